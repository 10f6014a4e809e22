"""HTML main text: a host-wide suffix array over every page's blocks, with page structure as a prior.

A page's blocks, without those that structure sets aside, are a token stream. The suffixes of all streams of a host,
cut to ``DEPTH`` tokens, are grouped by a shuffle, so no task holds a host. The array is sparse at first: of ``GAP``
neighbouring suffixes the one with the least hash, and the first and last of a block. Around those that many distinct
pages share, all suffixes are grouped. They form maximal repeats; a repeat whose pages go on in different ways at one
of its ends is boilerplate, also inside an article.
"""

from __future__ import annotations

import html as entities
import re
from functools import reduce
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import in_arrow, stored
from .shingles import gram_hashes, mixed, word_hashes

DEPTH = 6
GAP = 8
#: Repeats that only two pages hold are copied text, not boilerplate, from so many tokens in a page.
COPIED = 50
#: Bytes of text that are hashed at once.
PIECE = 4 << 20
#: Tokens whose heads are hashed at once, in the processor's cache.
STEP = 1 << 15
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>""", re.S)
ATTR = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
# Element names and the words in class, id and role that mark what isn't the article.
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "title", "svg", "math", "object", "canvas", "select", "head"}
ASIDE = {"nav", "footer", "aside", "form", "button", "dialog", "menu", "fieldset"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "link", "mark", "meta", "q", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
MARKS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo", "promotion", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert", "sidebar", "aside", "rail", "comment", "comments", "disqus", "reply", "replies", "respond", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead", "topbar", "share", "sharing", "social", "related", "recommended", "newsletter", "subscribe", "signup", "popup", "modal", "overlay", "widget", "pagination", "pager", "search", "complementary", "contentinfo"}
MAIN = {"article", "main"}


def marked(attrs: str) -> bool:
    for name, value in ATTR.findall(attrs):
        if name.lower() == "hidden" or name.lower() == "aria-hidden" and value.strip("\"'").lower() == "true":
            return True
        if MARKS & set(re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())):
            return True
    return False


def page_blocks(page: str | None) -> list[tuple[str, bool, bool]]:
    """(text, inside the article, set aside by structure) of each block with text, in page order."""
    out: list[tuple[str, bool, bool]] = []
    held: list[str] = []
    src, at = page or "", 0
    inside, skip, depth = 0, "", 0

    def flush():
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append((text, inside > 0, bool(skip)))

    while m := TOKEN.search(src, at):
        held.append(src[at : m.start()])
        at = m.end()
        closing, tag, attrs = m.group(1), (m.group(2) or "").lower(), m.group(3) or ""
        if not tag:
            if m.group().startswith("<![CDATA["):
                held.append(m.group()[9:-3].replace("&", "&amp;"))
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag in RAW and not closing and not attrs.endswith("/"):
            if tag not in INLINE:
                flush()
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(src, at) or (re.compile(r"<body\b", re.I).search(src, at) if tag == "head" else None)
            at = (end.end() if end and end.group().startswith("</") else end.start()) if end else (at if tag == "head" else len(src))
            continue
        if tag in INLINE and not (not closing and marked(attrs)):
            if not skip or tag != skip:
                continue
        flush()
        if tag in VOID:
            continue
        if skip:
            if tag == skip and not attrs.endswith("/"):
                depth += -1 if closing else 1
                if depth == 0:
                    skip = ""
                continue
            if closing or tag not in MAIN or marked(attrs) or skip in ASIDE:
                continue
            skip, depth = "", 0  # an article inside: the mark was a page's, not a part's
        if closing:
            inside -= tag in MAIN and inside > 0
        elif tag in ASIDE or tag == "header" and not inside or (marked(attrs) and tag not in ("html", "body")):
            if not attrs.endswith("/"):
                skip, depth = tag, 1
        elif tag in MAIN:
            inside += 1
    held.append(src[at:])
    flush()
    return out


def host_of(url: str | None) -> str:
    try:
        return urlsplit(url or "").netloc.lower()
    except ValueError:
        return ""


def pieces(batch: pa.RecordBatch, column: str = "blocks"):
    """Runs of rows with at most PIECE bytes of text, or one row: numpy's arrays over a run take several times its text."""
    blocks = batch.column(column)
    held = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(blocks.flatten()), 0).to_numpy())])
    ends, at = held[bounds_of(pc.list_value_length(blocks).to_numpy())[1:]], 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE, "right")))
        yield batch.slice(at, to - at)
        at = to


def bounds_of(lengths: np.ndarray) -> np.ndarray:
    """First places of runs laid end to end, and the end of the last."""
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def without_tails(bounds: np.ndarray, n: int) -> np.ndarray:
    """Marks for all places of the runs but the last n of each."""
    keep = np.ones(bounds[-1], bool)
    for d in range(1, n + 1):
        at = bounds[1:] - d
        keep[at[at >= bounds[:-1]]] = False
    return keep


def suffix_heads(hosts: list[str], blocks: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the host and the DEPTH-token heads of the suffixes of all pages, page after page.

    Beside them the first place of each page (and the end), and the sorted places where a block begins or, with the
    mark that parts it from the next, ends. A page's n-th head begins at its n-th token. Each different word is hashed
    once.
    """
    words = pc.split_pattern(blocks.flatten(), " ")
    coded = words.flatten().dictionary_encode()
    own = word_hashes(coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist())
    block = bounds_of(pc.list_value_length(words).to_numpy() + 1)
    page = bounds_of(pc.list_value_length(blocks).to_numpy())
    tokens = block[page]
    stream = np.full(block[-1], word_hashes([b"\n"])[0])
    stream[without_tails(block, 1)] = own[coded.indices.to_numpy()]
    h = np.concatenate([gram_hashes(stream[i : i + STEP + DEPTH - 1], DEPTH) for i in range(0, len(stream) or 1, STEP)])
    h = h[without_tails(tokens, DEPTH - 1)[: len(h)]]
    n = np.maximum(np.diff(tokens) - DEPTH + 1, 0)
    bounds = bounds_of(n)
    digests = {x: xxh3_64_intdigest(x) for x in set(hosts)}
    h = mixed(h ^ np.repeat(np.array([digests[x] for x in hosts], np.uint64), n))
    of = np.repeat(np.arange(len(n)), np.diff(page))
    of = np.concatenate([of, of])
    at = np.concatenate([block[:-1], block[1:] - DEPTH]) - tokens[of]
    there = (at >= 0) & (at < n[of])
    return h.view(np.int64), bounds, np.unique(at[there] + bounds[of[there]])


def sparse_places(heads: np.ndarray, bounds: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Places of the sparse heads: the first least (unsigned) of each GAP neighbours in a page, the edges, and all of a short page."""
    least, at = heads.view(np.uint64), np.arange(len(heads))
    for step in (1, 2, 4):  # least of 2, 4 and GAP = 8
        later = least[step:] < least[:-step]
        least, at = np.where(later, least[step:], least[:-step]), np.where(later, at[step:], at[:-step])
    found = np.repeat(np.diff(bounds) <= GAP, np.diff(bounds))
    found[at[without_tails(bounds, GAP - 1)[: len(at)]]] = True
    found[edges] = True
    return np.flatnonzero(found)


def page_of(places: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.searchsorted(bounds, places, "right") - 1


def firsts(*columns: np.ndarray) -> np.ndarray:
    """Where ordered rows differ from the row before, the first included."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def page_counts(key: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys, a page of each and its number of pages; the pages ascend."""
    order = np.argsort(key, kind="stable")
    order = order[firsts(key[order], page[order])]
    key = key[order]
    at = firsts(key)
    return key[at], page[order[at]], np.diff(at, append=len(key))


def pair_counts(key: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each different (key, other) and the number of its places."""
    order = np.lexsort((other, key))
    at = firsts(key[order], other[order])
    return order[at], np.diff(at, append=len(key))


def finder(sorted_keys: np.ndarray):
    """A function that gives the places of those of its keys that are in ``sorted_keys``, and their places there."""
    marks = np.zeros(1 << 20, bool)  # by leading bits: few keys have to be searched for
    marks[sorted_keys.view(np.uint64) >> np.uint64(44)] = True

    def find(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.flatnonzero(marks[keys.view(np.uint64) >> np.uint64(44)])
        if not len(place):
            return place, place
        at = np.minimum(np.searchsorted(sorted_keys, keys[place]), len(sorted_keys) - 1)
        same = sorted_keys[at] == keys[place]
        return place[same], at[same]

    return find


def around(at: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Places less than GAP from the ascending places ``at`` in the same page."""
    page = page_of(at, bounds)
    edge = np.zeros(bounds[-1] + 1, np.int64)
    np.add.at(edge, np.maximum(at - GAP + 1, bounds[page]), 1)
    np.add.at(edge, np.minimum(at + GAP, bounds[page + 1]), -1)
    return np.flatnonzero(np.cumsum(edge)[:-1])


def boilerplate(spots: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    """Token ranges of the maximal repeats that are boilerplate; a spot is (at, pages, ways before, ways after).

    A repeat ends where its heads end or where their number of pages halves or doubles. Copies of a page go on alike
    at both ends, boilerplate doesn't at one end at least.
    """
    out, pairs, run = [], [], []
    for spot in [*sorted(spots), None]:
        if run and (spot is None or spot[0] != run[-1][0] + 1 or spot[1] > 2 * run[-1][1] or 2 * spot[1] < run[-1][1]):
            first, last = run[0], run[-1]
            if 2 * first[2] > first[1] or 2 * last[3] > last[1]:
                (pairs if max(x[1] for x in run) == 2 else out).append((first[0], last[0] + DEPTH))
            run = []
        run.append(spot)
    return out + (pairs if sum(b - a for a, b in pairs) < COPIED else [])


def whole_texts(blocks: pa.ListArray, inside: pa.ListArray) -> list[str]:
    """Text of each page's article (without one: of all blocks)."""
    page = bounds_of(pc.list_value_length(blocks).to_numpy())
    own = inside.flatten().to_numpy(zero_copy_only=False).astype(bool)
    of = np.repeat(np.arange(len(blocks)), np.diff(page))
    own |= (np.bincount(of[own], minlength=len(blocks)) == 0)[of]
    kept = blocks.flatten().filter(pa.array(own))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds_of(own)[page], pa.int32()), kept), " ").to_pylist()


def pruned(texts: list[str], inside: list[bool], ranges: list[tuple[int, int]]) -> str:
    """Text of the article's blocks (without one: of all blocks) outside the ranges of the stream."""
    whole, out, at = not any(inside), [], 0
    gone = {i for a, b in ranges for i in range(a, b)}
    for text, own in zip(texts, inside):
        end = at + text.count(" ") + 1
        if whole or own:
            out += [text] if gone.isdisjoint(range(at, end)) else [w for i, w in enumerate(text.split(" "), at) if i not in gone]
        at = end + 1
    return " ".join(out)


def main_texts(pages: DataFrame, limit: int = 32 << 20) -> DataFrame:
    """page_id, url, text, n_chars of every row.

    The main text is the declared article (article, main), else the page's open blocks, without the parts that
    structure sets aside and without boilerplate: repeats on at least the square root of the host's distinct pages
    (two at least); repeats under DEPTH + GAP - 1 tokens count where they begin or end a block. Null, empty or
    all-boilerplate pages give empty text; a null url is a host of its own; equal pages don't count as distinct, so a
    copy keeps its text; an empty table gives no rows; other columns are not read.

    Repeated heads reach the tasks by broadcast of at most about ``limit`` bytes: where there are more, hosts are dealt
    into so many groups that each group's fit, and the groups run one after the other.
    """
    spark = pages.sparkSession

    def parse(batches):
        for b in batches:
            rows = []
            for url, src in zip(b.column(2).to_pylist(), b.column(4)):
                found = [(t, inside) for t, inside, aside in page_blocks(src.as_py()) if not aside]
                rows.append((host_of(url), [t for t, _ in found], [x for _, x in found]))
            cols = list(zip(*rows)) if rows else [[], [], []]
            h, t, i = (pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.list_(pa.string()), pa.list_(pa.bool_()))))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), h, b.column(3), t, i], ["uid", "page_id", "url", "host", "th", "blocks", "inside"])

    def sparse_of(batches):
        for b in batches:
            for part in pieces(b):
                heads, bounds, edges = suffix_heads(part.column("host").to_pylist(), part.column("blocks"))
                at = sparse_places(heads, bounds, edges)
                key, page, n = page_counts(heads[at], page_of(at, bounds))
                need, of = (part.column(c).to_numpy()[page] for c in ("need", "slot"))
                order = np.argsort(of, kind="stable")  # runs of one host take less room
                yield counted(0, *(x[order] for x in (key, of, n, need)))

    slot = F.pmod(F.xxhash64("host"), F.lit(1 << 20))
    base = pages.select(F.monotonically_increasing_id().alias("uid"), F.col("page_id").cast("long").alias("page_id"), "url", F.xxhash64("html").alias("th"), "html")
    parsed = stored(in_arrow(base, parse, "uid long, page_id long, url string, host string, th long, blocks array<string>, inside array<boolean>"), "zstd")
    copies = stored(parsed.groupBy("host", "th").agg(F.min("uid").alias("first"), F.count("*").alias("n"), F.max(F.size("blocks")).alias("size")))
    needs = stored(copies.filter("size > 0").groupBy("host").agg(F.greatest(F.lit(2), F.ceil(F.sqrt(F.count("*")))).cast("int").alias("need")))
    again = stored(copies.filter("n > 1").select("host", "th", "first"))  # written, so that Spark knows the sizes and moves no texts for small ones
    distinct = parsed.join(again, ["host", "th"], "left").filter("first IS NULL OR first = uid").join(needs, "host").select("host", "blocks", "need", slot.alias("slot"))
    many = lambda df: df.filter("kind = 0").groupBy("key").agg(F.sum("n").alias("pages"), F.max("need").alias("need"), F.max("other").alias("slot")).filter("pages >= need")
    sparse = stored(many(in_arrow(distinct, sparse_of, COUNTS)).select("key", "slot"))
    groups = max(1, -(-sparse.count() * (GAP * 32) // limit))
    of = lambda df, g, c: df if groups == 1 else df.filter(F.pmod(c, F.lit(groups)) == g)
    out = [pruned_pages(of(parsed, g, slot), of(distinct, g, F.col("slot")), of(sparse, g, F.col("slot")), spark) for g in range(groups)]
    return reduce(DataFrame.unionByName, out).withColumn("n_chars", F.char_length("text").cast("long"))


COUNTS = "kind int, key long, other long, n long, need int"


def counted(kind: int, *cols: np.ndarray) -> pa.RecordBatch:
    """A batch of COUNTS."""
    names, kinds = zip(*(c.split() for c in COUNTS.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, {"int": pa.int32(), "long": pa.int64()}[k]) for c, k in zip((np.full(len(cols[0]), kind), *cols), kinds)], names)


def pruned_pages(parsed: DataFrame, distinct: DataFrame, sparse: DataFrame, spark: SparkSession) -> DataFrame:
    """page_id, url and text of parsed pages; ``sparse``: the sparse heads that many distinct pages share."""
    known = spark.sparkContext.broadcast(np.sort(sparse.toArrow().column("key").to_numpy()))

    def counts_of(batches):
        find = finder(known.value)
        for b in batches:
            for part in pieces(b):
                heads, bounds, _ = suffix_heads(part.column("host").to_pylist(), part.column("blocks"))
                near = around(find(heads)[0], bounds)
                page, key = page_of(near, bounds), heads[near]
                need = part.column("need").to_numpy()
                same, first, n = page_counts(key, page)
                yield counted(0, same, np.zeros(len(same), np.int64), n, need[first])
                for kind, step in ((1, -DEPTH), (2, DEPTH)):
                    to = near + step
                    there = (to >= bounds[page]) & (to < bounds[page + 1])
                    other = np.where(there, heads[np.where(there, to, 0)], 0)
                    at, n = pair_counts(key, other)
                    yield counted(kind, key[at], other[at], n, need[page[at]])

    counts = in_arrow(distinct, counts_of, COUNTS).groupBy("kind", "key", "other").agg(F.sum("n").alias("n"), F.max("need").alias("need"))
    ways = lambda kind: F.count_if(F.col("kind") == kind)
    heads = counts.groupBy("key").agg(F.sum(F.when(F.col("kind") == 0, F.col("n"))).alias("pages"), ways(1).alias("before"), ways(2).alias("after"), F.max("need").alias("need"))
    heads = heads.filter("pages >= need").select("key", "pages", "before", "after").toArrow().sort_by("key")
    table = spark.sparkContext.broadcast([heads.column(c).to_numpy() for c in ("key", "pages", "before", "after")])

    def prune(batches):
        key, *facts = table.value
        find = finder(key)
        for b in batches:
            for part in pieces(b):
                blocks, inside = part.column("blocks"), part.column("inside")
                heads, bounds, _ = suffix_heads(part.column("host").to_pylist(), blocks)
                place, at = find(heads)
                page, texts = page_of(place, bounds), whole_texts(blocks, inside)
                first = firsts(page)
                for a, z in zip(first, [*first[1:], len(page)]):
                    p = int(page[a])
                    ranges = boilerplate(list(zip((place[a:z] - bounds[p]).tolist(), *(f[at[a:z]].tolist() for f in facts))))
                    if ranges:
                        texts[p] = pruned(blocks[p].as_py(), inside[p].as_py(), ranges)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return in_arrow(parsed.select("page_id", "url", "host", "blocks", "inside"), prune, "page_id long, url string, text string")
