"""N-gram Jaccard join: T-occurrence search with DivideSkip inside blocks that exact signatures bring together.

1. A document's set of shingles becomes sorted 64-bit hashes; equal sets are one node.
2. A node is cut into parts by shingle hash. Two sets that reach the threshold differ in at most d shingles, d by
   size class, so of m = d + 1 + s parts at least 1 + s are equal. Thin parts (at most two shingles, fewer where parts
   are small) are left out unless a node has more than s of them; the others that a link makes equal are at least as
   many as a node ``needs``. A part equal to no other node's is dropped, then a node with fewer parts than it needs, and
   both once more. Equal parts of one class bring the nodes that stay together, with no link lost.
   A task reports an equal part once, whatever the number of its nodes that have it.
3. Nodes joined by equal parts form blocks. A block is searched as a whole, or, beyond a number of shingles, by size
   class in pairs of slices of so many shingles. Every node that isn't reached yet is a query: short inverted lists are
   merged, long ones are probed for the candidates, and those that reach the required overlap are linked and leave the lists.
"""

from __future__ import annotations

import math
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, forget, in_arrow, packed, packed_rows, release, small, stored
from .graph import components
from .shingles import gram_hashes, mixed, word_hashes

THIN = 2  # at most; classes with few shingles a part use less
SHINGLES = 1_000_000  # in a slice of a block
SIGNATURES = 400_000  # that a task holds at once
LARGE = 8 << 20  # bytes of sets after whose search memory goes back to the system
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    w = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not w:
        return np.empty(0, np.uint64)
    h = word_hashes(w)
    if len(w) < k:
        return mixed(np.array([hash_all(h)], np.uint64))
    return np.unique(gram_hashes(h, k))


def hash_all(h: np.ndarray) -> int:
    out = len(h)
    for x in h.tolist():
        out = (out * 0x9E3779B97F4A7C15 + x + 1) & 0xFFFFFFFFFFFFFFFF
    return out


def node_of(s: np.ndarray) -> int:
    from xxhash import xxh3_64_intdigest

    x = xxh3_64_intdigest(s.tobytes())
    return x - (1 << 64) if x >> 63 else x


class Classes:
    """Size classes [low, high]: linked sets lie in one class or in neighbours. part_count(c) serves class c with c - 1."""

    def __init__(self, threshold: Fraction):
        self.t = threshold
        self.lows = [1]
        while self.lows[-1] < 1 << 31:
            low = self.lows[-1]
            self.lows.append(int(low / threshold) + 1)
        self.table = np.array(self.lows)

    def of(self, n: int) -> int:
        return int(np.searchsorted(self.table, n, "right")) - 1

    @lru_cache(maxsize=None)  # noqa: B019
    def parts(self, c: int) -> tuple[int, int, int]:
        """(m, s, thin): by the largest difference |A xor B| <= (1 - t) / (1 + t) * (|A| + |B|) at the class's largest size.

        A Poisson estimate picks the largest ``thin`` that leaves out no more than half of s.
        """
        high = self.lows[c + 1] - 1
        d = int((1 - self.t) / (1 + self.t) * 2 * high)
        s = max(1, d // 4)
        m, thin = d + 1 + s, THIN
        mean = self.lows[max(c - 1, 0)] / m
        while thin and m * sum(math.exp(-mean) * mean**i / math.factorial(i) for i in range(thin + 1)) > s / 2:
            thin -= 1
        return m, s, thin


def signatures(s: np.ndarray, classes: Classes) -> list[tuple[np.ndarray, int]]:
    """For the set's own class and the next one: hashes of its parts, and how many of them a linked set must share."""
    own, out = classes.of(len(s)), []
    spread = mixed(s ^ np.uint64(0x5851F42D4C957F2D))
    weight = mixed(s + np.uint64(0x14057B7EF767814F))
    for c in (own, own + 1):
        m, slack, thin = classes.parts(c)
        part = (spread % np.uint64(m)).astype(np.int64)
        count = np.bincount(part, minlength=m)
        order = np.argsort(part, kind="stable")
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(weight[order], dtype=np.uint64)])
        ends = np.cumsum(count)
        content = sums[ends] - sums[ends - count]
        use = np.flatnonzero(count > thin)
        if m - len(use) > slack:
            use = np.arange(m)
        tag = (np.uint64(c) << np.uint64(40)) + use.astype(np.uint64)
        out.append((mixed(mixed(content[use]) + mixed(tag)).view(np.int64), 1 + slack - (m - len(use))))
    return out


def search(sets: list[np.ndarray], t: Fraction) -> list[tuple[int, int]]:
    """Links (i, j) that join the components of the sets, with no component split.

    A breadth-first search whose every step is a T-occurrence query: a set of n shingles links only with sets that
    hold T = ceil(t n) of them (and are neither smaller than t n nor larger than n / t). DivideSkip: the longest
    lists, fewer than T, are not merged but probed for each candidate of the others. Reached sets leave the lists,
    so a group of near copies costs little more than one query. The merge counts by document number.
    """
    num, den = t.numerator, t.denominator
    order = np.array(sorted(range(len(sets)), key=lambda i: (len(sets[i]), i)), np.int64)
    sizes = np.array([len(sets[i]) for i in order], np.int64)
    flat = np.concatenate([sets[i] for i in order]) if len(order) else np.empty(0, np.uint64)
    token = np.unique(flat, return_inverse=True)[1].astype(np.int32)  # a slice pair has far fewer than 2**31 shingles
    del flat
    doc = np.repeat(np.arange(len(order), dtype=np.int32), sizes)
    shared = np.bincount(token)[token] > 1 if len(token) else np.empty(0, bool)
    token, doc = token[shared], doc[shared]
    n_tokens = int(token.max()) + 1 if len(token) else 0
    own_at = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(order)))])
    lists = doc[np.argsort(token, kind="stable")]
    held = np.bincount(token, minlength=n_tokens)
    list_at = np.concatenate([[0], np.cumsum(held)])
    weight = np.bincount(doc, weights=held[token], minlength=len(order))
    del doc, shared
    open_, left, built, links = np.ones(len(order), bool), len(order), len(order), []

    def linked(q: int) -> np.ndarray:
        n = int(sizes[q])
        need = -(-num * n // den)
        own = token[own_at[q] : own_at[q + 1]]
        length = list_at[own + 1] - list_at[own]
        own, length = own[length > 0], length[length > 0]
        if n == 0 or len(own) < need:
            return own[:0]
        n_long = min(need - 1, int(need / (0.0085 * np.log2(max(2, length.max())) + 1)))
        rank = np.argsort(length, kind="stable")
        short, long_ = own[rank[: len(own) - n_long]], own[rank[len(own) - n_long :]]
        least, past = np.searchsorted(sizes, [need, n * den // num + 1])
        merged = np.concatenate([lists[list_at[x] : list_at[x + 1]] for x in short])
        merged = merged[(merged >= least) & (merged < past)] - least
        hits = np.bincount(merged, minlength=past - least)
        hits[~open_[least:past]] = 0
        found = np.flatnonzero(hits >= max(1, need - n_long))
        common, found = hits[found], found + least
        for x in long_ if len(found) else ():
            one = lists[list_at[x] : list_at[x + 1]]
            common += one[np.minimum(np.searchsorted(one, found), len(one) - 1)] == found
        return found[common * den >= num * (n + sizes[found] - common)]

    for start in np.argsort(-weight, kind="stable"):
        todo = [int(start)] * bool(open_[start])
        left -= len(todo)
        open_[start] = False
        while todo and left:
            q = todo.pop()
            found = linked(q)
            open_[found] = False
            left -= len(found)
            links += [(int(order[q]), int(order[y])) for y in found]
            todo += found.tolist()
            if 2 * left < built:  # lists without the sets that have been reached
                still = open_[lists]
                list_at = np.concatenate([[0], np.cumsum(still)])[list_at]
                lists, built = lists[still], left
        if not left:
            break
    return links


def equal_parts(held: list[tuple[int, np.ndarray, int]]) -> pa.RecordBatch:
    """(sig, node, need, kind, salt) of some (node, signatures, need): a row for each signature, in the order of the nodes.

    Kind 0: no other of these nodes has it. Where several do, each has a row of kind 2 with a salt of its own, and the
    first one another of kind 1 that stands for them all.
    """
    sig = np.concatenate([s for _, s, _ in held])
    size = [len(s) for _, s, _ in held]
    node, need = (np.repeat(np.array([x[i] for x in held], np.int64), size) for i in (0, 2))
    _, first, where, count = np.unique(sig, return_index=True, return_inverse=True, return_counts=True)
    several = count[where] > 1
    stand = first[count > 1]
    at = np.concatenate([np.arange(len(sig)), stand])
    kind = np.concatenate([np.where(several, 2, 0), np.ones(len(stand), np.int64)])
    salt = np.where(kind == 2, node[at] | 1, 0)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (sig[at], node[at], need[at].astype(np.int32), kind.astype(np.int32), salt)], ["sig", "node", "need", "kind", "salt"])


def pieces(batch: pa.RecordBatch, rows: int = 65_536):
    """The batch in pieces of so many rows, so that Spark holds few of them at once."""
    return (batch.slice(i, rows) for i in range(0, batch.num_rows, rows))


def same_signature(signed: DataFrame) -> DataFrame:
    """Edges (u, v) that join the nodes with an equal signature, from the rows of ``equal_parts``.

    ``need`` is twice the parts that a node needs, plus 1 in its second class. Only signatures that two different nodes have leave the shuffle. Tasks report a signature there once for each
    SIGNATURES signatures, so a hot one has few rows; the rows of kind 2 are dealt out by their salts.
    """
    every = Window.partitionBy("sig", "salt")
    met = signed.withColumn("several", F.min("node").over(every) != F.max("node").over(every)).filter("kind = 2 OR kind = 0 AND several")
    rows = stored(met.select("sig", "node", "need").distinct())
    for _ in range(2):
        enough = rows.groupBy("node", "need").agg(F.count("*").alias("c")).filter("c >= need div 2").select("node", "need")
        some = stored(rows.join(enough, ["node", "need"], "left_semi"))
        hubs = some.groupBy("sig").agg(F.min("node").alias("hub"), F.max("node").alias("last")).filter("hub <> last").select("sig", "hub")
        hubs = stored(hubs)
        discard(rows)
        rows = stored(some.join(hubs.select("sig"), "sig", "left_semi"))
        discard(some)
    edges = stored(rows.join(hubs, "sig").filter("node <> hub").select(F.col("node").alias("u"), F.col("hub").alias("v")).distinct())
    discard(rows, hubs)
    return edges


def classes_of(docs: DataFrame, threshold: str = "0.9", k: int = 3, shingles: int = SHINGLES, **broadcast) -> DataFrame:
    """doc_id, th, n_shingles, root, component_id for every row of ``docs`` (th: xxhash64 of the text; root: the component's node, null for an empty set).

    Text is lower-cased for A-Z only. Fewer than k words: the whole sequence is the one shingle; null or blank
    text: an empty set, linked with nothing (its component is its own doc_id). Repeated rows and equal sets are
    linked. A null doc_id is a row like any other; component_id is the smallest id that isn't null. An empty
    table gives no rows; other columns are not read.
    """
    t = Fraction(threshold)

    def profile(batches):
        for b in batches:
            out = ([], [])
            for x in b.column(2):
                s = shingle_set(x.as_py(), k)
                out[0].append(len(s))
                out[1].append(node_of(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64())], ["doc_id", "th", "n", "node"])

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    rows = stored(in_arrow(base, profile, "doc_id long, th long, n long, node long"))
    # Sets under 9 (for 0.9) link only with equal ones.
    least = next(n for n in range(2, 1 << 20) if Fraction(n - 1, n) >= t) - 1

    def sign(batches):
        classes, held, n, seen = Classes(t), [], 0, set()
        for b in batches:
            for x in b.column(0):
                s = shingle_set(x.as_py(), k)
                if len(s) >= least and (node := node_of(s)) not in seen:
                    seen.add(node)
                    held += [(node, sig, need * 2 + i) for i, (sig, need) in enumerate(signatures(s, classes))]
                    n += sum(len(sig) for _, sig, _ in held[-2:])
                if n >= min(shingles, SIGNATURES):
                    yield from pieces(equal_parts(held))
                    held, n, seen = [], 0, set()
        if held:
            yield from pieces(equal_parts(held))

    near = same_signature(in_arrow(base.select("text"), sign, "sig long, node long, need int, kind int, salt long"))
    blocks = components(near)
    members = rows.join(small(blocks, 16, **broadcast), "node").groupBy("node", "root").agg(F.min(F.struct("doc_id", "th")).alias("r"), F.min("n").alias("n"))
    members = stored(members.select("node", "root", "r.doc_id", "r.th", "n"))
    edges = linked(base, sliced(members, t, shingles), t, k, **broadcast)
    links = components(edges)
    discard(near)
    comp = rows.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least")).join(links, "node", "left")
    comp = comp.select("node", "least", F.coalesce("root", "node").alias("root"))
    best = comp.groupBy("root").agg(F.min("least").alias("component_id"))
    comp = stored(comp.join(best, "root").select("node", "root", "component_id"))
    discard(blocks, members, links)
    one = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = rows.join(comp, "node", "left").select("doc_id", "th", F.col("n").alias("n_shingles"), "root", one.alias("component_id"))
    out.folio_parts = rows, comp
    return out


def sliced(members: DataFrame, t: Fraction, shingles: int) -> DataFrame:
    """members (node, root, n) with ``keys``, the searches (block, i, j) that a node takes part in.

    A block of at most twice ``shingles`` is one search. A larger one is searched by size class, each with the class below
    it, in pairs of slices of about ``shingles`` by node hash.
    """
    lows = F.array(*[F.lit(x) for x in Classes(t).lows])
    cls = F.size(F.filter(lows, lambda x: x <= F.col("n")))
    whole = members.groupBy("root").agg(F.sum("n").alias("all")).filter(F.col("all") > 2 * shingles)
    large = stored(members.join(whole.select("root"), "root").withColumn("block", F.explode(F.array(cls, cls + 1))).withColumn("own", cls))
    # A search of class c holds classes c - 1 and c; where class c is missing, search c - 1 covers it.
    counts = large.groupBy("root", "block").agg(F.ceil(F.sum("n") / shingles).cast("int").alias("slices"), F.max("own").alias("top")).filter("top = block")
    mine = F.pmod(F.xxhash64("node", F.lit(3)), F.col("slices")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("slices") - 1), lambda o: (o != F.col("mine")) | (F.col("slices") == 1))
    key = lambda b, i, j: F.struct(b.cast("int").alias("block"), i.cast("int").alias("i"), j.cast("int").alias("j"))
    keyed = large.join(counts.select("root", "block", "slices"), ["root", "block"]).withColumn("mine", mine)
    keyed = keyed.withColumn("keys", F.transform(others, lambda o: key(F.col("block"), F.least(o, F.col("mine")), F.greatest(o, F.col("mine")))))
    keyed = keyed.groupBy("node").agg(F.flatten(F.collect_list("keys")).alias("keys"))
    one = F.array(key(F.lit(-1), F.lit(0), F.lit(0)))
    return stored(members.join(keyed, "node", "left").withColumn("keys", F.coalesce("keys", one)))


def linked(base: DataFrame, members: DataFrame, t: Fraction, k: int, **broadcast) -> DataFrame:
    """Edges (u, v) that join linked nodes of a block; members: (node, root, doc_id, th, n, keys), base: (doc_id, th, text)."""

    def sets(batches):
        seen = set()  # a row that repeats is taken once a task
        for b in batches:
            node, text = b.column(0), b.column(1)
            new = [i for i, x in enumerate(node.to_pylist()) if x not in seen and not seen.add(x)]
            packed_sets = pa.array([shingle_set(text[i].as_py(), k).tobytes() for i in new], pa.binary())
            at = pa.array(new, pa.int64())
            yield pa.RecordBatch.from_arrays([node.take(at), b.column(2).take(at), b.column(3).take(at), packed_sets], ["node", "root", "keys", "set"])

    side = small(members.select(F.col("doc_id").alias("m_id"), F.col("th").alias("m_th"), "node", "root", "keys"), 48, **broadcast)
    texts = base.join(side, base["doc_id"].eqNullSafe(side["m_id"]) & (base["th"] == side["m_th"])).select("node", "text", "root", "keys")
    got = in_arrow(texts, sets, "node long, root long, keys array<struct<block:int,i:int,j:int>>, set binary")
    placed = got.select("node", "root", F.explode("keys").alias("key"), "set").select("node", "root", "key.block", "key.i", "key.j", "set")

    def run(table):
        forget()
        nodes, at = np.unique(table.column("node").to_numpy(), return_index=True)
        held = table.column("set")
        found = search([np.frombuffer(held[int(i)].as_buffer(), np.uint64) for i in at], t)
        if table.nbytes > LARGE:
            release()
        return pa.table({"u": pa.array([int(nodes[a]) for a, _ in found], pa.int64()), "v": pa.array([int(nodes[b]) for _, b in found], pa.int64())})

    return placed.groupBy("root", "block", "i", "j").applyInArrow(run, "u long, v long")


def representatives(docs: DataFrame, threshold: str = "0.8", k: int = 5, **limits) -> DataFrame:
    """``docs`` with one row of each component left: the smallest doc_id (null last), then text hash; of equal such rows any one.

    Null and blank texts have empty sets and all stay; a null doc_id is an id like any other; repeated rows count as
    copies of each other; an empty table gives no rows; all columns are kept, whatever their names.
    """
    classes = classes_of(docs, threshold, k, **limits)
    found = stored(classes)
    discard(*classes.folio_parts)
    place = F.struct(F.col("doc_id").isNull().alias("nil"), "doc_id", "th")
    grouped = found.filter("root IS NOT NULL")
    best = grouped.groupBy("root").agg(F.min(place).alias("best"))
    key = [F.col("doc_id").alias("k_id"), F.col("th").alias("k_th")]
    gone = stored(grouped.join(best, "root").filter(place != F.col("best")).select(*key).distinct())
    again = stored(grouped.groupBy("doc_id", "th").agg(F.count("*").alias("c")).filter("c > 1").select(*key))
    limits.pop("shingles", None)
    rows = packed_rows(docs, id=F.col("doc_id").cast("long"), th=F.xxhash64("text"))

    def rid(df: DataFrame, side: DataFrame, how: str) -> DataFrame:
        return df.join(small(side, 16, **limits), df["id"].eqNullSafe(side["k_id"]) & (df["th"] == side["k_th"]), how)

    kept = rid(rows, gone, "left_anti")
    if again.isEmpty():
        return kept.select("row.*")
    first = rid(kept, again, "left_semi").dropDuplicates(["id", "th"])
    return rid(kept, again, "left_anti").unionByName(first).select("row.*")
