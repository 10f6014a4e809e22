"""Operators against small hand-derived cases."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from foliospark.functions import boxes, furniture, syllables, text
from foliospark.functions.similarity import coverage_of
from foliospark.operators import audits, joins, layout, order, regions, search, vote
from foliospark.sources import readers, sinks


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("o")).first()["o"]


@pytest.mark.parametrize(
    "f, value, want",
    [
        (text.fold, "Tổng Đá straße", "tong da straße"),
        (text.norm, "Tổng Đá straße", "tongdastrae"),
        (text.fold, "é", "e"),
        (text.fold_same_length, "é", "é"),
        (text.search_key, "tỷ quý yêu máy", "ti qui yeu may"),
        (text.clean, "A–B,  c", " a b c "),
        (text.page_list, "10-13, 17; 20–21; 5-3", [10, 11, 12, 13, 17, 20, 21]),
        (text.page_bounds, "10-13, 17", [10, 17, 13]),
        (text.auto_queries, "Foo bar / baz (qux, quux)", ["foo bar", "qux"]),
        (text.auto_queries, "Foo / Bar", ["foo", "bar"]),
        (text.printed_number, "- 1 2 -", 12),
        (text.printed_number, "1234", None),
        (text.strip, " \t a b\n", "a b"),
        (text.html_escape, "<a & 'b'>", "&lt;a &amp; &#x27;b&#x27;&gt;"),
        (text.cell, "a|b", "a\\|b"),
        (text.without_markup, "> [figure]: cap[?]", "cap"),
    ],
)
def test_text(spark, f, value, want):
    assert one(spark, value, f) == want


def test_words_with_and_without_spaces(spark):
    df = spark.createDataFrame([(" twowords here ",)], "t string").select(text.has_words(F.col("t"), F.array(F.lit("two words"))).alias("a"), text.has_letters(F.col("t"), F.array(F.lit("two words"))).alias("b"))
    assert tuple(df.first()) == (False, True)


def test_collation(spark):
    names = ["ab c", "abc", "az", "aw", "ba", "bà", "bả", "bã", "bá", "bạ"]
    df = spark.createDataFrame([(n,) for n in reversed(names)], "n string").withColumn("k", text.collation_key(F.col("n"))).orderBy("k.letters", "k.tones", "n")
    assert [r["n"] for r in df.collect()] == ["abc", "ab c", "aw", "az", "ba", "bà", "bá", "bã", "bả", "bạ"]


@pytest.mark.parametrize("needle, hay, want", [("", "x", 1.0), ("abc", "xxabcxx", 1.0), ("abcdef", "zzz", 0.0), ("abcdefgh", "zzabcdxfghzz", 7 / 8), ("abcdefxyzwvu", "ab1cd2ef34xyzwvu", 1.0)])
def test_coverage(needle, hay, want):
    assert coverage_of(needle, hay) == pytest.approx(want)


def test_votes(spark):
    df = spark.createDataFrame([(7, 7), (7, 7), (7, 1), (9, 1), (9, 9), (5, None), (7000, 6)][:6], "page int, v int")
    got = {r["page"]: r["out"] for r in vote.mode_near(df.withColumn("n", F.col("page")), ["page"], "v", "n", "out").collect()}
    assert got == {7: 7, 9: 9}
    rows = [("x", "y", "y"), ("x", "y", "x"), ("x", "x", "y"), ("x", None, None), ("x", "y", "z"), ("x", None, "y")]
    out = spark.createDataFrame(rows, "p string, a string, b string").select(vote.voted(F.col("p"), F.col("a"), F.col("b")).alias("v")).collect()
    assert [r["v"]["word"] for r in out] == ["y", "x", "x", "x", "x[?]", "x[?]"]
    assert [r["v"]["candidates"] for r in out][4:] == [["x", "y", "z"], ["x", "y"]]


def test_alignment(spark):
    a = spark.createDataFrame([(1, i, w) for i, w in enumerate("a b c d e".split())], "page int, pos int, word string")
    b = spark.createDataFrame([(1, i, w) for i, w in enumerate("a x c e".split())], "page int, pos int, word string")
    got = vote.aligned(a, b, ["page"], "o").orderBy("pos").collect()
    assert [r["o"] for r in got] == ["a", "x", "c", None, "e"]


def test_quartile_and_step(spark):
    df = spark.createDataFrame([(1, x) for x in (0.10, 0.12, 0.20, 0.30)], "g int, x double")
    assert layout.lower_quartile(df, ["g"], "x", "q").first()["q"] == 0.12
    ys = spark.createDataFrame([(1, y) for y in (0.10, 0.13, 0.16, 0.26)], "g int, y double")
    assert layout.line_step(ys, ["g"], "y", 0.01, 0.05, 0.026).first()["step"] == pytest.approx(0.03)


def test_markers_carried_and_crossing(spark):
    rows = [("f", 1, "t0", None), ("f", 2, "m", 5), ("f", 3, "t1", None), ("f", 4, "t2", None), ("f", 5, "m", 6), ("f", 6, "t3", None)]
    df = spark.createDataFrame(rows, "path string, n int, text string, m int")
    plain = order.carried(df, "m", ["path"], ["n"], "page").orderBy("n")
    assert [r["page"] for r in plain.collect()] == [None, 5, 5, 5, 6, 6]
    seeded = order.carried(df, "m", ["path"], ["n"], "page", seed=True)
    assert [r["page"] for r in seeded.orderBy("n").collect()] == [5, 5, 5, 5, 6, 6]
    lines = seeded.filter("m IS NULL")
    assert ([5, 6], "t2 t3") in [(r["pages"], r["text"]) for r in order.crossing(lines, ["path"], "n").collect()]
    blank = lines.unionByName(spark.createDataFrame([("f", 5, "", None, 5)], lines.schema))
    assert len(order.crossing(blank, ["path"], "n").collect()) == 4


def test_marker_audit(spark):
    df = spark.createDataFrame([(1, i, p) for i, p in enumerate((1, 2, 2, 4, 6))], "g int, i int, p int")
    got = {(r["problem"], r["p"]) for r in audits.markers(df, ["g"], "p", ["i"], 1, 5).collect()}
    assert got == {("missing", 3), ("missing", 5), ("duplicate", 2), ("range", 6), ("disorder", 2)}


def test_reading_rows_use_the_anchor(spark):
    rows = [(1, i, 0.1 * i, c - 0.01, 0.02) for i, c in enumerate((0.110, 0.118, 0.126))]
    got = order.reading_rows(spark.createDataFrame(rows, "page int, line_no int, x double, y double, h double"), ["page"]).orderBy("line_no").collect()
    assert [r["row_no"] for r in got] == [0, 0, 1]


@pytest.mark.parametrize("tail, want", [([], [(10, 30)]), (range(995, 1000), [(10, 30), (995, 5)])])
def test_bands(spark, tail, want):
    ink = {*range(10, 30), *range(32, 40), *range(500, 505), *tail}
    df = spark.createDataFrame([(1, y, 9 if y in ink else 0, 1000) for y in range(1000)], "page int, y int, ink int, height int")
    got = order.bands(df, ["page"], F.col("height")).orderBy("start").collect()
    assert [(r["start"], r["rows"]) for r in got] == want


def test_chapters_and_sections(spark):
    c = spark.createDataFrame([("01", "T", 7, 48, [("a", 13), ("b", 22)])], "no string, title string, first int, last int, sections array<struct<title:string,page:int>>")
    p = spark.createDataFrame([(8,), (15,), (30,)], "page int")
    assert [r["section"] for r in joins.to_section(p, c).orderBy("page").collect()] == ["T", "a", "b"]
    with pytest.raises(Exception, match="in no chapter"):
        joins.to_section(spark.createDataFrame([(99,)], "page int"), c).collect()


def test_region_fixes_and_upsert(spark):
    lines = spark.createDataFrame([(1, 0, "gone", 0.05, 0.1, 0.1, 0.0), (1, 1, "stays", 0.5, 0.5, 0.1, 0.1)], "page int, line_no int, text string, x double, y double, w double, h double")
    box = (0.1, 0.1, 0.2, 0.1)
    fix = spark.createDataFrame([(1, box, [("new", 0.9, 0.1, 0.1, 0.1, 0.1)])], "page int, replace struct<x:double,y:double,w:double,h:double>, lines array<struct<text:string,conf:double,x:double,y:double,w:double,h:double>>")
    assert {r["text"] for r in joins.with_fixes(lines, fix).collect()} == {"stays", "new"}
    kv = lambda rows: spark.createDataFrame(rows, "k int, v string")
    got = joins.upserted(kv([(2, "a"), (5, "b")]), kv([(2, "")]).select("k"), kv([(5, "c"), (9, "d")]), "k", "v")
    assert {tuple(r) for r in got.collect()} == {(5, "c"), (9, "d")}


def test_boxes_merge_to_a_fixpoint(spark):
    a, b, c = (0, 0, 0.1, 0.3), (0.105, 0.25, 0.3, 0.05), (0.2, 0.05, 0.05, 0.1)
    got = regions.merged(spark.createDataFrame([(1, *map(float, x)) for x in (a, b, c)], "page int, x double, y double, w double, h double")).collect()
    assert len(got) == 1 and (got[0]["w"], got[0]["h"]) == (pytest.approx(0.405), pytest.approx(0.3))


def test_components(spark):
    cells = spark.createDataFrame([(1, 0, 0, 5), (1, 2, 0, 5), (1, 9, 9, 5)], "page int, cx int, cy int, ink int")
    assert regions.bounds(regions.components(cells)).count() == 3
    joined = regions.bounds(regions.components(cells, regions.dilated(cells, 1, 0)))
    assert {(r["x0"], r["x1"], r["ink"]) for r in joined.collect()} == {(0, 2, 10), (9, 9, 5)}


def test_page_scan():
    import numpy as np

    gray = np.full((100, 100), 255, np.uint8)
    gray[10:20, 10:30] = 0
    gray[60:80, 60:80] = 0
    found = regions.page_regions(gray, [(0.55, 0.55, 0.9, 0.9)], 4, 3, 1, 1)
    assert len(found) == 1 and found[0][4] == 200


@pytest.mark.parametrize("cells, w, want", [(["some words"], 0.5, "text"), (["1", "2"], 0.2, "label"), (["1 + 2", "abcde"], 0.2, "pre"), (["abcde = 7"], 0.2, "pre"), (["1 - 2 abc"], 0.2, "text"), (["1", "= 2"], 0.2, "pre"), (["some words"], 0.45, "text"), (["abcde"], 0.2, "text")])
def test_row_kind(spark, cells, w, want):
    assert spark.createDataFrame([(cells, w)], "c array<string>, w double").select(boxes.row_kind(F.col("c"), F.col("w"))).first()[0] == want


def test_rounding_of_boxes(spark):
    b = boxes.box(F.lit(0.00025), F.lit(0.5), F.lit(0.1), F.lit(0.1))
    up, even = spark.range(1).select(boxes.padded(b, 0.0)["x"], boxes.padded(b, 0.0, half_even=True)["x"]).first()
    assert (up, even) == (0.0003, 0.0002)


def test_search_strict_then_loose(spark):
    book = spark.createDataFrame([("a", 1, "Đá bóng, two words", 1), ("a", 2, "twowords", 2), ("b", 1, "Quý máy", 3)], "path string, line_no int, text string, page int")
    strict = search.keyword_search(book, ["two words"]).collect()
    assert [(r["line_no"], r["loose"], r["at"]) for r in strict] == [(1, False, 9)]
    loose = search.keyword_search(book.filter("line_no = 2"), ["two  words"]).collect()
    assert [(r["line_no"], r["loose"]) for r in loose] == [(2, True)]
    assert search.keyword_search(book, ["qui"]).count() == 1 and search.keyword_search(book, [" "]).count() == 0
    assert search.page_view(book, 3).first()["text"] == "Quý máy"


def test_attribution_ties_fail(spark):
    text_ = spark.createDataFrame([(1, "same line here"), (2, "same line here"), (3, "other own words")], "page int, text string")
    edges = spark.createDataFrame([(2, "first", "same line here"), (3, "last", "other own words")], "page int, edge string, line string")
    assert {r["page"]: r["ok"] for r in audits.attribution(edges, text_, 1, 3).collect()} == {2: False, 3: True}


def test_dropped_and_other_pass(spark):
    lines = spark.createDataFrame([(1, "abcdefghijklmnop"), (1, "zyxwvutsrqponmlk")], "page int, line string")
    corpus = spark.createDataFrame([(1, "xxabcdefghijklmnopxx")], "page int, text string")
    second = spark.createDataFrame([(1, "..zyxwvutsrqponmlk..")], "page int, text string")
    assert [r["line"] for r in audits.dropped(lines, corpus).collect()] == ["zyxwvutsrqponmlk"]
    assert [r["line"] for r in audits.other_pass(lines, corpus, second).collect()] == ["zyxwvutsrqponmlk"]


def test_dropped_lines_of_every_document(spark, tmp_path):
    from foliospark.plans import queries

    whole = "one two three four five six seven eight nine ten"
    items = [(1, whole), (2, "nobody holds these few words")]
    docs = [(1, f"x {whole} y"), (2, "One two three four, and then quite another matter"), (3, f"{whole}.")]
    spark.createDataFrame(items, "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {(r["item_id"], r["page"]): r["cover"] for r in queries.dropped_lines(spark, str(tmp_path)).collect()}
    assert set(out) == {(1, 2), (2, None)} and out[2, None] == 0 and 0 < out[1, 2] < 0.8


def test_aligned_copies_of_a_whole_group(spark, tmp_path):
    import random
    from difflib import SequenceMatcher

    from foliospark.plans import queries

    r = random.Random(5)
    word = lambda: f"{r.choice('abcdefgh')}{r.randrange(10**6)}"
    base = [word() for _ in range(120)]
    edit = lambda at: " ".join(base[:at] + [word()] + base[at + 1 :])
    docs = [(1, " ".join(base)), (2, edit(0)), (3, edit(110)), (4, " ".join(base)), (5, " ".join(base + [word(), word()])), (6, "tiny text"), (7, "tiny text"), (8, " ".join(word() for _ in range(90))), (9, "Tiny, text"), (10, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))}
    words = {k: re.sub("[^a-z0-9]+", " ", t.lower()).split() for k, t in docs if t}
    want = {}
    for k in words:
        firsts = [j for j in words if j < k and 2 * len(grams(words[j]) & grams(words[k])) >= max(len(grams(words[j])), len(grams(words[k])))]
        if firsts:
            x, y = (dict(docs)[j].split() for j in (min(firsts), k))
            ops = [o for o in SequenceMatcher(None, x, y, autojunk=False).get_opcodes() if o[0] == "equal" or o[0] == "replace" and o[2] - o[1] == o[4] - o[3]]
            a, b = ("".join(words[j]) for j in (min(firsts), k))
            want[k] = (min(firsts), len(x), sum(o[2] - o[1] for o in ops), sum(o[2] - o[1] for o in ops if o[0] == "replace"), SequenceMatcher(None, a, b).ratio())
    assert set(want) == {2, 3, 4, 5, 7, 9}
    assert {r["other"]: (r["page"], r["words"], r["aligned"], r["changed"], r["likeness"]) for r in queries.aligned_copies(spark, str(tmp_path)).collect()} == want


def test_copies_of_a_text_made_of_earlier_ones(spark, tmp_path):
    from foliospark.plans import queries

    a, b = ([f"{c}{i}" for i in range(60)] for c in "ab")
    docs = [(1, a), (2, b), (5, a + b), (9, a + ["z"] + b)]  # all windows that 5 and 9 share stand in 1 or 2 first, of which 9 isn't a copy
    spark.createDataFrame([(k, " ".join(w)) for k, w in docs], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert [(r["page"], r["other"], r["words"], r["aligned"]) for r in queries.aligned_copies(spark, str(tmp_path)).collect()] == [(5, 9, 120, 120)]


def test_first_copies_against_all_pairs(spark, monkeypatch):
    import random

    from foliospark.operators import copies

    monkeypatch.setattr(copies, "HELD_GRAMS", 300)
    r = random.Random(3)
    runs = [[f"w{r.randrange(10**6)}" for _ in range(r.choice([8, 15, 30]))] for _ in range(12)]
    docs = []
    for k in r.sample(range(-500, 10**12, 10**7), 300):
        words = [w for run in r.choices(runs, [1 / (i + 1) for i in range(12)], k=r.choice([0, 1, 2, 3, 5])) for w in run]
        docs.append((k, ([f"own{k}x{i}" for i in range(r.choice([0, 0, 4, 20]))] + words)[: r.choice([3, 200])]))
    grams = {k: {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} for k, w in docs if w}
    want = {k: min((j for j in grams if j < k and 2 * len(grams[j] & grams[k]) >= max(len(grams[j]), len(grams[k]))), default=None) for k in grams}
    got = copies.first_copies(spark.createDataFrame([(k, " ".join(w)) for k, w in docs], "doc_id long, text string"), "doc_id", "text", 0)
    assert {x["doc_id"]: x["first"] for x in got.collect()} == {k: j for k, j in want.items() if j is not None}


def test_windows_move_in_packed_arrays():
    import pyarrow as pa

    from foliospark.operators import copies

    texts = pa.RecordBatch.from_pydict({"k": list(range(100)), "t": [" ".join(f"d{k}w{i}" for i in range(504)) for k in range(100)]})
    sent = [b for out in copies.spread(5, 16)([texts]) for c in out.columns[1:] for b in c.to_pylist()]
    assert sum(len(b.replace(b"\0", b"")) for b in sent) < 9 * 100 * 500  # of each window its hash; what else goes along is zeros
    rows = [r for out in copies.spread(5, 16)([texts]) for r in out.to_pylist()]
    batch = pa.RecordBatch.from_pylist([r for r in rows if r["at"] < 16])
    assert list(copies.repeated(16)([batch])) == []  # none is held by two texts, so none goes back


def test_blocks_are_those_of_difflib(monkeypatch):
    import random
    from difflib import SequenceMatcher

    import numpy as np

    from foliospark.functions import similarity

    monkeypatch.setattr(similarity, "AT_ONCE", 100)
    r = random.Random(4)
    for _ in range(400):
        letters = "abcdefghijklmnopqrstuvwxyz0123456789"[: r.choice([1, 2, 6, 36])]
        x = r.choices(letters, [r.random() ** 3 + 0.001 for _ in letters], k=r.choice([0, 1, 50, 199, 200, 500]))
        y = list(x)
        for _ in range(r.choice([0, 1, 5, 30])):
            at = r.randrange(len(y) + 1)
            y[at : at + r.randrange(9)] = r.choices(letters, k=r.randrange(9))
        for autojunk in (False, True):
            got = similarity.blocks(*(np.array([ord(c) for c in s], np.int64) for s in (x, y)), autojunk)
            joined = [(0, 0, 0)]
            for i, j, n in got:
                p, q, m = joined[-1]
                joined[-1:] = [(p, q, m + n)] if (p + m, q + m) == (i, j) and m else [(p, q, m), (i, j, n)]
            assert joined[1:] == [tuple(b) for b in SequenceMatcher(None, x, y, autojunk).get_matching_blocks()[:-1]]
        assert similarity.ratio("".join(x), "".join(y)) == SequenceMatcher(None, "".join(x), "".join(y)).ratio()
    for s in ("É Đà, Ünïcode ſ K\u0301x\x1cy\u2003z \u4e2d\u6587a", "plain ASCII 12"):
        assert similarity.unaccented(s) == s.lower().translate(similarity._FOLD)
    assert similarity.tokens("\u2003a\x1cb  c\u3000d\n") == ["a\x1cb", "c", "d"]


ROWS = "page int, row_no int, kind string, cells array<string>, x double, y double, h double, margin double, step double, title string"


def test_layout(spark):
    rows = [(1, 0, "text", ["First part,"], 0.1, 0.1, 0.01, 0.1, 0.02, None), (1, 1, "text", ["goes", "on"], 0.1, 0.12, 0.01, 0.1, 0.02, None), (1, 2, "text", ["New one"], 0.15, 0.14, 0.01, 0.1, 0.02, None), (2, 0, "text", ["and ends."], 0.1, 0.1, 0.01, 0.1, 0.02, None)]
    blocks = layout.paragraphs(spark.createDataFrame(rows, ROWS))
    assert [r["text"] for r in blocks.orderBy("page", "block_no").collect()] == ["First part, goes on", "New one", "and ends."]
    notes = spark.createDataFrame([], "page int, note string")
    got = layout.joined_pages(blocks.withColumn("no", F.lit("01")), notes, ["no"]).orderBy("para_no").collect()
    assert [(r["pages"], r["text"]) for r in got] == [([1], "First part, goes on"), ([1, 2], "New one and ends.")]


def test_layout_kinds(spark):
    line = lambda i, kind, text, y, x=0.1: (1, i, kind, text if isinstance(text, list) else [text], x, y, 0.02, 0.1, 0.025, "A Long Title")
    rows = [
        line(0, "text", "• ® A Long", 0.10), line(1, "text", "Title", 0.125), line(2, "text", "Prose that", 0.15), line(3, "text", "goes on", 0.175),
        line(4, "text", "centred line", 0.20, 0.4), line(5, "text", "back at the margin", 0.225), line(6, "text", "• a point", 0.25), line(7, "label", ["ab", "cd"], 0.50),
        line(8, "label", ["e"], 0.52), line(9, "pre", ["1", "2"], 0.54), line(10, "pre", ["3", "4"], 0.56), line(11, "text", "A long title", 0.58), line(12, "text", "left of it", 0.60, 0.05),
    ]
    got = [(r["kind"], r["text"], r["indented"], r["labels"]) for r in layout.paragraphs(spark.createDataFrame(rows, ROWS)).orderBy("block_no").collect()]
    assert got == [
        ("heading", "A Long Title", False, []), ("text", "Prose that goes on", False, []), ("text", "centred line", True, []), ("text", "back at the margin", False, []),
        ("text", "- a point", True, []), ("figure", "", False, ["ab", "cd", "e"]), ("pre", "1    2\n3    4", False, []), ("text", "A long title left of it", False, []),
    ]


def test_furniture_and_doubt(spark):
    rows = [("www. SiteMark .org", 0.5), ("visit sitemark now", 0.5), ("THE RUNNING HEAD", 0.05), ("The Running Head", 0.5), ("- 12 -", 0.95), ("12", 0.5), (None, 0.5)]
    t = spark.createDataFrame(rows, "t string, y double")
    got = t.select(furniture.is_furniture(F.col("t"), F.col("y"), "sitemark.org", ("sitemarkn",), ("The running head",)).alias("f"), furniture.page_number(F.col("t"), F.col("y")).alias("n"))
    assert [tuple(r) for r in got.collect()] == [(True, None), (True, None), (True, None), (False, None), (True, 12), (False, None), (False, None)]
    t = spark.createDataFrame([("a", 0.79), ("b", 0.8), ("c", None)], "t string, c double").select(text.doubted(F.col("t"), F.col("c")).alias("t"))
    assert [r["t"] for r in t.collect()] == ["a [?]", "b", "c"]
    marks = spark.createDataFrame([("e\ufe20a\ufe0f", "• ◦ [?] Title", "· x")], "a string, b string, c string").select(text.fold(F.col("a")), text.bare_title(F.col("b")), text.listed(F.col("c")))
    assert tuple(marks.first()) == ("ea", "Title", "- x")


def test_edge_lines(spark):
    lines = [(1, 1, "short"), (1, 2, " First line of some length, " + "x" * 90), (1, 3, "middle line of it"), (1, 4, "y" * 90 + " The very last line"), (1, 5, "12"), (2, 1, "no")]
    got = {(r["page"], r["edge"]): r["line"] for r in audits.edge_lines(spark.createDataFrame(lines, "page int, line_no int, text string")).collect()}
    assert got == {(1, "first"): ("firstlineofsomelength" + "x" * 90)[:50], (1, "last"): "y" * 35 + "theverylastline"}


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "01-a.md").write_text("head\n<!-- pdf:5 | sach:3 -->\none\n")
    (tmp_path / "_x.md").write_text("no")
    (tmp_path / "00-muc-luc.md").write_text("no")
    lines = readers.corpus_lines(spark, str(tmp_path / "*.md"), seed=True).orderBy("line_no").collect()
    assert [(r["path"], r["line_no"], r["page"]) for r in lines] == [("01-a.md", 1, 5), ("01-a.md", 2, 5), ("01-a.md", 3, 5)]
    (tmp_path / "p.json").write_text('{"page":3,"width":8,"height":9,"lines":[{"text":" a ","conf":0.9,"x":0.1,"y":0.2,"w":0.6,"h":0.02},{"text":" ","conf":1,"x":0,"y":0,"w":0,"h":0}]}')
    assert [r["text"] for r in readers.ocr_lines(spark, str(tmp_path / "p.json")).collect()] == ["a"]
    (tmp_path / "n.json").write_text('{"7": "note"}')
    assert readers.json_map(spark, str(tmp_path / "n.json"), "string", "note").first()["page"] == 7
    (tmp_path / "q.tsv").write_text("# c\n1\ta + b\n\n2\tc\td\n")
    assert [(r["row"], len(r["cells"])) for r in readers.tsv(spark, str(tmp_path / "q.tsv")).orderBy("row").collect()] == [(2, 2), (4, 3)]
    texts = sinks.chapter_texts(spark.createDataFrame([("01", 2, 0, "b"), ("01", 1, 0, "a")], "no string, page int, block_no int, md string"))
    assert texts.first()["text"] == "a\n\nb"
    sinks.write_chapters(texts, str(tmp_path / "out"))
    report = spark.createDataFrame([("# r\n## a\nold\n## b\nx\n",)], "t string").select(sinks.replaced_section(F.col("t"), "a", F.lit("new")).alias("r")).first()["r"]
    assert report == "# r\n## a\nnew\n## b\nx\n"


def test_entry_imports_without_the_training_operators():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_syllables(spark):
    good = ["nghiêng", "Đường", "quý", "gì", "tách", "Thuở", "a\u0323\u0302m", "khuya"]
    bad = ["tàch", "đừờng", "straße", "bcé", "làp", "ô\u0301\u0300", "éclair"]
    df = spark.createDataFrame([(w,) for w in good + bad] + [(None,)], "w string")
    got = [r["ok"] for r in df.select(syllables.valid_syllable(F.col("w")).alias("ok")).collect()]
    assert got == [True] * len(good) + [False] * len(bad) + [None]
    assert one(spark, "Đường straße plain, làp x", syllables.suspicious_words, "string") == ["straße", "làp"]


def test_sections_and_preview(spark):
    rows = spark.createDataFrame([("B", 2, "b|c", None), ("A", 1, "a", "n"), ("B", 1, "b", "m")], "letter string, k int, term string, note string")
    out = {r["letter"]: r["text"] for r in sinks.table_sections(rows, "letter", ["k"], {"term": "Term", "note": "Note"}).collect()}
    assert out["A"] == "## A\n\n| Term | Note |\n|---|---|\n| a | n |" and out["B"].split("\n")[4].startswith("| b | m")
    figs = spark.createDataFrame([("01", "A & B", 3, 1, "<s>", "f.jpg"), ("01", "A & B", 2, 1, None, "g.jpg")], "no string, chapter string, page int, k int, section string, file string")
    html = sinks.figure_preview(figs).first()["html"]
    assert "A &amp; B" in html and "&lt;s&gt;" in html and html.index("g.jpg") < html.index("f.jpg")


def test_missing_pages_and_commands(spark, tmp_path):
    for n in (1, 3):
        (tmp_path / f"page-{n:03d}.json").write_text("[]")
    assert sorted(r["page"] for r in readers.missing_pages(spark, 1, 4, str(tmp_path)).collect()) == [2, 4]
    calls = spark.createDataFrame([(1, ['[{"x": 1}, {"x": 2}]']), (2, ["[]"])], "id int, args array<string>")
    assert [tuple(r) for r in readers.command_rows(calls, "args", ["printf", "%s"], "x int").select("id", "x").collect()] == [(1, 1), (1, 2)]


def test_bench_runs_every_query(spark, monkeypatch, capsys):
    import json

    import __spark_entry__
    import bench

    monkeypatch.setattr(__spark_entry__, "queries", lambda: {n: lambda s, _: s.range(1) for n in ("op7_sharding", "pipeline")})
    bench.main()
    assert set(json.loads(capsys.readouterr().out.splitlines()[-1])["queries"]) == {"op7_sharding", "pipeline"}
