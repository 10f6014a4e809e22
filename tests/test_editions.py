"""Region fixes, figure and ink audits, reports and lookups, on small made-up pages."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.functions import text
from foliospark.operators import audits, joins, layout, order, regions
from foliospark.sources import readers, sinks

BOXED = "page int, line_no int, text string, x double, y double, w double, h double"
CHAPTERS = "no string, slug string, label string, title string, first int, last int, sections array<struct<title:string,page:int>>"


def chapters(spark):
    return spark.createDataFrame([("01", "one", "C 1", "One", 1, 9, [("a", 2), ("b", 4), ("c", 4)]), ("02", "two", None, "Two", 10, 20, [])], CHAPTERS)


def test_fixes_apply_one_after_the_other(spark):
    lines = spark.createDataFrame([(1, 0, "old", 0.1, 0.1, 0.1, 0.1), (2, 0, "other", 0.1, 0.1, 0.1, 0.1)], BOXED)
    line = lambda t, y: (t, 0.9, 0.1, y, 0.1, 0.1)
    rows = [(1, 0, (0.1, 0.1, 0.2, 0.2), [line("first", 0.5)]), (1, 1, (0.1, 0.5, 0.2, 0.2), [line("second", 0.1)])]
    fixes = spark.createDataFrame(rows, "page int, fix_no int, replace struct<x:double,y:double,w:double,h:double>, lines array<struct<text:string,conf:double,x:double,y:double,w:double,h:double>>")
    assert {(r["page"], r["text"]) for r in joins.with_fixes(lines, fixes).collect()} == {(1, "second"), (2, "other")}


def test_planned_fixes(spark):
    got = "array<struct<text:string,conf:double,x:double,y:double,w:double,h:double>>"
    specs = spark.createDataFrame([(1, 0, "dropcap", None), (1, 1, "block", [0.1, 0.2, 0.3, 0.4])], "page int, fix_no int, kind string, box array<double>")
    two = [("a", 0.91234, 0.2, 0.1, 0.5, 0.02), ("b", 0.9, 0.25, 0.14, 0.6, 0.02)]
    read = spark.createDataFrame([(1, 0, [0.1, 0.1, 0.05, 0.06], two), (1, 1, None, two[::-1])], f"page int, fix_no int, cap array<double>, lines {got}")
    cap, block = regions.planned(specs, read).orderBy("fix_no").collect()
    assert cap["replace"] == pytest.approx([0.09, 0.092, 0.88, 0.074])
    assert [(s["x"], s["w"]) for s in cap["lines"]] == [(0.25, pytest.approx(0.6))] * 2 and cap["lines"][0]["conf"] == 0.912
    assert block["replace"] == [0.1, 0.2, 0.3, 0.4] and [s["text"] for s in block["lines"]] == ["a", "b"] and block["cap"] is None
    with pytest.raises(Exception, match="needs 2 lines"):
        regions.planned(specs.filter("fix_no = 0"), read.withColumn("lines", F.slice("lines", 1, 1))).collect()


def image(dark):
    gray = np.full((600, 600), 255, np.uint8)
    for y0, y1, x0, x1 in dark:
        gray[y0:y1, x0:x1] = 0
    return bytearray(gray.tobytes())


def test_figures_from_page_to_file(spark):
    pages = [(1, 600, 600, image([(120, 240, 120, 300), (400, 420, 60, 540), (10, 30, 10, 500)])), (2, 600, 600, image([(300, 330, 150, 210)])), (3, 600, 600, image([]))]
    images = spark.createDataFrame(pages, "page int, width int, height int, data binary")
    body = (1, 0, "a body line", 0.1, 0.66, 0.8, 0.05)
    label = (2, 0, "label", 0.25, 0.5, 0.1, 0.05)  # all ink of page 2 is the label's
    found = regions.detected(images, spark.createDataFrame([body, label], BOXED))
    (only,) = found.collect()
    assert only["page"] == 1 and np.allclose(only["boxes"], [[0.188, 0.188, 0.324, 0.224]], atol=0.011)
    more = spark.createDataFrame([(12, [[0.1, 0.1, 0.2, 0.2], [0.5, 0.5, 0.1, 0.1]])], "page int, boxes array<array<double>>")
    made = regions.figure_table(found, spark.createDataFrame([(5,)], "page int"), more, chapters(spark))
    assert [tuple(r) for r in made.orderBy("page", "k").select("page", "k", "chapter", "section", "file").collect()] == [(1, 1, "C 1: One", "One", "01/p001-1.jpg"), (12, 1, "Two", "Two", "02/p012-1.jpg"), (12, 2, "Two", "Two", "02/p012-2.jpg")]
    assert tuple(audits.box_totals(made).first()) == (2, 3) and audits.figure_pages(made).first()["pages"] == [1, 12]
    got = joins.figures_on(spark.createDataFrame([(12,), (13,)], "page int"), made).orderBy("page").collect()
    assert [r["files"] for r in got] == ["02/p012-1.jpg, 02/p012-2.jpg", "none"]


def test_label_share():
    assert regions.in_labels([(0, 0, 5), (10, 10, 5)], [(0.0, 0.0, 0.1, 0.1)], 6, 600, 600) == 0.5


def test_unexplained_ink(spark):
    images = spark.createDataFrame([(1, 600, 600, image([(120, 240, 120, 300), (300, 312, 60, 200), (400, 412, 60, 200), (5, 20, 5, 300)]))], "page int, width int, height int, data binary")
    lines = spark.createDataFrame([(1, 0, "read", 0.1, 0.5, 0.24, 0.02)], BOXED)
    none = spark.createDataFrame([], "page int, x double, y double, w double, h double")
    found = regions.unexplained(images, lines, none).orderBy("box.y").collect()
    assert [(r["kind"], r["box"]["y"], r["ink"]) for r in found] == [("dark", 0.2, 1.0), ("dark", pytest.approx(0.6667), 1.0)]
    figure = spark.createDataFrame([(1, 0.2, 0.2, 0.3, 0.2)], "page int, x double, y double, w double, h double")
    assert regions.unexplained(images, lines, figure).count() == 1


def test_margins_and_page_texts(spark):
    lines = spark.createDataFrame([(1, 0.3, 0.5), (1, 0.1, 0.5), (1, 0.01, 0.1), (2, 0.4, 0.1), (2, None, 0.1)], "page int, x double, w double")
    got = layout.body_margin(spark.range(1, 4).selectExpr("cast(id AS int) AS page"), lines, 0.2).orderBy("page").collect()
    assert [r["margin"] for r in got] == [0.1, 0.4, 0.1]
    rows = spark.createDataFrame([(1, 2, "B c", 0.5, 0.4), (1, 1, "Á", 0.9, 0.1)], "page int, line_no int, text string, conf double, x double")
    assert layout.page_text(rows).first()["text"] == "abc"
    assert tuple(layout.region_text(rows, ["page"]).first()) == (1, "Á B c", 0.5)
    bands = spark.createDataFrame([(1, 0, 5), (1, 20, 30), (1, 80, 10), (1, 95, 12)], "page int, start int, rows int")
    assert [r["start"] for r in order.first_bands(bands, ["page"], F.lit(1000)).orderBy("start").collect()] == [20, 80]


def test_headings_overrides_and_names(spark):
    assert {tuple(r) for r in joins.headings(chapters(spark)).collect()} == {("01", 2, "a"), ("01", 4, "c")}
    q = "row int, queries array<array<string>>"
    own = spark.createDataFrame([(1, [["a"]]), (2, [["b"]]), (3, [["c"]])], q)
    got = joins.overridden(own, spark.createDataFrame([(1, [["x", "y"]]), (2, [])], q)).orderBy("row").collect()
    assert [(r["queries"], r["override"]) for r in got] == [([["x", "y"]], True), ([["b"]], False), ([["c"]], False)]
    assert readers.only(own, "row", []).count() == 3 and readers.only(own, "row", [2]).count() == 1
    assert chapters(spark).select(text.chapter_file(F.col("no"), F.col("slug"))).first()[0] == "01-one.md"


def test_spots_and_words_near(spark):
    paragraphs = spark.createDataFrame([([3], " one two "), ([3, 4], " of the onetwo "), ([7], " two la one ")], "pages array<int>, text string")
    asked = spark.createDataFrame([(1, 3, ["one two"]), (2, 4, ["one two"]), (3, 5, ["one two"])], "row int, page int, parts array<string>")
    got = audits.spots(asked, paragraphs).orderBy("row").collect()
    assert [(r["strict"], r["loose"], r["shown"]) for r in got] == [(True, True, [3]), (False, True, [3]), (False, False, [3])]
    concepts = spark.createDataFrame([(1, [6, 7], [["two la", "one"]]), (2, [3], [["two la three"]]), (3, [3], [["la"]]), (4, [3], [])], "row int, near array<int>, queries array<array<string>>")
    assert [r["words_near"] for r in audits.words_near(concepts, paragraphs).orderBy("row").collect()] == [True, False, False, False]


def test_report_numbers(spark):
    pages = spark.createDataFrame([(1, 10, 1), (2, 30, None), (3, 0, 8)], "page int, lines int, printed int")
    marks = lambda *p: spark.createDataFrame([(x,) for x in p], "page int")
    assert audits.totals(pages, marks(1, 2), marks(), marks(2)).first().asDict() == {"lines": 40, "pages": 3, "unsure": 2, "voted": 0, "low": 1, "low_share": 0.025}
    assert audits.totals(pages.limit(0), marks(), marks(), marks()).first()["low_share"] == 0.0
    assert [tuple(r) for r in audits.problem_pages(marks(3, 1), marks(3), marks(2)).collect()] == [(3, 2), (1, 1), (2, 1)]
    assert {(r["page"], r["problem"]) for r in audits.mismatches(pages).collect()} == {(2, "unread"), (3, "differs")}


def test_contents_and_report(spark):
    made = sinks.contents(chapters(spark), "T", ("A", "B", "C", "D"), "Sections").first()["text"]
    assert made.split("\n")[4:6] == ["| C 1 | One | [01-one.md](01-one.md) | 1–9 |", "| — | Two | [02-two.md](02-two.md) | 10–20 |"]
    assert made.endswith("## Sections\n\n**C 1: One** (p. 1)\n\n- a — p. 2\n- b — p. 4\n- c — p. 4\n")
    rows = spark.createDataFrame([([2.0], "- two"), ([1.0], "- one")], "at array<double>, line string")
    parts = [("Few", "", rows), ("None", "", rows.limit(0)), ("Table", "| a |\n|---|", rows.limit(0))]
    assert sinks.assembled("R", parts).first()["text"] == "# R\n\n## Few\n\n- one\n- two\n\n## None\n\n- (none)\n\n## Table\n\n| a |\n|---|\n"


def test_files_of_pages(spark, tmp_path):
    for name in ("p012-1.jpg", "p012-2.jpg", "p007.jpg", "cover.jpg"):
        (tmp_path / name).write_bytes(b"x")
    assert {tuple(r) for r in readers.page_files(spark, str(tmp_path)).collect()} == {(12, "p012-1.jpg"), (12, "p012-2.jpg"), (7, "p007.jpg")}
    (tmp_path / "ocr.json").write_text('{"page": 1, "lines": [{"text": " a ", "conf": 0.9, "x": 0.1, "y": 0.1, "w": 0.1, "h": 0.1}]}')
    assert readers.pass_lines(spark, str(tmp_path / "ocr.json")).first()["text"] == "a"
