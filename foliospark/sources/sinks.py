"""Sinks: chapter texts, tables of contents, reports and JSON maps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import cell, chapter_file, chapter_name, html_escape


def chapter_texts(blocks: DataFrame) -> DataFrame:
    """(no, text): blocks (no, page, block_no, md) joined by blank lines in order."""
    parts = F.array_sort(F.collect_list(F.struct("page", "block_no", "md")))
    return blocks.groupBy("no").agg(F.array_join(F.transform(parts, lambda p: p["md"]), "\n\n").alias("text"))


def write_chapters(texts: DataFrame, path: str) -> None:
    texts.select("no", F.col("text").alias("value")).repartition("no").write.mode("overwrite").partitionBy("no").text(path)


def markdown_rows(df: DataFrame, *cols: str) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(cell(F.col(c).cast("string")), F.lit("")) for c in cols]), F.lit(" |"))


def contents(chapters: DataFrame, title: str, headings: tuple[str, str, str, str], sections: str, page: str = "p.") -> DataFrame:
    """One text: a table of the chapters (no, slug, label, title, first, last, sections), then the sections of each labelled chapter that has some."""
    file = chapter_file(F.col("no"), F.col("slug"))
    row = F.concat(F.lit("| "), F.coalesce("label", F.lit("—")), F.lit(" | "), F.col("title"), F.lit(" | ["), file, F.lit("]("), file, F.format_string(") | %d–%d |", "first", "last"))
    items = F.transform("sections", lambda s: F.format_string(f"- %s — {page} %d", s["title"], s["page"]))
    own = F.concat(F.lit("**"), chapter_name(F.col("label"), F.col("title")), F.format_string(f"** ({page} %d)\n\n", "first"), F.array_join(items, "\n"), F.lit("\n"))
    one = F.struct("first", "no", row.alias("row"), F.when(F.col("label").isNotNull() & (F.size("sections") > 0), own).alias("own"))
    all_rows = F.array_sort(F.collect_list(one))  # one row for each chapter
    table = F.array_join(F.transform(all_rows, lambda r: r["row"]), "\n")
    rest = F.array_join(F.filter(F.transform(all_rows, lambda r: r["own"]), lambda t: t.isNotNull()), "\n")
    return chapters.agg(F.concat(F.lit(f"# {title}\n\n| {' | '.join(headings)} |\n|---|---|---|---|\n"), table, F.lit(f"\n\n## {sections}\n\n"), rest).alias("text"))


def assembled(title: str, sections: list[tuple[str, str, DataFrame]], none: str = "- (none)") -> DataFrame:
    """One text: under the title a section for each (heading, table head, rows) with its rows (at, line) in the order of ``at``, or ``none``; a table head without rows stands alone. ``at`` is an array of doubles."""
    spark = sections[0][2].sparkSession
    heads = spark.createDataFrame([(i, h, t) for i, (h, t, _) in enumerate(sections)], "i int, heading string, head string")
    rows = reduce(DataFrame.unionByName, [df.select(F.lit(i).alias("i"), F.col("at").cast("array<double>").alias("at"), "line") for i, (_, _, df) in enumerate(sections)])
    body = rows.groupBy("i").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda r: r["line"]), "\n").alias("body"))
    empty = F.when(F.col("head") == "", F.lit(none))
    text = F.concat(F.lit("## "), "heading", F.lit("\n\n"), F.concat_ws("\n", F.when(F.col("head") != "", F.col("head")), F.coalesce("body", empty)))
    made = heads.join(body, "i", "left").select("i", text.alias("t"))
    return made.agg(F.concat(F.lit(f"# {title}\n\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "t"))), lambda r: r["t"]), "\n\n"), F.lit("\n")).alias("text"))


def replaced_section(report: Column, title: str, section: Column) -> Column:
    """The report with one ``## title`` section replaced, or put before the first other section, or at the end."""
    own = rf"(?s)## {title}\n.*?(?=\n## |\z)"
    new = F.concat(F.lit(f"## {title}\n"), section)
    there = report.rlike(own)
    parts = F.split(report, r"(?m)(?=^## )", 2)
    before = F.when(F.size(parts) > 1, F.concat(parts[0], new, F.lit("\n"), parts[1])).otherwise(F.concat(report, F.lit("\n"), new))
    safe = F.regexp_replace(new, r"([\\$])", r"\\\\$1")
    return F.when(there, F.regexp_replace(report, F.lit(own), safe)).otherwise(before)


def box_map(boxes: DataFrame) -> DataFrame:
    """One JSON object: page to its boxes in order. A row for each figure page."""
    per = boxes.groupBy("page").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "x", "y", "w", "h"))), lambda b: F.array(b["x"], b["y"], b["w"], b["h"])).alias("boxes"))
    return per.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.format_string("%03d", "page"), "boxes"))))).alias("json"))


def table_sections(rows: DataFrame, group: str, order: list[str], cols: dict[str, str]) -> DataFrame:
    """(group, text): a Markdown heading and table for each group; ``cols`` maps columns to headings. Serves the concept index (by first letter) and the figure list (by chapter)."""
    head = f"| {' | '.join(cols.values())} |\n|{'---|' * len(cols)}"
    lines = F.transform(F.array_sort(F.collect_list(F.struct(*order, markdown_rows(rows, *cols).alias("md")))), lambda r: r["md"])
    return rows.groupBy(group).agg(F.concat_ws("\n", F.concat(F.lit("## "), F.first(group).cast("string"), F.lit("\n")), F.lit(head), lines).alias("text"))


def figure_preview(figures: DataFrame) -> DataFrame:
    """(no, html): a section of escaped figures for each chapter, from (no, chapter, page, k, section, file)."""
    e = lambda c: html_escape(F.col(c).cast("string"))
    one = F.concat(F.lit('<figure><img loading="lazy" src="'), e("file"), F.lit('"><figcaption>'), e("page"), F.lit(" "), F.coalesce(e("section"), F.lit("")), F.lit("</figcaption></figure>"))
    made = figures.select("no", e("chapter").alias("title"), F.struct("page", "k", one.alias("html")).alias("f"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list("f")), lambda f: f["html"]), "\n")
    return made.groupBy("no").agg(F.concat(F.lit("<section><h2>"), F.first("title"), F.lit("</h2>\n"), body, F.lit("\n</section>")).alias("html"))
