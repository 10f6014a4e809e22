"""Page layout: margins, line steps, paragraphs and chapters."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import plain, ratio_of
from ..functions.text import BULLET, TITLE_JUNK, norm


def lower_quartile(df: DataFrame, by: list[str], value: str, out: str) -> DataFrame:
    """The sorted value at index n // 4 of those that are not null, without interpolation. Values are counted before the shuffle, so a group is never held in one row."""
    each = df.groupBy(*by, F.col(value).alias("_v")).agg(F.count(value).alias("_n"))
    w = Window.partitionBy(*by)
    upto = each.withColumn("_upto", F.sum("_n").over(w.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))).withColumn("_all", F.sum("_n").over(w))
    return upto.groupBy(*by).agg(F.min(F.when(F.col("_upto") > F.floor(F.col("_all") / 4), F.col("_v"))).alias(out))


def body_margin(pages: DataFrame, lines: DataFrame, short: float, default: float = 0.1) -> DataFrame:
    """Pages with ``margin``: the lower quartile of x of the lines (page, x, w) wider than ``short``, else of all the page's lines, else the default."""
    wide = lower_quartile(lines.filter(F.col("w") > short), ["page"], "x", "_wide")
    every = lower_quartile(lines, ["page"], "x", "_every")
    return pages.join(wide, "page", "left").join(every, "page", "left").withColumn("margin", F.coalesce("_wide", "_every", F.lit(default))).drop("_wide", "_every")


def page_text(lines: DataFrame) -> DataFrame:
    """(page, text): all lines of a page in their order, joined by spaces, in normal form."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda s: s["text"])
    return lines.groupBy("page").agg(norm(F.array_join(parts, " ")).alias("text"))


def region_text(seen: DataFrame, by: list[str]) -> DataFrame:
    """(by, text, conf): a region's readings (x, text, conf) from left to right, with the least confidence, 0 if none."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("x", "text"))), lambda s: s["text"])
    return seen.groupBy(*by).agg(F.array_join(parts, " ").alias("text"), F.coalesce(F.min("conf"), F.lit(0.0)).alias("conf"))


def line_step(df: DataFrame, by: list[str], y: str, low: float, high: float, default: float, out: str = "step") -> DataFrame:
    """Median of the gaps between consecutive rows that lie strictly between low and high, else the default."""
    gap = F.col(y) - F.lag(y).over(Window.partitionBy(*by).orderBy(y))
    g = df.withColumn("_g", gap)
    inside = (F.col("_g") > low) & (F.col("_g") < high)
    return g.groupBy(*by).agg(F.coalesce(F.median(F.when(inside, F.col("_g"))), F.lit(default)).alias(out))


def paragraphs(rows: DataFrame, indent: float = 0.035, shift: float = 0.015, centred: float = 0.15, wide_gap: float = 1.7, figure_gap: float = 0.12, alike: float = 0.8) -> DataFrame:
    """(page, block_no, kind, text, indented, labels) from layout rows (page, row_no, kind, cells, x, y, h, margin, step, title).

    Blocks are text, pre, heading or figure. A gap over ``figure_gap`` below the row before and label rows make a
    figure, or add to the open one. A row, or two rows, alike to the page's section title (null: none) are its heading,
    once. Text opens a block after another kind, with a bullet, indented or under a centred row where it starts at
    another x than the row before, or after a wide gap. Blocks depend on rows before them, so a page is one group.
    """

    def run(p: pd.DataFrame) -> pd.DataFrame:
        page = p.sort_values("row_no").to_dict("records")
        bare = [re.sub(TITLE_JUNK, "", " ".join(r["cells"])) for r in page]
        title, out, before, taken = page[0]["title"], [], None, -1

        def put(kind: str, text: str, indented: bool = False) -> None:
            out.append([page[0]["page"], len(out), kind, text, indented, []])

        def figure() -> None:
            if not out or out[-1][2] != "figure":
                put("figure", "")

        def heading(i: int) -> int:
            """How many rows from i on are the title."""
            if not isinstance(title, str) or not title:
                return 0
            if ratio_of(bare[i], title) > alike:
                return 1
            start = plain(bare[i])[:10]
            whole = " ".join([bare[i], *page[i + 1]["cells"]]) if i + 1 < len(page) else ""
            return 2 if whole and start and plain(title).startswith(start) and ratio_of(whole, title) > alike else 0

        for i, r in enumerate(page):
            if i <= taken:
                continue
            if before is not None and r["y"] - before["y"] - before["h"] > figure_gap:
                figure()
            text, kind, n = " ".join(r["cells"]), r["kind"], heading(i)
            if n:
                put("heading", bare[i] if n == 1 else " ".join([bare[i], *page[i + 1]["cells"]]))
                title, taken = None, i + n - 1
            elif kind == "label":
                figure()
                out[-1][5] += list(r["cells"])
            elif kind == "pre":
                line = "    ".join(r["cells"])
                if out and out[-1][2] == "pre" and before is not None and before["kind"] == "pre":
                    out[-1][3] += "\n" + line
                else:
                    put("pre", line)
            else:
                bullet = re.match(BULLET, text)
                inset = r["x"] - r["margin"] > indent
                moved = before is None or abs(r["x"] - before["x"]) > shift
                goes_on = out and out[-1][2] == "text" and before is not None and before["kind"] == "text" and not bullet
                goes_on = goes_on and not (moved and (inset or before["x"] - r["margin"] > centred)) and r["y"] - before["y"] <= wide_gap * r["step"]
                if goes_on:
                    out[-1][3] += " " + text
                else:
                    put("text", re.sub(BULLET, "- ", text), inset or bool(bullet))
            before = r
        return pd.DataFrame(out, columns=["page", "block_no", "kind", "text", "indented", "labels"])

    return rows.groupBy("page").applyInPandas(run, "page int, block_no int, kind string, text string, indented boolean, labels array<string>")


def joined_pages(blocks: DataFrame, notes: DataFrame, by: list[str]) -> DataFrame:
    """Paragraphs that run over page breaks: (by, para_no, pages, kind, text).

    A page's first block continues the open paragraph if both are text, it is not indented, its page has no note
    and the open one does not end in closing punctuation. Flags and a running sum give the paragraph; a chapter is
    a partition.
    """
    w = Window.partitionBy(*by).orderBy("page", "block_no")
    b = blocks.join(notes.select("page", F.lit(True).alias("_note")), "page", "left")
    goes_on = (F.col("block_no") == 0) & (F.col("kind") == "text") & (F.lag("kind").over(w) == "text") & ~F.col("indented") & F.col("_note").isNull() & ~F.lag("text").over(w).rlike(r"[.!?:…”\"»]\s*$")
    b = b.withColumn("para_no", F.sum(F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.array_sort(F.collect_list(F.struct("page", "block_no", "text")))
    return b.groupBy(*by, "para_no").agg(F.first("kind").alias("kind"), F.array_sort(F.collect_set("page")).alias("pages"), F.array_join(F.transform(parts, lambda p: p["text"]), " ").alias("text"))


def rendered(kind, text, page, labels):
    """Markdown of a block: prose as it is, preformatted rows in a fence, a figure as a quoted placeholder with its labels."""
    names = F.when(F.size(labels) > 0, F.concat(F.lit(": "), F.array_join(labels, "; "))).otherwise("")
    return F.when(kind == "pre", F.concat(F.lit("```text\n"), text, F.lit("\n```"))).when(kind == "figure", F.concat(F.lit("> [figure, page "), page.cast("string"), F.lit("]"), names)).when(kind == "heading", F.concat(F.lit("## "), text)).otherwise(text)
