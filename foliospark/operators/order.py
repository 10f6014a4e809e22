"""Order-dependent operators: markers carried forward, gaps, islands, reading order, ranks and chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def carried(df: DataFrame, marker: str, by: list[str], order: list[str], out: str, seed: bool = False) -> DataFrame:
    """``out``: the last marker at or before each row; with ``seed`` rows before the first marker take that one."""
    w = Window.partitionBy(*by).orderBy(*order)
    last = F.last(marker, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    if seed:
        last = F.coalesce(last, F.first(marker, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return df.withColumn(out, last)


def crossing(lines: DataFrame, by: list[str], order: str) -> DataFrame:
    """(by, pages, text): every paragraph, and the join of two neighbours that a page break parts. A blank line between them, a row without text, keeps them apart. Marker rows are not in ``lines``."""
    w = Window.partitionBy(*by).orderBy(order)
    t = lines.withColumn("before", F.lag("text").over(w)).withColumn("page_before", F.lag("page").over(w))
    real = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) != ""
    single = lines.filter(real("text")).select(*by, F.array("page").alias("pages"), "text")
    joined = t.filter(real("text") & real("before") & (F.col("page") != F.col("page_before"))).select(*by, F.array("page_before", "page").alias("pages"), F.concat_ws(" ", "before", "text").alias("text"))
    return single.unionByName(joined)


def not_rising(df: DataFrame, value: str, by: list[str], order: list[str]) -> DataFrame:
    """Consecutive rows whose value does not rise: (by, before, value)."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("before", F.lag(value).over(w)).filter(F.col(value) <= F.col("before")).select(*by, "before", value)


def reading_rows(lines: DataFrame, by: list[str]) -> DataFrame:
    """Adds ``row_no`` and ``cell_no``: lines by vertical centre; a new row starts where the centre is further from the row's first line than half the larger height."""
    item = F.struct((F.col("y") + F.col("h") / 2).alias("c"), F.col("x"), F.col("h"), F.col("line_no"))
    g = lines.groupBy(*by).agg(F.array_sort(F.collect_list(item)).alias("l"))
    fold = """aggregate(l, struct(cast(-1 AS int) AS r, cast(0 AS double) AS c, cast(0 AS double) AS h, cast(array() AS array<struct<line_no:int,x:double,r:int>>) AS o),
      (a, e) -> IF(a.r >= 0 AND abs(e.c - a.c) <= 0.5 * greatest(a.h, e.h),
        struct(a.r AS r, a.c AS c, a.h AS h, concat(a.o, array(struct(e.line_no AS line_no, e.x AS x, a.r AS r))) AS o),
        struct(a.r + 1 AS r, e.c AS c, e.h AS h, concat(a.o, array(struct(e.line_no AS line_no, e.x AS x, a.r + 1 AS r))) AS o))).o"""
    rows = g.select(*by, F.explode(F.expr(fold)).alias("e")).select(*by, "e.line_no", F.col("e.r").alias("row_no"), F.col("e.x").alias("_x"))
    rows = rows.withColumn("cell_no", F.row_number().over(Window.partitionBy(*by, "row_no").orderBy("_x", "line_no")) - 1).drop("_x")
    return lines.join(rows, [*by, "line_no"])


def bands(ink: DataFrame, by: list[str], height: Column, least_ink: int = 3, gap: float = 0.003, least: float = 0.008) -> DataFrame:
    """Gaps and islands over pixel rows (by, y, ink, height): bands (start, rows) of rows with more than ``least_ink``; blank runs up to ``gap`` of the height stay inside, bands up to ``least`` are dropped unless they reach the last row."""
    w = Window.partitionBy(*by).orderBy("y")
    on = ink.withColumn("last", F.max("y").over(Window.partitionBy(*by))).filter(F.col("ink") > least_ink)
    on = on.withColumn("new", F.coalesce((F.col("y") - F.lag("y").over(w) - 1 > gap * height), F.lit(True)).cast("int"))
    on = on.withColumn("island", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    got = on.groupBy(*by, "island").agg(F.min("y").alias("start"), F.max("y").alias("end"), F.first("last").alias("last"), F.first(height).alias("_h"))
    return got.filter((F.col("end") - F.col("start") + 1 > least * F.col("_h")) | (F.col("end") == F.col("last"))).select(*by, "start", (F.col("end") - F.col("start") + 1).alias("rows"))


def first_bands(found: DataFrame, by: list[str], height: Column, least: float = 0.01, n: int = 2) -> DataFrame:
    """The first n bands (by, start, rows) of at least ``least`` of the height."""
    tall = found.filter(F.col("rows") >= least * height)
    return tall.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy("start"))).filter(F.col("_r") <= n).drop("_r")


def chunks(df: DataFrame, order: list[str], n: int, by: list[str] = []) -> DataFrame:  # noqa: B006
    """Adds ``chunk``: groups of n rows in order."""
    return df.withColumn("chunk", F.floor((F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1) / n).cast("int"))


def ordered_sample(df: DataFrame, key: str, n: int, seed: int = 2026) -> DataFrame:
    """n rows by the md5 of seed and key, so that any engine draws the same."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary")), key).limit(n)


def group_heads(df: DataFrame, letter: str, order: list[str]) -> DataFrame:
    """Adds ``is_head``: the letter differs from the row before. One row for each index entry, so one ordered task."""
    return df.withColumn("is_head", ~F.lag(letter).over(Window.orderBy(*order)).eqNullSafe(F.col(letter)))
