"""Accent-insensitive keyword search and page views over corpus lines (path, line_no, text, page)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import search_key, snippet


def hits(lines: DataFrame, terms: list[str], any_mode: bool = False, loose: bool = False) -> DataFrame:
    """Lines that hold all (or any) of the terms: adds ``at`` (0-based place of the earliest term in the folded line) and ``snippet``. Terms that fold to nothing are ignored; without terms there are no hits."""
    spark = lines.sparkSession
    keys = [k for (k,) in spark.createDataFrame([(t,) for t in terms] or [("",)], "t string").select(search_key(F.col("t"), loose)).collect() if k and k.strip()]
    if not keys:
        return lines.filter(F.lit(False)).withColumn("at", F.lit(0)).withColumn("snippet", F.lit(""))
    folded = lines.withColumn("_k", search_key(F.col("text"), loose))
    tests = [F.contains(F.col("_k"), F.lit(k)) for k in keys]
    found = folded.filter(reduce(lambda a, b: a | b if any_mode else a & b, tests))
    spots = F.array(*[F.struct(F.nullif(F.instr("_k", k), F.lit(0)).alias("p"), F.lit(len(k)).alias("n")) for k in keys])
    first = F.array_min(F.filter(spots, lambda s: s["p"].isNotNull()))
    at = (first["p"] - 1).cast("int")
    if loose:  # places count without white space: map back through the running number of other characters
        chars = F.split("text", "")
        index = F.filter(F.sequence(F.lit(1), F.size(chars)), lambda i: ~F.element_at(chars, i).rlike(r"(?U)^\s?$"))
        start, end = F.element_at(index, at + 1) - 1, F.element_at(index, at + first["n"])
    else:
        start, end = at, at + first["n"]
    return found.withColumn("snippet", snippet(F.col("text"), start, end)).withColumn("at", start.cast("int")).drop("_k")


def keyword_search(book: DataFrame, terms: list[str], any_mode: bool = False, limit: int = 20, index: DataFrame | None = None) -> DataFrame:
    """Index hits, then book hits, at most ``limit`` of each, in (path, line_no) order; the loose pass (without white space) runs only if the strict one finds nothing in any source.

    Whether there is a strict hit is asked first (the scan stops at one), so that the loose pass is planned only if needed.
    """
    sources = [(0, index), (1, book)] if index is not None else [(1, book)]
    loose = all(hits(df, terms, any_mode).isEmpty() for _, df in sources)
    top = lambda df, s: df.orderBy("path", "line_no").limit(limit).withColumn("source_no", F.lit(s))
    per = [top(hits(df, terms, any_mode, loose), s) for s, df in sources]
    return reduce(DataFrame.unionByName, per).withColumn("loose", F.lit(loose))


def page_view(lines: DataFrame, page: int) -> DataFrame:
    """(path, text): the page's lines joined in order, from the first file that has the page."""
    w = Window.partitionBy("page").orderBy("path")
    own = lines.filter(F.col("page") == page).withColumn("_r", F.dense_rank().over(w)).filter("_r = 1")
    return own.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda s: s["text"]), "\n").alias("text"))
