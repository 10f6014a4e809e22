"""Range, as-of, anti, upsert and band joins over page-like keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.boxes import centre_in

SMALL_ROWS = 100_000


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A control table, broadcast once its size has been checked; larger ones are joined as they are."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def to_chapter(pages: DataFrame, chapters: DataFrame, page: str = "page", strict: bool = True) -> DataFrame:
    """Adds the chapter with first <= page <= last; a page in none is an error, or a null row without ``strict``. Ranges are joined by the pages they hold, so the join is an equi join."""
    held = chapters.select(F.explode(F.sequence("first", "last")).alias(page), F.struct(*chapters.columns).alias("chapter"))
    got = pages.join(small(held), page, "left")
    if strict:
        got = got.withColumn("chapter", F.when(F.col("chapter").isNull(), F.raise_error(F.format_string("page %s is in no chapter", F.col(page)))).otherwise(F.col("chapter")))
    return got


def to_section(pages: DataFrame, chapters: DataFrame, page: str = "page") -> DataFrame:
    """Adds ``section``: the last one that starts at or before the page in its chapter, else the chapter's title."""
    got = to_chapter(pages, chapters, page)
    started = F.filter(F.col("chapter.sections"), lambda s: s["page"] <= F.col(page))
    last = F.aggregate(started, F.struct(F.lit(None).cast("string").alias("title"), F.lit(-1).alias("page")), lambda a, s: F.when(s["page"] >= a["page"], F.struct(s["title"].alias("title"), s["page"].alias("page"))).otherwise(a))
    return got.withColumn("section", F.coalesce(last["title"], F.col("chapter.title")))


def asof_backward(left: DataFrame, right: DataFrame, by: list[str], at: str, value: str) -> DataFrame:
    """Adds ``value`` of the last right row at or before ``at`` (ties: the larger value): one sort of both sides by key, no pairs."""
    from pyspark.sql import Window

    both = left.withColumn("_side", F.lit(1)).withColumn("_v", F.lit(None).cast(right.schema[value].dataType)).unionByName(right.select(*by, at, F.lit(0).alias("_side"), F.col(value).alias("_v")), allowMissingColumns=True)
    w = Window.partitionBy(*by).orderBy(at, "_side", "_v").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(value, F.last("_v", ignorenulls=True).over(w)).filter("_side = 1").drop("_side", "_v")


def with_fixes(lines: DataFrame, fixes: DataFrame) -> DataFrame:
    """OCR lines with region fixes applied in the order of ``fix_no`` (without that column: all at once): lines whose centre lies in a fix's ``replace`` box go, the fix's lines come.

    A line goes if any later fix covers it, so one anti join does all rounds.
    """
    f = fixes.withColumn("_step", F.col("fix_no") + 1 if "fix_no" in fixes.columns else F.lit(1))
    added = f.select("page", "_step", F.posexplode("lines").alias("pos", "l")).select("page", (F.col("pos") + F.col("_step") * 1_000_000).alias("line_no"), "l.*", "_step")
    both = lines.withColumn("_step", F.lit(0)).unionByName(added, allowMissingColumns=True)
    later = small(f.select(F.col("page").alias("_p"), "replace", F.col("_step").alias("_later")))
    covered = (F.col("page") == F.col("_p")) & (F.col("_later") > F.col("_step")) & centre_in(F.struct("x", "y", "w", "h"), F.col("replace"))
    return both.join(later, covered, "left_anti").drop("_step")


def headings(chapters: DataFrame) -> DataFrame:
    """(no, page, heading): section titles by their page; of several on a page the last."""
    s = chapters.select("no", F.posexplode("sections").alias("pos", "s"))
    return s.groupBy("no", F.col("s.page").alias("page")).agg(F.max_by("s.title", "pos").alias("heading"))


def overridden(concepts: DataFrame, overrides: DataFrame) -> DataFrame:
    """Concepts with the ``queries`` of their row in ``overrides``; a row that has none, or an empty list there, keeps its own."""
    o = overrides.select("row", F.col("queries").alias("_q"))
    return concepts.join(o, "row", "left").withColumn("override", F.coalesce(F.size("_q") > 0, F.lit(False))).withColumn("queries", F.when(F.col("override"), F.col("_q")).otherwise(F.col("queries"))).drop("_q")


def figures_on(pages: DataFrame, figures: DataFrame, none: str = "none") -> DataFrame:
    """Pages with ``files``: the names of their figures (page, file) in order, or ``none``."""
    held = figures.groupBy("page").agg(F.array_join(F.array_sort(F.collect_list("file")), ", ").alias("files"))
    return pages.join(held, "page", "left").withColumn("files", F.coalesce("files", F.lit(none)))


def upserted(auto: DataFrame, exclude: DataFrame, override: DataFrame, key: str, value: str) -> DataFrame:
    """Excluded keys go first, then overrides replace or add whole keys (also excluded ones)."""
    kept = auto.join(exclude, key, "left_anti")
    o = override.select(key, F.col(value).alias("_new"))
    return kept.join(o, key, "full_outer").select(key, F.coalesce("_new", value).alias(value))


def neighbours(pages: DataFrame, page: str, low: int, high: int, reach: int = 1) -> DataFrame:
    """A row for each page within ``reach``, clipped: column ``near``. Equi join on it instead of a band join."""
    return pages.withColumn("near", F.explode(F.sequence(F.greatest(F.col(page) - reach, F.lit(low)), F.least(F.col(page) + reach, F.lit(high)))))


def near_set(pages: Column, reach: int = 1) -> Column:
    return F.array_sort(F.array_distinct(F.flatten(F.transform(pages, lambda p: F.sequence(p - reach, p + reach)))))


def containing(queries: DataFrame, paragraphs: DataFrame, parts: str, text: str) -> DataFrame:
    """Pairs (query, paragraph) in which every part stands as whole words. Candidates meet by the longest word of the first part, which any hit must hold, so no cross join."""
    from ..functions.text import has_words

    longest = F.element_at(F.array_sort(F.transform(F.split(F.element_at(parts, 1), " "), lambda w: F.struct((-F.char_length(w)).alias("l"), w.alias("w")))), 1)["w"]
    q = queries.filter(F.size(parts) > 0).withColumn("_w", longest)
    p = paragraphs.withColumn("_w", F.explode(F.array_distinct(F.filter(F.split(text, " "), lambda w: w != ""))))
    p = p.join(small(q.select("_w").distinct()), "_w", "left_semi")
    return q.join(p, "_w").filter(has_words(F.col(text), F.col(parts))).drop("_w")
