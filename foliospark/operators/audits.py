"""Audits: markers, attribution, dropped lines, other passes, findability and spots. Problems are rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import coverage
from ..functions.text import STOP_WORDS, has_words, norm, strip
from .joins import neighbours


def markers(df: DataFrame, by: list[str], page: str, order: list[str], low: int, high: int) -> DataFrame:
    """(by, problem, page): missing, duplicate, out of range and disorder (a page not above the one before)."""
    seen = df.select(*by, page).distinct()
    every = df.select(*by).distinct() if by else df.sparkSession.range(1).select()
    every = every.withColumn(page, F.explode(F.sequence(F.lit(low), F.lit(high))))
    missing = every.join(seen, [*by, page], "left_anti").withColumn("problem", F.lit("missing"))
    twice = df.groupBy(*by, page).count().filter("count > 1").drop("count").withColumn("problem", F.lit("duplicate"))
    out = seen.filter(~F.col(page).between(low, high)).withColumn("problem", F.lit("range"))
    w = Window.partitionBy(*by).orderBy(*order)
    back = df.withColumn("_b", F.lag(page).over(w)).filter(F.col(page) <= F.col("_b")).select(*by, page).withColumn("problem", F.lit("disorder"))
    cols = [*by, "problem", page]
    return missing.select(cols).unionByName(twice.select(cols)).unionByName(out.select(cols)).unionByName(back.select(cols))


def edge_lines(lines: DataFrame, least_chars: int = 12, raw: int = 80, chars: int = 50) -> DataFrame:
    """(page, edge, line): the first and the last line of each page (page, line_no, text) with ``least_chars`` normal characters; of the first the beginning, of the last the end, normalised."""
    own = lines.withColumn("text", strip(F.col("text"))).filter(F.char_length(norm(F.col("text"))) >= least_chars)
    ends = own.groupBy("page").agg(F.min_by("text", "line_no").alias("first"), F.max_by("text", "line_no").alias("last"))
    key = lambda edge: norm(F.when(edge == "first", F.substring("first", 1, raw)).otherwise(F.expr(f"right(last, {raw})")))
    return ends.select("page", "first", "last", F.explode(F.array(F.lit("first"), F.lit("last"))).alias("edge")).select("page", "edge", key(F.col("edge")).alias("line")).withColumn(
        "line", F.when(F.col("edge") == "first", F.substring("line", 1, chars)).otherwise(F.expr(f"right(line, {chars})")))


def attribution(edges: DataFrame, page_text: DataFrame, low: int, high: int, least: float = 0.8) -> DataFrame:
    """Checks that an edge line (page, edge, line) of ``edge_lines`` scores best on its own page and at least ``least``; ties go to the lowest page, so a tie with the page before fails."""
    near = neighbours(edges, "page", low, high).join(page_text.select(F.col("page").alias("near"), F.col("text").alias("hay")), "near", "left")
    scored = near.withColumn("score", coverage(F.col("line"), F.coalesce("hay", F.lit(""))))
    best = scored.groupBy("page", "edge", "line").agg(F.max_by("near", F.struct("score", -F.col("near"))).alias("best"), F.max(F.when(F.col("near") == F.col("page"), F.col("score"))).alias("own"))
    return best.withColumn("ok", (F.col("best") == F.col("page")) & (F.col("own") >= least))


def dropped(lines: DataFrame, page_text: DataFrame, least: float = 0.8, least_chars: int = 2) -> DataFrame:
    """Normalised lines (page, line) that the page's text covers less than ``least``; a page without text covers nothing."""
    t = lines.filter(F.char_length("line") >= least_chars).join(page_text.select("page", F.col("text").alias("hay")), "page", "left").withColumn("hay", F.coalesce("hay", F.lit("")))
    fuzzy = t.filter(~F.contains("hay", "line"))  # contained lines are covered; only the others reach Python
    return fuzzy.withColumn("cover", coverage(F.col("line"), F.col("hay"))).filter(F.col("cover") < least).drop("hay")


def other_pass(lines: DataFrame, page_text: DataFrame, second: DataFrame, least: float = 0.6, confirm: float = 0.8, least_chars: int = 12) -> DataFrame:
    """Lines of another pass that the corpus lacks (cover under ``least``) and a second pass confirms."""
    lost = dropped(lines, page_text, least, least_chars)
    both = lost.join(second.select("page", F.col("text").alias("hay")), "page")
    return both.withColumn("confirmed", coverage(F.col("line"), F.col("hay"))).filter(F.col("confirmed") >= confirm).drop("hay")


def findability(concepts: DataFrame, paragraphs: DataFrame, block: int = 4_096) -> DataFrame:
    """(row, listed near pages, queries) against (pages, text): hit pages by whole words and without spaces, and whether they fall within the listed pages ±1.

    The concepts are a stated query set: all paragraphs are read for each ``block`` of them, with their forms without
    spaces made once, and a block is what is broadcast.
    """
    tight = lambda c: F.replace(c, F.lit(" "), F.lit(""))
    q = concepts.withColumn("query", F.explode("queries")).select("row", "query", F.transform("query", tight).alias("letters"))
    n = max(1, -(-q.count() // block))
    hay = paragraphs.withColumn("tight", tight(F.col("text")))
    pairs = []
    for i in range(n):
        own = q if n == 1 else q.filter(F.pmod(F.xxhash64("row", "query"), F.lit(n)) == i)
        pair = hay.join(F.broadcast(own), F.forall("letters", lambda p: F.contains(F.col("tight"), p)))
        pairs.append(pair.select("row", "pages", has_words(F.col("text"), F.col("query")).alias("words")))
    found = reduce(DataFrame.unionByName, pairs).select("row", F.explode("pages").alias("page"), "words").groupBy("row", "page").agg(F.max("words").alias("words"))
    found = found.groupBy("row").agg(F.array_sort(F.collect_list(F.when(F.col("words"), F.col("page")))).alias("strict_pages"), F.array_sort(F.collect_list("page")).alias("loose_pages"))
    none = F.array().cast("array<int>")
    got = concepts.join(found, "row", "left").withColumn("strict_pages", F.coalesce("strict_pages", none)).withColumn("loose_pages", F.coalesce("loose_pages", none))
    return got.withColumn("strict", F.arrays_overlap("strict_pages", "near")).withColumn("loose", F.arrays_overlap("loose_pages", "near"))


def spots(queries: DataFrame, paragraphs: DataFrame, shown: int = 8) -> DataFrame:
    """(row, page, parts) whose phrase must stand on exactly its page: ``strict`` by whole words, ``loose`` without spaces, and the first pages of the strict hits."""
    asked = queries.withColumn("near", F.array("page")).withColumn("queries", F.array("parts"))
    return findability(asked, paragraphs).withColumn("shown", F.slice("strict_pages", 1, shown)).drop("near", "queries")


def words_near(concepts: DataFrame, paragraphs: DataFrame, stop: tuple[str, ...] = STOP_WORDS) -> DataFrame:
    """Adds ``words_near``: one paragraph (pages, text) on a page of ``near`` holds all words, stop words aside, of the first query. Concepts meet paragraphs by page; a concept without such words has none."""
    first = F.coalesce(F.get("queries", F.lit(0)), F.array().cast("array<string>"))
    words = F.filter(F.split(F.array_join(first, " "), " "), lambda w: (w != "") & ~w.isin(list(stop)))
    asked = concepts.select("row", words.alias("words"), F.explode("near").alias("page")).filter(F.size("words") > 0)
    held = paragraphs.select(F.explode("pages").alias("page"), "text")
    found = asked.join(held, "page").filter(has_words(F.col("text"), F.col("words"))).select("row").distinct()
    return concepts.join(found.withColumn("words_near", F.lit(True)), "row", "left").withColumn("words_near", F.coalesce("words_near", F.lit(False)))


def totals(pages: DataFrame, unsure: DataFrame, voted: DataFrame, low: DataFrame) -> DataFrame:
    """One row: pages, their lines, unsure and voted words, low lines and their share of all lines (0 without lines)."""
    marked = {"unsure": unsure, "voted": voted, "low": low}
    every = pages.select(F.lit("pages").alias("kind"), F.col("lines").cast("long").alias("lines"))
    for name, df in marked.items():
        every = every.unionByName(df.select(F.lit(name).alias("kind"), F.lit(0).cast("long").alias("lines")))
    counted = every.agg(F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"), *[F.count_if(F.col("kind") == n).alias(n) for n in ("pages", *marked)])
    return counted.withColumn("low_share", F.col("low") / F.greatest(F.col("lines"), F.lit(1)))


def problem_pages(*problems: DataFrame) -> DataFrame:
    """(page, n): the places of all kinds (unsure, no syllable, low confidence) by page, most first, then by page."""
    every = reduce(DataFrame.unionByName, [p.select("page") for p in problems])
    return every.groupBy("page").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "page")


def mismatches(pages: DataFrame) -> DataFrame:
    """(page, printed, problem): pages whose printed number is another one, and those without."""
    differs = F.when(F.col("printed").isNull(), "unread").when(F.col("printed") != F.col("page"), "differs")
    return pages.select("page", "printed", differs.alias("problem")).filter("problem IS NOT NULL")


def figure_pages(figures: DataFrame) -> DataFrame:
    """One row: the pages with figures, each once, in order."""
    return figures.agg(F.array_sort(F.collect_set("page")).alias("pages"))


def box_totals(boxes: DataFrame) -> DataFrame:
    """One row: pages that hold boxes, and boxes."""
    return boxes.agg(F.count_distinct("page").alias("pages"), F.count("*").alias("boxes"))


def rates(checked: DataFrame, by: list[str], flag: str) -> DataFrame:
    return checked.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(F.col(flag)).alias("found"), F.avg(F.col(flag).cast("double")).alias("rate"))
