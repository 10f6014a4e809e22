"""Quality rules with adaptive thresholds.

Word, symbol, line and repetition counts come from one Arrow stage over whole texts. Ratios are whole numbers in a
bounded range, so a histogram for each language, source and ratio is an exact, mergeable quantile sketch: partial
counts add up in any order. Fences from the quantiles of a group replace fixed cutoffs; the spread is the group's or, if
that is wider, the median of all groups' spreads, so that a group that copies of one document fill keeps its other
documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import packed_rows, quoted, small_batches, stored, trimmed

SYMBOLS = b"#*$%&|<>"
#: Upper fences by ratio: (quantile, inner quantile, factor); a value is too high above q + factor * (q - inner) + 1.
UPPER = {"symbols": (750, 250, 3), "dup_lines": (980, 900, 1), "repeats": (980, 900, 1), "length": (750, 250, 3)}
#: Lower fences: too low below q - factor * (inner - q) - 1.
LOWER = {"length": (250, 750, 3)}
#: Ratios: per-milles, and the mean word length in hundredths of a code point, up to 100 code points.
RATIOS = {
    "symbols": "1000 * n_symbols div greatest(word_chars, 1)", "dup_lines": "1000 * n_dup_lines div greatest(n_lines, 1)",
    "repeats": "1000 * n_repeat_words div greatest(n_words, 1)", "length": "least(100 * word_chars div greatest(n_words, 1), 10000)",
}
BASE = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"
STATS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
NAMES = [x.split()[0] for x in STATS.split(", ")]


def text_stats(text: str | None) -> tuple[int, int, int, int, int, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    w = raw.split()
    n = len(w)
    chars = len(b"".join(w).decode("utf-8", "surrogatepass"))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeats = 0
    if n > 3:
        grams = list(zip(w, w[1:], w[2:]))
        seen = Counter(grams)
        if len(seen) < len(grams):
            last = -1
            for i, g in enumerate(grams):
                if seen[g] > 1:
                    repeats += i + 3 - max(i, last)
                    last = i + 3
    return n, chars, sum(map(raw.count, (SYMBOLS[i : i + 1] for i in range(len(SYMBOLS))))), len(lines), len(lines) - len(set(lines)), repeats


def counted(text: Column) -> Column:
    """Struct of the counts of a text (null: empty)."""

    def stats(batches):
        for texts in batches:
            rows = [text_stats(t.as_py()) for t in texts]
            yield pa.StructArray.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(len(NAMES))], NAMES)

    @F.arrow_udf(f"struct<{STATS.replace(' ', ':').replace(',:', ',')}>")
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return trimmed(stats)(batches)

    return counts(text)


def measured(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns in ``keep``, the counts of every text and base_failed."""
    counts = small_batches(docs).select(*[quoted(c) for c in keep], counted(F.col("text")).alias("counts"))
    return counts.select(*keep, "counts.*").withColumn("base_failed", F.expr(BASE))


def sketches(stats: DataFrame) -> DataFrame:
    """(lang, source, ratio, value, n): the histograms of the documents that pass the base rule."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("ratio"), F.expr(v).alias("value")) for k, v in RATIOS.items()]))
    return stats.filter("NOT base_failed").select("lang", "source", each.alias("r")).groupBy("lang", "source", "r.ratio", "r.value").agg(F.count("*").alias("n"))


def quantiles(hist: DataFrame, *group: str, used=None) -> DataFrame:
    """q<per mille> of each group and ratio: the least value that so many per mille reach."""
    w = Window.partitionBy(*group, "ratio")
    hist = hist.withColumn("cum", F.sum("n").over(w.orderBy("value").rowsBetween(Window.unboundedPreceding, 0))).withColumn("all", F.sum("n").over(w))
    used = used or sorted({q for hi, inner, _ in [*UPPER.values(), *LOWER.values()] for q in (hi, inner)})
    return hist.groupBy(*group, "ratio").agg(*[F.min(F.when(F.col("cum") * 1000 >= F.col("all") * q, F.col("value"))).alias(f"q{q}") for q in used])


def fences(hist: DataFrame) -> DataFrame:
    """(lang, source, max_<ratio> ..., min_<ratio> ...): a row for each language and source with a document that passes the base rule.

    The median spread of the groups is found as a group's quantile is, from a histogram of at most 10,001 spreads.
    """
    got = stored(quantiles(hist, "lang", "source"))
    rules = [(k, 1, r) for k, r in UPPER.items()] + [(k, -1, r) for k, r in LOWER.items()]
    spread = lambda s, r: s * (F.col(f"q{r[0]}") - F.col(f"q{r[1]}"))
    each = got.select(F.explode(F.array(*[F.when(F.col("ratio") == k, F.struct(F.lit(f"{k}{s}").alias("ratio"), spread(s, r).alias("value"))) for k, s, r in rules])).alias("s"))
    mid = quantiles(each.filter("s IS NOT NULL").groupBy("s.ratio", "s.value").agg(F.count("*").alias("n")), used=(500,))
    mid = mid.agg(*[F.max(F.when(F.col("ratio") == f"{k}{s}", F.col("q500"))).alias(f"mid_{k}{s}") for k, s, _ in rules])  # one row
    fence = lambda k, s, r: F.max(F.when(F.col("ratio") == k, F.col(f"q{r[0]}") + s * (r[2] * F.greatest(spread(s, r), F.col(f"mid_{k}{s}")) + 1)))
    return got.crossJoin(F.broadcast(mid)).groupBy("lang", "source").agg(*[fence(k, s, r).alias(f"{'max' if s > 0 else 'min'}_{k}") for k, s, r in rules])


def judged(stats: DataFrame, limits: DataFrame) -> DataFrame:
    """stats with kept, by the fences of their language and source."""
    on = F.col("a.lang").eqNullSafe(F.col("b.lang")) & F.col("a.source").eqNullSafe(F.col("b.source"))
    both = stats.alias("a").join(limits.alias("b"), on, "left").select("a.*", *[f"max_{k}" for k in UPPER], *[f"min_{k}" for k in LOWER])
    bad = F.lit(False)
    for k in UPPER:
        bad = bad | F.coalesce(F.expr(RATIOS[k]) > F.col(f"max_{k}"), F.lit(False))
    for k in LOWER:
        bad = bad | F.coalesce(F.expr(RATIOS[k]) < F.col(f"min_{k}"), F.lit(False))
    return both.withColumn("kept", ~F.col("base_failed") & ~bad)


def verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counts, base_failed, the fences and kept for every row; nothing is dropped.

    Null text counts as empty and fails the base rule (as do texts under 50 words); null languages and sources
    are groups of their own; repeated rows count each; an empty table gives no rows; other columns are not read.
    """
    stats = stored(measured(docs, "doc_id", "lang", "source"))
    return judged(stats, stored(fences(sketches(stats))))  # written, so that Spark knows its size: small ones are broadcast


def passing(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, unchanged, with all columns, whatever their names; nulls, repeats and empty tables as in ``verdicts``.

    Texts are counted twice, once for the fences and once for the verdict, so that no copy of them is written.
    """
    limits = stored(fences(sketches(measured(docs, "lang", "source"))))
    rows = packed_rows(docs, lang=F.col("lang"), source=F.col("source"), counts=counted(F.col("text")))
    stats = rows.select("row", "lang", "source", "counts.*").withColumn("base_failed", F.expr(BASE))
    return judged(stats, limits).filter("kept").select("row.*")
