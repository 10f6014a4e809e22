"""Document fingerprints as threshold-scaled sketches (DataFrame functions only).

A sketch keeps every hash of a five-word shingle that lies below a fixed fraction of the hash range, so sketches
of parts merge by union and the containment of a short document in a long one can be estimated. A document whose
hashes all lie above the threshold keeps its smallest one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import range_of, splitters, words

FRACTION = 4  # one hash of so many is kept
KEY = "struct<nil:int,doc_id:bigint,th:bigint>"


def with_sketch(df: DataFrame, text: str, out: str, k: int = 5, fraction: int = FRACTION) -> DataFrame:
    """Adds the sorted array ``out``. Null or blank text: empty; fewer than k words: one hash of them all."""
    hashes, full = f"_{out}_h", f"_{out}_s"
    df = df.withColumn(hashes, F.transform(words(text), lambda w: F.xxhash64(w)))
    size = F.size(hashes)
    shingle = lambda i: F.xxhash64(*[F.get(F.col(hashes), i + d) for d in range(k)])
    df = df.withColumn(full, F.when(size >= k, F.array_distinct(F.transform(F.sequence(F.lit(0), size - k), shingle))).when(size > 0, F.array(F.xxhash64(hashes))).otherwise(F.array().cast("array<bigint>")))
    limit = F.lit(-(1 << 63) + (1 << 64) // fraction)
    kept = F.array_sort(F.filter(F.col(full), lambda h: h < limit))
    df = df.withColumn(out, kept)
    df = df.withColumn(out, F.when((F.size(out) == 0) & (F.size(full) > 0), F.array(F.array_min(full))).otherwise(F.col(out)))
    return df.drop(hashes, full)


def merge(a: Column, b: Column, fraction: int = FRACTION) -> Column:
    """Sketch of two parts together: the union, by the same threshold."""
    both = F.array_sort(F.array_union(a, b))
    kept = F.filter(both, lambda h: h < F.lit(-(1 << 63) + (1 << 64) // fraction))
    return F.when(F.size(kept) > 0, kept).otherwise(F.slice(both, 1, 1))


def containment(a: Column, b: Column) -> Column:
    """Share of the smaller sketch that the other one holds, 0 to 1; two empty sketches: 1."""
    least = F.least(F.size(a), F.size(b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when(least == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)).cast("double") / least)


def as_text(sketch: Column) -> Column:
    """Hexadecimal, 16 characters a hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def edited_fingerprints(docs: DataFrame, rows_per_range: int = 20_000, least_ranges: int = 256) -> DataFrame:
    """Sketches of every text and of its edited text, with likenesses.

    The edit replaces the last floor(n / 3) code points by the first as many (or all) of the next document in
    descending doc_id order (null last; equal ids by text hash); the last one's next is the first. Returns doc_id,
    n_chars, edited_sha256, sketch, edited_sketch, near_edited, near_next (containments). Null text counts as
    empty; repeated rows follow each other; an empty table gives no rows; other columns are not read.

    Rows are dealt by sampled ranges of (doc_id, text hash); the first row of each range is also sent to the
    range before it, so that "next" never needs all rows in one task.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    d = d.withColumn("th", F.xxhash64("text"))
    key = F.struct(F.col("doc_id").isNotNull().cast("int").alias("nil"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("th"))
    slim = d.select("doc_id", "th")
    n_rows = docs.count()
    bounds = splitters(slim, key, F.lit(1), max(least_ranges, -(-n_rows // rows_per_range)), per_range=16)
    ranged = slim.withColumn("range", range_of(key, bounds, KEY))
    heads = ranged.groupBy("range").agg(F.max(key).alias("head"))  # a row for each range
    after = Window.orderBy("range")
    heads = heads.withColumn("to", F.coalesce(F.lead("range").over(after), F.min("range").over(Window.partitionBy())))
    heads = heads.select(F.col("head").alias("h"), "to")

    placed = with_sketch(d, "text", "sketch").withColumn("range", range_of(key, bounds, KEY)).withColumn("key", key)
    placed = placed.join(F.broadcast(heads), placed["key"] == heads["h"], "left")  # as many rows as ranges
    ends = F.filter(F.array(F.struct(F.col("range").alias("range"), F.lit(0).alias("extra")), F.struct(F.col("to").alias("range"), F.lit(1).alias("extra"))), lambda x: x["range"].isNotNull())
    placed = placed.select("doc_id", "th", "text", "sketch", F.explode(ends).alias("e")).select("doc_id", "th", "text", "sketch", "e.range", "e.extra")
    order = Window.partitionBy("range").orderBy("extra", F.col("doc_id").desc_nulls_last(), F.col("th").desc(), F.col("text").desc())
    got = placed.withColumn("next_text", F.lead("text").over(order)).withColumn("next_sketch", F.lead("sketch").over(order)).filter("extra = 0")

    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    got = got.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut)))
    got = with_sketch(got, "edited", "edited_sketch")
    return got.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"), "sketch", "edited_sketch",
        containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"), containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
