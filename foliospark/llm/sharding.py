"""Sharding by sampled splitters (DataFrame functions only).

Size-weighted key samples give quantile boundaries; records are range-partitioned by key, ranges that hold
too much are subdivided, and exact prefix sums of the sizes over the ranges turn every record's place in the
key order into a shard and a slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import MAX_RANGES, range_of, splitters, stored

KEY = "struct<nil:int,doc_id:bigint,crc:bigint,size:bigint>"


def shard_by_bytes(docs: DataFrame, n_shards: int = 24, overhead: int = 8, rows_per_range: int = 200_000, overfull: float = 2.0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``.

    Law ``bytes``: shards are consecutive runs of the order (doc_id, crc, size); a row belongs to the shard in
    which the middle of its bytes falls, so a shard differs from total / n_shards by less than one row at
    either end. Slots count from 0 inside a shard. ``grown_shard`` is null (that column is for the law ``key``).

    Null text counts ``overhead`` bytes and crc 0; null doc_id sorts first; rows that repeat in doc_id, crc and
    size are counted before the shuffle and dealt out again at the end, so no key is too hot; empty tables give
    no rows; columns other than doc_id and text are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("crc"),
    )
    rows = stored(slim.groupBy("doc_id", "size", "crc").agg(F.count("*").alias("n")))
    key = F.struct(F.col("doc_id").isNotNull().cast("int").alias("nil"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("crc"), F.col("size"))
    n_rows, total = rows.agg(F.count("*"), F.sum(F.col("n") * F.col("size"))).first()
    n_ranges = min(MAX_RANGES, max(4 * n_shards, -(-n_rows // rows_per_range)))
    bounds = splitters(rows, key, F.col("size") * F.col("n"), n_ranges)
    placed = rows.withColumn("range", range_of(key, bounds, KEY))
    # Overfull ranges get their own, denser splitters; the summary has a row for each range.
    limit = overfull * max(1.0, n_rows / n_ranges)
    over = placed.groupBy("range").agg(F.count("*").alias("rows")).filter(F.col("rows") > F.lit(max(limit, rows_per_range / 4)))
    full = [r["range"] for r in over.collect()]
    if full:
        inner = placed.filter(F.col("range").isin(full))
        held = inner.count()
        bounds = sorted({*bounds, *splitters(inner, key, F.lit(1), max(2, int(2 * held / max(limit, 1))))})
        placed = rows.withColumn("range", range_of(key, bounds, KEY))
    placed = stored(placed.repartition(F.col("range")))

    sums = placed.groupBy("range").agg(F.sum(F.col("n") * F.col("size")).alias("bytes"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    offsets = sums.select("range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("range").orderBy(F.col("doc_id").asc_nulls_first(), "crc", "size").rowsBetween(Window.unboundedPreceding, -1)
    at = placed.withColumn("run", F.coalesce(F.sum(F.col("n") * F.col("size")).over(inside), F.lit(0))).join(offsets, "range")
    each = at.select("doc_id", "size", "crc", "range", (F.col("offset") + F.col("run")).alias("start"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"))
    middle = F.col("start") + F.col("copy") * F.col("size") + F.floor(F.col("size") / 2)
    sharded = each.withColumn("shard", F.least(F.lit(n_shards - 1), F.floor(middle.cast("decimal(38,0)") * n_shards / F.lit(max(total or 1, 1)).cast("decimal(38,0)"))).cast("int"))

    # A slot is the rank inside (range, shard) plus the rows that earlier ranges put into the shard.
    counts = sharded.groupBy("range", "shard").agg(F.count("*").alias("rows"))
    offsets = counts.select("range", "shard", F.coalesce(F.sum("rows").over(Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    rank = Window.partitionBy("range", "shard").orderBy(F.col("doc_id").asc_nulls_first(), "crc", "size", "copy")
    return (
        sharded.withColumn("rank", F.row_number().over(rank))
        .join(offsets, ["range", "shard"])
        .select("doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("rank") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )
