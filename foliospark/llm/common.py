"""Helpers shared by the training-data operators.

Words are maximal runs of characters other than space and U+0009 to U+000D. ``bytes.split()`` has the
same rule on UTF-8, so the Python stages split encoded text.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import ARROW_ROWS, discard, forget, in_arrow, kept, release, session_of, setting, shared_dir, small_batches, stored, trimmed  # noqa: F401

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
BROADCAST_BYTES = 8 << 20
MAX_RANGES = 1 << 16
MAX_SAMPLE = 1 << 18


def small(table: DataFrame, row_bytes: int | Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A stored table, marked for broadcast if its rows, of ``row_bytes`` each, take ``limit`` bytes at most; else Spark picks the join."""
    held = table.agg(F.sum(row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes))).first()[0] or 0
    return F.broadcast(table) if held <= limit else table


def packed_rows(df: DataFrame, **keys: Column) -> DataFrame:
    """All columns of df in one struct ``row`` beside ``keys``, so that no input name can clash; ``row.*`` unpacks."""
    return df.select(F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("row"), *[v.alias(k) for k, v in keys.items()])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def words(text: Column | str) -> Column:
    """Array of words; empty for null or blank text."""
    col = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(col, F.lit("")), GAP), lambda w: w != "")


def n_words(text: Column | str) -> Column:
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def splitters(df: DataFrame, key: Column, weight: Column, n_ranges: int, per_range: int = 32) -> list:
    """Sampled range boundaries over ``key``: rows are drawn with a chance that grows with ``weight``.

    The draw is a hash test, so reruns agree. There are at most MAX_RANGES ranges and about MAX_SAMPLE sampled keys,
    whatever the table's size, so the driver and the plan hold a bounded list; beyond that, ranges hold more rows.
    """
    n_ranges = min(n_ranges, MAX_RANGES)
    per_range = max(4, min(per_range, MAX_SAMPLE // max(1, n_ranges)))
    total = df.agg(F.sum(weight.cast("double"))).first()[0] or 0.0
    if n_ranges < 2 or total <= 0:
        return []
    chance = weight.cast("double") * F.lit(n_ranges * per_range / total)
    draw = (F.pmod(F.xxhash64(key, F.lit(20011)), F.lit(1 << 40)).cast("double")) / F.lit(float(1 << 40))
    got = [r[0] for r in df.filter(draw < chance).select(key.alias("k")).distinct().sort("k").collect()]
    step = len(got) / n_ranges
    return [got[i] for i in sorted({math.floor(step * j) for j in range(1, n_ranges)})] if step >= 1 else got


def range_of(key: Column, bounds: list, kind: str) -> Column:
    """Number of boundaries at or below ``key``: a two-level search, about 2 * sqrt(len(bounds)) comparisons."""
    if not bounds:
        return F.lit(0)
    width = max(1, math.isqrt(len(bounds)))
    blocks = [bounds[i : i + width] for i in range(0, len(bounds), width)]

    def literal(values: list) -> Column:
        return F.from_json(F.lit(_json(values)), f"array<{kind}>")

    top = literal([b[0] for b in blocks])
    table = F.from_json(F.lit("[" + ",".join(_json(b) for b in blocks) + "]"), f"array<array<{kind}>>")
    block = F.size(F.filter(top, lambda x: x <= key))
    inside = F.size(F.filter(F.get(table, block - 1), lambda x: x <= key))
    return F.when(block == 0, F.lit(0)).otherwise((block - 1) * F.lit(width) + inside)


def _json(values: list) -> str:
    import json

    return json.dumps([v.asDict() if hasattr(v, "asDict") else v for v in values])


def packed(f, size: int = 100_000):
    """Joins the small batches of f to larger ones."""

    def run(batches):
        held, n = [], 0
        for b in f(batches):
            held.append(b)
            n += b.num_rows
            if n >= size:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return run
