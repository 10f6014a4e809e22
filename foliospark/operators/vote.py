"""Reconciling several readings of a page."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import blocks, plain, ratio, tokens
from ..sources.shared import in_arrow


def mode_near(df: DataFrame, by: list[str], value: str, near: str, out: str) -> DataFrame:
    """Most frequent value by group; ties go to the value nearest to ``near``, then to the smaller one."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, near, value).agg(F.count("*").alias("_n"))
    best = F.max_by(value, F.struct("_n", -F.abs(F.col(value) - F.col(near)), -F.col(value))).alias(out)
    return counts.groupBy(*by).agg(best)


def voted(p: Column, a: Column, b: Column) -> Column:
    """struct(word, changed, unsure, candidates) of a primary word and two aligned readings (null: not aligned).

    Agreeing alternates win over the primary; one that agrees with the primary confirms it; without any alternate
    the primary stays; otherwise it is marked and the distinct readings are listed.
    """
    both = a.isNotNull() & (a == b) & (a != p)
    kept = (a.isNull() & b.isNull()) | F.coalesce(a == p, F.lit(False)) | F.coalesce(b == p, F.lit(False))
    take = F.coalesce(both, F.lit(False))
    return F.struct(
        F.when(take, a).when(kept, p).otherwise(F.concat(p, F.lit("[?]"))).alias("word"), take.alias("changed"), (~take & ~kept).alias("unsure"),
        F.when(~take & ~kept, F.array_distinct(F.array_compact(F.array(p, a, b)))).otherwise(F.array().cast("array<string>")).alias("candidates"),
    )


def readings(x: list, y: list) -> list:
    """For every word of ``x`` its word of ``y`` in equal runs and in replacements of equal length, else None."""
    if x == y:
        return list(y)
    code: dict = {}
    a, b = (np.array([code.setdefault(w, len(code)) for w in words], np.int64) for words in (x, y))
    found: list = [None] * len(x)
    i = j = 0
    for at, to, n in [*blocks(a, b), (len(x), len(y), 0)]:
        if at - i == to - j:
            found[i:at] = y[j:to]
        i, j = at + n, to + n
        found[at:i] = y[to:j]
    return found


def alignments(df: DataFrame) -> DataFrame:
    """All columns but the last two, texts ``a`` and ``b``; then counts of the words of ``a``, those that ``b`` has a word for and those whose word differs, and the ``likeness`` of both texts (``similar``)."""
    names = ["words", "aligned", "changed", "likeness"]

    def run(batches):
        for batch in batches:
            rows = []
            for a, b in zip(batch.column("a"), batch.column("b")):
                a, b = a.as_py(), b.as_py()
                x = tokens(a)
                got = readings(x, tokens(b))
                rows.append((len(x), sum(w is not None for w in got), sum(w is not None and w != v for v, w in zip(x, got)), ratio(plain(a), plain(b))))
            counts = [pa.array([r[c] for r in rows], pa.int64() if c < 3 else pa.float64()) for c in range(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *counts], names=[*batch.schema.names[:-2], *names])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema[:-2])
    return in_arrow(df, run, f"{kept}, words long, aligned long, changed long, likeness double")


def aligned(primary: DataFrame, other: DataFrame, by: list[str], out: str) -> DataFrame:
    """Adds ``out`` to every primary word (by, pos, word): the word of the other pass in equal runs and in replacements of equal length, else null. Pages are independent groups."""
    keys = ", ".join(f"{c} {primary.schema[c].dataType.simpleString()}" for c in by)

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        a, b = a.sort_values("pos"), b.sort_values("pos")
        return a[[*by, "pos", "word"]].assign(**{out: readings(a["word"].tolist(), b["word"].tolist())})

    return primary.select(*by, "pos", "word").groupBy(*by).cogroup(other.select(*by, "pos", "word").groupBy(*by)).applyInPandas(run, f"{keys}, pos int, word string, {out} string")
