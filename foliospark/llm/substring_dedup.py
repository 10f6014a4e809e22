"""Substring dedup: words covered by a window of words that also starts elsewhere are removed.

The automaton of repeated windows is cut at the threshold: a state for each distinct run of ``width`` words, so a
document's matching statistics reach the threshold exactly where its running window is a state. Reference shards
are hash shards of those states. They hold repeated text only, which is found in three steps:

1. Every window is owned by its least ``gram``-word hash (a minimizer), so equal windows have equal owners at equal
   offsets. An anchor is a run of windows with one owner: (gram hash, hash of the run's words, document, place).
2. Anchors whose gram occurs once are unique. Anchors that share all their words repeat as a whole.
3. Among the others of a gram, one anchor of each wording lists its windows; windows listed twice are states.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, stored
from .shingles import gram_hashes, run_hashes, word_hashes

GRAM = 8


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def anchors(h: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, wording hash, first window, number of windows) of each anchor; h has at least ``width`` words."""
    g = gram_hashes(h, gram)
    span = width - gram + 1
    least = np.arange(len(g) - span + 1) + np.lib.stride_tricks.sliding_window_view(g, span).argmin(axis=1)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    count = np.diff(np.concatenate([first, [len(least)]]))
    return g[least[first]].view(np.int64), run_hashes(h, first, count - 1 + width).view(np.int64), first, count


def covered(n: int, starts: list[int], counts: list[int], width: int) -> np.ndarray:
    """Which of n words lie in one of the windows start .. start + count - 1."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.asarray(starts, np.int64), 1)
    np.add.at(edge, np.asarray(starts, np.int64) + np.asarray(counts, np.int64) + width - 1, -1)
    return np.cumsum(edge)[:n] > 0


def repeated_windows(docs: DataFrame, width: int = 35, gram: int = GRAM) -> DataFrame:
    """(doc_id, th, runs array<struct<start,n>>): runs of window starts whose words also start elsewhere."""
    base = keyed(docs)

    def anchor(batches):
        for b in batches:
            ids, ths = b.column(0), b.column(1)
            for i, x in enumerate(b.column(2).to_pylist()):
                w = split_words(x)
                if len(w) >= width:
                    m, s, first, count = anchors(word_hashes(w), width, gram)
                    at = pa.array(np.full(len(m), i, np.int64))
                    yield pa.RecordBatch.from_arrays([ids.take(at), ths.take(at), pa.array(m), pa.array(s), pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32))], ["doc_id", "th", "mh", "sh", "first", "n"])

    found = stored(base.mapInArrow(packed(anchor), "doc_id long, th long, mh long, sh long, first int, n int"))
    # Counts are written before they are joined: Spark splits hot keys only where both sides come straight from a shuffle.
    twice = stored(found.groupBy("mh").agg(F.count("*").alias("c"), (F.min("sh") != F.max("sh")).alias("mixed")).filter("c > 1").select("mh", "mixed"))
    shared = stored(found.join(twice, "mh"))
    wording = stored(shared.groupBy("mh", "sh").agg(F.count("*").alias("c"), F.min(F.struct("doc_id", "th", "first")).alias("rep")))
    marked = stored(shared.join(wording, ["mh", "sh"]).select("doc_id", "th", "first", "n", (F.col("c") > 1).alias("whole"), (F.col("mixed") & F.col("rep").eqNullSafe(F.struct("doc_id", "th", "first"))).alias("lists")).filter("whole OR lists"))

    lists = marked.filter("lists").groupBy("doc_id", "th").agg(F.collect_set(F.struct("first", "n", "whole")).alias("runs"))
    texts = with_runs(base, lists, "inner")

    def window(batches):
        for b in batches:
            ids, ths = b.column(0), b.column(1)
            for i, (x, runs) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
                h = word_hashes(split_words(x))
                at = np.concatenate([np.arange(r["first"], r["first"] + r["n"]) for r in runs])
                whole = np.repeat([r["whole"] for r in runs], [r["n"] for r in runs])
                row = pa.array(np.full(len(at), i, np.int64))
                yield pa.RecordBatch.from_arrays([ids.take(row), ths.take(row), pa.array(run_hashes(h, at, width).view(np.int64)), pa.array(at.astype(np.int32)), pa.array(whole)], ["doc_id", "th", "wh", "at", "whole"])

    listed = stored(texts.mapInArrow(packed(window), "doc_id long, th long, wh long, at int, whole boolean"))
    states = stored(listed.groupBy("wh").agg(F.count("*").alias("c")).filter("c > 1").select("wh"))
    single = listed.filter("NOT whole").join(states, "wh").select("doc_id", "th", F.col("at").alias("start"), F.lit(1).alias("n"))
    every = marked.filter("whole").select("doc_id", "th", F.col("first").alias("start"), "n").unionByName(single)
    return every.groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "n")).alias("runs"))


def keyed(docs: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text", *extra)


def with_runs(base: DataFrame, runs: DataFrame, how: str) -> DataFrame:
    """Adds runs to their documents; Spark picks the join by the sizes it measures, nothing is broadcast by hand."""
    side = stored(runs)
    on = base["doc_id"].eqNullSafe(side["doc_id"]) & (base["th"] == side["th"])
    return base.join(side, on, how).select(base["doc_id"], base["th"], "text", "runs")


def dedup(docs: DataFrame, width: int = 35, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, spans (and kept, the text that stays) for every row.

    Kept words are joined by one space; spans are [first, end) word places that were removed. Null, empty and
    short texts (under ``width`` words) lose nothing; rows that repeat lose all they share, in each of the rows; a
    null doc_id stays; an empty table gives no rows; other columns are not read. Windows are judged on the input.
    """
    base = keyed(docs)
    both = with_runs(base, repeated_windows(docs, width), "left")
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "spans", *["kept"] * with_text]

    def cut(batches):
        for b in batches:
            out = [[], [], [], [], []]
            for x, runs in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                w, spans = split_words(x), []
                n = len(w)
                if runs:
                    gone = covered(n, [r["start"] for r in runs], [r["n"] for r in runs], width)
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                    spans = edge.reshape(-1, 2).tolist()
                    w = [x for x, g in zip(w, gone.tolist()) if not g]
                kept = b" ".join(w)
                for o, v in zip(out, (n, n - len(w), hashlib.sha256(kept).hexdigest(), spans, kept.decode("utf-8", "replace") if with_text else None)):
                    o.append(v)
            cols = [b.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), pa.array(out[3], pa.list_(pa.list_(pa.int32()))), *[pa.array(out[4], pa.string())] * with_text]
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<array<int>>" + ", kept string" * with_text
    return both.mapInArrow(cut, schema)
