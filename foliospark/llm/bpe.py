"""BPE encoding, decoding and token counts for a byte-level tokenizer file.

Encoding speculates and verifies: greedy longest matches propose the tokens of a pre-token, every adjacent pair is
tested in one vectorised look-up, and only pre-tokens with an incompatible pair are merged exactly. A sequence is
the BPE result exactly if each adjacent pair is, so verified proposals need no merging.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, kept

CACHE = 200_000  # pre-tokens a worker remembers; beyond that it keeps those of the block at hand
SPACE = r"\p{White_Space}"


def byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for U+0100 onwards."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizer:
    """A byte-level BPE tokenizer read from the text of a tokenizers JSON file."""

    def __init__(self, spec: str):
        data, letters = json.loads(spec), byte_letters()
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        as_bytes = lambda s: bytes(letters[c] for c in s)
        self.ids = {as_bytes(t): i for t, i in data["model"]["vocab"].items() if t not in self.special}
        self.bytes = {i: b for b, i in self.ids.items()} | {i: s.encode() for s, i in self.special.items()}
        self.single = [self.ids[bytes([b])] for b in range(256)]
        reach = [0] * 65536  # longest token by its first two bytes
        for b in self.ids:
            if len(b) > 1:
                reach[b[0] << 8 | b[1]] = max(reach[b[0] << 8 | b[1]], len(b))
        self.reach = reach
        self.merges = {}
        for rank, m in enumerate(data["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            a, b = as_bytes(a), as_bytes(b)
            self.merges.setdefault((self.ids[a], self.ids[b]), (rank, self.ids[a + b]))
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pieces = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|{SPACE}+(?!\P{{White_Space}})|{SPACE}+").findall
        self.pair_keys, self.pair_ok = np.empty(0, np.int64), np.empty(0, bool)
        self.known: dict[str, str] = {}
        self.odd: dict[str, bytes] = {}  # of the known, those whose tokens don't decode to themselves

    def segments(self, text: str) -> list[str]:
        """Pre-tokens in order; special strings stand alone."""
        if self.split_special is None or not any(s in text for s in self.special):
            return self.pieces(text)
        out: list[str] = []
        for i, part in enumerate(self.split_special.split(text)):
            out += [part] if i % 2 else self.pieces(part)
        return out

    def merge(self, raw: bytes) -> list[int]:
        """Exact merging: the lowest rank first, leftmost first; a heap over a linked list, so n log n."""
        ids: list = [self.single[b] for b in raw]
        n = len(ids)
        if n <= 24:  # short words: the least rank by a scan
            merges = self.merges
            pairs = [merges.get(p) for p in zip(ids, ids[1:])]
            while True:
                best, at = None, -1
                for i, m in enumerate(pairs):
                    if m is not None and (best is None or m[0] < best[0]):
                        best, at = m, i
                if best is None:
                    return ids
                ids[at : at + 2] = [best[1]]
                del pairs[at]
                if at:
                    pairs[at - 1] = merges.get((ids[at - 1], best[1]))
                if at < len(pairs):
                    pairs[at] = merges.get((best[1], ids[at + 1]))
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := self.merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = new, None, after[j]
            if after[j] < n:
                before[after[j]] = i
            for left in (before[i], i):
                if left >= 0 and (right := after[left]) < n and (m := self.merges.get((ids[left], ids[right]))):
                    heapq.heappush(heap, (m[0], left, ids[left], ids[right], m[1]))
        return [x for x in ids if x is not None]

    def greedy(self, raw: bytes) -> list[int]:
        out, at, n, ids, reach = [], 0, len(raw), self.ids, self.reach
        while at < n:
            end = min(n, at + (reach[raw[at] << 8 | raw[at + 1]] or 1)) if at + 1 < n else n
            while raw[at:end] not in ids:
                end -= 1
            out.append(ids[raw[at:end]])
            at = end
        return out

    def compatible(self, keys: np.ndarray) -> np.ndarray:
        """For pairs (left << 32 | right): do they stay two tokens when merged exactly? Verdicts are kept."""
        own = np.unique(keys)
        at = np.searchsorted(self.pair_keys, own)
        new = own[self.pair_keys[np.minimum(at, len(self.pair_keys) - 1)] != own] if len(self.pair_keys) else own
        if len(new):
            told = np.fromiter((self.merge(self.bytes[k >> 32] + self.bytes[k & 0xFFFFFFFF]) == [k >> 32, k & 0xFFFFFFFF] for k in new.tolist()), bool, len(new))
            at = np.searchsorted(self.pair_keys, new)
            self.pair_keys, self.pair_ok = np.insert(self.pair_keys, at, new), np.insert(self.pair_ok, at, told)
        return self.pair_ok[np.searchsorted(self.pair_keys, keys)]

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        raws = [p.encode("utf-8") for p in pieces]
        found = [self.greedy(r) if p not in self.special else [self.special[p]] for p, r in zip(pieces, raws)]
        many = [i for i, f in enumerate(found) if len(f) > 1]
        if many:
            flat = np.fromiter((x for i in many for x in found[i]), np.int64)
            ends = np.cumsum([len(found[i]) for i in many])
            keys = (flat[:-1] << 32) | flat[1:]
            inner = np.ones(len(keys), bool)
            inner[ends[:-1] - 1] = False
            ok = np.ones(len(keys) + 1, bool)
            ok[:-1][inner] = self.compatible(keys[inner])
            good = np.logical_and.reduceat(ok, np.concatenate([[0], ends[:-1]]))
            for i, fine in zip(many, good):
                if not fine:
                    found[i] = self.merge(raws[i])
        return found

    def learn(self, pieces: set[str]) -> None:
        if len(self.known) + len(pieces) > CACHE:
            self.known = {p: self.known[p] for p in pieces if p in self.known}
            self.odd = {p: self.odd[p] for p in pieces if p in self.odd}
        todo = [p for p in pieces if p not in self.known]
        for p, ids in zip(todo, self.encode_pieces(todo)):
            self.known[p] = ",".join(map(str, ids))
            if (back := self.decode(ids)) != p.encode("utf-8"):
                self.odd[p] = back

    def decoded(self, pieces: list[str]) -> bytes:
        """What the tokens of known pieces decode to, one after the other."""
        if not self.odd:
            return "".join(pieces).encode("utf-8")
        return b"".join([self.odd[p] if p in self.odd else p.encode("utf-8") for p in pieces])

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def encode(self, text: str) -> list[int]:
        return [x for ids in self.encode_pieces(self.segments(text)) for x in ids]


def loaded(spec: str) -> Tokenizer:
    """One tokenizer, with its caches, for each worker process and file, until a stage of another kind runs there."""
    return kept(("tokenizer", hash(spec)), lambda: Tokenizer(spec))


def blocks(texts: list, size: int = 1_000_000):
    """Slices of about ``size`` characters, at least one text each."""
    at = 0
    while at < len(texts):
        end, held = at, 0
        while end < len(texts) and (end == at or held + len(texts[end] or "") <= size):
            held += len(texts[end] or "")
            end += 1
        yield at, end
        at = end


def spec_of(docs: DataFrame, path: str):
    """The tokenizer file's text, broadcast (a file of the tokenizer, a few MB whatever the data)."""
    with open(path, encoding="utf-8") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def round_trip(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids, comma-joined) of every text.

    Null text counts as empty: no tokens, the hash of an empty string. Repeated rows are encoded each; a null
    doc_id stays; an empty table gives no rows; other columns are not read. Special strings in a text are special
    tokens, as the library has it.
    """
    spec = spec_of(docs, path)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]

    def run(batches):
        t = loaded(spec.value)
        for b in batches:
            texts = b.column(1).to_pylist()
            for i, j in blocks(texts):
                lists = [t.segments(x or "") for x in texts[i:j]]
                t.learn(set().union(*lists))
                counts, ids, back, joint = [], [], [], []
                for pieces in lists:
                    joined = ",".join(map(t.known.__getitem__, pieces))
                    counts.append(joined.count(",") + bool(joined))
                    ids.append(hashlib.sha256(joined.encode()).hexdigest())
                    back.append(hashlib.sha256(t.decoded(pieces).decode("utf-8", "replace").encode()).hexdigest())
                    joint.append(joined)
                cols = [b.column(0).slice(i, j - i), pa.array(counts, pa.int64()), pa.array(ids), pa.array(back), *[pa.array(joint)] * with_ids]
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids string" * with_ids
    return in_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, schema, keep=True)


def frequent(docs: DataFrame, path: str, size: int = 32_768) -> dict[str, int]:
    """Token counts of about the ``size`` most frequent pre-tokens, from partial counts over all texts.

    Only the choice of entries is approximate (a task reports its own ``size`` most frequent); each value is exact.
    """
    spec = spec_of(docs, path)

    def run(batches):
        t, seen = loaded(spec.value), Counter()
        for b in batches:
            for x in b.column(0).to_pylist():
                seen.update(t.segments(x or ""))
            if len(seen) > 8 * size:
                seen = Counter(dict(seen.most_common(4 * size)))
        top = seen.most_common(size)
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in top], pa.string()), pa.array([v for _, v in top], pa.int64())], ["piece", "n"])

    top = docs.select("text").mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(size).collect()
    pieces = [r["piece"] for r in top if len(r["piece"]) <= 64]
    return dict(zip(pieces, map(len, Tokenizer(spec.value).encode_pieces(pieces))))


def token_counts(docs: DataFrame, path: str, limit: int = 512, table_size: int = 32_768) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every text, without a shuffle of pre-tokens.

    Lengths come from a broadcast table of frequent pre-tokens (``table_size`` entries of at most 64 characters),
    else from the worker's own cache, which encodes what it misses. Nulls, repeats and empty tables as in
    ``round_trip``.
    """
    spec = spec_of(docs, path)
    table = docs.sparkSession.sparkContext.broadcast(frequent(docs, path, table_size))
    names = ["doc_id", "n_bytes", "n_tokens", "over_limit"]

    def run(batches):
        t, first, second = loaded(spec.value), table.value, {}
        for b in batches:
            texts = b.column(1).to_pylist()
            for i, j in blocks(texts):
                lists = [t.segments(x or "") for x in texts[i:j]]
                here = set().union(*lists)
                misses = [p for p in here if p not in first and p not in second]
                if len(second) + len(misses) > CACHE:
                    second = {p: second[p] for p in here if p in second}
                second.update(zip(misses, map(len, t.encode_pieces(misses))))
                counts = [sum([first[p] if p in first else second[p] for p in pieces]) for pieces in lists]
                size = [len((x or "").encode("utf-8")) for x in texts[i:j]]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(size, pa.int64()), pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
