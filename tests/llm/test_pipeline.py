"""The pipeline's stages against plain versions, each on its own input."""

from __future__ import annotations

from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from foliospark.llm.common import stored

from . import brute
from .test_operators import corpus

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def results(spark):
    rows = [(r[0], r[1], r[2], r[3], len(r[1] or "")) for r in corpus(11, 240)]
    out = [spark.createDataFrame(rows, COLUMNS).repartition(3)]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], "")))
    return [[tuple(r) for r in df.collect()] for df in out]


def test_stage_columns(spark, results):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "secret scan", "source mixing", "BPE encoding"]
    assert all(len(r) == 5 for rows in results[:-1] for r in rows)


def test_quality_keeps_clean_documents(results):
    assert Counter(results[1]) == Counter(r for r, kept in zip(results[0], brute.kept([r[1:4] for r in results[0]])) if kept)


def test_one_of_each_group_stays(results):
    before, after = results[1], results[2]
    assert not Counter(after) - Counter(before)
    sets = [brute.shingles(r[1], 5) for r in before]
    root = list(range(len(before)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and 10 * len(a & b) >= 8 * len(a | b):
                root[find(i)] = find(j)
    groups: dict[int, list] = {}
    for i, r in enumerate(before):
        groups.setdefault(find(i), []).append(r)
    kept = Counter(after)
    assert len(after) == len(groups)
    assert all(sum((Counter(v) & kept).values()) >= 1 for v in groups.values())


def test_secrets_are_masked(results):
    before, after = results[2], results[3]
    assert len(before) == len(after) and any(brute.secrets(r[1]) for r in before)
    assert not any(brute.secrets(r[1]) for r in after)
    clean = Counter(r for r in before if not brute.secrets(r[1]) and "user=" not in r[1])
    assert not clean - Counter(after)
    assert all(r[4] == len(r[1]) for r in after)


def test_mix_repeats_documents(results):
    before, after = Counter(results[3]), Counter(results[4])
    assert not set(after) - set(before) and all(n <= 3 * before[r] for r, n in after.items())
    size = lambda c: sum(len(brute.words(r[1])) * n for r, n in c.items())
    assert abs(size(after) - size(before)) < 0.1 * size(before)


def test_encoding(results):
    lib, texts = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), Counter((r[0], r[1]) for r in results[4])
    want = Counter()
    for (d, t), n in texts.items():
        ids = lib.encode(t, add_special_tokens=False).ids
        want[d, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(t), ",".join(map(str, ids))] += n
    assert Counter(results[5]) == want
