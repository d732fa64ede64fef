"""Importance resampling against a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from helpers import awkward, docs, frame, prose

from tidemark.llm import resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def grams_of(text, n):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = WORD.findall(lowered)
    return words, [" ".join(words[i:i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def slow(rows, target, grams, buckets, percent, least, seed):
    """``{id: (n_features, weight, score, rank)}`` for rows with distinct ids."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in rows for f in grams_of(t, grams)[1])
    t = Counter(bucket(f) for x in target for f in grams_of(x, grams)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    out, pool = {}, []
    for doc, text in rows:
        words, features = grams_of(text, grams)
        weight = sum(gain[bucket(f)] for f in features)
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[doc] = [len(features), weight, score, None]
        if len(words) >= least:
            pool.append((-score, doc is None, doc or 0, doc))
    for rank, x in enumerate(sorted(pool)[:percent * len(pool) // 100], 1):
        out[x[3]][3] = rank
    return {k: tuple(v) for k, v in out.items()}


def as_dict(df):
    return {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("grams", [1, 2, 3])
def test_features_equal_plain_words(grams):
    texts = ["a B a b", None, "", "--", "é É x9Z", "one", "A b\x7fc퟿d e", " a  b ", "K i̇ İ"]
    words, text, bucket = resampling.features(pa.array(texts), grams, 997)
    for i, t in enumerate(texts):
        plain = grams_of(t, grams)
        assert words[i] == len(plain[0])
        assert Counter(bucket[text == i].tolist()) == Counter(zlib.crc32(f.encode()) % 997 for f in plain[1])


@pytest.mark.parametrize("grams", [1, 2])
def test_equals_brute_force(spark, grams):
    texts = [*prose(5, 150, words=(0, 60)), None, "", "ÄÖ é" * 9, "w1 W1 w1 " * 20]
    target = prose(6, 20, vocabulary=15)
    rows = resampling.resample(docs(spark, texts), docs(spark, target), grams, 50, 30, 20, 7)
    want = slow(list(enumerate(texts)), target, grams, 50, 30, 20, 7)
    assert as_dict(rows) == want
    assert sum(v[3] is not None for v in want.values()) > 20


def test_ties_go_to_the_smaller_id(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(resampling, "gumbel", lambda seed, c: F.lit(0).cast("long"))
    base = docs(spark, ["x y z"] * 30, first=100)
    rows = resampling.resample(base, base, 1, 10, 50, 1, 1).collect()
    assert {r.doc_id: r["rank"] for r in rows if r["rank"]} == {100 + i: i + 1 for i in range(15)}


def test_awkward_rows_and_empty_tables(spark):
    base = awkward(spark, docs(spark, prose(8, 20, words=(20, 40))))
    rows = resampling.resample(base, base, 1, 100, 50, 20, 3).collect()
    assert len(rows) == base.count()
    drawn = sorted(r["rank"] for r in rows if r["rank"] is not None)
    able = sum(r.n_words >= 20 for r in rows)
    assert drawn == list(range(1, able // 2 + 1))
    assert [(r.n_features, r.weight) for r in rows if r.doc_id == 900] == [(0, 0)]
    assert [r.n_features for r in rows if r.doc_id == 902] == [30000]
    empty = frame(spark, [])
    assert resampling.resample(empty, base, 1, 100, 50, 20, 3).count() == 0
    assert resampling.resample(base, empty, 1, 100, 50, 20, 3).count() == base.count()


def test_a_target_like_some_documents_draws_them(spark):
    like, other = ["alpha beta gamma delta " * 10] * 20, ["one two three four " * 10] * 180
    rows = resampling.resample(docs(spark, like + other), docs(spark, ["gamma alpha delta"]), 1, 1000, 10, 20, 1)
    assert {r.doc_id for r in rows.collect() if r["rank"]} == set(range(20))
