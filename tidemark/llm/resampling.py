"""Importance resampling toward a target distribution over hashed n-grams.

Arrow kernels do the text work of a batch: ``ascii_lower``,
``split_pattern_regex``, ``list_flatten`` and ``dictionary_encode``.  Shifted
dictionary indices form the n-grams, the CRC-32 is taken once per distinct word
and once per distinct n-gram of the batch, and a document's weight is a take of
the buckets' gains summed over its segment.  What is counted over the corpus is
one number per bucket and task.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written
from tidemark.operators.ordering import numbered_in_order

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"   # after lower-casing: all of ASCII but letters and digits
_TEXTS = 512                                   # texts a kernel call takes


def features(texts: pa.Array, grams: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(words, text, bucket)``: how many words each text has, and for every
    run of 1 to ``grams`` words the place of its text and its bucket."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts.fill_null("")), pattern=NOT_WORD)
    words, text = pc.list_flatten(parts), pc.list_parent_indices(parts)
    real = pc.not_equal(words, "")  # a separator at either end leaves one
    coded = words.filter(real).dictionary_encode()
    text = text.filter(real).to_numpy().astype(np.int64)
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    spoken = [w.encode() for w in coded.dictionary.to_pylist()]
    crc = np.array([zlib.crc32(w) for w in spoken], np.int64)
    last = code                                     # the word at each place
    texts_of, buckets_of = [text], [crc[code] % buckets if len(code) else code]
    for n in range(2, grams + 1):
        inside = text[n - 1:] == text[:len(text) - n + 1] if len(text) >= n else np.zeros(0, bool)
        # the runs of n - 1 words that another word of the same text follows
        pair = code[:len(inside)] * len(spoken) + last[n - 1:][:len(inside)]
        distinct, of = np.unique(pair, return_inverse=True)
        longer = np.array([zlib.crc32(b" " + spoken[p % len(spoken)], int(crc[p // len(spoken)]))
                           for p in distinct.tolist()], np.int64)
        code, crc = of.astype(np.int64), longer
        texts_of.append(text[:len(inside)][inside])
        buckets_of.append((crc[code] % buckets)[inside] if len(code) else code)
    return np.bincount(text, minlength=len(texts)), np.concatenate(texts_of), np.concatenate(buckets_of)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, _TEXTS):
        yield batch.slice(at, _TEXTS)


def bucket_counts(docs: DataFrame, text_col: str, grams: int, buckets: int) -> DataFrame:
    """``bucket, n``: how many features of all texts each bucket has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in _parts(batch):
                counts += np.bincount(features(part.column(0), grams, buckets)[2], minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], ["bucket", "n"])

    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """``floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B))))`` of every bucket."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for counts, into in ((docs, s), (target, t)):
        for r in counts.collect():  # at most one row per bucket
            into[r.bucket] = r.n
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def weighted(docs: DataFrame, gains: np.ndarray, id_col: str, text_col: str, grams: int) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` for every row of ``docs``."""
    given = docs.sparkSession.sparkContext.broadcast(gains)  # one number per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = given.value
        for batch in batches:
            for part in _parts(batch):
                words, text, bucket = features(part.column(1), grams, len(gain))
                order = np.argsort(text, kind="stable")
                counts = np.bincount(text, minlength=part.num_rows)
                some = np.flatnonzero(counts)
                weight = np.zeros(part.num_rows, np.int64)
                if len(some):
                    begin = (np.cumsum(counts) - counts)[some]
                    weight[some] = np.add.reduceat(gain.take(bucket[order]), begin)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(words.astype(np.int64)), pa.array(counts.astype(np.int64)), pa.array(weight)],
                    ["doc_id", "n_words", "n_features", "weight"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(seed: int, id_col: str) -> Column:
    """``floor(-1000 ln(-ln u))`` at the number u that seed and id hash to."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    bits = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((bits + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, grams: int, buckets: int, percent: int, least_words: int, seed: int,
             id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """``doc_id, n_features, weight, score, rank, n_words`` for every row of ``docs``.

    Of the N rows with at least ``least_words`` words the ``floor(percent * N / 100)``
    of the highest scores are drawn, without replacement, and have a ``rank``
    from 1; the others' is null.  Ties go to the smaller id; a null id comes
    last and draws as the id ''.  A null or empty text has no features and
    weight 0.  Rows that share an id draw the same number, and rows that agree
    in id and score are ranked in any order.  Empty tables give no rows; an
    empty target gives gains from its zero counts.  Other columns are not read.
    """
    gains = bucket_gains(bucket_counts(docs, text_col, grams, buckets),
                         bucket_counts(target, target_col, grams, buckets), buckets)
    rows = weighted(docs, gains, id_col, text_col, grams)
    scored = rows.withColumn("score", F.col("weight") + gumbel(seed, "doc_id"))
    # written, as ordering reads its rows twice: once for the ranges
    scored = written(scored.withColumn("drawable", F.col("n_words") >= least_words), "scored")
    ordered = numbered_in_order(
        scored,
        [F.col("drawable").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "place")
    drawn = percent * ordered.filter("drawable").count() // 100
    return ordered.select("doc_id", "n_features", "weight", "score",
                          F.when(F.col("drawable") & (F.col("place") <= drawn), F.col("place")).alias("rank"), "n_words")
