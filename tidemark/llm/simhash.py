"""SimHash near-dedup with pigeonhole blocks.

A document's fingerprint has a bit set where more than half of its shingles'
64-bit hashes have it.  Two fingerprints that differ in at most ``d`` bits agree
whole in ``blocks - d`` of ``blocks`` bit blocks at least, so joining on every
choice of that many blocks meets every close pair; the Hamming distance decides.

Copies collapse first: the join runs on distinct fingerprints, each stood for
by its smallest document.  Bucket members are compared inside tasks, and a
bucket of more than ``TILE`` members is dealt to tiles of at most about two
times that, so no bucket is one task's work; a tile returns a spanning forest
of the close pairs it found and never the pairs themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import packed_rows, unpacked, written
from tidemark.llm.components import components
from tidemark.llm.xxh64 import xxh64_spans

BITS = 64
TILE = 2048
_TEXT_BYTES = 128 << 10  # keeps the kernels' arrays in the cache


def fingerprints_of(texts: list[bytes | None], shingle: int) -> np.ndarray:
    """The fingerprint of each text (UTF-8): A-Z lower-cased, words parted by
    white space, ``shingle`` words joined by a space; a text of fewer words is
    one shingle, one without words has fingerprint 0."""
    parts = [b" ".join(t.lower().split()) if t else b"" for t in texts]
    out = np.zeros(len(parts), np.uint64)
    k = 0
    while k < len(parts):  # a cache-sized part at a time
        end, held = k, 0
        while end < len(parts) and (end == k or held + len(parts[end]) <= _TEXT_BYTES):
            held += len(parts[end])
            end += 1
        out[k:end] = _fingerprints(parts[k:end], shingle)
        k = end
    return out


def _fingerprints(parts: list[bytes], shingle: int) -> np.ndarray:
    """``parts`` have single spaces between words."""
    joined = b"\n".join(parts) + b"\n"
    buf = np.frombuffer(joined, np.uint8)
    ends = np.flatnonzero((buf == 32) | (buf == 10))           # a word ends before each
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = buf[ends] == 10
    doc = np.concatenate([[0], np.cumsum(last)[:-1]])
    real = ends > starts
    n_words = np.bincount(doc[real], minlength=len(parts))
    first = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(parts)))[:-1]])
    n_shingles = np.where(n_words == 0, 0, np.maximum(n_words - shingle + 1, 1))
    of = np.repeat(np.arange(len(parts)), n_shingles)
    base = np.cumsum(n_shingles) - n_shingles
    i = first[of] + (np.arange(len(of)) - base[of])
    j = i + np.minimum(shingle, n_words[of]) - 1
    out = np.zeros(len(parts), np.uint64)
    if not len(of):
        return out
    has = np.flatnonzero(n_shingles)
    at = base[has]
    ones = np.zeros((len(has), BITS), np.int64)
    hashes = xxh64_spans(buf, starts[i], ends[j])
    step = 1 << 20  # bits are unpacked in pieces, which begin and end anywhere
    for a in range(0, len(hashes), step):
        piece = hashes[a:a + step]
        bits = np.unpackbits(piece.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        lo = np.searchsorted(at, a, "right") - 1
        hi = np.searchsorted(at, a + len(piece), "left")
        cuts = np.maximum(at[lo:hi] - a, 0)
        ones[lo:hi] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    is_set = ones * 2 > n_shingles[has][:, None]
    packed = np.packbits(is_set, axis=1, bitorder="little")
    out[has] = packed.view("<u8").reshape(-1)
    return out


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, fp`` (the fingerprint as a signed long) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(2).cast(pa.binary()).to_pylist()
                fp = fingerprints_of(texts, shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fp)],
                                                 ["doc_id", "text_hash", "fp"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                       F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, text_hash long, fp long")


def block_keys(distance: int, blocks: int) -> list[int]:
    """Bit masks: every choice of ``blocks - distance`` of ``blocks`` blocks."""
    if not distance < blocks <= BITS:
        raise ValueError("there must be more blocks than differing bits")
    edges = [round(k * BITS / blocks) for k in range(blocks + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(masks, blocks - distance)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _forest(fp: np.ndarray, node: np.ndarray, pairs: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs: each member and its component's smallest node."""
    a, b = pairs
    label = node.copy()
    while len(a):
        low = np.minimum(label[a], label[b])
        if (label[a] == low).all() and (label[b] == low).all():
            break
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
    found = np.flatnonzero(label != node)
    return label[found], node[found]


def _close(fp: np.ndarray, group: np.ndarray, side: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of one group (``group`` is sorted) within ``distance`` bits.
    Rows of a tile between two chunks are compared across the chunks only."""
    left, right = [], []
    i = np.arange(len(fp))
    end = np.searchsorted(group, group, "right")
    d = 1
    while True:
        i = i[i + d < end[i]]
        if not len(i):
            break
        j = i + d
        hit = (np.bitwise_count(fp[i] ^ fp[j]) <= distance) & ((side[i] != side[j]) | (side[i] < 0))
        left.append(i[hit])
        right.append(j[hit])
        d += 1
    return (np.concatenate(left), np.concatenate(right)) if left else (i, i)


def links(classes: DataFrame, distance: int, blocks: int) -> DataFrame:
    """``a, b``: links between the nodes of ``classes`` (``fp, node``; each
    fingerprint once) whose closure is that of all pairs within ``distance``."""
    keys = F.array(*[F.struct(F.lit(k).cast("tinyint").alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("v"))
                     for k, m in enumerate(block_keys(distance, blocks))])
    members = classes.select("fp", "node", F.explode(keys).alias("key")).select("fp", "node", "key.k", "key.v")
    hot = members.groupBy("k", "v").count().filter(F.col("count") > TILE).select(
        "k", "v", F.ceil(F.col("count") / TILE).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    tiled = members.join(hot, ["k", "v"], "left").withColumn("own", F.coalesce(own, F.lit(0)))
    other = F.explode(F.expr("sequence(0, coalesce(chunks, 1) - 1)"))
    tiled = tiled.select("fp", "node", "k", "v", "own", other.alias("other"))
    tiled = tiled.select("k", "v", F.least("own", "other").alias("t1"), F.greatest("own", "other").alias("t2"),
                         F.when(F.col("own") == F.col("other"), -1).otherwise(F.col("own")).alias("side"), "fp", "node")
    # the diagonal tile holds its chunk once; a tile of two chunks compares across them

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.table(batch) if not isinstance(batch, pa.RecordBatch) else pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            cols = [held.column(c).to_numpy() for c in ("k", "v", "t1", "t2")]
            new = np.zeros(len(held), bool)
            for c in cols:
                new[1:] |= c[1:] != c[:-1]
            cut = np.flatnonzero(new)
            if not len(cut) or cut[-1] < 4 * TILE and len(held) < 64 * TILE:
                continue
            yield from done(held.slice(0, cut[-1]), np.cumsum(new[:cut[-1]]))
            held = held.slice(cut[-1])
        if held is not None and len(held):
            new = np.zeros(len(held), bool)
            for c in [held.column(c).to_numpy() for c in ("k", "v", "t1", "t2")]:
                new[1:] |= c[1:] != c[:-1]
            yield from done(held, np.cumsum(new))

    def done(part: pa.Table, group: np.ndarray) -> Iterator[pa.RecordBatch]:
        fp, node, side = (part.column(c).to_numpy() for c in ("fp", "node", "side"))
        a, b = _forest(fp, node, _close(fp.view(np.uint64), group, side, distance))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    dealt = tiled.repartition("k", "v", "t1", "t2").sortWithinPartitions("k", "v", "t1", "t2")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def block_count(classes: int, distance: int) -> int:
    """The number of blocks with the least work for so many fingerprints: a
    fingerprint has a key for every choice of ``blocks - distance`` blocks, and
    meets by chance the others whose bits agree there."""
    def work(blocks: int) -> float:
        return math.comb(blocks, distance) * (1 + classes / 2 ** (64 * (blocks - distance) / blocks))

    return min(range(distance + 1, 65), key=work)


def near_duplicates(docs: DataFrame, shingle: int, distance: int, blocks: int | None = None,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, fp, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``distance`` bits.  Null and empty texts have fingerprint 0 and link like
    any other.  Repeated rows come back as often.  A row with a null doc_id
    takes its class's component (null if the class has no other id).
    """
    prints = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("node")), "classes")
    blocks = blocks or block_count(classes.count(), distance)
    found = components(links(classes.filter("node is not null"), distance, blocks))
    # written, so that the join can split the rows of a very frequent fingerprint over tasks
    rooted = written(classes.join(found, "node", "left")
                     .select("fp", F.coalesce("component", "node").alias("component_id")), "components")
    return prints.join(rooted, "fp").select("doc_id", "text_hash", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int, distance: int, blocks: int | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is their component's smallest, once each.

    Of rows that agree in id and text one stays.  Rows without an id stay, once
    for each text, where their fingerprint's class has no id at all.
    """
    found = near_duplicates(docs, shingle, distance, blocks, id_col, text_col)
    first = (found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
             .select(F.coalesce("doc_id", F.lit(-1)).alias("doc"), F.col("doc_id").isNull().alias("none"),
                     F.col("text_hash").alias("hash")).distinct())
    keyed = docs.select(packed_rows(docs).alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("doc"),
                        F.col(id_col).isNull().alias("none"), F.xxhash64(text_col).alias("hash"))
    keys = ["doc", "none", "hash"]
    kept = keyed.join(first, keys, "left_semi")
    again = Window.partitionBy(*keys).orderBy(*keys)
    return (kept.withColumn("copy", F.row_number().over(again)).filter(F.col("copy") == 1)
            .select(*unpacked(docs, "row")))
