"""Shards of near-equal size from indivisible groups: best-fit decreasing.

Groups (equal texts) are placed by decreasing size; each enters the bin whose
remaining capacity is the tightest that still holds it, found in a balanced
tree over the open bins.  The capacity is the least found for which all groups
fit the asked number of shards, so shards end near equal.

Every group is an item, and what the driver sees is bounded by parameters and
not by the corpus:

* a group of at least ``1 / parts`` of a shard comes with its own size (there
  are at most ``shards * parts`` of them);
* smaller groups come as a histogram: how many groups each size class has, and
  their bytes.  A class is one size up to ``EXACT`` bytes and a range of sizes
  within ``1 / EXACT`` above.  Classes are placed as counts, and the groups take
  the places of their class by rank;
* an item larger than the mean of the shards still open takes a shard of its
  own, and the others share the rest;
* a group of several rows that is larger than a shard cannot stay in one; only
  such a group is split, by row, into pieces of ``1 / parts`` of a shard.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import numbered, slots, utf8, written

ROW_BYTES = 8
EXACT = 4096      # sizes below are classes of their own


class CapacityTree:
    """Open bins ordered by (remaining capacity, bin) in a treap.

    Nodes are ``[remaining, bin, priority, left, right]``; priorities are a
    checksum of the key, so the shape depends on the content alone.
    """

    def __init__(self) -> None:
        self.root = None

    def add(self, remaining: int, bin_no: int) -> None:
        node = [remaining, bin_no, zlib.crc32(f"{remaining}:{bin_no}".encode()), None, None]
        low, high = self._split(self.root, (remaining, bin_no))
        self.root = self._merge(self._merge(low, node), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least remaining capacity >= size."""
        found, node = None, self.root
        while node:
            if node[0] >= size:
                found, node = (node[0], node[1]), node[3]
            else:
                node = node[4]
        if found:
            low, rest = self._split(self.root, found)
            _, high = self._split(rest, (found[0], found[1] + 1))
            self.root = self._merge(low, high)
        return found

    def _split(self, node, key):
        """Trees of the keys below ``key`` and from ``key`` on."""
        if node is None:
            return None, None
        if (node[0], node[1]) < key:
            left, right = self._split(node[4], key)
            node[4] = left
            return node, right
        left, right = self._split(node[3], key)
        node[3] = right
        return left, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[2] > b[2]:
            a[4] = self._merge(a[4], b)
            return a
        b[3] = self._merge(a, b[3])
        return b


def best_fit(items: list[tuple[float, int]], capacity: float, most: int | None = None) -> list[list[tuple[int, int]]] | None:
    """For each item ``(size, count)`` the bins it enters as ``(bin, count)``;
    sizes descend and none exceeds ``capacity``.  The bin that an item enters
    stays the tightest for its equals, so they follow while they fit.  None as
    soon as more than ``most`` bins would be needed."""
    tree, placed, n = CapacityTree(), [], 0
    for size, count in items:
        into = []
        while count:
            found = tree.take_tightest(size)
            if found is None:
                if n == most:
                    return None
                found, n = (capacity, n), n + 1
            fits = min(count, max(1, int(found[0] // size)))
            into.append((found[1], fits))
            count -= fits
            tree.add(found[0] - size * fits, found[1])
        placed.append(into)
    return placed


def fill(items: list[tuple[float, int]], shards: int) -> list[list[tuple[int, int]]]:
    """Best fit of ``items`` (sizes descend) with the least capacity found that
    needs at most ``shards`` bins.

    Items above the mean of the bins left have one to themselves.  What few or
    coarse items leave uneven is levelled (:func:`_level`)."""
    placed, left, total, k, used = [[] for _ in items], [n for _, n in items], sum(s * n for s, n in items), 0, 0
    while k < len(items) and used + 1 < shards and items[k][0] > total / (shards - used):
        used += 1
        placed[k].append((shards - used, 1))
        total -= items[k][0]
        left[k] -= 1
        k += not left[k]
    rest = [(size, n) for (size, _), n in zip(items[k:], left[k:])]
    for into, more in zip(placed[k:], _least(rest, shards - used)):
        into += more
    return _level(items, placed, shards)


def _least(items: list[tuple[float, int]], shards: int) -> list[list[tuple[int, int]]]:
    """Best fit with the least capacity found."""
    if not items:
        return []
    low = max(sum(s * n for s, n in items) / shards, items[0][0])
    step, placed, capacity = max(1.0, low / 4096), None, low
    while placed is None:
        placed = best_fit(items, capacity, shards)
        if placed is None:
            low, capacity, step = capacity, capacity + step, step * 2
    grain = max(1.0, capacity / 8192)
    while capacity - low >= grain:
        middle = (low + capacity) / 2
        tried = best_fit(items, middle, shards)
        if tried is None:
            low = middle
        else:
            placed, capacity = tried, middle
    return placed


def _level(items: list[tuple[float, int]], placed: list[list[tuple[int, int]]], shards: int) -> list[list[tuple[int, int]]]:
    """Move items to the emptiest bin from the fullest that has one smaller than
    the gap between them, until none has or the gap is below a thousandth of the
    mean.  Every move makes the two bins more equal; a bin that best fit left
    empty is filled this way."""
    bins: list[dict[int, int]] = [{} for _ in range(shards)]
    for k, into in enumerate(placed):
        for b, n in into:
            bins[b][k] = bins[b].get(k, 0) + n
    load = [sum(items[k][0] * n for k, n in held.items()) for held in bins]
    for _ in range(64 * shards):
        low = min(range(shards), key=lambda b: load[b])
        for full in sorted(range(shards), key=lambda b: -load[b]):
            gap = load[full] - load[low]
            fits = [k for k in bins[full] if items[k][0] < gap]
            if fits or gap < sum(load) / shards / 1000:
                break
        if not fits or gap < sum(load) / shards / 1000:
            break
        k = min(fits, key=lambda k: (abs(items[k][0] - gap / 2), k))
        n = min(bins[full][k], max(1, int(gap / 2 // items[k][0])))
        for b, more in ((full, -n), (low, n)):
            bins[b][k] = bins[b].get(k, 0) + more
            load[b] += more * items[k][0]
        if not bins[full][k]:
            del bins[full][k]
    return [[(b, held[k]) for b, held in enumerate(bins) if k in held] for k in range(len(items))]


def size_class(size: str) -> Column:
    """Classes by which small groups are counted: one size below ``EXACT``, and
    above the leading bits of the size."""
    shift = f"greatest(0, length(bin({size})) - {EXACT.bit_length()})"
    return F.expr(f"{shift} * {1 << 40}L + shiftright({size}, {shift})")


def balanced_shards(docs: DataFrame, shards: int, parts: int = 500,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 8; a null text counts as empty and
    groups with the empty texts.  Rows that agree in id and text are
    interchangeable.  ``slot`` numbers a shard's rows from 0 without gaps.  A row
    larger than a shard has one to itself.  An empty table gives no rows; other
    columns are not read.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = written(docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(utf8(F.col(text_col))).alias("text_crc32"),
        F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2"),
        F.monotonically_increasing_id().alias("row")), "shard-rows")  # written, so a row keeps its number
    total, n_rows = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    share = max(1, math.ceil(total / shards))
    unit = max(1, math.ceil(share / parts))
    groups = written(rows.groupBy("h1", "h2").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")),
                     "shard-groups")
    split = (F.col("bytes") > share) & (F.col("rows") > 1)
    large = groups.filter(F.col("bytes") >= unit).withColumn(  # at most shards * parts groups
        "pieces", F.when(split, F.ceil(F.col("bytes") / unit)).otherwise(1).cast("long"))
    of_large = (rows.join(F.broadcast(large.select("h1", "h2", "pieces")), ["h1", "h2"])
                .withColumn("piece", F.pmod(F.xxhash64("row"), "pieces")))
    own = of_large.groupBy("h1", "h2", "piece").agg(F.sum("size").alias("bytes")).collect()  # 3 * shards * parts
    small = groups.filter(F.col("bytes") < unit).withColumn("class", size_class("bytes"))
    counted = (small.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
               .collect())  # at most EXACT for each power of two
    items = sorted([(r.bytes, 1, (r.h1, r.h2, r.piece)) for r in own] +
                   [(r.bytes / r.n, r.n, r["class"]) for r in counted],
                   key=lambda i: (-i[0], isinstance(i[2], tuple), i[2]))
    placed = fill([i[:2] for i in items], shards)
    of_piece = spark.createDataFrame([(*i[2], into[0][0]) for i, into in zip(items, placed) if isinstance(i[2], tuple)],
                                     "h1 long, h2 long, piece long, shard int")
    places = [(i[2], into) for i, into in zip(items, placed) if not isinstance(i[2], tuple)]
    names = ["doc_id", "size", "text_crc32", "row", "shard"]
    big = of_large.join(F.broadcast(of_piece), ["h1", "h2", "piece"]).select(*names)  # as many as `own`
    tiny = rows.join(_by_rank(small, places, n_rows), ["h1", "h2"]).select(*names)
    return numbered(big.unionByName(tiny), ["shard"], ["doc_id", "text_crc32", "size", "row"], "slot",
                    slots(spark, n_rows)).drop("row")


def _by_rank(small: DataFrame, places: list[tuple[int, list[tuple[int, int]]]], rows: int) -> DataFrame:
    """``h1, h2, shard``: the group of rank r in its class takes the class's r-th place."""
    ranked = numbered(small.select("class", "h1", "h2"), ["class"], ["h1", "h2"], "rank",
                      slots(small.sparkSession, rows))
    classes = {c: k for k, (c, _) in enumerate(sorted(places))}
    flat = [(classes[c], b, n) for c, into in sorted(places) for b, n in into]
    held = np.array([n for _, _, n in flat], np.int64)
    begin = np.cumsum(held) - held
    first = np.zeros(len(classes) + 1, np.int64)
    for (k, _, _), at in zip(reversed(flat), reversed(begin.tolist())):
        first[k] = at
    shard = np.array([b for _, b, _ in flat], np.int32)
    known = np.array(sorted(classes), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = np.searchsorted(known, batch.column("class").to_numpy())
            place = first[k] + batch.column("rank").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("h1"), batch.column("h2"), pa.array(shard[np.searchsorted(begin, place, "right") - 1])],
                ["h1", "h2", "shard"])

    return ranked.mapInArrow(run, "h1 long, h2 long, shard int")
