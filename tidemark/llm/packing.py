"""Packing documents into sequences: shortest pack first over the histogram.

Documents are tokenized and cut into full sequences and a rest.  The counts of
the pieces' lengths (one number for each length up to the sequence size) go to
the driver, where lengths are placed longest first: each time the pattern with
the most space left takes the length, for as many packs as both have, and the
pattern's count is split if it had more.  A length that no pattern has room for
opens new packs.  A length step leaves at most three patterns more than before,
so the patterns are bounded by the sequence size whatever the corpus.

Pieces of one length are numbered by rank in the cluster, and rank ``r`` of
length ``L`` takes the ``r``-th place that the patterns keep for ``L``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import numbered, slots, written
from tidemark.llm.tokens import Encoder


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[int, dict[int, int]]]:
    """Packing patterns ``(count, {length: times})`` that hold every piece."""
    by_space: dict[int, list[tuple[int, dict[int, int]]]] = {}
    widest = 0  # no pattern has more space

    def put(space: int, count: int, pattern: dict[int, int]) -> None:
        nonlocal widest
        if count:
            by_space.setdefault(space, []).append((count, pattern))
            widest = max(widest, space)

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if not 0 < length <= size:
            raise ValueError(f"a piece of {length} does not fit a sequence of {size}")
        while left:
            while widest and not by_space.get(widest):
                widest -= 1
            if widest >= length:
                count, pattern = by_space[widest].pop()
                used, space = min(count, left), widest
                put(space, count - used, pattern)
                put(space - length, used, {**pattern, length: pattern.get(length, 0) + 1})
                left -= used
            else:  # new packs; each is the shortest until it is full of this length
                most = size // length
                put(size - most * length, left // most, {length: most})
                if left % most:
                    put(size - (left % most) * length, 1, {length: left % most})
                left = 0
    return [x for space in sorted(by_space) for x in by_space[space]]


def places(patterns: list[tuple[int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """The patterns by length: entry ``e`` keeps ``times`` places of ``length``
    from ``offset`` on in each of ``count`` sequences from ``sequence`` on.
    ``begin`` is the entry's first place in the order (length, entry), and
    ``base[L]`` the first place of length ``L``."""
    rows, sequence = [], 0
    for count, pattern in patterns:
        offset = 0
        for length in sorted(pattern, reverse=True):
            rows.append((length, sequence, pattern[length], offset, count * pattern[length]))
            offset += length * pattern[length]
        sequence += count
    rows.sort()
    length, first, times, offset, held = (np.array(c, np.int64) for c in zip(*rows)) if rows else [np.zeros(0, np.int64)] * 5
    begin = np.cumsum(held) - held
    base = np.zeros(int(length.max(initial=0)) + 1, np.int64)
    base[length[::-1]] = begin[::-1]
    return {"begin": begin, "sequence": first, "times": times, "offset": offset, "base": base}


def _narrow(ids: np.ndarray) -> bytes:
    """``ids`` in two bytes each if all fit, else in four; the length tells which."""
    return (ids.astype("<u2") if ids.max() < 1 << 16 else ids).tobytes()


def _wide(data: bytes, length: int) -> bytes:
    return np.frombuffer(data, "<u2").astype("<u4").tobytes() if len(data) == 2 * length else data


def token_pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int,
                 id_col: str = "doc_id", text_col: str = "text", narrow: bool = False) -> DataFrame:
    """``doc_id, start, length, ids, doc_tokens, row``: documents cut at ``size``.

    ``row`` is one number for all pieces of a row of ``docs``, so copies of a
    document can be told apart (another number in another run).  ``ids`` has the piece's token ids as little-endian 32-bit numbers, with
    ``narrow`` as 16-bit ones where all of a piece fit.  A null text is an empty
    one, whose only id is ``end_id``.
    """
    with open(tokenizer, encoding="utf-8") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(content.value).encode
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                rows = []
                for doc, text, row in zip(*(part.column(c).to_pylist() for c in range(3))):
                    ids = np.array([*encode(text or ""), end_id], "<u4")
                    for start in range(0, len(ids), size):
                        piece = ids[start:start + size]
                        rows.append((doc, start, len(piece), _narrow(piece) if narrow else piece.tobytes(), len(ids), row))
                if rows:
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                     ["doc_id", "start", "length", "ids", "doc_tokens", "row"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    return slim.mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long, row long")


def packed(pieces: DataFrame, size: int, order: list[str], narrow: bool = False) -> DataFrame:
    """``pieces`` (a table; a row has its ``length``) with ``sequence_id, offset``.
    ``narrow`` ids become 32-bit numbers.

    Pieces that agree in length and ``order`` are interchangeable.  No pieces
    give no rows.  Sequences are numbered from 0 without gaps, and a sequence's
    pieces lie in it without gaps from 0.
    """
    spark = pieces.sparkSession
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    p = places(shortest_pack_first(histogram, size))
    ranked = numbered(pieces, ["length"], order, "__rank", slots(spark, sum(histogram.values())))
    names = pieces.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            place = p["base"][length] + batch.column("__rank").to_numpy()
            e = np.searchsorted(p["begin"], place, "right") - 1
            k = place - p["begin"][e]
            sequence = p["sequence"][e] + k // p["times"][e]
            offset = p["offset"][e] + k % p["times"][e] * length
            held = {n: batch.column(n) for n in names}
            if narrow:
                held["ids"] = pa.array(map(_wide, held["ids"].to_pylist(), length.tolist()), pa.binary())
            yield pa.RecordBatch.from_arrays([*held.values(), pa.array(sequence), pa.array(offset)],
                                             [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, size: int, end_id: int, digest: bool = False,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenize, cut and pack ``docs``; the pieces are tokenized once and written.

    The ids always travel with their piece, narrow on the way.  ``digest`` adds ``ids_crc32``, the
    CRC-32 of the packed ``ids``.
    """
    pieces = written(token_pieces(docs, tokenizer, size, end_id, id_col, text_col, narrow=True), "pieces")
    rows = packed(pieces, size, ["doc_id", "start", "row"], narrow=True)  # written, so a row keeps its number
    return rows.withColumn("ids_crc32", F.crc32("ids")) if digest else rows
