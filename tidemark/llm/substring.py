"""Substring dedup: suffix automata of reference shards, documents streamed.

A document loses every word covered by a window of ``window`` words that a
document with a smaller id has too.  Windows are judged on the input.

Streaming every document through the automata of the whole corpus would cost
the square of its size, so documents first find whom they must meet.  Windows
are hashed where the text lies, the hashes are dealt to buckets, and a bucket
links each document to the first one that has the same hash.  The documents
linked to are the references.  Documents are dealt to parts of bounded size by
a hash of their id, and a reference is sent to each part that has readers of it.
A part cuts its references into shards of at most ``SHARD_WORDS`` words (pieces
overlap by a window less a word, so no window is lost), builds one shard's
automaton after the other, and streams the shard's readers through it.  The
automaton compares words and not hashes.

A bucket links a hash to one document only, so where different windows share a
hash the automaton may miss a repeat.  Then the reader has a window that stays
and whose hash a smaller reference of its part has: the window is in doubt.
The hashes in doubt go to a second round, which takes every window of the corpus
with one of them and compares the windows' words, so no result depends on chance.

References grow with the corpus, so they reach the tasks by a shuffle and not by
the driver's broadcast.  Within a batch of documents only a hash's first
document goes to the bucket, and the batch's others link to that one, so a
passage that a third of the corpus has reaches its bucket once per batch.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.automaton import SuffixAutomaton
from tidemark.llm.common import tasks, written
from tidemark.llm.xxh64 import xxh64_spans

IN_BATCH = 4096               # documents whose equal windows meet before they go to buckets
STORED = 5                    # bytes of a hash that are stored; the bucket's number is more of it
TARGETS = 1024                # parts that one row sends a reference to
BUCKET_WORDS = 2_000_000
SHARD_WORDS = 100_000
PART_BYTES = 16 << 20
DOUBT_SLICE = 1 << 20         # hashes in doubt that one pass of the second round takes
_TEXT_BYTES = 128 << 10
_REF_BYTES = 4 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FINAL = np.uint64(0xBF58476D1CE4E5B9)


def window_hashes(texts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every window of every text, and the place of its text."""
    hashes, places = [], []
    k = 0
    while k < len(texts):  # a cache-sized part at a time
        parts, held, first = [], 0, k
        while k < len(texts) and (not parts or held < _TEXT_BYTES):
            parts.append(b" ".join(texts[k].split()))
            held += len(parts[-1])
            k += 1
        buf = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
        ends = np.flatnonzero((buf == 32) | (buf == 10))
        starts = np.concatenate([[0], ends[:-1] + 1])
        doc = np.cumsum(buf[ends] == 10)
        doc = np.concatenate([[0], doc[:-1]])
        if len(ends) < window:
            continue
        words = xxh64_spans(buf, starts, ends)
        n = len(words) - window + 1
        acc = words[:n].copy()
        for j in range(1, window):
            acc *= _BASE
            acc += words[j:n + j]
        inside = doc[:n] == doc[window - 1:]
        acc ^= acc >> np.uint64(31)
        acc *= _FINAL
        acc ^= acc >> np.uint64(29)
        hashes.append(acc[inside])
        places.append(doc[:n][inside] + first)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(places)


def _pairs(d: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of two id arrays."""
    if not len(d):
        return d, f
    ids, code = np.unique(np.concatenate([d, f]), return_inverse=True)
    pair = np.unique(code[:len(d)] * len(ids) + code[len(d):])
    return ids[pair // len(ids)], ids[pair % len(ids)]


def _small(values: np.ndarray) -> bytes:
    """Non-negative numbers in the least bytes that hold them all; the first
    byte tells how many that is."""
    kind = np.min_scalar_type(int(values.max()))
    return bytes([kind.itemsize]) + values.astype(f"<u{kind.itemsize}").tobytes()


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _bucket_bits(words: int) -> int:
    """Buckets keep their size: as the words double, so do the buckets."""
    return max(6, math.ceil(math.log2(max(1, words / BUCKET_WORDS))))


def _unused_bits(bits: int) -> int:
    """Low bits of a 64-bit hash that neither the bucket nor the stored bytes have."""
    return max(0, 64 - 8 * STORED - bits)


def links(docs: DataFrame, window: int, words: int) -> DataFrame:
    """``doc_id, ref``: for each window of a document that a smaller document
    has too, a link to one that has it (``ref`` < ``doc_id``).  ``words`` is
    about the number of words of ``docs`` (``doc_id, text``)."""
    bits = _bucket_bits(words)
    unused = np.uint64(_unused_bits(bits))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, IN_BATCH):
                part = batch.slice(start, IN_BATCH).sort_by("doc_id")
                ids = part.column("doc_id").to_numpy()
                hashes, place = window_hashes(part.column("text").cast(pa.binary()).to_pylist(), window)
                if not len(hashes):
                    continue
                hashes >>= unused
                order = np.argsort(hashes)
                value, at = hashes[order], place[order]
                new = np.concatenate([[True], value[1:] != value[:-1]])
                group = np.flatnonzero(new)
                least = np.minimum.reduceat(at, group)  # places are in the order of the ids
                head = least[np.cumsum(new) - 1]
                late = ids[head] < ids[at]
                d, f = _pairs(ids[at[late]], ids[head[late]])
                value = value[group]
                bucket = (value >> np.uint64(64 - int(unused) - bits)).astype(np.int64)
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
                rows = []
                for a, b in zip(cuts, cuts[1:]):
                    # the hashes by document: ids as steps, how many each has, then the hashes' low bytes
                    place_of = least[a:b]
                    order = np.argsort(place_of, kind="stable")
                    used, many = np.unique(place_of, return_counts=True)
                    steps = np.diff(ids[used], prepend=ids[used[0]])
                    low = value[a:b][order].astype("<u8").view(np.uint8).reshape(-1, 8)
                    rows.append((int(bucket[a]), int(ids[used[0]]), _small(steps), _small(many),
                                 low[:, :STORED].tobytes()))
                if len(d):
                    rows.append((-1 - int(ids[0]) % (1 << bits), 0, d.tobytes(), f.tobytes(), b""))
                for a in range(0, len(rows), 64):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows[a:a + 64]),
                                                        (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                        ["bucket", "base", "steps", "many", "hashes"])

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if row[0] < 0:
                    yield out(np.frombuffer(row[2], np.int64), np.frombuffer(row[3], np.int64))
                    continue
                if row[0] != bucket and held:
                    yield out(*first_of(held))
                    held = []
                bucket = row[0]
                held.append(row[1:])
        if held:
            yield out(*first_of(held))

    def first_of(held: list) -> tuple[np.ndarray, np.ndarray]:
        """Links of a bucket: the smallest document of each hash to the others."""
        ids, low = [], []
        for base, steps, many, data in held:
            ids.append(np.repeat(base + np.cumsum(_wide(steps)), _wide(many)))
            value = np.zeros((len(data) // STORED, 8), np.uint8)
            value[:, :STORED] = np.frombuffer(data, np.uint8).reshape(-1, STORED)
            low.append(value.view("<u8").reshape(-1))
        who, value = np.concatenate(ids), np.concatenate(low)
        order = np.lexsort((who, value))
        who, value = who[order], value[order]
        new = np.concatenate([[True], value[1:] != value[:-1]])
        head = who[np.flatnonzero(new)][np.cumsum(new) - 1]
        late = head < who
        return _pairs(who[late], head[late])

    def out(d: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(d), pa.array(f)], ["doc_id", "ref"])

    entries = docs.mapInArrow(dealt, "bucket long, base long, steps binary, many binary, hashes binary")
    # a task takes one bucket after the other, so buckets may be more than tasks
    grouped = entries.repartition("bucket").sortWithinPartitions("bucket")
    return grouped.mapInArrow(met, "doc_id long, ref long").distinct()


def _shards(refs: list[tuple[int, list[bytes], list[int]]], window: int):
    """References ``(id, words, readers)`` as lists of at most ``SHARD_WORDS``
    words (one piece at least); pieces of one reference overlap by a window
    less a word."""
    shard, size = [], 0
    for doc, words, readers in refs:
        for k in range(0, max(1, len(words) - window + 1), SHARD_WORDS):
            piece = words[k:k + SHARD_WORDS + window - 1]
            if shard and size + len(piece) > SHARD_WORDS:
                yield shard
                shard, size = [], 0
            shard.append((doc, piece, readers))
            size += len(piece)
    if shard:
        yield shard


def _references(docs: pa.Table, wanted: pa.Table) -> pa.Table:
    """The documents of a part that others read, with the parts that do."""
    rows: dict[int, list[int]] = {}
    for i, doc in enumerate(docs["doc_id"].to_pylist()):
        rows.setdefault(doc, []).append(i)
    of = [(i, w) for w, doc in enumerate(wanted["doc_id"].to_pylist()) for i in rows.get(doc, ())]
    i, w = (pa.array([x[k] for x in of], pa.int64()) for k in (0, 1))
    return pa.table([docs["doc_id"].take(i), docs["text"].take(i), wanted["targets"].take(w).cast(pa.list_(pa.int32()))],
                    names=["ref", "ref_text", "targets"])


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    whole: list[list[int]] = []
    for a, b in sorted(spans):
        if whole and a <= whole[-1][1]:
            whole[-1][1] = max(b, whole[-1][1])
        else:
            whole.append([a, b])
    return whole


def _in_doubt(refs: Iterator[tuple[int, bytes]], readers: list[tuple[int, int, bytes]],
              spans: dict[int, list[tuple[int, int]]], window: int, shift: int) -> dict[int, list[dict]]:
    """The windows in doubt of each reader ``(row, doc, text)``: those not in
    its ``spans`` whose hash a smaller reference has."""
    hashes, place = window_hashes([text for _, _, text in readers], window)
    if not len(hashes):
        return {}
    hashes >>= np.uint64(shift)
    begin = np.searchsorted(place, np.arange(len(readers)))
    left = np.ones(len(hashes), bool)
    for k, (i, _, _) in enumerate(readers):
        for a, b in _merged(spans.get(i, ())):
            left[begin[k] + a:begin[k] + b - window + 1] = False
    at = np.flatnonzero(left)
    mask = np.uint64((1 << min(25, max(10, int(8 * len(at)).bit_length()))) - 1)
    seen = np.zeros(int(mask) + 1, bool)
    seen[(hashes[at] & mask).astype(np.int64)] = True
    of_refs, ids = [], []

    def take(held: list[tuple[int, bytes]]) -> None:
        value, text = window_hashes([x for _, x in held], window)
        value >>= np.uint64(shift)
        keep = seen[(value & mask).astype(np.int64)]
        of_refs.append(value[keep])
        ids.append(np.array([x for x, _ in held], np.int64)[text[keep]])

    held, size = [], 0
    for ref in refs:
        held.append(ref)
        size += len(ref[1])
        if size > _REF_BYTES:
            take(held)
            held, size = [], 0
    take(held)
    value, doc = np.concatenate(of_refs), np.concatenate(ids)
    order = np.lexsort((doc, value))
    value, doc = value[order], doc[order]
    new = np.concatenate([[True], value[1:] != value[:-1]])[:len(value)]
    value, doc = value[new], doc[new]  # the smallest reference of each hash
    if not len(value):
        return {}
    near = np.minimum(np.searchsorted(value, hashes[at]), len(value) - 1)
    reader = np.array([x for _, x, _ in readers], np.int64)[place[at]]
    out: dict[int, list[dict]] = {}
    words, of = [], -1
    for w in at[(value[near] == hashes[at]) & (doc[near] < reader)]:
        if place[w] != of:
            of = place[w]
            words = readers[of][2].split()
        start = int(w - begin[of])
        if start + window <= len(words):
            out.setdefault(readers[of][0], []).append(
                {"start": start, "hash": int(hashes[w].astype(np.int64)), "words": b" ".join(words[start:start + window])})
    return out


def _part(window: int, shift: int):
    """A part's references (``ref, ref_text``), who reads them (``ref, reader``)
    and its documents to the documents' kept words and windows in doubt;
    ``shift`` bits of a hash are not compared."""

    def run(sent: pa.Table, docs: pa.Table) -> pa.Table:
        gc.disable()  # the automata's many lists and dicts hold no cycles; looking for some takes an eighth of the time
        try:
            return kept_of(sent, docs)
        finally:
            gc.enable()

    def kept_of(sent: pa.Table, docs: pa.Table) -> pa.Table:
        links = sent.filter(pc.is_valid(sent["reader"]))
        reads: dict[int, list[int]] = {}
        for ref, reader in zip(links["ref"].to_pylist(), links["reader"].to_pylist()):
            reads.setdefault(ref, []).append(reader)
        refs = sent.filter(pc.is_null(sent["reader"]))
        texts = docs["text"].cast(pa.binary())
        rows: dict[int, list[int]] = {}
        for i, doc in enumerate(docs["doc_id"].to_pylist()):
            rows.setdefault(doc, []).append(i)
        spans: dict[int, list[tuple[int, int]]] = {}
        order = np.argsort(refs["ref"].to_numpy(), kind="stable") if len(refs) else []
        listed = ((refs["ref"][i].as_py(), refs["ref_text"][i].as_py().encode().split(), reads[refs["ref"][i].as_py()])
                  for i in map(int, order))
        for shard in _shards(listed, window):
            automaton = SuffixAutomaton(window)
            for doc, words, _ in shard:
                automaton.add(words, doc)
            automaton.close()
            for reader in {r for _, _, readers in shard for r in readers}:
                for i in rows.get(reader, ()):
                    spans.setdefault(i, []).extend(automaton.covered(texts[i].as_py().split(), reader))
        read = {r for readers in reads.values() for r in readers}
        doubts = _in_doubt(((refs["ref"][i].as_py(), refs["ref_text"][i].as_py().encode()) for i in map(int, order)),
                           [(i, doc, texts[i].as_py()) for doc in sorted(read) for i in rows.get(doc, ())],
                           spans, window, shift)
        kept = _kept(docs["doc_id"].to_pylist(), texts, spans)
        return kept.append_column("doubts", pa.array([doubts.get(i) for i in range(len(kept))], _DOUBTS))

    return run


_DOUBTS = pa.list_(pa.struct([("start", pa.int64()), ("hash", pa.int64()), ("words", pa.binary())]))
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_SCHEMA = "doc_id long, n_words long, n_removed long, kept string, spans array<struct<start: long, end: long>>"


def _kept(docs: list, texts, spans: dict[int, list[tuple[int, int]]]) -> pa.Table:
    """Merge each row's spans and remove their words."""
    n_words, n_removed, kept, merged = [], [], [], []
    for i, text in enumerate(texts):
        words = (text.as_py() or b"").split()
        whole = _merged(spans.get(i, ()))
        rest, at = [], 0
        for a, b in whole:
            rest += words[at:a]
            at = b
        rest += words[at:]
        n_words.append(len(words))
        n_removed.append(len(words) - len(rest))
        kept.append(b" ".join(rest).decode())
        merged.append([{"start": a, "end": b} for a, b in whole])
    return pa.table([pa.array(docs, pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                     pa.array(kept, pa.string()), pa.array(merged, _SPANS)],
                    names=["doc_id", "n_words", "n_removed", "kept", "spans"])


def _alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from _kept(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), {}).to_batches()


def _second_round(known: DataFrame, first: DataFrame, window: int, shift: int) -> DataFrame:
    """``first`` (written) with the repeats removed that its windows in doubt are.

    The hashes in doubt are taken a slice at a time: one pass over ``known``
    gives every window with such a hash, and the words decide.
    """
    spark = known.sparkSession
    plain = ["doc_id", "n_words", "n_removed", "kept", "spans"]
    doubts = first.filter("doubts is not null").select("doc_id", F.inline("doubts"))
    hashes = doubts.select("hash").distinct()
    n = hashes.count()
    if not n:
        return first.select(*plain)
    slices = math.ceil(n / DOUBT_SLICE)
    slice_of = F.pmod(F.xxhash64("hash"), F.lit(slices))

    def holders(asked):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sought = asked.value
            for batch in batches:
                ids = batch.column("doc_id").to_numpy()
                texts = batch.column("text").cast(pa.binary()).to_pylist()
                value, place = window_hashes(texts, window)
                value = (value >> np.uint64(shift)).astype(np.int64)
                hit = np.flatnonzero(sought[np.minimum(np.searchsorted(sought, value), len(sought) - 1)] == value)
                least: dict[bytes, int] = {}
                words, of, begin = [], -1, 0
                for w in hit:
                    if place[w] != of:
                        of = place[w]
                        words, begin = texts[of].split(), np.searchsorted(place, of)
                    if w - begin + window <= len(words):
                        key = b" ".join(words[w - begin:w - begin + window])
                        least[key] = min(least.get(key, ids[of]), ids[of])
                yield pa.RecordBatch.from_arrays([pa.array(list(least), pa.binary()),
                                                  pa.array([int(x) for x in least.values()], pa.int64())],
                                                 ["words", "first"])
        return run

    lost = None
    for k in range(slices):
        some = doubts.filter(slice_of == k)
        asked = spark.sparkContext.broadcast(np.sort(np.array(  # about DOUBT_SLICE numbers
            hashes.filter(slice_of == k).toArrow()["hash"].to_numpy(), np.int64)))
        if not len(asked.value):
            continue
        holder = (known.mapInArrow(holders(asked), "words binary, first long")
                  .groupBy("words").agg(F.min("first").alias("first")))
        found = written(some.select("doc_id", "words").distinct().join(holder, "words")
                        .filter("first < doc_id").select("doc_id", "words"), "lost")
        lost = found if lost is None else lost.unionByName(found)
        asked.unpersist()
    of_doc = lost.groupBy("doc_id").agg(F.collect_set("words").alias("lost"))  # windows of one document
    mended = (first.filter("doubts is not null").join(of_doc, "doc_id", "left")
              .select(*plain, "doubts", "lost").mapInArrow(_mended(window), _SCHEMA))
    return first.filter("doubts is null").select(*plain).unionByName(mended)


def _mended(window: int):
    """Rows with the spans of their lost windows added and those words removed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                gone, lost = [(s["start"], s["end"]) for s in r["spans"]], set(r.pop("lost") or ())
                more = [(d["start"], d["start"] + window) for d in r.pop("doubts") if d["words"] in lost]
                stays = np.ones(r["n_words"], bool)
                for a, b in gone:
                    stays[a:b] = False
                before = np.flatnonzero(stays)
                for a, b in more:
                    stays[a:b] = False
                words = r["kept"].encode().split()
                r["kept"] = b" ".join(x for x, at in zip(words, before) if stays[at]).decode()
                r["n_removed"] = r["n_words"] - int(stays.sum())
                r["spans"] = [{"start": a, "end": b} for a, b in _merged(gone + more)]
            schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                                ("kept", pa.string()), ("spans", _SPANS)])
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def dedup_substrings(docs: DataFrame, window: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept, spans`` for every row of ``docs``.

    Words are runs of bytes other than space and ``\\t`` to ``\\r``; ``spans``
    are the removed ranges of words and ``kept`` the others, joined by a space.
    Null texts have no words.  A row with a null id has no smaller document and
    is none: it loses nothing.  Rows that share an id never take words from
    each other, and equal ones lose the same.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    known = base.filter("doc_id is not null")
    size = known.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    pairs = written(links(known, window, size // 5), "links")
    parts = max(tasks(spark), math.ceil(size / PART_BYTES))
    part_of = lambda c: F.pmod(F.xxhash64(c), F.lit(parts)).cast("int")
    # one shuffle of the texts serves as documents and as references; a task takes one part after the other
    dealt = known.withColumn("part", part_of("doc_id"))
    # a reference goes once to each part that reads it; who reads it there is known from the part's own links
    wanted = (pairs.select("ref", part_of("doc_id").alias("reader_part")).distinct()
              .groupBy(F.col("ref").alias("doc_id"), F.floor(F.col("reader_part") / TARGETS).alias("chunk"))
              .agg(F.collect_list("reader_part").alias("targets"))  # at most TARGETS parts
              .select("doc_id", "targets", part_of("doc_id").alias("part")))
    refs = (dealt.groupBy("part").cogroup(wanted.groupBy("part"))
            .applyInArrow(_references, "ref long, ref_text string, targets array<int>")
            # a text that many parts need is copied row by row on its way to them
            .select(F.explode("targets").alias("reader_part"), "ref", "ref_text", F.lit(None).cast("long").alias("reader")))
    reads = pairs.select(part_of("doc_id").alias("reader_part"), "ref", F.lit(None).cast("string").alias("ref_text"),
                         F.col("doc_id").alias("reader"))
    shift = _unused_bits(_bucket_bits(size // 5))
    first = written(refs.unionByName(reads).groupBy("reader_part").cogroup(dealt.groupBy("part"))
                    .applyInArrow(_part(window, shift),
                                  f"{_SCHEMA}, doubts array<struct<start: long, hash: long, words: binary>>"), "kept")
    kept = _second_round(known, first, window, shift)
    return kept.unionByName(base.filter("doc_id is null").mapInArrow(_alone, _SCHEMA))
