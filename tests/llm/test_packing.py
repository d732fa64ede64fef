import random

import numpy as np
import public_tokenizers
import pytest
from helpers import awkward, docs, frame, prose

from tidemark.llm import packing
from tidemark.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_patterns_hold_every_piece_once():
    rnd = random.Random(5)
    histogram = {rnd.randint(1, 64): rnd.randint(1, 200) for _ in range(40)}
    patterns = packing.shortest_pack_first(histogram, 64)
    held = {}
    for count, pattern in patterns:
        assert sum(length * times for length, times in pattern.items()) <= 64
        for length, times in pattern.items():
            held[length] = held.get(length, 0) + count * times
    assert held == histogram
    assert len(patterns) <= 3 * 64


def test_one_length_fills_packs():
    assert packing.shortest_pack_first({10: 25}, 64) == [(4, {10: 6}), (1, {10: 1})]
    with pytest.raises(ValueError):
        packing.shortest_pack_first({65: 1}, 64)


def test_longest_first_into_the_shortest_pack():
    # 40 and 30 open packs; 20 goes to the emptier one, then 15 to the one with 24 left
    assert sorted(map(str, packing.shortest_pack_first({40: 1, 30: 1, 20: 1, 15: 1}, 64))) == sorted(
        map(str, [(1, {30: 1, 20: 1}), (1, {40: 1, 15: 1})]))


def test_ids_equal_the_reference_library():
    from tokenizers import Tokenizer
    slow = Tokenizer.from_file(PATH)
    ours = Encoder(open(PATH, encoding="utf-8").read())
    assert ours.fast is not None
    rnd = random.Random(2)
    letters = "ab éßÿ'sLtre1 2\t\n\r.,!|«»¡ɏĀ-日😀\u0085\u00a0\u2028<|"
    texts = ["", " ", "a" * 3000, " " * 3000, "<|endoftext|>", "a<|endoftext|> b <|endoftext|", "don't I'LL"] + [
        "".join(rnd.choice(letters) for _ in range(rnd.randrange(80))) for _ in range(500)]
    for t in texts:
        assert ours.encode(t) == slow.encode(t, add_special_tokens=False).ids
    assert ours.encode("a<|endoftext|>b")[1] == 50256  # a special token's string is one id


def check(rows, size, texts):
    """Round trip: the pieces of each document give its ids, sequences have no gaps."""
    encode = Encoder(open(PATH, encoding="utf-8").read()).encode
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    for doc, text in texts.items():
        mine = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.start)
        ids = [*encode(text or ""), 1]
        assert [int(x) for r in mine for x in np.frombuffer(bytes(r.ids), "<u4")] == ids
        assert all(r.doc_tokens == len(ids) and r.length == len(r.ids) // 4 for r in mine)


def test_round_trip(spark):
    texts = [*prose(1, 60), None, "", "w " * 700]
    rows = packing.pack(docs(spark, texts), PATH, 128, 1).collect()
    check(rows, 128, dict(enumerate(texts)))
    used, sequences = sum(r.length for r in rows), len({r.sequence_id for r in rows})
    assert used / (128 * sequences) > 0.85  # of 46 sequences


def test_awkward_rows(spark):
    from tidemark.llm.common import written
    base = awkward(spark, docs(spark, prose(3, 5)))
    rows = packing.pack(base, PATH, 64, 1, digest=True).collect()
    copies = sum(r.doc_id == 901 for r in rows)
    assert copies == 2 and any(r.doc_id is None for r in rows)
    assert sum(r.length for r in rows if r.doc_id == 902) == rows[[r.doc_id for r in rows].index(902)].doc_tokens
    empty = packing.pack(base.limit(0), PATH, 64, 1)
    assert empty.count() == 0
    assert written(empty, "empty").columns[-2:] == ["sequence_id", "offset"]


def test_digest_keeps_the_ids(spark):
    import zlib
    texts = [*prose(4, 20), None, "w " * 300]
    rows = packing.pack(docs(spark, texts), PATH, 64, 1, digest=True).collect()
    check(rows, 64, dict(enumerate(texts)))
    assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) for r in rows)


def test_copies_of_a_document_can_be_told_apart(spark):
    rows = packing.pack(frame(spark, [(5, "w " * 300, "en", "s", 600)] * 4), PATH, 64, 1).collect()
    by_row = {}
    for r in rows:
        by_row.setdefault(r.row, []).append(r)
    assert len(by_row) == 4
    for mine in by_row.values():
        assert sorted(r.start for r in mine) == list(range(0, mine[0].doc_tokens, 64))


def test_query_and_pipeline_pack_the_ids(spark):
    import zlib

    import corpus_pipeline
    from tidemark.llm import queries as Q
    sf = "/root/testdata/sf0.001"
    base = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in base.collect()}
    rows = corpus_pipeline.pack(spark, base, sf).collect()
    check(rows, Q.SEQUENCE, texts)
    crc = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
    assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) for r in rows)
    query = Q.op3_pack(spark, sf)
    assert "crc32(ids#" in query._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(crc, query.collect())) == sorted(map(crc, rows))


def test_narrow_ids():
    for ids in ([0], [1, 65535], [65536, 3], [1]):
        a = np.array(ids, "<u4")
        data = packing._narrow(a)
        assert len(data) == (2 if max(ids) < 65536 else 4) * len(ids)
        assert packing._wide(data, len(ids)) == a.tobytes()
