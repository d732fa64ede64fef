"""The registered queries on small tables, every column of their contracts
against plain Python written from the contract."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from helpers import DOC_SCHEMA, awkward, docs, frame, prose
from test_simhash import roots, slow_print
from test_text_dedup import slow_words
from tokenizers import Tokenizer

from tidemark.llm import quality
from tidemark.llm import queries as Q


def folder(tmp_path, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.fixture(scope="module")
def texts():
    passage = " ".join("p%d" % i for i in range(20))
    out = prose(41, 60, vocabulary=60, words=(0, 90))
    out += [f"{out[1]} {passage}", f"{passage} {out[2]} {passage}", out[3], out[3], None, "", " \t\n ", "one two",
            "Äß é 日本 <|endoftext|> tail", "a<|endoftext|>", "x" * 9000, " ".join(["same"] * 3000)]
    return out


@pytest.fixture(scope="module")
def sf(spark, texts, tmp_path_factory):
    rows = docs(spark, texts)
    labels = spark.createDataFrame([(i, int(len(t or "") > 100), int(i % 9 == 0)) for i, t in enumerate(texts) if i % 2],
                                   "doc_id long, quality int, toxic int")
    return folder(tmp_path_factory.mktemp("sf"), documents=rows, labels=labels)


def test_op1(spark, sf, texts):
    rows = {r.doc_id: r for r in Q.op1_quality(spark, sf).collect()}
    docs_ = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality.train(docs_, quality.train_fold(spark.read.parquet(f"{sf}/labels.parquet")))
    assert set(rows) == set(range(len(texts)))
    for i, t in enumerate(texts):
        total = model.base
        x = quality.text_features((t or "").encode())
        for value, edges, table in zip(x, model.edges, model.tables):
            total += table[sum(e <= value for e in edges)]
        for (a, b), table in zip(model.pairs, model.pair_tables):
            total += table[sum(e <= x[a] for e in model.coarse[a]), sum(e <= x[b] for e in model.coarse[b])]
        assert rows[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert rows[i].score == pytest.approx(1 / (1 + np.exp(-total))) and 0 <= rows[i].score <= 1
        assert rows[i].predicted == int(rows[i].score >= 0.5)


def test_op3(spark, sf, texts):
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    want = {i: [*encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    places = {}
    seen = {i: [] for i in want}
    for r in Q.op3_pack(spark, sf).collect():
        ids = want[r.doc_id][r.start:r.start + r.length]
        assert r.length == len(ids) > 0 and r.doc_tokens == len(want[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        seen[r.doc_id] += range(r.start, r.start + r.length)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert {i: sorted(s) for i, s in seen.items()} == {i: list(range(len(w))) for i, w in want.items()}
    for pieces in places.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048


def test_op5(spark, sf, texts):
    want = slow_words(dict(enumerate(texts)), 13)
    got = {(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in Q.op5_substrings(spark, sf).collect()}
    assert got == {(i, n, k, hashlib.sha256(kept.encode()).hexdigest()) for i, (n, k, kept) in want.items()}
    assert sum(x[1] for x in want.values()) > 20


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
         ("block", "com", "/de/")]


def parts_of(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), re.match(r"[^?#]*", rest[len(host):]).group()


def test_op7(spark, tmp_path):
    urls = [None, "", "no scheme", "http://", "http://EXAMPLE.org/es/x?q#f", "https://a.example.org/en/12", "http://org",
            "http://x.org/", "http://xorg/", "ftp://b.COM/fr/1", "http://com/de/#a", "http://a.com/de", "://a.com/de/x",
            "http://a://b.com/fr/", "http://example.org/en/1", "http://notexample.org/es/", "http://a.com?/de/"]
    urls += [f"http://h{i % 7}.com/{'de' if i % 3 else 'fr'}/{i}" for i in range(60)] + ["http://h.net/x%d" % i for i in range(9)]
    pages = spark.createDataFrame([(i, u, "") for i, u in enumerate(urls)], "page_id long, url string, html string")
    rows = {r.page_id: r for r in Q.op7_url_trees(spark, folder(tmp_path, pages=pages)).collect()}
    assert set(rows) == set(range(len(urls)))
    for i, u in enumerate(urls):
        host, path = parts_of(u)
        fits = [(len(h + p), v, h + p) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (rows[i].host, rows[i].path) == (host, path)
        assert rows[i].rule == (max(fits)[2] if fits else None)
        assert rows[i].verdict == max(fits)[1] if fits else rows[i].verdict in ("allow", "block")


def test_op8(spark, sf, texts):
    rows = Q.op8_best_fit_shards(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    slots, loads, of = {}, Counter(), {}
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "bytes", None)
        slots.setdefault(r.shard, []).append(r.slot)
        loads[r.shard] += r["size"]
        of.setdefault(data, set()).add(r.shard)
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of.values())
    alone = {next(r.shard for r in rows if r["size"] == len(t) + 8) for t in ("x" * 9000, " ".join(["same"] * 3000))}
    others = [v for s, v in loads.items() if s not in alone]
    assert max(others) < 1.25 * min(others)  # 70 texts of up to 600 bytes


def test_op9(spark, sf, texts):
    prints = {i: slow_print(t, 4) for i, t in enumerate(texts)}
    want = roots(sorted(prints), lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in Q.op9_simhash(spark, sf).collect()}
    assert got == {i: ("%016x" % p, want[i]) for i, p in prints.items()}


def test_empty_tables(spark, tmp_path):
    empty = frame(spark, [])
    sf = folder(tmp_path, documents=empty, benchmark=spark.createDataFrame([], "item_id long, text string"),
                labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"),
                pages=spark.createDataFrame([], "page_id long, url string, html string"),
                embeddings=spark.createDataFrame([], "vec_id long, embedding array<float>, label int"))
    for name, query in Q.QUERIES.items():
        assert query(spark, sf).count() == 0, name


def test_pipeline_on_awkward_rows(spark, tmp_path):
    """Clashing names come through all stages with their values; repeats and nulls do not crash one."""
    import corpus_pipeline as P
    good = [t for t in prose(51, 80, vocabulary=80, words=(40, 120), lines=True)]
    base = awkward(spark, docs(spark, good + ["$$$ ### !!!"] * 20 + [good[0]] * 3))
    labels = spark.createDataFrame([(i, int(i < len(good)), 0) for i in range(0, len(good) + 20, 2)],
                                   "doc_id long, quality int, toxic int")
    sf = folder(tmp_path, documents=base, labels=labels)
    rows, before = base, base.count()
    for name, stage in P.STAGES[:-1]:
        rows = P.written(stage(spark, rows, sf), "awkward")
        assert rows.columns == base.columns, name
        clash = [c for c in base.columns if c not in DOC_SCHEMA]
        assert {v for r in rows.select(*clash).distinct().collect() for v in r} == {"clash"}, name
        assert 0 < rows.count() <= 3 * before
    assert "$$$ ### !!!" not in {r.text for r in rows.collect()}
    pieces = P.STAGES[-1][1](spark, rows, sf)
    assert pieces.filter("start = 0").count() == rows.count()


def test_pipeline_on_an_empty_table(spark, tmp_path):
    import corpus_pipeline as P
    sf = folder(tmp_path, documents=frame(spark, []), labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert P.run(spark, sf).count() == 0
