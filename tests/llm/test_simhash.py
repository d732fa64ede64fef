import random

import pytest
import xxhash
from helpers import awkward, docs, frame, prose

from tidemark.llm import simhash
from tidemark.llm.components import components


def slow_print(text, shingle):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, near):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and near(a, b) and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_fingerprints_equal_the_definition():
    texts = [None, "", " \t ", "One", "a B c", "a b c d", "Ä É x y z", "long " * 3000, *prose(1, 80, words=(0, 200))]
    got = simhash.fingerprints_of([None if t is None else t.encode() for t in texts], 4)
    assert [int(x) for x in got] == [slow_print(t, 4) for t in texts]


@pytest.mark.parametrize("tile", [2048, 3])
def test_components_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    rnd = random.Random(3)
    centers = [rnd.getrandbits(64) for _ in range(6)] + [0]
    prints = {}
    for i in range(160):
        x = rnd.choice(centers)
        for _ in range(rnd.randint(0, 7)):
            x ^= 1 << rnd.randrange(64)
        prints.setdefault(x, i)
    classes = spark.createDataFrame([(x - (1 << 64) if x >= 1 << 63 else x, i) for x, i in prints.items()], "fp long, node long")
    found = {r.node: r.component for r in components(simhash.links(classes, 4, 6)).collect()}
    fp = {i: x for x, i in prints.items()}
    want = roots(sorted(fp), lambda a, b: bin(fp[a] ^ fp[b]).count("1") <= 4)
    assert {n: found.get(n, n) for n in fp} == want
    assert len(set(want.values())) < len(want)


def test_every_choice_of_blocks_meets_close_pairs():
    masks = simhash.block_keys(4, 6)
    assert len(masks) == 15
    rnd = random.Random(1)
    for _ in range(200):
        x = 0
        for b in rnd.sample(range(64), 4):
            x |= 1 << b
        assert any(x & m == 0 for m in masks)


def test_long_chains_and_stars(spark):
    rnd = random.Random(2)
    chain = list(range(100, 160))
    edges = list(zip(chain, chain[1:])) + [(7, n) for n in range(20, 90)] + [(5, 5), (1, 3), (3, 2)]
    rnd.shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[n] == 100 for n in chain) and all(got[n] == 7 for n in range(20, 90))
    assert (got[1], got[2], got[3]) == (1, 1, 1)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_end_to_end(spark):
    texts = [*prose(4, 40), None, "", "  "]
    texts += [texts[3], texts[3].upper(), texts[5] + " one more word"]
    base = awkward(spark, docs(spark, texts))
    rows = simhash.near_duplicates(base, 4, 4).collect()
    assert len(rows) == base.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    for i, t in enumerate(texts):
        assert by_id[i].fp % (1 << 64) == slow_print(t, 4)
    ids = sorted(by_id)
    want = roots(ids, lambda a, b: bin((by_id[a].fp ^ by_id[b].fp) % (1 << 64)).count("1") <= 4)
    assert {i: by_id[i].component_id for i in ids} == want
    assert by_id[900].component_id == by_id[901].component_id == by_id[40].component_id  # null, '' and blank texts
    kept = simhash.one_of_each(base, 4, 4)
    assert kept.columns == base.columns
    got = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert got == sorted(set(want.values()))


def test_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, []), 4, 4).count() == 0
    assert simhash.one_of_each(frame(spark, []), 4, 4).count() == 0
