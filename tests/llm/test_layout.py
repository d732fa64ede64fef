"""Sharding, mixing and numbering."""

import random
import zlib
from collections import Counter

import pytest
from helpers import awkward, docs, frame, prose, unchanged

from tidemark.llm import mixing, sharding
from tidemark.llm.common import numbered


def test_numbers_have_no_gaps(spark):
    rows = [(i % 3 == 0 and "hot" or "k%d" % (i % 5), i) for i in range(400)] + [("hot", 3)] * 50
    out = numbered(spark.createDataFrame(rows, "k string, v long"), ["k"], ["v"], "n", 7).collect()
    assert len(out) == len(rows)
    for k in {r.k for r in out}:
        mine = sorted(r.n for r in out if r.k == k)
        assert mine == list(range(len(mine)))


def test_tree_finds_the_tightest_bin():
    rnd = random.Random(6)
    tree, bins = sharding.CapacityTree(), {}
    for step in range(2000):
        if rnd.random() < 0.5:
            bins[step] = rnd.randrange(50)
            tree.add(bins[step], step)
        else:
            size = rnd.randrange(60)
            fits = sorted((r, b) for b, r in bins.items() if r >= size)
            got = tree.take_tightest(size)
            assert got == (fits[0] if fits else None)
            if got:
                del bins[got[1]]


def one_each(sizes):
    return [(s, 1) for s in sizes]


def test_best_fit_decreasing():
    assert sharding.best_fit(one_each([6, 5, 4, 3, 2]), 10) == [[(0, 1)], [(1, 1)], [(0, 1)], [(1, 1)], [(1, 1)]]
    assert sharding.best_fit(one_each([6, 5, 4]), 10, most=1) is None
    assert sharding.best_fit([(4, 5)], 10) == [[(0, 2), (1, 2), (2, 1)]]
    assert sharding.fill([], 4) == []
    sizes = sorted((random.Random(1).randint(1, 1000) for _ in range(3000)), reverse=True)
    counted = sorted(Counter(sizes).items(), reverse=True)
    for items in (one_each(sizes), counted):
        placed = sharding.fill(items, 24)
        assert [sum(n for _, n in into) for into in placed] == [n for _, n in items]
        loads = load_of(items, placed)
        assert len(loads) == 24 and max(loads.values()) < 1.01 * sum(sizes) / 24


def load_of(items, placed):
    loads = Counter()
    for (s, _), into in zip(items, placed):
        for b, n in into:
            loads[b] += s * n
    return loads


@pytest.mark.parametrize("sizes", [[1000] + [1] * 500, [900, 800, 3] + [1] * 97, [5] * 30, [7] * 24, [9] * 5,
                                   [50, 50, 50] + [1] * 40])
def test_no_bin_stays_empty(sizes):
    items = sorted(Counter(sizes).items(), reverse=True)
    loads = load_of(items, sharding.fill(items, 24))
    assert len(loads) == min(24, len(sizes)) and sum(loads.values()) == sum(sizes)
    # beside the items that fill a bin alone, no bin has more than twice the least
    small = sorted(loads.values())[:24 - sum(s > sum(sizes) / 24 for s in sizes)]
    assert small[-1] <= 2 * small[0]


def check_shards(rows, n):
    for s in range(n):
        mine = sorted(r.slot for r in rows if r.shard == s)
        assert mine == list(range(len(mine)))


def test_shards_are_near_equal_and_keep_groups(spark):
    texts = prose(2, 600, words=(1, 60))
    texts += [texts[0]] * 20 + [None, ""]
    rows = sharding.balanced_shards(docs(spark, texts), 6).collect()
    assert len(rows) == len(texts)
    where = {}
    for r in rows:
        t = (texts[r.doc_id] or "").encode()
        assert r["size"] == len(t) + 8 and r.text_crc32 == zlib.crc32(t)
        where.setdefault(t, set()).add(r.shard)
    assert all(len(s) == 1 for s in where.values())
    loads = Counter()
    for r in rows:
        loads[r.shard] += r["size"]
    assert max(loads.values()) - min(loads.values()) < 0.01 * max(loads.values())
    check_shards(rows, 6)


def test_only_a_group_larger_than_a_shard_is_split(spark):
    texts = ["hot text of some length"] * 500 + ["t%d" % i * 5 for i in range(300)]
    rows = sharding.balanced_shards(docs(spark, texts), 5).collect()
    loads = Counter()
    for r in rows:
        loads[r.shard] += r["size"]
    assert set(loads) == set(range(5)) and max(loads.values()) < 1.05 * sum(loads.values()) / 5
    check_shards(rows, 5)


def load(rows):
    loads = Counter()
    for r in rows:
        loads[r.shard] += r["size"]
    return loads


def test_one_long_document_leaves_the_others_near_equal(spark):
    texts = ["z" * 40000] + prose(4, 1500, words=(1, 60))
    rows = sharding.balanced_shards(docs(spark, texts), 24).collect()
    loads = load(rows)
    alone = next(r.shard for r in rows if r.doc_id == 0)
    assert len(loads) == 24 and loads.pop(alone) >= 40008
    assert max(loads.values()) - min(loads.values()) < 0.02 * max(loads.values())
    check_shards(rows, 24)


def test_repeats_of_one_row_fill_all_shards(spark):
    rows = sharding.balanced_shards(frame(spark, [(7, "the same text", "en", "s", 13)] * 1500), 24).collect()
    loads = load(rows)
    assert len(rows) == 1500 and len(loads) == 24 and max(loads.values()) < 1.1 * min(loads.values())
    check_shards(rows, 24)


def test_every_group_is_an_item(spark):
    """Small groups are placed by their class's places, large ones by themselves."""
    texts = ["x" * (n % 97) + str(n) for n in range(3000)] + ["y" * 5000 + str(n) for n in range(200)]
    rows = sharding.balanced_shards(docs(spark, texts), 8, parts=20).collect()
    loads = load(rows)
    assert len(rows) == len(texts) and len({r.doc_id for r in rows}) == len(texts)
    assert max(loads.values()) < 1.02 * min(loads.values())
    check_shards(rows, 8)


def test_shards_of_awkward_rows(spark):
    base = awkward(spark, docs(spark, prose(3, 10)))
    rows = sharding.balanced_shards(base, 24).collect()
    assert len(rows) == base.count()
    check_shards(rows, 24)
    assert sharding.balanced_shards(frame(spark, []), 24).count() == 0


def test_mix_reaches_target_shares(spark):
    texts = ["w" * 50] * 6000
    sources = ["big"] * 4000 + ["small"] * 200 + [None] * 1800
    rows = mixing.mix(docs(spark, texts, sources), {"big": 1.0, "small": 2.0, "": 1.0}, seed=3)
    assert rows.columns == ["doc_id", "text", "lang", "source", "n_chars", "draw", "copy", "shuffle_key"]
    got = {r.source: r["count"] for r in rows.groupBy("source").count().collect()}
    assert abs(got["big"] - 1500) < 5 * 1500 ** 0.5
    assert abs(got["small"] - 3000) < 5 * 3000 ** 0.5     # a mean of 15 is drawn in two parts
    assert abs(got[None] - 1500) < 5 * 1500 ** 0.5
    per_doc = Counter(r.doc_id for r in rows.select("doc_id", "source").collect() if r.source == "small")
    counts = [per_doc.get(i, 0) for i in range(4000, 4200)]
    mean = sum(counts) / 200
    variance = sum((c - mean) ** 2 for c in counts) / 200
    assert 0.7 * mean < variance < 1.4 * mean              # Poisson: variance equals mean


def test_mix_repeats_itself_and_orders_at_random(spark):
    base = docs(spark, prose(1, 300, words=(5, 9)), ["a", "b", "c"] * 100)
    one, two = (mixing.mix(base, {}, seed=1).collect() for _ in range(2))
    key = lambda rows: sorted((r.doc_id, r.draw, r.copy, r.shuffle_key) for r in rows)
    assert key(one) == key(two)
    assert key(one) != key(mixing.mix(base, {}, seed=2).collect())
    assert len({(r.doc_id, r.draw, r.copy) for r in one}) == len(one)
    ids = [r.doc_id for r in one]
    assert 0.3 < sum(a < b for a, b in zip(ids, ids[1:])) / len(ids) < 0.7


def test_mix_zero_weight_high_rate_and_awkward_rows(spark):
    rows = mixing.mix(docs(spark, ["x", "y" * 9000, "z"], ["a", "b", "c"]), {"a": 1, "b": 1, "c": 0}, seed=1)
    got = Counter(r.source for r in rows.collect())
    assert 4000 < got["a"] < 5100 and "c" not in got
    base = awkward(spark, docs(spark, prose(3, 30)))
    out = mixing.mix(base, {"t": 1.0})
    assert out.columns == [*base.columns, "draw_", "copy_", "shuffle_key_"]
    rows = out.collect()
    assert rows and unchanged(rows, base)
    assert mixing.mix(frame(spark, []), {}).count() == 0
    assert mixing.mix(docs(spark, ["", ""]), {}).count() >= 0


@pytest.mark.parametrize("mean", [0.01, 0.7, 8.0])
def test_table_is_the_poisson_distribution(spark, mean):
    import math
    rates = spark.createDataFrame([("s", mean)], "__source string, __rate double")
    cdf = mixing.poisson_table(rates).first()["__cdf"]
    total, p = 0.0, math.exp(-mean)
    for k, c in enumerate(cdf):
        total += p
        assert abs(c - total) < 1e-12
        p *= mean / (k + 1)
    assert 1 - cdf[-1] < 1e-12
