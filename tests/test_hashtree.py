import glob
import os
import shutil

from pyspark.sql import functions as F

from tidemark.operators import drift, hashtree

SCHEMA = "category string, name string, sha256 string"


def rows_of(df):
    return sorted((str(r.category), str(r.name), r.status) for r in df.collect())


def stored(spark, rows, folder):
    df = spark.createDataFrame(rows, SCHEMA)
    hashtree.write_tree(df, folder)
    return df


def test_equals_the_flat_comparison(spark, scratch_dir):
    left = [("c%d" % (i % 3), "n%d" % i, "d%d" % i) for i in range(600)] + [("c", "none", None)]
    right = [(c, n, "new" if i % 50 == 7 else d) for i, (c, n, d) in enumerate(left) if i % 40] + [("c9", "more", "x")]
    l, r = (stored(spark, rows, os.path.join(scratch_dir, side)) for rows, side in ((left, "l"), (right, "r")))
    got = hashtree.tree_drift(spark, f"{scratch_dir}/l", f"{scratch_dir}/r")
    assert rows_of(got) == rows_of(drift.raw_hash_diff(l, r)) and got.count() > 20
    assert hashtree.tree_drift(spark, f"{scratch_dir}/l", f"{scratch_dir}/l").count() == 0


def test_root_tells_snapshots_apart(spark, scratch_dir):
    rows = [("c", "n%d" % i, "d") for i in range(50)]
    for side, x in (("a", rows), ("b", rows[::-1]), ("c", rows[1:])):
        stored(spark, x, f"{scratch_dir}/{side}")
    a, b, c = (hashtree.tree_root(spark, f"{scratch_dir}/{s}").first() for s in "abc")
    assert a == b and a.root_digest != c.root_digest and (a.objects, c.objects) == (50, 49)


def test_unchanged_branches_are_not_read(spark, scratch_dir):
    """The folders of branches whose digests agree are gone, and nobody misses them."""
    rows = [("c", "n%d" % i, "d") for i in range(400)]
    l, r = f"{scratch_dir}/l", f"{scratch_dir}/r"
    stored(spark, rows, l)
    stored(spark, [(c, n, "changed" if n == "n17" else d) for c, n, d in rows], r)
    (branch,) = hashtree.differing_branches(spark, l, r)
    gone = 0
    for folder in glob.glob(f"{scratch_dir}/[lr]/leaves/folder=*"):
        if not folder.endswith("=" + branch[0]):
            assert os.listdir(folder)
            shutil.rmtree(folder)
            gone += 1
    assert gone == 30
    drifted = hashtree.tree_drift(spark, l, r)
    assert rows_of(drifted) == [("c", "n17", "modified")]
    # within the folder that is left, the branch is a condition that the reader gets
    assert f"PushedFilters: [IsNotNull(branch), EqualTo(branch,{branch})" in drifted._jdf.queryExecution().toString()


def test_unchanged_blocks_are_not_joined(spark, scratch_dir):
    rows = [("c", "n%d" % i, "d") for i in range(3000)]
    l, r = f"{scratch_dir}/l", f"{scratch_dir}/r"
    stored(spark, rows, l)
    stored(spark, rows + [("c", "added", "x")], r)
    drifted = hashtree.tree_drift(spark, l, r)
    plan = drifted._jdf.queryExecution().toString()
    assert plan.count("LeftSemi") >= 2 and "branch" in plan
    assert rows_of(drifted) == [("c", "added", "added")]


def test_empty_snapshots(spark, scratch_dir):
    l, r = f"{scratch_dir}/l", f"{scratch_dir}/r"
    stored(spark, [], l)
    stored(spark, [("c", "n", "d")], r)
    assert hashtree.tree_drift(spark, l, l).count() == 0
    assert rows_of(hashtree.tree_drift(spark, l, r)) == [("c", "n", "added")]
    assert rows_of(hashtree.tree_drift(spark, r, l)) == [("c", "n", "removed")]
    assert hashtree.tree_root(spark, l).first().objects == 0
