from pyspark.sql import functions as F

from tidemark.operators import integrity, search
from tidemark.sources.catalog import actual_columns, available_tables


def test_duplicate_keys_and_orphans(spark):
    child = spark.createDataFrame([(1, 10), (1, 10), (2, 20), (3, None), (4, 99), (5, 99)], "k int, p int")
    parent = spark.createDataFrame([(10,), (20,)], "p int")
    dups = {(r.k, r.p): r.copies for r in integrity.duplicate_keys(child, ["k", "p"]).collect()}
    assert dups == {(1, 10): 2}
    fk = {r.child_column: (r.orphan_rows, r.orphan_keys) for r in integrity.foreign_key_orphans(
        {"c": child, "p": parent}, [("c", "p", "p", "p"), ("c", "k", "p", "p"), ("p", "p", "c", "p")]).collect()
        if r.child_table == "c"}
    assert fk == {"p": (2, 1), "k": (6, 5)}  # NULL is not an orphan


def test_accepted_values_and_gaps(spark):
    t = spark.createDataFrame([("a",), ("b",), ("x",), ("x",), (None,)], "s string")
    got = {(r.value, r.rows) for r in integrity.accepted_values({"t": t}, [("t", "s", ("a", "b"))]).collect()}
    assert got == {("x", 2)}
    def gaps(numbers, **kw):
        v = spark.createDataFrame([(n,) for n in numbers], "version long")
        return sorted((r.gap_from, r.gap_to) for r in integrity.version_gaps(v, **kw).collect())

    assert gaps([1, 2, 2, 5, 9, None]) == [(3, 4), (6, 8)]
    assert gaps([3, 4, 9]) == [(1, 2), (5, 8)]
    assert gaps([0, 1, 2]) == [] and gaps([]) == [] and gaps([4], start=4) == []
    far = 3 * 65536
    assert gaps([1, far, far + 1, far + 5]) == [(2, far - 1), (far + 2, far + 4)]


def test_total_agreement(spark):
    o = spark.createDataFrame([(1, 110.0), (2, 50.0), (3, 1.0)], "k long, total double")
    li = spark.createDataFrame([(1, 100.0, 0.1), (2, 10.0, 0.0), (9, 1.0, 1.0)], "k long, price double, tax double")
    r = integrity.total_agreement(o, "k", "total", li, "k", "price * (1 + tax)", "sum", "0.01").first()
    assert (r.rule, r.checked_rows, r.without_children, r.violations) == ("sum", 2, 1, 1)


def test_search_and_presence(spark):
    h = spark.createDataFrame([("v001_base", "success", 1.5), ("v002_add", "failed", None),
                               ("v010_x", "success", 2.0)], "migration_id string, status string, d double")
    assert [r.migration_id for r in search.text_search(h, "V00").collect()] == ["v001_base", "v002_add"]
    loose = {r.needle: r.found for r in search.search_presence(h, ["v001", "v002", "v003", "1.5"]).collect()}
    assert loose == {"v001": True, "v002": True, "v003": False, "1.5": True}
    strict = {r.needle: r.found for r in search.strict_presence(h, ["v001", "v002"]).collect()}
    assert strict == {"v001": True, "v002": False}  # a failed run does not count
    assert search.presence_modes(h, []).count() == 0


def test_presence_plan_does_not_grow_with_labels(spark):
    h = spark.createDataFrame([("v001_base", "success")], "migration_id string, status string")
    sizes = [search.presence_modes(h, [f"v{i:03d}" for i in range(n)])._jdf.queryExecution().optimizedPlan()
             .numberedTreeString().count("\n") for n in (4, 400)]
    assert sizes[0] == sizes[1]
    assert search.presence_modes(h, [f"v{i:03d}" for i in range(400)]).filter("strict_found").count() == 1


def test_kind_counts(spark):
    items = spark.createDataFrame([("table",), ("job",), ("job",), ("dashboard",)], "type string")
    got = {r.kind: r.found for r in search.kind_counts(items, "type", ["table", "job", "stream"]).collect()}
    assert got == {"table": 1, "job": 2, "stream": 0}


def test_catalog_frames(spark):
    df = spark.createDataFrame([(1, "a")], "ID int, Name string")
    cols = {(r.column_name, r.data_type, r.ordinal) for r in actual_columns(spark, {"T1": df}).collect()}
    assert cols == {("id", "int", 1), ("name", "string", 2)}
    assert [r.table_name for r in available_tables(spark, {"T1": df}).collect()] == ["t1"]
    assert df.select(F.lit(1)).count() == 1


def test_labels_as_a_table(spark):
    import random
    rnd = random.Random(6)
    word = lambda a, b: "".join(rnd.choice("abAB_1") for _ in range(rnd.randint(a, b)))
    rows = [(word(0, 30), rnd.choice(["success", "failed"]), None if i % 9 == 0 else word(1, 12)) for i in range(150)]
    rows.append((None, "success", "x"))
    h = spark.createDataFrame(rows, "migration_id string, status string, note string")
    text = [f"{a or ''}||{b or ''}||{c or ''}".lower() for a, b, c in rows]
    labels = {word(0, 14) for _ in range(300)} | {r[0][3:17] for r in rows if r[0]} | {"SUCCESS", "||success||", "é", ""}
    table = spark.createDataFrame([(x,) for x in [*labels, None]], "needle string")
    got = {r.needle: (r.loose_found, r.strict_found) for r in search.label_presence(h, table).collect()}
    want = {x: (any(x.lower() in t for t in text), any(r[1] == "success" and r[0] is not None and r[0].startswith(x) for r in rows))
            for x in labels}
    assert got == want
    assert sum(len(x) > search.GRAM and w[0] for x, w in want.items()) > 20
    few = {r.needle: (r.loose_found, r.strict_found) for r in search.presence_modes(h, sorted(labels)).collect()}
    assert few == want
    assert search.label_presence(h, table.limit(0)).count() == 0
    empty = search.label_presence(h.limit(0), table).filter("loose_found OR strict_found")
    assert empty.count() == 0
    plan = search.label_presence(h, table)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_label_index_leaves_out_what_most_rows_have(spark, monkeypatch):
    tail = "_common_tail_of_every_row_" + "xyz" * 20
    ids = [f"v{i * 7919:06d}{tail}" for i in range(80)]
    h = spark.createDataFrame([(x, "success") for x in ids], "migration_id string, status string")
    labels = {ids[3][:14], ids[9][2:20], "v000001_common", tail[:12], "Tail_Of_Every_ROW", "tail_of_every_cow", "v00", "zzzz",
              "v0079190", ids[5].upper()}
    table = spark.createDataFrame([(x,) for x in labels], "needle string")
    want = {x: (any(x.lower() in f"{i}||success" for i in ids), any(i.startswith(x) for i in ids)) for x in labels}
    dealt = []
    real = search._index
    monkeypatch.setattr(search, "_index", lambda *a: dealt.append((real(*a), *a)) or dealt[-1][0])
    for frequent in (1, 400, 1 << 16):
        monkeypatch.setattr(search, "FREQUENT", frequent)
        got = {r.needle: (r.loose_found, r.strict_found) for r in search.label_presence(h, table).collect()}
        assert got == want
    index, texts, held, asked = dealt[1]
    every = texts.select("row", F.explode(search._pieces("text", [search.GRAM])).alias("piece"))
    assert index.count() < every.count() / 3  # every piece of every row before
    assert index.join(asked, "piece").count() == every.join(asked, "piece").count()  # no piece that a label asks for is lost
    assert dict(index.dtypes)["row"] == "bigint"  # a hash of 64 letters before
