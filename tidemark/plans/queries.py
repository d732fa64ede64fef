"""Registered queries: every operator of the library run over the driver's
tables (whole tables, derived inputs from :mod:`tidemark.plans.mapping`).

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame.  The
matching DuckDB SQL lives in :mod:`tidemark.plans.oracle`; column names are
the same on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.hashing import bundle_hash_tree
from tidemark.functions.text import is_executable, normalize_definition
from tidemark.operators import (assembly, checks, contracts, drift, footers, hashtree, integrity, lint, migrations,
                                render, search)
from tidemark.plans import mapping as M
from tidemark.plans import snapshot
from tidemark.plans.contract import CONTRACT, EXPECTED_VERSION, RULES
from tidemark.session import scratch_folder, written
from tidemark.sources import catalog
from tidemark.sources.catalog import actual_columns, available_tables
from tidemark.sources.corpus import read_snapshot, resolve_paths

Query = Callable[[SparkSession, str], DataFrame]


# --------------------------------------------------------------------------
# Validation (contract checks)
# --------------------------------------------------------------------------

def _fused(t, kinds=(checks.ROWS, checks.NULLS, checks.RANGES)):
    """Fused checks of the tables, and of documents joined to their labels."""
    labels = t["labels"].select("doc_id", "quality", "toxic")
    joined = t["documents"].select("doc_id", "lang").join(labels, "doc_id", "left")
    return checks.fused_checks({**t, "doc_labels": joined}, RULES, kinds)


def q_row_counts(spark, sf_dir):
    return _fused(M.load_all(spark, sf_dir), (checks.ROWS,)).select(
        "table_name", F.col("observed").alias("row_count"), "severity")


def _paths(sf_dir):
    return {t: f"{sf_dir}/{t}.parquet" for t in M.TABLES}


def q_footer_counts(spark, sf_dir):
    """Row counts of all tables from their footers."""
    return footers.footer_counts(spark, _paths(sf_dir))


# Closed ranges, some of which the footers settle.
FOOTER_RANGES = [("part", "p_size", 1, 50), ("part", "p_size", 1, 49), ("customer", "c_nationkey", 0, 24),
                 ("conversations", "turn", 0, 7), ("conversations", "turn", 1, 7), ("lineitem", "l_linenumber", 1, 7),
                 ("lineitem", "l_quantity", 1, 50), ("events", "user_id", 0, 10), ("documents", "n_chars", 1, 10_000_000)]


def q_settled_ranges(spark, sf_dir):
    """Which ranges the footers settle, so that no scan is needed."""
    return footers.settled_ranges(spark, _paths(sf_dir), FOOTER_RANGES)


def q_null_counts(spark, sf_dir):
    return _fused(M.load_all(spark, sf_dir), (checks.NULLS,)).select(
        "table_name", F.col("subject").alias("column_name"), F.col("observed").alias("null_rows"), "passed")


def q_range_violations(spark, sf_dir):
    return _fused(M.load_all(spark, sf_dir), (checks.RANGES,)).select(
        "table_name", F.col("subject").alias("column_name"), F.col("check_name").alias("rule"),
        F.col("observed").alias("invalid_rows"), "passed", "message")


def q_range_violation_rows(spark, sf_dir):
    t = M.load_all(spark, sf_dir)
    cust = checks.range_violation_rows(
        t["customer"].withColumn("row_id", F.col("c_custkey").cast("string")), "customer",
        [checks.RangeRule("c_acctbal", 0.0, 10000.0)], ["row_id"])
    line = checks.range_violation_rows(
        t["lineitem"].withColumn("row_id", F.concat_ws("-", F.col("l_orderkey").cast("string"),
                                                       F.col("l_linenumber").cast("string"))),
        "lineitem", [checks.RangeRule("l_discount", 0.0, 0.05), checks.RangeRule("l_quantity", 5.0, 45.0)],
        ["row_id"])
    return cust.unionByName(line)


def _contract_checks(spark, t, expected_version=EXPECTED_VERSION):
    return contracts.contract_checks(contracts.contract_frame(spark, CONTRACT), actual_columns(spark, t),
                                     available_tables(spark, t), expected_version)


def _with_rows(t, rows):
    """Contract checks with the row count of the table they are about (null
    for a table that is not there)."""
    counts = _fused(t, (checks.ROWS,)).select("table_name", F.col("observed").alias("row_count"))
    return rows.join(counts, "table_name", "left")


def q_table_presence(spark, sf_dir):
    t = M.load_all(spark, sf_dir)
    contract = contracts.gate(contracts.contract_frame(spark, CONTRACT), "v003")
    rows = contracts.table_presence(contract, available_tables(spark, t))
    return _with_rows(t, rows).select("table_name", "passed", "message", "row_count")


def q_schema_conformance(spark, sf_dir):
    t = M.load_all(spark, sf_dir)
    contract = contracts.gate(contracts.contract_frame(spark, CONTRACT), EXPECTED_VERSION)
    rows = contracts.column_conformance(contract, actual_columns(spark, t), available_tables(spark, t))
    return _with_rows(t, rows).select(
        "table_name", F.col("subject").alias("column_name"), "passed", "message", "row_count")


def q_version_gate(spark, sf_dir):
    """The contract gated at every version the history recorded as applied."""
    full = contracts.contract_frame(spark, CONTRACT)
    applied = migrations.parse_names(
        M.history(spark, sf_dir).filter(F.col("status") == "success")
        .select(F.col("migration_name").alias("file_name"))).filter(F.col("valid"))
    return contracts.required_per_version(full, applied)


def q_version_block(spark, sf_dir):
    t = M.load_all(spark, sf_dir)
    contract, columns, tables = contracts.contract_frame(spark, CONTRACT), actual_columns(spark, t), available_tables(spark, t)
    parts = [contracts.version_block(contract, columns, tables, v)
             .withColumn("expected_version", F.lit(v)) for v in ("v002", "v003")]
    return _with_rows(t, parts[0].unionByName(parts[1])).select(
        "expected_version", "table_name", "check_name", "subject", "passed", "message", "row_count")


def q_history_checks(spark, sf_dir):
    labels = contracts.expected_version_labels("v004")
    return contracts.history_checks_both_modes(M.history(spark, sf_dir), labels)


def _all_check_rows(spark, sf_dir):
    hist = contracts.history_checks(M.history(spark, sf_dir), contracts.expected_version_labels(EXPECTED_VERSION),
                                    spark=spark)
    t = M.load_all(spark, sf_dir)
    return reduce(lambda a, b: a.unionByName(b), [_contract_checks(spark, t), _fused(t), hist])


def q_check_results(spark, sf_dir):
    return _all_check_rows(spark, sf_dir)


def q_check_summary(spark, sf_dir):
    return checks.check_summary(_all_check_rows(spark, sf_dir))


def q_verdict(spark, sf_dir):
    return checks.verdict(_all_check_rows(spark, sf_dir))


# --------------------------------------------------------------------------
# Drift
# --------------------------------------------------------------------------

def q_definition_normalize(spark, sf_dir):
    d = M.load_split(spark, sf_dir, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("object_id"), F.col("text").alias("body"))
    p = M.load_split(spark, sf_dir, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("object_id"), F.col("html").alias("body"))
    u = d.unionByName(p)
    norm = normalize_definition(F.col("body"))
    return u.select("kind", "object_id",
                    F.sha2(norm, 256).alias("normalized_sha256"),
                    F.length(norm).cast("bigint").alias("normalized_length"),
                    is_executable(F.col("body")).alias("executable"))


def _object_drift(spark, sf_dir):
    return drift.object_drift(M.baseline_objects(spark, sf_dir), M.live_objects(spark, sf_dir))


def q_object_drift(spark, sf_dir):
    return _object_drift(spark, sf_dir)


def _column_drift(spark, sf_dir):
    return drift.column_drift(M.baseline_columns(spark, sf_dir), M.live_columns(spark, sf_dir))


def q_column_drift(spark, sf_dir):
    return _column_drift(spark, sf_dir)


def q_column_differences(spark, sf_dir):
    """The sorted column differences of each modified table, as one text."""
    lists = drift.column_differences_per_object(_column_drift(spark, sf_dir))
    return lists.select("name", F.size("column_differences").alias("differences"), F.expr(
        "array_join(transform(column_differences, d -> concat_ws(' ', d.status, d.column_name)), '; ')")
        .alias("listing"))


def _table_drift(spark, sf_dir):
    return drift.table_drift(M.baseline_columns(spark, sf_dir), M.live_columns(spark, sf_dir))


def q_table_drift(spark, sf_dir):
    return _table_drift(spark, sf_dir)


# Categories the summary always lists, even with no object; others (fr, es,
# views) are listed because they occur.
SUMMARY_CATEGORIES = ("de", "en", "tables", "procedures")


def _statuses(spark, sf_dir):
    """``category, status`` of every object and table."""
    objs = _object_drift(spark, sf_dir).select("category", "status")
    return objs.unionByName(_table_drift(spark, sf_dir).select(F.lit("tables").alias("category"), "status"))


def q_drift_summary(spark, sf_dir):
    return drift.drift_summary(_statuses(spark, sf_dir), SUMMARY_CATEGORIES)


def q_drift_verdict(spark, sf_dir):
    return drift.drift_verdict(_statuses(spark, sf_dir))


def q_drift_recommendations(spark, sf_dir):
    """What to do about the live side, and about the baseline against itself."""
    base = M.baseline_objects(spark, sf_dir)
    same = drift.object_drift(base, base).select("category", "status")
    parts = [drift.recommendations(rows).withColumn("compared", F.lit(name))
             for name, rows in (("live", _statuses(spark, sf_dir)), ("itself", same))]
    return parts[0].unionByName(parts[1])


# Ignore globs of the ignore query.
IGNORE_PATTERNS = "src1?.doc*, fr:*, es/src3.doc1*.sql, [!e]*:src5.*, VIEWS:PAGE1?"


def q_ignored_objects(spark, sf_dir):
    from tidemark.functions.text import split_patterns
    pats = split_patterns(IGNORE_PATTERNS)
    _, li = drift.split_ignored(M.baseline_objects(spark, sf_dir), pats)
    _, ri = drift.split_ignored(M.live_objects(spark, sf_dir), pats)
    return drift.ignored_union(li, ri)


def q_ignored_by_table(spark, sf_dir):
    """A table of globs, one for every document, by spelling and kind of glob."""
    name, number, kind = M.doc_name(), F.col("doc_id").cast("string"), F.col("n_chars") % 4
    globs = M.load(spark, sf_dir, "documents").select(
        F.when(kind == 0, F.concat(name, F.lit("?"))).when(kind == 1, F.concat(F.col("lang"), F.lit("/"), name, F.lit(".*")))
        .when(kind == 2, F.concat(F.lit(" *:"), name)).otherwise(F.concat(F.lit("VIEWS:PAGE"), number, F.lit("[0-4]")))
        .alias("pattern"))
    both = [M.baseline_objects(spark, sf_dir), M.live_objects(spark, sf_dir)]
    objects = reduce(lambda a, b: a.unionByName(b), [o.select("category", "name", "relative_path") for o in both]).distinct()
    return drift.ignored_by(objects, globs)


def q_raw_hash_diff(spark, sf_dir):
    l = M.baseline_objects(spark, sf_dir).withColumn("sha256", F.sha2("definition", 256))
    r = M.live_objects(spark, sf_dir).withColumn("sha256", F.sha2("definition", 256))
    return drift.raw_hash_diff(l, r)


def q_tree_drift(spark, sf_dir):
    """The snapshots stored as digest trees, then compared from the top down."""
    folder = scratch_folder(spark, "trees")
    for name, objs in (("left", M.baseline_objects(spark, sf_dir)), ("right", M.live_objects(spark, sf_dir))):
        hashtree.write_tree(objs.withColumn("sha256", F.sha2("definition", 256)), f"{folder}/{name}")
    return hashtree.tree_drift(spark, f"{folder}/left", f"{folder}/right")


# --------------------------------------------------------------------------
# Snapshot: artifacts, manifest, bundle hash, render, parse, modules
# --------------------------------------------------------------------------

def q_snapshot_roundtrip(spark, sf_dir):
    """Artifacts exported, exported again with other texts, and the export read back: the version published last."""
    folder = scratch_folder(spark, "snapshot")
    arts = M.doc_artifacts(spark, sf_dir)
    snapshot.write(arts.withColumn("content", F.lit("an older text")), folder)
    snapshot.write(arts, folder)
    _, objects = read_snapshot(spark, folder)
    return objects.select("category", "name", "relative_path", "sha256")


def q_artifact_manifest(spark, sf_dir):
    return render.manifest_files(M.doc_artifacts(spark, sf_dir))


def q_manifest_counts(spark, sf_dir):
    return render.manifest_counts(M.doc_artifacts(spark, sf_dir))


def q_bundle_hash(spark, sf_dir):
    return bundle_hash_tree(M.doc_artifacts(spark, sf_dir), ["object_type"], total="*")


def q_names_per_type(spark, sf_dir):
    """The names of each type in order, with how many there are."""
    return render.names_in_order(M.doc_artifacts(spark, sf_dir))


def q_render_definition(spark, sf_dir):
    return M.order_table_texts(spark, sf_dir).select(
        "qualified_name", F.col("definition"), F.sha2("definition", 256).alias("definition_sha256"))


def q_definition_lines(spark, sf_dir):
    o = M.load(spark, sf_dir, "orders")
    li = M.load(spark, sf_dir, "lineitem")
    tables = o.select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("schema_name"),
                      F.concat(F.lit("order"), F.col("o_orderkey").cast("string")).alias("table_name"))
    typ = (F.when(F.col("l_returnflag") == "R", F.lit("nvarchar"))
           .when(F.col("l_returnflag") == "A", F.lit("decimal")).otherwise(F.lit("datetime2")))
    cols = li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey).select(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("schema_name"),
        F.concat(F.lit("order"), F.col("l_orderkey").cast("string")).alias("table_name"),
        F.concat(F.lit("part"), F.col("l_partkey").cast("string")).alias("column_name"),
        F.col("l_linenumber").alias("ordinal_position"),
        typ.alias("data_type"),
        F.when(F.col("l_quantity") > 45, F.lit(-1)).otherwise((F.col("l_quantity") * 10).cast("int"))
        .alias("character_maximum_length"),
        F.lit(18).alias("numeric_precision"),
        (F.col("l_tax") * 100).cast("int").alias("numeric_scale"),
        (F.col("l_linenumber") - 1).alias("datetime_precision"),
        (F.col("l_linestatus") == "O").alias("is_nullable"),
        F.when(F.col("l_discount") == 0, F.lit("((0))")).alias("column_default"))
    return render.definition_lines(cols, None, tables)


def q_parse_definition_columns(spark, sf_dir):
    defs = M.order_table_texts(spark, sf_dir)
    return render.parse_definition_columns(defs).select(
        "qualified_name", "column_name", "ordinal", "type_sql", "column_definition")


def q_unparsed_definitions(spark, sf_dir):
    """Definitions that lost their head or their opening parenthesis, found
    among those that are whole."""
    defs = M.order_table_texts(spark, sf_dir)
    end, text = F.substring("qualified_name", -1, 1), F.col("definition")
    broken = (F.when(end == "7", F.replace(text, F.lit("CREATE TABLE"), F.lit("TABLE")))
              .when(end == "3", F.regexp_replace(text, r"\] \(\n", "]\n")).otherwise(text))
    return render.unparsed_definitions(defs.withColumn("definition", broken))


def _texts(spark, sf_dir, live):
    return M.order_table_texts(spark, sf_dir, live=live, digest=drift.COLUMNS_DIGEST).select(
        F.lit("tables").alias("category"), F.col("qualified_name").alias("name"), "definition", drift.COLUMNS_DIGEST,
        F.lit(None).cast("string").alias("relative_path"))


def q_catalog_drift(spark, sf_dir):
    """Two rendered catalogs compared in one join: the digest of a definition
    decides the status, and the digest of its columns' names and types whether
    a modified table gets the second detail."""
    left, right = (_texts(spark, sf_dir, live) for live in (False, True))
    return drift.object_drift(left, right).select("category", "name", "status", "details")


def q_normalize_module(spark, sf_dir):
    return render.normalize_module(M.modules(spark, sf_dir))


def _constraint_names(key):
    order = F.concat(F.lit("order"), F.col(key).cast("string"))
    return [F.lit("main").alias("constraint_catalog"), F.lit("sales").alias("constraint_schema"),
            F.concat(F.lit("k"), F.col(key).cast("string")).alias("constraint_name"),
            F.lit("sales").alias("schema_name"), order.alias("table_name")]


def _key_columns(spark, sf_dir):
    """Constraints (orders; cancelled ones are checks and no keys) and the
    columns they use (lineitems)."""
    kind = (F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("PRIMARY KEY"))
            .when(F.col("o_orderstatus") == "P", F.lit("CHECK")).otherwise(F.lit("UNIQUE")))
    cons = M.load(spark, sf_dir, "orders").select(*_constraint_names("o_orderkey"), kind.alias("constraint_type"))
    usage = M.load(spark, sf_dir, "lineitem").select(
        *_constraint_names("l_orderkey"), F.concat(F.lit("part"), F.col("l_partkey").cast("string")).alias("column_name"),
        F.col("l_linenumber").alias("ordinal_position"))
    return assembly.key_columns(cons, usage)


def q_keyed_columns(spark, sf_dir):
    """Key constraints joined to their key columns, one row per key column."""
    return _key_columns(spark, sf_dir)


def q_ordered_keys(spark, sf_dir):
    """One row per key with its columns in order."""
    keys = render.constraint_columns_ordered(_key_columns(spark, sf_dir))
    return keys.select("table_name", "constraint_name", "constraint_type", F.array_join("columns", ", ").alias("columns"))


def q_module_join(spark, sf_dir):
    """Modules (customers) with their objects (nations, of kinds V, P and U)
    and schemas (regions, one of which counts as the system's)."""
    c, n, r = (M.load(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    kind = F.element_at(F.array(*map(F.lit, ("V", "P", "U"))), (F.col("n_nationkey") % 3 + 1).cast("int"))
    return assembly.module_texts(
        c.select(F.col("c_nationkey").alias("object_id"), F.col("c_name").alias("definition")),
        n.select(F.col("n_nationkey").alias("object_id"), F.col("n_regionkey").alias("schema_id"),
                 F.col("n_name").alias("object_name"), kind.alias("object_type")),
        r.select(F.col("r_regionkey").alias("schema_id"), F.col("r_name").alias("schema_name")),
        system=("MIDDLE EAST",))


def q_attach_children(spark, sf_dir):
    o = M.load(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P")
    li = M.load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return assembly.children_of(li, o, ["o_orderkey"]).groupBy("o_orderkey").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_columns"))


def q_orphans(spark, sf_dir):
    d, lab, o, li = (M.load(spark, sf_dir, t) for t in ("documents", "labels", "orders", "lineitem"))
    unlabeled = assembly.missing_parts(d, lab, ["doc_id"], "document_without_label").select(
        F.col("error").alias("kind"), F.col("doc_id").alias("object_id"))
    empty = assembly.missing_parts(o, li.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"],
                                   "order_without_lines").select(F.col("error").alias("kind"),
                                                                 F.col("o_orderkey").alias("object_id"))
    return unlabeled.unionByName(empty)


def q_assembly_errors(spark, sf_dir):
    """Views (documents) that no module (labelled ones; toxic ones are
    procedures) defines, and tables (orders) without columns (lineitems)."""
    d, lab, o, li = (M.load(spark, sf_dir, t) for t in ("documents", "labels", "orders", "lineitem"))

    def names(df, schema, key, name):
        return df.select(schema.alias("schema_name"), F.col(key).cast("string").alias(name))

    modules = names(d.join(lab, "doc_id"), F.col("source"), "doc_id", "object_name").join(
        lab.select(F.col("doc_id").cast("string").alias("object_name"),
                   F.when(F.col("toxic") == 1, F.lit("P")).otherwise(F.lit("V")).alias("object_type")), "object_name")
    views = assembly.views_without_text(names(d, F.col("source"), "doc_id", "object_name"), modules)
    tables = assembly.tables_without_columns(names(o, F.lit("sales"), "o_orderkey", "table_name"),
                                             names(li, F.lit("sales"), "l_orderkey", "table_name"))
    return views.unionByName(tables.withColumnRenamed("table_name", "object_name"))


def q_catalog_from_views(spark, sf_dir):
    """A catalog from view frames: orders as tables (pending ones are views) in
    schemas by priority, one of which is the system's and one unknown; lineitems
    as columns; customers as modules of the views, some of them blank names."""
    o, li, c = (M.load(spark, sf_dir, t) for t in ("orders", "lineitem", "customer"))
    schema = F.when(F.col("o_orderpriority").startswith("5"), F.lit("sys")).otherwise(F.lower("o_orderpriority"))
    table = F.concat(F.lit("order"), F.col("o_orderkey").cast("string"))
    tables = o.select(schema.alias("schema_name"), table.alias("table_name"), "o_orderkey", "o_custkey",
                      F.when(F.col("o_orderstatus") == "P", F.lit("VIEW")).otherwise(F.lit("BASE TABLE")).alias("table_type"))
    schemata = o.select(schema.alias("schema_name")).filter(~F.col("schema_name").startswith("4")).distinct()
    keyed = li.join(tables.select("schema_name", "table_name", F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")
    columns = keyed.select("schema_name", "table_name",
                           F.concat(F.lit("part"), F.col("l_partkey").cast("string")).alias("column_name"),
                           F.col("l_linenumber").alias("ordinal_position"),
                           F.when(F.col("l_linestatus") == "O", F.lit("YES")).otherwise(F.lit("NO")).alias("is_nullable"))
    named = [F.lit("main").alias("constraint_catalog"), F.col("schema_name").alias("constraint_schema"),
             F.concat(F.lit("pk_"), F.col("table_name")).alias("constraint_name"), "schema_name", "table_name"]
    constraints = tables.select(*named, F.lit("PRIMARY KEY").alias("constraint_type"))
    usage = keyed.filter("l_linenumber <= 2").select(
        *named, F.concat(F.lit("part"), F.col("l_partkey").cast("string")).alias("column_name"),
        F.col("l_linenumber").alias("ordinal_position"))
    views = tables.filter(F.col("table_type") == "VIEW")
    cat = catalog.from_views(
        schemata, tables.select("schema_name", "table_name", "table_type"), columns, constraints, usage,
        c.join(views, F.col("c_custkey") == F.col("o_custkey")).select(
            F.col("o_orderkey").alias("object_id"), F.col("c_name").alias("definition")),
        views.filter(F.col("o_custkey") % 2 == 0).select(
            F.col("o_orderkey").alias("object_id"), F.col("schema_name").alias("schema_id"),
            F.col("table_name").alias("object_name"), F.lit("V").alias("object_type")),
        schemata.select(F.col("schema_name").alias("schema_id"), "schema_name"))
    at = ["schema_name", "object_name"]
    parts = cat.columns.withColumnRenamed("table_name", "object_name").groupBy(*at).agg(
        F.count(F.lit(1)).alias("columns"), F.count_if(~F.col("is_nullable")).alias("not_null"))
    keys = cat.keys.withColumnRenamed("table_name", "object_name").groupBy(*at).agg(F.count(F.lit(1)).alias("key_columns"))
    texts = cat.modules.select(*at, F.col("definition").alias("text"))
    listed = cat.tables.withColumnRenamed("table_name", "object_name")
    return (listed.join(parts, at, "left").join(keys, at, "left").join(texts, at, "left").join(cat.errors, at, "left")
            .select(*at, "table_type", *[F.coalesce(n, F.lit(0)).alias(n) for n in ("columns", "not_null", "key_columns")],
                    "text", "error"))


def q_table_lifecycle(spark, sf_dir):
    """A table created from a schema, filled by name, widened, left alone by a
    seed (it has rows) and filled further; then read."""
    name, folder = f"customers_{uuid.uuid4().hex}", scratch_folder(spark, "table")
    narrow = T.StructType([f for f in CUSTOMER_TARGET.fields if f.name not in ("c_phone", "c_credit_limit")])
    migrations.ensure_table(spark, name, narrow, "customers and suppliers", location=folder)
    migrations.insert_by_name(M.load(spark, sf_dir, "customer"), name)
    migrations.add_missing_columns_table(spark, name, CUSTOMER_TARGET)
    more = M.load(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("c_acctbal"), F.col("s_name").alias("c_name"), F.col("s_suppkey").alias("c_custkey"),
        F.concat(F.lit("+"), F.col("s_nationkey").cast("string")).alias("c_phone"))
    if not migrations.seed_if_empty(spark, name, more):
        migrations.insert_by_name(more, name)
    return spark.table(name)


def q_resolve_paths(spark, sf_dir):
    """Paths by a manifest that lists good documents twice; the files of toxic
    ones, and those that the manifest names without a label, are not there."""
    objs = M.baseline_objects(spark, sf_dir)
    d = M.load(spark, sf_dir, "documents")
    lab = M.load(spark, sf_dir, "labels")
    listed = d.join(lab.filter(F.col("quality") == 1), "doc_id", "left_semi").select(
        M.doc_name().alias("qualified_name"), F.col("lang").alias("object_type"),
        F.explode(F.array(*[F.concat(F.lit(f"{top}/"), F.col("lang"), F.lit("/"), F.col("doc_id").cast("string"),
                                     F.lit(".sql")) for top in ("manifest", "other")])).alias("relative_path"))
    clean = d.join(lab.filter(F.col("toxic") == 1), "doc_id", "left_anti")
    present = listed.join(clean.select(M.doc_name().alias("qualified_name")), "qualified_name", "left_semi").select(
        "relative_path").unionByName(objs.join(clean.select(M.doc_name().alias("name")), "name", "left_semi")
                                     .select("relative_path"))
    return resolve_paths(objs, listed, present).select("category", "name", "resolved_path", "from_manifest", "found")


# --------------------------------------------------------------------------
# Migrations
# --------------------------------------------------------------------------

def q_migration_files(spark, sf_dir):
    return migrations.parse_names(M.script_files(spark, sf_dir)).select(
        "file_name", "migration_id", "version", "extension", "valid")


def q_migration_pending(spark, sf_dir):
    files = migrations.discover(M.script_files(spark, sf_dir), "sql")
    return migrations.pending(files, M.history(spark, sf_dir)).select("file_name", "migration_id", "version")


def q_migration_run_order(spark, sf_dir):
    """The pending scripts' places in run order."""
    files = migrations.discover(M.script_files(spark, sf_dir), "sql")
    todo = migrations.pending(files, M.history(spark, sf_dir)).select("migration_id", "version", "doc_id")
    return migrations.with_run_rank(todo, "doc_id")


def q_drift_report_order(spark, sf_dir):
    """Every object's place in the drift report."""
    rows = _object_drift(spark, sf_dir).select("category", "name", "status", "status_rank")
    return drift.with_report_rank(rows).drop("status_rank")


def _outcomes(spark, sf_dir):
    """What would become of every pending script: blank ones fail.  Written, as a run's outcomes are facts and are
    read twice: for the first failure and for what it leaves pending."""
    files = migrations.discover(M.script_files(spark, sf_dir), "sql")
    todo = migrations.pending(files, M.history(spark, sf_dir))
    status = F.when(is_executable(F.col("content")), F.lit("success")).otherwise(F.lit("failed"))
    return written(todo.select("version", "migration_id", "doc_id", "file_name", "migration_type", status.alias("status")),
                   "outcomes")


def q_history_outcomes(spark, sf_dir):
    """A run that stops at its first failing script: what the history records, and what stays pending."""
    return migrations.until_first_failure(_outcomes(spark, sf_dir), "doc_id").select(
        "migration_id", "version", "doc_id", "state")


def q_history_reruns(spark, sf_dir):
    """The recorded part of the run appended twice, as a retry does, and a second run beside it."""
    folder = scratch_folder(spark, "history")
    states = migrations.until_first_failure(_outcomes(spark, sf_dir), "doc_id").filter("state <> 'pending'")
    for run_id, status, user in (("run1", None, "nobody"), ("run1", None, "nobody"), ("run2", "success", None)):
        runs = states.select("migration_id", "file_name", "migration_type", F.col("state").alias("status"))
        migrations.append_run(migrations.history_rows(runs, status, user, M.APPLIED_AT), run_id, folder)
    return migrations.read_runs(spark, folder).groupBy("run_id", "status").agg(
        F.count(F.lit(1)).alias("runs"), F.count_if(F.col("applied_by") == F.current_user()).alias("by_session_user"))


def q_migration_skipped(spark, sf_dir):
    return migrations.skipped(M.script_files(spark, sf_dir), "sql")


def q_history_append(spark, sf_dir):
    files = migrations.discover(M.script_files(spark, sf_dir), "sql")
    h = M.history(spark, sf_dir)
    todo = migrations.pending(files, h).withColumn("duration_seconds", F.col("n_chars") / F.lit(1000.0))
    new_rows = migrations.history_rows(todo, "success", M.RUN_BY, M.APPLIED_AT, "duration_seconds",
                                       timestamp_type="timestamp_ntz")
    return migrations.history_totals(h.unionByName(new_rows))


# The target customer schema of the evolution query.
CUSTOMER_TARGET = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType()), T.StructField("c_phone", T.StringType()),
    T.StructField("c_credit_limit", T.DoubleType()),
])


def q_evolve_add_missing(spark, sf_dir):
    c = M.load(spark, sf_dir, "customer")
    return migrations.evolve(migrations.evolve(c, CUSTOMER_TARGET), CUSTOMER_TARGET)


def q_seed_missing(spark, sf_dir):
    """Default label rows for the documents that have no label yet."""
    labels = M.load(spark, sf_dir, "labels")
    seed = M.load(spark, sf_dir, "documents").select(
        "doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    return migrations.seed_missing(labels, seed, ["doc_id"])


# --------------------------------------------------------------------------
# Search
# --------------------------------------------------------------------------

def q_text_search(spark, sf_dir):
    return search.text_search(M.history(spark, sf_dir), "V01")


# Version labels the presence query looks for.
PRESENCE_NEEDLES = ("v001", "v002", "v010", "v100", "v250", "v999", "v4999", "src1")


def q_version_presence(spark, sf_dir):
    return search.presence_modes(M.history(spark, sf_dir), PRESENCE_NEEDLES)


def q_label_presence(spark, sf_dir):
    """A table of labels, two for every document, looked for in the history."""
    number = F.format_string("v%03d", F.col("doc_id"))
    labels = M.load(spark, sf_dir, "documents").select(F.explode(F.array(
        number, F.concat(number, F.lit("_"), F.upper("source"), F.lit("-es")))).alias("needle"))
    return search.label_presence(M.history(spark, sf_dir), labels)


def q_expected_kind_counts(spark, sf_dir):
    ev = M.load(spark, sf_dir, "events")
    return search.kind_counts(ev, "event_type", ["click", "purchase", "view", "signup", "refund"])


# --------------------------------------------------------------------------
# Lint
# --------------------------------------------------------------------------

def q_lint_findings(spark, sf_dir):
    # versions below 1,000, as the validator's rule takes three digits
    return lint.lint(M.script_files(spark, sf_dir, numbers=300).select("file_name", "content"))


def q_lint_summary(spark, sf_dir):
    return lint.lint_summary(q_lint_findings(spark, sf_dir))


# --------------------------------------------------------------------------
# Declared rules (extensions)
# --------------------------------------------------------------------------

def q_dup_keys(spark, sf_dir):
    return integrity.duplicate_keys(M.load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# Relations, some of which hold and some of which do not.
RELATIONS = [("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"),
             ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("lineitem", "l_partkey", "supplier", "s_suppkey"),
             ("orders", "o_custkey", "customer", "c_custkey"), ("orders", "o_orderkey", "lineitem", "l_orderkey"),
             ("labels", "doc_id", "documents", "doc_id"), ("documents", "doc_id", "labels", "doc_id"),
             ("customer", "c_nationkey", "nation", "n_nationkey")]


def q_fk_orphans(spark, sf_dir):
    return integrity.foreign_key_orphans(M.load_all(spark, sf_dir), RELATIONS)


def q_accepted_values(spark, sf_dir):
    t = M.load_all(spark, sf_dir)
    rules = [("orders", "o_orderstatus", ("F", "O")),
             ("events", "event_type", ("click", "purchase", "view", "signup")),
             ("conversations", "role", ("system", "user", "assistant")),
             ("documents", "lang", ("en", "fr", "de"))]
    return integrity.accepted_values(t, rules)


def q_cross_column(spark, sf_dir):
    """An order's total against the sum of its lines' prices; the tolerance is
    wide, as the two are made independently."""
    t = M.load_all(spark, sf_dir)
    return integrity.total_agreement(t["orders"], "o_orderkey", "o_totalprice", t["lineitem"], "l_orderkey",
                                     "l_extendedprice", "order_total_vs_lines", "100000")


def q_column_agreement(spark, sf_dir):
    """Cross-column rules checked in one aggregate per table."""
    t = M.load_all(spark, sf_dir)
    return integrity.expression_agreement(t["documents"], "documents", [
        ("n_chars_is_text_length", "length(text)", "CAST(n_chars AS DOUBLE)", 0.0),
        ("n_chars_is_text_bytes", "octet_length(text)", "CAST(n_chars AS DOUBLE)", 0.0),
    ]).unionByName(integrity.expression_agreement(t["lineitem"], "lineitem", [
        ("tax_capped", "l_tax", "least(l_tax, 0.05D)", 0.0),
        ("price_per_unit_under_2000", "l_extendedprice / l_quantity", "least(l_extendedprice / l_quantity, 2000D)",
         0.0),
    ]))


def q_version_gaps(spark, sf_dir):
    h = M.history(spark, sf_dir).filter(F.col("status") == "success")
    versions = migrations.parse_names(h.withColumnRenamed("migration_name", "file_name").select("file_name")) \
        .filter(F.col("valid")).select("version")
    return integrity.version_gaps(versions)


QUERIES: dict[str, Query] = {
    "row_counts": q_row_counts,
    "footer_counts": q_footer_counts,
    "settled_ranges": q_settled_ranges,
    "null_counts": q_null_counts,
    "range_violations": q_range_violations,
    "range_violation_rows": q_range_violation_rows,
    "table_presence": q_table_presence,
    "schema_conformance": q_schema_conformance,
    "version_gate": q_version_gate,
    "version_block": q_version_block,
    "history_checks": q_history_checks,
    "check_results": q_check_results,
    "check_summary": q_check_summary,
    "verdict": q_verdict,
    "definition_normalize": q_definition_normalize,
    "object_drift": q_object_drift,
    "column_drift": q_column_drift,
    "column_differences": q_column_differences,
    "table_drift": q_table_drift,
    "drift_report_order": q_drift_report_order,
    "drift_summary": q_drift_summary,
    "drift_verdict": q_drift_verdict,
    "drift_recommendations": q_drift_recommendations,
    "ignored_objects": q_ignored_objects,
    "ignored_by_table": q_ignored_by_table,
    "raw_hash_diff": q_raw_hash_diff,
    "tree_drift": q_tree_drift,
    "snapshot_roundtrip": q_snapshot_roundtrip,
    "artifact_manifest": q_artifact_manifest,
    "manifest_counts": q_manifest_counts,
    "names_per_type": q_names_per_type,
    "bundle_hash": q_bundle_hash,
    "render_definition": q_render_definition,
    "definition_lines": q_definition_lines,
    "parse_definition_columns": q_parse_definition_columns,
    "unparsed_definitions": q_unparsed_definitions,
    "normalize_module": q_normalize_module,
    "catalog_drift": q_catalog_drift,
    "keyed_columns": q_keyed_columns,
    "ordered_keys": q_ordered_keys,
    "module_join": q_module_join,
    "attach_children": q_attach_children,
    "orphans": q_orphans,
    "assembly_errors": q_assembly_errors,
    "catalog_from_views": q_catalog_from_views,
    "table_lifecycle": q_table_lifecycle,
    "resolve_paths": q_resolve_paths,
    "migration_files": q_migration_files,
    "migration_pending": q_migration_pending,
    "migration_run_order": q_migration_run_order,
    "history_outcomes": q_history_outcomes,
    "history_reruns": q_history_reruns,
    "migration_skipped": q_migration_skipped,
    "history_append": q_history_append,
    "evolve_add_missing": q_evolve_add_missing,
    "seed_missing": q_seed_missing,
    "text_search": q_text_search,
    "version_presence": q_version_presence,
    "label_presence": q_label_presence,
    "expected_kind_counts": q_expected_kind_counts,
    "lint_findings": q_lint_findings,
    "lint_summary": q_lint_summary,
    "dup_keys": q_dup_keys,
    "fk_orphans": q_fk_orphans,
    "accepted_values": q_accepted_values,
    "cross_column": q_cross_column,
    "version_gaps": q_version_gaps,
    "column_agreement": q_column_agreement,
}
