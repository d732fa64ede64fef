"""The contract the driver's tables are validated against.

Written the way a team would write a contract for these tables: the core
order tables at v1, the event and text tables at v2, two planned tables at
v3.  A few expectations are deliberately stricter than the data (a ``date``
where the data has ``timestamp_ntz``, a column not delivered yet), so the
validation has failures to report.
"""

from __future__ import annotations

from tidemark.operators.checks import RangeRule, TableRules

# Fixed values: (table, column, expected type, since version).
CONTRACT = [
    ("region", "r_regionkey", "int", 1), ("region", "r_name", "string", 1),
    ("nation", "n_nationkey", "int", 1), ("nation", "n_name", "string", 1),
    ("nation", "n_regionkey", "integer", 1),
    ("customer", "c_custkey", "bigint", 1), ("customer", "c_name", "string", 1),
    ("customer", "c_nationkey", "int", 1), ("customer", "c_acctbal", "double", 1),
    ("customer", "c_mktsegment", "string", 1), ("customer", "c_phone", "string", 2),
    ("supplier", "s_suppkey", "bigint", 1), ("supplier", "s_name", "string", 1),
    ("supplier", "s_nationkey", "int", 1), ("supplier", "s_acctbal", "double", 1),
    ("part", "p_partkey", "bigint", 1), ("part", "p_name", "string", 1), ("part", "p_brand", "string", 1),
    ("part", "p_type", "string", 1), ("part", "p_size", "int", 1), ("part", "p_retailprice", "double", 1),
    ("orders", "o_orderkey", "bigint", 1), ("orders", "o_custkey", "bigint", 1),
    ("orders", "o_orderstatus", "string", 1), ("orders", "o_totalprice", "double", 1),
    ("orders", "o_orderdate", "date", 1), ("orders", "o_orderpriority", "string", 1),
    ("lineitem", "l_orderkey", "bigint", 1), ("lineitem", "l_partkey", "bigint", 1),
    ("lineitem", "l_suppkey", "bigint", 1), ("lineitem", "l_linenumber", "int", 1),
    ("lineitem", "l_quantity", "double", 1), ("lineitem", "l_extendedprice", "double", 1),
    ("lineitem", "l_discount", "double", 1), ("lineitem", "l_tax", "double", 1),
    ("lineitem", "l_returnflag", "string", 1), ("lineitem", "l_linestatus", "string", 1),
    ("lineitem", "l_shipdate", "timestamp_ntz", 1), ("lineitem", "l_commitdate", "timestamp_ntz", 2),
    ("events", "event_id", "bigint", 2), ("events", "ts", "timestamp_ntz", 2),
    ("events", "user_id", "bigint", 2), ("events", "event_type", "string", 2),
    ("events", "value", "double", 2), ("events", "props", "string", 2),
    ("documents", "doc_id", "bigint", 2), ("documents", "text", "string", 2),
    ("documents", "lang", "string", 2), ("documents", "source", "string", 2),
    ("documents", "n_chars", "int", 2),
    ("labels", "doc_id", "bigint", 2), ("labels", "quality", "int", 2), ("labels", "toxic", "bool", 2),
    ("pages", "page_id", "bigint", 2), ("pages", "url", "string", 2), ("pages", "html", "string", 2),
    ("conversations", "conv_id", "bigint", 2), ("conversations", "turn", "bigint", 2),
    ("conversations", "role", "string", 2), ("conversations", "text", "string", 2),
    ("benchmark", "item_id", "bigint", 2), ("benchmark", "text", "string", 2),
    ("embeddings", "vec_id", "bigint", 2), ("embeddings", "embedding", "array<float>", 2),
    ("embeddings", "label", "int", 2),
    ("shipments", "ship_id", "bigint", 3), ("shipments", "l_orderkey", "bigint", 3),
    ("returns", "return_id", "bigint", 3),
    ("orders", "o_clerk", "string", 3),
]

EXPECTED_VERSION = "v002"

# Key columns (must not be NULL) and closed value ranges.
RULES = [
    TableRules("region", ("r_regionkey",)),
    TableRules("nation", ("n_nationkey", "n_regionkey")),
    TableRules("customer", ("c_custkey", "c_nationkey"), (RangeRule("c_acctbal", 0.0, 10000.0),)),
    TableRules("supplier", ("s_suppkey", "s_nationkey"), (RangeRule("s_acctbal", 0.0, 10000.0),)),
    TableRules("part", ("p_partkey",), (RangeRule("p_size", 1, 50), RangeRule("p_retailprice", 900.0, 2000.0))),
    TableRules("orders", ("o_orderkey", "o_custkey"), (RangeRule("o_totalprice", 0.0, 500000.0),)),
    TableRules("lineitem", ("l_orderkey", "l_partkey", "l_suppkey"),
               (RangeRule("l_discount", 0.0, 0.05), RangeRule("l_quantity", 5.0, 45.0),
                RangeRule("l_tax", 0.0, 0.08))),
    TableRules("events", ("event_id", "user_id"), (RangeRule("value", 0.0, 300.0),)),
    TableRules("documents", ("doc_id",), (RangeRule("n_chars", 1, 20000),)),
    TableRules("labels", ("doc_id",), (RangeRule("quality", 0, 1), RangeRule("toxic", 0, 1))),
    TableRules("conversations", ("conv_id", "turn"), (RangeRule("turn", 0, 7),)),
    TableRules("pages", ("page_id",)),
    TableRules("benchmark", ("item_id",)),
    TableRules("embeddings", ("vec_id",), (RangeRule("label", 0, 9),)),
    # a join of two tables whose rows are counted above
    TableRules("doc_labels", ("doc_id", "quality", "toxic"), row_count=False),
]
