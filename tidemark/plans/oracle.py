"""DuckDB SQL for every registered query (the correctness oracle).

SQL over the same parquet tables, written apart from the library: nothing is
imported from it, and every contract row, rule, pattern and message is spelled
out here.  DuckDB differences handled here: ``upper('ß')`` is ``ẞ`` in DuckDB
but ``SS`` in Spark, regex replace needs the ``'g'`` flag, double to int casts
round instead of truncating, and decimal literals need casts.
"""

from __future__ import annotations

# White space, the run's time and user, the search labels and
# listed categories of the queries.
WS = (r"[\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
APPLIED_AT_SQL = "TIMESTAMP '2031-05-06 07:08:09'"
RUN_BY = "tidemark"
LISTED_CATEGORIES = ("de", "en", "tables", "procedures")
SEARCHED_LABELS = ("v001", "v002", "v010", "v100", "v250", "v999", "v4999", "src1")
IGNORED = ("src1?.doc*", "fr:*", "es/src3.doc1*.sql", "[!e]*:src5.*", "views:page1?")

# Drift details.
DETAIL_ADDED, DETAIL_REMOVED = "only_compared", "only_baseline"
DETAIL_SAME, DETAIL_CHANGED, DETAIL_NO_COLUMN = "same_text", "changed_text", "changed_text; same_columns"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def norm(x: str) -> str:
    stripped = (f"regexp_replace(regexp_replace({x}, '(?s)/\\*.*?\\*/', ' ', 'g'), "
                f"'(?m)--.*$', ' ', 'g')")
    collapsed = f"trim(regexp_replace({stripped}, '{WS}+', ' ', 'g'))"
    return f"upper(replace({collapsed}, 'ß', 'SS'))"


def executable(x: str) -> str:
    stripped = (f"regexp_replace(regexp_replace({x}, '(?s)/\\*.*?\\*/', '', 'g'), "
                f"'(?m)--.*$', '', 'g')")
    return f"(regexp_replace({stripped}, '{WS}+', '', 'g') <> '')"


def sanitize(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '[<>:\"/\\\\|?*]', '_', 'g'), '[. ]+$', '')"


def strip_ws(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def qi(x: str) -> str:
    return f"('[' || replace({x}, ']', ']]') || ']')"


DOC_NAME = "(source || '.doc' || CAST(doc_id AS VARCHAR))"

BASE_OBJ = f"""SELECT lang AS category, {DOC_NAME} AS name, text AS definition,
  lang || '/' || {sanitize(DOC_NAME)} || '.sql' AS relative_path FROM documents"""

LIVE_OBJ = f"""SELECT d.lang AS category, d.source || '.doc' || CAST(d.doc_id AS VARCHAR) AS name,
  CASE WHEN l.quality = 0 THEN d.text || chr(10) || 'REVISED'
       WHEN l.quality = 1 THEN lower(d.text) || '  -- reviewed'
       ELSE d.text END AS definition,
  d.lang || '/' || {sanitize("d.source || '.doc' || CAST(d.doc_id AS VARCHAR)")} || '.sql' AS relative_path
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE coalesce(l.toxic, 0) = 0
UNION ALL
SELECT 'views', 'page' || CAST(page_id AS VARCHAR), html,
  'views/' || {sanitize("'page' || CAST(page_id AS VARCHAR)")} || '.sql' FROM pages"""

STATUS_RANK = ("CASE status WHEN 'modified' THEN 0 WHEN 'added' THEN 1 WHEN 'removed' THEN 2 "
               "WHEN 'unchanged' THEN 3 END")
STATUS_SYMBOL = "CASE status WHEN 'modified' THEN '~' WHEN 'added' THEN '!' WHEN 'removed' THEN '!' ELSE '=' END"

OBJECT_DRIFT = f"""
WITH l AS (SELECT category, name, sha256({norm('definition')}) AS left_norm, relative_path AS left_path
           FROM ({BASE_OBJ})),
r AS (SELECT category, name, sha256({norm('definition')}) AS right_norm, relative_path AS right_path
      FROM ({LIVE_OBJ})),
j AS (SELECT coalesce(l.category, r.category) AS category, coalesce(l.name, r.name) AS name,
             l.left_norm, r.right_norm, l.left_path, r.right_path,
             l.name IS NOT NULL AS in_l, r.name IS NOT NULL AS in_r
      FROM l FULL OUTER JOIN r ON l.category = r.category AND l.name = r.name),
s AS (SELECT *, CASE WHEN NOT in_l THEN 'added' WHEN NOT in_r THEN 'removed'
                     WHEN left_norm IS NOT DISTINCT FROM right_norm THEN 'unchanged'
                     ELSE 'modified' END AS status FROM j)
SELECT category, name, status, {STATUS_RANK} AS status_rank, {STATUS_SYMBOL} AS symbol,
  CASE status WHEN 'added' THEN {q(DETAIL_ADDED)} WHEN 'removed' THEN {q(DETAIL_REMOVED)}
              WHEN 'unchanged' THEN {q(DETAIL_SAME)} ELSE {q(DETAIL_CHANGED)} END AS details,
  left_path, right_path
FROM s"""

_USER_T = "CASE WHEN role = 'user' THEN 'NVARCHAR(4000)' ELSE 'NVARCHAR(MAX)' END"
_LIVE_T = ("CASE WHEN role = 'user' AND length(text) > 200 THEN 'NVARCHAR(MAX)' "
           "WHEN role = 'user' THEN 'NVARCHAR(4000)' ELSE 'NVARCHAR(MAX)' END")
BASE_COLS = f"""SELECT 'conv' || CAST(conv_id AS VARCHAR) AS name, 'turn_' || CAST(turn AS VARCHAR) AS column_name,
  CAST(turn AS BIGINT) AS ordinal, {_USER_T} AS type_sql, {_USER_T} || ' NOT NULL' AS definition
FROM conversations"""
LIVE_COLS = f"""SELECT 'conv' || CAST(conv_id AS VARCHAR) AS name, 'turn_' || CAST(turn AS VARCHAR) AS column_name,
  CAST(turn AS BIGINT) AS ordinal, {_LIVE_T} AS type_sql,
  {_LIVE_T} || CASE WHEN role = 'assistant' AND length(text) > 1500 THEN ' NULL' ELSE ' NOT NULL' END AS definition
FROM conversations WHERE role <> 'system'
UNION ALL
SELECT 'conv' || CAST(conv_id AS VARCHAR), 'turn_' || CAST(turn AS VARCHAR) || '_note', CAST(turn + 100 AS BIGINT),
  'NVARCHAR(200)', 'NVARCHAR(200) NULL'
FROM conversations WHERE role = 'user' AND length(text) < 60
UNION ALL
SELECT 'bench' || CAST(item_id AS VARCHAR), 'body', CAST(1 AS BIGINT), 'NVARCHAR(MAX)', 'NVARCHAR(MAX) NOT NULL'
FROM benchmark"""

COLUMN_JOIN = f"""
WITH l AS (SELECT name, column_name, type_sql AS left_type, {norm('type_sql')} AS left_ntype,
                  sha256(CAST(ordinal AS VARCHAR) || chr(1) || {norm('definition')}) AS left_ndef
           FROM ({BASE_COLS})),
r AS (SELECT name, column_name, type_sql AS right_type, {norm('type_sql')} AS right_ntype,
             sha256(CAST(ordinal AS VARCHAR) || chr(1) || {norm('definition')}) AS right_ndef
      FROM ({LIVE_COLS})),
j AS (SELECT coalesce(l.name, r.name) AS name, coalesce(l.column_name, r.column_name) AS column_name,
             l.left_type, r.right_type, l.left_ntype, r.right_ntype, l.left_ndef, r.right_ndef,
             l.name IS NOT NULL AS in_l, r.name IS NOT NULL AS in_r
      FROM l FULL OUTER JOIN r ON l.name = r.name AND l.column_name = r.column_name),
c AS (SELECT *, CASE WHEN NOT in_l THEN 'added' WHEN NOT in_r THEN 'removed'
                     WHEN left_ntype IS DISTINCT FROM right_ntype THEN 'type_changed'
                     WHEN left_ndef IS DISTINCT FROM right_ndef THEN 'definition_changed'
                     ELSE 'same' END AS col_status FROM j)"""

COLUMN_DRIFT = COLUMN_JOIN + """
SELECT name, column_name, col_status AS status,
  CASE WHEN col_status <> 'added' THEN left_type END AS left_type,
  CASE WHEN col_status <> 'removed' THEN right_type END AS right_type
FROM c WHERE col_status IN ('added', 'removed', 'type_changed')
  AND name IN (SELECT name FROM c GROUP BY name
               HAVING bool_or(in_l) AND bool_or(in_r) AND bool_or(col_status <> 'same'))"""

COLUMN_DIFFERENCES = f"""
SELECT name, CAST(count(*) AS INTEGER) AS differences,
  string_agg(status || ' ' || column_name, '; ' ORDER BY lower(column_name), column_name) AS listing
FROM ({COLUMN_DRIFT}) GROUP BY name"""

TABLE_DRIFT = COLUMN_JOIN + f""",
t AS (SELECT name, bool_or(in_l) AS in_left, bool_or(in_r) AS in_right,
             CAST(count(*) FILTER (col_status = 'added') AS BIGINT) AS columns_added,
             CAST(count(*) FILTER (col_status = 'removed') AS BIGINT) AS columns_removed,
             CAST(count(*) FILTER (col_status = 'type_changed') AS BIGINT) AS columns_retyped,
             CAST(count(*) FILTER (col_status = 'definition_changed') AS BIGINT) AS columns_redefined
      FROM c GROUP BY name),
s AS (SELECT *, columns_added + columns_removed + columns_retyped AS ncd,
             CASE WHEN NOT in_left THEN 'added' WHEN NOT in_right THEN 'removed'
                  WHEN columns_added + columns_removed + columns_retyped + columns_redefined > 0 THEN 'modified'
                  ELSE 'unchanged' END AS status FROM t)
SELECT name, status, {STATUS_RANK} AS status_rank,
  CAST(CASE WHEN status = 'modified' THEN ncd ELSE 0 END AS BIGINT) AS n_column_differences,
  columns_added, columns_removed, columns_retyped,
  CASE WHEN status = 'added' THEN {q(DETAIL_ADDED)} WHEN status = 'removed' THEN {q(DETAIL_REMOVED)}
       WHEN status = 'unchanged' THEN {q(DETAIL_SAME)}
       WHEN ncd = 0 THEN {q(DETAIL_NO_COLUMN)}
       ELSE {q(DETAIL_CHANGED)} END AS details
FROM s"""

_CATS = ", ".join(f"({q(c)})" for c in LISTED_CATEGORIES)
STATUSES = f"SELECT category, status FROM ({OBJECT_DRIFT}) UNION ALL SELECT 'tables', status FROM ({TABLE_DRIFT})"
DRIFT_SUMMARY = f"""
WITH u AS ({STATUSES}),
cats AS (SELECT * FROM (VALUES {_CATS}) v(category) UNION SELECT category FROM u)
SELECT category, CAST(count(*) FILTER (status = 'added') AS BIGINT) AS added,
  CAST(count(*) FILTER (status = 'removed') AS BIGINT) AS removed,
  CAST(count(*) FILTER (status = 'modified') AS BIGINT) AS modified,
  CAST(count(*) FILTER (status = 'unchanged') AS BIGINT) AS unchanged,
  CAST(count(*) FILTER (status IN ('added', 'removed', 'modified')) AS BIGINT) AS drifted
FROM cats LEFT JOIN u USING (category) GROUP BY category"""

DRIFT_VERDICT = f"""SELECT CAST(count(*) FILTER (status <> 'unchanged') AS BIGINT) AS total_drifted,
  count(*) FILTER (status <> 'unchanged') > 0 AS has_drift FROM ({STATUSES})"""

DRIFT_RECOMMENDATIONS = f"""
WITH t AS (SELECT count(*) FILTER (status <> 'unchanged') AS drifted,
                  count(*) FILTER (category = 'tables' AND status = 'modified') AS changed,
                  count(*) FILTER (category = 'tables' AND status IN ('added', 'removed')) AS moved
           FROM ({STATUSES}))
SELECT 'itself' AS compared, 0 AS seq, 'aligned' AS action, CAST(0 AS BIGINT) AS objects
UNION ALL SELECT 'live', 0, 'aligned', drifted FROM t WHERE drifted = 0
UNION ALL SELECT 'live', 1, 'update_baseline', drifted FROM t WHERE drifted > 0
UNION ALL SELECT 'live', 2, 'migrate_live', drifted FROM t WHERE drifted > 0
UNION ALL SELECT 'live', 3, 'review_table_text', changed FROM t WHERE changed > 0
UNION ALL SELECT 'live', 4, 'review_table_set', moved FROM t WHERE moved > 0"""


def _ignore_sql() -> str:
    singular = ("CASE category WHEN 'tables' THEN 'table' WHEN 'views' THEN 'view' "
                "WHEN 'procedures' THEN 'procedure' ELSE category END")
    cands = ["lower(name)", "lower(category || ':' || name)", f"lower({singular} || ':' || name)",
             "lower(replace(coalesce(relative_path, ''), '\\', '/'))"]
    cond = " OR ".join(f"({c} GLOB {q(p)})" for p in IGNORED for c in cands)
    return f"""SELECT DISTINCT category, name FROM (
  SELECT category, name FROM ({BASE_OBJ}) WHERE {cond}
  UNION ALL SELECT category, name FROM ({LIVE_OBJ}) WHERE {cond})"""


def _ignore_table_sql() -> str:
    cands = ["lower(name)", "lower(category || ':' || name)", "lower(replace(coalesce(relative_path, ''), '\\', '/'))"]
    cond = " OR ".join(f"({c} GLOB g.pattern)" for c in cands)
    singular = "(category = 'views' AND 'view:' || lower(name) GLOB g.pattern)"
    return f"""
WITH o AS (SELECT DISTINCT category, name, relative_path FROM (
             SELECT category, name, relative_path FROM ({BASE_OBJ}) UNION ALL SELECT category, name, relative_path FROM ({LIVE_OBJ}))),
g AS (SELECT DISTINCT lower(CASE n_chars % 4 WHEN 0 THEN {DOC_NAME} || '?' WHEN 1 THEN lang || '/' || {DOC_NAME} || '.*'
             WHEN 2 THEN '*:' || {DOC_NAME} ELSE 'views:page' || CAST(doc_id AS VARCHAR) || '[0-4]' END) AS pattern FROM documents)
SELECT DISTINCT category, name FROM o JOIN g ON {cond} OR {singular}"""


# Closed ranges that footers may settle (no footer does for l_quantity, a double).
FOOTER_RANGES = [("part", "p_size", 1, 50), ("part", "p_size", 1, 49), ("customer", "c_nationkey", 0, 24),
                 ("conversations", "turn", 0, 7), ("conversations", "turn", 1, 7), ("lineitem", "l_linenumber", 1, 7),
                 ("lineitem", "l_quantity", 1, 50), ("events", "user_id", 0, 10), ("documents", "n_chars", 1, 10_000_000)]
CATALOG_FROM_VIEWS = """
WITH t AS (SELECT CASE WHEN o_orderpriority LIKE '5%' THEN 'sys' ELSE lower(o_orderpriority) END AS schema_name,
                  'order' || CAST(o_orderkey AS VARCHAR) AS object_name, o_orderkey, o_custkey,
                  CASE WHEN o_orderstatus = 'P' THEN 'VIEW' ELSE 'BASE TABLE' END AS table_type
           FROM orders WHERE o_orderpriority NOT LIKE '4%' AND o_orderpriority NOT LIKE '5%'),
c AS (SELECT l_orderkey AS o_orderkey, count(*) AS columns, count(*) FILTER (l_linestatus <> 'O') AS not_null,
             count(*) FILTER (l_linenumber <= 2) AS key_columns FROM lineitem GROUP BY l_orderkey),
m AS (SELECT o_orderkey, c_name AS text FROM t JOIN customer ON c_custkey = o_custkey
      WHERE table_type = 'VIEW' AND o_custkey % 2 = 0)
SELECT schema_name, object_name, table_type,
  CASE WHEN table_type = 'VIEW' THEN 0 ELSE coalesce(columns, 0) END AS columns,
  CASE WHEN table_type = 'VIEW' THEN 0 ELSE coalesce(not_null, 0) END AS not_null,
  CASE WHEN table_type = 'VIEW' THEN 0 ELSE coalesce(key_columns, 0) END AS key_columns, text,
  CASE WHEN table_type = 'VIEW' AND m.o_orderkey IS NULL THEN 'view without text'
       WHEN table_type <> 'VIEW' AND c.o_orderkey IS NULL THEN 'table without columns' END AS error
FROM t LEFT JOIN c USING (o_orderkey) LEFT JOIN m USING (o_orderkey)"""

RAW_HASH_DIFF = f"""
WITH l AS (SELECT category, name, sha256(definition) AS h FROM ({BASE_OBJ})),
r AS (SELECT category, name, sha256(definition) AS h FROM ({LIVE_OBJ}))
SELECT * FROM (
  SELECT coalesce(l.category, r.category) AS category, coalesce(l.name, r.name) AS name,
    CASE WHEN l.name IS NULL THEN 'added' WHEN r.name IS NULL THEN 'removed'
         WHEN l.h IS DISTINCT FROM r.h THEN 'modified' END AS status
  FROM l FULL OUTER JOIN r ON l.category = r.category AND l.name = r.name) WHERE status IS NOT NULL"""

_QN = "('dbo.' || source || ':doc' || CAST(doc_id AS VARCHAR))"
_OT = "CASE lang WHEN 'en' THEN 'table' WHEN 'fr' THEN 'view' ELSE 'procedure' END"
_FOLDER = "CASE lang WHEN 'en' THEN 'tables' WHEN 'fr' THEN 'views' ELSE 'procedures' END"
ARTIFACTS = f"""SELECT {_OT} AS object_type, {_QN} AS qualified_name,
  {_FOLDER} || '/' || {sanitize(_QN)} || '.sql' AS relative_path, text AS content, sha256(text) AS sha256
FROM documents"""


def _tree(src: str) -> str:
    return f"""
WITH a AS (SELECT object_type AS g, relative_path AS p, content AS c FROM ({src})),
l AS (SELECT g, substr(sha256(p), 1, 4) AS b1, substr(sha256(p), 5, 4) AS b2,
             sha256(p || chr(10) || sha256(c)) AS leaf FROM a),
c1 AS (SELECT g, b1, b2, sha256(string_agg(leaf, chr(10) ORDER BY leaf)) AS h, count(*) AS n
       FROM l GROUP BY g, b1, b2),
c2 AS (SELECT g, b1, sha256(string_agg(b2 || ':' || h, chr(10) ORDER BY b2 || ':' || h)) AS h, sum(n) AS n
       FROM c1 GROUP BY g, b1)
SELECT g AS object_type, CAST(sum(n) AS BIGINT) AS artifact_count,
  sha256(string_agg(b1 || ':' || h, chr(10) ORDER BY b1 || ':' || h)) AS bundle_sha256
FROM c2 GROUP BY g"""


ALL_ARTIFACTS = f"SELECT * REPLACE ('*' AS object_type) FROM ({ARTIFACTS})"
BUNDLE_HASH = f"SELECT * FROM ({_tree(ARTIFACTS)}) UNION ALL SELECT * FROM ({_tree(ALL_ARTIFACTS)})"


def _order_lines() -> str:
    """The six column lines and two constraint lines of an order's table."""
    default = "'(''' || o_orderstatus || ', [b] INT, CONSTRAINT [c] (it''''s'')'"
    digits = "length(CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR)) + 2"
    prio_t = ("CASE WHEN o_orderpriority LIKE '1%' THEN 'NVARCHAR' ELSE 'VARCHAR' END || "
              "CASE WHEN o_orderpriority LIKE '5%' THEN '(MAX)' ELSE '(' || CAST(length(o_orderpriority) AS VARCHAR) || ')' END")
    return {
        "o_orderkey": ("1", "'BIGINT'", "'    [o_orderkey] BIGINT NOT NULL'", "'BIGINT NOT NULL'"),
        "o_custkey": ("2", "'BIGINT'", "'    [o_custkey] BIGINT NULL'", "'BIGINT NULL'"),
        "o_orderstatus": ("3", "'NCHAR(1)'",
                          f"'    [o_orderstatus] NCHAR(1) DEFAULT ' || {default} || ' NOT NULL'",
                          f"'NCHAR(1) DEFAULT ' || {default} || ' NOT NULL'"),
        "o_totalprice": ("4", f"'DECIMAL(' || CAST({digits} AS VARCHAR) || ',2)'",
                         f"'    [o_totalprice] DECIMAL(' || CAST({digits} AS VARCHAR) || ',2) NULL'",
                         f"'DECIMAL(' || CAST({digits} AS VARCHAR) || ',2) NULL'"),
        "o_orderdate": ("5", "'DATETIME2(' || CAST(month(o_orderdate) % 8 AS VARCHAR) || ')'",
                        "'    [o_orderdate] DATETIME2(' || CAST(month(o_orderdate) % 8 AS VARCHAR) || ') NULL'",
                        "'DATETIME2(' || CAST(month(o_orderdate) % 8 AS VARCHAR) || ') NULL'"),
        "o_orderpriority": ("6", prio_t, f"'    [o_orderpriority] ' || {prio_t} || ' NULL'", f"{prio_t} || ' NULL'"),
    }


def _render_sql() -> str:
    cols = _order_lines()
    key = "CAST(o_orderkey AS VARCHAR)"
    lines = [cols[c][2] for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                  "o_orderdate", "o_orderpriority")]
    lines.append(f"'    CONSTRAINT [pk_order' || {key} || '] PRIMARY KEY ([o_orderkey])'")
    lines.append(f"'    CONSTRAINT [uq_order' || {key} || '] UNIQUE ([o_custkey], [o_orderdate])'")
    body = " || ',' || chr(10) || ".join(f"({x})" for x in lines)
    definition = (f"'CREATE TABLE [c' || CAST(o_custkey AS VARCHAR) || '].[order' || {key} || '] (' || chr(10) || "
                  f"{body} || chr(10) || ');' || chr(10)")
    return f"""SELECT 'c' || CAST(o_custkey AS VARCHAR) || '.order' || {key} AS qualified_name,
  {definition} AS definition, sha256({definition}) AS definition_sha256 FROM orders"""


def _parse_sql() -> str:
    parts = []
    for name, (ordinal, typ, _line, coldef) in _order_lines().items():
        parts.append(f"""SELECT 'c' || CAST(o_custkey AS VARCHAR) || '.order' || CAST(o_orderkey AS VARCHAR) AS qualified_name,
  '{name}' AS column_name, CAST({ordinal} AS INTEGER) AS ordinal, {typ} AS type_sql, {coldef} AS column_definition
FROM orders""")
    return "\nUNION ALL\n".join(parts)


def _definition_lines_sql() -> str:
    t = ("CASE l_returnflag WHEN 'R' THEN 'NVARCHAR' WHEN 'A' THEN 'DECIMAL' ELSE 'DATETIME2' END")
    typ = ("CASE l_returnflag "
           "WHEN 'R' THEN 'NVARCHAR' || CASE WHEN l_quantity > 45 THEN '(MAX)' "
           "ELSE '(' || CAST(CAST(trunc(l_quantity * 10) AS INTEGER) AS VARCHAR) || ')' END "
           "WHEN 'A' THEN 'DECIMAL(18,' || CAST(CAST(trunc(l_tax * 100) AS INTEGER) AS VARCHAR) || ')' "
           "ELSE 'DATETIME2(' || CAST(l_linenumber - 1 AS VARCHAR) || ')' END")
    del t
    line = (f"rtrim('    [part' || CAST(l_partkey AS VARCHAR) || '] ' || {typ} || "
            "CASE WHEN l_discount = 0 THEN ' DEFAULT ((0))' ELSE '' END || ' ' || "
            "CASE WHEN l_linestatus = 'O' THEN 'NULL' ELSE 'NOT NULL' END)")
    return f"""
SELECT 'c' || CAST(o_custkey AS VARCHAR) AS schema_name, 'order' || CAST(l_orderkey AS VARCHAR) AS table_name,
  2 AS section, CAST(l_linenumber AS BIGINT) AS position, '' AS sort_key, {line} AS line
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
UNION ALL
SELECT 'c' || CAST(o_custkey AS VARCHAR), 'order' || CAST(o_orderkey AS VARCHAR), 1, 0, '',
  'CREATE TABLE [c' || CAST(o_custkey AS VARCHAR) || '].[order' || CAST(o_orderkey AS VARCHAR) || '] (' FROM orders
UNION ALL
SELECT 'c' || CAST(o_custkey AS VARCHAR), 'order' || CAST(o_orderkey AS VARCHAR), 4, 0, '', ');' FROM orders"""


def _normalize_module_sql() -> str:
    obj = "'conv' || CAST(conv_id AS VARCHAR) || '_t' || CAST(turn AS VARCHAR)"
    raw = (f"CASE WHEN role = 'system' THEN 'ALTER VIEW ' || {obj} || ' AS' || chr(10) || text "
           f"WHEN role = 'user' AND length(text) > 200 THEN 'create view ' || {obj} || ' as ' || text "
           "WHEN role = 'user' AND length(text) < 60 THEN ' ' || chr(10) || ' ' "
           "ELSE text END")
    d = strip_ws("raw")
    qn = f"({qi('schema_name')} || '.' || {qi('object_name')})"
    return f"""
WITH m AS (SELECT role AS schema_name, {obj} AS object_name,
                  CASE WHEN role = 'assistant' THEN 'P' ELSE 'V' END AS object_type, {raw} AS raw
           FROM conversations),
n AS (SELECT *, {d} AS d FROM m)
SELECT schema_name, object_name, object_type,
  CASE WHEN d = '' THEN NULL
       WHEN regexp_matches(d, '(?i)^ALTER\\s+VIEW\\b') OR regexp_matches(d, '(?i)^ALTER\\s+PROC(EDURE)?\\b')
         THEN regexp_replace(d, '(?i)^ALTER', 'CREATE OR ALTER')
       WHEN regexp_matches(d, '(?i)^CREATE\\s') THEN d
       WHEN object_type = 'V' THEN 'CREATE VIEW ' || {qn} || ' AS' || chr(10) || d
       WHEN object_type IN ('P', 'PC') THEN 'CREATE PROCEDURE ' || {qn} || chr(10) || 'AS' || chr(10) || d
       ELSE d END AS definition,
  CASE WHEN d = '' THEN 'empty_text' END AS error
FROM n"""


RUNNER_RULE = r"^(v([0-9]+)_([A-Za-z0-9_\-]+))\.(sql|py)$"


def _script_name(number: str) -> str:
    return f"""CASE WHEN n_chars < 200 THEN 'draft_' ELSE '' END || 'v' ||
  CASE WHEN n_chars % 29 = 0 THEN '000' WHEN n_chars % 31 = 0 THEN '99999999999999999999'
       ELSE printf('%03d', CAST({number} * 3 + 6 + n_chars % 2 AS BIGINT)) END || '_' || source ||
  CASE lang WHEN 'en' THEN '.sql' WHEN 'de' THEN '_de.sql' WHEN 'fr' THEN '.py' ELSE '-ES.sql' END"""


SCRIPT_TEXT = """CASE n_chars % 17 WHEN 3 THEN ' ' || chr(10) || chr(9)
  WHEN 5 THEN 'ALTER TABLE t ADD (a INT; ' || text
  WHEN 7 THEN 'CREATE TABLE t (a INT); DROP SCHEMA old; ' || text
  WHEN 9 THEN 'CREATE TABLE t (a INT) -- def run(x)' || chr(10) || text ELSE text END"""


def _scripts(number: str) -> str:
    return (f"SELECT doc_id, {_script_name(number)} AS file_name, {SCRIPT_TEXT} AS content, n_chars, source, lang "
            "FROM documents")


def _parsed(scripts: str) -> str:
    return f"""SELECT * EXCLUDE (n), CASE WHEN n IS NOT NULL THEN regexp_extract(file_name, '{RUNNER_RULE}', 1) END AS migration_id,
  n AS version, regexp_extract(file_name, '(\\.[^.]*)$', 1) AS extension, n IS NOT NULL AS valid
FROM (SELECT *, TRY_CAST(nullif(regexp_extract(file_name, '{RUNNER_RULE}', 2), '') AS BIGINT) AS n FROM ({scripts}))"""


SCRIPTS = _scripts("(doc_id // 2)")
LINT_SCRIPTS = _scripts("((doc_id // 2) % 300)")  # the validator's rule takes three digits
PARSED = _parsed(SCRIPTS)
HISTORY = f"""SELECT coalesce(f.migration_id, f.file_name) AS migration_id, f.file_name AS migration_name,
  {APPLIED_AT_SQL} AS applied_at, f.source AS applied_by,
  CASE WHEN f.file_name LIKE '%.py' THEN 'pyspark' ELSE 'sql' END AS migration_type,
  CASE WHEN l.quality = 1 THEN 'success' ELSE 'failed' END AS status,
  f.n_chars / 1000.0 AS duration_seconds
FROM ({PARSED}) f JOIN labels l ON f.doc_id = l.doc_id"""
DISCOVERED = f"SELECT *, 'sql' AS migration_type FROM ({PARSED}) WHERE file_name LIKE '%.sql' AND valid"
PENDING = f"""SELECT * FROM ({DISCOVERED}) d WHERE d.migration_id NOT IN
  (SELECT migration_id FROM ({HISTORY}) WHERE status = 'success' AND migration_id IS NOT NULL)"""

OUTCOMES = f"""SELECT * FROM (
SELECT migration_id, version, doc_id, CASE
    WHEN bool_or(failed) OVER (ORDER BY version, migration_id, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 'pending'
    WHEN failed THEN 'failed' ELSE 'success' END AS state
FROM (SELECT *, NOT {executable('content')} AS failed FROM ({PENDING}))) s"""

HISTORY_APPEND = f"""
WITH h AS (SELECT * FROM ({HISTORY})
           UNION ALL
           SELECT migration_id, file_name, {APPLIED_AT_SQL}, {q(RUN_BY)}, migration_type, 'success', n_chars / 1000.0
           FROM ({PENDING}))
SELECT status, CAST(count(*) AS BIGINT) AS runs, CAST(count(DISTINCT migration_id) AS BIGINT) AS migrations,
  round(coalesce(sum(duration_seconds), 0.0), 3) AS total_seconds
FROM h GROUP BY status"""

SEARCH_COLS = ("migration_id", "migration_name", "applied_at", "applied_by", "migration_type", "status",
               "duration_seconds")
SEARCH_TEXT = "lower(concat_ws('||', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in SEARCH_COLS) + "))"


def _presence_sql() -> str:
    vals = ", ".join(f"({q(n)})" for n in SEARCHED_LABELS)
    return f"""
WITH h AS (SELECT *, {SEARCH_TEXT} AS t FROM ({HISTORY})),
n AS (SELECT * FROM (VALUES {vals}) v(needle))
SELECT needle,
  EXISTS (SELECT 1 FROM h WHERE contains(h.t, lower(n.needle))) AS loose_found,
  EXISTS (SELECT 1 FROM h WHERE h.status = 'success' AND starts_with(h.migration_id, n.needle)) AS strict_found
FROM n"""


# Lint keywords, entry points and messages, as the tools that lint scripts word them.
SQL_KEYWORDS = ("CREATE", "ALTER", "DROP", "INSERT", "UPDATE", "DELETE", "ADD", "COLUMN", "TABLE", "INDEX", "VIEW", "IF")
ENTRY_POINTS = ("def upgrade(", "def run(")
LINT = {
    "naming_runner": "skipped: the name does not match the runner's pattern",
    "naming": "Invalid naming convention. Expected: vNNN_description.sql or vNNN_description.py",
    "naming_ci": "does not follow the vNNN_description.sql naming convention.",
    "empty": "Empty migration file",
    "parens": "Unbalanced parentheses detected",
    "keywords": "No recognized SQL keywords found",
    "entry": "Missing required upgrade() or run() function",
    "required": "must contain CREATE TABLE or ALTER TABLE statements.",
    "forbidden": "contains a forbidden DROP DATABASE or DROP SCHEMA statement.",
}


def _validator_lint_sql() -> str:
    vrule = r"^v([0-9]{3})_\w+\.(sql|py)$"
    kw = " OR ".join(f"contains(upper(content), {q(k)})" for k in SQL_KEYWORDS)
    entry = " OR ".join(f"contains(content, {q(k)})" for k in ENTRY_POINTS)
    empty = f"(regexp_replace(coalesce(content, ''), '{WS}+', '', 'g') = '')"
    parens = "(length(content) - length(replace(content, '(', '')) <> length(content) - length(replace(content, ')', '')))"
    sp = "[ \\t\\x{0B}\\f\\r]+"
    req = f"(?i)(CREATE{sp}TABLE|ALTER{sp}TABLE)"
    forb = f"(?i)(DROP{sp}DATABASE|DROP{sp}SCHEMA)"
    return f"""
WITH f AS (SELECT file_name, content FROM ({LINT_SCRIPTS})),
named AS (SELECT file_name, CAST(regexp_extract(file_name, '{vrule}', 1) AS INTEGER) AS v,
                 regexp_extract(file_name, '{vrule}', 2) AS ext
          FROM f WHERE regexp_matches(file_name, '{vrule}')),
firsts AS (SELECT v, ext, min(file_name) AS first, count(*) AS n FROM named GROUP BY v, ext)
SELECT file_name, 'naming' AS rule, 'ERROR' AS severity, {q(LINT['naming'])} AS message FROM f
  WHERE NOT (file_name LIKE '.%' OR file_name = '__pycache__') AND NOT regexp_matches(file_name, '{vrule}')
UNION ALL
SELECT named.file_name, 'duplicate_version', 'ERROR',
  'Duplicate version number ' || printf('v%03d', named.v) || ' (also in ' || firsts.first || ')'
  FROM named JOIN firsts ON named.v = firsts.v AND named.ext = firsts.ext
  WHERE firsts.n > 1 AND named.file_name <> firsts.first
UNION ALL
SELECT file_name, 'empty', 'ERROR', {q(LINT['empty'])} FROM f
  WHERE (file_name LIKE '%.sql' OR file_name LIKE '%.py') AND {empty}
UNION ALL
SELECT file_name, 'parentheses', 'ERROR', {q(LINT['parens'])} FROM f
  WHERE file_name LIKE '%.sql' AND NOT {empty} AND {parens}
UNION ALL
SELECT file_name, 'keywords', 'WARNING', {q(LINT['keywords'])} FROM f
  WHERE file_name LIKE '%.sql' AND NOT {empty} AND NOT ({kw})
UNION ALL
SELECT file_name, 'entry_point', 'WARNING', {q(LINT['entry'])} FROM f
  WHERE file_name LIKE '%.py' AND NOT {empty} AND NOT ({entry})
UNION ALL
SELECT file_name, 'naming_runner', 'WARNING', {q(LINT['naming_runner'])} FROM ({_parsed(LINT_SCRIPTS)})
  WHERE (file_name LIKE '%.sql' OR file_name LIKE '%.py') AND NOT valid
UNION ALL
SELECT file_name, 'naming_ci', 'ERROR', file_name || ' ' || {q(LINT['naming_ci'])} FROM f
  WHERE file_name LIKE '%.sql' AND NOT regexp_matches(file_name, '^v[0-9]{{3}}_[a-z0-9_]+\\.sql$')
UNION ALL
SELECT file_name, 'create_or_alter', 'ERROR', file_name || ' ' || {q(LINT['required'])} FROM f
  WHERE file_name LIKE '%.sql' AND NOT regexp_matches(coalesce(content, ''), '{req}')
UNION ALL
SELECT file_name, 'forbidden_drop', 'ERROR', file_name || ' ' || {q(LINT['forbidden'])} FROM f
  WHERE file_name LIKE '%.sql' AND regexp_matches(coalesce(content, ''), '{forb}')"""


# --------------------------------------------------------------------------
# Contract checks
# --------------------------------------------------------------------------

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
TYPE_MAP = """CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
  WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>'
  WHEN 'BOOLEAN' THEN 'boolean' WHEN 'DATE' THEN 'date' WHEN 'FLOAT' THEN 'float' WHEN 'SMALLINT' THEN 'smallint'
  ELSE lower(column_type) END"""
ACTUAL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, lower(column_name) AS column_name, {TYPE_MAP} AS actual_type FROM (DESCRIBE {t})"
    for t in TABLE_NAMES)
AVAILABLE = "SELECT * FROM (VALUES " + ", ".join(f"('{t}')" for t in TABLE_NAMES) + ") v(table_name)"


# The contract as (table, since version, columns with their types).
CONTRACT = [
    ("region", 1, "r_regionkey int, r_name string"),
    ("nation", 1, "n_nationkey int, n_name string, n_regionkey int"),
    ("customer", 1, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    ("customer", 2, "c_phone string"),
    ("supplier", 1, "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
    ("part", 1, "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
    ("orders", 1, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
     "o_totalprice double, o_orderdate date, o_orderpriority string"),
    ("lineitem", 1, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
     "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    ("lineitem", 2, "l_commitdate timestamp_ntz"),
    ("events", 2, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"),
    ("documents", 2, "doc_id bigint, text string, lang string, source string, n_chars int"),
    ("labels", 2, "doc_id bigint, quality int, toxic boolean"),
    ("pages", 2, "page_id bigint, url string, html string"),
    ("conversations", 2, "conv_id bigint, turn bigint, role string, text string"),
    ("benchmark", 2, "item_id bigint, text string"),
    ("embeddings", 2, "vec_id bigint, embedding array<float>, label int"),
    ("shipments", 3, "ship_id bigint, l_orderkey bigint"),
    ("returns", 3, "return_id bigint"),
    ("orders", 3, "o_clerk string"),
]


def _contract_values() -> str:
    rows = ", ".join(f"({q(t)}, {q(c)}, {q(ty)}, {v})" for t, v, columns in CONTRACT
                     for c, ty in (x.split(" ") for x in columns.split(", ")))
    return ("SELECT table_name, column_name, expected_type, CAST(since AS BIGINT) AS since_version "
            f"FROM (VALUES {rows}) v(table_name, column_name, expected_type, since)")


def _vnum(version: str) -> int:
    return int(version[1:])


def presence_sql(version: str) -> str:
    return f"""SELECT 'tables' AS category, c.table_name, 'exists' AS check_name, c.table_name AS subject,
  CAST(a.table_name IS NOT NULL AS BIGINT) AS observed, a.table_name IS NOT NULL AS passed,
  CASE WHEN a.table_name IS NOT NULL THEN 'info' ELSE 'error' END AS severity,
  'Table `' || c.table_name || '` exists' AS message
FROM (SELECT DISTINCT table_name FROM ({_contract_values()}) WHERE since_version <= {_vnum(version)}) c
LEFT JOIN ({AVAILABLE}) a ON c.table_name = a.table_name"""


def columns_sql(version: str) -> str:
    return f"""SELECT 'columns' AS category, c.table_name, 'column_type' AS check_name, c.column_name AS subject,
  CAST(coalesce(a.actual_type = c.expected_type, false) AS BIGINT) AS observed,
  coalesce(a.actual_type = c.expected_type, false) AS passed,
  CASE WHEN coalesce(a.actual_type = c.expected_type, false) THEN 'info' ELSE 'error' END AS severity,
  '`' || c.table_name || '.' || c.column_name || '` -> expected ' || c.expected_type || ', found ' ||
    coalesce(a.actual_type, 'missing') AS message
FROM (SELECT * FROM ({_contract_values()}) WHERE since_version <= {_vnum(version)}
      AND table_name IN (SELECT table_name FROM ({AVAILABLE}))) c
LEFT JOIN ({ACTUAL}) a ON c.table_name = a.table_name AND c.column_name = a.column_name"""


def block_sql(version: str) -> str:
    v = _vnum(version)
    if v < 2:
        return ("SELECT * FROM (SELECT 'version' AS category, '' AS table_name, '' AS check_name, '' AS subject, "
                "CAST(0 AS BIGINT) AS observed, true AS passed, '' AS severity, '' AS message) WHERE false")
    return f"""
WITH c AS ({_contract_values()}),
first AS (SELECT table_name, min(since_version) AS f FROM c GROUP BY table_name),
items AS (SELECT c.*, first.f FROM c JOIN first USING (table_name) WHERE c.since_version = {v})
SELECT 'version' AS category, t.table_name, 'introduced_table' AS check_name, t.table_name AS subject,
  CAST(a.table_name IS NOT NULL AS BIGINT) AS observed, a.table_name IS NOT NULL AS passed,
  CASE WHEN a.table_name IS NOT NULL THEN 'info' ELSE 'error' END AS severity,
  'Table `' || t.table_name || '` exists for {version}' AS message
FROM (SELECT DISTINCT table_name FROM items WHERE f = since_version) t
LEFT JOIN ({AVAILABLE}) a ON t.table_name = a.table_name
UNION ALL
SELECT 'version', i.table_name, 'introduced_column', i.column_name,
  CAST(coalesce(a.actual_type = i.expected_type, false) AS BIGINT),
  coalesce(a.actual_type = i.expected_type, false),
  CASE WHEN coalesce(a.actual_type = i.expected_type, false) THEN 'info' ELSE 'error' END,
  i.table_name || ' includes `' || i.column_name || '` (' || upper(i.expected_type) || ')'
FROM (SELECT * FROM items WHERE f < since_version) i
LEFT JOIN ({ACTUAL}) a ON i.table_name = a.table_name AND i.column_name = a.column_name"""


def history_sql(labels: list[str], strict: bool) -> str:
    vals = ", ".join(f"({q(n)})" for n in labels)
    hit = ("h.status = 'success' AND starts_with(h.migration_id, n.needle)" if strict
           else "contains(h.t, lower(n.needle))")
    return f"""
WITH h AS (SELECT *, {SEARCH_TEXT} AS t FROM ({HISTORY})),
n AS (SELECT * FROM (VALUES {vals}) v(needle)),
f AS (SELECT needle, EXISTS (SELECT 1 FROM h WHERE {hit}) AS found FROM n)
SELECT 'migration' AS category, '_migration_history' AS table_name, 'exists' AS check_name,
  '_migration_history' AS subject, CAST(1 AS BIGINT) AS observed, true AS passed, 'info' AS severity,
  'Table `_migration_history` exists' AS message
UNION ALL
SELECT 'migration', '_migration_history', 'version_recorded', needle, CAST(found AS BIGINT), found,
  CASE WHEN found THEN 'info' ELSE 'error' END, 'Migration history contains `' || needle || '`'
FROM f"""


# Fixed values: (table, whether its rows are counted, key columns, ranges as (column, low, high)).
RULES = [
    ("region", True, ("r_regionkey",), []),
    ("nation", True, ("n_nationkey", "n_regionkey"), []),
    ("customer", True, ("c_custkey", "c_nationkey"), [("c_acctbal", "0", "10000")]),
    ("supplier", True, ("s_suppkey", "s_nationkey"), [("s_acctbal", "0", "10000")]),
    ("part", True, ("p_partkey",), [("p_size", "1", "50"), ("p_retailprice", "900", "2000")]),
    ("orders", True, ("o_orderkey", "o_custkey"), [("o_totalprice", "0", "500000")]),
    ("lineitem", True, ("l_orderkey", "l_partkey", "l_suppkey"),
     [("l_discount", "0", "0.05"), ("l_quantity", "5", "45"), ("l_tax", "0", "0.08")]),
    ("events", True, ("event_id", "user_id"), [("value", "0", "300")]),
    ("documents", True, ("doc_id",), [("n_chars", "1", "20000")]),
    ("labels", True, ("doc_id",), [("quality", "0", "1"), ("toxic", "0", "1")]),
    ("conversations", True, ("conv_id", "turn"), [("turn", "0", "7")]),
    ("pages", True, ("page_id",), []),
    ("benchmark", True, ("item_id",), []),
    ("embeddings", True, ("vec_id",), [("label", "0", "9")]),
    ("doc_labels", False, ("doc_id", "quality", "toxic"), []),
]


def fused_sql() -> str:
    joined = "(SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
    parts = []
    for t, counted, keys, ranges in RULES:
        src = joined if t == "doc_labels" else t
        if counted:
            parts.append(f"""SELECT 'rows' AS category, '{t}' AS table_name, 'row_count' AS check_name, '{t}' AS subject,
  CAST(count(*) AS BIGINT) AS observed, true AS passed,
  CASE WHEN count(*) = 0 THEN 'warning' ELSE 'info' END AS severity,
  '`{t}` row count: ' || CAST(count(*) AS VARCHAR) AS message FROM {src}""")
        checks = [(k, "null_key", f"{k} IS NULL", "null check", "null rows") for k in keys]
        checks += [(c, f"range [{lo}, {hi}]", f"({c} < {lo}::DOUBLE OR {c} > {hi}::DOUBLE)", f"range [{lo}, {hi}]",
                    "invalid rows") for c, lo, hi in ranges]
        for c, name, bad, told, rows in checks:
            n = f"count(*) FILTER ({bad})"
            parts.append(f"""SELECT 'data', '{t}', '{name}', '{c}', CAST({n} AS BIGINT), {n} = 0,
  CASE WHEN {n} = 0 THEN 'info' ELSE 'error' END,
  '`{t}.{c}` {told} -> ' || CAST({n} AS VARCHAR) || ' {rows}' FROM {src}""")
    return "\nUNION ALL\n".join(parts)


def with_rows(sql: str) -> str:
    """Contract checks with the row count of their table."""
    counts = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLE_NAMES)
    return f"SELECT c.*, n.row_count FROM ({sql}) c LEFT JOIN ({counts}) n USING (table_name)"


def all_checks_sql() -> str:
    return "\nUNION ALL\n".join([
        f"SELECT * FROM ({presence_sql('v002')})",
        f"SELECT * FROM ({columns_sql('v002')})",
        f"SELECT * FROM ({block_sql('v002')})",
        f"SELECT * FROM ({fused_sql()})",
        f"SELECT * FROM ({history_sql(["v001", "v002"], False)})",
    ])


def _summary_sql() -> str:
    return f"""SELECT category, CAST(count(*) FILTER (passed) AS BIGINT) AS passed, CAST(count(*) AS BIGINT) AS total,
  CAST(count(*) FILTER (severity = 'warning') AS BIGINT) AS warnings,
  coalesce(array_to_string(list_sort(list(message) FILTER (NOT passed)), '; '), '') AS failures
FROM ({all_checks_sql()}) GROUP BY category"""


def _verdict_sql() -> str:
    return f"""SELECT CASE WHEN coalesce(bool_and(passed), true) THEN 'PASS' ELSE 'FAIL' END AS result,
  coalesce(bool_and(passed), true) AS passed, CAST(count(*) AS BIGINT) AS checks,
  CAST(count(*) FILTER (NOT passed) AS BIGINT) AS failed,
  CAST(count(*) FILTER (severity = 'warning') AS BIGINT) AS warnings,
  coalesce(array_to_string(list_sort(list(message) FILTER (NOT passed)), '; '), '') AS failures
FROM ({all_checks_sql()})"""


def _fk_sql() -> str:
    rels = [("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"),
            ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("lineitem", "l_partkey", "supplier", "s_suppkey"),
            ("orders", "o_custkey", "customer", "c_custkey"), ("orders", "o_orderkey", "lineitem", "l_orderkey"),
            ("labels", "doc_id", "documents", "doc_id"), ("documents", "doc_id", "labels", "doc_id"),
            ("customer", "c_nationkey", "nation", "n_nationkey")]
    parts = []
    for c, cc, p, pc in rels:
        parts.append(f"""SELECT '{c}' AS child_table, '{cc}' AS child_column, '{p}' AS parent_table, '{pc}' AS parent_column,
  CAST(count(*) AS BIGINT) AS orphan_rows, CAST(count(DISTINCT {cc}) AS BIGINT) AS orphan_keys
FROM {c} WHERE {cc} IS NOT NULL AND {cc} NOT IN (SELECT {pc} FROM {p} WHERE {pc} IS NOT NULL)""")
    return "\nUNION ALL\n".join(parts)


def _accepted_sql() -> str:
    rules = [("orders", "o_orderstatus", ("F", "O")), ("events", "event_type", ("click", "purchase", "view", "signup")),
             ("conversations", "role", ("system", "user", "assistant")), ("documents", "lang", ("en", "fr", "de"))]
    parts = []
    for t, c, acc in rules:
        lst = ", ".join(q(a) for a in acc)
        parts.append(f"""SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value,
  CAST(count(*) AS BIGINT) AS rows FROM {t} WHERE {c} IS NOT NULL AND CAST({c} AS VARCHAR) NOT IN ({lst})
GROUP BY CAST({c} AS VARCHAR)""")
    return "\nUNION ALL\n".join(parts)


KEYED_COLUMNS = """
SELECT 'sales' AS schema_name, 'order' || CAST(o_orderkey AS VARCHAR) AS table_name,
  'k' || CAST(o_orderkey AS VARCHAR) AS constraint_name,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'PRIMARY KEY' ELSE 'UNIQUE' END AS constraint_type,
  'part' || CAST(l_partkey AS VARCHAR) AS column_name, l_linenumber AS ordinal_position
FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderpriority = '1-URGENT' OR o_orderstatus <> 'P'"""


def oracle_sql() -> dict[str, str]:
    fused = fused_sql()
    hist4 = ["v001", "v002", "v003", "v004"]
    sql = {
        "row_counts": f"SELECT table_name, observed AS row_count, severity FROM ({fused}) WHERE check_name = 'row_count'",
        "null_counts": f"SELECT table_name, subject AS column_name, observed AS null_rows, passed FROM ({fused}) WHERE check_name = 'null_key'",
        "range_violations": f"SELECT table_name, subject AS column_name, check_name AS rule, observed AS invalid_rows, passed, message FROM ({fused}) WHERE check_name LIKE 'range%'",
        "range_violation_rows": """
SELECT 'customer' AS table_name, CAST(c_custkey AS VARCHAR) AS row_id, 'c_acctbal' AS column_name,
  CAST(c_acctbal AS DOUBLE) AS value, CAST(0.0 AS DOUBLE) AS low, CAST(10000.0 AS DOUBLE) AS high,
  CASE WHEN c_acctbal < 0.0 THEN 'below' ELSE 'above' END AS reason
FROM customer WHERE c_acctbal IS NOT NULL AND (c_acctbal < 0.0 OR c_acctbal > 10000.0)
UNION ALL
SELECT 'lineitem', CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR), 'l_discount',
  CAST(l_discount AS DOUBLE), CAST(0.0 AS DOUBLE), CAST(0.05 AS DOUBLE),
  CASE WHEN l_discount < 0.0 THEN 'below' ELSE 'above' END
FROM lineitem WHERE l_discount IS NOT NULL AND (l_discount < 0.0 OR l_discount > 0.05)
UNION ALL
SELECT 'lineitem', CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR), 'l_quantity',
  CAST(l_quantity AS DOUBLE), CAST(5.0 AS DOUBLE), CAST(45.0 AS DOUBLE),
  CASE WHEN l_quantity < 5.0 THEN 'below' ELSE 'above' END
FROM lineitem WHERE l_quantity IS NOT NULL AND (l_quantity < 5.0 OR l_quantity > 45.0)""",
        "table_presence": f"SELECT table_name, passed, message, row_count FROM ({with_rows(presence_sql('v003'))})",
        "schema_conformance": f"SELECT table_name, subject AS column_name, passed, message, row_count FROM ({with_rows(columns_sql('v002'))})",
        "version_gate": f"""
WITH v AS (SELECT DISTINCT TRY_CAST(regexp_extract(migration_name, '{RUNNER_RULE}', 2) AS BIGINT) AS version
           FROM ({HISTORY}) WHERE status = 'success' AND regexp_matches(migration_name, '{RUNNER_RULE}')),
c AS ({_contract_values()})
SELECT v.version, CAST(count(DISTINCT c.table_name) AS BIGINT) AS required_tables,
  CAST(count(c.table_name) AS BIGINT) AS required_columns
FROM v LEFT JOIN c ON c.since_version <= v.version WHERE v.version IS NOT NULL GROUP BY v.version""",
        "version_block": "\nUNION ALL\n".join(
            f"SELECT '{v}' AS expected_version, table_name, check_name, subject, passed, message, row_count "
            f"FROM ({with_rows(block_sql(v))})" for v in ("v002", "v003")),
        "history_checks": (f"SELECT 'loose' AS mode, check_name, subject, passed, message FROM ({history_sql(hist4, False)}) "
                           f"UNION ALL SELECT 'strict', check_name, subject, passed, message FROM ({history_sql(hist4, True)})"),
        "check_results": all_checks_sql(),
        "check_summary": _summary_sql(),
        "verdict": _verdict_sql(),
        "definition_normalize": f"""
SELECT kind, object_id, sha256({norm('body')}) AS normalized_sha256, CAST(length({norm('body')}) AS BIGINT) AS normalized_length,
  {executable('body')} AS executable
FROM (SELECT 'document' AS kind, doc_id AS object_id, text AS body FROM documents
      UNION ALL SELECT 'page', page_id, html FROM pages)""",
        "object_drift": OBJECT_DRIFT,
        "column_drift": COLUMN_DRIFT,
        "column_differences": COLUMN_DIFFERENCES,
        "table_drift": TABLE_DRIFT,
        "drift_summary": DRIFT_SUMMARY,
        "drift_verdict": DRIFT_VERDICT,
        "drift_recommendations": DRIFT_RECOMMENDATIONS,
        "ignored_objects": _ignore_sql(),
        "raw_hash_diff": RAW_HASH_DIFF,
        "tree_drift": RAW_HASH_DIFF,
        "snapshot_roundtrip": f"SELECT object_type || 's' AS category, qualified_name AS name, relative_path, sha256 FROM ({ARTIFACTS})",
        "history_outcomes": f"""WITH o AS ({OUTCOMES})
SELECT migration_id, version, doc_id, state FROM o""",
        "history_reruns": f"""WITH o AS ({OUTCOMES} WHERE state <> 'pending')
SELECT 'run1' AS run_id, state AS status, count(*) AS runs, 0::BIGINT AS by_session_user FROM o GROUP BY state
UNION ALL SELECT 'run2', 'success', count(*), count(*) FROM o HAVING count(*) > 0""",
        "footer_counts": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLE_NAMES),
        "settled_ranges": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, '{c}' AS column_name, {lo}::BIGINT AS low, {hi}::BIGINT AS high, "
            + ("NULL::BIGINT AS least, NULL::BIGINT AS most, false AS settled" if c == "l_quantity" else
               f"min({c})::BIGINT AS least, max({c})::BIGINT AS most, coalesce(min({c}) >= {lo} AND max({c}) <= {hi}, true) AS settled "
               f"FROM {t}")
            for t, c, lo, hi in FOOTER_RANGES),
        "artifact_manifest": f"SELECT relative_path, object_type, qualified_name, sha256 FROM ({ARTIFACTS})",
        "manifest_counts": f"SELECT object_type, CAST(count(*) AS BIGINT) AS object_count FROM ({ARTIFACTS}) GROUP BY object_type",
        "migration_run_order": f"""SELECT migration_id, version, doc_id,
  row_number() OVER (ORDER BY version, migration_id, doc_id) AS run_rank FROM ({PENDING})""",
        "drift_report_order": f"""SELECT category, name, status,
  row_number() OVER (ORDER BY category, status_rank, lower(name), name) AS report_rank FROM ({OBJECT_DRIFT})""",
        "names_per_type": f"""SELECT object_type, qualified_name,
  row_number() OVER (PARTITION BY object_type ORDER BY qualified_name) AS position,
  CAST(count(*) OVER (PARTITION BY object_type) AS BIGINT) AS object_count FROM ({ARTIFACTS})""",
        "bundle_hash": BUNDLE_HASH,
        "render_definition": _render_sql(),
        "definition_lines": _definition_lines_sql(),
        "parse_definition_columns": _parse_sql(),
        "unparsed_definitions": """
SELECT 'c' || CAST(o_custkey AS VARCHAR) || '.order' || CAST(o_orderkey AS VARCHAR) AS qualified_name,
  CASE o_orderkey % 10 WHEN 7 THEN 'no CREATE TABLE' ELSE 'no list of columns after the table name' END AS error
FROM orders WHERE o_orderkey % 10 IN (3, 7)""",
        "normalize_module": _normalize_module_sql(),
        "catalog_drift": f"""
SELECT 'tables' AS category, 'c' || CAST(o_custkey AS VARCHAR) || '.order' || CAST(o_orderkey AS VARCHAR) AS name,
  CASE WHEN o_orderstatus = 'P' THEN 'removed' WHEN o_orderstatus = 'F' THEN 'modified'
       WHEN o_orderpriority LIKE '2%' THEN 'modified' ELSE 'unchanged' END AS status,
  CASE WHEN o_orderstatus = 'P' THEN {q(DETAIL_REMOVED)} WHEN o_orderstatus = 'F' THEN {q(DETAIL_CHANGED)}
       WHEN o_orderpriority LIKE '2%' THEN {q(DETAIL_NO_COLUMN)}
       ELSE {q(DETAIL_SAME)} END AS details
FROM orders""",
        "keyed_columns": KEYED_COLUMNS,
        "ordered_keys": f"""SELECT table_name, constraint_name, constraint_type,
  string_agg(column_name, ', ' ORDER BY ordinal_position, column_name) AS columns
FROM ({KEYED_COLUMNS}) GROUP BY ALL""",
        "module_join": """
SELECT r_name AS schema_name, n_name AS object_name,
  CASE n_nationkey % 3 WHEN 0 THEN 'V' ELSE 'P' END AS object_type, c_name AS definition
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE n_nationkey % 3 < 2 AND r_name <> 'MIDDLE EAST'""",
        "attach_children": """
SELECT l_orderkey AS o_orderkey, CAST(count(*) AS BIGINT) AS n_columns FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY l_orderkey""",
        "assembly_errors": """
SELECT source AS schema_name, CAST(doc_id AS VARCHAR) AS object_name, 'view without text' AS error FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic IS DISTINCT FROM 1)
UNION ALL
SELECT 'sales', CAST(o_orderkey AS VARCHAR), 'table without columns' FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL)""",
        "orphans": """
SELECT 'document_without_label' AS kind, doc_id AS object_id FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)
UNION ALL
SELECT 'order_without_lines', o_orderkey FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL)""",
        "resolve_paths": f"""
WITH o AS ({BASE_OBJ}),
m AS (SELECT {DOC_NAME} AS name, 'manifest/' || lang || '/' || CAST(doc_id AS VARCHAR) || '.sql' AS mpath,
             lang AS category
      FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
clean AS (SELECT {DOC_NAME} AS name FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1))
SELECT o.category, o.name, coalesce(m.mpath, o.category || '/' || {sanitize('o.name')} || '.sql') AS resolved_path,
  m.mpath IS NOT NULL AS from_manifest, o.name IN (SELECT name FROM clean) AS found
FROM o LEFT JOIN m ON o.name = m.name AND o.category = m.category""",
        "migration_files": f"SELECT file_name, migration_id, version, extension, valid FROM ({PARSED})",
        "migration_pending": f"SELECT file_name, migration_id, version FROM ({PENDING})",
        "migration_skipped": f"SELECT file_name FROM ({PARSED}) WHERE file_name LIKE '%.sql' AND NOT valid",
        "history_append": HISTORY_APPEND,
        "evolve_add_missing": "SELECT *, CAST(NULL AS VARCHAR) AS c_phone, CAST(NULL AS DOUBLE) AS c_credit_limit FROM customer",
        "seed_missing": "SELECT doc_id, 1 AS quality, 0 AS toxic FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)",
        "text_search": f"SELECT {', '.join(SEARCH_COLS)} FROM ({HISTORY}) WHERE contains({SEARCH_TEXT}, 'v01')",
        "version_presence": _presence_sql(),
        "label_presence": f"""
WITH h AS (SELECT *, {SEARCH_TEXT} AS t FROM ({HISTORY})),
l AS (SELECT DISTINCT unnest([printf('v%03d', doc_id), printf('v%03d', doc_id) || '_' || upper(source) || '-es']) AS needle
      FROM documents),
loose AS (SELECT DISTINCT needle FROM l JOIN h ON contains(h.t, lower(l.needle))),
strict AS (SELECT DISTINCT needle FROM l JOIN h ON h.status = 'success' AND starts_with(h.migration_id, l.needle))
SELECT needle, needle IN (SELECT needle FROM loose) AS loose_found, needle IN (SELECT needle FROM strict) AS strict_found
FROM l""",
        "ignored_by_table": _ignore_table_sql(),
        "catalog_from_views": CATALOG_FROM_VIEWS,
        "table_lifecycle": """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, NULL::VARCHAR AS c_phone, NULL::DOUBLE AS c_credit_limit FROM customer
UNION ALL
SELECT s_suppkey, s_name, NULL, s_acctbal, NULL, '+' || CAST(s_nationkey AS VARCHAR), NULL FROM supplier""",
        "expected_kind_counts": """
SELECT k.kind, CAST(coalesce(c.n, 0) AS BIGINT) AS found
FROM (VALUES ('click'), ('purchase'), ('view'), ('signup'), ('refund')) k(kind)
LEFT JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY event_type) c ON k.kind = c.event_type""",
        "lint_findings": _validator_lint_sql(),
        "lint_summary": f"""SELECT CAST(count(*) FILTER (severity = 'ERROR') AS BIGINT) AS errors,
  CAST(count(*) FILTER (severity = 'WARNING') AS BIGINT) AS warnings,
  count(*) FILTER (severity = 'ERROR') = 0 AS passed FROM ({_validator_lint_sql()})""",
        "dup_keys": """SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS copies FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
        "fk_orphans": _fk_sql(),
        "accepted_values": _accepted_sql(),
        "cross_column": """
WITH l AS (SELECT l_orderkey, sum(l_extendedprice::DECIMAL(28,6)) AS s FROM lineitem GROUP BY l_orderkey)
SELECT 'order_total_vs_lines' AS rule, CAST(count(s) AS BIGINT) AS checked_rows,
  CAST(count(*) FILTER (s IS NULL) AS BIGINT) AS without_children,
  CAST(count(*) FILTER (abs(o_totalprice::DECIMAL(28,6) - s) > 100000) AS BIGINT) AS violations
FROM orders LEFT JOIN l ON o_orderkey = l_orderkey""",
        "column_agreement": """
SELECT 'documents' AS table_name, CAST(count(*) AS BIGINT) AS checked_rows, 'n_chars_is_text_length' AS rule,
  CAST(count(*) FILTER (length(text) <> n_chars) AS BIGINT) AS violations FROM documents
UNION ALL
SELECT 'documents', CAST(count(*) AS BIGINT), 'n_chars_is_text_bytes',
  CAST(count(*) FILTER (strlen(text) <> n_chars) AS BIGINT) FROM documents
UNION ALL
SELECT 'lineitem', CAST(count(*) AS BIGINT), 'tax_capped',
  CAST(count(*) FILTER (l_tax > 0.05::DOUBLE) AS BIGINT) FROM lineitem
UNION ALL
SELECT 'lineitem', CAST(count(*) AS BIGINT), 'price_per_unit_under_2000',
  CAST(count(*) FILTER (l_extendedprice / l_quantity > 2000.0::DOUBLE) AS BIGINT) FROM lineitem""",
        "version_gaps": f"""
WITH v AS (SELECT DISTINCT TRY_CAST(regexp_extract(migration_name, '{RUNNER_RULE}', 2) AS BIGINT) AS v
           FROM ({HISTORY}) WHERE status = 'success' AND regexp_matches(migration_name, '{RUNNER_RULE}'))
SELECT * FROM (SELECT lag(v, 1, 0) OVER (ORDER BY v) + 1 AS gap_from, v - 1 AS gap_to FROM v WHERE v >= 1)
WHERE gap_from <= gap_to""",
    }
    return sql
