"""DuckDB SQL equivalents of the registry queries (the correctness oracle).

Each SQL string runs on the test tables registered as views.  It computes
the expected answer independently of Spark, from the base tables.
"""

from __future__ import annotations

# DuckDB strptime/strftime forms of the candidate timestamp masks, in the
# reference's order (None = automatic parse).
_DUCK_MASKS = [
    ("DD-MON-YY", "%d-%b-%y"),
    ("Mon DD, YYYY HH:MI:SS AM", "%b %d, %Y %I:%M:%S %p"),
    ("DD-MON-YY HH12.MI.SS.FF9 AM", "%d-%b-%y %I.%M.%S.%n %p"),
    ("YYYY-", "%Y-"),
    ("MM/DD/YYYY HH12:MI AM", "%m/%d/%Y %I:%M %p"),
    ("AUTO", None),
]

ORACLE: dict[str, str] = {}


def _profile_sql(text_cte: str, columns: list[str]) -> str:
    """Profile (ordinal, column_name, non_null, data_type, scale, date_mask)."""
    aggs, selects = [], []
    for i, c in enumerate(columns):
        aggs.append(f"count({c}) AS nn{i}")
        aggs.append(f"count(*) FILTER (WHERE {c} IS NOT NULL AND "
                    f"try_cast(replace({c}, ',', '') AS DECIMAL(38,0)) IS NULL) AS num{i}")
        aggs.append(f"coalesce(max(CASE WHEN instr({c}, '.') = 0 THEN 0 "
                    f"ELSE length({c}) - instr({c}, '.') END), 0) AS sc{i}")
        for j, (_, fmt) in enumerate(_DUCK_MASKS):
            parsed = (f"try_cast({c} AS TIMESTAMP)" if fmt is None
                      else f"try_strptime({c}, '{fmt}')")
            aggs.append(f"count(*) FILTER (WHERE {c} IS NOT NULL AND {parsed} IS NULL) "
                        f"AS ts{i}_{j}")
        mask = "CASE " + " ".join(f"WHEN ts{i}_{j} = 0 THEN '{m}'"
                                  for j, (m, _) in enumerate(_DUCK_MASKS)) + \
            " ELSE 'NOT_A_DATE' END"
        selects.append(
            f"SELECT CAST({i + 1} AS INTEGER) AS ordinal, '{c}' AS column_name, "
            f"CAST(nn{i} AS BIGINT) AS non_null, "
            f"CASE WHEN nn{i} = 0 THEN NULL WHEN num{i} = 0 THEN 'NUMBER' "
            f"WHEN ({mask}) <> 'NOT_A_DATE' THEN 'DATETIME' ELSE 'VARCHAR' END AS data_type, "
            f"CAST(CASE WHEN nn{i} = 0 THEN NULL WHEN num{i} = 0 THEN sc{i} END AS INTEGER) "
            f"AS scale, "
            f"CASE WHEN nn{i} = 0 OR num{i} = 0 THEN NULL ELSE {mask} END AS date_mask "
            f"FROM p")
    return (f"WITH t AS ({text_cte}), p AS (SELECT {', '.join(aggs)} FROM t) "
            + " UNION ALL ".join(selects))


_ORDERS_TEXT = (
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, "
    "o_orderstatus, format('{:,.2f}', CAST(o_totalprice AS DECIMAL(18,2))) AS o_totalprice, "
    "upper(strftime(o_orderdate, '%d-%b-%y')) AS o_orderdate, o_orderpriority, "
    "CAST(NULL AS VARCHAR) AS o_comment FROM orders")
_ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                "o_orderpriority", "o_comment"]

ORACLE["profile_orders"] = _profile_sql(_ORDERS_TEXT, _ORDERS_COLS)

ORACLE["typed_orders"] = """
SELECT CAST(o_orderkey AS DECIMAL(38,0)) AS o_orderkey,
       CAST(o_custkey AS DECIMAL(38,0)) AS o_custkey,
       o_orderstatus,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,2)) AS o_totalprice,
       CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS o_orderdate,
       o_orderpriority
FROM orders"""

_EVENTS_TEXT = (
    "SELECT CAST(event_id AS VARCHAR) AS event_id, "
    "strftime(ts, '%d-%b-%y') AS ts_dd_mon_yy, "
    "strftime(ts, '%b %d, %Y %I:%M:%S %p') AS ts_mon_dd_yyyy, "
    "strftime(ts, '%d-%b-%y %I.%M.%S.%f000 %p') AS ts_dd_mon_yy_ff9, "
    "strftime(ts, '%Y-') AS ts_yyyy, "
    "strftime(ts, '%m/%d/%Y %I:%M %p') AS ts_mm_dd_yyyy, "
    "strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_iso, event_type FROM events")
_EVENTS_COLS = ["event_id", "ts_dd_mon_yy", "ts_mon_dd_yyyy", "ts_dd_mon_yy_ff9", "ts_yyyy",
                "ts_mm_dd_yyyy", "ts_iso", "event_type"]
ORACLE["profile_formats"] = _profile_sql(_EVENTS_TEXT, _EVENTS_COLS)

# Two-digit years: 80-99 -> 19xx, 00-79 -> 20xx (the events are all in 2024).
ORACLE["typed_formats"] = """
SELECT CAST(event_id AS DECIMAL(38,0)) AS event_id,
       date_trunc('day', ts) AS ts_dd_mon_yy,
       date_trunc('second', ts) AS ts_mon_dd_yyyy,
       ts AS ts_dd_mon_yy_ff9,
       date_trunc('year', ts) AS ts_yyyy,
       date_trunc('minute', ts) AS ts_mm_dd_yyyy,
       date_trunc('second', ts) AS ts_iso,
       event_type
FROM events"""

ORACLE["load_file_part"] = """
SELECT CAST(p_partkey AS DECIMAL(38,0)) AS Part_Key, p_name AS PartName,
       p_brand AS Brand_Code, p_type AS Type_Text, CAST(p_size AS DECIMAL(38,0)) AS Size,
       CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DECIMAL(38,2)) AS Retail_Price_USD
FROM part"""

ORACLE["normalize_headers"] = """
SELECT p_partkey, raw AS raw_header,
       replace(replace(replace(replace(replace(raw, ' ', '_'), '.', ''), '/', '_'), '(', ''),
               ')', '') AS clean_header
FROM (SELECT p_partkey, p_type || ' (' || p_brand || ')/' || p_name || '.' AS raw FROM part)"""

ORACLE["load_rejects"] = """
WITH texts AS (
    SELECT *, CASE WHEN c_custkey % 13 = 5 AND c_nationkey % 2 = 0
                   THEN '"' || c_name || chr(10) || 'and ""more""' || '"' ELSE c_name END AS name,
           c_custkey = (SELECT max(c_custkey) FROM customer WHERE c_nationkey = 0) AS unclosed
    FROM customer),
wholes AS (
    SELECT *, c_custkey || ',' || name || ',' || c_nationkey || ','
              || CAST(c_acctbal AS DECIMAL(18,2)) || ',' || c_mktsegment AS whole FROM texts),
records AS (
    SELECT *, CASE WHEN unclosed THEN c_custkey || ',"' || c_name || ',x'
                   WHEN c_acctbal < 0 THEN whole || ',EXTRA'
                   WHEN c_custkey % 11 = 3 THEN c_custkey || ',' || c_name ELSE whole END AS record,
           CASE WHEN unclosed THEN 'unclosed' WHEN c_acctbal < 0 THEN 'many'
                WHEN c_custkey % 11 = 3 THEN 'few' END AS kind
    FROM wholes),
placed AS (
    SELECT *, length(record) - length(replace(record, chr(10), '')) + 1 AS n_lines,
           CASE WHEN c_custkey % 17 = 1 THEN 1 ELSE 0 END AS blank FROM records)
SELECT c_nationkey,
       2 + CAST(coalesce(sum(n_lines + blank) OVER (PARTITION BY c_nationkey ORDER BY c_custkey
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) + blank AS line,
       CASE kind WHEN 'many' THEN length(whole) + 2 WHEN 'few' THEN length(record) + 1
                 ELSE length(c_custkey::VARCHAR) + 2 END AS character,
       CASE kind WHEN 'many' THEN 'too many fields: 6 instead of 5'
                 WHEN 'few' THEN 'too few fields: 2 instead of 5'
                 ELSE 'quoted field is not closed' END AS error,
       CASE kind WHEN 'many' THEN 'c_mktsegment' WHEN 'few' THEN 'c_nationkey' ELSE 'c_name' END
           AS column_name,
       'parsing' AS category, 'CUSTOMER' AS table_name, record AS rejected_record
FROM placed QUALIFY kind IS NOT NULL"""

ORACLE["load_good_rows"] = """
SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE NOT (c_acctbal < 0)"""

_AUDIT_SOURCES = {
    1: ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"],
    2: ["documents", "labels", "benchmark", "pages"],
    3: ["events", "embeddings", "conversations"],
}


def _audit_sql(key: int, names: list[str]) -> str:
    src = " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS source_count FROM {n}"
        + (" WHERE doc_id < 0" if n == "labels" else "") for n in names)
    tgt = " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS target_count FROM {n}"
        + (" WHERE o_orderstatus <> 'P'" if n == "orders" else "")
        for n in names if n != "benchmark")
    return (f"SELECT CAST({key} AS BIGINT) AS source_key, s.table_name, s.source_count, "
            f"coalesce(t.target_count, -1) AS target_count, 'Y' AS md_active_flag "
            f"FROM ({src}) s LEFT JOIN ({tgt}) t ON s.table_name = t.table_name "
            f"WHERE s.source_count <> 0")


ORACLE["count_audit"] = " UNION ALL ".join(_audit_sql(k, v) for k, v in _AUDIT_SOURCES.items())

ORACLE["retire_and_append"] = (
    "SELECT source_key, table_name, source_count, target_count, "
    "CASE WHEN source_key = 2 THEN 'N' ELSE md_active_flag END AS md_active_flag FROM ("
    + " UNION ALL ".join(_audit_sql(k, v) for k, v in _AUDIT_SOURCES.items())
    + ") UNION ALL " + _audit_sql(2, _AUDIT_SOURCES[2]))

ORACLE["copy_count_check"] = """
SELECT 'lineitem' AS table_name, count(*) AS source_count, count(*) AS target_count,
       TRUE AS matched FROM lineitem"""

ORACLE["soft_delete_view"] = """
SELECT event_id, ts, user_id, event_type, value, props FROM events
WHERE (CASE WHEN event_type = 'error' THEN TRUE WHEN event_type = 'signup' THEN NULL
            ELSE FALSE END) <> TRUE"""

ORACLE["global_rank_orders"] = """
SELECT o_orderkey, o_custkey, CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS ranking
FROM orders"""

ORACLE["row_number_page"] = """
SELECT o_orderkey, o_totalprice, ranking FROM (
  SELECT o_orderkey, o_totalprice,
         CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS ranking FROM orders)
WHERE ranking BETWEEN 1001 AND 2000"""

ORACLE["chunk_counts"] = """
SELECT CAST((rn - 1) // 500 AS BIGINT) AS chunk_id, count(*) AS n_rows,
       min(rn) AS first_rank, max(rn) AS last_rank
FROM (SELECT CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS rn FROM orders)
GROUP BY 1"""

ORACLE["replicate_orders"] = "SELECT * FROM orders"
ORACLE["replicate_keyless"] = "SELECT *, CAST(0 AS BIGINT) AS chunk_id FROM nation"

_SOURCE_TYPES = ["smallint", "tinyint", "decimal", "float", "int", "money", "numeric",
                 "datetime", "datetime2", "smalldatetime", "bigint", "bit", "date",
                 "varchar", "nvarchar", "varbinary", "image", "binary"]
_TYPES_LIST = "[" + ", ".join(f"'{t}'" for t in _SOURCE_TYPES) + "]"

_CATALOG_CTES = f"""
prt AS (SELECT *, upper(split_part(p_name, ' ', 2)) AS noun,
               upper(split_part(p_name, ' ', 1)) AS adj, upper(p_type) AS ptype,
               CAST(split_part(p_brand, '#', 2) AS INTEGER) AS b,
               ({_TYPES_LIST})[p_size % 18 + 1] AS dtype FROM part),
crow AS (
  SELECT CASE WHEN b % 2 = 0 THEN ptype ELSE noun END ||
         CASE WHEN p_size <= 10 THEN '_DIM' WHEN p_size <= 20 THEN '_DFACT' ELSE '_FACT' END
           AS table_name,
         CASE WHEN p_size % 7 = 0 THEN adj || '_' || noun || '_NAME'
              WHEN b % 5 = 0 THEN ptype || '_KEY'
              WHEN b % 5 = 1 THEN noun || '_KEY'
              WHEN b % 5 = 2 THEN adj || '_MONTH_KEY'
              WHEN b % 5 = 3 THEN adj || '_DATE_KEY'
              ELSE (['PKEY', 'MD_NATURAL_KEY', 'DATE_KEY', 'MONTH_DATE_KEY'])[p_size % 4 + 1]
         END AS column_name,
         dtype AS data_type,
         CAST(CASE WHEN dtype IN ('decimal', 'numeric', 'money') THEN p_size % 3
                   WHEN dtype = 'float' AND p_size % 2 = 0 THEN 2 END AS INTEGER) AS numeric_scale,
         p_partkey
  FROM prt),
cagg AS (SELECT table_name, column_name,
                arg_min({{'d': data_type, 's': numeric_scale}}, p_partkey) AS t,
                min(p_partkey) AS first_key
         FROM crow GROUP BY table_name, column_name),
cat_columns AS (
  SELECT 'PROD_DB' AS table_catalog, 'PUBLIC' AS table_schema, table_name, column_name,
         t.d AS data_type, t.s AS numeric_scale,
         CAST(row_number() OVER (PARTITION BY table_name ORDER BY first_key) AS INTEGER)
           AS ordinal_position
  FROM cagg),
cat_tables AS (
  SELECT DISTINCT table_catalog, table_schema, table_name,
         CASE WHEN table_name LIKE 'PROMO%' THEN 'VIEW' ELSE 'BASE TABLE' END AS table_type
  FROM cat_columns),
mapped AS (
  SELECT c.*, CASE
      WHEN c.data_type IN ('smallint', 'tinyint', 'decimal', 'float', 'int', 'money', 'numeric')
        THEN 'NUMBER(38, ' || coalesce(CAST(c.numeric_scale AS VARCHAR), '0') || ')'
      WHEN c.data_type IN ('datetime', 'datetime2', 'smalldatetime') THEN 'DATETIME'
      ELSE 'VARCHAR' END AS target_type
  FROM cat_columns c JOIN cat_tables t
    ON c.table_catalog = t.table_catalog AND c.table_schema = t.table_schema
   AND c.table_name = t.table_name
  WHERE t.table_type = 'BASE TABLE' AND c.data_type NOT IN ('varbinary', 'image', 'binary')),
naming_rules(pattern, never, unless, suffix, target) AS (VALUES
  ('^.*KEY$', ['MD_NATURAL_KEY', 'PKEY'], '^$', '_DIM', NULL),
  ('^.*KEY$', ['MD_NATURAL_KEY', 'PKEY'], '^$', '_DFACT', NULL),
  ('^.*MONTH.*KEY$', ['MD_NATURAL_KEY', 'PKEY'], '^$', NULL, 'MONTH_DIM_VIEW'),
  ('^.*DATE.*KEY$', ['MD_NATURAL_KEY', 'PKEY', 'DATE_KEY'], 'MONTH', NULL, 'DATE_DIM')),
named AS (
  SELECT c.table_name AS left_table, c.column_name AS left_column, r.target,
         CASE WHEN r.suffix IS NOT NULL THEN left(c.column_name, -4) || r.suffix END AS computed
  FROM cat_columns c JOIN naming_rules r ON regexp_matches(c.column_name, r.pattern)
   AND NOT list_contains(r.never, c.column_name)
   AND NOT regexp_matches(c.column_name, r.unless)),
edges AS (
  SELECT DISTINCT left_table, left_column, coalesce(target, computed) AS right_table,
         'PKEY' AS right_column
  FROM named WHERE target IS NOT NULL OR computed IN (SELECT table_name FROM cat_columns))
"""

ORACLE["type_mapping"] = f"""WITH {_CATALOG_CTES}
SELECT table_name, column_name, ordinal_position, data_type, numeric_scale, target_type
FROM mapped"""

ORACLE["grouped_columns"] = f"""WITH {_CATALOG_CTES}
SELECT table_name, count(*) AS n_columns,
       string_agg(column_name || ' ' || target_type, ', ' ORDER BY ordinal_position)
         AS column_list
FROM mapped GROUP BY table_name"""

ORACLE["convert_orders"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       o_orderstatus, CAST(o_totalprice AS DECIMAL(38,0)) AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders"""

_CONVERT_CTES = """
WITH texts AS (
    SELECT * REPLACE (
        CASE WHEN o_orderkey % 50 = 7 THEN 'n/a' WHEN o_orderkey % 50 = 8 THEN NULL
             ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS o_totalprice,
        CASE WHEN o_orderkey % 70 = 7 THEN strftime(o_orderdate, '%Y-13-%d')
             ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS o_orderdate)
    FROM orders),
bad AS (
    SELECT o_orderkey, 'o_totalprice' AS column_name, o_totalprice AS value,
           'NUMBER(38, 0)' AS target_type
    FROM texts WHERE o_totalprice = 'n/a'
    UNION ALL
    SELECT o_orderkey, 'o_orderdate', o_orderdate, 'DATETIME' FROM texts WHERE o_orderkey % 70 = 7)"""

ORACLE["convert_rejects"] = _CONVERT_CTES + """
SELECT 'orders' AS table_name, '{"o_orderkey":' || o_orderkey || '}' AS key, column_name, value, target_type
FROM bad"""

ORACLE["convert_status"] = _CONVERT_CTES + """
SELECT 'orders' AS table_name, 'failed' AS status, (SELECT count(*) FROM orders) AS n_rows,
       (SELECT count(DISTINCT o_orderkey) FROM bad) AS rejected_rows,
       (SELECT count(*) FROM bad) AS rejected_values
UNION ALL SELECT 'customer', 'converted', (SELECT count(*) FROM customer), 0, 0
UNION ALL SELECT 'lineitem', 'converted', (SELECT count(*) FROM lineitem), 0, 0
UNION ALL SELECT 'supplier', 'failed', NULL, NULL, NULL"""

ORACLE["convert_good_rows"] = _CONVERT_CTES + """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,0)) AS o_totalprice,
       CAST(o_orderdate AS TIMESTAMP) AS o_orderdate, o_orderpriority
FROM texts WHERE o_orderkey NOT IN (SELECT o_orderkey FROM bad)"""

ORACLE["relationships"] = f"WITH {_CATALOG_CTES} SELECT * FROM edges"

ORACLE["entities"] = f"""WITH {_CATALOG_CTES},
seen AS (
  SELECT left_table AS entity, right_table || chr(1) || left_table || chr(1) || '0' AS s
  FROM edges
  UNION ALL
  SELECT right_table, right_table || chr(1) || left_table || chr(1) || '1' FROM edges),
folded AS (
  SELECT table_name AS entity,
         string_agg(column_name || ' ' || data_type, ', ' ORDER BY ordinal_position)
           AS column_list
  FROM cat_columns GROUP BY table_name)
SELECT s.entity,
       CASE WHEN s.entity LIKE '%DIM' THEN '#d0e0d0' WHEN s.entity LIKE '%DFACT' THEN '#ececfc'
            ELSE '#fcecec' END AS color,
       replace(min(s.s), chr(1), '|') AS first_seen_key, f.column_list
FROM seen s LEFT JOIN folded f ON s.entity = f.entity
GROUP BY s.entity, f.column_list"""

_TEST_EDGES = [
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("labels", "doc_id", "documents", "doc_id"),
    ("events", "user_id", "customer", "c_custkey"),
]


def _edge_sql(child, ccol, parent, pcol):
    ptab = f"(SELECT * FROM {parent} WHERE lang <> 'de')" if parent == "documents" else parent
    return (f"SELECT '{child}' AS child_table, '{ccol}' AS child_column, "
            f"'{parent}' AS parent_table, '{pcol}' AS parent_column, "
            f"count(*) AS child_rows, count(c.k) AS keyed_rows, "
            f"count(DISTINCT c.k) AS child_keys, "
            f"count(DISTINCT c.k) FILTER (WHERE c.k IS NOT NULL AND p.k IS NULL) AS orphan_keys, "
            f"count(*) FILTER (WHERE c.k IS NOT NULL AND p.k IS NULL) AS orphan_rows "
            f"FROM (SELECT {ccol} AS k FROM {child}) c "
            f"LEFT JOIN (SELECT DISTINCT {pcol} AS k FROM {ptab}) p ON c.k = p.k")


ORACLE["check_relationships"] = " UNION ALL ".join(_edge_sql(*e) for e in _TEST_EDGES)

ORACLE["file_list"] = """
SELECT 'doc_' || doc_id || '.txt' AS file_name FROM documents"""

ORACLE["copy_files"] = """
SELECT 'doc_' || doc_id || '.txt' AS file_name, CAST(strlen(text) AS BIGINT) AS bytes
FROM documents"""

ORACLE["manifest_join"] = """
SELECT source AS invoice_id, 'doc_' || doc_id || '.txt' AS file_name
FROM documents WHERE lang <> 'es'"""

ORACLE["bundle_manifest"] = """
SELECT invoice_id, CAST(row_number() OVER (PARTITION BY invoice_id ORDER BY file_name) AS BIGINT)
         AS file_seq, file_name
FROM (SELECT source AS invoice_id, 'doc_' || doc_id || '.txt' AS file_name
      FROM documents WHERE lang <> 'es')"""

ORACLE["files_vs_records"] = """
SELECT 'doc_' || doc_id || '.txt' AS file_name,
       CASE WHEN lang = 'es' THEN 'missing_file' WHEN lang = 'fr' THEN 'unexpected_file'
            ELSE 'matched' END AS status
FROM documents"""

ORACLE["zip_bundles"] = """
SELECT conv_id, count(*) AS n_files, count(*) AS n_entries,
       CAST(sum(strlen(text)) AS BIGINT) AS n_bytes
FROM conversations GROUP BY conv_id"""

ORACLE["zip_folders"] = """
SELECT 'INVOICES_Source' || source || '.zip' AS archive_name, count(*) AS n_files,
       CAST(sum(strlen(text)) AS BIGINT) AS n_bytes
FROM documents WHERE lang <> 'de' GROUP BY source"""

_MX = "(6378137.0 * (({v}) * (pi() / 180.0)))"
_MY = "(6378137.0 * ln(tan(pi() / 4 + (({v}) * (pi() / 180.0)) / 2)))"
_PTS = ("SELECT c_custkey AS id, c_mktsegment AS record_source, "
        "CAST(-70.0 AS DOUBLE) + CAST(c_custkey * 104729 % 14000 AS DOUBLE) / 100.0 AS lat, "
        "CAST(-180.0 AS DOUBLE) + CAST(c_custkey * 7919 % 36000 AS DOUBLE) / 100.0 AS lon "
        "FROM customer")
# (shape, ring, vertex, dx, dy, ring size) of the triangle and the holed square
_SHAPES = [("T", 0, [(-5, -4), (5, -4), (0, 6), (-5, -4)]),
           ("S", 0, [(-6, -6), (6, -6), (6, 6), (-6, 6), (-6, -6)]),
           ("S", 1, [(-2, -2), (2, -2), (2, 2), (-2, 2), (-2, -2)])]
_SHAPE_ROWS = ", ".join(f"('{s}', {r}, {i}, {dx}, {dy}, {len(v)})"
                        for s, r, v in _SHAPES for i, (dx, dy) in enumerate(v))
_GEO_CTES = f"""
pts AS ({_PTS}),
pm AS (SELECT id, record_source, {_MX.format(v='lon')} AS px, {_MY.format(v='lat')} AS py
       FROM pts),
shapes(shape, ring, seq, dx, dy, n) AS (VALUES {_SHAPE_ROWS}),
verts AS (
  SELECT s.shape || CAST(n.n_nationkey AS VARCHAR) AS poly_id, s.ring, s.seq, s.n,
         {_MX.format(v='CAST(-170.0 AS DOUBLE) + n.n_nationkey * 14 + s.dx')} AS x,
         {_MY.format(v='CAST(-60.0 AS DOUBLE) + (n.n_nationkey % 5) * 25 + s.dy')} AS y
  FROM nation n, shapes s),
edges AS (
  SELECT a.poly_id, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
  FROM verts a JOIN verts b
    ON a.poly_id = b.poly_id AND a.ring = b.ring AND b.seq = (a.seq + 1) % a.n),
pip AS (
  SELECT p.id, e.poly_id
  FROM pm p, edges e
  GROUP BY p.id, e.poly_id
  HAVING sum(CASE WHEN ((e.y1 > p.py) <> (e.y2 > p.py))
                   AND (p.px < (e.x2 - e.x1) * (p.py - e.y1) / (e.y2 - e.y1) + e.x1)
                  THEN 1 ELSE 0 END) % 2 = 1
     AND NOT bool_or((e.x2 - e.x1) * (p.py - e.y1) - (e.y2 - e.y1) * (p.px - e.x1) = 0
                     AND p.px BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
                     AND p.py BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)))
"""

ORACLE["web_mercator"] = f"""WITH {_GEO_CTES}
SELECT id, round(px, 3) + 0.0 AS x, round(py, 3) + 0.0 AS y FROM pm"""

ORACLE["point_in_polygon"] = f"WITH {_GEO_CTES} SELECT id, poly_id FROM pip"

ORACLE["area_tag_job"] = f"""WITH {_GEO_CTES}
SELECT pip.id AS ID, c.c_mktsegment AS RECORD_SOURCE, 'NWMLS' AS MLS_NAME,
       n.n_name AS MLS_AREA_NAME, r.r_name AS COUNTY, pip.poly_id AS MLS_AREA_ID
FROM pip JOIN customer c ON c.c_custkey = pip.id
JOIN nation n ON CAST(substr(pip.poly_id, 2) AS INTEGER) = n.n_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey
WHERE c.c_mktsegment <> 'AUTOMOBILE'"""

ORACLE["missing_worklist"] = """
SELECT doc_id, source, lang FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"""

ORACLE["geocode_enrich"] = """
SELECT c.c_custkey AS ID, c.c_mktsegment AS RECORD_SOURCE,
       CASE WHEN n.n_regionkey <> 4 THEN 'OK' END AS status,
       CASE WHEN n.n_regionkey <> 4 THEN array_to_string(list_transform(
            string_split(lower(n.n_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') END
         AS formatted_address,
       CASE WHEN n.n_regionkey <> 4 THEN CAST(-60.0 AS DOUBLE) + (n.n_nationkey % 5) * 25 END
         AS lat,
       CASE WHEN n.n_regionkey <> 4 THEN CAST(-170.0 AS DOUBLE) + n.n_nationkey * 14 END AS lng
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE c.c_mktsegment <> 'MACHINERY'"""

ORACLE["api_envelope"] = """
SELECT event_id AS call_id, event_id AS EventID, user_id AS UserID, event_type AS EventType,
       value AS Value, props AS Props
FROM events WHERE event_type NOT IN ('error', 'signup')"""

ORACLE["api_routes"] = """
SELECT event_id AS call_id,
       CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'retry' ELSE 'data' END
         AS route,
       CASE WHEN event_type = 'error' THEN '5 - Invalid request parameter' END AS error
FROM events"""

ORACLE["api_retry_list"] = "SELECT event_id AS call_id FROM events WHERE event_type = 'signup'"

ORACLE["api_hierarchy"] = """
SELECT c.c_custkey AS TaskID, r.r_name AS business_unit, n.n_name AS project,
       c.c_mktsegment AS division
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey"""

ORACLE["api_form_results"] = """
SELECT l.l_orderkey AS FormID, l.l_linenumber AS line, r.r_name AS business_unit,
       n.n_name AS project, l.l_quantity AS quantity
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey"""

ORACLE["request_plan"] = """
WITH RECURSIVE rng AS (
  SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS date_from,
         CAST(max(o_orderdate) AS DATE) AS date_to FROM orders GROUP BY o_custkey),
w(o_custkey, date_to, window_from) AS (
  SELECT o_custkey, date_to, date_from FROM rng
  UNION ALL
  SELECT o_custkey, date_to, CAST(window_from + INTERVAL 3 MONTH AS DATE) FROM w
  WHERE CAST(window_from + INTERVAL 3 MONTH AS DATE) <= date_to)
SELECT o_custkey, window_from,
       least(date_to, CAST(window_from + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)) AS window_to
FROM w"""

ORACLE["request_pages"] = """
SELECT ship_year, start_row, 1000 AS page_size
FROM (SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, count(*) AS n
      FROM lineitem GROUP BY 1),
     unnest(generate_series(0, n - 1, 1000)) AS t(start_row)"""

_CONV_FIRST = """(SELECT conv_id, role, arg_min(text, turn) AS text
                  FROM conversations GROUP BY conv_id, role)"""
ORACLE["pivot_sheet"] = f"""
SELECT conv_id AS row_id,
       max(CASE WHEN role = 'user' THEN text END) AS "user",
       max(CASE WHEN role = 'assistant' THEN text END) AS assistant,
       max(CASE WHEN role = 'system' THEN text END) AS system,
       max(CASE WHEN role = 'user' THEN text END) AS user__display
FROM {_CONV_FIRST} GROUP BY conv_id"""


_HTML_CELL = '<div style="font-size: 110%;">'
_HTML_BORDER = 'style="border: 1px solid #ddd;padding: 8;">'


def _form_html_sql() -> str:
    """The expected page, written out here (not taken from the job)."""
    rows = [
        ("Submitted By", "c.c_name"), ("Project Name", "'Order ' || o.o_orderkey"),
        ("Client", "c.c_name"),
        ("Comments", "CASE WHEN o.o_orderpriority LIKE '5%' THEN '' "
                     "ELSE 'Priority ' || o.o_orderpriority END"),
        ("Address", "n.n_name"), ("Market", "c.c_mktsegment"),
        ("Value", "'$' || format('{:,.2f}', CAST(o.o_totalprice AS DECIMAL(18,2)))"),
        ("Precon Start Date", "strftime(o.o_orderdate, '%Y-%m-%d')"),
        ("Construction Start Date", "strftime(o.o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d')"),
        ("Completion Date", "strftime(o.o_orderdate + INTERVAL 365 DAY, '%Y-%m-%d')"),
        ("Client Contact", "CAST(c.c_custkey AS VARCHAR)"), ("Designer", "''"),
    ]
    sql = ["""'<html><body style="font-family: sans-serif"><table style="width: 85%">'"""]
    for i, (label, value) in enumerate(rows):
        color = "f2f2f2" if i % 2 else "ffffff"
        sql.append(f"""chr(10) || '<tr style="background-color:#{color};"><td width="50" """
                   f"""{_HTML_BORDER}{_HTML_CELL}{label}</div></td><td width="250" """
                   f"""{_HTML_BORDER}{_HTML_CELL}'""")
        sql.append(f"({value})")
        sql.append("'</div></td></tr>'")
    sql.append("'</table></body></html>'")
    return " || ".join(sql)


_ORDER_SHEET_FROM = """FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey"""

ORACLE["form_notifications"] = f"""
SELECT o.o_orderkey AS row_id, 'Project Opportunity: Order ' || o.o_orderkey AS subject,
       {_form_html_sql()} AS html
{_ORDER_SHEET_FROM} WHERE o.o_orderstatus = 'P'"""

ORACLE["form_comments"] = f"""
SELECT o.o_orderkey AS row_id, 'Priority ' || o.o_orderpriority AS comment_text
{_ORDER_SHEET_FROM}
WHERE o.o_orderstatus = 'P' AND o.o_orderpriority NOT LIKE '5%'"""

ORACLE["form_status_updates"] = """
SELECT o_orderkey AS row_id, 'Form' AS record_source FROM orders"""

ORACLE["classify_notifications"] = """
SELECT event_id, CASE WHEN event_type = 'signup' THEN 'challenge'
                      WHEN event_type = 'click' THEN 'change' ELSE 'ignored' END AS kind
FROM events"""

ORACLE["stream_new_entries"] = """
SELECT event_id AS row_id, 'Project Opportunity: Event ' || event_id AS subject
FROM events WHERE event_type = 'signup'"""

_SNAPSHOTS = """(SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"""

ORACLE["snapshot_names"] = f"""
SELECT d AS snapshot_date, 'zBACKUP_PROD_DB_' || strftime(d, '%m_%d_%Y') AS name,
       'PROD_DB' AS db
FROM {_SNAPSHOTS}"""

ORACLE["retention_plan"] = f"""
SELECT 'zBACKUP_PROD_DB_' || strftime(d, '%m_%d_%Y') AS name, d AS snapshot_date,
       CAST(DATE '2001-08-16' - d AS INTEGER) AS age_days,
       d = DATE '2001-08-16' - INTERVAL 15 DAY AS "drop",
       d <= DATE '2001-08-16' - INTERVAL 15 DAY AS drop_older
FROM {_SNAPSHOTS}"""

_ALL_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

ORACLE["snapshot_tables"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows_before, count(*) AS rows_after, "
    f"'snapshot zBACKUP_PROD_DB_08_16_2001' AS status FROM {t}" for t in _ALL_TABLES)

ORACLE["catalog_columns"] = f"""
SELECT table_name, column_name,
       CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
            WHEN 'DOUBLE' THEN 'float' WHEN 'VARCHAR' THEN 'varchar'
            WHEN 'TIMESTAMP' THEN 'datetime2' WHEN 'DATE' THEN 'date'
            WHEN 'FLOAT[]' THEN 'array<float>' ELSE data_type END AS data_type,
       ordinal_position
FROM information_schema.columns WHERE table_name IN {_ALL_TABLES}"""

ORACLE["truncate_and_load"] = """
SELECT t AS table_name, n AS source_count,
       CASE WHEN t = 'nation' THEN (SELECT count(*) FROM nation WHERE n_regionkey = 0)
            ELSE 0 END AS rows_before, n AS rows_after, TRUE AS matched
FROM (SELECT 'region' AS t, count(*) AS n FROM region UNION ALL
      SELECT 'nation', count(*) FROM nation UNION ALL
      SELECT 'supplier', count(*) FROM supplier UNION ALL
      SELECT 'part', count(*) FROM part)"""

ORACLE["transfer_all_tables"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows_after, TRUE AS matched, TRUE AS equal_values "
    f"FROM {t}" for t in _ALL_TABLES)

ORACLE["cell_updates"] = """
SELECT c.conv_id AS row_id, coalesce(u.column_id, 1) AS column_id,
       CASE WHEN u.column_id = 1 AND c.conv_id % 3 = 0 THEN NULL
            WHEN u.column_id = 1 AND c.conv_id % 3 = 1 THEN 'second'
            WHEN u.column_id = 1 THEN c.text ELSE 'added' END AS value
FROM (SELECT conv_id, min_by(text, turn) AS text FROM conversations GROUP BY conv_id) c
CROSS JOIN (VALUES (1), (99)) u(column_id)"""

ORACLE["replicate_refresh"] = "SELECT * FROM orders"
ORACLE["replicate_restart"] = "SELECT * FROM orders"

ORACLE["replicate_delta"] = "SELECT * REPLACE (o_orderkey * 2 AS o_orderkey) FROM orders"

ORACLE["replicate_delta_log"] = """
WITH newer AS (SELECT * REPLACE (o_orderkey * 2 AS o_orderkey) FROM orders),
shares AS (SELECT *, o_orderkey * 50 // (SELECT max(o_orderkey) + 1 FROM orders) AS share FROM newer),
older AS (
    SELECT * EXCLUDE (share) REPLACE (
        CASE WHEN share = 20 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice)
    FROM shares WHERE o_orderkey > 20
    UNION ALL
    SELECT * EXCLUDE (share) REPLACE (o_orderkey + 1 AS o_orderkey)
    FROM shares WHERE share = 70 AND o_orderkey % 20 = 0),
ranked AS (SELECT o_orderkey AS k, row_number() OVER (ORDER BY o_orderkey) - 1 AS r FROM older),
borders AS (SELECT CASE WHEN r = 0 THEN -1 ELSE k END AS k, r // 100 AS id FROM ranked WHERE r % 100 = 0),
differing AS (
    (SELECT * FROM (SELECT * FROM older EXCEPT ALL SELECT * FROM newer))
    UNION ALL (SELECT * FROM (SELECT * FROM newer EXCEPT ALL SELECT * FROM older))),
changed AS (
    SELECT DISTINCT b.id FROM differing d ASOF JOIN borders b ON d.o_orderkey >= b.k),
copied AS (
    SELECT count(*) AS n FROM newer d ASOF JOIN borders b ON d.o_orderkey >= b.k
    WHERE b.id IN (SELECT id FROM changed))
SELECT 0 AS call, (SELECT count(*) FROM borders) AS ranges, (SELECT count(*) FROM borders) AS copied_ranges,
       (SELECT count(*) FROM older) AS copied_rows
UNION ALL SELECT 1, (SELECT count(*) FROM borders), 0, 0
UNION ALL SELECT 2, (SELECT count(*) FROM borders), (SELECT count(*) FROM changed), (SELECT n FROM copied)"""

ORACLE["append_loads"] = "SELECT * FROM events"

ORACLE["load_documents_file"] = """
SELECT doc_id, text || CASE WHEN doc_id % 7 = 0 THEN ' "quoted"' || chr(10) || ',"tail"' ELSE '' END
         AS text, CASE WHEN doc_id % 5 > 0 THEN lang END AS lang
FROM documents"""

ORACLE["csv_round_trip"] = "SELECT * FROM orders"

ORACLE["json_lines"] = """
SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN 'ok' END AS c_comment, 6 AS n_keys
FROM customer"""

ORACLE["text_lines"] = "SELECT p_name AS value FROM part"

ORACLE["strict_load"] = "SELECT * FROM supplier"

ORACLE["load_history"] = """
SELECT run, 'PART_LOADED' AS table_name,
       CASE WHEN run = 1 THEN 0 ELSE n END AS rows_before, n AS rows_after,
       CAST(0 AS BIGINT) AS rejects, 'loaded' AS status
FROM (SELECT count(*) AS n FROM part), (VALUES (1), (2)) v(run)"""

ORACLE["area_tag_geojson"] = f"""WITH {_GEO_CTES}
SELECT pip.id, pip.poly_id, n.n_name AS name, r.r_name AS layer
FROM pip JOIN nation n ON CAST(substr(pip.poly_id, 2) AS INTEGER) = n.n_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey"""

ORACLE["api_entities"] = """
SELECT event_id AS call_id, 'T' || event_id AS TaskID, user_id AS TaskTypeLinkID,
       event_type AS TaskType, user_id AS IssuedToPackageID, value AS Cost,
       event_type = 'purchase' AS Complete, date_trunc('second', ts) AS LastModified,
       CAST(NULL AS BOOLEAN) AS Closed
FROM events WHERE event_type IN ('click', 'view', 'purchase')"""


ORACLE["api_business_units"] = """
SELECT CAST(r_regionkey AS BIGINT) AS call_id, CAST(r_regionkey AS BIGINT) AS "BusinessUnitID", r_name AS "Name"
FROM region"""

ORACLE["api_projects"] = """
SELECT CAST(n_nationkey AS BIGINT) AS call_id, CAST(n_nationkey AS BIGINT) AS "ProjectID",
       CAST(n_regionkey AS BIGINT) AS "BusinessUnitID", n_name AS "Name",
       CASE WHEN n_nationkey % 3 = 0 THEN 'M ' || n_name END AS "Manager"
FROM nation"""

ORACLE["api_package_trades"] = """
SELECT p_partkey AS call_id, p_partkey AS "PackageID", p_type AS "Trade",
       CASE WHEN p_size % 10 = 0 THEN 'open' ELSE CAST(p_size AS VARCHAR) END AS "Rate"
FROM part"""

ORACLE["api_forms"] = """
SELECT o_orderkey AS call_id, o_orderkey AS "FormID", o_orderstatus AS "Status",
       o_orderstatus = 'F' AS "Closed", strftime(o_orderdate, '%Y-%m-%d') AS "StatusDate",
       CASE WHEN o_orderkey % 2 = 0 THEN CAST(trunc(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)
            ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS "Cost"
FROM orders WHERE CAST(o_totalprice AS DECIMAL(18,2)) <= 150000"""

ORACLE["ordered_relationships"] = f"""WITH {_CATALOG_CTES}
SELECT *, row_number() OVER (ORDER BY right_table, left_table, left_column, right_column) AS position
FROM edges"""

ORACLE["ordered_manifest"] = f"""
SELECT *, row_number() OVER (ORDER BY invoice_id NULLS FIRST, file_name) AS position
FROM ({ORACLE["manifest_join"]})"""
