"""Oracle SQL per catalogued key (DuckDB, over the pre-registered tables)."""

from __future__ import annotations

from odpanel.functions import REGION_PREFIXES
from odpanel.plans.oracle import sql

ORACLE: dict[str, str] = {}


def _add(key, body, doubles=()):
    ORACLE[key] = sql(body, list(doubles))


_add("clean_corridors", "SELECT * FROM corridors", ["value"])
_add("clean_regional", "SELECT * FROM regional", ["value"])
_add("clean_cargo", "SELECT * FROM cargo", ["value"])
_add("clean_price", "SELECT * FROM price_index", ["price_index"])
_add("clean_bands", "SELECT * FROM distance_bands", ["value"])
_COST_D = ["km_anual", "pct_carga", "km_en_carga", "horas_anuales", "personal_conduccion_eur",
           "dietas_conductor_eur", "seguros_eur", "costes_fiscales_eur", "peajes_eur",
           "urea_eur", "costes_indirectos_eur", "fuel_price_per_litre",
           "fuel_consumption_coeff", "combustible_eur"]
_add("clean_cost", "SELECT * FROM cost", _COST_D)

_NCOLS = {"corridors": 5, "regional": 5, "cargo": 6, "price_index": 4, "distance_bands": 5,
          "cost": 15}
_add("table_summary", " UNION ALL ".join(
    f"SELECT '{n}' AS dataset, (SELECT count(*) FROM {n}_raw) AS raw_rows, "
    f"(SELECT count(*) FROM {n}) AS clean_rows, CAST({k} AS INTEGER) AS n_columns"
    for n, k in _NCOLS.items()))

_add("wide_flows", "SELECT * FROM wide", ["ops_total", "ops_empty", "tonnes"])
_add("flow_asymmetry", "SELECT origin, destination, asymmetry FROM pairs", ["asymmetry"])
_add("empty_rate", "SELECT origin, destination, empty_rate FROM pairs", ["empty_rate"])
_add("flow_instability", "SELECT origin, destination, instability FROM pairs", ["instability"])
_add("hhi_by_origin", "SELECT * FROM hhi", ["concentration"])
_add("cargo_shares", """
  SELECT t.year, t.region, t.cargo_class, t.tonnes, tt.total, t.tonnes / nullif(tt.total, 0) AS share
  FROM cargo_t t JOIN cargo_tot tt ON t.year = tt.year AND t.region = tt.region""",
     ["tonnes", "total", "share"])
_M = ["asymmetry", "empty_rate", "instability", "concentration"]
_add("minmax_norm", "SELECT * FROM ranking", _M + [m + "_n" for m in _M])
_add("zscore_norm", "SELECT origin, destination, " + ", ".join(
    f"({m} - (SELECT avg({m}) FROM scored)) / nullif((SELECT stddev_samp({m}) FROM scored), 0) AS {m}_z"
    for m in _M) + " FROM scored", [m + "_z" for m in _M])
_add("corridor_ranking", "SELECT * FROM ranked ORDER BY composite DESC, origin, destination",
     _M + [m + "_n" for m in _M] + ["composite"])
_add("sql_top_corridors", "SELECT origin, destination, round(composite, 3) AS score FROM ranked "
     "ORDER BY composite DESC, origin, destination LIMIT 20", ["score"])

_add("period_split", "SELECT period, CAST(year(period) AS INTEGER) AS year, "
     "'Q' || CAST(quarter(period) AS VARCHAR) AS quarter FROM cost")
_add("cost_per_unit", "SELECT * FROM cost_unit", ["total_cost_eur", "km_anual", "cost_per_km"])
_add("derived_cost", "SELECT period, km_anual * pct_carga / 100 AS km_en_carga, "
     "fuel_price_per_litre * fuel_consumption_coeff * km_anual AS combustible_eur FROM cost_raw",
     ["km_en_carga", "combustible_eur"])
_add("rebase_cost", "SELECT * FROM cost_idx", ["cost_per_km", "cost_idx"])
_add("rebase_price", "SELECT * FROM price_idx", ["price_idx"])
_add("margin_index", "SELECT * FROM mpi ORDER BY distance_band, year, quarter",
     ["price_idx", "cost_idx", "mpi"])
_add("margin_index_dropgaps", "SELECT * FROM mpi_inner ORDER BY distance_band, year, quarter",
     ["price_idx", "cost_idx", "mpi"])
_add("margin_summary", """
  SELECT distance_band, round(avg(mpi), 2) AS avg_mpi, round(min(mpi), 2) AS min_mpi,
         round(max(mpi), 2) AS max_mpi
  FROM mpi GROUP BY distance_band ORDER BY avg_mpi, distance_band""",
     ["avg_mpi", "min_mpi", "max_mpi"])
_add("sql_avg_index", "SELECT distance_band, round(avg(mpi), 2) AS avg_mpi FROM mpi "
     "GROUP BY distance_band ORDER BY avg_mpi, distance_band", ["avg_mpi"])
_add("shock_flag", "SELECT period, year, quarter, fuel_price_per_litre, fuel_shock FROM enriched",
     ["fuel_price_per_litre"])
_add("shock_counts", "SELECT fuel_shock, count(*) AS count FROM enriched GROUP BY fuel_shock")

# ---- profiling -------------------------------------------------------------------
_RAW_COLS = {
    "corridors": [("year", "num"), ("origin_region", "str"), ("destination_region", "str"),
                  ("metric", "str"), ("value", "num")],
    "regional": [("year", "num"), ("region", "str"), ("displacement_type", "str"),
                 ("metric", "str"), ("value", "num")],
    "cargo": [("year", "num"), ("region", "str"), ("direction", "str"), ("cargo_class", "str"),
              ("metric", "str"), ("value", "num")],
    "price_index": [("year", "num"), ("quarter", "str"), ("distance_band", "str"),
                    ("price_index", "num")],
    "distance_bands": [("year", "num"), ("distance_band", "str"), ("service_type", "str"),
                       ("metric", "str"), ("value", "num")],
    "cost": [("period", "date"), ("vehicle_type", "str")] + [
        (c, "num") for c in ["km_anual", "pct_carga", "km_en_carga", "horas_anuales",
                             "personal_conduccion_eur", "dietas_conductor_eur", "seguros_eur",
                             "costes_fiscales_eur", "peajes_eur", "urea_eur",
                             "costes_indirectos_eur", "vehicle_price_eur",
                             "semitrailer_price_eur", "fuel_price_per_litre",
                             "fuel_consumption_coeff", "interest_rate_pct", "combustible_eur"]],
}


def _blank(c, kind, ds="corridors"):
    texts = "'', '..'" if ds == "corridors" else "''"
    return (f"{c} IS NULL OR trim({c}) IN ({texts})" if kind == "str" else f"{c} IS NULL")


def _ndist(c):
    return (f"count(DISTINCT {c}) + CASE WHEN count(*) FILTER (WHERE {c} IS NULL) > 0 "
            f"THEN 1 ELSE 0 END")


def _mean(c):
    """The mean of the doubles, summed with compensation."""
    return f"favg({c})"


def _num(c, kind, fn):
    if kind == "num" and fn == "avg":
        return _mean(c)
    return f"CAST({fn}({c}) AS DOUBLE)" if kind == "num" else "CAST(NULL AS DOUBLE)"


_FREQ = [("corridors", "metric"), ("regional", "displacement_type"), ("cargo", "cargo_class"),
         ("price_index", "distance_band"), ("distance_bands", "distance_band")]
_add("value_counts", " UNION ALL ".join(
    f"SELECT '{ds}' AS dataset, '{c}' AS column_name, {c} AS value, count(*) AS count "
    f"FROM {ds}_raw GROUP BY {c}" for ds, c in _FREQ))
_add("year_counts", "SELECT substr(CAST(period AS VARCHAR), 1, 4) AS year, count(*) AS count "
     "FROM cost_raw GROUP BY 1 ORDER BY 1")
_DIST = {
    "corridors": ["year", "origin_region", "destination_region", "metric"],
    "regional": ["region", "displacement_type", "metric"],
    "cargo": ["cargo_class", "direction", "region"],
    "price_index": ["year", "quarter", "distance_band"],
    "distance_bands": ["distance_band", "service_type", "metric"],
    "cost": ["period", "vehicle_type"],
}
_add("distinct_values", " UNION ALL ".join(
    f"SELECT DISTINCT '{ds}' AS dataset, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value "
    f"FROM {ds}_raw" for ds, cols in _DIST.items() for c in cols))
_add("profile_nulls", " UNION ALL ".join(
    f"SELECT '{ds}' AS dataset, '{c}' AS column_name, count(*) FILTER (WHERE {_blank(c, k, ds)}) "
    f"AS n_null FROM {ds}_raw" for ds, cols in _RAW_COLS.items() for c, k in cols))
_add("profile_distinct", " UNION ALL ".join(
    f"SELECT '{ds}' AS dataset, '{c}' AS column_name, {_ndist(c)} AS n_distinct FROM {ds}_raw"
    for ds in ("corridors", "regional", "cargo") for c, _ in _RAW_COLS[ds]))
_NUMC = {
    "corridors": ["value"], "regional": ["value"], "cargo": ["value"],
    "price_index": ["price_index"], "distance_bands": ["value"],
    "cost": ["fuel_price_per_litre", "personal_conduccion_eur", "dietas_conductor_eur",
             "seguros_eur", "costes_fiscales_eur", "combustible_eur"],
}
_add("profile_numeric", " UNION ALL ".join(
    f"SELECT '{ds}' AS dataset, '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min_v, "
    f"CAST(max({c}) AS DOUBLE) AS max_v, {_mean(c)} AS avg_v FROM {ds}_raw"
    for ds, cols in _NUMC.items() for c in cols), ["min_v", "max_v", "avg_v"])
_add("profile_summary", " UNION ALL ".join(
    f"SELECT '{ds}' AS dataset, '{c}' AS column_name, count(*) AS n_rows, "
    f"count(*) FILTER (WHERE {_blank(c, k, ds)}) AS n_null, {_ndist(c)} AS n_distinct, "
    f"{_num(c, k, 'min')} AS min_v, {_num(c, k, 'max')} AS max_v, {_num(c, k, 'avg')} AS avg_v "
    f"FROM {ds}_raw" for ds, cols in _RAW_COLS.items() for c, k in cols),
    ["min_v", "max_v", "avg_v"])
_CLEAN_DROPPED = {"vehicle_type", "vehicle_price_eur", "semitrailer_price_eur", "interest_rate_pct"}
_add("profile_summary_clean", " UNION ALL ".join(
    f"SELECT '{ds}' AS dataset, '{c}' AS column_name, count(*) AS n_rows, "
    f"count(*) FILTER (WHERE {_blank(c, k, ds)}) AS n_null, {_ndist(c)} AS n_distinct, "
    f"{_num(c, k, 'min')} AS min_v, {_num(c, k, 'max')} AS max_v, {_num(c, k, 'avg')} AS avg_v "
    f"FROM {ds}" for ds, cols in _RAW_COLS.items() for c, k in cols
    if not (ds == "cost" and c in _CLEAN_DROPPED)),
    ["min_v", "max_v", "avg_v"])
_STATS = [("cost", "fuel_price_per_litre", "cost"), ("cost", "combustible_eur", "cost"),
          ("cost", "personal_conduccion_eur", "cost"), ("cost", "peajes_eur", "cost"),
          ("price_index", "price_index", "price_index"),
          ("corridors", "value",
           "(SELECT * FROM corridors WHERE metric = 'transport_operations_total')")]
_add("stats_mmm", " UNION ALL ".join(
    f"SELECT '{ds}' AS dataset, '{c}' AS column_name, {_mean(c)} AS mean, "
    f"CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS median, "
    f"(SELECT CAST(v AS DOUBLE) FROM (SELECT {c} AS v, count(*) AS n FROM {src} s2 GROUP BY {c}) "
    f"ORDER BY n DESC, v ASC NULLS LAST LIMIT 1) AS mode FROM {src} s1"
    for ds, c, src in _STATS), ["mean", "median", "mode"])
_add("stats_stddev", "SELECT 'cost' AS dataset, 'combustible_eur' AS column_name, "
     "stddev_samp(combustible_eur) AS stddev FROM cost", ["stddev"])

# ---- data quality -----------------------------------------------------------------
_add("dq_taxonomy", """
  SELECT year, count(DISTINCT cargo_class) AS n_classes,
         count(DISTINCT cargo_class) = 6 AND count(DISTINCT cargo_class) FILTER (
           WHERE cargo_class IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD')) = 6
           AS match
  FROM cargo GROUP BY year""")
_add("dq_band_share", """
  SELECT b.year, b.distance_band, b.value / nullif(t.value, 0) * 100 AS share_pct
  FROM distance_bands b JOIN distance_bands t
    ON b.year = t.year AND t.distance_band = 'Total' AND t.metric = 'operations_total'
   AND t.service_type = 'total'
  WHERE b.metric = 'operations_total' AND b.service_type = 'total' AND b.distance_band <> 'Total'""",
     ["share_pct"])
_add("dq_density", """
  SELECT 'corridors' AS dataset, count(*) // (count(DISTINCT year) * count(DISTINCT metric)) AS density
  FROM corridors
  UNION ALL
  SELECT 'price_index', CASE WHEN count(DISTINCT year) > 0 THEN count(*) // count(DISTINCT year)
                             ELSE 0 END FROM price_index""")
_add("dq_spot", "SELECT * FROM corridors WHERE year = 2000 AND origin_region = 'NATION_1' "
     "AND destination_region = 'NATION_2' AND metric = 'transport_operations_total'", ["value"])
_add("dq_trend", """
  SELECT period, fuel_price_per_litre, (SELECT min(period) FROM cost) AS first_period,
         (SELECT max(period) FROM cost) AS last_period
  FROM cost ORDER BY period""", ["fuel_price_per_litre"])

# ---- sources, sinks, records ---------------------------------------------------------
_add("obs_extract", """
  SELECT period, vehicle_type, km_anual, pct_carga, km_anual * pct_carga / 100.0 AS km_en_carga,
         horas_anuales, personal_conduccion_eur, dietas_conductor_eur, seguros_eur,
         costes_fiscales_eur, peajes_eur, urea_eur, costes_indirectos_eur, vehicle_price_eur,
         semitrailer_price_eur, fuel_price_per_litre, fuel_consumption_coeff, interest_rate_pct,
         fuel_price_per_litre * fuel_consumption_coeff * km_anual AS combustible_eur
  FROM cost_raw ORDER BY period""",
     ["km_anual", "pct_carga", "km_en_carga", "horas_anuales", "personal_conduccion_eur",
      "dietas_conductor_eur", "seguros_eur", "costes_fiscales_eur", "peajes_eur", "urea_eur",
      "costes_indirectos_eur", "vehicle_price_eur", "semitrailer_price_eur",
      "fuel_price_per_litre", "fuel_consumption_coeff", "interest_rate_pct", "combustible_eur"])
_add("obs_quality", "SELECT count(*) AS files, "
     "CAST(0 AS BIGINT) AS short_records, "
     "CAST(0 AS BIGINT) AS bad_fields FROM cost_raw")
_add("csv_roundtrip", "SELECT * FROM corridors", ["value"])
_add("files_by_year", "SELECT * FROM corridors", ["value"])
_add("scan_table", "SELECT * FROM price_index", ["price_index"])
_add("proj_alias", "SELECT o_orderkey AS order_id, o_custkey AS customer_id, "
     "CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders")

# ---- grids --------------------------------------------------------------------------
_CS = ("CASE metric WHEN 'transport_operations_total' THEN '6.5' "
       "WHEN 'transport_operations_empty' THEN '6.6' WHEN 'tonnes_thousands' THEN '6.7' "
       "WHEN 'tonne_km_millions' THEN '6.8' END")
_RS = ("CASE metric WHEN 'operations_total' THEN '6.1' WHEN 'operations_empty' THEN '6.2' "
       "WHEN 'tonnes_thousands' THEN '6.3' WHEN 'tonne_km_millions' THEN '6.4' END")
_SPAN = "(SELECT max(n_nationkey) + 1 FROM nation)"
_HALF = f"(({_SPAN} + 1) // 2)"
_add("clean_cells", f"""
  SELECT 'flows_' || CAST(c.year AS VARCHAR) AS file,
         {_CS} || CASE WHEN d.n_nationkey < {_HALF} THEN '' ELSE 's' END AS sheet,
         17 + o.n_nationkey AS row,
         CASE WHEN d.n_nationkey < {_HALF} THEN d.n_nationkey + 1 ELSE d.n_nationkey - {_HALF} END AS col,
         c.value AS value
  FROM corridors_raw c JOIN nation o ON c.origin_region = o.n_name
  JOIN nation d ON c.destination_region = d.n_name
  UNION ALL
  SELECT DISTINCT 'flows_' || CAST(c.year AS VARCHAR), {_CS}, 17 + o.n_nationkey, 0,
         CAST(NULL AS DOUBLE)
  FROM corridors_raw c JOIN nation o ON c.origin_region = o.n_name""", ["value"])
_add("normalize_labels", f"""
  SELECT DISTINCT 'regional_' || CAST(r.year AS VARCHAR) AS file, {_RS} AS sheet,
         17 + n.n_nationkey AS row, r.region AS raw_label, r.region AS label
  FROM regional_raw r JOIN nation n ON r.region = n.n_name
  UNION ALL
  SELECT DISTINCT 'regional_' || CAST(year AS VARCHAR), {_RS}, 17 + {_SPAN}, 'TOTAL', NULL
  FROM regional_raw""")
_add("unpivot_labels", "SELECT * FROM price_index_raw WHERE price_index IS NOT NULL",
     ["price_index"])
_add("od_matrix_long", """
  SELECT * FROM corridors_raw
  WHERE value IS NOT NULL AND origin_region <> destination_region
    AND origin_region <> 'NATION_24' AND destination_region <> 'NATION_24'""", ["value"])
_add("price_from_grid", "SELECT * FROM price_index_raw WHERE price_index IS NOT NULL",
     ["price_index"])
_add("regional_from_grid", "SELECT * FROM regional_raw WHERE value IS NOT NULL AND region IS NOT NULL",
     ["value"])
_add("bands_from_grid", "SELECT * FROM distance_bands_raw WHERE value IS NOT NULL", ["value"])
_add("block_detect", f"""
  SELECT DISTINCT 'cargo_' || CAST(c.year AS VARCHAR) AS file,
         CASE c.metric WHEN 'operations' THEN '7.4' ELSE '7.5' END || 'p'
           || CAST(2 * coalesce(n.n_nationkey % 4, 0) + 1 AS VARCHAR) AS sheet,
         16 + 10 * coalesce(n.n_nationkey // 4, ({_SPAN} + 3) // 4) AS row, c.region AS region
  FROM cargo_raw c LEFT JOIN nation n ON c.region = n.n_name""")
_add("block_extract", "SELECT * FROM cargo_raw", ["value"])

# ---- describe ---------------------------------------------------------------------
# DuckDB type names mapped to Spark's DESCRIBE names (the only types the panel has).
ORACLE["describe_table"] = f"""
  SELECT column_name AS col_name,
         CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
                          WHEN 'DOUBLE' THEN 'double' ELSE lower(column_type) END AS data_type,
         CAST(NULL AS VARCHAR) AS comment
  FROM (DESCRIBE ({sql("SELECT * FROM corridors")}))"""

# ---- scans and summaries ------------------------------------------------------------
# ---- grids and records of the given texts ---------------------------------------------
def _trimmed(x: str) -> str:
    return f"regexp_replace({x}, '^[\\x01-\\x20]+|[\\x01-\\x20]+$', '', 'g')"


_LINES = """l AS (SELECT rid, CAST(doc_id AS VARCHAR) AS file, source AS sheet,
           CAST(unnest(range(len(ls))) AS INTEGER) AS row, unnest(ls) AS line
         FROM (SELECT row_number() OVER () AS rid, doc_id, source,
                      string_split(text, chr(10)) AS ls FROM documents))"""
ORACLE["document_cells"] = f"""
  WITH {_LINES},
  p AS (SELECT file, sheet, row, CAST(unnest(range(len(ps))) AS INTEGER) AS col,
               unnest(ps) AS part
        FROM (SELECT *, regexp_split_to_array(line, '[| ]+') AS ps FROM l)),
  c AS (SELECT file, sheet, row, col, {_trimmed("part")} AS text FROM p),
  v AS (SELECT *, CASE WHEN text NOT IN ('..', '.', '-') THEN TRY_CAST(text AS DOUBLE) END
               AS value FROM c WHERE text <> '')
  SELECT file, sheet, max(row) + 1 AS n_rows, count(*) AS n_cells, max(col) + 1 AS n_cols,
         count(value) AS n_values, round(max(value), 6) AS max_value
  FROM v GROUP BY file, sheet"""
_RULES = " ".join(f"WHEN starts_with(label, '{p}') THEN '{c}'" for p, c in sorted(
    REGION_PREFIXES.items(), key=lambda r: -len(r[0])))
ORACLE["document_blocks"] = f"""
  WITH {_LINES},
  t AS (SELECT file, sheet, row, {_trimmed("line")} AS label FROM l)
  SELECT t.file, t.sheet, t.row, CASE WHEN label = 'TOTAL' THEN NULL {_RULES} ELSE label END
         AS region
  FROM t JOIN (SELECT file, sheet, row - 1 AS row FROM t WHERE label LIKE '%License%') n
    USING (file, sheet, row)
  WHERE label <> '' AND NOT starts_with(label, '(') AND NOT starts_with(label, 'Fuente')"""
_LIT = "CASE WHEN s LIKE '\"%\"' OR s LIKE '#%#' THEN s[2:-2] ELSE s END"


def _bad_line(i: int, kind: str) -> str:
    return (f"CAST(len(ls) >= {i} AND TRY_CAST(list_transform([{_trimmed(f'ls[{i}]')}], "
            f"lambda s: {_LIT})[1] AS {kind}) IS NULL AS INTEGER)")


ORACLE["document_records"] = f"""
  WITH r AS (SELECT CASE WHEN ls[-1] = '' THEN ls[:-2] ELSE ls END AS ls
             FROM (SELECT regexp_split_to_array(coalesce(text, ''), '\\r\\n|\\n|\\r') AS ls
                   FROM documents))
  SELECT count(*) AS files, count(*) FILTER (len(ls) < 12) AS short_records,
         CAST(coalesce(sum(CASE WHEN len(ls) >= 12 THEN {_bad_line(2, "DOUBLE")}
           + {_bad_line(5, "DOUBLE")} + {_bad_line(9, "DOUBLE")} + {_bad_line(12, "DATE")}
           ELSE 0 END), 0) AS BIGINT) AS bad_fields
  FROM r"""
ORACLE["carry_forward"] = """
  SELECT event_id, user_id, round(last_value(CASE WHEN event_type = 'purchase' THEN value END
           IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
                               ROWS UNBOUNDED PRECEDING), 6) AS last_purchase FROM events"""
_FREQUENT = [("lineitem", "l_partkey"), ("lineitem", "l_suppkey"), ("events", "user_id")]
_PLACED = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) AS INTEGER)"
    f" AS place, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {t} GROUP BY {c}"
    for t, c in _FREQUENT)
ORACLE["heavy_hitters"] = f"SELECT * FROM ({_PLACED}) WHERE place <= 20"
ORACLE["column_modes"] = f"SELECT column_name, value, n FROM ({_PLACED}) WHERE place = 1"
ORACLE["quantile_sketches"] = """
  SELECT s.first_year, s.last_year, p.p, count(*) AS n, true AS within_bound
  FROM lineitem JOIN (
    SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS first_year,
           CAST(year(l_shipdate) AS INTEGER) AS last_year FROM lineitem
    UNION ALL SELECT 0, 9999) s ON year(l_shipdate) BETWEEN s.first_year AND s.last_year,
    (SELECT unnest([0.01, 0.25, 0.5, 0.75, 0.99])::DOUBLE AS p) p
  GROUP BY ALL"""
ORACLE["distinct_sketches"] = """
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(DISTINCT o_custkey) AS n,
         true AS hll_ok, true AS theta_ok FROM orders GROUP BY ALL
  UNION ALL SELECT NULL, count(DISTINCT o_custkey), true, true FROM orders"""
ORACLE["distinct_overlap"] = """
  WITH c AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y, o_custkey FROM orders),
  y AS (SELECT y, count(*) AS size FROM c GROUP BY y)
  SELECT a.y AS a, b.y AS b, coalesce(s.n, 0) AS n_shared,
         a.size + b.size - coalesce(s.n, 0) AS n_all, true AS both_ok, true AS either_ok
  FROM y a JOIN y b ON a.y < b.y
  LEFT JOIN (SELECT p.y AS a, q.y AS b, count(*) AS n FROM c p JOIN c q USING (o_custkey)
             WHERE p.y < q.y GROUP BY ALL) s ON s.a = a.y AND s.b = b.y"""
ORACLE["distinct_bitmaps"] = " UNION ALL ".join(
    f"SELECT {y} AS year, '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM lineitem"
    f"{g}" for c in ("l_orderkey", "l_partkey", "l_suppkey")
    for y, g in (("CAST(year(l_shipdate) AS INTEGER)", " GROUP BY year(l_shipdate)"), ("NULL", "")))
_add("counted_writes", " UNION ALL ".join(
    f"SELECT '{n}' AS dataset, (SELECT count(*) FROM {n}_raw) AS raw_rows, "
    f"(SELECT count(*) FROM {n}) AS clean_rows" for n in _NCOLS))
ORACLE["bucketed_join"] = """
  SELECT o_orderpriority, count(*) AS n_orders, CAST(sum(n_lines) AS BIGINT) AS n_lines,
         sum(qty) AS qty
  FROM orders JOIN (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty
                    FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
  GROUP BY o_orderpriority"""
_add("rewritten_year", "SELECT * REPLACE (CASE WHEN year = 1997 THEN 2 ELSE 1 END * value AS value) "
     "FROM corridors", ["value"])
ORACLE["variant_fields"] = """
  SELECT event_type, count(*) AS n_rows, 0::BIGINT AS n_bad,
         count(json_extract(props, '$.k')) AS n_k,
         CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k,
         0::BIGINT AS n_none FROM events GROUP BY event_type"""
ORACLE["variant_types"] = """
  SELECT 'props' AS column_name, count(*) AS n_rows, 0::BIGINT AS n_null, 0::BIGINT AS n_bad,
         'OBJECT<k: BIGINT>' AS found FROM events
  UNION ALL SELECT 'event_type', count(*), 0, count(*), NULL FROM events"""
ORACLE["csv_bad_lines"] = """
  SELECT c_mktsegment AS segment, count(*) AS n_lines,
         count_if(c_mktsegment = 'BUILDING') AS n_bad FROM customer GROUP BY c_mktsegment"""
