"""DuckDB SQL that recomputes every catalogued query from the raw tables.

The SQL is written independently of the Spark plans: the panels are
recomputed straight from lineitem and its dimensions (plain joins and GROUP
BY, no cubes), then each query is a CTE chain over them. Final doubles are
rounded to 6 places on both sides (``+ 0.0`` folds ``-0.0``).
"""

from __future__ import annotations

Y0, Y1 = 1995, 2000   # analysis window; Y0 is the base year


def _unpivot(src: str, ids: str, metrics: list[tuple[str, str]]) -> str:
    return "\n  UNION ALL ".join(
        f"SELECT {ids}, '{name}' AS metric, {expr} AS value FROM {src}" for name, expr in metrics)


CTES: dict[str, str] = {}

CTES["pair_flows"] = """
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS year,
         ns.n_nationkey AS o_nk, nc.n_nationkey AS d_nk,
         ns.n_name AS o_name, nc.n_name AS d_name,
         ns.n_regionkey AS o_rk, nc.n_regionkey AS d_rk,
         count(*) AS n_ops,
         count(*) FILTER (WHERE l.l_returnflag = 'R') AS n_empty,
         sum(l.l_quantity) AS qty,
         sum(CAST(round(l.l_extendedprice * 100) AS BIGINT)) AS price
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation ns ON s.s_nationkey = ns.n_nationkey
  JOIN nation nc ON c.c_nationkey = nc.n_nationkey
  GROUP BY ALL"""

_FLOW_METRICS = lambda names: [
    (names[0], "CAST(n_ops AS DOUBLE)"),
    (names[1], "CAST(n_empty AS DOUBLE)"),
    (names[2], "qty"),
    (names[3], "CAST(price AS DOUBLE) / 100000.0"),
]

CTES["corridors_raw"] = _unpivot(
    "pair_flows", "year, o_name AS origin_region, d_name AS destination_region",
    _FLOW_METRICS(["transport_operations_total", "transport_operations_empty",
                   "tonnes_thousands", "tonne_km_millions"]))

CTES["corridors"] = f"""
  SELECT * FROM corridors_raw
  WHERE value IS NOT NULL AND origin_region IS NOT NULL AND destination_region IS NOT NULL
    AND origin_region <> destination_region AND year BETWEEN {Y0} AND {Y1}"""

CTES["regional_g"] = """
  SELECT year, region, displacement_type, sum(n_ops) AS n_ops, sum(n_empty) AS n_empty,
         sum(qty) AS qty, sum(price) AS price
  FROM (
    SELECT year, o_name AS region,
           CASE WHEN o_nk = d_nk THEN 'intrarregional_total'
                WHEN o_rk = d_rk THEN 'interregional_expedido'
                ELSE 'internacional_expedido' END AS displacement_type,
           n_ops, n_empty, qty, price FROM pair_flows
    UNION ALL
    SELECT year, d_name,
           CASE WHEN o_rk = d_rk THEN 'interregional_recibido'
                ELSE 'internacional_recibido' END,
           n_ops, n_empty, qty, price FROM pair_flows WHERE o_nk <> d_nk)
  GROUP BY ALL"""

CTES["regional_raw"] = _unpivot(
    "regional_g", "year, region, displacement_type",
    _FLOW_METRICS(["operations_total", "operations_empty", "tonnes_thousands",
                   "tonne_km_millions"]))

CTES["regional"] = f"""
  SELECT * FROM regional_raw
  WHERE value IS NOT NULL AND region IS NOT NULL AND year BETWEEN {Y0} AND {Y1}"""

CTES["cargo_g"] = """
  SELECT x.year, n.n_name AS region, x.direction, x.p_type AS cargo_class,
         count(*) AS n_ops, sum(x.l_quantity) AS qty
  FROM (
    SELECT CAST(year(o.o_orderdate) AS INTEGER) AS year, s.s_nationkey AS o_nk,
           c.c_nationkey AS d_nk, p.p_type, l.l_quantity
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN supplier s ON l.l_suppkey = s.s_suppkey
    JOIN part p ON l.l_partkey = p.p_partkey
    WHERE s.s_nationkey <> c.c_nationkey) b0,
  LATERAL (SELECT b0.year, b0.o_nk AS nk, 'expedido' AS direction, b0.p_type, b0.l_quantity
           UNION ALL
           SELECT b0.year, b0.d_nk, 'recibido', b0.p_type, b0.l_quantity) x
  JOIN nation n ON x.nk = n.n_nationkey
  GROUP BY ALL"""

CTES["cargo_raw"] = """
  SELECT year, region, direction, cargo_class, 'operations' AS metric,
         CAST(n_ops AS DOUBLE) AS value FROM cargo_g
  UNION ALL
  SELECT year, region, direction, cargo_class, 'tonnes_thousands',
         qty FROM cargo_g
  UNION ALL
  SELECT year, NULL, direction, cargo_class, 'operations', CAST(sum(n_ops) AS DOUBLE)
  FROM cargo_g GROUP BY year, direction, cargo_class
  UNION ALL
  SELECT year, NULL, direction, cargo_class, 'tonnes_thousands', sum(qty)
  FROM cargo_g GROUP BY year, direction, cargo_class"""

CTES["cargo"] = f"""
  SELECT * FROM cargo_raw
  WHERE value IS NOT NULL AND value > 0 AND region IS NOT NULL AND cargo_class IS NOT NULL
    AND year BETWEEN {Y0} AND {Y1}"""

CTES["ship"] = """
  SELECT CAST(year(l.l_shipdate) AS INTEGER) AS year, CAST(quarter(l.l_shipdate) AS INTEGER) AS q,
         'band_' || CAST(CAST(ceil(p.p_size / 10) AS INTEGER) AS VARCHAR) AS band,
         l.l_linestatus, l.l_quantity, l.l_extendedprice
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""

CTES["price_index_raw"] = """
  SELECT year, 'Q' || CAST(q AS VARCHAR) AS quarter, band AS distance_band,
         avg(l_extendedprice / l_quantity) AS price_index
  FROM ship GROUP BY ALL
  UNION ALL
  SELECT year, 'Q' || CAST(q AS VARCHAR), 'Total', avg(l_extendedprice / l_quantity)
  FROM ship GROUP BY ALL"""

CTES["price_index"] = f"""
  SELECT * FROM price_index_raw WHERE price_index IS NOT NULL AND year BETWEEN {Y0} AND {Y1}"""

CTES["bands_g"] = """
  SELECT year, distance_band, service_type, count(*) AS n, sum(l_quantity) AS qty,
         sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS price
  FROM (
    SELECT year, b.distance_band, s.service_type, l_quantity, l_extendedprice
    FROM ship,
    LATERAL (SELECT band AS distance_band UNION ALL SELECT 'Total') b,
    LATERAL (SELECT 'total' AS service_type
             UNION ALL
             SELECT CASE l_linestatus WHEN 'F' THEN 'cuenta_ajena'
                                      WHEN 'O' THEN 'cuenta_propia' END) s
    WHERE s.service_type IS NOT NULL)
  GROUP BY ALL"""

CTES["distance_bands_raw"] = _unpivot(
    "bands_g", "year, distance_band, service_type",
    [("operations_total", "CAST(n AS DOUBLE)"), ("tonnes_thousands", "qty"),
     ("tonne_km_millions", "CAST(price AS DOUBLE) / 100000.0")])

CTES["distance_bands"] = """
  SELECT * FROM distance_bands_raw
  WHERE value IS NOT NULL AND value > 0 AND distance_band IS NOT NULL"""

_COMBOS = [("personal_conduccion_eur", "A", "F"), ("dietas_conductor_eur", "A", "O"),
           ("seguros_eur", "N", "F"), ("costes_fiscales_eur", "N", "O"),
           ("peajes_eur", "R", "F"), ("urea_eur", "R", "O")]
_PRICE = "CAST(round(l_extendedprice * 100) AS BIGINT)"
_DISC, _TAX = "CAST(round(l_discount * 100) AS BIGINT)", "CAST(round(l_tax * 100) AS BIGINT)"
CTES["cost_g"] = f"""
  SELECT CAST(year(l_shipdate) AS INTEGER) AS y, CAST(quarter(l_shipdate) AS INTEGER) AS q,
         sum(l_quantity) AS km_anual,
         CAST(count(*) FILTER (WHERE l_linestatus = 'F') AS DOUBLE) * CAST(100.0 AS DOUBLE)
           / count(*) AS pct_carga,
         CAST(count(*) AS DOUBLE) AS horas_anuales,
         {", ".join(f"CAST(sum({_PRICE} * ({_DISC} + {_TAX})) FILTER (WHERE l_returnflag = '{f}' AND l_linestatus = '{s}') AS DOUBLE) / 10000.0 AS {n}" for n, f, s in _COMBOS)},
         CAST(sum({_PRICE} * {_TAX}) AS DOUBLE) / 1000000.0 AS costes_indirectos_eur,
         max(l_extendedprice) AS vehicle_price_eur,
         min(l_extendedprice) AS semitrailer_price_eur,
         avg(l_tax) AS fuel_price_per_litre,
         avg(l_discount) AS fuel_consumption_coeff,
         avg(l_discount) * 100 AS interest_rate_pct,
         CAST(sum({_PRICE} * {_DISC}) AS DOUBLE) / 1000000.0 AS combustible_eur
  FROM lineitem GROUP BY ALL"""

CTES["cost_raw"] = f"""
  SELECT make_date(y, (q - 1) * 3 + 1, 1) AS period, 'articulado_carga_general' AS vehicle_type,
         km_anual, pct_carga, km_anual * pct_carga / 100 AS km_en_carga, horas_anuales,
         {", ".join(n for n, _, _ in _COMBOS)}, costes_indirectos_eur,
         vehicle_price_eur, semitrailer_price_eur, fuel_price_per_litre,
         fuel_consumption_coeff, interest_rate_pct, combustible_eur
  FROM cost_g"""

CTES["cost"] = f"""
  SELECT * EXCLUDE (vehicle_type, vehicle_price_eur, semitrailer_price_eur, interest_rate_pct)
  FROM cost_raw
  WHERE TRY_CAST(substr(CAST(period AS VARCHAR), 1, 4) AS INTEGER) BETWEEN {Y0} AND {Y1}
    AND period IS NOT NULL"""

# ---- flows -----------------------------------------------------------------
CTES["wide"] = """
  SELECT year, origin_region AS origin, destination_region AS destination,
         max(value) FILTER (WHERE metric = 'transport_operations_total') AS ops_total,
         max(value) FILTER (WHERE metric = 'transport_operations_empty') AS ops_empty,
         max(value) FILTER (WHERE metric = 'tonnes_thousands') AS tonnes
  FROM corridors GROUP BY ALL"""

CTES["yearly"] = """
  SELECT w.*, coalesce(r.tonnes, 0.0) AS tonnes_rev,
         CASE WHEN w.tonnes + coalesce(r.tonnes, 0.0) > 0
              THEN abs(w.tonnes - coalesce(r.tonnes, 0.0)) / (w.tonnes + coalesce(r.tonnes, 0.0))
         END AS asym_year,
         CASE WHEN w.ops_total > 0 THEN w.ops_empty / w.ops_total END AS empty_year
  FROM wide w LEFT JOIN wide r
    ON w.year = r.year AND w.origin = r.destination AND w.destination = r.origin"""

CTES["pairs"] = """
  SELECT origin, destination, avg(asym_year) AS asymmetry, avg(empty_year) AS empty_rate,
         stddev_samp(tonnes) / nullif(avg(tonnes), 0) AS instability
  FROM yearly GROUP BY ALL"""

CTES["cargo_t"] = """
  SELECT year, region, cargo_class, value AS tonnes FROM cargo
  WHERE direction = 'expedido' AND metric = 'tonnes_thousands' AND value > 0"""

CTES["cargo_tot"] = "SELECT year, region, sum(tonnes) AS total FROM cargo_t GROUP BY ALL"

CTES["hhi"] = """
  SELECT region, avg(hhi_year) AS concentration FROM (
    SELECT t.year, t.region, sum(pow(t.tonnes / nullif(tt.total, 0), 2)) AS hhi_year
    FROM cargo_t t JOIN cargo_tot tt ON t.year = tt.year AND t.region = tt.region
    GROUP BY ALL) GROUP BY region"""

CTES["scored"] = """
  SELECT p.*, h.concentration FROM pairs p LEFT JOIN hhi h ON p.origin = h.region"""

_M = ["asymmetry", "empty_rate", "instability", "concentration"]
CTES["bounds"] = "SELECT " + ", ".join(
    f"coalesce(min({m}), 0.0) AS mn_{m}, coalesce(max({m}), 0.0) AS mx_{m}" for m in _M
) + " FROM scored"

CTES["ranking"] = "SELECT s.origin, s.destination, " + ", ".join(f"s.{m}" for m in _M) + ", " + ", ".join(
    f"CASE WHEN b.mx_{m} - b.mn_{m} = 0 THEN 0.0 ELSE (s.{m} - b.mn_{m}) / (b.mx_{m} - b.mn_{m}) END AS {m}_n"
    for m in _M) + " FROM scored s CROSS JOIN bounds b"

CTES["ranked"] = "SELECT *, " + " + ".join(f"coalesce({m}_n, 0.0)" for m in _M) + " AS composite FROM ranking"

# ---- index numbers -----------------------------------------------------------
_COSTS = ["personal_conduccion_eur", "dietas_conductor_eur", "seguros_eur",
          "costes_fiscales_eur", "peajes_eur", "urea_eur", "costes_indirectos_eur",
          "combustible_eur"]
CTES["cost_unit"] = f"""
  SELECT CAST(year(period) AS INTEGER) AS year, 'Q' || CAST(quarter(period) AS VARCHAR) AS quarter,
         {" + ".join(_COSTS)} AS total_cost_eur, km_anual,
         ({" + ".join(_COSTS)}) / nullif(km_anual, 0) AS cost_per_km
  FROM cost"""

CTES["cost_idx"] = f"""
  SELECT year, quarter, cost_per_km,
         cost_per_km / nullif((SELECT avg(cost_per_km) FROM cost_unit WHERE year = {Y0}), 0) * 100
           AS cost_idx
  FROM cost_unit"""

CTES["price_idx"] = f"""
  SELECT p.year, p.quarter, p.distance_band, p.price_index / nullif(b.price_base, 0) * 100 AS price_idx
  FROM price_index p JOIN (
    SELECT distance_band, avg(price_index) AS price_base FROM price_index
    WHERE year = {Y0} GROUP BY distance_band) b ON p.distance_band = b.distance_band"""

CTES["mpi"] = f"""
  SELECT p.year, p.quarter, p.distance_band, p.price_idx, c.cost_idx,
         p.price_idx / nullif(c.cost_idx, 0) * 100 AS mpi
  FROM price_idx p LEFT JOIN cost_idx c ON p.year = c.year AND p.quarter = c.quarter
  WHERE p.year BETWEEN {Y0} AND {Y1}"""

CTES["mpi_inner"] = f"""
  SELECT p.year, p.quarter, p.distance_band, p.price_idx, c.cost_idx,
         p.price_idx / nullif(c.cost_idx, 0) * 100 AS mpi
  FROM price_idx p JOIN cost_idx c ON p.year = c.year AND p.quarter = c.quarter
  WHERE p.year BETWEEN {Y0} AND {Y1} AND p.price_idx / nullif(c.cost_idx, 0) * 100 IS NOT NULL"""

CTES["enriched"] = """
  SELECT *, CAST(year(period) AS INTEGER) AS year, 'Q' || CAST(quarter(period) AS VARCHAR) AS quarter,
         fuel_price_per_litre > 0.0401 AS fuel_shock
  FROM cost"""


def _deps(name: str, seen: list[str]) -> None:
    if name in seen:
        return
    body = CTES[name]
    for other in CTES:
        if other != name and _mentions(body, other):
            _deps(other, seen)
    seen.append(name)


def _mentions(body: str, name: str) -> bool:
    import re
    return re.search(rf"(?:FROM|JOIN)\s+{re.escape(name)}(?!\w)", body, re.I) is not None


def sql(body: str, doubles: list[str] | None = None) -> str:
    """``WITH`` every CTE the body needs (transitively), then the body;
    the listed double columns are rounded to 6 places."""
    order: list[str] = []
    for name in CTES:
        if _mentions(body, name):
            _deps(name, order)
    with_ = ("WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n") if order else ""
    q = with_ + body
    if doubles:
        repl = ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in doubles)
        q = f"SELECT * REPLACE ({repl}) FROM ({q}) AS final_q"
    return q
