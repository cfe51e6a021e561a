"""Explicit schemas of the six panel tables and the re-aimed raw inputs.

Schemas are declared once and passed to every CSV read, so no inference job
runs and a stray sentinel cannot turn a numeric column into strings.
"""

from pyspark.sql.types import (BinaryType, DateType, DoubleType, IntegerType,
                               LongType, StringType, StructField, StructType,
                               TimestampNTZType)


def _st(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


CORRIDORS = _st(("year", IntegerType()), ("origin_region", StringType()),
                ("destination_region", StringType()), ("metric", StringType()),
                ("value", DoubleType()))

REGIONAL = _st(("year", IntegerType()), ("region", StringType()),
               ("displacement_type", StringType()), ("metric", StringType()),
               ("value", DoubleType()))

CARGO = _st(("year", IntegerType()), ("region", StringType()), ("direction", StringType()),
            ("cargo_class", StringType()), ("metric", StringType()), ("value", DoubleType()))

PRICE_INDEX = _st(("year", IntegerType()), ("quarter", StringType()),
                  ("distance_band", StringType()), ("price_index", DoubleType()))

DISTANCE_BANDS = _st(("year", IntegerType()), ("distance_band", StringType()),
                     ("service_type", StringType()), ("metric", StringType()),
                     ("value", DoubleType()))

# Cost model columns in output order (period and vehicle type first).
COST_MEASURES = [
    "km_anual", "pct_carga", "km_en_carga", "horas_anuales",
    "personal_conduccion_eur", "dietas_conductor_eur", "seguros_eur",
    "costes_fiscales_eur", "peajes_eur", "urea_eur", "costes_indirectos_eur",
    "vehicle_price_eur", "semitrailer_price_eur", "fuel_price_per_litre",
    "fuel_consumption_coeff", "interest_rate_pct", "combustible_eur",
]
COST = _st(("period", DateType()), ("vehicle_type", StringType()),
           *[(c, DoubleType()) for c in COST_MEASURES])

# Columns the cost cleaner removes.
COST_DROPPED = ["vehicle_type", "vehicle_price_eur", "semitrailer_price_eur", "interest_rate_pct"]

# The eight cost columns summed into the operating cost.
COST_COLUMNS = [
    "personal_conduccion_eur", "dietas_conductor_eur", "seguros_eur",
    "costes_fiscales_eur", "peajes_eur", "urea_eur",
    "costes_indirectos_eur", "combustible_eur",
]

CELLS = _st(("file", StringType()), ("sheet", StringType()), ("row", IntegerType()),
            ("col", IntegerType()), ("num", DoubleType()), ("text", StringType()))

RECORD_FILES = _st(("path", StringType()), ("content", BinaryType()))

SCHEMAS = {
    "corridors": CORRIDORS, "regional": REGIONAL, "cargo": CARGO,
    "price_index": PRICE_INDEX, "distance_bands": DISTANCE_BANDS, "cost": COST,
}


# The star-schema source tables. Declaring them skips the footer-reading
# schema-inference job that ``spark.read.parquet`` runs for every read.
_I, _L, _D, _S, _T = IntegerType(), LongType(), DoubleType(), StringType(), TimestampNTZType()
SOURCE_TABLES = {
    "region": _st(("r_regionkey", _I), ("r_name", _S)),
    "nation": _st(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "customer": _st(("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I), ("c_acctbal", _D),
                    ("c_mktsegment", _S)),
    "supplier": _st(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I), ("s_acctbal", _D)),
    "part": _st(("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S),
                ("p_size", _I), ("p_retailprice", _D)),
    "orders": _st(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S),
                  ("o_totalprice", _D), ("o_orderdate", _T), ("o_orderpriority", _S)),
    "lineitem": _st(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L),
                    ("l_linenumber", _I), ("l_quantity", _D), ("l_extendedprice", _D),
                    ("l_discount", _D), ("l_tax", _D), ("l_returnflag", _S),
                    ("l_linestatus", _S), ("l_shipdate", _T)),
}
