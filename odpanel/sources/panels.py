"""The six panel tables, derived from the driver's star schema.

The analysed application reads official spreadsheets; here the same long
tables are derived from ``lineitem`` and its dimensions so that every query's
work grows with the data:

* ``flow_cube``  lineitem ⋈ orders ⋈ customer ⋈ supplier ⋈ part aggregated to
  (order year, supplier nation, customer nation, part type). The join is the
  only large step; it ends in a partial (map-side) aggregate whose output is
  bounded by years × nations² × types, so the shuffle after it is tiny no
  matter how many lineitem rows or how skewed the keys are. Corridors,
  regional and cargo tables are all roll-ups of this cube.
* ``ship_cube`` lineitem ⋈ part aggregated to (ship year, quarter, size band,
  return flag, line status) for the price index and distance bands.
* ``cost_cube`` lineitem alone aggregated per ship quarter (no join).

Nation names are attached after aggregation. Money sums are exact: prices
and rates have two decimals, so each row contributes integer cents (or cents
x rate points), summed as integers in any partitioning order. Sums of cents
fit a long up to 6e11 rows; the products of ``cost_cube`` do not and are
summed in two halves that do (``exact_sum``). The rate averages are integer
sums over a count. The unit prices of ``ship_cube`` (price over quantity) are
not decimal and are summed as doubles: they agree to about 12 digits however
the rows are partitioned, not to the last bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odpanel.functions import safe_div
from odpanel.operators.cleaning import YEAR_MAX, YEAR_MIN
from odpanel.schemas import SCHEMAS
from odpanel.sources.tables import broadcast_if_small, checked_broadcast, read_table

# Fixed parameters of the derivation (see FIXTURES.md family B).
EMPTY_FLAG = "R"              # return flag counted as an empty run
VEHICLE_TYPE = "articulado_carga_general"
# The cargo class taxonomy of the derived panel (part types).
CARGO_CLASSES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
N_NATIONS_MAX = 1000          # bound for broadcasting the nation dimension


def cents(c) -> "F.Column":
    """A two-decimal amount as integer hundredths (exact, codegen'd rint)."""
    return F.rint(F.col(c) * 100).cast("long")


def exact_sum(c) -> "F.Column":
    """The exact integer sum of a long expression as a decimal: the high and
    the low 20 bits of the numbers are summed apart, so neither sum comes
    near 2^63 before 8e12 rows of any size."""
    high = F.sum(F.shiftright(c, 20)).cast("decimal(38,0)")
    low = F.sum(c.bitwiseAND(F.lit((1 << 20) - 1))).cast("decimal(20,0)")
    return high * F.lit(1 << 20).cast("decimal(8,0)") + low


def money(cents_sum, scale: float) -> "F.Column":
    """Exact integer sum back to a double amount: sum / scale."""
    return cents_sum.cast("double") / scale

# (return flag, line status) combination feeding each of the six cost columns.
COST_COMBOS = [
    ("personal_conduccion_eur", "A", "F"),
    ("dietas_conductor_eur", "A", "O"),
    ("seguros_eur", "N", "F"),
    ("costes_fiscales_eur", "N", "O"),
    ("peajes_eur", "R", "F"),
    ("urea_eur", "R", "O"),
]


def _date_window(col: str, years):
    """Filter on a raw date/timestamp column for an inclusive year window,
    written as a range on the column itself so it reaches the parquet scan
    (``PushedFilters``; row-group statistics prune at scale)."""
    if years is None:
        return F.lit(True)
    lo, hi = years
    c = F.col(col)
    return (c >= F.lit(f"{lo:04d}-01-01 00:00:00").cast("timestamp_ntz")) & (
        c < F.lit(f"{hi + 1:04d}-01-01 00:00:00").cast("timestamp_ntz"))


def _nations(spark, sf_dir):
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    return broadcast_if_small(n, N_NATIONS_MAX)


def flow_cube(spark: SparkSession, sf_dir: str, years=None, typed: bool = True,
              nations: DataFrame | None = None, pair=None) -> DataFrame:
    """(year, o_nk, d_nk[, p_type]) -> n_ops, n_empty, qty, price (cents),
    optionally restricted to an order-year window at the orders scan.
    ``pair`` (origin, destination) keeps the flows between two nations, by
    semi-joins of suppliers and customers before the large join.
    ``typed=False`` leaves out the part join (a full shuffle of lineitem by
    part key at scale) for panels that do not need the part type."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
                     "l_extendedprice", "l_returnflag"])
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"]
                        ).where(_date_window("o_orderdate", years))
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    supp = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_type"])
    nat = nations if nations is not None else _nations(spark, sf_dir)
    if pair:
        supp, cust = (x.join(nat.where(F.col("n_name") == name), x[key] == F.col("n_nationkey"),
                             "left_semi")
                      for x, key, name in ((supp, "s_nationkey", pair[0]),
                                           (cust, "c_nationkey", pair[1])))
    # orders ⋈ customer first: both are smaller than lineitem, and the result
    # carries only (orderkey, year, customer nation) into the big join.
    oc = (orders.join(cust, orders.o_custkey == cust.c_custkey)
          .select("o_orderkey", F.year("o_orderdate").alias("year"),
                  F.col("c_nationkey").alias("d_nk")))
    # no hint: AQE turns the merge join into a hash join only where every
    # build partition fits its bound (session.DEFAULT_CONF)
    j = (li.join(oc, li.l_orderkey == oc.o_orderkey)
         .join(supp, li.l_suppkey == supp.s_suppkey))
    keys = ["year", F.col("s_nationkey").alias("o_nk"), "d_nk"]
    if typed:
        j = j.join(part, li.l_partkey == part.p_partkey)
        keys.append("p_type")
    g = j.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_ops"),
        F.count_if(F.col("l_returnflag") == EMPTY_FLAG).alias("n_empty"),
        F.sum("l_quantity").alias("qty"),
        F.sum(cents("l_extendedprice")).alias("price"))
    # names and region keys after the aggregate: the cube is small and the
    # checkpointed result needs no further dimension joins downstream
    o = nat.select(F.col("n_nationkey").alias("o_nk"), F.col("n_name").alias("o_name"),
                   F.col("n_regionkey").alias("o_rk"))
    d = nat.select(F.col("n_nationkey").alias("d_nk"), F.col("n_name").alias("d_name"),
                   F.col("n_regionkey").alias("d_rk"))
    return g.join(o, "o_nk").join(d, "d_nk")


def _pair_flows(src):
    """flow_cube rolled up to (year, o, d) with nation names and regions
    (a no-op roll-up on the untyped cube)."""
    return src.flow_cube().groupBy("year", "o_nk", "d_nk", "o_name", "d_name", "o_rk", "d_rk").agg(
        F.sum("n_ops").alias("n_ops"), F.sum("n_empty").alias("n_empty"),
        F.sum("qty").alias("qty"), F.sum("price").alias("price"))


def _flow_metrics(df):
    """The four flow measures of an aggregated group, as doubles."""
    return {
        "ops_total": F.col("n_ops").cast("double"),
        "ops_empty": F.col("n_empty").cast("double"),
        "tonnes": F.col("qty"),
        "tonne_km": money(F.col("price"), 100000.0),
    }


def corridors_raw(src: "PanelSource") -> DataFrame:
    """corridors long table: (year, origin_region, destination_region, metric, value).

    Diagonal pairs and all years stay, for the cleaner to remove.
    """
    f = _pair_flows(src)
    m = _flow_metrics(f)
    wide = f.select(
        "year", F.col("o_name").alias("origin_region"), F.col("d_name").alias("destination_region"),
        m["ops_total"].alias("transport_operations_total"),
        m["ops_empty"].alias("transport_operations_empty"),
        m["tonnes"].alias("tonnes_thousands"),
        m["tonne_km"].alias("tonne_km_millions"))
    return wide.unpivot(["year", "origin_region", "destination_region"],
                        ["transport_operations_total", "transport_operations_empty",
                         "tonnes_thousands", "tonne_km_millions"], "metric", "value")


def regional_raw(src: "PanelSource") -> DataFrame:
    """regional long table: (year, region, displacement_type, metric, value).

    A flow within one nation is intrarregional; between nations of the same
    region key it is interregional, otherwise internacional; expedido is
    counted at the origin, recibido at the destination.
    """
    f = _pair_flows(src)
    kind = (F.when(F.col("o_rk") == F.col("d_rk"), F.lit("interregional"))
            .otherwise(F.lit("internacional")))
    intra = F.col("o_nk") == F.col("d_nk")
    sides = F.array(
        F.struct(F.col("o_name").alias("region"),
                 F.when(intra, F.lit("intrarregional_total"))
                  .otherwise(F.concat(kind, F.lit("_expedido"))).alias("displacement_type")),
        F.struct(F.col("d_name").alias("region"),
                 F.when(~intra, F.concat(kind, F.lit("_recibido"))).alias("displacement_type")))
    x = (f.select("year", "n_ops", "n_empty", "qty", "price", F.explode(sides).alias("s"))
         .where(F.col("s.displacement_type").isNotNull())
         .groupBy("year", F.col("s.region").alias("region"),
                  F.col("s.displacement_type").alias("displacement_type"))
         .agg(F.sum("n_ops").alias("n_ops"), F.sum("n_empty").alias("n_empty"),
              F.sum("qty").alias("qty"), F.sum("price").alias("price")))
    m = _flow_metrics(x)
    wide = x.select("year", "region", "displacement_type",
                    m["ops_total"].alias("operations_total"),
                    m["ops_empty"].alias("operations_empty"),
                    m["tonnes"].alias("tonnes_thousands"),
                    m["tonne_km"].alias("tonne_km_millions"))
    return wide.unpivot(["year", "region", "displacement_type"],
                        ["operations_total", "operations_empty", "tonnes_thousands",
                         "tonne_km_millions"], "metric", "value")


def cargo_raw(src: "PanelSource") -> DataFrame:
    """cargo long table: (year, region, direction, cargo_class, metric, value).

    Inter-nation flows by part type, expedido at the origin and recibido at
    the destination; plus per-(year, direction, class) TOTAL rows with a NULL
    region.
    """
    c = src.flow_cube().where(F.col("o_nk") != F.col("d_nk"))
    sides = F.array(F.struct(F.col("o_name").alias("region"), F.lit("expedido").alias("direction")),
                     F.struct(F.col("d_name").alias("region"), F.lit("recibido").alias("direction")))
    g = (c.select("year", "p_type", "n_ops", "qty", F.explode(sides).alias("s"))
         .groupBy("year", F.col("s.region").alias("region"),
                  F.col("s.direction").alias("direction"), F.col("p_type").alias("cargo_class"))
         .agg(F.sum("n_ops").alias("n_ops"), F.sum("qty").alias("qty")))
    per_region = g.select(
        "year", "region", "direction", "cargo_class",
        F.col("n_ops").cast("double").alias("operations"),
        F.col("qty").alias("tonnes_thousands"))
    totals = g.groupBy("year", "direction", "cargo_class").agg(
        F.sum("n_ops").cast("double").alias("operations"),
        F.sum("qty").alias("tonnes_thousands")).select(
        "year", F.lit(None).cast("string").alias("region"), "direction", "cargo_class",
        "operations", "tonnes_thousands")
    return per_region.unionByName(totals).unpivot(
        ["year", "region", "direction", "cargo_class"],
        ["operations", "tonnes_thousands"], "metric", "value")


def _band_label(band_no):
    return F.concat(F.lit("band_"), band_no.cast("string"))


def ship_cube(spark: SparkSession, sf_dir: str, years=None) -> DataFrame:
    """(year, q, band_no, status) measures of lineitem ⋈ part by ship date,
    optionally restricted to a ship-year window at the lineitem scan."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_partkey", "l_quantity", "l_extendedprice", "l_linestatus", "l_shipdate"]
                    ).where(_date_window("l_shipdate", years))
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_size"])
    j = li.join(part, li.l_partkey == part.p_partkey)
    return j.groupBy(
        F.year("l_shipdate").alias("year"), F.quarter("l_shipdate").alias("q"),
        F.ceil(F.col("p_size") / 10).cast("int").alias("band_no"), "l_linestatus",
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("l_quantity").alias("qty"),
        F.sum(cents("l_extendedprice")).alias("price"),
        F.sum(safe_div("l_extendedprice", "l_quantity")).alias("unit_sum"))


def price_index_raw(src: "PanelSource") -> DataFrame:
    """price_index: (year, quarter, distance_band, price_index); price index =
    mean unit price per size band, plus a ``Total`` band mixed in."""
    c = src.ship_cube()
    bands = F.array(_band_label(F.col("band_no")), F.lit("Total"))
    g = (c.select("year", "q", "n", "unit_sum", F.explode(bands).alias("distance_band"))
         .groupBy("year", "q", "distance_band")
         .agg(F.sum("unit_sum").alias("unit_sum"), F.sum("n").alias("n")))
    return g.select("year", F.concat(F.lit("Q"), F.col("q").cast("string")).alias("quarter"),
                    "distance_band", safe_div("unit_sum", "n").alias("price_index"))


def distance_bands_raw(src: "PanelSource") -> DataFrame:
    """distance_bands: (year, distance_band, service_type, metric, value) with
    the band total and the service split (F -> cuenta_ajena, O -> cuenta_propia)."""
    c = src.ship_cube()
    svc = F.when(F.col("l_linestatus") == "F", F.lit("cuenta_ajena")).when(
        F.col("l_linestatus") == "O", F.lit("cuenta_propia"))
    keys = F.array(*[F.struct(b.alias("distance_band"), s.alias("service_type"))
                     for b in (_band_label(F.col("band_no")), F.lit("Total"))
                     for s in (F.lit("total"), svc)])
    g = (c.select("year", "n", "qty", "price", F.explode(keys).alias("k"))
         .where(F.col("k.service_type").isNotNull())
         .groupBy("year", F.col("k.distance_band").alias("distance_band"),
                  F.col("k.service_type").alias("service_type"))
         .agg(F.sum("n").alias("n"), F.sum("qty").alias("qty"), F.sum("price").alias("price")))
    wide = g.select("year", "distance_band", "service_type",
                    F.col("n").cast("double").alias("operations_total"),
                    F.col("qty").alias("tonnes_thousands"),
                    money(F.col("price"), 100000.0).alias("tonne_km_millions"))
    return wide.unpivot(["year", "distance_band", "service_type"],
                        ["operations_total", "tonnes_thousands", "tonne_km_millions"],
                        "metric", "value")


def cost_cube(spark: SparkSession, sf_dir: str, years=None) -> DataFrame:
    """Per ship (year, quarter): the cost-model measures. One scan of lineitem
    (optionally restricted to a ship-year window) and one partial aggregate,
    no join."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_quantity", "l_extendedprice", "l_discount", "l_tax",
                     "l_returnflag", "l_linestatus", "l_shipdate"]
                    ).where(_date_window("l_shipdate", years))
    price, disc, tax = cents("l_extendedprice"), cents("l_discount"), cents("l_tax")
    combo_sums = [
        money(exact_sum(F.when((F.col("l_returnflag") == fl) & (F.col("l_linestatus") == st),
                               price * (disc + tax))), 10000.0).alias(name)
        for name, fl, st in COST_COMBOS]
    g = li.groupBy(F.year("l_shipdate").alias("y"), F.quarter("l_shipdate").alias("q")).agg(
        F.sum("l_quantity").alias("km_anual"),
        (F.count_if(F.col("l_linestatus") == "F") * 100.0 / F.count(F.lit(1))).alias("pct_carga"),
        F.count(F.lit(1)).cast("double").alias("horas_anuales"),
        *combo_sums,
        money(exact_sum(price * tax), 1000000.0).alias("costes_indirectos_eur"),
        F.max("l_extendedprice").alias("vehicle_price_eur"),
        F.min("l_extendedprice").alias("semitrailer_price_eur"),
        (F.sum(tax) / F.count(tax) / 100).alias("fuel_price_per_litre"),
        (F.sum(disc) / F.count(disc) / 100).alias("fuel_consumption_coeff"),
        (F.sum(disc) / F.count(disc)).alias("interest_rate_pct"),
        money(exact_sum(price * disc), 1000000.0).alias("combustible_eur"))
    return g


def cost_raw(src: "PanelSource") -> DataFrame:
    """cost model per ship quarter (period = first day of the quarter)."""
    g = src.cost_cube()
    return g.select(
        F.make_date("y", (F.col("q") - 1) * 3 + 1, F.lit(1)).alias("period"),
        F.lit(VEHICLE_TYPE).alias("vehicle_type"),
        "km_anual", "pct_carga",
        (F.col("km_anual") * F.col("pct_carga") / 100).alias("km_en_carga"),
        "horas_anuales", *[n for n, _, _ in COST_COMBOS], "costes_indirectos_eur",
        "vehicle_price_eur", "semitrailer_price_eur", "fuel_price_per_litre",
        "fuel_consumption_coeff", "interest_rate_pct", "combustible_eur")


RAW = {
    "corridors": corridors_raw, "regional": regional_raw, "cargo": cargo_raw,
    "price_index": price_index_raw, "distance_bands": distance_bands_raw, "cost": cost_raw,
}


class PanelSource:
    """The panels of one source directory, sharing their aggregate cubes.

    Each cube is computed once and checkpointed (reliable checkpoint in the
    session's shared checkpoint folder): the large join and scan run once
    per cube however many panels, branches or subqueries read it, and the
    lineage below the cube is cut, so a lost executor never re-runs the big
    join. The cubes are bounded by their key domains (years, quarters,
    nations, part types, bands), not by the number of lineitem rows.

    ``clean(name)`` builds its cube only over the cleaner's year window (the
    window becomes a date-range filter on the orders / lineitem scan); every
    cleaned row comes from cube rows of its own year, so the result is the
    same as cleaning the full panel. ``raw(name)`` uses the full cube.
    """

    # cube and year window each cleaned panel needs (None: all years)
    # panels that need the part type (the typed flow cube)
    TYPED = {"cargo"}
    CLEAN_WINDOWS = {
        "corridors": ("flow", (YEAR_MIN, YEAR_MAX)), "regional": ("flow", (YEAR_MIN, YEAR_MAX)),
        "cargo": ("flow", (YEAR_MIN, YEAR_MAX)), "price_index": ("ship", (YEAR_MIN, YEAR_MAX)),
        "distance_bands": ("ship", None), "cost": ("cost", (YEAR_MIN, YEAR_MAX)),
    }
    BUILDERS = {"flow": flow_cube, "ship": ship_cube, "cost": cost_cube}

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True,
                 location: str | None = None):
        """``location``: read the raw panels stored there by ``write_panels``
        instead of deriving them. ``materialize=False`` runs no job."""
        self.spark, self.sf_dir, self.materialize = spark, sf_dir, materialize
        self.location = location
        self._cubes: dict = {}
        self._nations = None
        self._pair = None     # nations of the flows being derived (None: all)
        self._window = None   # year window of the panel being derived
        self._typed = False   # the panel being derived needs the typed flow cube
        self.typed_flows = False  # set by queries that read cargo and other flow panels

    def _cube(self, name):
        kw = {}
        if name == "flow":
            kw["typed"] = self._typed or self.typed_flows
            kw["pair"] = self._pair
        key = (name, self._window, kw.get("typed"), *([self._pair] if self._pair else []))
        if name == "flow" and key not in self._cubes:
            kw["nations"] = self.nations()   # already size-checked once
        if key not in self._cubes:
            df = self.BUILDERS[name](self.spark, self.sf_dir, years=self._window, **kw)
            if self.materialize:
                from odpanel.session import ensure_checkpoint_dir
                ensure_checkpoint_dir(self.spark)
                df = df.checkpoint(eager=True)
            self._cubes[key] = df
        return self._cubes[key]

    def flow_cube(self) -> DataFrame:
        return self._cube("flow")

    def ship_cube(self) -> DataFrame:
        return self._cube("ship")

    def cost_cube(self) -> DataFrame:
        return self._cube("cost")

    def nations(self) -> DataFrame:
        if self._nations is None:
            n = read_table(self.spark, self.sf_dir, "nation",
                           ["n_nationkey", "n_name", "n_regionkey"])
            self._nations = checked_broadcast(n, N_NATIONS_MAX)[0] if self.materialize else n
        return self._nations

    def nation_span(self) -> int:
        """Places a grid keeps for the nations: the largest key plus one."""
        return self.nations().agg(F.max("n_nationkey")).first()[0] + 1

    def _panel(self, name: str) -> DataFrame:
        if self.location:
            return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.location}/{name}")
        self._typed = name in self.TYPED
        try:
            return RAW[name](self)
        finally:
            self._typed = False

    def raw(self, name: str) -> DataFrame:
        self._window = None
        return self._panel(name)

    def clean(self, name: str, years=None, pair=None) -> DataFrame:
        """The cleaned panel. ``years`` narrows the year window and ``pair``
        (origin, destination nation) the flows before the cube is built."""
        from odpanel.operators.cleaning import CLEANERS
        self._window, self._pair = years or self.CLEAN_WINDOWS[name][1], pair
        try:
            return CLEANERS[name](self._panel(name))
        finally:
            self._window, self._pair = None, None


def write_panels(src: PanelSource, location: str) -> None:
    """Store the six raw panels once as parquet under ``location``, for
    ``PanelSource(..., location=...)`` to read many times."""
    src.typed_flows = True
    for name in RAW:
        src.raw(name).write.mode("overwrite").parquet(f"{location}/{name}")
