"""The query catalogue: one callable (spark, sf_dir) -> DataFrame per key.

Every query reads the driver's tables (through the derived panels), so its
work grows with them. Doubles are rounded to 6 places in the final
projection only, as the DuckDB oracle does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from odpanel.operators import cleaning, flows, index, normalize
from odpanel.plans import ranking
from odpanel.sources import panels
from odpanel.operators import grid as G
from odpanel.operators import (bitmaps, frequent, profile, quality, scan, sketches,
                               variants)
from odpanel.operators.records import extract_records, record_quality
from odpanel.schemas import CORRIDORS
from odpanel.session import shared_dir
from odpanel.sources import files, records, stores
from odpanel.sources import grid as GS
from odpanel.sources.tables import read_table
from odpanel.sources.text_cells import line_cells, text_records

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def finalize(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round double columns for comparison; ``+ 0.0`` turns -0.0 into 0.0."""
    return df.select(*[
        ((F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name)
         if isinstance(f.dataType, DoubleType) else F.col(f.name))
        for f in df.schema.fields])


def query(name: str):
    """Register ``fn(spark, src)``; the catalogue callable takes (spark, sf_dir)
    and gives ``fn`` one PanelSource, so all panels of a query share cubes."""
    def deco(fn):
        def run(spark, sf_dir, _fn=fn):
            return finalize(_fn(spark, panels.PanelSource(spark, sf_dir)))
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def raw(spark, src, name):
    return src.raw(name)


def clean(spark, src, name):
    return src.clean(name)


# ---- cleaning ----------------------------------------------------------------
for _name, _key in [("corridors", "clean_corridors"), ("regional", "clean_regional"),
                    ("cargo", "clean_cargo"), ("price_index", "clean_price"),
                    ("distance_bands", "clean_bands"), ("cost", "clean_cost")]:
    query(_key)(lambda spark, d, _n=_name: clean(spark, d, _n))


@query("table_summary")
def q_table_summary(spark, d):
    """Raw and cleaned row counts and cleaned column count of the six panels."""
    d.typed_flows = True
    return cleaning.table_summary({n: raw(spark, d, n) for n in panels.RAW})


# ---- flows -------------------------------------------------------------------
@query("wide_flows")
def q_wide_flows(spark, d):
    return flows.wide_flows(clean(spark, d, "corridors"))


@query("flow_asymmetry")
def q_flow_asymmetry(spark, d):
    return flows.pair_metrics(clean(spark, d, "corridors")).select(
        "origin", "destination", "asymmetry")


@query("empty_rate")
def q_empty_rate(spark, d):
    return flows.pair_metrics(clean(spark, d, "corridors")).select(
        "origin", "destination", "empty_rate")


@query("flow_instability")
def q_flow_instability(spark, d):
    return flows.pair_metrics(clean(spark, d, "corridors")).select(
        "origin", "destination", "instability")


@query("hhi_by_origin")
def q_hhi(spark, d):
    return flows.hhi_by_origin(clean(spark, d, "cargo"))


@query("cargo_shares")
def q_cargo_shares(spark, d):
    return flows.cargo_shares(clean(spark, d, "cargo"))


def _scores(spark, d):
    d.typed_flows = True
    return flows.corridor_scores(clean(spark, d, "corridors"), clean(spark, d, "cargo"))


@query("minmax_norm")
def q_minmax(spark, d):
    return normalize.min_max(_stored(_scores(spark, d)), ranking.METRICS)


@query("zscore_norm")
def q_zscore(spark, d):
    return normalize.z_score(_stored(_scores(spark, d)), ranking.METRICS).select(
        "origin", "destination", *[m + "_z" for m in ranking.METRICS])


def _ranking(spark, d):
    d.typed_flows = True
    return ranking.corridor_ranking(clean(spark, d, "corridors"), clean(spark, d, "cargo"))


@query("corridor_ranking")
def q_ranking(spark, d):
    """Flagship: the four metrics, normalized, composite, sorted."""
    return _ranking(spark, d)


@query("sql_top_corridors")
def q_sql_top(spark, d):
    return ranking.top_corridors(spark, _ranking(spark, d), 20)


# ---- index numbers -------------------------------------------------------------
@query("period_split")
def q_period_split(spark, d):
    return index.period_split(clean(spark, d, "cost")).select("period", "year", "quarter")


@query("cost_per_unit")
def q_cost_per_unit(spark, d):
    return index.cost_per_unit(clean(spark, d, "cost"))


@query("derived_cost")
def q_derived_cost(spark, d):
    return index.derived_cost(raw(spark, d, "cost"))


@query("rebase_cost")
def q_rebase_cost(spark, d):
    return index.rebase_cost(clean(spark, d, "cost"))


@query("rebase_price")
def q_rebase_price(spark, d):
    return index.rebase_price(clean(spark, d, "price_index"))


def _mpi(spark, d, gaps="keep"):
    return index.margin_index(clean(spark, d, "price_index"), clean(spark, d, "cost"), gaps=gaps)


@query("margin_index")
def q_margin_index(spark, d):
    return _mpi(spark, d)


@query("margin_index_dropgaps")
def q_margin_index_drop(spark, d):
    return _mpi(spark, d, gaps="drop")


@query("margin_summary")
def q_margin_summary(spark, d):
    return index.margin_summary(_mpi(spark, d))


@query("sql_avg_index")
def q_sql_avg_index(spark, d):
    return spark.sql("SELECT distance_band, round(avg(mpi), 2) AS avg_mpi FROM {mpi} "
                     "GROUP BY distance_band ORDER BY avg_mpi, distance_band", mpi=_mpi(spark, d))


@query("shock_flag")
def q_shock_flag(spark, d):
    return index.shock_flag(clean(spark, d, "cost")).select(
        "period", "year", "quarter", "fuel_price_per_litre", "fuel_shock")


@query("shock_counts")
def q_shock_counts(spark, d):
    return index.shock_counts(index.shock_flag(clean(spark, d, "cost")))


# ---- profiling -------------------------------------------------------------------

FREQ_COLUMNS = [("corridors", "metric"), ("regional", "displacement_type"),
                ("cargo", "cargo_class"), ("price_index", "distance_band"),
                ("distance_bands", "distance_band")]
DISTINCT_COLUMNS = {
    "corridors": ["year", "origin_region", "destination_region", "metric"],
    "regional": ["region", "displacement_type", "metric"],
    "cargo": ["cargo_class", "direction", "region"],
    "price_index": ["year", "quarter", "distance_band"],
    "distance_bands": ["distance_band", "service_type", "metric"],
    "cost": ["period", "vehicle_type"],
}
NUMERIC_COLUMNS = {
    "corridors": ["value"], "regional": ["value"], "cargo": ["value"],
    "price_index": ["price_index"], "distance_bands": ["value"],
    "cost": ["fuel_price_per_litre", "personal_conduccion_eur", "dietas_conductor_eur",
             "seguros_eur", "costes_fiscales_eur", "combustible_eur"],
}
# Blank texts of the null/blank counts: the corridors profile also treats the
# suppression mark ".." as blank, the other tables only the empty string.
BLANKS = {"corridors": ("", ".."), "regional": ("",), "cargo": ("",), "price_index": ("",),
          "distance_bands": ("",), "cost": ("",)}
STATS_COLUMNS = [("cost", "fuel_price_per_litre"), ("cost", "combustible_eur"),
                 ("cost", "personal_conduccion_eur"), ("cost", "peajes_eur"),
                 ("price_index", "price_index"), ("corridors", "value")]


def _stats_source(spark, d, dataset):
    df = clean(spark, d, dataset)
    if dataset == "corridors":
        df = df.where(F.col("metric") == flows.OPS_TOTAL)
    return df


@query("value_counts")
def q_value_counts(spark, d):
    """Frequencies of one key column per panel, most frequent first."""
    d.typed_flows = True
    return profile.value_counts({ds: raw(spark, d, ds) for ds, _ in FREQ_COLUMNS}, FREQ_COLUMNS)


@query("year_counts")
def q_year_counts(spark, d):
    return profile.year_counts(raw(spark, d, "cost"), "period")


@query("distinct_values")
def q_distinct_values(spark, d):
    d.typed_flows = True
    return profile.distinct_values({ds: raw(spark, d, ds) for ds in DISTINCT_COLUMNS},
                                   DISTINCT_COLUMNS)


@query("profile_nulls")
def q_profile_nulls(spark, d):
    d.typed_flows = True
    return profile.profile_nulls({ds: raw(spark, d, ds) for ds in panels.RAW}, blanks=BLANKS)


@query("profile_distinct")
def q_profile_distinct(spark, d):
    d.typed_flows = True
    return profile.profile_distinct(
        {ds: raw(spark, d, ds) for ds in ("corridors", "regional", "cargo")})


@query("profile_numeric")
def q_profile_numeric(spark, d):
    d.typed_flows = True
    return profile.profile_numeric({ds: raw(spark, d, ds) for ds in NUMERIC_COLUMNS},
                                   NUMERIC_COLUMNS)


@query("profile_summary")
def q_profile_summary(spark, d):
    d.typed_flows = True
    return profile.profile_tables({ds: raw(spark, d, ds) for ds in panels.RAW}, blanks=BLANKS)


@query("profile_summary_clean")
def q_profile_summary_clean(spark, d):
    """The same profile over the cleaned panels (the cleaned cost table has
    four columns fewer: only present columns are profiled)."""
    d.typed_flows = True
    return profile.profile_tables({ds: clean(spark, d, ds) for ds in panels.RAW}, blanks=BLANKS)


@query("stats_mmm")
def q_stats_mmm(spark, d):
    vals = profile.union_all(
        _stats_source(spark, d, ds).select(F.lit(ds).alias("dataset"),
                                           F.lit(c).alias("column_name"),
                                           F.col(c).cast("double").alias("v"))
        for ds, c in STATS_COLUMNS)
    return profile.describe_values(vals, ["dataset", "column_name"])


@query("stats_stddev")
def q_stats_stddev(spark, d):
    return clean(spark, d, "cost").agg(F.stddev_samp("combustible_eur").alias("stddev")).select(
        F.lit("cost").alias("dataset"), F.lit("combustible_eur").alias("column_name"), "stddev")


@query("describe_table")
def q_describe(spark, d):
    plain = panels.PanelSource(spark, d.sf_dir, materialize=False)   # only its schema is read
    return profile.describe_table(spark, plain.clean("corridors"))


# ---- data quality -----------------------------------------------------------------
@query("dq_taxonomy")
def q_dq_taxonomy(spark, d):
    return quality.taxonomy_check(clean(spark, d, "cargo"), panels.CARGO_CLASSES)


@query("dq_band_share")
def q_dq_band_share(spark, d):
    return quality.band_share(clean(spark, d, "distance_bands"))


@query("dq_density")
def q_dq_density(spark, d):
    return quality.density(clean(spark, d, "corridors"), "corridors", "year", "metric").unionByName(
        quality.density(clean(spark, d, "price_index"), "price_index", "year"))


@query("dq_spot")
def q_dq_spot(spark, d):
    pair = ("NATION_1", "NATION_2")
    return quality.spot(d.clean("corridors", years=(2000, 2000), pair=pair), year=2000,
                        origin_region=pair[0], destination_region=pair[1],
                        metric=flows.OPS_TOTAL)


@query("dq_trend")
def q_dq_trend(spark, d):
    return quality.trend(clean(spark, d, "cost"), "fuel_price_per_litre")


# ---- sources, sinks, records ---------------------------------------------------------


def _record_files(spark, d):
    root = shared_dir(spark, "records")
    records.write_records(raw(spark, d, "cost"), root)
    return files.read_records(spark, root, "*.txt")


@query("obs_extract")
def q_obs_extract(spark, d):
    """Cost rows written as fixed-line record files, read back and extracted."""
    return extract_records(_record_files(spark, d))


@query("obs_quality")
def q_obs_quality(spark, d):
    """Counts of the record extraction: files, short records, unparsable fields."""
    return record_quality(_record_files(spark, d))


@query("csv_roundtrip")
def q_csv_roundtrip(spark, d):
    """Cleaned corridors written as header CSV to shared storage, read back
    with the explicit schema."""
    path = shared_dir(spark, "csv_roundtrip")
    files.write_csv(clean(spark, d, "corridors"), path)
    return files.read_csv(spark, path, CORRIDORS)


@query("files_by_year")
def q_files_by_year(spark, d):
    """One folder per year (name carries the year, file has no year column),
    read back as one scan with the year taken from the path."""
    path = shared_dir(spark, "files_by_year")
    c = clean(spark, d, "corridors")
    c.write.mode("overwrite").option("header", True).partitionBy("year").csv(path)
    no_year = StructType([f for f in CORRIDORS.fields if f.name != "year"])
    return files.read_by_year(spark, path, no_year, r"year=(\d{4})")


@query("scan_table")
def q_scan_table(spark, d):
    """Cleaned price panel stored as parquet in shared storage, then scanned."""
    path = shared_dir(spark, "scan_table")
    files.write_parquet(clean(spark, d, "price_index"), path)
    return spark.read.parquet(path)


@query("proj_alias")
def q_proj_alias(spark, d):
    o = read_table(spark, d.sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    return o.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                    F.year("o_orderdate").alias("order_year"))


# ---- grids --------------------------------------------------------------------------


def _stored(df: DataFrame) -> DataFrame:
    """Materialize a derived input once (reliable checkpoint in the shared
    checkpoint folder), as the stored workbooks would be: every branch that
    reads it scans the checkpoint instead of re-deriving it."""
    from odpanel.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _n_regions(src) -> int:
    """Rows and columns a grid keeps for the nations."""
    return src.nation_span()


@query("clean_cells")
def q_clean_cells(spark, d):
    return G.cell_values(_stored(GS.corridor_cells(d, _n_regions(d))))


@query("normalize_labels")
def q_normalize_labels(spark, d):
    from odpanel.functions import normalize_label
    cells = _stored(GS.regional_cells(d, _n_regions(d)))
    return cells.where(F.col("col") == 0).select(
        "file", "sheet", "row", F.col("text").alias("raw_label"),
        normalize_label(F.col("text")).alias("label"))


@query("unpivot_labels")
def q_unpivot_labels(spark, d):
    p = _stored(raw(spark, d, "price_index"))
    cols = {f"b{i}": b for i, b in enumerate(GS.bands_of(p))}
    wide = p.groupBy("year", "quarter").agg(
        *[F.max(F.when(F.col("distance_band") == b, F.col("price_index"))).alias(c)
          for c, b in cols.items()])
    return G.unpivot_labeled(wide, ["year", "quarter"], cols, "distance_band", "price_index")


@query("od_matrix_long")
def q_od_matrix_long(spark, d):
    n = _n_regions(d)
    split = GS.matrix_split(n)
    sheets = {code: (code + "s", m) for m, code in GS.CORRIDOR_SHEETS.items()}
    m = G.od_matrix(_stored(GS.corridor_cells(d, n)), sheets, GS.MATRIX_FIRST_ROW, n,
                    range(1, split + 1), range(0, n - split))
    labels = d.nations().select(F.col("n_nationkey").alias("idx"), F.col("n_name").alias("name"))
    return G.od_long(m, labels, GS.EXCLUDED_REGIONS)


@query("price_from_grid")
def q_price_from_grid(spark, d):
    panel = _stored(raw(spark, d, "price_index"))
    bands, editions = GS.bands_of(panel), GS.editions_of(GS.years_of(panel))
    cells = _stored(GS.price_cells(panel, bands, editions))
    cols = {i + 2: b for i, b in enumerate(bands)}
    (a, first, _, _), (b, middle, last, _) = editions
    # the first edition up to the year the second begins with, then the second
    parts = [(a, first, middle - 1), (b, middle, last)]
    return profile.union_all(
        G.quarterly_panel(cells.where(F.col("file") == f), GS.PRICE_SHEET, GS.PRICE_FIRST_ROW,
                          GS.QUARTER_LABELS, cols, lo, hi) for f, lo, hi in parts)


@query("regional_from_grid")
def q_regional_from_grid(spark, d):
    n = _n_regions(d)
    sheets = {code: m for m, code in GS.REGIONAL_SHEETS.items()}
    cols = {c: t for t, c in GS.DISPLACEMENT_COLS.items()}
    return G.labeled_rows(_stored(GS.regional_cells(d, n)), sheets, GS.REGIONAL_FIRST_ROW,
                          GS.REGIONAL_FIRST_ROW + n + 1, cols)


@query("bands_from_grid")
def q_bands_from_grid(spark, d):
    sheets = {code: m for m, code in GS.BAND_SHEETS.items()}
    panel = _stored(raw(spark, d, "distance_bands"))
    bands, years = GS.bands_of(panel), GS.years_of(panel)
    sections = GS.sections_of(years)
    cells = _stored(GS.bands_cells(panel, bands, sections, years[0]))
    return G.sectioned_rows(cells, sheets, sections, {i + 1: b for i, b in enumerate(bands)},
                            *years)


def _cargo_blocks(d):
    classes = GS.classes_of(d.raw("cargo"))
    cells = _stored(GS.cargo_cells(d, _n_regions(d), *classes))
    return cells, classes, G.find_blocks(cells, GS.BLOCK_FIRST_ROW, GS.BLOCK_MARKER,
                                         sheets=GS.cargo_block_sheets())


@query("block_detect")
def q_block_detect(spark, d):
    return _cargo_blocks(d)[2]


@query("block_extract")
def q_block_extract(spark, d):
    cells, (left, right), blocks = _cargo_blocks(d)
    metrics = {p: m for m, p in GS.CARGO_PREFIXES.items()}
    return G.block_table(cells, blocks, GS.BLOCK_OFFSETS,
                         {c: k for k, c in left.items()}, {c: k for k, c in right.items()},
                         metrics)


# ---- grids and records of the given texts ---------------------------------------------
@query("document_cells")
def q_document_cells(spark, d):
    """The documents as grids, words and table cells being columns: rows,
    cells, widest row, numeric cells and the largest value of each."""
    cells = line_cells(read_table(spark, d.sf_dir, "documents", ["doc_id", "source", "text"]),
                       "doc_id", "source", "text", "[| ]+")
    return G.cell_values(cells).groupBy("file", "sheet").agg(
        (F.max("row") + 1).alias("n_rows"), F.count(F.lit(1)).alias("n_cells"),
        (F.max("col") + 1).alias("n_cols"), F.count("value").alias("n_values"),
        F.max("value").alias("max_value"))


@query("document_blocks")
def q_document_blocks(spark, d):
    """Block headers in the documents: the lines that stand right above a line
    which names a license. Documents without id or source are not joined."""
    cells = line_cells(read_table(spark, d.sf_dir, "documents", ["doc_id", "source", "text"]),
                       "doc_id", "source", "text")
    return G.find_blocks(cells, 0, "License")


_LINE_FIELDS = {"vehicle_type": 1, "km_anual": 2, "pct_carga": 5, "horas_anuales": 9, "period": 12}


@query("document_records")
def q_document_records(spark, d):
    """The documents as fixed-line records of 12 lines or more: how many are
    short, and how many numeric and date fields do not parse."""
    docs = read_table(spark, d.sf_dir, "documents", ["doc_id", "text"])
    return record_quality(text_records(docs, "doc_id", "text"), _LINE_FIELDS, 12)


# ---- scans and summaries that no single key or value count bounds -------------------
@query("carry_forward")
def q_carry_forward(spark, d):
    """For each event the value of its user's last purchase so far, by a
    two-level scan."""
    ev = read_table(spark, d.sf_dir, "events", ["event_id", "user_id", "ts", "event_type",
                                                "value"])
    bought = F.when(F.col("event_type") == "purchase", F.col("value"))
    return scan.carry_forward(
        ev.select("event_id", "user_id", "ts", bought.alias("last_purchase")),
        ["user_id"], ["ts", "event_id"], "last_purchase").select(
            "event_id", "user_id", "last_purchase")


_FREQUENT = [("lineitem", "l_partkey"), ("lineitem", "l_suppkey"), ("events", "user_id")]


@query("heavy_hitters")
def q_heavy_hitters(spark, d):
    """The 20 most frequent values of three columns with exact counts, from
    Misra-Gries summaries."""
    return profile.union_all(
        frequent.placed(frequent.top_values(read_table(spark, d.sf_dir, t, [c]), c, 20), c)
        for t, c in _FREQUENT)


@query("column_modes")
def q_column_modes(spark, d):
    """The mode of each of those columns, by the same summaries."""
    return profile.union_all(
        frequent.placed(frequent.mode(read_table(spark, d.sf_dir, t, [c]), c), c).drop("place")
        for t, c in _FREQUENT)


_PS = [0.01, 0.25, 0.5, 0.75, 0.99]


@query("quantile_sketches")
def q_quantile_sketches(spark, d):
    """Prices sketched by ship year, the sketches stored and merged over each
    year and over all: is every quantile's exact rank within the bound?"""
    li = read_table(spark, d.sf_dir, "lineitem", ["l_shipdate", "l_extendedprice"]).select(
        F.year("l_shipdate").alias("year"), F.col("l_extendedprice").alias("v"))
    stored = sketches.quantile_sketches(li, ["year"], "v")
    spans = stored.select("year", F.explode(F.array(
        F.struct(F.col("year").alias("first_year"), F.col("year").alias("last_year")),
        F.struct(F.lit(0).alias("first_year"), F.lit(9999).alias("last_year")))).alias("s")
    ).select("year", "s.*")
    quantiles = sketches.merged_quantiles(
        stored.join(spans, "year"), _PS, ["first_year", "last_year"])
    # the exact rank of each quantile among the rows of its span
    asked = spans.join(quantiles, ["first_year", "last_year"])
    ranks = li.join(asked, "year").groupBy("first_year", "last_year", "p", "n").agg(
        F.count_if(F.col("v") < F.col("quantile")).alias("below"),
        F.count_if(F.col("v") <= F.col("quantile")).alias("upto"),
        F.count("v").alias("rows"))
    off = F.greatest(F.col("below") / F.col("n") - F.col("p"),
                     F.col("p") - F.col("upto") / F.col("n"))
    return ranks.select("first_year", "last_year", "p", "n", (
        (off <= sketches.rank_error()) & (F.col("rows") == F.col("n"))).alias("within_bound"))


def _customer_sketches(spark, d):
    by = read_table(spark, d.sf_dir, "orders", ["o_orderdate", "o_custkey"]).select(
        F.year("o_orderdate").alias("year"), "o_custkey")
    return by, sketches.distinct_sketches(by, ["year"], "o_custkey")


@query("distinct_sketches")
def q_distinct_sketches(spark, d):
    """Customers by order year and in all (year NULL): exact count, and whether
    the merged HLL and Theta estimates are within their bounds."""
    by, stored = _customer_sketches(spark, d)
    each = sketches.merged_distinct(stored, ["year"])
    whole = sketches.merged_distinct(stored).withColumn("year", F.lit(None).cast("int"))
    seen = by.distinct()
    exact = seen.groupBy("year").agg(F.count("o_custkey").alias("n")).unionByName(
        seen.select("o_custkey").distinct().agg(F.count("o_custkey").alias("n"))
        .withColumn("year", F.lit(None).cast("int")))
    got = each.unionByName(whole).withColumnRenamed("year", "y")
    return exact.join(got, F.col("year").eqNullSafe(F.col("y"))).select(
        "year", "n", sketches.within("n_hll", "n", sketches.hll_error()).alias("hll_ok"),
        sketches.within("n_theta", "n", sketches.theta_error()).alias("theta_ok"))


@query("distinct_overlap")
def q_distinct_overlap(spark, d):
    """Customers that two order years share, exactly, and whether the
    intersection and union of the stored Theta sketches are within bounds."""
    by, stored = _customer_sketches(spark, d)
    years = by.distinct().groupBy("o_custkey").agg(F.sort_array(F.collect_set("year")).alias("g"))
    pairs = (years.select("g", F.explode("g").alias("a"))
             .select("a", F.explode(F.filter("g", lambda x: x > F.col("a"))).alias("b"))
             .groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_shared")))
    size = by.distinct().groupBy("year").agg(F.count(F.lit(1)).alias("size"))
    either = (sketches.overlaps(stored, "year").join(pairs, ["a", "b"], "left")
              .join(size.select(F.col("year").alias("a"), F.col("size").alias("n_a")), "a")
              .join(size.select(F.col("year").alias("b"), F.col("size").alias("n_b")), "b")
              .fillna(0, ["n_shared"])
              .withColumn("n_all", F.col("n_a") + F.col("n_b") - F.col("n_shared")))
    off = F.abs(F.col("n_both") - F.col("n_shared")) <= (
        F.lit(sketches.theta_error()) * F.col("n_all") + 0.5)
    return either.select(
        "a", "b", "n_shared", "n_all", off.alias("both_ok"),
        sketches.within("n_either", "n_all", sketches.theta_error()).alias("either_ok"))


@query("distinct_bitmaps")
def q_distinct_bitmaps(spark, d):
    """Exact distinct keys by ship year and in all (year NULL), from stored
    bitmaps merged."""
    li = read_table(spark, d.sf_dir, "lineitem", ["l_shipdate", "l_orderkey", "l_partkey",
                                                  "l_suppkey"])
    stored = bitmaps.value_bitmaps(li.withColumn("year", F.year("l_shipdate")),
                                   ["l_orderkey", "l_partkey", "l_suppkey"], ["year"])
    whole = bitmaps.distinct_counts(stored).withColumn("year", F.lit(None).cast("int"))
    return bitmaps.distinct_counts(stored, ["year"]).unionByName(whole)


# ---- stored tables ------------------------------------------------------------------
@query("counted_writes")
def q_counted_writes(spark, d):
    """Raw and cleaned row counts of the panels, observed by the jobs that write
    the cleaned tables."""
    d.typed_flows = True
    got = [(n, *stores.write_counted(d.raw(n), cleaning.CLEANERS[n],
                                     shared_dir(spark, f"clean-{n}")).values())
           for n in cleaning.CLEANERS]
    return spark.createDataFrame(got, "dataset string, raw_rows long, clean_rows long")


@query("bucketed_join")
def q_bucketed_join(spark, d):
    """Lineitem and orders saved bucketed and sorted by order key, joined and
    grouped by order without an exchange, then summed by priority."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables = {}
    for name, key, cols in (("lineitem", "l_orderkey", ["l_quantity"]),
                            ("orders", "o_orderkey", ["o_orderpriority"])):
        path = shared_dir(spark, f"bucketed-{name}")
        tables[name] = path.rsplit("/", 1)[1].replace("-", "_")
        stores.save_bucketed(read_table(spark, d.sf_dir, name, [key, *cols]), tables[name],
                             [key], n, path)
    per = _order_lines(spark.table(tables["lineitem"]), spark.table(tables["orders"]))
    return per.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("n_lines").alias("n_lines"),
        F.sum("qty").alias("qty"))


def _order_lines(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines and quantity of each row of ``orders``, both tables bucketed by
    order key."""
    lines = lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"),
                                               F.sum("l_quantity").alias("qty"))
    return orders.join(lines.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"))


@query("rewritten_year")
def q_rewritten_year(spark, d):
    """The cleaned corridors stored by year, one year written again with its
    values doubled: the others keep theirs."""
    panel = clean(spark, d, "corridors")
    path = shared_dir(spark, "by-year")
    stores.replace_periods(panel, path, ["year"])
    again = panel.filter(F.col("year") == 1997).withColumn("value", F.col("value") * 2)
    stores.replace_periods(again, path, ["year"])
    return stores.read_periods(spark, path, panel)


# ---- values of any type, lines that do not fit -----------------------------------------
@query("variant_fields")
def q_variant_fields(spark, d):
    """By event type: rows, bad texts, and the field k of the properties as a
    number, from VARIANT values."""
    ev = read_table(spark, d.sf_dir, "events", ["event_type", "props"])
    got = variants.typed_fields(ev, "props", {"k": ("$.k", "long"), "none": ("$.x.y", "int")})
    return got.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("bad_text").alias("n_bad"),
        F.count("k").alias("n_k"), F.sum("k").alias("sum_k"), F.count("none").alias("n_none"))


@query("variant_types")
def q_variant_types(spark, d):
    """The types that the properties and the event types (no JSON) hold."""
    ev = read_table(spark, d.sf_dir, "events", ["event_type", "props"])
    return profile.union_all(
        variants.found_types(ev, c).select(F.lit(c).alias("column_name"), "*")
        for c in ("props", "event_type"))


@query("csv_bad_lines")
def q_csv_bad_lines(spark, d):
    """Customers as CSV, one folder a segment, the key replaced by the name in
    one of them; read with an integer key, the lines that do not fit are kept
    and counted by their file's segment."""
    c = read_table(spark, d.sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    path = shared_dir(spark, "csv-lines")
    key = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).otherwise(
        F.col("c_custkey").cast("string"))
    c.select(key.alias("key"), "c_name", "c_mktsegment").write.option("header", True) \
        .partitionBy("c_mktsegment").csv(path)
    schema = StructType([StructField("key", LongType()), StructField("c_name", StringType())])
    lines = files.read_csv_checked(spark, f"{path}/*", schema)
    segment = F.regexp_extract(F.url_decode("file"), "c_mktsegment=([^/]*)/", 1)
    return files.line_quality(lines.withColumn("segment", segment), ["segment"])
