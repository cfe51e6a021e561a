"""Record files derived from the cost panel.

Each cost row becomes one fixed-line text file of 256 lines in a folder of
its period, with the fields on their line numbers and filler elsewhere, so
that extraction must return the cost rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The record format, by line number (from 1). Held here apart
# from the extractor's list, so that an error in either shows.
LINES = 256
LAYOUT = {
    129: "vehicle_type", 135: "km_anual", 136: "pct_carga", 137: "horas_anuales",
    142: "vehicle_price_eur", 148: "interest_rate_pct", 159: "semitrailer_price_eur",
    177: "personal_conduccion_eur", 182: "dietas_conductor_eur", 192: "seguros_eur",
    202: "costes_fiscales_eur", 206: "fuel_price_per_litre", 207: "fuel_consumption_coeff",
    229: "peajes_eur", 235: "urea_eur", 240: "costes_indirectos_eur", 256: "period",
}
FILLER = "0"


def record_text(lines: int = LINES) -> F.Column:
    """The record of a cost row: text in quotes, the date between hashes."""
    def line(i: int):
        name = LAYOUT.get(i)
        if name is None:
            return F.lit(FILLER)
        text = F.coalesce(F.col(name).cast("string"), F.lit(""))
        mark = F.lit({"vehicle_type": '"', "period": "#"}.get(name, ""))
        return F.concat(mark, text, mark)

    return F.array_join(F.array(*[line(i) for i in range(1, lines + 1)]), "\n")


def write_records(cost: DataFrame, root: str) -> None:
    """One text file per cost row under ``root``, in folders by period."""
    (cost.select(record_text().alias("value"), F.col("period").cast("string").alias("folder"))
     .write.mode("overwrite").partitionBy("folder").text(root))
