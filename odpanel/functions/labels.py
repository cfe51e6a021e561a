"""Label normalization by prefix rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from odpanel.functions.columns import trim_blanks

# Region label prefixes and the canonical names they map to.
# A trimmed label starting with a prefix gets the canonical name.
REGION_PREFIXES = {
    "Andaluc": "Andalucia",
    "Arag": "Aragon",
    "Asturias": "Asturias",
    "Balears": "Baleares",
    "Canarias": "Canarias",
    "Cantabria": "Cantabria",
    "Castilla-La Mancha": "Castilla-La Mancha",
    "Castilla y Le": "Castilla y Leon",
    "Catalu": "Cataluna",
    "Comunidad Valenciana": "Com. Valenciana",
    "Extremadura": "Extremadura",
    "Galicia": "Galicia",
    "Madrid": "Madrid",
    "Murcia": "Murcia",
    "Navarra": "Navarra",
    "Pa": "Pais Vasco",
    "Rioja": "Rioja",
    "Ceuta": "Ceuta y Melilla",
}
# Fixed value: the label of an aggregate row, mapped to NULL.
TOTAL_LABEL = "TOTAL"


def normalize_label(raw, rules: dict | None = None, total_label: str = TOTAL_LABEL) -> Column:
    """Canonical label: ``total_label`` -> NULL, the longest matching prefix
    rule, else the trimmed raw label. One CASE expression, in codegen."""
    rules = REGION_PREFIXES if rules is None else rules
    s = trim_blanks(raw)
    expr = F.when(s == total_label, F.lit(None).cast("string"))
    for prefix, canon in sorted(rules.items(), key=lambda r: -len(r[0])):
        expr = expr.when(s.startswith(prefix), F.lit(canon))
    return expr.otherwise(s)


def normalize_with_rule_table(df, col: str, rules, out: str = "label",
                              total_label: str = TOTAL_LABEL):
    """``normalize_label`` for rule tables too large for a CASE expression.

    ``rules`` is a DataFrame (prefix, canon). The distinct labels are
    exploded into their prefixes (up to the longest rule prefix, a scalar
    subquery), equi-joined with the rules on prefix, and the longest match
    wins (``max_by``). The label -> canonical map is joined back through a
    salted lookup, so a label carried by a third of all rows still spreads
    over many tasks. Adds ``out``; other columns are unchanged.
    """
    from odpanel.operators.flows import salted_lookup
    raw = trim_blanks(col)
    maxlen = rules.select(F.max(F.length("prefix"))).scalar()
    labels = df.select(raw.alias("_raw")).distinct().where(F.col("_raw").isNotNull())
    prefixes = F.transform(F.sequence(F.lit(1), F.col("_n")),
                           lambda i: F.substr(F.col("_raw"), F.lit(1), i))
    cand = (labels.where(F.length("_raw") > 0)
            .withColumn("_n", F.least(F.length("_raw"), maxlen))
            .select("_raw", F.explode(prefixes).alias("prefix")))
    best = cand.join(rules, "prefix").groupBy("_raw").agg(
        F.max_by("canon", F.length("prefix")).alias("_canon"))
    x = salted_lookup(df.withColumn("_raw", raw), best, ["_raw"], how="left")
    lab = F.when(F.col("_raw") == total_label, F.lit(None).cast("string")).otherwise(
        F.coalesce(F.col("_canon"), F.col("_raw")))
    return x.withColumn(out, lab).drop("_raw", "_canon")
