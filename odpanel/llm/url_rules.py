"""URL filters from association rules.

Host rules decide first: a rule (action, host, path) fits its host and all
subdomains where the URL's path starts with the rule's; the longest fitting
rule wins. The other URLs are judged by rules mined from labelled pages:

* a URL is a set of at most twelve tokens, one of a kind, which together hold
  the whole URL: its host and the parts of it, first, middle and last path
  segments, extension, depth, the set of query keys, a fragment. A fixed
  number of kinds bounds the frequent sets of a URL at 2^12, however long it
  is and however often it repeats;
* Spark's FP-growth finds the frequent token sets, with the label ``bad`` as
  one more token. A set of at most ``MAX_TOKENS`` tokens is a rule if it
  stands with ``bad`` often enough (support) and for a large enough share of
  its pages (confidence); a rule that holds a smaller rule is redundant;
* the inverted index posts each rule under its rarest token; a URL meets the
  rules of its tokens and checks that it holds them whole.

Columns and SQL functions only; no Python worker sees a row.
"""

from __future__ import annotations

import math
from functools import reduce
from string import ascii_lowercase, ascii_uppercase
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odpanel.llm.common import stored

BAD = "bad"            # the label's token; those of URLs have a "kind="
MIN_SUPPORT = 0.002    # least share of the labelled pages that hold a rule and are bad
MIN_COUNT = 5          # and their least number
MIN_CONFIDENCE = 0.5   # least share of bad pages among those that hold a rule
MAX_TOKENS = 3         # tokens of a rule, at most


class HostRule(NamedTuple):
    action: str
    host: str
    path: str


# The host rules of the query.
HOST_RULES = [HostRule("block", "net", "/"), HostRule("allow", "example.net", "/en/"),
              HostRule("block", "example.com", "/de/"), HostRule("allow", "org", "/fr/")]


def lower_ascii(c: Column) -> Column:
    return F.translate(c, ascii_uppercase, ascii_lowercase)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one or for a null."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: list[HostRule]) -> Column:
    """struct(rule, action) of the longest rule that fits; fields null if
    none does. The list is a parameter and becomes one CASE expression."""
    ordered = sorted(rules, key=lambda r: (-len(r.host + r.path), r))

    def named(r: HostRule | None) -> Column:
        return F.struct(F.lit(r and r.host + r.path).cast("string").alias("rule"),
                        F.lit(r and r.action).cast("string").alias("action"))

    fits = [(F.when((F.concat(F.lit("."), host).endswith("." + r.host))
                    & path.startswith(r.path), named(r))) for r in ordered]
    return F.coalesce(*fits, named(None))


def tokens(url: Column) -> Column:
    """The URL's tokens ``kind=value``, A-Z lower-cased, at most one of a
    kind; none for a null URL or one without ``://``."""
    low = lower_ascii(url)
    host, path = host_of(url), path_of(low)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    query = F.regexp_extract(_rest(low), r"^[^?#]*\?([^#]*)", 1)
    keys = F.array_sort(F.array_distinct(F.filter(
        F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1)),
        lambda x: x != "")))
    leaf = F.try_element_at(parts, F.lit(-1))
    n = F.size(labels)
    kinds = {
        "host": host,
        "tld": F.try_element_at(labels, F.lit(-1)),
        "domain": F.when(n >= 2, F.array_join(F.slice(labels, F.greatest(n - 1, F.lit(1)), 2), ".")),
        "site": F.when(n >= 3, F.try_element_at(labels, F.lit(-3))),
        "sub": F.try_element_at(labels, F.lit(1)),
        "dir": F.try_element_at(parts, F.lit(1)),
        "mid": F.array_join(F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0))), "/"),
        "leaf": leaf,
        "ext": F.regexp_extract(F.coalesce(leaf, F.lit("")), r"\.([^.]+)$", 1),
        "depth": F.when(host != "", F.size(parts).cast("string")),
        "keys": F.array_join(keys, "&"),
        "fragment": F.when(F.regexp_extract(_rest(url), "#.", 0) != "", F.lit("yes")),
    }
    values = [F.when(v != "", F.concat(F.lit(f"{k}="), v)) for k, v in kinds.items()]
    return F.array_compact(F.array(*values))


def _subsets(items: Column) -> Column:
    """The smaller non-empty sets of a sorted set of at most three items."""
    singles = F.transform(items, lambda x: F.array(x))
    without = F.transform(items, lambda x: F.array_remove(items, x))
    return F.when(F.size(items) > 1, F.array_distinct(F.concat(singles, without))).otherwise(
        F.array().cast("array<array<string>>"))


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT,
               min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(rule, bad_n, n, confidence, token) of ``labelled`` (tokens, bad): the
    token sets of at most ``MAX_TOKENS`` tokens that imply ``bad``; token is
    the rarest of each. bad_n is at least ``min_count`` and ``min_support`` of
    all labelled rows. Without labelled rows there are no rules."""
    spark = labelled.sparkSession
    marked = F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))
    rows = stored(spark, labelled.select(F.concat("tokens", marked).alias("items")), "url-items")
    total = rows.count()
    least = max(min_count, math.ceil(min_support * total))
    if least > total:
        return spark.createDataFrame(
            [], "rule array<string>, bad_n long, n long, confidence double, token string")
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / total).fit(rows)
    sets = stored(spark, model.freqItemsets.filter(F.size("items") <= MAX_TOKENS + 1)
                  .select(F.array_sort("items").alias("items"), "freq"), "url-sets")
    bad = sets.filter(F.array_contains("items", BAD) & (F.size("items") > 1)).select(
        F.array_remove("items", BAD).alias("rule"), F.col("freq").alias("bad_n"))
    every = sets.select(F.col("items").alias("rule"), F.col("freq").alias("n"))
    share = (F.col("bad_n") / F.col("n")).alias("confidence")
    kept = stored(spark, bad.join(every, "rule").select("rule", "bad_n", "n", share)
                  .filter(F.col("confidence") >= min_confidence), "url-rules")
    wider = (kept.select("rule", F.explode(_subsets(F.col("rule"))).alias("part"))
             .join(kept.select(F.col("rule").alias("part")), "part").select("rule").distinct())
    single = sets.filter(F.size("items") == 1).select(
        F.col("items")[0].alias("token"), F.col("freq").alias("token_n"))
    rarest = (kept.join(wider, "rule", "left_anti")
              .select("*", F.explode("rule").alias("token")).join(single, "token")
              .groupBy("rule").agg(F.first("bad_n").alias("bad_n"), F.first("n").alias("n"),
                                   F.first("confidence").alias("confidence"),
                                   F.min(F.struct("token_n", "token")).alias("least")))
    return stored(spark, rarest.select("rule", "bad_n", "n", "confidence",
                                       F.col("least.token").alias("token")), "url-index")


def matching_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The different ``url`` values that hold a rule whole. The join is on the
    rules' rarest tokens, between two plain sides, so Spark splits a common
    token or sends a small index to all tasks."""
    held = urls.select("url").distinct().select("url", tokens(F.col("url")).alias("tokens"))
    return (held.select("url", "tokens", F.explode("tokens").alias("token"))
            .join(rules.select("token", "rule"), "token")
            .filter(F.size(F.array_except("rule", "tokens")) == 0)
            .select("url").distinct())


def page_labels(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(page_id, bad), an id once: bad if any row is toxic or of quality 0.
    Null ids and labels are no labels."""
    bad = F.coalesce((F.col("toxic") == 1), F.lit(False)) | F.coalesce(
        (F.col("quality") == 0), F.lit(False))
    set_ = F.col("toxic").isNotNull() | F.col("quality").isNotNull()
    return (labels.filter(set_ & F.col(key).isNotNull())
            .groupBy(F.col(key).cast("long").alias("page_id")).agg(F.max(bad).alias("bad")))


def filter_urls(pages: DataFrame, labels: DataFrame, rules: list[HostRule] = HOST_RULES,
                min_support: float = MIN_SUPPORT, min_count: int = MIN_COUNT,
                min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of ``pages``;
    ``labels`` is (page_id, bad), an id once.

    rule: the host rule that decides, else null; verdict: its action, else
    ``block`` if the URL holds a mined rule, else ``allow``. A null URL or one
    without ``://`` has empty host and path, fits nothing and is allowed. Null
    and repeated ids keep their rows; no labels, no mined rules; an empty
    table gives an empty result; other columns are not read."""
    spark = pages.sparkSession
    src = pages.select(F.col("page_id").cast("long").alias("page_id"),
                       F.col("url").cast("string").alias("url"))
    known = stored(spark, labels.select("page_id", "bad"), "url-labels")
    mined = mine_rules(src.join(known, "page_id").select(
        tokens(F.col("url")).alias("tokens"), "bad"), min_support, min_count, min_confidence)
    parts = src.select("page_id", "url", host_of(F.col("url")).alias("host"),
                       path_of(F.col("url")).alias("path"))
    decided = parts.select("*", fitting_rule(F.col("host"), F.col("path"), rules).alias("fit"))
    open_urls = decided.filter(F.col("fit.action").isNull() & F.col("url").isNotNull())
    hit = stored(spark, matching_urls(open_urls, mined), "url-hits")
    return (decided.join(hit.select("url", F.lit(True).alias("hit")), "url", "left")
            .select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                    F.coalesce("fit.action", F.when(F.col("hit"), "block").otherwise("allow"))
                    .alias("verdict")))


def _sql_rest(url: str) -> str:
    return f"(CASE WHEN contains({url}, '://') THEN substr({url}, instr({url}, '://') + 3) " \
           f"ELSE '' END)"


def oracle() -> str:
    """The same rows in DuckDB SQL, without FP-growth: every set of up to three
    tokens of each labelled page is counted."""
    rules = sorted(HOST_RULES, key=lambda r: -len(r.host + r.path))
    when = "\n".join(f"WHEN ends_with('.' || host, '.{r.host}') AND starts_with(path, '{r.path}')"
                     f" THEN {{}}" for r in rules)
    case = [f"CASE {when.format(*x)} END" for x in (
        [f"'{r.host}{r.path}'" for r in rules], [f"'{r.action}'" for r in rules])]
    low = f"translate(url, '{ascii_uppercase}', '{ascii_lowercase}')"
    kinds = {
        "host": "host", "tld": "labels[-1]",
        "domain": "CASE WHEN len(labels) >= 2 THEN labels[-2] || '.' || labels[-1] END",
        "site": "CASE WHEN len(labels) >= 3 THEN labels[-3] END", "sub": "labels[1]",
        "dir": "parts[1]", "mid": "array_to_string(parts[2:len(parts) - 1], '/')",
        "leaf": "parts[-1]", "ext": "regexp_extract(coalesce(parts[-1], ''), '\\.([^.]+)$', 1)",
        "depth": "CASE WHEN host <> '' THEN len(parts)::VARCHAR END",
        "keys": "array_to_string(list_sort(list_distinct(list_filter(list_transform("
                "string_split(query, '&'), lambda x: string_split(x, '=')[1]), "
                "lambda x: x <> ''))), '&')",
        "fragment": f"CASE WHEN regexp_matches({_sql_rest('url')}, '#.') THEN 'yes' END",
    }
    listed = ", ".join(f"CASE WHEN {v} <> '' THEN '{k}=' || {v} END" for k, v in kinds.items())
    names = "abc"[:MAX_TOKENS]
    sets = " UNION ALL ".join(
        f"SELECT [{', '.join(f'{x}.t' for x in names[:k])}] AS items, a.bad FROM one a "
        + " ".join(f"JOIN one {y} ON {y}.id = a.id AND {y}.t > {x}.t"
                   for x, y in zip(names[:k - 1], names[1:k], strict=True))
        for k in range(1, MAX_TOKENS + 1))
    joined = reduce(lambda a, b: f"{a},\n{b}", [
        f"""u AS (SELECT page_id, url, {low} AS low,
            translate(regexp_extract({_sql_rest('coalesce(url, chr(0))')}, '^[^/?#]*'),
                      '{ascii_uppercase}', '{ascii_lowercase}') AS host,
            regexp_extract({_sql_rest('coalesce(url, chr(0))')}, '^[^/?#]*([^?#]*)', 1) AS path
            FROM pages)""",
        f"""s AS (SELECT *, list_filter(string_split(host, '.'), lambda x: x <> '') AS labels,
            list_filter(string_split(translate(path, '{ascii_uppercase}', '{ascii_lowercase}'),
                                     '/'), lambda x: x <> '') AS parts,
            regexp_extract({_sql_rest('low')}, '^[^?#]*\\?([^#]*)', 1) AS query FROM u)""",
        f"""t AS MATERIALIZED (SELECT page_id, url, host, path, {case[0]} AS rule,
            {case[1]} AS action,
            list_filter([{listed}], lambda x: x IS NOT NULL) AS tokens FROM s)""",
        """lab AS (SELECT doc_id, max(coalesce(toxic = 1, false) OR coalesce(quality = 0, false))
            AS bad FROM labels WHERE doc_id IS NOT NULL
            AND (toxic IS NOT NULL OR quality IS NOT NULL) GROUP BY doc_id)""",
        """x AS MATERIALIZED (SELECT row_number() OVER () AS id, tokens, bad
            FROM t JOIN lab ON doc_id = page_id)""",
        "one AS MATERIALIZED (SELECT id, bad, unnest(tokens) AS t FROM x)",
        f"""r AS MATERIALIZED (SELECT items FROM ({sets}) GROUP BY items
            HAVING count_if(bad) >= greatest({MIN_COUNT},
              ceil({MIN_SUPPORT}::DOUBLE * (SELECT count(*) FROM x)))
            AND count_if(bad)::DOUBLE / count(*) >= {MIN_CONFIDENCE})""",
        """h AS (SELECT DISTINCT url FROM (SELECT DISTINCT url, tokens FROM t
            WHERE rule IS NULL AND url IS NOT NULL) JOIN r ON list_has_all(tokens, items))""",
    ])
    return f"""WITH {joined}
    SELECT page_id, host, path, rule,
      coalesce(action, CASE WHEN url IN (SELECT url FROM h) THEN 'block' ELSE 'allow' END)
        AS verdict FROM t"""
