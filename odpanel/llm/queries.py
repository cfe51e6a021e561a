"""Registered queries of the operators, with their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from odpanel.llm import (
    chunk_dedup,
    decontaminate,
    langid,
    licenses,
    mixing,
    packing,
    repetition,
    simhash,
    spelling,
    token_orc,
    url_rules,
    warc_zstd,
    whitening,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.quality(_table(spark, sf_dir, "documents")).drop("n_repeats",
                                                                       "longest_repeat")


def op2_pack_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.shard_documents(_table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"),
                                    _table(spark, sf_dir, "benchmark"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_matches(_table(spark, sf_dir, "documents"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.sample_mix(_table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(_table(spark, sf_dir, "documents"))


def op8_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_orc.token_output(_table(spark, sf_dir, "documents"), word_tokenizer())


def op9_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.repeated_regions(_table(spark, sf_dir, "documents"))


def op10_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zstd.archive_pages(_table(spark, sf_dir, "pages"))


def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and labels share their ids: a page is bad if its label is."""
    return url_rules.filter_urls(_table(spark, sf_dir, "pages"),
                                 url_rules.page_labels(_table(spark, sf_dir, "labels")))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_suffix_repetition, op2_pack_shards, op3_decontaminate, op4_language_id,
        op5_license_scan, op6_mix_sources, op7_simhash, op8_token_orc, op9_chunk_dedup,
        op10_warc_zstd, op11_url_rules, op12_whitening, op13_spelling)
}

WORDS = "'[^\\x20\\x09-\\x0D]+'"


def _repetition_oracle() -> str:
    """The covered words are those of repeated windows of the least length;
    no repeat is longer than L words if no window of L + 1 words repeats."""
    m, most = repetition.MIN_WORDS, repetition.MAX_LONGEST + 1
    return f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text,
                 coalesce(regexp_extract_all(text, {WORDS}), []) AS w FROM documents),
    g AS (SELECT rid, unnest(i) AS i FROM (
            SELECT rid, list(i) AS i FROM (
              SELECT rid, unnest(list_transform(range(1, len(w) - {m - 2}),
                lambda i: md5(array_to_string(w[i:i + {m - 1}], ' ')))) AS h,
                unnest(range(1, len(w) - {m - 2})) AS i FROM d)
            GROUP BY rid, h HAVING count(*) > 1)),
    v AS (SELECT DISTINCT rid, i + unnest(range({m})) AS i FROM g),
    r AS (SELECT v.rid, count(*) AS n_repeat_words, sum(length(d.w[v.i])) AS repeat_chars
          FROM v JOIN d USING (rid) GROUP BY v.rid),
    l AS (SELECT DISTINCT rid FROM (SELECT rid, unnest(list_transform(
              range(1, len(w) - {most - 2}),
              lambda i: md5(array_to_string(w[i:i + {most - 1}], ' ')))) AS h FROM d)
          GROUP BY rid, h HAVING count(*) > 1),
    b AS (SELECT rid, doc_id, len(w) AS n_words,
            coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
            coalesce(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')), 0) AS n_symbols,
            list_filter(coalesce(string_split(text, chr(10)), []),
                        lambda x: regexp_matches(x, {WORDS})) AS lines FROM d),
    q AS (SELECT b.doc_id, b.n_words, b.word_chars, b.n_symbols,
            len(b.lines) - len(list_distinct(b.lines)) AS n_dup_lines,
            coalesce(r.n_repeat_words, 0) AS n_repeat_words,
            coalesce(r.repeat_chars, 0)::BIGINT AS repeat_chars,
            b.n_words < {repetition.MIN_TEXT_WORDS} OR 100 * coalesce(r.n_repeat_words, 0)
              > {repetition.BASE_PERCENT} * b.n_words AS base_failed, l.rid IS NOT NULL AS long
          FROM b LEFT JOIN r USING (rid) LEFT JOIN l USING (rid))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, repeat_chars,
      base_failed, NOT base_failed AND NOT long
        AND 100 * repeat_chars <= {repetition.MAX_PERCENT} * word_chars AS kept FROM q"""


def _mixing_oracle() -> str:
    """The sweeps written out; the scale by the same halving, as a recursion."""
    dims, powers = mixing.DIMENSIONS, mixing.POWERS
    count = "(length(text) - length(replace(text, '{}', '')))"
    ctes = [f"""d AS MATERIALIZED (SELECT doc_id, coalesce(source, '') AS source,
        coalesce(lang, '') AS lang,
        CASE WHEN coalesce(length(text), 0) = 0 THEN 'none'
          WHEN {count.format('|')} * 40 >= length(text) THEN 'table'
          WHEN length(regexp_replace(text, '[^A-Z]+', '', 'g')) * 4 >= length(text) THEN 'loud'
          WHEN (length(text) - length(replace(text, chr(10), ''))) * 60 >= length(text)
            THEN 'lines' ELSE 'prose' END AS topic,
        coalesce(len(regexp_extract_all(text, {WORDS})), 0) AS tokens FROM documents)""",
            """c AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::DOUBLE AS base,
        sum(tokens)::DOUBLE / sum(sum(tokens)) OVER () AS share
        FROM d GROUP BY ALL)""",
            "w0 AS MATERIALIZED (SELECT *, share AS w FROM c WHERE base > 0)"]
    for dim in dims:
        ctes.append(f"""t_{dim} AS MATERIALIZED (SELECT {dim}, p / sum(p) OVER () AS want
            FROM (SELECT {dim}, pow(sum(base), {powers[dim]}) AS p FROM c
                  GROUP BY {dim} HAVING sum(base) > 0))""")
    k = 0
    for _ in range(mixing.SWEEPS):
        for dim in dims:
            ctes.append(f"""w{k + 1} AS MATERIALIZED (SELECT source, lang, topic, base, share,
                w * want / sum(w) OVER (PARTITION BY {dim}) AS w
                FROM w{k} JOIN t_{dim} USING ({dim}))""")
            k += 1
    ctes.append(f"x AS MATERIALIZED (SELECT *, w / share AS ratio FROM w{k})")
    # the sum of min(1, s * ratio) * base is piecewise linear in s: solve it exactly
    ctes.append(f"""s AS MATERIALIZED (SELECT max(scale) AS scale FROM (
        SELECT ({mixing.BUDGET} * (SELECT sum(base) FROM x)
          - coalesce((SELECT sum(y.base) FROM x y WHERE y.ratio > x.ratio), 0))
          / (SELECT sum(y.base * y.ratio) FROM x y WHERE y.ratio <= x.ratio) AS scale, ratio
        FROM x) WHERE scale * ratio <= 1 + 1e-12)""")
    ctes.append("""p AS (SELECT c.source, c.lang, c.topic,
        round(coalesce(least(1.0, (SELECT scale FROM s) * ratio), 0.0), 6) AS prob
        FROM c LEFT JOIN x USING (source, lang, topic))""")
    return "WITH " + ",\n".join(ctes) + f"""
    SELECT doc_id, source, lang, topic, tokens, prob, ('0x' || substr(md5('{mixing.SEED}:'
      || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE < prob AS sampled
    FROM d JOIN p USING (source, lang, topic)"""


def _warc_oracle() -> str:
    return f"""
    WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
        sha256(coalesce(html, '')) AS payload_digest FROM pages),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
    SELECT page_id, payload_bytes, payload_digest,
      CASE WHEN payload_bytes >= {warc_zstd.MIN_REVISIT} AND first IS DISTINCT FROM page_id
        AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN payload_bytes >= {warc_zstd.MIN_REVISIT} AND first IS DISTINCT FROM page_id
        THEN first END AS refers_to FROM f"""


ORACLE: dict[str, str] = {
    "op1_suffix_repetition": _repetition_oracle(),
    "op5_license_scan": licenses.oracle(),
    "op6_mix_sources": _mixing_oracle(),
    "op10_warc_zstd": _warc_oracle(),
    "op11_url_rules": url_rules.oracle(),
}
