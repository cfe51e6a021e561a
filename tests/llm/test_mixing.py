import numpy as np
import pandas as pd
import pytest

from odpanel.llm import mixing


def frame(seed=1, n=60):
    rng = np.random.default_rng(seed)
    df = pd.DataFrame({"source": rng.integers(0, 6, n).astype(str),
                       "lang": rng.integers(0, 4, n).astype(str),
                       "topic": rng.integers(0, 3, n).astype(str),
                       "tokens": rng.integers(0, 1000, n)})
    return df.groupby(list(mixing.DIMENSIONS), as_index=False)["tokens"].sum()


def test_rake_meets_all_marginals():
    cells = frame()
    targets = mixing.power_targets(cells)
    w = mixing.rake(cells, targets)
    for dim, shares in targets.items():
        have = pd.Series(w).groupby(cells[dim]).sum()
        assert all(abs(have[v] - s) < 1e-6 for v, s in shares.items())


def test_probabilities_meet_the_budget():
    cells = frame(2)
    w = mixing.rake(cells, mixing.power_targets(cells))
    for budget in (0.05, 0.5, 0.95):
        p = mixing.probabilities(cells["tokens"], w, budget)
        assert p.max() <= 1
        assert abs((p * cells["tokens"]).sum() - budget * cells["tokens"].sum()) < 1e-3
    assert mixing.probabilities(np.zeros(3), np.zeros(3), 0.5).tolist() == [0, 0, 0]


def test_large_tables_are_raked_alike(spark, docs):
    small = {r.doc_id: r for r in mixing.sample_mix(docs).collect()}
    large = {r.doc_id: r for r in mixing.sample_mix(docs, max_cells=1).collect()}
    assert small.keys() == large.keys()
    assert all(abs(small[i].prob - large[i].prob) <= 2e-6 for i in small)
    assert all(small[i].sampled == large[i].sampled for i in small)


def test_a_scale_beyond_a_million_is_found_alike(spark):
    # one cell holds nearly all tokens and a target of nearly nothing
    cells = spark.createDataFrame([("a", "", "t", 10 ** 12), ("b", "", "t", 1)],
                                  "source string, lang string, topic string, tokens long")
    stated = {"source": {"a": 1e-9, "b": 1 - 1e-9}}
    got = [{r.source: r.prob for r in mixing.fit(cells, 0.5, {}, stated, n).collect()}
           for n in (10, 1)]
    assert got[0] == got[1] and got[0] == {"a": 0.5, "b": 1.0}


def naive_fit(rows, targets, rounds=400):
    """Raking with dictionaries: rows are (values, tokens)."""
    w = [n for _, n in rows]
    for _ in range(rounds):
        for k, shares in targets.items():
            for v, share in shares.items():
                own = [i for i, (values, _) in enumerate(rows) if values[k] == v]
                have = sum(w[i] for i in own)
                for i in own:
                    w[i] *= share / have
    return w


@pytest.mark.parametrize("max_cells", [100, 1])
def test_stated_weights_hold(spark, max_cells):
    rng = np.random.default_rng(5)
    rows = [((f"s{a}", f"l{b}", f"t{c}"), int(rng.integers(50, 900)))
            for a in range(3) for b in range(2) for c in range(2)]
    docs = spark.createDataFrame(
        [(i, "w " * n, *v) for i, (v, n) in enumerate(rows)],
        "doc_id long, text string, source string, lang string, kind string")
    targets = {"source": {"s0": 2, "s1": 1, "s2": 1}, "lang": {"l0": 0.6, "l1": 0.4}}
    want = naive_fit(rows, {0: {"s0": .5, "s1": .25, "s2": .25}, 1: targets["lang"]})
    want = mixing.probabilities([n for _, n in rows], np.array(want), 0.3)
    args = {"budget": 0.3, "powers": {}, "targets": targets, "topic_of": "kind",
            "max_cells": max_cells}
    got = {r.doc_id: r.prob for r in mixing.sample_mix(docs, **args).collect()}
    assert all(abs(got[i] - p) < 2e-6 for i, p in enumerate(want))
    report = {(r.dimension, r.value): r for r in mixing.mix_report(docs, **args).collect()}
    for d, v, share in (("source", "s0", .5), ("source", "s2", .25), ("lang", "l1", .4)):
        r = report[d, v]
        assert abs(r.target - share) < 1e-9 and abs(r.fitted - share) < 1e-9
        assert max(want) == 1 or abs(r.expected - share) < 1e-4
    assert report["topic", "t0"].target is None


def test_targets_that_cannot_hold_are_reported(spark):
    rows = [(i, "a b c d", f"s{i % 2}", f"l{i % 2}") for i in range(20)]   # source tells lang
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    targets = {"source": {"s0": .5, "s1": .5}, "lang": {"l0": .9, "l1": .1}}
    with pytest.warns(mixing.MixWarning, match="source"):
        mixing.sample_mix(docs, powers={}, targets=targets)
    report = {(r.dimension, r.value): r for r in
              mixing.mix_report(docs, powers={}, targets=targets).collect()}
    assert abs(report["source", "s0"].fitted - report["source", "s0"].target) > 0.3
    with pytest.warns(mixing.MixWarning, match="'s9'"):
        mixing.keep_mix(docs, powers={}, targets={"source": {"s0": .5, "s9": .5}})
    for bad in ({"size": {"a": 1}}, {"lang": {"l0": 0}}, {"lang": {"l0": -1, "l1": 3}}):
        with pytest.raises(ValueError):
            mixing.sample_mix(docs, targets=bad)


def test_sample_follows_the_targets(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.sample_mix(df).toPandas()
    assert len(got) == df.count()
    kept = got[got.sampled]
    assert abs(kept.tokens.sum() / got.tokens.sum() - mixing.BUDGET) < 0.06
    expected = (got.prob * got.tokens).sum() / got.tokens.sum()
    assert abs(expected - mixing.BUDGET) < 1e-4
    stage = {r.doc_id for r in mixing.keep_mix(df).collect()}
    assert stage == set(kept.doc_id)


def test_edge_cases(edges, no_docs):
    got = mixing.sample_mix(edges).collect()
    assert len(got) == edges.count()
    assert all(r.prob == 0 and not r.sampled for r in got if r.doc_id in (100, 150))
    kept = mixing.keep_mix(edges)
    assert kept.columns == edges.columns and kept.count() == sum(r.sampled for r in got)
    assert mixing.sample_mix(no_docs).count() == 0 and mixing.keep_mix(no_docs).count() == 0
    report = mixing.mix_report(no_docs, targets={"source": {"s0": 1}}).collect()
    assert [(r.value, r.tokens, r.fitted) for r in report] == [("s0", 0, 0.0)]
