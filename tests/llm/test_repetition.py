import random
import re
from collections import Counter

import pytest

from odpanel.llm import repetition


def brute(text, least):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, covered, places = len(w), set(), {}
    for i in range(n):
        for size in range(least, n - i + 1):
            places.setdefault(tuple(w[i:i + size]), []).append(i)
    repeated = {s: p for s, p in places.items() if len(p) > 1}
    for s, p in repeated.items():
        for i in p:
            covered |= set(range(i, i + len(s)))
    maximal = sum(
        len({w[i - 1] if i else None for i in p}) > 1
        and len({w[i + len(s)] if i + len(s) < n else None for i in p}) > 1
        for s, p in repeated.items())
    return (n, sum(map(len, w)), sum(len(w[i]) for i in covered), maximal,
            max(map(len, repeated), default=0))


@pytest.mark.parametrize("least", [2, 3, 5, 8])
def test_measure_matches_brute_force(least):
    rng = random.Random(least)
    texts = ["", None]
    for _ in range(150):
        kinds = [str(i) for i in range(rng.choice([2, 4, 40]))] + ["é"]
        t = " ".join(rng.choice(kinds) for _ in range(rng.randint(0, 40)))
        texts.append(t + " x " + t[:rng.randint(0, len(t))] if rng.random() < 0.5 else t)
    m = repetition.measure([None if t is None else t.encode() for t in texts], least)
    for i, t in enumerate(texts):
        got = tuple(int(m[c][i]) for c in ("n_words", "word_chars", "repeat_chars", "n_repeats",
                                           "longest_repeat"))
        assert got == brute(t, least), t


def test_base_columns_and_verdict(spark):
    line = "one two three four five six seven eight nine ten"
    texts = {1: "\n".join([line, line, "  ", "  ", "# * $ é"]), 2: " ".join(map(str, range(100))),
             3: None, 4: " ".join(map(str, range(60))) + " x " + " ".join(map(str, range(60)))
             + " " + " ".join(f"w{i}" for i in range(500))}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    r = {x.doc_id: x for x in repetition.quality(df).collect()}
    assert (r[1].n_dup_lines, r[1].n_symbols, r[1].n_repeat_words) == (1, 3, 20)
    assert r[1].base_failed and not r[1].kept
    assert r[2].kept and not r[2].base_failed and r[2].word_chars == 190
    assert r[3].base_failed and r[3].n_words == 0
    assert not r[4].base_failed and r[4].longest_repeat == 60 and not r[4].kept


def test_windows_on_documents(docs):
    rows = {r.doc_id: r for r in repetition.quality(docs).collect()}
    for d in docs.collect():
        w = d.text.encode().split()
        count = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        covered = {j for i in range(len(w) - 7) if count[tuple(w[i:i + 8])] > 1
                   for j in range(i, i + 8)}
        assert rows[d.doc_id].n_repeat_words == len(covered)
        assert rows[d.doc_id].n_words == len(w)


def test_edge_cases(edges, no_docs):
    got = repetition.quality(edges).collect()
    assert len(got) == edges.count()
    assert all(r.base_failed for r in got if r.n_words == 0)
    assert repetition.quality(no_docs).count() == 0
