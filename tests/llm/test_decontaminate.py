import random

import numpy as np

from odpanel.llm import decontaminate as dc


def brute(item, text):
    """Least edits between ``item`` and any stretch of ``text``."""
    row = [0] * (len(text) + 1)
    for r in range(1, len(item) + 1):
        new = [r] + [0] * len(text)
        for j in range(1, len(text) + 1):
            new[j] = min(row[j - 1] + (item[r - 1] != text[j - 1]), row[j] + 1, new[j - 1] + 1)
        row = new
    return min(row)


def test_search_matches_brute_force(benchmark):
    rng = random.Random(5)
    items = [(r.item_id, dc.normal(r.text)) for r in benchmark.collect()]
    index = dc.Items(items)
    found = 0
    for _ in range(60):
        item_id, text = rng.choice(items)
        budget = int(index.edits[index.ids.index(item_id)])
        s = list(text)
        for _ in range(rng.randint(0, budget + 4)):
            j, kind = rng.randrange(len(s)), rng.random()
            if kind < 0.4:
                s[j] = rng.choice("abcdefgh")
            elif kind < 0.7:
                s.insert(j, rng.choice("abcdefgh"))
            else:
                del s[j]
        body = dc.normal("x" * rng.randint(1, 90) + " " + "".join(s) + " tail of it")
        want = brute(text, body)
        got = [h for h in index.search(["zzz", body, "yyy"]) if h[1] == item_id]
        assert bool(got) == (want <= budget)
        found += bool(got)
        if got:
            assert got[0][0] == 1 and got[0][2] == want
    assert found > 20


def test_layout_is_the_normal_form():
    texts = ["", "Ab,  cD\n", "ünï_code 漢字!", " x", "𝐀b 🙂"]
    c, starts = dc.layout(texts)
    for i, t in enumerate(texts):
        part = c[starts[i]:starts[i + 1] - 1]
        assert "".join(map(chr, part.tolist())).rstrip() == dc.normal(t)


def test_hash_of_equal_grams_is_equal():
    c = dc.codes("abcdefghijabcdefghij")
    h = dc.qgram_hashes(c)
    assert h[0] == h[10] and len(np.unique(h)) == 10


def test_finds_all_planted_passages(docs, benchmark):
    items = {r.item_id: r.text for r in benchmark.collect()}
    rows = {r.doc_id: r.text for r in docs.collect()}
    planted = {(d, i) for d, t in rows.items() for i, x in items.items() if x in t}
    got = {(r.doc_id, r.item_id): r for r in dc.find_leaks(docs, benchmark).collect()}
    assert planted and planted <= set(got)
    for d, i in set(got) - planted:
        budget = int(len(dc.normal(items[i])) * dc.ERROR_RATE)
        assert brute(dc.normal(items[i]), dc.normal(rows[d])) == got[d, i].edits <= budget
    left = {r.doc_id for r in dc.drop_leaks(docs, benchmark).collect()}
    assert left == set(rows) - {d for d, _ in got}


def test_blocks_of_items_give_the_same(docs, benchmark, monkeypatch):
    whole = {tuple(r) for r in dc.find_leaks(docs, benchmark).collect()}
    monkeypatch.setattr(dc.item_blocks, "__defaults__", (2000,))
    assert {tuple(r) for r in dc.find_leaks(docs, benchmark).collect()} == whole


def test_edge_cases(spark, edges, no_docs, benchmark):
    odd = spark.createDataFrame(
        [(1, None, 0), (2, "", 0), (3, "short", 0), (None, "x" * 99, 0), (4, "a" * 200, 0),
         (4, "a" * 200, 0)], "item_id long, text string, doc_id long")
    got = dc.find_leaks(edges, odd).collect()
    assert [(r.doc_id, r.item_id, r.edits) for r in got] == [(450, 4, 0)]
    kept = dc.drop_leaks(edges, odd)
    assert kept.columns == edges.columns and kept.count() == edges.count() - 1
    assert dc.find_leaks(no_docs, benchmark).count() == 0
    assert dc.find_leaks(edges, odd.limit(0)).count() == 0
    assert dc.drop_leaks(edges, odd.limit(0)).count() == edges.count()


def test_items_of_sixteen_characters_and_more_match_brute_force():
    rng = random.Random(6)
    items = [(n, "".join(rng.choice("abcdef ") for _ in range(n)).replace(" ", "g"))
             for n in range(16, 32)]
    index = dc.Items(items)
    assert index.edits.min() == 1 and index.edits.max() == 2
    found = 0
    for _ in range(200):
        n, text = rng.choice(items)
        budget = int(index.edits[index.ids.index(n)])
        s = list(text)
        for _ in range(rng.randint(0, budget + 2)):
            j, kind = rng.randrange(len(s)), rng.random()
            if kind < 0.4:
                s[j] = "x"
            elif kind < 0.7:
                s.insert(j, "x")
            else:
                del s[j]
        body = dc.normal("y" * rng.randint(1, 20) + " " + "".join(s) + " tail of it")
        want = brute(text, body)
        got = [h for h in index.search(["zzz", body, "yyy"]) if h[1] == n]
        assert bool(got) == (want <= budget)
        found += bool(got)
    assert 50 < found < 200


def test_short_items_are_whole_words():
    items = [(1, "what is dna"), (2, "x y 2"), (3, "question"), (4, "7"), (5, "漢字"),
             (6, "a" * 15), (7, "")]
    texts = ["So: What is DNA?", "what is dnase", "x + y = 2", "x + y = 21", "questions, 7",
             "unquestion question", "这是漢字测试", "a" * 16, "a" * 15, "", "77 ab7"]
    got = dc.Items(items).search(texts)
    assert [(t, i) for t, i, *_ in got] == [(0, 1), (2, 2), (4, 4), (5, 3), (6, 5), (8, 6)]
    for t, i, edits, begin, end in got:
        assert edits == 0 and dc.normal(texts[t])[begin:end] == dict(items)[i]


def test_short_items_and_items_without_an_id_drop_documents(spark):
    docs = spark.createDataFrame([(1, "Tell me: 2 + 2 = 4, is it?"), (2, "all of it is new"),
                                  (3, "who wrote the odyssey"), (None, "... who knows")],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(9, "2+2=4"), (None, "Who wrote the Odyssey?"),
                                   (None, "who knows"), (8, "new item"), (7, None), (6, "?!")],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.edits) for r in dc.find_leaks(docs, items).collect()}
    assert got == {(1, 9, 0), (3, None, 0), (None, None, 0)}
    assert [r.doc_id for r in dc.drop_leaks(docs, items).collect()] == [2]
