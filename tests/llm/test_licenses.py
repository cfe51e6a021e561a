import re

import duckdb

from odpanel.llm import licenses


def brute(text, threshold=licenses.THRESHOLD):
    clean = re.sub(r"[^a-z0-9\n]+", " ", (text or "").lower())
    units = [clean, *re.split(r"\n ?\n", clean), *clean.split("\n")]
    out = {}
    for u in dict.fromkeys(" ".join(x.split()) for x in units):
        w = u.split()
        pairs = {f"{a} {b}" for a, b in zip(w, w[1:], strict=False)}
        best = max(((2 * len(pairs & set(g)) / (len(pairs) + len(g)), n)
                    for n, g in licenses.template_grams() if pairs), default=(0, ""))
        if best[0] >= threshold:
            out[u] = (best[1], round(best[0], 6))
    return out


def test_matches_brute_force(spark):
    mit = [t for n, t in licenses.TEMPLATES if n == "MIT"]
    bsd = [t for n, t in licenses.TEMPLATES if n.startswith("BSD")]
    texts = ["\n\n".join(mit[2:]), "intro line\n" + mit[0] + "\nmore text here", mit[3],
             "\n".join(bsd[0].split("\n")), bsd[1].replace("CONTRIBUTORS", "AUTHORS"),
             "licensed under cc by nc 4.0", "Licensed under CC BY 4.0!!", "under the MIT",
             "nothing to see here at all", "a b a b a b a b " * 200, *[t for _, t in
                                                                       licenses.TEMPLATES]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got: dict[int, dict] = {}
    for r in licenses.license_matches(df).collect():
        got.setdefault(r.doc_id, {})[r.passage] = (r.license, r.dice)
    for i, t in enumerate(texts):
        assert got.get(i, {}) == brute(t), t
    assert got[0] and len([i for i in got if i >= 10]) == len(licenses.TEMPLATES)


def test_telling_bigrams_lose_no_match():
    grams = licenses.template_grams()
    known = set(licenses.telling(grams, 0.8))
    for _, g in grams:
        # the largest part of a template without a telling bigram stays below
        rest = len(set(g) - known)
        assert 2 * rest < 0.8 * (rest + len(g))


def test_plan_is_native(docs):
    plan = licenses.license_matches(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange|Cartesian", plan)


def test_edge_cases(edges, no_docs):
    got = licenses.license_matches(edges).collect()
    assert [(r.doc_id, r.license, r.dice) for r in got] == [(550, "MIT", 1.0)]
    assert licenses.license_matches(no_docs).count() == 0


def brute_windows(text, threshold=licenses.THRESHOLD):
    """Every window of every template, compared with sets."""
    words = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    texts = licenses.template_texts(licenses.ALL_TEMPLATES)
    taken, found = [], []
    lines = re.sub(r"[^a-z0-9\n]+", " ", text.lower())
    for u in {" ".join(x.split()) for x in [lines, *re.split(r"\n ?\n", lines),
                                            *lines.split("\n")]}:
        own, w = set(licenses.word_pairs(u)), u.split()
        best = max(((2 * len(own & set(licenses.bigrams(t))) / (len(own) + len(
            licenses.bigrams(t))), n) for n, t in texts if own), default=(0, ""))
        if best[0] >= threshold:
            taken += [(*best, i, i + len(w) - 1) for i in range(len(words))
                      if words[i:i + len(w)] == w]
    for name, t in texts:
        g = set(licenses.bigrams(t))
        most = int(len(licenses.word_pairs(t)) * (2 - threshold) / threshold + 1e-9)
        for s in [i for i, x in enumerate(pairs) if x in g]:
            ends = [e for e in range(s, min(len(pairs), s + most)) if pairs[e] in g]
            own = [set(pairs[s:e + 1]) for e in ends]
            found.append(max((2 * len(o & g) / (len(o) + len(g)), name, -s, -e - 1)
                             for o, e in zip(own, ends, strict=True)))
    kept = []
    for d, name, s, e in sorted((x for x in found if x[0] >= threshold), reverse=True):
        told = any(a <= -e and -s <= b and (n == name or c >= d) for c, n, a, b in taken)
        if not told and all(-e < a or b < -s for *_, a, b in kept):
            kept.append((name, round(d, 6), -s, -e))
    return {(" ".join(words[a:b + 1]), n, d) for n, d, a, b in kept}


def test_notices_that_share_their_line_or_paragraph(spark):
    apache = licenses.TEMPLATES[1][1]
    code = "\nimport os\n" + "\n".join(f"value{i} = read(name{i}, of the {i})" for i in range(60))
    want = {
        "Copyright 2020 Foo. Released under the MIT License.": ["MIT"],
        "(c) 2020 Foo. Licensed under CC BY 4.0. Contact us": ["CC-BY-4.0"],
        "# " + re.sub(r"\s*\n\s*", "\n# ", apache) + code: ["Apache-2.0"],
        "Foo 1. " + licenses.GNU.format("library", "Lesser", 2.1) + code: ["LGPL-2.1"],
        "Bar is free. " + licenses.TEMPLATES_MORE[-2][1] + code: ["Zlib"],
        "A b c. Licensed under CC BY 4.0. Some other words. It is released under the MIT "
        "license. And again, released under MIT license, as was said": ["CC-BY-4.0", "MIT"],
        "intro\nReleased under the MIT License.\nno more of it at all here": [],
        "none of the words of a license to be found in the text": [],
    }
    df = spark.createDataFrame(list(enumerate(want)), "doc_id long, text string")
    known = licenses.Templates(licenses.ALL_TEMPLATES, licenses.THRESHOLD)
    got: dict[int, set] = {}
    for r in licenses.license_windows(df, known).collect():
        got.setdefault(r.doc_id, set()).add((r.passage, r.license, r.dice))
    for i, (text, names) in enumerate(want.items()):
        assert got.get(i, set()) == brute_windows(text), text
        assert sorted({n for _, n, _ in got.get(i, set())}) == names, text
    matches = {r.doc_id for r in licenses.license_matches(df).collect()}
    assert matches == set(range(7))


def test_siblings_are_told_apart(spark):
    texts = licenses.TEMPLATES_MORE
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)],
                               "doc_id long, text string")
    best: dict[int, tuple] = {}
    for r in licenses.license_matches(df).collect():
        best[r.doc_id] = max(best.get(r.doc_id, (0, "")), (r.dice, r.license))
    assert best == {i: (1.0, n) for i, (n, _) in enumerate(texts)}


def test_many_notices_in_one_text(spark):
    apache = " ".join(licenses.TEMPLATES[1][1].split())
    notes = ["As was said, it is released under the MIT license by Foo {}", "Licensed under CC BY 4.0.",
             "The words of {} licensed under the MIT license. Released under the MIT license", apache,
             "value {} of the license, of the terms", "GNU General Public License, version {}"]
    text = "".join(notes[i * i % 7 % 6].format(i) + " \n"[i % 5 % 2] for i in range(220))
    known = licenses.Templates(licenses.ALL_TEMPLATES, licenses.THRESHOLD)
    assert len(text.split()) > 3 * known.block
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = {(r.passage, r.license, r.dice) for r in licenses.license_windows(df, known).collect()}
    assert got == brute_windows(text) and len(got) == 3


def test_sql_tells_the_passages_of_all_templates(spark, tmp_path):
    texts = [f"words before it\n{' '.join(t.split())}\n\nand after it" for _, t in
             licenses.ALL_TEMPLATES] + [None, "", "a line", "Licensed under CC BY 4.0"]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string") \
        .coalesce(1).write.parquet(path)
    known = licenses.Templates(licenses.ALL_TEMPLATES, licenses.THRESHOLD)
    docs = spark.read.parquet(path)
    windows = {tuple(r) for r in licenses.license_windows(docs, known).collect()}
    got = {tuple(r) for r in licenses.license_matches(docs).collect()} - windows
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    assert got == set(con.execute(licenses.oracle()).fetchall()) and len(got) > len(texts) - 5
