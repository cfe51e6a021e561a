import zlib

import numpy as np
import pytest

from odpanel.llm import langid

DOCS = "/root/testdata/sf0.01/documents.parquet"


@pytest.fixture(scope="module")
def predicted(spark):
    df = spark.read.parquet(DOCS)
    rows = {r.doc_id: r for r in langid.identify(df).collect()}
    return rows, {r.doc_id: r.lang for r in df.collect()}


def test_held_out_accuracy(predicted):
    rows, lang = predicted
    held = [r for r in rows.values() if r.held_out]
    assert {r.doc_id for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert np.mean([r.rejected for r in rows.values()]) <= 0.01


def test_foreign_text_is_rejected(spark):
    df = spark.read.parquet(DOCS)
    model = langid.train(langid.sample(df))
    odd = ["Это совсем другой язык, которого нет среди меток", "这是另一种语言的文本", "9 8 7 !", ""]
    new = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    got = {r.doc_id: r for r in langid.identify(new, model=model).collect()}
    assert all(r.rejected for r in got.values())
    assert got[2].lang_pred == got[3].lang_pred == langid.UNKNOWN


def test_ngrams_stay_inside_words():
    def grams(text):
        out = set()
        for n in langid.ORDERS:
            for i in range(len(text) - n + 1):
                g = text[i:i + n]
                if " " not in g[1:-1]:
                    out.add((n, i))
        return out

    norm = langid.normal("Ab, cde x\nÉtÉ")
    assert norm == " ab cde x été "
    got = {(n, int(i)) for n, (_, at) in zip(langid.ORDERS, langid.ngrams(norm), strict=True)
           for i in at}
    assert got == grams(norm)


def test_snippets_of_snippets_are_the_same():
    for n in (0, 5, 24, 25, 600, 5000):
        once = langid.snippets(" ".join(f"w{chr(97 + i % 26)}x" for i in range(n)))
        assert langid.snippets(" ".join(s.strip() for s in once)) == once
        assert len(once) <= langid.SNIPPETS


def test_prediction_does_not_depend_on_neighbours():
    rows = [(i, t, "ab"[i % 2]) for i, t in enumerate(["the cat sat", "der hund lief"] * 20)]
    model = langid.train(rows, epochs=2)
    texts = [r[1].encode() for r in rows[:7]] + [b"zz " * 40_000, None]
    together = langid._predict(model, texts)
    for i, t in enumerate(texts):
        lang, score, _ = langid._predict(model, [t])
        assert lang[0] == together[0][i] and abs(score[0] - together[1][i]) < 1e-5


def test_edge_cases(spark, edges, no_docs):
    got = langid.identify(edges).collect()
    assert len(got) == edges.count()
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (100, 150))
    assert not [r for r in got if r.doc_id is None][0].held_out
    kept = langid.drop_rejected(edges)
    assert kept.columns == edges.columns and kept.filter("doc_id in (100, 150)").count() == 0
    assert langid.identify(no_docs).count() == 0
    unlabelled = edges.withColumn("lang", edges["lang"].substr(9, 1).isNull().cast("string"))
    assert langid.identify(unlabelled.filter("false")).count() == 0
    none = langid.identify(spark.createDataFrame([(1, "abc", None)],
                                                 "doc_id long, text string, lang string")).first()
    assert none.lang_pred == "und" and none.rejected


def test_number_signs_are_no_letters(spark, docs):
    model = langid.train(langid.sample(docs))
    df = spark.createDataFrame([(1, "² ½ ①"), (2, "Ⅷ ⅷ 12 _"), (3, "the ² and")],
                               "doc_id long, text string")
    got = {r.doc_id: r for r in langid.identify(df, model=model).collect()}
    assert {got[i].lang_pred for i in (1, 2)} == {"und"} and got[3].lang_pred != "und"
    assert [got[i].score for i in (1, 2)] == [0.0, 0.0] and got[1].rejected


def test_the_sample_is_bounded_in_rows(spark, monkeypatch):
    """One doc_id on 3,000 rows, and more languages than are learned."""
    one = spark.createDataFrame([(2, f"text number {'abcdefghij'[i % 10]} {i}", "en")
                                 for i in range(3000)], "doc_id long, text string, lang string")
    assert 0 < len(langid.sample(one, 20)) <= 20
    same = spark.createDataFrame([(2, "text", "en")] * 3000,
                                 "doc_id long, text string, lang string")
    assert len(langid.sample(same, 20)) == 1
    monkeypatch.setattr(langid, "MAX_LANGS", 5)
    many = spark.createDataFrame([(i, "text", f"l{i % 300:03d}") for i in range(3000)],
                                 "doc_id long, text string, lang string")
    got = langid.sample(many, 4)
    assert len({r[2] for r in got}) == 5 and len(got) <= 20


def test_predictions_against_a_plain_loop(docs):
    """Each n-gram by itself over the same model, in plain Python."""
    model = langid.train(langid.sample(docs))

    def bucket(gram):
        h = (ord(gram[0]) + 1) & 0xFFFFFFFF
        for c in gram[1:]:
            h = (h * 0x01000193 & 0xFFFFFFFF) ^ (ord(c) + 1)
        return ((h + len(gram)) * 0x9E3779B1 & 0xFFFFFFFF) >> 16

    def plain(text):
        words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        total, n = np.zeros(len(model.langs)), 0
        for w in words:
            marked = f" {w} "
            for k in langid.ORDERS:
                for i in range(len(marked) - k + 1):
                    total += model.logits[bucket(marked[i:i + k])]
                    n += 1
        if not words:
            return "und", 0.0
        z = (total / max(n, 1) + model.bias) / model.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        return model.langs[int(p.argmax())], float(p.max())

    rows = docs.collect()
    got = {r.doc_id: r for r in langid.identify(docs, model=model).collect()}
    for r in rows:
        lang, score = plain(r.text or "")
        assert got[r.doc_id].lang_pred == lang
        assert abs(got[r.doc_id].score - score) < 1e-5
