import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyarrow import orc
from tokenizers import Tokenizer

from odpanel.llm import token_orc
from odpanel.llm.queries import word_tokenizer
from odpanel.session import shared_dir


def brute(rows):
    tok, start, out = Tokenizer.from_file(word_tokenizer()), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_words_encode_as_whole_texts(name):
    rng = random.Random(3)
    letters = "abcXYZ éÉßÄ.,!?;:'s't 'll 12٣́̇İΣς漢\x1c\x85\n\t\x0b"
    parts = ["<|endoftext|>", "<|startoftext|>", "Don't.", "é.", "É,", "ΟΔΟΣ.", "can't!!!", "×."]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += [" ".join(rng.choice(parts) for _ in range(6)) for _ in range(500)] + [""]
    raw = pa.array([*texts, None], pa.string())
    path = public_tokenizers.path(name)
    cached, whole = token_orc.Encoder(path, 2), token_orc.Encoder(path, 2, whole=True)
    assert (cached.cache is not None) == (name == "word_bpe_49k.json")
    assert cached.cache is None or cached.cache.model is not None
    want = lists(whole(raw))
    assert len(want) == len(raw) and want[-1] == [2]
    assert lists(cached(raw)) == want == lists(cached(raw))
    assert lists(cached(raw.slice(5, 100))) == want[5:105]     # a slice keeps its offsets
    assert lists(cached(raw.slice(0, 0))) == []


def lists(got):
    ids, bounds = got
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def test_words_come_back_from_the_older_generation(monkeypatch):
    """A cache far smaller than the words met gives the same ids."""
    monkeypatch.setattr(token_orc, "CACHE_BYTES", 20_000)
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeé.,") for _ in range(rng.randint(1, 7)))
             for _ in range(900)]
    path = public_tokenizers.path("word_bpe_49k.json")
    cached, whole = token_orc.Encoder(path, 2), token_orc.Encoder(path, 2, whole=True)
    turns = 0
    for k in range(60):
        texts = pa.array([" ".join(rng.choices(words[k * 10:k * 10 + 300], k=80))])
        before = cached.cache.words
        assert lists(cached(texts)) == lists(whole(texts))
        turns += cached.cache.words is not before
    assert turns > 3
    assert len(cached.cache.words) + len(cached.cache.older) < 1500


def test_one_id_on_many_rows_is_spread(spark):
    """A third of all rows without a doc_id: parted by how the texts begin."""
    rng = random.Random(9)
    rows = [(None if i % 3 else i, f"{rng.random()} text {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    path = shared_dir(spark, "spread")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_orc.write_tokens(df.repartition(8), path, word_tokenizer())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = token_orc.read_tokens(spark, path).filter("doc_id IS NULL").groupBy("part").count()
    assert parts.count() >= 2 and max(r["count"] for r in parts.collect()) < 1500


def test_index_matches_brute_force(docs):
    got = token_orc.token_output(docs.repartition(5), word_tokenizer()).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute([(r.doc_id, r.text)
                                                           for r in docs.collect()]))


def test_files_prune_and_split(spark, docs, tmp_path):
    path = str(tmp_path / "orc")
    token_orc.write_tokens(docs, path, word_tokenizer())
    found = token_orc.read_tokens(spark, path, [7, 150])
    assert sorted(r.doc_id for r in found.collect()) == [7, 150]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(doc_id" in plan or "In(doc_id, [7,150])" in plan
    files = sorted(p for p in (tmp_path / "orc").iterdir() if p.suffix == ".orc")
    ids = [i for p in files for i in orc.ORCFile(str(p)).read(columns=["doc_id"])
           .column("doc_id").to_pylist()]
    assert ids == sorted(ids) and len(ids) == docs.count()
    assert orc.ORCFile(str(files[0])).row_index_stride == token_orc.STRIDE


def test_edge_cases(spark, edges, no_docs):
    got = token_orc.token_output(edges, word_tokenizer()).collect()
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    want = brute(rows)
    assert sorted(r[1:] for r in want) == sorted((r.start, r.n_tokens, r.ids_crc32) for r in got)
    assert min(got, key=lambda r: r.start).doc_id is None
    assert token_orc.token_output(no_docs, word_tokenizer()).count() == 0
    assert shared_dir(spark, "x") != shared_dir(spark, "x")
