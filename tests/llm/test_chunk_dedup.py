import random
from itertools import groupby

from odpanel.llm import chunk_dedup as cd
from tests.llm.conftest import words


def brute_chunks(text):
    out, at, h = [], 0, 0
    for i, b in enumerate(text):
        h = ((h << 1) + int(cd.GEAR[b])) & 0xFFFFFFFF
        size = i + 1 - at
        if (size >= cd.MIN_CHUNK and h >> (32 - cd.MASK_BITS) == 0) or size == cd.MAX_CHUNK:
            out.append((at, size))
            at = i + 1
    return out + [(at, len(text) - at)] if at < len(text) else out


def test_chunks_match_a_byte_loop():
    rng = random.Random(1)
    texts = [words(rng, n).encode() for n in (0, 1, 3, 20, 200, 2000)] \
        + [None, b"", b"a" * 3000, bytes(500), b"abc"]
    owner, start, length, digest = cd.chunk_texts(texts)
    got = [[] for _ in texts]
    for i, a, n in zip(owner.tolist(), start.tolist(), length.tolist(), strict=True):
        got[i].append((a, n))
    assert got == [brute_chunks(t or b"") for t in texts]
    assert len(digest) == len(owner)


def test_an_insertion_moves_few_chunks():
    rng = random.Random(2)
    a = words(rng, 3000).encode()
    b = a[:9000] + b"inserted words" + a[9000:]
    _, _, _, d = cd.chunk_texts([a])
    _, _, _, e = cd.chunk_texts([b])
    same = set(map(bytes, d)) & set(map(bytes, e))
    assert len(same) >= 0.98 * len(d)


def brute_spans(rows, least=cd.MIN_REGION):
    """(doc_id, start, length, n_chunks, kept, region start, region length,
    first_doc) over rows of different ids."""
    holders = {}
    for i, t in sorted(rows):
        for a, n in brute_chunks(t):
            holders.setdefault(t[a:a + n], []).append((i, a))
    out = set()
    for i, t in rows:
        region = []
        for a, n in [*brute_chunks(t), (None, 0)]:
            own = holders[t[a:a + n]] if a is not None else []
            if len(own) > 1:
                region.append((a, n, own[0][0], own[0] == (i, a)))
            elif region:
                size = sum(x[1] for x in region)
                for kept, part in groupby(region, lambda x: x[3]) if size >= least else ():
                    part = list(part)
                    out.add((i, part[0][0], sum(x[1] for x in part), len(part), kept,
                             region[0][0], size, min(x[2] for x in part)))
                region = []
    return out


def test_regions_match_brute_force(spark, docs):
    rng = random.Random(3)
    line = words(rng, 80)
    inside = spark.createDataFrame(      # a passage three times in one text alone
        [(10 ** 6, f"{line} {words(rng, 30)} {line} {words(rng, 9)} {line}")],
        "doc_id long, text string")
    df = docs.select("doc_id", "text").union(inside)
    want = brute_spans([(r.doc_id, r.text.encode()) for r in df.collect()])
    got = [tuple(r) for r in cd.repeated_regions(df).collect()]
    assert {x[4] for x in want} == {True, False} and any(x[0] == 10 ** 6 for x in want)
    assert len(got) == len(set(got)) and set(got) == want


def test_one_copy_of_every_chunk_remains(spark, docs):
    rows = {r.doc_id: r.text.encode() for r in docs.collect()}
    left = {r.doc_id: r.text.encode() for r in cd.remove_repeats(docs).collect()}
    assert left.keys() == rows.keys()
    gone = {}
    for i, start, length, _, kept, *_ in brute_spans(list(rows.items())):
        if not kept:
            gone.setdefault(i, []).append((start, length))
    assert gone and left == {i: cd.cut_spans(t, sorted(gone.get(i, ()))) for i, t in rows.items()}
    corpus = b"\xff".join(left.values())
    assert all(t[a:a + n] in corpus for t in rows.values() for a, n in brute_chunks(t))


def test_cuts_leave_whole_characters():
    text = "aä漢🙂b".encode()
    for start in range(len(text)):
        for length in range(1, len(text) - start + 1):
            left = cd.cut_spans(text, [(start, length)]).decode()
            assert "".join(c for c in "aä漢🙂b" if c in left) == left
    assert cd.cut_spans(text, [(0, 1), (3, 3)]).decode() == "ä🙂b"


def test_a_hot_passage_is_spread(spark):
    rng = random.Random(6)
    passage = words(rng, 60)
    rows = [(i, f"{passage} {words(rng, 20)}" if i % 3 == 0 else words(rng, 40))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    shared = cd.shared_digests(cd.chunks(df))
    assert shared.filter("n > 900 and not hot").count() == 0
    assert 0 < shared.filter("hot").count() < cd.HOT_LIST
    hits = cd.repeated_chunks(df)
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert "salt" in plan and "strategy=broadcast" in plan
    got = cd.repeated_regions(df)
    assert {r.doc_id for r in got.collect()} == set(range(0, 3000, 3))
    assert {r.doc_id for r in got.filter("kept").collect()} == {0}


def test_rows_without_id_and_texts_under_one_id_stay(spark):
    rng = random.Random(8)
    p, q, r = (words(rng, 60) for _ in range(3))
    rows = [(None, p), (None, q), (7, p), (7, r), (9, q), (9, q), (None, None), (1 << 62, r)]
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)],
                               "doc_id long, text string, oid int")
    left = {x.oid: (x.doc_id, x.text) for x in cd.remove_repeats(df).collect()}
    assert [left[k][0] for k in range(8)] == [i for i, _ in rows]
    assert [left[k][1] for k in range(8)] == ["", "", p, r, q, q, None, ""]
    got = {(x.doc_id, x.kept, x.first_doc) for x in cd.repeated_regions(df).collect()}
    assert got == {(None, False, 7), (None, False, 9), (7, True, 7), (9, True, 9),
                   (1 << 62, False, 7)}


def test_catches_long_passages_and_leaves_clean_texts(spark):
    rng = random.Random(4)
    rows, planted = [], set()
    for i in range(60):
        rows.append((i, words(rng, rng.randint(30, 300))))
    for k in range(30):
        passage = words(rng, 55)
        for j in (100 + 2 * k, 101 + 2 * k):
            rows.append((j, f"{words(rng, rng.randint(0, 90))} {passage} "
                            f"{words(rng, rng.randint(0, 90))}"))
            planted.add(j)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in cd.repeated_regions(df).collect()} == planted


def test_edge_cases(spark, edges, no_docs):
    got = cd.repeated_regions(edges).collect()
    assert {r.doc_id for r in got} >= {None, 0, 50, 200, 250}
    assert not {r.doc_id for r in got} & {100, 150}
    left = cd.remove_repeats(edges)
    assert left.columns == edges.columns and left.count() == edges.count()
    assert cd.repeated_regions(no_docs).count() == 0 and cd.remove_repeats(no_docs).count() == 0
