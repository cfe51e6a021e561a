import hashlib

import pytest
import zstandard

from odpanel.llm import warc_zstd as wz
from odpanel.session import shared_dir


def brute(rows):
    first: dict[str, int] = {}
    for page, html in rows:
        d = hashlib.sha256((html or "").encode()).hexdigest()
        if page is not None:
            first[d] = min(first.get(d, page), page)
    out = []
    for page, html in rows:
        raw = (html or "").encode()
        d = hashlib.sha256(raw).hexdigest()
        again = len(raw) >= 100 and first.get(d, page) != page
        out.append((page, len(raw), d, "revisit" if again else "response",
                    first[d] if again else None))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    rows += [(1000 + p, u, h) for p, u, h in rows[:20]] + [(2000, None, None), (2001, "a b\r\n", ""),
                                                           (2002, "x", "ü" * 49), (2003, "x", "ü" * 50),
                                                           (2004, "y", "ü" * 49), (2005, "y", "ü" * 50),
                                                           (2006, "z", "q" * 3_000_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder = f"file://{tmp_path}/warc"
    got = wz.archive_pages(df, folder).collect()
    assert sorted(map(tuple, got), key=str) == brute([(p, h) for p, _, h in rows])
    index = wz.write_archives(df, f"file://{tmp_path}/again").collect()
    html = {p: h for p, _, h in rows}
    plain = {r.page_id: r for r in got}
    for r in index[:10]:
        rec = wz.parse(wz.read_record(f"{tmp_path}/again/{r.file}", r.offset, r.length))
        assert rec["page_id"] == r.page_id
        if plain[r.page_id].record_type == "response":
            assert rec["payload"].decode() == (html[r.page_id] or "")


def test_archive_layout(tmp_path):
    records = [wz.record(i, "http://a/", f"<html>{i} some common text</html>".encode() * 20,
                         hashlib.sha256(f"<html>{i} some common text</html>".encode() * 20)
                         .hexdigest(), None) for i in range(200)]
    trained = wz.train_dictionary(records)
    archive = wz.Archive(str(tmp_path), "a.warc.zst", 1, trained)
    places = [archive.add(r) for r in records]
    archive.close()
    raw = (tmp_path / "a.warc.zst").read_bytes()
    assert raw[:4] == (0x184D2A5D).to_bytes(4, "little")
    assert raw[8:8 + len(trained)] == trained
    assert list(wz.read_archive(str(tmp_path / "a.warc.zst"))) == records
    with pytest.raises(zstandard.ZstdError):      # a record needs the dictionary
        zstandard.ZstdDecompressor().decompress(raw[places[0][0]:sum(places[0])],
                                                max_output_size=1 << 20)


def test_damage_is_noticed(tmp_path):
    good = wz.record(1, None, b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    assert wz.parse(good)["payload"] == b"payload"
    with pytest.raises(ValueError):
        wz.parse(good.replace(b"payload\r", b"paYload\r"))
    with pytest.raises(ValueError):
        wz.parse(good[:-2])


def test_edge_cases(spark):
    rows = [(None, "u", "x" * 200, 1), (5, "u", "x" * 200, 1), (5, "u", "x" * 200, 1),
            (4, "u", "x" * 200, 1), (6, None, None, None), (None, "v", "y" * 200, 2),
            (None, "w", "y" * 200, 2), (None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    got = [tuple(r) for r in wz.archive_pages(df).collect()]
    assert sorted(got, key=str) == brute([(p, h) for p, _, h, _ in rows])
    assert wz.archive_pages(df.limit(0)).count() == 0
    assert shared_dir(spark, "warc")


def test_copies_of_a_hot_payload_are_dealt_out(spark, monkeypatch):
    """A third of all pages share a payload: salted, whole, named by one page."""
    monkeypatch.setattr(wz, "HOT_COPIES", 50)
    rows = [(i, f"http://h/{i}", "same page " * 30 if i % 3 == 0 else f"page {i} " * 20)
            for i in range(900)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = [tuple(r) for r in wz.archive_pages(df).collect()]
    assert sorted(got, key=str) == brute([(p, h) for p, _, h in rows])
