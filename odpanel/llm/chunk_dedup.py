"""Substring dedup by content-defined chunking.

A gear hash rolls over the bytes of a text: h = (h << 1) + GEAR[byte], of
which 32 bits are kept, so it depends on the last 32 bytes alone. A cut
follows each byte where the top ``MASK_BITS`` bits are zero, at least
``MIN_CHUNK`` bytes after the cut before; a chunk of ``MAX_CHUNK`` bytes is
cut anyway. Cuts depend on nearby content only, so an insertion moves the
chunks around it and no others.

Chunks are compared by 96 bits of their XXH3 digest over all documents. One
copy of each chunk is kept: the first in the document of the smallest id.
Counts are summed before the shuffle; only digests that occur twice or more
meet the chunks again. Fewer than ``HOT_LIST`` digests can hold more than
that part of all repeated chunks: these are broadcast as a list and salted, so
a passage that stands in very many documents is spread over the join's tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from odpanel.llm.common import byte_slices, stored
from odpanel.operators.flows import salts_of

MASK_BITS = 4          # a cut in every 16 bytes on average, after the minimum
MIN_CHUNK = 16
MAX_CHUNK = 256
WINDOW = 32            # bytes the kept hash bits depend on
MIN_REGION = 96        # bytes of adjacent repeated chunks that count as a repeat
HOT_LIST = 1000        # a digest is salted if it holds over 1/1000 of the repeated chunks
NO_ID = 1 << 62        # numbers from here on stand for documents without id
SEED = 0x9E3779B97F4A7C15


def gear_table(seed: int = SEED) -> np.ndarray:
    """256 pseudo-random 32-bit numbers by the splitmix rule."""
    out, state, mask = [], seed, (1 << 64) - 1
    for _ in range(256):
        state = (state + 0x9E3779B97F4A7C15) & mask
        z = state
        z = ((z ^ z >> 30) * 0xBF58476D1CE4E5B9) & mask
        z = ((z ^ z >> 27) * 0x94D049BB133111EB) & mask
        out.append((z ^ z >> 31) >> 32)
    return np.array(out, np.uint32)


GEAR = gear_table()
GEAR[0] = 0            # zero bytes leave no trace in the hash


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte, by doubling the span summed."""
    h = GEAR[data]
    span = 1
    while span < WINDOW:
        out = h.copy()
        out[span:] += h[:-span] << np.uint32(span)
        h, span = out, span * 2
    return h


def cuts(candidates: list[int], begin: int, end: int) -> list[int]:
    """Ends of the chunks of the bytes begin..end, given the positions at
    which the hash allows a cut."""
    out, at = [], begin
    for c in candidates:
        while c - at > MAX_CHUNK:
            at += MAX_CHUNK
            out.append(at)
        if c - at >= MIN_CHUNK:
            out.append(c)
            at = c
    while end - at > MAX_CHUNK:
        at += MAX_CHUNK
        out.append(at)
    if at < end:
        out.append(end)
    return out


def chunk_texts(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray,
                                                    np.ndarray]:
    """(text number, start, length, digest as two longs) of the texts' chunks."""
    # WINDOW zero bytes, whose gear is 0, stand before each text: the hash
    # forgets the text before it
    pad = bytes(WINDOW)
    joined = b"".join(pad + (t or b"") for t in texts)
    sizes = np.array([len(t or b"") for t in texts], np.int64)
    ends = np.cumsum(sizes + WINDOW)
    begins = ends - sizes
    allowed = np.flatnonzero(gear_hashes(np.frombuffer(joined, np.uint8))
                             >> np.uint32(32 - MASK_BITS) == 0) + 1
    low, high = np.searchsorted(allowed, begins), np.searchsorted(allowed, ends, "right")
    owner, stops = [], []
    for i, (b, e) in enumerate(zip(begins.tolist(), ends.tolist(), strict=True)):
        got = cuts(allowed[low[i]:high[i]].tolist(), b, e)
        owner += [i] * len(got)
        stops += got
    own, stop = np.array(owner, np.int64), np.array(stops, np.int64)
    start = np.concatenate([[0], stop[:-1]])[:len(stop)]
    first = np.concatenate([[True], own[1:] != own[:-1]])[:len(own)]
    start[first] = begins[own[first]]
    digest = xxhash.xxh3_128_digest
    digests = b"".join([digest(joined[a:b]) for a, b in zip(start.tolist(), stops, strict=True)])
    return own, start - begins[own], stop - start, np.frombuffer(digests, ">i8").reshape(-1, 2)


def identity() -> dict[str, Column]:
    """What tells documents apart: ``oid`` is the id, or for rows without one
    a number from the text; ``txt`` is a hash of the text, which parts the
    texts that stand under one id."""
    text = F.xxhash64(F.col("text").cast("string"))
    return {"oid": F.coalesce(F.col("doc_id").cast("long"),
                              text.bitwiseAND(F.lit(NO_ID - 1)) + F.lit(NO_ID)),
            "txt": text}


def chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, oid, txt, start, length, hi, lo, again): the chunks of every
    text in bytes of its UTF-8 form, with 96 bits of the digest; ``again``
    marks a chunk that the same text holds before. Null and empty texts have
    none. Equal rows of one Arrow batch are cut into chunks once."""
    names = ["doc_id", "oid", "txt", "start", "length", "hi", "lo", "again"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pd.DataFrame({c: batch.column(c).to_numpy() for c in ("oid", "txt")})
            batch = batch.filter(pa.array(~ids.duplicated().to_numpy()))
            for rows, texts in byte_slices(batch, "text", 1 << 20):
                owner, start, length, digest = chunk_texts(texts)
                hi, lo = digest[:, 0].astype(np.int64), digest[:, 1].astype(np.int32)
                again = pd.DataFrame({"o": owner, "h": hi, "l": lo}).duplicated().to_numpy()
                own = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(c).take(own) for c in names[:3]],
                     pa.array(start.astype(np.int32)), pa.array(length.astype(np.int32)),
                     pa.array(hi), pa.array(lo), pa.array(again)], names)

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      *[c.alias(n) for n, c in identity().items()],
                      F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, oid long, txt long, start int, length int, "
                               "hi long, lo int, again boolean")


def shared_digests(table: DataFrame) -> DataFrame:
    """(hi, lo, first_doc, first_oid, n, hot) of the digests that occur in two
    documents or twice in one text, as a stored table. Fewer than
    ``HOT_LIST`` of them are hot: their counts add up to the whole."""
    spark = table.sparkSession
    shared = stored(spark, table.groupBy("hi", "lo").agg(
        F.min("doc_id").alias("first_doc"), F.min("oid").alias("first_oid"),
        F.max("oid").alias("last_oid"), F.max("again").alias("again"),
        F.count(F.lit(1)).alias("n"))
        .filter("first_oid <> last_oid or again").drop("last_oid", "again"), "digests")
    whole = shared.agg(F.sum("n")).first()[0] or 0
    return shared.withColumn("hot", F.col("n") * HOT_LIST > F.lit(whole))


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, oid, txt, start, end, first_doc, kept) of the chunks that
    occur more than once; ``kept`` marks the copies that stay."""
    table = chunks(docs)
    shared = shared_digests(table)
    salts = salts_of(docs.sparkSession)
    hot = F.broadcast(shared.filter("hot").select("hi", "lo", "hot"))   # < HOT_LIST rows
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), "oid", "txt", "start"), F.lit(salts))
    dealt = table.join(hot, ["hi", "lo"], "left").withColumn(
        "salt", F.when(F.col("hot"), salt).otherwise(F.lit(0)).cast("int")).drop("hot")
    copies = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(salts - 1))) \
        .otherwise(F.array(F.lit(0)))
    looked = shared.select("hi", "lo", "first_doc", "first_oid", F.explode(copies).alias("salt"))
    return dealt.join(looked, ["hi", "lo", "salt"]).select(
        "doc_id", "oid", "txt", F.col("start").cast("long").alias("start"),
        (F.col("start") + F.col("length")).cast("long").alias("end"), "first_doc",
        ((F.col("oid") == F.col("first_oid")) & ~F.col("again")).alias("kept"))


def _spans(docs: DataFrame, min_region: int) -> DataFrame:
    # by text from here on: its chunks are bounded by its size
    hits = repeated_chunks(docs).repartition("oid", "txt").groupBy("oid", "txt", "start").agg(
        F.max("doc_id").alias("doc_id"), F.max("end").alias("end"),
        F.min("first_doc").alias("first_doc"), F.max("kept").alias("kept"))
    w = Window.partitionBy("oid", "txt").orderBy("start")
    apart = F.coalesce(F.lag("end").over(w) != F.col("start"), F.lit(True))
    turns = apart | (F.lag("kept").over(w) != F.col("kept"))
    runs = hits.select("*", apart.cast("long").alias("apart"), turns.cast("long").alias("turns")) \
        .select("*", F.sum("apart").over(w).alias("region"), F.sum("turns").over(w).alias("span"))
    spans = runs.groupBy("oid", "txt", "region", "span").agg(
        F.max("doc_id").alias("doc_id"), F.min("start").alias("start"),
        (F.max("end") - F.min("start")).alias("length"), F.count(F.lit(1)).alias("n_chunks"),
        F.max("kept").alias("kept"), F.min("first_doc").alias("first_doc"))
    whole = Window.partitionBy("oid", "txt", "region")
    return spans.select("*", F.min("start").over(whole).alias("region_start"),
                        F.sum("length").over(whole).alias("region_length")) \
        .filter(F.col("region_length") >= min_region)


def repeated_regions(docs: DataFrame, min_region: int = MIN_REGION) -> DataFrame:
    """(doc_id, start, length, n_chunks, kept, region_start, region_length,
    first_doc): the spans, in bytes, of the maximal runs of adjacent chunks,
    ``min_region`` bytes together at least, each of which occurs in more than
    one document or more than once in its text.

    A run is cut where copies that stay (``kept``) meet copies that go, so
    the rows say which bytes a dedup removes. The copy that stays is the first
    one in the document of the smallest doc_id (documents without id come
    last); first_doc is the smallest doc_id that holds a chunk of the span,
    null if none has an id. Texts under one doc_id count as one document:
    they are not held against each other. Equal rows count once; rows without
    id are documents of their own if their texts differ. Null and empty texts
    and empty tables give no rows; other columns are not read."""
    return _spans(docs, min_region).select(
        "doc_id", "start", "length", "n_chunks", "kept", "region_start", "region_length",
        "first_doc")


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the spans (start, length), which are in order. A
    character that a span holds in part stays whole."""
    out, at = [], 0
    for start, length in spans:
        end = start + length
        while start < end and text[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(text) and text[end] & 0xC0 == 0x80:
            end -= 1
        out.append(text[at:start])
        at = end
    return b"".join([*out, text[at:]])


def remove_repeats(docs: DataFrame, min_region: int = MIN_REGION) -> DataFrame:
    """All rows and columns of ``docs``; ``text`` is what remains of it when
    the spans of ``repeated_regions`` that are not kept are taken out. At
    least one copy of every chunk stays. Null texts stay null, rows without id
    and repeated rows stay; a text of repeats alone becomes empty."""
    gone = _spans(docs, min_region).filter("not kept").groupBy("oid", "txt").agg(
        F.sort_array(F.collect_list(F.struct("start", "length"))).alias("__gone"))
    gone = stored(docs.sparkSession, gone.withColumnsRenamed({"oid": "__oid", "txt": "__txt"}),
                  "spans")

    @F.pandas_udf("string")
    def remaining(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([
            t if t is None or s is None
            else cut_spans(t.encode(), [(x["start"], x["length"]) for x in s]).decode()
            for t, s in zip(text, spans, strict=True)], dtype=object)

    keyed = docs.withColumns({f"__{n}": c for n, c in identity().items()})
    return keyed.join(gone, ["__oid", "__txt"], "left").withColumn(
        "text", remaining(F.col("text").cast("string"), F.col("__gone"))) \
        .select(*[F.col(c) for c in docs.columns])
