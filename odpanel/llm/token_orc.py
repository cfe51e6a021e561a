"""Token-ID output in ORC.

Documents are range-partitioned and sorted by doc_id, encoded with a public
tokenizer, and written as ORC: token ids as an integer list column (ORC's
run-length encoding v2), a row index every ``STRIDE`` rows and Bloom filters
on doc_id. Readers split files by stripe and prune stripes and row groups by
the doc_id statistics and filters (``read_tokens``).

Encoding: where the tokenizer never lets a pre-token span white space (seen
from its definition and probed, ``WordCache.usable``), the ids of a text are
those of its words one after the other; each different word then goes
through the tokenizers library once and is kept. Any other tokenizer encodes
whole texts.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from odpanel.llm.common import stored
from odpanel.session import shared_dir

END_ID = 2
STRIDE = 1000            # rows a row-index entry covers
STRIPE_BYTES = 16 << 20
CACHE_BYTES = 96 << 20   # of words that a worker holds in one generation, about
WORD_BYTES = 200         # of a word held, beside its ids and text
JOINED = 256             # words sent to the library in one text
PUNCTUATION = ".,!;:?"
RANGE_CHARS = 32         # of a text that part rows of one doc_id
SLICE_BYTES = 2 << 20    # text that a task encodes at once (one document at least)

_workers: dict[str, "Encoder"] = {}   # per Python worker: loaded once, words kept


class WordCache:
    """Ids of single words as little-endian int32 bytes, in two generations:
    when the younger is full it becomes the older, and what is met again comes
    back. Frequent words stay; those met once go with their generation."""

    def __init__(self, tok, spec: dict):
        self.tok = tok
        self.sep, self.sep_id = self._separator(tok, spec)
        self.lower = any(n.get("type") == "Lowercase" for n in _parts(spec, "normalizer"))
        self.model = self._letters_model(tok, spec)
        self.words: dict[bytes, bytes] = {b"": b""}
        self.older: dict[bytes, bytes] = {}
        self.held = 0

    @staticmethod
    def usable(spec: dict) -> bool:
        """No normalizer or pre-tokenizer step looks across white space."""
        if any(n.get("type") not in ("NFC", "Lowercase") and not (
                n.get("type") == "Replace" and n.get("pattern") == {"Regex": r"\s+"}
                and n.get("content") == " ") for n in _parts(spec, "normalizer")):
            return False
        if any(t.get("lstrip") or t.get("rstrip") for t in spec.get("added_tokens") or []):
            return False
        steps = _parts(spec, "pre_tokenizer")
        if not steps or steps[0].get("type") != "Split" or any(
                s.get("type") != "ByteLevel" or s.get("add_prefix_space") or s.get("use_regex")
                for s in steps[1:]):
            return False
        first = steps[0]
        pattern = (first.get("pattern") or {}).get("Regex")
        if not pattern or not first.get("invert") or first.get("behavior") != "Removed":
            return False
        probe = "".join(f"a{w}b 1{w}2 .{w}, '{w}s{w}{w}é{w}" for w in " \t\n\v\f\r")
        found = regex.findall(pattern, probe)
        ends = regex.findall(pattern, "ab.,!;:?")
        return not any(set(x) & set(" \t\n\v\f\r") for x in found) and ends == ["ab", ".,!;:?"]

    @staticmethod
    def _separator(tok, spec: dict) -> tuple[str, int]:
        """A special token that stands between words sent together."""
        for t in spec.get("added_tokens") or []:
            got = tok.encode(f"ab{t['content']}cd", add_special_tokens=False).ids
            want = tok.encode("ab", add_special_tokens=False).ids + [t["id"]] \
                + tok.encode("cd", add_special_tokens=False).ids
            if got == want:
                return t["content"], t["id"]
        return "", -1

    @staticmethod
    def _letters_model(tok, spec: dict):
        """The tokenizer's model if ASCII letters reach it as they are, one
        pre-token a word (seen from the pattern and probed), else None."""
        letters = ascii_lowercase + ascii_uppercase
        pattern = _parts(spec, "pre_tokenizer")[0]["pattern"]["Regex"]
        lower = any(n.get("type") == "Lowercase" for n in _parts(spec, "normalizer"))
        probe = [letters * 2, *letters, *(a + b + "st" for a in letters for b in letters)]
        for w in probe:
            sent = w.lower() if lower else w
            if regex.findall(pattern, sent) != [sent] or [
                    t.id for t in tok.model.tokenize(sent)] != tok.encode(
                        w, add_special_tokens=False).ids:
                return None
        return tok.model

    def _encode(self, cores: list[bytes]) -> None:
        """Hold the ids of ``cores``: plain words of ASCII letters go straight
        to the model, the others through the whole tokenizer."""
        if self.model is not None:
            whole = []
            for c in cores:
                if c.isalpha():     # of bytes: ASCII letters only
                    ids = [t.id for t in self.model.tokenize(c.decode("ascii"))]
                    self.words[c] = struct.pack(f"<{len(ids)}i", *ids)
                else:
                    whole.append(c)
            cores = whole
        texts = [c.decode("utf-8", "replace") for c in cores]
        alone = [i for i, t in enumerate(texts) if not self.sep or self.sep in t]
        for i, e in zip(alone, self.tok.encode_batch_fast([texts[i] for i in alone],
                                                          add_special_tokens=False), strict=True):
            self.words[cores[i]] = np.array(e.ids, "<i4").tobytes()
        odd = set(alone)
        rest = [i for i in range(len(texts)) if i not in odd] if odd else range(len(texts))
        groups = [rest[k:k + JOINED] for k in range(0, len(rest), JOINED)]
        joined = [self.sep.join([texts[i] for i in g]) for g in groups]
        for g, e in zip(groups, self.tok.encode_batch_fast(joined, add_special_tokens=False),
                        strict=True):
            ids = np.array(e.ids, "<i4")
            cut = np.flatnonzero(ids == self.sep_id) * 4
            data, begin = ids.tobytes(), 0
            for i, end in zip(g, [*cut.tolist(), len(data)], strict=True):
                self.words[cores[i]] = data[begin:end]
                begin = end + 4

    def ids(self, cores: list[bytes]) -> list[bytes]:
        """The ids of different words. A full generation becomes the older
        one before, so that the answer stands in the younger one whole."""
        if self.held > CACHE_BYTES:
            self.older, self.words, self.held = self.words, {b"": b""}, 0
        words, older = self.words, self.older
        got = list(map(words.get, cores))
        if None in got:
            unknown = [c for c, i in zip(cores, got, strict=True) if i is None]
            if older:
                back = {c: older[c] for c in unknown if c in older}
                words.update(back)
                new = [c for c in unknown if c not in back]
            else:
                new = unknown
            self._encode(new)
            self.held += len(unknown) * WORD_BYTES + 2 * sum(map(len, unknown))
            got = list(map(words.__getitem__, cores))
        return got

    def split(self, words: pa.StringArray) -> tuple[pa.Array, pa.Array]:
        """Core and tail of each word: trailing punctuation after a Latin
        letter is a pre-token of its own; ASCII cores are lower-cased where
        the normalizer does so (special tokens hold a ``<`` and are left)."""
        tailed = pc.match_substring_regex(words, f"[A-Za-zÀ-ÖØ-öø-ÿ][{PUNCTUATION}]+$")
        cores = pc.if_else(tailed, pc.ascii_rtrim(words, PUNCTUATION), words)
        tails = pc.if_else(tailed, pc.extract_regex(words, f"(?P<t>[{PUNCTUATION}]+)$")
                           .field("t"), "")
        if self.lower:
            plain = pc.and_not(pc.string_is_ascii(cores), pc.match_substring(cores, "<"))
            cores = pc.if_else(plain, pc.ascii_lower(cores), cores)
        return cores, pc.fill_null(tails, "")

    def word_ids(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of different words, one after the other."""
        coded = [x.dictionary_encode() for x in self.split(words)]
        known = [self.ids(c.dictionary.cast(pa.large_binary()).to_pylist()) for c in coded]
        size = np.fromiter((len(x) for k in known for x in k), np.int64) // 4
        pieces = np.empty(2 * len(words), np.int64)
        pieces[0::2] = coded[0].indices.to_numpy()
        pieces[1::2] = coded[1].indices.to_numpy() + len(known[0])
        ids, n = _gather(np.frombuffer(b"".join([x for k in known for x in k]), "<i4"),
                         size, pieces)
        return ids, n[0::2] + n[1::2]


def _gather(blob: np.ndarray, size: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs ``at`` of a row of runs of the given sizes, one after the other,
    and their sizes."""
    n = size[at]
    skip = (np.cumsum(size) - size)[at] - (np.cumsum(n) - n)
    return blob[np.repeat(skip, n) + np.arange(n.sum())], n


def _parts(spec: dict, key: str) -> list[dict]:
    x = spec.get(key)
    if not x:
        return []
    return x.get("normalizers") or x.get("pretokenizers") or [x]


class Encoder:
    """Token ids of texts with the end id, from an Arrow string column."""

    def __init__(self, path: str, end_id: int, whole: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.end = end_id
        spec = json.loads(self.tok.to_str())
        self.cache = None if whole or not WordCache.usable(spec) else WordCache(self.tok, spec)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): those of text i are ids[bounds[i]:bounds[i + 1]]."""
        if self.cache is None:
            got = self.tok.encode_batch_fast(
                [(t or b"").decode("utf-8", "replace") for t in texts.cast(pa.large_binary())
                 .to_pylist()], add_special_tokens=False)
            lists = [np.array([*e.ids, self.end], "<i4") for e in got]
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)])
            return np.concatenate([np.empty(0, "<i4"), *lists]), bounds
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = split.flatten().dictionary_encode()
        ids, n = _gather(*self.cache.word_ids(coded.dictionary), coded.indices.to_numpy())
        upto = np.concatenate([[0], np.cumsum(n)])
        offsets = split.offsets.to_numpy().astype(np.int64)
        ends = upto[offsets[1:] - offsets[0]]
        return (np.insert(ids, ends, self.end),
                np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]))


def encoder(path: str, end_id: int) -> Encoder:
    key = f"{path}:{end_id}"
    if key not in _workers:
        _workers[key] = Encoder(path, end_id)
    return _workers[key]


def _slices(batch: pa.RecordBatch, texts: pa.Array) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``SLICE_BYTES`` of text, one row at least."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        held = upto[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(upto, held + SLICE_BYTES, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID,
                 stride: int = STRIDE, stripe_bytes: int = STRIPE_BYTES) -> None:
    """Write ORC files (part, seq, doc_id, n_tokens, ids) in ascending doc_id
    order: files by part, rows by seq inside a part. Null texts count as
    empty; a null doc_id sorts first; rows of equal doc_id stand together,
    ordered by text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, seq, part = encoder(tokenizer_path, end_id), 0, TaskContext.get().partitionId()
        for batch in batches:
            for rows in _slices(batch, batch.column(1)):
                (ids, bounds), n = enc(rows.column(1)), rows.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(seq, seq + n)),
                     rows.column(0), pa.array(np.diff(bounds)),
                     pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))],
                    ["part", "seq", "doc_id", "n_tokens", "ids"])
                seq += n

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.col("text").cast("string").alias("text"))
    # equal ids are parted by how their texts begin, which keeps the order
    (src.repartitionByRange(F.col("doc_id").asc_nulls_first(),
                            F.substring("text", 1, RANGE_CHARS).asc_nulls_first())
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
     .mapInArrow(run, "part int, seq long, doc_id long, n_tokens long, ids array<int>")
     .write.option("orc.compress", "ZSTD").option("orc.create.index", "true")
     .option("orc.row.index.stride", str(stride)).option("orc.stripe.size", str(stripe_bytes))
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .orc(path))


SCHEMA = "part int, seq long, doc_id long, n_tokens long, ids array<int>"


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Documents of an output; ``doc_ids`` are looked up through the row
    indexes and Bloom filters (a pushed filter)."""
    df = spark.read.schema(SCHEMA).orc(path)
    return df if doc_ids is None else df.filter(F.col("doc_id").isin(doc_ids))


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the
    ORC files. start counts the ids of all documents before it: the sum over
    earlier parts plus the running sum inside its part, which is about one
    task's rows, so no task sees all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            at = ids.offsets.to_numpy().tolist()
            data = memoryview(np.ascontiguousarray(ids.values.to_numpy(), "<i4")).cast("B")
            crc = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.array(np.diff(at), pa.int64()), pa.array(crc, pa.int64())],
                ["part", "seq", "doc_id", "n_tokens", "ids_crc32"])

    files = read_tokens(spark, path)
    rows = files.select("part", "seq", "doc_id", "ids").mapInArrow(
        run, "part int, seq long, doc_id long, n_tokens long, ids_crc32 long")
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n"))
                          .alias("before"))  # one row per part
    run_sum = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq"))
    return (rows.withColumn("upto", run_sum).join(before, "part")
            .select("doc_id", (F.col("before") + F.col("upto") - F.col("n_tokens")).alias("start"),
                    "n_tokens", "ids_crc32"))


def token_output(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Write the documents' token ids to a fresh folder in the shared storage
    and return ``token_index`` of it. An empty table gives an empty result;
    other columns are not read."""
    spark = docs.sparkSession
    path = shared_dir(spark, "tokens")
    write_tokens(docs, path, tokenizer_path, end_id)
    return stored(spark, token_index(spark, path), "token-index")
