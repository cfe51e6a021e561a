"""Benchmark decontamination by q-gram lemma filtering.

An item of m characters that occurs in a text with at most k edits shares at
least m - q + 1 - k*q q-grams with it, all on diagonals (text position minus
item position) at most k apart. Texts are read in slices; the q-grams they
share with the items are counted per item in overlapping diagonal bands of
2(k+1) diagonals, each beginning k+1 after the one before, so any occurrence
lies whole in a band. Bands that reach the lemma's bound are verified by
banded alignment (edit distance of the item against the best stretch of the
band's text). The edits of an item of 2q characters or more are clamped so
that its bound stays at one q-gram or more. Shorter items are allowed no edits
and must stand between word borders, so that they are not found inside other
words; they are looked up by hash among the stretches of their length.

The items are a stated query set. They go to the tasks in blocks of at most
``BLOCK_CHARS`` characters, one pass over the documents each, so what a task
holds has a fixed bound however large the benchmark is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odpanel.llm.common import byte_slices

Q = 8
ERROR_RATE = 0.1          # edits allowed, as a share of the item's characters
SHORT_CHARS = 2 * Q       # shorter items (normalised) are matched unchanged, as whole words
BLOCK_CHARS = 4 << 20
RUN_BYTES = 256 << 10     # text looked up at once
FILTER_BITS = 21
NOT_WORD = re.compile(r"[\W_]+")


def normal(text: str) -> str:
    """Lower case, every run of other than letters and digits one space."""
    return NOT_WORD.sub(" ", text.lower()).strip()


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), "<u4").astype(np.uint32)


WORDLIKE = np.array([bool(re.match(r"[^\W_]", chr(i))) for i in range(1 << 16)])


def layout(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The normalised code points of many texts in one array, each followed
    by a newline, and where each begins (with the array's end). The same as
    ``normal`` of each text, but for a space that may stay at its end."""
    low = [t.lower() for t in texts]
    c = codes("\n".join(low) + "\n")
    ends = np.cumsum([len(t) + 1 for t in low]) - 1
    word = WORDLIKE[np.minimum(c, 0xFFFF)]
    far = np.flatnonzero(c > 0xFFFF)
    if len(far):
        word[far] = [bool(re.match(r"[^\W_]", chr(x))) for x in c[far].tolist()]
    out = np.where(word, c, np.uint32(32))
    out[ends] = 10
    keep = word.copy()
    keep[1:] |= word[:-1]          # the first of a run of other characters
    keep[ends] = True
    return out[keep], np.concatenate([[0], np.cumsum(keep)[ends]])


def qgram_hashes(c: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the q = 8 code points at each position, by doubling."""
    if len(c) < Q:
        return np.zeros(0, np.uint64)
    h = c.astype(np.uint64) + np.uint64(0x9E37)
    for width, factor in ((1, 0x100000001B3), (2, 0xC2B2AE3D27D4EB4F), (4, 0x9E3779B97F4A7C15)):
        h = h[:-width] * np.uint64(factor) + h[width:]
    return h * np.uint64(0xD6E8FEB86659FD93)


def stretch_hashes(c: np.ndarray, begin: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of the ``width`` code points from each of ``begin`` on."""
    h = np.full(len(begin), width, np.uint64)
    for j in range(width):
        h = (h ^ c[begin + j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


# Scripts written without spaces, where words may end between any two letters:
# Thai and Lao, Burmese, Khmer, kana and ideographs with their marks.
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007),
            (0x3040, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x9FFF),
            (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF))


def borders(c: np.ndarray) -> np.ndarray:
    """Whether a word may begin or end before each of the code points of
    ``layout``, and after the last."""
    inner = (c != 32) & (c != 10)
    for lo, hi in UNSPACED:
        inner &= (c < lo) | (c > hi)
    out = np.ones(len(c) + 1, bool)
    out[1:-1] = ~(inner[1:] & inner[:-1])
    return out


class Items:
    """The index of one block of items: q-grams, and whole texts of the short
    ones. Items without a letter or digit are left out: nothing is left of
    them in the normal form."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float = ERROR_RATE):
        self.ids, self.texts = [], []
        for item_id, text in items:
            if text:
                self.ids.append(item_id)
                self.texts.append(text)
        self.codes = [codes(t) for t in self.texts]
        length = np.array([len(t) for t in self.texts], np.int64)
        # no more edits than leave a bound of at least one shared q-gram
        self.edits = np.maximum(
            np.minimum((length * rate).astype(np.int64), (length - Q) // Q), 0)
        self.bound = length - Q + 1 - self.edits * Q
        self.short: dict[int, dict[int, list[int]]] = {}   # by length: items of each hash
        for i in np.flatnonzero(length < SHORT_CHARS).tolist():
            h = int(stretch_hashes(self.codes[i], np.zeros(1, np.int64), int(length[i]))[0])
            self.short.setdefault(int(length[i]), {}).setdefault(h, []).append(i)
        self.short_keys = {m: np.array(sorted(v), np.uint64) for m, v in self.short.items()}
        grams = [qgram_hashes(c if len(c) >= SHORT_CHARS else c[:0]) for c in self.codes]
        key = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams]) if grams else key
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else key
        order = np.argsort(key, kind="stable")
        self.item, self.place = item[order].astype(np.int64), place[order].astype(np.int64)
        self.key, self.first, self.count = np.unique(key[order], return_index=True,
                                                     return_counts=True)
        self.seen = np.zeros(1 << FILTER_BITS, bool)
        self.seen[self.key >> np.uint64(64 - FILTER_BITS)] = True

    def bands(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item index, first diagonal) of the bands of text ``c`` that reach
        their item's bound."""
        h = qgram_hashes(c)
        at = np.flatnonzero(self.seen[h >> np.uint64(64 - FILTER_BITS)])
        if not len(at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known = np.minimum(np.searchsorted(self.key, h[at]), len(self.key) - 1)
        same = self.key[known] == h[at]
        at, known = at[same], known[same]
        lo, n = self.first[known], self.count[known]
        first = np.repeat(np.cumsum(n) - n, n)
        entry = np.repeat(lo, n) + np.arange(n.sum()) - first
        item = self.item[entry]
        # diagonals are shifted to be positive: no item is longer than 2^22
        diagonal = np.repeat(at, n) - self.place[entry] + (1 << 23)
        band = diagonal // (self.edits[item] + 1)
        keys = np.concatenate([item << 40 | band, item << 40 | (band - 1)])
        uniq, count = np.unique(keys, return_counts=True)
        uniq = uniq[count >= self.bound[uniq >> 40]]
        item = uniq >> 40
        return item, (uniq & ((1 << 40) - 1)) * (self.edits[item] + 1) - (1 << 23)

    def short_hits(self, c: np.ndarray) -> Iterator[tuple[int, int]]:
        """(item index, position) of the short items between word borders of
        text ``c``."""
        border = borders(c) if self.short else np.zeros(0, bool)
        for m, by_hash in self.short.items():
            begin = np.flatnonzero(border[:-m] & border[m:])
            if not len(begin):
                continue
            keys, h = self.short_keys[m], stretch_hashes(c, begin, m)
            known = keys[np.minimum(np.searchsorted(keys, h), len(keys) - 1)] == h
            for key, p in zip(h[known].tolist(), begin[known].tolist(), strict=True):
                for i in by_hash[key]:
                    if np.array_equal(c[p:p + m], self.codes[i]):
                        yield i, p

    def search(self, texts: list[str]) -> list[tuple[int, int | None, int, int, int]]:
        """(text number, item id, edits, start, end) of the best occurrence of
        each item in each text, where one is within its edits."""
        if not self.ids or not texts:
            return []
        c, starts = layout(texts)
        item, diagonal = self.bands(c)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for i, p in self.short_hits(c):
            best.setdefault((int(np.searchsorted(starts, p, "right")) - 1, i),
                            (0, p, p + len(self.texts[i])))
        open_bands = []
        for i, d in zip(item.tolist(), diagonal.tolist(), strict=True):
            k, m = int(self.edits[i]), len(self.texts[i])
            lo, hi = max(0, d), min(len(c), d + 2 * (k + 1) + m)
            # the band may touch several texts at a border
            first = int(np.searchsorted(starts, lo, "right")) - 1
            last = int(np.searchsorted(starts, max(lo, hi - 1), "right")) - 1
            for t in range(first, min(last, len(texts) - 1) + 1):
                begin, end = max(lo, int(starts[t])), min(hi, int(starts[t + 1]) - 1)
                if end - begin < m - k or best.get((t, i), (1,))[0] == 0:
                    continue
                at = self._exact(i, c[begin:end])
                if at >= 0:
                    best[t, i] = (0, begin + at, begin + at + m)
                else:
                    open_bands.append((t, i, d, begin, end))
        open_bands = [x for x in open_bands if best.get(x[:2], (1,))[0]]
        if open_bands:
            own = [x[1] for x in open_bands]
            got = banded_distances(
                [self.codes[i] for i in own], self.edits[own], c,
                *(np.array(v, np.int64) for v in list(zip(*open_bands, strict=True))[2:]))
            for (t, i, *_), cost, begin, end in zip(open_bands, *got, strict=True):
                if cost <= self.edits[i]:
                    best[t, i] = min(best.get((t, i), (1 << 30, 0, 0)),
                                     (int(cost), int(begin), int(end)))
        return [(t, self.ids[i], v[0], v[1] - int(starts[t]), v[2] - int(starts[t]))
                for (t, i), v in sorted(best.items())]

    def _exact(self, i: int, text: np.ndarray) -> int:
        """First position of the item in ``text`` unchanged, or -1."""
        raw, item = text.tobytes(), self.codes[i].tobytes()
        p = raw.find(item)
        while p >= 0 and p % 4:
            p = raw.find(item, p + 1)
        return p // 4 if p >= 0 else -1


BIG = np.int64(1 << 30)
UNIT = np.int64(1 << 32)   # a cell holds cost * UNIT + begin of the stretch


def banded_distances(items: list[np.ndarray], edits: np.ndarray, text: np.ndarray,
                     diagonal: np.ndarray, begin: np.ndarray, end: np.ndarray
                     ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Banded alignment of many items at once, one band each: the least edits
    that turn the item into a stretch of ``text[begin:end]`` on the diagonals
    ``diagonal`` .. ``diagonal + 2 * edits + 1``, and that stretch (the first
    begin among the cheapest). A band that exceeds its edits everywhere is
    given up; its cost is then only known to be larger.

    Cell j of row r of a band is text position diagonal + r + j."""
    n = len(items)
    size = np.array([len(x) for x in items])
    width = 2 * (edits + 1)
    pattern = np.zeros((n, size.max()), np.uint32)
    for i, x in enumerate(items):
        pattern[i, :len(x)] = x
    shift = np.arange(width.max())
    cost, first, last = np.full(n, BIG), np.zeros(n, np.int64), np.zeros(n, np.int64)
    live = np.arange(n)
    lo, hi = begin[:, None], end[:, None]
    pos = diagonal[:, None] + shift
    wide = shift < width[:, None]
    row = np.where(wide & (pos >= lo) & (pos <= hi), pos, BIG * UNIT)
    for r in range(1, int(size.max()) + 1):
        pos = pos + 1
        inside = wide & (pos > lo) & (pos <= hi)
        same = text[np.clip(pos - 1, 0, len(text) - 1)] == pattern[:, r - 1:r]
        new = np.where(inside, row + np.where(same, 0, UNIT), BIG * UNIT)   # match, replace
        new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + UNIT)            # item's is missing
        new = np.minimum.accumulate(new - shift * UNIT, axis=1) + shift * UNIT   # text's is extra
        row = np.where(wide & (pos >= lo) & (pos <= hi), np.minimum(new, BIG * UNIT), BIG * UNIT)
        done = size[live] == r
        if done.any():
            j = row[done].argmin(axis=1)
            cell = row[done, j]
            cost[live[done]], first[live[done]] = cell >> 32, cell & (UNIT - 1)
            last[live[done]] = pos[done, j]
        if done.any() or r % 8 == 0:
            on = ~done & ((row.min(axis=1) >> 32) <= edits[live])
            if not on.any():
                break
            if not on.all():
                live, row, pos, wide, lo, hi, pattern = (
                    x[on] for x in (live, row, pos, wide, lo, hi, pattern))
    return cost, first, last


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS
                ) -> Iterator[list[tuple[int | None, str]]]:
    """The items (item_id, normalised text) in blocks of a bounded size, read
    one partition at a time; null texts and repeated items are skipped, items
    without an id are not."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                            F.col("text").cast("string").alias("text")) \
        .filter("text is not null").distinct().orderBy("item_id", "text")
    block, held = [], 0
    for r in rows.toLocalIterator():
        text = normal(r.text)
        block.append((r.item_id, text))
        held += len(text)
        if held >= block_chars:
            yield block
            block, held = [], 0
    if block:
        yield block


_held: list = []   # per Python worker: the block indexed last, its rate and index


def _index(block: list[tuple[int | None, str]], rate: float) -> Items:
    """The index of a broadcast block, built once per worker."""
    if not _held or _held[0] is not block or _held[1] != rate:
        _held[:] = [block, rate, Items(block, rate)]
    return _held[2]


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for rows, texts in byte_slices(batch, "text", RUN_BYTES):
        yield rows, [t.decode("utf-8", "replace") if t else "" for t in texts]


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """(doc_id, item_id, edits, start, end): for each document and item that
    occurs in it within ``rate`` edits, the best occurrence, in positions of
    the normalised text. Documents without an occurrence, null and empty
    texts give no row; repeated rows give repeated results; ties go to the
    first stretch; a null doc_id or item_id stays null. Other columns are not
    read."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, edits int, start long, end long"
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.col("text").cast("string").alias("text"))
    out = spark.createDataFrame([], schema)
    for block in item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = _index(shared.value, rate)
            for batch in batches:
                for rows, texts in _runs(batch):
                    hits = items.search(texts)
                    at = pa.array([h[0] for h in hits], pa.int64())
                    cols = list(zip(*[h[1:] for h in hits], strict=True)) or [()] * 4
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(0).take(at), pa.array(cols[0], pa.int64()),
                         pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                         pa.array(cols[3], pa.int64())],
                        ["doc_id", "item_id", "edits", "start", "end"])

        out = out.unionByName(src.mapInArrow(run, schema))
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """The input rows and columns without the rows that hold an item. Decided
    row by row in one pass per block of items; nothing is joined."""
    spark = docs.sparkSession
    for block in item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = _index(shared.value, rate)
            for batch in batches:
                for rows, texts in _runs(batch):
                    bad = {h[0] for h in items.search(texts)}
                    yield rows.filter(pa.array([i not in bad for i in range(len(texts))],
                                               pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
