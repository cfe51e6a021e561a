"""Quality rules over suffix-array repetition.

The words of a text are sorted as suffixes by prefix doubling, many texts in
one array (a suffix ends with its text). Longest common prefixes of
neighbouring suffixes come from the ranks kept at each doubling. Maximal runs
of suffixes that share a prefix are the longest-common-prefix intervals;
those preceded by different words are the maximal repeated substrings of at
least ``MIN_WORDS`` words. The union of their spans gives the covered words;
a text is kept if the covered share and the longest repeat stay in limits.

All work on a text happens in the task that reads it: nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odpanel.llm.common import byte_slices

MIN_WORDS = 8            # least length of a repeat
MIN_TEXT_WORDS = 20      # base rule
BASE_PERCENT = 30        # base rule: share of words in repeated windows
MAX_PERCENT = 25         # method's limit: share of characters in repeats
MAX_LONGEST = 50         # method's limit: words of the longest repeat
RUN_BYTES = 1 << 20
SYMBOLS = b"#*$%&|<>"

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_HEAD = np.ones(256, bool)
_HEAD[0x80:0xC0] = False          # UTF-8 continuation bytes
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def refine(ids: np.ndarray, end: np.ndarray, min_words: int
           ) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions whose first ``min_words`` words (or the power of two below
    it) occur elsewhere in their text, in suffix-array order, and the ranks of
    all positions at each doubling: ranks[k] orders suffixes by their first
    2**k words. ``ids`` must differ between texts."""
    n = len(ids)
    _, inv, count = np.unique(ids, return_inverse=True, return_counts=True)
    rank = (np.cumsum(count) - count)[inv].astype(np.int32)
    live = np.flatnonzero(count[inv] > 1)
    ranks, width = [rank], 1
    stop = 1 << (min_words.bit_length() - 1)
    repeated = live
    while len(live):
        nxt = live + width
        second = np.where(nxt < end[live], ranks[-1][np.minimum(nxt, n - 1)] + 1, 0)
        key = ranks[-1][live].astype(np.int64) << 32 | second
        order = np.argsort(key, kind="stable")
        key, at = key[order], live[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        old = np.concatenate([[True], key[1:] >> 32 != key[:-1] >> 32])
        place = np.arange(len(key))
        group, parent = np.maximum.accumulate(np.where(new, place, 0)), \
            np.maximum.accumulate(np.where(old, place, 0))
        rank = ranks[-1].copy()
        rank[at] += (group - parent).astype(np.int32)
        ranks.append(rank)
        width *= 2
        size = np.bincount(np.cumsum(new) - 1)
        live = np.sort(at[size[np.cumsum(new) - 1] > 1])
        if width <= stop:
            repeated = live
    if width < stop:
        repeated = live
    return repeated[np.argsort(ranks[-1][repeated], kind="stable")], ranks


def neighbour_lcp(suffixes: np.ndarray, ranks: list[np.ndarray], end: np.ndarray) -> np.ndarray:
    """Common prefix, in words, of each suffix and the next one in order."""
    a, b = suffixes[:-1].copy(), suffixes[1:].copy()
    last = np.minimum(end[a], end[b])
    lcp = np.zeros(len(a), np.int64)
    n = len(end)
    for k in range(len(ranks) - 1, -1, -1):
        open_ = np.maximum(a, b) < last
        same = open_ & (ranks[k][np.minimum(a, n - 1)] == ranks[k][np.minimum(b, n - 1)])
        # equal ranks at doubling k: 2**k equal words, none past a text's end
        lcp[same] += 1 << k
        a[same] += 1 << k
        b[same] += 1 << k
    return lcp


def intervals(lcp: list[int], least: int) -> list[tuple[int, int, int]]:
    """Longest-common-prefix intervals (length, first, last suffix) of at
    least ``least`` words, by one pass with a stack."""
    out, stack = [], []
    for i, v in enumerate([*lcp, 0]):
        first = i
        while stack and stack[-1][0] > v:
            length, first = stack.pop()
            out.append((length, first, i))
        if v >= least and (not stack or stack[-1][0] < v):
            stack.append((v, first))
    return out


def repeats(ids: np.ndarray, begin: np.ndarray, min_words: int = MIN_WORDS
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts laid one after the other (``begin``: first word of each, and
    the total): a mark on every covered word, and per text the number of
    maximal repeated substrings and the words of the longest."""
    n, texts = len(ids), len(begin) - 1
    text = np.repeat(np.arange(texts), np.diff(begin))
    end = begin[1:][text]
    cover = np.zeros(n + 1, np.int64)
    number, longest = np.zeros(texts, np.int64), np.zeros(texts, np.int64)
    if n:
        sa, ranks = refine(ids, end, min_words)
        if len(sa) > 1:
            lcp = neighbour_lcp(sa, ranks, end)
            before = np.where(sa == begin[text[sa]], -1 - sa, ids[sa - 1])
            # runs of equal preceding words: an interval inside one extends left
            run = np.concatenate([[0], np.cumsum(before[1:] != before[:-1])]).tolist()
            found = [(length, a, b) for length, a, b in intervals(lcp.tolist(), min_words)
                     if run[a] != run[b]]
            for length, a, b in found:
                at = sa[a:b + 1]
                np.add.at(cover, at, 1)
                np.add.at(cover, at + length, -1)
                t = text[at[0]]
                number[t] += 1
                longest[t] = max(longest[t], length)
    return np.cumsum(cover[:-1]) > 0, number, longest


def measure(texts: list[bytes | None], min_words: int = MIN_WORDS) -> dict[str, np.ndarray]:
    """The columns of ``quality`` that come from the texts."""
    lists = [(t or b"").split() for t in texts]
    begin = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    code: dict[bytes, int] = {}
    flat = [code.setdefault(w, len(code)) for x in lists for w in x]
    owner = np.repeat(np.arange(len(texts)), np.diff(begin))
    ids = owner * (len(code) + 1) + np.array(flat, np.int64).reshape(-1)
    size_of = np.array([int(_HEAD[np.frombuffer(w, np.uint8)].sum()) if not w.isascii()
                        else len(w) for w in code], np.int64)
    sizes = size_of[np.array(flat, np.int64)] if flat else np.zeros(0, np.int64)
    covered, number, longest = repeats(ids, begin, min_words)
    base = covered if min_words == MIN_WORDS else repeats(ids, begin, MIN_WORDS)[0]

    def per_text(values: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=values, minlength=len(texts)).astype(np.int64)

    symbols, copies = [], []
    for t in texts:
        raw = np.frombuffer(t or b"", np.uint8)
        symbols.append(int(_SYMBOL[raw].sum()))
        lines = [x for x in (t or b"").split(b"\n") if x.strip()]
        copies.append(len(lines) - len(set(lines)))
    return {"n_words": np.diff(begin), "word_chars": per_text(sizes),
            "n_symbols": np.array(symbols, np.int64), "n_dup_lines": np.array(copies, np.int64),
            "n_repeat_words": per_text(base), "repeat_chars": per_text(sizes * covered),
            "n_repeats": number, "longest_repeat": longest}


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
           "repeat_chars", "n_repeats", "longest_repeat")


def quality(docs: DataFrame, min_words: int = MIN_WORDS, max_percent: int = MAX_PERCENT,
            max_longest: int = MAX_LONGEST) -> DataFrame:
    """(doc_id, COLUMNS, base_failed, kept), one row per input row.

    kept: the base rules hold, at most ``max_percent`` of the word characters
    lie in repeats, and the longest repeat has at most ``max_longest`` words.
    Null, empty and blank texts have no words and fail the base rules;
    repeated rows get equal results; a null doc_id stays null; an empty table
    gives an empty result. Other columns are not read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in byte_slices(batch, "text", RUN_BYTES):
                m = measure(texts, min_words)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), *(pa.array(m[c].astype(np.int64)) for c in COLUMNS)],
                    ["doc_id", *COLUMNS])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.col("text").cast("string").alias("text"))
    failed = (F.col("n_words") < MIN_TEXT_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * BASE_PERCENT)
    verdict = (F.col("repeat_chars") * 100 <= F.col("word_chars") * max_percent) & (
        F.col("longest_repeat") <= max_longest)
    return src.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in COLUMNS)) \
        .withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict)
