"""Language ID: averaged hashed subword embeddings with a linear softmax.

A text is the mean of the embeddings of its character n-grams (2 to 4,
inside words, word ends marked), hashed to ``BUCKETS`` rows; a linear layer
and a softmax give the languages. Embeddings and layer are trained by
mini-batch stochastic gradient descent in numpy on snippets of a bounded
sample of labelled rows: ``per_lang`` documents of each of at most
``MAX_LANGS`` languages, chosen by hash. The sampled documents left out of training set a temperature and the
rejection threshold.

The mean and the layer are linear, so prediction uses the product of the two
tables: one row of logits per n-gram, averaged over the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from odpanel.llm.common import byte_slices

BUCKETS = 1 << 16
ORDERS = (2, 3, 4)
DIM = 16
PER_LANG = 250     # labelled documents of each language in the sample
MAX_LANGS = 200    # languages that are learned, at most: those of the most labelled rows
SNIPPETS = 24      # at most so many training snippets of a document, evenly spaced
SNIPPET_WORDS = 24
EPOCHS = 5
BATCH = 64
RATE = 0.5
UNKNOWN = "und"
REJECT_SHARE = 0.002   # of clean calibration documents that may be rejected
MAX_THRESHOLD = 0.5
RUN_CHARS = 1 << 16
LETTERS = regex.compile(r"\p{L}+")   # letters alone, no other number signs


@dataclass
class Model:
    langs: list[str]
    logits: np.ndarray             # BUCKETS x languages: embeddings times layer
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0
    info: dict = field(default_factory=dict)


def normal(text: str) -> str:
    """Lower-cased words of letters, each between single spaces; no letter: ''."""
    words = LETTERS.findall(text.lower())
    return " " + " ".join(words) + " " if words else ""


def ngrams(norm: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order, the buckets of the n-grams of normalised text (texts
    joined by newlines) and the positions at which they begin, ascending. An
    n-gram may begin or end with the space at a word end but has none
    inside, and no newline."""
    c = np.frombuffer(norm.encode("utf-32-le"), "<u4").astype(np.uint32)
    space, line = c == 32, c == 10
    edge = space | line
    out = []
    h = c + np.uint32(1)
    # bad: a newline anywhere, or a space that is neither first nor last
    bad = line.copy()
    for n in range(2, max(ORDERS) + 1):
        m = len(c) - n + 1
        if m <= 0:
            break
        h = h[:m] * np.uint32(0x01000193) ^ (c[n - 1:] + np.uint32(1))
        bad = bad[:m] | line[n - 1:]
        if n > 2:
            bad |= edge[n - 2:n - 2 + m]
        if n in ORDERS:
            ok = np.flatnonzero(~bad if n > 2 else ~(bad | (edge[:m] & edge[1:1 + m])))
            mixed = (h[ok] + np.uint32(n)) * np.uint32(0x9E3779B1)
            out.append(((mixed >> np.uint32(32 - 16)).astype(np.int32), ok))
    return out


def buckets(norm: str) -> np.ndarray:
    return np.concatenate([b for b, _ in ngrams(norm)] or [np.zeros(0, np.int32)])


def mean_logits(model: Model, norms: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Logits per normalised text, and the number of its n-grams. Works on
    runs of about RUN_CHARS characters, which stay in the CPU's cache."""
    sizes = [len(x) + 1 for x in norms]
    total, counts = np.zeros((len(norms), len(model.langs))), np.zeros(len(norms), np.int64)
    begin = 0
    while begin < len(norms):
        end, held = begin + 1, sizes[begin]
        while end < len(norms) and held + sizes[end] <= RUN_CHARS:
            held += sizes[end]
            end += 1
        starts = np.concatenate([[0], np.cumsum(sizes[begin:end])])
        for b, at in ngrams("\n".join(norms[begin:end]) + "\n"):
            cut = np.searchsorted(at, starts)
            n = np.diff(cut)
            some = np.flatnonzero(n)
            if len(some):
                total[begin + some] += np.add.reduceat(model.logits[b], cut[:-1][some],
                                                       axis=0, dtype=np.float64)
                counts[begin + some] += n[some]
        begin = end
    return total / np.maximum(counts, 1)[:, None] + model.bias, counts


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def snippets(text: str) -> list[str]:
    """Evenly spaced runs of SNIPPET_WORDS words over the whole text, SNIPPETS
    at most. The snippets of the snippets joined are the same again."""
    words = LETTERS.findall(text.lower())
    parts = [words[i:i + SNIPPET_WORDS] for i in range(0, len(words), SNIPPET_WORDS)]
    step = max(1, -(-len(parts) // SNIPPETS))
    return [" " + " ".join(p) + " " for p in parts[::step]]


def train(rows: list[tuple[int, str, str]], epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Fit on (doc_id, text, lang) rows. A fifth of them (by position in
    doc_id order, within each language) only calibrates."""
    langs = sorted({r[2] for r in rows})
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    code = {x: i for i, x in enumerate(langs)}
    fit, held = [], []
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0], r[1]))
        for i, r in enumerate(own):
            (held if i % 5 == 4 else fit).append(r)
    rng = np.random.default_rng(seed)
    texts = [(s, code[r[2]]) for r in fit for s in snippets(r[1])]
    feats = [(f, y) for s, y in texts if len(f := buckets(s))]
    emb = ((rng.random((BUCKETS, DIM)) - 0.5) / DIM).astype(np.float64)
    layer, bias = np.zeros((DIM, len(langs))), np.zeros(len(langs))
    # every language weighs the same, however many snippets it has
    per = np.bincount([y for _, y in feats], minlength=len(langs))
    weight = len(feats) / (len(langs) * np.maximum(per, 1))
    steps = max(1, epochs * -(-len(feats) // BATCH))
    done = 0
    for _ in range(epochs):
        order = rng.permutation(len(feats))
        for k in range(0, len(order), BATCH):
            part = [feats[i] for i in order[k:k + BATCH]]
            rate = RATE * (1 - done / steps) + 1e-3
            done += 1
            ids = np.concatenate([f for f, _ in part])
            sizes = np.array([len(f) for f, _ in part])
            y = np.array([v for _, v in part])
            first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            hidden = np.add.reduceat(emb[ids], first, axis=0) / sizes[:, None]
            err = softmax(hidden @ layer + bias)
            err[np.arange(len(y)), y] -= 1
            err *= np.minimum(weight[y], 10)[:, None]
            back = err @ layer.T / sizes[:, None]
            layer -= rate * hidden.T @ err / len(y) * 8
            bias -= rate * err.mean(axis=0)
            uniq, inv = np.unique(ids, return_inverse=True)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            grad = np.stack([np.bincount(inv, weights=back[doc, d], minlength=len(uniq))
                             for d in range(DIM)], axis=1)
            emb[uniq] -= rate * grad
    model = Model(langs, (emb @ layer).astype(np.float32), bias)
    calibrate(model, held or fit, code)
    model.info = {"fit": len(fit), "calibration": len(held), "snippets": len(feats)}
    return model


def calibrate(model: Model, rows: list[tuple[int, str, str]], code: dict[str, int]) -> None:
    """Temperature of the least log loss over the snippets of the held rows
    (short texts, where scores matter), and the threshold below which a text
    is rejected: the score that REJECT_SHARE of the rightly labelled snippets
    stay under, MAX_THRESHOLD at most."""
    pairs = [(n, code[r[2]]) for r in rows for n in snippets(r[1])]
    if not pairs:
        return
    z, counts = mean_logits(model, [n for n, _ in pairs])
    y = np.array([v for _, v in pairs])
    z, y = z[counts > 0], y[counts > 0]
    if not len(y):
        return
    best = min((float(-np.log(softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean()), t)
               for t in np.geomspace(0.2, 5, 41))
    model.temperature = float(best[1])
    p = softmax(z / model.temperature)
    right = p.argmax(axis=1) == y
    if right.any():
        model.threshold = min(MAX_THRESHOLD,
                              float(np.quantile(p.max(axis=1)[right], REJECT_SHARE)))


def held_out(doc_id) -> F.Column:
    """crc32 of the id's decimal text, mod 5, is 0 (no id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, per_lang: int = PER_LANG) -> list[tuple[int, str, str]]:
    """The training sample: of each language the ``per_lang`` (1000 at most)
    different labelled rows (doc_id, text) outside the held-out fold that come
    first in hash order; of more than ``MAX_LANGS`` languages, those of the
    most labelled rows (ties by name). So at most ``per_lang * MAX_LANGS``
    rows reach the driver. Spark keeps ``per_lang`` ranks per language and
    task before the shuffle, so a hot language costs no more than others."""
    if not 0 < per_lang <= 1000:
        raise ValueError("per_lang must be in 1..1000")
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                           F.col("text").cast("string").alias("text"),
                           F.col("lang").cast("string").alias("lang")) \
        .filter("doc_id is not null and text is not null and lang is not null") \
        .filter(~held_out(F.col("doc_id")))
    most = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.desc("n"), "lang").limit(MAX_LANGS).collect()
    labelled = labelled.filter(F.col("lang").isin([r.lang for r in most])) \
        .withColumn("text_hash", F.xxhash64("text"))
    ids = labelled.select("doc_id", "lang", "text_hash")
    w = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text_hash")
    chosen = ids.withColumn("rank", F.dense_rank().over(w)).filter(F.col("rank") <= per_lang) \
        .select("doc_id", "lang", "text_hash").distinct()
    # at most per_lang rows of each language; the tasks cut the texts to their
    # training snippets and repeated rows fall together, so the bytes are bounded too
    chosen_rows = labelled.join(F.broadcast(chosen), ["doc_id", "lang", "text_hash"],
                                "left_semi").select("doc_id", "text", "lang")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in byte_slices(batch, "text"):
                short = [" ".join(s.strip() for s in snippets(t.decode("utf-8", "replace")))
                         for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(short, pa.string()), rows.column(2)],
                    ["doc_id", "text", "lang"])

    rows = chosen_rows.mapInArrow(cut, "doc_id long, text string, lang string") \
        .distinct().collect()
    return sorted((r.doc_id, r.text, r.lang) for r in rows)


def _predict(model: Model, texts: list[bytes | None]) -> tuple[list, np.ndarray, np.ndarray]:
    norms = [normal(t.decode("utf-8", "replace")) if t else "" for t in texts]
    langs = [UNKNOWN] * len(texts)
    score = np.zeros(len(texts))
    known = [i for i, n in enumerate(norms) if n]
    if known and model.langs:
        z, _ = mean_logits(model, [norms[i] for i in known])
        p = softmax(z / model.temperature)
        for i, k, s in zip(known, p.argmax(axis=1), p.max(axis=1), strict=True):
            langs[i] = model.langs[k]
            score[i] = round(min(1.0, float(s)), 6)
    rejected = np.array([x == UNKNOWN for x in langs]) | (score < round(model.threshold, 6))
    return langs, score, rejected


def identify(docs: DataFrame, per_lang: int = PER_LANG,
             model: Model | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected), one row per input row.

    Learns from text and lang of the rows outside the held-out fold; a
    prediction reads the text alone. Null, empty or letterless texts, or no
    labelled row at all, give `und`, score 0, rejected. Repeated rows get
    equal results; a null doc_id stays null and is not held out. Ties go to
    the language first in order. Other columns are not read."""
    if model is None:
        model = train(sample(docs, per_lang))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in byte_slices(batch, "text"):
                langs, score, rejected = _predict(shared.value, texts)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(langs), pa.array(score),
                     pa.array(rejected)],
                    ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      held_out(F.col("doc_id")).alias("held_out"),
                      F.col("text").cast("string").alias("text"))
    return src.mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def drop_rejected(docs: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """The input rows and columns without the rows that ``identify`` rejects.
    Decided row by row: nothing is joined or shuffled."""
    model = train(sample(docs, per_lang))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in byte_slices(batch, "text"):
                yield rows.filter(pa.array(~_predict(shared.value, texts)[2]))

    return docs.mapInArrow(run, docs.schema)
