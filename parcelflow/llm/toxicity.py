"""Toxicity from subword-bag embeddings averaged into a linear softmax (operator 5).

A word is the bag of its character n-grams (with word borders) and itself, hashed into ``BUCKETS``
embedding rows.  The embeddings of a segment - ``SEGMENT`` consecutive words - are averaged and go
into a two-class linear softmax; both are trained together in numpy.  A misspelling that was never
seen shares most n-grams with the words it comes from.  A text's score is that of its most toxic
segment, so a few words count alike in short and in very long texts.  Labels are given per text:
training starts with every segment of a toxic text as toxic and then keeps the text's highest one.

Training takes a bounded sample of labelled rows (``max_per_class`` of each class, the smallest
hashes of the id), on the driver.  Scoring is a map over whole texts: with a linear softmax the
average falls into one number per word, which each Python worker keeps for words already seen.

Defined cases: null and empty texts have no segment and get the score of the bias alone; labels
that are null or whose id is null teach nothing; an id labelled twice teaches once per distinct label; without
labelled rows of both classes every score is 0; extra columns are dropped; repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.bpe import slices
from parcelflow.llm.common import text_of

BUCKET_BITS = 20
BUCKETS = 1 << BUCKET_BITS
DIMENSIONS = 8
SEGMENT = 8
NGRAMS = (3, 4, 5)
MAX_PER_CLASS = 2000
#: Subwords of words that occur in fewer training texts are not trained.
MIN_TEXTS = 10
EPOCHS = 60
#: Largest step of an embedding, of the softmax's weights and of its bias.
RATES = (0.5, 0.1, 0.1)
THRESHOLD = 0.3
#: Words kept per worker before the memory of seen words starts anew.
MEMORY_WORDS = 500_000
# Fixed value: characters taken off both ends of a word.
EDGES = b".,;:!?\"'()[]{}|"
_PRIME = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    """Lower-case words without punctuation at their ends."""
    words = text.lower().encode("utf-8", "replace").split()
    return [w for w in (x.strip(EDGES) for x in words) if w]


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of all words' subwords, flat, and how many each word has."""
    parts = [_subwords(words[i:i + 20_000]) for i in range(0, len(words), 20_000)]
    return np.concatenate([b for b, _ in parts]), np.concatenate([n for _, n in parts])


def _subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    marked = [b"<" + w + b">" for w in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    flat = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    owner = np.repeat(np.arange(len(words)), lengths)
    owners, buckets = [], []
    prefix = np.zeros(len(flat), np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, max(NGRAMS) + 1):
            count = len(flat) - n + 1
            if count <= 0:
                break
            prefix = prefix[:count] * _PRIME + flat[n - 1:]
            if n in NGRAMS:
                inside = np.flatnonzero(ends[owner[:count]] - np.arange(count) >= n)
                owners.append(owner[inside])
                buckets.append((prefix[inside] + np.uint64(n)) * _MIX)
        weights = _PRIME ** (np.arange(len(flat)) - np.repeat(starts, lengths)).astype(np.uint64)
        whole = np.add.reduceat(flat * weights, starts) if len(flat) else np.empty(0, np.uint64)
        owners.append(np.arange(len(words)))
        buckets.append((whole + np.uint64(99)) * _MIX)
    owner = np.concatenate(owners)
    bucket = (np.concatenate(buckets) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
    return bucket[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words)).astype(np.int32)


@dataclass
class Model:
    """One number per bucket (its embedding times the softmax's class difference) and the bias."""

    weight: np.ndarray
    bias: float
    seen: dict[bytes, int] = field(default_factory=dict)
    sums: np.ndarray = field(default_factory=lambda: np.empty(0))
    counts: np.ndarray = field(default_factory=lambda: np.empty(0))

    def _learn(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self.seen]
        if not new:
            return
        if len(self.seen) + len(new) > MEMORY_WORDS:
            self.seen, self.sums, self.counts = {}, np.empty(0), np.empty(0)
            new = list(words)
        buckets, counts = subwords(new)
        sums = np.add.reduceat(self.weight[buckets], np.cumsum(counts) - counts)
        self.seen.update(zip(new, range(len(self.seen), len(self.seen) + len(new))))
        self.sums = np.concatenate([self.sums, sums])
        self.counts = np.concatenate([self.counts, counts])

    def score(self, texts: list[str]) -> np.ndarray:
        return np.concatenate([self._score(texts[i:j]) for i, j in slices(texts, 2_000_000)] or [np.empty(0)])

    def _score(self, texts: list[str]) -> np.ndarray:
        words = [words_of(t) for t in texts]
        self._learn({w for ws in words for w in ws})
        out = np.full(len(texts), self.bias)
        for i, ws in enumerate(words):
            if ws:
                at = np.fromiter(map(self.seen.__getitem__, ws), np.int64, len(ws))
                first = np.arange(0, len(ws), SEGMENT)
                mean = np.add.reduceat(self.sums[at], first) / np.add.reduceat(self.counts[at], first)
                out[i] += mean.max()
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Trains embeddings and softmax together by gradient steps on the segments of the given texts."""
    if len(set(labels)) < 2:
        return Model(np.zeros(BUCKETS), -30.0)
    rng = np.random.default_rng(seed)
    index: dict[bytes, int] = {}
    words, text_no = [], []
    segment_size = []
    for i, t in enumerate(texts):
        ws = words_of(t)
        if ws:
            words.append(np.fromiter((index.setdefault(w, len(index)) for w in ws), np.int32, len(ws)))
            n = -(-len(ws) // SEGMENT)
            text_no.append(np.full(n, i, np.int32))
            size = np.full(n, SEGMENT, np.int32)
            size[-1] = len(ws) - SEGMENT * (n - 1)
            segment_size.append(size)
    word_at, text_no = np.concatenate(words), np.concatenate(text_no)
    del words
    sizes = np.concatenate(segment_size)
    buckets, counts = subwords(list(index))
    distinct = len(index)
    del index
    bucket_start = np.cumsum(counts) - counts
    word_start = np.cumsum(sizes) - sizes
    tokens = np.add.reduceat(counts[word_at], word_start).astype(float)  # subwords per segment
    segment_of = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    toxic = np.asarray(labels)[text_no] == 1
    text_start = np.flatnonzero(np.r_[True, np.diff(text_no) != 0])

    pairs = np.unique(np.repeat(text_no, sizes) * np.int64(distinct) + word_at) % distinct
    word_texts = np.bincount(pairs, minlength=distinct)
    del pairs
    common = np.bincount(buckets, np.repeat(word_texts, counts), BUCKETS) >= MIN_TEXTS

    embed = rng.normal(0, 0.01, (BUCKETS, DIMENSIONS)).astype(np.float32)
    classes = rng.normal(0, 0.1, (DIMENSIONS, 2))
    bias = np.zeros(2)
    momentum = [np.zeros_like(x) for x in (embed, classes, bias)]
    room = np.empty_like(embed)  # the one array of this size that the steps work in
    for epoch in range(epochs):
        diff = classes[:, 1] - classes[:, 0]
        per_word = np.add.reduceat((embed @ diff.astype(np.float32))[buckets], bucket_start)
        logit = np.add.reduceat(per_word[word_at], word_start) / tokens + bias[1] - bias[0]
        chance = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if epoch < epochs // 4:
            chosen = toxic
        else:  # of a toxic text, its highest segment
            best = np.maximum.reduceat(logit, text_start)
            chosen = toxic & (logit >= np.repeat(best, np.diff(np.r_[text_start, len(logit)])))
        weights = np.where(toxic, 0.0, 1.0 / max(1, (~toxic).sum()))
        weights[chosen] = 1.0 / chosen.sum()
        error = weights * (chance - toxic)
        # The gradient of a bucket is this number times the class difference.
        word_error = np.bincount(word_at, (error / tokens)[segment_of], len(counts))
        pull = np.bincount(buckets, np.repeat(word_error, counts), BUCKETS) * common
        # In parts, as the product is taken in double precision
        by_class = sum(embed[i:i + (1 << 17)].T @ pull[i:i + (1 << 17)] for i in range(0, BUCKETS, 1 << 17))
        np.outer(pull.astype(np.float32), diff.astype(np.float32), out=room)
        grads = (room, np.stack([-by_class, by_class], 1), np.array([-error.sum(), error.sum()]))
        # Steps keep the proportions of the gradient, so that rare subwords move little.
        for x, g, m, rate in zip((embed, classes, bias), grads, momentum, RATES):
            m *= 0.8
            g *= np.asarray(0.2, m.dtype)
            m += g
            np.multiply(m, m.dtype.type(rate / (max(m.max(), -m.min()) + 1e-12)), out=g)
            x -= g
    diff = classes[:, 1] - classes[:, 0]
    model = Model((embed @ diff) * common, float(bias[1] - bias[0]))
    return _calibrated(model, texts, np.asarray(labels))


def _calibrated(model: Model, texts: list[str], labels: np.ndarray) -> Model:
    """Moves the bias so that ``THRESHOLD`` separates the training texts with the fewest errors."""
    score = model.score(texts)
    logit = np.log(score / (1 - score))
    model.seen, model.sums, model.counts = {}, np.empty(0), np.empty(0)
    order = np.argsort(logit)
    y = labels[order] == 1
    wrong = np.r_[0, np.cumsum(y)] / max(1, y.sum()) + (~y).sum() / max(1, (~y).sum()) - np.r_[0, np.cumsum(~y)] / max(1, (~y).sum())
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    edges = np.r_[logit[order][0] - 2, (logit[order][1:] + logit[order][:-1]) / 2, logit[order][-1] + 2]
    cut = edges[best[len(best) // 2]]
    model.bias += float(np.log(THRESHOLD / (1 - THRESHOLD)) - cut)
    return model


def fold(id_col: str = "doc_id"):
    """crc32 of the id's text, modulo 4 (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def labelled_sample(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> DataFrame:
    """(text, toxic) of at most ``max_per_class`` labelled training rows of each class."""
    marks = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold() != 2))
             .select("doc_id", "toxic").distinct().withColumn("order", F.xxhash64("doc_id")))
    picked = None
    for y in (0, 1):
        some = marks.where(F.col("toxic") == y).orderBy("order", "doc_id").limit(max_per_class)
        picked = some if picked is None else picked.unionByName(some)
    return docs.select("doc_id", text_of().alias("text")).join(F.broadcast(picked), "doc_id").select(
        "text", "toxic", "doc_id")


def fit(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> Model:
    """Trains on the driver; the sample is bounded by ``max_per_class``."""
    rows = labelled_sample(docs, labels, max_per_class).toPandas().sort_values(["doc_id", "toxic", "text"])
    return train(rows["text"].tolist(), rows["toxic"].astype(int).tolist())


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    rows = docs.select("doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), text_of().alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast((model.weight.astype(np.float32), model.bias))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weight, bias = shared.value
        m = Model(weight, bias)
        for b in batches:
            s = m.score(b["text"].tolist())
            yield b[["doc_id", "held_out"]].assign(score=s, predicted=(s >= threshold).astype(np.int32))

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score is below ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weight.astype(np.float32), model.bias))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weight, bias = shared.value
        m = Model(weight, bias)
        for b in batches:
            clean = m.score(["" if t is None else t for t in b["text"]]) < threshold
            for i in range(0, len(b), 1000):  # smaller batches back, which copy less at a time
                yield b.iloc[i:i + 1000][clean[i:i + 1000]]

    return docs.mapInPandas(run, docs.schema)
