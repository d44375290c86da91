"""Stupid-backoff language-model scores over the whole corpus (operator 10).

The corpus's own n-gram counts are the model.  A word's score is c(context word) / c(context) if the
n-gram occurs at least ``min_count`` times, else ``ALPHA`` times the score with a context one word
shorter; a single word's is its share of all words.  A document's score is the sum of logarithms.

The count table is partitioned by hash: a range of the 64-bit hashes of n-grams of all orders, in
one task.  Documents are dealt into blocks; a block's exploded n-grams are grouped before they move, so each
distinct n-gram of a block is one entry however often it occurs, and the entries of a block for a range travel
in one row, sorted and delta-coded.  The join of counts and n-grams is by (block, range); scores are summed
per document.  It takes two exchanges, as most n-grams of a corpus occur once and need no count:

* thin: hashes cut to a few bits more than tell all n-grams apart; the answer is one bit, whether the
  cut hash occurs ``min_count`` times.  Hashes that fall together only let an n-gram pass.
* exact: the words and the n-grams that passed, by the whole hash; the answer is the count.

The number of bits grows with the corpus.  No row is without an entry, so there are never more rows than
distinct n-grams.  A word that makes up a third of the corpus is one entry per block; rows with one text
are dealt out by a number of their own.  Blocks hold about ``BLOCK_BYTES`` of text and ranges
the n-grams of about ``RANGE_BLOCKS`` blocks, at any corpus size.

Defined cases: null and empty texts have no words, log score 0 and mean 0; words are runs of
characters other than white space (space, tab to carriage return), A-Z lower-cased; repeated rows are separate documents
whose words all count; an empty table gives no rows; extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.collocations import Words, _longer
from parcelflow.llm.common import staged
from parcelflow.llm.packed_keys import borders, cut_bits, edges, rows, small, totals, unsmall

ORDER = 3
MIN_COUNT = 2
ALPHA = 0.4
BLOCK_BYTES = 8 << 20
RANGE_BLOCKS = 2
#: A-Z in lower case, white space as a space.
_PLAIN = bytes.maketrans(bytes(range(65, 91)) + b"\t\n\x0b\x0c\r", bytes(range(97, 123)) + b" " * 5)


class Block:
    """The words of some texts, and for k = 1..order the hash of the k-gram that ends at each word."""

    def __init__(self, texts: list[bytes | None], order: int):
        plain = [(t or b"").translate(_PLAIN) for t in texts]
        w = Words(b"\n".join(plain))
        ends = np.cumsum(np.fromiter(map(len, plain), np.int64, len(plain)) + 1)
        self.of = np.searchsorted(ends, w.start, "right")
        self.counts = np.bincount(self.of, minlength=len(texts))
        self.place = np.arange(len(self.of)) - np.repeat(np.cumsum(self.counts) - self.counts, self.counts)
        self.grams = [w.hash]
        for _ in range(1, order):
            longer = w.hash.copy()
            longer[1:] = _longer(self.grams[-1][:-1], w.hash[1:])
            self.grams.append(longer)
        #: Positions at which a k-gram ends.
        self.inside = [np.flatnonzero(self.place >= k) for k in range(order)]

    def _cut(self, shift: int) -> np.ndarray:
        """Cut hashes of all n-grams of two words and more."""
        longer = [g[i] for g, i in zip(self.grams[1:], self.inside[1:])]
        return np.concatenate([np.empty(0, np.uint64), *longer]) >> np.uint64(shift)

    def cut(self, shift: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct cut hashes, and how often each occurs."""
        return np.unique(self._cut(shift), return_counts=True)

    def passed(self, shift: int, often: Callable[[np.ndarray], np.ndarray]) -> list[np.ndarray]:
        """Per order, the positions whose n-gram is asked for: all words, and what passed the thin
        exchange; ``often`` tells which of the sorted cut hashes did."""
        keys, number = np.unique(self._cut(shift), return_inverse=True)
        flags = np.split(often(keys)[number], np.cumsum([len(i) for i in self.inside[1:]]))
        return [self.inside[0], *[i[f] for i, f in zip(self.inside[1:], flags)]]


_ASKED = "block long, range int, keys binary, times binary"
_ANSWERED = "block long, range int, answer binary"


def score(docs: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT, alpha: float = ALPHA,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_backoff, log_score, mean_log_score): ``n_backoff`` counts the words after
    the first that were scored with less than their longest context."""
    size, everything = docs.select(F.sum(F.octet_length("text")), F.sum(
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()
    everything = everything or 0
    blocks = max(1, -(-(size or 0) // block_bytes))
    ranges = max(1, -(-blocks // RANGE_BLOCKS))
    bits = cut_bits(everything * order)
    kind = docs.schema["doc_id"].dataType.simpleString()
    # The rows' own number deals copies of one document out like others.
    dealt = docs.select(F.pmod(F.xxhash64("doc_id", "text", F.monotonically_increasing_id()), F.lit(blocks)).alias("block"),
                        "doc_id", F.col("text").cast("binary").alias("text"))

    def ask_thin(block: pd.DataFrame) -> pd.DataFrame:
        keys, times = Block(block["text"].tolist(), order).cut(64 - bits)
        return rows(keys, np.minimum(times, min_count), edges(ranges, bits)).assign(block=block["block"].iloc[0])

    def answer_thin(asked: pd.DataFrame) -> pd.DataFrame:
        _, total, places = totals(asked)
        return asked[["block", "range"]].assign(answer=[np.packbits(total[p] >= min_count).tobytes() for p in places])

    def often(answers: pd.DataFrame) -> Callable[[np.ndarray], np.ndarray]:
        """Whether each of a block's cut hashes occurs often enough, from the bits of its ranges."""

        def flags(keys: np.ndarray) -> np.ndarray:
            at = borders(keys, edges(ranges, bits))
            out = np.zeros(len(keys), bool)
            for r, answer in zip(answers["range"], answers["answer"]):
                out[at[r]:at[r + 1]] = np.unpackbits(np.frombuffer(answer, np.uint8), count=at[r + 1] - at[r])
            return out

        return flags

    def ask_exact(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        words = Block(block["text"].tolist(), order)
        asked = words.passed(64 - bits, often(answers))
        keys, times = np.unique(np.concatenate([g[i] for g, i in zip(words.grams, asked)]), return_counts=True)
        return rows(keys, times, edges(ranges, 64)).assign(block=block["block"].iloc[0])

    def answer_exact(asked: pd.DataFrame) -> pd.DataFrame:
        _, total, places = totals(asked)
        return asked[["block", "range"]].assign(answer=[small(total[p]) for p in places])

    def finish(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        words = Block(block["text"].tolist(), order)
        asked = words.passed(64 - bits, often(answers[answers["round"] == 0]))
        _, number = np.unique(np.concatenate([g[i] for g, i in zip(words.grams, asked)]), return_inverse=True)
        exact = answers[answers["round"] == 1].sort_values("range")
        found = np.concatenate([np.empty(0, np.int64), *map(unsmall, exact["answer"])])
        n, place = len(words.place), words.place
        seen = np.zeros((order, n))  # per order, the count of the n-gram that ends at each position
        parts = np.split(found[number], np.cumsum([len(i) for i in asked])[:-1])
        for k, (i, counts) in enumerate(zip(asked, parts)):
            seen[k, i] = np.where(counts >= min_count, counts, 0) if k else counts
        log, level = np.full(n, np.nan), np.zeros(n, np.int64)
        for k in range(order, 0, -1):  # the longest n-gram that is frequent enough decides
            if k > 1:
                context = np.r_[0.0, seen[k - 2][:-1]]
                use = np.isnan(log) & (place >= k - 1) & (seen[k - 1] > 0)
            else:
                context, use = np.full(n, float(everything)), np.isnan(log)
            backed = np.minimum(place, order - 1) - (k - 1)
            log[use] = np.log(seen[k - 1][use] / context[:n][use]) + backed[use] * np.log(alpha)
            level[use] = k
        total = np.bincount(words.of, log, len(block))
        short = np.bincount(words.of, (level <= np.minimum(place, order - 1)).astype(float), len(block))
        return pd.DataFrame({
            "doc_id": block["doc_id"].array, "n_words": words.counts, "n_backoff": short.astype(np.int64),
            "log_score": np.round(total, 4), "mean_log_score": np.round(total / np.maximum(words.counts, 1), 6)})

    by_block = dealt.groupBy("block")
    thin = staged(by_block.applyInPandas(ask_thin, _ASKED).groupBy("range").applyInPandas(answer_thin, _ANSWERED), "thin")
    exact = (by_block.cogroup(thin.groupBy("block")).applyInPandas(ask_exact, _ASKED)
             .groupBy("range").applyInPandas(answer_exact, _ANSWERED))
    both = thin.withColumn("round", F.lit(0)).unionByName(exact.withColumn("round", F.lit(1)))
    return by_block.cogroup(both.groupBy("block")).applyInPandas(
        finish, f"doc_id {kind}, n_words long, n_backoff long, log_score double, mean_log_score double")
