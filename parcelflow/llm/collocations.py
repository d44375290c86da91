"""Phrase collocations mined over a prefix-free parse (operator 11).

Texts are sequences of words with breaks between pieces.  Wherever the rolling hash of a window of
``max_words - 1`` words is zero modulo ``modulus``, one chunk ends with that window and the next one
begins with it, so chunks depend on content alone and equal passages fall into equal chunks.  The
distinct chunks of a language with their number of occurrences are the dictionary; n-grams are
counted inside distinct chunks only, times that number.  Consecutive chunks overlap by the window;
an n-gram is counted in the chunk in whose own part (before its closing window) it starts, so
once.

Only phrases of at least ``min_count`` occurrences matter, parts of candidates included.  Two
passes count hashes (of words, then of word pairs whose words are frequent), cut short and packed by
hash range, and fold those that reach ``min_count`` into a bit table of fixed size.  A table that fills up, as on a very large
corpus, prunes less and loses nothing.  The last pass counts the phrases themselves - all of whose
words and pairs pass - as text, so no result rests on a hash.

All counts are sums in Spark after map-side aggregation: a word, chunk or language that makes up a
third of the corpus is one row per batch.  The driver sees the bit tables alone.

Defined cases: null and empty texts have no words; a null language is ``und``; doc_id and other columns are
not read; repeated rows count as often as they occur; an empty table gives no rows; a very long text is cut into
chunks like any other (a window that repeats may keep a stretch whole, which is bounded by its text).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.common import staged
from parcelflow.llm.packed_keys import cut_bits, edges, rows, totals

MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000
MODULUS = 64
#: Bits of a pass's table of frequent hashes: 8 MB.
TABLE_BITS = 26
#: Bytes of text that are parsed or counted at a time.
SLICE_BYTES = 2_000_000
#: Words of the corpus per range of hashes, and hashes that a task holds before it sends them.
RANGE_WORDS = 4_000_000
HELD_HASHES = 2_000_000
# Characters that end a piece, and those that end a word inside a piece.
BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
#: A-Z in lower case, every break as a line feed, every blank as a space.
_PLAIN = bytes.maketrans(bytes(range(65, 91)) + BREAKS + BLANKS,
                         bytes(range(97, 123)) + b"\n" * len(BREAKS) + b" " * len(BLANKS))
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class _Powers:
    """Powers of the hash base and of its inverse modulo 2 ** 64."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) <= n:
            for name, x in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(n + 1, x, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.multiply.accumulate(steps))
        return cls.up, cls.down


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= _MIX
    return h ^ (h >> np.uint64(29))


def _longer(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a phrase from those of the phrase without its last word and of its last word."""
    return _mixed(left * np.uint64(_BASE) + right)


class Words:
    """The words of normalised bytes: where they lie, their hashes, and where a break precedes them."""

    def __init__(self, data: bytes):
        self.raw = raw = np.frombuffer(data, np.uint8)
        inside = (raw != 32) & (raw != 10)
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        self.start, self.end = edge[::2], edge[1::2]
        up, down = _Powers.upto(len(raw))
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw + np.uint64(1)) * up[:len(raw)], out=sums[1:])
        self.hash = _mixed((sums[self.end] - sums[self.start]) * down[self.start])
        line = np.cumsum(raw == 10)
        at = line[self.start] if len(raw) else np.empty(0, np.int64)
        #: Number of the piece that each word is in.
        self.piece = at


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges of about ``SLICE_BYTES`` (one entry at least)."""
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, "right"))
        yield at, max(at + 1, stop)
        at = max(at + 1, stop)


def parse(texts: list[bytes], overlap: int, modulus: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(text number, number of own words, chunk) of every chunk; words are joined with a space, or
    with a line feed at a break."""
    data = b"\n".join(texts).translate(_PLAIN)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    w = Words(data)
    n = len(w.start)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), []
    owner = np.searchsorted(ends, w.start, "right")
    # Normalised bytes: each word and one separator after it.
    room = w.end - w.start + 1
    stop = np.cumsum(room)
    flat = w.raw[np.minimum(np.arange(stop[-1]) + np.repeat(w.start - (stop - room), room), len(w.raw) - 1)].copy()
    flat[stop[:-1] - 1] = np.where(w.piece[1:] != w.piece[:-1], 10, 32)
    flat = flat.tobytes()
    # Trigger windows: ``overlap`` words of one text.
    window = w.hash.copy()
    for i in range(1, min(overlap, n)):
        window[:n - i] = _longer(window[:n - i], w.hash[i:])
    full, some = np.zeros(n, bool), max(0, n - overlap + 1)
    full[:some] = owner[:some] == owner[overlap - 1:]
    first = np.concatenate([[True], owner[1:] != owner[:-1]])
    begin = np.flatnonzero(first | (full & (window % np.uint64(modulus) == 0)))
    text_end = np.searchsorted(owner, owner[begin], "right")
    own_end = np.append(begin[1:], n)
    last = np.minimum(own_end + overlap, text_end)
    a, b = (stop - room)[begin], stop[last - 1] - 1
    return owner[begin], own_end - begin, [flat[i:j] for i, j in zip(a.tolist(), b.tolist())]


def chunks(docs: DataFrame, overlap: int, modulus: int) -> DataFrame:
    """(lang, own, chunk, times): the dictionary of the parse, with parse frequencies."""
    texts_ = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.col("text").cast("binary").alias("text")).where(F.octet_length("text") > 0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts, lang = b["text"].tolist(), b["lang"].to_numpy()
            for i, j in _slices(b["text"].map(len).to_numpy()):
                owner, own, found = parse(texts[i:j], overlap, modulus)
                yield pd.DataFrame({"lang": lang[i + owner], "own": own, "chunk": found})

    parsed = texts_.mapInPandas(run, "lang string, own int, chunk binary")
    return parsed.groupBy("lang", "own", "chunk").agg(F.count("*").alias("times"))


class Batch:
    """Some dictionary entries as flat arrays: words, languages, weights, and who may start an n-gram."""

    def __init__(self, b: pd.DataFrame):
        found = b["chunk"].tolist()
        self.data = b"\n".join(found)
        self.words = w = Words(self.data)
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
        of = np.searchsorted(ends, w.start, "right")
        first = np.searchsorted(of, np.arange(len(found)))
        own = np.arange(len(of)) - first[of] < b["own"].to_numpy()[of]
        self.starts = own
        self.times = b["times"].to_numpy(np.int64)[of]
        names, number = np.unique(b["lang"].to_numpy(), return_inverse=True)
        salt = np.array([hash_name(x) for x in names], np.uint64)
        self.lang, self.langs = number[of], names
        self.salt = salt[self.lang]

    def within(self, k: int) -> np.ndarray:
        """Whether k words from each word on lie in one piece (breaks separate chunks, too)."""
        n, piece = len(self.starts), self.words.piece
        out = np.zeros(n, bool)
        out[:max(0, n - k + 1)] = piece[:max(0, n - k + 1)] == piece[k - 1:]
        return out

    def hashes(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on, mixed with the language."""
        h = self.words.hash.copy()
        for i in range(1, min(k, len(h))):
            h[:len(h) - i] = _longer(h[:len(h) - i], self.words.hash[i:])
        return _mixed(h ^ self.salt)


def hash_name(name: str) -> int:
    """A 64-bit number for a language."""
    h = 0
    for c in name.encode("utf-8", "surrogatepass"):
        h = (h * _BASE + c + 1) % (1 << 64)
    return h


class Table:
    """Bit table over hashes."""

    def __init__(self, bits: np.ndarray, size: int = TABLE_BITS):
        self.bits, self.shift = bits, np.uint64(64 - size)

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h >> self.shift
        return (self.bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _all_in(has: np.ndarray, parts: int) -> np.ndarray:
    """Whether ``parts`` consecutive entries from each on are set (those after the end do not count)."""
    out = has.copy()
    for i in range(1, min(parts, len(has))):
        out[:len(out) - i] &= has[i:]
    return out


def frequent_table(dictionary: DataFrame, k: int, words: Table | None, min_count: int, total: int,
                   size: int = TABLE_BITS) -> Table:
    """The table of the hashes of k-word phrases that occur ``min_count`` times; with the table of
    words, only phrases of frequent words are counted.

    Hashes are cut to the bits that tell the corpus's phrases apart and travel packed, by range;
    ``total`` is the number of words.
    """
    shared = dictionary.sparkSession.sparkContext.broadcast(words)
    bits = max(size, cut_bits(total))
    cuts = edges(max(1, -(-total // RANGE_WORDS)), bits)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, held, count = shared.value, [], 0

        def merged() -> pd.DataFrame:
            h, number = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
            times = np.zeros(len(h), np.int64)
            np.add.at(times, number, np.concatenate([x for _, x in held]))
            return rows(h, times, cuts)

        for b in batches:
            for i, j in _slices(b["chunk"].map(len).to_numpy()):
                part = Batch(b.iloc[i:j])
                use = part.starts & part.within(k)
                if table is not None:
                    use &= _all_in(table.has(part.hashes(1)), k)
                held.append((part.hashes(k)[use] >> np.uint64(64 - bits), part.times[use]))
                count += len(held[-1][0])
                if count > HELD_HASHES:
                    yield merged()
                    held, count = [], 0
        if count:
            yield merged()

    def often(met: pd.DataFrame) -> pd.DataFrame:
        keys, times, _ = totals(met)
        at = keys[times >= min_count] >> np.uint64(bits - size)
        word, number = np.unique(at >> np.uint64(6), return_inverse=True)
        out = np.zeros(len(word), np.uint64)
        np.bitwise_or.at(out, number, np.uint64(1) << (at & np.uint64(63)))
        return pd.DataFrame({"at": word.astype(np.int64), "bits": out.view(np.int64)})

    counted = (dictionary.mapInPandas(run, "range int, keys binary, times binary").groupBy("range")
               .applyInPandas(often, "at long, bits long"))
    # At most 2 ** (size - 6) rows
    found = counted.groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas()
    table = np.zeros(1 << (size - 6), np.uint64)
    table[found["at"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return Table(table, size)


def _same_bytes(raw: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the bytes at ``a`` and at ``b`` are equal over ``length`` (positive) bytes."""
    ends = np.cumsum(length)
    step = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - length, length)
    same = raw[np.repeat(a, length) + step] == raw[np.repeat(b, length) + step]
    return np.logical_and.reduceat(same, ends - length) if len(ends) else np.empty(0, bool)


def counts(dictionary: DataFrame, words: Table, pairs: Table, max_words: int, min_count: int) -> DataFrame:
    """(lang, k, phrase, n): every phrase of up to ``max_words`` words that occurs ``min_count`` times."""
    shared = dictionary.sparkSession.sparkContext.broadcast((words, pairs))

    def count(part: Batch, k: int, use: np.ndarray) -> pd.DataFrame:
        w, at = part.words, np.flatnonzero(use)
        _, first, number = np.unique(part.hashes(k)[at], return_index=True, return_inverse=True)
        a, b = w.start[at], w.end[at + k - 1]
        # Words of one piece are joined with single spaces, so equal phrases are equal bytes.
        size, named = b - a, first[number]
        same = (size == size[named]) & (part.lang[at] == part.lang[at][named])
        same[same] = _same_bytes(w.raw, a[same], a[named][same], size[same])
        times = np.bincount(number[same], part.times[at][same], len(first)).astype(np.int64)
        rest = np.flatnonzero(~same)  # equal hash, other phrase: a row of its own
        pick = np.concatenate([first, rest])
        return pd.DataFrame({
            "lang": part.langs[part.lang[at[pick]]],
            "phrase": [part.data[i:j] for i, j in zip(a[pick].tolist(), b[pick].tolist())],
            "n": np.concatenate([times, part.times[at[rest]]])})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, pairs = shared.value
        for b in batches:
            for i, j in _slices(b["chunk"].map(len).to_numpy()):
                part = Batch(b.iloc[i:j])
                one = words.has(part.hashes(1))
                yield count(part, 1, part.starts & one)
                two = pairs.has(part.hashes(2)) & _all_in(one, 2) & part.within(2)
                for k in range(2, max_words + 1):
                    yield count(part, k, part.starts & _all_in(two, k - 1) & part.within(k))

    counted = dictionary.mapInPandas(run, "lang string, phrase binary, n long")
    often = counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    return often.select("lang", F.size(F.split(F.col("phrase").cast("string"), " ", -1)).alias("k"),
                        F.col("phrase").cast("string").alias("phrase"), "n")


def _first(phrase: Column, k: Column) -> Column:
    """The first k words; the last -k for a negative k."""
    return F.call_function("substring_index", phrase, F.lit(" "), k)


def scored(frequent: DataFrame, totals: DataFrame, keep_percent: int = 100) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the candidates that no longer one contains.

    A phrase is contained in a longer candidate of ``keep_percent`` percent of its count if and only if
    it is in one that is a word longer, as every phrase between the two occurs at least as often as
    the longer one.
    """
    candidates = frequent.where(F.col("k") >= 2)
    count = frequent.select(F.col("lang").alias("of_lang"), F.col("phrase").alias("of"), F.col("n").alias("of_n"))
    # Every candidate against its parts at every cut
    cuts = candidates.select("lang", "k", "phrase", F.col("n").alias("a"),
                             F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    spans = cuts.select("*", F.explode(F.array(
        F.struct(F.lit("l").alias("side"), _first(F.col("phrase"), F.col("cut")).alias("part")),
        F.struct(F.lit("r").alias("side"), _first(F.col("phrase"), F.col("cut") - F.col("k")).alias("part")))).alias("s"))
    met = (spans.join(count, (F.col("lang") == F.col("of_lang")) & (F.col("s.part") == F.col("of")))
           .groupBy("lang", "phrase", "k", "a", "cut").agg(F.max(F.when(F.col("s.side") == "l", F.col("of_n"))).alias("l"),
                                                          F.max(F.when(F.col("s.side") == "r", F.col("of_n"))).alias("r")))
    wide = "decimal(38,0)"
    score = F.call_function("div", (F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(17,0)")
                                    * F.col("n").cast("decimal(17,0)")).cast(wide),
                            (F.col("l").cast("decimal(18,0)") * F.col("r").cast("decimal(18,0)")).cast(wide))
    best = (met.join(totals, "lang").withColumn("score", score).groupBy("lang", "phrase", "k", "a")
            .agg(F.min(F.struct("score", "cut", "l", "r", "n")).alias("b")))
    longer = (candidates.where(F.col("k") >= 3).select(
        "lang", F.col("n").alias("longer"), F.explode(F.array(
            _first(F.col("phrase"), F.col("k") - 1), _first(F.col("phrase"), 1 - F.col("k")))).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    return (best.join(longer, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * keep_percent))
            .select("lang", "phrase", "a", "b.l", "b.r", "b.n", "b.score"))


def mine(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int | None = TOP,
         modulus: int = MODULUS, keep_percent: int = 100, table_bits: int = TABLE_BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases (all for None), best first.

    ``max_words`` is 2 at least, ``table_bits`` 6 at least.
    """
    dictionary = staged(chunks(docs, max_words - 1, modulus), "dictionary")
    by_lang = staged(dictionary.groupBy("lang").agg(F.sum(F.col("own") * F.col("times")).alias("n")), "totals")
    total = by_lang.agg(F.sum("n")).first()[0] or 0
    words = frequent_table(dictionary, 1, None, min_count, total, table_bits)
    pairs = frequent_table(dictionary, 2, words, min_count, total, table_bits)
    frequent = staged(counts(dictionary, words, pairs, max_words, min_count), "frequent")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored(frequent, by_lang, keep_percent).withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
