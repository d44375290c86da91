"""Best-fit packing by exact-complement hashing (operator 13).

Documents are cut into pieces of at most ``window`` tokens; a piece of a whole window is a sequence of
its own.  All others differ, for packing, in their length alone, so the plan is made on the
histogram of lengths.  The longest length left opens a sequence; an index of the sums that one, two
or three available lengths can make says whether the gap can be filled exactly, and if not which
largest sum below it leaves the smallest residual.  A combination is consumed as often as its
availability counts allow, at once.  What the gap still leaves is filled in the same way, until no
length fits.

The plan gives, for every length, stretches of ranks with the sequence and place that they take.  It
has a few entries per length, whatever the number of documents, and is all that the driver
makes or broadcasts.  Each piece finds its rank among the pieces of its length from its number in
its task and a prefix sum over the (task, length) counts, and its place by binary search.  A length
that a third of all pieces share is one histogram cell and its pieces stay spread over their tasks.

Defined cases: a null or empty text is the closing token alone; null doc_ids are carried through; repeated rows
are packed as often as they occur; a text of any length is cut into as many pieces as it needs; an
empty table gives no pieces; extra columns are dropped.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.bpe import encoder, slices
from parcelflow.llm.common import staged, text_of
from parcelflow.llm.flat_words import FlatWords

WINDOW = 2048
CLOSING_ID = 0


def pieces(docs: DataFrame, path: str, window: int = WINDOW, keep_ids: bool = False) -> DataFrame:
    """(task, number, doc_id, piece, start, length, ids_crc32[, ids]): ``number`` counts the pieces of
    the same length earlier in the same task; ids are little-endian unsigned 32-bit integers."""
    rows = docs.select("doc_id", text_of().alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = encoder(FlatWords, path)
        task, closing = TaskContext.get().partitionId(), np.array([CLOSING_ID], "<u4")
        seen = np.zeros(window + 1, np.int64)
        for b in batches:
            texts, doc_ids = b["text"].tolist(), b["doc_id"].array
            for i, j in slices(texts):
                owner, piece, length, crc, kept = [], [], [], [], []
                for at, ids in enumerate(words.encode_batch(texts[i:j]), i):
                    ids = np.concatenate([ids, closing], dtype="<u4")
                    for no, start in enumerate(range(0, len(ids), window)):
                        part = ids[start:start + window].tobytes()
                        owner.append(at)
                        piece.append(no)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if keep_ids:
                            kept.append(part)
                length = np.array(length, np.int64)
                order = np.argsort(length, kind="stable")
                found, first, count = np.unique(length[order], return_index=True, return_counts=True)
                number = np.empty(len(length), np.int64)
                number[order] = np.arange(len(length)) - np.repeat(first, count) + np.repeat(seen[found], count)
                seen[found] += count
                out = pd.DataFrame({"task": task, "number": number, "doc_id": doc_ids[owner], "piece": piece,
                                    "start": np.array(piece, np.int64) * window, "length": length, "ids_crc32": crc})
                yield out.assign(ids=kept) if keep_ids else out

    return rows.mapInPandas(run, f"task int, number long, doc_id {rows.schema['doc_id'].dataType.simpleString()}, "
                                 f"piece int, start long, length long, ids_crc32 long{', ids binary' if keep_ids else ''}")


class SumIndex:
    """Which sums up to ``top`` one, two or three of the available lengths make, as bit sets."""

    def __init__(self, left: np.ndarray, top: int):
        self.left, within = left, (1 << (top + 1)) - 1
        self.lengths = np.flatnonzero(left[:top + 1]).tolist()[::-1]
        one = sum(1 << x for x in self.lengths)
        two = three = 0
        for x in self.lengths:
            two |= (one if left[x] > 1 else one & ~(1 << x)) << x & within
        for x in self.lengths:
            three |= two << x & within
        self.sums = (one, two, three)

    def best(self, gap: int) -> tuple[int, ...]:
        """The available lengths, three at most, whose sum comes closest to ``gap`` from below:
        of equal sums the one of fewest parts."""
        below = (1 << (gap + 1)) - 1
        rest = (self.sums[0] | self.sums[1] | self.sums[2]) & below
        while rest:
            total = rest.bit_length() - 1
            for parts, sums in enumerate(self.sums, 1):
                if sums >> total & 1:
                    found = self._parts(total, parts, Counter())
                    if found:
                        return found
            rest &= (1 << total) - 1
        return ()

    def _parts(self, total: int, parts: int, taken: Counter) -> tuple[int, ...]:
        """``parts`` lengths with this sum, longest first, within the availability counts."""
        if parts == 1:
            ok = total < len(self.left) and self.left[total] > taken[total]
            return (total,) if ok else ()
        sums = self.sums[parts - 2]
        for x in self.lengths:
            if x < total and sums >> (total - x) & 1 and self.left[x] > taken[x]:
                rest = self._parts(total - x, parts - 1, taken + Counter([x]))
                if rest:
                    return (x, *rest)
        return ()


def plan(counts: np.ndarray, window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of one sequence, number of such sequences) for ``counts[length]`` pieces."""
    left = np.array(counts, np.int64)
    out = [((window,), int(left[window]))] if left[window] else []
    for opener in range(window - 1, 0, -1):
        index = None
        while left[opener]:
            # The index holds what is there besides the opener; it is made anew when a length runs out.
            if index is None:
                index = SumIndex(left, window - opener)
            left[opener] -= 1
            filled = [opener]
            fit = index.best(window - opener)
            while fit:
                filled += fit
                left -= np.bincount(fit, minlength=len(left))
                gap = window - sum(filled)
                fit = index.best(gap) if gap else ()
            each = Counter(filled)
            left += np.bincount(filled, minlength=len(left))
            times = min(int(left[x]) // n for x, n in each.items())
            for x, n in each.items():
                left[x] -= times * n
            out.append((tuple(filled), times))
            if any(left[x] <= 2 for x in each):
                index = None
    return out


def stretches(patterns: list[tuple[tuple[int, ...], int]], window: int) -> pd.DataFrame:
    """(length, rank, sequence, offset): from this rank on, pieces of this length take the
    sequences from this one on, one each, at this offset."""
    used, rows, sequence = np.zeros(window + 1, np.int64), [], 0
    for lengths, times in patterns:
        offset = 0
        for x in lengths:
            rows.append((x, int(used[x]), sequence, offset))
            used[x] += times
            offset += x
        sequence += times
    return pd.DataFrame(rows, columns=["length", "rank", "sequence", "offset"]).sort_values(["length", "rank"])


def pack(docs: DataFrame, path: str, window: int = WINDOW, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset and, if asked for, ids."""
    cut = staged(pieces(docs, path, window, keep_ids), "pieces")
    sums = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    same = Window.partitionBy("length")
    before = staged(sums.select(F.col("task").alias("of_task"), F.col("length").alias("of_length"), "n",
                                (F.sum("n").over(same.orderBy("task")) - F.col("n")).alias("before")), "counts")
    counts = np.zeros(window + 1, np.int64)
    for row in before.groupBy("of_length").agg(F.sum("n").alias("n")).collect():  # one row per length
        counts[row["of_length"]] = row["n"]
    ways = stretches(plan(counts, window), window)
    start = np.cumsum(counts) - counts  # pieces of shorter lengths
    first = start[ways["length"]] + ways["rank"].to_numpy()
    sequence, offset = ways["sequence"].to_numpy(), ways["offset"].to_numpy()

    @F.pandas_udf("struct<sequence_id: long, offset: long>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = start[length.to_numpy()] + rank.to_numpy()
        way = np.searchsorted(first, at, "right") - 1
        return pd.DataFrame({"sequence_id": sequence[way] + at - first[way], "offset": offset[way]})

    ranked = cut.join(before, (F.col("task") == F.col("of_task")) & (F.col("length") == F.col("of_length")))
    placed = ranked.withColumn("place", place("length", F.col("before") + F.col("number")))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset",
                         *["ids"] * keep_ids)
