"""Size-balanced shards from sampled splitters (operator 4).

Records are ordered by (hash of the text, doc_id, number of the row in a staged copy).  A sample that
takes every record with a probability proportional to its size gives quantile boundaries, by which the
records are range-partitioned.  The exact size of every range is then counted; ranges that came out
overfull are subdivided by a denser sample of their own, all in one pass, until none is (or it is a
single record): repeated rows have numbers of their own, so a range of equal keys splits like any
other.  Running sizes inside the ranges and prefix sums over the range table give every record its exact position
in the ordered stream of bytes, which is cut into equal stretches: the shards.

Equal texts (one hash) stay together in a shard, unless the group is larger than 1/256 of a shard;
such a group (at most 256 a shard) is cut by its records.  A text that a third of all rows share therefore fills as many
ranges and shards as its size asks for.

Only (doc_id, size, two checksums, number) move; texts never do.  The driver sees the sample (about
``SAMPLE`` records, as every row is drawn by itself), the boundaries, the hashes of the large groups and
one row per shard, all bounded.

Defined cases: a null text has size 1 and the empty text's checksum; null doc_ids come first; repeated rows are
separate records with neighbouring places; an empty table gives an empty result; extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.common import staged, text_of

SHARDS = 16
SAMPLE = 40_000
RANGES_PER_SHARD = 16
#: Groups of equal texts above this part of a shard are cut.
GROUP_PART = 256
#: Records drawn from an overfull range.
DENSER = 1000
_LOW = np.iinfo(np.int64).min


def records(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, h, id, row): id is doc_id with null as the smallest number."""
    return docs.select(
        "doc_id", (F.octet_length(text_of()) + 1).cast("long").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"), F.xxhash64(text_of()).alias("h"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOW)).alias("id"), F.monotonically_increasing_id().alias("row"))


def sample(rows: DataFrame, total: Column, target: int, salt: int) -> pd.DataFrame:
    """(range, h, id, row, weight): about ``target`` of every ``total``, each row drawn by itself with
    probability size * target / total (1 at most); ``weight`` is the size that a drawn row stands for."""
    draw = F.shiftrightunsigned(F.xxhash64("h", "id", "row", F.lit(salt)), 11) / F.lit(float(1 << 53))
    chance = F.least(F.col("size") * F.lit(float(target)) / F.greatest(total, F.lit(1)), F.lit(1.0))
    drawn = rows.where(draw < chance).select("range", "h", "id", "row", (F.col("size") / chance).alias("weight")).toPandas()
    return drawn.sort_values(["range", "h", "id", "row"], kind="stable")


def boundaries(drawn: pd.DataFrame, ranges: int, large: set[int]) -> set[tuple[int, int, int]]:
    """Quantile boundaries (h, id, row): a range starts with its boundary.

    A boundary inside a group of equal hashes moves to the group's start; only in large groups the
    later ones stay, and there is one at the end.
    """
    if drawn.empty or ranges < 2:
        return set()
    at = drawn["weight"].cumsum().to_numpy()
    pick = np.searchsorted(at, at[-1] * np.arange(1, ranges) / ranges)
    keys = drawn[["h", "id", "row"]].to_numpy(np.int64)[np.minimum(pick, len(at) - 1)].tolist()
    found = set()
    for h, i, row in keys:
        found.add((h, _LOW, 0))
        if h in large:
            found.update({(h, i, row), (h + 1, _LOW, 0)})
    return found


def not_after(edges: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
    """How many of the sorted boundaries are not after each key, compared column by column."""
    low, high = np.searchsorted(edges[:, 0], keys[0], "left"), np.searchsorted(edges[:, 0], keys[0], "right")
    if len(keys) == 1:
        return high
    out = low.copy()
    for a, b in {(int(a), int(b)) for a, b in zip(low, high) if b > a}:
        mine = (low == a) & (high == b)
        out[mine] = a + not_after(edges[a:b, 1:], [k[mine] for k in keys[1:]])
    return out


def range_of(rows: DataFrame, edges: set[tuple[int, int, int]]) -> DataFrame:
    """Adds ``range``: how many boundaries are not after the record."""
    table = np.array(sorted(edges), np.int64).reshape(-1, 3)

    @F.pandas_udf("int")
    def number(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(not_after(table, [x.to_numpy() for x in part]).astype(np.int32))

    return rows.withColumn("range", number("h", "id", "row") if edges else F.lit(0))


def splitters(rows: DataFrame, total: int, ranges: int, large: set[int], target: int = SAMPLE) -> set[tuple[int, int, int]]:
    """Boundaries of about ``ranges`` ranges, none over twice its share unless it is one record or one
    group of equal texts that is not large."""
    edges = boundaries(sample(rows.withColumn("range", F.lit(0)), F.lit(total), target, 0), ranges, large)
    limit = 2 * total / ranges
    for round_no in range(1, 8):
        ranged = range_of(rows, edges)
        full = {r["range"]: r["size"] for r in (
            ranged.groupBy("range").agg(F.sum("size").alias("size"), F.min(F.struct("h", "id", "row")).alias("a"),
                                        F.max(F.struct("h", "id", "row")).alias("b"))
            .where((F.col("size") > limit) & (F.col("a") != F.col("b"))).select("range", "size").collect())}
        if not full:  # at most ``ranges`` / 2 of them
            break
        size = F.create_map(*[F.lit(x) for pair in full.items() for x in pair])[F.col("range")]
        drawn = sample(ranged.where(size.isNotNull()), size, DENSER, round_no)
        added = set(edges)
        for r, part in drawn.groupby("range"):
            added |= boundaries(part, int(2 * full[r] / limit) + 2, large)
        if added == edges:
            break
        edges = added
    return edges


def shard(docs: DataFrame, shards: int = SHARDS, ranges_per_shard: int = RANGES_PER_SHARD) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row; law ``bytes``."""
    rows = staged(records(docs), "records")
    total = rows.agg(F.sum("size")).first()[0] or 0
    # Groups of equal texts that are cut: at most GROUP_PART a shard
    large = rows.groupBy("h").agg(F.sum("size").alias("group")).where(F.col("group") > total / shards / GROUP_PART)
    hashes = {r["h"] for r in large.select("h").collect()}
    ranged = range_of(rows, splitters(rows, total, shards * ranges_per_shard, hashes))
    order = ["h", "id", "row"]
    group = Window.partitionBy("range", "h")
    inner = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = (ranged.withColumn("no", F.row_number().over(Window.partitionBy("range").orderBy(*order)))
             .withColumn("before", F.sum("size").over(inner) - F.col("size"))
             .withColumn("group_before", F.min("before").over(group))
             .withColumn("group_size", F.sum("size").over(group)))
    sums = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    upto = Window.orderBy("range")  # one row per range
    offsets = staged(sums.select(F.col("range").alias("of"), (F.sum("bytes").over(upto) - F.col("bytes")).alias("bytes_before"),
                                 (F.sum("rows").over(upto) - F.col("rows")).alias("rows_before")), "ranges")
    cut = F.col("h").isin(*sorted(hashes)) if hashes else F.lit(False)
    middle = F.col("bytes_before") + F.when(cut, F.col("before") + F.col("size") / 2).otherwise(
        F.col("group_before") + F.col("group_size") / 2)
    placed = staged(
        local.join(offsets, F.col("range") == F.col("of")).select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
            F.least(F.floor(middle * shards / F.lit(max(1, total))), F.lit(shards - 1)).cast("int").alias("shard"),
            (F.col("rows_before") + F.col("no") - 1).alias("place")), "placed")
    firsts = {r["shard"]: r["first"] for r in placed.groupBy("shard").agg(F.min("place").alias("first")).collect()}
    first = F.create_map(*[F.lit(x) for k, v in firsts.items() for x in (k, v)]) if firsts else F.create_map()
    return placed.select(
        "doc_id", "size", "text_crc32", "law", "shard",
        (F.col("place") - (first[F.col("shard")] if firsts else F.lit(0))).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
