"""Nearest neighbours along shifted Hilbert curves (operator 2).

Vectors are projected to a few dimensions; several Hilbert curves - each with its own rotation and
shift of the projection - give every vector a key.  Spark range-partitions the vectors by (curve,
key) and numbers them; stretches of neighbouring numbers, with ``window`` vectors of the stretches
before and after, are the tasks, so a query is compared with the ``window`` vectors on either side of it
wherever it lies.  The windows of all curves merge, duplicates out, into each query's best.

Neighbouring keys alone find what a projection can keep apart.  Where vectors have no such
structure (isotropic noise) a curve keeps little, so an exact pass follows: stretches of the first curve
are stored as blocks with a centre and a radius, and a query visits every block whose bound (centre
product plus radius) can still beat the worst of its best so far.  On clustered vectors few
blocks pass; on noise most do, and the result is exact either way.  ``exact=False`` returns the
windows' result.

Equal vectors are one index entry with its ``k + 1`` smallest ids, so a vector that a third of the
rows share costs as much as any other.  Scores are cosines in double precision, summed in one fixed order
for whatever is close to a query's best, so that a pair has one score however it was found; ties go
to smaller ids: an entry's smallest id travels with it and decides wherever a best-of list is cut.

Stretches and blocks are bounded in rows and bytes.  Queries meet the blocks' centres and radii in
buckets of blocks, by an equality join.  The driver sees the dimension and the number of vectors alone.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no
part, nor do vectors of another length than the most frequent one (the larger of equally frequent
lengths); null ids take no part; an id with several different vectors is found once per vector and
asks once per vector (best score counts); fewer than ``k`` candidates are all returned; an empty
table gives no rows; extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.common import numbered, staged

CURVES = 4
DIMENSIONS = 8
BITS = 7
WINDOW = 256
NEAREST = 5
BLOCK_ROWS = 2048
BLOCK_BYTES = 16 << 20
#: Neighbouring rows of a curve in one task, without those of its neighbours.
STRETCH_ROWS = 8192
#: Blocks whose centres queries meet together, and queries that do.
BUCKET_BLOCKS = 1024
_QUERY_ROWS = 256
#: More than a sum in another order moves a cosine.
_CLOSE = 1e-9


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of integer coordinates below 2 ** bits.

    Gray-code form: from the highest bit down, axes are exchanged or mirrored as the
    curve's orientation in the surrounding cube asks, then the bits are Gray-decoded together.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = top
    while q > 1:
        flip = np.where(x[n - 1] & q, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


class Curves:
    """Rotations and shifts of the projected space, the same in every task."""

    def __init__(self, width: int, curves: int = CURVES, dimensions: int = DIMENSIONS, bits: int = BITS, seed: int = 3):
        rng = np.random.default_rng(seed)
        m = min(dimensions, width)
        self.bits = bits
        self.turns = [np.linalg.qr(rng.normal(size=(width, m)))[0] for _ in range(curves)]
        self.shifts = [rng.uniform(0, 1, m) for _ in range(curves)]
        self.scale = np.sqrt(width)

    def keys(self, unit: np.ndarray) -> list[np.ndarray]:
        """One key array per curve for unit vectors."""
        side = 1 << self.bits
        out = []
        for turn, shift in zip(self.turns, self.shifts):
            # A projected unit vector has components of about 1/sqrt(width); 3 of them to each side.
            at = (unit @ turn * self.scale / 6 + 0.5) * (side - 1) + shift
            out.append(hilbert_keys(np.clip(at, 0, side - 1).astype(np.int64), self.bits))
        return out


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.empty((0, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosine of one vector with every row of ``x``; each sum runs over one row, always in the same order."""
    return (q * x).sum(1) / (np.sqrt((q[None] * q).sum(1)) * np.sqrt((x * x).sum(1)))


def _nearest(q: np.ndarray, x: np.ndarray, allowed: np.ndarray, least: np.ndarray, k: int
             ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row of ``q``, rows of ``x``, scores): the ``k`` best of the allowed rows, ties by smallest id."""
    about = _unit(q) @ _unit(x).T
    about[~allowed] = -np.inf
    for i, s in enumerate(about):
        edge = np.partition(s, len(s) - k)[len(s) - k] if len(s) > k else -np.inf
        some = np.flatnonzero((s >= edge - _CLOSE) & np.isfinite(s))
        if len(some):
            score = cosines(q[i], x[some])
            best = np.lexsort((least[some], -score))[:k]
            yield i, some[best], score[best]


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): the vectors that take part."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v")).where(
        F.col("vec_id").isNotNull() & (F.size("v") > 0)
        & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
        & F.exists("v", lambda x: x != 0))
    width = rows.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).first()
    return rows.where(F.size("v") == (width["w"] if width else 0))


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best entries of each query: (query, entry, least, score)."""
    once = found.groupBy("query", "entry").agg(F.min("least").alias("least"), F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "least", "entry")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def windows(entries: DataFrame, width: int, k: int, curves: int = CURVES, window: int = WINDOW,
            stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """(query, entry, least, score): each query's ``k`` best in its window of each curve."""
    make = Curves(width, curves)
    kind = entries.schema["least"].dataType.simpleString()

    def key(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                for c, keys in enumerate(make.keys(_unit(_matrix(b["v"])))):
                    yield pd.DataFrame({"curve": c, "key": keys, "entry": b["entry"].array,
                                        "least": b["least"].array, "v": b["v"].array, "asks": b["asks"].array})

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place", kind="stable")
        x, ids, least = _matrix(rows["v"]), rows["entry"].to_numpy(), rows["least"].to_numpy()
        curve, place = rows["curve"].to_numpy(), rows["place"].to_numpy()
        asks = np.flatnonzero(rows["asks"].to_numpy() & rows["own"].to_numpy())
        query, entry, score = [], [], []
        for i in range(0, len(asks), _QUERY_ROWS):
            part = asks[i:i + _QUERY_ROWS]
            low, high = max(0, part[0] - window), min(len(rows), part[-1] + window + 1)
            near = np.abs(place[low:high][None] - place[part][:, None]) <= window
            near &= curve[low:high][None] == curve[part][:, None]
            for q, found, s in _nearest(x[part], x[low:high], near, least[low:high], k):
                query.append(np.full(len(found), part[q]))
                entry.append(low + found)
                score.append(s)
        at = np.concatenate(entry) if entry else np.empty(0, np.int64)
        of = np.concatenate(query) if query else np.empty(0, np.int64)
        return pd.DataFrame({"query": ids[of], "entry": ids[at], "least": least[at],
                             "score": np.concatenate(score) if score else np.empty(0)})

    columns = f"curve int, key long, entry long, least {kind}, v array<double>, asks boolean"
    keyed = entries.mapInPandas(key, columns)
    placed = numbered(keyed, "curve", "key", "entry", tag="curves")
    size = max(stretch_rows, window)
    stretch, inside = F.floor(F.col("place") / size), F.col("place") % size
    copies = F.filter(F.array(
        F.struct(stretch.alias("stretch"), F.lit(True).alias("own")),
        F.when(inside < window, F.struct((stretch - 1).alias("stretch"), F.lit(False).alias("own"))),
        F.when(inside >= size - window, F.struct((stretch + 1).alias("stretch"), F.lit(False).alias("own")))),
        lambda c: c.isNotNull())
    spread = placed.select("curve", "entry", "least", "v", "asks", "place", F.explode(copies).alias("c")).select(
        "curve", "entry", "least", "v", "asks", "place", "c.stretch", "c.own")
    found = spread.groupBy("stretch").applyInPandas(compare, f"query long, entry long, least {kind}, score double")
    return _best(found, k).select("query", "entry", "least", "score")


def blocks(entries: DataFrame, width: int, rows: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(block, centre, radius, entries, least, vectors): stretches of the first curve, packed."""
    make = Curves(width, 1)
    kind = entries.schema["least"].dataType.simpleString()
    size = max(1, min(block_rows, BLOCK_BYTES // (8 * width)))

    def key(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield b[["entry", "least", "v"]].assign(key=make.keys(_unit(_matrix(b["v"])))[0])[["key", "entry", "least", "v"]]

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def row(part: pd.DataFrame) -> pd.DataFrame:
            x = _matrix(part["v"])
            unit = _unit(x)
            centre = unit.mean(0)
            radius = np.sqrt(((unit - centre) ** 2).sum(1).max())
            return pd.DataFrame({"centre": [centre], "radius": [float(radius)],
                                 "entries": [part["entry"].to_numpy(np.int64).tobytes()],
                                 "least": [part["least"].tolist()], "vectors": [x.tobytes()]})

        held = None
        for b in batches:
            held = b if held is None else pd.concat([held, b], ignore_index=True)
            while len(held) >= size:
                yield row(held.iloc[:size])
                held = held.iloc[size:].reset_index(drop=True)
        if held is not None and len(held):
            yield row(held)

    keyed = entries.select("entry", "least", "v").mapInPandas(key, f"key long, entry long, least {kind}, v array<double>")
    dealt = keyed.repartitionByRange(max(1, -(-rows // size)), "key", "entry").sortWithinPartitions("key", "entry")
    return dealt.mapInPandas(bundle, f"centre array<double>, radius double, entries binary, least array<{kind}>, vectors binary").select(
        F.xxhash64("entries").alias("block"), "centre", "radius", "entries", "least", "vectors")


def complete(entries: DataFrame, found: DataFrame, width: int, rows: int, k: int) -> DataFrame:
    """(query, entry, least, score) of every block visit that can change a query's ``k`` best."""
    index = staged(blocks(entries, width, rows), "blocks")
    worst = found.groupBy("query").agg(F.min("score").alias("worst"), F.count("*").alias("n")).select(
        "query", F.when(F.col("n") >= k, F.col("worst")).otherwise(-2.0).alias("worst"))
    asking = entries.where("asks").select(F.col("entry").alias("query"), "v").join(worst, "query", "left").fillna(
        {"worst": -2.0})
    buckets = max(1, -(-index.count() // BUCKET_BLOCKS))
    heads = (index.select(F.pmod("block", F.lit(buckets)).alias("bucket"), F.struct("block", "centre", "radius").alias("head"))
             .groupBy("bucket").agg(F.collect_list("head").alias("heads")))

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), _QUERY_ROWS):
                part = b.iloc[i:i + _QUERY_ROWS]
                yield pd.DataFrame({"queries": [part["query"].to_numpy(np.int64).tobytes()],
                                    "asked": [_matrix(part["v"]).tobytes()], "worst": [part["worst"].to_numpy().tobytes()]})

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for queries, asked, limit, head in zip(b["queries"], b["asked"], b["worst"], b["heads"]):
                ids, x = np.frombuffer(queries, np.int64), np.frombuffer(asked).reshape(-1, width)
                centres, radii = np.stack([h["centre"] for h in head]), np.array([h["radius"] for h in head])
                meet = _unit(x) @ centres.T + radii + _CLOSE >= np.frombuffer(limit)[:, None]
                # One row per block and group of queries: those that visit it, packed
                out = [(head[j]["block"], ids[meet[:, j]].tobytes(), x[meet[:, j]].tobytes())
                       for j in np.flatnonzero(meet.any(0)).tolist()]
                yield pd.DataFrame(out, columns=["block", "queries", "asked"])

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for entries_, least, vectors, queries, asked in zip(
                    b["entries"], b["least"], b["vectors"], b["queries"], b["asked"]):
                x, q = np.frombuffer(vectors).reshape(-1, width), np.frombuffer(asked).reshape(-1, width)
                ids, qs, least = np.frombuffer(entries_, np.int64), np.frombuffer(queries, np.int64), np.asarray(least)
                hits = list(_nearest(q, x, np.ones((len(q), len(x)), bool), least, k))
                at = np.concatenate([h[1] for h in hits])
                yield pd.DataFrame({"query": np.concatenate([np.full(len(h[1]), qs[h[0]]) for h in hits]),
                                    "entry": ids[at], "least": least[at], "score": np.concatenate([h[2] for h in hits])})

    groups = asking.mapInPandas(gather, "queries binary, asked binary, worst binary").withColumn(
        "bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))))
    visits = groups.join(heads, "bucket").select("queries", "asked", "worst", "heads").mapInPandas(
        route, "block long, queries binary, asked binary")
    kind = entries.schema["least"].dataType.simpleString()
    met = visits.join(index.select("block", "entries", "least", "vectors"), "block").select(
        "entries", "least", "vectors", "queries", "asked")
    return met.mapInPandas(visit, f"query long, entry long, least {kind}, score double").unionByName(found)


def search(vectors: DataFrame, queries: DataFrame, k: int = NEAREST, exact: bool = True) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest other rows of every query row.

    Both frames have (vec_id, embedding).
    """
    rows = usable(vectors)
    asks = usable(queries)
    order = Window.partitionBy("v").orderBy("vec_id")
    # One entry per distinct vector, named by a number of its own; its k + 1 smallest ids can matter.
    members = staged(rows.select("vec_id", F.transform("v", lambda x: x.cast("double")).alias("v"))
                     .distinct().withColumn("no", F.row_number().over(order)).where(F.col("no") <= k + 1)
                     .withColumn("entry", F.xxhash64("v")), "members")
    asked = staged(asks.select("vec_id", F.xxhash64(F.transform("v", lambda x: x.cast("double"))).alias("entry"))
                   .distinct(), "asked")
    entries = staged(members.where("no = 1").select("entry", F.col("vec_id").alias("least"), "v").join(
        asked.select(F.col("entry").alias("a")).distinct(), F.col("entry") == F.col("a"), "left").select(
        "entry", "least", "v", F.col("a").isNotNull().alias("asks")), "entries")
    first = entries.select(F.size("v").alias("w")).first()
    width, total = (first["w"] if first else 1), entries.count()
    # The query's own entry is one of its hits (it may have other members), hence k + 1.
    found = staged(windows(entries, width, k + 1), "windows")
    if exact:
        found = staged(_best(complete(entries, found, width, total, k + 1), k + 1).select("query", "entry", "least", "score"), "best")
    hits = (asked.select(F.col("vec_id").alias("query_id"), F.col("entry").alias("query"))
            .join(found, "query").select("query_id", "entry", "score")
            .join(members.select("entry", "vec_id"), "entry").where("vec_id <> query_id")
            .groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
