"""Hard negatives by angular triangle filtering (operator 12).

Every vector is stored with its norm and its angles to a few reference directions.  By the triangle
inequality on the sphere the angle between two vectors lies between the difference and the sum of
their angles to any reference, which gives an interval of its cosine; all references together give
the narrowest one.  Multiplied by both norms, and widened by more than rounding can move it, the
interval bounds the inner product.  Only pairs whose interval meets the window of scores that is
asked for are multiplied out, in integers.

Vectors are sorted by label, nearest reference and angle and packed into stripes, anchors likewise into
tiles; both are bounded in rows and bytes.  A stripe's head holds its ranges of labels, norms and
angles, so pairs of tile and stripe that cannot meet are dropped before any vector moves.  Heads meet in
buckets of stripes by an equality join; the remaining pairs are the tasks.  A first round finds each
anchor's positives, whose scores set the windows of the second.

Scores are exact: products of integers in double precision while norms bound them below 2 ** 53, in
64-bit integers or Python's beyond that.

Reference directions come from ``SAMPLE`` rows of smallest hash; they decide what is pruned and never a
result.  The driver sees these rows and nothing else.

Defined cases: rows with a null id, label or vector, an empty vector, or null or non-finite
components take no part, nor do vectors of another length than the most frequent one (the larger of
equally frequent lengths); rows that are equal in id, label and vector count once; rows that share
the anchor's id are not its partners; ties go to smaller ids; an anchor without positives, or
whose windows hold nothing (negative scores have empty windows), has no rows; a vector that is zero in whole numbers scores 0;
an empty table gives no rows; extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.common import numbered, staged

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: A negative's score lies between these percentages of the positive's.
LOW, HIGH = 30, 90
REFERENCES = 12
SAMPLE = 2048
STRIPE_ROWS = 16_384
TILE_ROWS = 4_096
PACK_BYTES = 16 << 20
#: Stripe heads in a bucket.
BUCKET_HEADS = 4_096
#: More than rounding moves a cosine bound: a sine from a cosine near 1 is off by up to 2e-8.
_SAFE = 1e-7
_BLOCK = 32

_PACK = ("pack long, n int, ids binary, labels binary, whole binary, norms binary, cosines binary, label_low long, "
         "label_high long, norm_low double, norm_high double, angle_low array<double>, angle_high array<double>")


def usable(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label",
           vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, label, v) of the rows that take part, once each, and the length of their vectors."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                          F.transform(vector_col, lambda x: x.cast("double")).alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0)
        & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))))
    rows = staged(rows.distinct(), "rows")
    width = rows.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).first()
    width = width["w"] if width else 1
    return rows.where(F.size("v") == width), width


def _matrix(column: pd.Series, scale: int) -> np.ndarray:
    """Whole-number vectors, as doubles."""
    return np.floor(np.stack(column.to_numpy()).astype(np.float64) * scale)


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x, x))


def references(rows: DataFrame, width: int, scale: int, count: int = REFERENCES, sample: int = SAMPLE) -> np.ndarray:
    """Unit directions far from each other, out of the ``sample`` rows of smallest hash."""
    v = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "label", "v").limit(sample).select("v").toPandas()["v"]
    x = _matrix(v, scale) if len(v) else np.zeros((1, width))
    x = x[_norms(x) > 0]
    if not len(x):
        return np.eye(1, width)
    x /= _norms(x)[:, None]
    chosen = [x[0]]
    near = x @ chosen[0]
    while len(chosen) < count and near.min() < 1 - 1e-9:
        chosen.append(x[near.argmin()])  # farthest from all chosen
        near = np.maximum(near, x @ chosen[-1])
    return np.stack(chosen)


def _cosines(x: np.ndarray, norms: np.ndarray, refs: np.ndarray) -> np.ndarray:
    return np.clip((x @ refs.T) / np.where(norms > 0, norms, 1)[:, None], -1, 1)


def packed(rows: DataFrame, refs: np.ndarray, scale: int, most: int) -> DataFrame:
    """One row per stretch of at most ``most`` rows, in the order of label, nearest reference and angle."""
    width = refs.shape[1]
    most = max(1, min(most, PACK_BYTES // (8 * (width + len(refs)))))

    def cell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                x = _matrix(b["v"], scale)
                c = _cosines(x, _norms(x), refs)
                yield pd.DataFrame({"label": b["label"], "cell": c.argmax(1), "near": -c.max(1), "vec_id": b["vec_id"],
                                    "whole": [r.tobytes() for r in x]})

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("place")
        x = np.frombuffer(b"".join(part["whole"]), np.float64).reshape(-1, width)
        norms = _norms(x)
        c = _cosines(x, norms, refs)
        angle, label = np.arccos(c), part["label"].to_numpy(np.int64)
        return pd.DataFrame({
            "pack": [part["pack"].iloc[0]], "n": [len(part)], "ids": [part["vec_id"].to_numpy(np.int64).tobytes()],
            "labels": [label.tobytes()], "whole": [x.tobytes()], "norms": [norms.tobytes()],
            "cosines": [c.tobytes()], "label_low": [label.min()], "label_high": [label.max()],
            "norm_low": [norms.min()], "norm_high": [norms.max()],
            "angle_low": [angle.min(0).tolist()], "angle_high": [angle.max(0).tolist()]})

    keyed = rows.mapInPandas(cell, "label long, cell int, near double, vec_id long, whole binary")
    placed = numbered(keyed, "label", "cell", "near", "vec_id", "whole", tag="angles")
    return placed.withColumn("pack", F.floor(F.col("place") / most)).groupBy("pack").applyInPandas(pack, _PACK)


class Pack:
    """A packed stretch, as arrays."""

    def __init__(self, ids: bytes, labels: bytes, whole: bytes, norms: bytes, cosines: bytes):
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        n = len(self.ids)
        self.whole, self.norms = np.frombuffer(whole).reshape(n, -1), np.frombuffer(norms)
        self.cos = np.frombuffer(cosines).reshape(n, -1)
        self.sin = np.sqrt((1 - self.cos) * (1 + self.cos))


def score_bounds(a: Pack, which: slice, x: Pack) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest possible inner product of some rows of ``a`` with all rows of ``x``."""
    low, high = -1.0, 1.0
    for j in range(a.cos.shape[1]):
        both = np.multiply.outer(a.cos[which, j], x.cos[:, j])
        cross = np.multiply.outer(a.sin[which, j], x.sin[:, j])
        low, high = np.maximum(low, both - cross), np.minimum(high, both + cross)
    size = np.multiply.outer(a.norms[which], x.norms)
    return (low - _SAFE) * size, (high + _SAFE) * size


def products(x: np.ndarray, a: np.ndarray, bound: float) -> np.ndarray:
    """Exact inner products of rows of whole numbers with one; ``bound`` is the largest product of norms."""
    if bound < 1 << 52:
        return (x @ a).astype(np.int64)
    if bound < 1 << 61 and max(np.abs(x).max(initial=0), np.abs(a).max()) < 1 << 61:
        return x.astype(np.int64) @ a.astype(np.int64)
    whole = [int(c) for c in a]
    return np.array([sum(int(c) * d for c, d in zip(r, whole)) for r in x], object)


def _top(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The first k by score, descending, and id."""
    if len(score) > 4 * k and score.dtype != object:
        least = np.partition(score, len(score) - k)[len(score) - k]
        some = np.flatnonzero(score >= least)
    else:
        some = np.arange(len(score))
    return some[np.lexsort((ids[some], -score[some]))[:k]]


def positives_in(a: Pack, x: Pack, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row of ``a``, ids, scores): its ``k`` best partners of the same label in ``x``."""
    for start in range(0, len(a.ids), _BLOCK):
        which = slice(start, start + _BLOCK)
        _, high = score_bounds(a, which, x)
        for i, top in enumerate(high, start):
            at = np.flatnonzero((x.labels == a.labels[i]) & (x.ids != a.ids[i]))
            if not len(at):
                continue
            bound = a.norms[i] * x.norms[at].max()
            if len(at) > 16 * k:  # those of highest bound first: their k-th score leaves out most others
                first = at[np.argpartition(-top[at], 8 * k)[:8 * k]]
                score = products(x.whole[first], a.whole[i], bound)
                at = at[top[at] >= float(score[_top(score, x.ids[first], k)[-1]])]
            score = products(x.whole[at], a.whole[i], bound)
            best = _top(score, x.ids[at], k)
            yield i, x.ids[at[best]], score[best]


def negatives_in(a: Pack, x: Pack, asked: list[list[int]], k: int, low: int, high: int
                 ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(row of ``a``, score of a positive, ids, scores): the ``k`` best of another label in each window."""
    for start in range(0, len(a.ids), _BLOCK):
        which = slice(start, start + _BLOCK)
        least, most = score_bounds(a, which, x)
        for i in range(start, min(start + _BLOCK, len(a.ids))):
            # Windows of whole scores; those of negative positives are empty.
            windows = [(p, -(-low * p // 100), high * p // 100) for p in asked[i] if p >= 0]
            if not windows:
                continue
            bottom, top = float(min(w[1] for w in windows)), float(max(w[2] for w in windows))
            at = np.flatnonzero((x.labels != a.labels[i]) & (most[i - start] >= bottom) & (least[i - start] <= top))
            if not len(at):
                continue
            score = products(x.whole[at], a.whole[i], a.norms[i] * x.norms[at].max())
            for p, bottom, top in windows:
                some = np.flatnonzero((score >= bottom) & (score <= top))
                if len(some):
                    best = some[_top(score[some], x.ids[at[some]], k)]
                    yield i, p, x.ids[at[best]], score[best]


_HEAD = ["pack", "label_low", "label_high", "norm_low", "norm_high", "angle_low", "angle_high"]


def meeting(tiles: DataFrame, stripes: DataFrame, stripe_count: int, same_label: bool) -> DataFrame:
    """(tile, stripe): the pairs of which some rows can meet.  ``tiles`` are heads with ``bottom`` and
    ``top``, the window of scores; ``same_label`` asks for equal labels, else for different ones."""
    buckets = max(1, -(-stripe_count // BUCKET_HEADS))
    heads = (stripes.select(F.pmod(F.xxhash64("pack"), F.lit(buckets)).alias("bucket"), F.struct(*_HEAD).alias("head"))
             .groupBy("bucket").agg(F.collect_list("head").alias("heads")))
    asked = tiles.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))).alias("bucket"),
                         F.struct(*_HEAD, "bottom", "top").alias("tile"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for t, heads in zip(b["tile"], b["heads"]):
                h = pd.DataFrame(list(heads))
                if same_label:
                    meet = (h["label_low"] <= t["label_high"]) & (h["label_high"] >= t["label_low"])
                else:
                    low, high = np.minimum(h["label_low"], t["label_low"]), np.maximum(h["label_high"], t["label_high"])
                    meet = low != high
                x0, x1 = np.stack(h["angle_low"]), np.stack(h["angle_high"])
                a0, a1 = np.asarray(t["angle_low"]), np.asarray(t["angle_high"])
                nearest = np.cos(np.maximum(0, np.maximum(x0 - a1, a0 - x1))).min(1) + _SAFE
                across = (x0 + a0 <= np.pi) & (x1 + a1 >= np.pi)
                farthest = np.where(across, -1, np.minimum(np.cos(x0 + a0), np.cos(x1 + a1))).max(1) - _SAFE
                small, large = h["norm_low"] * t["norm_low"], h["norm_high"] * t["norm_high"]
                meet &= np.where(nearest > 0, large, small) * nearest >= t["bottom"]
                meet &= np.where(farthest > 0, small, large) * farthest <= t["top"]
                yield pd.DataFrame({"tile": t["pack"], "stripe": h["pack"][meet]})

    return asked.join(heads, "bucket").select("tile", "heads").mapInPandas(run, "tile long, stripe long")


_DATA = ["ids", "labels", "whole", "norms", "cosines"]


def _tasks(tiles: DataFrame, stripes: DataFrame, pairs: DataFrame, *more: str) -> DataFrame:
    a = tiles.select(F.col("pack").alias("tile"), *[F.col(c).alias(f"a_{c}") for c in _DATA], *more)
    x = stripes.select(F.col("pack").alias("stripe"), *[F.col(c).alias(f"x_{c}") for c in _DATA])
    # Few pairs, far apart: dealt out evenly, one after the other
    return pairs.join(a, "tile").join(x, "stripe")


def _packs(b: pd.DataFrame) -> Iterator[tuple]:
    for r in b.itertuples(index=False):
        yield r, Pack(*(getattr(r, f"a_{c}") for c in _DATA)), Pack(*(getattr(r, f"x_{c}") for c in _DATA))


def mine(vectors: DataFrame, anchors: str, scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, stripe_rows: int = STRIPE_ROWS, tile_rows: int = TILE_ROWS,
         reference_count: int = REFERENCES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` has vec_id, label and embedding; ``anchors`` is the condition on vec_id that names the
    anchors among its rows.
    """
    rows, width = usable(vectors)
    asking = rows.where(anchors)
    refs = references(rows, width, scale, reference_count)
    stripes = staged(packed(rows, refs, scale, stripe_rows), "stripes")
    tiles = staged(packed(asking, refs, scale, tile_rows), "tiles")
    stripe_count = stripes.count()

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r, a, x in _packs(b):
                hits = list(positives_in(a, x, positives))
                if hits:
                    at = np.repeat([h[0] for h in hits], [len(h[1]) for h in hits])
                    yield pd.DataFrame({"tile": r.tile, "anchor": at, "anchor_id": a.ids[at],
                                        "positive_id": np.concatenate([h[1] for h in hits]),
                                        "score": np.concatenate([h[2] for h in hits])})

    everything = tiles.select("*", F.lit(-np.inf).alias("bottom"), F.lit(np.inf).alias("top"))
    pairs = staged(meeting(everything, stripes, stripe_count, True), "same_label")
    found = _tasks(tiles, stripes, pairs).mapInPandas(
        find, "tile long, anchor int, anchor_id long, positive_id long, score long")
    order = Window.partitionBy("tile", "anchor").orderBy(F.desc("score"), "positive_id")
    best = staged(found.withColumn("no", F.row_number().over(order)).where(F.col("no") <= positives), "positives")

    # A tile's windows: for each of its anchors (at most ``tile_rows``) the scores of its positives
    asked = best.groupBy("tile").agg(
        F.collect_list(F.struct("anchor", "score")).alias("asked"),
        F.floor(F.min(F.when(F.col("score") >= 0, F.col("score"))) * (low / 100)).cast("double").alias("bottom"),
        F.ceil(F.max("score") * (high / 100)).cast("double").alias("top"))
    windowed = staged(tiles.join(asked.where("bottom is not null"), F.col("pack") == F.col("tile")).drop("tile"), "windowed")

    def mined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r, a, x in _packs(b):
                scores: list[list[int]] = [[] for _ in a.ids]
                for one in r.asked:
                    if one["score"] not in scores[one["anchor"]]:
                        scores[one["anchor"]].append(one["score"])
                hits = list(negatives_in(a, x, scores, negatives, low, high))
                if hits:
                    times = [len(h[2]) for h in hits]
                    yield pd.DataFrame({"tile": r.tile, "anchor": np.repeat([h[0] for h in hits], times),
                                        "score": np.repeat([h[1] for h in hits], times),
                                        "negative_id": np.concatenate([h[2] for h in hits]),
                                        "negative_score": np.concatenate([h[3] for h in hits])})

    pairs = staged(meeting(windowed, stripes, stripe_count, False), "other_label")
    hits = _tasks(windowed, stripes, pairs, "asked").mapInPandas(
        mined, "tile long, anchor int, score long, negative_id long, negative_score long")
    order = Window.partitionBy("tile", "anchor", "score").orderBy(F.desc("negative_score"), "negative_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return (best.join(ranked, ["tile", "anchor", "score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score"))
