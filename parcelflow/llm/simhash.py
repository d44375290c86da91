"""SimHash near-duplicates by anchor-point covering (operator 3).

Fingerprint: every ``shingle`` consecutive words of the lower-cased (A-Z) text, repeats included,
are hashed by XXH64; a bit of the 64-bit fingerprint is 1 if it is set in over half the hashes.

Links: fingerprints that differ in at most ``max_bits`` bits.  The 64 bits are cut into blocks, few
enough that two linked fingerprints differ in at most one bit of some block.  In every block the
words of a Hamming code are the anchors: each block value lies within the code's covering radius 1
of exactly one anchor, its home.  A fingerprint is replicated to every anchor within covering radius
plus block threshold (2): itself, or its home and the 15 (for 31 bits) anchors two bits away.  Of two linked
fingerprints one's home is thereby an anchor of the other, and they meet there.

Scale: equal fingerprints are reduced to one before anything else, so copies cost nothing.
Anchors are hash-partitioned and sorted; a task streams them and compares rows of one anchor in
numpy, blockwise, in arrays of 8 bytes a row.  An anchor with more than ``HOT`` rows is not
compared: its rows go on by the bits that the anchor leaves free, which are cut into blocks with
anchors of their own (linked fingerprints again differ in at most one bit of some block), up to
``ROUNDS`` times; a group that is then still as large lies within a few bits in all blocks.  Only links that join
two groups of an anchor are sent on (a spanning forest), never all pairs.  Components are found by
alternating star contraction over the links, written to the checkpoint folder after each round.

Defined cases: a null text is empty; a text of fewer words than a shingle is one shingle; a text
without words has fingerprint zero, linked like any other; rows with a null doc_id take part and
never name a component unless it has no other row; repeated rows are one document of that id; an empty table gives
an empty result; extra columns are dropped (``keep_one`` keeps them all).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import staged, text_of

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Rows of one anchor that are compared before the anchor is split further, and how often it is.
HOT = 4096
ROUNDS = 3
_ROWS = 2048


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1)[:len(words) - shingle + 1].tolist()
        stops = (ends[shingle - 1:] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(line[i:j], SEED) for i, j in zip(starts, stops)), np.uint64, len(stops))
    set_bits = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):  # bounded working memory for very long texts
        part = hashes[i:i + (1 << 16)]
        set_bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, row: str | None = None) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed 64-bit integer; with the name of a column of
    row numbers also that and text_hash."""
    more = [row, F.xxhash64("text").alias("text_hash")] if row else []
    rows = docs.select("doc_id", *more, text_of().alias("text"))
    carried = rows.columns[:-1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b["text"]], np.uint64).view(np.int64)
            yield b[carried].assign(fp=fp)

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in carried)
    return rows.mapInPandas(run, f"{kinds}, fp long")


class Cover:
    """Blocks of the lowest ``bits`` bits and the Hamming code whose words are each block's anchors."""

    def __init__(self, blocks: int, bits: int = 64):
        self.blocks, self.width = blocks, bits // blocks
        self.check_bits = (self.width + 1).bit_length() - 1
        self.length = (1 << self.check_bits) - 1  # bits of a block that the code covers
        self.shifts = [i * self.width for i in range(blocks)]

    def rest(self, fp: np.ndarray, block: int) -> np.ndarray:
        """The bits outside a block, moved together."""
        low, above = np.uint64(self.shifts[block]), self.shifts[block] + self.width
        high = fp >> np.uint64(above) if above < 64 else np.zeros_like(fp)
        return (fp & ((np.uint64(1) << low) - np.uint64(1))) | (high << low if self.shifts[block] else high)

    def anchors(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row number, anchor) of every anchor that each fingerprint is replicated to."""
        rows, found = [], []
        places = np.arange(1, self.length + 1, dtype=np.uint64)
        one = np.uint64(1)
        for b, shift in enumerate(self.shifts):
            value = (fp >> np.uint64(shift)) & np.uint64((1 << self.length) - 1)
            syndrome = np.zeros(len(fp), np.uint64)
            for p in places:
                syndrome ^= np.where((value >> (p - one)) & one, p, np.uint64(0))
            # A code word is its own and only anchor.
            own = np.flatnonzero(syndrome == 0)
            rows.append(own)
            found.append(value[own] | np.uint64(b << self.length))
            off = np.flatnonzero(syndrome)
            v, s = value[off], syndrome[off]
            rows.append(off)
            found.append((v ^ (one << (s - one))) | np.uint64(b << self.length))
            for p in places:  # two bits p < q whose places have the syndrome as their sum
                q = p ^ s
                two = np.flatnonzero(q > p)
                rows.append(off[two])
                flipped = v[two] ^ (one << (p - one)) ^ (one << (q[two] - one))
                found.append(flipped | np.uint64(b << self.length))
        return np.concatenate(rows), np.concatenate(found).view(np.int64)


def _forest(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, smallest member of its group) among the fingerprints of one group."""
    n = len(fp)
    root = np.arange(n)
    changed = True
    while changed:  # each sweep lowers every row to the lowest root among its neighbours
        changed = False
        for i in range(0, n, _ROWS):
            best = root[i:i + _ROWS].copy()
            for j in range(0, n, _ROWS):
                near = np.bitwise_count(fp[i:i + _ROWS, None] ^ fp[None, j:j + _ROWS]) <= max_bits
                best = np.minimum(best, np.where(near, root[None, j:j + _ROWS], n).min(1))
            if (best < root[i:i + _ROWS]).any():
                changed = True
                np.minimum.at(root, root[i:i + _ROWS].copy(), best)
                root[i:i + _ROWS] = best
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    member = np.flatnonzero(root != np.arange(n))
    return fp[member], fp[root[member]]


def _left(fp: np.ndarray, path: int, blocks: int, rounds: int) -> tuple[np.ndarray, int]:
    """The free bits and their number after ``rounds`` anchors, whose blocks ``path`` lists in base ``blocks``."""
    bits = 64
    for i in range(rounds):
        cover = Cover(blocks, bits)
        fp = cover.rest(fp, path // blocks ** i % blocks)
        bits -= cover.width
    return fp, bits


def _links_of(keys: np.ndarray, fps: np.ndarray, max_bits: int, hot: int | None) -> Iterator[tuple]:
    """Over rows sorted by key: (kind, a, b) with kind 0 for links, 1 for rows put off as hot."""
    if not len(keys):
        return
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    size = np.diff(np.r_[first, len(keys)])
    small = size <= 64
    in_small = np.repeat(small, size)
    k, f = keys[in_small], fps[in_small]
    for step in range(1, int(size[small].max(initial=1))):
        same = k[step:] == k[:-step]
        if not same.any():
            break
        a, b = f[step:][same], f[:-step][same]
        near = (np.bitwise_count(a ^ b) <= max_bits) & (a != b)
        yield 0, a[near], b[near]
    for i, n in zip(first[~small].tolist(), size[~small].tolist()):
        group = np.unique(fps[i:i + n])
        if hot is not None and n > hot:
            yield 1, np.full(len(group), keys[i]).view(np.uint64), group
        else:
            yield 0, *_forest(group, max_bits)


def _compare(rows: DataFrame, max_bits: int, hot: int | None) -> DataFrame:
    """(kind, a, b, path) from (key, fp, path): rows of one key meet in one task, sorted."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pd.DataFrame]:
            keys, fps, paths = (np.concatenate(x) for x in zip(*held))
            kinds, a, b, path = [], [], [], []
            for kind, x, y in _links_of(keys, fps, max_bits, hot):
                kinds.append(np.full(len(x), kind, np.int32))
                a.append(x.view(np.int64))
                b.append(y.view(np.int64))
                path.append(paths[np.searchsorted(keys, a[-1])] if kind else np.zeros(len(x), np.int64))
            if kinds:
                out = pd.DataFrame({"kind": np.concatenate(kinds), "a": np.concatenate(a), "b": np.concatenate(b),
                                    "path": np.concatenate(path)})
                yield out.drop_duplicates()

        for batch in batches:
            part = (batch["key"].to_numpy(), batch["fp"].to_numpy().view(np.uint64), batch["path"].to_numpy())
            if not len(part[0]):
                continue
            if held and held[-1][0][-1] == part[0][-1]:
                held.append(part)
                continue
            cut = int(np.searchsorted(part[0], part[0][-1]))  # the last key may go on in the next batch
            held.append(tuple(x[:cut] for x in part))
            yield from flush()
            held = [tuple(x[cut:] for x in part)]
        if held:
            yield from flush()

    dealt = rows.repartition("key").sortWithinPartitions("key")
    return dealt.mapInPandas(run, "kind int, a long, b long, path long")


def links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): enough links between distinct fingerprints ``fp`` that linked ones are connected."""
    blocks = max_bits // 2 + 1

    def expand(rounds: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for path, part in b.groupby("path", sort=False):
                    for i in range(0, len(part), 1 << 15):
                        key, fp = part["key"].to_numpy()[i:i + (1 << 15)], part["fp"].to_numpy()[i:i + (1 << 15)]
                        free, bits = _left(fp.view(np.uint64), int(path), blocks, rounds)
                        cover = Cover(blocks, bits)
                        row, anchor = cover.anchors(free)
                        # An anchor is found within the one it comes from.
                        yield pd.DataFrame({
                            "key": _mixed(key[row], anchor) if rounds else anchor, "fp": fp[row],
                            "path": path + blocks ** rounds * (anchor.view(np.uint64) >> np.uint64(cover.length)).astype(np.int64)})

        return run

    rows, found = nodes.select(F.lit(0).cast("long").alias("key"), "fp", F.lit(0).cast("long").alias("path")), None
    for rounds in range(ROUNDS + 1):
        anchored = rows.mapInPandas(expand(rounds), "key long, fp long, path long")
        met = staged(_compare(anchored, max_bits, HOT if rounds < ROUNDS else None), "anchors")
        linked = met.where("kind = 0").select("a", "b")
        found = linked if found is None else found.unionByName(linked)
        rows = met.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("fp"), "path")
        if rows.isEmpty():
            break
    return found.distinct()


def _mixed(key: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """One number for a pair of numbers; groups that share one by chance are compared together."""
    with np.errstate(over="ignore"):
        x = key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + anchor.view(np.uint64)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(32))).view(np.int64)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node reachable; nodes without edges are left out.

    Alternating large-star and small-star steps; the state is as large as the edges.
    """
    edges = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .where("u <> v").distinct(), "edges")
    while True:
        before = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))).where("u <> v")
        edges = staged(small.distinct(), "edges")
        if edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() == before:
            return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))


def _named(fps: DataFrame, first: Column, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(fp, first, root) of every distinct fingerprint, and (root, first) of every component; ``first``
    is the smallest value of the aggregate over the rows."""
    nodes = staged(fps.groupBy("fp").agg(first.alias("first")), "nodes")
    roots = components(links(nodes.select("fp"), max_bits))
    of_node = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    return of_node, of_node.groupBy("root").agg(F.min("first").alias("least"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per row of ``docs``."""
    fps = staged(fingerprints(docs, shingle), "fingerprints")
    of_node, least = _named(fps, F.min("doc_id"), max_bits)
    named = staged(of_node.join(least, "root").select(F.col("fp").alias("node"), F.col("least").alias("component_id")), "named")
    return fps.join(named, fps["fp"] == named["node"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, with all its columns: the first by doc_id (nulls last), hash of the
    text and number of the row.

    Rows get numbers of their own in a staged copy, so rows without doc_id and rows that share one
    count one by one.
    """
    row = "_simhash_row"
    keyed = staged(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    fps = staged(fingerprints(keyed, shingle, row), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", row)
    _, least = _named(fps, F.min(order), max_bits)
    return keyed.join(least.select(F.col(f"least.{row}").alias("_simhash_kept")),
                      F.col(row) == F.col("_simhash_kept"), "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
