"""Mixture-controlled packing by deficit round-robin (operator 1).

Every source is a queue of documents; a window is one sequence of ``window`` tokens.  Sources are
visited in turn: a visit adds the source's quantum (its target share of a window) to its deficit
and serves at most that many tokens from its queue.  What a visit may not or cannot serve stays in
the deficit for the next window.

Scale: documents are tokenized once and written to the shared checkpoint folder with their running
position inside (task, source).  Prefix sums over the small (task, source) and (lane, source)
tables give each document its position in its source's queue and the lane - a stretch of about
``lane_tokens`` tokens of the global sequence stream - that its start falls into.  Lanes are packed
independently: where a lane's tokens begin in the global stream, and how far each source has been
served before it, follow from the lane table, so deficits carry over from lane to lane as well as
from window to window, and sequences run on across lane borders.  A hot source is spread over all
lanes, as its share demands.  No lane holds more than its tokens plus one document per source.

Defined cases: a null text is empty and yields the closing token alone; a null source is a queue of
its own; documents longer than a window are cut; repeated rows are packed as often as they occur;
an empty table gives no pieces; extra columns are dropped; all sequences but the very last are full.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
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
CLOSING_ID = 1
LANE_TOKENS = 2_000_000
#: A visit serves no shorter stretch than this unless the queue or the window ends with it.
LEAST_GRANT = 64

PIECES = ("doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, source string")


def tokenize(docs: DataFrame, path: str) -> DataFrame:
    """(task, doc_id, source, before, n, ids): ids are unsigned 16-bit, closing id included;
    ``before`` counts the tokens of the same source earlier in the same task."""
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), text_of().alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = encoder(FlatWords, path)
        task, seen = TaskContext.get().partitionId(), defaultdict(int)
        closing = np.uint16(CLOSING_ID).tobytes()
        for b in batches:
            texts = b["text"].tolist()
            for i, j in slices(texts):
                part = b.iloc[i:j]
                ids = [x.astype("<u2").tobytes() + closing for x in words.encode_batch(texts[i:j])]
                before = []
                for source, x in zip(part["source"], ids):
                    before.append(seen[source])
                    seen[source] += len(x) // 2
                yield pd.DataFrame({"task": task, "doc_id": part["doc_id"].array, "source": part["source"].array,
                                    "before": before, "n": [len(x) // 2 for x in ids], "ids": ids})

    return rows.mapInPandas(run, f"task int, doc_id {rows.schema['doc_id'].dataType.simpleString()}, source string, "
                                 "before long, n long, ids binary")


def place(tokens: DataFrame, lane_tokens: int = LANE_TOKENS) -> DataFrame:
    """Adds ``at`` (position in the source's queue) and ``lane`` to the tokenized documents."""
    sums = tokens.groupBy("task", "source").agg(F.sum("n").alias("n"))
    queue = Window.partitionBy("source")
    offsets = staged(
        sums.select("task", "source",
                    (F.sum("n").over(queue.orderBy("task")) - F.col("n")).alias("task_before"),
                    F.sum("n").over(queue).alias("queue_tokens")), "offsets")
    total = offsets.groupBy("source").agg(F.max("queue_tokens").alias("n")).agg(F.sum("n")).first()[0] or 0
    lanes = max(1, -(-total // lane_tokens))
    o = offsets.select("task", F.col("source").alias("o_source"), "task_before", "queue_tokens")
    joined = tokens.join(o, (tokens["task"] == o["task"]) & F.col("source").eqNullSafe(F.col("o_source")))
    at = F.col("before") + F.col("task_before")
    # Lane k holds the documents that start in [floor(queue*k/lanes), floor(queue*(k+1)/lanes)).
    lane = F.floor(((at + 1).cast("decimal(38,0)") * F.lit(lanes) - 1) / F.col("queue_tokens")).cast("long")
    return joined.select("doc_id", "source", at.alias("at"), "n", "ids", "queue_tokens", lane.alias("lane"))


def lane_table(placed: DataFrame) -> DataFrame:
    """(lane, first_token, total, queues): for each lane where it begins in the stream and, by
    source, tokens served before it, tokens in it and tokens of the whole queue."""
    cells = placed.groupBy("lane", "source").agg(F.sum("n").alias("n"), F.max("queue_tokens").alias("queue_tokens"))
    queue = Window.partitionBy("source")
    cells = cells.withColumn("served", F.sum("n").over(queue.orderBy("lane")) - F.col("n"))
    # A source may skip a lane (a long document covers it); what was served before it still counts.
    lanes = cells.groupBy("lane").agg(
        F.sum("n").alias("n"), F.collect_list(F.struct("source", "served", "n", "queue_tokens")).alias("queues"))
    stream = Window.orderBy("lane")
    return lanes.select("lane", (F.sum("n").over(stream) - F.col("n")).alias("first_token"),
                        F.sum("n").over(Window.partitionBy()).alias("total"), "queues")


class _Queue:
    """One source's documents of a lane, and its deficit."""

    def __init__(self, docs: pd.DataFrame, share: float, deficit: float):
        self.share, self.deficit, self.left = share, deficit, int(docs["n"].sum())
        self.docs = list(zip(docs["doc_id"], docs["n"], docs["ids"]))
        self.doc, self.start = 0, 0
        self.ids = self._load()

    def _load(self) -> memoryview:
        return memoryview(np.frombuffer(self.docs[self.doc][2], "<u2").astype("<u4").tobytes())

    def serve(self, tokens: int) -> Iterator[tuple]:
        """Pieces (doc_id, start, length, crc, doc_tokens) of the next ``tokens`` tokens."""
        self.left -= tokens
        self.deficit -= tokens
        while tokens:
            doc_id, n, _ = self.docs[self.doc]
            take = min(tokens, n - self.start)
            yield doc_id, self.start, take, zlib.crc32(self.ids[4 * self.start:4 * (self.start + take)]), n
            tokens -= take
            self.start += take
            if self.start == n:
                self.doc, self.start = self.doc + 1, 0
                if self.doc < len(self.docs):
                    self.ids = self._load()


def round_robin(queues: dict[str, _Queue], first_token: int, window: int = WINDOW,
                least: int = LEAST_GRANT) -> Iterator[tuple]:
    """Serves all queues: pieces with their place (…, sequence_id, offset, source) in stream order."""
    at = first_token
    active = [s for s in sorted(queues, key=lambda s: (s is None, s or "")) if queues[s].left]
    turn, fresh = 0, True
    while active:
        source = active[turn % len(active)]
        q = queues[source]
        if fresh:  # the quantum is added when a visit begins, not when it goes on in the next window
            q.deficit += window * q.share / sum(queues[s].share for s in active)
        space = window - at % window
        grant = min(q.left, max(0, int(q.deficit)))
        if grant < least and grant < q.left:
            grant = 0
        fresh = grant <= space
        for piece in q.serve(min(grant, space)) if grant else ():
            yield *piece, at // window, at % window, source
            at += piece[2]
        if not q.left:
            active.remove(source)
            turn = turn % len(active) if active and turn % (len(active) + 1) < len(active) else 0
            fresh = True
        elif fresh:
            turn = (turn + 1) % len(active)


def pack(docs: DataFrame, path: str, window: int = WINDOW, lane_tokens: int = LANE_TOKENS,
         weights: dict[str, float] | None = None) -> DataFrame:
    """Packs all documents; one row per piece (see ``PIECES``).

    ``weights`` are target token proportions by source; by default each source's share of all
    tokens, which fills every window alike to the end.  With other weights a queue that runs
    dry leaves its share to the rest.
    """
    tokens = staged(tokenize(docs, path), "tokens")
    placed = place(tokens, lane_tokens)
    lanes = staged(lane_table(placed), "lanes")

    def run(docs_of_lane: pd.DataFrame, lane: pd.DataFrame) -> pd.DataFrame:
        meta = lane.iloc[0]
        total, first = int(meta["total"]), int(meta["first_token"])
        by_source = {s: part.sort_values("at", kind="stable")
                     for s, part in docs_of_lane.groupby("source", dropna=False, sort=False)}
        by_source = {None if pd.isna(s) else s: part for s, part in by_source.items()}
        queues = {}
        for cell in meta["queues"]:
            share = cell["queue_tokens"] / total
            due = first * share - cell["served"]
            if weights is not None:
                share, due = max(weights.get(cell["source"], 0.0), 1e-6), 0.0
            queues[cell["source"]] = _Queue(by_source[cell["source"]], share, due)
        return pd.DataFrame(list(round_robin(queues, first, window)), columns=[
            "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return (placed.select("lane", "source", "doc_id", "at", "n", "ids").groupBy("lane")
            .cogroup(lanes.groupBy("lane")).applyInPandas(run, PIECES.format(id=kind)))
