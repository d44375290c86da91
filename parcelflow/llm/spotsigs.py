"""SpotSigs document fingerprints (operator 6).

A signature is an anchor - one of the most common words of the four languages - and the chain of the
next ``CHAIN`` content words (words that are no anchors) after it.  A text's fingerprint is the set
of its signatures; as a string it is their number and the SHA-256 of their sorted 64-bit hashes.
A text without any signature has its word sequence as the only one, so that its
fingerprint still tells it apart.  Likeness is the Jaccard index of two sets; a pair whose set sizes
alone keep it below a threshold is never compared.

Near-duplicate pairs: sets are partitioned by length into ranges so that a set and any partner of at least
``threshold`` lie in the same or in neighbouring ranges.  Within a range pair, sets meet by their
rarest signatures (as many as a partner must share one of), and are compared in order of length, ending
where the length bound does.

Every document also gets an edited form - its second half replaced by the first part of the next
document - for which documents need their successor in doc_id order.  Documents are
dealt by sampled doc_id boundaries and sorted; the first document of every stretch is also sent to the stretch before it, so
that texts are shuffled once and a task streams its stretch with one text held back.

Defined cases: a null text is an empty text; the empty text has one signature, the empty sequence;
documents with a null doc_id come first; rows with the same doc_id follow each other by text; the
successor of the last row is the first row (itself, if it is the only one); an empty table gives no rows; extra
columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.common import staged, text_of

CHAIN = 2
THRESHOLD = 0.8
# Common words of English, German, French and Spanish.
ANCHORS = frozenset(
    "a an and are as at be by for from in is it of on or that the this to was with "
    "als auf das dem den der des die ein eine für im in ist mit nicht sich und von zu "
    "au aux ce dans de des du en est et la le les par pas pour que qui sur un une "
    "al como con del el en es la las lo los no para por que se su un una y".split())
_WORD = regex.compile(r"[\p{L}\p{N}]+")


def signatures(text: str, chain: int = CHAIN) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's signatures; one at least."""
    words = _WORD.findall(text.lower())
    content: list[str] = []
    anchors: list[tuple[str, int]] = []
    for w in words:
        if w in ANCHORS:
            anchors.append((w, len(content)))
        else:
            content.append(w)
    last = len(content) - chain
    found = {a + " " + " ".join(content[i:i + chain]) for a, i in anchors if i <= last}
    digest = xxhash.xxh64_intdigest
    if not found:
        found = {"\n" + text}
    return np.sort(np.fromiter((digest(s.encode("utf-8", "replace")) for s in found), np.uint64, len(found)))


def fingerprint(sigs: np.ndarray) -> str:
    return f"{len(sigs)}:{hashlib.sha256(sigs.astype('<u8').tobytes()).hexdigest()}"


def likeness(a: np.ndarray, b: np.ndarray, at_least: float = 0.0) -> float:
    """Jaccard index of two sorted sets; 0 if their sizes keep it below ``at_least``."""
    if min(len(a), len(b)) < at_least * max(len(a), len(b)):
        return 0.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def edited(text: str, following: str) -> str:
    """The last half (rounded down) replaced by the first as many code points of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _stretches(docs: DataFrame, target_rows: int) -> DataFrame:
    """(doc_id, text, stretch, tail): rows by stretches of doc_id, and for every stretch the row
    after its end as ``tail``."""
    ids = docs.select("doc_id")
    rows = ids.count()
    n = max(1, min(8192, -(-rows // target_rows)))
    # Approximate quantiles in bounded memory; any boundaries give the same result.
    edges = sorted(set(ids.where("doc_id is not null").approxQuantile("doc_id", [i / n for i in range(1, n)],
                                                                      0.1 / n))) if n > 1 else []
    # Which stretch: how many boundaries are not after the id.
    cut = np.array([int(e) for e in edges], np.int64)

    @F.pandas_udf("int")
    def stretch_of(part: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in part:
            known = s.notna().to_numpy()
            out = np.zeros(len(s), np.int32)
            out[known] = np.searchsorted(cut, s[known].to_numpy().astype(np.int64), "right")
            yield pd.Series(out)

    dealt = docs.select("doc_id", text_of().alias("text")).withColumn(
        "stretch", stretch_of(F.col("doc_id").cast("long")) if edges else F.lit(0))
    named = dealt.withColumn("h", F.xxhash64("text"))
    least = staged(named.groupBy("stretch").agg(F.min(F.struct(
        F.col("doc_id").isNotNull().alias("known"), F.col("doc_id").alias("id"), F.col("h").alias("first_h"))).alias("f"))
        .select(F.col("stretch").alias("of"), "f.id", "f.first_h"), "least")
    first = staged(named.join(least, (F.col("stretch") == F.col("of")) & (F.col("h") == F.col("first_h"))
                              & F.col("doc_id").eqNullSafe(F.col("id"))).select("stretch", "doc_id", "text"), "firsts")
    # One row per stretch (bounded): its predecessor, cyclic
    known = sorted(r["of"] for r in least.select("of").collect())
    before = {s: known[i - 1] for i, s in enumerate(known)}
    if not known:
        return dealt.withColumn("tail", F.lit(0))
    to = F.create_map(*[F.lit(x) for s, p in before.items() for x in (s, p)])
    tails = first.select("doc_id", "text", to[F.col("stretch")].alias("stretch"), F.lit(1).alias("tail"))
    return dealt.withColumn("tail", F.lit(0)).unionByName(tails)


def fingerprints(docs: DataFrame, chain: int = CHAIN, stretch_rows: int = 4096) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    rows = _stretches(docs, stretch_rows)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # (stretch, doc_id, text, signatures) that waits for its successor
        for b in batches:
            out = []
            for stretch, doc_id, text, tail in zip(b["stretch"], b["doc_id"], b["text"], b["tail"]):
                sigs = signatures(text, chain)
                if held is not None:
                    _, held_id, held_text, held_sigs = held
                    changed = edited(held_text, text)
                    changed_sigs = signatures(changed, chain)
                    out.append((held_id, len(held_text), hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest(),
                                fingerprint(held_sigs), fingerprint(changed_sigs),
                                likeness(held_sigs, changed_sigs), likeness(held_sigs, sigs)))
                held = None if tail else (stretch, doc_id, text, sigs)
            yield pd.DataFrame(out, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint",
                                             "edited_fingerprint", "near_edited", "near_next"])

    order = ["stretch", "tail", F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartition("stretch").sortWithinPartitions(*order).select("stretch", "doc_id", "text", "tail")
    return dealt.mapInPandas(run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
                                  "edited_fingerprint string, near_edited double, near_next double")


def near_pairs(docs: DataFrame, threshold: float = THRESHOLD, chain: int = CHAIN) -> DataFrame:
    """(a, b, likeness): representatives of equal signature sets, a < b, of at least ``threshold``.

    ``members`` gives the documents of a representative: it is their smallest doc_id.
    """
    sets = staged(members(docs, chain).groupBy("fingerprint").agg(
        F.min("doc_id").alias("rep"), F.min(F.struct("doc_id", "sigs"))["sigs"].alias("sigs")), "sets")
    tokens = sets.select("rep", F.explode("sigs").alias("sig"))
    rare = staged(tokens.groupBy("sig").agg(F.count("*").alias("n")).where("n > 1"), "rarity")
    shared = tokens.join(rare, "sig")
    size = sets.select("rep", F.size("sigs").alias("size"))
    # A partner shares one of the (size - ceil(threshold * size) + 1) rarest; unshared signatures come first.
    order = Window.partitionBy("rep").orderBy("n", "sig")
    ranked = (shared.withColumn("no", F.row_number().over(order)).withColumn("of", F.count("*").over(Window.partitionBy("rep")))
              .join(size, "rep"))
    prefix = ranked.where(F.col("no") + F.col("size") - F.col("of") <= F.col("size") - F.ceil(F.col("size") * threshold) + 1)
    # Length range: partners of at least the threshold are at most one range apart.
    length = F.floor(F.log(F.col("size")) / F.log(F.lit(1 / threshold))).cast("int")
    left = prefix.select("sig", length.alias("range"), F.col("rep").alias("a"), F.col("size").alias("na"))
    right = left.select("sig", F.explode(F.array(F.col("range") - 1, F.col("range"), F.col("range") + 1)).alias("range"),
                        F.col("a").alias("b"), F.col("na").alias("nb"))
    pairs = (left.join(right, ["sig", "range"]).where(
        (F.col("a") < F.col("b")) & (F.least("na", "nb") >= F.greatest("na", "nb") * threshold))
        .select("a", "b").distinct())
    both = (pairs.join(sets.select(F.col("rep").alias("a"), F.col("sigs").alias("sa")), "a")
            .join(sets.select(F.col("rep").alias("b"), F.col("sigs").alias("sb")), "b"))
    same = F.size(F.array_intersect("sa", "sb"))
    value = same / (F.size("sa") + F.size("sb") - same)
    return both.select("a", "b", value.alias("likeness")).where(F.col("likeness") >= threshold)


def members(docs: DataFrame, chain: int = CHAIN) -> DataFrame:
    """(doc_id, fingerprint, sigs): every document's signature set."""
    rows = docs.select("doc_id", text_of().alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sigs = [signatures(t, chain) for t in b["text"]]
            yield b[["doc_id"]].assign(fingerprint=[fingerprint(s) for s in sigs], sigs=[s.view(np.int64) for s in sigs])

    return rows.mapInPandas(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fingerprint string, sigs array<long>")
