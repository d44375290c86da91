"""Removal of repeated passages by content-defined line chunks (operator 8, native).

Lines get a 64-bit hash, every two neighbouring lines a rolling hash over the two line hashes, and a
chunk ends before a line whose rolling hash is a strict local minimum, and before and after a line of
over ``LONG_WORDS`` words.  Borders depend on the lines around them alone, so a passage moved to another
place in another text is cut alike.

First, chunks of at least two lines and long lines are counted over all documents by hash.  Those whose hash
occurs more than once are compared byte by byte: they are grouped by the text itself.  Of equal ones
the first stays (smallest doc_id, then document hash, then position); the others are cut out.
Then the ragged ends, where a repeated passage begins or ends inside a chunk: neighbouring lines, one of
which at least is left, with an equal rolling hash elsewhere are compared and cut in the same way.  A match grows over as many lines as are equal, as each further line makes one more equal pair; a
repeated run of two lines or more goes whole, however short.  Every distinct line stays at least
once, since the first occurrence of a line lies in nothing that occurred before.  ``ragged=False``
leaves the second part out.

Everything is DataFrame functions.  Texts are shuffled once, by document; all joins with them read that
exchange.  A line, pair or chunk that a third of the documents share is reduced to its first place by
map-side aggregation; the places that go are what is left of all places without the first ones, by
document, so no join has a text as its key.

Defined cases: a null text stays null and an empty one empty; lines are separated by line feeds;
blank lines count as lines, but two blank lines are no pair; rows with the same doc_id and text are one document (both
keep or lose the same lines); null doc_ids come first in the order; all other columns are carried through
unchanged, whatever their names; an empty table gives an empty table; a repeated passage inside single
lines of other text stays.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.bind import let
from parcelflow.llm.common import staged

MIN_LINES = 2
#: A line of more words than this is a chunk of its own.
LONG_WORDS = 50
_TAG = "_line_dedup_"
_KEY, _RID, _AT, _GONE, _ZERO = (f"{_TAG}{x}" for x in ("key", "rid", "at", "gone", "zero"))
#: A unit's place: number of its first line times this, plus its number of lines.
_SPAN = 1 << 32


def _lines(use: Callable) -> Column:
    return let(F.split(F.col("text"), "\n", -1), use)


def _is_long(line: Column) -> Column:
    # So many words need as many letters, and a space less.
    return (F.length(line) > 2 * LONG_WORDS) & (F.regexp_count(line, F.lit(r"\S+")) > LONG_WORDS)


def _chunk_units(min_lines: int) -> Callable:
    """Lines -> array of (at, h) of the chunks that can be cut."""

    def starts(rolling: Column, long: Column) -> Column:
        """Line numbers at which chunks start."""
        return F.filter(F.sequence(F.lit(0), F.size(long) - 1), lambda i: (i == 0) | F.get(long, i) | F.get(long, i - 1) | (
            (i >= 2) & F.coalesce((F.get(rolling, i) < F.get(rolling, i - 1)) & (F.get(rolling, i) < F.get(rolling, i + 1)),
                                  F.lit(False))))

    def units(begin: Column, hashes: Column, long: Column) -> Column:
        def one(s: Column, k: Column) -> Column:
            n = F.coalesce(F.get(begin, k + 1), F.size(hashes)) - s
            counts = (n >= min_lines) | (F.get(long, s) if min_lines > 1 else F.lit(True))
            return F.struct((s.cast("long") * _SPAN + n).alias("at"),
                            F.when(counts, F.xxhash64(F.slice(hashes, s + 1, n))).alias("h"))

        return F.filter(F.transform(begin, one), lambda u: u["h"].isNotNull())

    # ``let`` binds each step, so that nothing is computed once per line.
    return lambda lines: let(F.transform(lines, lambda x: F.xxhash64(x)), lambda hashes: let(
        F.zip_with(hashes, F.slice(hashes, 2, F.size(hashes)), lambda a, b: F.xxhash64(a, b)), lambda rolling: let(
            F.transform(lines, _is_long), lambda long: let(
                starts(rolling, long), lambda begin: units(begin, hashes, long)))))


def _pair_units(lines: Column) -> Column:
    """Array of (at, h) of the neighbouring lines of which one is left at least, unless both are blank."""
    every = F.sequence(F.col(_ZERO), F.size(lines) - 2)
    left = F.when(F.col(_GONE).isNull(), every).otherwise(
        F.array_except(every, F.array_intersect(F.col(_GONE), F.transform(_GONE, lambda i: i - 1))))
    return F.when(F.size(lines) > 1, F.filter(F.transform(left, lambda i: let(F.get(lines, i), lambda a: let(
        F.get(lines, i + 1), lambda b: F.struct(
            (i.cast("long") * _SPAN + 2).alias("at"),
            F.when(a.rlike(r"\S") | b.rlike(r"\S"), F.xxhash64(a, b)).alias("h"))))), lambda u: u["h"].isNotNull()))


def _unit_texts(lines: Column) -> Column:
    """Array of (at, text) of the units at the places asked for."""
    return F.transform(F.filter(_AT, lambda a: a >= F.col(_ZERO)), lambda a: F.struct(
        a.alias("at"), F.array_join(F.slice(lines, _first_line(a) + 1, _count(a)), "\n").alias("text")))


def _first_line(at: Column) -> Column:
    return F.shiftright(at, 32).cast("int")


def _count(at: Column) -> Column:
    return at.bitwiseAND(F.lit(_SPAN - 1)).cast("int")


def _join(df: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """By document, null-safe; ``other`` has one row per document."""
    k, r = f"{_TAG}k", f"{_TAG}r"
    other = other.withColumnsRenamed({_KEY: k, _RID: r})
    return df.join(other, (F.col(_RID) == F.col(r)) & F.col(_KEY).eqNullSafe(F.col(k)), how).drop(k, r)


def _suspects(units: DataFrame) -> DataFrame:
    """(key, rid, at): by document the places of the units whose hash occurs more than once."""
    often = units.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    return units.join(often, "h").groupBy(_KEY, _RID).agg(F.collect_set("at").alias(_AT))


def _repeated(docs: DataFrame, suspects: DataFrame) -> DataFrame:
    """(key, rid, gone): by document the numbers of the lines in units that occurred before; ``docs`` has
    the suspects' texts."""
    # Byte comparison: equal texts meet in one group, after map-side aggregation.
    texts = _join(docs, suspects, "inner").select(_KEY, _RID, F.explode(_lines(_unit_texts)).alias("u"))
    place = F.struct(F.col(_KEY).alias("k"), F.col(_RID).alias("r"), F.col("u.at").alias("at"))
    first = (texts.groupBy(F.col("u.text").alias("t")).agg(F.min(place).alias("p")).select("p.*")
             .groupBy(F.col("k").alias(_KEY), F.col("r").alias(_RID)).agg(F.collect_set("at").alias(f"{_TAG}first")))
    again = F.array_except(_AT, F.coalesce(F.col(f"{_TAG}first"), F.array().cast("array<bigint>")))
    gone = F.array_distinct(F.flatten(F.transform(again, lambda a: F.sequence(
        _first_line(a), _first_line(a) + _count(a) - 1))))
    return _join(suspects, first, "left").select(_KEY, _RID, gone.alias(_GONE)).where(F.size(_GONE) > 0)


def dedup(docs: DataFrame, min_lines: int = MIN_LINES, ragged: bool = True) -> DataFrame:
    """``docs`` with its columns and rows, less the repeated passages, and ``n_removed`` (runs of lines)
    and ``chars_removed``, which replace input columns of these names."""
    own = [c for c in docs.columns if c not in ("n_removed", "chars_removed")]
    hashed = docs.select(*[F.col(f"`{c}`") for c in own], F.col("doc_id").alias(_KEY),
                         F.xxhash64(F.col("doc_id"), F.col("text")).alias(_RID))
    # Zero for every row, made of all columns: Spark drops columns that a join does not use before the
    # exchange, and joins that use different columns would each shuffle the texts for themselves.
    some_null = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in own])
    full = hashed.withColumn(_ZERO, F.least(F.lit(0), F.when(some_null, 1).otherwise(2)))
    chunks = hashed.select(_KEY, _RID, F.explode(_lines(_chunk_units(min_lines))).alias("u")).select(_KEY, _RID, "u.at", "u.h")
    # Written once: both are small, hold no text, and keep the plan of the rest short.
    cut = _repeated(full, staged(_suspects(staged(chunks, "chunks")), "suspects"))
    if ragged:
        pairs = (_join(full, cut, "left").select(_KEY, _RID, F.explode(_lines(_pair_units)).alias("u"))
                 .select(_KEY, _RID, "u.at", "u.h"))
        more = _repeated(full, _suspects(pairs))
        cut = cut.unionByName(more).groupBy(_KEY, _RID).agg(
            F.array_distinct(F.flatten(F.collect_list(_GONE))).alias(_GONE))
    final = _join(hashed, cut, "left")
    gone, kept = F.col(_GONE), f"{_TAG}kept"
    left = _lines(lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone), lambda i: F.get(lines, i)), "\n"))
    runs = F.size(F.array_except(gone, F.transform(gone, lambda i: i + 1)))
    return final.select(
        *[F.col(f"`{c}`") for c in own], F.when(gone.isNull(), F.col("text")).otherwise(left).alias(kept),
        F.coalesce(F.when(gone.isNotNull(), runs), F.lit(0)).alias("n_removed")).select(
        *[F.col(kept).alias(c) if c == "text" else F.col(f"`{c}`") for c in own], "n_removed",
        (F.coalesce(F.length("text"), F.lit(0)) - F.coalesce(F.length(kept), F.lit(0))).alias("chars_removed"))
