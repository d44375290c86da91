"""Join operators on composite keys.

Design notes for scale:

* ``without`` / ``within`` reduce the other side to its *distinct* key set first.  The partial
  hash aggregate runs before the shuffle, so a key that holds a third of the other table sends
  one row per map task instead of a third of the table to one reducer, and the aggregate's
  output partitioning already satisfies the join, so no extra exchange is planned.
* ``unpack_containers`` reads each side once: items learn from a per-container count whether they are
  a container and over how many salts its contents are dealt, and a left join on (container, salt)
  brings the contents.  A giant cage is dealt over several salts; a container that is scanned very
  often is a skewed left side, which AQE may split in a left join.
* No broadcast hints: dimensions are left to Spark's size-checked broadcast (static estimate
  from file statistics, then AQE's runtime statistics), with sort-merge join beyond it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Contents of one container that stay together when it is unpacked.
CONTENTS_PER_SALT = 100_000


def _pairs(keys, other_keys=None) -> list[tuple[str, str]]:
    if isinstance(keys, str):
        keys = [keys]
    if other_keys is None:
        other_keys = keys
    elif isinstance(other_keys, str):
        other_keys = [other_keys]
    if len(keys) != len(other_keys):
        raise ValueError("keys and other_keys differ in length")
    return list(zip(keys, other_keys))


def _key_set(other: DataFrame, pairs) -> tuple[DataFrame, list[str]]:
    names = [f"__pf_k{i}" for i in range(len(pairs))]
    ks = other.select(*[F.col(r).alias(n) for (_, r), n in zip(pairs, names)]).distinct()
    return ks, names


def _cond(df: DataFrame, ks: DataFrame, pairs, names) -> Column:
    cond = None
    for (left, _), n in zip(pairs, names):
        c = df[left] == ks[n]
        cond = c if cond is None else (cond & c)
    return cond


def without(df: DataFrame, other: DataFrame, keys, other_keys=None) -> DataFrame:
    """Rows of ``df`` with no row in ``other`` on the (composite) key — NOT EXISTS semantics
    (a NULL key never matches, so such rows are kept)."""
    pairs = _pairs(keys, other_keys)
    ks, names = _key_set(other, pairs)
    return df.join(ks, _cond(df, ks, pairs, names), "left_anti")


def within(df: DataFrame, other: DataFrame, keys, other_keys=None) -> DataFrame:
    """Rows of ``df`` with at least one row in ``other`` on the key — EXISTS semantics; never
    multiplies rows, whatever the duplicates in ``other``."""
    pairs = _pairs(keys, other_keys)
    ks, names = _key_set(other, pairs)
    return df.join(ks, _cond(df, ks, pairs, names), "left_semi")


def keep_in_any(df: DataFrame, others: Sequence[tuple[DataFrame, "str | list[str]"]], keys) -> DataFrame:
    """Rows of ``df`` whose key appears in at least one of ``others`` ((frame, its key cols))."""
    pairs0 = _pairs(keys)
    names = [f"__pf_k{i}" for i in range(len(pairs0))]
    union = None
    for other, okeys in others:
        okeys = [okeys] if isinstance(okeys, str) else list(okeys)
        part = other.select(*[F.col(k).alias(n) for k, n in zip(okeys, names)])
        union = part if union is None else union.unionByName(part)
    ks = union.distinct()
    return df.join(ks, _cond(df, ks, pairs0, names), "left_semi")


def unpack_containers(df: DataFrame, item_col: str, boxes: DataFrame, container_col: str = "task_number",
                      content_col: str = "waybill_number", out_col: str | None = None,
                      box_filter: Column | None = None, only_if: Column | None = None,
                      carry: Sequence[str] = ()) -> DataFrame:
    """Replace every item that is a container (bag, cage) by the items it holds.

    * ``item_col`` of ``df`` is matched to ``boxes.container_col``; a match yields one row per
      content with ``out_col`` (default ``item_col``) set to the content; an item that is not a
      container keeps its own value.  Equivalent to
      ``LEFT JOIN boxes ON item = container`` + ``coalesce(content, item)``.
    * ``box_filter`` restricts the boxes (e.g. valid bindings only).
    * ``only_if`` is a predicate on ``df`` that must hold for unpacking to happen (a left-side
      predicate in the ON clause): other rows pass through unchanged.
    * ``carry`` box columns are added (NULL for items that were not unpacked).
    """
    out_col = out_col or item_col
    b = boxes if box_filter is None else boxes.filter(box_filter)
    contents = b.select(F.col(container_col).alias("__pf_c"), F.col(content_col).alias("__pf_w"),
                        *[F.col(c).alias(f"__pf_carry_{c}") for c in carry]).filter(F.col("__pf_c").isNotNull())
    # How many salts a container is dealt over: one, but for containers with very many contents.
    salts = (contents.groupBy(F.col("__pf_c").alias("__pf_sc")).agg(F.count("*").alias("__pf_n"))
             .select("__pf_sc", F.ceil(F.col("__pf_n") / F.lit(CONTENTS_PER_SALT)).cast("int").alias("__pf_salts")))
    contents = (contents.join(salts, F.col("__pf_c") == F.col("__pf_sc"), "inner")
                .withColumn("__pf_salt", F.pmod(F.xxhash64("__pf_w"), F.col("__pf_salts")).cast("int"))
                .drop("__pf_sc", "__pf_salts"))
    item = F.col(item_col) if only_if is None else F.when(only_if, F.col(item_col))
    items = df.withColumn("__pf_item", item)
    items = items.join(salts, F.col("__pf_item") == F.col("__pf_sc"), "left")
    items = items.withColumn("__pf_s", F.explode(F.sequence(F.lit(0), F.coalesce("__pf_salts", F.lit(1)) - 1)))
    met = items.join(contents, (F.col("__pf_item") == F.col("__pf_c")) & (F.col("__pf_s") == F.col("__pf_salt")), "left")
    # An item that is a container shows its contents alone, whichever salts they fell to.
    met = met.filter(F.col("__pf_sc").isNull() | F.col("__pf_c").isNotNull())
    value = F.when(F.col("__pf_c").isNotNull(), F.col("__pf_w")).otherwise(F.col(item_col))
    out_cols = list(dict.fromkeys(df.columns + [out_col]))
    return met.withColumn(out_col, value).withColumnsRenamed({f"__pf_carry_{c}": c for c in carry}) \
        .select(*out_cols, *carry)


def with_org(df: DataFrame, roles: dict, org_dim: DataFrame, org_key: str = "code",
             fields: Sequence[str] | None = None) -> DataFrame:
    """Role-playing dimension join: for each ``{df_col: prefix}`` add ``<prefix>_<field>``
    columns of the org row whose ``org_key`` equals ``df_col`` (left join; ``org_dim`` must be
    unique on ``org_key``, e.g. the output of ``latest_per_key``)."""
    fields = [f for f in (fields or org_dim.columns) if f != org_key]
    out = df
    for col_name, prefix in roles.items():
        dim = org_dim.select(F.col(org_key).alias(f"__pf_{prefix}_key"),
                             *[F.col(f).alias(f"{prefix}_{f}") for f in fields])
        out = out.join(dim, out[col_name] == dim[f"__pf_{prefix}_key"], "left").drop(f"__pf_{prefix}_key")
    return out


def restrict_to_centers(df: DataFrame, org_col: str, org_dim: DataFrame, org_key: str = "code",
                        center_col: str = "center", center_value: str = "Y") -> DataFrame:
    """Rows whose ``org_col`` is a center department (semi join: never multiplies rows even if
    the org master repeats a code)."""
    centers = org_dim.filter(F.col(center_col) == F.lit(center_value))
    return within(df, centers, [org_col], [org_key])
