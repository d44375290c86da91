"""Route operators: parse planned routes, cut the part still ahead, split it into legs and walk
the legs through the timetable.

Routes arrive as text ``A:x-B:y-C:z`` (department code before ``:``).  Inside, a route is an
``array<string>`` of department codes, so codes never need to be re-packed into strings.

The schedule walk is sequential along a waybill's legs (each leg departs after the previous
one arrived and unloaded).  It goes leg number by leg number over all waybills at once:

    waybills (key, stops ahead, ready time, constants)
      -> ⟕ departures on (src, dst, hour of the ready time)   (first leg, second leg, …)
      -> inline(legs walked)

A waybill stays one row all the way; what it meets is one hour of one pair's departures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import let, timefmt
from ..session import discard, written
from . import lines as L

# --- fixed values -------------------------------------------------------------------------
HOP_SEPARATOR = "-"      # between route stops
CODE_SEPARATOR = ":"     # between a stop's department code and its label
IN_TRANSIT_STATUS = "load_noarrive"   # leg numbering starts at 2 for goods already on the road
# ------------------------------------------------------------------------------------------


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse(route) -> Column:
    """``A:x-B:y`` -> ``[A, B]`` (code before the first ``:`` of every stop).  Plain string
    functions (no lambda), so the projection stays in whole-stage codegen."""
    codes_only = F.regexp_replace(_as_col(route), CODE_SEPARATOR + "[^" + HOP_SEPARATOR + "]*", "")
    return F.split(codes_only, HOP_SEPARATOR)


def last_position(orgs, current) -> Column:
    """0-based index of the *last* occurrence of ``current`` in ``orgs``; -1 when absent."""
    orgs, current = _as_col(orgs), _as_col(current)
    p = F.array_position(F.reverse(orgs), current)
    return F.when(p > 0, F.size(orgs) - p).otherwise(F.lit(-1))


def remaining(orgs, current) -> Column:
    """Stops from the last occurrence of ``current`` to the end; NULL when ``current`` is absent
    or already the final stop (nothing left to travel).  Prefer ``with_remaining`` on frames: it
    materialises the parsed route and the index once instead of re-deriving them."""
    def body(o):
        return let(last_position(o, current),
                   lambda i: F.when((i >= 0) & (i < F.size(o) - 1), F.slice(o, i + 1, F.size(o) - i)))
    return let(_as_col(orgs), body)


def with_remaining(df: DataFrame, route_col: str, current_col: str, out_col: str = "remaining") -> DataFrame:
    """Add ``out_col`` = stops still ahead (see ``remaining``); helper columns are computed once
    each (Catalyst does not inline a non-trivial column that is used several times)."""
    orgs, idx = "__pf_orgs", "__pf_idx"
    n = F.size(F.col(orgs))
    return (df.withColumn(orgs, parse(route_col))
            .withColumn(idx, last_position(F.col(orgs), F.col(current_col)))
            .withColumn(out_col, F.when((F.col(idx) >= 0) & (F.col(idx) < n - 1),
                                        F.slice(F.col(orgs), F.col(idx) + 1, n - F.col(idx))))
            .drop(orgs, idx))


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def legs(df: DataFrame, key, remaining_col: str, status_col: str | None = None,
         leave_org_col: str | None = None, carry=()) -> DataFrame:
    """One row per consecutive pair of ``remaining_col`` (none when it is NULL, so callers need
    no filter on it): ``leg_idx`` (0-based), ``src``,
    ``dst``, ``path_no`` (1-based; from 2 when status is in transit) and ``pre_org`` (the stop
    before ``src``; for the first leg the department the goods left if in transit, else NULL)."""
    rem = F.col(remaining_col)
    status = F.col(status_col) if status_col else F.lit(None).cast("string")
    leave = F.col(leave_org_col) if leave_org_col else F.lit(None).cast("string")
    # NULL / single-stop routes give no legs.  explode_outer + a filter on the generated column:
    # a plain explode (or a filter on ``remaining`` itself) would let Catalyst push a predicate
    # below the projections with the route derivation inlined, evaluating it twice.
    idx = F.when(rem.isNotNull() & (F.size(rem) >= 2), F.sequence(F.lit(0), F.size(rem) - 2))
    base = df.select(*_keys(key), *carry, status.alias("__pf_status"), leave.alias("__pf_leave"), rem.alias("__pf_rem"),
                     F.explode_outer(idx).alias("leg_idx")).filter(F.col("leg_idx").isNotNull())
    in_transit = F.coalesce(F.col("__pf_status") == F.lit(IN_TRANSIT_STATUS), F.lit(False))
    r, i = F.col("__pf_rem"), F.col("leg_idx")
    return base.select(
        *_keys(key), *carry, i.cast("int").alias("leg_idx"),
        F.element_at(r, i + 1).alias("src"), F.element_at(r, i + 2).alias("dst"),
        (i + F.when(in_transit, 2).otherwise(1)).cast("int").alias("path_no"),
        F.when(i == 0, F.when(in_transit, F.col("__pf_leave"))).otherwise(F.element_at(r, i)).alias("pre_org"))


_OUT = "struct<leg_idx:int,src:string,dst:string,path_no:int,pre_org:string," \
       "start_time:timestamp_ntz,end_time:timestamp_ntz>"
#: Legs walked in one plan; longer routes go on from a written table.
LEGS_AT_ONCE = 8
#: Waybills that have nothing to look up are dealt over so many keys that match nothing.
_IDLE_KEYS = 1 << 20


def _walk_leg(df: DataFrame, lookup: DataFrame, keys: list[str], leg: int) -> DataFrame:
    """One leg of every waybill: ``__pf_t`` (ready time, NULL once stopped) and ``__pf_out`` move on.

    Written as SQL expressions, which cost the driver one call each; there is a set of them per leg.
    """
    state = df.columns
    asked = df.selectExpr("*", f"get(__pf_rem, {leg}) AS __pf_src", f"get(__pf_rem, {leg + 1}) AS __pf_dst",
                          "cast(date_trunc('DAY', __pf_t) AS timestamp_ntz) AS __pf_day")
    asked = asked.selectExpr("*", "cast(ceil(cast(timestampdiff(MICROSECOND, __pf_day, __pf_t) AS double) / 1000000.0D) "
                                  "AS bigint) AS __pf_x")
    # Finished waybills get a key that no line has, so that they neither match nor meet in one task.
    names = ", ".join(f"`{k}`" for k in keys)
    asked = asked.selectExpr(
        "*", "cast(CASE WHEN __pf_t IS NOT NULL AND __pf_src IS NOT NULL AND __pf_dst IS NOT NULL THEN floor(__pf_x / 3600) "
             f"ELSE -1 - pmod(xxhash64({names}), {_IDLE_KEYS}) END AS int) AS __pf_hour")
    met = asked.join(lookup, F.expr("__pf_src = __pf_l_src AND __pf_dst = __pf_l_dst AND __pf_hour = __pf_l_hour"), "left")
    # The first departure of the hour that is not before the ready time: its place among the sorted seconds
    came = [*[f"`{c}`" for c in state], "__pf_src", "__pf_dst", "__pf_day"]
    met = met.selectExpr(*came, "__pf_l_first", "coalesce(get(__pf_l_deps, cast(array_position(sort_array(concat("
                         "__pf_l_secs, array(__pf_x))), __pf_x) AS int) - 1), __pf_l_later) AS __pf_today")
    met = met.selectExpr(*came, "coalesce(__pf_today, __pf_l_first) AS __pf_dep",
                         "CASE WHEN __pf_today IS NULL THEN 86400L ELSE 0L END AS __pf_wait")
    met = met.selectExpr(*came, "__pf_dep",
                         "timestampadd(SECOND, cast(__pf_dep.secs AS bigint) + __pf_wait, __pf_day) AS __pf_start")
    met = met.selectExpr("*", "timestampadd(MINUTE, cast(__pf_dep.run AS bigint), __pf_start) AS __pf_end")
    before = "__pf_pre" if leg == 0 else f"get(__pf_rem, {leg - 1})"
    record = (f"cast(named_struct('leg_idx', {leg}, 'src', __pf_src, 'dst', __pf_dst, 'path_no', {leg} + __pf_no, "
              f"'pre_org', {before}, 'start_time', __pf_start, 'end_time', __pf_end) AS {_OUT})")
    ready = timefmt.add_hours(F.col("__pf_end"), F.col("__pf_dep.unload").cast("double"), fractional=True)
    return met.select(
        *[c for c in state if c not in ("__pf_t", "__pf_out")], F.when(F.col("__pf_dep").isNotNull(), ready).alias("__pf_t"),
        F.expr(f"CASE WHEN __pf_dep IS NOT NULL THEN concat(__pf_out, array({record})) ELSE __pf_out END").alias("__pf_out"))


def schedule_walk(df: DataFrame, tt: DataFrame, key, remaining_col: str, ready_col: str,
                  status_col: str | None = None, leave_org_col: str | None = None, carry=()) -> DataFrame:
    """Walk each waybill's remaining route through the timetable.

    ``df`` has one row per waybill: ``key``, the stops still ahead (``remaining_col``), the ready
    time, and ``carry`` columns that are passed on.  Every leg takes the next departure at/after the
    current ready time (rolling to the next day), arrives ``run_minutes`` later and is ready again
    ``unload_time`` hours after arrival.  The walk stops at the first leg whose pair has no line
    (earlier legs are kept); a NULL ready time or fewer than two stops give no row.  Returns one row
    per walked leg: key, ``carry`` columns, leg_idx, src, dst, path_no and pre_org (as ``legs``
    numbers them), start_time, end_time.

    Leg after leg, every waybill is one row that meets one row of ``lines.departures_by_hour``, by
    (pair, hour): timetables do not travel with the waybills, and a pair that a third of all waybills
    take is a skewed left side, which Spark splits.  Routes of more than ``LEGS_AT_ONCE`` legs
    go on from a written table, so the plan does not grow with the longest route.
    """
    keys = _keys(key)
    lookup = written(L.departures_by_hour(tt).select(
        F.col(L.SRC).alias("__pf_l_src"), F.col(L.DST).alias("__pf_l_dst"),
        *[F.col(c).alias(f"__pf_l_{c}") for c in ("hour", "secs", "deps", "later", "first")]), "departures")
    status = F.col(status_col) if status_col else F.lit(None).cast("string")
    leave = F.col(leave_org_col) if leave_org_col else F.lit(None).cast("string")
    in_transit = F.coalesce(status == F.lit(IN_TRANSIT_STATUS), F.lit(False))
    state = df.select(*keys, *carry, F.col(remaining_col).alias("__pf_rem"), F.col(ready_col).alias("__pf_t"),
                      F.when(in_transit, 2).otherwise(1).alias("__pf_no"), F.when(in_transit, leave).alias("__pf_pre"))
    seen = Observation()
    stored = written(state.observe(seen, F.max(F.size("__pf_rem")).alias("longest")), "walk")
    state = stored.filter(F.col("__pf_t").isNotNull() & (F.size("__pf_rem") >= 2))
    state = state.withColumn("__pf_out", F.array().cast(f"array<{_OUT}>"))
    cores = state.sparkSession.sparkContext.defaultParallelism
    if len(state.inputFiles()) < cores:  # an input of few tasks, which would leave cores idle all the way
        state = state.repartition(cores)
    for leg in range((seen.get["longest"] or 1) - 1):
        if leg and leg % LEGS_AT_ONCE == 0:
            state = written(state, "walk")
            discard(stored)
            stored = state
        state = _walk_leg(state, lookup, keys, leg)
    return state.select(*keys, *carry, F.inline_outer("__pf_out")).filter(F.col("leg_idx").isNotNull())
