"""Timestamp text layouts and time arithmetic as native Column expressions.

Everything here compiles to Catalyst expressions (regex rewrite, ``try_cast``,
``date_format``, ``timestampadd``/``timestampdiff``), so it stays inside whole-stage codegen;
there is no Python UDF.  Parsed values are ``TIMESTAMP_NTZ``: the source text carries no zone
and the result must not move with the session time zone.

Semantic decisions (see SURVEY §8):

* impossible dates (``2020-13-05``) give NULL instead of being rolled over (Q24);
* a fraction after the seconds is accepted and dropped, like the original parser;
* NULL / unparsable input gives NULL, never an exception (Q23).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------------------
# Accepted text layouts, tried in this order; the first full match wins.  Each entry is
# (layout name, full-match regex, which calendar fields the capture groups fill).  Missing
# date fields default to 1970-01-01, missing time fields to 0.
TEXT_LAYOUTS = [
    ("yyyy-MM-dd HH:mm:ss[.f]", r"(\d{4})-(\d{1,2})-(\d{1,2})\s+(\d{1,2}):(\d{1,2}):(\d{1,2})[.]?\d*", "ymdHMS"),
    ("yyyy-MM-ddHH:mm:ss", r"(\d{4})-(\d{1,2})-(\d{1,2})(\d{1,2}):(\d{1,2}):(\d{1,2})", "ymdHMS"),
    ("yyyy-MM-dd HH:mm", r"(\d{4})-(\d{1,2})-(\d{1,2})\s+(\d{1,2}):(\d{1,2})", "ymdHM"),
    ("yyyy/MM/dd HH:mm:ss", r"(\d{4})/(\d{1,2})/(\d{1,2})\s+(\d{1,2}):(\d{1,2}):(\d{1,2})", "ymdHMS"),
    ("yyyy/MM/dd HH:mm", r"(\d{4})/(\d{1,2})/(\d{1,2})\s+(\d{1,2}):(\d{1,2})", "ymdHM"),
    ("yyyy-MM-dd", r"(\d{4})-(\d{1,2})-(\d{1,2})", "ymd"),
    ("yyyyMMddHHmmss", r"(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})", "ymdHMS"),
    ("yyyyMMdd", r"(\d{4})(\d{2})(\d{2})", "ymd"),
    ("yyyyMM", r"(\d{4})(\d{2})", "ym"),
    ("HH:mm:ss[.f]", r"(\d{1,2}):(\d{1,2}):(\d{1,2})[.]?\d*", "HMS"),
    ("HH:mm", r"(\d{1,2}):(\d{1,2})", "HM"),
]

# The ISO layout of the raw exports; fraction and zone may follow.
ISO_LAYOUT = ("yyyy-MM-ddTHH:mm:ss[.f][zone]", r"(\d{4})-(\d{2})-(\d{2})T(\d{2}):(\d{2}):(\d{2})(?:[.]\d+)?(?:Z|[+-]\d{2}:?\d{2})?", "ymdHMS")

# The full form of it: exact digits throughout, so that its first 19 characters alone decide the time.
EXPORT_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}[.]\d{3}Z\z"

# Named output patterns (name -> Spark datetime pattern).
FORMATS = {
    "TIME": "yyyy-MM-dd HH:mm:ss",
    "DATE": "yyyy-MM-dd",
    "MONTH": "yyyy-MM",
    "DATETIME": "yyyy-MM-dd 00:00:00",
    "TIMEASKEY": "yyyyMMddHHmmss",
    "MINSASKEY": "yyyyMMddHHmm",
    "HOURSASKEY": "yyyyMMddHH",
    "DATEASKEY": "yyyyMMdd",
    "MONTHASKEY": "yyyyMM",
    "HHMMSS": "HH:mm:ss",
    "YYMMDDHHMM": "yyyy-MM-dd HH:mm",
    "YYMMDD_HH": "yyyy-MM-dd HH",
    "YY-MM-DD HH:00:00": "yyyy-MM-dd HH:00:00",
    "yyyy-MM-dd HH:mm:ss": "yyyy-MM-dd HH:mm:ss",
}
# The compact layout that TIME keeps when the input text used it.
COMPACT_TIME_PATTERN = "yyyy-MM-ddHH:mm:ss"
# ------------------------------------------------------------------------------------------

def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _parsed(c, layouts) -> Column:
    """The text rewritten from the first layout that matches all of it to ``y-M-d H:m:s`` and cast.

    A column named by its name is parsed by one SQL expression, which costs the driver one call
    instead of one per function and layout.
    """
    if isinstance(c, str):
        return F.expr(_parsed_sql(c, layouts))
    text, plain = F.trim(c.cast("string")), None
    for w, to in _cases(layouts):
        value = F.regexp_replace(text, w, to)
        plain = F.when(text.rlike(w), value) if plain is None else plain.when(text.rlike(w), value)
    return plain.try_cast("timestamp_ntz")


def _cases(layouts) -> list[tuple[str, str]]:
    """(regex, replacement by ``y-M-d H:m:s``) per layout."""
    cases = []
    for _, regex, fields in layouts:
        group = {f: f"${i}" for i, f in enumerate(fields, start=1)}
        y, mo, d, h, mi, s = (group.get(f, default) for f, default in zip("ymdHMS", ("1970", "01", "01", "00", "00", "00")))
        cases.append((f"^{regex}$", f"{y}-{mo}-{d} {h}:{mi}:{s}"))
    return cases


def _parsed_sql(c: str, layouts) -> str:
    t = f"trim(cast(`{c}` AS string))"
    whens = " ".join(f"WHEN rlike({t}, r'{w}') THEN regexp_replace({t}, r'{w}', '{to}')" for w, to in _cases(layouts))
    return f"try_cast(CASE {whens} END AS timestamp_ntz)"


def parse_ts(c) -> Column:
    """Text in any of the ``TEXT_LAYOUTS`` -> TIMESTAMP_NTZ; NULL when nothing matches or
    the calendar fields are impossible."""
    return _parsed(c, TEXT_LAYOUTS)


def parse_ts_strict5(c) -> Column:
    """The five-layout variant (full timestamp, compact, date, 14- and 8-digit keys)."""
    keep = {"yyyy-MM-dd HH:mm:ss[.f]", "yyyy-MM-ddHH:mm:ss", "yyyy-MM-dd", "yyyyMMddHHmmss", "yyyyMMdd"}
    return _parsed(c, [layout for layout in TEXT_LAYOUTS if layout[0] in keep])


def iso_to_ts(c) -> Column:
    """ISO text such as ``2019-12-12T10:00:00.000Z`` -> TIMESTAMP_NTZ (fraction and zone dropped).
    Every other layout is parsed as by ``parse_ts`` (decision Q2).

    The full 24-character form, which raw exports have throughout, is told by one regex and its first 19
    characters are cast as they stand; only other texts are matched against the layouts.  That match is
    one lambda, whose code stays out of the row loop: inlined for two or more columns it would make the
    loop's method longer than the JVM compiles (8,000 bytes), and every row would be interpreted."""
    layouts = [ISO_LAYOUT, *TEXT_LAYOUTS]
    if not isinstance(c, str):
        return _parsed(c, layouts)
    return F.expr(f"CASE WHEN `{c}` IS NULL THEN NULL WHEN rlike(`{c}`, r'{EXPORT_SHAPE}') THEN try_cast(substr(`{c}`, 1, 19) AS "
                  f"timestamp_ntz) ELSE get(transform(array(`{c}`), __pf_text -> {_parsed_sql('__pf_text', layouts)}), 0) END")


def to_ts(c, dtype: str) -> Column:
    """Bring a column of type ``dtype`` (a Spark simpleString) to TIMESTAMP_NTZ."""
    return iso_to_ts(c) if dtype == "string" else _as_col(c).cast("timestamp_ntz")


def format_ts(c, name: str) -> Column:
    """Format a timestamp column with one of the named ``FORMATS``; unknown name -> NULL."""
    pattern = FORMATS.get(name)
    if pattern is None:
        return F.lit(None).cast("string")
    return F.date_format(_as_col(c), pattern)


def format_text(c, name: str) -> Column:
    """Parse text then format it; ``TIME`` keeps the compact layout when the input used it."""
    text = F.trim(_as_col(c).cast("string"))
    ts = parse_ts(text)
    out = format_ts(ts, name)
    if name == "TIME":
        compact = text.rlike("^" + TEXT_LAYOUTS[1][1] + "$") & ~text.rlike("^" + TEXT_LAYOUTS[0][1] + "$")
        out = F.when(compact, F.date_format(ts, COMPACT_TIME_PATTERN)).otherwise(out)
    return out


def minutes_between(a, b) -> Column:
    """(a - b) in minutes as DOUBLE, exact to the microsecond; NULL if either side is NULL."""
    return F.timestamp_diff("MICROSECOND", _as_col(b), _as_col(a)).cast("double") / F.lit(60_000_000.0)


def millis_between(a, b) -> Column:
    """(a - b) in milliseconds as DOUBLE."""
    return F.timestamp_diff("MICROSECOND", _as_col(b), _as_col(a)).cast("double") / F.lit(1000.0)


def _whole_minutes(amount: Column, minutes_per_unit: int) -> Column:
    # fractional amounts are applied as whole minutes, truncated toward zero; NULL or text that
    # is not a number counts as 0 (never an error)
    num = amount.try_cast("double")
    return F.when(num.isNull(), F.lit(0)).otherwise((num * F.lit(float(minutes_per_unit))).cast("long"))


def add_days(ts, days, fractional: bool = False) -> Column:
    """ts + days.  Integral amounts move calendar days; ``fractional=True`` applies the amount as
    whole minutes (days * 1440, truncated).  NULL amount counts as 0."""
    ts, days = _as_col(ts), (F.lit(days) if isinstance(days, (int, float)) else _as_col(days))
    if fractional:
        return F.timestamp_add("MINUTE", _whole_minutes(days, 1440), ts)
    return F.timestamp_add("DAY", F.coalesce(days.cast("long"), F.lit(0)), ts)


def add_hours(ts, hours, fractional: bool = False) -> Column:
    """ts + hours; fractional amounts become whole minutes (hours * 60, truncated)."""
    ts, hours = _as_col(ts), (F.lit(hours) if isinstance(hours, (int, float)) else _as_col(hours))
    if fractional:
        return F.timestamp_add("MINUTE", _whole_minutes(hours, 60), ts)
    return F.timestamp_add("HOUR", F.coalesce(hours.cast("long"), F.lit(0)), ts)


def add_minutes(ts, minutes) -> Column:
    """ts + whole minutes; NULL minutes count as 0."""
    ts, minutes = _as_col(ts), (F.lit(minutes) if isinstance(minutes, (int, float)) else _as_col(minutes))
    return F.timestamp_add("MINUTE", F.coalesce(minutes.cast("long"), F.lit(0)), ts)


def add_seconds(ts, seconds) -> Column:
    """ts + whole seconds; NULL seconds count as 0."""
    ts, seconds = _as_col(ts), (F.lit(seconds) if isinstance(seconds, (int, float)) else _as_col(seconds))
    return F.timestamp_add("SECOND", F.coalesce(seconds.cast("long"), F.lit(0)), ts)


def time_of_day_seconds(c) -> Column:
    """A time-of-day text (``H:m``, ``HH:mm:ss``, with or without padding) -> seconds after
    midnight; NULL when it is not a valid time of day.  Numeric comparison fixes the string
    ordering of unpadded times (decision Q18)."""
    text = F.trim(_as_col(c).cast("string"))
    pat = r"^(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?(?:[.]\d*)?$"
    h = F.regexp_extract(text, pat, 1).cast("int")
    m = F.regexp_extract(text, pat, 2).cast("int")
    s = F.coalesce(F.nullif(F.regexp_extract(text, pat, 3), F.lit("")).cast("int"), F.lit(0))
    ok = text.rlike(pat) & (h < 24) & (m < 60) & (s < 60)
    return F.when(ok, h * 3600 + m * 60 + s)


def at_time_of_day(day_of, seconds) -> Column:
    """The calendar day of ``day_of`` at ``seconds`` after midnight (TIMESTAMP_NTZ)."""
    midnight = F.date_trunc("DAY", _as_col(day_of)).cast("timestamp_ntz")
    return F.timestamp_add("SECOND", _as_col(seconds).cast("long"), midnight)


def format_pattern(c, pattern: str | None) -> Column:
    """Format with an explicit Spark datetime pattern; an empty or missing pattern gives NULL."""
    if not pattern:
        return F.lit(None).cast("string")
    return F.date_format(_as_col(c), pattern)
