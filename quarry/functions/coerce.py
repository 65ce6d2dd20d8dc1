"""Value coercion: numbers, dates, ids, safe arithmetic.

All functions build native Column expressions (no Python UDFs), so they stay
inside whole-stage codegen and never raise under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Strings a CSV reader treats as missing (same list as pandas' default
# na_values), compared after trimming.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Plain decimal / scientific notation only: rejects '1,234', '0x10', '1d', 'inf'.
NUMERIC_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Accepted date layouts (T13) as (shape, pattern). The shape picks
# exactly one pattern per value, so a row is parsed once (a failed parse attempt
# is costly); an impossible date in the right shape still becomes NULL.
DATE_LAYOUTS = [
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2}:\d{2}$", "yyyy-M-d H:mm:ss"),
    (r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{2}:\d{2}$", "yyyy-M-d'T'H:mm:ss"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$", "M/d/yyyy H:mm:ss"),
    (r"^\d{1,2}/\d{1,2}/\d{2}$", "M/d/yy"),
    (r"^\d{8}$", "yyyyMMdd"),
]
DATE_FORMATS = [fmt for _, fmt in DATE_LAYOUTS]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def na_to_null(c) -> Column:
    """String cell -> NULL when it is an NA token (T26), else the trimmed text."""
    s = F.trim(_c(c).cast("string"))
    return F.when(s.isin(*NA_TOKENS) | s.isNull(), F.lit(None).cast("string")).otherwise(s)


def nan_to_null(c) -> Column:
    """Double NaN -> NULL (T1): pandas treats NaN as missing, Spark as a value."""
    x = _c(c).cast("double")
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def to_number(c) -> Column:
    """lenient numeric coercion; anything not plainly numeric becomes NULL."""
    s = F.trim(_c(c).cast("string"))
    ok = s.rlike(NUMERIC_PATTERN)
    return nan_to_null(F.when(ok, s.try_cast("double")))


def to_long_id(c) -> Column:
    """Integer id from text: '12', '12.0', ' 12 ' -> 12; overflow/garbage -> NULL."""
    s = F.trim(_c(c).cast("string"))
    x = to_number(c)
    # plain digits go straight to a long: a double holds only 53 bits of them
    whole = F.when((x.isNotNull()) & (x == F.floor(x)), x.try_cast("long"))
    return F.when(s.rlike(r"^[+-]?[0-9]+$"), s.try_cast("long")).otherwise(whole)


def to_date_lenient(c, layouts=DATE_LAYOUTS) -> Column:
    """text -> DATE using the first layout whose shape matches; anything else
    (blank, NA token, unknown layout, impossible date) -> NULL. Values that already
    are dates or timestamps are returned as dates."""
    col = _c(c)
    s = na_to_null(col.cast("string"))
    out = None
    for shape, fmt in layouts:
        parsed = F.try_to_timestamp(s, F.lit(fmt)).cast("date")
        out = F.when(s.rlike(shape), parsed) if out is None else out.when(s.rlike(shape), parsed)
    return out


def date_of(c) -> Column:
    """Already typed timestamp/date -> DATE."""
    return _c(c).cast("date")


def safe_div(num, den) -> Column:
    """NULL when the denominator is 0 or NULL or the numerator is NULL."""
    n, d = _c(num).cast("double"), _c(den).cast("double")
    return F.when(n.isNotNull() & d.isNotNull() & (d != 0), n / d)


def clip(c, lower=None, upper=None) -> Column:
    """clip that keeps NULL (greatest/least alone would turn NULL into a bound, T14)."""
    x = _c(c)
    y = x
    if lower is not None:
        y = F.greatest(y, F.lit(lower))
    if upper is not None:
        y = F.least(y, F.lit(upper))
    return F.when(x.isNotNull(), y)


def zero_pad(c, width: int = 6, drop_after_dot: bool = False) -> Column:
    """trim, optionally drop text from the first '.', left-pad with zeros to
    ``width`` but never truncate (bare lpad truncates, T15)."""
    s = F.trim(_c(c).cast("string"))
    if drop_after_dot:
        s = F.substring_index(s, ".", 1)
    s = F.when(s.isin("", ".", "nan", "NaN", "None"), F.lit(None).cast("string")).otherwise(s)
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def clean_zip(c) -> Column:
    """F8: trim, keep the part before '-', pad to 5; NULL stays NULL."""
    s = F.substring_index(F.trim(_c(c).cast("string")), "-", 1)
    return F.when(F.length(s) >= 5, s).otherwise(F.lpad(s, 5, "0"))


def id_suffix_between(c, lo: int, hi: int, start: int = 3) -> Column:
    """characters from position ``start`` (1-based) read as a number in [lo, hi];
    NULL or non-numeric -> false."""
    s = F.substr(_c(c).cast("string"), F.lit(start))
    n = F.when(s.rlike(NUMERIC_PATTERN), s.try_cast("double"))
    return F.coalesce(n.between(lo, hi), F.lit(False))


def unified_id(preferred, fallback, width: int = 6) -> Column:
    """prefer the first id (dot-suffix dropped, padded) else the second."""
    return F.coalesce(zero_pad(preferred, width, drop_after_dot=True), zero_pad(fallback, width))


def coerce_columns(df: DataFrame, numeric: Iterable[str] = (), dates: Iterable[str] = (),
                   ids: Iterable[str] = ()) -> DataFrame:
    """Apply F1/F2 coercion to the named columns that exist (absent names ignored)."""
    cols = set(df.columns)
    mapping = {}
    for c in numeric:
        if c in cols:
            mapping[c] = to_number(c)
    for c in dates:
        if c in cols:
            mapping[c] = to_date_lenient(c)
    for c in ids:
        if c in cols:
            mapping[c] = to_long_id(c)
    return df.withColumns(mapping) if mapping else df


def typed_null(dtype: str | T.DataType) -> Column:
    return F.lit(None).cast(dtype)
