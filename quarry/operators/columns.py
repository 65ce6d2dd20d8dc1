"""Column-level operators: rename, keep, order, header rules, drop, typed nulls
(P1-P6, P9, P11). These touch only the schema (driver-side metadata), never rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by dictionary; absent names are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def keep_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Keep the wanted columns that exist, in the wanted order."""
    have = set(df.columns)
    return df.select(*[c for c in wanted if c in have])


def canonical_order(df: DataFrame, ordered: Sequence[str], types: Mapping[str, str] | None = None) -> DataFrame:
    """Canonical columns first (missing ones added as typed NULLs when a type is
    given), unknown columns appended in their current order."""
    types = dict(types or {})
    have = set(df.columns)
    cols = []
    for c in ordered:
        if c in have:
            cols.append(F.col(c))
        elif c in types:
            cols.append(F.lit(None).cast(types[c]).alias(c))
    extras = [F.col(c) for c in df.columns if c not in set(ordered)]
    return df.select(*cols, *extras)


def normalize_headers(df: DataFrame, lower: bool = False) -> DataFrame:
    """Strip (and optionally lower-case) every header."""
    new = [c.strip().lower() if lower else c.strip() for c in df.columns]
    return df.toDF(*new)


# Header keyword rules (P5): target, any-of keywords, none-of keywords.
HEADER_RULES = [
    ("Hospital Name", ("hospital", "facility"), ()),
    ("State", ("state",), ("address",)),
    ("REH Conversion Date", ("date", "effective", "conversion"), ()),
    ("Previous Medicare Payment Type", ("payment", "previous", "prior", "type"), ()),
    ("Current Status", ("status",), ()),
]


def harmonize_headers(columns: Sequence[str], rules=HEADER_RULES) -> dict[str, str]:
    """P5: for each header in order, the first rule whose keywords match and whose
    target is still free. Each target is used once (T22)."""
    used: set[str] = set()
    mapping: dict[str, str] = {}
    for col in columns:
        cl = col.lower()
        for target, anyof, noneof in rules:
            if target in used:
                continue
            if any(k in cl for k in anyof) and not any(k in cl for k in noneof):
                mapping[col] = target
                used.add(target)
                break
    return mapping


def drop_existing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop helper columns; absent names ignored."""
    return df.drop(*[n for n in names if n in df.columns])


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None, how: str = "any") -> DataFrame:
    """Drop rows with a NULL in ``subset`` (how='any') or entirely NULL rows
    (how='all')."""
    return df.dropna(how=how, subset=list(subset) if subset else None)


def with_constant(df: DataFrame, name: str, value, dtype: str | T.DataType | None = None) -> DataFrame:
    """Constant or typed-NULL column."""
    c = F.lit(value)
    if dtype is not None:
        c = c.cast(dtype)
    return df.withColumn(name, c)
