"""Input guards: dispatch by schema, required columns, optional inputs."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

logger = logging.getLogger(__name__)


def dispatch_by_column(df: DataFrame, column: str, when_present: Callable[[DataFrame], DataFrame],
                       otherwise: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Choose the operator by the presence of a column (schema metadata only);
    if the chosen path fails to plan, fall back to the other one."""
    first, second = (when_present, otherwise) if column in df.columns else (otherwise, when_present)
    try:
        out = first(df)
        out.schema  # forces analysis, so a bad plan fails here
        return out
    except AnalysisException as e:
        logger.warning("the first choice for column %s does not plan, taking the other: %s", column, e)
        return second(df)


def has_columns(df: DataFrame | None, required: Sequence[str]) -> bool:
    """All required columns exist."""
    return df is not None and set(required) <= set(df.columns)


def enrich_or_null(df: DataFrame, lookup: DataFrame | None, required: Sequence[str],
                   enrich: Callable[[DataFrame, DataFrame], DataFrame], out_col: str,
                   out_type: str = "double") -> DataFrame:
    """Run ``enrich`` only when the lookup has the required columns; otherwise
    add ``out_col`` as a typed NULL column so downstream schemas stay stable."""
    if has_columns(lookup, required):
        return enrich(df, lookup)
    return df.withColumn(out_col, F.lit(None).cast(out_type))


def optional_stage(df: DataFrame, extra: DataFrame | None,
                   stage: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """A stage whose extra input is absent or empty is a no-op."""
    if extra is None or extra.isEmpty():
        return df
    return stage(df, extra)
