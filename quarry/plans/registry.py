"""Name -> query callable and name -> oracle SQL, for the driver contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.plans import baseline, bindings, coverage, enrich, enrollment, landed, matching, oracle, recipes, recipes_sql, region, reports, reports_sql

MODULES = (bindings, recipes, reports, baseline, coverage, enrich, enrollment, landed, matching, region)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name[2:]: getattr(m, name) for m in MODULES for name in dir(m) if name.startswith("q_")}


def oracle_sql() -> dict[str, str]:
    known = queries()
    sql = oracle.SQL | recipes_sql.SQL | reports_sql.SQL | baseline.SQL | coverage.SQL | enrich.SQL | enrollment.SQL | landed.SQL | matching.SQL | region.SQL
    return {k: v for k, v in sql.items() if k in known}
