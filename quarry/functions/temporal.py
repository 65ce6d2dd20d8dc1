"""Date rules: dominant year, day spans, months since an event, period labels
(F4, F5, F6, F19, F26, F27)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.coerce import clip


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dominant_year(begin, end) -> Column:
    """the calendar year holding most days of [begin, end] (both inclusive).

    Ties go to the earliest year; a NULL bound gives NULL; end < begin gives
    year(begin). Evaluated per row with array higher-order functions — one
    element per spanned year, so the work is bounded by the span, not the data.
    """
    b, e = _c(begin).cast("date"), _c(end).cast("date")
    per_year = F.transform(
        F.sequence(F.year(b), F.year(e)),
        lambda y: F.struct(
            (F.datediff(F.least(e, F.make_date(y, F.lit(12), F.lit(31))),
                        F.greatest(b, F.make_date(y, F.lit(1), F.lit(1)))) + 1).alias("days"),
            (-y).alias("neg_year"),
        ),
    )
    best = -F.array_max(per_year)["neg_year"]
    return (F.when(b.isNull() | e.isNull(), F.lit(None).cast("int"))
            .when(e < b, F.year(b))
            .otherwise(best))


def day_span(begin, end) -> Column:
    """whole days end - begin (NULL if either is NULL)."""
    return F.datediff(_c(end).cast("date"), _c(begin).cast("date"))


def months_since(event, end, flag=None, days_per_month: float = 30.44) -> Column:
    """months from ``event`` to ``end``, floored at 0, one decimal half-even;
    NULL when not flagged or a date is missing."""
    m = F.datediff(_c(end).cast("date"), _c(event).cast("date")) / F.lit(days_per_month)
    out = F.bround(clip(m, lower=0.0), 1)
    if flag is not None:
        out = F.when(_c(flag) == 1, out)
    return out


def period_label(begin, end, event, before: str = "CAH_Year", after: str = "REH_Year",
                 straddle: str = "Transition") -> Column:
    """classify a reporting period against an event date. No event -> before;
    begin >= event -> after (wins when both hold); end <= event -> before; anything
    else, including missing period dates -> straddle."""
    b, e, ev = _c(begin).cast("date"), _c(end).cast("date"), _c(event).cast("date")
    return (F.when(ev.isNull(), F.lit(before))
            .when(b >= ev, F.lit(after))
            .when(e <= ev, F.lit(before))
            .otherwise(F.lit(straddle)))


def year_of(c) -> Column:
    """F26."""
    return F.year(_c(c))


def iso_date(c) -> Column:
    """date -> 'yyyy-MM-dd', NULL kept."""
    return F.date_format(_c(c).cast("date"), "yyyy-MM-dd")
