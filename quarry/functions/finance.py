"""Row-level business rules: ratios, labels, shares, solvency scoring
(F14-F18, F20-F24, F29). All native expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.coerce import clip, safe_div


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The derived ratio set (F15): output -> (numerator, denominator, scale).
# A denominator given as (column, divisor) divides that column first.
RATIO_SPEC: dict[str, tuple] = {
    "Current_Ratio": ("CMS_Current_Assets", "CMS_Current_Liabilities", 1.0),
    "Debt_Ratio": ("CMS_Total_Liabilities", "CMS_Total_Assets", 1.0),
    "Days_Cash_on_Hand": ("CMS_Cash", ("CMS_Operating_Expense", 365.0), 1.0),
    "Labor_Cost_Pct": ("CMS_Total_Salaries", "CMS_Total_Costs", 100.0),
    "Rev_per_Discharge": ("CMS_Net_Patient_Revenue", "Total_Discharges", 1.0),
    "Cost_per_Discharge": ("CMS_Total_Costs", "Total_Discharges", 1.0),
    "Outpatient_Rev_Pct": ("CMS_Outpatient_Revenue", "CMS_Net_Patient_Revenue", 100.0),
    "Medicare_Pct_Days": ("Medicare_Days", "Total_Patient_Days", 100.0),
    "Medicaid_Pct_Days": ("Medicaid_Days", "Total_Patient_Days", 100.0),
    "Charity_Care_Pct_Revenue": ("CMS_Charity_Care_Cost", "CMS_Net_Patient_Revenue", 100.0),
    "Rev_per_Adj_Discharge": ("NASHP_Net_Patient_Revenue", "Adjusted_Patient_Discharges", 1.0),
    "Cost_per_Adj_Discharge": ("NASHP_Hospital_Op_Costs", "Adjusted_Patient_Discharges", 1.0),
}
# Percentage copies of source fractions.
PERCENT_SPEC = {
    "Operating_Margin_Pct": "NASHP_Operating_Margin",
    "Net_Profit_Margin_Pct": "NASHP_Net_Profit_Margin",
}


def derive_ratios(df: DataFrame, spec: Mapping[str, tuple] = RATIO_SPEC,
                  percent: Mapping[str, str] = PERCENT_SPEC) -> DataFrame:
    """add (or overwrite) every ratio whose inputs exist; missing inputs give NULL."""
    have = set(df.columns)

    def col_or_null(name):
        return F.col(name).cast("double") if name in have else F.lit(None).cast("double")

    out = {}
    for name, src in percent.items():
        out[name] = col_or_null(src) * 100
    for name, (num, den, scale) in spec.items():
        if isinstance(den, tuple):
            den_col = col_or_null(den[0]) / F.lit(den[1])
        else:
            den_col = col_or_null(den)
        r = safe_div(col_or_null(num), den_col)
        out[name] = r * F.lit(scale) if scale != 1.0 else r
    return df.withColumns(out)


def provenance(left_present, right_present, both: str = "both", left: str = "left only",
               right: str = "right only") -> Column:
    """F16: three-way source label from two presence flags."""
    lp = _c(left_present) == 1
    rp = _c(right_present) == 1
    return F.when(lp & rp, F.lit(both)).when(lp, F.lit(left)).when(rp, F.lit(right))


def bucket(c, buckets: Mapping[str, Sequence[str]], default: str = "Other") -> Column:
    """first bucket whose value list holds the trimmed text; else ``default``
    (NULL included)."""
    s = F.trim(_c(c).cast("string"))
    out = None
    for label, values in buckets.items():
        cond = s.isin(*values)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.coalesce(out.otherwise(F.lit(default)), F.lit(default)) if out is not None else F.lit(default)


# Facility-type buckets used by the reports.
FACILITY_BUCKETS = {
    "STH": ["STH", "Short Term (General and Specialty) Hospitals"],
    "CAH": ["CAH", "Critical Access Hospitals"],
    "LTCH": ["LTCH"],
    "PH": ["PH"],
    "RH": ["RH"],
}


def or_flag(*conditions) -> Column:
    """1 if any condition is true; NULL comparisons count as false."""
    acc = F.lit(False)
    for cond in conditions:
        acc = acc | F.coalesce(cond, F.lit(False))
    return acc.cast("int")


def share_with_fallback(part, other, pct_fallback) -> Column:
    """part/(part+other) when both present and the sum > 0, else pct/100;
    clipped to [0, 1], NULL kept."""
    p, o = _c(part).cast("double"), _c(other).cast("double")
    total = F.coalesce(p, F.lit(0.0)) + F.coalesce(o, F.lit(0.0))
    ok = p.isNotNull() & o.isNotNull() & (total > 0)
    raw = F.when(ok, p / F.when(total != 0, total)).otherwise(_c(pct_fallback).cast("double") / 100)
    return clip(raw, 0.0, 1.0)


def implied_other_income(net_income, revenue, expenses, one_off=None) -> Column:
    """NI - (revenue - expenses), minus a one-off item (NULL -> 0) if given."""
    x = _c(net_income) - (_c(revenue) - _c(expenses))
    if one_off is not None:
        x = x - F.coalesce(_c(one_off).cast("double"), F.lit(0.0))
    return x


# Solvency rule table (F22): metric, direction, severe, mild, flag texts.
SOLVENCY_RULES = [
    ("Days_Cash_on_Hand", "<", 30, 90, "DCOH<30", "DCOH<90"),
    ("Current_Ratio", "<", 1.0, 2.0, "CR<1.0", "CR<2.0"),
    ("Debt_Ratio", ">", 0.7, 0.5, "DR>0.7", "DR>0.5"),
    ("Operating_Margin_Pct", "<", -0.10, 0, "OM<-10%", "OM<0%"),
]


def solvency(metrics: Mapping[str, Column] | None = None, rules=SOLVENCY_RULES) -> dict[str, Column]:
    """score 0-8 (2 for the severe band, 1 for the mild band, per metric, NULL
    scores 0), status (>=4 Distressed, >=2 Marginal, else Stable) and flags joined
    by ', ' ('None' when empty). ``metrics`` maps rule names to columns."""
    metrics = dict(metrics or {})
    score = F.lit(0)
    flags = []
    for name, op, severe, mild, f_severe, f_mild in rules:
        x = metrics.get(name, F.col(name)).cast("double")
        if op == "<":
            sev, mil = x < F.lit(severe), x < F.lit(mild)
        else:
            sev, mil = x > F.lit(severe), x > F.lit(mild)
        points = F.when(x.isNull(), 0).when(sev, 2).when(mil, 1).otherwise(0)
        score = score + points
        flags.append(F.when(x.isNotNull() & sev, F.lit(f_severe))
                     .when(x.isNotNull() & mil, F.lit(f_mild)))
    joined = F.concat_ws(", ", *flags)
    return {
        "Solvency_Score": score.cast("int"),
        "Solvency_Status": F.when(score >= 4, "Distressed").when(score >= 2, "Marginal").otherwise("Stable"),
        "Solvency_Flags": F.when(joined == "", F.lit("None")).otherwise(joined),
    }


def derived_financials(revenue, expenses, op_share, default_share: float = 0.5,
                       risk_cut: float = 0.25) -> dict[str, Column]:
    """operating income, margin (revenue > 0 only), IP/OP revenue split with a
    default share, swing-bed risk flag."""
    rev, exp = _c(revenue).cast("double"), _c(expenses).cast("double")
    share = F.coalesce(_c(op_share).cast("double"), F.lit(default_share))
    inc = rev - exp
    return {
        "Historical_Op_Income": inc,
        "Historical_Op_Margin": F.when(rev > 0, inc / rev),
        "IP_Revenue": rev * (1 - share),
        "OP_Revenue": rev * share,
        "Swing_Bed_Risk": (1 - share) > F.lit(risk_cut),
    }


def flag_label(c, yes: str = "CAH", other: str = "Short-Term Hospital", token: str = "Y") -> Column:
    """``token`` (any case) -> yes; other non-empty -> other; empty/NULL -> NULL."""
    s = _c(c).cast("string")
    return (F.when(F.upper(s) == F.lit(token.upper()), F.lit(yes))
            .when(s.isNotNull() & (s != ""), F.lit(other)))


def report_round(c, digits: int = 4) -> Column:
    """half-even rounding (numpy semantics), NULL kept."""
    return F.bround(_c(c).cast("double"), digits)
