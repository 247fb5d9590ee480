"""From query results to the dashboard's figures: incomplete months, repaired KPIs, labels, and the JSON document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import falsy, fixed, flag, month_abbr, quarter_text
from ..operators.folds import last_present, surviving
from ..sources.constants import COHORT_CURVE, DEFAULT_VINTAGES, FLAGGED, FUNNEL, values
from ..sources.params import AsOf
from ..sources.warehouse import Warehouse
from . import cohorts as C
from . import headline as H
from . import markets as M

SERIES = ("revenue", "payment_revenue", "arpc", "active_users", "gtv")


def monthly_dense(wh: Warehouse, as_of: AsOf = AsOf(), rows: DataFrame | None = None) -> DataFrame:
    """Twelve rows: target and actual of five series as doubles; actuals of the current month and later are null.

    Months out of range are skipped and missing ones are null rows.
    """
    rows = H.monthly(wh, as_of) if rows is None else rows
    slots = wh.spark.range(1, 13, 1, 1).select(F.col("id").alias("slot"))
    df = slots.join(rows, F.col("slot") == F.col("month_num"), "left")
    past = F.col("slot") < as_of.day.month
    cols = []
    for s in SERIES:
        cols += [F.col(f"{s}_target").cast("double").alias(f"{s}_target"), F.when(past, F.col(f"{s}_actual").cast("double")).alias(f"{s}_actual")]
    return df.select(F.col("slot").alias("month_num"), month_abbr(F.col("slot")).alias("month"), *cols)


def _array(of: Column | str) -> Column:
    """The values of `of` over the months, in order, nulls in their places; at most twelve."""
    of = F.col(of) if isinstance(of, str) else of
    return F.transform(F.array_sort(F.collect_list(F.struct("month_num", of.alias("v")))), lambda x: x["v"])


def incomplete_months(wh: Warehouse, as_of: AsOf = AsOf(), dense: DataFrame | None = None) -> DataFrame:
    """monthly_dense() with all actuals null where active users fell by over a quarter from the month before; `nulled` says so.

    A month is compared with what survived, so the month after a nulled one stays.
    """
    dense = monthly_dense(wh, as_of) if dense is None else dense
    kept = dense.agg(surviving(_array("active_users_actual")).alias("kept"))
    df = dense.crossJoin(kept).withColumn("now", F.get("kept", (F.col("month_num") - 1).cast("int")))
    nulled = F.col("active_users_actual").isNotNull() & F.col("now").isNull()
    cols = []
    for s in SERIES:
        cols += [f"{s}_target", F.when(~nulled, F.col(f"{s}_actual")).alias(f"{s}_actual")]
    return df.select("month_num", "month", *cols, nulled.alias("nulled"))


def last_complete_month(wh: Warehouse, as_of: AsOf = AsOf(), complete: DataFrame | None = None) -> DataFrame:
    """One row: the active users of the last month that has a value."""
    complete = incomplete_months(wh, as_of) if complete is None else complete
    return complete.agg(last_present(_array("active_users_actual")).alias("latest_active"), F.count("active_users_actual").alias("n_months"))


def kpi_repaired(wh: Warehouse, as_of: AsOf = AsOf(), kpis: DataFrame | None = None, complete: DataFrame | None = None) -> DataFrame:
    """KPIs with defaults for 0 and null, active users from the last complete month where the KPI is under 75 % of it, and deltas."""
    kpis = H.kpis(wh, as_of) if kpis is None else kpis
    one = kpis.crossJoin(last_complete_month(wh, as_of, complete))
    latest = F.col("latest_active")
    low = (latest > 0) & (F.col("active_users") < latest * 0.75)
    active = F.when(F.coalesce(low, F.lit(False)), latest).otherwise(F.col("active_users").cast("double"))
    gtv = falsy(F.col("total_gtv"), F.lit(25.8))
    delta = lambda v, base, n: F.concat(F.lit("+"), fixed((v / base - 1) * 100, n), F.lit("%"))
    return one.select(
        "total_revenue",
        delta(F.col("total_revenue"), 7.6, 1).alias("total_revenue_delta"),
        F.col("payment_revenue").cast("double").alias("payment_revenue"),
        "arpc",
        active.alias("active_users"),
        delta(active, 278000, 0).alias("active_users_delta"),
        gtv.alias("total_gtv"),
        delta(gtv, 23.4, 0).alias("total_gtv_delta"),
        falsy(F.col("monthly_churn"), F.lit(2.1)).alias("monthly_churn"),
        falsy(F.col("annual_churn"), F.lit(22.0)).alias("annual_churn"),
        falsy(F.col("nrr"), F.lit(104).cast("long")).alias("nrr"),
        falsy(F.col("gross_margin"), F.lit(68).cast("long")).alias("gross_margin"),
        "registered",
        "paying",
        "payments_enabled",
    )


VINTAGE = (
    ("merchants", "registrations"),
    ("active_now", "active_now"),
    ("active_pct", "active_pct"),
    ("paying_now", "paying_now"),
    ("paying_pct", "paying_pct"),
    ("active_to_paying_pct", "active_to_paying_pct"),
    ("mrr", "cohort_mrr_eur"),
    ("arr", "cohort_arr_eur"),
    ("arpc", "arpc_eur"),
    ("gtv_30d", "gtv_30d_k_eur"),
    ("gtv_alltime", "gtv_alltime_m_eur"),
    ("revenue_alltime", "revenue_alltime_k_eur"),
    ("npv", "npv_per_merchant_eur"),
    ("ltv", "ltv_per_paying_eur"),
    ("cancelled_30d", "cancelled_30d"),
    ("churn_rate_30d", "churn_rate_30d"),
    ("cohort_age_months", "cohort_age_months"),
)


def cohort_vintages(wh: Warehouse, as_of: AsOf = AsOf(), rows: DataFrame | None = None) -> DataFrame:
    """Cohorts with 0 for null; the built-in vintages where there are none at all."""
    rows = C.cohorts(wh, as_of) if rows is None else rows
    own = rows.select(F.col("cohort_month").alias("month"), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(n) for n, c in VINTAGE])
    own = own.withColumn("payment_pct", F.col("paying_pct"))
    built = values(wh.spark, DEFAULT_VINTAGES, "month, merchants, npv, ltv, arpc, payment_pct")
    have = {"merchants", "npv", "ltv", "arpc"}
    built = built.select("month", *[(F.col(n) if n in have else F.lit(None)).cast("double").alias(n) for n, _ in VINTAGE], F.col("payment_pct").cast("double").alias("payment_pct"))
    none = rows.agg(F.count(F.lit(1)).alias("own_rows")).where("own_rows = 0")
    return own.unionByName(built.crossJoin(none).drop("own_rows"))


def top_markets_flagged(wh: Warehouse, as_of: AsOf = AsOf(), rows: DataFrame | None = None) -> DataFrame:
    rows = M.markets(wh, as_of) if rows is None else rows
    return rows.select(
        "country",
        flag(F.col("country"), FLAGGED).alias("flag"),
        falsy(F.col("gtv_millions"), F.lit(0.0)).alias("gtv"),
        F.col("merchant_count").alias("merchants"),
        falsy(F.col("avg_gtv_per_merchant"), F.lit(0.0)).alias("avg_gtv"),
    )


def funnel_labeled(wh: Warehouse, as_of: AsOf = AsOf(), rows: DataFrame | None = None) -> DataFrame:
    """Stages with document key, label and conversion text; the text is null where the rate is 0 or null."""
    rows = H.funnel(wh, as_of) if rows is None else rows
    known = F.broadcast(values(wh.spark, [(s, label, key) for s, _, label, key in FUNNEL], "known, label, key"))
    rate = F.when(falsy(F.col("conversion_rate"), F.lit(None).cast("double")).isNotNull(), F.concat(fixed(F.col("conversion_rate"), 1), F.lit("%")))
    stage = F.lower("stage")
    return rows.join(known, stage == F.col("known"), "left").select(
        F.coalesce("key", stage).alias("key"),
        F.coalesce("label", stage).alias("label"),
        F.col("current_value").alias("value"),
        rate.alias("conv_rate"),
        "target",
        "stage_order",
    )


def funnel_fallback(repaired: DataFrame) -> DataFrame:
    """The funnel from KPIs alone, with default rates, for when the funnel query gave nothing."""
    v = {"registered": F.col("registered"), "active": F.col("active_users"), "paying": F.col("paying"), "payments_enabled": F.col("payments_enabled")}
    default = {"active": "8.0%", "paying": "3.0%", "payments_enabled": "3.0%"}
    rows, before = [], None
    for i, (stage, goal, label, key) in enumerate(FUNNEL):
        now = v[stage].cast("double")
        rate = F.lit(None).cast("string")
        if before is not None:
            rate = F.when((now > 0) & (before > 0), F.concat(fixed(F.try_divide(now * 100, before), 1), F.lit("%"))).otherwise(default[stage])
        rows.append(
            F.struct(
                F.lit(key).alias("key"),
                F.lit(label).alias("label"),
                now.cast("long").alias("value"),
                rate.alias("conv_rate"),
                F.lit(goal).cast("long").alias("target"),
                F.lit(i + 1).cast("long").alias("stage_order"),
            )
        )
        before = now
    return repaired.select(F.inline(F.array(*rows)))


def unit_economics(wh: Warehouse, as_of: AsOf = AsOf(), vintages: DataFrame | None = None, latest: str = "last") -> DataFrame:
    """One row from the cohort that stands for all.

    latest='last' takes the last row of the list, which is sorted newest first, and so the oldest
    cohort; 'newest' takes the newest.
    """
    vintages = cohort_vintages(wh, as_of) if vintages is None else vintages
    pick = F.min_by if latest == "last" else F.max_by
    row = F.struct("month", "npv", "ltv")
    one = vintages.agg(pick(row, "month").alias("r"))
    npv = F.coalesce(F.col("r.npv"), F.lit(180.0))
    return one.select(
        F.col("r.month").alias("cohort_month"),
        npv.alias("avg_npv"),
        F.coalesce(F.col("r.ltv"), F.lit(180.0)).alias("avg_ltv"),
        F.when(F.col("r").isNull(), 216.0).otherwise(F.floor(npv * 1.2 + 0.5)).cast("double").alias("cohort_payments"),
    )


#: Sections for which the document before stands in where the queries gave no rows.
STANDS_IN = ("revenue_projection", "gtv_projection", "top_markets", "country_weights")


def weights_map(weights: DataFrame) -> DataFrame:
    """One row: country code to weight, at most the rows of country_weights()."""
    return weights.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("country_code", "weight")))).alias("country_weights"))


def _rows(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """One row: a bounded report as a sorted array of structs."""
    return df.agg(F.array_sort(F.collect_list(F.struct(*order, *[c for c in df.columns if c not in order]))).alias(name))


def dashboard_document(wh: Warehouse, as_of: AsOf = AsOf(), results: dict[str, DataFrame] | None = None, previous: DataFrame | None = None) -> DataFrame:
    """One nested row, the dashboard's document. All parts are bounded reports: months, cohorts, countries, stages.

    results: query results by name, for those that ran already (run_all()); others are planned here.
    previous: the document before. Its sections that no query makes are carried forward, it stands in for queries that gave
    no rows, and its cohort curve goes before the constant one.
    """
    results = results or {}
    got = lambda name, make: results[name] if name in results else make(wh, as_of)
    complete = incomplete_months(wh, as_of, monthly_dense(wh, as_of, got("monthly", H.monthly)))
    vintages = cohort_vintages(wh, as_of, got("cohorts", C.cohorts))
    arrays = []
    for s in SERIES:
        arrays.append(F.struct(_array(f"{s}_target").alias("target"), _array(f"{s}_actual").alias("actual")).alias(s))
    one = complete.agg(
        F.struct(*arrays, _array("month").alias("months")).alias("monthly"),
        F.filter(_array(F.when(F.col("nulled"), F.col("month"))), lambda m: m.isNotNull()).alias("incomplete_months"),
    )
    repaired = kpi_repaired(wh, as_of, got("kpis", H.kpis), complete)
    parts = [
        repaired.select(F.struct(*repaired.columns).alias("kpis")),
        _rows(funnel_labeled(wh, as_of, got("funnel", H.funnel)), ["stage_order"], "funnel"),
        _rows(vintages, ["month"], "cohort_vintages"),
        unit_economics(wh, as_of, vintages).select(F.struct("cohort_month", "avg_npv", "avg_ltv", "cohort_payments").alias("unit_economics")),
        _rows(got("cohort_aging", C.cohort_aging), ["cohort_month", "age_months"], "cohort_aging"),
        _rows(top_markets_flagged(wh, as_of, got("markets", M.markets)), ["merchants", "country"], "top_markets"),
        weights_map(got("country_weights", M.country_weights)),
        _rows(got("revenue_projection", H.revenue_projection), ["year"], "revenue_projection"),
        _rows(got("gtv_projection", H.gtv_projection), ["year"], "gtv_projection"),
        _rows(got("diagnostics", M.diagnostics), ["source", "period"], "diagnostics"),
        _rows(got("revenue_diag", M.revenue_diag), ["source"], "revenue_diag"),
        _rows(got("revenue_sample", M.revenue_sample), ["invoice_date", "total"], "revenue_sample"),
    ]
    for p in parts:  # single rows
        one = one.crossJoin(p)
    curve = F.array(*[F.struct(F.lit(m).alias("month"), F.lit(r).alias("retention"), F.lit(c).alias("contribution")) for m, r, c in COHORT_CURVE])
    one = one.withColumns(
        {
            "last_updated": F.lit(str(as_of.day)),
            "period": F.concat(quarter_text(H.day(as_of.day)), F.lit(f" {as_of.day.year}")),
            "data_status": F.lit("ACTUAL"),
            "cohort_curve": curve,
        }
    )
    if previous is not None:
        made, before = one.columns, {f.name: f.dataType for f in previous.schema.fields}
        stands_in = [c for c in (*STANDS_IN, "cohort_curve") if c in before and before[c].simpleString() == one.schema[c].dataType.simpleString()]
        last = previous.select(*[F.col(c).alias(f"before_{c}" if c in made else c) for c in before if c not in made or c in stands_in]).limit(1)
        one = one.join(last, F.lit(True), "left")
        for c in stands_in:
            old = F.col(f"before_{c}")
            use = F.size(old) > 0 if c == "cohort_curve" else (F.size(c) < 1) & (F.size(old) > 0)
            one = one.withColumn(c, F.when(use, old).otherwise(F.col(c)))
        one = one.select(*made, *[c for c in before if c not in made])
    return one
