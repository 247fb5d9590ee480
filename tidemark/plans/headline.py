"""Headline figures: KPIs, months against targets, the funnel, projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import month_abbr, parsed_date, percent, ratio, rounded
from ..operators.currency import money, region_default, with_rates
from ..operators.distinct import exact_distinct
from ..sources.constants import FUNNEL, GTV_PROJECTION, REVENUE_PROJECTION, targets, values
from ..sources.params import AsOf
from ..sources.warehouse import Warehouse


def day(d) -> F.Column:
    return F.lit(str(d)).cast("date")


def active_count(wh: Warehouse, as_of: AsOf) -> DataFrame:
    """One row: merchants with sales since the start of the previous calendar month."""
    sales = wh.sales(since=as_of.month_before.replace(day=1)).where(F.col("month") >= as_of.active_month)
    return exact_distinct(sales, [], "merchant_id", "active")


def subscription_totals(wh: Warehouse, as_of: AsOf) -> DataFrame:
    """One row from one scan: active and recently cancelled subscriptions, those paying in a known currency and their MRR."""
    subs = with_rates(wh.subscriptions().where("NOT deleted"), wh.fx(), region_default(F.col("region")))
    active = F.col("status") == "active"
    since = F.unix_seconds(day(as_of.days_30).cast("timestamp"))
    gone = (F.col("status") == "cancelled") & (F.col("cancelled_at") >= since)
    return subs.agg(
        F.count_if(active & F.col("per_cent").isNotNull()).alias("paying"),
        F.coalesce(F.sum(F.when(active, money("mrr", "per_cent"))).cast("double"), F.lit(0.0)).alias("mrr"),
        F.count_if(active).alias("active_subs"),
        F.count_if(gone).alias("cancelled"),
    )


def gtv_total(wh: Warehouse, as_of: AsOf) -> DataFrame:
    rows = wh.receipts(since=as_of.month_before).where(parsed_date(F.col("receipt_date")) >= day(as_of.month_before))
    rows = with_rates(rows, wh.fx())
    return rows.agg(F.coalesce(F.sum(money("total_money", "per_minor")).cast("double"), F.lit(0.0)).alias("gtv"))


def kpis(wh: Warehouse, as_of: AsOf = AsOf()) -> DataFrame:
    """One row; its sources are single rows, so the cross joins multiply nothing."""
    registered = wh.merchants().agg(F.count(F.lit(1)).alias("registered"))
    one = registered.crossJoin(active_count(wh, as_of)).crossJoin(subscription_totals(wh, as_of)).crossJoin(gtv_total(wh, as_of))
    churn = ratio(F.col("cancelled"), F.col("active_subs") + F.col("cancelled"))
    zero = F.lit(0).cast("long")
    return one.select(
        rounded(F.col("mrr") * 12 / 1e6, 2).alias("total_revenue"),
        zero.alias("payment_revenue"),
        F.coalesce(rounded(ratio(F.col("mrr"), F.col("paying")), 2), F.lit(0.0)).alias("arpc"),
        F.col("active").alias("active_users"),
        rounded(F.col("gtv") / 1e6, 1).alias("total_gtv"),
        zero.alias("attach_rate"),
        zero.alias("take_rate"),
        zero.alias("gtv_processed"),
        F.coalesce(rounded(churn * 100, 1), F.lit(2.1)).alias("monthly_churn"),
        F.coalesce(rounded((1 - F.pow(1 - churn, F.lit(12))) * 100, 0), F.lit(22.0)).alias("annual_churn"),
        F.lit(104).cast("long").alias("nrr"),
        "registered",
        "paying",
        zero.alias("payments_enabled"),
        F.lit(68).cast("long").alias("gross_margin"),
    )


def monthly_revenue(wh: Warehouse, as_of: AsOf) -> DataFrame:
    """month_num, revenue_actual: invoices of the year, both regions in one scan and one aggregate."""
    start, stop = (F.unix_seconds(day(d).cast("timestamp")) for d in (as_of.year_start, as_of.next_year))
    rows = wh.invoices(since=as_of.year_start, until=as_of.next_year)
    rows = rows.where(F.col("status").isin("paid", "payment_due") & ~F.col("deleted") & (F.col("date") >= start) & (F.col("date") < stop))
    rows = with_rates(rows, wh.fx(), region_default(F.col("region")), "inner")
    return rows.groupBy(F.month(F.timestamp_seconds("date")).alias("month_num")).agg(
        rounded(F.sum(money("total", "per_cent")).cast("double") / 1e6, 3).alias("revenue_actual")
    )


def monthly_active(wh: Warehouse, as_of: AsOf) -> DataFrame:
    rows = wh.sales(as_of.year_start, as_of.next_year).where(F.col("month").startswith(str(as_of.day.year)))
    # One row a merchant and month of one year, so all are distinct.
    return rows.groupBy(F.substring("month", 6, 2).cast("int").alias("month_num")).agg(F.count("merchant_id").alias("active_users_actual"))


def monthly_gtv(wh: Warehouse, as_of: AsOf) -> DataFrame:
    when = parsed_date(F.col("receipt_date"))
    rows = wh.receipts(as_of.year_start, as_of.next_year).where((when >= day(as_of.year_start)) & (when < day(as_of.next_year)))
    return (
        with_rates(rows, wh.fx())
        .groupBy(F.month(when).alias("month_num"))
        .agg(rounded(F.sum(money("total_money", "per_minor")).cast("double") / 1e6, 1).alias("gtv_actual"))
    )


def monthly(wh: Warehouse, as_of: AsOf = AsOf()) -> DataFrame:
    """The twelve months of the year: actuals, where there are any, and targets."""
    df = targets(wh.spark)
    for part in (monthly_revenue(wh, as_of), monthly_active(wh, as_of), monthly_gtv(wh, as_of)):
        df = df.join(part, "month_num", "left")
    zero = F.lit(0).cast("long")
    return df.select(
        F.col("month_num").cast("long").alias("month_num"),
        month_abbr(F.col("month_num")).alias("month_abbr"),
        "revenue_actual",
        "revenue_target",
        *[zero.alias(c) for c in ("payment_revenue_actual", "payment_revenue_target", "arpc_actual", "arpc_target")],
        "active_users_actual",
        "active_users_target",
        "gtv_actual",
        zero.alias("gtv_target"),
    ).orderBy("month_num")


def funnel(wh: Warehouse, as_of: AsOf = AsOf()) -> DataFrame:
    """Four stages; subscriptions in unknown currencies count as paying here, other than in kpis."""
    one = wh.merchants().agg(F.count(F.lit(1)).alias("registered")).crossJoin(active_count(wh, as_of))
    one = one.crossJoin(wh.subscriptions().where("status = 'active' AND NOT deleted").agg(F.count(F.lit(1)).alias("paying")))
    none = F.lit(None).cast("double")
    counts = {"registered": F.col("registered"), "active": F.col("active"), "paying": F.col("paying"), "payments_enabled": F.lit(0)}
    rates = {
        "registered": none,
        "active": percent(F.col("active"), F.col("registered"), 1),
        "paying": percent(F.col("paying"), F.col("active"), 1),
        "payments_enabled": F.lit(0.0),
    }
    rows = F.array(
        *[
            F.struct(
                F.lit(stage).alias("stage"),
                counts[stage].cast("long").alias("current_value"),
                F.lit(goal).cast("long").alias("target"),
                rates[stage].alias("conversion_rate"),
                F.lit(i + 1).cast("long").alias("stage_order"),
            )
            for i, (stage, goal, _, _) in enumerate(FUNNEL)
        ]
    )
    return one.select(F.inline(rows)).orderBy("stage_order")


def revenue_projection(wh: Warehouse, as_of: AsOf = AsOf()) -> DataFrame:
    names = ("addon_revenue", "payment_revenue", "new_pricing_revenue")
    df = values(wh.spark, REVENUE_PROJECTION, ", ".join(("year", *names)))
    return df.select(F.col("year").cast("long").alias("year"), *[F.col(n).cast("double").alias(n) for n in names]).orderBy("year")


def gtv_projection(wh: Warehouse, as_of: AsOf = AsOf()) -> DataFrame:
    df = values(wh.spark, GTV_PROJECTION, "year, gtv_billions")
    return df.selectExpr("CAST(year AS BIGINT) AS year", "CAST(gtv_billions AS DOUBLE) AS gtv_billions").orderBy("year")
