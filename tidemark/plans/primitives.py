"""Each relational primitive as a query of its own over the warehouse views."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import (
    count_text,
    merchant_key,
    month_abbr,
    month_diff,
    money_text,
    number_word,
    parsed_date,
    percent,
    percent_text,
    quarter_text,
    rounded,
    falsy,
)
from ..operators.currency import money, region_default, with_rates
from ..operators.ranking import first_by, top
from ..sources.constants import fx_rates, targets
from ..sources.params import AsOf
from ..sources.warehouse import Warehouse
from . import cohorts as C
from . import headline as H
from .headline import day

ONE = "*"


def scan_constant_fx(wh: Warehouse, as_of: AsOf) -> DataFrame:
    return fx_rates(wh.spark).select("currency", F.col("rate").cast("double").alias("rate"), F.col("minor_units").cast("long").alias("minor_units"))


def values_targets(wh: Warehouse, as_of: AsOf) -> DataFrame:
    return targets(wh.spark).select(F.col("month_num").cast("long").alias("month_num"), "revenue_target", "active_users_target")


def scan_quoted(wh: Warehouse, as_of: AsOf) -> DataFrame:
    """A regional view by its quoted name."""
    return wh.view('"BILLING-EU-SUBSCRIPTIONS"').groupBy("status").agg(F.count(ONE).alias("n"))


def project_constants(wh: Warehouse, as_of: AsOf) -> DataFrame:
    return wh.merchants().select("merchant_id", F.lit("EU").alias("region"), F.lit(0).cast("long").alias("payment_revenue"), F.lit("").alias("flag_emoji"))


def distinct_active(wh: Warehouse, as_of: AsOf) -> DataFrame:
    return wh.sales(since=as_of.month_before.replace(day=1)).where(F.col("month") >= as_of.active_month).select("merchant_id").distinct()


def filter_in_list(wh: Warehouse, as_of: AsOf) -> DataFrame:
    return wh.invoices().where(F.col("status").isin("paid", "payment_due")).groupBy("region", "status").agg(F.count(ONE).alias("n"), F.sum("total").alias("total"))


def filter_nonempty(wh: Warehouse, as_of: AsOf) -> DataFrame:
    return wh.merchants().where("country IS NOT NULL AND country <> ''").groupBy("country").agg(F.count(ONE).alias("n"))


def filter_like_year(wh: Warehouse, as_of: AsOf) -> DataFrame:
    rows = wh.sales(as_of.year_start, as_of.next_year).where(F.col("month").like(f"{as_of.day.year}%"))
    return rows.groupBy("month").agg(F.sum("sales_count").alias("sales_count"))


def filter_rolling_days(wh: Warehouse, as_of: AsOf) -> DataFrame:
    rows = wh.receipts(since=as_of.days_30).where(parsed_date(F.col("receipt_date")) >= day(as_of.days_30))
    return rows.groupBy("receipt_date").agg(F.count(ONE).alias("n"), F.sum("total_money").alias("raw"))


def filter_rolling_month(wh: Warehouse, as_of: AsOf) -> DataFrame:
    rows = wh.receipts(since=as_of.month_before).where(parsed_date(F.col("receipt_date")) >= F.add_months(day(as_of.day), -1))
    return rows.groupBy("receipt_date").agg(F.count(ONE).alias("n"))


def filter_rolling_timestamp(wh: Warehouse, as_of: AsOf) -> DataFrame:
    since = F.expr(f"TIMESTAMP '{as_of.day} 00:00:00' - INTERVAL 30 DAYS")
    rows = wh.subscriptions().where((F.col("status") == "cancelled") & (F.timestamp_seconds("cancelled_at") >= since))
    return rows.groupBy("region").agg(F.count(ONE).alias("n"))


def filter_month_string(wh: Warehouse, as_of: AsOf) -> DataFrame:
    rows = wh.sales(since=as_of.month_before.replace(day=1)).where(F.col("month") >= as_of.active_month)
    return rows.groupBy("month").agg(F.count(ONE).alias("n"), F.sum("sales_count").alias("sales_count"))


def filter_year_range(wh: Warehouse, as_of: AsOf) -> DataFrame:
    rows = wh.invoices(as_of.year_start, as_of.next_year).where(F.year(F.timestamp_seconds("date")) == as_of.day.year)
    return rows.groupBy("region").agg(F.count(ONE).alias("n"), F.sum("total").alias("total"))


def join_inner_sub_customer(wh: Warehouse, as_of: AsOf) -> DataFrame:
    return C.billed(wh, wh.subscriptions()).groupBy("region").agg(F.count(ONE).alias("n"), F.sum("mrr").alias("mrr"))


def _by_currency(rows: DataFrame, factor) -> DataFrame:
    label = F.coalesce("currency", F.lit("NULL")).alias("currency")
    return rows.groupBy(label).agg(F.count(ONE).alias("n"), rounded(F.sum(money("total_money", factor)), 2).alias("eur"))


def join_fx_inner_drop_unknown(wh: Warehouse, as_of: AsOf) -> DataFrame:
    return _by_currency(with_rates(wh.receipts(), wh.fx(), how="inner"), "per_minor")


def join_fx_left_keep_unknown(wh: Warehouse, as_of: AsOf) -> DataFrame:
    return _by_currency(with_rates(wh.receipts(), wh.fx()), "per_minor")


def join_fx_default_one(wh: Warehouse, as_of: AsOf) -> DataFrame:
    at_par = F.coalesce(F.col("per_cent"), F.expr("CAST('0.01' AS DECIMAL(18,12))"))
    return _by_currency(with_rates(wh.receipts(), wh.fx()), at_par)


def join_left_enrich(wh: Warehouse, as_of: AsOf) -> DataFrame:
    df = targets(wh.spark).join(H.monthly_active(wh, as_of), "month_num", "left")
    return df.select(F.col("month_num").cast("long").alias("month_num"), "active_users_target", "active_users_actual")


def _cells(wh: Warehouse) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Activity, revenue and volume by cohort and age, each by itself."""
    cells = {}
    base = wh.merchants().where("created_at IS NOT NULL").select("merchant_id", F.date_format("created_at", "yyyy-MM").alias("cohort"))
    sales = wh.sales().join(base, "merchant_id").where("month >= cohort")
    age = month_diff(F.to_date(F.concat("cohort", F.lit("-01"))), F.to_date(F.concat("month", F.lit("-01"))))
    cells["a"] = sales.groupBy(F.col("cohort").alias("ac"), age.alias("aa")).agg(F.count_distinct("merchant_id").alias("active"))
    rev = C.revenue_rows(wh).join(base, "merchant_id")
    rage = month_diff(F.to_date(F.concat("cohort", F.lit("-01"))), F.timestamp_seconds("date"))
    cells["r"] = rev.groupBy(F.col("cohort").alias("rc"), rage.alias("ra")).agg(F.sum("eur").cast("double").alias("revenue")).where("ra >= 0")
    gtv = with_rates(wh.receipts(), wh.fx()).withColumn("d", parsed_date(F.col("receipt_date"))).where("d IS NOT NULL").join(base, "merchant_id")
    gage = month_diff(F.to_date(F.concat("cohort", F.lit("-01"))), F.col("d"))
    gtv = gtv.groupBy(F.col("cohort").alias("gc"), gage.alias("ga")).agg(F.sum(money("total_money", "per_minor")).cast("double").alias("gtv"))
    return cells["a"], cells["r"], gtv.where("ga >= 0")


def join_full_outer_two_key(wh: Warehouse, as_of: AsOf) -> DataFrame:
    a, r, _ = _cells(wh)
    df = a.join(r, (F.col("ac") == F.col("rc")) & (F.col("aa") == F.col("ra")), "full")
    return df.select(F.coalesce("ac", "rc").alias("cohort_month"), F.coalesce("aa", "ra").alias("age_months"), "active", rounded(F.col("revenue"), 2).alias("revenue"))


def join_full_outer_coalesced(wh: Warehouse, as_of: AsOf) -> DataFrame:
    """The cells by chained full outer joins on coalesced keys, as a second form of cohort_cells()."""
    a, r, g = _cells(wh)
    df = a.join(r, (F.col("ac") == F.col("rc")) & (F.col("aa") == F.col("ra")), "full")
    df = df.withColumns({"c": F.coalesce("ac", "rc"), "age": F.coalesce("aa", "ra")})
    df = df.join(g, (F.col("c") == F.col("gc")) & (F.col("age") == F.col("ga")), "full")
    return df.select(
        F.coalesce("c", "gc").alias("cohort_month"),
        F.coalesce("age", "ga").alias("age_months"),
        F.coalesce("active", F.lit(0)).cast("long").alias("active"),
        rounded(F.coalesce("revenue", F.lit(0.0)), 2).alias("revenue"),
        rounded(F.coalesce("gtv", F.lit(0.0)), 2).alias("gtv"),
    )


def join_on_try_cast(wh: Warehouse, as_of: AsOf) -> DataFrame:
    c = wh.customers().withColumn("k", merchant_key(F.col("customer_id")))
    df = c.join(wh.merchants().select("merchant_id"), F.col("k") == F.col("merchant_id"), "left")
    return df.groupBy("region").agg(F.count(ONE).alias("customers"), F.count("merchant_id").alias("matched"), percent(F.count("merchant_id"), F.count(ONE), 2).alias("matched_pct"))


def cross_join_scalars(wh: Warehouse, as_of: AsOf) -> DataFrame:
    return wh.merchants().agg(F.count(ONE).alias("registered")).crossJoin(H.active_count(wh, as_of)).crossJoin(wh.receipts().agg(F.count(ONE).alias("receipts")))


def semi_join_active(wh: Warehouse, as_of: AsOf) -> DataFrame:
    return wh.merchants().join(distinct_active(wh, as_of), "merchant_id", "left_semi").groupBy("country").agg(F.count(ONE).alias("active_merchants"))


def agg_count_distinct_grouped(wh: Warehouse, as_of: AsOf) -> DataFrame:
    """Merchants with sales in each month. sales() lies by merchant and month already, so the distinct ids need no exchange of their own."""
    return wh.sales().groupBy("month").agg(F.count_distinct("merchant_id").alias("merchants"))


def agg_conditional_counts(wh: Warehouse, as_of: AsOf) -> DataFrame:
    paid = F.col("status") == "paid"
    return wh.invoices().groupBy("region").agg(
        F.count_if(paid).alias("paid"), F.sum(F.when(paid, F.col("total")).otherwise(0)).alias("paid_total"), F.count_if(F.col("currency").isNull()).alias("no_currency")
    )


def agg_two_phase_regions(wh: Warehouse, as_of: AsOf) -> DataFrame:
    """Regions aggregated by themselves and summed; Spark's own partial aggregate does the same in one step."""
    parts = None
    for region in ("EU", "UK"):
        rows = wh.invoices().where((F.col("region") == region) & F.col("status").isin("paid", "payment_due") & ~F.col("deleted"))
        rows = with_rates(rows, wh.fx(), region_default(F.lit(region)), "inner")
        part = rows.groupBy(F.month(F.timestamp_seconds("date")).alias("month_num")).agg(F.sum(money("total", "per_cent")).alias("part"))
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy(F.col("month_num").cast("long").alias("month_num")).agg(rounded(F.sum("part"), 2).alias("revenue"))


def agg_mixed_distinct_sum(wh: Warehouse, as_of: AsOf) -> DataFrame:
    df = with_rates(wh.receipts(), wh.fx()).join(wh.merchants().select("merchant_id", "country"), "merchant_id")
    return df.groupBy("country").agg(rounded(F.sum(money("total_money", "per_minor")), 2).alias("eur"), F.count_distinct("merchant_id").alias("merchants"))


def agg_ratio_guarded(wh: Warehouse, as_of: AsOf) -> DataFrame:
    n_void, n = F.count_if(F.col("status") == "voided"), F.count_if(F.col("status") == "refunded")
    return wh.invoices().groupBy("region").agg(percent(n_void, F.count(ONE), 2).alias("voided_pct"), percent(n_void, n, 2).alias("per_refund"))


def agg_percent_total(wh: Warehouse, as_of: AsOf) -> DataFrame:
    df = wh.subscriptions().groupBy("status").agg(F.count(ONE).alias("n"))
    return df.select("status", percent(F.col("n"), F.sum("n").over(Window.partitionBy()), 2).alias("pct"))  # three rows


def agg_group_expr(wh: Warehouse, as_of: AsOf) -> DataFrame:
    rows = wh.receipts().withColumn("d", parsed_date(F.col("receipt_date")))
    return rows.groupBy(F.year("d").cast("long").alias("year"), F.month("d").cast("long").alias("month_num")).agg(F.count(ONE).alias("n"))


def agg_min_max_dates(wh: Warehouse, as_of: AsOf) -> DataFrame:
    stamp = lambda c: F.timestamp_seconds(c).cast("timestamp_ntz")
    return wh.invoices().groupBy("region").agg(stamp(F.min("date")).alias("first"), stamp(F.max("date")).alias("last"))


def agg_max_month(wh: Warehouse, as_of: AsOf) -> DataFrame:
    return wh.sales().groupBy("merchant_id").agg(F.max("month").alias("last_month"), F.sum("sales_count").alias("sales_count"))


def window_best_subscription(wh: Warehouse, as_of: AsOf) -> DataFrame:
    subs = C.billed(wh, wh.subscriptions()).where("merchant_id IS NOT NULL")
    order = [F.when(F.col("status") == "active", 0).otherwise(1).asc(), F.desc("created_at"), F.col("subscription_id").asc()]
    return first_by(subs, ["merchant_id"], order).select("merchant_id", "subscription_id", "status", "region")


def window_running_revenue(wh: Warehouse, as_of: AsOf) -> DataFrame:
    df = C.revenue_rows(wh).groupBy(F.date_format(F.timestamp_seconds("date"), "yyyy-MM").alias("month")).agg(F.sum("eur").alias("eur"))
    year = F.substring("month", 1, 4)
    running = F.sum("eur").over(Window.partitionBy(year).orderBy("month").rowsBetween(Window.unboundedPreceding, 0))
    return df.select("month", rounded(F.col("eur"), 2).alias("revenue"), rounded(running, 2).alias("running"))


def topk_newest(wh: Warehouse, as_of: AsOf) -> DataFrame:
    return top(wh.merchants().where("created_at IS NOT NULL").select("merchant_id", "created_at"), 1000, F.desc("created_at"), F.col("merchant_id"))


def union_hetero(wh: Warehouse, as_of: AsOf) -> DataFrame:
    """Relations of different types stacked under one schema."""
    a = wh.merchants().agg(F.count(ONE).alias("v")).select(F.lit("merchants").alias("source"), F.lit(None).cast("double").alias("rate"), "v")
    b = wh.subscriptions().agg(F.count(ONE).alias("v")).select(F.lit("subscriptions").alias("source"), F.lit(0.5).alias("rate"), "v")
    return a.unionByName(b)


def fn_decode_month(wh: Warehouse, as_of: AsOf) -> DataFrame:
    return wh.spark.range(1, 13, 1, 1).select(F.col("id").alias("month_num"), month_abbr(F.col("id")).alias("month_abbr"))


def fn_try_casts(wh: Warehouse, as_of: AsOf) -> DataFrame:
    return wh.customers().select("customer_id", merchant_key(F.col("customer_id")).alias("merchant_id"))


def fn_month_boundary_diff(wh: Warehouse, as_of: AsOf) -> DataFrame:
    m = wh.merchants().where("created_at IS NOT NULL")
    return m.select("merchant_id", month_diff(F.col("created_at"), day(as_of.day)).alias("months"))


def fn_epoch_parts(wh: Warehouse, as_of: AsOf) -> DataFrame:
    t = F.timestamp_seconds("created_at")
    rows = wh.subscriptions()
    return rows.groupBy(F.year(t).cast("long").alias("year"), F.month(t).cast("long").alias("month_num"), F.date_format(t, "yyyy-MM").alias("month")).agg(F.count(ONE).alias("n"))


def fn_churn_compound(wh: Warehouse, as_of: AsOf) -> DataFrame:
    df = wh.subscriptions().groupBy("region").agg(F.count_if(F.col("status") == "cancelled").alias("c"), F.count_if(F.col("status") == "active").alias("a"))
    r = F.try_divide(F.col("c").cast("double"), (F.col("a") + F.col("c")).cast("double")) / 12
    return df.select("region", rounded(r * 100, 1).alias("monthly_churn"), rounded((1 - F.pow(1 - r, F.lit(12))) * 100, 0).alias("annual_churn"))


def fn_magnitude_format(wh: Warehouse, as_of: AsOf) -> DataFrame:
    """Sums of volume by currency in all three formats."""
    v = F.col("raw") / 1e9
    df = wh.receipts().groupBy(F.coalesce("currency", F.lit("NULL")).alias("currency")).agg(F.sum("total_money").cast("double").alias("raw"))
    return df.select("currency", money_text(v).alias("money"), count_text(v * 10).alias("count"), percent_text(v / 100).alias("pct"))


def fn_quarter_label(wh: Warehouse, as_of: AsOf) -> DataFrame:
    m = wh.merchants().where("created_at IS NOT NULL")
    return m.groupBy(quarter_text(F.col("created_at")).alias("quarter")).agg(F.count(ONE).alias("n"))


def fn_number_word(wh: Warehouse, as_of: AsOf) -> DataFrame:
    return wh.spark.range(0, 15, 1, 1).select(F.col("id").alias("n"), number_word(F.col("id")).alias("word"))


def fn_falsy_coalesce(wh: Warehouse, as_of: AsOf) -> DataFrame:
    k = F.col("merchant_id")
    x = F.when(k % 3 == 0, 0).when(k % 3 == 1, k).cast("long")
    return wh.merchants().select("merchant_id", falsy(x, F.lit(7).cast("long")).alias("falsy"), F.coalesce(x, F.lit(7).cast("long")).alias("nullish"))


PRIMITIVES = (
    scan_constant_fx,
    values_targets,
    scan_quoted,
    project_constants,
    distinct_active,
    filter_in_list,
    filter_nonempty,
    filter_like_year,
    filter_rolling_days,
    filter_rolling_month,
    filter_rolling_timestamp,
    filter_month_string,
    filter_year_range,
    join_inner_sub_customer,
    join_fx_inner_drop_unknown,
    join_fx_left_keep_unknown,
    join_fx_default_one,
    join_left_enrich,
    join_full_outer_two_key,
    join_full_outer_coalesced,
    join_on_try_cast,
    cross_join_scalars,
    semi_join_active,
    agg_count_distinct_grouped,
    agg_conditional_counts,
    agg_two_phase_regions,
    agg_mixed_distinct_sum,
    agg_ratio_guarded,
    agg_percent_total,
    agg_group_expr,
    agg_min_max_dates,
    agg_max_month,
    window_best_subscription,
    window_running_revenue,
    topk_newest,
    union_hetero,
    fn_decode_month,
    fn_try_casts,
    fn_month_boundary_diff,
    fn_epoch_parts,
    fn_churn_compound,
    fn_magnitude_format,
    fn_quarter_label,
    fn_number_word,
    fn_falsy_coalesce,
)
