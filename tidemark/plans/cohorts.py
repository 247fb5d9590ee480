"""Registration cohorts, the cohort-aging matrix, and the view of single merchants."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import merchant_key, month_diff, month_index, month_text, parsed_date, percent, ratio, rounded
from ..operators.currency import money, region_default, with_rates
from ..operators.ranking import best_by, top
from ..sources.params import AsOf
from ..sources.warehouse import Warehouse
from .headline import day

SUB_RANK = ("active first", "newest first", "least subscription id")


def billed(wh: Warehouse, rows: DataFrame) -> DataFrame:
    """Rows of customers that aren't deleted, with merchant_id. The customer's id is the join key, so it is read once from there."""
    customers = wh.customers().where("NOT deleted").select(F.col("region").alias("c_region"), F.col("customer_id").alias("c_id"))
    joined = rows.where("NOT deleted").join(customers, (F.col("customer_id") == F.col("c_id")) & (F.col("region") == F.col("c_region")))
    return joined.drop("c_region", "c_id").withColumn("merchant_id", merchant_key(F.col("customer_id")))


def revenue_rows(wh: Warehouse) -> DataFrame:
    """Invoices that count as revenue, with merchant_id and exact EUR; unknown currencies are left out."""
    rows = billed(wh, wh.invoices().where(F.col("status").isin("paid", "payment_due")))
    rows = with_rates(rows, wh.fx(), region_default(F.col("region")), "inner").where("merchant_id IS NOT NULL")
    return rows.select("merchant_id", "date", money("total", "per_cent").alias("eur"))


def merchant_states(wh: Warehouse, as_of: AsOf) -> DataFrame:
    """(merchant_id, active, paying, cancelled, mrr): a row for each merchant that is one of the three; flags are 1 or null.

    Only rows that set a flag are aggregated, as each merchant counts once and its MRR is rounded.
    """
    none = F.lit(None).cast("int")
    sales = wh.sales(since=as_of.month_before.replace(day=1)).where(F.col("month") >= as_of.active_month)
    subs = with_rates(billed(wh, wh.subscriptions()), wh.fx(), region_default(F.col("region"))).where("merchant_id IS NOT NULL")
    paying = (F.col("status") == "active") & F.col("per_cent").isNotNull()
    gone = (F.col("status") == "cancelled") & (F.col("cancelled_at") >= F.unix_seconds(day(as_of.days_30).cast("timestamp")))
    mrr = F.when(paying, money("mrr", "per_cent").cast("decimal(38,12)")).alias("mrr")
    states = subs.where(paying | gone).select("merchant_id", none.alias("active"), F.when(paying, 1).alias("paying"), F.when(gone, 1).alias("cancelled"), mrr)
    states = states.unionByName(sales.select("merchant_id", F.lit(1).alias("active")), allowMissingColumns=True)
    flags = [F.max(k).alias(k) for k in ("active", "paying", "cancelled")]
    return states.groupBy("merchant_id").agg(*flags, F.round(F.sum("mrr"), 2).cast("decimal(38,12)").alias("mrr"))


def cohort_sums(wh: Warehouse, as_of: AsOf, base: DataFrame) -> DataFrame:
    """(sm, active, paying, cancelled, mrr, gtv_30d, gtv, revenue) of each cohort with any; base: merchant_id and cohort m.

    Volume and revenue are summed by cohort alone, of which there are few, so no task holds sums of them by merchant. They
    and the states are stacked before one join with the cohorts. kind: 's' states, 'n' volume of the last 30 days, 'g' other volume, 'r' revenue.
    """
    receipts = with_rates(wh.receipts(), wh.fx())
    recent = parsed_date(F.col("receipt_date")) >= day(as_of.days_30)
    stacked = lambda df, kind, amount: df.select("merchant_id", kind.alias("kind"), amount.cast("decimal(38,12)").alias("amount"))
    rows = stacked(receipts, F.when(recent, "n").otherwise("g"), money("total_money", "per_minor"))
    rows = rows.unionByName(stacked(revenue_rows(wh), F.lit("r"), F.col("eur"))).where("amount IS NOT NULL")
    states = merchant_states(wh, as_of).withColumnRenamed("mrr", "amount").withColumn("kind", F.lit("s"))
    rows = states.unionByName(rows, allowMissingColumns=True).join(base.hint("shuffle_hash"), "merchant_id")
    total = lambda *kinds: F.sum(F.when(F.col("kind").isin(*kinds), F.col("amount"))).cast("double")
    return rows.groupBy(F.col("m").alias("sm")).agg(
        *[F.count(k).alias(k) for k in ("active", "paying", "cancelled")],
        total("s").alias("mrr"), total("n").alias("gtv_30d"), total("n", "g").alias("gtv"), total("r").alias("revenue"),
    )


def cohorts(wh: Warehouse, as_of: AsOf = AsOf()) -> DataFrame:
    """A row for each month of registration, the newest first."""
    base = wh.merchants().where("created_at IS NOT NULL").select("merchant_id", month_index(F.col("created_at")).alias("m"), "created_at")
    sizes = base.groupBy("m").agg(F.count(F.lit(1)).alias("n"), F.min("created_at").alias("first"))
    df = sizes.join(cohort_sums(wh, as_of, base.select("merchant_id", "m")), F.col("m") == F.col("sm"), "left")
    df = df.fillna(0, ["active", "paying", "cancelled", "mrr", "gtv_30d", "gtv", "revenue"])
    c = F.col
    return df.select(
        month_text(c("m")).alias("cohort_month"),
        c("n").alias("registrations"),
        c("active").alias("active_now"),
        percent(c("active"), c("n"), 1).alias("active_pct"),
        c("paying").alias("paying_now"),
        percent(c("paying"), c("n"), 2).alias("paying_pct"),
        percent(c("paying"), c("active"), 1).alias("active_to_paying_pct"),
        rounded(c("mrr"), 0).alias("cohort_mrr_eur"),
        rounded(c("mrr") * 12, 0).alias("cohort_arr_eur"),
        rounded(ratio(c("mrr"), c("paying")), 2).alias("arpc_eur"),
        rounded(c("gtv_30d") / 1000, 1).alias("gtv_30d_k_eur"),
        rounded(c("gtv") / 1e6, 2).alias("gtv_alltime_m_eur"),
        rounded(c("revenue") / 1000, 1).alias("revenue_alltime_k_eur"),
        rounded(ratio(c("revenue"), c("n")), 2).alias("npv_per_merchant_eur"),
        rounded(ratio(c("revenue"), c("paying")), 2).alias("ltv_per_paying_eur"),
        c("cancelled").alias("cancelled_30d"),
        percent(c("cancelled"), c("paying") + c("cancelled"), 1).alias("churn_rate_30d"),
        month_diff(c("first"), day(as_of.day)).alias("cohort_age_months"),
    ).orderBy(F.desc("cohort_month"))


def monthly_facts(wh: Warehouse) -> DataFrame:
    """(merchant_id, m, kind, amount): what a merchant did in month m, a row for each month of sales, invoice and receipt.

    kind: 'a' months of sales, without an amount; 'r' revenue; 'g' volume. Rows are narrow and not summed here: a merchant
    has few of a kind in one month, so a sum by both would hold about every row of a task in memory and spare none.
    """
    stacked = lambda df, m, kind, amount: df.select("merchant_id", m.alias("m"), F.lit(kind).alias("kind"), amount.cast("decimal(38,12)").alias("amount"))
    sales = stacked(wh.sale_months(), F.col("m"), "a", F.lit(None))
    invoices = stacked(revenue_rows(wh), month_index(F.timestamp_seconds("date")), "r", F.col("eur"))
    receipts = with_rates(wh.receipts(), wh.fx()).withColumn("d", parsed_date(F.col("receipt_date"))).where("d IS NOT NULL")
    return sales.unionByName(invoices).unionByName(stacked(receipts, month_index(F.col("d")), "g", money("total_money", "per_minor")))


def cohort_cells(wh: Warehouse) -> DataFrame:
    """(c, age, active, revenue, gtv) of each cohort and age at which anything happened.

    The measures are stacked before one join with the merchants' cohorts, and summed by cohort and age alone, of which
    there are few: no task holds sums by merchant. sale_months() has a row for each merchant and month, so active merchants are its rows.
    """
    base = wh.merchants().where("created_at IS NOT NULL").select("merchant_id", month_index(F.col("created_at")).alias("c"))
    rows = monthly_facts(wh).join(base.hint("shuffle_hash"), "merchant_id").withColumn("age", F.col("m") - F.col("c")).where("age >= 0")
    total = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("amount"))).cast("double"), F.lit(0.0))
    return rows.groupBy("c", "age").agg(F.count_if(F.col("kind") == "a").alias("active"), total("r").alias("revenue"), total("g").alias("gtv"))


def cohort_aging(wh: Warehouse, as_of: AsOf = AsOf(), most_age: int = 120) -> DataFrame:
    """Cohort by age in months: retention, revenue and its running sum over the ages seen, volume."""
    sizes = wh.merchants().where("created_at IS NOT NULL").groupBy(month_index(F.col("created_at")).alias("sc")).agg(F.count(F.lit(1)).alias("n"))
    df = cohort_cells(wh).where(f"age <= {most_age}").join(sizes, F.col("c") == F.col("sc"))
    running = F.sum("revenue").over(Window.partitionBy("c").orderBy("age").rowsBetween(Window.unboundedPreceding, 0))
    return df.select(
        month_text(F.col("c")).alias("cohort_month"),
        F.col("age").alias("age_months"),
        F.col("n").alias("registrations"),
        F.col("active").alias("active_merchants"),
        percent(F.col("active"), F.col("n"), 1).alias("retention_pct"),
        rounded(F.col("revenue"), 0).alias("revenue_eur"),
        rounded(running, 0).alias("cumulative_revenue_eur"),
        rounded(ratio(F.col("revenue"), F.col("active")), 2).alias("revenue_per_active_eur"),
        rounded(F.col("gtv") / 1000, 1).alias("gtv_k_eur"),
    ).orderBy(F.desc("cohort_month"), "age_months")


def best_subscriptions(wh: Warehouse, subs: DataFrame) -> DataFrame:
    """The subscription that stands for a merchant: active ones first, then the newest, then the least id."""
    keep = ["subscription_id", "status", "region", "mrr", "currency", "created_at", "cancelled_at"]
    rank = [F.when(F.col("status") == "active", 0).otherwise(1), -F.col("created_at"), F.col("subscription_id")]
    return best_by(subs.where("merchant_id IS NOT NULL"), ["merchant_id"], rank, keep)


def unified_merchant(wh: Warehouse, as_of: AsOf = AsOf(), newest: int = 1000) -> DataFrame:
    """The newest merchants with subscription, activity and volume.

    The joins are one to one, so the merchants are limited before them; their ids (`newest` of them) are
    broadcast to the facts, and no fact is shuffled but those of these merchants.
    """
    m = top(wh.merchants().where("created_at IS NOT NULL"), newest, F.desc("created_at"), F.col("merchant_id"))
    ids = F.broadcast(m.select(F.col("merchant_id").alias("wanted")))
    only = lambda df: df.join(ids, F.col("merchant_id") == F.col("wanted"), "left_semi")
    best = best_subscriptions(wh, only(billed(wh, wh.subscriptions())))
    best = with_rates(best, wh.fx())
    best = best.select(
        "merchant_id",
        "subscription_id",
        F.col("status").alias("sub_status"),
        F.col("region").alias("billing_region"),
        rounded(F.col("mrr").cast("decimal(18,0)") * F.coalesce("per_cent", F.expr("CAST('0.01' AS DECIMAL(18,12))")), 2).alias("mrr_eur"),
        F.col("currency").alias("currency_code"),
        F.col("created_at").alias("sub_created_at"),
        F.col("cancelled_at").alias("sub_cancelled_at"),
    )
    sales = only(wh.sales(since=as_of.month_before.replace(day=1)).where(F.col("month") >= as_of.active_month))
    sales = sales.groupBy("merchant_id").agg(F.max("month").alias("last_active_month"), F.sum("sales_count").alias("recent_txn_count"))
    receipts = only(wh.receipts(since=as_of.days_30).where(parsed_date(F.col("receipt_date")) >= day(as_of.days_30)))
    receipts = with_rates(receipts, wh.fx()).groupBy("merchant_id").agg(
        rounded(F.sum(money("total_money", "per_minor")), 2).alias("gtv_30d_eur"), F.count(F.lit(1)).alias("receipt_count_30d")
    )
    df = m.join(best, "merchant_id", "left").join(sales, "merchant_id", "left").join(receipts, "merchant_id", "left")
    true = lambda c: F.coalesce(c, F.lit(False))
    return df.select(
        "merchant_id",
        "merchant_uuid",
        "country",
        "email",
        F.col("created_at").alias("registered_at"),
        F.date_format("created_at", "yyyy-MM").alias("cohort_month"),
        "subscription_id",
        "sub_status",
        "billing_region",
        "mrr_eur",
        "currency_code",
        "sub_created_at",
        "sub_cancelled_at",
        F.col("last_active_month").isNotNull().alias("is_active_30d"),
        true(F.col("sub_status") == "active").alias("is_paying"),
        true((F.col("sub_status") == "cancelled") & F.col("sub_cancelled_at").isNotNull()).alias("is_churned"),
        "last_active_month",
        "recent_txn_count",
        "gtv_30d_eur",
        "receipt_count_30d",
    ).orderBy(F.desc("registered_at"), "merchant_id")
