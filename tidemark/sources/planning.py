"""Inputs that don't come from the warehouse: countries, tasks, people and actions, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .params import AsOf
from .warehouse import Warehouse


def market_countries(wh: Warehouse) -> DataFrame:
    """name, continent, served, tier, micro, small, medium, informal (million firms), digital_share, psp, source."""
    customers = wh.table("customer").groupBy(F.col("c_nationkey").alias("ck")).agg(F.count(F.lit(1)).alias("nc"))
    suppliers = wh.table("supplier").groupBy(F.col("s_nationkey").alias("sk")).agg(F.count(F.lit(1)).alias("ns"))
    k = F.col("n_nationkey")
    df = (
        wh.table("nation")
        .join(wh.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .join(customers, k == F.col("ck"), "left")
        .join(suppliers, k == F.col("sk"), "left")
    )
    nc, ns = F.coalesce("nc", F.lit(0)), F.coalesce("ns", F.lit(0))
    pick = lambda *names: F.element_at(F.array(*[F.lit(n) for n in names]), (k % 4 + 1).cast("int"))
    return df.select(
        F.col("n_name").alias("name"),
        F.col("r_name").alias("continent"),
        (k % 3 != 0).alias("served"),
        pick("HI", "UMI", "LMI", "LI").alias("tier"),
        (nc / F.lit(8.0)).alias("micro"),
        (ns / F.lit(4.0)).alias("small"),
        (ns / F.lit(64.0)).alias("medium"),
        (nc / F.lit(2.0)).alias("informal"),
        ((F.lit(20) + k * 3) / F.lit(100.0)).alias("digital_share"),
        pick("S", "P", "B", "N/A").alias("psp"),
        F.lit("derived").alias("source"),
    )


def tasks(wh: Warehouse, as_of: AsOf = AsOf()) -> DataFrame:
    """id, cadence, owner, enabled, last_run_at, next_run_at (ISO text, null where unknown)."""
    k = F.col("s_suppkey")
    names = F.array(*[F.lit(c) for c in ("daily", "weekday", "weekly-mon", "weekly-thu", "weekly-fri", "weekly-sun")])
    now = F.lit(f"{as_of.day} 00:00:00").cast("timestamp_ntz")
    hours = lambda n: F.make_dt_interval(hours=n.cast("int"))
    iso = lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    return wh.table("supplier").select(
        F.concat(F.lit("task-"), k.cast("string")).alias("id"),
        F.element_at(names, (k % 6 + 1).cast("int")).alias("cadence"),
        F.concat(F.lit("owner_"), (k % 4).cast("string")).alias("owner"),
        (k % 7 != 0).alias("enabled"),
        F.when(k % 11 != 0, iso(now - hours(k * 5 % 240))).alias("last_run_at"),
        F.when(k % 5 != 0, iso(now + hours(k * 7 % 60 - 20))).alias("next_run_at"),
    )


def people(wh: Warehouse) -> DataFrame:
    """id, name, type, reports_to, department, employment_type: four reports each, some orphans, agents among humans."""
    k = F.col("c_custkey")
    boss = F.when(k == 0, None).when(k % 37 == 0, F.lit(999999)).otherwise(F.floor((k - 1) / 4)).cast("long")
    return wh.table("customer").select(
        k.alias("id"),
        F.col("c_name").alias("name"),
        F.when(k % 5 == 0, "agent").otherwise("human").alias("type"),
        boss.alias("reports_to"),
        F.when(k % 13 != 0, F.col("c_mktsegment")).alias("department"),
        F.when(k % 3 == 0, "contractor").otherwise("employee").alias("employment_type"),
    )


def _actions(wh: Warehouse) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    names = F.array(*[F.lit(x) for x in ("payments", "pricing", "partnerships", "general")])
    status = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "P", "in-progress").otherwise("overdue")
    return wh.table("orders").select(
        k.alias("k"),
        F.concat(
            F.lit("A-"), F.date_format("o_orderdate", "yyMMdd"), F.lit("-"), F.lpad((k % 100).cast("string"), 2, "0")
        ).alias("id"),
        F.concat(F.lit("owner_"), (c % 4).cast("string")).alias("owner"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("due"),
        status.alias("status"),
        F.element_at(names, (k % 4 + 1).cast("int")).alias("initiative"),
    )


def initiatives(wh: Warehouse) -> DataFrame:
    """id, health, milestones[], actions[]: an initiative for each month of orders, so no array outgrows a month's share."""
    rows = _actions(wh).where("initiative <> 'general'").withColumn("own", F.concat_ws("-", "initiative", F.substring("due", 1, 7), (F.col("k") % 64).cast("string")))
    action = F.struct("id", "owner", "due", "status", "initiative")
    milestone = F.struct(
        F.col("id"),
        F.concat(F.lit("milestone "), F.col("id")).alias("name"),
        F.when(F.col("status") == "done", "complete").otherwise("open").alias("status"),
        F.col("due").alias("date"),
    )
    rows = rows.groupBy(F.col("own").alias("id")).agg(
        F.collect_list(F.when(F.col("k") % 10 == 0, milestone)).alias("milestones"),
        F.collect_list(action).alias("actions"),
        F.max(F.col("status") == "overdue").alias("late"),
        F.max(F.col("status") == "in-progress").alias("going"),
    )
    health = F.when(F.col("late") & ~F.col("going"), "blocked").when(F.col("late"), "at-risk").otherwise("on-track")
    return rows.select("id", health.alias("health"), "milestones", "actions")


def backlog(wh: Warehouse) -> DataFrame:
    return _actions(wh).where("initiative = 'general'").select("id", "owner", "due", "status", "initiative")
