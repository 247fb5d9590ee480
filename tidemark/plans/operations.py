"""Task health, the organisation's hierarchy, the action tracker and the plan's projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import clock_text, coded, relative_time, rounded
from ..operators.hierarchy import descendant_counts, levels, with_ancestors
from ..operators.ranking import top
from ..sources import planning
from ..sources.constants import CADENCE_HOURS, GRACE_HOURS, INITIATIVES, PLAN_REVENUE, WEEKLY_HOURS, values
from ..sources.params import AsOf
from ..sources.warehouse import Warehouse

_ISO = "yyyy-MM-dd'T'HH:mm:ss"


def task_status(wh: Warehouse, as_of: AsOf = AsOf(), tasks: DataFrame | None = None) -> DataFrame:
    """Each task with status and label; the first rule that holds decides. Times that can't be read count as unknown."""
    tasks = planning.tasks(wh, as_of) if tasks is None else tasks
    now = F.lit(f"{as_of.day} 00:00:00").cast("timestamp_ntz")
    stamp = lambda c: F.expr(f"try_to_timestamp({c}, \"{_ISO}\")").cast("timestamp_ntz")
    df = tasks.withColumns({"last_run": stamp("last_run_at"), "next_run": stamp("next_run_at")})
    hours = (F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(F.col("last_run").cast("timestamp"))) / 3600.0
    most = coded(F.col("cadence"), [(c, F.lit(h)) for c, h in CADENCE_HOURS], F.lit(WEEKLY_HOURS))
    missed = (now > F.col("next_run") + F.make_dt_interval(hours=F.lit(GRACE_HOURS))) & (F.col("last_run") < F.col("next_run"))
    label = (
        F.when(~F.col("enabled"), "Disabled")
        .when(F.col("last_run").isNull(), "Never run")
        .when(F.coalesce(missed, F.lit(False)), "Missed run")
        .when(hours > most, "Overdue")
        .otherwise("Healthy")
    )
    status = coded(F.col("label"), [("Disabled", "disabled"), ("Never run", "pending"), ("Missed run", "failed"), ("Overdue", "failed")], "healthy")
    return df.withColumn("label", label).select(
        "id",
        "cadence",
        "owner",
        "enabled",
        status.alias("status"),
        "label",
        relative_time(F.col("last_run"), now).alias("last_run_ago"),
        clock_text(F.col("next_run")).alias("next_run_text"),
    )


def task_summary(wh: Warehouse, as_of: AsOf = AsOf(), tasks: DataFrame | None = None) -> DataFrame:
    """One row of tallies; disabled tasks count as pending."""
    s = F.col("status")
    return task_status(wh, as_of, tasks).agg(
        F.count_if(s == "healthy").alias("healthy"),
        F.count_if(s == "failed").alias("failed"),
        F.count_if(~s.isin("healthy", "failed")).alias("pending"),
        F.count(F.lit(1)).alias("total"),
    )


def org_levels(wh: Warehouse, as_of: AsOf = AsOf(), people: DataFrame | None = None) -> DataFrame:
    """People of the trees with level, path and their place among siblings: humans first, then by name."""
    people = planning.people(wh) if people is None else people
    place = Window.partitionBy("reports_to").orderBy(F.when(F.col("type") == "human", 0).otherwise(1), "name", "id")
    df = levels(people).join(people, "id").withColumn("sibling", F.row_number().over(place).cast("long"))
    return df.select("id", "name", "type", "reports_to", F.col("level").cast("long").alias("level"), "path", "sibling")


def first_root(wh: Warehouse, people: DataFrame | None = None) -> DataFrame:
    """The root that is shown: the first by name."""
    people = planning.people(wh) if people is None else people
    return top(people.where("reports_to IS NULL"), 1, F.col("name"), F.col("id")).select("id", "name", "type")


def org_descendants(wh: Warehouse, as_of: AsOf = AsOf(), people: DataFrame | None = None) -> DataFrame:
    """Direct reports and all descendants of everybody."""
    people = planning.people(wh) if people is None else people
    zero = F.lit(0).cast("long")
    found = people.select("id").join(descendant_counts(people), "id", "left")
    return found.select("id", F.coalesce("direct_reports", zero).alias("direct_reports"), F.coalesce("descendants", zero).alias("descendants"))


def self_join_parent(wh: Warehouse, as_of: AsOf = AsOf(), people: DataFrame | None = None) -> DataFrame:
    """Everybody with their manager's name; the id as text where the manager doesn't exist, null for roots."""
    people = planning.people(wh) if people is None else people
    boss = people.select(F.col("id").alias("b"), F.col("name").alias("boss"))
    df = people.join(boss, F.col("reports_to") == F.col("b"), "left")
    return df.select("id", "name", F.coalesce("boss", F.col("reports_to").cast("string")).alias("manager"), (F.col("reports_to").isNotNull() & F.col("b").isNull()).alias("orphan"))


def org_filter_ancestors(wh: Warehouse, as_of: AsOf = AsOf(), kind: str = "agent", people: DataFrame | None = None) -> DataFrame:
    """People of a type and all their ancestors."""
    people = planning.people(wh) if people is None else people
    wanted = people.where(F.col("type") == kind).select("id")
    return people.join(with_ancestors(people, wanted), "id", "left_semi").select("id", "name", "type")


def org_stats(wh: Warehouse, as_of: AsOf = AsOf(), people: DataFrame | None = None) -> DataFrame:
    people = planning.people(wh) if people is None else people
    human = F.col("type") == "human"
    df = people.agg(
        F.count_if(human).alias("humans"),
        F.count_if(F.col("type") == "agent").alias("agents"),
        F.count_distinct(F.nullif(F.col("department"), F.lit(""))).alias("departments"),
        F.count_if(human & (F.col("employment_type") == "employee")).alias("e"),
    )
    return df.select("humans", "agents", "departments", F.concat_ws("/", F.col("e").cast("string"), F.col("humans").cast("string")).alias("employees"))


def action_flatten(wh: Warehouse, as_of: AsOf = AsOf(), initiatives: DataFrame | None = None, backlog: DataFrame | None = None) -> DataFrame:
    """Actions of all initiatives and of the backlog; an initiative without actions gives none."""
    initiatives = planning.initiatives(wh) if initiatives is None else initiatives
    backlog = planning.backlog(wh) if backlog is None else backlog
    nested = initiatives.select(F.inline("actions"))
    return nested.unionByName(backlog)


def action_facets(wh: Warehouse, as_of: AsOf = AsOf(), owner: str | None = "owner_1", project: str | None = None, status: str | None = None, actions: DataFrame | None = None) -> DataFrame:
    """One row: tallies after the owner and project filters but before the status filter, and how many are shown after it."""
    actions = action_flatten(wh, as_of) if actions is None else actions
    if owner:
        actions = actions.where(F.col("owner") == owner)
    if project:
        actions = actions.where(F.col("initiative") == project)
    s = F.col("status")
    shown = F.count(F.lit(1)) if status is None else F.count_if(s == status)
    return actions.agg(F.count(F.lit(1)).alias("total"), *_tallies(s), shown.alias("shown"))


def _tallies(s):
    return [F.count_if(s == k).alias(n) for k, n in (("done", "done"), ("in-progress", "in_progress"), ("overdue", "overdue"))]


def action_summary(wh: Warehouse, as_of: AsOf = AsOf(), actions: DataFrame | None = None) -> DataFrame:
    """One row: tallies and the number of sessions, the first nine characters of an id."""
    actions = action_flatten(wh, as_of) if actions is None else actions
    return actions.agg(F.count(F.lit(1)).alias("total"), *_tallies(F.col("status")), F.count_distinct(F.substring("id", 1, 9)).alias("sessions"))


def action_owner_rollup(wh: Warehouse, as_of: AsOf = AsOf(), actions: DataFrame | None = None) -> DataFrame:
    """Tallies by owner with whole percents."""
    actions = action_flatten(wh, as_of) if actions is None else actions
    df = actions.groupBy("owner").agg(F.count(F.lit(1)).alias("total"), *_tallies(F.col("status")))
    pct = lambda c: F.floor(F.lit(100.0) * F.col(c) / F.greatest("total", F.lit(1)) + 0.5).cast("long").alias(f"{c}_pct")
    return df.select("owner", "total", "done", "in_progress", "overdue", pct("done"), pct("in_progress"), pct("overdue"))


def action_rows(wh: Warehouse, as_of: AsOf = AsOf(), actions: DataFrame | None = None) -> DataFrame:
    """Actions with the labels of status and initiative."""
    actions = action_flatten(wh, as_of) if actions is None else actions
    return actions.select(
        "id",
        "owner",
        "due",
        coded(F.col("status"), [("done", "Done"), ("in-progress", "In Progress")], "Overdue").alias("status_label"),
        coded(F.col("initiative"), INITIATIVES, "Gen. Strategy").alias("initiative_label"),
    )


def milestone_progress(wh: Warehouse, as_of: AsOf = AsOf(), initiatives: DataFrame | None = None) -> DataFrame:
    """Completed of all milestones of each initiative, and its health as a level."""
    initiatives = planning.initiatives(wh) if initiatives is None else initiatives
    done = F.size(F.filter("milestones", lambda m: m["status"] == "complete"))
    return initiatives.select(
        "id",
        F.concat_ws("/", done.cast("string"), F.size("milestones").cast("string")).alias("progress"),
        coded(F.col("health"), [("blocked", "red"), ("at-risk", "amber")], "green").alias("health_level"),
    )


def projection_totals_yoy(wh: Warehouse, as_of: AsOf = AsOf()) -> DataFrame:
    """The plan's totals as stated and as summed, and the growth of the stated ones."""
    df = values(wh.spark, PLAN_REVENUE, "year, add_on, payments, new_pricing, total, stated_growth")
    df = df.selectExpr("CAST(year AS BIGINT) AS year", *[f"CAST({c} AS DOUBLE) AS {c}" for c in ("add_on", "payments", "new_pricing", "total")], "stated_growth")
    before = F.lag("total").over(Window.partitionBy().orderBy("year"))  # six constant rows
    return df.select(
        "year",
        rounded(F.col("add_on") + F.col("payments") + F.col("new_pricing"), 1).alias("summed_total"),
        F.col("total").alias("stated_total"),
        rounded((F.col("total") / before - 1) * 100, 1).alias("yoy_pct"),
        "stated_growth",
    )
