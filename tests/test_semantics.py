"""What an oracle can't judge: policies, ties, folds, trees, formats, containment, empty inputs, and plans."""

import json
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.functions import exprs as X
from tidemark.operators import currency, distinct, folds, hierarchy, ranking
from tidemark.plans import cohorts, headline, market_model, markets, operations, postprocess, report
from tidemark.registry import PULL, queries, run_all
from tidemark.sources import catalog, sinks
from tidemark.sources.constants import COHORT_CURVE, FLAGGED, fx_rates
from tidemark.sources.facts import BucketedWarehouse, write_bucketed
from tidemark.sources.params import AsOf
from tidemark.sources.versions import Versions
from tidemark.sources.warehouse import SchemaMismatch, Warehouse, checked


@pytest.fixture(scope="session")
def wh(spark, small):
    return Warehouse(spark, small)


def one(df, col):
    return df.select(col.alias("x")).first().x


@pytest.fixture(scope="session")
def dot(spark):
    return spark.range(1)


@pytest.mark.parametrize(
    "values, want",
    [
        ([100.0, 90.0, 60.0, 50.0, 49.0], [100.0, 90.0, None, 50.0, 49.0]),
        ([100.0, None, 10.0], [100.0, None, 10.0]),
        ([0.0, 5.0, 3.75, 2.8], [0.0, 5.0, 3.75, None]),
        ([], []),
        ([100.0, 70.0, 10.0, 8.0, 1.0], [100.0, None, 10.0, 8.0, None]),
    ],
)
def test_surviving_months(spark, values, want):
    df = spark.createDataFrame([(values,)], "v array<double>")
    assert one(df, folds.surviving(F.col("v"))) == want
    assert one(df, folds.last_present(folds.surviving(F.col("v")))) == next((x for x in reversed(want) if x is not None), None)


def test_incomplete_month_nulls_every_series(spark, wh):
    active = [100, 90, 60, 50, 49, 48, 47, None, None, None, None, None]
    rows = [(i + 1, 1.0, 2.0, 0, 0, 0, 0, v, 10, 3.0, 0) for i, v in enumerate(active)]
    names = "month_num long, revenue_actual double, revenue_target double, payment_revenue_actual long, payment_revenue_target long, arpc_actual long, arpc_target long,"
    df = spark.createDataFrame(rows, names + " active_users_actual long, active_users_target long, gtv_actual double, gtv_target long")
    out = postprocess.incomplete_months(wh, AsOf(), postprocess.monthly_dense(wh, AsOf(), df)).orderBy("month_num").collect()
    assert [r.month for r in out if r.nulled] == ["Mar"]
    assert [r.revenue_actual for r in out] == [1.0, 1.0, None, 1.0, 1.0, 1.0] + [None] * 6
    assert all(r.revenue_target == 2.0 for r in out)


def test_month_boundaries(spark):
    rows = [(date(2001, 1, 31), date(2001, 2, 1), 1), (date(2001, 2, 1), date(2001, 2, 28), 0), (date(2000, 12, 31), date(2001, 1, 1), 1), (date(2001, 2, 1), date(2001, 1, 31), -1)]
    df = spark.createDataFrame(rows, "a date, b date, want int")
    assert all(r.got == r.want for r in df.withColumn("got", X.month_diff(F.col("a"), F.col("b"))).collect())
    months = spark.createDataFrame([("1999-12",), ("2000-01",), ("2001-07",)], "m string")
    assert all(r.m == r.back for r in months.withColumn("back", X.month_text(X.month_text_index(F.col("m")))).collect())


def test_as_of_windows():
    assert AsOf(date(2001, 3, 31)).month_before == date(2001, 2, 28)
    assert AsOf(date(2001, 1, 15)).month_before == date(2000, 12, 15)
    assert AsOf(date(2001, 1, 15)).active_month == "2000-12"


def test_unknown_currency_policies(spark, wh):
    rows = [("EUR", 1000), (None, 1000), ("XXX", 1000), ("JPY", 1000)]
    df = spark.createDataFrame(rows, "currency string, total_money long")
    left = {r.currency: r.e for r in currency.with_rates(df, wh.fx()).select("currency", currency.money("total_money", "per_minor").cast("double").alias("e")).collect()}
    assert left == {"EUR": 10.0, None: 10.0, "XXX": None, "JPY": pytest.approx(5.405)}
    assert currency.with_rates(df, wh.fx(), how="inner").count() == 3
    uk = currency.with_rates(df, wh.fx(), currency.region_default(F.lit("UK")))
    assert uk.where("currency IS NULL").first().rate == fx_rates(spark).where("currency = 'GBP'").first().rate


def test_falsy_and_nullish(spark):
    df = spark.createDataFrame([(0,), (None,), (5,)], "x long")
    assert [r[0] for r in df.select(X.falsy(F.col("x"), F.lit(7).cast("long"))).collect()] == [7, 7, 5]
    assert [r[0] for r in df.select(X.falsy(F.col("x"), F.lit(0).cast("long"), F.lit(9).cast("long"))).collect()] == [9, 9, 5]
    text = spark.createDataFrame([("",), ("a",)], "x string")
    assert [r[0] for r in text.select(X.falsy(F.col("x"), F.lit("d"))).collect()] == ["d", "a"]


@pytest.mark.parametrize("v, money, count", [(1234.0, "$1.2T", "1.2B"), (12.34, "$12.3B", "12.3M"), (0.5, "$500M", "500.0K"), (0.0004, "$400K", "0.000M"), (0.0, "$0K", "0"), (None, "—", None), (-2.0, "$-2.0B", "-2.000M")])
def test_magnitudes(spark, v, money, count):
    df = spark.createDataFrame([(v,)], "v double")
    assert one(df, X.money_text(F.col("v"))) == money
    assert one(df, X.count_text(F.col("v"))) == count


def test_times_and_flags(spark):
    now = F.lit("2001-07-15 12:00:00").cast("timestamp_ntz")
    rows = [("2001-07-15 11:59:30", "Just now"), ("2001-07-15 11:30:00", "30m ago"), ("2001-07-15 01:00:00", "11h ago"), ("2001-07-14 01:00:00", "Yesterday"), ("2001-07-10 01:00:00", "5d ago"), (None, "Never")]
    df = spark.createDataFrame(rows, "t string, want string").withColumn("got", X.relative_time(F.col("t").cast("timestamp_ntz"), now))
    assert all(r.got == r.want for r in df.collect())
    rows = [("2001-07-15 00:05:00", "Sun 0:05AM"), ("2001-07-15 12:00:00", "Sun 12:00PM"), ("2001-07-16 15:09:00", "Mon 3:09PM"), (None, "—")]
    df = spark.createDataFrame(rows, "t string, want string").withColumn("got", X.clock_text(F.col("t").cast("timestamp_ntz")))
    assert all(r.got == r.want for r in df.collect())
    df = spark.createDataFrame([("ES",), ("GB",), ("NATION_1",), (None,)], "c string")
    assert [r[0] for r in df.select(X.flag(F.col("c"), FLAGGED)).collect()] == ["🇪🇸", "🇬🇧", "", ""]


def test_best_subscription_ties_and_both_forms(spark, wh):
    rows = [(1, 9, "active", 5), (1, 8, "active", 5), (1, 7, "cancelled", 9), (2, 3, "cancelled", 1), (2, 4, "cancelled", 2)]
    df = spark.createDataFrame(rows, "merchant_id long, subscription_id long, status string, created_at long")
    for c in ("region", "mrr", "currency", "cancelled_at"):
        df = df.withColumn(c, F.lit(None).cast("string" if c in ("region", "currency") else "long"))
    want = {1: 8, 2: 4}
    assert {r.merchant_id: r.subscription_id for r in cohorts.best_subscriptions(wh, df).collect()} == want
    order = [F.when(F.col("status") == "active", 0).otherwise(1).asc(), F.desc("created_at"), F.col("subscription_id").asc()]
    assert {r.merchant_id: r.subscription_id for r in ranking.first_by(df, ["merchant_id"], order).collect()} == want


PEOPLE = "id long, name string, type string, reports_to long, department string, employment_type string"


def test_trees(spark, wh):
    rows = [
        (1, "b", "human", None, "x", "employee"),
        (2, "a", "human", None, "", "contractor"),
        (3, "c", "agent", 1, None, None),
        (4, "d", "human", 1, "x", "employee"),
        (5, "e", "human", 4, "y", None),
        (6, "f", "agent", 5, "x", None),
        (7, "o", "human", 99, "x", None),
    ]
    people = spark.createDataFrame(rows, PEOPLE)
    lev = {r.id: r for r in operations.org_levels(wh, people=people).collect()}
    assert set(lev) == {1, 2, 3, 4, 5, 6} and lev[6].path == "1/4/5/6" and lev[4].sibling == 1 and lev[3].sibling == 2
    assert {r.id: r.descendants for r in operations.org_descendants(wh, people=people).collect()} == {1: 4, 2: 0, 3: 0, 4: 2, 5: 1, 6: 0, 7: 0}
    assert {r.id for r in operations.org_filter_ancestors(wh, people=people).collect()} == {3, 1, 6, 5, 4}
    assert operations.first_root(wh, people).first().id == 2
    assert operations.org_stats(wh, people=people).first().asDict() == {"humans": 5, "agents": 2, "departments": 2, "employees": "2/5"}
    loop = spark.createDataFrame([(1, "a", "human", 2, None, None), (2, "b", "human", 1, None, None)], PEOPLE)
    assert hierarchy.closure(loop, depth=6).agg(F.max("distance")).first()[0] == 6
    assert hierarchy.levels(loop).count() == 0


def test_deep_trees_are_not_cut_and_cycles_end(spark, wh):
    n = 56
    chain = [(i, f"p{i:02}", "human", i - 1 if i else None, None, None) for i in range(n)]
    # 900 and 901 report to each other, 902 to one of them, 903 to itself.
    loops = [(i, f"p{i}", "human", boss, None, None) for i, boss in ((900, 901), (901, 900), (902, 900), (903, 903))]
    people = spark.createDataFrame(chain + loops, PEOPLE).coalesce(1)
    assert {r.id: r.level for r in hierarchy.levels(people).collect()} == {i: i for i in range(n)}
    pairs = {(r.descendant, r.ancestor) for r in hierarchy.closure(people).collect()}
    want = {(i, j) for i in range(n) for j in range(i)}
    assert pairs == want | {(900, 901), (900, 900), (901, 900), (901, 901), (902, 900), (902, 901), (903, 903)}


def test_status_ladder(spark, wh):
    at = "2001-07-1{}T{:02d}:00:00"
    rows = [
        ("off", "daily", False, None, None, "Disabled"),
        ("never", "daily", True, None, None, "Never run"),
        ("missed", "daily", True, at.format(4, 1), at.format(4, 21), "Missed run"),
        ("grace", "daily", True, at.format(4, 1), at.format(4, 22), "Healthy"),
        ("ran", "daily", True, at.format(4, 21), at.format(4, 21), "Healthy"),
        ("26", "daily", True, at.format(3, 22), None, "Healthy"),
        ("27", "daily", True, at.format(3, 21), None, "Overdue"),
        ("74", "weekday", True, at.format(1, 22), None, "Healthy"),
        ("75", "weekday", True, at.format(1, 21), None, "Overdue"),
        ("170", "odd", True, "2001-07-07T22:00:00", None, "Healthy"),
        ("171", "weekly-sun", True, "2001-07-07T21:00:00", None, "Overdue"),
        ("bad", "daily", True, "soon", None, "Never run"),
    ]
    df = spark.createDataFrame([(i, c, "o", e, a, b) for i, c, e, a, b, _ in rows], "id string, cadence string, owner string, enabled boolean, last_run_at string, next_run_at string")
    got = {r.id: r.label for r in operations.task_status(wh, tasks=df).collect()}
    assert got == {i: w for i, *_, w in rows}
    assert operations.task_summary(wh, tasks=df).first().pending == 3


def test_kpi_repair_and_defaults(spark, wh):
    kpis = spark.createDataFrame(
        [(8.0, 0, 1.0, 70, 0.0, 0.0, 0.0, 0, 0, 100, 5, 0)],
        "total_revenue double, payment_revenue long, arpc double, active_users long, total_gtv double, monthly_churn double, annual_churn double, nrr long, gross_margin long, registered long, paying long, payments_enabled long",
    )
    months = spark.createDataFrame([(1, 90.0), (2, 100.0), (3, None)], "month_num long, active_users_actual double")
    r = postprocess.kpi_repaired(wh, AsOf(), kpis, months).first()
    assert (r.active_users, r.monthly_churn, r.annual_churn, r.nrr, r.gross_margin, r.total_gtv) == (100.0, 2.1, 22.0, 104, 68, 25.8)
    assert r.total_revenue_delta == "+5.3%"
    fall = {x.key: x.conv_rate for x in postprocess.funnel_fallback(postprocess.kpi_repaired(wh, AsOf(), kpis, months)).collect()}
    assert fall == {"registered": None, "active": "100.0%", "paying": "5.0%", "paymentsEnabled": "3.0%"}


def test_vintages_fall_back(spark, wh):
    none = cohorts.cohorts(wh).where("false")
    rows = postprocess.cohort_vintages(wh, AsOf(), none)
    assert rows.count() == 6
    assert postprocess.unit_economics(wh, AsOf(), rows).first().cohort_payments == 144.0
    assert postprocess.unit_economics(wh, AsOf(), rows, latest="newest").first().cohort_month == "2025-07"


def test_market_filters_and_sort(spark, wh):
    t = market_model.market_country_table
    assert {r.psp for r in t(wh, psp=["S", "B"]).collect()} == {"S", "B"}
    assert all(r.served for r in t(wh, served=True).collect())
    assert {r.name for r in t(wh, contains="nation_2").collect()} >= {"NATION_2", "NATION_20"}
    got = [r.tam_rev for r in t(wh).collect()]
    assert got == sorted(got, reverse=True)
    both = market_model.market_rows(wh, scenario="e")
    assert both.where("informal_firms > 0").count() > 0
    assert market_model.market_export(wh, scenario="e").where("`Informal SMBs` <> ''").count() == both.count()


def test_cohort_cells_agree_with_full_outer_joins(spark, small, wh):
    from tidemark.plans.primitives import join_full_outer_coalesced

    a = cohorts.cohort_cells(wh).select(X.month_text(F.col("c")).alias("cohort_month"), F.col("age").alias("age_months"), "active", X.rounded(F.col("revenue"), 2).alias("revenue"), X.rounded(F.col("gtv"), 2).alias("gtv"))
    b = join_full_outer_coalesced(wh, AsOf())
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_schema_contract(spark):
    with pytest.raises(SchemaMismatch):
        checked("customers", spark.range(1))


def test_empty_inputs(spark, wh, tmp_path):
    for t in ("customer", "nation", "orders", "lineitem", "region", "supplier"):
        wh.table(t).where("false").write.parquet(str(tmp_path / f"{t}.parquet"))
    none = Warehouse(spark, str(tmp_path))
    k = headline.kpis(none).first()
    assert (k.registered, k.paying, k.arpc, k.monthly_churn, k.total_gtv) == (0, 0, 0.0, 2.1, 0.0)
    assert headline.monthly(none).count() == 12 and cohorts.cohort_aging(none).count() == 0 and cohorts.unified_merchant(none).count() == 0
    assert [r.conversion_rate for r in headline.funnel(none).collect()] == [None, None, None, 0.0]
    assert postprocess.cohort_vintages(none).count() == 6


def test_failed_queries_are_contained(spark, tmp_path, wh):
    wh.table("customer").write.parquet(str(tmp_path / "customer.parquet"))
    out = run_all(spark, str(tmp_path), ["kpis", "revenue_projection"])
    assert out["kpis"].count() == 0 and out["revenue_projection"].count() == 6
    assert len(PULL) == 14


def test_document_sinks_and_carry_forward(spark, small, wh, tmp_path):
    path = str(tmp_path / "doc")
    before = spark.createDataFrame([("kept", "x")], "reviews string, period string")
    doc = postprocess.dashboard_document(wh, AsOf(), previous=before)
    sinks.write_document(doc, path)
    row = json.loads(spark.read.text(path).first()[0])
    assert row["reviews"] == "kept" and row["period"] == "Q3 2001" and len(row["monthly"]["revenue"]["actual"]) == 12 and len(row["funnel"]) == 4
    assert sinks.read_document(spark, path, "reviews string").first().reviews == "kept"
    assert sinks.read_document(spark, str(tmp_path / "none"), "reviews string").count() == 0


def test_versions_are_published_whole_and_broken_ones_passed_over(spark, tmp_path):
    store = Versions(spark, str(tmp_path / "docs"))
    assert store.latest() is None and store.published() == []
    doc = lambda **v: spark.createDataFrame([tuple(v.values())], list(v))
    assert [store.publish(doc(reviews="a", n=k)) for k in (1, 2)] == [1, 2]
    assert store.latest().first().asDict() == {"reviews": "a", "n": 2}
    # A run that dies before its marker is not read, and its number is not used again.
    assert store._create("claimed/3") and store.latest().first().n == 2
    sinks.write_document(doc(reviews="half", n=3), store.path(3))
    assert store.latest().first().n == 2 and store.publish(doc(reviews="b", n=4)) == 4 and store.latest().first().n == 4
    broken = [tmp_path / "docs" / "versions" / str(k) for k in (4, 2)]
    for path, text in zip(broken, ('{"reviews": "b", "n"', "")):
        for part in path.glob("part*"):
            part.write_text(text)
        for crc in path.glob(".part*"):
            crc.unlink()
    assert store.latest().first().n == 1
    known = spark.createDataFrame([], "n double").schema
    assert store.latest(known).schema["n"].dataType.simpleString() == "double"
    store.prune(keep=1)
    assert store.published() == [4] and store.latest() is None


def test_a_second_run_carries_what_only_the_first_one_s_file_holds(spark, wh, tmp_path):
    store = Versions(spark, str(tmp_path / "docs"))
    few = {n: spark.createDataFrame([], queries()[n](spark, wh.sf_dir).schema) for n in ("markets", "country_weights", "cohort_aging")}
    first = report.reviewed(wh).withColumn("country_weights", F.create_map(F.lit("XX"), F.lit(100.0)))
    month, retention, contribution = (F.lit(x) for x in COHORT_CURVE[0])
    first = first.withColumn("cohort_curve", F.array(F.struct(month.alias("month"), retention.alias("retention"), contribution.alias("contribution"))))
    store.publish(first)
    report.run(wh, store, AsOf(), few)
    made = json.loads(spark.read.text(store.path(2)).first()[0])
    assert made["reviews"] == {"total": wh.table("labels").count(), "good": wh.table("labels").where("quality = 1").count()}
    assert made["period"] == "Q3 2001" and len(made["region_countries"]) == 5
    assert made["country_weights"] == {"XX": 100.0} and made["top_markets"] == [] and made["cohort_aging"] == []
    assert [x["month"] for x in made["cohort_curve"]] == [COHORT_CURVE[0][0]]
    # The third run has the weights of its own query, and still the reviews.
    report.run(wh, store, AsOf(), {k: v for k, v in few.items() if k != "country_weights"})
    made = json.loads(spark.read.text(store.path(3)).first()[0])
    assert "XX" not in made["country_weights"] and made["reviews"]["total"] == wh.table("labels").count()


def test_catalog_sizes_and_samples(spark, tmp_path):
    spark.range(1000).repartition(3).write.parquet(str(tmp_path / "orders.parquet"))
    odd = spark.createDataFrame([(None, [1.5, None], None), (2, None, "b"), (None, [], "é"), (3, [0.0], "z")], "x int, a array<double>, `t.t` string")
    odd.write.parquet(str(tmp_path / "nation.parquet"))
    spark.createDataFrame([], "x int").write.parquet(str(tmp_path / "region.parquet"))
    only = ("orders", "nation", "region")
    got = {r.table_name: (r.n_files, r.n_rows, r.n_bytes) for r in catalog.catalog_sizes(spark, str(tmp_path), only).collect()}
    assert set(got) == set(only) and got["orders"][1] == 1000 and got["region"] == (0, 0, 0)
    for t in ("orders", "nation"):
        sizes = [f.stat().st_size for f in (tmp_path / f"{t}.parquet").glob("*.parquet") if spark.read.parquet(str(f)).count()]
        assert (got[t][0], got[t][2]) == (len(sizes), sum(sizes))
    cells = {(r.table_name, r.nth, r.column_name): (r.number, r.text) for r in catalog.catalog_samples(spark, str(tmp_path), only).collect()}
    assert len(cells) == 3 * 3 + 3
    assert [cells["nation", k, "a"] for k in (1, 2, 3)] == [(0.0, None), (2.0, None), (None, None)]
    assert [cells["nation", k, "t.t"] for k in (1, 2, 3)] == [(None, "é"), (None, None), (None, "b")]
    assert cells["orders", 3, "id"] == (2.0, None)


def test_names_sort_by_locale(spark):
    names = ["zebra", "Äther", "apfel", "Zoo", "Apfel", "éclair", "Eclair", "eclair", "ähre", None, "Öl", "ol"]
    rows = spark.createDataFrame([("x", n) for n in names], "name string, continent string")
    want = ["ähre", "apfel", "Apfel", "Äther", "eclair", "Eclair", "éclair", "ol", "Öl", "zebra", "Zoo"]
    got = [[r.continent for r in market_model.sorted_by(rows, 1, down).collect()] for down in (False, True)]
    assert got == [[None, *want], [*want[::-1], None]]


def test_exact_distinct_counts_and_sends_less(spark):
    rows = spark.range(60_000).selectExpr("id % 3 AS g", "CASE WHEN id % 11 = 0 THEN NULL ELSE id * 7 % 30000 - 9000 END AS x").union(spark.range(3).selectExpr("9L", "CAST(NULL AS BIGINT)"))
    want = {r.g: r.n for r in rows.groupBy("g").agg(F.count_distinct("x").alias("n")).collect()}
    assert {r.g: r.n for r in distinct.exact_distinct(rows, ["g"], "x", "n").collect()} == want and want[9] == 0
    assert distinct.exact_distinct(rows.where("false"), [], "x", "n").first().n == 0
    p = plan(distinct.exact_distinct(rows, ["g"], "x", "n"))
    assert p.index("bitmap_construct_agg") < p.rindex("partial_bitmap_construct_agg") and "hashpartitioning(g" in p
    assert "count(distinct" not in p


def test_diagnostics_push_their_month(spark, wh):
    p = plan(markets.diagnostics(wh))
    scans = [line for line in p.splitlines() if "PushedFilters" in line and "o_orderdate" in line]
    assert scans and all("GreaterThanOrEqual(o_orderdate" in line for line in scans)


def test_csv_and_html(spark, tmp_path):
    df = spark.createDataFrame([('a "b", c', None), ("<d>", "1")], "x string, y string")
    sinks.write_csv(df.coalesce(1), str(tmp_path / "csv"))
    text = next((tmp_path / "csv").glob("*.csv")).read_text()
    assert text.splitlines()[:2] == ['"x","y"', '"a ""b"", c",""']
    assert sinks.csv_text(["x"], [('a"',)]) == '﻿"x"\n"a"""'
    assert "<td>&lt;d></td>" in sinks.table_html(["x"], [("<d>",)]).replace("&gt;", ">")


def test_catalog(spark, small):
    assert "lineitem" in catalog.tables(spark, small)
    assert catalog.catalog_columns(spark, small, ("region", "missing")).count() == 2
    assert catalog.catalog_sample(spark, small, "orders").count() == 3
    assert "default" in catalog.catalog_namespaces(spark)
    catalog.register_views(spark, small, ("region",))
    assert spark.sql("SELECT count(*) FROM region").first()[0] == 5


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_prune_push_and_stay_in_the_jvm(spark, wh):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    p = plan(headline.monthly_gtv(wh, AsOf()))
    assert "GreaterThanOrEqual(o_orderdate" in p and "o_orderstatus" not in p
    p = plan(headline.monthly_revenue(wh, AsOf()))
    assert "GreaterThanOrEqual(l_shipdate" in p
    for df in (cohorts.cohort_aging(wh), cohorts.cohorts(wh), cohorts.unified_merchant(wh), headline.kpis(wh)):
        assert "Python" not in plan(df) and "CartesianProduct" not in plan(df)
    assert "TakeOrderedAndProject" in plan(cohorts.unified_merchant(wh)) or "TakeOrdered" in cohorts.unified_merchant(wh)._jdf.queryExecution().toString()


def test_bounded_sales_cut_lines_before_they_are_shuffled(spark, small):
    few, none = Warehouse(spark, small), Warehouse(spark, small, broadcast_keys=0)
    since = AsOf().month_before.replace(day=1)
    p = plan(few.sales(since=since))
    scan = p.index("l_orderkey", p.index("FileScan parquet [l_orderkey")) if "FileScan parquet [l_orderkey" in p else p.rindex("l_orderkey")
    above = p[:scan]
    assert "BroadcastHashJoin" in above[above.rindex("Exchange hashpartitioning(k"):]
    assert "LeftSemi" in p and sorted(map(tuple, few.sales(since=since).collect())) == sorted(map(tuple, none.sales(since=since).collect()))
    whole = few.sales().where(f"month >= '{since:%Y-%m}'")
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, few.sales(since=since).collect()))


def test_a_deep_chain_takes_few_rounds(spark):
    n = 300
    nodes = spark.range(n).selectExpr("id", "IF(id = 0, NULL, id - 1) AS reports_to").coalesce(1)
    assert hierarchy.closure(nodes).count() == n * (n - 1) // 2
    got = hierarchy.levels(nodes).agg(F.count("*").alias("n"), F.max("level").alias("deepest"), F.max(F.length("path")).alias("path")).first()
    assert (got.n, got.deepest, got.path) == (n, n - 1, len("/".join(map(str, range(n)))))
    two = nodes.unionByName(spark.createDataFrame([(2, 0)], "id long, reports_to long")).where("id < 4")
    assert {(r.id, r.level) for r in hierarchy.levels(two).collect()} == {(0, 0), (1, 1), (2, 1), (2, 2), (3, 2), (3, 3)}


def plain_descendants(edges):
    below = {i: {j for j, up in edges if up == i} for i, _ in edges}
    out = {}
    for i in below:
        seen, queue = set(), list(below[i])
        while queue:
            if (j := queue.pop()) not in seen:
                seen.add(j)
                queue += below[j]
        out[i] = (len(below[i]), seen)
    return out


@pytest.mark.parametrize("parents", [1, 2])
def test_counts_and_kept_ancestors_of_all_shapes(spark, parents):
    """Trees, orphans, cycles with trees below them, a node that reports to itself, repeats; with one parent each or more."""
    r = random.Random(parents)
    edges = {(i, r.choice([None, i // 2, i - 1, i - 1, 5000]) if i else None) for i in range(60)}
    edges |= {(i, 100 + (i - 99) % 5) for i in range(100, 105)} | {(i, r.randrange(100, i)) for i in range(105, 130)} | {(200, 200), (201, 200)}
    if parents == 2:
        edges |= {(30, 2), (40, 41), (110, 3), (50, 7), (51, None)}
    nodes = spark.createDataFrame(list(edges) + list(edges)[:9], "id long, reports_to long").repartition(3)
    want = plain_descendants(edges)
    got = {x.id: (x.direct_reports, x.descendants) for x in hierarchy.descendant_counts(nodes).collect()}
    assert got == {i: (n, len(seen)) for i, (n, seen) in want.items()}
    wanted = {17, 33, 112, 201, 9999}
    kept = {x.id for x in hierarchy.with_ancestors(nodes, spark.createDataFrame([(i,) for i in wanted], "id long")).collect()}
    assert kept == {i for i, (_, seen) in want.items() if i in wanted or seen & wanted}
    pairs = {(x.descendant, x.ancestor) for x in hierarchy.closure(nodes).collect()}
    assert pairs == {(d, a) for a, (_, seen) in want.items() for d in seen}


def test_ways_of_ids_with_several_parents(spark):
    """Each way down is a row, none comes back to a node, and a deep chain takes few rounds."""
    edges = [(i, i - 1 if i else None) for i in range(400)] + [(3, 1), (5, None), (7, 9), (900, 901), (901, 900), (901, 2), (902, 77777)]
    ups = {}
    for i, up in edges:
        ups.setdefault(i, []).append(up)
    want, queue = set(), [(i,) for i, up in edges if up is None]
    while queue:
        way = queue.pop()
        want.add((way[-1], len(way) - 1, "/".join(map(str, way))))
        queue += [(*way, i) for i, up in edges if up == way[-1] and i not in way]
    nodes = spark.createDataFrame(edges, "id long, reports_to long").repartition(2)
    assert {tuple(x) for x in hierarchy.levels(nodes).collect()} == want
    assert {x.level for x in hierarchy.levels(nodes, depth=3).select("level").collect()} == {0, 1, 2, 3}


def test_a_chain_of_100_000_is_counted(spark):
    n = 100_000
    chain = spark.range(n).selectExpr("id", "IF(id = 0, NULL, id - 1) AS reports_to")
    wrong = hierarchy.descendant_counts(chain).where(f"descendants <> {n - 1} - id OR direct_reports <> IF(id = {n - 1}, 0, 1)")
    assert wrong.isEmpty()
    assert hierarchy.with_ancestors(chain, spark.createDataFrame([(70_000,)], "id long")).agg(F.max("id"), F.count("*")).first() == (70_000, 70_001)


def test_bucketed_facts_are_not_shuffled(spark, wh, small):
    write_bucketed(wh, "tidemark_test", buckets=3)
    kept = BucketedWarehouse(spark, small, "tidemark_test")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for view in ("sales", "invoices"):
            for bounds in ({}, {"since": date(1998, 1, 1), "until": date(1999, 1, 1)}):
                got, want = getattr(kept, view)(**bounds), getattr(wh, view)(**bounds)
                assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
            p = plan(getattr(kept, view)())
            keys = ("hashpartitioning(k#", "hashpartitioning(l_orderkey#", "hashpartitioning(o_orderkey#")
            assert "SortMergeJoin" in p and not any(k in p for k in keys)
            assert any(k in plan(getattr(wh, view)()) for k in keys)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for t in ("orders", "lineitem"):
            spark.sql(f"DROP TABLE tidemark_test_{t}")


def test_a_run_scans_the_lines_twice(spark, wh, small, monkeypatch):
    read = []
    real = Warehouse.table
    monkeypatch.setattr(Warehouse, "table", lambda self, name: read.append(name) or real(self, name))
    out = run_all(spark, small)
    assert read.count("lineitem") == 2
    monkeypatch.undo()
    assert not spark.sparkContext._jsc.getPersistentRDDs()
    for name in ("kpis", "monthly", "diagnostics", "revenue_sample", "unified_merchant", "cohorts"):
        want = PULL[name](wh, AsOf())
        assert sorted(map(repr, out[name].collect())) == sorted(map(repr, want.collect())), name


def test_entry_points(spark, small):
    import __spark_entry__ as entry

    q = entry.queries()
    assert "cohort_aging" in q and set(entry.oracle_sql()) <= set(q)


def test_merchants_of_a_month_are_those_with_sales(spark, small, tmp_path):
    """Orders without lines are no sales, so the lines must be read (F1)."""
    lines = spark.read.parquet(f"{small}/lineitem.parquet").where("l_orderkey % 4 = 0")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.read.parquet(f"{small}/orders.parquet").write.parquet(f"{tmp_path}/orders.parquet")
    got = queries()["agg_count_distinct_grouped"](spark, str(tmp_path))
    want = spark.read.parquet(f"{tmp_path}/orders.parquet").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    want = want.select("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month")).distinct().groupBy("month").count()
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}


def test_cohort_cells_hold_no_sums_by_merchant(spark, wh):
    """sums by merchant and month held about every row of a task; money is summed by cohort and age alone."""
    p = plan(cohorts.cohort_cells(wh))
    assert "keys=[c#" in p and "keys=[merchant_id#" not in p


def test_the_document_sums_money_by_cohort_alone(spark, wh):
    """volume and revenue were summed by merchant in one aggregate over four sources, and lines were sorted to meet orders."""
    by_merchant = [x for x in plan(cohorts.cohorts(wh)).splitlines() if "Aggregate(keys=[merchant_id#" in x]
    assert by_merchant and not any(k in x for x in by_merchant for k in ("gtv", "revenue"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (wh.sales(), wh.invoices()):
            assert "ShuffledHashJoin" in plan(df) and "SortMergeJoin" not in plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_sale_months_are_those_of_sales(spark, wh):
    """a task held a row for each merchant and month."""
    want = wh.sales().where("month IS NOT NULL").select("merchant_id", X.month_text_index(F.col("month"))).collect()
    got = wh.sale_months().collect()
    assert len(got) == len(want) and set(map(tuple, got)) == set(map(tuple, want))
    assert "bit_or" in plan(cohorts.cohort_cells(wh))


def test_cohorts_of_merchants_without_facts_and_of_several_states(spark, small, tmp_path):
    """a cohort without facts is a row of zeros; a merchant counts once, and its MRR is rounded before it is added."""
    spark.read.parquet(f"{small}/nation.parquet").write.parquet(f"{tmp_path}/nation.parquet")
    customer = spark.read.parquet(f"{small}/customer.parquet")
    customer.where("c_custkey IN (1, 2, 73)").write.parquet(f"{tmp_path}/customer.parquet")
    orders = spark.read.parquet(f"{small}/orders.parquet").limit(1).drop("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    facts = "(11L, 1L, 'P', 10.0D, '2001-07-01'), (16L, 1L, 'P', 20.0D, '1999-01-01'), (21L, 1L, 'F', 30.0D, '2001-07-10'), (13L, 73L, 'P', 40.0D, '2000-01-01'), (14L, 73L, 'P', 50.0D, '2000-01-01')"
    facts = spark.sql(f"SELECT k AS o_orderkey, c AS o_custkey, s AS o_orderstatus, p AS o_totalprice, CAST(d AS TIMESTAMP_NTZ) AS o_orderdate FROM VALUES {facts} AS t(k, c, s, p, d)")
    facts.crossJoin(orders).write.parquet(f"{tmp_path}/orders.parquet")
    lines = spark.read.parquet(f"{small}/lineitem.parquet").limit(1).withColumn("l_orderkey", F.lit(11).cast("long"))
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r.cohort_month: r for r in cohorts.cohorts(Warehouse(spark, str(tmp_path))).collect()}
    rate = spark.sql("SELECT 1").crossJoin(fx_rates(spark).where("currency = 'USD'")).first().per_cent
    one, two = got["1995-02"], got["1995-03"]
    assert (one.registrations, one.active_now, one.paying_now, one.cancelled_30d) == (2, 1, 2, 1)
    assert two.registrations == 1 and (two.active_now, two.paying_now, two.cancelled_30d, two.cohort_mrr_eur, two.gtv_alltime_m_eur) == (0, 0, 0, 0.0, 0.0)
    assert one.arpc_eur == pytest.approx((round(30 * float(rate), 2) + round(40 * 0.01, 2)) / 2, abs=0.01)
