"""All queries by name, and a runner that contains the failure of one."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .plans import cohorts, headline, market_model, markets, operations, postprocess, report
from .plans.primitives import PRIMITIVES
from .sources import catalog
from .sources.facts import HeldWarehouse
from .sources.params import AsOf
from .sources.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]
log = logging.getLogger(__name__)

#: The fourteen queries of a daily pull.
PULL = {
    f.__name__: f
    for f in (
        headline.kpis,
        headline.monthly,
        cohorts.cohorts,
        markets.markets,
        markets.country_weights,
        headline.funnel,
        headline.revenue_projection,
        headline.gtv_projection,
        markets.diagnostics,
        markets.revenue_diag,
        markets.revenue_sample,
        markets.gtv_by_market,
        cohorts.unified_merchant,
        cohorts.cohort_aging,
    )
}
POST = (
    postprocess.monthly_dense,
    postprocess.incomplete_months,
    postprocess.last_complete_month,
    postprocess.kpi_repaired,
    postprocess.cohort_vintages,
    postprocess.top_markets_flagged,
    postprocess.funnel_labeled,
    postprocess.unit_economics,
    report.dashboard_document,
    report.agg_map_weights,
    report.funnel_fallback,
    report.console_summary,
)
OPERATIONS = (
    operations.task_status,
    operations.task_summary,
    operations.org_levels,
    operations.org_descendants,
    operations.self_join_parent,
    operations.org_filter_ancestors,
    operations.org_stats,
    operations.action_flatten,
    operations.action_facets,
    operations.action_summary,
    operations.action_owner_rollup,
    operations.action_rows,
    operations.milestone_progress,
    operations.projection_totals_yoy,
)
MARKET = (
    market_model.market_rows,
    market_model.market_totals,
    market_model.market_by_continent,
    market_model.market_drilldown,
    market_model.market_scenarios,
    market_model.market_country_table,
    market_model.market_export,
    report.market_filtered_sorted,
    report.market_sorted_texts,
)


def _dated(f, as_of: AsOf) -> Query:
    return lambda spark, sf_dir: f(Warehouse(spark, sf_dir), as_of)


def _plain(f) -> Query:
    return lambda spark, sf_dir: f(Warehouse(spark, sf_dir))


def queries(as_of: AsOf = AsOf()) -> dict[str, Query]:
    found: dict[str, Query] = {name: _dated(f, as_of) for name, f in PULL.items()}
    found |= {f.__name__: _dated(f, as_of) for f in (*POST, *OPERATIONS, *PRIMITIVES)}
    found |= {f.__name__: _plain(f) for f in MARKET}
    found["org_first_root"] = lambda spark, sf_dir: operations.first_root(Warehouse(spark, sf_dir))
    found["catalog_columns"] = catalog.catalog_columns
    found["catalog_row_counts"] = catalog.catalog_row_counts
    found["catalog_namespaces"] = catalog.namespaces
    found["catalog_samples"] = catalog.catalog_samples
    found["catalog_sizes"] = catalog.catalog_sizes
    return found


def run_all(spark: SparkSession, sf_dir: str, names: Iterable[str] = tuple(PULL), as_of: AsOf = AsOf()) -> dict[str, DataFrame]:
    """Runs queries one after the other and holds their results; all are bounded reports.

    The daily pull's queries share one warehouse, which holds what they take from the lines and is released
    at the end. A query that Spark refuses is logged and gives no rows, under its own schema where it can be planned,
    and the others go on.
    """
    known, out = queries(as_of), {}
    with HeldWarehouse(spark, sf_dir) as held:
        for name in names:
            schema = T.StructType()
            try:
                df = PULL[name](held, as_of) if name in PULL else known[name](spark, sf_dir)
                schema = df.schema
                out[name] = spark.createDataFrame(df.collect(), schema)
            except PySparkException as e:
                log.warning("%s failed: %s", name, str(e).splitlines()[0])
                out[name] = spark.createDataFrame([], schema)
    return out
