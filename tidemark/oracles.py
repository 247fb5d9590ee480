"""DuckDB SQL for the queries: written for DuckDB, over the driver's tables, to hold Spark's rows against."""

from __future__ import annotations

import re

from .sources.constants import (
    COHORT_CURVE,
    CONTINENTS,
    FLAGGED,
    FUNNEL,
    FX,
    GTV_PROJECTION,
    INFORMAL_SCALE,
    MONTHS,
    NUMBER_WORDS,
    PLAN_REVENUE,
    REVENUE_PROJECTION,
    TARGETS,
    TIERS,
    quoted,
)


def rows(of) -> str:
    return ", ".join("(" + ", ".join(quoted(v) for v in r) + ")" for r in of)


def R(x: str, places: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(30,10)), {places}) AS DOUBLE)"


def S(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(28,10))) AS DOUBLE)"


def ym(month: str) -> str:
    return f"(CAST(substr({month}, 1, 4) AS BIGINT) * 12 + CAST(substr({month}, 6, 2) AS BIGINT))"


#: Views that the queries share, by name; WITH lists are put together from them.
VIEWS = {
    "merchants": """SELECT c_custkey AS merchant_id, 'uuid-' || c_custkey AS merchant_uuid,
        CASE c_nationkey WHEN 24 THEN NULL WHEN 23 THEN '' ELSE n_name END AS country, 'm' || c_custkey || '@example.com' AS email,
        CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE TIMESTAMP '1995-01-01' + to_months(CAST(c_custkey % 72 AS INT)) + to_days(CAST(c_custkey % 28 AS INT)) END AS created_at
      FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "sales": """SELECT o_custkey AS merchant_id, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS sales_count
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""",
    "receipts": """SELECT o_custkey AS merchant_id, CAST(round(o_totalprice * 100) AS BIGINT) AS total_money,
        CASE left(o_orderpriority, 1) WHEN '1' THEN 'EUR' WHEN '2' THEN 'USD' WHEN '3' THEN 'JPY' WHEN '5' THEN 'XXX' END AS currency,
        CASE WHEN o_orderkey % 101 = 0 THEN 'bad-date' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS receipt_date
      FROM orders""",
    "customers": """SELECT CASE c_custkey % 2 WHEN 0 THEN 'EU' ELSE 'UK' END AS region,
        CASE c_custkey % 27 WHEN 0 THEN 'cb_' ELSE '' END || c_custkey AS customer_id, c_custkey % 41 = 0 AS deleted FROM customer""",
    "subscriptions": """SELECT CASE o_custkey % 2 WHEN 0 THEN 'EU' ELSE 'UK' END AS region, o_orderkey AS subscription_id,
        CASE o_custkey % 27 WHEN 0 THEN 'cb_' ELSE '' END || o_custkey AS customer_id,
        CASE o_orderstatus WHEN 'P' THEN 'active' WHEN 'F' THEN 'cancelled' ELSE 'non_renewing' END AS status,
        CAST(round(o_totalprice) AS BIGINT) AS mrr, CASE o_orderkey % 5 WHEN 1 THEN 'USD' WHEN 2 THEN 'GBP' WHEN 3 THEN 'EUR' WHEN 4 THEN 'XXX' END AS currency,
        CAST(epoch(o_orderdate) AS BIGINT) AS created_at,
        CASE WHEN o_orderstatus = 'F' THEN CAST(epoch(o_orderdate) AS BIGINT) + 86400 * (o_orderkey % 20) END AS cancelled_at, o_orderkey % 53 = 0 AS deleted
      FROM orders""",
    "invoices": """SELECT CASE o_custkey % 2 WHEN 0 THEN 'EU' ELSE 'UK' END AS region, CASE o_custkey % 27 WHEN 0 THEN 'cb_' ELSE '' END || o_custkey AS customer_id,
        CAST(round(l_extendedprice * 100) AS BIGINT) AS total,
        CASE l_returnflag WHEN 'A' THEN 0 ELSE CAST(round(l_extendedprice * 100) AS BIGINT) END AS amount_due,
        CASE l_returnflag WHEN 'A' THEN CAST(round(l_extendedprice * 100) AS BIGINT) ELSE 0 END AS amount_paid,
        CASE l_linenumber WHEN 2 THEN 'XXX' WHEN 3 THEN 'EUR' WHEN 4 THEN 'USD' END AS currency,
        CASE l_returnflag WHEN 'A' THEN 'paid' WHEN 'N' THEN 'payment_due' ELSE 'voided' END AS status,
        CAST(epoch(l_shipdate) AS BIGINT) AS date, l_orderkey % 59 = 0 AS deleted
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "fx": f"""SELECT currency, CAST(rate AS DECIMAL(9,8)) AS rate, minor_units,
        CAST(CAST(rate AS DECIMAL(18,12)) / 100 AS DECIMAL(18,12)) AS per_cent,
        CAST(CAST(rate AS DECIMAL(18,12)) / CASE minor_units WHEN 0 THEN 1 ELSE 100 END AS DECIMAL(18,12)) AS per_minor
      FROM (VALUES {rows(FX)}) AS t(currency, rate, minor_units)""",
    "targets": f"""SELECT CAST(m AS BIGINT) AS month_num, CAST(r AS DOUBLE) AS revenue_target, CAST(a AS BIGINT) AS active_users_target FROM (VALUES {rows(TARGETS)}) AS t(m, r, a)""",
    "eur_receipts": """SELECT r.*, try_strptime(receipt_date, '%Y-%m-%d')::DATE AS d, CAST(total_money AS DECIMAL(18,0)) * per_minor AS eur
      FROM receipts r LEFT JOIN fx ON fx.currency = coalesce(r.currency, 'EUR')""",
    "billed_subs": """SELECT s.*, TRY_CAST(s.customer_id AS BIGINT) AS merchant_id FROM subscriptions s
      JOIN customers c ON s.customer_id = c.customer_id AND s.region = c.region WHERE NOT s.deleted AND NOT c.deleted""",
    "rated_subs": """SELECT s.*, CAST(mrr AS DECIMAL(18,0)) * per_cent AS eur, per_cent IS NOT NULL AS known FROM billed_subs s
      LEFT JOIN fx ON fx.currency = coalesce(s.currency, CASE s.region WHEN 'UK' THEN 'GBP' ELSE 'EUR' END)""",
    "paid_invoices": """SELECT i.*, CAST(total AS DECIMAL(18,0)) * per_cent AS eur FROM invoices i
      JOIN fx ON fx.currency = coalesce(i.currency, CASE i.region WHEN 'UK' THEN 'GBP' ELSE 'EUR' END) WHERE status IN ('paid', 'payment_due') AND NOT deleted""",
    "revenue": """SELECT TRY_CAST(i.customer_id AS BIGINT) AS merchant_id, i.date, i.eur FROM paid_invoices i
      JOIN customers c ON c.customer_id = i.customer_id AND c.region = i.region WHERE NOT c.deleted AND TRY_CAST(i.customer_id AS BIGINT) IS NOT NULL""",
    "active": "SELECT DISTINCT merchant_id FROM sales WHERE month >= '2001-06'",
    "base": "SELECT merchant_id, created_at, strftime(created_at, '%Y-%m') AS cohort FROM merchants WHERE created_at IS NOT NULL",
    "cell_a": f"SELECT cohort, {ym('month')} - {ym('cohort')} AS age, count(DISTINCT merchant_id) AS active FROM sales JOIN base USING (merchant_id) WHERE month >= cohort GROUP BY ALL",
    "cell_r": """SELECT cohort, age, CAST(sum(eur) AS DOUBLE) AS revenue FROM (SELECT cohort, eur, date_diff('month', date_trunc('month', created_at), date_trunc('month', make_timestamp(date * 1000000))) AS age
      FROM revenue JOIN base USING (merchant_id)) WHERE age >= 0 GROUP BY cohort, age""",
    "cell_g": """SELECT cohort, age, CAST(sum(eur) AS DOUBLE) AS gtv FROM (SELECT cohort, eur, date_diff('month', date_trunc('month', created_at), date_trunc('month', d)) AS age
      FROM eur_receipts JOIN base USING (merchant_id) WHERE d IS NOT NULL) WHERE age >= 0 GROUP BY cohort, age""",
    "kpis": f"""SELECT {R('mrr * 12 / 1e6', 2)} AS total_revenue, CAST(0 AS BIGINT) AS payment_revenue, coalesce({R('mrr / nullif(paying, 0)', 2)}, 0) AS arpc,
        active AS active_users, {R('gtv / 1e6', 1)} AS total_gtv, CAST(0 AS BIGINT) AS attach_rate, CAST(0 AS BIGINT) AS take_rate, CAST(0 AS BIGINT) AS gtv_processed,
        coalesce({R('churn * 100', 1)}, 2.1) AS monthly_churn, coalesce({R('(1 - pow(1 - churn, 12)) * 100', 0)}, 22) AS annual_churn, CAST(104 AS BIGINT) AS nrr,
        registered, paying, CAST(0 AS BIGINT) AS payments_enabled, CAST(68 AS BIGINT) AS gross_margin
      FROM (SELECT *, cancelled / nullif(CAST(act + cancelled AS DOUBLE), 0) AS churn FROM
        (SELECT count(*) AS registered FROM merchants), (SELECT count(*) AS active FROM active),
        (SELECT count(*) FILTER (status = 'active' AND per_cent IS NOT NULL) AS paying, count(*) FILTER (status = 'active') AS act,
           coalesce(CAST(sum(CAST(mrr AS DECIMAL(18,0)) * per_cent) FILTER (status = 'active') AS DOUBLE), 0) AS mrr,
           count(*) FILTER (status = 'cancelled' AND cancelled_at >= epoch(TIMESTAMP '2001-06-15')) AS cancelled
         FROM subscriptions s LEFT JOIN fx ON fx.currency = coalesce(s.currency, CASE s.region WHEN 'UK' THEN 'GBP' ELSE 'EUR' END) WHERE NOT deleted),
        (SELECT coalesce(CAST(sum(eur) AS DOUBLE), 0) AS gtv FROM eur_receipts WHERE d >= DATE '2001-06-15'))""",
    "monthly": f"""SELECT month_num, ['{"','".join(MONTHS)}'][month_num] AS month_abbr, revenue_actual, revenue_target,
        CAST(0 AS BIGINT) AS payment_revenue_actual, CAST(0 AS BIGINT) AS payment_revenue_target, CAST(0 AS BIGINT) AS arpc_actual, CAST(0 AS BIGINT) AS arpc_target,
        active_users_actual, active_users_target, gtv_actual, CAST(0 AS BIGINT) AS gtv_target
      FROM targets
      LEFT JOIN (SELECT month(make_timestamp(date * 1000000)) AS month_num, {R('CAST(sum(eur) AS DOUBLE) / 1e6', 3)} AS revenue_actual FROM paid_invoices
        WHERE year(make_timestamp(date * 1000000)) = 2001 GROUP BY 1) USING (month_num)
      LEFT JOIN (SELECT CAST(substr(month, 6) AS BIGINT) AS month_num, count(DISTINCT merchant_id) AS active_users_actual FROM sales WHERE month LIKE '2001%' GROUP BY 1) USING (month_num)
      LEFT JOIN (SELECT month(d) AS month_num, {R('CAST(sum(eur) AS DOUBLE) / 1e6', 1)} AS gtv_actual FROM eur_receipts WHERE year(d) = 2001 GROUP BY 1) USING (month_num)""",
    "dense": """SELECT month_num, month_abbr AS month, revenue_target, CASE WHEN month_num < 7 THEN revenue_actual END AS revenue_actual,
        CAST(0 AS DOUBLE) AS payment_revenue_target, CASE WHEN month_num < 7 THEN CAST(0 AS DOUBLE) END AS payment_revenue_actual,
        CAST(0 AS DOUBLE) AS arpc_target, CASE WHEN month_num < 7 THEN CAST(0 AS DOUBLE) END AS arpc_actual,
        CAST(active_users_target AS DOUBLE) AS active_users_target, CASE WHEN month_num < 7 THEN CAST(active_users_actual AS DOUBLE) END AS active_users_actual,
        CAST(0 AS DOUBLE) AS gtv_target, CASE WHEN month_num < 7 THEN gtv_actual END AS gtv_actual FROM monthly""",
    "fold": """SELECT month_num, active_users_actual AS kept FROM dense WHERE month_num = 1
      UNION ALL SELECT d.month_num, CASE WHEN f.kept > 0 AND (f.kept - d.active_users_actual) / f.kept > 0.25 THEN NULL ELSE d.active_users_actual END
      FROM fold f JOIN dense d ON d.month_num = f.month_num + 1""",
    "complete": f"""SELECT month_num, month, {", ".join(f"{s}_target, CASE WHEN active_users_actual IS NULL OR kept IS NOT NULL THEN {s}_actual END AS {s}_actual"
        for s in ("revenue", "payment_revenue", "arpc", "active_users", "gtv"))}, active_users_actual IS NOT NULL AND kept IS NULL AS nulled
      FROM dense JOIN fold USING (month_num)""",
    "latest": "SELECT arg_max(active_users_actual, month_num) AS latest_active, count(active_users_actual) AS n_months FROM complete",
    "facts": """SELECT b.*, a.merchant_id IS NOT NULL AS active, p.mrr, p.merchant_id IS NOT NULL AS paying, x.merchant_id IS NOT NULL AS cancelled, g.gtv_30d, g.gtv, r.revenue
      FROM base b LEFT JOIN active a USING (merchant_id)
      LEFT JOIN (SELECT merchant_id, round(sum(eur), 2) AS mrr FROM rated_subs WHERE status = 'active' AND known GROUP BY 1) p USING (merchant_id)
      LEFT JOIN (SELECT DISTINCT merchant_id FROM rated_subs WHERE status = 'cancelled' AND cancelled_at >= epoch(TIMESTAMP '2001-06-15')) x USING (merchant_id)
      LEFT JOIN (SELECT merchant_id, sum(eur) FILTER (d >= DATE '2001-06-15') AS gtv_30d, sum(eur) AS gtv FROM eur_receipts GROUP BY 1) g USING (merchant_id)
      LEFT JOIN (SELECT merchant_id, sum(eur) AS revenue FROM revenue GROUP BY 1) r USING (merchant_id)""",
    "cohorts": f"""SELECT cohort AS cohort_month, n AS registrations, act AS active_now, {R('100.0::DOUBLE * act / n', 1)} AS active_pct, pay AS paying_now, {R('100.0::DOUBLE * pay / n', 2)} AS paying_pct,
        {R('100.0::DOUBLE * pay / nullif(act, 0)', 1)} AS active_to_paying_pct, {R('mrr', 0)} AS cohort_mrr_eur, {R('mrr * 12', 0)} AS cohort_arr_eur, {R('mrr / nullif(pay, 0)', 2)} AS arpc_eur,
        {R('g30 / 1000', 1)} AS gtv_30d_k_eur, {R('g / 1e6', 2)} AS gtv_alltime_m_eur, {R('rev / 1000', 1)} AS revenue_alltime_k_eur, {R('rev / n', 2)} AS npv_per_merchant_eur,
        {R('rev / nullif(pay, 0)', 2)} AS ltv_per_paying_eur, gone AS cancelled_30d, {R('100.0::DOUBLE * gone / nullif(pay + gone, 0)', 1)} AS churn_rate_30d, age AS cohort_age_months
      FROM (SELECT cohort, count(*) AS n, count(*) FILTER (active) AS act, count(*) FILTER (paying) AS pay, count(*) FILTER (cancelled) AS gone,
        coalesce(CAST(sum(mrr) AS DOUBLE), 0) AS mrr, coalesce(CAST(sum(gtv_30d) AS DOUBLE), 0) AS g30, coalesce(CAST(sum(gtv) AS DOUBLE), 0) AS g,
        coalesce(CAST(sum(revenue) AS DOUBLE), 0) AS rev, date_diff('month', date_trunc('month', min(created_at)), DATE '2001-07-01') AS age FROM facts GROUP BY cohort)""",
    "cells": """SELECT coalesce(a.cohort, r.cohort, g.cohort) AS cohort, coalesce(a.age, r.age, g.age) AS age, coalesce(active, 0) AS active, coalesce(revenue, 0) AS revenue, coalesce(gtv, 0) AS gtv
      FROM cell_a a FULL JOIN cell_r r ON a.cohort = r.cohort AND a.age = r.age
      FULL JOIN cell_g g ON g.cohort = coalesce(a.cohort, r.cohort) AND g.age = coalesce(a.age, r.age)""",
    "markets": """SELECT m.country, '' AS flag_emoji, coalesce(any_value(g.eur) / 1e6, 0) AS gtv_millions, count(*) AS merchant_count, coalesce(any_value(g.eur) / 1e6, 0) / count(*) AS avg_gtv_per_merchant
      FROM merchants m LEFT JOIN (SELECT country, CAST(sum(eur) AS DOUBLE) AS eur FROM eur_receipts JOIN merchants USING (merchant_id) WHERE d >= DATE '2001-06-15' GROUP BY 1) g ON g.country = m.country
      WHERE m.country <> '' GROUP BY m.country ORDER BY merchant_count DESC, m.country LIMIT 10""",
    "weights": f"""SELECT country AS country_code, {R('100.0::DOUBLE * count(*) / (SELECT count(*) FROM merchants)', 2)} AS weight FROM merchants WHERE country <> '' GROUP BY country
      ORDER BY weight DESC, country_code LIMIT 30""",
    "funnel": f"""SELECT stage, current_value, CAST(target AS BIGINT) AS target, conversion_rate, CAST(stage_order AS BIGINT) AS stage_order
      FROM (SELECT count(*) AS reg FROM merchants), (SELECT count(*) AS act FROM active), (SELECT count(*) AS pay FROM subscriptions WHERE status = 'active' AND NOT deleted),
        LATERAL (VALUES ('registered', reg, {FUNNEL[0][1]}, CAST(NULL AS DOUBLE), 1), ('active', act, {FUNNEL[1][1]}, {R('100.0::DOUBLE * act / nullif(reg, 0)', 1)}, 2),
          ('paying', pay, {FUNNEL[2][1]}, {R('100.0::DOUBLE * pay / nullif(act, 0)', 1)}, 3), ('payments_enabled', CAST(0 AS BIGINT), {FUNNEL[3][1]}, CAST(0 AS DOUBLE), 4)) AS t(stage, current_value, target, conversion_rate, stage_order)""",
    "vintages": f"""SELECT cohort_month AS month, {", ".join(f"coalesce(CAST({c} AS DOUBLE), 0) AS {n}" for n, c in (
        ("merchants", "registrations"), ("active_now", "active_now"), ("active_pct", "active_pct"), ("paying_now", "paying_now"), ("paying_pct", "paying_pct"),
        ("active_to_paying_pct", "active_to_paying_pct"), ("mrr", "cohort_mrr_eur"), ("arr", "cohort_arr_eur"), ("arpc", "arpc_eur"), ("gtv_30d", "gtv_30d_k_eur"),
        ("gtv_alltime", "gtv_alltime_m_eur"), ("revenue_alltime", "revenue_alltime_k_eur"), ("npv", "npv_per_merchant_eur"), ("ltv", "ltv_per_paying_eur"),
        ("cancelled_30d", "cancelled_30d"), ("churn_rate_30d", "churn_rate_30d"), ("cohort_age_months", "cohort_age_months"), ("payment_pct", "paying_pct")))} FROM cohorts""",
    "countries": """SELECT n_name AS name, r_name AS continent, n_nationkey % 3 <> 0 AS served, ['HI', 'UMI', 'LMI', 'LI'][n_nationkey % 4 + 1] AS tier,
        coalesce(nc, 0) / 8.0::DOUBLE AS micro, coalesce(ns, 0) / 4.0::DOUBLE AS small, coalesce(ns, 0) / 64.0::DOUBLE AS medium, coalesce(nc, 0) / 2.0::DOUBLE AS informal,
        (20 + n_nationkey * 3) / 100.0::DOUBLE AS digital_share, ['S', 'P', 'B', 'N/A'][n_nationkey % 4 + 1] AS psp, 'derived' AS source
      FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN (SELECT c_nationkey AS n_nationkey, count(*) AS nc FROM customer GROUP BY 1) USING (n_nationkey)
      LEFT JOIN (SELECT s_nationkey AS n_nationkey, count(*) AS ns FROM supplier GROUP BY 1) USING (n_nationkey)""",
    "tiers": f"SELECT * FROM (VALUES {rows(TIERS)}) AS t(tier, gp_m, gp_s, gp_d, gp_i, q_s, q_d, cap_m, cap_s, cap_d)",
    "sized": f"""SELECT *, CASE WHEN served THEN sam_gtv ELSE 0 END AS som_gtv, CASE WHEN served THEN sam_tpv ELSE 0 END AS som_tpv,
        CASE WHEN served THEN sam_rev ELSE 0 END AS som_rev, CASE WHEN served THEN sam_firms ELSE 0 END AS som_firms
      FROM (SELECT *, tam_gtv * 0.002::DOUBLE + tam_tpv * 0.005::DOUBLE AS tam_rev, sam_gtv * 0.002::DOUBLE + sam_tpv * 0.005::DOUBLE AS sam_rev
      FROM (SELECT *, tam_gtv * digital_share AS tam_tpv, sam_gtv * digital_share AS sam_tpv, formal + informal_firms AS firms
      FROM (SELECT *, micro + small + medium AS formal, micro * gp_m::DOUBLE + small * gp_s::DOUBLE + medium * gp_d::DOUBLE + informal_firms * gp_i::DOUBLE AS tam_gtv,
          micro * least(cap_m::DOUBLE, 1000) + small * least(1, q_s::DOUBLE) * least(cap_s::DOUBLE, 1000) + medium * least(1, q_d::DOUBLE) * least(cap_d::DOUBLE, 1000) + informal_firms * least(gp_i::DOUBLE, 1000) AS sam_gtv,
          micro + small * least(1, q_s::DOUBLE) + medium * least(1, q_d::DOUBLE) + informal_firms AS sam_firms
      FROM (SELECT *, CASE scenario WHEN 'e' THEN informal * {INFORMAL_SCALE}::DOUBLE ELSE 0::DOUBLE END AS informal_firms
      FROM countries JOIN tiers USING (tier), (VALUES ('c'), ('e')) AS s(scenario)))))""",
    "tasks": """SELECT 'task-' || s_suppkey AS id, ['daily', 'weekday', 'weekly-mon', 'weekly-thu', 'weekly-fri', 'weekly-sun'][s_suppkey % 6 + 1] AS cadence, 'owner_' || s_suppkey % 4 AS owner,
        s_suppkey % 7 <> 0 AS enabled, TIMESTAMP '2001-07-15' AS now,
        CASE WHEN s_suppkey % 11 <> 0 THEN TIMESTAMP '2001-07-15' - to_hours(CAST(s_suppkey * 5 % 240 AS INT)) END AS last_run,
        CASE WHEN s_suppkey % 5 <> 0 THEN TIMESTAMP '2001-07-15' + to_hours(CAST(s_suppkey * 7 % 60 - 20 AS INT)) END AS next_run FROM supplier""",
    "labelled": """SELECT *, CASE WHEN NOT enabled THEN 'Disabled' WHEN last_run IS NULL THEN 'Never run' WHEN now > next_run + INTERVAL 2 HOURS AND last_run < next_run THEN 'Missed run'
        WHEN epoch(now - last_run) / 3600 > CASE cadence WHEN 'daily' THEN 26 WHEN 'weekday' THEN 74 ELSE 170 END THEN 'Overdue' ELSE 'Healthy' END AS label FROM tasks""",
    "statuses": """SELECT *, CASE label WHEN 'Disabled' THEN 'disabled' WHEN 'Never run' THEN 'pending' WHEN 'Healthy' THEN 'healthy' ELSE 'failed' END AS status FROM labelled""",
    "people": """SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 5 = 0 THEN 'agent' ELSE 'human' END AS type,
        CASE WHEN c_custkey = 0 THEN NULL WHEN c_custkey % 37 = 0 THEN 999999 ELSE (c_custkey - 1) // 4 END AS reports_to,
        CASE WHEN c_custkey % 13 <> 0 THEN c_mktsegment END AS department, CASE WHEN c_custkey % 3 = 0 THEN 'contractor' ELSE 'employee' END AS employment_type FROM customer""",
    "up": """SELECT id AS descendant, reports_to AS ancestor, 1 AS distance FROM people WHERE reports_to IS NOT NULL
      UNION ALL SELECT descendant, p.reports_to, distance + 1 FROM up JOIN people p ON p.id = up.ancestor WHERE p.reports_to IS NOT NULL""",
    "down": """SELECT id, CAST(0 AS BIGINT) AS level, CAST(id AS VARCHAR) AS path FROM people WHERE reports_to IS NULL
      UNION ALL SELECT p.id, level + 1, path || '/' || p.id FROM down JOIN people p ON p.reports_to = down.id""",
    "actions": """SELECT 'A-' || strftime(o_orderdate, '%y%m%d') || '-' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') AS id, 'owner_' || o_custkey % 4 AS owner, strftime(o_orderdate, '%Y-%m-%d') AS due,
        CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'P' THEN 'in-progress' ELSE 'overdue' END AS status, ['payments', 'pricing', 'partnerships', 'general'][o_orderkey % 4 + 1] AS initiative, o_orderkey AS k FROM orders""",
}
RECURSIVE = {"fold", "up", "down"}


def sql(body: str) -> str:
    """body with the WITH list of the views that it names, those that they name included."""
    order: list[str] = []

    def need(text: str, own: str = "") -> None:
        for name in re.findall(r"\b(?:FROM|JOIN)\s+\(*\s*([a-z_]+)", text) + re.findall(r",\s*([a-z_]+)\b(?=\s*(?:[,)]|WHERE|$))", text):
            if name in VIEWS and name not in order and name != own:
                need(VIEWS[name], name)
                if name not in order:
                    order.append(name)

    need(body)
    if not order:
        return body
    recursive = "RECURSIVE " if RECURSIVE & set(order) else ""
    return f"WITH {recursive}" + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in order) + "\n" + body


MEASURES = "formal, informal_firms, firms, tam_gtv, tam_tpv, tam_rev, sam_gtv, sam_tpv, sam_rev, sam_firms, som_gtv, som_tpv, som_rev, som_firms"
COUNTRY = f"SELECT name, continent, served, tier, psp, source, digital_share, micro, small, medium, informal, scenario, {MEASURES} FROM sized WHERE scenario = 'c'"
POSITION = "list_position([" + ", ".join(f"'{c}'" for c in CONTINENTS) + "], continent)"


def fixed(x: str, places: int) -> str:
    return f"printf('%.{places}f', round(CAST({x} AS DECIMAL(30,10)), {places})::DOUBLE)"


def money_text(v: str) -> str:
    return (
        f"CASE WHEN {v} IS NULL THEN '—' WHEN abs({v}) >= 1000 THEN '$' || {fixed(f'({v}) / 1000', 1)} || 'T' WHEN abs({v}) >= 1 THEN '$' || {fixed(v, 1)} || 'B'"
        f" WHEN abs({v}) >= 0.001 THEN '$' || {fixed(f'({v}) * 1000', 0)} || 'M' ELSE '$' || {fixed(f'({v}) * 1e6', 0)} || 'K' END"
    )


def count_text(v: str) -> str:
    return (
        f"CASE WHEN {v} = 0 THEN '0' WHEN {v} >= 1000 THEN {fixed(f'({v}) / 1000', 1)} || 'B' WHEN {v} >= 1 THEN {fixed(v, 1)} || 'M'"
        f" WHEN {v} >= 0.001 THEN {fixed(f'({v}) * 1000', 1)} || 'K' ELSE {fixed(v, 3)} || 'M' END"
    )


def _projection(table, names: str) -> str:
    cols = names.split(", ")
    return f"SELECT CAST(year AS BIGINT) AS year, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in cols[1:])} FROM (VALUES {rows(table)}) AS t({names})"


def _delta(v: str, base: str, n: int) -> str:
    return f"'+' || {fixed(f'({v} / {base}::DOUBLE - 1) * 100', n)} || '%'"


ACTIVE_NOW = "CASE WHEN latest_active > 0 AND active_users < latest_active * 0.75::DOUBLE THEN latest_active ELSE CAST(active_users AS DOUBLE) END"
GTV_NOW = "CASE WHEN coalesce(total_gtv, 0) = 0 THEN 25.8::DOUBLE ELSE total_gtv END"
VIEWS |= {
    "reviewed": "SELECT count(*) AS total, count(*) FILTER (quality = 1) AS good FROM labels",
    "repaired": f"""SELECT total_revenue, {_delta('total_revenue', '7.6', 1)} AS total_revenue_delta, CAST(payment_revenue AS DOUBLE) AS payment_revenue, arpc, {ACTIVE_NOW} AS active_users,
        {_delta(f'({ACTIVE_NOW})', '278000', 0)} AS active_users_delta, {GTV_NOW} AS total_gtv, {_delta(f'({GTV_NOW})', '23.4', 0)} AS total_gtv_delta,
        coalesce(nullif(monthly_churn, 0), 2.1::DOUBLE) AS monthly_churn, coalesce(nullif(annual_churn, 0), 22::DOUBLE) AS annual_churn, nrr, gross_margin, registered, paying, payments_enabled
      FROM kpis CROSS JOIN latest""",
    "aging": f"""SELECT cohort AS cohort_month, age AS age_months, n AS registrations, active AS active_merchants, {R('100.0::DOUBLE * active / n', 1)} AS retention_pct, {R('revenue', 0)} AS revenue_eur,
        {R('sum(revenue) OVER (PARTITION BY cohort ORDER BY age ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 0)} AS cumulative_revenue_eur,
        {R('revenue / nullif(active, 0)', 2)} AS revenue_per_active_eur, {R('gtv / 1000', 1)} AS gtv_k_eur
      FROM cells JOIN (SELECT cohort, count(*) AS n FROM base GROUP BY 1) USING (cohort) WHERE age BETWEEN 0 AND 120""",
    "flagged": f"""SELECT country, CASE WHEN country IN ({", ".join(f"'{c}'" for c in FLAGGED)}) THEN chr(127462 + ascii(country) - 65) || chr(127462 + ascii(substr(country, 2)) - 65) ELSE '' END AS flag,
        gtv_millions AS gtv, merchant_count AS merchants, avg_gtv_per_merchant AS avg_gtv FROM markets""",
    "labeled": f"""SELECT key, label, current_value AS value, {fixed('nullif(conversion_rate, 0)', 1)} || '%' AS conv_rate, target, stage_order
      FROM funnel JOIN (VALUES {rows([(s, label, key) for s, _, label, key in FUNNEL])}) AS k(stage, label, key) USING (stage)""",
    "economics": """SELECT month AS cohort_month, npv AS avg_npv, ltv AS avg_ltv, floor(npv * 1.2::DOUBLE + 0.5::DOUBLE) AS cohort_payments FROM vintages ORDER BY month LIMIT 1""",
    "diagnosed": """SELECT 'active_users' AS source, month AS period, count(*) AS row_count, CAST(count(DISTINCT merchant_id) AS DOUBLE) AS metric_value FROM sales WHERE month >= '2001-01' GROUP BY month
      UNION ALL SELECT 'gtv_currency', coalesce(currency, 'NULL'), count(*), CAST(sum(total_money) AS DOUBLE) FROM eur_receipts WHERE d >= DATE '2001-06-15' GROUP BY currency
      UNION ALL SELECT 'gtv_null_pct', 'null_vs_total', count(*) FILTER (currency IS NULL), CAST(count(*) AS DOUBLE) FROM eur_receipts WHERE d >= DATE '2001-06-15'""",
    "invoiced": """SELECT 'eu_invoices' AS source, count(*) AS total_rows, count(*) FILTER (y = 2001) AS current_year_rows, CAST(sum(CASE WHEN y = 2001 THEN total ELSE 0 END) AS BIGINT) AS current_year_amount,
        min(t) AS min_date, max(t) AS max_date FROM (SELECT total, make_timestamp(date * 1000000) AS t, year(make_timestamp(date * 1000000)) AS y FROM invoices
        WHERE region = 'EU' AND status IN ('paid', 'payment_due') AND NOT deleted)""",
    "sampled": """SELECT amount_due, amount_paid, total, currency AS currency_code, status, make_timestamp(date * 1000000) AS invoice_date FROM invoices
      WHERE region = 'EU' AND status IN ('paid', 'payment_due') AND NOT deleted AND year(make_timestamp(date * 1000000)) = 2001
      ORDER BY invoice_date DESC, total DESC, amount_due, currency NULLS LAST LIMIT 5""",
    "revenue_plan": _projection(REVENUE_PROJECTION, "year, addon_revenue, payment_revenue, new_pricing_revenue"),
    "gtv_plan": _projection(GTV_PROJECTION, "year, gtv_billions"),
}


def _cells(section: str, source: str, key: str, numbers: str = "", texts: str = "") -> str:
    """A row for each value of each row of a source."""
    n, t = ([c for c in x.split() if c] for x in (numbers, texts))
    listed = lambda xs: "[" + ", ".join(xs) + "]"
    return (
        f"SELECT '{section}' AS section, {key} AS key, unnest({listed(repr(c) for c in n + t)}) AS metric,"
        f" unnest({listed([f'CAST({c} AS DOUBLE)' for c in n] + ['CAST(NULL AS DOUBLE)'] * len(t))}) AS number,"
        f" unnest({listed(['CAST(NULL AS VARCHAR)'] * len(n) + [f'CAST({c} AS VARCHAR)' for c in t])}) AS text FROM {source}"
    )


#: Columns of the tables in their order: n is a number, s a text, t an instant, a an array.
SAMPLED = {
    "region": "r_regionkey n r_name s",
    "nation": "n_nationkey n n_name s n_regionkey n",
    "customer": "c_custkey n c_name s c_nationkey n c_acctbal n c_mktsegment s",
    "supplier": "s_suppkey n s_name s s_nationkey n s_acctbal n",
    "part": "p_partkey n p_name s p_brand s p_type s p_size n p_retailprice n",
    "orders": "o_orderkey n o_custkey n o_orderstatus s o_totalprice n o_orderdate t o_orderpriority s",
    "lineitem": "l_orderkey n l_partkey n l_suppkey n l_linenumber n l_quantity n l_extendedprice n l_discount n l_tax n l_returnflag s l_linestatus s l_shipdate t",
    "events": "event_id n ts t user_id n event_type s value n props s",
    "documents": "doc_id n text s lang s source s n_chars n",
    "embeddings": "vec_id n embedding a label n",
    "pages": "page_id n url s html s",
    "benchmark": "item_id n text s",
    "labels": "doc_id n quality n toxic n",
    "conversations": "conv_id n turn n role s text s",
}


def _sample(table: str, columns: str) -> str:
    """The first three rows of a table by all its columns, a row for each value."""
    names, kinds = columns.split()[::2], columns.split()[1::2]
    listed = lambda xs: "[" + ", ".join(xs) + "]"
    number = {"n": "CAST({} AS DOUBLE)", "a": "CAST(len({}) AS DOUBLE)"}
    text = {"s": "{}", "t": "strftime({}, '%Y-%m-%d %H:%M:%S')"}
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in names)
    return (
        f"SELECT '{table}' AS table_name, nth, unnest({listed(repr(c) for c in names)}) AS column_name,"
        f" unnest({listed(number.get(k, 'CAST(NULL AS DOUBLE)').format(c) for c, k in zip(names, kinds))}) AS number,"
        f" unnest({listed(text.get(k, 'CAST(NULL AS VARCHAR)').format(c) for c, k in zip(names, kinds))}) AS text"
        f" FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS nth FROM {table}) WHERE nth <= 3"
    )


VINTAGE = "merchants active_now active_pct paying_now paying_pct active_to_paying_pct mrr arr arpc gtv_30d gtv_alltime revenue_alltime npv ltv cancelled_30d churn_rate_30d cohort_age_months payment_pct"
SERIES = " ".join(f"{s}_{m}" for s in ("revenue", "payment_revenue", "arpc", "active_users", "gtv") for m in ("target", "actual"))
DOCUMENT = " UNION ALL ".join(
    (
        _cells("kpis", "repaired", "''", "total_revenue payment_revenue arpc active_users total_gtv monthly_churn annual_churn nrr gross_margin registered paying payments_enabled", "total_revenue_delta active_users_delta total_gtv_delta"),
        _cells("monthly", "complete", "month", SERIES),
        _cells("incomplete_months", "complete WHERE nulled", "month", "", "month").replace("['month']", "['incomplete_months']"),
        _cells("funnel", "labeled", "key", "value target stage_order", "label conv_rate"),
        _cells("cohort_vintages", "vintages", "month", VINTAGE),
        _cells("unit_economics", "economics", "''", "avg_npv avg_ltv cohort_payments", "cohort_month"),
        _cells("cohort_aging", "aging", "cohort_month || '|' || age_months", "registrations active_merchants retention_pct revenue_eur cumulative_revenue_eur revenue_per_active_eur gtv_k_eur"),
        _cells("top_markets", "flagged", "country", "gtv merchants avg_gtv", "flag"),
        _cells("country_weights", "weights", "country_code", "weight"),
        _cells("revenue_projection", "revenue_plan", "CAST(year AS VARCHAR)", "addon_revenue payment_revenue new_pricing_revenue"),
        _cells("gtv_projection", "gtv_plan", "CAST(year AS VARCHAR)", "gtv_billions"),
        _cells("diagnostics", "diagnosed", "source || '|' || period", "row_count metric_value"),
        _cells("revenue_diag", "invoiced", "source", "total_rows current_year_rows current_year_amount", "min_date max_date"),
        _cells("revenue_sample", "sampled", "CAST(invoice_date AS VARCHAR) || '|' || total", "amount_due amount_paid", "currency_code status"),
        _cells("cohort_curve", f"(VALUES {rows(COHORT_CURVE)}) AS t(month, retention, contribution)", "CAST(month AS VARCHAR)", "retention contribution"),
        *(f"SELECT '{k}', '', '{k}', CAST(NULL AS DOUBLE), '{v}'" for k, v in (("last_updated", "2001-07-15"), ("period", "Q3 2001"), ("data_status", "ACTUAL"))),
        _cells("reviews", "reviewed", "''", "total good"),
        _cells("region_countries", "(SELECT r_name, count(*) AS countries FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name)", "r_name", "countries"),
    )
)
BODIES = {
    "dashboard_document": DOCUMENT,
    "agg_map_weights": "SELECT * FROM weights",
    "funnel_fallback": f"""SELECT key, label, CAST(v AS BIGINT) AS value, CASE WHEN rate IS NULL THEN NULL WHEN v > 0 AND b > 0 THEN {fixed('v * 100 / b', 1)} || '%' ELSE rate END AS conv_rate,
        CAST(goal AS BIGINT) AS target, CAST(stage_order AS BIGINT) AS stage_order
      FROM repaired, LATERAL (VALUES {", ".join(f"({quoted(key)}, {quoted(label)}, {goal}, {i + 1}, CAST({now} AS DOUBLE), CAST({before} AS DOUBLE), {rate})" for i, ((_, goal, label, key), now, before, rate) in enumerate(zip(FUNNEL, ("registered", "active_users", "paying", "payments_enabled"), ("NULL", "registered", "active_users", "paying"), ("CAST(NULL AS VARCHAR)", "'8.0%'", "'3.0%'", "'3.0%'"), strict=True)))}) AS t(key, label, goal, stage_order, v, b, rate)""",
    "console_summary": f"""SELECT CAST(position AS BIGINT) AS position, rpad(name || ':', 17, ' ') || value AS line FROM repaired, latest,
        (SELECT count(*) AS vintages FROM vintages), (SELECT least(count(*), 1000) AS unified FROM base), (SELECT count(*) AS aged FROM aging), (SELECT count(revenue_actual) AS filled FROM complete), (SELECT count(*) AS top FROM markets),
        LATERAL (VALUES (1, 'dataStatus', 'ACTUAL'), (2, 'lastUpdated', '2001-07-15'), (3, 'totalRevenue', '€' || {fixed('total_revenue', 2)} || 'M'), (4, 'activeUsers', format('{{:,}}', CAST(active_users AS BIGINT))),
          (5, 'registered', format('{{:,}}', registered)), (6, 'paying', format('{{:,}}', paying)), (7, 'ARPC', '€' || {fixed('arpc', 2)} || '/mo'), (8, 'Monthly churn', {fixed('monthly_churn', 1)} || '%'),
          (9, 'Cohort vintages', CAST(vintages AS VARCHAR)), (10, 'Unified merch', unified || ' rows'), (11, 'Cohort aging', aged || ' rows'), (12, 'Top markets', CAST(top AS VARCHAR)), (13, 'Monthly actuals', filled || '/12 months filled')) AS t(position, name, value)""",
    "market_filtered_sorted": """SELECT name, continent, psp, formal, tam_rev, row_number() OVER (ORDER BY formal, name) AS place FROM sized WHERE scenario = 'c' AND served AND psp IN ('P', 'B') AND contains(lower(name), 'a')""",
    "catalog_namespaces": "SELECT 'default' AS namespace",
    "market_sorted_texts": """SELECT name, continent, psp, formal, tam_rev, row_number() OVER (ORDER BY continent DESC, name) AS place FROM sized WHERE scenario = 'c'""",
    "catalog_samples": " UNION ALL ".join(_sample(t, kinds) for t, kinds in SAMPLED.items()),
    "catalog_columns": " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, column_name, regexp_replace(CASE replace(column_type, '[]', '') WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(replace(column_type, '[]', '')) END,
        '(.+)', CASE WHEN column_type LIKE '%[]' THEN 'array<\\1>' ELSE '\\1' END) AS data_type, "null" = 'YES' AS nullable, row_number() OVER () - 1 AS position FROM (DESCRIBE {t})"""
        for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
    ),
    "kpis": "SELECT * FROM kpis",
    "monthly": "SELECT * FROM monthly",
    "cohorts": "SELECT * FROM cohorts",
    "cohort_aging": "SELECT * FROM aging",
    "unified_merchant": f"""SELECT m.merchant_id, merchant_uuid, country, email, m.created_at AS registered_at, strftime(m.created_at, '%Y-%m') AS cohort_month, subscription_id, status AS sub_status,
        region AS billing_region, {R("CAST(mrr AS DECIMAL(18,0)) * coalesce(per_cent, 0.01::DECIMAL(18,12))", 2)} AS mrr_eur, b.currency AS currency_code, b.created_at AS sub_created_at, cancelled_at AS sub_cancelled_at,
        a.merchant_id IS NOT NULL AS is_active_30d, coalesce(status = 'active', false) AS is_paying, coalesce(status = 'cancelled' AND cancelled_at IS NOT NULL, false) AS is_churned,
        last_active_month, recent_txn_count, gtv_30d_eur, receipt_count_30d
      FROM merchants m
      LEFT JOIN (SELECT * FROM billed_subs QUALIFY row_number() OVER (PARTITION BY merchant_id ORDER BY status <> 'active', created_at DESC, subscription_id) = 1) b USING (merchant_id)
      LEFT JOIN fx ON fx.currency = coalesce(b.currency, 'EUR') AND subscription_id IS NOT NULL
      LEFT JOIN (SELECT merchant_id, max(month) AS last_active_month, CAST(sum(sales_count) AS BIGINT) AS recent_txn_count FROM sales WHERE month >= '2001-06' GROUP BY 1) a USING (merchant_id)
      LEFT JOIN (SELECT merchant_id, {R('sum(eur)', 2)} AS gtv_30d_eur, count(*) AS receipt_count_30d FROM eur_receipts WHERE d >= DATE '2001-06-15' GROUP BY 1) g USING (merchant_id)
      WHERE m.created_at IS NOT NULL ORDER BY m.created_at DESC, m.merchant_id LIMIT 1000""",
    "markets": "SELECT * FROM markets",
    "gtv_by_market": f"""SELECT country, {R('CAST(sum(eur) AS DOUBLE) / 1e6', 1)} AS gtv_millions, count(DISTINCT merchant_id) AS merchant_count FROM eur_receipts JOIN merchants USING (merchant_id)
      WHERE d >= DATE '2001-06-15' GROUP BY country""",
    "country_weights": "SELECT * FROM weights",
    "funnel": "SELECT * FROM funnel",
    "diagnostics": "SELECT * FROM diagnosed",
    "revenue_diag": "SELECT * FROM invoiced",
    "revenue_sample": "SELECT * FROM sampled",
    "revenue_projection": "SELECT * FROM revenue_plan",
    "gtv_projection": "SELECT * FROM gtv_plan",
    "monthly_dense": "SELECT * FROM dense",
    "incomplete_months": "SELECT * FROM complete",
    "last_complete_month": "SELECT * FROM latest",
    "kpi_repaired": "SELECT * FROM repaired",
    "cohort_vintages": "SELECT * FROM vintages",
    "top_markets_flagged": "SELECT * FROM flagged",
    "funnel_labeled": "SELECT * FROM labeled",
    "unit_economics": "SELECT * FROM economics",
    "scan_constant_fx": "SELECT currency, CAST(rate AS DOUBLE) AS rate, CAST(minor_units AS BIGINT) AS minor_units FROM fx",
    "values_targets": "SELECT * FROM targets",
    "scan_quoted": "SELECT status, count(*) AS n FROM subscriptions WHERE region = 'EU' GROUP BY status",
    "project_constants": "SELECT merchant_id, 'EU' AS region, CAST(0 AS BIGINT) AS payment_revenue, '' AS flag_emoji FROM merchants",
    "distinct_active": "SELECT * FROM active",
    "filter_in_list": "SELECT region, status, count(*) AS n, CAST(sum(total) AS BIGINT) AS total FROM invoices WHERE status IN ('paid', 'payment_due') GROUP BY ALL",
    "filter_nonempty": "SELECT country, count(*) AS n FROM merchants WHERE country <> '' GROUP BY country",
    "filter_like_year": "SELECT month, CAST(sum(sales_count) AS BIGINT) AS sales_count FROM sales WHERE month LIKE '2001%' GROUP BY month",
    "filter_rolling_days": "SELECT receipt_date, count(*) AS n, CAST(sum(total_money) AS BIGINT) AS raw FROM eur_receipts WHERE d >= DATE '2001-07-15' - 30 GROUP BY receipt_date",
    "filter_rolling_month": "SELECT receipt_date, count(*) AS n FROM eur_receipts WHERE d >= DATE '2001-07-15' - INTERVAL 1 MONTH GROUP BY receipt_date",
    "filter_rolling_timestamp": "SELECT region, count(*) AS n FROM subscriptions WHERE status = 'cancelled' AND make_timestamp(cancelled_at * 1000000) >= TIMESTAMP '2001-07-15' - INTERVAL 30 DAYS GROUP BY region",
    "filter_month_string": "SELECT month, count(*) AS n, CAST(sum(sales_count) AS BIGINT) AS sales_count FROM sales WHERE month >= '2001-06' GROUP BY month",
    "filter_year_range": "SELECT region, count(*) AS n, CAST(sum(total) AS BIGINT) AS total FROM invoices WHERE year(make_timestamp(date * 1000000)) = 2001 GROUP BY region",
    "join_inner_sub_customer": "SELECT region, count(*) AS n, CAST(sum(mrr) AS BIGINT) AS mrr FROM billed_subs GROUP BY region",
    "join_fx_inner_drop_unknown": f"SELECT coalesce(currency, 'NULL') AS currency, count(*) AS n, {R('sum(eur)', 2)} AS eur FROM eur_receipts WHERE currency IS NULL OR currency IN (SELECT currency FROM fx) GROUP BY 1",
    "join_fx_left_keep_unknown": f"SELECT coalesce(currency, 'NULL') AS currency, count(*) AS n, {R('sum(eur)', 2)} AS eur FROM eur_receipts GROUP BY 1",
    "join_fx_default_one": f"""SELECT coalesce(r.currency, 'NULL') AS currency, count(*) AS n, {R("sum(CAST(total_money AS DECIMAL(18,0)) * coalesce(per_cent, 0.01::DECIMAL(18,12)))", 2)} AS eur
      FROM receipts r LEFT JOIN fx ON fx.currency = coalesce(r.currency, 'EUR') GROUP BY 1""",
    "join_left_enrich": "SELECT month_num, active_users_target, active_users_actual FROM monthly",
    "join_full_outer_two_key": f"""SELECT coalesce(a.cohort, r.cohort) AS cohort_month, coalesce(a.age, r.age) AS age_months, active, {R('revenue', 2)} AS revenue FROM cell_a a FULL JOIN cell_r r ON a.cohort = r.cohort AND a.age = r.age""",
    "join_full_outer_coalesced": f"SELECT cohort AS cohort_month, age AS age_months, active, {R('revenue', 2)} AS revenue, {R('gtv', 2)} AS gtv FROM cells",
    "join_on_try_cast": f"""SELECT region, count(*) AS customers, count(merchant_id) AS matched, {R('100.0::DOUBLE * count(merchant_id) / count(*)', 2)} AS matched_pct
      FROM customers LEFT JOIN merchants ON merchant_id = TRY_CAST(customer_id AS BIGINT) GROUP BY region""",
    "cross_join_scalars": "SELECT * FROM (SELECT count(*) AS registered FROM merchants), (SELECT count(*) AS active FROM active), (SELECT count(*) AS receipts FROM receipts)",
    "semi_join_active": "SELECT country, count(*) AS active_merchants FROM merchants WHERE merchant_id IN (SELECT merchant_id FROM active) GROUP BY country",
    "agg_count_distinct_grouped": "SELECT month, count(DISTINCT merchant_id) AS merchants FROM sales GROUP BY month",
    "agg_conditional_counts": """SELECT region, count(*) FILTER (status = 'paid') AS paid, CAST(coalesce(sum(total) FILTER (status = 'paid'), 0) AS BIGINT) AS paid_total, count(*) FILTER (currency IS NULL) AS no_currency
      FROM invoices GROUP BY region""",
    "agg_two_phase_regions": f"SELECT month(make_timestamp(date * 1000000)) AS month_num, {R('sum(eur)', 2)} AS revenue FROM paid_invoices GROUP BY 1",
    "agg_mixed_distinct_sum": f"SELECT country, {R('sum(eur)', 2)} AS eur, count(DISTINCT merchant_id) AS merchants FROM eur_receipts JOIN merchants USING (merchant_id) GROUP BY country",
    "agg_ratio_guarded": f"""SELECT region, {R("100.0::DOUBLE * count(*) FILTER (status = 'voided') / count(*)", 2)} AS voided_pct, CAST(NULL AS DOUBLE) AS per_refund FROM invoices GROUP BY region""",
    "agg_percent_total": f"SELECT status, {R('100.0::DOUBLE * count(*) / (SELECT count(*) FROM subscriptions)', 2)} AS pct FROM subscriptions GROUP BY status",
    "agg_group_expr": "SELECT year(d) AS year, month(d) AS month_num, count(*) AS n FROM eur_receipts GROUP BY ALL",
    "agg_min_max_dates": "SELECT region, make_timestamp(min(date) * 1000000) AS first, make_timestamp(max(date) * 1000000) AS last FROM invoices GROUP BY region",
    "agg_max_month": "SELECT merchant_id, max(month) AS last_month, CAST(sum(sales_count) AS BIGINT) AS sales_count FROM sales GROUP BY merchant_id",
    "window_best_subscription": """SELECT merchant_id, subscription_id, status, region FROM billed_subs WHERE merchant_id IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY merchant_id ORDER BY status <> 'active', created_at DESC, subscription_id) = 1""",
    "window_running_revenue": f"""SELECT month, {R('eur', 2)} AS revenue, {R("sum(eur) OVER (PARTITION BY substr(month, 1, 4) ORDER BY month)", 2)} AS running
      FROM (SELECT strftime(make_timestamp(date * 1000000), '%Y-%m') AS month, sum(eur) AS eur FROM revenue GROUP BY 1)""",
    "topk_newest": "SELECT merchant_id, created_at FROM merchants WHERE created_at IS NOT NULL ORDER BY created_at DESC, merchant_id LIMIT 1000",
    "union_hetero": "SELECT 'merchants' AS source, CAST(NULL AS DOUBLE) AS rate, count(*) AS v FROM merchants UNION ALL SELECT 'subscriptions', 0.5::DOUBLE, count(*) FROM subscriptions",
    "fn_decode_month": f"SELECT m AS month_num, ['{"','".join(MONTHS)}'][m] AS month_abbr FROM range(1, 13) AS t(m)",
    "fn_try_casts": "SELECT customer_id, TRY_CAST(customer_id AS BIGINT) AS merchant_id FROM customers",
    "fn_month_boundary_diff": "SELECT merchant_id, date_diff('month', created_at, TIMESTAMP '2001-07-15') AS months FROM base",
    "fn_epoch_parts": """SELECT year(t) AS year, month(t) AS month_num, strftime(t, '%Y-%m') AS month, count(*) AS n FROM (SELECT make_timestamp(created_at * 1000000) AS t FROM subscriptions) GROUP BY ALL""",
    "fn_churn_compound": f"""SELECT region, {R('r * 100', 1)} AS monthly_churn, {R('(1 - pow(1 - r, 12)) * 100', 0)} AS annual_churn
      FROM (SELECT region, count(*) FILTER (status = 'cancelled')::DOUBLE / nullif(count(*) FILTER (status IN ('active', 'cancelled')), 0) / 12 AS r FROM subscriptions GROUP BY region)""",
    "fn_magnitude_format": f"""SELECT currency, {money_text('v')} AS money, {count_text('(v * 10)')} AS count, {fixed('v', 0)} || '%' AS pct
      FROM (SELECT coalesce(currency, 'NULL') AS currency, CAST(sum(total_money) AS DOUBLE) / 1e9 AS v FROM receipts GROUP BY 1)""",
    "fn_quarter_label": "SELECT 'Q' || quarter(created_at) AS quarter, count(*) AS n FROM base GROUP BY 1",
    "fn_number_word": f"SELECT n, coalesce(['{"','".join(NUMBER_WORDS)}'][n + 1], CAST(n AS VARCHAR)) AS word FROM range(0, 15) AS t(n)",
    "fn_falsy_coalesce": """SELECT merchant_id, CASE WHEN merchant_id % 3 = 1 THEN merchant_id ELSE 7 END AS falsy, CASE merchant_id % 3 WHEN 0 THEN 0 WHEN 1 THEN merchant_id ELSE 7 END AS nullish FROM merchants""",
    "market_rows": COUNTRY,
    "market_country_table": COUNTRY,
    "market_totals": f"""SELECT {", ".join(f"{S(m)} AS {m}" for m in MEASURES.split(", "))}, {S('som_rev')} * 0.01::DOUBLE AS penetrated_rev, {S('som_gtv')} * 0.002::DOUBLE * 0.01::DOUBLE AS penetrated_gtv_fee,
        {S('som_tpv')} * 0.005::DOUBLE * 0.01::DOUBLE AS penetrated_tpv_fee FROM sized WHERE scenario = 'c'""",
    "market_by_continent": f"""SELECT continent, CAST({POSITION} AS BIGINT) AS position, {", ".join(f"{S(m)} AS {m}" for m in ("informal_firms", "tam_tpv", "tam_rev", "sam_rev", "som_rev"))}, {S('formal')} AS formal, {S('tam_gtv')} AS tam_gtv,
        {count_text(S('formal'))} AS formal_text, {money_text(S('tam_gtv'))} AS tam_gtv_text FROM sized WHERE scenario = 'c' GROUP BY continent HAVING {POSITION} > 0""",
    "market_drilldown": f"""SELECT continent, name, grouping(name) = 1 AS is_subtotal, {", ".join(f"{S(m)} AS {m}" for m in ("micro", "small", "medium", "informal_firms", "tam_gtv", "tam_tpv", "tam_rev", "sam_gtv", "sam_rev", "som_rev"))}
      FROM sized WHERE scenario = 'c' AND {POSITION} > 0 GROUP BY GROUPING SETS ((continent), (continent, name))""",
    "market_scenarios": """SELECT CAST(position AS BIGINT) AS position, metric, c AS conservative, e AS expansive, e - c AS difference, e / nullif(c, 0) - 1 AS relative FROM (SELECT * FROM (
        """
    + " UNION ALL ".join(
        f"SELECT {i} AS position, '{label}' AS metric, CAST(sum(CAST({m} AS DECIMAL(28,10))) FILTER (scenario = 'c') AS DOUBLE) * {f}::DOUBLE AS c, CAST(sum(CAST({m} AS DECIMAL(28,10))) FILTER (scenario = 'e') AS DOUBLE) * {f}::DOUBLE AS e FROM sized"
        for i, (label, m, f) in enumerate(
            (("Total firms", "firms", 1), ("TAM GTV", "tam_gtv", 1), ("TAM revenue potential", "tam_rev", 1), ("SAM revenue potential", "sam_rev", 1), ("SOM revenue potential", "som_rev", 1), ("Penetrated revenue", "som_rev", 0.01)),
            1,
        )
    )
    + "))",
    "market_export": """SELECT name AS "Country", continent AS "Continent", CASE WHEN served THEN 'Yes' ELSE 'No' END AS "Served", tier AS "Tier", """
    + ", ".join(
        f"CAST(CAST(floor({c} + 0.5::DOUBLE) AS BIGINT) AS VARCHAR) AS \"{n}\""
        for c, n in (("formal", "Formal SMBs"), ("tam_gtv", "GTV TAM"), ("tam_tpv", "TPV TAM"), ("tam_rev", "Revenue TAM"), ("sam_rev", "Revenue SAM"), ("som_rev", "Revenue SOM"))
    )
    + f""", '' AS "Informal SMBs", {fixed('digital_share * 100', 1)} || '%' AS "Digital %", CASE psp WHEN 'S' THEN 'Stripe' WHEN 'P' THEN 'Partner' WHEN 'B' THEN 'Stripe+Teya' ELSE psp END AS "PSP", source AS "SMB Source"
      FROM sized WHERE scenario = 'c'""",
    "task_status": """SELECT id, cadence, owner, enabled, status, label,
        CASE WHEN last_run IS NULL THEN 'Never' WHEN m < 1 THEN 'Just now' WHEN m < 60 THEN m || 'm ago' WHEN m // 60 < 24 THEN m // 60 || 'h ago' WHEN m // 1440 = 1 THEN 'Yesterday' ELSE m // 1440 || 'd ago' END AS last_run_ago,
        CASE WHEN next_run IS NULL THEN '—' ELSE strftime(next_run, '%a ') || CASE WHEN hour(next_run) > 12 THEN hour(next_run) - 12 ELSE hour(next_run) END || strftime(next_run, ':%M') || CASE WHEN hour(next_run) >= 12 THEN 'PM' ELSE 'AM' END END AS next_run_text
      FROM (SELECT *, CAST(floor(epoch(now - last_run) / 60) AS BIGINT) AS m FROM statuses)""",
    "task_summary": "SELECT count(*) FILTER (status = 'healthy') AS healthy, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status NOT IN ('healthy', 'failed')) AS pending, count(*) AS total FROM statuses",
    "org_levels": """SELECT id, name, type, reports_to, level, path, row_number() OVER (PARTITION BY reports_to ORDER BY type <> 'human', name, id) AS sibling FROM down JOIN people USING (id)""",
    "org_descendants": """SELECT p.id, count(DISTINCT descendant) FILTER (distance = 1) AS direct_reports, count(DISTINCT descendant) AS descendants FROM people p LEFT JOIN up ON up.ancestor = p.id GROUP BY p.id""",
    "self_join_parent": """SELECT p.id, p.name, coalesce(b.name, CAST(p.reports_to AS VARCHAR)) AS manager, p.reports_to IS NOT NULL AND b.id IS NULL AS orphan FROM people p LEFT JOIN people b ON b.id = p.reports_to""",
    "org_filter_ancestors": """SELECT id, name, type FROM people WHERE type = 'agent' OR id IN (SELECT up.ancestor FROM up JOIN people p ON p.id = up.descendant WHERE p.type = 'agent')""",
    "org_stats": """SELECT count(*) FILTER (type = 'human') AS humans, count(*) FILTER (type = 'agent') AS agents, count(DISTINCT nullif(department, '')) AS departments,
        count(*) FILTER (type = 'human' AND employment_type = 'employee') || '/' || count(*) FILTER (type = 'human') AS employees FROM people""",
    "org_first_root": "SELECT id, name, type FROM people WHERE reports_to IS NULL ORDER BY name, id LIMIT 1",
    "action_flatten": "SELECT id, owner, due, status, initiative FROM actions",
    "action_facets": """SELECT count(*) AS total, count(*) FILTER (status = 'done') AS done, count(*) FILTER (status = 'in-progress') AS in_progress, count(*) FILTER (status = 'overdue') AS overdue, count(*) AS shown
      FROM actions WHERE owner = 'owner_1'""",
    "action_summary": """SELECT count(*) AS total, count(*) FILTER (status = 'done') AS done, count(*) FILTER (status = 'in-progress') AS in_progress, count(*) FILTER (status = 'overdue') AS overdue, count(DISTINCT left(id, 9)) AS sessions FROM actions""",
    "action_owner_rollup": f"""SELECT owner, total, done, in_progress, overdue, {", ".join(f"CAST(floor(100.0::DOUBLE * {c} / total + 0.5::DOUBLE) AS BIGINT) AS {c}_pct" for c in ("done", "in_progress", "overdue"))}
      FROM (SELECT owner, count(*) AS total, count(*) FILTER (status = 'done') AS done, count(*) FILTER (status = 'in-progress') AS in_progress, count(*) FILTER (status = 'overdue') AS overdue FROM actions GROUP BY owner)""",
    "action_rows": """SELECT id, owner, due, CASE status WHEN 'done' THEN 'Done' WHEN 'in-progress' THEN 'In Progress' ELSE 'Overdue' END AS status_label,
        CASE initiative WHEN 'payments' THEN 'Payments' WHEN 'pricing' THEN 'Pricing' WHEN 'partnerships' THEN 'Partnerships' ELSE 'Gen. Strategy' END AS initiative_label FROM actions""",
    "milestone_progress": """SELECT own AS id, count(*) FILTER (k % 10 = 0 AND status = 'done') || '/' || count(*) FILTER (k % 10 = 0) AS progress,
        CASE WHEN bool_or(status = 'overdue') AND NOT bool_or(status = 'in-progress') THEN 'red' WHEN bool_or(status = 'overdue') THEN 'amber' ELSE 'green' END AS health_level
      FROM (SELECT *, initiative || '-' || left(due, 7) || '-' || k % 64 AS own FROM actions WHERE initiative <> 'general') GROUP BY own""",
    "projection_totals_yoy": f"""SELECT CAST(year AS BIGINT) AS year, {R('a + b + c', 1)} AS summed_total, CAST(total AS DOUBLE) AS stated_total, {R('(CAST(total AS DOUBLE) / lag(CAST(total AS DOUBLE)) OVER (ORDER BY year) - 1) * 100', 1)} AS yoy_pct, g AS stated_growth
      FROM (VALUES {rows(PLAN_REVENUE)}) AS t(year, a, b, c, total, g)""",
    "catalog_row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}"
        for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
    ),
}
SQL = {name: sql(body) for name, body in BODIES.items()}
