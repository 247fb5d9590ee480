"""Fixed values of the business: exchange rates, targets, projections, labels, tier parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Currency, EUR for one unit of it, decimals of its minor unit.
FX = (
    ("EUR", "1.0", 2),
    ("USD", "0.8564", 2),
    ("GBP", "1.1492", 2),
    ("JPY", "0.005405", 0),
    ("KRW", "0.00057917", 0),
    ("PHP", "0.014400", 2),
    ("THB", "0.026718", 2),
    ("IDR", "0.00005035", 2),
    ("MXN", "0.049128", 2),
    ("MYR", "0.2152", 2),
    ("VND", "0.00003284", 0),
    ("BRL", "0.1678", 2),
    ("SAR", "0.2284", 2),
    ("INR", "0.009269", 2),
    ("COP", "0.00023219", 2),
    ("ARS", "0.00061743", 2),
    ("EGP", "0.016092", 2),
    ("NGN", "0.00062172", 2),
    ("KES", "0.006607", 2),
    ("UAH", "0.019716", 2),
    ("TRY", "0.019240", 2),
    ("RUB", "0.010912", 2),
    ("PLN", "0.2351", 2),
    ("AUD", "0.6036", 2),
    ("CAD", "0.6186", 2),
    ("CHF", "1.0835", 2),
    ("SEK", "0.092139", 2),
    ("NOK", "0.089589", 2),
    ("DKK", "0.1340", 2),
    ("CZK", "0.040999", 2),
    ("HUF", "0.002656", 2),
    ("RON", "0.1963", 2),
    ("ZAR", "0.052269", 2),
    ("PKR", "0.003074", 2),
    ("BDT", "0.006974", 2),
    ("LKR", "0.002721", 2),
    ("MMK", "0.00040774", 2),
    ("TWD", "0.026992", 2),
    ("SGD", "0.6721", 2),
    ("HKD", "0.1094", 2),
    ("NZD", "0.4993", 2),
    ("ILS", "0.2773", 2),
    ("AED", "0.2332", 2),
    ("PEN", "0.2514", 2),
    ("CLP", "0.00093392", 0),
    ("QAR", "0.2353", 2),
    ("KHR", "0.00021232", 2),
    ("LAK", "0.00003912", 2),
)
#: Month, revenue target (EUR million), active users target.
TARGETS = (
    (1, 0.73, 340000),
    (2, 0.75, 345000),
    (3, 0.78, 350000),
    (4, 0.80, 360000),
    (5, 0.82, 365000),
    (6, 0.85, 370000),
    (7, 0.87, 375000),
    (8, 0.89, 380000),
    (9, 0.91, 385000),
    (10, 0.93, 390000),
    (11, 0.95, 395000),
    (12, 0.97, 400000),
)
#: Abbreviations of the months.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
#: Year, add-on, payment and new-pricing revenue (EUR million).
REVENUE_PROJECTION = (
    (2025, 7.6, 0.0, 0.0),
    (2026, 8.5, 0.1, 1.1),
    (2027, 9.5, 1.5, 3.0),
    (2028, 10.5, 5.0, 5.5),
    (2029, 11.5, 12.0, 8.0),
    (2030, 12.5, 25.0, 11.0),
)
#: Year, transaction volume (EUR billion).
GTV_PROJECTION = ((2025, 23.4), (2026, 30.9), (2027, 40.0), (2028, 52.0), (2029, 67.0), (2030, 85.0))
#: Fixed values of the plan: year, add-on, payments, new pricing, stated total, stated growth.
PLAN_REVENUE = (
    (2025, 7.6, 0.2, 0.0, 7.6, "26.0%"),
    (2026, 9.3, 0.1, 0.3, 9.7, "27.6%"),
    (2027, 11.3, 1.5, 3.1, 15.9, "63.9%"),
    (2028, 13.2, 4.8, 11.0, 29.0, "82.4%"),
    (2029, 14.8, 9.4, 29.6, 53.8, "85.5%"),
    (2030, 16.5, 14.5, 47.4, 78.4, "45.7%"),
)
#: Fixed values of the plan: months, retention and contribution (percent).
COHORT_CURVE = ((0, 100, 0), (3, 92, 8), (6, 85, 18), (12, 78, 42), (18, 72, 68), (24, 68, 85), (36, 65, 100))
#: Cohorts shown where there are none: month, merchants, npv, ltv, arpc, payment percent.
DEFAULT_VINTAGES = (
    ("2024-01", 45000, 120.0, 145.0, 12.0, 0.0),
    ("2024-04", 52000, 135.0, 158.0, 13.0, 0.0),
    ("2024-07", 58000, 148.0, 170.0, 14.0, 0.0),
    ("2024-10", 63000, 160.0, 178.0, 14.5, 0.0),
    ("2025-01", 68000, 170.0, 185.0, 15.0, 0.5),
    ("2025-07", 75000, 180.0, 195.0, 16.0, 1.2),
)
#: Countries that have a flag; its two letters are regional indicators.
FLAGGED = "US BR MX IN ID GB FR DE ES IT JP PH RU TR PL TH CO AR SA EG AU CA NG KE UA MY VN".split()
#: Stage, goal, label, key in the document.
FUNNEL = (
    ("registered", 5_000_000, "Registered merchants", "registered"),
    ("active", 400_000, "Active (last 30d)", "active"),
    ("paying", 20_000, "Paying customers", "paying"),
    ("payments_enabled", 1_600, "Payments-enabled", "paymentsEnabled"),
)
#: Volume of a micro, small, medium and informal firm by income tier (USD thousand),
#: shares of small and medium firms that qualify, and caps of the served volume of micro, small, medium.
TIERS = (
    ("HI", 80.0, 700.0, 6000.0, 15.0, 0.60, 0.05, 80.0, 400.0, 700.0),
    ("UMI", 30.0, 180.0, 1200.0, 6.0, 0.75, 0.10, 30.0, 140.0, 600.0),
    ("LMI", 7.0, 35.0, 250.0, 2.5, 0.95, 0.30, 7.0, 33.0, 200.0),
    ("LI", 3.0, 15.0, 100.0, 1.5, 0.99, 0.65, 3.0, 15.0, 80.0),
)
TIER_COLUMNS = ("tier", "gp_m", "gp_s", "gp_d", "gp_i", "q_s", "q_d", "cap_m", "cap_s", "cap_d")
#: Fixed value: share of the informal firms that the expansive scenario counts.
INFORMAL_SCALE = 0.1242
#: Fixed order of continents in reports; the driver's regions stand for them.
CONTINENTS = ("ASIA", "EUROPE", "AMERICA", "MIDDLE EAST", "AFRICA")
#: Payment provider codes and labels.
PROVIDERS = (("S", "Stripe"), ("P", "Partner"), ("B", "Stripe+Teya"), ("N/A", "N/A"))
#: Cadence of a task and the hours after which it is overdue; others as weekly.
CADENCE_HOURS = (("daily", 26), ("weekday", 74))
WEEKLY_HOURS, GRACE_HOURS = 170, 2
#: Number words from 0.
NUMBER_WORDS = ("Zero", "One", "Two", "Three", "Four", "Five", "Six", "Seven", "Eight", "Nine", "Ten", "Eleven", "Twelve")
#: Labels of initiatives; any other is general strategy.
INITIATIVES = (("payments", "Payments"), ("pricing", "Pricing"), ("partnerships", "Partnerships"))


def quoted(value) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def values(spark: SparkSession, rows, columns: str) -> DataFrame:
    """A constant relation: planned as a local table scan, so nothing is sent to Python."""
    body = ", ".join("(" + ", ".join(quoted(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({columns})")


def fx_rates(spark: SparkSession) -> DataFrame:
    """currency, rate, minor_units, and exact factors: per_cent for hundredths, per_minor for minor units."""
    rows = [(c, rate, m) for c, rate, m in FX]
    body = ", ".join(f"('{c}', CAST('{rate}' AS DECIMAL(9,8)), {m})" for c, rate, m in rows)
    return spark.sql(
        f"""SELECT currency, rate, minor_units,
              CAST(rate * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(18,12)) AS per_cent,
              CAST(rate * IF(minor_units = 0, CAST('1' AS DECIMAL(3,2)), CAST('0.01' AS DECIMAL(3,2))) AS DECIMAL(18,12)) AS per_minor
            FROM VALUES {body} AS t(currency, rate, minor_units)"""
    )


def targets(spark: SparkSession) -> DataFrame:
    return values(spark, TARGETS, "month_num, revenue_target, active_users_target").selectExpr(
        "month_num", "CAST(revenue_target AS DOUBLE) AS revenue_target", "CAST(active_users_target AS BIGINT) AS active_users_target"
    )
