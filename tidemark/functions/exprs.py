"""Column expressions; all of them compile to JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.constants import MONTHS, NUMBER_WORDS


def rounded(x: Column, places: int) -> Column:
    """Half away from zero on the decimal value, as a double. A double's own digits beyond 10 places don't decide ties."""
    return F.round(x.cast("decimal(30,10)"), places).cast("double")


def month_index(day: Column) -> Column:
    """Months since year 0; differences count calendar boundaries, not whole months."""
    return (F.year(day) * 12 + F.month(day)).cast("long")


def month_text_index(month: Column) -> Column:
    """month_index() of a text 'YYYY-MM'."""
    return (F.substring(month, 1, 4).cast("long") * 12 + F.substring(month, 6, 2).cast("long")).cast("long")


def month_text(index: Column) -> Column:
    """'YYYY-MM' of a month_index()."""
    year = F.floor((index - 1) / 12)
    return F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad((index - year * 12).cast("string"), 2, "0"))


def month_diff(a: Column, b: Column) -> Column:
    """Calendar month boundaries from a to b."""
    return month_index(b) - month_index(a)


def parsed_date(text: Column) -> Column:
    return F.try_to_date(text, "yyyy-MM-dd")


def merchant_key(customer_id: Column) -> Column:
    """The merchant of a billing customer; null where the id is no number, which then joins nothing."""
    return customer_id.try_cast("decimal(38,0)").try_cast("long")


def falsy(x: Column, default: Column, *more: Column) -> Column:
    """The first of the values that is neither null, 0 nor empty; the last value as it is."""
    rest = falsy(default, *more) if more else default
    return F.when(x.isNull() | (x.cast("string").isin("0", "0.0", "", "false")), rest).otherwise(x)


def ratio(a: Column, b: Column) -> Column:
    """a / b as doubles, null where b is 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def percent(a: Column, b: Column, places: int) -> Column:
    return rounded(F.try_divide(F.lit(100.0) * a, b.cast("double")), places)


def month_abbr(month_num: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTHS]), month_num.cast("int"))


def number_word(n: Column) -> Column:
    """Zero to Twelve; other numbers as digits."""
    words = F.array(*[F.lit(w) for w in NUMBER_WORDS])
    return F.coalesce(F.get(words, n.cast("int")), n.cast("string"))


def fixed(x: Column, places: int) -> Column:
    """A number with so many decimals."""
    return F.round(x.cast("decimal(30,10)"), places).cast("string")


def exact_sum(x: Column) -> Column:
    """A sum of doubles that doesn't depend on the order of rows: they are added at ten decimal places."""
    return F.sum(x.cast("decimal(28,10)")).cast("double")


def money_text(v: Column) -> Column:
    """Billions as $..T, $..B, $..M or $..K by size; a dash for null."""
    size = F.abs(v)
    return (
        F.when(v.isNull() | F.isnan(v), "—")
        .when(size >= 1000, F.concat(F.lit("$"), fixed(v / 1000, 1), F.lit("T")))
        .when(size >= 1, F.concat(F.lit("$"), fixed(v, 1), F.lit("B")))
        .when(size >= 0.001, F.concat(F.lit("$"), fixed(v * 1000, 0), F.lit("M")))
        .otherwise(F.concat(F.lit("$"), fixed(v * 1e6, 0), F.lit("K")))
    )


def count_text(v: Column) -> Column:
    """Millions as ..B, ..M or ..K by size."""
    return (
        F.when(v == 0, "0")
        .when(v >= 1000, F.concat(fixed(v / 1000, 1), F.lit("B")))
        .when(v >= 1, F.concat(fixed(v, 1), F.lit("M")))
        .when(v >= 0.001, F.concat(fixed(v * 1000, 1), F.lit("K")))
        .otherwise(F.concat(fixed(v, 3), F.lit("M")))
    )


def percent_text(v: Column) -> Column:
    return F.concat(fixed(v * 100, 0), F.lit("%"))


def relative_time(then: Column, now: Column) -> Column:
    """How long ago an instant was, in words."""
    minutes = F.floor((F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(then.cast("timestamp"))) / 60)
    hours = F.floor(minutes / 60)
    days = F.floor(hours / 24)
    return (
        F.when(then.isNull(), "Never")
        .when(minutes < 1, "Just now")
        .when(minutes < 60, F.concat(minutes.cast("string"), F.lit("m ago")))
        .when(hours < 24, F.concat(hours.cast("string"), F.lit("h ago")))
        .when(days == 1, "Yesterday")
        .otherwise(F.concat(days.cast("string"), F.lit("d ago")))
    )


def clock_text(t: Column) -> Column:
    """'Mon 3:05PM'; midnight's hour is 0, noon's 12."""
    hour = F.hour(t)
    text = F.concat(
        F.date_format(t, "EEE"), F.lit(" "), F.when(hour > 12, hour - 12).otherwise(hour).cast("string"), F.lit(":"), F.date_format(t, "mm")
    )
    return F.when(t.isNull(), "—").otherwise(F.concat(text, F.when(hour >= 12, "PM").otherwise("AM")))


def quarter_text(day: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(day).cast("string"))


def coded(x: Column, pairs, default: Column | str) -> Column:
    """A label for each code; anything else is the default."""
    out = default if isinstance(default, Column) else F.lit(default)
    for code, label in reversed(pairs):
        out = F.when(x == code, label).otherwise(out)
    return out


def flag(country: Column, known: list[str]) -> Column:
    """The flag of a two-letter code: two regional indicator symbols; '' for other countries."""
    byte = lambda i: F.hex(F.ascii(F.substring(country, i, 1)) + (0xA6 - 65))
    text = F.concat(F.lit("F09F87"), byte(1), F.lit("F09F87"), byte(2))
    return F.when(country.isin(*known), F.decode(F.unhex(text), "UTF-8")).otherwise("")
