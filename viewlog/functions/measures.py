"""Duration, category and activation expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from viewlog import schema
from viewlog.functions.calendar import col


def hours(seconds: Column | str) -> Column:
    """Seconds as double hours."""
    return col(seconds) / F.lit(3600.0)


def whole_seconds(text: Column | str) -> Column:
    """Seconds from a number or its text; a fraction is cut off, what is no number becomes NULL."""
    return col(text).try_cast("decimal(38,9)").try_cast("bigint")


def or_zero(value: Column | str) -> Column:
    return F.coalesce(col(value), F.lit(0))


def category_of(app: Column | str = "AppName", labels: str = "vi") -> Column:
    """Category label of an application; anything unlisted, NULL included, is the unknown label."""
    app = col(app)
    known = reduce(
        lambda chain, c: chain.when(app.isin(*c.apps), schema.label_of(c, labels)),
        schema.CATEGORIES[1:],
        F.when(app.isin(*schema.CATEGORIES[0].apps), schema.label_of(schema.CATEGORIES[0], labels)),
    )
    return known.otherwise(schema.label_of(schema.UNKNOWN, labels))


def known_app_or_other(app: Column | str = "AppName") -> Column:
    """Application name with every unlisted one, NULL included, folded into one placeholder."""
    app = col(app)
    return F.when(app.isin(*schema.KNOWN_APPS), app).otherwise(schema.OTHER_APP)


def best_duration(durations: Sequence[Column]) -> Column:
    """Largest duration of the row, never below 0 and never NULL."""
    return F.greatest(*[or_zero(d) for d in durations], F.lit(0))


def best_label(durations: Sequence[Column], labels: Sequence[str]) -> Column:
    """Label of the largest positive duration; the earlier one on a tie, NULL if none is positive."""
    top = best_duration(durations)
    winners = [F.when((d == top) & (top > 0), F.lit(name)) for d, name in zip(durations, labels)]
    return F.coalesce(*winners)


def level_of(days: Column | str, limits: Sequence[int], levels: Sequence[str]) -> Column:
    """Name of the band that ``days`` falls in; NULL days have no band."""
    days = col(days)
    low, middle = limits
    return (
        F.when(days.isNull(), None)
        .when(days < low, levels[0])
        .when(days < middle, levels[1])
        .otherwise(levels[2])
    )


def whole_average(value: Column | str) -> Column:
    """Integer average that drops the fraction, as integer columns average in the marts."""
    name = col(value)
    return F.call_function("div", F.sum(name), F.count(name))


def byte_length(*values: Column | str) -> Column:
    """UTF-8 bytes of the values written as text, NULL counting 0."""
    sizes = [F.coalesce(F.octet_length(col(v).cast("string")), F.lit(0)) for v in values]
    return reduce(lambda a, b: a + b, sizes).cast("bigint")
