"""Column expressions that carry a planning meaning."""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfcast.sources.contracts import MONEY

# Lead-time bands as (inclusive upper limit in days, label); the last one has no limit.
LEAD_TIME_BANDS: tuple[tuple[int | None, str], ...] = (
    (30, "≤30 Days"),
    (60, "31–60 Days"),
    (90, "61–90 Days"),
    (None, ">90 Days"),
)


def any_of(conditions: Iterable[Column]) -> Column:
    return functools.reduce(operator.or_, conditions)


def all_of(conditions: Iterable[Column]) -> Column:
    return functools.reduce(operator.and_, conditions)


def equals_all(values: Mapping[str, object]) -> Column:
    """Every column has its value; None stands for NULL."""
    return all_of(F.col(name).isNull() if value is None else F.col(name) == F.lit(value) for name, value in values.items())


def lead_time_band(days: Column, *, unknown: str | None = None) -> Column:
    """Band label of a lead time. A NULL lead time counts as open-ended unless ``unknown`` names a band for it."""
    *limited, (_, open_ended) = LEAD_TIME_BANDS
    labelled = [F.when(days <= limit, label) for limit, label in limited]
    missing = [F.when(days.isNull(), unknown)] if unknown else []
    return F.coalesce(*missing, *labelled, F.lit(open_ended))


def lead_time_band_order(band: Column) -> Column:
    """Position of a band for presentation: the labels do not sort by length of the lead time."""
    labels = F.array(*[F.lit(label) for _, label in LEAD_TIME_BANDS])
    return F.nullif(F.array_position(labels, band), F.lit(0)).cast("int")


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, one decimal; NULL when the whole is zero or NULL."""
    return F.round(F.try_divide(part, whole) * 100, 1)


def worth(units: Column, price: Column) -> Column:
    """Units at a unit price, in cents' precision; NULL when either is NULL."""
    return F.round(units * price, 2).cast(MONEY)


def shortfall(inventory: Column) -> Column:
    """Units missing below zero; 0 for a positive or unknown inventory."""
    return F.when(inventory < 0, -inventory).otherwise(0)
