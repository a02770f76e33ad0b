"""Currency conversion and calendar helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from ledgerline.schemas import MONEY_EUR


def to_eur(amount: Column | str, rate: Column | str) -> Column:
    """Convert one amount and round it to cents, half away from zero.

    Rounding happens per invoice, before any sum, so that totals add up from the rows shown.
    """
    product = (F.col(amount) if isinstance(amount, str) else amount) * (
        F.col(rate) if isinstance(rate, str) else rate
    )
    return F.round(product, 2).cast(MONEY_EUR)


def month_of(day: Column | str) -> Column:
    """First day of the month, as a date."""
    return F.trunc(day, "MM")


def as_of_date(as_of: dt.date | str | None) -> Column:
    """The day a run is judged against; today unless one is given."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
