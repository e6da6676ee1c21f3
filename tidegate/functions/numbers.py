"""Business formulas; divisions by zero give NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def revenue(price: Column, quantity: Column) -> Column:
    return price * quantity


def percentage(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole) * 100


def growth_rate(current: Column, previous: Column) -> Column:
    return F.try_divide(current - previous, previous) * 100
