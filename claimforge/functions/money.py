"""Amounts: parsing with its several rules, formatting, ranges and size tiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(15,2)"


def _number(text: Column, pattern: str = r"^[0-9]+(\.[0-9]+)?$") -> Column:
    return F.when(text.rlike(pattern), text.try_cast(MONEY))


def safe_numeric(text: Column) -> Column:
    """Digits and dots only, so a minus sign is lost; null unless a number is left."""
    return _number(F.regexp_replace(F.coalesce(text, F.lit("")), "[^0-9.]", ""))


def claim_amount(text: Column) -> Column:
    """Digits and dots only; a dot may stand first or last. Null unless a number is left."""
    return _number(F.regexp_replace(F.coalesce(text, F.lit("")), "[^0-9.]", ""), r"^([0-9]+\.?[0-9]*|\.[0-9]+)$")


def loss_amount(text: Column) -> Column:
    """Digits, dot and minus; null where that is no number."""
    return _number(F.regexp_replace(F.coalesce(text, F.lit("")), "[^0-9.-]", ""), r"^-?[0-9]+(\.[0-9]+)?$")


def sort_amount(text: Column) -> Column:
    return F.coalesce(loss_amount(text), F.lit(0).cast(MONEY))


def dollars(amount: Column) -> Column:
    return F.when(amount.isNull(), "").otherwise(F.concat(F.lit("$"), F.format_number(amount, 2)))


def midpoint(low: Column, high: Column) -> Column:
    """The mean of both ends, or the one that is given."""
    return F.when(low.isNotNull() & high.isNotNull(), (low + high) / 2).otherwise(F.coalesce(low, high))


def whole_midpoint(low: Column, high: Column) -> Column:
    both = ((low + high) / 2).cast("long")  # towards zero
    return F.when(low.isNotNull() & high.isNotNull(), both).otherwise(F.coalesce(low, high).cast("long"))


# Tier, label, least revenue, least employees.
TIERS = ((1, "Enterprise", 1_000_000_000, 5000), (2, "Mid-Market", 100_000_000, 500), (3, "SMB", 0, 0))


def tier_by_table(revenue: Column, employees: Column, tiers=TIERS) -> tuple[Column, Column]:
    """The first tier whose revenue or head count is reached, and what it was matched on."""
    tier, why = F.lit(None).cast("int"), F.lit(None).cast("string")
    for number, _, least_revenue, least_employees in reversed(tiers):
        rich = F.coalesce(revenue >= least_revenue, F.lit(False))
        many = F.coalesce(employees >= least_employees, F.lit(False))
        tier = F.when(rich | many, number).otherwise(tier)
        why = F.when(rich & many, "revenue_and_employees").when(rich, "revenue").when(many, "employees").otherwise(why)
    nothing = revenue.isNull() & employees.isNull()
    last = tiers[-1][0]
    return (
        F.when(nothing, last).otherwise(F.coalesce(tier, F.lit(last))),
        F.when(nothing, "default_null_firmographics").otherwise(F.coalesce(why, F.lit("fallback_smb"))),
    )


def tier_by_constants(revenue_thousands: Column, employees: Column) -> Column:
    """The same limits on revenue in thousands, and null where neither is known."""
    tier = (
        F.when((revenue_thousands >= 1_000_000) | (employees >= 5000), 1)
        .when((revenue_thousands >= 100_000) | (employees >= 500), 2)
        .otherwise(3)
    )
    return F.when(revenue_thousands.isNotNull() | employees.isNotNull(), tier)


def schedule_cost(pages: Column) -> Column:
    return F.least(pages * F.lit(0.1), F.lit(4.5)).cast("decimal(6,2)")
