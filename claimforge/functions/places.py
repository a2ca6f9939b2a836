"""States, cities, addresses, courts and case numbers, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# How addresses end, and how case numbers are spelled.
ADDRESS_STATE = r"(?:,\s*|\s+)([A-Z]{2})\s*(?:\d{5}(?:-\d{4})?)?\s*$"
LAST_CITY = r",\s*([^,]+)\s*,\s*[A-Z]{2}\s*(?:\d{5}(?:-\d{4})?)?\s*$"
STREET_CITY = r"^\s*\d+[^,]*,\s*([^,]+)\s*,\s*[A-Z]{2}"
DOCKET_SHAPES = (r"(?i)(\d{2})-?bk-?(\d+)", r"(\d{2}-\d+)")


def found(text: Column, pattern: str, group: int = 1) -> Column:
    """The group's first match, null where there is none or it is empty."""
    return F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), pattern, group), F.lit(""))


def address_state(address: Column, fallback: Column) -> Column:
    return F.upper(F.coalesce(found(address, ADDRESS_STATE), F.nullif(F.trim(fallback), F.lit(""))))


def address_city(address: Column) -> Column:
    return F.nullif(F.trim(F.coalesce(found(address, LAST_CITY), found(address, STREET_CITY))), F.lit(""))


def state_code(state: Column) -> Column:
    """Two letters in upper case, else null."""
    return F.when(F.trim(state).rlike("^[A-Za-z]{2}$"), F.upper(F.trim(state)))


def city_state(city: Column, state: Column) -> Column:
    return F.nullif(F.concat_ws(", ", F.nullif(F.trim(city), F.lit("")), F.nullif(F.trim(state), F.lit(""))), F.lit(""))


def docket_number(case: Column) -> Column:
    """Year and serial of a bankruptcy case number in any of its spellings, else the number as it is."""
    year, serial = (found(case, DOCKET_SHAPES[0], g) for g in (1, 2))
    return F.coalesce(F.concat(year, F.lit("-"), serial), found(case, DOCKET_SHAPES[1]), case, F.lit(""))


def document_key(case: Column) -> Column:
    return F.concat(F.lit("cases/"), F.regexp_replace(case, r"[^A-Za-z0-9._-]", "-"), F.lit(".pdf"))


def court_base(court: Column) -> Column:
    """A court's district: without the trailing k of bankruptcy courts, with one corrected name."""
    low = F.lower(F.trim(court))
    cut = F.when(low.endswith("k"), F.expr("1")).otherwise(F.expr("0"))
    out = F.substring(low, F.lit(1), F.length(low) - cut)
    return F.when(out == "maeb", "mieb").otherwise(out)


def filled_template(identity: Column, template: str) -> Column:
    clean = F.trim(identity)
    return F.when(identity.isNull() | (clean == ""), "").otherwise(F.replace(F.lit(template), F.lit("{id}"), clean))
