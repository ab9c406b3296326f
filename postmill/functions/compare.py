"""How alike two values are: DIFFERENT < REVIEW < LIKELY < EXACT, as integer columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from postmill.functions.geo import haversine
from postmill.functions.text import STOP_WORDS, core, expand, fold, number_key, postcode_key, without
from postmill.schema import DIFFERENT, EXACT, LIKELY, REVIEW


def field_compare(a: Column, b: Column, status: Callable[[Column, Column], Column]) -> Column:
    """DIFFERENT if any is null, EXACT if both are the same, else the status."""
    return F.when(a.isNull() | b.isNull(), DIFFERENT).when(a == b, EXACT).otherwise(status(a, b))


def opt_field_compare(a: Column, b: Column, status: Callable[[Column, Column], Column]) -> Column:
    """The same, but two nulls are EXACT."""
    return F.when(a.isNull() & b.isNull(), EXACT).otherwise(field_compare(a, b, status))


def by_key(key: Callable[[Column], Column]) -> Callable[[Column, Column], Column]:
    return lambda a, b: F.when(key(a) == key(b), EXACT).otherwise(DIFFERENT)


number_status = by_key(number_key)
name_status = by_key(fold)
postcode_status = by_key(postcode_key)


def street_status(a: Column, b: Column) -> Column:
    x, y = expand(fold(a)), expand(fold(b))
    return _street(x, y, without(x, STOP_WORDS), without(y, STOP_WORDS), core(x), core(y))


def _street(x: Column, y: Column, light_x: Column, light_y: Column, core_x: Column, core_y: Column) -> Column:
    return F.when(x == y, EXACT).when(light_x == light_y, LIKELY).when(core_x == core_y, REVIEW).otherwise(DIFFERENT)


#: Columns that `with_keys` adds: every normal form once for each row, not once for each pair.
KEYS = ("k_number", "k_street", "k_light", "k_core", "k_city", "k_postcode")


def with_keys(addresses):
    """The frame with the normal forms that `is_duplicate` compares."""
    folded = addresses.withColumns({"k_number": number_key(F.col("number")), "k_street": expand(fold(F.col("street"))), "k_city": fold(F.col("city")), "k_postcode": postcode_key(F.col("postcode"))})
    return folded.withColumns({"k_light": without(F.col("k_street"), STOP_WORDS), "k_core": core(F.col("k_street"))})


def is_duplicate(a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
    """Whether two rows with keys are one address. a and b give the columns of either side by name.

    Under 10 m: same number and at least a REVIEW of the street; under 100 m: at least LIKELY;
    under 1 km: number, street, city and postcode EXACT. The distance comes first.
    """
    distance = haversine(a("lat"), a("lon"), b("lat"), b("lon"))
    number = opt_field_compare(a("number"), b("number"), lambda *_: F.when(a("k_number") == b("k_number"), EXACT).otherwise(DIFFERENT))
    street = field_compare(a("street"), b("street"), lambda *_: _street(*(s(k) for k in ("k_street", "k_light", "k_core") for s in (a, b))))
    city = field_compare(a("city"), b("city"), lambda *_: F.when(a("k_city") == b("k_city"), EXACT).otherwise(DIFFERENT))
    postcode = field_compare(a("postcode"), b("postcode"), lambda *_: F.when(a("k_postcode") == b("k_postcode"), EXACT).otherwise(DIFFERENT))
    near = (distance < 10) & (street >= REVIEW) | (distance < 100) & (street >= LIKELY) | (street == EXACT) & (city == EXACT) & (postcode == EXACT)
    return (distance < 1000) & (number == EXACT) & near
