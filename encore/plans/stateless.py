"""Record-at-a-time pipelines: filters, projections, branches, merges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import address_line, birth_year

PRIORITY_STATE = "MN"          # addresses of this state go to the priority output
TARGET_BIRTH_YEARS = (1990, 2000)  # born in [1990, 2000)


def merge_customers(current: DataFrame, legacy: DataFrame) -> DataFrame:
    """Both customer feeds as one stream (UNION ALL; duplicates kept)."""
    return current.unionByName(legacy)


def target_customer_filter(current: DataFrame, legacy: DataFrame) -> DataFrame:
    """Customers born in the 1990s, from the current and the legacy feed.

    A birth date whose year part is not a number yields null and is dropped.
    """
    lo, hi = TARGET_BIRTH_YEARS
    y = birth_year(F.col("birthdt"))
    return (merge_customers(current, legacy)
            .filter((y >= lo) & (y < hi))
            .select("id", "fullname", "birthdt", "feed"))


def address_stringify(address: DataFrame) -> DataFrame:
    """Every address as ``(state, one-line text)``."""
    return address.select("id", "state", address_line().alias("address"))


def _is_priority(state: str):
    return F.col("state").eqNullSafe(F.lit(state))


def address_split_priority(address: DataFrame, state: str = PRIORITY_STATE) -> DataFrame:
    return address_stringify(address.filter(_is_priority(state)))


def address_split_default(address: DataFrame, state: str = PRIORITY_STATE) -> DataFrame:
    """Everything not in the priority state, including addresses without a state."""
    return address_stringify(address.filter(~_is_priority(state)))


def split_addresses_by_owner(address: DataFrame) -> DataFrame:
    """Label each address as a customer's or a venue's (venues have no customer)."""
    owner = F.when(F.col("customerid").isNull(), F.lit("venue")).otherwise(F.lit("customer"))
    return address.select("id", "customerid", "state", owner.alias("owner"))
