"""Ticket request outcome from the remaining capacity after the request."""

from pyspark.sql import Column
from pyspark.sql import functions as F

CONFIRMED, REJECTED = "CONFIRMED", "REJECTED"
SOLD_OUT, LIMITED, OPEN = "SOLD_OUT", "LIMITED", "OPEN"
LIMITED_PCT = 20.0          # at or below this share left, availability is limited


def confirmation_status(remaining: Column) -> Column:
    return F.when(remaining >= 0, F.lit(CONFIRMED)).otherwise(F.lit(REJECTED))


def remaining_pct(remaining: Column, capacity: Column) -> Column:
    """Share of the capacity still free, in percent; 0 once oversold."""
    return F.when(remaining < 0, F.lit(0.0)).otherwise(
        remaining.cast("double") / capacity.cast("double") * 100.0)


def ticket_tier(remaining: Column, capacity: Column) -> Column:
    """First match of: sold out, limited (<= 20 % left), open (> 20 % left)."""
    pct = remaining_pct(remaining, capacity)
    return (F.when(remaining < 0, F.lit(SOLD_OUT))
             .when(pct <= LIMITED_PCT, F.lit(LIMITED))
             .when(pct > LIMITED_PCT, F.lit(OPEN)))
