"""Date text handling. Dates arrive as text; bad text gives null, never an error."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def birth_year(birthdt: Column) -> Column:
    """Year of a ``YYYY-MM-DD`` text: the part before the first ``-`` as int."""
    return F.split(birthdt, "-").getItem(0).try_cast("int")


def parse_day(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.try_to_timestamp(text, F.lit(pattern))
