"""Pipeline metrics without per-row logging (``observe``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str, **conditions: Column) -> tuple[DataFrame, Observation]:
    """Attach row counts (total and per condition) computed while the plan runs.

    The counts are aggregated on the executors alongside the job and read from
    ``observation.get`` after an action: numbers reach the driver, rows do not.
    """
    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("rows")]
    exprs += [F.count(F.when(c, F.lit(1))).alias(k) for k, c in conditions.items()]
    return df.observe(obs, *exprs), obs
