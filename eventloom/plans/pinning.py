"""Keep a row filter where it is written.

Catalyst pushes a filter down through every deterministic projection and
substitutes the projected expressions into the predicate. For a predicate over
columns that are themselves built from many nested expressions (a row's
rejection reason depends on every rule of a contract), that substitution
copies the whole projection chain into the predicate: the work is done twice
and the generated code outgrows the JVM's method limit. A non-deterministic
column in the projection right under the filter (here the partition id, which
costs nothing) stops the pushdown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def filter_here(df: DataFrame, condition: str) -> DataFrame:
    """``df.filter(condition)``, evaluated on ``df``'s own output columns."""
    pinned = df.selectExpr("*", "spark_partition_id() AS __pin")
    return pinned.filter(f"({condition}) AND __pin >= 0").drop("__pin")


def pinned_stage(df: DataFrame) -> DataFrame:
    """Ends a projection here: the next one is not merged with it. A filter on a non-deterministic column
    stays where it is, and no projection passes it."""
    return df.selectExpr("*", "spark_partition_id() AS __stage").filter("__stage >= 0").drop("__stage")
