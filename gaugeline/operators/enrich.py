"""Operating mode and its risk lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions import modes
from gaugeline.sources.workspace import broadcast_if_small


def mode_lookup(spark: SparkSession) -> DataFrame:
    """The fixed lookup as an inline table, planned without a Python data source."""
    rows = ", ".join(f"('{mode}', '{risk}', '{priority}')" for mode, risk, priority in modes.MODE_LOOKUP)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(operating_mode, mode_risk, maintenance_priority)")


def with_operating_mode(df: DataFrame) -> DataFrame:
    """``unknown`` throughout when the table lacks one of the sensors the rules read."""
    known = modes.MODE_INPUTS <= set(df.columns)
    return df.withColumn(
        "operating_mode", modes.operating_mode() if known else F.lit(modes.UNKNOWN_MODE)
    )


def join_mode_risk(df: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """Left join to the lookup; a mode it lacks becomes ``unknown`` / ``investigate``.

    The built-in lookup has five rows and is broadcast.  A caller's lookup is broadcast
    only after its row count was checked.
    """
    side = F.broadcast(mode_lookup(df.sparkSession)) if lookup is None else broadcast_if_small(lookup)
    return df.join(side, "operating_mode", "left").withColumns(
        {
            "mode_risk": F.coalesce("mode_risk", F.lit(modes.DEFAULT_RISK)),
            "maintenance_priority": F.coalesce("maintenance_priority", F.lit(modes.DEFAULT_PRIORITY)),
        }
    )


def enrich(df: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    return join_mode_risk(with_operating_mode(df), lookup)
