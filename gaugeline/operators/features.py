"""Risk scores, feature vectors, null filling and standardising."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add
from typing import NamedTuple

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions import modes

# Sensors preferred for the risk score, in summation order.
PREFERRED_RISK_SENSORS = (
    "dv_pressure", "reservoirs", "oil_temperature", "motor_current", "tp2", "tp3", "h1",
)
FALLBACK_RISK_SENSORS = 6


class SensorRiskScore(
    Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Adds the sum of the input sensors; a null input makes the score null, no input makes it 0."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCol: str = "sensor_risk_score"):
        super().__init__()
        self._setDefault(inputCols=[], outputCol="sensor_risk_score")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def setInputCols(self, value: list[str]) -> SensorRiskScore:
        return self._set(inputCols=value)

    def setOutputCol(self, value: str) -> SensorRiskScore:
        return self._set(outputCol=value)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        sensors = [F.col(name).cast("double") for name in self.getInputCols()]
        return dataset.withColumn(self.getOutputCol(), reduce(add, sensors) if sensors else F.lit(0.0))


def risk_columns(features: Sequence[str]) -> list[str]:
    preferred = [c for c in PREFERRED_RISK_SENSORS if c in features]
    return preferred or list(features[:FALLBACK_RISK_SENSORS])


def with_risk_scores(df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Adds both scores; returns the frame and the model's full column list."""
    scored = SensorRiskScore(inputCols=risk_columns(features)).transform(df)
    scored = scored.withColumn("mode_risk_score", modes.mode_risk_ordinal())
    return scored, [*features, "sensor_risk_score", "mode_risk_score"]


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Vector column; nulls are kept as NaN."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="keep").transform(df)


def fill_features(df: DataFrame, columns: Sequence[str], value: float = 0.0) -> DataFrame:
    """Nulls and NaN to a constant, after casting flags and integers to double."""
    filled = {c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(value)), F.lit(value)) for c in columns}
    return df.withColumns(filled)


class Scaling(NamedTuple):
    """Mean and scale of each column, as measured on one frame."""

    columns: list[str]
    means: list[float]
    scales: list[float]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
                for c, m, s in zip(self.columns, self.means, self.scales, strict=True)
            }
        )


def fit_scaling(df: DataFrame, columns: Sequence[str]) -> Scaling:
    """One aggregate over the frame; population deviation, and scale 1 where it is 0 or missing."""
    row = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return Scaling(
        list(columns),
        [row[f"m{i}"] or 0.0 for i in range(len(columns))],
        [row[f"s{i}"] or 1.0 for i in range(len(columns))],
    )
