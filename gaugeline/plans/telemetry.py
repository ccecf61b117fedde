"""The sensor table used by the registered queries: ``lineitem`` read as compressor telemetry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions import keys
from gaugeline.operators.enrich import enrich
from gaugeline.operators.features import with_risk_scores
from gaugeline.operators.schema import normalize_class

SENSORS = (
    "tp2", "tp3", "h1", "dv_pressure", "reservoirs", "oil_temperature", "motor_current",
    "comp", "towers", "lps",
)
KEY = "row_key"


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide sensor rows with a unique text key, a time and a raw label."""
    quantity, price, discount = F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_discount")
    flag, line = F.col("l_returnflag"), F.col("l_linenumber")
    return lineitem(spark, sf_dir).select(
        keys.row_key("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias(KEY),
        F.col("l_shipdate").alias("timestamp"),
        quantity.alias("tp2"),
        price.alias("tp3"),
        F.nullif(discount, F.lit(0.0)).alias("h1"),
        F.col("l_tax").alias("dv_pressure"),
        (quantity * (1 - discount)).alias("reservoirs"),
        (price / quantity).alias("oil_temperature"),
        (price * discount).alias("motor_current"),
        flag.isin("N", "R").cast("int").alias("comp"),
        (flag == "R").cast("int").alias("towers"),
        (line % 5 == 0).cast("int").alias("lps"),
        F.when(line == 7, "Service")
        .when(F.col("l_linestatus") == "F", "Fault")
        .otherwise("Normal")
        .alias("label"),
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry(spark, sf_dir).withColumnRenamed("label", "class").transform(normalize_class)


def featured(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    return with_risk_scores(enrich(labelled(spark, sf_dir)), SENSORS)


def deviation_score() -> Column:
    """A plain score that any SQL engine computes to the same bits: distance from a set point."""
    return F.abs(F.col("tp3") - F.lit(38000.0)) / F.lit(20000.0)
