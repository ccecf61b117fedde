"""Column names, label discovery, feature choice and label clean-up."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.functions import labels

# ``c0`` is what an unnamed CSV index column becomes once cleaned.
INDEX_COLUMNS = ("unnamed_0", "c0")
NON_FEATURES = ("class", "timestamp")


def clean_names(names: Iterable[str]) -> list[str]:
    """Lower-case words joined by ``_``; repeats are numbered with the first free suffix."""
    wanted = ["_".join(re.findall(r"[a-z0-9]+", name.lower())) or "col" for name in names]
    taken = set(wanted)
    seen: Counter[str] = Counter()
    result = []
    for name in wanted:
        seen[name] += 1
        if seen[name] > 1:
            number = seen[name]
            while f"{name}_{number}" in taken:
                number += 1
            seen[name] = number
            name = f"{name}_{number}"
            taken.add(name)
        result.append(name)
    return result


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Rename by position, as renaming by name would hit every case variant at once."""
    return df.toDF(*clean_names(df.columns))


def lowercase_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip().lower() for name in df.columns])


def drop_index_columns(df: DataFrame, names: Sequence[str] = INDEX_COLUMNS) -> DataFrame:
    return df.drop(*names)


def parse_timestamp(df: DataFrame, column: str = "timestamp", fmt: str | None = None) -> DataFrame:
    """Text to timestamp; unreadable text becomes null (see ``timestamp_failures``)."""
    if column not in df.columns:
        return df
    if isinstance(df.schema[column].dataType, T.StringType):
        parsed = F.try_to_timestamp(column, F.lit(fmt)) if fmt else F.try_to_timestamp(column)
    else:
        parsed = F.col(column).cast("timestamp")
    return df.withColumn(column, parsed)


def timestamp_failures(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Quality metric over the unparsed text: values that are present but unreadable.

    A table without the column, or with times already typed, has none.
    """
    if column not in df.columns or not isinstance(df.schema[column].dataType, T.StringType):
        return df.sparkSession.range(1).select(
            F.lit(f"unparsed_{column}").alias("metric"), F.lit(0).cast("bigint").alias("value")
        )
    broken = F.col(column).isNotNull() & F.try_to_timestamp(F.col(column).cast("string")).isNull()
    return df.agg(F.count_if(broken).alias("value")).select(
        F.lit(f"unparsed_{column}").alias("metric"), "value"
    )


def find_label(df: DataFrame, candidates: Sequence[str] = labels.LABEL_CANDIDATES) -> str | None:
    return next((name for name in candidates if name in df.columns), None)


def rename_label(df: DataFrame, candidates: Sequence[str] = labels.LABEL_CANDIDATES) -> DataFrame:
    found = find_label(df, candidates)
    return df if found in (None, "class") else df.withColumnRenamed(found, "class")


def select_features(df: DataFrame, exclude: Sequence[str] = NON_FEATURES) -> list[str]:
    """Names of the numeric (decimal included) and boolean columns that are not label or time."""
    found = [
        field.name
        for field in df.schema
        if field.name not in exclude and isinstance(field.dataType, (T.NumericType, T.BooleanType))
    ]
    if not found:
        raise ValueError("no numeric or boolean column to use as a feature")
    return found


def normalize_class(df: DataFrame, **vocabulary: object) -> DataFrame:
    """Normalised label, or the constant ``unknown`` when the table has none."""
    if "class" not in df.columns:
        return df.withColumn("class", F.lit(labels.UNLABELLED))
    return df.withColumn("class", labels.normalize_label("class", **vocabulary))


class Ingested(NamedTuple):
    frame: DataFrame
    features: list[str]
    has_label: bool


def ingest(raw: DataFrame, index_columns: Sequence[str] = INDEX_COLUMNS) -> Ingested:
    """Names, index columns, timestamp, label and feature list of a raw table."""
    df = (
        sanitize_columns(raw)
        .transform(drop_index_columns, index_columns)
        .transform(parse_timestamp)
        .transform(rename_label)
    )
    has_label = "class" in df.columns
    features = select_features(df)
    return Ingested(normalize_class(df), features, has_label)
