"""Quality report, dedup, unions and predicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions import labels
from gaugeline.sources.workspace import broadcast_if_small, stage_table

COPIES = "_copies"


#: Repeated fingerprints that are sent to every task, 16 bytes each; beyond, whole rows are compared.
REPEATED_ROWS = 500_000
#: Columns whose nulls one number marks.
MARKS = 63


def row_fingerprint(columns: Sequence[str], seed: int = 0) -> Column:
    """64 bits of a row's content; rows that Spark counts as equal have equal fingerprints.

    Hashes pass over nulls, so the places of the nulls are hashed as well.
    """
    nulls = [
        reduce(Column.bitwiseOR, [F.when(F.col(f"`{c}`").isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, c in enumerate(columns[at : at + MARKS])])
        for at in range(0, len(columns), MARKS)
    ]
    return F.xxhash64(F.lit(seed), *nulls, *[F.col(f"`{c}`") for c in columns])


def repeated_fingerprints(df: DataFrame) -> DataFrame:
    """``(_f0, _f1)`` of which there is more than one row: 128 bits a row are shuffled, whatever the columns."""
    marked = df.select(*[row_fingerprint(df.columns, seed).alias(f"_f{seed}") for seed in (0, 1)])
    return marked.groupBy("_f0", "_f1").agg(F.count(F.lit(1)).alias(COPIES)).filter(F.col(COPIES) > 1).drop(COPIES)


def collapse_copies(df: DataFrame) -> DataFrame:
    """Distinct rows with the number of their copies.

    Only 128-bit fingerprints are shuffled to find which occur more than once.  Rows of any other
    fingerprint are distinct and stay where they are.  Rows of repeated ones are compared as a
    whole, combined map-side, so equal fingerprints alone merge nothing, and a row repeated a billion
    times costs one record per task.  With more than ``REPEATED_ROWS`` repeated fingerprints all
    rows are compared as a whole.  The frame is read twice: pass a table or a stage.
    """
    if not df.columns or _nested(df):
        return _compare_rows(df)
    repeated = stage_table(repeated_fingerprints(df), "repeated")
    if repeated.isEmpty():
        return df.withColumn(COPIES, F.lit(1).cast("bigint"))
    marks = broadcast_if_small(repeated, REPEATED_ROWS)
    if marks is repeated:
        return _compare_rows(df)
    marked = df.withColumns({f"_f{seed}": row_fingerprint(df.columns, seed) for seed in (0, 1)})
    alone = marked.join(marks, ["_f0", "_f1"], "left_anti").drop("_f0", "_f1")
    again = marked.join(marks, ["_f0", "_f1"], "left_semi").drop("_f0", "_f1")
    return alone.withColumn(COPIES, F.lit(1).cast("bigint")).unionByName(_compare_rows(again))


def _compare_rows(df: DataFrame) -> DataFrame:
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(COPIES))


def _nested(df: DataFrame) -> bool:
    """Whether a column holds values whose inner nulls a hash would pass over."""
    return any("<" in f.dataType.simpleString() or f.dataType.simpleString() == "variant" for f in df.schema)


def quality_of_groups(
    groups: DataFrame, features: Sequence[str], has_label: bool, null_checked: int | None = None
) -> DataFrame:
    """Long table ``(metric, value)`` from collapsed rows: every metric is a weighted sum.

    Nulls are counted in the label, the time if there is one, and all features, or only the first
    ``null_checked`` of them.
    """
    timed = [c for c in ("timestamp",) if c in groups.columns]
    checked = ["class", *timed, *features[:null_checked]]
    copies = F.col(COPIES)
    totals = groups.agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(copies - 1), F.lit(0)).alias("duplicate_rows"),
        *[
            F.coalesce(F.sum(F.when(F.col(c).isNull(), copies)), F.lit(0)).alias(f"null_{c}")
            for c in checked
        ],
    ).withColumn("ground_truth_label_available", F.lit(int(has_label)).cast("bigint"))
    names = ["ground_truth_label_available", "total_rows", "duplicate_rows", *[f"null_{c}" for c in checked]]
    return totals.unpivot([], names, "metric", "value")


def quality_report(
    df: DataFrame, features: Sequence[str], has_label: bool, null_checked: int | None = None
) -> DataFrame:
    """All quality metrics from one scan and one shuffle of fixed width.

    Rows meet by a 128-bit fingerprint with their null marks.  A third hash must agree within a
    fingerprint: were two different rows ever to share one, the report is an error, not a wrong count.
    Tables with nested columns are compared as whole rows.
    """
    checked = ["class", *[c for c in ("timestamp",) if c in df.columns], *features[:null_checked]]
    if _nested(df):
        return quality_of_groups(_compare_rows(df), features, has_label, null_checked)
    marks = [
        reduce(Column.bitwiseOR, [F.when(F.col(f"`{c}`").isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, c in enumerate(checked[at : at + MARKS])])
        for at in range(0, len(checked), MARKS)
    ]
    slim = df.select(
        *[row_fingerprint(df.columns, seed).alias(f"_f{seed}") for seed in (0, 1, 2)], *[m.alias(f"_m{i}") for i, m in enumerate(marks)]
    )
    met = slim.groupBy("_f0", "_f1").agg(
        F.count(F.lit(1)).alias(COPIES),
        (F.min("_f2") != F.max("_f2")).alias("_differ"),
        *[F.first(f"_m{i}").alias(f"_m{i}") for i in range(len(marks))],
    )
    copies = F.col(COPIES)
    absent = {
        f"null_{c}": F.when(F.col(f"_m{i // MARKS}").bitwiseAND(F.lit(1 << (i % MARKS))) != 0, copies) for i, c in enumerate(checked)
    }
    zero = F.lit(0)
    shared = F.raise_error(F.lit("different rows share a fingerprint: take quality_of_groups of collapse_copies"))
    totals = met.agg(
        F.when(F.max("_differ"), shared).otherwise(F.coalesce(F.sum(copies), zero)).cast("bigint").alias("total_rows"),
        F.coalesce(F.sum(copies - 1), zero).alias("duplicate_rows"),
        *[F.coalesce(F.sum(v), zero).alias(name) for name, v in absent.items()],
    ).withColumn("ground_truth_label_available", F.lit(int(has_label)).cast("bigint"))
    names = ["ground_truth_label_available", "total_rows", "duplicate_rows", *absent]
    return totals.unpivot([], names, "metric", "value")


def dedup_rows(df: DataFrame) -> DataFrame:
    return collapse_copies(df).drop(COPIES)


def clean_rows(df: DataFrame) -> DataFrame:
    """Dedup over all columns, then the trimmed lower-case label."""
    return dedup_rows(df).withColumn("class", labels.clean_label("class"))


def distinct_labels(df: DataFrame, label: str = "class") -> DataFrame:
    return df.select(label).distinct().orderBy(label)


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, others, first)


def has_ground_truth(df: DataFrame, label: str = "class") -> bool:
    """Whether any row carries a real label; stops at the first one found."""
    return not df.filter(F.col(label) != labels.UNLABELLED).isEmpty()
