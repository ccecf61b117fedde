"""Ground-truth label vocabulary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Column names searched for the label, and the spellings of each class.
LABEL_CANDIDATES = ("class", "result", "label", "target")
POSITIVE_SPELLINGS = ("1", "true", "malware", "anomaly", "fault")
NEGATIVE_SPELLINGS = ("0", "false", "benign", "normal")
POSITIVE = "malware"
NEGATIVE = "benign"
UNLABELLED = "unknown"


def clean_label(label: Column | str) -> Column:
    label = F.col(label) if isinstance(label, str) else label
    return F.lower(F.trim(label.cast("string")))


def normalize_label(
    label: Column | str,
    positive: str = POSITIVE,
    negative: str = NEGATIVE,
    positive_spellings: Sequence[str] = POSITIVE_SPELLINGS,
    negative_spellings: Sequence[str] = NEGATIVE_SPELLINGS,
) -> Column:
    """Map known spellings to the two class names; other labels stay, a null label stays null.

    Blanks are trimmed before matching, so ``' Fault '`` counts as positive.
    """
    text = clean_label(label)
    return (
        F.when(text.isin(*positive_spellings), positive)
        .when(text.isin(*negative_spellings), negative)
        .otherwise(text)
    )


def is_positive(label: Column | str, positive: str = POSITIVE) -> Column:
    """1 for the positive class, 0 for any other label and for null."""
    label = F.col(label) if isinstance(label, str) else label
    return F.coalesce(label == F.lit(positive), F.lit(False)).cast("int")
