"""The training-data pipeline: each stage reads what the stage before it wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import packing, quality_rules, queries, secrets, simhash, suffix_dedup
from gaugeline.llm.common import ranked, table, text_or_empty
from gaugeline.sources.workspace import stage_table

SECRET_MARK = "[SECRET]"


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of the documents has, in either case of letters."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def own_columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    (verdict,) = free_names(docs, "_quality")
    judged = quality_rules.judge(docs, out=verdict)
    return judged.filter(F.col(verdict)["kept"]).select(*own_columns(docs))


def with_row_key(docs: DataFrame, row: str) -> DataFrame:
    """Adds ``row``, one number for every row, in the order of the ids; rows without an id come last.

    Ids that are whole numbers, unique and not null are their own keys; otherwise rows are ranked and staged.
    """
    whole = docs.schema["doc_id"].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    copies = docs.groupBy("doc_id").agg(F.count("*").alias("rows"))
    if whole and copies.filter("rows > 1 OR doc_id IS NULL").isEmpty():
        return docs.withColumn(row, F.col("doc_id").cast("long"))
    # The ranking has helper columns of its own: it sees the documents' columns under plain names.
    shown = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)))
    place = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    numbered = ranked(shown, [F.col(place["doc_id"]).asc_nulls_last(), F.xxhash64(place["text"])], "place")
    return numbered.select(*(F.col(own).alias(c) for c, own in place.items()), F.col("place").alias(row))


def keep_first_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of every component of near duplicates; of rows with that id, one."""
    (row,) = free_names(docs, "_row")
    rows = with_row_key(docs, row)
    slim = rows.select(row, "text")
    found = simhash.near_duplicates(slim, queries.SHINGLE_WORDS, queries.MAX_BITS, doc_id=row)
    later = found.filter("doc_id <> component_id").select(F.col("doc_id").alias(row))
    return rows.join(later, row, "left_anti").select(*own_columns(docs))


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that an earlier document holds; a character cut in two goes whole.

    Texts of which nothing but white space is left go.
    """
    row, left, changed = free_names(docs, "_row", "_kept", "_changed")
    rows = with_row_key(docs, row)
    found = suffix_dedup.remove_repeats(rows.select(row, "text"), doc_id=row).filter("n_removed > 0")
    shorter = found.select(F.col("doc_id").alias(row), F.col("kept_text").alias(left), F.lit(True).alias(changed))
    joined = rows.join(shorter, row, "left")
    text = F.when(F.col(changed), F.col(left)).otherwise(F.col("text"))
    return _with_text(joined, docs, text).filter(F.col("text").rlike(quality_rules.HAS_WORD))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret replaced by a mark; all documents stay."""
    (spans,) = free_names(docs, "_secrets")
    found = secrets.scan(docs, secrets.train(secrets.training_samples(docs)), out=spans)
    return _with_text(found, docs, secrets.redacted(text_or_empty("text"), F.col(spans), SECRET_MARK))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in the training sequences."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(docs, tokenizer, queries.PACK_END_ID, queries.SEQUENCE_TOKENS)


def _with_text(rows: DataFrame, docs: DataFrame, text) -> DataFrame:
    """The columns of ``docs`` with a new text and its length."""
    (own,) = free_names(rows, "_text")
    changed = rows.withColumn(own, text)
    new = {"text": F.col(own), "n_chars": F.char_length(own).cast("long")}
    return changed.select(*(new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns))


STAGES = [
    ("quality_rules", keep_good_quality),
    ("simhash_near_dedup", keep_first_of_near_duplicates),
    ("suffix_array_dedup", remove_repeated_passages),
    ("secret_scan", hide_secrets),
    ("best_fit_packing", pack_sequences),
]
#: Fingerprints, suffixes, models and tokens are not SQL; tests compare the run with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return docs
