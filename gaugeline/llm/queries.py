"""One query per operator over its whole table, with SQL counterparts where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import bpe, licenses, lm, negatives, packing, phrases, quality_rules, secrets, sharding, simhash, suffix_dedup, token_files, topk
from gaugeline.llm.common import Query, table

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

OPENING_NOTICE = r"(?i)\blicen[sc]ed?\b"
QUERY_EVERY = 20
TOP = 20
VECTOR_SCALE = 64
SHARDS = 24
SEQUENCE_TOKENS = 1024
PACK_END_ID = 2
FILE_END_ID = 1
SHINGLE_WORDS = 4
MAX_BITS = 4
PHRASE_SUPPORT = 100
PHRASE_WORDS = 5
PHRASE_TOP = 2000
NEGATIVE_SCALE = 256
ANCHOR_EVERY, RELABEL_EVERY, LABELS = 100, 7, 10
POSITIVES, NEGATIVES, LOW_PERCENT = 5, 5, 80
FOLDS, HELD_OUT_FOLD = 7, 2


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def sql(name: str, text: str) -> None:
    ORACLE_SQL[name] = text


sql(
    "op2_exact_top_k",
    f"""
WITH whole AS (
    SELECT vec_id, len(embedding) AS dim, list_transform(embedding, lambda x: floor(x::DOUBLE * {VECTOR_SCALE})::BIGINT) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
    FROM (SELECT DISTINCT * FROM whole WHERE vec_id % {QUERY_EVERY} = 0) q JOIN whole c ON q.dim = c.dim AND q.vec_id <> c.vec_id),
ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {TOP}""",
)

_STOP_LIST = ", ".join(f"'{w}'" for w in sorted(set(quality_rules.STOP_WORDS)))
_LANGUAGES = ", ".join(f"'{x}'" for x in quality_rules.STOP_WORD_LANGUAGES)
#: Bounds as in ``quality_rules``, written out, so that a change of a rule shows.
sql(
    "op9_quality_rules",
    rf"""
WITH parts AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines,
           coalesce(lower(regexp_extract(lang, '^\s*([^-_\s]*)', 1)) IN ({_LANGUAGES}, ''), true) AS listed
    FROM documents),
words AS (SELECT rid, unnest(words) AS word, unnest(range(len(words))) AS pos FROM parts),
windows AS (
    SELECT rid, pos, word || ' ' || lead(word, 1) OVER w || ' ' || lead(word, 2) OVER w || ' ' || lead(word, 3) OVER w
           || ' ' || lead(word, 4) OVER w AS five
    FROM words WINDOW w AS (PARTITION BY rid ORDER BY pos)),
often AS (SELECT rid, pos, count(*) OVER (PARTITION BY rid, five) AS n FROM windows WHERE five IS NOT NULL),
repeated AS (
    SELECT rid, count(DISTINCT place) AS n
    FROM (SELECT rid, unnest(range(pos, pos + {quality_rules.WINDOW_WORDS})) AS place FROM often WHERE n > 1) GROUP BY rid),
stops AS (
    SELECT rid, count(*) FILTER (lower(rtrim(word, '{quality_rules.CLOSING_MARKS}')) IN ({_STOP_LIST})) AS n FROM words GROUP BY rid),
measures AS (
    SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
           len(regexp_extract_all(body, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words,
           CASE WHEN listed THEN coalesce(stops.n, 0) END AS n_stop_words
    FROM parts LEFT JOIN repeated USING (rid) LEFT JOIN stops USING (rid)),
judged AS (
    SELECT *, n_words < 10 OR coalesce(n_repeat_words / nullif(n_words, 0) > 0.2, false) AS base_failed FROM measures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(word_chars / nullif(n_words, 0) BETWEEN 2.0 AND 15.0, true)
       AND coalesce(n_symbols / nullif(n_words, 0) <= 0.25, true) AND coalesce(n_stop_words / nullif(n_words, 0) >= 0.02, true)
       AND coalesce(n_dup_lines / nullif(n_lines, 0) <= 0.5, true) AS kept
FROM judged""",
)

sql(
    "op11_phrase_mining",
    rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
runs AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM runs),
grams AS (SELECT lang, w, i, unnest(range(1, least({PHRASE_WORDS}, len(w) - i + 1) + 1)) AS k FROM starts),
counted AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a FROM grams GROUP BY ALL),
sizes AS (SELECT lang, sum(a) AS n FROM counted WHERE k = 1 GROUP BY lang),
often AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM counted WHERE a >= {PHRASE_SUPPORT}),
inner_parts AS (
    SELECT lang, a, unnest(list_transform(range(1, k + 1), lambda i: list_transform(range(i, k + 1), lambda j: array_to_string(w[i:j], ' '))).flatten()) AS phrase, k
    FROM often WHERE k > 2),
covered AS (SELECT p.lang, p.phrase, max(p.a) AS inside FROM inner_parts p JOIN often o ON o.lang = p.lang AND o.phrase = p.phrase AND o.k < p.k GROUP BY ALL),
kept AS (
    SELECT o.* FROM often o LEFT JOIN covered c USING (lang, phrase) WHERE o.k > 1 AND (c.inside IS NULL OR 100 * c.inside < 100 * o.a)),
cuts AS (SELECT *, unnest(range(1, k)) AS c FROM kept),
scored AS (
    SELECT t.lang, t.phrase, t.a, t.c, f.a AS l, r.a AS r, sizes.n,
           (1000::HUGEINT * t.a::HUGEINT * sizes.n::HUGEINT) // (f.a::HUGEINT * r.a::HUGEINT) AS score
    FROM cuts t JOIN often f ON f.lang = t.lang AND f.phrase = array_to_string(t.w[:t.c], ' ')
    JOIN often r ON r.lang = t.lang AND r.phrase = array_to_string(t.w[t.c + 1:], ' ') JOIN sizes ON sizes.lang = t.lang),
least_cut AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least_cut)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= {PHRASE_TOP}""",
)

sql(
    "op12_hard_negatives",
    f"""
WITH whole AS (
    SELECT vec_id, CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label, len(embedding) AS dim,
           list_transform(embedding, lambda x: floor(x::DOUBLE * {NEGATIVE_SCALE})::BIGINT) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
anchors AS (SELECT row_number() OVER () AS anchor, * FROM (SELECT DISTINCT * FROM whole WHERE vec_id % {ANCHOR_EVERY} = 0)),
scores AS (
    SELECT a.anchor, a.vec_id AS anchor_id, c.vec_id, c.label = a.label AS same,
           list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
    FROM anchors a JOIN whole c ON a.dim = c.dim AND a.vec_id <> c.vec_id),
positives AS (
    SELECT anchor, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place
    FROM scores WHERE same QUALIFY place <= {POSITIVES}),
ranked AS (
    SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
    FROM positives p JOIN scores s ON s.anchor = p.anchor AND NOT s.same
     AND {LOW_PERCENT} * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= {NEGATIVES}""",
)


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of their source, in directories of a thousand and of fifty neighbours.

    The tables hold no file names: a document that opens with a licence notice counts as the licence
    file of its directory.
    """
    docs = table(spark, sf_dir, "documents")
    opening = F.substring_index(F.col("text"), "\n", 1).rlike(OPENING_NOTICE)
    name = F.when(opening, F.concat(F.lit("LICENSE-"), "doc_id")).otherwise(F.concat(F.col("doc_id"), F.lit(".txt")))
    path = F.concat_ws("/", "source", F.floor(F.col("doc_id") / 1000), F.floor(F.col("doc_id") / 50), name)
    return licenses.scan(docs.select("doc_id", path.alias("path"), "text"))


@query
def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0, TOP, VECTOR_SCALE)


@query
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), keep_bytes=False)


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.train(secrets.training_samples(docs))).select("doc_id", "secrets")
    of_kind = lambda k: F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("secrets", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id",
        of_kind(0).alias("n_assign"),
        of_kind(1).alias("n_access"),
        of_kind(2).alias("n_hex"),
        F.sha2(secrets.span_list(base), 256).alias("base_sha256"),
        secrets.span_list(F.col("secrets")).alias("spans"),
    )


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer, PACK_END_ID, SEQUENCE_TOKENS)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return token_files.round_trip(table(spark, sf_dir, "documents"), tokenizer, FILE_END_ID, keep_ids=False)


@query
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN, keep_ids=False)


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *(F.col("quality")[n].alias(n) for n in names))


@query
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), SHINGLE_WORDS, MAX_BITS)
    return found.select("doc_id", simhash.hex_mark("fingerprint").alias("fingerprint"), "component_id")


@query
def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    frequent = phrases.frequent_phrases(table(spark, sf_dir, "documents"), PHRASE_SUPPORT, PHRASE_WORDS)
    return phrases.collocations(frequent, PHRASE_TOP)


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = negatives.usable_rows(table(spark, sf_dir, "embeddings"), NEGATIVE_SCALE)
    noisy = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", noisy), F.col("vec_id") % ANCHOR_EVERY == 0, POSITIVES, NEGATIVES, LOW_PERCENT)


@query
def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    held_out = F.coalesce(fold == HELD_OUT_FOLD, F.lit(False))
    model = lm.train(docs, ~held_out)
    scored = lm.score(docs.withColumn("held_out", held_out), model)
    return scored.select(
        "doc_id", "held_out", "lm.n_tokens", "lm.n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "lm.base_score", "lm.score"
    )
