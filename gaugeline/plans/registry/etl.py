"""Schema, label, quality, enrichment and feature queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions import labels, modes, numeric
from gaugeline.operators import anomaly, features, quality, reports, schema, split, stages
from gaugeline.operators.enrich import enrich, join_mode_risk, mode_lookup, with_operating_mode
from gaugeline.plans.registry.base import MODE, over, query, union_all
from gaugeline.plans.telemetry import KEY, SENSORS, featured, labelled, lineitem, telemetry


def _count() -> F.Column:
    return F.count(F.lit(1)).alias("row_count")


def _per(df: DataFrame, *dims: str) -> DataFrame:
    return df.groupBy(*dims).agg(_count())


@query(
    "mode_lookup",
    over(
        "enriched",
        """SELECT operating_mode, l.mode_risk, l.maintenance_priority, count(e.row_key) AS row_count
           FROM lookup l LEFT JOIN enriched e USING (operating_mode) GROUP BY ALL""",
    ),
)
def mode_lookup_counts(spark, sf):
    counts = _per(with_operating_mode(telemetry(spark, sf)), "operating_mode")
    return mode_lookup(spark).join(counts, "operating_mode", "left").na.fill(0, ["row_count"])


@query(
    "sanitize_columns",
    """SELECT sum(l_orderkey)::BIGINT AS a, sum(l_partkey)::BIGINT AS a_2, sum(l_suppkey)::BIGINT AS oil_temp_c,
              sum(l_linenumber)::BIGINT AS col, sum(l_orderkey + 1)::BIGINT AS x_2,
              sum(l_partkey + 1)::BIGINT AS x, sum(l_suppkey + 1)::BIGINT AS x_3 FROM lineitem""",
)
def sanitize_columns(spark, sf):
    raw = lineitem(spark, sf).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.col("l_orderkey") + 1, F.col("l_partkey") + 1, F.col("l_suppkey") + 1,
    ).toDF("A", "a", "Oil Temp (C)", "  ", "x_2", "x", "x")
    clean = schema.sanitize_columns(raw)
    return clean.agg(*[F.sum(c).alias(c) for c in clean.columns])


@query(
    "drop_index_columns",
    """SELECT l_returnflag, count(*) AS row_count
       FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_quantity FROM lineitem)
       GROUP BY l_returnflag""",
)
def drop_index_columns(spark, sf):
    raw = lineitem(spark, sf).select(
        F.col("l_orderkey").alias("c0"), F.col("l_orderkey").alias("unnamed_0"),
        "l_returnflag", "l_linestatus", "l_linenumber", "l_quantity",
    )
    return _per(quality.dedup_rows(schema.drop_index_columns(raw)), "l_returnflag")


@query(
    "parse_timestamp",
    """SELECT l_returnflag, count(*) AS row_count, count(*) FILTER (l_linenumber <> 3) AS parsed,
              count(*) FILTER (l_linenumber = 3) AS unparsed,
              strftime(min(l_shipdate) FILTER (l_linenumber <> 3), '%Y-%m-%d %H:%M:%S') AS first_time,
              strftime(max(l_shipdate) FILTER (l_linenumber <> 3), '%Y-%m-%d %H:%M:%S') AS last_time
       FROM lineitem GROUP BY l_returnflag""",
)
def parse_timestamp(spark, sf):
    pattern = "yyyy-MM-dd HH:mm:ss"
    raw = lineitem(spark, sf).select(
        "l_returnflag",
        F.when(F.col("l_linenumber") == 3, "zz")
        .otherwise(F.date_format("l_shipdate", pattern))
        .alias("timestamp"),
    )
    parsed = schema.parse_timestamp(raw)
    return parsed.groupBy("l_returnflag").agg(
        _count(),
        F.count("timestamp").alias("parsed"),
        F.count_if(F.col("timestamp").isNull()).alias("unparsed"),
        F.date_format(F.min("timestamp"), pattern).alias("first_time"),
        F.date_format(F.max("timestamp"), pattern).alias("last_time"),
    )


@query(
    "label_discovery",
    over("telemetry", "SELECT label AS class, count(*) AS row_count FROM telemetry GROUP BY label"),
)
def label_discovery(spark, sf):
    return _per(schema.rename_label(telemetry(spark, sf)), "class")


_TYPED = (*SENSORS, "tax", "cheap")


@query(
    "select_features",
    over(
        "telemetry",
        union_all([f"SELECT '{c}' AS feature, count({c}) AS present FROM telemetry" for c in SENSORS])
        + " UNION ALL SELECT 'tax', count(*) FROM telemetry UNION ALL SELECT 'cheap', count(*) FROM telemetry",
    ),
)
def select_features(spark, sf):
    typed = telemetry(spark, sf).withColumns(
        {
            "tax": F.col("dv_pressure").cast("decimal(10,2)"),
            "cheap": F.col("tp3") < 20000,
            "readings": F.array("tp2", "tp3"),
            "lag": F.make_dt_interval(F.col("lps")),
        }
    )
    names = schema.select_features(typed, ("class", "timestamp", "label"))
    return typed.agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "feature", "present")


@query(
    "normalize_label",
    """SELECT CASE l_linenumber WHEN 1 THEN 'malware' WHEN 2 THEN 'benign' WHEN 3 THEN 'malware'
                   WHEN 4 THEN NULL WHEN 5 THEN 'benign' WHEN 6 THEN 'service' ELSE 'malware' END AS class,
              count(*) AS row_count
       FROM lineitem GROUP BY 1""",
)
def normalize_label(spark, sf):
    spellings = {1: " Fault ", 2: "NORMAL", 3: "1", 5: "False", 6: " Service", 7: "TRUE"}
    line = F.col("l_linenumber")
    raw = F.lit(None).cast("string")
    for number, text in spellings.items():
        raw = F.when(line == number, text).otherwise(raw)
    return _per(schema.normalize_class(lineitem(spark, sf).select(raw.alias("class"))), "class")


@query(
    "default_label",
    "SELECT 'unknown' AS class, 0 AS ground_truth_label_available, count(*) AS row_count FROM lineitem",
)
def default_label(spark, sf):
    ingested = schema.ingest(telemetry(spark, sf).drop("label"))
    flag = F.lit(int(ingested.has_label)).alias("ground_truth_label_available")
    return ingested.frame.groupBy("class", flag).agg(_count())


@query(
    "clean_label",
    "SELECT lower(l_returnflag) AS class, count(*) AS row_count FROM lineitem GROUP BY 1",
)
def clean_label(spark, sf):
    padded = lineitem(spark, sf).select(F.concat(F.lit("  "), "l_returnflag", F.lit(" ")).alias("raw"))
    return _per(padded.select(labels.clean_label("raw").alias("class")), "class")


@query(
    "operating_mode",
    over(
        "telemetry",
        f"""SELECT 'all operands' AS operands, {MODE} AS operating_mode, count(*) AS row_count
            FROM telemetry GROUP BY ALL
            UNION ALL
            SELECT 'towers null', {MODE}, count(*)
            FROM (SELECT comp, NULLIF(towers, 1) AS towers, lps FROM telemetry) GROUP BY ALL
            UNION ALL
            SELECT 'towers missing', 'unknown', count(*) FROM telemetry""",
    ),
)
def operating_mode(spark, sf):
    full = telemetry(spark, sf)
    variants = {
        "all operands": full,
        "towers null": full.withColumn("towers", F.nullif("towers", F.lit(1))),
        "towers missing": full.drop("towers"),
    }
    counted = [
        _per(with_operating_mode(df), "operating_mode").withColumn("operands", F.lit(name))
        for name, df in variants.items()
    ]
    return quality.union_by_name(*counted)


@query(
    "broadcast_enrichment",
    over(
        "enriched",
        """SELECT operating_mode,
                  CASE WHEN operating_mode = 'transition' THEN 'unknown' ELSE mode_risk END AS mode_risk,
                  CASE WHEN operating_mode = 'transition' THEN 'investigate' ELSE maintenance_priority END
                    AS maintenance_priority,
                  count(*) AS row_count
           FROM enriched GROUP BY ALL""",
    ),
)
def broadcast_enrichment(spark, sf):
    partial = mode_lookup(spark).filter("operating_mode <> 'transition'")
    joined = enrich(telemetry(spark, sf), partial)
    return _per(joined, "operating_mode", "mode_risk", "maintenance_priority")


@query(
    "mode_risk_score",
    over(
        "enriched",
        """SELECT risk AS mode_risk, CASE risk WHEN 'high' THEN 3.0 WHEN 'medium' THEN 2.0 WHEN 'low' THEN 1.0
                       ELSE 0.0 END::DOUBLE AS mode_risk_score, count(*) AS row_count
           FROM (SELECT CASE WHEN operating_mode = 'transition' THEN 'unknown' ELSE mode_risk END AS risk
                 FROM enriched) GROUP BY ALL""",
    ),
)
def mode_risk_score(spark, sf):
    partial = mode_lookup(spark).filter("operating_mode <> 'transition'")
    risky = join_mode_risk(with_operating_mode(telemetry(spark, sf)), partial)
    return risky.groupBy("mode_risk", modes.mode_risk_ordinal().alias("mode_risk_score")).agg(_count())


@query(
    "sensor_risk_score",
    over(
        "featured",
        """SELECT operating_mode, count(*) AS row_count, count(sensor_risk_score) AS scored,
                  round(min(sensor_risk_score), 4) AS lowest, round(max(sensor_risk_score), 4) AS highest,
                  round(avg(sensor_risk_score), 4) AS average
           FROM featured GROUP BY operating_mode""",
    ),
)
def sensor_risk_score(spark, sf):
    scored, _ = featured(spark, sf)
    return scored.groupBy("operating_mode").agg(
        _count(),
        F.count("sensor_risk_score").alias("scored"),
        F.round(F.min("sensor_risk_score"), 4).alias("lowest"),
        F.round(F.max("sensor_risk_score"), 4).alias("highest"),
        F.round(F.avg("sensor_risk_score"), 4).alias("average"),
    )


@query(
    "risk_columns_fallback",
    """SELECT l_returnflag, round(sum(risk), 2) AS risk, count(*) AS row_count FROM (
         SELECT l_returnflag, (l_orderkey + l_partkey + l_suppkey + l_linenumber + l_quantity
                               + CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END)::DOUBLE AS risk
         FROM lineitem) GROUP BY l_returnflag""",
)
def risk_columns_fallback(spark, sf):
    plain = lineitem(spark, sf).select(
        "l_returnflag", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        (F.col("l_quantity") > 25).alias("busy"), "l_tax",
    )
    columns = features.risk_columns(schema.select_features(plain))
    scored = features.SensorRiskScore(inputCols=columns, outputCol="risk").transform(plain)
    return scored.groupBy("l_returnflag").agg(F.round(F.sum("risk"), 2).alias("risk"), _count())


_VECTOR = (*SENSORS, "sensor_risk_score", "mode_risk_score")


@query(
    "assemble_features",
    over(
        "featured",
        union_all(
            [
                f"""SELECT '{c}' AS feature, count(*) FILTER ({c} IS NULL) AS missing,
                           round(avg({c}), 4) AS average FROM featured"""
                for c in _VECTOR
            ]
        ),
    ),
)
def assemble_features(spark, sf):
    scored, columns = featured(spark, sf)
    flat = features.assemble(scored, columns).select(vector_to_array("features").alias("v"))
    parts = []
    for i, _ in enumerate(columns):
        x = F.col("v")[i]
        parts += [F.count_if(F.isnan(x)).alias(f"m{i}"), F.avg(F.when(~F.isnan(x), x)).alias(f"a{i}")]
    rows = [
        F.struct(
            F.lit(c).alias("feature"), F.col(f"m{i}").alias("missing"), F.round(f"a{i}", 4).alias("average")
        )
        for i, c in enumerate(columns)
    ]
    return flat.agg(*parts).select(F.inline(F.array(*rows)))


@query(
    "fill_features",
    over(
        "telemetry",
        """SELECT label, count(*) FILTER (h1 IS NULL) AS nulls_before, 0::BIGINT AS nulls_after,
                  count(*) FILTER (h1 IS NULL) AS zeros_after FROM telemetry GROUP BY label""",
    ),
)
def fill_features(spark, sf):
    kept = telemetry(spark, sf).withColumn("before", F.col("h1"))
    filled = features.fill_features(kept, SENSORS)
    return filled.groupBy("label").agg(
        F.count_if(F.col("before").isNull()).alias("nulls_before"),
        F.count_if(F.col("h1").isNull()).alias("nulls_after"),
        F.count_if(F.col("h1") == 0).alias("zeros_after"),
    )


@query(
    "binarize_label",
    over(
        "labelled",
        "SELECT class, sum(CASE WHEN class = 'malware' THEN 1 ELSE 0 END)::BIGINT AS positives FROM labelled GROUP BY class",
    ),
)
def binarize_label(spark, sf):
    return labelled(spark, sf).groupBy("class").agg(F.sum(labels.is_positive("class")).alias("positives"))


@query(
    "anomaly_flag",
    over(
        "labelled",
        "SELECT class, sum(CASE WHEN tp3 >= 60000.0 THEN 1 ELSE 0 END)::BIGINT AS flagged FROM labelled GROUP BY class",
    ),
)
def anomaly_flag(spark, sf):
    return labelled(spark, sf).groupBy("class").agg(
        F.sum(anomaly.anomaly_flag("tp3", 60000.0)).alias("flagged")
    )


@query(
    "filter_predicates",
    over(
        "telemetry",
        """SELECT 'null' AS predicate, count(*) AS row_count, sum(tp2) AS total FROM telemetry WHERE h1 IS NULL
           UNION ALL SELECT 'not null', count(*), sum(tp2) FROM telemetry WHERE h1 IS NOT NULL
           UNION ALL SELECT 'equal', count(*), sum(tp2) FROM telemetry WHERE label = 'Fault'
           UNION ALL SELECT 'not equal', count(*), sum(tp2) FROM telemetry WHERE label <> 'Fault'
           UNION ALL SELECT 'time range', count(*), sum(tp2) FROM telemetry
             WHERE "timestamp" > TIMESTAMP '1996-01-01' AND "timestamp" <= TIMESTAMP '1998-01-01'""",
    ),
)
def filter_predicates(spark, sf):
    rows = telemetry(spark, sf)
    time = F.col("timestamp")
    start, end = (F.lit(f"{year}-01-01").cast("timestamp_ntz") for year in (1996, 1998))
    predicates = {
        "null": F.col("h1").isNull(),
        "not null": F.col("h1").isNotNull(),
        "equal": F.col("label") == "Fault",
        "not equal": F.col("label") != "Fault",
        "time range": (time > start) & (time <= end),
    }
    counted = [
        rows.filter(p).agg(_count(), F.sum("tp2").alias("total")).withColumn("predicate", F.lit(name))
        for name, p in predicates.items()
    ]
    return quality.union_by_name(*counted)


@query(
    "has_ground_truth",
    over(
        "labelled",
        """SELECT 'labelled' AS source, count(*) FILTER (class <> 'unknown') > 0 AS has_label FROM labelled
           UNION ALL SELECT 'unlabelled', false""",
    ),
)
def has_ground_truth(spark, sf):
    sources = {
        "labelled": labelled(spark, sf),
        "unlabelled": schema.normalize_class(telemetry(spark, sf).drop("label")),
    }
    rows = [(name, quality.has_ground_truth(df)) for name, df in sources.items()]
    return spark.createDataFrame(rows, "source STRING, has_label BOOLEAN")


@query(
    "cost_throughput",
    """SELECT "partitions", "rows", duration_seconds,
              round("rows" / greatest(duration_seconds, 1e-6), 2) AS throughput_rows_per_sec,
              round(duration_seconds / 3600.0 * 4 * 0.25, 6) AS estimated_cost_usd,
              round_even("rows" * 0.05, 0)::BIGINT AS alerts,
              round(round_even("rows" * 0.05, 0) * -8.0, 2)::DOUBLE AS expected_profit_usd
       FROM (SELECT l_linenumber AS "partitions", count(*) AS "rows",
                    round(count(*) / 40000.0::DOUBLE, 4) AS duration_seconds
             FROM lineitem GROUP BY l_linenumber)""",
)
def cost_throughput(spark, sf):
    timings = (
        lineitem(spark, sf)
        .groupBy(F.col("l_linenumber").alias("partitions"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("duration_seconds", F.round(F.col("rows") / 40000.0, 4))
    )
    alerts = numeric.alert_count(F.col("rows"), F.lit(0.05))
    return reports.scaling_costs(timings, executors=4).withColumns(
        {"alerts": alerts, "expected_profit_usd": numeric.review_profit(alerts)}
    )


_NARROW = """SELECT l_returnflag AS class, l_linenumber AS line, l_quantity AS quantity,
                    NULLIF(l_discount, 0.0) AS discount FROM lineitem"""


@query(
    "dq_report",
    f"""WITH n AS ({_NARROW}), g AS (SELECT *, count(*) AS copies FROM n GROUP BY ALL)
        SELECT 'ground_truth_label_available' AS metric, 1::BIGINT AS value
        UNION ALL SELECT 'total_rows', count(*) FROM n
        UNION ALL SELECT 'duplicate_rows', sum(copies - 1)::BIGINT FROM g
        UNION ALL SELECT 'null_class', count(*) FILTER (class IS NULL) FROM n
        UNION ALL SELECT 'null_line', count(*) FILTER (line IS NULL) FROM n
        UNION ALL SELECT 'null_quantity', count(*) FILTER (quantity IS NULL) FROM n
        UNION ALL SELECT 'null_discount', count(*) FILTER (discount IS NULL) FROM n""",
)
def dq_report(spark, sf):
    raw = lineitem(spark, sf).select(
        F.col("l_returnflag").alias("class"),
        F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("quantity"),
        F.nullif("l_discount", F.lit(0.0)).alias("discount"),
    )
    return quality.quality_report(raw, schema.select_features(raw), has_label=True)


@query(
    "dedup_rows",
    """SELECT count(*) AS row_count, sum(l_quantity) AS total
       FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_quantity FROM lineitem)""",
)
def dedup_rows(spark, sf):
    narrow = lineitem(spark, sf).select("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity")
    return quality.dedup_rows(narrow).agg(_count(), F.sum("l_quantity").alias("total"))


@query("distinct_labels", over("labelled", "SELECT DISTINCT class FROM labelled ORDER BY class"))
def distinct_labels(spark, sf):
    return quality.distinct_labels(labelled(spark, sf))


@query(
    "union_by_name",
    over(
        "labelled",
        """SELECT class, count(*) AS row_count, sum(tp2) AS total
           FROM (SELECT class, tp2 FROM labelled WHERE lps = 1 UNION ALL BY NAME
                 SELECT tp2, class FROM labelled WHERE comp = 0) GROUP BY class""",
    ),
)
def union_by_name(spark, sf):
    rows = labelled(spark, sf)
    both = quality.union_by_name(
        rows.filter("lps = 1").select("class", "tp2"), rows.filter("comp = 0").select("tp2", "class")
    )
    return both.groupBy("class").agg(_count(), F.sum("tp2").alias("total"))


@query(
    "stage_lineage",
    """WITH n AS (SELECT l_returnflag, l_linestatus, l_linenumber, l_quantity, l_shipdate FROM lineitem),
            c AS (SELECT count(*) AS k FROM (SELECT DISTINCT * FROM n)), r AS (SELECT count(*) AS k FROM n)
       SELECT 'ingestion_validation' AS stage, 'success' AS status, r.k AS input_rows, r.k AS output_rows FROM r
       UNION ALL SELECT 'basic_etl', 'success', r.k, c.k FROM r, c
       UNION ALL SELECT 'broadcast_etl', 'success', c.k, c.k FROM c
       UNION ALL SELECT 'broken', 'failed', 0, 0""",
)
def stage_lineage(spark, sf):
    raw = lineitem(spark, sf).select("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_shipdate")
    log = stages.StageLog()
    log.run("ingestion_validation", lambda: raw, None, "scan")
    clean = log.run("basic_etl", lambda: quality.dedup_rows(raw), log.rows_of("ingestion_validation"), "dedup")
    log.run("broadcast_etl", lambda: enrich(clean), log.rows_of("basic_etl"), "lookup")
    try:
        log.run("broken", lambda: clean.select("no_such_column"), None, "")
    except Exception:  # noqa: BLE001 - the failed row is the point
        pass
    return log.lineage_table(spark).drop("notes")


@query(
    "stage_rows",
    over(
        "enriched",
        """SELECT 'raw' AS stage, count(*) AS "rows" FROM lineitem
           UNION ALL SELECT 'deduplicated', count(*)
             FROM (SELECT DISTINCT label, tp2, comp, towers, lps FROM telemetry)
           UNION ALL SELECT 'enriched', count(*) FROM enriched""",
    ),
)
def stage_rows(spark, sf):
    rows = telemetry(spark, sf)
    return stages.stage_counts(
        {
            "raw": rows,
            "deduplicated": quality.dedup_rows(rows.select("label", "tp2", "comp", "towers", "lps")),
            "enriched": enrich(rows),
        }
    )


@query(
    "materialized_stage",
    over("enriched", "SELECT operating_mode, class, count(*) AS row_count FROM enriched GROUP BY ALL"),
)
def materialized_stage(spark, sf):
    with stages.materialized(enrich(labelled(spark, sf)), checkpoint=True) as stage:
        # The checkpoint outlives the release of the cached copy.
        return _per(stage, "operating_mode", "class")


@query(
    "repartition_group_count",
    over(
        "labelled",
        """SELECT p AS "partitions", class, count(*) AS row_count
           FROM labelled CROSS JOIN (SELECT unnest([2, 4, 8, 16]) AS p) GROUP BY ALL""",
    ),
)
def repartition_group_count(spark, sf):
    rows = labelled(spark, sf)
    counted = [
        split.repartition_group_count(rows, n).withColumn("partitions", F.lit(n)) for n in (2, 4, 8, 16)
    ]
    return quality.union_by_name(*counted)


@query(
    "salted_partition_count",
    over("labelled", "SELECT class, count(*) AS row_count FROM labelled GROUP BY class"),
)
def salted_partition_count(spark, sf):
    return _per(split.salted_repartition(labelled(spark, sf), 8, "class", KEY), "class")


_WIDE = [f"f{i:02d}" for i in range(1, 13)]


@query(
    "dq_report_wide",
    "WITH raw AS (SELECT l_returnflag AS class, CASE WHEN l_linenumber <> 3 THEN l_shipdate END AS ts, l_quantity, "
    "l_discount, l_linenumber FROM lineitem), "
    "told AS (SELECT class, ts, l_quantity, l_discount, l_linenumber, count(*) AS n FROM raw GROUP BY ALL) "
    + "SELECT metric, CAST(value AS BIGINT) AS value FROM ("
    + union_all(
        [
            "SELECT 'ground_truth_label_available' AS metric, 1 AS value",
            "SELECT 'total_rows', sum(n) FROM told",
            "SELECT 'duplicate_rows', sum(n - 1) FROM told",
            "SELECT 'null_class', 0",
            "SELECT 'null_timestamp', coalesce(sum(n) FILTER (ts IS NULL), 0) FROM told",
            *[f"SELECT 'null_{c}', 0" for c in _WIDE[:10]],
            "SELECT 'null_f11', coalesce(sum(n) FILTER (l_linenumber = 2), 0) FROM told",
            "SELECT 'null_f12', coalesce(sum(n) FILTER (l_discount = 0), 0) FROM told",
        ]
    )
    + ")",
)
def dq_report_wide(spark, sf):
    """Null counts of the time and of all of twelve features, the last two with nulls."""
    quantity, line = F.col("l_quantity"), F.col("l_linenumber")
    raw = lineitem(spark, sf).select(
        F.col("l_returnflag").alias("class"),
        F.when(line != 3, F.col("l_shipdate")).alias("timestamp"),
        *[(quantity * i + line).alias(c) for i, c in enumerate(_WIDE[:10])],
        F.when(line != 2, quantity).alias("f11"),
        F.nullif("l_discount", F.lit(0.0)).alias("f12"),
    )
    return quality.quality_report(raw, schema.select_features(raw), has_label=True)


@query(
    "temporal_split_untimed",
    over(
        "labelled",
        """SELECT CASE WHEN t IS NULL THEN 'untimed' WHEN t <= q60 THEN 'train' WHEN t <= q80 THEN 'validation'
                       ELSE 'test' END AS split, count(*) AS row_count
           FROM timed, (SELECT quantile_cont(t, 0.6) AS q60, quantile_cont(t, 0.8) AS q80 FROM timed) GROUP BY ALL""",
        timed="""SELECT CASE WHEN lps = 0 THEN floor(epoch("timestamp")) END AS t FROM labelled""",
    ),
)
def temporal_split_untimed(spark, sf):
    """Rows without a time stay, in a split of their own."""
    rows = labelled(spark, sf).withColumn("timestamp", F.when(F.col("lps") == 0, F.col("timestamp")))
    return _per(split.temporal_split(rows), "split")


@query(
    "lowercase_columns",
    "SELECT l_returnflag, sum(l_quantity) AS total, count(*) AS row_count FROM lineitem GROUP BY l_returnflag",
)
def lowercase_columns(spark, sf):
    """Padded upper-case names become plain lower-case ones."""
    raw = lineitem(spark, sf).select("l_returnflag", "l_quantity").toDF(" L_RETURNFLAG ", "L_Quantity")
    lower = schema.lowercase_columns(raw)
    return lower.groupBy("l_returnflag").agg(F.sum("l_quantity").alias("total"), _count())


@query(
    "upsample",
    """SELECT s_suppkey, CASE WHEN n >= 120 THEN 1 ELSE greatest(2, 120 // greatest(n, 1) + 1) END AS row_count
       FROM supplier, (SELECT count(*) AS n FROM supplier)""",
)
def upsample(spark, sf):
    """Copies of each row after a table of fewer than 120 rows was replicated."""
    suppliers = spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey")
    return _per(split.upsample(suppliers), "s_suppkey")
