"""Registration, and the SQL texts shared by several queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
#: Queries whose values no SQL can state, beside those of ``QUERIES`` that judge them.
VALUE_QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; without SQL only its rows are checked."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE_SQL[name] = sql
        return function

    return register


def value_query(function: Query) -> Query:
    VALUE_QUERIES[function.__name__] = function
    return function


TELEMETRY = """
SELECT concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_key,
       l_shipdate AS "timestamp",
       l_quantity AS tp2,
       l_extendedprice AS tp3,
       NULLIF(l_discount, 0.0) AS h1,
       l_tax AS dv_pressure,
       l_quantity * (1 - l_discount) AS reservoirs,
       l_extendedprice / l_quantity AS oil_temperature,
       l_extendedprice * l_discount AS motor_current,
       CASE WHEN l_returnflag IN ('N', 'R') THEN 1 ELSE 0 END AS comp,
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS towers,
       CASE WHEN l_linenumber % 5 = 0 THEN 1 ELSE 0 END AS lps,
       CASE WHEN l_linenumber = 7 THEN 'Service' WHEN l_linestatus = 'F' THEN 'Fault' ELSE 'Normal' END AS label
FROM lineitem"""

LABELLED = """
SELECT * EXCLUDE (label),
       CASE label WHEN 'Fault' THEN 'malware' WHEN 'Normal' THEN 'benign' ELSE 'service' END AS class
FROM telemetry"""

MODE = """
CASE WHEN comp = 1 AND towers = 1 AND lps = 0 THEN 'production'
     WHEN comp = 0 AND towers = 0 THEN 'idle'
     WHEN comp = 1 AND lps = 1 THEN 'pressure_event'
     ELSE 'transition' END"""

LOOKUP = """
SELECT * FROM (VALUES ('production', 'medium', 'observe'), ('idle', 'low', 'normal'),
                      ('pressure_event', 'high', 'urgent'), ('transition', 'medium', 'observe'),
                      ('unknown', 'unknown', 'investigate'))
         AS v(operating_mode, mode_risk, maintenance_priority)"""

ENRICHED = f"""
SELECT m.*, l.mode_risk, l.maintenance_priority
FROM (SELECT *, {MODE} AS operating_mode FROM labelled) m LEFT JOIN lookup l USING (operating_mode)"""

FEATURED = """
SELECT *,
       dv_pressure + reservoirs + oil_temperature + motor_current + tp2 + tp3 + h1 AS sensor_risk_score,
       CASE mode_risk WHEN 'high' THEN 3.0 WHEN 'medium' THEN 2.0 WHEN 'low' THEN 1.0 ELSE 0.0 END::DOUBLE
         AS mode_risk_score
FROM enriched"""

BOUNDS = """
SELECT quantile_cont(floor(epoch("timestamp")), 0.6) AS q60, quantile_cont(floor(epoch("timestamp")), 0.8) AS q80
FROM telemetry"""

SPLIT_ROWS = """
SELECT *, CASE WHEN floor(epoch("timestamp")) <= (SELECT q60 FROM bounds) THEN 'train'
               WHEN floor(epoch("timestamp")) <= (SELECT q80 FROM bounds) THEN 'validation'
               ELSE 'test' END AS split
FROM featured"""

SCORED = "SELECT *, abs(tp3 - 38000.0::DOUBLE) / 20000.0::DOUBLE AS anomaly_score FROM split_rows"

POINTS = """
SELECT 'isolation_forest' AS algorithm, quantile_cont(anomaly_score, 0.95) AS threshold
FROM scored WHERE split = 'train'
UNION ALL
SELECT 'isolation_forest_strict', quantile_cont(anomaly_score, 0.99) FROM scored WHERE split = 'train'"""

FLAGGED = """
SELECT algorithm, s.*, CASE WHEN anomaly_score >= threshold THEN 1 ELSE 0 END AS anomaly_flag, threshold
FROM scored s CROSS JOIN points"""

SUMMARY = """
SELECT algorithm, split, count(*) AS "rows",
       round(avg(anomaly_flag), 6) AS anomaly_rate,
       round(avg(anomaly_score), 6) AS score_mean,
       round(stddev_pop(anomaly_score), 6) AS score_std,
       round(quantile_cont(anomaly_score, 0.95), 6) AS score_p95,
       round(quantile_cont(anomaly_score, 0.99), 6) AS score_p99
FROM flagged GROUP BY algorithm, split"""

STAGES = {
    "telemetry": TELEMETRY,
    "labelled": LABELLED,
    "lookup": LOOKUP,
    "enriched": ENRICHED,
    "featured": FEATURED,
    "bounds": BOUNDS,
    "split_rows": SPLIT_ROWS,
    "scored": SCORED,
    "points": POINTS,
    "flagged": FLAGGED,
    "summary": SUMMARY,
}


def over(last_stage: str, select: str, **extra: str) -> str:
    """``select`` over the SQL stages up to ``last_stage`` and any further named stages."""
    names = list(STAGES)
    used = {name: STAGES[name] for name in names[: names.index(last_stage) + 1]} | extra
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in used.items()) + "\n" + select


def union_all(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)
