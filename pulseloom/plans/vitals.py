"""Readings and messages derived from the `events` table, for queries and their SQL.

Measurements are integer functions of the event id divided by a power of ten, so both
engines compute the same doubles. Factors are reduced before multiplying, which keeps the
products small for any id. Lost signals (zeros) sit at fixed ids.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseloom.functions import rules
from pulseloom.schema import ALIASES, MEASURES
from pulseloom.sources.points import to_points

_S = "(800+(event_id%1201*7919)%1201)"
_D = "(450+(event_id%801*104729)%801)"
_H = "(500+(event_id%701*1299709)%701)"
_O = "(800+(event_id%201*15485863)%201)"


def _unless(divisor: int, expr: str) -> str:
    return f"CASE WHEN event_id%{divisor}=0 THEN 0e0 ELSE {expr} END"


COLUMNS = {
    "RR": "(80+(event_id%240*31)%240)/1e1",
    "SPO2": _unless(307, f"{_O}/1e1"),
    "MAP": _unless(53, f"({_S}+2*{_D})/3e1"),
    "SBP": _unless(53, f"{_S}/1e1"),
    "DBP": _unless(53, f"{_D}/1e1"),
    "HR": _unless(211, f"{_H}/1e1"),
    "PP": _unless(53, f"({_S}-{_D})/1e1"),
    "CO": f"CASE WHEN event_id%53=0 OR event_id%211=0 THEN 0e0 ELSE ({_S}-{_D})*{_H}/1e2 END",
}

_MEASURED = ", ".join(f'{COLUMNS[c]} AS {c}' for c in MEASURES)

# the same table for the other engine; ts_us is the time in microseconds
CTE = (
    "WITH vitals AS (SELECT user_id AS patient_id, event_id AS reading_id, ts AS DateTime, "
    f"epoch_us(ts) AS ts_us, CAST(floor(epoch(ts)) AS BIGINT) AS sec, {_MEASURED} FROM events) "
)


def cte(*more: str) -> str:
    """WITH clause of the readings followed by further named queries."""
    return CTE.rstrip() + "".join(f", {m}" for m in more) + " "


def vitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return from_events(events)


def from_events(events: DataFrame) -> DataFrame:
    """Readings of a batch or stream of events."""
    measured = [f"{COLUMNS[c]} AS {c}" for c in MEASURES]
    return events.selectExpr(
        "user_id AS patient_id", "event_id AS reading_id", "CAST(ts AS timestamp) AS DateTime", *measured
    )


def ts_us(c="DateTime"):
    return F.unix_micros(F.col(c))


def r6(c, name=None):
    c = F.col(c) if isinstance(c, str) else c
    out = F.round(c, 6)
    return out.alias(name) if name else out


def messages(readings: DataFrame) -> DataFrame:
    """JSON messages of the readings, all values text, with the drift and the faults of real feeds.

    By reading id: three spellings of the time column (one without seconds), two of SPO2,
    unreadable or empty SBP, and payloads that are no JSON.
    """
    rid = F.col("reading_id")
    text = {c: F.col(c).cast("string") for c in ("patient_id", "reading_id", *MEASURES)}
    text["SBP"] = F.when(rid % 103 == 1, "abc").when(rid % 107 == 2, "").otherwise(text["SBP"])
    full, short = F.date_format("DateTime", "yyyy-MM-dd HH:mm:ss"), F.date_format("DateTime", "yyyy-MM-dd HH:mm")
    variant = rid % 3
    text |= {
        "DateTime": F.when(variant == 0, full),
        "Timestamp": F.when(variant == 1, full),
        "DATETIME": F.when(variant == 2, short),
        "SPO": F.when(variant == 1, text["SPO2"]),
    }
    text["SPO2"] = F.when(variant != 1, text["SPO2"])
    names = ["patient_id", "reading_id", *ALIASES["DateTime"][:3], *MEASURES, "SPO"]
    payload = F.to_json(F.struct(*[text[n].alias(n) for n in names]))
    value = F.when(rid % 101 == 0, F.concat(F.lit("not json "), rid.cast("string"))).otherwise(payload)
    return readings.select(F.lit(None).cast("string").alias("key"), value.alias("value"))


# what survives decoding and casting, in the other engine
DECODED = (
    "decoded AS (SELECT *, CASE WHEN reading_id%3=2 THEN date_trunc('minute', DateTime) "
    "ELSE date_trunc('second', DateTime) END AS t FROM vitals WHERE reading_id%101<>0)"
)
BAD_SBP = "(reading_id%103=1 OR reading_id%107=2)"


def points(spark: SparkSession, sf_dir: str, fields=("SBP", "DBP"), measurement="vitals") -> DataFrame:
    """Points of the readings, tagged with the patient; the reading id is kept for ties."""
    return to_points(vitals(spark, sf_dir), measurement, ("patient_id",), fields, "DateTime", ("reading_id",))


def points_cte(fields=("SBP", "DBP")) -> str:
    parts = [f"SELECT reading_id, patient_id, '{f}' AS field, {f} AS value, DateTime AS time, ts_us, sec FROM vitals" for f in fields]
    return cte("points AS (" + " UNION ALL ".join(parts) + ")")


# CASE expressions of the rules used in several queries, in the other engine
def level_sql(s="SBP", d="DBP") -> str:
    return (
        f"CASE WHEN {s}<120 AND {d}<80 THEN 'Normal' WHEN {s}>=120 AND {s}<130 AND {d}<80 THEN 'Elevated' "
        f"WHEN ({s}>=130 AND {s}<140) OR ({d}>=80 AND {d}<90) THEN 'Stage 1 Hypertension' "
        f"WHEN {s}>=140 OR {d}>=90 THEN 'Stage 2 Hypertension' ELSE 'Hypertensive Crisis' END"
    )


def class_sql(s="SBP", d="DBP", zero=False) -> str:
    top = 129 if zero else 130
    dead = f"WHEN {s}=0 OR {d}=0 THEN 'Dead' " if zero else ""
    return (
        f"CASE WHEN {s}>180 OR {d}>120 THEN 'Hypertensive Crisis' WHEN {s}>=140 OR {d}>=90 THEN 'Hypertension Stage 2' {dead}"
        f"WHEN {s}>=130 OR {d}>=80 THEN 'Hypertension Stage 1' WHEN {s}>=120 AND {s}<={top} AND {d}<80 THEN 'Elevated' "
        f"WHEN {s}<120 AND {d}<80 THEN 'Normal' ELSE 'Uncategorized' END"
    )


VALIDITY_SQL = (
    "CASE WHEN SBP=0 AND DBP=0 AND (HR=0 OR HR>80) AND (SPO2=0 OR SPO2>80) THEN 'Invalid Measurement' "
    "WHEN SBP<120 AND DBP<80 THEN 'Normal' WHEN SBP<129 AND DBP<89 THEN 'Elevated' "
    "WHEN SBP<139 AND DBP<89 THEN 'Hypertension Stage 1' ELSE 'Hypertension Stage 2 or higher' END"
)
LABEL_SQL = "CASE WHEN SBP=0 AND DBP=0 AND HR>=80 THEN 1 WHEN SBP<120 AND DBP<80 THEN 0 ELSE 1 END"
ONLINE_SQL = (
    "CASE WHEN SBP=0 OR DBP=0 THEN 1 WHEN SBP>120 OR DBP>80 THEN 1 WHEN SBP<120 AND DBP<80 THEN 0 ELSE 1 END"
)
PRED_SQL = "CASE WHEN SBP>=130 THEN 1 ELSE 0 END"


def predicted():
    """A simple prediction to measure against: systolic pressure of 130 or more."""
    return F.when(F.col("SBP") >= 130, 1).otherwise(0)


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with truth `label` and prediction `pred`."""
    v = vitals(spark, sf_dir)
    return v.withColumn("label", rules.label_online("SBP", "DBP")).withColumn("pred", predicted())


JUDGED = f"judged AS (SELECT *, {ONLINE_SQL} AS label, {PRED_SQL} AS pred FROM vitals)"
