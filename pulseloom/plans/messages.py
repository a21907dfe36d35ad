"""Queries on sources, codecs and points."""

from pyspark.sql import functions as F

from pulseloom.functions import rules
from pulseloom.operators.clean import valid_bp
from pulseloom.plans.base import query
from pulseloom.plans.vitals import BAD_SBP, DECODED, cte, level_sql, messages, points, points_cte, ts_us, vitals
from pulseloom.schema import MEASURES
from pulseloom.sources.codecs import cast_vitals, dead_letters, decode, encode_kv, normalize_aliases, parse_line_protocol
from pulseloom.session import shared_dir
from pulseloom.sources.points import from_points, points_range, to_points
from pulseloom.sources.readers import read_vitals
from pulseloom.sources.sinks import write_csv, write_points

_ALL = ", ".join(MEASURES)


@query("scan_vitals", cte() + f"SELECT patient_id, reading_id, ts_us, {_ALL} FROM vitals")
def scan_vitals(spark, sf):
    return vitals(spark, sf).select("patient_id", "reading_id", ts_us().alias("ts_us"), *MEASURES)


@query("scan_csv", cte() + f"SELECT patient_id, reading_id, ts_us, {_ALL} FROM vitals")
def scan_csv(spark, sf):
    """Readings written as CSV to the shared folder and read back with the fixed schema."""
    path = shared_dir(spark, "csv")
    write_csv(vitals(spark, sf), path)
    return read_vitals(spark, path, "csv").select("patient_id", "reading_id", ts_us().alias("ts_us"), *MEASURES)


def _good(spark, sf):
    return decode(messages(vitals(spark, sf)))[0]


@query(
    "json_decode",
    cte(DECODED) + "SELECT CAST(patient_id AS VARCHAR) AS patient_id, CAST(reading_id AS VARCHAR) AS reading_id, "
    "CASE WHEN reading_id%103=1 THEN NULL WHEN reading_id%107=2 THEN NULL ELSE SBP END AS SBP, DBP, HR, CO FROM decoded",
)
def json_decode(spark, sf):
    numbers = [F.col(c).try_cast("double").alias(c) for c in ("SBP", "DBP", "HR", "CO")]
    return _good(spark, sf).select("patient_id", "reading_id", *numbers)


@query(
    "alias_normalize",
    cte(DECODED) + "SELECT reading_id, CAST(floor(epoch(t)) AS BIGINT) AS sec, SPO2 FROM decoded",
)
def alias_normalize(spark, sf):
    typed = cast_vitals(normalize_aliases(_good(spark, sf)), required=())
    return typed.select("reading_id", F.unix_seconds("DateTime").alias("sec"), "SPO2")


@query(
    "cast_dropna",
    cte(DECODED) + f"SELECT reading_id, SBP, DBP FROM decoded WHERE NOT {BAD_SBP}",
)
def cast_dropna(spark, sf):
    return cast_vitals(normalize_aliases(_good(spark, sf))).select("reading_id", "SBP", "DBP")


@query(
    "dead_letter",
    cte() + "SELECT reading_id, CASE WHEN reading_id%101=0 THEN 'not JSON' ELSE 'unreadable SBP' END AS reason FROM vitals "
    f"WHERE reading_id%101=0 OR {BAD_SBP}",
)
def dead_letter(spark, sf):
    lost = dead_letters(messages(vitals(spark, sf)))
    at = F.coalesce(F.get_json_object("payload", "$.reading_id"), F.regexp_extract("payload", "([0-9]+)$", 1))
    return lost.select(at.cast("long").alias("reading_id"), "reason")


@query(
    "json_encode",
    cte() + """SELECT '{"patient_id":' || CAST(patient_id AS VARCHAR) || '}' AS key,
    '{"reading_id":' || CAST(reading_id AS VARCHAR) || ',"DateTime":"' || strftime(DateTime, '%Y-%m-%d %H:%M:%S') ||
    '"' || CASE WHEN SBP<>0 THEN ',"BP_level":"' || """ + level_sql() + """ || '"' ELSE '' END || '}' AS value FROM vitals""",
)
def json_encode(spark, sf):
    v = vitals(spark, sf).withColumn("BP_level", F.when(valid_bp(), rules.bp_level("SBP", "DBP")))
    v = v.withColumn("DateTime", F.date_format("DateTime", "yyyy-MM-dd HH:mm:ss"))
    return encode_kv(v, ["patient_id"], ["reading_id", "DateTime", "BP_level"])


@query(
    "to_points",
    cte("levels AS (SELECT *, " + level_sql() + " AS BP_level FROM vitals)")
    + " UNION ALL ".join(
        f"SELECT 'vitals' AS measurement, CAST(patient_id AS VARCHAR) AS patient_id, '{f}' AS field, "
        + (f"{f} AS value, CAST(NULL AS VARCHAR) AS value_str" if f != "BP_level" else "NULL AS value, BP_level AS value_str")
        + ", ts_us FROM levels"
        for f in ("SBP", "DBP", "HR", "BP_level")
    ),
)
def points_of_readings(spark, sf):
    v = vitals(spark, sf).withColumn("BP_level", rules.bp_level("SBP", "DBP"))
    p = to_points(v, "vitals", ("patient_id",), ("SBP", "DBP", "HR", "BP_level"))
    return p.select("measurement", F.col("tags")["patient_id"].alias("patient_id"), "field", "value", "value_str",
                    ts_us("time").alias("ts_us"))


@query(
    "from_points",
    cte() + "SELECT ts_us, CAST(patient_id AS VARCHAR) AS patient_id, reading_id, SBP, DBP FROM vitals",
)
def wide_from_points(spark, sf):
    wide = from_points(points(spark, sf), ("SBP", "DBP"), ("patient_id",), ("reading_id",))
    return wide.select(ts_us("time").alias("ts_us"), "patient_id", "reading_id", "SBP", "DBP")


@query(
    "points_range",
    points_cte() + "SELECT reading_id, value, ts_us FROM points WHERE field='SBP' "
    "AND time >= TIMESTAMP '2024-01-10 00:00:00' AND time < TIMESTAMP '2024-01-20 00:00:00'",
)
def range_of_points(spark, sf):
    """Points of a stored table, partitioned by measurement and date."""
    path = shared_dir(spark, "points")
    write_points(points(spark, sf), path)
    p = points_range(spark.read.parquet(path), "vitals", ["SBP"], "2024-01-10 00:00:00", "2024-01-20 00:00:00")
    return p.select("reading_id", "value", ts_us("time").alias("ts_us"))


@query(
    "line_protocol_ingest",
    cte("levels AS (SELECT *, " + level_sql() + " AS lvl FROM vitals)")
    + "SELECT 'bed side' AS measurement, CAST(patient_id AS VARCHAR) AS patient, 'SBP' AS field, SBP AS value, NULL AS value_str, ts_us FROM levels "
    "UNION ALL SELECT 'bed side', CAST(patient_id AS VARCHAR), 'reading', CAST(reading_id AS DOUBLE), NULL, ts_us FROM levels "
    "UNION ALL SELECT 'bed side', CAST(patient_id AS VARCHAR), 'lost', CASE WHEN SBP=0 THEN 1e0 ELSE 0e0 END, NULL, ts_us FROM levels "
    "UNION ALL SELECT 'bed side', CAST(patient_id AS VARCHAR), 'level', NULL, concat(lvl, ', checked'), ts_us FROM levels",
)
def line_protocol_ingest(spark, sf):
    v = vitals(spark, sf)
    line = F.concat(
        F.lit("bed\\ side,patient="), F.col("patient_id").cast("string"),
        F.lit(" SBP="), F.col("SBP").cast("string"),
        F.lit(",reading="), F.col("reading_id").cast("string"), F.lit("i,lost="),
        F.when(F.col("SBP") == 0, "t").otherwise("false"),
        F.lit(',level="'), rules.bp_level("SBP", "DBP"), F.lit(', checked" '),
        ts_us().cast("string"), F.lit("000"),
    )
    p = parse_line_protocol(v.select(line.alias("line")))
    return p.select("measurement", F.col("tags")["patient"].alias("patient"), "field", "value", "value_str",
                    ts_us("time").alias("ts_us"))
