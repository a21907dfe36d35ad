"""The long table of points: (measurement, tags, field, value, value_str, time)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_points(df: DataFrame, measurement: str, tags=(), fields=(), time="DateTime", extra=()) -> DataFrame:
    """One row per field that is present. Text fields go to `value_str`, all others to `value`.

    `extra` columns, such as the reading id, are kept beside the point.
    """
    entries = []
    for f in fields:
        is_text = isinstance(df.schema[f].dataType, T.StringType)
        number = F.lit(None).cast("double") if is_text else F.col(f).cast("double")
        text = F.col(f) if is_text else F.lit(None).cast("string")
        entries.append(F.struct(F.lit(f).alias("field"), number.alias("value"), text.alias("value_str")))
    pairs = [x for t in tags for x in (F.lit(t), F.col(t).cast("string"))]
    tag_map = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    rows = df.select(
        F.lit(measurement).alias("measurement"), tag_map.alias("tags"), F.inline(F.array(*entries)),
        F.col(time).alias("time"), *extra,
    )
    return rows.filter("value is not null or value_str is not null")


def from_points(df: DataFrame, fields, tags=(), keys=()) -> DataFrame:
    """Back to one row per time, tag values and further `keys`, with a column for each field."""
    tag_cols = [F.col("tags")[t].alias(t) for t in tags]
    rows = df.select("time", *tag_cols, *keys, "field", "value")
    return rows.groupBy("time", *tags, *keys).pivot("field", list(fields)).agg(F.first("value", ignorenulls=True))


def points_range(df: DataFrame, measurement=None, fields=None, start=None, stop=None) -> DataFrame:
    """Points of a measurement in a half-open time range.

    On the partitioned table the derived filter on `date` prunes folders.
    """
    out = df
    if measurement is not None:
        out = out.filter(F.col("measurement") == measurement)
    if fields is not None:
        out = out.filter(F.col("field").isin(*fields))
    for bound, op in ((start, "__ge__"), (stop, "__lt__")):
        if bound is not None:
            at = F.to_timestamp(F.lit(bound))
            out = out.filter(getattr(F.col("time"), op)(at))
            if "date" in df.columns:
                day = F.to_date(at)
                out = out.filter(F.col("date") >= day if op == "__ge__" else F.col("date") <= day)
    return out
