"""Column names, table schemas and message schemas."""

from pyspark.sql import types as T

KEY = ("patient_id",)
ORDER = ("DateTime", "reading_id")

# The eight measured columns, in the order every table carries them.
MEASURES = ("RR", "SPO2", "MAP", "SBP", "DBP", "HR", "PP", "CO")

VITALS = T.StructType(
    [
        T.StructField("patient_id", T.LongType()),
        T.StructField("reading_id", T.LongType()),
        T.StructField("DateTime", T.TimestampType()),
    ]
    + [T.StructField(c, T.DoubleType()) for c in MEASURES]
)

# Other spellings of a column seen in message payloads.
ALIASES = {
    "DateTime": ("DateTime", "Timestamp", "DATETIME", "TimeStamp"),
    "SPO2": ("SPO2", "SPO"),
}

# Accepted time formats, tried in this order.
TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm")


def distinct_names(names) -> list:
    """Column names for JSON fields: Spark ignores case in column names, JSON does not."""
    out, seen = [], {}
    for n in names:
        k = n.lower()
        seen[k] = seen.get(k, 0) + 1
        out.append(n if seen[k] == 1 else f"{n}__{seen[k]}")
    return out


def message_schema(aliases: bool = True) -> T.StructType:
    """Payload schema: every value is a string; with `aliases`, the superset of all spellings."""
    names = ["patient_id", "reading_id"]
    for c in ("DateTime",) + MEASURES:
        names += ALIASES.get(c, (c,)) if aliases else (c,)
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


FORECAST_MESSAGE = T.StructType(
    [
        T.StructField("sbp_predictions", T.ArrayType(T.DoubleType())),
        T.StructField("dbp_predictions", T.ArrayType(T.DoubleType())),
        T.StructField("timestamps", T.ArrayType(T.StringType())),
    ]
)
