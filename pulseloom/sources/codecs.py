"""Messages: JSON payloads to typed readings and back, and line-protocol text to points."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseloom.schema import ALIASES, MEASURES, TIME_FORMATS, distinct_names, message_schema
from pulseloom.sources.readers import nan_to_null

CORRUPT = "_corrupt_record"
NOT_JSON = "not JSON"


def _parsed(df: DataFrame, schema: T.StructType | None, value_col: str):
    """(messages with `_text`, `_data` and `_broken`, the other columns, the payload's columns)."""
    schema = schema or message_schema()
    wide = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    names = distinct_names(wide.fieldNames())
    columns = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, wide.fields)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    others = [c for c in df.columns if c not in names and c != value_col]
    text = df.select(*others, F.col(value_col).cast("string").alias("_text"))
    # inline keeps the parser in a step of its own: a projection would parse once per field used
    data = F.from_json("_text", wide, options).cast(columns)
    parsed = text.select("*", F.inline(F.array(F.struct(data.alias("_data"), F.isnull("_text").alias("_none")))))
    broken = F.col("_none") | F.col(f"_data.{CORRUPT}").isNotNull()
    return parsed.withColumn("_broken", broken), others, [n for n in names if n != CORRUPT]


def decode(df: DataFrame, schema: T.StructType | None = None, value_col: str = "value"):
    """Split messages into (good, bad): parsed payload columns, and payloads that are no JSON object."""
    parsed, others, names = _parsed(df, schema, value_col)
    good = parsed.filter("not _broken").select(*others, *[F.col(f"_data.{n}") for n in names])
    bad = parsed.filter("_broken").select(*others, F.col("_text").alias("payload"))
    return good, bad


def normalize_aliases(df: DataFrame) -> DataFrame:
    """One column per quantity, whichever spelling a message used."""
    names = {a: name for name, group in ALIASES.items() for a in group}
    groups = {}
    for c in df.columns:
        spelling = c.split("__")[0]
        groups.setdefault(names.get(spelling, spelling), []).append(F.col(c))
    return df.select(*[F.coalesce(*cols).alias(name) for name, cols in groups.items()])


def parse_time(c) -> Column:
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in TIME_FORMATS])


def _casts(df: DataFrame, time: str) -> dict[str, Column]:
    """The typed value of every column that has a type to get; not-a-number is missing."""
    numbers = {c: F.col(c).try_cast("double") for c in MEASURES if c in df.columns}
    casts = {c: F.when(~F.isnan(v), v) for c, v in numbers.items()}
    casts |= {c: F.col(c).try_cast("long") for c in ("patient_id", "reading_id") if c in df.columns}
    if time in df.columns and isinstance(df.schema[time].dataType, T.StringType):
        casts[time] = parse_time(F.col(time))
    return casts


def cast_vitals(df: DataFrame, required=("SBP", "DBP"), time="DateTime") -> DataFrame:
    """Text to numbers and times; unreadable values become null, rows without a required value go."""
    casts = _casts(df, time)
    typed = df.select(*[casts[c].alias(c) if c in casts else F.col(c) for c in df.columns])
    return nan_to_null(typed).dropna(subset=list(required))


def checked(df: DataFrame, value_col: str = "value", time: str = "DateTime") -> DataFrame:
    """Every message as a typed reading, parsed once, with its `_payload` and its `_faults`.

    `_faults` is an array: "not JSON", or the name of each column whose value was there and is missing after the very cast that
    the reading went through. A message without faults has an empty array; one that is no JSON has no values.
    """
    parsed, others, names = _parsed(df, None, value_col)
    flat = parsed.select(*others, F.col("_text").alias("_payload"), "_broken", *[F.col(f"_data.{n}") for n in names])
    text = normalize_aliases(flat)
    casts = _casts(text, time)
    order = [c for c in (*MEASURES, "patient_id", "reading_id", time) if c in casts]
    # the casts stand in a step of their own too, so that values and faults come from one evaluation
    values = F.struct(*[casts[c].alias(c) for c in order])
    typed = text.select("*", F.inline(F.array(F.struct(values.alias("_typed")))))
    lost = [F.when(F.col(c).isNotNull() & F.col(f"_typed.{c}").isNull(), F.lit(c)) for c in order]
    faults = F.array_compact(F.array(F.when(F.col("_broken"), F.lit(NOT_JSON)), *[F.when(~F.col("_broken"), x) for x in lost]))
    columns = [F.col(f"_typed.{c}").alias(c) if c in order else F.col(c) for c in text.columns if c != "_broken"]
    return typed.select(*columns, faults.alias("_faults"))


def good_readings(read: DataFrame) -> DataFrame:
    """The readings among `checked` messages; a value that could not be read is missing."""
    return read.filter(~F.array_contains("_faults", NOT_JSON)).drop("_payload", "_faults")


def faults(read: DataFrame) -> DataFrame:
    """(payload, reason) of the `checked` messages that lost something."""
    broken = F.array_contains("_faults", NOT_JSON)
    reason = F.when(broken, F.lit(NOT_JSON)).otherwise(F.concat(F.lit("unreadable "), F.array_join("_faults", ", ")))
    return read.filter(F.size("_faults") > 0).select(F.col("_payload").alias("payload"), reason.alias("reason"))


def fault_counts(read: DataFrame) -> DataFrame:
    """(fault, n): how many `checked` messages have each fault, and how many there are in all (fault `any message`)."""
    each = read.select(F.explode(F.array_append("_faults", F.lit("any message"))).alias("fault"))
    return each.groupBy("fault").agg(F.count(F.lit(1)).alias("n"))


def dead_letters(df: DataFrame, value_col: str = "value", time: str = "DateTime") -> DataFrame:
    """(payload, reason) of messages that are no JSON object or have a value that cannot be read.

    The latter are decoded as well, with that value missing; here they are on record.
    """
    return faults(checked(df, value_col, time))


def encode_kv(df: DataFrame, key_cols, value_cols) -> DataFrame:
    """Key and value as JSON text; empty fields are left out."""
    return df.select(F.to_json(F.struct(*key_cols)).alias("key"), F.to_json(F.struct(*value_cols)).alias("value"))


def parse_line_protocol(df: DataFrame, col: str = "line") -> DataFrame:
    """`measurement,tag=v field=1.5,flag=2i,text="x" 1700000000000000000` to points.

    Backslash escapes protect commas, spaces and equal signs; in quoted text these need none.
    """
    name = r"(?=[^,=\s])[^,=\s\\]*+(?:\\.[^,=\s\\]*+)*+"
    text = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
    value = rf"(?:{text}|[^,\s\"][^,\s]*+)"
    head = r"(?=[^,\s])[^,\s\\]*+(?:\\.[^,\s\\]*+)*+"
    line = rf"^({head})((?:,{name}={name})*+)\s+({name}={value}(?:,{name}={value})*+)(?:\s+(-?\d+))?\s*$"
    mark = "\u0001"

    def plain(c):
        return F.regexp_replace(c, r"\\(.)", "$1")

    # one match per line: the four parts, joined by a mark, come out of a single replacement
    parts = F.split(F.regexp_replace(F.regexp_replace(col, mark, " "), line, mark.join(("$1", "$2", "$3", "$4"))), mark)
    split = df.select(F.inline(F.array(F.struct(parts.alias("p"))))).filter(F.size("p") == 4)
    lines = split.select(*[F.col("p")[i].alias(n) for i, n in enumerate(("m", "tags", "fields", "ns"))])
    tag = rf"({name})=({name})"
    tags = [F.transform(F.regexp_extract_all("tags", F.lit(tag), F.lit(i)), plain) for i in (1, 2)]
    pairs = F.regexp_extract_all("fields", F.lit(rf"{name}={value}"), F.lit(0))
    # tags are read once per line, before its fields are spread over rows
    rows = lines.select(
        plain("m").alias("measurement"),
        F.map_from_arrays(*tags).alias("tags"),
        F.timestamp_micros(F.floor(F.nullif(F.col("ns"), F.lit("")).cast("decimal(20,0)") / 1000).cast("long")).alias("time"),
        pairs.alias("pairs"),
    )
    rows = rows.withColumn("f", F.explode("pairs")).drop("pairs")
    rows = rows.withColumn("k", F.regexp_extract("f", rf"^{name}", 0)).withColumn("v", F.expr("substring(f, length(k) + 2)"))
    raw = F.col("v")
    quoted = raw.startswith('"')
    flag = F.when(raw.isin("t", "T", "true", "True", "TRUE"), 1.0).when(raw.isin("f", "F", "false", "False", "FALSE"), 0.0)
    number = F.regexp_replace(raw, "[iu]$", "").try_cast("double")
    return rows.select(
        "measurement",
        "tags",
        plain("k").alias("field"),
        F.when(~quoted, F.coalesce(flag, number)).alias("value"),
        F.when(quoted, F.regexp_replace(F.regexp_extract(raw, '^"(.*)"$', 1), r'\\(["\\])', "$1")).alias("value_str"),
        "time",
    )
