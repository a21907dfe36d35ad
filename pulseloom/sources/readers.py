"""Batch and stream readers. Schemas are fixed; nothing is inferred."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseloom.schema import VITALS


def nan_to_null(df: DataFrame) -> DataFrame:
    """Not-a-number means missing: Spark would sort it above every value."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns])


def read_vitals(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = VITALS) -> DataFrame:
    """Readings from Parquet, CSV with a header, or JSON lines."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return nan_to_null(reader.option("header", True).csv(path))
    return nan_to_null(reader.format(fmt).load(path))


# Options of a message source read from the start, tolerant of expired offsets.
KAFKA_DEFAULTS = {"startingOffsets": "earliest", "failOnDataLoss": "false"}


def source_options(fmt: str, options: dict) -> dict:
    """Options with the defaults of the format; a message source must name servers and topics."""
    if fmt != "kafka":
        return dict(options)
    needed = {"kafka.bootstrap.servers"} - options.keys()
    if needed or not {"subscribe", "subscribePattern", "assign"} & options.keys():
        raise ValueError("kafka needs kafka.bootstrap.servers and subscribe")
    return {**KAFKA_DEFAULTS, **options}


def stream_vitals(spark: SparkSession, fmt: str, options: dict, schema: T.StructType | None = None) -> DataFrame:
    """Streaming DataFrame: `kafka` gives key and value, file formats need a schema and `path`.

    Bound a micro-batch with maxOffsetsPerTrigger or maxFilesPerTrigger.
    """
    reader = spark.readStream.format(fmt).options(**source_options(fmt, options))
    return (reader.schema(schema) if schema is not None else reader).load()
