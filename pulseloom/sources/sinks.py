"""Writers for tables, points and streams."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, one file per task: no forced single file."""
    df.write.option("header", True).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").csv(path)


def write_points(df: DataFrame, path: str, mode: str = "append") -> None:
    """Points partitioned by measurement and date, the columns dashboards filter on."""
    dated = df.withColumn("date", F.to_date("time"))
    dated.write.mode(mode).partitionBy("measurement", "date").parquet(path)


def write_stream(df: DataFrame, fmt: str, options: dict, checkpoint: str, trigger: dict | None = None, mode: str = "append"):
    """Start a query. Every query needs a checkpoint folder of its own."""
    if not checkpoint:
        raise ValueError("a streaming query needs its own checkpoint folder")
    if fmt == "kafka" and not {"kafka.bootstrap.servers", "topic"} <= options.keys():
        raise ValueError("kafka needs kafka.bootstrap.servers and topic")
    writer = df.writeStream.format(fmt).options(**options).option("checkpointLocation", checkpoint)
    return writer.outputMode(mode).trigger(**(trigger or {"availableNow": True})).start()


def debug_stream(df: DataFrame, checkpoint: str, seconds: int = 30, trigger: dict | None = None):
    """Print changed rows every so many seconds."""
    if not checkpoint:
        raise ValueError("a streaming query needs its own checkpoint folder")
    writer = df.writeStream.format("console").outputMode("update").option("truncate", False).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": f"{seconds} seconds"})).start()


def batch_writer(sinks: dict):
    """One pass over each micro-batch for several sinks: name -> (function of the batch, folder).

    A batch that is repeated after a failure overwrites its own folder, so nothing is doubled. Points (rows with a
    measurement and a time) are partitioned by measurement and date below it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if len(sinks) == 1:
            out(batch, batch_id)
            return
        # the extra column makes Spark forget the row order of the streaming plan, which refers
        # to attributes a cached table does not have
        kept = batch.withColumn("_batch", F.lit(batch_id)).persist()
        try:
            out(kept.drop("_batch"), batch_id)
        finally:
            kept.unpersist()

    def out(batch: DataFrame, batch_id: int) -> None:
        for make, path in sinks.values():
            made, target = make(batch), f"{path}/batch_id={batch_id}"
            if {"measurement", "time"} <= set(made.columns):
                write_points(made, target, "overwrite")
            else:
                made.write.mode("overwrite").parquet(target)

    return write


def read_state(spark, checkpoint: str, keys, values) -> DataFrame:
    """The rows that the aggregation of a query keeps as state, as of its last finished batch: key columns, then the fields of
    its running values, under the given names.

    Spark keeps and changes them incrementally, so reading costs the state's size and keeping it nothing beyond the batch.
    """
    state = spark.read.format("statestore").load(checkpoint)

    def renamed(column, names):
        fields = state.schema[column].dataType.fields
        kind = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, fields, strict=True)])
        return F.col(column).cast(kind).alias(column)

    return state.select(renamed("key", keys), renamed("value", values)).select("key.*", "value.*")
