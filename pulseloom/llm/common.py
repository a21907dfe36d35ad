"""Helpers shared by the corpus operators: batch functions over text, keys of rows, written tables."""

import os

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from pulseloom.session import configure, materialize, shared_dir  # noqa: F401

#: The characters that separate words in the corpus contracts: space, tab, newline, VT, FF, CR.
SPACE = " \t\n\x0b\x0c\r"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the corpus operators: small Arrow batches, so that long texts fit a worker."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def free(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames uses."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_text(df: DataFrame, fn, fields: str | T.StructType, text="text", keep=("doc_id",), raw=False) -> DataFrame:
    """Columns `keep` plus the `fields` that `fn(list of texts) -> dict of lists` computes, batch by batch.

    A null text is given as an empty one; `raw` gives an Arrow array in place of a list. A kept column that has the name of a new field is replaced.
    """
    new = T.StructType.fromDDL(fields) if isinstance(fields, str) else fields
    keep = [c for c in keep if c not in new.fieldNames()]
    types = [to_arrow_type(f.dataType) for f in new]
    schema = T.StructType([df.schema[c] for c in keep] + list(new))

    def run(batches):
        for b in batches:
            texts = pc.fill_null(b.column(len(keep)), "")
            out = fn(texts if raw else texts.to_pylist())
            made = [x if isinstance(x := out[f.name], pa.Array) else pa.array(x, t) for f, t in zip(new, types)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), *made], names=schema.fieldNames())

    return df.select(*keep, df[text].alias(free("text__", df))).mapInArrow(run, schema)


def text_key(text="text") -> Column:
    """128 bits that name a text; null and empty are one text."""
    t = F.coalesce(F.col(text), F.lit(""))
    return F.struct(F.xxhash64(t).alias("a"), F.xxhash64(t, F.lit(1)).alias("b"))


def fold(id_col="doc_id") -> Column:
    """crc32 of the id's digits modulo 5; 0 is the held-out part. A null id counts as the text "null"."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).cast("binary")) % 5


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: tuple[int, int], max_chars: int) -> list[tuple[str, int]]:
    """At most `per_class` labelled texts of class 0 and 1, in the order of a hash of the id, none held out.

    Bounds: sum(per_class) rows of at most `max_chars` characters come to the driver.
    """
    train = labels.filter(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("y")).filter(fold() != 0)
    ids: list[tuple[int, int]] = []
    for y in (0, 1):
        first = train.filter(F.col("y") == y).select("doc_id", "y").distinct().orderBy(F.xxhash64(F.col("doc_id"), F.lit(7)), "doc_id").limit(per_class[y])
        ids += [(r.doc_id, r.y) for r in first.collect()]
    if not ids:
        return []
    wanted = docs.sparkSession.createDataFrame(ids, "doc_id long, y int")
    rows = docs.select("doc_id", "text").filter(F.length("text").between(1, max_chars)).join(F.broadcast(wanted), "doc_id")
    rows = rows.withColumn("h", F.xxhash64("text")).dropDuplicates(["doc_id", "y", "h"])
    return sorted((r.text, r.y) for r in rows.orderBy("h", "doc_id", "y").limit(sum(per_class)).select("text", "y").collect())


def remote(uri: str):
    """None for a folder of the local file system (all executors share it), else its pyarrow file system and path."""
    if "://" not in uri and not uri.startswith("file:"):
        return None, uri
    if uri.startswith("file:"):
        return None, "/" + uri[5:].lstrip("/")
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def open_output(uri: str):
    """A binary stream to a new file of the shared folder."""
    store, path = remote(uri)
    if store is None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb")
    return store.open_output_stream(path)


def open_input(uri: str):
    """A binary stream, with seek, from a file of the shared folder."""
    store, path = remote(uri)
    return open(path, "rb") if store is None else store.open_input_file(path)
