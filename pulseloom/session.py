"""Session helpers: the settings the operators rely on and the shared working folder."""

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Time arithmetic assumes UTC; skewed joins are split by adaptive execution."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that Python workers can import it anywhere."""
    sc = spark.sparkContext
    if getattr(sc, "_pulseloom_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="pulseloom-code-"), "pulseloom.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                z.write(path, os.path.join("pulseloom", os.path.relpath(path, root)))
    sc.addPyFile(archive)
    sc._pulseloom_shipped = True


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared folder (`spark.checkpoint.dir`).

    Without that setting only a local session gets a folder of its own; on a cluster a
    machine-local folder would be lost with its executor, so it is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="pulseloom-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialize(df, purpose: str):
    """Write `df` once to the shared folder and return the written table (cuts the lineage)."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
