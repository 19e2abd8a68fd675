"""Session helpers shared by every operator: reading tables, shipping code, cutting lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, once for each application: they may not have it on their path."""
    context = spark.sparkContext
    if getattr(context, "_actaflow_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="actaflow-code-")) / "actaflow.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(str(target))
    context._actaflow_shipped = True


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The Parquet table ``name`` below the folder ``base``."""
    ship_code(spark)
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor sees: ``spark.checkpoint.dir``. Only a local master may do without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + os.path.join(tempfile.gettempdir(), "actaflow-shared")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which ends its lineage.

    A lost executor then costs a file read instead of a recomputation. The files go when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Repartition small inputs so that costly per-row work uses every core.

    Only inputs with fewer partitions than cores are moved; large inputs stay as they were read.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
