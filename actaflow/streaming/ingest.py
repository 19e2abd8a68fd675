"""Incremental ingestion: new documents become acts, each file once, with the result of a full run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actaflow.operators.dedup import first_wins, new_rows, write_key
from actaflow.plans.extract import extract_acts


def ingest_documents(spark: SparkSession, source: str, target: str, checkpoint: str) -> None:
    """Process the Parquet files of documents that arrived below ``source`` since the last call.

    The file source's checkpoint remembers what was read. Each micro-batch is deduplicated and appended
    to ``target`` if its key isn't there yet, so a batch that is replayed after a failure adds nothing.
    """
    schema = "doc_id bigint, estado string, caderno string, data_publicacao date, text string"
    stream = spark.readStream.schema(schema).parquet(source)

    def merge(batch: DataFrame, _: int) -> None:
        acts = extract_acts(batch).join(batch.select("doc_id", "caderno", F.col("data_publicacao").cast("string").alias("data_publicacao")).dropDuplicates(["doc_id"]), "doc_id")
        acts = acts.withColumn("linha_csv", F.xxhash64("doc_id", "posicao"))
        key = write_key()
        fresh = first_wins(acts, key)
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(target)
        if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            fresh = new_rows(spark.read.schema(fresh.schema).parquet(target), fresh, key)
        fresh.write.mode("append").parquet(target)

    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def windowed_failures(stream: DataFrame, late: str = "1 day", width: str = "1 hour") -> DataFrame:
    """Failures by hour and step from a stream, with a watermark for late ones."""
    return stream.withWatermark("registrado_em", late).groupBy(F.window("registrado_em", width).alias("janela"), "etapa").agg(F.count("*").alias("falhas"))
