"""Readers and writers: document lake, act tables as CSV and Parquet, failures, markers of complete years."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from actaflow import schemas as S
from actaflow.operators.dedup import complete_columns, first_wins, maintenance_key, missing_columns, new_rows, write_key
from actaflow.runtime import cut, ship_code


@F.pandas_udf(StringType())
def decoded(content: pd.Series) -> pd.Series:
    """UTF-8 text; bytes that aren't are dropped."""
    return content.map(lambda b: bytes(b).decode("utf-8", "ignore"))


def file_date(name: Column) -> Column:
    return F.try_to_date(F.regexp_extract(name, r"_(\d{4}-\d{2}-\d{2})\.md$", 1))


def section_of(name: Column) -> Column:
    """Section from a file name ``CODE_SECTION_NAME_yyyy-mm-dd.md``."""
    section = F.regexp_replace(F.regexp_extract(name, r"^[^_]+_(.*)_\d{4}-\d{2}-\d{2}\.md$", 1), "_", " ")
    return F.coalesce(F.nullif(F.initcap(F.lower(section)), F.lit("")), F.lit("Caderno não identificado"))


def lake_documents(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """``path, estado, data_publicacao, caderno, text`` of every Markdown file below ``path``.

    The date and section come from the file name, so a date range prunes files before they are decoded.
    """
    ship_code(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    files = files.select("path", F.regexp_extract("path", r"/([A-Z]{2})/\d{4}/\d{2}/[^/]+$", 1).alias("estado"), file_date(name).alias("data_publicacao"), section_of(name).alias("caderno"), "content")
    if first:
        files = files.where(F.col("data_publicacao") >= F.lit(first).cast("date"))
    if last:
        files = files.where(F.col("data_publicacao") <= F.lit(last).cast("date"))
    return files.select("path", "estado", "data_publicacao", "caderno", decoded("content").alias("text"))


def csv_files(spark: SparkSession, root: str, state: str | None = None, years: tuple[int, ...] = (), yearly_only: bool = False) -> DataFrame:
    """``path, estado, ano`` of the act tables below ``root``, ``<UF>/<code>_<yyyy>.csv``; results of analyses are left out.

    Files are listed, not read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(root)
    year = F.regexp_extract("path", r"(?i)_((?:19|20)\d{2})\.csv$", 1)
    out = files.select("path", F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("estado"), F.nullif(year, F.lit("")).cast("int").alias("ano")).where("not lower(path) like '%/analises/%'")
    out = out.where(F.upper("estado") == state.upper()) if state else out
    out = out.where(F.col("ano").isin(*years)) if years else out
    return out.where("ano is not null") if yearly_only else out


def states_of(spark: SparkSession, root: str, years: tuple[int, ...] = ()) -> DataFrame:
    """States with at least one act table."""
    return csv_files(spark, root, None, years).select(F.upper("estado").alias("estado")).distinct()


def _records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for path, content in zip(b["path"], b["content"], strict=True):
            rows = csv.DictReader(io.TextIOWrapper(io.BytesIO(bytes(content)), encoding="utf-8", newline=""))
            have = rows.fieldnames or []
            out = [(path, n, have, *[(r.get(c) or "") for c in S.ACT_COLUMNS]) for n, r in enumerate(rows, start=2)]
            yield pd.DataFrame(out, columns=["arquivo_csv", "linha_csv", "colunas", *S.ACT_COLUMNS])


def read_acts_csv(spark: SparkSession, root: str, state: str | None = None, years: tuple[int, ...] = (), yearly_only: bool = False) -> DataFrame:
    """The 22 act columns as text (missing ones and empty fields ``""``), ``arquivo_csv`` and ``linha_csv``, the row's place in its file (2 for the first).

    A file is read by one task, as places need its order; files are of one state and year.
    """
    ship_code(spark)
    wanted = csv_files(spark, root, state, years, yearly_only).select("path")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(root).join(wanted, "path", "left_semi")
    fields = ", ".join(f"{c} string" for c in S.ACT_COLUMNS)
    return files.select("path", "content").mapInPandas(_records, f"arquivo_csv string, linha_csv bigint, colunas array<string>, {fields}")


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def write_acts(rows: DataFrame, path: str) -> int:
    """Add the acts whose key ``path`` doesn't hold yet, the first of each; the number of new ones.

    A Parquet table (zstd) by state and year. Partitions with new rows are written anew, others stay.
    """
    spark = rows.sparkSession
    shaped = complete_columns(rows, S.ACT_COLUMNS).withColumn("uf", F.col("estado")).withColumn("ano", F.substring("data_publicacao", 1, 4))
    shaped = shaped.withColumn("_ordem", F.monotonically_increasing_id())
    fresh = shaped
    if _exists(spark, path):
        old = spark.read.parquet(path)
        fresh = new_rows(old, shaped, write_key())
    fresh = cut(fresh, "incoming")
    fresh = cut(first_wins(fresh, write_key(), "_ordem").drop("_ordem"), "fresh")
    n = fresh.count()
    if n:
        fresh.hint("rebalance", "uf", "ano").write.mode("append").partitionBy("uf", "ano").option("compression", "zstd").parquet(path)
    return n


def write_csv(rows: DataFrame, path: str) -> None:
    """Acts as CSV below ``path``, by state and year, with a header even if there are no rows."""
    out = complete_columns(rows, S.ACT_COLUMNS).withColumn("uf", F.col("estado")).withColumn("ano", F.substring("data_publicacao", 1, 4))
    out.hint("rebalance", "uf", "ano").write.mode("overwrite").partitionBy("uf", "ano").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def deduplicate_files(spark: SparkSession, root: str, state: str | None = None, chars: int = 240, dry_run: bool = True) -> DataFrame:
    """Report of the maintenance deduplication, a row a file; files with repeats are written anew unless ``dry_run``.

    ``arquivo, linhas_antes, linhas_depois, duplicatas_removidas, status``. A file that lacks a key column is left as it is.
    """
    rows = cut(read_acts_csv(spark, root, state, yearly_only=True), "act-files")
    needed = ("data_publicacao", "caderno", "tipo_ato", "nome", "cargo", "orgao", "assinante", "trecho")
    gone = F.array_except(F.array(*[F.lit(c) for c in needed]), "colunas")
    kept = cut(first_wins(rows.withColumn("_id", F.concat_ws("#", "arquivo_csv", F.lpad(F.col("linha_csv").cast("string"), 12, "0"))), maintenance_key(chars), "_id", within=("arquivo_csv",)).drop("_id"), "kept")
    before = rows.groupBy(F.col("arquivo_csv").alias("arquivo")).agg(F.count("*").alias("linhas_antes"), F.first(gone).alias("faltam"))
    after = kept.groupBy(F.col("arquivo_csv").alias("arquivo")).agg(F.count("*").alias("n"))
    sound = F.size("faltam") == 0
    report = before.join(after, "arquivo").select(
        "arquivo", "linhas_antes", F.when(sound, F.col("n")).otherwise(F.col("linhas_antes")).alias("linhas_depois"),
        F.when(sound, F.col("linhas_antes") - F.col("n")).otherwise(F.lit(0)).alias("duplicatas_removidas"),
        F.when(~sound, F.concat(F.lit("ignorado: colunas ausentes ("), F.array_join("faltam", ", "), F.lit(")"))).otherwise(F.lit("simulado" if dry_run else "atualizado")).alias("status"))
    report = cut(report, "dedup-report")
    if not dry_run:
        for r in report.where("duplicatas_removidas > 0").collect():  # one row a file
            _replace_file(spark, kept.where(F.col("arquivo_csv") == r.arquivo).orderBy("linha_csv"), r.arquivo)
    return report


def _replace_file(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Write rows beside a CSV file, then put the new file in its place."""
    have = rows.select("colunas").first().colunas
    columns = [F.col(c) if c in S.ACT_COLUMNS else F.lit("").alias(c) for c in have]
    rows.select(*columns).coalesce(1).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").csv(f"{path}.tmp")
    Path = spark._jvm.org.apache.hadoop.fs.Path
    files = Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    part = next(s.getPath() for s in files.listStatus(Path(f"{path}.tmp")) if s.getPath().getName().startswith("part-"))
    files.delete(Path(path), False)
    files.rename(part, Path(path))
    files.delete(Path(f"{path}.tmp"), True)


def dedup_totals(report: DataFrame) -> DataFrame:
    return report.agg(*[F.sum(c).alias(c) for c in ("linhas_antes", "linhas_depois", "duplicatas_removidas")])


def mark_year_complete(spark: SparkSession, path: str, state: str, year: int, section: str = "") -> None:
    spark.createDataFrame([(state, year, section)], "uf string, ano int, caderno string").write.mode("append").parquet(path)


def complete_years(spark: SparkSession, path: str) -> DataFrame:
    """``uf, ano, caderno`` of years marked complete; none if nothing was marked."""
    schema = "uf string, ano int, caderno string"
    return spark.read.schema(schema).parquet(path).distinct() if _exists(spark, path) else spark.createDataFrame([], schema)


def append_failures(rows: DataFrame, path: str) -> None:
    rows.select("registrado_em", "data_publicacao", "caderno", "etapa", "url", "erro").write.mode("append").parquet(path)


__all__ = ["append_failures", "complete_years", "csv_files", "decoded", "dedup_totals", "deduplicate_files", "lake_documents", "mark_year_complete", "missing_columns", "read_acts_csv", "states_of", "write_acts", "write_csv"]
