"""Consolidated projections of movements and returns, and their partitioned sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actaflow import schemas as S
from actaflow.functions import text as T
from actaflow.operators.dedup import load_key, new_rows


def _filled(column: str, sentinel: str):
    return F.coalesce(F.nullif(F.trim(F.col(column)), F.lit("")), F.lit(sentinel))


def _common(rows: DataFrame, date: str) -> list:
    governor = _filled("governador_edicao", S.UNKNOWN)
    return [
        F.col("nome_normalizado").alias("pessoa"), F.col("estado"), F.year(F.col(date)).alias("ano"), F.col("tipo_ato"), T.agency(F.col("orgao")).alias("orgao"), F.col("cargo"),
        _filled("cargo_assinante", S.UNSIGNED).alias("autoridade_assinante"), T.authorship(F.col("cargo_assinante")).alias("autoria_ato"),
        governor.alias("governador_edicao"), T.representative(governor).alias("representante_governo"), T.origin(governor).alias("origem_representante"),
        F.concat(T.representative(governor), F.lit(" ("), T.origin(governor), F.lit(")")).alias("representante_origem"),
    ]


def movements(rows: DataFrame) -> DataFrame:
    """One row per act of a timeline. A null governor, signer or agency gets its sentinel or ``""``."""
    return rows.select("linha_csv", *_common(rows, "data"), F.col("data").alias("data_movimentacao"))


def returns(rows: DataFrame) -> DataFrame:
    """One row per return, with duration class and state label; a missing change flag counts as no change."""
    days = F.col("dias_desde_exoneracao")
    return rows.where("retorno").select(
        "linha_csv", *_common(rows, "data"), F.col("data").alias("data_nomeacao"), "data_exoneracao", "dias_desde_exoneracao",
        F.coalesce("mudou_cargo", F.lit(False)).alias("mudou_cargo"), F.coalesce("mudou_orgao", F.lit(False)).alias("mudou_orgao"),
        T.duration_class(days).alias("tempo_cluster"), T.state_label(days, F.col("mudou_cargo"), F.col("mudou_orgao")).alias("estado_n"))


def write_partitioned(rows: DataFrame, path: str, by: str = "estado", mode: str = "overwrite") -> None:
    """Parquet with zstd, one folder per ``by``; hash clustering first, so each task opens few folders."""
    rows.repartition(by).write.mode(mode).partitionBy(by).option("compression", "zstd").parquet(path)


def entity_filter(rows: DataFrame, column: str = "spacy_entidades") -> DataFrame:
    """Rows whose recognised entities hold a person, or that have none."""
    text = F.coalesce(F.col(column), F.lit(""))
    return rows.where(F.contains(text, F.lit(":PER")) | (F.trim(text) == ""))


def recognised(rows: DataFrame, mode: str = "marcar") -> DataFrame:
    """Acts by what entity recognition said of the name: ``filter`` drops those it denied, ``filtrar`` keeps all and adds a reason."""
    denied = ~F.coalesce(F.col("spacy_pessoa"), F.lit("")).isin("sim", "indisponivel")
    if mode == "filter":
        return rows.where(F.coalesce(F.col("spacy_pessoa"), F.lit("")) != "nao")
    reason = T.rejection_reasons(F.col("nome"))
    extra = F.when((reason == "") & denied, "spacy_nao_confirmou_pessoa").otherwise(reason) if mode == "filtrar" else reason
    return rows.withColumn("motivo_rejeicao", extra)


def by_section(rows: DataFrame, words: str, column: str = "caderno", start: bool = False) -> DataFrame:
    """Rows whose section holds (or begins with) ``words``, accents and case aside."""
    text = T.normalize_text(F.col(column))
    wanted = T.normalize_text(F.lit(words))
    return rows.where(F.startswith(text, wanted) if start else F.contains(text, wanted))


def real_people(rows: DataFrame, starts: tuple[str, ...]) -> DataFrame:
    """Acts whose name doesn't begin with one of ``starts`` (words that some gazettes put where a name stands)."""
    return rows.where(~F.coalesce(F.upper(F.get(F.split("nome", " "), F.lit(0))).isin(*starts), F.lit(False)))


def states_with_both(first: DataFrame, second: DataFrame, column: str = "estado") -> DataFrame:
    """States that have rows in both tables."""
    return first.select(column).distinct().join(second.select(column), column, "left_semi")


def processed_range(rows: DataFrame, date: str, low: str | None = None, high: str | None = None) -> DataFrame:
    """First and last processed day: given bounds win over those of the rows."""
    return rows.agg(F.coalesce(F.lit(low).cast("date"), F.min(date)).alias("primeira"), F.coalesce(F.lit(high).cast("date"), F.max(date)).alias("ultima"))


def incremental_rows(existing: DataFrame, incoming: DataFrame, date: str = "data") -> DataFrame:
    """Incoming acts outside the range of the existing ones, or inside it with a key these don't have.

    ``existing`` and ``incoming`` have the columns of the analysis key; the range is one row.
    """
    bounds = existing.agg(F.min(date).alias("_a"), F.max(date).alias("_b"))
    rows = incoming.join(F.broadcast(bounds))  # one row
    inside = F.coalesce(F.col(date).between(F.col("_a"), F.col("_b")), F.lit(False))
    rows = rows.withColumn("_dentro", inside).drop("_a", "_b")
    return rows.where("not _dentro").unionByName(new_rows(existing, rows.where("_dentro"), load_key())).drop("_dentro")
