"""First-wins deduplication under named identity policies, never by implicit row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actaflow.functions import text as T


def write_key() -> dict[str, Column]:
    """Identity at write time: raw fields and the first 180 characters of the excerpt."""
    return {c: F.col(c) for c in ("data_publicacao", "caderno", "tipo_ato", "nome")} | {"inicio": F.substring("trecho", 1, 180)}


def maintenance_key(chars: int = 240) -> dict[str, Column]:
    """Identity in maintenance: normalised fields and the start of the normalised excerpt."""
    fields = ("data_publicacao", "caderno", "tipo_ato", "nome", "cargo", "orgao", "assinante")
    # Normalising shortens only blanks and marks: if the start of the text gives enough, the rest needn't be looked at.
    start = T.normalize_text(F.concat(F.substring("trecho", 1, 2 * chars), F.lit("x")))
    enough = F.length(start) > chars + 1
    text = F.when(enough, start).otherwise(T.normalize_text(F.col("trecho")))
    return {c: T.normalize_text(F.col(c)) for c in fields} | {"inicio": F.substring(text, 1, chars)}


def load_key() -> dict[str, Column]:
    """Identity in analysis: no excerpt."""
    raw = {c: F.col(c) for c in ("data_publicacao", "tipo_ato", "fonte_url", "arquivo_markdown")}
    return raw | {f"{c}_norm": T.normalize_text(F.col(c)) for c in ("nome", "cargo", "orgao")}


def digest(key: dict[str, Column], within: tuple[str, ...] = ()) -> Column:
    """128 bits of a key: two seeded 64-bit hashes over its values, cheaper than a text digest of them all."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in within] + [F.coalesce(v, F.lit("\u0000")) for v in key.values()]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit("second"), *reversed(parts)).alias("b"))


def first_wins(df: DataFrame, key: dict[str, Column], order: str = "linha_csv", within: tuple[str, ...] = ()) -> DataFrame:
    """Rows that come first in ``order`` (unique) within their key.

    The first row of each key is found by aggregation (partial minimum before the shuffle) and joined
    back by row, so that a key held by a third of the rows costs no sort of its group.
    """
    firsts = df.select(digest(key, within).alias("_k"), F.col(order).alias("_first")).groupBy("_k").agg(F.min("_first").alias("_first"))
    return df.join(firsts.select("_first"), F.col(order) == F.col("_first"), "left_semi")


def first_ids(df: DataFrame, key: dict[str, Column], order: str = "linha_csv") -> DataFrame:
    """The ``order`` of the rows that come first: one aggregation, no second look at the rows."""
    return df.groupBy(digest(key).alias("_k")).agg(F.min(order).alias(order)).select(order)


def dedup_report(df: DataFrame, key: dict[str, Column], file_col: str) -> DataFrame:
    """Rows before and after deduplication inside each file, and the difference."""
    distinct = df.select(F.col(file_col).alias("arquivo"), digest(key).alias("k")).groupBy("arquivo", "k").agg(F.count("*").alias("n"))
    return distinct.groupBy("arquivo").agg(
        F.sum("n").alias("linhas_antes"), F.count("*").alias("linhas_depois"), (F.sum("n") - F.count("*")).alias("duplicatas_removidas"))


def missing_columns(df: DataFrame, needed: tuple[str, ...]) -> str:
    """Status text of the column guard; empty if nothing is missing."""
    gone = [c for c in needed if c not in df.columns]
    return f"colunas ausentes: {', '.join(gone)}" if gone else ""


def complete_columns(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Exactly ``columns`` in that order: missing ones as empty text, others dropped, nulls empty."""
    return df.select(*[(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) if c in df.columns else F.lit("")).alias(c) for c in columns])


def new_rows(existing: DataFrame, incoming: DataFrame, key: dict[str, Column]) -> DataFrame:
    """Rows of ``incoming`` whose key ``existing`` doesn't hold (left anti join on a digest)."""
    return incoming.withColumn("_k", digest(key)).join(existing.select(digest(key).alias("_k")), "_k", "left_anti").drop("_k")


def upsert(existing: DataFrame, incoming: DataFrame, key: dict[str, Column], order: str = "linha_csv") -> DataFrame:
    """``existing`` and the first of each new key of ``incoming``."""
    return existing.unionByName(first_wins(new_rows(existing, incoming, key), key, order), allowMissingColumns=True)
