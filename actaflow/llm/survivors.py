"""Problem 2: the best field values of each group of duplicate records.

The fields are unpivoted to long rows. Each normalised value collects votes (trust of the row times a
decay with age); max_by picks the winner of every field, and the winners are pivoted back. For fields
with declared preferences (trusted and non-empty, then length, then date) these come first and votes
settle what they leave open; for other fields votes alone decide between normalised values. The
smallest row id settles the rest.

All rows meet in one hash aggregation over numbers (the declared rank is packed into one bigint);
values, of which there are fewer, go through aggregations with partial results before the shuffle, so
no group is ever held by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIELDS = ("nome", "id_funcional", "orgao")
#: Trust of a row by its flag; other flags and nulls count as ``nao``.
TRUST = {"sim": 1.0, "indisponivel": 0.5, "nao": 0.25}
HALF_LIFE_DAYS = 180.0
#: Days before this one count less than 1, later ones more; only ratios of votes matter.
REFERENCE_DAY = "2020-01-01"


def field_votes(groups: DataFrame, acts: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """One row per group, field and normalised value: its votes and its best verbatim spelling.

    A null value counts as ``""``; a null or unreadable date as the oldest. Group members without an
    act and acts without a group are left out. Repeated membership rows count once.
    """
    members = groups.select("grupo_id", "linha_csv").where("grupo_id is not null and linha_csv is not null").distinct()
    rows = acts.select("linha_csv", "nome_parse_confiavel", "data_publicacao", *fields)
    pairs = ", ".join(f"'{f}', coalesce(`{f}`, '')" for f in fields)
    long = members.join(rows, "linha_csv").selectExpr(
        "grupo_id", "linha_csv", "lower(trim(coalesce(nome_parse_confiavel, 'nao'))) AS trust",
        f"coalesce(datediff(try_to_date(data_publicacao, 'yyyy-MM-dd'), date'{REFERENCE_DAY}'), -1000000) AS day", f"stack({len(fields)}, {pairs}) AS (campo, valor)")
    weight = F.lit(TRUST["nao"])
    for name, w in TRUST.items():
        weight = F.when(F.col("trust") == name, F.lit(w)).otherwise(weight)
    long = long.withColumn("w", weight * F.pow(F.lit(2.0), F.least(F.greatest(F.col("day"), F.lit(-100_000)) / HALF_LIFE_DAYS, F.lit(900.0))))
    long = long.withColumn("norm", F.upper(F.regexp_replace(F.trim("valor"), r"\s+", " ")))
    sure = ((F.col("valor") != "") & (F.col("trust") == "sim")).cast("bigint")
    rank = F.shiftleft(sure, 60) + F.shiftleft(F.length("valor").cast("bigint"), 24) + (F.col("day") + 1_000_000)
    value = long.groupBy("grupo_id", "campo", "norm", "valor").agg(F.max(rank).alias("rank"), F.sum("w").alias("w"), F.min("linha_csv").alias("linha_csv"))
    best = F.max_by(F.struct("valor", "rank", "linha_csv"), F.struct("rank", -F.col("linha_csv")))
    return value.groupBy("grupo_id", "campo", "norm").agg(best.alias("melhor"), F.sum("w").alias("votos"), F.count("*").alias("grafias"))


def winners(votes: DataFrame, declared: bool = True) -> DataFrame:
    """Winning value of each group and field, and in how many values the members differ.

    ``declared``: trust, length and date come before votes; otherwise votes come first.
    """
    cast = F.round(F.log2("votos"), 6)  # sums of the same votes in another order come out equal
    order = F.struct("melhor.rank", cast, -F.col("melhor.linha_csv")) if declared else F.struct(cast, "melhor.rank", -F.col("melhor.linha_csv"))
    won = votes.groupBy("grupo_id", "campo").agg(F.max_by("melhor", order).alias("m"), F.sum("grafias").alias("valores"))
    return won.select("grupo_id", "campo", "m.valor", "m.linha_csv", "valores")


def surviving_records(groups: DataFrame, acts: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """One row per group with the surviving value of every field (pivoted back)."""
    won = winners(field_votes(groups, acts, fields))
    return won.groupBy("grupo_id").agg(*[F.max(F.when(F.col("campo") == f, F.col("valor"))).alias(f) for f in fields])


def contested_fields(groups: DataFrame, acts: DataFrame) -> DataFrame:
    """``grupo_id, campo, linha_csv`` for fields whose members don't all agree."""
    return winners(field_votes(groups, acts)).where("valores > 1").select("grupo_id", "campo", "linha_csv")


def voted_fields(groups: DataFrame, acts: DataFrame, fields: tuple[str, ...] = ("cargo", "assinante", "cargo_assinante")) -> DataFrame:
    """``grupo_id, campo, valor, linha_csv`` of fields without declared preferences: votes choose."""
    return winners(field_votes(groups, acts, fields), declared=False).select("grupo_id", "campo", "valor", "linha_csv")
