"""Per-person ordered state: previous act, last dismissal, returns, summaries, milestones.

All windows share one partitioning and order, so a timeline is one exchange, one sort, one window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from actaflow import schemas as S
from actaflow.functions import text as T


def person_acts(acts: DataFrame) -> DataFrame:
    """Acts with a usable name and date, and their normalised fields."""
    rows = acts.select(
        "linha_csv", "estado", "tipo_ato", "nome", "cargo", "orgao", "cargo_assinante", "governador_edicao",
        F.expr("try_to_date(data_publicacao, 'yyyy-MM-dd')").alias("data"),
        T.normalize_text(F.col("nome")).alias("nome_normalizado"), T.normalize_text(F.col("cargo")).alias("cargo_norm"), T.normalize_text(F.col("orgao")).alias("orgao_norm"),
    )
    return rows.where(F.col("data").isNotNull() & (F.col("nome_normalizado") != "") & (T.rejection_reasons(F.col("nome")) == ""))


def timeline(acts: DataFrame, person: str = "nome_normalizado", line: str = "linha_csv") -> DataFrame:
    """One row per act with its place in the person's history.

    ``acts`` has ``person, data, tipo_ato, cargo_norm, orgao_norm`` and a unique ``line``. A dismissal
    isn't used up by a return: two appointments after it are two returns to it.
    """
    order = F.lit(S.OTHER_ACTION)
    for kind, rank in S.ACTION_ORDER.items():
        order = F.when(F.col("tipo_ato") == kind, rank).otherwise(order)
    rows = acts.withColumn("_o", order)
    by = Window.partitionBy(person).orderBy("data", "_o", line)
    past = by.rowsBetween(Window.unboundedPreceding, -1)
    act = F.struct("data", "tipo_ato", "cargo_norm", "orgao_norm")
    rows = rows.select(
        "*", F.row_number().over(by).alias("ordem_pessoa"), F.lag(act).over(by).alias("_p"),
        F.last(F.when(F.col("tipo_ato") == "exoneracao", act), ignorenulls=True).over(past).alias("_e"),
    )
    back = (F.col("tipo_ato") == "nomeacao") & F.col("_e").isNotNull()
    changed = lambda c: F.when(back & (F.col(c) != "") & (F.col(f"_e.{c}") != ""), F.col(c) != F.col(f"_e.{c}")).when(back, F.lit(False))
    return rows.select(
        *[c for c in acts.columns], "ordem_pessoa", F.col("_p.tipo_ato").alias("ato_anterior"), F.col("_p.data").alias("data_anterior"),
        F.col("_p.cargo_norm").alias("cargo_anterior"), F.col("_p.orgao_norm").alias("orgao_anterior"),
        F.datediff("data", "_p.data").alias("dias_desde_anterior"), back.alias("retorno"),
        F.when(back, F.col("_e.data")).alias("data_exoneracao"), F.when(back, F.datediff("data", "_e.data")).alias("dias_desde_exoneracao"),
        changed("cargo_norm").alias("mudou_cargo"), changed("orgao_norm").alias("mudou_orgao"),
    )


def returns_by_year(rows: DataFrame) -> DataFrame:
    days = F.col("dias_desde_exoneracao")
    return rows.where("retorno").groupBy(F.year("data").alias("ano")).agg(
        F.count("*").alias("retornos"), F.round(F.avg(days), 6).alias("media_dias"), F.median(days).alias("mediana_dias"),
        F.count_if("mudou_cargo").alias("mudou_cargo"), F.count_if("mudou_orgao").alias("mudou_orgao"))


def person_summary(rows: DataFrame, person: str = "nome_normalizado") -> DataFrame:
    """One row per person. Groups are bounded by a person's acts; counts are partial before the shuffle."""
    out = rows.groupBy(person).agg(
        F.min_by("nome", "ordem_pessoa").alias("nome_exemplo"), F.count("*").alias("total_atos"),
        F.count_if(F.col("tipo_ato") == "nomeacao").alias("total_nomeacoes"), F.count_if(F.col("tipo_ato") == "exoneracao").alias("total_exoneracoes"),
        F.count_if("retorno").alias("total_retornos"), F.min("data").alias("primeira_data"), F.max("data").alias("ultima_data"),
        F.count_distinct(F.nullif(F.col("cargo"), F.lit(""))).alias("cargos_distintos"), F.count_distinct(F.nullif(F.col("orgao"), F.lit(""))).alias("orgaos_distintos"))
    return out.withColumn("teve_ambos", (F.col("total_nomeacoes") > 0) & (F.col("total_exoneracoes") > 0)).withColumn("teve_retorno", F.col("total_retornos") > 0)


def latest_milestone(rows: DataFrame, milestones: list[tuple[str, str]], date: str = "data") -> DataFrame:
    """As-of backward join with a parameter list ``(yyyy-mm-dd, label)``; of equal dates the first given wins.

    The list is an argument, so its size doesn't follow the data; it becomes one CASE expression.
    """
    ordered = sorted(enumerate(milestones), key=lambda x: (x[1][0], -x[0]), reverse=True)
    at, label = F.lit(None).cast("date"), F.lit(None).cast("string")
    for _, (day, name) in reversed(ordered):
        hit = F.col(date) >= F.lit(day).cast("date")
        at, label = F.when(hit, F.lit(day).cast("date")).otherwise(at), F.when(hit, F.lit(name)).otherwise(label)
    return rows.withColumn("marco", label).withColumn("data_marco", at).withColumn("dias_desde_marco", F.datediff(date, at))


def in_range(column, low: str | None = None, high: str | None = None, outside: bool = False):
    """Closed date interval with open ends, or its complement."""
    inside = F.lit(True)
    if low is not None:
        inside = inside & (column >= F.lit(low).cast("date"))
    if high is not None:
        inside = inside & (column <= F.lit(high).cast("date"))
    return ~inside if outside else inside


def rejected_names(acts: DataFrame) -> DataFrame:
    """Acts whose name can't be a person's, with the reasons."""
    return acts.select("linha_csv", "nome", T.rejection_reasons(F.col("nome")).alias("motivo_rejeicao")).where("motivo_rejeicao <> ''")


def affected_timeline(existing: DataFrame, incoming: DataFrame, person: str = "nome_normalizado", line: str = "linha_csv") -> DataFrame:
    """Timeline after new acts: only people with new acts are recomputed, with the result of a full run."""
    people = incoming.select(person).distinct()
    touched = existing.join(people, person, "left_semi").unionByName(incoming)
    base = list(incoming.columns)
    return timeline(existing.join(people, person, "left_anti").select(*base), person, line).unionByName(timeline(touched.select(*base), person, line))
