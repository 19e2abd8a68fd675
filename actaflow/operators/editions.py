"""Editions: work queue, labels, calendars, pending probe, collection failures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def backoff_minutes(attempts):
    """``min(360, 5 * 2^min(t-1, 6))``; its real maximum is 320."""
    return F.least(F.lit(360.0), 5 * F.pow(F.lit(2.0), F.least(attempts - 1, F.lit(6)))).cast("int")


def queue_pop(queue: DataFrame, now: str, k: int = 1) -> DataFrame:
    """The next ``k`` editions to process: newest first, then fewest attempts, then name."""
    ready = queue.where(F.col("estado").isin("pendente", "erro")).where(F.col("disponivel_em").isNull() | (F.col("disponivel_em") <= F.lit(now).cast("timestamp_ntz")))
    return ready.orderBy(F.desc("data_publicacao"), "tentativas", "arquivo").limit(k)


def after_failure(queue: DataFrame, failed: DataFrame, now: str) -> DataFrame:
    """The queue after the editions in ``failed`` (``arquivo, erro``) failed: one more attempt, later start."""
    f = failed.select("arquivo", F.col("erro").alias("_erro"))
    hit = F.col("_erro").isNotNull()
    tries = F.when(hit, F.col("tentativas") + 1).otherwise(F.col("tentativas"))
    later = F.lit(now).cast("timestamp_ntz") + F.make_dt_interval(mins=backoff_minutes(F.col("tentativas") + 1))
    return queue.join(f, "arquivo", "left").select(
        *[{"estado": F.when(hit, "erro").otherwise(F.col("estado")), "tentativas": tries, "disponivel_em": F.when(hit, later).otherwise(F.col("disponivel_em")),
           "atualizado_em": F.when(hit, F.lit(now).cast("timestamp_ntz")).otherwise(F.col("atualizado_em")), "erro": F.coalesce("_erro", "erro")}.get(c, F.col(c)).alias(c) for c in queue.columns])


def numbered_labels(df: DataFrame, label: str, keys: tuple[str, ...], order: str) -> DataFrame:
    """The first edition of a label keeps it, later ones get their number."""
    by = Window.partitionBy(*keys, label)
    n = F.row_number().over(by.orderBy(order))
    special = F.col(label).rlike(r"(?i)\b(?:complementar|suplemento|extra)\b")
    numbered = F.when(n == 1, F.col(label)).when(special, F.concat_ws(" ", label, n.cast("string"))).otherwise(F.concat(F.col(label), F.lit(" - Edicao "), n.cast("string")))
    return df.withColumn("rotulo", numbered)


def pending(queue: DataFrame, acts: DataFrame) -> DataFrame:
    """Editions by state of the queue, and how many have no acts yet."""
    done = acts.where("arquivo_markdown <> ''").select(F.col("arquivo_markdown").alias("arquivo")).distinct().withColumn("_ok", F.lit(1))
    return queue.join(done, "arquivo", "left").groupBy("uf", "estado").agg(F.count("*").alias("edicoes"), F.count_if(F.col("_ok").isNull()).alias("sem_atos"))


def calendar(df: DataFrame, date: str, weekdays_only: bool = True) -> DataFrame:
    """Every day between the first and last date of ``df``."""
    days = df.agg(F.min(date).alias("a"), F.max(date).alias("b")).where("a is not null").select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("dia"))
    return days.where(F.weekday("dia") < 5) if weekdays_only else days


def missing_days(df: DataFrame, date: str) -> DataFrame:
    """Weekdays of the range without an edition (left anti join with the calendar)."""
    return calendar(df, date).join(df.select(F.col(date).alias("dia")).distinct(), "dia", "left_anti")


def register(queue: DataFrame, new: DataFrame, now: str) -> DataFrame:
    """The queue after editions ``new`` (``arquivo, uf, codigo, data_publicacao, caderno, url``) were registered: known ones get the new data and keep their state."""
    fields = ("uf", "codigo", "data_publicacao", "caderno", "url")
    n = new.select("arquivo", *[F.col(c).alias(f"_{c}") for c in fields], F.lit(True).alias("_new"))
    at = F.lit(now).cast("timestamp_ntz")
    fresh = F.col("_new").isNotNull()
    both = queue.join(n, "arquivo", "full")
    values = {c: F.when(fresh, F.col(f"_{c}")).otherwise(F.col(c)) for c in fields} | {
        "estado": F.coalesce("estado", F.lit("pendente")), "tentativas": F.coalesce("tentativas", F.lit(0)), "atualizado_em": F.when(fresh, at).otherwise(F.col("atualizado_em"))}
    return both.select(*[values.get(c, F.col(c)).alias(c) for c in queue.columns])


def _moved(queue: DataFrame, which: DataFrame, state: str, now: str, **more) -> DataFrame:
    hit = F.col("_hit").isNotNull()
    values = {"estado": F.lit(state), "atualizado_em": F.lit(now).cast("timestamp_ntz"), **more}
    both = queue.join(which.select("arquivo").distinct().withColumn("_hit", F.lit(True)), "arquivo", "left")
    return both.select(*[(F.when(hit, values[c]).otherwise(F.col(c)) if c in values else F.col(c)).alias(c) for c in queue.columns])


def claim(queue: DataFrame, now: str, k: int = 1) -> DataFrame:
    """The queue after its next ``k`` editions were taken up."""
    return _moved(queue, queue_pop(queue, now, k), "processando", now)


def finish(queue: DataFrame, done: DataFrame, now: str) -> DataFrame:
    return _moved(queue, done, "concluido", now, erro=F.lit(""))


def recover(queue: DataFrame, now: str) -> DataFrame:
    """Editions that were being processed wait again."""
    return _moved(queue, queue.where("estado = 'processando'"), "pendente", now)


def paused_until(failures: DataFrame, source: str, minutes: int = 30) -> DataFrame:
    """Until when each source rests after its latest failure."""
    return failures.groupBy(source).agg((F.max("registrado_em") + F.make_dt_interval(mins=F.lit(minutes))).alias("pausa_ate"))


def turns(queue: DataFrame) -> DataFrame:
    """``arquivo, uf, rodada``: the k-th newest edition of every state comes in round k.

    Editions are counted by state and day first, so the running sum is over days, and only editions of one
    day are ordered together: a state with most editions is no single task's work.
    """
    days = queue.groupBy("uf", "data_publicacao").agg(F.count("*").alias("n"))
    newer = F.sum("n").over(Window.partitionBy("uf").orderBy(F.desc("data_publicacao")).rowsBetween(Window.unboundedPreceding, -1))
    days = days.select("uf", F.col("data_publicacao").alias("_d"), F.coalesce(newer, F.lit(0)).alias("antes"))
    own = F.row_number().over(Window.partitionBy("uf", "data_publicacao").orderBy("arquivo"))
    rows = queue.select("arquivo", "uf", "data_publicacao", own.alias("k"))
    return rows.join(days.withColumnRenamed("uf", "_u"), F.col("uf").eqNullSafe(F.col("_u")) & F.col("data_publicacao").eqNullSafe(F.col("_d"))).select("arquivo", "uf", (F.col("antes") + F.col("k")).cast("int").alias("rodada"))


def merged_by_date(queue: DataFrame) -> DataFrame:
    """All states in one order, newest first: place of each edition (days counted first, as in ``turns``)."""
    days = queue.groupBy("data_publicacao").agg(F.count("*").alias("n"))
    newer = F.sum("n").over(Window.orderBy(F.desc("data_publicacao")).rowsBetween(Window.unboundedPreceding, -1))  # days are few
    days = days.select(F.col("data_publicacao").alias("_d"), F.coalesce(newer, F.lit(0)).alias("antes"))
    own = F.row_number().over(Window.partitionBy("data_publicacao").orderBy("uf", "arquivo"))
    rows = queue.select("arquivo", "data_publicacao", own.alias("k"))
    return rows.join(days, F.col("data_publicacao").eqNullSafe(F.col("_d"))).select("arquivo", (F.col("antes") + F.col("k")).cast("int").alias("posicao"))


def wanted_dates(days: DataFrame, start: str, today: str, weekdays_only: bool = False) -> DataFrame:
    """Days of a portal's calendar (``dia``) from a source's start to today, newest first at the sink."""
    out = days.where(F.col("dia").between(F.lit(start).cast("date"), F.lit(today).cast("date"))).distinct()
    return out.where(F.weekday("dia") < 5) if weekdays_only else out


def carried_forward(rows: DataFrame, group: str, order: str, value: str, width: int = 4096) -> DataFrame:
    """``order, contexto``: the latest non-empty ``value`` at or before each row within its group.

    Rows are cut into stretches of ``width`` places of ``order`` (a bigint); the last value of each stretch
    is carried over the stretches, so no task orders a whole group, only a stretch or a list of stretches.
    """
    rows = rows.select(F.col(group).alias("g"), F.col(order).alias("o"), F.nullif(F.col(value), F.lit("")).alias("v")).withColumn("s", F.floor(F.col("o") / width))
    last = rows.groupBy("g", "s").agg(F.max_by("v", F.when(F.col("v").isNotNull(), F.col("o"))).alias("v"))
    before = F.last("v", ignorenulls=True).over(Window.partitionBy("g").orderBy("s").rowsBetween(Window.unboundedPreceding, -1))
    last = last.select(F.col("g").alias("_g"), F.col("s").alias("_s"), before.alias("c"))
    inside = F.last("v", ignorenulls=True).over(Window.partitionBy("g", "s").orderBy("o").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.select("g", "s", "o", inside.alias("i")).join(last, F.col("g").eqNullSafe(F.col("_g")) & (F.col("s") == F.col("_s")))
    return rows.select(F.col("o").alias(order), F.coalesce("i", "c").alias("contexto"))
