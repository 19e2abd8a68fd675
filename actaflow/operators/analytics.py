"""Aggregations, series, rankings and first-order transitions over consolidated movements.

Group keys are named in the result; nothing is collected except where a result is bounded by a
parameter (top-k) or by a list of states (the stationary vector).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from actaflow.functions import text as T
from actaflow.runtime import cut

TOP_AGENCIES = 10
TOP_TRANSITIONS = 30


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.where(" and ".join(f"{k} is not null" for k in keys)).groupBy(*keys).agg(F.count("*").alias("quantidade"))


def signed_flow(df: DataFrame, key: str) -> DataFrame:
    """Appointments positive, dismissals negative."""
    n = F.count("*")
    return df.groupBy(key, "tipo_ato").agg(F.when(F.col("tipo_ato") == "exoneracao", -n).otherwise(n).alias("fluxo"))


def balance(df: DataFrame, key: str) -> DataFrame:
    """Dismissals, appointments, their difference and sum; both kinds in one pass without a pivot job."""
    out, into = F.count_if(F.col("tipo_ato") == "exoneracao"), F.count_if(F.col("tipo_ato") == "nomeacao")
    return df.groupBy(key).agg(out.alias("exoneracao"), into.alias("nomeacao"), (into - out).alias("saldo"), (into + out).alias("atos"))


def agency_labels(df: DataFrame) -> DataFrame:
    """Most frequent spelling of each agency key; ties go to the first in alphabet."""
    n = df.select(T.agency_key(F.col("orgao")).alias("chave"), T.agency_label(F.col("orgao")).alias("rotulo")).where("chave <> ''").groupBy("chave", "rotulo").agg(F.count("*").alias("n"))
    return n.groupBy("chave").agg(F.min_by("rotulo", F.struct(-F.col("n"), F.col("rotulo"))).alias("rotulo"), F.sum("n").alias("atos"))


def top_agencies(df: DataFrame, k: int = TOP_AGENCIES) -> DataFrame:
    """Signed flow of the ``k`` agencies with most acts (ties by key)."""
    top = agency_labels(df).orderBy(F.desc("atos"), "chave").limit(k)
    rows = df.select(T.agency_key(F.col("orgao")).alias("chave"), "tipo_ato")
    return signed_flow(rows.join(F.broadcast(top), "chave"), "chave").join(F.broadcast(top), "chave").select("chave", "rotulo", "tipo_ato", "fluxo")


def month_series(df: DataFrame, date: str = "data_movimentacao") -> DataFrame:
    """Acts by month, representative and kind, with the distinct origins in alphabetical order."""
    return df.where(F.col(date).isNotNull()).groupBy(F.trunc(date, "MM").alias("mes"), "representante_governo", "tipo_ato").agg(
        F.count("*").alias("quantidade"), F.array_join(F.array_sort(F.collect_set("origem_representante")), " / ").alias("origens"))


def gap_filled(df: DataFrame, date: str = "data_movimentacao") -> DataFrame:
    """Every month between the first and last of each representative and kind; missing ones have null counts."""
    n = df.where(F.col(date).isNotNull()).groupBy(F.trunc(date, "MM").alias("mes"), "representante_governo", "tipo_ato").agg(F.count("*").alias("quantidade"))
    span = n.groupBy("representante_governo", "tipo_ato").agg(F.explode(F.sequence(F.min("mes"), F.max("mes"), F.expr("interval 1 month"))).alias("mes"))
    return span.join(n, ["mes", "representante_governo", "tipo_ato"], "left").select("mes", "representante_governo", "tipo_ato", "quantidade")


def adaptive_period(df: DataFrame, few: int = 3, date: str = "data_movimentacao") -> DataFrame:
    """By month for at most ``few`` representatives, else by year.

    A month stands at its end, the newest at the day after its last act. The choice is a scalar
    subquery of the same plan.
    """
    rows = df.where(F.col(date).isNotNull()).select("representante_governo", "tipo_ato", F.col(date).alias("d"))
    facts = rows.agg((F.count_distinct("representante_governo") <= few).alias("mensal"), F.max("d").alias("fim"))
    rows = rows.join(F.broadcast(facts))  # one row of facts
    month = F.when(F.trunc("d", "MM") == F.trunc("fim", "MM"), F.date_add("fim", 1)).otherwise(F.last_day("d"))
    return rows.select("representante_governo", "tipo_ato", F.when(F.col("mensal"), month).otherwise(F.make_date(F.year("d"), F.lit(1), F.lit(1))).alias("periodo")).groupBy(
        "periodo", "representante_governo", "tipo_ato").agg(F.count("*").alias("quantidade"))


def cards(df: DataFrame) -> DataFrame:
    """Totals of the dashboard in one aggregation."""
    kind = lambda k: F.count_if(F.col("tipo_ato") == k)
    by = lambda k, a: F.count_if((F.col("tipo_ato") == k) & (F.col("autoria_ato") == a))
    return df.agg(
        F.count("*").alias("atos"), F.count_distinct("pessoa").alias("pessoas"), kind("nomeacao").alias("nomeacoes"), kind("exoneracao").alias("exoneracoes"),
        by("nomeacao", "Governador").alias("nomeacoes_governador"), by("exoneracao", "Governador").alias("exoneracoes_governador"),
        (kind("nomeacao") - kind("exoneracao")).alias("saldo"))


FILTERS = ("estado", "ano", "representante_origem", "orgao", "autoria_ato", "tipo_ato")


def filtered(df: DataFrame, **chosen: list) -> DataFrame:
    """Conjunction of the given filters; an empty choice leaves its column open."""
    for column, values in chosen.items():
        if column not in FILTERS:
            raise ValueError(f"unknown filter {column}")
        if values:
            df = df.where(F.col(column).isin(*values))
    return df


def filter_options(df: DataFrame, estado: str | None = None) -> DataFrame:
    """Distinct values of each filter column for one state."""
    rows = df if estado is None else df.where(F.col("estado") == estado)
    pairs = ", ".join(f"'{c}', cast({c} as string)" for c in FILTERS)
    return rows.selectExpr(f"stack({len(FILTERS)}, {pairs}) AS (filtro, valor)").where("valor is not null and valor <> ''").distinct()


def mobility_rates(ret: DataFrame) -> DataFrame:
    rate = lambda c: F.round(F.avg(F.col(c).cast("int")), 6)
    return ret.groupBy("ano").agg(rate("mudou_cargo").alias("taxa_cargo"), rate("mudou_orgao").alias("taxa_orgao"), F.count("*").alias("retornos"))


def return_stats(ret: DataFrame) -> DataFrame:
    days = F.col("dias_desde_exoneracao")
    return ret.agg(
        F.count("*").alias("retornos"), F.count_distinct("pessoa").alias("pessoas"), F.round(F.avg(days), 6).alias("media"), F.median(days).alias("mediana"),
        F.round(F.avg(F.col("mudou_cargo").cast("int")), 6).alias("taxa_cargo"), F.round(F.avg(F.col("mudou_orgao").cast("int")), 6).alias("taxa_orgao"))


def events(ret: DataFrame) -> DataFrame:
    """Dismissal and appointment of every return. A dismissal counts once for each return to it."""
    pairs = F.array(F.struct(F.col("data_exoneracao").alias("data"), F.lit("E").alias("estado"), F.lit(0).alias("k")),
                    F.struct(F.col("data_nomeacao").alias("data"), F.col("estado_n").alias("estado"), F.lit(1).alias("k")))
    return ret.select("pessoa", "linha_csv", "ano", F.inline(pairs)).where("data is not null")


def next_states(ret: DataFrame) -> DataFrame:
    by = Window.partitionBy("pessoa").orderBy("data", "linha_csv", "k")
    return events(ret).withColumn("prox_estado", F.lead("estado").over(by)).where("prox_estado is not null")


def transitions(ret: DataFrame, *keys: str) -> DataFrame:
    return next_states(ret).groupBy(*keys, "estado", "prox_estado").agg(F.count("*").alias("n"))


def transition_probabilities(ret: DataFrame) -> DataFrame:
    t = transitions(ret)
    total = t.groupBy("estado").agg(F.sum("n").alias("total"))
    return t.join(total, "estado").select("estado", "prox_estado", "n", F.round(F.col("n") / F.col("total"), 8).alias("p"))


def top_transitions(ret: DataFrame, k: int = TOP_TRANSITIONS) -> DataFrame:
    return transitions(ret).orderBy(F.desc("n"), "estado", "prox_estado").limit(k)


def top_transitions_by_year(ret: DataFrame, k: int = TOP_TRANSITIONS) -> DataFrame:
    """The ``k`` most frequent of each year; ranks are taken over counts, not events."""
    rank = F.row_number().over(Window.partitionBy("ano").orderBy(F.desc("n"), "estado", "prox_estado"))
    return transitions(ret, "ano").withColumn("posicao", rank).where(F.col("posicao") <= k)


def degrees(ret: DataFrame, k: int = TOP_TRANSITIONS) -> DataFrame:
    """Degree of each node in the graph of the top transitions."""
    ends = top_transitions(ret, k).select(F.explode(F.array("estado", "prox_estado")).alias("estado"))
    return ends.groupBy("estado").agg(F.count("*").alias("grau"))


#: States up to which the stationary vector is solved as one small matrix; more are iterated as joins.
FEW_STATES = 200


def stationary_vector(ret: DataFrame, most: int = FEW_STATES) -> DataFrame:
    """Stationary distribution of the chain; a state without successors is absorbing.

    Up to ``most`` states (a few dozen labels in practice) their matrix is solved at once; more take
    the way of ``stationary_by_joins``.
    """
    t = cut(transitions(ret), "transitions")
    names = t.select("estado").union(t.select("prox_estado")).distinct()
    if names.count() > most:
        return stationary_by_joins(t)
    rows = t.collect()  # at most ``most`` squared
    states = sorted({r.estado for r in rows} | {r.prox_estado for r in rows})
    spark = ret.sparkSession
    if not states:
        return spark.createDataFrame([], "estado string, p double")
    at = {s: i for i, s in enumerate(states)}
    m = np.zeros((len(states), len(states)))
    for r in rows:
        m[at[r.estado], at[r.prox_estado]] = r.n
    sums = m.sum(axis=1)
    m[sums == 0, sums == 0] = 1
    m = m / m.sum(axis=1, keepdims=True)
    n = len(states)
    a = np.vstack([m.T - np.eye(n), np.ones(n)])
    v = np.linalg.lstsq(a, np.append(np.zeros(n), 1.0), rcond=None)[0]
    v = np.clip(v, 0, None) / np.clip(v, 0, None).sum()
    return spark.createDataFrame([(s, float(x)) for s, x in zip(states, v, strict=True)], "estado string, p double")


def stationary_by_joins(t: DataFrame, tolerance: float = 1e-10, most_rounds: int = 500) -> DataFrame:
    """The same by power iteration over (``estado, prox_estado, n``), any number of states; half of each step stays, so cycles settle."""
    total = t.groupBy("estado").agg(F.sum("n").alias("total"))
    names = t.select("estado").union(t.select("prox_estado")).distinct()
    edges = t.join(total, "estado").select("estado", "prox_estado", (F.col("n") / F.col("total")).alias("q"))
    stuck = names.join(total, "estado", "left_anti").select("estado", F.col("estado").alias("prox_estado"), F.lit(1.0).alias("q"))
    edges = cut(edges.unionByName(stuck), "chain")
    n = names.count()
    v = cut(names.withColumn("p", F.lit(1.0 / max(n, 1))), "vector")
    for _ in range(most_rounds):
        step = v.join(edges, "estado").groupBy(F.col("prox_estado").alias("estado")).agg(F.sum(F.col("p") * F.col("q")).alias("in"))
        new = cut(v.join(step, "estado", "left").select("estado", (F.col("p") / 2 + F.coalesce("in", F.lit(0.0)) / 2).alias("p"), F.abs(F.coalesce("in", F.lit(0.0)) - F.col("p")).alias("d")), "vector")
        change = new.agg(F.max("d")).first()[0] or 0.0
        v = new.select("estado", "p")
        if change <= tolerance:
            break
    return v


def axis_mode(df: DataFrame) -> DataFrame:
    """``Setor`` if that is the only origin, else ``Governo``."""
    return df.agg(F.when(F.collect_set("origem_representante") == F.array(F.lit("Setor")), "Setor").otherwise("Governo").alias("eixo"))


def flow_order(df: DataFrame, key: str = "representante_origem") -> DataFrame:
    """Signed flow by ``key`` and kind, the sum of absolute flows of the key, and its place in that order (ties by key).

    In sector mode only the ten largest stay.
    """
    flow = signed_flow(df.where(F.col(key).isNotNull() & F.col("tipo_ato").isNotNull()), key)
    size = flow.groupBy(key).agg(F.sum(F.abs("fluxo")).alias("soma_abs"))
    size = size.withColumn("posicao", F.row_number().over(Window.orderBy(F.desc("soma_abs"), key)))  # one row a key
    rows = flow.join(size, key).join(F.broadcast(axis_mode(df)))  # one row
    return rows.where((F.col("eixo") != "Setor") | (F.col("posicao") <= TOP_AGENCIES)).drop("eixo")


def extreme_balances(df: DataFrame, key: str = "representante_governo") -> DataFrame:
    """The keys with the largest and the smallest balance (ties by key)."""
    b = balance(df, key).where(F.col(key).isNotNull())
    return b.agg(F.min_by(key, F.struct(-F.col("saldo"), F.col(key))).alias("maior"), F.min_by(key, F.struct("saldo", key)).alias("menor"))


def option_union(first: DataFrame, second: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column that two tables share."""
    both = first.select(F.col(column).cast("string").alias("valor")).union(second.select(F.col(column).cast("string").alias("valor")))
    return both.where("valor is not null and valor <> ''").distinct()


def still_valid(chosen: dict[str, list[str]], options: DataFrame) -> DataFrame:
    """``filtro, valores``: chosen values that are still among the options (``filtro, valor``), in the order chosen."""
    spark = options.sparkSession
    rows = [(k, i, v) for k, vs in chosen.items() for i, v in enumerate(dict.fromkeys(vs))]
    picked = spark.createDataFrame(rows, "filtro string, i int, valor string")
    kept = picked.join(options, ["filtro", "valor"], "left_semi")
    return kept.groupBy("filtro").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "valor"))), lambda x: x["valor"]).alias("valores"))


def latest_of_month(df: DataFrame, date: str = "data_movimentacao") -> DataFrame:
    """The last day with an act of each month."""
    return df.where(F.col(date).isNotNull()).groupBy(F.trunc(date, "MM").alias("mes")).agg(F.max(date).alias("ultimo"))


def period_label(df: DataFrame, year: str = "ano") -> DataFrame:
    """``2020``, ``2018-2021`` if contiguous, else a list; ``sem período`` without years."""
    years = F.array_sort(F.collect_set(F.col(year).cast("int")))
    one = df.agg(years.alias("y"))
    return one.select(F.when(F.size("y") == 0, "sem período").when(F.size("y") == 1, F.col("y")[0].cast("string"))
                      .when(F.array_max("y") - F.array_min("y") + 1 == F.size("y"), F.concat_ws("-", F.array_min("y").cast("string"), F.array_max("y").cast("string")))
                      .otherwise(F.array_join(F.transform("y", lambda x: x.cast("string")), ", ")).alias("periodo"))
