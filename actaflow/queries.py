"""Queries of the core engine and their SQL, by name. Every query reads its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actaflow import schemas as S
from actaflow.functions import text as T
from actaflow.operators import analytics as A
from actaflow.operators import consolidate as C
from actaflow.operators import dedup as D
from actaflow.operators import editions as E
from actaflow.operators import repair as R
from actaflow.operators import timeline as L
from actaflow.plans import cases as CASES
from actaflow.plans import extract as X
from actaflow.plans import pages as P
from actaflow.runtime import table
from actaflow.sources import lake as K

MILESTONES = [("2026-01-01", "Gestao A"), ("2026-04-05", "Gestao B"), ("2026-10-01", "Gestao C")]
NOW = "2026-06-15 12:00:00"
GOVERNORS = [("Gestao A", "2025-01-01", "2026-04-04"), ("Gestao B", "2026-04-05", "2026-09-30"), ("Gestao C", "2026-10-01", "2099-12-31")]

# ---------------------------------------------------------------- tables and adapters


def acts(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "doeg_2026")


def mov(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "movimentacoes")


def editions(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "edicoes")


def history(spark: SparkSession, base: str) -> DataFrame:
    """Timeline of orders seen as acts: one person a customer, F a dismissal, O an appointment."""
    o = table(spark, base, "orders")
    kind = F.when(F.col("o_orderstatus") == "F", "exoneracao").when(F.col("o_orderstatus") == "O", "nomeacao").otherwise("outro")
    rows = o.select(
        F.col("o_custkey").alias("pessoa"), F.col("o_orderkey").alias("linha"), F.to_date("o_orderdate").alias("data"), kind.alias("tipo_ato"),
        F.lit("").alias("cargo_norm"), F.col("o_orderpriority").alias("orgao_norm"))
    return L.timeline(rows, "pessoa", "linha")


def act_timeline(spark: SparkSession, base: str) -> DataFrame:
    return L.timeline(L.person_acts(acts(spark, base)))


def act_returns(spark: SparkSession, base: str) -> DataFrame:
    return C.returns(act_timeline(spark, base))


# ---------------------------------------------------------------- SQL building blocks


def _sql_norm(c: str) -> str:
    return rf"upper(trim(regexp_replace(strip_accents(coalesce({c}, '')), '[\t\n\f\r \x{{00a0}}]+', ' ', 'g')))"


_TERMS = ", ".join(f"'{t}'" for t in S.ADMINISTRATIVE_TERMS)
_STARTS = ", ".join(f"'{t}'" for t in S.SUSPICIOUS_STARTS)


def _sql_reasons(norm: str) -> str:
    toks = f"list_filter(string_split({norm}, ' '), lambda x: x <> '')"
    return (
        f"concat_ws(';', CASE WHEN len({toks}) < 2 THEN 'menos_de_2_tokens' END, CASE WHEN len({toks}) > 14 THEN 'mais_de_14_tokens' END, "
        f"CASE WHEN regexp_matches({norm}, '[0-9]') THEN 'tem_numero' END, CASE WHEN {toks}[1] IN ({_STARTS}) THEN 'inicio_suspeito' END, "
        f"CASE WHEN regexp_matches({norm}, '\\b(?:{'|'.join(S.ADMINISTRATIVE_PHRASES)})\\b') THEN 'frase_administrativa' END, "
        f"CASE WHEN list_has_any({toks}, [{_TERMS}]) THEN 'termo_administrativo' END, CASE WHEN length({norm}) > 80 THEN 'muito_longo' END)")


_NOME = _sql_norm("nome")
_PERSON = f"""persons AS (SELECT linha_csv, estado, tipo_ato, nome, cargo, orgao, cargo_assinante, governador_edicao, try_cast(data_publicacao AS DATE) AS data,
 {_NOME} AS nome_normalizado, {_sql_norm('cargo')} AS cargo_norm, {_sql_norm('orgao')} AS orgao_norm FROM doeg_2026),
acts AS (SELECT *, nome_normalizado AS pessoa, linha_csv AS linha FROM persons WHERE data IS NOT NULL AND nome_normalizado <> '' AND {_sql_reasons('nome_normalizado')} = '')"""
_ORDERS = """acts AS (SELECT o_custkey AS pessoa, o_orderkey AS linha, CAST(o_orderdate AS DATE) AS data,
 CASE o_orderstatus WHEN 'F' THEN 'exoneracao' WHEN 'O' THEN 'nomeacao' ELSE 'outro' END AS tipo_ato, '' AS cargo_norm, o_orderpriority AS orgao_norm FROM orders)"""
_TIMELINE = """ordered AS (SELECT *, CASE tipo_ato WHEN 'exoneracao' THEN 0 WHEN 'nomeacao' THEN 1 ELSE 99 END AS o FROM acts),
seen AS (SELECT *, row_number() OVER w AS ordem_pessoa, lag(tipo_ato) OVER w AS ato_anterior, lag(data) OVER w AS data_anterior, lag(cargo_norm) OVER w AS cargo_anterior, lag(orgao_norm) OVER w AS orgao_anterior,
 last_value(CASE WHEN tipo_ato = 'exoneracao' THEN {'d': data, 'c': cargo_norm, 'g': orgao_norm} END IGNORE NULLS) OVER (PARTITION BY pessoa ORDER BY data, o, linha ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS e
 FROM ordered WINDOW w AS (PARTITION BY pessoa ORDER BY data, o, linha)),
timeline AS (SELECT *, CAST(data - data_anterior AS INTEGER) AS dias_desde_anterior, (tipo_ato = 'nomeacao' AND e IS NOT NULL) AS retorno,
 CASE WHEN tipo_ato = 'nomeacao' THEN e.d END AS data_exoneracao, CASE WHEN tipo_ato = 'nomeacao' THEN CAST(data - e.d AS INTEGER) END AS dias_desde_exoneracao,
 CASE WHEN tipo_ato = 'nomeacao' AND e IS NOT NULL THEN cargo_norm <> '' AND e.c <> '' AND cargo_norm <> e.c END AS mudou_cargo,
 CASE WHEN tipo_ato = 'nomeacao' AND e IS NOT NULL THEN orgao_norm <> '' AND e.g <> '' AND orgao_norm <> e.g END AS mudou_orgao FROM seen)"""
_RET_STATE = """'N_' || CASE WHEN dias_desde_exoneracao IS NULL THEN 'desconhecido' WHEN dias_desde_exoneracao = 0 THEN 'imediato' WHEN dias_desde_exoneracao < 30 THEN 'curto' WHEN dias_desde_exoneracao <= 180 THEN 'medio' ELSE 'longo' END
 || '_' || CASE WHEN mudou_cargo THEN 'novo_cargo' ELSE 'mesmo_cargo' END || '_' || CASE WHEN mudou_orgao THEN 'novo_orgao' ELSE 'mesmo_orgao' END"""
_RET = f"ret AS (SELECT *, year(data) AS ano, {_RET_STATE} AS estado_n FROM timeline WHERE retorno)"
_EVENTS = """ev AS (SELECT pessoa, linha, ano, data_exoneracao AS data, 'E' AS estado, 0 AS k FROM ret UNION ALL SELECT pessoa, linha, ano, data, estado_n, 1 FROM ret),
nx AS (SELECT *, lead(estado) OVER (PARTITION BY pessoa ORDER BY data, linha, k) AS prox_estado FROM ev WHERE data IS NOT NULL),
tr AS (SELECT estado, prox_estado, count(*) AS n FROM nx WHERE prox_estado IS NOT NULL GROUP BY ALL)"""
_BASE = f"WITH {_PERSON}, {_TIMELINE}"
_CHAIN = f"{_BASE}, {_RET}, {_EVENTS}"


def _sql_agency(c: str) -> str:
    s = rf"regexp_replace(trim(coalesce({c}, '')), '(?i)^(?:da|do|das|dos)[\t\n\f\r ]+', '')"
    s = rf"regexp_replace(regexp_replace({s}, '[\x{{fffe}}\x{{fffd}}]', '', 'g'), '[\t\n\f\r ]*-[\t\n\f\r ]*', ' ', 'g')"
    return rf"regexp_replace(trim({s}, ' ,.;:'), '[\t\n\f\r ]+', ' ', 'g')"


def _sql_label(c: str) -> str:
    s = rf"regexp_replace(CASE WHEN lower(trim(coalesce({c}, ''))) IN ('nan', 'none', 'null') THEN '' ELSE trim(coalesce({c}, '')) END, '[\t\n\f\r ]+', ' ', 'g')"
    return f"trim(regexp_replace(regexp_replace({s}, ' ?- ?', ' - ', 'g'), ' ?/ ?', '/', 'g'))"


def _sql_key(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({_sql_label(c)}), ' ?- ?', ' ', 'g'), ' +', ' ', 'g'))"


_AUTHOR = "CASE WHEN regexp_matches(trim(coalesce(cargo_assinante, '')), '(?i)^(?:sub)?secret.rio(?:$|[^\\p{L}\\p{N}_])') THEN 'Secretaria/Subsecretaria' WHEN regexp_matches(trim(coalesce(cargo_assinante, '')), '(?i)^governador(?:$|[^\\p{L}\\p{N}_])') THEN 'Governador' ELSE 'Outro/Nao identificado' END"
_REP = "coalesce(nullif(trim(split_part(coalesce(nullif(trim(governador_edicao), ''), 'Nao identificado'), ' - ', 1)), ''), 'Nao identificado')"
_ORIGIN = f"CASE {_REP} WHEN 'Nao identificado' THEN 'Nao identificado' " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.ORIGINS.items()) + " ELSE CASE WHEN contains(governador_edicao, 'Governador em exerc') THEN 'Vice-governadoria' ELSE 'Executivo estadual' END END"
_MOVED = f"""linha_csv, nome_normalizado AS pessoa, estado, CAST(year(data) AS INTEGER) AS ano, tipo_ato, {_sql_agency('orgao')} AS orgao, cargo, coalesce(nullif(trim(cargo_assinante), ''), 'Sem identificacao') AS autoridade_assinante,
 {_AUTHOR} AS autoria_ato, coalesce(nullif(trim(governador_edicao), ''), 'Nao identificado') AS governador_edicao, {_REP} AS representante_governo, {_ORIGIN} AS origem_representante, {_REP} || ' (' || {_ORIGIN} || ')' AS representante_origem"""
_WRITE = "data_publicacao, caderno, tipo_ato, nome, substr(trecho, 1, 180)"
_LOAD = f"data_publicacao, tipo_ato, fonte_url, arquivo_markdown, {_NOME}, {_sql_norm('cargo')}, {_sql_norm('orgao')}"
_MAINT = ", ".join(_sql_norm(c) for c in ("data_publicacao", "caderno", "tipo_ato", "nome", "cargo", "orgao", "assinante")) + f", substr({_sql_norm('trecho')}, 1, 240)"
_OPTIONS = " UNION ".join(f"SELECT '{c}' AS filtro, CAST({c} AS VARCHAR) AS valor FROM movimentacoes WHERE estado = 'GO'" for c in A.FILTERS)

# ---------------------------------------------------------------- queries

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return keep


_YEARLY = """SELECT CAST(year(data) AS INTEGER) AS ano, count(*) AS retornos, round(avg(dias_desde_exoneracao), 6) AS media_dias, median(dias_desde_exoneracao) AS mediana_dias,
 CAST(count(*) FILTER (WHERE mudou_cargo) AS BIGINT) AS mudou_cargo, CAST(count(*) FILTER (WHERE mudou_orgao) AS BIGINT) AS mudou_orgao FROM timeline WHERE retorno GROUP BY 1"""


@_query("returns_by_year", f"WITH {_PERSON}, {_TIMELINE} {_YEARLY}")
def _(spark, base):
    return L.returns_by_year(act_timeline(spark, base))


@_query("returns_by_year_orders", f"WITH {_ORDERS}, {_TIMELINE} {_YEARLY}")
def _(spark, base):
    return L.returns_by_year(history(spark, base))


_COLS = "ordem_pessoa, ato_anterior, data_anterior, orgao_anterior, dias_desde_anterior, retorno, data_exoneracao, dias_desde_exoneracao, mudou_cargo, mudou_orgao"


@_query("timeline_full", f"{_BASE} SELECT linha_csv, nome_normalizado, {_COLS} FROM timeline")
def _(spark, base):
    return act_timeline(spark, base).selectExpr("linha_csv", "nome_normalizado", *_COLS.split(", "))


@_query("timeline_orders", f"WITH {_ORDERS}, {_TIMELINE} SELECT linha, pessoa, {_COLS} FROM timeline")
def _(spark, base):
    return history(spark, base).selectExpr("linha", "pessoa", *_COLS.split(", "))


@_query("returns_after_dismissal", f"{_BASE} SELECT linha_csv, data, data_exoneracao, dias_desde_exoneracao FROM timeline WHERE retorno")
def _(spark, base):
    return act_timeline(spark, base).where("retorno").select("linha_csv", "data", "data_exoneracao", "dias_desde_exoneracao")


@_query("person_summary", f"""{_BASE} SELECT *, total_nomeacoes > 0 AND total_exoneracoes > 0 AS teve_ambos, total_retornos > 0 AS teve_retorno FROM (SELECT nome_normalizado, min_by(nome, ordem_pessoa) AS nome_exemplo, count(*) AS total_atos,
 count(*) FILTER (WHERE tipo_ato = 'nomeacao') AS total_nomeacoes, count(*) FILTER (WHERE tipo_ato = 'exoneracao') AS total_exoneracoes, count(*) FILTER (WHERE retorno) AS total_retornos, min(data) AS primeira_data, max(data) AS ultima_data,
 count(DISTINCT nullif(cargo, '')) AS cargos_distintos, count(DISTINCT nullif(orgao, '')) AS orgaos_distintos FROM timeline GROUP BY 1)""")
def _(spark, base):
    return L.person_summary(act_timeline(spark, base))


_MS = " UNION ALL ".join(f"SELECT DATE '{d}' AS d, '{n}' AS marco" for d, n in MILESTONES)


@_query("milestone_asof", f"WITH m AS ({_MS}), a AS (SELECT linha_csv, try_cast(data_publicacao AS DATE) AS data FROM doeg_2026) SELECT linha_csv, marco, d AS data_marco, CAST(data - d AS INTEGER) AS dias_desde_marco FROM a ASOF LEFT JOIN m ON a.data >= m.d")
def _(spark, base):
    rows = acts(spark, base).select("linha_csv", F.expr("try_to_date(data_publicacao, 'yyyy-MM-dd')").alias("data"))
    return L.latest_milestone(rows, MILESTONES).drop("data")


@_query("rejected_names", f"SELECT * FROM (SELECT linha_csv, nome, {_sql_reasons(_NOME)} AS motivo_rejeicao FROM doeg_2026) WHERE motivo_rejeicao <> ''")
def _(spark, base):
    return L.rejected_names(acts(spark, base))


@_query("name_reasons", f"SELECT motivo, count(*) AS atos FROM (SELECT unnest(string_split({_sql_reasons(_NOME)}, ';')) AS motivo FROM doeg_2026) WHERE motivo <> '' GROUP BY 1")
def _(spark, base):
    return acts(spark, base).select(F.explode(F.split(T.rejection_reasons(F.col("nome")), ";")).alias("motivo")).where("motivo <> ''").groupBy("motivo").agg(F.count("*").alias("atos"))


def _sql_lead(tokens: str, test: str) -> str:
    """Tokens behind the first place that passes ``test`` and is followed by two words of letters."""
    places = f"list_filter(range(1, len({tokens}) + 1), lambda i: ({test}) AND regexp_matches(coalesce({tokens}[i + 1], ''), '^\\p{{L}}{{2,}}$') AND regexp_matches(coalesce({tokens}[i + 2], ''), '^\\p{{L}}{{2}}'))"
    return f"CASE WHEN len({places}) > 0 THEN {tokens}[{places}[1] + 1:] ELSE {tokens} END"


def _sql_clean_names() -> str:
    """Independent of the engine's expressions but for the word lists: every step is a query over lists."""
    outer = "E' \\t\\r\\n,.;:-\\'\"'"
    upper = f"trim(upper(strip_accents(x)), {outer[:-1]}()')"
    words = lambda values: ", ".join(f"'{v}'" for v in values)
    split_ = "s"
    for a, b in T.SPLIT_NAMES:
        split_ = f"regexp_replace({split_}, '(?i) {a} ', ' {b} ', 'g')"
    return rf"""WITH a AS (SELECT linha_csv, ' ' || regexp_replace(replace(replace(regexp_replace(regexp_replace(nome, '(?i)<!--\s*image\s*-->', ' ', 'g'), '/U[0-9A-Fa-f]{{4}}', ' ', 'g'), '#', ' '), '-', ' - '), '[\s\x{{00a0}}]+', ' ', 'g') || ' ' AS s FROM doeg_2026),
 b AS (SELECT linha_csv, list_filter(string_split({split_}, ' '), lambda x: x <> '') AS t FROM a),
 c AS (SELECT linha_csv, {_sql_lead('t', f"ends_with(t[i], '.') AND len(list_filter(t[1:i], lambda x: {upper} = 'PROCESSO')) > 0")} AS t FROM b),
 d AS (SELECT linha_csv, {_sql_lead('t', "ends_with(t[i], ':')")} AS t FROM c), e AS (SELECT linha_csv, {_sql_lead('t', "t[i] = '-'")} AS t FROM d),
 f AS (SELECT linha_csv, t, list_transform(t, lambda x: {upper}) AS k FROM e),
 g AS (SELECT linha_csv, t, list_filter(range(1, len(t) + 1), lambda i: concat_ws(' ', k[i], k[i + 1]) = 'PARA EXERCER' OR i > 1 AND (k[i] IN ({words(T.END_WORDS)}) OR concat_ws(' ', k[i], k[i + 1]) IN ({words(T.END_PAIRS)})
  OR regexp_matches(k[i], '^\d[\d.\-/]*$') AND (regexp_matches(coalesce(t[i - 1], ''), '[:,-]$') OR i = len(t)) OR k[i] IN ({words(T.IDENTIFIERS)}) AND len(list_filter(k[i + 1:i + 3], lambda x: regexp_matches(x, '^[\p{{L}}º°.]*\d'))) > 0
  OR regexp_matches(k[i], '^(?:ID|RG|CPF|MATR?)\d'))) AS fim FROM f)
 SELECT linha_csv, trim(replace(array_to_string(CASE WHEN len(fim) > 0 THEN t[1:fim[1] - 1] ELSE t END, ' '), ' - ', '-'), {outer}) AS nome_limpo FROM g"""


@_query("clean_names", _sql_clean_names())
def _(spark, base):
    return acts(spark, base).select("linha_csv", T.clean_person_name(F.col("nome")).alias("nome_limpo"))


for _name, _key, _sql in (("dedup_write_key", D.write_key, _WRITE), ("dedup_load_key", D.load_key, _LOAD), ("dedup_norm_key", D.maintenance_key, _MAINT)):
    QUERIES[_name] = (lambda key: lambda spark, base: D.first_ids(acts(spark, base), key()))(_key)
    ORACLES[_name] = f"SELECT min(linha_csv) AS linha_csv FROM doeg_2026 GROUP BY {_sql}"


@_query("dedup_report", f"SELECT arquivo_markdown AS arquivo, CAST(sum(n) AS BIGINT) AS linhas_antes, count(*) AS linhas_depois, CAST(sum(n) - count(*) AS BIGINT) AS duplicatas_removidas FROM (SELECT arquivo_markdown, count(*) AS n FROM doeg_2026 GROUP BY arquivo_markdown, {_MAINT}) GROUP BY 1")
def _(spark, base):
    return D.dedup_report(acts(spark, base), D.maintenance_key(), "arquivo_markdown")


@_query("full_row_distinct", "SELECT DISTINCT * FROM falhas")
def _(spark, base):
    return table(spark, base, "falhas").dropDuplicates()


@_query("anti_new_acts", f"SELECT linha_csv FROM doeg_2026 WHERE data_publicacao >= '2026-07-01' AND md5(concat_ws('|', {_WRITE})) NOT IN (SELECT md5(concat_ws('|', {_WRITE})) FROM doeg_2026 WHERE data_publicacao < '2026-07-01')")
def _(spark, base):
    a = acts(spark, base)
    return D.new_rows(a.where("data_publicacao < '2026-07-01'"), a.where("data_publicacao >= '2026-07-01'"), D.write_key()).select("linha_csv")


@_query("incremental_append", f"""SELECT linha_csv FROM doeg_2026 WHERE data_publicacao < '2026-07-01' UNION ALL SELECT min(linha_csv) FROM doeg_2026 WHERE data_publicacao >= '2026-07-01'
 AND md5(concat_ws('|', {_WRITE})) NOT IN (SELECT md5(concat_ws('|', {_WRITE})) FROM doeg_2026 WHERE data_publicacao < '2026-07-01') GROUP BY {_WRITE}""")
def _(spark, base):
    a = acts(spark, base)
    return D.upsert(a.where("data_publicacao < '2026-07-01'"), a.where("data_publicacao >= '2026-07-01'"), D.write_key()).select("linha_csv")


@_query("incremental_timeline", f"{_BASE} SELECT linha_csv, ordem_pessoa, retorno FROM timeline")
def _(spark, base):
    a = L.person_acts(acts(spark, base))
    return L.affected_timeline(a.where("data < '2026-07-01'"), a.where("data >= '2026-07-01'")).select("linha_csv", "ordem_pessoa", "retorno")


@_query("normalize_text", f"SELECT linha_csv, {_NOME} AS nome_norm, {_sql_norm('orgao')} AS orgao_norm, {_sql_norm('assinante')} AS assinante_norm FROM doeg_2026")
def _(spark, base):
    return acts(spark, base).select("linha_csv", *[T.normalize_text(F.col(c)).alias(f"{c}_norm") for c in ("nome", "orgao", "assinante")])


@_query("agency_normalize", f"SELECT linha_csv, {_sql_agency('orgao')} AS orgao FROM doeg_2026")
def _(spark, base):
    return acts(spark, base).select("linha_csv", T.agency(F.col("orgao")).alias("orgao"))


@_query("agency_chart_key", f"SELECT DISTINCT {_sql_key('orgao')} AS chave, {_sql_label('orgao')} AS rotulo FROM movimentacoes")
def _(spark, base):
    return mov(spark, base).select(T.agency_key(F.col("orgao")).alias("chave"), T.agency_label(F.col("orgao")).alias("rotulo")).distinct()


@_query("agency_labels", f"WITH n AS (SELECT {_sql_key('orgao')} AS chave, {_sql_label('orgao')} AS rotulo, count(*) AS n FROM movimentacoes GROUP BY ALL) SELECT chave, first(rotulo ORDER BY n DESC, rotulo) AS rotulo, CAST(sum(n) AS BIGINT) AS atos FROM n WHERE chave <> '' GROUP BY 1")
def _(spark, base):
    return A.agency_labels(mov(spark, base))


@_query("slug", "SELECT arquivo, coalesce(nullif(upper(trim(regexp_replace(strip_accents(coalesce(caderno, '')), '[^A-Za-z0-9]+', '_', 'g'), '_')), ''), 'caderno') AS slug FROM edicoes")
def _(spark, base):
    return editions(spark, base).select("arquivo", T.slug(F.col("caderno")).alias("slug"))


@_query("title_case", """SELECT linha_csv, array_to_string(list_transform(string_split(lower(trim(regexp_replace(assinante, '[\t\n\f\r \\x{00a0}]+', ' ', 'g'))), ' '), lambda w, i: CASE WHEN i > 1 AND w IN ('de', 'da', 'do', 'das', 'dos', 'e') THEN w ELSE upper(substr(w, 1, 1)) || substr(w, 2) END), ' ') AS assinante FROM doeg_2026""")
def _(spark, base):
    return acts(spark, base).select("linha_csv", T.title_case(F.col("assinante")).alias("assinante"))


@_query("authorship_case", f"SELECT {_AUTHOR} AS autoria_ato, count(*) AS atos FROM doeg_2026 GROUP BY 1")
def _(spark, base):
    return acts(spark, base).groupBy(T.authorship(F.col("cargo_assinante")).alias("autoria_ato")).agg(F.count("*").alias("atos"))


@_query("mov_projection", f"{_BASE} SELECT {_MOVED}, data AS data_movimentacao FROM timeline")
def _(spark, base):
    return C.movements(act_timeline(spark, base))


_DUR = "CASE WHEN dias_desde_exoneracao IS NULL THEN 'desconhecido' WHEN dias_desde_exoneracao = 0 THEN 'imediato' WHEN dias_desde_exoneracao < 30 THEN 'curto' WHEN dias_desde_exoneracao <= 180 THEN 'medio' ELSE 'longo' END"


@_query("ret_projection", f"{_BASE} SELECT {_MOVED}, data AS data_nomeacao, data_exoneracao, dias_desde_exoneracao, mudou_cargo, mudou_orgao, {_DUR} AS tempo_cluster, {_RET_STATE} AS estado_n FROM timeline WHERE retorno")
def _(spark, base):
    return act_returns(spark, base)


@_query("duration_class", f"{_BASE} SELECT CAST(year(data) AS INTEGER) AS ano, {_DUR} AS tempo_cluster, count(*) AS quantidade FROM timeline WHERE retorno GROUP BY ALL")
def _(spark, base):
    return A.count_by(act_returns(spark, base), "ano", "tempo_cluster")


@_query("count_year_type", "SELECT ano, tipo_ato, count(*) AS quantidade FROM movimentacoes WHERE ano IS NOT NULL AND tipo_ato IS NOT NULL GROUP BY ALL")
def _(spark, base):
    return A.count_by(mov(spark, base), "ano", "tipo_ato")


@_query("signed_flow_rep", "SELECT representante_governo, tipo_ato, CASE WHEN tipo_ato = 'exoneracao' THEN -count(*) ELSE count(*) END AS fluxo FROM movimentacoes GROUP BY representante_governo, tipo_ato")
def _(spark, base):
    return A.signed_flow(mov(spark, base), "representante_governo")


_BAL = "count(*) FILTER (WHERE tipo_ato = 'exoneracao') AS exoneracao, count(*) FILTER (WHERE tipo_ato = 'nomeacao') AS nomeacao"


@_query("balance_pivot", f"SELECT *, nomeacao - exoneracao AS saldo, nomeacao + exoneracao AS atos FROM (SELECT representante_origem, {_BAL} FROM movimentacoes GROUP BY 1)")
def _(spark, base):
    return A.balance(mov(spark, base), "representante_origem")


_TOP = f"""n AS (SELECT {_sql_key('orgao')} AS chave, {_sql_label('orgao')} AS rotulo, count(*) AS n FROM movimentacoes GROUP BY ALL),
 top AS (SELECT chave, first(rotulo ORDER BY n DESC, rotulo) AS rotulo, sum(n) AS atos FROM n WHERE chave <> '' GROUP BY 1 ORDER BY atos DESC, chave LIMIT 10)"""


@_query("top10_agencies", f"WITH {_TOP} SELECT chave, rotulo, tipo_ato, CASE WHEN tipo_ato = 'exoneracao' THEN -count(*) ELSE count(*) END AS fluxo FROM (SELECT {_sql_key('orgao')} AS chave, tipo_ato FROM movimentacoes) JOIN top USING (chave) GROUP BY chave, rotulo, tipo_ato")
def _(spark, base):
    return A.top_agencies(mov(spark, base))


@_query("month_series", "SELECT CAST(date_trunc('month', data_movimentacao) AS DATE) AS mes, representante_governo, tipo_ato, count(*) AS quantidade, coalesce(string_agg(DISTINCT origem_representante, ' / ' ORDER BY origem_representante), '') AS origens FROM movimentacoes WHERE data_movimentacao IS NOT NULL GROUP BY 1, 2, 3")
def _(spark, base):
    return A.month_series(mov(spark, base))


@_query("month_gap_fill", """WITH n AS (SELECT CAST(date_trunc('month', data_movimentacao) AS DATE) AS mes, representante_governo, tipo_ato, count(*) AS quantidade FROM movimentacoes WHERE data_movimentacao IS NOT NULL GROUP BY ALL),
 s AS (SELECT representante_governo, tipo_ato, CAST(unnest(generate_series(min(mes), max(mes), INTERVAL 1 MONTH)) AS DATE) AS mes FROM n GROUP BY 1, 2) SELECT s.mes, s.representante_governo, s.tipo_ato, quantidade FROM s LEFT JOIN n ON s.mes = n.mes AND s.representante_governo = n.representante_governo AND s.tipo_ato = n.tipo_ato""")
def _(spark, base):
    return A.gap_filled(mov(spark, base))


@_query("adaptive_period", """WITH m AS (SELECT representante_governo, tipo_ato, data_movimentacao AS d FROM movimentacoes WHERE data_movimentacao IS NOT NULL), f AS (SELECT count(DISTINCT representante_governo) <= 3 AS mensal, max(d) AS fim FROM m)
 SELECT CASE WHEN mensal THEN CASE WHEN date_trunc('month', d) = date_trunc('month', fim) THEN fim + 1 ELSE last_day(d) END ELSE make_date(year(d), 1, 1) END AS periodo, representante_governo, tipo_ato, count(*) AS quantidade FROM m, f GROUP BY ALL""")
def _(spark, base):
    return A.adaptive_period(mov(spark, base))


@_query("cards", """SELECT count(*) AS atos, count(DISTINCT pessoa) AS pessoas, count(*) FILTER (WHERE tipo_ato = 'nomeacao') AS nomeacoes, count(*) FILTER (WHERE tipo_ato = 'exoneracao') AS exoneracoes,
 count(*) FILTER (WHERE tipo_ato = 'nomeacao' AND autoria_ato = 'Governador') AS nomeacoes_governador, count(*) FILTER (WHERE tipo_ato = 'exoneracao' AND autoria_ato = 'Governador') AS exoneracoes_governador,
 count(*) FILTER (WHERE tipo_ato = 'nomeacao') - count(*) FILTER (WHERE tipo_ato = 'exoneracao') AS saldo FROM movimentacoes""")
def _(spark, base):
    return A.cards(mov(spark, base))


@_query("six_filters", "SELECT pessoa, data_movimentacao, orgao FROM movimentacoes WHERE estado IN ('GO') AND ano IN (2026) AND autoria_ato IN ('governador', 'desconhecido') AND tipo_ato IN ('nomeacao')")
def _(spark, base):
    chosen = {"estado": ["GO"], "ano": [2026], "representante_origem": [], "orgao": [], "autoria_ato": ["governador", "desconhecido"], "tipo_ato": ["nomeacao"]}
    return A.filtered(mov(spark, base), **chosen).select("pessoa", "data_movimentacao", "orgao")


@_query("filter_options", f"SELECT filtro, valor FROM ({_OPTIONS}) WHERE valor IS NOT NULL AND valor <> ''")
def _(spark, base):
    return A.filter_options(mov(spark, base), "GO")


@_query("mobility_rates", f"{_BASE}, {_RET} SELECT CAST(ano AS INTEGER) AS ano, round(avg(CAST(mudou_cargo AS INT)), 6) AS taxa_cargo, round(avg(CAST(mudou_orgao AS INT)), 6) AS taxa_orgao, count(*) AS retornos FROM ret GROUP BY 1")
def _(spark, base):
    return A.mobility_rates(act_returns(spark, base))


@_query("return_summary_stats", f"{_BASE}, {_RET} SELECT count(*) AS retornos, count(DISTINCT pessoa) AS pessoas, round(avg(dias_desde_exoneracao), 6) AS media, median(dias_desde_exoneracao) AS mediana, round(avg(CAST(mudou_cargo AS INT)), 6) AS taxa_cargo, round(avg(CAST(mudou_orgao AS INT)), 6) AS taxa_orgao FROM ret")
def _(spark, base):
    return A.return_stats(act_returns(spark, base))


@_query("transitions", f"{_CHAIN} SELECT * FROM tr")
def _(spark, base):
    return A.transitions(act_returns(spark, base))


@_query("transition_probs", f"{_CHAIN} SELECT estado, prox_estado, n, round(n / sum(n) OVER (PARTITION BY estado), 8) AS p FROM tr")
def _(spark, base):
    return A.transition_probabilities(act_returns(spark, base))


@_query("top30_transitions", f"{_CHAIN} SELECT * FROM tr ORDER BY n DESC, estado, prox_estado LIMIT 30")
def _(spark, base):
    return A.top_transitions(act_returns(spark, base))


@_query("top30_by_year", f"{_CHAIN}, ty AS (SELECT CAST(ano AS INTEGER) AS ano, estado, prox_estado, count(*) AS n FROM nx WHERE prox_estado IS NOT NULL GROUP BY ALL) SELECT *, CAST(row_number() OVER (PARTITION BY ano ORDER BY n DESC, estado, prox_estado) AS INTEGER) AS posicao FROM ty QUALIFY posicao <= 30")
def _(spark, base):
    return A.top_transitions_by_year(act_returns(spark, base))


@_query("graph_degree", f"{_CHAIN}, top AS (SELECT * FROM tr ORDER BY n DESC, estado, prox_estado LIMIT 30) SELECT estado, count(*) AS grau FROM (SELECT estado FROM top UNION ALL SELECT prox_estado FROM top) GROUP BY 1")
def _(spark, base):
    return A.degrees(act_returns(spark, base))


_CHAINED = """q AS (SELECT estado, prox_estado, n / sum(n) OVER (PARTITION BY estado) AS q FROM tr), names AS (SELECT estado FROM tr UNION SELECT prox_estado FROM tr),
 m AS (SELECT estado, prox_estado, q FROM q UNION ALL SELECT estado, estado, 1.0 FROM names WHERE estado NOT IN (SELECT estado FROM tr)),
 v(k, estado, p) AS (SELECT 0, estado, CAST(1.0 AS DOUBLE) / (SELECT count(*) FROM names) FROM names
  UNION ALL SELECT * FROM (WITH old AS (SELECT * FROM v) SELECT old.k + 1, m.prox_estado, sum(old.p * m.q) FROM old JOIN (SELECT estado, prox_estado, q / 2 AS q FROM m UNION ALL SELECT estado, estado, 0.5 FROM names) AS m USING (estado) WHERE old.k < 400 GROUP BY 1, 2))"""


@_query("stationary_vector", f"{_CHAIN.replace('WITH ', 'WITH RECURSIVE ', 1)}, {_CHAINED} SELECT estado, round(p, 4) AS p FROM v WHERE k = 400")
def _(spark, base):
    return A.stationary_vector(act_returns(spark, base)).select("estado", F.round("p", 4).alias("p"))


@_query("label_occurrence", """SELECT arquivo, CASE WHEN k = 1 THEN caderno WHEN regexp_matches(caderno, '(?i)\\b(?:complementar|suplemento|extra)\\b') THEN caderno || ' ' || k ELSE caderno || ' - Edicao ' || k END AS rotulo
 FROM (SELECT *, row_number() OVER (PARTITION BY uf, data_publicacao, caderno ORDER BY arquivo) AS k FROM edicoes)""")
def _(spark, base):
    return E.numbered_labels(editions(spark, base), "caderno", ("uf", "data_publicacao"), "arquivo").select("arquivo", "rotulo")


_GOV = " UNION ALL ".join(f"SELECT '{n}' AS gestao, DATE '{a}' AS de, DATE '{b}' AS ate" for n, a, b in GOVERNORS)


@_query("governor_range_join", f"WITH g AS ({_GOV}) SELECT arquivo, gestao FROM edicoes LEFT JOIN g ON try_cast(data_publicacao AS DATE) BETWEEN de AND ate")
def _(spark, base):
    terms = spark.createDataFrame(GOVERNORS, "gestao string, de string, ate string").selectExpr("gestao", "to_date(de) AS de", "to_date(ate) AS ate")
    day = F.expr("try_to_date(data_publicacao, 'yyyy-MM-dd')")
    rows = editions(spark, base).select("arquivo", day.alias("d"))
    return rows.join(F.broadcast(terms), F.col("d").between(F.col("de"), F.col("ate")), "left").select("arquivo", "gestao")  # a parameter list


@_query("contextual_signer_asof", "SELECT linha_csv, last_value(nullif(cargo_assinante, '') IGNORE NULLS) OVER (PARTITION BY arquivo_markdown ORDER BY linha_csv ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cargo_contexto FROM doeg_2026")
def _(spark, base):
    return E.carried_forward(acts(spark, base), "arquivo_markdown", "linha_csv", "cargo_assinante").withColumnRenamed("contexto", "cargo_contexto")


@_query("queue_pop", f"SELECT arquivo, data_publicacao, tentativas FROM edicoes WHERE estado IN ('pendente', 'erro') AND (disponivel_em IS NULL OR disponivel_em <= TIMESTAMP '{NOW}') ORDER BY data_publicacao DESC, tentativas, arquivo LIMIT 1")
def _(spark, base):
    return E.queue_pop(editions(spark, base), NOW).select("arquivo", "data_publicacao", "tentativas")


@_query("queue_backoff", "SELECT arquivo, CAST(least(360, 5 * pow(2, least(tentativas - 1, 6))) AS INTEGER) AS minutos FROM edicoes")
def _(spark, base):
    return editions(spark, base).select("arquivo", E.backoff_minutes(F.col("tentativas")).alias("minutos"))


@_query("pending_probe", "SELECT uf, estado, count(*) AS edicoes, count(*) FILTER (WHERE arquivo NOT IN (SELECT arquivo_markdown FROM doeg_2026)) AS sem_atos FROM edicoes GROUP BY ALL")
def _(spark, base):
    return E.pending(editions(spark, base), acts(spark, base))


@_query("missing_days", """WITH d AS (SELECT DISTINCT try_cast(data_publicacao AS DATE) AS dia FROM edicoes), r AS (SELECT CAST(unnest(generate_series(min(dia), max(dia), INTERVAL 1 DAY)) AS DATE) AS dia FROM d)
 SELECT dia FROM r WHERE isodow(dia) < 6 AND dia NOT IN (SELECT dia FROM d WHERE dia IS NOT NULL)""")
def _(spark, base):
    rows = editions(spark, base).select(F.expr("try_to_date(data_publicacao, 'yyyy-MM-dd')").alias("data"))
    return E.missing_days(rows, "data")


@_query("latest_by_source", "SELECT uf, min(data_publicacao) AS primeira, max(data_publicacao) AS ultima FROM edicoes GROUP BY 1")
def _(spark, base):
    return editions(spark, base).groupBy("uf").agg(F.min("data_publicacao").alias("primeira"), F.max("data_publicacao").alias("ultima"))


@_query("failures_by_step", "SELECT etapa, count(*) AS falhas, count(DISTINCT url) AS urls, max(registrado_em) AS ultima FROM falhas GROUP BY 1")
def _(spark, base):
    return table(spark, base, "falhas").groupBy("etapa").agg(F.count("*").alias("falhas"), F.count_distinct("url").alias("urls"), F.max("registrado_em").alias("ultima"))


@_query("date_range_complement", "SELECT linha_csv FROM doeg_2026 WHERE NOT (try_cast(data_publicacao AS DATE) >= DATE '2026-03-01' AND try_cast(data_publicacao AS DATE) <= DATE '2026-09-30')")
def _(spark, base):
    rows = acts(spark, base).select("linha_csv", F.expr("try_to_date(data_publicacao, 'yyyy-MM-dd')").alias("d"))
    return rows.where(L.in_range(F.col("d"), "2026-03-01", "2026-09-30", outside=True)).select("linha_csv")


@_query("coalesce_year", "SELECT coalesce(ano, CAST(year(data_movimentacao) AS INTEGER)) AS ano, count(*) AS atos FROM movimentacoes GROUP BY 1")
def _(spark, base):
    return mov(spark, base).groupBy(F.coalesce("ano", F.year("data_movimentacao")).alias("ano")).agg(F.count("*").alias("atos"))


@_query("period_label", "WITH y AS (SELECT list_sort(list(DISTINCT ano) FILTER (WHERE ano IS NOT NULL)) AS y FROM movimentacoes) SELECT CASE WHEN len(y) = 0 THEN 'sem período' WHEN len(y) = 1 THEN CAST(y[1] AS VARCHAR) WHEN y[-1] - y[1] + 1 = len(y) THEN y[1] || '-' || y[-1] ELSE array_to_string(y, ', ') END AS periodo FROM y")
def _(spark, base):
    return A.period_label(mov(spark, base))


@_query("complete_columns", "SELECT coalesce(estado, '') AS estado, coalesce(autoria_ato, '') AS autoria_ato, coalesce(cargo, '') AS cargo, '' AS trecho, count(*) AS linhas FROM movimentacoes GROUP BY ALL")
def _(spark, base):
    rows = D.complete_columns(mov(spark, base), ("estado", "autoria_ato", "cargo", "trecho"))
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("linhas"))


@_query("top_representatives", f"SELECT * FROM (SELECT *, nomeacao - exoneracao AS saldo, nomeacao + exoneracao AS atos FROM (SELECT representante_governo, {_BAL} FROM movimentacoes GROUP BY 1)) ORDER BY atos DESC, representante_governo LIMIT 5")
def _(spark, base):
    return A.balance(mov(spark, base), "representante_governo").orderBy(F.desc("atos"), "representante_governo").limit(5)


_ORPHAN = "(length(trim(orgao)) < 10 OR regexp_matches(lower(trim(orgao)), ' d[ao]$'))"


@_query("repaired_agencies", f"""WITH d AS (SELECT arquivo_markdown, tipo_ato, nome, min_by(orgao, linha_csv) AS s FROM doeg_2026 WHERE NOT {_ORPHAN} AND nome <> '' GROUP BY ALL)
 SELECT linha_csv, CASE WHEN {_ORPHAN} THEN coalesce(s, orgao) ELSE orgao END AS orgao FROM doeg_2026 LEFT JOIN d USING (arquivo_markdown, tipo_ato, nome)""")
def _(spark, base):
    return R.repaired_agencies(acts(spark, base))


@_query("role_text", """WITH r AS (SELECT linha_csv, cargo, trim(regexp_replace(cargo, '(?i)^(?:para exercer )?(?:[oa] )?(?:cargo(?: em comiss[aã]o)?|fun[cç][aã]o(?: gratificada)?) d[eoa] ', '')) AS b FROM doeg_2026) SELECT linha_csv, CASE WHEN length(b) > 2 THEN b ELSE cargo END AS cargo FROM r""")
def _(spark, base):
    return acts(spark, base).select("linha_csv", R.role_text(F.col("cargo")).alias("cargo"))


@_query("run_counters", f"{_BASE} SELECT count(*) AS atos, count(DISTINCT nome_normalizado) AS pessoas, count(*) FILTER (WHERE retorno) AS retornos, count(*) FILTER (WHERE regexp_matches(lower(trim(cargo_assinante)), '^(?:sub)?secret.rio')) AS atos_secretaria FROM timeline")
def _(spark, base):
    return R.run_counters(act_timeline(spark, base))


@_query("round_robin", "SELECT arquivo, uf, CAST(row_number() OVER (PARTITION BY uf ORDER BY data_publicacao DESC, arquivo) AS INTEGER) AS rodada FROM edicoes")
def _(spark, base):
    return E.turns(editions(spark, base))


@_query("edition_governor")
def _(spark, base):
    return R.edition_governor(table(spark, base, "documents"), [n for n in S.ORIGINS])


@_query("thousands", "SELECT uf, replace(format('{:,}', count(*)), ',', '.') AS edicoes FROM edicoes GROUP BY 1")
def _(spark, base):
    return editions(spark, base).groupBy("uf").agg(R.thousands(F.count("*")).alias("edicoes"))


@_query("extract_acts")
def _(spark, base):
    return X.extract_acts(table(spark, base, "documents"))


@_query("extract_excerpts")
def _(spark, base):
    return X.extract_acts(acts(spark, base).select(F.col("linha_csv").alias("doc_id"), "estado", F.col("trecho").alias("text")))


@_query("page_text", r"SELECT doc_id, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(coalesce(text, ''), '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&'), '[\s\x{00a0}\x{2028}\x{0085}]+', ' ', 'g')) AS texto FROM documents")
def _(spark, base):
    return table(spark, base, "documents").select("doc_id", P.unescape_html(F.col("text")).alias("texto"))


# ---------------------------------------------------------------- smaller operators


_FLAT = _sql_norm("caderno")


@_query("entity_filter", "SELECT linha_csv FROM doeg_2026 WHERE contains(coalesce(spacy_entidades, ''), ':PER') OR trim(coalesce(spacy_entidades, '')) = ''")
def _(spark, base):
    return C.entity_filter(acts(spark, base)).select("linha_csv")


@_query("recognition_filter", "SELECT linha_csv FROM doeg_2026 WHERE coalesce(spacy_pessoa, '') <> 'nao'")
def _(spark, base):
    return C.recognised(acts(spark, base), "filter").select("linha_csv")


@_query("recognition_reasons", f"SELECT motivo_rejeicao, count(*) AS atos FROM (SELECT CASE WHEN {_sql_reasons(_NOME)} = '' AND coalesce(spacy_pessoa, '') NOT IN ('sim', 'indisponivel') THEN 'spacy_nao_confirmou_pessoa' ELSE {_sql_reasons(_NOME)} END AS motivo_rejeicao FROM doeg_2026) GROUP BY 1")
def _(spark, base):
    return C.recognised(acts(spark, base), "filtrar").groupBy("motivo_rejeicao").agg(F.count("*").alias("atos"))


@_query("section_filter", f"SELECT arquivo FROM edicoes WHERE contains({_FLAT}, 'EXECUTIVO')")
def _(spark, base):
    return C.by_section(editions(spark, base), "executivo").select("arquivo")


@_query("section_start", f"SELECT arquivo FROM edicoes WHERE starts_with({_FLAT}, 'CADERNO')")
def _(spark, base):
    return C.by_section(editions(spark, base), "Caderno", start=True).select("arquivo")


@_query("real_people", "SELECT linha_csv FROM doeg_2026 WHERE NOT coalesce(upper(string_split(nome, ' ')[1]) IN ('COMPROMISSO', 'MESMA', 'PROVAS', 'SUAS', 'OS'), false)")
def _(spark, base):
    return C.real_people(acts(spark, base), ("COMPROMISSO", "MESMA", "PROVAS", "SUAS", "OS")).select("linha_csv")


@_query("states_with_both", "SELECT DISTINCT estado FROM movimentacoes WHERE estado IN (SELECT uf FROM edicoes)")
def _(spark, base):
    return C.states_with_both(mov(spark, base), editions(spark, base).select(F.col("uf").alias("estado")))


@_query("consolidated_by_state", "SELECT pessoa, data_movimentacao FROM movimentacoes WHERE estado = 'GO'")
def _(spark, base):
    return A.filtered(mov(spark, base), estado=["GO"]).select("pessoa", "data_movimentacao")


@_query("processed_range", "SELECT min(try_cast(data_publicacao AS DATE)) AS primeira, DATE '2026-09-30' AS ultima FROM doeg_2026")
def _(spark, base):
    rows = acts(spark, base).select(F.try_to_date("data_publicacao", "yyyy-MM-dd").alias("d"))
    return C.processed_range(rows, "d", high="2026-09-30")


@_query("incremental_rows", f"""WITH a AS (SELECT *, try_cast(data_publicacao AS DATE) AS data, md5(concat_ws('|', {_LOAD})) AS k FROM doeg_2026), old AS (SELECT * FROM a WHERE linha_csv % 2 = 0 AND data BETWEEN DATE '2026-03-01' AND DATE '2026-09-30')
 SELECT linha_csv FROM a WHERE linha_csv % 2 = 1 AND (NOT coalesce(data BETWEEN (SELECT min(data) FROM old) AND (SELECT max(data) FROM old), false) OR k NOT IN (SELECT k FROM old))""")
def _(spark, base):
    a = acts(spark, base).withColumn("data", F.try_to_date("data_publicacao", "yyyy-MM-dd"))
    old = a.where("linha_csv % 2 = 0").where(L.in_range(F.col("data"), "2026-03-01", "2026-09-30"))
    return C.incremental_rows(old, a.where("linha_csv % 2 = 1")).select("linha_csv")


@_query("short_labels", f"SELECT DISTINCT governador_edicao, CASE WHEN len(w) > 1 THEN w[1] || ' ' || w[-1] ELSE r END AS curto FROM (SELECT governador_edicao, {_REP} AS r, string_split(regexp_replace({_REP}, ' +', ' ', 'g'), ' ') AS w FROM doeg_2026)")
def _(spark, base):
    return acts(spark, base).select("governador_edicao", T.short_name(F.col("governador_edicao")).alias("curto")).distinct()


@_query("short_governor", """SELECT DISTINCT g AS governador_edicao, CASE WHEN contains(g, ' - ') THEN CASE WHEN len(w) > 1 THEN w[1] || ' ' || w[-1] ELSE split_part(g, ' - ', 1) END || substr(g, strpos(g, ' - ')) ELSE g END AS curto
 FROM (SELECT g, string_split(regexp_replace(trim(split_part(g, ' - ', 1)), ' +', ' ', 'g'), ' ') AS w FROM (SELECT trim(coalesce(nullif(governador_edicao, ''), 'Nao identificado')) AS g FROM doeg_2026))""")
def _(spark, base):
    g = F.trim(F.coalesce(F.nullif("governador_edicao", F.lit("")), F.lit(S.UNKNOWN)))
    return acts(spark, base).select(g.alias("governador_edicao"), T.short_governor(F.col("governador_edicao")).alias("curto")).distinct()


@_query("axis_mode", "SELECT CASE WHEN list_sort(list(DISTINCT origem_representante) FILTER (WHERE origem_representante IS NOT NULL)) = ['Setor'] THEN 'Setor' ELSE 'Governo' END AS eixo FROM movimentacoes")
def _(spark, base):
    return A.axis_mode(mov(spark, base))


_ORDERED_FLOW = """f AS (SELECT representante_origem, tipo_ato, CASE WHEN tipo_ato = 'exoneracao' THEN -count(*) ELSE count(*) END AS fluxo FROM m WHERE representante_origem IS NOT NULL AND tipo_ato IS NOT NULL GROUP BY representante_origem, tipo_ato),
 s AS (SELECT representante_origem, CAST(sum(abs(fluxo)) AS BIGINT) AS soma_abs FROM f GROUP BY 1), o AS (SELECT *, CAST(row_number() OVER (ORDER BY soma_abs DESC, representante_origem) AS INTEGER) AS posicao FROM s)"""


@_query("flow_order", f"WITH m AS (SELECT * FROM movimentacoes), {_ORDERED_FLOW} SELECT * FROM f JOIN o USING (representante_origem)")
def _(spark, base):
    return A.flow_order(mov(spark, base))


@_query("sector_top10", f"WITH m AS (SELECT orgao AS representante_origem, tipo_ato FROM movimentacoes), {_ORDERED_FLOW} SELECT * FROM f JOIN o USING (representante_origem) WHERE posicao <= 10")
def _(spark, base):
    return A.flow_order(mov(spark, base).select(F.col("orgao").alias("representante_origem"), F.lit("Setor").alias("origem_representante"), "tipo_ato"))


@_query("extreme_balances", f"WITH b AS (SELECT *, nomeacao - exoneracao AS saldo FROM (SELECT representante_governo, {_BAL} FROM movimentacoes GROUP BY 1)) SELECT (SELECT representante_governo FROM b WHERE representante_governo IS NOT NULL ORDER BY saldo DESC, 1 LIMIT 1) AS maior, (SELECT representante_governo FROM b WHERE representante_governo IS NOT NULL ORDER BY saldo, 1 LIMIT 1) AS menor")
def _(spark, base):
    return A.extreme_balances(mov(spark, base))


@_query("top10_transitions", f"{_CHAIN} SELECT * FROM tr ORDER BY n DESC, estado, prox_estado LIMIT 10")
def _(spark, base):
    return A.top_transitions(act_returns(spark, base), 10)


@_query("option_union", "SELECT cargo AS valor FROM movimentacoes WHERE cargo <> '' UNION SELECT cargo FROM doeg_2026 WHERE cargo <> ''")
def _(spark, base):
    return A.option_union(mov(spark, base), acts(spark, base), "cargo")


@_query("latest_of_month", "SELECT CAST(date_trunc('month', data_movimentacao) AS DATE) AS mes, max(data_movimentacao) AS ultimo FROM movimentacoes WHERE data_movimentacao IS NOT NULL GROUP BY 1")
def _(spark, base):
    return A.latest_of_month(mov(spark, base))


@_query("month_type_count", "SELECT CAST(date_trunc('month', data_movimentacao) AS DATE) AS mes, tipo_ato, count(*) AS quantidade FROM movimentacoes WHERE data_movimentacao IS NOT NULL AND tipo_ato IS NOT NULL GROUP BY 1, 2")
def _(spark, base):
    return A.count_by(mov(spark, base).withColumn("mes", F.trunc("data_movimentacao", "MM")), "mes", "tipo_ato")


@_query("yes_no", "SELECT linha_csv, CASE lower(trim(nome_parse_confiavel)) WHEN 'sim' THEN true WHEN 'nao' THEN false WHEN 'não' THEN false END AS confiavel FROM doeg_2026")
def _(spark, base):
    return acts(spark, base).select("linha_csv", T.yes_no(F.col("nome_parse_confiavel")).alias("confiavel"))


@_query("milestone_parse", "SELECT linha_csv, try_cast(data_publicacao AS DATE) AS data, CASE WHEN linha_csv % 2 = 0 THEN trim(caderno) ELSE data_publicacao END AS marco FROM doeg_2026")
def _(spark, base):
    written = F.when(F.col("linha_csv") % 2 == 0, F.concat_ws(":", "data_publicacao", "caderno")).otherwise(F.col("data_publicacao"))
    return acts(spark, base).select("linha_csv", T.milestone(written).alias("m")).select("linha_csv", "m.*")


@_query("long_dates", r"""WITH t AS (SELECT linha_csv, lower(strip_accents(trecho)) AS t FROM doeg_2026), p AS (SELECT linha_csv, regexp_extract(t, '(\d{1,2})[oº]? +de +(janeiro|fevereiro|marco|abril|maio|junho|julho|agosto|setembro|outubro|novembro|dezembro) +de +(\d{4})', ['d', 'm', 'y']) AS x FROM t)
 SELECT linha_csv, try_cast(x.y || '-' || list_position(['janeiro', 'fevereiro', 'marco', 'abril', 'maio', 'junho', 'julho', 'agosto', 'setembro', 'outubro', 'novembro', 'dezembro'], x.m) || '-' || x.d AS DATE) AS data FROM p""")
def _(spark, base):
    return acts(spark, base).select("linha_csv", T.long_date(F.col("trecho")).alias("data"))


@_query("ordered_entities", "SELECT linha_csv, array_to_string(list_transform(list_filter(range(1, len(e) + 1), lambda i: e[i] <> '' AND list_position(e, e[i]) = i), lambda i: e[i]), '|') AS entidades FROM (SELECT linha_csv, string_split(coalesce(spacy_entidades, ''), '|') AS e FROM doeg_2026)")
def _(spark, base):
    return acts(spark, base).select("linha_csv", T.ordered_entities(F.col("spacy_entidades")).alias("entidades"))


@_query("dedup_totals", f"SELECT CAST(count(*) AS BIGINT) AS linhas_antes, CAST(count(DISTINCT md5(concat_ws('|', arquivo_markdown, {_MAINT}))) AS BIGINT) AS linhas_depois, CAST(count(*) - count(DISTINCT md5(concat_ws('|', arquivo_markdown, {_MAINT}))) AS BIGINT) AS duplicatas_removidas FROM doeg_2026")
def _(spark, base):
    return K.dedup_totals(D.dedup_report(acts(spark, base), D.maintenance_key(), "arquivo_markdown"))


@_query("new_key_count", f"SELECT count(DISTINCT md5(concat_ws('|', {_WRITE}))) AS novas FROM doeg_2026 WHERE data_publicacao >= '2026-07-01' AND md5(concat_ws('|', {_WRITE})) NOT IN (SELECT md5(concat_ws('|', {_WRITE})) FROM doeg_2026 WHERE data_publicacao < '2026-07-01')")
def _(spark, base):
    a = acts(spark, base)
    fresh = D.new_rows(a.where("data_publicacao < '2026-07-01'"), a.where("data_publicacao >= '2026-07-01'"), D.write_key())
    return D.first_ids(fresh, D.write_key()).agg(F.count("*").alias("novas"))


@_query("rejected_rows", f"SELECT linha_csv, estado, tipo_ato, nome, cargo, orgao, arquivo_markdown, motivo_rejeicao FROM (SELECT *, {_sql_reasons(_NOME)} AS motivo_rejeicao FROM doeg_2026) WHERE motivo_rejeicao <> ''")
def _(spark, base):
    a = acts(spark, base)
    return L.rejected_names(a).drop("nome").join(a, "linha_csv").select("linha_csv", "estado", "tipo_ato", "nome", "cargo", "orgao", "arquivo_markdown", "motivo_rejeicao")


_READY = f"estado IN ('pendente', 'erro') AND (disponivel_em IS NULL OR disponivel_em <= TIMESTAMP '{NOW}')"


@_query("queue_claim", f"WITH c AS (SELECT arquivo FROM edicoes WHERE {_READY} ORDER BY data_publicacao DESC, tentativas, arquivo LIMIT 5) SELECT arquivo, CASE WHEN arquivo IN (SELECT arquivo FROM c) THEN 'processando' ELSE estado END AS estado FROM edicoes")
def _(spark, base):
    return E.claim(editions(spark, base), NOW, 5).select("arquivo", "estado")


@_query("queue_finish", f"SELECT arquivo, CASE WHEN estado = 'processando' THEN 'concluido' ELSE estado END AS estado, CASE WHEN estado = 'processando' THEN '' ELSE erro END AS erro, CASE WHEN estado = 'processando' THEN TIMESTAMP '{NOW}' ELSE atualizado_em END AS atualizado_em FROM edicoes")
def _(spark, base):
    q = editions(spark, base)
    return E.finish(q, q.where("estado = 'processando'"), NOW).select("arquivo", "estado", "erro", "atualizado_em")


@_query("queue_recover", "SELECT arquivo, CASE WHEN estado = 'processando' THEN 'pendente' ELSE estado END AS estado FROM edicoes")
def _(spark, base):
    return E.recover(editions(spark, base), NOW).select("arquivo", "estado")


@_query("queue_register", f"""WITH n AS (SELECT arquivo, url || '?v=2' AS url FROM edicoes WHERE uf = 'GO' UNION ALL SELECT arquivo || '.novo', url FROM edicoes WHERE uf <> 'GO')
 SELECT coalesce(e.arquivo, n.arquivo) AS arquivo, coalesce(n.url, e.url) AS url, coalesce(e.estado, 'pendente') AS estado, coalesce(e.tentativas, 0) AS tentativas FROM edicoes e FULL JOIN n USING (arquivo)""")
def _(spark, base):
    q = editions(spark, base)
    new = q.where("uf = 'GO'").withColumn("url", F.concat("url", F.lit("?v=2"))).unionByName(q.where("uf <> 'GO'").withColumn("arquivo", F.concat("arquivo", F.lit(".novo"))))
    return E.register(q, new, NOW).select("arquivo", "url", "estado", "tentativas")


@_query("queue_failed", f"""SELECT arquivo, CASE WHEN estado = 'processando' THEN 'erro' ELSE estado END AS estado, CASE WHEN estado = 'processando' THEN tentativas + 1 ELSE tentativas END AS tentativas,
 CASE WHEN estado = 'processando' THEN TIMESTAMP '{NOW}' + to_minutes(CAST(least(360, 5 * pow(2, least(tentativas, 6))) AS INTEGER)) ELSE disponivel_em END AS disponivel_em FROM edicoes""")
def _(spark, base):
    q = editions(spark, base)
    return E.after_failure(q, q.where("estado = 'processando'").select("arquivo", F.lit("lost").alias("erro")), NOW).select("arquivo", "estado", "tentativas", "disponivel_em")


@_query("paused_until", "SELECT caderno, max(registrado_em) + INTERVAL 30 MINUTE AS pausa_ate FROM falhas GROUP BY 1")
def _(spark, base):
    return E.paused_until(table(spark, base, "falhas"), "caderno")


@_query("merged_by_date", "SELECT arquivo, CAST(row_number() OVER (ORDER BY data_publicacao DESC, uf, arquivo) AS INTEGER) AS posicao FROM edicoes")
def _(spark, base):
    return E.merged_by_date(editions(spark, base))


@_query("wanted_dates", "SELECT DISTINCT try_cast(data_publicacao AS DATE) AS dia FROM edicoes WHERE try_cast(data_publicacao AS DATE) BETWEEN DATE '2026-02-01' AND DATE '2026-08-31' AND isodow(try_cast(data_publicacao AS DATE)) < 6")
def _(spark, base):
    return E.wanted_dates(editions(spark, base).select(F.try_to_date("data_publicacao", "yyyy-MM-dd").alias("dia")), "2026-02-01", "2026-08-31", weekdays_only=True)


@_query("file_names", r"SELECT arquivo, try_cast(regexp_extract(arquivo, '_(\d{4}-\d{2}-\d{2})\.md$', 1) AS DATE) AS data, regexp_extract(arquivo, '/([A-Z]{2})/\d{4}/\d{2}/[^/]+$', 1) AS uf FROM edicoes")
def _(spark, base):
    name = F.element_at(F.split("arquivo", "/"), -1)
    return editions(spark, base).select("arquivo", K.file_date(name).alias("data"), F.regexp_extract("arquivo", r"/([A-Z]{2})/\d{4}/\d{2}/[^/]+$", 1).alias("uf"))


@_query("needs_ocr", r"SELECT doc_id, length(regexp_replace(coalesce(text, ''), '<!--(?s:.*?)-->|\s+', '', 'g')) < greatest(500, 10 * 80) AS ocr FROM documents")
def _(spark, base):
    return table(spark, base, "documents").select("doc_id", X.needs_ocr(F.coalesce("text", F.lit("")), F.lit(10)).alias("ocr"))


@_query("governor_columns", f"""WITH g AS (SELECT CASE WHEN municipio <> '' THEN '' WHEN linha_csv = 1 THEN 'Sergio Cabral - Governador' ELSE governador_edicao END AS governador_edicao, municipio FROM (SELECT * EXCLUDE linha_csv, CASE WHEN arquivo_markdown LIKE '%1.md' THEN 1 ELSE 0 END AS linha_csv FROM doeg_2026))
 SELECT governador_edicao, CASE WHEN municipio <> '' THEN '' ELSE {_REP} END AS representante_governo, CASE WHEN municipio <> '' THEN '' ELSE {_ORIGIN} END AS origem_representante, count(*) AS atos FROM g GROUP BY ALL""")
def _(spark, base):
    a = acts(spark, base)
    known = a.where("arquivo_markdown LIKE '%1.md'").select(F.col("arquivo_markdown").alias("path"), F.lit("Sergio Cabral - Governador").alias("governador")).distinct()
    return R.with_governor(a, known).groupBy("governador_edicao", "representante_governo", "origem_representante").agg(F.count("*").alias("atos"))


QUERIES.update(CASES.QUERIES)
ORACLES.update(CASES.ORACLES)
