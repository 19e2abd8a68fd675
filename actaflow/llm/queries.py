"""Queries of the training-data operators, over the whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from actaflow.llm import bpe, canonical_list, encoding_repair, format_copies, mixing, name_variants, page_noise, reading_level, survivors, truncation
from actaflow.runtime import table


def _found(fn, *names):
    return lambda spark, base: fn(*[table(spark, base, n) for n in names])


def p7_found(spark, base):
    return encoding_repair.garbled_values(table(spark, base, "doeg_2026")).select(F.col("id").alias("linha_csv"), "campo").distinct()


def p7_restored(spark, base):
    return encoding_repair.garbled_values(table(spark, base, "doeg_2026")).withColumnRenamed("id", "linha_csv")


def p6_unmatched(spark, base):
    """How often each value without an entry was typed."""
    acts = table(spark, base, "doeg_2026")
    found = canonical_list.mapped_values(acts, table(spark, base, "ref_orgaos"), table(spark, base, "ref_cargos")).where("ref_id = 0")
    value = F.when(F.col("campo") == "orgao", F.col("orgao")).otherwise(F.col("cargo_assinante"))
    return found.join(acts.select("linha_csv", "orgao", "cargo_assinante"), "linha_csv").groupBy("campo", value.alias("valor")).agg(F.count("*").alias("atos"))


QUERIES = {
    "p1_found": _found(page_noise.scanned, "doeg_2026"),
    "p1_repaired": _found(page_noise.repaired, "doeg_2026"),
    "p2_found": _found(survivors.contested_fields, "grupos_duplicados", "doeg_2026"),
    "p2_survivors": _found(survivors.surviving_records, "grupos_duplicados", "doeg_2026"),
    "p2_voted": _found(survivors.voted_fields, "grupos_duplicados", "doeg_2026"),
    "p3_found": _found(format_copies.surplus_pairs, "doeg_2026"),
    "p3_collapsed": lambda spark, base: format_copies.collapse_copies(table(spark, base, "doeg_2026")).select("linha_csv", "copias"),
    "p4_found": _found(name_variants.variant_pairs, "doeg_2026"),
    "p4_entities": _found(name_variants.entities, "doeg_2026"),
    "p5_found": _found(truncation.truncated, "doeg_2026"),
    "p5_rates": _found(truncation.truncation_rates, "doeg_2026"),
    "p6_found": _found(canonical_list.mapped_values, "doeg_2026", "ref_orgaos", "ref_cargos"),
    "p6_unmatched": p6_unmatched,
    "p7_found": p7_found,
    "p7_restored": p7_restored,
    "p8_ids": _found(bpe.encoded, "documents"),
    "p9_mix": _found(mixing.mix, "documents", "pesos_fontes"),
    "p9_shares": _found(mixing.share_report, "documents", "pesos_fontes"),
    "p10_found": lambda spark, base: reading_level.levelled(table(spark, base, "documents"), table(spark, base, "niveis_rotulados")).select("doc_id", "nivel"),
}

_LABELS = "|".join(format_copies.FIELD_LABELS)


def _sql_stripped(c: str) -> str:
    return rf"regexp_replace(lower(upper(coalesce({c}, ''))), '[^\p{{L}}\p{{N}}]+', '', 'g')"


_SQL_FIELDS = rf"""CASE WHEN regexp_matches(upper(trecho), '^[^\p{{L}}\p{{N}}]*(?:{_LABELS})[^\p{{L}}\p{{N}}]')
 THEN array_to_string(list_sort(list_filter(list_transform(string_split(regexp_replace(upper(trecho), '(^|[^\p{{L}}\p{{N}}])({_LABELS})([^\p{{L}}\p{{N}}]|$)', '\1' || chr(1) || '\2\3', 'g'), chr(1)),
 lambda x: regexp_replace(lower(x), '[^\p{{L}}\p{{N}}]+', '', 'g')), lambda x: x <> '')), chr(1)) ELSE {_sql_stripped('trecho')} END"""

_VOTED = ("cargo", "assinante", "cargo_assinante")
_SQL_COPIES = f"""k AS (SELECT linha_csv, md5(concat_ws(chr(2), estado, municipio, diario, data_publicacao, caderno, tipo_ato, id_funcional, assinante, cargo_assinante, categoria_assinante, governador_edicao,
  representante_governo, origem_representante, spacy_pessoa, spacy_entidades, nome_parse_confiavel, fonte_url, arquivo_markdown, {_sql_stripped('nome')}, {_sql_stripped('cargo')}, {_sql_stripped('orgao')}, {_SQL_FIELDS})) AS k FROM doeg_2026)"""


def _sql_values(fields: tuple[str, ...]) -> str:
    """Values of the fields of all members, with rank and votes, grouped by spelling and by normalised value."""
    names, cases = ", ".join(f"'{f}'" for f in fields), " ".join(f"WHEN '{f}' THEN coalesce({f}, '')" for f in fields)
    return rf"""m AS (SELECT DISTINCT grupo_id, linha_csv FROM grupos_duplicados),
 v AS (SELECT grupo_id, linha_csv, campo, CASE campo {cases} END AS valor, nome_parse_confiavel AS flag, coalesce(CAST(try_cast(data_publicacao AS DATE) - DATE '{survivors.REFERENCE_DAY}' AS INTEGER), -1000000) AS dia
  FROM m JOIN doeg_2026 USING (linha_csv), (SELECT unnest([{names}]) AS campo)),
 g AS (SELECT grupo_id, campo, valor, upper(regexp_replace(trim(valor), '\s+', ' ', 'g')) AS norm, max({{'s': (valor <> '' AND flag = 'sim')::INT, 'n': length(valor), 'd': dia}}) AS r, min(linha_csv) AS linha_csv,
  sum(CASE flag WHEN 'sim' THEN 1 WHEN 'indisponivel' THEN 0.5 ELSE 0.25 END * pow(2, least(greatest(dia, -100000) / 180.0, 900))) AS w FROM v GROUP BY 1, 2, 3)"""


_SQL_FIELDS_OF = ", ".join(f"max(valor) FILTER (WHERE campo = '{f}') AS {f}" for f in survivors.FIELDS)

ORACLES: dict[str, str] = {
    "p2_found": f"WITH {_sql_values(survivors.FIELDS)} SELECT grupo_id, campo, arg_max(linha_csv, {{'r': r, 'l': -linha_csv}}) AS linha_csv FROM g GROUP BY 1, 2 HAVING count(*) > 1",
    "p2_survivors": f"WITH {_sql_values(survivors.FIELDS)}, b AS (SELECT grupo_id, campo, arg_max(valor, {{'r': r, 'l': -linha_csv}}) AS valor FROM g GROUP BY 1, 2) SELECT grupo_id, {_SQL_FIELDS_OF} FROM b GROUP BY 1",
    "p2_voted": f"""WITH {_sql_values(_VOTED)}, n AS (SELECT grupo_id, campo, norm, round(log2(sum(w)), 6) AS votos, max({{'r': r, 'l': -linha_csv}}) AS m, arg_max(valor, {{'r': r, 'l': -linha_csv}}) AS valor FROM g GROUP BY 1, 2, 3)
 SELECT grupo_id, campo, arg_max(valor, {{'v': votos, 'm': m}}) AS valor, -(max({{'v': votos, 'm': m}})).m.l AS linha_csv FROM n GROUP BY 1, 2""",
    "p3_found": f"WITH {_SQL_COPIES}, f AS (SELECT k, min(linha_csv) AS linha_a FROM k GROUP BY 1) SELECT linha_a, linha_csv AS linha_b FROM k JOIN f USING (k) WHERE linha_csv <> linha_a",
    "p3_collapsed": f"WITH {_SQL_COPIES} SELECT min(linha_csv) AS linha_csv, count(*) AS copias FROM k GROUP BY k",
}
