"""Repairs of extracted acts, edition governors, and small payload helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actaflow import schemas as S

#: An agency this short, or that ends in a bare article, was cut by the extractor.
SHORT_AGENCY = 10


def orphan(agency: Column) -> Column:
    text = F.trim(F.coalesce(agency, F.lit("")))
    return (F.length(text) < SHORT_AGENCY) | F.lower(text).rlike(r" d[ao]$")


def repaired_agencies(acts: DataFrame) -> DataFrame:
    """``linha_csv, orgao``: orphan agencies replaced by the first sound one of the same document, act and name.

    The donors are found by aggregation, one row a key, so a document with many acts stays spread.
    """
    key = ["arquivo_markdown", "tipo_ato", "nome"]
    donors = acts.where(~orphan(F.col("orgao")) & (F.col("nome") != "")).groupBy(*key).agg(F.min_by("orgao", "linha_csv").alias("_sound"))
    fixed = F.when(orphan(F.col("orgao")), F.coalesce("_sound", "orgao")).otherwise(F.col("orgao"))
    return acts.join(donors, key, "left").select("linha_csv", fixed.alias("orgao"))


def role_text(role: Column) -> Column:
    """A role without its lead-in; kept as it was if hardly anything would remain."""
    bare = F.trim(F.regexp_replace(role, r"(?i)^(?:para exercer )?(?:[oa] )?(?:cargo(?: em comiss[aã]o)?|fun[cç][aã]o(?: gratificada)?) d[eoa] ", ""))
    return F.when(F.length(bare) > 2, bare).otherwise(role)


def run_counters(timeline: DataFrame) -> DataFrame:
    """Rows, people, returns and acts signed by secretaries, in one aggregation."""
    secretary = F.lower(F.trim("cargo_assinante")).rlike(r"^(?:sub)?secret.rio")
    return timeline.agg(F.count("*").alias("atos"), F.count_distinct("nome_normalizado").alias("pessoas"), F.count_if("retorno").alias("retornos"), F.count_if(F.coalesce(secretary, F.lit(False))).alias("atos_secretaria"))


def edition_governor(docs: DataFrame, known: list[str]) -> DataFrame:
    """``path, governador``: who governs by a document's whole text, computed once for each document.

    In this order: a name with the acting phrase; a heading ``Governador`` with the name in its line or the
    next; a known name right behind the title; a signature line above the title; the first known name (a
    parameter list, tested in its order) in a line with the title; the first known name anywhere. Otherwise
    the sentinel.
    """
    word = r"[A-ZÁÉÍÓÚÂÊÔÃÕÇ][\wÀ-ÿ]+"
    name = rf"({word}(?: (?:[Dd][aeo]s? )?{word}){{1,6}})"
    text = F.coalesce("text", F.lit(""))
    found = lambda pattern: F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    # Blanks are taken possessively: a long run of them costs its length, not its square.
    acting = F.coalesce(found(rf"(?mU)^[#\s]*+(?i:governador em exerc[ií]cio)\s*+:?\s*+{name}[^\S\n]*+$"), found(rf"(?U){name}\s*+(?:,\s*+)?(?i:governador em exerc[ií]cio)"))
    heading = found(rf"(?mU)^[^\S\n]*+#*[^\S\n]*+(?:Governador|GOVERNADOR)[^\S\n]*+:?[^\S\n]*+\n?[^\S\n]*+#*[^\S\n]*+{name}[^\S\n]*+$")
    signed = found(rf"(?U){name}(?:\s*+,|[^\S\n]*+\n)\s*+(?i:governador(?: do estado)?)\b(?!\s*+(?i:em exerc))")
    behind, line, anywhere = F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("string")
    for person in reversed(known):
        here = F.lit(person)
        behind = F.when(text.rlike(rf"(?is)(?<!vice-)governador\s.{{0,180}}?\Q{person}\E"), here).otherwise(behind)
        line = F.when(text.rlike(rf"(?i)governador[^\n]*\Q{person}\E|\Q{person}\E[^\n]*governador"), here).otherwise(line)
        anywhere = F.when(F.contains(text, here), here).otherwise(anywhere)
    titled = F.coalesce(heading, behind, signed, line, anywhere)
    return docs.select("path", F.coalesce(F.concat(acting, F.lit(" - Governador em exercicio")), F.concat(titled, F.lit(" - Governador")), F.lit(S.UNKNOWN)).alias("governador"))


def with_governor(acts: DataFrame, editions: DataFrame) -> DataFrame:
    """Acts with the governor columns computed anew from their edition (``path, governador``); city gazettes have none."""
    from actaflow.functions import text as T

    rows = acts.join(editions.select(F.col("path").alias("arquivo_markdown"), F.col("governador").alias("_g")), "arquivo_markdown", "left")
    governor = F.coalesce("_g", "governador_edicao")
    city = F.coalesce(F.col("municipio"), F.lit("")) != ""
    blank = lambda c: F.when(city, "").otherwise(c)
    new = {"governador_edicao": blank(governor), "representante_governo": blank(T.representative(governor)), "origem_representante": blank(T.origin(governor))}
    return rows.select(*[new.get(c, F.col(c)).alias(c) for c in acts.columns])


def pdf_payload(encoded: Column) -> Column:
    """Bytes of a base64 payload from ``%PDF-`` to the last ``%%EOF``; null if there is no such part."""
    raw = F.decode(F.unbase64(encoded), "ISO-8859-1")
    return F.encode(F.nullif(F.regexp_extract(raw, r"(?s)(%PDF-.*%%EOF)", 1), F.lit("")), "ISO-8859-1")


def thousands(n: Column) -> Column:
    return F.translate(F.format_number(n, 0), ",", ".")
