"""Problem 6: map typed values to the closest entry of a reference list.

Prefix-filter set-similarity join. Distinct values and list entries (official name, acronym, former
name) become token sets. What a typed word may stand for (exact, abbreviation, one or two typos, two
words run together) is settled once for each distinct word, by a join of words and list tokens on
deletion keys, beginnings and letter pairs; every pair the rules accept shares a key. Tokens are
ordered by rarity over both sides, only the rare prefix of a set is joined, length and positional
filters drop hopeless pairs, and the Jaccard similarity of the rest is computed exactly; the best
entry is kept. Each value gives several views (without the unit before it, without the address or
agency after it), so a unit of a listed agency maps to the agency. A value that is the cut beginning of
one entry only is that entry: its rarest whole word meets all tokens of entries, and the exact test on
the letters follows.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actaflow.runtime import cut, ship_code

THRESHOLD = 0.5
#: Least similarity of a view that leaves part of the value out.
PART_THRESHOLD = 0.6
#: Entries up to which the index is sent to the workers; a longer list is joined by shuffling.
MAX_LIST = 20_000
#: Least letters of a value that may be the cut beginning of one entry.
LEAST_BEGINNING = 8
#: Words that carry no meaning in names of agencies and roles (fixed values).
STOP = frozenset("DE DO DA DOS DAS E EM NO NA NOS NAS A O AO AOS AS OS PELO PELA JUNTO COM PARA SR SRA EXMO EXMA ILMO DR DRA".split())
_WORDS = re.compile(r"[A-Z0-9]+\.?")


def fold(text: str) -> str:
    """NFKD without combining marks, upper case."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).upper()


def near(a: str, b: str, limit: int) -> bool:
    """Whether the optimal string alignment distance of ``a`` and ``b`` is at most ``limit``."""
    if abs(len(a) - len(b)) > limit:
        return False
    two, one = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            cost = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (x != y))
            if two is not None and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, two[j - 2] + 1)
            row.append(cost)
        if min(row) > limit:
            return False
        two, one = one, row
    return one[-1] <= limit


def subsequence(short: str, long: str) -> bool:
    it = iter(long)
    return all(c in it for c in short)


#: Letters typed by sound and how they are spelled (fixed values).
SOUNDS = (("PH", "F"), ("TH", "T"), ("K", "QU"), ("K", "C"), ("Y", "I"), ("W", "V"))


def spellings(word: str) -> list[str]:
    """``word``, its masculine forms and what letters typed by sound stand for."""
    out = [word]
    if word.endswith("A") and len(word) > 4:
        out += [word[:-1], word[:-1] + "O"]
    for typed, meant in SOUNDS:
        out += [w.replace(typed, meant) for w in out[:3] if typed in w]
    return out


def tokens_of(text: str) -> list[str]:
    return list(dict.fromkeys(t for w in _WORDS.findall(fold(text)) if (t := w.rstrip(".")) not in STOP))


def plain_text(text: str) -> str:
    return " ".join(w.rstrip(".") for w in _WORDS.findall(fold(text)))


# ---------------------------------------------------------------- what a typed word may stand for


def deletions(word: str, n: int) -> set[str]:
    """``word`` and what is left after deleting up to ``n`` letters: words within distance n share one (transpositions too)."""
    out = level = {word}
    for _ in range(n):
        level = {w[:i] + w[i + 1 :] for w in level for i in range(len(w))}
        out = out | level
    return out


def offered_keys(token: str) -> set[str]:
    """Keys of a list token."""
    keys = {f"1{x}" for x in deletions(token, 1)} | {f"p{token[:k]}" for k in range(2, len(token) - 1)} | {f"s{token[0]}{c}" for c in token[1:]}
    if len(token) >= 7:
        keys |= {f"2{x}" for x in deletions(token, 2)}
    return keys | {f"q{x}" for k in range(4, len(token)) for x in deletions(token[:k], 1)}


def probed_keys(word: str) -> set[str]:
    """Keys of a typed word; a list token that ``stands_for`` accepts has one of them."""
    w = word.rstrip(".")
    keys = {f"1{x}" for f in spellings(w) for x in deletions(f, 1)} if len(w) >= 3 else set()
    if len(w) >= 9:
        keys |= {f"2{x}" for x in deletions(w, 2)}
    if len(w) >= 2:
        keys |= {f"p{w}"} | ({f"s{w[:2]}"} if word.endswith(".") and len(w) <= 7 else set())
    return keys | ({f"q{x}" for x in deletions(w, 1)} if len(w) >= 5 else set())


def stands_for(word: str, last: bool, tokens: list[str]) -> list[str]:
    """Tokens among ``tokens`` that an unknown typed word may stand for; ``last``: it ends its value, so it may be cut."""
    w, dotted = word.rstrip("."), word.endswith(".")
    limit = 2 if len(w) >= 9 else 1 if len(w) >= 3 else 0
    typo = [t for t in tokens if limit and any(near(f, t, 1) for f in spellings(w))] or [t for t in tokens if limit > 1 and near(w, t, 2)]
    short: list[str] = []
    if len(w) >= 2 and (dotted or last or len(w) >= 4):
        long = [t for t in tokens if len(t) > len(w) + 1]
        short = [t for t in long if t.startswith(w)]
        if not short and dotted and len(w) <= 7:
            short = [t for t in long if t[0] == w[0] and subsequence(w, t)]
        if not short and len(w) >= 5:
            short = [t for t in long if any(near(w, t[:k], 1) for k in (len(w) - 1, len(w), len(w) + 1))]
    return sorted(typo) if typo and not dotted else sorted({*short, *typo})


def _keyed(keys, column: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(w, k) for w in b[column] for k in keys(w)]
            yield pd.DataFrame(rows, columns=[column, "chave"])

    return run


def _resolved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = [(w, stands_for(w, False, list(t)), stands_for(w, True, list(t))) for w, t in zip(b["palavra"], b["tokens"], strict=True)]
        yield pd.DataFrame(rows, columns=["palavra", "meio", "fim"])


def _forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = [(w, i, f) for w in b["palavra"] for i, f in enumerate(spellings(w.rstrip(".")))]
        yield pd.DataFrame(rows, columns=["palavra", "i", "token"])


def _halves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for word in b["palavra"]:
            w = word.rstrip(".")
            for k in range(3, len(w) - 3) if len(w) >= 8 else ():
                rows += [(word, 10 * k + j, f, tail) for f in spellings(w[:k]) for j, tail in enumerate((w[k:], w[k + 1 :]))]
        yield pd.DataFrame(rows, columns=["palavra", "i", "a", "b"])


def word_readings(words: DataFrame, tokens: DataFrame) -> DataFrame:
    """``palavra, n, meio, fim, partes``: what each typed word (``palavra, n``) stands for inside and at the end of a value.

    ``partes`` are two list tokens run together in the word. ``tokens`` has one row for each list token.
    """
    known = words.mapInPandas(_forms, "palavra string, i int, token string").join(tokens.select("token"), "token").groupBy("palavra").agg(F.min_by("token", "i").alias("t"))
    known = cut(known.select("palavra", F.array("t").alias("meio"), F.array("t").alias("fim")), "known")
    unknown = words.join(known, "palavra", "left_anti").select("palavra")
    probe = unknown.mapInPandas(_keyed(probed_keys, "palavra"), "palavra string, chave string")
    offer = tokens.select("token").mapInPandas(_keyed(offered_keys, "token"), "token string, chave string")
    met = probe.join(offer, "chave").groupBy("palavra").agg(F.collect_set("token").alias("tokens"))
    near_ = cut(met.mapInPandas(_resolved, "palavra string, meio array<string>, fim array<string>"), "near")
    halves = unknown.join(near_.where(F.size("fim") > 0), "palavra", "left_anti").mapInPandas(_halves, "palavra string, i int, a string, b string")
    halves = halves.join(tokens.select(F.col("token").alias("a")), "a").join(tokens.select(F.col("token").alias("b")), "b").groupBy("palavra").agg(F.min_by(F.array("a", "b"), F.struct("i", "a")).alias("partes"))
    none = F.array().cast("array<string>")
    return words.join(known.unionByName(near_), "palavra", "left").join(halves, "palavra", "left").select(
        "palavra", "n", F.coalesce("meio", none).alias("meio"), F.coalesce("fim", none).alias("fim"), F.coalesce("partes", none).alias("partes"))


# ---------------------------------------------------------------- values as token sets

_CUT = re.compile(r",\s+EM\s|\s[-–]\s|/|\(")
_ROLE_CUT = re.compile(r",|\s[-–]\s|/|\(")


def views(value: str, heads: set[str], unit_first: bool) -> list[str]:
    """Readings of a value: whole, before an address or agency, from a word on that begins an agency (``heads``)."""
    text = re.sub(r"\s+", " ", fold(value)).strip()
    out = [text]
    if m := (_CUT if unit_first else _ROLE_CUT).search(text):
        out.append(text[: m.start()])
        out.append(text[m.end() :])
    if unit_first:
        for base in out[:2]:
            for m in re.finditer(r"\b(?:D[AO]S?|N[AO]|DE|PEL[AO]|D[AO]\([AO]\)|JUNTO A|A) (?=([A-Z.]+))", base):
                if m.group(1) in heads:
                    out.append(base[m.end() :])
    else:
        for m in re.finditer(r"\s(?:D[AO]S?|N[AO]|EM EXERCICIO|SUBSTITUT[AO]|INTERIN[AO])\b", text):
            out.append(text[: m.start()])
    return list(dict.fromkeys(v for v in out if v.strip()))


def token_sets(value: str, known: dict[str, dict], unit_first: bool) -> list[tuple[str, list[list[str]], bool]]:
    """For each view its plain text, per typed word the list tokens it may stand for, and whether its last word is one of them."""
    out, seen = [], []
    for v in views(value, {w for w, r in known.items() if r["cabeca"]}, unit_first):
        words = [w for w in _WORDS.findall(v) if w.rstrip(".") not in STOP]
        tokens: list[list[str]] = []
        for i, w in enumerate(words):
            r = known.get(w)
            got = (list(r["fim"]) if i == len(words) - 1 else list(r["meio"])) if r else []
            tokens += [[x] for x in r["partes"]] if r and not got and len(r["partes"]) else [got]
        if tokens and tokens not in seen:
            seen.append(tokens)
            out.append((plain_text(v), tokens, len(words) == 1))
    return out


def prefix_length(n: int, threshold: float) -> int:
    return n - int(-(-n * threshold // 1)) + 1


def _probes(unit_first: bool, threshold: float):
    """Probe rows of every view: the rare prefix of its certain tokens, all readings of uncertain ones, one token for beginnings."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for value, readings in zip(b["valor"], b["leituras"], strict=True):
                known = {r["palavra"]: r for r in readings}
                often = {t: n for r in readings for t, n in zip(r["tokens"], r["ns"], strict=True)}
                for k, (plain, tokens, single) in enumerate(token_sets(value, known, unit_first)):
                    sure = sorted((t[0] for t in tokens if len(t) == 1), key=lambda t: (often[t], t))
                    free = [t for t in tokens if len(t) > 1]
                    n, f, u = len(tokens), len(free), len(sure)
                    need = max(int(-(-n * threshold // 1)) - f, 1)
                    probe = [(i, t) for i, t in enumerate(sure[: max(u - need + 1, 0)])] + [(-1, t) for ts in free for t in ts]
                    if len(plain) >= LEAST_BEGINNING:
                        whole = sorted((t[0] for t in tokens[:-1] if len(t) == 1), key=lambda t: (often[t], t))
                        probe += [(-2, t) for t in (whole[:1] or tokens[-1] if single or whole else [])]
                    rows += [(value, k, plain, n, f, u, tokens, i, t) for i, t in probe]
            yield pd.DataFrame(rows, columns=["valor", "vista", "plano", "n", "f", "u", "tokens", "pos", "token"])

    return run


def _entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"ref_id": b["ref_id"], "tipo": b["tipo"], "texto": [plain_text(x) for x in b["nome"]], "lista": [tokens_of(x) for x in b["nome"]]})


def _words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = [(v, w) for v in b["valor"] for w in dict.fromkeys(_WORDS.findall(fold(v))) if w.rstrip(".") not in STOP]
        yield pd.DataFrame(rows, columns=["valor", "palavra"])


def match_list(values: DataFrame, entries: DataFrame, unit_first: bool, threshold: float = THRESHOLD) -> DataFrame:
    """``valor, ref_id, semelhanca`` for each distinct non-empty ``valor``; 0 where no entry is near.

    ``entries`` has ``ref_id, tipo, nome`` (0 name, 1 acronym, 2 former name). Blank values give no
    row, values without any word map to 0, ties go to the rarer tokens, then to the smaller id.
    """
    spark = values.sparkSession
    ship_code(spark)
    cores = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    listed = entries.where("ref_id is not null and trim(nome) <> ''").select(F.col("ref_id").cast("bigint").alias("ref_id"), F.col("tipo").cast("int").alias("tipo"), "nome")
    listed = cut(listed.mapInPandas(_entries, "ref_id bigint, tipo int, texto string, lista array<string>").where(F.size("lista") > 0), "entries")
    tokens = listed.select(F.posexplode("lista").alias("i", "token"), "tipo").groupBy("token").agg(F.count("*").alias("ln"), F.max((F.col("i") == 0) & (F.col("tipo") != 1)).alias("cabeca"))
    tokens = cut(tokens, "tokens")
    # An explicit number of partitions keeps the costly Python work on all cores.
    distinct = cut(values.where("trim(valor) <> ''").select("valor").distinct().repartition(cores, "valor"), "values")
    held = cut(distinct.mapInPandas(_words, "valor string, palavra string"), "words")
    words = held.groupBy("palavra").agg(F.count("*").alias("n")).repartition(cores, "palavra")
    readings = cut(word_readings(cut(words, "typed"), tokens), "readings")
    typed = readings.where(F.size("meio") == 1).groupBy(F.col("meio")[0].alias("token")).agg(F.sum("n").alias("tn"))
    often = cut(tokens.join(typed, "token", "left").select("token", "cabeca", (F.col("ln") + F.coalesce("tn", F.lit(0))).alias("tn")), "rarity")
    used = readings.select("palavra", F.explode(F.array_distinct(F.concat("meio", "fim", "partes"))).alias("token"), "meio").join(often, "token").groupBy("palavra").agg(
        F.collect_list("token").alias("tokens"), F.collect_list("tn").alias("ns"), F.max(F.col("cabeca") & F.array_contains("meio", F.col("token"))).alias("cabeca"))
    readings = cut(readings.join(used, "palavra").select("palavra", "meio", "fim", "partes", "tokens", "ns", "cabeca"), "readings")
    sets = held.join(readings, "palavra").groupBy("valor").agg(F.collect_list(F.struct(*readings.columns)).alias("leituras")).repartition(cores, "valor")
    probes = sets.mapInPandas(_probes(unit_first, threshold), "valor string, vista int, plano string, n int, f int, u int, tokens array<array<string>>, pos int, token string")
    order = listed.select("ref_id", "tipo", "texto", F.explode("lista").alias("token")).join(often, "token").groupBy("ref_id", "tipo", "texto").agg(F.array_sort(F.collect_list(F.struct("tn", "token"))).alias("o"))
    index = order.select("ref_id", "tipo", "texto", F.size("o").alias("m"), F.col("o.token").alias("lista"), F.col("o")[0]["tn"].alias("raro"), F.posexplode("o.token").alias("apos", "token"))
    index = cut(index, "index")
    index = F.broadcast(index) if listed.count() <= MAX_LIST else index
    pairs = probes.join(index, "token")
    in_prefix = F.col("apos") < F.col("m") - F.ceil(F.col("m") * threshold) + 1
    length = (F.col("n") >= threshold * F.col("m")) & (F.col("m") >= threshold * F.col("n"))
    room = F.lit(1) + F.least(F.col("u") - F.col("pos") - 1, F.col("m") - F.col("apos") - 1) + F.least("pos", "apos") + F.col("f")
    position = (F.col("pos") == -1) | (room >= threshold / (1 + threshold) * (F.col("n") + F.col("m")))
    begins = (F.col("pos") == -2) & F.startswith("texto", F.col("plano")) & (F.col("texto") != F.col("plano"))
    pairs = pairs.withColumn("inicio", begins).where(F.col("inicio") | ((F.col("pos") >= -1) & in_prefix & length & position))
    shared = F.size(F.filter("lista", lambda a: F.exists("tokens", lambda t: F.array_contains(t, a))))
    used_ = F.size(F.filter("tokens", lambda t: F.arrays_overlap(t, F.col("lista"))))
    common = F.least(shared, used_)
    pairs = pairs.withColumn("s", common / (F.col("n") + F.col("m") - common))
    pairs = pairs.where(F.col("inicio") | (F.col("s") >= F.when(F.col("vista") > 0, F.lit(max(threshold, PART_THRESHOLD))).otherwise(threshold)))
    entry = pairs.groupBy("valor", "vista", "ref_id", "m", "raro").agg(F.max("s").alias("s"), F.max("inicio").alias("inicio"))
    one = entry.where("inicio").groupBy("valor", "vista").agg(F.count_distinct("ref_id").alias("refs"))
    entry = entry.join(one, ["valor", "vista"], "left").withColumn("s", F.when(F.col("inicio") & (F.col("refs") == 1), 1.0).otherwise(F.col("s")))
    entry = entry.where(F.col("s") >= F.when(F.col("vista") > 0, F.lit(max(threshold, PART_THRESHOLD))).otherwise(threshold))
    rank = F.struct(F.round("s", 9), "m", -F.col("vista"), -F.col("raro"), -F.col("ref_id"))
    best = entry.groupBy("valor").agg(F.max_by("ref_id", rank).alias("ref_id"), F.max("s").alias("semelhanca"))
    return distinct.join(best, "valor", "left").select(
        "valor", F.coalesce("ref_id", F.lit(0)).cast("bigint").alias("ref_id"), F.coalesce("semelhanca", F.lit(0.0)).alias("semelhanca"))


def agency_entries(ref: DataFrame) -> DataFrame:
    return ref.selectExpr("orgao_id AS ref_id", "stack(3, 0, nome_oficial, 1, sigla, 2, nome_anterior) AS (tipo, nome)").where("nome is not null")


def role_entries(ref: DataFrame) -> DataFrame:
    return ref.selectExpr("cargo_id AS ref_id", "0 AS tipo", "cargo_oficial AS nome")


def mapped_values(acts: DataFrame, agencies: DataFrame, roles: DataFrame) -> DataFrame:
    """``linha_csv, campo, ref_id`` for each non-empty value that isn't verbatim an official name."""
    parts = []
    for field, entries, unit_first in (("orgao", agency_entries(agencies), True), ("cargo_assinante", role_entries(roles), False)):
        typed = acts.select("linha_csv", F.col(field).alias("valor")).where("valor is not null and trim(valor) <> ''")
        official = entries.where("tipo = 0").select(F.col("nome").alias("valor")).distinct()
        typed = typed.join(F.broadcast(official) if entries.count() <= MAX_LIST else official, "valor", "left_anti")
        found = match_list(typed, entries, unit_first)
        parts.append(typed.join(found, "valor").select("linha_csv", F.lit(field).alias("campo"), "ref_id"))
    return parts[0].unionByName(parts[1])
