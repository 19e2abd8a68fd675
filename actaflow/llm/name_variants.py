"""Problem 4: spellings of one person or organisation.

Noisy-channel attribution. The words of all spellings give a prior; a rare word one typo away from a
much more frequent one is read as that one. Spellings with the same words (in any order, particles
aside) are one form. Frequent full forms are candidates for the rest: a form with initials,
abbreviations, nicknames or a dropped middle name is attached to the candidate with the largest
posterior, prior (how often the candidate was written) times channel (how likely each word was
written that way). Candidates meet forms through keys that every pair the channel accepts shares.
Suffixes (Filho, Júnior, Neto) and differing given names keep relatives apart.
"""

from __future__ import annotations

import itertools
import math
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actaflow.llm.canonical_list import near
from actaflow.llm.encoding_repair import restored
from actaflow.runtime import cut, ship_code, spread
from actaflow.schemas import ADMINISTRATIVE_TERMS

PARTICLES = ("DE", "DA", "DO", "DAS", "DOS", "E")
SUFFIXES = ("FILHO", "FILHA", "JUNIOR", "NETO", "NETA", "SOBRINHO", "SEGUNDO")
#: Function words that no name holds (fixed values); a value with one of them, or with a particle at its start or end, is a phrase.
NO_NAME = ("PARA", "CONFORME", "SOB", "SE", "NO", "NA", "NOS", "NAS", "OS", "AS", "POR", "AO", "AOS", "QUE", "SEM", "ATE", "CONTAR", "II", "III", "IV")
#: Brazilian nicknames and the given names they stand for (fixed values).
NICKNAMES = {
    "BASTIAO": ("SEBASTIAO",), "BEBEL": ("ISABEL",), "BEL": ("ISABEL",), "BETO": ("ROBERTO", "ALBERTO", "GILBERTO"), "BIA": ("BEATRIZ",), "CEICA": ("CONCEICAO",), "CHIQUINHA": ("FRANCISCA",), "CHIQUINHO": ("FRANCISCO",), "CHICA": ("FRANCISCA",), "CHICO": ("FRANCISCO",),
    "CIDA": ("APARECIDA",), "DUDA": ("EDUARDO", "EDUARDA"), "EDU": ("EDUARDO",), "FAFA": ("FATIMA",), "FATINHA": ("FATIMA",), "KIKO": ("HENRIQUE", "FRANCISCO"), "GABI": ("GABRIELA",), "GUGA": ("GUSTAVO",),
    "GUIDA": ("MARGARIDA",), "GUSTINHO": ("GUSTAVO",), "ISA": ("ISABEL",), "JUCA": ("JOSE", "JOAQUIM"), "LALA": ("LARISSA",), "LENA": ("HELENA", "MADALENA"),
    "LENINHA": ("HELENA",), "LEO": ("LEANDRO", "LEONARDO"), "LILA": ("LIVIA", "LETICIA"), "LU": ("LUCIA", "LUIS"), "LULA": ("LUIS",), "MAGO": ("WAGNER",),
    "LUISINHO": ("LUIS",), "MUNDINHO": ("RAIMUNDO",), "MUNDICO": ("RAIMUNDO",), "TONINHO": ("ANTONIO",), "ZEZINHO": ("JOSE",), "MANECO": ("MANUEL",), "MARIQUINHA": ("MARIA",), "MAZE": ("MARIA",), "NANDA": ("FERNANDA",), "NANDO": ("FERNANDO",), "NATI": ("NATALIA",),
    "NECO": ("MANUEL",), "PATY": ("PATRICIA",), "PATI": ("PATRICIA",), "QUIM": ("JOAQUIM",), "RO": ("ROSANGELA", "ROBERTO"), "ROSINHA": ("ROSANGELA", "ROSA"),
    "SUZI": ("SUZANA",), "TATA": ("TATIANA",), "TECA": ("TEREZA",), "TEREZINHA": ("TEREZA",), "TETE": ("TEREZA",), "TIAO": ("SEBASTIAO",), "TICO": ("ANTONIO",),
    "TINA": ("CRISTINA",), "TITO": ("ANTONIO",), "TONHO": ("ANTONIO",), "TONICO": ("ANTONIO",), "VAVA": ("VALDIR",), "VERA": ("VERONICA",), "XICO": ("FRANCISCO",),
    "ZE": ("JOSE",), "ZECA": ("JOSE",), "ZEZE": ("JOSE", "MARIA"), "ZITO": ("JOSE",),
}
#: A word one edit away from another is its typo if the other is held by so many times more names (names as sets of words).
TYPO_ODDS = 10.0


def meeting(a: DataFrame, b: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join of which neither side is sent to the driver to be broadcast.

    Spark sizes a side by its compressed file, of which these keys and words take many times the space in memory.
    """
    return a.join(b.hint("merge"), on, how)


def spelling(text: str) -> str:
    """NFKD, combining marks dropped, upper case, runs of non-letters as one blank, trimmed."""
    folded = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).upper()
    return "".join(c if c.isalpha() else " " for c in folded).strip() if folded.isalpha() else re.sub(r"[\W\d_]+", " ", folded).strip()


def _spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"campo": b["campo"], "grafia": [spelling(v) for v in b["valor"]], "n": b["n"]})


def spellings(acts: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """``campo, grafia, n`` for each distinct spelling that may be a name and isn't garbled."""
    pairs = ", ".join(f"'{f}', `{f}`" for f in fields)
    values = acts.selectExpr(f"stack({len(fields)}, {pairs}) AS (campo, valor)").where("trim(valor) <> ''").groupBy("campo", "valor").agg(F.count("*").alias("n"))
    values = cut(values, "values")
    garbled = restored(values.select("valor").distinct().select(F.lit(0).alias("id"), F.lit("nome").alias("campo"), "valor"))
    values = meeting(values, garbled.select("valor"), "valor", "left_anti")
    rows = values.mapInPandas(_spell, "campo string, grafia string, n bigint").groupBy("campo", "grafia").agg(F.sum("n").alias("n"))
    words = F.split("grafia", " ")
    end = F.array(*[F.lit(w) for w in PARTICLES])
    phrase = F.arrays_overlap(words, F.array(*[F.lit(w) for w in NO_NAME])) | (F.array_contains(end, F.element_at(words, -1)) & (F.element_at(words, -1) != "E")) | (F.array_contains(end, words[0]) & (words[0] != "E"))
    phrase = phrase | ((words[0] == "COM") & ~F.coalesce(F.array_contains(end, F.get(words, F.lit(1))), F.lit(False)))  # before a particle it stands for a commission
    phrase = phrase | ((F.col("campo") == "nome") & F.arrays_overlap(words, F.array(*[F.lit(w) for w in ADMINISTRATIVE_TERMS])))
    return rows.where((F.col("grafia") != "") & ~phrase)


def plain_words(column: Column) -> Column:
    """Words of a spelling without particles; ``E`` at either end is an initial."""
    words = F.split(column, " ")
    return F.filter(words, lambda w, i: ~w.isin(*PARTICLES) | ((w == "E") & ((i == 0) | (i == F.size(words) - 1))))


def word_readings(rows: DataFrame) -> DataFrame:
    """``palavra, lida, tipos, duvida``: each word and the more frequent word it is most likely a typo of.

    A word that may be a typo of several others stays as it is (``duvida``): the rest of the name decides
    later. The frequency of a word is the number of names, as sets of words over all fields, that hold it. Words
    one edit apart meet through the strings left when one letter is deleted.
    """
    names = rows.select(F.array_sort(F.array_distinct(plain_words(F.col("grafia")))).alias("nome")).distinct()
    words = cut(names.select(F.explode("nome").alias("w")).groupBy("w").agg(F.count("*").alias("tipos")), "words")
    deletes = F.concat(F.array("w"), F.transform(F.sequence(F.lit(1), F.length("w")), lambda i: F.concat(F.expr("w").substr(F.lit(1), i - 1), F.expr("w").substr(i + 1, F.length("w")))))
    keyed = words.where(F.length("w") >= 3).select("w", "tipos", F.explode(F.array_distinct(deletes)).alias("key"))
    pairs = meeting(keyed.alias("r"), keyed.alias("o"), "key").where(F.col("o.tipos") > 2 * F.col("r.tipos"))
    distance = F.levenshtein("r.w", "o.w")
    swapped = (distance == 2) & (F.array_sort(F.split("r.w", "")) == F.array_sort(F.split("o.w", "")))
    pairs = pairs.where((distance == 1) | swapped).where(~F.col("r.w").isin(*NICKNAMES, *PARTICLES, *SUFFIXES))
    best = pairs.groupBy(F.col("r.w").alias("w")).agg(F.max_by(F.col("o.w"), F.struct(F.col("o.tipos"), F.col("o.w"))).alias("lida"), F.sort_array(F.collect_list(F.struct("o.tipos", "o.w")), asc=False).alias("p"))
    first, others = F.col("p")[0]["tipos"], F.filter("p", lambda x: (x["w"] != F.col("lida")) & (2 * TYPO_ODDS * x["tipos"] >= F.col("p")[0]["tipos"]))  # words have few neighbours
    best = best.select("w", "lida", first.alias("mais"), (F.size(others) + 1).alias("k"))
    typo = F.coalesce(F.col("mais") > TYPO_ODDS * F.col("tipos"), F.lit(False))
    return meeting(words, best, "w", "left").select(F.col("w").alias("palavra"), F.when(typo & (F.col("k") == 1), F.col("lida")).otherwise(F.col("w")).alias("lida"), "tipos", (typo & (F.col("k") > 1)).alias("duvida"))


def _splits(readings: DataFrame) -> DataFrame:
    """Rare long words that are two frequent words run together."""
    often = readings.where((F.length("palavra") >= 3) & (F.col("palavra") == F.col("lida")) & ~F.col("palavra").isin(*SUFFIXES)).select("palavra", "tipos")
    long = readings.where((F.length("palavra") >= 8) & (F.col("palavra") == F.col("lida")))
    cuts = long.select("palavra", "tipos", F.explode(F.sequence(F.lit(3), F.length("palavra") - 3)).alias("k")).select(
        "palavra", "tipos", F.expr("substring(palavra, 1, k)").alias("a"), F.expr("substring(palavra, k + 1)").alias("b"))
    left = often.select(F.col("palavra").alias("a"), F.col("tipos").alias("ta"))
    right = often.select(F.col("palavra").alias("b"), F.col("tipos").alias("tb"))
    found = meeting(meeting(cuts, left, "a"), right, "b").where(F.least("ta", "tb") > TYPO_ODDS / 2 * F.col("tipos"))
    return found.groupBy("palavra").agg(F.max_by(F.array("a", "b"), F.least("ta", "tb")).alias("partes"))


def forms(rows: DataFrame) -> DataFrame:
    """``campo, grafia, n, forma`` (sorted words as read, particles aside) and ``ordem`` (as written)."""
    readings = cut(word_readings(rows), "readings")
    table = meeting(readings, _splits(readings), "palavra", "left").select("palavra", F.coalesce("partes", F.array("lida")).alias("partes"), "duvida")
    placed = rows.select("campo", "grafia", "n", F.posexplode(plain_words(F.col("grafia"))).alias("i", "palavra"))
    read = meeting(placed, table, "palavra").groupBy("campo", "grafia", "n").agg(F.array_sort(F.collect_list(F.struct("i", "partes"))).alias("p"), F.max("duvida").alias("duvida"))
    words = F.flatten(F.transform("p", lambda x: x["partes"]))
    return read.select("campo", "grafia", "n", words.alias("ordem"), F.concat_ws(" ", F.array_sort(words)).alias("forma"), "duvida")


def channel(form: list[str], full: list[str]) -> float | None:
    """Log likelihood that the words of ``full`` were written as ``form``; None if they can't be.

    Words match by equality, initial, abbreviation, nickname or typo. ``full`` may have one more
    middle word. Suffixes must be the same; the first given name is never dropped.
    """
    tail = [w for w in form if w in SUFFIXES]
    if tail != [w for w in full if w in SUFFIXES]:
        return None
    form, full = [w for w in form if w not in SUFFIXES], [w for w in full if w not in SUFFIXES]
    spread: list[str] = []
    for w in form:  # two or three capitals in a row are initials
        spread += list(w) if 2 <= len(w) <= 3 and w not in full and not set(w) & set("AEIOUY") else [w]
    form = spread
    left = list(full)
    score, rest = 0.0, []
    for w in form:
        if w in left:
            left.remove(w)
        else:
            rest.append(w)
    if len(form) - len(rest) < 1:
        return None
    odd = 0
    for w in rest:
        options = []
        for t in left:
            if len(w) == 1 and t.startswith(w):
                options.append((math.log(0.08), t))
            elif t in NICKNAMES.get(w, ()):
                options.append((math.log(0.05), t))
            elif len(w) >= 3 and len(t) >= len(w) + 2 and t.startswith(w):
                options.append((math.log(0.03), t))
            elif len(w) >= 5 and w.endswith(("INHO", "INHA")) and t.startswith(w[:-4][:3]) and len(w) > 6:
                options.append((math.log(0.02), t))
            elif len(w) >= 4 and len(t) >= 4 and near(w, t, 1):
                options.append((math.log(0.01), t))
                odd += 1
        if not options:
            return None
        best = max(options, key=lambda x: (x[0], -left.index(x[1])))
        left.remove(best[1])
        score += best[0]
    if len(left) > 1 or odd > 1 or (left and (full[0] in left or full[-1] in left or len(form) < 2)):
        return None
    if left:
        score += math.log(0.04)
    return score


def _slips(word: str) -> list[str]:
    """Strings that a word shares with any that is one slip away, if the slip changes its first three letters."""
    return [f"t{word[2:]}", f"t{word[3:]}", f"s{''.join(sorted(word[:4]))}{word[4:]}"] if len(word) >= 4 else []


def _begin(words: list[str], letters: int) -> str:
    return " ".join(sorted(w[:letters] for w in words))


def probe_keys(form: list[str]) -> set[str]:
    """Keys of a form; a candidate that ``channel`` accepts has one of them among its ``offer_keys``.

    All that ``channel`` lets a word stand for begins with its first three letters, or with its one
    letter, except nicknames, which are replaced, and slips in these letters, which leave the rest.
    """
    tail = "/" + " ".join(w for w in form if w in SUFFIXES)
    options = [[[w]] + [[t] for t in NICKNAMES.get(w, ())] + ([list(w)] if 2 <= len(w) <= 3 and not set(w) & set("AEIOUY") else []) for w in form if w not in SUFFIXES]
    keys = set()
    for choice in itertools.product(*options):
        words = [w for part in choice for w in part]
        short = any(len(w) == 1 for w in words)
        if not short:
            keys.add(f"3|{_begin(words, 3)}{tail}")
        for i, w in enumerate(words):
            rest = words[:i] + words[i + 1 :]
            if short:
                keys.add(f"1|{w}|{_begin(rest, 1)}{tail}")
            keys.update(f"{1 if short else 3}|{x}|{_begin(rest, 1 if short else 3)}{tail}" for x in map("~".__add__, _slips(w)))
    return keys


def offer_keys(full: list[str]) -> set[str]:
    """Keys of a candidate, with all its words and without each middle word."""
    tail = "/" + " ".join(w for w in full if w in SUFFIXES)
    full = [w for w in full if w not in SUFFIXES]
    keys = set()
    for words in [full, *(full[:i] + full[i + 1 :] for i in range(1, len(full) - 1))]:
        keys.add(f"3|{_begin(words, 3)}{tail}")
        for i, w in enumerate(words):
            rest = words[:i] + words[i + 1 :]
            keys.add(f"1|{w}|{_begin(rest, 1)}{tail}")
            keys.update(f"{n}|~{x}|{_begin(rest, n)}{tail}" for x in _slips(w) for n in (1, 3))
    return keys


def _keys(of, name: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["chave"] = [list(of(list(w))) for w in b["ordem"]]
            out = b[["campo", "forma", "n", "letras", "palavras", "duvida", "chave"]].explode("chave").dropna()
            yield out.rename(columns={"forma": name})

    return run


def _score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        got = [channel(list(f), list(c)) for f, c in zip(b["ordem"], b["c_ordem"], strict=True)]
        b["posterior"] = [None if s is None else s + math.log(n) for s, n in zip(got, b["c_n"], strict=True)]
        yield b.loc[b["posterior"].notna(), ["campo", "forma", "c_forma", "posterior"]]


def roots(link: DataFrame) -> DataFrame:
    """``campo, forma, raiz``: the end of each form's chain of parents (``campo, forma, pai, n``).

    Forms that are each other's parents, directly or in a ring, share their most frequent one. Steps
    are doubled until every chain has ended and no ring is longer than the step.
    """
    own = F.col("pai") == F.col("forma")
    link = cut(link.select("campo", "forma", F.col("pai").alias("salto"), own.alias("fim"), F.struct("n", "forma").alias("melhor")), "chains")
    ends = link.select("campo", "forma", F.col("fim").alias("_fim"))
    step, before = 1, -1
    while True:
        open_ends = meeting(link.select("campo", F.col("salto").alias("forma")).distinct(), ends.where("not _fim"), ["campo", "forma"]).count()
        if not open_ends or (open_ends == before and step >= open_ends):
            break
        before, step = open_ends, step * 2
        up = link.select("campo", F.col("forma").alias("salto"), F.col("salto").alias("_salto"), F.col("melhor").alias("_melhor"))
        link = cut(meeting(link, up, ["campo", "salto"]).select("campo", "forma", F.col("_salto").alias("salto"), F.greatest("melhor", "_melhor").alias("melhor")), "chains")
    landed = meeting(link.select("campo", F.col("forma").alias("salto"), F.col("melhor.forma").alias("_ring")), ends.withColumnRenamed("forma", "salto"), ["campo", "salto"])
    return meeting(link, landed, ["campo", "salto"]).select("campo", "forma", F.when(F.col("_fim"), F.col("salto")).otherwise(F.col("_ring")).alias("raiz"))


def entities(acts: DataFrame, fields: tuple[str, ...] = ("nome", "assinante")) -> DataFrame:
    """``campo, grafia, n, entidade`` for each spelling; ``entidade`` is the canonical form's words.

    Null, blank, garbled values and phrases that are no names are left out. Ties go to the more
    frequent, then the alphabetically larger candidate. An empty table gives no rows.
    """
    ship_code(acts.sparkSession)
    rows = cut(spellings(acts, fields), "spellings")
    written = cut(forms(rows), "forms")
    form = written.groupBy("campo", "forma").agg(F.sum("n").alias("n"), F.max_by("ordem", F.struct("n", "grafia")).alias("ordem"), F.max("duvida").alias("duvida"))
    form = cut(form, "form")
    sized = spread(form.withColumn("letras", F.length(F.concat_ws("", "ordem"))).withColumn("palavras", F.size("ordem")))
    kept = "n bigint, letras int, palavras int, duvida boolean, chave string"
    probe = sized.mapInPandas(_keys(probe_keys, "forma"), f"campo string, forma string, {kept}").withColumn("chave", F.xxhash64("campo", "chave"))
    offer = sized.mapInPandas(_keys(offer_keys, "c_forma"), f"campo string, c_forma string, {kept}").withColumn("chave", F.xxhash64("campo", "chave"))
    offer = offer.select("campo", "c_forma", "chave", F.col("n").alias("c_n"), F.col("letras").alias("c_letras"), F.col("palavras").alias("c_palavras"), F.col("duvida").alias("c_duvida"))
    meet = meeting(probe, offer, ["campo", "chave"]).where("forma <> c_forma")
    # A form attaches only to one with more letters, or to a more frequent or less doubtful one with as many.
    better = (F.col("c_n") > 2 * F.col("n")) | (F.col("duvida") & ~F.col("c_duvida"))
    ahead = (F.col("c_letras") > F.col("letras")) | ((F.col("c_letras") >= F.col("letras") - 1) & better & (F.col("c_palavras") == F.col("palavras")))
    meet = meet.where(ahead & (F.col("c_palavras") >= F.col("palavras") - 1)).select("campo", "forma", "c_forma", "c_n").distinct()
    meet = meeting(meeting(meet, form.select("campo", "forma", "ordem"), ["campo", "forma"]), form.select("campo", F.col("forma").alias("c_forma"), F.col("ordem").alias("c_ordem")), ["campo", "c_forma"])
    scored = meet.select("campo", "forma", "ordem", "c_forma", "c_ordem", "c_n").mapInPandas(_score, "campo string, forma string, c_forma string, posterior double")
    best = scored.groupBy("campo", "forma").agg(F.max_by("c_forma", F.struct("posterior", "c_forma")).alias("pai"))
    link = cut(meeting(form.select("campo", "forma"), best, ["campo", "forma"], "left").withColumn("pai", F.coalesce("pai", "forma")), "links")
    return meeting(written, roots(meeting(link, form.select("campo", "forma", "n"), ["campo", "forma"])), ["campo", "forma"]).select("campo", "grafia", "n", F.col("raiz").alias("entidade"))


def variant_pairs(acts: DataFrame) -> DataFrame:
    """``campo, grafia_a, grafia_b``: all pairs of different spellings of one entity."""
    linked = cut(entities(acts), "entities")
    a = linked.select("campo", "entidade", F.col("grafia").alias("grafia_a"))
    b = linked.select("campo", "entidade", F.col("grafia").alias("grafia_b"))
    return meeting(a, b, ["campo", "entidade"]).where("grafia_a < grafia_b").select("campo", "grafia_a", "grafia_b")
