"""Problem 5: values cut off before their real end.

A backward character n-gram model per column: for the last 4, 5, 6 ... 20 characters of a value, how often
they end values against how often text goes on after them anywhere in the column, the value itself left
out. The counts are interpolated from short contexts to long ones (a long context seen seldom leans on
the shorter), which gives the log-odds that a value ends there. A value is cut if they are below the
threshold of its column, language and kind of ending (sentence mark or not), or, in columns of names,
if the end lies inside a word: where it goes on, it nearly always goes on with a letter. That test
doesn't depend on how often a value is cut at the same place, the log-odds do.

Thresholds are fitted: they lie in the emptiest stretch of the real log-odds (cut and complete values
are two heaps). The places inside all values where a cut could be taken for a complete end, because
other values end with the same characters, decide between stretches that are alike. Nothing is sampled.

Training covers every character of every value. The contexts that matter are kept in a table sized by
their number; beyond ``MOST_CONTEXTS`` they are counted in several passes. Contexts, not texts, are
shuffled.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actaflow.runtime import cut, ship_code, spread

TAIL = 20
#: Context lengths.
ORDERS = (4, 5, 6, 9, 14, 20)
#: A context seen so often has as much weight as what shorter ones say.
SMOOTHING = 15.0
#: Width of the bins of log-odds, of the stretch around a threshold, and what missing a cut at every place costs against a real end in the stretch.
BIN, STRETCH, MISSED = 0.25, 2, 0.001
LOWEST, HIGHEST = -9.0, 0.0
#: Largest share of a group's values that can be cuts: above it the left heap is another kind of complete end.
MOST_CUT = 0.3
#: Values of a language that have as much weight for its thresholds as those of all languages.
POOLED = 5000
#: An end lies inside a word if this share of its continuations start with a letter, and there are so many of them ...
IN_WORD, LEAST_LETTERS = 0.95, 5
#: ... and more than this many for each end: fewer are slips of the pen after a complete value.
SLIPS = 0.1
#: Columns of names whose ends are tested so; the last word of an excerpt, often a signer's title, stands rarely elsewhere.
PHRASES = ("orgao",)
#: Contexts whose table is held at once (about 30 bytes each: 128 MB), and texts hashed at a time.
MOST_CONTEXTS = 1 << 22
CHUNK, SEGMENT = 250, 1 << 20
_BASE = 1_000_003
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Function words that tell languages apart (fixed values).
LANGUAGES = {"pt": "da|do|das|dos|em|não|com|ou|ao|aos|na|no|nas|nos|um|uma|pela|pelo|são|à", "es": "el|los|las|del|y|en|con|una|por|al", "en": "the|of|and|to|in|for|by|on"}


def normal(texts: pa.Array) -> pa.Array:
    """One case, digits as 9, single blanks, without stray marks, outer quotes and a final ellipsis."""
    t = pc.replace_substring_regex(pc.utf8_lower(texts), "[0-8]", "9")
    t = pc.replace_substring_regex(t, r"[\s\x{a0}]+", " ")
    for _ in range(2):  # the blank between two stray marks belongs to both
        t = pc.replace_substring_regex(t, r" (?:[*'~_|·]|\.·|°\.)( |$)", r"\1")
    t = pc.utf8_trim(t, " \"'“…")
    return pc.if_else(pc.ends_with(t, "..."), pc.utf8_rtrim(t, " ."), t)


def language(texts: pa.Array) -> np.ndarray:
    """The language most function words are of; ``und`` without any."""
    padded = pc.replace_substring(pc.binary_join_element_wise("", texts, "", " "), " ", "  ")
    n = np.stack([np.asarray(pc.count_substring_regex(padded, rf" (?:{w})[ ,.;:]")) for w in LANGUAGES.values()])
    return np.where(n.max(axis=0) > 0, np.array(list(LANGUAGES))[n.argmax(axis=0)], "und")


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.append(np.uint64(1), np.full(n, _BASE, np.uint64)))
        return up, np.cumprod(np.append(np.uint64(1), np.full(n, inverse, np.uint64)))


def window_hashes(points: np.ndarray, ends: np.ndarray, order: int, sums: np.ndarray, down: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the ``order`` characters before each end, from running sums."""
    return (sums[ends] - sums[ends - order]) * down[ends - order]


def running_sums(points: np.ndarray, up: np.ndarray) -> np.ndarray:
    return np.append(np.uint64(0), np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[: len(points)]))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def _ends(fields: tuple[str, ...]):
    """``linha_csv, campo, fim, lingua`` for each non-blank value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, field in enumerate(fields, 1):
                texts = b.column(k)
                kept = pc.greater(pc.utf8_length(pc.utf8_trim_whitespace(texts)), 0)
                texts, ids = texts.filter(kept), b.column(0).filter(kept)
                tail = pc.utf8_slice_codeunits(texts, start=-100)
                end = pc.utf8_slice_codeunits(normal(tail), start=-TAIL)
                yield pa.RecordBatch.from_arrays([ids, pa.array([field] * len(ids), pa.string()), end, pa.array(language(pc.utf8_lower(tail)), pa.string())], ["linha_csv", "campo", "fim", "lingua"])

    return run


def _suffix_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    up, down = _powers(TAIL + 1)
    for b in batches:
        out = []
        for field, tail, n in zip(b["campo"], b["fim"], b["n"], strict=True):
            points = _points(tail)
            sums = running_sums(points, up)
            for order in ORDERS:
                if len(tail) >= order:
                    with np.errstate(over="ignore"):
                        h = window_hashes(points, np.array([len(points)]), order, sums, down)
                    out.append((field, tail, order, int(h.view(np.int64)[0]), n))
        yield pd.DataFrame(out, columns=["campo", "fim", "ordem", "hash", "n"])


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


class Contexts:
    """Wanted hashes of one order with an open-addressing table: one look finds nearly all, a few more the rest."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes)
        self.shift = np.uint64(64 - max(10, (4 * len(hashes)).bit_length()))
        self.table = np.full(1 << int(64 - self.shift), -1, np.int32)
        left, self.looks = np.arange(len(self.hashes), dtype=np.int32), 0
        while len(left):
            place = self._place(self.hashes[left], self.looks)
            free = left[self.table[place] < 0]
            self.table[self._place(self.hashes[free], self.looks)] = free  # the last of those that meet stays
            left = left[self.table[place] != left]
            self.looks += 1

    def _place(self, h: np.ndarray, look: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((h + np.uint64(look)) * _MIX >> self.shift).astype(np.int64)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``h`` are wanted, and their numbers."""
        if not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, number, left = [], [], np.arange(len(h))
        for look in range(self.looks):
            k = self.table[self._place(h[left], look)]
            hit = self.hashes[k] == h[left]  # an empty place compares with the last hash, which is right or fails
            at.append(left[hit])
            number.append(np.where(k[hit] < 0, len(self.hashes) - 1, k[hit]))
            left = left[~hit & (k >= 0)]
            if not len(left):
                break
        return np.concatenate(at), np.concatenate(number)


def _counts(fields: tuple[str, ...], wanted: dict[tuple[str, int], np.ndarray]):
    """``c, ordem, hash, total, letras`` of the ``wanted`` contexts: how often seen, how often before a letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up, down = _powers(SEGMENT + 64)
        known = {k: Contexts(v) for k, v in wanted.items()}
        letters = _letters()
        total = {k: np.zeros(len(v.hashes), np.int64) for k, v in known.items()}
        before = {k: np.zeros(len(v.hashes), np.int64) for k, v in known.items()}
        for b in batches:
            for c, field in enumerate(fields):
                texts = normal(b.column(c).filter(pc.greater(pc.utf8_length(b.column(c)), 0))).to_pylist()
                for k in range(0, len(texts), CHUNK):
                    whole = _points("\0".join(texts[k : k + CHUNK]))
                    for at in range(0, len(whole), SEGMENT):
                        low = max(0, at - TAIL)
                        points = whole[low : at + SEGMENT]
                        follows = np.append(letters[whole[low + 1 : at + SEGMENT + 1]], np.zeros(int(at + SEGMENT >= len(whole)), bool))
                        with np.errstate(over="ignore"):
                            sums = running_sums(points, up)
                            ends = np.arange(max(at - low, ORDERS[0] - 1) + 1, len(points) + 1)
                            for order in ORDERS:
                                ends = ends[ends >= order]
                                if (field, order) not in known or not len(ends):
                                    break
                                hit, number = known[field, order].find(window_hashes(points, ends, order, sums, down))
                                ends = ends[hit]
                                total[field, order] += np.bincount(number, minlength=len(total[field, order]))
                                before[field, order] += np.bincount(number[follows[ends - 1]], minlength=len(total[field, order]))
        for (field, order), n in total.items():
            seen = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), x)) for x in (fields.index(field), order)] + [
                pa.array(x) for x in (known[field, order].hashes[seen].view(np.int64), n[seen], before[field, order][seen])], ["c", "ordem", "hash", "total", "letras"])

    return run


def contexts(acts: DataFrame, fields: tuple[str, ...], suffixes: DataFrame) -> DataFrame:
    """``campo, ordem, hash, total, letras`` for the contexts of ``suffixes``, counted in all values."""
    distinct = cut(suffixes.select("campo", "ordem", "hash").distinct(), "contexts")
    passes = -(-distinct.count() // MOST_CONTEXTS)
    texts = spread(acts.select(*[F.coalesce(F.col(f), F.lit("")).alias(f) for f in fields]))
    seen = None
    for p in range(passes):
        # A pass takes the ends whose shortest context falls to it, with all their longer ones, so that each order is sought among the hits of the one before.
        own = distinct
        if passes > 1:
            first = suffixes.where((F.col("ordem") == ORDERS[0]) & (F.pmod("hash", F.lit(passes)) == p)).select("campo", "fim").distinct()
            own = suffixes.join(first, ["campo", "fim"], "left_semi").select("campo", "ordem", "hash").distinct()
        rows = own.toPandas()  # about MOST_CONTEXTS
        wanted = {(f, int(o)): g["hash"].to_numpy().view(np.uint64) for (f, o), g in rows.groupby(["campo", "ordem"])}
        part = texts.mapInArrow(_counts(fields, wanted), "c bigint, ordem bigint, hash bigint, total bigint, letras bigint")
        seen = part if seen is None else seen.unionByName(part)
    if seen is None:
        return distinct.select("campo", "ordem", "hash", F.lit(0).cast("bigint").alias("total"), F.lit(0).cast("bigint").alias("letras"))
    name = F.element_at(F.array(*[F.lit(f) for f in fields]), F.col("c").cast("int") + 1)
    return seen.select(name.alias("campo"), F.col("ordem").cast("int").alias("ordem"), "hash", "total", "letras").groupBy("campo", "ordem", "hash").agg(F.sum("total").alias("total"), F.sum("letras").alias("letras"))


def _log_odds(seen: Column, own: int) -> Column:
    """Log-odds of an end after interpolation of the contexts ``seen``, short ones first; ``own`` ends and one sighting of each are the value's own."""
    share = F.aggregate(seen, F.lit(0.5), lambda p, x: (F.greatest(x["fins"] - own, F.lit(0)) + SMOOTHING * p) / (F.greatest(x["total"] - 1, F.lit(0)) + SMOOTHING))
    return F.log(F.greatest(share, F.lit(1e-12)) / F.greatest(1 - share, F.lit(1e-12)))


def inner_places(scored: DataFrame) -> DataFrame:
    """``campo, fim, ordem, lingua, log_odds, n``: the places inside all values after characters that some value ends with.

    A place counts once, with the longest of these contexts (the last ``ordem`` characters of ``fim``); its log-odds are those of a cut there. ``scored``
    has ``campo, fim`` and the contexts ``c`` of each distinct end. Places aren't told apart by language.
    """
    c = F.array_sort("c")
    one = F.transform(F.sequence(F.lit(1), F.size("c")), lambda k: F.struct(
        F.element_at(c, k)["ordem"].alias("ordem"), F.element_at(c, k)["hash"].alias("hash"), F.greatest(F.element_at(c, k)["total"] - F.element_at(c, k)["fins"], F.lit(0)).alias("n"),
        _log_odds(F.slice(c, F.lit(1), k), 0).alias("log_odds"), F.when(k > 1, F.struct(F.get(c, k - 2)["ordem"].alias("ordem"), F.get(c, k - 2)["hash"].alias("hash"))).alias("menor")))
    each = scored.where(F.size("c") > 0).select("campo", "fim", F.explode(one).alias("x")).groupBy("campo", F.col("x.ordem").alias("ordem"), F.col("x.hash").alias("hash")).agg(
        F.min("fim").alias("fim"), F.max("x.n").alias("n"), F.max("x.log_odds").alias("log_odds"), F.max("x.menor").alias("menor"))
    longer = each.where("menor is not null").groupBy("campo", F.col("menor.ordem").alias("ordem"), F.col("menor.hash").alias("hash")).agg(F.sum("n").alias("maiores"))
    rest = F.greatest(F.col("n") - F.coalesce("maiores", F.lit(0)), F.lit(0))
    return each.join(longer, ["campo", "ordem", "hash"], "left").select("campo", "fim", "ordem", F.lit("").alias("lingua"), "log_odds", rest.alias("n"))


def end_scores(acts: DataFrame, fields: tuple[str, ...] = ("orgao", "trecho")) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ends of all values (``linha_csv, campo, fim, lingua``), each distinct end with ``log_odds`` and ``na_palavra``, ``inner_places``."""
    ship_code(acts.sparkSession)
    filled = acts.select("linha_csv", *[F.coalesce(F.col(f), F.lit("")).alias(f) for f in fields])
    ends = cut(spread(filled).mapInArrow(_ends(fields), f"linha_csv {dict(acts.dtypes)['linha_csv']}, campo string, fim string, lingua string"), "value-ends")
    counted = ends.groupBy("campo", "fim").agg(F.count("*").alias("n"))
    suffixes = cut(counted.mapInPandas(_suffix_rows, "campo string, fim string, ordem int, hash bigint, n bigint"), "ends")
    seen = contexts(acts, fields, suffixes)
    ended = suffixes.groupBy("campo", "ordem", "hash").agg(F.sum("n").alias("fins"))
    both = ended.join(seen, ["campo", "ordem", "hash"])
    scored = cut(suffixes.join(both, ["campo", "ordem", "hash"]).groupBy("campo", "fim").agg(F.collect_list(F.struct("ordem", "total", "fins", "letras", "hash")).alias("c")), "end-contexts")
    # The longest context that was seen often enough to tell what follows it.
    known = F.filter(F.array_sort("c"), lambda x: (x["total"] > LEAST_LETTERS) & (x["ordem"] > ORDERS[0]))
    onward = F.when(F.size(known) > 0, F.element_at(known, -1))
    inside = (onward["letras"] >= F.greatest(IN_WORD * (onward["total"] - onward["fins"]), SLIPS * onward["fins"])) & (onward["letras"] >= LEAST_LETTERS)
    inside = F.coalesce(inside, F.lit(False)) & F.col("fim").rlike(r"\p{L}$") & F.col("campo").isin(*PHRASES)
    scores = cut(scored.select("campo", "fim", _log_odds(F.array_sort("c"), 1).alias("log_odds"), inside.alias("na_palavra")), "scores")
    return ends, scores, inner_places(scored)


def marked() -> Column:
    """Whether an end has the mark of a sentence."""
    return F.col("fim").rlike(r"[.!?”]$")


def thresholds(ends: DataFrame, scores: DataFrame, places: DataFrame) -> dict[tuple[str, str, bool], float]:
    """Least log-odds of a complete value by column, language and mark; ``places`` (rows, or ``n`` each) are where cuts would be."""
    place = F.greatest(F.least(F.floor(F.col("log_odds") / BIN), F.lit(int(HIGHEST / BIN) + 8)), F.lit(int(LOWEST / BIN) - 8)).cast("int").alias("b")
    key = ["campo", "lingua", marked().alias("marca"), place]
    real: dict[tuple[str, str, bool], dict[int, int]] = {}
    cuts: dict[tuple[str, str, bool], dict[int, int]] = {}
    for df, into in ((ends.join(scores, ["campo", "fim"]), real), (places, cuts)):
        for r in df.groupBy(*key).agg((F.sum("n") if "n" in df.columns else F.count("*")).alias("n")).where("n > 0").collect():  # bins, languages and columns are few
            into.setdefault((r.campo, r.lingua, r.marca), {})[r.b] = r.n
    out = {}
    for k, bins in real.items():
        # A language seldom met leans on all languages of its column.
        bins, own = dict(bins), dict(cuts.get(k, {}))
        for table, mine in ((real, bins), (cuts, own)):
            whole: dict[int, int] = {}
            for j, other in table.items():
                if (j[0], j[2]) == (k[0], k[2]):
                    for b, n in other.items():
                        whole[b] = whole.get(b, 0) + n
            for b, n in whole.items():
                mine[b] = mine.get(b, 0) + n * POOLED / sum(whole.values())
        n = sum(bins.values())
        missed = lambda t: sum(x for b, x in own.items() if b >= t) / max(sum(own.values()), 1)  # noqa: B023, E731
        cost = {t: sum(bins.get(b, 0) for b in range(t - STRETCH, t + STRETCH)) / n + MISSED * missed(t) for t in range(int(LOWEST / BIN), int(HIGHEST / BIN) + 1)
                if t == int(LOWEST / BIN) or sum(x for b, x in bins.items() if b < t + STRETCH) <= MOST_CUT * n}
        out[k] = min(cost, key=lambda t: (cost[t], t)) * BIN  # noqa: B023
    return out


def truncated(acts: DataFrame, fields: tuple[str, ...] = ("orgao", "trecho")) -> DataFrame:
    """``linha_csv, campo`` of each value that was cut. Null and blank values have no end to judge.

    An end whose contexts nothing else holds has log-odds 0 and counts as complete. Repeated rows give a
    row each; an empty table gives none; texts are read whole whatever their length.
    """
    ends, scores, places = end_scores(acts, fields)
    limit = thresholds(ends, scores, places)
    least = F.lit(-math.inf)
    for (f, lang, mark), t in limit.items():
        least = F.when((F.col("campo") == f) & (F.col("lingua") == lang) & (marked() == mark), F.lit(t)).otherwise(least)
    judged = ends.join(scores, ["campo", "fim"])
    return judged.where((F.col("log_odds") < least) | F.col("na_palavra")).select("linha_csv", "campo")


def truncation_rates(acts: DataFrame) -> DataFrame:
    """Share of cut values for each source (host of ``fonte_url``, ``unknown`` if empty) and column."""
    cuts = truncated(acts).groupBy("linha_csv", "campo").agg(F.count("*").alias("_cut"))
    host = F.coalesce(F.expr("nullif(try_parse_url(fonte_url, 'HOST'), '')"), F.lit("unknown"))
    values = acts.selectExpr("linha_csv", "fonte_url", "stack(2, 'orgao', orgao, 'trecho', trecho) AS (campo, valor)").where("trim(valor) <> ''")
    joined = values.select("linha_csv", "campo", host.alias("fonte")).join(cuts, ["linha_csv", "campo"], "left")
    return joined.groupBy("fonte", "campo").agg(
        F.count("*").alias("valores"), F.count("_cut").alias("cortados"), F.round(F.count("_cut") / F.count("*"), 6).alias("taxa"))
