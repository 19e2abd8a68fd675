"""Problems 8 to 10: exact ids, shares and repeats, held-out accuracy."""

import base64
import os

import pytest
from pyspark.sql import functions as F

from actaflow.llm import bpe, mixing, reading_level
from actaflow.runtime import table

tiktoken = pytest.importorskip("tiktoken")
pytestmark = pytest.mark.skipif(not os.path.exists(bpe.VOCABULARY), reason="vocabulary file not here")
TEXTS = ["", "Olá, mundo!  dois espaços\n\nlinhas", "<|endoftext|> é texto", "a" * 3000, "ção " * 500, "日本語 😀 \u0000", "it's we'll 12345 R$ 1,00", " \t ", "ﬁḿ"]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(bpe.VOCABULARY, "rb"))}
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal():
    keys = [f"k{i}".encode() for i in range(5000)]
    table_ = bpe.PerfectHash(keys)
    assert sorted(table_.slot(k) for k in keys) == list(range(5000))


def test_ids_equal_the_library(spark, reference, base):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate([*TEXTS, None])], "doc_id bigint, text string, ids int")
    got = {r.doc_id: r.ids for r in bpe.encoded(df).collect()}
    assert got == {i: reference.encode_ordinary(t or "") for i, t in enumerate([*TEXTS, None])}
    docs = table(spark, base, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.ids == reference.encode_ordinary(texts[r.doc_id] or "") for r in bpe.encoded(docs).collect())
    assert bpe.encoded(df.limit(0)).count() == 0


def test_both_tiers_equal_the_library(reference):
    tok = bpe.tokenizer(bpe.VOCABULARY)
    for text in TEXTS:
        for piece in tok.pattern.findall(text):
            assert list(tok.piece(piece)) == reference.encode_ordinary(piece)
            if tok.whole(piece.encode()) is None:
                assert tok.merged(piece.encode()) == reference.encode_ordinary(piece)


def brute_fill(weights, room, budget):
    """Siblings one by one: full ones drop out, the rest share again."""
    out, open_ = [0.0] * len(weights), [i for i, r in enumerate(room) if r > 0 and weights[i] > 0]
    left = min(budget, sum(room[i] for i in open_))
    while open_ and left > 1e-9:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if out[i] + left * weights[i] / total >= room[i] - 1e-9]
        for i in full or open_:
            out[i] += room[i] - out[i] if full else left * weights[i] / total
        left = left - sum(room[i] for i in full) if full else 0
        open_ = [i for i in open_ if i not in full]
    return out


def test_fill_gives_shortages_to_siblings(spark):
    import random

    rng, rows, expect = random.Random(3), [], {}
    for p in range(60):
        n = rng.randint(1, 6)
        weights, room, budget = [rng.choice((0.0, 1.0, rng.random())) for _ in range(n)], [rng.choice((0.0, 5.0, rng.random() * 20)) for _ in range(n)], rng.choice((0.0, 3.0, 1000.0, rng.random() * 30))
        expect[p] = brute_fill(weights, room, budget)
        rows += [(p, i, w, r, budget) for i, (w, r) in enumerate(zip(weights, room, strict=True))]
    got = mixing.fill(spark.createDataFrame(rows, "p int, i int, weight double, room double, budget double"), ("p",), "i").collect()
    assert all(r.amount == pytest.approx(expect[r.p][r.i]) for r in got) and len(got) == len(rows)
    leaf = [("a", "pt", "a_1", 0.25, 5.0), ("a", "pt", "a_2", 0.25, 100.0), ("b", "pt", "b_1", 0.5, 100.0)]
    got = mixing.leaf_budgets(spark.createDataFrame(leaf, "domain string, lang string, source string, weight double, room double"), F.lit(100.0)).collect()
    assert {r.source: r.amount for r in got} == {"a_1": 5, "a_2": 45, "b_1": 50}


def test_prefix_search_equals_one_ordering(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FEW", 3)
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("pt").alias("lang"), (F.col("id") % 7 + 1).alias("tokens"), F.lit(5000).cast("bigint").alias("rest"), F.xxhash64("id").alias("h"))
    got = mixing.prefixes(rows, rows.select("source", "lang", "rest").distinct())
    ordered, run, expect = sorted((r.h & (2**64 - 1), r.doc_id, r.tokens) for r in rows.collect()), 0, set()
    for _, d, t in ordered:
        run += t
        if run - t / 2 <= 5000:
            expect.add(d)
    assert {r.doc_id for r in got.where("extra = 1").collect()} == expect and got.count() == 4000


def test_mixture(spark, base):
    docs, weights = table(spark, base, "documents"), table(spark, base, "pesos_fontes")
    chosen, leaves = mixing.mixture(docs, weights)
    used = {(r.source, r.lang): r.t for r in chosen.groupBy("source", "lang").agg(F.sum(F.col("tokens") * F.col("usos")).alias("t")).collect()}
    longest = docs.agg(F.max("n_chars")).first()[0]
    assert all(abs(used.get((r.source, r.lang), 0) - r.amount) <= longest for r in leaves.collect())
    limits = {r.source: r.max_repeticoes for r in weights.collect()}
    assert all(r.usos <= limits[r.source] for r in chosen.collect())
    assert chosen.count() == chosen.select("doc_id").distinct().count()
    assert sorted(map(tuple, chosen.collect())) == sorted(map(tuple, mixing.mixture(docs, weights)[0].collect()))
    report = mixing.share_report(docs, weights, total=2000.0).agg(F.sum("peso_real")).first()[0]
    assert report == pytest.approx(1, abs=1e-4)


def test_mixture_of_nothing(spark, base):
    docs, weights = table(spark, base, "documents"), table(spark, base, "pesos_fontes")
    assert mixing.mixture(docs.limit(0), weights)[0].count() == 0
    assert mixing.mixture(docs, weights.limit(0))[0].count() == 0
    assert mixing.share_report(docs.limit(0), weights).count() == weights.count()


def test_levels_of_held_out_documents(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = table(spark, base, "documents"), table(spark, base, "niveis_rotulados")
    hidden = labels.where("avaliador = 'a1' and pmod(doc_id, 4) = 0").select("doc_id", F.col("nivel").alias("true"))
    got = reading_level.levelled(docs, labels.join(hidden.select("doc_id"), "doc_id", "left_anti")).join(hidden, "doc_id")
    right, n = got.agg(F.avg((F.col("nivel") == F.col("true")).cast("int")), F.count("*")).first()
    assert n > 15 and right >= 0.8


def test_level_edges(spark):
    docs = spark.createDataFrame([(1, "pt", "a b c", 9), (2, "pt", "a b d", 9), (3, "pt", None, 9), (4, "pt", "", 9), (5, "en", "a b", 9), (6, None, "a", 9)], "doc_id bigint, lang string, text string, nivel int")
    labels = spark.createDataFrame([(1, 2, "a1"), (1, 5, "a2"), (None, 1, "a1"), (2, None, "a1")], "doc_id bigint, nivel int, avaliador string")
    got = {r.doc_id: r.nivel for r in reading_level.levelled(docs, labels).collect()}
    assert set(got) == {3, 4} and got[3] == 2
    none = reading_level.levelled(docs, labels.limit(0)).collect()
    assert {r.doc_id: r.nivel for r in none} == {1: 3, 2: 3, 3: 3, 4: 3}
    assert reading_level.levelled(docs.limit(0), labels).count() == 0


def test_both_ways_of_propagation_agree(spark, base, monkeypatch):
    docs, labels = table(spark, base, "documents"), table(spark, base, "niveis_rotulados")
    own, clamped = docs.where("lang = 'pt'").select("doc_id", "text"), reading_level.grades(labels)
    one = {r.doc_id: r.valor for r in reading_level.propagate(own, clamped, 3.0).collect()}
    monkeypatch.setattr(reading_level, "MAX_WORDS", 0)
    two = {r.doc_id: r.valor for r in reading_level.propagate(own, clamped, 3.0).collect()}
    assert one.keys() == two.keys() and all(one[k] == pytest.approx(two[k]) for k in one)
