"""Problem 9: mix sources to target weights.

Sizes are tokens of the public tokenizer. Weights flow down a tree of domains (the part of a source's
name before the first underscore), languages and sources. A node gets at most what its documents give
when each is used as often as allowed; what a node can't take goes to its siblings before it goes back
to the parent's siblings. Each leaf fills its budget with whole epochs and a token-prefix of one more,
in an order seeded for the epoch.

The tree has one leaf for each weighted source and language and stays a table: every level is shared out
by one window over siblings, so no number of sources is too many. Prefixes come from running sums over
1024 hash buckets; the bucket in which a budget ends is split again until it holds few documents, so a
source with a third of all documents is never ordered by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actaflow.llm.bpe import VOCABULARY, token_counts
from actaflow.runtime import cut

#: Bits of the hash that each round of the prefix search looks at, and documents that may be ordered at the end.
STEP_BITS, FEW = 10, 10_000


def fill(nodes: DataFrame, parent: tuple[str, ...], name: str) -> DataFrame:
    """``nodes`` with ``amount``: each parent's ``budget`` shared by ``weight``, nobody above ``room``.

    What exceeds a room goes to the siblings, by weight, while any has room. Sorted by room for weight, the
    nodes before some point are full and all others get the same amount for their weight.
    """
    ok = (F.col("weight") > 0) & (F.col("room") > 0)
    ratio = F.when(ok, F.col("room") / F.col("weight"))
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    before = group.orderBy(ratio.asc_nulls_last(), name).rowsBetween(Window.unboundedPreceding, -1)
    less = lambda c: F.coalesce(F.sum(F.when(ok, F.col(c))).over(before), F.lit(0.0))
    open_weight = F.sum(F.when(ok, F.col("weight"))).over(group) - less("weight")
    rows = nodes.withColumn("_rate", F.when(ok, F.try_divide(F.col("budget") - less("room"), open_weight))).withColumn("_ratio", ratio)
    rate = F.max(F.when(F.col("_rate") <= F.col("_ratio"), F.col("_rate"))).over(group)
    rows = rows.withColumn("_rate", rate)
    return rows.withColumn("amount", F.when(ok, F.coalesce(F.least("room", F.col("_rate") * F.col("weight")), "room")).otherwise(0.0)).drop("_rate", "_ratio")


def leaf_budgets(leaves: DataFrame, budget: Column) -> DataFrame:
    """``leaves`` (``domain, lang, source, weight, room``) with ``amount``: the budget brought down level by level."""
    up = [F.sum("weight").alias("weight"), F.sum("room").alias("room")]
    domains = fill(leaves.groupBy("domain").agg(*up).withColumn("budget", budget), (), "domain").select("domain", F.col("amount").alias("budget"))
    langs = fill(leaves.groupBy("domain", "lang").agg(*up).join(domains, "domain"), ("domain",), "lang").select("domain", "lang", F.col("amount").alias("budget"))
    return fill(leaves.join(langs, ["domain", "lang"]), ("domain", "lang"), "source").drop("budget")


def leaves_of(sized: DataFrame, weights: DataFrame) -> DataFrame:
    """The tree's leaves. A source's weight goes to its languages by their tokens."""
    sums = sized.groupBy("source", "lang").agg(F.sum("tokens").alias("tokens"))
    whole = sums.groupBy("source").agg(F.sum("tokens").alias("whole"))
    rows = weights.join(sums, "source", "left").join(whole, "source", "left")
    tokens, times = F.coalesce("tokens", F.lit(0)), F.greatest(F.coalesce("max_repeticoes", F.lit(0)), F.lit(0))
    share = F.coalesce(F.col("tokens") / F.col("whole"), F.lit(1.0))
    return rows.select(F.substring_index("source", "_", 1).alias("domain"), F.coalesce("lang", F.lit("")).alias("lang"), "source", tokens.alias("tokens"),
                       (F.coalesce("peso_alvo", F.lit(0.0)) * share).alias("weight"), (tokens * times).cast("double").alias("room"), times.alias("times"))


def largest_budget(leaves: DataFrame) -> float:
    """The largest total at which no source that has documents falls short of its share (one number)."""
    have = leaves.where("room > 0 and weight > 0")
    least = have.agg(F.min("room")).first()[0]
    if least is None:
        return 0.0
    small = leaf_budgets(leaves, F.lit(least / 10)).where("room > 0 and weight > 0")
    total = small.agg(F.sum("amount")).first()[0] or 0.0
    source = small.groupBy("source").agg(F.sum("amount").alias("part"), F.sum("room").alias("room")).where("part > 0")
    return source.agg(F.min(F.col("room") * F.lit(total) / F.col("part"))).first()[0] or 0.0


def prefixes(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with ``extra``: 1 for the documents of each leaf, in order of ``h``, that its ``rest`` tokens reach.

    The document on the edge is used if more than half of it lies inside.
    """
    leaf = ["source", "lang"]
    edges, bits = plan.where("rest > 0").select(*leaf, "rest", F.lit(0).cast("bigint").alias("prefix"), F.lit(0).cast("bigint").alias("before")), 0
    top = lambda n: F.shiftrightunsigned("h", 64 - n) if n else F.lit(0).cast("bigint")
    while True:
        inside = rows.join(edges.drop("rest"), leaf).where(top(bits) == F.col("prefix"))
        sums = inside.groupBy(*leaf, "rest", "prefix", "before", top(bits + STEP_BITS).alias("bucket")).agg(F.sum("tokens").alias("s"), F.count("*").alias("n"))
        start = F.col("before") + F.coalesce(F.sum("s").over(Window.partitionBy(*leaf).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        last = sums.withColumn("start", start).where("start < rest").groupBy(*leaf, "rest").agg(F.max_by(F.struct("bucket", "start", "n"), "bucket").alias("m"))
        edges = cut(last.select(*leaf, "rest", F.col("m.bucket").alias("prefix"), F.col("m.start").alias("before"), F.col("m.n").alias("n")), "edges")
        bits += STEP_BITS
        if (edges.agg(F.max("n")).first()[0] or 0) <= FEW or bits + STEP_BITS > 60:
            break
    placed = rows.join(edges.select(*leaf, "prefix", "before"), leaf, "left")
    on_edge = F.coalesce(top(bits) == F.col("prefix"), F.lit(False))
    clear = placed.where(~on_edge).withColumn("extra", F.coalesce((top(bits) < F.col("prefix")).cast("int"), F.lit(0)))
    running = F.sum("tokens").over(Window.partitionBy(*leaf).orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    edge = placed.where(on_edge).withColumn("extra", ((F.col("before") + running - F.col("tokens") / 2) <= F.col("rest")).cast("int"))
    return clear.unionByName(edge).drop("prefix", "before")


def mixture(docs: DataFrame, weights: DataFrame, total: float | None = None, seed: int = 0, path: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """``doc_id, source, lang, tokens, usos`` of the documents in the mix; its leaves with their budgets (``amount``).

    ``total`` tokens are wanted; by default as many as all shares allow. Null, empty and wordless texts
    have no tokens and are never used, nor are documents without source or weight. Repeated weights of a
    source count once (the largest). The same seed gives the same mix.
    """
    weights = weights.where("source is not null").groupBy("source").agg(F.max("peso_alvo").alias("peso_alvo"), F.max("max_repeticoes").alias("max_repeticoes"))
    own = docs.select("doc_id", "source", F.coalesce("lang", F.lit("")).alias("lang"), "text")
    own = own.join(weights.select("source"), "source", "left_semi")
    counts = token_counts(own.withColumn("_key", F.struct("doc_id", "source", "lang")), "_key", "text", path)
    sized = cut(counts.select("_key.*", "tokens").where("tokens > 0"), "sized")
    leaves = cut(leaves_of(sized, weights), "leaves")
    leaves = cut(leaf_budgets(leaves, F.lit(float(largest_budget(leaves) if total is None else total))), "budgets")
    epochs = F.least(F.floor((F.col("amount") + 1e-6) / F.col("tokens")), F.col("times").cast("bigint"))
    plan = leaves.where("tokens > 0 and amount > 0").withColumn("epochs", epochs)
    rest = F.when(F.col("epochs") < F.col("times"), F.floor(F.col("amount") - F.col("epochs") * F.col("tokens") + 0.5)).otherwise(0)
    plan = cut(plan.select("source", "lang", F.col("epochs").cast("int").alias("epochs"), rest.cast("bigint").alias("rest")), "plan")
    rows = cut(sized.join(plan, ["source", "lang"]).withColumn("h", F.xxhash64(F.lit(seed), F.col("epochs"), F.col("doc_id"))), "planned")
    used = prefixes(rows, plan).withColumn("usos", F.col("epochs") + F.col("extra"))
    return used.where("usos > 0").select("doc_id", "source", "lang", "tokens", "usos"), leaves


def mix(docs: DataFrame, weights: DataFrame) -> DataFrame:
    return mixture(docs, weights)[0]


def share_report(docs: DataFrame, weights: DataFrame, total: float | None = None) -> DataFrame:
    """Target and actual share of each weighted source, its tokens and how often documents were used."""
    chosen, _ = mixture(docs, weights, total)
    used = cut(chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("usos")).alias("tokens_usados"), F.max("usos").alias("max_usos"), F.count("*").alias("documentos")), "shares")
    everything = used.agg(F.sum("tokens_usados").alias("t"))
    total_used = everything.first().t  # one number
    return weights.join(used, "source", "left").withColumn("t", F.lit(total_used)).select(
        "source", "peso_alvo", "max_repeticoes", F.coalesce("documentos", F.lit(0)).alias("documentos"), F.coalesce("tokens_usados", F.lit(0)).alias("tokens_usados"),
        F.coalesce("max_usos", F.lit(0)).alias("max_usos"), F.round(F.coalesce(F.col("tokens_usados") / F.col("t"), F.lit(0.0)), 6).alias("peso_real"))
