"""Problem 10: reading level by harmonic propagation on the document-word graph.

Documents and words form a bipartite graph, an edge weighted by how rare its word is. Graded documents
are clamped; every other value becomes the weighted mean of its neighbours, words and documents in turn,
until no word changes by more than ``TOLERANCE``. An edge's weight depends on its word alone, so a word
is the plain mean of its documents.

The graph is one row for each document with the codes of its words. A round is one pass over these rows:
each batch computes its documents from the values of the words, and sums of words from its documents;
only those sums are shuffled. The values of all words are sent to the workers while there are at most
``MAX_WORDS`` of them; a larger vocabulary takes the same rounds as joins of the edge list.

Averages shrink towards the middle; cut points between levels are therefore fitted on the graded
documents' own propagated (unclamped) values, from a histogram of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actaflow.runtime import cut, ship_code, spread

LEVELS = 5
#: Largest change of a word after which the rounds end, and most rounds (the change falls by a fixed share each round).
TOLERANCE, MOST_ROUNDS = 0.005, 200
#: Words whose values may be sent to the workers (8 MB); more take the way of joins.
MAX_WORDS = 1_000_000
#: Least documents that hold a word.
LEAST_DOCS = 2
#: Width of the histogram bins in which cut points are sought.
BIN = 0.002
REFERENCE_RATER = "a1"


def grades(labels: DataFrame) -> DataFrame:
    """One level for each graded document: the reference rater's, else the mean of the others."""
    ok = labels.where("doc_id is not null and nivel between 1 and 5")
    own = F.avg(F.when(F.col("avaliador") == REFERENCE_RATER, F.col("nivel")))
    return ok.groupBy("doc_id").agg(F.coalesce(own, F.avg("nivel")).alias("nivel"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of each text as 64-bit hashes."""
    for b in batches:
        words = pc.split_pattern_regex(pc.utf8_lower(b.column(2)), r"[^\pL]+")
        flat = words.flatten().dictionary_encode()
        names = flat.dictionary.to_numpy(zero_copy_only=False)
        hashes = pd.util.hash_array(names, categorize=False).view(np.int64) if len(names) else np.zeros(0, np.int64)
        codes, parent = flat.indices.to_numpy().astype(np.int64), np.asarray(pc.list_parent_indices(words)).astype(np.int64)
        full = np.asarray([n != "" for n in names], bool)[codes] if len(names) else np.zeros(0, bool)
        pairs = np.unique(parent[full] * max(len(names), 1) + codes[full])
        ends = np.searchsorted(pairs, (np.arange(b.num_rows + 1)) * max(len(names), 1))
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(hashes[pairs % max(len(names), 1)]))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], ["doc_id", "nivel", "palavras"])


def graph_of(docs: DataFrame, clamped: DataFrame) -> DataFrame:
    """``doc_id, nivel`` (null without a grade) ``, palavras``: one row for each document."""
    grade = F.broadcast(clamped) if clamped.count() <= MAX_WORDS else clamped  # texts stay where they are for up to so many grades
    rows = spread(docs.select("doc_id", "text")).join(grade, "doc_id", "left").select("doc_id", F.col("nivel").cast("double").alias("nivel"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_hashed, f"doc_id {dict(docs.dtypes)['doc_id']}, nivel double, palavras array<bigint>")


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        words, n = np.unique(b.column(0).flatten().to_numpy(), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(n)], ["palavra", "n"])


def _codes(known: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            flat, parent = lists.flatten().to_numpy(), np.asarray(pc.list_parent_indices(lists))
            at = np.minimum(np.searchsorted(known, flat), max(len(known) - 1, 0))
            hit = known[at] == flat if len(known) else np.zeros(len(flat), bool)
            ends = np.append(0, np.cumsum(np.bincount(parent[hit], minlength=b.num_rows)))
            kept = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(at[hit].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), kept], ["doc_id", "nivel", "codigos"])

    return run


def _means(b: pa.RecordBatch, value: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes and owners of the edges of a batch, and each document's mean (NaN without words)."""
    lists = b.column(2)
    code, own = lists.flatten().to_numpy(), np.asarray(pc.list_parent_indices(lists))
    total = np.bincount(own, weights=weight[code], minlength=b.num_rows)
    with np.errstate(invalid="ignore"):
        return code, own, np.bincount(own, weights=(weight * value)[code], minlength=b.num_rows) / np.where(total > 0, total, np.nan)


def _round(value: np.ndarray | None, weight: np.ndarray):
    """Sums of documents by word. Without ``value`` only graded documents count (the start)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            grade = b.column(1).to_numpy(zero_copy_only=False).astype(float)
            code, own, mean = _means(b, weight if value is None else value, weight)
            held = grade if value is None else np.where(np.isnan(grade), mean, grade)
            seen = ~np.isnan(held[own])
            n = np.bincount(code[seen], minlength=len(weight))
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.bincount(code[seen], weights=held[own][seen], minlength=len(weight))[at]), pa.array(n[at])], ["codigo", "soma", "n"])

    return run


def _values(value: np.ndarray, weight: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_means(b, value, weight)[2], from_pandas=True)], ["doc_id", "valor"])

    return run


def by_batches(graph: DataFrame, words: DataFrame, n_docs: int, middle: float) -> DataFrame:
    """``doc_id, valor`` with the values of all words (at most ``MAX_WORDS``) on the workers."""
    known = words.toPandas().sort_values("palavra")
    weight = np.log1p(n_docs / known["n"].to_numpy())
    id_type = dict(graph.dtypes)["doc_id"]
    coded = cut(graph.mapInArrow(_codes(known["palavra"].to_numpy()), f"doc_id {id_type}, nivel double, codigos array<int>"), "graph")

    def once(value: np.ndarray | None) -> np.ndarray:
        sums = coded.mapInArrow(_round(value, weight), "codigo bigint, soma double, n bigint").groupBy("codigo").agg((F.sum("soma") / F.sum("n")).alias("v")).toPandas()
        new = np.full(len(weight), middle)
        new[sums["codigo"].to_numpy()] = sums["v"].to_numpy()
        return new

    value = once(None)
    for _ in range(MOST_ROUNDS):
        new = once(value)
        change, value = np.abs(new - value).max(initial=0), new
        if change <= TOLERANCE:
            break
    return coded.mapInArrow(_values(value, weight), f"doc_id {id_type}, valor double")


def by_joins(graph: DataFrame, words: DataFrame, n_docs: int, middle: float) -> DataFrame:
    """``doc_id, valor`` by joins of the edge list: any number of words."""
    rows = cut(graph.withColumn("linha", F.monotonically_increasing_id()), "documents")
    weights = words.select("palavra", F.log1p(F.lit(float(n_docs)) / F.col("n")).alias("peso"))
    edges = cut(rows.select("linha", F.explode("palavras").alias("palavra")).join(weights.select("palavra"), "palavra", "left_semi"), "edges")
    held = rows.where("nivel is not null").select("linha", F.col("nivel").alias("valor"))
    at = lambda docs: cut(weights.join(edges.join(docs, "linha").groupBy("palavra").agg(F.avg("valor").alias("valor")), "palavra", "left").withColumn("valor", F.coalesce("valor", F.lit(middle))), "word-levels")
    mean = lambda level: edges.join(level, "palavra").groupBy("linha").agg((F.sum(F.col("peso") * F.col("valor")) / F.sum("peso")).alias("valor"))
    level = at(held)
    for _ in range(MOST_ROUNDS):
        docs = rows.select("linha", "nivel").join(mean(level), "linha", "left").select("linha", F.coalesce("nivel", "valor").alias("valor")).where("valor is not null")
        new = at(docs)
        change = new.join(level.select("palavra", F.col("valor").alias("_old")), "palavra").agg(F.max(F.abs(F.col("valor") - F.col("_old")))).first()[0] or 0.0
        level = new
        if change <= TOLERANCE:
            break
    return rows.select("linha", "doc_id").join(mean(level), "linha", "left").select("doc_id", "valor")


def propagate(docs: DataFrame, clamped: DataFrame, middle: float) -> DataFrame:
    """``doc_id, valor`` of each document: its unclamped value when the rounds have settled; null without shared words."""
    ship_code(docs.sparkSession)
    graph = cut(graph_of(docs, clamped), "words")
    words = graph.select("palavras").mapInArrow(_word_counts, "palavra bigint, n bigint").groupBy("palavra").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_DOCS)
    words = cut(words, "vocabulary")
    way = by_batches if words.count() <= MAX_WORDS else by_joins
    return way(graph, words, graph.count(), middle)


def cut_points(values: DataFrame, clamped: DataFrame) -> list[float]:
    """Boundaries between neighbouring levels with the fewest errors on graded documents."""
    bins = values.join(clamped, "doc_id").groupBy(F.round(F.col("valor") / BIN).cast("int").alias("b"), F.round("nivel").cast("int").alias("nivel")).agg(F.count("*").alias("n"))
    got = bins.collect()  # at most LEVELS / BIN bins for each level
    out: list[float] = []
    for k in range(1, LEVELS):
        low: dict[int, int] = {}
        high: dict[int, int] = {}
        for r in got:
            side = low if r.nivel <= k else high
            side[r.b] = side.get(r.b, 0) + r.n
        wrong, best = sum(low.values()), (sum(low.values()) + 1, [])
        for b in sorted({*low, *high}):
            wrong += high.get(b, 0) - low.get(b, 0)
            if wrong < best[0]:
                best = (wrong, [b])
            elif wrong == best[0]:
                best[1].append(b)
        at = (best[1][0] + best[1][-1] + 1) / 2 * BIN if best[1] else k + 0.5
        out.append(max(at, out[-1] if out else at))
    return out


def levelled(docs: DataFrame, labels: DataFrame, lang: str = "pt") -> DataFrame:
    """``doc_id, valor, nivel`` (bigint) for each document of ``lang`` without a grade.

    Null, empty and wordless texts, and texts that share no word, get the middle of the grades. Without
    any grades every document gets level 3. Repeated documents give a row for each.
    """
    own = docs.where(F.col("lang") == lang).select("doc_id", "text")
    clamped = cut(grades(labels), "grades")
    middle = clamped.agg(F.avg("nivel").alias("m")).first().m
    if middle is None:
        rest = own.select("doc_id").join(labels.select("doc_id"), "doc_id", "left_anti")
        return rest.select("doc_id", F.lit(3.0).alias("valor"), F.lit(3).cast("bigint").alias("nivel"))
    values = cut(propagate(own, clamped, float(middle)), "values")
    points = cut_points(values, clamped)
    rest = values.join(labels.select("doc_id"), "doc_id", "left_anti")
    level = F.lit(1)
    for p in points:
        level = level + F.when(F.col("valor") > p, 1).otherwise(0)
    return rest.select("doc_id", F.coalesce("valor", F.lit(float(middle))).alias("valor"),
                       F.when(F.col("valor").isNull(), F.lit(round(middle))).otherwise(level).cast("bigint").alias("nivel"))
