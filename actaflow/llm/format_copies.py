"""Problem 3: records that are the same but for their formatting.

Progressive partition refinement. Every row first gets a cheap invariant (a hash of the columns that
must agree exactly and of the stripped lengths of the free columns); only ids and invariants are
shuffled. Classes with one member end there. Members of larger classes get a letter histogram, and
only classes that are still shared get the exact key: the exact columns themselves, and letters and
digits of each free column with labelled fields in sorted order.

Texts travel for members of shared classes alone: the rest is dropped at the scan by a bitmap of the
members' ids, sized by how many there are up to ``MAX_BITS``; with more members the bitmap lets more
through, and the exact join that follows decides in any case.

Classes are counted by hash aggregation (partial sums before the shuffle) and joined back, never
windowed, so a class that holds a third of all rows is split by adaptive skew handling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actaflow.runtime import cut

FREE_COLUMNS = ("nome", "cargo", "orgao", "trecho")
#: Labels that open a field of a labelled excerpt (fixed values of the data).
FIELD_LABELS = ("PROCESSO", "VIGÊNCIA", "DOCUMENTO", "CARGO", "SERVIDOR", "LOTAÇÃO", "MOTIVO", "OBSERVAÇÃO")
#: Most bits of the bitmap of ids (32 MB).
MAX_BITS = 1 << 28
#: Letters whose counts form the histogram.
HISTOGRAM_LETTERS = "aeiosrnt"


def stripped(column: Column) -> Column:
    """Letters and digits only, in one case. Null counts as empty."""
    return F.regexp_replace(F.lower(F.upper(F.coalesce(column, F.lit("")))), r"[^\p{L}\p{N}]+", "")


def histogram(column: Column) -> Column:
    """Counts of frequent letters in a stripped value; the order of fields doesn't change it."""
    n = F.length(column)
    return F.concat_ws(",", *[(n - F.length(F.replace(column, F.lit(c), F.lit("")))).cast("string") for c in HISTOGRAM_LETTERS])


def canonical_fields(column: Column) -> Column:
    """Exact key of an excerpt: stripped text, with the fields of a labelled excerpt sorted.

    An excerpt is labelled if a label opens it; what stands between a label and its field is disregarded.
    """
    labels = "|".join(FIELD_LABELS)
    text = F.upper(F.coalesce(column, F.lit("")))
    labelled = text.rlike(rf"^[^\p{{L}}\p{{N}}]*(?:{labels})[^\p{{L}}\p{{N}}]")
    pieces = F.split(text, rf"(?<![\p{{L}}\p{{N}}])(?={'(?:' + labels + ')'}(?![\p{{L}}\p{{N}}]))")
    fields = F.filter(F.transform(pieces, lambda p: F.regexp_replace(F.lower(p), r"[^\p{L}\p{N}]+", "")), lambda p: p != "")
    return F.when(labelled, F.concat_ws("\u0001", F.array_sort(fields))).otherwise(stripped(column))


def _shared(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of ``df`` whose key occurs more than once."""
    many = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    return df.join(many, on=[F.col(k) == F.col(f"_k_{k}") for k in keys], how="left_semi")


def members(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``rows`` whose ``id`` is among ``ids`` (one column). A bitmap drops most others before the exact join."""
    n = ids.count()
    bits = min(MAX_BITS, max(1 << 15, 1 << (16 * n).bit_length()))
    place = F.pmod(F.xxhash64("id"), F.lit(bits))
    chunks = ids.select(place.alias("p")).groupBy(F.shiftright("p", 15).alias("_chunk")).agg(F.expr("bitmap_construct_agg(p & 32767)").alias("_bits"))
    near = rows.withColumn("_p", place).join(F.broadcast(chunks), F.shiftright("_p", 15) == F.col("_chunk"))  # at most MAX_BITS bits
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(shiftright(_p & 32767, 3) as int) + 1, 1)")), 16, 10).cast("int")
    near = near.where(F.call_function("shiftright", byte, F.expr("cast(_p & 7 as int)")).bitwiseAND(F.lit(1)) == 1)
    return near.drop("_p", "_chunk", "_bits").join(ids, "id", "left_semi")


def copy_classes(df: DataFrame, id_col: str = "linha_csv", free: tuple[str, ...] = FREE_COLUMNS, labelled: str = "trecho") -> DataFrame:
    """One row per copy: ``id``, ``key`` (exact class key), for classes with several members only.

    All columns but ``id_col`` and ``free`` must agree exactly. Nulls equal nulls and, in the free
    columns, empty texts. An empty table gives no rows; repeated ids stay separate rows. Extra
    columns take part in the exact comparison whatever their names.
    """
    exact = [c for c in sorted(df.columns) if c != id_col and c not in free]
    rows = df.select(
        F.col(f"`{id_col}`").alias("id"), *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")).alias(f"e{i}") for i, c in enumerate(exact)],
        *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(f"f{i}") for i, c in enumerate(free)])
    texts = [F.col(f"f{i}") for i in range(len(free))]
    k1 = F.xxhash64(*[F.col(f"e{i}") for i in range(len(exact))], *[F.length(stripped(t)) for t in texts])
    shared = cut(_shared(cut(rows.select("id", k1.alias("k1")), "invariants"), "k1"), "shared")
    one = members(rows, shared.select("id").distinct())
    one = cut(one.withColumn("k2", F.xxhash64(k1, *[histogram(stripped(t)) for t in texts])), "copies")
    two = _shared(one, "k2")
    key = [canonical_fields(t) if c == labelled else stripped(t) for c, t in zip(free, texts, strict=True)]
    exact_key = F.unhex(F.sha2(F.to_json(F.struct(*[F.col(f"e{i}") for i in range(len(exact))], *[k.alias(f"k{i}") for i, k in enumerate(key)])), 256))
    return two.select("id", exact_key.alias("key"))


def collapse_copies(df: DataFrame, id_col: str = "linha_csv", free: tuple[str, ...] = FREE_COLUMNS, labelled: str = "trecho") -> DataFrame:
    """``df`` with one row per set of copies (the smallest id) and ``copias``, the number of copies."""
    classes = cut(copy_classes(df, id_col, free, labelled), "classes")
    size = classes.groupBy("key").agg(F.min("id").alias("_first"), F.count("*").alias("_copies"))
    surplus = classes.join(size, "key").where("id <> _first").select(F.col("id").alias("_surplus"))
    kept = df.join(surplus, F.col(f"`{id_col}`") == F.col("_surplus"), "left_anti")
    counted = kept.join(size.select("_first", "_copies"), F.col(f"`{id_col}`") == F.col("_first"), "left")
    return counted.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce("_copies", F.lit(1)).alias("copias"))


def surplus_pairs(df: DataFrame) -> DataFrame:
    """``linha_a`` (smallest id of its set of copies) and ``linha_b`` (each other member)."""
    classes = cut(copy_classes(df), "classes")
    first = classes.groupBy("key").agg(F.min("id").alias("linha_a"), F.count("*").alias("n")).where("n > 1")
    return classes.join(first, "key").where("id <> linha_a").select("linha_a", F.col("id").alias("linha_b"))
