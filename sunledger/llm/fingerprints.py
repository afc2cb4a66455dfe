"""Document fingerprints: bottom-k sketches of shingle hashes, by DataFrame functions alone.

A sketch is the k smallest distinct hashes of a text's shingles, in order. Sketches of parts merge into that of the whole
(the k smallest of both), and two sketches tell how much two texts share without the texts: resemblance, containment,
and the number of distinct shingles.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger.llm.common import private

SHINGLE = 5
K = 128
#: Rows that are put in order together, about.
ORDERED_TOGETHER = 2000
#: Most ranges of ids; their bounds are held as literals. Beyond 40 million rows ranges grow with the table.
MOST_RANGES = 20_000
HASHES = float(1 << 64)


# --- sketches ---


def sketch(text: Column, shingle: int = SHINGLE, k: int = K) -> Column:
    """Sketch of a text's lower-cased words. A text of fewer words than a shingle is one shingle; one without words has
    the empty sketch. A null text gives null."""
    words = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def shingles(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w) - (shingle - 1))
        return F.transform(starts, lambda i: F.xxhash64(*(F.element_at(w, i + j) for j in range(shingle))))

    # A lambda's argument is computed once; the words would otherwise be split again at each mention.
    return F.element_at(
        F.transform(
            F.array(words),
            lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>"))
            .when(F.size(w) < shingle, F.array(F.xxhash64(w)))
            .otherwise(smallest(shingles(w), k)),
        ),
        1,
    )


def smallest(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return smallest(F.concat(a, b), k)


def merge_groups(sketches: DataFrame, key: str, column: str = "sketch", k: int = K) -> DataFrame:
    """``key, sketch``: one sketch per group of any size. Tasks keep the k smallest hashes of a group before the
    exchange, so a group that holds a third of all rows costs the shuffle k rows per task."""
    hashes = sketches.select(F.col(key), F.explode(column).alias("hash"))
    order = Window.partitionBy(key).orderBy("hash")
    least = hashes.withColumn("place", F.dense_rank().over(order)).filter(F.col("place") <= k)
    return least.groupBy(key).agg(F.sort_array(F.collect_set("hash")).alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated shared part of all shingles of either text: how many of the k smallest of both are in both. 1 for two
    empty sketches, 0 if one is empty. Exact as long as both hold fewer than k shingles together."""
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, k)
    common = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when(F.size(union) == 0, 1.0).otherwise(common / F.size(union)).cast("double")


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    reach = (F.element_at(a, -1).cast("double") + HASHES / 2) / HASHES
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / reach)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too; 1 for an empty a."""
    shared = resemblance(a, b, k) * distinct_count(merged(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / distinct_count(a, k)))


def printed(a: Column) -> Column:
    """16 hexadecimal digits per hash, in order."""
    return F.lower(F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


# --- the next document in order of ids ---


def id_bounds(docs: DataFrame) -> tuple[list[int], int]:
    """Ids that cut the table into ranges of about :data:`ORDERED_TOGETHER` rows, at most :data:`MOST_RANGES`, and
    into how many parts the rows without an id are cut likewise."""
    n, named = docs.agg(F.count("*"), F.count("doc_id")).first()
    parts = max(1, min(MOST_RANGES, named // ORDERED_TOGETHER))
    nameless = max(1, min(MOST_RANGES, (n - named) // ORDERED_TOGETHER))
    if parts == 1:
        return [], nameless
    shares = [i / parts for i in range(1, parts)]
    found = docs.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), 10 * parts).alias("q")).first().q
    return sorted({int(q) for q in found or []}), nameless


def bounds_up_to(doc_id: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at or under the id, found in two steps: the group, then the place in it."""
    if not bounds:
        return F.lit(0)
    step = isqrt(len(bounds)) + 1
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    group = F.size(F.filter(F.lit([g[0] for g in groups]), lambda b: b <= doc_id))
    inside = F.size(F.filter(F.get(F.array(*map(F.lit, groups)), group - 1), lambda b: b <= doc_id))
    return F.when(group == 0, 0).otherwise((group - 1) * step + inside)


def in_ranges(rows: DataFrame, bounds: list[int], nameless: int) -> DataFrame:
    """With ``range``: larger ids in lower ranges; after them rows without an id, by ``tie``."""
    by_tie = F.least(F.floor((F.col("tie").cast("double") / HASHES + 0.5) * nameless), F.lit(nameless - 1))
    last = F.lit(len(bounds) + 1) + by_tie.cast("int")
    named = F.lit(len(bounds)) - bounds_up_to(F.col("doc_id"), bounds)
    return rows.withColumn("range", F.when(F.col("doc_id").isNull(), last).otherwise(named))


def heads(ranged: DataFrame) -> DataFrame:
    """``range, doc_id, text, tie``: the first row of each range, put at the end of the range before it (that of the
    first range at the end of the last). One id per range comes to the driver, to pick the rows by."""
    first = {row.range: row.doc_id for row in ranged.groupBy("range").agg(F.max("doc_id").alias("doc_id")).collect()}
    at = sorted(first)
    before = F.create_map(*(F.lit(x) for a, b in zip(at, at[-1:] + at[:-1]) for x in (a, b)))
    named = [doc_id for doc_id in first.values() if doc_id is not None]
    picked = ranged.filter(F.col("doc_id").isin(named) | F.col("doc_id").isNull())
    least = picked.groupBy("range", "doc_id").agg(F.min("tie").alias("tie"), F.min_by("text", "tie").alias("text"))
    return least.select(F.element_at(before, F.col("range")).alias("range"), "doc_id", "text", "tie")


def with_next(docs: DataFrame, following: dict[str, Column]) -> DataFrame:
    """``doc_id, text`` rows with the columns of ``following``, and ``next_text`` and ``next_<column>`` of the row that
    follows by descending ``doc_id``; the first follows the last.

    Rows without an id come last; rows of one id, and those without, go by ``tie``. Each range is ordered by itself.
    What follows its last row is the next range's first, of which a copy is put at its end: one row per range is all
    that crosses ranges.
    """
    tied = docs.withColumn("tie", F.xxhash64("text"))
    ranged = in_ranges(tied, *id_bounds(docs.select("doc_id"))).select("range", "doc_id", "text", "tie")
    if not ranged.head(1):
        rows = ranged.withColumn("ghost", F.lit(1))
    else:
        rows = ranged.withColumn("ghost", F.lit(0)).unionByName(heads(ranged).withColumn("ghost", F.lit(1)))
    rows = rows.withColumns(following)
    order = Window.partitionBy("range").orderBy("ghost", F.desc_nulls_last("doc_id"), "tie")
    for name in ["text", *following]:
        rows = rows.withColumn(f"next_{name}", F.lead(name).over(order))
    return rows.filter("ghost = 0").drop("range", "tie", "ghost")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, k: int = K) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, sketch, edited_sketch, near_edited, near_next``, one row per document.

    The edited text has its last half (rounded down, in code points) replaced by as much of the beginning of the next
    document, or all of that. A null text is an empty one. Repeated ids are ordered by their texts' hashes. An empty
    table gives an empty result.
    """
    rows = private(docs, ["doc_id", "text"]).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    paired = with_next(rows, {"sketch": sketch(F.col("text"), shingle, k)})
    half = F.floor(F.length("text") / 2)
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("next_text"), F.lit(1), half)
    )
    made = paired.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        edited.alias("edited"),
        "sketch",
        "next_sketch",
    )
    made = made.withColumn("edited_sketch", sketch(F.col("edited"), shingle, k))
    return made.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "sketch",
        "edited_sketch",
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
    )
