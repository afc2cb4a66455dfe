"""Ranked lexical search by range maxima over posting lists.

The corpus is indexed in blocks of documents. Within a block each term of the queries has a posting list by place, with
the term's integer impact on each document; a sparse table over the lists answers the largest impact, and its place, of
any range in two lookups. A query starts with the whole block as one interval. The interval with the largest bound, the
sum of its terms' range maxima, comes first: it is split at the document of the largest single impact, that document is
scored, and what lies to its left and right gets bounds of its own. Intervals under the score that a place among the
best takes by now are left; what remains of few documents is scored whole.

Frequencies come from all documents. A task carries each query's best from block to block, and hands on no more than
those. Queries are taken in groups of bounded size, each group in one pass over the corpus.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sunledger.llm.common import private, run_dir, stored

TOP = 50
#: Documents of one block of the index, and words of texts that close a block before.
BLOCK = 4096
BLOCK_WORDS = 4_000_000
#: Queries that one pass over the corpus answers, on average.
GROUP = 1000
#: An interval of no more documents is scored whole.
LEAF = 24
#: Intervals split at a time.
AT_ONCE = 48
#: What separates terms becomes a space, A-Z become a-z; bytes of other letters stay.
SEPARATED = bytes(
    b if b >= 128 or chr(b).isdigit() or chr(b).islower() else ord(chr(b).lower()) if chr(b).isupper() else 32
    for b in range(256)
)


def terms_of(text: str | bytes | None) -> list[bytes]:
    """Terms of a whole text, in order, as UTF-8."""
    data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
    return data.translate(SEPARATED).split()


# --- numbers ---


def weight(total: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1)))


def length_norms(words: np.ndarray, total: int, all_words: int) -> np.ndarray:
    """m of each document, in 64 bits as long as the products fit, else in Python's integers."""
    if 50 * int(words.max(initial=0)) * total < 2**63:
        return 50 + 50 * words * total // max(all_words, 1)
    return np.array([50 + 50 * n * total // all_words for n in words.tolist()], np.int64)


def impacts(w: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


# --- index ---

INDEXED = "ids array<bigint>, words array<bigint>, term array<int>, place array<int>, tf array<int>"


def indexed(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """One row per block: its documents' ids and lengths, and the postings of the vocabulary by term and place.

    ``vocabulary`` holds the terms of one group of queries, a bounded number. Documents without terms are not indexed.
    """
    handed = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def block(ids: list, words: list[int], found: list[dict[bytes, int]], known: dict[bytes, int]) -> pa.RecordBatch:
        sizes = np.array([len(f) for f in found], np.int64)
        term = np.fromiter((known[t] for f in found for t in f), np.int32, sizes.sum())
        tf = np.fromiter((n for f in found for n in f.values()), np.int32, sizes.sum())
        place = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
        order = np.argsort(term, kind="stable")
        lists = [pa.array([x], pa.list_(t)) for x, t in (
            (ids, pa.int64()), (words, pa.int64()), (term[order], pa.int32()), (place[order], pa.int32()), (tf[order], pa.int32()))]
        return pa.RecordBatch.from_arrays(lists, names=["ids", "words", "term", "place", "tf"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = handed.value
        wanted = known.keys()
        ids, words, found, seen = [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                terms = terms_of(text.as_py())
                if not terms:
                    continue
                counts = Counter(terms)
                ids.append(doc_id)
                words.append(len(terms))
                found.append({t: counts[t] for t in counts.keys() & wanted})
                seen += len(terms)
                if len(ids) == BLOCK or seen >= BLOCK_WORDS:
                    yield block(ids, words, found, known)
                    ids, words, found, seen = [], [], [], 0
        if ids:
            yield block(ids, words, found, known)

    source = private(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return source.mapInArrow(rows, INDEXED)


def document_frequencies(blocks: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents, all their terms, and how many documents hold each term of the vocabulary."""
    sums = blocks.agg(F.sum(F.size("ids")), F.sum(F.expr("aggregate(words, 0L, (a, x) -> a + x)"))).first()

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        for batch in batches:
            held += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(held)), pa.array(held[held > 0])], names=["term", "n"])

    counted = blocks.select("term").mapInArrow(partial, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    df = np.zeros(size, np.int64)
    for row in counted.collect():  # one row per term of a bounded group of queries
        df[row.term] = row.n
    return sums[0] or 0, sums[1] or 0, df


class Block:
    """Postings of one block by term and place, their impacts, and the sparse table of range maxima over them."""

    def __init__(self, term: np.ndarray, place: np.ndarray, impact: np.ndarray, documents: int):
        self.n = documents
        keep = impact > 0
        self.term, self.place, self.impact = term[keep].astype(np.int64), place[keep].astype(np.int64), impact[keep]
        #: Ascending, as the lists lie one after the other.
        self.key = self.term * documents + self.place
        # Level j holds, for each posting, where the largest impact of the 2^j postings from it on is. Ranges that run
        # into the next list are there too, but nothing asks for them.
        longest = int(np.bincount(self.term).max(initial=0))
        self.levels = [np.arange(len(self.impact), dtype=np.int32)]
        while 2 << (len(self.levels) - 1) <= longest:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            a, b = last[:-half], last[half:]
            self.levels.append(np.where(self.impact[b] > self.impact[a], b, a))

    def range_of(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.searchsorted(self.key, term * self.n), np.searchsorted(self.key, (term + 1) * self.n)

    def largest(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Where the largest impact of each range of postings is (0 for an empty one)."""
        size = np.maximum(stop - start, 1)
        level = np.log2(size).astype(np.int64)
        at = np.zeros(start.shape, np.int64)
        for j in np.unique(level):
            here = (level == j) & (stop > start)
            a, b = self.levels[j][start[here]], self.levels[j][stop[here] - (1 << j)]
            at[here] = np.where(self.impact[b] > self.impact[a], b, a)
        return at


@dataclass
class Best:
    """The best documents of one query so far: by score, then by id (rows without id last)."""

    top: int
    scores: np.ndarray
    ids: np.ndarray
    unnamed: np.ndarray

    @classmethod
    def none(cls, top: int) -> Best:
        return cls(top, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))

    @property
    def bar(self) -> int:
        """What a document must score at least to have a place."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        good = scores >= self.bar
        if good.any():
            scores, ids = np.append(self.scores, scores[good]), np.append(self.ids, ids[good])
            unnamed = np.append(self.unnamed, unnamed[good])
            order = np.lexsort((ids, unnamed, -scores))[: self.top]
            self.scores, self.ids, self.unnamed = scores[order], ids[order], unnamed[order]


def search(block: Block, terms: np.ndarray, ids: np.ndarray, unnamed: np.ndarray, best: Best) -> int:
    """Documents of the block that belong to the query's best, best-first; returns how many were scored."""
    start, stop = block.range_of(terms)
    held = stop > start
    terms, start, stop = terms[held], start[held], stop[held]
    if not len(terms):
        return 0
    scored = 0
    # One row per open interval: first and last place, bounds of the lists' ranges, and where their maxima are.
    low, high = np.zeros(1, np.int64), np.full(1, block.n)
    left, right = start[None, :], stop[None, :]
    peak = block.largest(left, right)
    bound = block.impact[peak].sum(axis=1)
    while len(bound):
        open_ = bound >= best.bar
        low, high, left, right, peak, bound = (x[open_] for x in (low, high, left, right, peak, bound))
        if not len(bound):
            break
        narrow = high - low <= LEAF
        if narrow.any():
            # Few documents: all their postings, summed by place.
            first, size = left[narrow].ravel(), (right[narrow] - left[narrow]).ravel()
            at = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
            where, inverse = np.unique(block.place[at], return_inverse=True)
            sums = np.zeros(len(where), np.int64)
            np.add.at(sums, inverse, block.impact[at])
            best.add(sums, ids[where], unnamed[where])
            scored += len(where)
            low, high, left, right, peak, bound = (x[~narrow] for x in (low, high, left, right, peak, bound))
            continue
        if len(bound) > AT_ONCE:
            order = np.argpartition(-bound, AT_ONCE)
            now, rest = order[:AT_ONCE], order[AT_ONCE:]
        else:
            now, rest = np.arange(len(bound)), np.zeros(0, np.int64)
        # Each is split at the document of its largest single impact, and that document scored.
        height = np.where(right[now] > left[now], block.impact[peak[now]], 0)
        middle = block.place[peak[now, height.argmax(axis=1)]]
        cut = np.searchsorted(block.key, terms * block.n + middle[:, None])
        cut = np.clip(cut, left[now], right[now])
        inside = cut < right[now]
        hit = inside & (block.key[np.where(inside, cut, 0)] == terms * block.n + middle[:, None])
        best.add(np.where(hit, block.impact[np.where(hit, cut, 0)], 0).sum(axis=1), ids[middle], unnamed[middle])
        scored += len(now)
        sides = (np.append(low[now], middle + 1), np.append(middle, high[now]),
                 np.vstack([left[now], cut + hit]), np.vstack([cut, right[now]]))
        some = sides[1] > sides[0]
        sides = tuple(x[some] for x in sides)
        top = block.largest(sides[2], sides[3])
        height = np.where(sides[3] > sides[2], block.impact[top], 0).sum(axis=1)
        low, high, left, right = (np.concatenate([x[rest], y]) for x, y in zip((low, high, left, right), sides))
        peak, bound = np.concatenate([peak[rest], top]), np.append(bound[rest], height)
    return scored


# --- queries ---


def ranked_in_blocks(blocks: DataFrame, queries: list[np.ndarray], numbers: tuple[int, int, np.ndarray], top: int) -> DataFrame:
    """``query, score, doc_id, part``: for each task and query, the best of the task's blocks."""
    total, all_words, df = numbers
    weights = np.array([weight(total, n) for n in df.tolist()], np.int64)
    handed = blocks.sparkSession.sparkContext.broadcast((queries, weights, total, all_words))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights, total, all_words = handed.value
        best = [Best.none(top) for _ in queries]
        for batch in batches:
            for i in range(batch.num_rows):
                held, words, term, place, tf = (batch.column(c)[i].values for c in range(5))
                unnamed = held.is_null().to_numpy(zero_copy_only=False)
                ids = held.fill_null(0).to_numpy()
                m = length_norms(words.to_numpy(), total, all_words)
                term, place = term.to_numpy(), place.to_numpy()
                block = Block(term, place, impacts(weights[term], tf.to_numpy().astype(np.int64), m[place]), len(ids))
                for terms, so_far in zip(queries, best):
                    search(block, terms, ids, unnamed, so_far)
        for query, so_far in enumerate(best):
            if len(so_far.ids):
                arrays = [pa.array(np.full(len(so_far.ids), query)), pa.array(so_far.scores)]
                arrays.append(pa.array(so_far.ids, mask=so_far.unnamed))
                yield pa.RecordBatch.from_arrays(arrays, names=["query", "score", "doc_id"])

    found = blocks.mapInArrow(rows, "query bigint, score bigint, doc_id bigint")
    return found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64)))


def first_of(rows: DataFrame, key: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*key).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def ranked(spark: SparkSession, docs: DataFrame, items: list[tuple[int | None, str | None]], top: int, path: str) -> DataFrame:
    """``item_id, rank, doc_id, score`` for a group of items."""
    found = [sorted(set(terms_of(text))) for _, text in items]
    vocabulary = {term: i for i, term in enumerate(sorted({t for terms in found for t in terms}))}
    blocks = stored(indexed(docs, vocabulary), f"{path}/index")
    queries = [np.array([vocabulary[t] for t in terms], np.int64) for terms in found]
    best = ranked_in_blocks(blocks, queries, document_frequencies(blocks, len(vocabulary)), top)
    # A task's best of a query are few; those of all tasks meet in two steps.
    best = first_of(first_of(best, ["query", "part"], top).drop("rank"), ["query"], top)
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(items)], "query bigint, item_id bigint")
    return best.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, benchmark: DataFrame, top: int = TOP, group: int = GROUP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item, equal scores by ascending id.

    Every row of ``docs`` is a document, repeated rows and ids included (equal ones get neighbouring ranks); among equal
    scores a row without id comes last. Null texts and texts without terms count nowhere. An item without terms, or
    whose terms no document holds, has no rows; repeated items count once, and an id with several texts is ranked for
    each of them. Empty tables give an empty result. Other columns are not looked at.
    """
    spark = docs.sparkSession
    path = run_dir(spark, "lexical")
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").distinct()
    items = stored(items.filter("text is not null"), f"{path}/items")
    # Groups by hash: about as many items in each, and about as much text.
    size = items.agg(F.count("*"), F.sum(F.length("text"))).first()
    groups = max(1, -(-size[0] // group), -(-(size[1] or 0) // (group * 2000)))
    of_group = F.pmod(F.xxhash64("item_id", "text"), F.lit(groups))
    out = []
    for i in range(groups):
        some = [(r.item_id, r.text) for r in items.filter(of_group == i).orderBy("item_id", "text").collect()]
        out.append(stored(ranked(spark, docs, some, top, f"{path}/{i}"), f"{path}/{i}/ranked"))
    return reduce(DataFrame.unionByName, out)
