"""Near-duplicate groups by circulant MinHash.

A document is the set of its distinct shingles of words. Two permutations of the 2^32 codes make a whole signature: the
first scatters the shingles' codes, the second, circularly shifted by one more place for each coordinate, gives the
minima. Coordinates go into bands; documents that share a band meet, and the Jaccard similarity of their full sets decides.

Equal sets are one node of the search, so copies cost it nothing. In a bucket of near copies nobody meets everybody: first
each member meets the bucket's leaders, a fixed number of members that hashes choose, anew in each of the 32 bands. Only
members that are still in different components of what was found then meet each other, so no link that joins components
is lost, and a group that holds together costs as many pairs as it has rows. Before they meet, those drop out of which
more than a fifth is in no other set of these buckets: that bounds their similarity to anything below the threshold.
A bucket that is still crowded is cut into blocks, and each two blocks are compared as tables of bits in a task of their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import private, run_dir, stored
from sunledger.llm.components import components

SHINGLE = 4
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 80
#: At similarity 0.8 all bands miss a pair once in 330,000; from 0.9 on, less than once in 10^12.
BANDS, ROWS = 32, 5
#: Members of a bucket that all others of it meet.
LEADERS = 2
#: A bucket with more members that are apart than this is compared block by block, and others pair by pair.
CROWD = 32
BLOCK = 256
#: Columns of a block's table at a time.
COLUMNS = 8192
#: Words whose hashes a Python worker remembers.
REMEMBERED = 400_000
#: Bytes of a text taken into words at a time.
PART = 4_000_000
SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Odd multipliers: of a shingle's words by their place, and of the two permutations.
PLACES = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93]
FIRST = (0x85EBCA6B, 0xC2B2AE35)
SECOND = (0x7FEB352D, 0x846CA68B)


# --- sets ---


class WordHashes(dict):
    """64-bit hash of each word, remembered as long as there is room."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = found
        return found


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of the 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def words_of(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, part by part; bytes.lower() turns A-Z alone, and split() knows the same white space."""
    at = 0
    while at < len(data):
        end = SPACE.search(data, at + PART)
        stop = end.start() if end else len(data)
        yield data[at:stop].lower().split()
        at = stop


def shingle_set(data: bytes | None, known: WordHashes, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct shingles, in order: none without words, one for fewer words than a shingle has."""
    hashes = [np.fromiter(map(known.__getitem__, words), np.uint64, len(words)) for words in words_of(data or b"")]
    word = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    if not len(word):
        return word
    size = min(shingle, len(word))
    n = len(word) - size + 1
    total = np.full(n, size, np.uint64)
    for place in range(size):
        total = mixed(total * np.uint64(PLACES[place % 4]) + word[place : place + n])
    return np.unique(total)


# --- signatures ---


def permute(x: np.ndarray, by: tuple[int, int], spare: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit codes, in place."""
    for shift, factor in ((16, by[0]), (15, by[1])):
        np.right_shift(x, np.uint32(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)
        np.multiply(x, np.uint32(factor), out=x)
    np.right_shift(x, np.uint32(16), out=spare)
    return np.bitwise_xor(x, spare, out=x)


def signature(found: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """Coordinate k is the least value of the second permutation, shifted by k, over the first one's codes."""
    codes = (found ^ (found >> np.uint64(32))).astype(np.uint32)
    codes = permute(codes, FIRST, np.empty_like(codes))
    shifts = np.arange(1, size + 1, dtype=np.uint32)
    out = np.full(size, np.iinfo(np.uint32).max, np.uint32)
    spare, room = np.empty((128, size), np.uint32), np.empty((128, size), np.uint32)
    for at in range(0, len(codes), 128):
        some = codes[at : at + 128]
        shifted = np.subtract(some[:, None], shifts, out=room[: len(some)])
        np.minimum(out, permute(shifted, SECOND, spare[: len(some)]).min(axis=0), out=out)
    return out


def band_keys(coordinates: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key a band, its number included."""
    table = coordinates.reshape(bands, -1).astype(np.uint64)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for column in table.T:
        keys = mixed(keys * np.uint64(PLACES[0]) + column)
    return keys.view(np.int64)


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[bytes | None]:
    for value in batch.column(column).cast(pa.binary()):
        yield value.as_py()


def node_of(found: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return xxhash.xxh3_128_digest(found.tobytes())


def signed(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, at, node, n, keys``: per document the hash of its text, the name of its set (null for the empty one),
    the set's size and its bands' keys."""
    rows_of = private(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("bigint"), "text", text_hash().alias("at"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            nodes, sizes, keys = [], [], []
            for text in _texts(batch, 1):
                found = shingle_set(text, known, shingle)
                sizes.append(len(found))
                nodes.append(node_of(found) if len(found) else None)
                keys.append(band_keys(signature(found)) if len(found) else None)
            arrays = [batch.column(0), batch.column(2), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64())]
            arrays.append(pa.array(keys, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "at", "node", "n", "keys"])

    return rows_of.mapInArrow(rows, "doc_id bigint, at bigint, node binary, n bigint, keys array<bigint>")


def text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


# --- pairs ---


def could_link(n: str, m: str, percent: int = PERCENT) -> Column:
    """Sets of these sizes can be similar enough; no link fails this."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def crowded(nodes: DataFrame) -> DataFrame:
    """``key, node, n`` in buckets of two or more."""
    keyed = nodes.select(F.explode("keys").alias("key"), "node", "n")
    shared = nodes.select(F.explode("keys").alias("shared")).groupBy("shared").agg(F.count("*").alias("size"))
    return keyed.join(shared.filter("size > 1"), F.col("key") == F.col("shared"), "left_semi")


def leader_pairs(members: DataFrame, percent: int, leaders: int = LEADERS) -> DataFrame:
    """Each member of a bucket with the bucket's leaders: those with the least of so many hashes."""
    least = [F.min(F.struct(F.xxhash64("node", "key", F.lit(i)), "node", "n")) for i in range(leaders)]
    chosen = members.groupBy(F.col("key").alias("led")).agg(*(c.alias(f"by{i}") for i, c in enumerate(least)))
    named = [F.struct(f"by{i}.node", f"by{i}.n") for i in range(leaders)]
    chosen = chosen.select("led", F.explode(F.array_distinct(F.array(*named))).alias("leader"))
    met = members.join(chosen, F.col("key") == F.col("led")).filter("node <> leader.node")
    met = met.filter(could_link("n", "leader.n", percent))
    return ordered(met.select(F.col("node").alias("u"), F.col("leader.node").alias("v")))


def apart(members: DataFrame, links: DataFrame, path: str) -> DataFrame:
    """Members of the buckets that the links leave in several components, with their roots."""
    roots = components(links, f"{path}/roots").withColumnRenamed("u", "node")
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = placed.withColumn("mark", F.xxhash64("root"))
    # Both are taken map-side: a bucket of any size sends one row for each task.
    split = placed.groupBy(F.col("key").alias("split")).agg(F.min("mark").alias("low"), F.max("mark").alias("high"))
    split = split.filter("low <> high").select("split")
    placed = placed.join(split, F.col("key") == F.col("split"), "left_semi").drop("mark")
    return stored(placed, f"{path}/placed")


def alone(sets: DataFrame, percent: int) -> DataFrame:
    """Nodes of which too many members are in no other of the sets: whatever they meet, the bound is missed."""
    member = sets.select("node", F.size("members").alias("n"), F.explode("members").alias("member"))
    once = member.groupBy("member").agg(F.count("*").alias("c"), F.any_value(F.struct("node", "n")).alias("of"))
    once = once.filter("c = 1").groupBy("of.node", "of.n").agg(F.count("*").alias("own"))
    return once.filter(F.col("n") * percent > (F.col("n") - F.col("own")) * 100).select("node")


def sized(placed: DataFrame) -> DataFrame:
    """With ``size``, the members left in the bucket."""
    sizes = placed.groupBy(F.col("key").alias("counted")).agg(F.count("*").alias("size"))
    return placed.join(sizes, F.col("key") == F.col("counted")).drop("counted")


def apart_pairs(placed: DataFrame, tried: DataFrame, percent: int) -> DataFrame:
    """Pairs of one bucket that no chain of links joins yet, without those that were tried."""
    other = placed.select("key", F.col("node").alias("v"), F.col("n").alias("m"), F.col("root").alias("to"))
    met = placed.withColumnRenamed("node", "u").join(other, "key").filter("root <> to and u > v")
    met = met.filter(could_link("n", "m", percent)).select("u", "v").distinct()
    return met.join(tried, ["u", "v"], "left_anti")


def block_links(placed: DataFrame, sets: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """``u, v``: links that join the components of each bucket, every two of its members compared in some pair of blocks."""
    blocks = F.ceil(F.col("size") / block).cast("int")
    dealt = placed.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    dealt = dealt.select("key", "node", "root", "own", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    dealt = dealt.select("key", "node", "root", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    rows = dealt.join(sets, "node")

    def compare(table: pa.Table) -> pa.Table:
        at = linked_rows(*(table.column(c).to_pylist() for c in ("root", "members")), percent)
        nodes = table.column("node").to_pylist()
        pairs = [[nodes[i] for i in side] for side in (at if at else ((), ()))]
        return pa.table({c: pa.array(side, pa.binary()) for c, side in zip("uv", pairs)})

    return rows.groupBy("key", "low", "high").applyInArrow(compare, "u binary, v binary").distinct()


def linked_rows(roots: list[bytes], sets: list[list[int]], percent: int) -> tuple[list[int], list[int]] | None:
    """Rows whose sets are similar enough, as few as join what the roots leave apart."""
    sizes = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(len(sets)), sizes)
    _, column = np.unique(np.concatenate([np.array(s, np.int64) for s in sets]), return_inverse=True)
    often = np.bincount(column) > 1
    place, kept = np.cumsum(often) - 1, often[column]
    row, column = row[kept], place[column[kept]]
    shared = np.zeros((len(sets), len(sets)))
    for low in range(0, int(often.sum()), COLUMNS):
        here = (column >= low) & (column < low + COLUMNS)
        bits = np.zeros((len(sets), min(COLUMNS, int(often.sum()) - low)), np.float32)
        bits[row[here], column[here] - low] = 1
        shared += bits @ bits.T
    _, name = np.unique(np.array([r.hex() for r in roots]), return_inverse=True)
    close = shared * 100 >= (sizes[:, None] + sizes - shared) * percent
    left, right = np.nonzero(np.triu(close & (name[:, None] != name), 1))
    out: tuple[list[int], list[int]] = ([], [])
    for i, j in zip(left.tolist(), right.tolist()):
        if name[i] != name[j]:
            name[name == name[i]] = name[j]
            out[0].append(i)
            out[1].append(j)
    return out if out[0] else None


def sets_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, shingle: int, path: str) -> DataFrame:
    """``node, members``: the full sets of the wanted nodes, from one text each."""
    texts = nodes.join(wanted, "node", "left_semi").select("first.*")
    texts = texts.select(F.col("doc_id").alias("of_id"), F.col("at").alias("of_text"))
    rows_of = private(docs, ["doc_id", "text"]).withColumn("at", text_hash())
    same = (F.col("at") == F.col("of_text")) & F.col("doc_id").cast("bigint").eqNullSafe(F.col("of_id"))
    rows_of = rows_of.join(texts, same, "left_semi").select("text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            found = [shingle_set(text, known, shingle) for text in _texts(batch, 0)]
            for at in range(0, len(found), 256):
                some = found[at : at + 256]
                arrays = [pa.array([node_of(s) for s in some], pa.binary())]
                arrays.append(pa.array([s.view(np.int64) for s in some], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(arrays, names=["node", "members"])

    found = rows_of.mapInArrow(rows, "node binary, members array<bigint>")
    # Repeated rows of one id and text give a set twice.
    return stored(found.dropDuplicates(["node"]), path)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    left, right = (sets.select(F.col("node").alias(f"{c}_node"), F.col("members").alias(f"{c}_set")) for c in "uv")
    both = pairs.join(left, F.col("u") == F.col("u_node")).join(right, F.col("v") == F.col("v_node"))
    shared = F.size(F.array_intersect("u_set", "v_set"))
    both = both.withColumn("shared", shared.cast("bigint"))
    union = F.size("u_set") + F.size("v_set") - F.col("shared")
    return both.filter(F.col("shared") * 100 >= union * percent).select("u", "v")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    The component's name is the smallest id reachable over links, itself included; a null id only where all its ids are
    null. Null texts and texts without words have no shingles and link with nothing: they keep their own id. Repeated
    rows give repeated results. ``kept`` is whether the two ids are equal, both null included. An empty table gives an
    empty result. Other columns are not looked at.
    """
    path = run_dir(docs.sparkSession, "minhash")
    rows = stored(signed(docs, shingle), f"{path}/rows")
    first = F.min(F.struct("doc_id", "at")).alias("first")
    nodes = rows.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"), first, F.any_value("n").alias("n"), F.any_value("keys").alias("keys"))
    nodes = stored(nodes, f"{path}/nodes")
    members = stored(crowded(nodes), f"{path}/members")

    def nodes_of(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()

    led = stored(leader_pairs(members, percent), f"{path}/led")
    sets = sets_of(docs, nodes, nodes_of(led), shingle, f"{path}/led-sets")
    links = stored(verified(led, sets, percent), f"{path}/led-links")

    placed = apart(members, links, f"{path}/apart")
    sets = sets_of(docs, nodes, placed.select("node").distinct(), shingle, f"{path}/apart-sets")
    lone = stored(alone(sets, percent), f"{path}/alone")
    left = stored(sized(placed.join(lone, "node", "left_anti")), f"{path}/left")
    met = stored(apart_pairs(left.filter(F.col("size") <= CROWD), led, percent), f"{path}/met")
    found = verified(met, sets, percent).union(block_links(left.filter(F.col("size") > CROWD), sets, percent))
    links = links.union(stored(found, f"{path}/met-links"))

    roots = components(links, f"{path}/components").withColumnRenamed("u", "node")
    placed = nodes.select("node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = stored(placed, f"{path}/placed")
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.select("node", "root").join(names, "root").select("node", "component_id")
    linked = rows.filter("n > 0").join(named, "node").select("doc_id", "n", "component_id")
    empty = rows.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    every = linked.unionByName(empty)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return every.select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))
