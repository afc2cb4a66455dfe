"""Best-fit packing of tokenised documents into sequences, after Martello and Toth's dominance reduction.

Pieces are integers from 1 to the capacity, so all that a packing depends on is how many pieces have each size: at most
2048 counts, whatever the corpus. The packing is computed on those counts, as patterns (sizes that share a sequence) and
how often each is used. First, a size is fixed for good wherever one set with it provably dominates every other:
whatever else an optimal packing would put beside the piece can be exchanged against that set. What is left goes by best
fit in decreasing order, again in bulk. The pieces then find their places in parallel, by their rank within their size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sunledger.llm.common import in_use, kept, private, run_dir, stored

CAPACITY = 2048
#: Pieces of one size that are put in order together.
BUCKET = 1000
#: Words whose ids a Python worker remembers.
REMEMBERED = 400_000
#: Characters tokenised at a time (a longer text goes alone).
AT_ONCE = 2_000_000
#: Characters after a word that are a token of their own to the tokenizer's splitter, in one run.
TAIL = ".,;:!?|)]}$%&*#\"-"
#: str.split() also splits at these; the tokenizer does not.
NOT_SPACE = "\x1c\x1d\x1e\x1f"

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


# --- tokens ---


class WordIds:
    """Token ids by word, remembered. White space separates tokens and no merge crosses it, so a text's ids are its
    words' ids in a row; each distinct word is tokenised once per worker as long as the memory has room."""

    def __init__(self, path: str, room: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.room = room
        self.known: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def learn(self, words: list[str]) -> list[bytes]:
        """Ids of each word. Words that are letters, marks or letters and then marks are one or two units to the
        splitter; they are tokenised in one go, and told apart by the ids that end a unit."""
        plain, units, odd = [], [], []
        for i, word in enumerate(words):
            core = word.rstrip(TAIL)
            if core.isalpha():
                plain.append(word)
                units.append(1 if len(core) == len(word) else 2)
            elif core:
                odd.append(i)
            else:
                plain.append(word)
                units.append(1)
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != sum(units):
            return self.whole(words)
        data = ids.tobytes()
        edges = [0, *(4 * ends[np.cumsum(units) - 1]).tolist()] if units else [0]
        found = [data[a:b] for a, b in zip(edges, edges[1:])]
        if odd:
            others = self.whole([words[i] for i in odd])
            for i, other in zip(odd, others):
                found.insert(i, other)
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        get = self.known.get
        out: list[list[bytes | None]] = []
        unknown: dict[str, bytes] = {}
        gaps = []
        for text in texts:
            if any(c in text for c in NOT_SPACE):
                out.append(self.whole([text]))
                continue
            words = text.split()
            found = list(map(get, words))
            if None in found:
                at = [i for i, ids in enumerate(found) if ids is None]
                missing = [words[i] for i in at]
                unknown.update(dict.fromkeys(missing))
                gaps.append((found, at, missing))
            out.append(found)
        if unknown:
            words = list(unknown)
            unknown = dict(zip(words, self.learn(words)))
            for found, at, missing in gaps:
                for i, word in zip(at, missing):
                    found[i] = unknown[word]
            if len(self.known) + len(unknown) <= self.room:
                self.known.update(unknown)
        return [b"".join(found) for found in out]


def word_ids(path: str) -> WordIds:
    return kept(("word ids", path), lambda: WordIds(path))


def _groups(texts: list[str]) -> Iterator[list[str]]:
    group, chars = [], 0
    for text in texts:
        group.append(text)
        chars += len(text)
        if chars >= AT_ONCE:
            yield group
            group, chars = [], 0
    yield group


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32[, ids]``: each document's ids and a closing 0, cut at the capacity.

    A null text is an empty one, and leaves the closing 0 alone. ``tokenizer`` is the path of the vocabulary file.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with in_use():
            encoder = word_ids(tokenizer)
            width = 4 * capacity
            for batch in batches:
                ids = iter(batch.column(0).to_pylist())
                for group in _groups([t or "" for t in batch.column(1).to_pylist()]):
                    out = []
                    for data in encoder.encode(group):
                        doc, data = next(ids), data + b"\0\0\0\0"
                        for start in range(0, len(data), width):
                            part = data[start : start + width]
                            out.append((doc, start // width, start // 4, len(part) // 4, zlib.crc32(part), part))
                    if out:
                        doc, piece, start, length, crc, part = zip(*out)
                        arrays = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32())]
                        arrays += [pa.array(x, pa.int64()) for x in (start, length, crc)]
                        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                        if with_ids:
                            arrays.append(pa.array([np.frombuffer(p, "<u4").astype(np.int32) for p in part], pa.list_(pa.int32())))
                            names.append("ids")
                        yield pa.RecordBatch.from_arrays(arrays, names=names)

    source = private(docs, ["doc_id", "text"]).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return source.mapInArrow(rows, PIECE + (", ids array<int>" if with_ids else ""))


# --- patterns from the counts of the sizes ---

Pattern = tuple[tuple[int, int], ...]  # (size, how many of it), largest size first


def _down(left: np.ndarray, size: int) -> int:
    """The largest size up to ``size`` that is left; 0 if none."""
    some = np.flatnonzero(left[: max(size, 0) + 1])
    return int(some[-1]) if len(some) else 0


def _smallest(left: np.ndarray, n: int) -> list[int]:
    """The n smallest pieces left (fewer if there are fewer)."""
    out: list[int] = []
    for size in np.flatnonzero(left):
        out += [int(size)] * min(n - len(out), int(left[size]))
        if len(out) == n:
            break
    return out


def dominating_set(left: np.ndarray, size: int, capacity: int) -> list[int] | None:
    """What to put beside one piece of ``size`` so that no other choice can lead to fewer sequences; None if no set
    of at most two further pieces is known to dominate. ``left`` does not count the piece itself.

    A set dominates when whatever else fits beside the piece can be dealt out over the set's pieces, each share no
    larger than its piece: exchanging the two then keeps every other sequence within the capacity.
    """
    room = capacity - size
    best = _down(left, room)
    if not best:
        return []
    if best == room:
        return [best]
    small = _smallest(left, 3)
    if len(small) < 2 or small[0] + small[1] > room:
        return [best]
    if len(small) < 3 or sum(small) > room:
        # One or two pieces fit. The largest first, then the largest beside it; it dominates if no pair has both
        # its pieces larger than the second one.
        left[best] -= 1
        second = _down(left, room - best)
        left[best] += 1
        larger = np.flatnonzero(left[second + 1 :])[:1] + second + 1
        if not len(larger):
            return [best] + [second] * (second > 0)
        pair = int(larger[0])
        left[: pair], held = 0, left[: pair].copy()
        two = _smallest(left, 2)
        left[: pair] = held
        if len(two) < 2 or sum(two) > room:
            return [best] + [second] * (second > 0)
    return None


def reduce_by_dominance(counts: np.ndarray, capacity: int) -> tuple[list[tuple[Pattern, int]], np.ndarray]:
    """Patterns that are fixed for good with their numbers, and the counts that remain."""
    left, fixed = counts.copy(), []
    changed = True
    while changed:
        changed = False
        for size in np.flatnonzero(left)[::-1].tolist():
            while left[size]:
                left[size] -= 1
                chosen = dominating_set(left, size, capacity)
                left[size] += 1
                if chosen is None:
                    break
                pattern = _pattern([size, *chosen])
                times = min(int(left[s]) // n for s, n in pattern)
                if chosen and sum(chosen) < capacity - size:
                    # Only a full sequence, or a piece alone, keeps dominating whatever else is used up meanwhile.
                    times = 1 if len(chosen) > 1 else _same_choice(left, size, chosen[0], capacity, times)
                for s, n in pattern:
                    left[s] -= n * times
                fixed.append((pattern, times))
                changed = True
    return fixed, left


def _same_choice(left: np.ndarray, size: int, other: int, capacity: int, most: int) -> int:
    """How often in a row {size, other} dominates: while the two smallest pieces stay, and one piece at most fits."""
    small = _smallest(left, 2)
    if size in small or other in small or len(small) < 2 or small[0] + small[1] <= capacity - size:
        return 1
    return most


def _pattern(sizes: list[int]) -> Pattern:
    values, n = np.unique(sizes, return_counts=True)
    return tuple(zip(values[::-1].tolist(), n[::-1].tolist()))


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """Best fit in decreasing order, size by size: pieces go where the least room is left that takes them. Sequences
    with the same content are handled together."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms = np.zeros(capacity + 1, bool)
    for size in np.flatnonzero(counts)[::-1].tolist():
        n = int(counts[size])
        while n:
            fits = np.flatnonzero(rooms[size:])
            if len(fits):
                room = int(fits[0]) + size
                content, many = open_[room].pop()
                if not open_[room]:
                    rooms[room] = False
            else:
                room, content, many = capacity, (), n
            each = room // size
            full = min(many, n // each)
            for times, k in ((full, each), (1 if full < many and n % each and full == n // each else 0, n % each)):
                if times:
                    open_.setdefault(room - k * size, []).append((content + (size,) * k, times))
                    rooms[room - k * size] = True
                    n -= times * k
                    many -= times
            if many and content:
                open_.setdefault(room, []).append((content, many))
                rooms[room] = True
    return [(_pattern(list(content)), times) for group in open_.values() for content, times in group]


def packing(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    fixed, left = reduce_by_dominance(np.asarray(counts, np.int64), capacity)
    return fixed + best_fit(left, capacity)


def slots(patterns: list[tuple[Pattern, int]]) -> dict[str, np.ndarray]:
    """Where the pieces of a size go, by their rank in it: from rank on, so many per sequence, the first sequence, the
    offset of the first. Sorted by size and rank; the table has one row for each size of each pattern."""
    rows, rank, sequence = [], {}, 0
    for pattern, times in patterns:
        offset = 0
        for size, n in pattern:
            rows.append((size, rank.get(size, 0), n, sequence, offset))
            rank[size] = rank.get(size, 0) + n * times
            offset += n * size
        sequence += times
    table = np.array(sorted(rows) or np.zeros((0, 5)), np.int64).reshape(-1, 5)
    return dict(zip(("size", "rank", "each", "sequence", "offset"), table.T))


# --- places ---

RANK_BITS = 48


def place(ranked: DataFrame, where: dict[str, np.ndarray]) -> DataFrame:
    """``sequence_id`` and ``offset`` of each piece from its ``length`` and ``rank`` (from 0) among those of its size."""
    names = [f.name for f in ranked.schema if f.name != "rank"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    keys = (where["size"] << RANK_BITS) + where["rank"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, (length << RANK_BITS) + rank, side="right") - 1
            local = rank - where["rank"][at]
            sequence = where["sequence"][at] + local // where["each"][at]
            offset = where["offset"][at] + local % where["each"][at] * length
            arrays = [batch.column(n) for n in names] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(rows, f"{schema}, sequence_id bigint, offset bigint")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``, one row per piece.

    Documents up to the capacity stay whole. Null ids and repeated rows are pieces like any other; equal ones take
    their places in any order. An empty table gives an empty result.
    """
    path = run_dir(docs.sparkSession, "packing")
    cut = stored(pieces(docs, tokenizer, capacity), f"{path}/pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for row in cut.groupBy("length").agg(F.count("*").alias("n")).collect():  # one row per size
        counts[row.length] = row.n
    # Ranks within a size: a bucket holds about so many pieces of it, however common the size.
    share = F.lit(np.maximum(1, -(-counts // BUCKET)).tolist())
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.element_at(share, F.col("length").cast("int") + 1))
    spread = cut.withColumn("bucket", bucket)
    sizes = spread.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = spread.withColumn("place", F.row_number().over(within)).join(sizes, ["length", "bucket"])
    ranked = ranked.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place") - 1).alias("rank")
    )
    return place(ranked, slots(packing(counts, capacity)))


def sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id, ids``: the packed sequences themselves. A group is one sequence, at most ``capacity`` ids."""
    placed = pack(docs, tokenizer, capacity)
    ids = pieces(docs, tokenizer, capacity, with_ids=True)
    # Equal pieces of repeated rows carry equal ids: any of them fits any of their places.
    per_piece = ids.dropDuplicates(["doc_id", "piece", "ids_crc32"]).select(
        F.col("doc_id").alias("of"), F.col("piece").alias("nth"), F.col("ids_crc32").alias("crc"), "ids"
    )
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("piece") == F.col("nth")) & (F.col("ids_crc32") == F.col("crc"))
    parts = placed.join(per_piece, same).groupBy("sequence_id").agg(F.collect_list(F.struct("offset", "ids")).alias("parts"))
    return parts.select("sequence_id", F.expr("flatten(transform(array_sort(parts), p -> p.ids))").alias("ids"))
