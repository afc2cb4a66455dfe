"""Alignment of two tokenizers' tokens by the bytes they cover.

Both tokenizations of a text end at the same last byte, and so do all groups: the byte offsets where tokens of both end
cut the text. Finding them is a merge of two rising lists of ends. Merge-path partitioning cuts that merge into pieces of
equal work: a binary search along each diagonal of the merge grid says how many ends of either list come before it, so
a piece knows its part of both lists without the pieces before. The texts of a batch lie end to end in one merge, so one long
text is as many pieces as it needs. A piece emits the overlaps it sees, which are the ends in common and how far either
list has come; what is open at a piece's border is stitched to the next into one group.

Which token of B best stands for a token of A depends on the whole corpus: for each pair of ids, how many documents
link it. Documents go in blocks, each with the sorted table of its distinct pairs. Counting adds up the tables, and the
counts come back to the blocks by table, once for each block and pair however many documents of the block hold it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import in_use, kept, private, rebalanced, release, run_dir, stored

#: Ends that one piece of a merge takes.
WORK = 32_768
#: Characters tokenised at a time (a longer text goes alone).
AT_ONCE = 1_000_000
#: A group with more links than this is counted by its distinct ids.
WIDE = 65_536
#: Documents, and distinct pairs of all its documents, that close a block.
BLOCK_DOCS = 4096
BLOCK_PAIRS = 500_000
#: Up to here the two libraries that know the byte-level vocabulary cut texts alike; others go the slower way.
PLAIN = "ʰ"


# --- tokens ---


def byte_of_char() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself where it is printable, and
    the characters from 256 on, in order, for the others."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteTokens:
    """Ids of a byte-level BPE vocabulary file and the bytes of each id."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        to_byte = byte_of_char()
        entries = self.slow.get_vocab(with_added_tokens=False)
        self.bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.bytes[i] = bytes(to_byte[c] for c in entry) if all(c in to_byte for c in entry) else entry.encode()
        self.fast = self._fast(path)

    def _fast(self, path: str):
        """The same vocabulary as ranks, where ids rise as merges do."""
        import json

        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"]["".join(m)] for m in merges]
        special = {t.content for t in self.slow.get_added_tokens_decoder().values()}
        ranks = {data: i for i, data in enumerate(self.bytes) if data and self.slow.id_to_token(i) not in special}
        if made != sorted(made) or len(ranks) != 256 + len(merges):
            return None
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = []
        odd = []
        for i, text in enumerate(texts):
            if self.fast and (text.isascii() or max(text) < PLAIN):
                out.append(np.array(self.fast.encode_ordinary(text), np.int64))
            else:
                out.append(None)
                odd.append(i)
        found = self.slow.encode_batch_fast([texts[i] for i in odd], add_special_tokens=False) if odd else []
        for i, encoding in zip(odd, found):
            out[i] = np.array(encoding.ids, np.int64)
        return out


class PieceTokens:
    """Ids of a piece model and the bytes of each id."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.vocab_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]


def tokenizers_of(a: str, b: str) -> tuple[ByteTokens, PieceTokens]:
    return kept(("alignment", a, b), lambda: (ByteTokens(a), PieceTokens(b)))


# --- merge ---


def split_at(diagonal: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of A's ends are among the first so many of the merge (of equal ends A's comes first), by binary search
    along each diagonal."""
    low, high = np.maximum(diagonal - len(b), 0), np.minimum(diagonal, len(a))
    while (low < high).any():
        middle = (low + high) // 2
        go = (low < high) & (a[np.minimum(middle, len(a) - 1)] <= b[np.clip(diagonal - 1 - middle, 0, len(b) - 1)])
        low, high = np.where(go, middle + 1, low), np.where(go, high, np.where(low < high, middle, high))
    return low


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of one piece: the places, in its parts of A and of B, of the ends that both have."""
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.searchsorted(b, a)
    same = b[np.minimum(at, len(b) - 1)] == a
    return np.flatnonzero(same), at[same]


def common_ends(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """The places in A and in B of all ends in common, in order, from pieces of ``work`` ends."""
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    diagonal = np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b))
    from_a = split_at(diagonal, a, b)
    from_b = diagonal - from_a
    in_a, in_b = [], []
    for a0, a1, b0, b1 in zip(from_a, from_a[1:], from_b, from_b[1:]):
        # A border may part an end of A from its equal in B: the piece that has B's takes A's last one along.
        open_ = int(a0 > 0 and b0 < b1 and a[a0 - 1] == b[b0])
        x, y = overlaps(a[a0 - open_ : a1], b[b0:b1])
        in_a.append(x + a0 - open_)
        in_b.append(y + b0)
    return np.concatenate(in_a), np.concatenate(in_b)


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``start, start + 1, ..`` of each range, one after the other."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())


class Aligned:
    """Texts of a batch, aligned: which tokens of A and B make each group, and which text each group is of."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], sizes_a: np.ndarray, sizes_b: np.ndarray):
        n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
        self.a, self.b = (np.concatenate(side) if side else np.zeros(0, np.int64) for side in (a, b))
        last_a, last_b = common_ends(np.cumsum(sizes_a[self.a]), np.cumsum(sizes_b[self.b]))
        self.stop_a, self.stop_b = last_a + 1, last_b + 1
        self.start_a, self.start_b = (np.append(0, x[:-1]) if len(x) else x for x in (self.stop_a, self.stop_b))
        self.size_a, self.size_b = self.stop_a - self.start_a, self.stop_b - self.start_b
        self.text = np.searchsorted(np.cumsum(n_a), self.start_a, side="right")
        self.texts = len(a)

    def groups(self) -> np.ndarray:
        return np.bincount(self.text, minlength=self.texts)

    def links(self) -> np.ndarray:
        out = np.zeros(self.texts, np.int64)
        np.add.at(out, self.text, self.size_a * self.size_b)
        return out

    def pairs(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text and distinct pair of ids, in order: the text, the pair (A's id times ``width``, plus B's), its links."""
        narrow = self.size_a * self.size_b <= WIDE
        of_a, times = ranges(self.start_a[narrow], self.size_a[narrow]), np.repeat(self.size_b[narrow], self.size_a[narrow])
        of_b = ranges(np.repeat(self.start_b[narrow], self.size_a[narrow]), times)
        text = np.repeat(np.repeat(self.text[narrow], self.size_a[narrow]), times)
        found = [(text, np.repeat(self.a[of_a], times) * width + self.b[of_b], np.ones(len(of_b), np.int64))]
        for g in np.flatnonzero(~narrow):
            x, n = np.unique(self.a[self.start_a[g] : self.stop_a[g]], return_counts=True)
            y, m = np.unique(self.b[self.start_b[g] : self.stop_b[g]], return_counts=True)
            found.append((np.full(len(x) * len(y), self.text[g]), (x[:, None] * width + y).ravel(), np.outer(n, m).ravel()))
        text, pair, times = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((pair, text)) if len(found) > 1 else np.argsort(text * 2**40 + pair)
        text, pair, times = text[order], pair[order], times[order]
        first = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (pair[1:] != pair[:-1]))[: len(pair)])
        return text[first], pair[first], np.add.reduceat(times, first) if len(first) else times

    def printed(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each text: decimal ids in order."""
        n = len(self.a) + len(self.b)
        ids, sign = np.zeros(n, np.int64), np.full(n, ord(","), np.uint8)
        # A group's tokens of A stand after all of B's before it, and its tokens of B after them.
        ids[np.arange(len(self.a)) + np.repeat(self.start_b, self.size_a)] = self.a
        ids[np.arange(len(self.b)) + np.repeat(self.stop_a, self.size_b)] = self.b
        sign[self.stop_a + self.start_b - 1] = ord("|")
        sign[self.stop_a + self.stop_b - 1] = ord(";")
        digits, size = decimal(int(ids.max(initial=0)))
        table = digits[ids]
        table[np.arange(n), size[ids]] = sign
        length = size[ids] + 1
        data = table[np.arange(table.shape[1]) < length[:, None]].tobytes()
        at = np.append(0, np.cumsum(length))
        # The last group of each text says where it ends; its closing sign is left out.
        ends = np.zeros(self.texts, np.int64)
        ends[self.text] = at[self.stop_a + self.stop_b]
        starts = np.append(0, np.maximum.accumulate(ends)[:-1])
        return [data[s : e - 1] if e else b"" for s, e in zip(starts.tolist(), ends.tolist())]


@lru_cache(maxsize=4)
def decimal_of_width(width: int) -> tuple[np.ndarray, np.ndarray]:
    text = np.array([str(i).encode() for i in range(10**width)], f"S{width + 1}")
    return text.view(np.uint8).reshape(-1, width + 1), np.char.str_len(text)


def decimal(largest: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of each number up to ``largest``, with room for a sign, and how many there are."""
    return decimal_of_width(max(len(str(largest)), 1))


# --- documents ---


def tokens(texts: list[str | None], a: str, b: str) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Ids of both tokenizers; none where the bytes of one are not those of the text after a space."""
    first, second = tokenizers_of(a, b)
    none = np.zeros(0, np.int64)
    # A lone surrogate has no bytes in UTF-8, and neither tokenizer takes it.
    here = [i for i, t in enumerate(texts) if t and encodable(t)]
    out_a, out_b = [none] * len(texts), [none] * len(texts)
    found_a, found_b = first.encode([f" {texts[i]}" for i in here]), second.encode([texts[i] for i in here])
    for i, x, y in zip(here, found_a, found_b):
        data = f" {texts[i]}".encode()
        if b"".join(map(first.bytes.__getitem__, x.tolist())) == data == b"".join(map(second.bytes.__getitem__, y.tolist())):
            out_a[i], out_b[i] = x, y
    return out_a, out_b


def encodable(text: str) -> bool:
    try:
        text.encode()
    except UnicodeEncodeError:
        return False
    return True


DOCUMENT = {"doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string()}
#: Per document how many distinct pairs it holds; over all of them, the place of the pair in the block's table and its
#: links.
HELD = {"held": pa.int64(), "place": pa.int32(), "links": pa.int64()}
#: A block's documents are read again by Python alone, so Spark carries them packed, as one value that is small beside
#: the lists. The table is Spark's to count: each pair and the documents of the block that hold it.
BLOCKS = "block bigint, documents binary, pair array<bigint>, docs array<bigint>"


def packed(lists: dict, types: dict[str, pa.DataType]) -> bytes:
    batch = pa.RecordBatch.from_arrays([pa.array([lists[c]], pa.list_(types[c])) for c in types], names=list(types))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(data: pa.Buffer) -> dict[str, pa.Array]:
    batch = pa.ipc.open_stream(data).read_next_batch()
    return {c: batch.column(i)[0].values for i, c in enumerate(batch.schema.names)}


def aligned_blocks(docs: DataFrame, a: str, b: str) -> DataFrame:
    """Documents in blocks (see :data:`HELD`), every text aligned."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with in_use():
            yield from blocks_of(batches)

    def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first, second = tokenizers_of(a, b)
        sizes_a, sizes_b = (np.array([len(x) for x in t.bytes], np.int64) for t in (first, second))
        number = TaskContext.get().partitionId() << 32
        parts: list[dict] = []
        n, pairs = 0, 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at, texts in grouped(batch.column(1).to_pylist()):
                parts.append(aligned_part(ids[at : at + len(texts)], *tokens(texts, a, b), sizes_a, sizes_b))
                n, pairs = n + len(texts), pairs + len(parts[-1]["pair"])
                if n >= BLOCK_DOCS or pairs >= BLOCK_PAIRS:
                    yield block_row(number, parts)
                    number, parts, n, pairs = number + 1, [], 0, 0
        if parts:
            yield block_row(number, parts)

    source = private(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return source.mapInArrow(rows, BLOCKS)


def grouped(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    at, chars, group = 0, 0, []
    for text in texts:
        group.append(text)
        chars += len(text or "")
        if chars >= AT_ONCE or len(group) >= BLOCK_DOCS:
            yield at, group
            at, chars, group = at + len(group), 0, []
    if group:
        yield at, group


def aligned_part(ids: list, a: list[np.ndarray], b: list[np.ndarray], sizes_a: np.ndarray, sizes_b: np.ndarray) -> dict:
    found = Aligned(a, b, sizes_a, sizes_b)
    text, pair, links = found.pairs(len(sizes_b))
    return {
        "doc_id": ids,
        "n_a": [len(x) for x in a],
        "n_b": [len(x) for x in b],
        "n_groups": found.groups().tolist(),
        "n_links": found.links().tolist(),
        "groups_sha256": [hashlib.sha256(p).hexdigest() if p else "" for p in found.printed()],
        "held": np.bincount(text, minlength=len(ids)),
        "links": links,
        "pair": pair,
    }


def block_row(number: int, parts: list[dict]) -> pa.RecordBatch:
    pair = np.concatenate([p["pair"] for p in parts])
    table, place, docs = np.unique(pair, return_inverse=True, return_counts=True)
    whole = {c: [x for p in parts for x in p[c]] for c in DOCUMENT}
    whole |= {"held": np.concatenate([p["held"] for p in parts]), "links": np.concatenate([p["links"] for p in parts])}
    whole["place"] = place.astype(np.int32)
    table, docs = (pa.array([x], pa.list_(pa.int64())) for x in (table, docs))
    documents = pa.array([packed(whole, DOCUMENT | HELD)], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([number]), documents, table, docs], names=["block", "documents", "pair", "docs"])


def pair_counts(blocks: DataFrame, width: int) -> DataFrame:
    """``pair, n, best``: documents that hold the pair linked, and whether no pair of its A id has more."""
    table = blocks.select(F.explode(F.arrays_zip("pair", "docs")).alias("t")).select("t.pair", "t.docs")
    counted = table.groupBy("pair").agg(F.sum("docs").alias("n"))
    counted = counted.withColumn("a", F.expr(f"pair div {width}"))
    most = counted.groupBy(F.col("a").alias("of_a")).agg(F.max("n").alias("most"))
    joined = counted.join(most, F.col("a") == F.col("of_a"))
    return joined.select(F.col("pair").alias("counted"), "n", (F.col("n") == F.col("most")).alias("best"))


RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def with_counts(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows of documents, with what the corpus-wide counts say of their links. Each pair of a block's table is looked
    up once, and each block meets its table's counts in a task of its own."""
    table = blocks.select(F.col("block").alias("of"), F.posexplode("pair").alias("at", "pair"))
    found = table.join(counts, F.col("pair") == F.col("counted")).select("of", "at", "n", "best")

    def rows(block: pa.Table, table: pa.Table) -> pa.Table:
        release()
        one = unpacked(block.column("documents").chunk(0)[0].as_buffer())
        n, best = np.zeros(table.num_rows, np.int64), np.zeros(table.num_rows, bool)
        at = table.column("at").to_numpy()
        n[at], best[at] = table.column("n").to_numpy(), table.column("best").to_numpy()
        place, links = one["place"].to_numpy(), one["links"].to_numpy()
        ends = np.append(0, np.cumsum(one["held"].to_numpy()))
        sums = [np.append(0, np.cumsum(links * x[place])) for x in (best, n)]
        n_best, count_sum = (pa.array(np.diff(s[ends])) for s in sums)
        columns = {c: one[c] for c in DOCUMENT} | {"n_best": n_best, "count_sum": count_sum}
        return pa.table({c.split()[0]: columns[c.split()[0]] for c in RESULT.split(", ")})

    # Blocks meet their counts in many tasks, whose rows of documents are few: they go on in partitions of a useful size.
    return rebalanced(blocks.select("block", "documents").groupBy("block").cogroup(found.groupBy("of")).applyInArrow(rows, RESULT))


def align(docs: DataFrame, a: str, b: str) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``a`` is the file of a byte-level BPE vocabulary, ``b`` that of a piece model. Null and empty texts, and texts that
    either tokenizer does not give back byte by byte (a literal U+2581, a lone surrogate), have no tokens: zeros, and
    the empty text for their groups. Repeated rows count as documents of their own, and a null id is handed on. An
    empty table gives an empty result. Other columns are not looked at.
    """
    path = run_dir(docs.sparkSession, "alignment")
    blocks = stored(aligned_blocks(docs, a, b), f"{path}/blocks")
    counts = stored(pair_counts(blocks, len(PieceTokens(b).bytes)), f"{path}/counts")
    return with_counts(blocks, counts)
