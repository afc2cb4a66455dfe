import random
import weakref
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from conftest import TESTDATA
from llm_edges import clashing, edge, none  # noqa: F401
from sunledger.llm import common
from sunledger.llm import packing as P
from sunledger.llm.queries import tokenizer_file


def optimum(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for b in {room: k for k, room in enumerate(bins)}.values():
            if bins[b] + items[i] <= capacity:
                bins[b] += items[i]
                go(i + 1, bins)
                bins[b] -= items[i]
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


def spread(patterns, capacity):
    out = np.zeros(capacity + 1, int)
    for pattern, times in patterns:
        assert times > 0 and sum(s * n for s, n in pattern) <= capacity
        for s, n in pattern:
            out[s] += n * times
    return out


def test_reduction_keeps_an_optimum_and_fit_uses_all():
    rng, worse = random.Random(2), 0
    for _ in range(1500):
        capacity = rng.choice([10, 20, 30, 64])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(0, 10))]
        counts = np.bincount(items, minlength=capacity + 1)
        fixed, left = P.reduce_by_dominance(counts, capacity)
        rest = [s for s in range(capacity + 1) for _ in range(left[s])]
        best = optimum(items, capacity)
        assert sum(t for _, t in fixed) + optimum(rest, capacity) == best
        patterns = P.packing(counts, capacity)
        assert (spread(patterns, capacity) == counts).all()
        worse += sum(t for _, t in patterns) - best
    assert worse <= 5


def test_many_pieces_are_near_the_bound():
    sizes = np.minimum(2048, np.random.default_rng(0).lognormal(6.2, 1, 400_000).astype(int) + 1)
    counts = np.bincount(sizes, minlength=2049)
    patterns = P.packing(counts)
    assert (spread(patterns, 2048) == counts).all()
    assert sum(t for _, t in patterns) <= 1.005 * sizes.sum() / 2048


def slow_pieces(rows, capacity=2048):
    tokenizer, out = Tokenizer.from_file(tokenizer_file()), []
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for at in range(0, len(ids), capacity):
            part = ids[at : at + capacity]
            out.append((doc_id, at // capacity, at, len(part), zlib.crc32(part.tobytes())))
    return sorted(out, key=str)


def check(placed, rows, capacity=2048):
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in placed), key=str) == slow_pieces(rows, capacity)
    by_sequence = defaultdict(list)
    for r in placed:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_query(spark):
    import __spark_entry__ as entry

    rows = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()
    placed = entry.queries()["op9_best_fit_packing"](spark, f"{TESTDATA}/sf0.001").collect()
    used = check(placed, [tuple(r) for r in rows])
    assert used <= 1.02 * sum(r.length for r in placed) / 2048 + 1


@pytest.mark.parametrize("capacity", [7, 2048])
def test_edges_of_the_input(edge, clashing, capacity):
    check(P.pack(clashing, tokenizer_file(), capacity).collect(), [tuple(r)[:2] for r in edge.collect()], capacity)


def test_empty_table(none):
    assert P.pack(none, tokenizer_file()).count() == 0


def test_sequences_hold_all_ids(edge):
    rows = [tuple(r)[:2] for r in edge.collect()]
    total = sum(length for _, _, _, length, _ in slow_pieces(rows))
    made = P.sequences(edge, tokenizer_file()).collect()
    assert sum(len(r.ids) for r in made) == total and max(len(r.ids) for r in made) <= 2048


def test_remembered_words_give_the_same_ids():
    """Words apart, text whole: odd spaces, marks, numbers, contractions, special tokens, a full memory."""
    texts = [
        "It's 12,345 dogs' don't -- \"quoted\"... x_y a|b | c##d",
        "<|startoftext|> in a text<|endoftext|>.",
        "étude Å ﬁn ΣΑΣ İstanbul ǅ",
        "a b c　d\u0085e\x1cf\x1dg",
        "\ud83d".encode("utf-16", "surrogatepass").decode("utf-16", "replace") + " tail",
        "WORD word Word, word. (word) [word] {word} word!? “word”",
        "",
        " \n\t ",
    ]
    whole = Tokenizer.from_file(tokenizer_file())
    for room in (0, 5, 1000):
        encoder = P.WordIds(tokenizer_file(), room)
        for _ in range(2):
            got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
            assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(encoder.known) <= room


def test_a_worker_lets_go_of_the_tokenizer():
    """The stage after this one needs the memory: nothing else holds the tokenizer and the words it knows."""
    common.release()
    encoder = P.word_ids(tokenizer_file())
    assert P.word_ids(tokenizer_file()) is encoder
    gone = weakref.ref(encoder)
    del encoder
    common.release()
    assert gone() is None
