import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as entry
from conftest import TESTDATA
from helpers import plan
from llm_edges import clashing, edge, none  # noqa: F401
from sunledger.llm import alignment as A
from sunledger.llm import common
from sunledger.llm.common import documents, importable
from sunledger.llm.queries import tokenizer_file

FILES = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def plain():
    """Ids and bytes of both tokenizers, straight from the libraries."""
    first = Tokenizer.from_file(FILES[0])
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    back = {c: b for b, c in zip([*range(33, 127), *range(161, 173), *range(174, 256)], map(chr, [*range(33, 127), *range(161, 173), *range(174, 256)]))}
    back |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if chr(b) not in back)}

    def tokens(text):
        if not text:
            return [], []
        a = [(i, bytes(back[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in second.encode(text):
            piece = second.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        same = b"".join(t for _, t in a) == whole == b"".join(t for _, t in b)
        return (a, b) if same else ([], [])

    return tokens


def plain_groups(a, b):
    """Groups by walking both lists of tokens."""
    out, at, to = [], [0, 0], [0, 0]
    group = ([], [])
    for _ in range(len(a) + len(b)):
        side = 0 if at[0] < len(a) and (to[0] <= to[1] or at[1] == len(b)) else 1
        i, data = (a, b)[side][at[side]]
        group[side].append(i)
        at[side], to[side] = at[side] + 1, to[side] + len(data)
        if to[0] == to[1]:
            out.append(group)
            group = ([], [])
    return out


def expected(rows, tokens):
    aligned = []
    for doc_id, text in rows:
        a, b = tokens(text)
        aligned.append((doc_id, len(a), len(b), plain_groups(a, b)))
    held = Counter()
    for *_, groups in aligned:
        held.update({(x, y) for g in groups for x in g[0] for y in g[1]})
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for doc_id, n_a, n_b, groups in aligned:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        text = ";".join(f"{','.join(map(str, g[0]))}|{','.join(map(str, g[1]))}" for g in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        best = sum(held[x] == most[x[0]] for x in links)
        out.append((doc_id, n_a, n_b, len(groups), len(links), best, sum(held[x] for x in links), digest))
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=str)


def test_query_against_a_walk_over_all_tokens(spark, plain):
    path = f"{TESTDATA}/sf0.01"
    rows = [(r.doc_id, r.text) for r in documents(spark, path).select("doc_id", "text").collect()]
    assert got(entry.queries()["op13_alignment"](spark, path)) == expected(rows, plain)


ODD = [
    "日本語のテキスト、漢字と😀😀絵文字", "▁ literal", "a▁b", "tab\t\ttab  two   three\n\n\nlines \r\n end ", "   ", "\n", "<s> <unk> </s> <|endoftext|>",
    "naïve café ʰʱ á ​ 　x", "don't I'LL 12345 3.14 ²³ ½", "\x00\x01\x7f\x85", "ﬁ Å ㎏ İi", "x" * 3000, "العربية עברית हिन्दी",
]


@pytest.mark.parametrize("work,wide,block", [(32_768, 65_536, 4096), (3, 0, 2), (1, 4, 1)])
def test_odd_texts_in_small_pieces(spark, plain, monkeypatch, work, wide, block):
    """Pieces of a few ends, groups counted by ids, blocks of a few documents: the same results."""
    importable(spark)
    monkeypatch.setattr(A.common_ends, "__defaults__", (work,))
    monkeypatch.setattr(A, "WIDE", wide)
    monkeypatch.setattr(A, "BLOCK_DOCS", block)
    rows = [*enumerate(ODD), *enumerate(ODD[:5], 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(A.align(docs, *FILES)) == expected(rows, plain)


def test_pieces_find_all_common_ends():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 50, 1000):
        end = max(3 * n, 1)
        a, b = (np.sort(rng.choice(end, min(n, end), replace=False)) for _ in "ab")
        for work in (1, 2, 7, 64, 10_000):
            x, y = A.common_ends(a, b, work)
            assert a[x].tolist() == b[y].tolist() == sorted(set(a.tolist()) & set(b.tolist()))
        d = np.arange(len(a) + len(b) + 1)
        if len(a) and len(b):
            merged = sorted([(v, 0) for v in a.tolist()] + [(v, 1) for v in b.tolist()])
            assert A.split_at(d, a, b).tolist() == [sum(s == 0 for _, s in merged[:k]) for k in d]


def test_both_byte_level_libraries_agree():
    """Every character up to the border, alone, between letters, digits, signs and blanks."""
    first = A.ByteTokens(FILES[0])
    assert first.fast is not None
    texts = [f" {x}{chr(c)}{y}" for c in range(ord(A.PLAIN)) for x, y in (("", ""), ("a", "b"), (" ", "1"), ("!", " a"), (" ", " "))]
    slow = [e.ids for e in first.slow.encode_batch_fast(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in first.encode(texts)] == slow


def test_edges_of_the_input(spark, edge, clashing, none, plain):
    importable(spark)
    rows = A.align(clashing, *FILES)
    assert tuple(rows.columns) == COLUMNS
    assert got(rows) == expected([(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()], plain)
    assert A.align(none, *FILES).count() == 0


def test_spark_carries_blocks_small(spark, plain):
    """What a block says of its documents is packed, a few bytes a pair: lists of whole numbers, copied by every read and
    shuffle, filled the executor."""
    importable(spark)
    rng = np.random.default_rng(3)
    words = np.array([f"{a}{b}{c}" for a in ("wo", "ka", "tre", "lin") for b in ("ra", "ni", "so", "mu", "pel") for c in ("n", "st", "ing", "er")])
    rows = [(i, " ".join(rng.choice(words, 400))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    blocks = A.aligned_blocks(docs, *FILES)
    held = len({(i, x, y) for i, text in rows for g in plain_groups(*plain(text)) for x in g[0] for y in g[1]})
    assert held > 20_000 and blocks.toArrow().nbytes < 5 * held
    rows_out = A.align(docs, *FILES)
    assert "REBALANCE_PARTITIONS" in plan(rows_out)
    assert got(rows_out) == expected(rows, plain)


def test_workers_let_go_of_the_tokenizers():
    assert A.tokenizers_of(*FILES) is A.tokenizers_of(*FILES) and common._KEPT
    common.release()
    assert not common._KEPT
