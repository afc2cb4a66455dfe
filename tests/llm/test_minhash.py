import re
from itertools import combinations

import numpy as np
import pytest

import __spark_entry__ as entry
from conftest import TESTDATA
from llm_edges import clashing, edge, none  # noqa: F401
from sunledger.llm import minhash as M
from sunledger.llm.common import documents, importable


def plain_set(text, shingle=4):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))} if words else set()


def expected(rows, shingle=4, percent=80):
    """``(n, component)`` of each row, by comparing all pairs of texts."""
    sets = [plain_set(text, shingle) for _, text in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(range(len(rows)), 2):
        if min(len(sets[a]), len(sets[b])) * 100 >= percent * max(len(sets[a]), len(sets[b])) > 0:
            shared = len(sets[a] & sets[b])
            if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                root[top(a)] = top(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        ids = [x for x in (least.get(top(i)), doc_id) if x is not None]
        least[top(i)] = min(ids) if ids else None
    return sorted(((d, len(sets[i]), least[top(i)]) for i, (d, _) in enumerate(rows)), key=str)


def got(rows):
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_against_all_pairs(spark, sf):
    path = f"{TESTDATA}/sf{sf}"
    rows = [(r.doc_id, r.text) for r in documents(spark, path).select("doc_id", "text").collect()]
    assert got(entry.queries()["op12_minhash"](spark, path).collect()) == expected(rows)


@pytest.mark.parametrize("crowd", [0, 10_000])
def test_a_group_of_near_copies_with_stragglers(spark, monkeypatch, crowd):
    """Many texts that share every band, of which some link with a few others only, and chains of links."""
    importable(spark)
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(150):
        words = list(base)
        for at in rng.choice(120, rng.integers(0, 9), replace=False):
            words[at] = f"x{i}y{at}"
        texts.append(" ".join(words))
    chain = [" ".join(f"c{j}" for j in range(4 * i, 4 * i + 80)) for i in range(30)]
    rows = list(enumerate(texts + chain))
    monkeypatch.setattr(M, "CROWD", crowd)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert got(M.near_duplicates(docs).collect()) == expected(rows)


def test_links_that_no_leader_has(spark, tmp_path):
    """The leader links with neither of two members that link with each other."""
    importable(spark)
    members = spark.createDataFrame([(1, b"a", 10), (1, b"b", 10), (1, b"c", 10), (1, b"d", 10), (2, b"c", 10), (2, b"z", 4)],
                                    "key long, node binary, n long")
    led = [(bytes(r.u), bytes(r.v)) for r in M.leader_pairs(members, 80, leaders=1).collect()]
    assert len(led) == 3 and max(sum(c in pair for pair in led) for c in (b"a", b"b", b"c", b"d")) == 3
    links = spark.createDataFrame([(b"d", b"a")], "u binary, v binary")
    tried = spark.createDataFrame([(b"b", b"a"), (b"c", b"a"), (b"d", b"a")], "u binary, v binary")
    apart = M.apart_pairs(M.apart(members, links, str(tmp_path)), tried, 80)
    assert {(bytes(r.u), bytes(r.v)) for r in apart.collect()} == {(b"c", b"b"), (b"d", b"b"), (b"d", b"c")}


def test_blocks_compare_all_members(spark):
    """A crowded bucket cut into blocks of few rows: its links join what all pairs join, and no more."""
    rng = np.random.default_rng(8)
    sets = [sorted({*range(50)} - {*rng.choice(50, k, replace=False).tolist()} | {*range(1000 * i, 1000 * i + k)}) for i in range(1, 60) for k in [int(rng.integers(1, 9))]]
    nodes = [b"%02d" % i for i in range(len(sets))]
    placed = spark.createDataFrame([(7, n, n, len(sets)) for n in nodes], "key long, node binary, root binary, size long")
    held = spark.createDataFrame(list(zip(nodes, sets)), "node binary, members array<long>")
    found = {(bytes(r.u), bytes(r.v)) for r in M.block_links(placed, held, 80, block=9).collect()}
    of = dict(zip(nodes, map(set, sets)))
    all_pairs = {(a, b) for a, b in combinations(nodes, 2) if 100 * len(of[a] & of[b]) >= 80 * len(of[a] | of[b])}
    assert {tuple(sorted(pair)) for pair in found} <= all_pairs

    def groups(pairs):
        root = {n: n for n in nodes}
        for _ in nodes:
            for a, b in pairs:
                root[a] = root[b] = min(root[a], root[b])
        return root

    assert groups(found) == groups(all_pairs) and 1 < len(set(groups(found).values())) < len(nodes)


def test_only_what_cannot_link_drops_out(spark):
    sets = [(b"a", list(range(10))), (b"b", list(range(8)) + [20, 21]), (b"c", list(range(7)) + [30, 31, 32]), (b"d", [40])]
    found = M.alone(spark.createDataFrame(sets, "node binary, members array<long>"), 80)
    assert {bytes(r.node) for r in found.collect()} == {b"c", b"d"}


def test_signatures_estimate_similarity():
    """Coordinates agree as often as the Jaccard similarity says, and are those of the shifted permutation."""
    rng = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.8):
        agree = []
        for _ in range(60):
            pool = rng.integers(0, 2**63, 400).astype(np.uint64)
            same = int(400 * share)
            half = (400 - same) // 2
            a, b = pool[: same + half], np.concatenate([pool[:same], pool[same + half : same + 2 * half]])
            agree.append((M.signature(a) == M.signature(b)).mean())
        assert abs(np.mean(agree) - same / (same + 2 * half)) < 0.02
    codes = M.permute(np.arange(1000, dtype=np.uint32), M.SECOND, np.empty(1000, np.uint32))
    assert len(set(codes.tolist())) == 1000
    one = np.array([77], np.uint64)
    code = M.permute(one.astype(np.uint32), M.FIRST, np.empty(1, np.uint32))
    plain = [M.permute(code - np.uint32(k), M.SECOND, np.empty(1, np.uint32))[0] for k in range(1, 161)]
    assert M.signature(one).tolist() == plain


def test_parts_of_a_long_text_make_the_same_set(monkeypatch):
    text = ("A b\tc  d\n" * 50 + "Ünï code ÀÉ x").encode()
    whole = M.shingle_set(text, M.WordHashes())
    monkeypatch.setattr(M, "PART", 7)
    assert (M.shingle_set(text, M.WordHashes()) == whole).all()
    assert len(whole) == len(plain_set(text.decode()))
    assert len(M.shingle_set(b" \t ", M.WordHashes())) == 0 and len(M.shingle_set(b"one", M.WordHashes())) == 1


def test_edges_of_the_input(spark, edge, clashing, none):
    importable(spark)
    rows = M.near_duplicates(clashing)
    assert rows.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows.collect()), key=str)
    assert found == expected([(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()])
    assert M.near_duplicates(none).count() == 0
