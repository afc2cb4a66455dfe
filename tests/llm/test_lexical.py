import math
import re
from collections import Counter

import numpy as np
import pytest

from llm_edges import clashing, edge, none  # noqa: F401
from sunledger.llm import lexical as X
from sunledger.llm.common import importable

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def expected(docs, items, top=50):
    """Every document scored for every item."""
    counted = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs]
    counted = [(doc_id, c, sum(c.values())) for doc_id, c in counted if c]
    total, words = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item_id, text in dict.fromkeys(items):
        terms = set(plain_terms(text))
        scored = []
        for doc_id, c, n in counted:
            m = 100 - 50 + 50 * n * total // words
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in terms if t in c
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item_id, rank, doc_id, -score) for rank, (score, _, doc_id) in enumerate(scored[:top], 1)]
    return sorted(out, key=str)


def got(frame):
    return sorted(map(tuple, frame.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def words(rng, n):
    return " ".join(f"t{int(x)}" for x in np.minimum(rng.zipf(1.3, n), 300))


@pytest.mark.parametrize("leaf,at_once,block", [(24, 48, 4096), (1, 2, 16), (0, 1, 50)])
def test_best_of_all_documents(spark, monkeypatch, leaf, at_once, block):
    """Small blocks and intervals, ties and copies, one hot word in all texts."""
    importable(spark)
    for name, value in (("LEAF", leaf), ("AT_ONCE", at_once), ("BLOCK", block)):
        monkeypatch.setattr(X, name, value)
    rng = np.random.default_rng(block)
    docs = [(i, words(rng, int(rng.integers(0, 40))) + " hot") for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(90)]
    items = [(i, words(rng, int(rng.integers(1, 12)))) for i in range(25)] + [(50, "hot"), (51, docs[7][1]), (52, "nowhere"), (53, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert got(X.ranked_search(frame, asked, top=10)) == expected(docs, items, 10)


def test_queries_in_groups(spark):
    importable(spark)
    rng = np.random.default_rng(3)
    docs = [(i, words(rng, 30)) for i in range(100)]
    items = [(i, words(rng, 5)) for i in range(30)]
    frame, asked = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert got(X.ranked_search(frame, asked, top=5, group=4)) == expected(docs, items, 5)


def test_range_maxima_and_skipping():
    """The sparse table answers any range of a list; intervals under the bar are not looked into."""
    rng = np.random.default_rng(0)
    term = np.sort(rng.integers(0, 6, 700))
    place = np.concatenate([np.sort(rng.choice(1000, (term == t).sum(), replace=False)) for t in range(6)])
    impact = rng.integers(1, 50, 700)
    block = X.Block(term, place, impact, 1000)
    for t in range(6):
        low, high = (int(x[0]) for x in block.range_of(np.array([t])))
        for _ in range(50):
            a, b = sorted(rng.integers(low, high + 1, 2).tolist())
            if a < b:
                at = int(block.largest(np.array([a]), np.array([b]))[0])
                assert a <= at < b and block.impact[at] == block.impact[a:b].max()
    rising = X.Block(np.zeros(5000, int), np.arange(5000), np.arange(1, 5001), 5000)
    best = X.Best.none(3)
    scored = X.search(rising, np.array([0]), np.arange(5000), np.zeros(5000, bool), best)
    assert best.ids.tolist() == [4999, 4998, 4997] and scored < 200


def test_norms_do_not_overflow():
    n = np.array([1, 3_000_000_000], np.int64)
    total, all_words = 10**11, 4 * 10**13
    assert X.length_norms(n, total, all_words).tolist() == [50 + 50 * x * total // all_words for x in n.tolist()]


def test_terms():
    for text in ("Ab-cD_9 éÀ\x7fx y\U0001f600z", "", None, "\x00a@[`{0", "日本 語"):
        assert [t.decode() for t in X.terms_of(text)] == plain_terms(text)


def test_edges_of_the_input(spark, edge, clashing, none):
    importable(spark)
    items = [(1, "the quick brown Fox"), (1, "the quick brown Fox"), (1, "und zwei"), (None, "words"), (2, None), (3, ""), (4, "Äpfel straße")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    rows = X.ranked_search(clashing, asked.selectExpr("*", "1 as score", "2 as rank", "3 as query"))
    assert rows.columns == ["item_id", "rank", "doc_id", "score"]
    assert got(rows) == expected(docs, items)
    assert X.ranked_search(none, asked).count() == 0 and X.ranked_search(edge, asked.limit(0)).count() == 0
