import math
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import TESTDATA
from llm_edges import clashing, edge, none  # noqa: F401
from sunledger.llm import common
from sunledger.llm import toxicity as T
from sunledger.llm.common import documents, importable


def random_vectors(rng, n, terms):
    out = []
    for _ in range(n):
        picked = np.sort(rng.choice(terms, rng.integers(1, 9), replace=False))
        weight = rng.integers(1, 5, len(picked)).astype(float)
        out.append((picked, weight / np.sqrt(weight @ weight)))
    return out


def index_of(vectors, terms, **more):
    sizes = [len(t) for t, _ in vectors]
    flat = [np.concatenate([v[i] for v in vectors]) if vectors else np.zeros(0, np.int64) for i in (0, 1)]
    return T.Index(np.repeat(np.arange(len(vectors)), sizes), flat[0].astype(np.int64), flat[1].astype(float), len(vectors), terms, **more)


@pytest.mark.parametrize("block", [1, 5, 32])
@pytest.mark.parametrize("n", [0, 1, 14, 15, 64, 65, 1000])
def test_nearest_are_those_of_all_examples(n, block):
    rng, terms = np.random.default_rng(n), 60
    vectors = random_vectors(rng, n, terms)
    vectors += vectors[: n // 3]  # ties
    index = index_of(vectors, terms, block=block)
    table = np.zeros((len(vectors), terms))
    for i, (t, w) in enumerate(vectors):
        table[i, t] = w
    queries = random_vectors(rng, 60, terms) + vectors[:20] + [(np.zeros(0, np.int64), np.zeros(0))]
    found, _ = index.nearest_of(queries, 15)
    for (t, w), (best, scores) in zip(queries, found):
        if not len(t):
            assert not len(best)
            continue
        cosine = np.round(table[:, t] @ w, 9)
        order = np.lexsort((np.arange(len(vectors)), -cosine))[:15]
        assert np.allclose(scores, cosine[order], atol=1e-8)
        assert set(best[scores > scores.min() + 1e-8].tolist()) <= set(order.tolist()) if len(best) else not len(order)


def test_blocks_that_are_too_far_are_skipped():
    """Groups that share no term: a text of one group is compared with that group alone."""
    rng, vectors = np.random.default_rng(3), []
    for group in range(8):
        for _ in range(64):
            t = np.sort(rng.choice(20, 10, replace=False)) + 20 * group
            vectors.append((t, np.full(10, 10**-0.5)))
    index = index_of(vectors, 160)
    found, scored = index.nearest_of(vectors[:64], 15)
    assert scored < 64 * 200
    assert all(best[0] == i or scores[0] == 1 for i, (best, scores) in enumerate(found))


def test_terms_are_those_of_all_words():
    vocabulary = sorted(["idiot", "^idio", "ab", "^worthl", "élan", "^trash", "abcde", "^abcd"])
    texts = ["Idiot! idiots, (idiot) $$$idiot%%idiot ab AB-ab abc abcde abcdefg xab", "worthless,worthlessly Élan 12 trash1 trashy",
             "", None, "x", "idiot", "ab"]
    terms = T.Terms(vocabulary)
    for text in texts:
        every = Counter(t for w in T.WORD.findall((text or "").lower()) for t in T.word_terms(w))
        number, times, others = terms.counts(text)
        assert {vocabulary[i]: n for i, n in zip(number, times)} == {t: n for t, n in every.items() if t in vocabulary}
        assert others == pytest.approx(sum(np.log1p(n) ** 2 for t, n in every.items() if t not in vocabulary))


def plain_scores(docs, labelled, sizes, k, texts):
    """Scores and neighbours by comparing every text with every example, in plain Python; nothing of the operator's but
    what a term is."""
    def counts(text):
        return Counter(t for w in T.WORD.findall((text or "").lower()) for t in T.word_terms(w))

    rows = sorted(labelled)
    held = [counts(text) for _, _, text in rows]
    n = Counter(y for _, y, _ in rows)
    df, with_1, with_0 = Counter(), Counter(), Counter()
    for (_, y, _), c in zip(rows, held):
        df.update(c.keys())
        (with_1 if y else with_0).update(c.keys())
    scale = {t: (math.log((1 + len(rows)) / (1 + df[t])) + 1) * math.log2(2 + (with_1[t] / n[1]) / (max(with_0[t], 1) / n[0])) for t in df}

    def unit(c):
        v = {t: math.log1p(m) * scale.get(t, math.log(1 + len(rows)) + 1) for t, m in c.items()}
        length = math.sqrt(math.fsum(x * x for x in v.values()))
        return {t: x / length for t, x in v.items()}

    vectors = [unit(c) for c in held]

    def nearest(text, k):
        v = unit(counts(text))
        if not v.keys() & scale.keys():
            return []
        own = next((i for i, r in enumerate(rows) if (r[2] or "") == (text or "")), None)
        cosines = [(-round(math.fsum(x * w[t] for t, x in v.items() if t in w), 10), i) for i, w in enumerate(vectors) if i != own]
        return sorted(cosines)[:k]

    def vote(found):
        weight = [1 / n[rows[i][1]] / (1.01 + c) ** T.POWER for c, i in found]
        return sum(w for w, (_, i) in zip(weight, found) if rows[i][1]) / sum(weight)

    votes = np.array([vote(nearest(r[2], k)) for r in rows])
    y = np.array([r[1] for r in rows], float)
    knots = T.isotonic(votes, y, np.array([sizes[r[1]] / n[r[1]] for r in rows]))
    out = {}
    for doc_id, text in texts:
        found = nearest(text, k)
        out[doc_id] = (float(np.interp(vote(found), *knots)) if found else sizes[1] / sum(sizes), found, rows)
    return out


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_against_all_examples(spark, sf):
    """Score and evidence of the whole query; documents with toxic texts are flagged at both sizes."""
    path = f"{TESTDATA}/sf{sf}"
    docs = [(r.doc_id, r.text) for r in documents(spark, path).select("doc_id", "text").collect()]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    learned = [(i, labels[i], text or "") for i, text in docs if i in labels and zlib.crc32(str(i).encode()) % 3 != 1]
    sizes = [sum(y == c for _, y, _ in learned) for c in (0, 1)]
    model = T.fit(documents(spark, path), spark.read.parquet(f"{path}/labels.parquet"))
    rows = {r.doc_id: r for r in entry.queries()["op4_toxicity"](spark, path).collect()}
    some = docs if sf == "0.001" else docs[::7]
    want = plain_scores(docs, learned, sizes, model.k, some)
    for doc_id, (score, found, examples) in want.items():
        assert rows[doc_id].score == pytest.approx(score, abs=1e-7)
        assert rows[doc_id].predicted == (rows[doc_id].score >= 0.7) and rows[doc_id].held_out == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
        sure = {examples[i][0] for c, i in found if c < found[-1][0] - 1e-9}
        assert sure <= set(rows[doc_id].evidence) and len(rows[doc_id].evidence) == len(found)
    flagged = {i for i, r in rows.items() if r.predicted}
    held = {i for i, y in labels.items() if y and rows[i].held_out}
    assert len(flagged) >= 3 and len(held & flagged) >= {"0.001": 2, "0.01": 15}[sf]
    assert all(labels.get(i, 1) for i in flagged if rows[i].held_out)


def test_the_text_itself_is_no_evidence(spark):
    """A text that was learned from scores as one that was not: by its neighbours."""
    importable(spark)
    rows = [(i, f"{w} alpha beta gamma", y) for i, (w, y) in enumerate([("idiot", 1), ("idiot", 1), ("lovely", 0), ("kind", 0)])]
    model = T.Model(T.Examples.unpacked(T.counted(rows, [2, 2]).packed()))
    found = [f.tolist() for f, _ in model.neighbours(["idiot alpha beta gamma", "lovely alpha beta gamma", "other alpha beta"], 3)]
    assert found[0][0] == 1 and 0 not in found[0] and 2 not in found[1] and len(found[2]) == 3


def test_the_sample_is_bounded(spark):
    importable(spark)
    ids = [i for i in range(300) if zlib.crc32(str(i).encode()) % 3 != 1]
    docs = spark.createDataFrame([(i, "word " * (20 if i % 2 else 2000)) for i in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    picked, sizes = T.sample_labels(docs, labels, 50)
    rows = T.example_rows(docs, picked, 50, 60_000).collect()
    assert sizes == [sum(i % 2 == c for i in ids) for c in (0, 1)]
    assert sum(r.toxic == 1 for r in rows) == 50 and 0 < sum(r.toxic == 0 for r in rows) == 3
    assert len(T.fit(docs, labels, 50, 60_000).model().doc_ids) == 53


def test_isotonic_rises_and_keeps_the_mean():
    rng = np.random.default_rng(0)
    votes = np.round(rng.random(500), 2)
    labels = (rng.random(500) < votes**2).astype(float)
    x, y = T.isotonic(votes, labels, np.ones(500))
    assert (np.diff(x) > 0).all() and (np.diff(y) >= 0).all() and y.min() > 0 and y.max() < 1
    assert abs(np.interp(0.9, x, y) - 0.81) < 0.15


def test_held_out_labels(spark):
    """Labels that took no part: the order of the scores, what is flagged, and that scores are shares."""
    path = f"{TESTDATA}/sf0.1"
    rows = entry.queries()["op4_toxicity"](spark, path)
    labels = spark.read.parquet(f"{path}/labels.parquet").select("doc_id", "toxic")
    held = rows.filter("held_out").join(labels, "doc_id").toPandas()
    rank = held.score.rank().to_numpy()
    y = held.toxic.to_numpy()
    area = (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))
    flagged = held.predicted.to_numpy() == 1
    assert area > 0.95
    assert y[flagged].mean() > 0.95 and flagged[y == 1].mean() > 0.9
    assert held.score.between(0, 1).all() and abs(held.score.mean() - y.mean()) < 0.03


def test_other_columns_are_no_inputs(spark):
    docs, labels = documents(spark, f"{TESTDATA}/sf0.01"), spark.read.parquet(f"{TESTDATA}/sf0.01/labels.parquet")
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "n_chars": F.lit(0)})
    # Held-out labels may say anything.
    turned = labels.withColumn("toxic", F.when(T.crc_mod("doc_id", 3) == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one = {r.doc_id: r.score for r in T.toxicity(docs, labels).collect()}
    two = {r.doc_id: r.score for r in T.toxicity(other, turned).collect()}
    assert one == two


def test_edges_of_the_input(spark, edge, clashing, none):
    importable(spark)
    labels = spark.createDataFrame([(i, i % 2, int(i == 10)) for i in (1, 2, 3, 6, 8, 10)] + [(None, 1, 1), (2, 0, None)],
                                   "doc_id bigint, quality int, toxic int")
    empty = labels.limit(0)
    rows = T.toxicity(clashing, labels)
    assert rows.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    got = rows.collect()
    assert len(got) == edge.count() and all(0 <= r.score <= 1 for r in got)
    assert T.toxicity(none, labels).count() == 0
    assert {r.score for r in T.toxicity(edge, empty).collect()} == {0.0}
    kept = T.keep_clean(clashing, labels)
    assert kept.columns == clashing.columns and kept.count() >= edge.count() - 1
    assert T.keep_clean(none, empty).count() == 0


def test_words_beyond_what_is_remembered(monkeypatch):
    monkeypatch.setattr(T, "REMEMBERED", 3)
    vocabulary = sorted({t for w in ["alphabet", "beta", "gammas", "delta"] for t in T.word_terms(w)})
    terms = T.Terms(vocabulary)
    for text in ["alphabet beta beta", "gammas delta alphabet unknown delta", "unknown beta delta alphabets", "alphabet beta beta"]:
        every = Counter(t for w in T.WORD.findall(text) for t in T.word_terms(w))
        number, times, others = terms.counts(text)
        assert {vocabulary[i]: n for i, n in zip(number, times)} == {t: n for t, n in every.items() if t in vocabulary}
        assert others == pytest.approx(sum(np.log1p(n) ** 2 for t, n in every.items() if t not in vocabulary))
        assert len(terms.words) <= 3


def test_a_model_takes_little_beside_its_index():
    """Terms by number, not as strings and lists: a worker holds one, beside the index."""
    words = ["".join(chr(97 + (i // 26**p) % 26) for p in range(9)) for i in range(0, 4_000_000, 80)]
    vocabulary = sorted({t for w in words for t in T.word_terms(w)})
    tracemalloc.start()
    terms = T.Terms(vocabulary)
    for at in range(0, len(words), 500):
        terms.counts(" ".join(words[at : at + 500]))
    size, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert size < 400 * len(words)


def test_a_model_goes_when_no_task_uses_it(spark, monkeypatch):
    """The stage after the scores may be long and need the memory."""
    monkeypatch.setattr(common, "IDLE", 0.2)
    with common.in_use():
        common.kept("model", lambda: [1])
        time.sleep(0.4)
        assert common._KEPT == {"model": [1]}
    with common.in_use():
        assert common.kept("model", lambda: [2]) == [1]
    time.sleep(0.6)
    assert not common._KEPT
    importable(spark)
    docs = spark.range(64, numPartitions=8).selectExpr("id as doc_id", "concat('some text ', id) as text")
    T.toxicity(docs, spark.createDataFrame([(1, 0), (2, 1), (3, 0), (6, 1)], "doc_id long, toxic int")).collect()
    time.sleep(4)

    def held(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(common._KEPT)] * batch.num_rows)], names=["n"])

    assert {r.n for r in docs.mapInArrow(held, "n long").collect()} == {0}


def examples_of(n, words_each, words):
    """Texts of words that share no beginning, most words in few texts; every second text has label 1."""
    names = ["".join(chr(97 + (i // 26**p) % 26) for p in range(4)) for i in range(words)]
    picked = (words * np.random.default_rng(5).random((n, words_each)) ** 2).astype(int)
    return [(i, " ".join(names[w] for w in some), i % 2) for i, some in enumerate(picked.tolist())]


def test_a_worker_builds_its_model_in_little_memory():
    """Each worker of an executor builds one, beside the executor's own memory: no entry may take many bytes on the way."""
    rows = examples_of(800, 500, 60_000)
    data = T.counted(rows, [400, 400]).packed()
    entries = sum(len(set(text.split())) for _, text, _ in rows)
    tracemalloc.start()
    model = T.Model(T.Examples.unpacked(data))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 40 * entries
    assert model.index.lists.nbytes < 3 * entries + 9 * len(model.scale)


def test_words_of_a_batch_are_looked_up_together(monkeypatch):
    """Words that are not remembered cost one search for all texts of a batch, not one for each text."""
    monkeypatch.setattr(T, "REMEMBERED", 50)
    rows, calls, search = examples_of(40, 60, 500), [], T.Terms.numbers_of
    model = T.Model(T.Examples.unpacked(T.counted(rows, [20, 20]).packed()))
    monkeypatch.setattr(T.Terms, "numbers_of", lambda self, words: calls.append(len(words)) or search(self, words))
    texts = [f"{text} other{chr(97 + i % 26)}" for i, text, _ in rows * 3]
    found = list(model.neighbours(texts, 5))
    assert len(calls) <= 2 * -(-len(texts) // T.BATCH)
    one_by_one = [next(iter(model.neighbours([text], 5))) for text in texts]
    assert all((a[0] == b[0]).all() and np.allclose(a[1], b[1], atol=1e-11) for a, b in zip(found, one_by_one))


def test_single_precision_loses_no_neighbour():
    """Cosines that differ by less than single precision can tell, in common terms: the nearest are the exact ones."""
    rng, terms, n = np.random.default_rng(8), 40, 600
    base = rng.random(terms)
    vectors = [base + 1e-9 * rng.random(terms) for _ in range(n // 2)] + [rng.random(terms) for _ in range(n // 2)]
    vectors = [(np.arange(terms), v / np.sqrt(v @ v)) for v in vectors]
    query = (np.arange(terms), base / np.sqrt(base @ base))
    table, (best, cosine) = np.array([w for _, w in vectors]), index_of(vectors, terms, block=32).nearest(*query, 15)
    exact = table @ query[1]
    assert len(best) == 15 and (best < n // 2).all()
    assert np.allclose(cosine, exact[best], rtol=0, atol=2e-12) and exact[best].min() >= np.sort(exact)[-15] - 2e-12
