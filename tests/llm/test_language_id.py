import numpy as np
from pyspark.sql import functions as F

from conftest import TESTDATA
from llm_edges import clashing, edge, none  # noqa: F401
from sunledger.llm import language_id as L
from sunledger.llm.common import documents


def test_held_out_accuracy(spark):
    import __spark_entry__ as entry

    path = f"{TESTDATA}/sf0.1"
    rows = entry.queries()["op10_language_id"](spark, path)
    truth = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "lang")
    held = rows.filter("held_out").join(truth, "doc_id")
    n, right, low, high = held.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert n > 1500 and right / n > 0.99 and low >= 0 and high <= 1


def test_tables_are_the_network():
    rng = np.random.default_rng(0)
    net = L.train(rng.integers(0, 256, (20, 64)).astype(np.uint8), np.arange(20) % 3, ["a", "b", "c"], steps=5)
    windows = rng.integers(0, 256, (7, 64)).astype(np.uint8)
    pooled, _, _ = L.forward(net, windows)
    direct = np.log(L.softmax(pooled @ net.out + net.out_bias))
    assert np.allclose(L.Tables.of(net).log_probabilities(windows), direct, atol=1e-4)


def test_windows_cover_whole_texts():
    for n in (0, 1, 511, 512, 513, 1024, 1300):
        data = bytes(np.random.default_rng(n).integers(1, 256, n).astype(np.uint8))
        rows = L.cut(data)
        assert rows.shape[1] == L.WINDOW
        if n >= L.WINDOW:
            assert rows[: n // L.WINDOW].tobytes() == data[: n // L.WINDOW * L.WINDOW] and rows[-1].tobytes() == data[-L.WINDOW :]
        else:
            assert rows.tobytes() == data.ljust(L.WINDOW, b"\0")


def test_only_text_and_learned_languages_count(spark):
    docs = documents(spark, f"{TESTDATA}/sf0.01")
    # Held-out languages may say anything; sources too.
    other = docs.withColumns({"lang": F.when(L.crc_mod("doc_id", 5) == 0, "xx").otherwise(F.col("lang")), "source": F.lit("s")})
    one = {r.doc_id: (r.lang_pred, r.score) for r in L.language_id(docs).collect()}
    two = {r.doc_id: (r.lang_pred, r.score) for r in L.language_id(other).collect()}
    assert one == two and {p for p, _ in one.values()} <= {"en", "de", "fr", "es", "und"}


def test_edges_of_the_input(spark, edge, clashing, none):
    got = L.language_id(clashing).collect()
    texts = {(r.doc_id, r.text) for r in edge.collect()}
    assert len(got) == edge.count()
    by_id = {r.doc_id: r for r in got}
    for doc_id, text in texts:
        if doc_id is not None:
            letters = any(c.isalpha() for c in text or "")
            assert (by_id[doc_id].lang_pred == "und") == (not letters)
    assert all(0 <= r.score <= 1 for r in got)
    assert L.language_id(none).count() == 0
    unlabelled = edge.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in L.language_id(unlabelled).collect()} == {("und", 0.0)}
    # Digits and marks alone are no language, whatever their length.
    signs = spark.createDataFrame([(1, "123 456! ½ ² " * 500), (2, "12 ab")], "doc_id bigint, text string")
    tables = L.fit(documents(spark, f"{TESTDATA}/sf0.001"))
    assert {r.doc_id: r.lang_pred == "und" for r in L.languages(signs, tables).collect()} == {1: True, 2: False}
