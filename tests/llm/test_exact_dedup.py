from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm_edges import clashing, edge, none  # noqa: F401
from sunledger.llm import exact_dedup as X


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[lowered(text)].append(doc_id)
    out = Counter()
    for ids in groups.values():
        keep = max((i for i in ids if i is not None), default=None)
        seen = False
        for i in ids:
            kept = i == keep and not seen
            seen |= kept
            out[(i, keep, len(ids), kept)] += 1
    return out


def result(frame):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in frame.collect())


# Digests that tell nothing, little and all: the check of the bytes must make up for it.
@pytest.mark.parametrize("digest", [X.sha256, F.length, lambda c: F.lit("x")], ids=["sha256", "length", "constant"])
def test_groups_are_those_of_the_bytes(spark, edge, digest):
    assert result(X.exact_dedup(edge, digest)) == expected([tuple(r) for r in edge.collect()])


def test_rows_that_stay_keep_their_columns(edge, clashing):
    kept = X.keep_first(clashing)
    assert kept.columns == clashing.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=str) == sorted([2, 6, 7, 8, 9, 10, 5, 4, None, None], key=str)


def test_empty_table(none):
    assert X.exact_dedup(none).count() == 0
    assert X.keep_first(none).count() == 0


def test_state_goes_on_over_batches(spark, edge, tmp_path):
    """Arrivals in three files, one per micro-batch, and a restart in between: the state of all of them."""
    arrived = X.arrivals(edge)
    run = str(tmp_path)
    arrived.repartition(1).write.parquet(f"{run}/in")
    stream = lambda: spark.readStream.schema(X.ARRIVAL).option("maxFilesPerTrigger", 1).parquet(f"{run}/in")
    X.start_state(stream(), f"{run}/state", f"{run}/checkpoint").awaitTermination()
    more = spark.createDataFrame([(99, "the quick brown fox jumps over the lazy dog."), (0, "new")], "doc_id long, text string")
    X.arrivals(more).coalesce(1).write.mode("append").parquet(f"{run}/in")
    X.start_state(stream(), f"{run}/state", f"{run}/checkpoint").awaitTermination()
    state = {r.digest: (r.n_rows, r.locator.doc_id) for r in X.read_state(spark, f"{run}/state").collect()}
    rows = [tuple(r)[:2] for r in edge.collect()] + [tuple(r) for r in more.collect()]
    assert sorted(n for n, _ in state.values()) == sorted(Counter(lowered(t) for _, t in rows).values())
    assert (4, 99) in state.values()


def test_state_and_small_tables_are_few_files(spark, tmp_path, monkeypatch):
    """Whatever the number of partitions; each file and each store costs an executor several child processes."""
    docs = spark.range(3000, numPartitions=40).selectExpr("id as doc_id", "concat('text ', id div 2) as text")
    monkeypatch.setattr(X, "run_dir", lambda spark, name: str(tmp_path / name))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "61")
        kept = X.keep_first(docs)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "61"
        kept.write.parquet(str(tmp_path / "result"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {r.doc_id for r in spark.read.parquet(str(tmp_path / "result")).collect()} == set(range(1, 3000, 2))
    run = tmp_path / "exact-dedup"
    assert [p.name for p in (run / "checkpoint/state/0").iterdir() if p.name.isdigit()] == ["0"]
    files = {name: len(list((run / name).glob("part-*.parquet"))) for name in ("arrivals", "state/batch=0", "hits")}
    assert max(files.values()) <= 2, files
    assert len(list((tmp_path / "result").glob("part-*.parquet"))) <= spark.sparkContext.defaultParallelism
