from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from conftest import TESTDATA
from llm_edges import clashing, edge, none  # noqa: F401
from sunledger.llm import common
from sunledger.llm import simhash as S
from sunledger.llm.common import importable
from sunledger.llm.components import components


def slow_fingerprint(text, shingle=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in low).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute_components(rows, distance=2):
    """Per row the smallest id reachable, by comparing all fingerprints."""
    prints = np.array([slow_fingerprint(t) for _, t in rows], dtype=np.uint64)
    pairs = [(i, int(j)) for i in range(len(rows)) for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= distance)]
    root = roots(len(rows), pairs)
    least = defaultdict(lambda: None)
    for r, (doc_id, _) in zip(root, rows):
        if doc_id is not None:
            least[r] = doc_id if least[r] is None else min(least[r], doc_id)
    return sorted(((d, int(p), least[r]) for (d, _), p, r in zip(rows, prints, root)), key=str)


def found(frame):
    return sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in frame.collect()), key=str)


def test_query_against_all_pairs(spark):
    import __spark_entry__ as entry

    rows = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = entry.queries()["op2_simhash"](spark, f"{TESTDATA}/sf0.001").collect()
    got = sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in got), key=str)
    assert got == brute_components([tuple(r) for r in rows])


@pytest.mark.parametrize("crowd", [2, 128])
def test_edges_of_the_input(edge, clashing, crowd):
    rows = [tuple(r)[:2] for r in edge.collect()]
    assert found(S.near_duplicates(clashing, crowd=crowd)) == brute_components(rows)


def test_empty_table(none):
    assert S.near_duplicates(none).count() == 0
    assert S.keep_one(none).count() == 0


def test_one_of_each_group_stays(edge, clashing):
    kept = S.keep_one(clashing)
    assert kept.columns == clashing.columns
    ids = [r.doc_id for r in kept.collect()]
    # One row for each group: unnamed texts that do not link are groups of their own.
    rows = [tuple(r)[:2] for r in edge.collect()]
    prints = [slow_fingerprint(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    first = {}
    for r, (doc_id, _) in zip(roots(len(rows), pairs), rows):
        first[r] = min(first.get(r, (True, 0)), (doc_id is None, doc_id or 0))
    assert sorted(ids, key=str) == sorted((None if unnamed else i for unnamed, i in first.values()), key=str)


def test_one_of_each_group_stays_whatever_its_ids(spark):
    """Unrelated texts without an id or with the same id are groups of their own; each keeps one."""
    words = [" ".join(f"{w}{k}" for k in range(12)) for w in ("ash", "birch", "cedar", "dogwood", "elm", "fir")]
    rows = [(None, words[0]), (None, words[1]), (None, words[1]), (1, words[2]), (1, words[3]), (None, words[3]), (2, words[4])]
    rows += [(3, words[4]), (None, words[5]), (None, None), (None, "")]
    kept = S.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(None, words[0]), (None, words[1]), (1, words[2]), (1, words[3]), (2, words[4]), (None, words[5]), (None, "")]
    assert sorted(((r.doc_id, r.text or "") for r in kept), key=str) == sorted(want, key=str)


def clustered(rng, n=400):
    """Random fingerprints, half of them around a few centres and sharing many bits."""
    out = [int(rng.integers(0, 1 << 63)) for _ in range(n // 2)]
    for centre in out[:4]:
        for _ in range(n // 8):
            flips = rng.choice(64, rng.integers(0, 5), replace=False)
            out.append(centre ^ sum(1 << int(f) for f in flips))
    return sorted({x - (1 << 64) if x >> 63 else x for x in out})


@pytest.mark.parametrize("distance", [0, 1, 2])
@pytest.mark.parametrize("crowd", [2, 8, 10_000])
def test_links_connect_like_all_pairs(spark, tmp_path, distance, crowd):
    """Any size of crowd, so that either way of linking does all, some or none of the work."""
    values = clustered(np.random.default_rng(distance))
    distinct = spark.createDataFrame([(v,) for v in values], "fp bigint")
    plan = S.make_plan(distinct, distance)
    pairs = S.links(distinct, plan, str(tmp_path), crowd).collect()
    unsigned = np.array(values).view(np.uint64)
    assert all(bin((r.u ^ r.v) % (1 << 64)).count("1") <= distance for r in pairs)
    at = {v: i for i, v in enumerate(values)}
    every = [(i, int(j)) for i in range(len(values)) for j in np.flatnonzero(np.bitwise_count(unsigned ^ unsigned[i]) <= distance)]
    assert roots(len(values), [(at[r.u], at[r.v]) for r in pairs]) == roots(len(values), every)


def test_parts_and_thresholds():
    rng = np.random.default_rng(3)
    values = rng.integers(-(1 << 62), 1 << 62, 500)
    values = (values & ~np.int64(3)) | np.where(values & 8, 3, 0)  # the lowest two bits always go together
    bits = S.bit_rows(values).astype(float)
    parts = S.correlated_parts(len(values), bits.T @ bits, 3)
    assert sorted(b for part in parts for b in part) == list(range(64))
    assert any({0, 1} <= set(part) for part in parts)
    near = [[S.near_counts(np.bincount(S.part_values(values, run), minlength=1 << len(run)), 2) for run in S.runs_of(p)] for p in parts]
    plan = S.Plan(2, len(values), parts, near)
    thresholds, cost = S.allocate(plan, values)
    assert (thresholds.sum(axis=1) == 0).all() and thresholds.min() >= -1
    priced = S.costs(plan, values)
    for choice in [(0, 0, 0), (1, 0, -1), (2, -1, -1), (-1, 1, 0)]:
        assert (cost <= sum(priced[i][:, t + 1] for i, t in enumerate(choice)) + 1e-9).all()


def test_probes_come_in_bounded_batches():
    """Over all 64 bits a fingerprint looks up 2081 values: not all of a batch's at once."""
    values = np.random.default_rng(5).integers(-(1 << 62), 1 << 62, 1200)
    plan = S.Plan(2, len(values), [list(range(64))], [[]])
    got = list(S.lookups(plan, values, np.full((len(values), 1), 2)))
    assert max(b.num_rows for b in got) <= S.LOOKUPS
    asked, by = (np.concatenate([b.column(i).to_numpy() for b in got]) for i in (1, 2))
    assert len(asked) == 2081 * len(values) and (by == np.repeat(values, 2081)).all()
    assert (np.bitwise_count((asked ^ by).view(np.uint64)) <= 2).all()
    assert all(len(set(asked[i : i + 2081])) == 2081 for i in range(0, len(asked), 2081))


def test_small_tables_are_few_files(spark, tmp_path):
    """Whatever the number of shuffle partitions; each file costs an executor several child processes."""
    docs = spark.range(3000).selectExpr("id as doc_id", "concat_ws(' ', 'one two three four', id div 2, id % 7) as text")
    held = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        rows, rooted = S.rooted_rows(importable(spark) and docs, 3, 2, 8, str(tmp_path / "run"))
        S.near_duplicates(docs, crowd=8).write.parquet(str(tmp_path / "run" / "result"))
        assert rows.count() == 3000 and rooted.count() == rows.select("fp").distinct().count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = defaultdict(int)
    for file in (tmp_path / "run").rglob("part-*.parquet"):
        files[str(file.parent.relative_to(tmp_path / "run"))] += 1
    files.pop("rows")
    assert {"distinct", "crowded", "components/0", "components/1", "rooted", "result"} <= set(files)
    assert max(files.values()) <= 2, files


def test_near_counts():
    counts = np.random.default_rng(0).integers(0, 9, 32)
    for v, row in enumerate(S.near_counts(counts, 2)):
        for e in range(3):
            assert row[e] == sum(counts[u] for u in range(32) if bin(u ^ v).count("1") == e)


def test_components(spark, tmp_path):
    rng = np.random.default_rng(1)
    chain = [(i, i + 1) for i in range(100, 140)]
    pairs = [tuple(map(int, p)) for p in rng.integers(0, 90, (60, 2))] + chain + chain[:3] + [(7, 7)]
    frame = spark.createDataFrame(pairs, "u bigint, v bigint")
    got = {r.u: r.root for r in components(frame, str(tmp_path)).collect()}
    root = roots(141, pairs)
    assert got == {i: root[i] for i in range(141) if root[i] != i}


def test_a_worker_lets_go_of_the_model_of_a_job_before(spark):
    """The next operator's tasks run in the same workers; what they keep must not lie beside it."""
    importable(spark)
    docs = spark.range(64, numPartitions=8).selectExpr("id as doc_id", "concat('some text ', id) as text")

    def held(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(common._KEPT)] * batch.num_rows)], names=["n"])

    def keep(batches):
        for batch in batches:
            common.kept("model", lambda: [0] * 1000)
            yield pa.RecordBatch.from_arrays([pa.array([len(common._KEPT)] * batch.num_rows)], names=["n"])

    assert {r.n for r in docs.mapInArrow(keep, "n long").collect()} == {1}
    for _ in range(4):
        S.fingerprints(docs).collect()
    assert {r.n for r in S.fingerprints(docs).select("doc_id").mapInArrow(held, "n long").collect()} == {0}
