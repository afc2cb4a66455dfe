"""The registered queries: twins in SQL, the pipeline against its parts by brute force, and life without this folder."""

import subprocess
import sys
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from conftest import ROOT, TESTDATA
from oracle_check import differences, duck
from sunledger.llm import mixing, toxicity
from sunledger.llm.common import documents
from sunledger.llm.oracle import ORACLE
from sunledger.llm.queries import QUERIES, tokenizer_file
from test_exact_dedup import expected as dedup_expected
from test_packing import check as check_packing
from test_simhash import brute_components


def test_all_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact dedup", "SimHash near-dedup", "mixing sources to target weights", "best-fit packing"
    ]


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_twins(spark, name, sf):
    path = f"{TESTDATA}/sf{sf}"
    assert differences(entry.queries()[name](spark, path), duck(path), entry.oracle_sql()[name]) is None


def test_pipeline_against_brute_force(spark):
    """Each stage on what the one before it kept, with every group and every piece found by comparing all."""
    path = f"{TESTDATA}/sf0.001"
    docs = documents(spark, path)
    labels = spark.read.parquet(f"{path}/labels.parquet")
    rejected = {r.doc_id for r in toxicity.toxicity(docs, labels).filter("predicted = 1").collect()}
    rows = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect() if r.doc_id not in rejected}
    assert rejected and rows
    kept = {doc_id for doc_id, _, _, stays in dedup_expected(list(rows.items())) if stays}
    rows = {doc_id: text for doc_id, text in rows.items() if doc_id in kept}
    rows = {doc_id: rows[doc_id] for doc_id in {c for _, _, c in brute_components(list(rows.items()))}}
    sample = mixing.sampled(docs.filter(docs.doc_id.isin(list(rows))))
    rows = {r.doc_id: r.text for r in sample.select("doc_id", "text").collect()}
    check_packing(corpus_pipeline.run(spark, path).collect(), list(rows.items()))


def test_stages_keep_the_columns_of_documents(spark):
    path = f"{TESTDATA}/sf0.001"
    docs = documents(spark, path)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString(), name
        assert Counter(map(tuple, out.collect())) <= Counter(map(tuple, docs.collect())), name


def test_the_rest_works_without_these_folders(tmp_path):
    """The entry imports and lists the other queries when the subpackage and the pipeline are not there; an import that
    fails inside them is not swallowed."""
    hide = "import sys; sys.path.insert(0, {root!r})\n{before}\nimport __spark_entry__ as e\nprint(len(e.queries()), 'op6_exact_dedup' in e.queries())"
    gone = "sys.modules['sunledger.llm'] = None; sys.modules['corpus_pipeline'] = None"

    def run(before):
        code = hide.format(root=str(ROOT), before=before)
        return subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path)

    assert run(gone).stdout.split()[1] == "False"
    assert run("").stdout.split()[1] == "True"
    assert "ModuleNotFoundError" in run("sys.modules['xxhash'] = None").stderr
