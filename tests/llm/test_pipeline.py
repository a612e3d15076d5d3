import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfmark.llm import decontaminate, pieces, pii, quality, simhash
from shelfmark.llm.queries import ORACLES, QUERIES
from tests.llm.test_simhash import fingerprint, groups
from tools.check_oracles import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage is given and returns, step by step."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF).cache()
        out.append((name, docs, after))
        docs = after
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_columns_stay(spark, stages):
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes
    assert [name for name, _ in corpus_pipeline.STAGES] == [name for name, _, _ in stages]


def test_quality_keeps_good_and_drops_bad(spark, stages):
    _, before, after = stages[0]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = texts(after)
    good = [i for i in texts(before) if labels.get(i) == 1]
    bad = [i for i in texts(before) if labels.get(i) == 0]
    assert all(i in kept for i in good) and not any(i in kept for i in bad)


def test_one_of_each_group(stages):
    _, before, after = stages[1]
    rows = sorted(texts(before).items())
    label = groups([fingerprint(t) for _, t in rows], 3)
    assert sorted(texts(after)) == sorted(rows[i][0] for i in set(label))


def test_benchmark_and_identifiers_are_gone(spark, stages):
    _, before, after = stages[2]
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontaminate.contamination_report(before, benchmark).filter("contaminated").count() > 0
    assert decontaminate.contamination_report(after, benchmark).filter("contaminated").count() == 0
    changed = {i for i, t in texts(after).items() if t != texts(before)[i]}
    hit = {r.doc_id for r in decontaminate.contamination_report(before, benchmark).filter("contaminated").collect()}
    assert changed == hit and len(texts(after)) == len(texts(before))
    _, before, after = stages[3]
    assert {i: pii.redacted(t) for i, t in texts(before).items()} == texts(after)
    assert after.filter(F.col("n_chars") != F.length("text")).isEmpty()


def test_pieces_decode_to_the_texts(spark, stages):
    vocabulary = pieces.Vocabulary.of_model(corpus_pipeline.PIECE_MODEL)
    for r in stages[4][2].collect():
        assert vocabulary.decode(r.piece_ids) == r.text.replace(pieces.MARKER, " ")


def test_run(spark, stages):
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, whole.collect())) == sorted(map(str, stages[-1][2].collect()))


def test_empty_documents(spark, stages):
    docs = stages[0][1].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0 and quality.held_back is not None and simhash.DISTANCE == 3


def test_queries_are_registered():
    import __spark_entry__ as entry

    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert duckdb.connect() and TABLES
