import pytest

import corpus_pipeline
from checks.compare import _bag, duck
from tests.conftest import SF
from tests.llm import plain
from ticketmill.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, name):
    frame = QUERIES[name](spark, SF)
    result = duck(SF).execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert _bag(frame.columns, frame.collect()) == _bag(columns, result.fetchall())


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage gets and what it gives, written and read again."""
    base = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{base}/{k}")
        made = spark.read.parquet(f"{base}/{k}")
        out.append((name, docs, made))
        docs = made
    return out


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages_keep_the_columns_of_documents(stages):
    assert [name for name, _, _ in stages] == [
        "toxicity", "simhash_near_dedup", "substring_dedup", "benchmark_decontamination", "best_fit_packing",
    ]
    for _, before, after in stages[:-1]:
        assert after.dtypes == before.dtypes


def test_toxic_documents_go_and_others_stay(spark, stages):
    _, before, after = stages[0]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    left = {r["doc_id"] for r in after.collect()}
    clean = [r["doc_id"] for r in labels.filter("toxic = 0").collect()]
    assert sum(i in left for i in clean) > 0.99 * len(clean)
    assert after.join(before, before.columns, "left_anti").count() == 0


def test_one_of_each_near_duplicate_stays(stages):
    _, before, after = stages[1]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    assert sorted(r["doc_id"] for r in after.collect()) == sorted({c for _, _, c in plain.near_duplicates(rows)})


def test_passages_and_benchmark_are_cut(spark, stages):
    _, before, after = stages[2]
    old, new = by_id(before), by_id(after)
    for i, r in new.items():
        assert len(r["text"]) == r["n_chars"]
        assert len(plain.words(r["text"])) <= len(plain.words(old[i]["text"]))
    _, before, after = stages[3]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    old, new = by_id(before), by_id(after)
    assert old.keys() == new.keys()
    wanted = dict(zip(old, plain.hits([r["text"] for r in old.values()], items)))
    for i, (n_words, n_hit, _) in wanted.items():
        assert (old[i]["text"] == new[i]["text"]) == (n_hit == 0)


def test_every_document_that_is_left_is_packed(stages):
    _, before, after = stages[4]
    assert {r["doc_id"] for r in before.collect()} == {r["doc_id"] for r in after.collect()}
