import re

import pytest

import corpus_pipeline
from dayfold.llm import classifier, stages
from test_decontamination import brute as contaminated_words
from test_jaccard import shingles

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """Documents before the first stage and after each."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.written(stage(spark, out[-1], SF), "test"))
    return [{"columns": d.columns, "rows": d.collect()} for d in out]


def ids(step):
    return {r["doc_id"] for r in step["rows"]}


def test_columns_and_whole_result(spark, steps):
    assert all(s["columns"] == COLUMNS for s in steps[:-1]) and steps[-1]["columns"][:5] == COLUMNS
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()), key=repr) == sorted(map(tuple, steps[-1]["rows"]), key=repr)


def test_rejected_documents_go(spark, steps):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scores = classifier.quality(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()
    assert ids(steps[1]) == {r["doc_id"] for r in scores if r["predicted"]} and 0 < len(ids(steps[1])) < 200


def test_one_document_of_each_group_stays(steps):
    sets = {r["doc_id"]: shingles(r["text"], 5) for r in steps[1]["rows"]}
    near = lambda a, b: 100 * len(a & b) >= 80 * len(a | b) and a
    component = {d: d for d in sets}
    for _ in sets:  # the smallest id spreads along links until nothing changes
        spread = {d: min(component[e] for e in sets if e == d or near(sets[d], sets[e])) for d in sets}
        if spread == component:
            break
        component = spread
    assert ids(steps[2]) == {d for d in sets if component[d] == d} and len(ids(steps[2])) < len(sets)


def test_contaminated_documents_go_and_passages_of_others(spark, steps):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = contaminated_words([(r["doc_id"], r["text"]) for r in steps[2]["rows"]], items)
    assert ids(steps[3]) == {d for d, n, hit, _, _ in before if not (hit and 20 * hit >= n)}
    after = contaminated_words([(r["doc_id"], r["text"]) for r in steps[3]["rows"]], items)
    assert all(hit == 0 for _, _, hit, _, _ in after)


def test_personal_data_is_replaced(steps):
    known = r"\S+@[\w.]+\.\w+|\+1 \(\d{3}\) \d{3}-\d{4}|(?<!\d)\d{16}(?!\d)"
    after = {r["doc_id"]: r["text"] for r in steps[4]["rows"]}
    assert set(after) == ids(steps[3])
    for r in steps[3]["rows"]:
        assert not any(f in after[r["doc_id"]] for f in re.findall(known, r["text"]))
        assert len(after[r["doc_id"]]) == next(x["n_chars"] for x in steps[4]["rows"] if x["doc_id"] == r["doc_id"])


def test_mix_takes_documents_up_to_three_times(steps):
    count = {}
    for r in steps[5]["rows"]:
        count[r["doc_id"]] = count.get(r["doc_id"], 0) + 1
    assert set(count) <= ids(steps[4]) and max(count.values()) <= 3
    assert len({(r["doc_id"], r["copy"]) for r in steps[5]["rows"]}) == len(steps[5]["rows"])


def test_stages_on_an_empty_table_and_extra_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "1 AS score", "'x' AS component_id")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SF).count() == 0
        assert stage(spark, docs.limit(20), SF).columns == docs.columns
    assert stages.mixed(spark, docs.limit(0), SF).count() == 0
