import zlib

import numpy as np
import pyarrow as pa
import pytest

from dayfold.llm import classifier, queries

DOC, LABEL = "doc_id long, text string", "doc_id long, quality int"


def texts(n):
    good = [(i, f"The plain words of text number {i}, " * (3 + i % 5)) for i in range(n)]
    bad = [(n + i, f"BUY!! $$$ {i} %%% ##" * (3 + i % 7)) for i in range(n)]
    return good + bad


def test_scores_are_posteriors_of_the_fitted_normals():
    rng = np.random.default_rng(1)
    d = len(classifier.FEATURES)
    x = {0: rng.normal(0, 1, (400, d)), 1: rng.normal(0.4, 2, (600, d))}
    mean = {k: v.mean(axis=0) for k, v in x.items()}
    cov = {k: np.cov(v.T, bias=True) for k, v in x.items()}
    model = classifier.Discriminant([
        (len(x[k]) / 1000, mean[k], np.linalg.inv(np.linalg.cholesky(cov[k])), np.linalg.slogdet(cov[k])[1]) for k in (0, 1)
    ], 0.5)
    row = rng.normal(0, 1, (5, d))
    density = {
        k: len(x[k]) / np.sqrt(np.linalg.det(cov[k])) * np.exp(-0.5 * np.einsum(
            "ij,jk,ik->i", row - mean[k], np.linalg.inv(cov[k]), row - mean[k])) for k in (0, 1)
    }
    assert model.score(row) == pytest.approx(density[1] / (density[0] + density[1]))


def test_statistics_of_odd_texts():
    got = classifier.Statistics()(pa.array([None, "", "   ", "\n\n", "ÜÜ ß" * 5, "x" * 3_000_000, "a\na\na b"]))
    assert got.shape == (7, len(classifier.FEATURES)) and np.isfinite(got).all()
    assert (got[0] == got[1]).all()


def test_held_out_rows_teach_nothing(spark):
    docs = spark.createDataFrame(texts(40), DOC)
    labels = [(i, int(i < 40)) for i in range(80)]
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q) for i, q in labels]
    one, two = (
        sorted(map(tuple, classifier.quality(docs, spark.createDataFrame(x, LABEL)).collect())) for x in (labels, flipped)
    )
    assert one == two
    for doc, held, score, predicted in one:
        assert held == (zlib.crc32(str(doc).encode()) % 4 == 2) and predicted == int(score >= 0.7) == int(doc < 40)


def test_odd_tables(spark):
    none = spark.createDataFrame([], LABEL)
    docs = spark.createDataFrame([(1, None), (None, "a b"), (2, ""), (2, "")], DOC)
    assert {r["score"] for r in classifier.quality(docs, none).collect()} == {0.5}
    one_class = spark.createDataFrame([(1, 1), (1, 1), (2, None), (2, 7), (None, 0)], LABEL)
    assert classifier.quality(docs, one_class).count() == 4
    assert classifier.quality(spark.createDataFrame([], DOC), one_class).collect() == []


def test_accepted_keeps_other_columns(spark):
    rows = [(i, t, "kept", i / 2) for i, t in texts(40)]
    docs = spark.createDataFrame(rows, DOC + ", score string, x double")
    out = classifier.accepted(docs, spark.createDataFrame([(i, int(i < 40)) for i in range(80)], LABEL))
    assert out.columns == docs.columns and sorted(map(tuple, out.collect())) == sorted(rows[:40])


def test_query_is_accurate_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    out = {r["doc_id"]: r for r in queries.QUERIES["op10_quality_classifier"](spark, sf).collect()}
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if out[r["doc_id"]]["held_out"]]
    right = [out[r["doc_id"]]["predicted"] == r["quality"] for r in labels]
    assert len(out) == 1000 and sum(right) / len(right) >= 0.95
