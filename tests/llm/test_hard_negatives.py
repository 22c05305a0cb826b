import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from dayfold.llm import hard_negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every=4, positives=5, negatives=3):
    kept = {
        (i, lab, tuple(math.floor(256 * float(x)) for x in v))
        for i, v, lab in rows
        if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a, lab, q in sorted(kept):
        if a % every:
            continue
        others = sorted(((-sum(x * y for x, y in zip(q, r)), i, other) for i, other, r in kept if i != a))
        for s, p, _ in [o for o in others if o[2] == lab][:positives]:
            fitting = [(t, i) for t, i, other in others if other != lab and 50 * -s <= 100 * -t <= 95 * -s][:negatives]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i) in enumerate(fitting)]
    return sorted(out)


def run(spark, rows, every=4, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    out = hard_negatives.mine(df, F.col("id") % every == 0, F.col("vec_id"), F.col("label"), F.col("embedding"))
    return sorted(tuple(r) for r in out.select(*COLUMNS).collect())


def clouds(seed, n=400, dim=8, labels=4, spread=0.3):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(labels, dim))
    return [
        (int(i), [float(np.float32(x)) for x in middle[i % labels] * rng.random() + spread * rng.normal(size=dim)], int(rng.integers(labels)))
        for i in rng.permutation(n)]


@pytest.mark.parametrize("tree,bundle", [(512, 16), (7, 2)])
def test_brute_force(spark, monkeypatch, tree, bundle):
    monkeypatch.setattr(hard_negatives, "TREE", tree)
    monkeypatch.setattr(hard_negatives, "BUNDLE", bundle)
    rows = clouds(tree)
    assert run(spark, rows) == brute(rows)


def test_nulls_ties_repeats_other_lengths_and_columns(spark):
    rng = random.Random(2)
    rows = [(i, [float(rng.randrange(-1, 3)) / 4 for _ in range(3)], rng.randrange(2)) for i in range(60)]
    rows += rows[:9] + [(None, [1.0, 1.0, 1.0], 1), (64, None, 1), (68, [1.0, None, 1.0], 0), (72, [1.0, float("nan"), 1.0], 1),
                        (76, [float("inf"), 0.0, 0.0], 0), (80, [1.0, 1.0, 1.0], None), (84, [], 1), (88, [1.0, 1.0, 1.0, 4.0], 0), (92, [2.0], 1)]
    assert run(spark, rows) == brute(rows)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS vector", "3 AS tree", "4 AS cell")
    out = hard_negatives.mine(df, F.col("id") % 4 == 0, F.col("vec_id"), F.col("label"), F.col("embedding"))
    assert sorted(tuple(r) for r in out.select(*COLUMNS).collect()) == brute(rows)


def test_empty_table_and_no_anchors(spark):
    assert run(spark, []) == [] and run(spark, [(1, [1.0], 0), (2, [1.0], 1)], every=50) == []


def test_scores_are_whole_numbers_at_any_size(spark):
    rows = [(i, [1.5e6 + i / 7, -2.25e6, 3e5 * i], i % 2) for i in range(12)]
    assert run(spark, rows, schema="vec_id long, embedding array<double>, label int") == brute(rows)


def test_many_equal_vectors(spark):
    rows = [(i, [0.5, 0.25, -0.125], i % 3) for i in range(150)] + clouds(4, n=60, dim=3)[:40]
    rows = [(k, v, lab) for k, (_, v, lab) in enumerate(rows)]
    assert run(spark, rows) == brute(rows)


def test_bounds_spare_scores_and_lose_none():
    rng = np.random.default_rng(1)
    vectors = np.floor(256 * (rng.normal(size=16) + 0.02 * rng.normal(size=(200, 16))))
    parent, edge = hard_negatives.span(vectors)
    assert sorted(np.flatnonzero(parent < 0)) == [0]
    rows = np.floor(256 * rng.normal(size=(1000, 16)))
    full, found = rows @ vectors.T, []

    def pick(j, low, high):
        assert (low <= full[:, j] + 1e-6).all() and (high >= full[:, j] - 1e-6).all()
        return high >= 250_000

    scored = hard_negatives.walk(parent, edge, vectors, hard_negatives.Scores(rows), pick, lambda j, at, own: found.append((j, at, own)))
    assert len(found) == 200 and scored < 0.5 * full.size
    for j, at, own in found:
        assert set(np.flatnonzero(full[:, j] >= 250_000)) <= set(at.tolist()) and (own == full[at, j]).all()


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_equals_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    ours = sorted(tuple(r) for r in queries.QUERIES["op12_hard_negatives"](spark, folder).select(*COLUMNS).collect())
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    theirs = connection.sql(f"SELECT {', '.join(COLUMNS)} FROM ({queries.SQL['op12_hard_negatives']})").fetchall()
    assert ours == sorted(theirs) and len({a for a, *_ in ours}) == 10
