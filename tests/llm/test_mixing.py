import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from dayfold.llm import mixing, queries

SCHEMA = "doc_id long, text string, source string"


def share(size_of: dict, weights=(5, 2, 1), most=3):
    """Targets by raising all sources together until each is full or everything is dealt out."""
    order = sorted((s for s in size_of if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in size_of)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, full, left = dict.fromkeys(size_of, 0.0), set(), float(sum(size_of.values()))
    while left > 1e-9 and len(full) < len(size_of):
        open_ = [s for s in size_of if s not in full]
        total = sum(weight[s] for s in open_)
        step = min((most * size_of[s] - target[s]) / weight[s] for s in open_)
        step = min(step, left / total)
        for s in open_:
            target[s] += step * weight[s]
            if target[s] >= most * size_of[s] - 1e-9:
                full.add(s)
        left -= step * total
    return target


@pytest.mark.parametrize("most", [1, 2])
@pytest.mark.parametrize("seed", range(12))
def test_budget_is_met_as_nearly_as_documents_allow(seed, most):
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(2, 40), 5))
    counts = [rng.randint(1, 3) for _ in lengths]
    budget = rng.randrange(most * sum(n * c for n, c in zip(lengths, counts)))
    got = mixing.fit_budget(lengths, counts, budget, seed, most)
    assert all(0 <= q <= c * most for q, c in zip(got, counts))
    sums = [sum(n * q for n, q in zip(lengths, pick)) for pick in itertools.product(*[range(c * most + 1) for c in counts])]
    assert sum(n * q for n, q in zip(lengths, got)) == max(s for s in sums if s <= budget)


def test_budget_above_the_knapsack():
    lengths, counts = [7, 11, 500, 90_000], [10_000, 10_000, 300, 5]
    got = mixing.fit_budget(lengths, counts, 333_333, 1, knapsack=1000)
    assert sum(n * q for n, q in zip(lengths, got)) == 333_333 and all(q <= c for q, c in zip(got, counts))


def checked(rows, size_of):
    want = share(size_of)
    by_source = {}
    for r in rows:
        assert r["source_size"] == size_of[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], abs=1e-3)
        assert 0 <= r["copies"] <= 3
        by_source[r["source"]] = by_source.get(r["source"], 0) + r["size"] * r["copies"]
    return want, by_source


def test_mix_with_a_hot_source_and_a_hot_size(spark):
    rng = random.Random(3)
    docs = [(i, "x " * (50 if i % 3 else rng.randint(0, 90)), "hot" if i % 2 else rng.choice(["a", "b", "ß", None])) for i in range(3000)]
    docs += [(9001, None, "a"), (9002, "", None), (9003, "one two", "tiny"), (9003, "one two", "tiny")]
    size_of = {}
    for _, text, source in docs:
        size_of[source] = size_of.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    rows = mixing.mix(spark.createDataFrame(docs, SCHEMA)).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(d[0] for d in docs)
    want, got = checked(rows, size_of)
    for source, target in want.items():
        assert abs(got[source] - target) <= 1 or source == "tiny"
    again = mixing.mix(spark.createDataFrame(docs[::-1], SCHEMA).repartition(5)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_mix_of_odd_tables(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []
    assert mixing.mixed(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = mixing.mix(spark.createDataFrame([(1, None, None), (2, " ", "a")], SCHEMA)).collect()
    assert {(r["size"], r["copies"], r["target"]) for r in rows} == {(0, 0, 0.0)}


def test_mixed_repeats_documents_and_keeps_columns(spark):
    docs = spark.createDataFrame(
        [(i, "w " * 10, "s", i * 2, "c") for i in range(9)] + [(100, "w " * 1000, "t", 0, "c")],
        SCHEMA + ", size int, copy string",
    )
    out = mixing.mixed(docs)
    assert out.columns[:5] == docs.columns and len(out.columns) == 6
    n = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert all(n[i] == 3 for i in range(9)) and 100 not in n


def test_query_on_the_smallest_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = queries.QUERIES["op9_mixing"](spark, sf).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r["doc_id"] for r in rows} == set(docs)
    size_of = {}
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", docs[r["doc_id"]]["text"]))
        size_of.setdefault(docs[r["doc_id"]]["source"], 0)
        size_of[docs[r["doc_id"]]["source"]] += r["size"]
    want, got = share(size_of), {}
    for r in rows:
        source = docs[r["doc_id"]]["source"]
        assert r["target"] == pytest.approx(want[source], abs=1e-3) and r["taken"] in (0, r["size"], 2 * r["size"], 3 * r["size"])
        got[source] = got.get(source, 0) + r["taken"]
    assert all(abs(got[s] - want[s]) <= 40 for s in want)


def test_rows_without_or_with_repeated_ids_are_taken_each_by_its_own_number(spark):
    rows = [(None if i % 3 else i % 7, f"s{i % 4}", "w " * (1 + i * 7 % 13) + f"t{i}") for i in range(400)]
    rows += [(7, "s1", "same text of seven")] * 9 + [(None, "s2", "same text of none")] * 9
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    plan = mixing.mix(df)
    goal = {r["source"]: r["target"] for r in plan.select("source", "target").distinct().collect()}
    out = mixing.mixed(df).collect()
    for source, target in goal.items():
        words = sum(len(r["text"].split()) for r in out if r["source"] == source)
        assert words <= target < words + 1
        assert words == plan.filter(F.col("source") == source).selectExpr("sum(size * copies)").first()[0]
    assert sorted(map(str, out)) == sorted(map(str, mixing.mixed(df.repartition(5)).collect()))
