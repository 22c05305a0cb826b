import numpy as np
import pytest
from pyspark.sql import functions as F

from dayfold.llm import queries, setsketch
from test_jaccard import SCHEMA, brute, families


def expected(docs, percent=85):
    return sorted(((d, n, c, d == c) for d, n, c in brute(docs, percent)), key=repr)


def run(spark, docs, percent=85):
    df = spark.createDataFrame(docs, SCHEMA).selectExpr("*", "1 AS n", "'x' AS node", "2 AS key")
    rows = setsketch.near_duplicates(df, percent=percent).select("doc_id", "n_shingles", "component_id", "kept").collect()
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    docs = families(seed)
    assert run(spark, docs) == expected(docs)


def test_full_buckets(spark, monkeypatch):
    monkeypatch.setattr(setsketch, "SPARSE", 0)
    monkeypatch.setattr(setsketch, "CELL", 8)
    docs = families(7, sizes=(60, 120, 240), members=25)
    assert run(spark, docs) == expected(docs)


def test_copies_that_drift_apart_are_one_component(spark):
    words = [f"w{i}" for i in range(300)]
    docs = []
    for i in range(150):
        words[7 * i % 300] = f"x{i}"
        docs.append((i, " ".join(words)))
    assert run(spark, docs) == expected(docs) and {c for *_, c, _ in run(spark, docs)} == {0}


def test_nulls_empty_texts_repeated_ids_and_rows(spark):
    long = " ".join(f"w{i}" for i in range(200))
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "A"), (6, "a b"), (7, long), (7, long), (7, "other text of seven"),
            (8, long + " end"), (None, long.upper()), (None, "no id here"), (None, "no id here"), (9, "x " * 300000)]
    assert run(spark, docs) == expected(docs)


def test_empty_table(spark):
    assert run(spark, []) == []


def hashed(rng, n):
    return np.unique(rng.integers(0, 1 << 63, size=n, dtype=np.int64)).astype(np.uint64)


def test_registers_merge_and_agree_in_proportion():
    rng = np.random.default_rng(3)
    same, one, two = hashed(rng, 1700), hashed(rng, 150), hashed(rng, 150)
    a, b = np.union1d(same, one), np.union1d(same, two)
    sets = [a, b, np.union1d(a, b), a[:1], np.zeros(0, np.uint64)]
    first = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    rows = setsketch.sketch(np.concatenate(sets), first)
    assert (np.maximum(rows[0], rows[1]) == rows[2]).all() and (rows[4] == 0).all()
    alone = np.concatenate([setsketch.sketch(s, np.array([0, len(s)])) for s in sets])
    assert (rows == alone).all()
    equal = []
    for _ in range(60):
        same, one, two = hashed(rng, 850), hashed(rng, 75), hashed(rng, 75)
        x, y = np.union1d(same, one), np.union1d(same, two)
        r = setsketch.sketch(np.concatenate((x, y)), np.array([0, len(x), len(x) + len(y)]))
        equal.append((r[0] == r[1]).mean())
    assert abs(np.mean(equal) - 0.856) < 0.015  # similarity 0.85 on a scale of powers of 1.1


def test_agreement_of_packed_registers(spark):
    rng = np.random.default_rng(8)
    one, two = rng.integers(0, 4, size=(2, 50, setsketch.REGISTERS)).astype(np.uint8) * 85
    two[0] = one[0]
    packs = [setsketch.packed(x) for x in (one, two)]
    assert (setsketch._registers(packs[0]) == one).all()
    df = spark.createDataFrame([(i, packs[0][i].as_py(), packs[1][i].as_py()) for i in range(50)], "i int, a array<long>, b array<long>")
    found = df.select("i", setsketch.equal(F.col("a"), F.col("b")).alias("same")).collect()
    assert {r["i"]: r["same"] for r in found} == dict(enumerate((one == two).sum(axis=1).tolist()))


def test_likelihood_keeps_similar_pairs_and_drops_others():
    rng = np.random.default_rng(4)
    kept = {}
    for common in (0.3, 0.6, 0.85, 0.95):
        fits = []
        for _ in range(80):
            n = 1000
            same = hashed(rng, int(n * common))
            own = int((n - n * common) / 2)
            x, y = np.union1d(same, hashed(rng, own)), np.union1d(same, hashed(rng, own))
            r = setsketch.sketch(np.concatenate((x, y)), np.array([0, len(x), len(x) + len(y)]))
            fits.append(setsketch.likely(
                np.array([(r[0] > r[1]).sum()]), np.array([(r[0] < r[1]).sum()]), np.array([float(len(x))]), np.array([float(len(y))]), 85)[0])
        kept[common] = np.mean(fits)
    assert kept[0.85] == kept[0.95] == 1 and kept[0.3] == 0 and kept[0.6] < 0.5


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = queries.QUERIES["op13_setsketch"](spark, sf).select("doc_id", "n_shingles", "component_id", "kept").collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, rows), key=repr) == expected(docs)
