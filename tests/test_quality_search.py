import pytest
from pyspark.sql import functions as F

from dayfold.operators import quality, search
from conftest import rows


def test_check(frame):
    parents = frame([(1,), (2,)], "id int")
    df = frame([
        ("a", 1, 0.5, "pending", 1, 9.994), ("a", 1, None, None, None, None), (None, 1, 2.0, "odd", 3, 1000.0),
        (None, 1, 0.0, "pending", 3, 0.995),
    ], "k string, m int, p double, s string, ref int, d double")
    rules = [
        quality.not_null("k"), quality.in_range("p", 0, 1), quality.allowed("s", ["pending"]),
        quality.fits_decimal("d", 3, 2), quality.unique("k", "m"), quality.references("ref", parents, "id"),
    ]
    assert dict(rows(quality.check(df, rules))) == {
        "k not null": 2, "p in range": 1, "s allowed": 1, "d fits decimal(3,2)": 1, "k, m unique": 1,
        "ref references id": 2,
    }
    bad = quality.violations(df, rules)
    assert dict(rows(bad.groupBy("rule").agg(F.count("*")))) == {
        "k not null": 2, "p in range": 1, "s allowed": 1, "d fits decimal(3,2)": 1, "k, m unique": 2,
        "ref references id": 2,
    }


def test_columns(spark, frame):
    df = frame([(1, "x")], "a int, b string")
    quality.require_columns(df, ["a"])
    with pytest.raises(ValueError, match="lacks"):
        quality.require_columns(df, ["c"])
    with pytest.raises(ValueError, match="case"):
        quality.refuse_case_clash(["a", "A"])
    described = quality.describe_schema(spark, {"t": df}, {"a": 0})
    assert rows(described) == [("t", 1, "a", "int", True, "0"), ("t", 2, "b", "string", True, None)]
    assert rows(quality.columns_per_type(described)) == [("t", "int", 1), ("t", "string", 1)]


def test_search(spark, frame, folder):
    docs = frame([(1, "The été cat, the CAT"), (2, "cat dog"), (3, "dog"), (4, None)], "id int, t string")
    index = search.postings(docs, "id", "t")
    assert rows(index) == [("cat", 1, 2), ("cat", 2, 1), ("dog", 2, 1), ("dog", 3, 1), ("été", 1, 1)]
    search.write_postings(index, f"{folder}/i")
    stored = search.load_postings(spark, f"{folder}/i")
    assert rows(search.search_all(stored, "the Cat & dog"), "doc") == [(2,)]
    assert rows(search.search_any(stored, "cat dog")) == [(1, 1, 2), (2, 2, 2), (3, 1, 1)]
    assert search.search_all(stored, "the").isEmpty()
    assert "PushedFilters: [In(token" in search.search_any(stored, "cat dog")._jdf.queryExecution().executedPlan().toString()


def test_an_index_is_dealt_once(spark, frame, folder, monkeypatch):
    """Words are shuffled once, by ranges of (token, document) that follow the texts' size, and not grouped before."""
    monkeypatch.setattr(search, "TEXT_PER_RANGE", 100)
    docs = frame([(i % 30, f"cat dog w{i} w{i + 1} cat") for i in range(60)] + [(None, "cat"), (None, "dog cat")], "id int, t string")
    for made, columns in ((search.postings, ["token", "doc", "times"]), (search.positions, ["token", "doc", "piece", "places"])):
        index = made(docs, "id", "t", ranged=True)
        plan = index.sortWithinPartitions("token", "doc")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") == 1 and "Exchange rangepartitioning(token" in plan
        assert not [x for x in plan[plan.index("Exchange "):].splitlines() if "Aggregate" in x]
        path = f"{folder}/{made.__name__}"
        search.write_postings(index, path, ranged=True)
        stored = search.load_postings(spark, path)
        assert rows(stored, *columns) == rows(made(docs, "id", "t"), *columns)
        bounds = stored.groupBy(F.input_file_name().alias("file")).agg(F.min("token").alias("a"), F.max("token").alias("z"))
        spans = sorted((r["a"], r["z"]) for r in bounds.collect())
        assert len(spans) > 4 and all(z <= a for (_, z), (a, _) in zip(spans, spans[1:]))
    assert search.postings(docs, "id", "t").filter("token = 'cat' and doc is null").first()["times"] == 2


def test_phrases_and_near_words(frame, monkeypatch):
    monkeypatch.setattr(search, "PIECE_WORDS", 2)
    docs = frame([
        (1, "Cat, dog! The cat dog cat"), (2, "dog cat"), (3, "cat of dog"), (4, None), (5, ""), (6, "cat cat cat"), (7, "cat bird bird bird dog"),
    ], "doc_id long, text string")
    index = search.positions(docs, "doc_id", "text")
    assert rows(index.filter("doc = 6"), "piece", "places") == [(0, [0, 1]), (1, [2])]
    assert rows(search.search_phrase(index, "cat dog")) == [(1, 2)]
    assert rows(search.search_phrase(index, "CAT the dog")) == [(3, 1)]
    assert rows(search.search_phrase(index, "cat, cat")) == [(6, 2)]
    assert rows(search.search_phrase(index, "the")) == rows(search.search_phrase(index, "")) == []
    assert rows(search.search_near(index, "dog cat", 2)) == [(1, 0), (2, 0)]
    assert rows(search.search_near(index, "dog and cat", 5)) == [(1, 0), (2, 0), (3, 0), (7, 0)]
    assert rows(search.search_near(index, "fish cat", 9)) == rows(search.search_near(index, "the", 9)) == []
