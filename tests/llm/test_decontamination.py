import hashlib
import random
import re

import pytest

from dayfold.llm import decontamination, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text)) if text else []


def brute(docs, items, window=13):
    """doc -> (n_words, hit positions, items), by comparing every window with every place."""
    out = []
    for doc, text in docs:
        own, hit, found = words(text), set(), set()
        for item, item_text in items:
            have = words(item_text)
            size = min(window, len(have))
            parts = {tuple(have[i : i + size]) for i in range(len(have) - size + 1)} if have else set()
            for i in range(len(own) - size + 1):
                if parts and tuple(own[i : i + size]) in parts:
                    hit |= set(range(i, i + size))
                    found.add(str(item))
        out.append((doc, len(own), len(hit), len(found), ",".join(sorted(found))))
    return sorted(out, key=repr)


def run(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    rows = decontamination.overlaps(d, i, ["doc_id"], **options).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), ",".join(r["items"])) for r in rows), key=repr)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("block_words", [10**6, 25])
def test_against_brute_force(spark, seed, block_words):
    rng = random.Random(seed)
    say = lambda n: " ".join(rng.choice(["a", "B", "c,", "Ü"]) for _ in range(n))
    items = [(i, say(rng.choice([1, 2, 3, 4, 6, 9]))) for i in range(8)] + [(90, ""), (91, None), (92, "...")]
    docs = [(i, say(rng.choice([0, 1, 3, 10, 40]))) for i in range(30)] + [(99, None), (99, None), (None, say(9))]
    assert run(spark, docs, items, window=4, block_words=block_words) == brute(docs, items, window=4)


def test_query_on_the_smallest_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    want = [
        (d, n, hit, k, hashlib.sha256(ids.encode()).hexdigest(), hit > 0 and 20 * hit >= n)
        for d, n, hit, k, ids in brute(docs, items)
    ]
    got = queries.QUERIES["op1_decontamination"](spark, sf).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == []
    assert run(spark, [(1, "a b")], []) == [(1, 2, 0, 0, "")]


def test_decontaminate_keeps_other_columns_and_cuts(spark):
    passage = " ".join(f"w{i}" for i in range(13))
    filler = " ".join(f"f{i}" for i in range(400))
    docs = spark.createDataFrame(
        [(1, passage, 5, "x"), (2, f"{filler}, {passage}. {filler}", 6, None), (3, "Clean  Text\n", 7, "y"), (4, None, 8, "z")],
        "doc_id long, text string, n_words int, items string",
    )
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    out = {r["doc_id"]: r for r in decontamination.decontaminate(docs, items).collect()}
    assert set(out) == {2, 3, 4}
    assert passage not in out[2]["text"]
    assert words(out[2]["text"]) == words(f"{filler} {filler}")
    assert out[3]["text"] == "Clean  Text\n" and out[4]["text"] is None
    assert list(out[3].asDict()) == ["doc_id", "text", "n_words", "items"] and out[3]["n_words"] == 7
