import random
import re

import pytest

from dayfold.llm import jaccard, queries
from dayfold.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def shingles(text, k=3):
    own = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not own:
        return frozenset()
    return frozenset(tuple(own[i : i + k]) for i in range(max(1, len(own) - k + 1)))


def brute(docs, percent=90):
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, len(sets[i]), least.get(find(i))) for i, (doc, _) in enumerate(docs)), key=repr)


def run(spark, docs, percent=90):
    df = spark.createDataFrame(docs, SCHEMA)
    rows = jaccard.near_duplicates(df, percent=percent).select("doc_id", "n_shingles", "component_id").collect()
    return sorted(map(tuple, rows), key=repr)


def families(seed, sizes=(1, 2, 3, 8, 30, 90, 130, 230, 400), members=7):
    """Texts with copies that differ in a few words, so that many pairs are near the limit."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    boiler = [word() for _ in range(40)]
    docs = []
    for size in sizes:
        base = [word() for _ in range(size)]
        for _ in range(members):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, max(1, size // 60), max(1, size // 45)])):
                own[rng.randrange(size)] = word().upper()
            if rng.random() < 0.2:
                own += boiler[: rng.randrange(40)]
            docs.append(" ".join(own))
    docs += [" ".join(boiler + [word() for _ in range(60)]) for _ in range(12)]
    rng.shuffle(docs)
    return [(i * 3 + 5, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    docs = families(seed)
    docs += [(1000, None), (1001, ""), (1002, " \n"), (None, docs[0][1]), (None, "alone with no id"), (7, docs[4][1]), docs[2], docs[2]]
    assert run(spark, docs) == brute(docs)


@pytest.mark.parametrize("percent", [80, 95, 100])
def test_other_thresholds(spark, percent):
    docs = families(11)
    assert run(spark, docs, percent) == brute(docs, percent)


def test_chains_of_near_copies_are_one_component(spark):
    words = [f"v{i}" for i in range(120)]
    docs = []
    for i in range(40):  # each differs from the one before in one word, the last from the first in 39
        words[i * 3] = f"x{i}"
        docs.append((100 - i, " ".join(words)))
    got = run(spark, docs)
    assert got == brute(docs) and {c for _, _, c in got} == {61}


def test_empty_table(spark):
    assert run(spark, []) == []


def test_components_of_stars_and_chains(spark):
    links = [(0, i) for i in range(1, 300)] + [(1000 + i, 1001 + i) for i in range(64)] + [(5000, 5000)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(300)) and all(got[1000 + i] == 1000 for i in range(65)) and got[5000] == 5000


def test_query_on_the_smallest_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.QUERIES["op2_jaccard_join"](spark, sf).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, rows)) == sorted(brute(docs))
