import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayfold.llm import lempel_ziv, queries

SCHEMA = "doc_id long, text string"


def phrases(data):
    """The set of phrases of a parse, as bytes."""
    known, start = set(), 0
    for end in range(1, len(data) + 1):
        if data[start:end] not in known:
            known.add(data[start:end])
            start = end
    return known


def texts(n, seed=0):
    rng = random.Random(seed)
    return [rng.choice(["", "a" * rng.randrange(40), "".join(rng.choice("abcé ") for _ in range(rng.randrange(400)))]) for _ in range(n)]


def test_phrases_and_hashes():
    for text in texts(60) + ["x" * 5000, "\x00\x00\xff"]:
        data = text.encode()
        tree = lempel_ziv.Phrases().feed(data)
        assert len(tree.tree) == len(phrases(data))
        forest = lempel_ziv.Forest()
        at = forest.add(tree)
        assert len(np.unique(forest.hashes()[at:])) == len(tree.tree)


def test_forks_and_chunks_give_the_same_fingerprints():
    for head, one, two in zip(texts(40, 1), texts(40, 2), texts(40, 3)):
        start = lempel_ziv.Phrases().feed(head.encode())
        n = len(start.tree)
        fork = start.fork().feed(two.encode())
        start.feed(one.encode())
        forest = lempel_ziv.Forest()
        forest.add(lempel_ziv.Phrases().feed(b"something before"))
        at = forest.add(start)
        tail = forest.add(fork, n, at)
        h = forest.hashes()
        both = np.concatenate((h[at : at + n], h[tail : tail + len(fork.tree) - n]))
        want = lempel_ziv.signatures([(head + two).encode(), (head + one).encode()])
        assert (lempel_ziv.signature(both) == want[0]).all()
        assert (lempel_ziv.signature(h[at : at + len(start.tree)]) == want[1]).all()


def test_likeness_is_exact_for_small_sets_and_near_for_large_ones():
    for a, b in zip(texts(50, 4), texts(50, 5)):
        x, y = phrases(a.encode()), phrases(b.encode())
        p, q = lempel_ziv.signatures([a.encode(), b.encode()])
        got = lempel_ziv.likeness(p, q)
        want = len(x & y) / len(x | y) if x and y else float(len(x) == len(y))
        assert got == pytest.approx(want, abs=1e-12 if len(x | y) <= lempel_ziv.SIZE else 0.15)
        assert got == lempel_ziv.likeness(q, p) and 0 <= got <= 1


def brute(docs):
    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0), d[1] is not None, d[1] or ""))
    out = []
    for i, (doc, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        a, b, c = lempel_ziv.signatures([text.encode(), edited.encode(), following.encode()])
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), lempel_ziv.shown(a), lempel_ziv.shown(b),
                    lempel_ziv.likeness(a, b), lempel_ziv.likeness(a, c)))
    return sorted(out, key=repr)


def run(spark, docs):
    rows = lempel_ziv.compared_with_next(spark.createDataFrame(docs, SCHEMA)).collect()
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("chunk", [1 << 21, 300])
def test_compared_with_next(spark, monkeypatch, chunk):
    monkeypatch.setattr(lempel_ziv, "CHUNK", chunk)
    docs = [(i * 17 % 101, t) for i, t in enumerate(texts(90, 6))] + [(400, None), (None, "no id"), (None, None), (7, "again"), (7, "again")]
    assert run(spark, docs) == brute(docs)


@pytest.mark.parametrize("docs", [[], [(1, "only one")], [(1, "abc"), (1, "abd")], [(None, "a"), (None, None)], [(5, "äöü"), (3, "xy")]])
def test_small_tables(spark, docs):
    assert run(spark, docs) == brute(docs)


def test_fingerprint_columns(spark):
    df = spark.createDataFrame([(1, "some text", "some text"), (2, None, ""), (3, "one", "zzz")], "i int, a string, b string")
    out = df.select("i", lempel_ziv.fingerprint(F.col("a")).alias("p"), lempel_ziv.fingerprint(F.col("b")).alias("q"))
    got = out.withColumn("s", lempel_ziv.similarity(F.col("p"), F.col("q"))).orderBy("i").collect()
    assert [r["s"] for r in got] == [1, 1, 0] and got[0]["p"] == got[0]["q"]


def test_query_on_the_smallest_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, queries.QUERIES["op3_lempel_ziv"](spark, sf).collect()), key=repr)
    assert got == brute(docs)
    assert np.mean([r[5] for r in got]) > 2 * np.mean([r[6] for r in got])
