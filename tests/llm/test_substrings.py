import hashlib
import random
import re

import pytest

from dayfold.llm import queries, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def brute(docs, window):
    """(id, words, removed, kept) of each row, by going through all windows in document order."""
    place = lambda doc: substrings.NO_ID if doc is None else doc
    first = {}
    for doc, text in docs:
        own = WORD.findall(text or "")
        for i in range(len(own) - window + 1):
            key = tuple(own[i : i + window])
            first[key] = min(first.get(key, (place(doc), i)), (place(doc), i))
    out = []
    for doc, text in docs:
        own, gone = WORD.findall(text or ""), set()
        for i in range(len(own) - window + 1):
            if first[tuple(own[i : i + window])] != (place(doc), i):
                gone |= set(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        out.append((doc, len(own), len(gone), kept))
    return sorted(out, key=repr)


def run(spark, docs, window=4, run=2):
    df = spark.createDataFrame(docs, SCHEMA)
    rows = substrings.without_repeats(df, ["doc_id"], window, run).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in rows), key=repr)


def brute_maximal(docs, window):
    """(words, number of places, first place) of the maximal repeats, by going through all runs of words."""
    own = {}
    for doc, text in docs:
        words = tuple(WORD.findall(text or ""))
        doc = substrings.NO_ID if doc is None else doc
        own[words] = min(own.get(words, doc), doc)
    places = {}
    for words, doc in own.items():
        for i in range(len(words)):
            for j in range(i + window, len(words) + 1):
                around = (words[i - 1] if i else (words, i), words[j] if j < len(words) else (words, j))
                places.setdefault(words[i:j], []).append(((doc, i), *around))
    return sorted(
        (" ".join(k), len(k), len(p), *min(x[0] for x in p)) for k, p in places.items()
        if len(p) > 1 and len({x[1] for x in p}) > 1 and len({x[2] for x in p}) > 1)


def texts(seed, n=60):
    rng = random.Random(seed)
    say = lambda k: " ".join(rng.choice("abcdeÜ") for _ in range(k))
    passage, docs = say(9), []
    for i in range(n):
        kind = rng.randrange(6)
        text = [say(rng.randrange(12)), f"{say(3)}\t{passage}\n{say(2)}", say(2) * 8, None, passage, "z " * rng.randrange(30)][kind]
        docs.append((i * 7 % 61, text))
    docs += [(500 + i, docs[i][1]) for i in range(8)] + [docs[3], docs[3]]
    return docs


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    docs = texts(seed)
    assert run(spark, docs) == brute(docs, 4)


@pytest.mark.parametrize("seed", range(2))
def test_maximal_repeats(spark, seed):
    docs = texts(seed) + [(None, None), (None, "a b c d e a b c d e"), (700, "q w e r t y"), (701, "q w e r t y u"), (702, "o q w e r t")]
    want = brute_maximal(docs, 4)
    assert any(n > 4 for _, n, *_ in want) and ("q w e r t", 5, 3, 700, 0) in want
    got = substrings.maximal_repeats(spark.createDataFrame(docs, SCHEMA), 4, 2).collect()
    assert sorted(map(tuple, got)) == want
    assert substrings.maximal_repeats(spark.createDataFrame([], SCHEMA), 4, 2).collect() == []


def test_deep_nodes_of_nested_repeats():
    leaves = sorted([b"a b c d", b"a b c", b"a b c d e", b"a b x", b"a bc", b"q"])
    nodes = substrings.deep_nodes(((w, [w]) for w in leaves), 2, lambda a, b: a + b)
    found = {(depth, len(below)) for depth, below, _ in nodes if len(below) > 1}
    assert found == {(4, 2), (3, 3), (2, 4)}
    assert substrings.common_words(b"a b c", b"a bc") == 1 and substrings.common_words(b"a b", b"a b c") == 2
    long = b"w " * 5000
    assert substrings.common_words(long + b"x y", long + b"xz") == 5000 and substrings.common_words(b"ab", b"a") == 0


def test_full_groups_and_own_anchor_lists(spark, monkeypatch):
    docs = texts(9) + [(None, "a b c d e a b c d e"), (None, None), (-5, "a b c d e")]
    want = brute(docs, 4)
    monkeypatch.setattr(substrings, "FEWEST", 2)
    monkeypatch.setattr(substrings, "MOST", 2)  # nearly every window is shared by more suffixes
    assert run(spark, docs) == want
    monkeypatch.setattr(substrings, "FILTER_BYTES", 0)
    assert run(spark, docs) == want


def test_copies_of_which_one_has_a_shared_id(spark):
    docs = [(1, "a b c d e f g h"), (2, "a b c d e f g h"), (2, "x y z w v u"), (3, "x y z w v u"), (4, "  a b  c d e f g h ")]
    got = run(spark, docs)
    assert got == brute(docs, 4)


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([(1, "a b c d", 3, "s")], SCHEMA + ", id int, spans string")
    assert substrings.without_repeats(df, ["doc_id", "id", "spans"], 4, 2).first()["id"] == 3
    df = spark.createDataFrame([(1, "a b c d", "mine")], SCHEMA + ", kept string")
    row = substrings.without_repeats(df, ["doc_id", "kept"], 4, 2).first()
    assert (row["kept"], row["kept_"], row["n_words"]) == ("mine", "a b c d", 4)


def test_query_on_the_smallest_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute(docs, 20)]
    assert sorted(map(tuple, queries.QUERIES["op6_substring_dedup"](spark, sf).collect())) == sorted(want)
