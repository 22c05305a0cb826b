import re

import pytest

from dayfold.llm import licenses, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def places(text):
    own, out = words(text), []
    for phrase, label in licenses.PHRASES:
        parts = phrase.split()
        out += [(i, label) for i in range(len(own)) if own[i : i + len(parts)] == parts]
    return own, sorted(out)


def found(text, templates):
    return licenses.Automaton(templates).scan([w.encode() for w in words(text)])


TEMPLATE = [("t", "Use <<beginOptional>>and copy <<beginOptional>>or sell<<endOptional>><<endOptional>> of <<var;words=1-2>> is free")]


@pytest.mark.parametrize("text, accepted", [
    ("use of it is free", True), ("x USE, and copy of the thing is free!", True), ("use and copy or sell of it is free", True),
    ("use or sell of it is free", False), ("use of is free", False), ("use of a b c is free", False), ("use of it is not free", False),
    ("use use of of is free", True), ("use of it is", False), ("", False), ("use of is is free", True),
])
def test_regions(text, accepted):
    labels, part = found(text, TEMPLATE)
    assert (labels == {"t"}) == accepted and (part == 1) == accepted


def test_automaton_accepts_what_a_regular_expression_does():
    import itertools

    pattern = re.compile(r"(^| )a( b( c)?)? d( \S+){0,2} e( |$)")
    templates = [("t", "a <<beginOptional>>b <<beginOptional>>c<<endOptional>><<endOptional>> d <<var;words=0-2>> e")]
    automaton = licenses.Automaton(templates)
    for n in range(1, 7):
        for text in itertools.product("abcde", repeat=n):
            labels, _ = automaton.scan([w.encode() for w in text])
            assert bool(labels) == bool(pattern.search(" ".join(text))), text


@pytest.mark.parametrize("line, label", [
    ("Released under the MIT License.", "mit"), ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3.0"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc"), ("Licensed under a Creative Commons CC BY-SA 4.0", "cc-by-sa"),
])
def test_notices(line, label):
    labels, part = found(f"Some words. {line} More words follow here", licenses.TEMPLATES)
    assert label in labels and part == 1


def test_odd_texts(spark):
    docs = spark.createDataFrame(
        [(1, None, "s"), (2, "", "s"), (3, "Mit License mit license", "s"), (3, "Mit License mit license", "s"), (4, "license", "s"),
         (5, "general general public license", "s"), (None, "x " * 200_000 + "apache-license", "s")],
        "doc_id long, text string, score string",
    )
    rows = licenses.scan(docs, ["doc_id"]).collect()
    got = {r["doc_id"]: (r["n_words"], [(b["first_word"], b["label"]) for b in r["base"]], r["score"]) for r in rows}
    assert len(rows) == 7 and got[1] == got[2] == (0, [], 0)
    assert got[3][:2] == (4, [(0, "mit"), (2, "mit")]) and got[4][:2] == (1, []) and got[5][:2] == (4, [(1, "gpl")])
    assert got[None][:2] == (200_002, [(200_000, "apache")])
    assert licenses.scan(docs.limit(0), ["doc_id"]).collect() == []


def test_query_on_the_smallest_tables(spark):
    sf = "/root/testdata/sf0.01"
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    rows = queries.QUERIES["op8_license_scan"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        own, base = places(texts[r["doc_id"]])
        labels = sorted({b for _, b in base})
        assert r["n_words"] == len(own) and r["n_base"] == len(base) and r["base_labels"] == ",".join(labels)
        assert (r["first_word"], r["last_word"]) == ((base[0][0], base[-1][0]) if base else (None, None))
        assert set(labels) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        assert bool(re.search("CC BY-NC 4.0", texts[r["doc_id"]])) == ("cc-by-nc" in r["labels"].split(","))
