"""License scans by template-markup matching.

A template is a license text with marked regions: ``<<beginOptional>>`` to ``<<endOptional>>`` may
be left out, ``<<var;words=0-12>>`` stands for any words, so many of them. It is compiled to an
automaton over words; everything outside the regions is mandatory and has to match word for word.
Documents are read from every place where a template can begin, for all templates at once.

Base labels come from fixed phrases. A null text is an empty one: no words, places or labels and a
score of 0. Repeated rows get equal results. A template matches wherever it stands in a document
and as often as it stands there.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import map_batches
from .words import LETTERS_BLANKED, fast_split

# Phrases of the contract and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Public license notices as templates, by label.
TEMPLATES = (
    ("mit", "Released under the <<beginOptional>>terms of the<<endOptional>> MIT License"),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
        and associated documentation files <<beginOptional>>(the "Software")<<endOptional>>, to deal in
        <<var;words=1-2>> without restriction, including without limitation the rights to use, copy, modify,
        merge, publish, distribute, sublicense, and/or sell copies of <<var;words=1-2>>, and to permit persons
        to whom <<var;words=1-2>> is furnished to do so, subject to the following conditions"""),
    ("isc", """Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for
        any purpose with or without fee is hereby granted, provided that the above copyright notice and this
        permission notice appear in all copies"""),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0
        <<beginOptional>>(the "License"); you may not use this file except in compliance with the License<<endOptional>>"""),
    ("gpl-3.0", """This <<var;words=1-3>> is licensed under the GNU <<beginOptional>>Affero<<endOptional>>
        <<beginOptional>>Lesser<<endOptional>> General Public License, version 3
        <<beginOptional>>or any later version<<endOptional>>"""),
    ("gpl", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation; either version <<var;words=1-2>> of the
        License, or <<beginOptional>>(at your option)<<endOptional>> any later version"""),
    ("cc-by", "Licensed under <<beginOptional>>a Creative Commons<<endOptional>> CC BY <<var;words=2-2>>"),
    ("cc-by-nc", "Licensed under <<beginOptional>>a Creative Commons<<endOptional>> CC BY-NC <<var;words=2-2>>"),
    ("cc-by-sa", "Licensed under <<beginOptional>>a Creative Commons<<endOptional>> CC BY-SA <<var;words=2-2>>"),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met <<var;words=0-2>> Redistributions of source code must retain the
        above copyright notice, this list of conditions and the following disclaimer"""),
)

_MARK = re.compile(r"<<(beginOptional|endOptional|var;words=(\d+)-(\d+))>>")


class Automaton:
    """Nondeterministic automaton over words for several templates together."""

    def __init__(self, templates: Sequence[tuple[str, str]]):
        self.step: list[dict[bytes, int]] = [{}]
        self.any: list[int] = [-1]  # where any word at all leads
        self.free: list[list[int]] = [[]]  # where no word at all leads
        self.accept: dict[int, int] = {}
        self.depth: list[int] = [0]  # mandatory words up to a state
        self.template: list[int] = [-1]
        self.labels, self.mandatory = [], []
        starts = [self._compile(i, label, text) for i, (label, text) in enumerate(templates)]
        self.closed = [self._closure(i) for i in range(len(self.step))]
        # The words with which templates begin, and the states right after them.
        self.begin: dict[bytes, frozenset[int]] = {}
        for state in frozenset().union(*(self.closed[s] for s in starts)):
            for word, to in self.step[state].items():
                self.begin[word] = self.begin.get(word, frozenset()) | self.closed[to]

    def _new(self, template: int, depth: int) -> int:
        for row, value in ((self.step, {}), (self.any, -1), (self.free, []), (self.depth, depth), (self.template, template)):
            row.append(value)
        return len(self.step) - 1

    def _compile(self, number: int, label: str, text: str) -> int:
        start = at = self._new(number, 0)
        opened: list[int] = []
        mandatory = 0
        place = 0
        for mark in [*_MARK.finditer(text), None]:
            for word in fast_split(text[place : mark.start() if mark else len(text)]):
                mandatory += not opened
                to = self._new(number, mandatory)
                self.step[at][word] = to
                at = to
            if mark is None:
                break
            place = mark.end()
            if mark[1] == "beginOptional":
                opened.append(at)
            elif mark[1] == "endOptional":
                # The region gets an end of its own, so words after it are reached both ways.
                end = self._new(number, mandatory)
                self.free[at].append(end)
                self.free[opened.pop()].append(end)
                at = end
            else:
                least, most = int(mark[2]), int(mark[3])
                chain = [at]
                for _ in range(most):
                    to = self._new(number, mandatory)
                    self.any[chain[-1]] = to
                    chain.append(to)
                end = self._new(number, mandatory)
                for state in chain[least:]:
                    self.free[state].append(end)
                at = end
        self.accept[at] = number
        self.labels.append(label)
        self.mandatory.append(mandatory)
        return start

    def _closure(self, state: int) -> frozenset[int]:
        seen, todo = {state}, [state]
        while todo:
            for to in self.free[todo.pop()]:
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
        return frozenset(seen)

    def scan(self, words: Sequence[bytes]) -> tuple[set[str], float]:
        """Labels of the templates that are accepted somewhere, and the largest part of one read.

        The part is that of a template's mandatory words which a stretch of the document follows
        from the template's start; it is 1 where a template is accepted.
        """
        found: set[int] = set()
        best = 0.0
        live: frozenset[int] = frozenset()
        for word in words:
            if live:
                follow = set()
                for state in live:
                    to = self.step[state].get(word)
                    if to is not None:
                        follow |= self.closed[to]
                    to = self.any[state]
                    if to >= 0:
                        follow |= self.closed[to]
                live = frozenset(follow)
            if word in self.begin:
                live |= self.begin[word]
            for state in live:
                number = self.accept.get(state)
                if number is not None:
                    found.add(number)
                part = self.depth[state] / self.mandatory[self.template[state]]
                if part > best:
                    best = part
        return {self.labels[i] for i in found}, best


def _phrase_places(words: list[bytes], phrases) -> dict[str, list[int]]:
    """Starts of each phrase's words, by label."""
    places: dict[str, list[int]] = {}
    for parts, label in phrases:
        at = -1
        while True:
            try:
                at = words.index(parts[-1], at + 1)  # phrases are told by their last, rare word
            except ValueError:
                break
            first = at - len(parts) + 1
            if first >= 0 and words[first : at + 1] == parts:
                places.setdefault(label, []).append(first)
    return places


def scan(
    docs: DataFrame, keep: Sequence[str], text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Sequence[tuple[str, str]] = PHRASES,
) -> DataFrame:
    """``keep`` columns with ``n_words``, ``base`` (label and start of each phrase), ``matches``
    (sorted labels of the templates found) and ``score``, the part of a template that is there."""
    picked = docs.select(*keep, F.col(f"`{text}`").alias("__text"))
    cut = [(fast_split(p), label) for p, label in phrases]
    held: list[Automaton] = []
    n_keep = len(keep)
    base_type = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(Automaton(templates))
        automaton = held[0]
        counts, bases, matches = [], [], []
        scores = np.zeros(len(batch))
        for i, value in enumerate(batch.column(n_keep)):
            words = value.as_buffer().to_pybytes().translate(LETTERS_BLANKED).split() if value.is_valid else []
            found, best = set(), 0.0
            if not automaton.begin.keys().isdisjoint(words):
                found, best = automaton.scan(words)
            places = _phrase_places(words, cut)
            counts.append(len(words))
            bases.append([{"label": k, "first_word": p} for k in sorted(places) for p in places[k]])
            matches.append(sorted(found))
            scores[i] = best
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:n_keep], pa.array(counts, pa.int64()), pa.array(bases, base_type), pa.array(matches, pa.list_(pa.string())), pa.array(scores)],
            names=[*keep, "n_words", "base", "matches", "score"],
        )

    new = T._parse_datatype_string(
        "n_words long, base array<struct<label:string,first_word:long>>, matches array<string>, score double")
    return map_batches(picked, run, T.StructType([*picked.schema.fields[:n_keep], *new.fields]))
