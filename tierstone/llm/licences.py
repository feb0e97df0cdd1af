"""Find licence notices: templates with optional and replaceable regions, compiled into token automata.

A template is written in the markup of licence lists: ``<<beginOptional>>...<<endOptional>>`` may be left out, and
``<<var;name="x";original="y";match=".{0,n}">>`` stands for up to n words of any kind (n counts words here). All
other wording is mandatory and has to stand in the text word for word. A template becomes a chain of states, one per
word; optional regions and places for variable words can be skipped, so the set of states that a position can be in
is one integer and a step is a few operations on it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tierstone.llm.batches import texts_of

#: The phrases of the base count (fixed values).
PHRASES = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}

#: The mandatory wording of public licences and of the usual notices.
TEMPLATES = (
    ("mit", """<<beginOptional>>this <<endOptional>><<beginOptional>>work software project code is <<endOptional>>
        released under the mit license"""),
    ("mit", 'licensed under the <<beginOptional>>terms of the <<endOptional>>mit license'),
    ("mit", """permission is hereby granted free of charge to any person obtaining a copy of this software and
        associated documentation files the software to deal in the software without restriction including without
        limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the
        software and to permit persons to whom the software is furnished to do so subject to the following
        conditions the above copyright notice and this permission notice
        <<beginOptional>>including the next paragraph <<endOptional>>shall be included in all copies or substantial
        portions of the software"""),
    ("apache", """licensed under the apache license version 2 0
        <<beginOptional>>the license you may not use this file except in compliance with the license you may obtain a
        copy of the license at <<var;name="url";original="http www apache org licenses LICENSE 2 0";match=".{0,12}">>
        unless required by applicable law or agreed to in writing software distributed under the license is
        distributed on an as is basis without warranties or conditions of any kind either express or implied
        <<endOptional>>"""),
    ("gpl", """<<var;name="what";original="this work";match=".{0,3}">> is licensed under the gnu
        <<beginOptional>>lesser <<endOptional>><<beginOptional>>affero <<endOptional>>general public license
        <<beginOptional>>version <<var;name="v";original="3";match=".{0,1}">><<endOptional>>"""),
    ("gpl", """is free software you can redistribute it and or modify it under the terms of the gnu
        <<beginOptional>>lesser <<endOptional>><<beginOptional>>affero <<endOptional>>general public license as
        published by the free software foundation"""),
    ("bsd", """redistribution and use in source and binary forms with or without modification are permitted provided
        that the following conditions are met
        <<beginOptional>>1 <<endOptional>>redistributions of source code must retain the above copyright notice this
        list of conditions and the following disclaimer
        <<beginOptional>>2 <<endOptional>>redistributions in binary form must reproduce the above copyright notice
        this list of conditions and the following disclaimer in the documentation and or other materials provided
        with the distribution"""),
    ("isc", """permission to use copy modify and or distribute this software for any purpose with or without fee is
        hereby granted provided that the above copyright notice and this permission notice appear in all copies"""),
    ("mpl", """this source code form is subject to the terms of the mozilla public license v 2 0
        <<beginOptional>>if a copy of the mpl was not distributed with this file you can obtain one at
        <<var;name="url";original="http mozilla org MPL 2 0";match=".{0,8}">><<endOptional>>"""),
    ("cc", 'licensed under <<beginOptional>>the <<endOptional>>creative commons <<var;name="k";original="attribution";match=".{0,6}">> license'),
    ("cc", 'licensed under cc <<var;name="k";original="by";match=".{1,4}">> <<beginOptional>>4 0 <<endOptional>><<beginOptional>>3 0 <<endOptional>>'),
)

_MARK = re.compile(r"<<(.*?)>>", re.S)
_RANGE = re.compile(r'match="\.\{(\d+),(\d+)\}"')
#: Capital letters become small, all that is in no word becomes a blank (bytes; words hold all beyond ASCII).
_FOLD = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


@dataclass(frozen=True, eq=False)
class Automaton:
    """States 0..size; a text is accepted when ``accept`` is reached. Sets of states are integers."""

    label: str
    literal: dict[bytes, int]
    anything: int
    skips: tuple[tuple[int, int], ...]
    accept: int
    mandatory: frozenset[bytes]

    def closed(self, states: int) -> int:
        """The states with all that skipping optional parts reaches; skips only lead forward and are in order."""
        for state, to in self.skips:
            if states >> state & 1:
                states |= 1 << to
        return states

    def longest(self, words: list[bytes], at: int) -> int:
        """The end of the longest accepted run of words that starts at ``at``; -1 if there is none."""
        states, end, i = self.closed(1), -1, at
        while states:
            if states >> self.accept & 1:
                end = i
            if i == len(words):
                break
            states = self.closed((states & (self.literal.get(words[i], 0) | self.anything)) << 1)
            i += 1
        return end

    def first_words(self) -> frozenset[bytes] | None:
        """Words a match can start with; None if any word can."""
        start = self.closed(1)
        return None if start & self.anything else frozenset(w for w, s in self.literal.items() if s & start)


def compile_template(label: str, template: str) -> Automaton:
    """The automaton of a template's markup; an unknown or unclosed mark is an error."""
    literal: dict[bytes, int] = {}
    anything = size = 0
    skips: list[tuple[int, int]] = []
    opened: list[int] = []
    mandatory: set[bytes] = set()
    at = 0
    for m in [*_MARK.finditer(template), None]:
        for word in words_of(template[at : m.start() if m else len(template)]):
            literal[word] = literal.get(word, 0) | 1 << size
            if not opened:
                mandatory.add(word)
            size += 1
        if m is None:
            break
        at, mark = m.end(), m[1].strip()
        if mark == "beginOptional":
            opened.append(size)
        elif mark == "endOptional":
            skips.append((opened.pop(), size))
        elif mark.startswith("var;") and (found := _RANGE.search(mark)):
            for i in range(int(found[2])):
                anything |= 1 << size
                if i >= int(found[1]):
                    skips.append((size, size + 1))
                size += 1
        else:
            raise ValueError(f"unknown mark in the template of {label}: {mark}")
    if opened:
        raise ValueError(f"an optional region of {label} is not closed")
    return Automaton(label, literal, anything, tuple(sorted(skips)), size, frozenset(mandatory))


@cache
def _automata(templates: tuple[tuple[str, str], ...]) -> list[Automaton]:
    return [compile_template(label, text) for label, text in templates]


def base_places(words: list[bytes]) -> list[tuple[int, int, str]]:
    """(first word, end, label) of each place of a phrase."""
    out = []
    for label, phrase in PHRASES.items():
        need = phrase.encode().split()
        at = -1
        while True:
            try:
                at = words.index(need[0], at + 1)
            except ValueError:
                break
            if words[at : at + len(need)] == need:
                out.append((at, at + len(need), label))
    return sorted(out)


def template_matches(words: list[bytes], automata: list[Automaton]) -> list[tuple[int, int, str]]:
    """(first word, end, label) of each automaton's leftmost longest matches, which don't overlap."""
    out = []
    have = set(words)
    for automaton in automata:
        if not automaton.mandatory <= have:
            continue
        first = automaton.first_words()
        at = 0
        while at < len(words):
            end = automaton.longest(words, at) if first is None or words[at] in first else -1
            if end > at:
                out.append((at, end, automaton.label))
            at = max(end, at + 1)
    return sorted(out)


REPORT = (
    "struct<n_words:long,n_base:long,first_word:long,last_word:long,base_labels:string,labels:string,score:double,"
    "matches:array<struct<label:string,first_word:long,end_word:long>>>"
)
_MATCH = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64())])
_REPORT = pa.struct([
    *[(n, pa.int64()) for n in ("n_words", "n_base", "first_word", "last_word")],
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("matches", pa.list_(_MATCH)),
])


def _report(text: str, automata: list[Automaton]) -> dict:
    words = words_of(text)
    base = base_places(words)
    found = template_matches(words, automata)
    covered = np.zeros(len(words), bool)
    for s, e, _ in [*base, *found]:
        covered[s:e] = True
    return {
        "n_words": len(words), "n_base": len(base),
        "first_word": base[0][0] if base else None, "last_word": base[-1][0] if base else None,
        "base_labels": ",".join(sorted({x for _, _, x in base})),
        "labels": ",".join(sorted({x for _, _, x in [*base, *found]})),
        "score": float(covered.mean()) if len(words) else 0.0,
        "matches": [{"label": x, "first_word": s, "end_word": e} for s, e, x in found],
    }


def licences_in(text: Column, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> Column:
    """What a text says of its licence, as a struct.

    ``n_base`` counts the places of the base phrases, ``first_word`` and ``last_word`` are their smallest and largest
    start (null if there are none), ``matches`` are the accepted runs of words per template, ``labels`` is all found
    by either and ``score`` the share of the text's words in phrases and matches. A null or empty text has no words,
    no labels and score 0. Several templates may accept the same place.
    """
    def scan(column: pa.Array) -> pa.Array:
        automata = _automata(templates)
        return pa.array([_report(x, automata) for x in texts_of(column)], _REPORT)

    return F.arrow_udf(scan, REPORT)(text)
