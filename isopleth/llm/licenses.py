"""License scan by template markup.

A template is wording with marked regions, as license lists publish them:

* ``<<beginOptional>> ... <<endOptional>>`` may be left out as a whole; it nests;
* ``<<var;name=...;match=LO,HI>>`` is replaceable by LO to HI words of any kind;
* all other words are mandatory.

``compile_template`` turns a template into a token automaton.  Its states are
positions between words; a text is accepted where a run of its words leads from
the first state to the last, so the mandatory wording must match exactly and in order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of a license scan: runs of letters, digits and everything beyond ASCII.
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

# Fixed values of the contract: phrases and the labels that they give.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Template wording of public licenses and of the notices that refer to them.
TEMPLATES = {
    "notice-apache-2.0": (
        "licensed under the apache license version 2 0 <<beginOptional>> the license you may not use this file "
        "except in compliance with the license <<endOptional>>"
    ),
    "notice-gpl": (
        "<<beginOptional>> this <<var;name=kind;match=1,2>> is <<endOptional>> licensed under the gnu general public "
        "license <<beginOptional>> version <<var;name=version;match=1,1>> <<endOptional>>"
    ),
    "notice-mit": "<<beginOptional>> released <<endOptional>> under the mit license",
    "notice-cc-by": (
        "licensed under <<beginOptional>> a <<endOptional>> <<beginOptional>> creative commons <<endOptional>> cc by "
        "<<beginOptional>> <<var;name=version;match=1,2>> <<endOptional>>"
    ),
    "text-mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
        "permit persons to whom the software is furnished to do so subject to the following conditions the above "
        "copyright notice and this permission notice <<beginOptional>> including the next paragraph <<endOptional>> "
        "shall be included in all copies or substantial portions of the software"
    ),
    "text-bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met <<var;name=bullet;match=0,1>> redistributions of source code must retain "
        "the above copyright notice this list of conditions and the following disclaimer <<var;name=bullet;match=0,1>> "
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
        "following disclaimer in the documentation and or other materials provided with the distribution "
        "<<beginOptional>> <<var;name=bullet;match=0,1>> neither the name of <<var;name=holder;match=1,12>> nor the "
        "names of its contributors may be used to endorse or promote products derived from this software without "
        "specific prior written permission <<endOptional>>"
    ),
    "text-isc": (
        "permission to use copy modify <<beginOptional>> and <<endOptional>> or distribute this software for any "
        "purpose with or without fee is hereby granted provided that the above copyright notice and this permission "
        "notice appear in all copies"
    ),
}

_MARK = re.compile(r"<<(beginOptional|endOptional|var;[^>]*)>>")


@dataclass(frozen=True)
class Automaton:
    """Token automaton of one template.

    ``arcs[s]`` lists (word or None for any word, next state); ``skips[s]`` the states
    reached without a word.  ``depth[s]`` is the number of mandatory words before ``s``.
    """

    label: str
    arcs: tuple[tuple[tuple[str | None, int], ...], ...]
    skips: tuple[tuple[int, ...], ...]
    depth: tuple[int, ...]
    last: int
    anchor: str  # a mandatory word (the longest): a text without it can't be accepted
    before_anchor: int  # mandatory words before it

    def closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        seen = set(states)
        while todo:
            for t in self.skips[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return seen

    def first_words(self) -> set[str | None]:
        return {w for s in self.closure({0}) for w, _ in self.arcs[s]}

    def run(self, tokens: list[str], at: int) -> tuple[int, int]:
        """(end of the longest accepted run from ``at`` or -1, most mandatory words matched)."""
        live, end, best = self.closure({0}), -1, 0
        while live:
            if self.last in live:
                end = at
            if at >= len(tokens):
                break
            word = tokens[at]
            live = self.closure({t for s in live for w, t in self.arcs[s] if w is None or w == word})
            best = max([best, *(self.depth[s] for s in live)])
            at += 1
        return end, best


def compile_template(label: str, template: str) -> Automaton:
    """Token automaton of a template; raises ValueError for unbalanced or unknown markup."""
    arcs: list[list[tuple[str | None, int]]] = [[]]
    skips: list[list[int]] = [[]]
    depth = [0]
    open_at: list[int] = []
    mandatory: list[str] = []

    def step(word: str | None, counts: bool) -> None:
        arcs[-1].append((word, len(arcs)))
        arcs.append([])
        skips.append([])
        depth.append(depth[-1] + counts)

    for k, piece in enumerate(_MARK.split(template)):
        if k % 2 == 0:
            for word in WORD.findall(piece.translate(_UPPER)):
                step(word, not open_at)
                if not open_at:
                    mandatory.append(word)
        elif piece == "beginOptional":
            open_at.append(len(arcs) - 1)
        elif piece == "endOptional":
            if not open_at:
                raise ValueError(f"{label}: endOptional without beginOptional")
            skips[open_at.pop()].append(len(arcs) - 1)
        else:
            limits = re.search(r"match=(\d+),(\d+)", piece)
            if not limits or int(limits[1]) > int(limits[2]):
                raise ValueError(f"{label}: a replaceable region needs match=LO,HI")
            low, high = int(limits[1]), int(limits[2])
            for _ in range(low):
                step(None, False)
            starts = []
            for _ in range(high - low):
                starts.append(len(arcs) - 1)
                step(None, False)
            for s in starts:
                skips[s].append(len(arcs) - 1)
    if open_at:
        raise ValueError(f"{label}: beginOptional without endOptional")
    if not mandatory:
        raise ValueError(f"{label}: no mandatory words")
    anchor = max(mandatory, key=len)
    return Automaton(
        label, tuple(map(tuple, arcs)), tuple(map(tuple, skips)), tuple(depth), len(arcs) - 1, anchor, mandatory.index(anchor)
    )


def _scan(text: str | None, automata: list[Automaton], firsts: list[set[str | None]]) -> tuple:
    low = (text or "").translate(_UPPER)
    tokens = WORD.findall(low)
    n_base, first, last, base, found, score = 0, None, None, set(), set(), 0.0
    joined = ""
    for phrase, label in PHRASES.items():
        if phrase.split(" ", 1)[0] not in low:
            continue
        joined = joined or f" {' '.join(tokens)} "
        needle, at, place, past = f" {phrase} ", -1, 0, 0
        while (at := joined.find(needle, at + 1)) >= 0:
            place += joined.count(" ", past, at)  # counted on from the last place
            past = at
            n_base += 1
            first = place if first is None else min(first, place)
            last = place if last is None else max(last, place)
            base.add(label)
    for a, begin in zip(automata, firsts):
        # a text without the anchor can't be accepted, and no run of it gets past the anchor
        if a.anchor not in low and a.before_anchor <= score * a.depth[a.last]:
            continue
        total = a.depth[a.last]
        for k, word in enumerate(tokens):
            if word in begin or None in begin:
                end, best = a.run(tokens, k)
                score = max(score, best / total)
                if end >= 0:
                    found.add(a.label)
    return len(tokens), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(base | found)), score


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """License phrases and template matches of every whole text.

    One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score.  ``labels`` adds to the phrase labels those of the accepted templates;
    ``score`` is the largest share of a template's mandatory words that some run of the
    text matches from its start (1 for accepted texts).  Labels must hold no comma.

    NULL and empty texts have no words, no labels and score 0.  Repeated rows give repeated
    results.  Further columns are ignored.  Nothing is shuffled; a task holds one batch.
    """
    automata = [compile_template(k, v) for k, v in (TEMPLATES if templates is None else templates).items()]
    if any("," in a.label for a in automata):
        raise ValueError("a label holds a comma")
    firsts = [a.first_words() for a in automata]

    @F.pandas_udf(
        "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    )
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = pd.DataFrame([_scan(t, automata, firsts) for t in texts], columns=FIELDS)
            yield out.astype({"first_word": "Int64", "last_word": "Int64"})

    return docs.select(F.col(doc_id).alias("doc_id"), scan(F.col(text)).alias("s")).select("doc_id", "s.*")


FIELDS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
