"""License scans: templates with optional and replaceable regions, matched as token automata.

A template is wording with markup: ``[[ ... ]]`` may be absent, ``{{n}}`` stands for up to ``n`` tokens of
any kind, ``{{a|b}}`` for one of the tokens named.  All else is mandatory and must match token by token.
A compiled template is a nondeterministic automaton; a text carries the label when a run of its tokens
takes the automaton from its first token to its end.

Tokens are runs of letters, digits and non-ASCII characters, A-Z lower-cased.  Null and empty texts have no
tokens and no labels.  Repeated rows get equal answers; an empty table gives an empty result; other columns
are not read.  Texts are scanned whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm import text as tx

# Phrases with their labels, and the wording of well-known notices.
PHRASES = {
    "gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit",
}
TEMPLATES = {
    "apache-1.1": "licensed under the apache [[software]] license [[version]] 1 1",
    "apache-2.0": "licensed under the apache license [[version]] 2 0 [[the license you may not use this file except "
                  "in compliance with the license]]",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that "
           "the following conditions are met",
    "cc-by-4.0": "{{licensed|released|available}} under [[a]] [[the]] [[creative commons]] [[attribution]] cc by 4 0 "
                 "[[international]]",
    "cc-by-4.0-name": "creative commons attribution {{1}} 4 0 international [[public]] license",
    "gpl-2.0": "gnu general public license [[as published by the free software foundation]] [[either]] [[version]] "
               "{{2|v2}} [[0]]",
    "gpl-3.0": "gnu general public license [[as published by the free software foundation]] [[either]] [[version]] "
               "{{3|v3}} [[0]] [[of the license]] [[or at your option any later version]]",
    "mit": "{{available|distributed|licensed|released}} under the [[terms of the]] mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of {{8}} to deal in {{3}} "
                "without restriction",
    "mpl-2.0": "subject to the terms of the mozilla public license [[v]] [[version]] 2 0",
}
_TOKEN_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TOKEN_BYTES).split()


class Automaton(NamedTuple):
    """``steps[state]`` holds (tokens or None for any, next state); ``skips[state]`` states reached freely.

    ``literal`` is the longest run of mandatory tokens: a text without it cannot match.
    """

    steps: list[list[tuple[frozenset[bytes] | None, int]]]
    skips: list[list[int]]
    literal: bytes

    def closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for target in self.skips[todo.pop()]:
                if target not in states:
                    states.add(target)
                    todo.append(target)
        return states

    def match(self, found: list[bytes], start: int) -> int | None:
        """The end of the longest match that begins at token ``start``."""
        last, end = len(self.steps) - 1, None
        states = self.closure({0})
        for at in range(start, len(found) + 1):
            if last in states:
                end = at
            if at == len(found):
                break
            token = found[at]
            states = self.closure(
                {to for s in states for accepted, to in self.steps[s] if accepted is None or token in accepted}
            )
            if not states:
                break
        return end


def compile_template(markup: str) -> Automaton:
    steps: list[list] = [[]]
    skips: list[list[int]] = [[]]
    runs: list[list[str]] = [[]]
    opened: list[int] = []

    def advance(accepted: frozenset[bytes] | None) -> int:
        steps.append([])
        skips.append([])
        steps[-2].append((accepted, len(steps) - 1))
        return len(steps) - 2

    for part in re.findall(r"\[\[|\]\]|\{\{[^}]*\}\}|[^\s\[\]{}]+", markup):
        if part == "[[":
            opened.append(len(steps) - 1)
            runs.append([])
        elif part == "]]":
            skips[opened.pop()].append(len(steps) - 1)
            runs.append([])
        elif part.startswith("{{"):
            runs.append([])
            if part[2:-2].isdigit() and "|" not in part:
                for _ in range(int(part[2:-2])):
                    skips[advance(None)].append(len(steps) - 1)
            else:
                advance(frozenset(x.encode() for x in part[2:-2].split("|")))
        else:
            advance(frozenset([part.encode()]))
            if not opened:
                runs[-1].append(part)
    if opened:
        raise ValueError(f"an optional region is not closed: {markup}")
    longest = max(runs, key=lambda run: len(" ".join(run)))
    if not longest:
        raise ValueError(f"no mandatory wording: {markup}")
    return Automaton(steps, skips, f" {' '.join(longest)} ".encode())


class Match(NamedTuple):
    label: str
    start: int
    end: int


def phrase_places(joined: bytes, phrase: str) -> list[int]:
    """The word numbers at which a phrase stands in words joined by single blanks, blanks at both ends."""
    needle, places, at, word, counted = f" {phrase} ".encode(), [], -1, 0, 0
    while (at := joined.find(needle, at + 1)) >= 0:
        word += joined.count(b" ", counted, at)
        counted = at
        places.append(word)
    return places


def template_matches(found: list[bytes], joined: bytes, automata: dict[str, Automaton]) -> list[Match]:
    """All places where a template is accepted."""
    matches = []
    for label, automaton in automata.items():
        if automaton.literal in joined:
            first = automaton.closure({0})
            entries = [accepted for s in first for accepted, _ in automaton.steps[s]]
            for start, token in enumerate(found):
                if any(accepted is None or token in accepted for accepted in entries):
                    if (end := automaton.match(found, start)) is not None:
                        matches.append(Match(label, start, end))
    return matches


SCORES = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, matches array<struct<label: string, start: long, end: long>>"
)


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """Per document: the phrases of ``PHRASES`` it holds, the templates it matches and where.

    The score is 1 where a template is accepted, 0.5 where only a phrase is named, else 0.
    """
    automata = {label: compile_template(markup) for label, markup in (templates or TEMPLATES).items()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tx.slices(batches, "text"):
            rows = []
            for doc_id, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()):
                found = tokens(text)
                joined = b" " + b" ".join(found) + b" "
                places = {label: phrase_places(joined, phrase) for phrase, label in PHRASES.items()}
                all_places = [place for found_at in places.values() for place in found_at]
                base = {label for label, found_at in places.items() if found_at}
                matches = template_matches(found, joined, automata)
                rows.append({
                    "doc_id": doc_id, "n_words": len(found), "n_base": len(all_places),
                    "first_word": min(all_places, default=None), "last_word": max(all_places, default=None),
                    "base_labels": ",".join(sorted(base)),
                    "labels": ",".join(sorted(base | {m.label for m in matches})),
                    "score": 1.0 if matches else 0.5 if base else 0.0,
                    "matches": [m._asdict() for m in matches],
                })
            yield pa.RecordBatch.from_pylist(rows, schema=ARROW)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, SCORES)


ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("matches", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
])
