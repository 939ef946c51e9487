"""License wording in documents, by template markup.

A template is license wording with marked regions:

    <<optional>> ... <<end>>   words that may be missing; may be nested
    <<any 1-4>>                from 1 to 4 words of any kind

All other words are mandatory. A template is compiled to an automaton over words, and a
place in a text matches if the automaton accepts words from there on: mandatory wording
is the same, word for word, optional regions are whole or absent.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are made lower case, in texts
and templates, so case, punctuation and line breaks play no part. All words of all texts
are hashed at once. The beginning of the longest stretch of mandatory words of each
template is looked for by its hash, and the automaton starts only where it can reach such
a place. ``license_texts`` has whole licenses.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stowage.llm.license_texts import LICENSE_TEXTS
from stowage.llm.text import LOWER, WORD_BYTES, Words, slices, text_buffer, windows

# The base phrases and their labels, then wording of public licenses.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
TEMPLATES = {
    "apache-2-notice": "licensed under the apache license version 2 0 <<optional>>the license<<end>> <<optional>>you may "
                       "not use this file except in compliance with the license<<end>>",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-by": "<<optional>>this work is<<end>> licensed under <<optional>>a<<end>> <<optional>>the<<end>> creative commons "
             "attribution <<any 1-3>> international license",
    "cc-by-nc-4": "licensed under <<optional>>the<<end>> cc by nc 4 0",
    "gpl": "licensed under the <<optional>>terms of the<<end>> gnu general public license",
    "gpl-3": "<<optional>>this <<any 1-3>> is<<end>> licensed under the <<optional>>terms of the<<end>> gnu general "
             "public license <<optional>>as published by the free software foundation either<<end>> version 3 "
             "<<optional>>of the license or at your option any later version<<end>>",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "lgpl": "licensed under the <<optional>>terms of the<<end>> gnu lesser general public license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                 "associated documentation files <<optional>>the software<<end>> to deal in the software without restriction",
    "mit-release": "released under the mit license",
    "mpl-2": "this source code form is subject to the terms of the mozilla public license v 2 0",
    **LICENSE_TEXTS,
}
#: Of the longest mandatory stretch of a template so many words are looked for by hash.
CORE = 8
SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double")
_MARKUP = re.compile(r"<<(optional|end|any (\d+)-(\d+))>>|(<<)|([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


@dataclass
class Automaton:
    """States are numbers; ``words[s]`` leads on by a word, ``other[s]`` by any word, ``free[s]`` by none."""

    words: list[dict[str, int]] = field(default_factory=list)
    other: list[int | None] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)
    last: int = 0
    core: list[str] = field(default_factory=list)  # the first words of the longest mandatory stretch
    least: int = 0  # so many words at least, and at most, stand before the core
    most: int = 0

    def state(self) -> int:
        self.words.append({})
        self.other.append(None)
        self.free.append([])
        return len(self.words) - 1

    def reach(self, states: set[int]) -> set[int]:
        """``states`` and all that follow without a word."""
        todo, seen = list(states), set(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return seen

    def accepts(self, text: Sequence[str], at: int) -> bool:
        """Whether the wording stands in ``text`` from word ``at`` on."""
        now = self.reach({0})
        while now and self.last not in now and at < len(text):
            word = text[at]
            step = {self.words[s][word] for s in now if word in self.words[s]}
            step |= {self.other[s] for s in now if self.other[s] is not None}
            now = self.reach(step)
            at += 1
        return self.last in now


def compile_template(markup: str) -> Automaton:
    made = Automaton()
    now, opened, stretch, longest = made.state(), [], [], 0
    fewest = largest = 0  # words up to here

    def close() -> None:
        nonlocal longest
        if len(stretch) > longest:
            longest = len(stretch)
            made.core, made.least, made.most = stretch[:CORE], fewest - longest, largest - longest
        stretch.clear()

    for kind, least, most, word in _marks(markup):
        if word:
            new = made.state()
            made.words[now][word] = new
            now = new
            largest += 1
            if not opened:
                fewest += 1
                stretch.append(word)
            continue
        close()
        if kind == "optional":
            new = made.state()
            made.free[now].append(new)
            opened.append(now := new)
        elif kind == "end":
            new = made.state()
            made.free[now].append(new)
            made.free[opened.pop()].append(new)
            now = new
        else:
            largest += int(most)
            fewest += 0 if opened else int(least)
            begin = [now]
            for _ in range(int(most)):
                new = made.state()
                made.other[now] = new
                begin.append(now := new)
            for s in begin[int(least) : -1]:
                made.free[s].append(now)
            new = made.state()
            made.free[now].append(new)
            now = new
    close()
    if opened or not made.core:
        raise ValueError(f"not a template: {markup!r}")
    made.last = now
    return made


def _marks(markup: str) -> Iterator[tuple[str, str, str, str]]:
    """The marks and words of a template: kind, fewest and most words of ``any``, word."""
    for mark in _MARKUP.finditer(markup.translate(_LOWER)):
        kind, least, most, unknown, word = mark.groups()
        if unknown:
            raise ValueError(f"not a mark: {markup[mark.start() : mark.start() + 20]!r}")
        yield kind, least, most, word


def template_regex(markup: str) -> str:
    """The same template as a regular expression over words that each follow a space."""
    def turn(kind: str, least: str, most: str, word: str) -> str:
        if word:
            return f" {re.escape(word)}"
        return {"optional": "(?:", "end": ")?"}.get(kind) or f"(?: [^ ]+){{{least},{most}}}"

    return "".join(turn(*m) for m in _marks(markup)) + " "


def license_words(texts: pa.Array | pa.ChunkedArray) -> Words:
    data, offsets = text_buffer(texts)
    return Words(LOWER[data], offsets, WORD_BYTES)


def scan_licenses(docs: DataFrame, base: dict[str, str] | None = None, templates: dict[str, str] | None = None) -> DataFrame:
    """License wording in every row of ``docs`` (``doc_id``, ``text``); other columns are not read.

    One row per input row: ``n_words``; ``n_base``, how many places hold a base phrase;
    ``first_word`` and ``last_word``, the smallest and largest start of these, in words
    from 0 (null if none); ``base_labels`` and ``labels`` (those of templates too), each
    distinct, sorted and joined by commas ('' if none); ``score``: 1 - 2^-k for k
    distinct labels, 0 where there is none. A null text counts as empty: no words, no
    labels. Rows without an id and repeated rows are scanned as they are. An empty table
    gives no rows. Texts are read in whole: the work is linear in a text's length and in the
    places that hold a template's core, and a text lies in one task's memory.
    """
    base = BASE if base is None else base
    automata = {label: compile_template(t) for label, t in (TEMPLATES if templates is None else templates).items()}
    phrases = {tuple(p.split()): label for p, label in base.items()}
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {tuple(p): _hash(p) for p in [*phrases, *(a.core for a in automata.values())]}
        for batch in slices(batches, "text"):
            yield _scan(batch, phrases, automata, known)

    return docs.mapInArrow(scan, SCHEMA)


class _Text(Sequence):
    """The words of one row, each spelled when it is asked for."""

    def __init__(self, words: Words, row: int):
        mine = words.of_row(row)
        self.words, self.begin, self.end = words, mine.start, mine.stop

    def __len__(self) -> int:
        return self.end - self.begin

    def __getitem__(self, i: int) -> str:
        return _spell(self.words, self.begin + i)


def _spell(words: Words, i: int) -> str:
    return words.data[words.starts[i] : words.ends[i]].tobytes().decode()


def _hash(words: tuple[str, ...] | list[str]) -> np.uint64:
    h = license_words(pa.array([" ".join(words)])).hashes()
    return windows(h, len(words))[0]


def _scan(batch: pa.RecordBatch, phrases: dict, automata: dict, known: dict) -> pa.RecordBatch:
    words = license_words(batch.column("text"))
    h = words.hashes()
    by_size = {k: windows(h, k) for k in {len(p) for p in known}}

    def places(phrase: tuple[str, ...]) -> np.ndarray:
        at = np.flatnonzero(by_size[len(phrase)] == known[phrase])
        at = at[words.rows[at] == words.rows[at + len(phrase) - 1]]
        return np.array([i for i in at if all(_spell(words, i + k) == w for k, w in enumerate(phrase))], np.int64)

    n = batch.num_rows
    n_base, first, last = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
    base_labels: dict[int, set[str]] = {}
    for phrase, label in phrases.items():
        at = places(phrase)
        rows = words.rows[at]
        place = at - words.bounds[rows]
        np.add.at(n_base, rows, 1)
        np.minimum.at(first, rows, place)
        np.maximum.at(last, rows, place)
        for row in rows.tolist():
            base_labels.setdefault(row, set()).add(label)
    labels = {row: set(found) for row, found in base_labels.items()}
    for label, automaton in automata.items():
        for core in places(tuple(automaton.core)).tolist():
            row = int(words.rows[core])
            if label in labels.get(row, ()):
                continue
            text = _Text(words, row)
            place = core - text.begin
            if any(automaton.accepts(text, at) for at in range(max(place - automaton.most, 0), place - automaton.least + 1)):
                labels.setdefault(row, set()).add(label)
    none = n_base == 0
    return pa.record_batch({
        "doc_id": batch.column("doc_id"),
        "n_words": pa.array(words.counts, pa.int64()),
        "n_base": pa.array(n_base),
        "first_word": pa.array(first, mask=none),
        "last_word": pa.array(last, mask=none),
        "base_labels": pa.array([",".join(sorted(base_labels.get(r, ()))) for r in range(n)], pa.string()),
        "labels": pa.array([",".join(sorted(labels.get(r, ()))) for r in range(n)], pa.string()),
        "score": pa.array([1 - 0.5 ** len(labels.get(r, ())) for r in range(n)], pa.float64()),
    })
