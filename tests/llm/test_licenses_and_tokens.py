import re

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stowage.llm import token_counts as tc
from stowage.llm.license_texts import LICENSE_TEXTS
from stowage.llm.license_scan import BASE, TEMPLATES, compile_template, scan_licenses, template_regex
from tests.llm.conftest import ODD

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=300, deadline=None)
@given(st.sampled_from([
    "a b <<optional>>c<<end>> a", "a <<any 1-2>> b", "a <<optional>>b <<any 0-2>> c<<end>> d",
    "a <<optional>>b <<optional>>c<<end>><<end>> a b", "<<optional>>b<<end>> a <<any 2-2>>",
]), st.lists(st.sampled_from("abcd"), max_size=9))
def test_automata_accept_what_the_expression_matches(markup, text):
    automaton = compile_template(markup)
    accepted = any(automaton.accepts(text, at) for at in range(len(text)))
    assert accepted == bool(re.search(template_regex(markup), " " + " ".join(text) + " "))
    for at in range(len(text)):  # a match has the core where the scan starts from
        if automaton.accepts(text, at):
            reach = range(at + automaton.least, at + automaton.most + 1)
            assert any(text[i : i + len(automaton.core)] == automaton.core for i in reach)


@pytest.mark.parametrize("bad", ["<<optional>>a<<end>>", "a <<optional>>b", "<<any 1-2>>", "a <<optinal>>b<<end>>"])
def test_templates_need_mandatory_words_and_closed_regions(bad):
    with pytest.raises(ValueError):
        compile_template(bad)


def by_hand(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    starts, labels = [], set()
    for phrase, label in BASE.items():
        p = phrase.split()
        at = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        starts += at
        labels |= {label} if at else set()
    every = labels | {label for label, t in TEMPLATES.items() if re.search(template_regex(t), " " + " ".join(w) + " ")}
    return (len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)),
            ",".join(sorted(every)), 1 - 0.5 ** len(every))


LICENSED = [
    "Released under the MIT License.", "under the\nM.I.T license", "x Under-The-MIT\tLICENSE and CC BY-NC 4.0, cc by nc",
    "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    "apache license version 20", "under the mit licenses", "This work is licensed under the GNU General Public License, version 3.",
    "licensed under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3",
    "this is licensed under the gnu general public license version 2", "cc by nc cc by nc cc by", "é under the mit license é",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    "files (the \"Software\"), to deal in the Software without restriction",
    "word " * 5000 + "under the MIT license " + "word " * 5000,
]


def test_scans_are_those_by_hand(documents):
    rows = [(i + 100, t) for i, t in enumerate(LICENSED)] + ODD
    got = [tuple(r) for r in scan_licenses(documents(*rows)).collect()]
    assert sorted(got, key=str) == sorted(((d, *by_hand(t)) for d, t in rows), key=str)
    assert sum(r[6] != "" for r in got) >= 9
    assert scan_licenses(documents()).collect() == []


def copy_of(template, optional=True):
    """A license as it stands in the world: regions filled in, marks of optional ones gone or with their words."""
    text = re.sub(r"<<any 0-1>>", "3. " if optional else "", template)
    text = re.sub(r"<<any 1-\d+>>", "Jane Doe & others", text)
    return re.sub(r"<<optional>>(.*?)<<end>>", r"\1" if optional else "", text)


@pytest.mark.parametrize("optional", [True, False])
def test_whole_licenses_are_found_and_changed_ones_refused(documents, optional):
    rows, want = [], {}
    for label, template in LICENSE_TEXTS.items():
        words = copy_of(template, optional).split()
        for text, found in [
            ("The Title\n(c) 2024 J. Doe\n" + " ".join(words) + " and more", True),
            ("x " * 3000 + "\n * ".join(words).upper(), True),
            (" ".join([*words[:3], "not", *words[3:]]), False),
            (" ".join([*words[:3], *words[4:]]), False),
            (" ".join([*words[:-2], "not", *words[-2:]]), False),
            (" ".join(words[:-1]), False),
        ]:
            want[len(rows)] = (label, found)
            rows.append((len(rows), text))
    for r in scan_licenses(documents(*rows)).collect():
        label, found = want[r.doc_id]
        assert (label in r.labels.split(",")) == found, (label, r.doc_id)
        assert r.labels == by_hand(rows[r.doc_id][1])[5]


def test_a_core_that_repeats_is_read_on(documents):
    tail = " international license"
    rows = [(1, "creative commons attribution " * 3000), (2, "licensed under creative commons attribution " * 2000 + "4 0" + tail),
            (3, "licensed under a the creative commons attribution x y z w" + tail)]
    assert [r.labels for r in sorted(scan_licenses(documents(*rows)).collect())] == ["", "cc-by", ""]


TEXTS = ["Hello  World", "hello world", " Hello World\n", "Hello World", "", None, "<|endoftext|>", "a<|endoftext|>b　c", "don't 123",
         "İstanbul ΣΑΣ ǆ é", "日本語 テキスト", "\xa0a\x1cb\x85c", "x" * 5000, "tok " * 50_000, "<|startoftext|> <|end oftext|>"]


def test_tokens_are_the_librarys(documents, tmp_path):
    rows = list(enumerate(TEXTS)) + ODD[3:6]
    got = tc.count_tokens(documents(*rows), PATH, str(tmp_path / "cache")).collect()
    coder = Tokenizer.from_file(PATH)
    want = [(d, len((t or "").encode()), len(coder.encode(t or "", add_special_tokens=False)), ) for d, t in rows]
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=str) == sorted(want, key=str)
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    assert tc.count_tokens(documents(), PATH, str(tmp_path / "other")).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_stretches_add_up(text):
    text = text.encode("utf-8", "ignore").decode()
    assert tc.count_batch([text], PATH, True) == tc.count_batch([text], PATH, False)


def test_only_misses_are_encoded(spark, documents, tmp_path):
    cache = str(tmp_path / "cache")
    tc.count_tokens(documents((1, "a b"), (2, "a  b"), (3, "c")), PATH, cache).collect()
    stored = spark.read.parquet(cache)
    assert stored.count() == 2  # one for "a b" in both forms
    # A doctored count shows that what is stored is used, and for its own tokenizer only.
    doctored = [(r.content, r.tokenizer, 7) for r in stored.collect()]
    lied = str(tmp_path / "lied")
    spark.createDataFrame(doctored + [(c, "another", 99) for c, _, _ in doctored], tc.CACHE).write.parquet(lied)
    got = {r.doc_id: r.n_tokens for r in tc.count_tokens(documents((1, "a b"), (5, "d e f"), (6, " a b ")), PATH, lied).collect()}
    assert got == {1: 7, 5: 3, 6: 7}
    assert spark.read.parquet(lied).count() == 5
    whole = tc.count_tokens(documents((1, "a b"), (2, "a  b")), PATH, lied, normalise=False).collect()
    assert [r.n_tokens for r in whole] == [7, 2] or {r.doc_id: r.n_tokens for r in whole} == {1: 7, 2: 2}


def test_what_a_worker_remembers_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(tc, "MEMO_BYTES", 2000)
    texts = [f"{chr(97 + n % 26) * 50}{n} word {n}" for n in range(100)]
    assert tc.count_batch(texts, PATH, True) == tc.count_batch(texts, PATH, False)
    memo = tc._memo(PATH)
    assert memo.size <= 2000 + 3 * tc.ENTRY_BYTES + 200
    assert memo.size == sum(map(len, memo.known)) + tc.ENTRY_BYTES * len(memo.known)
