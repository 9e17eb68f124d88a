"""Counts against the tokenizers library; licence words, phrases and expressions against plain scans."""

import random
import re

import duckdb
import public_tokenizers
import pytest
from tokenizers.models import Unigram

from storeops.llm import licences as lic
from storeops.llm import tokencount as tc

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocabulary():
    return tc.load(public_tokenizers.path("piece_bpe_32k.model"))


def library(vocabulary):
    return Unigram([("\x01unknown", 0.0), *vocabulary.pieces], 0, False)


def counted(model, text, as_bytes=True):
    if not text:
        return 0
    found = model.tokenize(tc.BLANK + text.replace(" ", tc.BLANK))
    return sum(1 if t.id or not as_bytes else len(t.value.encode()) for t in found)


def test_published_vocabulary(vocabulary):
    model, counter = library(vocabulary), tc.Counter(vocabulary)
    rng = random.Random(1)
    letters = list("  the inngaé漢😀\n\tñ▁==**A1\x00")
    for _ in range(800):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 25)))
        assert counter.count(text)[1] == counted(model, text)


def test_ties_and_unknown_runs():
    """Tiny vocabularies full of equal scores, unknown characters counted by the run."""
    rng = random.Random(2)
    for _ in range(800):
        pieces = {"".join(rng.choice("ab▁") for _ in range(rng.randint(1, 3))): -float(rng.randint(1, 3)) for _ in range(rng.randint(1, 6))}
        vocabulary = tc.Vocabulary(tuple(pieces.items()), False)
        text = "".join(rng.choice("ab cd") for _ in range(rng.randint(0, 12)))
        assert tc.Counter(vocabulary).count(text)[1] == counted(library(vocabulary), text, False)


def test_forgetting_changes_nothing(vocabulary, monkeypatch):
    text = "The cat sat on the mat and the dog did not"
    whole = tc.Counter(vocabulary).count(text)
    monkeypatch.setattr(tc, "REMEMBERED", 1)
    assert tc.Counter(vocabulary).count(text) == whole


def test_token_query(spark, vocabulary):
    model = library(vocabulary)
    docs = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    rows = tc.op3_token_counts(spark, SF).collect()
    assert {r.doc_id: (r.n_tokens, r.n_chars) for r in rows} == {i: (counted(model, t or ""), len(t or "")) for i, t in docs.items()}


def test_awkward_tokens(awkward, clash, empty, vocabulary):
    for docs in (awkward, clash):
        rows = tc.token_counts(docs, ["doc_id"], vocabulary).collect()
        assert len(rows) == 7 and {(r.n_tokens, r.score) for r in rows if r.doc_id in (2, 3)} == {(0, 0.0)}
        assert len({r.n_tokens for r in rows if r.doc_id in (1, None)}) == 1
    assert tc.token_counts(empty, ["doc_id"], vocabulary).count() == 0


PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hits = [(i, v) for p, v in PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    at = [i for i, _ in hits]
    return len(words), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({v for _, v in hits}))


def read(rows):
    return {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows}


def test_licence_query(spark):
    docs = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    rows = lic.op10_licences(spark, SF).collect()
    assert read(rows) == {i: plain(t) for i, t in docs.items()}
    for r in rows:
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_hard_licence_texts(spark, docs_of, tmp_path):
    texts = [
        "MIT License, mit-license; the MIT\nLICENSE mit licenses xmit license é mit license",
        "GNU General Public License General Public License MIT License license",
        "# SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0\nx SPDX-License-Identifier: GPL-3.0 WITH Classpath-exception-2.0",
        "SPDX-License-Identifier: MIT OR\nspdx-license-identifier:\nSPDX-License-Identifier: (MIT",
        "all rights reserved " * 3,
        None,
        "",
    ]
    docs_of(*texts).write.parquet(str(tmp_path / "documents.parquet"))
    rows = lic.op10_licences(spark, str(tmp_path)).collect()
    assert read(rows) == {i: plain(t) for i, t in enumerate(texts)}
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].labels == "apache-2.0,gpl-2.0-only,gpl-3.0,mit" and by_id[2].score == lic.WEAK
    assert by_id[3].labels == "" and by_id[3].score == 0
    assert by_id[4].labels == "all-rights-reserved" and by_id[4].score == 1
    assert by_id[5].labels == by_id[6].labels == "" and by_id[5].n_words == 0


@pytest.mark.parametrize(
    "text, asks",
    [
        ("mit", 0.25), ("mit or gpl-2.0", 0.25), ("mit and gpl-2.0", 0.75), ("mit or gpl-2.0 and cc-by-nc-4.0", 0.25),
        ("(mit or gpl-2.0) and cc-by-nc-4.0", 1.0), ("gpl-2.0 with x-exception", 0.5), ("gpl-2.0 with x or 0bsd", 0.0),
        ("something-else", 1.0), ("mit or", None), ("or mit", None), ("(mit", None), ("mit)", None), ("mit gpl", None), ("", None), ("()", None),
    ],
)
def test_expressions(text, asks):
    found = lic.evaluate(text)
    assert (found and found[0]) == asks


def test_awkward_licences(awkward, clash, empty):
    for docs in (awkward, clash):
        rows = lic.find_licences(docs, ["doc_id"]).collect()
        assert len(rows) == 7 and {r.n_words for r in rows if r.doc_id in (2, 3, 4)} == {0}
    assert lic.find_licences(empty, ["doc_id"]).count() == 0
