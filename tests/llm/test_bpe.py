"""Ids against the tiktoken library; boundaries against its pattern; exact round trips."""

import base64
import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from conftest import sha
from storeops.llm import bpe

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    with open(RANKS, "rb") as file:
        return bpe.Codec.of(file.read(), bpe.code_point_classes())


def texts(count=400):
    rng = random.Random(8)
    letters = list("  ''''strevmdlx1٣.-\n\t  \r\x00éß漢😀Aא") + ["'re", "'ll", "'s", "   ", "<|endoftext|>"]
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(count)]


def test_slices_are_the_patterns_matches(codec):
    for batch in (texts(), ["", " ", "\n", "'", "'s", "  'll", "a\0b"]):
        for text, parts in zip(batch, codec.slices(batch)):
            assert [p.decode() for p in parts] == regex.findall(public_tokenizers.PATTERN, text)


def test_ids_and_round_trip(codec, library):
    batch = [*texts(), "a" * 5000, "ab" * 700 + " " * 300, "Zwölf" * 90]
    for text, ids in zip(batch, codec.encode(batch)):
        assert ids.tolist() == library.encode_ordinary(text)
        ends = codec.ends(ids)
        assert codec.decode(ids, ends) == text.encode()
        assert [text.encode()[a:b] for a, b in zip([0, *ends], ends)] == [codec.tokens[i] for i in ids]


def test_forgetting_changes_nothing(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    for _ in range(3):
        for text in texts(60):
            (ids,) = codec.encode([text])
            assert ids.tolist() == library.encode_ordinary(text)


def test_scan_equals_stepping():
    rng = np.random.default_rng(1)
    for size in (1, 2, 7, 100, 1000):
        symbols = rng.integers(0, 8, size).astype(np.uint8)
        state, want = bpe.START, []
        for s in symbols.tolist():
            want.append(state)
            state = bpe._transition(s, state)
        assert bpe.states_before(symbols).tolist() == want


def test_query(spark, library):
    docs = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    rows = bpe.op8_bpe(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        text = docs[r.doc_id] or ""
        ids = library.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(text))


def test_awkward_rows(awkward, clash, empty, library):
    for docs in (awkward, clash):
        rows = bpe.encode_checked(docs).collect()
        assert len(rows) == 7 and all(r.exact and len(r.ids) == len(r.ends) == r.n_tokens for r in rows)
        assert {r.n_tokens for r in rows if r.doc_id in (2, 3)} == {0}
        back = bpe.decode(bpe.encode(docs, ["doc_id"]), ["doc_id"]).collect()
        assert {bytes(r.decoded) for r in back if r.doc_id in (1, None)} == {b"a b c d e f"}
    assert bpe.encode_checked(empty).count() == 0 and bpe.decode(bpe.encode(empty, ["doc_id"]), ["doc_id"]).count() == 0
