"""The near-dedup stage against the Jaccard likeness of all pairs of texts."""

import random
import re

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from storeops.llm import simhash
from storeops.llm.common import table
from test_simhash import slow_print

SF = "/root/testdata/sf0.001"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def slow_kept(rows):
    """Smallest ids of the components, for (id, text) rows; and the number of unequal sets that are alike."""
    root, sets, prints, n = {i: i for i, _ in rows}, {i: shingles(t) for i, t in rows}, {i: slow_print(t) for i, t in rows}, 0

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, _) in enumerate(rows):
        for j, _ in rows[:k]:
            both = len(sets[i] & sets[j])
            like = sets[i] == sets[j] or both * 5 >= 4 * len(sets[i] | sets[j])
            n += like and sets[i] != sets[j]
            if like or (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return sorted(i for i in root if find(i) == i), n


def test_stage_on_the_given_table(spark):
    kept, n = slow_kept(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall())
    assert n > 0
    got = corpus_pipeline.drop_near_duplicates(spark, table(spark, SF, "documents"), SF)
    assert sorted(r.doc_id for r in got.collect()) == kept


@pytest.mark.parametrize("crowded", [64, 1])
def test_edited_copies_around_the_bound(docs_of, monkeypatch, crowded):
    """Chains of edits of several sizes, with one line in all texts; with a bound of 1 every shared cell is crowded."""
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = random.Random(3)
    line = " ".join(f"common{i}" for i in range(12))
    texts = ["", " ", "one", "ONE", "one two", "a b c d e f", "a b c d e f g"]
    for _ in range(8):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([20, 60, 150]))]
        for _ in range(9):
            texts.append(f"{line} {' '.join(words)}")
            for _ in range(rng.choice([0, 1, 2])):
                at = rng.randrange(len(words))
                words[at : at + rng.choice([0, 1, 1, 4])] = [f"n{rng.randrange(5000)}"]
    rng.shuffle(texts)
    kept, n = slow_kept(list(enumerate(texts)))
    assert n > 20
    assert sorted(r.doc_id for r in simhash.keep_first(docs_of(*texts)).collect()) == kept


@pytest.mark.parametrize("leaders, heads", [(1, 1), (3, 2), (3, 16)])
def test_cells_larger_than_their_leaders(docs_of, monkeypatch, leaders, heads):
    """Groups whose members are often alike, but seldom like the smallest ones; nothing is lost, few pairs are met twice."""
    monkeypatch.setattr(simhash, "LEADERS", leaders)
    monkeypatch.setattr(simhash, "FIRST_CELLS", heads)
    rng = random.Random(11)
    texts = []
    for _ in range(4):
        words = [f"w{rng.randrange(10**6)}" for _ in range(80)]
        for _ in range(30):
            copy = list(words)
            for _ in range(rng.choice([1, 1, 2])):
                copy[rng.randrange(30, 80)] = f"n{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    kept, n = slow_kept(list(enumerate(texts)))
    assert n > 100 and 4 < len(kept) < 120
    assert sorted(r.doc_id for r in simhash.keep_first(docs_of(*texts)).collect()) == kept


def test_many_unlike_texts_with_one_rare_line(docs_of, monkeypatch):
    """A line that the sample cannot know: its cells are crowded, are put last, and next to no pairs are compared."""
    monkeypatch.setattr(simhash, "COMMON", 10**9)
    rng = random.Random(8)
    line = " ".join(f"line{i}" for i in range(14))
    texts = [f"{' '.join(f'w{rng.randrange(10**6)}' for _ in range(40))} {line}" for _ in range(5000)]
    compared = []
    real = simhash.checked
    monkeypatch.setattr(simhash, "checked", lambda pairs, sets, texts: compared.append(pairs.count()) or real(pairs, sets, texts))
    assert simhash.keep_first(docs_of(*texts, texts[7] + " more")).count() == 5000
    assert sum(compared) < 50


def test_tallies_never_lose_a_pair_that_is_alike():
    rng = np.random.default_rng(7)
    for n in (1, 2, 3, 4, 9, 63, 64, 65, 127, 128, 300, 2_000, 40_000):
        for _ in range(6):
            left = rng.integers(-(1 << 63), (1 << 63) - 1, n)
            cut = max(0, n - -(-4 * n // 5))
            for right in (left[cut:], np.concatenate([left, rng.integers(-(1 << 63), (1 << 63) - 1, n // 4)])):
                common, every = len(np.intersect1d(left, right)), len(np.union1d(left, right))
                assert common * 5 >= every * 4
                a, b = (simhash.tally(np.unique(x)) for x in (left, right))
                assert simhash.may_be_alike(a, b) and simhash.may_be_alike(b, a)


def test_tallies_tell_most_unlike_sets_apart():
    rng = np.random.default_rng(8)
    for n in (60, 300, 5_000):
        sets = [np.unique(rng.integers(-(1 << 63), (1 << 63) - 1, n)) for _ in range(20)]
        half = [np.unique(np.concatenate([x[: n // 2], y[n // 2 :]])) for x, y in zip(sets, sets[1:])]
        marks = [simhash.tally(x) for x in sets]
        assert not any(simhash.may_be_alike(x, y) for x, y in zip(marks, marks[1:]))
        assert sum(simhash.may_be_alike(x, simhash.tally(y)) for x, y in zip(marks, half)) <= 2


def test_a_full_class_says_nothing():
    full = np.arange(300, dtype=np.int64) << 20
    assert simhash.may_be_alike(simhash.tally(full), simhash.tally(full + 1))
