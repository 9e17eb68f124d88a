"""Edit matching against the plain dynamic program."""

import random

import duckdb

from storeops.llm import decontaminate as d

SF = "/root/testdata/sf0.001"


def table_of(pattern, text, anchored):
    row = list(range(len(text) + 1)) if anchored else [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != x), row[j] + 1, new[-1] + 1))
        row = new
    return row[1:]


def test_bit_vectors_are_the_dynamic_program():
    rng = random.Random(1)
    for _ in range(400):
        pattern = "".join(rng.choice("ab ") for _ in range(rng.randint(1, 70)))
        text = "".join(rng.choice("abé ") for _ in range(rng.randint(0, 90)))
        for anchored in (False, True):
            assert d.end_distances(pattern, text, anchored) == table_of(pattern, text, anchored)


def test_every_place_within_the_budget_is_found():
    rng = random.Random(2)
    letters = "abcdefgh "
    for _ in range(60):
        item = "".join(rng.choice(letters) for _ in range(rng.randint(20, 120)))
        budget = len(item) // d.CHARS_PER_EDIT
        edited = list(item)
        for _ in range(rng.randint(0, budget + 2)):
            at = rng.randrange(len(edited))
            edited[at : at + 1] = rng.choice([[], [rng.choice(letters)], [edited[at], "z"]])
        text = "".join(rng.choice(letters) for _ in range(60)) + "".join(edited) + "".join(rng.choice(letters) for _ in range(60))
        best = min(table_of(item, text, False))
        hits = d.Matcher.of([(9, item)]).search(text)
        assert bool(hits) == (best <= budget)
        if hits:
            assert min(h[3] for h in hits) == best
            for number, start, end, distance in hits:
                assert number == 9 and table_of(item, text[start:end], True)[-1] == distance


def test_query_finds_all_exact_passages(spark):
    hits = d.op7_decontaminate(spark, SF).collect()
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    held = {(i, n): d.fold(t.encode()) for n, t in items for i, x in docs if d.fold(t.encode()) in d.fold(x.encode())}
    assert set(held) <= {(r.doc_id, r.item_id) for r in hits}
    texts = dict(docs)
    for r in hits:
        if r.distance == 0:
            assert d.fold(texts[r.doc_id].encode())[r.start : r.end] == held[r.doc_id, r.item_id]
        else:
            assert r.distance <= len(dict(items)[r.item_id]) // d.CHARS_PER_EDIT


def test_query_against_the_dynamic_program(spark, tmp_path):
    """All rows of the query: a place for each pair of text and item whose least distance is within the budget."""
    rng = random.Random(6)
    words = [f"{a}{b}" for a in ("ba", "ko", "li", "mu", "ze") for b in ("n", "st", "ra", "")]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([3, 12, 30])))) for i in range(12)]
    texts = []
    for i in range(60):
        text = " ".join(rng.choices(words, k=40))
        for _, item in rng.sample(items, rng.choice([0, 1, 2])):
            edited = list(item.upper() if i % 3 else item)
            for _ in range(rng.choice([0, 1, 2, 4])):
                at = rng.randrange(len(edited))
                edited[at : at + 1] = rng.choice([[], ["q"], [edited[at], "z"]])
            text += rng.choice([" ", "\n", ""]) + "".join(edited) + " " + " ".join(rng.choices(words, k=9))
        texts.append((i, text))
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = d.op7_decontaminate(spark, str(tmp_path)).collect()
    best = {(i, n): min(table_of(d.fold(t.encode()), d.fold(x.encode()), False)) for i, x in texts for n, t in items}
    budget = {n: len(t) // d.CHARS_PER_EDIT for n, t in items}
    want = {pair for pair, distance in best.items() if distance <= budget[pair[1]]}
    assert {(r.doc_id, r.item_id) for r in rows} == want and any(best[p] for p in want)
    closest = {}
    for r in rows:
        item, text = d.fold(dict(items)[r.item_id].encode()), d.fold(dict(texts)[r.doc_id].encode())
        assert table_of(item, text[r.start : r.end], True)[-1] == r.distance
        closest[r.doc_id, r.item_id] = min(r.distance, closest.get((r.doc_id, r.item_id), 99))
    assert closest == {p: best[p] for p in want}


def test_an_item_without_id_still_contaminates(spark, docs_of):
    passage = "the quick brown fox jumps over the lazy dog and runs far away"
    items = spark.createDataFrame([(None, passage)], "item_id long, text string")
    docs = docs_of(f"so {passage} it is", "clean")
    assert [r.text for r in d.keep_clean(docs, items).collect()] == ["clean"] and d.find_items(docs, items, ["doc_id"]).count() == 0


def test_awkward_rows(spark, docs_of, awkward, clash, empty, monkeypatch):
    passage = "the quick brown fox jumps over the lazy dog and runs far away"
    items = spark.createDataFrame([(1, passage), (1, passage), (2, None), (3, ""), (None, "x"), (4, "é" * 30)], "item_id long, text string")
    docs = docs_of(f"so: {passage.upper()}.", passage.replace("lazy", "lasy"), f"ééé {'é' * 30}", "clean", None, ids=[5, 5, 6, 7, None])
    for size in (d.BLOCK_BYTES, 40):  # one block, and several passes
        monkeypatch.setattr(d, "BLOCK_BYTES", size)
        got = sorted((r.doc_id, r.item_id, r.start, r.end, r.distance) for r in d.find_items(docs, items, ["doc_id"]).collect())
        assert got[:2] == [(5, 1, 0, 61, 1), (5, 1, 4, 65, 0)] and {g[:2] for g in got} == {(5, 1), (6, 4)}
        assert sorted(r.text or "" for r in d.keep_clean(docs, items).collect()) == ["", "clean"]
    assert d.find_items(clash, items, ["doc_id"]).count() == 0
    assert sorted(map(str, d.keep_clean(clash, items).collect())) == sorted(map(str, clash.collect()))
    assert d.find_items(empty, items, ["doc_id"]).count() == 0 and d.keep_clean(empty, items).count() == 0
    assert d.keep_clean(docs, items.limit(0)).count() == 5
