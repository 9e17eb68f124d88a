"""Split reading of CSV with quoted line breaks against a one-task parser."""

import csv
import io
import os
import random

import pyarrow as pa
import pytest

from storeops.schemas import EXTRACTS
from storeops.sources import landing, quoted_csv


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def messy(seed, width, rows, end="\n"):
    rng = random.Random(seed)
    parts = ["a", "é", " ", ",", '"', "\n", "\r\n", "x y", "1.50", "\n\n", '""', "long " * 60]
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow([f"head{i}" + ("\nmore" if i == 1 and seed % 2 else "") for i in range(width)])
    for _ in range(rows):
        writer.writerow(["".join(rng.choices(parts, k=rng.choice([0, 1, 1, 2, 4, 9]))) or "z" for _ in range(width)])
    return out.getvalue()


def expected(text, width):
    rows = list(csv.reader(io.StringIO(text, newline="")))[1:]
    return sorted(tuple(v or None for v in r) for r in rows if r)


@pytest.mark.parametrize("seed", range(6))
def test_splits_give_the_rows_of_one_task(spark, tmp_path, small_splits, seed):
    names = list(EXTRACTS["waste_log"])
    text = messy(seed, len(names), 40, "\r\n" if seed % 3 == 2 else "\n")
    (tmp_path / "waste_log_extract.csv").write_bytes(text.encode())
    rows = landing.land_extract(spark, str(tmp_path), "waste_log")
    assert rows.select(*names).rdd.getNumPartitions() > 3
    got = sorted((tuple(r[n] for n in names) for r in rows.collect()), key=repr)
    assert got == sorted(expected(text, len(names)), key=repr)


def test_states_of_lines():
    cases = {
        b"a,b": (False, True), b'a,"b': (True, False), b'"a""': (True, False), b'a"b,c': (False, False), b'x",y': (False, False),
        b'x","y': (True, True), b'""': (False, True), b'"a","': (True, True), b"": (False, True),
    }
    for line, (out, into) in cases.items():
        assert (quoted_csv.inside_after(line, False), quoted_csv.inside_after(line, True)) == (out, into), line


def test_all_extracts(spark, tmp_path, small_splits):
    """Line breaks in a field of every extract, files cut into ranges, rows as a parser of whole files gives them."""
    (tmp_path / "in").mkdir()
    texts = {}
    for k, (name, columns) in enumerate(EXTRACTS.items()):
        texts[name] = messy(k, len(columns), 25)
        (tmp_path / "in" / (f"{name}.csv" if name.startswith("ref_") else f"{name}_extract.csv")).write_bytes(texts[name].encode())
    raw = landing.land_all(spark, str(tmp_path / "in"))
    for name, columns in EXTRACTS.items():
        got = sorted((tuple(r) for r in raw[name].select(*columns).collect()), key=repr)
        assert got == sorted(expected(texts[name], len(columns)), key=repr), name


def test_files_picked_by_a_regular_expression(spark, tmp_path):
    for name in ("2026/03/pos_1.csv", "2026/13/pos_2.csv", "2026/04/pos_x.csv", "old/2026/05/pos_3.csv"):
        os.makedirs(tmp_path / os.path.dirname(name), exist_ok=True)
        (tmp_path / name).write_text("h\n" + name + "\n")
    for multiline in (True, False):
        rows = landing.land_extract(spark, str(tmp_path), "pos_sales", path_regex=r"2026/(0[1-9]|1[0-2])/pos_[0-9]+[.]csv", multiline=multiline)
        assert [r.business_date for r in rows.collect()] == ["2026/03/pos_1.csv"]
        assert landing.land_extract(spark, str(tmp_path), "pos_sales", path_regex="nothing", multiline=multiline).count() == 0


def test_land_all_takes_a_choice_per_extract(spark, tmp_path):
    for name, columns in EXTRACTS.items():
        (tmp_path / (f"{name}.csv" if name.startswith("ref_") else f"{name}_extract.csv")).write_text("h\n" + ",".join(columns) + "\n")
    raw = landing.land_all(spark, str(tmp_path), multiline={"pos_sales": False})
    assert {n: df.count() for n, df in raw.items()} == dict.fromkeys(EXTRACTS, 1)
    plans = {n: df._jdf.queryExecution().toString() for n, df in raw.items()}
    assert "MapInArrow" not in plans["pos_sales"] and "MapInArrow" in plans["timeclock"]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_stretches_without_quotes(spark, tmp_path, small_splits, end):
    """Plain lines between quoted ones, also as the inside of a quoted field that covers whole ranges."""
    rng, width = random.Random(3), len(EXTRACTS["waste_log"])
    odd = ['"a,""b"",c",2', f'x,"{end}y"', "", " ", "short", "," * 20, 'a"b,c', '""', "bad \udcff,1", 'z,"' + f"in,side{end}" * 300 + '",7']
    lines = ["\ufeffh,h"]
    for n in [1, 63, 64, 65, 150, *rng.choices([0, 1, 2, 64, 100], k=25)]:
        lines += [*(f"{i},é,,{'x' * (i % 3)}" for i in range(n)), rng.choice(odd)]
    data = end.join([*lines, *odd, ""]).encode("utf-8", "surrogateescape")
    (tmp_path / "waste_log_extract.csv").write_bytes(data)
    found = list(csv.reader(io.StringIO(data.decode("utf-8-sig", "replace"), newline="")))[1:]
    expected = [tuple(v or None for v in r[:width]) + (None,) * (width - len(r)) for r in found if r]
    got = landing.land_extract(spark, str(tmp_path), "waste_log").select(*EXTRACTS["waste_log"]).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_plain_lines_pass_python_once(spark, tmp_path):
    (tmp_path / "pos_sales_extract.csv").write_text("h\n" + "1999-01-01,store,item\n" * 500)
    assert quoted_csv.ranges(quoted_csv.text_lines(spark, str(tmp_path))).count() == 0
    plan = landing.land_extract(spark, str(tmp_path), "pos_sales")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_only_odd_lines_are_taken_one_by_one():
    plain = 200
    values = pa.array([b"a,,c,d"] * plain + [b'"q"', b"a\rb", b"x\r", b"", b"\r"], pa.binary())
    lines, hard = quoted_csv.plain_lines(values)
    assert hard == [plain, plain + 1]
    assert quoted_csv.cut_plain(lines[:plain], 3).to_pylist() == [["a", None, "c"]] * plain
    assert quoted_csv.cut_plain(lines[plain + 2 :], 3).to_pylist() == [["x"]]
    assert quoted_csv.plain_lines(pa.array([b"\xff"]))[0] is None


def test_ranges_stay_the_same_beside_other_files(spark, tmp_path):
    """With splits by the sizes of all files, a scan of one file alone would be cut elsewhere."""
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        quoted = "".join(f'"{i},\nb{i}",x{i}\n' for i in range(9000))
        (tmp_path / "a_waste_log_extract.csv").write_text("h\n" + quoted)
        (tmp_path / "b_waste_log_extract.csv").write_text("h\n" + "p,q\n" * 9000)
        rows = landing.land_extract(spark, str(tmp_path), "waste_log", pattern="*.csv").select(*list(EXTRACTS["waste_log"])[:2]).collect()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert sorted(map(tuple, rows)) == sorted([(f"{i},\nb{i}", f"x{i}") for i in range(9000)] + [("p", "q")] * 9000)
