"""Inventories: numbers are those of the lines whatever the splits; cells as they stand; other headers refused."""

import csv

import pytest

from cohortmill.sources.inventory import read_inventory

COLUMNS = ["number", "name", "file"]


@pytest.fixture
def splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    yield lambda size: spark.conf.set(key, str(size))
    spark.conf.set(key, before)


def rows_of(path):
    with open(path, encoding="utf-8-sig", newline="") as f:
        return [(i, *(r[c] for c in COLUMNS)) for i, r in enumerate(csv.DictReader(f), start=1)]


@pytest.mark.parametrize("size", [400, 10_000_000])
def test_numbers_are_those_of_the_lines(spark, tmp_path, splits, size):
    for k in range(3):
        with open(tmp_path / f"part-{k}.csv", "w", encoding="utf-8-sig" if k == 1 else "utf-8", newline="") as f:
            out = csv.writer(f, lineterminator="\r\n" if k == 1 else "\n")
            out.writerow(COLUMNS)
            for i in range(0 if k == 2 else 200):
                out.writerow([f"K{(i * 7919 + k) % 1000:03d}", ["", " two  spaces ", 'a "quoted", name', "back\\slash", "é 日本"][i % 5], "x" * (i % 40)])
    with open(tmp_path / "part-0.csv", "a") as f:
        f.write("\n\nlast,,\n")
    splits(size)
    got = read_inventory(spark, str(tmp_path), COLUMNS)
    assert got.columns == ["file", "row_number", "position", *COLUMNS, "ragged"]
    assert got.filter("ragged is not null").count() == 0
    got = got.collect()
    for k in range(3):
        assert sorted(tuple(r[1:2]) + tuple(r[3:6]) for r in got if r[0] == f"part-{k}.csv") == rows_of(tmp_path / f"part-{k}.csv")
    assert [r["position"] for r in sorted(got, key=lambda r: (r[0], r["row_number"]))] == list(range(1, 402))


def test_breaks_and_ragged_rows(spark, tmp_path):
    one = tmp_path / "one.csv"
    one.write_text('number,name,file\na,"two\nlines",x\nb,short\nc,d,e,f\n,,\n')
    got = sorted(tuple(r)[1:] for r in read_inventory(spark, str(one), COLUMNS, breaks_in_cells=True).collect())
    assert [r[:5] for r in got] == [(1, 1, "a", "two\nlines", "x"), (2, 2, "b", "short", None), (3, 3, "c", "d", "e"), (4, 4, "", "", "")]
    assert [r[5] is not None for r in got] == [False, True, True, False]


@pytest.mark.parametrize("header", ["number,name", "number,name,file,more", "name,number,file", "Number,name,file", "number, name,file", "a,b,c"])
def test_other_headers(spark, tmp_path, header):
    (tmp_path / "good.csv").write_text("number,name,file\n1,2,3\n")
    (tmp_path / "other.csv").write_text(header + "\n1,2,3\n")
    with pytest.raises(ValueError, match="other.csv"):
        read_inventory(spark, str(tmp_path), COLUMNS)
