"""Delimited records with line ends in quoted fields, cut anywhere."""

import csv
import random

import pytest

from quarrystone.sources import files, records


@pytest.fixture
def small_splits(spark):
    """Splits of some bytes, so that records reach over one or several borders."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}

    def use(size, number=1):
        spark.conf.set(names[0], f"{size}b")
        spark.conf.set(names[1], "0b")
        spark.conf.set(names[2], str(number))

    yield use
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def _rows(seed, n=120):
    draw = random.Random(seed)
    pieces = ["plain", "two\nlines", "a,b", 'say ""hi""'.replace('""', '"'), "\n\n", 'x"\n"y', "é\n" * 9, "w" * 90, " lead", "end\n"]
    return [(str(i), "".join(draw.choices(pieces, k=draw.randint(1, 3))), str(draw.random())) for i in range(n)]


def _write(path, rows, end="\n", above=""):
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(above)
        csv.writer(f, lineterminator=end).writerows([("id", "text", "x"), *rows])


@pytest.mark.parametrize("size", [90, 300, 10_000_000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_in_any_number_of_splits(spark, tmp_path, small_splits, size, end):
    folder = tmp_path / "in"
    folder.mkdir()
    rows = [_rows(k, 25) for k in range(3)]
    for k, part in enumerate(rows):
        _write(folder / f"p{k}.csv", part, end)
    small_splits(size)
    df = files.load_csv(spark, str(folder), multi_line=True, schema="id string, text string, x string")
    tasks = df.rdd.getNumPartitions()
    assert tasks > 10 if size < 1000 else tasks <= 3
    assert sorted(map(tuple, df.collect())) == sorted(r for part in rows for r in part)
    typed = files.load_csv(spark, str(folder), multi_line=True, usecols=["id", "x"])
    assert [t for _, t in typed.dtypes] == ["bigint", "double"] and typed.count() == 75


def test_lines_above_the_header_and_no_header(spark, tmp_path, small_splits):
    rows = _rows(5, 20)
    _write(tmp_path / "head.csv", rows, above='one "quote\nreport, by hand,,,\n')
    small_splits(120)
    df = files.load_csv(spark, str(tmp_path / "head.csv"), multi_line=True, header=2, schema="id string, text string, x string")
    assert df.columns == ["id", "text", "x"] and sorted(map(tuple, df.collect())) == sorted(rows)
    _write(tmp_path / "bare.csv", rows)
    bare = files.load_csv(spark, str(tmp_path / "bare.csv"), multi_line=True, header=None, schema="`1` string")
    assert bare.columns == ["0", "1", "2"] and bare.count() == 21


def test_rows_and_headers_that_do_not_fit(spark, tmp_path, small_splits):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text('a,b\n1,"x\ny"\n')
    (folder / "b.csv").write_text('a,c\n2,"z"\n')
    with pytest.raises(Exception, match="another header"):
        files.load_csv(spark, str(folder), multi_line=True).collect()
    (folder / "b.csv").write_text('a,b\n2,"z\n",3\n')
    with pytest.raises(Exception, match="fields of the header"):
        files.load_csv(spark, str(folder), multi_line=True).collect()
    (tmp_path / "open.csv").write_text('"never\nclosed')
    with pytest.raises(ValueError, match="whole record"):
        files.load_csv(spark, str(tmp_path / "open.csv"), multi_line=True)


def test_a_record_larger_than_many_splits(spark, tmp_path, small_splits):
    long = "line of a long field\n" * 60
    _write(tmp_path / "long.csv", [("1", "a", "0"), ("2", long, "1"), ("3", "b", "2")])
    small_splits(128)
    found = records.read_records(spark, str(tmp_path / "long.csv")).orderBy("split", "line").collect()
    assert [r.value.split(",")[0] for r in found] == ["id", "1", "2", "3"]
    df = files.load_csv(spark, str(tmp_path / "long.csv"), multi_line=True)
    assert {r.id: r.text for r in df.collect()} == {1: "a", 2: long, 3: "b"}


@pytest.mark.parametrize("nrows", [0, 1, 7, 50, 119, 120, 500])
def test_first_records_reach_over_splits(spark, tmp_path, small_splits, nrows):
    rows = _rows(3)
    _write(tmp_path / "1.csv", rows[:70])
    _write(tmp_path / "2.csv", rows[70:])
    small_splits(90)
    found = files.load_csv(spark, str(tmp_path), nrows=nrows, multi_line=True, schema="id string, text string, x string")
    assert sorted((int(r.id), r.text) for r in found.collect()) == [(int(i), t) for i, t, _ in rows[:nrows]]


@pytest.mark.parametrize("header, above", [(0, "id,x\n"), (None, ""), (2, "made by\nhand\nid,x\n")])
@pytest.mark.parametrize("nrows", [3, 40, 400])
def test_first_lines_of_several_splits(spark, tmp_path, small_splits, header, above, nrows):
    for f in range(2):
        (tmp_path / f"{f}.csv").write_text(above + "".join(f"{f * 100 + i},{'w' * (i % 9)}\n" for i in range(100)))
    small_splits(100)
    found = files.load_csv(spark, str(tmp_path), nrows=nrows, header=header)
    assert sorted(r[0] for r in found.collect()) == list(range(min(nrows, 200)))
    first = files.load_csv(spark, str(tmp_path), nrows=nrows, header=header, usecols=found.columns[:1])
    assert first.columns == found.columns[:1]


def test_first_lines_do_not_depend_on_the_order_rows_come_in(spark, tmp_path, monkeypatch):
    """Over a network the rows of the last split may come first."""
    (tmp_path / "1.csv").write_text("id\n" + "".join(f"{i}\n" for i in range(50)))
    read = files._read_delimited

    def backwards(*args, **kwargs):
        rows = read(*args, **kwargs)
        return rows.orderBy(rows["id"].cast("int").desc())

    monkeypatch.setattr(files, "_read_delimited", backwards)
    monkeypatch.setattr(files, "_heads", lambda rows: lambda batches: batches, raising=False)
    assert sorted(r.id for r in files.load_csv(spark, str(tmp_path), nrows=5).collect()) == [0, 1, 2, 3, 4]
