"""Inputs that once gave a wrong answer in silence."""

import numpy as np
import pytest

from quarrystone.functions.pvalues import _chi_square_tail, _t_two_sided
from quarrystone.operators import charts, correlation, descriptive, modeling, splitting
from quarrystone.plans import ordering, scratch
from quarrystone.sources.excel import load_excel
from quarrystone.sources.files import load_csv, load_json, load_text
from quarrystone.streaming import batches

from test_sources import write_workbook


@pytest.mark.parametrize("dof,tail", [(1e7, 0.4999405), (1e8, 0.4999812)])
def test_chi_square_tail_of_many_degrees(dof, tail):
    found = _chi_square_tail(np.array([dof, 10.0]), np.array([dof, 10.0]))
    assert found[0] == pytest.approx(tail, abs=1e-6)
    assert found[1] == pytest.approx(0.440493285, abs=1e-8)


def test_tails_join_up_where_the_form_changes():
    for x in (0.995, 1.0, 1.004):
        low, high = _chi_square_tail(np.array([x * 99_999, x * 100_001]), np.array([99_999.0, 100_001.0]))
        assert low == pytest.approx(high, rel=5e-3)
    few, many = _t_two_sided(np.array([1.5, 1.5]), np.array([999_999.0, 1_000_001.0]))
    assert few == pytest.approx(many, abs=1e-9)
    assert _t_two_sided(np.array([1.5]), np.array([1e11]))[0] == pytest.approx(0.13361440, abs=1e-7)


def test_headings_that_coincide(spark):
    rows = [("r", "a_b", "c", 1), ("r", "a", "b_c", 10), ("s", "a", "c", 5)]
    df = spark.createDataFrame(rows, "i string, x string, y string, v int")
    cells = descriptive.pivot_cells(df, index="i", columns=["x", "y"], values="v").collect()
    assert sorted(int(c.cell) for c in cells) == [1, 5, 10]
    with pytest.raises(ValueError, match="heading"):
        descriptive.pivot_summary(df, index="i", columns=["x", "y"], values="v")


def test_points_without_a_box(spark):
    rows = [("a", float(v)) for v in [*range(20), 500]] + [(None, float(v)) for v in [*range(20), 900]]
    found = charts.box_outliers(spark.createDataFrame(rows, "g string, v double"), y="v", x="g").collect()
    assert [tuple(r) for r in found] == [("a", 500.0)]


def test_headers_of_several_files(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,x\n")
    (tmp_path / "2.csv").write_text("b,a\ny,2\n")
    with pytest.raises(Exception, match="header"):
        load_csv(spark, str(tmp_path)).collect()


def test_a_key_that_repeats(spark):
    df = spark.range(1000).selectExpr("id", "id % 3 AS k")
    with pytest.raises(ValueError, match="key"):
        splitting.train_test(df, test_size=0.2, key="k")


def test_rows_with_more_fields_than_names(spark, tmp_path):
    (tmp_path / "short.csv").write_text('a,b\n1,"x,y"\n2\n')
    assert sorted(tuple(r) for r in load_csv(spark, str(tmp_path / "short.csv")).collect()) == [(1, "x,y"), (2, None)]
    for body, header in (("a,b\n1,x\n3,4,5\n", 0), ("1,x\n3,4,5\n", None), ("junk\na,b\n1,x\n3,4,\n", 1)):
        (tmp_path / "long.csv").write_text(body)
        with pytest.raises(Exception, match="fields of the header"):
            load_csv(spark, str(tmp_path / "long.csv"), header=header).collect()
        with pytest.raises(Exception, match="fields of the header"):
            load_csv(spark, str(tmp_path / "long.csv"), header=header, schema="a string, b string").count()


def test_a_guessed_separator_must_be_in_every_row(spark, tmp_path):
    (tmp_path / "mixed.txt").write_text("a;b\n" + "1;x\n" * 60 + "2,y\n")
    with pytest.raises(Exception, match="fields of the header"):
        load_text(spark, str(tmp_path / "mixed.txt")).collect()


def test_first_rows_in_file_order_decide_their_types(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a\n1\n2\n")
    (tmp_path / "2.csv").write_text("a\n3\nx\n" + "y\n" * 1000)
    df = load_csv(spark, str(tmp_path), nrows=3)
    assert df.dtypes == [("a", "bigint")] and sorted(r.a for r in df.collect()) == [1, 2, 3]


def test_json_documents_with_columns_of_their_own(spark, tmp_path):
    (tmp_path / "1.json").write_text('{"columns":["a","b"],"data":[[1,"x"]]}')
    (tmp_path / "2.json").write_text('{"columns":["b","a","c"],"data":[["y",2,9]]}')
    rows = load_json(spark, str(tmp_path), orient="split").orderBy("a").select("a", "b", "c").collect()
    assert [tuple(r) for r in rows] == [(1, "x", None), (2, "y", 9)]


def test_json_tables_with_fields_of_their_own(spark, tmp_path):
    one = '{"schema":{"fields":[{"name":"a","type":"integer"}]},"data":[{"a":1}]}'
    two = '{"schema":{"fields":[{"name":"b","type":"string"},{"name":"a","type":"integer"}]},"data":[{"b":"y","a":2}]}'
    (tmp_path / "1.json").write_text(one)
    (tmp_path / "2.json").write_text(two)
    rows = load_json(spark, str(tmp_path), orient="table").orderBy("a").select("a", "b").collect()
    assert [tuple(r) for r in rows] == [(1, None), (2, "y")]


def test_workbooks_with_headers_of_their_own(spark, tmp_path):
    write_workbook(tmp_path / "1.xlsx", {"s": [["a", "b"], [1, "x"]]})
    write_workbook(tmp_path / "2.xlsx", {"s": [["b", "a", "a"], ["y", 2, 7]]})
    df = load_excel(spark, str(tmp_path))
    rows = df.orderBy("a").select("a", "b", "`a.1`").collect()
    assert [tuple(r) for r in rows] == [(1, "x", None), (2, "y", 7)]


@pytest.mark.parametrize("offset", [0.0, 1e9])
def test_pearson_is_one_formula(spark, monkeypatch, offset):
    rng = np.random.default_rng(3)
    x = offset + rng.normal(size=400)
    y = np.where(rng.random(400) < 0.3, np.nan, x + rng.normal(size=400))
    rows = [(float(a), None if np.isnan(b) else float(b), 0.1, float(i) if i < 3 else 1e12) for i, (a, b) in enumerate(zip(x, y))]
    rows += [(None, None, 0.1, 1e15)] * 50
    df = spark.createDataFrame(rows, "x double, y double, c double, z double").repartition(5)
    pairs = [("x", "y"), ("x", "c"), ("c", "c"), ("x", "z"), ("y", "z")]

    def found():
        return {(r[0], r[1]): r[2] for r in correlation.correlate_pairs(df, pairs).collect()}

    few = found()
    columns = {c: np.array([np.nan if r[k] is None else r[k] for r in rows]) for k, c in enumerate("xycz")}
    for a, b in [("x", "y"), ("x", "z"), ("y", "z")]:
        both = ~np.isnan(columns[a]) & ~np.isnan(columns[b])
        assert few[a, b] == pytest.approx(np.corrcoef(columns[a][both], columns[b][both])[0, 1], abs=1e-7)
    assert few["x", "c"] is None and few["c", "c"] is None


def test_one_pearson_formula_at_every_width(spark):
    """A pair's correlation does not depend on how many other pairs there are."""
    rng = np.random.default_rng(12)
    values = rng.normal(0, 1, (2000, 10)) + 1e9
    df = spark.createDataFrame([tuple(map(float, r)) for r in values], ", ".join(f"c{k} double" for k in range(10)))
    alone = correlation.correlate_pairs(df.repartition(3), [("c0", "c1")]).first()[2]
    pairs = [(f"c{a}", f"c{b}") for a in range(10) for b in range(a + 1, 10)]
    wide = {(r[0], r[1]): r[2] for r in correlation.correlate_pairs(df.repartition(3), pairs).collect()}
    assert wide["c0", "c1"] == pytest.approx(alone, abs=1e-7)
    assert alone == pytest.approx(np.corrcoef(values[:, 0] - 1e9, values[:, 1] - 1e9)[0, 1], abs=1e-7)


def test_columns_that_vary_little_beside_a_gap(spark, monkeypatch):
    rows = [(1.0, 1.0), (2.0, 2.0), (3.0, 1.0), (4.0, 3.0), (1e12, None)]
    df = spark.createDataFrame(rows, "x double, y double")
    expected = np.corrcoef([1.0, 2, 3, 4], [1.0, 2, 1, 3])[0, 1]
    assert correlation.correlate_pairs(df, [("x", "y")]).first()[2] == pytest.approx(expected, abs=1e-12)


def test_a_confusion_matrix_of_many_classes(spark):
    df = spark.range(2101).selectExpr("id AS y", "(id + 1) % 2101 AS prediction")
    sparse = modeling.confusion_matrix(df, label="y", zeros=False)
    assert sparse.count() == 2101
    dense = modeling.confusion_matrix(df, label="y").selectExpr("count(*)", "sum(count)").first()
    assert tuple(dense) == (2101 * 2101, 2101)


def test_rows_that_tie_in_an_order_spread(spark):
    df = spark.range(20_000).selectExpr("id", "1 AS t", "1 AS w")
    total = ordering.running_total(df, ["t"], "w", "upto")
    assert total.selectExpr("count(DISTINCT upto)", "max(upto)").first()[:] == (20_000, 20_000)
    placed = ordering.numbered(df, ["t"], "at")
    assert placed.selectExpr("count(DISTINCT at)", "max(at)").first()[:] == (20_000, 19_999)


def test_written_tables_can_be_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "scratch_folder", lambda _: f"{tmp_path}/base/quarrystone/app/one")
    assert scratch.written(spark.range(3)).count() == 3
    scratch.clear(spark)
    assert not (tmp_path / "base" / "quarrystone" / "app").exists()


def _files_stream(spark, folder):
    return spark.readStream.schema("id bigint, v bigint").option("maxFilesPerTrigger", 1).json(str(folder))


def _write_ids(folder, name, ids):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(f'{{"id": {i}, "v": 1}}\n' for i in ids))


def test_consume_carries_on_where_it_stopped(spark, tmp_path):
    source, seen = tmp_path / "in", []
    for k in range(3):
        _write_ids(source, f"{k}.json", range(10 * k, 10 * k + 10))

    def keep(batch):
        seen.append(sorted(r.id for r in batch.collect()))

    def run(**options):
        return batches.consume(
            _files_stream(spark, source), keep, order_by=["id"], batch_size=4, checkpoint=str(tmp_path / "at"), **options
        )

    assert run(max_batches=1) == 4 and len(seen) == 1
    run()
    assert sorted({i for batch in seen for i in batch}) == list(range(30))
    assert all(len(batch) == 4 for batch in seen[:-1])
    before = len(seen)
    assert run() == 0
    _write_ids(source, "3.json", range(30, 35))
    assert run() == 5 and [len(b) for b in seen[before:]] == [4, 1]


def test_final_state_adds_to_what_it_had(spark, tmp_path):
    source = tmp_path / "in"
    _write_ids(source, "0.json", range(4))

    def total():
        sums = batches.running_totals(_files_stream(spark, source), group_by="v", value="id")
        return batches.final_state(sums, checkpoint=str(tmp_path / "at")).first()["total"]

    assert total() == 6
    assert total() == 6
    _write_ids(source, "1.json", [10])
    assert total() == 16
