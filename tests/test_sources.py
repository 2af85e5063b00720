import datetime
import json
import zipfile

import pytest

from quarrystone.sources import database, excel, files


@pytest.fixture
def sample_csv(tmp_path):
    path = tmp_path / "sample.csv"
    path.write_text("a,b,d\n1,x,2023-01-01\n2,y,2023-02-01\n3,z,2023-03-01\n")
    return str(path)


def test_csv_types_dates_columns_and_rows(spark, sample_csv):
    df = files.load_csv(spark, sample_csv, parse_dates=["d"])
    assert df.dtypes == [("a", "bigint"), ("b", "string"), ("d", "timestamp_ntz")]
    assert df.orderBy("a").first()["d"] == datetime.datetime(2023, 1, 1)
    assert files.load_csv(spark, sample_csv, usecols=["a", "b"], nrows=2).count() == 2
    assert files.load_csv(spark, sample_csv, schema="a double, b string, d string").dtypes[0] == ("a", "double")


def test_csv_missing_texts_and_mixed_columns(spark, tmp_path):
    path = tmp_path / "gaps.csv"
    path.write_text("n,t,f,q,e\n1,NA,True,1.5,\nnull,x,False,nan,\n3,,N/A,2e3,\n")
    df = files.load_csv(spark, str(path))
    assert [t for _, t in df.dtypes] == ["bigint", "string", "boolean", "double", "double"]
    assert [tuple(r) for r in df.orderBy("q").collect()] == [
        (None, "x", False, None, None), (1, None, True, 1.5, None), (3, None, None, 2000.0, None)
    ]


def test_csv_without_header_and_with_junk_above_it(spark, tmp_path):
    (tmp_path / "plain.csv").write_text("1,a\n2,b\n")
    assert files.load_csv(spark, str(tmp_path / "plain.csv"), header=None).columns == ["0", "1"]
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(3):
        lines = "".join(f'{i}{k},"x, {k}"\n' for k in range(20))
        (folder / f"part{i}.csv").write_text(f"report\nmade by hand,,,\nid,name\n{lines}")
    df = files.load_csv(spark, str(folder), header=2)
    assert df.columns == ["id", "name"] and df.count() == 60
    assert {r["name"] for r in df.collect()} == {f"x, {k}" for k in range(20)}
    with pytest.raises(ValueError, match="header"):
        files.load_csv(spark, str(tmp_path / "plain.csv"), header=9)


def test_quoted_newlines(spark, tmp_path):
    path = tmp_path / "quoted.csv"
    path.write_text('a,b\n1,"two\nlines"\n2,"say ""hi"""\n')
    rows = files.load_csv(spark, str(path), multi_line=True).orderBy("a").collect()
    assert [r["b"] for r in rows] == ["two\nlines", 'say "hi"']


@pytest.mark.parametrize("sep", ["\t", ";", "|"])
def test_text_finds_its_delimiter(spark, tmp_path, sep):
    path = tmp_path / "data.txt"
    path.write_text("\n".join(sep.join(r) for r in [["a", "b"], ["1", "x"], ["2", "y"], ["3", "z"]]) + "\n")
    df = files.load_text(spark, str(path))
    assert df.columns == ["a", "b"] and df.count() == 3
    named = files.load_text(spark, str(path), header=None, column_names=["p", "q"])
    assert named.columns == ["p", "q"] and named.count() == 4


RECORDS = [{"a": 1, "b": "x"}, {"a": 2, "b": "y"}]


@pytest.mark.parametrize("orient, document", [
    (None, RECORDS),
    ("records", RECORDS),
    ("columns", {"a": {"0": 1, "1": 2}, "b": {"0": "x", "1": "y"}}),
    ("index", {"0": {"a": 1, "b": "x"}, "1": {"a": 2, "b": "y"}}),
    ("split", {"columns": ["a", "b"], "index": [0, 1], "data": [[1, "x"], [2, "y"]]}),
    ("table", {"schema": {"fields": [{"name": "a", "type": "integer"}, {"name": "b", "type": "string"}]}, "data": RECORDS}),
    ("values", [[1, "x"], [2, "y"]]),
])
def test_json_orients(spark, tmp_path, orient, document):
    path = tmp_path / "doc.json"
    path.write_text(json.dumps(document))
    df = files.load_json(spark, str(path), orient=orient)
    names = ["0", "1"] if orient == "values" else ["a", "b"]
    assert sorted((r[names[0]], r[names[1]]) for r in df.collect()) == [(1, "x"), (2, "y")]


def test_json_lines_and_dates(spark, tmp_path):
    path = tmp_path / "rows.jsonl"
    path.write_text('{"a": 1, "at": "2024-01-02"}\n{"a": 2, "at": null}\n')
    df = files.load_auto(spark, str(path), parse_dates=["at"])
    assert dict(df.dtypes)["at"] == "timestamp_ntz" and df.count() == 2
    with pytest.raises(ValueError, match="orient"):
        files.load_json(spark, str(path), orient="diagonal")


def test_parquet_reads_only_the_listed_columns(spark, clean_df, tmp_path):
    path = str(tmp_path / "t.parquet")
    clean_df.write.parquet(path)
    df = files.load_parquet(spark, path, columns=["region", "sales"])
    assert df.columns == ["region", "sales"] and df.count() == 6
    assert "ReadSchema: struct<sales:double>" in df.select("sales")._jdf.queryExecution().toString()
    assert files.load_auto(spark, path).count() == 6


def test_missing_files_and_unknown_suffixes(spark, tmp_path):
    for load in (files.load_csv, files.load_text, files.load_json, files.load_parquet, excel.load_excel, files.load_auto):
        with pytest.raises(FileNotFoundError):
            load(spark, str(tmp_path / "nope.csv"))
    (tmp_path / "data.xyz").write_text("1")
    with pytest.raises(ValueError, match="Unsupported"):
        files.load_auto(spark, str(tmp_path / "data.xyz"))


MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def write_workbook(path, sheets):
    """A workbook with shared, inline, boolean, numeric and date cells."""
    shared: list[str] = []

    def cell(ref, v):
        if v is None:
            return ""
        if isinstance(v, bool):
            return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
        if isinstance(v, datetime.date):
            return f'<c r="{ref}" s="1"><v>{(v - datetime.date(1899, 12, 30)).days}</v></c>'
        if isinstance(v, (int, float)):
            return f'<c r="{ref}"><v>{v}</v></c>'
        if v.startswith("="):
            return f'<c r="{ref}" t="inlineStr"><is><t>{v[1:]}</t></is></c>'
        shared.append(v)
        return f'<c r="{ref}" t="s"><v>{len(shared) - 1}</v></c>'

    with zipfile.ZipFile(path, "w") as book:
        names = "".join(f'<sheet name="{n}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, n in enumerate(sheets))
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{RELS}"><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{i + 1}" Target="worksheets/sheet{i + 1}.xml"/>' for i in range(len(sheets)))
        book.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{links}</Relationships>")
        book.writestr("xl/styles.xml", f'<styleSheet xmlns="{MAIN}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        for i, rows in enumerate(sheets.values()):
            body = "".join(
                f'<row r="{r + 1}">' + "".join(cell(f"{'ABCDEF'[c]}{r + 1}", v) for c, v in enumerate(row)) + "</row>"
                for r, row in enumerate(rows)
            )
            book.writestr(f"xl/worksheets/sheet{i + 1}.xml", f'<worksheet xmlns="{MAIN}"><sheetData>{body}</sheetData></worksheet>')
        items = "".join(f"<si><t>{t}</t></si>" for t in shared)
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{items}</sst>')


@pytest.fixture
def workbook(tmp_path):
    path = tmp_path / "book.xlsx"
    first = [["id", "name", "flag", "day", "x"],
             [1, "ann", True, datetime.date(2024, 2, 29), 1.5],
             [2, "=bob", False, datetime.date(2023, 1, 1), None],
             [3, None, True, None, 2.5]]
    write_workbook(path, {"People": first, "Other": [["k"], ["v1"], ["v2"]]})
    return str(path)


def test_excel_sheet(spark, workbook):
    df = excel.load_excel(spark, workbook, parse_dates=["day"])
    assert df.dtypes == [("id", "bigint"), ("name", "string"), ("flag", "boolean"), ("day", "timestamp_ntz"), ("x", "double")]
    rows = df.orderBy("id").collect()
    assert tuple(rows[0]) == (1, "ann", True, datetime.datetime(2024, 2, 29), 1.5)
    assert rows[1]["name"] == "bob" and rows[2]["name"] is None
    assert excel.load_excel(spark, workbook, usecols="A:B,E").columns == ["id", "name", "x"]
    assert excel.load_excel(spark, workbook, usecols=["x", "id"]).columns == ["id", "x"]
    assert excel.load_excel(spark, workbook, sheet_name="Other").count() == 2
    assert files.load_auto(spark, workbook, sheet_name=1).columns == ["k"]
    assert excel.load_excel(spark, workbook, sheet_name=1, header=None).columns == ["0"]
    with pytest.raises(ValueError, match="header"):
        excel.load_excel(spark, workbook, sheet_name="Missing")


def test_excel_from_a_table(spark, workbook):
    with open(workbook, "rb") as file:
        books = spark.createDataFrame([("a", file.read()), ("b", None)], "path string, content binary")
    assert excel.load_excel(spark, books).collect() == excel.load_excel(spark, workbook).collect()
    assert set(excel.load_excel_all_sheets(spark, books)) == {"People", "Other"}
    with pytest.raises(ValueError, match="content"):
        excel.load_excel(spark, books.drop("content"))


def test_excel_all_sheets_and_many_workbooks(spark, workbook, tmp_path):
    sheets = excel.load_excel_all_sheets(spark, workbook)
    assert list(sheets) == ["People", "Other"] and sheets["Other"].count() == 2
    write_workbook(tmp_path / "second.xlsx", {"People": [["id"], [4], [5]]})
    rows = excel.read_workbooks(spark, str(tmp_path / "*.xlsx"))
    assert rows.groupBy("path").count().count() == 2
    (tmp_path / "old.xls").write_bytes(b"")
    with pytest.raises(ValueError, match="xls"):
        excel.load_excel(spark, str(tmp_path / "old.xls"))


def test_bound_queries():
    text = "SELECT ':no', x::int FROM t WHERE a = :a AND b < :b AND c = :c"
    bound = database.bind(text, {"a": "O'Brien", "b": datetime.date(2024, 1, 2), "c": None})
    assert bound == "SELECT ':no', x::int FROM t WHERE a = 'O''Brien' AND b < DATE '2024-01-02' AND c = NULL"
    for params in ({}, {"a": 1, "b": 2, "c": 3, "d": 4}, {"a": [1], "b": 2, "c": 3}, {"a": "\\'", "b": 1, "c": 1}):
        with pytest.raises(ValueError):
            database.bind(text, params)


def test_connection_strings():
    options = database.jdbc_options("postgresql+psycopg2://me:p%40ss@db.example:5433/sales")
    assert options == {
        "url": "jdbc:postgresql://db.example:5433/sales", "driver": "org.postgresql.Driver", "user": "me", "password": "p@ss"
    }
    assert database.jdbc_options("jdbc:derby:memory:x") == {"url": "jdbc:derby:memory:x"}
    assert database.jdbc_options("sqlite:////data/a.db")["url"] == "jdbc:sqlite:/data/a.db"
    with pytest.raises(ValueError, match="Unknown database"):
        database.jdbc_options("abacus://x/y")


def test_partitioned_reads_need_bounds(spark):
    with pytest.raises(ValueError, match="bounds"):
        database.load_database(spark, "SELECT 1", "jdbc:derby:memory:x", partition_column="id")
