"""Round trips through scratch files."""

from pyspark.sql import functions as F

from quarrystone.plans.scratch import scratch_folder
from quarrystone.sources import excel, files
from quarrystone.streaming import batches, readers

from .registry import query, table

CUSTOMER = "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer"


def _customers(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


@query("load_csv", CUSTOMER)
def load_csv(spark, sf):
    path = scratch_folder(spark)
    _customers(spark, sf).write.option("header", True).csv(path)
    return files.load_csv(spark, path)


@query(
    "load_csv_columns",
    "SELECT o_orderkey, o_orderdate FROM orders",
)
def load_csv_columns(spark, sf):
    path = scratch_folder(spark)
    table(spark, sf, "orders").write.option("header", True).csv(path)
    return files.load_csv(spark, path, usecols=["o_orderkey", "o_orderdate"], parse_dates=["o_orderdate"])


@query("load_text", CUSTOMER)
def load_text(spark, sf):
    path = scratch_folder(spark)
    _customers(spark, sf).write.option("sep", "|").csv(path)
    return files.load_text(spark, path, column_names=["c_custkey", "c_name", "c_acctbal", "c_mktsegment"])


@query("load_json_lines", CUSTOMER)
def load_json_lines(spark, sf):
    path = scratch_folder(spark)
    _customers(spark, sf).write.json(path)
    return files.load_json(spark, path, lines=True)


@query("load_parquet", "SELECT l_orderkey, l_extendedprice FROM lineitem")
def load_parquet(spark, sf):
    return files.load_parquet(spark, f"{sf}/lineitem.parquet", columns=["l_orderkey", "l_extendedprice"])


@query("load_auto", "SELECT * FROM supplier")
def load_auto(spark, sf):
    return files.load_auto(spark, f"{sf}/supplier.parquet")


@query("load_csv_first_rows", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer ORDER BY c_custkey LIMIT 500")
def load_csv_first_rows(spark, sf):
    """The limit reaches the scan; the files hold the rows in order."""
    path = scratch_folder(spark)
    _customers(spark, sf).repartitionByRange(4, "c_custkey").sortWithinPartitions("c_custkey").write.option(
        "header", True
    ).csv(path)
    return files.load_csv(spark, path, nrows=500)


# Rows in one JSON document of the orients that are not lines.
DOCUMENT_ROWS = 2000
CELLS = ("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


def _documents(spark, sf, build):
    """A folder with one JSON document per file, built from the rows of each by ``build``."""
    path = scratch_folder(spark)
    doc = F.floor(F.col("c_custkey") / DOCUMENT_ROWS)
    rows = F.array_sort(F.collect_list(F.struct("c_custkey", "c_name", "c_acctbal", "c_mktsegment"))).alias("r")
    made = _customers(spark, sf).groupBy(doc.alias("doc")).agg(rows).select("doc", build(F.col("r")).alias("value"))
    made.repartition("doc").write.partitionBy("doc").text(path)
    return f"{path}/doc=*"


def _strings(row):
    return F.array(*[row[c].cast("string") for c in CELLS])


def _by_name(row):
    return F.map_from_arrays(F.array(*map(F.lit, CELLS)), _strings(row))


@query("load_json_records", CUSTOMER)
def load_json_records(spark, sf):
    return files.load_json(spark, _documents(spark, sf, F.to_json)).select(*CELLS)


@query("load_json_split", CUSTOMER)
def load_json_split(spark, sf):
    def build(rows):
        index = F.transform(rows, lambda r: r["c_custkey"])
        return F.to_json(F.struct(
            F.array(*map(F.lit, CELLS)).alias("columns"), index.alias("index"), F.transform(rows, _strings).alias("data")
        ))

    return _typed(files.load_json(spark, _documents(spark, sf, build), orient="split"))


@query("load_json_index", CUSTOMER)
def load_json_index(spark, sf):
    def build(rows):
        return F.to_json(F.map_from_arrays(F.transform(rows, lambda r: r["c_custkey"].cast("string")), F.transform(rows, _by_name)))

    return _typed(files.load_json(spark, _documents(spark, sf, build), orient="index"))


@query("load_json_columns", CUSTOMER)
def load_json_columns(spark, sf):
    def build(rows):
        keys = F.transform(rows, lambda r: r["c_custkey"].cast("string"))
        columns = [F.map_from_arrays(keys, rows[c].cast("array<string>")) for c in CELLS]
        return F.to_json(F.map_from_arrays(F.array(*map(F.lit, CELLS)), F.array(*columns)))

    return _typed(files.load_json(spark, _documents(spark, sf, build), orient="columns"))


@query("load_json_values", CUSTOMER)
def load_json_values(spark, sf):
    found = files.load_json(spark, _documents(spark, sf, lambda rows: F.to_json(F.transform(rows, _strings))), orient="values")
    return _typed(found.toDF(*CELLS))


@query("load_json_table", CUSTOMER)
def load_json_table(spark, sf):
    def build(rows):
        fields = F.array(*[F.struct(F.lit(c).alias("name"), F.lit("string").alias("type")) for c in CELLS])
        return F.to_json(F.struct(F.struct(fields.alias("fields")).alias("schema"), F.transform(rows, _by_name).alias("data")))

    return _typed(files.load_json(spark, _documents(spark, sf, build), orient="table"))


def _typed(df):
    """The columns of the table; whole numbers are read as bigint."""
    return df.select(F.col("c_custkey").cast("bigint"), "c_name", F.col("c_acctbal").cast("double"), "c_mktsegment")


# Rows in one workbook.
WORKBOOK_ROWS = 5000


def _workbooks(df, sheets):
    """``path, content``: one workbook for each ``book``, a sheet for each of ``sheets`` (name: columns)."""

    def build(key, rows):
        import io
        import zipfile
        from xml.sax.saxutils import escape

        import pandas as pd

        def letters(place):
            return chr(65 + place)

        def cell(at, found):
            if pd.isna(found):
                return ""
            if isinstance(found, str):
                return f'<c r="{at}" t="inlineStr"><is><t>{escape(found)}</t></is></c>'
            return f'<c r="{at}"><v>{found}</v></c>'

        head = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
        links = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
            listed = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
            book.writestr("xl/workbook.xml", f'<workbook {head} xmlns:r="{links}"><sheets>{listed}</sheets></workbook>')
            targets = "".join(f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
            book.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{targets}</Relationships>")
            for i, names in enumerate(sheets.values(), 1):
                lines = [names, *rows[names].itertuples(index=False)]
                body = "".join(
                    f'<row r="{r}">' + "".join(cell(f"{letters(c)}{r}", v) for c, v in enumerate(line)) + "</row>"
                    for r, line in enumerate(lines, 1)
                )
                book.writestr(f"xl/worksheets/sheet{i}.xml", f"<worksheet {head}><sheetData>{body}</sheetData></worksheet>")
        return pd.DataFrame({"path": [f"book{key[0]}.xlsx"], "content": [out.getvalue()]})

    return df.groupBy("book").applyInPandas(build, "path string, content binary")


def _customer_books(spark, sf):
    book = F.floor(F.col("c_custkey") / WORKBOOK_ROWS).alias("book")
    rows = table(spark, sf, "customer").select("*", book)
    return _workbooks(rows, {"Customers": list(CELLS), "Nations": ["c_custkey", "c_nationkey"]})


@query("load_excel", CUSTOMER)
def load_excel(spark, sf):
    return excel.load_excel(spark, _customer_books(spark, sf), sheet_name="Customers")


@query("load_excel_columns", "SELECT c_custkey, c_acctbal FROM customer")
def load_excel_columns(spark, sf):
    """Columns by letter; the sheet by its place."""
    return excel.load_excel(spark, _customer_books(spark, sf), usecols="A,C")


@query(
    "load_excel_all_sheets",
    "SELECT c_custkey, c_acctbal, c_mktsegment, c_nationkey FROM customer",
)
def load_excel_all_sheets(spark, sf):
    """Both sheets of all workbooks, put together again; whole numbers are read as bigint."""
    sheets = excel.load_excel_all_sheets(spark, _customer_books(spark, sf))
    both = sheets["Customers"].join(sheets["Nations"], "c_custkey")
    return both.select("c_custkey", "c_acctbal", "c_mktsegment", F.col("c_nationkey").cast("int"))


@query("landing_zone", "SELECT event_id, user_id, event_type, value FROM events")
def landing_zone(spark, sf):
    """Messages that arrive as JSON files, read as a stream of a few files at a time."""
    path, schema = scratch_folder(spark), "event_id bigint, user_id bigint, event_type string, value double"
    table(spark, sf, "events").select("event_id", "user_id", "event_type", "value").repartition(6).write.json(path)
    reader = readers.LandingZoneReader(path, schema, max_files_per_trigger=2)
    return batches.stream_to_dataframe(reader.load(spark), limit=10**9)
