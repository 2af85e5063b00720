"""File sources: delimited text, JSON, Parquet, and the dispatch by suffix."""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import ref, require
from ..plans.scratch import scratch_folder, written
from .objects import read_objects
from .records import read_records

# The texts a CSV reader of the Python stack takes for missing.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
JSON_ORIENTS = ("records", "columns", "index", "split", "values", "table")
# Lines looked at to find the delimiter of a text file.
SNIFF_LINES = 50
# Where a row stands in its file: the split it is read from and a number that rises within the split.
PLACE = ("__split", "__line")


def validate_exists(spark: SparkSession, path: str) -> str:
    """The path, if a file, folder or glob matches; ``FileNotFoundError`` before any lazy read."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(str(path))
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    found = system.globStatus(where)
    if not found:
        raise FileNotFoundError(f"Nothing lies under {path}")
    return str(path)


# ---------------------------------------------------------------- delimited text


def _typed(df: DataFrame, spark: SparkSession, schema: T.StructType | str | None, parse_dates) -> DataFrame:
    """Missing texts to NULL, then each column to its narrowest type (or to ``schema``)."""
    blank = df.select(
        *[F.when(~ref(c).isin(*MISSING_TEXTS), ref(c)).alias(c) for c in df.columns]
    )
    dates = set(require(blank, parse_dates))
    if schema is not None:
        wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        kinds = {f.name: f.dataType.simpleString() for f in wanted.fields}
    else:
        kinds = _inferred(blank, [c for c in blank.columns if c not in dates])

    def typed(name: str) -> Column:
        if name in dates:
            return ref(name).try_cast("timestamp_ntz").alias(name)
        return ref(name).try_cast(kinds.get(name, "string")).alias(name)

    return blank.select(*[typed(c) for c in blank.columns])


def _inferred(df: DataFrame, names: Sequence[str]) -> dict[str, str]:
    """bigint, double or boolean where every present value reads as one; string otherwise.

    One pass of counters for all columns.  A schema given by the caller saves it.
    """
    if not names:
        return {}
    whole, real = r"^\s*[+-]?\d{1,19}\s*$", r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$|^\s*[+-]?(inf|Infinity)\s*$"
    tests = {
        "bigint": lambda c: c.rlike(whole) & c.try_cast("bigint").isNotNull(),
        "double": lambda c: c.rlike(real),
        "boolean": lambda c: c.isin("True", "False", "TRUE", "FALSE", "true", "false"),
    }
    counters = [
        F.count_if(ref(c).isNotNull() & ~test(ref(c))).alias(f"{i}_{kind}")
        for i, c in enumerate(names)
        for kind, test in tests.items()
    ] + [F.count(ref(c)).alias(f"{i}_n") for i, c in enumerate(names)]
    seen = df.agg(*counters).first()
    kinds = {}
    for i, c in enumerate(names):
        fits = [kind for kind in tests if seen[f"{i}_{kind}"] == 0]
        kinds[c] = fits[0] if fits and seen[f"{i}_n"] else ("double" if not seen[f"{i}_n"] else "string")
    return kinds


def _head(spark: SparkSession, path: str, encoding: str, lines: int) -> list[str]:
    """The first lines of the first file, for the driver to look at the layout."""
    reader = spark.read.option("encoding", encoding)
    return [r.value for r in reader.text(path).limit(lines).collect()]


def load_csv(
    spark: SparkSession,
    path: str,
    *,
    sep: str = ",",
    encoding: str = "utf-8",
    header: int | None = 0,
    usecols: Sequence[str] | None = None,
    parse_dates: Sequence[str] | None = None,
    nrows: int | None = None,
    schema: T.StructType | str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Delimited text with a header row.

    ``header`` is the number of the header line (lines above it are skipped) or ``None``
    for files without one, whose columns are named 0, 1, 2...  The usual missing texts
    become NULL.  Types are inferred in one pass unless ``schema`` is given.  Quoted
    newlines need ``multi_line``; large files are read in many tasks then too, twice, as :mod:`.records`
    says.  A row with fewer fields than the header ends in missing values, one with more raises when it is read.
    ``nrows`` takes the first rows of the files in the order of their names.
    """
    validate_exists(spark, path)

    def chosen(where: str, placed: bool = False) -> DataFrame:
        raw = _read_delimited(spark, where, sep, encoding, header, multi_line, placed=placed)
        if usecols is None:
            return raw
        wanted = {*require(raw, usecols), *(PLACE if placed else ())}
        return raw.select(*[ref(c) for c in raw.columns if c in wanted])

    raw = chosen(path) if nrows is None else _first_rows(spark, path, chosen, nrows, not multi_line)
    return _typed(raw, spark, schema, parse_dates)


def _first_rows(
    spark: SparkSession, path: str, read: Callable[[str, bool], DataFrame], rows: int, in_order: bool
) -> DataFrame:
    """The first rows, file by file and written once, so that types are those of the rows returned.

    A limit takes rows of any task, so the splits of a file are counted and taken in their order.  If tasks read rows
    ``in_order``, each stops after as many as are missing.
    """
    if rows < 0:
        raise ValueError("nrows must not be negative")
    parts, missing = [], rows
    for file in sorted(spark.read.format("binaryFile").load(path).inputFiles()):
        placed = read(file, True)
        some = written(placed.mapInArrow(_heads(missing), placed.schema) if in_order else placed)
        part, count = _first_of_file(some, missing)
        parts.append(part.drop(*PLACE))
        missing -= count
        if not missing:
            break
    return reduce(DataFrame.unionByName, parts)


def _heads(rows: int):
    """At most the first rows of every task, which then stops to read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = rows
        for batch in batches:
            yield batch.slice(0, left)
            left -= min(left, batch.num_rows)
            if not left:
                return

    return run


def _first_of_file(placed: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """The first rows of one file by their places, and how many there are; the driver gets one count for each split."""
    split, line = PLACE
    upto = 0
    for own in placed.groupBy(split).agg(F.count("*").alias("n")).orderBy(split).collect():
        if upto + own.n > rows:
            edge = placed.where(F.col(split) == own[split]).select(line).orderBy(line).limit(rows - upto)
            last = edge.agg(F.max(line)).first()[0]
            before = F.col(split) < own[split]
            return placed.where(before if last is None else before | ((F.col(split) == own[split]) & (F.col(line) <= last))), rows
        upto += own.n
    return placed, upto


def _checked(rows: DataFrame, sep: str, width: int, needs_sep: bool) -> DataFrame:
    """Raise on rows with more fields than names, or (``needs_sep``) with no separator at all.

    ``rows`` has the raw text in ``__bad``, at least of each row of another width.
    """
    bare = F.regexp_replace("__bad", '"(?:[^"]|"")*"', "")
    fields = F.size(F.split(bare, re.escape(sep), -1))
    fits = fields <= width
    if needs_sep and width > 1:
        fits = fits & (fields > 1)
    message = F.concat(F.lit(f"A row does not have the {width} fields of the header: "), F.substring("__bad", 1, 200))
    # Spark reads the raw text only next to a parsed column, so good rows look at one; they all pass.
    some = ref(rows.columns[0])
    good = some.isNull() | (F.length(some) >= 0)
    passes = F.when(F.col("__bad").isNull(), good).when(fits, True).otherwise(F.raise_error(message).cast("boolean"))
    return rows.where(passes).drop("__bad")


def _first_record(spark: SparkSession, path: str, encoding: str, skip: int, sep: str) -> list[str]:
    """The fields of the first record after ``skip`` lines of the first file."""
    reader = spark.read.option("encoding", encoding).option("lineSep", "\n")
    lines = SNIFF_LINES
    while True:
        head = [r.value for r in reader.text(path).limit(skip + lines).collect()]
        record, quotes = [], 0
        for line in head[skip:]:
            record.append(line.removesuffix("\r"))
            quotes += line.count('"')
            if quotes % 2 == 0:
                return next(csv.reader(["\n".join(record)], delimiter=sep), [])
        if len(head) < skip + lines:
            raise ValueError(f"No whole record after line {skip} of {path}")
        lines *= 2


def _read_records(spark, path, sep, encoding, header, placed) -> DataFrame:
    """Rows of records that may hold line ends."""
    first = _first_record(spark, path, encoding, header or 0, sep)
    names = [str(i) for i in range(len(first))] if header is None else first
    records = read_records(spark, path, encoding=encoding, skip=header or 0).where(F.length("value") > 0)
    plain = [f"c{i}" for i in range(len(names))]
    parsed = F.from_csv("value", ", ".join(f"{c} string" for c in plain), {"sep": sep, "quote": '"', "escape": '"'})
    rows = records.select("split", "line", parsed.alias("r"), F.col("value").alias("__bad"))
    if header is not None:  # every file's own header must be the first one's
        is_head = (F.col("split") == 0) & (F.col("line") == header)
        same = F.array(*[F.col(f"r.{c}") for c in plain]) == F.array(*map(F.lit, names))
        other = F.raise_error(F.concat(F.lit("A file has another header: "), F.substring("__bad", 1, 200))).cast("boolean")
        rows = rows.where(F.when(~is_head, True).when(same, False).otherwise(other))
    place = [F.col(c).alias(p) for c, p in zip(("split", "line"), PLACE)] if placed else []
    checked = _checked(rows.select("r.*", *place, "__bad"), sep, len(names), False)
    return checked.toDF(*names, *(PLACE if placed else ()))


def _read_delimited(spark, path, sep, encoding, header, multi_line, needs_sep=False, placed=False) -> DataFrame:
    """All fields as text; with ``placed`` also the place of each row in its file."""
    if multi_line and (header is None or header >= 0):
        return _read_records(spark, path, sep, encoding, header, placed)
    reader = (
        spark.read.option("sep", sep)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "__bad")
        # With pruning a row is only as wide as the columns read, and none is too long.
        .option("columnPruning", False)
    )

    def with_bad(names: Sequence[str]) -> T.StructType:
        return T.StructType([T.StructField(n, T.StringType()) for n in [*names, "__bad"]])

    def checked(names: Sequence[str]) -> DataFrame:
        rows = reader.schema(with_bad(names)).csv(path)
        if placed:
            start = rows.metadataColumn("_metadata")["file_block_start"]
            rows = rows.select("*", start.alias(PLACE[0]), F.monotonically_increasing_id().alias(PLACE[1]))
        return _checked(rows, sep, len(names), needs_sep)

    if header is None:
        names = reader.csv(path).columns
        return checked(names).toDF(*[str(i) for i in range(len(names))], *(PLACE if placed else ()))
    if header == 0:
        # Every file's own header is compared with the first one's; another order or name raises.
        reader = reader.option("header", True).option("enforceSchema", False)
        return checked(reader.csv(path).columns)
    if header < 0:
        raise ValueError("header must be a line number or None")
    # Lines above the header are junk of any width, so the names come from a look at the
    # head and every file then loses its first lines.  Line numbers within a file exist
    # only while its first split is read in order, hence the pass through Python.
    head = _head(spark, path, encoding, header + 1)
    if len(head) <= header:
        raise ValueError(f"No header at line {header}")
    names = next(csv.reader([head[header]], delimiter=sep))
    lines = spark.read.option("encoding", encoding).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )

    def without_head(batches):
        passed: dict[str, int] = {}
        for batch in batches:
            number = batch.groupby("file").cumcount() + batch["file"].map(passed).fillna(0)
            for file, count in batch["file"].value_counts().items():
                passed[file] = passed.get(file, 0) + count
            batch["number"] = number
            yield batch.loc[(batch["start"] > 0) | (number > header), ["value", "start", "number"]]

    fields = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    parsed = F.from_csv("value", fields, {"sep": sep, "quote": '"', "escape": '"'})
    body = lines.mapInPandas(without_head, "value string, start bigint, number bigint").where(F.length("value") > 0)
    place = [F.col(c).alias(p) for c, p in zip(("start", "number"), PLACE)] if placed else []
    rows = body.select(parsed.alias("r"), *place, F.col("value").alias("__bad"))
    rows = rows.select("r.*", *(PLACE if placed else ()), "__bad")
    return _checked(rows, sep, len(names), needs_sep)


def load_text(
    spark: SparkSession,
    path: str,
    *,
    sep: str | None = None,
    encoding: str = "utf-8",
    header: int | str | None = "infer",
    column_names: Sequence[str] | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Delimited text whose separator is found from its first lines unless given.

    A separator found so must be in every row: one without it raises when it is read.
    ``column_names`` names the columns of a file without a header (``header="infer"``
    then means no header line).
    """
    validate_exists(spark, path)
    guessed = sep is None
    if guessed:
        sample = "\n".join(_head(spark, path, encoding, SNIFF_LINES))
        try:
            sep = csv.Sniffer().sniff(sample, delimiters=",;\t|: ").delimiter
        except csv.Error as failure:
            raise ValueError(f"Could not find the delimiter of {path}; pass sep") from failure
    if header == "infer":
        header = None if column_names is not None else 0
    raw = _read_delimited(spark, path, sep, encoding, header, False, needs_sep=guessed)
    if column_names is not None:
        if len(column_names) != len(raw.columns):
            raise ValueError(f"{len(column_names)} names for {len(raw.columns)} columns")
        raw = raw.toDF(*column_names)
    return _typed(raw, spark, schema, None)


# ---------------------------------------------------------------- JSON and Parquet


def load_json(
    spark: SparkSession,
    path: str,
    *,
    orient: str | None = None,
    lines: bool = False,
    encoding: str = "utf-8",
    parse_dates: Sequence[str] | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """JSON Lines (``lines=True``, splittable) or whole documents of a given ``orient``.

    ``records`` (the default) is a list of objects, however long: it is cut into lines in many tasks, written to
    the scratch folder and read from there.  ``columns``, ``index``, ``split``,
    ``values`` and ``table`` are read one document per file and unfolded into rows;
    ``columns`` and ``index`` keep their labels in a column ``index``.
    """
    validate_exists(spark, path)
    if orient is not None and orient not in JSON_ORIENTS:
        raise ValueError(f"Unknown orient {orient!r}; choose one of {JSON_ORIENTS}")
    if lines or orient in (None, "records"):
        reader = spark.read.option("encoding", encoding) if lines else spark.read
        reader = reader.schema(schema) if schema is not None else reader
        table = reader.json(path if lines else _as_lines(spark, path, encoding))
    else:
        documents = spark.read.option("wholetext", True).option("encoding", encoding).text(path)
        table = _unfolded(documents, orient)
        if schema is not None:
            wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
            table = table.select(*[ref(f.name).try_cast(f.dataType).alias(f.name) for f in wanted.fields])
    dates = set(require(table, parse_dates))
    return table.select(
        *[ref(c).try_cast("timestamp_ntz").alias(c) if c in dates else ref(c) for c in table.columns]
    )


def _as_lines(spark: SparkSession, path: str, encoding: str) -> str:
    """A folder with the objects of all documents, one a line."""
    lines = scratch_folder(spark)
    # A line end within an object is white space between its parts.
    read_objects(spark, path, encoding=encoding).select(F.regexp_replace("value", r"[\r\n]+", " ")).write.text(lines)
    return lines


def _unfolded(documents: DataFrame, orient: str) -> DataFrame:
    """Rows of JSON documents that are not lists of records; values typed by inference."""
    text = F.col("value")
    doc = documents.withColumn("__doc", F.input_file_name())
    if orient in ("columns", "index"):
        nested = doc.select(
            "__doc", F.posexplode(F.from_json(text, "map<string,map<string,string>>")).alias("p", "outer", "cells")
        ).select("__doc", "p", "outer", F.posexplode("cells").alias("q", "inner", "cell"))
        if orient == "columns":
            nested = nested.select("__doc", F.col("inner").alias("index"), F.col("outer").alias("name"), "cell",
                                   F.col("q").alias("row"), F.col("p").alias("place"))
        else:
            nested = nested.select("__doc", F.col("outer").alias("index"), F.col("inner").alias("name"), "cell",
                                   F.col("p").alias("row"), F.col("q").alias("place"))
        names = _names_in_order(nested)
        wide = nested.groupBy("__doc", "index").pivot("name", names).agg(F.first("cell"))
        table = wide.select("index", *[ref(n) for n in names])
    elif orient == "table":
        shape = "struct<schema:struct<fields:array<struct<name:string,type:string>>>>"
        names = _names_in_order(doc.select(F.posexplode(F.from_json(text, shape)["schema"]["fields"]["name"]).alias("place", "name")))
        rows = doc.select(F.explode(F.from_json(text, "struct<data:array<map<string,string>>>")["data"]).alias("r"))
        table = rows.select(*[F.element_at("r", F.lit(n)).alias(n) for n in names])
    elif orient == "split":
        # Every document has its own order of columns.
        shape = "struct<columns:array<string>,index:array<string>,data:array<array<string>>>"
        parts = doc.select(F.from_json(text, shape).alias("d")).select("d.columns", "d.data")
        names = _names_in_order(parts.select(F.posexplode("columns").alias("place", "name")))
        rows = parts.select("columns", F.explode("data").alias("r")).select(F.map_from_arrays("columns", "r").alias("r"))
        table = rows.select(*[F.element_at("r", F.lit(n)).alias(n) for n in names])
    else:
        rows = doc.select(F.explode(F.from_json(text, "array<array<string>>")).alias("r"))
        width = rows.agg(F.max(F.size("r"))).first()[0] or 0
        table = rows.select(*[F.get("r", F.lit(i)).alias(str(i)) for i in range(width)])
    kinds = _inferred(table, table.columns)
    return table.select(*[ref(c).try_cast(kinds[c]).alias(c) for c in table.columns])


def _names_in_order(named: DataFrame) -> list[str]:
    """Column names of all documents, by the first place each has in one of them."""
    order = named.groupBy("name").agg(F.min("place").alias("place")).orderBy("place", "name").collect()
    return [r["name"] for r in order]


def load_parquet(spark: SparkSession, path: str, *, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet, reading only the listed columns."""
    validate_exists(spark, path)
    table = spark.read.parquet(path)
    return table if columns is None else table.select(*[ref(c) for c in require(table, columns)])


def load_auto(spark: SparkSession, path: str, **options) -> DataFrame:
    """Pick the loader by the suffix of the path (a file, a folder or a glob)."""
    from .excel import load_excel

    validate_exists(spark, path)
    name = str(path).rstrip("/").rsplit("/", 1)[-1].lower()
    suffix = name.rsplit(".", 1)[-1] if "." in name else ""
    loaders = {
        "csv": load_csv,
        "txt": load_text,
        "tsv": load_text,
        "xlsx": load_excel,
        "xls": load_excel,
        "json": load_json,
        "jsonl": load_json,
        "parquet": load_parquet,
    }
    if suffix not in loaders:
        raise ValueError(f"Unsupported suffix {suffix!r}: no loader is known for it")
    if suffix == "jsonl":
        options.setdefault("lines", True)
    return loaders[suffix](spark, path, **options)

