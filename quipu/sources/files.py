"""Text formats by file extension."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from ..functions.text import null_as_text, text_as_null

# fixed values: field separators by extension; psv uses one emoji
SEPARATORS = {"csv": ",", "tsv": "\t", "ssv": ";", "psv": "\U0001f4a9"}


#: marks a folder whose cells hold no line breaks: they are written as ESCAPED
ESCAPED_MARK = "_LINES_ESCAPED"
ESCAPED = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"))


def escape_breaks(text: Column) -> Column:
    for plain, written in ESCAPED:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape_breaks(text: Column) -> Column:
    """Reverse of `escape_breaks`: a backslash takes the letter behind it along."""
    parts = F.regexp_extract_all(text, F.lit(r"(?s)\\.|[^\\]+|\\$"), F.lit(0))
    plain = F.transform(parts, lambda p: F.when(p == "\\\\", "\\").when(p == "\\n", "\n").when(p == "\\r", "\r").otherwise(p))
    return F.when(F.contains(text, F.lit("\\")), F.array_join(plain, "")).otherwise(text)


def _mark(spark: SparkSession, path: str):
    file = spark._jvm.org.apache.hadoop.fs.Path(path, ESCAPED_MARK)
    return file, file.getFileSystem(spark._jsc.hadoopConfiguration())


def read_delimited(spark: SparkSession, path: str, ext: str, schema: str, multi_line: bool | None = None) -> DataFrame:
    """Header row first; `NULL` is a missing cell and `_NULL` the text `NULL`.

    Quoted cells may hold separators, quotes and line breaks. Files of `write_delimited` have
    their line breaks escaped and are split over tasks. In other files a cell may go over
    several lines, so each is read by one task, unless the caller says `multi_line=False`.
    """
    fields = StructType.fromDDL(schema).fields
    file, files = _mark(spark, path)
    escaped = files.exists(file)
    whole = (not escaped) if multi_line is None else multi_line
    reader = spark.read.option("header", True).option("sep", SEPARATORS[ext]).option("multiLine", whole)
    reader = reader.option("nullValue", "\0").option("emptyValue", "").option("escape", '"')
    for side in ("Leading", "Trailing"):
        reader = reader.option(f"ignore{side}WhiteSpace", False)
    texts = reader.schema(StructType([StructField(f.name, StringType()) for f in fields])).csv(path)
    plain = unescape_breaks if escaped else lambda cell: cell
    return texts.select(*[text_as_null(plain(F.col(f"`{f.name}`"))).try_cast(f.dataType).alias(f.name) for f in fields])


def write_delimited(df: DataFrame, path: str, ext: str) -> None:
    """Cells as text, line breaks and backslashes escaped, so that every line is a whole row."""
    names = {c: reduce(lambda name, pair: name.replace(*pair), ESCAPED, c) for c in df.columns}
    texts = df.select(*[escape_breaks(null_as_text(F.col(f"`{c}`"))).alias(name) for c, name in names.items()])
    if ext == "psv":
        _write_wide_separator(texts, path, SEPARATORS[ext])
    else:
        _write_csv(texts, path, SEPARATORS[ext])
    file, files = _mark(df.sparkSession, path)
    files.create(file, True).close()


def _write_csv(texts: DataFrame, path: str, sep: str) -> None:
    writer = texts.write.mode("overwrite").option("header", True).option("sep", sep)
    for side in ("Leading", "Trailing"):
        writer = writer.option(f"ignore{side}WhiteSpace", False)
    writer.option("emptyValue", '""').option("escape", '"').csv(path)


def _write_wide_separator(texts: DataFrame, path: str, sep: str) -> None:
    """The CSV writer takes one UTF-16 unit as separator, so wide ones go through text."""

    def quoted(cell: Column) -> Column:
        special = F.lit(False)
        for mark in (sep, '"', "\n", "\r"):
            special = special | F.contains(cell, F.lit(mark))
        whole = F.concat(F.lit('"'), F.replace(cell, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(special | (cell == "") | (F.trim(cell) != cell), whole).otherwise(cell)

    row = F.concat_ws(sep, *[quoted(F.col(f"`{c}`")) for c in texts.columns])
    header = F.concat_ws(sep, *[quoted(F.lit(c)) for c in texts.columns])
    # the first row of each partition, and so of each file, brings the header
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    lines = texts.select(row.alias("row"), first.alias("first"))
    value = F.when(F.col("first"), F.concat(header, F.lit("\n"), F.col("row"))).otherwise(F.col("row"))
    lines.select(value.alias("value")).write.mode("overwrite").text(path)


def read_ndjson(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """One object per line; without a schema the columns are the union of the keys."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def write_ndjson(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_json_table(
    spark: SparkSession, path: str, name: str, columns: list[str], multi_line: bool = True
) -> DataFrame:
    """`{name: {columns, rows}}` with rows as arrays; cells come back as text."""
    table = StructType(
        [
            StructField("columns", ArrayType(StringType())),
            StructField("rows", ArrayType(ArrayType(StringType()))),
        ]
    )
    reader = spark.read.schema(StructType([StructField(name, table)]))
    doc = reader.option("multiLine", multi_line).json(path)
    rows = doc.select(F.explode(F.col(name)["rows"]).alias("row"), F.col(name)["columns"].alias("names"))
    at = {c: F.array_position("names", c).cast("int") for c in columns}
    return rows.select(*[F.get("row", at[c] - 1).alias(c) for c in columns])


def read_json_objects(
    spark: SparkSession, path: str, name: str, columns: list[str], multi_line: bool = True
) -> DataFrame:
    """`{name: {columns, rows}}` with rows as objects."""
    table = StructType(
        [
            StructField("columns", ArrayType(StringType())),
            StructField("rows", ArrayType(MapType(StringType(), StringType()))),
        ]
    )
    doc = spark.read.schema(StructType([StructField(name, table)])).option("multiLine", multi_line).json(path)
    rows = doc.select(F.explode(F.col(name)["rows"]).alias("row"))
    return rows.select(*[F.col("row")[c].alias(c) for c in columns])


def read_json_tables(
    spark: SparkSession, path: str, tables: dict[str, list[str]], multi_line: bool = True
) -> dict[str, DataFrame]:
    """`{names: [...], tables: {name: {columns, rows}}}`: each named table."""
    row = ArrayType(MapType(StringType(), StringType()))
    body = StructType([StructField("columns", ArrayType(StringType())), StructField("rows", row)])
    inner = StructType([StructField(n, body) for n in tables])
    doc = spark.read.schema(StructType([StructField("tables", inner)])).option("multiLine", multi_line).json(path)
    return {
        n: doc.select(F.explode(F.col("tables")[n]["rows"]).alias("row")).select(
            *[F.col("row")[c].alias(c) for c in columns]
        )
        for n, columns in tables.items()
    }


def write_json_table(df: DataFrame, path: str, name: str, rows_per_document: int = 1024, objects: bool = False) -> None:
    """One `{name: {columns, rows}}` document per line, each of at most `rows_per_document` rows.

    A large table becomes many bounded documents, a partition's rows together;
    `read_json_table(multi_line=False)` reads the folder back.
    """
    docs = _documents(df, rows_per_document, objects).withColumnRenamed("document", name)
    docs.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_json_tables(tables: dict[str, DataFrame], path: str, rows_per_document: int = 1024) -> None:
    """`{names, tables: {name: {columns, rows}}}` documents, each with rows of one table."""
    names = F.array(*[F.lit(n) for n in tables]).alias("names")
    parts = [
        _documents(df, rows_per_document, objects=True).select(
            F.to_json(F.struct(names, F.struct(F.col("document").alias(n)).alias("tables")), {"ignoreNullFields": "false"}).alias("value")
        )
        for n, df in tables.items()
    ]
    reduce(DataFrame.unionByName, parts).write.mode("overwrite").text(path)


def _documents(df: DataFrame, rows_per_document: int, objects: bool) -> DataFrame:
    """`document`: columns and rows of some neighbouring rows of a partition."""
    texts = [F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]
    cells = F.struct(*texts) if objects else F.array(*texts)
    at = F.monotonically_increasing_id()
    inside = F.floor(at.bitwiseAND((1 << 33) - 1) / rows_per_document)
    chunk = F.struct(F.shiftright(at, 33).alias("part"), inside.alias("inside"))
    columns = F.array(*[F.lit(c) for c in df.columns]).alias("columns")
    return (
        df.select(chunk.alias("_chunk"), cells.alias("row"))
        .groupBy("_chunk")
        .agg(F.collect_list("row").alias("rows"))
        .select(F.struct(columns, "rows").alias("document"))
    )


def convert(spark: SparkSession, src: str, src_ext: str, dst: str, dst_ext: str, schema: str) -> None:
    """Copy a table between formats."""
    if src_ext == "ndjson":
        df = read_ndjson(spark, src, schema)
    elif src_ext == "parquet":
        df = spark.read.schema(schema).parquet(src)
    else:
        df = read_delimited(spark, src, src_ext, schema)
    if dst_ext == "ndjson":
        write_ndjson(df, dst)
    elif dst_ext == "parquet":
        df.write.mode("overwrite").parquet(dst)
    else:
        write_delimited(df, dst, dst_ext)


def _filled(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c).cast("string") != "")


def drop_blank(df: DataFrame) -> DataFrame:
    """Drop rows whose cells are all empty and columns that are empty in every row."""
    row = df.agg(*[F.max(_filled(c)).alias(c) for c in df.columns]).first()
    kept = [c for c in df.columns if row[c]]
    if not kept:
        return df.limit(0)
    return df.select(*kept).filter(reduce(Column.__or__, [_filled(c) for c in kept]))
