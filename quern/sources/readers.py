"""Batch and stream readers (SRC-*) and sinks (SNK-*).

All readers return lazy DataFrames; column pruning and filters written after
them reach the Parquet scan (``PushedFilters`` / ``ReadSchema``). SNK-3: no
operator runs an action; ``show``/``first``/``collect``/``count`` are the
caller's (the registered queries return DataFrames).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.session import scratch_path
from quern.functions.columns import exact_mean

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """SRC-1: one fixed table as a DataFrame (Parquet, schema from the file footer)."""
    return spark.read.parquet(table_path(sf_dir, name))


# Scans of so few splits are dealt out before the registered queries' per-row work.
FEW_SPLITS = 8


def spread(df: DataFrame, max_splits: int = 0) -> DataFrame:
    """Spread a scan of at most ``max_splits`` splits over the cluster (0: never).

    For CPU-heavy per-row work on a table stored as one or a few unsplittable files (one
    Parquet row group each): its rows are dealt round-robin over the cluster's default
    parallelism. Scans of more splits pass unchanged, whatever the cluster's size, so a
    large table is never moved.
    """
    if max_splits <= 0:
        return df
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD access (e.g. Spark Connect): leave as is
        return df
    return df.repartition(target) if splits <= max_splits and splits < target else df


def from_rows(spark: SparkSession, rows, schema: T.StructType | str) -> DataFrame:
    """SRC-1 / SRC-9 / SRC-10: small in-process collections with an explicit schema."""
    return spark.createDataFrame(rows, schema)


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """SRC-2: one record per document, id as a string (``"{}".format(docid)``)."""
    return df.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))


def document_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """SRC-3: one record per line, keyed ``"docid:lineid"`` (0-based line numbers).

    ``split`` on ``\\n`` keeps empty leading/trailing lines, as ``str.split`` does.
    """
    lines = df.select(F.col(id_col).cast("string").alias("doc_id"),
                      F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("line_no", "line"))
    return lines.select(F.concat_ws(":", "doc_id", F.col("line_no").cast("string")).alias("key"),
                        "doc_id", "line_no", "line")


def file_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """SRC-3: the lines of text files, ``(key, file, line_no, line)``, keyed ``"file:lineid"``.

    A file of many splits is read by many tasks; a line's number is counted over the splits before its own
    (see ``ordering.number_rows``). Empty lines count; an empty file has no lines. ``file`` is the
    file's whole path.
    """
    from quern.operators.ordering import number_rows
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    # Lines of a split come in order in one partition, so their place in it orders them.
    lines = reader.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_split"),
                                     F.monotonically_increasing_id().alias("_place"), F.col("value").alias("line"))
    out = number_rows(lines, ["_split", "_place"], ["file"], number="line_no", size="_lines")
    return out.select(F.concat_ws(":", "file", F.col("line_no").cast("string")).alias("key"), "file", "line_no", "line")


def coo_from_arrays(df: DataFrame, row_col: str, array_col: str,
                    value: Column | None = None) -> DataFrame:
    """SRC-4 / SRC-5: a row-per-vector table as a COO matrix ``(i, j, v)``.

    ``value`` maps the raw element column ``x`` to the stored value (default: x as double).
    Each input row expands in place (no shuffle), so any number of files/splits
    per matrix gives the same relation.
    """
    exploded = df.select(F.col(row_col).cast("long").alias("i"),
                         F.posexplode(array_col).alias("j", "x"))
    v = value if value is not None else F.col("x").cast("double")
    return exploded.select("i", F.col("j").cast("long").alias("j"), v.alias("v"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             drop_nulls: bool = False, infer_schema: bool = False,
             timestamp_format: str | None = None, corrupt: str | None = None, multi_line: bool = False,
             null_text: str = "") -> DataFrame:
    """SRC-6 / SRC-7: CSV with a header.

    Without a schema every column is a string (SRC-6, the reference's mode);
    with one, values are typed at read, and with ``infer_schema`` types come from one more
    pass over the file. ``drop_nulls`` is ``na.drop()`` (FIL-9). With ``corrupt``, a row that does not
    fit the schema keeps its text in the column of that name (see ``split_malformed``). ``multi_line`` reads line
    feeds inside quotes, at the price of one task a file. ``null_text`` stands for null; while it is empty,
    empty texts are null as well.
    """
    reader = spark.read.option("header", "true").option("inferSchema", infer_schema and schema is None) \
        .option("escape", '"').option("multiLine", multi_line).option("nullValue", null_text)
    if corrupt:
        schema = with_corrupt(schema, corrupt)
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    return df.na.drop() if drop_nulls else df


def read_xml_rows(spark: SparkSession, path: str, schema: T.StructType | str,
                  row_tag: str = "row", timestamp_format: str | None = None, corrupt: str | None = None) -> DataFrame:
    """SRC-8: XML rows with attributes as ``_Name`` columns (built-in source).

    The schema is required: inference with a ``timestampFormat`` that does not
    fit the data turns dates into strings (trap T8). With ``corrupt``, attributes are read as text and
    cast; a row with an attribute that does not fit, or that is no XML, keeps its text (its attributes as JSON)
    in the column of that name.
    """
    reader = spark.read.format("xml").option("rowTag", row_tag)
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
    if not corrupt:
        return reader.schema(schema).load(path)
    fields = with_corrupt(schema, corrupt).fields[:-1]
    raw = reader.schema(T.StructType([*[T.StructField(f.name, T.StringType()) for f in fields], T.StructField(corrupt, T.StringType())])) \
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt).load(path)

    def typed(f: T.StructField) -> Column:
        if timestamp_format and f.dataType.typeName().startswith("timestamp"):
            return F.try_to_timestamp(f"`{f.name}`", F.lit(timestamp_format)).cast(f.dataType)
        return F.col(f"`{f.name}`").try_cast(f.dataType)
    wrong = [F.col(f"`{f.name}`").isNotNull() & typed(f).isNull() for f in fields]
    text = F.when(F.array_contains(F.array(*wrong), True), F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in fields])))
    return raw.select(*[typed(f).alias(f.name) for f in fields], F.coalesce(F.col(f"`{corrupt}`"), text).alias(corrupt))


def with_corrupt(schema: T.StructType | str | None, corrupt: str) -> T.StructType:
    if schema is None:
        raise ValueError("rows can be malformed only against a schema")
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    return T.StructType([*fields, T.StructField(corrupt, T.StringType())])


def split_malformed(df: DataFrame, corrupt: str) -> tuple[DataFrame, DataFrame, int, int]:
    """Rows that fit, the texts of those that do not, and the number of each.

    The rows are written to the shared folder once, with all columns parsed: a reader that is
    asked for some columns only does not see what is wrong with the others.
    """
    path = scratch_path(df.sparkSession, "parsed")
    df.write.parquet(path)
    held = df.sparkSession.read.schema(df.schema).parquet(path)
    rows, bad = held.agg(F.count("*"), F.count(F.col(f"`{corrupt}`"))).first()
    return held.where(F.col(f"`{corrupt}`").isNull()).drop(corrupt), \
        held.where(F.col(f"`{corrupt}`").isNotNull()).select(corrupt), rows - bad, bad


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", null_text: str = "\\N") -> None:
    """CSV with a header; ``read_csv`` with the same ``null_text`` gives the rows back, blanks at the ends included."""
    df.write.mode(mode).option("header", "true").option("escape", '"').option("nullValue", null_text) \
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)


def write_xml_rows(df: DataFrame, path: str, row_tag: str = "row", root_tag: str = "rows", mode: str = "overwrite") -> None:
    """XML rows, each column an attribute as text, as ``read_xml_rows`` reads them; nulls are left out."""
    df.select(*[F.col(f"`{c}`").cast("string").alias(f"_{c}") for c in df.columns]).write.format("xml").mode(mode) \
        .option("rowTag", row_tag).option("rootTag", root_tag).save(path)


def read_stream(spark: SparkSession, directory: str, schema: T.StructType,
                file_glob: str | None = None, files_per_trigger: int | None = None) -> DataFrame:
    """SRC-11 / SRC-12: a Parquet file stream over a directory.

    Replay speed of the reference's sources is replaced by ``maxFilesPerTrigger``
    and the ``availableNow`` trigger.
    """
    reader = spark.readStream.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    return reader.parquet(directory)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    """SNK-1: Parquet writer (overwrite by default)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def schema_report(df: DataFrame) -> str:
    """SNK-4: the ``printSchema()`` tree as text."""
    return df.schema.treeString()


def summary(df: DataFrame, *statistics: str) -> DataFrame:
    """SNK-5 (full form, LR2's ``summary()``): count, mean, stddev, min,
    approximate 25/50/75 % and max of every column, as ``DataFrame.summary``."""
    return df.summary(*statistics)


def moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """SNK-5: ``(column_name, count, mean, stddev)`` of numeric columns in one scan.

    The mean is the exact sum over the count; ``stddev`` is the sample's.
    """
    aggs = [a for c in columns for a in (F.count(c).alias(f"{c}__count"), exact_mean(c).alias(f"{c}__mean"),
                                         F.stddev_samp(F.col(c).cast("double")).alias(f"{c}__stddev"))]
    parts = ", ".join(f"'{c}', `{c}__count`, `{c}__mean`, `{c}__stddev`" for c in columns)
    return df.agg(*aggs).selectExpr(f"stack({len(columns)}, {parts}) as (column_name, count, mean, stddev)")


def profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """SNK-5: per-column profile ``(column_name, count, min, max)`` in one scan.

    Oracle-comparable subset of ``DataFrame.summary()``; all statistics of all
    columns come from one aggregate (one pass, partial + final), then ``stack``
    turns the single wide row into one row per column.
    """
    if columns is None:
        columns = [f.name for f in df.schema.fields
                   if isinstance(f.dataType, T.NumericType)]
    aggs = []
    for c in columns:
        aggs += [F.count(c).alias(f"{c}__count"),
                 F.min(F.col(c).cast("double")).alias(f"{c}__min"),
                 F.max(F.col(c).cast("double")).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    parts = ", ".join(f"'{c}', `{c}__count`, `{c}__min`, `{c}__max`" for c in columns)
    return wide.selectExpr(
        f"stack({len(columns)}, {parts}) as (column_name, count, min, max)")
