"""Read datasets and their splits."""

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rowscribe.functions import fixed
from rowscribe.operators.columns import column
from rowscribe.operators.order import head

_PARENT_FOLDER = "([^/]+)/[^/]+$"
#: Where Spark puts a record that it can't read by the schema, and how many files an error names.
_BAD_RECORD, _NAMED = "_corrupt_record", 20


@contextmanager
def loading_errors() -> Iterator[None]:
    """Whatever fails inside is a RuntimeError of loading, also while rows are read."""
    try:
        yield
    except Exception as error:
        if isinstance(error, RuntimeError) and str(error).startswith(fixed.LOAD_ERROR):
            raise
        raise RuntimeError(f"{fixed.LOAD_ERROR}{error}") from error


def load_split(
    spark: SparkSession,
    name: str,
    split: str | None = "train",
    *,
    format: str = "parquet",
    split_column: str | None = None,
    num_samples: int | None = None,
    order_by: Sequence[str] | None = None,
    schema: StructType | str | None = None,
    strict: bool = False,
    **options,
) -> DataFrame:
    """Rows of one split of a dataset.

    ``name`` is a path, or a table if ``format`` is ``"table"``. The split is
    the sub-folder of that name, or, with ``split_column``, the rows with that
    value: a filter which prunes partitions if the column is one. A table has
    no sub-folders, so its split needs the column. ``None`` reads everything at ``name``.

    ``num_samples`` keeps the first rows, by ``order_by`` or else by file and
    row. None and 0 keep all; more than there are is an error.
    ``schema`` saves reading JSON and CSV twice.
    Whatever fails here is reported as a RuntimeError. Unreadable file content
    shows up later, when the rows are read (see :func:`loading_errors`), and a JSON or CSV
    record that does not fit the schema as nulls. ``strict`` reads JSON and CSV once more
    beforehand, and one error names the files with such records.
    """
    with loading_errors():
        if format == "table":
            if split is not None and not split_column:
                raise ValueError(f"split {split!r} of a table needs split_column")
            rows = spark.table(name)
        else:
            folder = name if split is None or split_column else f"{name.rstrip('/')}/{split}"
            if strict and format in ("json", "csv"):
                _refuse(faulty_files(spark, folder, format=format, schema=schema, **options))
            rows = _reader(spark, format, schema, options).load(folder)
        if split_column and split is not None:
            rows = rows.where(column(rows, split_column) == split)
        return sample_head(rows, num_samples, order_by, format)


def faulty_files(
    spark: SparkSession,
    path: str,
    *,
    format: str = "json",
    schema: StructType | str | None = None,
    **options,
) -> DataFrame:
    """(file, rows, bad): JSON or CSV files with records that can't be read by the schema, how
    many records each has and how many of them are bad.

    One scan, counted by file before the shuffle; no record travels. Without ``schema`` it is
    inferred as for reading, and then only what is no record at all is bad. A file that
    can't be read in any part ends the scan with Spark's error, which names it.
    """
    plain = _reader(spark, format, schema, options).load(path).schema
    plain = StructType([field for field in plain if field.name != _BAD_RECORD])
    # Spark parses the columns that are asked for only, and a bad value is seen in no other.
    every = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD_RECORD, "columnPruning": "false"}
    seen = StructType([*plain, StructField(_BAD_RECORD, StringType())])
    rows = _reader(spark, format, seen, options | every).load(path)
    values = F.struct(*(column(rows, field.name) for field in plain))
    bad = F.count(F.when(F.col(_BAD_RECORD).isNotNull(), values)).alias("bad")
    files = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"), bad)
    return files.where("bad > 0")


def _refuse(files: DataFrame) -> None:
    """Fail if there are files, naming the first ones; the driver gets no more of them."""
    numbers = files.agg(F.count("*").alias("files"), F.sum("bad").alias("bad")).first()
    if numbers["files"]:
        named = files.orderBy("file").limit(_NAMED).collect()
        shown = ", ".join(f"{row['file']} ({row['bad']} of {row['rows']})" for row in named)
        more = "" if numbers["files"] <= _NAMED else f" and {numbers['files'] - _NAMED} files more"
        raise ValueError(f"{numbers['bad']} records can't be read: {shown}{more}")


def load_all_splits(
    spark: SparkSession,
    path: str,
    *,
    format: str = "parquet",
    schema: StructType | str | None = None,
    **options,
) -> DataFrame:
    """All sub-folders of a dataset, with the folder's name as ``split``."""
    with loading_errors():
        rows = _reader(spark, format, schema, options).load(f"{path.rstrip('/')}/*")
        return rows.withColumn(
            "split", F.regexp_extract("_metadata.file_path", _PARENT_FOLDER, 1)
        )


def pick_split(df: DataFrame, split: str, split_column: str = "split") -> DataFrame:
    """One split of a dataset that was loaded with all of them."""
    return df.where(column(df, split_column) == split)


def spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Deal the rows of a table out to all cores, if it has fewer tasks.

    For costly expressions over a table of one or two files. A large table has
    more tasks than there are cores and is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() * 2 > cores:
        return df
    return df.repartition(cores, *[column(df, key) for key in keys])


def sample_head(
    df: DataFrame,
    num_samples: int | None,
    order_by: Sequence[str] | None = None,
    format: str = "parquet",
) -> DataFrame:
    """The first rows; None and 0 mean all, and asking for too many is an error."""
    if not num_samples:
        return df
    if num_samples < 0:
        raise ValueError(f"the number of samples must not be negative: {num_samples}")
    if order_by is None and format == "parquet":
        return head_in_file_order(df, num_samples)
    if order_by is None:
        return head_in_block_order(df, num_samples)
    available = df.count()
    if num_samples > available:
        raise ValueError(f"{num_samples} samples asked for, {available} rows available")
    return head(df, num_samples, order_by)


def head_in_file_order(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of Parquet files by file name and row.

    The rows of each file that ``df`` keeps are counted to find the file where
    the head ends; without a filter that reads no data. Of that file alone the
    row numbers are sorted to find the last one. Files after it are skipped, and
    no other rows are sorted. The result is in no particular order across tasks.
    """
    path, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    until_here = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, 0)
    # One row per file: what the driver's file listing holds as well.
    files = df.groupBy(path.alias("path")).count().withColumn("until", F.sum("count").over(until_here))
    end = files.where(F.col("until") >= n).orderBy("path").first()
    if end is None:
        raise ValueError(f"{n} samples asked for, but there are fewer rows")
    # Row numbers count all rows of a file, also those that a filter leaves out.
    wanted = n - (end["until"] - end["count"])
    numbers = df.where(path == end["path"]).select(row.alias("row")).orderBy("row").limit(wanted)
    last = numbers.agg(F.max("row")).first()[0]
    return df.where(path <= end["path"]).where((path < end["path"]) | (row <= last))


def head_in_block_order(df: DataFrame, n: int) -> DataFrame:
    """As :func:`head_in_file_order`, for files that do not number their rows: JSON, CSV,
    text, ORC and others that are read in blocks.

    Rows are counted in the first file, then in four times as many, until there are enough
    of them, so files long after the head are not read. Of the file where the head ends the
    rows are sorted by block and place in it, and only so many kept in a task as are wanted.
    """
    path, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    until_here = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, 0)
    # The driver's listing of the files, local ones as rows name them; what is counted has
    # one row for each.
    files = sorted(re.sub("^file:/+", "file:/", file) for file in df.inputFiles())
    some, end = 1, None
    while end is None:
        part = df.where(path <= files[some - 1]) if some < len(files) else df
        counted = part.groupBy(path.alias("path")).count().withColumn("until", F.sum("count").over(until_here))
        end = counted.where(F.col("until") >= n).orderBy("path").first()
        if end is None and some >= len(files):
            raise ValueError(f"{n} samples asked for, but there are fewer rows")
        some *= 4
    wanted = n - (end["until"] - end["count"])
    # Numbers ascend with the rows of a block, wherever the file was cut into blocks.
    last = df.where(path == end["path"]).orderBy(block, F.monotonically_increasing_id()).limit(wanted)
    return df.where(path < end["path"]).unionByName(last)


def _reader(
    spark: SparkSession, format: str, schema: StructType | str | None, options: dict
) -> DataFrameReader:
    reader = spark.read.format(format).options(**options)
    return reader if schema is None else reader.schema(schema)
