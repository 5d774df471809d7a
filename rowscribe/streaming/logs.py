"""Training-log records as lines, in a batch or in a stream."""

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rowscribe.functions import fixed
from rowscribe.functions.values import py_str
from rowscribe.operators.columns import column, column_type, quoted, with_column
from rowscribe.operators.order import sorted_position

POLL_INTERVAL = "1 second"
LINES_PER_CHUNK = 1000


def log_line(
    step: Column,
    step_type: T.DataType,
    loss: Column,
    loss_type: T.DataType,
    loss_mark: str = fixed.LOG_LOSS,
) -> Column:
    """One line; a record without a loss shows ``N/A``."""
    shown = F.when(loss.isNull(), F.lit(fixed.NO_LOSS)).otherwise(py_str(loss, loss_type))
    return F.concat(
        F.lit(fixed.LOG_STEP), py_str(step, step_type), F.lit(loss_mark), shown, F.lit("\n")
    )


def with_log_line(df: DataFrame, step: str = "step", loss: str = "loss") -> DataFrame:
    """Add ``line``. Row by row, so ``df`` may be a stream."""
    line = log_line(
        column(df, step), column_type(df, step), column(df, loss), column_type(df, loss)
    )
    return with_column(df, "line", line)


def every_kth(df: DataFrame, k: int, step: str = "step") -> DataFrame:
    """Records of every ``k``-th step only."""
    return df.where(column(df, step) % k == 0)


def log_chunks(
    lines: DataFrame,
    order_by: Sequence[str],
    lines_per_chunk: int = LINES_PER_CHUNK,
    run: str | None = None,
) -> DataFrame:
    """The whole log in arrival order, as texts of ``lines_per_chunk`` lines.

    Joined by ``chunk`` number the texts are the cumulative log. It is not one
    text, because a log has no size limit and a cell has. Chunks are cut by
    position, so all are equally long whatever the step numbers are. Lines of
    many runs are told apart by the column ``run``: each run has a log of its
    own then, with chunks from 0. A null run is one too. Lines with equal keys
    come in an order that depends on their columns alone.
    """
    text = F.expr("listagg(line, '') within group (order by position)").alias("text")
    chunk = F.expr(f"position div {lines_per_chunk}").alias("chunk")
    keys = [c for c in order_by if c != run]
    columns = [*keys, "line"] if run is None else [run, *keys, "line"]
    numbered = sorted_position(lines.select(*[quoted(c) for c in columns]), keys, within=run)
    return numbered.groupBy(*[] if run is None else [F.col(quoted(run))], chunk).agg(text)


def read_log_stream(
    spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet", **options
) -> DataFrame:
    """Records arriving as files; ``path`` is a folder or a pattern."""
    return spark.readStream.schema(schema).format(format).options(**options).load(path)


def append_lines(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    *,
    format: str = "parquet",
    until_caught_up: bool = False,
) -> StreamingQuery:
    """Append a stream of lines to files, polling each second, or only until
    all records present are read. No state is kept; the files are the log."""
    trigger = {"availableNow": True} if until_caught_up else {"processingTime": POLL_INTERVAL}
    return (
        lines.writeStream.format(format)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start(path)
    )


def on_log(
    records: DataFrame,
    hook: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    until_caught_up: bool = False,
) -> StreamingQuery:
    """Call ``hook(records, batch_number)`` with each batch of new records."""
    trigger = {"availableNow": True} if until_caught_up else {"processingTime": POLL_INTERVAL}
    return (
        records.writeStream.foreachBatch(hook)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def once(spark: SparkSession, hook: Callable[[DataFrame, int], None], commits: str) -> Callable[[DataFrame, int], None]:
    """The hook, for :func:`on_log`, with a table in ``commits`` of the batches that it has
    been through: one that is handed over again, after a failure of what follows, is left out.

    A hook that fails midway runs again. If it writes each batch to a place of its own, in
    place of what is there, as :func:`append_batch` does, readers that only take batches of
    the table, as :func:`read_committed` does, see each batch once or not at all.
    """

    def run(batch: DataFrame, number: int) -> None:
        if not committed(spark, commits).where(F.col("batch") == number).isEmpty():
            return
        hook(batch, number)
        spark.range(1).select(F.lit(number).cast("long").alias("batch")).write.mode("append").parquet(commits)

    return run


def committed(spark: SparkSession, commits: str) -> DataFrame:
    """The numbers of the batches that are through, as ``batch``."""
    try:
        return spark.read.schema("batch long").parquet(commits).distinct()
    except AnalysisException:  # no batch yet
        return spark.createDataFrame([], "batch long")


def append_batch(path: str) -> Callable[[DataFrame, int], None]:
    """A hook that writes each batch to a folder of its number."""

    def hook(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return hook


def read_committed(spark: SparkSession, path: str, commits: str) -> DataFrame:
    """The rows of :func:`append_batch` of all batches that are through, with their ``batch``."""
    rows = spark.read.option("basePath", path).parquet(f"{path}/batch=*")
    return rows.join(committed(spark, commits), "batch", "left_semi")


def follow_log(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    order_by: Sequence[str],
    lines_per_chunk: int = LINES_PER_CHUNK,
    run: str | None = None,
    *,
    until_caught_up: bool = False,
) -> StreamingQuery:
    """Keep the cumulative log of a stream of lines, as :func:`log_chunks` has it, in ``path``.

    Each run has a state: the number of its lines so far, and the text of its last chunk
    while that is open. A batch adds its lines, in the order of ``order_by``, to what is
    there, and writes the chunks that it ends and the open one, not the log before them.
    Lines that arrive in a later batch come later. A batch that is run again replaces what
    it wrote. :func:`read_log` gives the log. The lines of a run in one batch are
    in one task, so batches are to be bounded, as by ``maxFilesPerTrigger``.
    """
    keys = [c for c in order_by if c != run]
    of_run = F.lit(None).cast("string") if run is None else F.col(quoted(run))
    rows = lines.select(
        of_run.alias("run"), *[F.col(quoted(c)).alias(f"k{i}") for i, c in enumerate(keys)], "line"
    )
    by = [f"k{i}" for i in range(len(keys))]

    def add(key, frames, state):
        import pandas as pd

        position, text = state.get if state.exists else (0, "")
        batch = pd.concat(list(frames), ignore_index=True)
        batch = batch.sort_values([*by, "line"], na_position="first", kind="stable")["line"].tolist()
        out, at = [], 0
        while at < len(batch):
            room = lines_per_chunk - position % lines_per_chunk
            more = batch[at : at + room]
            text += "".join(more)
            out.append((position // lines_per_chunk, text))
            position, at = position + len(more), at + len(more)
            if position % lines_per_chunk == 0:
                text = ""
        state.update((position, text))
        frame = pd.DataFrame(out, columns=["chunk", "text"])
        # The key is taken as an object, so a null one or a number stays as it is.
        frame.insert(0, "run", pd.Series([key[0]] * len(out), dtype="object"))
        yield frame

    kind = rows.schema["run"].dataType
    written = T.StructType().add("run", kind).add("chunk", "long").add("text", "string")
    chunks = rows.groupBy("run").applyInPandasWithState(
        add, written, "position long, text string", "update", "NoTimeout"
    )

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    trigger = {"availableNow": True} if until_caught_up else {"processingTime": POLL_INTERVAL}
    return (
        chunks.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """``run``, ``chunk`` and ``text`` of what :func:`follow_log` has written: of each chunk
    the text of the last batch that wrote it."""
    rows = spark.read.option("basePath", path).parquet(f"{path}/batch=*")
    return rows.groupBy("run", "chunk").agg(F.max_by("text", "batch").alias("text"))
