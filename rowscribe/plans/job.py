"""A whole preparation job: load, render, order, write."""

from collections.abc import Sequence
from dataclasses import dataclass, field
from math import ceil

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowscribe.operators.chat import ChatTemplate
from rowscribe.operators.columns import quoted
from rowscribe.operators.order import assign_batches, shuffle_take
from rowscribe.operators.render import render
from rowscribe.operators.tokens import (
    DEFAULT_LENGTH,
    DEFAULT_VOCABULARY,
    build_vocabulary,
    encode_with_labels,
    written,
)
from rowscribe.sources.datasets import load_split
from rowscribe.sources.scratch import scratch_path
from rowscribe.sources.sinks import dry_run, write_rows


@dataclass(frozen=True)
class JobParameters:
    """What a job reads, how it renders and what it writes.

    ``keys`` identify a row. ``output_files`` is best chosen for files of about
    a gigabyte; the default is the session's number of shuffle partitions.
    ``shuffled_samples`` keeps that many rows of a shuffle by ``sample_seed``.
    """

    dataset_name: str
    keys: Sequence[str]
    output_dir: str = "outputs"
    format: str = "parquet"
    split: str | None = "train"
    split_column: str | None = None
    dataset_num_samples: int | None = None
    shuffled_samples: int | None = None
    sample_seed: int = 42
    dataset_text_column: str | None = None
    style: str = "auto"
    eos: str | None = None
    template: ChatTemplate | None = None
    text_only: bool = False
    tokenize: bool = False
    vocabulary_size: int = DEFAULT_VOCABULARY
    max_seq_length: int = DEFAULT_LENGTH
    random_state: int = 3407
    batch_size: int = 2
    gradient_accumulation_steps: int = 4
    num_train_epochs: float = 1.0
    max_steps: int = -1
    dry_run: bool = False
    output_format: str = "parquet"
    output_files: int | None = None
    schema: StructType | str | None = None
    strict: bool = False
    options: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class JobReport:
    """``unrendered`` counts rows whose text is null, such as chats with a
    missing turn content."""

    rows: int
    unrendered: int
    steps: int


def prepare(spark: SparkSession, job: JobParameters) -> DataFrame:
    """The ordered, rendered training set, not yet computed. A sample and a vocabulary
    are, and kept as tables in the scratch folder: several steps read them.

    Rows are ordered before they are rendered: the text is then made after the
    shuffle and does not travel next to the columns it is made of.
    """
    raw = load_split(
        spark,
        job.dataset_name,
        job.split,
        format=job.format,
        split_column=job.split_column,
        num_samples=job.dataset_num_samples,
        order_by=job.keys if job.format == "table" else None,
        schema=job.schema,
        strict=job.strict,
        **job.options,
    )
    order = ["position", "micro_batch", "step"]
    if taken := set(order) & set(raw.columns):
        raise ValueError(f"the dataset has columns named like the order: {sorted(taken)}")
    if job.shuffled_samples:
        sample = shuffle_take(raw, job.shuffled_samples, job.sample_seed, job.keys)
        path = scratch_path(spark, "sample")
        sample.drop("position").write.parquet(path)
        raw = spark.read.schema(raw.schema).parquet(path)
    batched = assign_batches(
        raw,
        job.batch_size,
        job.gradient_accumulation_steps,
        job.random_state,
        job.keys,
        shards=job.output_files,
    )
    rows = batched.select(*[quoted(c) for c in raw.columns], F.struct(*order).alias("_order"))
    result, added = _render(rows, job), ["text"]
    if job.tokenize:
        vocabulary = build_vocabulary(_render(raw, job), "text", job.vocabulary_size)
        vocabulary = written(vocabulary, scratch_path(spark, "vocabulary"))
        result = encode_with_labels(result, vocabulary, job.max_seq_length)
        added += ["token_ids", "labels"]
    kept = added if job.text_only else [c for c in result.columns if c != "_order"]
    return result.select(
        *[quoted(c) for c in kept], *[F.col("_order")[name].alias(name) for name in order]
    )


def run(spark: SparkSession, job: JobParameters) -> JobReport:
    """Prepare and write (or, as a dry run, only compute) the training set."""
    seen = Observation()
    rows = prepare(spark, job).observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.col("text").isNull(), 1)).alias("unrendered"),
    )
    if job.dry_run:
        dry_run(rows)
    else:
        write_rows(rows, job.output_dir, job.output_format)
    counted = seen.get
    return JobReport(
        rows=counted["rows"],
        unrendered=counted["unrendered"],
        steps=steps(counted["rows"], job),
    )


def steps(rows: int, job: JobParameters) -> int:
    """Optimizer steps of the run, see :func:`rowscribe.operators.order.step_budget`."""
    if job.max_steps > 0:
        return job.max_steps
    per_epoch = ceil(ceil(rows / job.batch_size) / job.gradient_accumulation_steps)
    return ceil(per_epoch * job.num_train_epochs)


def _render(df: DataFrame, job: JobParameters) -> DataFrame:
    return render(
        df,
        job.style,
        eos=job.eos,
        template=job.template,
        text_column=job.dataset_text_column,
        parts=job.tokenize,
    )
