import pytest
from pyspark.sql import functions as F

from rowscribe import JobParameters, run
from rowscribe.plans.job import steps
from rowscribe.sources import scratch


@pytest.fixture(scope="module")
def dataset(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("jobs"))
    spark.range(0, 200, 1, 3).select(
        "id",
        F.concat(F.lit("q"), "id").alias("question"),
        F.concat(F.lit("a"), "id").alias("answer"),
        F.when(F.col("id") % 4 == 0, "c").alias("context"),
    ).write.parquet(f"{path}/pairs/train")
    turns = "array<struct<role:string,content:string>>"
    spark.createDataFrame(
        [(1, [("user", "u")]), (2, [("user", None)]), (3, [])], f"id int, messages {turns}"
    ).write.parquet(f"{path}/chats/train")
    return path


def test_whole_job(spark, dataset, tmp_path):
    out = str(tmp_path / "out")
    report = run(
        spark,
        JobParameters(f"{dataset}/pairs", ["id"], out, eos="</s>", tokenize=True, vocabulary_size=50),
    )
    assert (report.rows, report.unrendered, report.steps) == (200, 0, 25)
    rows = spark.read.parquet(out).orderBy("position").collect()
    assert [r.position for r in rows] == list(range(200))
    for r in rows:
        middle = "### Input:\nc\n\n" if r.id % 4 == 0 else ""
        assert r.text == f"### Instruction:\nq{r.id}\n\n{middle}### Response:\na{r.id}</s>"
        assert (r.micro_batch, r.step) == (r.position // 2, r.position // 8)
        assert len(r.labels) == len(r.token_ids) and r.labels[0] == -100 and r.labels[-1] >= 0


def test_text_only_json(spark, dataset, tmp_path):
    out = str(tmp_path / "out")
    report = run(
        spark,
        JobParameters(
            f"{dataset}/pairs",
            ["id"],
            out,
            eos="",
            text_only=True,
            dataset_num_samples=20,
            output_format="json",
            output_files=3,
            max_steps=60,
        ),
    )
    assert (report.rows, report.steps) == (20, 60)
    assert len(list((tmp_path / "out").glob("part-*"))) == 3
    assert set(spark.read.json(out).columns) == {"text", "position", "micro_batch", "step"}


def test_dry_run_counts_and_writes_nothing(spark, dataset, tmp_path):
    out = tmp_path / "out"
    report = run(spark, JobParameters(f"{dataset}/chats", ["id"], str(out), dry_run=True))
    assert (report.rows, report.unrendered, report.steps) == (3, 1, 1)
    assert not out.exists()


def test_source_columns_named_like_the_order(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(10).select("id", F.lit("x").alias("text"), F.lit(-1).alias("step")).write.parquet(source)
    job = JobParameters(source, ["id"], str(tmp_path / "out"), split=None)
    with pytest.raises(ValueError, match="step"):
        run(spark, job)


@pytest.mark.parametrize("epochs, expected", [(1.0, 30), (3.0, 90), (0.01, 1)])
def test_steps(epochs, expected):
    job = JobParameters("d", ["k"], num_train_epochs=epochs)
    assert steps(233, job) == expected


def test_scratch_follows_the_session(spark, monkeypatch):
    root = scratch.scratch_root(spark)
    assert root == (
        spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or root
    )
    assert scratch.scratch_path(spark, "x") != scratch.scratch_path(spark, "x")
