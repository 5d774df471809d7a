import pytest
from pyspark.sql import functions as F

from rowscribe.functions import fixed
from rowscribe.operators.render import render
from rowscribe.streaming import logs

SCHEMA = "step bigint, loss double"
RECORDS = [(1, 2.5), (2, None), (3, 1e-5), (25, 0.125)]
LINES = ["Step 1: Loss 2.5\n", "Step 2: Loss N/A\n", "Step 3: Loss 1e-05\n", "Step 25: Loss 0.125\n"]


@pytest.fixture
def folder(spark, tmp_path):
    path = str(tmp_path / "records")
    rows = spark.createDataFrame(RECORDS, SCHEMA)
    rows.where("step < 3").coalesce(1).write.parquet(path)
    rows.where("step >= 3").coalesce(1).write.mode("append").parquet(path)
    return path


def test_lines(spark):
    rows = logs.with_log_line(spark.createDataFrame(RECORDS, SCHEMA))
    assert [r.line for r in rows.orderBy("step").collect()] == LINES


def test_other_mark(spark):
    rows = spark.createDataFrame(RECORDS[:1], SCHEMA)
    types = [field.dataType for field in rows.schema.fields]
    line = logs.log_line(F.col("step"), types[0], F.col("loss"), types[1], fixed.LOG_LOSS_COLON)
    assert rows.select(line).first()[0] == "Step 1: Loss: 2.5\n"


def test_every_kth(spark):
    rows = spark.createDataFrame(RECORDS, SCHEMA)
    assert [r.step for r in logs.every_kth(rows, 25).collect()] == [25]
    assert logs.every_kth(rows, 1).count() == 4


def test_chunks_make_up_the_log(spark):
    # A third of the lines belong to one step.
    rows = spark.range(0, 3000, 1, 7).select(
        F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id")).cast("long").alias("step"),
        F.col("id").alias("arrival"),
        F.concat(F.lit("l"), "id", F.lit("\n")).alias("line"),
    )
    chunks = logs.log_chunks(rows, ["step", "arrival"], 100).orderBy("chunk").collect()
    expected = [r.line for r in rows.orderBy("step", "arrival").collect()]
    assert "".join(c.text for c in chunks) == "".join(expected)
    assert {c.text.count("\n") for c in chunks} == {100}


def test_runs_have_logs_of_their_own(spark):
    records = [("a", 1, "a1\n"), ("b", 1, "b1\n"), (None, 1, "n1\n"), ("a", 2, "a2\n"), ("a", 3, "a3\n")]
    rows = spark.createDataFrame(records, "`run.id` string, step int, line string")
    found = logs.log_chunks(rows, ["step"], 2, run="run.id").collect()
    assert {(r["run.id"], r.chunk, r.text) for r in found} == {
        ("a", 0, "a1\na2\n"),
        ("a", 1, "a3\n"),
        ("b", 0, "b1\n"),
        (None, 0, "n1\n"),
    }


def test_stream_appends(spark, folder, tmp_path):
    schema = spark.read.parquet(folder).schema
    out, progress = str(tmp_path / "lines"), str(tmp_path / "progress")

    def follow():
        lines = logs.with_log_line(logs.read_log_stream(spark, folder, schema))
        query = logs.append_lines(lines.select("step", "line"), out, progress, until_caught_up=True)
        query.awaitTermination()
        return [r.line for r in spark.read.parquet(out).orderBy("step").collect()]

    assert follow() == LINES
    more = spark.createDataFrame([(26, 0.5)], SCHEMA)
    more.write.mode("append").parquet(folder)
    assert follow() == [*LINES, "Step 26: Loss 0.5\n"]


def test_polling_each_second(spark, folder, tmp_path):
    lines = logs.with_log_line(
        logs.read_log_stream(spark, folder, spark.read.parquet(folder).schema)
    ).select("step", "line")
    query = logs.append_lines(lines, str(tmp_path / "lines"), str(tmp_path / "progress"))
    try:
        query.processAllAvailable()
        assert spark.read.parquet(str(tmp_path / "lines")).count() == 4
    finally:
        query.stop()


def test_renderers_take_streams(spark, tmp_path):
    source, out = str(tmp_path / "pairs"), str(tmp_path / "texts")
    rows = spark.createDataFrame([("q", 0.5), ("r", 1e20)], "question string, answer double")
    rows.write.parquet(source)
    stream = render(logs.read_log_stream(spark, source, rows.schema), eos="</s>")
    logs.append_lines(stream, out, str(tmp_path / "progress"), until_caught_up=True).awaitTermination()
    found = spark.read.parquet(out)
    assert sorted(found.collect()) == sorted(render(rows, eos="</s>").collect())


def test_hook(spark, folder, tmp_path):
    seen = []
    records = logs.read_log_stream(spark, folder, spark.read.parquet(folder).schema)
    query = logs.on_log(
        records,
        lambda batch, number: seen.append((number, batch.count())),
        str(tmp_path / "progress"),
        until_caught_up=True,
    )
    query.awaitTermination()
    assert sum(n for _, n in seen) == 4


def test_cumulative_log_of_a_stream(spark, tmp_path):
    source, log, progress = (str(tmp_path / name) for name in ("source", "log", "progress"))
    schema = "run string, step bigint, line string"

    def arrive(rows):
        spark.createDataFrame(rows, schema).repartition(3).write.mode("append").parquet(source)
        stream = logs.read_log_stream(spark, source, spark.createDataFrame([], schema).schema)
        logs.follow_log(stream, log, progress, ["step"], 3, run="run", until_caught_up=True).awaitTermination()
        return {(r.run, r.chunk): r.text for r in logs.read_log(spark, log).collect()}

    assert arrive([("a", 2, "a2\n"), ("a", 1, "a1\n"), (None, 1, "n1\n")]) == {("a", 0): "a1\na2\n", (None, 0): "n1\n"}
    found = arrive([("a", i, f"a{i}\n") for i in range(3, 9)] + [("b", 1, "b1\n")])
    assert "".join(found["a", i] for i in range(3)) == "".join(f"a{i}\n" for i in range(1, 9))
    assert found["a", 2] == "a7\na8\n" and found["b", 0] == "b1\n" and found[None, 0] == "n1\n"
    # The second batch wrote the open chunk and those after it, not what was there before.
    written = spark.read.option("basePath", log).parquet(f"{log}/batch=*").where("run = 'a' and batch = 1")
    assert {r.chunk for r in written.collect()} == {0, 1, 2}
    assert arrive([("a", 9, "a9\n"), (None, 2, "n2\n")])["a", 2] == "a7\na8\na9\n"
    assert {r.chunk for r in spark.read.parquet(f"{log}/batch=2").where("run = 'a'").collect()} == {2}


def test_a_batch_takes_effect_once(spark, tmp_path):
    source, path, commits, progress = (str(tmp_path / name) for name in ("source", "out", "commits", "progress"))
    schema = spark.createDataFrame([], "id bigint").schema
    calls = []

    def fails_midway(batch, number):
        calls.append(number)
        logs.append_batch(path)(batch.limit(1) if len(calls) == 2 else batch, number)
        if len(calls) == 2:
            raise RuntimeError("stopped after a part was written")

    def follow():
        records = logs.read_log_stream(spark, source, schema)
        logs.on_log(records, logs.once(spark, fails_midway, commits), progress, until_caught_up=True).awaitTermination()
        return sorted(r.id for r in logs.read_committed(spark, path, commits).collect())

    spark.range(3).write.parquet(source)
    assert follow() == [0, 1, 2]
    spark.range(3, 8).write.mode("append").parquet(source)
    with pytest.raises(Exception, match="stopped after a part"):
        follow()
    assert sorted(r.id for r in logs.read_committed(spark, path, commits).collect()) == [0, 1, 2]
    assert follow() == list(range(8)) and calls == [0, 1, 1]
    # A batch that is handed over once more is not run.
    logs.once(spark, fails_midway, commits)(spark.range(99), 1)
    assert calls == [0, 1, 1] and logs.read_committed(spark, path, commits).count() == 8
