import hashlib
from math import ceil

import pytest
from pyspark.sql import functions as F

from rowscribe.operators import order
from rowscribe.plans import views


def shuffled(n, seed):
    return sorted(range(n), key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))


@pytest.mark.parametrize("partitions, shards", [(1, 1), (4, 3), (13, 40)])
def test_position_does_not_depend_on_partitions(spark, partitions, shards):
    rows = spark.range(0, 3000, 1, partitions).withColumnRenamed("id", "k")
    found = order.shuffled_position(rows, 3407, ["k"], shards=shards).collect()
    assert [r.k for r in sorted(found, key=lambda r: r.position)] == shuffled(3000, 3407)
    assert sorted(r.position for r in found) == list(range(3000))


@pytest.mark.parametrize("n", [0, 1, 100, 2999, 3000, 5000])
def test_shuffle_take(spark, n):
    rows = spark.range(3000).withColumnRenamed("id", "k")
    found = order.shuffle_take(rows, n, 42, ["k"]).collect()
    assert [r.k for r in sorted(found, key=lambda r: r.position)] == shuffled(3000, 42)[:n]


def test_several_keys(spark):
    rows = spark.range(200).select((F.col("id") % 7).alias("a"), F.col("id").alias("b.c"))
    found = order.shuffled_position(rows, 1, ["a", "b.c"]).collect()
    expected = sorted(
        ((k % 7, k) for k in range(200)),
        key=lambda t: hashlib.md5(f"1:{t[0]}:{t[1]}".encode()).hexdigest(),
    )
    assert [(r.a, r["b.c"]) for r in sorted(found, key=lambda r: r.position)] == expected


def test_no_rows(spark):
    assert order.assign_batches(spark.range(0), 2, 4, 1, ["id"]).count() == 0
    assert order.sorted_position(spark.range(0), ["id"]).count() == 0


def test_batches(spark):
    rows = order.assign_batches(spark.range(101), 3, 2, 1, ["id"]).collect()
    for row in rows:
        assert (row.micro_batch, row.step) == (row.position // 3, row.position // 6)


def test_written_batches_are_in_order(spark, tmp_path):
    path = str(tmp_path / "out")
    order.assign_batches(spark.range(5000), 2, 4, 1, ["id"], shards=6).write.parquet(path)
    files = (
        spark.read.parquet(path)
        .select("position", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i"))
        .orderBy("f", "i")
        .collect()
    )
    assert [r.position for r in files] == list(range(5000))
    assert len({r.f for r in files}) == 6


def test_one_shuffle_of_the_rows(spark):
    rows = order.assign_batches(spark.range(100).withColumn("text", F.lit("x")), 2, 4, 1, ["id"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    wide = [l for l in plan.splitlines() if "Exchange" in l and "shufflepartitionid" in l]
    assert len(wide) == 1 and plan.count("Exchange SinglePartition") == 1
    # What goes to one partition is counts: the other shuffle is by prefix.
    assert "partial_count" in plan and "hashpartitioning(_prefix" in plan


@pytest.mark.parametrize("b, g, epochs, n", [(2, 4, 1.0, 233), (2, 4, 3.0, 16), (3, 2, 0.5, 17), (1, 1, 2.5, 0)])
def test_step_budget(spark, b, g, epochs, n):
    row = order.step_budget(spark.range(n), b, g, epochs).first()
    assert (row.n_rows, row.steps) == (n, ceil(ceil(ceil(n / b) / g) * epochs))
    assert order.step_budget(spark.range(n), b, g, epochs, max_steps=60).first().steps == 60


@pytest.mark.parametrize("keys", [["a", "b"], ["b"]])
def test_head(spark, keys):
    rows = spark.range(0, 500, 1, 7).select(
        F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("a"), (499 - F.col("id")).alias("b")
    )
    everything = sorted(
        rows.collect(), key=lambda r: [(r[k] is not None, r[k] or 0) for k in keys]
    )
    for n in (0, 1, 120, 500, 900):
        assert order.head(rows, n, keys).collect() == everything[:n]


@pytest.mark.parametrize("n", [1000, 1001, 12_000])
def test_head_of_repeated_and_null_keys(spark, n):
    rows = spark.range(0, 30_000, 1, 5).select(
        F.when(F.col("id") % 4 > 0, F.expr("id div 9")).alias("k"), F.col("id").alias("v")
    )
    found = [r.k for r in order.head(rows, n, ["k"]).collect()]
    expected = sorted((r.k for r in rows.collect()), key=lambda k: (k is not None, k or 0))
    assert found == expected[:n]


def test_shuffle_take_moves_few_rows(spark):
    rows = spark.range(0, 400_000, 1, 4).withColumnRenamed("id", "k")
    taken = order.shuffle_take(rows, 3, 42, ["k"])
    assert [r.k for r in sorted(taken.collect(), key=lambda r: r.position)] == sorted(
        range(400_000), key=lambda k: hashlib.md5(f"42:{k}".encode()).hexdigest()
    )[:3]


def test_pairs_with_gaps(spark):
    turns = spark.createDataFrame(
        [
            (1, 0, "user", "q"),
            (1, 5000, "assistant", "a"),
            (2, 0, "system", "s"),
            (2, 1_700_000_000_000_000, "user", "q2"),
            (2, 1_700_000_090_000_000, "assistant", "a2"),
        ],
        "conv_id bigint, turn bigint, role string, text string",
    )
    found = sorted(tuple(r) for r in views.pairs(turns).collect())
    assert [(r[0], *r[2:]) for r in found] == [(1, "q", "a", None), (2, "q2", "a2", "s")]


def test_sorted_position_with_a_hot_leading_key(spark):
    rows = spark.range(0, 2000, 1, 9).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("long").alias("a"),
        (F.col("id") * 37 % 2000).alias("b"),
    )
    found = order.sorted_position(rows, ["a", "b"]).collect()
    ranked = sorted(found, key=lambda r: r.position)
    assert [(r.a, r.b) for r in ranked] == sorted((r.a, r.b) for r in rows.collect())
    assert [r.position for r in ranked] == list(range(2000))


def keyed(spark, kind):
    """Rows with a hot first key, nulls, and values far from the others."""
    rows = spark.range(0, 3000, 1, 7)
    a = F.when(F.col("id") % 3 == 0, 500).when(F.col("id") % 100 == 1, None).when(F.col("id") == 17, 10**15).otherwise(F.col("id") % 40)
    if kind == "double":
        a = F.when(F.col("id") % 50 == 2, F.lit(float("nan"))).when(F.col("id") == 20, float("-inf")).otherwise(a / 7)
    if kind == "string":
        a = F.concat(F.lit("k"), a.cast("string"), F.when(F.col("id") % 2 == 0, "longer than six").otherwise(""))
    if kind == "date":
        a = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 9).cast("int"))
    if kind == "timestamp":
        a = F.timestamp_micros(F.col("id") % 70 * 300_000)
    return rows.select(a.alias("a"), (F.col("id") * 37 % 600).alias("b"), (F.col("id") % 4).alias("run"), F.col("id").alias("line"))


@pytest.mark.parametrize(
    ("kind", "keys"),
    [("long", ["a"]), ("long", ["a", "b", "line"]), ("double", ["a", "b"]), ("string", ["a", "b"]), ("date", ["a", "b"]), ("timestamp", ["a"])],
)
def test_sorted_position_of_ranges(spark, monkeypatch, kind, keys):
    monkeypatch.setattr(order, "_LIGHT", 0)
    rows = keyed(spark, kind)
    if kind != "double":
        found = order.sorted_position(rows, keys).orderBy("position").collect()
        assert [r.position for r in found] == list(range(3000))
        wanted = rows.orderBy(*keys).collect()
        assert repr([tuple(r[k] for k in keys) for r in found]) == repr([tuple(r[k] for k in keys) for r in wanted])
    if kind != "date":
        by_run = order.sorted_position(rows, keys, within="run").orderBy("run", "position").collect()
        wanted = rows.orderBy("run", *keys).collect()
        assert [r.position for r in by_run] == [i for _ in range(4) for i in range(750)]
        assert repr([tuple(r[k] for k in keys) for r in by_run]) == repr([tuple(r[k] for k in keys) for r in wanted])


def test_a_heavy_step_is_ranked_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(order, "_LIGHT", 100)
    rows = spark.range(0, 30_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 123_456).otherwise(F.col("id") * 1000).alias("step"), F.col("id").alias("line")
    )
    tasks = order.sorted_position(rows, ["step"], shards=8).groupBy(F.spark_partition_id()).agg(
        F.count(F.when(F.col("step") == 123_456, 1)).alias("n")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r.n for r in tasks.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 10_000 and max(sizes) < 4000


def test_positions_start_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    order.sorted_position(spark.range(1000), ["id"])
    assert not tracker.getJobIdsForGroup("planning")


def test_pairs_of_long_chats(spark):
    turns = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).cast("long").alias("conv_id"),
        F.when(F.col("id") % 3 == 0, F.col("id") / 3).otherwise(F.lit(0)).cast("long").alias("turn"),
    )
    role = (
        F.when(F.col("turn") == 0, "system")
        .when(F.col("turn") % 2 == 1, "user")
        .otherwise("assistant")
    )
    turns = turns.select(
        "conv_id", "turn", role.alias("role"), F.concat_ws("-", "conv_id", "turn").alias("text")
    )
    cut = views.pairs(turns, turns_per_block=5)
    whole = views.pairs(turns, turns_per_block=10**6)
    assert sorted(cut.collect()) == sorted(whole.collect())
    row = whole.where("turn = 5").first()
    assert (row.instruction, row.output, row.input) == ("1-5", "1-6", "1-0")
    assert whole.count() == 499


def test_epochs_are_permutations(spark):
    for n in (0, 1, 2, 7, 1000):
        rows = order.epoch_batches(order.shuffled_position(spark.range(n), 5, ["id"]), 3, 2, 4, 5)
        found = sorted(rows.collect(), key=lambda r: (r.epoch, r.place))
        assert [(r.epoch, r.place) for r in found] == [(e, p) for e in range(4) for p in range(n)]
        steps = order.step_budget(spark.range(n), 3, 2, epochs=4).first().steps
        assert len({r.step for r in found}) == steps and (not n or found[-1].step == steps - 1)
        orders = [[r.id for r in found if r.epoch == e] for e in range(4)]
        assert n < 100 or all(sum(a == b for a, b in zip(x, y)) < 20 for x in orders for y in orders if x is not y)
    assert all(r.place == r.position for r in found if r.epoch == 0)


def test_columns_of_the_caller_stay(spark):
    rows = spark.range(50).selectExpr("id", "id as _digest", "id as _PREFIX", "id as _shard", "id as _start", "id as _n", "id as _rounds")
    for found in (order.shuffled_position(rows, 1, ["id"]), order.shuffle_take(rows, 20, 1, ["id"])):
        assert found.columns == [*rows.columns, "position"]
        assert all(r.id == r["_digest"] == r["_PREFIX"] == r["_shard"] == r["_start"] for r in found.collect())
    epochs = order.epoch_batches(order.shuffled_position(rows, 1, ["id"]), 2, 2, 2, 1)
    assert all(r.id == r["_n"] == r["_rounds"] for r in epochs.collect())
    with pytest.raises(ValueError, match="Position"):
        order.assign_batches(rows.withColumn("Position", F.lit(1)), 2, 2, 1, ["id"])
