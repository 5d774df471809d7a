import pytest
from pyspark.sql import functions as F

from rowscribe.sources.datasets import (
    faulty_files,
    head_in_file_order,
    load_all_splits,
    load_split,
    loading_errors,
    pick_split,
    sample_head,
    spread,
)
from rowscribe.sources.preview import preview_dataset, preview_formatted, preview_raw
from rowscribe.sources.sinks import dry_run, write_rows, write_sorted


@pytest.fixture(scope="module")
def dataset(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("dataset")
    rows = spark.range(0, 100, 1, 4).select("id", F.concat(F.lit("t"), "id").alias("text"))
    for format in ("parquet", "json", "csv", "orc"):
        for split, part in (("train", "id < 80"), ("test", "id >= 80")):
            rows.where(part).write.format(format).option("header", True).save(f"{root}/{format}/{split}")
    rows.select("text").coalesce(1).write.text(f"{root}/text/train")
    rows.withColumn("split", F.when(F.col("id") < 80, "train").otherwise("test")).write.partitionBy(
        "split"
    ).parquet(f"{root}/partitioned")
    return str(root)


@pytest.mark.parametrize("format", ["parquet", "json", "csv", "orc"])
def test_formats(spark, dataset, format):
    options = {"header": True} if format == "csv" else {}
    rows = load_split(spark, f"{dataset}/{format}", format=format, **options)
    assert rows.count() == 80 and set(rows.columns) == {"id", "text"}
    test = load_split(spark, f"{dataset}/{format}", "test", format=format, **options)
    assert test.count() == 20
    every = load_all_splits(spark, f"{dataset}/{format}", format=format, **options)
    assert pick_split(every, "test").count() == 20
    assert every.groupBy("split").count().count() == 2


def test_given_schema(spark, dataset):
    rows = load_split(spark, f"{dataset}/csv", format="csv", schema="id bigint, text string", header=True)
    assert [f.dataType.simpleString() for f in rows.schema] == ["bigint", "string"]
    assert rows.agg({"id": "sum"}).first()[0] == sum(range(80))


def test_text_lines(spark, dataset):
    rows = load_split(spark, f"{dataset}/text", format="text")
    assert rows.columns == ["value"] and rows.count() == 100


def test_split_partitions_are_pruned(spark, dataset):
    rows = load_split(spark, f"{dataset}/partitioned", "test", split_column="split")
    assert rows.count() == 20
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    assert load_split(spark, f"{dataset}/partitioned", None).count() == 100


def test_tables(spark, dataset):
    spark.read.parquet(f"{dataset}/partitioned").createOrReplaceTempView("some_rows")
    rows = load_split(spark, "some_rows", "train", format="table", split_column="split")
    assert rows.count() == 80


@pytest.mark.parametrize(
    "name, options",
    [
        ("nowhere", {}),
        ("parquet", {"split": "validation"}),
        ("parquet", {"format": "no_such_format"}),
        ("parquet", {"num_samples": 81}),
        ("parquet", {"num_samples": 81, "order_by": ["id"]}),
        ("parquet", {"num_samples": -1}),
        ("partitioned", {"split_column": "nosuch", "split": "train"}),
        ("no_such_table", {"format": "table"}),
    ],
)
def test_failures_are_loading_errors(spark, dataset, name, options):
    path = name if options.get("format") == "table" else f"{dataset}/{name}"
    with pytest.raises(RuntimeError, match="^Data loading error: "):
        load_split(spark, path, **options)


@pytest.mark.parametrize("n", [None, 0])
def test_no_sample_size_means_all(spark, n):
    rows = spark.range(3)
    assert sample_head(rows, n) is rows


@pytest.mark.parametrize("n", [1, 7, 50, 80])
def test_head_in_file_order(spark, dataset, n):
    rows = spark.read.parquet(f"{dataset}/parquet/train")
    found = head_in_file_order(rows, n)
    order = ["_metadata.file_path", "_metadata.row_index"]
    expected = [r.id for r in rows.orderBy(*order).select("id").collect()][:n]
    assert [r.id for r in found.orderBy(*order).select("id").collect()] == expected
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_sample_by_key(spark, dataset):
    rows = load_split(spark, f"{dataset}/json", format="json", num_samples=30, order_by=["id"])
    assert [r.id for r in rows.orderBy("id").collect()] == list(range(30))


def test_spread(spark, dataset):
    one = spark.range(0, 1000, 1, 1)
    assert spread(one, ["id"]).rdd.getNumPartitions() == 8
    many = spark.range(0, 1000, 1, 8)
    assert spread(many, ["id"]) is many


def test_round_trips(spark, tmp_path):
    rows = spark.range(500).select("id", F.concat(F.lit("a\nb"), "id").alias("text"))
    for format in ("parquet", "json"):
        path = str(tmp_path / format)
        write_rows(rows, path, format)
        write_rows(rows, path, format)
        back = spark.read.schema(rows.schema).format(format).load(path)
        assert sorted(back.collect()) == sorted(rows.collect())


def test_sorted_files(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    write_sorted(rows, path, ["k"], files=5)
    found = (
        spark.read.parquet(path).orderBy("_metadata.file_name", "_metadata.row_index").collect()
    )
    assert [r.k for r in found] == list(range(1000))


def test_dry_run_computes_everything(spark):
    dry_run(spark.range(10))
    with pytest.raises(Exception, match="boom"):
        dry_run(spark.range(10).select(F.raise_error(F.lit("boom"))))


def test_preview(spark, dataset):
    rows, status = preview_dataset(spark, f"{dataset}/parquet", ["id"], num_samples=50)
    assert status == "Dataset Loaded Successfully"
    assert [r.id for r in rows.collect()] == [0, 1, 2, 3, 4]
    rows, status = preview_dataset(spark, f"{dataset}/nowhere", ["id"])
    assert rows.count() == 0 and rows.columns == [] and status.startswith("Error: Data loading error: ")
    assert preview_raw(spark.range(2), ["id"]).count() == 2
    assert [r.id for r in preview_formatted(spark.range(9), ["id"]).collect()] == [0, 1, 2]


def test_table_split_is_not_ignored(spark):
    spark.range(3).createOrReplaceTempView("whole_table")
    with pytest.raises(RuntimeError, match="split_column"):
        load_split(spark, "whole_table", format="table")
    assert load_split(spark, "whole_table", None, format="table").count() == 3


def test_head_of_a_filtered_split(spark, sf_dir):
    rows = load_split(spark, f"{sf_dir}/documents.parquet", "en", split_column="lang", num_samples=150)
    ids = [r["doc_id"] for r in rows.collect()]
    every = spark.read.parquet(f"{sf_dir}/documents.parquet").where("lang = 'en'").orderBy("doc_id").limit(150)
    assert sorted(ids) == [r["doc_id"] for r in every.collect()]


def test_the_input_is_not_written_over(spark, tmp_path):
    path = f"{tmp_path}/some data"
    write_rows(spark.range(3), path)
    rows = spark.read.parquet(path)
    for again in (path, f"file://{path}", f"{path}/", str(tmp_path)):
        with pytest.raises(ValueError, match="read from it"):
            write_rows(rows, again)
    write_rows(rows, f"{path} 2")
    assert spark.read.parquet(path).count() == spark.read.parquet(f"{path} 2").count() == 3


@pytest.mark.parametrize("format", ["json", "csv", "orc"])
def test_head_in_block_order(spark, tmp_path, format):
    path = f"{tmp_path}/a b"
    rows = spark.range(0, 1000, 1, 1).selectExpr("id", "repeat('x', 40) as filler")
    rows.repartitionByRange(4, "id").sortWithinPartitions("id").write.format(format).save(path)
    if format == "orc":
        # A file long after the head that can't be read.
        (tmp_path / "a b" / "zzz.orc").write_bytes(b"not orc")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        for n in (1, 250, 251, 333):
            found = load_split(spark, path, None, format=format, num_samples=n, schema=rows.schema)
            assert sorted(r.id for r in found.collect()) == list(range(n))
        evens = spark.read.format(format).schema(rows.schema).load(path).where("id % 2 = 0")
        assert sorted(r.id for r in sample_head(evens, 200, None, format).collect()) == list(range(0, 400, 2))
        if format != "orc":
            with pytest.raises(RuntimeError, match="fewer rows"):
                load_split(spark, path, None, format=format, num_samples=1001, schema=rows.schema)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_with_bad_records_are_named(spark, tmp_path):
    folder = tmp_path / "some lines"
    folder.mkdir()
    (folder / "a.json").write_text('{"id": 1, "t": "x"}\n{"id": 2, "t": null}\n')
    (folder / "b.json").write_text('{"id": 3, "t": "y"}\n{"id": 4, "t"\n{"id": "many"}\n')
    (folder / "c.json").write_text("")
    schema = "id long, t string"
    found = faulty_files(spark, str(folder), schema=schema).collect()
    assert [(r["file"].rpartition("/")[2], r["rows"], r["bad"]) for r in found] == [("b.json", 3, 2)]
    with pytest.raises(RuntimeError, match=r"^Data loading error: 2 records .*b\.json \(2 of 3\)$"):
        load_split(spark, str(folder), None, format="json", schema=schema, strict=True)
    # Without a schema a value of another type is none that is bad.
    assert [r["bad"] for r in faulty_files(spark, str(folder)).collect()] == [1]
    assert load_split(spark, str(folder), None, format="json", schema=schema).count() == 5
    (folder / "b.json").unlink()
    assert load_split(spark, str(folder), None, format="json", schema=schema, strict=True).count() == 2


def test_csv_records_that_do_not_fit(spark, tmp_path):
    for name, lines in (("a", "id,t\n1,x\n"), ("b", "id,t\nmany,y\n2\n3,z\n4,w,v\n")):
        (tmp_path / f"{name}.csv").write_text(lines)
    found = faulty_files(spark, str(tmp_path), format="csv", schema="id long, t string", header=True).collect()
    assert [(r["file"].rpartition("/")[2], r["rows"], r["bad"]) for r in found] == [("b.csv", 4, 3)]


def test_late_failures_are_loading_errors(spark, tmp_path):
    spark.range(9).write.parquet(f"{tmp_path}/rows")
    (tmp_path / "rows" / "part-zzz.parquet").write_bytes(b"PAR1 but not really PAR1")
    rows = load_split(spark, f"{tmp_path}/rows", None, schema="id long")
    with pytest.raises(RuntimeError, match="^Data loading error: (.|\\n)*part-zzz"):
        with loading_errors():
            rows.collect()
    with pytest.raises(RuntimeError, match="^Data loading error: nothing$"):
        with loading_errors(), loading_errors():
            raise ValueError("nothing")
