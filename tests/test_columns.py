import pytest
from pyspark.sql import functions as F

from rowscribe.operators.columns import (
    ColumnMapping,
    column,
    detect_columns,
    first_present,
    force_instruction,
    optional_column,
    rename_to_text,
    report_columns,
    require_columns,
    with_column,
)


@pytest.mark.parametrize(
    "columns, expected",
    [
        (["text", "messages"], ColumnMapping(text="text")),
        (["full_text", "content"], ColumnMapping(text="content")),
        (["instruction", "output", "full_text"], ColumnMapping(text="full_text")),
        (["chat", "messages", "conversations"], ColumnMapping(chat="conversations")),
        (["chat", "output", "instruction"], ColumnMapping(chat="chat")),
        (
            ["answer", "context", "question"],
            ColumnMapping(instruction="question", output="answer", input="context"),
        ),
        (
            ["input_text", "prompt", "completion", "response"],
            ColumnMapping(instruction="prompt", output="response"),
        ),
        # No instruction: both by position, the input match stays.
        (
            ["input", "output"],
            ColumnMapping(instruction="input", output="output", input="input"),
        ),
        (["a", "instruction"], ColumnMapping(instruction="a", output="instruction")),
        (["Text", "x"], ColumnMapping(instruction="Text", output="x")),
        (["background", "b", "c"], ColumnMapping("", "", "background", "b", "background")),
    ],
)
def test_detect(columns, expected):
    found = detect_columns(columns)
    assert [found.text or "", found.chat or ""] == [expected.text or "", expected.chat or ""]
    assert (found.instruction, found.output, found.input) == (
        expected.instruction,
        expected.output,
        expected.input,
    )


@pytest.mark.parametrize("columns", [["only"], []])
def test_too_few_columns(columns):
    with pytest.raises(ValueError, match="two columns"):
        detect_columns(columns)
    with pytest.raises(ValueError, match="two columns"):
        force_instruction(ColumnMapping(text="only"), columns)


def test_explicit_text_column():
    assert detect_columns(["text", "body"], "body") == ColumnMapping(text="body")
    with pytest.raises(ValueError, match="missing columns"):
        detect_columns(["text"], "body")


def test_first_present_follows_the_candidates():
    assert first_present(["b", "a"], ["a", "b"]) == "a"
    assert first_present(["A"], ["a"]) is None


def test_force_instruction():
    forced = force_instruction(ColumnMapping(text="text"), ["a", "text", "c", "d"])
    assert forced == ColumnMapping(instruction="a", output="text", input="c")
    two = force_instruction(ColumnMapping(chat="chat"), ["chat", "b"])
    assert two == ColumnMapping(instruction="chat", output="b")
    kept = ColumnMapping(instruction="x", output="y")
    assert force_instruction(kept, ["a", "b"]) is kept


def test_report(spark):
    rows = report_columns(spark, ColumnMapping(instruction="q", output="a"))
    assert {tuple(r) for r in rows.collect()} == {
        ("text", None),
        ("chat", None),
        ("instruction", "q"),
        ("output", "a"),
        ("input", None),
    }


def test_names_with_dots_and_ticks(spark):
    rows = spark.range(1).select(F.lit("x").alias("a.b"), F.lit("y").alias("c`d"))
    assert rows.select(column(rows, "a.b"), column(rows, "c`d")).first()[:] == ("x", "y")


def test_names_are_exact(spark):
    rows = spark.range(1).select(F.lit("x").alias("Text"))
    with pytest.raises(ValueError, match="missing"):
        column(rows, "text")


def test_optional_column(spark):
    rows = spark.range(1).select(F.lit("x").alias("a"))
    assert rows.select(optional_column(rows, "a")[0]).first()[0] == "x"
    assert rows.select(optional_column(rows, "b")[0]).first()[0] is None


def test_all_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match=r"\['x', 'y'\]"):
        require_columns(spark.range(1), ["x", "id", "y"])


def test_rename(spark):
    rows = spark.range(1).select(F.lit("x").alias("content"), "id")
    assert rename_to_text(rows, "content").columns == ["text", "id"]
    same = rows.withColumnRenamed("content", "text")
    assert rename_to_text(same, "text") is same
    with pytest.raises(ValueError, match="exists"):
        rename_to_text(rows.withColumn("text", F.lit("y")), "content")


def test_columns_that_differ_by_case_only(spark):
    rows = spark.range(1).select(F.lit("x").alias("content"), F.lit("y").alias("Text"))
    with pytest.raises(ValueError, match="case"):
        rename_to_text(rows, "content")
    with pytest.raises(ValueError, match="case"):
        with_column(rows, "text", F.lit("z"))
    assert rename_to_text(rows.select("Text"), "Text").columns == ["text"]
