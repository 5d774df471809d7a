import pytest
from pyspark.sql import functions as F

from rowscribe.operators.chat import (
    CHATML,
    ChatTemplate,
    assemble_chats,
    from_sharegpt,
    generation_prompt,
    render_chat,
    strip_special,
)
from rowscribe.operators.columns import ColumnMapping
from rowscribe.operators.render import (
    instruction_prompt,
    render,
    render_instruction,
    render_movie,
    text_only,
)

TURNS = "array<struct<role:string,content:string>>"


def texts(df):
    return [row.text for row in df.collect()]


def test_instruction_shapes(spark):
    rows = spark.createDataFrame(
        [("q", "a", "c"), ("q", "a", ""), ("q", None, None), (None, "a", " ")],
        "instruction string, output string, input string",
    )
    assert texts(render(rows, eos="<e>")) == [
        "### Instruction:\nq\n\n### Input:\nc\n\n### Response:\na<e>",
        "### Instruction:\nq\n\n### Response:\na<e>",
        "### Instruction:\nq\n\n### Response:\nNone<e>",
        "### Instruction:\nNone\n\n### Input:\n \n\n### Response:\na<e>",
    ]


def test_instruction_of_other_types(spark):
    rows = spark.createDataFrame([(1, 2.5, 0), (2, 1e20, 3)], "prompt int, answer double, context int")
    assert texts(render(rows, eos="")) == [
        "### Instruction:\n1\n\n### Response:\n2.5",
        "### Instruction:\n2\n\n### Input:\n3\n\n### Response:\n1e+20",
    ]


def test_same_cell_twice(spark):
    rows = spark.createDataFrame([("x", "y")], "input string, output string")
    assert texts(render(rows, eos="")) == [
        "### Instruction:\nx\n\n### Input:\nx\n\n### Response:\ny"
    ]


def test_forced_instruction_overwrites_text(spark):
    rows = spark.createDataFrame([("a", "b", "c")], "lang string, text string, source string")
    out = render(rows, "alpaca", eos="", parts=True)
    row = out.first()
    assert row.text == "### Instruction:\na\n\n### Input:\nc\n\n### Response:\nb"
    assert row.prompt_text + row.completion_text == row.text
    assert out.columns == ["lang", "text", "source", "prompt_text", "completion_text"]


def test_eos_is_required(spark):
    rows = spark.createDataFrame([("a", "b")], "instruction string, output string")
    with pytest.raises(ValueError, match="eos"):
        render(rows)
    with pytest.raises(ValueError, match="missing"):
        render_instruction(rows, ColumnMapping(instruction="instruction", output="x"), "")


def test_unknown_style(spark):
    with pytest.raises(ValueError, match="style"):
        render(spark.range(1), "alpacca")


MOVIE = {
    "title": "T",
    "tagline": "G",
    "overview": "O",
    "genres": "[{'id': 1, 'name': 'A'}, {'id': 2, 'name': 'B'}]",
    "keywords": "[{'name': 'k'}]",
    "vote_average": 7.0,
    "vote_count": 12,
    "popularity": 2e10,
    "release_date": "2001-01-01",
    "runtime": 90.0,
}
MOVIE_SCHEMA = (
    "title string, tagline string, overview string, genres string, keywords string, "
    "vote_average double, vote_count bigint, popularity double, release_date string, runtime double"
)


def movie_text(tagline, overview, genres, rest):
    return (
        "### Instruction:\nGenerate a persuasive movie recommendation for a user. Highlight why "
        "they should watch the movie using its genre, themes, storyline, and popularity.\n\n"
        f"### Movie Metadata:\nTitle: T\nTagline: {tagline}\nOverview: {overview}\n"
        f"Genres: {genres}\n{rest}\n\n### Response:\nHere’s why you might enjoy this movie:\n"
    )


def test_movie(spark):
    empty = MOVIE | {
        "tagline": None,
        "overview": "",
        "genres": None,
        "keywords": "nan",
        "vote_average": None,
        "popularity": 0.5,
        "runtime": None,
    }
    rows = spark.createDataFrame(
        [tuple(MOVIE.values()), tuple(empty.values())], MOVIE_SCHEMA
    )
    full_rest = (
        "Keywords: k\nVote Average: 7.0\nVote Count: 12\nPopularity: 20000000000.0\n"
        "Release Date: 2001-01-01\nRuntime: 90.0 minutes"
    )
    empty_rest = (
        "Keywords: \nVote Average: None\nVote Count: 12\nPopularity: 0.5\n"
        "Release Date: 2001-01-01\nRuntime: None minutes"
    )
    assert texts(render(rows, "movie_recommender", eos="<e>")) == [
        movie_text("G", "O", "A, B", full_rest) + "<e>",
        movie_text("", "No overview available.", "", empty_rest) + "<e>",
    ]
    no_tagline = render_movie(rows.drop("tagline").limit(1), eos="")
    assert texts(no_tagline) == [movie_text("", "O", "A, B", full_rest)]
    with pytest.raises(ValueError, match=r"\['overview', 'runtime'\]"):
        render_movie(rows.drop("overview", "runtime"), eos="")


def test_ready_text_is_left_alone(spark):
    rows = spark.createDataFrame([("x", 1)], "content string, n int")
    out = render(rows, "chat", eos="<e>")
    assert out.columns == ["text", "n"] and texts(out) == ["x"]


def chat_rows(spark, *chats):
    return spark.createDataFrame([(chat,) for chat in chats], f"messages {TURNS}")


def test_chat(spark):
    rows = chat_rows(
        spark,
        [("system", "s"), ("user", "u"), ("assistant", "a")],
        [("user", "u")],
        [],
        None,
        [("user", None), ("assistant", "a")],
        [("tool", "t")],
        [None],
    )
    assert texts(render(rows)) == [
        "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu<|im_end|>\n"
        "<|im_start|>assistant\na<|im_end|>\n<|im_end|>",
        "<|im_start|>user\nu<|im_end|>\n<|im_end|>",
        "<|im_end|>",
        None,
        None,
        "<|im_start|>tool\nt<|im_end|>\n<|im_end|>",
        None,
    ]


def test_other_template(spark):
    template = ChatTemplate("[", ":", "]", "[assistant:", "</s>", ("[", "]", "</s>"))
    rows = chat_rows(spark, [("user", "u")])
    assert texts(render(rows, template=template)) == ["[user:u]</s>"]
    found = rows.select(
        strip_special(render_chat(F.col("messages"), template), template).alias("text"),
        generation_prompt(F.lit("q"), template).alias("prompt"),
    ).first()
    assert found.text == "user:u" and found.prompt == "[user:q][assistant:"


def test_chat_column_must_exist_and_hold_turns(spark):
    pairs = spark.createDataFrame([("q", "a")], "instruction string, output string")
    with pytest.raises(ValueError, match="missing"):
        render(pairs, "chat")
    with pytest.raises(ValueError, match="turns"):
        render(spark.createDataFrame([("x",)], "messages string"))


def test_sharegpt(spark):
    schema = "conversations array<struct<from:string,value:string>>"
    rows = spark.createDataFrame([([("human", "h"), ("gpt", "g"), ("system", "s"), (None, "n")],)], schema)
    turns = rows.select(from_sharegpt(F.col("conversations"))).first()[0]
    assert [tuple(t) for t in turns] == [
        ("user", "h"),
        ("assistant", "g"),
        ("system", "s"),
        (None, "n"),
    ]
    known = rows.select(F.slice("conversations", 1, 2).alias("conversations"))
    assert texts(render(known, "sharegpt")) == [
        "<|im_start|>user\nh<|im_end|>\n<|im_start|>assistant\ng<|im_end|>\n<|im_end|>"
    ]


def test_prompts(spark):
    row = spark.range(1).select(
        instruction_prompt(F.lit("q"), "P ").alias("i"), generation_prompt(F.lit("q")).alias("c")
    ).first()
    assert row.i == "P ### Instruction:\nq\n\n### Response:\n"
    assert row.c == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n"


def test_prompts_of_null_and_of_numbers(spark):
    rows = spark.createDataFrame([(None, 2.5)], "q string, n double")
    number = rows.schema["n"].dataType
    row = rows.select(
        instruction_prompt(F.col("q")).alias("i"),
        generation_prompt(F.col("q")).alias("c"),
        instruction_prompt(F.col("n"), dtype=number).alias("n"),
    ).first()
    assert row.i == "### Instruction:\nNone\n\n### Response:\n"
    assert row.c == "<|im_start|>user\nNone<|im_end|>\n<|im_start|>assistant\n"
    assert row.n == "### Instruction:\n2.5\n\n### Response:\n"


def test_stripping_keeps_the_content(spark):
    rows = chat_rows(spark, [("user", "a <| b |> im_end")])
    out = rows.select(strip_special(render_chat(F.col("messages"))).alias("text"))
    assert texts(out) == ["user\na <| b |> im_end\n"]


def test_long_chats_are_one_row(spark):
    turns = spark.range(6000).select(
        (F.col("id") % 2).alias("conv_id"),
        F.expr("id * 1000000").alias("turn"),
        F.lit("user").alias("role"),
        F.concat(F.lit("t"), "id").alias("text"),
    )
    rows = assemble_chats(turns).select("conv_id", render_chat(F.col("messages")).alias("text"))
    found = {row.conv_id: row.text for row in rows.collect()}
    for chat in (0, 1):
        expected = "".join(f"<|im_start|>user\nt{i}<|im_end|>\n" for i in range(chat, 6000, 2))
        assert found[chat] == expected + "<|im_end|>"


def test_text_only_prunes_the_scan(spark, sf_dir):
    rows = render(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    plan = text_only(rows)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string>" in plan


def test_no_python_for_strings(spark):
    rows = spark.createDataFrame([("q", "a")], "instruction string, output string")
    plan = render(rows, eos="")._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan
    chats = render(chat_rows(spark, [("user", "u")]))
    assert "EvalPython" not in chats._jdf.queryExecution().executedPlan().toString()


def test_default_template_is_chatml():
    assert (CHATML.eos, CHATML.turn_end) == ("<|im_end|>", "<|im_end|>\n")
