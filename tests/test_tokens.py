from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowscribe.operators import tokens as tok
from rowscribe.operators.render import render


def split(text):
    for blank in "\t\r\n":
        text = text.replace(blank, " ")
    return [t for t in text.split(" ") if t]


def ranking(texts, size):
    counts = Counter(t for text in texts if text for t in split(text))
    return sorted(counts.items(), key=lambda item: (-item[1], item[0].encode()))[:size]


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "text")


TEXTS = ["a b", " a\t\tb\r\n", "", " \n ", "a\x0bb\xa0c d", None, "x" * 5000, "a " * 300]


@pytest.mark.parametrize("limit", [None, 1, 2, 250])
def test_tokens(spark, limit):
    table = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    found = table.select("i", tok.tokens(F.col("text"), limit).alias("t")).orderBy("i").collect()
    assert [r.t for r in found] == [None if t is None else split(t)[:limit] for t in TEXTS]


@pytest.mark.parametrize("size", [1, 50, 1000, 10**6])
def test_vocabulary(spark, rows, size):
    found = tok.build_vocabulary(rows, "text", size).frame.orderBy("id").collect()
    expected = ranking([r.text for r in rows.collect()], size)
    assert [(r.token, r["count"]) for r in found] == expected
    assert [r.id for r in found] == list(range(1, len(expected) + 1))


def test_vocabulary_of_nothing(spark):
    table = spark.createDataFrame([(1, None), (2, " ")], "k int, text string")
    vocabulary = tok.build_vocabulary(table, "text", 10)
    assert vocabulary.frame.count() == 0
    found = tok.encode(table, "text", vocabulary).orderBy("k").collect()
    assert [r.token_ids for r in found] == [None, []]


@pytest.mark.parametrize("max_length", [None, 16])
def test_lookup_and_join_agree(spark, rows, max_length):
    vocabulary = tok.build_vocabulary(rows, "text", 300)
    looked_up = tok.encode_by_lookup(rows, "text", vocabulary, max_length)
    joined = tok.encode_by_join(rows, "text", vocabulary, max_length)
    found = sorted(looked_up.collect())
    assert found == sorted(joined.collect())
    ids = {token: i for i, (token, _) in enumerate(ranking([r.text for r in found], 300), 1)}
    for row in found:
        assert row.token_ids == [ids.get(t, 0) for t in split(row.text)[:max_length]]


def test_lookup_and_join_agree_on_odd_rows(spark):
    table = spark.createDataFrame(
        [(None, "a b"), (None, "b"), (1, "a"), (1, "b c"), (1, "a"), (2, None), (3, " "), (4, "")],
        "k int, text string",
    )
    vocabulary = tok.build_vocabulary(table, "text", 2)
    looked_up = tok.encode_by_lookup(table, "text", vocabulary, None)
    joined = tok.encode_by_join(table, "text", vocabulary, None)
    assert joined.columns == looked_up.columns
    assert sorted(map(str, joined.collect())) == sorted(map(str, looked_up.collect()))


def test_long_tokens(spark):
    texts = ["x" * 64, "x" * 65, "x" * 70_000 + " y", "x" * 70_001, "é" * 33]
    table = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    vocabulary = tok.build_vocabulary(table.where("k <> 3"), "text", 10)
    looked_up = tok.encode_by_lookup(table, "text", vocabulary, None)
    assert sorted(looked_up.collect()) == sorted(
        tok.encode_by_join(table, "text", vocabulary, None).collect()
    )
    assert [r.token_ids for r in looked_up.orderBy("k").collect()] == [[1], [2], [3, 4], [0], [5]]


def test_large_vocabularies_are_joined(spark, rows, monkeypatch):
    monkeypatch.setattr(tok, "LOOKUP_LIMIT", 10)
    vocabulary = tok.build_vocabulary(rows, "text", 300)
    encoded = tok.encode(rows, "text", vocabulary)
    assert "Join" in encoded._jdf.queryExecution().optimizedPlan().toString()


def test_vocabulary_is_not_copied_into_rows(spark, rows):
    vocabulary = tok.build_vocabulary(rows, "text", 300)
    prompts = render(rows.withColumnRenamed("text", "prompt").withColumn("answer", F.col("prompt")), eos="")
    for table in (rows, prompts, rows.withColumn("text", F.upper("text"))):
        encoded = tok.encode(table, "text", vocabulary)
        plan = encoded._jdf.queryExecution().optimizedPlan().toString()
        assert "_maps" not in plan and "Join" not in plan.split("transform")[0]


def test_labels_mask_the_prompt(spark):
    table = spark.createDataFrame(
        [(1, "how are you", "fine thanks"), (2, " ", ""), (3, "a b c d e f", "g")],
        "k int, instruction string, output string",
    )
    rows = render(table, eos=" </s>", parts=True)
    vocabulary = tok.build_vocabulary(rows, "text", 100)
    for length in (None, 8, 1):
        for row in tok.encode_with_labels(rows, vocabulary, length).collect():
            asked = len(split(row.prompt_text))
            assert len(row.labels) == len(row.token_ids)
            assert row.labels == [
                -100 if i < asked else t for i, t in enumerate(row.token_ids)
            ]


def test_ready_text_is_learned_whole(spark):
    table = spark.createDataFrame([(1, "a b a")], "k int, text string")
    vocabulary = tok.build_vocabulary(table, "text", 1)
    row = tok.encode_with_labels(table, vocabulary).first()
    assert row.labels == row.token_ids == [1, 0, 1]


def test_columns_of_the_caller_stay(spark):
    rows = spark.createDataFrame([("a b a", 1), (None, 2), ("", 3)], "text string, _tokens int").selectExpr(
        "*", "4 as _maps", "5 as _digest", "6 as _entries", "7 as _known", "8 as _cold"
    )
    vocabulary = tok.build_vocabulary(rows, "text", 10)
    for encode in (tok.encode_by_lookup, tok.encode_by_join):
        found = encode(rows, "text", vocabulary, None)
        assert found.columns == [*rows.columns, "token_ids"]
        assert sorted((r["_tokens"], r["_maps"], r["_cold"], r.token_ids) for r in found.collect()) == [
            (1, 4, 8, [1, 2, 1]), (2, 4, 8, None), (3, 4, 8, [])
        ]


def test_size_bounds_what_is_looked_up(spark):
    rows = spark.createDataFrame([("a a a b b c",)], "text string")
    whole = tok.build_vocabulary(rows, "text", 10)
    cut = tok.Vocabulary(whole.frame, 2)
    for encode in (tok.encode_by_lookup, tok.encode_by_join):
        assert encode(rows, "text", cut, None).first().token_ids == [1, 1, 1, 2, 2, 0]


def test_hot_tokens_are_not_joined(spark, monkeypatch):
    monkeypatch.setattr(tok, "HOT_TOKENS", 3)
    rows = spark.range(60).selectExpr("concat('the of and the w', id, ' rare', id % 7, ' the') as text")
    vocabulary = tok.build_vocabulary(rows, "text", 30)
    wanted = sorted(tok.encode_by_lookup(rows, "text", vocabulary, None).collect())
    assert sorted(tok.encode_by_join(rows, "text", vocabulary, None).collect()) == wanted


def test_ranking_by_many_tasks(spark, monkeypatch):
    rows = spark.range(4000).selectExpr("concat('t', id % 900, ' ', id % 30, ' é', id % 401) as text")
    together = tok.build_vocabulary(rows, "text", 700).frame.orderBy("id").collect()
    monkeypatch.setattr(tok, "RANKED_TOGETHER", 0)
    assert tok.build_vocabulary(rows, "text", 700).frame.orderBy("id").collect() == together


@pytest.mark.parametrize("max_length", [None, 0, 1, 3])
def test_join_runs_no_expression_for_each_token(spark, monkeypatch, max_length):
    monkeypatch.setattr(tok, "HOT_TOKENS", 2)
    long = "é" * 40
    texts = [*TEXTS, "a a b b c " * 3, f"{long} a {long}x c", "d\te\rf\ng", "a b", None, "日本 a\xa0b 日本"]
    table = spark.createDataFrame([(None if i == 3 else i, t) for i, t in enumerate(texts)], "k int, text string").repartition(3)
    vocabulary = tok.build_vocabulary(spark.createDataFrame([(t,) for t in texts + [long] * 9], "text string"), "text", 7)
    joined = tok.encode_by_join(table, "text", vocabulary, max_length)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan
    key = lambda r: (str(r.k), r.text or "", r.token_ids or [])
    found = sorted(joined.collect(), key=key)
    ids = {token: i for i, (token, _) in enumerate(ranking(texts + [long] * 9, 7), 1)}
    assert [r.token_ids for r in found] == [None if r.text is None else [ids.get(t, 0) for t in split(r.text)[:max_length]] for r in found]
    assert found == sorted(tok.encode_by_lookup(table, "text", vocabulary, max_length).collect(), key=key)
