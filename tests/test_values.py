"""Text form, truthiness and literals, against Python itself."""

import ast
import datetime as dt
import random
import subprocess
import sys
from decimal import Decimal

import pyspark.sql.types as T
import pytest
from conftest import ROOT
from pyspark.sql import functions as F

from rowscribe.functions.values import (
    default_if_falsy,
    joined_names,
    literal_names,
    py_str,
    truthy,
)

TEXT_CASES = [
    ("string", ["a", "", " ", None, "None", "é\n"]),
    ("boolean", [True, False, None]),
    ("int", [0, -5, None]),
    ("bigint", [2**62, None]),
    (
        "double",
        [900.1, 0.1, 100.0, 1e7, 9999999.9, 1e10, 1.5e16, 1e16, 1e17, 1e-3, 9.99e-4, 1e-4, 1e-5]
        + [1 / 3, -1 / 3, 0.0, -0.0, 1e300, 5e-324, 123456789.123, 2.0**-44, 1e23, None]
        + [float("nan"), float("inf"), float("-inf")],
    ),
    ("date", [dt.date(2001, 1, 1), dt.date(999, 12, 31), None]),
    (
        "timestamp_ntz",
        [
            dt.datetime(2024, 1, 1),
            dt.datetime(2024, 1, 1, 0, 0, 7, 500000),
            dt.datetime(2024, 3, 10, 2, 30, 0, 1),
            None,
        ],
    ),
    ("decimal(10,2)", [Decimal("1.50"), Decimal("0.00"), Decimal("-3.10"), None]),
    ("decimal(12,6)", [Decimal("0.000001"), Decimal("-0.000010"), Decimal("0.000000"), None]),
    (
        "decimal(20,10)",
        [
            Decimal("0.0000010000"),
            Decimal("0.0000009999"),
            Decimal("-0.0000000001"),
            Decimal("0.0000000000"),
            Decimal("-12.5000000000"),
            None,
        ],
    ),
    ("array<int>", [[1, 2], [], None]),
    ("array<string>", [["a", None, "it's"], None]),
    ("struct<a:int,b:string>", [{"a": 1, "b": "x"}, None]),
    ("binary", [b"ab\x00", b"", None]),
]


_STRINGS = ["", "a b", "it's", 'say "x"', """both ' and " """, "back\\slash", "a\nb", "\t", "\x00", "\x7f", "\xa0", "\xad"]
_STRINGS += ["é", "ж", "日本", "한", "😀", "​", "͸", "�", "None", None]
_DOUBLES = [0.0, -0.0, 0.1, -2.5, 1e-3, 9.99e-4, 1e7, 1e16, float("nan"), float("inf"), None]

NESTED_CASES = [
    ("array<string>", [[s] for s in _STRINGS] + [_STRINGS, [], None]),
    ("array<double>", [[d] for d in _DOUBLES] + [_DOUBLES, None]),
    ("array<array<boolean>>", [[[True, None], [], None, [False]], [], None]),
    ("array<float>", [[0.5, None, -3.0]]),
    ("array<date>", [[dt.date(999, 1, 31), None], []]),
    ("array<decimal(10,2)>", [[Decimal("1.50"), Decimal("-0.01"), None], None]),
    ("array<decimal(20,10)>", [[Decimal("0.0000000001"), None]]),
    ("array<timestamp_ntz>", [[dt.datetime(2024, 1, 1, 0, 0, 7)], None]),
    ("array<binary>", [[b"a\x00", None], None]),
    ("struct<`it's`:int,`a b`:string>", [{"it's": 1, "a b": None}, None]),
    (
        "array<struct<a:int,b:struct<c:array<string>,d:double>>>",
        [[{"a": 1, "b": {"c": ["x", "'"], "d": 0.25}}, {"a": None, "b": None}, None], [], None]
        + [[{"a": 2, "b": {"c": ["\n"], "d": 1e20}}]],
    ),
]


def column_of(spark, type_name, values):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {type_name}")
    return rows, F.col("v"), rows.schema["v"].dataType


@pytest.mark.parametrize("type_name, values", TEXT_CASES, ids=[c[0] for c in TEXT_CASES])
def test_py_str(spark, type_name, values):
    rows, v, dtype = column_of(spark, type_name, values)
    found = rows.select("i", py_str(v, dtype).alias("s")).orderBy("i").collect()
    assert [row.s for row in found] == [str(value) for value in values]


@pytest.mark.parametrize("type_name, values", NESTED_CASES, ids=[c[0] for c in NESTED_CASES])
def test_py_str_of_nested_values(spark, type_name, values):
    rows, v, dtype = column_of(spark, type_name, values)
    found = rows.select("i", py_str(v, dtype).alias("s")).orderBy("i").collect()
    assert [row.s for row in found] == [str(value) for value in values]


def test_py_str_of_maps(spark):
    values = [{"a": [1, None]}, {"it's": None, "\n": []}, {}, None]
    rows, v, dtype = column_of(spark, "map<string,array<int>>", values)
    found = rows.select("i", py_str(v, dtype).alias("s")).orderBy("i").collect()
    assert found[0].s == "[('a', [1, None])]" and [row.s for row in found[2:]] == ["[]", "None"]
    assert dict(ast.literal_eval(found[1].s)) == values[1]


def test_plain_nested_values_take_no_python(spark):
    types = ("array<int>", "struct<a:int,b:array<date>>", "map<int,boolean>", "array<decimal(9,2)>")
    for type_name in types:
        rows, v, dtype = column_of(spark, type_name, [None])
        plan = rows.select(py_str(v, dtype))._jdf.queryExecution().executedPlan().toString()
        assert "Arrow" not in plan and "Python" not in plan


def test_strings_taken_as_plain_are_printable_in_python(spark):
    from rowscribe.functions.values import _PLAIN_STRING

    every = [chr(i) for i in range(1, 0x2FFFF) if not 0xD800 <= i <= 0xDFFF]
    rows, v, dtype = column_of(spark, "string", every)
    plain = {row.v for row in rows.where(v.rlike(_PLAIN_STRING)).collect()}
    assert {"a", "é", "ж", "日"} <= plain
    assert all(repr(c) in (f"'{c}'", f'"{c}"') for c in plain)


def test_py_str_of_float_is_that_of_its_double(spark):
    rows, v, dtype = column_of(spark, "float", [0.1, 0.5, None])
    found = rows.select("i", py_str(v, dtype).alias("s")).orderBy("i").collect()
    assert [row.s for row in found] == ["0.10000000149011612", "0.5", "None"]


def test_py_str_of_random_doubles(spark):
    rng = random.Random(1)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-20, 25) for _ in range(20_000)]
    rows, v, dtype = column_of(spark, "double", values)
    found = rows.select("i", py_str(v, dtype).alias("s")).orderBy("i").collect()
    assert [row.s for row in found] == [str(value) for value in values]


def test_py_str_of_nothing(spark):
    rows = spark.range(1).select(F.lit(None).alias("v"))
    assert rows.select(py_str(F.col("v"), T.NullType())).first()[0] == "None"


@pytest.mark.parametrize("type_name, values", TEXT_CASES, ids=[c[0] for c in TEXT_CASES])
def test_truthy(spark, type_name, values):
    rows, v, dtype = column_of(spark, type_name, values)
    found = rows.select("i", truthy(v, dtype).alias("t")).orderBy("i").collect()
    assert [row.t for row in found] == [bool(value) for value in values]


def test_default_if_falsy(spark):
    rows, v, dtype = column_of(spark, "string", ["x", "", None, " "])
    found = rows.select("i", default_if_falsy(v, dtype, "d").alias("s")).orderBy("i").collect()
    assert [row.s for row in found] == ["x", "d", "d", " "]


def expected_names(literal):
    try:
        found = [item["name"] for item in ast.literal_eval(literal)]
        return found if all(isinstance(name, str) for name in found) else []
    except Exception:
        return []


LITERALS = [
    "[{'id': 28, 'name': 'Action'}, {'id': 12, 'name': 'Adventure'}]",
    "[]",
    None,
    "",
    "nan",
    "[{'id': 1}]",
    "[{'id': 1, 'name': 'a'}, {'id': 2}]",
    "[{'id': None, 'name': 'a'}]",
    "[{'id': True, 'name': 'a'}]",
    "{'id': 1, 'name': 'a'}",
    "({'id': 1, 'name': 'a'}, {'id': 2, 'name': 'b'})",
    "[{'id': 1, 'name': 'a'},]",
    "[{'id': 1, 'name': 'a'}] x",
    "[{'id': 1, 'name': 'a'}]\n",
    "[{'id': 1, 'name': 'a'}, ]",
    "[{'id': 1, 'name': 'it\\'s'}]",
    "[{'id': 1, 'name': 'caf\\xe9'}]",
    "[{'id': 1, 'name': \"it's\"}]",
    "[{'id': 1, 'name': 'say \"hi\"'}]",
    "[{'id': 1, 'name': None}]",
    "[{'id': 1, 'name': 7}]",
    "[{'id': 1, 'name': 'a', 'name': 'b'}]",
    " [{'id': 1, 'name': 'a'}]",
    "[{'id': 01, 'name': 'a'}]",
    "[{'name': 'a', 'id': 1}]",
    "[{'id': 1, 'name': 'tab\there'}]",
    "[{'id': 1, 'name': 'nul\x00here'}]",
    "[{'id': 1, 'name': 'é漢😀'}]",
    "[{'id': 1, 'name': ''}]",
    "[{'id': 123456789012345678901234567890, 'name': 'a'}]",
    "[{'id': 1, 'name': \"x 'name': 'y'}\"}, {'id': 2, 'name': 'z'}]",
    "[{'id': 1, 'name': 'a\x85b\u2028c'}]",
    '[{"id": 1, "name": "a"}]',
    "''",
    "{}",
    "[" * 2000,
]


def names_of(spark, literals):
    rows, v, _ = column_of(spark, "string", literals)
    return [row.n for row in rows.select("i", literal_names(v).alias("n")).orderBy("i").collect()]


def test_literal_names(spark):
    assert names_of(spark, LITERALS) == [expected_names(literal) for literal in LITERALS]


def test_literal_names_with_double_quoted_keys(spark):
    literals = [
        '[{"id": 1, "name": "a"}, {"id": 20, "name": "b c"}]',
        """[{"id": 1, "name": "it's"}, {'id': 2, 'name': 'x'}]""",
        """[{"id": 1, "name": "'name': 'y'"}, {"id": 2, "name": "z"}]""",
        """[{"id': 1, "name": "a"}]""",
        '[{"id": 1, "name": "a\\"b"}]',
        '[{"id": 1, "name": 2}]',
    ]
    assert names_of(spark, literals) == [expected_names(literal) for literal in literals]


def test_literal_names_of_random_literals(spark):
    rng = random.Random(7)
    pieces = ["a", "'", '"', "\\", "\\'", "x y", "é", ", ", "}", "]", "\t", "\\n", "{", "\x1f"]

    def name():
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 4)))
        return rng.choice([repr(text), f"'{text}'", f'"{text}"', "None", "3"][: rng.choice([1, 3, 5])])

    def item():
        return rng.choice(
            ["{'id': %d, 'name': %s}", "{'id': %d,'name': %s}", "{'x': %d, 'name': %s}"]
            [: rng.choice([1, 1, 3])]
        ) % (rng.randint(0, 99), name())

    literals = [
        rng.choice(["[%s]", "[%s]", "[%s]", "(%s)", "[%s] "])
        % ", ".join(item() for _ in range(rng.randint(0, 4)))
        for _ in range(5_000)
    ]
    found = names_of(spark, literals)
    expected = [expected_names(literal) for literal in literals]
    assert found == expected
    assert 500 < sum(bool(names) for names in expected) < 4_900


def test_literal_names_of_a_very_long_list(spark):
    names = [f"name {i}" for i in range(200_000)]
    literal = str([{"id": i, "name": name} for i, name in enumerate(names)])
    assert names_of(spark, [literal]) == [names]


def test_joined_names(spark):
    rows, v, _ = column_of(spark, "string", [LITERALS[0], "[]", None])
    found = rows.select("i", joined_names(v).alias("n")).orderBy("i").collect()
    assert [row.n for row in found] == ["Action, Adventure", "", ""]


def test_python_functions_travel_without_the_package(tmp_path):
    """Executors have no copy of this package."""
    script = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession, functions as F
from rowscribe.functions.values import literal_names, py_str
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
rows = spark.createDataFrame([("({{'name': 'a'}},)", 1e20)], "v string, x double")
print(rows.select(literal_names(F.col("v")), py_str(F.col("x"), rows.schema["x"].dataType)).first())
"""
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=300
    )
    assert "['a']" in done.stdout and "'1e+20'" in done.stdout, done.stderr
