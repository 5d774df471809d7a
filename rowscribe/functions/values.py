"""Python semantics for single values, as Spark column expressions.

The formats this library renders are defined by Python string formatting, so
a value's text form, its truthiness and its literal syntax follow Python.
Common values stay in the JVM. The few that Spark prints differently go
through an Arrow function, which receives null for every row that is already
settled (Spark evaluates a Python function for all rows, whatever ``when``
says).

The Arrow functions are defined inside other functions on purpose: they are
then shipped by value and executors need no installed copy of this package.
"""

from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowscribe.functions import fixed

# Decimals with more decimal places than this have an exponent in Python where
# they are 0 or below 1e-6.
_PLAIN_SCALE = 6
# Doubles of this magnitude have one text form in Spark and Python.
_PLAIN_FROM = 1e-3
_PLAIN_BELOW = 1e7

# Strings that Python shows as they are, but for the choice of quotes: ASCII without
# the backslash, Latin, Greek accents, Cyrillic, kana, common Han and Hangul.
_PLAIN_STRING = (
    r"\A[\x20-\x5b\x5d-\x7e\u00a1-\u00ac\u00ae-\u0377\u0400-\u052f"
    r"\u3041-\u3096\u30a1-\u30ff\u4e00-\u9fa5\uac00-\ud7a3]*+\z"
)

# The common shape of a literal list of names. Possessive repetition keeps the
# regex engine from recursing once per element on long lists.
_PLAIN_NAME_LIST = (
    r"\A\[(?:\{(?:'id'|\"id\"): (?:0|[1-9][0-9]{0,17}), (?:'name'|\"name\"): "
    r"""(?:'[^'"\\\x00-\x1f]*+'|"[^"\\\x00-\x1f]*+")\}"""
    r"(?:, (?=\{)|(?=\])))*+\]\z"
)
# Exact for that shape only: each match starts at an item's own name and takes
# all of it, so text inside a name is never taken for another item.
_PLAIN_NAME = r"""(?s)(?:'name'|"name"): (['"])(.*?)\1"""


def py_str(value: Column, dtype: T.DataType) -> Column:
    """Python ``str(value)``; null becomes ``None``. Never null itself."""
    none = F.lit(fixed.PY_NONE)
    if isinstance(dtype, T.NullType):
        return none
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return F.coalesce(value, none)
    if isinstance(dtype, T.BooleanType):
        return (
            F.when(value, F.lit(fixed.PY_TRUE))
            .when(~value, F.lit(fixed.PY_FALSE))
            .otherwise(none)
        )
    if isinstance(dtype, (T.IntegralType, T.DateType)):
        return F.coalesce(value.cast("string"), none)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        # Python prints either no fraction or all six digits of it.
        shown = value.cast("string")
        padded = F.when(F.contains(shown, F.lit(".")), F.rpad(shown, 26, "0"))
        return F.coalesce(padded, shown, none)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        number = value.cast("double")
        plain = (number == 0.0) | (
            (F.abs(number) >= _PLAIN_FROM) & (F.abs(number) < _PLAIN_BELOW)
        )
        rare = _python_text()(F.when(~plain, number))
        return F.coalesce(F.when(plain, number.cast("string")), rare, none)
    if isinstance(dtype, T.DecimalType):
        if dtype.scale <= _PLAIN_SCALE:
            return F.coalesce(value.cast("string"), none)
        plain = F.abs(value) >= F.lit(10.0**-_PLAIN_SCALE).cast(dtype)
        rare = _python_text()(F.when(~plain, value))
        return F.coalesce(F.when(plain, value.cast("string")), rare, none)
    literal = _literal(value, dtype) if isinstance(dtype, _NESTED) else None
    if literal is None:
        return F.coalesce(_python_text()(value), none)
    text, exact = literal
    if exact is None:
        return text
    return F.coalesce(F.when(exact, text), _python_text()(F.when(~exact, value)), none)


_NESTED = (T.ArrayType, T.StructType, T.MapType)


def _literal(value: Column, dtype: T.DataType) -> tuple[Column, Column | None] | None:
    """Python ``repr(value)``, and where that is exact: None for everywhere.

    Lists are shown with brackets, structs as dictionaries and maps as lists of pairs. The
    first column is never null; the second one is true for null. None for types
    that hold something whose text is made in Python only.
    """
    none = F.lit(fixed.PY_NONE)
    if isinstance(dtype, (T.NullType, T.BooleanType, T.IntegralType)):
        return py_str(value, dtype), None
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        single, double = F.lit("'"), F.lit('"')
        shown = (
            F.when(~F.contains(value, single), F.concat(single, value, single))
            .when(~F.contains(value, double), F.concat(double, value, double))
            .otherwise(F.concat(single, F.replace(value, single, F.lit("\\'")), single))
        )
        return F.coalesce(shown, none), value.isNull() | value.rlike(_PLAIN_STRING)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        number = value.cast("double")
        plain = (F.abs(number) >= _PLAIN_FROM) & (F.abs(number) < _PLAIN_BELOW)
        return F.coalesce(number.cast("string"), none), value.isNull() | (number == 0.0) | plain
    if isinstance(dtype, T.DecimalType) and dtype.scale <= _PLAIN_SCALE:
        shown = F.concat(F.lit("Decimal('"), value.cast("string"), F.lit("')"))
        return F.coalesce(shown, none), None
    if isinstance(dtype, T.DateType):
        numbers = F.concat_ws(", ", F.year(value), F.month(value), F.day(value))
        shown = F.concat(F.lit("datetime.date("), numbers, F.lit(")"))
        return F.when(value.isNotNull(), shown).otherwise(none), None
    if isinstance(dtype, T.ArrayType):
        return _list(value, lambda item: _literal(item, dtype.elementType))
    if isinstance(dtype, T.MapType):

        def pair(entry):
            key, held = entry.getField("key"), entry.getField("value")
            return _joined("(", [_literal(key, dtype.keyType), _literal(held, dtype.valueType)], ")")

        return _list(F.map_entries(value), pair)
    if isinstance(dtype, T.StructType) and len({name.lower() for name in dtype.names}) == len(dtype.names):
        fields = [_literal(value.getField(f.name), f.dataType) for f in dtype]
        found = _joined("{", fields, "}", [f"{name!r}: " for name in dtype.names])
        if found is None:
            return None
        text, exact = found
        shown = F.when(value.isNull(), none).otherwise(text)
        return shown, None if exact is None else value.isNull() | exact
    return None


def _list(items: Column, show) -> tuple[Column, Column | None] | None:
    """The literal of a list of which ``show`` gives that of an item."""
    of_any = show(F.col("item"))
    if of_any is None:
        return None
    shown = F.array_join(F.transform(items, lambda item: show(item)[0]), ", ")
    text = F.coalesce(F.concat(F.lit("["), shown, F.lit("]")), F.lit(fixed.PY_NONE))
    if of_any[1] is None:
        return text, None
    return text, items.isNull() | F.forall(items, lambda item: show(item)[1])


def _joined(start: str, parts: list, end: str, before: list[str] | None = None):
    """Literals between marks, each with what is before it; None if one of them is."""
    if any(part is None for part in parts):
        return None
    before = before or [""] * len(parts)
    shown = [F.concat(F.lit(b), text) for b, (text, _) in zip(before, parts)]
    bounds = [exact for _, exact in parts if exact is not None]
    text = F.concat(F.lit(start), F.concat_ws(", ", *shown), F.lit(end))
    return text, reduce(and_, bounds) if bounds else None


def truthy(value: Column, dtype: T.DataType) -> Column:
    """Python ``bool(value)``. Never null; blank strings and NaN are true."""
    if isinstance(dtype, T.NullType):
        return F.lit(False)
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return F.coalesce(value, F.lit("")) != ""
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(value, F.lit(False))
    if isinstance(dtype, T.NumericType):
        return value.isNotNull() & (value != 0)
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return value.isNotNull() & (F.size(value) > 0)
    if isinstance(dtype, T.BinaryType):
        return value.isNotNull() & (F.octet_length(value) > 0)
    return value.isNotNull()


def default_if_falsy(value: Column, dtype: T.DataType, default: str) -> Column:
    """Text form of ``value``, or ``default`` where it is falsy."""
    return F.when(truthy(value, dtype), py_str(value, dtype)).otherwise(F.lit(default))


def literal_names(value: Column) -> Column:
    """``name`` of every item of a Python-literal list of dicts held in a string.

    Anything that is not such a list gives an empty array, and so does null.
    A list holding a name that is not a string also counts as unreadable,
    because its names could not be joined.
    """
    plain = F.coalesce(value.rlike(_PLAIN_NAME_LIST), F.lit(False))
    native = F.regexp_extract_all(F.when(plain, value), F.lit(_PLAIN_NAME), F.lit(2))
    rare = _python_names()(F.when(~plain, value))
    return F.coalesce(native, rare, F.array().cast("array<string>"))


def joined_names(value: Column) -> Column:
    """The names of :func:`literal_names`, joined by comma and blank."""
    return F.array_join(literal_names(value), fixed.NAME_SEPARATOR)


def _python_text():
    @F.arrow_udf("string")
    def python_text(values: pa.Array) -> pa.Array:
        return pa.array(
            [None if v is None else str(v) for v in values.to_pylist()], pa.string()
        )

    return python_text


def _python_names():
    @F.arrow_udf("array<string>")
    def python_names(values: pa.Array) -> pa.Array:
        import ast
        import warnings

        def names(literal):
            try:
                found = [item["name"] for item in ast.literal_eval(literal)]
                "".join(found).encode()
                return found
            except Exception:
                return []

        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            return pa.array(
                [None if v is None else names(v) for v in values.to_pylist()],
                pa.list_(pa.string()),
            )

    return python_names
