"""Which column holds what. Works on column names only, so it starts no job."""

import logging
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowscribe.functions import fixed

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class ColumnMapping:
    """The column chosen for each part of a training row; None where unused."""

    text: str | None = None
    chat: str | None = None
    instruction: str | None = None
    output: str | None = None
    input: str | None = None


def first_present(columns: Iterable[str], candidates: Sequence[str]) -> str | None:
    """First candidate that is a column, by exact and case-sensitive name."""
    present = set(columns)
    return next((name for name in candidates if name in present), None)


def detect_columns(columns: Sequence[str], text_column: str | None = None) -> ColumnMapping:
    """Detect ready text, else a chat, else instruction and output.

    ``text_column`` names the ready text explicitly. If instruction or output
    is not found, both are taken by position.
    """
    if text_column is not None:
        _require([text_column], columns)
        return ColumnMapping(text=text_column)
    if text := first_present(columns, fixed.TEXT_COLUMNS):
        return ColumnMapping(text=text)
    if chat := first_present(columns, fixed.CHAT_COLUMNS):
        return ColumnMapping(chat=chat)

    instruction = first_present(columns, fixed.INSTRUCTION_COLUMNS)
    output = first_present(columns, fixed.OUTPUT_COLUMNS)
    if not (instruction and output):
        logger.warning("No standard column names; using columns 0 and 1 as instruction and output.")
        instruction, output = _leading(columns)
    return ColumnMapping(
        instruction=instruction,
        output=output,
        input=first_present(columns, fixed.INPUT_COLUMNS),
    )


def force_instruction(mapping: ColumnMapping, columns: Sequence[str]) -> ColumnMapping:
    """Turn a text or chat mapping into an instruction one, by position."""
    if mapping.instruction is not None:
        return mapping
    instruction, output = _leading(columns)
    return ColumnMapping(
        instruction=instruction,
        output=output,
        input=columns[2] if len(columns) > 2 else None,
    )


def report_columns(spark: SparkSession, mapping: ColumnMapping) -> DataFrame:
    """The mapping as a table with one row per part."""
    rows = [(part.name, getattr(mapping, part.name)) for part in fields(mapping)]
    return spark.createDataFrame(rows, "part string, column_name string")


def column(df: DataFrame, name: str) -> Column:
    """A column by exact name; dots and back-ticks in it are taken literally."""
    _require([name], df.columns)
    return F.col(quoted(name))


def column_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def optional_column(df: DataFrame, name: str) -> tuple[Column, T.DataType]:
    """A column and its type; one that does not exist reads as null."""
    if name in df.columns:
        return column(df, name), column_type(df, name)
    return F.lit(None).cast("string"), T.NullType()


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    """One error naming every missing column."""
    _require(names, df.columns)


def rename_to_text(df: DataFrame, name: str) -> DataFrame:
    """Call the ready text column ``text``; the others stay as they are."""
    if name == "text":
        return df
    require_columns(df, [name])
    _reject_collision(df, "text", besides=name)
    if "text" in df.columns:
        raise ValueError(f"cannot rename {name!r}: a column 'text' exists already")
    return df.withColumnRenamed(name, "text")


def with_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add or overwrite a column, without touching one that differs by case."""
    return with_columns(df, {name: value})


def with_columns(df: DataFrame, added: dict[str, Column]) -> DataFrame:
    """Add or overwrite several columns, all computed from those of ``df``."""
    for name in added:
        _reject_collision(df, name)
    return df.withColumns(added)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added to those that a column has, in whatever case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def reject_taken(df: DataFrame, *names: str) -> None:
    """An error where a column to be added is there already, in whatever case."""
    if taken := [c for c in df.columns if c.lower() in {name.lower() for name in names}]:
        raise ValueError(f"the table has columns named like those to be added: {taken}")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _leading(columns: Sequence[str]) -> tuple[str, str]:
    if len(columns) < 2:
        raise ValueError(f"need two columns for instruction and output, have {list(columns)}")
    return columns[0], columns[1]


def _require(names: Iterable[str], columns: Sequence[str]) -> None:
    missing = [name for name in names if name not in columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {list(columns)}")


def _reject_collision(df: DataFrame, name: str, besides: str | None = None) -> None:
    if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true":
        return
    alike = [c for c in df.columns if c.lower() == name.lower() and c not in (name, besides)]
    if alike:
        raise ValueError(f"writing column {name!r} would replace {alike}, which differ only by case")
