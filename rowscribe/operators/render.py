"""Render rows into one training string."""

import logging
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowscribe.functions import fixed
from rowscribe.functions.values import default_if_falsy, joined_names, py_str, truthy
from rowscribe.operators.chat import CHATML, ChatTemplate, normalize_turns, render_chat
from rowscribe.operators.columns import (
    ColumnMapping,
    column,
    column_type,
    detect_columns,
    force_instruction,
    optional_column,
    rename_to_text,
    require_columns,
    with_column,
    with_columns,
)

logger = logging.getLogger(__name__)

INSTRUCTION = "alpaca"
MOVIE = "movie_recommender"
CHAT = "chat"
#: Styles that leave the choice to the detected columns.
DETECTED = ("auto", "text", "chatml", "sharegpt")

_MOVIE_FIELDS = [field for _, field, _, _ in string.Formatter().parse(fixed.MOVIE_TEMPLATE) if field]


def render(
    df: DataFrame,
    style: str = "auto",
    *,
    eos: str | None = None,
    template: ChatTemplate | None = None,
    text_column: str | None = None,
    parts: bool = False,
) -> DataFrame:
    """Add (or rename to) ``text`` in the given style, keeping other columns.

    ``eos`` ends instruction and movie rows; a chat ends with the mark of its
    template; ready text is passed through without any. ``parts`` is as in
    :func:`render_instruction` and changes nothing for other styles.
    """
    if style not in (INSTRUCTION, MOVIE, CHAT, *DETECTED):
        raise ValueError(f"unknown style {style!r}")
    if style == MOVIE:
        return render_movie(df, eos)
    mapping = detect_columns(df.columns, text_column)
    if style == INSTRUCTION:
        return render_instruction(df, force_instruction(mapping, df.columns), eos, parts=parts)
    if mapping.text:
        return rename_to_text(df, mapping.text)
    if mapping.chat or style == CHAT:
        if template is None:
            logger.warning("No chat template given; using ChatML.")
            template = CHATML
        chat = mapping.chat or "chat"
        turns = normalize_turns(column(df, chat), column_type(df, chat))
        return with_column(df, "text", render_chat(turns, template))
    return render_instruction(df, mapping, eos, parts=parts)


def render_instruction(
    df: DataFrame, mapping: ColumnMapping, eos: str | None, *, parts: bool = False
) -> DataFrame:
    """Instruction style; ``parts`` adds ``prompt_text`` and ``completion_text``,
    whose concatenation is ``text``."""
    prompt, completion = instruction_parts(df, mapping, eos)
    added = {"text": F.concat(prompt, completion)}
    if parts:
        added |= {"prompt_text": prompt, "completion_text": completion}
    # One projection: a source column called ``text`` is read before it is
    # overwritten.
    return with_columns(df, added)


def instruction_parts(
    df: DataFrame, mapping: ColumnMapping, eos: str | None
) -> tuple[Column, Column]:
    """The part that is asked and the part that is to be learned."""
    eos = _required_eos(eos)
    require_columns(df, [mapping.instruction, mapping.output])

    blocks = [
        F.lit(fixed.INSTRUCTION_HEADING),
        text_of(df, mapping.instruction),
        F.lit(fixed.BLOCK_GAP),
    ]
    if mapping.input in df.columns:
        extra, dtype = column(df, mapping.input), column_type(df, mapping.input)
        block = F.concat(F.lit(fixed.INPUT_HEADING), py_str(extra, dtype), F.lit(fixed.BLOCK_GAP))
        blocks.append(F.when(truthy(extra, dtype), block).otherwise(F.lit("")))
    blocks.append(F.lit(fixed.RESPONSE_HEADING))
    return F.concat(*blocks), F.concat(text_of(df, mapping.output), F.lit(eos))


def render_movie(df: DataFrame, eos: str | None) -> DataFrame:
    """Movie-recommendation style. ``tagline`` is the only optional column."""
    eos = _required_eos(eos)
    require_columns(df, [name for name in _MOVIE_FIELDS if name != "tagline"])
    values = {
        "tagline": default_if_falsy(*optional_column(df, "tagline"), fixed.NO_TAGLINE),
        "overview": default_if_falsy(
            column(df, "overview"), column_type(df, "overview"), fixed.NO_OVERVIEW
        ),
        "genres": joined_names(column(df, "genres")),
        "keywords": joined_names(column(df, "keywords")),
    }
    pieces = []
    for literal, name, _, _ in string.Formatter().parse(fixed.MOVIE_TEMPLATE):
        pieces.append(F.lit(literal))
        if name:
            pieces.append(values[name] if name in values else text_of(df, name))
    return with_column(df, "text", F.concat(*pieces, F.lit(eos)))


def text_only(df: DataFrame) -> DataFrame:
    """Drop everything but ``text``, so that scans read only what it needs."""
    return df.select(column(df, "text"))


def instruction_prompt(
    instruction: Column, preamble: str = "", dtype: T.DataType = T.StringType()
) -> Column:
    """Instruction style up to the answer, for inference. Never null; an
    instruction that is null or no string, of type ``dtype``, has its text form."""
    return F.concat(
        F.lit(preamble + fixed.INSTRUCTION_HEADING),
        py_str(instruction, dtype),
        F.lit(fixed.BLOCK_GAP + fixed.RESPONSE_HEADING),
    )


def text_of(df: DataFrame, name: str) -> Column:
    return py_str(column(df, name), column_type(df, name))


def _required_eos(eos: str | None) -> str:
    if eos is None:
        raise ValueError("eos is required for this style; pass '' for none")
    return eos
