"""Chats: assemble, normalise and render them with a template."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowscribe.functions import fixed
from rowscribe.functions.values import py_str
from rowscribe.operators.columns import quoted


@dataclass(frozen=True)
class ChatTemplate:
    """How a turn is written, how an answer is opened, and how a chat ends."""

    turn_start: str = fixed.TURN_START
    role_end: str = "\n"
    turn_end: str = fixed.TURN_END + "\n"
    generation_prompt: str = fixed.TURN_START + "assistant\n"
    eos: str = fixed.TURN_END
    special_tokens: tuple[str, ...] = (fixed.TURN_START, fixed.TURN_END)


#: Used where no template is given. Its end-of-turn mark is also the end mark,
#: so a chat ends with that mark twice.
CHATML = ChatTemplate()


def turn_text(role: Column, content: Column, template: ChatTemplate = CHATML) -> Column:
    return F.concat(
        F.lit(template.turn_start),
        role,
        F.lit(template.role_end),
        content,
        F.lit(template.turn_end),
    )


def render_chat(turns: Column, template: ChatTemplate = CHATML) -> Column:
    """All turns, then the end mark.

    The text is null if the list, a role or a content is null: such a row cannot
    be rendered, and leaving the turn out would change the chat.
    """
    complete = F.forall(turns, lambda t: t["role"].isNotNull() & t["content"].isNotNull())
    pieces = F.transform(turns, lambda t: turn_text(t["role"], t["content"], template))
    return F.concat(F.when(complete, F.array_join(pieces, "")), F.lit(template.eos))


def generation_prompt(
    content: Column, template: ChatTemplate = CHATML, dtype: T.DataType = T.StringType()
) -> Column:
    """One user turn and the opening of the answer, for inference. Never null; a
    question that is null or no string, of type ``dtype``, has its text form."""
    return F.concat(
        turn_text(F.lit("user"), py_str(content, dtype), template),
        F.lit(template.generation_prompt),
    )


def normalize_turns(turns: Column, dtype: T.DataType) -> Column:
    """Turns as ``role``/``content``; ShareGPT turns are converted."""
    names = (
        set(dtype.elementType.names)
        if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType)
        else set()
    )
    if {"role", "content"} <= names:
        return turns
    if {"from", "value"} <= names:
        return from_sharegpt(turns)
    raise ValueError(
        f"a chat must be a list of role/content or from/value turns, not {dtype.simpleString()}"
    )


def from_sharegpt(turns: Column) -> Column:
    """``from``/``value`` turns as ``role``/``content``; unknown speakers keep
    their name."""

    def role(speaker: Column) -> Column:
        known = F.lit(None).cast("string")
        for theirs, ours in fixed.SHAREGPT_ROLES.items():
            known = F.coalesce(known, F.when(speaker == theirs, F.lit(ours)))
        return F.coalesce(known, speaker)

    return F.transform(
        turns,
        lambda t: F.struct(role(t["from"]).alias("role"), t["value"].alias("content")),
    )


def assemble_chats(
    turns: DataFrame,
    chat: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    content: str = "text",
) -> DataFrame:
    """One row per chat, with its ``messages`` in order of ``turn``, out of a
    table with one row per turn.

    ``(chat, turn)`` must be unique; turns may have gaps and be of any type that
    can be ordered. Turns are shuffled once, on the chat. A chat is one cell, as
    its text will be, so it has to fit into a task.
    """
    entry = F.struct(
        F.col(quoted(turn)).alias("turn"),
        F.col(quoted(role)).alias("role"),
        F.col(quoted(content)).alias("content"),
    )
    return (
        turns.select(F.col(quoted(chat)), entry.alias("entry"))
        .groupBy(quoted(chat))
        .agg(F.sort_array(F.collect_list("entry")).alias("entries"))
        .select(
            quoted(chat),
            F.transform(
                "entries",
                lambda e: F.struct(e["role"].alias("role"), e["content"].alias("content")),
            ).alias("messages"),
        )
    )


def strip_special(text: Column, template: ChatTemplate = CHATML) -> Column:
    """Remove the template's special tokens from generated text."""
    for token in template.special_tokens:
        text = F.replace(text, F.lit(token), F.lit(""))
    return text
