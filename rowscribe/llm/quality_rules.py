"""Quality rules: a table of thresholds, compiled into one projection.

Everything is built from Spark's own functions; no row leaves the JVM and
nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowscribe.llm.common import let, numbered, pick, position

#: White space that separates words, and the characters that count as symbols.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Words of the commonest kind in English, French, German and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from have in is it not of on or that the this to was with "
    "au dans des du elle en est et il la le les ne par pas pour que qui sur un une "
    "auf das dem den der des die ein eine er es im ist mit nicht sich sie und von zu "
    "al como con de del el está las lo los más no para se son una y"
).split()


@dataclass(frozen=True)
class Rule:
    """A document fails if 100 * part is over `most` * whole or under `least` *
    whole. Rules on texts of fewer than `words` words don't apply."""

    name: str
    part: str
    whole: str
    least: int | None = None
    most: int | None = None
    words: int = 0


#: The base rules fix themselves; the others make the method's verdict.
BASE = (
    Rule("length", "n_words", "1", least=1000),
    Rule("repeats", "n_repeat_words", "n_words", most=20),
)
RULES = (
    Rule("word_length_low", "word_chars", "n_words", least=150),
    Rule("word_length_high", "word_chars", "n_words", most=3000),
    Rule("symbols", "n_symbols", "n_words", most=10),
    Rule("capitals", "n_capitals", "word_chars", most=30, words=10),
    Rule("exclamations", "n_exclamations", "n_words", most=30, words=10),
    Rule("stop_words", "n_stop_words", "n_words", least=3, words=50),
    Rule("lines", "n_dup_lines", "n_lines", most=50),
)
#: What the base counts, and what the other rules compare besides.
BASE_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FURTHER_MEASURES = ("n_lines", "n_capitals", "n_exclamations", "n_stop_words")


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _repeat_words(words: Column, size: int = 5) -> Column:
    """Words that lie in windows found twice or more in the list.

    Windows are told apart by a hash. A list without a repeated hash is settled. Else
    hashes are sorted with their places, so equal ones are neighbours; those with an equal
    neighbour are sorted again by their words, and the places of those with an equal
    neighbour then are sorted, of which each adds the words up to the next, `size` at most.
    """
    # Words are taken one by one, as `slice` copies the whole list for each window.
    window = lambda i: [F.get(words, i + j) for j in range(size)]
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - size), lambda i: F.xxhash64(*window(i)))

    def with_neighbour(sorted_: Column, key: str, value) -> Column:
        """value of the items of a sorted list that have a neighbour with an equal key."""
        same = lambda x, k: F.coalesce(x[key] == F.get(sorted_, k)[key], F.lit(False))
        marked = F.transform(sorted_, lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), value(x)))
        return F.filter(marked, lambda x: x.isNotNull())

    def spread(places: Column) -> Column:
        return F.aggregate(
            F.transform(places, lambda p, k: F.least(F.lit(size), F.coalesce(F.get(places, k + 1) - p, F.lit(size)))),
            F.lit(0),
            lambda total, n: total + n,
        )

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        worded = lambda x: F.struct(F.array(*window(x["i"])).alias("w"), x["i"].alias("i"))
        places = lambda found: let(F.sort_array(with_neighbour(found, "w", lambda x: x["i"])), spread)
        some = lambda placed: let(F.sort_array(with_neighbour(placed, "h", worded)), places)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(placed, some))

    return F.when(F.size(words) > size, let(hashes, covered)).otherwise(F.lit(0))


def measures(text: Column) -> Column:
    """A struct of what the rules compare; a null text measures as an empty one."""
    text = F.coalesce(text, F.lit(""))

    def of_words(words: Column) -> Column:
        def of_lines(lines: Column) -> Column:
            return F.struct(
                F.size(words).cast("long").alias("n_words"),
                (F.length(text) - _count(text, SPACES)).cast("long").alias("word_chars"),
                _count(text, SYMBOLS).cast("long").alias("n_symbols"),
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                _repeat_words(words).cast("long").alias("n_repeat_words"),
                F.size(lines).cast("long").alias("n_lines"),
                _count(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long").alias("n_capitals"),
                _count(text, "!").cast("long").alias("n_exclamations"),
                F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
            )

        lines = F.filter(F.split(text, "\n", -1), lambda line: F.length(F.translate(line, SPACES, "")) > 0)
        return let(lines, of_lines)

    return let(F.filter(F.split(text, "[\\x20\\x09-\\x0D]+", -1), lambda w: w != ""), of_words)


def _failed(rule: Rule, of) -> Column:
    part, whole = 100 * of(rule.part), F.lit(1) if rule.whole == "1" else of(rule.whole)
    failed = F.lit(False)
    if rule.least is not None:
        failed = failed | (part < rule.least * whole)
    if rule.most is not None:
        failed = failed | (part > rule.most * whole)
    return failed & (of("n_words") >= rule.words)


def verdicts(measured: Column, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE) -> tuple[Column, Column]:
    """base_failed and kept of a struct of measures."""
    of = lambda name: measured[name]
    base_failed = F.lit(False)
    for rule in base:
        base_failed = base_failed | _failed(rule, of)
    rejected = F.lit(False)
    for rule in rules:
        rejected = rejected | _failed(rule, of)
    return base_failed, ~base_failed & ~rejected


def quality_rules(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, base measures, base_failed, kept, further measures) of every whole text.

    A null or empty text has no words and fails. Rows are not compared, so
    repeated and null ids stay as they are; other columns are left out.
    """

    def judged(measured: Column) -> Column:
        base_failed, kept = verdicts(measured)
        return F.struct(measured.alias("measured"), base_failed.alias("base_failed"), kept.alias("kept"))

    docs = pick(df, doc_id=doc_id, text=text)
    rows = docs.select("doc_id", let(measures(F.col("text")), judged).alias("result"))
    value = lambda name: F.col("result")["measured"][name].alias(name)
    return rows.select(
        "doc_id", *map(value, BASE_MEASURES), "result.base_failed", "result.kept", *map(value, FURTHER_MEASURES)
    )


def keep_good(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows, with all their columns, that the rules keep."""
    # One expression with one measuring inside it: a filter over a struct column would be
    # pushed down with a copy of the measuring for every field it uses.
    kept = let(measures(F.col(position(df, text))), lambda measured: verdicts(measured)[1])
    return numbered(df).where(kept).toDF(*df.columns)
