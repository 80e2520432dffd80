"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Everything is computed inside the row, so there is no shuffle and no user
function: arrays of words and lines, and higher-order functions over them.

The rule on stop words knows English, French, German and Spanish and compares
case-sensitively: it rejects clean text in other languages or wholly in capitals.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import WORD

#: Frequent function words of the languages at hand (English, French, German, Spanish). Fixed values.
STOP_WORDS = (
    "the of and to in a is that for it was on are with as be this by from or an at not have which you had "
    "le la les de des du un une et en que qui dans pour sur est pas au avec par ce il plus "
    "der die das und den von zu mit ist im dem nicht ein eine als auch auf für es sich "
    "el los las y por con una su del se lo no al como más pero"
).split()


@dataclass(frozen=True)
class Rule:
    """Rejects a document whose ``measure`` lies outside ``least``..``most``; ``measure`` names a column of measures()."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None


#: The base every document has to pass, in whole numbers: percentages are compared as 100 * part > percent * whole.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

#: The thresholds. They are set wide: a document of plain prose stays far inside all of them.
RULES = (
    Rule("length", "n_words", most=10_000_000),
    Rule("word_length", "mean_word_chars", least=2.0, most=15.0),
    Rule("symbols", "symbols_per_word", most=0.1),
    Rule("marks", "marks_per_word", most=0.5),
    Rule("stop_words", "stop_words_ratio", least=0.005),
    Rule("repeated_lines", "dup_lines_ratio", most=0.5),
)


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def _count(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once: bound by a lambda, it stays so wherever the optimizer moves the expression."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeated_words(words: Column) -> Column:
    """Words in three-word windows found twice or more."""
    def place(windows: Column) -> Column:
        def repeated(w: Column, i: Column) -> Column:
            before, after = F.get(windows, i - 1)["h"], F.get(windows, i + 1)["h"]
            return F.coalesce(before == w["h"], F.lit(False)) | F.coalesce(after == w["h"], F.lit(False))

        # In order of place each window covers three words, fewer where the next one begins sooner.
        starts = F.array_sort(F.transform(F.filter(windows, repeated), lambda w: w["i"]))
        return F.aggregate(
            starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
            lambda acc, i: F.struct((acc["n"] + F.least(i - acc["last"], F.lit(3))).alias("n"), i.alias("last")),
            lambda acc: acc["n"],
        )

    # Windows as (hash, place), sorted: equal windows become neighbours.
    windows = F.array_sort(F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i"))))
    return F.when(F.size(words) >= 3, _let(windows, place)).otherwise(F.lit(0).cast("long"))


def measures(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """Add the measures of the rules as columns, each in one pass over the row.

    Counts are longs; ratios of an empty text are 0. The columns of ``docs`` stay;
    a column of the same name as a measure is replaced unless ``prefix`` differs.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    of_words = _let(words(F.col(text)), lambda w: F.struct(
        F.size(w).cast("long").alias("n"), _repeated_words(w).alias("repeated"),
        F.size(F.filter(w, lambda x: x.isin(*STOP_WORDS))).cast("long").alias("stops")))
    of_lines = _let(F.filter(F.split(body, "\n", -1), lambda line: line.rlike(WORD)), lambda lines: F.struct(
        F.size(lines).cast("long").alias("n"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("repeated")))
    values = {
        "n_words": F.col("__of_words.n"),
        "word_chars": F.char_length(F.translate(body, " \t\n\x0b\f\r", "")).cast("long"),
        "n_symbols": _count(body, "#*$%&|<>").cast("long"),
        "n_dup_lines": F.col("__of_lines.repeated"),
        "n_repeat_words": F.col("__of_words.repeated"),
        "n_lines": F.col("__of_lines.n"),
        "n_marks": _count(body, "!?").cast("long"),
        "n_stop_words": F.col("__of_words.stops"),
    }
    out = docs.withColumns({"__of_words": of_words, "__of_lines": of_lines}).select(
        *[c for c in docs.columns if c not in {prefix + k for k in values}], *[v.alias(prefix + k) for k, v in values.items()])

    def ratio(part: str, whole: str) -> Column:
        return F.when(F.col(prefix + whole) > 0, F.col(prefix + part) / F.col(prefix + whole)).otherwise(F.lit(0.0))

    return out.withColumns({
        prefix + "mean_word_chars": ratio("word_chars", "n_words"), prefix + "symbols_per_word": ratio("n_symbols", "n_words"),
        prefix + "marks_per_word": ratio("n_marks", "n_words"), prefix + "stop_words_ratio": ratio("n_stop_words", "n_words"),
        prefix + "dup_lines_ratio": ratio("n_dup_lines", "n_lines"),
    })


def base_failed(prefix: str = "") -> Column:
    """The fixed base: too few words, or too many of them in repeated three-word windows."""
    n, repeated = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (n < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n)


def compiled(rules: tuple[Rule, ...] = RULES, prefix: str = "") -> Column:
    """The names of the rules that reject, as one array expression over the measures."""
    checks = []
    for rule in rules:
        value, bad = F.col(prefix + rule.measure), F.lit(False)
        if rule.least is not None:
            bad = bad | (value < rule.least)
        if rule.most is not None:
            bad = bad | (value > rule.most)
        checks.append(F.when(bad, F.lit(rule.name)))
    return F.array_compact(F.array(*checks))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", prefix: str = "") -> DataFrame:
    """Measures, ``base_failed``, the rejecting rules and ``kept`` for every row.

    A null or empty text has no words and fails the base. Repeated rows get equal
    verdicts. An empty table gives an empty table. Columns of ``docs`` stay; those
    that clash with a result column are replaced unless ``prefix`` differs.
    """
    out = measures(docs, text, prefix).withColumns({prefix + "base_failed": base_failed(prefix), prefix + "rejected_by": compiled(rules, prefix)})
    return out.withColumn(prefix + "kept", ~F.col(prefix + "base_failed") & (F.size(prefix + "rejected_by") == 0))


def kept_rows(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass base and rules, with the columns of ``docs`` only, whatever their names.

    Null and empty texts have no words and go; repeated rows stay or go together; an
    empty table gives an empty table. The input row travels as one struct, so no name
    can clash. A filter on the verdict alone would be pushed below the projections and
    compute the measures again for each rule. It also reads a row number, which no
    predicate is pushed below.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("body"))
    judged = judge(rows, rules, "body").withColumn("place", F.monotonically_increasing_id())
    return judged.filter(F.col("kept") & (F.col("place") >= 0)).select("row.*")


def rule_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The verdict as SQL text over columns named as the measures: the same table, for other engines."""
    bad = []
    for rule in rules:
        bad += [f"{rule.measure} < {rule.least}"] if rule.least is not None else []
        bad += [f"{rule.measure} > {rule.most}"] if rule.most is not None else []
    return f"not base_failed and not ({' or '.join(bad)})"
