"""Line-first cleaning: rules per line, then a verdict on how much of the text went.

Everything is an expression over one row: no shuffle, no Python. A text's cost is
that of a few passes over its words, and one sort where a window of words repeats.

A line that fails for its end or for a phrase loses what failed only: the tail after its
last sentence end, or the sentences that hold a phrase. It goes whole if it is short and
loses half of itself or more, as furniture does.

Defined results for odd input: a null text counts as empty and stays null when
cleaned; an empty text or one of blanks has no words and fails the base rules; lines
without a word are never removed and count as no text. Rows with equal ids or texts
are judged one by one. Other columns pass through; those whose names clash with an
added column are replaced by it. An empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 5
# The words and the symbols that the base rules are about.
WORD = r"[^\\x20\\x09-\\x0D]+"
BLANKS = r"[\\x20\\x09-\\x0D]"
SYMBOL = "[#*$%&|<>]"
# What a sentence may end with, closing quotes and brackets included.
CLOSING = r"[\\x22\\x27)\\]\\u2019\\u201D\\u00BB]"
SENTENCE_END = r"[.!?:;\\u2026\\u3002\\uFF01\\uFF1F\\u061F\\u0964]" + CLOSING + "{0,9}$"
ENDING = 10
# All up to the last such end within a line (full-width marks need no blank
# behind them), and the places between two sentences.
FULL_WIDTH = r"[\\u3002\\uFF01\\uFF1F]" + CLOSING
FINISHED = rf"(?s)^.*(?:[.!?:;\\u2026\\u061F\\u0964]{CLOSING}{{0,9}}(?={BLANKS}|$)|{FULL_WIDTH}{{0,9}})"
BETWEEN_SENTENCES = (
    rf"(?={BLANKS})(?<=[.!?\\u2026\\u061F\\u0964]{CLOSING}{{0,9}})|(?<={FULL_WIDTH}{{0,9}})(?!{CLOSING})"
)
# Separators between the entries of a menu.
MENU_MARKS = r"[|\\u00BB\\u203A\\u2022\\u00B7]"
# Phrases of page furniture.
BOILERPLATE = [
    "accept cookies",
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "read more",
    "sign up for our newsletter",
    "subscribe to our",
    "terms of service",
    "terms of use",
    "use of cookies",
]


@dataclass(frozen=True)
class LineRules:
    """``min_words`` and ``max_repeated`` (percent of words) are the base rules on texts.

    A line fails if it doesn't end as a sentence does, if its menu marks are more than
    ``menu_share`` of its words and ``menu_marks`` or more, if more than
    ``symbol_share`` of its characters are symbols, or if it holds a phrase of page
    furniture. A failed line of fewer than ``short_line`` words that would lose half of its
    word characters goes whole. A text that loses more than ``max_loss`` of its word
    characters is rejected.
    """

    min_words: int = 10
    max_repeated: int = 20
    menu_marks: int = 2
    menu_share: float = 0.2
    symbol_share: float = 0.05
    max_loss: float = 0.5
    short_line: int = 20


def _has_phrase(text: str) -> str:
    return "(" + " OR ".join(f"contains(lower({text}), '{phrase}')" for phrase in BOILERPLATE) + ")"


def _is_furniture(rules: LineRules) -> str:
    """What goes by its share of the line, and so fails the line as a whole."""
    marks = f"regexp_count(line, '{MENU_MARKS}')"
    return f"""(
        ({marks} >= {rules.menu_marks} AND {marks} > {rules.menu_share} * regexp_count(line, '{WORD}'))
        OR regexp_count(line, '{SYMBOL}') > {rules.symbol_share} * length(line)
    )"""


def _is_unfinished() -> str:
    """Only the end of a line is searched for punctuation, and only lines of texts with
    ``has_phrase`` for phrases."""
    return f"""(
        NOT regexp_like(right(rtrim(line), {ENDING}), '{SENTENCE_END}')
        OR (__has_phrase AND {_has_phrase('line')})
    )"""


def _chars(text: str) -> str:
    return f"(length({text}) - regexp_count({text}, '{BLANKS}'))"


def _rest(rules: LineRules) -> str:
    """What stays of the failed line ``x``; null if nothing does."""
    sentences = f"filter(split(done, '{BETWEEN_SENTENCES}'), s -> NOT {_has_phrase('s')})"
    done = f"transform(array(regexp_extract(x.line, '{FINISHED}', 0)), done -> IF(__has_phrase AND {_has_phrase('done')}, ltrim(array_join({sentences}, '')), done))"
    short = f"regexp_count(x.line, '{WORD}') < {rules.short_line} AND 2 * {_chars('rest')} <= x.chars"
    return f"""CASE WHEN NOT x.furniture THEN get(transform({done}, rest ->
        CASE WHEN {_chars('rest')} > 0 AND NOT ({short}) THEN rest END), 0) END"""


def _repeated_words() -> str:
    """Words in windows that occur twice or more; windows are compared by 64-bit hashes.

    Only a text with a repeat pays for the sort that finds its places. A repeated
    window at ``place`` covers the words that the one before didn't.
    """
    ordered = "sort_array(transform(__windows, (hash, place) -> struct(hash, place)))"
    places = f"""sort_array(transform(flatten(transform(array({ordered}), o ->
        filter(o, (x, i) -> get(o, i - 1).hash <=> x.hash OR get(o, i + 1).hash <=> x.hash))), x -> x.place))"""
    return f"""CASE WHEN size(array_distinct(__windows)) < size(__windows) THEN aggregate(
        {places}, named_struct('total', 0L, 'last', {-WINDOW}),
        (seen, place) -> named_struct('total', seen.total + least({WINDOW}, place - seen.last), 'last', place),
        seen -> seen.total) ELSE 0L END"""


def judged(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text") -> DataFrame:
    """``docs`` with ``clean_text`` and what the rules found: ``n_words``, ``word_chars``,
    ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``n_lines``, ``n_failed_lines``,
    ``kept_chars`` (word characters that stay), ``base_failed`` and ``kept``."""
    joined = ", ".join(f"get(__words, CAST(i + {k} AS INT))" for k in range(WINDOW))
    added = {
        "__words": f"regexp_extract_all(coalesce(`{text}`, ''), '{WORD}', 0)",
        "__has_phrase": _has_phrase(f"coalesce(`{text}`, '')"),
        "__lines": rf"""transform(split(coalesce(`{text}`, ''), '\n'), line -> named_struct('line', line,
            'chars', {_chars('line')}))""",
    }
    docs = docs.withColumns({k: F.expr(v) for k, v in added.items()})
    docs = docs.withColumns(
        {
            "__windows": F.expr(
                f"""CASE WHEN size(__words) >= {WINDOW} THEN
                transform(sequence(0, size(__words) - {WINDOW}), i -> xxhash64({joined}))
                ELSE array(0L) END"""
            ),
            "__lines": F.expr(
                f"""transform(__lines, x -> named_struct('line', x.line, 'chars', x.chars,
                'furniture', x.chars > 0 AND get(transform(array(x.line), line -> {_is_furniture(rules)}), 0),
                'unfinished', x.chars > 0 AND get(transform(array(x.line), line -> {_is_unfinished()}), 0)))"""
            ),
            "__full_lines": F.expr("transform(filter(__lines, x -> x.chars > 0), x -> x.line)"),
        }
    )
    failed_line = "(x.furniture OR x.unfinished)"
    docs = docs.withColumn("__left", F.expr(f"transform(__lines, x -> IF({failed_line}, {_rest(rules)}, x.line))"))
    found = {
        "n_words": "CAST(size(__words) AS BIGINT)",
        "word_chars": "aggregate(__lines, 0L, (total, x) -> total + x.chars)",
        "n_symbols": f"CAST(coalesce(regexp_count(`{text}`, '{SYMBOL}'), 0) AS BIGINT)",
        "n_dup_lines": "CAST(size(__full_lines) - size(array_distinct(__full_lines)) AS BIGINT)",
        "n_repeat_words": _repeated_words(),
        "n_lines": "CAST(size(__full_lines) AS BIGINT)",
        "n_failed_lines": f"CAST(size(filter(__lines, x -> {failed_line})) AS BIGINT)",
        "kept_chars": f"aggregate(__left, 0L, (total, line) -> total + coalesce({_chars('line')}, 0))",
        "clean_text": rf"CASE WHEN `{text}` IS NOT NULL THEN array_join(__left, '\n') END",
    }
    docs = docs.withColumns({k: F.expr(v) for k, v in found.items()})
    docs = docs.drop("__words", "__has_phrase", "__lines", "__left", "__windows", "__full_lines")
    failed = f"n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeated} * n_words"
    docs = docs.withColumn("base_failed", F.expr(failed))
    verdict = f"NOT base_failed AND kept_chars >= {1 - rules.max_loss} * word_chars"
    return docs.withColumn("kept", F.expr(verdict))


def cleaned(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The documents that stay, without what failed of their lines, in the columns of ``docs``.

    ``n_chars``, where there is such a column, is the length of the cleaned text.
    """
    # The row is kept whole beside what is found, so that no name of its columns can clash.
    whole = docs.select("text", F.struct(*docs.columns).alias("__row"))
    # Through a generator, so that the filter doesn't take copies of all its parts below them.
    verdict = F.inline(F.array(F.struct("kept", "clean_text")))
    changed = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("bigint")}
    return judged(whole, rules).select("__row", verdict).where("kept").select(
        *[changed.get(c, F.col("__row").getField(c)).alias(c) for c in docs.columns]
    )
