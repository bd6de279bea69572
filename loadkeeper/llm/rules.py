"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

``measures`` counts what the rules need in a text; ``RULES`` says which ratio of two counts may lie
between which bounds; ``failed`` turns that table into one column with the names of the rules a text breaks. Ratios are compared as
products of whole numbers, in percent, so a bound is met exactly or not.

Words lie between white space, lines between line feeds. A null text counts as empty: it has no words and fails.
Repeated rows get equal results; only the text column is read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadkeeper.llm.shared import SPACE, UPPER, words_of

#: Words of a window whose repetition within a text counts.
WINDOW = 5
#: The symbols that are counted, marks of shouting, marks that begin a list item and that end a cut line.
SYMBOLS, SHOUTS, BULLETS, ELLIPSES = "#*$%&|<>", "!?", ("- ", "* ", "• ", "· ", "+ "), ("...", "…")
#: The commonest words of the corpus languages, which running text cannot do without.
STOP_WORDS = (
    "the of and to in a is that it for was on are as with they at be this from or by not but what all were an you he she have had",
    "der die das und ist nicht ein eine zu den dem des mit von für auf im sich als auch es an werden aus er hat dass sie nach wird bei",
    "le la les de des du et un une est que qui dans pour pas au sur avec ce il elle ne se par plus sont en",
    "el los las y del que en por con para una su al lo como más pero sus es no son se",
)


@dataclass(frozen=True)
class Rule:
    """``least`` <= 100 * ``count`` / ``per`` <= ``most``; with ``per`` None the bounds are for the count itself. None is no bound.

    A ratio says little about a few words or lines: the rule holds where ``per`` is at least ``among``.
    """

    name: str
    count: str
    per: str | None = None
    least: int | None = None
    most: int | None = None
    among: int = 0


#: The production table. Ratios in percent.
RULES = (
    Rule("few_words", "n_words", least=10),
    Rule("short_words", "word_chars", "n_words", least=200),
    Rule("long_words", "word_chars", "n_words", most=2000),
    Rule("symbols", "n_symbols", "n_words", most=10),
    Rule("shouts", "n_shouts", "n_words", most=50),
    Rule("capitals", "n_capitals", "word_chars", most=40),
    Rule("stop_words", "n_stop_words", "n_words", least=1, among=20),
    Rule("repeated_words", "n_repeat_words", "n_words", most=20),
    Rule("echoes", "n_echoes", "n_words", most=20),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=40),
    Rule("bullets", "n_bullets", "n_lines", most=90),
    Rule("cut_lines", "n_cut_lines", "n_lines", most=30),
)
#: The contract's own rules.
BASE = ("few_words", "repeated_words")


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _without(text: Column, characters: str) -> Column:
    """The text without some ASCII marks or letters. A pattern takes runs of them out; ``translate`` looks up every character."""
    return F.regexp_replace(text, "[" + "".join(f"\\x{ord(c):02X}" for c in characters) + "]+", "")


def _held(text: Column, characters: str) -> Column:
    """How many characters of a text are among some."""
    return F.char_length(text) - F.char_length(_without(text, characters))


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """How many words lie in a run of ``width`` words that occurs twice or more, the first occurrence included.

    Runs are compared by 64-bit hashes. Only where two are equal are they sorted, with their places, to find the equal ones.
    """
    starts = F.slice(words, 1, F.greatest(F.size(words) - (width - 1), F.lit(0)))
    runs = F.transform(starts, lambda x, i: F.xxhash64(x, *[F.get(words, i + k) for k in range(1, width)]))

    def covered(places: Column) -> Column:
        # every run covers its words up to where the next one begins
        steps = F.transform(places, lambda p, i: F.least(F.coalesce(F.get(places, i + 1) - p, F.lit(width)), F.lit(width)))
        return F.aggregate(steps, F.lit(0), lambda a, s: a + s)

    def among(ordered: Column) -> Column:
        def place(x: Column, i: Column) -> Column:
            before, after = F.get(ordered, i - 1)["run"], F.get(ordered, i + 1)["run"]
            return F.when((x["run"] == before) | (x["run"] == after), x["place"])

        return _bound(F.sort_array(F.array_compact(F.transform(ordered, place))), covered)

    def counted(found: Column) -> Column:
        ordered = F.sort_array(F.transform(found, lambda r, i: F.struct(r.alias("run"), i.alias("place"))))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(_bound(ordered, among))

    return _bound(runs, counted)


def _stop_words(text: Column) -> Column:
    """How many words are stop words once marks are off; case and marks are seen to once for the text, not word by word."""
    known = [w for line in STOP_WORDS for w in line.split()]
    return F.size(F.filter(words_of(_without(F.lower(text), ".,;:!?\"'()")), lambda w: w.isin(*known)))


def measures(text: Column) -> Column:
    """The counts of a text that rules may name, as a struct of longs."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.rlike(x, F.lit(f"[^{SPACE}]")))
    starts = lambda x, marks: F.rlike(x, F.lit(f"^[{SPACE}]*(" + "|".join(f"\\Q{m}\\E" for m in marks) + ")"))
    ends = lambda x, marks: F.rlike(x, F.lit("(" + "|".join(f"\\Q{m}\\E" for m in marks) + f")[{SPACE}]*$"))

    def of(words: Column, rows: Column) -> Column:
        counts = {
            "n_words": F.size(words),
            "word_chars": F.char_length(F.array_join(words, "")),
            "n_symbols": _held(text, SYMBOLS),
            "n_shouts": _held(text, SHOUTS),
            "n_capitals": _held(text, UPPER),
            "n_stop_words": _stop_words(text),
            "n_repeat_words": repeated_words(words),
            "n_echoes": F.size(F.array_compact(F.transform(words, lambda w, i: F.when(w == F.get(words, i - 1), i)))),
            "n_lines": F.size(rows),
            "n_dup_lines": F.size(rows) - F.size(F.array_distinct(rows)),
            "n_bullets": F.size(F.filter(rows, lambda x: starts(x, BULLETS))),
            "n_cut_lines": F.size(F.filter(rows, lambda x: ends(x, ELLIPSES))),
        }
        return F.struct(*[c.cast("bigint").alias(name) for name, c in counts.items()])

    return _bound(words_of(text), lambda w: _bound(lines, lambda rows: of(w, rows)))


def failed(counts: Column, rules: Sequence[Rule] = RULES) -> Column:
    """The names of the rules that a text's measures break, in the order of the table."""

    def broken(rule: Rule) -> Column:
        value = counts[rule.count] * (1 if rule.per is None else 100)
        per = F.lit(1) if rule.per is None else counts[rule.per]
        out = F.lit(False)
        if rule.least is not None:
            out = out | (value < per * rule.least)
        if rule.most is not None:
            out = out | (value > per * rule.most)
        return F.when(out & (per >= rule.among), F.lit(rule.name))

    return F.array_compact(F.array(*map(broken, rules)))
