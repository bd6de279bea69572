"""Text functions with the comparison rules of the control tables.

Names compare without case and without trailing blanks, so both sides go through ``fold``.
Everything here is a built-in expression and stays in generated code.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def fold(value: Column | str) -> Column:
    """The comparison key of a name: no case, no trailing blanks."""
    return F.lower(F.rtrim(col(value)))


def fold_text(value: str) -> str:
    """``fold`` for a value known on the driver."""
    return value.rstrip(" ").lower()


def same(value: Column | str, text: str) -> Column:
    return fold(value) == F.lit(fold_text(text))


def like(value: Column | str, pattern: str) -> Column:
    """LIKE without case; ``%`` and ``_`` are wildcards."""
    return F.lower(col(value)).like(pattern.lower())


def empty(value: Column | str) -> Column:
    """NULL, '' or blanks only."""
    return F.coalesce(F.rtrim(col(value)), F.lit("")) == ""


def text_length(value: Column | str) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(col(value)))


def replace_any_case(value: Column | str, find: str, put: Column | str) -> Column:
    """Replace every occurrence of ``find`` in any case; a NULL replacement gives NULL."""
    put = F.lit(put) if isinstance(put, str) else put
    # a long replacement without the two marks, which is nearly every one, is not searched with a pattern for each row
    marked = put.contains("\\") | put.contains("$")
    literal = F.when(marked, F.regexp_replace(put, r"([\\$])", r"\\$1")).otherwise(put)
    return F.regexp_replace(col(value), F.lit("(?i)" + re.escape(find)), literal)


def code4(value: Column | str) -> Column:
    """A numeric code as four characters; numbers too wide for four characters show as '*'."""
    digits = col(value).cast("string")
    shown = F.when(F.length(digits) > 4, F.lit("*")).otherwise(digits)
    return F.right(F.concat(F.lit("0000"), shown), F.lit(4))


def code_key(value: Column | str) -> Column:
    """The comparison key of a numeric code: up to four characters padded, wider ones as they are."""
    digits = col(value).cast("string")
    return F.when(F.length(digits) > 4, digits).otherwise(F.lpad(digits, 4, "0"))


def entries(value: Column | str) -> Column:
    """The entries of a comma list, untrimmed; NULL has none, '' has one empty entry."""
    return F.split(col(value), ",")


def entry_count(value: Column | str) -> Column:
    return F.coalesce(F.size(entries(value)), F.lit(0))


def entry_keys(value: Column | str) -> Column:
    """The distinct comparison keys of a comma list."""
    return F.array_distinct(F.transform(entries(value), fold))


def in_names(value: Column | str, names: str | Sequence[str]) -> Column:
    """Membership in a name list given by the caller (comma text or sequence)."""
    given = names.split(",") if isinstance(names, str) else names
    return fold(value).isin(sorted({fold_text(n) for n in given}))


def schema_part(value: Column | str) -> Column:
    """What stands before the first dot, NULL without a dot."""
    value = col(value)
    return F.when(value.contains("."), F.substring_index(value, ".", 1))


def table_part(value: Column | str) -> Column:
    """What stands after the first dot, the whole name without a dot."""
    return F.regexp_replace(col(value), r"^[^.]*\.", "")


def camel_case(value: Column | str, max_chars: int | None = None) -> Column:
    """First letter of every blank-separated word in upper case, the rest in lower case.

    Inner blanks stay, trailing blanks go. ``max_chars`` cuts the result to a width. Case maps letter by letter: a letter whose
    upper case is two letters stays as it is.
    """

    def capital(word: Column) -> Column:
        first = F.substring(word, 1, 1)
        upper = F.upper(first)
        return F.concat(F.when(F.length(upper) > 1, first).otherwise(upper), word.substr(F.lit(2), F.length(word)))

    lowered = F.lower(col(value))
    word_by_word = F.array_join(F.transform(F.split(lowered, " "), capital), " ")
    # For words that start with an ASCII or Latin-1 letter the engine's own function does the same
    # in generated code; only texts with other word starts are taken apart.
    out = F.when(lowered.rlike(r"(^| )[^\x00-\x7F\u00C0-\u00DE\u00E0-\u00FE]"), word_by_word).otherwise(F.initcap(lowered))
    if max_chars is not None:
        out = F.substring(out, 1, max_chars)
    return F.rtrim(out)


def fill(template: str, **values: Column) -> Column:
    """A template with ``{name}`` places as one text column; a NULL value makes the text NULL."""
    parts = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2:
            parts.append(values[piece])
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)
