"""How deep JSON text is nested, told before it is parsed.

The parser, and whatever walks through its result, goes down one call per level, so a line of a few
kilobytes could use up a thread's stack and end the process. The measure here needs no
recursion: patterns are possessive, which runs them as loops.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MAX_DEPTH = 500  # of what is looked into: type names and texts of a value are made level by level
PARSER_DEPTH = 1200  # of what is parsed at all

TOO_DEEP = "too_deep"
UNBALANCED = "unbalanced"

# A string, up to the end of the text if it is not closed.
_STRING = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+(?:"|\\?\z)'
_NO_BRACKETS = r"[^\[\]{}]++"


def nesting_fault(raw: Column, most: int = MAX_DEPTH) -> Column:
    """`too_deep` where lists and objects of a JSON text are nested in more than `most` levels,
    `unbalanced` where brackets of such a text do not match, else NULL.

    A text with at most `most` opening brackets is neither, and most texts are told so by one pattern. One
    with more than `most` in a row is too deep. For others brackets outside strings are kept, and innermost pairs are taken out level by level:
    what is left after `most` levels is deeper, if it still holds a pair or more than `most`
    unclosed ones. Only texts without a fault may be parsed; an unbalanced text is no JSON, whichever
    fault it has.
    """
    # Tied to the start, or it would be tried from every place in the text.
    many = raw.rlike(r"(?s)\A(?:[^\[{]*+[\[{]){%d}+" % (most + 1))
    brackets = F.regexp_replace(F.regexp_replace(raw, _STRING, ""), _NO_BRACKETS, "")
    marks = F.translate(brackets, "{}", "[]")
    pair, nothing = F.lit("[]"), F.lit("")
    level = lambda left, _: F.replace(left, pair, nothing)
    left = F.aggregate(F.sequence(F.lit(1), F.lit(most)), marks, level)

    def verdict(left: Column) -> Column:
        unclosed = F.length(left) - F.length(F.replace(left, F.lit("["), nothing))
        deeper = F.contains(left, pair) | (unclosed > most)
        return F.when(deeper, TOO_DEEP).when(left != "", UNBALANCED)

    # The lambda binds what is left, which would otherwise be worked out for each use of it.
    at_once = marks.rlike(r"\[{%d}" % (most + 1))
    return F.when(many, F.when(at_once, TOO_DEEP).otherwise(F.transform(F.array(left), verdict)[0]))


def is_too_deep(raw: Column) -> Column:
    return F.coalesce(nesting_fault(raw) == TOO_DEEP, F.lit(False))
