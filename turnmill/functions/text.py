"""Column expressions over one text: script tests, token estimate, stripping, keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from turnmill.config import Script

# The code points that count as whitespace when a text is stripped.
WHITESPACE = (
    "\u0009\u000A\u000B\u000C\u000D\u001C\u001D\u001E\u001F\u0020\u0085\u00A0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200A"
    "\u2028\u2029\u202F\u205F\u3000"
)
# End of fixed values.


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def leading_blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.ltrim(text, F.lit(WHITESPACE)))


def trailing_blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.rtrim(text, F.lit(WHITESPACE)))


def is_spoken(text: Column) -> Column:
    """True where the text is there and holds something besides whitespace."""
    # Looks no further than the first visible character.
    return F.coalesce(F.ltrim(text, F.lit(WHITESPACE)) != "", F.lit(False))


def _unless_ascii(text: Column, script: Script, plain: Column, value: Column) -> Column:
    """`value`, or at once `plain` where the bytes show that no letter of the script can occur."""
    if script.has_ascii:
        return value
    return F.when(F.octet_length(text) == F.length(text), plain).otherwise(value)


def contains_script(text: Column, script: Script) -> Column:
    return _unless_ascii(text, script, F.lit(False), text.rlike(script.one))


def script_chars(text: Column, script: Script) -> Column:
    # Whole runs, not single letters: few matches in dense text, none copied in other text.
    runs = F.regexp_extract_all(text, F.lit(script.run), F.lit(0))
    return _unless_ascii(text, script, F.lit(0), F.length(F.array_join(runs, "")))


def ratio(n_script: Column, n_stripped: Column) -> Column:
    return F.when(n_stripped > 0, n_script / n_stripped).otherwise(F.lit(0.0))


def script_ratio(text: Column, script: Script) -> Column:
    return ratio(script_chars(text, script), F.length(strip(text)))


def tokens_from_counts(n_chars: Column, n_script: Column, script: Script) -> Column:
    dense = n_script / F.lit(script.chars_per_token)
    rest = (n_chars - n_script) / F.lit(script.other_chars_per_token)
    return (dense + rest).cast("bigint")


def estimate_tokens(text: Column, script: Script) -> Column:
    return tokens_from_counts(F.length(text), script_chars(text, script), script)


def preview(text: Column, n: int) -> Column:
    return F.substring(text, 1, n)


def prefix_key(text: Column, n: int) -> Column:
    return F.md5(F.substring(text, 1, n))


def draw_key(seed: int, stage: Column | str, ident: Column) -> Column:
    """A pseudo-random order that depends on the row alone, not on where the row is stored."""
    stage = F.lit(stage) if isinstance(stage, str) else stage
    return F.md5(F.concat_ws(":", F.lit(str(seed)), stage, ident.cast("string")))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent; NULL where the whole is empty."""
    return F.lit(100.0) * part / F.when(whole != 0, whole)
