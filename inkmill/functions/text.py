"""Text functions as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space and as line ends.
WS = r"[\t-\r\u001c- \u0085   -     　]"
NL = r"\r\n|[\n\u000b\u000c\r\u001c-\u001e\u0085  ]"
#: What the approximate token counter counts: runs of letters and marks, up to three digits, runs of other signs.
TOKEN = r"[\p{L}\p{M}]+|\p{N}{1,3}|[^\s\p{L}\p{M}\p{N}]+"
#: A piece of text up to the end of a sentence or line; the pieces of a text follow one another without a gap.
PIECE = r"(?s).+?(?:[.!?]+[\"'”»’)]*\s+|\n+|\z)"


def strip(c: Column) -> Column:
    """Without white space at both ends (all of Unicode's, not the blank alone)."""
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def clean_text(c: Column) -> Column:
    """Stripped lines without the blank ones, joined by a line feed; null gives the empty string."""
    lines = F.transform(F.split(F.coalesce(c, F.lit("")), NL), strip)
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def token_count(c: Column) -> Column:
    """Approximate number of tokens; null and empty texts have 0."""
    return F.coalesce(F.regexp_count(c, F.lit(TOKEN)), F.lit(0))


def one_line(c: Column) -> Column:
    """Line feeds as blanks, as language identification wants its input."""
    return F.replace(c, F.lit("\n"), F.lit(" "))


def head(c: Column, tokens: Column, most_tokens: int = 512, characters: int = 2048) -> Column:
    """The first characters of a text of more than ``most_tokens`` tokens, else the text."""
    return F.when(tokens > most_tokens, F.substring(c, 1, characters)).otherwise(c)


def truncate_prompt(c: Column, most: int = 256) -> Column:
    """A prompt of over ``most`` characters is cut there, taken back to its last blank if it has one, and given dots."""
    cut = F.substring(c, 1, most)
    return F.when(F.length(c) > most, F.concat(F.regexp_replace(cut, r"(?s) [^ ]*\z", ""), F.lit("..."))).otherwise(c)


def pieces(c: Column) -> Column:
    """All pieces of a text in order; together they are the text."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(PIECE), F.lit(0))
