"""Text expressions with the semantics of Python's str: Unicode white space, printability, strip, split."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: What str.isspace() takes; as a class of few parts, since each part costs a test a character and an alternation a search by branches.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE, INK = r"[\x1c\x1d\x1e\x1f\p{IsWhite_Space}]", r"[^\x1c\x1d\x1e\x1f\p{IsWhite_Space}]"
OTHER_SPACE = r"[\x1c\x1d\x1e\x1f\p{IsWhite_Space}&&[^ ]]"
UNPRINTABLE = r"[\p{C}\p{Z}&&[^ ]]"
#: Digits that Python's isdigit() takes besides the decimal ones.
MORE_DIGITS = (
    r"\x{b2}\x{b3}\x{b9}\x{1369}-\x{1371}\x{19da}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247c}\x{2488}-\x{2490}"
    r"\x{24ea}\x{24f5}-\x{24fd}\x{24ff}\x{2776}-\x{277e}\x{2780}-\x{2788}\x{278a}-\x{2792}"
)
#: Marks that may stand around a number, and those that may stand in it.
NUMBER_EDGE = r"[()\[\].,%$:/+\-]"
DIGIT, INNER = rf"[\p{{Nd}}{MORE_DIGITS}]", rf"[\p{{Nd}}{MORE_DIGITS},./]"
NUMBER = f"^{NUMBER_EDGE}*+{DIGIT}(?:{INNER}*{DIGIT})?{NUMBER_EDGE}*+$"
#: A token from its first character that is no letter on, with the letter before it.
ODD = rf"\p{{L}}?+[^\p{{L}}\x1c\x1d\x1e\x1f\p{{IsWhite_Space}}]{INK}*+"
#: A letter beside a digit; it looks for the digit first, which is rare.
GARBLED = r"\p{Nd}(?:(?=[A-Za-z])|(?<=[A-Za-z]\p{Nd}))"
RUN = r"(?d)(.)\1{6,}"


def tokens(text: Column) -> Column:
    """The white-space separated pieces of text; null for null."""
    plain = F.replace(text, F.lit("\n"), F.lit(" "))
    return F.array_remove(F.when(plain.rlike(OTHER_SPACE), F.split(text, f"{SPACE}+")).otherwise(F.split(plain, " ")), "")


def on_one_line(text: Column) -> Column:
    """text with spaces for line feeds, and none at its ends."""
    return F.btrim(F.replace(text, F.lit("\n"), F.lit(" ")))


def ink(line: Column) -> Column:
    """The characters of the tokens of on_one_line(), where single spaces alone part them; else null. They are then counted without a split."""
    return F.when(~line.contains("  ") & ~line.rlike(OTHER_SPACE), F.length(F.replace(line, F.lit(" "), F.lit(""))))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def odd_tokens(text: Column) -> Column:
    """Of each token that isn't of letters only, what begins at its first other character, with the letter before it.

    Numbers come whole, and a letter beside a digit with both. These tokens are few, so what asks for numbers or garbled tokens looks at
    them alone.
    """
    return F.regexp_extract_all(text, F.lit(ODD), F.lit(0))


def is_number(odd: Column) -> Column:
    """Whether an odd token is a number with the usual marks in and around it."""
    return odd.rlike(NUMBER)


def printable_length(text: Column) -> Column:
    return F.length(F.regexp_replace(text, UNPRINTABLE, ""))


def has_run(text: Column) -> Column:
    """Whether one character, but the line feed, stands seven or more times in a row."""
    return text.rlike(RUN)


def suffix(path: Column) -> Column:
    """Lower-case suffix with its dot; empty without one."""
    return F.lower(F.regexp_extract(name(path), r"^.+(\.[^.]+)$", 1))


def name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def stem(path: Column) -> Column:
    """The name without its last suffix."""
    return F.regexp_replace(name(path), r"(?<=.)\.[^.]+$", "")


def collapsed(text: Column) -> Column:
    """text with white space as single spaces."""
    return F.array_join(tokens(text), " ")
