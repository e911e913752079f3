"""Text expressions with Unicode-aware classes that the JVM evaluates inside whole-stage code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as the interpreter's ``str.split`` sees it, as a Java class.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"


def prose_signature(c: Column) -> Column:
    """White space collapsed to single blanks and trimmed."""
    return F.trim(F.regexp_replace(c, SPACE + "+", " "))


def words(c: Column) -> Column:
    """White-space separated tokens without empty ones."""
    return F.filter(F.split(c, SPACE + "+"), lambda w: w != "")


def code_signature(c: Column) -> Column:
    """Lines without leading blanks and tabs, line ends kept."""
    return F.regexp_replace(c, r"(?md)^[ \t]+", "")


def similarity_milli(a: Column, b: Column) -> Column:
    """Edit similarity in thousandths, rounded down; two empty texts are equal."""
    longest = F.greatest(F.length(a), F.length(b))
    distance = F.when(a == b, 0).otherwise(F.levenshtein(a, b))
    return F.when(longest == 0, F.lit(1000)).otherwise(F.floor((longest - distance) * 1000 / longest)).cast("bigint")


def locator_tokens(c: Column) -> Column:
    """Lower-case tokens that locate a text in a source: alphanumeric runs and operators."""
    text = F.replace(F.replace(F.lower(c), F.lit("≥"), F.lit(">=")), F.lit("≤"), F.lit("<="))
    return F.regexp_extract_all(text, F.lit(r"([a-z0-9]+|>=|<=|//|\\\\|[+*/=<>^-])"), F.lit(1))


def ngrams(tokens: Column, size: int = 3) -> Column:
    """Distinct runs of ``size`` tokens, joined by a unit separator; empty for shorter lists."""
    n = F.size(tokens) - F.lit(size) + 1
    runs = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.array_join(F.slice(tokens, i, F.lit(size)), "\x1f"))
    return F.when(n > 0, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))
