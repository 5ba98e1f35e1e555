"""Regular expressions that mean the same in Spark (Java), DuckDB (RE2) and Python.

The text rules of this engine are defined over Unicode: white space, digits and
word characters are spelled as classes here, because the engines' short forms
differ. A list of rules can be applied to a column or rendered as SQL, which is
how the queries and their oracles stay one definition.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space, as a class body and as a class.
WS_BODY = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS = f"[{WS_BODY}]"
NOT_WS = f"[^{WS_BODY}]"
DIGIT = r"\p{Nd}"
WORD = r"[\p{L}\p{N}_]"
MYANMAR = r"\x{1000}-\x{109f}"


@dataclass(frozen=True)
class Rule:
    """Replace every match; groups are written \\1 in ``to``."""

    pattern: str
    to: str = ""


def java(pattern: str) -> str:
    """Flags widened to Unicode letters and to newlines as the only line ends."""
    return pattern.replace("(?i)", "(?iu)").replace("(?m)", "(?md)")


def python(pattern: str) -> str:
    """The same for Python's re."""
    pattern = re.sub(r"\\x\{([0-9a-fA-F]+)\}", lambda m: f"\\U{int(m[1], 16):08x}", pattern)
    return pattern.replace(r"\z", r"\Z").replace(r"\p{Nd}", r"\d")


def compiled(rules: list[Rule]) -> list[tuple[re.Pattern, str]]:
    return [(re.compile(python(r.pattern)), r.to) for r in rules]


def _java_to(to: str) -> str:
    out = to.replace("$", "\\$")
    for k in range(1, 10):
        out = out.replace(f"\\{k}", f"${k}")
    return out


def apply(col: Column, rules: list[Rule]) -> Column:
    for r in rules:
        col = F.regexp_replace(col, java(r.pattern), _java_to(r.to))
    return col


def matches(col: Column, pattern: str) -> Column:
    return col.rlike(java(pattern))


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql(expr: str, rules: list[Rule]) -> str:
    """The same as ``apply``, for DuckDB."""
    for r in rules:
        expr = f"regexp_replace({expr}, {quoted(r.pattern)}, {quoted(r.to)}, 'g')"
    return expr


#: Removes white space at both ends.
STRIP = [Rule(rf"\A{WS}+", ""), Rule(rf"{WS}+\z", "")]


def strip(col: Column) -> Column:
    return apply(col, STRIP)


def let(col: Column, body) -> Column:
    """body(x) with x bound to the column's value, so that it is computed once however often body names it."""
    return F.transform(F.array(col), body)[0]


#: Letters that match s, k, i and i where case is ignored.
FOLDED = "\u017f\u212a\u0130\u0131"


def fold(text: Column) -> Column:
    """Lower case for a look at which words occur: also of the letters that only case folding maps to ASCII."""
    return F.lower(F.translate(text, FOLDED, "skii"))


def where_found(col: Column, words: list[str], rules: list[Rule]) -> Column:
    """``apply`` for texts that hold one of the (lower-case) words; a plain search is far cheaper than a pattern that can't match."""

    def body(t: Column) -> Column:
        low, found = fold(t), F.lit(False)
        for w in words:
            found = found | F.contains(low, F.lit(w))
        return F.when(found, apply(t, rules)).otherwise(t)

    return let(col, body)
