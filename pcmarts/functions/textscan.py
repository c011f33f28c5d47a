"""Find lines of free text that carry SQL structure (not just a word like "where" or "join").

A line counts if it holds one clause-shaped pattern, or, unless it opens like a prose instruction,
at least two different SQL keywords together with one structural sign.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

_F = "(?iU)"  # ignore case; letters and word boundaries of every language

# Clause shapes; one is enough.
CLAUSES = (
    r"\bSELECT\b[^.]*?\bFROM\b",
    r"\bFROM\s+[`\"\w.]+\s+(?:AS\s+\w+|WHERE|JOIN|GROUP|ORDER|HAVING|LIMIT)\b",
    r"\bJOIN\s+[`\"\w.]+\s+ON\b",
    r"\bWHERE\s+[`\"\w.]+\s*(?:=|<>|!=|<=|>=|<|>|\bLIKE\b|\bIN\s*\()",
    r"\bGROUP\s+BY\s+[`\"\w.]+(?:\s*,\s*[`\"\w.]+)*\s+(?:\bHAVING\b|\bORDER\s+BY\b|\bLIMIT\b)",
    r"\bORDER\s+BY\s+[`\"\w.]+(?:\s*,\s*[`\"\w.]+)*\s+(?:\bASC\b|\bDESC\b|\bLIMIT\b)",
    r"\bHAVING\s+(?:SUM|COUNT|AVG|MAX|MIN|STDDEV|VARIANCE)\s*\(",
)

# Openings of a prose instruction, after an optional bullet.
PROSE = (
    "^\\s*[-*•]?\\s*(?:Do\\s+not|Don['’]t|Never|Always|When|If|Prefer|Avoid|Combine|Link|Pair|Associate|"
    "Consider|Note)\\b"
)

# Keywords, and the structural signs of which one must be present.
KEYWORDS = r"\b(SELECT|WHERE|JOIN|GROUP\s+BY|ORDER\s+BY|HAVING)\b"
SIGNS = (
    r"[`\"]?\w+[`\"]?\.[`\"]?\w+[`\"]?",
    r"(?:=|<>|!=|<=|>=|\bLIKE\b|\bIN\s*\(|\bBETWEEN\s+\w+)",
    r"\b(?:SUM|COUNT|AVG|MAX|MIN|STDDEV|VARIANCE)\s*\(",
    r"\bIS\s+(?:NOT\s+)?NULL\b",
)

LINE_BREAK = "\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085\u2028\u2029]"


def _any(line: Column, patterns: tuple[str, ...]) -> Column:
    return reduce(or_, [line.rlike(_F + p) for p in patterns])


ANY_WORD = _F + r"\b(?:SELECT|FROM|WHERE|JOIN|GROUP|ORDER|HAVING)\b"  # every clause and keyword has one of these


def is_sql(line: Column) -> Column:
    """Most lines have none of the words: they cost one pattern instead of all."""
    words = F.regexp_extract_all(line, F.lit(_F + KEYWORDS), F.lit(1))
    dense = F.size(F.array_distinct(F.transform(words, lambda w: F.upper(w)))) >= 2
    return line.rlike(ANY_WORD) & (_any(line, CLAUSES) | (~line.rlike(_F + PROSE) & dense & _any(line, SIGNS)))


def sql_lines(text: Column | str) -> Column:
    """The offending lines of a text, in order. A text without any keyword is not split at all."""
    text = F.col(text) if isinstance(text, str) else text
    some = text.rlike(ANY_WORD)
    found = F.filter(F.split(text, LINE_BREAK), is_sql)
    return F.when(some, found).otherwise(F.array().cast("array<string>"))
