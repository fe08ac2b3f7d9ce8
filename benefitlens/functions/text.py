"""Text helpers: Python-like strip/title semantics and screening patterns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() removes any whitespace, Spark's trim() only blanks.
_WS_CLASS = r"[\s\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_WS = rf"^{_WS_CLASS}+|{_WS_CLASS}+$"


def py_strip(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(col, _WS, "")


def word_boundary_alternation(words) -> str:
    """One regex for 'any of these whole words' with Unicode-aware boundaries.

    Python's ``\\b`` treats any letter or digit as a word character; this
    pattern states that explicitly so the JVM engine agrees on non-ASCII text.
    """
    alt = "|".join(re.escape(w) for w in words)
    return rf"(?<![\p{{L}}\p{{N}}_])(?:{alt})(?![\p{{L}}\p{{N}}_])"


def any_pattern(patterns) -> str:
    return "|".join(f"(?:{p})" for p in patterns)
