"""String predicates and cleaners."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values ----
# Characters Python's str.strip()/str.isspace() treat as whitespace, as a regex class usable by
# Java regex and RE2 alike. SQL trim() removes spaces only, so it cannot stand in for strip().
PY_WHITESPACE = (r"[\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                 r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# Header keywords (matched as substrings of the lower-cased header text).
QA_INPUT_KEYWORDS = ("質問", "question", "prompt", "input")
QA_OUTPUT_KEYWORDS = ("回答", "answer", "response", "output")
TEXT_KEYWORDS = ("本文", "原文", "解説", "text")
# Snapshot folder names: exactly eight digits (YYYYMMDD).
SNAPSHOT_PATTERN = "^[0-9]{8}$"
# Result-log timestamp format.
RESULT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# ---- end of fixed values ----

STRIP_PATTERN = f"^{PY_WHITESPACE}+|{PY_WHITESPACE}+$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Python ``str.strip()`` semantics (Unicode whitespace, incl. U+001C-U+001F)."""
    return F.regexp_replace(_c(c), STRIP_PATTERN, "")


def contains_any(c, keywords: Sequence[str]) -> Column:
    """lower-cased text contains any of the keywords."""
    low = F.lower(_c(c))
    cond = None
    for k in keywords:
        e = F.contains(low, F.lit(k.lower()))
        cond = e if cond is None else cond | e
    return cond


def strip_echo(generated, prompt) -> Column:
    """F8: when the output starts with the prompt, drop the prompt and strip whitespace."""
    g, p = _c(generated), _c(prompt)
    rest = F.substring(g, F.length(p) + 1, 2147483647)
    return F.when(F.startswith(g, p), py_strip(rest)).otherwise(g)


def result_time(ts) -> Column:
    """timestamp text of a result row."""
    return F.date_format(_c(ts), RESULT_TIME_FORMAT)


def is_snapshot(c) -> Column:
    """P10: full match of eight digits."""
    return F.coalesce(_c(c).rlike(SNAPSHOT_PATTERN), F.lit(False))
