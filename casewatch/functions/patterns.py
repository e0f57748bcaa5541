"""Ordered pattern classification and the short disease name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from casewatch.functions.text import ASCII_WS_CLASS, trim_ws
from casewatch.reference_data import DISEASE_MODIFIERS, SHORT_NAME_STRIP_RULES


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def match_first(c: Column | str, rules: Sequence[tuple[str, str]], default: str | None = "N/A",
                kind: str = "contains") -> Column:
    """Label of the first (pattern, label) whose pattern occurs in `c`.

    kind='contains' tests anywhere in the text, kind='prefix' only at the start.
    A null input gets the default, as a failed match does.
    """
    c = _col(c)
    test = {"contains": c.contains, "prefix": c.startswith}[kind]
    out = None
    for pattern, label in rules:
        out = F.when(test(F.lit(pattern)), label) if out is None else out.when(test(F.lit(pattern)), label)
    return out.otherwise(default)


def modifier_regex(modifiers: Sequence[str] = DISEASE_MODIFIERS) -> str:
    return "[,-]?" + ASCII_WS_CLASS + "*(" + "|".join(modifiers) + ")"


def short_name(c: Column | str) -> Column:
    """Group prefix (or ', INVASIVE DISEASE') removed, modifiers removed, trimmed, spaces collapsed."""
    c = _col(c)
    stripped = None
    for prefix, text in SHORT_NAME_STRIP_RULES:
        cond = c.startswith(F.lit(prefix))
        value = F.replace(c, F.lit(text), F.lit(""))
        stripped = F.when(cond, value) if stripped is None else stripped.when(cond, value)
    stripped = stripped.otherwise(c)
    bare = F.regexp_replace(stripped, modifier_regex(), "")
    return F.regexp_replace(trim_ws(bare), ASCII_WS_CLASS + "+", " ")
