"""Query plans as text, for reading and for tests."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain(mode)`` prints; ``"extended"`` shows the unoptimized plan as well."""
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        df.explain(mode=mode)
    return shown.getvalue()


def plan_lines(df: DataFrame, name: str) -> list[str]:
    """The values of an attribute such as ``PushedFilters`` or ``ReadSchema`` in the plan."""
    return re.findall(rf"^{name}: (.*)$", plan_text(df), flags=re.MULTILINE)


def operator_count(df: DataFrame, operator: str) -> int:
    """How often an operator such as ``Exchange`` occurs in the physical plan's tree."""
    tree = plan_text(df, "simple")
    return len(re.findall(rf"[-+:\s*()0-9]{operator}\b", tree))
