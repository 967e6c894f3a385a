"""Read physical plans the way a Spark user does: through ``DataFrame.explain``.

Used by the plan tests (A2, A4, S7) and the bench to confirm that aggregation is
combined map-side, filters reach the Parquet scan, and no Python worker runs.
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonMapInArrow")


def plan_string(df: DataFrame, mode: str = "simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def _physical_lines(df: DataFrame) -> list[str]:
    return [ln for ln in plan_string(df).splitlines() if ln.strip() and not ln.startswith("==")]


def exchanges(df: DataFrame) -> list[str]:
    """Shuffle exchanges of the plan (broadcasts excluded), top first."""
    return [ln.strip(" +-:") for ln in _physical_lines(df) if re.search(r"\bExchange (hash|range|RoundRobin|Single)", ln)]


def partial_aggregate_below_exchange(df: DataFrame) -> bool:
    """True when some hash exchange sits directly on a partial aggregate (map-side combine)."""
    lines = _physical_lines(df)
    for i, ln in enumerate(lines[:-1]):
        if "Exchange hashpartitioning" in ln and "partial_" in lines[i + 1] and "Aggregate" in lines[i + 1]:
            return True
    return False


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", plan_string(df))


def python_nodes(df: DataFrame) -> list[str]:
    text = plan_string(df)
    return [n for n in PYTHON_NODES if n in text]
