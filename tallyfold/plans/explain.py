"""Plan inspection: the formatted physical plan as text, node counts."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def count_nodes(df: DataFrame, name: str, mode: str = "simple") -> int:
    """How often a physical operator (e.g. ``Exchange``) appears in the plan."""
    return len(re.findall(rf"\b{re.escape(name)}\b", plan_text(df, mode)))


def summarize(df: DataFrame) -> dict[str, object]:
    """Shape of the physical plan: shuffles, join strategies, windows,
    aggregates, and what reached the parquet scans."""
    text = plan_text(df, "simple")
    exchanges = re.findall(r"Exchange (\w+)\(", text)
    return {
        "shuffles": len(re.findall(r"\bExchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", text)),
        "shuffle_kinds": sorted(set(exchanges)),
        "broadcasts": text.count("BroadcastExchange"),
        "joins": sorted(set(re.findall(r"(\w+Join) (?:\[[^\]]*\], \[[^\]]*\], )?(\w+)", text))),
        "windows": len(re.findall(r"\bWindow \[", text)),
        "window_group_limit": "WindowGroupLimit" in text,
        "expand": "Expand [" in text,
        "bucketed_scans": text.count("Bucketed: true"),
        "pushed_filters": sorted(set(f for f in re.findall(r"PushedFilters: \[([^\]]*)\]", text) if f)),
        "written_tables": bool(re.search(r"tallyfold_|_bucketed_|/tallyfold/", text)),
    }
