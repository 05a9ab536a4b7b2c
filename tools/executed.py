"""What a query really ran: scans and exchanges of its final plan, each counted once."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame


def _run_nodes(df: DataFrame) -> list:
    """``(kind, node)`` of the plan after the run, subqueries included; what was reused stands where it was made."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.collect()
    system = df.sparkSession._jvm.java.lang.System
    found, seen = [], set()

    def walk(node) -> None:
        here = system.identityHashCode(node)
        if here in seen:
            return
        seen.add(here)
        kind = node.getClass().getSimpleName()
        if kind.startswith("Reused"):
            return
        found.append((kind, node))
        inside = []
        if kind == "AdaptiveSparkPlanExec":
            inside.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            inside.append(node.plan())
        for part in (node.children(), node.subqueries()):
            inside += [part.apply(i) for i in range(part.size())]
        for each in inside:
            walk(each)

    walk(plan)
    return found


def executed_nodes(df: DataFrame) -> Counter:
    """Operators of the plan after the run, subqueries included; what was reused counts where it was made.

    The DataFrame is run by this call.
    """
    return Counter(kind for kind, _ in _run_nodes(df))


def broadcast_rows(df: DataFrame) -> int:
    """Rows that passed the driver in broadcasts. The DataFrame is run by this call."""
    return sum(node.metrics().apply("numOutputRows").value() for kind, node in _run_nodes(df) if kind == "BroadcastExchangeExec")
