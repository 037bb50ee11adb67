"""Chat history windows, message intents and agent-trace rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.text import intent_labels, json_in_text
from tickloom.operators.latest import newest_n
from tickloom.vocab import CHAT_TURNS

CONTEXT = (
    "symbol string, supervisor_decision array<string>, supervisor_reason string, "
    "tools_used array<string>, agents_called array<string>, provider string"
)


def chat_window(df: DataFrame, session: str, order: list[str], turns: int = CHAT_TURNS) -> DataFrame:
    """Newest 2*turns messages per session, a session's together and oldest first (`order` ends with a unique tie-break)."""
    return _by_session(newest_n(df, [session], order, 2 * turns), session, order)


def chat_history(df: DataFrame, session: str, order: list[str]) -> DataFrame:
    """Messages of every session, a session's together and oldest first."""
    return _by_session(df, session, order)


def _by_session(df: DataFrame, session: str, order: list[str]) -> DataFrame:
    """Rows in order over all tasks: ranges of (session, order), so a session with most of the rows lies on several of them."""
    return df.repartitionByRange(session, *order).sortWithinPartitions(session, *order)


def with_intents(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("labels", intent_labels(F.col(text)))


def with_context(df: DataFrame, column: str = "context_summary") -> DataFrame:
    """Unpack the JSON summary an assistant message carries."""
    return df.withColumn("context", json_in_text(F.col(column), CONTEXT))


def trace_rollup(df: DataFrame) -> DataFrame:
    """Runs, distinct agents and tools and durations per session.

    Names are reduced to distinct (session, kind, name) rows before they are listed, so a busy
    session ships its few distinct names and not its runs.
    """
    runs = df.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.sum("duration_ms").alias("total_ms"),
        F.avg("duration_ms").alias("avg_ms"),
    )
    kinds = F.array(
        F.struct(F.lit("agents").alias("kind"), F.col("agents_called").alias("names")),
        F.struct(F.lit("tools").alias("kind"), F.col("tools_used").alias("names")),
    )
    names = (
        df.select("session_id", F.inline(kinds))
        .select("session_id", "kind", F.explode("names").alias("name"))
        .distinct()
        .groupBy("session_id")
        .agg(
            *[
                F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.col("name")))).alias(k)
                for k in ("agents", "tools")
            ]
        )
    )
    none = F.array().cast("array<string>")
    return runs.join(names, "session_id", "left").withColumns(
        {k: F.coalesce(k, none) for k in ("agents", "tools")}
    )
