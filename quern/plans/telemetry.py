"""Workload telemetry: captured events and statement statistics as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.numeric import whole_average
from quern.functions.statements import statement_template
from quern.functions.text import normalized_statement
from quern.functions.xml import event_field, parse_event
from quern.operators.joins import apply_keyed

# Event names, and the field that holds the text of each.
BATCH_EVENT = "sql_batch_completed"
CALL_EVENT = "rpc_completed"
TEXT_FIELDS = {BATCH_EVENT: "batch_text", CALL_EVENT: "statement"}
# Measures of an event.
MEASURES = ("duration", "physical_reads", "logical_reads", "cpu_time")
HASHES = ("query_hash", "query_plan_hash")


def by_event(name: Column, texts: dict[str, Column]) -> Column:
    """Pick the expression that belongs to the event name, else NULL."""
    choice = None
    for event, text in texts.items():
        hit = name == event
        choice = F.when(hit, text) if choice is None else choice.when(hit, text)
    return choice


def shred_events(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Typed columns from event documents; a missing node gives NULL."""
    return shred_parsed(payloads.select(parse_event(F.col(payload)).alias("event")))


def shred_parsed(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns from parsed documents in column ``event``; ``keep`` passes others."""
    event = F.col("event")
    name = event["_name"]
    return events.select(
        name.alias("event_name"),
        *[event_field(event, m, "bigint").alias(m) for m in MEASURES],
        by_event(
            name, {e: event_field(event, f) for e, f in TEXT_FIELDS.items()}
        ).alias("sql_text"),
        *[event_field(event, h, "binary").alias(h) for h in HASHES],
        *keep,
    )


def workload_rollup(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Executions, summed measures, and the average duration per group."""
    return events.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("executions"),
        F.sum("duration").alias("duration_total"),
        F.sum("cpu_time").alias("cpu_total"),
        F.sum("logical_reads").alias("logical_total"),
        F.sum("physical_reads").alias("physical_total"),
        whole_average(F.col("duration")).alias("duration_avg"),
    )


def cost_with_text(
    stats: DataFrame, key: str, sums: dict[str, Column], texts: DataFrame, on: Column
) -> DataFrame:
    """Sum per key first, then attach the text of each key."""
    totals = stats.groupBy(key).agg(*[a.alias(n) for n, a in sums.items()])
    return apply_keyed(totals, texts, on)


def plan_hash_rollup(
    stats: DataFrame, hash_key: str, member: Sequence[str], sums: dict[str, Column]
) -> DataFrame:
    """Sums per hash, repeated on every member of the hash.

    The aggregate has one row per hash, so the join emits one row per member.
    """
    totals = stats.groupBy(hash_key).agg(*[a.alias(n) for n, a in sums.items()])
    return stats.select(hash_key, *member).join(totals, hash_key)


def statement_templates(statements: DataFrame, text: str) -> DataFrame:
    """Statements that differ only in literals, case and spacing count as one."""
    return (
        statements.select(normalized_statement(F.col(text)).alias("template"))
        .groupBy("template")
        .agg(F.count(F.lit(1)).alias("executions"))
        .select(F.md5("template").alias("fingerprint"), "template", "executions")
    )


def template_rollup(statements: DataFrame, text: str) -> DataFrame:
    """Executions and different texts per statement template.

    Equal texts are counted first, so each is cut into tokens once, and a frequent one
    is combined map-side.
    """
    per_text = statements.groupBy(F.col(text).alias("text")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        per_text.select(statement_template(F.col("text")).alias("template"), "n")
        .groupBy("template")
        .agg(F.sum("n").alias("executions"), F.count(F.lit(1)).alias("texts"))
        .select(F.md5("template").alias("fingerprint"), "template", "executions", "texts")
    )


def blocking_pairs(
    waiters: DataFrame, blockers: DataFrame, texts: DataFrame
) -> DataFrame:
    """Each waiting request with its blocker and the blocker's text, if known.

    ``waiters`` has ``waiter_id`` and ``blocker_ref``; ``blockers`` has
    ``blocker_id`` and ``text_ref``; ``texts`` has ``text_id`` and
    ``blocker_text``.
    """
    found = apply_keyed(
        waiters, blockers, F.col("blocker_ref") == F.col("blocker_id"), True
    )
    return apply_keyed(found, texts, F.col("text_ref") == F.col("text_id"), True)
