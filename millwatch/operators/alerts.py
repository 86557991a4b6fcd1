"""Alert rules, cool-down, life cycle, statistics and paging."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millwatch.functions.scores import health_status
from millwatch.plans.slices import HOT_ROWS, epoch_us, lookback
from millwatch.plans.storage import written
from millwatch.schemas import SEVERITIES
from millwatch.session import ship

COOLDOWN_SECONDS = 300
PAGE_SIZE = 100


@dataclass(frozen=True)
class AlertRule:
    """A named condition. ``condition`` is SQL over the record's columns, or a Column."""

    name: str
    condition: str | Column
    severity: str
    description: str
    source: str
    enabled: bool = True
    cooldown_seconds: int = COOLDOWN_SECONDS

    def __post_init__(self):
        if self.severity not in SEVERITIES:
            raise ValueError(f"Unknown severity: {self.severity}")

    def fires(self) -> Column:
        held = F.expr(self.condition) if isinstance(self.condition, str) else self.condition
        return F.coalesce(held, F.lit(False))


# The standard maintenance rules and the host rules.
MAINTENANCE_RULES = [
    AlertRule("anomaly_detected", "is_anomaly AND anomaly_confidence > 0.8", "warning",
              "Anomaly detected in sensor data", "anomaly_detector"),
    AlertRule("critical_health", "health_score < 0.2", "critical", "Equipment health is critical", "health_scorer"),
    AlertRule("failure_predicted", "failure_probability > 0.8", "error", "Equipment failure predicted", "failure_predictor"),
    AlertRule("model_performance_degraded", "model_accuracy < 0.7", "warning",
              "Model performance has degraded", "model_monitor"),
]
HOST_RULES = [
    AlertRule("High CPU Usage", "metric = 'cpu_percent' AND value > 80", "warning", "CPU usage is {value}%", "system_monitor"),
    AlertRule("High Memory Usage", "metric = 'memory_percent' AND value > 90", "critical", "Memory usage is {value}%",
              "system_monitor"),
]
RULE_FIELDS = {
    "is_anomaly": "boolean", "anomaly_confidence": "double", "health_score": "double",
    "failure_probability": "double", "model_accuracy": "double",
}


def rule_alerts(df: DataFrame, row_id: str, rules: Sequence[AlertRule] = MAINTENANCE_RULES,
                keep: Sequence[str] = ("equipment_id",)) -> DataFrame:
    """One alert per record and enabled rule that holds; a missing field never fires.

    The id joins source, epoch second, rule and row, so that no alert overwrites another.
    """
    absent = {c: F.lit(None).cast(t) for c, t in RULE_FIELDS.items() if c not in df.columns}
    source = df.withColumns(absent) if absent else df
    active = [rule for rule in rules if rule.enabled]
    second = F.floor(epoch_us(F.col("timestamp")) / 1_000_000).cast("string")

    def alert(rule: AlertRule) -> Column:
        return F.when(rule.fires(), F.struct(
            F.concat_ws("_", F.lit(rule.source), second, F.lit(rule.name), F.col(row_id).cast("string")).alias("alert_id"),
            F.lit(rule.name).alias("rule"), F.lit(f"Rule Triggered: {rule.name}").alias("title"),
            F.lit(rule.description).alias("description"), F.lit(rule.severity).alias("severity"),
            F.lit(rule.source).alias("source"), F.lit(rule.cooldown_seconds).alias("cooldown_seconds"),
        ))

    raised = F.filter(F.array(*[alert(rule) for rule in active]), lambda a: a.isNotNull())
    return source.select(row_id, "timestamp", *keep, F.inline(raised)).withColumn("status", F.lit("active"))


def metric_alerts(df: DataFrame, row_id: str, rules: Sequence[AlertRule] = HOST_RULES) -> DataFrame:
    """Host rules over rows (timestamp, metric, value); the text carries the value."""
    out = rule_alerts(df, row_id, rules, keep=["metric", "value"])
    text = F.replace("description", F.lit("{value}"), F.col("value").cast("string"))
    return out.withColumns({"title": F.col("rule"), "description": text})


# --- cool-down --------------------------------------------------------------------


#: Maps that one step of the scan joins.
FAN = 64
_NEVER = np.iinfo(np.int64).min


def _last_fired(at: np.ndarray, gap: int) -> np.ndarray:
    """For each instant: the last firing inside the slice if that instant fires.

    Every instant points to the first one a full gap later; the pointers are followed by
    doubling.
    """
    n = len(at)
    jump = np.append(np.searchsorted(at, at + gap, side="left"), n)
    stop = np.append(np.arange(n), n)
    while True:
        inside = jump[:n] < n
        if not inside.any():
            return at[stop[:n]]
        stop[:n] = np.where(inside, stop[jump[:n]], stop[:n])
        jump = jump[jump]


class EntryMap(NamedTuple):
    """What a stretch of time makes of the instant from which an alert may fire: "up to here, the last firing is there".

    From an instant beyond the last of ``upto`` nothing fires. Chains of firings soon meet, so there are
    few pieces; at most one for each instant of the first gap, as nothing later can be the first to fire.
    """

    upto: np.ndarray
    last: np.ndarray

    @classmethod
    def of(cls, at: np.ndarray, gap: int) -> EntryMap:
        # A firing before the slice lets the next follow less than a gap after the slice's first instant.
        upto = int(np.searchsorted(at, at[0] + gap, side="left")) + 1
        return cls(at[:upto], _last_fired(at, gap)[:upto]).folded()

    def folded(self) -> EntryMap:
        ends = np.append(self.last[1:] != self.last[:-1], True)[:len(self.last)]
        return EntryMap(self.upto[ends], self.last[ends])

    def leave(self, entry: np.ndarray, gap: int) -> np.ndarray:
        """The instant from which an alert may fire after the stretch."""
        at = np.searchsorted(self.upto, entry, side="left")
        fires = at < len(self.upto)
        return np.where(fires, np.append(self.last, 0)[at] + gap, entry)

    def then(self, after: EntryMap, gap: int) -> EntryMap:
        """Both stretches as one."""
        own = after.leave(self.last + gap, gap) - gap
        late = np.searchsorted(after.upto, self.upto[-1] if len(self.upto) else _NEVER, side="right")
        return EntryMap(np.append(self.upto, after.upto[late:]), np.append(own, after.last[late:])).folded()


def _maps(pdf: pd.DataFrame) -> list[EntryMap]:
    return [EntryMap(np.asarray(u, "int64"), np.asarray(v, "int64")) for u, v in zip(pdf["_upto"], pdf["_last"])]


def _named(scope: Sequence[str], key: tuple, **columns) -> pd.DataFrame:
    out = pd.DataFrame(columns)
    return out.assign(**dict(zip(scope, key)))


def _slice_maps(scope: Sequence[str]):
    """Per slice: its map."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        gap = int(pdf["_gap"].iloc[0])
        made = EntryMap.of(np.sort(pdf["_at"].to_numpy()), gap)
        return _named(scope, key, _node=[int(key[-1])], _gap=[gap], _upto=[made.upto], _last=[made.last])
    return run


def _joined_maps(scope: Sequence[str]):
    """Per ``FAN`` neighbours: one map."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, gap = pdf.sort_values("_node"), int(pdf["_gap"].iloc[0])
        maps = _maps(pdf)
        made = maps[0]
        for m in maps[1:]:
            made = made.then(m, gap)
        return _named(scope, key, _node=[int(key[-1])], _gap=[gap], _upto=[made.upto], _last=[made.last])
    return run


def _entries(scope: Sequence[str]):
    """Per ``FAN`` neighbours and the instant from which the first may fire: that of each."""
    def run(key: tuple, pdf: pd.DataFrame, entered: pd.DataFrame) -> pd.DataFrame:
        pdf, rows = pdf.sort_values("_node"), []
        entry = int(entered["_earliest"].iloc[0]) if len(entered) else _NEVER
        for node, gap, m in zip(pdf["_node"], pdf["_gap"], _maps(pdf)):
            rows.append((int(node), entry))
            entry = int(m.leave(np.array([entry]), int(gap))[0])
        return _named(scope, key, _node=[n for n, _ in rows], _earliest=[e for _, e in rows])
    return run


def _firings(scope: Sequence[str]):
    """Per slice, given its earliest instant: the instants that fire."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        at, gap = np.sort(pdf["_at"].to_numpy()), int(pdf["_gap"].iloc[0])
        fired, earliest = [], int(pdf["_earliest"].iloc[0])
        i = int(np.searchsorted(at, earliest, side="left"))
        while i < len(at):
            fired.append(at[i])
            i = int(np.searchsorted(at, at[i] + gap, side="left"))
        return _named(scope, key[:len(scope)], _at=np.array(fired, dtype="int64"))
    return run


def cooldown(alerts: DataFrame, scope: Sequence[str] = ("rule",), order: Sequence[str] = ("timestamp", "alert_id"),
             seconds: int | str = COOLDOWN_SECONDS) -> DataFrame:
    """Alerts left when a rule stays silent for ``seconds`` after each alert it raises.

    The rule is greedy in time, so it looks sequential over all alerts of a rule. It is a parallel scan
    instead. Instants are dealt by ranges of rule and time, so dense times make more slices, not larger
    ones. Each slice is reduced to a map from the instant at which it is entered to that at which it is left;
    maps of ``FAN`` neighbours are composed, level by level, until one is left of each rule; going down again,
    every slice learns its entry and emits its own firings. ``seconds`` may name a column with the
    rule's value. An alert exactly ``seconds`` after the last one fires.
    """
    scope, order = list(scope), list(order)
    spark = ship(alerts.sparkSession)
    gap = (F.col(seconds) if isinstance(seconds, str) else F.lit(seconds)).cast("long") * 1_000_000
    # Of several alerts at one instant only the first can fire; it is carried whole, so the
    # alerts are computed once.
    instants = (
        alerts.groupBy(*scope, epoch_us(F.col(order[0])).alias("_at"), gap.alias("_gap"))
        .agg(F.min_by(F.struct(*alerts.columns), F.struct(*order)).alias("_alert"))
    )
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The steps read them several times: a written table keeps one cut into slices.
    instants = written(instants.repartitionByRange(slices, *scope, "_at").withColumn("_node", F.spark_partition_id().cast("long")), "instants")
    bare = instants.select(*scope, "_node", "_at", "_gap")
    kinds = [alerts.schema[c] for c in scope]

    def shape(*fields: T.StructField | str) -> T.StructType:
        return T.StructType([*[T.StructField(f, T.LongType()) if isinstance(f, str) else f for f in fields], *kinds])

    lists = [T.StructField(f, T.ArrayType(T.LongType())) for f in ("_upto", "_last")]
    up = F.floor(F.col("_node") / FAN).cast("long").alias("_node")
    levels = [written(bare.groupBy(*scope, "_node").applyInPandas(_slice_maps(scope), shape("_node", "_gap", *lists)), "cooldown-maps")]
    span = slices
    while span > FAN:
        made = levels[-1].groupBy(*scope, up.alias("_above")).applyInPandas(_joined_maps(scope), shape("_node", "_gap", *lists))
        levels.append(written(made, "cooldown-maps"))
        span = -(-span // FAN)
    entered = spark.createDataFrame([], shape("_node", "_earliest"))
    for maps in reversed(levels):
        above = F.floor(F.col("_node") / FAN).cast("long").alias("_above")
        entered = maps.groupBy(*scope, above).cogroup(entered.groupBy(*scope, F.col("_node").alias("_above"))).applyInPandas(_entries(scope), shape("_node", "_earliest"))
    fired = bare.join(entered, [*scope, "_node"]).groupBy(*scope, "_node").applyInPandas(_firings(scope), shape("_at"))
    return instants.join(fired, [*scope, "_at"], "left_semi").select("_alert.*")


# --- life cycle -------------------------------------------------------------------


def apply_actions(alerts: DataFrame, actions: DataFrame) -> DataFrame:
    """Alerts with the state after a log of actions (alert_id, action, actor, at, action_id).

    The latest action sets the state; actions on unknown alerts have no effect.
    """
    order = F.struct("at", "action_id")
    ack, done = F.col("action") == "acknowledged", F.col("action") == "resolved"
    latest = actions.groupBy("alert_id").agg(
        F.max_by("action", order).alias("_state"),
        F.max_by("actor", F.when(ack, order)).alias("acknowledged_by"),
        F.max(F.when(ack, F.col("at"))).alias("acknowledged_at"),
        F.max(F.when(done, F.col("at"))).alias("resolved_at"),
    )
    joined = alerts.join(latest, "alert_id", "left")
    return joined.withColumn("status", F.coalesce("_state", "status")).drop("_state")


def lifecycle_events(alerts: DataFrame, actions: DataFrame) -> DataFrame:
    """Event payloads ``alert.created``, ``alert.acknowledged`` and ``alert.resolved``."""
    created = alerts.select(F.lit("alert.created").alias("event"), "timestamp", "alert_id", "severity")
    known = actions.join(alerts.select("alert_id", "severity"), "alert_id")
    acted = known.select(F.concat(F.lit("alert."), "action").alias("event"), F.col("at").alias("timestamp"), "alert_id", "severity")
    both = created.unionByName(acted)
    return both.withColumn("payload", F.to_json(F.struct(
        "event", "timestamp", F.struct("alert_id", "severity").alias("data"))))


def alert_statistics(alerts: DataFrame) -> DataFrame:
    """Totals, active alerts and the count of every severity, zeros included."""
    def count(c: Column) -> Column:
        return F.coalesce(F.sum(c.cast("long")), F.lit(0))

    return alerts.agg(
        F.count(F.lit(1)).alias("total_alerts"), count(F.col("status") == "active").alias("active_alerts"),
        *[count(F.col("severity") == s).alias(f"{s}_alerts") for s in SEVERITIES])


def page(df: DataFrame, order: Sequence[str | Column], limit: int = PAGE_SIZE, offset: int = 0) -> DataFrame:
    """One page of a list with the total count and whether there are pages around it."""
    total = df.agg(F.count(F.lit(1))).scalar()
    rows = df.orderBy(*order).offset(offset).limit(limit).withColumn("total_count", total)
    return rows.withColumns({
        "has_next": F.col("total_count") > offset + limit, "has_previous": F.lit(offset > 0)})


def alert_page(alerts: DataFrame, severity: str | None = None, equipment_id: str | None = None,
               status: str | None = None, limit: int = PAGE_SIZE, offset: int = 0) -> DataFrame:
    for name, wanted in (("severity", severity), ("equipment_id", equipment_id), ("status", status)):
        if wanted is not None:
            alerts = alerts.filter(F.col(name) == wanted)
    return page(alerts, [F.desc("timestamp"), "alert_id"], limit, offset)


def health_changes(health: DataFrame, time: str = "window_start", score: str = "overall_health",
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows where an equipment's health status differs from the one before, with a payload."""
    rows = health.withColumn("new_status", health_status(F.col(score)))
    seen = lookback(rows, ["equipment_id"], [time], 1, {"old_status": lambda w: F.lag("new_status").over(w)}, hot_rows)
    changed = seen.filter(F.col("old_status") != F.col("new_status"))
    return changed.withColumn("payload", F.to_json(F.struct(
        F.lit("equipment.health_changed").alias("event"), F.col(time).alias("timestamp"),
        F.struct("equipment_id", "old_status", "new_status").alias("data"))))
