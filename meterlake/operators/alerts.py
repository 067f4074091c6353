"""Alert rules over readings, for batches and streams."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

logger = logging.getLogger(__name__)

ALERT_FIELDS = ("type", "message", "action")


class AlertRule:
    """A user's rule: `alert` gives a struct of type, message and action, or NULL.

    `initialize` runs before the rule is used, `finalize` after the last use.
    """

    @property
    def name(self) -> str:
        return type(self).__name__

    def initialize(self) -> None:
        pass

    def alert(self, readings: DataFrame) -> Column:
        raise NotImplementedError

    def finalize(self) -> None:
        pass


class OverVoltage(AlertRule):
    """A reading above the limit asks for a cut-off."""

    # Limit and texts of the over-voltage alert.
    LIMIT_VOLTS = 240
    TYPE = "CRITICAL"
    MESSAGE = "Over-voltage detected: %.2fV"
    ACTION = "Cut-off triggered"

    def __init__(self, limit_volts: float = LIMIT_VOLTS):
        self.limit_volts = limit_volts

    def alert(self, readings: DataFrame) -> Column:
        volts = readings["voltage"]
        # NaN sorts above every number and is no measured voltage.
        return F.when(
            (volts > self.limit_volts) & ~F.isnan(volts),
            F.struct(
                F.lit(self.TYPE).alias("type"),
                F.format_string(self.MESSAGE, volts).alias("message"),
                F.lit(self.ACTION).alias("action"),
            ),
        )


def run_rules(
    readings: DataFrame, rules: Iterable[AlertRule], strict: bool = False
) -> DataFrame:
    """Alerts of all rules with meter, time and rule name, from one pass over the readings.

    A rule that cannot start or does not fit the readings is logged and left out. One that fails
    on a reading raises no alert for it, and goes on; `rule_failures` names these readings. With
    `strict` such a failure ends the job, as it does for a stream that has one rule.
    """
    schema = ", ".join(f"{field} string" for field in ALERT_FIELDS)
    raised = tried_rules(readings, rules, strict).where("tried IS NOT NULL")
    alert = F.from_json(F.decode("tried", "utf-8"), schema)
    return raised.select("meter_id", "event_time", "rule", F.inline(F.array(alert)))


def rule_failures(readings: DataFrame, rules: Iterable[AlertRule]) -> DataFrame:
    """Meter, time and rule name where a rule could not be evaluated, such as after a division
    by zero. Python functions in a rule are beyond this: their errors end the job."""
    failed = tried_rules(readings, rules).where("tried IS NULL")
    return failed.select("meter_id", "event_time", "rule")


def tried_rules(
    readings: DataFrame, rules: Iterable[AlertRule], strict: bool = False
) -> DataFrame:
    """`meter_id, event_time, rule, tried`: an alert as JSON bytes, NULL where the rule failed."""
    tried = []
    for rule in rules:
        try:
            rule.initialize()
            alert = rule.alert(readings)
            fields = [alert[field].cast("string").alias(field) for field in ALERT_FIELDS]
            readings.select(*fields).schema  # fails here rather than in the joint query
        except Exception as error:
            logger.warning("alert rule %s left out: %s", rule.name, error)
            continue
        # Empty for no alert. The function gives NULL for whatever fails in its argument.
        text = F.when(alert.isNull(), "").otherwise(F.to_json(F.struct(*fields)))
        to_bytes = F.to_binary if strict else F.try_to_binary
        result = to_bytes(text, F.lit("utf-8"))
        tried.append(F.struct(F.lit(rule.name).alias("rule"), result.alias("tried")))
    none = F.array().cast("array<struct<rule:string,tried:binary>>")
    # Inside the filter Spark takes no parts out that rules share; outside of the try they would
    # fail for all. Most readings raise nothing, and give no row.
    worth_a_row = F.filter(
        F.array(*tried) if tried else none,
        lambda one: one["tried"].isNull() | (F.length(one["tried"]) > 0),
    )
    return readings.select("meter_id", "event_time", F.inline(worth_a_row))


def finish_rules(rules: Iterable[AlertRule]) -> None:
    """Finalize all rules, whatever one of them does."""
    for rule in rules:
        try:
            rule.finalize()
        except Exception as error:
            logger.warning("alert rule %s did not finish: %s", rule.name, error)
