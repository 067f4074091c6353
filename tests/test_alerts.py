import pytest
from pyspark.sql import functions as F

from meterlake.operators import alerts


def readings(spark):
    return spark.sql(
        "SELECT *, TIMESTAMP'2024-01-01' AS event_time FROM VALUES "
        "('a', 240.0D), ('b', 240.126D), ('c', NULL), ('d', double('NaN')) AS t(meter_id, voltage)"
    )


class Unresolved(alerts.AlertRule):
    def alert(self, readings):
        return F.when(F.col("nowhere") > 1, F.lit(1))


class NoAlert(alerts.AlertRule):
    def alert(self, readings):
        return F.lit("not an alert")


class NoStart(alerts.OverVoltage):
    def initialize(self):
        raise OSError("no connection")

    def finalize(self):
        raise OSError("no connection")


class Counting(alerts.OverVoltage):
    def __init__(self):
        super().__init__()
        self.calls = []

    def initialize(self):
        self.calls.append("initialize")

    def finalize(self):
        self.calls.append("finalize")


def test_over_voltage(spark):
    (row,) = alerts.run_rules(readings(spark), [alerts.OverVoltage()]).collect()
    assert (row.meter_id, row.rule, row.type) == ("b", "OverVoltage", "CRITICAL")
    assert row.message == "Over-voltage detected: 240.13V"
    assert row.action == "Cut-off triggered"


@pytest.mark.parametrize("broken", [Unresolved, NoAlert, NoStart])
def test_a_broken_rule_does_not_stop_others(spark, broken):
    good = Counting()
    rules = [broken(), good, alerts.OverVoltage(limit_volts=1)]
    found = alerts.run_rules(readings(spark), rules).collect()
    assert sorted((r.rule, r.meter_id) for r in found) == [
        ("Counting", "b"),
        ("OverVoltage", "a"),
        ("OverVoltage", "b"),
    ]
    alerts.finish_rules(rules)
    assert good.calls == ["initialize", "finalize"]


class PerVolt(alerts.OverVoltage):
    """Divides by zero at the limit."""

    def alert(self, readings):
        near = 1 / (readings["voltage"] - self.limit_volts) > self.least
        return F.when(near, super().alert(readings))

    def __init__(self, least=0):
        super().__init__()
        self.least = least


class Raising(alerts.OverVoltage):
    def alert(self, readings):
        return F.when(F.raise_error(F.lit("never")).isNull(), super().alert(readings))


def test_a_rule_that_fails_on_a_reading_goes_on(spark):
    """Two rules share the failing part; another fails everywhere."""
    rules = [PerVolt(), PerVolt(1), Raising(), alerts.OverVoltage()]
    found = alerts.run_rules(readings(spark), rules).collect()
    assert sorted((r.rule, r.meter_id) for r in found) == [
        ("OverVoltage", "b"),
        ("PerVolt", "b"),
        ("PerVolt", "b"),
    ]
    failed = alerts.rule_failures(readings(spark), rules).collect()
    assert sorted((r.rule, r.meter_id) for r in failed) == [
        ("PerVolt", "a"),
        ("PerVolt", "a"),
        *(("Raising", meter) for meter in "abcd"),
    ]


def test_without_rules_there_are_no_alerts(spark):
    found = alerts.run_rules(readings(spark), [])
    assert found.columns == ["meter_id", "event_time", "rule", "type", "message", "action"]
    assert found.count() == 0
