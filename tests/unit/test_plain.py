"""Guards and settings that need no Spark."""

from datetime import UTC, datetime, timedelta, timezone

import pytest

from tidewell import cli, schema, settings
from tidewell.functions.expr import exact_hour, micros
from tidewell.operators import learning, skew
from tidewell.sources import generate, store

HOUR = datetime(2026, 1, 1, 12, tzinfo=UTC)


def test_hours():
    assert exact_hour(datetime(2026, 1, 1, 13, tzinfo=timezone(timedelta(hours=1)))) == HOUR
    for bad in (datetime(2026, 1, 1, 12), HOUR.replace(minute=1), HOUR.replace(microsecond=1)):
        with pytest.raises(ValueError):
            exact_hour(bad)
    assert micros(datetime(1970, 1, 2, tzinfo=UTC) - timedelta(microseconds=1)) == 86_399_999_999


def test_tables_and_names():
    assert schema.Table("gold", "incident_signals").path == "gold/incident_signals"
    for bad in (("gold", "nothing"), ("iron", "tickets")):
        with pytest.raises(ValueError):
            schema.Table(*bad)
    for bad in ("a b", "a;drop", "`x`", ""):
        with pytest.raises(ValueError):
            store.safe(bad)


def test_settings(tmp_path):
    (tmp_path / "base.toml").write_text('late_tolerance_minutes = 30\n[storage]\nroot = "a"\nkeep = 1\n')
    (tmp_path / "dev.toml").write_text('risk_threshold = 0.7\n[storage]\nroot = "b"\n')
    got = settings.load(tmp_path, "dev")
    assert (got.late_tolerance_minutes, got.risk_threshold, got.storage) == (30, 0.7, {"root": "b", "keep": 1})
    with pytest.raises(FileNotFoundError):
        settings.load(tmp_path, "prod")
    for bad in ({"timezone": "CET"}, {"late_tolerance_minutes": -1}, {"risk_threshold": 1.1}):
        with pytest.raises(ValueError):
            settings.Settings(**bad)


def test_periods():
    day = timedelta(days=1)
    assert learning.check_periods(HOUR + 3 * day, HOUR, HOUR + day, HOUR + 3 * day)[0] == HOUR + 3 * day
    for ends in ((HOUR, HOUR, HOUR + day), (HOUR, HOUR + day, HOUR + 4 * day), (HOUR + day, HOUR, HOUR + 2 * day)):
        with pytest.raises(ValueError):
            learning.check_periods(HOUR + 3 * day, *ends)


def test_choice_and_gate():
    one = {"pr_auc": 0.4, "recall": 0.5, "precision": 0.3, "roc_auc": 0.7}
    assert learning.choose({"a": {"validation": one}, "b": {"validation": one | {"recall": 0.6}}}) == "b"
    assert learning.choose({"a": {"validation": one, "test": {"pr_auc": 0}}, "b": {"validation": one, "test": {"pr_auc": 1}}}) == "a"
    assert learning.gate_failures(one, 0.25) == []
    assert len(learning.gate_failures({"pr_auc": 0.1, "recall": 0.1, "precision": 0.2, "roc_auc": 0.5}, 0.2)) == 4


def test_sizes():
    for bad in ((0, 3, 2, 2), (1, 2, 2, 2), (1, 3, 1, 2), (1, 3, 2, 1)):
        with pytest.raises(ValueError):
            skew.check_size(*bad)


def test_risk():
    p = generate.Profile(risk_pattern=True, breach_rate=0.12)
    assert generate.breach_probability(p, "P1", "Standard") == pytest.approx(0.12 * 4 * 1.15)
    assert generate.breach_probability(generate.Profile(risk_pattern=True, breach_rate=0.5), "P1", "Standard") == 0.85
    assert generate.breach_probability(generate.Profile(breach_rate=0.12), "P1", "Standard") == 0.12
    for bad in ({"tickets": 0}, {"breach_rate": 2}, {"start": datetime(2025, 1, 1)}):
        with pytest.raises(ValueError):
            generate.Profile(**bad)


def test_event_files(tmp_path):
    c = generate.Streamed(20, 4, HOUR, malformed=2, invalid=3)
    assert generate.batch_lines(c, 5) == generate.batch_lines(c, 5) != generate.batch_lines(c, 6)
    first = generate.write_batches(tmp_path, c, 2)
    assert [f.name for f in first] == ["events_000001.json", "events_000002.json"]
    assert [f.name for f in generate.write_batches(tmp_path, c, 1)] == ["events_000003.json"] and not list(tmp_path.glob(".*"))
    late = generate.Streamed(20, 4, HOUR, late_rate=1.0, late_minutes=60)
    assert generate.batch_lines(late, 1) == [] and generate.batch_lines(late, 5)


def test_command_line():
    a = cli.parser().parse_args(["--run-id", "r", "operations", "--hour", "2026-01-01T00:00:00Z"])
    assert (a.job, a.run_id, a.hour) == ("operations", "r", datetime(2026, 1, 1, tzinfo=UTC))
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["operations", "--hour", "2026-01-01T00:00:00"])
