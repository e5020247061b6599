"""The store's versions: whole or not at all, readable later, and swept."""

from datetime import UTC, datetime

import pytest

from tidewell.sources import store as stores

T = ("ops", "streaming_metrics")


@pytest.fixture
def store(spark, tmp_path):
    made = stores.Store(spark, f"{tmp_path}/w")
    made.append(rows(spark, (1, "a"), (2, "b")), *T)
    return made


def rows(spark, *values):
    return spark.createDataFrame(values, "k int, v string")


def held(store, version=None, table=T):
    return sorted(map(tuple, store.read(*table, version).collect()), key=repr)


@pytest.mark.parametrize("step", ["_write", "_commit", "write"])
def test_a_crash_leaves_the_table_as_it_was(spark, store, monkeypatch, step):
    """Before the part is written, after it, and with the new version's file still a draft."""

    def crash(*_, **__):
        raise RuntimeError(step)

    with monkeypatch.context() as m:
        m.setattr(stores.Files if step == "write" else stores.Store, step, crash)
        for change in (store.replace, store.append, lambda r, *t: store.update_only(r, *t, ["k"]), lambda r, *t: store.insert_only(r, *t, ["k"])):
            with pytest.raises(RuntimeError):
                change(rows(spark, (2, "x"), (3, "y")), *T)
    assert store.version(*T) == 1 and held(store) == [(1, "a"), (2, "b")]
    store.update_only(rows(spark, (2, "x"), (3, "y")), *T, ["k"])
    assert held(store) == [(1, "a"), (2, "x")] and held(store, 1) == [(1, "a"), (2, "b")]
    assert len(store.vacuum(*T)) == (1 if step == "_write" else 5) and held(store) == [(1, "a"), (2, "x")] and store.versions(*T) == [2]


def test_a_second_writer_is_refused(spark, store):
    with pytest.raises(FileExistsError):
        store._commit(*T, {"parts": {}}, 0)


def test_merges_take_a_key_once_and_write_nulls(spark, store):
    store.insert_only(rows(spark, (2, "z"), (3, "c"), (3, "c"), (None, "n"), (None, "n")), *T, ["k"])
    assert held(store) == [(1, "a"), (2, "b"), (3, "c"), (None, "n"), (None, "n")]
    store.update_only(rows(spark, (1, None), (9, "new")), *T, ["k"])
    assert held(store)[0] == (1, None) and len(held(store)) == 5


def test_only_touched_days_are_read(spark, tmp_path):
    from pyspark.sql import functions as F

    store, day = stores.Store(spark, f"{tmp_path}/w"), F.substring("v", 1, 2)
    events = "bronze", "ticket_events"
    for batch in (((1, "d1x"), (2, "d2x")), ((1, "d1x"), (3, "d3x")), ((3, "d3x"),)):
        store.insert_only(rows(spark, *batch), *events, ["v"], within=day)
    assert held(store, table=events) == [(1, "d1x"), (2, "d2x"), (3, "d3x")]
    plan = store._parts(*events, store._log(*events), list(store._log(*events)["parts"])).where("_within = 'd1'")
    assert len(plan.inputFiles()) >= 1 and plan.count() == 1
    assert "PartitionFilters: [_part" in plan._jdf.queryExecution().toString() or "_within" in plan._jdf.queryExecution().toString()


def test_compaction_changes_nothing(spark, store):
    store.append(rows(spark, (3, "c")), *T)
    store.append(rows(spark, (4, "d")), *T, "kept")
    before = held(store)
    store.compact(*T)
    assert held(store) == before and len(store._log(*T)["parts"]) == 2 and len(store.vacuum(*T)) == 2 and held(store) == before


def test_a_shorter_range_keeps_what_lies_after_it(spark, tmp_path):
    store, table = stores.Store(spark, f"{tmp_path}/w"), ("gold", "ticket_features")
    at = lambda d: datetime(2025, 1, d, tzinfo=UTC)
    days = lambda v, *ds: spark.createDataFrame([(at(d), v) for d in ds], "as_of timestamp, v string")
    store.replace_snapshot(days("live", 9), *table, "as_of", at(9))
    store.replace_range(days("first", 1, 2, 3), *table, "as_of", at(4), "backfill")
    store.replace_range(days("second", 1), *table, "as_of", at(2), "backfill")
    got = sorted((r["as_of"].day, r["v"]) for r in store.read(*table).collect())
    assert got == [(1, "second"), (2, "first"), (3, "first"), (9, "live")]
