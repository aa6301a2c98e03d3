import pytest

from pulsegrid.session import shared_dir
from pulsegrid.tables import event_log, experiments

COLUMNS = ["experiment_id", "name", "status", "n_metrics", "n_results", "final_results"]


def _listed(spark, root):
    return sorted(tuple(r) for r in experiments.list_experiments(spark, root).select(*COLUMNS).collect())


def test_appends_keep_the_file_count_bounded(spark, monkeypatch):
    monkeypatch.setattr(event_log, "COMPACT_FILES", 12)
    monkeypatch.setattr(event_log.compact_if_many, "__defaults__", (12,))
    root = shared_dir(spark, "test-events", unique=True)
    exp = experiments.start_experiment(spark, root, "run")
    for i in range(60):
        experiments.log_metric(spark, root, exp, "loss", 1.0 / (i + 1), i)
        assert len(event_log.event_files(spark, root)[1]) <= 13
    got = sorted(experiments.metrics_of(spark, root, exp).select("step", "value").collect())
    assert [tuple(r) for r in got] == [(i, 1.0 / (i + 1)) for i in range(60)]
    # files of before the last snapshot are gone
    assert len(event_log._names(spark, f"{root}/events")) < 40


def test_listing_is_the_same_before_and_after(spark):
    root = shared_dir(spark, "test-events", unique=True)
    ids = [experiments.start_experiment(spark, root, f"e{k}") for k in range(3)]
    for exp in ids:
        experiments.log_metric(spark, root, exp, "accuracy", 0.9)
    experiments.finish_experiment(spark, root, ids[0], {"a": 1})
    before = _listed(spark, root)
    assert experiments.compact_log(spark, root)
    assert _listed(spark, root) == before and event_log.event_files(spark, root)[1] == []
    assert not experiments.compact_log(spark, root)  # nothing new
    experiments.log_metric(spark, root, ids[1], "accuracy", 0.95)
    assert experiments.compact_log(spark, root)
    assert [r.value for r in experiments.metrics_of(spark, root, ids[1]).orderBy("value").collect()] == [0.9, 0.95]
    assert experiments.metrics_of(spark, root, "none").count() == 0


def test_an_append_during_a_compaction_is_kept_and_one_compaction_wins(spark, monkeypatch):
    root = shared_dir(spark, "test-events", unique=True)
    exp = experiments.start_experiment(spark, root, "run")
    listed, pointer = event_log._names, event_log._pointer
    state = {"in": False}

    def late(spark_, path):
        names = listed(spark_, path)
        if path.endswith("/events") and not state["in"]:
            state["in"] = True
            experiments.log_metric(spark, root, exp, "loss", 0.5, 1)  # after the compaction has looked
        return names

    monkeypatch.setattr(event_log, "_names", late)
    assert experiments.compact_log(spark, root)
    monkeypatch.setattr(event_log, "_names", listed)
    assert [r.value for r in experiments.metrics_of(spark, root, exp).collect()] == [0.5]
    stale = pointer(spark, root)
    assert experiments.compact_log(spark, root)
    experiments.log_metric(spark, root, exp, "loss", 0.25, 2)
    # a compaction that started from the older pointer loses and changes nothing
    monkeypatch.setattr(event_log, "_pointer", lambda *_: stale)
    assert not experiments.compact_log(spark, root)
    monkeypatch.setattr(event_log, "_pointer", pointer)
    assert sorted(r.value for r in experiments.metrics_of(spark, root, exp).collect()) == [0.25, 0.5]


def test_a_reader_of_one_experiment_opens_its_bucket(spark):
    root = shared_dir(spark, "test-events", unique=True)
    ids = [experiments.start_experiment(spark, root, f"e{k}") for k in range(4)]
    experiments.compact_log(spark, root)
    one = event_log.read_events(spark, root, experiments.EVENTS, ids[2])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_bucket" in plan.split("PartitionFilters")[1][:80]
    assert one.count() == 1


def test_an_empty_log(spark):
    root = shared_dir(spark, "test-events", unique=True)
    assert not experiments.compact_log(spark, root)
    assert _listed(spark, root) == []
