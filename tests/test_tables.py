"""Round trips of sinks, registry and experiment log (SNK, REG, EXP)."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from pulsegrid.session import shared_dir
from pulsegrid.sources import files, panels
from pulsegrid.tables import experiments, registry


def test_dataset_roundtrip_all_formats(spark):
    df = panels.masked(panels.user_series(spark, SF_SMALL))
    for fmt in ("parquet", "csv", "json"):
        path = shared_dir(spark, "test-ds", uuid.uuid4().hex)
        m = files.save_dataset(df, path, "p1", {"k": "v"}, fmt).first()
        assert m["rows"] == df.count() and m["format"] == fmt
        back, _ = files.load_dataset(spark, path)
        assert rows(back) == rows(df)


def test_unknown_format_rejected(spark):
    with pytest.raises(ValueError):
        files.read_frame(spark, "/nowhere", "orc")


def test_registry_save_load_list_delete(spark):
    root = shared_dir(spark, "test-reg", uuid.uuid4().hex)
    m = spark.createDataFrame([("a", "ok", 1.0), ("b", "failed", 2.0)], "series_id string, status string, w double")
    registry.save_model(m, root, "demo", "v1", {"owner": "tests"})
    registry.save_model(m.withColumn("w", F.col("w") * 2), root, "demo", "v2")
    registry.save_model(m, root, "other", "v1")
    latest = registry.load_model(spark, root, "demo")
    assert {r["version"] for r in latest.collect()} == {"v2"}
    lst = registry.list_checkpoints(spark, root).collect()
    assert len(lst) == 3 and lst[0]["saved_at"] >= lst[-1]["saved_at"]
    assert {r["n_fitted"] for r in lst} == {1}
    assert registry.delete_checkpoint(spark, root, "demo", "v2")
    assert not registry.delete_checkpoint(spark, root, "demo", "v9")
    assert {r["version"] for r in registry.list_checkpoints(spark, root, "demo").collect()} == {"v1"}


def test_experiment_log(spark):
    root = shared_dir(spark, "test-exp", uuid.uuid4().hex)
    a = experiments.start_experiment(spark, root, "exp", "d", {"lr": 0.1})
    b = experiments.start_experiment(spark, root, "exp", "d", {"lr": 0.2})
    assert a != b
    experiments.log_metric(spark, root, a, "accuracy", 0.95, 1)
    experiments.log_metric(spark, root, a, "loss", 0.1, 1)
    experiments.save_result(spark, root, a, "res", spark.createDataFrame([(1, 0.95)], "k int, final_accuracy double"))
    experiments.finish_experiment(spark, root, a, {"final_accuracy": 0.95})
    lst = {r["experiment_id"]: r for r in experiments.list_experiments(spark, root).collect()}
    assert lst[a]["status"] == "completed" and lst[a]["n_metrics"] == 2 and lst[a]["n_results"] == 1
    assert lst[b]["status"] == "running"
    assert {r["name"] for r in experiments.metrics_of(spark, root, a).collect()} == {"accuracy", "loss"}


def test_registry_keeps_schemas_and_version_texts_apart(spark):
    root = shared_dir(spark, "test-reg", uuid.uuid4().hex)
    m = spark.createDataFrame([("a", "ok", 1.0)], "series_id string, status string, w double")
    other = spark.createDataFrame([("a", [1, 2])], "series_id string, xs array<int>")
    for v in ("001", "1", "1.0"):
        registry.save_model(m, root, "demo", v)
    registry.save_model(other, root, "scaler", "1")
    assert registry.load_model(spark, root, "demo", "1").columns == ["series_id", "status", "w", "model_name", "version", "saved_at"]
    assert registry.load_model(spark, root, "scaler").columns[:2] == ["series_id", "xs"]
    listed = registry.list_checkpoints(spark, root, "demo").collect()
    assert sorted(r["version"] for r in listed) == ["001", "1", "1.0"] and all(r["rows"] == 1 for r in listed)


def test_registry_saves_a_deleted_version_again(spark):
    root = shared_dir(spark, "test-reg", uuid.uuid4().hex)
    m = spark.createDataFrame([("a", 1.0)], "series_id string, w double")
    registry.save_model(m, root, "demo", "v1")
    assert registry.delete_checkpoint(spark, root, "demo", "v1")
    with pytest.raises(FileNotFoundError):
        registry.load_model(spark, root, "demo")
    registry.save_model(m.withColumn("w", F.lit(5.0)), root, "demo", "v1")
    assert [r["version"] for r in registry.list_checkpoints(spark, root).collect()] == ["v1"]
    assert registry.load_model(spark, root, "demo", "v1").first()["w"] == 5.0


def test_damaged_model_fails_to_load_and_damaged_listing_warns(spark):
    import glob
    import os

    from pulsegrid.session import local_path

    root = shared_dir(spark, "test-reg", uuid.uuid4().hex)
    m = spark.createDataFrame([("a", "ok", 1.0)], "series_id string, status string, w double")
    registry.save_model(m, root, "demo", "v1")
    folder = glob.glob(os.path.join(local_path(root), "models", "demo", "v1-*"))[0]
    for where in (folder, os.path.join(local_path(root), "metadata")):
        with open(os.path.join(where, "part-corrupt.parquet"), "wb") as fh:
            fh.write(b"not a parquet file")
    with pytest.raises(Exception):
        registry.load_model(spark, root, "demo").collect()
    with pytest.warns(UserWarning, match="not listed"):
        assert [r["version"] for r in registry.list_checkpoints(spark, root).collect()] == ["v1"]


def test_event_times_do_not_depend_on_the_session_zone(spark):
    root = shared_dir(spark, "test-exp", uuid.uuid4().hex)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        a = experiments.start_experiment(spark, root, "exp")
        experiments.log_metrics(spark.createDataFrame([("m", 1.0)], "name string, value double"), root, a)
        got = experiments.list_experiments(spark, root).first()
        assert 0 <= (got["updated"] - got["started"]).total_seconds() < 300
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_spine_keeps_rows_off_the_grid(spark):
    from datetime import datetime

    from conftest import frame
    from pulsegrid.sources import spine

    t = lambda h, m=0: datetime(2024, 1, 1, h, m)
    df = frame(spark, [("a", t(0, 30), 0, 1.0), ("a", t(1, 45), 1, 3.0), ("a", t(2, 0), 2, 5.0), ("a", t(4, 30), 3, 7.0)])
    got = [(r["ts"], r["value"]) for r in spine.fill_on_spine(df).orderBy("ts").collect()]
    assert got == [(t(0, 30), 1.0), (t(1, 30), 4.0), (t(2, 30), None), (t(3, 30), None), (t(4, 30), 7.0)]
    long = frame(spark, [("a", datetime(2000, 1, 1), 0, 1.0), ("a", datetime(2004, 1, 1), 1, 2.0)])
    assert spine.time_spine(long).count() == spine.time_spine(long).distinct().count() == 1461 * 24 + 1
    with pytest.raises(ValueError):
        spine.time_spine(df, "1 fortnight")
