"""Sources, sinks, stored parameters, staging, and the request stream."""

import datetime as dt
import json
import os
from multiprocessing.pool import ThreadPool

import pytest
from conftest import listed
from pyspark.sql import functions as F
from test_requests import TODAY, body

from tillcast.operators import encoders as enc
from tillcast.plans import queries_models as qm
from tillcast.plans import scoring as sc
from tillcast.plans.scoring import score
from tillcast.session import shared_dir, stage
from tillcast.sources import readers, sinks
from tillcast.sources.artefacts import ArtefactStore, RunStore, lookup
from tillcast.streaming import score_stream
from tillcast.streaming.score_stream import BODY_SCHEMA, request_stream, score_batch, start_scoring

SF = "/root/testdata/sf0.001"


def test_csv(spark, rows, tmp_path):
    df = rows([("1", "2021-01-05", 1.5), ("2", "2021-01-06", None)], "outlet STRING, date DATE, v DOUBLE")
    sinks.write_csv(df, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert "outlet,date,v" in text and "1,2021-01-05,1.5" in text
    back = readers.read_csv(spark, str(tmp_path / "out"), "outlet STRING, date STRING, v DOUBLE", date_column="date")
    assert listed(back.select(*df.columns), "outlet") == listed(df, "outlet")


def test_partition_files(spark, tmp_path):
    for outlet in ("201", "202"):
        (tmp_path / f"proxy_revenue_{outlet}.csv").write_text("Date,v\n2021-01-05,NaN\n2021-13-05,2.0\n")
    (tmp_path / "notes.txt").write_text("x")
    got = readers.read_partitioned_csv(spark, str(tmp_path), "Date STRING, v DOUBLE", date_column="Date")
    assert {r["partition_id"] for r in got.collect()} == {"proxy_revenue_201", "proxy_revenue_202"}
    assert got.where("v IS NULL AND date = '2021-01-05'").count() == 2 and got.where("date IS NULL").count() == 2


def test_json(spark, rows, tmp_path):
    df = rows([(1, "a"), (2, None)], "fold INT, column STRING")
    sinks.write_json(df, str(tmp_path / "j"))
    assert listed(readers.read_json(spark, str(tmp_path / "j"), df.schema), "fold") == [(1, "a"), (2, None)]


def test_only_present_partitions_are_replaced(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    schema = "v DOUBLE, role STRING, fold INT"
    sinks.write_table(rows([(1.0, "training", 1), (2.0, "training", 2)], schema), path, ["role", "fold"])
    sinks.write_table(rows([(9.0, "training", 2)], schema), path, ["role", "fold"])
    assert [tuple(r) for r in spark.read.parquet(path).orderBy("v").select("v", "fold").collect()] == [(1.0, 1), (9.0, 2)]


def test_artefacts(spark, rows, tmp_path):
    store = ArtefactStore(spark, str(tmp_path))
    data = [("1", 1, "training", 1.0), ("1", 1, "training", 3.0), ("2", 2, "training", 5.0)]
    df = rows(data, "outlet STRING, fold INT, role STRING, x DOUBLE")
    params = enc.fit_scaling(df, ["x"], "standardize")
    with pytest.raises(LookupError):
        store.load("scaling")
    store.save("scaling", "a", params)
    assert lookup(store.load("scaling"), 1).first()["mean_x"] == 2.0
    store.save("scaling", "b", params)
    with pytest.raises(LookupError):
        store.load("scaling")
    assert store.load("scaling", "b").count() == 2 and store.runs("scaling") == ["a", "b"]


def test_runs_appear_whole(spark, rows, tmp_path):
    store = RunStore(spark, str(tmp_path))
    assert store.runs() == []
    with pytest.raises(LookupError):
        store.load()
    one = rows([(1,)], "v INT")
    store.publish("a", {"x": one, "y": one})
    broken = one.select(F.raise_error(F.lit("lost")).cast("int").alias("v"))
    with pytest.raises(Exception, match="lost"):
        store.publish("b", {"x": one, "y": broken})
    assert store.runs() == ["a"] and set(store.load()) == {"x", "y"}
    with pytest.raises(LookupError):
        store.load("b")
    held = store.load("a")["x"]
    store.publish("b", {"x": rows([(2,)], "v INT")})
    store.publish("a", {"x": rows([(3,)], "v INT")})  # published again: the last of all
    assert store.runs() == ["b", "a"] and [store.load(r)["x"].first()["v"] for r in (None, "a", "b")] == [3, 3, 2]
    assert held.first()["v"] == 1  # who reads the old tables goes on doing so


def test_two_writers_at_once(spark, rows, tmp_path):
    store, df = RunStore(spark, str(tmp_path)), stage(rows([(1,), (2,)], "v INT"))
    with ThreadPool(4) as pool:
        pool.map(lambda k: store.publish(f"run {k % 3}", {"x": df.withColumn("k", F.lit(k))}), range(6))
    assert sorted(store.runs()) == ["run 0", "run 1", "run 2"]
    assert all(store.load(f"run {k}")["x"].select("k").distinct().count() == 1 and store.load(f"run {k}")["x"].count() == 2 for k in range(3))


def test_stored_models_of_both_kinds(spark, tmp_path):
    spec, store = qm.user_spec(), RunStore(spark, str(tmp_path))
    requests = stage(qm.rq.parse_requests(spark.createDataFrame([("good", TODAY, body())], BODY_SCHEMA)))
    for additive in (False, True):
        trained = qm.user_artefacts(spark, SF, additive)
        sc.save_artefacts(trained, store, f"run {additive}")
        stored = sc.load_artefacts(store, None, 1)
        assert type(stored.model) is type(trained.model) and stored.bins.count() > 0
        first, second = ([r["probabilities"] for r in score(requests, a, spec).orderBy("date").collect()] for a in (trained, stored))
        assert first == second and len(first) == 7
    with pytest.raises(LookupError):
        sc.load_artefacts(store, None, 2)


def test_stage(spark):
    before = spark.range(10).withColumn("half", F.col("id") / 2)
    after = stage(before)
    assert after.schema.names == before.schema.names and listed(after, "id") == listed(before, "id")
    assert shared_dir(spark) in after.inputFiles()[0].replace("file://", "")



def test_stream(spark, tmp_path):
    incoming, out = tmp_path / "in", str(tmp_path / "out")
    incoming.mkdir()
    bodies = {"good": body(), "bad": body(range(-6, 0))}
    lines = [json.dumps({"request_id": k, "request_date": TODAY.isoformat(), "body": b}) for k, b in bodies.items()]
    (incoming / "one.json").write_text("\n".join(lines))
    spec = qm.user_spec()
    artefacts = qm.user_artefacts(spark, SF)
    query = start_scoring(request_stream(spark, str(incoming)), artefacts, spec, out, str(tmp_path / "check"))
    assert query.awaitTermination(300)
    got = spark.read.json(f"{out}/predictions")
    assert got.count() == 7 and {r["request_id"] for r in got.collect()} == {"good"}
    assert [r["request_id"] for r in spark.read.json(f"{out}/rejected").collect()] == ["bad"]
    requests = qm.rq.parse_requests(spark.read.schema(BODY_SCHEMA).json(str(incoming)))
    batch = score(requests, artefacts, spec).orderBy("date").collect()
    assert [r["date"] for r in batch] == sorted(r["date"] for r in got.collect())
    for row in batch:
        assert row["cost_centre_code"] == 201 and sum(row["probabilities"].values()) == pytest.approx(1, abs=3e-4)
        assert row["sales_class_name"] == qm.LABELS[int(row["sales_class_id"])]
        best = max(row["probabilities"].values())
        assert row["probabilities"][row["sales_class_id"]] == best


def test_batch_run_twice_leaves_each_row_once(spark, tmp_path):
    out = str(tmp_path / "out")
    spec = qm.user_spec()
    artefacts = qm.user_artefacts(spark, SF)
    bodies = spark.createDataFrame([("good", TODAY, body()), ("bad", TODAY, body(range(-6, 0)))], BODY_SCHEMA)
    before = set(os.listdir(shared_dir(spark).removeprefix("file:")))
    for _ in range(2):
        score_batch(bodies, artefacts, spec, out, 7)
    score_batch(bodies.where("request_id = 'good'"), artefacts, spec, out, 8)
    got = [(r["batch_id"], r["request_id"], r["date"]) for r in spark.read.json(f"{out}/predictions").collect()]
    assert len(got) == len(set(got)) == 14
    requests = sinks.read_log(spark, f"{out}/requests", "batch_id BIGINT, request_id STRING, request_date DATE, body STRING")
    assert sorted((r["batch_id"], r["request_id"]) for r in requests.collect()) == [(7, "bad"), (7, "good"), (8, "good")]
    left = {f for f in set(os.listdir(shared_dir(spark).removeprefix("file:"))) - before if f.startswith("requests")}
    assert not left  # what a batch staged goes with it
    shown = sinks.read_batches(spark, out, "outcomes", "batch_id STRING, request_id STRING, date DATE, status STRING, reason STRING")
    told = [(r["batch_id"], r["request_id"], r["status"], r["date"] is None) for r in shown.collect()]
    assert sorted(set(told)) == [("7", "bad", "rejected", True), ("7", "good", "scored", False), ("8", "good", "scored", False)]


def test_a_batch_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    spec, artefacts = qm.user_spec(), qm.user_artefacts(spark, SF)
    gappy = json.loads(body())
    gappy["lag_sales_attributes"][0]["lag_sales_date"] = [(TODAY - dt.timedelta(days=d)).isoformat() for d in range(8, 0, -1)]
    gappy["lag_sales_attributes"][0]["lag_sales"] = [5.0] * 8
    bodies = spark.createDataFrame([("good", TODAY, body()), ("bad", TODAY, body(range(-6, 0))), ("gappy", TODAY, json.dumps(gappy))], BODY_SCHEMA)
    schema = "batch_id STRING, request_id STRING"

    def counts():
        return {t: sinks.read_batches(spark, out, t, schema).groupBy("batch_id").count().collect() for t in ("requests", "predictions", "rejected", "outcomes")}

    write = score_stream.write_log
    for lost in ("predictions", "outcomes"):

        def failing(df, path, batch, lost=lost):
            if path.endswith(lost):
                raise RuntimeError("lost")
            write(df, path, batch)

        monkeypatch.setattr(score_stream, "write_log", failing)
        with pytest.raises(RuntimeError):
            score_batch(bodies, artefacts, spec, out, 1)
        assert not any(counts().values())
    monkeypatch.setattr(score_stream, "write_log", write)
    score_batch(bodies, artefacts, spec, out, 1)
    assert {t: c[0]["count"] for t, c in counts().items()} == {"requests": 3, "predictions": 7, "rejected": 1, "outcomes": 1 + 7 + 7}
    monkeypatch.setattr(score_stream, "write_log", failing)
    with pytest.raises(RuntimeError):
        score_batch(bodies, artefacts, spec, out, 1)
    assert not any(counts().values())  # a batch that is written again is out of sight meanwhile

