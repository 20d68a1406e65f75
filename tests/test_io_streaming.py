import datetime as dt
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from growthlab.operators import timeseries as TS
from growthlab.plans import anomaly as AN
from growthlab.sources import readers, sinks, views
from growthlab.streaming import history, payments


def test_sql_file_and_lists(spark, tmp_path):
    (tmp_path / "q.sql").write_text("select id from range(10) where id > :low;")
    assert readers.sql_file(spark, str(tmp_path / "q.sql"), {"low": 6}).count() == 3
    (tmp_path / "empty.sql").write_text("  \n")
    with pytest.raises(ValueError):
        readers.sql_file(spark, str(tmp_path / "empty.sql"))
    (tmp_path / "f.txt").write_text("b\na\nc\n")
    assert readers.text_list(spark, str(tmp_path / "f.txt")) == ["b", "a", "c"]


def test_json_documents(spark, tmp_path):
    doc = {
        "platform_provider": "WEB_NUVEI",
        "instances": [
            {"approved": 772, "total": 999, "hour": "2025-07-25T22:15:00"},
            {"approved": 1, "total": 2, "hour": "2025-07-25T22:30:00"},
        ],
    }
    (tmp_path / "r.json").write_text(json.dumps(doc, indent=1))
    rows = readers.payment_requests(spark, str(tmp_path / "r.json"), multi_line=True).collect()
    assert [tuple(r) for r in rows] == [
        ("WEB_NUVEI", 772, 999, dt.datetime(2025, 7, 25, 22, 15)),
        ("WEB_NUVEI", 1, 2, dt.datetime(2025, 7, 25, 22, 30)),
    ]
    config = {"platforms": ["WEB_NUVEI", "X"], "contamination_rates": {"WEB_NUVEI": 0.008}, "model_type": "m"}
    (tmp_path / "c.json").write_text(json.dumps(config, indent=1))
    got = {r[0]: r[1] for r in readers.detector_config(spark, str(tmp_path / "c.json")).collect()}
    assert got == {"WEB_NUVEI": 0.008, "X": None}


def test_sinks(spark, tmp_path):
    base = str(tmp_path)
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    sinks.replace(df, f"{base}/t")
    assert sinks.append_if_any(df.where("id = 1"), f"{base}/t")
    assert not sinks.append_if_any(df.where("id = 9"), f"{base}/t")
    assert spark.read.parquet(f"{base}/t").count() == 3
    keyed = spark.createDataFrame([(7, 1), (7, 2), (8, 3)], "k int, id int")
    for k in (7, 8):
        sinks.replace_key(keyed, f"{base}/k", "k", k)
    sinks.replace_key(keyed.where("id = 2"), f"{base}/k", "k", 7)
    back = {tuple(r) for r in spark.read.parquet(f"{base}/k").select("k", "id").collect()}
    assert back == {(7, 2), (8, 3)}
    sinks.replace_key(keyed.where("id = 9"), f"{base}/k", "k", 7)
    assert {r["k"] for r in spark.read.parquet(f"{base}/k").collect()} == {8}
    sinks.csv(df, f"{base}/c")
    assert readers.csv(spark, f"{base}/c", "id int, s string").count() == 2
    sinks.text_list(df, ["z", "y"], f"{base}/l")
    assert readers.text_list(spark, f"{base}/l") == ["z", "y"]


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    old = spark.createDataFrame([(7, 1), (7, 2), (8, 3)], "k int, id int")
    broken = old.withColumn("id", F.when(F.col("id") > 0, F.raise_error(F.lit("broken")).cast("int")))
    sinks.replace(old, f"{tmp_path}/t")
    for k in (7, 8):
        sinks.replace_key(old, f"{tmp_path}/k", "k", k)
    for write in (lambda: sinks.replace(broken, f"{tmp_path}/t"), lambda: sinks.replace_key(broken, f"{tmp_path}/k", "k", 7)):
        with pytest.raises(Exception, match="broken"):
            write()
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/t").collect()) == [(7, 1), (7, 2), (8, 3)]
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/k").collect()) == [1, 2, 3]
    assert [p.name for p in tmp_path.iterdir() if "-new-" in p.name or "-old-" in p.name] == []
    # a table may be replaced by what is read from it
    sinks.replace(spark.read.parquet(f"{tmp_path}/t").where("id > 1"), f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 2
    names = spark.createDataFrame([("a b/c=d", 1)], "k string, id int")
    sinks.replace_key(names, f"{tmp_path}/n", "k", "a b/c=d")
    sinks.replace_key(names, f"{tmp_path}/n", "k", "x")
    assert spark.read.parquet(f"{tmp_path}/n").count() == 1
    sinks.replace_key(names.where("id > 1"), f"{tmp_path}/n", "k", "a b/c=d")
    assert [p.name for p in (tmp_path / "n").iterdir() if p.is_dir()] == []


def test_views(spark):
    tokens = spark.createDataFrame([(1, "n", "t", 2)], "user_id int, full_name string, payment_token_id string, grade int")
    assert views.curated("finance_token_redeem_grade", tokens).columns == ["user_id", "grade"]
    web = spark.createDataFrame([("App",), ("Search",)], "channel_type string")
    assert views.curated("marketing_cohort_metrics_web", web).count() == 1
    source, cols, renames = views.SELECTED["marketing_costs"]
    wide = spark.createDataFrame([tuple("x" for _ in cols) + ("hidden",)], [*cols, "secret"])
    out = views.curated("marketing_costs", wide)
    assert out.columns == [renames.get(c, c) for c in cols]
    with pytest.raises(ValueError):
        views.curated("marketing_costs", wide.drop("cost"))
    made = views.register_views(spark, {source: wide, "fact_payment_token": tokens})
    assert set(made) == {"marketing_costs", "finance_token_redeem_grade"}
    assert spark.table("finance_token_redeem_grade").count() == 1


def event_frame(n=6000, days=9, seed=0):
    rng = np.random.default_rng(seed)
    offset = np.sort(rng.integers(0, days * 86400, n))
    return pd.DataFrame({
        "ts": pd.to_datetime("2024-01-01") + pd.to_timedelta(offset, unit="s"),
        "platform": rng.choice(["WEB_NUVEI", "NUVEI_CARD"], n), "ok": rng.random(n) > 0.2,
    })


def test_stream_counts_equal_batch(spark, tmp_path):
    events = spark.createDataFrame(event_frame())
    events.write.parquet(str(tmp_path / "in" / "events.parquet"))
    stream = payments.read_events(spark, str(tmp_path / "in" / "events.parquet"))
    args = (F.col("platform"), F.col("ok"))
    counts = payments.bucket_counts(stream, *args)
    payments.write_counts(counts, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    batch = payments.bucket_counts(events, *args)
    limit = events.agg(F.max("ts") - F.expr("INTERVAL 75 MINUTES")).collect()[0][0]
    want = batch.where(F.col("hour") <= F.lit(limit))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_stream_reads_a_single_file(spark, tmp_path):
    path = tmp_path / "events.parquet"
    event_frame(50).to_parquet(path, coerce_timestamps="us")
    stream = payments.read_events(spark, str(path))
    query = (
        stream.writeStream.format("parquet").option("path", str(tmp_path / "o"))
        .option("checkpointLocation", str(tmp_path / "s")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 50


def test_stream_scores_equal_batch(spark, tmp_path):
    # nine weeks of hours: longer than every window of the features
    events = spark.createDataFrame(event_frame(20_000, 65))
    events.write.parquet(str(tmp_path / "in" / "events.parquet"))
    args = (F.col("platform"), F.col("ok"), "1 hour")
    batch = payments.bucket_counts(events, *args)
    spans = TS.Spans()
    detector = AN.fit(batch, trees=10)
    stream = payments.read_events(spark, str(tmp_path / "in" / "events.parquet"))
    seen = []
    payments.score_batches(
        payments.bucket_counts(stream, *args), str(tmp_path / "buckets"), detector,
        lambda df, i: seen.append(df.collect()), str(tmp_path / "state"), spans,
    ).awaitTermination()
    limit = events.agg(F.max("ts") - F.expr("INTERVAL 2 HOURS")).collect()[0][0]
    want = {
        r["platform"]: [r["anomaly_score"], *r["rolling_feature_values"].values()]
        for r in AN.latest_records(batch.where(F.col("hour") <= F.lit(limit)), detector, spans).collect()
    }
    got = {r["platform"]: [r["anomaly_score"], *r["rolling_feature_values"].values()] for r in seen[-1]}
    assert got == {k: pytest.approx(v) for k, v in want.items()} and len(got) == 2


def test_history_equals_batch_at_every_bucket(spark):
    """Ten weeks, a gap and empty buckets: the state stays bounded and its features equal the batch's."""
    rng = np.random.default_rng(3)
    hours = [h for h in pd.date_range("2024-01-01", periods=1700, freq="h") if not 600 <= (h - pd.Timestamp("2024-01-01")).total_seconds() / 3600 < 640]
    total = rng.poisson(6, len(hours))
    rows = pd.DataFrame({"platform": "p", "hour": hours, "approved": rng.binomial(total, 0.7), "total": total})
    # hour factors look at a series' last rows, so it is evaluated at three ends
    for end in (97, 400, len(rows)):
        state, spans = None, TS.Spans()
        for low in range(0, end, 50):
            past = history.History.of(spans, state)
            for r in rows.iloc[low : min(low + 50, end)].itertuples():
                past.add(int(r.hour.value // 1000), r.approved, r.total)
            state = past.stored()
            assert len(state[0]) <= spans.season + 1 and len(state[3]) <= 168 * spans.same_hour
        got = past.record()
        batch = TS.rolling_features(TS.complete_rows(spark.createDataFrame(rows.iloc[:end])))
        want = TS.latest(batch).first()
        assert got["hour"] == want["hour"] and got["records_analyzed"] == want["records_analyzed"] == end - 1
        assert [got[c] for c in TS.FEATURES] == pytest.approx([want[c] for c in TS.FEATURES], abs=1e-9)
        assert got["hour_of_week"] == want["hour_of_week"] and got["success_factor"] == pytest.approx(want["success_factor"])
    with pytest.raises(ValueError):
        past.add(0, 1, 1)


def test_triggers_go_on_where_the_last_ended(spark, tmp_path):
    frame = event_frame(6000, 14)
    args = (F.col("platform"), F.col("ok"), "1 hour")
    detector = AN.fit(payments.bucket_counts(spark.createDataFrame(frame), *args).where("platform = 'NUVEI_CARD'"), trees=5)
    got = []
    for k, day in enumerate(["2024-01-01", "2024-01-03", "2024-01-09", "2024-01-15"][1:]):
        part = frame[(frame["ts"] < day) & (frame["ts"] >= (["2024-01-01", "2024-01-03", "2024-01-09"][k]))]
        spark.createDataFrame(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in.parquet"))
        stream = payments.read_events(spark, str(tmp_path / "in.parquet"))
        payments.score_batches(
            payments.bucket_counts(stream, *args), str(tmp_path / "buckets"), detector,
            lambda df, i: got.append({r["platform"]: r for r in df.collect()}), str(tmp_path / "state"),
        ).awaitTermination()
    read = spark.read.parquet(str(tmp_path / "buckets"))
    want = {r["platform"]: r for r in AN.latest_records(read, detector).collect()}
    assert [g["NUVEI_CARD"]["status"] for g in got] == ["insufficient data", "ok", "ok"]
    assert [g["WEB_NUVEI"]["status"] for g in got][1:] == ["platform not available"] * 2
    last = got[-1]["NUVEI_CARD"]
    assert last["anomaly_score"] == pytest.approx(want["NUVEI_CARD"]["anomaly_score"])
    assert last["records_analyzed"] == want["NUVEI_CARD"]["records_analyzed"]
    assert last["prediction_timestamp"] == want["NUVEI_CARD"]["prediction_timestamp"]
