"""The caller's aggregates over windows: batch against brute force, stream against batch."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from flowtables.operators import pane_aggregates as panes
from flowtables.streaming import panes as stream
from flowtables.streaming.versions import complete_batches

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def events(n=300, seed=1):
    """(seconds, group, value): uneven times, also before 1970, null groups and values."""
    rng = random.Random(seed)
    return [(rng.choice([rng.randint(-2000, 2000), rng.randint(100, 160)]), rng.choice(["a", "a", "b", None]), rng.choice([None, *range(50)])) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(t, g, v) for t, g, v in rows], "s long, g string, v long").withColumn("ts", F.timestamp_seconds("s"))


@pytest.fixture
def aggregates(spark):
    return [
        panes.least("low", F.col("v")), panes.greatest("high", F.col("v")), panes.total("sum", F.col("v")), panes.count("rows"), panes.count("known", F.col("v")),
        panes.mean("mean", F.col("v")), panes.first("opened", F.col("v"), F.col("ts")), panes.last("closed", F.col("v"), F.col("ts")), panes.distinct("kinds", F.col("v")),
        panes.quantile("middle", F.col("v"), 0.5),
        # one of the caller's own: bits of the values seen, and whether all are even
        panes.Aggregate("bits", [(F.bit_or("v"), F.bit_or), (F.bool_and(F.col("v") % 2 == 0), F.bool_and)], lambda b, even: F.when(even, F.lit(-1)).otherwise(b)),
    ]


def brute(rows, window, hop):
    out = {}
    for t, _, _ in rows:
        first = t // hop * hop
        for begin in ([first + hop - window] if hop > window else [first - i * hop for i in range(-(-window // hop))]):
            for g in {x[1] for x in rows}:
                inside = sorted((x[0], x[2] is not None, x[2] or 0, x[2]) for x in rows if x[1] == g and begin <= x[0] < begin + window)
                if inside:
                    out[g, begin] = [x[3] for x in inside]
    return out


@pytest.mark.parametrize(("window", "hop"), [(300, 60), (250, 100), (60, 60), (60, 300), (7, 3)])
def test_any_aggregates_over_any_windows(spark, aggregates, window, hop):
    rows = events(300 if window > 7 else 60)
    got = panes.hop_aggregate_by(frame(spark, rows), ["g"], aggregates, window, hop).collect()
    want = brute(rows, window, hop)
    assert len(got) == len(want)
    for r in got:
        begin = int((dt.datetime.fromisoformat(r["begin_date"]).replace(tzinfo=dt.timezone.utc) - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)).total_seconds())
        end = int((dt.datetime.fromisoformat(r["end_date"]).replace(tzinfo=dt.timezone.utc) - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)).total_seconds())
        values = want[r["g"], begin]
        known = [v for v in values if v is not None]
        assert end == begin + window and (r["rows"], r["known"], r["kinds"]) == (len(values), len(known), len(set(known)))
        assert (r["low"], r["high"], r["sum"]) == ((min(known), max(known), sum(known)) if known else (None, None, None))
        assert r["mean"] == (pytest.approx(sum(known) / len(known)) if known else None)
        assert (r["opened"], r["closed"]) == (values[0], values[-1])
        assert r["middle"] is None if not known else abs(sum(v < r["middle"] for v in known) - len(known) / 2) <= max(known.count(r["middle"]), 0.02 * len(known)) + 1
        union = 0
        for v in known:
            union |= v
        assert r["bits"] == (None if not known else -1 if all(v % 2 == 0 for v in known) else union)


def test_sketches_keep_their_error(spark):
    df = spark.range(200_000).select(F.timestamp_seconds(F.col("id") % 900).alias("ts"), (F.col("id") * 7919 % 50_000).alias("v"))
    got = panes.hop_aggregate_by(df, [], [panes.distinct("kinds", F.col("v")), panes.quantile("p90", F.col("v"), 0.9)], 900, 300)
    whole = [r for r in got.collect() if r["begin_date"].endswith("00:00:00")]
    assert abs(whole[0]["kinds"] - 50_000) < 50_000 * 0.05 and abs(whole[0]["p90"] - 45_000) < 50_000 * 0.02


def test_names_and_lengths_are_checked(spark, aggregates):
    df = frame(spark, [])
    for chosen, window, hop in (([], 1, 1), ([panes.count("n"), panes.count("n")], 1, 1), ([panes.count("n")], 0, 1), ([panes.count("n")], 1, 0)):
        with pytest.raises(ValueError):
            panes.hop_aggregate_by(df, ["g"], chosen, window, hop)
    assert panes.hop_aggregate_by(df, ["g"], aggregates, 60, 60).collect() == []


def test_stream_states_agree_with_batch_over_restarts_and_folds(spark, aggregates, folder):
    rows, windows = events(240, 3), {"window": 300, "hop": 60}
    states = folder + "/states"
    assert stream.read_windows(spark, states, ["g"], aggregates, **windows) is None and stream.fold(spark, states, ["g"], aggregates) is None
    exact = [a for a in aggregates if a.name != "middle"]  # which value a quantile sketch gives depends on the order
    for run in range(4):
        for part in range(2):
            frame(spark, rows[run * 60 + part * 30 : run * 60 + part * 30 + 30]).coalesce(1).write.mode("append").parquet(folder + "/in")
        source = spark.readStream.schema(frame(spark, []).schema).option("maxFilesPerTrigger", 1).parquet(folder + "/in")
        stream.start_pane_states(source, states, folder + "/checkpoint", ["g"], exact, **windows).awaitTermination()
        if run in (1, 2):
            last = stream.fold(spark, states, ["g"], exact)
            assert complete_batches(spark, states + "/delta") == [] and complete_batches(spark, states + "/base") == [last]
            assert stream.fold(spark, states, ["g"], exact) == last
        got = stream.read_windows(spark, states, ["g"], exact, **windows).collect()
        assert sorted(map(str, got)) == sorted(map(str, panes.hop_aggregate_by(frame(spark, rows[: run * 60 + 60]), ["g"], exact, **windows).collect()))
    assert len(complete_batches(spark, states + "/delta")) == 2
    # old panes go, and only they
    stream.fold(spark, states, ["g"], exact, keep_from=120)
    left = stream.read_windows(spark, states, ["g"], exact, **windows)
    young = panes.hop_aggregate_by(frame(spark, [r for r in rows if r[0] >= 120]), ["g"], exact, **windows)
    assert sorted(map(str, left.collect())) == sorted(map(str, young.collect()))
