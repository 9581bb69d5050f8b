"""Windows over arrival time: the documented scenario minute by minute, restarts, failures, idle time."""

import time

import pytest
from pyspark.sql import functions as F

from flowtables.operators import pane_aggregates as panes
from flowtables.streaming import arrival
from flowtables.streaming.versions import complete_batches

T = 1_700_000_040  # a whole minute


class Stream:
    """One run of the query per batch of events, at a time that the test sets."""

    def __init__(self, spark, folder, window=300, hop=60, **options):
        self.spark, self.folder, self.now = spark, folder, T
        self.options = dict(window=window, hop=hop, clock=lambda rows: self.now, fold_every=3, **options)

    def start(self):
        events = self.spark.readStream.schema("card_no string, trx_amount long").parquet(f"{self.folder}/in")
        return arrival.start_arrival_windows(
            events, ["card_no"], [panes.total("trx_amount_sum", F.col("trx_amount")), panes.count("n")],
            f"{self.folder}/out", f"{self.folder}/state", f"{self.folder}/checkpoint", **self.options)

    def put(self, *events):
        rows = self.spark.createDataFrame(list(events), "card_no string, trx_amount long")
        rows.coalesce(1).write.mode("append").parquet(f"{self.folder}/in")

    def at(self, now, *events):
        """A batch at ``now``, maybe without events; what the last batch wrote: end (relative to T), group, sum."""
        self.put(*events)
        self.now = T + now
        seen = set(complete_batches(self.spark, f"{self.folder}/out"))
        self.start().awaitTermination()
        return self.written(seen)

    def written(self, seen=()):
        out = [b for b in complete_batches(self.spark, f"{self.folder}/out") if b not in seen]
        rows = [r for b in out for r in self.spark.read.parquet(f"{self.folder}/out/batch={b}")
                .withColumn("end", F.unix_timestamp(F.to_timestamp("end_date"))).collect()]
        return sorted(((r["end"] - T, r["card_no"], r["trx_amount_sum"]) for r in rows), key=str)


def test_scenario_minute_by_minute(spark, folder):
    s = Stream(spark, folder)
    assert s.at(1, ("cc11", 100)) == []
    assert s.at(40, ("cc21", 250)) == []
    assert s.at(60) == [(60, "cc11", 100), (60, "cc21", 250)]
    assert s.at(70, ("cc11", 150)) == []
    assert s.at(100, ("cc21", 300)) == []
    assert s.at(120) == [(120, "cc11", 250), (120, "cc21", 550)]
    # nothing comes for a while; the triggers between are late, so each window is written when it can be
    assert s.at(240) == [(180, "cc11", 250), (180, "cc21", 550), (240, "cc11", 250), (240, "cc21", 550)]
    assert s.at(300) == [(300, "cc11", 250), (300, "cc21", 550)]
    assert s.at(305, ("cc11", 200)) == []
    assert s.at(345, ("cc21", 350)) == []
    # the first two events are no more in the aggregation
    assert s.at(360) == [(360, "cc11", 350), (360, "cc21", 650)]
    # groups that have gone silent give nothing, and their states are let go
    last = s.at(1000)
    assert max(r[0] for r in last) == 600 and all(0 < r[0] - 360 <= 300 for r in last)
    assert s.at(1100) == []
    s.at(1200), s.at(1300), s.at(1400)
    assert sum(spark.read.parquet(f"{folder}/state/panes/{kind}").count() for kind in ("base", "delta") if complete_batches(spark, f"{folder}/state/panes/{kind}")) == 0
    assert len(complete_batches(spark, f"{folder}/state/clock")) <= 3


def test_a_repeated_batch_keeps_its_arrival_time(spark, folder, monkeypatch):
    s = Stream(spark, folder)
    s.at(10, ("a", 1))
    s.put(("a", 2), (None, 5))
    s.now = T + 65
    real = arrival.write_batch

    def failing(df, root, batch_id):
        real(df, root, batch_id)
        if root.endswith("delta"):
            raise RuntimeError("lost after the states, before the windows")

    monkeypatch.setattr(arrival, "write_batch", failing)
    with pytest.raises(Exception):  # noqa: B017
        s.start().awaitTermination()
    monkeypatch.setattr(arrival, "write_batch", real)
    s.now = T + 500  # the repeat still counts at T + 65
    s.start().awaitTermination()
    assert s.written() == [(60, "a", 1)]
    assert s.at(120) == [(120, "a", 3), (120, None, 5)]


def test_a_clock_that_goes_back_stands_still(spark, folder):
    s = Stream(spark, folder, window=60, hop=60)
    assert s.at(70, ("a", 1)) == []
    assert s.at(20, ("a", 2)) == []
    assert s.at(130) == [(120, "a", 3)]


def test_sampled_windows_take_the_end_of_each_hop(spark, folder):
    s = Stream(spark, folder, window=30, hop=120)
    base = -T % 120  # hops are at multiples of 120 seconds
    s.at(base + 10, ("a", 1))
    s.at(base + 95, ("a", 2))
    assert s.at(base + 121, ("a", 4)) == [(base + 120, "a", 2)]


@pytest.mark.parametrize(("after", "window", "hop", "end"), [
    (0, 300, 60, 60), (59.9, 300, 60, 60), (60, 300, 60, 120), (0, 250, 100, 50), (50, 250, 100, 150), (0, 30, 120, 120), (119.5, 30, 120, 120),
])
def test_next_end(after, window, hop, end):
    assert arrival.next_end(after, window, hop) == end


def test_heartbeat_closes_windows_without_events(spark, folder):
    s = Stream(spark, folder, window=4, hop=2, heartbeat=True)
    s.options["clock"] = arrival.system_clock
    s.put(("a", 7))
    query = s.start()
    try:
        deadline = time.time() + 60
        while time.time() < deadline and len(s.written()) < 2:
            time.sleep(1)
        time.sleep(5)
    finally:
        query.stop()
    got = s.written()
    assert len(got) == 2 and {r[1:] for r in got} == {("a", 7)} and abs(got[0][0] - got[1][0]) == 2
