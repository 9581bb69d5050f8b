"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line.

Each query runs once to warm up and then $BENCH_RUNS times (default 3) into a
sink that drops the rows; the median counts. Tables are first written again as
folders of as many files as there are cores, as a cluster would hold them: a small
table of one row group would be one task. That copy is not timed. ``--alternatives``
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession, Window, functions as F  # noqa: E402

from flowtables.operators import fix, gate, redo_events, snapshot  # noqa: E402
from flowtables.operators.windows import hop_aggregate  # noqa: E402
from flowtables.plans import catalog, derived  # noqa: E402
from flowtables.sources import changelog  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "hop_sum", "hop_avg", "tumbling_sum", "sampled_window_sum", "cdc_all", "cdc_committed", "change_events",
    "redo_update", "snapshot_merge", "bulk_actions", "mssql_changes", "crypto_plan", "crypto_hmac",
    "frame_records", "bundle_by_count", "bundle_by_bytes", "route_round_robin",
    "fix_execution", "fix_trade", "fix_seq_gaps",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("flowtables-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def copied(spark: SparkSession, source: str) -> str:
    """A folder with the same tables in several files each."""
    target = tempfile.mkdtemp(prefix="flowtables-bench-")
    for name in sorted(os.listdir(source)):
        df = spark.read.parquet(f"{source}/{name}")
        (df.repartition(int(CPUS)) if os.path.getsize(f"{source}/{name}") > 1 << 20 else df.coalesce(1)).write.parquet(f"{target}/{name}")
    return target


def seconds(make) -> float:
    times = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 3)


def joined_gate(df):
    """Gate by joining every change to the decisions of its transaction id."""
    ends = df.where(F.col("operation_code").isin(7, 36)).select(
        F.col("xid").alias("x"), F.col("scn").alias("end_scn"), F.col("operation_code").alias("end_code"))
    later = df.where(~F.col("operation_code").isin(7, 36)).join(ends, (F.col("xid") == F.col("x")) & (F.col("end_scn") >= F.col("scn")))
    first = later.groupBy("scn", "xid", "row_id").agg(F.min_by("end_code", "end_scn").alias("code"))
    return first.where("code = 7")


def single_window_gate(df):
    """Gate with one window per transaction id."""
    w = Window.partitionBy("xid").orderBy(F.col("scn").desc()).rowsBetween(Window.unboundedPreceding, 0)
    end = F.when(F.col("operation_code").isin(7, 36), F.col("operation_code"))
    return df.withColumn("d", F.last(end, True).over(w)).where("d = 7 and operation_code < 4")


def max_by_latest(df):
    fields = F.struct(*[c for c in df.columns if c not in snapshot.KEYS])
    return df.groupBy(*snapshot.KEYS).agg(F.max_by(fields, "seq").alias("r"))


def decode_by_kind(log):
    """Change events with one decoding branch per statement kind."""
    parts = [redo_events.change_events(log.where(F.col("operation") == op)) for op in ("INSERT", "UPDATE", "DELETE")]
    return parts[0].union(parts[1]).union(parts[2])


def executions_by_map(df):
    """Execution fields looked up in one map per message (the last of equal tags)."""
    pairs = df.select("session", F.posexplode(fix.tags(F.col("raw"))).alias("pos", "t"), F.monotonically_increasing_id().alias("m"))
    last = pairs.groupBy("session", "m", "t.tag").agg(F.max_by("t.val", "pos").alias("val"))
    return last.groupBy("session", "m").agg(F.map_from_entries(F.collect_list(F.struct("tag", "val"))).alias("f")).select(
        "session", *[F.col("f")[f.tag].alias(f.name) for f in fix.EXECUTION.fields])


def alternatives(spark, sf_dir: str) -> dict[str, float]:
    events = derived.table(spark, sf_dir, "events")
    redo = derived.redo_log(spark, sf_dir)
    log = changelog.scan_transactional(redo, "SALES.ORDERS")
    docs = snapshot.to_documents(redo_events.change_events(changelog.scan_all(redo, derived.REDO_TABLES)))
    orders = derived.fix_log(spark, sf_dir, "execution")
    hop = lambda panes: lambda: hop_aggregate(events, ["event_type"], ["value"], "sum", 300, 60, panes=panes)
    dense = events.withColumn("ts", F.col("ts") - F.make_dt_interval(days=F.dayofmonth("ts")))
    dense_hop = lambda panes: lambda: hop_aggregate(dense, ["event_type"], ["value"], "sum", 300, 60, panes=panes)
    return {
        "hop_sum panes": seconds(hop(True)), "hop_sum rows": seconds(hop(False)),
        "hop_sum one day panes": seconds(dense_hop(True)), "hop_sum one day rows": seconds(dense_hop(False)),
        "gate ranged": seconds(lambda: gate.committed_only(log)), "gate one window": seconds(lambda: single_window_gate(log)),
        "gate join": seconds(lambda: joined_gate(log)),
        "latest row_number": seconds(lambda: snapshot.latest_by_key(docs)), "latest max_by": seconds(lambda: max_by_latest(docs)),
        "events all rows": seconds(lambda: redo_events.change_events(redo.where("operation in ('INSERT', 'UPDATE', 'DELETE')"))),
        "events per kind": seconds(lambda: decode_by_kind(redo)),
        "executions by search": seconds(lambda: fix.executions(orders)), "executions by map": seconds(lambda: executions_by_map(orders)),
    }


def main() -> None:
    spark = session()
    if "--alternatives" in sys.argv:
        print(json.dumps(alternatives(spark, copied(spark, SF_DIR))))
        return
    sf_dir = copied(spark, SF_DIR)
    names = [a for a in sys.argv[1:] if not a.startswith("-")] or HEADLINE
    queries = {name: seconds(lambda n=name: catalog.QUERIES[n](spark, sf_dir)) for name in names}
    print(json.dumps({
        "metric": "median wall time, sum over queries", "value": round(sum(queries.values()), 3), "unit": "sec",
        "queries": queries, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
