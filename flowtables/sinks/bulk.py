"""Search-index bulk bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowtables.functions.documents import document
from flowtables.functions.ordered import row_position
from flowtables.functions.text import index_name
from flowtables.operators.bundles import bundle_by_count
from flowtables.session import scratch_dir

# --- fixed values: default limit ------------------------------------------------
BODY_EVENTS = 1000
# ------------------------------------------------------------------------------


def bulk_actions(events: DataFrame, *carried: str) -> DataFrame:
    """Change events as bulk text, one row per event.

    A delete is one action line; every other change is an index action line and
    the document line. Ids and names are escaped as JSON. ``carried`` columns are kept.
    """
    action = F.when(F.col("type") == "delete", "delete").otherwise("index")
    target = F.to_json(F.struct(
        F.concat_ws("-", index_name(F.col("database")), index_name(F.col("table_name"))).alias("_index"),
        F.col("row_id").alias("_id"),
    ))
    head = F.concat(F.lit('{"'), action, F.lit('":'), target, F.lit("}"))
    doc = F.when(action == "index", document(F.col("columns")))
    return events.select(*carried, F.col("seq").cast("long").alias("seq"), F.concat_ws("\n", head, doc).alias("body"))


def bulk_bodies(events: DataFrame, size: int = BODY_EVENTS, width: int | None = None) -> DataFrame:
    """One request body for every ``size`` events in order: ``bundle``, ``first_seq``, ``last_seq``, ``records``, ``content``.

    Events are in order of ``seq``, then of database, table and row. Every line of a body ends with a line
    break. The last body may hold fewer events; no events give no body. Bodies are put together in
    parallel, each from at most ``size`` events. The text of every event is made once, into a scratch folder:
    finding the order takes several passes, and those read ``seq`` alone.
    """
    spark, place = events.sparkSession, ("database", "table_name", "row_id")
    made = scratch_dir(spark, "bulk_lines")
    bulk_actions(events, *place).write.parquet(made)
    lines = row_position(spark.read.parquet(made), [], "seq", "_pos", ties=place, width=width)
    also = [F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq")]
    return bundle_by_count(lines, [], "_pos", "body", size, dense=True, also=also).select("bundle", "first_seq", "last_seq", "records", "content")


def write_bulk(bodies: DataFrame, path: str, compression: str = "none") -> None:
    """Bulk text files; lines of one file stay in change order."""
    (
        bodies.repartitionByRange("seq").sortWithinPartitions("seq")
        .select(F.col("body").alias("value")).write.option("compression", compression).text(path)
    )
