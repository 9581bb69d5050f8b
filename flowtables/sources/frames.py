"""Records out of delimited byte streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# --- fixed values -------------------------------------------------------------
DEMARCATOR = 10
STRIP_BYTES = (10, 13, 255)  # line feed, carriage return, 0xFF
TRIM = r"^[\x00-\x20]+|[\x00-\x20]+$"
# ------------------------------------------------------------------------------


def _pieces(content: Column, demarcator: int) -> Column:
    # ISO-8859-1 maps each byte to one character and back
    return F.split(F.decode(content, "ISO-8859-1"), rf"\x{demarcator:02x}")


def _clean(piece: Column, strip_bytes: Sequence[int], charset: str) -> Column:
    kept = piece
    if strip_bytes:
        kept = F.regexp_replace(kept, "[" + "".join(rf"\x{b:02x}" for b in strip_bytes) + "]", "")
    if charset.upper() == "UTF-8":
        # a cast keeps malformed bytes; decode would fail the job on them
        kept = F.encode(kept, "ISO-8859-1").cast("string")
    elif charset.upper() != "ISO-8859-1":
        kept = F.decode(F.encode(kept, "ISO-8859-1"), charset)
    return F.regexp_replace(kept, TRIM, "")


def frame(
    df: DataFrame, content: str = "content", demarcator: int = DEMARCATOR,
    strip_bytes: Sequence[int] = STRIP_BYTES, charset: str = "UTF-8",
) -> DataFrame:
    """One row per record of a binary column, with its 0-based ``pos``.

    The bytes are split at the demarcator; what follows the last one is an
    incomplete record and is left out. Strip bytes are removed, the rest is
    decoded and trimmed of control characters and blanks.
    """
    keep = [c for c in df.columns if c != content]
    split = df.select(*keep, _pieces(F.col(content), demarcator).alias("_pieces"))
    complete = F.slice("_pieces", F.lit(1), F.size("_pieces") - 1)
    cleaned = F.transform(complete, lambda piece: _clean(piece, strip_bytes, charset))
    return split.select(*keep, F.posexplode(cleaned).alias("pos", "record"))


def read_binary_files(spark, path: str) -> DataFrame:
    """Captured byte streams, one file each: (path, content)."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_framed(
    spark: SparkSession, path: str, demarcator: int = DEMARCATOR,
    strip_bytes: Sequence[int] = STRIP_BYTES, charset: str = "UTF-8",
) -> DataFrame:
    """(path, pos, record) of captured byte streams of any length, one file each, as :func:`frame` gives them.

    Spark's text reader cuts a file into byte ranges (``spark.sql.files.maxPartitionBytes``) and hands a record that
    crosses a border to the range it begins in. ``pos`` is the number of records in the ranges before plus the place in the
    range; only these counts, a row per range, are added up, and records are not shuffled. What follows the last
    demarcator shows in the length of the file and is left out; empty files have no records.

    The demarcator is below 128. Files are not compressed. A byte order mark at the begin of a file is no part of its first record.
    """
    if not 0 < demarcator < 128:
        raise ValueError("a demarcator of a file is a byte from 1 to 127")
    lines = spark.read.option("lineSep", chr(demarcator)).text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_begin"),
        F.col("_metadata.file_size").alias("_size"), F.monotonically_increasing_id().alias("_id"), "value")
    ranges = lines.groupBy("path", "_begin").agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"), F.sum(F.octet_length("value") + 1).alias("_bytes"), F.max("_size").alias("_size"))
    of_file = Window.partitionBy("path")
    earlier = of_file.orderBy("_begin").rowsBetween(Window.unboundedPreceding, -1)
    mark = 3  # bytes of a byte order mark
    ended = F.sum("_bytes").over(of_file).isin(F.col("_size"), F.col("_size") - mark)
    carried = ranges.select(
        "path", "_begin", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        (F.sum("_n").over(of_file) - F.when(ended, 0).otherwise(1)).alias("_complete"))
    numbered = lines.drop("_size").join(F.broadcast(carried), ["path", "_begin"])  # one row per range
    pos = F.col("_before") + F.col("_id") - F.col("_first")
    piece = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    return numbered.where(pos < F.col("_complete")).select("path", pos.alias("pos"), _clean(piece, strip_bytes, charset).alias("record"))
