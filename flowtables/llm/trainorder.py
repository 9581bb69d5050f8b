"""Training order on disk: packed token sequences, shuffled by a keyed permutation.

Documents become tokens, end to end, and the stream is cut into sequences of
equal length. Sequence i goes to the global slot that a keyed Feistel network
gives it; values outside the range are sent through again (cycle walking), so
slots are a permutation and no table of it is kept. Slot // per_shard is the shard.
A shard is one file of records of equal size, so slot s is at byte
(s % per_shard) * stride: a reader can start anywhere and go on in sequence.

A record is the tokens' bytes and a line feed. By default tokens are the UTF-8
bytes of the text (0xFF, which UTF-8 never has, ends a document and 0xFE fills up
the last sequence). With ``ranks`` (a file of base64 token and rank per line) they
are byte-pair tokens of two or four bytes, little-endian.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowtables.llm.common import id_text, ship_functions, stored, with_id

END, FILL = b"\xff", b"\xfe"
ROUNDS = 6


def feistel(index: np.ndarray, size: int, key: int, inverse: bool = False) -> np.ndarray:
    """Slots of ``index`` (0..size-1) under the permutation of ``key``, or with ``inverse`` the indexes of slots."""
    half = max(1, ((max(size - 1, 1)).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64(xxhash.xxh64_intdigest(f"{key}:{r}")) for r in range(ROUNDS)]

    def mixed(x: np.ndarray, k: np.uint64) -> np.ndarray:
        x = (x + k) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x >> np.uint64(32)) & mask

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for k in reversed(keys) if inverse else keys:
            left, right = (right ^ mixed(left, k), left) if inverse else (right, left ^ mixed(right, k))
        return (left << np.uint64(half)) | right

    out = once(np.asarray(index).astype(np.uint64))
    while (outside := out >= size).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def tokenised(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """doc_id, tokens (binary, with the end of document); a null text has only the end."""
    if ranks is None:
        text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.concat(text, F.lit(END)).alias("tokens"))
    pairs = [line.split() for line in docs.sparkSession.sparkContext.binaryFiles(ranks).first()[1].splitlines() if line.strip()]
    table = docs.sparkSession.sparkContext.broadcast({base64.b64decode(a): int(b) for a, b in pairs})
    end = max(table.value.values()) + 1
    kind = np.dtype("<u2") if end < 2**16 - 1 else np.dtype("<u4")

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        pattern = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
        coder = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=table.value, special_tokens={})
        for frame in frames:
            made = [np.array([*coder.encode_ordinary(t or ""), end], kind).tobytes() for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "tokens": made})

    rows = docs.select(id_text(), F.col("text").cast("string").alias("text"))
    return with_id(rows.mapInPandas(work, "doc_id string, tokens binary"))


def materialise(docs: DataFrame, path: str, key: int = 1, length: int = 2048, per_shard: int = 4096, ranks: str | None = None) -> DataFrame:
    """Write the shards below ``path``; returns slot, sequence, shard, record, read back from the files.

    ``length`` is in bytes of tokens. Files are ``path``/shard=<n>/part-*, one for
    each shard; the last is shorter.

    ``docs`` is passed over twice, first to learn how many tokens each partition
    has, so it must be a table as read from files, of which partitions are the
    same each time; a partition that has changed is an error. Byte-pair tokens are
    written to the shared scratch folder first.

    Null and empty texts take one end mark. Rows that repeat an id are written
    each. Very long texts span many sequences. An empty table writes nothing and
    gives an empty table; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = tokenised(docs, ranks).select("tokens")
    if ranks is not None:
        rows = stored(rows, "tokens")

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = sum(sum(map(len, frame["tokens"])) for frame in frames)
        yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "n": [total]})

    sizes = sorted(tuple(r) for r in rows.mapInPandas(measure, "part int, n long").collect())
    begins, total = {}, 0
    for part, n in sizes:
        begins[part] = (total, n)
        total += n
    sequences = -(-total // length)
    if not sequences:
        return spark.createDataFrame([], "slot long, sequence long, shard long, record binary")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, expected = begins[TaskContext.get().partitionId()]
        stop = at + expected
        for frame in frames:
            made = []
            for tokens in frame["tokens"]:
                done = 0
                while done < len(tokens):
                    sequence, inside = divmod(at, length)
                    piece = tokens[done : done + length - inside]
                    made.append((sequence, inside, piece))
                    at, done = at + len(piece), done + len(piece)
            out = pd.DataFrame(made, columns=["sequence", "inside", "piece"])
            out["slot"] = feistel(out["sequence"].to_numpy(np.int64), sequences, key)
            yield out[["slot", "sequence", "inside", "piece"]]
        if at != stop:
            raise ValueError("the input has other partitions than before")

    def join_pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slot, parts = None, []
        for frame in frames:
            done = []
            for s, piece in zip(frame["slot"], frame["piece"], strict=True):
                if s != slot and slot is not None:
                    done.append((slot // per_shard, slot, b"".join(parts).ljust(length, FILL)))
                    parts = []
                slot = s
                parts.append(piece)
            yield pd.DataFrame(done, columns=["shard", "slot", "record"])
        if slot is not None:
            yield pd.DataFrame({"shard": [slot // per_shard], "slot": [slot], "record": [b"".join(parts).ljust(length, FILL)]})

    pieces = rows.mapInPandas(cut, "slot long, sequence long, inside long, piece binary").withColumn("shard", F.expr(f"slot div {per_shard}"))
    shards = -(-sequences // per_shard)
    dealt = pieces.repartition(min(shards, 10_000), "shard").sortWithinPartitions("slot", "inside")
    whole = dealt.select("slot", "piece").mapInPandas(join_pieces, "shard long, slot long, record binary")
    # the text writer copies a string's bytes as they are
    in_place(whole).write.partitionBy("shard").option("lineSep", "\n").text(path)

    return read_records(spark, path, sequences, key, length, per_shard)


def in_place(whole: DataFrame) -> DataFrame:
    """shard, record (as string), sorted by shard and slot in each partition.

    The writer needs rows sorted by shard. It would sort them by that alone, and so
    mix up the slots of a shard when it spills; this order is enough for it, and exact.
    """
    return whole.sortWithinPartitions("shard", "slot").select("shard", F.col("record").cast("string").alias("record"))


def read_records(spark: SparkSession, path: str, sequences: int, key: int, length: int, per_shard: int) -> DataFrame:
    """slot, sequence, shard, record: every record of the shards below ``path``.

    The slot is the record's place in its file, the sequence follows from it.
    """

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard, content in zip(frame["shard"], frame["content"], strict=True):
                count = len(content) // (length + 1)
                records = [content[i * (length + 1) : i * (length + 1) + length] for i in range(count)]
                slots = shard * per_shard + np.arange(count)
                yield pd.DataFrame({"slot": slots, "sequence": feistel(slots, sequences, key, inverse=True), "shard": shard, "record": records})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(path)
    return files.select(F.col("shard").cast("long").alias("shard"), "content").mapInPandas(work, "slot long, sequence long, shard long, record binary")


ship_functions(__name__)
