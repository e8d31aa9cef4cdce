"""Token ids packed into rows of fixed length by best-fit decreasing.

Method. Every text is encoded and closed by an end id. Its ids are cut into pieces of the row length, without loss; full pieces are
rows already. The remainders are dealt over shards by a hash of their row number; each shard sorts its remainders by
falling length and puts each into the row with the least room that suffices, found by a segment tree over the
rooms. A shard holds about SHARD_TOKENS ids, whatever the corpus: the number of shards follows the count of ids.

Result. One row per packed row: ids (little-endian, padded to the row length), the cumulative segment lengths, at
which the positions start again from 0, and for every segment its document and piece, so all texts can be put together again.

Defined cases. Null and empty texts have only the end id. Null ids and repeated rows are packed like others. An empty
table gives an empty table. Only the id and text columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.tables import written

LENGTH = 2048
SHARD_TOKENS = 4_000_000
PACKED = "shard int, row long, n_tokens long, cu_seqlens array<int>, docs array<long>, pieces array<int>, ids binary"


class RoomTree:
    """Segment tree over rooms 0..capacity: finds the least room of at least a given size that some row has."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = bytearray(2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        i = self.size + room
        while i and not self.any[i]:
            self.any[i] = 1
            i >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Removes and returns (room, row), the newest row of the least sufficient room; None if there is none."""
        i = self.size + least
        if not self.any[i]:
            while i > 1 and not (i % 2 == 0 and self.any[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.any[2 * i] else 2 * i + 1
        room = i - self.size
        row = self.rows[room].pop()
        if not self.rows[room]:
            while i and not (i < self.size and (self.any[2 * i] or self.any[2 * i + 1])):
                self.any[i] = 0
                i >>= 1
        return room, row


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Rows of positions in `sizes` (each 1..capacity); equal sizes keep their order."""
    tree, rows = RoomTree(capacity), []
    for k in np.argsort(-sizes, kind="stable").tolist():
        n = int(sizes[k])
        got = tree.take(n)
        if got is None:
            rows.append([])
            got = capacity, len(rows) - 1
        room, row = got
        rows[row].append(k)
        if room > n:
            tree.add(room - n, row)
    return rows


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def _encode(table, length: int):
    def run(batches):
        import tiktoken

        pattern, ranks, end, kind = table.value
        encode = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                ids = [np.array([*encode(t.as_py() or ""), end], kind) for t in part.column(1)]
                full = [[x[k : k + length].tobytes() for k in range(0, len(x) - length + 1, length)] for x in ids]
                rest = [x[len(x) - len(x) % length :].tobytes() for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array(full, pa.list_(pa.binary())), pa.array(rest, pa.binary())], ["d", "n", "full", "rest"]
                )

    return run


def _pack(length: int, kind: str, pad: int):
    def run(key, t):
        width = np.dtype(kind).itemsize
        o = np.argsort(t.column("rid").to_numpy(), kind="stable")
        t = t.take(pa.array(o))
        rest = t.column("rest").to_pylist()
        docs, pieces = t.column("d").to_pylist(), t.column("piece").to_pylist()
        sizes = np.array([len(x) // width for x in rest], np.int64)
        out = []
        for row, members in enumerate(best_fit_decreasing(sizes, length)):
            cu = np.concatenate([[0], np.cumsum(sizes[members])])
            ids = b"".join(rest[k] for k in members)
            ids += np.full(length - int(cu[-1]), pad, kind).tobytes()
            out.append((key[0].as_py(), row, int(cu[-1]), cu.tolist(), [docs[k] for k in members], [pieces[k] for k in members], ids))
        cols = list(zip(*out, strict=True))
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["shard", "row", "n_tokens", "cu_seqlens", "docs", "pieces", "ids"])

    return run


def pack(docs: DataFrame, path: str, pattern: str, length: int = LENGTH, shard_tokens: int = SHARD_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Returns (shard, row, n_tokens, cu_seqlens, docs, pieces, ids); a row that is the full piece k of a text has shard -1 - k.

    path: ranks of byte pairs as text lines; pattern: the regular expression that splits texts into words.
    """
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    end = max(ranks.values()) + 1
    kind = id_type(end + 1)
    table = docs.sparkSession.sparkContext.broadcast((pattern, ranks, end, kind))
    rows = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).cast("string").alias("text"))
    ids = written(rows.mapInArrow(_encode(table, length), "d long, n long, full array<binary>, rest binary"), "ids")
    ids = ids.withColumn("rid", F.monotonically_increasing_id())  # of a written table, so it stays the same
    whole = ids.select("rid", "d", F.posexplode("full").alias("piece", "ids")).select(
        (-1 - F.col("piece")).alias("shard"),
        F.col("rid").alias("row"),
        F.lit(length).cast("long").alias("n_tokens"),
        F.array(F.lit(0), F.lit(length)).alias("cu_seqlens"),
        F.array("d").alias("docs"),
        F.array("piece").alias("pieces"),
        "ids",
    )
    width = np.dtype(kind).itemsize
    rest = ids.filter(F.length("rest") > 0).select("rid", "d", F.size("full").alias("piece"), "rest")
    total = rest.agg(F.sum(F.length("rest"))).first()[0] or 0
    shards = max(1, -(-total // (width * shard_tokens)))
    rest = rest.withColumn("shard", F.pmod(F.xxhash64("rid"), F.lit(shards)).cast("int"))
    packed = rest.groupBy("shard").applyInArrow(_pack(length, kind, end), PACKED)
    return whole.unionAll(packed)


def positions(cu_seqlens: np.ndarray, length: int) -> np.ndarray:
    """Position ids of a packed row: each segment counts from 0; the padding counts on as a segment of its own."""
    out = np.arange(length)
    for a, b in zip(cu_seqlens, [*cu_seqlens[1:], length], strict=True):
        out[a:b] -= a
    return out


def write_packed(packed: DataFrame, path: str, length: int = LENGTH) -> None:
    """Writes the id matrices with position resets as Parquet: ids and position_ids are rows of little-endian integers."""

    def with_positions(batches):
        for batch in batches:
            pos = [positions(np.array(c), length).astype("<u4").tobytes() for c in batch.column("cu_seqlens").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pos, pa.binary())], [*batch.schema.names, "position_ids"])

    packed.mapInArrow(with_positions, PACKED + ", position_ids binary").write.parquet(path)


def default_tokenizer() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _digest(batches):
    for batch in batches:
        sha = [hashlib.sha256(x.as_buffer()).hexdigest() for x in batch.column("ids")]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("shard", "row", "n_tokens", "cu_seqlens", "docs", "pieces")] + [pa.array(sha, pa.string())], ["shard", "row", "n_tokens", "cu_seqlens", "docs", "pieces", "ids_sha256"])


def op1_packing(spark, sf_dir):
    """Registered query: all documents in rows of 2048 ids; the ids as a digest."""
    packed = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), *default_tokenizer())
    return packed.mapInArrow(_digest, PACKED.replace("ids binary", "ids_sha256 string"))
