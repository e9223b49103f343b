"""Token-id output (operator 10): best-fit-decreasing packing with a segment tree over bin capacities.

Each task packs its own documents in blocks of at most ``block_tokens`` tokens: overlong documents are first split into
whole rows and a rest, the pieces are sorted by falling length, and each goes to the fullest row that still has room,
found by descending a segment tree whose leaves, one for each free capacity, say whether a row of that capacity is open.
No shuffle and no state beyond a block, so a hot source or a copied document costs nothing extra and a lost task is
simply packed again; rows are numbered by (partition, row).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import arrow_map, in_chunks, table, texts


class Capacities:
    """Segment tree over capacities 0..size: open rows by free room; finds the least free room that is enough."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def _add(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) of the fullest open row with room >= need; the row is taken out."""
        node = self.leaves + need
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._add(room, -1)
        return room, self.rows[room].pop()


def best_fit_decreasing(lengths: list[int], width: int) -> list[list[tuple[int, int, int]]]:
    """Rows of (document, start, length); documents longer than width are split into whole rows and a rest.

    Ties in length keep the documents' order; among rows of equal room the last opened is taken.
    """
    rows: list[list[tuple[int, int, int]]] = []
    rest = []
    for i, n in enumerate(lengths):
        at = 0
        while n - at >= width:
            rows.append([(i, at, width)])
            at += width
        if n > at:
            rest.append((i, at, n - at))
    free = Capacities(width)
    for piece in sorted(rest, key=lambda x: (-x[2], x[0])):
        found = free.take(piece[2])
        if found is None:
            rows.append([piece])
            room, row = width - piece[2], len(rows) - 1
        else:
            room, row = found[0] - piece[2], found[1]
            rows[row].append(piece)
        if room:
            free.put(room, row)
    return rows


SCHEMA = "sequence_id long, ids binary, n_tokens int, cu_seqlens array<int>, doc_ids array<long>, starts array<int>, position_resets array<int>"


def pack_binary(docs: DataFrame, path: str | None = None, width: int = 2048, end_id: int | None = 1, pad_id: int = 0, block_tokens: int = 4 << 20) -> DataFrame:
    """Packed id matrix, a row of ``width`` ids (little-endian, padded with pad_id) per sequence.

    n_tokens: ids before the padding. cu_seqlens: cumulative segment lengths from 0 to n_tokens. doc_ids and starts: the
    document of each segment and the segment's first token there. position_resets: places in the row where positions
    start again from 0. Null or empty text is the end id alone (with end_id None: no piece); null doc_ids, repeated rows
    and extra columns are fine; an empty table gives no rows.
    """
    path = path or tokens.default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, base, made = tokens.encoder(path), TaskContext.get().partitionId() << 40, 0
        held: list[np.ndarray] = []
        names: list[int | None] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal made
            rows = best_fit_decreasing([len(x) for x in held], width)
            for lo in range(0, len(rows), 512):
                some = rows[lo : lo + 512]
                out = np.full((len(some), width), pad_id, enc.dtype)
                cu = []
                for r, row in enumerate(some):
                    ends = [0]
                    for i, at, n in row:
                        out[r, ends[-1] : ends[-1] + n] = held[i][at : at + n]
                        ends.append(ends[-1] + n)
                    cu.append(ends)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(base + made, base + made + len(some)), pa.int64()), pa.array([x.tobytes() for x in out], pa.binary()), pa.array([x[-1] for x in cu], pa.int32()), pa.array(cu, pa.list_(pa.int32())),
                     pa.array([[names[p[0]] for p in row] for row in some], pa.list_(pa.int64())), pa.array([[p[1] for p in row] for row in some], pa.list_(pa.int32())), pa.array([x[:-1] for x in cu], pa.list_(pa.int32()))],
                    ["sequence_id", "ids", "n_tokens", "cu_seqlens", "doc_ids", "starts", "position_resets"],
                )
                made += len(some)
            held.clear()
            names.clear()

        total = 0
        for batch in in_chunks(batches, "text", 4 << 20):
            for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch)):
                ids = enc.ids(text)
                if end_id is not None:
                    ids.append(end_id)
                held.append(np.array(ids, enc.dtype))
                names.append(doc_id)
                total += len(ids)
                if total >= block_tokens:
                    yield from flush()
                    total = 0
        yield from flush()

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, SCHEMA)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write packed rows as Parquet files of about 64,000 rows each, ids as one fixed-width binary value a row."""
    packed.write.option("maxRecordsPerFile", 1 << 16).option("compression", "zstd").parquet(path)


def unpacked(ids: bytes, cu_seqlens: list[int], width: int = 2048) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, positions, segments) of one row: positions start from 0 in every segment; the padding's segment is -1."""
    row = np.frombuffer(ids, f"<u{len(ids) // width}")
    cuts = np.asarray(cu_seqlens)
    segments = np.searchsorted(cuts, np.arange(width), side="right") - 1
    segments[cuts[-1] :] = -1
    positions = np.where(segments < 0, 0, np.arange(width) - cuts[np.maximum(segments, 0)])
    return row, positions, segments


def op10_binary(spark, sf_dir: str) -> DataFrame:
    return pack_binary(table(spark, sf_dir, "documents"))


QUERIES = {"op10_binary": op10_binary}
ORACLE_SQL: dict[str, str] = {}
