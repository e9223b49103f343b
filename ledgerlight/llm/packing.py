"""Mixture-controlled packing (operator 1): deficit round-robin over one token queue per source.

Each source's documents form a queue of tokens. A round fills one window: every source earns credit, its target share of
the window, and sends as many whole ``segment``s of tokens as its credit covers; what it cannot spend yet, its deficit, it
carries to the next rounds, windows and partitions. With segments of a few tokens each window holds each source's share
to within about a segment, also if there are many sources. What a queue sends in a round stays in one piece, so windows
have about a piece per source and document. The round and the place of every token have a closed form in the queues'
totals: every task places its own pieces from the totals and its place in the queue, so nothing is sorted or shuffled and
the hot source is spread over all tasks.

Driver memory: one total for each source. Tasks' placing: linear in sources per round that a document is sent in.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .common import arrow_map, column_or_null, in_chunks, materialize, table, texts

#: Credit is counted in this part of a token.
UNIT = 1024


#: Tokens that a queue sends at least; credit beyond a multiple of it is carried over.
SEGMENT = 8


class Schedule:
    """Closed form of the deficit round-robin over queues with totals[s] tokens and target shares[s]."""

    def __init__(self, totals: list[int], shares: list[float], window: int, segment: int):
        self.totals = np.asarray(totals, np.int64)
        self.segment, self.window = segment, window
        whole = float(sum(shares)) or 1.0
        self.quantum = np.maximum(1, np.rint(np.asarray(shares, float) / whole * window * UNIT)).astype(np.int64)
        self.last_round = -(-(-(-self.totals // segment) * segment * UNIT) // self.quantum)

    def sent(self, s: int | np.ndarray, rounds: np.ndarray) -> np.ndarray:
        """Tokens that queue s has sent after so many rounds."""
        r = np.minimum(rounds, self.last_round[s])
        return np.minimum(self.totals[s], r * self.quantum[s] // (self.segment * UNIT) * self.segment)

    def round_of(self, s: np.ndarray, token: np.ndarray) -> np.ndarray:
        """The round, from 1, in which a queue sends its token."""
        return -(-((token // self.segment + 1) * self.segment * UNIT) // self.quantum[s])

    def place(self, s: np.ndarray, rounds: np.ndarray) -> np.ndarray:
        """Tokens of other queues that are sent before what queue s sends in a round: a token's position in the order of
        all tokens is this and its position in its queue."""
        at = np.zeros(len(s), np.int64)
        for q in range(len(self.totals)):
            at += np.where(s == q, 0, self.sent(q, rounds - (s < q)))
        return at


def tokenized(docs: DataFrame, path: str, end_id: int | None = 1) -> DataFrame:
    """pid, source, doc_id, ids (little-endian), n (tokens), before (the source's tokens before it in this task)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, pid, seen = tokens.encoder(path), TaskContext.get().partitionId(), {}
        for batch in in_chunks(batches, "text", 4 << 20):
            ids, n, before, sources = [], [], [], batch.column(1).to_pylist()
            for text, source in zip(texts(batch), sources):
                own = enc.ids(text)
                if end_id is not None:
                    own.append(end_id)
                ids.append(np.array(own, enc.dtype).tobytes())
                n.append(len(own))
                before.append(seen.get(source, 0))
                seen[source] = before[-1] + len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([pid] * len(n), pa.int32()), batch.column(1), batch.column(0), pa.array(ids, pa.binary()), pa.array(n, pa.int64()), pa.array(before, pa.int64())],
                ["pid", "source", "doc_id", "ids", "n", "before"],
            )

    chosen = docs.select(F.col("doc_id").cast("long"), column_or_null(docs, "source", "string").cast("string").alias("source"), F.col("text").cast("string"))
    return arrow_map(chosen, run, "pid int, source string, doc_id long, ids binary, n long, before long")


def pack(docs: DataFrame, path: str | None = None, targets: dict[str, float] | None = None, window: int = 2048, segment: int = SEGMENT, end_id: int | None = 1, digest: bool = False) -> DataFrame:
    """Place every token of every document in windows of ``window`` tokens.

    targets: share of each source in a window (missing sources get share 0 beside a quantum of a 1024th token); None
    takes the sources' own token shares, the one mixture that every window can have while all rows are packed. Queues
    that run empty leave the round; the others go on with their quanta. While no queue is empty, a source's tokens in a
    window differ from its target by at most a few segments; over 20 sources of the test tables that is a total variation
    of under 0.05 in every full window.

    Returns a row per piece: doc_id, source, start, length, doc_tokens, sequence_id, offset, ids (little-endian, 2 bytes
    an id where the vocabulary allows, else 4), or with digest ids_crc32 in its place, over the ids as unsigned 32-bit
    little-endian numbers. Null text counts as empty and yields the end id alone (with end_id None:
    no piece); null source is a queue of its own; repeated rows and doc_ids are packed row by row; extra columns are
    ignored; an empty table gives an empty result.
    """
    path = path or tokens.default_path()
    held = materialize(tokenized(docs, path, end_id), "tokens")
    by_task = held.groupBy("pid", "source").agg(F.sum("n").alias("n"))
    queue = Window.partitionBy("source").orderBy("pid")
    starts = materialize(by_task.select("pid", "source", "n", (F.sum("n").over(queue) - F.col("n")).alias("base")), "queue-starts")
    totals = sorted(((r.source, r.n) for r in starts.groupBy("source").agg(F.sum("n").alias("n")).collect()), key=lambda x: (x[0] is not None, x[0] or ""))
    order = {s: i for i, (s, _) in enumerate(totals)}
    shares = [n if targets is None else targets.get(s, 0.0) for s, n in totals]
    plan = Schedule([n for _, n in totals], shares, window, segment)

    last = ("ids_crc32", "long") if digest else ("ids", "binary")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            n = col["n"].to_numpy(zero_copy_only=False)
            first = col["first"].to_numpy(zero_copy_only=False)
            s = np.array([order[x] for x in col["source"].to_pylist()], np.int64)
            some = n > 0
            r0, r1 = plan.round_of(s, first), plan.round_of(s, first + np.maximum(n, 1) - 1)
            # a piece for each round from r0 to r1 in which the queue sends something
            count = np.where(some, r1 - r0 + 1, 0)
            row = np.repeat(np.arange(len(n)), count)
            turn = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + r0[row]
            begin = np.maximum(plan.sent(s[row], turn - 1), first[row])
            end = np.minimum(plan.sent(s[row], turn), first[row] + n[row])
            used = end > begin
            row, turn, begin, end = row[used], turn[used], begin[used], end[used]
            at = plan.place(s[row], turn) + begin
            length = end - begin
            cuts = np.where(length > 0, (at + length - 1) // window - at // window + 1, 0)
            part = np.repeat(np.arange(len(row)), cuts)
            j = np.arange(len(part)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
            lo = np.maximum(at[part], (at[part] // window + j) * window)
            hi = np.minimum(at[part] + length[part], (at[part] // window + j + 1) * window)
            rows, start = row[part], begin[part] + lo - at[part] - first[row[part]]
            raw = col["ids"]
            cache, width, pieces = (-1, b""), 2, []
            for r, a, b in zip(rows.tolist(), start.tolist(), (start + hi - lo).tolist()):
                if cache[0] != r:
                    cache = (r, raw[r].as_py())
                    width = len(cache[1]) // int(n[r])
                piece = cache[1][a * width : b * width]
                pieces.append(zlib.crc32(np.frombuffer(piece, f"<u{width}").astype("<u4")) if digest else piece)
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [col["doc_id"].take(take), col["source"].take(take), pa.array(start), pa.array(hi - lo), col["n"].take(take), pa.array(lo // window), pa.array(lo % window), pa.array(pieces, pa.int64() if digest else pa.binary())],
                ["doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset", last[0]],
            )

    b = starts.select(F.col("pid").alias("b_pid"), F.col("source").alias("b_source"), "base")
    joined = held.join(b, (held.pid == b.b_pid) & held.source.eqNullSafe(b.b_source))  # starts has a file's statistics: broadcast only below Spark's threshold
    chosen = joined.select("doc_id", "source", "n", (F.col("base") + F.col("before")).alias("first"), "ids")
    return arrow_map(chosen, place, f"doc_id long, source string, start long, length long, doc_tokens long, sequence_id long, offset long, {' '.join(last)}")


def op1_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), digest=True).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source")


QUERIES = {"op1_packing": op1_packing}
ORACLE_SQL: dict[str, str] = {}
