"""Embedding near-duplicates (operator 6): sorted projection passes.

Equal vectors of a label form a class; only classes go on. In each pass a class has a key, the signs of its products with
random directions one after the other, and classes are put in the lexicographic order of (label, key). Every one is
compared with the next ``window`` in that order, across the borders of partitions as well. What travels in the passes is
a sketch, SKETCH more such signs: pairs whose sketches differ too much for the threshold are dropped, the others are
united across passes to families. A family's vectors come together once, and its pairs are verified by cosine, in blocks
however dense it is: that gives the links, their number, and the components. Only counts and at most a link per row leave
a block, never its pairs.

A pair at the threshold keeps a common prefix long enough to be in one window with a probability that follows from the
size of the largest label; passes are as many as bring the chance to miss it under ``miss``. A window that is full of
copies loses nothing, as each of them is in the family of its neighbours.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import blocks, by_group
from .common import materialize, scratch, small, table
from .components import connected_components, with_components

WINDOW, BITS, MISS = 256, 62, 1e-5
#: Signs of a sketch; rows whose windows are compared at once.
SKETCH, STEP = 256, 64


def passes_for(rows: int, threshold: float, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes that bring the chance to miss a pair at the threshold, among so many rows in random places, under miss."""
    agree = 1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi
    prefix = max(0.0, math.log2(max(1, rows) * 2 / window))
    caught = min(1 - 1e-9, agree**prefix)
    return max(2, math.ceil(math.log(miss) / math.log(1 - caught)))


def _unit(raw: list[bytes], width: int) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), f"<f{width}").reshape(len(raw), -1).astype(np.float64)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _valid(vectors: DataFrame, width: int) -> DataFrame:
    """vec_id, label, key (of label and vector; null if the vector links with nothing), vec."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[bytes | None] = []
            vecs: list[bytes | None] = []
            for label, v in zip(batch.column(1).to_pylist(), batch.column(2)):
                x = None
                if label is not None and v.is_valid and len(v.values) and not v.values.null_count:
                    x = v.values.to_numpy(zero_copy_only=False)
                    with np.errstate(over="ignore"):
                        norm = float((x.astype(np.float64) ** 2).sum())
                    if not (math.isfinite(norm) and norm > 0):
                        x = None
                vecs.append(None if x is None else np.ascontiguousarray(x, f"<f{width}").tobytes())
                keys.append(None if x is None else xxhash.xxh128_digest(label.encode() + b"\0" + vecs[-1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(vecs, pa.binary())], ["vec_id", "label", "key", "vec"])

    return vectors.mapInArrow(run, "vec_id long, label string, key binary, vec binary")


def most_differing(threshold: float, sigmas: float = 6.5) -> int:
    """Differing signs that two sketches of a pair at the threshold exceed with negligible probability."""
    differ = math.acos(min(1.0, max(-1.0, threshold))) / math.pi
    return math.ceil(SKETCH * differ + sigmas * math.sqrt(SKETCH * differ * (1 - differ)))


def _keyed(passes: int, width: int, seed: int):
    """Every class once for each pass, with its sort key and its sketch. Group: pass, label and dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = (np.uint64(1) << np.arange(BITS, dtype=np.uint64)[::-1]).astype(np.uint64)
        directions: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            ids, labels, vecs = (batch.column(batch.schema.get_field_index(c)) for c in ("id", "label", "vec"))
            raw = vecs.to_pylist()
            sizes = np.array([len(x) for x in raw])
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                unit = _unit([raw[i] for i in at], width)
                take = pa.array(at)
                for p in range(-1, passes):
                    if (size, p) not in directions:
                        directions[size, p] = np.random.default_rng((seed, size, p + 1)).standard_normal((size // width, SKETCH if p < 0 else BITS))
                    signs = unit @ directions[size, p] > 0
                    if p < 0:
                        sketch = pa.array([x.tobytes() for x in np.packbits(signs, axis=1)], pa.binary())
                        continue
                    key = (signs * shift).sum(axis=1, dtype=np.uint64).astype(np.int64)
                    group = pa.array([f"{p}/{size}/{x}" for x in labels.take(take).to_pylist()])
                    yield pa.RecordBatch.from_arrays([group, pa.array(key), ids.take(take), sketch], ["grp", "key", "id", "sketch"])

    return run


class _Pieces:
    """Components of the rows of a run, as labels; says which hits of a row join two of them."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def join(self, row: int, hits: np.ndarray) -> list[int]:
        """One hit for each component that the row's component takes in."""
        labels, first = np.unique(self.label[hits], return_index=True)
        new = labels != self.label[row]
        if new.any():
            self.label[np.isin(self.label, labels[new])] = self.label[row]
        return hits[first[new]].tolist()


def _sketches(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), np.uint64).reshape(len(raw), -1)


def _window_links(rows: pa.Table, window: int, limit: int, cross: bool = False) -> list[tuple[int, int]]:
    """Near pairs that join components of a sorted run: each row against the next ``window`` of its group. cross: only
    pairs from both sides of a border."""
    ids, sketch = rows["id"].to_numpy(), _sketches(rows["sketch"])
    group = rows["grp"].combine_chunks().dictionary_encode()
    group = (group.chunk(0) if isinstance(group, pa.ChunkedArray) else group).indices.to_numpy()
    side = rows["side"].to_numpy() if cross else None
    pieces, links, n = _Pieces(len(ids)), [], len(ids)
    for lo in range(0, n, STEP):
        hi, end = min(n, lo + STEP), min(n, lo + STEP + window)
        near = np.bitwise_count(sketch[lo:hi, None] ^ sketch[None, lo:end]).sum(axis=2) <= limit
        i, j = np.nonzero(near)
        keep = (j > i) & (j - i <= window) & (group[lo + i] == group[lo + j])
        if cross:
            keep &= side[lo + i] != side[lo + j]
        i, j = i[keep] + lo, j[keep] + lo
        cuts = np.flatnonzero(np.diff(i)) + 1
        for row, hits in zip(i[np.r_[0, cuts]].tolist() if len(i) else [], np.split(j, cuts)):
            links += [(int(ids[row]), int(ids[x])) for x in pieces.join(row, hits)]
    return links


_PASS = "a long, b long, pid int, side int, pos long, grp string, id long, sketch binary"
_NAMES = ["a", "b", "pid", "side", "pos", "grp", "id", "sketch"]


def _passed(window: int, limit: int):
    """Links inside a partition, and its first and last ``window`` rows for its borders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        held: pa.Table | None = None  # the last window of rows, and what came since
        count = headed = 0

        def edge(rows: pa.Table, side: int, start: int) -> Iterator[pa.RecordBatch]:
            n = rows.num_rows
            none, pids, sides = pa.nulls(n, pa.int64()), pa.array([pid] * n, pa.int32()), pa.array([side] * n, pa.int32())
            out = pa.table([none, none, pids, sides, pa.array(range(start, start + n), pa.int64()), rows["grp"], rows["id"], rows["sketch"]], _NAMES)
            yield from out.combine_chunks().to_batches()

        def work(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            links = _window_links(rows, window, limit)
            if links:
                n = len(links)
                rest = [pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64()), *rest], _NAMES)

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            if headed < window:
                head = rows.slice(0, window - headed)
                yield from edge(head, 1, headed)
                headed += head.num_rows
            held = rows if held is None else pa.concat_tables([held, rows])
            count += rows.num_rows
            if held.num_rows >= 16 * window:
                yield from work(held)
                held = held.slice(held.num_rows - window)
        if held is not None:
            yield from work(held)
            tail = held.slice(max(0, held.num_rows - window))
            yield from edge(tail, 0, count - tail.num_rows)

    return run


def _borders(window: int, limit: int):
    """Links over each border: the rows before it and after it, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            links = _window_links(pa.Table.from_batches(held), window, limit, cross=True)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["a", "b"])

        for batch in batches:
            border = batch.column(batch.schema.get_field_index("border")).to_numpy()
            cuts = (np.flatnonzero(np.diff(border)) + 1).tolist()
            for a, b in zip([0, *cuts], [*cuts, len(border)]):
                if a == b:
                    continue
                if held and border[a] != now:
                    yield from flush()
                    held = []
                now = border[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield from flush()

    return run


def _verified(threshold: float, width: int):
    """For each pair of blocks of a family: (id, linked), the copies linked with a class, and (a, b), verified links that
    join components of the pair of blocks. Vectors of one family have one size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in by_group(batches):
            ids, part, copies = (group.column(c).to_numpy() for c in ("id", "part", "copies"))
            unit = _unit(group.column("vec").to_pylist(), width)
            lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
            one, two = np.flatnonzero(part == lo), np.flatnonzero(part == hi)
            near = unit[one] @ unit[two].T >= threshold
            if lo == hi:
                np.fill_diagonal(near, False)
            pieces, links = _Pieces(len(ids)), []
            for k, row in enumerate(one.tolist()):
                hits = two[near[k]]
                if len(hits):
                    links += [(int(ids[row]), int(ids[j])) for j in pieces.join(row, hits)]
            got = [(ids[one], near @ copies[two])] + ([] if lo == hi else [(ids[two], near.T @ copies[one])])
            who, linked = np.concatenate([x for x, _ in got]), np.concatenate([y for _, y in got]).astype(np.int64)
            n, m = len(who), len(links)
            yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(linked), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], ["id", "linked", "a", "b"])
            if m:
                yield pa.RecordBatch.from_arrays([pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["id", "linked", "a", "b"])

    return run


def vector_links(vectors: DataFrame, threshold: float = 0.98, window: int = WINDOW, miss: float = MISS, seed: int = 6) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors(vec_id, label, embedding).

    Rows are compared only when their labels are equal and not null, and their vectors of one length, by cosine in double
    precision. Vectors that are null, empty, zero or hold null or non-finite components have no links. n_links counts
    the other rows linked directly, equal vectors and repeated rows among them. component_id: the smallest vec_id that is
    reachable; kept: whether it is the row's own. Rows with null vec_id take no part (0 links, null component, not
    kept). Extra columns are ignored; an empty table gives no rows.
    """
    width = 4 if dict(vectors.dtypes)["embedding"] == "array<float>" else 8
    kind = "array<float>" if width == 4 else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").cast(kind))
    with scratch() as keep:
        held, per_class = _linked(rows, width, threshold, window, miss, seed, keep)
    out = held.select("vec_id", "key").withColumn("key", F.when(F.col("vec_id").isNotNull(), F.col("key"))).join(per_class, F.col("key") == F.col("k"), "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def _linked(rows: DataFrame, width: int, threshold: float, window: int, miss: float, seed: int, keep) -> tuple[DataFrame, DataFrame]:
    """All rows with their class key, and (k, links, component) of each class."""
    held = keep(materialize(_valid(rows, width), "vectors"))
    good = held.where("vec_id IS NOT NULL AND key IS NOT NULL")
    classes = materialize(good.groupBy("key").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("vec").alias("vec")), "classes")
    largest = classes.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    passes = passes_for(largest, threshold, window, miss)

    limit = most_differing(threshold)
    keyed = classes.select("id", "label", "vec").mapInArrow(_keyed(passes, width, seed), "grp string, key long, id long, sketch binary")
    ordered = keyed.repartitionByRange("grp", "key", "id").sortWithinPartitions("grp", "key", "id")
    found = materialize(ordered.mapInArrow(_passed(window, limit), _PASS), "passes")
    pids = found.where("pid IS NOT NULL").select("pid").distinct()
    place = materialize(pids.select(F.col("pid").alias("p"), F.row_number().over(Window.orderBy("pid")).alias("place")), "places")  # one row per partition
    edges = found.where("pid IS NOT NULL").join(small(place), F.col("pid") == F.col("p")).withColumn("border", (F.col("place") - F.col("side")).cast("long"))
    borders = edges.select("border", "side", "pos", "grp", "id", "sketch").repartition("border").sortWithinPartitions("border", "side", "pos")
    over = borders.mapInArrow(_borders(window, limit), "a long, b long")
    families = connected_components(found.where("a IS NOT NULL").select("a", "b").union(over))

    inside = classes.select("id", "copies", "vec").join(small(families), F.col("id") == F.col("node")).select(F.col("component").alias("key"), "id", "copies", "vec")
    inside = materialize(inside, "inside")
    sizes = materialize(inside.groupBy("key").agg(F.count("*").alias("size")), "sizes")
    parts = ("key", "lo", "hi")
    paired = blocks(inside, sizes).repartition(*parts).sortWithinPartitions(*parts)
    verified = materialize(paired.mapInArrow(_verified(threshold, width), "id long, linked long, a long, b long"), "verified")
    components = connected_components(verified.where("a IS NOT NULL").select("a", "b"))
    linked = materialize(verified.where("id IS NOT NULL").groupBy("id").agg(F.sum("linked").alias("linked")).withColumnRenamed("id", "l"), "linked")
    per_class = classes.select("key", "id", "copies").join(small(linked), F.col("id") == F.col("l"), "left")
    per_class = with_components(per_class, components, "id", "component")
    per_class = keep(materialize(per_class.select(F.col("key").alias("k"), (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("links"), "component"), "per-class"))
    return held, per_class


def op6_veclinks(spark, sf_dir: str) -> DataFrame:
    return vector_links(table(spark, sf_dir, "embeddings"))


QUERIES = {"op6_veclinks": op6_veclinks}
ORACLE_SQL: dict[str, str] = {
    "op6_veclinks": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND a.norm > 0 AND b.norm > 0 AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
reach(a, b) AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
least AS (SELECT a, least(a, min(b)) AS component FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(l.component, e.vec_id) AS component_id, coalesce(l.component, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN least l ON l.a = e.vec_id"""
}
