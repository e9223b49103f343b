"""MinHash near-duplicates (operator 4) with odd sketches and exact confirmation.

1. Texts with equal shingle sets form a class, named by its smallest doc_id; only classes go on.
2. A class's MinHash samples make band keys. Classes that share a key are candidates of each other.
3. Of each bucket two members stand for it: the one with the most bucket mates over all bands, which in a group of copies
   is the text that they come from, and one drawn by hash. Members are paired with these only, so a bucket of n gives
   n pairs, not n * n.
4. An odd sketch, the parity bitmap of the samples, is XORed for each pair; the population count estimates the
   similarity. Pairs too far below the threshold for chance are dropped; the others make families by distributed
   contraction. In buckets that hold several families, the members outside the largest one are held against all members,
   in blocks by sketch, which joins families, so that no link is lost by the choice in 3.
5. A bucket in which more than BLOCK members lie outside its largest family is crowded: pages of one template share the
   template's bands and are far apart. It is put off until 6 is done, as are buckets that are crowded in 6.
6. A family's members bring their full shingle sets together once. In families of more than BLOCK members the pairs of 3
   are confirmed first; then each member outside the main component, in smaller families every member, is held against
   the family in blocks: near ones by sketch, nearest first, are confirmed until they are connected. A block emits at most
   a link per member. Families in which more than BLOCK members are left are worked bucket by bucket.
7. Crowded buckets whose members are not all connected by then are finished without loss. Their sets are ordered, rare
   shingles first. Two similar sets share a shingle of their prefixes, the first n - ceil(n * threshold) + 1 of each. The
   rare shingles of the prefixes are keys by which members meet. What meets by none of them is similar by common shingles
   alone, so the smaller of the two consists of them to 2 * threshold / (1 + threshold) at least; such members are held
   against all of their buckets in blocks, or the members outside the largest component, if these are fewer.
8. Links become components by distributed contraction.

Band layout: BANDS * ROWS samples; a pair of similarity 0.8 shares no key with probability below 1e-6, one of 0.85 below
1e-9; crowded buckets add nothing to that. A pair at the threshold has sketches that differ too much with probability 1e-7.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import BLOCK, against_all, by_group
from .common import arrow_map, gathered, in_chunks, materialize, scratch, small, table
from .components import connected_components, with_components

BANDS, ROWS = 36, 5
SKETCH_BITS = 1024
#: A shingle is common if more members of crowded buckets have it, beside twice the mean of the SLOTS counters that shingles
#: are counted in. Any order and any choice of common shingles gives the same links; this one keeps the keys' groups small.
COMMON = 64
SLOTS = 1 << 20
_rng = np.random.default_rng(20240229)
_FLIP = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_MULT = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_SALT = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_W = _rng.integers(0, 1 << 63, 8, dtype=np.uint64) | np.uint64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text; A-Z are lower-cased, words are parted by ASCII white
    space. Fewer words than width: the whole sequence is one shingle; no word: none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(w) for w in words], np.uint64)
    with np.errstate(over="ignore"):
        if len(h) < width:
            out = np.array([len(h)], np.uint64)
            for x in h:
                out = _mix(out * _W[0] + x)
            return out
        n = len(h) - width + 1
        out = np.zeros(n, np.uint64)
        for i in range(width):
            out = _mix(out * _W[1] + h[i : n + i])
    return np.unique(out)


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """One row of BANDS * ROWS samples for each (not empty) set."""
    low = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((BANDS * ROWS, len(sets)), np.uint32)
    with np.errstate(over="ignore"):
        for i in range(BANDS * ROWS):
            out[i] = np.minimum.reduceat((low ^ _FLIP[i]) * _MULT[i], starts)
    return out.T


def band_keys(samples: np.ndarray) -> np.ndarray:
    """A 64-bit key per band; bands have different keys for equal samples."""
    out = np.empty((len(samples), BANDS), np.uint64)
    with np.errstate(over="ignore"):
        for b in range(BANDS):
            h = np.full(len(samples), b + 1, np.uint64)
            for r in range(ROWS):
                h = _mix(h * _W[2] + samples[:, b * ROWS + r])
            out[:, b] = h
    return out.view(np.int64)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps: each sample flips the bit that its index and value hash to."""
    with np.errstate(over="ignore"):
        bit = _mix(samples.astype(np.uint64) * _SALT) % np.uint64(SKETCH_BITS)
    count = np.zeros((len(samples), SKETCH_BITS), np.uint8)
    np.add.at(count, (np.arange(len(samples))[:, None], bit), 1)
    return np.packbits(count & 1, axis=1)


def similarity_from(flipped: float) -> float:
    """Estimate from the population count of two sketches' XOR."""
    share = min(flipped / SKETCH_BITS, 0.499999)
    differing = math.log(1 - 2 * share) / math.log(1 - 2 / SKETCH_BITS) / 2
    return max(0.0, 1 - differing / (BANDS * ROWS))


def most_flipped(threshold: float, sigmas: float = 5.2) -> int:
    """XOR population count that a pair at the threshold exceeds with negligible probability: a normal bound over the spread
    of the samples that differ and of the bits that they share."""
    k = BANDS * ROWS
    lost, spread = k * (1 - threshold), math.sqrt(k * threshold * (1 - threshold))
    flipped = lambda n: SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** (2 * n))
    deviation = math.sqrt((flipped(lost + spread) - flipped(lost)) ** 2 + 0.15 * flipped(lost) + 1)
    return math.ceil(flipped(lost) + sigmas * deviation)


def _signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n, key (of the whole set), bands, sketch; an empty set has null key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "text", 2 << 20):
            sets = [shingles(t, width) for t in batch.column(1).to_pylist()]
            n = np.array([len(s) for s in sets], np.int64)
            some = np.flatnonzero(n)
            keys: list[bytes | None] = [None] * len(sets)
            bands: list[np.ndarray | None] = [None] * len(sets)
            sketches: list[bytes | None] = [None] * len(sets)
            if len(some):
                samples = minhashes([sets[i] for i in some])
                for i, b, s in zip(some.tolist(), band_keys(samples), odd_sketches(samples)):
                    keys[i], bands[i], sketches[i] = xxhash.xxh128_digest(sets[i].tobytes()), b, s.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary())], ["doc_id", "n", "key", "bands", "sketch"]
            )

    return arrow_map(docs, run, "doc_id long, n long, key binary, bands array<long>, sketch binary")


def _sets(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "text", 2 << 20):
            sets = [shingles(t, width).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["id", "members"])

    return arrow_map(docs, run, "id long, members array<long>")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    one = sets.select(F.col("id").alias("a"), F.col("members").alias("ma"))
    two = sets.select(F.col("id").alias("b"), F.col("members").alias("mb"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b").withColumn("both", F.size(F.array_intersect("ma", "mb")))
    return both.where(100 * F.col("both") >= percent * (F.size("ma") + F.size("mb") - F.col("both"))).select("a", "b")


def _linked(limit: int, percent: int, exact: bool):
    """Links between components in each group, at most one fewer than its components: pairs near by size and sketch, and
    if exact, confirmed on their full sets, the nearest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in by_group(batches):
            ids, n, side = (group.column(c).to_numpy() for c in ("id", "n", "side"))
            _, label = np.unique(group.column("component").to_numpy(), return_inverse=True)
            sketch = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint64).reshape(len(n), -1)
            sets: dict[int, np.ndarray] = {}
            members = group.column("members") if exact else None

            def full(i: int) -> np.ndarray:
                if i not in sets:
                    sets[i] = members[i].values.to_numpy()
                return sets[i]

            def similar(i: int, j: int) -> bool:
                one, two = full(i), full(j)
                both = len(np.intersect1d(one, two, assume_unique=True))
                return 100 * both >= percent * (len(one) + len(two) - both)

            links: list[tuple[int, int]] = []
            place = np.arange(len(n))
            for i in np.flatnonzero(side != 1).tolist():
                some = (label != label[i]) & (side != 0) & (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i]))
                if side[i] == 2:
                    some &= (side == 1) | (place > i)
                at = np.flatnonzero(some)
                flipped = np.bitwise_count(sketch[at] ^ sketch[i]).sum(axis=1)
                at = at[np.argsort(flipped, kind="stable")][: int((flipped <= limit).sum())]
                while len(at):
                    j = int(at[0])
                    if exact and not similar(i, j):
                        at = at[1:]
                        continue
                    label[label == label[j]] = label[i]
                    links.append((int(ids[i]), int(ids[j])))
                    at = at[label[at] != label[i]]
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["a", "b"])

    return run


def _grouped(members: DataFrame, sizes: DataFrame) -> DataFrame:
    parts = ("key", "lo", "hi")
    return against_all(members, sizes).repartition(*parts).sortWithinPartitions(*parts)


def _outside(groups: DataFrame) -> DataFrame:
    """(key, size, main, odds) of the keys that hold several components: the largest one, and the members outside it."""
    parts = groups.groupBy("key", "component").agg(F.count("*").alias("n"))
    stats = parts.groupBy("key").agg(F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("size")).where("size > main.n")
    return materialize(gathered(stats.select("key", "size", F.col("main.component").alias("main"), (F.col("size") - F.col("main.n")).alias("odds"))), "several")


def _by_bucket(groups: DataFrame, crowded: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """members(key, id, component, odd) and sizes(key, size, odds) of the groups(key, id, component) that hold several
    components; rows of those with more than BLOCK members outside the largest one are appended to crowded instead."""
    several = _outside(groups)
    hard = F.col("odds") > BLOCK
    if not several.where(hard).isEmpty():
        crowded.append(materialize(groups.select("key", "id").join(small(several).where(hard).select("key"), "key", "left_semi"), "crowded"))
    easy = small(several).where(~hard)
    return groups.select("key", "id", "component").join(easy.select("key", "main"), "key").withColumn("odd", F.col("component") != F.col("main")).drop("main"), easy.select("key", "size", "odds")


def _slot_counts(sets: DataFrame) -> np.ndarray:
    """How many shingles of all sets fall in each of SLOTS counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            total += np.bincount(_slots(batch.column(0).flatten().to_numpy()), minlength=SLOTS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["slot", "n"])

    found = arrow_map(sets.select("members"), run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SLOTS, np.int64)
    out[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return out


def _slots(members: np.ndarray) -> np.ndarray:
    return (members & np.int64(SLOTS - 1)).astype(np.int64)


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """id, full, keys of sets(id, members). keys: the rare shingles of a set's prefix; full: whether a set that is at least
    as large can be similar by common shingles alone.

    Driver and each worker: SLOTS counters. Sets x, y with 100 * |x & y| >= percent * |x | y| have at least
    ceil(percent * n / 100) shingles in common, for the n of either, so the first one in the order lies in both prefixes.
    If y is the smaller and has c common shingles, at least ceil(2 * percent * |y| / (100 + percent)) - c of them are rare.
    """
    counts = _slot_counts(sets)
    most = COMMON + 2 * int(counts.mean())
    shared = sets.sparkSession.sparkContext.broadcast(np.minimum(counts, (1 << 32) - 1).astype(np.uint32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            full, keys = [], []
            for row in batch.column(1):
                own = row.values.to_numpy()
                n, seen = len(own), counts[_slots(own)]
                rare = int((seen <= most).sum())
                prefix = n + percent * n // -100 + 1
                keys.append(own[np.lexsort((own, seen))[: min(prefix, rare)]])
                full.append((n - rare) * (100 + percent) >= 2 * percent * n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(full, pa.bool_()), pa.array(keys, pa.list_(pa.int64()))], ["id", "full", "keys"])

    return arrow_map(sets.select("id", "members"), run, "id long, full boolean, keys array<long>")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs.

    Two texts are linked if 100 * |intersection| >= percent * |union| of their sets of ``width``-word shingles.
    component_id is the smallest doc_id that is reachable over links, the row's own included; kept is whether that is the
    row itself. Texts without a word, null ones included, have no shingle and no link. Rows with the same doc_id are one
    node. Rows with null doc_id take no part: component_id is null, kept false. Extra columns are ignored; an empty
    table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    with scratch() as keep:
        signed, classes, components = _judged(rows, width, percent, keep)
    named = classes.select(F.col("key").alias("k"), F.col("id"))
    joined = signed.select("doc_id", "n", "key").join(named, F.col("key") == F.col("k"), "left")
    # doc_ids that name no class of their own reach the class through its id
    joined = joined.withColumn("node", F.when(F.col("doc_id").isNotNull(), F.coalesce("id", "doc_id")))
    out = with_components(joined, components, "node", "component_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _judged(rows: DataFrame, width: int, percent: int, keep) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signatures of all rows, classes of equal sets, and the classes' components."""
    signed = keep(materialize(_signatures(rows, width), "signatures"))
    known = signed.where("doc_id IS NOT NULL AND key IS NOT NULL")
    classes = keep(materialize(known.groupBy("key").agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "classes"))
    return signed, classes, keep(connected_components(_links(rows, classes, width, percent)))


def _links(rows: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    limit = most_flipped(percent / 100)
    buckets = classes.select("id", F.explode("bands").alias("key"))
    shared = buckets.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("size")).where("lo < hi")
    shared = materialize(gathered(shared.select("key", "size")), "buckets")
    members = materialize(buckets.join(small(shared), "key"), "members")
    degree = materialize(gathered(members.groupBy("id").agg(F.sum("size").alias("degree"))), "degree")
    weighed = members.select("key", "id").join(small(degree), "id")
    stand = weighed.groupBy("key").agg(F.max(F.struct("degree", F.xxhash64("id").alias("x"), "id"))["id"].alias("r1"), F.min(F.struct(F.xxhash64("id", F.lit(3)).alias("x"), "id"))["id"].alias("r2"))
    stand = materialize(gathered(stand), "stand")
    pairs = members.select("key", "id").join(small(stand), "key").select("id", F.explode(F.array("r1", "r2")).alias("r")).where("id <> r")
    pairs = pairs.select(F.least("id", "r").alias("a"), F.greatest("id", "r").alias("b")).distinct()
    known = materialize(classes.select("id", "n", "sketch").join(small(degree).select("id"), "id", "left_semi"), "known")
    near = materialize(gathered(_near(pairs, known, percent, limit).select("a", "b")), "near")

    # families: components of pairs that are near by sketch; buckets that hold several are compared in blocks
    families = connected_components(near)
    placed = materialize(with_components(members.select("key", "id"), families, "id", "component"), "placed")
    sketched = small(known)
    crowds: list[DataFrame] = []
    group, sizes = _by_bucket(placed, crowds)
    families = connected_components(near.union(arrow_map(_grouped(group.join(sketched, "id"), sizes), _linked(limit, percent, False), "a long, b long")))

    # every link lies in a family or in a crowded bucket: confirm on full sets
    docs = rows.withColumnRenamed("doc_id", "id")
    sets = materialize(_sets(docs.join(small(families), F.col("id") == F.col("node"), "left_semi"), width), "sets")
    sizes = materialize(families.groupBy(F.col("component").alias("key")).agg(F.count("*").alias("size")).where(F.col("size") > BLOCK), "sizes")
    large = materialize(families.join(small(sizes), F.col("component") == F.col("key"), "left_semi"), "large")
    stars = near.join(small(large).select(F.col("node").alias("a")), "a", "left_semi")
    first = materialize(gathered(_confirm(stars, sets, percent)), "links")
    inner = with_components(families.select(F.col("node").alias("id"), F.col("component").alias("key")), connected_components(first), "id", "component")
    inner = materialize(inner, "inner")
    parts = inner.groupBy("key", "component").agg(F.count("*").alias("n"))
    main = parts.groupBy("key").agg(F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("size"))
    main = main.select("key", "size", F.when(F.col("size") > BLOCK, F.col("main.component")).alias("main"), F.when(F.col("size") > BLOCK, F.col("size") - F.col("main.n")).otherwise(F.col("size")).alias("odds"))
    main = materialize(gathered(main.where("odds > 0")), "main")
    crowded = F.col("odds") > BLOCK
    easy = inner.join(small(main).where(~crowded).select("key", "main"), "key").withColumn("odd", ~F.col("component").eqNullSafe(F.col("main"))).drop("main")
    confirmed = lambda group, sizes, sets: arrow_map(_grouped(group.join(sketched, "id").join(sets, "id"), sizes), _linked(limit, percent, True), "a long, b long")
    links = [confirmed(easy, small(main).where(~crowded).select("key", "size", "odds"), sets)]
    if not main.where(crowded).isEmpty():
        apart = inner.join(small(main).where(crowded).select("key"), "key", "left_semi").withColumnRenamed("key", "family")
        shared = members.select("key", "id").join(apart, "id").select(F.xxhash64("key", "family").alias("key"), "id", "component")
        links.append(confirmed(*_by_bucket(materialize(shared, "apart"), crowds), sets))
    links = reduce(DataFrame.union, links, first)
    if not crowds:
        return links

    # what the links so far leave apart in crowded buckets
    found = connected_components(links)
    done = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    groups = materialize(with_components(reduce(DataFrame.union, crowds), found, "id", "component"), "crowds")
    several = _outside(groups)
    ids = materialize(groups.join(small(several).select("key"), "key", "left_semi").select("id").distinct(), "crowd-ids")
    sets = materialize(_sets(docs.join(small(ids), "id", "left_semi"), width), "crowd-sets")
    marked = materialize(_prefixes(sets, percent), "prefixes")
    full = materialize(marked.where("full").select("id", "full"), "full")
    groups = materialize(groups.join(small(several).select("key", "main"), "key").join(small(full), "id", "left"), "crowds-apart")
    chosen = several.join(groups.groupBy("key").agg(F.count("full").alias("n_full")), "key")
    chosen = materialize(chosen.select("key", "size", F.least("odds", "n_full").alias("odds"), (F.col("odds") <= F.col("n_full")).alias("outer")), "crowd-sizes")
    odd = F.when(F.col("outer"), F.col("component") != F.col("main")).otherwise(F.col("full").isNotNull())
    some = groups.join(small(chosen).where("odds > 0").select("key", "outer"), "key").select("key", "id", "component", odd.alias("odd"))
    links = [done, confirmed(some, small(chosen).where("odds > 0").select("key", "size", "odds"), sets)]
    rest = materialize(groups.join(small(chosen).where("NOT outer").select("key"), "key", "left_semi").select("id", "component").distinct(), "crowd-rest")
    keyed = materialize(marked.join(small(rest), "id").select(F.explode("keys").alias("key"), "id", "component"), "by-shingle")
    several = _outside(keyed)
    few = F.col("size") <= COMMON
    one, two = (keyed.join(small(several).where(few).select("key"), "key", "left_semi").select("key", F.col("id").alias(x), F.col("component").alias(f"c{x}")) for x in "ab")
    pairs = one.join(two, "key").where("a < b AND ca <> cb").select("a", "b").distinct()
    links.append(_confirm(materialize(_near(pairs, known, percent, limit), "near-rest"), sets, percent))
    many = small(several).where(~few)
    some = keyed.join(many.select("key", "main"), "key").withColumn("odd", F.col("component") != F.col("main")).drop("main")
    links.append(confirmed(some, many.select("key", "size", "odds"), sets))
    return reduce(DataFrame.union, links)


def _near(pairs: DataFrame, known: DataFrame, percent: int, limit: int) -> DataFrame:
    """pairs(a, b) that are near by size and sketch."""
    one, two = (small(known).select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}")) for x in "ab")
    sized = pairs.join(one, "a").join(two, "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return arrow_map(sized, _flipped(limit), "a long, b long, flipped int")


def _flipped(limit: int):
    """a, b and the population count of their sketches' XOR, where it is small enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.schema.get_field_index
            x, y = (np.frombuffer(b"".join(batch.column(at(c)).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for c in ("sa", "sb"))
            flipped = np.bitwise_count(x ^ y).sum(axis=1)
            near = flipped <= limit
            keep = pa.array(near)
            yield pa.RecordBatch.from_arrays([batch.column(at("a")).filter(keep), batch.column(at("b")).filter(keep), pa.array(flipped[near].astype(np.int32))], ["a", "b", "flipped"])

    return run


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of docs for each component: that of the smallest doc_id, rows without one last. Columns are docs'.

    Rows with null doc_id, and rows whose doc_id stands for several texts, are documents of their own by doc_id and text, so
    different texts are never dropped for their ids. Of rows that are equal in doc_id and text one stays, the first by a
    hash of all its columns. Texts without a word, null ones included, link with nothing. An empty table gives no rows.
    """
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("n__row"), F.col("doc_id").cast("long").alias("n__doc"), F.col("text").cast("string").alias("n__body"))
    texts = inner.select("n__doc", F.xxhash64("n__body").alias("h")).groupBy("n__doc").agg(F.min("h").alias("lo"), F.max("h").alias("hi"))
    unclear = materialize(texts.where("n__doc IS NULL OR lo <> hi").select(F.col("n__doc").alias("n__unclear"), F.lit(True).alias("n__many")), "unclear-ids")
    if unclear.isEmpty():
        inner = inner.withColumn("n__node", F.col("n__doc"))
    else:  # above all usual ids, so that these name a component
        own = F.xxhash64("n__doc", "n__body").bitwiseAND((1 << 62) - 1).bitwiseOR(1 << 62)
        inner = inner.join(small(unclear), F.col("n__doc").eqNullSafe(F.col("n__unclear")), "left").withColumn("n__node", F.when(F.col("n__many"), own).otherwise(F.col("n__doc")))
    judged = near_duplicates(inner.select(F.col("n__node").alias("doc_id"), F.col("n__body").alias("text")), width, percent)
    verdicts = judged.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("copies"))
    marked = materialize(gathered(verdicts.where("NOT kept OR copies > 1").withColumnRenamed("doc_id", "n__id")), "verdicts")
    same = F.col("n__node") == F.col("n__id")
    left = inner.select("n__row", "n__node").join(small(marked).select("n__id"), same, "left_anti")
    repeated = small(marked).where("kept").select("n__id")
    if not repeated.isEmpty():
        again = inner.select("n__row", "n__node").join(repeated, same, "left_semi").withColumn("h", F.xxhash64("n__row"))
        left = left.unionByName(again.groupBy("n__node").agg(F.min_by("n__row", "h").alias("n__row")).select("n__row", "n__node"))
    return left.select(*[F.col("n__row").getField(c).alias(c) for c in docs.columns])


def op4_neardup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


QUERIES = {"op4_neardup": op4_neardup}
ORACLE_SQL = {
    "op4_neardup": """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS grams FROM w),
x AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k FROM x a JOIN x b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE 100 * k >= 85 * (na + nb - k)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT s.doc_id, len(s.grams)::BIGINT AS n_shingles, coalesce(least(s.doc_id, low.b), s.doc_id) AS component_id, coalesce(least(s.doc_id, low.b), s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN low ON low.a = s.doc_id"""
}
