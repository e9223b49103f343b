import collections
import random
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from ledgerlight.llm import common, components, neardup, veclinks
from ledgerlight.llm.common import materialize, scratch, shared_dir
from ledgerlight.llm.components import connected_components


def components_of(nodes, links):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    groups = collections.defaultdict(list)
    for x in nodes:
        groups[find(x)].append(x)
    return {x: min(g) for g in groups.values() for x in g}


def test_components_of_chains_stars_and_rings(spark):
    r = random.Random(3)
    links = [(i, i + 1) for i in range(300)] + [(1000, 1001 + i) for i in range(200)] + [(5000 + i, 5000 + (i + 1) % 50) for i in range(50)] + [(7, 7), (9000, 9001), (9001, 9000)]
    r.shuffle(links)
    df = spark.createDataFrame(links + [(None, 3)], "a long, b long")
    got = {row.node: row.component for row in connected_components(df).collect()}
    assert got == components_of({x for p in links for x in p}, links)
    assert connected_components(df.limit(0)).collect() == []


def test_components_by_rounds_and_by_one_task(spark, monkeypatch):
    r = random.Random(4)
    links = [(r.randrange(400), r.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(100)] + [(3000, 2000 + i) for i in range(90)]
    wanted = components_of({x for a, b in links if a != b for x in (a, b)}, links)
    df = spark.createDataFrame([*links, (None, 3), (5, None)], "a long, b long")
    assert {row.node: row.component for row in connected_components(materialize(df, "links")).collect()} == wanted
    for most in (components.LOCAL_BYTES, 4000, 0):
        monkeypatch.setattr(components, "LOCAL_BYTES", most)
        assert {row.node: row.component for row in connected_components(df).collect()} == wanted


def test_few_links_take_few_tables_without_checksum_files(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir()) if folder.exists() else set()
    tables = []
    with scratch() as keep:
        keep(connected_components(df))
        tables = [p for p in folder.iterdir() if p not in before]
        assert len(tables) == 1  # the links' own table is deleted by now
        assert {p.suffix for p in tables[0].iterdir()} == {"", ".parquet"}
        assert len(common._SCRATCH.open[-1]) <= 2


def test_links_are_written_in_a_few_files(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(3000)], "a long, b long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        with scratch():
            assert len(materialize(common.gathered(df.distinct()), "few").inputFiles()) == 8
            assert connected_components(df).where("component = 0").count() == 3001
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def sets_of(text, width):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    return set(zip(*[words[i:] for i in range(width)])) if len(words) >= width else {tuple(words)} if words else set()


def brute(rows, width, percent):
    sets = {i: sets_of(t, width) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {i: len(s) for i, s in sets.items()}, components_of(ids, links)


def corpus():
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    rows = [(i, " ".join(word() for _ in range(r.randint(1, 120)))) for i in range(80)]
    base = [word() for _ in range(90)]
    for i in range(200, 290):  # variants of one text around the threshold
        text = list(base)
        for _ in range(r.randint(0, 5)):
            text[r.randrange(len(text))] = word()
        rows.append((i, " ".join(text)))
    chain = [word() for _ in range(70)]
    for i in range(300, 330):  # every text near the one before
        chain[i % 70] = word()
        rows.append((i, " ".join(chain)))
    rows += [(400 + i, "Same  text\nhere TWICE over and over") for i in range(25)] + [(450, "same text here twice OVER and over\x0b")]
    rows += [(500, None), (501, ""), (502, " \t "), (503, "one"), (504, "ONE"), (505, "one two"), (506, "two one"), (507, "one\u00a0two"), (508, "É é"), (509, "é É")]
    return rows


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_same_components_as_brute_force(spark, width, percent, monkeypatch):
    rows = corpus()
    sizes, want = brute(rows, width, percent)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, key string")
    got = neardup.near_duplicates(docs, width, percent).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.n_shingles == sizes[r.doc_id] and r.kept == (r.doc_id == r.component_id) for r in got)


def test_large_families_in_blocks(spark, monkeypatch):
    from ledgerlight.llm import blocks

    monkeypatch.setattr(blocks, "BLOCK", 16)
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rows = corpus()
    _, want = brute(rows, 3, 85)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 3, 85).collect()} == want


def templated(n, seed=4):
    """Pages of one template, 60 words of it and 24 of their own, nothing to link but a near copy of every fiftieth."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(6))
    template = " ".join(word() for _ in range(60))
    rows = [(i, f"{template} {' '.join(word() for _ in range(24))}") for i in range(n)]
    return rows + [(100_000 + i, rows[i][1] + " z") for i in range(0, n, 50)]


def test_pages_of_a_template_meet_by_several_keys(spark, monkeypatch):
    from ledgerlight.llm import blocks

    monkeypatch.setattr(blocks, "BLOCK", 32)
    monkeypatch.setattr(neardup, "BLOCK", 32)
    levels = []
    real = neardup._outside
    monkeypatch.setattr(neardup, "_outside", lambda groups: levels.append(1) or real(groups))
    rows = templated(1500)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs).collect()}
    assert got == {i: i - 100_000 if i >= 100_000 else i for i, _ in rows}
    assert len(levels) >= 3


def pairs_with_few_keys(tries=20_000, most=5):
    """Pairs of similarity 0.8 on a template of 70 words whose shared band keys are few and all the template's; and a
    function that makes further pages, near nothing."""
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(6))
    template = [word() for _ in range(70)]
    keys = lambda texts: neardup.band_keys(neardup.minhashes([neardup.shingles(t, 5) for t in texts]))
    shared = keys([" ".join(template)])[0]
    found = []
    for _ in range(0, tries, 2000):
        rests = [[word() for _ in range(15)] for _ in range(2000)]
        pairs = [(" ".join(template + x), " ".join(template + x[:-9] + [word() for _ in range(9)])) for x in rests]
        one, two = (keys([p[i] for p in pairs]) for i in (0, 1))
        n = (one == two).sum(axis=1)
        found += [pairs[i] for i in np.flatnonzero((n > 0) & (n <= most) & ~((one == two) & (one != shared)).any(axis=1))]
    return found, lambda: " ".join(template + [word() for _ in range(15)])


def test_pairs_whose_shared_buckets_are_all_crowded(spark, monkeypatch):
    from ledgerlight.llm import blocks

    monkeypatch.setattr(blocks, "BLOCK", 2)
    monkeypatch.setattr(neardup, "BLOCK", 2)
    pairs, page = pairs_with_few_keys()
    assert len(pairs) >= 3
    rows = [(k * 1000 + i, p[k]) for i, p in enumerate(pairs) for k in (0, 1)] + [(2000 + i, page()) for i in range(500)]
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i - 1000 if 1000 <= i < 2000 else i for i, _ in rows}


@pytest.mark.parametrize("common", [-1, 3])
def test_crowded_buckets_lose_nothing(spark, common, monkeypatch):
    """Variants of a few texts, all buckets crowded; common -1: many or all shingles are common."""
    from ledgerlight.llm import blocks

    monkeypatch.setattr(blocks, "BLOCK", 1)
    monkeypatch.setattr(neardup, "BLOCK", 1)
    monkeypatch.setattr(neardup, "COMMON", common)
    ways = []
    real = neardup._prefixes
    monkeypatch.setattr(neardup, "_prefixes", lambda sets, percent: ways.append(real(sets, percent).collect()) or real(sets, percent))
    r = random.Random(21)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    rows = []
    for base in range(2):
        text = [word() for _ in range(70)]
        for i in range(60):
            some = list(text)
            for _ in range(r.randint(1, 5)):
                some[r.randrange(70)] = word()
            rows.append((base * 100 + i, " ".join(some)))
    _, want = brute(rows, 5, 80)
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == want
    assert ways and any(x.full for x in ways[0]) and (common < 0 or any(x["keys"] for x in ways[0]))


def test_similar_sets_meet_by_prefix_or_in_full(spark, monkeypatch):
    """Any two similar sets share a key, or the smaller one is marked, whatever shingles are common."""
    monkeypatch.setattr(neardup, "COMMON", 6)
    rows = [x for x in corpus() if x[1] and x[1].strip()]
    sets = neardup._sets(spark.createDataFrame(rows, "id long, text string"), 3)
    got = {r.id: (r.full, set(r["keys"])) for r in neardup._prefixes(sets, 80).collect()}
    held = {r.id: set(r.members) for r in sets.collect()}
    similar = [(a, b) for a in held for b in held if a < b and 100 * len(held[a] & held[b]) >= 80 * len(held[a] | held[b])]
    assert similar and {got[a][0] for a, _ in similar} == {True, False}
    for a, b in similar:
        least = min(len(held[a]), len(held[b]))
        assert got[a][1] & got[b][1] or any(got[x][0] for x in (a, b) if len(held[x]) == least)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "A b c d e f"), (3, "other words are in this one")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 1, True), (1, 1, True), (None, None, False), (2, 1, False), (3, 3, True)], key=str)
    left = neardup.drop_near_duplicates(docs).collect()
    assert sorted((str(r.doc_id) for r in left)) == ["1", "3"]
    rows = [(1, "one text of several words here", "x"), (1, "another text that has nothing to do with it", "y"), (1, "another text that has nothing to do with it", "z"), (None, "words of a row without id", "x"), (None, "words of a row without id", "x"), (None, "One text of several WORDS here", "w"), (None, None, "n"), (4, "", "e")]
    some = spark.createDataFrame(rows, "doc_id long, text string, n__row string")
    kept = [tuple(r) for r in neardup.drop_near_duplicates(some).collect()]
    assert len(kept) == 5 and {t and t.lower() for _, t, _ in kept} == {"one text of several words here", "another text that has nothing to do with it", "words of a row without id", None, ""}
    assert sorted(kept, key=str) == sorted((tuple(r) for r in neardup.drop_near_duplicates(some.repartition(3)).collect()), key=str)
    assert neardup.near_duplicates(docs.limit(0)).collect() == [] and neardup.drop_near_duplicates(docs.limit(0)).collect() == []


def test_odd_sketches_estimate_similarity():
    r = np.random.default_rng(5)
    for share in (0.95, 0.85, 0.7):
        errors = []
        for _ in range(30):
            common = r.integers(0, 1 << 63, int(1000 * share), dtype=np.uint64)
            rest = int(1000 * (1 - share) / 2)
            sets = [np.unique(np.concatenate([common, r.integers(0, 1 << 63, rest, dtype=np.uint64)])) for _ in range(2)]
            a, b = neardup.odd_sketches(neardup.minhashes(sets)).view(np.uint64)
            errors.append(neardup.similarity_from(np.bitwise_count(a ^ b).sum()) - share)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06


# vectors


def vectors():
    r = np.random.default_rng(1)
    rows = [(i, int(i % 3), r.standard_normal(16).astype(np.float32).tolist()) for i in range(150)]
    centre = r.standard_normal(16)
    rows += [(1000 + i, 1, (centre + 0.12 * r.standard_normal(16)).astype(np.float32).tolist()) for i in range(120)]
    rows += [(2000 + i, 2, rows[0][2]) for i in range(5)] + [(2100 + i, 0, [2 * x for x in rows[0][2]]) for i in range(3)]
    rows += [(3000, 1, None), (3001, 1, [0.0] * 16), (3002, 1, [None] + [1.0] * 15), (3003, 1, [float("nan")] * 16), (3004, 1, [float("inf")] + [1.0] * 15), (3005, None, rows[0][2]), (3006, None, rows[0][2]), (3007, 1, []), (3008, 1, [1.0, 0.0]), (3009, 1, [1.0, 0.0])]
    return rows


def brute_vectors(rows):
    good = [(i, label, np.array(v, float)) for i, label, v in rows if label is not None and v and None not in v]
    good = [(i, label, v / np.linalg.norm(v)) for i, label, v in good if np.isfinite(v).all() and v.any()]
    links = [(a, b) for k, (a, la, va) in enumerate(good) for b, lb, vb in good[k + 1 :] if la == lb and len(va) == len(vb) and va @ vb >= 0.98]
    n = collections.Counter(x for p in links for x in p)
    return n, components_of([i for i, _, _ in rows], links)


@pytest.mark.parametrize("window", [8, 256])
def test_vector_links(spark, window):
    rows = vectors()
    n, want = brute_vectors(rows)
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, embedding array<float>, id string").repartition(3)
    got = veclinks.vector_links(df, window=window).collect()
    assert {r.vec_id: r.n_links for r in got} == {i: n[i] for i, _, _ in rows}
    assert {r.vec_id: r.component_id for r in got} == want and all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_planted_pairs_in_a_large_label(spark, tmp_path):
    """100,000 vectors of one label, 2,000 pairs planted between cosine 0.98 and 1: all are found, and nothing else."""
    r = np.random.default_rng(11)
    n, planted, wide = 100_000, 2_000, 32
    x = r.standard_normal((n, wide))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    one, two = r.permutation(n)[: 2 * planted].reshape(2, -1)
    aside = r.standard_normal((planted, wide))
    aside -= (aside * x[one]).sum(axis=1, keepdims=True) * x[one]
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    cosine = np.where(np.arange(planted) < planted // 2, 0.9802, r.uniform(0.9802, 1, planted))[:, None]
    x[two] = cosine * x[one] + np.sqrt(1 - cosine**2) * aside
    held = pa.table({"vec_id": np.arange(n), "label": np.zeros(n, np.int32), "embedding": pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), wide).cast(pa.list_(pa.float64()))})
    pq.write_table(held, tmp_path / "v.parquet", row_group_size=10_000)
    got = veclinks.vector_links(spark.read.parquet(str(tmp_path / "v.parquet"))).where("n_links > 0 OR NOT kept").collect()
    assert {(v.vec_id, v.n_links, v.component_id) for v in got} == {(int(v), 1, int(min(p))) for p in zip(one, two) for v in p}


def test_odd_vectors(spark):
    df = spark.createDataFrame([(None, 1, [1.0, 0.0]), (4, 1, [1.0, 0.0]), (4, 1, [1.0, 0.0])], "vec_id long, label int, embedding array<double>")
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in veclinks.vector_links(df).collect()) == [("4", 1, "4", True), ("4", 1, "4", True), ("None", 0, "None", False)]
    assert veclinks.vector_links(df.limit(0)).collect() == []
    assert veclinks.passes_for(10**9, 0.98) > veclinks.passes_for(10**4, 0.98) >= 5
