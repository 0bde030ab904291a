"""The Jaccard join against all pairs."""

import random
import re

import numpy as np
import pytest

from veritally import workspace
from veritally.llm import jaccard
from veritally.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def by_all_pairs(docs, width, threshold):
    """(doc_id, n_shingles, component_id) by looking at all pairs."""
    sets = [(d, shingles(t, width)) for d, t in docs]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= threshold * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(s), least.get(root(i))) for i, (d, s) in enumerate(sets)), key=str)


def found(spark, docs, **options):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return sorted(map(tuple, jaccard.jaccard_components(df, **options).drop("component").collect()), key=str)


def corpus(seed, n=150):
    """Texts with copies, near copies at all distances, shared passages, and a chain of edits."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=60)
    texts = []
    for _ in range(n):
        kind = rng.random()
        if texts and kind < 0.6:
            words = rng.choice(texts).split()
            for _ in range(rng.randint(0, 1 + len(words) // 20)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = rng.choices(vocabulary, k=rng.choice([1, 2, 3, 5, 8, 20, 60, 130, 300]))
            if kind > 0.8:
                words += passage
        texts.append(" ".join(words))
    return list(enumerate(texts))


@pytest.mark.parametrize("width, threshold", [(4, 85), (5, 80), (1, 50), (2, 60), (2, 40), (1, 30)])
def test_same_as_all_pairs(spark, width, threshold):
    docs = corpus(width)
    assert found(spark, docs, width=width, threshold=threshold) == by_all_pairs(docs, width, threshold)


def test_sets_of_unlike_sizes_at_low_thresholds(spark):
    """Sets link although one has several times the parts of the other; each half or third is a share of its own."""
    words = [f"x{i}" for i in range(4096)]
    docs = [(0, " ".join(words)), (1, " ".join(words[:2400])), (2, " ".join(words[:1400])), (3, " ".join(words[100:900]))]
    for threshold in (30, 34, 40, 58, 60):
        assert found(spark, docs, width=1, threshold=threshold) == by_all_pairs(docs, 1, threshold)
    for n in (1, 63, 64, 600, 1024, 5000):
        counts = jaccard.part_counts(n, 30)
        assert all(set(jaccard.part_counts(m, 30)) & set(counts) for m in range(-(-30 * n // 100), n + 1))
    with pytest.raises(ValueError):
        found(spark, docs, threshold=0)


def test_large_groups_in_chunks(spark):
    """Groups of more than one chunk and buckets that are connected without a look lose no link."""
    docs = corpus(7, 120)
    assert found(spark, docs, width=3, threshold=80, chunk_docs=3, large_run=2) == by_all_pairs(docs, 3, 80)


def test_large_group_without_links(spark, monkeypatch):
    """Thousands of classes that share 75 % of their words and hardly link: no tree holds more than two pieces, nothing is
    compared twice in the last round, and all links are found."""
    rng = random.Random(3)
    base, docs = [f"b{i}" for i in range(60)], []
    for i in range(3_000):
        own = [f"o{i}_{j}" for j in range(20)]
        if i % 100 == 99:  # links with a document before it
            own = docs[rng.randrange(i // 100 * 100, i)][1].split()[60:78] + own[:2]
        docs.append((i, " ".join(base + own)))
    trees, group_edges = [], jaccard._group_edges

    def watched(rows, threshold):
        sizes = rows.groupBy("tree").agg({"class_id": "count"}).collect()
        trees.append(sorted(r[1] for r in sizes))
        return group_edges(rows, threshold)

    monkeypatch.setattr(jaccard, "_group_edges", watched)
    got = found(spark, docs, width=1, threshold=85, chunk_docs=256, large_run=64)
    assert max(trees[1]) < 2.5 * 256, trees[1]
    owner = {w: i for i, t in reversed(docs) for w in t.split()[60:]}
    expected = [(i, 80, min([i, *(owner[w] for w in t.split()[60:])])) for i, t in docs]
    assert got == sorted(expected, key=str) and sum(c != i for i, _, c in expected) == 30


def test_sides_of_a_tree():
    """With sides, exactly the pairs of different sides are compared, each once."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 62, 100, dtype=np.uint64)
    sets = [np.unique(np.concatenate((base, rng.integers(0, 1 << 62, 10, dtype=np.uint64)))) for _ in range(150)]
    sides = rng.integers(1, 3, len(sets))
    seen = []
    tree = jaccard.SignatureTree(np.array([len(s) for s in sets]), jaccard.bitmaps(sets, 4), 50, sides)
    tree.connect(np.arange(len(sets)), lambda i, j: seen.append((min(i, j), max(i, j))))
    assert sorted(seen) == [(i, j) for i in range(150) for j in range(i + 1, 150) if sides[i] != sides[j]]


def test_few_files_for_few_rows(spark, tmp_path, monkeypatch):
    """Stored tables of few rows have few files, whatever the number of shuffle partitions; every file costs an executor two
    more processes on a local disk. Results stay the same."""
    monkeypatch.setattr(workspace, "shared_dir", lambda _: str(tmp_path))
    few = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in few}
    docs = corpus(11, 120)
    for k, v in few.items():
        spark.conf.set(k, v)
    try:
        assert found(spark, docs, width=3, threshold=80, chunk_docs=3, large_run=2) == by_all_pairs(docs, 3, 80)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = {p.name: len(list(p.glob("part-*"))) for p in tmp_path.iterdir()}
    assert {n.split("-")[0] for n in files} >= {"edges", "large", "small", "members", "links", "labelled"}
    assert all(n == 1 for name, n in files.items() if name.split("-")[0] not in ("classes", "sets")), files


@pytest.mark.parametrize("threshold", [1, 30, 50, 80, 85, 100])
def test_bound_of_routed_rows(threshold):
    rng = np.random.default_rng(threshold)
    level = np.zeros(jaccard.CELLS, dtype=np.uint8)
    for n in (1, 2, 63, 64, 65, 127, 128, 300, 5_000):
        sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for _ in range(3)]
        routed = sum(len(jaccard.part_rows(s, threshold, level)[0]) for s in sets)
        assert routed <= jaccard._routed_most(3, sum(map(len, sets)), threshold)


def test_odd_rows(spark):
    docs = [
        (3, None), (4, ""), (5, " \t\n"), (6, "one"), (2, "ONE"), (7, "one two"), (7, "one two"), (7, "other words here"),
        (None, "one two"), (9, "É one two three four"), (8, "é one two three four"), (11, "a b c d e f"), (10, "a\nb\tc  d e f"),
    ]
    assert found(spark, docs, width=4, threshold=85) == by_all_pairs(docs, 4, 85)
    assert found(spark, docs[:3], width=4, threshold=85) == by_all_pairs(docs[:3], 4, 85)
    assert found(spark, []) == []


def test_long_text(spark):
    words = [f"v{i * 7919 % 200_003}" for i in range(120_000)]
    docs = [(1, " ".join(words)), (2, " ".join(words[:-9_000])), (3, " ".join(words[:60_000]))]
    assert found(spark, docs) == [(1, 119_996, 1), (2, 110_996, 1), (3, 59_996, 3)]


def test_whole_table(spark, sf_dir):
    from veritally.llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op4_jaccard_join"](spark, sf_dir).collect()), key=str)
    assert got == by_all_pairs(docs, 4, 85)


def test_tree_leaves_no_pair_out():
    rng = np.random.default_rng(1)
    base = [np.unique(rng.integers(0, 1 << 62, rng.integers(1, 200), dtype=np.uint64)) for _ in range(60)]
    sets = base + [np.unique(np.concatenate((b[rng.random(len(b)) > 0.04], rng.integers(0, 1 << 62, 2, dtype=np.uint64)))) for b in base]
    sizes = np.array([len(s) for s in sets])
    tree = jaccard.SignatureTree(sizes, jaccard.bitmaps(sets, 4), 80)
    label = tree.connect(np.arange(len(sets)), lambda i, j: jaccard.overlap_at_least(sets[i], sets[j], 80))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            common = len(np.intersect1d(a, b))
            assert jaccard.overlap_at_least(a, b, 80) == (100 * common >= 80 * (len(a) + len(b) - common))
            if jaccard.overlap_at_least(a, b, 80):
                assert label[i] == label[j]


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, -5), (-5, 7_000_000_000), (9, 9)] + [(200, i) for i in range(201, 260)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(61)} | dict.fromkeys((100, -5, 7_000_000_000), -5) | dict.fromkeys(range(200, 260), 200)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
