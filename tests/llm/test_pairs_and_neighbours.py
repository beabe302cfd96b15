import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import components, jaccard_join, neighbours

SCHEMA = "doc_id long, text string, _id string, row string, tokens string, node string, _gone string"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", "x", "x", "x", "x") for i, t in rows], SCHEMA)


def _shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _expected(rows):
    sets = [_shingles(t) for _, t in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and both >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    classes = {}
    for at, (i, _) in enumerate(rows):
        classes.setdefault(find(at), []).append(i)
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in classes.items()}
    return sorted(((i, least[find(at)], len(classes[find(at)]), links[at]) for at, (i, _) in enumerate(rows)), key=repr)


def _rows():
    random.seed(8)
    word = lambda: "".join(random.choices("abcdefgh", k=4))
    passage = [word() for _ in range(60)]
    rows = [(i, " ".join(word() for _ in range(80))) for i in range(40)]
    rows += [(100 + i, " ".join(passage + [word() for _ in range(90)])) for i in range(30)]  # a shared passage is no link
    base = [word() for _ in range(120)]
    for i in range(60):  # near copies, some linked only through others
        copy = list(base)
        for _ in range(random.randint(0, 5)):
            copy[random.randrange(len(copy))] = word()
        rows.append((200 + i, " ".join(copy)))
    rows += [(300, None), (301, ""), (302, " \n"), (303, "one two"), (304, "One  TWO"), (305, "one two three")]
    rows += [(306, "same words here for a copy"), (306, "same words here for a copy"), (None, "same words here for a copy")]
    rows += [(307, "long " * 30_000), (308, "long " * 20_000)]
    return rows


@pytest.mark.parametrize("small, blocks", [(256, 1024), (4, 16)])
def test_join_equals_brute_force(spark, monkeypatch, small, blocks):
    """The second case splits to the deepest level and compares the dense bucket in pairs of blocks."""
    monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", blocks)
    monkeypatch.setattr(jaccard_join, "VERIFY_ROWS", blocks)
    rows = _rows()
    found = jaccard_join.similar_classes(_docs(spark, rows), small=small).collect()
    assert sorted(((r.doc_id, r.class_id, r.class_size, r.n_links) for r in found), key=repr) == _expected(rows)
    assert sum(r.kept for r in found) == len({(r.class_id if r.class_size > 1 else r.doc_id) for r in found})


def test_one_row_of_each_class(spark):
    rows = [r for r in _rows() if r[0] is not None] + [(304, "its own text"), (301, "")]
    left = jaccard_join.one_row_of_each(_docs(spark, rows))
    assert left.columns == _docs(spark, []).columns
    kept = sorted(i for i, c, _, _ in _expected(rows) if i == c)
    repeated = [306]  # twice in the rows, in one class
    for i in repeated:
        kept.remove(i)
    assert sorted(r.doc_id for r in left.collect()) == kept


def test_join_of_nothing(spark):
    assert jaccard_join.similar_classes(_docs(spark, [])).count() == 0
    assert jaccard_join.similar_classes(_docs(spark, [(1, None)])).first().class_id == 1


def test_runs_follow_from_recall():
    assert jaccard_join.survival(1) == pytest.approx(0.632, abs=1e-3)
    assert (1 - jaccard_join.survival(4)) ** jaccard_join.runs_for(0.99, 4) <= 0.01


def test_runs_make_up_for_a_seed_that_draws_little(monkeypatch):
    """The recall is that of the coordinates really drawn, whatever the seed."""
    counts = set()
    for seed in range(60):
        monkeypatch.setattr(jaccard_join, "SEED", seed)
        runs = jaccard_join.runs_for(0.99, 4)
        assert jaccard_join.recall_of(runs, 4) >= 0.99
        counts.add(runs)
    assert min(counts) == 13 and max(counts) > 13


def test_pairs_meet_as_often_as_the_draws_say():
    """Sets of tokens that agree on each coordinate with the threshold's chance, through all levels."""
    chance, depth, pairs = np.random.default_rng(3), 3, 2000
    left = chance.integers(0, 1 << 32, (pairs, jaccard_join.HASHES), dtype=np.uint32)
    right = np.where(chance.random(left.shape) < 0.8, left, left + np.uint32(1))
    met = np.zeros(pairs, dtype=bool)
    for run in range(5):
        paths = np.full(pairs, jaccard_join.root_path(run)), np.full(pairs, jaccard_join.root_path(run))
        rows = np.arange(pairs), np.arange(pairs)
        for _ in range(depth):
            split = [jaccard_join.children(p, t[r], 0.8) for p, t, r in zip(paths, (left, right), rows)]
            rows = [r[at] for r, (at, _) in zip(rows, split)]
            paths = [p for _, p in split]
        held = set(zip(rows[0].tolist(), paths[0].tolist()))
        met[[r for r, p in zip(rows[1].tolist(), paths[1].tolist()) if (r, p) in held]] = True
    assert met.mean() == pytest.approx(jaccard_join.recall_of(5, depth), abs=0.05)


def test_a_repeated_row_sends_its_set_once():
    text = "one two three four five six"
    key = jaccard_join.xxhash.xxh3_128_intdigest(jaccard_join.shingles(text, jaccard_join.WordHashes()).tobytes())
    high, low = (key >> 64) - (1 << 63), (key & ((1 << 64) - 1)) - (1 << 63)
    names = ["node", "component", "copies", "high", "low", "text"]
    batch = jaccard_join.pa.RecordBatch.from_pylist(
        [dict(zip(names, (n, 1, 9, high, low, t))) for n, t in [(7, "some other text here too")] + [(7, text)] * 50 + [(8, text)]]
    )
    sent = [r for out in jaccard_join._with_sets(iter([batch, batch])) for r in out.to_pylist()]
    assert [(r["node"], r["copies"]) for r in sent] == [(7, 9), (8, 9)]
    assert len(sent[0]["set"]) == 8 * 2


def test_components(spark):
    random.seed(6)
    edges = [(random.randrange(200), random.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)] + [(7, 7)]
    root = {n: n for e in edges for n in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    found = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {n: find(n) for n in root if find(n) != n}


def _cosines(rows, query, vector):
    scores = {}
    for i, v in rows:
        if i is None or i == query or v is None or len(v) != len(vector) or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        a, b = np.array(v, dtype=float), np.array(vector, dtype=float)
        scores[i] = max(scores.get(i, -2), float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))))
    return sorted(scores.items(), key=lambda s: (-s[1], s[0]))


def test_neighbours_recall_and_scores(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=24).round(3).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[0][1]) for i in range(40)]  # ties: the smaller ids are the nearest
    table = spark.createDataFrame([(i, v, "x", "x") for i, v in rows], "vec_id long, embedding array<float>, asked string, values string")
    kept = [(r.vec_id, r.embedding) for r in table.collect()]
    found = {}
    for r in neighbours.nearest(table, F.col("vec_id") % 50 == 0, block_rows=64).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = total = 0
    vectors = dict(kept)
    for query in (i for i, _ in kept if i % 50 == 0):
        exact = _cosines(kept, query, vectors[query])
        got = sorted(found[query])
        assert [g[0] for g in got] == [1, 2, 3, 4, 5]
        assert all(abs(dict(exact)[v] - s) < 1e-12 for _, v, s in got)
        hits += len({v for _, v, _ in got} & {v for v, _ in exact[:5]})
        total += 5
    assert hits / total >= 0.9
    assert [v for _, v, _ in sorted(found[0])] == [2000, 2001, 2002, 2003, 2004]


def test_neighbours_of_odd_vectors(spark):
    rows = [
        (0, [1.0, 0.0]), (50, None), (100, [0.0, 0.0]), (150, [1.0, None]), (200, [float("nan"), 1.0]), (250, [float("inf"), 1.0]),
        (300, []), (350, [3.0]), (1, [1.0, 1.0]), (2, [-1.0, 0.0]), (2, [-1.0, 0.0]), (None, [1.0, 0.0]), (400, [2.0, 0.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted((r.query_id, r.rank, r.vec_id) for r in neighbours.nearest(table, F.col("vec_id") % 50 == 0).collect())
    assert found == [(0, 1, 400), (0, 2, 1), (0, 3, 2), (400, 1, 0), (400, 2, 1), (400, 3, 2)]
    assert neighbours.nearest(table.limit(0), F.lit(True)).count() == 0


def test_a_repeated_neighbour_takes_one_place(spark):
    rows = [(0, [1.0, 0.0])] + [(1, [1.0, 0.01])] * 6 + [(i, [1.0, i / 100]) for i in range(2, 11)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted((r.rank, r.vec_id) for r in neighbours.nearest(table, F.col("vec_id") == 0).collect())
    assert found == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)]


def test_hadamard():
    rows = np.eye(8)
    turned = neighbours.hadamard(rows)
    assert np.allclose(turned @ turned.T, np.eye(8)) and np.allclose(np.abs(turned), 8**-0.5)
