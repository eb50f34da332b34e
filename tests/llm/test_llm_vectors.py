"""Operators over vectors against brute force: hard negatives, near-duplicates, centroids."""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from txnrisk.llm import centroids, euclid, negatives, topk, vectors

SCHEMA = "vec_id long, label int, embedding array<float>, rank string, score string, kept string, cluster string, key string"


@pytest.fixture(scope="module")
def frame(spark):
    """Rows of (vec_id, label, vector), with columns that clash with outputs."""

    def frame(rows):
        return spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], SCHEMA)

    return frame


def drawn(seed: int, n: int, size: int = 8, scale: float = 1.0) -> list[list[float]]:
    draw = np.random.default_rng(seed)
    return (scale * draw.standard_normal((n, size))).astype(np.float32).tolist()


def odd_rows(size: int = 8) -> list[tuple]:
    """Nulls, non-finite values, zeros, other lengths, huge and tiny values, repeated rows and shared ids."""
    good = [0.5] * size
    return [
        (None, 1, good), (900, None, good), (901, 1, None), (902, 1, []), (903, 1, [0.0] * size),
        (904, 1, [None, *good[1:]]), (905, 1, [math.nan, *good[1:]]), (906, 1, [math.inf, *good[1:]]), (907, 1, good[1:]),
        (908, 1, good), (908, 1, good), (909, 1, good), (909, 2, good), (909, 1, [-0.5] * size),
        (910, 1, [1e3] + [0.0] * (size - 1)), (911, 1, [1e-30] * size), (300, 1, good), (300, 1, good), (400, 2, good[1:]),
    ]


def whole(vector, scale):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(scale * x) for x in vector]


# Hard negatives


def mined(rows, positives, many, percent, scale):
    kept = [(k, lab, tuple(v)) for k, lab, x in rows if k is not None and lab is not None and (v := whole(x, scale))]
    out = Counter()
    for key, label, vector in {r for r in kept if r[0] % 100 == 0}:
        scored = [(k, lab, sum(map(int.__mul__, vector, v))) for k, lab, v in kept if len(v) == len(vector)]
        first = sorted(((-s, k) for k, lab, s in scored if lab == label and k != key))[:positives]
        for less, positive in first:
            band = sorted((-s, k) for k, lab, s in scored if lab != label and percent * -less <= 100 * s <= 100 * -less)
            for rank, (n, k) in enumerate(band[:many], 1):
                out[key, positive, rank, k, -less, -n] += 1
    return out


def mining_rows(seed):
    """Vectors around a few directions, so that windows are full, and some that repeat."""
    centres, noise = np.array(drawn(seed, 4)), np.array(drawn(seed + 1, 160, scale=0.4))
    rows = [(7 * i % 1000, i % 3, (centres[i % 4] + noise[i]).tolist()) for i in range(160)]
    rows += [(100 * i, i % 3, rows[i][2]) for i in range(1, 4)]
    rows += [(500 + i, i % 2, rows[0][2]) for i in range(30)]
    return [(k, lab, np.float32(v).tolist()) for k, lab, v in rows]


@pytest.mark.parametrize(("seed", "block", "scale", "many"), [(1, 4, 256.0, 5), (2, 1000, 3.0, 4), (3, 3, 1e6, 7)])
def test_hard_negatives_equal_brute_force(frame, seed, block, scale, many):
    rows = mining_rows(seed) + odd_rows()
    df = frame(rows)
    found = negatives.mine(df, df.where("vec_id % 100 = 0"), negatives=many, scale=scale, block=block)
    want = mined(rows, 5, many, 80, scale)
    assert Counter(tuple(r) for r in found.collect()) == want and len(want) > 100


def test_hard_negatives_with_large_numbers(frame):
    rows = mining_rows(4)
    df = frame(rows)
    found = negatives.mine(df, df.where("vec_id % 100 = 0"), scale=3e6)
    assert Counter(tuple(r) for r in found.collect()) == mined(rows, 5, 5, 80, 3e6)
    with pytest.raises(Exception, match="55 bits"):
        negatives.mine(df, df.where("vec_id % 100 = 0"), scale=1e9).collect()


def test_hard_negatives_of_empty_tables(frame):
    df = frame([(100, 1, [1.0, 2.0]), (1, None, None)])
    assert negatives.mine(df, df.limit(0)).collect() == []
    assert negatives.mine(df.limit(0), df).collect() == []
    assert negatives.mine(df, df).columns == "anchor_id positive_id rank negative_id positive_score negative_score".split()


def test_index_omits_dimensions_and_loses_no_pair():
    draw = np.random.default_rng(5)
    for shape in (1.0, 0.3):
        rows = np.rint(200 * draw.standard_normal((500, 64)) * shape ** np.arange(64)).astype(np.int64)
        asked = rows[:40]
        scores = asked @ rows.T
        least = np.quantile(scores, [0.999, 0.9, 0.1], axis=1).T[np.arange(40), np.arange(40) % 3].astype(np.int64)
        found = {(int(a), int(r)): int(s) for part in negatives.above(asked, rows, least) for a, r, s in zip(*part, strict=True)}
        want = {(int(a), int(r)): int(scores[a, r]) for a, r in np.argwhere(scores >= least[:, None])}
        assert found == want


def test_a_task_holds_no_more_than_a_window(monkeypatch):
    monkeypatch.setattr(vectors, "BUFFER", 10)
    best = vectors.Best(2, 3)
    for key in range(100):
        best.add(np.array([0, 1]), np.array([key, key]), np.array([key % 7, 1]))
        assert len(best.kept[0]) <= 6 and best.waiting <= 12
    best.settle()
    assert list(zip(*(c.tolist() for c in best.kept), strict=True)) == [(0, 6, 6), (0, 13, 6), (0, 20, 6), (1, 0, 1), (1, 1, 1), (1, 2, 1)]
    assert best.floor.tolist() == [6, 1]


# Near-duplicates


def linked(rows, cosine):
    """(key, n_links, component_id, kept) of each row."""
    def direction(label, x):
        if label is None or not x or any(c is None or not math.isfinite(c) for c in x) or not any(x):
            return None
        v = np.array(x, np.float64) / np.abs(x).max()
        return tuple((v / np.sqrt(v @ v)).tolist())

    own = [(k, lab, direction(lab, x)) for k, lab, x in rows]
    known = sorted({o for o in own if o[2]}, key=str)
    graph = defaultdict(set)
    for a in known:
        for b in known:
            if a != b and a[1] == b[1] and len(a[2]) == len(b[2]) and float(np.dot(a[2], b[2])) >= cosine:
                graph[a].add(b)
    out = Counter()
    for row in own:
        if row[2] is None:
            out[row[0], 0, row[0], True] += 1
            continue
        reached, todo = {row}, [row]
        while todo:
            for b in graph[todo.pop()] - reached:
                reached.add(b)
                todo.append(b)
        least = min((r[0] for r in reached), key=lambda k: (k is None, k or 0))
        # A null key sorts after all others.
        out[row[0], len(graph[row]), least, row[0] == least] += 1
    return out


def near_rows(seed, groups=3, members=60, spread=0.1):
    """Groups of noisy copies, of several radii, and lone vectors."""
    rows, key = [], 0
    for g, centre in enumerate(drawn(seed, groups)):
        noise = np.array(drawn(seed + 10 + g, members, scale=1.0))
        for i in range(members):
            far = spread * (0.2 if i % 3 else 2.0)
            rows.append((key := key + 1, g % 2, np.float32(np.array(centre) + far * noise[i]).tolist()))
    rows += [(1000 + i, i % 2, v) for i, v in enumerate(drawn(seed + 50, 40))]
    return rows + [(2000 + i, r[1], [2 * x for x in r[2]]) for i, r in enumerate(rows[:30])] + rows[:5]


@pytest.mark.parametrize(("dense", "chunk", "spread"), [(8, 7, 0.1), (8, 1000, 0.2), (10_000, 13, 0.2), (20, 16, 0.35), (4, 5, 0.02)])
def test_near_duplicates_equal_brute_force(frame, dense, chunk, spread):
    """With many wide keys every link is found, so the counts of balls and chunks must be exact."""
    rows = near_rows(6, spread=spread) + odd_rows()
    found = euclid.components(frame(rows), width=4.0, hashes=4, tables=60, dense=dense, chunk=chunk)
    assert Counter(tuple(r) for r in found.collect()) == linked(rows, 0.93)


def test_default_keys_find_nearly_all_links_and_no_other(frame):
    """Pairs just above the threshold, which are the hardest to find, in 64 dimensions; and pairs just below it."""
    draw, rows = np.random.default_rng(8), []
    for i, cosine in enumerate(np.r_[np.linspace(0.9305, 0.96, 300), np.linspace(0.90, 0.9295, 100)]):
        x, y = np.linalg.qr(draw.standard_normal((64, 2)))[0].T
        rows += [(2 * i, 1, x.tolist()), (2 * i + 1, 1, (cosine * x + np.sqrt(1 - cosine**2) * y).tolist())]
    found = {r["vec_id"]: r for r in euclid.components(frame(rows)).collect()}
    hits = sum(found[2 * i]["n_links"] == 1 for i in range(300))
    assert hits >= 0.97 * 300
    assert all(found[2 * i]["n_links"] == 0 for i in range(300, 400))


def test_near_duplicates_of_an_empty_table(frame):
    found = euclid.components(frame([]))
    assert found.collect() == [] and found.columns == ["vec_id", "n_links", "component_id", "kept"]


# Centroids


def clustered(rows, size, k, rounds, scale, seed):
    kept = [(key, v) for key, _, x in rows if (v := whole(x, scale)) is not None and len(v) == size]
    drawn_first = sorted((hashlib.sha256(f"{seed}:{key}".encode()).hexdigest(), np.array(v, np.int64).tobytes(), v) for key, v in kept if key is not None)
    centres = [list(v) for _, _, v in drawn_first[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centres)) for _, v in kept]

    for _ in range(rounds):
        places = assign()
        for i in range(len(centres)):
            own = [v for (_, v), (_, c) in zip(kept, places, strict=True) if c == i]
            if own:
                centres[i] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    places = assign()
    inertia = Counter()
    for d, c in places:
        inertia[c] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter(
        (key, c, d, inertia[c], sum(inertia.values()), digest[c]) for (key, _), (d, c) in zip(kept, places, strict=True)
    )


@pytest.mark.parametrize(("k", "rounds", "scale"), [(8, 10, 1024.0), (3, 2, 1.0), (500, 1, 7.0), (1, 0, 1024.0)])
def test_centroids_equal_brute_force(frame, k, rounds, scale):
    rows = mining_rows(9) + odd_rows()
    found = centroids.cluster(frame(rows), size=8, k=k, rounds=rounds, scale=scale)
    assert Counter(tuple(r) for r in found.collect()) == clustered(rows, 8, k, rounds, scale, "3")


def test_centroids_of_empty_tables(frame):
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    for rows in ([], [(1, 1, None), (2, 1, [1.0])]):
        found = centroids.cluster(frame(rows))
        assert found.collect() == [] and found.columns == names


def test_lookup_tables_give_exact_distances():
    draw = np.random.default_rng(3)
    matrix, centres = draw.integers(-(10**6), 10**6, (50, 5)), draw.integers(-(10**6), 10**6, (4, 5))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, c, strict=True)) for c in centres] for v in matrix]
    assert centroids.distances(matrix, centres).tolist() == want
    with pytest.raises(ValueError, match="64 bits"):
        centroids.distances(matrix * 10**6, centres)


def test_components_beyond_64_bits_are_refused():
    pack = vectors.quantized_batches(1024.0)
    with pytest.raises(ValueError, match="64 bits"):
        list(pack(iter([np.array([[1e30, 1.0]], dtype=object)])))


# Search


def test_search_holds_k_rows_a_task_on_ties(spark):
    """A task gives out k rows of each query, however many rows tie and however many batches it gets."""
    blocks, exact = topk.query_blocks([{"key": q, "vector": np.array([1, q]).tobytes()} for q in (1, 2)], {2: 10})
    for block in blocks.values():
        block.low[:] = -100
    shared = type("Shared", (), {"value": (blocks, exact)})
    batch = pd.DataFrame({"key": range(100, 1100), "vector": [np.array([3, 0]).tobytes()] * 1000})
    out = pd.concat(topk.final_batches(shared, 10)(iter([batch, batch.assign(key=batch["key"] - 90)])))
    assert sorted(zip(out["query_id"], out["key"], strict=True)) == [(q, k) for q in (1, 2) for k in range(10, 20)]


def test_search_refuses_what_does_not_fit(frame):
    df = frame([(1, 1, [6.0, 1.0]), (2, 1, [1e30, 1.0])])
    with pytest.raises(Exception, match="64 bits"):
        topk.search(df, df.where("vec_id = 1"))
