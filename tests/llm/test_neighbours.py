"""Nearest neighbours: exact scores and order, recall, and vectors that take no part."""

import numpy as np

from perigee.llm import neighbours as N

SCHEMA = "vec_id long, embedding array<float>"


def exact(rows, every, k):
    seen = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            seen[i] = np.asarray(v, np.float32).astype(float)
    out = {}
    for q in (i for i in seen if i % every == 0):
        d = sorted((float(np.sqrt(((seen[q] - v) ** 2).sum())), i) for i, v in seen.items() if i != q)
        out[q] = d[:k]
    return out


def by_query(df):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


def test_recall_ties_and_odd_vectors(make, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=8) / 3).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[40][1]) for i in range(200)]  # equal vectors, queries among them
    rows += [(3000, None), (3001, [0.0] * 8), (3002, [1.0] * 3), (3003, [float("nan")] * 8), (3004, [1.0, None] * 4), (None, [1.0] * 8), (3005, [float("inf")] * 8), rows[7]]
    monkeypatch.setattr(N, "CHUNK", 64)
    got, want = by_query(N.nearest(make(rows, SCHEMA), 20, 10)), exact(rows, 20, 10)
    assert set(got) == set(want)
    hits = 0
    for q, best in got.items():
        assert best == sorted(best) and len(best) == 10
        hits += len({i for _, i in best} & {i for _, i in want[q]})
    assert hits >= 0.9 * 10 * len(want)
    assert [i for _, i in got[40]] == [2000 + i for i in range(10)] and [i for _, i in got[2000]] == [40, *range(2001, 2010)]


def test_fewer_candidates_than_asked_for(make):
    rows = [(0, [1.0] * 8), (1, [1.1] * 8), (2, [1.0] * 8)]
    got = by_query(N.nearest(make(rows, SCHEMA), 100, 10))
    assert [i for _, i in got[0]] == [2, 1] and got[0][0][0] == 0.0
    assert N.nearest(make([], SCHEMA)).collect() == []
    assert N.nearest(make([(0, [1.0] * 8)], SCHEMA)).collect() == []


def test_probes_come_in_order_and_differ():
    offsets = np.array([0.1, 0.6, 0.5])
    cost = lambda moves: sum((offsets[j] if s < 0 else 1 - offsets[j]) ** 2 for j, s in moves)
    order = N.probe_order(offsets, 27)
    costs = [cost(m) for m in order]
    assert len(order) == 27 == len({tuple(sorted(m)) for m in order}) and costs == sorted(costs) and order[0] == []


def test_every_query_of_mixed_lengths(make, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lengths = {0: 10.0, 1: 4.0, 2: 1.5, 3: 0.5, 4: 0.02}  # of a few of the queries, others stay
    for i in range(0, 1000, 20):
        x[i] *= lengths[i // 20 % 5]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    monkeypatch.setattr(N, "WHOLE", 40, raising=False)
    x = np.asarray(x, np.float32).astype(float)
    got = by_query(N.nearest(make(rows, SCHEMA), 20, 10))
    recall = {}
    for q in range(0, 3000, 20):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        recall[q] = len({i for _, i in got.get(q, [])} & set(np.argsort(d, kind="stable")[:10].tolist())) / 10
        assert len(got.get(q, [])) == 10
    assert min(recall.values()) >= 0.6 and np.mean([r for q, r in recall.items() if q < 1000]) >= 0.9


def test_a_query_far_in_direction_still_gets_k(make, monkeypatch):
    rng = np.random.default_rng(4)
    x = np.eye(8)[0] + rng.normal(size=(300, 8)) / 1000
    x[0] = -np.eye(8)[0]
    monkeypatch.setattr(N, "WHOLE", 40, raising=False)
    got = by_query(N.nearest(make([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA), 1000, 10))
    x = np.asarray(x, np.float32).astype(float)
    d = np.sqrt(((x - x[0]) ** 2).sum(axis=1))
    assert len(got[0]) == 10 and {i for _, i in got[0]} <= set(range(1, 300))
    assert [i for _, i in got[0]] == np.argsort(np.where(d > 0, d, np.inf), kind="stable")[:10].tolist()


def test_nothing_of_the_inputs_size_passes_the_driver(make, monkeypatch):
    """Stored rows repeat little on disk, so Spark took the visited buckets, 384 rows a query, for small and broadcast them."""
    plans, rows, real = {}, {}, N.stored

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        out = real(df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(N, "stored", kept)
    x = np.random.default_rng(5).normal(size=(1200, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = by_query(N.nearest(make([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA), 20, 10))
    assert len(got) == 60 and all(len(best) == 10 for best in got.values())
    assert not [name for name, plan in plans.items() if "Broadcast" in plan]
    assert max(rows.values()) <= 1200 and rows["lsh-visits-own"] == 60


def test_blocks_of_vectors_and_of_queries_change_nothing(make, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(1500, 8)))]
    rows += [(1500 + i, rows[7][1]) for i in range(60)]  # equal vectors meet in one block
    monkeypatch.setattr(N, "WHOLE", 100)
    whole = by_query(N.nearest(make(rows, SCHEMA), 10, 10))
    monkeypatch.setattr(N, "BLOCK", 8 * 20)
    assert by_query(N.nearest(make(rows, SCHEMA, 7), 10, 10)) == whole


def test_visited_buckets_are_those_of_the_probe_order():
    x = np.random.default_rng(7).normal(size=(5, 8))
    hashes = N.Hashes(8)
    cells, offsets = hashes.cells(x)
    visited = hashes.visited(x)
    assert np.array_equal(hashes.buckets(x), cells @ hashes.PLACES)
    for i in range(5):
        for t in range(N.TABLES):
            moved = [cells[i, t] + sum((s * np.eye(N.K, dtype=int)[j] for j, s in moves), np.zeros(N.K, int)) for moves in N.probe_order(offsets[i, t], N.PROBES)]
            assert {int(c @ hashes.PLACES) for c in moved} == set(visited[i, t].tolist())


def test_single_precision_leaves_out_none_of_the_nearest():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 8))
    shapes = {"plain": x, "far from the origin": 1 + x / 1e4, "almost equal": 1 + x / 1e9, "huge": x * 1e300, "tiny": x * 1e-200, "apart": np.where(np.arange(3000)[:, None] < 1500, 1 + x / 100, -1 + x / 100)}
    for name, y in shapes.items():
        for v in (y[:70:7], y[:64] * 3, -y[:3], y[:2] * 1e16 if name != "huge" else y[:1]):
            block = N.Block(y, np.arange(3000)[::-1].copy(), 11)
            whole = np.arange(len(v)) % 2 == 0
            found_by = block.candidates(v, whole)
            for q, (rows, far) in enumerate(block.nearest(v, whole)):
                of = np.flatnonzero(found_by >> np.uint64(q) & np.uint64(1))
                assert len(of) == 3000 or not whole[q]
                with np.errstate(over="ignore"):
                    d = np.sqrt(((y[of] - v[q]) ** 2).sum(axis=1))
                best = np.lexsort((block.gid[of], d))[:11]
                assert rows == of[best].tolist() and far == d[best].tolist(), name
    block = N.Block(np.eye(8)[:1] + x[:50] / 1e3, np.arange(50), 11)
    assert [rows for rows, _ in block.nearest(-np.eye(8)[[0, 0]], np.zeros(2, bool))] == [[], []]
