import numpy as np

from estatescope.llm import graph
from estatescope.llm.neighbours import fit_centroids, nearest


def clustered(n, d, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n // 12, d))[rng.integers(0, n // 12, n)] + 0.45 * rng.normal(size=(n, d))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def truth(x, k):
    s = x.astype(np.float64) @ x.T.astype(np.float64)
    np.fill_diagonal(s, -9)
    return np.lexsort((np.broadcast_to(np.arange(len(x)), s.shape), -s), axis=1)[:, :k]


def test_graph_recall():
    x = clustered(2500, 48)
    edges, medoid = graph.build(x, 20, 40, 1.2)
    assert (edges >= 0).sum(1).max() <= 20
    found, far = graph.beam_search(x, edges, x, np.full((len(x), 1), medoid), 40)
    assert (np.diff(np.where(np.isfinite(far), far, 9), axis=1) >= 0).all()
    best = truth(x, 5)
    assert np.mean([len(set(f[1:7]) & set(b)) / 5 for f, b in zip(found, best)]) > 0.9


def test_shards_recall_and_dirty_vectors(spark):
    x = clustered(3000, 32, 4)
    rows = [(int(i), [float(v) for v in x[i] * (1 + i % 3)]) for i in range(len(x))]
    dirty = [(9001, None), (9002, [0.0] * 32), (9003, [1.0] * 31), (9004, [float("nan")] * 32), (9005, [float("inf")] * 32), (None, [1.0] * 32), (9006, [None] * 32), (9007, [])]
    df = spark.createDataFrame(rows + rows[:200] + dirty, "file_id long, embedding array<float>")
    got = nearest(df, 5, dims=32, sample_rows=1500, shard_rows=700).collect()
    best = truth(x, 5)
    by = {}
    for r in got:
        by.setdefault(r.file_id, []).append((r.place, r.other))
    assert set(by) == set(range(len(x))) and all(sorted(p for p, _ in v) == [1, 2, 3, 4, 5] for v in by.values())
    assert np.mean([len({o for _, o in by[i]} & set(best[i])) / 5 for i in range(len(x))]) > 0.9


def test_equal_vectors_and_ties(spark):
    df = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(10)], "file_id long, embedding array<float>")
    got = nearest(df, 3, dims=2, shard_rows=8, sample_rows=10).collect()
    assert all(r.file_id != r.other for r in got)
    ranked = {i: [r.other for r in sorted(got, key=lambda r: r.place) if r.file_id == i] for i in range(10)}
    assert ranked[9] == [0, 1, 2] and ranked[0] == [1, 2, 3]


def test_centroids_part_what_can_be_parted():
    x = clustered(2000, 16)
    c = fit_centroids(x, 20000, 2000)
    assert len(c) >= 10
    assert len(fit_centroids(np.ones((50, 4), np.float32), 1000, 100)) == 1


def test_many_files_of_one_vector(spark):
    x = clustered(1200, 32, 5)
    x[300:700] = x[300]
    x[710:713] = x[710]
    df = spark.createDataFrame([(5000 - i, [float(v) for v in x[i]]) for i in range(len(x))], "file_id long, embedding array<float>")
    by = {}
    for r in nearest(df, 5, dims=32, sample_rows=600, shard_rows=300).collect():
        by.setdefault(r.file_id, []).append((r.place, r.other, r.similarity))
    assert set(by) == set(range(5000 - 1199, 5001)) and all(sorted(p for p, _, _ in v) == [1, 2, 3, 4, 5] for v in by.values())
    low = list(range(5000 - 699, 5000 - 690))
    for i in range(300, 700):
        assert [o for _, o, _ in sorted(by[5000 - i])] == [o for o in low if o != 5000 - i][:5]
    for i in (710, 711, 712):
        assert [o for _, o, _ in sorted(by[5000 - i])][:2] == [o for o in (4288, 4289, 4290) if o != 5000 - i]


def test_many_askers_and_ids_of_several_vectors(spark, monkeypatch):
    from estatescope.llm import neighbours

    x = clustered(900, 16, 6)
    rows = [(i, [float(v) for v in x[i]]) for i in range(900)]
    # an id given with several vectors counts with the least
    rows += [(i, [float(v) + 1.0 for v in x[i]]) for i in range(40)]
    df = spark.createDataFrame(rows, "file_id long, embedding array<float>")
    monkeypatch.setattr(neighbours, "ASKERS", 1)
    got = nearest(df, 5, dims=16, sample_rows=400, shard_rows=150).collect()
    by = {}
    for r in got:
        by.setdefault(r.file_id, []).append((r.place, r.other))
    assert set(by) == set(range(900)) and all(len({o for _, o in v}) == 5 and sorted(p for p, _ in v) == [1, 2, 3, 4, 5] for v in by.values())
    best = truth(x, 5)
    assert np.mean([len({o for _, o in by[i]} & set(best[i])) / 5 for i in range(900)]) > 0.9


def test_near_vectors_of_cells_that_do_not_ask_each_other(spark):
    # groups of ten in no order that centroids could follow, and many small cells
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 96))[np.arange(4000) // 10] + 0.7 * rng.normal(size=(4000, 96))
    df = spark.createDataFrame([(int(i), [float(v) for v in x[i]]) for i in range(4000)], "file_id long, embedding array<float>")
    x = x.astype(np.float32).astype(np.float64)
    best = truth(x / np.linalg.norm(x, axis=1, keepdims=True), 5)
    by = {}
    for r in nearest(df, 5, dims=96, sample_rows=2000, shard_rows=60).collect():
        by.setdefault(r.file_id, []).append((r.place, r.other))
    assert set(by) == set(range(4000)) and all(sorted(p for p, _ in v) == [1, 2, 3, 4, 5] for v in by.values())
    recall = np.mean([len({o for _, o in by[i]} & set(best[i])) / 5 for i in range(4000)])
    assert recall > 0.92, recall
