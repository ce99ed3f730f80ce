import numpy as np
import pytest

from strandlake.llm import embeddings as em


def brute_force(rows, threshold=0.93):
    def unit(x):
        if x is None or any(v is None or not np.isfinite(v) for v in x):
            return None
        a = np.array(x, float)
        return a / np.linalg.norm(a) if a.any() else None

    units = [unit(r[1]) for r in rows]
    n = len(rows)
    links = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(i):
            if rows[i][2] is not None and rows[i][2] == rows[j][2] and units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]):
                links[i, j] = links[j, i] = units[i] @ units[j] >= threshold
    label = np.arange(n)
    while True:
        new = np.array([min([label[i], *label[links[i]]]) for i in range(n)])
        if (new == label).all():
            break
        label = new
    ids = [r[0] for r in rows]
    least = [min(ids[k] for k in range(n) if label[k] == label[i]) for i in range(n)]
    return sorted((ids[i], int(links[i].sum()), least[i], ids[i] == least[i]) for i in range(n))


def cloud(seed, groups=40, hot=60):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        base = rng.standard_normal(16)
        for _ in range(rng.integers(1, 5)):
            rows.append((base + rng.standard_normal(16) * rng.choice([0.0, 0.1, 0.25]), int(rng.integers(0, 2))))
    base = rng.standard_normal(16)
    rows += [(base + rng.standard_normal(16) * 0.1, 1) for _ in range(hot)] + [(base, 1)] * hot
    rng.shuffle(order := np.arange(len(rows)))
    return [(int(i), [float(np.float32(v)) for v in rows[k][0]], rows[k][1]) for i, k in enumerate(order)]


ODD = [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] * 16, 0), (903, [None] * 16, 0), (904, [1.0] * 16, None), (905, [1.0] * 16, None), (906, [1.0] * 8, 0), (907, [2.0] * 8, 0), (908, [float("inf")] + [0.0] * 15, 0), (909, [1e-30] * 16, 5), (910, [1e30] * 16, 5), (911, [], 0)]


@pytest.mark.parametrize("seed", [0])
def test_against_brute_force(spark, seed):
    rows = cloud(seed) + ODD
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(tuple(r) for r in em.link_embeddings(table).collect())
    assert got == brute_force(rows)


def test_empty_and_repeated(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert em.link_embeddings(table).count() == 0
    same = spark.createDataFrame([(1, [1.0, 0.0], 0)] * 3 + [(None, [1.0, 0.0], 0)], "vec_id long, embedding array<float>, label int")
    assert sorted((r["n_links"], r["component_id"]) for r in em.link_embeddings(same).collect()) == [(3, 1)] * 4


def test_groups_across_batches():
    import pyarrow as pa

    batches = [pa.record_batch({"k": [1, 1, 2], "v": [1, 2, 3]}), pa.record_batch({"k": [2, 2], "v": [4, 5]}), pa.record_batch({"k": [3], "v": [6]})]
    assert [(k, t.column("v").to_pylist()) for k, t in em.groups(batches, 1)] == [((1,), [1, 2]), ((2,), [3, 4, 5]), ((3,), [6])]


def test_dense_clusters_keep_their_cross_links(spark):
    rng = np.random.default_rng(4)
    near = rng.standard_normal(16)
    near /= np.linalg.norm(near)
    side = rng.standard_normal(16)
    side -= (side @ near) * near
    side /= np.linalg.norm(side)
    rows = []
    for angle in (0.0, 0.34):  # the centres lie at 0.943, within a cluster all at over 0.98
        centre = np.cos(angle) * near + np.sin(angle) * side
        rows += [centre + rng.standard_normal(16) * 0.015 for _ in range(40)]
    rows = [(i, [float(np.float32(v)) for v in r], 0) for i, r in enumerate(rows)]
    want = brute_force(rows)
    assert min(w[1] for w in want) > 40
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    others = spark.range(1000, 61000).selectExpr("id AS vec_id", "array(cast(1 AS float), cast(id AS float)) AS embedding", "cast(id AS int) AS label")
    got = em.link_embeddings(table.unionByName(others)).where("vec_id < 1000")
    assert sorted(tuple(r) for r in got.collect()) == want


@pytest.mark.parametrize("dim, spread", [(4, 0.3), (16, 0.15)])
def test_cells_of_vectors_lose_no_link(monkeypatch, dim, spread):
    monkeypatch.setattr(em, "TILE", 8)
    rng = np.random.default_rng(dim)
    x = np.repeat(rng.standard_normal((30, dim)), 10, axis=0) + rng.standard_normal((300, dim)) * spread
    x /= np.linalg.norm(x, axis=1)[:, None]
    n, order = rng.integers(1, 4, 300), rng.integers(0, 40, 300)
    order[:200] = np.repeat(np.arange(20), 10)
    hit = x @ x.T >= 0.93
    np.fill_diagonal(hit, False)
    assert hit.sum() > 300
    links, label = em.links_in_cell(x, n, order, np.arange(300), None, 0.93)
    assert (links == hit @ n).all() and (label[np.nonzero(hit)[0]] == label[np.nonzero(hit)[1]]).all()
    left, right = np.arange(140), np.arange(140, 300)
    links, label = em.links_in_cell(x, n, order, left, right, 0.93)
    assert (links[left] == hit[:140, 140:] @ n[140:]).all() and (links[right] == n[:140] @ hit[:140, 140:]).all()
    assert (label[left[np.nonzero(hit[:140, 140:])[0]]] == label[right[np.nonzero(hit[:140, 140:])[1]]]).all()


def table_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def grouped(spark, rows, **how):
    table = table_of(spark, rows).selectExpr("vec_id AS vec", "cast(embedding AS array<double>) AS embedding", "label")
    return em.link_groups(table, 0.93, **how)


def test_lists_alone_hold_all_links_of_small_groups(spark):
    """No exact comparison at all: edges of the graph against brute force."""
    rows = cloud(2, groups=60, hot=0)
    classes, graph, audit = grouped(spark, rows, mend=False)
    names = {r["cls"]: r["least"] for r in classes.collect()}
    edges = {(names[r["src"]], names[r["dst"]]) for r in graph.where("sim >= 0.93").collect()}
    found = {tuple(sorted(e)) for e in edges}
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids = {r[0]: i for i, r in enumerate(rows)}
    want = {(a, b) for a in names.values() for b in names.values() if a < b and rows[ids[a]][2] == rows[ids[b]][2] and x[ids[a]] @ x[ids[b]] >= 0.93}
    assert found == want and len(want) > 20
    assert audit.recall == 1 and audit.classes == len(names)


def test_the_audit_notices_poor_lists_and_mends_them(spark):
    rows = cloud(3, groups=150, hot=30)
    poor = {"tables": 1, "window": 1, "rounds": 0, "k": 2}
    _, _, audit = grouped(spark, rows, mend=False, **poor)
    assert 0 < audit.recall < 1 and audit.rounds == 1
    _, _, audit = grouped(spark, rows, **poor)
    assert audit.recall < 1 and audit.rounds > 1
    got = sorted(tuple(r) for r in em.link_embeddings(table_of(spark, rows), **poor).collect())
    assert got == brute_force(rows)


def test_good_lists_need_no_mending(spark):
    _, _, audit = grouped(spark, cloud(5))
    assert audit.recall >= 0.99 and audit.wanting == 0


def test_labels_found_wanting_are_compared_whole(spark, monkeypatch):
    monkeypatch.setattr(em, "AUDITS", 1)
    rows = cloud(6, groups=100, hot=20)
    _, _, audit = grouped(spark, rows, tables=1, window=1, rounds=0, k=2)
    assert audit.wanting > 0
    got = em.link_embeddings(table_of(spark, rows), tables=1, window=1, rounds=0, k=2)
    assert sorted(tuple(r) for r in got.collect()) == brute_force(rows)


def test_a_chain_of_saturated_clusters(spark):
    """Each cluster links with the next one alone; all lists are full of own."""
    rng = np.random.default_rng(8)
    a, b = np.linalg.qr(rng.standard_normal((24, 2)))[0].T
    rows = []
    for step in range(5):
        centre = np.cos(0.33 * step) * a + np.sin(0.33 * step) * b
        rows += [centre + rng.standard_normal(24) * 0.012 for _ in range(30)]
    rows = [(i, [float(np.float32(v)) for v in r], 0) for i, r in enumerate(rows)]
    want = brute_force(rows)
    assert {w[2] for w in want} == {0}
    assert sorted(tuple(r) for r in em.link_embeddings(table_of(spark, rows)).collect()) == want
