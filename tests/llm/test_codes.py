import hashlib
import math

import numpy as np
import pytest

from strandlake.llm import codes


def plain(rows, parts=16, entries=64, rounds=2):
    """The contract in whole numbers; rows: (id, vector, label)."""
    kept = [(i, tuple(math.floor(256 * x) for x in v), lab) for i, v, lab in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return {}
    wide = len(kept[0][1]) // parts
    cut = [[v[p * wide : (p + 1) * wide] for p in range(parts)] for _, v, _ in kept]
    books = [[cut[e][p] for e in range(min(entries, len(kept)))] for p in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assigned():
        return [[min((away(c[p], b), e) for e, b in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        chosen = assigned()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [c[p] for c, a in zip(cut, chosen) if a[p][1] == e]
                if mine:
                    books[p][e] = tuple(sum(x) // len(mine) for x in zip(*mine))
    last = assigned()
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in a) for a in last]
    per = {}
    for (_, _, lab), err in zip(kept, errors):
        per[lab] = per.get(lab, 0) + err
    return sorted((repr(i), "".join(f"{e:02x}" for _, e in a), err, per[lab], sha) for (i, _, lab), a, err in zip(kept, last, errors))


def table_of(spark, rows):
    full = [(i, v, lab, "x", 1, 2) for i, v, lab in rows]
    return spark.createDataFrame(full, "vec_id long, embedding array<double>, label int, code string, error int, values int")


def got(spark, rows):
    out = codes.code_digest(table_of(spark, rows))
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((repr(r["vec_id"]), *list(r)[1:]) for r in out.collect())


def test_against_whole_numbers(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), (rng.standard_normal(32) * 0.3).tolist(), int(i) % 3 if i % 5 else None) for i in rng.permutation(150)]
    rows += [(1000 + i, rows[0][1], 1) for i in range(40)] + [(7, rows[7][1], 2), (None, rows[8][1], 2), (2000, [0.0] * 32, 1)]
    rows += [(3000, None, 1), (3001, [float("nan")] * 32, 1), (3002, [float("-inf")] + [0.0] * 31, 1), (3003, [None] + [0.0] * 31, 1), (3004, [], 1)]
    assert got(spark, rows) == plain(rows)


@pytest.mark.parametrize("n", [1, 5, 63])
def test_fewer_vectors_than_entries(spark, n):
    rows = [(i, [((i * 7 + j) % 11 - 5) / 100 for j in range(16)], None) for i in range(n)]
    assert got(spark, rows) == plain(rows)


def test_other_lengths_and_too_large_components_are_left_out(spark):
    rows = [(i, [i / 10.0] * 16, 1) for i in range(4)]
    odd = [(10, [0.1] * 32, 1), (11, [0.1] * 15, 1), (12, [65536.0] + [0.0] * 15, 1)]
    assert got(spark, rows + odd) == plain(rows)


def test_empty_table(spark):
    assert got(spark, []) == [] and codes.code_digest(table_of(spark, [(1, None, 1)])).count() == 0


def test_annuli_lose_no_entry_and_compare_fewer():
    rng = np.random.default_rng(5)
    sizes = lambda n: rng.lognormal(0, 1, (n, 1))
    entries = np.floor(rng.standard_normal((64, 4)) * 256 * sizes(64)).astype(np.int64)
    entries[10] = entries[3]  # ties
    entries[20] = -entries[4]  # an equal norm
    x = np.concatenate([np.floor(rng.standard_normal((3000, 4)) * 256 * sizes(3000)).astype(np.int64), entries, np.zeros((2, 4), np.int64), entries + 100_000])
    best, dist, compared = codes.Annuli(entries).nearest(x)
    all_ = ((x[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    assert (best == all_.argmin(axis=1)).all() and (dist == all_.min(axis=1)).all()
    assert compared.min() >= 1 and compared[:3000].mean() < 40


def test_blocks_of_pairs_do_not_change_the_result(monkeypatch):
    rng = np.random.default_rng(6)
    entries, x = (rng.integers(-500, 500, (n, 3)) for n in (64, 400))
    want = codes.Annuli(entries).nearest(x)
    monkeypatch.setattr(codes, "BLOCK_PAIRS", 100)
    assert all((a == b).all() for a, b in zip(codes.Annuli(entries).nearest(x), want))


def test_decoded_vectors_are_near(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(16) * 0.2).tolist(), 1) for i in range(300)]
    vectors = codes.kept_vectors(table_of(spark, rows), "vec_id", "embedding", "label", 16)
    books = codes.train(vectors)
    coded = codes.encode(vectors, books).cache()
    back = {r["vec_id"]: np.array(r["vector"]) for r in codes.decode(coded, books).collect()}
    for r in coded.collect():
        gap = np.abs(np.floor(np.array(rows[r["vec_id"]][1]) * 256) + 0.5 - back[r["vec_id"]] * 256)
        assert round(float((gap**2).sum())) == r["error"]
