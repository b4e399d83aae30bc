"""Operators on embeddings against brute force, and their defined results on odd rows."""

import hashlib
import math
import random
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from corpusloom.llm import ann_search, vector_codes, whitening
from corpusloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"
ROWS = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    return np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float), [r.label for r in rows]


@pytest.fixture(scope="module")
def odd(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (50, [2.0, 4.0], None), (50, [2.0, 4.0], None), (1, [1.0, 2.0], None), (2, [1.0], 1), (3, None, 1), (4, [], 1), (5, [1.0, None], 1), (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (8, [0.0, 0.0], 2), (None, [-1.0, 3.0], 2), (9, [1e30, -1e30], 3), (100, [-1.0, 0.5], 2)]
    df = spark.createDataFrame(rows, ROWS)
    for name in ("id", "v", "x", "code", "part", "rep", "n", "i", "error", "r"):
        df = df.selectExpr("*", f"'clash' AS {name}")
    return df


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], ROWS)


def exact_nearest(ids, x, every, k):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    for i in np.flatnonzero(ids % every == 0):
        score = u @ u[i]
        order = sorted((j for j in range(len(ids)) if ids[j] != ids[i]), key=lambda j: (-round(score[j], 12), ids[j]))[:k]
        yield from ((int(ids[i]), r, int(ids[j]), score[j]) for r, j in enumerate(order, 1))


def test_ann_recall_and_exact_scores(spark, table):
    ids, x, _ = table
    got = QUERIES["op11_cross_polytope_ann"](spark, SF).collect()
    want = list(exact_nearest(ids, x, 50, 5))
    assert len({(r.query_id, r.vec_id) for r in got} & {w[::2][:2] for w in want}) >= 0.9 * len(want)
    place = {int(i): n for n, i in enumerate(ids)}
    for q in {r.query_id for r in got}:
        rows = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == [1, 2, 3, 4, 5] and q not in {r.vec_id for r in rows}
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        for r in rows:
            a, b = x[place[q]], x[place[r.vec_id]]
            assert math.isclose(r.score, a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs_tol=1e-14)


def test_ann_all_probes_are_exact_with_hot_and_split_parts(spark, monkeypatch):
    """All buckets probed, in tiny parts and blocks: brute force, with a vector that a third of the rows share."""
    monkeypatch.setattr(ann_search, "PART_BYTES", 8 * 12 * 5)
    monkeypatch.setattr(ann_search, "BLOCK", 3)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 12))
    x[rng.random(300) < 0.33] = x[0]
    x[10] = 2 * x[11]
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)]
    random.Random(1).shuffle(rows)
    got = ann_search.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=10, recall=1.01).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == sorted(w[:3] for w in exact_nearest(np.arange(300), x, 10, 5))


def test_probes_come_in_order_of_all_buckets():
    rng = np.random.default_rng(2)
    u = ann_search.units(rng.normal(size=(4, 6)))
    for digits in (1, 2, 3):
        index = ann_search.Index.make(6)._replace(digits=digits, probes=40)
        everything = index._replace(probes=16**digits).probe_codes(u, 1)
        assert everything.shape[1] == 16**digits and all(len(set(row)) == 16**digits for row in everything)
        assert (index.probe_codes(u, 1) == everything[:, :40]).all() or digits > 1
        assert (everything[:, 0] == index.codes(u, 1)).all()
        assert [set(a) for a in index.probe_codes(u, 1)] == [set(b[: len(a)]) for a, b in zip(index.probe_codes(u, 1), everything, strict=True)]


def test_pseudo_rotations_keep_angles():
    u = ann_search.units(np.random.default_rng(3).normal(size=(20, 50)))
    y = ann_search.Index.make(50).rotated(u, 2, 1)
    assert y.shape == (20, 64) and np.allclose(y @ y.T, u @ u.T)


def test_ann_odd_rows(odd, none):
    got = [(r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in ann_search.nearest(odd, k=2).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 50, 1.0), (50, 1, 0, 1.0), (50, 2, 1, 1.0), (100, 1, 0, 0.0), (100, 2, 1, 0.0)]
    assert ann_search.nearest(none).count() == 0


def test_jacobi_keeps_small_eigenvalues():
    """Eigenvalues over 35 powers of ten, on a graded matrix: their product against the exact determinant."""
    rng = np.random.default_rng(4)
    b = np.eye(8) + 0.1 * rng.normal(size=(8, 8))
    grade = 10.0 ** -np.arange(0, 20, 2.5)
    a = (b @ b.T) * grade[:, None] * grade[None, :]
    e, v = whitening.jacobi(a)

    def det(m):
        m, out = [[Fraction(float(x)) for x in row] for row in m], Fraction(1)
        for i in range(len(m)):
            out *= m[i][i]
            for j in range(i + 1, len(m)):
                f = m[j][i] / m[i][i]
                m[j] = [p - f * q for p, q in zip(m[j], m[i], strict=True)]
        return out

    assert (np.diff(e) < 0).all() and np.allclose(v @ v.T, np.eye(8), atol=1e-14)
    assert math.isclose(math.prod(Fraction(float(x)) for x in e) / det(a), 1.0, rel_tol=1e-12)
    assert np.allclose(whitening.jacobi(np.zeros((3, 3)))[0], 0)


def test_whitening_against_brute_force(spark, table):
    ids, x, _ = table
    rows = QUERIES["op12_jacobi_whitening"](spark, SF).collect()
    whole = np.floor(64 * x).astype(int) + 1_000_000
    n, s = len(x), whole.sum(0)
    z = n * whole - s
    e, vectors = np.linalg.eigh(z.T @ z / n**3)
    e, vectors = e[::-1], vectors[:, ::-1]
    place = {int(i): p for p, i in enumerate(ids)}
    got = np.zeros((n, 32))
    for r in rows:
        p = place[r.vec_id]
        got[p, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == (z[p] ** 2).sum() and r.identity_error < 1e-10
        assert math.isclose(r.explained, e[r.component - 1] / e.sum(), rel_tol=1e-9)
    want = (z / n) @ vectors[:, :32] / np.sqrt(e[:32])
    assert len(rows) == 32 * n and np.allclose(np.abs((got * want).mean(0)), 1) and np.allclose(np.abs(got), np.abs(want), atol=1e-8)


def test_whitening_of_dependent_and_huge_entries(spark):
    """A copied dimension has no variance of its own; numbers whose squares exceed a double's whole numbers stay exact."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=(60, 3))
    df = spark.createDataFrame([(i, [*map(float, b), float(b[0])]) for i, b in enumerate(base)], "vec_id long, embedding array<double>")
    rows = whitening.whiten(df).collect()
    assert len(rows) == 240 and all((r.whitened is None) == (r.component == 4) and r.identity_error < 1e-9 for r in rows)
    y = np.array([[int(v) for v in row] for row in rng.integers(-(2**40), 2**40, size=(7, 3))], object)
    assert (whitening.products(y, 2**41) == y.T @ y).all() and (whitening.products(y // 2**20, 2**21) == (y // 2**20).T @ (y // 2**20)).all()
    assert whitening.deviations(y.astype(np.int64), [0, 1, 2], 7, 2**41) == [min(sum((7 * int(v) - k) ** 2 for k, v in enumerate(r)), 2**63 - 1) for r in y]


def test_whitening_odd_rows(spark, odd, none):
    rows = whitening.whiten(odd).collect()
    assert {(r.vec_id, r.n) for r in rows} == {(i, 8) for i in (0, 1, 8, 9, 50, 100, None)} and len(rows) == 16
    assert whitening.whiten(none).count() == 0
    alone = whitening.whiten(spark.createDataFrame([(1, [3.0, 4.0])], "vec_id long, embedding array<float>")).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone] == [(1, 1, 0, None, 0.0, 0.0), (2, 1, 0, None, 0.0, 0.0)]


def test_codes_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.execute(ORACLES["op13_exponion_codes"]).fetchall()
    assert sorted(map(tuple, QUERIES["op13_exponion_codes"](spark, SF).collect())) == sorted(want)


@pytest.mark.parametrize("kind", [float, object])
def test_exponion_finds_the_nearest_entry_from_any_start(kind):
    rng = np.random.default_rng(8)
    entries = rng.integers(-6, 6, size=(40, 3))  # many ties and equal entries
    x, start = rng.integers(-9, 9, size=(700, 3)), rng.integers(0, 40, size=700)
    dist = ((x[:, None] - entries[None]) ** 2).sum(2)
    index, least = vector_codes.Neighbours(entries, kind).assign(x, start)
    assert (index == dist.argmin(1)).all() and (least == dist.min(1)).all()


def test_exponion_scans_few_entries_from_a_near_start(monkeypatch):
    """From its own cluster's entry, a row's radius holds few others."""
    rng, seen = np.random.default_rng(9), []
    entries = rng.integers(-(10**4), 10**4, size=(256, 4))
    near = vector_codes.Neighbours(entries, float)
    x = entries[np.arange(1000) % 256] + rng.integers(-9, 9, size=(1000, 4))
    real = vector_codes.squared
    monkeypatch.setattr(vector_codes, "squared", lambda a, b: (seen.append(len(a) * len(b)), real(a, b))[1])
    assert (near.assign(x, np.arange(1000) % 256)[0] == np.arange(1000) % 256).mean() > 0.99 and sum(seen) < 20_000


def test_codes_odd_rows(odd, none, spark):
    rows = {(r.vec_id, r.code, r.error) for r in vector_codes.compress(odd).collect()}
    books = vector_codes.learn_and_encode(odd)[1]
    assert {i for i, _, _ in rows} == {0, 1, 8, 9, 50, 100, None} and [b.shape for b in books] == [(7, 1), (7, 1), (7, 0), (7, 0)]
    assert vector_codes.compress(none).count() == 0
    lone = vector_codes.compress(spark.createDataFrame([(None, [1.0, 2.0, 3.0, 4.0])], "vec_id long, embedding array<double>")).collect()
    assert lone[0].codebooks_sha256 == hashlib.sha256(b"1024,2048,3072,4096").hexdigest() and lone[0].code == "00000000"
