"""Exact dedup, hard negatives and whitening against brute force."""

import itertools
import math
import re
from collections import defaultdict
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinion_spark.llm import exact, mining, whitening
from tests.llm.helpers import BIG, DOC_SCHEMA, DOCS, LONG, docs, rows, sha

VECTORS = "vec_id long, embedding array<float>, label int"


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute_exact(data):
    groups = defaultdict(list)
    for k, (i, t) in enumerate(data):
        groups[normal(t)].append((i is None, i, k))
    out = []
    for text, members in groups.items():
        keep = min(members, key=lambda m: (m[0], m[1] if m[1] is not None else 0))
        out += [(i, keep[1], len(members), sha(text)) for _, i, _ in members]
    return out


SPACED = [(1, "a b"), (0, "a \t\n b"), (2, " a b"), (2, " a b"), (2, "a b"), (None, "x"), (None, "x\v"), (None, "x "), (5, None), (6, ""), (7, " "), (8, "\f"), (9, LONG), (3, LONG.replace(" ", "  ")),
          (10, "İ"), (11, "i̇"), (12, "b a"), (13, "ab")]


@pytest.mark.parametrize("hot_groups", [1, 3, 10_000])
@pytest.mark.parametrize("hashing", [exact.content_hash, lambda t: F.length(t) % 3, lambda t: F.lit(7)])
def test_exact_against_plain_python(spark, hot_groups, hashing):
    """Also with hashes that collide, down to one hash for all, and with every or no group hot."""
    for data in (SPACED, [(r[0], r[1]) for r in DOCS]):
        frame = docs(spark, [(i, t, None, None, 0) for i, t in data]).withColumn("hash", F.lit("clash")).withColumn("body", F.lit(1))
        got = exact.deduplicate(frame, hashing=hashing, hot_groups=hot_groups).collect()
        key = lambda r: tuple((x is None, x or 0) for x in r[:3]) + (r[3],)
        assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=key) == sorted(brute_exact(data), key=key)
        kept = [r for r in got if r.kept]
        assert len(kept) == len({r.text_sha256 for r in got}) == len({r.text_sha256 for r in kept})
        assert all(r.doc_id == r.keep_id for r in kept)


def test_exact_empty_table(spark):
    out = exact.deduplicate(spark.createDataFrame([], DOC_SCHEMA))
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and rows(out) == []


def test_exact_large_group_of_copies(spark):
    data = [(i, "the same text" if i % 3 else f"text {i}", None, None, 0) for i in range(300)]
    got = {r.doc_id: r for r in exact.deduplicate(spark.createDataFrame(data, DOC_SCHEMA).repartition(7)).collect()}
    assert got[2].keep_id == 1 and got[2].group_size == 200 and not got[2].kept and got[1].kept and got[3].group_size == 1


def taking_part(data):
    return [(i, label, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, label in data
            if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]


def brute_mine(data, every, positives=5, negatives=3, low=50, high=95):
    part, out = taking_part(data), []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for k, (a, la, va) in enumerate(part):
        if a % every:
            continue
        scored = sorted((-dot(va, v), i, lab) for m, (i, lab, v) in enumerate(part) if m != k and len(v) == len(va))
        for down, p, _ in [s for s in scored if s[2] == la][:positives]:
            fit = [s for s in scored if s[2] != la and low * -down <= 100 * -s[0] <= high * -down][:negatives]
            out += [(a, p, r + 1, s[1], -down, -s[0]) for r, s in enumerate(fit)]
    return out


def vectors(seed, n, d, labels, whole=False):
    g = np.random.default_rng(seed)
    base = g.standard_normal((labels, d))
    out = []
    for i in range(n):
        label = int(g.integers(labels))
        v = base[label] * 0.3 + g.standard_normal(d) * 0.4 + 0.2
        out.append((i, [float(np.float32(round(x, 1) if whole else x)) for x in v], label))
    return out


def mined(frame, every, **how):
    part = mining.whole_vectors(frame, 256, "vec_id", "embedding", F.col("label"))
    return rows(mining.mine(part, F.col("id") % every == 0, **how))


@pytest.mark.parametrize("seed,n,d,labels,whole", [(1, 200, 8, 4, False), (2, 150, 2, 3, True), (3, 60, 4, 40, False), (4, 90, 1, 2, True)])
@pytest.mark.parametrize("block,part", [(16384, 16384), (4, 30)])
def test_mining_against_plain_python(spark, seed, n, d, labels, whole, block, part):
    data = vectors(seed, n, d, labels, whole)
    got = mined(spark.createDataFrame(data, VECTORS), 5, anchors_each=block, part=part)
    assert sorted(got) == sorted(brute_mine(data, 5)) and (got or labels == 40)


@pytest.mark.parametrize("how", [{"positives": 1, "negatives": 1}, {"positives": 9, "negatives": 7, "low": 0, "high": 100}, {"low": 90, "high": 90}])
def test_mining_windows(spark, how):
    data = vectors(7, 120, 3, 3, True)
    assert sorted(mined(spark.createDataFrame(data, VECTORS), 7, part=25, **how)) == sorted(brute_mine(data, 7, **how))


def test_mining_awkward_rows(spark):
    """Nulls, other lengths, empty vectors, repeated rows and ids, ties, ids beyond 2**53, clashing columns."""
    data = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (5, None, 1), (10, [None, 1.0], 1), (15, [float("nan"), 1.0], 1), (20, [float("inf"), 1.0], 2), (None, [1.0, 1.0], 1), (25, [1.0, 0.5], None),
            (30, [1.0], 1), (31, [0.5], 1), (32, [0.4], 2), (35, [], 1), (36, [], 1), (37, [], 2), (40, [-1.0, -1.0], 1), (41, [0.9, 0.1], 2), (42, [0.9, 0.1], 2), (43, [0.9, 0.1], 2), (44, [0.9, 0.1], 2),
            (BIG - 1, [1.0, 0.4], 2), (BIG, [1.0, 0.25], 1), (5 * (BIG // 5), [1.0, 0.25], 2)]
    frame = spark.createDataFrame(data, VECTORS)
    for name in ("id", "row", "v", "block", "part", "score", "slot", "p"):
        frame = frame.withColumn(name, F.lit("clash"))
    got = mined(frame, 5, anchors_each=2, part=3)
    assert sorted(got) == sorted(brute_mine(data, 5)) and got
    assert mined(spark.createDataFrame([], VECTORS), 5) == []


def test_mining_scores_of_many_bits(spark):
    data = [(k * 5, [float(2 ** 20) * s, float(2 ** 20) + k], k % 2) for k, s in enumerate([1, 1, 1, 0.5, 0.5, -1])]
    assert sorted(mined(spark.createDataFrame(data, VECTORS), 5)) == sorted(brute_mine(data, 5))
    a = np.array([[3 << 40, 1]]), np.array([[1 << 20, 5], [-(1 << 20), 7]])
    assert mining.products(*a).tolist() == [[(3 << 60) + 5, -(3 << 60) + 7]]
    with pytest.raises(OverflowError):
        mining.products(np.array([[1 << 40]]), np.array([[1 << 40]]))


def spread(seed, n, d):
    g = np.random.default_rng(seed)
    return [(i, [float(np.float32(x)) for x in v], 0) for i, v in enumerate((g.standard_normal((n, d)) * np.linspace(1, 3, d)) @ np.linalg.qr(g.standard_normal((d, d)))[0])]


def whitened(frame, **how):
    return whitening.whiten(whitening.whole_vectors(frame, 1024, 100000, "vec_id", "embedding"), **how).collect()


def brute_whiten(data, k):
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v, _ in data], dtype=object)
    n, s = len(x), x.sum(axis=0)
    dev = ((n * x - s) ** 2).sum(axis=1)
    c = ((n * x - s) / n).astype("float64")
    values, vecs = np.linalg.eigh(c.T @ c / n)
    values, vecs = values[::-1][:k], vecs[:, ::-1][:, :k]
    return dev, values, c @ vecs, values / np.trace(c.T @ c / n)


@pytest.mark.parametrize("seed,n,d", [(1, 400, 20), (2, 300, 64), (3, 50, 3), (4, 40, 1)])
def test_whitening_against_dense_eigenvectors(spark, seed, n, d):
    data = spread(seed, n, d)
    got = whitened(spark.createDataFrame(data, VECTORS).repartition(5))
    k = min(8, d)
    dev, values, projected, shares = brute_whiten(data, k)
    assert len(got) == n * k and {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    by = {(r.id, r.component): r for r in got}
    sign = np.array([1 if by[0, j + 1].whitened * projected[0, j] > 0 else -1 for j in range(k)])
    for i, j in itertools.product(range(n), range(k)):
        r = by[i, j + 1]
        assert r.deviation == dev[i] and abs(r.whitened - sign[j] * projected[i, j] / values[j] ** 0.5) < 1e-7 and abs(r.explained / shares[j] - 1) < 1e-9


def test_whitening_awkward_rows(spark):
    """Nulls, repeated and null ids, other lengths, constant and single rows, a deviation beyond 64 bits, clashing columns."""
    data = [*spread(5, 30, 4), (None, [1.0, 2.0, 3.0, 4.0], 1), (1, [9.0, 2.0, 3.0, 4.0], 1), (1, [9.0, 2.0, 3.0, 4.0], 1), (100, None, 1), (101, [None, 1.0, 1.0, 1.0], 1),
            (102, [float("nan")] * 4, 1), (103, [float("-inf")] * 4, 1), (104, [], 1), (105, [5.0, 5.0], 1), (106, [7.0], 1), (107, [8.0], 1)]
    frame = spark.createDataFrame(data, VECTORS)
    for name in ("id", "x", "n", "component", "deviation"):
        frame = frame.withColumn(name, F.lit("clash"))
    got = whitened(frame)
    four = [r for r in got if r.n == 33]
    dev, values, projected, _ = brute_whiten([d for d in data if d[1] is not None and len(d[1]) == 4 and all(x is not None and math.isfinite(x) for x in d[1])], 4)
    assert len(four) == 4 * 33 and sorted(r.deviation for r in four if r.component == 1) == sorted(dev)
    assert np.allclose(sorted(abs(r.whitened) for r in four if r.component == 2), sorted(abs(projected[:, 1] / values[1] ** 0.5)))
    alone = [r for r in got if r.id == 105]
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained) for r in alone] == [(1, 1, 0, None, None), (2, 1, 0, None, None)]
    assert sorted(r.whitened for r in got if r.id in (106, 107)) == pytest.approx([-1, 1]) and not [r for r in got if r.id in (100, 101, 102, 103, 104)]
    assert whitened(spark.createDataFrame([], VECTORS)) == [] and whitened(frame.where("id = 'none'")) == []


def test_whitening_of_few_directions(spark):
    """Components without variance are null; tied values are still orthonormal."""
    data = [(i, [float(i % 2), float(i // 2 % 2), 1.0, 1.0], 0) for i in range(40)]
    got = whitened(spark.createDataFrame(data, VECTORS), components=3)
    assert {r.component for r in got if r.whitened is None} == {3} and got[0].identity_error < 1e-12
    assert all(abs(abs(r.whitened) ** 2 - 1) < 1 for r in got if r.component < 3)
    assert sum(r.explained for r in got if r.id == 0) == pytest.approx(1)


def test_exact_deviation_beyond_64_bits():
    n = 3_000_000
    centre = whitening.Centre(n, [n * 100000 + 7, n * 99000 - 5])
    model = whitening.Whitening(centre, [1.0, 1.0], np.eye(2), 2.0)
    x = np.array([[101024, 98000], [100000, 99000]])
    want = [(n * 101024 - centre.sums[0]) ** 2 + (n * 98000 - centre.sums[1]) ** 2, 7 ** 2 + 5 ** 2]
    assert [int(v) for v in model.deviations(x)] == want and want[0] > 1 << 62
    assert Decimal(want[0]) == want[0]


@pytest.mark.parametrize("d,wanted,rank", [(1, 1, 1), (12, 8, 12), (30, 8, 9), (20, 8, 0), (90, 8, 90), (64, 3, 2)])
def test_jacobi_davidson_finds_the_largest(d, wanted, rank):
    g = np.random.default_rng(d)
    half = g.standard_normal((100, rank)) @ g.standard_normal((rank, d)) if rank < d else g.standard_normal((100, d))
    a, calls = half.T @ half, []

    def product(w):
        calls.append(w.shape[1])
        return a @ w

    values, found = whitening.jacobi_davidson(product, d, wanted)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:wanted], atol=1e-10 * max(1, np.abs(a).max()))
    assert np.abs(found.T @ found - np.eye(wanted)).max() < 1e-12 and len(calls) < 100
    assert np.abs(a @ found - found * values).max() <= 1e-12 * max(1, values[0])


def test_minres_solves_each_column():
    g = np.random.default_rng(1)
    a = g.standard_normal((12, 12))
    a = a + a.T
    b = np.c_[g.standard_normal((12, 3)), np.zeros(12)]
    x = whitening.minres(lambda v: a @ v, b, 40, 1e-13)
    assert np.abs(a @ x - b).max() < 1e-8 and not x[:, 3].any()
