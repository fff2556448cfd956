"""Whitening on the leading principal components, found by a Jacobi-Davidson iteration on distributed products.

1. One pass sums the whole components exactly, in integers. Rows are centred before anything is multiplied: the mean's
   whole part is taken off in integers and its fraction after it, so no digits are lost to a large mean.
2. The covariance is never formed: a product with a block of vectors W is one pass in which each task adds up
   C'(C W) for its centred rows C; only dimension x block numbers per task are shuffled and summed.
3. Rayleigh-Ritz on the search space gives candidates. Leading ones whose residual is at double precision are locked,
   and the rest of the space is kept orthogonal to them. For all others the correction equation
   (I - QQ')(V - t I)(I - QQ') z = -r, with Q the locked vectors and the candidate itself, is solved by a few steps of
   MINRES, one shared product a step. Corrections extend the space; a full space restarts from its best vectors.
4. Rows are projected, in one pass over the table; another sums the whitened covariance.

The driver holds matrices of the dimension by ``SUBSPACE`` vectors, whatever the number of rows.

Defined results: a null or non-finite component, or a null vector, takes a row out; ids may be null or repeat, every row
counts; vectors of different lengths are different spaces and are fitted apart, an empty vector has no component;
with fewer dimensions than ``components`` there are as many components as dimensions; a component without variance
(a constant table, a single row, fewer rows than components) has a null ``whitened`` and takes no part in
``identity_error``; without any variance ``explained`` is null; extra columns are not read; an empty table gives an empty
table. ``deviation`` is exact and a decimal, as it outgrows 64 bits near 10**6 rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinion_spark.llm.common import Scratch, table

COMPONENTS, SUBSPACE, BLOCK, INNER, OUTER = 8, 48, 24, 3, 60
#: A residual under this share of the largest eigenvalue is rounding; a spread under it is no variance.
PRECISION = 2.0 ** -46
SEED = 20250203


def whole_vectors(rows: DataFrame, scale: int, offset: int, key: str, vector: str) -> DataFrame:
    """``id, x``: components as floor(scale * c) + offset of the rows that take part."""
    c = F.col(vector)
    whole = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) != F.lit(float("inf"))))
    x = F.transform(c, lambda e: F.floor(e.cast("double") * F.lit(float(scale))).cast("long") + F.lit(offset))
    return rows.where(F.coalesce(whole, F.lit(False))).select(F.col(key).alias("id"), x.alias("x"))


def matrix(batch, name: str = "x"):
    """The rows of an Arrow batch's list column, all of one length."""
    flat = batch.column(batch.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def summed(rows: DataFrame, of: Callable) -> DataFrame:
    """The sums over all rows of the numbers that ``of(matrix)`` gives for a batch: one shuffle of their count a task."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total = None
        for b in batches:
            if b.num_rows:
                got = of(matrix(b))
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype="int32")), pa.array(total.ravel())], names=["at", "value"])

    return rows.select("x").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))


def column_sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """Row count and exact sum of each component."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        # halves of 32 bits, so that a batch's sums stay exact
        for b in batches:
            if b.num_rows:
                x = matrix(b)
                high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype="int32")), pa.array(high), pa.array(low), pa.array(np.full(d, b.num_rows))], names=["at", "high", "low", "n"])

    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    got = {r["at"]: r for r in rows.select("x").mapInArrow(run, "at int, high long, low long, n long").groupBy("at").agg(whole("high"), whole("low"), whole("n")).collect()}
    return int(got[0]["n"]), [(int(got[k]["high"]) << 32) + int(got[k]["low"]) for k in range(d)]


@dataclass
class Centre:
    """The mean as whole part and fraction, and with it the centred rows."""

    n: int
    sums: list[int]

    def __post_init__(self):
        import numpy as np

        self.whole = np.array([s // self.n for s in self.sums], "int64")
        self.fraction = np.array([(s % self.n) / self.n for s in self.sums])

    def __call__(self, x):
        return (x - self.whole).astype("float64") - self.fraction


def orthonormal(block, *against):
    """An orthonormal basis of ``block`` less what lies in ``against`` or depends on earlier columns (twice, against rounding)."""
    import numpy as np

    out = np.empty((block.shape[0], 0))
    for v in block.T:
        size = np.linalg.norm(v)
        for _ in range(2):
            for a in (*against, out):
                v = v - a @ (a.T @ v)
        left = np.linalg.norm(v)
        if left > 1e-10 * size and left > 0:
            v = v / left
            for a in (*against, out):
                v = v - a @ (a.T @ v)
            out = np.c_[out, v / np.linalg.norm(v)]
    return out


def minres(product: Callable, right, steps: int, enough: float):
    """Approximate solutions of symmetric systems, a column each, one call of ``product`` a step for all of them."""
    import numpy as np

    norm = lambda a: np.sqrt((a * a).sum(axis=0))
    size = norm(right)
    tiny = np.finfo(float).tiny
    solution, w, older_w = (np.zeros_like(right) for _ in range(3))
    before, now, beta, old_beta = np.zeros_like(right), right, size, np.ones_like(size)
    c, s, d_bar, epsilon, rest = -np.ones_like(size), np.zeros_like(size), np.zeros_like(size), np.zeros_like(size), size.copy()
    live = size > 0
    for _ in range(steps):
        if not live.any() or (rest[live] <= enough * size[live]).all():
            break
        v = now / np.where(live, beta, 1)
        y = product(v) - before * (beta / old_beta)
        alpha = (v * y).sum(axis=0)
        y = y - now * (alpha / np.where(live, beta, 1))
        before, now, old_beta, beta = now, y, np.where(live, beta, 1), norm(y)
        old_epsilon, delta, g_bar = epsilon, c * d_bar + s * alpha, s * d_bar - c * alpha
        epsilon, d_bar = s * beta, -c * beta
        gamma = np.maximum(np.hypot(g_bar, beta), tiny)
        c, s = g_bar / gamma, beta / gamma
        older_w, w = w, (v - older_w * old_epsilon - w * delta) / gamma
        solution = solution + np.where(live, c * rest, 0) * w
        rest = s * rest
        live &= beta > 1e-14 * size
    return solution


def jacobi_davidson(product: Callable, d: int, wanted: int, subspace: int = SUBSPACE, inner: int = INNER, outer: int = OUTER, block: int = BLOCK):
    """The ``wanted`` largest eigenvalues and unit eigenvectors of a symmetric matrix known by its ``product``.

    ``block``: candidates corrected at a time, more than wanted, as a product of many vectors is one pass all the same.
    """
    import numpy as np

    random = np.random.default_rng(SEED)
    wanted, block = min(d, wanted), min(d, max(block, wanted))
    locked, values = np.empty((d, 0)), np.empty(0)
    space = orthonormal(random.standard_normal((d, block)))
    image = product(space)
    scale = 0.0
    for turn in range(outer):
        small = space.T @ image
        theta, s = np.linalg.eigh((small + small.T) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        space, image = space @ s, image @ s
        scale = max(scale, abs(theta[0]), *np.abs(values[:1]))
        residual = image - space * theta
        residual -= locked @ (locked.T @ residual)
        size = np.sqrt((residual ** 2).sum(axis=0))
        done = 0
        while done < len(theta) and len(values) + done < wanted and size[done] <= PRECISION * scale:
            done += 1
        locked, values = np.c_[locked, space[:, :done]], np.r_[values, theta[:done]]
        space, image, theta, residual = space[:, done:], image[:, done:], theta[done:], residual[:, done:]
        if len(values) == wanted:
            return values, locked
        if space.shape[1] + block > max(subspace, 2 * block):
            space, image = space[:, :block], image[:, :block]
        u, t, r = space[:, :block], theta[:block], residual[:, :block]

        def off(z, u=u):
            z = z - locked @ (locked.T @ z)
            return z - u * (u * z).sum(axis=0)

        def shifted(z, t=t, off=off):
            z = off(z)
            return off(product(z) - z * t)

        new = orthonormal(minres(shifted, -off(r), inner, 2.0 ** -(turn + 1)), locked, space)
        if not new.shape[1]:  # an invariant space: whatever is left lies outside
            new = orthonormal(random.standard_normal((d, block)), locked, space)
        if not new.shape[1]:
            raise ArithmeticError("the search space is full and residuals are above double precision")
        space, image = np.c_[space, new], np.c_[image, product(new)]
    raise ArithmeticError("residuals did not reach double precision")


@dataclass
class Whitening:
    """A fitted space: ``values`` and ``vectors`` of its leading components, the trace, and the error of the whitened covariance."""

    centre: Centre
    values: list[float]
    vectors: object
    trace: float
    identity_error: float | None = None

    def shares(self) -> list:
        return [float(e) / self.trace if self.trace else None for e in self.values]

    def spread(self):
        """Which components have variance."""
        import numpy as np

        return np.asarray(self.values) > 2.0 ** -40 * max(self.values[0], 0) if len(self.values) else np.zeros(0, bool)

    def project(self, x):
        """Whitened coordinates of the components with variance."""
        import numpy as np

        some = self.spread()
        return (self.centre(x) @ self.vectors[:, some]) / np.sqrt(np.asarray(self.values)[some])

    def deviations(self, x):
        """Exact sums of (n x - S)**2 as Python's integers or a 64-bit array."""
        import numpy as np

        c = self.centre
        rest = np.array([s % c.n for s in c.sums], dtype=object)
        y = x - c.whole
        most = (int(np.abs(y).max(initial=0)) + 1) * c.n
        if x.shape[1] * most * most < 1 << 62:
            z = y * c.n - rest.astype("int64")
            return (z * z).sum(axis=1)
        z = y.astype(object) * c.n - rest
        return (z * z).sum(axis=1)


def fit(rows: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    """The leading components of ``x``, vectors of length ``d`` (one row at least)."""
    import numpy as np

    centre = Centre(*column_sums(rows, d))
    n = centre.n

    def total(of, size: int):
        out = np.zeros(size)
        for r in summed(rows, of).collect():  # as many numbers as ``of`` gives, whatever the rows
            out[r["at"]] = r["value"]
        return out

    def product(w):
        def part(x):
            c = centre(x)
            return c.T @ (c @ w)

        return total(part, w.size).reshape(w.shape) / n

    trace = float(total(lambda x: np.atleast_1d((centre(x) ** 2).sum()), 1)[0]) / n
    values, vectors = jacobi_davidson(product, d, components)
    model = Whitening(centre, [max(0.0, float(e)) for e in values], vectors, trace)
    k = int(model.spread().sum())
    if k:
        def moments(x):
            z = model.project(x)
            return np.r_[z.sum(axis=0), (z.T @ z).ravel()]

        got = total(moments, k + k * k) / n
        model.identity_error = float(np.abs(got[k:].reshape(k, k) - np.outer(got[:k], got[:k]) - np.eye(k)).max())
    return model


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error``: a row for each row and component."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        k, some, shares = len(model.values), model.spread(), model.shares()
        exact = pa.decimal128(38, 0)
        for b in batches:
            m = b.num_rows
            if not m:
                continue
            x = matrix(b)
            z = np.full((m, k), np.nan)
            z[:, some] = model.project(x)
            dev = model.deviations(x)
            dev = pa.array(dev).cast(exact) if dev.dtype == np.int64 else pa.array([int(v) for v in dev], exact)
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays([
                b.column(b.schema.get_field_index("id")).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype="int32"), m)), pa.array(np.full(m * k, model.centre.n)),
                dev.take(pa.array(each)), pa.array(z.ravel(), mask=np.tile(~some, m)), pa.array(shares * m, "float64"), pa.array([model.identity_error] * (m * k), "float64")],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``transform`` of every row of ``id, x``, each vector length in a space of its own."""
    base = Scratch(rows.sparkSession, "whitening").written(rows.select("id", "x"), "rows")
    lengths = sorted(r[0] for r in base.where(F.size("x") > 0).select(F.size("x")).distinct().collect())
    out = None
    for d in lengths:
        some = base.where(F.size("x") == d)
        one = transform(some, fit(some, d, components))
        out = one if out is None else out.unionByName(one)
    if out is None:
        none = lambda kind: F.lit(None).cast(kind)
        out = base.limit(0).select("id", none("int").alias("component"), none("long").alias("n"), none("decimal(38,0)").alias("deviation"),
                                   none("double").alias("whitened"), none("double").alias("explained"), none("double").alias("identity_error"))
    return out


def query(spark, sf_dir):
    """op11: the first eight whitened coordinates of every vector (``deviation`` beyond 64 bits: null; ``deviation_exact`` has it)."""
    out = whiten(whole_vectors(table(spark, sf_dir, "embeddings"), 1024, 100000, "vec_id", "embedding"))
    fits: Column = F.col("deviation").try_cast("long")
    return out.select(F.col("id").alias("vec_id"), "component", "n", fits.alias("deviation"), "whitened", "explained", "identity_error", F.col("deviation").cast("string").alias("deviation_exact"))
