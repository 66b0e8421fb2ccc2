"""Whitening of vectors on their leading principal components.

A vector's entries become whole numbers x = floor(scale * c) + shift.  The components are eigenvectors of the
covariance V of x, found by Chebyshev-filtered subspace iteration without forming V: a block Q of somewhat more columns
than are wanted goes through a polynomial in V, evaluated by its three-term recurrence, that damps the eigenvalues
below the block's own and so turns the block to the wanted ones; then QR and Rayleigh-Ritz in the block.  This repeats
until each wanted pair is certified by its residual |V q - e q|.  A product V Q is one Spark pass over the centred
rows, X' (X Q), summed in two steps; what travels is a matrix of dimension by block size, never rows.

The damped interval is [a, b]: b is the block's smallest Ritz value, a a safe lower bound of the spectrum from a short
Lanczos run (smallest Ritz value less the residual's norm).  A block that the certificate isn't reached with in ROUNDS
rounds (eigenvalues too close at its edge) is doubled, at last to the whole space, so the iteration ends on any input.

Edge cases: vectors that are null, empty, hold null or non-finite entries, or entries beyond 2**39, are left out, and
so are vectors of another length than the most frequent (of equally frequent ones the longest).  Null and repeated ids
are kept.  Components whose variance is nought (below 1e-12 of the largest) can't be scaled and are left out: a table
of one vector, or of equal ones, gives no rows, like an empty table.  Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from constella.llm.common import cut

ROWS, DEGREE, ROUNDS, LANCZOS, SEED = 1024, 16, 6, 8, 11
TINY = 1e-12


def _usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    entries = F.col(vector).cast("array<double>")
    sound = F.forall(entries, lambda c: F.coalesce(F.abs(c) <= float(2**39), F.lit(False)))     # not for NaN: it's largest
    return df.select(F.col(key).cast("bigint").alias("key"), entries.alias("v")).filter(
        F.col("v").isNotNull() & (F.size("v") > 0) & sound)


def _blocks(scale: int, shift: int):
    """Up to ROWS vectors a row: their keys, their whole numbers, column sums."""
    schema = pa.schema([("keys", pa.list_(pa.int64())), ("x", pa.binary()), ("sums", pa.list_(pa.int64()))])

    def pack(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                values = part["v"].flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                x = np.floor(scale * values).astype(np.int64) + shift
                yield pa.record_batch([pa.array([part["key"].to_pylist()], schema.types[0]), pa.array([x.tobytes()]),
                                       pa.array([x.sum(axis=0).tolist()], schema.types[2])], schema=schema)

    return pack


class Centred:
    """The fit list as blocks in the shared folder, and passes over it."""

    def __init__(self, df: DataFrame, key: str, vector: str, scale: int, shift: int):
        usable = _usable(df, key, vector)
        lengths = usable.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
        self.d = lengths["d"] if lengths else 0
        self.blocks = cut(usable.filter(F.size("v") == self.d).mapInArrow(
            _blocks(scale, shift), "keys array<bigint>, x binary, sums array<bigint>"), name="vectors")
        self.n = self.blocks.agg(F.coalesce(F.sum(F.size("keys")), F.lit(0)).cast("bigint")).first()[0]
        sums = self.blocks.select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(
            F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()      # a row a dimension
        self.sums = [int(r["s"]) for r in sorted(sums, key=lambda r: r["i"])]
        self.tasks = max(1, math.isqrt(self.blocks.rdd.getNumPartitions()))

    def centre(self):
        """A block's rows less the mean: n * x - S is a whole number, rounded once by the division."""
        n, d, sums = self.n, self.d, self.sums
        small = n < 2**17       # then n * x stays below 2**63: entries stay below 2**45

        def rows(data: bytes) -> np.ndarray:
            x = np.frombuffer(data, np.int64).reshape(-1, d)
            if small:
                return (n * x - np.array(sums, np.int64)) / n
            whole = np.array([s // n for s in sums])
            rest = np.array([s % n / n for s in sums])
            return (x - whole) - rest

        return rows

    def total(self, of, shape: tuple[int, ...]) -> np.ndarray:
        """Sum of ``of(block)`` over all blocks.  Every task adds up its own, a few tasks (the root of their number)
        what those hold, and the driver as many matrices as those."""
        def add(items):
            out = np.zeros(shape)
            for item in items:
                out += item
            yield pa.record_batch([pa.array([out.tobytes()])], names=["m"])

        def first(batches):
            yield from add(of(x) for b in batches for x in b["x"].to_pylist())

        def second(batches):
            yield from add(np.frombuffer(m).reshape(shape) for b in batches for m in b["m"].to_pylist())

        parts = self.blocks.select("x").mapInArrow(first, "m binary").repartition(self.tasks).mapInArrow(second, "m binary")
        return sum((np.frombuffer(r["m"]).reshape(shape) for r in parts.collect()), np.zeros(shape))

    def product(self, q: np.ndarray) -> np.ndarray:
        """V q."""
        rows = self.centre()

        def of(data):
            y = rows(data)
            return y.T @ (y @ q)

        return self.total(of, q.shape) / self.n

    def trace(self) -> float:
        rows = self.centre()
        return float(self.total(lambda data: np.array([np.square(rows(data)).sum()]), (1,))[0]) / self.n


def lower_bound(product, d: int, rng: np.random.Generator, steps: int = LANCZOS) -> float:
    """A lower bound of a positive semidefinite matrix's spectrum after a few Lanczos steps."""
    q, before, basis, alphas, betas = rng.standard_normal(d), np.zeros(d), [], [], []
    q /= np.linalg.norm(q)
    for _ in range(min(steps, d)):
        basis.append(q)
        w = product(q[:, None])[:, 0] - (betas[-1] * before if betas else 0)
        alphas.append(float(w @ q))
        w -= alphas[-1] * q
        for b in basis:     # full reorthogonalisation
            w -= (w @ b) * b
        betas.append(float(np.linalg.norm(w)))
        if betas[-1] <= TINY * max(map(abs, alphas)):
            break
        before, q = q, w / betas[-1]
    ritz = np.linalg.eigvalsh(np.diag(alphas) + np.diag(betas[:-1], 1) + np.diag(betas[:-1], -1))
    return max(0.0, float(ritz[0]) - betas[-1])


def chebyshev(product, q: np.ndarray, low: float, high: float, top: float, degree: int = DEGREE) -> np.ndarray:
    """A Chebyshev polynomial of V applied to ``q``: small on [low, high], growing above it, scaled to 1 at ``top``."""
    half, middle = (high - low) / 2, (high + low) / 2
    sigma = half / (top - middle)
    tau, y = 2 / sigma, (product(q) - middle * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (tau - sigma)
        q, y = y, 2 * after / half * (product(y) - middle * y) - sigma * after * q
        sigma = after
    return y


def leading(product, d: int, k: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues, eigenvectors (columns) and residuals of the ``k`` largest of a matrix given by its products."""
    rng = np.random.default_rng(seed)
    k, width = min(k, d), min(d, k + max(8, k // 4))
    low = lower_bound(product, d, rng)

    def ritz(q):
        q, _ = np.linalg.qr(q)
        vq = product(q)
        small = q.T @ vq
        e, u = np.linalg.eigh((small + small.T) / 2)
        e, u = e[::-1], u[:, ::-1]
        q, vq = q @ u, vq @ u
        return e, q, np.linalg.norm(vq[:, :k] - q[:, :k] * e[:k], axis=0)

    e, q, residual = ritz(rng.standard_normal((d, width)))
    best, rounds = math.inf, 0
    while width < d:
        worst = float(residual.max())
        # certified: at the rounding of a product, or within a hundred times of it and no longer falling
        if worst <= 1e-14 * e[0] or (worst <= 1e-12 * e[0] and worst > best / 2):
            return e[:k], q[:, :k], residual
        best, rounds = min(best, worst), rounds + 1
        high = float(e[-1])
        if rounds % ROUNDS == 0 or not e[0] > high > low:
            width = min(d, 2 * width)
            q = np.hstack([q, rng.standard_normal((d, width - q.shape[1]))])
        else:
            q = chebyshev(product, q, low, high, float(e[0]))
        e, q, residual = ritz(q)
    return e[:k], q[:, :k], residual


def whiten(df: DataFrame, components: int = 32, key: str = "vec_id", vector: str = "embedding", scale: int = 64,
           shift: int = 1_000_000) -> DataFrame:
    """``key``, component (from 1), n, deviation (sum of (n * x - S)**2, decimal), whitened, explained, identity_error
    and residual (of the component's pair, over the largest eigenvalue) of every usable vector."""
    fit = Centred(df, key, vector, scale, shift)
    rows, n, d, sums = fit.centre(), fit.n, fit.d, fit.sums
    trace = fit.trace() if n else 0.0
    e, q, residual = leading(fit.product, d, components) if trace > 0 else (np.zeros(0), np.zeros((d, 0)), np.zeros(0))
    held = int((e > TINY * e[0]).sum()) if len(e) else 0
    e, q, residual = e[:held], q[:, :held], residual[:held]
    axes = q / np.sqrt(e)
    error = 0.0
    if held:
        mean = fit.total(lambda data: (rows(data) @ axes).sum(axis=0), (held,)) / n

        def spread(data):
            z = rows(data) @ axes - mean
            return z.T @ z

        error = float(np.abs(fit.total(spread, (held, held)) / n - np.eye(held)).max())

    wrapped = np.array([(v + 2**63) % 2**64 - 2**63 for v in sums], np.int64)

    def project(batches):
        for batch in batches:
            for keys, data in zip(batch["keys"].to_pylist(), batch["x"].to_pylist()):
                x = np.frombuffer(data, np.int64).reshape(-1, d)
                far = max(max(abs(int(n * int(v) - s)) for v, s in zip(ends, sums)) for ends in (x.min(axis=0), x.max(axis=0)))
                if far * far * d < 2**63:
                    deviation = np.square(n * x - wrapped).sum(axis=1).astype(str)     # exact: differences are small
                else:
                    deviation = [str(sum((n * v - s) ** 2 for v, s in zip(row, sums))) for row in x.tolist()]
                z = rows(data) @ axes
                yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(list(deviation), pa.string()),
                                       pa.array(list(z), pa.list_(pa.float64()))], names=["key", "deviation", "z"])

    found = fit.blocks.select("keys", "x").mapInArrow(project, "key bigint, deviation string, z array<double>")
    about = F.array(*[F.struct(F.lit(float(a / trace)).alias("explained"), F.lit(float(r / e[0])).alias("residual"))
                      for a, r in zip(e, residual)]) if held else F.array().cast("array<struct<explained:double,residual:double>>")
    found = found.select("key", "deviation", F.posexplode(F.arrays_zip(F.col("z"), about.alias("about"))).alias("c", "s"))
    return found.select(F.col("key").alias(key), (F.col("c") + 1).cast("int").alias("component"),
                        F.lit(n).cast("bigint").alias("n"), F.col("deviation").cast("decimal(38,0)").alias("deviation"),
                        F.col("s.z").alias("whitened"), F.col("s.about.explained").alias("explained"),
                        F.lit(error).alias("identity_error"), F.col("s.about.residual").alias("residual"))
