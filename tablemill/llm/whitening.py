r"""Whitening of embeddings along their strongest directions, from a blockwise QR.

Vectors become whole numbers, and each distinct one counts once. Count and sums are exact, so every
block is centred before anything is multiplied. A task reduces its centred rows block by block to an
upper triangle R (the QR of the last R stacked on the next block); the triangles of the tasks are
stacked and reduced again in rounds, ``FAN`` at a time, until one is left. Covariances are never
formed: R holds the same singular values at twice the digits.

On the driver R, as large as the square of the vector length, becomes bidiagonal by Householder
reflections. Differential quotient-difference steps with shifts (dqds) find all its singular values
accurately, down to the smallest. A twisted factorisation at a singular value gives its vector of the
bidiagonal matrix, and the right reflections turn that into a direction of the vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemill.session import staged
from tablemill.spec import col

SCALE = 256.0
COMPONENTS = 4
# Rows that a task holds at once, by the numbers in them.
BLOCK_NUMBERS = 1 << 20
FAN = 16
EPS = np.finfo(float).eps
WHOLE = (-(2.0**63), np.nextafter(2.0**63, 0))


# The solver, on the driver


def householder(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Unit ``v`` and ``alpha`` with (I - 2 v v') x = alpha e1."""
    norm = float(np.linalg.norm(x))
    alpha = -math.copysign(norm, x[0])
    v = x.copy()
    v[0] -= alpha
    size = float(np.linalg.norm(v))
    return (v / size if size else v), alpha


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, superdiagonal, and the right reflections of a square matrix."""
    a = r.astype(float).copy()
    n = len(a)
    diagonal, above, right = np.zeros(n), np.zeros(max(n - 1, 0)), []
    for k in range(n):
        v, diagonal[k] = householder(a[k:, k])
        a[k:, k + 1 :] -= 2.0 * np.outer(v, v @ a[k:, k + 1 :])
        if k < n - 1:
            w, above[k] = householder(a[k, k + 1 :])
            a[k + 1 :, k + 1 :] -= 2.0 * np.outer(a[k + 1 :, k + 1 :] @ w, w)
            right.append(w)
    return diagonal, above, right


def dqds_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One differential step; None where the shift was too large. The last value is the
    smallest intermediate, a bound from above on what is left of the smallest root."""
    d = least = q[0] - shift
    if d < 0:
        return None
    new_q, new_e = [], []
    for i in range(len(e)):
        total = d + e[i]
        if total <= 0:
            return None
        new_q.append(total)
        ratio = q[i + 1] / total
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
        if d < 0 or math.isnan(d):
            return None
        least = min(least, d)
    return new_q + [d], new_e, least


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling."""
    found: list[float] = []
    work = [([float(x) * float(x) for x in diagonal], [float(x) * float(x) for x in above], 0.0)]
    while work:
        q, e, sigma = work.pop()
        guess, rounds = 0.0, 0
        while q:
            rounds += 1
            if rounds > 200 * (len(q) + 10):
                raise ArithmeticError("singular values did not converge")
            # A zero on the diagonal is a root; a step without shift moves it to the end.
            small = [i for i, x in enumerate(e) if x <= EPS * EPS * (sigma + min(q[i], q[i + 1])) or x < 1e-290]
            if small:
                cut = small[-1]
                tail = (q[cut + 1 :], e[cut + 1 :], sigma)
                q, e, guess = q[: cut + 1], e[:cut], 0.0
                if len(tail[0]) == 1:
                    found.append(tail[0][0] + sigma)
                else:
                    work.append(tail)
                continue
            if len(q) == 1:
                found.append(q[0] + sigma)
                break
            if q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            if min(q) == 0.0:
                guess = 0.0
            step = None
            while step is None:
                step = dqds_step(q, e, guess)
                if step is None:
                    if guess == 0.0:
                        # A zero inside: rounded up to what squaring cannot tell from it.
                        tiny = max(max(q) * 1e-300, 1e-280)
                        q, e = [max(x, tiny) for x in q], [max(x, tiny) for x in e]
                    guess = guess / 4.0 if guess > EPS * sigma else 0.0
            (q, e, least), sigma = step, sigma + guess
            # What the next step may take: less than the bound, by what the last corner says.
            corner = e[-1] if e else 0.0
            guess = max(0.0, least - math.sqrt(corner * max(least, 0.0)) - corner) * (1.0 - 4.0 * EPS)
    return np.array(sorted(found, reverse=True))


def twisted_vector(diagonal: np.ndarray, above: np.ndarray, root: float, known: list[np.ndarray]) -> np.ndarray:
    """Unit right vector of the bidiagonal matrix at the squared singular value ``root``.

    Top-down and bottom-up factorisations of B'B - root meet at the place where the twist
    is smallest; the vector is read off both ways from there. Vectors already ``known``
    are taken out, for roots that agree to all digits the next best twist serves.
    """
    n = len(diagonal)
    scale = max(float(np.abs(diagonal).max()), float(np.abs(above).max()) if n > 1 else 0.0)
    floor = (EPS * scale) ** 2 or 1e-300
    a = np.where(np.abs(diagonal) < EPS * scale, EPS * scale, diagonal)
    d, low = a * a, above / a[:-1]
    guarded = lambda x: x if abs(x) > floor * EPS else math.copysign(floor * EPS, x or 1.0)
    s, down = np.zeros(n), np.zeros(max(n - 1, 0))
    s[0] = -root
    for i in range(n - 1):
        plus = guarded(s[i] + d[i])
        down[i] = d[i] * low[i] / plus
        s[i + 1] = down[i] * low[i] * s[i] - root
    p, up = np.zeros(n), np.zeros(max(n - 1, 0))
    p[n - 1] = d[n - 1] - root
    for i in range(n - 2, -1, -1):
        minus = guarded(d[i] * low[i] * low[i] + p[i + 1])
        ratio = d[i] / minus
        up[i] = low[i] * ratio
        p[i] = p[i + 1] * ratio - root
    order = np.argsort(np.abs(s + p + root), kind="stable")
    best = None
    for twist in order[: len(known) + 1]:
        z = np.zeros(n)
        z[twist] = 1.0
        for i in range(twist - 1, -1, -1):
            z[i] = -down[i] * z[i + 1]
        for i in range(twist, n - 1):
            z[i + 1] = -up[i] * z[i]
        z /= np.abs(z).max()
        z /= np.linalg.norm(z)
        whole = z.copy()
        for _ in range(2):
            for other in known:
                z -= (other @ z) * other
        left = float(np.linalg.norm(z))
        if best is None or left > best[0]:
            best = (left, z / left if left > 1e-8 else whole)
        if left > 0.5:
            break
    return best[1]


def directions(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of a square matrix, falling, and the first ``count`` right
    singular vectors as columns; the largest entry of each is positive."""
    # Scaled by a power of two, so that squares neither overflow nor vanish.
    largest = float(np.abs(r).max()) if r.size else 0.0
    if largest == 0.0:
        return np.zeros(len(r)), np.eye(len(r))[:, :count]
    exponent = math.frexp(largest)[1]
    a, b, right = bidiagonal(np.ldexp(r, -exponent))
    roots = dqds(a, b)
    vectors: list[np.ndarray] = []
    for root in roots[:count]:
        vectors.append(twisted_vector(a, b, float(root), vectors))
    out = []
    for z in vectors:
        v = z.copy()
        for k in range(len(right) - 1, -1, -1):
            w = right[k]
            v[k + 1 :] -= 2.0 * (w @ v[k + 1 :]) * w
        out.append(v * math.copysign(1.0, v[np.argmax(np.abs(v))]))
    return np.ldexp(roots, 2 * exponent), np.stack(out, 1)


# Rows, in tasks


def usable(vector: Column) -> Column:
    """True where a vector is there and all its entries are finite."""
    fine = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf))
    return vector.isNotNull() & F.coalesce(F.forall(vector, fine), F.lit(False))


def whole_numbers(vectors: pa.Array, d: int) -> np.ndarray:
    """Rows of floor(256 c), with zeros behind vectors shorter than ``d``. Entries beyond
    64 bits take the nearest end of their range."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64)
    x = np.clip(np.floor(SCALE * flat), *WHOLE).astype(np.int64)
    sizes = np.asarray(vectors.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    if (sizes == d).all():
        return x.reshape(len(vectors), d)
    rows = np.zeros((len(vectors), d), np.int64)
    rows[np.arange(d) < sizes[:, None]] = x
    return rows


def pack(x: np.ndarray) -> list[bytes]:
    """Each row in the narrowest whole numbers that hold it: equal rows, equal bytes."""
    out: list[bytes | None] = [None] * len(x)
    top = np.maximum(x.max(1, initial=0), -1 - x.min(1, initial=0))
    below = -1
    for kind in (np.int8, np.int16, np.int32, np.int64):
        limit = np.iinfo(kind).max
        for i in np.flatnonzero((top > below) & (top <= limit)):
            out[i] = x[i].astype(kind).tobytes()
        below = limit
    return out


def unpack(rows: list[bytes], d: int) -> np.ndarray:
    kinds = {d: np.int8, 2 * d: np.int16, 4 * d: np.int32, 8 * d: np.int64}
    out = np.empty((len(rows), d), np.int64)
    sizes = np.array([len(r) for r in rows])
    for size, kind in kinds.items():
        at = np.flatnonzero(sizes == size)
        if len(at):
            out[at] = np.frombuffer(b"".join(rows[i] for i in at), kind).reshape(len(at), d)
    return out


def blocks(batch: pa.RecordBatch, d: int):
    """Slices of a batch of bounded size."""
    step = max(1, BLOCK_NUMBERS // max(d, 1))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def distinct_rows(df: DataFrame, vector: str, d: int) -> DataFrame:
    """The distinct whole-number vectors, packed (``x``)."""

    def run(batches):
        for batch in batches:
            for part in blocks(batch, d):
                rows = list(dict.fromkeys(pack(whole_numbers(part.column(0), d))))
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["x"])

    return df.select(col(vector)).mapInArrow(run, "x binary").distinct()


def exact_sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number and sum of the rows. What reaches the driver is one row per dimension."""

    def run(batches):
        n, total = 0, [0] * d
        for batch in batches:
            for part in blocks(batch, d):
                x = unpack(part.column(0).to_pylist(), d)
                n += len(x)
                # Halves of 32 bits: no sum of a block leaves 64.
                high, low = (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)
                total = [t + (int(h) << 32) + int(w) for t, h, w in zip(total, high, low)]
        values = [n, *total]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(-1, d), pa.int32()),
                pa.array([v >> 32 for v in values], pa.int64()),
                pa.array([v & 0xFFFFFFFF for v in values], pa.int64()),
            ],
            names=["dim", "high", "low"],
        )

    each = rows.mapInArrow(run, "dim int, high long, low long").groupBy("dim").agg(
        F.sum(F.col("high").cast("decimal(20,0)")).alias("high"), F.sum(F.col("low").cast("decimal(20,0)")).alias("low")
    )
    total = {r["dim"]: (int(r["high"]) << 32) + int(r["low"]) for r in each.collect()}
    return total.get(-1, 0), [total.get(i, 0) for i in range(d)]


def differences(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S without rounding: in 64 bits where that holds it, else in Python's numbers."""
    top = max(int(x.max(initial=0)), -int(x.min(initial=0))) * n + max((abs(s) for s in sums), default=0)
    if top < 1 << 63:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return differences(x, n, sums).astype(np.float64) / n


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of squares; null where 64 bits do not hold one."""
    y = differences(x, n, sums)
    if y.dtype != object:
        top = max(int(y.max(initial=0)), -int(y.min(initial=0)))
        if top * top * max(y.shape[1], 1) < 1 << 63:
            return (y * y).sum(1).tolist()
        y = y.astype(object)
    return [v if v < 1 << 63 else None for v in (sum(int(c) * int(c) for c in row) for row in y)]


def triangle(stacked: np.ndarray) -> np.ndarray:
    return np.linalg.qr(stacked, mode="r")


def reduced(rows: DataFrame, d: int, n: int, sums: list[int]) -> np.ndarray:
    """The triangle of all centred rows."""
    schema = "task long, r binary"

    def of_task(batches):
        from pyspark import TaskContext

        r = np.zeros((0, d))
        for batch in batches:
            for part in blocks(batch, d):
                r = triangle(np.vstack([r, centred(unpack(part.column(0).to_pylist(), d), n, sums)]))
        if len(r):
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([task], pa.int64()), pa.array([r.tobytes()], pa.binary())], names=["task", "r"])

    def of_tasks(table: pa.Table) -> pa.Table:
        r = np.zeros((0, d))
        order = np.argsort(table.column("task").to_numpy())
        for part in table.column("r").take(pa.array(order)).to_pylist():
            r = triangle(np.vstack([r, np.frombuffer(part).reshape(-1, d)]))
        return pa.table({"task": pa.array([table.column("group")[0].as_py()], pa.int64()), "r": pa.array([r.tobytes()], pa.binary())})

    parts = staged(rows.mapInArrow(of_task, schema), "triangles")
    left = parts.count()
    while left > FAN:
        grouped = parts.withColumn("group", F.expr(f"task div {FAN}"))
        parts = staged(grouped.groupBy("group").applyInArrow(of_tasks, schema), "triangles")
        left = parts.count()
    # At most ``FAN`` triangles of d by d numbers reach the driver.
    r = np.zeros((0, d))
    for row in parts.orderBy("task").collect():
        r = triangle(np.vstack([r, np.frombuffer(row["r"]).reshape(-1, d)]))
    return np.vstack([r, np.zeros((max(d - len(r), 0), d))])[:d]


def gram_error(rows: DataFrame, d: int, n: int, sums: list[int], weights: np.ndarray) -> float:
    """Largest entry of the covariance of the whitened rows minus the identity."""
    k = weights.shape[1]
    if not k:
        return 0.0

    def run(batches):
        gram = np.zeros((k, k))
        for batch in batches:
            for part in blocks(batch, d):
                y = centred(unpack(part.column(0).to_pylist(), d), n, sums) @ weights
                gram += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(k * k), pa.int32()), pa.array(gram.ravel())], names=["at", "v"])

    gram = np.zeros(k * k)
    for row in rows.mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
        gram[row["at"]] = row["v"]
    return float(np.abs(gram.reshape(k, k) / n - np.eye(k)).max())


def whiten(
    df: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """Per usable row and component: id, ``component`` from 1, ``n``, ``deviation``,
    ``whitened``, ``explained``, ``identity_error``.

    Vectors that are null or hold null or non-finite entries are left out. Vectors shorter
    than the longest usable one read as if zeros followed; there are at most as many
    components as dimensions, so empty vectors give no rows. Rows that repeat an id or a
    vector each get their rows, null ids too. A direction without variance (one vector,
    equal vectors, fewer vectors than components) has ``whitened`` null and ``explained``
    0; the identity error is that of the others. Equal eigenvalues share their space: any
    basis of it is right, the one found is used for all rows. An empty table gives an empty
    result. Other columns are not read.

    The driver holds FAN + 1 matrices of the squared vector length.
    """
    schema = (
        df.select(col(id_column)).schema.add("component", "integer").add("n", "long").add("deviation", "long")
        .add("whitened", "double").add("explained", "double").add("identity_error", "double")
    )
    good = df.select(col(id_column), col(vector_column)).where(usable(col(vector_column)))
    d = good.agg(F.max(F.size(col(vector_column))).alias("d")).first()["d"] or 0
    if not d:
        return df.sparkSession.createDataFrame([], schema)
    rows = staged(distinct_rows(good, vector_column, d), "vectors")
    n, sums = exact_sums(rows, d)
    roots, vectors = directions(reduced(rows, d, n, sums), min(components, d))
    trace = math.fsum(roots)
    # Below this a singular value is what rounding left of zero.
    live = [i for i in range(vectors.shape[1]) if roots[i] > trace * (d * EPS) ** 2]
    weights = np.stack([vectors[:, i] / math.sqrt(roots[i] / n) for i in live], 1) if live else np.zeros((d, 0))
    error = gram_error(rows, d, n, sums, weights)
    explained = [float(roots[i] / trace) if i in live else 0.0 for i in range(vectors.shape[1])]
    count = len(explained)

    def run(batches):
        for batch in batches:
            for part in blocks(batch, max(d, 8)):
                x = whole_numbers(part.column(1), d)
                projected = np.full((len(x), count), np.nan)
                projected[:, live] = centred(x, n, sums) @ weights
                each = np.repeat(np.arange(len(x)), count)
                white = projected.ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(each), n, np.int64)),
                        pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(each)),
                        pa.array(white, mask=np.isnan(white)),
                        pa.array(np.tile(np.array(explained), len(x))),
                        pa.array(np.full(len(each), error)),
                    ],
                    names=schema.names,
                )

    return good.mapInArrow(run, schema)
