"""Singular values and right singular vectors of a triangular factor through its bidiagonal form.

Householder reflections make it bidiagonal, differential qd transforms with shifts (dqds) find
the squares of its singular values, and twisted factorisations give one vector for each. The
matrix is of the dimension of the data, however many rows went into it.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
_ROUNDS = 200  # sweeps for one value; a handful is usual


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, superdiagonal and the right reflectors (unit vectors or zeros, the k-th of
    entries k + 1 and on) of a square matrix."""
    a = np.array(r, float)
    n = len(a)
    right = []
    for k in range(n):
        v = _reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        v = _reflector(a[k, k + 1 :]) if k + 2 < n else np.zeros(max(n - k - 1, 0))
        a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
        right.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _reflector(x: np.ndarray) -> np.ndarray:
    """v of the reflection I - 2vv' that leaves only the first entry of x; 0 if it is so."""
    v = np.array(x, float)
    norm = np.linalg.norm(v)
    if norm == 0 or not v[1:].any():
        return np.zeros_like(v)
    v = v / norm
    v[0] += np.copysign(1.0, v[0])
    return v / np.linalg.norm(v)


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]] | None:
    """One dqds transform: new q and e, and the d of every place; None if one is negative."""
    d = q[0] - shift
    new_q, new_e, ds = [], [], [d]
    for k, ek in enumerate(e):
        if d < 0:
            return None
        qk = d + ek
        t = q[k + 1] / qk if qk > 0 else 0.0
        new_q.append(qk)
        new_e.append(ek * t)
        # Without anything in this place, the next one stands alone.
        d = (d * t if qk > 0 else q[k + 1]) - shift
        ds.append(d)
    if d < 0:
        return None
    return [*new_q, d], new_e, ds


def squared_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, falling.

    A sweep without shift gives the diagonal of the inverse; one over its trace is below the
    least value and is the next shift. Places where the superdiagonal is negligible cut the
    matrix in two.
    """
    scale = max([*np.abs(diagonal), *np.abs(above), 0.0])
    if scale == 0:
        return np.zeros(len(diagonal))
    q0 = [float(x / scale) ** 2 for x in diagonal]
    e0 = [float(x / scale) ** 2 for x in above]
    out: list[float] = []
    blocks = [(q0, e0, 0.0, 0)]
    while blocks:
        q, e, shift, rounds = blocks.pop()
        if len(q) == 1:
            out.append(q[0] + shift)
            continue
        cut = next(
            (k for k in range(len(e) - 1, -1, -1) if e[k] <= EPS**2 * (shift + min(q[k], q[k + 1]))),
            None,
        )
        if cut is not None or rounds > _ROUNDS * len(q):
            cut = len(e) - 1 if cut is None else cut
            blocks.append((q[: cut + 1], e[:cut], shift, 0))
            blocks.append((q[cut + 1 :], e[cut + 1 :], shift, 0))
            continue
        if q[0] < q[-1]:
            q, e = q[::-1], e[::-1]
        q, e, d = _sweep(q, e, 0.0)
        least = 0.0 if min(d) <= 0 else 1 / sum(1 / x for x in d)
        moved = None
        while least > 0 and moved is None:
            least *= 1 - 8 * EPS * len(q)
            moved = _sweep(q, e, least)
            if moved is None:
                least = least / 2 if least > EPS * (shift + min(d)) else 0.0
        if moved is not None:
            q, e, shift = moved[0], moved[1], shift + least
        blocks.append((q, e, shift, rounds + 1))
    return np.sort(np.array(out))[::-1] * scale**2


def _away(x: float, tiny: float) -> float:
    return x if abs(x) > tiny else (-tiny if x <= 0 else tiny)


def twisted_vector(diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """Unit vector of B'B for an eigenvalue: the factorisations from the top and from the
    bottom meet where the twist is least."""
    n = len(diagonal)
    tiny = EPS**2 * max(value, float(np.max(diagonal**2, initial=0)), 1e-290)
    a2, b2, ab = diagonal**2, above**2, diagonal[:-1] * above
    s, p = np.empty(n), np.empty(n)
    down, up = np.empty(n - 1), np.empty(n - 1)
    s[0], p[n - 1] = -value, a2[n - 1] - value
    for k in range(n - 1):
        pivot = _away(s[k] + a2[k], tiny)
        down[k] = ab[k] / pivot
        s[k + 1] = s[k] * b2[k] / pivot - value
    for k in range(n - 2, -1, -1):
        pivot = _away(b2[k] + p[k + 1], tiny)
        up[k] = ab[k] / pivot
        p[k] = p[k + 1] * a2[k] / pivot - value
    twist = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[twist] = 1.0
    for k in range(twist - 1, -1, -1):
        z[k] = -down[k] * z[k + 1]
    for k in range(twist, n - 1):
        z[k + 1] = -up[k] * z[k]
    return z / np.linalg.norm(z)


def _solve(diagonal: np.ndarray, above: np.ndarray, value: float, y: np.ndarray) -> np.ndarray:
    """(B'B - value) x = y by the factorisation from the top."""
    n = len(diagonal)
    a2, b2, ab = diagonal**2, above**2, diagonal[:-1] * above
    tiny = EPS * max(value, float(np.max(a2, initial=0)), 1e-290)
    pivots, low, s = np.empty(n), np.empty(n - 1), -value
    for k in range(n):
        pivots[k] = _away(s + a2[k], tiny)
        if k + 1 < n:
            low[k] = ab[k] / pivots[k]
            s = s * b2[k] / pivots[k] - value
    x = np.array(y, float)
    for k in range(1, n):
        x[k] -= low[k - 1] * x[k - 1]
    x /= pivots
    for k in range(n - 2, -1, -1):
        x[k] -= low[k] * x[k + 1]
    return x


def right_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal right singular vectors of a bidiagonal matrix, as columns, for squared
    values in falling order. Within a cluster of values each vector is made orthogonal to the
    ones before it; where nothing is left of it, inverse iteration starts anew."""
    n = len(diagonal)
    out = np.zeros((n, len(values)))
    for k, value in enumerate(values):
        z = twisted_vector(diagonal, above, float(value))
        near = [j for j in range(k) if values[j] - value <= 1e-3 * values[0]]
        before = out[:, near]
        rest = _apart(z, before)
        random = np.random.default_rng(k)
        for _ in range(10):
            if np.linalg.norm(rest) > 0.5:
                break
            z = _apart(random.standard_normal(n), before)
            for _ in range(3):
                z = _solve(diagonal, above, float(value), z / np.linalg.norm(z))
                z = _apart(z / np.linalg.norm(z), before)
            rest = z / np.linalg.norm(z)
        out[:, k] = _apart(rest / np.linalg.norm(rest), before)
        out[:, k] /= np.linalg.norm(out[:, k])
    return out


def _apart(z: np.ndarray, before: np.ndarray) -> np.ndarray:
    for _ in range(2):
        z = z - before @ (before.T @ z)
    return z


def leading(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Of r'r: the ``most`` largest eigenvalues above rounding, falling, their unit vectors as
    columns (largest entry positive), and the trace."""
    n = len(r)
    trace = float(np.sum(np.asarray(r, float) ** 2))
    scale = float(np.max(np.abs(r), initial=0))
    if scale == 0:
        return np.zeros(0), np.zeros((n, 0)), trace
    diagonal, above, right = bidiagonalise(np.asarray(r, float) / scale)
    values = squared_values(diagonal, above)
    values = values[: min(most, int(np.sum(values > values[0] * (n * EPS) ** 2)))]
    vectors = right_vectors(diagonal, above, values)
    for k in range(n - 1, -1, -1):
        v = right[k]
        vectors[k + 1 :] -= 2 * np.outer(v, v @ vectors[k + 1 :])
    signs = np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(len(values))])
    return values * scale**2, vectors * np.where(signs == 0, 1, signs), trace
