"""Singular values and right singular vectors of a small square matrix, to high relative accuracy.

Householder reflections bring it to bidiagonal form. The differential qd algorithm with shifts (dqds)
finds the singular values from the squared entries, without subtractions other than the shift, so small
ones are as accurate as large ones. Twisted factorisations of the tridiagonal product give the vectors:
the stationary transform from the top and the progressive one from the bottom meet where the residual
is least. Values that are close to each other get their vectors by repeated solves against those that
are done. The matrix is no larger than the dimension of a vector, whatever the number of rows.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
# Relative distance below which neighbouring squared values count as close.
CLOSE = 1e-3
_LARGE = 1e100


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of U' A V, and V."""
    a, n = np.array(matrix, dtype=float), len(matrix)
    right = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        largest = np.abs(x).max(initial=0.0)
        if len(x) < 2 or largest == 0:
            return None
        v = x / largest
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        return v / np.linalg.norm(v)

    for k in range(n):
        v = reflector(a[k:, k].copy())
        if v is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        v = reflector(a[k, k + 1 :].copy())
        if v is not None:
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
            right[:, k + 1 :] -= 2 * np.outer(right[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _sweep(q: list, e: list, shift: float) -> tuple[list, list, float] | None:
    """One dqds transform, or None if the shift is above the least value."""
    n, d = len(q), q[0] - shift
    if d < 0:
        return None
    least, new_q, new_e = d, [0.0] * n, [0.0] * (n - 1)
    for k in range(n - 1):
        new_q[k] = d + e[k]
        if new_q[k] == 0:
            # Nothing couples this value to the rest.
            new_e[k], d = 0.0, q[k + 1] - shift
        else:
            ratio = q[k + 1] / new_q[k]
            new_e[k], d = e[k] * ratio, d * ratio - shift
        if not d >= 0:
            return None
        least = min(least, d)
    new_q[n - 1] = d
    return new_q, new_e, least


def squared_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix by dqds, in falling order."""
    found: list[float] = []
    open_ = [([x * x for x in diagonal.tolist()], [x * x for x in above.tolist()], 0.0)]
    while open_:
        q, e, done = open_.pop()
        # The least value left lies in [0, most].
        most = None
        while q:
            n = len(q)
            if n == 1:
                found.append(q[0] + done)
                break
            tiny = [k for k in range(n - 1) if e[k] <= EPS * EPS * (done + min(q[k], q[k + 1]))]
            if tiny:
                cut = tiny[-1] + 1
                open_.append((q[:cut], e[: cut - 1], done))
                q, e, most = q[cut:], e[cut:], None
                continue
            if q[0] < q[-1]:
                # Seen from its other end it has the same values, and small ones go to the end.
                q, e = q[::-1], e[::-1]
            shift, step = 0.0, None
            if most is not None and most > EPS * done:
                close = most - 2 * (e[-1] * most) ** 0.5
                for shift in (max(close, most / 2), most / 4, most / 16):
                    step = _sweep(q, e, shift)
                    if step:
                        break
                    most = min(most, shift)
            if step is None:
                shift, step = 0.0, _sweep(q, e, 0.0)
            q, e, least = step
            done += shift
            most = least if most is None else min(least, most - shift)
    return np.sort(np.array(found))[::-1]


class _Twisted:
    """B'B less a shift, factored from both ends, meeting at row r."""

    def __init__(self, diagonal: np.ndarray, above: np.ndarray, shift: float):
        q, e, n = diagonal * diagonal, above * above, len(diagonal)
        both = diagonal[:-1] * above
        small = EPS * EPS * max(q.max(), np.finfo(float).tiny / EPS)

        def pivot(x: float) -> float:
            return x if abs(x) > small else small

        self.top, self.low = np.empty(n), np.empty(n)
        self.down, self.up = np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0))
        s, p = np.empty(n), np.empty(n)
        s[0] = -shift
        for k in range(n - 1):
            self.top[k] = pivot(q[k] + s[k])
            self.down[k] = both[k] / self.top[k]
            s[k + 1] = e[k] * (s[k] / self.top[k]) - shift
        p[n - 1] = q[n - 1] - shift
        for k in range(n - 2, -1, -1):
            self.low[k + 1] = pivot(e[k] + p[k + 1])
            self.up[k] = both[k] / self.low[k + 1]
            p[k] = q[k] * (p[k + 1] / self.low[k + 1]) - shift
        meet = s + p + shift
        self.n, self.r = n, int(np.argmin(np.abs(meet)))
        self.meet = pivot(meet[self.r])

    def _outwards(self, w: np.ndarray) -> np.ndarray:
        for k in range(self.r - 1, -1, -1):
            w[k] -= self.down[k] * w[k + 1]
            if abs(w[k]) > _LARGE:
                w /= _LARGE
        for k in range(self.r, self.n - 1):
            w[k + 1] -= self.up[k] * w[k]
            if abs(w[k + 1]) > _LARGE:
                w /= _LARGE
        return w / np.linalg.norm(w)

    def vector(self) -> np.ndarray:
        """The direction with the least residual: a solve for the unit vector at the twist."""
        w = np.zeros(self.n)
        w[self.r] = 1.0
        return self._outwards(w)

    def solve(self, right: np.ndarray) -> np.ndarray:
        y, r = right.copy(), self.r
        for k in range(r):
            y[k + 1] -= self.down[k] * y[k]
        for k in range(self.n - 2, r - 1, -1):
            y[k] -= self.up[k] * y[k + 1]
        y[:r] /= self.top[:r]
        y[r] /= self.meet
        y[r + 1 :] /= self.low[r + 1 :]
        return self._outwards(y / max(np.abs(y).max(), np.finfo(float).tiny))


def right_vectors(diagonal: np.ndarray, above: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Right singular vectors of a bidiagonal matrix, a column for each of its leading squared values."""
    n, out = len(diagonal), np.empty((len(diagonal), len(squares)))
    begin = 0
    for k, value in enumerate(squares):
        if k and squares[k - 1] - value > CLOSE * squares[k - 1]:
            begin = k
        twisted, near = _Twisted(diagonal, above, value), out[:, begin:k]
        z = twisted.vector()
        if begin < k:
            for turn in range(5):
                z = z - near @ (near.T @ z)
                z = z - near @ (near.T @ z)
                size = np.linalg.norm(z)
                if size < 0.1:
                    # Much the same vector again: start from another place.
                    z = np.random.default_rng((k, turn)).normal(size=n)
                    z = z - near @ (near.T @ z)
                    z = z - near @ (near.T @ z)
                    size = np.linalg.norm(z)
                elif turn >= 2:
                    break
                z = twisted.solve(z / size)
            z = z - near @ (near.T @ z)
            z /= np.linalg.norm(z)
        out[:, k] = z
    return out


def singular(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """All squared singular values of a square matrix, falling, and its leading right vectors.

    There are `count` vectors at most, and none for values that rounding cannot tell from zero.
    """
    diagonal, above, right = bidiagonalise(matrix)
    squares = squared_values(diagonal, above)
    leading = squares[:count][squares[:count] > (len(matrix) * EPS) ** 2 * squares.max(initial=0.0)]
    return squares, right @ right_vectors(diagonal, above, leading)
