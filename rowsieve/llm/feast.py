"""Leading eigenpairs of a symmetric matrix by contour integration (FEAST).

The spectrum is cut into intervals from the top down. How many eigenvalues lie above a
place is counted exactly by the signs of a pivoted LDL^T factorisation of the shifted matrix
(Sylvester's law), so each interval's count is known beforehand. For each interval a
quadrature over a circle around it, one complex shifted solve a point, projects a
random subspace onto the eigenvectors inside; Rayleigh-Ritz extracts them, and the step is
repeated until residuals are at rounding level. The number found must equal the interval's count:
else the search goes on with a larger subspace and more points, and at last it fails loudly.
"""

from __future__ import annotations

import numpy as np

#: Eigenvalues of an interval, unless they lie too close together to be told apart.
MOST_INSIDE = 8
POINTS = 8
MOST_STEPS = 40
#: Residuals, relative to the largest eigenvalue, that are rounding for certain.
ROUNDING = 1e-12


def below(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are less than ``shift``."""
    a = matrix - shift * np.eye(len(matrix))
    alpha, negative = (1 + 17**0.5) / 8, 0
    while len(a):
        size = np.abs(a)
        p, q = np.unravel_index(size.argmax(), size.shape)
        r = np.abs(np.diag(a)).argmax()
        if size[p, q] == 0:
            break
        pivot = [r] if size[r, r] >= alpha * size[p, q] else sorted({int(p), int(q)})
        rest = np.setdiff1d(np.arange(len(a)), pivot)
        block, side = a[np.ix_(pivot, pivot)], a[np.ix_(rest, pivot)]
        # A pivot of two has a negative determinant here: one sign of each kind.
        negative += int(block[0, 0] < 0) if len(pivot) == 1 else 1
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
        a = (a + a.T) / 2
    return negative


def _place(matrix: np.ndarray, low: float, high: float) -> float:
    """Where to cut an interval: as far from eigenvalues as a few trials find."""
    width = high - low
    for margin in (1 / 32, 1 / 256, 1 / 4096):
        for part in (0.5, 0.4, 0.6, 0.45, 0.55, 0.3, 0.7):
            at, near = low + part * width, margin * width
            if below(matrix, at - near) == below(matrix, at + near):
                return at
    return low + width / 2


def intervals(matrix: np.ndarray, low: float, high: float, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside) of intervals from the top, until ``wanted`` are inside."""
    size = len(matrix)
    out, found = [], 0
    stack = [(low, high, below(matrix, low), size)]
    while stack and found < wanted:
        a, b, under_a, under_b = stack.pop()
        inside = under_b - under_a
        if not inside:
            continue
        if inside <= MOST_INSIDE or b - a <= 1e-9 * abs(high):
            out.append((a, b, inside))
            found += inside
            continue
        at = _place(matrix, a, b)
        under = below(matrix, at)
        stack += [(a, at, under_a, under), (at, b, under, under_b)]
    return out


def _inside(
    matrix: np.ndarray, low: float, high: float, count: int, points: int, extra: int, scale: float
) -> tuple[np.ndarray, np.ndarray] | None:
    """The eigenpairs of an interval, or none if they were not all found."""
    size = len(matrix)
    centre, radius = (low + high) / 2, (high - low) / 2
    angles = (np.arange(points) + 0.5) * np.pi / points
    shifts = centre + radius * np.exp(1j * angles)
    y = np.random.default_rng(size + count).standard_normal((size, min(size, count + extra)))
    before = np.inf
    for _ in range(MOST_STEPS):
        # The lower half circle gives the complex conjugate.
        projected = sum(
            ((z - centre) / points * np.linalg.solve(z * np.eye(size) - matrix, y)).real for z in shifts
        )
        basis = np.linalg.qr(projected)[0]
        values, mix = np.linalg.eigh(basis.T @ matrix @ basis)
        y = basis @ mix
        near = np.argsort(np.maximum(low - values, values - high), kind="stable")[:count]
        found, vectors = values[near], y[:, near]
        residual = np.linalg.norm(matrix @ vectors - vectors * found, axis=0).max()
        # At rounding level residuals no longer fall.
        if residual <= ROUNDING * scale and residual >= before / 2:
            edge = 2 * residual
            return (found, vectors) if (found > low - edge).all() and (found < high + edge).all() else None
        before = residual
    return None


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``wanted`` largest positive eigenvalues, falling, and their unit eigenvectors.

    Eigenvalues that are zero but for rounding are left out.
    """
    size = len(matrix)
    radius = np.abs(matrix).sum(axis=1)
    high = float(radius.max(initial=0.0)) * (1 + 1e-9)
    nothing = np.array([]), np.zeros((size, 0))
    if not high:
        return nothing
    low = size * np.finfo(float).eps * high
    positive = size - below(matrix, low)
    if not positive:
        return nothing
    # An edge beside the zeros would leave them half inside the lowest circle.
    edge = high / 2
    while edge > low and size - below(matrix, edge) < min(wanted, positive):
        edge /= 2
    parts = []
    for a, b, count in intervals(matrix, max(edge, low), high, min(wanted, positive)):
        for trial in range(5):
            pairs = _inside(matrix, a, b, count, POINTS << trial, (count + 4) << trial, high)
            if pairs:
                break
        else:
            raise ArithmeticError(f"not all {count} eigenvalues between {a} and {b} were found")
        parts.append(pairs[1])
    # Vectors of different intervals are made orthogonal to rounding by one more Rayleigh-Ritz step.
    basis = np.linalg.qr(np.hstack(parts))[0]
    values, mix = np.linalg.eigh(basis.T @ matrix @ basis)
    order = np.argsort(-values, kind="stable")[: min(wanted, positive)]
    return values[order], (basis @ mix)[:, order]
