"""Leading eigenpairs of a symmetric matrix by contour integration.

The spectrum is cut into intervals that inertia counts find (an LDL' factorisation of the
shifted matrix tells how many eigenvalues lie above the shift). In each interval a few
vectors are projected onto its eigenspace by a quadrature of complex shifted solves along a
circle through its ends, Rayleigh-Ritz turns them into eigenpairs, and this is repeated
until the residuals are at rounding. Counts of eigenpairs are held against the inertia
counts, so that none is missed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

NODES = 12  # of the quadrature on the upper half circle
PER_INTERVAL = 12  # an interval of more eigenvalues is cut, unless they are a cluster
EXTRA = 6  # vectors beyond the counted ones
ROUNDS = 40
_PIVOT = (1 + 17**0.5) / 8


@dataclass(frozen=True)
class Interval:
    """`count` eigenvalues lie between `low` and `high`, `above` lie over `low`."""

    low: float
    high: float
    count: int
    above: int


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues exceed shift: the inertia of matrix - shift, factored with
    pivots of one or two rows, the largest left at each step."""
    a = matrix - shift * np.eye(len(matrix))
    found = 0
    while len(a):
        size = np.abs(a)
        one = int(np.argmax(np.diagonal(size)))
        r, s = np.unravel_index(int(np.argmax(size)), size.shape)
        if size[r, s] == 0:
            break
        taken = [one] if size[one, one] >= _PIVOT * size[r, s] else [int(r), int(s)]
        rest = np.setdiff1d(np.arange(len(a)), taken)
        pivot, side = a[np.ix_(taken, taken)], a[np.ix_(rest, taken)]
        # A pivot of two rows has one eigenvalue of each sign.
        found += int(pivot[0, 0] > 0) if len(taken) == 1 else 1
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(pivot, side.T)
        a = (a + a.T) / 2
    return found


def _clear_shift(matrix: np.ndarray, shift: float, width: float) -> tuple[float, int]:
    """A shift near the asked one that no eigenvalue touches, and the count above it."""
    for step in range(64):
        at = shift - width * 1e-3 * step
        count = count_above(matrix, at)
        if count_above(matrix, at + width * 1e-5) == count == count_above(matrix, at - width * 1e-5):
            return at, count
    return shift, count_above(matrix, shift)


def intervals(matrix: np.ndarray, wanted: int) -> list[Interval]:
    """Intervals, from the top, that hold the `wanted` largest eigenvalues above rounding."""
    bound = float(np.abs(matrix).sum(axis=1).max()) * 1.001
    floor = bound * len(matrix) * np.finfo(float).eps
    total = count_above(matrix, floor)
    done: list[Interval] = []
    todo = [Interval(floor, bound, total, total)]
    while todo and sum(i.count for i in done) < min(wanted, total):
        here = todo.pop()
        if here.count == 0:
            continue
        if here.count <= PER_INTERVAL and here.above <= max(wanted, PER_INTERVAL) or here.high - here.low < 1e-9 * bound:
            done.append(here)
            continue
        middle, above = _clear_shift(matrix, (here.low + here.high) / 2, here.high - here.low)
        todo.append(Interval(here.low, middle, here.above - above, here.above))
        todo.append(Interval(middle, here.high, above - (here.above - here.count), above))
    return done


def _tightened(matrix: np.ndarray, at: Interval) -> Interval:
    """The interval with its ends moved half way to its own eigenvalues, so that those just
    outside keep off the contour."""
    ends = []
    for end, other, count in ((at.low, at.high, at.above), (at.high, at.low, at.above - at.count)):
        free, held = end, other
        for _ in range(10):
            middle = (free + held) / 2
            free, held = (middle, held) if count_above(matrix, middle) == count else (free, middle)
        ends.append((end + free) / 2)
    return Interval(ends[0], ends[1], at.count, at.above)


def _projected(matrix: np.ndarray, at: Interval, block: np.ndarray) -> np.ndarray:
    """block projected onto the eigenspace of the interval by the contour integral."""
    points, weights = np.polynomial.legendre.leggauss(NODES)
    centre, radius = (at.low + at.high) / 2, (at.high - at.low) / 2
    out = np.zeros_like(block)
    for point, weight in zip(points, weights, strict=True):
        turn = np.exp(0.5j * np.pi * (1 + point))
        solved = np.linalg.solve((centre + radius * turn) * np.eye(len(matrix)) - matrix, block.astype(complex))
        out += (weight / 2) * (radius * turn * solved).real
    return out


def _ritz(matrix: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rayleigh-Ritz pairs of the space that block spans, largest value first."""
    left, size, _ = np.linalg.svd(block, full_matrices=False)
    basis = left[:, size > size[0] * 1e-13] if size[0] > 0 else left[:, :0]
    small = basis.T @ matrix @ basis
    values, turn = np.linalg.eigh((small + small.T) / 2)
    return values[::-1], (basis @ turn)[:, ::-1]


def solve(matrix: np.ndarray, at: Interval, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvalues inside the interval, largest first, and their unit vectors."""
    at = _tightened(matrix, at)
    size = min(len(matrix), at.count + max(EXTRA, at.count // 2))
    block = np.random.default_rng(seed).standard_normal((len(matrix), size))
    scale = np.abs(matrix).sum(axis=1).max()
    best: tuple[float, np.ndarray, np.ndarray] | None = None
    stalled = 0
    for _ in range(ROUNDS):
        values, block = _ritz(matrix, _projected(matrix, at, block))
        inside = (values > at.low) & (values < at.high)
        if inside.sum() == at.count:
            error = np.abs(matrix @ block[:, inside] - block[:, inside] * values[inside]).max() / scale
            if best is None or error < best[0] / 2:
                best, stalled = (error, values[inside], block[:, inside]), 0
            else:
                stalled += 1
            if error < 4 * np.finfo(float).eps or stalled == 2:
                break
    if best is None or best[0] > 1e-11:
        raise ArithmeticError(f"{at.count} eigenvalues lie between {at.low} and {at.high} by inertia, but the projection did not settle on them")
    return best[1], best[2]


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` largest eigenvalues above rounding, falling, and their unit vectors as
    columns; the largest entry of each vector is positive. Fewer where the rank is lower,
    none for an empty or zero matrix."""
    if not len(matrix) or not np.abs(matrix).max() > 0:
        return np.empty(0), np.empty((len(matrix), 0))
    found = intervals(matrix, wanted)
    parts = [solve(matrix, at, seed) for seed, at in enumerate(found)]
    # The intervals' vectors together: what is left between them falls away.
    values, vectors = _ritz(matrix, np.concatenate([v for _, v in parts], axis=1))
    for at in found:
        if int((values > at.low).sum()) != at.above:
            raise ArithmeticError(f"{at.above} eigenvalues lie above {at.low} by inertia, {int((values > at.low).sum())} were found")
    values, vectors = values[:wanted], vectors[:, :wanted]
    top = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.sign(vectors[top, np.arange(len(values))])
