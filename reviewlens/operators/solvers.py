"""Quasi-Newton minimisers that ask for loss and gradient instead of computing them.

A solver is a generator: it yields points, one a row, and is sent ``[(loss, gradient), ...]`` there, so that
the caller can answer many solvers from one pass over distributed rows (``batched.solve``).  A backtracking
search asks for the trials that it may go through together: as many as the search before it took, when those
do not end it a few more, then all that may follow.  It goes through the same trials as one that asks for each.  Both are
textbook methods with the settings that Spark's estimators use, so that a fit stopped after a given
number of iterations is the fit that Spark would give: limited-memory BFGS of ten corrections with a
strong Wolfe line search (smooth losses), and its orthant-wise form with a backtracking search (an L1
penalty; the hinge loss, whose penalty is zero).

``marks`` are iterations whose points are wanted on the way: models that differ in nothing but the
number of iterations share one run.
"""

from __future__ import annotations

from collections.abc import Generator, Sequence

import numpy as np

Ask = Generator[np.ndarray, list[tuple[float, np.ndarray]], dict[int, np.ndarray]]

CORRECTIONS = 10
#: Iterations whose losses the test of convergence looks at.
LOOK_BACK = 20
ARMIJO, WOLFE = 1e-4, 0.9
SEARCH_STEPS, ZOOM_STEPS, BACKTRACK_STEPS = 10, 10, 20
SMALLEST_STEP, LARGEST_STEP = 1e-10, 1e10
#: What a backtracking search grows a step by, and the ever shorter trials that it asks for after its first, or after one that grew.
GROW = 2.1
AHEAD = 7


class SearchFailed(Exception):
    """No acceptable step along a direction."""


def _two_loops(steps: list[np.ndarray], changes: list[np.ndarray], grad: np.ndarray) -> np.ndarray:
    """The descent direction from the corrections (latest last)."""
    direction, kept = grad.copy(), []
    scale = 1.0
    if steps:
        sy = steps[-1] @ changes[-1]
        if not sy >= 0:
            raise SearchFailed
        scale = sy / (changes[-1] @ changes[-1])
    for s, y in zip(reversed(steps), reversed(changes)):
        rho = s @ y
        a = s @ direction / rho
        if not np.isfinite(a):
            raise SearchFailed
        direction -= a * y
        kept.append((a, rho))
    direction *= scale
    for (s, y), (a, rho) in zip(zip(steps, changes), reversed(kept)):
        direction += (a - y @ direction / rho) * s
    return -direction


def _cubic(left: tuple[float, float, float], right: tuple[float, float, float]) -> float:
    """Minimum of the cubic through two (step, value, slope), kept off the ends."""
    (lt, lv, ld), (rt, rv, rd) = left, right
    d1 = ld + rd - 3 * (lv - rv) / (lt - rt)
    d2 = np.sqrt(d1 * d1 - ld * rd) if d1 * d1 >= ld * rd else np.nan
    t = rt - (rt - lt) * (rd + d2 - d1) / (rd - ld + 2 * d2)
    low, high = lt + 0.1 * (rt - lt), lt + 0.9 * (rt - lt)
    return low if t < low else high if t > high else t


def _strong_wolfe(x, value, grad, direction, step):
    """Step with sufficient decrease and small slope -> (point, value, gradient)."""
    slope = float(direction @ grad)
    if slope > 0:
        raise SearchFailed
    seen = {}

    def at(t: float):
        point = x + t * direction
        ((v, g),) = yield point[None]
        seen[t] = point, v, g
        return t, v, float(g @ direction)

    def zoom(low, high):
        for _ in range(ZOOM_STEPS):
            c = yield from at(_cubic(high, low) if low[0] > high[0] else _cubic(low, high))
            if c[1] > value + ARMIJO * c[0] * slope or c[1] >= low[1]:
                high = c
            else:
                if abs(c[2]) <= WOLFE * abs(slope):
                    return c[0]
                if c[2] * (high[0] - low[0]) >= 0:
                    high = low
                low = c
        raise SearchFailed

    low, t, found = (0.0, value, slope), step, None
    for i in range(SEARCH_STEPS):
        c = yield from at(t)
        if not np.isfinite(c[1]):
            t /= 2
            continue
        if c[1] > value + ARMIJO * t * slope or (c[1] >= low[1] and i > 0):
            found = yield from zoom(low, c)
        elif abs(c[2]) <= WOLFE * abs(slope):
            found = t
        elif c[2] >= 0:
            found = yield from zoom(c, low)
        if found is not None:
            if found * np.linalg.norm(grad) < SMALLEST_STEP:
                raise SearchFailed
            return seen[found]
        low, t = c, t * 1.5
    raise SearchFailed


def lbfgs(x: np.ndarray, max_iter: int, tol: float = 1e-6, marks: Sequence[int] = ()) -> Ask:
    """Minimise a smooth loss; returns the points after the marked iterations and the last (key -1)."""
    ((value, grad),) = yield x[None]
    return (yield from _descend(x, value, grad, max_iter, tol, marks, None))


def owlqn(x: np.ndarray, l1: np.ndarray, max_iter: int, tol: float = 1e-6, marks: Sequence[int] = ()) -> Ask:
    """Minimise a loss plus ``sum(l1 * abs(x))``; the loss and gradient asked for leave the penalty out."""
    ((value, grad),) = yield x[None]
    return (yield from _descend(x, value, grad, max_iter, tol, marks, l1))


def _pseudo(x: np.ndarray, value: float, grad: np.ndarray, l1: np.ndarray | None) -> tuple[float, np.ndarray]:
    """Value and gradient with the penalty; at zero the one-sided slope nearest to zero."""
    if l1 is None:
        return value, grad
    down, up = grad - l1, grad + l1
    flat = np.where(down > 0, down, np.where(up < 0, up, 0.0))
    return value + float(l1 @ np.abs(x)), np.where(l1 == 0, grad, np.where(x == 0, flat, grad + np.sign(x) * l1))


def _following(step: float, shrink: float, count: int, grew: bool) -> list[float]:
    """The trial ``step`` and those that may follow: ever shorter ones; after one that grew also those that shrink and grow in turn."""
    shorter, turns = [step], [step]
    while len(shorter) < (min(count, AHEAD) if grew else count) and shorter[-1] * shrink >= SMALLEST_STEP:
        shorter.append(shorter[-1] * shrink)
    while grew and len(turns) < count:
        turns.append(turns[-1] * (shrink if len(turns) % 2 else GROW))
    return list(dict.fromkeys(shorter + turns))


def _backtrack(x, value, full, pseudo, direction, l1, first, expected=1):
    """Backtracking within the orthant -> (point, value, gradient) of the smooth part, and the trials that it took.

    ``expected``: the trials that are asked for at first.

    Spark's search judges its first trial by the loss at the start: unless the penalty makes up for it, the
    trial is one step shorter, and there is nothing to evaluate at the first.
    """
    orthant = np.where(x != 0, np.sign(x), np.sign(-pseudo))
    slope = float(direction @ pseudo)
    step = 0.5 / np.linalg.norm(first) if first is not None else 1.0
    shrink = 0.1 if first is not None else 0.5
    start, trials = value, BACKTRACK_STEPS + 1
    if start > full + step * slope * ARMIJO:
        step, trials = step * shrink, BACKTRACK_STEPS
    known: dict[float, tuple] = {}
    grew, asks = False, [expected, max(expected, AHEAD)]
    for left in range(trials, 0, -1):
        if step not in known:
            ahead = _following(step, shrink, min(asks.pop(0), left) if asks else left, grew)
            points = x + np.array(ahead)[:, None] * direction
            points = np.where(np.sign(points) == np.sign(orthant), points, 0.0)
            known.update({t: (p, *there) for t, p, there in zip(ahead, points, (yield points))})
        point, value, grad = known[step]
        reached, there = _pseudo(point, value, grad, l1)
        if left > BACKTRACK_STEPS:
            reached = start
        now = float(there @ direction)
        if reached > full + step * slope * ARMIJO:
            factor = shrink
        elif now < WOLFE * slope:
            factor = GROW
        elif now > -WOLFE * slope:
            factor = shrink
        else:
            break
        if left == 2:  # the last step is taken as it is
            break
        if not SMALLEST_STEP <= step * factor <= LARGEST_STEP:
            raise SearchFailed
        step, grew = step * factor, factor == GROW
    return point, value, grad, trials - left + 1


def _descend(x, value, grad, max_iter, tol, marks, l1):
    full, pseudo = _pseudo(x, value, grad, l1)
    start, recent = full, [np.inf]
    steps: list[np.ndarray] = []
    changes: list[np.ndarray] = []
    kept, iteration, failed, tried = {0: x}, 0, False, 1
    while True:
        still = len(recent) >= 2 and abs(full - max(recent)) <= tol * start
        if iteration >= max_iter or still or np.linalg.norm(pseudo) <= max(tol * full, 1e-8):
            break
        try:
            direction = _two_loops(steps, changes, pseudo)
            if l1 is None:
                step = 1.0 / np.linalg.norm(direction) if iteration == 0 else 1.0
                point, new, new_grad = yield from _strong_wolfe(x, value, grad, direction, step)
            else:
                direction = np.where(direction * pseudo < 0, direction, 0.0)
                first = grad if iteration == 0 else None
                point, new, new_grad, tried = yield from _backtrack(x, value, full, pseudo, direction, l1, first, tried)
        except SearchFailed:
            if failed:
                break
            failed, steps, changes = True, [], []
            continue
        steps, changes = [*steps, point - x][-CORRECTIONS:], [*changes, new_grad - grad][-CORRECTIONS:]
        x, value, grad, failed = point, new, new_grad, False
        full, pseudo = _pseudo(x, value, grad, l1)
        recent = [*recent, value][-LOOK_BACK:]
        iteration += 1
        if iteration in marks:
            kept[iteration] = x
    return kept | {-1: x}
