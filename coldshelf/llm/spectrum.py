"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

By Sylvester's law a factorization LDLᵀ of ``v - s`` has as many positive pivots as ``v``
has eigenvalues above ``s``.  Such counts cut the spectrum until an interval holds the
k-th eigenvalue alone; Rayleigh quotient iteration from within it converges cubically; a
count on either side of the result certifies its number.  The matrix has the size of a
vector's dimension squared, however many vectors there are.
"""

from __future__ import annotations

import numpy as np

_PIVOT = (1 + np.sqrt(17)) / 8  # Bunch and Parlett's bound for the growth of entries
_STEPS = 40


def count_above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues are above ``shift``: positive pivots of a diagonally pivoted
    LDLᵀ factorization with blocks of one or two rows."""
    a = v - shift * np.eye(len(v))
    positive = 0
    while (n := len(a)) > 0:
        diagonal = np.abs(np.diag(a))
        p = int(diagonal.argmax())
        off = np.abs(np.triu(a, 1))
        r, s = divmod(int(off.argmax()), n)
        if diagonal[p] >= _PIVOT * off[r, s]:
            if diagonal[p] == 0:
                break  # all that is left is zero: eigenvalues at the shift itself
            pivot, rest = a[p, p], np.delete(np.arange(n), p)
            positive += pivot > 0
            column = a[rest, p]
            a = a[np.ix_(rest, rest)] - np.outer(column, column / pivot)
        else:  # a block with one positive and one negative eigenvalue
            rest = np.delete(np.arange(n), [r, s])
            block, columns = a[np.ix_([r, s], [r, s])], a[np.ix_(rest, [r, s])]
            positive += 1
            a = a[np.ix_(rest, rest)] - columns @ np.linalg.solve(block, columns.T)
        a = (a + a.T) / 2
    return int(positive)


def leading_eigenpairs(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues that are not zero, falling, and unit eigenvectors as rows.

    Eigenvalues that counts can't tell apart, equal ones above all, get any orthogonal
    vectors of their common space.  Eigenvalues within rounding of zero are left out.
    """
    d = len(v)
    # rounding of the whole problem: no count is certain closer to an eigenvalue
    scale = float(np.linalg.norm(v))
    fuzz = 4 * d * np.finfo(float).eps * scale
    values: list[float] = []
    vectors = np.zeros((0, d))
    for number in range(1, min(k, d) + 1):
        if scale == 0 or count_above(v, fuzz) < number:
            break
        low, high = _isolated(v, number, fuzz, values[-1] + 2 * fuzz if values else scale + fuzz, fuzz)
        value, vector = _rayleigh(v, low, high, vectors, fuzz, number)
        values.append(value)
        vectors = np.vstack([vectors, vector])
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], vectors[order]


def _isolated(v: np.ndarray, number: int, low: float, high: float, fuzz: float) -> tuple[float, float]:
    """An interval that holds the eigenvalue of this number alone, or one too narrow to cut.

    At ``low`` at least ``number`` eigenvalues lie above, at ``high`` fewer.
    """
    above_low, above_high = count_above(v, low), count_above(v, high)
    while (above_low > number or above_high < number - 1) and high - low > fuzz:
        middle = (low + high) / 2
        above = count_above(v, middle)
        if above >= number:
            low, above_low = middle, above
        else:
            high, above_high = middle, above
    return low, high


def _rayleigh(
    v: np.ndarray, low: float, high: float, found: np.ndarray, fuzz: float, number: int
) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration that may not leave the interval.

    It starts by inverse iteration at the interval's middle.  Where it settles outside or
    its number is not certified, the interval is cut in half by another count.
    """
    d = len(v)
    while True:
        shift, x = (low + high) / 2, _free(np.random.default_rng(number).standard_normal(d), found)
        before = np.inf
        for step in range(_STEPS):
            x = _free(_solved(v, shift, x, fuzz), found)
            quotient = float(x @ v @ x)
            residual = float(np.linalg.norm(v @ x - quotient * x))
            if residual <= fuzz / 4 and residual > before / 2:
                break  # settled: what is left is rounding
            before = residual
            if step >= 2:
                shift = quotient if low <= quotient <= high else (low + high) / 2
        certain = (
            low - fuzz <= quotient <= high + fuzz
            and residual <= fuzz
            and count_above(v, quotient - 2 * fuzz) >= number
            and count_above(v, quotient + 2 * fuzz) < number
        )
        if certain or high - low <= fuzz / 8:
            return quotient, x
        middle = (low + high) / 2
        low, high = (middle, high) if count_above(v, middle) >= number else (low, middle)


def _solved(v: np.ndarray, shift: float, x: np.ndarray, fuzz: float) -> np.ndarray:
    """A vector in the direction of (v - shift)⁻¹ x; a shift on an eigenvalue is moved off it."""
    for nudge in (0.0, fuzz / 64, fuzz / 8):
        try:
            solved = np.linalg.solve(v - (shift + nudge) * np.eye(len(v)), x)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(solved).all() and (size := np.abs(solved).max()) > 0:
            return solved / size
    return x


def _free(x: np.ndarray, found: np.ndarray) -> np.ndarray:
    """The unit vector of what is orthogonal to the vectors found."""
    for _ in range(2):
        x = x - found.T @ (found @ x)
    return x / np.linalg.norm(x)
