"""Quantiles of the standard normal distribution and sums of normal scores over runs of ranks."""

from __future__ import annotations

import numpy as np

# Wichura's rational approximation of the normal quantile (algorithm AS 241,
# accurate to 16 digits); coefficients of numerator and denominator, highest power first.
CENTRE = (
    (2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457,
     13731.693765509461125, 1971.5909503065514427, 133.14166789178437745, 3.387132872796366608),
    (5226.495278852545925, 28729.085735721942674, 39307.89580009271061, 21213.794301586595867,
     5394.1960214247511077, 687.1870074920579083, 42.313330701600911252, 1.0),
)
MIDDLE = (
    (7.7454501427834140764e-4, 0.0227238449892691845833, 0.24178072517745061177, 1.27045825245236838258,
     3.64784832476320460504, 5.7694972214606914055, 4.6303378461565452959, 1.42343711074968357734),
    (1.05075007164441684324e-9, 5.475938084995344946e-4, 0.0151986665636164571966, 0.14810397642748007459,
     0.68976733498510000455, 1.6763848301838038494, 2.05319162663775882187, 1.0),
)
TAIL = (
    (2.01033439929228813265e-7, 2.71155556874348757815e-5, 0.0012426609473880784386, 0.026532189526576123093,
     0.29656057182850489123, 1.7848265399172913358, 5.4637849111641143699, 6.6579046435011037772),
    (2.04426310338993978564e-15, 1.4215117583164458887e-7, 1.8463183175100546818e-5, 7.868691311456132591e-4,
     0.0148753612908506148525, 0.13692988092273580531, 0.59983220655588793769, 1.0),
)
CENTRE_WIDTH, CENTRE_SQUARE, MIDDLE_END, MIDDLE_SHIFT = 0.425, 0.180625, 5.0, 1.6
# Shift of ranks in Blom's scores.
RANK_SHIFT, COUNT_SHIFT = 0.375, 0.25


def normal_quantile(p: np.ndarray) -> np.ndarray:
    """The value below which a standard normal falls with probability ``p`` (0 < p < 1)."""
    p = np.asarray(p, float)
    q = p - 0.5
    ratio = lambda of, x: np.polyval(of[0], x) / np.polyval(of[1], x)
    out = q * ratio(CENTRE, CENTRE_SQUARE - np.minimum(q * q, CENTRE_SQUARE))
    far = np.abs(q) > CENTRE_WIDTH
    if far.any():
        r = np.sqrt(-np.log(np.where(q[far] < 0, p[far], 1.0 - p[far])))
        tail = np.where(r <= MIDDLE_END, ratio(MIDDLE, r - MIDDLE_SHIFT), ratio(TAIL, r - MIDDLE_END))
        out[far] = np.sign(q[far]) * tail
    return out


def scores(first: np.ndarray, count: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Blom's normal scores of runs of ranks, laid end to end.

    A run has ``count`` ranks from ``first`` on (0 is the lowest), of a sample of ``n``.
    """
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return normal_quantile((np.repeat(first, count) + within + 1.0 - RANK_SHIFT) / (np.repeat(n, count) + COUNT_SHIFT))


def quantile_sql(p: str) -> str:
    """``normal_quantile`` as an SQL expression, for the checks."""

    def polynomial(of, x: str) -> str:
        text = f"{of[0]!r}::double"
        for c in of[1:]:
            text = f"({text} * {x} + {c!r}::double)"
        return text

    def ratio(of, x: str) -> str:
        return f"{polynomial(of[0], x)} / {polynomial(of[1], x)}"

    q = f"({p} - 0.5)"
    r = f"sqrt(-ln(least({p}, 1.0 - {p})))"
    return f"""case when abs({q}) <= {CENTRE_WIDTH} then {q} * {ratio(CENTRE, f"({CENTRE_SQUARE} - {q} * {q})")}
        when {r} <= {MIDDLE_END} then sign({q}) * {ratio(MIDDLE, f"({r} - {MIDDLE_SHIFT})")}
        else sign({q}) * {ratio(TAIL, f"({r} - {MIDDLE_END})")} end"""
