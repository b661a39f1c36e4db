"""Gamma and normal distributions over NumPy arrays, by the formulas of ``distributions``; NaN stands for null.

A step of a series or fraction is one pass over an array, for as many terms as
the value that needs most of them.
"""

from __future__ import annotations

import math

import numpy as np

from .distributions import CENTRE, FAR, LARGE_SHAPE, NEAR, NEWTON_STEPS, NODES, digamma, log_gamma, ratio, trigamma


def gamma_shape(log_gap: np.ndarray) -> np.ndarray:
    """The likeliest shape of a gamma distribution from ln(mean) - mean(ln)."""
    gap = np.maximum(log_gap, 1e-12)
    start = shape = (1 + np.sqrt(1 + 4 * gap / 3)) / (4 * gap)
    for _ in range(NEWTON_STEPS):
        to = shape - (np.log(shape) - digamma(shape) - gap) / (1 / shape - trigamma(shape))
        shape = np.where(to > 0, to, shape / 2)
    return np.where(gap < 1e-9, start, shape)


def _integrated(shape: np.ndarray, x: np.ndarray, upper: bool) -> np.ndarray:
    """A tail of the gamma distribution of a large shape, over the stretch from x on that holds all but 1e-16 of it."""
    m = shape - 1
    wide = np.sqrt(m)
    low = x if upper else np.maximum(np.minimum(m - 9 * wide, x - 6 * wide), 0.0)
    high = np.maximum(m + 12 * wide, x + 7 * wide) if upper else x
    middle, half, total = (high + low) / 2 / m - 1, (high - low) / 2 / m, np.zeros_like(m)
    for node, weight in NODES:
        d = middle + half * node
        total += weight * np.exp(m * (np.log1p(d) - d))
    stirling = 1 / (12 * m) - 1 / (360 * m * m * m)
    return total * half * np.sqrt(m / (2 * math.pi)) * np.exp(-stirling)


def _series(shape: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The regularised lower incomplete gamma function by its series of positive terms, summed from the last on."""
    far = x > shape + 40 * np.sqrt(shape) + 200
    near = np.where(far, 0.0, x)
    terms = 30 + np.maximum(near - shape, 0.0) + 9 * np.sqrt(np.maximum(shape, near))
    total = np.ones_like(x)
    for n in range(int(terms.max(initial=0)), 0, -1):
        total = 1 + near / (shape + n) * total
    return np.where(far, 1.0, np.minimum(np.exp(shape * np.log(x) - x - log_gamma(shape + 1)) * total, 1.0))


def gamma_cdf(x: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """P(X <= x) of a gamma distribution with scale 1."""
    p = np.where((x <= 0) & ~np.isnan(shape), 0.0, np.nan)
    for which, value in (
        ((x > 0) & (shape <= LARGE_SHAPE), lambda a, x: _series(a, x)),
        ((x > 0) & (shape > LARGE_SHAPE) & (x > shape), lambda a, x: 1 - _integrated(a, x, True)),
        ((x > 0) & (shape > LARGE_SHAPE) & (x <= shape), lambda a, x: _integrated(a, x, False)),
    ):
        p[which] = value(shape[which], x[which])
    return p


def gamma_tail(x: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """P(X > x) of a gamma distribution with scale 1 for x well above the shape, to full relative precision."""
    p, large = np.full_like(x, np.nan), shape > LARGE_SHAPE
    p[large] = _integrated(shape[large], x[large], True)
    a, x = shape[~large], x[~large]
    # The continued fraction from its last term on.
    terms = int(60 + 4 * math.sqrt(LARGE_SHAPE))
    below = x + 2 * terms + 1 - a
    for i in range(terms, 0, -1):
        below = x + 2 * i - 1 - a - i * (i - a) / below
    p[~large] = np.exp(a * np.log(x) - x - log_gamma(a)) / below
    return p


def normal_quantile(p: np.ndarray) -> np.ndarray:
    """The inverse of the normal distribution by Wichura's rational functions, for p clipped to 1e-300 and 1 - 1e-16."""
    v = np.clip(p, 1e-300, 1 - 1e-16)
    q = v - 0.5
    z = q * ratio(CENTRE, 0.180625 - q * q)
    outer = np.abs(q) > 0.425
    r = np.sqrt(-np.log(np.minimum(v, 1 - v)[outer]))
    z[outer] = np.copysign(np.where(r <= 5, ratio(NEAR, r - 1.6), ratio(FAR, r - 5)), q[outer])
    return z
