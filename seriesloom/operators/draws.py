"""Random numbers that depend on what they are for, not on the task that draws them."""

from __future__ import annotations

import math

import numpy as np

_GAMMA, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def scramble(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(seed: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Uniform numbers in (0, 1) that depend on a seed and a place alone."""
    x = scramble(seed.astype(np.uint64) * _GAMMA + place.astype(np.uint64) * _ODD)
    return (x >> np.uint64(11)).astype(float) / 2.0**53 + 2.0**-54


def hashes(rows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every row of integers."""
    out = np.zeros(len(rows), np.uint64)
    for column in rows.T:
        out = scramble((out + column.astype(np.uint64) + np.uint64(1)) * _GAMMA)
    return out


def poisson_table(mean: float) -> np.ndarray:
    """Distribution function of a Poisson number, as far as it matters."""
    if mean <= 0:
        return np.ones(1)
    limit = int(mean + 12 * math.sqrt(mean) + 12)
    return np.cumsum([math.exp(k * math.log(mean) - mean - math.lgamma(k + 1)) for k in range(limit)])


def poisson(mean: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Poisson numbers for uniform ``u``, one table per different mean."""
    out = np.zeros(len(u))
    for m in np.unique(mean):
        at = mean == m
        out[at] = np.searchsorted(poisson_table(float(m)), u[at])
    return out
