"""Model parameters and emission densities.

An emission knows its log density as a column expression, the terms whose weighted sums a
refit needs, and how to turn those sums into a new emission. Expressions take the parameter
values as columns, so one expression serves every round of a fit; the values are a few
numbers per state and enter the plan as literals.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Protocol

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Log density of what a model holds impossible; keeps every step finite.
LOG_FLOOR = -700.0
# Log of a structural zero in a move or a start: below any possible path.
LOG_NEVER = -7e8
VARIANCE_FLOOR = 1e-6


class Emission(Protocol):
    @property
    def n_terms(self) -> int: ...

    def parameters(self) -> list[float]: ...

    def log_density(self, x: Column, p: Sequence[Column]) -> Column: ...

    def terms(self, x: Column, p: Sequence[Column]) -> list[Column]: ...

    def refit(self, sums: Sequence[float]) -> "Emission": ...

    def log_densities(self, x: np.ndarray) -> np.ndarray:
        """Of many observations at once."""
        ...

    def weighted_terms(self, x: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The sums of ``terms`` over many observations."""
        ...


def literals(emission: Emission) -> list[Column]:
    return [F.lit(float(v)) for v in emission.parameters()]


def log_floor(p: float) -> float:
    return max(math.log(p), LOG_FLOOR) if p > 0 else LOG_FLOOR


def log_move(p: float) -> float:
    return math.log(p) if p > 0 else LOG_NEVER


def _sum(parts: Sequence[Column]) -> Column:
    out = parts[0]
    for part in parts[1:]:
        out = out + part
    return out


@dataclass(frozen=True)
class Table:
    """Probabilities of the integers 0..n-1."""

    probabilities: tuple[float, ...]

    @property
    def n_terms(self) -> int:
        return len(self.probabilities)

    def parameters(self) -> list[float]:
        return [log_floor(p) for p in self.probabilities]

    def log_density(self, x: Column, p: Sequence[Column]) -> Column:
        return F.coalesce(F.get(F.array(*p), x.cast("int")), F.lit(LOG_FLOOR))

    def terms(self, x: Column, p: Sequence[Column]) -> list[Column]:
        return [F.when(x == v, 1.0).otherwise(0.0) for v in range(len(self.probabilities))]

    def refit(self, sums: Sequence[float]) -> "Table":
        weight = sum(sums)
        if weight <= 0:
            return self
        return Table(tuple(s / weight for s in sums))

    def log_densities(self, x: np.ndarray) -> np.ndarray:
        known = (x >= 0) & (x < len(self.probabilities))
        return np.where(known, np.array(self.parameters())[np.where(known, x, 0).astype(np.int64)], LOG_FLOOR)

    def weighted_terms(self, x: np.ndarray, weight: np.ndarray) -> np.ndarray:
        return np.array([weight[x == v].sum() for v in range(len(self.probabilities))])


@dataclass(frozen=True)
class Gaussian:
    mean: float
    variance: float

    n_terms = 3

    def parameters(self) -> list[float]:
        return [self.mean, 2 * self.variance, -0.5 * math.log(2 * math.pi * self.variance)]

    def log_density(self, x: Column, p: Sequence[Column]) -> Column:
        mean, twice_variance, constant = p
        d = x - mean
        return constant - d * d / twice_variance

    def terms(self, x: Column, p: Sequence[Column]) -> list[Column]:
        # around the present mean, so that the variance does not cancel
        d = x - p[0]
        return [F.lit(1.0), d, d * d]

    def refit(self, sums: Sequence[float]) -> "Gaussian":
        weight, first, second = sums
        if weight <= 0:
            return self
        shift = first / weight
        return Gaussian(self.mean + shift, max(second / weight - shift * shift, VARIANCE_FLOOR))

    def log_densities(self, x: np.ndarray) -> np.ndarray:
        mean, twice_variance, constant = self.parameters()
        return constant - (x - mean) ** 2 / twice_variance

    def weighted_terms(self, x: np.ndarray, weight: np.ndarray) -> np.ndarray:
        d = x - self.mean
        return np.array([weight.sum(), weight @ d, weight @ (d * d)])


@dataclass(frozen=True)
class Mixture:
    """Weighted Gaussians. A refit is one expectation step around the present means."""

    weights: tuple[float, ...]
    means: tuple[float, ...]
    variances: tuple[float, ...]

    def __post_init__(self):
        whole = sum(self.weights)
        object.__setattr__(self, "weights", tuple(w / whole for w in self.weights))

    @property
    def n_terms(self) -> int:
        return 3 * len(self.weights)

    def parameters(self) -> list[float]:
        out = []
        for w, m, v in zip(self.weights, self.means, self.variances):
            out += [w / math.sqrt(2 * math.pi * v), m, 2 * v]
        return out

    def _densities(self, x: Column, p: Sequence[Column]) -> list[Column]:
        out = []
        for c in range(len(self.weights)):
            scale, mean, twice_variance = p[3 * c : 3 * c + 3]
            d = x - mean
            out.append(scale * F.exp(-(d * d) / twice_variance))
        return out

    def log_density(self, x: Column, p: Sequence[Column]) -> Column:
        logs = F.log(_sum(self._densities(x, p)))
        return F.coalesce(F.greatest(logs, F.lit(LOG_FLOOR)), F.lit(LOG_FLOOR))

    def terms(self, x: Column, p: Sequence[Column]) -> list[Column]:
        parts = self._densities(x, p)
        whole = _sum(parts)
        out = []
        for c, part in enumerate(parts):
            share = F.when(whole > 0, part / whole).otherwise(F.lit(1.0 / len(parts)))
            d = x - p[3 * c + 1]
            out += [share, share * d, share * d * d]
        return out

    def refit(self, sums: Sequence[float]) -> "Mixture":
        parts = [sums[i : i + 3] for i in range(0, len(sums), 3)]
        whole = sum(s[0] for s in parts)
        if whole <= 0 or any(s[0] <= 0 for s in parts):
            return self
        return Mixture(
            tuple(s[0] / whole for s in parts),
            tuple(m + s[1] / s[0] for m, s in zip(self.means, parts)),
            tuple(max(s[2] / s[0], VARIANCE_FLOOR) for s in parts),
        )

    def _part_logs(self, x: np.ndarray) -> np.ndarray:
        w, mean, variance = (np.array(v, dtype=float) for v in (self.weights, self.means, self.variances))
        with np.errstate(divide="ignore"):
            scale = np.log(w) - 0.5 * np.log(2 * np.pi * variance)
        return scale - (x[:, None] - mean) ** 2 / (2 * variance)

    def log_densities(self, x: np.ndarray) -> np.ndarray:
        return np.logaddexp.reduce(self._part_logs(x), axis=1)

    def weighted_terms(self, x: np.ndarray, weight: np.ndarray) -> np.ndarray:
        parts = self._part_logs(x)
        share = np.exp(parts - np.logaddexp.reduce(parts, axis=1)[:, None]) * weight[:, None]
        d = x[:, None] - np.array(self.means)
        return np.stack([share.sum(axis=0), (share * d).sum(axis=0), (share * d * d).sum(axis=0)], axis=1).ravel()


@dataclass(frozen=True)
class MultiGaussian:
    """Vector observations; ``diagonal`` keeps the covariances at zero."""

    mean: tuple[float, ...]
    covariance: tuple[tuple[float, ...], ...]
    diagonal: bool = False

    @property
    def n_terms(self) -> int:
        return 1 + len(self.mean) + len(self._upper())

    def _upper(self) -> list[tuple[int, int]]:
        d = len(self.mean)
        return [(i, j) for i in range(d) for j in range(i, d) if i == j or not self.diagonal]

    def _lower(self) -> list[tuple[int, int]]:
        return [(j, i) for i, j in self._upper()]

    def parameters(self) -> list[float]:
        # rows of the inverse factor turn the vector into independent unit normals
        factor = np.linalg.inv(np.linalg.cholesky(np.array(self.covariance)))
        constant = -0.5 * len(self.mean) * math.log(2 * math.pi) + np.log(np.diag(factor)).sum()
        return [float(constant), *self.mean, *[float(factor[i, j]) for i, j in self._lower()]]

    def log_density(self, x: Column, p: Sequence[Column]) -> Column:
        d = len(self.mean)
        rows: dict[int, list[Column]] = {}
        for at, (i, j) in enumerate(self._lower()):
            rows.setdefault(i, []).append((x[j] - p[1 + j]) * p[1 + d + at])
        units = [_sum(parts) for parts in rows.values()]
        return p[0] - _sum([u * u for u in units]) / 2

    def terms(self, x: Column, p: Sequence[Column]) -> list[Column]:
        centred = [x[i] - p[1 + i] for i in range(len(self.mean))]
        return [F.lit(1.0), *centred, *[centred[i] * centred[j] for i, j in self._upper()]]

    def refit(self, sums: Sequence[float]) -> "MultiGaussian":
        d, weight = len(self.mean), sums[0]
        if weight <= 0:
            return self
        shift = [s / weight for s in sums[1 : d + 1]]
        covariance = np.zeros((d, d))
        for (i, j), s in zip(self._upper(), sums[d + 1 :]):
            covariance[i, j] = covariance[j, i] = s / weight - shift[i] * shift[j]
        covariance[np.diag_indices(d)] = np.maximum(covariance.diagonal(), VARIANCE_FLOOR)
        return MultiGaussian(
            tuple(m + s for m, s in zip(self.mean, shift)),
            tuple(tuple(float(v) for v in row) for row in covariance),
            self.diagonal,
        )

    def log_densities(self, x: np.ndarray) -> np.ndarray:
        d, p = len(self.mean), self.parameters()
        factor = np.zeros((d, d))
        for (i, j), v in zip(self._lower(), p[1 + d :]):
            factor[i, j] = v
        units = (x - np.array(self.mean)) @ factor.T
        return p[0] - (units * units).sum(axis=1) / 2

    def weighted_terms(self, x: np.ndarray, weight: np.ndarray) -> np.ndarray:
        centred = x - np.array(self.mean)
        second = centred.T @ (centred * weight[:, None])
        return np.array([weight.sum(), *(weight @ centred), *[second[i, j] for i, j in self._upper()]])


@dataclass(frozen=True)
class Hmm:
    initial: tuple[float, ...]
    transitions: tuple[tuple[float, ...], ...]
    emissions: tuple[Emission, ...]

    @property
    def k(self) -> int:
        return len(self.initial)


def uniform(emissions: Sequence[Emission]) -> Hmm:
    k = len(emissions)
    return Hmm((1.0 / k,) * k, ((1.0 / k,) * k,) * k, tuple(emissions))
