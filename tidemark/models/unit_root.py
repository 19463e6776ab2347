"""Augmented Dickey-Fuller and KPSS tests of one series."""

from __future__ import annotations

from statistics import NormalDist
from typing import NamedTuple

import numpy as np

# Fixed values. MacKinnon (1994), response surface of the p-value with a constant: bounds of the statistic,
# and coefficients of rising powers below and above the switch.
TAU_LEAST, TAU_SWITCH, TAU_MOST = -18.83, -1.61, 2.74
TAU_SMALL = (2.1659, 1.4412, 0.038269)
TAU_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
# Fixed values. MacKinnon (2010), critical values at 1, 5 and 10 percent: coefficients of rising powers of 1/n.
CRITICAL = ((-3.43035, -6.5393, -16.786, -79.433), (-2.86154, -2.8903, -4.234, -40.040), (-2.56677, -1.5384, -2.809, 0.0))
# Fixed values. Kwiatkowski et al. (1992), level stationarity: statistic and p-value.
KPSS_TABLE = ((0.347, 0.10), (0.463, 0.05), (0.574, 0.025), (0.739, 0.01))


class Adf(NamedTuple):
    statistic: float
    p_value: float
    lags: int
    n_obs: int
    criterion: float
    critical: tuple[float, ...]


def _ols(y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Coefficients, their t-statistics, and Akaike's criterion."""
    n, k = x.shape
    beta, _, rank, _ = np.linalg.lstsq(x, y, rcond=None)
    if rank < k:
        raise np.linalg.LinAlgError("regressors are collinear")
    ssr = float(((y - x @ beta) ** 2).sum())
    spread = np.sqrt(np.maximum(np.diag(np.linalg.inv(x.T @ x)) * ssr / max(n - k, 1), 1e-300))
    return beta, beta / spread, n * (np.log(2 * np.pi * max(ssr, 1e-300) / n) + 1) + 2 * k


def mackinnon_p(statistic: float) -> float:
    if statistic > TAU_MOST:
        return 1.0
    if statistic < TAU_LEAST:
        return 0.0
    powers = TAU_SMALL if statistic <= TAU_SWITCH else TAU_LARGE
    return NormalDist().cdf(sum(c * statistic**i for i, c in enumerate(powers)))


def adf_test(x: np.ndarray) -> Adf:
    """With a constant; lags by Akaike's criterion on the sample that the most lags leave, then fitted anew."""
    n = len(x)
    most = min(int(np.ceil(12 * (n / 100) ** 0.25)), n // 2 - 2)
    if most < 0:
        raise ValueError("sample size is too short for the regression")
    steps = np.diff(x)

    def design(lags: int, skip: int) -> tuple[np.ndarray, np.ndarray]:
        y = steps[skip:]
        past = [steps[skip - k : len(steps) - k] for k in range(1, lags + 1)]
        return y, np.column_stack([x[skip:-1], *past, np.ones(len(y))])

    y, full = design(most, most)
    best = min(range(most + 1), key=lambda k: _ols(y, np.column_stack([full[:, : k + 1], full[:, -1]]))[2])
    criterion = _ols(y, np.column_stack([full[:, : best + 1], full[:, -1]]))[2]
    y, own = design(best, best)
    t = float(_ols(y, own)[1][0])
    return Adf(t, mackinnon_p(t), best, len(y), float(criterion), tuple(sum(c / len(y) ** i for i, c in enumerate(row)) for row in CRITICAL))


def kpss_test(x: np.ndarray) -> tuple[float, float, int]:
    """(statistic, p-value, lags) around a level, with the bandwidth of Hobijn et al. (1998)."""
    n = len(x)
    e = x - x.mean()
    cov = [float(e[k:] @ e[: n - k]) for k in range(n)]
    reach = int(n ** (2 / 9))
    s0 = (cov[0] + 2 * sum(cov[1 : reach + 1])) / n
    s1 = 2 * sum(k * cov[k] for k in range(1, reach + 1)) / n
    lags = min(int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3)), n - 1)
    variance = (cov[0] + 2 * sum((1 - k / (lags + 1)) * cov[k] for k in range(1, lags + 1))) / n
    statistic = float((e.cumsum() ** 2).sum() / n**2 / variance)
    points, values = zip(*KPSS_TABLE, strict=True)
    return statistic, float(np.interp(statistic, points, values)), lags
