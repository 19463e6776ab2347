"""Regression with seasonal ARMA errors, fitted by conditional least squares.

The model is phi(B) Phi(B^s) [w - c - x b] = theta(B) Theta(B^s) e, where w and x are the series and the
features after (1-B)^d (1-B^s)^D; c is a drift once there is a difference. Estimates are close to, not equal
to, exact maximum likelihood. Gaps are interpolated before fitting; their number is kept.
"""

from __future__ import annotations

from dataclasses import dataclass
from statistics import NormalDist

import numpy as np

Order = tuple[int, int, int]
Seasonal = tuple[int, int, int, int]


def interpolated(y: np.ndarray) -> tuple[np.ndarray, int]:
    gap = ~np.isfinite(y)
    if not gap.any():
        return y, 0
    if gap.all():
        raise ValueError("a series has no values")
    at = np.arange(len(y))
    return np.where(gap, np.interp(at, at[~gap], y[~gap]), y), int(gap.sum())


def difference_poly(d: int, seas_d: int, s: int) -> np.ndarray:
    out = np.ones(1)
    for _ in range(d):
        out = np.convolve(out, [1.0, -1.0])
    for _ in range(seas_d):
        out = np.convolve(out, np.concatenate([[1.0], np.zeros(s - 1), [-1.0]]))
    return out


def filtered(x: np.ndarray, poly: np.ndarray) -> np.ndarray:
    """poly(B) x, without the first values that have no past."""
    n = len(poly) - 1
    return sum(c * x[n - k : len(x) - k] for k, c in enumerate(poly) if c) if n else x.astype(float)


def stable(raw: np.ndarray) -> np.ndarray:
    """Free numbers to coefficients of a stable polynomial, through partial autocorrelations; row by row."""
    partial = raw / np.sqrt(1 + raw**2)
    out = partial[:, :1]
    for k in range(1, raw.shape[1]):
        r = partial[:, k : k + 1]
        out = np.concatenate([out - r * out[:, ::-1], r], axis=1)
    return out if raw.shape[1] else raw


@dataclass
class Fit:
    order: Order
    seasonal: Seasonal
    drift: float
    beta: np.ndarray
    ar: np.ndarray  # of the product phi Phi, constant first
    ma: np.ndarray
    sigma2: float
    aicc: float
    resid: np.ndarray  # in line with the series; nan where the past is too short
    converged: bool
    n_missing: int
    y: np.ndarray
    x: np.ndarray

    def forecast(self, steps: int, confidence: float, future: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(mean, lower, upper) for the steps after the series."""
        s = self.seasonal[3]
        full = np.convolve(self.ar, difference_poly(self.order[1], self.seasonal[1], max(s, 1)))
        level = self.drift * self.ar.sum()
        u = np.concatenate([self.y - self.x @ self.beta, np.zeros(steps)])
        e = np.concatenate([np.nan_to_num(self.resid), np.zeros(steps)])
        n = len(self.y)
        for t in range(n, n + steps):
            back = sum(full[k] * u[t - k] for k in range(1, min(len(full) - 1, t) + 1))
            shocks = sum(self.ma[k] * e[t - k] for k in range(1, min(len(self.ma) - 1, t) + 1))
            u[t] = level - back + shocks
        psi = np.zeros(steps)
        for h in range(steps):
            psi[h] = (self.ma[h] if h < len(self.ma) else 0.0) - sum(full[k] * psi[h - k] for k in range(1, min(h, len(full) - 1) + 1))
        mean = u[n:] + (0 if future is None or not len(self.beta) else np.asarray(future, dtype=float) @ self.beta)
        width = NormalDist().inv_cdf(0.5 + confidence / 2) * np.sqrt(self.sigma2 * np.cumsum(psi**2))
        return mean, mean - width, mean + width


def fit(
    y: np.ndarray,
    order: Order,
    seasonal: Seasonal = (0, 0, 0, 0),
    x: np.ndarray | None = None,
    stationary: bool = False,
    invertible: bool = True,
    max_iterations: int = 200,
) -> Fit:
    """Raises ValueError if the series is too short for its order."""
    y, n_missing = interpolated(np.asarray(y, dtype=float))
    x = np.zeros((len(y), 0)) if x is None else np.nan_to_num(np.asarray(x, dtype=float)).reshape(len(y), -1)
    (p, d, q), (sp, sd, sq, s) = order, seasonal
    if s < 2:
        sp = sd = sq = 0
    poly = difference_poly(d, sd, max(s, 1))
    lost = len(poly) - 1
    if len(y) - lost < 2:
        raise ValueError("the series is too short to be differenced")
    w, z = filtered(y, poly), np.column_stack([filtered(c, poly) for c in x.T]) if x.shape[1] else np.zeros((len(y) - lost, 0))
    k = 1 + x.shape[1]
    sizes = np.cumsum([k, p, q, sp, sq])
    reach = p + s * sp
    if len(w) - reach < sizes[-1] + 2:
        raise ValueError("the series is too short for the order")
    scale = float(w.std()) or 1.0
    spread = z.std(axis=0) if x.shape[1] else np.zeros(0)
    regressors = np.column_stack([np.ones(len(w)), z / np.where(spread > 0, spread, 1.0)])
    target = w / scale

    def polys(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The products of both pairs of polynomials, for each row of parameters."""
        parts = [b[:, i:j] for i, j in zip(sizes[:-1], sizes[1:], strict=True)]
        phi, theta, seas_phi, seas_theta = (stable(v) if on else v for v, on in zip(parts, (stationary, invertible, stationary, invertible), strict=True))

        def product(near: np.ndarray, far: np.ndarray, sign: float) -> np.ndarray:
            out = np.zeros((len(b), near.shape[1] + s * far.shape[1] + 1))
            one = np.column_stack([np.ones(len(b)), sign * near])
            out[:, : near.shape[1] + 1] = one
            for i in range(far.shape[1]):
                at = s * (i + 1)
                out[:, at : at + near.shape[1] + 1] += sign * far[:, i : i + 1] * one
            return out

        return product(phi, seas_phi, -1.0), product(theta, seas_theta, 1.0)

    def errors(b: np.ndarray) -> np.ndarray:
        ar, ma = polys(b)
        v = target - b[:, :k] @ regressors.T
        n = v.shape[1]
        a = sum(ar[:, j : j + 1] * v[:, reach - j : n - j] for j in range(ar.shape[1]) if ar[:, j].any())
        lags = [j for j in range(1, ma.shape[1]) if ma[:, j].any()]
        if not lags:
            return a
        e = np.zeros((len(b), lags[-1] + a.shape[1]))
        weights, back = ma[:, lags], np.array(lags)
        with np.errstate(over="ignore", invalid="ignore"):
            for t in range(a.shape[1]):
                at = lags[-1] + t
                e[:, at] = a[:, t] - (weights * e[:, at - back]).sum(axis=1)
        return e[:, lags[-1] :]

    b = np.zeros(sizes[-1])
    b[:k] = np.linalg.lstsq(regressors, target, rcond=None)[0]
    b[k:] = 0.1
    e = errors(b[None])[0]
    cost, damping, converged = float(e @ e), 1e-2, False
    for _ in range(max_iterations):
        step = 1e-5 * np.maximum(1.0, np.abs(b))
        jacobian = ((errors(b + np.diag(step)) - e) / step[:, None]).T
        if not np.isfinite(jacobian).all():
            break
        gradient, normal = jacobian.T @ e, jacobian.T @ jacobian
        for _ in range(12):
            move = np.linalg.solve(normal + damping * (np.diag(np.diag(normal)) + 1e-8 * np.eye(len(b))), -gradient)
            tried = errors((b + move)[None])[0]
            new = float(tried @ tried)
            if np.isfinite(new) and new <= cost:
                break
            damping *= 4
        else:
            converged = True  # no step lowers the sum any more
            break
        gain, b, e, cost, damping = cost - new, b + move, tried, new, max(damping / 5, 1e-9)
        if gain <= 1e-8 * (cost + 1e-12):
            converged = True
            break
    ar, ma = (m[0] for m in polys(b[None]))
    if not (np.isfinite(b).all() and np.isfinite(cost)):
        raise ValueError("the fit diverged")
    sigma2 = cost / len(e) * scale**2
    beta = b[1:k] * scale / np.where(spread > 0, spread, 1.0) if k > 1 else np.zeros(0)
    resid = np.full(len(y), np.nan)
    resid[len(y) - len(e) :] = e * scale
    # All orders count with the series' whole length, so that their criteria compare.
    n, m = len(y), sizes[-1] + 1
    aicc = n * (np.log(2 * np.pi * max(sigma2, 1e-300)) + 1) + 2 * m + (2 * m * (m + 1) / (n - m - 1) if n > m + 1 else np.inf)
    return Fit(order, (sp, sd, sq, s), float(b[0] * scale), np.where(spread > 0, beta, 0.0) if k > 1 else beta, ar, ma, sigma2, float(aicc), resid, converged, n_missing, y, x)
