"""Plain numpy/pandas versions of the operators, written from the formulas, for comparison."""

import math

import numpy as np
import pandas as pd


def zscore(v, t=3.0):
    sd = v.std()
    return np.zeros(len(v), bool) if sd == 0 else np.abs(v - v.mean()) / sd > t


def modified_zscore(v, t=3.5):
    med = np.median(v)
    mad = np.median(np.abs(v - med))
    return np.zeros(len(v), bool) if mad == 0 else 0.6745 * np.abs(v - med) / mad > t


def iqr(v, k=1.5):
    q1, q3 = np.percentile(v, [25, 75])
    return (v < q1 - k * (q3 - q1)) | (v > q3 + k * (q3 - q1))


def moving_average(v, w=10, t=3.0):
    if len(v) < w:
        return np.zeros(len(v), bool)
    rolled = pd.Series(v).rolling(w, center=True)
    ma, sd = rolled.mean(), rolled.std()
    ma, sd = ma.fillna(ma.mean()).to_numpy(), sd.fillna(sd.std(ddof=0)).to_numpy()
    sd[sd < 1e-12 * np.maximum(1, np.abs(ma))] = 1
    return np.abs(v - ma) / sd > t


def ema(v, span=10):
    return pd.Series(v).ewm(span=span).mean().to_numpy()


def ema_flags(v, span=10, t=3.0):
    r = v - ema(v, span)
    return np.zeros(len(v), bool) if r.std() < 1e-12 else np.abs(r) > t * r.std()


def seasonal_residual(v, p=24):
    n, h = len(v), p // 2
    weights = np.ones(p) / p if p % 2 else np.r_[0.5, np.ones(p - 1), 0.5] / p
    trend = np.full(n, np.nan)
    trend[h:n - h] = np.convolve(v, weights, "valid")
    first, last = h, n - 1 - h
    for a, b, fill in ((first, min(first + p, last), range(first)),
                       (max(first, last - p), last, range(last + 1, n))):
        slope, start = np.polyfit(np.arange(a, b), trend[a:b], 1)
        for i in fill:
            trend[i] = slope * i + start
    flat = v - trend
    means = np.array([flat[j::p].mean() for j in range(p)])
    return flat - (means - means.mean())[np.arange(n) % p]


def seasonal(v, p=24, t=3.0):
    if len(v) < 2 * p:
        return zscore(v, t)
    r = seasonal_residual(v, p)
    return np.zeros(len(v), bool) if r.std() < 1e-12 else np.abs(r - r.mean()) > t * r.std()


def vote(v):
    return sum(f(v).astype(int) for f in (zscore, modified_zscore, iqr, moving_average, ema_flags)) >= 2.5


def features(v, w=10):
    rows = []
    for i in range(w, len(v)):
        b = v[i - w:i]
        rows.append([v[i], b.mean(), b.std(), b.min(), b.max(), np.median(b), v[i] - v[i - 1],
                     v[i] - b.mean(), v[i - 1], v[i - 2], v[i - 5]])
    return np.array(rows).reshape(-1, 11)


def scaled(x):
    sd = x.std(axis=0)
    sd[sd <= 1e-12 * np.maximum(1, np.abs(x.mean(axis=0)))] = 1
    return (x - x.mean(axis=0)) / sd


def cut(score, w, n, contamination=0.1):
    out = np.zeros(n, bool)
    out[w:] = score > np.percentile(score, 100 * (1 - contamination))
    return out


def t_tail(t, df):
    """P(T > t) by Simpson's rule over the density, with x = tan u."""
    u = np.linspace(math.atan(t), math.pi / 2, 20_001)[:-1]
    log_c = math.lgamma((df + 1) / 2) - math.lgamma(df / 2) - math.log(df * math.pi) / 2
    y = np.exp(log_c - (df + 1) / 2 * np.log1p(np.tan(u) ** 2 / df)) / np.cos(u) ** 2
    y = np.append(y, 0.0 if df > 1 else math.exp(log_c) * df)
    h = (math.pi / 2 - math.atan(t)) / 20_000
    return h / 3 * (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum())


def grubbs_critical(n, alpha):
    """(n - 1) / sqrt(n) sqrt(t^2 / (n - 2 + t^2)) with the upper alpha / 2n point t, found by bisection."""
    low, high = 0.0, 1.0
    while t_tail(high, n - 2) > alpha / (2 * n):
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if t_tail(mid, n - 2) > alpha / (2 * n) else (low, mid)
    return (n - 1) / math.sqrt(n) * math.sqrt(low * low / (n - 2 + low * low))


def grubbs(v, alpha=0.05):
    out, rest = np.zeros(len(v), bool), v.copy()
    while len(rest) > 2 and rest.std() > 0:
        apart = np.abs(rest - rest.mean())
        j = int(apart.argmax())
        if apart[j] / rest.std() <= grubbs_critical(len(rest), alpha):
            break
        out[np.flatnonzero(v == rest[j])[0]] = True
        rest = np.delete(rest, j)
    return out


def hbos_scores(v, w=10, bins=10):
    x = scaled(features(v, w))
    total = np.zeros(len(x))
    for column in x.T:
        density, edges = np.histogram(column, bins, density=True)
        total -= np.log2(density[np.clip(np.digitize(column, edges) - 1, 0, bins - 1)] + 0.1)
    return total


def pca_scores(v, w=10):
    x = features(v, w)
    x = x - x.mean(axis=0)
    axes = np.linalg.svd(x, full_matrices=False)[2][:3]
    return ((x - x @ axes.T @ axes) ** 2).mean(axis=1)


def neighbour_scores(v, w=10, k=5, lof=20):
    x = scaled(features(v, w))
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(dist, np.inf)
    m = len(x)
    order = np.argsort(dist, axis=1, kind="stable")
    near = np.take_along_axis(dist, order, axis=1)
    kk = min(lof, m - 1)
    ids, ds = order[:, :kk], near[:, :kk]
    density = 1 / (np.maximum(ds[:, -1][ids], ds).mean(axis=1) + 1e-10)
    return near[:, min(k, m - 1) - 1], density[ids].mean(axis=1) / density
