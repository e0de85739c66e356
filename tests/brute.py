"""Small sequential models of the contract, used as oracles on fixtures."""

import numpy as np


def distances(x, metric="euclidean"):
    diff = x[:, None, :] - x[None, :, :]
    if metric == "manhattan":
        return np.abs(diff).sum(axis=2)
    return np.sqrt((diff * diff).sum(axis=2))


def dbscan(x, eps, min_samples, metric="euclidean"):
    """Labels and core flags by visiting core rows in order."""
    x = np.asarray(x, dtype=float)
    close = distances(x, metric) <= eps
    core = close.sum(axis=1) >= min_samples
    label = np.full(len(x), -1)
    cluster = 0
    for i in np.flatnonzero(core):
        if label[i] != -1:
            continue
        stack = [i]
        label[i] = cluster
        while stack:
            p = stack.pop()
            for q in np.flatnonzero(close[p]):
                if label[q] == -1:
                    label[q] = cluster
                    if core[q]:
                        stack.append(q)
        cluster += 1
    return label, core


def kmeans(x, centers, max_iter=300, tol=1e-4):
    x, centers = np.asarray(x, float), np.asarray(centers, float)
    label = np.zeros(len(x), dtype=int)
    for _ in range(max_iter):
        old = centers.copy()
        d = np.sqrt(((x[:, None, :] - old[None]) ** 2).sum(axis=2))
        label = d.argmin(axis=1)
        for k in range(len(centers)):
            if (label == k).any():
                centers[k] = x[label == k].mean(axis=0)
        if np.sqrt(((centers - old) ** 2).sum(axis=1)).max() < tol:
            break
    inertia = ((x - centers[label]) ** 2).sum()
    return centers, label, inertia


def seed_plus_plus(x, k, state=None):
    x = np.asarray(x, float)
    n = len(x)
    centers = [x[(42 if state is None else state) % n]]
    for c in range(1, k):
        d2 = np.min([((x - m) ** 2).sum(axis=1) for m in centers], axis=0)
        total = d2.sum()
        if total > 0:
            target = (42 + c if state is None else state) / float(2**64 - 1) * total
            centers.append(x[int(np.argmax(np.cumsum(d2) >= target))])
        else:
            centers.append(x[(23 * c + 17) % n])
    return np.array(centers)


def logistic_gd(x, y, lr=0.01, steps=1000, tol=1e-6, intercept=True):
    x, y = np.asarray(x, float), np.asarray(y, float)
    if intercept:
        x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    previous, calm = np.inf, 0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ w)))
        q = np.clip(p, 1e-15, 1 - 1e-15)
        cost = -(y * np.log(q) + (1 - y) * np.log(1 - q)).mean()
        calm = calm + 1 if abs(previous - cost) < tol else 0
        if calm > 10:
            break
        w = w - lr * x.T @ (p - y) / len(y)
        previous = cost
    return w
