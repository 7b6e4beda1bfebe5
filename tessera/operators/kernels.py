"""Kernels on whole small images, for what DataFrame operators can't express: each image is one group, so Spark
spreads the images over its tasks and a task holds one image at a time."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd


def grid(p: pd.DataFrame, value: str = "v", shape: tuple[int, int] | None = None) -> np.ndarray:
    """An image from its pixels, 0 where there is none; of the given shape, or as large as its last pixel."""
    out = np.zeros(shape or (int(p.y.max()) + 1, int(p.x.max()) + 1))
    out[p.y.to_numpy(int), p.x.to_numpy(int)] = p[value].to_numpy(float)
    return out


def links(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (of row numbers) of places, distinct rows of integers, that differ by at most 1 in each coordinate."""
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = at - at.min(0) + 1
    size = at.max(0) + 2
    code = np.ravel_multi_index(tuple(at.T), tuple(size))
    order = np.argsort(code)
    code = code[order]
    a, b = [], []
    steps = np.indices((3,) * at.shape[1]).reshape(at.shape[1], -1).T - 1
    for step in steps[len(steps) // 2 + 1 :]:  # each pair once
        to = code + int(np.ravel_multi_index(tuple(step + 1), tuple(size)) - np.ravel_multi_index((1,) * at.shape[1], tuple(size)))
        k = np.minimum(np.searchsorted(code, to), len(code) - 1)
        found = code[k] == to
        a.append(order[found])
        b.append(order[k[found]])
    return np.concatenate(a), np.concatenate(b)


def united(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n rows the least row it is connected to by the pairs."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while (new[new] != new).any():
            new = new[new]
        new = new[root]
        if (new == root).all():
            return root
        root = new


def labels(at: np.ndarray) -> np.ndarray:
    """For each place the number of a place of its component, the same for all of it."""
    return united(len(at), *links(at))


def regional_maxima(at: np.ndarray, value: np.ndarray, threshold: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(z, y, x, voxels, a row of it) of each set of connected voxels of one value above the threshold without a higher neighbour."""
    a, b = links(at)
    same = value[a] == value[b]
    root = united(len(at), a[same], b[same])
    lower = np.r_[a[value[a] < value[b]], b[value[b] < value[a]]]
    top = value > threshold
    top[np.isin(root, root[lower])] = False
    out = []
    for r in np.unique(root[top]).tolist():
        rows = np.flatnonzero(root == r)
        out.append((*(int(c) for c in np.floor(at[rows].mean(0) + 0.5)), len(rows), r))
    return out


def pixels(a: np.ndarray, name: str = "v") -> pd.DataFrame:
    y, x = np.indices(a.shape)
    return pd.DataFrame({"y": y.ravel(), "x": x.ravel(), name: a.ravel()})


def register(fixed: np.ndarray, moving: np.ndarray) -> tuple[int, int, float]:
    """(dy, dx, phase): the circular shift that brings moving onto fixed, at the largest absolute cross-correlation; the first in
    column order where there are ties."""
    c = np.fft.ifft2(np.fft.fft2(fixed) * np.conj(np.fft.fft2(moving)))
    size = np.round(np.abs(c), 6)
    k = int(np.argmax(size.T))
    dx, dy = divmod(k, size.shape[0])
    wrap = lambda d, n: d if d < (n + 1) // 2 else d - n
    return wrap(dy, size.shape[0]), wrap(dx, size.shape[1]), float(np.angle(c[dy, dx]))


def volume(p: pd.DataFrame, shape: tuple[int, int, int], value: str = "v") -> np.ndarray:
    out = np.zeros(shape)
    out[p.z.to_numpy(int), p.y.to_numpy(int), p.x.to_numpy(int)] = p[value].to_numpy(float)
    return out


def register_volumes(fixed: np.ndarray, moving: np.ndarray) -> tuple[int, ...]:
    """The circular shift in each axis that brings moving onto fixed, at the largest absolute cross-correlation (the first in the axes'
    order where there are ties)."""
    c = np.fft.ifftn(np.fft.fftn(fixed) * np.conj(np.fft.fftn(moving)))
    at = np.unravel_index(int(np.argmax(np.round(np.abs(c), 6))), c.shape)
    return tuple(int(d if d < (n + 1) // 2 else d - n) for d, n in zip(at, c.shape))


def _near(a: np.ndarray, offsets, fill: float, agg) -> np.ndarray:
    r = max(max(abs(i), abs(j)) for i, j in offsets)
    p = np.pad(a, r, constant_values=fill)
    return agg([p[r + i : r + i + a.shape[0], r + j : r + j + a.shape[1]] for i, j in offsets], axis=0)


def disk(radius: int) -> list[tuple[int, int]]:
    r = range(-radius, radius + 1)
    return [(i, j) for i in r for j in r if i * i + j * j <= radius * radius]


def erode(a: np.ndarray, radius: int) -> np.ndarray:
    return _near(a, disk(radius), np.inf, np.min)


def dilate(a: np.ndarray, radius: int) -> np.ndarray:
    return _near(a, disk(radius), -np.inf, np.max)


def reconstruct(seed: np.ndarray, under: np.ndarray) -> np.ndarray:
    """The seed grown by its neighbours for as long as it stays under an image."""
    now = np.minimum(seed, under)
    square = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    while True:
        grown = np.minimum(_near(now, square, -np.inf, np.max), under)
        if (grown == now).all():
            return now
        now = grown


def remove_background(a: np.ndarray, radius: int) -> np.ndarray:
    """An image less its opening by reconstruction, plus its top-hat, less its bottom-hat, within 0 to 255."""
    flat = a - reconstruct(erode(a, radius), a)
    opened, closed = dilate(erode(flat, radius), radius), erode(dilate(flat, radius), radius)
    return np.clip(flat + (flat - opened) - (closed - flat), 0, 255)


def watershed(height: np.ndarray, markers: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Labels flooded from markers in the order of height, with lines of 0 where two meet."""
    out, h, w = markers.astype(int).copy(), *height.shape
    done = out > 0
    heap: list = []
    order = 0

    def push(y, x):
        nonlocal order
        for i, j in ((-1, 0), (1, 0), (0, -1), (0, 1)):
            a, b = y + i, x + j
            if 0 <= a < h and 0 <= b < w and mask[a, b] and not done[a, b]:
                done[a, b] = True
                heapq.heappush(heap, (height[a, b], order, a, b))
                order += 1

    for y, x in zip(*np.nonzero(out)):
        push(y, x)
    while heap:
        _, _, y, x = heapq.heappop(heap)
        near = {out[a, b] for a, b in ((y - 1, x), (y + 1, x), (y, x - 1), (y, x + 1)) if 0 <= a < h and 0 <= b < w and out[a, b] > 0}
        if len(near) == 1:
            out[y, x] = near.pop()
            push(y, x)
    return out


def fill_holes(mask: np.ndarray) -> np.ndarray:
    """A mask with what its background can't reach from the border filled in."""
    open_ = ~mask.astype(bool)
    edge = np.zeros_like(open_)
    edge[[0, -1], :] = edge[:, [0, -1]] = True
    seed = np.where(open_ & edge, 1.0, 0.0)
    cross = [(0, 0), (-1, 0), (1, 0), (0, -1), (0, 1)]
    while True:
        grown = np.where(open_, _near(seed, cross, 0, np.max), 0)
        if (grown == seed).all():
            return seed == 0
        seed = grown


def match_histogram(a: np.ndarray, like: np.ndarray, bins: int = 64) -> np.ndarray:
    """Values moved so that their distribution over bins is nearest to another image's."""
    low, high = 0.0, max(a.max(), like.max(), 1.0)
    cut = lambda v: np.minimum((v - low) / (high - low) * bins, bins - 1).astype(int)
    ca, cl = (np.cumsum(np.bincount(cut(v).ravel(), minlength=bins)) / v.size for v in (a, like))
    to = np.abs(ca[:, None] - cl[None, :]).argmin(1)
    return (to[cut(a)] + 0.5) / bins * (high - low) + low


def demons(fixed: np.ndarray, moving: np.ndarray, rounds: int = 10, smooth: int = 1) -> np.ndarray:
    """The displacement (2, rows, columns) that carries moving onto fixed: steps along fixed's gradient by the difference, smoothed by
    a box after each."""
    gy, gx = np.gradient(fixed)
    y, x = np.indices(fixed.shape)
    u = np.zeros((2, *fixed.shape))
    for _ in range(rounds):
        at = np.clip(np.round(y + u[0]), 0, fixed.shape[0] - 1).astype(int), np.clip(np.round(x + u[1]), 0, fixed.shape[1] - 1).astype(int)
        gap = moving[at] - fixed
        size = gy * gy + gx * gx + gap * gap
        step = np.where(size > 1e-9, -gap / np.maximum(size, 1e-9), 0)
        u += np.stack([step * gy, step * gx])
        square = [(i, j) for i in range(-smooth, smooth + 1) for j in range(-smooth, smooth + 1)]
        u = np.stack([_near(np.pad(c, smooth, mode="edge"), square, 0, np.mean)[smooth:-smooth, smooth:-smooth] for c in u])
    return u


def hull(x: np.ndarray, y: np.ndarray) -> list[tuple[float, float]]:
    """The corners of the convex hull of points, by angle around their mean."""
    pts = sorted(set(zip(x.tolist(), y.tolist())))
    if len(pts) < 3:
        return pts

    def chain(ps):
        out: list = []
        for p in ps:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    corners = chain(pts) + chain(pts[::-1])
    cx, cy = sum(p[0] for p in corners) / len(corners), sum(p[1] for p in corners) / len(corners)
    return sorted(corners, key=lambda p: (math.atan2(p[1] - cy, p[0] - cx), p))


def median(a: np.ndarray, size: int) -> np.ndarray:
    """The median of the size by size pixels around each pixel, with zeros beyond the edge; an even window reaches a pixel farther down
    and to the right."""
    before = (size - 1) // 2
    p = np.pad(a, ((before, size - 1 - before),) * 2)
    return np.median(np.lib.stride_tricks.sliding_window_view(p, (size, size)), axis=(2, 3))
