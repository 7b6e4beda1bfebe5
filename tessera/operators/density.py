"""Density of points at whole coordinates, counted on a raster: by sums along its rows, so that the work for a place grows with the radius and not
with the points around it."""

from __future__ import annotations

from math import isqrt

import numpy as np

LARGEST = 1 << 25  # places of a raster
BLOCK = 1 << 16  # places looked at at once


class Raster:
    """The places of points (x, y, z: integers) within a box with room for a radius around it, numbered by planes, rows and columns. `at` are the places
    with points, ascending, `of` is each point's number among them, `first` a place's point with the smallest name."""

    def __init__(self, x: np.ndarray, y: np.ndarray, z: np.ndarray, name: np.ndarray, radius: int):
        self.wide, self.high, self.deep = int(x.max() - x.min()) + 2 * radius + 1, int(y.max() - y.min()) + 2 * radius + 1, int(z.max() - z.min()) + 1
        self.plane = self.wide * self.high
        self.place = (z - z.min()).astype(np.int64) * self.plane + (y - y.min() + radius) * self.wide + (x - x.min() + radius)
        order = np.lexsort((name, self.place))
        new = np.r_[True, self.place[order][1:] != self.place[order][:-1]]
        self.first = order[new]
        self.at = self.place[self.first]
        self.of = np.empty(len(x), np.int64)
        self.of[order] = np.cumsum(new) - 1


def fits(x: np.ndarray, y: np.ndarray, z: np.ndarray, radius: int) -> bool:
    if not all(np.issubdtype(a.dtype, np.integer) for a in (x, y, z)) or not len(x):
        return False
    around = [int(a.max()) - int(a.min()) + 1 + 2 * radius * (a is not z) for a in (x, y, z)]
    return around[0] * around[1] * (3 * around[2]) <= LARGEST


def within(dz: int, xy_radius: int, z_radius: int) -> int:
    """The largest squared distance in the plane of an ellipsoid's points dz planes off."""
    return xy_radius * xy_radius * (z_radius * z_radius - dz * dz) // (z_radius * z_radius)


def counts(r: Raster, wanted: np.ndarray, xy_radius: int, z_radius: int) -> np.ndarray:
    """For each place with points, where wanted, how many points lie within the radii of it, its own included."""
    before = np.zeros(r.plane * r.deep + 1, np.int32)
    np.cumsum(np.bincount(r.place, minlength=r.plane * r.deep), out=before[1:])
    out = np.zeros(len(r.at), np.int64)
    which = np.flatnonzero(wanted)
    cut = np.searchsorted(r.at[which], np.arange(r.deep + 1) * r.plane)
    for k in range(r.deep):
        for a in range(cut[k], cut[k + 1], BLOCK):
            rows = which[a : min(a + BLOCK, cut[k + 1])]
            own, n = r.at[rows], np.zeros(len(rows), np.int64)
            for dz in range(-min(k, z_radius), min(r.deep - 1 - k, z_radius) + 1):
                most = within(dz, xy_radius, z_radius)
                for dy in range(-isqrt(most), isqrt(most) + 1):
                    half = isqrt(most - dy * dy)
                    at = own + (dz * r.plane + dy * r.wide)
                    n += before[at + (half + 1)]
                    n -= before[at - half]
            out[rows] = n
    return out


def neighbours(x: np.ndarray, y: np.ndarray, wanted: np.ndarray, radius: int) -> np.ndarray:
    """How many points lie within the radius of each, where wanted, itself included."""
    z = np.zeros(len(x), np.int64)
    r = Raster(x, y, z, z, radius)
    own = np.zeros(len(r.at), bool)
    own[r.of[wanted]] = True
    return counts(r, own, radius, 1)[r.of]


def followed(x: np.ndarray, y: np.ndarray, z: np.ndarray, name: np.ndarray, xy_radius: int, z_radius: int, core: np.ndarray) -> np.ndarray:
    """For each point of the core the row of the one it follows: the nearest denser one within the radii, of equally near ones the smaller name; its
    own for a peak and for points outside the core. A point is denser if more lie within the radii of it, or as many and its name is smaller.

    Points of one place are equally dense, so all but the smallest name follow that one, and places are settled by their first points: around a
    place other places are looked at in the order of their distance, the more distances at once the fewer places are left, until one is denser; few
    places need many."""
    r = Raster(x, y, z, name, xy_radius)
    box = [(a >= a[core].min() - xy_radius) & (a <= a[core].max() + xy_radius) for a in (x, y)]
    rho = np.r_[counts(r, (box[0] & box[1])[r.first], xy_radius, z_radius), 0]
    many = len(r.at)
    names = np.r_[name[r.first], np.iinfo(np.int64).max]
    up = np.arange(many + 1)
    reach = min(z_radius, r.deep - 1)
    number = np.full(r.plane * (r.deep + 2 * reach), many, np.int32)  # of the place, `many` where there is no point
    number[r.at + reach * r.plane] = np.arange(many)
    ways = []
    for dz in range(-reach, reach + 1):
        most = within(dz, xy_radius, z_radius)
        dy, dx = np.indices((2 * isqrt(most) + 1,) * 2).reshape(2, -1) - isqrt(most)
        dy, dx = dy[dy * dy + dx * dx <= most], dx[dy * dy + dx * dx <= most]
        ways.append(np.stack([z_radius**2 * (dy * dy + dx * dx) + xy_radius**2 * dz * dz, dz * r.plane + dy * r.wide + dx]))
    far, step = np.concatenate(ways, 1)
    order = np.argsort(far, kind="stable")
    far, step = far[order], step[order]
    ring = np.cumsum(np.r_[True, far[1:] != far[:-1]]) - 1  # of one distance; the first is the place itself
    end = np.r_[np.flatnonzero(ring[1:] != ring[:-1]) + 1, len(far)]
    own = np.zeros(many, bool)
    own[r.of[core]] = True
    left = np.flatnonzero(own)
    k, at_once = 1, 1 << 18
    while k < len(end) and len(left):
        a = end[k - 1]
        k = max(k + 1, int(np.searchsorted(end, a + at_once // len(left), "right")))
        b = end[k - 1]
        many_at_once = max(1, at_once // int(b - a))
        rest = []
        for begin in range(0, len(left), many_at_once):
            part = left[begin : begin + many_at_once]
            near = number[(r.at[part] + reach * r.plane)[:, None] + step[a:b]]
            dense, own_rho = rho[near], rho[part][:, None]
            able = dense > own_rho
            row, column = np.nonzero(dense == own_rho)
            able[row, column] = names[near[row, column]] < names[part[row]]
            hit = able.any(1)
            if hit.any():
                able, own_ring = able[hit], ring[a:b]
                able &= own_ring == own_ring[able.argmax(1)][:, None]
                best = np.where(able, names[near[hit]], np.iinfo(np.int64).max).argmin(1)
                up[part[hit]] = near[hit][np.arange(len(best)), best]
            rest.append(part[~hit])
        left = np.concatenate(rest)
    head = r.first[r.of]
    out = np.where(np.arange(len(x)) == head, r.first[up[:-1]][r.of], head)
    return np.where(core, out, np.arange(len(x)))
