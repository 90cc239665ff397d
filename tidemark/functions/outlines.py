"""Outlines of small groups of edges, a batch of groups at a time: what `operators.arrangement`
and `operators.geometry` do over rows of edges, for groups that fit one task many times over."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import RINGS

#: Decimals that vertices are rounded to, and how near a vertex may come to an edge without
#: cutting it, as in `operators.arrangement`.
DECIMALS, NEAR = 9, 1.5e-9
#: Pairs of edges that are compared at once.
PAIRS = 500_000

OUTLINE = T.StructType([T.StructField("rings", RINGS), T.StructField("open", T.BooleanType())])


def spans(first: np.ndarray, last: np.ndarray, most: int = PAIRS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) for all j from ``first[i]`` up to but not ``last[i]``, some ``most`` at a
    time; the pairs of one i are never parted."""
    n = np.maximum(last - first, 0)
    ends = np.cumsum(n)
    at = 0
    while at < len(n):
        done = ends[at - 1] if at else 0
        stop = max(int(np.searchsorted(ends, done + most, side="right")), at + 1)
        k = n[at:stop]
        i = np.repeat(np.arange(at, stop), k)
        yield i, first[i] + np.arange(len(i)) - np.repeat(np.cumsum(k) - k, k)
        at = stop


def bounds_of(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the run of each row's group starts and ends in sorted ``g``."""
    return np.searchsorted(g, g, side="left"), np.searchsorted(g, g, side="right")


def _merged(g: np.ndarray, e: np.ndarray, net: np.ndarray, parity: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges from their lesser end to the greater, ``net`` times; those that cancel are gone."""
    e = np.round(e, DECIMALS) + 0.0
    kept = ((e[:, 0] != e[:, 2]) | (e[:, 1] != e[:, 3])) & np.isfinite(e).all(axis=1)
    g, e, net = g[kept], e[kept], net[kept]
    back = (e[:, 0] > e[:, 2]) | ((e[:, 0] == e[:, 2]) & (e[:, 1] > e[:, 3]))
    e = np.where(back[:, None], e[:, [2, 3, 0, 1]], e)
    net = np.where(back, -net, net)
    order = np.lexsort((e[:, 3], e[:, 2], e[:, 1], e[:, 0], g))
    g, e, net = g[order], e[order], net[order]
    if not len(g):
        return g, e, net
    new = np.append(True, (g[1:] != g[:-1]) | (e[1:] != e[:-1]).any(axis=1))
    g, e, net = g[new], e[new], np.add.reduceat(net, np.flatnonzero(new))
    kept = net % 2 != 0 if parity else net != 0
    return g[kept], e[kept], net[kept]


def _turn(ax, ay, bx, by, x, y):
    """Positive where (x, y) lies left of a -> b."""
    return (bx - ax) * (y - ay) - (by - ay) * (x - ax)


def _vertex_on(i: np.ndarray, s: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges ``i`` with ends ``s`` and the vertices that lie on their inside."""
    x0, y0, x1, y1 = s.T
    dx, dy = x1 - x0, y1 - y0
    length = np.hypot(dx, dy)
    along = ((x - x0) * dx + (y - y0) * dy) / length
    on = (np.abs(_turn(x0, y0, x1, y1, x, y)) / length <= NEAR) & (along > 0) & (along < length)
    on &= (np.hypot(x - x0, y - y0) > NEAR) & (np.hypot(x - x1, y - y1) > NEAR)
    return i[on], np.column_stack([x[on], y[on]])


def _cuts(g: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges to be cut and where: at a vertex of another that comes within ``NEAR`` of their
    inside, and where both cross inside."""
    low, high = np.minimum(e[:, 1], e[:, 3]), np.maximum(e[:, 1], e[:, 3])
    ids, points = [], []
    for i, j in spans(np.arange(len(g)) + 1, bounds_of(g)[1]):
        near = (e[i, 0] <= e[j, 2] + NEAR) & (e[j, 0] <= e[i, 2] + NEAR) & (low[i] <= high[j] + NEAR) & (low[j] <= high[i] + NEAR)
        i, j = i[near], j[near]
        a, b = e[i], e[j]
        with np.errstate(divide="ignore", invalid="ignore"):
            den = (a[:, 2] - a[:, 0]) * (b[:, 3] - b[:, 1]) - (a[:, 3] - a[:, 1]) * (b[:, 2] - b[:, 0])
            t = ((b[:, 0] - a[:, 0]) * (b[:, 3] - b[:, 1]) - (b[:, 1] - a[:, 1]) * (b[:, 2] - b[:, 0])) / den
            u = ((b[:, 0] - a[:, 0]) * (a[:, 3] - a[:, 1]) - (b[:, 1] - a[:, 1]) * (a[:, 2] - a[:, 0])) / den
            p = np.round(np.column_stack([a[:, 0] + t * (a[:, 2] - a[:, 0]), a[:, 1] + t * (a[:, 3] - a[:, 1])]), DECIMALS) + 0.0
            inside = (den != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1)
            for s in (a, b):
                for k in (0, 2):
                    inside &= np.hypot(p[:, 0] - s[:, k], p[:, 1] - s[:, k + 1]) > NEAR
        found = [
            _vertex_on(i, a, b[:, 0], b[:, 1]), _vertex_on(i, a, b[:, 2], b[:, 3]),
            _vertex_on(j, b, a[:, 0], a[:, 1]), _vertex_on(j, b, a[:, 2], a[:, 3]),
            (i[inside], p[inside]), (j[inside], p[inside]),
        ]
        ids += [f[0] for f in found]
        points += [f[1] for f in found]
    return (np.concatenate(ids), np.vstack(points)) if ids else (np.empty(0, int), np.empty((0, 2)))


def _pieces(g: np.ndarray, e: np.ndarray, parity: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges cut until they meet at their ends only; pieces drawn twice merge."""
    g, e, net = _merged(g, e, np.ones(len(g), int), parity)
    while True:
        ids, points = _cuts(g, e)
        if not len(ids):
            return g, e, net
        hit = np.unique(ids)
        # each cut edge from end to end, its points by their way along it
        row = np.concatenate([ids, hit, hit])
        at = np.vstack([points, e[hit, :2], e[hit, 2:]])
        along = np.abs(at[:, 0] - e[row, 0]) + np.abs(at[:, 1] - e[row, 1])
        along[len(ids) :] = np.repeat([-1.0, np.inf], len(hit))
        order = np.lexsort((at[:, 1], at[:, 0], along, row))
        row, at = row[order], at[order]
        on = row[1:] == row[:-1]
        parts = np.hstack([at[:-1][on], at[1:][on]])
        of = row[:-1][on]
        whole = np.ones(len(g), bool)
        whole[hit] = False
        g, e, net = _merged(
            np.concatenate([g[whole], g[of]]), np.vstack([e[whole], parts]), np.concatenate([net[whole], net[of]]), parity
        )


def _left_cover(g: np.ndarray, e: np.ndarray, net: np.ndarray) -> np.ndarray:
    """How often the area left of each piece is covered: the sum of what is crossed on the way
    to its middle, from below or, for an upright piece, from the west."""
    upright = e[:, 0] == e[:, 2]
    mx, my = (e[:, 0] + e[:, 2]) / 2, (e[:, 1] + e[:, 3]) / 2
    low, high = np.minimum(e[:, 1], e[:, 3]), np.maximum(e[:, 1], e[:, 3])
    total = np.where(upright, 0, net)
    with np.errstate(divide="ignore", invalid="ignore"):
        slope = (e[:, 3] - e[:, 1]) / (e[:, 2] - e[:, 0])
        for i, j in spans(*bounds_of(g)):
            up = upright[i]
            under = ~up & (e[j, 0] <= mx[i]) & (mx[i] < e[j, 2]) & (e[j, 1] + (mx[i] - e[j, 0]) * slope[j] < my[i])
            x = np.where(upright[j], e[j, 0], e[j, 0] + (my[i] - e[j, 1]) / slope[j])
            west = up & (low[j] <= my[i]) & (my[i] < high[j]) & (x < mx[i])
            step = np.where(under, net[j], np.where(west, np.where(e[j, 3] > e[j, 1], -net[j], net[j]), 0))
            step[i == j] = 0
            total += np.bincount(i, step, len(g)).astype(int)
    return total


def _outline(g: np.ndarray, e: np.ndarray, parity: bool) -> tuple[np.ndarray, np.ndarray]:
    """Directed edges of the covered area, which lies on their left."""
    g, e, net = _pieces(g, e, parity)
    left = _left_cover(g, e, net)
    right = left - net
    inner, outer = (left % 2 != 0, right % 2 != 0) if parity else (left > 0, right > 0)
    e = np.where(inner[:, None], e, e[:, [2, 3, 0, 1]])
    return g[inner != outer], e[inner != outer]


def _successors(g: np.ndarray, e: np.ndarray) -> np.ndarray:
    """The next edge of each, -1 without one: where several leave a point, the sharpest left turn."""
    n = len(g)
    place = np.column_stack([np.concatenate([g, g]), np.concatenate([e[:, 0], e[:, 2]]), np.concatenate([e[:, 1], e[:, 3]])])
    order = np.lexsort(place.T[::-1])
    new = np.append(True, (place[order][1:] != place[order][:-1]).any(axis=1))
    point = np.empty(2 * n, int)
    point[order] = np.cumsum(new)
    start, end = point[:n], point[n:]
    leaving = np.argsort(start, kind="stable")
    heading = np.arctan2(e[:, 3] - e[:, 1], e[:, 2] - e[:, 0])
    nxt = np.full(n, -1)
    for i, k in spans(np.searchsorted(start[leaving], end, "left"), np.searchsorted(start[leaving], end, "right")):
        j = leaving[k]
        turn = np.mod(heading[j] - heading[i] + np.pi, 2 * np.pi)
        best = np.lexsort((j, turn, i))
        nxt[i[best]] = j[best]  # the last of each i stays
    return nxt


def _walked(nxt: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest id of each edge's ring, the steps to it and whether the chain is open, by doubling."""
    ring, steps, opened = np.arange(len(nxt)), np.zeros(len(nxt), int), np.zeros(len(nxt), bool)
    reach = 1
    while True:
        some = nxt >= 0
        nearer = some & (ring[nxt] < ring)
        now = opened | ~some | opened[nxt]
        moved = nearer.any() or (now != opened).any()
        ring, steps = np.where(nearer, ring[nxt], ring), np.where(nearer, steps[nxt] + reach, steps)
        nxt, opened, reach = np.where(some, nxt[nxt], -1), now, reach * 2
        if not moved:
            return ring, steps, opened


def _rings(g: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ring, steps to its smallest id and whether the chain is open, per edge. A ring that comes
    back to a point is cut there: each edge into the point goes on with the one that left it a
    visit earlier."""
    if not len(g):
        return np.empty(0, int), np.empty(0, int), np.empty(0, bool)
    nxt = _successors(g, e)
    ring, steps, opened = _walked(nxt)
    order = np.lexsort((-steps, e[:, 1], e[:, 0], ring))
    order = order[~opened[order]]
    same = (ring[order][1:] == ring[order][:-1]) & (e[order][1:, :2] == e[order][:-1, :2]).all(axis=1)
    if not same.any():
        return ring, steps, opened
    run = np.cumsum(np.append(True, ~same)) - 1
    last = order[np.append(np.flatnonzero(~same), len(order) - 1)]
    turned = np.arange(len(g))
    turned[order] = np.where(np.append(False, same), np.append(-1, order[:-1]), last[run])
    return _walked(np.where(nxt >= 0, turned[nxt], -1))


def _homes(g: np.ndarray, e: np.ndarray, ring: np.ndarray, holes: np.ndarray, corner: np.ndarray, hole_g: np.ndarray) -> np.ndarray:
    """The shell of each hole, -1 without one: the ring next to the west of its least vertex, or
    that ring's shell if it is a hole too."""
    at = np.searchsorted(g, hole_g, "left"), np.searchsorted(g, hole_g, "right")
    home = np.full(len(holes), -1)
    for i, j in spans(*at):
        px, py = corner[i].T
        met = (ring[j] != holes[i]) & ((e[j, 1] <= py) != (e[j, 3] <= py))
        i, j, px, py = i[met], j[met], px[met], py[met]
        x = e[j, 0] + (py - e[j, 1]) * (e[j, 2] - e[j, 0]) / (e[j, 3] - e[j, 1])
        west = x <= px
        i, j, x = i[west], j[west], x[west]
        best = np.lexsort((x, i))
        home[i[best]] = ring[j[best]]
    of = dict(zip(holes.tolist(), home.tolist()))
    while (again := np.isin(home, holes)).any():
        home = np.where(again, [of.get(h, -1) for h in home.tolist()], home)
    return home


def _placed(n: int, g: np.ndarray, e: np.ndarray) -> pa.Array:
    """``OUTLINE`` of ``n`` groups from their outline: shells by area, each with its holes by area."""
    ring, steps, opened = _rings(g, e)
    is_open = np.zeros(n, bool)
    is_open[g[opened]] = True
    order = np.lexsort((-steps, ring))
    order = order[~opened[order]]
    g, e, ring = g[order], e[order], ring[order]
    starts = np.flatnonzero(np.append(True, ring[1:] != ring[:-1])) if len(ring) else np.empty(0, int)
    ends = np.append(starts, len(ring))[1:]
    ids, rg = ring[starts], g[starts]
    # rings lie by id, ids by group: `g` stays sorted
    following = np.arange(len(ring)) + 1
    following[ends - 1] = starts
    d = e[:, :2] - np.repeat(e[starts, :2], ends - starts, axis=0)
    cross = d[:, 0] * d[following, 1] - d[following, 0] * d[:, 1]
    area = np.add.reduceat(cross, starts) if len(starts) else np.empty(0)
    least = np.lexsort((e[:, 1], e[:, 0], ring))[starts] if len(starts) else starts
    corner = e[least, :2]
    home = np.where(area > 0, ids, -1)
    cut = area < 0
    if cut.any():
        home[cut] = _homes(g, e, ring, ids[cut], corner[cut], rg[cut])
    sized = dict(zip(ids[area > 0].tolist(), np.flatnonzero(area > 0).tolist()))
    shell = np.array([sized.get(h, -1) for h in home.tolist()], int)
    kept = np.flatnonzero(shell >= 0)
    shell = shell[kept]
    # a shell's holes follow it, the least first
    order = np.lexsort((
        corner[kept, 1], corner[kept, 0], np.abs(area[kept]), area[kept] < 0, shell,
        corner[shell, 1], corner[shell, 0], area[shell], rg[kept],
    ))
    kept, shell = kept[order], shell[order]
    fresh = np.append(True, shell[1:] != shell[:-1]) if len(shell) else np.empty(0, bool)
    count = np.cumsum(fresh)
    first = np.searchsorted(rg[kept], rg[kept], "left")
    part = count - count[first] if len(kept) else count
    nth = np.arange(len(kept)) - np.flatnonzero(fresh)[count - 1] if len(kept) else count
    sizes = ends[kept] - starts[kept] + 1
    at = np.repeat(starts[kept] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    at[np.cumsum(sizes) - 1] = starts[kept]
    xy = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(e[at, k])) for k in (0, 1)], ["x", "y"])
    pts = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), xy)
    rows = pa.StructArray.from_arrays([pa.array(part, pa.int32()), pa.array(nth, pa.int32()), pts], ["part", "ring", "pts"])
    rings = pa.ListArray.from_arrays(pa.array(np.searchsorted(rg[kept], np.arange(n + 1)), pa.int32()), rows)
    return pa.StructArray.from_arrays([rings, pa.array(is_open)], ["rings", "open"])


def _outlines(edges: pa.Array, parity: bool) -> pa.Array:
    if isinstance(edges, pa.ChunkedArray):
        edges = edges.combine_chunks()
    sizes = np.nan_to_num(edges.value_lengths().to_numpy(zero_copy_only=False)).astype(int)
    flat = edges.flatten()
    e = np.column_stack([flat.field(c).to_numpy(zero_copy_only=False).astype("f8") for c in ("x0", "y0", "x1", "y1")])
    g = np.repeat(np.arange(len(edges)), sizes)
    return _placed(len(edges), *_outline(g, e, parity))


@F.arrow_udf(OUTLINE)
def union_outline(edges: pa.Array) -> pa.Array:
    """Rings of what the rings of ``edges`` run around more often left than right, shells with
    holes, and whether a chain of the outline doesn't close. Closed rings only."""
    return _outlines(edges, False)


@F.arrow_udf(OUTLINE)
def even_odd_outline(edges: pa.Array) -> pa.Array:
    """The same for what they run around an odd number of times."""
    return _outlines(edges, True)
