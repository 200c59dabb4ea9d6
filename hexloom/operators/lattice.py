"""Corridors of lines on the edges of a pointy grid and the cheapest paths through them, for many lines at once in numpy.

An edge is the side ``k`` (see ``SIDES``) of a cell (q, r); its nodes are in the whole numbers of ``grid.edge_graph``, the smaller one first.
A directed edge is the number of an edge, or that plus the number of all edges where it runs from the larger node to the smaller one.
"""

from __future__ import annotations

import numpy as np

from hexloom.functions.hexgrid import GridSpec

#: The three sides that a cell owns: their ends from its middle, and the cell beyond.
SIDES = (((1, -1), (1, 1), (1, 0)), ((1, 1), (0, 2), (0, 1)), ((0, 2), (-1, 1), (-1, 1)))
#: The same with the smaller end first, as numbers: x1, y1, x2, y2, and q and r of the cell beyond.
ENDS = np.array([[*a, *b, *SIDES[k][2]] for k, (a, b) in enumerate(tuple(sorted(s[:2])) for s in SIDES)])
#: Pairs of a piece of line and a cell that are looked at together.
PAIRS = 60_000
#: Cells of a tile of water along q and r: 64 in all, one number.
TILE = 8


def _after() -> np.ndarray:
    """For each side, direction (0: towards the larger node) and turn (0: right, 1: left) the edge that follows: dq, dr, k and its direction."""
    out = np.zeros((3, 2, 2, 4), dtype=np.int64)
    for k in range(3):
        for d in range(2):
            tail, head = ENDS[k][:2] if d == 0 else ENDS[k][2:4], ENDS[k][2:4] if d == 0 else ENDS[k][:2]
            for dr in range(-2, 3):
                for dq in range(-2, 3):
                    for k2 in range(3):
                        middle = np.array([2 * dq + dr, 3 * dr])
                        one, two = ENDS[k2][:2] + middle, ENDS[k2][2:4] + middle
                        for d2, (start, stop) in enumerate(((one, two), (two, one))):
                            if (start == head).all() and (stop != tail).any():
                                turn = (head[0] - tail[0]) * (stop[1] - start[1]) - (head[1] - tail[1]) * (stop[0] - start[0])
                                out[k, d, int(turn > 0)] = dq, dr, k2, d2
    return out


AFTER = _after()


def runs(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row as many numbers as it counts: the row and the number from 0."""
    counts = np.maximum(counts, 0).astype(np.int64)
    rows = np.repeat(np.arange(len(counts)), counts)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)


def to_leg(px, py, ax, ay, bx, by):
    """The distance of places from legs, and the part of the leg (0 to 1) where it is nearest."""
    dx, dy = bx - ax, by - ay
    long = dx * dx + dy * dy
    with np.errstate(divide="ignore", invalid="ignore"):
        t = np.where(long > 0, np.minimum(1.0, np.maximum(0.0, ((px - ax) * dx + (py - ay) * dy) / long)), 0.0)
    return np.hypot(px - ax - t * dx, py - ay - t * dy), t


class Lines:
    """Lines with at least two corners each: ``xs`` and ``ys`` are lists of arrays. Legs and pieces know their line."""

    def __init__(self, xs: list[np.ndarray], ys: list[np.ndarray], grid: GridSpec):
        self.n, self.grid = len(xs), grid
        sizes = np.array([len(x) for x in xs], dtype=np.int64)
        x, y, own = np.concatenate(xs), np.concatenate(ys), np.repeat(np.arange(self.n), sizes)
        last = np.cumsum(sizes) - 1
        self.from_x, self.from_y, self.to_x, self.to_y = x[last - sizes + 1], y[last - sizes + 1], x[last], y[last]
        begin = np.ones(len(x), bool)
        begin[last] = False
        i = np.flatnonzero(begin)
        self.line, self.ax, self.ay, self.bx, self.by = own[i], x[i], y[i], x[i + 1], y[i + 1]
        self.leg = np.hypot(self.bx - self.ax, self.by - self.ay)
        self.first = np.concatenate([[0], np.cumsum(sizes - 1)])
        ends = [np.cumsum(self.leg[a:b]) for a, b in zip(self.first, self.first[1:])]
        self.s0, self.total = np.concatenate(ends) - self.leg, np.array([e[-1] for e in ends])

    def tangents(self, line: np.ndarray, s: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """The direction from ``reach`` before to ``reach`` after a way along a line, both within the line. Rows lie by line."""
        out = []
        bounds = np.searchsorted(line, np.arange(self.n + 1))
        for e in (-1, 1):
            at = np.minimum(self.total[line], np.maximum(0.0, s + e * reach))
            on = np.empty(len(at), dtype=np.int64)
            for n in range(self.n):
                a, b = bounds[n], bounds[n + 1]
                if a < b:
                    on[a:b] = self.first[n] + np.maximum(0, np.searchsorted(self.s0[self.first[n] : self.first[n + 1]], at[a:b], side="right") - 1)
            with np.errstate(divide="ignore", invalid="ignore"):
                t = np.where(self.leg[on] > 0, (at - self.s0[on]) / self.leg[on], 0.0)
            out.append((self.ax[on] + (self.bx[on] - self.ax[on]) * t, self.ay[on] + (self.by[on] - self.ay[on]) * t))
        return out[1][0] - out[0][0], out[1][1] - out[0][1]


def xy(grid: GridSpec, x, y):
    """Projected places of nodes."""
    return grid.origin_x + x * (grid.flat_to_flat / 2), grid.origin_y + y * (grid.side / 2)


class Edges:
    """Edges of lines' corridors by line, r, q and k, with their nodes, the distance of their middle and the way along the line there."""

    def __init__(self, line, q, r, k, distance, s):
        self.line, self.q, self.r, self.k, self.distance, self.s = line, q, r, k, distance, s
        cx, cy = 2 * q + r, 3 * r
        self.x1, self.y1, self.x2, self.y2 = (c + ENDS[k, i] for i, c in enumerate((cx, cy, cx, cy)))


def corridor(lines: Lines, reach: float) -> Edges:
    """The edges within ``reach`` of each line."""
    g, v = lines.grid, lines
    n = np.maximum(1, np.ceil(v.leg / (3 * g.side)))
    at, i = runs(n)
    dx, dy = (v.bx - v.ax)[at] / n[at], (v.by - v.ay)[at] / n[at]
    px, py, ox, oy = v.ax[at] + dx * i, v.ay[at] + dy * i, v.ax[at] + dx * (i + 1), v.ay[at] + dy * (i + 1)
    piece, own = v.leg[at] / n[at], v.line[at]
    s = v.s0[at] + piece * i
    pad, step, f = reach + g.side, 1.5 * g.side, g.flat_to_flat
    low = np.ceil((np.minimum(py, oy) - pad - g.origin_y) / step - 1e-9)
    high = np.floor((np.maximum(py, oy) + pad - g.origin_y) / step + 1e-9)
    row, j = runs(high - low + 1)
    r = low[row] + j
    low = np.ceil((np.minimum(px, ox)[row] - pad - g.origin_x) / f - r / 2 - 1e-9)
    high = np.floor((np.maximum(px, ox)[row] + pad - g.origin_x) / f - r / 2 + 1e-9)
    cell, j = runs(high - low + 1)
    row, r, q = row[cell], r[cell].astype(np.int64), (low[cell] + j).astype(np.int64)
    out = []
    for a in range(0, len(q), PAIRS):
        out.append(_sides(g, reach, row[a : a + PAIRS], q[a : a + PAIRS], r[a : a + PAIRS], (px, py, ox, oy, s, piece), pad))
    row, q, r, k, d, s, near = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, t) for t in (int, int, int, int, float, float, bool))
    if not len(q):
        return Edges(*(np.zeros(0, t) for t in (int, int, int, int, float, float)))
    box = q.min(), r.min(), q.max() - q.min() + 1, r.max() - r.min() + 1
    key = ((own[row] * box[3] + r - box[1]) * box[2] + q - box[0]) * 3 + k
    names, number = np.unique(key, return_inverse=True)
    number = number.ravel()
    some = np.zeros(len(names), bool)
    some[number[near]] = True
    best, way = np.full(len(names), np.inf), np.full(len(names), np.inf)
    np.minimum.at(best, number, d)
    first = d == best[number]
    np.minimum.at(way, number[first], s[first])
    names, best, way = names[some], best[some], way[some]
    names, k = np.divmod(names, 3)
    names, q = np.divmod(names, box[2])
    line, r = np.divmod(names, box[3])
    return Edges(line, q + box[0], r + box[1], k, best, way)


def _sides(g: GridSpec, reach: float, row, q, r, pieces, pad: float):
    """Sides of cells about pieces of lines, with the distance of their middle, the way along there and whether they are within ``reach``."""
    px, py, ox, oy, s, piece = (c[row] for c in pieces)
    mx, my = g.origin_x + q * g.step_q[0] + r * g.step_r[0], g.origin_y + q * g.step_q[1] + r * g.step_r[1]
    keep = np.flatnonzero(to_leg(mx, my, px, py, ox, oy)[0] <= pad + 1e-6)
    k = np.tile(np.arange(3), len(keep))
    keep = keep.repeat(3)
    row, q, r, px, py, ox, oy, s, piece = (c[keep] for c in (row, q, r, px, py, ox, oy, s, piece))
    cx, cy = 2 * q + r, 3 * r
    (ux, uy), (vx, vy) = xy(g, cx + ENDS[k, 0], cy + ENDS[k, 1]), xy(g, cx + ENDS[k, 2], cy + ENDS[k, 3])
    d, part = to_leg((ux + vx) / 2, (uy + vy) / 2, px, py, ox, oy)
    keep = np.flatnonzero(d <= reach + g.side / 2 + 1e-6)
    row, q, r, k, d, way = row[keep], q[keep], r[keep], k[keep], d[keep], (s + part * piece)[keep]
    near = d <= reach
    ask = np.flatnonzero(~near)
    ux, uy, vx, vy, px, py, ox, oy = (c[keep][ask] for c in (ux, uy, vx, vy, px, py, ox, oy))

    def side(ax, ay, bx, by, cx, cy):
        return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)

    crosses = (side(ux, uy, vx, vy, px, py) * side(ux, uy, vx, vy, ox, oy) < 0) & (side(px, py, ox, oy, ux, uy) * side(px, py, ox, oy, vx, vy) < 0)
    least = np.minimum(np.minimum(to_leg(ux, uy, px, py, ox, oy)[0], to_leg(vx, vy, px, py, ox, oy)[0]), np.minimum(to_leg(px, py, ux, uy, vx, vy)[0], to_leg(ox, oy, ux, uy, vx, vy)[0]))
    near[ask] = crosses | (least <= reach)
    return row, q, r, k, d, way, near


class Water:
    """Water cells about lines: tiles (tq, tr) of 8 by 8 cells with a bit for each, by line."""

    def __init__(self, line, tq, tr, bits):
        self.empty = not len(line)
        if not self.empty:
            self.box = tq.min(), tr.min(), tq.max() - tq.min() + 1, tr.max() - tr.min() + 1
            key = (line * self.box[3] + tr - self.box[1]) * self.box[2] + tq - self.box[0]
            order = np.argsort(key, kind="stable")
            self.key, self.bits = key[order], bits[order]

    def __call__(self, line, q, r) -> np.ndarray:
        if self.empty:
            return np.zeros(len(q), bool)
        tq, tr = q // TILE, r // TILE
        inside = (tq >= self.box[0]) & (tq < self.box[0] + self.box[2]) & (tr >= self.box[1]) & (tr < self.box[1] + self.box[3])
        key = (line * self.box[3] + tr - self.box[1]) * self.box[2] + tq - self.box[0]
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return inside & (self.key[at] == key) & ((self.bits[at] >> (q % TILE * TILE + r % TILE)) & 1 == 1)


def tiles(lines: Lines, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tiles that may hold a cell on a side of an edge within ``reach`` of each line, each once: line, tq, tr. Legs are cut, so that a long one meets few besides."""
    g, v = lines.grid, lines
    n = np.maximum(1, np.ceil(v.leg / (TILE * g.flat_to_flat)))
    at, i = runs(n)
    dx, dy = (v.bx - v.ax)[at] / n[at], (v.by - v.ay)[at] / n[at]
    px, py, ox, oy = v.ax[at] + dx * i, v.ay[at] + dy * i, v.ax[at] + dx * (i + 1), v.ay[at] + dy * (i + 1)
    pad, f, step = reach + 4 * g.side, g.flat_to_flat, 1.5 * g.side
    low, high = np.floor((np.minimum(py, oy) - pad - g.origin_y) / step), np.ceil((np.maximum(py, oy) + pad - g.origin_y) / step)
    row, j = runs(high // TILE - low // TILE + 1)
    tr = low[row] // TILE + j
    r0, r1 = np.maximum(low[row], tr * TILE), np.minimum(high[row], tr * TILE + TILE - 1)
    first = np.floor(((np.minimum(px, ox)[row] - pad - g.origin_x) / f - r1 / 2) / TILE)
    last = np.floor(((np.maximum(px, ox)[row] + pad - g.origin_x) / f - r0 / 2) / TILE)
    cell, j = runs(last - first + 1)
    line, tr, tq = v.line[at[row[cell]]], tr[cell].astype(np.int64), (first[cell] + j).astype(np.int64)
    q0, r0, w, h = tq.min(), tr.min(), tq.max() - tq.min() + 1, tr.max() - tr.min() + 1
    names, tq = np.divmod(np.unique((line * h + tr - r0) * w + tq - q0), w)
    line, tr = np.divmod(names, h)
    return line, tq + q0, tr + r0


def nearest(line, x, y, distance, n: int) -> np.ndarray:
    """Of the nodes of each line the one with the least distance, of ties the smaller: its row."""
    best = np.full(n, np.inf)
    np.minimum.at(best, line, distance)
    tied = np.flatnonzero(distance == best[line])
    tied = tied[np.lexsort((y[tied], x[tied], line[tied]))]
    _, first = np.unique(line[tied], return_index=True)
    return tied[first]


class Nodes:
    """The different nodes of edges, by line, x and y."""

    def __init__(self, e: Edges):
        x, y, line = np.concatenate([e.x1, e.x2]), np.concatenate([e.y1, e.y2]), np.concatenate([e.line, e.line])
        self.x0, self.y0, self.w, self.h = x.min(), y.min(), x.max() - x.min() + 1, y.max() - y.min() + 1
        names, number = np.unique(self.name(line, x, y), return_inverse=True)
        self.names, self.number = names, number.ravel()
        rest, self.y = np.divmod(names, self.h)
        self.line, self.x = np.divmod(rest, self.w)
        self.x, self.y = self.x + self.x0, self.y + self.y0

    def name(self, line, x, y):
        return (line * self.w + x - self.x0) * self.h + y - self.y0

    def find(self, line, x, y) -> np.ndarray:
        """The numbers of the given nodes, -1 for those that no edge has."""
        inside = (x >= self.x0) & (x < self.x0 + self.w) & (y >= self.y0) & (y < self.y0 + self.h)
        name = self.name(line, x, y)
        at = np.minimum(np.searchsorted(self.names, name), len(self.names) - 1)
        return np.where(inside & (self.names[at] == name), at, -1)


def followers(e: Edges) -> np.ndarray:
    """For each directed edge and turn (0: right, 1: left) the directed edge that follows, -1 for none."""
    m = len(e.q)
    q0, r0, w, h = e.q.min() - 2, e.r.min() - 2, e.q.max() - e.q.min() + 5, e.r.max() - e.r.min() + 5
    name = lambda q, r, k: ((e.line * h + r - r0) * w + q - q0) * 3 + k
    names = name(e.q, e.r, e.k)
    out = np.empty((2 * m, 2), dtype=np.int64)
    for d in range(2):
        for turn in range(2):
            dq, dr, k, way = AFTER[e.k, d, turn].T
            want = name(e.q + dq, e.r + dr, k)
            at = np.minimum(np.searchsorted(names, want), m - 1)
            out[d * m : (d + 1) * m, turn] = np.where(names[at] == want, at + way * m, -1)
    return out


def cheapest(e: Edges, ahead: np.ndarray, back: np.ndarray, nodes: Nodes, start: np.ndarray, goal: np.ndarray, n: int, same_turn: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each line that can be joined the numbers of its path's nodes and the cost at each.

    ``start`` has the number of the node where a line begins (-1: it has no path), ``goal`` tells of each node whether it is one. A state is a directed edge and the
    turn that led onto it. From the edges that were bettered in a round all lines' searches go on together, until none betters another; what costs as much as
    the best goal of its line is not followed. An edge and a turn onto it follow one edge alone, so a round needs no sorting.
    """
    m = len(e.q)
    after, cost = followers(e), np.concatenate([ahead, back])
    tail, head = nodes.number, np.concatenate([nodes.number[m:], nodes.number[:m]])
    line = np.concatenate([e.line, e.line])
    ends = goal[head]
    found: dict[int, tuple[np.ndarray, np.ndarray]] = {int(k): (start[k : k + 1], np.zeros(1)) for k in np.flatnonzero((start >= 0) & goal[np.maximum(start, 0)])}
    begun = np.full((2 * m,), np.inf)  # of edges that leave the start, which no turn led onto
    reached = np.full((2, 2 * m), np.inf)  # by the turn, right and left
    came, by = np.full((2, 2 * m), -1), np.zeros((2, 2 * m), dtype=np.int8)  # the edge before and its turn: 0 right, 1 none, 2 left
    fresh = np.flatnonzero((tail == start[line]) & ~goal[tail])
    begun[fresh] = cost[fresh]
    best = np.full(n, np.inf)
    np.minimum.at(best, line[fresh[ends[fresh]]], cost[fresh[ends[fresh]]])
    marked = np.zeros(2 * m, bool)
    while len(fresh):
        least = np.minimum(np.minimum(reached[0, fresh], reached[1, fresh]), begun[fresh])
        fresh = fresh[(least < best[line[fresh]]) & ~ends[fresh]]
        moves = []
        for turn in range(2):
            onto = after[fresh, turn]
            source = fresh[onto >= 0]
            onto = onto[onto >= 0]
            more = cost[onto]
            right, left = reached[0, source] + more, reached[1, source] + more
            if turn == 0:
                right = right + same_turn
            else:
                left = left + same_turn
            none = begun[source] + more
            total, who = right, np.zeros(len(source), dtype=np.int8)
            for k, other in ((1, none), (2, left)):
                less = other < total
                total, who = np.where(less, other, total), np.where(less, np.int8(k), who)
            better = total < reached[turn, onto]
            moves.append((onto[better], source[better], who[better], total[better]))
        for turn, (onto, source, who, total) in enumerate(moves):
            reached[turn, onto], came[turn, onto], by[turn, onto] = total, source, who
            goals = ends[onto]
            np.minimum.at(best, line[onto[goals]], total[goals])
        one, two = moves[0][0], moves[1][0]
        marked[one] = True
        fresh = np.concatenate([one, two[~marked[two]]])
        marked[one] = False
    # The last edge of each path: of equal ones the first by direction, nodes and turn.
    last = np.flatnonzero(ends)
    states = np.stack([reached[0, last], begun[last], reached[1, last]], 1)
    pick, turn = np.nonzero(np.isfinite(states) & (states == best[line[last]][:, None]))
    edge = last[pick]
    order = np.lexsort((turn, e.y2[edge % m], e.x2[edge % m], e.y1[edge % m], e.x1[edge % m], edge >= m, line[edge]))
    edge, turn = edge[order], turn[order]
    lines, first = np.unique(line[edge], return_index=True)
    edge, turn = edge[first], turn[first]
    steps = []
    while len(edge):
        value = np.where(turn == 1, begun[edge], reached[(turn == 2).astype(int), edge])
        steps.append((lines, head[edge], value))
        on = turn != 1
        lines, edge, turn = lines[on], edge[on], turn[on]
        side = (turn == 2).astype(int)
        edge, turn = came[side, edge], by[side, edge].astype(int)
    if steps:
        own, node, paid = (np.concatenate(c) for c in zip(*steps))
        order = np.lexsort((-np.arange(len(own)), own))
        own, node, paid = own[order], node[order], paid[order]
        names, first = np.unique(own, return_index=True)
        for k, a, b in zip(names.tolist(), first, [*first[1:], len(own)]):
            found[k] = np.concatenate([start[k : k + 1], node[a:b]]), np.concatenate([[0.0], paid[a:b]])
    return found


def numbers(nx1, ny1, nx2, ny2) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The cell and side of edges given by their smaller and larger node, and whether there is such an edge."""
    dy, dx = ny2 - ny1, nx2 - nx1
    k = np.where(dx == 0, 0, np.where(dy < 0, 1, 2))
    cx, cy = nx1 - ENDS[k, 0], ny1 - ENDS[k, 1]
    r = cy // 3
    real = (dx == ENDS[k, 2] - ENDS[k, 0]) & (dy == ENDS[k, 3] - ENDS[k, 1]) & (cy % 3 == 0) & ((cx - r) % 2 == 0)
    return (cx - r) // 2, r, k, real


def percentile(ordered: np.ndarray, first: np.ndarray, n: np.ndarray, p: float) -> np.ndarray:
    """Exact percentiles, straight between two values, of runs of sorted values; nan for empty ones."""
    at = np.maximum(n - 1, 0) * p
    low, high = np.floor(at).astype(int), np.ceil(at).astype(int)
    values = np.append(ordered, np.nan)
    where = lambda i: np.where(n > 0, first + i, len(ordered))
    a, b = values[where(low)], values[where(high)]
    return np.where((low == high) | (a == b), a, (high - at) * a + (at - low) * b)


def measures(grid: GridSpec, paths: list[tuple[np.ndarray, np.ndarray]], lines: list[tuple[np.ndarray, np.ndarray]], reach: float, tangent_reach: float) -> dict[str, np.ndarray]:
    """For each path (nodes) and its line (corners): edges, offsets, turns, equal turns in a row, edges against the line and the straight distance."""
    n = len(paths)
    sizes = np.array([len(x) for x, _ in paths])
    x, y, own = np.concatenate([x for x, _ in paths]), np.concatenate([y for _, y in paths]), np.repeat(np.arange(n), sizes)
    last = np.cumsum(sizes) - 1
    px, py = xy(grid, x, y)
    straight = np.hypot(px[last] - px[last - sizes + 1], py[last] - py[last - sizes + 1])
    step = np.flatnonzero(own[1:] == own[:-1]) + 1  # the node that an edge leads to
    line, dx, dy = own[step], px[step] - px[step - 1], py[step] - py[step - 1]
    flip = (x[step] < x[step - 1]) | ((x[step] == x[step - 1]) & (y[step] < y[step - 1]))
    one, two = np.where(flip, step, step - 1), np.where(flip, step - 1, step)
    q, r, k, real = numbers(x[one], y[one], x[two], y[two])
    distance, along = np.full(len(step), np.nan), np.zeros(len(step))
    usable = np.flatnonzero([len(a) > 1 for a, _ in lines])
    if len(usable) and len(step):
        of = np.full(n, -1)
        of[usable] = np.arange(len(usable))
        held = Lines([lines[i][0] for i in usable], [lines[i][1] for i in usable], grid)
        e = corridor(held, reach)
        ask = np.flatnonzero(real & (of[line] >= 0)) if len(e.q) else np.zeros(0, int)
        if len(ask):
            q0, r0 = min(e.q.min(), q[ask].min()), min(e.r.min(), r[ask].min())
            w, h = max(e.q.max(), q[ask].max()) - q0 + 1, max(e.r.max(), r[ask].max()) - r0 + 1
            name = lambda b, q, r, k: ((b * h + r - r0) * w + q - q0) * 3 + k
            names, want = name(e.line, e.q, e.r, e.k), name(of[line[ask]], q[ask], r[ask], k[ask])
            at = np.minimum(np.searchsorted(names, want), len(names) - 1)
            hit = names[at] == want
            ask, at = ask[hit], at[hit]
            distance[ask] = e.distance[at]
            tx, ty = held.tangents(of[line[ask]], e.s[at], tangent_reach)
            long = grid.side * np.hypot(tx, ty)
            with np.errstate(divide="ignore", invalid="ignore"):
                along[ask] = np.where(long > 0, (dx[ask] * tx + dy[ask] * ty) / long, 0.0)
    after = np.flatnonzero(line[1:] == line[:-1]) + 1
    turn = np.sign(dx[after - 1] * dy[after] - dy[after - 1] * dx[after])
    same = np.flatnonzero((line[after][1:] == line[after][:-1]) & (turn[1:] == turn[:-1]) & (turn[1:] != 0)) + 1
    count = lambda rows: np.bincount(rows, minlength=n)
    known = np.flatnonzero(~np.isnan(distance))
    order = known[np.lexsort((distance[known], line[known]))]
    each, off = count(line[known]), distance[order]
    first = np.cumsum(each) - each
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = np.bincount(line[known], distance[known], minlength=n) / each
    return {
        "edges": count(line), "offset_mean": mean, **{f"offset_{a}": percentile(off, first, each, p) for a, p in (("median", 0.5), ("p90", 0.9), ("p95", 0.95), ("max", 1.0))},
        "turns": count(line[after]), "same_turns": count(line[after][same]), "reversals": count(line[along < -0.5]), "straight_m": straight,
    }
