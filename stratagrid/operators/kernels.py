"""Small numpy steps that run on one bounded group of cells inside a task.

A group is a raster block or the cells round one structure, so its size is fixed by the
block size or the buffer radius and never by the amount of data.
"""

from __future__ import annotations

import heapq

import numpy as np

INF = np.iinfo(np.int64).max


def adjacent_pairs(col, row, offsets, group=None):
    """Index pairs (u, v) of cells of one group with ``cell[v] = cell[u] + offset``.

    Input is sorted by (group, row, col); ``group`` is a small consecutive number.
    """
    if group is None:
        group = np.zeros(len(col), dtype=np.int64)
    # positions relative to each group's corner keep the keys small however large the raster is
    first = np.flatnonzero(np.diff(group, prepend=-1))
    sizes = np.diff(np.append(first, len(group)))
    col = col - np.repeat(np.minimum.reduceat(col, first), sizes) + 1
    row = row - np.repeat(np.minimum.reduceat(row, first), sizes) + 1
    width, depth = int(col.max()) + 2, int(row.max()) + 2
    key = (group * depth + row) * width + col
    us, vs = [], []
    for dc, dr in offsets:
        target = key + dr * width + dc
        at = np.minimum(np.searchsorted(key, target), len(key) - 1)
        hit = key[at] == target
        us.append(np.nonzero(hit)[0])
        vs.append(at[hit])
    return np.concatenate(us), np.concatenate(vs)


def jump(pointer):
    """Follow pointers to their roots by doubling."""
    while True:
        further = pointer[pointer]
        if np.array_equal(further, pointer):
            return pointer
        pointer = further


def least_labels(n, u, v):
    """Component label of n nodes joined by edges (u, v): the least index in the component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        hooked = label.copy()
        np.minimum.at(hooked, label[u], low)
        np.minimum.at(hooked, label[v], low)
        hooked = jump(hooked)
        if np.array_equal(hooked, label):
            return label
        label = hooked


def spanning_tree(n, a, b, w, terminal):
    """Cheapest edges that join ``n`` nodes, and the least tree that keeps the levels between terminals.

    Returns the numbers of the kept edges, ascending in ``w``, and ``(edge, terminal, terminal)`` for those
    that join terminals: the greatest ``w`` on the way between two terminals is the same in both.
    """
    order = np.argsort(w, kind="stable")
    parent = list(range(n))
    of = [node if flag else -1 for node, flag in enumerate(terminal.tolist())]
    tree, between = [], []
    for edge, x, y in zip(order.tolist(), a[order].tolist(), b[order].tolist()):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        if x == y:
            continue
        tree.append(edge)
        if of[x] >= 0 and of[y] >= 0:
            between.append((edge, of[x], of[y]))
        parent[y] = x
        if of[x] < 0:
            of[x] = of[y]
    return np.array(tree, np.int64), between


def flood_tree(n, a, b, w, sources):
    """Lowest level at which every node of a forest is reached from ``(level, node)`` sources."""
    ends = np.concatenate([a, b])
    order = np.argsort(ends, kind="stable")
    first = np.searchsorted(ends[order], np.arange(n + 1)).tolist()
    to, cost = np.concatenate([b, a])[order].tolist(), np.concatenate([w, w])[order].tolist()
    level = [None] * n
    heap = list(sources)
    heapq.heapify(heap)
    while heap:
        height, node = heapq.heappop(heap)
        if level[node] is not None:
            continue
        level[node] = height
        for k in range(first[node], first[node + 1]):
            if level[to[k]] is None:
                heapq.heappush(heap, (max(height, cost[k]), to[k]))
    return level


def local_pointers(cell_id, nxt):
    """Pointer of each cell to the last cell of its chain inside the group; input sorted by id."""
    at = np.minimum(np.searchsorted(cell_id, nxt), len(cell_id) - 1)
    inside = (cell_id[at] == nxt) & (nxt != cell_id)
    return np.where(inside, at, np.arange(len(cell_id)))


def accumulate(pointer, weight):
    """Sum of the weights of each node's subtree, the node included, by pointer doubling."""
    total = weight.astype(np.int64)
    nodes = np.arange(len(pointer))
    ahead = np.where(pointer == nodes, -1, pointer)  # -1: past the end of the chain
    while (ahead >= 0).any():
        moving = ahead >= 0
        flow = np.zeros_like(total)
        np.add.at(flow, ahead[moving], total[moving])
        total = total + flow
        ahead = np.where(moving, ahead[ahead], -1)
    return total


def hop_distances(hops, u, v):
    """Least number of steps along edges u -> v, starting from the known values."""
    hops = hops.copy()
    active = hops < INF
    while active.any():
        out = active[u]
        via, to = hops[u[out]] + 1, v[out]
        nearer = via < hops[to]
        np.minimum.at(hops, to[nearer], via[nearer])
        active = np.zeros(len(hops), dtype=bool)
        active[to[nearer]] = True
    return hops


def cost_surfaces(height, start, directions, straight, diagonal, target=None):
    """Least accumulated cost from the ``start`` cell of each stacked window, and the way back.

    One step costs the mean of the two heights times the step length; NaN cells are closed.
    The way back is a direction code, 0 at the start and where nothing arrives.

    Only cells whose cost has just fallen look at their neighbours, the cheap ones first.  With
    ``target`` a window stops at the cost of its cheapest target: dearer cells stay unreached, cells
    up to that cost are exact.
    """
    count, rows, cols = height.shape
    # a closed border of one cell; positions are those of the flattened padded windows
    padded = np.pad(height, ((0, 0), (1, 1), (1, 1)), constant_values=np.nan)
    shape = padded.shape
    area, width = shape[1] * shape[2], shape[2]
    h = padded.reshape(-1)
    cost = np.full(h.size, np.inf)
    steps = [(code, dr * width + dc, (diagonal if dc and dr else straight) / 2.0) for code, dc, dr in directions]
    origin = np.arange(count) * area + (start[0] + 1) * width + start[1] + 1
    active = origin[~np.isnan(h[origin])]
    cost[active] = 0.0
    bound = np.full(count, np.inf)
    aim = None if target is None else np.pad(target, ((0, 0), (1, 1), (1, 1))).reshape(-1)
    known = h[~np.isnan(h)]
    stride = float(known.mean()) * diagonal if known.size else 1.0  # about one step
    limit = stride
    while active.size:
        if aim is not None:
            active = active[cost[active] <= bound[active // area]]
        near = cost[active] < limit
        if not near.any():
            if active.size:
                limit = float(cost[active].min()) + stride
            continue
        now, later = active[near], [active[~near]]
        for _, offset, half in steps:
            to = now + offset
            via = cost[now] + (h[now] + h[to]) * half
            better = via < cost[to]  # false where the height is NaN
            to, via = to[better], via[better]
            cost[to] = via  # cells differ, and so do their neighbours at one offset
            if aim is not None and to.size:
                hit = aim[to]
                np.minimum.at(bound, to[hit] // area, via[hit])
            later.append(to)
        active = np.unique(np.concatenate(later))
    grid = cost.reshape(shape)
    back = np.zeros(h.size, dtype=np.int64)
    reached = np.flatnonzero(np.isfinite(cost))
    for code, offset, half in reversed(steps):
        via = cost[reached + offset] + (h[reached + offset] + h[reached]) * half
        back[reached[via == cost[reached]]] = code
    back[origin] = 0
    inner = (slice(None), slice(1, -1), slice(1, -1))
    return grid[inner], back.reshape(shape)[inner]
