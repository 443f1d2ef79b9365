"""Maximum flow from a source and to a sink, over a graph whose nodes hang together by weak edges.

Blocking flows in levels (Dinic), without recursion. Every node has a capacity from the source or to the
sink, and undirected edges with capacities to a few others.
"""

from __future__ import annotations

from collections import deque

EPSILON = 1e-9


def source_side(terminal: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes a minimum cut leaves with the source.

    ``terminal`` is a node's capacity from the source if positive, to the sink if negative. ``edges`` are
    undirected: cutting one costs its capacity in either direction.
    """
    n = len(terminal)
    sink = [max(0.0, -t) for t in terminal]
    supply = [max(0.0, t) for t in terminal]
    arcs: list[list[int]] = [[] for _ in range(n)]
    to: list[int] = []
    room: list[float] = []
    for a, b, capacity in edges:
        arcs[a].append(len(to))
        to.append(b)
        room.append(capacity)
        arcs[b].append(len(to))
        to.append(a)
        room.append(capacity)
    for node in range(n):  # what reaches the sink by its own node
        flow = min(supply[node], sink[node])
        supply[node] -= flow
        sink[node] -= flow
    while True:
        level = _levels(supply, arcs, to, room)
        if not any(level[v] >= 0 and sink[v] > EPSILON for v in range(n)):
            return [x >= 0 for x in level]
        following = [0] * n
        for start in range(n):
            while level[start] == 0 and supply[start] > EPSILON:
                path = _path(start, level, following, arcs, to, room, sink)
                if path is None:
                    break
                end = to[path[-1]] if path else start
                flow = min([supply[start], sink[end], *[room[arc] for arc in path]])
                supply[start] -= flow
                sink[end] -= flow
                for arc in path:
                    room[arc] -= flow
                    room[arc ^ 1] += flow


def _levels(supply, arcs, to, room) -> list[int]:
    """Steps from the nearest node with supply left; -1 where flow can't get."""
    level = [0 if left > EPSILON else -1 for left in supply]
    queue = deque(v for v, x in enumerate(level) if x == 0)
    while queue:
        v = queue.popleft()
        for arc in arcs[v]:
            if room[arc] > EPSILON and level[to[arc]] < 0:
                level[to[arc]] = level[v] + 1
                queue.append(to[arc])
    return level


def _path(start, level, following, arcs, to, room, sink) -> list[int] | None:
    """Arcs, each one level up, from ``start`` to a node that the sink takes from."""
    path: list[int] = []
    v = start
    while sink[v] <= EPSILON:
        while following[v] < len(arcs[v]):
            arc = arcs[v][following[v]]
            if room[arc] > EPSILON and level[to[arc]] == level[v] + 1:
                break
            following[v] += 1
        if following[v] < len(arcs[v]):
            path.append(arcs[v][following[v]])
            v = to[path[-1]]
        elif path:
            v = to[path.pop() ^ 1]
            following[v] += 1
        else:
            return None
    return path
