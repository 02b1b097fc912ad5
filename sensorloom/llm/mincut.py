"""Two-label minimum cut on a small sparse graph.

Each node pays one cost for the label 1 and another for 0, and each edge pays its weight if its ends differ.  Nodes whose
own preference outweighs all their edges are settled first, which is exact and folds their edges into the neighbours'
costs; what is left goes through maximum flow (shortest augmenting levels), and the nodes still reachable from the
source keep label 1.
"""

from __future__ import annotations

from collections import deque

EPS = 1e-9


def labels(cost_one: list[float], cost_zero: list[float], edges: dict[tuple[int, int], float]) -> list[int]:
    """The labelling of least total cost; at a tie a node that can stay 0 does."""
    n = len(cost_one)
    lean = [z - o for o, z in zip(cost_one, cost_zero, strict=True)]  # above 0: label 1 is cheaper
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (i, j), w in edges.items():
        if i != j and w > 0:
            near[i][j] = near[i].get(j, 0.0) + w
            near[j][i] = near[j].get(i, 0.0) + w
    label = [-1] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] >= 0 or abs(lean[i]) < sum(near[i].values()):
            continue
        label[i] = int(lean[i] > 0)
        for j, w in near[i].items():
            lean[j] += w if label[i] else -w
            del near[j][i]
            queue.append(j)
        near[i] = {}
    left = [i for i in range(n) if label[i] < 0]
    if left:
        ones = _source_side(left, lean, near)
        for i in left:
            label[i] = int(i in ones)
    return label


def _source_side(nodes: list[int], lean: list[float], near: list[dict[int, float]]) -> set[int]:
    """Nodes on the source side of a minimum cut, by maximum flow."""
    source, sink = -1, -2
    room: dict[int, dict[int, float]] = {i: dict(near[i]) for i in nodes}
    room[source], room[sink] = {}, {}
    for i in nodes:
        if lean[i] > 0:
            room[source][i], room[i][source] = lean[i], 0.0
        elif lean[i] < 0:
            room[i][sink], room[sink][i] = -lean[i], 0.0
    while True:
        level, queue = {source: 0}, deque([source])
        while queue:
            i = queue.popleft()
            for j, r in room[i].items():
                if r > EPS and j not in level:
                    level[j] = level[i] + 1
                    queue.append(j)
        if sink not in level:
            return {i for i in level if i >= 0}
        pending = {i: iter(list(room[i])) for i in level}
        path = [source]
        while path:
            i = path[-1]
            if i == sink:
                least = min(room[a][b] for a, b in zip(path, path[1:], strict=False))
                for a, b in zip(path, path[1:], strict=False):
                    room[a][b] -= least
                    room[b][a] = room[b].get(a, 0.0) + least
                full = next(k for k, (a, b) in enumerate(zip(path, path[1:], strict=False)) if room[a][b] <= EPS)
                # the node before the full edge tries that edge's successors next
                del path[full + 1 :]
                continue
            step = next((j for j in pending[i] if room[i][j] > EPS and level.get(j) == level[i] + 1), None)
            if step is None:
                level[i] = -1
                path.pop()
            else:
                path.append(step)
