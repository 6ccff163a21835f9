"""Plain-Python model of the graph operations, to test against."""


def color_rounds(colors, half_edges, k=None, max_rounds=None):
    """Returns (colors, rounds, fails); ``colors`` maps id -> colour or None."""
    colors = dict(colors)
    out = {}
    for src, dst in half_edges:
        out.setdefault(src, set()).add(dst)
    rounds = 0
    while any(c is None for c in colors.values()):
        if max_rounds is not None and rounds >= max_rounds:
            break
        active = [i for i, c in colors.items() if c is None]
        used = {i: set() for i in active}
        for i, c in colors.items():
            if c is not None:
                for n in out.get(i, ()):
                    if n in used:
                        used[n].add(c)
        want = {i: next(c for c in range(len(used[i]) + 1) if c not in used[i]) for i in active}
        fails = sum(1 for c in want.values() if k is not None and c >= k)
        if fails:
            return colors, rounds + 1, fails
        rounds += 1
        beaten = {
            n for i in active for n in out.get(i, ()) if n in want and i < n and want[n] == want[i]
        }
        for i in active:
            if i not in beaten:
                colors[i] = want[i]
    return colors, rounds, 0


def k_search(nodes, half_edges, k_start):
    """Tries k, k-1, ... until one fails; returns (best_k, colours of the last success)."""
    best, result = -1, None
    for k in range(k_start, 0, -1):
        colors, _, fails = color_rounds({i: None for i in nodes}, half_edges, k)
        if fails or any(c is None for c in colors.values()):
            break
        best, result = k, colors
    return best, result


def apply_one(nodes, edges, change):
    """Apply (type, a, b, neighbors) in place to a dict id -> colour and a set of half-edges."""
    kind, a, b, neighbors = change
    if kind == "ADD_NODE":
        for n in neighbors:
            if n != a:
                edges.add((a, n))
                if n in nodes:
                    edges.add((n, a))
        nodes.setdefault(a, -1)
    elif kind == "REMOVE_NODE":
        nodes.pop(a, None)
        for e in [e for e in edges if a in e]:
            edges.discard(e)
    elif kind == "ADD_EDGE":
        if a != b:
            if a in nodes:
                edges.add((a, b))
            if b in nodes:
                edges.add((b, a))
    elif kind == "REMOVE_EDGE":
        edges.discard((a, b))
        edges.discard((b, a))
