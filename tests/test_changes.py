"""Change logs against a step-by-step model."""

import importlib
import random

import pytest

from graph_model import apply_one, color_rounds
from sparkloom.operators import graph

# The package has a function of the same name.
recolor_module = importlib.import_module("sparkloom.operators.graph.recolor")

LOG = "seq long, type string, a long, b long, neighbors array<long>"


def log_frame(spark, changes):
    return spark.createDataFrame([(i, *c) for i, c in enumerate(changes)], LOG)


def frames(spark, nodes, edges):
    n = spark.createDataFrame(sorted(nodes.items()), "id long, color int")
    e = spark.createDataFrame(sorted(edges) or [(0, 0)], "src long, dst long")
    return n, e.filter("src <> dst")


def collected(nodes, edges):
    pairs = [tuple(r) for r in edges.select("src", "dst").collect()]
    assert len(pairs) == len(set(pairs))
    return {r["id"]: r["color"] for r in nodes.collect()}, set(pairs)


def random_log(rng, length, ids):
    log = []
    for _ in range(length):
        kind = rng.choice(["ADD_NODE", "REMOVE_NODE", "ADD_EDGE", "ADD_EDGE", "REMOVE_EDGE"])
        a, b = rng.choice(ids), rng.choice(ids)
        if kind == "ADD_NODE":
            log.append((kind, a, None, [rng.choice(ids) for _ in range(rng.randint(0, 4))]))
        elif kind == "REMOVE_NODE":
            log.append((kind, a, None, None))
        else:
            log.append((kind, a, b, None))
    return log


@pytest.mark.parametrize("seed", range(6))
def test_random_logs(spark, seed):
    rng = random.Random(seed)
    ids = list(range(12))
    nodes = {i: rng.randint(0, 3) for i in ids[:8]}
    edges = {(a, b) for a in nodes for b in nodes if a != b and rng.random() < 0.3}
    edges.add((0, 10))
    log = random_log(rng, 60, ids)
    want_nodes, want_edges = dict(nodes), set(edges)
    removed = set()
    for change in log:
        if change[0] == "REMOVE_NODE":
            removed.add(change[1])
        apply_one(want_nodes, want_edges, change)
    got_nodes, got_edges = collected(
        *graph.apply_changes(*frames(spark, nodes, edges), log_frame(spark, log), block=7)
    )
    assert set(got_nodes) == set(want_nodes)
    assert got_edges == want_edges
    for i, color in got_nodes.items():
        assert color == (nodes[i] if i in nodes and i not in removed else -1)


def test_single_changes(spark):
    nodes, edges = {1: 0, 2: 1, 3: 0}, {(1, 2), (2, 1)}
    cases = {
        ("ADD_NODE", 9, None, (1, 7, 9)): {(9, 1), (1, 9), (9, 7)},
        ("REMOVE_NODE", 2, None, None): None,
        ("ADD_EDGE", 3, 8, None): {(3, 8)},
        ("ADD_EDGE", 1, 2, None): set(),
        ("ADD_EDGE", 1, 1, None): set(),
    }
    for change, added in cases.items():
        change = (*change[:3], list(change[3]) if change[3] else None)
        _, got = collected(
            *graph.apply_changes(*frames(spark, nodes, edges), log_frame(spark, [change]))
        )
        assert got == (set() if added is None else edges | added)


def cycle(n):
    return {(i, (i + 1) % n) for i in range(n)} | {((i + 1) % n, i) for i in range(n)}


def test_affected_and_recolor(spark):
    edges = cycle(8)
    nodes = {i: i % 2 for i in range(8)}
    log = [("REMOVE_EDGE", 0, 1, None), ("ADD_NODE", 20, None, [2, 4])]
    n, e = frames(spark, nodes, edges)
    done = graph.recolor(n, e, log_frame(spark, log), k=3)
    assert {r["id"] for r in done.affected.collect()} == {0, 1, 7, 2, 20, 4}
    assert done.success
    got, pairs = collected(done.nodes, done.edges)
    start = {i: c for i, c in nodes.items()} | {20: None}
    for i in (0, 1, 7, 2, 4):
        start[i] = None
    want, _, _ = color_rounds(start, pairs)
    assert got == want
    assert tuple(graph.validate(done.nodes, done.edges).first())[:3] == (True, 0, 0)


def test_recolor_with_too_few_colors_keeps_the_old_ones(spark):
    nodes, edges = {0: 0, 1: 1, 2: 0}, {(0, 1), (1, 0), (1, 2), (2, 1)}
    n, e = frames(spark, nodes, edges)
    log = log_frame(spark, [("ADD_EDGE", 0, 2, None), ("ADD_NODE", 5, None, [0])])
    done = graph.recolor(n, e, log, k=2)
    assert not done.success
    assert collected(done.nodes, done.edges)[0] == {0: 0, 1: 1, 2: 0, 5: -1}
    more = graph.recolor(n, e, log, k=2, allow_new_colors=True)
    assert more.success and more.coloring.best_k == 3


def stepwise_model(nodes, edges, log, k):
    want, pairs, outcomes = dict(nodes), set(edges), []
    for change in log:
        apply_one(want, pairs, change)
        named = {change[1], change[2]} - {None}
        hit = named | {b for a, b in pairs if a in named}
        start = {i: None if i in hit or c == -1 else c for i, c in want.items()}
        colors, _, fails = color_rounds(start, pairs, k=k)
        outcomes.append(not fails)
        if not fails:
            want = colors
    return want, pairs, outcomes


@pytest.mark.parametrize("k", [2, 3])
def test_stepwise_with_a_limit_follows_the_model(spark, k):
    nodes, edges = {i: i % 2 for i in range(6)}, cycle(6)
    log = [("REMOVE_NODE", 3, None, None), ("ADD_EDGE", 0, 2, None), ("ADD_NODE", 9, None, [0, 2])]
    log += [("ADD_EDGE", 9, 1, None)][: k - 2]
    n, e = frames(spark, nodes, edges)
    got_n, got_e, outcomes = graph.recolor_stepwise(n, e, log_frame(spark, log), k=k)
    want, pairs, want_outcomes = stepwise_model(nodes, edges, log, k)
    assert outcomes == want_outcomes
    assert collected(got_n, got_e) == (want, pairs)


def test_stepwise_with_a_failure_beside_later_changes(spark):
    # The ring over 0 to 4 needs a third colour; the path from 10 on is far away.
    path = {(i, i + 1) for i in range(10, 30)} | {(i + 1, i) for i in range(10, 30)}
    line = {(i, i + 1) for i in range(4)} | {(i + 1, i) for i in range(4)}
    nodes = {i: i % 2 for i in [*range(5), *range(10, 31)]}
    log = [("ADD_NODE", 50, None, [30]), ("ADD_EDGE", 0, 4, None), ("REMOVE_NODE", 10, None, None)]
    n, e = frames(spark, nodes, path | line)
    got_n, got_e, outcomes = graph.recolor_stepwise(n, e, log_frame(spark, log), k=2)
    want, pairs, want_outcomes = stepwise_model(nodes, path | line, log, 2)
    assert outcomes == want_outcomes == [True, False, True]
    assert collected(got_n, got_e) == (want, pairs)


def test_stepwise_in_layers_follows_the_model(spark, monkeypatch):
    layers = []
    once = recolor_module.recolor_part
    monkeypatch.setattr(
        recolor_module, "recolor_part", lambda *a: layers.append(1) or once(*a)
    )
    rng = random.Random(3)
    ids = list(range(300))
    nodes, edges = {}, set()
    for a in ids[:280]:
        for b in (a + 1, rng.choice(ids[:280]) if a % 7 == 0 else a + 1):
            if b < 280 and a != b:
                edges |= {(a, b), (b, a)}
    edges.add((5, 290))  # one-sided
    nodes, _, _ = color_rounds({i: None for i in ids[:280]}, edges)
    log = random_log(rng, 12, ids) + [("ADD_EDGE", 7, 11, None)]
    log += [("REMOVE_NODE", 7, None, None), ("ADD_NODE", 7, None, [11, 299, 13])]
    n, e = frames(spark, nodes, edges)
    got_n, got_e, outcomes = graph.recolor_stepwise(
        n, e, log_frame(spark, log), k=2, allow_new_colors=True, compact_steps=2
    )
    want, pairs, _ = stepwise_model(nodes, edges, log, None)
    assert collected(got_n, got_e) == (want, pairs)
    assert outcomes == [True] * len(log)
    assert len(layers) < len(log)


def test_a_hub_passes_on_one_number(spark):
    # Changes 0 and 2 name the hub, change 1 a node four links away, change 3 one near it.
    near = [(0, i) for i in range(1, 50)] + [(i, 0) for i in range(1, 50)] + [(49, 60), (60, 49)]
    near = spark.createDataFrame(near, "src long, dst long")
    named = spark.createDataFrame([(0, 0), (2, 0), (1, 100), (3, 60)], "seq long, id long")
    assert sorted(r["seq"] for r in recolor_module.ready_changes(named, near).collect()) == [0, 1]
    empty = recolor_module.ready_changes(named.limit(0), near)
    assert empty.isEmpty()


def test_stepwise_of_an_empty_log(spark):
    n, e = frames(spark, {0: 0, 1: 1}, {(0, 1), (1, 0)})
    got_n, got_e, outcomes = graph.recolor_stepwise(n, e, log_frame(spark, [(
        "ADD_EDGE", 0, 1, None)]).limit(0), k=2)
    assert outcomes == [] and collected(got_n, got_e) == ({0: 0, 1: 1}, {(0, 1), (1, 0)})


def test_stepwise_colors_what_came_uncolored(spark):
    nodes, edges = {0: 0, 1: -1, 2: 0, 3: 1}, {(0, 1), (1, 0), (2, 3), (3, 2)}
    log = [("ADD_EDGE", 2, 0, None), ("REMOVE_EDGE", 2, 3, None)]
    n, e = frames(spark, nodes, edges)
    got_n, got_e, outcomes = graph.recolor_stepwise(n, e, log_frame(spark, log), k=3)
    want, pairs, want_outcomes = stepwise_model(nodes, edges, log, 3)
    assert (outcomes, collected(got_n, got_e)) == (want_outcomes, (want, pairs))


def test_demo_changes(spark):
    ring = cycle(13)
    n, e = frames(spark, {i: 0 for i in range(13)}, ring)
    got = [tuple(r) for r in graph.demo_changes(n, e).orderBy("seq").collect()]
    assert got == [
        (0, "REMOVE_EDGE", 10, 11, None),
        (1, "ADD_NODE", 13, None, [5, 10]),
        (2, "ADD_EDGE", 5, 7, None),
        (3, "REMOVE_NODE", 3, None, None),
    ]
    small = {0: 0, 1: 0, 3: 0}
    star = {(3, i) for i in range(20, 26)}
    n, e = frames(spark, small, star)
    assert [tuple(r) for r in graph.demo_changes(n, e).collect()] == [
        (0, "ADD_NODE", 4, None, [])
    ]
