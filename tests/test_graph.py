"""Colouring, checking and building graphs."""

import random

import pytest
from pyspark.sql import functions as F

from graph_model import color_rounds, k_search
from sparkloom.operators import graph
from sparkloom.operators.graph import coloring
from sparkloom.scratch import Scratch


def frames(spark, colors, half_edges):
    nodes = spark.createDataFrame(
        [(i, -1 if c is None else c) for i, c in colors.items()], "id long, color int"
    )
    edges = spark.createDataFrame(sorted(half_edges), "src long, dst long")
    return nodes, edges


def both_ways(pairs):
    return {(a, b) for a, b in pairs} | {(b, a) for a, b in pairs}


def as_dict(colors):
    return {r["id"]: r["color"] for r in colors.collect()}


def random_graphs(seed, count, size):
    """Disjoint random graphs, one-sided and dangling links included."""
    rng = random.Random(seed)
    nodes, edges, parts = [], set(), []
    for g in range(count):
        base = 1000 * g
        n = rng.randint(1, size)
        ids = [base + i for i in range(n)]
        pairs = [(a, b) for a in ids for b in ids if a < b and rng.random() < 0.3]
        half = both_ways(pairs)
        if g % 3 == 0 and half:
            half.discard(sorted(half)[0])
            half.add((ids[0], base + 999))
        nodes += ids
        edges |= half
        parts.append((ids, half))
    return nodes, edges, parts


def test_color_random_graphs(spark):
    nodes, edges, parts = random_graphs(7, 25, 14)
    want, rounds, _ = color_rounds({i: None for i in nodes}, edges)
    run = graph.color_graph(*frames(spark, {i: None for i in nodes}, edges))
    assert as_dict(run.colors) == want
    assert (run.success, run.rounds, run.candidate_fails) == (True, rounds, 0)
    assert run.best_k == 1 + max(want.values())
    # The single run equals the search over k of each graph on its own.
    for ids, half in parts:
        degree = max(sum(1 for s, _ in half if s == i) for i in ids)
        k, colors = k_search(ids, half, degree + 2)
        assert colors == {i: want[i] for i in ids}
        assert k == 1 + max(colors.values())
    table = {r["round"]: r for r in graph.coloring_rounds(run).collect()}
    assert set(table) == set(range(1, rounds + 1))
    assert table[1]["uncolored"] == len(nodes)
    assert table[1]["messages"] == len(nodes) + len(edges)
    assert sum(r["decided"] for r in table.values()) == len(nodes)
    assert table[rounds]["tie_conflicts"] == 0


def test_same_colors_with_hubs_compaction_and_other_partitions(spark):
    rng = random.Random(3)
    pairs = {(0, i) for i in range(1, 60)} | {
        tuple(sorted(rng.sample(range(60), 2))) for _ in range(200)
    }
    edges = both_ways(pairs)
    blank = {i: None for i in range(60)}
    want, _, _ = color_rounds(blank, edges)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        run = graph.color_graph(*frames(spark, blank, edges), slot_edges=10, compact_edges=0)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert as_dict(run.colors) == want
    assert spark.sql("SHOW TABLES IN sparkloom_scratch").count() == 0


def test_color_keeps_given_colors(spark):
    edges = both_ways([(1, 2), (2, 3), (3, 4), (4, 1), (1, 5)])
    given = {1: 0, 2: None, 3: 0, 4: None, 5: None}
    run = graph.color_graph(*frames(spark, given, edges))
    want, rounds, _ = color_rounds(given, edges)
    assert as_dict(run.colors) == want == {1: 0, 2: 1, 3: 0, 4: 1, 5: 1}
    assert run.rounds == rounds == 1


@pytest.mark.parametrize("k,ok", [(2, False), (3, True)])
def test_color_limit_on_triangle(spark, k, ok):
    edges = both_ways([(0, 1), (1, 2), (0, 2)])
    blank = {i: None for i in range(3)}
    run = graph.color_graph(*frames(spark, blank, edges), k_max=k)
    _, rounds, fails = color_rounds(blank, edges, k)
    assert (run.success, run.candidate_fails, run.rounds) == (ok, fails, rounds)
    assert run.best_k == (3 if ok else -1)


def test_round_limit(spark):
    edges = both_ways([(i, i + 1) for i in range(9)])
    blank = {i: None for i in range(10)}
    run = graph.color_graph(*frames(spark, blank, edges), max_rounds=2)
    want, _, _ = color_rounds(blank, edges, max_rounds=2)
    assert as_dict(run.colors) == want and not run.success and run.rounds == 2
    table = {r["round"]: tuple(r)[1:] for r in graph.coloring_rounds(run).collect()}
    assert table[1] == (10, 28, 9, 1)


def test_hash_order_needs_fewer_rounds(spark):
    edges = both_ways([(i, i + 1) for i in range(39)])
    blank = {i: None for i in range(40)}
    by_id = graph.color_graph(*frames(spark, blank, edges))
    by_hash = graph.color_graph(*frames(spark, blank, edges), priority="hash")
    assert by_id.success and by_hash.success and by_hash.rounds < by_id.rounds / 2
    colors = as_dict(by_hash.colors)
    assert all(colors[a] != colors[b] for a, b in edges)


def test_graphs_without_edges(spark):
    nodes, edges = frames(spark, {1: None, 2: None}, {(1, 2)})
    run = graph.color_graph(nodes, edges.limit(0))
    assert as_dict(run.colors) == {1: 0, 2: 0} and run.best_k == 1
    empty = graph.color_graph(nodes.limit(0), edges.limit(0))
    assert (empty.best_k, empty.success, empty.rounds) == (0, True, 0)


def test_degrees(spark):
    nodes, edges = frames(spark, {1: None, 2: None, 3: None, 4: None}, both_ways([(1, 2), (1, 3)]))
    assert {tuple(r) for r in graph.degrees(nodes, edges).collect()} == {
        (1, 2),
        (2, 1),
        (3, 1),
        (4, 0),
    }
    assert tuple(graph.degree_stats(nodes, edges).first()) == (4, 2, 1.0)


def test_normalize(spark):
    pairs = [(1, 2), (2, 1), (1, 2), (3, 3), (None, 1), (4, None)]
    edges = spark.createDataFrame(pairs, "a int, b int")
    got = {tuple(r) for r in graph.normalize_edges(edges, "a", "b").collect()}
    assert got == {(1, 2), (2, 1)}


def test_edges_from_shared_key(spark):
    rows = [("x", 3), ("x", 1), ("x", 2), ("x", 3), ("y", 3), ("y", 2), ("z", 9), (None, 1), ("z", None)]
    df = spark.createDataFrame(rows, "k string, i int")
    got = {tuple(r) for r in graph.edges_from_shared_key(df, key="k", item="i").collect()}
    assert got == both_ways([(1, 2), (1, 3), (2, 3)])


def test_validate_reports_injected_defects(spark):
    edges = both_ways([(1, 2), (2, 3), (3, 4), (1, 4)])
    nodes, e = frames(spark, {1: 0, 2: 0, 3: 1, 4: None}, edges | {(4, 2)})
    assert tuple(graph.validate(nodes, e).first()) == (False, 1, 1, 1)
    assert [tuple(r) for r in graph.conflict_sample(nodes, e).collect()] == [(1, 2, 0)]
    fine, e = frames(spark, {1: 0, 2: 1, 3: 0, 4: 1}, edges)
    assert tuple(graph.validate(fine, e).first()) == (True, 0, 0, 0)


def test_histogram(spark):
    nodes, _ = frames(spark, {1: 0, 2: 1, 3: 0}, {(1, 2)})
    assert {tuple(r) for r in graph.color_histogram(nodes).collect()} == {(0, 2), (1, 1)}


@pytest.mark.parametrize("n,degree", [(1, 0), (2, 1), (9, 3), (50, 7), (51, 6), (12, 99), (40, 1)])
def test_generate(spark, n, degree):
    nodes, edges = graph.generate_graph(spark, n, degree, seed=5)
    got = [tuple(r) for r in edges.collect()]
    assert nodes.count() == n
    assert len(got) == len(set(got))
    assert all((b, a) in set(got) and a != b and 0 <= a < n for a, b in got)
    counts = graph.degree_stats(nodes, edges).first()
    assert counts["max_degree"] <= min(degree, n - 1)


def test_generate_depends_on_seed_only(spark):
    def pairs(seed):
        return {tuple(r) for r in graph.generate_graph(spark, 200, 8, seed)[1].collect()}

    assert pairs(1) == pairs(1) != pairs(2)
    assert 1500 < len(pairs(1)) <= 1600


@pytest.mark.parametrize("n,degree", [(501, 7), (400, 6)])
def test_generate_reaches_the_limit_between_any_ids(spark, n, degree):
    nodes, edges = graph.generate_graph(spark, n, degree, seed=9)
    degrees = [r["degree"] for r in graph.degrees(nodes, edges).collect()]
    assert max(degrees) == degree and sum(d == degree for d in degrees) >= 0.98 * n
    # Distances between linked ids are spread evenly, on the ring and in parity.
    apart = [(b - a) % n for a, b in edges.collect()]
    quarters = [sum(q * n <= 4 * d < (q + 1) * n for d in apart) / len(apart) for q in range(4)]
    assert all(0.2 < q < 0.3 for q in quarters)
    assert 0.42 < sum(d % 2 for d in apart) / len(apart) < 0.58


def test_generate_links_two_nodes_once(spark):
    nodes, edges = graph.generate_graph(spark, 2, 1, seed=3)
    assert {tuple(r) for r in edges.collect()} == {(0, 1), (1, 0)}
    assert graph.generate_graph(spark, 5, 0)[1].count() == 0


@pytest.mark.parametrize("n,degree", [(0, 1), (5, -1)])
def test_generate_rejects_bad_sizes(spark, n, degree):
    with pytest.raises(ValueError):
        graph.generate_graph(spark, n, degree)


def test_rounds_are_as_wide_as_the_edges_need(spark, monkeypatch):
    """A small graph is not cut into as many tasks as the session's shuffles have."""
    widths, plain = [], Scratch.write_bucketed

    def seen(self, df, step, keys, buckets):
        widths.append((buckets, int(spark.conf.get("spark.sql.shuffle.partitions"))))
        return plain(self, df, step, keys, buckets)

    monkeypatch.setattr(Scratch, "write_bucketed", seen)
    rng = random.Random(3)
    edges = both_ways({tuple(sorted(rng.sample(range(60), 2))) for _ in range(150)})
    blank = {i: None for i in range(60)}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    cores = spark.sparkContext.defaultParallelism
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "97")
        assert graph.color_graph(*frames(spark, blank, edges)).success
        assert spark.conf.get("spark.sql.shuffle.partitions") == "97"
        assert widths == [(cores, cores)]
        # More edges than a bucket should hold make more buckets.
        monkeypatch.setattr(coloring, "BUCKET_EDGES", 1 + len(edges) // (cores + 5))
        assert not graph.color_graph(*frames(spark, blank, edges), k_max=1).success
        assert spark.conf.get("spark.sql.shuffle.partitions") == "97"
        assert cores < widths[1][0] == widths[1][1] < 97
        # Written again as edges are finished, and restored if a round fails.
        monkeypatch.setattr(coloring, "BUCKET_EDGES", 1_000_000)
        assert graph.color_graph(*frames(spark, blank, edges), compact_edges=0).success
        assert len(widths) > 3
        monkeypatch.setattr(coloring, "_round", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            graph.color_graph(*frames(spark, blank, edges))
        assert spark.conf.get("spark.sql.shuffle.partitions") == "97"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
