import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from sparkloom.llm import posting_lists, words


def test_releasing_hands_back_arrow_memory(monkeypatch):
    released = []

    class Pool:
        def release_unused(self):
            released.append(True)

    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3])], ["x"])

    def run(batches):
        for b in batches:
            yield b.slice(1)

    out = list(words.releasing(run)(iter([batch, batch])))
    assert [b.to_pydict() for b in out] == [{"x": [2, 3]}] * 2
    assert released == [True]


@pytest.fixture(scope="module")
def listed():
    """3,000 vectors and an index of them whose queries read all of its lists."""
    x = np.random.default_rng(4).normal(size=(3000, 16))
    index = posting_lists.build_index(x, 400_000, float(np.linalg.norm(x, axis=1).max()))
    index.ratio, index.held = np.inf, np.full(len(index.centers), 10)
    return x, index


@pytest.mark.parametrize("k", [None, 20])
def test_listed_rows_come_in_bounded_pieces(listed, k):
    x, index = listed
    frame = pd.DataFrame({"id": np.arange(len(x)), "v": list(x)})
    lists = index.read_by(x, k) if k else index.lists_of(x)
    pieces = list(posting_lists._postings({16: index}, k)(iter([frame])))
    assert max(map(len, pieces)) * 16 <= posting_lists.VALUES
    assert len(pieces) > 1 or not k
    got = pd.concat(pieces)
    assert got["id"].tolist() == [i for i, rows in enumerate(lists) for _ in rows]
    assert (got["part"] - 16 * posting_lists.CENTROIDS).tolist() == np.concatenate(lists).tolist()
    assert got.loc[got["first"], "id"].tolist() == list(range(len(x)))
    assert all((v == x[i]).all() for i, v in zip(got["id"], got["v"], strict=True))


def test_distances_to_centroids_are_bounded(listed, monkeypatch):
    x, index = listed
    want = index.lists_of(x)
    sizes, plain = [], posting_lists._distances

    def seen(rows, centers):
        sizes.append(len(rows) * len(centers))
        return plain(rows, centers)

    monkeypatch.setattr(posting_lists, "_distances", seen)
    monkeypatch.setattr(posting_lists, "DISTANCES", 10_000)
    got = index.lists_of(x)
    assert max(sizes) <= 10_000 and len(sizes) > 1
    assert [g.tolist() for g in got] == [w.tolist() for w in want]


def tiles(x, queries, blocks):
    """All queries and the rows of each block, as one sorted run of tiles."""
    rows = [
        {"part": 7, "block": b, "deal": 0, "candidate": c, "id": int(i), "v": x[i].tolist()}
        for b, ids in enumerate(blocks)
        for c, some in ((0, queries), (1, ids))
        for i in some
    ]
    numbers = [(n, pa.int32()) for n in ("block", "deal", "candidate")]
    schema = [("part", pa.int64()), *numbers, ("id", pa.int64()), ("v", pa.list_(pa.float64()))]
    return pa.Table.from_pylist(rows, pa.schema(schema))


@pytest.mark.parametrize("batch", [100, 10_000])
def test_scores_are_bounded(listed, monkeypatch, batch):
    x, _ = listed
    queries = np.arange(0, 3000, 5)
    # The last block has no rows, and a part after it no queries.
    given = tiles(x, queries, [*np.array_split(np.arange(3000), 3), []])
    lone = tiles(x, [], [np.arange(50)]).set_column(0, "part", pa.array([9] * 50))
    given = pa.concat_tables([given, lone])
    sizes, plain = [], np.einsum

    def seen(sums, q, rows):
        sizes.append(len(q) * len(rows))
        return plain(sums, q, rows)

    monkeypatch.setattr(np, "einsum", seen)
    monkeypatch.setattr(posting_lists, "SCORES", 50_000)
    batches = given.combine_chunks().to_batches(batch)
    got = pa.Table.from_batches(posting_lists._searched(20)(iter(batches))).to_pandas()
    assert max(sizes) <= 50_000 and sum(sizes) == 600 * 3000
    scores = x[::5] @ x.T
    scores[np.arange(600), queries] = -np.inf
    want = np.argsort(-scores, axis=1)[:, :20]
    rows = got.groupby("query_id").vec_id.agg(list)
    assert rows.index.tolist() == queries.tolist() and rows.tolist() == want.tolist()


def test_nearest_in_many_blocks_and_deals(spark, monkeypatch):
    draw = np.random.default_rng(6)
    x = draw.normal(size=(1500, 8)).round(1)
    x[100:400] = x[100]  # one long list of copies
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5, x[700].tolist()), (5, x[5].tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    find = lambda: posting_lists.nearest(frame, lambda i: i % 5 == 0).orderBy("query_id", "rank")
    want = find().collect()
    monkeypatch.setattr(posting_lists, "ROWS", 50)
    monkeypatch.setattr(posting_lists, "HELD", 400)
    monkeypatch.setattr(posting_lists, "VALUES", 256)
    assert find().collect() == want and len(want) == 300 * 20
