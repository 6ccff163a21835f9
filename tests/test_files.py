"""Readers, writers and whole jobs."""

import json

import pytest
from pyspark.errors import PySparkException

from sparkloom.operators import graph
from sparkloom.plans import graph_job, track_report
from sparkloom.sources import graph_files, reports, tables
from sparkloom.streaming import change_stream, graph_versions, stream_changes

HEADER = ",track_id,artists,album_name,track_name,popularity,duration_ms,explicit,danceability,energy,key,loudness,mode,speechiness,acousticness,instrumentalness,liveness,valence,tempo,time_signature,track_genre"


def track(i, artists="A", album="al", name="n", pop=50, explicit="False", dance=0.5, tempo=110, genre="rock", acoustic=0.1):
    return (
        f'{i},t{i},{artists},{album},{name},{pop},{60000 + 1000 * i},{explicit},{dance},0.5,1,-5.0,'
        f"0,0.1,{acoustic},{acoustic},0.1,0.4,{tempo},4,{genre}"
    )


def csv_file(tmp_path, lines):
    path = tmp_path / "tracks.csv"
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def test_csv_quotes_and_malformed_rows(spark, tmp_path):
    lines = [
        track(0),
        track(1, artists='"Joe ""Co, Co"" D"'),
        track(2, pop="many"),
        "3,too,short",
        track(4, name=""),
    ]
    path = csv_file(tmp_path, lines)
    got = track_report.stored(tables.read_tracks(spark, path), str(tmp_path / "copy"))
    assert len(got.columns) == 20 and got.columns == HEADER.split(",")[1:]
    artists = {r["track_id"]: r["artists"] for r in got.collect()}
    assert artists["t1"] == 'Joe "Co, Co" D'
    assert set(artists) == {"t0", "t1", "t4"}
    # The same rows whatever is read of them.
    assert got.count() == got.select("track_id").count() == 3
    backslash = tables.read_tracks(spark, path, rfc4180=False)
    assert {r["track_id"] for r in backslash.collect()} == {"t0", "t4"}


def test_csv_is_judged_whatever_is_read(spark, tmp_path):
    path = tmp_path / "t.csv"
    lines = [
        "id,name,ok,x", "1,a,true,0.5", "two,b,true,1", "3,c,maybe,x", "4,d,FALSE,", "5,e", "6,f,true,1,9",
        ',"",,', '7,"a ""b"", c",True,-1e3', "99999999999,g,true,1", " 8,h,true,1", "9,i,true,NaN",
    ]
    path.write_text("\n".join(lines) + "\n")
    parsed = tables.parse_csv(spark, str(path), "id int, name string, ok boolean, x double")
    rows = {r["id"]: tuple(r)[1:] for r in parsed.rows.where("x IS NULL OR x = x").collect()}
    assert rows[7] == ('a "b", c', True, -1000.0) and rows[4] == ("d", False, None)
    assert set(rows) == {1, 4, None, 7, 9} and rows[None] == (None, None, None)
    counts = {parsed.rows.select(c).count() for c in parsed.rows.columns}
    assert counts == {parsed.rows.count()} == {5}
    reasons = {r["record"].split(",")[0]: r["reason"] for r in parsed.rejected.collect()}
    assert reasons == {"two": "id", "3": "ok,x", "5": "fields", "6": "fields", "99999999999": "id", " 8": "id"}
    assert parsed.rejected.count() == parsed.rejected.select("reason").count() == 6
    (tmp_path / "none.csv").write_text("id,name\n")
    empty = tables.parse_csv(spark, str(tmp_path / "none.csv"), "id int, name string")
    assert empty.rows.count() == empty.rejected.count() == 0
    with pytest.raises(ValueError):
        tables.parse_csv(spark, str(path), "_corrupt_record string")


def test_empty_csv(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.read_tracks(spark, csv_file(tmp_path, []))


def test_track_report(spark, tmp_path):
    lines = []
    for i in range(60):
        lines.append(
            track(
                i,
                artists=["A", "B", "A;B", "C"][i % 4],
                album=f"al{i % 7}",
                pop=(i * 37) % 101,
                explicit=str(i % 3 == 0),
                dance=0.85 if i % 2 else 0.4,
                tempo=80 + i,
                genre=f"g{i % 6}",
                acoustic=0.9 if i % 5 == 0 else 0.1,
            )
        )
    lines += [track(90, dance=1.5), track(91, genre="")]
    out = str(tmp_path / "out")
    extra = {"10_mine": lambda t: {"rows": t.groupBy("track_genre").count()}}
    metrics = track_report.run(spark, csv_file(tmp_path, lines), out, extra)
    names = [r["name"] for r in metrics.orderBy("step").collect()]
    assert set(track_report.ANALYSES) | {"10_mine", "whole run"} <= set(names)
    report = spark.read.json(f"{out}/00_cleaning/report").first()
    assert (report["rows_in"], report["removed_null"], report["removed_range"]) == (62, 1, 1)
    columns = spark.read.json(f"{out}/01_distribution/columns")
    assert columns.count() == 20 and columns.first()["row_count"] == 60
    top = spark.read.json(f"{out}/02_collaborations/top_groups").first()
    assert (top["artists"], top["group_count"]) == ("A;B", 15)
    assert spark.read.json(f"{out}/06_long_danceable/top").count() == 10
    assert spark.read.json(f"{out}/10_mine/rows").count() == 6
    about = spark.read.json(f"{out}/09_acoustic_vocal/about").first()
    assert about["analysis_name"] == "09_acoustic_vocal"


def test_run_metrics(spark):
    got = {r["name"]: tuple(r) for r in reports.run_metrics(spark, [("a", 30), ("b", 10)], 80).collect()}
    assert got["a"] == (1, "a", 30.0, 37.5)
    assert got["all analyses"][2:] == (40.0, 50.0) and got["mean per analysis"][2] == 20.0


def write_json(tmp_path, name, value):
    path = tmp_path / name
    path.write_text(json.dumps(value, indent=1))
    return str(path)


def test_graph_round_trip(spark, tmp_path):
    records = [
        {"id": 1, "neighbors": [2, 2, 1, 3], "color": 0},
        {"id": 2, "neighbors": [1], "color": -1},
        {"id": 3, "neighbors": None, "color": 2},
        {"id": 4},
    ]
    nodes, edges = graph_files.read_graph(spark, write_json(tmp_path, "g.json", records))
    want_nodes = {(1, 0), (2, -1), (3, 2), (4, -1)}
    want_edges = {(1, 2), (1, 3), (2, 1)}
    assert {tuple(r) for r in nodes.collect()} == want_nodes
    assert {tuple(r) for r in edges.collect()} == want_edges
    for name, slot_edges in (("whole", 1000), ("split", 1)):
        path = str(tmp_path / name)
        graph_files.write_graph(nodes, edges, path, slot_edges=slot_edges)
        again_nodes, again_edges = graph_files.read_graph(spark, path)
        assert {tuple(r) for r in again_nodes.collect()} == want_nodes
        assert {tuple(r) for r in again_edges.collect()} == want_edges
    assert spark.read.json(str(tmp_path / "split")).count() >= 4


@pytest.mark.parametrize("indent", [None, 1])
def test_large_arrays_are_read_in_parallel(spark, tmp_path, indent):
    changes = [{"type": "ADD_EDGE", "nodeIdA": 3 * i, "nodeIdB": 3 * i + 1} for i in range(20_000)]
    path = tmp_path / "log.json"
    path.write_text(json.dumps(changes, indent=indent))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(path.stat().st_size // 7))
    try:
        pieces = graph_files._array_pieces(spark, str(path))
        assert pieces.where("value LIKE '%{%'").select("block").distinct().count() >= 6
        log = graph_files.read_changes(spark, str(path)).collect()
        assert sorted((r["seq"], r["a"], r["b"]) for r in log) == [
            (i, 3 * i, 3 * i + 1) for i in range(20_000)
        ]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_arrays_of_any_form(spark, tmp_path):
    def ids(name, *texts):
        folder = tmp_path / name
        folder.mkdir()
        for i, text in enumerate(texts):
            (folder / f"{i}.json").write_text(text)
        nodes, edges = graph_files.read_graph(spark, str(folder), json_lines=False)
        return sorted(r["id"] for r in nodes.collect()), sorted(map(tuple, edges.collect()))

    one, two = '[\n {"id": 1, "neighbors": [2]}\n,\n{"id": 2}\n]\n', '[{"id":3,"neighbors":[]} ]'
    assert ids("several", one, two, " [ ] ") == ([1, 2, 3], [(1, 2)])
    # Braces inside a record: the file is read as one text.
    assert ids("nested", '[{"id": 1, "more": {"x": "}"}, "neighbors": [4]},\n{"id": 4}]') == ([1, 4], [(1, 4)])
    for number, broken in enumerate(
        ('[{"id": 1}', '[{"id": 1} {"id": 2}]', '[{"id": 1}]]', '{"id": 1},\n{"id": 2}]', '[{"id": x}]')
    ):
        with pytest.raises((PySparkException, ValueError)):
            ids(f"broken{number}", broken)


def test_bad_graph_files(spark, tmp_path):
    with pytest.raises(ValueError):
        graph_files.read_graph(spark, write_json(tmp_path, "none.json", []))
    with pytest.raises((PySparkException, ValueError)):
        graph_files.read_graph(spark, str(tmp_path / "missing.json"))
    broken = tmp_path / "broken.json"
    broken.write_text('[{"id": 1, "neighbors": [')
    with pytest.raises(ValueError):
        graph_files.read_graph(spark, str(broken))


def test_read_changes(spark, tmp_path):
    log = [
        {"type": "remove_edge", "nodeIdA": 5, "nodeIdB": 10},
        {"type": "ADD_NODE", "nodeIdA": 1001, "neighbors": [5, 10, 15]},
        {"type": "Add_Edge", "nodeIdA": 20, "nodeIdB": 25},
        {"type": "REMOVE_NODE", "nodeIdA": 3},
    ]
    want = [
        (0, "REMOVE_EDGE", 5, 10, None),
        (1, "ADD_NODE", 1001, None, [5, 10, 15]),
        (2, "ADD_EDGE", 20, 25, None),
        (3, "REMOVE_NODE", 3, None, None),
    ]
    got = graph_files.read_changes(spark, write_json(tmp_path, "log.json", log))
    assert [tuple(r) for r in got.orderBy("seq").collect()] == want
    lines = tmp_path / "log.jsonl"
    lines.write_text("\n".join(json.dumps({"seq": i, **c}) for i, c in enumerate(log)))
    got = graph_files.read_changes(spark, str(lines))
    assert [tuple(r) for r in got.orderBy("seq").collect()] == want


@pytest.mark.parametrize(
    "change",
    [
        {"type": "PAINT", "nodeIdA": 1},
        {"nodeIdA": 1},
        {"type": "ADD_NODE", "nodeIdA": 1},
        {"type": "ADD_EDGE", "nodeIdA": 1},
        {"type": "REMOVE_EDGE", "nodeIdA": 1},
        {"type": "REMOVE_NODE"},
    ],
)
def test_bad_changes(spark, tmp_path, change):
    log = graph_files.read_changes(spark, write_json(tmp_path, "bad.json", [change]))
    with pytest.raises(PySparkException):
        log.collect()


def test_nothing_is_read_in_part(spark, tmp_path):
    twice = tmp_path / "twice.json"
    twice.write_text('[{"id": 1}]\n[{"id": 2}]')
    nodes, _ = graph_files.read_graph(spark, str(twice))
    assert {r["id"] for r in nodes.collect()} == {1, 2}
    trailing = tmp_path / "trailing.json"
    trailing.write_text('[\n{"id": 1}\n]\n[{"id": 2}]')
    with pytest.raises(ValueError):
        graph_files.read_graph(spark, str(trailing))
    with pytest.raises(Exception):
        change = '[{"type": "REMOVE_NODE", "nodeIdA": 1}]'
        trailing.write_text(change + "\n" + change)
        graph_files.read_changes(spark, str(trailing)).collect()
    folder = tmp_path / "logs"
    folder.mkdir()
    for i in range(2):
        (folder / f"{i}.json").write_text(change)
    with pytest.raises(ValueError):
        graph_files.read_changes(spark, str(folder))


def test_graph_job(spark, tmp_path):
    log = [{"type": "ADD_NODE", "nodeIdA": 500, "neighbors": [1, 2]}]
    prefix, out = str(tmp_path / "m"), str(tmp_path / "graph")
    done = graph_job.run(
        spark,
        generate=60,
        max_degree=4,
        average=True,
        coloring=True,
        validation=True,
        incremental=True,
        changes_path=write_json(tmp_path, "log.json", log),
        metrics_prefix=prefix,
        output_graph=out,
        output_result=str(tmp_path / "result"),
    )
    assert done.success and done.best_k <= 5
    degree = spark.read.json(f"{prefix}_avg_degree.json").first()
    assert degree["node_count"] == 60 and degree["max_degree"] <= 4
    assert spark.read.json(f"{prefix}_coloring_optimized.json").first()["bestK"] == done.best_k
    assert spark.read.json(f"{prefix}_validation.json").first()["is_valid"]
    assert spark.read.json(f"{prefix}_incremental_validation.json").first()["conflict_count"] == 0
    nodes, edges = graph_files.read_graph(spark, out)
    assert nodes.count() == 61 and edges.filter("src = 500").count() == 2
    summary = spark.read.json(str(tmp_path / "result" / "summary")).first()
    assert (summary["chromaticNumber"], summary["nodeCount"]) == (done.best_k, 61)


def test_graph_job_options(spark):
    with pytest.raises(ValueError):
        graph_job.run(spark, generate=5)
    with pytest.raises(ValueError):
        graph_job.run(spark, generate=5, max_degree=2, incremental=True)
    with pytest.raises(ValueError):
        graph_job.run(spark, input_path="/x/g", output_graph="/x/g/", coloring=True)


def test_stream_fails_on_a_bad_record(spark, tmp_path):
    logs, state, marks = (str(tmp_path / d) for d in ("logs", "state", "marks"))
    spark.createDataFrame([(0, 0)], "id long, color int").write.parquet(f"{state}/version=0/nodes")
    spark.createDataFrame([], "src long, dst long").write.parquet(f"{state}/version=0/edges")
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "a.json").write_text(json.dumps({"seq": 0, "type": "PAINT", "a": 0}))
    query = stream_changes(spark, logs, state, 3, checkpoint_dir=marks)
    with pytest.raises(PySparkException):
        query.awaitTermination(120)


def test_stream_changes(spark, tmp_path):
    logs, state, marks = (str(tmp_path / d) for d in ("logs", "state", "marks"))
    first = [(0, 0), (1, 1), (2, 0)]
    edges = [(0, 1), (1, 0), (1, 2), (2, 1)]
    spark.createDataFrame(first, "id long, color int").write.parquet(f"{state}/version=0/nodes")
    spark.createDataFrame(edges, "src long, dst long").write.parquet(f"{state}/version=0/edges")
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "a.json").write_text(
        json.dumps({"seq": 0, "type": "ADD_EDGE", "a": 0, "b": 2})
    )
    stream_changes(spark, logs, state, 3, checkpoint_dir=marks).awaitTermination(120)
    (tmp_path / "logs" / "b.json").write_text(
        json.dumps({"seq": 1, "type": "ADD_NODE", "a": 7, "neighbors": [0]})
    )
    stream_changes(spark, logs, state, 3, checkpoint_dir=marks).awaitTermination(120)
    nodes, edges = graph_versions(spark, state).read(2)
    assert nodes.count() == 4 and edges.count() == 8
    assert tuple(graph.validate(nodes, edges).first()) == (True, 0, 0, 0)


def test_stream_writes_deltas_and_compacts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(change_stream, "COMPACT_BATCHES", 2)
    logs, state, marks = (str(tmp_path / d) for d in ("logs", "state", "marks"))
    ring = [(i, (i + 1) % 400) for i in range(400)]
    both = ring + [(b, a) for a, b in ring]
    versions = graph_versions(spark, state)
    versions.put_whole(
        0,
        spark.createDataFrame([(i, i % 2) for i in range(400)], "id long, color int"),
        spark.createDataFrame(both, "src long, dst long"),
    )
    (tmp_path / "logs").mkdir()
    for turn in range(3):
        change = {"seq": turn, "type": "ADD_NODE", "a": 1000 + turn, "neighbors": [10 * turn, 10 * turn + 1]}
        (tmp_path / "logs" / f"{turn}.json").write_text(json.dumps(change))
        stream_changes(spark, logs, state, 3, checkpoint_dir=marks).awaitTermination(120)
    nodes, edges = versions.read(3)
    assert nodes.count() == 403 and edges.count() == 812
    assert tuple(graph.validate(nodes, edges).first()) == (True, 0, 0, 0)
    # A batch writes what it changes, and every second one the whole graph.
    assert spark.read.parquet(f"{state}/delta=3/edges").count() == 4
    assert spark.read.parquet(f"{state}/delta=3/nodes").count() <= 5
    assert spark.read.parquet(f"{state}/version=2/nodes").count() == 402
    assert not (tmp_path / "state" / "version=3").exists()
    # A batch that runs again writes the same version, and its change counts once.
    before = versions.read(2)
    batch = spark.read.schema(change_stream.LOG_SCHEMA).json(f"{logs}/2.json")
    node_delta, edge_delta, done = graph.recolor_part(*before, batch, 3)
    versions.put_delta(3, node_delta, edge_delta)
    assert done.success and versions.read(3)[1].count() == 812
