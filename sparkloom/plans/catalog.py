"""Every operator as a query over the test tables, by the same keys as ``oracles``.

Averages are rounded to six digits here, not in the operators, so that sums
taken in another order compare equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions import by_bounds, equal_width
from ..operators import cohort, collab, consistency, graph, outlier, profile, quality, sweetspot, topk
from ..scratch import Scratch
from ..sources import reports
from ..sources.graph_files import read_changes, read_graph, write_coloring, write_graph
from ..sources.tables import parse_csv
from ..streaming.change_stream import graph_versions, stream_changes
from . import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

RANGES = quality.unit_ranges(["feature_a", "feature_b"])
REQUIRED = ["genre", "feature_a"]
ITEM_KEY = ["album", "part", "line"]
FEATURES = ["feature_a", "feature_b"]
LONGEST = dict(by="genre", score="score", rank_by="duration", feature="feature_a", keep=ITEM_KEY)
SWEET = dict(by="genre", score="score", x="tempo")
STEADY = dict(entity="artists", score="score")
CREDIT = dict(members="members", score="score")
GENERATED_DEGREE = 7


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits; other columns as they are."""
    return df.select(
        *[
            F.round(f.name, 6).alias(f.name) if isinstance(f.dataType, DoubleType) else f.name
            for f in df.schema
        ]
    )


def on_items(run: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: run(fx.items(spark, sf))


def on_raw(run: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: run(fx.raw_items(spark, sf))


def on_credits(run: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: rounded(run(fx.credits(spark, sf)))


def on_graph(run: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: run(fx.part_nodes(spark, sf), fx.part_edges(spark, sf))


def _impact(items: DataFrame) -> DataFrame:
    return cohort.flag_impact(items, by="genre", flag="flag", score="score", threshold=2.0)


def _flag_buckets(items: DataFrame) -> DataFrame:
    return cohort.flag_by_bucket(items, score="score", flag="flag", value="feature_a")


def _cohorts(items: DataFrame) -> DataFrame:
    return cohort.two_cohorts(items, by="genre", features=FEATURES, score="score")


def _numeric(items: DataFrame) -> DataFrame:
    columns = ["score", *FEATURES, "tempo", "duration", "album"]
    return rounded(profile.profile_numeric(items, columns, exact=True))


def _spread(items: DataFrame) -> DataFrame:
    profiled = profile.profile_numeric(items, ["duration", "part", "album"])
    return rounded(profiled.select("column", "mean", "stddev", "min", "max"))


def _undirected(edges: DataFrame) -> DataFrame:
    return edges.filter("src < dst").select(F.col("src").alias("u"), F.col("dst").alias("v"))


def _colored(nodes: DataFrame, edges: DataFrame, **options) -> graph.Coloring:
    run = graph.color_graph(nodes, edges, **options)
    if not run.success:
        raise RuntimeError("the colouring did not finish")
    return run


def _color_count(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    run = _colored(nodes, edges)
    return run.colors.agg(
        F.lit(run.best_k).alias("best_k"), F.count(F.lit(1)).alias("node_count")
    )


def _graph_and_log(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes, half-edges and change log, written once as each is read several times."""
    scratch = Scratch(spark, "graph_and_log")
    return (
        fx.part_nodes(spark, sf),
        scratch.write(fx.part_edges(spark, sf), "edges"),
        scratch.write(fx.part_changes(spark, sf), "changes"),
    )


def _apply_changes(spark: SparkSession, sf: str) -> DataFrame:
    nodes, edges = graph.apply_changes(*_graph_and_log(spark, sf))
    null = F.lit(None).cast("bigint").alias("b")
    return edges.select(
        F.lit("edge").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b")
    ).unionByName(nodes.select(F.lit("node").alias("kind"), F.col("id").alias("a"), null))


def _affected(spark: SparkSession, sf: str) -> DataFrame:
    nodes, edges, changes = _graph_and_log(spark, sf)
    return graph.affected_nodes(*graph.apply_changes(nodes, edges, changes), changes)


def _recolor(spark: SparkSession, sf: str) -> DataFrame:
    nodes, edges, changes = _graph_and_log(spark, sf)
    first = graph.color_graph(nodes, edges, stored=True)
    done = graph.recolor(first.colors, edges, changes, first.best_k, allow_new_colors=True)
    return done.nodes.select("id", "color")


def _recolor_fixed_k(spark: SparkSession, sf: str) -> DataFrame:
    """Recolouring with no new colours; too few keep the old colours."""
    nodes, edges, changes = _graph_and_log(spark, sf)
    first = graph.color_graph(nodes, edges, stored=True)
    done = graph.recolor(first.colors, edges, changes, first.best_k)
    return done.nodes.select("id", F.when(F.col("color") >= 0, F.col("color")).alias("color"))


def _graph_json(spark: SparkSession, sf: str) -> DataFrame:
    """The part graph with striped colours, written as JSON and read again."""
    path = f"{Scratch(spark, 'graph_json').path}/graph"
    write_graph(fx.striped_colors(spark, sf), fx.part_edges(spark, sf), path)
    nodes, edges = read_graph(spark, path)
    null = F.lit(None).cast("bigint")
    return edges.select(
        F.col("src").alias("a"), F.col("dst").alias("b"), F.lit(None).cast("int").alias("color")
    ).unionByName(nodes.select(F.col("id").alias("a"), null.alias("b"), "color"))


def _change_log(spark: SparkSession, sf: str) -> DataFrame:
    """The change log, written as JSON lines and read again."""
    path = f"{Scratch(spark, 'change_log').path}/log"
    log = fx.part_changes(spark, sf)
    log.select(
        "seq", "type", F.col("a").alias("nodeIdA"), F.col("b").alias("nodeIdB"), "neighbors"
    ).write.json(path)
    again = read_changes(spark, path)
    return again.withColumn("neighbors", F.array_join("neighbors", ","))


def _change_log_array(spark: SparkSession, sf: str) -> DataFrame:
    """The change log as one JSON array in one file, whose order becomes ``seq``."""
    path = f"{Scratch(spark, 'change_log_array').path}/log"
    log = fx.part_changes(spark, sf)
    record = F.to_json(
        F.struct("type", F.col("a").alias("nodeIdA"), F.col("b").alias("nodeIdB"), "neighbors")
    )
    first, last = log.agg(F.min("seq"), F.max("seq")).first()
    lines = log.orderBy("seq").coalesce(1)  # an array is one file
    begin = F.when(F.col("seq") == F.lit(first), "[").otherwise(",")
    end = F.when(F.col("seq") == F.lit(last), "]").otherwise("")
    lines.select(F.concat(begin, F.lit("\n  "), record, end).alias("value")).write.text(path)
    again = read_changes(spark, path)
    return again.withColumn("neighbors", F.array_join("neighbors", ","))


def _coloring_json(spark: SparkSession, sf: str) -> DataFrame:
    """Striped colours, written as a result and read again with their summary."""
    path = f"{Scratch(spark, 'coloring_json').path}/result"
    write_coloring(fx.striped_colors(spark, sf), 3, path)
    nodes = spark.read.schema("nodeId bigint, color int").json(f"{path}/assignments")
    summary = spark.read.schema("chromaticNumber int, nodeCount bigint").json(f"{path}/summary")
    per_color = nodes.groupBy("color").agg(F.count("*").alias("node_count"))
    return per_color.unionByName(
        summary.select(F.col("chromaticNumber").alias("color"), F.col("nodeCount").alias("node_count"))
    )


def _csv_read(spark: SparkSession, sf: str) -> DataFrame:
    """The items as CSV with planted bad records, read back as rows and rejected records.

    Rejected are a word for a number, a fraction for a whole number, another word
    for a truth value, one field too many and one too few.
    """
    path = f"{Scratch(spark, 'csv_read').path}/items"
    line, part = F.col("line"), F.col("part")
    quoted = F.concat(F.lit('"a ""'), F.col("genre"), F.lit('"", b"'))
    genre = F.when(line == 1, quoted).when(line == 2, F.lit("")).otherwise(F.col("genre"))
    score = F.when((line == 3) & (part % 5 == 0), "many").otherwise(F.col("score").cast("string"))
    score = F.when((line == 4) & (part % 5 == 0), F.concat(score, F.lit(".5"))).otherwise(score)
    flag = F.when((line == 3) & (part % 3 == 0), "yes").otherwise(F.col("flag").cast("string"))
    fields = ["album", "part", "line", genre, score, flag, F.col("duration").cast("string")]
    record = F.concat_ws(",", *fields)
    record = F.when((line == 5) & (part % 4 == 0), F.concat(record, F.lit(",")))\
        .when((line == 5) & (part % 4 == 1), F.concat_ws(",", *fields[:-1])).otherwise(record)
    fx.items(spark, sf).select(record.alias("value")).write.text(path)
    schema = "album long, part long, line int, genre string, score int, flag boolean, duration double"
    parsed = parse_csv(spark, path, schema, header=False)
    columns = ["album", "part", "line", "genre", "score", "flag", "duration"]
    rows = parsed.rows.select(F.lit("row").alias("reason"), *columns)
    empty = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in columns[1:]]
    album = F.element_at(F.split("record", ","), 1).cast("long").alias("album")
    return rows.unionByName(parsed.rejected.select("reason", album, *empty))


def _report(spark: SparkSession, sf: str) -> DataFrame:
    """A result of two parts and metrics, written and read again, NaN and infinities included."""
    folder = Scratch(spark, "report").path
    items = fx.items(spark, sf)
    score = F.col("score").cast("double")
    by_genre = items.groupBy("genre").agg(F.count("*").alias("n"), F.sum("score").alias("total"))
    special = items.groupBy("line").agg(
        F.when(F.col("line") == 1, float("inf"))
        .when(F.col("line") == 2, float("-inf"))
        .when(F.col("line") == 3, float("nan"))
        .otherwise(F.max(score))
        .alias("value")
    )
    reports.write_result(folder, "genres", "rows and scores", {"genres": by_genre, "lines": special})
    path = reports.write_metrics(items.agg(F.count("*").alias("n")), f"{folder}/run", "degree")
    genres = reports.read_result(spark, folder, "genres", "genres", "genre string, n long, total long")
    lines = reports.read_result(spark, folder, "genres", "lines", "line int, value double")
    about = reports.read_result(spark, folder, "genres", "about", "analysis_name string")
    rows = spark.read.schema("n long").json(path)
    number = F.col("total").cast("double").alias("value")
    null, none = F.lit(None).cast("double").alias("value"), F.lit(None).cast("long").alias("n")
    return (
        genres.select(F.col("genre").alias("name"), "n", number)
        .union(lines.select(F.col("line").cast("string").alias("name"), none, "value"))
        .union(about.select(F.col("analysis_name").alias("name"), none, null))
        .union(rows.select(F.lit("metrics").alias("name"), "n", null))
    )


def _change_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The change log as a stream that arrives in parts: the graph it ends in, and conflicts.

    Every part is a file folder of its own, read by a query that goes on from the
    checkpoint of the one before. Conflicts of the colouring would be rows too.
    """
    nodes, edges, log = _graph_and_log(spark, sf)
    folder = Scratch(spark, "change_stream").path
    first = graph.color_graph(nodes, edges, stored=True)
    versions = graph_versions(spark, f"{folder}/state")
    versions.put_whole(0, first.colors, edges)
    half = log.approxQuantile("seq", [0.5], 0.01)[0]
    for part in (log.where(F.col("seq") <= half), log.where(F.col("seq") > half)):
        part.write.mode("append").json(f"{folder}/log")
        stream_changes(
            spark, f"{folder}/log", f"{folder}/state", first.best_k,
            checkpoint_dir=f"{folder}/checkpoint", allow_new_colors=True,
        ).awaitTermination()
    return _structure(*versions.read(2))


def _stepwise(spark: SparkSession, sf: str) -> DataFrame:
    """The change log change by change over a sparse graph: what it ends in, and conflicts."""
    scratch = Scratch(spark, "stepwise_query")
    nodes = fx.part_nodes(spark, sf)
    edges = scratch.write(fx.large_line_edges(spark, sf), "edges")
    log = scratch.write(fx.local_changes(spark, sf), "changes")
    first = graph.color_graph(nodes, edges, stored=True)
    done = graph.recolor_stepwise(first.colors, edges, log, first.best_k, allow_new_colors=True)
    return _structure(*done[:2])


def _structure(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes and half-edges as rows; conflicts of the colouring would be rows too."""
    null = F.lit(None).cast("bigint").alias("b")
    wrong = graph.conflict_sample(nodes, edges).select(F.lit("conflict"), "u", "v")
    return (
        edges.select(F.lit("edge").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"))
        .unionByName(nodes.select(F.lit("node").alias("kind"), F.col("id").alias("a"), null))
        .union(wrong)
    )


def _demo_changes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    log = graph.demo_changes(nodes, edges)
    return log.withColumn("neighbors", F.array_join("neighbors", ","))


def _generate(spark: SparkSession, sf: str) -> DataFrame:
    n = fx.table(spark, sf, "part").select("p_partkey").distinct().count()
    return graph.generate_graph(spark, n, GENERATED_DEGREE, seed=123)[1]


def queries() -> dict[str, Query]:
    """The queries by key."""
    return {
        # cleaning
        "quality_probe": on_raw(lambda d: quality.probe(d, ["album", "genre"], RANGES)),
        "clean_nulls": on_raw(lambda d: quality.drop_null(d, REQUIRED)),
        "clean_ranges": on_raw(lambda d: quality.filter_ranges(d, RANGES)),
        "clean_report": on_raw(lambda d: quality.clean_report(d, REQUIRED, RANGES)),
        # profiles
        "profile_counts": on_raw(
            lambda d: profile.profile_counts(d, ["album", "line", "genre", *FEATURES])
        ),
        "profile_counts_sketch": on_raw(
            lambda d: profile.distinct_count_errors(d, ["album", "line", "genre", *FEATURES])
        ),
        "profile_numeric": on_items(_numeric),
        "profile_numeric_spread": on_items(_spread),
        "profile_percentile_rank": on_items(
            lambda d: profile.percentile_ranks(d, ["score", "duration", "album"])
        ),
        "profile_top_values": on_items(profile.profile_top_values),
        "profile_boolean": on_items(lambda d: rounded(profile.profile_boolean(d))),
        # buckets
        "bucket_bounds": on_items(
            lambda d: d.select(*ITEM_KEY, "tempo", by_bounds("tempo").alias("bucket"))
        ),
        "bucket_deciles": on_items(
            lambda d: d.select(*ITEM_KEY, "score", equal_width("score").alias("bucket"))
        ),
        # top k
        "topk_global": on_items(
            lambda d: topk.top_k(
                d.select(*ITEM_KEY, "score", "duration"),
                [F.desc("duration")],
                10,
                [*ITEM_KEY, "score"],
            )
        ),
        "topk_vs_group": on_items(lambda d: rounded(topk.top_vs_group(d, **LONGEST))),
        "topk_vs_all": on_items(lambda d: rounded(topk.top_vs_all(d, **LONGEST))),
        # flags and cohorts
        "flag_impact": on_items(lambda d: rounded(_impact(d))),
        "flag_impact_counts": on_items(lambda d: cohort.flag_impact_counts(_impact(d))),
        "flag_impact_top": on_items(
            lambda d: rounded(cohort.flag_impact_top(_impact(d), by="genre"))
        ),
        "flag_by_bucket": on_items(lambda d: rounded(_flag_buckets(d))),
        "flag_dominant_pattern": on_items(lambda d: cohort.dominant_pattern(_flag_buckets(d))),
        "mode_per_group": on_items(lambda d: cohort.mode_per_group(d, by="album", value="kind")),
        "cohort_groups": on_items(lambda d: rounded(_cohorts(d))),
        "cohort_summary": on_items(lambda d: rounded(cohort.two_cohorts_summary(_cohorts(d)))),
        # members
        "collab_top_groups": on_credits(lambda d: collab.top_groups(d, **CREDIT)),
        "collab_solo_avg": on_credits(lambda d: collab.solo_avg(d, **CREDIT)),
        "collab_boost": on_credits(lambda d: collab.boost(d, **CREDIT)),
        "collab_summary": on_credits(lambda d: collab.summary(d, **CREDIT)),
        # standouts
        "breakthrough_items": on_items(
            lambda d: rounded(
                outlier.items_vs_group(d, by="album", score="score", keep=["part", "line"])
            )
        ),
        "breakthrough_gap": on_items(
            lambda d: rounded(outlier.feature_gap(d, by="album", score="score", features=FEATURES))
        ),
        # sweet spots
        "sweetspot_buckets": on_items(lambda d: rounded(sweetspot.bucket_stats(d, **SWEET))),
        "sweetspot_best": on_items(lambda d: rounded(sweetspot.best_bucket(d, **SWEET))),
        "sweetspot_summary": on_items(
            lambda d: rounded(sweetspot.summary(sweetspot.best_bucket(d, **SWEET)))
        ),
        # consistency
        "entity_consistency": on_items(lambda d: rounded(consistency.rank_entities(d, **STEADY))),
        "entity_diversity": on_items(
            lambda d: rounded(consistency.diversity(d, category="kind", **STEADY))
        ),
        "entity_diversity_summary": on_items(
            lambda d: rounded(
                consistency.diversity_summary(consistency.diversity(d, category="kind", **STEADY))
            )
        ),
        # graphs
        "graph_cooccur_edges": on_graph(lambda n, e: _undirected(e)),
        "graph_half_edges": on_graph(lambda n, e: e),
        "graph_degrees": on_graph(graph.degrees),
        "graph_degree_stats": on_graph(lambda n, e: rounded(graph.degree_stats(n, e))),
        "graph_color": on_graph(lambda n, e: _colored(n, e).colors),
        "graph_color_hash": on_graph(lambda n, e: _colored(n, e, priority="hash").colors),
        "graph_color_count": on_graph(_color_count),
        "graph_color_histogram": on_graph(
            lambda n, e: graph.color_histogram(_colored(n, e).colors)
        ),
        "graph_color_rounds": on_graph(
            lambda n, e: graph.coloring_rounds(_colored(n, e))
        ),
        "graph_validate": lambda spark, sf: graph.validate(
            fx.striped_colors(spark, sf), fx.part_edges(spark, sf)
        ),
        "graph_conflict_sample": lambda spark, sf: graph.conflict_sample(
            fx.striped_colors(spark, sf), fx.part_edges(spark, sf)
        ),
        "graph_apply_changes": _apply_changes,
        "graph_affected": _affected,
        "graph_recolor": _recolor,
        "graph_recolor_fixed_k": _recolor_fixed_k,
        "graph_recolor_stepwise": _stepwise,
        "csv_read": _csv_read,
        "report_round_trip": _report,
        "graph_json_round_trip": _graph_json,
        "change_log_round_trip": _change_log,
        "change_log_array": _change_log_array,
        "coloring_round_trip": _coloring_json,
        "change_stream": _change_stream,
        "graph_demo_changes": on_graph(_demo_changes),
        "graph_generate": _generate,
    }
