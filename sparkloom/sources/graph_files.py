"""Graphs, change logs and colourings as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.graph.changes import check_changes
from ..operators.graph.slots import SLOT_EDGES, hub_slots, slot_of_edges
from ..operators.graph.validate import UNCOLORED

NODE_SCHEMA = "id bigint, neighbors array<bigint>, color int"
CHANGE_SCHEMA = "type string, nodeIdA bigint, nodeIdB bigint, neighbors array<bigint>"


# What comes before a record of an array, and what closes one.
BEFORE = r"^\s*[\[,]\s*\{"
CLOSING = r"^\s*(\[\s*)?\]\s*$"


def _has_lines(spark: SparkSession, path: str, records: str) -> bool:
    """Whether every line that is not blank looks like a value in one of the brackets."""
    ends = {"{": "}", "[": "]"}
    whole = F.lit(False)
    for begin in records:
        whole |= F.col("value").startswith(begin) & F.col("value").endswith(ends[begin])
    return _lines(spark, path).filter(~whole).isEmpty()


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("value")).filter("value <> ''")


def _array_pieces(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, at, value``: the files cut behind every closing brace, in parallel.

    Spark splits a file at its records whatever ends them; ``block`` is where a
    task's part begins in the file, and ``at`` numbers the pieces of a part.
    """
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )


def _array_blocks(pieces: DataFrame) -> DataFrame | None:
    """Per part of a file: its first number and the records before it; None if not flat arrays.

    Flat are arrays of records without braces inside. The driver sees one row
    for all files.
    """
    value = F.col("value")
    record = value.rlike(BEFORE)
    one_brace = F.length(value) - F.length(F.replace(value, F.lit("{"), F.lit(""))) == 1
    closing = value.rlike(CLOSING)
    blocks = pieces.groupBy("file", "block").agg(
        F.min("at").alias("first"),
        F.count_if(record).alias("records"),
        F.count_if(value.rlike(r"^\s*\[")).alias("opened"),
        F.count_if(closing).alias("closed"),
        F.count_if(~((record & one_brace) | closing)).alias("others"),
    )
    files = blocks.groupBy("file").agg(
        F.sum("opened").alias("opened"), F.sum("closed").alias("closed"), F.sum("others").alias("others")
    )
    if not files.where("opened <> 1 OR closed <> 1 OR others > 0").isEmpty():
        return None
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(
        "file", "block", "first", F.coalesce(F.sum("records").over(before), F.lit(0)).alias("before")
    )


def _records(
    spark: SparkSession, path: str, json_lines: bool | None, records: str, schema: str
) -> tuple[DataFrame, bool]:
    """The records of the files, ``seq, r`` for arrays and ``r`` for lines, and whether they are arrays.

    Arrays of records without braces inside are cut at their records and read in
    parallel, however large a file is; ``seq`` is the place in the file's array.
    Other arrays are read as one text per file.
    """
    if json_lines is None:
        json_lines = _has_lines(spark, path, records)
    if json_lines:
        return _lines(spark, path).select(F.explode(_parsed(F.col("value"), schema)).alias("r")), False
    pieces = _array_pieces(spark, path)
    blocks = _array_blocks(pieces)
    if blocks is None:
        texts = spark.read.text(path, wholetext=True)
        return texts.select(F.posexplode(_parsed(F.col("value"), schema)).alias("seq", "r")), True
    record = F.col("value").rlike(BEFORE)
    found = pieces.where(record).join(blocks, ["file", "block"])
    text = F.concat(F.regexp_replace("value", r"^\s*[\[,]\s*", ""), F.lit("}"))
    seq = F.col("before") + F.col("at") - F.col("first")
    # The condition again, as Spark may parse what a later filter needs before it filters here.
    return found.select(seq.alias("seq"), F.when(record, _parsed(text, schema)[0]).alias("r")), True


def _parsed(text: Column, schema: str) -> Column:
    """Array of the records in a text that holds one record or one array of them, and no more."""
    # Wrapped, so that anything after the first value is malformed.
    wrapped = F.concat(F.lit('{"r":'), text, F.lit("}"))
    options = {"mode": "FAILFAST"}
    one = F.from_json(wrapped, f"struct<r: struct<{_ddl_fields(schema)}>>", options)["r"]
    many = F.from_json(wrapped, f"struct<r: array<struct<{_ddl_fields(schema)}>>>", options)["r"]
    return F.when(F.trim(text).startswith("{"), F.array(one)).otherwise(
        F.coalesce(many, F.raise_error(F.lit("the text is not a JSON record or array")))
    )


def read_graph(
    spark: SparkSession, path: str, *, json_lines: bool | None = None
) -> tuple[DataFrame, DataFrame]:
    """Nodes and half-edges from records ``{id, neighbors, color}``.

    Files hold one JSON array each, or one record per line; Spark reads either in
    parallel. Unless ``json_lines`` says which, the lines do. Every record is
    read, or reading fails. Self-loops and repeated neighbours are dropped; a
    node may come in several records. Raises ``ValueError`` when there is no node
    or the first records are malformed; later ones fail when they are read.
    """
    try:
        records, _ = _records(spark, path, json_lines, "{[", NODE_SCHEMA)
        records = records.select("r.*").filter(F.col("id").isNotNull())
        empty = records.isEmpty()
    except Exception as error:
        raise ValueError(f"cannot read a graph from {path}") from error
    if empty:
        raise ValueError(f"no nodes in {path}")
    color = F.max(F.coalesce("color", F.lit(UNCOLORED))).cast("int")
    nodes = records.groupBy("id").agg(color.alias("color"))
    edges = (
        records.select(F.col("id").alias("src"), F.explode("neighbors").alias("dst"))
        .filter(F.col("src") != F.col("dst"))
        .distinct()
    )
    return nodes, edges


def read_changes(
    spark: SparkSession, path: str, *, json_lines: bool | None = None
) -> DataFrame:
    """A change log ``(seq, type, a, b, neighbors)``.

    One file holds a JSON array, whose order becomes ``seq``; or files hold a
    record per line that carries its own ``seq``. Unless ``json_lines`` says
    which, the lines do. Every change is read, or reading fails, by the rules of
    :func:`sparkloom.operators.graph.check_changes`; so it does for an array in
    several files, whose order is unknown.
    """
    parsed, array = _records(spark, path, json_lines, "{", "seq bigint, " + CHANGE_SCHEMA)
    if array:
        files = spark.read.text(path).select("_metadata.file_path").distinct()
        if files.limit(2).count() > 1:
            raise ValueError(f"the order of the changes in {path} is unknown: several arrays")
    own = [F.col(f"r.{name}") for name in ("type", "nodeIdA", "nodeIdB", "neighbors")]
    parsed = parsed.select(F.col("seq" if array else "r.seq"), *own)
    return check_changes(
        parsed.select(
            F.col("seq").cast("bigint").alias("seq"), "type", F.col("nodeIdA").alias("a"),
            F.col("nodeIdB").alias("b"), "neighbors",
        )
    )


def _ddl_fields(columns: str) -> str:
    return ", ".join(part.strip().replace(" ", ": ", 1) for part in columns.split(", "))


def write_graph(
    nodes: DataFrame, edges: DataFrame, path: str, *, slot_edges: int = SLOT_EDGES
) -> None:
    """Write records ``{id, neighbors, color}``, one JSON record per line.

    A node with very many neighbours is written as several records, each with a
    part of the list, so no task has to hold all of it; :func:`read_graph`
    puts them together again.
    """
    degree = edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("degree"))
    largest = degree.agg(F.max("degree")).first()[0]
    placed = edges.select("src", "dst", F.lit(0).alias("slot"))
    if (largest or 0) > slot_edges:
        placed = slot_of_edges(edges, hub_slots(degree, slot_edges))
    lists = (
        placed.groupBy(F.col("src").alias("id"), "slot")
        .agg(F.sort_array(F.collect_set("dst")).alias("neighbors"))
        .drop("slot")
    )
    empty = F.array().cast("array<bigint>")
    nodes.join(lists, "id", "left").select(
        "id",
        F.coalesce("neighbors", empty).alias("neighbors"),
        F.coalesce("color", F.lit(UNCOLORED)).alias("color"),
    ).write.mode("overwrite").json(path)


def write_coloring(colors: DataFrame, best_k: int, path: str) -> None:
    """Write ``assignments`` (``nodeId``, ``color``) and a one-row ``summary`` under ``path``."""
    colors.select(F.col("id").alias("nodeId"), "color").write.mode("overwrite").json(
        f"{path}/assignments"
    )
    colors.agg(
        F.lit(best_k).alias("chromaticNumber"), F.count(F.lit(1)).alias("nodeCount")
    ).write.mode("overwrite").json(f"{path}/summary")
