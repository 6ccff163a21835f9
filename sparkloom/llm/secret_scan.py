"""Secrets in texts: fixed patterns, and character Markov models for the rest.

Two first-order models, one of random strings and one of ordinary identifiers,
give a log-likelihood ratio for every long run of token characters. Models are
counts over labelled samples; all of it is SQL functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .hashing import unit

# The patterns of the base kinds and the least length of group or match.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{32,}"
KINDS = {"assign": (ASSIGN, 2, 8), "access": (ACCESS, 0, 16), "hex": (HEX, 0, 32)}

RUN = "[A-Za-z0-9+/_-]{20,}={0,2}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
UNIT = 1000  # scores are whole thousandths
LEAST_PER_SIGN = 400  # a run's mean score from which it counts as random
LEAST_TOTAL = 12_000
SMOOTHING = 20  # pairs that a character's row is taken to have from the model's whole
DRAWN = 3000  # random strings drawn for the sample
SAMPLED = 2000  # documents, as an expected number, that ordinary identifiers are taken from
MASK = "[SECRET]"
FAR = 2**31 - 1  # beyond every place in a text
PIECE_BITS = 10
PIECE = f"(?s).{{1,{1 << PIECE_BITS}}}"  # a text is cut into pieces of this many code points


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _before(values: Column, combine: Callable[[Column, Column], Column], zero: int) -> Column:
    """For each whole number of an array, all before it combined, from ``zero``.

    Arrays grow by copies, so the numbers are taken in pieces of about the square
    root of their count: first inside each piece, then over the pieces.
    """
    none = F.array().cast("array<int>")

    def over(part: Column) -> Column:
        start = F.struct(F.lit(zero).alias("at"), none.alias("before"))
        return F.aggregate(
            part, start,
            lambda state, x: F.struct(
                combine(state["at"], x).alias("at"),
                F.concat(state["before"], F.array(state["at"])).alias("before"),
            ),
        )

    def pieces(whole: Column) -> Column:
        side = F.ceil(F.sqrt(F.size(whole))).cast("int")
        last = F.ceil(F.size(whole) / side).cast("int") - 1
        return F.transform(
            F.sequence(F.lit(0), last), lambda i: over(F.slice(whole, i * side + 1, side))
        )

    def joined(parts: Column) -> Column:
        ahead = over(F.transform(parts, lambda part: part["at"]))["before"]
        return F.flatten(
            F.zip_with(
                parts, ahead,
                lambda part, at: F.transform(part["before"], lambda x: combine(at, x)),
            )
        )

    return _let(
        values, lambda whole: F.when(F.size(whole) > 0, _let(pieces(whole), joined)).otherwise(none)
    )


def matches(text: Column, pattern: str, group: int, least: int) -> Column:
    """Start, end (in code points) and text of the leftmost matches whose group is long enough.

    What lies between matches and the matches themselves give the places.
    """
    quoted = F.lit(pattern)
    rows = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, quoted, F.lit(0)).alias("found"),
        F.regexp_extract_all(text, quoted, F.lit(group)).alias("checked"),
    )

    def placed(rows: Column) -> Column:
        lengths = F.transform(rows, lambda r: F.length(r["gap"]) + F.length(r["found"]))

        def span(row: Column, at: Column) -> Column:
            start = at + F.length(row["gap"])
            end = start + F.length(row["found"])
            long_enough = F.length(row["checked"]) >= least
            return F.struct(
                start.alias("start"), end.alias("end"), row["found"].alias("text"), long_enough.alias("kept")
            )

        every = F.zip_with(rows, _before(lengths, lambda a, b: a + b, 0), span)
        return F.transform(
            F.filter(every, lambda s: s["kept"]),
            lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text")),
        )

    # One gap follows the last match.
    return _let(F.filter(rows, lambda r: r["found"].isNotNull()), placed)


def spans(text: Column, pattern: str, group: int, least: int) -> Column:
    """Start and end, in code points, of the matches."""
    return F.transform(
        matches(text, pattern, group, least),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")),
    )


def _apart(runs: Column, others: Column) -> Column:
    """The runs that overlap none of the others.

    Of all spans in order of their starts, a run must begin at or after the last
    end of the others before it and end at or before the first start after it.
    """

    def row(other: bool) -> Callable[[Column], Column]:
        text = F.lit("") if other else None
        return lambda s: F.struct(
            s["start"].alias("start"), F.lit(0 if other else 1).alias("run"),
            s["end"].alias("end"), (s["text"] if text is None else text).alias("text"),
        )

    every = F.array_sort(F.concat(F.transform(others, row(True)), F.transform(runs, row(False))))

    def settled(rows: Column) -> Column:
        ends = F.transform(rows, lambda r: F.when(r["run"] == 0, r["end"]).otherwise(0))
        starts = F.transform(rows, lambda r: F.when(r["run"] == 0, r["start"]).otherwise(FAR))
        ended = _before(ends, F.greatest, 0)
        begun = F.reverse(_before(F.reverse(starts), F.least, FAR))
        around = F.arrays_zip(rows.alias("row"), ended.alias("ended"), begun.alias("begun"))
        free = F.filter(
            around,
            lambda a: (a["row"]["run"] == 1)
            & (a["ended"] <= a["row"]["start"])
            & (a["begun"] >= a["row"]["end"]),
        )
        return F.transform(free, lambda a: a["row"])

    return _let(every, settled)


def _none() -> Column:
    return F.array().cast("array<struct<start:int,end:int>>")


def _base(text: Column) -> dict[str, Column]:
    """Spans per kind; a cheap test spares texts without a match the rest."""
    seen = {
        "assign": F.rlike(text, F.lit(ASSIGN)),
        "access": F.contains(text, F.lit("AKIA")),
        "hex": F.rlike(text, F.lit(HEX)),
    }
    return {
        kind: F.when(seen[kind], spans(text, *KINDS[kind])).otherwise(_none()) for kind in KINDS
    }


def drawn_samples(spark: SparkSession, count: int = DRAWN) -> DataFrame:
    """``token, secret``: hexadecimal and base64 strings from hashes of numbers, as secrets."""
    digest = F.sha2(F.concat(F.lit("sample"), F.col("id").cast("string")), 256)
    coded = F.regexp_replace(F.base64(F.unhex(digest)), "[\\r\\n]", "")
    token = F.when(F.col("id") % 2 == 0, F.substring(digest, 1, 40)).otherwise(coded)
    return spark.range(count).select(token.alias("token"), F.lit(True).alias("secret"))


def labelled_samples(docs: DataFrame, id_col: str, text_col: str, documents: int = SAMPLED) -> DataFrame:
    """``token, secret`` from the corpus: values of base matches, and ordinary identifiers.

    About ``documents`` documents of either kind are used, chosen by hash of the id.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    hit = F.rlike(text, F.lit(f"{ASSIGN}|AKIA[A-Z0-9]{{12}}|{HEX}"))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("hit", hit)
    counts = {r["hit"]: r["count"] for r in rows.groupBy("hit").count().collect()}
    share = {k: documents / counts[k] if counts.get(k) else 1.0 for k in (True, False)}
    u = unit(F.col("id"), 10)
    values = F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2))
    values = F.filter(values, lambda v: F.length(v) >= 8)
    # Runs long enough to be scanned may be secrets themselves, so they teach nothing here.
    words = F.regexp_extract_all("text", F.lit("[A-Za-z0-9+/_-]{4,}"), F.lit(0))
    words = F.filter(words, lambda w: F.length(w) < 20)
    secret = rows.where(F.col("hit") & (u < share[True])).select(F.explode(values).alias("token"))
    plain = rows.where(~F.col("hit") & (u < share[False])).select(F.explode(words).alias("token"))
    return secret.withColumn("secret", F.lit(True)).union(
        plain.withColumn("secret", F.lit(False))
    )


def _indexes(token: Column) -> Column:
    """Number of each character in the alphabet, from 0; other characters are left out."""
    signs = F.regexp_extract_all(token, F.lit(f"[{ALPHABET.replace('-', chr(92) + '-')}]"), F.lit(0))
    return F.transform(signs, lambda c: F.instr(F.lit(ALPHABET), c) - 1)


def train(samples: DataFrame) -> list[int]:
    """Log-likelihood ratio, in thousandths, of each pair of neighbouring characters.

    ``samples`` has a string ``token`` and a boolean ``secret``; null tokens and
    labels teach nothing. Rows are smoothed, so unseen pairs have a finite ratio,
    and without samples all ratios are 0. The counts are one
    row per pair, whatever the input.
    """
    size = len(ALPHABET)
    numbers = samples.where("token IS NOT NULL AND secret IS NOT NULL").select(
        "secret", _indexes(F.col("token")).alias("at")
    )
    pairs = numbers.where("size(at) > 1").select(
        "secret",
        F.explode(
            F.zip_with(
                F.expr("slice(at, 1, size(at) - 1)"), F.expr("slice(at, 2, size(at) - 1)"),
                lambda a, b: F.struct(a.alias("a"), b.alias("b")),
            )
        ).alias("pair"),
    )
    seen = pairs.groupBy("pair.a", "pair.b").agg(
        F.count_if("secret").alias("random"), F.count_if(~F.col("secret")).alias("plain")
    )
    counts = {(r["a"], r["b"]): (r["random"], r["plain"]) for r in seen.collect()}
    return _ratios(counts, size)


def _ratios(counts: dict[tuple[int, int], tuple[int, int]], size: int) -> list[int]:
    """Log ratios, with each model's pairs smoothed by how often it has the second character."""
    from math import log

    models = []
    for i in (0, 1):
        after = [1 + sum(counts.get((a, b), (0, 0))[i] for a in range(size)) for b in range(size)]
        share = [x / sum(after) for x in after]
        rows = []
        for a in range(size):
            row = [counts.get((a, b), (0, 0))[i] for b in range(size)]
            total = sum(row) + SMOOTHING
            rows += [log((n + SMOOTHING * p) / total) for n, p in zip(row, share, strict=True)]
        models.append(rows)
    return [round(UNIT * (x - y)) for x, y in zip(*models, strict=True)]


def run_scores(token: Column, ratios: list[int]) -> Column:
    """Sum of the ratios of a token's neighbouring characters."""
    size = len(ALPHABET)
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<int>")
    start = F.struct(F.lit(-1).alias("last"), F.lit(0).cast("long").alias("sum"))

    def step(state: Column, at: Column) -> Column:
        ratio = F.when(state["last"] >= 0, F.get(table, state["last"] * size + at)).otherwise(0)
        return F.struct(at.alias("last"), (state["sum"] + ratio).alias("sum"))

    return F.aggregate(_indexes(token), start, step, lambda state: state["sum"])


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: DataFrame | None = None
) -> DataFrame:
    """All rows and columns of ``docs`` with the secrets of the whole text.

    Adds ``assign``, ``access``, ``hex`` and ``markov``: arrays of ``start, end``
    in code points, end exclusive, in order of place. The first three are the
    leftmost matches of their patterns; ``markov`` holds other runs of token
    characters that the models, trained from ``samples`` (drawn random strings
    and the corpus, if None), call random: a high enough ratio in all and per
    character. It leaves out what overlaps the others.

    Null texts are empty and have no spans; rows are kept as they are, repeated
    ones and null ids included; an empty table gives no rows. Columns of the
    input with the names of the added ones are replaced.
    """
    if samples is None:
        samples = drawn_samples(docs.sparkSession).union(labelled_samples(docs, id_col, text_col))
    ratios = train(samples)
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.withColumns(_base(text))

    def random(run: Column) -> Column:
        pairs = run["end"] - run["start"] - 1
        return _let(
            run_scores(run["text"], ratios),
            lambda score: (score >= LEAST_TOTAL) & (score >= LEAST_PER_SIGN * pairs),
        )

    runs = _apart(matches(text, RUN, 0, 20), F.concat("assign", "access", "hex"))
    found = F.transform(
        F.filter(runs, random), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))
    )
    return out.withColumn("markov", F.when(F.rlike(text, F.lit(RUN)), found).otherwise(_none()))


def _joined(kinds: list[str]) -> Column:
    """kind:start:end of all spans, by start and then by kind as listed."""
    def named(number: int, kind: str) -> Column:
        def row(span: Column) -> Column:
            text = F.concat_ws(":", F.lit(kind), span["start"], span["end"])
            return F.struct(span["start"].alias("start"), F.lit(number).alias("number"), text.alias("text"))

        return F.transform(kind, row)

    rows = [named(number, kind) for number, kind in enumerate(kinds)]
    return F.array_join(F.transform(F.array_sort(F.concat(*rows)), lambda r: r["text"]), ",")


def digests(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the hash of the base spans and all spans as text, per row of :func:`scan`."""
    counts = [F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return scanned.select(
        id_col, *counts,
        F.sha2(_joined(list(KINDS)), 256).alias("base_sha256"),
        _joined([*KINDS, "markov"]).alias("spans"),
    )


def masked(scanned: DataFrame, text_col: str = "text") -> Column:
    """The text of a row of :func:`scan` with every stretch of secrets replaced; null stays null.

    The text is cut into pieces of fixed length first, so that each gap between
    secrets is found without reading all that comes before it.
    """
    text = F.col(text_col)
    every = F.array_sort(F.concat("assign", "access", "hex", "markov"))

    def cut(pieces: Column, start: Column, end: Column) -> Column:
        first = F.shiftright(start, PIECE_BITS)
        count = F.shiftright(end - 1, PIECE_BITS) - first + 1
        around = F.concat_ws("", F.slice(pieces, first + 1, F.greatest(count, F.lit(0))))
        return F.when(
            end > start,
            F.substring(around, start - F.shiftleft(first, PIECE_BITS) + 1, end - start),
        ).otherwise("")

    def hidden(rows: Column) -> Column:
        covered = _before(F.transform(rows, lambda r: r["end"]), F.greatest, 0)
        around = F.zip_with(
            rows, covered,
            lambda r, at: F.struct(at.alias("at"), r["start"].alias("start"), r["end"].alias("end")),
        )
        opened = F.filter(around, lambda r: (r["start"] >= r["at"]) & (r["end"] > r["at"]))

        def rebuilt(pieces: Column) -> Column:
            parts = F.transform(
                opened, lambda r: F.concat(cut(pieces, r["at"], r["start"]), F.lit(MASK))
            )
            last = F.array_max(F.transform(rows, lambda r: r["end"]))
            return F.concat(F.array_join(parts, ""), cut(pieces, last, F.length(text)))

        return _let(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), rebuilt)

    return F.when(F.size(every) == 0, text).otherwise(_let(every, hidden))
