"""The checked queries as SQL for DuckDB, over views named like the tables."""

from __future__ import annotations

from .fixtures import LARGE, NEW_NODES

ITEMS = """
items AS (
  SELECT l_orderkey AS album, l_partkey AS part, l_linenumber AS line,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O'
              THEN CAST(l_orderkey AS VARCHAR) || ';' || CAST(l_suppkey AS VARCHAR)
              ELSE CAST(l_orderkey AS VARCHAR) END AS artists,
         p_brand AS genre, p_type AS kind,
         CAST(l_quantity * 2 AS INT) AS score,
         l_discount * CAST(10 AS DOUBLE) AS feature_a,
         l_tax * CAST(12.5 AS DOUBLE) AS feature_b,
         l_returnflag = 'R' AS flag,
         CAST(60 + 2 * p_size AS DOUBLE) AS tempo,
         l_extendedprice AS duration
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

RAW = (
    ITEMS
    + """,
raw AS (
  SELECT album, part, line,
         CASE WHEN line = 4 AND flag THEN NULL ELSE genre END AS genre,
         CASE WHEN line = 6 THEN feature_a + CAST(1 AS DOUBLE)
              WHEN line = 7 THEN NULL ELSE feature_a END AS feature_a,
         CASE WHEN line = 5 THEN feature_b - CAST(0.5 AS DOUBLE) ELSE feature_b END AS feature_b
  FROM items
)"""
)

CREDITS = """
credits AS (
  SELECT CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O'
              THEN s_name || ' ; ' || p_brand || ';' || p_type
              WHEN l_returnflag = 'R' THEN s_name || ';' || p_brand
              WHEN l_returnflag = 'A' THEN s_name ELSE p_brand END AS members,
         CAST(l_quantity * 2 AS INT) AS score
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
),
top_groups AS (
  SELECT members, count(*) AS group_count, avg(score) AS avg_score
  FROM credits WHERE members LIKE '%;%'
  GROUP BY members ORDER BY group_count DESC, members LIMIT 10
),
solo AS (
  SELECT members AS member, avg(score) AS solo_avg
  FROM credits WHERE members NOT LIKE '%;%' GROUP BY members
),
boosts AS (
  SELECT t.members, group_count, avg_score, member AS weakest_member, solo_avg AS weakest_avg,
         avg_score - solo_avg AS boost
  FROM top_groups t LEFT JOIN (
    SELECT members, member, solo_avg,
           row_number() OVER (PARTITION BY members ORDER BY solo_avg, pos) AS rn
    FROM (SELECT members, trim(unnest(string_split(members, ';'))) AS member,
                 generate_subscripts(string_split(members, ';'), 1) AS pos FROM top_groups) m
    JOIN solo USING (member)
  ) w ON w.members = t.members AND w.rn = 1
)"""

BUCKET_CASE = """CASE WHEN tempo < CAST(100 AS DOUBLE) THEN 'Slow (<100 BPM)'
              WHEN tempo <= CAST(120 AS DOUBLE) THEN 'Medium (100-120 BPM)'
              WHEN tempo <= CAST(140 AS DOUBLE) THEN 'Fast (121-140 BPM)'
              ELSE 'Very Fast (>140 BPM)' END"""

DECILE_CASE = (
    "CASE "
    + " ".join(
        f"WHEN score < {10 * (i + 1)} THEN '{i / 10:.1f}-{(i + 1) / 10:.1f}'" for i in range(9)
    )
    + " ELSE '0.9-1.0' END"
)

IMPACT = (
    ITEMS
    + """,
impact AS (
  SELECT *, CASE WHEN difference > 2 THEN 'Positive' WHEN difference < -2 THEN 'Negative'
                 ELSE 'Neutral' END AS impact
  FROM (SELECT x.genre, flag_avg, other_avg, flag_avg - other_avg AS difference
        FROM (SELECT genre, avg(score) AS flag_avg FROM items WHERE flag GROUP BY genre) x
        JOIN (SELECT genre, avg(score) AS other_avg FROM items WHERE NOT flag GROUP BY genre) y
          ON x.genre = y.genre)
)"""
)

FLAG_BUCKETS = (
    ITEMS
    + f""",
buckets AS (
  SELECT *, flag_avg - other_avg AS difference,
         CASE WHEN flag_avg > other_avg THEN 'Explicit_More_Positive'
              WHEN flag_avg < other_avg THEN 'NonExplicit_More_Positive'
              ELSE 'Neutral' END AS pattern
  FROM (SELECT {DECILE_CASE} AS bucket,
               avg(feature_a) FILTER (WHERE flag) AS flag_avg,
               avg(feature_a) FILTER (WHERE NOT flag) AS other_avg,
               count(*) FILTER (WHERE flag) AS flag_count,
               count(*) FILTER (WHERE NOT flag) AS other_count
        FROM items GROUP BY 1)
)"""
)

WEAK = (
    ITEMS
    + """,
weak AS (
  SELECT album, avg(score) AS group_avg_score FROM items GROUP BY album HAVING avg(score) < 50
)"""
)

SWEET = (
    ITEMS
    + f""",
top_genres AS (
  SELECT genre, avg(score) AS group_avg_score FROM items
  GROUP BY genre ORDER BY group_avg_score DESC, genre LIMIT 5
),
stats AS (
  SELECT genre, group_avg_score, {BUCKET_CASE} AS bucket,
         avg(score) AS avg_score, avg(tempo) AS avg_x, count(*) AS row_count
  FROM items JOIN top_genres USING (genre) GROUP BY 1, 2, 3
),
best AS (
  SELECT DISTINCT genre, group_avg_score,
         first_value(bucket) OVER w AS best_bucket, max(avg_score) OVER g AS best_avg_score,
         CASE WHEN count(*) OVER g > 1
              THEN max(avg_score) OVER g - min(avg_score) OVER g END AS advantage
  FROM stats
  WINDOW w AS (PARTITION BY genre ORDER BY avg_score DESC, bucket), g AS (PARTITION BY genre)
)"""
)

LONGEST = (
    ITEMS
    + """,
longest AS (
  SELECT * FROM items WHERE feature_a > CAST(0.8 AS DOUBLE)
  ORDER BY duration DESC, album, part, line, genre, feature_a, score LIMIT 10
)"""
)

STEADY = (
    ITEMS
    + """,
solo AS (SELECT * FROM items WHERE artists NOT LIKE '%;%'),
steady AS (
  SELECT artists, stddev_samp(score) AS score_stddev, avg(score) AS avg_score,
         count(*) AS row_count
  FROM solo GROUP BY artists
  HAVING count(*) >= 5 AND avg(score) > 1 AND stddev_samp(score) > 0
  ORDER BY round(stddev_samp(score), 9), artists LIMIT 20
),
kinds AS (
  SELECT artists, kind, count(*) AS n FROM solo GROUP BY artists, kind
),
diversity AS (
  SELECT s.*, c.category_count, m.kind AS primary_category,
         m.n * 100.0 / row_count AS primary_percentage,
         CASE WHEN category_count <= 2 THEN 'Highly_Specialized'
              WHEN category_count <= 5 THEN 'Moderately_Diverse'
              ELSE 'Highly_Diverse' END AS diversity
  FROM steady s
  JOIN (SELECT artists, count(*) AS category_count FROM kinds GROUP BY artists) c
    ON c.artists = s.artists
  JOIN (SELECT *, row_number() OVER (PARTITION BY artists ORDER BY n DESC, kind) AS rn
        FROM kinds) m ON m.artists = s.artists AND m.rn = 1
)"""
)

COHORTS = (
    ITEMS
    + """,
cohorts AS (
  SELECT 'high' AS cohort, genre, avg(score) AS avg_score, avg(feature_a) AS avg_feature_a,
         avg(feature_b) AS avg_feature_b, count(*) AS row_count
  FROM items WHERE feature_a > CAST(0.8 AS DOUBLE) AND feature_b > CAST(0.8 AS DOUBLE)
  GROUP BY genre
  UNION ALL
  SELECT 'low', genre, avg(score), avg(feature_a), avg(feature_b), count(*)
  FROM items WHERE feature_a < CAST(0.3 AS DOUBLE) AND feature_b < CAST(0.3 AS DOUBLE)
  GROUP BY genre
)"""
)


def _graph(lines: str) -> str:
    return f"""
nodes AS MATERIALIZED (SELECT DISTINCT p_partkey AS id FROM part),
pairs AS MATERIALIZED (
  SELECT DISTINCT hub AS u, l_partkey AS v
  FROM {lines} JOIN (SELECT l_orderkey, min(l_partkey) AS hub FROM {lines} GROUP BY 1) h
    USING (l_orderkey)
  WHERE hub <> l_partkey
),
edges AS MATERIALIZED (
  SELECT u AS src, v AS dst FROM pairs UNION ALL SELECT v, u FROM pairs
),
degree AS MATERIALIZED (
  SELECT id, count(src) AS degree FROM nodes LEFT JOIN edges ON src = id GROUP BY id
)"""


GRAPH = _graph("lineitem")
SPARSE_GRAPH = _graph(f"(SELECT * FROM lineitem WHERE l_quantity >= {LARGE})")


def _by_hash(x: str) -> str:
    return f"({x}.id % 2147483647 * 469762049 % 2147483647)"


def rounds_sql(name: str, start: str, edges: str, before: str = "x.id < y.id") -> str:
    """A recursive query that runs the colouring rounds from ``start(id, c)``.

    Each step holds the whole state ``(r, id, c)``; ``c = -1`` is uncoloured.
    """
    return f"""
{name}(r, id, c) AS (
  SELECT 0, id, c FROM {start}
  UNION ALL
  SELECT cur.r + 1, cur.id,
         CASE WHEN cur.c >= 0 THEN cur.c WHEN lost.id IS NULL THEN cand.p ELSE -1 END
  FROM {name} cur
  LEFT JOIN ({_proposals(name, edges)}) cand ON cand.id = cur.id
  LEFT JOIN (
    SELECT DISTINCT y.id
    FROM ({_proposals(name, edges)}) x
    JOIN {edges} e ON e.src = x.id
    JOIN ({_proposals(name, edges)}) y ON y.id = e.dst
    WHERE {before} AND x.p = y.p
  ) lost ON lost.id = cur.id
  WHERE EXISTS (SELECT 1 FROM {name} o WHERE o.c = -1)
)"""


def _proposals(name: str, edges: str) -> str:
    return f"""
    SELECT n.id, list_min(list_filter(range(0, len(n.used) + 1),
                                      lambda q: NOT list_contains(n.used, q))) AS p
    FROM (SELECT m.id, coalesce(list(DISTINCT s.c) FILTER (WHERE s.c >= 0), []) AS used
          FROM {name} m LEFT JOIN {edges} e ON e.dst = m.id LEFT JOIN {name} s ON s.id = e.src
          WHERE m.c = -1 GROUP BY m.id) n"""


COLORED = (
    GRAPH
    + ", blank AS (SELECT id, -1 AS c FROM nodes),"
    + rounds_sql("st", "blank", "edges")
    + """,
colors AS (SELECT id, CAST(c AS INT) AS color FROM st WHERE r = (SELECT max(r) FROM st))"""
)

HASH_COLORED = (
    GRAPH
    + ", blank AS (SELECT id, -1 AS c FROM nodes),"
    + rounds_sql(
        "st", "blank", "edges",
        f"({_by_hash('x')} < {_by_hash('y')} OR ({_by_hash('x')} = {_by_hash('y')} AND x.id < y.id))",
    )
    + """,
colors AS (SELECT id, CAST(c AS INT) AS color FROM st WHERE r = (SELECT max(r) FROM st))"""
)

ENDS = """
  JOIN (SELECT l_orderkey AS o, min(l_partkey) AS low, max(l_partkey) AS high
        FROM lineitem GROUP BY 1) x USING (o)"""

KINDS = """CASE seq % 4 WHEN 0 THEN 'REMOVE_EDGE' WHEN 1 THEN 'ADD_NODE'
                    WHEN 2 THEN 'ADD_EDGE' ELSE 'REMOVE_NODE' END"""

DEAREST = """SELECT l_suppkey AS seq, l_orderkey AS o FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey) = 1"""

LOCAL_LOG = f"""
log AS MATERIALIZED (
  SELECT seq, {KINDS} AS type,
         CASE seq % 4 WHEN 1 THEN seq + {NEW_NODES} WHEN 3 THEN high ELSE low END AS a,
         CASE WHEN seq % 4 IN (0, 2) THEN high END AS b,
         CASE seq % 4 WHEN 1 THEN [low, high] END AS neighbors
  FROM ({DEAREST}) f {ENDS}
),"""

LOG = f"""
log AS MATERIALIZED (
  SELECT seq, {KINDS} AS type,
         CASE seq % 4 WHEN 1 THEN seq + {NEW_NODES} WHEN 3 THEN high ELSE low END AS a,
         CASE seq % 4 WHEN 0 THEN high WHEN 2 THEN seq - 1 + {NEW_NODES} END AS b,
         CASE seq % 4 WHEN 1 THEN [low, high, seq - 4 + {NEW_NODES}, seq] END AS neighbors
  FROM (SELECT l_suppkey AS seq, min(l_orderkey) AS o FROM lineitem GROUP BY 1) f {ENDS}
),"""

EFFECTS = f"""
listed AS (SELECT seq, a, unnest(neighbors) AS nb FROM log WHERE type = 'ADD_NODE'),
adds AS MATERIALIZED (
  SELECT a AS src, nb AS dst, seq, false AS needs FROM listed
  UNION ALL SELECT nb, a, seq, true FROM listed
  UNION ALL SELECT a, b, seq, true FROM log WHERE type = 'ADD_EDGE'
  UNION ALL SELECT b, a, seq, true FROM log WHERE type = 'ADD_EDGE'
),
dels AS MATERIALIZED (
  SELECT a AS src, b AS dst, seq FROM log WHERE type = 'REMOVE_EDGE'
  UNION ALL SELECT b, a, seq FROM log WHERE type = 'REMOVE_EDGE'
),
births AS MATERIALIZED (
  SELECT id, -1 AS seq FROM nodes UNION ALL SELECT a, seq FROM log WHERE type = 'ADD_NODE'
),
deaths AS MATERIALIZED (SELECT a AS id, seq FROM log WHERE type = 'REMOVE_NODE'),
claims AS (
  SELECT src, dst, CAST(-1 AS BIGINT) AS seq FROM edges
  UNION ALL
  SELECT src, dst, seq FROM adds
  WHERE src <> dst AND (NOT needs OR
    coalesce((SELECT max(b.seq) FROM births b WHERE b.id = adds.src AND b.seq < adds.seq), -2) >
    coalesce((SELECT max(d.seq) FROM deaths d WHERE d.id = adds.src AND d.seq < adds.seq), -2))
),
edges2 AS MATERIALIZED (
  SELECT DISTINCT src, dst FROM claims c
  WHERE NOT EXISTS (SELECT 1 FROM dels d
                    WHERE d.src = c.src AND d.dst = c.dst AND d.seq > c.seq)
    AND NOT EXISTS (SELECT 1 FROM deaths d WHERE d.id = c.src AND d.seq > c.seq)
    AND NOT EXISTS (SELECT 1 FROM deaths d WHERE d.id = c.dst AND d.seq > c.seq)
),
nodes2 AS MATERIALIZED (
  SELECT id FROM births b GROUP BY id
  HAVING max(seq) > coalesce((SELECT max(d.seq) FROM deaths d WHERE d.id = b.id), -2)
),
named AS (SELECT a AS id FROM log UNION SELECT b FROM log WHERE b IS NOT NULL),
affected AS MATERIALIZED (
  SELECT id FROM nodes2
  WHERE id IN (SELECT id FROM named)
     OR id IN (SELECT dst FROM edges2 WHERE src IN (SELECT id FROM named))
)"""

CHANGES = LOG + EFFECTS
LOCAL_CHANGES = LOCAL_LOG + EFFECTS




def _generated_sql(degree: int = 7, seed: int = 123, rounds: int = 8) -> str:
    """Pairs of free places that meet by a hash of node, place and round."""
    p = 2147483647

    def fifth(name: str) -> str:
        return f"((({name} * {name} % {p}) * ({name} * {name} % {p})) % {p} * {name} + 469762049) % {p}"

    def dealt(turn: int) -> str:
        return (
            f"(id % {p} * 469762049 + place % {p} * 167772161"
            f" + ((id >> 31) + {turn}) % {p} * 377487361) % {p}"
        )

    steps = [
        "size AS (SELECT count(DISTINCT p_partkey) AS n FROM part)",
        f"free0 AS (SELECT CAST(unnest(range(0, n)) AS BIGINT) AS id, least({degree}, n - 1) AS free"
        " FROM size)",
        "all0 AS (SELECT id AS u, id AS v FROM free0 WHERE false)",
    ]
    for r in range(rounds):
        turn = seed + 2 * r
        steps.append(f"""
        stubs{r} AS (SELECT id, unnest(range(1, free + 1)) AS place FROM free{r}),
        first{r} AS (SELECT id, place, {dealt(turn)} AS a, {dealt(turn + 1)} AS b FROM stubs{r}),
        second{r} AS (SELECT id, place, {fifth("a")} AS a, {fifth("b")} AS b FROM first{r}),
        third{r} AS (SELECT id, place, {fifth("a")} AS a, {fifth("b")} AS b FROM second{r}),
        dealt{r} AS (
          SELECT *, (a * {p} + b) % greatest(1, (SELECT sum(free) // 4 FROM free{r})) AS team
          FROM third{r}
        ),
        met{r} AS (
          SELECT DISTINCT least(id, other) AS u, greatest(id, other) AS v FROM (
            SELECT id, lead(id) OVER w AS other, row_number() OVER w AS nr FROM dealt{r}
            WINDOW w AS (PARTITION BY team ORDER BY b, a, id, place)
          ) WHERE nr % 2 = 1 AND id <> other
        ),
        fresh{r} AS MATERIALIZED (SELECT u, v FROM met{r} EXCEPT SELECT u, v FROM all{r}),
        all{r + 1} AS MATERIALIZED (SELECT * FROM all{r} UNION ALL SELECT * FROM fresh{r}),
        free{r + 1} AS MATERIALIZED (
          SELECT id, free - coalesce(used, 0) AS free FROM free{r} LEFT JOIN (
            SELECT id, count(*) AS used
            FROM (SELECT u AS id FROM fresh{r} UNION ALL SELECT v FROM fresh{r}) GROUP BY id
          ) USING (id) WHERE free > coalesce(used, 0)
        )""")
    return (
        f"WITH {', '.join(steps)} SELECT u AS src, v AS dst FROM all{rounds}"
        f" UNION ALL SELECT v, u FROM all{rounds}"
    )


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _counts_sql() -> str:
    kinds = {
        "album": "long",
        "line": "integer",
        "genre": "string",
        "feature_a": "double",
        "feature_b": "double",
    }
    return f"WITH {RAW} " + _union(
        [
            f"SELECT '{c}' AS \"column\", '{t}' AS data_type, count(*) AS row_count,"
            f" count(*) - count({c}) AS null_count, count({c}) AS non_null_count,"
            f" count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)"
            f" AS distinct_count FROM raw"
            for c, t in kinds.items()
        ]
    )


def _numeric_sql(columns: list[str], percentiles: bool) -> str:
    ranks = "".join(
        f", round(CAST(quantile_disc({{c}}, {p}) AS DOUBLE), 6) AS p{p * 100:g}" for p in (0.25, 0.5, 0.75)
    )
    return f"WITH {ITEMS} " + _union(
        [
            f"SELECT '{c}' AS \"column\", round(avg({c}), 6) AS mean,"
            f" round(stddev_samp({c}), 6) AS stddev,"
            f" round(CAST(min({c} + 0) AS DOUBLE), 6) AS min,"
            f" round(CAST(max({c} + 0) AS DOUBLE), 6) AS max"
            + (ranks.format(c=c) if percentiles else "")
            + " FROM items"
            for c in columns
        ]
    )


def oracle_sql() -> dict[str, str]:
    """SQL per query key."""
    return {
        # cleaning
        "quality_probe": f"""WITH {RAW}
            SELECT count(*) AS row_count,
                   count(*) FILTER (WHERE album IS NULL) AS null_album,
                   count(*) FILTER (WHERE genre IS NULL) AS null_genre,
                   count(*) FILTER (WHERE feature_a < 0 OR feature_a > 1) AS outside_feature_a,
                   count(*) FILTER (WHERE feature_b < 0 OR feature_b > 1) AS outside_feature_b,
                   count(*) FILTER (WHERE feature_a < 0 OR feature_a > 1
                                       OR feature_b < 0 OR feature_b > 1) AS bad_range_rows
            FROM raw""",
        "clean_nulls": f"""WITH {RAW}
            SELECT * FROM raw WHERE genre IS NOT NULL AND feature_a IS NOT NULL""",
        "clean_ranges": f"""WITH {RAW}
            SELECT * FROM raw WHERE feature_a BETWEEN 0 AND 1 AND feature_b BETWEEN 0 AND 1""",
        "clean_report": f"""WITH {RAW}, filled AS (
              SELECT * FROM raw WHERE genre IS NOT NULL AND feature_a IS NOT NULL
            ), good AS (
              SELECT * FROM filled WHERE feature_a BETWEEN 0 AND 1 AND feature_b BETWEEN 0 AND 1
            ), sizes AS (
              SELECT (SELECT count(*) FROM raw) AS a, (SELECT count(*) FROM filled) AS b,
                     (SELECT count(*) FROM good) AS c
            )
            SELECT a AS rows_in, a - b AS removed_null, b - c AS removed_range,
                   a - c AS removed_total, c AS rows_out FROM sizes""",
        # profiles
        "profile_counts": _counts_sql(),
        "profile_counts_sketch": f"""SELECT "column", distinct_count, true AS near
            FROM ({_counts_sql()})""",
        "profile_numeric": _numeric_sql(
            ["score", "feature_a", "feature_b", "tempo", "duration", "album"], True
        ),
        "profile_numeric_spread": _numeric_sql(["duration", "part", "album"], False),
        "profile_top_values": f"WITH {ITEMS} "
        + _union(
            [
                f"SELECT '{c}' AS \"column\", {c} AS value, n AS value_count FROM"
                f" (SELECT {c}, count(*) AS n FROM items GROUP BY {c}"
                f" ORDER BY n DESC, {c} LIMIT 10) WHERE {c} IS NOT NULL"
                for c in ("artists", "genre", "kind")
            ]
        ),
        "profile_boolean": f"""WITH {ITEMS}
            SELECT 'flag' AS "column", count(*) FILTER (WHERE flag) AS true_count,
                   count(*) FILTER (WHERE NOT flag) AS false_count,
                   round(count(*) FILTER (WHERE flag) * 100.0 / count(flag), 6)
                     AS true_percentage,
                   round(count(*) FILTER (WHERE NOT flag) * 100.0 / count(flag), 6)
                     AS false_percentage
            FROM items""",
        # buckets
        "bucket_bounds": f"WITH {ITEMS} SELECT album, part, line, tempo,"
        f" {BUCKET_CASE} AS bucket FROM items",
        "bucket_deciles": f"WITH {ITEMS} SELECT album, part, line, score,"
        f" {DECILE_CASE} AS bucket FROM items",
        # top k
        "topk_global": f"""WITH {ITEMS}
            SELECT album, part, line, score, duration FROM items
            ORDER BY duration DESC, album, part, line, score LIMIT 10""",
        "topk_vs_group": f"""WITH {LONGEST}
            SELECT album, part, line, genre, round(duration / 60000, 6) AS duration_units,
                   round(feature_a, 6) AS feature_a, CAST(score AS DOUBLE) AS score,
                   round(group_avg_score, 6) AS group_avg_score,
                   round(group_avg_units, 6) AS group_avg_units,
                   round(score - group_avg_score, 6) AS score_vs_group
            FROM longest JOIN (
              SELECT genre, avg(score) AS group_avg_score,
                     avg(duration) / 60000 AS group_avg_units
              FROM items GROUP BY genre) g USING (genre)""",
        "topk_vs_all": f"""WITH {LONGEST}, x AS (
              SELECT (SELECT avg(score) FROM longest) AS t,
                     (SELECT avg(score) FROM items WHERE feature_a > CAST(0.8 AS DOUBLE)) AS a)
            SELECT round(t, 6) AS top_avg_score, round(a, 6) AS all_avg_score,
                   round(t - a, 6) AS impact FROM x""",
        # flags and cohorts
        "flag_impact": f"""WITH {IMPACT}
            SELECT genre, round(flag_avg, 6) AS flag_avg, round(other_avg, 6) AS other_avg,
                   round(difference, 6) AS difference, impact FROM impact""",
        "flag_impact_counts": f"""WITH {IMPACT}
            SELECT count(*) FILTER (WHERE impact = 'Positive') AS positive_groups,
                   count(*) FILTER (WHERE impact = 'Negative') AS negative_groups,
                   count(*) FILTER (WHERE impact = 'Neutral') AS neutral_groups FROM impact""",
        "flag_impact_top": f"""WITH {IMPACT}
            SELECT 'Positive' AS impact, rank, genre, round(difference, 6) AS difference
            FROM (SELECT genre, difference,
                         CAST(row_number() OVER (ORDER BY difference DESC, genre) AS INT) AS rank
                  FROM impact WHERE impact = 'Positive') WHERE rank <= 10
            UNION ALL
            SELECT 'Negative', rank, genre, round(difference, 6)
            FROM (SELECT genre, difference,
                         CAST(row_number() OVER (ORDER BY difference, genre) AS INT) AS rank
                  FROM impact WHERE impact = 'Negative') WHERE rank <= 10""",
        "flag_by_bucket": f"""WITH {FLAG_BUCKETS}
            SELECT bucket, round(flag_avg, 6) AS flag_avg, round(other_avg, 6) AS other_avg,
                   flag_count, other_count, round(difference, 6) AS difference, pattern
            FROM buckets""",
        "flag_dominant_pattern": f"""WITH {FLAG_BUCKETS}
            SELECT pattern AS dominant_pattern, count(*) AS bucket_count,
                   count(*) >= 7 AS is_consistent
            FROM buckets GROUP BY pattern ORDER BY 2 DESC, 1 LIMIT 1""",
        "mode_per_group": f"""WITH {ITEMS}
            SELECT album, kind AS mode_kind, n AS mode_count
            FROM (SELECT album, kind, count(*) AS n,
                         row_number() OVER (PARTITION BY album ORDER BY count(*) DESC, kind)
                           AS rn
                  FROM items GROUP BY album, kind) WHERE rn = 1""",
        "cohort_groups": f"""WITH {COHORTS}
            SELECT cohort, genre, round(avg_score, 6) AS avg_score,
                   round(avg_feature_a, 6) AS avg_feature_a,
                   round(avg_feature_b, 6) AS avg_feature_b, row_count FROM cohorts""",
        "cohort_summary": f"""WITH {COHORTS}, x AS (
              SELECT count(*) FILTER (WHERE cohort = 'high') AS hn,
                     avg(avg_score) FILTER (WHERE cohort = 'high') AS h,
                     count(*) FILTER (WHERE cohort = 'low') AS ln,
                     avg(avg_score) FILTER (WHERE cohort = 'low') AS l FROM cohorts)
            SELECT hn AS high_groups, round(h, 6) AS high_avg_score, ln AS low_groups,
                   round(l, 6) AS low_avg_score, round(h - l, 6) AS difference,
                   CASE WHEN h - l > 5 THEN 'Positive' WHEN h - l < -5 THEN 'Negative'
                        WHEN h - l IS NOT NULL THEN 'Neutral' END AS impact FROM x""",
        # members
        "collab_top_groups": f"""WITH {CREDITS}
            SELECT members, group_count, round(avg_score, 6) AS avg_score FROM top_groups""",
        "collab_solo_avg": f"""WITH {CREDITS}
            SELECT member, round(solo_avg, 6) AS solo_avg FROM solo""",
        "collab_boost": f"""WITH {CREDITS}
            SELECT members, group_count, round(avg_score, 6) AS avg_score, weakest_member,
                   round(weakest_avg, 6) AS weakest_avg, round(boost, 6) AS boost FROM boosts""",
        "collab_summary": f"""WITH {CREDITS}
            SELECT (SELECT count(*) FROM credits WHERE members LIKE '%;%') AS collaboration_rows,
                   round(coalesce(avg(boost), 0), 6) AS average_boost,
                   coalesce(avg(boost), 0) > 0 AS collaborating_helps FROM boosts""",
        # standouts
        "breakthrough_items": f"""WITH {WEAK}
            SELECT album, part, line, score, round(group_avg_score, 6) AS group_avg_score
            FROM items JOIN weak USING (album) WHERE score > 80""",
        "breakthrough_gap": f"""WITH {WEAK}, hits AS (
              SELECT album, avg(feature_a) AS a, avg(feature_b) AS b
              FROM items JOIN weak USING (album) WHERE score > 80 GROUP BY album
            ), rest AS (
              SELECT album, avg(feature_a) AS a, avg(feature_b) AS b
              FROM items JOIN weak USING (album) WHERE score <= 80 GROUP BY album
            )
            SELECT round(avg(hits.a), 6) AS hit_feature_a, round(avg(hits.b), 6) AS hit_feature_b,
                   round(avg(rest.a), 6) AS other_feature_a,
                   round(avg(rest.b), 6) AS other_feature_b,
                   round(avg(hits.a - rest.a), 6) AS gap_feature_a,
                   round(avg(hits.b - rest.b), 6) AS gap_feature_b
            FROM hits JOIN rest USING (album)""",
        # sweet spots
        "sweetspot_buckets": f"""WITH {SWEET}
            SELECT genre, round(group_avg_score, 6) AS group_avg_score, bucket,
                   round(avg_score, 6) AS avg_score, round(avg_x, 6) AS avg_x, row_count
            FROM stats""",
        "sweetspot_best": f"""WITH {SWEET}
            SELECT genre, round(group_avg_score, 6) AS group_avg_score, best_bucket,
                   round(best_avg_score, 6) AS best_avg_score, round(advantage, 6) AS advantage
            FROM best""",
        "sweetspot_summary": f"""WITH {SWEET}
            SELECT count(*) AS group_count,
                   round(coalesce(avg(advantage), 0), 6) AS average_advantage,
                   coalesce(avg(advantage), 0) > 5 AS is_significant FROM best""",
        # consistency
        "entity_consistency": f"""WITH {STEADY}
            SELECT artists, round(score_stddev, 6) AS score_stddev,
                   round(avg_score, 6) AS avg_score, row_count FROM steady""",
        "entity_diversity": f"""WITH {STEADY}
            SELECT artists, round(score_stddev, 6) AS score_stddev,
                   round(avg_score, 6) AS avg_score, row_count, category_count,
                   primary_category, round(primary_percentage, 6) AS primary_percentage,
                   diversity FROM diversity""",
        "entity_diversity_summary": f"""WITH {STEADY}, x AS (
              SELECT count(*) FILTER (WHERE diversity = 'Highly_Specialized') AS s,
                     count(*) FILTER (WHERE diversity = 'Moderately_Diverse') AS m,
                     count(*) FILTER (WHERE diversity = 'Highly_Diverse') AS d FROM diversity)
            SELECT s AS specialized, m AS moderate, d AS diverse,
                   round(s * 100.0 / (s + m + d), 6) AS specialized_percentage,
                   s > (s + m + d) // 2 AS most_specialized FROM x""",
        # graphs
        "graph_cooccur_edges": f"WITH {GRAPH} SELECT least(u, v) AS u, greatest(u, v) AS v"
        " FROM pairs",
        "graph_half_edges": f"WITH {GRAPH} SELECT src, dst FROM edges",
        "graph_degrees": f"WITH {GRAPH} SELECT id, degree FROM degree",
        "graph_degree_stats": f"""WITH {GRAPH}
            SELECT count(*) AS node_count, max(degree) AS max_degree,
                   round(avg(degree), 6) AS average_degree FROM degree""",
        "graph_color": f"WITH RECURSIVE {COLORED} SELECT id, color FROM colors",
        "graph_color_count": f"""WITH RECURSIVE {COLORED}
            SELECT CAST(max(color) + 1 AS INT) AS best_k, count(*) AS node_count FROM colors""",
        "graph_color_histogram": f"""WITH RECURSIVE {COLORED}
            SELECT color, count(*) AS node_count FROM colors GROUP BY color""",
        "graph_color_rounds": f"""WITH RECURSIVE {COLORED},
            decided AS (SELECT id, min(r) AS d FROM st WHERE c >= 0 GROUP BY id),
            numbers AS (SELECT DISTINCT d AS r FROM decided)
            SELECT CAST(r AS INT) AS round, count(*) AS uncolored,
                   CAST(sum(degree + 1) AS BIGINT) AS messages,
                   count(*) FILTER (WHERE d > r) AS tie_conflicts,
                   count(*) FILTER (WHERE d = r) AS decided
            FROM numbers JOIN decided ON d >= r JOIN degree USING (id) GROUP BY r""",
        "graph_validate": f"""WITH {GRAPH}, clash AS (
              SELECT * FROM pairs WHERE u % 3 = v % 3
                AND u IN (SELECT id FROM nodes) AND v IN (SELECT id FROM nodes))
            SELECT (SELECT count(*) FROM clash) = 0 AS is_valid,
                   (SELECT count(*) FROM clash) AS conflict_count,
                   CAST(0 AS BIGINT) AS uncolored_count, CAST(0 AS BIGINT) AS one_sided_count""",
        "graph_conflict_sample": f"""WITH {GRAPH}
            SELECT least(u, v) AS u, greatest(u, v) AS v, CAST(u % 3 AS INT) AS color
            FROM pairs WHERE u % 3 = v % 3 ORDER BY 1, 2 LIMIT 10""",
        "graph_apply_changes": f"""WITH {GRAPH}, {CHANGES}
            SELECT 'edge' AS kind, src AS a, dst AS b FROM edges2
            UNION ALL SELECT 'node', id, NULL FROM nodes2""",
        "change_stream": f"""WITH {GRAPH}, {CHANGES}
            SELECT 'edge' AS kind, src AS a, dst AS b FROM edges2
            UNION ALL SELECT 'node', id, NULL FROM nodes2""",
        "graph_recolor_stepwise": f"""WITH {SPARSE_GRAPH}, {LOCAL_CHANGES}
            SELECT 'edge' AS kind, src AS a, dst AS b FROM edges2
            UNION ALL SELECT 'node', id, NULL FROM nodes2""",
        "graph_affected": f"WITH {GRAPH}, {CHANGES} SELECT id FROM affected",
        "graph_recolor": f"""WITH RECURSIVE {COLORED}, {CHANGES},
            reset AS MATERIALIZED (
              SELECT id, CASE WHEN id IN (SELECT id FROM affected) THEN -1
                              ELSE coalesce(color, -1) END AS c
              FROM nodes2 LEFT JOIN colors USING (id)
            ), {rounds_sql("st2", "reset", "edges2")}
            SELECT id, CAST(c AS INT) AS color FROM st2
            WHERE r = (SELECT max(r) FROM st2)""",
        "graph_recolor_fixed_k": f"""WITH RECURSIVE {COLORED}, {CHANGES},
            reset AS MATERIALIZED (
              SELECT id, CASE WHEN id IN (SELECT id FROM affected) THEN -1
                              ELSE coalesce(color, -1) END AS c
              FROM nodes2 LEFT JOIN colors USING (id)
            ), {rounds_sql("st2", "reset", "edges2")},
            again AS (SELECT id, CAST(c AS INT) AS color FROM st2 WHERE r = (SELECT max(r) FROM st2))
            SELECT n.id, CASE WHEN (SELECT max(color) FROM again) <= (SELECT max(color) FROM colors)
                              THEN a.color
                              WHEN n.id IN (SELECT id FROM deaths) THEN NULL
                              ELSE c.color END AS color
            FROM nodes2 n LEFT JOIN again a USING (id) LEFT JOIN colors c USING (id)""",
        "graph_color_hash": f"WITH RECURSIVE {HASH_COLORED} SELECT id, color FROM colors",
        "csv_read": f"""WITH {ITEMS},
          planted AS (
            SELECT *, line = 5 AND part % 4 < 2 AS fields,
                   (line = 3 OR line = 4) AND part % 5 = 0 AS bad_score, line = 3 AND part % 3 = 0 AS bad_flag
            FROM items)
          SELECT CASE WHEN fields THEN 'fields' WHEN bad_score AND bad_flag THEN 'score,flag'
                      WHEN bad_score THEN 'score' WHEN bad_flag THEN 'flag' ELSE 'row' END AS reason,
                 album, CASE WHEN good THEN part END AS part, CASE WHEN good THEN line END AS line,
                 CASE WHEN good AND line = 1 THEN 'a "' || genre || '", b'
                      WHEN good AND line <> 2 THEN genre END AS genre,
                 CASE WHEN good THEN score END AS score, CASE WHEN good THEN flag END AS flag,
                 CASE WHEN good THEN duration END AS duration
          FROM (SELECT *, NOT (fields OR bad_score OR bad_flag) AS good FROM planted)""",
        "report_round_trip": f"""WITH {ITEMS}
          SELECT genre AS name, count(*) AS n, CAST(sum(score) AS DOUBLE) AS value FROM items GROUP BY genre
          UNION ALL
          SELECT CAST(line AS VARCHAR), NULL,
                 CASE line WHEN 1 THEN CAST('inf' AS DOUBLE) WHEN 2 THEN CAST('-inf' AS DOUBLE)
                      WHEN 3 THEN CAST('nan' AS DOUBLE) ELSE CAST(max(score) AS DOUBLE) END
          FROM items GROUP BY line
          UNION ALL SELECT 'genres', NULL, NULL
          UNION ALL SELECT 'metrics', count(*), NULL FROM items""",
        "graph_json_round_trip": f"""WITH {GRAPH}
            SELECT src AS a, dst AS b, CAST(NULL AS INT) AS color FROM edges
            UNION ALL SELECT id, NULL, CAST(id % 3 AS INT) FROM nodes""",
        "change_log_round_trip": f"""WITH {GRAPH}, {CHANGES}
            SELECT seq, type, a, b, array_to_string(neighbors, ',') AS neighbors FROM log""",
        "change_log_array": f"""WITH {GRAPH}, {CHANGES}
            SELECT row_number() OVER (ORDER BY seq) - 1 AS seq, type, a, b,
                   array_to_string(neighbors, ',') AS neighbors FROM log""",
        "coloring_round_trip": f"""WITH {GRAPH}
            SELECT CAST(id % 3 AS INT) AS color, count(*) AS node_count FROM nodes GROUP BY 1
            UNION ALL SELECT 3, count(*) FROM nodes""",
        "profile_percentile_rank": """SELECT "column", percentile, true AS within
            FROM (SELECT unnest(['score', 'duration', 'album']) AS "column"),
                 (SELECT unnest([0.25::DOUBLE, 0.5::DOUBLE, 0.75::DOUBLE]) AS percentile)""",
        "graph_demo_changes": f"""WITH {GRAPH}, facts AS (
              SELECT max(id) AS top, bool_or(id = 5) AS has5,
                     (SELECT count(*) FROM edges WHERE src = 10 AND dst = 11) AS e1011,
                     (SELECT count(*) FROM edges WHERE src = 5 AND dst = 7) AS e57,
                     (SELECT count(*) FROM edges WHERE src = 3) AS d3 FROM nodes
            ), steps AS (
              SELECT 1 AS o, 'REMOVE_EDGE' AS type, 10 AS a, 11 AS b, NULL AS neighbors
              FROM facts WHERE top >= 11 AND e1011 > 0
              UNION ALL
              SELECT 2, 'ADD_NODE', top + 1, NULL,
                     array_to_string(list_filter([5, 10], lambda q: q <= top), ',') FROM facts
              UNION ALL
              SELECT 3, 'ADD_EDGE', 5, 7, NULL FROM facts WHERE top >= 7 AND has5 AND e57 = 0
              UNION ALL
              SELECT 4, 'REMOVE_NODE', 3, NULL, NULL FROM facts
              WHERE top >= 3 AND d3 BETWEEN 1 AND 5
            )
            SELECT row_number() OVER (ORDER BY o) - 1 AS seq, type, CAST(a AS BIGINT) AS a,
                   CAST(b AS BIGINT) AS b, neighbors FROM steps""",
        "graph_generate": _generated_sql(),
    }
