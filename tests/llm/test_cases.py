"""Defined results for nulls, empty and long texts, repeats, empty tables and clashing columns."""

import hashlib
import re
import time
from html import unescape

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkloom.llm import (
    catalog,
    cover_tree,
    linear_text,
    main_text,
    mixing,
    ngram_join,
    packing,
    posting_lists,
    quality_rff,
    secret_scan,
    sharding,
    words,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = " ".join(f"word{i}" for i in range(300))


def frame(spark, texts, ids=None, sources=None):
    ids = range(len(texts)) if ids is None else ids
    sources = ["a"] * len(texts) if sources is None else sources
    rows = [(i, t, "en", s, len(t or "")) for i, t, s in zip(ids, texts, sources, strict=True)]
    return spark.createDataFrame(rows, DOCS)


def shingles(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    if 0 < len(found) < 3:
        return {tuple(found)}
    return {tuple(found[i : i + 3]) for i in range(len(found) - 2)}


def test_shingle_sets():
    texts = ["A b  C\td", "a B c d", "a b", "a", "", None, "x " * 500, "Ä b c", "ä b c", "a b c d"]
    values, offsets = words.shingle_sets(pa.array(texts, pa.string()), 3)
    sets = [frozenset(values[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    want = [shingles(t) for t in texts]
    assert [len(s) for s in sets] == [len(w) for w in want]
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            assert len(x & y) == len(want[i] & want[j])


def test_join_against_brute_force(spark):
    draw = np.random.default_rng(3)
    base = [f"w{i}" for i in draw.integers(0, 5000, 120)]
    texts = [None, "", " \n", "one", "ONE", "one two", " ".join(base), " ".join(base).upper()]
    for size in (10, 12, 13, 20, 30, 60, 120):
        stem = [f"s{size}x{i}" for i in range(size)]
        texts.append(" ".join(stem))
        for _ in range(6):
            near = list(stem)
            for _ in range(int(draw.integers(1, 3))):
                at = int(draw.integers(0, len(near)))
                near[at : at + 1] = [] if draw.random() < 0.5 else [f"n{draw.integers(1000)}"]
            texts.append(" ".join(near))
    # A group with more members than a short list has.
    passage = [f"p{i}" for i in range(90)]
    texts += [" ".join([*passage, f"end{i}", f"last{i % 7}"]) for i in range(45)]
    ids = list(range(1, len(texts) + 1))
    texts, ids = [*texts, texts[6], "no id"], [*ids, ids[6], None]
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            linked = both and 100 * both >= 90 * len(sets[i] | sets[j])
            if linked and None not in (ids[i], ids[j]):
                parent[root(i)] = root(j)
    low = {}
    for i, x in enumerate(ids):
        if x is not None:
            low[root(i)] = min(low.get(root(i), x), x)
    want = sorted((x or 0, len(sets[i]), low[root(i)] if x else 0) for i, x in enumerate(ids))
    docs = frame(spark, texts, ids).withColumn("component_id", F.lit("clash")).repartition(5)
    got = ngram_join.jaccard_components(docs).collect()
    assert sorted((r[0] or 0, r[1], r[2] or 0) for r in got) == want
    assert ngram_join.jaccard_components(docs.limit(0)).count() == 0


def components_by_pairs(sets, percent):
    """The smallest number that links of all pairs reach, per set."""
    low = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((low[i], low[j]))
                low = [a if x == b else x for x in low]
    return low


def test_join_enumerates_subsets(spark, monkeypatch):
    texts = []
    for size in (11, 12, 13):
        stem = " ".join(f"s{size}x{i}" for i in range(size))
        texts += [stem, *[f"{stem} end{i}" for i in range(100)]]
    found = []
    boundary = ngram_join._boundary
    monkeypatch.setattr(ngram_join, "_boundary", lambda *a: found.append(boundary(*a)) or found[0])
    got = ngram_join.jaccard_components(frame(spark, texts).repartition(3)).collect()
    sets = [shingles(t) for t in texts]
    want = components_by_pairs(sets, 90)
    assert found[0] >= 12 and {len(s) for s in sets} == {9, 10, 11, 12}
    assert sorted(map(tuple, got)) == [(i, len(s), want[i]) for i, s in enumerate(sets)]


def test_join_of_long_lists(spark, monkeypatch):
    """Many near copies in one list, with outliers, other groups and sets of other sizes."""
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    draw = np.random.default_rng(8)
    passage = [f"p{i}" for i in range(150)]
    texts = []
    for i in range(120):
        near = list(passage)
        near[int(draw.integers(150))] = f"n{i}"
        texts.append(" ".join(near))
    for group in range(12):
        # Sets that share most of the passage and are similar to a few others only.
        cut = sorted(draw.choice(150, 150 - int(draw.integers(6, 40)), replace=False))
        stem = [passage[i] for i in cut]
        for _ in range(int(draw.integers(1, 7))):
            near = list(stem)
            near[int(draw.integers(len(near)))] = f"m{draw.integers(10**6)}"
            texts.append(" ".join(near))
    texts += [" ".join(passage[:length]) for length in range(60, 150, 3)]
    sets = [shingles(t) for t in texts]
    want = components_by_pairs(sets, 90)
    order = draw.permutation(len(texts)).tolist()
    docs = frame(spark, [texts[i] for i in order], order).repartition(4)
    got = ngram_join.jaccard_components(docs).collect()
    assert sorted(map(tuple, got)) == [(i, len(s), want[i]) for i, s in enumerate(sets)]
    assert len(set(want)) > 5


def test_boundary_has_no_limit(spark):
    def sizes(n, sets, length):
        classes = spark.createDataFrame([(n,)] * sets, "n long")
        scans = spark.createDataFrame([(n, length)] * sets, "n long, length long")
        return ngram_join._boundary(classes, scans, 90)

    assert sizes(40, 50, 10**6) == 40 and sizes(40, 50, 1) == 0 and sizes(5000, 3, 10**9) == 0


def test_mixing(spark):
    sources = ["b", "a", "a", None, "c", "c"]
    docs = frame(spark, ["x y z", "x " * 40, None, "q w", "", "e " * 30], sources=sources)
    rows = {r["doc_id"]: r for r in mixing.mix(docs.withColumn("size", F.lit("clash"))).collect()}
    size = {"a": 40, "b": 3, "c": 30, None: 2}
    # The small sources stop at three times their size, the rest share 75 - 15 by weight.
    want = {"a": 15.0, "b": 9.0, "c": 45.0, None: 6.0}
    for i, source in enumerate(sources):
        assert rows[i]["source_size"] == size[source]
        assert rows[i]["target"] == pytest.approx(want[source])
        assert rows[i]["taken"] <= 3 * rows[i]["size"]
    copies = sum(r["copies"] for r in rows.values())
    assert mixing.mixed_documents(docs).count() == copies
    assert mixing.mix(docs.limit(0)).count() == 0


def test_sharding(spark):
    table = {r["slot"]: r["shard"] for r in sharding.lookup_table(spark, 7, 101).collect()}
    assert [table[i] for i in range(101)] == sharding.lookup_list(7, 101)
    rows = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "doc_id long, shard string")
    placed = sharding.place(rows, "doc_id").collect()
    assert len(placed) == 3 and len({r["shard"] for r in placed if r["doc_id"] == 1}) == 1
    assert sharding.place(rows.limit(0), "doc_id").count() == 0
    before, after = sharding.lookup_list(16, 4099), sharding.lookup_list(15, 4099)
    moved = sum(a != b and a != 15 for a, b in zip(before, after, strict=True))
    assert moved < 0.12 * 4099
    with pytest.raises(ValueError):
        sharding.lookup_table(spark, 3, 100)


def test_packing(spark):
    texts = [None, "", "one", "a " * 20_000, *["b " * (i % 700 + 1) for i in range(300)]]
    docs = frame(spark, texts + texts[:3], [*range(len(texts)), 0, None, 2])
    rows = packing.pack(docs, group=50).toPandas()
    assert rows.n_words.sum() == sum(len((t or "").split()) for t in texts + texts[:3])
    full = rows[rows.n_words > 0].sort_values(["bin_id", "bin_offset"])
    assert rows[rows.n_words == 0].bin_id.isna().all()
    for _, bin_rows in full.groupby("bin_id"):
        assert (bin_rows.bin_offset == bin_rows.n_words.cumsum() - bin_rows.n_words).all()
        length = bin_rows.bin_length.iloc[0]
        used = bin_rows.n_words.sum()
        assert used <= length == min(c for c in packing.CAPACITIES if c >= used)
    assert packing.pack(docs.limit(0)).count() == 0
    assert packing.best_fit([6, 5, 4, 3], (10,), 0) == ([0, 1, 0, 1], [0, 0, 6, 5], [10, 10])


def least_cost(sizes, capacities, overhead):
    """The least cost of any way to put the sizes into bins that shrink to their contents."""
    best = [float("inf")]

    def place(at, used):
        if at == len(sizes):
            lengths = [min(c for c in capacities if c >= u) for u in used]
            best[0] = min(best[0], packing.cost(lengths, overhead))
            return
        for i in range(len(used)):
            if used[i] + sizes[at] <= max(capacities):
                place(at + 1, [*used[:i], used[i] + sizes[at], *used[i + 1 :]])
        place(at + 1, [*used, sizes[at]])

    place(0, [])
    return best[0]


def test_packing_chooses_lengths_jointly():
    draw = np.random.default_rng(8)
    optimal = 0
    for _ in range(150):
        capacities, overhead = (8, 12, 20), int(draw.integers(0, 5))
        sizes = sorted(draw.integers(1, 21, draw.integers(1, 7)).tolist(), reverse=True)
        bins, offsets, lengths = packing.best_fit(sizes, capacities, overhead)
        got = packing.cost(lengths, overhead)
        least = least_cost(sizes, capacities, overhead)
        assert least <= got <= 1.3 * least + overhead
        optimal += got == least
        ends = [offset + size for offset, size in zip(offsets, sizes, strict=True)]
        for number, length in enumerate(lengths):
            assert max(e for e, b in zip(ends, bins, strict=True) if b == number) <= length
        for only in capacities:
            single = packing._packing(
                sizes, list(capacities), lambda i, room: max(only, min(c for c in capacities if c >= sizes[i]))
            )
            assert got <= packing.cost(single[2], overhead)
    assert optimal >= 120
    # Pieces of two lengths that go badly together open bins of both.
    sizes = [700] * 40 + [500] * 41
    opened = []
    choose = packing._opener(sizes, [512, 1024, 1440], 16)

    def seen(at, room):
        opened.append(choose(at, room))
        return opened[-1]

    packing._packing(sizes, [512, 1024, 1440], seen)
    assert len(set(opened)) >= 2
    start = time.time()
    packing.best_fit(sorted(draw.integers(1, 3000, 20_000).tolist(), reverse=True))
    assert time.time() - start < 10


def test_language(spark):
    parts = {"aa": "ka lo mi tu", "bb": "xer zon quil vast", "cc": "schru pfont grumm tz"}
    draw = np.random.default_rng(1)
    rows = []
    for i in range(240):
        lang = list(parts)[i % 3]
        pieces = [*parts[lang].split(), *parts[lang].split()[:2]]
        text = " ".join("".join(draw.choice(pieces, 2)) for _ in range(30))
        rows.append((i, text, lang if i % 10 else None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = linear_text.train(docs.where("doc_id % 5 <> 0"), "doc_id", "text", "lang")
    odd = [(1000, None, None), (1001, "", "aa"), (1002, "123 !", "aa"), (None, rows[0][1], "aa")]
    odd.append((1003, "日本語", "aa"))
    more = docs.union(spark.createDataFrame(odd, docs.schema)).withColumn("score", F.lit("clash"))
    found = linear_text.predict(more, model)
    got = {r["doc_id"]: r for r in found.collect()}
    right = [got[i]["lang_pred"] == list(parts)[i % 3] for i in range(0, 240, 5)]
    assert np.mean(right) > 0.95
    for i in (1000, 1001, 1002):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["accepted"]) == ("und", 0.0, False)
    assert None in got
    unseen = linear_text.Model(["x", "y"], np.zeros((8, 2)), threshold=0.55).predict(["abc"])
    assert unseen[1].tolist() == [0.5] and not unseen[2][0]
    kept = linear_text.keep_accepted(docs.union(spark.createDataFrame(odd, docs.schema)), model)
    assert kept.count() in (241, 242) and kept.where("lang IS NULL").count() == 0
    nothing = linear_text.train(docs.limit(0), "doc_id", "text", "lang")
    assert linear_text.predict(docs, nothing).where("lang_pred = 'und'").count() == 240
    assert linear_text.predict(docs.limit(0), model).count() == 0


def test_language_learns_every_label(spark):
    draw = np.random.default_rng(4)
    rows = []
    for label in range(120):
        letters = draw.choice(list("abcdefghijklmnopqrstuvwxyz"), 6, replace=False)
        stems = ["".join(draw.choice(letters, 5)) for _ in range(8)]
        rows += [(len(rows) + i, " ".join(draw.choice(stems, 20)), f"l{label:03}", "s", 0) for i in range(12)]
    docs = spark.createDataFrame(rows, DOCS)
    model = linear_text.train(docs, "doc_id", "text", "lang")
    assert model.labels == [f"l{label:03}" for label in range(120)]
    got = {r["doc_id"]: r["lang_pred"] for r in linear_text.predict(docs, model).collect()}
    assert sum(got[r[0]] == r[2] for r in rows) >= 0.95 * len(rows)


def test_quality(spark):
    draw = np.random.default_rng(2)
    rows, labels = [], []
    for i in range(300):
        found = ["".join(draw.choice(list("abcdefgh"), 5)) for _ in range(60)]
        good = i % 3 > 0
        rows.append(" ".join(found) if good else " ".join(w.upper() + "!!" for w in found))
        labels.append((i, int(good)))
    docs = frame(spark, [*rows, None, "", rows[0]], [*range(300), 900, 901, 0])
    known = spark.createDataFrame([*labels, (5, None), (None, 1)], "doc_id long, quality int")
    scored = quality_rff.score_quality(docs, known.where("doc_id % 2 = 0 OR doc_id IS NULL"))
    got = scored.toPandas()
    assert len(got) == 303 and got.score.between(0, 1).all()
    held = got[(got.doc_id < 300) & (got.doc_id % 2 == 1)]
    assert (held.predicted == (held.doc_id % 3 > 0)).mean() > 0.97
    assert got[got.doc_id >= 900].score.nunique() == 1
    none = quality_rff.score_quality(docs, known.limit(0)).select("score").distinct().collect()
    assert [round(r[0], 2) for r in none] == [0.5]
    level = quality_rff.pooled(np.array([0.1, 0.2, 0.3]), np.array([0.5, 0.2, 0.9]), np.ones(3))[1]
    assert level.tolist() == [0.35, 0.9]


def test_main_text(spark):
    page = """<!doctype html><html><head><title>T</title><script>var a="<p>no</p>"</script></head>
    <body><header><a href="/">Site</a></header><nav><ul><li><a>Menu</a></ul></nav>
    <div class="ad">Buy this, buy it now, really.</div><article><h1>Head &amp; tail</h1>
    <p>First   para, with <b>bold</b>&nbsp;words,<br>and a second line of it.
    <p>Second &lt;para&gt; follows the first, and is long enough.</p><form><p>Sign up, now.</p></form>
    <div class="comments"><p>A reader wrote this, at length, with commas.</p></div></article>
    <aside>Side</aside><footer>&copy; foot</footer>"""
    want = "Head & tail\nFirst para, with bold words, and a second line of it.\n"
    want += "Second <para> follows the first, and is long enough."
    assert main_text.main_text(page) == want
    long = "<article>" + "<p>Many words, in it.</p>" * 5000 + "</article>"
    assert main_text.main_text(long).count("\n") == 4999
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (3, "v", ""), (None, "w", "<p>a<p>b")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = main_text.extract(pages.withColumn("text", F.lit("clash")), ["page_id", "url"]).collect()
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in got) == [
        (0, "a\nb", 3), (1, want, len(want)), (1, want, len(want)), (2, "", 0), (3, "", 0)
    ]
    assert main_text.extract(pages.limit(0)).count() == 0
    assert main_text.main_text("x < y " + unescape("&amp;")) == "x < y &"


@pytest.mark.parametrize(
    "page",
    [
        "<p>some text</p>" + "<a " * 100_000,
        "<div>" * 50_000 + "some text, long enough to count here" + "</div>" * 50_000,
        "<div class=sidebar>" * 20_000 + "<p>some text, long enough to count here</p>",
        "<div>" * 20_000 + "</b></li><li>some text" * 20_000,
        "<h1>some text</h1></p>" * 30_000,
    ],
)
def test_odd_pages_take_linear_time(page):
    began = time.perf_counter()
    main_text.main_text(page)
    assert time.perf_counter() - began < 10


def test_formulas_stay():
    page = "<article><p>Let <math><mi>x</mi></math> be a number, as in <object>this</object>.</p></article>"
    assert main_text.main_text(page).split() == "Let x be a number, as in this .".split()


def test_main_text_in_named_containers():
    first = "The first paragraph tells, at some length, what happened."
    second = "The second paragraph says why, and what came of it later."
    body = f"<h1>Head</h1><p>{first}</p><p>{second}</p>"
    want = f"Head\n{first}\n{second}"
    off = "<div class='{}'><p>Some other text, which nobody wants to read here.</p></div>"
    named = "has-sidebar no-sidebar|content with-widgets|widget|social|related|notice|post no-comments"
    for name in named.split("|"):
        page = f"<body><div class='{name}'>{body}{off.format('ad')}</div>{off.format('related-posts')}</body>"
        assert main_text.main_text(page) == want, name
        page = f"<body><div id='{name}'><p>{first}</p><p>{second}</p></div></body>"
        assert main_text.main_text(page) == f"{first}\n{second}", name
    for page in (
        "<html class='no-comments'><body class='post comments-open'>{}</body></html>",
        "<article class='no-comments'>{}</article>", "<main id='comments'>{}</main>",
        "<article class='comment-list'>{}</article>",
        "<div class='modal'><main>{}</main></div>",
        "<article>{}</article><article class='comment'><p>A reader wrote, at length.</p></article>",
        "<article>{}<article class='comment'><p>A reader wrote, at length.</p></article></article>",
        "<div>{}<div id='comments'>" + "<p>A reader wrote, at great length, of this.</p>" * 40 + "</div></div>",
    ):
        assert main_text.main_text(page.format(body)) == want, page
    for name in "ad sidebar sidebar-right cookie-banner related-posts comment-list widget share-bar".split():
        for page in (f"{body}{off.format(name)}", f"{off.format(name)}<article>{body}</article>"):
            assert main_text.main_text(f"<body><div>{page}</div></body>") == want, name
    assert main_text.main_text(f"<body>{off.format('cookie')}<p>short</p></body>") == "short"
    links = "<ul><li><a href='/a'>Source one</a></li><li><a href='/b'>Source two</a></li></ul>"
    for page in (
        f"<article>{body}<h2>References</h2>{links}</article>",
        f"<article>{body}<section><h2>References</h2>{links}</section></article>",
        f"<div><ul><li><a href='/m'>Menu of the site</a></li></ul>{body}<h2>References</h2>{links}</div>",
    ):
        assert main_text.main_text(page) == want + "\nReferences\nSource one\nSource two", page


def vectors(spark, n=700, size=8):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(n, size))
    x[1::50] = x[0]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    odd = [(9000, None), (9050, [1.0, None]), (9100, [float("nan")] * size), (None, rows[0][1])]
    odd.append(rows[3])
    frame = spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<double>")
    return x, frame.withColumn("score", F.lit("clash"))


def exact(x, step, k):
    for q in range(0, len(x), step):
        scores = x @ x[q]
        scores[q] = -np.inf
        yield q, np.lexsort((np.arange(len(x)), -scores.round(9)))[:k].tolist()


def test_exact_top_k(spark):
    x, frame = vectors(spark)
    whole = np.floor(256 * x)
    found = cover_tree.top_k(
        frame, lambda i: i % 50 == 0, transform=lambda c: F.floor(256 * c).cast("double"),
        rows=100, group=3,
    ).toPandas()
    got = found.sort_values("rank").groupby("query_id").vec_id.agg(list).to_dict()
    assert got == dict(exact(whole, 50, 5))
    assert cover_tree.top_k(frame.limit(0), lambda i: i % 50 == 0).count() == 0
    few = cover_tree.top_k(frame.where("vec_id < 3"), lambda i: i % 50 == 0).collect()
    assert len(few) == 2


def test_nearest(spark):
    x, frame = vectors(spark, 3000, 16)
    found = posting_lists.nearest(frame, lambda i: i % 20 == 0).toPandas()
    got = found.groupby("query_id").vec_id.agg(set).to_dict()
    recall = np.mean([len(got[q] & set(w)) / 20 for q, w in exact(x, 20, 20)])
    assert recall >= 0.9 and (found.groupby("query_id").size() == 20).all()
    assert posting_lists.nearest(frame.limit(0), lambda i: i % 20 == 0).count() == 0


def test_nearest_goes_on_past_small_lists(spark):
    draw = np.random.default_rng(8)
    x = draw.normal(size=(3000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    # A small cluster far from all else, whose members lie almost on their centroid.
    x[:5] = np.eye(16)[0] * 40 + draw.normal(size=(5, 16)) * 1e-3
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)] + [(0, [float(c) for c in x[0]])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = posting_lists.nearest(frame, lambda i: (i < 5) | (i % 100 == 0)).toPandas()
    assert (found.groupby("query_id").size() == 20).all() and found.query_id.nunique() == 34
    for query in range(5):
        assert set(range(5)) - {query} <= set(found.vec_id[found.query_id == query])
    few = posting_lists.nearest(frame.where("vec_id < 8"), lambda i: i < 5).toPandas()
    assert (few.groupby("query_id").size() == 7).all()


def test_secrets(spark):
    random = hashlib.sha256(b"x").digest().hex().upper()[:20] + "gT7kQz9LpW2xVb4N"
    texts = [
        None, "", 'é Password: "abcdefgh1" token=secret:abcdefghij short token=abc',
        "AKIA" + "Z" * 11, "AKIA" + "Z9" * 8, "f" * 31 + " " + "0a" * 16, f"id {random} end",
        "internationalization_of_ordinary_words_here", "token = " + "ab" * 5000,
        *["some ordinary words and identifiers like get_value or toString"] * 30,
    ]
    docs = frame(spark, texts)
    found = secret_scan.scan(docs.withColumn("hex", F.lit("clash")))
    got = {r["doc_id"]: r for r in secret_scan.digests(found).collect()}
    base = re.compile(secret_scan.ASSIGN, re.A)
    for i, text in enumerate(texts):
        text = text or ""
        spans = [(m.start(), 0, "assign", m.end()) for m in base.finditer(text) if len(m[2]) >= 8]
        for n, kind, least, pattern in ((1, "access", 16, "AKIA[A-Z0-9]+"), (2, "hex", 32, "[0-9a-f]+")):
            spans += [
                (m.start(), n, kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least
            ]
        text = ",".join(f"{k}:{a}:{e}" for a, _, k, e in sorted(spans))
        assert got[i]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert got[6]["spans"] == f"markov:3:{3 + len(random)}" and got[7]["spans"] == ""
    masked = {r[0]: r[1] for r in found.select("doc_id", secret_scan.masked(found)).collect()}
    assert masked[0] is None and masked[6] == "id [SECRET] end"
    assert masked[2] == 'é [SECRET]" token=secret:abcdefghij short token=abc'
    assert secret_scan.scan(docs.limit(0)).count() == 0


def test_secrets_against_plain_python(spark):
    """Places of many matches, overlaps with the base and masks, in texts long and short."""
    draw = np.random.default_rng(4)
    pieces = ["é", " ", "a" * 31, "0f" * 20, "AKIA" + "Q7" * 9, "token=", "gT7kQz9LpW2xVb4N" * 2, "\n", "𝄞 x", "secret: "]
    texts = ["".join(draw.choice(pieces, draw.integers(1, 60))) for _ in range(200)]
    many = "".join(f"{hashlib.md5(str(i).encode()).hexdigest()} é " for i in range(30_000))
    found = secret_scan.scan(frame(spark, [*texts, many]))
    columns = ["assign", "access", "hex", "markov", "text", secret_scan.masked(found).alias("clean")]
    start = time.time()
    rows = found.select("doc_id", *columns).collect()
    assert time.time() - start < 60
    run = re.compile(secret_scan.RUN)
    for r in rows:
        text = r["text"]
        base = [(s["start"], s["end"]) for kind in ("assign", "access", "hex") for s in r[kind]]
        assert [tuple(s) for s in r["hex"]] == [
            m.span() for m in re.finditer("[0-9a-f]{32,}", text)
        ]
        runs = {m.span() for m in run.finditer(text)}
        if r["doc_id"] < 200:
            runs = {x for x in runs if all(b <= x[0] or x[1] <= a for a, b in base)}
        markov = [(s["start"], s["end"]) for s in r["markov"]]
        assert set(markov) <= runs and markov == sorted(markov)
        clean, at = "", 0
        for a, b in sorted(base + markov):
            if a >= at and b > at:
                clean += text[at:a] + secret_scan.MASK
            at = max(at, b)
        assert r["clean"] == clean + text[at:]
    assert sum(len(r["markov"]) for r in rows) > 50


def test_pipeline_stages(spark):
    near = PROSE.split()
    near[100] = "changed"
    texts = [PROSE, " ".join(near), None, "123", *[f"{PROSE[i * 9:]} tail{i}" for i in range(1, 30, 7)]]
    docs = frame(spark, [*texts, texts[4]], [*range(len(texts)), 4])
    kept = corpus_pipeline.language(spark, docs, "")
    assert kept.columns == corpus_pipeline.COLUMNS
    ids = {r["doc_id"] for r in kept.collect()}
    assert 2 not in ids and 3 not in ids
    alone = corpus_pipeline.near_duplicates(spark, docs, "")
    rows = sorted(r["doc_id"] for r in alone.collect())
    groups = ngram_join.jaccard_components(docs, k=5, percent=80)
    assert rows == sorted({r["component_id"] for r in groups.collect()}) and 1 not in rows
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "ngram_join", "secret_scan", "mixing", "best_fit_packing"
    ]


def test_pipeline_near_copies(spark):
    draw = np.random.default_rng(5)
    texts = []
    for i in range(12):
        stem = [f"t{i}x{j}" for j in range(200)]
        scattered, passage, other = list(stem), list(stem), list(stem)
        for at in range(20, 20 + 40 * 4, 40):
            scattered[at] = f"n{i}x{at}"
        passage[90 : 90 + 14] = [f"p{i}x{j}" for j in range(14)]
        other[::12] = [f"o{i}x{j}" for j in range(len(other[::12]))]
        texts += [" ".join(x) for x in (stem, scattered, passage, other)]
    texts += [" ".join(f"u{draw.integers(9000)}" for _ in range(60)) for _ in range(5)]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    for i in range(0, 48, 4):
        for near in (1, 2):
            assert 0.8 <= len(sets[i] & sets[i + near]) / len(sets[i] | sets[i + near]) < 0.9
    kept = corpus_pipeline.near_duplicates(spark, frame(spark, texts).repartition(3), "")
    got = sorted(r["doc_id"] for r in kept.collect())
    want = components_by_pairs(sets, 80)
    assert got == sorted(set(want)) and len(got) == 29


def test_pipeline_keeps_rows_that_share_an_id(spark):
    stem = [f"a{i}" for i in range(80)]
    near = " ".join([*stem[:-1], "end"])
    other = " ".join(f"b{i}" for i in range(80))
    texts = [(1, " ".join(stem)), (3, near), (3, other), (7, other), (9, "alone"), (9, "alone")]
    texts += [(None, other), (None, "free"), (5, None), (5, None), (5, ""), (6, "")]
    docs = frame(spark, [t for _, t in texts], [k for k, _ in texts]).repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    want = [(1, " ".join(stem)), (3, other), (9, "alone"), (None, "free"), (5, None), (5, ""), (6, "")]
    assert got == sorted(want, key=str)


def test_pipeline_run(spark, tmp_path):
    """All stages against plain Python: what stays, whole, masked, once, in sequences that fit."""
    draw = np.random.default_rng(17)
    tongues = {
        "en": "the quick house with that stone over which weather thinks".split(),
        "de": "der schnelle hund über straße wäre nicht zwischen bücher gehört".split(),
    }
    rows = []
    for i in range(60):
        lang = ("en", "de")[i % 2]
        words = [f"{w}{'' if draw.random() < 0.5 else 's'}" for w in draw.choice(tongues[lang], 70)]
        rows.append((i, " ".join(words), lang, "one", 0))
    rows += [(i + 100, rows[i][1].rsplit(" ", 1)[0], rows[i][2], "one", 0) for i in range(10)]
    rows += [(3, rows[8][1] + " tail", "en", "one", 0), (200, None, "en", "one", 0), (201, "1 2", None, "one", 5)]
    secret = "password = hunter2hunter2hunter2"
    rows.append((300, f"{rows[0][1][::-1]} the house {secret}", "en", "one", 0))
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    accepted = {(r["doc_id"], r["text"]) for r in corpus_pipeline.language(spark, docs, "").collect()}
    kept = sorted(x for x in accepted)
    assert {k for k, _ in kept} >= set(range(60)) and not {200, 201} & {k for k, _ in kept}
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in kept)]
    low = components_by_pairs(sets, 80)
    want = {}
    for i, (key, text) in enumerate(kept):
        if low[i] == i:
            left = text.replace(secret, secret_scan.MASK)
            want.setdefault(key, []).append(len(left.split()))
    pieces, bins = {}, {}
    for r in out:
        pieces[r["doc_id"]] = pieces.get(r["doc_id"], 0) + r["n_words"]
        bins.setdefault((r["bin_id"], r["bin_length"]), []).append((r["bin_offset"], r["n_words"]))
    # There is one source, so every document is taken once.
    assert pieces == {key: sum(sizes) for key, sizes in want.items()}
    for (_, length), inside in bins.items():
        end = 0
        for offset, size in sorted(inside):
            assert offset >= end
            end = offset + size
        assert end <= length
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0, name


@pytest.mark.parametrize("key", ["op1_sharding", "op4_mixing", "op10_secret_scan"])
def test_native_queries_have_no_python(spark, key):
    frame_ = catalog.queries()[key](spark, "/root/testdata/sf0.001")
    plan = frame_._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin", plan)
