"""Benchmark passages in texts, against a plain search."""

import hashlib
import random
import re

import pytest

from sparkloom.llm import decontaminate

DOCS = "doc_id long, text string, lang string, item string, size string, hash string"


def tokens(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def plain(docs, items, n=10):
    windows = {}
    for item, text in items:
        found = tokens(text)
        size = min(n, len(found))
        for i in range(len(found) - size + 1 if size else 0):
            windows.setdefault(tuple(found[i : i + size]), set()).add(item)
    out = []
    for key, text in docs:
        found, hit, named = tokens(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(found) - size + 1):
                of = windows.get(tuple(found[i : i + size]))
                if of:
                    hit |= set(range(i, i + size))
                    named |= of
        names = sorted(str(i) for i in named if i is not None)
        out.append((key, len(found), len(hit), names))
    return out


def cases():
    draw = random.Random(11)
    pool = [f"w{i}" for i in range(60)] + ["é", "日本語", "naïve", "x1"]
    items = [(i, " ".join(draw.choices(pool, k=draw.choice([1, 2, 9, 10, 11, 40])))) for i in range(25)]
    items += [(3, "one more text"), (90, None), (91, ""), (92, " .,"), (93, "A B"), (None, "no name here")]
    items += [(94, items[0][1])]
    docs = [(0, None), (1, ""), (2, " \n!"), (3, "a-b"), (3, "a-b"), (None, "A, b"), (4, "no NAME here")]
    for i in range(60):
        words = draw.choices(pool, k=draw.choice([3, 30, 200]))
        for _ in range(draw.choice([0, 1, 3])):
            at = draw.randrange(len(words) + 1)
            words[at:at] = tokens(draw.choice(items)[1])
        sign = draw.choice([" ", ", ", "--", "\x85 ", "_"])
        docs.append((10 + i, sign.join(w.upper() if draw.random() < 0.2 else w for w in words)))
    passage = tokens(max((t or "" for _, t in items), key=len))
    docs.append((200, " ".join(pool * 4000 + passage + pool * 10)))
    return docs, items


@pytest.mark.parametrize("most", [decontaminate.BROADCAST, 0])
def test_against_a_plain_search(spark, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "BROADCAST", most)
    docs, items = cases()
    frame = spark.createDataFrame([(k, t, "en", "x", "y", "z") for k, t in docs], DOCS)
    bench = spark.createDataFrame([(k, t, "q") for k, t in items], "item_id long, text string, id string")
    got = [tuple(r) for r in decontaminate.overlaps(frame.repartition(3), bench).collect()]
    key = lambda r: (str(r[0]), *r[1:])
    assert sorted(got, key=key) == sorted(plain(docs, items), key=key)
    row = decontaminate.digests(decontaminate.overlaps(frame, bench)).where("doc_id = 1").first()
    assert tuple(row) == (1, 0, 0, 0, hashlib.sha256(b"").hexdigest(), False)


@pytest.mark.parametrize("most", [decontaminate.BROADCAST, 0])
def test_empty_tables(spark, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "BROADCAST", most)
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.overlaps(docs.limit(0), bench).collect() == []
    assert [tuple(r) for r in decontaminate.overlaps(docs, bench.limit(0)).collect()] == [(1, 3, 0, [])]


def test_passages_and_documents_go(spark):
    item = "One two three four five six seven eight nine ten eleven"
    texts = [f"Before, {item.upper()}! After.", "clean text", None, item, f"x {item} y {item} z"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    left = {r["doc_id"]: r["text"] for r in decontaminate.without_passages(docs, bench).collect()}
    assert left == {0: "Before, ! After.", 1: "clean text", 2: None, 3: "", 4: "x  y  z"}
    kept = decontaminate.clean_documents(docs, bench)
    assert {r["doc_id"] for r in kept.collect()} == {1, 2}
    kept = decontaminate.clean_documents(docs, bench, most=0.9)
    assert {r["doc_id"] for r in kept.collect()} == {0, 1, 2, 4}
