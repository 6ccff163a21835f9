"""Spelling variants, against a plain comparison of all words."""

import random
import re
import zlib
from collections import Counter

import pytest

from sparkloom.llm import spelling

DOCS = "doc_id long, text string, word string, n string, short string"


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(docs, slips):
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if slips and h % slips == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    vocab = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in vocab if one_edit(w, v)] for w in vocab}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-vocab[v], v), default=None)
        form[w] = best if best and vocab[best] >= 5 * vocab[w] else None
    out = set()
    for w in vocab:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, vocab[w], len(near[w]), form[w] and vocab[form[w]]))
    return out


def edited(draw, word):
    at = draw.randrange(len(word))
    other = draw.choice("abéÿ")
    return draw.choice([word[:at] + word[at + 1 :], word[:at] + other + word[at:], word[:at] + other + word[at + 1 :]])


def cases():
    draw = random.Random(13)
    base = ["".join(draw.choices("abéñ", k=draw.randrange(6, 12))) for _ in range(25)]
    base += ["aaaaaa", "aaaaaaa", "abababab", "babababa", "long" * 40, "Straße", "ÀÉÎõüß"]
    found = set(base)
    for word in base:
        found |= {edited(draw, word) for _ in range(4)} | {edited(draw, edited(draw, word))}
    counts = {w: draw.choice([1, 4, 5, 6, 25, 30, 150]) for w in sorted(found)}
    words = [w.upper() if w.isascii() and draw.random() < 0.1 else w for w, n in counts.items() for _ in range(n)]
    draw.shuffle(words)
    docs = [(0, None), (1, ""), (2, " 123 _"), (3, "short"), (None, "thirteen×fourteen÷thirteen")] + [(4, "thirteen")] * 5
    sizes = [1, 10, 400, 5000]
    while words:
        size = draw.choice(sizes)
        docs.append((len(docs), draw.choice([" ", "-", "1", "×"]).join(words[:size])))
        words = words[size:]
    return docs


@pytest.mark.parametrize("block,packed,cells,slips", [(50_000, 2048, 1 << 18, 7), (4, 5, 2, None), (30, 64, 1, 199)])
def test_against_a_plain_comparison(spark, monkeypatch, block, packed, cells, slips):
    monkeypatch.setattr(spelling, "PACKED", packed)
    monkeypatch.setattr(spelling, "CELLS", cells)
    docs = cases()
    frame = spark.createDataFrame([(*d, "w", "n", "s") for d in docs], DOCS).repartition(3)
    got = [tuple(r) for r in spelling.variants(frame, slips=slips, block=block).collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain(docs, slips)


def test_chains_and_ties(spark):
    counts = {"abcdef": 5, "abcdeg": 25, "abcdeh": 25, "abcdxg": 125, "zzzzzz": 5, "abydxg": 625}
    docs = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(counts.items())]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["word"]: tuple(r)[1:] for r in spelling.variants(frame).collect()}
    assert got["abcdef"] == ("abcdeg", "abydxg", 5, 2, 25)
    assert got["abcdeg"] == ("abcdxg", "abydxg", 25, 3, 125)
    assert got["abcdeh"] == (None, "abcdeh", 25, 2, None)
    assert got["zzzzzz"] == (None, "zzzzzz", 5, 0, None)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(empty).collect() == []


def test_one_large_block(spark):
    draw = random.Random(2)
    words = {"common" + "".join(draw.choices("abcdefgh", k=4)) for _ in range(1500)}
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    for block in (50_000, 20):
        got = {(r["word"], r["near"]) for r in spelling.near_words(frame, block=block).collect()}
        assert got == {(a, b) for a in words for b in words if one_edit(a, b)}
