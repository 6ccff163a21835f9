"""The audit of filters, against plain counting in every order."""

import random
import re
from collections import Counter
from itertools import permutations

import pytest

from sparkloom.llm import filter_audit
from sparkloom.scratch import Scratch

DOCS = "doc_id long, text string, lang string, mask string, part string, prefix string"


def failures(docs):
    out = []
    for key, text, lang in docs:
        text = text or ""
        found = re.findall(r"[^\x20\x09-\x0D]+", text)
        smaller = key is not None and any(
            k is not None and k < key and (t or "") == text for k, t, _ in docs
        )
        fails = {
            "A": len(found) < 200,
            "B": 100 * len(set(found)) < 50 * len(found),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": smaller,
        }
        out.append((key, lang or "", {f for f, x in fails.items() if x}))
    return out


def plain(docs, labels):
    rows = failures(docs)
    labels = [x for x in labels if x[0] is not None]
    good = {k for k, q, _ in labels if q == 1}
    toxic = {k for k, _, t in labels if t == 1}
    out, worth = {}, Counter()
    for order in permutations("ABCDE"):
        left = {part: [r for r in rows if r[1] == part] for part in {r[1] for r in rows}}
        for step, f in enumerate(order):
            for part, here in left.items():
                gone = [r for r in here if f in r[2]]
                failing = sum(f in r[2] for r in rows if r[1] == part)
                left[part] = [r for r in here if f not in r[2]]
                worth[part, f] += len(gone)
                out[part, "".join(order), step + 1] = [
                    len(left[part]), len(gone), failing - len(gone),
                    sum(r[2] == {f} for r in rows if r[1] == part),
                    sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone),
                ]
    return {k: (*v, worth[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def cases():
    draw = random.Random(12)
    pool = ["alpha", "Beta", "gamma", "x#", "é日", "delta", "GOOD", "plain"]
    pool += [f"w{i}" for i in range(400)]
    texts = [None, "", "", " \n", "a", "a", "a ", "A", "ab", "a" * 3000, "a" * 3000, "a" * 2999 + "b"]
    for _ in range(40):
        words = draw.choices(pool[: draw.choice([8, 408])], k=draw.choice([5, 199, 200, 600]))
        texts.append(draw.choice([" ", "\t", "  "]).join(words))
    texts += draw.choices(texts, k=40) + ["same start " * 50 + t for t in ("x", "y", "x")]
    texts.append(" ".join(pool * 3000))
    ids = [*range(len(texts) - 6), None, None, 3, 3, 5, -1]
    langs = [draw.choice(["en", "de", None, "", "fr"]) for _ in texts]
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1])) for i in range(0, len(texts), 2)]
    labels += [(4, 1, 0), (None, 1, 1), (9999, 1, 1)]
    return list(zip(ids, texts, langs, strict=True)), labels


@pytest.mark.parametrize("part_bytes", [filter_audit.PART_BYTES, 200])
def test_against_plain_counting(spark, part_bytes):
    docs, labels = cases()
    frame = spark.createDataFrame([(*d, "m", "p", "q") for d in docs], DOCS).repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    marked = filter_audit.flagged(frame, part_bytes=part_bytes)
    bits = {f: 1 << i for i, f in enumerate("ABCDE")}
    got = Counter(tuple(r) for r in marked.collect())
    assert got == Counter((k, p, sum(bits[f] for f in fails)) for k, p, fails in failures(docs))
    found = filter_audit.audit(marked, marks).collect()
    assert {(r[0], r[1], r[2]): tuple(r)[3:] for r in found} == plain(docs, labels)
    assert len(found) == 600 * len({r["part"] for r in found})


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.flagged(empty), labels).collect() == []
    one = spark.createDataFrame([(1, "a", "en")], empty.schema)
    assert filter_audit.audit(filter_audit.flagged(one), labels).count() == 600


def test_prefixes_gather_few_bytes(spark):
    draw = random.Random(3)
    texts = ["shared start of many texts " + "".join(draw.choices("abc", k=60)) for _ in range(400)]
    texts += ["".join(draw.choices("abcdefgh", k=50)) for _ in range(200)] + ["one text " * 200] * 20
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "copies long, text string")
    rows = filter_audit._prefixed(frame, 1000, Scratch(spark, "t")).collect()
    assert sorted(r["copies"] for r in rows) == list(range(len(texts)))
    weight = Counter()
    for r in rows:
        assert r["text"].startswith(r["prefix"])
        weight[r["prefix"]] += len(r["text"]) if len(set(t for t in texts if t.startswith(r["prefix"]))) > 1 else 0
    assert max(weight.values()) <= 1000


def test_trie():
    draw = random.Random(5)
    texts = ["".join(draw.choices("ab", k=draw.randrange(12))).encode() for _ in range(500)]
    trie, least = filter_audit._Trie(), {}
    nodes = [trie.put(t, key) for key, t in enumerate(reversed(texts))]
    for key, t in enumerate(reversed(texts)):
        least.setdefault(t, key)
    assert [trie.least[n] for n in nodes] == [least[t] for t in reversed(texts)]
    assert len({*nodes}) == len(least)
