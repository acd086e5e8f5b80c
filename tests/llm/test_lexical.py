import math
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lexledger.llm import lexical

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return PATTERN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=50):
    counted = [(i, Counter(words(t))) for i, t in docs if words(t)]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked, out = {}, {}
    for i, t in items:
        asked.setdefault(i, set()).update(words(t))
    for item, terms in asked.items():
        scored = []
        for i, c in counted:
            m = 50 + 50 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        if scored:
            out[item] = [(None if none else i, -s) for s, none, i in sorted(scored)[:top]]
    return out


def found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        out.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r["rank"] == len(out[r.item_id])
    return out


def corpus():
    rng = np.random.default_rng(4)
    names = [f"w{k}" for k in range(400)] + ["É", "日本", "naïve"]
    odds = 1 / np.arange(1, len(names) + 1)
    text = lambda n: " ".join(rng.choice(names, n, p=odds / odds.sum()))
    docs = [(int(k), text(int(rng.integers(1, 80))).replace("w1 ", "W1-")) for k in rng.permutation(900)]
    docs += [(2000 + k, docs[0][1]) for k in range(120)] + [(5, "w300 w301"), (5, "w300 w301"), (None, "w300 w302 w303"), (None, None), (3000, ""), (3001, " .,! "), (3002, "w9 " * 20_000)]
    items = [(k, text(25)) for k in range(30)] + [(1, "w300 w303"), (None, "w300 É"), (77, None), (78, "not-there"), (79, "w300"), (80, docs[0][1])]
    return docs, items


def test_equals_brute_force(spark):
    docs, items = corpus()
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, score int").repartition(3)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    for most in (300, lexical.SHARD_POSTINGS):  # many small shards, and one for each task
        assert found(lexical.search(lexical.index(df, shard_postings=most), asked).collect()) == brute(docs, items)


def test_passes_give_the_same(spark, monkeypatch):
    docs, items = corpus()
    shards = lexical.index(spark.createDataFrame(docs, "doc_id long, text string"))
    asked = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(lexical, "PASS_ITEMS", 11)
    assert found(lexical.search(shards, asked, top=5).collect()) == brute(docs, items, 5)


def test_empty_tables(spark):
    none, some = (spark.createDataFrame(r, "doc_id long, text string") for r in ([], [(1, "a b")]))
    asked = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(lexical.index(none), asked).count() == 0
    assert lexical.search(lexical.index(some), asked.limit(0)).count() == 0
    assert found(lexical.search(lexical.index(some), asked).collect()) == brute([(1, "a b")], [(1, "a")])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**55), max_size=50))
def test_packing_round_trip(values):
    raw, ends = lexical.packed(np.array(values, np.int64))
    assert lexical.unpacked(raw).tolist() == values and len(ends) == len(values)


def test_long_texts_are_read_in_pieces(monkeypatch):
    text = ("Ab" * 50 + " é9 ").encode() * 300
    whole = lexical.term_counts(text)
    monkeypatch.setattr(lexical, "_PIECE", 64)
    assert lexical.term_counts(text) == whole == Counter({b"ab" * 50: 300, "é9".encode(): 300})
