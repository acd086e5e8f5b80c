import hashlib
import random
from collections import Counter

import numpy as np

from lexledger.llm import suffixes


def brute(rows):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    out = []
    for (d, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = int(np.sum(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        out.append((d, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    letters = "abcdefghij klmnopé"
    make = lambda n: "".join(rng.choice(letters) for _ in range(n))
    texts = [make(rng.choice([0, 10, 150, 199, 200, 500, 1500])) for _ in range(25)]
    shared = [make(n) for n in (199, 200, 201, 260, 420, 800)]
    for _ in range(30):
        texts.append(make(rng.randrange(120)).join(rng.sample(shared, 2)))
    for _ in range(10):  # cuts at every residue
        s = rng.choice(shared)
        a = rng.randrange(len(s) - 100)
        texts.append(make(rng.randrange(90)) + s[a:] + make(50))
    morse = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    texts += [morse[:256], morse[256:512], morse, "ab" * 40 + morse[100:420], "aab" * 200, "aab" * 90 + "b" + "aab" * 90]
    texts += ["ab" * 300, "x" * 199, "y" * 200, "z" * 201, make(30) * 20, None, ""]
    texts += texts[:12] + [texts[3]] * 3
    return list(zip(range(len(texts)), texts, strict=True))


def test_cover_is_a_difference_cover():
    assert {(a - b) % suffixes.V for a in suffixes.D for b in suffixes.D} == set(range(suffixes.V))


def test_removed_bytes_equal_brute_force(spark, monkeypatch):
    for seed, size in ((1, 1 << 20), (2, 4000)):
        monkeypatch.setattr(suffixes, "BLOCK_BYTES", size)
        monkeypatch.setattr(suffixes, "BLOCK_BYTES_MOST", size)
        rows = corpus(seed)
        df = spark.createDataFrame([(d, t, "src") for d, t in rows], "doc_id long, text string, n_bytes string").repartition(3)
        got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.repeated_bytes(df).collect()]
        assert sorted(got, key=str) == brute(rows)


def test_segments_and_long_texts(spark):
    rng = random.Random(4)
    long = "".join(rng.choice("abcdefgh") for _ in range(1_300_000))
    rows = [(1, long), (2, "head " + long[524_000:525_000] + " tail"), (3, None)]
    got = {r.doc_id: (r.n_removed, [tuple(s) for s in r.spans]) for r in suffixes.repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1000, [(524_000, 525_000)]), 2: (1000, [(5, 1005)]), 3: (0, [])}


def test_kept_text_and_other_columns(spark):
    rows = [(1, "a" + "é" * 150 + "b", None), (2, "é" * 150 + "c", "x"), (None, "short", "y")]
    got = {r.doc_id: (r.text, r.lang) for r in suffixes.repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string, lang string"), with_text=True).collect()}
    assert got == {1: ("ab", None), 2: ("c", "x"), None: ("short", "y")}


def test_empty_table(spark):
    assert suffixes.repeated_bytes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


class Weak(suffixes.Hasher):
    """Keys of two bits: different strings have equal keys."""

    def at(self, buf, positions, length):
        return super().at(buf, positions, length) & np.uint64(3)


def test_equal_keys_of_different_strings_are_found_out():
    import pyarrow as pa

    def block(texts, hasher, notes=()):
        sink = pa.BufferOutputStream()
        table = pa.table({"text": pa.array(texts)})
        with pa.ipc.new_stream(sink, table.schema) as w:
            w.write_table(table)
        parts = pa.table({"block": pa.array([0], pa.int32()), "part": ["p"], "packed": pa.array([sink.getvalue().to_pybytes()], pa.binary())})
        side = pa.concat_tables([suffixes._note(kind, [0], [data]) for kind, data in notes]) if notes else suffixes._note("copy", [], [])
        return suffixes.Block(parts, side, hasher)

    rng = random.Random(8)
    make = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    shared, other = make(300), make(300)
    spans = lambda n: suffixes.packed(np.array([[0, n - 199]], np.int64))
    sent = lambda t: suffixes.packed(np.concatenate([np.array([1, len(t)], np.int32).view(np.uint8), np.frombuffer(t.encode(), np.uint8)]))
    sound, weak = suffixes.Hasher(1), Weak(1)
    assert block([shared], sound, [("repeated", spans(300)), ("sent", sent(shared))]).confirmed()
    assert block([shared + shared], sound, [("repeated", suffixes.packed(np.array([[0, 101], [300, 401]], np.int64)))]).confirmed()
    assert not block([shared], weak, [("repeated", spans(300))]).confirmed()
    assert not block([shared], sound, [("repeated", spans(300)), ("sent", sent(other))]).confirmed()
    assert not block([shared + "x"], sound, [("repeated", spans(300)), ("sent", sent(shared[1:] + "x"))]).confirmed()


def test_many_copies_and_repeated_rows(spark):
    rows = [(k % 7, "same text, " * 40) for k in range(500)] + [(None, "same text, " * 40), (None, None), (None, None)]
    got = suffixes.repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert len(got) == 503
    assert all(r.n_removed == r.n_bytes for r in got)
