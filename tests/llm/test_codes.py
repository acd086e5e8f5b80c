import hashlib

import numpy as np
import pytest

from lexledger.llm import codes


def brute(rows, parts=4, entries=256):
    """Product codes one distance at a time, in Python's whole numbers."""
    kept = [(i, lab, [int(np.floor(1024 * x)) for x in v]) for i, lab, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    w = len(kept[0][2]) // parts
    cut = [[v[p * w : (p + 1) * w] for p in range(parts)] for _, _, v in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))
    for _ in range(4):
        for p in range(parts):
            given = {}
            for c in cut:
                given.setdefault(near(c[p], books[p])[1], []).append(c[p])
            books[p] = [[sum(x) // len(given[k]) for x in zip(*given[k], strict=True)] if k in given else e for k, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, per = [], {}
    for (i, lab, _), c in zip(kept, cut, strict=True):
        found = [near(c[p], books[p]) for p in range(parts)]
        out.append((i, lab, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
        per[lab] = per.get(lab, 0) + out[-1][3]
    return sorted((str(i), code, e, per[lab], digest) for i, lab, code, e in out)


def test_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(k, int(rng.integers(0, 3)) if k % 9 else None, np.round(rng.standard_normal(8), 1).astype(np.float32).tolist()) for k in range(0, 700, 2)]
    rows += [(k, 1, rows[0][2]) for k in range(1, 60, 2)] + [(5, 2, rows[3][2])] * 3 + [(None, 1, [0.25] * 8), (900, 2, None), (901, 1, [float("nan")] * 8), (902, 0, [None] + [1.0] * 7), (903, 0, [float("inf")] * 8), (904, 0, [-0.0001] * 8)]
    df = spark.createDataFrame([(a, b, c, "x") for a, b, c in rows], "vec_id long, label int, embedding array<float>, code string").repartition(5)
    got = sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in codes.compress(df).collect())
    assert got == brute(rows)


@pytest.mark.parametrize("spread", [1, 50, 3000, 40_000_000])
def test_screening_finds_the_nearest_entry(spread):
    """Small values make ties, large ones rounding errors."""
    rng = np.random.default_rng(spread)
    x, e = rng.integers(-spread, spread + 1, (3000, 16)), rng.integers(-spread, spread + 1, (256, 16))
    e[100:110] = e[:10]
    if spread > 3000:  # nearly equal entries far from the origin
        e[20:60] = e[20] + rng.integers(0, 2, (40, 16))
        x[:1000] = e[20] + rng.integers(-3, 3, (1000, 16))
    index, distance = codes.nearest(x, e)
    for k in range(0, 3000, 7):
        d = ((x[k] - e) ** 2).sum(1)
        assert (index[k], distance[k]) == (int(d.argmin()), int(d.min()))


def test_other_lengths_and_empty_tables(spark):
    schema = "vec_id long, label string, embedding array<double>"
    rows = [(1, "a", [1.0] * 4), (2, "a", [2.0] * 4), (3, "a", [1.0] * 3), (4, "a", [])]
    got = {r.vec_id: (r.code, r.error, r.label_error) for r in codes.compress(spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: ("00000000", 0, 0), 2: ("01010101", 0, 0), 3: (None, None, 0), 4: (None, None, 0)}
    assert codes.compress(spark.createDataFrame([], schema)).count() == 0
    assert [r.code for r in codes.compress(spark.createDataFrame([(1, None, [1.0] * 6)], schema)).collect()] == [None]
    with pytest.raises(Exception, match="65536"):
        codes.compress(spark.createDataFrame([(1, None, [70000.0] * 4)], schema)).collect()
    with pytest.raises(TypeError):
        codes.compress(spark.createDataFrame([(1, "a", "b")], "vec_id long, label string, embedding string"))
