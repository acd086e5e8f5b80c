import random
import re

from lexledger.llm import common, minhash


def brute(rows):
    """Components by comparing all pairs of sets of word tuples."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                comp[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[root(i)] = min(d, low.get(root(i), d))
    return {d: (len(sets[i]), low[root(i)], d == low[root(i)]) for i, (d, _) in enumerate(rows)}


def edited(words, rng, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        words[at : at + rng.randrange(2)] = [f"x{rng.randrange(10**6)}"]
    return words


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for _ in range(25):
        base = [word() for _ in range(rng.choice([3, 6, 8, 12, 30, 80, 200, 400]))]
        texts += [" ".join(edited(base, rng, rng.randrange(4))) for _ in range(rng.choice([1, 2, 3, 8]))]
    for _ in range(15):  # unlike documents that share a passage
        texts.append(" ".join([word() for _ in range(rng.choice([10, 40]))] + passage))
    family = [word() for _ in range(150)]
    texts += [" ".join(edited(family, rng, rng.randrange(7))) for _ in range(40)]
    texts += [texts[0], texts[0].upper(), texts[1] + "\n ", "", " \t\n", None, "one", "ONE", "zwei drei", "é É"]
    ids = rng.sample(range(10_000), len(texts))
    return list(zip(ids, texts, strict=True))


def test_components_equal_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        df = spark.createDataFrame([(d, t, "src") for d, t in rows], "doc_id long, text string, kept string").repartition(3)
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()}
        assert got == brute(rows)
        exact = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df, exact=True).collect()}
        assert exact == got


def test_heavy_keys_are_dealt(spark, monkeypatch):
    """Every value, list and typical member counts as heavy: the same components."""
    monkeypatch.setattr(common, "HEAVY_KEYS", 1 << 40)
    monkeypatch.setattr(common, "KEY_ROWS", 1)
    monkeypatch.setattr(minhash, "NEIGHBOURS", 3)
    rows = corpus(3)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_clashing_columns_and_repeated_rows_stay(spark):
    words = " ".join(f"w{k}" for k in range(30))
    rows = [(1, words, "b", {"k": 1}), (1, words, "a", {"k": 2}), (2, words + " x", "c", None), (None, words, "d", None), (3, None, "e", None)]
    names = ("_h", "id", "row", "same", "place", "component_id", "kept", "n")
    df = spark.createDataFrame([(d, t, *[x] * len(names), m) for d, t, x, m in rows], f"doc_id int, text string, {', '.join(f'{c} string' for c in names)}, more map<string,int>")
    got = minhash.without_near_duplicates(df)
    assert got.schema == df.schema
    out = got.collect()
    assert sorted((r.doc_id or 0, *[r[c] for c in names]) for r in out if r.doc_id != 1) == [(0, *"d" * len(names)), (3, *"e" * len(names))]
    assert [r._h for r in out if r.doc_id == 1] in (["a"], ["b"])
    assert [tuple(r) for r in minhash.without_near_duplicates(df.repartition(3)).collect() if r.doc_id == 1] == [tuple(r) for r in out if r.doc_id == 1]


def near_copies(seed=7):
    """Rows of pairs whose likeness runs from 0.7 to 0.95, and the pairs' likeness."""
    rng = random.Random(seed)
    rows = []
    for k in range(60):
        words = [f"d{k}w{i}" for i in range(rng.choice([30, 60, 150, 400]))]
        other = list(words)
        for at in rng.sample(range(len(words)), max(1, len(words) * rng.randrange(1, 5) // 100)):
            other[at] = f"x{k}y{at}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    return rows


def likeness(a, b):
    x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.split(), b.split()))
    return len(x & y) / len(x | y)


def test_percent_is_kept_at_80_and_85(spark):
    rows = near_copies()
    alike = {rows[i][0]: likeness(rows[i][1], rows[i + 1][1]) for i in range(0, len(rows), 2)}
    assert sum(0.8 <= x < 0.85 for x in alike.values()) >= 3 and sum(x < 0.8 for x in alike.values()) >= 3
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (80, 85):
        got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, percent=percent).collect()}
        assert {d for d in alike if got[d + 1] == d} == {d for d, x in alike.items() if 100 * x >= percent - 1e-9}
    assert (minhash.shared_at_least(85), minhash.estimate_at_least(85)) == (36, 0.58)


def test_empty_table_and_repeated_rows(spark):
    schema = "doc_id long, text string"
    assert minhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "a b c d e f")] * 3 + [(2, "a b c d e f"), (None, "a b c d e f"), (None, None)]
    got = [(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, schema)).collect()]
    assert sorted(got, key=str) == sorted([(1, 1, True)] * 3 + [(2, 1, False)] + [(None, None, True)] * 2, key=str)


def test_very_long_text(spark):
    words = [f"w{i}" for i in range(60_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:59_000])), (3, " ".join(words[:40_000]))]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_list_entries_of_boilerplate_documents_stay_rare(spark):
    """Documents that share a passage but nothing else don't meet in lists."""
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, " ".join(f"d{i}x{j}" for j in range(200)) + " " + passage) for i in range(50)]
    sets = minhash.sketches(spark.createDataFrame(rows, "doc_id long, text string"))
    assert minhash.list_entries(sets).count() == 0
