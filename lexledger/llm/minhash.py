"""MinHash near-duplicates with bottom-k sketches from one hash function.

1. A document's set is its distinct five-word shingles, hashed to 64 bits; its sketch is the K smallest hashes.
   Documents with equal sets form a class; only the class's smallest doc_id goes on.
2. Inverted lists of retained values. A linked pair shares most retained values, so it shares one among the few
   rarest of either document (prefix filtering); only those enter lists, and passages that very many documents
   hold make no long lists unless a document consists of them.
3. In each list every member is paired with the list's most typical member and with its neighbour. Lists whose
   members are then all in one component are finished: a group of n similar documents costs n pairs, not n squared.
   In the others all members are compared block by block by larger sketches, and pairs that may join two components
   go on, so no link that matters is lost.
4. Pairs pass an estimate from the sketch of the union, then the exact comparison of the full sets.

Sketches of sets that are larger than they are leave a chance (below 1e-7 for a linked pair in step 2, five and six
standard errors in steps 3 and 4) of missing a link; with exact=True the "sketches" are the full sets, and no step
can. No key is hot: values, lists and typical members that hold many rows are counted before the shuffle, and their
rows joined where they are or dealt to several groups (common.by_weight and common.attached).
"""

from __future__ import annotations

from functools import lru_cache
from math import comb, floor

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexledger.llm.common import attached, by_weight, components, row_hash, row_of, written

SHINGLE_WORDS = 5
K = 64
#: Linked: 100 * |intersection| >= percent * |union|; this is the percent where none is given.
PERCENT = 85
#: Size of the sketches by which the members of unfinished lists are compared, and members in a block of a list.
WIDE_K, BLOCK = 512, 512
#: Members of a heavy list that are ordered in one task to pair neighbours.
NEIGHBOURS = 1000
#: Rows that are held as Python objects at a time.
ROWS = 500


def shared_at_least(percent: int, k: int = K) -> int:
    """Retained values that two linked sets share at least if either is larger than its sketch: of the k smallest of
    the union each is shared with probability percent / 100 or more; fewer has a chance below 1e-7. 36 of 64 at 85."""
    p, chance = percent / 100, 0.0
    for shared in range(k + 1):
        chance += comb(k, shared) * p**shared * (1 - p) ** (k - shared)
        if chance >= 1e-7:
            return max(1, shared - 1)
    return k


def estimate_at_least(percent: int, k: int = K) -> float:
    """Estimated likeness below which a pair is not compared in full: six standard errors under the percent,
    rounded down. 0.58 at 85."""
    p = percent / 100
    return floor(100 * (p - 6 * (p * (1 - p) / k) ** 0.5)) / 100


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles of a text; lower case of A-Z, words between ASCII
    white space. Fewer words: all of them as one shingle. None: empty."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    starts = np.concatenate([[0], ends[: n - 1]]).tolist()
    stops = (ends[len(words) - n :] - 1).tolist()
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b]) for a, b in zip(starts, stops, strict=True)), np.uint64, n))


def in_slices(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def sketches(docs: DataFrame, key: str = "doc_id", k: int | None = K) -> DataFrame:
    """(id, n, set_hash, sketch): size, 128-bit digest and k smallest hashes (as bigint; None: all) of each document's
    set."""

    def run(batches):
        for batch in in_slices(batches):
            n, whole, low = [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text)
                n.append(len(s))
                whole.append(xxhash.xxh3_128_hexdigest(s.tobytes()))
                low.append(s[:k].view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(whole), pa.array(low, pa.list_(pa.int64()))], names=["id", "n", "set_hash", "sketch"])

    return docs.select(F.col(key).cast("long").alias("id"), "text").mapInArrow(run, "id long, n long, set_hash string, sketch array<long>")


def _retained(n: Column, k: int | None) -> Column:
    return n if k is None else F.least(n, F.lit(k))


def _prefix(n: Column, percent: int = PERCENT, k: int | None = K) -> Column:
    """How many of its rarest retained values a document enters into lists."""
    needed = F.ceil(n * percent / 100)
    if k is not None:
        needed = F.when(n * 100 <= percent * k, needed).otherwise(F.least(needed, F.lit(shared_at_least(percent, k))))
    return _retained(n, k) - needed + 1


def list_entries(sets: DataFrame, percent: int = PERCENT, k: int | None = K) -> DataFrame:
    """(v, id, n, weight): the retained values by which a document is looked up, of those that other documents
    retain as well. weight: how common the document's values are."""
    values = sets.select("id", "n", F.explode("sketch").alias("v"))
    counts = written(values.groupBy("v").agg(F.count("*").alias("c")).where("c > 1"), "value-counts")
    heavy, light = by_weight(values, counts, "v", "c", counts.agg(F.sum("c")).first()[0] or 0)
    own = Window.partitionBy("id")
    ranked = heavy.unionByName(light).select("*", F.row_number().over(own.orderBy("c", "v")).alias("r"), F.count("*").over(own).alias("m"), F.sum("c").over(own).alias("weight"))
    alone = _retained(F.col("n"), k) - F.col("m")  # values of this document only are its rarest
    return ranked.where(F.col("r") <= _prefix(F.col("n"), percent, k) - alone).select("v", "id", "n", "weight")


def _close_sizes(a: str, b: str, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def star_pairs(entries: DataFrame, total: int, percent: int = PERCENT) -> DataFrame:
    """(a, b), b the more typical: every list member with the list's most typical member and with its neighbour.
    Heavy lists are dealt to parts of about NEIGHBOURS members, in which neighbours are found."""
    typical = F.max(F.struct("weight", (-F.col("id")).alias("k"), F.col("n").alias("top_n"), F.col("id").alias("top")))
    lists = entries.groupBy("v").agg(F.count("*").alias("m"), typical.alias("t")).where("m > 1").select("v", "m", "t.top", "t.top_n")
    heavy, light = by_weight(entries, written(lists, "lists", total), "v", "m", total)
    heavy = heavy.withColumn("part", F.pmod(F.xxhash64("id"), F.ceil(F.col("m") / NEIGHBOURS)))
    found = []
    for part, keys in ((light, ["v"]), (heavy, ["v", "part"])):
        order = Window.partitionBy(*keys).orderBy(F.desc("weight"), "id")
        at = part.select("id", "n", "top", "top_n", F.lag("id").over(order).alias("next"), F.lag("n").over(order).alias("next_n"))
        other = F.explode(F.array(*[F.struct(F.col(c).alias("other"), F.col(f"{c}_n").alias("other_n")) for c in ("top", "next")]))
        both = at.select("id", "n", other.alias("o")).select("id", "n", "o.*")
        found.append(both.where(F.col("other").isNotNull() & (F.col("id") != F.col("other")) & _close_sizes("n", "other_n", percent)))
    return found[0].unionByName(found[1]).select(F.col("id").alias("a"), F.col("other").alias("b")).distinct()


def _products(values: list[np.ndarray], below: int | None = None) -> np.ndarray:
    """How many values each two rows share; with ``below``, of the values less than it."""
    row = np.repeat(np.arange(len(values)), [len(x) for x in values])
    flat = np.concatenate(values)
    if below is not None:
        row, flat = row[flat < below], flat[flat < below]
    unique, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    column = np.where(count > 1, np.cumsum(count > 1) - 1, -1)[column] if len(unique) else column
    row, column = row[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(values), len(values)), np.float32)
    for k in range(0, int(column[-1]) + 1 if len(column) else 0, 1024):
        a, b = np.searchsorted(column, [k, k + 1024])
        x = np.zeros((len(values), 1024), np.float32)
        x[row[a:b], column[a:b] - k] = 1
        both += x @ x.T
    return both


def _likely(percent: int, wide: int | None):
    """Of the members of two blocks of a list, the pairs of different components that may be linked: by exact
    overlap of sets that fit in their larger sketch, else by the least overlap of linked sketches, five standard
    errors under the mean. A pair that meets in several lists is named in that of the smallest value."""
    p = percent / 100
    least = 0 if wide is None else int(wide * p - 5 * (wide * p * (1 - p)) ** 0.5)

    def run(table: pa.Table) -> pa.Table:
        ids, n, component, block = (table.column(c).to_numpy() for c in ("id", "n", "component", "block"))
        both = _products([np.frombuffer(x, np.uint64) for x in table.column("low").to_pylist()])
        fits = (n <= (n.max() if wide is None else wide))[:, None]
        fits = fits & fits.T
        near = np.where(fits, (100 + percent) * both >= percent * (n[:, None] + n[None, :]), both >= least)
        near &= component[:, None] != component[None, :]
        if table.column("i")[0].as_py() != table.column("j")[0].as_py():
            near &= block[:, None] != block[None, :]
        if near.any():
            near &= _products([np.frombuffer(x, np.int64) for x in table.column("keys").to_pylist()], table.column("v")[0].as_py()) == 0
        a, b = np.nonzero(np.triu(near, 1))
        return pa.table({"a": np.minimum(ids[a], ids[b]), "b": np.maximum(ids[a], ids[b])})

    return run


def remaining_pairs(entries: DataFrame, total: int, joined: DataFrame, texts: DataFrame, percent: int = PERCENT, wide_k: int | None = WIDE_K) -> DataFrame:
    """(a, b): pairs in lists with several components that may link two of them.

    All pairs of such a list are looked at, but as a product of matrices inside a group: members are dealt to
    blocks of about BLOCK, each pair of blocks is a group, and only likely pairs become rows.
    """
    known = entries.join(joined.select(F.col("node").alias("id"), "component"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    known = written(known, "list-components", total)
    per = known.groupBy("v").agg(F.count("*").alias("members"), (F.min("component") != F.max("component")).alias("mixed")).where("mixed").drop("mixed")
    heavy, light = by_weight(known, written(per, "mixed", total), "v", "members", total)
    rows = written(heavy.unionByName(light), "mixed-lists", total)
    keyed = rows.groupBy("id").agg(F.collect_set("v").alias("keys"))  # at most a prefix of a sketch for each id

    def widened(batches):
        for batch in in_slices(batches):
            low = [shingle_set(t)[:wide_k].tobytes() for t in batch.column("text").to_pylist()]
            keys = [np.array(k, np.int64).tobytes() for k in batch.column("keys").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(low, pa.binary()), pa.array(keys, pa.binary())], names=["id", "low", "keys"])

    wide = written(texts.join(keyed, "id").select("id", "text", "keys").mapInArrow(widened, "id long, low binary, keys binary"), "wide-sketches")
    placed = rows.withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    to = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(F.col("block"), o).alias("i"), F.greatest(F.col("block"), o).alias("j")))
    spread = placed.select("v", "id", "n", "component", "block", F.explode(to).alias("p")).select("v", "id", "n", "component", "block", "p.i", "p.j")
    return spread.join(wide, "id").groupBy("v", "i", "j").applyInArrow(_likely(percent, wide_k), "a long, b long").distinct()


def estimated(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT, k: int = K) -> DataFrame:
    """The pairs (a written table) whose likeness, estimated from the sketch of the union, does not rule them out."""
    low, total = sets.select("id", "sketch"), pairs.count()
    with_a = attached(pairs, pairs, low.withColumnRenamed("sketch", "sa"), "a", "b", total)
    with_b = attached(pairs, with_a, low.withColumnRenamed("sketch", "sb"), "b", "a", total)
    union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, k)
    seen = with_b.select("a", "b", F.size(union).alias("u"), F.size(F.array_intersect(F.array_intersect(union, F.col("sa")), F.col("sb"))).alias("i"))
    return seen.where(F.col("i") >= F.col("u") * estimate_at_least(percent, k)).select("a", "b")


def verified(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b), a written table, whose full shingle sets are similar enough. texts: id, text."""
    total = pairs.count()
    with_a = attached(pairs, pairs, texts.withColumnRenamed("text", "ta"), "a", "b", total)
    with_b = attached(pairs, with_a, texts.withColumnRenamed("text", "tb"), "b", "a", total)

    def run(batches):
        of = lru_cache(maxsize=512)(shingle_set)  # a typical member comes in many pairs
        for batch in in_slices(batches):
            keep = []
            for ta, tb in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), strict=True):
                x, y = of(ta), of(tb)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return with_b.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", percent: int = PERCENT, exact: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, class_id, class_size): one row per document.

    Linked are documents that share ``percent`` of 100 of their shingles or more, of those in either.
    class_id: smallest id among documents with the same set; component_id: smallest id reachable over links;
    kept: doc_id = component_id. Null or blank text: no shingles, linked with nothing, kept. Ids must be integers;
    rows with equal ids are one node to links; null ids are linked with nothing.
    Other columns are not used. Empty table: no rows. exact: look documents up by their full sets, which costs more
    and leaves no chance of missing a link.
    """
    k, wide = (None, None) if exact else (K, WIDE_K)
    sets = written(sketches(docs, key, k), "sketches")
    documents = sets.count()
    filled = sets.where("n > 0 AND id IS NOT NULL")
    classes = written(filled.groupBy("set_hash").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size")), "classes", documents)
    # of each class the row with its smallest id
    heads = classes.select(F.col("class_id").alias("id"), F.col("set_hash"))
    reps = written(sets.join(heads, ["id", "set_hash"]).select("id", "n", "set_hash", "sketch"), "class-sets")
    entries = written(list_entries(reps, percent, k), "list-entries")
    total = entries.count()
    most = 2 * total
    # from here on only documents in lists matter: their texts and sketches are set aside once
    listed = entries.select("id").distinct()
    texts = written(docs.select(F.col(key).cast("long").alias("id"), "text").join(listed, "id"), "list-texts")
    first = written(star_pairs(entries, total, percent), "star-pairs", most)
    if not exact:
        first = written(estimated(first, written(reps.join(listed, "id"), "list-sets"), percent), "likely-pairs", most)
    links = written(verified(first, texts, percent), "links")
    second = written(remaining_pairs(entries, total, components(links), texts, percent, wide), "more-pairs", most)
    if not second.isEmpty():
        links = links.unionByName(verified(second, texts, percent))
    joined = components(links)
    found = sets.select("id", "n", F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("set_hash")).alias("set_hash")).join(classes, "set_hash", "left")
    found = found.select("id", "n", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("class_size", F.lit(1)).alias("class_size"))
    found = found.join(joined.select(F.col("node").alias("class_id"), "component"), "class_id", "left").withColumn("component_id", F.coalesce("component", "class_id"))
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", (F.coalesce(F.col("id"), F.lit(-1)) == F.coalesce("component_id", F.lit(-1))).alias("kept"), "class_id", "class_size")


def without_near_duplicates(docs: DataFrame, key: str = "doc_id", percent: int = PERCENT, exact: bool = False) -> DataFrame:
    """docs with one document of each near-duplicate component: the one with the smallest id.

    Of rows that repeat both id and text one stays: the one whose columns hash smallest. Rows without an id are
    linked with nothing and stay. Any further columns are carried along as they are, whatever their names.
    """
    ids = near_duplicates(docs, key, percent, exact).where("kept").select(F.col("doc_id").alias("id")).distinct()
    rows = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64("text").alias("same"), row_hash(docs).alias("at"), row_of(docs).alias("row"))
    order = Window.partitionBy("id", "same").orderBy("at")
    once = rows.join(ids, "id", "left_semi").withColumn("place", F.row_number().over(order)).where("place = 1")
    return once.select("row").unionByName(rows.where("id IS NULL").select("row")).select("row.*")
