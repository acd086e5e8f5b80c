"""Ranked lexical search over an inverted index.

Documents become shards: runs of an input partition with at most SHARD_POSTINGS postings, each a row of the index with
its documents in the order of doc_id, its sorted terms, and for every term the compressed list of its documents and
counts in that order. A search walks a shard document by document: a heap holds one cursor for each of an item's lists,
the smallest document is scored from all lists that are at it, and a bounded heap keeps the best by score, then doc_id.
Lists whose best possible sum can't reach the worst of a full heap leave the cursor heap and are only looked up. The
shards' results are merged at last. No posting is shuffled, so a frequent term is no hot group.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexledger.llm.common import partitions, written

#: A term: ASCII letters and digits, and everything outside ASCII; on UTF-8 bytes.
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_STOP = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
TOP = 50
#: Postings of a shard, but for a single document that has more: a few bytes each.
SHARD_POSTINGS = 500_000
#: Items, and bytes of their texts, that are searched for in one pass over the index (a single longer one by itself).
PASS_ITEMS, PASS_BYTES = 2000, 4_000_000
_PIECE = 1 << 22
#: Stands for a null doc_id: the last of all.
_NO_ID = (1 << 63) - 1
_INDEX = "docs long, terms_read long, ids binary, lengths binary, terms binary, dfs binary, ends binary, postings binary"


def term_counts(text: bytes) -> Counter:
    """Occurrences of each term, lower-cased in ASCII only; a long text is read piece by piece."""
    found, a = Counter(), 0
    while a < len(text):
        cut = _STOP.search(text, a + _PIECE) if len(text) - a > _PIECE else None
        b = cut.start() if cut else len(text)
        found.update(TERM.findall(text[a:b].lower()))
        a = b
    return found


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in seven bits a byte, the low ones first, and the end of each in the bytes."""
    v = values.astype(np.uint64)
    size = np.ones(len(v), np.int64)
    for k in range(1, 9):
        size += v >= np.uint64(1 << (7 * k))
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(int(size.max()) if len(v) else 0):
        at = size > k
        more = (size[at] > k + 1).astype(np.uint8) << 7
        out[(ends - size)[at] + k] = ((v[at] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8) | more
    return out, ends


def unpacked(raw: np.ndarray) -> np.ndarray:
    """The numbers of packed() bytes."""
    last = np.nonzero(raw < 128)[0]
    starts = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    place = np.arange(len(raw)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(raw)]])))
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), starts) if len(starts) else np.zeros(0, np.int64)


class _Writer:
    """Gathers documents of one task until a shard is full."""

    def __init__(self):
        self.vocabulary: dict[bytes, int] = {}
        self.ids, self.lengths, self.distinct, self.terms, self.counts = [], [], [], [], []

    def add(self, doc_id: int | None, found: Counter) -> None:
        known = self.vocabulary
        self.ids.append(_NO_ID if doc_id is None else doc_id)
        self.lengths.append(sum(found.values()))
        self.distinct.append(len(found))
        self.terms += [known.setdefault(t, len(known)) for t in found]
        self.counts += found.values()

    def shard(self) -> list:
        ids, lengths = np.array(self.ids, np.int64), np.array(self.lengths, np.int64)
        by_id = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[by_id] = np.arange(len(ids))
        names = sorted(self.vocabulary)
        rank = np.empty(len(names), np.int64)
        rank[[self.vocabulary[t] for t in names]] = np.arange(len(names))
        term, doc, count = rank[self.terms], np.repeat(place, self.distinct), np.array(self.counts, np.int64)
        order = np.argsort(term * len(ids) + doc)
        term, doc, count = term[order], doc[order], count[order]
        dfs = np.bincount(term, minlength=len(names))
        step = np.diff(doc, prepend=0)
        firsts = np.cumsum(dfs) - dfs
        step[firsts] = doc[firsts]
        raw, ends = packed(np.stack([step, count], 1).ravel())  # of each posting the step to its document and the count
        stops = ends[2 * np.cumsum(dfs) - 1]
        plain = lambda x: x.astype("<i8").tobytes()
        return [len(ids), int(lengths.sum()), plain(ids[by_id]), plain(lengths[by_id]), b"\n".join(names), plain(dfs), plain(stops), raw.tobytes()]


def _shards(batches, most: int):
    names = [f.split()[0] for f in _INDEX.split(", ")]

    def emit(w):
        return pa.RecordBatch.from_arrays([pa.array([v], pa.binary() if isinstance(v, bytes) else pa.int64()) for v in w.shard()], names=names)

    w = _Writer()
    for batch in batches:
        for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
            found = term_counts(text.as_buffer().to_pybytes()) if text.is_valid else None
            if not found:
                continue
            if w.terms and len(w.terms) + len(found) > most:
                yield emit(w)
                w = _Writer()
            w.add(doc_id, found)
    if w.terms:
        yield emit(w)


def index(docs: DataFrame, key: str = "doc_id", column: str = "text", shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """The index of all documents, written: a row for each shard.

    Documents without a term (null and empty texts too) are not in it. Rows with equal ids are documents of their own;
    ids must be whole numbers (an error otherwise), null ids come last. Other columns are not used. Empty table: no rows.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(column).alias("text"))
    return written(rows.mapInArrow(lambda batches: _shards(batches, shard_postings), _INDEX), "lexical-index")


class _Shard:
    """A row of the index, opened."""

    def __init__(self, row: dict):
        read = lambda c: np.frombuffer(row[c], "<i8")
        self.ids, self.lengths, self.dfs, self.ends = read("ids"), read("lengths"), read("dfs"), read("ends")
        self.place = {t: k for k, t in enumerate(row["terms"].split(b"\n"))}
        self.raw = np.frombuffer(row["postings"], np.uint8)

    def postings(self, term: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """(documents, counts) of a term, documents as places in the shard."""
        k = self.place.get(term)
        if k is None:
            return None
        both = unpacked(self.raw[self.ends[k - 1] if k else 0 : self.ends[k]])
        return np.cumsum(both[::2]), both[1::2]


def best_of(lists: list[tuple[int, list[int], list[int]]], ids: list[int], best: list[tuple[int, int]], top: int) -> None:
    """Walks one item's lists of a shard document by document and puts what is good enough into ``best``, a heap of
    (score, -doc_id) with at most ``top`` entries. lists: (highest score, documents, scores)."""
    lists.sort(key=lambda x: x[0])  # those that add least come first, and leave the cursor heap first
    docs, scores = [x[1] for x in lists], [x[2] for x in lists]
    below = [0]
    for x in lists:
        below.append(below[-1] + x[0])
    n, bits = len(lists), max(1, len(lists).bit_length())
    mask, at = (1 << bits) - 1, [0] * len(lists)
    bar = best[0][0] if len(best) == top else 1  # a score below it is of no use
    first = bisect_left(below, bar) - 1  # lists before this one do not reach the bar together
    first = max(0, min(first, n))
    cursors = [docs[k][0] << bits | k for k in range(first, n)]
    heapq.heapify(cursors)
    while cursors:
        doc, score = cursors[0] >> bits, 0
        while cursors and cursors[0] >> bits == doc:
            k = cursors[0] & mask
            p = at[k]
            score += scores[k][p]
            at[k] = p = p + 1
            if p < len(docs[k]):
                heapq.heapreplace(cursors, docs[k][p] << bits | k)
            else:
                heapq.heappop(cursors)
        for k in range(first - 1, -1, -1):
            if score + below[k + 1] < bar:
                break
            own = docs[k]
            at[k] = p = bisect_left(own, doc, at[k])
            if p < len(own) and own[p] == doc:
                score += scores[k][p]
        if score < bar:
            continue
        entry = (score, -ids[doc])
        if len(best) < top:
            heapq.heappush(best, entry)
        elif entry > best[0]:
            heapq.heapreplace(best, entry)
        if len(best) == top and best[0][0] > bar:
            bar = best[0][0]
            leaves = first
            while first < n and below[first + 1] < bar:
                first += 1
            if first > leaves:
                cursors = [c for c in cursors if c & mask >= first]
                heapq.heapify(cursors)


def _search(batches, items: list[list[bytes]], weight: dict[bytes, int], docs: int, terms: int, top: int):
    best = [[] for _ in items]
    for batch in batches:
        for r in range(batch.num_rows):
            shard = _Shard(batch.slice(r, 1).to_pylist()[0])
            m = 100 - 50 + (50 * shard.lengths * docs) // terms
            known = {}
            for t in weight.keys() & shard.place.keys():
                if weight[t] > 0:
                    where, tf = shard.postings(t)
                    score = weight[t] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[where]))
                    if score.max() > 0:
                        known[t] = (int(score.max()), where.tolist(), score.tolist())
            ids = shard.ids.tolist()
            for own, heap in zip(items, best, strict=True):
                lists = [known[t] for t in own if t in known]
                if lists:
                    best_of(lists, ids, heap, top)
    flat = [(k, -i, s) for k, heap in enumerate(best) for s, i in heap]
    columns = list(zip(*flat, strict=True)) or [(), (), ()]
    yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], names=["at", "doc_id", "score"])


def _weights(shards: DataFrame, wanted: set[bytes], docs: int) -> dict[bytes, int]:
    """floor(1000 * ln((2 N + 2) / (2 df + 1))) of the wanted terms that occur."""

    def counted(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1).to_pylist()[0]
                place, dfs = {t: k for k, t in enumerate(row["terms"].split(b"\n"))}, np.frombuffer(row["dfs"], "<i8")
                here = list(wanted & place.keys())
                yield pa.RecordBatch.from_arrays([pa.array(here, pa.binary()), pa.array([int(dfs[place[t]]) for t in here], pa.int64())], names=["term", "df"])

    per = shards.select("terms", "dfs").mapInArrow(counted, "term binary, df long").groupBy("term").agg(F.sum("df"))
    return {bytes(r[0]): math.floor(1000 * math.log((2 * docs + 2) / (2 * r[1] + 1))) for r in per.collect()}


def search(shards: DataFrame, items: DataFrame, top: int = TOP, key: str = "item_id", column: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's best documents of an index, from rank 1; none with a score of 0.

    An item's terms count once each; rows with equal item_id (null included) are one item with the terms of all. Null
    texts and texts without a term find nothing. Of equal scores the smaller doc_id is first, null ids come last. Items are
    dealt by hash to passes of about PASS_ITEMS items and PASS_BYTES bytes, so what tasks are sent is bounded whatever
    their number; each pass reads the index once. Other columns are not used. Empty tables: no rows.
    """
    spark = shards.sparkSession
    kind = items.schema[key].dataType
    out = T.StructType([T.StructField(key, kind), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    known = shards.agg(F.sum("docs"), F.sum("terms_read")).first()
    asked = items.select(F.col(key).alias("item"), F.col(column).cast("binary").alias("text")).where("text IS NOT NULL")
    total = asked.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    if not known[0] or not total[0]:
        return spark.createDataFrame([], out)
    passes = max(-(-total[0] // PASS_ITEMS), -(-total[1] // PASS_BYTES))
    asked = asked.withColumn("pass", F.pmod(F.xxhash64("item"), F.lit(passes)))
    found = None
    for k in range(passes):
        terms: dict = {}
        for r in asked.where(F.col("pass") == k).select("item", "text").toLocalIterator():
            terms.setdefault(r["item"], set()).update(term_counts(bytes(r["text"])))
        names = list(terms)
        weight = _weights(shards, set().union(*terms.values()), known[0])
        lists = [sorted(terms[i] & weight.keys()) for i in names]
        args = (lists, weight, known[0], known[1], top)
        part = shards.mapInArrow(lambda batches, args=args: _search(batches, *args), "at int, doc_id long, score long")
        who = spark.createDataFrame(list(enumerate(names)), T.StructType([T.StructField("who", T.IntegerType()), T.StructField("item", kind)]))
        part = part.join(F.broadcast(who), F.col("at") == F.col("who")).select("item", "doc_id", "score")
        found = part if found is None else found.unionByName(part)
    found = written(found, "shard-results")
    # tasks' results meet in two steps, so that an item's are no group of the number of tasks
    groups = F.pmod(F.xxhash64("doc_id"), F.lit(partitions(spark))).alias("group")
    order = (F.desc("score"), "doc_id")
    few = found.select("*", groups).withColumn("r", F.row_number().over(Window.partitionBy("item", "group").orderBy(*order))).where(F.col("r") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select(F.col("item").alias(key), "rank", F.nullif("doc_id", F.lit(_NO_ID)).alias("doc_id"), "score")
