"""Packing by optimal length buckets.

Documents become pieces of at most ``max_len`` tokens. Dynamic programming over the global histogram of piece
lengths picks the bucket bounds with the least padding; inside each bucket, batches hold as many pieces as the token
budget allows at the bucket's padded length.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexledger.llm.common import written

MAX_LEN = 2048
BUCKETS = 8
TOKEN_BUDGET = 16384
#: A token: a run of letters, marks, numerals and underscores, or any other non-blank character.
TOKEN = r"[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_ \t\n\x0B\f\r]"
#: A bucket is dealt to shards of SHARD_BATCHES full batches at least, and to SHARDS shards at most before they grow;
#: then of no more than MOST_BATCHES batches or SHARD_PIECES pieces.
SHARD_BATCHES, SHARDS, MOST_BATCHES, SHARD_PIECES = 8, 256, 1024, 200_000


def token_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(TOKEN))


def optimal_bounds(histogram: dict[int, int], buckets: int) -> list[int]:
    """Ascending bounds, the last at the longest length, at most ``buckets`` of them, with the least total of
    (bound - length) over all pieces. Ties: the smaller bounds. No pieces: none."""
    lengths = np.array(sorted(x for x, c in histogram.items() if c > 0), dtype=np.int64)
    if not len(lengths):
        return []
    counts = np.array([histogram[int(x)] for x in lengths], dtype=np.int64)
    n = len(lengths)
    below = np.concatenate([[0], np.cumsum(counts)])
    # cost of one bucket over lengths i..j, up to a term that is the same for every choice: lengths[j] * pieces
    best = lengths * below[1:]
    back = []
    for _ in range(min(buckets, n) - 1):
        now, arg = best.copy(), np.full(n, -1)
        for j in range(1, n):
            total = best[:j] + lengths[j] * (below[j + 1] - below[1 : j + 1])
            i = int(np.argmin(total))
            if total[i] < now[j]:
                now[j], arg[j] = total[i], i
        back.append(arg)
        best = now
    bounds, j = [], n - 1
    for arg in [*reversed(back), None]:
        if arg is None:
            bounds.append(int(lengths[j]))
        elif arg[j] >= 0:
            bounds.append(int(lengths[j]))
            j = int(arg[j])
    return sorted(set(bounds))


def pieces(docs: DataFrame, max_len: int = MAX_LEN, tokens: Column | None = None) -> DataFrame:
    """(doc_id, piece, start, n_tokens, place): every document in consecutive pieces; one empty piece for no tokens.
    place: a 60-bit hash of the document (its id, or its text where that is null) and the piece."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    counted = docs.select("doc_id", key.alias("key"), (token_count(F.col("text")) if tokens is None else tokens).cast("int").alias("n"))
    cut = counted.withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / max_len) - 1, F.lit(0)).cast("int"))))
    place = F.conv(F.substring(F.md5(F.concat_ws(":", "key", F.col("piece").cast("string"))), 1, 15), 16, 10).cast("bigint")
    return cut.select("doc_id", "piece", (F.col("piece") * max_len).alias("start"), F.least(F.lit(max_len), F.col("n") - F.col("piece") * max_len).alias("n_tokens"), place.alias("place"))


def shard_count(n: int, room: int) -> int:
    """Shards of a bucket of n pieces whose batches hold ``room`` of them: by the data alone, whatever the cluster."""
    batches = n // room
    each = max(1, min(max(SHARD_BATCHES, min(MOST_BATCHES, batches // SHARDS)), SHARD_PIECES // room))
    return max(1, batches // each)


def pack(docs: DataFrame, max_len: int = MAX_LEN, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET, tokens: Column | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, n_tokens, bucket (its padded length), padding, batch_id, slot.

    The histogram has at most max_len + 1 entries whatever the corpus, so the driver plans the buckets. Batches are
    filled inside shards of a bucket, dealt by hash, so that no task numbers a whole bucket; each shard ends with
    one batch that may not be full. Batches depend on the documents only, not on the cluster's settings. Repeated
    doc_ids are packed as often as they occur; null ids as well. Null text: one empty piece. Empty table: no rows.
    Other columns of docs are not used.
    """
    cut = written(pieces(docs, max_len, tokens), "pieces")
    histogram = {r[0]: r[1] for r in cut.groupBy("n_tokens").count().collect()}
    bounds = optimal_bounds(histogram, buckets) or [max_len]
    each = [sum(c for x, c in histogram.items() if lo < x <= hi) for lo, hi in zip([-1, *bounds], bounds, strict=False)]
    room = [max(1, budget // max(b, 1)) for b in bounds]
    shards = [shard_count(c, r) for c, r in zip(each, room, strict=True)]
    pick = lambda values: F.element_at(F.array(*[F.lit(int(v)) for v in values]), F.col("b") + 1)
    placed = cut.withColumn("b", F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < F.col("n_tokens"))))
    placed = placed.select("*", pick(bounds).alias("bucket"), pick(room).alias("room"), F.pmod("place", pick(shards)).cast("int").alias("shard"))
    order = Window.partitionBy("b", "shard").orderBy("place", "doc_id", "piece", "n_tokens")
    numbered = placed.withColumn("at", F.row_number().over(order) - 1)
    batch = F.concat_ws("-", F.col("bucket").cast("string"), F.col("shard").cast("string"), F.floor(F.col("at") / F.col("room")).cast("string"))
    return numbered.select(
        "doc_id", "piece", "start", "n_tokens", "bucket", (F.col("bucket") - F.col("n_tokens")).alias("padding"),
        batch.alias("batch_id"), (F.col("at") % F.col("room")).cast("int").alias("slot"),
    )
