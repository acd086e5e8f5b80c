"""Product codes of vectors, by exact integer arithmetic.

Vectors are cut into parts, and every part is replaced by the number of the nearest entry of its codebook, found by a
few rounds of Lloyd's method. Distances of all entries are first bounded by one float32 matrix product with rigorous
rounding-error intervals; entries whose interval reaches the best one are evaluated again in 64-bit integers, and ties
go to the lower index. The result is the same as if every distance had been taken in integers.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexledger.llm.common import by_weight, written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Components are less than this after scaling, so that squared distances of up to 512 components fit in 64 bits.
LIMIT = 1 << 26
#: Components of all pairs of a block of vectors with a codebook, which bounds what is evaluated again at a time.
BLOCK_NUMBERS = 1 << 22
_UNIT = 2.0**-24  # the relative error of one float32 operation
_KIND, _SHIFT = ">u4", 1 << 31


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the entry nearest to each row of x; both int64. Ties: the lower index."""
    distinct, first = np.unique(entries, axis=0, return_index=True)
    order = np.argsort(first)  # of equal entries only the first can win
    distinct, first = distinct[order], first[order]
    index, distance = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    width = entries.shape[1]
    # a dot product of w terms in float32, from operands rounded to float32, is off by at most gamma * |x| * |c| in
    # whatever order it is summed; norms and sums below are float64, whose errors the last factor covers
    gamma = (width + 3) * _UNIT / (1 - (width + 3) * _UNIT)
    columns = distinct.astype(np.float32).T
    square = (distinct.astype(np.float64) ** 2).sum(1)
    norm = np.sqrt(square)
    block = max(1, BLOCK_NUMBERS // (len(distinct) * width))
    for a in range(0, len(x), block):
        rows = x[a : a + block]
        dots = (rows.astype(np.float32) @ columns).astype(np.float64)
        own = (rows.astype(np.float64) ** 2).sum(1, keepdims=True)
        about = square - 2 * dots  # the squared distance less |x|^2
        reach = 2 * gamma * np.sqrt(own) * norm * (1 + 1e-9) + (square + own) * 1e-13
        r, c = np.nonzero(about - reach <= (about + reach).min(1, keepdims=True))
        exact = ((rows[r] - distinct[c]) ** 2).sum(1)
        starts = np.searchsorted(r, np.arange(len(rows)))
        least = np.minimum.reduceat(exact, starts)
        best = np.where(exact == least[r], first[c], len(entries))
        distance[a : a + block] = least
        index[a : a + block] = np.minimum.reduceat(best, starts)
    return index, distance


class Codebooks:
    """entries[part]: int64 rows, at most ENTRIES of them."""

    def __init__(self, entries: list[np.ndarray]):
        self.entries = entries

    @property
    def parts(self) -> int:
        return len(self.entries)

    @property
    def dim(self) -> int:
        return sum(e.shape[1] for e in self.entries)

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, squared distances) of whole vectors, a column for each part."""
        pairs = [nearest(p, e) for p, e in zip(np.split(x, self.parts, axis=1), self.entries, strict=True)]
        return np.stack([i for i, _ in pairs], 1), np.stack([d for _, d in pairs], 1)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(v) for e in self.entries for v in e.ravel().tolist()).encode()).hexdigest()


def integers(vectors: DataFrame, key: str = "vec_id", label: str = "label", column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, label, packed): components as floor(scale * x), packed so that bytes have the order of the numbers; rows whose vector is null or
    holds null or non-finite components are left out. A component of LIMIT / scale or more is an error."""
    kind = vectors.schema[column].dataType
    if not isinstance(kind, T.ArrayType):
        raise TypeError(f"{column} is {kind.simpleString()}, not an array of numbers")
    base = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(column).cast("array<double>").alias("e"))
    bad = F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    base = base.where(F.col("e").isNotNull() & ~bad)

    def pack(batches):
        for batch in batches:
            e = batch.column("e")
            ends = e.offsets.to_numpy()
            flat = e.values.to_numpy(zero_copy_only=False) if len(e.values) else np.zeros(0)
            scaled = np.floor(flat * scale)
            if len(scaled) and np.abs(scaled).max() >= LIMIT:
                raise ValueError(f"a component is {LIMIT // scale} or more")
            raw = (scaled.astype(np.int64) + _SHIFT).astype(_KIND)
            packed = [raw[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(packed, pa.binary())], names=["id", "label", "packed"])

    schema = T.StructType([T.StructField("id", vectors.schema[key].dataType), T.StructField("label", vectors.schema[label].dataType), T.StructField("packed", T.BinaryType())])
    return written(base.mapInArrow(pack, schema), "integer-vectors")


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), _KIND).reshape(-1, width).astype(np.int64) - _SHIFT


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of written integer vectors of one length; None if there are none.

    They start as the parts of the ``entries`` smallest ids (ties: by the vector; nulls last). Tasks return the sums and
    counts of what they gave to each entry; the driver holds the codebooks only.
    """
    first = vectors.orderBy(F.asc_nulls_last("id"), "packed").limit(entries).select("packed").collect()
    if not first:
        return None
    start = _rows(pa.array([bytes(r[0]) for r in first]), len(first[0][0]) // 4)
    books = Codebooks(np.split(start, parts, axis=1))
    dim, width = books.dim, books.dim // parts
    sums = [f"s{k}" for k in range(width)]
    for _ in range(rounds):

        def given(batches, books=books):
            total = [np.zeros((len(e), width + 1), np.int64) for e in books.entries]
            for batch in batches:
                x = _rows(batch.column("packed"), dim)
                codes, _ = books.assign(x)
                for p, part in enumerate(np.split(x, parts, axis=1)):
                    order = np.argsort(codes[:, p], kind="stable")
                    which, at = np.unique(codes[order, p], return_index=True)
                    total[p][which, :width] += np.add.reduceat(part[order], at, axis=0)
                    total[p][which, width] += np.diff([*at, len(x)])
            p, e = np.nonzero(np.stack([t[:, width] for t in total]))
            found = np.stack([total[a][b] for a, b in zip(p, e, strict=True)]) if len(p) else np.zeros((0, width + 1), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), *(pa.array(found[:, k]) for k in range(width + 1))], names=["part", "entry", *sums, "n"])

        partial = vectors.select("packed").mapInArrow(given, f"part int, entry int, {', '.join(f'{s} long' for s in sums)}, n long")
        renewed = [e.copy() for e in books.entries]
        for r in partial.groupBy("part", "entry").agg(*[F.sum(s) for s in (*sums, "n")]).collect():
            renewed[r[0]][r[1]] = np.array(r[2:-1], np.int64) // r[-1]  # rounds down
        books = Codebooks(renewed)
    return books


def compress(vectors: DataFrame, key: str = "vec_id", label: str = "label", column: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): one row per vector whose components are all finite numbers.

    code: two hex digits for each part. error: the vector's squared distance to what its code stands for. label_error:
    the errors of all vectors with its label, those without a label together. All sums are exact, so the result is the
    same however the rows are partitioned. Repeated ids: a row each. Null ids are the last to start a codebook. Vectors
    are as long as the most of them (the shorter, of equally many); those of another length, and all if that length is
    no multiple of ``parts`` or zero, have no code: null in code, error and codebooks_sha256, and nothing in
    label_error. Other columns are not used. Empty table: no rows. A column that holds no arrays of numbers, or a
    component of 65,536 or more, is an error.
    """
    rows = integers(vectors, key, label, column)
    size = F.octet_length("packed")
    length = rows.groupBy(size.alias("size")).count().orderBy(F.desc("count"), "size").first()
    fits = length is not None and length["size"] > 0 and length["size"] // 4 % parts == 0
    sound = rows.where(size == (length["size"] if fits else -1))
    books = train(sound, parts, entries, rounds) if fits else None
    bytes_each = length["size"] if length is not None else 0

    def code(batches):
        for batch in batches:
            raw = batch.column("packed").to_pylist()
            good = [k for k, v in enumerate(raw) if books is not None and len(v) == bytes_each]
            codes, errors = [None] * len(raw), [None] * len(raw)
            if good:
                found, apart = books.assign(_rows(batch.column("packed").take(pa.array(good)), books.dim))
                digits, total = found.astype(np.uint8), apart.sum(1)
                for k, d, e in zip(good, digits, total.tolist(), strict=True):
                    codes[k], errors[k] = d.tobytes().hex(), e
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(errors, pa.int64())], names=["id", "label", "code", "error"])

    schema = T.StructType([rows.schema["id"], rows.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    coded = written(rows.mapInArrow(code, schema), "codes")
    of = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))  # null is a label of its own
    coded = coded.select("id", of.alias("of"), "code", "error")
    per = written(coded.groupBy("of").agg(F.sum("error").alias("label_error"), F.count("*").alias("members")), "label-errors")
    heavy, light = by_weight(coded, per, "of", "members", coded.count())
    digest = F.when(F.col("code").isNotNull(), F.lit(books.sha256() if books else None))
    return heavy.unionByName(light).select(F.col("id").alias(key), "code", "error", "label_error", digest.alias("codebooks_sha256"))
