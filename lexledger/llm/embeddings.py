"""Embedding near-duplicates by spherical-cap filters.

Filters are directions of a random product code: the space is turned by a random rotation and cut into blocks, each
block has its own random unit vectors, and a filter is one choice from every block. A vector is list-decoded to all
filters whose direction it exceeds by a threshold; vectors that meet in a filter are compared. The number of filters
follows the number of vectors, and the threshold is set so that a pair at the least similarity is expected to share
EXPECTED_SHARED filters.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexledger.llm.common import components, written

SIMILARITY = 0.9
#: Filters that a pair at the least similarity shares on average. Recall there is measured in tests (over 0.97).
EXPECTED_SHARED = 10.0
FILTERS_PER_VECTOR = 0.25
#: Every vector is in so many of its best filters at least, also where few exceed the threshold; with more filters
#: than the first number, in more by this power of the ratio, which holds recall about even.
LEAST_FILTERS, LEAST_AT, LEAST_POWER = 24, 12_500, 0.2
#: Vectors of a filter are compared in blocks of about so many, each pair of blocks in a group of its own.
BLOCK = 1024
_SEED = 20240229


def pair_rates(z: float, rho: float) -> tuple[float, float]:
    """P(X > z) and P(X > z and Y > z) of standard normal X, Y with correlation rho."""
    x = np.linspace(z, z + 12, 4001)
    density = np.exp(-x * x / 2) / math.sqrt(2 * math.pi)
    tail = np.array([0.5 * math.erfc((z - rho * v) / math.sqrt(1 - rho * rho) / math.sqrt(2)) for v in x])
    return 0.5 * math.erfc(z / math.sqrt(2)), float(np.trapezoid(density * tail, x))


class Filters:
    """A random product code for vectors of dimension ``dim``, sized for ``count`` vectors."""

    def __init__(self, dim: int, count: int, similarity: float = SIMILARITY, shared: float = EXPECTED_SHARED, per_vector: float = FILTERS_PER_VECTOR):
        wanted = max(4096.0, per_vector * count)
        self.blocks = min(max(1, dim // 4), max(3, math.ceil(math.log(wanted) / math.log(128))))
        self.size = max(2, math.ceil(wanted ** (1 / self.blocks)))
        self.least = math.ceil(LEAST_FILTERS * max(1.0, self.size**self.blocks / LEAST_AT) ** LEAST_POWER)
        low, high = 0.0, 8.0
        for _ in range(50):  # the highest threshold with enough shared filters
            mid = (low + high) / 2
            low, high = (mid, high) if self.size**self.blocks * pair_rates(mid, similarity)[1] >= shared else (low, mid)
        self.threshold = low / math.sqrt(dim)
        rng = np.random.default_rng(_SEED)
        self.rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.cuts = np.linspace(0, dim, self.blocks + 1).astype(int)
        self.codes = []
        for a, b in zip(self.cuts[:-1], self.cuts[1:], strict=True):
            c = rng.standard_normal((self.size, b - a))
            self.codes.append(c / np.linalg.norm(c, axis=1, keepdims=True) * math.sqrt((b - a) / dim))

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """For each unit vector (a row) all filter numbers whose direction it exceeds, and its ``least`` best."""
        turned = unit @ self.rotation
        parts = [turned[:, a:b] @ c.T for a, b, c in zip(self.cuts[:-1], self.cuts[1:], self.codes, strict=True)]
        rest = np.cumsum([p.max(axis=1) for p in parts][::-1], axis=0)[::-1]  # the most that this and later blocks add
        # the best sums of all filters are among those of each block's best codes
        best = np.zeros((len(unit), 1))
        for p in parts:
            top = -np.partition(-p, min(self.least, self.size) - 1, axis=1)[:, : self.least]
            best = (best[:, :, None] + top[:, None, :]).reshape(len(unit), -1)
            best = -np.partition(-best, min(self.least, best.shape[1]) - 1, axis=1)[:, : self.least]
        enough = best.min(axis=1) - 1e-12
        out = []
        for i in range(len(unit)):
            sums, ids = np.zeros(1), np.zeros(1, np.int64)
            need = min(self.threshold, enough[i])
            for k, p in enumerate(parts):
                total = sums[:, None] + p[i][None, :]
                later = rest[k + 1][i] if k + 1 < self.blocks else 0.0
                at = np.nonzero(total + later >= need)
                sums, ids = total[at], ids[at[0]] * self.size + at[1]
            out.append(np.sort(ids))
        return out


def unit_rows(packed: list[bytes], kind: str) -> np.ndarray:
    """Unit vectors in double precision of sound vectors, packed as numbers of type ``kind``."""
    x = np.frombuffer(b"".join(packed), kind).reshape(len(packed), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _compare(sizes: dict[int, int], similarity: float, shared: float, kind: str):
    """Of one pair of blocks of a filter: for each vector the links found and the smallest vector that it reaches.
    A pair that meets in several filters counts in the smallest of them only; what filters a vector is in is decoded
    again for those that have links here."""
    made: dict[int, Filters] = {}
    known: dict[int, frozenset] = {}

    def run(table: pa.Table) -> pa.Table:
        ids, size, block = (table.column(c).to_numpy() for c in ("id", "size", "block"))
        here, dim, i, j = (table.column(c)[0].as_py() for c in ("filter", "dim", "i", "j"))
        x = unit_rows(table.column("packed").to_pylist(), kind)
        a, b = np.nonzero(np.triu(x @ x.T >= similarity, 1))
        if i != j:
            apart = block[a] != block[b]
            a, b = a[apart], b[apart]
        if dim not in made:
            made[dim] = Filters(dim, sizes[dim], similarity, shared)
        if len(known) > 50_000:
            known.clear()
        new = [k for k in np.unique(np.concatenate([a, b])).tolist() if int(ids[k]) not in known]
        known.update((int(ids[k]), frozenset(f.tolist())) for k, f in zip(new, made[dim].decode(x[new]) if new else [], strict=True))
        here_first = [min(known[int(ids[p])] & known[int(ids[q])]) == here for p, q in zip(a, b, strict=True)]
        a, b = a[here_first], b[here_first]
        n = np.zeros(len(ids), np.int64)
        np.add.at(n, a, size[b])
        np.add.at(n, b, size[a])
        least, before = ids.copy(), None
        while before is None or (before != least).any():  # one edge for each vector says what is joined here
            before = least.copy()
            np.minimum.at(least, a, before[b])
            np.minimum.at(least, b, before[a])
        seen = n > 0
        return pa.table({"id": ids[seen], "links": n[seen], "least": least[seen]})

    return run


def similar(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", similarity: float = SIMILARITY, expected_shared: float = EXPECTED_SHARED) -> DataFrame:
    """(vec_id, n_links, component_id, kept, class_id): one row per vector.

    Null, empty or zero vectors and those with null or non-finite components link with nothing. Vectors of different
    lengths have no cosine and don't link. Equal vectors form a class and are compared as one; n_links counts every
    other vector, copies included. Repeated ids: each row is compared as a vector of its own, and the rows of an id
    belong to one component. Other columns are not used. Empty table: no rows. A column that holds no arrays of
    numbers is an error.
    """
    if not isinstance(vectors.schema[column].dataType, T.ArrayType):
        raise TypeError(f"{column} is {vectors.schema[column].dataType.simpleString()}, not an array of numbers")
    kind = "<f4" if vectors.schema[column].dataType.elementType == T.FloatType() else "<f8"
    number = "float" if kind == "<f4" else "double"
    base = vectors.select(F.col(key).cast("long").alias("id"), F.col(column).cast(f"array<{number}>").alias("e"))
    bad = F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = F.col("id").isNotNull() & F.col("e").isNotNull() & F.exists("e", lambda x: x != 0) & ~bad

    def pack(batches):
        for batch in batches:
            packed = [None if v is None else np.array(v, kind).tobytes() for v in batch.column("e").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(packed, pa.binary())], names=["id", "packed"])

    rows = base.select("id", F.when(F.coalesce(sound, F.lit(False)), F.col("e")).alias("e")).mapInArrow(pack, "id long, packed binary")
    rows = written(rows.select("id", "packed", F.sha2("packed", 256).alias("same")), "vectors")
    classes = rows.where("same IS NOT NULL").groupBy("same").agg(F.min("id").alias("class_id"), F.count("*").alias("size"))
    # a class is known by a number of its own, fixed when it is written, since one id may have several vectors
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    width = F.lit(int(kind[2]))
    reps = rows.join(classes.withColumnRenamed("same", "class"), (F.col("same") == F.col("class")) & (F.col("id") == F.col("class_id")))
    reps = reps.select(F.col("node").alias("id"), "size", (F.octet_length("packed") / width).cast("int").alias("dim"), "packed")
    reps = written(reps.dropDuplicates(["id"]), "class-vectors")  # rows of a node are equal
    sizes = {r["dim"]: r["count"] for r in reps.groupBy("dim").count().collect()}

    def decode(batches):
        made = {}
        for batch in batches:
            at = {}
            for k, d in enumerate(batch.column("dim").to_pylist()):
                at.setdefault(d, []).append(k)
            for d, where in at.items():
                if d not in made:
                    made[d] = Filters(d, sizes[d], similarity, expected_shared)
                part = batch.take(pa.array(where))
                found = made[d].decode(unit_rows(part.column("packed").to_pylist(), kind))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("dim"), pa.array(found, pa.list_(pa.int64()))], names=["id", "dim", "filters"])

    decoded = reps.mapInArrow(decode, "id long, dim int, filters array<long>")
    met = written(decoded.select("dim", "id", F.explode("filters").alias("filter")), "filter-members")
    per = met.groupBy("dim", "filter").agg(F.count("*").alias("members")).where("members > 1")
    # a filter of m members becomes m / BLOCK blocks by a hash of the id, and a group for each pair of blocks
    placed = met.join(per, ["dim", "filter"]).withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    spread = placed.select("dim", "filter", "id", "block", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(F.col("block"), o).alias("i"), F.greatest(F.col("block"), o).alias("j")))).alias("p"))
    groups = spread.select("dim", "filter", "id", "block", "p.i", "p.j").join(reps.select("id", "size", "packed"), "id")
    found = groups.groupBy("dim", "filter", "i", "j").applyInArrow(_compare(sizes, similarity, expected_shared, kind), "id long, links long, least long")
    found = written(found, "vector-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    edges = found.where("id <> least").select(F.col("id").alias("a"), F.col("least").alias("b"))
    several = rows.where("same IS NOT NULL").groupBy("id").agg(F.min("same").alias("one"), F.max("same").alias("other")).where("one <> other").select("id")
    several = written(several, "ids-of-several-vectors")
    if not several.isEmpty():
        of = rows.join(several, "id").select("id", "same").distinct().join(classes.select("same", "node"), "same")
        edges = edges.unionByName(of.join(of.groupBy("id").agg(F.min("node").alias("b")), "id").select(F.col("node").alias("a"), "b"))
    joined = components(edges)
    per_class = classes.withColumnRenamed("node", "own").join(links, F.col("own") == F.col("id"), "left").drop("id").join(joined, F.col("own") == F.col("node"), "left")
    per_class = written(per_class.select("same", "class_id", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "own").alias("root")), "class-links")
    least = per_class.groupBy("root").agg(F.min("class_id").alias("component_id"))
    per_class = per_class.join(least, "root").drop("root")
    out = rows.select("id", "same").join(per_class, "same", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"), F.coalesce("class_id", "id").alias("class_id"))
