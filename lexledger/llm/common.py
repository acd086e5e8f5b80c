"""Pieces that several operators share: written intermediate tables, size-checked
broadcasts and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders of local sessions without the setting, by application.
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """A folder of this application below the one that all executors share, spark.checkpoint.dir; it can be deleted
    when the application has ended. Where the setting is missing, a local master (as in tests) gets a folder of its
    own, a cluster an error, as it has no folder that survives a lost executor. No setting is changed."""
    where = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set")
        app = spark.sparkContext.applicationId
        where = _LOCAL[app] = _LOCAL.get(app) or tempfile.mkdtemp(prefix="lexledger-")
    return f"{where.rstrip('/')}/lexledger-{spark.sparkContext.applicationId}"


#: Rows of ids in a file of an intermediate table whose size is known beforehand.
FILE_ROWS = 100_000


def written(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts the lineage, survives lost executors.

    rows: how many narrow rows there are at most, where that is known; then no more files are written than they
    need, instead of one for each shuffle partition.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // FILE_ROWS)))
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


#: A side with at most this many short rows is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 100_000


def small_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Broadcast a written table of short rows if a count shows that it is small; else leave the join to shuffle,
    where adaptive execution splits skewed keys."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= BROADCAST_ROWS else df


#: Keys are heavy if they hold more than one in so many rows; there are never more of them than this.
HEAVY_KEYS = 10_000


def by_weight(rows: DataFrame, per_key: DataFrame, key: str, count: str, total: int) -> tuple[DataFrame, DataFrame]:
    """rows joined with a table of one row a key, in two parts: heavy keys, whose rows stay where they are (their
    entries, fewer than HEAVY_KEYS, are broadcast), and all others, which are shuffled and hold at most one in
    HEAVY_KEYS rows each. count: the column of per_key with a key's rows; total: all rows."""
    bar = total / HEAVY_KEYS
    heavy = F.broadcast(per_key.where(F.col(count) > bar))
    light = rows.join(heavy.select(key), key, "left_anti").join(per_key.where(F.col(count) <= bar), key)
    return rows.join(heavy, key), light


#: Rows of a key that are joined in one group, unless a HEAVY_KEYS-th of all rows is more.
KEY_ROWS = 200


def attached(pairs: DataFrame, rows: DataFrame, side: DataFrame, key: str, other: str, total: int) -> DataFrame:
    """rows (the written table of pairs, maybe with more columns) joined with side (id and other columns) on
    key = id. total: number of pairs. A heavy key's rows are dealt, by their other key, to
    several groups, for each of which there is a copy of side's row: at most 2 * HEAVY_KEYS copies in all."""
    bar = max(KEY_ROWS, total / HEAVY_KEYS)
    per = pairs.groupBy(F.col(key).alias("heavy")).agg(F.count("*").alias("c")).where(F.col("c") > bar)
    heavy = written(per.select("heavy", F.ceil(F.col("c") / bar).cast("int").alias("groups")), "heavy", HEAVY_KEYS)
    if heavy.isEmpty():
        return rows.join(side, F.col(key) == F.col("id")).drop("id")
    heavy = F.broadcast(heavy)
    groups = F.coalesce("groups", F.lit(1))
    left = rows.join(heavy, F.col(key) == F.col("heavy"), "left").withColumn("group", F.pmod(F.xxhash64(other), groups).cast("int")).drop("heavy", "groups")
    right = side.join(heavy, F.col("id") == F.col("heavy"), "left").withColumn("g", F.explode(F.sequence(F.lit(0), groups - 1))).drop("heavy", "groups")
    return left.join(right, (F.col(key) == F.col("id")) & (F.col("group") == F.col("g"))).drop("id", "group", "g")


def column(name: str) -> Column:
    """The column of this very name, whatever characters are in it."""
    return F.col(f"`{name.replace('`', '``')}`")


def keeping(docs: DataFrame, added: tuple[str, ...], apply: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """apply(docs) with docs' columns only, those included that have the names of columns that apply adds. Names that
    Python functions on DataFrames can't take (with dots or backticks) are replaced meanwhile."""
    taken = {c.lower() for c in docs.columns} | set(added)
    own = {}
    for c in docs.columns:
        if c.lower() in added or "`" in c or "." in c:
            plain = c.replace("`", "_").replace(".", "_")
            own[c] = next(x for k in range(len(taken) + 1) if (x := f"own_{plain}_{k}").lower() not in taken)
            taken.add(own[c].lower())
    out = apply(docs.withColumnsRenamed(own))
    return out.select(*[column(own.get(c, c)).alias(c) for c in docs.columns])


def row_of(docs: DataFrame):
    """All columns of docs as one struct, in which names clash with nothing."""
    return F.struct(*[column(c) for c in docs.columns])


def row_hash(docs: DataFrame):
    """A 64-bit hash of all columns, of maps and other unhashable ones by their JSON: an order that holds on every run."""
    return F.xxhash64(*[F.to_json(F.struct(column(f.name))) if "map<" in f.dataType.simpleString() or "variant" in f.dataType.simpleString() else column(f.name) for f in docs.schema])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b: long); the component is its smallest node.

    Each round points every node at its smallest neighbour, follows the pointers to their roots by doubling, and
    replaces edges by edges between roots, so the number of components still to be joined at least halves. Only
    minima are gathered by node (summed before the shuffle), so a node with very many edges is no hot group.
    No edges: an empty table. Self-loops keep their node with itself as component.
    """
    spark = edges.sparkSession
    edges = written(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).distinct(), "edges")
    most = 2 * edges.count()  # nodes, and what any table below holds
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = both.select(F.col("a").alias("node")).distinct().select("node", F.col("node").alias("component"))
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = written(both.groupBy(F.col("a").alias("n")).agg(F.least(F.col("n"), F.min("b")).alias("p")), "up", most)
        while True:
            q = up.select(F.col("n").alias("m"), F.col("p").alias("pp"))
            jumped = written(up.join(q, up.p == q.m).select("n", F.col("p").alias("old"), F.col("pp").alias("p")), "up", most)
            up = jumped.select("n", "p")
            if jumped.where("old <> p").isEmpty():
                break
        labels = written(labels.join(up, labels.component == up.n, "left").select("node", F.coalesce("p", "component").alias("component")), "labels", most)
        pa, pb = (up.select(F.col("n").alias(c), F.col("p").alias(f"p{c}")) for c in "ab")
        edges = written(edges.join(pa, "a").join(pb, "b").where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges", most)
    return labels
