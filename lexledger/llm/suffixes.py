"""Suffix-array deduplication by difference-cover blockwise construction.

Wanted are the suffixes that share WINDOW bytes with another suffix: the ties of a suffix array sorted to that
depth. A global array would hold a row for every byte; here suffixes are sorted one bucket at a time, and only those
that the difference cover does not already tell apart:

1. Documents are dealt to blocks once, in a table bucketed by block, which the later passes read without a shuffle.
   Texts that occur more than once are represented by one of their copies.
2. Cover sample. Positions p with p mod V in D (a perfect difference set) are ranked by the DEPTH bytes that follow:
   rank "tied" if the string occurs at another sample position, else "alone". Two suffixes that share WINDOW bytes
   share a sample offset below V, so a suffix is told apart from all others unless a sample position in reach is tied.
3. The remaining suffixes are keyed to depth WINDOW and sorted bucket by bucket. Equal neighbours of a bucket form a
   chain over the blocks, in the blocks' order.
4. Every block compares its own suffixes of a key byte by byte, and with those of the block that comes next in the
   key's chain, which sends it the bytes. Equality passes along a chain, so each repeat is confirmed on its bytes, and
   a passage that all blocks hold is no hot spot. Different strings with one key (chance, 2^-64 for each pair) are
   thus found out; the run is then made again with other random numbers.

Buckets are ranges of a 64-bit polynomial hash of the bytes instead of ranges of the bytes themselves: only ties are
wanted, so any order does, and hash ranges are equally large whatever the text. Sorted keys travel as compressed
differences, answers as compressed arrays. Memory: a block's text and one bucket's keys.
"""

from __future__ import annotations

import hashlib
import math
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexledger.llm.common import partitions, shared_dir, written

WINDOW = 200
#: A perfect difference set: every residue mod V is a difference of two of D (checked in tests).
V = 57
D = (0, 1, 3, 13, 32, 36, 43, 52)
#: Two suffixes equal in WINDOW bytes are equal in DEPTH bytes at a common sample offset.
DEPTH = WINDOW - V + 1
#: Bytes of text in a block, at least and at most; keys of a bucket, as a target, in bytes; text of a task.
BLOCK_BYTES, BLOCK_BYTES_MOST, BUCKET_BYTES, TASK_BYTES = 1 << 20, 16 << 20, 32 << 20, 256 << 20
_SEGMENT = 1 << 19
#: Runs of equal pairs shorter than this are compared many at a time.
_SHORT = 64


def _powers(base: int, n: int) -> np.ndarray:
    x = np.full(n, base, np.uint64)
    x[0] = 1
    return np.multiply.accumulate(x, out=x)


class Hasher:
    """64-bit hashes of the ``length`` bytes from given positions, a segment of the text at a time."""

    def __init__(self, seed: int = 0):
        n = _SEGMENT + WINDOW + 1
        rng = np.random.default_rng([77, seed])
        base = int(rng.integers(0, 2**64, dtype=np.uint64)) | 5
        self.table = rng.integers(0, 2**64, 256, dtype=np.uint64)
        self.up, self.down = _powers(base, n), _powers(pow(base, -1, 2**64), n)

    def at(self, buf: np.ndarray, positions: np.ndarray, length: int) -> np.ndarray:
        out = np.empty(len(positions), np.uint64)
        for low in range(0, len(buf), _SEGMENT):
            a, b = np.searchsorted(positions, [low, low + _SEGMENT])
            if a == b:
                continue
            part = buf[low : low + _SEGMENT + length]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(self.table[part] * self.up[: len(part)], out=sums[1:])
            p = positions[a:b] - low
            out[a:b] = (sums[p + length] - sums[p]) * self.down[p]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(29)
        return out


def packed(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x.tobytes())


def unpacked(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def ranges(positions: np.ndarray) -> np.ndarray:
    """Ascending positions as (first, last + 1) of their runs."""
    if not len(positions):
        return np.empty((0, 2), np.int64)
    cut = np.nonzero(np.diff(positions) > 1)[0]
    return np.stack([positions[np.concatenate([[0], cut + 1])], positions[np.concatenate([cut, [len(positions) - 1]])] + 1], 1).astype(np.int64)


def positions_of(runs: np.ndarray) -> np.ndarray:
    """The positions in runs of (first, last + 1)."""
    size = runs[:, 1] - runs[:, 0]
    return np.repeat(runs[:, 0] - np.cumsum(size) + size, size) + np.arange(size.sum())


def all_equal(x: np.ndarray, p: np.ndarray, y: np.ndarray, q: np.ndarray) -> bool:
    """Whether the WINDOW bytes of x at each of p are those of y at each of q."""
    if not len(p):
        return True
    cut = np.nonzero((np.diff(p) != 1) | (np.diff(q) != 1))[0] + 1
    first, stop = np.concatenate([[0], cut]), np.concatenate([cut, [len(p)]])
    long = stop - first >= _SHORT
    for a, b in zip(first[long].tolist(), stop[long].tolist(), strict=True):
        n = b - a + WINDOW - 1
        if not np.array_equal(x[p[a] : p[a] + n], y[q[a] : q[a] + n]):
            return False
    rest = np.nonzero(np.repeat(~long, stop - first))[0]
    reach = np.arange(WINDOW)
    for k in range(0, len(rest), 4096):
        at = rest[k : k + 4096, None]
        if not np.array_equal(x[p[at] + reach], y[q[at] + reach]):
            return False
    return True


def squeezed(keys: np.ndarray) -> bytes:
    """Sorted keys as compressed differences, byte planes apart."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return zstandard.ZstdCompressor(level=1).compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes())


def unsqueezed(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


class Block:
    """The documents of a block, in a fixed order."""

    def __init__(self, parts: pa.Table, notes: pa.Table, hasher: Hasher):
        self.hasher = hasher
        rows = sorted(zip(parts.column("part").to_pylist(), parts.column("packed"), strict=True), key=lambda r: r[0])
        tables = [pa.ipc.open_stream(p.as_buffer()).read_all() for _, p in rows]
        self.table = pa.concat_tables(tables)
        at = {(name, i): k for k, (name, i) in enumerate((name, i) for (name, _), t in zip(rows, tables, strict=True) for i in range(t.num_rows))}
        self.texts = [(t or "").encode("utf-8", "surrogatepass") for t in self.table.column("text").to_pylist()]
        self.copied, skipped = set(), set()
        self.bits: dict[str, dict[int, bytes]] = {"sample": {}, "suffix": {}}
        self.sent: list[bytes] = []
        self.near = self.repeated = np.empty((0, 2), np.int64)
        for kind, part, pos, first, bucket, data in zip(*(notes.column(c).to_pylist() for c in ("kind", "part", "pos", "first", "bucket", "bits")), strict=True):
            if kind == "copy":
                self.copied.add(at[part, pos])
                if not first:
                    skipped.add(at[part, pos])
            elif kind == "near":
                self.near = unpacked(data, np.int64).reshape(-1, 2)
            elif kind == "repeated":
                self.repeated = unpacked(data, np.int64).reshape(-1, 2)
            elif kind == "sent":
                self.sent.append(data)
            else:
                self.bits[kind][bucket] = data
        self.used = [k for k in range(len(self.texts)) if k not in skipped]
        sizes = np.array([len(self.texts[k]) for k in self.used], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.buf = np.frombuffer(b"".join(self.texts[k] for k in self.used), np.uint8)

    def _within(self, length: int) -> np.ndarray:
        """Marks the positions from which ``length`` bytes of the same document follow."""
        steps = np.zeros(len(self.buf) + 1, np.int8)
        fits = self.ends - self.starts >= length
        np.add.at(steps, self.starts[fits], 1)
        np.add.at(steps, self.ends[fits] - length + 1, -1)
        return np.cumsum(steps[:-1], dtype=np.int8) > 0

    def samples(self) -> tuple[np.ndarray, np.ndarray]:
        offset = np.arange(len(self.buf)) - np.repeat(self.starts, self.ends - self.starts)
        cover = np.zeros(V, bool)
        cover[list(D)] = True
        positions = np.nonzero(cover[offset % V] & self._within(DEPTH))[0]
        return positions, self.hasher.at(self.buf, positions, DEPTH)

    def tied_samples(self, bits: int, buckets: int) -> np.ndarray:
        """Sample positions whose keys occur more than once here, or in another block."""
        positions, keys = self.samples()
        unique, inverse, counts = np.unique(keys >> np.uint64(64 - bits), return_inverse=True, return_counts=True)
        found = counts > 1
        for a, b, data in self._answers("sample", unique, bits, buckets):
            found[a:b] |= np.unpackbits(unpacked(data, np.uint8), count=b - a).astype(bool)
        return positions[found[inverse]]

    def _answers(self, kind: str, unique: np.ndarray, bits: int, buckets: int):
        edges = np.searchsorted((unique >> np.uint64(bits - buckets)).astype(np.int64), np.arange((1 << buckets) + 1))
        for bucket, data in self.bits[kind].items():
            yield edges[bucket], edges[bucket + 1], data

    def candidates(self, bits: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes that a tied sample position does not tell apart, with their keys to depth WINDOW."""
        tied = self.tied_samples(bits, buckets)
        steps = np.zeros(len(self.buf) + 1, np.int32)
        np.add.at(steps, np.maximum(tied - (WINDOW - DEPTH), 0), 1)
        np.add.at(steps, tied + 1, -1)
        near = np.nonzero((np.cumsum(steps[:-1]) > 0) & self._within(WINDOW))[0]
        return near, self.hasher.at(self.buf, near, WINDOW)

    def repeats(self, buckets: int) -> tuple[np.ndarray, dict[int, bytes]]:
        """The suffixes whose keys occur again, and what to send to which block: the bytes of those whose keys'
        chains come from there."""
        near = positions_of(self.near)
        unique, at, inverse, counts = np.unique(self.hasher.at(self.buf, near, WINDOW), return_index=True, return_inverse=True, return_counts=True)
        before = np.zeros(len(unique), np.int32)  # 0: only here, 1: first of its chain, else the block before this + 2
        for a, b, data in self._answers("suffix", unique, 64, buckets):
            before[a:b] = unpacked(data, np.int32)
        later = np.nonzero(before > 1)[0]
        later = later[np.argsort(at[later], kind="stable")]
        p, to = near[at[later]], before[later] - 2
        sent: dict[int, list] = {}
        if len(p):
            cut = np.nonzero((np.diff(p) > 1) | (np.diff(to) != 0))[0]
            for a, b in zip(np.concatenate([[0], cut + 1]).tolist(), np.concatenate([cut, [len(p) - 1]]).tolist(), strict=True):
                sent.setdefault(int(to[a]), []).append(self.buf[p[a] : p[b] + WINDOW])
        full = {k: packed(np.concatenate([np.array([len(v), *map(len, v)], np.int32).view(np.uint8), *v])) for k, v in sent.items()}
        return near[((counts > 1) | (before > 0))[inverse]], full

    def confirmed(self) -> bool:
        """Whether suffixes with equal keys are equal, here and in what other blocks have sent."""
        own = positions_of(self.repeated)
        unique, at, inverse = np.unique(self.hasher.at(self.buf, own, WINDOW), return_index=True, return_inverse=True)
        first = own[at]
        again = first[inverse] != own
        if not all_equal(self.buf, own[again], self.buf, first[inverse][again]):
            return False
        for data in self.sent:
            raw = unpacked(data, np.uint8)
            n = int(raw[:4].view(np.int32)[0])
            size = raw[4 : 4 + 4 * n].view(np.int32).astype(np.int64)
            buf = raw[4 + 4 * n :]
            start = np.cumsum(size) - size
            p = positions_of(np.stack([start, start + size - WINDOW + 1], 1))
            keys = self.hasher.at(buf, p, WINDOW)
            k = np.minimum(np.searchsorted(unique, keys), max(len(unique) - 1, 0))
            if not len(unique) or (unique[k] != keys).any() or not all_equal(buf, p, self.buf, first[k]):
                return False
        return True

    def spans(self) -> list[list[tuple[int, int]]]:
        """For every document of the block its maximal repeated byte ranges."""
        repeated = positions_of(self.repeated)
        out: list[list[tuple[int, int]]] = [[] for _ in self.texts]
        of = np.searchsorted(self.ends, repeated, side="right")
        if len(repeated):
            first = np.concatenate([[True], (np.diff(repeated) > WINDOW) | (np.diff(of) > 0)])
            last = np.concatenate([first[1:], [True]])
            for a, b, k in zip(repeated[first].tolist(), repeated[last].tolist(), of[first].tolist(), strict=True):
                low = int(self.starts[k])
                out[self.used[k]].append((a - low, b - low + WINDOW))
        for k in self.copied:
            out[k] = [(0, len(self.texts[k]))]
        return out


def _chunks(keys: np.ndarray, bits: int, buckets: int, block: int, kept: bytes | None = None) -> pa.Table:
    """A row for each bucket with keys; ``kept`` goes back to the block itself, as a row of a bucket of its own."""
    unique = np.unique(keys >> np.uint64(64 - bits))
    edges = np.searchsorted(unique >> np.uint64(bits - buckets), np.arange((1 << buckets) + 1, dtype=np.uint64))
    full = [k for k in range(1 << buckets) if edges[k] < edges[k + 1]]
    rows = [(k, squeezed(unique[edges[k] : edges[k + 1]])) for k in full] + ([] if kept is None else [(-1 - block, kept)])
    return pa.table({"bucket": pa.array([k for k, _ in rows], pa.int32()), "block": pa.array([block] * len(rows), pa.int32()), "keys": pa.array([x for _, x in rows], pa.binary())})


def _note(kind: str, blocks: list[int], data: list[bytes], bucket: int | None = None) -> pa.Table:
    n = len(blocks)
    return pa.table({"block": pa.array(blocks, pa.int32()), "kind": pa.array([kind] * n, pa.string()), "part": pa.nulls(n, pa.string()), "pos": pa.nulls(n, pa.int32()), "first": pa.nulls(n, pa.bool_()), "bucket": pa.array([bucket] * n, pa.int32()), "bits": pa.array(data, pa.binary())})


def _sort_bucket(kind: str):
    """Sorts all keys of one bucket; tells every block which of its keys other blocks have too: for samples as one
    bit a key, for suffixes as the block before it in the key's chain."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        if bucket < 0:
            return _note("near", table.column("block").to_pylist(), table.column("keys").to_pylist())
        table = table.sort_by("block")
        blocks = table.column("block").to_pylist()
        keys = [unsqueezed(k) for k in table.column("keys").to_pylist()]
        every = np.concatenate(keys)
        order = np.argsort(every, kind="stable")
        ordered = every[order]
        same = ordered[1:] == ordered[:-1]
        before = np.zeros(len(every), np.int32)
        before[order[:-1][same]] = 1
        before[order[1:][same]] = np.repeat(np.array(blocks, np.int32), [len(k) for k in keys])[order[:-1][same]] + 2
        out, where, at = [], [], 0
        for block, own in zip(blocks, keys, strict=True):
            mine = before[at : at + len(own)]
            at += len(own)
            if mine.any():
                where.append(block)
                out.append(packed(np.packbits(mine > 0)) if kind == "sample" else packed(mine))
        return _note(kind, where, out, bucket)

    return run


_NOTES = "block int, kind string, part string, pos int, first boolean, bucket int, bits binary"
_CHUNKS = "bucket int, block int, keys binary"


def repeated_bytes(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """docs without text plus n_bytes, n_removed, n_spans, kept_sha256 and spans (array of (start, stop) in bytes);
    with_text: plus text, the kept bytes (a cut-up character is dropped). One output row per input row.

    Removed is every byte inside a WINDOW-byte string that also starts anywhere else, in the same or another
    document. Null text: empty. Texts shorter than WINDOW: nothing removed. Repeated rows are copies of each other.
    Empty table: no rows. Input columns with the names of results are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(partitions(spark), -(-total // TASK_BYTES))
    samples = max(total * len(D) / V, 1)
    buckets = max(1, math.ceil(math.log2(max(2 * n, 8 * samples / BUCKET_BYTES))))
    bits = min(64, max(buckets + 8, math.ceil(math.log2(samples)) + 10))
    blocks = max(1, math.ceil(total / min(BLOCK_BYTES_MOST, max(BLOCK_BYTES, (8 << 10) << buckets))))
    # the bucketed table of blocks is in a database of its own, whose place is the shared folder
    database = f"lexledger_{uuid.uuid4().hex}"
    name = f"{database}.blocks"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{shared_dir(spark)}/{database}'")
    try:
        _deal(docs, blocks, n, name)
        copied = written(_copies(spark.table(name)), "copies")
        for seed in range(1, 100):
            found = _attempt(spark.table(name), copied, docs.schema, with_text, buckets, bits, n, seed)
            if found is not None:
                return found
        raise RuntimeError("different strings have had equal keys in every run")
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def _deal(docs: DataFrame, blocks: int, n: int, name: str) -> None:
    """Writes the table of blocks: packed rows, and the digests of the texts that can be removed as copies."""

    def deal(batches):
        task, made = TaskContext.get().partitionId(), 0
        pick = np.random.default_rng([task, 5])
        for batch in batches:
            to = pick.integers(0, blocks, batch.num_rows)
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
            hashes = [hashlib.sha256(t).digest() if len(t) >= WINDOW else None for t in texts]
            rows = {"block": [], "part": [], "packed": [], "hashes": []}
            for b in np.unique(to).tolist():
                at = np.nonzero(to == b)[0]
                sink = pa.BufferOutputStream()
                part = batch.take(pa.array(at))
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                    w.write_batch(part)
                rows["block"].append(b)
                rows["part"].append(f"{task}-{made}")
                rows["packed"].append(sink.getvalue().to_pybytes())
                rows["hashes"].append([hashes[k] for k in at])
                made += 1
            yield pa.RecordBatch.from_arrays([pa.array(rows["block"], pa.int32()), pa.array(rows["part"]), pa.array(rows["packed"], pa.binary()), pa.array(rows["hashes"], pa.list_(pa.binary()))], names=list(rows))

    dealt = docs.mapInArrow(deal, "block int, part string, packed binary, hashes array<binary>")
    dealt.repartition(n, "block").write.bucketBy(n, "block").option("compression", "none").saveAsTable(name)


def _copies(table: DataFrame) -> DataFrame:
    """Notes on texts that occur more than once. A block's copies of a text are one row until they have been counted,
    so that a text with very many copies is no hot key."""
    members = table.select("block", "part", F.posexplode("hashes").alias("pos", "hash")).where("hash IS NOT NULL")
    per_block = members.groupBy("block", "hash").agg(F.array_sort(F.collect_list(F.struct("part", "pos"))).alias("at"))
    first = F.min(F.struct("block", F.element_at("at", 1)["part"].alias("part"), F.element_at("at", 1)["pos"].alias("pos")))
    twice = per_block.groupBy("hash").agg(F.sum(F.size("at")).alias("c"), first.alias("one")).where("c > 1").select("hash", "one")
    each = per_block.join(twice, "hash").select("block", "one", F.explode("at").alias("x")).select("block", "one", "x.part", "x.pos")
    none = lambda kind: F.lit(None).cast(kind)
    return each.select("block", F.lit("copy").alias("kind"), "part", "pos", (F.struct("block", "part", "pos") == F.col("one")).alias("first"), none("int").alias("bucket"), none("binary").alias("bits"))


def _attempt(table: DataFrame, copied: DataFrame, schema: T.StructType, with_text: bool, buckets: int, bits: int, n: int, seed: int) -> DataFrame | None:
    """The result, or None if different strings had equal keys."""
    stored = table.select("block", "part", "packed")
    tools: list[Hasher] = []

    def opened(parts: pa.Table, side: pa.Table) -> tuple[int, Block]:
        if not tools:
            tools.append(Hasher(seed))
        return parts.column("block")[0].as_py(), Block(parts, side, tools[0])

    def sample_keys(parts: pa.Table, side: pa.Table) -> pa.Table:
        number, block = opened(parts, side)
        return _chunks(block.samples()[1], bits, buckets, number)

    def suffix_keys(parts: pa.Table, side: pa.Table) -> pa.Table:
        number, block = opened(parts, side)
        near, keys = block.candidates(bits, buckets)
        return _chunks(keys, 64, buckets, number, packed(ranges(near)))

    def send(parts: pa.Table, side: pa.Table) -> pa.Table:
        number, block = opened(parts, side)
        repeated, sent = block.repeats(buckets)
        return pa.concat_tables([_note("repeated", [number], [packed(ranges(repeated))]), _note("sent", list(sent), list(sent.values()))])

    names = [c for c in schema.names if c != "text"]
    added = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,stop:int>>" + ", text string" * with_text
    wrong = f"wrong_{uuid.uuid4().hex}"
    out_schema = T.StructType([*(schema[c] for c in names), *T.StructType.fromDDL(added).fields, T.StructField(wrong, T.BooleanType())])

    def cut(parts: pa.Table, side: pa.Table) -> pa.Table:
        _, block = opened(parts, side)
        right = block.confirmed()
        kept = []
        spans = block.spans()
        for text, gone in zip(block.texts, spans, strict=True):
            stops = [0, *(b for _, b in gone)]
            kept.append(b"".join(text[a:b] for a, b in zip(stops, [*(a for a, _ in gone), len(text)], strict=True)))
        columns = {c: block.table.column(c) for c in names}
        columns |= {
            "n_bytes": pa.array([len(t) for t in block.texts], pa.int64()),
            "n_removed": pa.array([len(t) - len(k) for t, k in zip(block.texts, kept, strict=True)], pa.int64()),
            "n_spans": pa.array([len(s) for s in spans], pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
            "spans": pa.array([[{"start": a, "stop": b} for a, b in s] for s in spans], pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
        }
        if with_text:
            columns["text"] = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())
        columns[wrong] = pa.array([None if right else True] * len(kept), pa.bool_())
        return pa.table(columns)

    def with_notes(side: DataFrame, run, out: T.StructType | str) -> DataFrame:
        grouped = stored.groupBy("block").cogroup(side.repartition(n, "block").groupBy("block"))
        return grouped.applyInArrow(run, out)

    notes = copied
    for kind, run in (("sample", sample_keys), ("suffix", suffix_keys)):
        chunks = with_notes(notes, run, _CHUNKS).repartition(n, "bucket")
        notes = copied.unionByName(written(chunks.groupBy("bucket").applyInArrow(_sort_bucket(kind), _NOTES), f"{kind}-ties"))
    notes = copied.unionByName(written(with_notes(notes, send, _NOTES), "repeats"))
    found = written(with_notes(notes, cut, out_schema), "kept")
    return found.drop(wrong) if found.where(F.col(wrong)).isEmpty() else None
