"""Bounded training samples: features are made on the executors, and only of sampled documents."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexledger.llm import linear


def smallest_hashes(df: DataFrame, rows: int, key: str = "doc_id") -> DataFrame:
    """At most ``rows`` rows, those whose key hashes smallest: the same ones however the table is partitioned."""
    return df.where(F.col(key).isNotNull()).orderBy(F.xxhash64(key), *sorted(df.columns)).limit(rows)


def view_features(texts: list[str | None], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, stems and binned shapes of texts as (rows, features), and the shapes themselves."""
    shape = linear.shapes(texts)
    rows, features = linear.text_features(texts, wanted)
    binned = [tuple(int(v * 25) for v in row) for row in shape]
    r, f = linear.column_features(binned)
    if wanted is not None:
        r, f = r[wanted[f]], f[wanted[f]]
    return np.concatenate([rows, r]), np.concatenate([features, f]), shape


def text_sample(docs: DataFrame, chosen: DataFrame, carried: list[str]) -> pa.Table:
    """features, shape and the carried columns of the documents in ``chosen`` (doc_id and other columns; at most some
    thousand rows, a bound of the caller's). The driver gets features, no texts."""
    rows = docs.join(F.broadcast(chosen), "doc_id").select("text", *carried)

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            rows_of, features, shape = view_features(texts)
            order = np.argsort(rows_of, kind="stable")
            edges = np.searchsorted(rows_of[order], np.arange(len(texts) + 1))
            features = features[order].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(features, pa.int32()))
            yield pa.RecordBatch.from_arrays([lists, pa.array(list(shape), pa.list_(pa.float64())), *(batch.column(c) for c in carried)], names=["features", "shape", *carried])

    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carried)
    table = rows.mapInArrow(run, f"features array<int>, shape array<double>, {fields}").toArrow()
    order = np.argsort([repr(r) for r in zip(*(table.column(c).to_pylist() for c in ("doc_id", *carried) if c in table.column_names), strict=True)], kind="stable")
    return table.take(pa.array(order))


def sparse(table: pa.Table) -> linear.Sparse:
    lists = table.column("features").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    dense = np.array(table.column("shape").to_pylist(), float).reshape(table.num_rows, len(linear.SHAPES))
    return linear.Sparse(np.repeat(np.arange(table.num_rows), sizes), lists.flatten().to_numpy().astype(np.int64), table.num_rows, dense)
