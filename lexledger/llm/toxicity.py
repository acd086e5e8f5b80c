"""Toxicity by a classifier chain.

One linear model for each category, in order; each sees the text and the probabilities of the categories before it.
Those probabilities are out-of-fold in training, so that later models learn how far to trust them.

Where the label table tells several categories, they are the chain's. Where it has one flag only, two kinds of toxic
documents are learned from the flagged ones: clusters of their telling features. They serve the flag, the chain's last
category.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexledger.llm import linear, samples

#: Labelled documents that the models are fitted on, at most.
LABELLED = 12_000
FOLDS = 3
FLAG_AT = 0.5
#: Kinds that are learned for a single flag, and the features by which they are told apart, at most.
KINDS, KIND_FEATURES = 2, 1000
FLAG = "toxic"
CATEGORIES = (*(f"kind_{k + 1}" for k in range(KINDS)), FLAG)


def kinds(x: linear.Sparse, flag: np.ndarray, count: int = KINDS, features: int = KIND_FEATURES) -> np.ndarray:
    """A 0/1 column for each kind: clusters, the largest first, of the flagged rows by the features that tell flagged
    rows from others. Spherical k-means, from equal parts along the rows' main direction."""
    out = np.zeros((x.n, count), int)
    rows = np.nonzero(flag == 1)[0]
    size = 1 << linear.BITS
    chosen = np.nonzero(linear.telling(x, flag, 4.0, size))[0]
    share = np.bincount(x.features, flag[x.rows], minlength=size)[chosen] / np.maximum(np.bincount(x.features, minlength=size)[chosen], 1)
    chosen = np.sort(chosen[np.argsort(-share, kind="stable")][:features])  # of those, the ones most of whose rows are flagged
    if len(rows) < count or not len(chosen):
        return out
    place, column = np.full(x.n, -1), np.full(size, -1)
    place[rows], column[chosen] = np.arange(len(rows)), np.arange(len(chosen))
    at = (place[x.rows] >= 0) & (column[x.features] >= 0)
    m = np.zeros((len(rows), len(chosen)), np.float32)
    m[place[x.rows[at]], column[x.features[at]]] = 1
    m *= np.log((1 + len(rows)) / (1 + m.sum(0)))  # what all flagged rows share tells no kind
    m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)
    main = np.linalg.eigh((c := m - m.mean(0)).T @ c)[1][:, -1]
    along = m @ (main * np.sign(main[np.argmax(np.abs(main))]))
    kind = np.argsort(np.argsort(along, kind="stable")) * count // len(rows)
    centres = np.zeros((count, m.shape[1]), np.float32)
    for _ in range(20):
        centres = np.array([m[kind == k].sum(0) if (kind == k).any() else centres[k] for k in range(count)])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
        kind = np.argmax(m @ centres.T, axis=1)
    order = np.argsort(-np.bincount(kind, minlength=count), kind="stable")
    for k in range(count):
        out[rows[kind == order[k]], k] = 1
    return out


class Chain:
    def __init__(self, names: tuple[str, ...], links: list):
        self.names, self.links = names, links

    def wanted(self) -> np.ndarray:
        return np.any([m.weights != 0 for m, _ in self.links], axis=0)

    def probabilities(self, x: linear.Sparse) -> np.ndarray:
        out = np.zeros((x.n, 0))
        for model, (a, b) in self.links:
            p = linear.sigmoid(a * linear.Sparse(x.rows, x.features, x.n, np.concatenate([x.dense, out], 1)).scores(model) + b)
            out = np.concatenate([out, p[:, None]], 1)
        return out


def fit_chain(x: linear.Sparse, y: np.ndarray, names: tuple[str, ...] = CATEGORIES, folds: int = FOLDS) -> Chain:
    """y: a column of 0/1 for each name, in the chain's order."""
    earlier, links = np.zeros((x.n, 0)), []
    fold = np.arange(x.n) % folds
    for k in range(y.shape[1]):
        seen = linear.Sparse(x.rows, x.features, x.n, np.concatenate([x.dense, earlier], 1))
        out = np.zeros(x.n)
        for f in range(folds):
            on, off = np.nonzero(fold != f)[0], np.nonzero(fold == f)[0]
            if len(on) and len(off):
                out[off] = seen.take(off).scores(linear.fit(seen.take(on), y[on, k]))
        scale = linear.calibration(out, y[:, k])
        links.append((linear.fit(seen, y[:, k]), scale))
        earlier = np.concatenate([earlier, linear.sigmoid(scale[0] * out + scale[1])[:, None]], 1)
    return Chain(names, links)


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, categories: tuple[str, ...] = (FLAG,)) -> Chain | None:
    """labels: doc_id and 0/1 columns, the categories, of which the last is the flag; a single one gets kinds before it.

    None without labels. Rows with a null among their labels are not used; a document labelled twice is two training
    rows, and so is each of two documents with one id.
    """
    known = labels.dropna(subset=list(categories)).select("doc_id", *[F.col(c).cast("int").alias(c) for c in categories])
    got = samples.text_sample(docs.select("doc_id", "text"), samples.smallest_hashes(known, labelled), ["doc_id", *categories])
    if not got.num_rows:
        return None
    x, y = samples.sparse(got), np.stack([got.column(c).to_numpy() for c in categories], 1)
    if len(categories) > 1:
        return fit_chain(x, y, categories)
    return fit_chain(x, np.concatenate([kinds(x, y[:, 0]), y], 1), (*CATEGORIES[:-1], *categories))


def score(docs: DataFrame, chain: Chain | None) -> DataFrame:
    """docs plus a probability p_<category> for each category and flagged (the last one at FLAG_AT or more).

    Whole texts are looked at. Null or empty text scores as a text without words. Without a model: nulls, not
    flagged. Input columns with these names are replaced. Empty table: no rows.
    """
    names = [f"p_{c}" for c in (chain.names if chain else CATEGORIES)]
    docs = docs.drop(*names, "flagged")
    if chain is None:
        return docs.select("*", *[F.lit(None).cast("double").alias(c) for c in names], F.lit(False).alias("flagged"))
    schema = T.StructType([*docs.schema.fields, *[T.StructField(c, T.DoubleType()) for c in names], T.StructField("flagged", T.BooleanType())])

    def run(batches):
        wanted = chain.wanted()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            rows, features, shape = samples.view_features(texts, wanted)
            p = chain.probabilities(linear.Sparse(rows, features, len(texts), shape))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(np.ascontiguousarray(p[:, k])) for k in range(p.shape[1])), pa.array(p[:, -1] >= FLAG_AT)], names=schema.names)

    return docs.mapInArrow(run, schema)
