"""Document quality by co-training two views.

The text view sees words, stems and the shape of the text; the page-metadata view sees source, language and length.
Both start from labelled documents. In each round every document outside the labelled sample is scored by both views,
and either labels those that it is sure of for the other view: what the other learns from them is how often each of its
features occurs under either label, counted over all of them. At the end both views are calibrated on labelled
documents that neither was fitted on, and combined.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexledger.llm import linear, samples

#: Labelled documents that the models are fitted on, at most. Pseudo-labels come from all others, without a bound.
LABELLED = 6000
ROUNDS = 2
#: A view is sure of a document at this calibrated probability.
SURE = 0.95
#: Documents whose features are held at a time when all of them are counted.
ROWS = 2000
#: Features whose counts travel in one row.
BLOCK = 1 << 12
#: Documents are kept at this score.
KEEP_AT = 0.5
_METADATA = ("source", "lang", "n_chars")


def metadata_row(source: str | None, lang: str | None, n_chars: int | None) -> tuple:
    return source, lang, None if n_chars is None or n_chars < 0 else int(2 * math.log2(n_chars + 1)), (source, lang)


def metadata_view(columns: list[list]) -> linear.Sparse:
    rows = [metadata_row(*r) for r in zip(*columns, strict=True)]
    return linear.Sparse(*linear.column_features(rows), len(rows), np.zeros((len(rows), 0)))


class CoTrained:
    """Two calibrated views and their combination."""

    def __init__(self, views, combined):
        self.views, self.combined = views, combined

    def scores(self, text: linear.Sparse, meta: linear.Sparse) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of high quality: by both views together, by text, by metadata."""
        odds = [a * x.scores(m) + b for x, (m, (a, b)) in zip((text, meta), self.views, strict=True)]
        w, shift = self.combined
        return linear.sigmoid(np.stack(odds, 1) @ w + shift), linear.sigmoid(odds[0]), linear.sigmoid(odds[1])


#: Of a view: documents by pseudo-label (0, 1), and those that have each feature (a row for each label).
Counts = tuple[np.ndarray, np.ndarray]


def evidence(counts: Counts) -> np.ndarray:
    """Log-odds that each feature gives for label 1, of those whose rates differ by five standard errors or more."""
    n, have = counts
    rate = (have.sum(0) + 1) / (n.sum() + 2)
    apart = np.abs(have[1] / max(n[1], 1) - have[0] / max(n[0], 1)) >= 5 * np.sqrt(rate * (1 - rate) * (1 / max(n[0], 1) + 1 / max(n[1], 1)))
    odds = np.log((have[1] + 1) / (n[1] + 2)) - np.log((have[0] + 1) / (n[0] + 2))
    return np.where(apart & (have.sum(0) >= 3) & (n.min() > 0), odds, 0.0)


def _view(x: linear.Sparse, y: np.ndarray, counts: Counts | None) -> linear.Model:
    """A view's model. The sum of what the other view's pseudo-labels say of a row's features is one more column; how
    far to trust it is learned from the labelled rows. It is then folded into the features' weights."""
    odds = None if counts is None else evidence(counts)
    if odds is None or not odds.any():
        return linear.fit(x, y, z=5.0)
    said = np.bincount(x.rows, odds[x.features], minlength=x.n)[: x.n]
    scale = said.std() or 1.0
    model = linear.fit(linear.Sparse(x.rows, x.features, x.n, np.concatenate([x.dense, said[:, None] / scale], 1)), y, z=5.0)
    return linear.Model((model.weights + model.dense[-1] / scale * odds).astype(np.float32), model.dense[:-1], model.bias)


def co_train(views: list[linear.Sparse], y: np.ndarray, exchange: Callable[[list], list[Counts]], rounds: int = ROUNDS) -> CoTrained:
    """views: of labelled rows, y: their labels; every fourth row calibrates. exchange: counts for each view, by the
    labels that the other view of those given is sure of."""
    n = views[0].n
    held = np.arange(n) % 4 == 3
    if n < 8 or len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(n, bool)
    fit_on, check = np.nonzero(~held)[0], np.nonzero(held if held.any() else ~held)[0]

    def fitted(v: int, counts: Counts | None):
        model = _view(views[v].take(fit_on), y[fit_on], counts)
        return model, linear.calibration(views[v].take(check).scores(model), y[check])

    now = [fitted(0, None), fitted(1, None)]
    for _ in range(rounds):
        now = [fitted(v, c) for v, c in enumerate(exchange(now))]
    odds = np.stack([a * views[v].take(check).scores(m) + b for v, (m, (a, b)) in enumerate(now)], 1)
    w, shift = _combination(odds, y[check])
    return CoTrained(now, (w, shift))


def _combination(odds: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights, at least 0, of the views' log-odds, by Newton steps towards (1, 0) as a prior."""
    w = np.array([1.0, 0.0, 0.0])
    prior, x = w.copy(), np.concatenate([odds, np.ones((len(odds), 1))], 1)
    for _ in range(30):
        p = linear.sigmoid(x @ w)
        h = x.T @ (x * np.maximum(p * (1 - p), 1e-6)[:, None]) + np.eye(3)
        w = w - np.linalg.solve(h, x.T @ (p - y) + (w - prior))
    return np.maximum(w[:2], 0.0), float(w[2])


def views_of(batch: pa.RecordBatch, wanted: np.ndarray | None = None) -> list[linear.Sparse]:
    """The text view and the metadata view of a batch with text and _METADATA."""
    texts = batch.column("text").to_pylist()
    rows, features, shape = samples.view_features(texts, wanted)
    return [linear.Sparse(rows, features, len(texts), shape), metadata_view([batch.column(c).to_pylist() for c in _METADATA])]


def _summed(batches):
    """Adds up the rows of each view and block: a row for each."""
    have = {}
    for batch in batches:
        for view, block, feature, n0, n1 in zip(*(batch.column(c) for c in ("view", "block", "feature", "n0", "n1")), strict=True):
            sums = have.setdefault((view.as_py(), block.as_py()), np.zeros((2, BLOCK), np.int64))
            at = feature.values.to_numpy() % BLOCK  # no feature comes twice in a row
            sums[0, at] += n0.values.to_numpy()
            sums[1, at] += n1.values.to_numpy()
    for (view, block), sums in have.items():
        at = np.nonzero(sums.any(0))[0]
        yield _packed([view], [block], [at + block * BLOCK], [sums[0, at]], [sums[1, at]])


def _packed(view: list, block: list, *arrays: list[np.ndarray]) -> pa.RecordBatch:
    lists = [pa.array(x, pa.list_(kind)) for x, kind in zip(arrays, (pa.int32(), pa.int64(), pa.int64()), strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(view, pa.int32()), pa.array(block, pa.int32()), *lists], names=["view", "block", "feature", "n0", "n1"])


#: Of a view and a block: features, and the documents of either pseudo-label that have them.
_PACKED = "view int, block int, feature array<int>, n0 array<long>, n1 array<long>"


def task_counts(docs: DataFrame, views: list) -> DataFrame:
    """The counts of each task by the labels that the other view is sure of: a row for each block of features of which
    it has met any, however many these are, and one for the documents themselves (block -1, feature -1)."""
    size = 1 << linear.BITS

    def run(batches):
        seen, have = np.zeros((2, 2), np.int64), np.zeros((2, 2, size), np.int64)
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            both = views_of(batch)
            p = [linear.sigmoid(a * x.scores(m) + b) for x, (m, (a, b)) in zip(both, views, strict=True)]
            for v, x in enumerate(both):
                for label, sure in ((0, p[1 - v] <= 1 - SURE), (1, p[1 - v] >= SURE)):
                    seen[v, label] += sure.sum()
                    np.add.at(have[v, label], x.features[sure[x.rows]], 1)
        for v in (0, 1):
            at = np.nonzero(have[v].any(0))[0]
            blocks, starts = np.unique(at // BLOCK, return_index=True)
            cut = lambda x: np.split(x, starts[1:]) if len(x) else []  # noqa: B023, E731
            yield _packed([v] * (len(blocks) + 1), [-1, *blocks], [np.array([-1]), *cut(at)], *([seen[v, k : k + 1], *cut(have[v, k, at])] for k in (0, 1)))

    return docs.mapInArrow(run, _PACKED)


def pseudo_counts(docs: DataFrame, views: list) -> list[Counts]:
    """For each view the counts over all documents. Rows of a block are added up as they come; the driver gets a row for
    each block, with counts of 2 ** BITS features for a view at most."""
    size = 1 << linear.BITS
    got = task_counts(docs, views).repartition("view", "block").mapInArrow(_summed, _PACKED).toArrow()
    out = [(np.zeros(2), np.zeros((2, size))) for _ in (0, 1)]
    for row in got.to_pylist():
        n, have = out[row["view"]]
        for label, counts in enumerate((row["n0"], row["n1"])):
            if row["block"] < 0:
                n[label] = sum(counts)
            else:
                have[label, row["feature"]] = counts
    return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", labelled: int = LABELLED) -> CoTrained | None:
    """None without labels. labels: doc_id and a 0/1 column; null labels are not used. A document labelled twice is two
    training rows, and so is each of two documents with one id."""
    docs = docs.select("doc_id", "text", *_METADATA)
    known = labels.where(F.col(label).isNotNull()).select("doc_id", F.col(label).cast("int").alias("y"))
    marked = samples.smallest_hashes(known, labelled)
    got = samples.text_sample(docs, marked, ["doc_id", "y", *_METADATA])
    if not got.num_rows:
        return None
    rest = docs.join(F.broadcast(marked.select("doc_id").distinct()), "doc_id", "left_anti").select("text", *_METADATA)
    views = [samples.sparse(got), metadata_view([got.column(c).to_pylist() for c in _METADATA])]
    return co_train(views, got.column("y").to_numpy(), lambda now: pseudo_counts(rest, now))


def score(docs: DataFrame, model: CoTrained | None) -> DataFrame:
    """docs plus score, text_score, metadata_score (probabilities) and keep. Whole texts are looked at.

    Null or empty text scores as a text without words; null metadata is a value of its own. Without a model every
    score is null and everything is kept. Input columns with these names are replaced. Empty table: no rows.
    """
    added = ["score", "text_score", "metadata_score", "keep"]
    docs = docs.drop(*added)
    if model is None:
        return docs.select("*", *[F.lit(None).cast("double").alias(c) for c in added[:3]], F.lit(True).alias("keep"))
    schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL("score double, text_score double, metadata_score double, keep boolean").fields])

    def run(batches):
        wanted = model.views[0][0].weights != 0
        for batch in batches:
            both, text, meta = model.scores(*views_of(batch, wanted))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x) for x in (both, text, meta)), pa.array(both >= KEEP_AT)], names=schema.names)

    return docs.mapInArrow(run, schema)
