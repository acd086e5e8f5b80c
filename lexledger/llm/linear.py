"""Hashed text features and logistic models on them: fitted on a bounded sample, applied to every document."""

from __future__ import annotations

import numpy as np

#: Size of the hashed feature space.
BITS = 18
_BASE = 0x9E3779B97F4A7C15
_STEM = 5
#: Bytes of a word: ASCII letters in lower case, apostrophe and everything outside ASCII; the rest separates.
_WORD = np.zeros(256, np.uint8)
for _c in range(256):
    if _c >= 128 or chr(_c).isalpha() or _c == 39:
        _WORD[_c] = ord(chr(_c).lower()) if _c < 128 else _c
_TABLE = (np.random.default_rng(11).integers(0, 2**63, 256, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_SEGMENT = 1 << 20


def _powers(base: int) -> np.ndarray:
    x = np.full(_SEGMENT + 1, base, np.uint64)
    x[0] = 1
    return np.multiply.accumulate(x, out=x)


_UP, _DOWN = _powers(_BASE), _powers(pow(_BASE, -1, 2**64))


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h ^ np.uint64(salt)) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def _pieces(texts: list[bytes]):
    """(number of the text, bytes) in pieces of at most a segment, cut between words where there are any."""
    for k, t in enumerate(texts):
        a = 0
        while len(t) - a > _SEGMENT - 2:
            cut = t.rfind(b" ", a, a + _SEGMENT - 2)
            b = cut if cut > a else a + _SEGMENT - 2
            yield k, t[a:b]
            a = b
        yield k, t[a:]


def text_features(texts: list[str | None], wanted: np.ndarray | None = None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of the distinct words and word stems of each text, sorted. None or no words: nothing.
    wanted: marks the features to return; then only words with such a feature are gathered."""
    found, batch, size = [], [], 0
    raw = [(t or "").encode("utf-8", "replace") for t in texts]

    def flush():
        if not batch:
            return
        buf = _WORD[np.frombuffer(b"".join(t + b" " for _, t in batch), np.uint8)]
        ends_of = np.cumsum([len(t) + 1 for _, t in batch])
        word = buf > 0
        edge = np.diff(np.concatenate([[0], word.view(np.int8), [0]]))
        starts, stops = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
        sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_TABLE[buf] * _UP[: len(buf)], out=sums[1:])
        owner = np.array([k for k, _ in batch], np.int64)[np.searchsorted(ends_of, starts, side="right")]
        for salt, to in ((1, stops), (2, np.minimum(stops, starts + _STEM))):
            h = _mixed((sums[to] - sums[starts]) * _DOWN[starts], salt) >> np.uint64(64 - bits)
            h = h.astype(np.int64)
            k = slice(None) if wanted is None else wanted[h]
            found.append(np.unique((owner[k] << bits) | h[k]))
        batch.clear()

    for k, t in _pieces(raw):
        if size + len(t) + 1 > _SEGMENT:
            flush()
            size = 0
        batch.append((k, t))
        size += len(t) + 1
    flush()
    keys = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
    return keys >> bits, keys & ((1 << bits) - 1)


def column_features(values: list[tuple], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of the columns of each row: a feature for every (column, value)."""
    import xxhash

    at = [(r, xxhash.xxh3_64_intdigest(f"{c}={v!r}".encode("utf-8", "replace")) >> (64 - bits)) for r, row in enumerate(values) for c, v in enumerate(row)]
    a = np.array(at, np.int64).reshape(-1, 2)
    return a[:, 0], a[:, 1]


_KINDS = np.full(256, 0)
for _c in range(256):
    _KINDS[_c] = 1 if 65 <= _c <= 90 else 2 if 97 <= _c <= 122 or _c >= 128 else 3 if 48 <= _c <= 57 else 4 if _c in b" \t\r\n\x0b\x0c" else 5 if _c in b".,;:?'\"()-" else 6
#: Names of the columns of shapes().
SHAPES = ("upper", "letters", "digits", "blanks", "stops", "symbols", "distinct words", "words on a line", "word length", "log words", "repeats")


def shapes(texts: list[str | None]) -> np.ndarray:
    """What a text looks like, in eleven numbers; zeros for None and for texts without words."""
    out = np.zeros((len(texts), len(SHAPES)))
    for k, t in enumerate(texts):
        raw = (t or "").encode("utf-8", "replace")
        words = raw.split()
        if not words:
            continue
        kinds = np.bincount(_KINDS[np.frombuffer(raw, np.uint8)], minlength=7)[1:] / len(raw)
        again = sum(a == b for a, b in zip(words, words[1:], strict=False)) / len(words)
        out[k] = [*kinds, len(set(words)) / len(words) * min(1.0, len(words) / 50), min(len(words) / (raw.count(b"\n") + 1) / 50, 2.0), len(raw) / len(words) / 10, np.log1p(len(words)) / 5, again]
    return out


class Sparse:
    """Rows of binary features, with some dense columns."""

    def __init__(self, rows: np.ndarray, features: np.ndarray, n: int, dense: np.ndarray | None = None):
        self.rows, self.features, self.n = rows, features, n
        self.dense = np.zeros((n, 0)) if dense is None else dense

    def take(self, which: np.ndarray) -> Sparse:
        new = np.full(self.n, -1)
        new[which] = np.arange(len(which))
        keep = new[self.rows] >= 0
        return Sparse(new[self.rows[keep]], self.features[keep], len(which), self.dense[which])

    def scores(self, model: Model) -> np.ndarray:
        sums = np.bincount(self.rows, model.weights[self.features], minlength=self.n)[: self.n]
        return sums + self.dense @ model.dense + model.bias


class Model:
    def __init__(self, weights: np.ndarray, dense: np.ndarray, bias: float):
        self.weights, self.dense, self.bias = weights, dense, bias


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def telling(x: Sparse, y: np.ndarray, z: float, size: int) -> np.ndarray:
    """Marks the features whose rates in the two classes differ by z standard errors or more."""
    n1, n0 = max((y == 1).sum(), 1), max((y == 0).sum(), 1)
    both = np.bincount(x.features, minlength=size)
    one = np.bincount(x.features[y[x.rows] == 1], minlength=size)
    rate = (both + 1) / (n1 + n0 + 2)
    return (both >= 3) & (np.abs(one / n1 - (both - one) / n0) >= z * np.sqrt(rate * (1 - rate) * (1 / n1 + 1 / n0)))


def fit(x: Sparse, y: np.ndarray, weight: np.ndarray | None = None, penalty: float = 1e-3, steps: int = 200, rate: float = 0.3, z: float = 4.0, size: int = 1 << BITS) -> Model:
    """Logistic regression by adaptive gradient steps over all rows, on the features that tell the classes apart,
    with classes of equal weight. One class only: a model that gives its rate."""
    weight = np.ones(x.n) if weight is None else weight.astype(float)
    total = [weight[y == c].sum() for c in (0, 1)]
    if min(total) == 0:
        return Model(np.zeros(size), np.zeros(x.dense.shape[1]), 4.0 if total[1] > 0 else -4.0)
    weight = weight / np.where(y == 1, total[1], total[0]) / 2
    chosen = telling(x, y, z, size)
    at = chosen[x.features]
    rows, features = x.rows[at], np.searchsorted(np.nonzero(chosen)[0], x.features[at])
    w, d, b = np.zeros(int(chosen.sum())), np.zeros(x.dense.shape[1]), 0.0
    gw, gd, gb = np.full(len(w), 1e-8), np.full(len(d), 1e-8), 1e-8
    for _ in range(steps):
        score = np.bincount(rows, w[features], minlength=x.n) + x.dense @ d + b
        error = (sigmoid(score) - y) * weight
        for v, g, seen in ((w, np.bincount(features, error[rows], minlength=len(w)) + penalty * w, gw), (d, x.dense.T @ error + penalty * d, gd)):
            seen += g * g
            v -= rate * g / seen**0.5
        gb += error.sum() ** 2
        b -= rate * error.sum() / gb**0.5
    weights = np.zeros(size, np.float32)
    weights[chosen] = w
    return Model(weights, d, float(b))


def calibration(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn scores into log-odds (Platt scaling, with its smoothed targets)."""
    positive, negative = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    scale = score.std() or 1.0
    a, b = 1.0 / scale, 0.0
    for _ in range(50):  # Newton steps
        p = sigmoid(a * score + b)
        r, v = p - target, np.maximum(p * (1 - p), 1e-6)
        g = np.array([(r * score).sum() + 1e-3 * a, r.sum()])
        h = np.array([[(v * score * score).sum() + 1e-3, (v * score).sum()], [(v * score).sum(), v.sum()]])
        step = np.linalg.solve(h + 1e-9 * np.eye(2), g)
        a, b = a - step[0], b - step[1]
    return float(a), float(b)


def auc(score: np.ndarray, y: np.ndarray) -> float:
    """Chance that a positive scores above a negative; ties count half."""
    values, at, count = np.unique(score, return_inverse=True, return_counts=True)
    rank = (np.cumsum(count) - (count - 1) / 2)[at]
    n = int((y == 1).sum())
    return float((rank[y == 1].sum() - n * (n + 1) / 2) / max(n * (len(y) - n), 1))
