"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees, boosted in a cycle over the features, add up to one lookup table for each
feature; a second cycle does the same for the pairs of features whose joint table explains
most of what is left. Scoring a text is a sum of table entries, taken for a whole Arrow
batch at once, so the score needs no shuffle.

Null or empty texts have zero in each feature and get a score like any other text. Without
labelled rows the score is 0.5 throughout; with one class only it is near that class.
Labels that are null, repeated or contradictory: null ones are left out, a repeated pair
counts once, contradictory ones count each.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postmill.llm.common import as_bytes

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "distinct_words", "upper", "digits", "spaces", "high_bytes", "stops", "bangs",
    "bars", "symbols", "line_bytes", "distinct_lines", "short_words", "long_words", "commas", "top_word", "repeats",
)
SYMBOLS = b"#$%&*@^~<>{}[]\\=+_`"


def text_features(texts: list[bytes]) -> np.ndarray:
    """One row of FEATURES for each whole text."""
    out = np.zeros((len(texts), len(FEATURES)), np.float64)
    symbols = np.frombuffer(SYMBOLS, np.uint8)
    for row, text in enumerate(texts):
        if not text:
            continue
        n, byte = len(text), np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        words, lines = text.split(), text.split(b"\n")
        k = max(1, len(words))
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        seen: dict[bytes, int] = {}
        for w in words:
            seen[w] = seen.get(w, 0) + 1
        pairs = len(set(zip(words, words[1:], words[2:])))
        letters = byte[65:91].sum() + byte[97:123].sum() + byte[128:].sum()
        out[row] = (
            np.log1p(n), np.log1p(len(words)), lengths.sum() / k, len(seen) / k, byte[65:91].sum() / max(1, letters), byte[48:58].sum() / n,
            byte[32] / n, byte[128:].sum() / n, byte[46] / k, byte[33] / k, byte[124] / k, byte[symbols].sum() / n,
            n / len(lines), len(set(lines)) / len(lines), (lengths <= 3).sum() / k, (lengths >= 9).sum() / k, byte[44] / k,
            max(seen.values(), default=0) / k, 1 - pairs / max(1, len(words) - 2) if len(words) > 2 else 0,
        )
    return out


@dataclass
class Gam:
    """Lookup tables: `single[f]` over the bins of feature f, `double[(f, g)]` over two coarser ones."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    single: list[np.ndarray] = field(default_factory=list)
    double: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1, by additions of table entries."""
        total = np.full(len(x), self.base)
        for f, table in enumerate(self.single):
            total += table[np.searchsorted(self.edges[f], x[:, f], side="right")]
        for (f, g), table in self.double.items():
            total += table[np.searchsorted(self.coarse[f], x[:, f], side="right"), np.searchsorted(self.coarse[g], x[:, g], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    at = np.unique(np.quantile(values, np.arange(1, bins) / bins, method="lower"))
    return at[at > values.min()] if len(at) else at


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Values by bin of a tree with at most `leaves` leaves, split where the gain is best."""
    out, parts = np.zeros(len(g)), [(0, len(g))]
    gain_of = lambda a, b: a * a / (b + ridge)
    while len(parts) < leaves:
        best = (1e-9, 0, 0)
        for k, (lo, hi) in enumerate(parts):
            if hi - lo < 2:
                continue
            left_g, left_h = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
            all_g, all_h = g[lo:hi].sum(), h[lo:hi].sum()
            gain = gain_of(left_g, left_h) + gain_of(all_g - left_g, all_h - left_h) - gain_of(all_g, all_h)
            j = int(gain.argmax())
            if gain[j] > best[0]:
                best = (float(gain[j]), k, lo + j + 1)
        if not best[2]:
            break
        lo, hi = parts.pop(best[1])
        parts += [(lo, best[2]), (best[2], hi)]
    for lo, hi in parts:
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + ridge)
    return out


def _tree2(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    """The same over two features: one cut of the first and, on each side, one of the second."""
    best, best_gain = np.full(g.shape, g.sum() / (h.sum() + ridge)), -1.0
    for axis in (0, 1):
        a, b = (g, h) if axis == 0 else (g.T, h.T)
        for at in range(1, len(a)):
            out, gain = np.zeros(a.shape), 0.0
            for part in (slice(0, at), slice(at, None)):
                sg, sh = a[part].sum(0), b[part].sum(0)
                values = _tree(sg, sh, 2, ridge)
                out[part] = values
                gain += (values * sg).sum()
            if gain > best_gain:
                best, best_gain = (out if axis == 0 else out.T), gain
    return best


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.15, bins: int = 32, pairs: int = 6, pair_rounds: int = 25, ridge: float = 2.0) -> Gam:
    """The model of rows x with labels y (0 or 1). The same rows in the same order give the same model."""
    n = len(y)
    if not n:
        return Gam()
    rate_1 = (y.sum() + 0.5) / (n + 1)
    model = Gam(base=float(np.log(rate_1 / (1 - rate_1))))
    if len(np.unique(y)) < 2:
        return model
    model.edges = [_cuts(x[:, f], bins) for f in range(x.shape[1])]
    model.coarse = [_cuts(x[:, f], 8) for f in range(x.shape[1])]
    fine = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.edges)]
    rough = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.coarse)]
    model.single = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(n, model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f, at in enumerate(fine):
            g, h = slopes()
            k = len(model.single[f])
            step = rate * _tree(np.bincount(at, g, k), np.bincount(at, h, k), 3, ridge)
            model.single[f] += step
            total += step[at]
    g, h = slopes()
    gains = []
    for f, k in combinations(range(x.shape[1]), 2):
        shape = (len(model.coarse[f]) + 1, len(model.coarse[k]) + 1)
        at = rough[f] * shape[1] + rough[k]
        sg, sh = np.bincount(at, g, shape[0] * shape[1]), np.bincount(at, h, shape[0] * shape[1])
        gains.append((-float((sg * sg / (sh + 4 * ridge)).sum()), f, k, shape))
    chosen = [(f, k, shape) for _, f, k, shape in sorted(gains)[:pairs]]
    for f, k, shape in chosen:
        model.double[f, k] = np.zeros(shape)
    for _ in range(pair_rounds):
        for f, k, shape in chosen:
            g, h = slopes()
            at = rough[f] * shape[1] + rough[k]
            step = rate * _tree2(np.bincount(at, g, shape[0] * shape[1]).reshape(shape), np.bincount(at, h, shape[0] * shape[1]).reshape(shape), ridge)
            model.double[f, k] += step
            total += step[rough[f], rough[k]]
    return model


def held_out(doc_id: str | F.Column = "doc_id"):
    """Whether a row is kept from training: crc32 of the id as text (null: empty) mod 3 is 1."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, label: str = "quality", **options) -> Gam:
    """The model fitted on at most `max_rows` labelled rows, the first by a hash of their id.

    The bound keeps what the driver gets, and the broadcast list of ids, at a fixed size.
    """
    picked = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out())
        .select(F.col("doc_id"), F.col(label).cast("int").alias("y"))
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "y")
        .limit(max_rows)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id", "y").agg(F.min(features_of(F.col("text"))).alias("x"))
    got = rows.toArrow().sort_by([("doc_id", "ascending"), ("y", "ascending")])
    if not got.num_rows:
        return Gam()
    x = np.array(got.column("x").to_pylist(), np.float64)
    return fit(x, got.column("y").to_numpy().astype(np.float64), **options)


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def features_of(text: pa.Array) -> pa.Array:
    x = text_features(as_bytes(text))
    return pa.ListArray.from_arrays(np.arange(0, x.size + 1, len(FEATURES), dtype=np.int32), pa.array(x.ravel()))


def score_column(model: Gam, text: str = "text"):
    """A column with the model's score of each whole text."""

    @F.arrow_udf(T.DoubleType())
    def score(column: pa.Array) -> pa.Array:
        return pa.array(model.score(text_features(as_bytes(column))))

    return score(F.col(text))


def score_quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of docs; see the module's text."""
    model = learn(docs, labels, **options)
    return docs.select("doc_id", held_out().alias("held_out"), score_column(model).alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
