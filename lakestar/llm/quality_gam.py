"""Quality classifier: a generalised additive model with pairwise interactions over counts of the whole text.

Score = sigmoid(intercept + a table entry for each feature's bin + one for each chosen pair's cell). The tables are learned by cyclic boosting: round by
round, each feature in turn gets a shallow regression tree over its ordered bins, fitted to the log loss's gradient and added to its table with a small
rate; so no feature can take what others explain as well. Pairs are then ranked by how much a tree over their grid of coarse bins reduces what
the single tables leave, and the best are boosted the same way. Scoring is a lookup and an addition for each table, vectorised over a batch.

Learning reads a bounded sample: the SAMPLE distinct labelled texts with the smallest hashes (all, if fewer), of which only features and labels get
to the driver. Copies of a text count once, with their mean label; labels of one id too. Bins are quantiles of the sample, BINS at most.

Defined results: null and empty texts have all counts 0 and get a score like others; with nothing learned every score is 0.5; a feature that is the same in
all texts has a single bin; texts are scored one by one, so repeated rows get equal scores; null ids and null labels (or labels other than 0 and 1)
teach nothing; an empty table gives an empty result; columns named like the added ones give way.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sample_bound, sample_hash, ship, spare, with_columns, written

SAMPLE = 20_000
BINS, COARSE = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 300, 6
RATE, PENALTY, LEAF = 0.1, 2.0, 5
#: Leaves of a tree over bins.
LEAVES = 4

_PUNCTUATION = ".,;:!?'\"()-"
_CLASSES = [string.ascii_uppercase, string.digits, _PUNCTUATION, "!?", "".join(c for c in string.punctuation if c not in _PUNCTUATION), "\n"]
_TABLE = np.zeros((256, len(_CLASSES) + 1))
for _i, _c in enumerate(_CLASSES):
    _TABLE[[ord(x) for x in _c], _i] = 1
_TABLE[128:, -1] = 1
FEATURES = ["bytes", "words", "word_bytes", "distinct_words", "top_word", "lines", "distinct_lines", "capitals", "digits", "punctuation", "exclamations",
            "symbols", "line_feeds", "beyond_ascii"]
#: Bytes that are counted in one step.
STEP = 1 << 20


def features(text: str | None) -> list[float]:
    """The counts of a whole text, in the order of FEATURES; sizes as logarithms, others as shares."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words, lines = Counter(raw.split()), Counter(x for x in raw.split(b"\n") if x.strip())
    n_words, n_lines = words.total(), lines.total()
    seen = sum((np.bincount(np.frombuffer(raw[at:at + STEP], dtype=np.uint8), minlength=256) for at in range(0, len(raw), STEP)), np.zeros(256, dtype=np.int64))
    shares = seen @ _TABLE / max(1, len(raw))
    return [np.log1p(len(raw)), np.log1p(n_words), len(raw) / max(1, n_words), len(words) / max(1, n_words), max(words.values(), default=0) / max(1, n_words),
            np.log1p(n_lines), len(lines) / max(1, n_lines), *shares]


@dataclass
class Model:
    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0) for _ in FEATURES])
    tables: list[np.ndarray] = field(default_factory=lambda: [np.zeros(1) for _ in FEATURES])
    #: Two features' numbers, their coarse edges, the table of their cells.
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def logits(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.intercept)
        for column, edges, table in zip(rows.T, self.edges, self.tables):
            out += table[np.searchsorted(edges, column, side="right")]
        for a, b, edges_a, edges_b, table in self.pairs:
            out += table[np.searchsorted(edges_a, rows[:, a], side="right"), np.searchsorted(edges_b, rows[:, b], side="right")]
        return out

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(rows))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def quantile_edges(column: np.ndarray, bins: int) -> np.ndarray:
    """Where bins begin, but for the first: distinct quantiles above the smallest value."""
    cuts = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="higher")) if len(column) else np.zeros(0)
    return cuts[cuts > column.min()] if len(cuts) else cuts


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g ** 2 / (h + PENALTY)


def _best_cut(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of ordered bins in two, LEAF rows at least on either side; 0 where none helps."""
    if len(g) < 2:
        return 0.0, 0
    lg, lh, ln = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gains = _gain(lg, lh) + _gain(g.sum() - lg, h.sum() - lh) - _gain(g.sum(), h.sum())
    gains = np.where((ln >= LEAF) & (n.sum() - ln >= LEAF), gains, 0.0)
    at = int(gains.argmax())
    return float(gains[at]), at + 1


def tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """Step of each cell of a one- or two-dimensional grid (sums of gradients, curvatures, rows) under a tree of LEAVES leaves, and its gain."""
    leaves, total = [tuple(slice(0, k) for k in g.shape)], 0.0
    while len(leaves) < LEAVES:
        options = []
        for i, leaf in enumerate(leaves):
            for axis in range(g.ndim):
                flat = tuple(x[leaf].sum(axis=tuple(k for k in range(g.ndim) if k != axis)) for x in (g, h, n))
                gain, at = _best_cut(*flat)
                options.append((gain, -i, axis, at))
        gain, i, axis, at = max(options)
        if gain <= 1e-9:
            break
        leaf, cut = leaves.pop(-i), None
        cut = leaf[axis].start + at
        for part in (slice(leaf[axis].start, cut), slice(cut, leaf[axis].stop)):
            leaves.append(tuple(part if k == axis else s for k, s in enumerate(leaf)))
        total += gain
    out = np.zeros(g.shape)
    for leaf in leaves:
        out[leaf] = g[leaf].sum() / (h[leaf].sum() + PENALTY)
    return out, total


def learn(rows: np.ndarray, labels: np.ndarray) -> Model:
    """A model from features (a row for each text) and labels from 0 to 1."""
    model = Model()
    if not len(rows):
        return model
    share = (labels.sum() + 1) / (len(labels) + 2)
    model.intercept = float(np.log(share / (1 - share)))
    model.edges = [quantile_edges(c, BINS) for c in rows.T]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    if labels.min() == labels.max():
        return model
    bins = [np.searchsorted(e, c, side="right") for e, c in zip(model.edges, rows.T)]
    logits = np.full(len(rows), model.intercept)

    def grids(cell: np.ndarray, shape: tuple) -> tuple:
        p = sigmoid(logits)
        sums = (np.bincount(cell, w, minlength=int(np.prod(shape))).reshape(shape) for w in (labels - p, p * (1 - p)))
        return *sums, np.bincount(cell, minlength=int(np.prod(shape))).reshape(shape)

    for _ in range(ROUNDS):
        for own, table in zip(bins, model.tables):
            step = RATE * tree(*grids(own, table.shape))[0]
            table += step
            logits = logits + step[own]
    coarse = [quantile_edges(c, COARSE) for c in rows.T]
    own = [np.searchsorted(e, c, side="right") for e, c in zip(coarse, rows.T)]
    ranked = []
    for a, b in combinations(range(len(coarse)), 2):
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        if min(shape) > 1:
            ranked.append((-tree(*grids(own[a] * shape[1] + own[b], shape))[1], a, b))
    model.pairs = [(a, b, coarse[a], coarse[b], np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1))) for _, a, b in sorted(ranked)[:PAIRS]]
    cells = [own[a] * table.shape[1] + own[b] for a, b, _, _, table in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for cell, (*_, table) in zip(cells, model.pairs):
            step = RATE * tree(*grids(cell, table.shape))[0]
            table += step
            logits = logits + step.ravel()[cell]
    return model


def counts() -> Callable:
    """A column function text -> features."""
    @F.arrow_udf("array<double>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([features(x.as_py()) for x in texts], pa.list_(pa.float64()))

    return count


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """A model from the texts of ``docs`` that ``labels`` marks 0 or 1."""
    ship(docs.sparkSession)
    h = sample_hash(F.col("text"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label")).where("label in (0, 1)")
    marked = marked.groupBy("id").agg(F.avg("label").alias("label"))
    # Texts are joined by their hashes first; only those of the sample are read again.
    hashed = written(texts.select("id", h.alias("h")).join(marked, "id").groupBy("h").agg(F.min("id").alias("id"), F.avg("label").alias("label")), "gam-labelled")
    low = hashed.where(F.col("h") < sample_bound(SAMPLE, hashed.count())).orderBy("h").limit(SAMPLE)
    chosen = written(low, "gam-sample").withColumnRenamed("id", "chosen")
    found = texts.withColumn("own", h).join(chosen, (F.col("id") == F.col("chosen")) & (F.col("own") == F.col("h")))
    rows = found.groupBy("h").agg(F.min("text").alias("text"), F.min("label").alias("label")).select("h", counts()("text").alias("x"), "label").collect()
    rows.sort(key=lambda r: r["h"])
    return learn(np.array([r["x"] for r in rows], dtype=np.float64).reshape(-1, len(FEATURES)), np.array([r["label"] for r in rows], dtype=np.float64))


def scorer(model: Model) -> Callable:
    """A column function text -> score. ``model`` goes with it: some thousand numbers."""
    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = np.array([features(x.as_py()) for x in texts], dtype=np.float64).reshape(-1, len(FEATURES))
            yield pa.array(model.scores(rows))

    return score


def rate(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on)."""
    ship(docs.sparkSession)
    told = spare(docs, "told_quality")
    out = docs.withColumn(told, scorer(model)(F.col(text_col)))
    return with_columns(out, {"score": F.col(told), "predicted": (F.col(told) >= threshold).cast("int")}).drop(told)
