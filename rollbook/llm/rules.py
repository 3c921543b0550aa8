"""Quality of texts by a sparse ensemble of rules over statistics.

1. One pass over the texts gives each document's statistics (shares of character
   classes, words, lines), which are written.
2. On a sample of at most about ``SAMPLE_ROWS`` labelled rows (the classifier's
   documented bound), drawn by the hash of their id, small trees are boosted; every path from a root to a node is a rule,
   a conjunction of bounds on statistics.
3. A lasso logistic regression gives most rules no weight.
4. The rules left are compiled into Spark column expressions, so scoring is a projection.

Null and empty texts have zero statistics and are scored like all others.  Labels other
than 0 and 1 and labels without a document teach nothing; a document with several
labels counts with each.  With one class only, the score is that class's smoothed
share; without labels it is 0.5.  Very long texts are read whole; an empty table gives no
rows; columns named like statistics are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.llm.arrowtext import buffers, slices, texts

SAMPLE_ROWS = 10_000
TREES = 30
DEPTH = 3
BINS = 32
LEAST_ROWS = 8

#: Character classes by ASCII bytes; bytes from 0x80 are of no class. Fixed values.
CLASSES = {
    "letters": b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "capitals": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digits": b"0123456789",
    "stops": b".,;:?'\"()-",
    "marks": b"!",
    "signs": b"#$%&*+/<=>@[\\]^_`{|}~",
    "spaces": b" \t\r\n",
}
STATISTICS = (
    "log_bytes", "log_words", "log_lines", *(f"share_{c}" for c in CLASSES), "share_other",
    "word_bytes", "longest_word", "share_different_words", "share_short_words", "share_different_lines",
    "line_bytes", "words_a_stop",
)


def statistics(flat: np.ndarray, offsets: np.ndarray, docs: list[str]) -> np.ndarray:
    """A row of statistics for each text; 0 where nothing is there to divide by."""
    size = np.diff(offsets).astype(np.float64)

    def counts(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return np.diff(total[offsets]).astype(np.float64)

    def over(a, b) -> np.ndarray:
        return np.divide(a, b, out=np.zeros(len(size)), where=b > 0)

    by_class = {}
    for name, members in CLASSES.items():
        table = np.zeros(256, dtype=bool)
        table[list(members)] = True
        by_class[name] = counts(table[flat])
    words = [x.split() for x in docs]
    n = np.array(list(map(len, words)), dtype=np.float64)
    lengths = [np.fromiter(map(len, w), np.int64, len(w)) for w in words]
    lines = [x.split("\n") if x else [] for x in docs]
    n_lines = np.array(list(map(len, lines)), dtype=np.float64)
    columns = [
        np.log1p(size), np.log1p(n), np.log1p(n_lines),
        *(over(c, size) for c in by_class.values()),
        over(counts(flat >= 0x80), size),
        over(size - by_class["spaces"], n),
        np.array([w.max() if len(w) else 0 for w in lengths], dtype=np.float64),
        over(np.array([len(set(w)) for w in words], dtype=np.float64), n),
        over(np.array([(w <= 3).sum() for w in lengths], dtype=np.float64), n),
        over(np.array([len(set(x)) for x in lines], dtype=np.float64), n_lines),
        over(size, n_lines),
        over(n, by_class["stops"]),
    ]
    return np.column_stack(columns)


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without its text, with the statistics as columns of their names (which replace such columns)."""
    kept = [f for f in df.schema.fields if f.name not in (text, *STATISTICS)]
    schema = T.StructType([*kept, *(T.StructField(c, T.DoubleType(), False) for c in STATISTICS)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                found = statistics(*buffers(part, text), texts(part, text))
                columns = [np.ascontiguousarray(found[:, k]) for k in range(len(STATISTICS))]
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), *map(pa.array, columns)], names=schema.names)

    return df.mapInArrow(work, schema)


# ---------------------------------------------------------------- learning

#: (statistic, "above" or "upto", bound)
Bound = tuple[str, str, float]


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    rules: tuple[tuple[tuple[Bound, ...], float], ...] = field(default_factory=tuple)

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for bounds, weight in self.rules:
            holds = F.lit(True)
            for name, side, bound in bounds:
                holds = holds & (F.col(name) > bound if side == "above" else F.col(name) <= bound)
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def bin_edges(x: np.ndarray) -> list[np.ndarray]:
    """Bounds to split each statistic at: between neighbouring quantiles, shortened to few digits."""
    edges = []
    for column in x.T:
        q = np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)))
        edges.append(np.unique((q[:-1] + q[1:]) / 2))
    return edges


def tree_rules(bins: np.ndarray, edges, gradient: np.ndarray, rows: np.ndarray) -> tuple[list, np.ndarray]:
    """Grows one regression tree on the gradient: its paths, and its prediction for all rows."""
    fitted, paths = np.zeros(len(bins)), []

    def grow(own: np.ndarray, every: np.ndarray, path: tuple, depth: int) -> None:
        fitted[every] = gradient[own].mean() if len(own) else 0.0
        if path:
            paths.append(path)
        if depth == DEPTH or len(own) < 2 * LEAST_ROWS:
            return
        best = (1e-9, None, None)
        total, n = gradient[own].sum(), len(own)
        for k, edge in enumerate(edges):
            if not len(edge):
                continue
            width = len(edge) + 1
            count = np.bincount(bins[own, k], minlength=width)[:-1].cumsum()
            sums = np.bincount(bins[own, k], weights=gradient[own], minlength=width)[:-1].cumsum()
            ok = (count >= LEAST_ROWS) & (n - count >= LEAST_ROWS)
            gain = np.where(ok, sums**2 / np.maximum(count, 1) + (total - sums) ** 2 / np.maximum(n - count, 1) - total**2 / n, 0)
            if gain.max() > best[0] * (1 + 1e-12):
                best = (gain.max(), k, int(gain.argmax()))
        _, k, cut = best
        if k is None:
            return
        for side in ("upto", "above"):
            part = lambda r: r[(bins[r, k] <= cut) == (side == "upto")]
            grow(part(own), part(every), (*path, (k, side, cut)), depth + 1)

    grow(rows, np.arange(len(bins)), (), 0)
    return paths, fitted


def lasso_logistic(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 250) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient; the intercept is not penalised."""
    n, m = x.shape
    scale = np.linalg.norm(np.column_stack([np.ones(n), x]), 2) ** 2 / (4 * n) + 1e-9
    w = v = np.zeros(m + 1)
    w[0] = v[0] = np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    t = 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(v[0] + x @ v[1:], -30, 30)))
        gradient = np.concatenate([[(p - y).mean()], x.T @ (p - y) / n])
        new = v - gradient / scale
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - penalty / scale, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return float(w[0]), w[1:]


def fit(x: np.ndarray, y: np.ndarray, names=STATISTICS, seed: int = 7) -> RuleEnsemble:
    """Rules and weights from rows of statistics and labels 0 or 1."""
    if not len(y):
        return RuleEnsemble(0.0)
    share = (y.sum() + 1) / (len(y) + 2)
    if y.min() == y.max():
        return RuleEnsemble(float(np.log(share / (1 - share))))
    draw = np.random.default_rng(seed)
    edges = bin_edges(x)
    bins = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)])
    raw, paths = np.full(len(y), np.log(share / (1 - share))), {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        rows = np.sort(draw.permutation(len(y))[: max(2 * LEAST_ROWS, len(y) * 2 // 3)])
        found, fitted = tree_rules(bins, edges, y - p, rows)
        raw = raw + 0.5 * fitted / max((p * (1 - p)).mean(), 1e-3)
        paths.update(dict.fromkeys(tuple(sorted(path)) for path in found))
    matrix, kept = [], {}
    for path in paths:
        holds = np.ones(len(y), dtype=bool)
        for k, side, cut in path:
            holds &= (bins[:, k] <= cut) == (side == "upto")
        if (key := holds.tobytes()) not in kept and 0 < holds.sum() < len(y):
            kept[key] = path
            matrix.append(holds)
    if not matrix:
        return RuleEnsemble(float(np.log(share / (1 - share))))
    rules, test = np.column_stack(matrix).astype(np.float64), draw.random(len(y)) < 0.25
    best = (np.inf, 0.0)
    for penalty in (3e-3, 1e-3, 3e-4):
        if test.all() or not test.any() or len(np.unique(y[~test])) < 2:
            best = (0.0, 1e-3)
            break
        a, w = lasso_logistic(rules[~test], y[~test], penalty, 120)
        p = np.clip(1 / (1 + np.exp(-(a + rules[test] @ w))), 1e-6, 1 - 1e-6)
        loss = -(y[test] * np.log(p) + (1 - y[test]) * np.log(1 - p)).mean()
        best = min(best, (loss, penalty))
    intercept, weights = lasso_logistic(rules, y, best[1])
    chosen = []
    for path, weight in zip(kept.values(), weights, strict=True):
        if abs(weight) > 1e-4:
            chosen.append((tuple((names[k], side, float(edges[k][cut])) for k, side, cut in path), float(weight)))
    return RuleEnsemble(intercept, tuple(chosen))


def trained(stats: DataFrame, label: str, rows: int = SAMPLE_ROWS, seed: int = 7, key: str = "doc_id") -> RuleEnsemble:
    """An ensemble from a sample of the rows of ``stats`` whose ``label`` is 0 or 1.

    The sample follows from the keys, so other partitions of the same rows fit the same rules.
    """
    labelled = stats.filter(F.col(label).isin(0, 1))
    total, parts = labelled.count(), 1 << 30
    drawn = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(parts)) < parts * min(rows, max(total, 1)) // max(total, 1)
    found = labelled.filter(drawn).select(*STATISTICS, F.col(label).cast("double").alias("y_")).toPandas()
    found = found.sort_values(list(found.columns))  # the same model whatever the order
    return fit(found[list(STATISTICS)].to_numpy(), found["y_"].to_numpy())
