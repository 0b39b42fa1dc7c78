"""Quality classifier: regularised quadratic discriminant over document statistics.

One pass turns every text into transformed statistics. Class moments are summed on the executors,
the shrunken covariances are factored once, and the score compares the two log densities
through the Mahalanobis distances that the cached Cholesky factors give.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from tidewater.llm.shared import fold, only, rows_of
from tidewater.session import settle

#: Statistics in the order in which ``statistics`` gives them.
NAMES = (
    "chars", "words", "word_length", "word_spread", "upper", "digits", "symbols", "stops", "blanks", "beyond_ascii",
    "line_repeats", "vocabulary", "top_word", "line_words", "letterless", "entropy", "short_words", "closed_lines",
    "one_case_words", "word_bigram_repeats",
)
#: Shares of the class covariance that are replaced by the pooled one, and of that by its diagonal.
TO_POOLED, TO_DIAGONAL = 0.5, 0.05
#: Least variance of a statistic, in its own units, and temper of the log-density difference.
FLOOR, TEMPER = 1e-4, 0.2

_KIND = np.zeros(256, np.uint8)  # 0 other, 1 upper, 2 lower, 3 digit, 4 stop, 5 symbol, 6 blank, 7 beyond ASCII
_KIND[65:91], _KIND[97:123], _KIND[48:58] = 1, 2, 3
for _c in b"!\"#$%&'()*+-/:;<=>?@[\\]^_`{|}~":
    _KIND[_c] = 5
for _c in b".,":
    _KIND[_c] = 4
for _c in b" \t\n\v\f\r":
    _KIND[_c] = 6
_KIND[128:] = 7


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of a whole text: logarithms of sizes, roots of shares; all 0 without text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * len(NAMES)
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    kinds = np.bincount(_KIND, weights=seen, minlength=8)
    n = len(raw)
    words = raw.split()
    lines = raw.split(b"\n")
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    counts = Counter(words)
    n_words = max(1, len(words))
    closed = sum(line.rstrip().endswith((b".", b"!", b"?")) for line in lines)
    p = seen[seen > 0] / n
    pairs = len(set(zip(words, words[1:])))
    cased = sum(w.isupper() for w in counts)
    return [
        np.log1p(n),
        np.log1p(len(words)),
        np.log1p(lengths.mean()) if len(words) else 0.0,
        np.log1p(lengths.std()) if len(words) else 0.0,
        np.sqrt(kinds[1] / n),
        np.sqrt(kinds[3] / n),
        np.sqrt(kinds[5] / n),
        np.sqrt(kinds[4] / n),
        np.sqrt(kinds[6] / n),
        np.sqrt(kinds[7] / n),
        np.sqrt(1 - len(set(lines)) / len(lines)),
        np.log1p(len(counts)) / np.log1p(n_words),
        np.sqrt(max(counts.values(), default=0) / n_words),
        np.log1p(n_words / len(lines)),
        np.sqrt(sum(c for w, c in counts.items() if not w.lower() != w.upper()) / n_words),
        float(-(p * np.log2(p)).sum()),
        np.sqrt((lengths <= 3).sum() / n_words),
        np.sqrt(closed / len(lines)),
        np.sqrt(cased / max(1, len(counts))),
        np.sqrt(1 - pairs / max(1, len(words) - 1)) if len(words) > 1 else 0.0,
    ]


def _described(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows_of(batches):
        rows = np.array([statistics(t) for t in batch["text"].to_pylist()], float).reshape(-1, len(NAMES))
        columns = [pa.array(np.ascontiguousarray(rows[:, k])) for k in range(len(NAMES))]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], names=["doc_id", *NAMES])


def described(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of every document."""
    schema = "doc_id long, " + ", ".join(f"{n} double" for n in NAMES)
    return only(docs, doc_id="long", text="string").mapInArrow(_described, schema)


@dataclass(frozen=True)
class Discriminant:
    """Per class: prior, mean, Cholesky factor and log determinant of the shrunken covariance."""

    priors: tuple[float, float]
    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray
    temper: float = TEMPER

    def score(self, x: np.ndarray) -> np.ndarray:
        """Share of class 1, from the tempered difference of log densities and the log odds of the priors."""
        density = []
        for k in (0, 1):
            z = np.linalg.solve(self.factors[k], (x - self.means[k]).T)
            density.append(-0.5 * ((z * z).sum(axis=0) + self.log_dets[k]))
        odds = self.temper * (density[1] - density[0]) + np.log(self.priors[1] / self.priors[0])
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def discriminant(counts, sums, products, to_pooled=TO_POOLED, to_diagonal=TO_DIAGONAL, temper=TEMPER) -> Discriminant | None:
    """Fit from class counts, sums and sums of products; None unless both classes occur."""
    if min(counts) < 1:
        return None
    means = np.array([s / c for s, c in zip(sums, counts)])
    scatter = [p - c * np.outer(m, m) for p, c, m in zip(products, counts, means)]
    floor = FLOOR * np.eye(len(means[0]))
    pooled = sum(scatter) / sum(counts) + floor
    target = (1 - to_diagonal) * pooled + to_diagonal * np.diag(np.diag(pooled))
    factors = [
        np.linalg.cholesky((1 - to_pooled) * (s / c + floor) + to_pooled * target) for s, c in zip(scatter, counts)
    ]
    log_dets = np.array([2 * np.log(np.diag(f)).sum() for f in factors])
    total = sum(counts)
    return Discriminant((counts[0] / total, counts[1] / total), means, np.array(factors), log_dets, temper)


def _moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    d = len(NAMES)
    total = np.zeros((2, 1 + d + d * d))
    for batch in batches:
        label = batch["label"].to_numpy()
        x = np.stack([batch[n].to_numpy() for n in NAMES], 1)
        for k in (0, 1):
            own = x[label == k]
            total[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
    k, cell = np.divmod(np.arange(total.size), total.shape[1])
    yield pa.RecordBatch.from_arrays(
        [pa.array(k.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(total.ravel())], names=["k", "cell", "x"]
    )


def fit(stats: DataFrame, labels: DataFrame) -> Discriminant | None:
    """Fit on all labelled rows. The driver gets the moments alone, whose number the statistics fix."""
    labelled = stats.join(labels, "doc_id")
    sums = labelled.mapInArrow(_moments, "k int, cell int, x double").groupBy("k", "cell").agg(F.sum("x").alias("x"))
    d = len(NAMES)
    total = np.zeros((2, 1 + d + d * d))
    for r in sums.collect():
        total[r["k"], r["cell"]] = r["x"]
    return discriminant(total[:, 0], total[:, 1 : 1 + d], total[:, 1 + d :].reshape(2, d, d))


def scored(stats: DataFrame, model: Discriminant | None) -> DataFrame:
    """``doc_id, score``; 0.5 where nothing could be learned."""
    if model is None:
        return stats.select("doc_id", F.lit(0.5).alias("score"))

    @pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack([c.to_numpy() for c in columns], 1)))

    return stats.select("doc_id", score(*(F.col(n) for n in NAMES)).alias("score"))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Labels of 0 or 1 of documents whose id's CRC leaves a remainder by 5 that is not 0 are
    learned from; scores see the whole text and nothing else.

    Cases: null and empty texts have all statistics 0 and are scored like others; a document with
    several labels counts once with each; other labels, null labels and null ids are not learned
    from; with one class or none every score is 0.5; repeated rows give equal rows, and each is learned
    from; a null id is not held out; an empty table gives no rows.
    """
    stats = settle(described(docs), "statistics")
    labels = only(labels, doc_id="long", quality="int").where("quality in (0, 1)").where(fold("doc_id", 5) != 0)
    model = fit(stats, labels.withColumnRenamed("quality", "label"))
    out = scored(stats, model)
    return out.select(
        "doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
