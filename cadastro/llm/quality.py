"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a text (shares of letters, capitals, digits and signs, word and line lengths, repetition,
entropy) are computed batch by batch on whole texts. The trees are fitted on the driver from at most
``max_rows`` labelled rows (a documented bound: 20,000 rows of 24 numbers), each feature cut into at most
64 bins by quantiles, level by level from histograms of gradients. A fitted model is three arrays (split
feature, threshold, leaf value) over complete binary trees, and scoring walks all trees of a batch at
once with numpy indexing. Scoring maps the documents where they lie: no shuffle.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import append_columns, fresh, slices

FEATURES = [
    "log_chars", "log_words", "word_length", "letters", "digits", "capitals", "blanks", "punctuation", "signs",
    "exclamations", "bars", "non_ascii", "log_lines", "line_length", "repeated_lines", "repeated_words",
    "top_word", "top_line", "words_without_letters", "words_with_signs", "line_ends", "entropy", "control", "longest_word",
]
_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LOWER = (_BYTES >= 97) & (_BYTES <= 122)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_BLANK = np.isin(_BYTES, [9, 10, 11, 12, 13, 32])
_PUNCTUATION = np.isin(_BYTES, list(b".,;:!?'\"()-"))
_SIGN = (_BYTES > 32) & (_BYTES < 127) & ~(_UPPER | _LOWER | _DIGIT | _PUNCTUATION)
_CONTROL = (_BYTES < 32) & ~_BLANK
_LETTER = _UPPER | _LOWER | (_BYTES >= 128)
_PART = 1 << 22


def statistics(text: str | None) -> list[float]:
    """The features of a whole text, in the order of ``FEATURES``; all 0 for a null or empty text."""
    data = (text or "").encode()
    n = len(data)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    of = lambda mask: float(counts[mask].sum())
    words: Counter = Counter()
    for part in _parts(data):
        words.update(part.split())
    lines = Counter(data.split(b"\n"))
    n_words, n_lines = sum(words.values()), sum(lines.values())
    letters, latin = of(_LETTER), of(_UPPER | _LOWER)
    plain = _distinct_kinds(words)
    p = counts[counts > 0] / n
    w, ln = max(1, n_words), max(1, n_lines)
    ends = sum(k for x, k in lines.items() if x.rstrip()[-1:] in (b".", b"!", b"?"))
    return [
        float(np.log1p(n)), float(np.log1p(n_words)), (n - of(_BLANK)) / w, letters / n, of(_DIGIT) / n,
        of(_UPPER) / max(1.0, latin), of(_BLANK) / n, of(_PUNCTUATION) / n, of(_SIGN) / n, counts[33] / n, counts[124] / n,
        of(_BYTES >= 128) / n, float(np.log1p(n_lines)), n / ln, 1 - len(lines) / ln, 1 - len(words) / w,
        max(words.values(), default=0) / w, max(lines.values()) / ln, plain[0] / w, plain[1] / w, ends / ln,
        float(-(p * np.log2(p)).sum()), of(_CONTROL) / n, float(np.log1p(max(map(len, words), default=0))),
    ]


def _parts(data: bytes):
    """The bytes in parts of a few MB, cut after a blank where there is one."""
    start = 0
    while len(data) - start > _PART:
        cut = data.find(b" ", start + _PART)
        if cut < 0:
            break
        yield data[start:cut]
        start = cut
    yield data[start:]


def _distinct_kinds(words: Counter) -> tuple[int, int]:
    """(words without any letter, words that end in a sign other than usual punctuation)."""
    bare = signed = 0
    usual = b".,;:!?'\")-"
    for word, k in words.items():
        last = word[-1:]
        if last.isalpha() or last >= b"\x80":
            continue
        if not (word.upper() != word.lower() or max(word) >= 128):
            bare += k
        if not last.isdigit() and last not in usual:
            signed += k
    return bare, signed


@dataclass
class Trees:
    """Complete binary trees of one depth as arrays: node i has children 2i+1 (value <= threshold) and 2i+2."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of every row."""
        n_trees, inner = self.feature.shape
        if not n_trees:
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        tree = np.arange(n_trees)
        node = np.zeros((len(x), n_trees), np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(int(np.log2(inner + 1))):
            node = 2 * node + 1 + (x[rows, self.feature[tree, node]] > self.threshold[tree, node])
        return 1 / (1 + np.exp(-(self.base + self.leaf[tree, node - inner].sum(axis=1))))


def fit_trees(
    x: np.ndarray, y: np.ndarray, *, n_trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 1.0, min_hessian: float = 2.0,
) -> Trees:
    """Gradient boosting of the logistic loss on feature histograms; y may be a share between 0 and 1."""
    n, d = x.shape
    inner = 2**depth - 1
    if not n:
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), 0.0)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    code = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(d)], axis=1).astype(np.int64)
    mean = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    logit = np.full(n, base)
    feature = np.zeros((n_trees, inner), np.int64)
    threshold = np.full((n_trees, inner), np.inf)
    leaf = np.zeros((n_trees, inner + 1))
    for t in range(n_trees):
        p = 1 / (1 + np.exp(-logit))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            width, first = 2**level, 2**level - 1
            local = node - first
            best = np.full(width, 1e-9)
            for j in range(d):
                if not len(edges[j]):
                    continue
                size = len(edges[j]) + 1
                at = local * size + code[:, j]
                g = np.bincount(at, grad, width * size).reshape(width, size).cumsum(axis=1)
                h = np.bincount(at, hess, width * size).reshape(width, size).cumsum(axis=1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gl, hl = g[:, :-1], h[:, :-1]
                gain = gl**2 / (hl + l2) + (all_g - gl) ** 2 / (all_h - hl + l2) - all_g**2 / (all_h + l2)
                gain[(hl < min_hessian) | (all_h - hl < min_hessian)] = 0
                cut = gain.argmax(axis=1)
                value = gain[np.arange(width), cut]
                better = value > best
                best[better] = value[better]
                feature[t, first:first + width][better] = j
                threshold[t, first:first + width][better] = edges[j][cut[better]]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        at = node - inner
        g, h = np.bincount(at, grad, inner + 1), np.bincount(at, hess, inner + 1)
        leaf[t] = -rate * g / (h + l2)
        logit += leaf[t, at]
    return Trees(feature, threshold, leaf, base)


def fit(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = 20_000,
) -> Trees:
    """Trees fitted on at most ``max_rows`` labelled documents, picked by a hash of their id.

    Null ids and labels teach nothing; an id labelled several times counts with its mean label; repeated
    documents count once. With no labelled document every score is 1/2. The picked ids are at most
    ``max_rows`` rows, so broadcasting them is bounded; the texts never move, only their statistics do.
    """
    picked = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y")).dropna()
              .groupBy("id").agg(F.avg("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(max_rows))
    ids = F.broadcast(picked.select("id"))
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(ids, "id", "left_semi")
    schema = T.StructType([chosen.schema["id"], T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for batch in batches:
            for start, texts in slices(batch, 1):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), pa.array([statistics(t) for t in texts], pa.list_(pa.float64()))],
                    names=["id", "x"])

    known = chosen.mapInArrow(run, schema).groupBy("id").agg(F.min("x").alias("x"))
    rows = known.join(picked, "id").orderBy("id").collect()
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), len(FEATURES))
    return fit_trees(x, np.array([r["y"] for r in rows], float))


def score(docs: DataFrame, trees: Trees, *, text_col: str = "text", threshold: float = 0.7, score_out: str = "score", predicted_out: str = "predicted") -> DataFrame:
    """``docs`` plus the probability of good quality and ``predicted`` (1 from ``threshold`` on, else 0).

    Only the text is an input. Null and empty texts are scored like any other, from zero statistics;
    repeated rows get equal scores; input columns with the output names are replaced; an empty table
    stays empty.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(trees)

    def make():
        def compute(texts):
            x = np.array([statistics(t) for t in texts], float).reshape(len(texts), len(FEATURES))
            p = shipped.value.score(x)
            return [pa.array(p), pa.array((p >= threshold).astype(np.int32))]

        return compute

    return append_columns(docs, make, [(score_out, T.DoubleType()), (predicted_out, T.IntegerType())], text_col)


def keep_good(docs: DataFrame, trees: Trees, *, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """Rows of ``docs`` (same columns) predicted to be of good quality."""
    p, predicted = fresh("score", docs), fresh("predicted", docs)
    marked = score(docs, trees, text_col=text_col, threshold=threshold, score_out=p, predicted_out=predicted)
    return marked.where(F.col(predicted) == 1).drop(p, predicted)
