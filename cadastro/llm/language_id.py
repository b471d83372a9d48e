"""Language identification with hyperdimensional profiles.

Every letter of every alphabet has a random vector of +1 and -1, hashed from its code point. A trigram
``abc`` is the product (binding) of its letters' vectors, each rotated (permuted) by its place:
``rot2(a) * rot1(b) * c``. The sum (bundling) of a text's trigram vectors is its profile; the sum of a
language's texts is the language's prototype. A text gets the language whose prototype has the largest
cosine with its profile.

Learning is one pass: each task bundles its texts by language and sends one vector of integers per
language; their sum does not depend on the order, so reruns give the same prototypes. The driver holds
languages x dimensions numbers, whatever the size of the corpus. Prediction maps batches where they lie.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import append_columns, fresh, slices

UNDETERMINED = "und"
# Standard deviations (1 / sqrt(dimensions) each) that the cosine of a clean text may fall short by chance.
CHANCE = 4.5
_BLOCK_CHARS = 1 << 20
_MATRIX_CELLS = 1 << 22
_NON_LETTER = re.compile(r"[\W\d_]")


@lru_cache(maxsize=1)
def _symbol_of() -> np.ndarray:
    """Symbol by code point: 0, a word border, for what is no letter; a letter is its own symbol."""
    points = np.arange(0x110000, dtype=np.int32)
    letters = np.fromiter((chr(c).isalpha() for c in range(len(points))), bool, len(points))
    return np.where(letters, points, 0).astype(np.int32)


@dataclass(frozen=True)
class _Vectors:
    """Vectors by symbol, rotated by ``turn``: +1 and -1 from a hash of seed, symbol and place.

    No alphabet is fixed and nothing is kept: a symbol's vector is the same in every task and run.
    """

    dim: int
    seed: int
    turn: int

    def __getitem__(self, symbols) -> np.ndarray:
        symbols = np.asarray(symbols, np.uint64)
        z = symbols[..., None] << np.uint64(32) | np.arange(-(-self.dim // 64), dtype=np.uint64)
        for salt in (self.seed, 0):  # splitmix64, twice
            z = z + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
            z = (z ^ z >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ z >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
            z = z ^ z >> np.uint64(31)
        bits = np.unpackbits(z.astype("<u8").view(np.uint8), axis=-1, count=self.dim)
        return np.roll(bits.view(np.int8) * np.int8(2) - np.int8(1), self.turn, axis=-1)


def _letter_vectors(dim: int, seed: int) -> tuple[_Vectors, _Vectors, _Vectors]:
    """Vectors of the symbols in first, second and third place (rotated by 2, 1 and 0)."""
    return _Vectors(dim, seed, 2), _Vectors(dim, seed, 1), _Vectors(dim, seed, 0)


def _trigram_vectors(trigrams: np.ndarray, letters: list[np.ndarray]) -> np.ndarray:
    """Vectors of trigrams, numbers of three digits that are places in the tables of ``letters``."""
    first, second, third = letters
    n = len(first)
    bound = first[trigrams // n**2]
    bound *= second[trigrams // n % n]
    bound *= third[trigrams % n]
    return bound.astype(np.float32)


def _numbered(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, place of each value among them) of whole numbers below ``size``."""
    if size > 4 * len(values):
        return np.unique(values, return_inverse=True)
    seen = np.zeros(size, bool)
    seen[values] = True
    present = np.flatnonzero(seen)
    place = np.zeros(size, np.int64)
    place[present] = np.arange(len(present))
    return present, place[values]


def _blocks(texts: list[str | None]):
    """(rows, parts) of bounded size. A long text is cut after a non-letter, where no trigram crosses."""
    rows, parts, size = [], [], 0
    for row, text in enumerate(texts):
        text, start = text or "", 0
        while start < len(text):
            cut = _NON_LETTER.search(text, start + _BLOCK_CHARS) if len(text) - start > _BLOCK_CHARS else None
            end = cut.end() if cut else len(text)
            rows.append(row)
            parts.append(text[start:end])
            size += end - start
            start = end
            if size >= _BLOCK_CHARS:
                yield rows, parts
                rows, parts, size = [], [], 0
    if parts:
        yield rows, parts


def _trigrams(rows: list[int], parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, trigram) of every trigram of the parts, and the parts' symbols; a trigram never spans two words.

    A trigram is a number of three digits, each the place of a letter among the n symbols (base n).
    """
    lowered = [p.lower() for p in parts]
    points = np.frombuffer("\n".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
    symbols = np.concatenate([[0], _symbol_of()[points], [0]])
    owner = np.repeat(np.array(rows, np.int64), [len(p) + 1 for p in lowered])
    owner = np.concatenate([owner[:1], owner])
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != 0) | (symbols[:-1] != 0)
    names, digits = _numbered(symbols[keep], 0x110000)
    owner, n = owner[:len(keep)][keep], len(names)
    inner = names[digits[1:-1]] != 0
    grams = (digits[:-2] * n + digits[1:-1]) * n + digits[2:]
    return owner[1:-1][inner], grams[inner], names


def bundle(texts: list[str | None], groups: np.ndarray, n_groups: int, dim: int, seed: int) -> np.ndarray:
    """Sum of the trigram vectors of all texts by group (one group per text gives the texts' profiles).

    Sums are exact integers in float32 up to 2^24 trigrams a block and group, and added as float64. Counts
    are a matrix where groups share most trigrams, and pairs (group, trigram) where they do not.
    """
    return _bundle(texts, groups, n_groups, dim, seed)[0]


def _bundle(texts: list[str | None], groups: np.ndarray, n_groups: int, dim: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """``bundle`` and the number of trigrams by group."""
    total, sizes = np.zeros((n_groups, dim), np.float64), np.zeros(n_groups, np.int64)
    step = max(1, _MATRIX_CELLS // dim)
    for rows, parts in _blocks(texts):
        row, gram, symbols = _trigrams(rows, parts)
        if not len(gram):
            continue
        present, column = _numbered(gram, len(symbols) ** 3)
        sizes += np.bincount(groups[row], minlength=n_groups)
        letters = [vectors[symbols] for vectors in _letter_vectors(dim, seed)]
        names, local = _numbered(groups[row], n_groups)
        cell, n_cells = local * len(present) + column, len(names) * len(present)
        if n_cells <= 16 * len(gram):
            counts = np.zeros(n_cells, np.float32)
            np.add.at(counts, cell, np.float32(1))
            counts = counts.reshape(len(names), -1)
            for lo in range(0, len(present), step):
                total[names] += counts[:, lo:lo + step] @ _trigram_vectors(present[lo:lo + step], letters)
        else:
            pairs, counts = np.unique(cell, return_counts=True)
            for lo in range(0, len(pairs), step):
                at, which = np.divmod(pairs[lo:lo + step], len(present))
                vectors, weights = _trigram_vectors(present[which], letters), counts[lo:lo + step].astype(np.float32)
                some, starts = np.unique(at, return_index=True)
                for name, start, end in zip(names[some], starts, [*starts[1:], len(at)], strict=True):
                    total[name] += weights[start:end] @ vectors[start:end]
    return total, sizes


@dataclass
class Profiles:
    """Unit-length language prototypes: ``languages[i]`` has row ``i`` of ``matrix``.

    ``weights[i]`` is the mean cosine of one trigram of the language with its prototype, estimated for texts
    not learned: all learned trigrams together, less what each adds to its own prototype.
    """

    languages: list[str]
    matrix: np.ndarray
    weights: np.ndarray
    dim: int
    seed: int

    def level(self, best: np.ndarray, sizes: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Cosine below which a text of ``sizes`` trigrams and profile length ``norms`` is not in language ``best``.

        A text whose trigrams count as n different ones has a cosine of about weight * sqrt(n) if it is in the
        language. The level is half of that (at most 0.4), less ``CHANCE`` standard deviations of the cosine
        of unrelated vectors: a text of a word or a few, or one that repeats a word, has level 0.
        """
        different = sizes * np.sqrt(self.dim) / np.maximum(norms, 1e-12)
        return np.maximum(np.minimum(self.weights[best] * different, 0.8) / 2 - CHANCE / np.sqrt(self.dim), 0)


def learn(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", dim: int = 1024, seed: int = 20) -> Profiles:
    """Prototypes of the languages of ``docs``; rows with a null language or no letter teach nothing."""
    narrow = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(F.col("lang").isNotNull())

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for start, texts in slices(batch, 0):
                langs = batch.column(1).slice(start, len(texts)).to_pylist()
                names = sorted(set(langs))
                groups = np.array([names.index(x) for x in langs])
                for name, vector, size in zip(names, *_bundle(texts, groups, len(names), dim, seed), strict=True):
                    if vector.any():
                        sums[name] = sums.get(name, 0) + np.append(vector, size)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([v.astype(np.int64) for v in sums.values()], pa.list_(pa.int64()))],
                names=["lang", "vector"])

    # One row per language and dimension, and one with its number of trigrams, comes back, however many tasks there were.
    rows = (narrow.mapInArrow(run, "lang string, vector array<long>").select("lang", F.posexplode("vector"))
            .groupBy("lang", "pos").agg(F.sum("col").alias("n")).collect())
    languages = sorted({r["lang"] for r in rows})
    sums = np.zeros((len(languages), dim + 1))
    for r in rows:
        sums[languages.index(r["lang"]), r["pos"]] = r["n"]
    matrix, sizes = sums[:, :dim], sums[:, dim]
    norms = np.maximum(np.linalg.norm(matrix, axis=1), 1e-12)
    lengths = norms / np.sqrt(dim)
    weights = np.maximum(lengths**2 - sizes, 0) / (np.maximum(sizes - 1, 1) * lengths)
    return Profiles(languages, matrix / norms[:, None], weights, dim, seed)


def predict(docs: DataFrame, profiles: Profiles, *, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """``docs`` plus the predicted language and the cosine (0 to 1) with its prototype.

    A null text, a text without a letter and any text when nothing was learned get ``und`` and 0. Equal
    cosines go to the first language in code point order. Every text is read whole; repeated rows get
    equal results; input columns with the output names are replaced; an empty table stays empty.
    """
    return _marked(docs, profiles, text_col, [(lang_out, T.StringType()), (score_out, T.DoubleType())])


def _marked(docs: DataFrame, profiles: Profiles, text_col: str, fields: list[tuple[str, T.DataType]]) -> DataFrame:
    """``docs`` plus language, cosine and, if ``fields`` has a third, the level for the cosine."""
    shipped = docs.sparkSession.sparkContext.broadcast(profiles)

    def make():
        known = shipped.value

        def compute(texts):
            langs, scores, levels = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
            if known.languages:
                vectors, sizes = _bundle(texts, np.arange(len(texts)), len(texts), known.dim, known.seed)
                norms = np.linalg.norm(vectors, axis=1)
                cosines = vectors @ known.matrix.T / np.maximum(norms, 1e-12)[:, None]
                best = cosines.argmax(axis=1)
                levels = known.level(best, sizes, norms)
                for i in np.flatnonzero(norms):
                    langs[i], scores[i] = known.languages[best[i]], min(1.0, max(0.0, cosines[i, best[i]]))
            return [pa.array(langs, pa.string()), pa.array(scores), pa.array(levels)][:len(fields)]

        return compute

    return append_columns(docs, make, fields, text_col)


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def keep_known_languages(docs: DataFrame, profiles: Profiles, *, text_col: str = "text", min_score: float = 0.0) -> DataFrame:
    """Rows of ``docs`` (same columns) whose text has a language: not ``und``, and a cosine of at least
    ``min_score`` and the level that its trigrams allow (``Profiles.level``, set from all learned texts).

    Gibberish and languages never learned go. A text too short to tell from chance (level 0) stays, as a
    clean text may be one word; so does one in a language of which too little was learned to set a level.
    """
    lang, score, level = fresh("lang_pred", docs), fresh("score", docs), fresh("level", docs)
    marked = _marked(docs, profiles, text_col, [(lang, T.StringType()), (score, T.DoubleType()), (level, T.DoubleType())])
    known = (F.col(lang) != UNDETERMINED) & (F.col(score) >= min_score) & (F.col(score) >= F.col(level))
    return marked.where(known).drop(lang, score, level)
