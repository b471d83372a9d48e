"""Token counts by a two-tier lookup of pre-token lengths, without moving any pre-token.

A byte-level tokenizer first cuts a text into pre-tokens and then encodes each on its own, so a text's
count is the sum over its pre-tokens of their token counts. Tier one is a compact table of frequent
pre-tokens and their counts, broadcast to all tasks; tier two is each worker's bounded cache, filled by
encoding what the table lacks with the library. The documents are mapped where they lie: no shuffle.

The table comes from all documents: every task counts the pre-tokens of its texts in a bounded summary
(when it is full, the rarest half go and are counted anew if they return), tasks send their ``table_size``
most frequent, and sums by pre-token pick those of the corpus. It decides only how often a worker has to
encode, never a count. Every text is counted whole.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import append_columns, slices
from .tokens import Encoder, _segments, encoder

# Pre-tokens of texts made of these characters are cut by a plain regular expression; the library's own
# pre-tokenizer cuts every other text, so no difference between Unicode tables can matter.
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN_TEXT = re.compile(rf"[ \n\t\r!-~{_LETTER}]*\Z")
_PRETOKEN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\s0-9{_LETTER}]+|\s+(?!\S)|\s+")
_PART_CHARS = 1 << 16
_LONGEST = 64  # characters of a pre-token in the table, which bounds its size


def pretokens_of(text: str, codec: Encoder) -> list[str]:
    """The pre-tokens of a text without special strings, as the library cuts them."""
    if _PLAIN_TEXT.match(text):
        return _PRETOKEN.findall(text)
    return [text[a:b] for _, (a, b) in codec.library.pre_tokenizer.pre_tokenize_str(text)]


def _mapped(pretoken: str, codec: Encoder) -> str:
    """A pre-token in the characters that stand for its bytes."""
    return pretoken.translate(codec.mapping) if pretoken.isascii() else "".join([codec.chars[b] for b in pretoken.encode()])


class _Counter:
    def __init__(self, tokenizer_json: str, frequent: dict[str, int], cache_size: int):
        self.codec = encoder(tokenizer_json)
        self.frequent, self.cache, self.cache_size = frequent, {}, cache_size

    def _length(self, pretoken: str) -> int:
        # A lone pre-token is a text of its own: the library gives its tokens.
        return len(self.codec.library.model.tokenize(_mapped(pretoken, self.codec)))

    def count(self, text: str | None) -> int:
        text = text or ""
        if self.codec.kind != "byte_level":
            return self.codec.count(text)
        return sum(map(self._part, _segments(text, _PART_CHARS) if len(text) > _PART_CHARS else [text]))

    def _part(self, text: str) -> int:
        if self.codec.special and self.codec.special.search(text):
            return len(self.codec._whole(text)) // self.codec.dtype.itemsize
        pretokens = pretokens_of(text, self.codec)
        found = list(map(self.frequent.get, pretokens))
        if None not in found:
            return sum(found)
        total, cache = 0, self.cache
        for pretoken, n in zip(pretokens, found, strict=True):
            if n is None:
                n = cache.get(pretoken)
                if n is None:
                    n = cache[pretoken] = self._length(pretoken)
            total += n
        if len(cache) > self.cache_size:
            cache.clear()
        return total


def fit_table(docs: DataFrame, tokenizer_json: str, *, text_col: str = "text", table_size: int = 1 << 15) -> dict[str, int]:
    """Token counts of the most frequent pre-tokens of all documents, at most ``table_size`` of them.

    A task holds at most four times as many pre-tokens; sums and their order are worked out by Spark, and only
    the table itself reaches the driver. Ties go by the pre-token; an empty table gives an empty one.
    """
    codec = encoder(tokenizer_json)
    if codec.kind != "byte_level":
        return {}
    shipped = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def run(batches):
        own, counts = encoder(shipped.value), Counter()
        for batch in batches:
            for _, texts in slices(batch, 0):
                for text in texts:
                    for part in _segments(text or "", _PART_CHARS):
                        if not (own.special and own.special.search(part)):
                            counts.update(pretokens_of(part, own))
                if len(counts) > 4 * table_size:
                    counts = Counter(dict(counts.most_common(2 * table_size)))
        top = [(w, n) for w, n in counts.most_common(table_size) if len(w) <= _LONGEST]
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["w", "n"])

    found = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "w string, n long")
    most = found.groupBy("w").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "w").limit(table_size)
    return {r.w: len(codec.library.model.tokenize(_mapped(r.w, codec))) for r in most.collect()}


def count_tokens(
    docs: DataFrame,
    tokenizer_json: str,
    *,
    text_col: str = "text",
    limit: int = 512,
    table: dict[str, int] | None = None,
    cache_size: int = 200_000,
) -> DataFrame:
    """``docs`` plus ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (n_tokens > limit).

    Null text counts as empty: 0 bytes, 0 tokens. Repeated rows each get their counts; columns of the
    input with these names are replaced; an empty table gives an empty one. Special-token strings in a
    text are handled as the library does by default. Texts are cut into parts only between a visible
    ASCII sign and a space, where no token can cross, so memory is bounded for any text.
    """
    spark = docs.sparkSession
    table = fit_table(docs, tokenizer_json, text_col=text_col) if table is None else table
    shipped = spark.sparkContext.broadcast((tokenizer_json, table))

    def make():
        counter = _counter(shipped.value, cache_size)

        def compute(texts):
            n = np.fromiter(map(counter.count, texts), np.int64, len(texts))
            size = np.fromiter((len((t or "").encode()) for t in texts), np.int64, len(texts))
            return [pa.array(size), pa.array(n), pa.array(n > limit)]

        return compute

    return append_columns(
        docs, make, [("n_bytes", T.LongType()), ("n_tokens", T.LongType()), ("over_limit", T.BooleanType())], text_col)


_COUNTERS: dict = {}


def _counter(shipped: tuple[str, dict], cache_size: int) -> _Counter:
    """The worker's counter, kept from task to task."""
    key = (id(shipped), cache_size)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = (_Counter(*shipped, cache_size), shipped)
    return _COUNTERS[key][0]


def count_tokens_sentencepiece(
    docs: DataFrame, model_file: str, *, text_col: str = "text", limit: int = 512,
) -> DataFrame:
    """The same columns for a ``.model`` file of the sentencepiece library (whole texts, no begin or end)."""
    with open(model_file, "rb") as f:
        shipped = docs.sparkSession.sparkContext.broadcast(f.read())

    def make():
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=shipped.value)

        def compute(texts):
            texts = [t or "" for t in texts]
            n = np.array([len(x) for x in model.encode(texts, num_threads=1)], np.int64)
            return [pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n), pa.array(n > limit)]

        return compute

    return append_columns(
        docs, make, [("n_bytes", T.LongType()), ("n_tokens", T.LongType()), ("over_limit", T.BooleanType())], text_col)
