"""Phrase collocation mining on Rabin-Karp fingerprints.

A batch of texts is one byte buffer. numpy marks its words, and prefix sums of byte * B^position (modulo
2^64) give every word's hash at once; prefix sums of word hash * C^index give the hash of every n-gram,
whatever its length. Mixed with the language, that is the n-gram's fingerprint.

1. Fingerprints of n words are counted, one length after the other: folded in the task, then shuffled
   and summed. Nothing but 40 bits of the fingerprint and its count moves; as sums only decide what the last
   pass looks at, two fingerprints that share these bits cost a look and no error. An n-gram can only be frequent if both n-grams
   inside it are, so from two words on those alone are counted whose parts are in a bitmap of the
   frequent fingerprints. The bitmap has a fixed size (``filter_bits``) whatever the corpus; where it
   fills up, more n-grams are counted than needed, and none is missed.
2. A last pass materialises what the bitmaps call frequent, and nothing else. In a batch every
   fingerprint has a pointer to its first occurrence. The words behind equal hashes are compared byte by
   byte with the word at the pointer; if any differ, the batch goes by the words themselves. A phrase's
   text is cut out once, at its pointer, and shuffled with its count and pointer (document and word number).
   Sums go by the text, so colliding phrases part and counts are exact.
3. Scores join each cut of a phrase with the counts of its two parts; parts that begin very many phrases
   are salted. A histogram of the scores finds the level above which a language's best lie, and only
   those are sorted.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastro.operators.lookups import salted_join

from ._common import checked_join, in_filter, key_filter, materialise

MAX_WORDS = 3
MIN_COUNT = 10
TOP = 2000
FILTER_BITS = 27
PRINT_BITS = 40
# Bytes of text in a buffer, and entries a task holds before it passes them on.
BUFFER = 1 << 22
MAX_ENTRIES = 1 << 20
_WORDS = 1 << 40  # more than any document has

_BYTES = np.random.default_rng(11).integers(1, 1 << 63, 256, np.uint64)
_BYTE_BASE, _WORD_BASE, _LENGTH = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
_CUT = re.compile(rb"[ \t.,;:!?\n-\r]")
_KIND = np.zeros(256, np.uint8)  # 0: in a word, 1: between words, 2: between pieces
_KIND[[32, 9]] = 1
_KIND[[*b".,;:!?", 10, 11, 12, 13]] = 2


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, kept from buffer to buffer."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        """Sums of values[j] * base^j before each position."""
        if len(self.up) <= len(values):
            n = len(values) + (len(values) >> 2) + 1
            self.up, self.down = (np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, b, np.uint64))]) for b in (self.base, self.inverse))
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[:len(values)], out=out[1:])
        return out

    def between(self, prefix: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The polynomial of values[lo:hi], the same wherever these stand."""
        return (prefix[hi] - prefix[lo]) * self.down[lo]


_BYTE_POWERS, _WORD_POWERS = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


class Buffer:
    """The words of some texts, lower-cased: place, piece, owner and hash of each.

    ``lead`` words at the start belong to an earlier buffer too; n-grams wholly within them were counted there.
    """

    def __init__(self, texts: list[bytes], langs: list[str], docs: list, lead: int = 0, base: int = 0):
        self.data = b"\n".join(texts).lower()  # bytes: only A-Z change
        self.langs, self.docs, self.lead, self.base = langs, docs, lead, base
        values = np.frombuffer(self.data, np.uint8)
        kind = _KIND[values]
        edges = np.flatnonzero(np.diff(np.concatenate([[1], kind, [1]]).astype(bool)))
        self.starts, self.ends = edges[::2], edges[1::2]
        self.piece = np.searchsorted(np.flatnonzero(kind == 2), self.starts)
        opens = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        self.owner = np.searchsorted(opens, self.starts, side="right") - 1
        sums = _BYTE_POWERS.prefix(_BYTES[values])
        self.words = _mix(_BYTE_POWERS.between(sums, self.starts, self.ends) + (self.ends - self.starts).astype(np.uint64) * _LENGTH)
        self.sums = _WORD_POWERS.prefix(self.words)
        self.seeds = np.array([xxhash.xxh64_intdigest(lang.encode()) for lang in langs], np.uint64)

    def grams(self, n: int) -> np.ndarray:
        """Indexes of the first words of all n-grams."""
        at = np.arange(max(0, self.lead - n + 1), max(0, len(self.starts) - n + 1))
        return at[self.piece[at] == self.piece[at + n - 1]]

    def prints(self, at: np.ndarray, n: int) -> np.ndarray:
        """Fingerprints of the n-grams that start at these words."""
        return _mix(_WORD_POWERS.between(self.sums, at, at + n) ^ (self.seeds + np.array([n], np.uint64) * _LENGTH)[self.owner[at]])

    def counted(self, n: int, filters: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(first words, fingerprints) of the n-grams whose inner n-grams are all in the filters."""
        at = self.grams(n)
        if n > 1:
            for inner in (0, 1):
                at = at[in_filter(filters[n - 2], self.prints(at + inner, n - 1))]
        return at, self.prints(at, n)

    def word_ids(self) -> tuple[np.ndarray, np.ndarray]:
        """(id of each word, first place of each id); words have one id if and only if they are equal."""
        _, first, ids = np.unique(self.words, return_index=True, return_inverse=True)
        size = self.ends - self.starts
        pointed = first[ids]
        same = bool((size == size[pointed]).all())
        if same and len(ids):
            step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            values = np.frombuffer(self.data, np.uint8)
            same = np.array_equal(values[np.repeat(self.starts, size) + step], values[np.repeat(self.starts[pointed], size) + step])
        if same:
            return ids, first
        seen: dict[bytes, int] = {}
        ids = np.array([seen.setdefault(self.data[s:e], len(seen)) for s, e in zip(self.starts, self.ends, strict=True)], np.int64)
        return ids, np.unique(ids, return_index=True)[1]


def buffers(batch: pa.RecordBatch, max_words: int):
    """Buffers of a batch (text, lang, doc): small texts together, a long one in parts that share ``max_words - 1`` words."""
    langs, docs, texts = batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(0).cast(pa.binary())
    held, size = [], 0
    # By document, so that an n-gram's first place in a buffer is its first in the order of pointers too.
    for row in sorted(range(batch.num_rows), key=lambda i: (docs[i] is None, docs[i])):
        text = texts[row].as_py() or b""
        if len(text) > BUFFER:
            yield from _long(text, langs[row], docs[row], max_words)
            continue
        if size + len(text) > BUFFER and held:
            yield Buffer(*map(list, zip(*held, strict=True)))
            held, size = [], 0
        held.append((text, langs[row], docs[row]))
        size += len(text)
    if held:
        yield Buffer(*map(list, zip(*held, strict=True)))


def _long(text: bytes, lang: str, doc, max_words: int):
    tail, start, lead, base = b"", 0, 0, 0
    while start < len(text):
        cut = _CUT.search(text, start + BUFFER)
        end = cut.start() if cut else len(text)
        part = Buffer([tail + text[start:end]], [lang], [doc], lead, base)
        yield part
        lead = min(max_words - 1, len(part.starts))
        tail = part.data[part.starts[-lead]:] if lead else b""
        base += len(part.starts) - lead
        start = end


def _narrow(docs: DataFrame, text_col: str, lang_col: str, id_col: str) -> DataFrame:
    return docs.select(F.col(text_col).cast("string").alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.col(id_col).cast("long").alias("doc"))


def frequent_prints(narrow: DataFrame, n: int, filters: list, min_count: int, max_words: int) -> DataFrame:
    """Leading bits of the fingerprints (fp) that come at least ``min_count`` times: all n-grams as frequent as
    that in their language, and a few others."""

    def run(batches):
        held, size = [], 0

        def merged():
            fp = np.concatenate([h[0] for h in held])
            unique, back = np.unique(fp, return_inverse=True)
            total = np.zeros(len(unique), np.int64)
            np.add.at(total, back, np.concatenate([h[1] for h in held]))
            return unique, total

        bitmaps = [f.value for f in filters]
        for batch in batches:
            for buffer in buffers(batch, max_words):
                prints = buffer.counted(n, bitmaps)[1] >> np.uint64(64 - PRINT_BITS)
                held.append(np.unique(prints, return_counts=True))
                size += len(held[-1][0])
                if size > 2 * MAX_ENTRIES:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > MAX_ENTRIES:
                        yield from _print_batches(*held.pop())
                        size = 0
        if held:
            yield from _print_batches(*merged())

    counted = narrow.mapInArrow(run, "fp long, n long")
    frequent = counted.groupBy("fp").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    return frequent.select(F.shiftleft("fp", 64 - PRINT_BITS).alias("fp"))


def _print_batches(fp: np.ndarray, n: np.ndarray):
    for at in range(0, len(fp), 1 << 16):
        yield pa.RecordBatch.from_arrays(
            [pa.array(fp[at:at + (1 << 16)].astype(np.int64)), pa.array(n[at:at + (1 << 16)].astype(np.int64))], names=["fp", "n"])


_PHRASE = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("words", T.IntegerType()),
    T.StructField("phrase", T.StringType()), T.StructField("f", T.LongType()), T.StructField("doc", T.LongType()),
    T.StructField("word", T.LongType())])


def _materialise(buffer: Buffer, bitmaps: list[np.ndarray], max_words: int):
    """Rows of ``_PHRASE``: the buffer's frequent phrases, and each language's words under the empty phrase."""
    ids, first = buffer.word_ids()
    words = pa.array([buffer.data[s:e] for s, e in zip(buffer.starts[first], buffer.ends[first], strict=True)], pa.binary()).cast(pa.string())
    lang_of = np.unique(buffer.langs, return_inverse=True)
    of_owner = lang_of[1]
    opens = np.searchsorted(buffer.owner, np.arange(len(buffer.langs)))  # each document's first word
    docs = pa.array(buffer.docs, pa.int64())
    name = docs.fill_null(np.iinfo(np.int64).max).to_numpy()
    repeated = len(set(buffer.docs)) < len(buffer.docs)
    counted = np.bincount(of_owner[buffer.owner[buffer.lead:]], minlength=len(lang_of[0])).astype(np.int64)
    none = pa.nulls(len(counted), pa.int64())
    yield pa.RecordBatch.from_arrays(
        [pa.array(lang_of[0].tolist()), pa.array(np.zeros(len(counted), np.int32)),
         pa.array([""] * len(counted)), pa.array(counted), none, none], schema=_ARROW)
    for n in range(1, max_words + 1):
        at, fp = buffer.counted(n, bitmaps)
        at = at[in_filter(bitmaps[n - 1], fp)]
        if repeated:
            order = np.lexsort((at - opens[buffer.owner[at]], name[buffer.owner[at]]))
            at = at[order]
        key = of_owner[buffer.owner[at]].astype(np.int64)
        for k in range(n):  # exact: language and word ids, not the fingerprint
            key = np.unique(key * (len(words) + 1) + ids[at + k], return_inverse=True)[1].astype(np.int64)
        _, pointer, count = np.unique(key, return_index=True, return_counts=True)
        at = at[pointer]
        parts = [words.take(pa.array(ids[at + k])) for k in range(n)]
        owner = buffer.owner[at]
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang_of[0].tolist()).take(pa.array(of_owner[owner])), pa.array(np.full(len(at), n, np.int32)),
             pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0],
             pa.array(count.astype(np.int64)), docs.take(pa.array(owner)), pa.array(at - opens[owner] + buffer.base)], schema=_ARROW)


_ARROW = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("f", pa.int64()),
                    ("doc", pa.int64()), ("word", pa.int64())])


def phrase_counts(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", max_words: int = MAX_WORDS,
                  min_count: int = MIN_COUNT, filter_bits: int = FILTER_BITS) -> DataFrame:
    """Exact counts f of all phrases of 1 to ``max_words`` words with f >= ``min_count`` in their language:
    lang, words, phrase, f, doc and word (the first occurrence). ``words`` 0: all word occurrences of the language."""
    spark, narrow = docs.sparkSession, _narrow(docs, text_col, lang_col, id_col)
    filters = []
    for n in range(1, max_words + 1):
        prints = materialise(frequent_prints(narrow, n, filters, min_count, max_words), "collocation_prints")
        filters.append(spark.sparkContext.broadcast(key_filter(prints, filter_bits)))

    def run(batches):
        bitmaps = [f.value for f in filters]
        for batch in batches:
            for buffer in buffers(batch, max_words):
                yield from _materialise(buffer, bitmaps, max_words)

    # A pointer as one number, as a struct's minimum would need a sort of all rows.
    at = F.col("doc").cast("decimal(20,0)") * F.lit(_WORDS).cast("decimal(14,0)") + F.col("word")
    found = narrow.mapInArrow(run, _PHRASE).withColumn("at", at).groupBy("lang", "words", "phrase").agg(
        F.sum("f").alias("f"), F.min("at").alias("at"))
    return found.where((F.col("words") == 0) | (F.col("f") >= min_count)).withColumn("word", F.pmod("at", F.lit(_WORDS)).cast("long")).select(
        "lang", "words", "phrase", "f", F.call_function("div", F.col("at") - F.col("word"), F.lit(_WORDS)).alias("doc"), "word")


def score(a: str, left: str, right: str) -> Column:
    """floor(10^6 a^2 / (left right)), exact for counts below 10^15."""
    a, left, right = (F.col(c).cast("decimal(19,0)") for c in (a, left, right))
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (a * a).cast("decimal(31,0)"), left * right)


def _key(phrase: Column) -> Column:
    """One string for a (language, phrase) pair."""
    return F.concat(F.length("lang").cast("string"), F.lit(":"), F.col("lang"), phrase)


def mine(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", max_words: int = MAX_WORDS,
         min_count: int = MIN_COUNT, top: int = TOP, inside_percent: int = 50, filter_bits: int = FILTER_BITS) -> DataFrame:
    """The best collocations of each language: lang, rank, phrase, a, l, r, n, score, doc_id, word.

    A phrase has 2 to ``max_words`` words and a >= ``min_count`` occurrences within pieces (texts cut at
    punctuation and line ends). Its score is floor(10^6 a^2 / (l r)) for the cut into two parts (l and r
    occurrences) that scores lowest, the earliest on ties. It is dropped if a longer phrase that contains it
    has at least ``inside_percent`` of its occurrences. n: the language's words; doc_id and word:
    where the phrase first occurs (smallest id, then word number).

    Null text counts as empty, null language as ``und``; repeated rows count as often as they come;
    texts above 4 MB are gone through in parts that overlap by the words an n-gram can span (a single word is
    hashed whole); an empty table gives an empty result; extra columns are not read.
    """
    counts = materialise(phrase_counts(docs, text_col=text_col, lang_col=lang_col, id_col=id_col, max_words=max_words,
                                       min_count=min_count, filter_bits=filter_bits), "collocations")
    phrases = counts.where(F.col("words") > 0).select(_key(F.col("phrase")).alias("key"), "f")
    candidates = counts.where(F.col("words") > 1).select("lang", "words", "phrase", F.col("f").alias("a"), "doc", "word",
                                                         F.split("phrase", " ").alias("w"))
    cuts = materialise(candidates.select("lang", "words", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", _key(F.array_join(F.slice("w", 1, F.col("k")), " ")).alias("left"),
        _key(F.array_join(F.slice("w", F.col("k") + 1, F.col("words")), " ")).alias("right")), "collocation_cuts")
    parted = salted_join(cuts, phrases.select(F.col("key").alias("left"), F.col("f").alias("l")), "left", "inner")
    parted = salted_join(materialise(parted.drop("left"), "collocation_cuts"), phrases.select(F.col("key").alias("right"), F.col("f").alias("r")), "right", "inner")
    scored = parted.withColumn("score", score("a", "l", "r")).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    lengths = F.sequence(F.lit(2), F.col("words") - 1)
    inner = candidates.where(F.col("words") > 2).select("lang", "words", "w", "a", F.explode(lengths).alias("n")).select(
        "lang", "w", "a", "n", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("n") + 1)).alias("i")).select(
        "lang", F.array_join(F.slice("w", F.col("i"), F.col("n")), " ").alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    totals = counts.where(F.col("words") == 0).select("lang", F.col("f").alias("n"))
    whole = candidates.drop("w", "words").join(scored, ["lang", "phrase"]).join(inner, ["lang", "phrase"], "left")
    level = F.floor(F.log2(F.col("score") + 1) * 64).cast("int")
    kept = materialise(whole.where(F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a"))).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score", F.col("doc").alias("doc_id"), "word").withColumn("level", level), "collocation_scores")
    above = Window.partitionBy("lang").orderBy(F.col("level").desc())
    # At most 1,300 levels a language: the first by which ``top`` phrases are reached, or the last.
    reached = kept.groupBy("lang", "level").count().withColumn("n", F.sum("count").over(above))
    floor = reached.groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("n") >= top, F.col("level"))), F.min("level")).alias("floor"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    best = checked_join(kept, materialise(floor, "collocation_floors"), "lang").where("level >= floor").withColumn(
        "rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "doc_id", "word")


SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, doc_id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
    SELECT lang, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS phrase
    FROM worded, (VALUES (1), (2), (3)) AS sizes (n)
), f AS (SELECT lang, n AS words, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE words = 1 GROUP BY lang),
candidates AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND f >= 10),
cuts AS (
    SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r,
        CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
    FROM candidates c, (VALUES (1), (2)) AS ks (k)
    JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')
    WHERE k < c.words
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
    SELECT lang, phrase, max(a) AS longer
    FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM candidates WHERE words = 3)
    GROUP BY ALL
), ranked AS (
    SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank, s.phrase, s.a, s.l, s.r, s.score
    FROM lowest s LEFT JOIN longer g ON g.lang = s.lang AND g.phrase = s.phrase
    WHERE g.longer IS NULL OR 100 * g.longer < 50 * s.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
