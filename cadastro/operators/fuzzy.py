"""Approximate lookup keys: which keys of a gazetteer share most words with a query's key.

Keys are sets of folded words; two of them score floor(200 |A and B| / (|A| + |B|)), 0 to 100. Pairs of at least
``min_score`` are found by a prefix filter: with the words of every key in one global order, rarest first,
two keys that score enough must share a word among their first few (how few follows from their sizes). So only
those words are joined, which leaves the frequent ones (``rua``, a big city) out of almost every join; a word
that is frequent all the same is salted over several tasks. A pair is looked at once, at the first word it
shares, and verified on the whole sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ascii_fold
from ..session import checkpoint_root
from .lookups import lookup, salted_join


def words_of(key: Column) -> Column:
    """The distinct words of a key: accents folded, lower case, split at everything but a-z and 0-9."""
    plain = F.regexp_replace(F.lower(ascii_fold(key)), "[^a-z0-9]+", " ")
    return F.array_distinct(F.filter(F.split(plain, " "), lambda w: w != ""))


def likeness(a: Column, b: Column) -> Column:
    """floor(200 |a and b| / (|a| + |b|)) of two arrays of distinct words."""
    return F.floor(200 * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b))).cast("int")


def least_overlap(size: Column, min_score: int) -> Column:
    """Words that a key of ``size`` words must share with any key it scores ``min_score`` with; the other key
    cannot have fewer."""
    return F.ceil(min_score * size / (200 - min_score)).cast("int")


def _prefixed(keys: DataFrame, words: DataFrame, min_score: int) -> DataFrame:
    """(kind, key, words, prefix): each key's words, and the rarest of them by which it can be found."""
    each = keys.select("kind", "key", F.explode("words").alias("word"))
    ranked = lookup(each, words, "word", "inner", name="words").groupBy("kind", "key").agg(
        F.sort_array(F.collect_list(F.struct("n", "word"))).alias("ranked"))
    ordered = ranked.select("kind", "key", F.transform("ranked", lambda w: w["word"]).alias("words"))
    size = F.size("words")
    return ordered.withColumn("prefix", F.slice("words", F.lit(1), size - least_overlap(size, min_score) + 1))


def similar_keys(queries: DataFrame, keys: DataFrame, min_score: int = 80) -> DataFrame:
    """(kind, query, key, score) for every pair of a query key and a known key of one kind that scores
    ``min_score`` (1 to 100) or more.

    Both frames have ``kind`` and ``key``; repeated and null keys count once and never. Keys without a word
    have no pairs. What both sides share (words, counts) is written once to the checkpoint folder.
    """
    if not 1 <= min_score <= 100:
        raise ValueError("min_score must be 1 to 100")
    checkpoint_root(queries.sparkSession)

    def worded(df: DataFrame) -> DataFrame:
        # The kind is part of a word, so words meet only within a kind.
        named = F.transform(words_of(F.col("key")), lambda w: F.concat_ws(":", "kind", w))
        return df.select("kind", "key").where(F.col("key").isNotNull()).distinct().select("kind", "key", named.alias("words")).where(
            F.size("words") > 0).checkpoint()

    asked, known = worded(queries), worded(keys)
    counts = asked.unionByName(known).select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    left, right = (_prefixed(side, counts, min_score).checkpoint() for side in (asked, known))
    left = left.select("kind", F.col("key").alias("query"), F.col("words").alias("a"), F.col("prefix").alias("p"), F.explode("prefix").alias("word"))
    right = right.select("key", F.col("words").alias("b"), F.col("prefix").alias("q"), F.explode("prefix").alias("word"))
    met = salted_join(left, right, "word", "inner")
    a, b = F.size("a"), F.size("b")
    fits = (a >= least_overlap(b, min_score)) & (b >= least_overlap(a, min_score))
    # Prefixes are in one order: the first word they share is the one place where the pair is taken.
    first = F.get(F.array_intersect("p", "q"), 0) == F.col("word")
    return met.where(fits & first).select("kind", "query", "key", likeness(F.col("a"), F.col("b")).alias("score")).where(F.col("score") >= min_score)
