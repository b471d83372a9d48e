"""Source divergence audit: how far the sources of a language differ in the terms they use.

1. In-mapper stripes. A task folds whole documents into hash stripes, a stripe being a term's document
   frequency and its count per source. Terms get numbers from a hash table, and stripes are summed on
   the numbers in numpy. The table is bounded: when it is full, all its stripes are spilled.
2. Spilled stripes are shuffled and sorted by (language, term) and merged one term at a time. Terms in
   fewer than ``min_df`` documents of their language end here.
3. The merged stripes emit the divergences. With p a term's smoothed share in a group (scaled to 10^9)
   and f(p, q) = floor((p - q)^2 / (p + q)), a pair of sources scores the sum of f over all kept terms.
   A stripe names only the sources that have its term; the others share one constant p0 each. So

       sum f = V f(p0, q0) + sum over terms of one [f(p, q0) - f(p0, q0)] + the same of the other
               + sum over terms of both [f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)],

   and the work is that of the stripes' own pairs, not of every term times every pair of sources.

All arithmetic is on integers and exact while a language has fewer than 9 * 10^15 term occurrences.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import byte_parts, checked_join, materialise, slices

SCALE = 1_000_000_000
MIN_DF = 10
TOP_TERMS = 10
# Letters and everything beyond ASCII; upper-case ASCII is gone by the time this is applied.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_BREAK = re.compile(rb"[^A-Za-z\x80-\xff]")
# Terms, their bytes, and (term, group) entries that a task holds before it spills.
MAX_TERMS = 1 << 20
MAX_BYTES = 64 << 20
MAX_ENTRIES = 1 << 21
_PAIRS = 1 << 20
_ROWS = 20_000


class _Numbers(dict):
    """Hash table: key -> number, in order of arrival; ``size``: the keys' lengths."""

    size = 0

    def __missing__(self, key):
        self[key] = n = len(self)
        self.size += len(key)
        return n


class Stripes:
    """A task's table: stripes as parallel arrays (group << 32 | term, count, documents), summed now and then."""

    def __init__(self, max_terms: int = MAX_TERMS):
        self.max_terms = max_terms
        self._clear()

    def _clear(self) -> None:
        self.terms, self.groups = _Numbers({b"": 0}), _Numbers()
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.entries = 0

    def fold(self, groups: list[tuple[str, str]], texts: list[str | None]) -> None:
        """Add some documents of (language, source) groups. The empty term counts the documents themselves."""
        numbers, sizes = [], []
        of = self.terms.__getitem__
        for text in texts:
            size = 1
            numbers.append(np.zeros(1, np.int64))
            for part in byte_parts((text or "").encode(), _BREAK):
                found = _TERM.findall(part.lower())
                numbers.append(np.fromiter(map(of, found), np.int64, len(found)))
                size += len(found)
            sizes.append(size)
        group = np.fromiter(map(self.groups.__getitem__, groups), np.int64, len(groups))
        term = np.concatenate(numbers)
        # A document's occurrences of a term become one entry, then the entries of a group.
        owner = np.repeat(np.arange(len(texts)), sizes)
        pair, count = np.unique(owner * len(self.terms) + term, return_counts=True)
        owner, term = np.divmod(pair, len(self.terms))
        self._hold(*_summed(group[owner] << 32 | term, count.astype(np.int64), np.ones(len(pair), np.int64)))

    def _hold(self, key: np.ndarray, count: np.ndarray, docs: np.ndarray) -> None:
        self.held.append((key, count, docs))
        self.entries += len(key)
        if self.entries > 2 * MAX_ENTRIES:
            self.held = [_summed(*(np.concatenate(x) for x in zip(*self.held, strict=True)))]
            self.entries = len(self.held[0][0])

    @property
    def full(self) -> bool:
        return len(self.terms) > self.max_terms or self.terms.size > MAX_BYTES or len(self.groups) > self.max_terms or self.entries > MAX_ENTRIES

    def spill(self):
        """All stripes as batches; the table is empty afterwards."""
        if self.held:
            key, count, docs = _summed(*(np.concatenate(x) for x in zip(*self.held, strict=True)))
            names = list(self.groups)
            langs = _Numbers()
            lang_of = np.array([langs[lang] for lang, _ in names], np.int64)
            group, term = key >> 32, key & 0xFFFFFFFF
            order = np.lexsort((term, lang_of[group]))
            group, term, count, docs = (x[order] for x in (group, term, count, docs))
            lang = lang_of[group]
            starts = np.flatnonzero(np.diff(term, prepend=-1).astype(bool) | np.diff(lang, prepend=-1).astype(bool))
            df = np.add.reduceat(docs, starts)
            edges = np.append(starts, len(term))
            terms = pa.array(list(self.terms), pa.binary()).cast(pa.string())
            sources, langs = pa.array([s for _, s in names], pa.string()), pa.array(list(langs), pa.string())
            for lo in range(0, len(starts), _ROWS):
                at = starts[lo:lo + _ROWS]
                ends = edges[lo:lo + _ROWS + 1]
                offsets = pa.array((ends - ends[0]).astype(np.int32))
                inside = slice(int(ends[0]), int(ends[-1]))
                yield pa.RecordBatch.from_arrays(
                    [langs.take(pa.array(lang[at])), terms.take(pa.array(term[at])), pa.array(df[lo:lo + _ROWS]),
                     pa.ListArray.from_arrays(offsets, sources.take(pa.array(group[inside]))),
                     pa.ListArray.from_arrays(offsets, pa.array(count[inside]))], names=_NAMES)
        self._clear()


def _summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, sorted, with the sums of their values."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return (key[first], *(np.add.reduceat(v[order], first) for v in values))


_FIELDS = "lang string, term string, df long, sources array<string>, counts array<long>"
_NAMES = ["lang", "term", "df", "sources", "counts"]


def stripes(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
            max_terms: int = MAX_TERMS) -> DataFrame:
    """Unmerged stripes of all documents: lang, term, df, sources, counts. The term '' counts documents."""
    def text_of(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    narrow = docs.select(text_of(lang_col).alias("lang"), text_of(source_col).alias("source"), text_of(text_col).alias("text"))

    def run(batches):
        table = Stripes(max_terms)
        for batch in batches:
            for start, texts in slices(batch, 2):
                langs, sources = (batch.column(i).slice(start, len(texts)).to_pylist() for i in (0, 1))
                table.fold(list(zip(langs, sources, strict=True)), texts)
                if table.full:
                    yield from table.spill()
        yield from table.spill()

    return narrow.mapInArrow(run, _FIELDS)


def merge(spilled: DataFrame, min_df: int = MIN_DF) -> DataFrame:
    """One stripe a term of at least ``min_df`` documents in its language (the term '' always stays)."""

    def run(batches):
        held = None  # the last term's stripe so far: it may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            merged = _merged(batch if held is None else pa.concat_batches([held, batch]), min_df)
            held = merged.slice(merged.num_rows - 1)
            yield merged.slice(0, merged.num_rows - 1)
        if held is not None and (held.column(2)[0].as_py() >= min_df or held.column(1)[0].as_py() == ""):
            yield held

    return spilled.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(run, _FIELDS)


def _merged(batch: pa.RecordBatch, min_df: int) -> pa.RecordBatch:
    """Stripes sorted by key -> one a key, less those of too few documents (the last key stays, it may be cut off)."""
    lang, term = batch.column(0), batch.column(1)
    fresh = np.ones(batch.num_rows, bool)
    fresh[1:] = pc.or_(*(pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)) for c in (lang, term))).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(fresh)
    df = np.add.reduceat(batch.column(2).to_numpy(), starts)
    wanted = df >= min_df
    wanted |= pc.equal(term.take(pa.array(starts)), "").to_numpy(zero_copy_only=False)
    wanted[-1] = True
    rows = wanted[np.cumsum(fresh) - 1]
    part = batch.filter(pa.array(rows))
    stripe = np.cumsum(fresh[rows]) - 1
    names = part.column(3).flatten().dictionary_encode()
    code = names.indices.to_numpy().astype(np.int64)
    key = np.repeat(stripe, pc.list_value_length(part.column(3)).to_numpy()) * len(names.dictionary) + code
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    counts = np.add.reduceat(part.column(4).flatten().to_numpy()[order], first)
    found = key[order][first]
    offsets = pa.array(np.searchsorted(found, np.arange(len(df[wanted]) + 1) * len(names.dictionary)).astype(np.int32))
    keys = pa.array(starts[wanted])
    return pa.RecordBatch.from_arrays(
        [lang.take(keys), term.take(keys), pa.array(df[wanted]),
         pa.ListArray.from_arrays(offsets, names.dictionary.take(pa.array(found % len(names.dictionary)))),
         pa.ListArray.from_arrays(offsets, pa.array(counts))], names=["lang", "term", "df", "sources", "counts"])


def share(count: Column, total: Column) -> Column:
    """1 + floor(10^9 (count + 2) / total) by long division, so that no product passes 64 bits."""
    whole, rest = _div(count + 2, total), (count + 2) % total
    for _ in range(3):
        whole, rest = whole * 1000 + _div(rest * 1000, total), (rest * 1000) % total
    return whole + 1


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) of shares scaled to 10^9."""
    return _div((p - q) * (p - q), p + q)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _np_divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _shared_pairs(batches):
    """Rows (names, p, p0) of merged stripes -> sums over each pair of names of one stripe of
    f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0), a row per pair and tile."""
    for batch in batches:
        lists = batch.column(0)
        names = lists.flatten().dictionary_encode()
        code = names.indices.to_numpy().astype(np.int64)
        p, p0 = (batch.column(i).flatten().to_numpy() for i in (1, 2))
        size = pc.list_value_length(lists).to_numpy()
        last = np.repeat(np.cumsum(size), size)  # end of each entry's stripe
        partners = last - np.arange(len(code)) - 1  # entries behind it in its stripe
        edges = np.concatenate([[0], np.cumsum(partners)])
        i = 0
        while i < len(code):
            j = max(i + 1, int(np.searchsorted(edges, edges[i] + _PAIRS, side="right")) - 1)
            # One entry's partners may still be many: they are gone through in tiles.
            for at in range(0, int(edges[j] - edges[i]), _PAIRS):
                flat = np.arange(edges[i] + at, min(edges[j], edges[i] + at + _PAIRS))
                a = np.searchsorted(edges, flat, side="right") - 1
                b = a + 1 + (flat - edges[a])
                f = _np_divergence
                value = f(p[a], p[b]) - f(p[a], p0[b]) - f(p0[a], p[b]) + f(p0[a], p0[b])
                pair, back = np.unique(code[a] * len(names.dictionary) + code[b], return_inverse=True)
                total = np.zeros(len(pair), np.int64)
                np.add.at(total, back, value)
                yield pa.RecordBatch.from_arrays(
                    [names.dictionary.take(pa.array(pair // len(names.dictionary))),
                     names.dictionary.take(pa.array(pair % len(names.dictionary))), pa.array(total)], names=["g", "h", "value"])
            i = j


def audit(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_df: int = MIN_DF,
          top_terms: int = TOP_TERMS, max_terms: int = MAX_TERMS) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) for every (lang, source) that occurs.

    Part ``pair``: item is each other source of the language, value their divergence over all kept
    terms (0 where the language keeps none). Part ``term``: the ``top_terms`` terms that set the source
    off most from its language as a whole, of those it uses more than the language does. Ranks go by
    value descending, then item in UTF-8 order.

    Null text, language and source read as ''. Empty texts count as documents without terms; very long
    texts are cut between terms while they are folded, so only their table of terms is held; repeated
    rows count as often as they come; an empty table gives an empty result; extra columns are not read.
    A stripe holds at most one count per source. The list of groups is joined by a broadcast only below a
    measured size, else by a salted shuffle.
    """
    kept = materialise(merge(stripes(docs, text_col=text_col, lang_col=lang_col, source_col=source_col, max_terms=max_terms), min_df),
                       "stripes")
    is_term = F.col("term") != ""
    entries = kept.select("lang", "term", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("lang_count"),
                          F.explode(F.arrays_zip("sources", "counts")).alias("e")).select(
        "lang", "term", "lang_count", F.col("e.sources").alias("source"), F.col("e.counts").alias("n"), _group("lang", "e.sources").alias("g"))
    sizes = entries.groupBy("lang", "source", "g").agg(F.sum(F.when(is_term, F.col("n")).otherwise(0)).alias("group_total"))
    sizes = materialise(sizes, "stripe_groups")
    langs = materialise(sizes.groupBy("lang").agg(F.sum("group_total").alias("lang_total")).join(
        kept.groupBy("lang").agg(F.count_if(is_term).alias("v")), "lang"), "stripe_langs")
    groups = checked_join(sizes, langs, "lang")
    groups = materialise(groups.select(
        "lang", "source", "g", "v", (F.col("group_total") + 2 * F.col("v")).alias("d"), (F.col("lang_total") + 2 * F.col("v")).alias("lang_d"),
        # Without kept terms there is nothing to share; 1 stands in for the constant that is never summed.
        F.when(F.col("v") > 0, share(F.lit(0).cast("long"), F.greatest(F.col("group_total") + 2 * F.col("v"), F.lit(1)))).otherwise(1).alias("p0")),
        "stripe_shares")
    shared = materialise(
        checked_join(entries.where(is_term).drop("lang", "source"), groups, "g").select(
            "lang", "source", "g", "term", "p0", share(F.col("n"), F.col("d")).alias("p"),
            share(F.col("lang_count"), F.col("lang_d")).alias("q")), "stripe_entries")

    apart = divergence(F.col("p"), F.col("q"))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = shared.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), apart.alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top_terms)

    other = groups.select("lang", F.col("g").alias("h"), F.col("p0").alias("q0"))
    none = checked_join(groups.select("lang", "g", "p0", "v"), other, "lang").where("g <> h").select(
        "g", "h", (F.col("v") * divergence(F.col("p0"), F.col("q0"))).alias("value"))
    histogram = materialise(shared.groupBy("lang", "g", "p0", "p").count(), "stripe_histogram")
    one = checked_join(histogram, other, "lang").where("g <> h").select("g", "h", (F.col("count") * (
        divergence(F.col("p"), F.col("q0")) - divergence(F.col("p0"), F.col("q0")))).alias("value"))
    one = one.groupBy("g", "h").agg(F.sum("value").alias("value"))
    lists = shared.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("g", "p", "p0"))).alias("s")).where(F.size("s") > 1)
    both = lists.select("s.g", "s.p", "s.p0").mapInArrow(_shared_pairs, "g string, h string, value long")
    flipped = [x.select(F.col("h").alias("g"), F.col("g").alias("h"), "value") for x in (one, both)]
    summed = none.unionByName(one).unionByName(both).unionByName(flipped[0]).unionByName(flipped[1]).groupBy("g", "h").agg(
        F.sum("value").alias("value"))
    left = groups.select("g", "lang", "source")
    right = groups.select(F.col("g").alias("h"), F.col("source").alias("item"))
    pairs = checked_join(checked_join(summed, left, "g"), right, "h").select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    return pairs.withColumn("rank", F.row_number().over(best)).unionByName(terms)


def _group(lang: str, source: str) -> Column:
    """One string for a (language, source) pair."""
    return F.concat(F.length(lang).cast("string"), F.lit(":"), F.col(lang), F.col(source))


SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM documents
), occurrences AS (SELECT i, lang, source, unnest(words) AS term FROM docs),
kept AS (SELECT lang, term FROM occurrences GROUP BY ALL HAVING count(DISTINCT i) >= 10),
groups AS (SELECT DISTINCT lang, source FROM docs),
sized AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counted AS (SELECT lang, source, term, count(*) AS n FROM occurrences JOIN kept USING (lang, term) GROUP BY ALL),
group_totals AS (SELECT lang, source, sum(n) AS t FROM counted GROUP BY ALL),
lang_counted AS (SELECT lang, term, sum(n) AS n FROM counted GROUP BY ALL),
lang_totals AS (SELECT lang, sum(n) AS t FROM lang_counted GROUP BY ALL),
p AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2)) // (coalesce(t.t, 0) + 2 * s.v) AS p
    FROM groups g JOIN kept k USING (lang) JOIN sized s USING (lang)
    LEFT JOIN group_totals t ON t.lang = g.lang AND t.source = g.source
    LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), q AS (
    SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (n + 2)) // (t + 2 * v) AS q
    FROM lang_counted JOIN lang_totals USING (lang) JOIN sized USING (lang)
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    GROUP BY ALL
), terms AS (
    SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
    FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (FROM pairs UNION ALL FROM terms)
QUALIFY part = 'pair' OR row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) <= 10
"""
