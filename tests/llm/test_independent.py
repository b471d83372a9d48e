"""Language, fingerprints, trees and the whole pipeline against plain programs that share no code with them."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tokenizers
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from cadastro.llm import fingerprints, quality, queries
from tests.conftest import SF001
from tests.llm.conftest import TEXTS
from tests.llm.test_dedup import classes, simhash
from tests.llm.test_mix_chat_search import targets_by_rounds, words

FULL = (1 << 64) - 1


def splitmix(z):
    z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 & FULL
    z = (z ^ z >> 27) * 0x94D049BB133111EB & FULL
    return z ^ z >> 31


class Languages:
    """Letters, trigrams, texts and languages as vectors, one at a time."""

    def __init__(self, dim=1024, seed=20):
        self.dim, self.seed, self.letters, self.grams = dim, seed, {}, {}

    def letter(self, c):
        if c not in self.letters:
            signs = []
            for word in range(self.dim // 64):
                z = (ord(c) if c else 0) << 32 | word
                for salt in (self.seed, 0):
                    z = splitmix(z + (salt + 1) * 0x9E3779B97F4A7C15 & FULL)
                signs += [1 if z >> 8 * byte + 7 - bit & 1 else -1 for byte in range(8) for bit in range(8)]
            self.letters[c] = np.array(signs)
        return self.letters[c]

    def gram(self, a, b, c):
        if (a, b, c) not in self.grams:
            self.grams[a, b, c] = np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)
        return self.grams[a, b, c]

    def profile(self, text):
        total, n = np.zeros(self.dim), 0
        for word in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split(" "):
            letters = ["", *word, ""] if word else []
            for gram in zip(letters, letters[1:], letters[2:]):
                total += self.gram(*gram)
                n += 1
        return total, n

    def learn(self, rows):
        sums, sizes = defaultdict(lambda: np.zeros(self.dim)), Counter()
        for text, lang in rows:
            vector, n = self.profile(text)
            if lang is not None and n:
                sums[lang] += vector
                sizes[lang] += n
        self.known = {lang: sums[lang] for lang in sorted(sums)}
        self.weight = {}
        for lang, v in self.known.items():
            length = np.linalg.norm(v) / math.sqrt(self.dim)
            self.weight[lang] = max(length**2 - sizes[lang], 0) / (max(sizes[lang] - 1, 1) * length)
        return self

    def predict(self, text):
        """(language, cosine, whether it is known well enough)."""
        vector, n = self.profile(text)
        if not n or not self.known:
            return "und", 0.0, False
        norm = np.linalg.norm(vector)
        cosine = {lang: vector @ v / np.linalg.norm(v) / norm for lang, v in self.known.items()}
        best = max(cosine, key=cosine.get)
        level = max(min(self.weight[best] * n * math.sqrt(self.dim) / norm, 0.8) / 2 - 4.5 / math.sqrt(self.dim), 0)
        score = min(1.0, max(0.0, cosine[best]))
        return best, score, score >= level


def test_languages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in docs}
    plain = Languages().learn((r.text, r.lang) for r in docs if not held[r.doc_id])
    got = {r.doc_id: r for r in queries.op2_language_id(spark, SF001).collect()}
    assert got.keys() == held.keys()
    for r in docs:
        lang, score, _ = plain.predict(r.text)
        assert (got[r.doc_id].held_out, got[r.doc_id].lang_pred) == (held[r.doc_id], lang)
        assert got[r.doc_id].score == pytest.approx(score, abs=1e-5)


def plain_fingerprint(text, bins=512, bits=4, golden=0x9E3779B97F4A7C15, step=0xBF58476D1CE4E5B9):
    h = [xxhash.xxh64_intdigest(w) for w in (text or "").encode().split()]
    width, least = min(5, len(h)), {}
    for i in range(max(1, len(h) - 4)):
        total = width
        for k in range(width):
            total = splitmix(total + h[i + k] & FULL)
        least[total >> 55] = min(total, least.get(total >> 55, FULL))
    out = 0
    for b in range(bins):
        asked = [b, *(splitmix(attempt * bins + b + golden & FULL) % bins for attempt in range(64))]
        full = next((a for a in asked if a in least), None)
        if full is None:
            full = min((a for a in least if a >= b), default=min(least))
        out = out << bits | splitmix(least[full] + b * step & FULL) % 2**bits
    return f"{out:0{bins * bits // 4}x}"


def test_fingerprints_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    texts = TEXTS + [" ".join(map(str, rng.integers(0, 50, n))) for n in (2, 4, 5, 6, 20, 100, 1000, 4000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(docs).collect()}
    assert got == {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    whole = {r.doc_id: r for r in fingerprints.compare_with_next(docs).collect()}
    for i, t in enumerate(texts):
        t, following = t or "", texts[(i + 1) % len(texts)] or ""
        own, new, nxt = (plain_fingerprint(x) for x in (t, t[:len(t) - len(t) // 2] + following[:len(t) // 2], following))
        assert (whole[i].fingerprint, whole[i].edited_fingerprint) == (own, new)
        for other, near in ((new, whole[i].near_edited), (nxt, whole[i].near_next)):
            share = sum(a == b for a, b in zip(own, other)) / 512
            assert near == pytest.approx(min(1, max(0, (share - 1 / 16) / (15 / 16))))


def test_trees_equal_exhaustive_search():
    """Boosted trees grown node by node, every cut of every feature tried."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 3)).round(2)
    y = ((x[:, 0] > 0.2) & (x[:, 1] < 0.5) | (x[:, 2] > 1)).astype(float)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 65)[1:-1])) for j in range(3)]
    logit = np.full(400, math.log(y.mean() / (1 - y.mean())))

    def grow(rows, depth, grad, hess):
        g, h = grad[rows].sum(), hess[rows].sum()
        if not depth:
            logit[rows] -= 0.15 * g / (h + 1)
            return
        gains = {}
        for j in range(3):
            for cut in edges[j]:
                left = rows[x[rows, j] <= cut]
                gl, hl = grad[left].sum(), hess[left].sum()
                if hl >= 2 and h - hl >= 2:
                    gains[j, cut] = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
        j, cut = max(gains, key=gains.get) if gains and max(gains.values()) > 1e-9 else (0, math.inf)
        grow(rows[x[rows, j] <= cut], depth - 1, grad, hess)
        grow(rows[x[rows, j] > cut], depth - 1, grad, hess)

    for _ in range(5):
        p = 1 / (1 + np.exp(-logit))
        grow(np.arange(400), 3, p - y, p * (1 - p))
    trees = quality.fit_trees(x, y, n_trees=5, depth=3)
    assert np.allclose(trees.score(x), 1 / (1 + np.exp(-logit)), atol=1e-9)


def survivors(rows):
    """(id, text) of the row that stays of each group of near duplicates."""
    group = classes([(i, simhash(r.text)) for i, r in enumerate(rows)])
    stay = {}
    for i, r in enumerate(rows):
        digest = xxhash.xxh64_intdigest((r.text or "").encode(), 42) if r.text is not None else 42
        rank = (r.doc_id is None, r.doc_id or 0, digest - (1 << 64) * (digest >> 63))
        stay[group[i]] = min(stay.get(group[i], (rank, r.text)), (rank, r.text), key=lambda s: s[0])
    return Counter((None if rank[0] else rank[1], text) for rank, text in stay.values())


def rates(sizes, target, most=3):
    """Copies of a document by its size: one tilt, found by halving, brings the source to its target."""
    mean = np.mean([s for s in sizes if s] or [1])
    low, high = -200.0, 200.0
    for _ in range(200):
        tilt = (low + high) / 2
        rate = {s: most / (1 + (most - 1) * math.exp(min(700, max(-700, -tilt * s / mean)))) for s in sizes}
        low, high = (tilt, high) if sum(rate[s] * s for s in sizes) < target else (low, tilt)
    return rate


def test_every_stage_of_the_pipeline_equals_brute_force_on_odd_documents(spark, odd_docs, tmp_dir):
    """The given documents and odd ones with the same ids: nulls, repeats, a very long text, clashing columns."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select(odd_docs.columns).unionByName(odd_docs).unionByName(
        odd_docs.where("text like 'The first%'").withColumn("doc_id", F.lit(None).cast("long"))).withColumns(
        {c: F.lit(c) for c in ("score", "KEPT", "_rate", "column1", "first")})
    names = docs.columns
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    rows = docs.collect()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF001)
        if name != "best-fit packing":
            assert out.columns == names
            out.write.parquet(f"{tmp_dir}/odd{k}")
            out = spark.read.schema(docs.schema).parquet(f"{tmp_dir}/odd{k}")
        kept = out.collect()
        if name == "quality classifier":
            trees = quality.fit(docs, labels)
            want = Counter((r.doc_id, r.text) for r in rows if trees.score(np.array([quality.statistics(r.text)]))[0] >= 0.7)
        elif name == "language ID":
            plain = Languages().learn((r.text, r.lang) for r in rows)
            want = Counter((r.doc_id, r.text) for r in rows if plain.predict(r.text)[2])
        elif name == "SimHash near-dedup":
            want = survivors(rows)
        elif name == "mixing sources":
            want = None
            sizes = defaultdict(list)
            for r in rows:
                sizes[r.source].append(words(r.text))
            targets, taken = targets_by_rounds({s: sum(n) for s, n in sizes.items()}), Counter()
            copies = Counter((r.doc_id, r.text, r.source) for r in kept)
            assert set(copies) <= {(r.doc_id, r.text, r.source) for r in rows}
            for r in rows:
                n, rate = copies[r.doc_id, r.text, r.source], rates(sizes[r.source], targets[r.source])[words(r.text)]
                assert math.floor(rate - 1e-4) <= n <= min(3, math.ceil(rate + 1e-4))
                taken[r.source] += n * words(r.text)
            for s, n in sizes.items():
                assert abs(taken[s] - targets[s]) <= max(0.01 * targets[s], max(n) / 2)
        else:
            assert sum(Counter((r.doc_id, r.text) for r in rows).values()) == len([r for r in kept if r.piece == 0])
            library, want = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), Counter()
            for r in rows:
                ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 0]
                for piece, at in enumerate(range(0, len(ids), 2048)):
                    part = ids[at:at + 2048]
                    want[r.doc_id, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
            assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in kept) == want
            filled = defaultdict(list)
            for r in kept:
                filled[r.sequence_id].append((r.offset, r.length))
            for places in filled.values():
                ends = np.cumsum([n for _, n in sorted(places)])
                assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 2048
            break
        if want is not None:
            assert Counter((r.doc_id, r.text) for r in kept) == want, name
        assert kept and all(r.KEPT == "KEPT" and r.score == "score" and r.column1 == "column1" for r in kept)
        docs, rows = out, kept
