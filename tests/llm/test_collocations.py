"""Phrase mining against a brute force on Python strings and integers."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastro.llm import collocations
from tests.llm.conftest import DOCS


def brute(rows, min_count=10, top=2000, inside=50, max_words=3):
    f, n, first = {}, Counter(), {}
    for doc, text, lang in rows:
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        lang, at = "und" if lang is None else lang, 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, max_words + 1):
                for i in range(len(words) - size + 1):
                    phrase = tuple(words[i:i + size])
                    f.setdefault(lang, Counter())[phrase] += 1
                    if doc is not None:
                        key = lang, phrase
                        first[key] = min(first.get(key, (doc, at + i)), (doc, at + i))
            at += len(words)
    out = []
    for lang, counts in f.items():
        found = []
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        for p, a in candidates.items():
            if any(100 * b >= inside * a for q, b in candidates.items() if len(q) > len(p)
                   and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))):
                continue
            score, _, left, right = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                                        for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right, *first.get((lang, p), (None, None))))
        out += [(lang, k + 1, p.decode(), -a, left, right, n[lang], -s, doc, word)
                for k, (s, a, p, left, right, doc, word) in enumerate(sorted(found)[:top])]
    return sorted(out)


def got(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score, r.doc_id, r.word) for r in df.collect())


def sample(n=200, seed=2):
    rng = random.Random(seed)
    words = ["New", "york", "city", "été", "x", "日本", "a-b", "\x0btab", "the", "of"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", " ", ". ", ",", "\n", "!"]) for _ in range(rng.randint(0, 60)))
        rows.append((i % 150, text + " new York City" * (i % 3), rng.choice(["en", "fr", None])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, t, lang in rows], DOCS).repartition(4)


@pytest.mark.parametrize("bits", [collocations.FILTER_BITS, 16])
def test_mining_equals_brute_force(spark, bits):
    """With 2^16 bits in the filter too: a coarser filter counts more n-grams and changes nothing."""
    rows = sample()
    assert got(collocations.mine(frame(spark, rows), filter_bits=bits)) == brute(rows)
    assert got(collocations.mine(frame(spark, rows), filter_bits=bits, top=3)) == brute(rows, top=3)


def test_parts_of_a_long_text_and_full_tables(spark, monkeypatch):
    """Texts cut into parts at every few bytes, and tables passed on when almost empty."""
    rows = [*sample(40), (1000, "one two three. " * 400 + "w" * 900 + " one two" * 50, "en")]
    run = []
    for text in ("a b c d", "x" * 300 + " y", " \t. one two\nthree four five,six ", "", "..", "one two three " * 30):
        whole = collocations.Buffer([text.encode()], ["en"], [1])
        monkeypatch.setattr(collocations, "BUFFER", 5)
        parts = list(collocations._long(text.encode(), "en", 1, 3))
        monkeypatch.setattr(collocations, "BUFFER", 1 << 22)
        for n in (1, 2, 3):
            at = whole.grams(n)
            want = Counter(zip(whole.prints(at, n).tolist(), at.tolist(), strict=True))
            found = Counter()
            for p in parts:
                at = p.grams(n)
                found.update(zip(p.prints(at, n).tolist(), (at + p.base).tolist(), strict=True))
            assert found == want
        run.append(len(parts))
    assert max(run) > 10
    monkeypatch.setattr(collocations, "BUFFER", 50)
    monkeypatch.setattr(collocations, "MAX_ENTRIES", 4)
    frames = collocations._narrow(frame(spark, rows), "text", "lang", "doc_id").toArrow().to_batches()
    bitmaps = [np.full(16, 255, np.uint8)] * 3
    total = Counter()
    for batch in frames:
        for buffer in collocations.buffers(batch, 3):
            for out in collocations._materialise(buffer, bitmaps, 3):
                for r in out.to_pylist():
                    total[r["lang"], r["words"], r["phrase"]] += r["f"]
    want = Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        want[lang, 0, ""] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            want[lang, 0, ""] += len(words)
            want.update((lang, n, " ".join(words[i:i + n])) for n in (1, 2, 3) for i in range(len(words) - n + 1))
    assert {k: v for k, v in total.items() if v} == {k: v for k, v in want.items() if v}


def test_colliding_hashes_are_told_apart_by_the_text(spark, monkeypatch):
    """With every hash equal, counts still go by the words themselves."""
    monkeypatch.setattr(collocations, "_mix", lambda x: np.zeros_like(x))
    rows = sample(60)
    total = Counter()
    for batch in collocations._narrow(frame(spark, rows), "text", "lang", "doc_id").toArrow().to_batches():
        for buffer in collocations.buffers(batch, 3):
            for out in collocations._materialise(buffer, [np.full(16, 255, np.uint8)] * 3, 3):
                for r in out.to_pylist():
                    total[r["lang"], r["phrase"]] += r["f"]
    assert total["fr", "new york"] > 0
    for lang, phrase, a in {(x[0], x[2], x[3]) for x in brute(rows, min_count=1, inside=10**9)}:
        assert total[lang, phrase] == a


def test_odd_documents(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text, r.lang) for r in odd_docs.collect()]
    clash = odd_docs.withColumn("phrase", F.lit(1)).withColumn("FP", F.lit("x")).withColumn("rank", F.lit(2)).withColumn("word", F.lit(1))
    assert got(collocations.mine(clash, min_count=3)) == brute(rows, min_count=3)
    assert collocations.mine(no_docs).count() == 0
    nameless = odd_docs.where("length(text) < 100").withColumn("doc_id", F.lit(None).cast("long"))
    rows = [(None, r.text, r.lang) for r in nameless.collect()]
    assert got(collocations.mine(nameless, min_count=2)) == brute(rows, min_count=2)


def test_scores_beyond_64_bits(spark):
    a, left, right = 9 * 10**12, 10**13, 3 * 10**13
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(collocations.score("a", "l", "r").alias("s"))
    assert df.first().s == 10**6 * a * a // (left * right)
