"""Language and quality models: held-out accuracy and edge cases."""

import base64
import random
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastro.llm import language_id, quality, queries
from tests.conftest import SF01
from tests.llm.conftest import TEXTS


def test_languages_of_held_out_documents(spark):
    truth = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang")
    found = queries.op2_language_id(spark, SF01).join(truth, "doc_id").where("held_out")
    right, all_ = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert all_ > 100 and right / all_ > 0.98


def test_language_edge_cases(odd_docs, no_docs):
    profiles = language_id.learn(odd_docs)
    assert profiles.languages == ["en", "fr"]
    clash = odd_docs.withColumn("Score", F.lit("x")).withColumn("LANG_PRED", F.lit(1))
    rows = language_id.predict(clash, profiles).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    assert language_id.predict(no_docs, profiles).count() == 0
    nothing = language_id.learn(no_docs)
    assert {r.lang_pred for r in language_id.predict(odd_docs, nothing).collect()} == {"und"}
    kept = language_id.keep_known_languages(clash, profiles)
    assert kept.columns == clash.columns and kept.where("text is null").count() == 0


def test_gibberish_and_unknown_languages_go_and_short_clean_texts_stay(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("text", "lang")
    profiles = language_id.learn(docs)
    rng = random.Random(7)

    def words(letters, n):
        return " ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(n))

    latin, cyrillic, han = string.ascii_lowercase, [chr(c) for c in range(0x430, 0x450)], [chr(c) for c in range(0x4E00, 0x5E00)]
    bad = [words(letters, n) for letters in (latin, cyrillic, han) for n in (25, 100, 1000) for _ in range(50)]
    bad += [base64.b64encode(rng.randbytes(600)).decode() for _ in range(50)] + [rng.randbytes(2000).hex() for _ in range(50)]
    known = [r.text for r in docs.collect() if r.text]
    bad += [t.lower().translate({97 + k: 0x561 + k for k in range(26)}) for t in known if len(t) > 1000][:50]
    short = [" ".join(t.split()[:n]) for t in known for n in (1, 2, 5, 10)]
    clean = [t for t in known + short + ["yes yes yes " * 40] if any(c.isalpha() for c in t)]
    texts = spark.createDataFrame([("bad", t) for t in bad] + [("clean", t) for t in clean], "level string, text string")
    kept = language_id.keep_known_languages(texts, profiles)
    found = dict(kept.groupBy("level").count().collect())
    assert found.get("bad", 0) <= 0.02 * len(bad) and found["clean"] >= 0.999 * len(clean)


def test_bundle_is_the_sum_over_trigrams():
    texts = ["abc ab", "b", None, "éa abc"]
    got = language_id.bundle(texts, np.arange(4), 4, 64, 3)
    table = language_id._symbol_of()
    first, second, third = language_id._letter_vectors(64, 3)
    for text, vector in zip(texts, got):
        want = np.zeros(64)
        for word in (text or "").split():
            s = [0, *(int(table[ord(c)]) for c in word), 0]
            for a, b, c in zip(s, s[1:], s[2:]):
                want += first[a].astype(int) * second[b] * third[c]
        assert (vector == want).all()


def test_long_text_is_bundled_in_parts(monkeypatch):
    text = "some words of a text, in parts; " * 50
    whole = language_id.bundle([text], np.array([0]), 1, 64, 3)
    monkeypatch.setattr(language_id, "_BLOCK_CHARS", 37)
    assert (language_id.bundle([text], np.array([0]), 1, 64, 3) == whole).all()


def test_letters_of_every_alphabet_have_their_own_vectors():
    """The same words in Latin, Cyrillic, Armenian and CJK letters; letters that were one class mod 5 differ."""
    words = "the quick brown fox jumps over a lazy dog while some small birds sing " * 3
    for first in (0x430, 0x561, 0x4E00):
        text = words.translate({97 + k: first + k for k in range(26)})
        table = language_id._symbol_of()
        assert len({int(table[first + k]) for k in range(26)}) == 26 and 0 not in table[first:first + 26]
        other = text.translate({first + k: first + k + 5 for k in range(26)})
        profiles = language_id.bundle([text, other, words], np.arange(3), 3, 1024, 20)
        norms = np.linalg.norm(profiles, axis=1)
        assert np.allclose(norms, norms[2], rtol=0.1) and abs(profiles[0] @ profiles[1]) < 0.2 * norms[0] * norms[1]


def test_pairs_and_matrix_give_the_same_bundles():
    rng = np.random.default_rng(6)
    texts = ["".join(chr(c) for c in rng.integers(0x4E00, 0x4E00 + 3000, 200)) + " same end" for _ in range(40)]
    together = language_id.bundle(texts, np.arange(40), 40, 128, 3)
    assert (together == np.concatenate([language_id.bundle([t], np.array([0]), 1, 128, 3) for t in texts])).all()
    assert (language_id.bundle(texts, np.zeros(40, int), 1, 128, 3)[0] == together.sum(axis=0)).all()


def test_quality_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF01}/labels.parquet").select("doc_id", "quality")
    rows = queries.op8_quality_classifier(spark, SF01).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 60
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)


def test_trees_learn_and_flatten():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    trees = quality.fit_trees(x[:2000], y[:2000])
    assert ((trees.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95

    def walk(row):  # one row, one tree, one node at a time
        total = trees.base
        for f, t, leaf in zip(trees.feature, trees.threshold, trees.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + (row[f[node]] > t[node])
            total += leaf[node - len(f)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(trees.score(x[:50]), [walk(r) for r in x[:50]])


def test_quality_edge_cases(spark, odd_docs, no_docs):
    ids = [r.doc_id for r in odd_docs.select("doc_id").distinct().collect()]
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)] + [(ids[0], 1), (None, 1), (10**9, None)], "doc_id long, quality int")
    trees = quality.fit(odd_docs, labels)
    clash = odd_docs.withColumn("PREDICTED", F.lit("x")).withColumn("score", F.lit("y"))
    rows = quality.score(clash, trees).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.text == TEXTS[0]}) == 1
    assert quality.score(no_docs, trees).count() == 0
    blank = quality.fit(no_docs, labels)
    assert {r.score for r in quality.score(odd_docs, blank).collect()} == {0.5}
    assert quality.keep_good(clash, trees).columns == clash.columns


@pytest.mark.parametrize("text", [None, ""])
def test_statistics_of_nothing(text):
    assert quality.statistics(text) == [0.0] * len(quality.FEATURES)
