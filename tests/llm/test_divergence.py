"""The source divergence audit against a dense brute force in Python integers."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cadastro.llm import source_divergence
from tests.llm.conftest import DOCS


def brute(rows, min_df=10, top=10):
    docs = []
    for text, lang, source in rows:
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        docs.append((lang or "", source or "", Counter(re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text))))
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in d[2])
        kept = [t for t, n in df.items() if n >= min_df]
        groups = {s: Counter() for _, s, _ in mine}
        for _, s, c in mine:
            groups[s].update({t: c[t] for t in kept if t in c})
        whole = sum(groups.values(), Counter())

        def share(c, t):
            return 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        for s, c in groups.items():
            parts = {"pair": [(o, sum(f(share(c, t), share(d, t)) for t in kept)) for o, d in groups.items() if o != s],
                     "term": [(t, f(share(c, t), share(whole, t))) for t in kept if c[t] and share(c, t) > share(whole, t)]}
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(items) if part == "pair" or k < top]
    return sorted(out)


def got(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect())


@pytest.mark.parametrize("terms", [source_divergence.MAX_TERMS, 20])
def test_audit_equals_brute_force(spark, terms):
    """Sources of very different size, a term in every document, groups without a kept term; a small
    table forces many spills."""
    rng = random.Random(3)
    words = ["Common"] + [f"w{c}" for c in "abcdefghijklmnopqrstuv"] + ["été", "日本", "ÉTÉ"]
    rows = []
    for i in range(300):
        source = "big" if i % 3 == 0 else f"s{i % 7}"
        text = " ".join(["common"] + [rng.choice(words[: 5 + (i % 7) * 3]) + rng.choice(["", ",", "1", "-x"]) for _ in range(rng.randint(0, 40))])
        rows.append((text, rng.choice(["en", "fr", None]), source))
    rows += [(None, "en", None), ("", "en", "void"), ("rare only here", "de", "one"), ("", "de", "two"), ("12 34", "it", "alone")]
    docs = spark.createDataFrame([(i, t, lang, s, 0) for i, (t, lang, s) in enumerate(rows)], DOCS).repartition(5)
    assert got(source_divergence.audit(docs, max_terms=terms)) == brute(rows)


def test_audit_of_odd_documents(spark, odd_docs, no_docs):
    rows = [(r.text, r.lang, r.source) for r in odd_docs.collect()]
    clash = odd_docs.withColumn("TERM", F.lit(1)).withColumn("g", F.lit("x")).withColumn("value", F.lit(2)).withColumn("rank", F.lit(1))
    assert got(source_divergence.audit(clash, min_df=2)) == brute(rows, min_df=2)
    assert source_divergence.audit(no_docs).count() == 0


def test_groups_too_many_to_broadcast(spark, odd_docs):
    rows = [(r.text, r.lang, r.source) for r in odd_docs.collect()]
    spark.conf.set("spark.cadastro.broadcastMaxBytes", "0")
    try:
        assert got(source_divergence.audit(odd_docs, min_df=2)) == brute(rows, min_df=2)
    finally:
        spark.conf.unset("spark.cadastro.broadcastMaxBytes")


def test_shares_beyond_64_bits(spark):
    rows = [(0, 1), (8 * 10**11, 9 * 10**14), (10**13 - 2, 10**13), (12345678901, 98765432109876)]
    df = spark.createDataFrame(rows, "n long, d long").select("n", "d", source_divergence.share(F.col("n"), F.col("d")).alias("p"))
    assert [(r.n, r.d, r.p) for r in df.collect()] == [(n, d, 1 + 10**9 * (n + 2) // d) for n, d in rows]


def test_pairs_of_a_long_stripe_are_summed_in_tiles(monkeypatch):
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(5)
    lists = [[(f"g{k:02}", int(rng.integers(1, 1000)), k + 1) for k in range(n)] for n in (40, 1, 2, 17, 40)]
    batch = pa.RecordBatch.from_arrays([
        pa.array([[e[0] for e in x] for x in lists], pa.list_(pa.string())),
        *(pa.array([[e[i] for e in x] for x in lists], pa.list_(pa.int64())) for i in (1, 2))], names=["g", "p", "p0"])

    def total():
        out = Counter()
        for b in source_divergence._shared_pairs([batch]):
            for r in b.to_pylist():
                out[r["g"], r["h"]] += r["value"]
        return out

    def f(p, q):
        return (p - q) ** 2 // (p + q)

    want = Counter()
    for x in lists:
        for i, (g, p, p0) in enumerate(x):
            for h, q, q0 in x[i + 1:]:
                want[g, h] += f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)
    assert total() == want
    monkeypatch.setattr(source_divergence, "_PAIRS", 7)
    assert total() == want
