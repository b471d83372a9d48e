"""Fingerprints, SimHash near duplicates and the pipeline against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from cadastro.llm import fingerprints, simhash_dedup
from tests.conftest import SF001
from tests.llm.conftest import DOCS, TEXTS


def shingles(text):
    w = (text or "").encode().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}


def test_fingerprints_estimate_similarity():
    rng = random.Random(4)
    errors = []
    for _ in range(200):
        a = [rng.choice("abcdefghijklmnop") * rng.randint(1, 4) for _ in range(rng.choice([3, 30, 300, 3000]))]
        b = a[:]
        for _ in range(rng.randint(0, len(a) // 10)):
            b[rng.randrange(len(b))] = "new"
        a, b = " ".join(a), " ".join(b)
        x, y = shingles(a), shingles(b)
        prints = [fingerprints.fingerprint(fingerprints.shingle_hashes(t)) for t in (a, b)]
        errors.append(fingerprints.likeness(*prints) - len(x & y) / len(x | y))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.04


def test_fingerprints_of_equal_and_unlike_short_texts():
    prints = [fingerprints.fingerprint(fingerprints.shingle_hashes(f"only {i}")) for i in range(60)]
    assert max(fingerprints.likeness(a, b) for i, a in enumerate(prints) for b in prints[:i]) < 0.15
    empty = fingerprints.fingerprint(fingerprints.shingle_hashes(None))
    assert empty == fingerprints.fingerprint(fingerprints.shingle_hashes(" \n")) and fingerprints.likeness(empty, empty) == 1.0
    assert fingerprints.likeness(empty, prints[0]) < 0.15


@pytest.mark.parametrize("partitions", [1, 7])
def test_compare_with_next(spark, partitions):
    rows = [(3 * i, t, "en", "s", 0) for i, t in enumerate(TEXTS)]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, DOCS).withColumn("FINGERPRINT", F.lit(1))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(partitions == 1).lower())
    try:
        got = sorted(fingerprints.compare_with_next(docs).collect(), key=lambda r: r.doc_id)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    rows.sort()
    assert [r.doc_id for r in got] == [r[0] for r in rows]
    for k, r in enumerate(got):
        text, following = rows[k][1] or "", rows[(k + 1) % len(rows)][1] or ""
        changed = text[:len(text) - len(text) // 2] + following[:len(text) // 2]
        own, new, nxt = (fingerprints.fingerprint(fingerprints.shingle_hashes(t)) for t in (text, changed, following))
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (own.hex(), new.hex())
        assert (r.near_edited, r.near_next) == (fingerprints.likeness(own, new), fingerprints.likeness(own, nxt))


def test_compare_with_next_of_one_or_no_document(spark, no_docs):
    one = spark.createDataFrame([(5, "a b c d e f", None, None, 0)], DOCS)
    assert [(r.doc_id, r.near_next) for r in fingerprints.compare_with_next(one).collect()] == [(5, 1.0)]
    assert fingerprints.compare_with_next(no_docs).count() == 0
    assert fingerprints.fingerprints(no_docs).count() == 0


def simhash(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def classes(items, distance=4):
    """id -> smallest id reachable, over all pairs."""
    parent = {i: i for i, _ in items}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, a) in enumerate(items):
        for j, b in items[:k]:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i, _ in items}


def test_near_duplicates_of_odd_documents(spark, odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    got = simhash_dedup.near_duplicates(odd_docs.withColumn("BITS", F.lit(1)).withColumn("component", F.lit(1))).collect()
    assert sorted((r.doc_id, r.fingerprint) for r in got) == sorted((r.doc_id, f"{simhash(r.text):016x}") for r in rows)
    want = classes([(r.doc_id, simhash(r.text)) for r in rows])
    assert all(r.component_id == want[r.doc_id] for r in got)
    assert simhash_dedup.near_duplicates(no_docs).count() == 0
    kept = simhash_dedup.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_dropping_near_duplicates_keeps_a_column_named_kept(odd_docs):
    clash = odd_docs.withColumn("KEPT", F.col("doc_id") * 2).withColumn("count", F.lit("x"))
    got = simhash_dedup.drop_near_duplicates(clash)
    assert got.columns == clash.columns
    want = sorted(r.doc_id for r in simhash_dedup.drop_near_duplicates(odd_docs).collect())
    assert sorted((r.doc_id, r.KEPT, r["count"]) for r in got.collect()) == [(i, 2 * i, "x") for i in want]


@pytest.mark.parametrize("bucket_rows", [4096, 16])
def test_links_find_every_class(spark, bucket_rows):
    """Random fingerprints, clusters and chains; small buckets force the chunked path."""
    rng = random.Random(8)
    bits = {rng.getrandbits(64) for _ in range(300)}
    for centre in list(bits)[:4]:
        bits |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))) for _ in range(150)}
    chain = rng.getrandbits(64)
    for step in range(20):  # each link flips three other bits
        bits.add(chain)
        chain ^= 0b111 << (3 * step)
    items = [(signed(b), b) for b in sorted(bits)]
    rows = spark.createDataFrame([(i,) for i, _ in items], "bits long")
    links = simhash_dedup.near_links(rows, bucket_rows=bucket_rows)
    found = {r.id: r.component for r in simhash_dedup.components(links).collect()}
    want = classes(items)
    assert {i: found.get(i, i) for i, _ in items} == want
    assert links.count() < 15 * len(items)


def signed(bits):
    return bits - (1 << 64) if bits >> 63 else bits


def test_components_of_a_hub(spark):
    """A star whose centre is neither end of the order, a second star on one of its leaves, a chain."""
    edges = [(500, i) for i in range(1000) if i != 500] + [(700, 2000 + i) for i in range(500)] + [(9000 + i, 9001 + i) for i in range(40)]
    got = {r.id: r.component for r in simhash_dedup.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys([*range(1000), *range(2000, 2500)], 0), **dict.fromkeys(range(9000, 9041), 9000)}


REPEATED = [
    (1, "alpha one two three four five"), (2, "beta six seven eight nine ten"), (2, "gamma a b c d e f g"), (3, "gamma a b c d e f g"),
    (None, "delta x y z w v u"), (None, "delta x y z w v u"), (None, "epsilon k l m n o p"), (9, "epsilon k l m n o p"), (7, None), (5, ""),
    (4, "zeta q w e r t y"), (4, "zeta q w e r t y"), (4, "zeta q w e r t y"),
]


@pytest.mark.parametrize("bits", [simhash_dedup.MAX_FILTER_BITS, 4])
def test_one_row_of_each_component_whatever_the_ids(spark, bits):
    """Repeated ids with unlike texts, null ids, repeated rows; a filter of 16 bits sends every row to the exact join."""
    docs = spark.createDataFrame([(i, t, None, "s", k) for k, (i, t) in enumerate(REPEATED)], DOCS).repartition(3)
    got = simhash_dedup.drop_near_duplicates(docs, max_filter_bits=bits).collect()
    # Nodes are fingerprints: name each by a number, link them, and take one row a class.
    prints = sorted({simhash(t) for _, t in REPEATED})
    label = classes(list(enumerate(prints)))
    want = {}
    for i, t in REPEATED:
        of = label[prints.index(simhash(t))]
        want[of] = min(want.get(of, (True, 0)), (i is None, i or 0))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted(want.values())
    assert sorted(label[prints.index(simhash(r.text))] for r in got) == sorted(want)
    again = simhash_dedup.drop_near_duplicates(docs.repartition(5), max_filter_bits=bits).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    component = {(r.doc_id, r.fingerprint): r.component_id for r in simhash_dedup.near_duplicates(docs).collect()}
    for i, t in REPEATED:
        nameless, first = want[label[prints.index(simhash(t))]]
        assert component[i, f"{simhash(t):016x}"] == (None if nameless else first)


def test_random_rows_against_brute_force(spark):
    rng = random.Random(12)
    bases = [" ".join(rng.choice("abcdefghij") * 3 + str(rng.randrange(50)) for _ in range(60)) for _ in range(40)]
    rows = [(rng.randrange(60) if rng.random() < 0.9 else None, rng.choice(bases) + rng.choice(["", "", " tail", " other"])) for _ in range(400)]
    docs = spark.createDataFrame([(i, t, None, "s", 0) for i, t in rows], DOCS).repartition(4)
    got = simhash_dedup.drop_near_duplicates(docs).collect()
    prints = sorted({simhash(t) for _, t in rows})
    label = classes(list(enumerate(prints)))
    want = {}
    for i, t in rows:
        of = label[prints.index(simhash(t))]
        want[of] = min(want.get(of, (True, 0)), (i is None, i or 0))
    assert sorted((label[prints.index(simhash(r.text))], r.doc_id) for r in got) == sorted((k, None if n else i) for k, (n, i) in want.items())


def test_texts_are_not_shuffled_to_drop_copies(spark):
    """No exchange of the plan carries a text but on the way of the doubtful rows, which the bitmaps thin out."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    plan = simhash_dedup.drop_near_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") >= 2 and "SortMergeJoin" in plan
    kept = plan.split("Union")[1].split("MapInArrow")[0]
    assert "Exchange" not in kept


def test_every_near_pair_shares_a_bucket():
    masks = [m % (1 << 64) for m in simhash_dedup.block_masks(6, 4)]
    rng = random.Random(2)
    for _ in range(2000):
        a = rng.getrandbits(64)
        b = a ^ sum(1 << k for k in rng.sample(range(64), 4))
        assert any((a ^ b) & m == 0 for m in masks)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    names, ids = docs.columns, [r.doc_id for r in docs.select("doc_id").collect()]
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["quality_stage", "language_stage", "dedup_stage", "mix_stage", "packing_stage"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert out.columns == names
        docs = spark.createDataFrame(out.collect(), docs.schema)
        assert {r.doc_id for r in docs.collect()} <= set(ids)
    packed = corpus_pipeline.run(spark, SF001)
    rows = packed.collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
    assert len([r for r in rows if r.piece == 0]) == docs.count()
    assert sum(r.length for r in rows) / (2048 * len({r.sequence_id for r in rows})) > 0.95


def test_pipeline_keeps_clean_documents_and_drops_copies(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    kept = corpus_pipeline.quality_stage(spark, docs, SF001)
    good = labels.where("quality = 1").join(docs, "doc_id").count()
    assert kept.join(labels.where("quality = 1"), "doc_id").count() >= 0.97 * good
    assert kept.join(labels.where("quality = 0"), "doc_id").count() <= 0.1 * labels.where("quality = 0").count()
    assert corpus_pipeline.language_stage(spark, kept, SF001).count() == kept.count()


def test_stages_on_an_empty_table(spark, no_docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF001).count() == 0
