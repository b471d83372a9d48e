"""Source mix, chat formatting and exact search against brute force."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastro.llm import chat_format, queries, source_mix, topk_search
from tests.conftest import SF01
from tests.llm.conftest import TEXTS


def targets_by_rounds(sizes, weights=(5, 2, 1), most=3):
    """The contract's procedure, step by step."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        share = (total - sum(fixed.values())) / max(1e-9, sum(weight[s] for s in free))
        over = [s for s in free if share * weight[s] > most * sizes[s]]
        if not over:
            return {s: fixed.get(s, share * weight[s]) for s in order}
        fixed |= {s: most * sizes[s] for s in over}


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_are_shared_and_capped(spark):
    rng = np.random.default_rng(5)
    for _ in range(3):
        sizes = {s: int(n) for s, n in zip(["b", "a", "Z", "é", None, "aa", "0"], rng.integers(0, 400, 7) ** 2 // 50)}
        rows = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, size long, n long")
        got = {r.source: r.target for r in source_mix.source_targets(rows).collect()}
        for s, t in targets_by_rounds(sizes).items():
            assert got[s] == pytest.approx(t, rel=1e-9, abs=1e-6)


def test_mix_meets_its_targets(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    first = {r.doc_id: r for r in queries.op3_source_mix(spark, SF01).collect()}
    again = {r.doc_id: r.taken for r in queries.op3_source_mix(spark, SF01).select("doc_id", "taken").collect()}
    source = {r.doc_id: (r.source, words(r.text)) for r in docs.collect()}
    assert {d: r.taken for d, r in first.items()} == again and first.keys() == source.keys()
    sizes = {}
    for s, n in source.values():
        sizes[s] = sizes.get(s, 0) + n
    want = targets_by_rounds(sizes)
    for s in sizes:
        mine = [first[d] for d in source if source[d][0] == s]
        assert all(r.size == source[r.doc_id][1] and r.source_size == sizes[s] for r in mine)
        assert all(r.taken == r.copies * r.size <= 3 * r.size for r in mine)
        assert mine[0].target == pytest.approx(want[s])
        assert sum(r.taken for r in mine) == pytest.approx(want[s], rel=0.01)
        # Entropy balancing: the rates themselves meet the target, and are one tilt of the size.
        assert sum(r.rate * r.size for r in mine) == pytest.approx(want[s], rel=1e-5)
        ordered = sorted((r for r in mine if r.size), key=lambda r: r.size)
        odds = [np.log(2 * r.rate / (3 - r.rate)) / r.size for r in ordered if 0.001 < r.rate < 2.999]
        assert np.allclose(odds, odds[0], rtol=1e-4, atol=1e-9)


def test_nearest_change_equals_brute_force(spark):
    """Of all additions, withdrawals and swaps, the one that leaves the least of each source's gap."""
    rng = np.random.default_rng(11)
    menu, plan, want = [], [], {}
    for k, source in enumerate([None, "a", "b", "only out", "only in", "nothing"]):
        sides = {True: [], False: []}
        for out in (True, False):
            if source not in ("nothing", "only in" if out else "only out"):
                sides[out] = sorted(set(rng.integers(1, 3000, 25).tolist()))
        rows = [(source, out, size, 1000 * k + 2 * i + out) for out, sizes in sides.items() for i, size in enumerate(sizes)]
        used = [r[3] for r in rows[:2]]
        gap = float(rng.integers(-2000, 2000)) + 0.25
        menu += rows
        plan.append((source, gap, used, True))
        free = [r for r in rows if r[3] not in used]
        changes = [add - less for add in [0, *(r[2] for r in free if not r[1])] for less in [0, *(r[2] for r in free if r[1])]]
        want[source] = min(abs(gap - c) for c in changes)
    plan.append(("closed", 5.0, [], False))
    got = source_mix._nearest_change(
        spark.createDataFrame(menu, "_source string, out boolean, _size long, pick long").repartition(3),
        spark.createDataFrame(plan, "e string, _gap double, flips array<long>, _open boolean")).collect()
    size_of = {r[3]: -r[2] if r[1] else r[2] for r in menu}
    assert {r.m: r.miss for r in got} == want
    assert all(r.words == sum(size_of[p] for p in r.picks) for r in got)


def test_small_sources_meet_their_targets(spark):
    rng = np.random.default_rng(4)
    rows = [(1000 * s + d, "w " * int(n), f"s{s}") for s in range(6) for d, n in enumerate(rng.lognormal(5, 1.1, 30))]
    table = source_mix.mix_table(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4))
    for r in table.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect():
        assert r.taken == pytest.approx(r.target, rel=0.01)
    assert all(r.copies - np.floor(r.rate) in (0, 1) for r in table.collect())


def test_mix_returns_columns_named_as_those_of_the_plan(odd_docs):
    clash = odd_docs.withColumns({c: F.col("doc_id") for c in ("_tilt", "_FULL", "_scale", "_target", "_copy", "_fine", "_s", "e")})
    got, want = source_mix.mix(clash), source_mix.mix(odd_docs)
    assert got.columns == clash.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in want.collect())
    assert all(r._tilt == r._FULL == r._copy == r._s == r.doc_id for r in got.collect())


def test_mix_edge_cases(spark, odd_docs, no_docs):
    clash = odd_docs.withColumn("_SIZE", F.lit("x")).withColumn("copies", F.lit(9))
    table = source_mix.mix_table(clash).collect()
    assert len(table) == len(TEXTS)
    assert all(r.taken <= 3 * r.size and 0 <= r.copies <= 3 for r in table)
    assert {r["source"] for r in table} == {"s0", "s1", "s2", None}
    assert sorted(r["size"] for r in table) == sorted(words(t) for t in TEXTS)
    mixed = source_mix.mix(clash)
    assert mixed.columns == clash.columns and all(r._SIZE == "x" for r in mixed.select("_SIZE").collect())
    assert mixed.count() == sum(r.copies for r in table)
    assert source_mix.mix_table(no_docs).count() == 0 and source_mix.mix(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id long, text string, source string")
    assert {(r.taken, r.target) for r in source_mix.mix_table(blank).collect()} == {(0, 0.0)}


def test_mix_has_no_python_in_its_plans(spark):
    plan = queries.op3_source_mix(spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan


CHATS = [
    (1, 2, "assistant", "<|im_end|><|im_start|>assistant ok"), (1, 1, "user", "a <\\|im_sep|> b <|x|> <\\\\|"), (1, 3, "assistant", "again\n"),
    (1, 0, "system", None), (2, 0, None, "no role"), (2, 0, None, "no role"), (2, None, "user", ""), (3, 5, "ro\nle\\n", "x"),
    (3, 6, "<|im_end|>", "<|im_end|>\n"), (None, 0, "user", "lost"), (4, 1, "assistant", ""), (4, 1, "assistant", "b"), (4, 2, "user", "y" * 100_000),
]


def expected_turns(conv):
    rows = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in CHATS if c == conv))
    return [(r, x) for _, _, r, x in rows]


def test_chats_round_trip(spark):
    turns = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string").withColumn("TURNS", F.lit(1)).repartition(3)
    out = chat_format.format_chats(turns)
    rows = {r.conv_id: r for r in out.withColumn("read", chat_format.read_turns(F.col("formatted"))).collect()}
    digests = {r.conv_id: r for r in chat_format.digest(out).collect()}
    assert rows.keys() == {c for c, *_ in CHATS}
    for conv, r in rows.items():
        want = expected_turns(conv)
        assert [(t.role, t.text) for t in r.read] == want
        assert "".join(s.content for s in r.segments) == r.formatted
        merged = 1 + sum(a[0] != b[0] for a, b in zip(want, want[1:]))
        assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == merged
        loss = "".join(x for role, x in want if role == "assistant")
        d = digests[conv]
        assert (d.n_turns, d.loss_chars, d.formatted_chars) == (len(want), len(loss), len(r.formatted))
        assert d.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert d.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in want).encode()).hexdigest()


def test_odd_roles_read_back(spark):
    roles = ["a\x00n", "\\", "\\n", "\n", "\\\\n\n\\", "x\\\x00\ny", "<|im_end|>", "<\\|\n", "\x00", ""]
    rows = [(c, 0, r, "text") for c, r in enumerate(roles)]
    out = chat_format.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    read = {r.conv_id: [t.role for t in r.read] for r in out.withColumn("read", chat_format.read_turns(F.col("formatted"))).collect()}
    assert read == {c: [r] for c, r in enumerate(roles)}


def test_chats_of_an_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.digest(chat_format.format_chats(none)).count() == 0


def test_chat_plan_is_native(spark):
    plan = queries.op9_chat_format(spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange") == 1


def brute_force(rows, k, factor=256):
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole.setdefault(i, []).append(np.floor(np.array(v, float) * factor).astype(int))
    out = set()
    for q, vectors in whole.items():
        if q % 50 == 0:
            for v in vectors:
                scored = sorted((-int(sum(a * b for a, b in zip(v, w))), i) for i, ws in whole.items() if i != q for w in ws)
                out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


def vectors_table(spark, rows):
    return spark.createDataFrame(rows, T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                                                     T.StructField("Score", T.StringType())]))


@pytest.mark.parametrize("cells", [(topk_search.INDEX_CELLS, topk_search.QUERY_CELLS), (40 * 16, 3 * 16)])
def test_search_equals_brute_force(spark, cells):
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(size=16).round(2).tolist()) for i in rng.permutation(600)]
    rows += [(3000, [0.25]), (3050, [0.25, 0.0, 0.0]), (3051, [0.25] + [0.0] * 15)]  # equal, written unlike
    rows += [(1000 + i, [0.5] * 16) for i in range(150)] + [(2000, [0.0] * 16), (2050, None), (2100, [None] * 16), (2150, [float("nan")] * 16),
             (2200, [float("inf")] + [0.0] * 15), (2250, [0.25, -0.5]), (2251, []), (None, [1.0] * 16), (2300, [-1.0] * 16)]
    got = topk_search.search(vectors_table(spark, [(*r, "x") for r in rows]).repartition(4), F.col("vec_id") % 50 == 0,
                             index_cells=cells[0], query_cells=cells[1])
    assert {tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()} == brute_force(rows, 5)


def test_search_of_few_or_no_rows(spark):
    few = [(0, [1.0, 2.0], ""), (50, [0.5, 0.5], ""), (7, [1e9, -1e9], "")]
    got = topk_search.search(vectors_table(spark, few), F.col("vec_id") % 50 == 0)
    assert {tuple(r) for r in got.collect()} == brute_force([r[:2] for r in few], 5)
    assert topk_search.search(vectors_table(spark, []), F.col("vec_id") % 50 == 0).count() == 0
    assert topk_search.search(vectors_table(spark, few[:1]), F.col("vec_id") % 50 == 0).count() == 0


def test_index_stops_early_and_stays_exact():
    rng = np.random.default_rng(9)
    x = rng.integers(-100, 100, (2000, 32)).astype(float)
    q = rng.integers(-100, 100, (20, 32)).astype(float)
    x[5], x[6, ::2] = 0, 0
    index = topk_search.ImpactIndex(x)
    posted = np.zeros_like(x)
    posted[index.place, index.component] = index.value
    assert (posted == x).all() and len(index.value) == np.count_nonzero(x) and len(index.edges) > 4
    weakest = [np.abs(index.value[lo:hi]).min() for lo, hi in zip(index.edges, index.edges[1:]) if hi > lo]
    assert weakest == sorted(weakest, reverse=True) and (index.rest[-1] == 0).all()
    for i, at, scores in index.top(x, q, 6, np.arange(2000)):
        exact = x @ q[i]
        want = np.lexsort((np.arange(2000), -exact))[:6]
        assert at.tolist() == want.tolist() and scores.tolist() == exact[want].tolist()


def test_the_index_is_built_once_a_block_and_never_shuffled_for_a_query(spark):
    rows = [(i, [float((i * j) % 7) for j in range(8)], "") for i in range(300)]
    plan = topk_search.index_table(spark.createDataFrame([([i, i + 1], [i]) for i in range(100)], "w array<long>, ids array<long>"), 2, 5)
    assert plan.count() <= 5 and sum(r.n for r in plan.collect()) == 100
    got = topk_search.search(vectors_table(spark, rows), F.col("vec_id") % 50 == 0, index_cells=80, query_cells=16)
    assert {tuple(r) for r in got.collect()} == brute_force([r[:2] for r in rows], 5)
