"""Approximate keys against every pair of keys."""

import random
import re

import pytest

from cadastro.operators.fuzzy import similar_keys
from cadastro.operators.matching import tiered_match


def words(key):
    return set(re.sub("[^a-z0-9]+", " ", key.lower().replace("á", "a").replace("Á", "a").replace("ç", "c")).split())


def brute(asked, known, least):
    out = set()
    for kind, q in asked:
        for other, k in known:
            if q is None or k is None or kind != other or not words(q) or not words(k):
                continue
            a, b = words(q), words(k)
            score = 200 * len(a & b) // (len(a) + len(b))
            if score >= least:
                out.add((kind, q, k, score))
    return out


@pytest.mark.parametrize("least", [1, 50, 80, 100])
def test_similar_keys_equal_brute_force(spark, least):
    rng = random.Random(least)
    def key():
        return ", ".join(rng.choice(["Rua", "rua", "RUÁ", "av", "praça", *map(str, range(12)), "centro"]) for _ in range(rng.randint(0, 6)))

    asked = [(rng.choice("xy"), key()) for _ in range(150)] + [("x", None), ("x", "...")]
    known = [(rng.choice("xy"), key()) for _ in range(150)] + [("x", None), ("x", "")]
    frames = [spark.createDataFrame(rows, "kind string, key string") for rows in (asked, known)]
    rows = [tuple(r) for r in similar_keys(*frames, least).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute(asked, known, least)


def test_plan_has_no_cross_join_and_rare_words_carry_it(spark):
    asked = spark.createDataFrame([("a", f"rua {i} cidade grande sp") for i in range(200)], "kind string, key string")
    pairs = similar_keys(asked, asked.selectExpr("kind", "upper(key) AS key"), 100)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan
    assert pairs.count() == 200
    with pytest.raises(ValueError):
        similar_keys(asked, asked, 0)


def test_best_candidate_by_computed_score(spark):
    addresses = spark.createDataFrame([(1, "R. das Flores 10", "01000", "Centro", "Recife", "PE"), (2, "Rua X", "9", "Longe", "Natal", "RN"),
                                       (3, None, "7", None, None, None)], "i int, rua string, cep string, bairro string, municipio string, uf string")
    gaz = spark.createDataFrame([
        ("address", "RUA DAS FLORES, 10, CENTRO, RECIFE, PE", "Recife, PE", 1.0, 2.0, 0, "PointAddress"),
        ("address", "Rua das Dores, 11, Centro, Recife, PE", "Recife, PE", 3.0, 4.0, 100, "PointAddress"),
        ("zip", "9 Natal RN", "anything", 5.0, 6.0, 0, "Locality")],
        "grain string, key string, matched_address string, lat double, lng double, score int, quality string")
    fields = dict(street="rua", zip_code="cep", district="bairro", city="municipio", state="uf")
    got = {r.i: (r.match_tier, r.lat) for r in tiered_match(addresses, gaz, **fields, min_score=80).collect()}
    assert got == {1: ("address", 1.0), 2: ("zip", 5.0), 3: (None, None)}
    assert {r.match_tier for r in tiered_match(addresses, gaz, **fields).collect()} == {None}
