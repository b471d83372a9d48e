"""Tiered address matching against a gazetteer table (replaces a per-row web geocoding call).

The gazetteer holds candidate results per lookup key at three grains: a full street address, a
district, a postal code. Like a geocoder, only the *best* candidate per key is considered (highest
score; ties broken deterministically), and it is then accepted or not:

1. ``address``  - accepted when the result mentions the city and (score = 100, or score >= 80 with a
   point/street-level quality);
2. ``district`` - accepted when the result mentions the city and score >= 80;
3. ``zip``      - accepted whenever there is a result.

Keys are compared as they are, with the gazetteer's own scores; or, with ``min_score``, by the words they
share (:mod:`cadastro.operators.fuzzy`), with the score computed from those.

The first accepted tier wins. Everything is joins: the best-candidate table is unique per key, each tier
is one checked lookup join (broadcast when the gazetteer is small enough, salted shuffle otherwise), so an
address table with one hot city does not multiply rows or pile up on one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root
from .fuzzy import similar_keys
from .lookups import lookup, profile_dimensions

TIERS = ("address", "district", "zip")
# Result qualities precise enough for the address tier at scores below 100.
STREET_QUALITIES = ("PointAddress", "StreetAddress")


def address_keys(street: Column, zip_code: Column, district: Column, city: Column, state: Column) -> dict[str, Column]:
    """Lookup keys per tier, spelled as the query text a geocoder would receive."""
    return {
        "address": F.concat_ws(", ", street, district, city, state),
        "district": F.concat_ws(", ", district, city, state),
        "zip": F.concat_ws(", ", zip_code, city, state),
    }


def best_candidates(gazetteer: DataFrame) -> DataFrame:
    """One row per ``(grain, key)``: the candidate with the highest score (ties: lat, lng, text).

    ``max`` over a struct is a partial aggregate, so a key with many candidates is reduced map-side.
    """
    best = F.max(F.struct("score", "lat", "lng", "matched_address", "quality")).alias("b")
    return gazetteer.groupBy("grain", "key").agg(best).select(
        "grain", "key", "b.matched_address", "b.lat", "b.lng", "b.score", "b.quality"
    )


def similar_candidates(keys: DataFrame, gazetteer: DataFrame, min_score: int = 80) -> DataFrame:
    """One row per ``(grain, key)`` of ``keys``: the gazetteer row whose key is most like it, with the computed
    ``score`` (at least ``min_score``) in place of its own. Ties as in :func:`best_candidates`."""
    best = F.max(F.struct("lat", "lng", "matched_address", "quality")).alias("b")
    rows = gazetteer.groupBy("grain", "key").agg(best).checkpoint()  # one row a key: its rows score alike
    pairs = similar_keys(keys.withColumnRenamed("grain", "kind"), rows.select(F.col("grain").alias("kind"), "key"), min_score)
    named = pairs.withColumn("found", F.concat_ws(":", "kind", "key")).drop("key")
    found = lookup(named, rows.select(F.concat_ws(":", "grain", "key").alias("found"), "b"), "found", "inner", name="gazetteer")
    top = F.max(F.struct("score", "b.lat", "b.lng", "b.matched_address", "b.quality")).alias("t")
    return found.groupBy("kind", "query").agg(top).select(
        F.col("kind").alias("grain"), F.col("query").alias("key"), "t.matched_address", "t.lat", "t.lng", "t.score", "t.quality")


def _accepted(tier: str, city: Column) -> Column:
    hit = F.col(f"{tier}_matched_address").contains(city)
    score = F.col(f"{tier}_score")
    if tier == "address":
        return hit & ((score == 100) | ((score >= 80) & F.col(f"{tier}_quality").isin(*STREET_QUALITIES)))
    if tier == "district":
        return hit & (score >= 80)
    return F.col(f"{tier}_matched_address").isNotNull()


def tiered_match(addresses: DataFrame, gazetteer: DataFrame, *, street: str, zip_code: str, district: str,
                 city: str, state: str, strategy: str = "auto", materialize: bool = True,
                 min_score: int | None = None) -> DataFrame:
    """Add ``match_tier``, ``lat``, ``lng`` to ``addresses`` (null when no tier accepts).

    ``gazetteer`` columns: ``grain`` (address/district/zip), ``key``, ``matched_address``, ``lat``,
    ``lng``, ``score``, ``quality``.

    With ``materialize`` (default) the best-candidate table is computed once and checkpointed to the
    shared ``spark.checkpoint.dir``, so the size profile and the three joins read it instead of
    re-aggregating the gazetteer four times; the checkpoint also cuts lineage for executor-loss retries.

    ``min_score`` (1 to 100) matches keys that are not spelled alike: candidates are the gazetteer keys that
    share enough words, scored by how many, and the gazetteer's own scores are not read.
    """
    keys = address_keys(F.col(street), F.col(zip_code), F.col(district), F.col(city), F.col(state))
    if materialize or min_score:
        checkpoint_root(addresses.sparkSession)  # make sure the session names a checkpoint folder
    if min_score:
        asked = addresses.select(F.explode(F.array(*[F.struct(F.lit(t).alias("grain"), k.alias("key")) for t, k in keys.items()])).alias("k"))
        best = similar_candidates(asked.select("k.*"), gazetteer, min_score)
    else:
        best = best_candidates(gazetteer)
    if materialize:
        best = best.checkpoint(eager=True)
    tiers = {
        t: best.filter(F.col("grain") == t).select(
            F.col("key").alias(f"{t}_key"),
            *[F.col(c).alias(f"{t}_{c}") for c in ("matched_address", "lat", "lng", "score", "quality")],
        )
        for t in TIERS
    }
    profiles = profile_dimensions({t: (d, f"{t}_key") for t, d in tiers.items()}) if strategy in ("auto", "broadcast") else {}
    out = addresses.withColumns({f"{t}_key": k for t, k in keys.items()})
    for t in TIERS:
        out = lookup(out, tiers[t], f"{t}_key", "left", strategy=strategy, profile=profiles.get(t), name=t)
    city_col = F.col(city)
    tier = F.when(_accepted("address", city_col), F.lit("address")) \
        .when(_accepted("district", city_col), F.lit("district")) \
        .when(_accepted("zip", city_col), F.lit("zip"))

    def pick(field: str) -> Column:
        return F.when(F.col("match_tier") == "address", F.col(f"address_{field}")) \
            .when(F.col("match_tier") == "district", F.col(f"district_{field}")) \
            .when(F.col("match_tier") == "zip", F.col(f"zip_{field}"))

    out = out.withColumn("match_tier", tier)
    out = out.withColumns({"lat": pick("lat"), "lng": pick("lng")})
    extra = [f"{t}_{c}" for t in TIERS for c in ("key", "matched_address", "lat", "lng", "score", "quality")]
    return out.drop(*extra)
