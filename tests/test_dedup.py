import random

import numpy as np
import pytest

from glosswright.operators import dedup


def greedy(signatures, threshold):
    """Plain walk in string order of ids."""
    kept, out = [], {}
    for i in sorted(signatures, key=str):
        twin = next((k for k in kept if np.mean(np.array(signatures[k]) == np.array(signatures[i])) >= threshold), None)
        out[i] = None if twin is None else str(twin)
        if twin is None:
            kept.append(i)
    return out


def resolve(spark, signatures, k, threshold):
    df = spark.createDataFrame(list(signatures.items()), "doc_id bigint, signature array<int>")
    return {r.doc_id: r.duplicate_of for r in dedup.near_duplicates(df, "doc_id", k, threshold).collect()}


def test_chain_star_clique_and_copies(spark):
    base = list(range(10))
    a, b, c = base, [90, *base[1:]], [90, 91, *base[2:]]  # a~b, b~c, a!~c at 0.9
    cases = {1: a, 2: b, 3: c, 9: [50] * 10, 10: [50] * 10, 11: [50] * 9 + [1], 20: [70 + i for i in range(10)]}
    got = resolve(spark, cases, 10, 0.9)
    assert got == greedy(cases, 0.9)
    assert got[1] is None and got[2] == "1" and got[3] is None
    assert got[10] is None and got[9] == "10"  # ids compare as strings


def test_random_signatures_equal_the_walk(spark):
    rng = random.Random(3)
    seeds = [[rng.randint(0, 9) for _ in range(16)] for _ in range(8)]
    signatures = {}
    for i in range(150):
        s = list(rng.choice(seeds))
        for _ in range(rng.randint(0, 4)):
            s[rng.randrange(16)] = rng.randint(0, 9)
        signatures[i] = s
    assert resolve(spark, signatures, 16, 0.85) == greedy(signatures, 0.85)


def test_a_chain_is_decided_in_few_rounds(spark, monkeypatch):
    n, s, chain = 120, list(range(10)), {}
    for i in range(n):
        s = list(s)
        s[i % 10] = 1000 + i  # near its neighbours only
        chain[1000 + i] = s
    rounds = []
    along = dedup._along_chains
    monkeypatch.setattr(dedup, "_along_chains", lambda *a: rounds.append(1) or along(*a))
    assert resolve(spark, chain, 10, 0.9) == greedy(chain, 0.9)
    assert len(rounds) <= 2


def test_signatures(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "C b, a!"), (3, None), (4, ""), (5, "x " * 9000)], "doc_id bigint, text string")
    s = {r.doc_id: r.signature for r in dedup.signatures(docs, "doc_id", "text", 32).collect()}
    assert s[1] == s[2] and s[3] == s[4] == [dedup.PRIME] * 32 and len(s[5]) == 32
    assert dedup.signatures(docs.limit(0), "doc_id", "text", 8).count() == 0


def test_matches_needed():
    assert dedup.matches_needed(128, 0.85) == 109 and dedup.matches_needed(100, 0.55) in (55, 56)
    for k, t in ((100, 0.55), (128, 0.85), (7, 0.3)):
        m = dedup.matches_needed(k, t)
        assert m / k >= t and (m - 1) / k < t


def test_low_threshold_is_refused(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, [1, 3])], "doc_id bigint, signature array<int>")
    with pytest.raises(ValueError):
        dedup.near_duplicates(df, "doc_id", 2, 0.0)
