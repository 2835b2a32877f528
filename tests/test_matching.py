"""Topic identity between runs: the auction's matching against brute force, and the stated rules."""

import itertools
import random

from loomwire.operators.matching import auction, match_topics, topic_weights


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "doc long, topic int")


def best_total(weights):
    new = sorted({n for n, _, _ in weights})
    old = sorted({o for _, o, _ in weights})
    w = {(n, o): x for n, o, x in weights}
    best = 0
    for k in range(min(len(new), len(old)) + 1):
        for chosen in itertools.permutations(old, k):
            for bidders in itertools.combinations(new, k):
                best = max(best, sum(w.get(p, 0) for p in zip(bidders, chosen)))
    return best


def test_shuffled_numbers_are_restored(spark):
    rng = random.Random(1)
    old = [(d, d % 7 if d % 11 else -1) for d in range(300)]
    shuffle = list(range(7))
    rng.shuffle(shuffle)
    new = [(d, shuffle[t] if t >= 0 else -1) for d, t in old]
    got = {r["doc"]: r["topic"] for r in match_topics(frame(spark, old), frame(spark, new), "doc").collect()}
    assert got == dict(old)


def test_split_merge_and_new(spark):
    old = [(d, 0) for d in range(0, 100)] + [(d, 1) for d in range(100, 130)] + [(d, 2) for d in range(130, 160)]
    # topic 0 splits into 60/40, topics 1 and 2 merge, documents 200.. form a new topic
    new = ([(d, 5) for d in range(0, 60)] + [(d, 6) for d in range(60, 100)] + [(d, 7) for d in range(100, 160)]
           + [(d, 8) for d in range(200, 220)])
    got = {r["doc"]: r["topic"] for r in match_topics(frame(spark, old), frame(spark, new), "doc").collect()}
    assert {got[d] for d in range(0, 60)} == {0}
    assert {got[d] for d in range(100, 160)} == {1}  # ties between 1 and 2: the smaller new bidder wins, then id
    fresh = {got[60], got[200]}
    assert fresh == {3, 4} and got[60] == 3  # larger unmatched topic first


def test_auction_total_is_the_optimum(spark):
    rng = random.Random(7)
    for _ in range(4):
        weights = [(n, o, rng.randint(1, 9)) for n in range(5) for o in range(4) if rng.random() < 0.6]
        if not weights:
            continue
        df = spark.createDataFrame(weights, "new long, old long, w long")
        pairs = [(r["new"], r["old"]) for r in auction(df).collect()]
        assert len({n for n, _ in pairs}) == len(pairs) == len({o for _, o in pairs})
        w = {(n, o): x for n, o, x in weights}
        assert sum(w[p] for p in pairs) == best_total(weights)


def test_empty_and_outliers(spark):
    empty = frame(spark, [])
    assert match_topics(empty, empty, "doc").collect() == []
    only = frame(spark, [(1, -1), (2, None)])
    got = sorted((r["doc"], r["topic"]) for r in match_topics(only, only, "doc").collect())
    assert got == [(1, -1), (2, None)]
    assert topic_weights(only, only, "doc").collect() == []
