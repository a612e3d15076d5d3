from collections import defaultdict

from pyspark.sql import functions as F

from shelfmark.operators import sameuser

REVIEWS = "id bigint, user_id string, site_id int"
PAIRS = "review_id bigint, other_review_id bigint"


def brute(reviews, pairs, least=2):
    who = {r: (u, s) for r, u, s in reviews}
    own = defaultdict(lambda: (set(), set()))
    for r, o in pairs:
        if r in who and o in who and who[r][1] != who[o][1]:
            for x, y in ((r, o), (o, r)):
                own[who[x], who[y]][0].add(x)
                own[who[x], who[y]][1].add(y)
    texts = {k: min(map(len, v)) for k, v in own.items() if min(map(len, v)) >= least}
    best = {}
    for (a, b), n in texts.items():
        key = a, b[1]
        best[key] = min(best.get(key, (0, "~")), (-n, b[0]))
    up = {}
    for (a, site), (_, b) in best.items():
        if site < a[1] and best.get(((b, site), a[1]), (0, None))[1] == a[0]:
            up[a[0]] = min(up.get(a[0], (99, "")), (site, b))
    top = lambda u: top(up[u][1]) if u in up else u
    out = {(u, top(u)) for u in up}
    return sorted(out | {(t, t) for _, t in out})


def made(spark, texts):
    """Reviews and pairs out of lists of (user, site) that share a text, paired with the first."""
    reviews, pairs, n = [], [], 0
    for people in texts:
        first = n + 1
        for user, site in people:
            n += 1
            reviews.append((n, user, site))
            if n > first:
                pairs.append((n, first))
    return reviews, pairs


def run(spark, reviews, pairs, **more):
    found = sameuser.same_users(spark.createDataFrame(pairs, PAIRS), spark.createDataFrame(reviews, REVIEWS), **more)
    return sorted(tuple(r) for r in found.collect())


def test_links_need_two_texts_and_both_sides(spark):
    a, b, c, d = ("a", 1), ("b", 2), ("c", 4), ("d", 2)
    reviews, pairs = made(spark, [(a, b), (a, b), (a, b), (a, d), (a, d), (b, c), (b, c), (d, c), (a, c)])
    # d's best is a, whose best on that site is b; c has one text with a, so it climbs over b.
    assert run(spark, reviews, pairs) == brute(reviews, pairs) == [("a", "a"), ("b", "a"), ("c", "a")]
    assert run(spark, reviews, pairs, least_texts=4) == []


def test_a_text_many_copied_links_nobody(spark):
    reviews, pairs = made(spark, [[("a", 1)] + [(f"u{i}", 2) for i in range(40)]] * 1 + [[("a", 1), ("u7", 2)]])
    assert run(spark, reviews, pairs) == [("a", "a"), ("u7", "a")]
    # One review that resembles several of one user is one text.
    assert run(spark, [(1, "a", 1), (2, "b", 2), (3, "b", 2)], [(2, 1), (3, 1)]) == []


def test_ties_and_many_sites(spark):
    import random

    rnd = random.Random(6)
    people = [(f"s{site}u{i}", site) for site in range(1, 7) for i in range(6)]
    texts = [rnd.sample(people, rnd.randrange(2, 5)) for _ in range(400)]
    reviews, pairs = made(spark, texts)
    found = run(spark, reviews, pairs)
    assert found == brute(reviews, pairs) and len(found) > 10
    assert len({u for u, _ in found}) == len(found)


def test_empty_and_unknown(spark):
    assert run(spark, [], []) == []
    assert run(spark, [(1, "a", 1), (2, None, 2)], [(2, 1), (9, 1)]) == []
    plan = sameuser.shared_texts(spark.createDataFrame([], PAIRS), spark.createDataFrame([], REVIEWS))
    assert plan.filter(F.col("texts") > 0).isEmpty()
