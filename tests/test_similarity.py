import random

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import similarity as sim

WORDS = "the a of book story reader page great long short plot house river time night dark light end".split()


def grams(text):
    words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    return {f"  {w} "[i:i + 3] for w in words for i in range(len(w) + 1)}


def brute_force(reviews, processed=frozenset(), t=0.6, delta=0.08, shortest=100):
    out = {}
    sets = {r[0]: grams(r[3]) for r in reviews}
    for rid, work, site, text, lang in reviews:
        if rid in processed:
            continue
        best = None
        for oid, owork, osite, otext, olang in reviews:
            if oid >= rid or owork != work or lang is None or lang != olang:
                continue
            if len(text) < shortest or len(otext) < shortest:
                continue
            width = int(len(otext) * delta + 0.5)
            if not len(otext) - width <= len(text) <= len(otext) + width:
                continue
            a, b = sets[rid], sets[oid]
            s = len(a & b) / len(a | b)
            if s >= t and (best is None or oid < best[0]):
                best = (oid, osite, round(s, 9))
        if best:
            out[rid] = (site, best[1], best[0], best[2])
    return out


def make_reviews(seed, n, copies):
    """Fresh texts, exact copies and copies with a few words changed, in two works."""
    rnd = random.Random(seed)
    made, out = [], []
    for i in range(n):
        kind = rnd.random()
        if made and kind < copies:
            text = rnd.choice(made)
            if rnd.random() < 0.7:
                words = text.split()
                for _ in range(rnd.randint(1, 5)):
                    words[rnd.randrange(len(words))] = rnd.choice(WORDS) + rnd.choice("xyz ").strip()
                text = " ".join(words)
        else:
            text = " ".join(rnd.choice(WORDS) + rnd.choice(["", "s", "ed", "q" + str(rnd.randint(0, 99))])
                            for _ in range(rnd.randint(12, 45)))
        made.append(text)
        lang = rnd.choice(["en", "en", "en", "fr", None])
        out.append((i * 3 + 1, 1 if rnd.random() < 0.8 else 2, rnd.randint(1, 4), text, lang))
    return out


def run(spark, reviews, processed=frozenset(), **rules):
    df = spark.createDataFrame(reviews, "id bigint, work_refid bigint, site_id int, review string, review_lang string")
    queue = df.select(
        "work_refid",
        F.col("id").alias("review_id"),
        F.length("review").alias("text_length"),
        "review_lang",
        F.when(F.col("id").isin(*processed, -5), F.lit("2016-01-01").cast("timestamp")).alias("date_processed"),
    )
    found = sim.pick_similar(queue, df, sim.SimilarityRules(**rules)).collect()
    assert len({r.review_id for r in found}) == len(found)
    return {r.review_id: (r.site_id, r.other_site_id, r.other_review_id, round(r.similarity, 9)) for r in found}


@pytest.mark.parametrize("seed, copies", [(1, 0.3), (2, 0.85)])
def test_equals_brute_force(spark, seed, copies):
    reviews = make_reviews(seed, 160, copies)
    assert run(spark, reviews) == brute_force(reviews)


def test_processed_reviews_only_serve_as_partners(spark):
    reviews = make_reviews(5, 120, 0.6)
    processed = {r[0] for r in reviews if r[0] < 200}
    assert run(spark, reviews, processed) == brute_force(reviews, processed)


@pytest.mark.parametrize("t, delta, radius", [(0.8, 0.2, 0.05), (0.5, 0.5, 0.2), (0.3, 0.4, 0.1), (0.9, 0.02, 0.4)])
def test_other_thresholds(spark, t, delta, radius):
    reviews = make_reviews(9, 120, 0.6)
    got = run(spark, reviews, min_similarity=t, min_length=60, length_delta=delta, radius=radius)
    assert got == brute_force(reviews, t=t, delta=delta, shortest=60)


def test_rules_without_a_bound_are_refused():
    with pytest.raises(ValueError):
        sim.SimilarityRules(min_similarity=0.2, radius=0.1)
    with pytest.raises(ValueError):
        sim.SimilarityRules(length_delta=1.0)


def test_short_review_beside_a_far_longer_one(spark):
    """A wide length band reaches over several length buckets."""
    base = " ".join(WORDS)
    reviews = [(1, 1, 2, base + " " + base[:-1], "en"), (2, 1, 4, base, "en"), (3, 1, 2, base + " " + base, "en")]
    got = run(spark, reviews, length_delta=0.6, min_length=20)
    assert got == brute_force(reviews, delta=0.6, shortest=20)


def test_one_group_of_thousands(spark):
    """Thousands of different texts of one work: pairs of near copies among them are found."""
    rng = random.Random(3)
    reviews = []
    for i in range(3000):
        words = [f"{rng.choice(WORDS)}{rng.randrange(10**6)}" for _ in range(14)]
        reviews.append((i + 1, 1, 2, " ".join(words), "en"))
    for i in range(0, 300, 3):
        reviews.append((5000 + i, 1, 4, reviews[i][3] + " end", "en"))
    got = run(spark, reviews)
    assert {5000 + i: i + 1 for i in range(0, 300, 3)}.items() <= {k: v[2] for k, v in got.items()}.items()


def test_many_copies_of_one_text(spark):
    """A third of all reviews are one text: each copy is tied to the first."""
    text = " ".join(WORDS * 4)
    reviews = make_reviews(11, 80, 0.2)
    top = max(r[0] for r in reviews)
    reviews += [(top + 1 + i, 1, 2, text, "en") for i in range(60)]
    assert run(spark, reviews) == brute_force(reviews)


def test_dense_group_ships_blocks_not_pairs(spark, monkeypatch):
    """Different texts of one work and length that all share most trigrams: nothing is written per pair of them."""
    rng = random.Random(8)
    words = [a + b for a in WORDS for b in ("", "s", "ed")]
    reviews = [(i + 1, 1, 2, " ".join(rng.sample(words, 34))[:180], "en") for i in range(600)]
    made, write = {}, sim.materialize

    def noted(df, name):
        out = write(df, name)
        made[name] = out.count()
        return out

    monkeypatch.setattr(sim, "materialize", noted)
    assert run(spark, reviews) == brute_force(reviews)
    assert made and max(made.values()) <= 4 * len(reviews)


@pytest.mark.parametrize("seed, copies, small", [(12, 0.3, 0), (13, 0.9, 0), (14, 0.9, 256)])
def test_many_small_blocks_equal_brute_force(spark, monkeypatch, seed, copies, small):
    """Groups over several cells and blocks, bundles of two, leaders with followers, every product in slices."""
    for name, value in {"SMALL_GROUP": small, "BLOCK": 7, "BUNDLE": 2, "MINHASHES": 1}.items():
        monkeypatch.setattr(sim, name, value)
    reviews = make_reviews(seed, 160, copies)
    assert run(spark, reviews, length_delta=0.2, radius=0.25) == brute_force(reviews, delta=0.2)


@pytest.mark.parametrize("rare, part", [(0, 3), (1, 50), (200, 4096), (10**9, 20)])
def test_shared_trigrams_of_two_blocks(rare, part, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(sim, "RARE", rare)
    monkeypatch.setattr(sim, "SLICE", part)
    monkeypatch.setattr(sim, "PAIRS", part)
    rng = random.Random(rare)
    lots = [[sorted(rng.sample(range(60), rng.randrange(1, 30))) for _ in range(n)] for n in (9, 14)]
    blocks = []
    for sets in lots:
        n = len(sets)
        rows = pa.table({"cid": [*range(n)], "grams": sets, "pending": [True] * n,
                         **{c: [1.0] * n for c in ("len", "low", "high", "n", "radius")}})
        key = (pa.scalar(1), pa.scalar("en"), pa.scalar(0, pa.int32()), pa.scalar(True), pa.scalar(0, pa.int32()))
        blocks.append(sim._Block(sim._pack(key, rows), 0))
    assert sim._shared(*blocks).tolist() == [[len(set(x) & set(y)) for y in lots[1]] for x in lots[0]]


def test_sets_are_written_in_blocks_only(spark, monkeypatch):
    """No step but the one that packs blocks writes trigram sets, and none writes them as long lists."""
    made, write = {}, sim.materialize

    def noted(df, name):
        made[name] = df.schema
        return write(df, name)

    monkeypatch.setattr(sim, "materialize", noted)
    reviews = make_reviews(31, 60, 0.5)
    assert run(spark, reviews) == brute_force(reviews)
    held = {name: [f.dataType.simpleString() for f in s.fields if f.name in ("grams", "hashes")] for name, s in made.items()}
    assert {name for name, types in held.items() if types} == {"blocks"} and held["blocks"] == ["binary"]


def joined_texts(frame):
    """Whether a join of the frame's plan gives texts on."""
    def joins(node):
        children = node.children()
        below = [x for i in range(children.size()) for x in joins(children.apply(i))]
        return below + ([node.output().mkString(",")] if node.nodeName() == "Join" else [])

    found = joins(frame._jdf.queryExecution().optimizedPlan())
    assert found
    return any("review#" in columns for columns in found)


@pytest.mark.parametrize("case", ["even", "uneven", "few", "out of reach"])
def test_texts_stay_where_they_are_read(spark, monkeypatch, case):
    """Sets are built in the scan if most texts need one and the splits are even; texts of classes move otherwise."""
    made, write = {}, sim.materialize

    def noted(df, name):
        made[name] = joined_texts(df) if name == "blocks" else None
        return write(df, name)

    monkeypatch.setattr(sim, "materialize", noted)
    reviews = make_reviews(41, 120, 0.4)
    rows = reviews + [(100000 + i, 9, 1, "short", "en") for i in range(500 if case == "few" else 0)]
    df = spark.createDataFrame(rows, "id bigint, work_refid bigint, site_id int, review string, review_lang string")
    df = df.coalesce(1) if case == "uneven" else df
    processed = set()
    if case == "out of reach":
        monkeypatch.setattr(sim, "BLOCK", 2)
        monkeypatch.setattr(sim, "BUNDLE", 2)
        longest = max((r for r in reviews if r[4]), key=lambda r: len(r[3]))[0]
        processed = {r[0] for r in reviews} - {longest}
    queue = df.select(
        "work_refid", F.col("id").alias("review_id"), F.length("review").alias("text_length"), "review_lang",
        F.when(F.col("id").isin(*processed, -5), F.lit("2016-01-01").cast("timestamp")).alias("date_processed"))
    found = sim.pick_similar(queue, df).collect()
    got = {r.review_id: (r.site_id, r.other_site_id, r.other_review_id, round(r.similarity, 9)) for r in found}
    assert got == brute_force(reviews, processed) and len(found) == len(got)
    assert made["blocks"] == (case != "even")


def test_sets_built_where_read_of_odd_rows(spark, rows, monkeypatch):
    """Repeated rows and ids, one id with two texts, null texts, ids and languages: both ways give the same."""
    reviews = make_reviews(43, 60, 0.6)
    odd = reviews + reviews[:20] + [(r[0], r[1], r[2], reviews[i + 1][3], r[4]) for i, r in enumerate(reviews[20:30])]
    odd += [(r[0] + 1, r[1], r[2], None, "en") for r in reviews[:5]] + [(None, 1, 1, r[3], "en") for r in reviews[:3]]
    odd += [(5000 + i, 1, 1, "-" * 150, "en") for i in range(3)]
    df = spark.createDataFrame(odd, "id bigint, work_refid bigint, site_id int, review string, review_lang string")
    queue = df.select("work_refid", F.col("id").alias("review_id"), F.length("review").alias("text_length"),
                      "review_lang", F.lit(None).cast("timestamp").alias("date_processed"))
    found = []
    for here in (True, False):
        monkeypatch.setattr(sim, "_built_where_read", lambda *_, here=here: here)
        found.append(rows(sim.pick_similar(queue, df)))
    assert found[0] == found[1] and found[0]


def test_built_where_read_without_rows(spark):
    nothing = spark.createDataFrame([], "cid bigint, review string")
    assert not sim._built_where_read(nothing.select("cid"), nothing)


def test_packed_sets_are_restored():
    import pyarrow as pa

    sets = [[3, 9, 2**62], [], None, [0], [], [5, 6]]
    batch = pa.record_batch({"x": [*range(6)], "grams": pa.array(sets, pa.list_(pa.int64()))})
    packed, = sim._pack_sets([batch])
    assert packed["grams"].is_valid().to_pylist() == [s is not None for s in sets]
    known = packed["grams"].drop_null()
    assert sim._unpack_sets(pa.chunked_array([known])).to_pylist() == [s for s in sets if s is not None]
    assert packed["x"].to_pylist() == [*range(6)]


def test_classes_in_reach_of_a_pending_one_meet_in_a_tile(spark, monkeypatch):
    """Every pair within the band that has a pending class meets once; tiles out of reach go nowhere."""
    monkeypatch.setattr(sim, "BLOCK", 5)
    monkeypatch.setattr(sim, "BUNDLE", 2)
    rng, rules = random.Random(2), sim.SimilarityRules()
    rows = [(w, "en", int(100 * 1.02 ** rng.randrange(200)), f"k{i}", i, w == 1 and i % 50 == 0)
            for i, w in enumerate(rng.choices([1, 2], k=400))]
    classes = spark.createDataFrame(rows, "work_refid bigint, lang string, len int, text_key string, cid bigint, pending boolean")
    placed = sim._placed(classes, rules).collect()
    assert {r.work_refid for r in placed} == {1} and len(placed) < sum(r[0] == 1 for r in rows)
    goes = {r.cid: {(m.a, m.b) for m in r.goes} for r in placed}
    tile = {r.cid: r.tile for r in placed}
    for w, _, length, _, i, asks in rows:
        for w2, _, length2, _, j, _ in rows:
            if asks and w == w2 and abs(length - length2) <= round(min(length, length2) * 0.08):
                pair = (min(tile[i], tile[j]), max(tile[i], tile[j]))
                assert pair in goes[i] and pair in goes[j]


def test_enqueue_and_mark(spark, rows):
    work = spark.createDataFrame(
        [(1, "2016-01-01"), (2, "2016-01-01"), (3, None), (4, "2016-01-01"), (5, "2016-01-01")],
        "refid bigint, last_harvest_dts string",
    )
    mapping = spark.createDataFrame(
        [(w, s) for w in (1, 2, 3, 5) for s in (2, 4)] + [(4, 2)], "work_refid bigint, site_id int"
    )
    queue = spark.createDataFrame([(5, 50, 1, "en", None)],
        "work_refid bigint, review_id bigint, text_length int, review_lang string, date_processed timestamp")
    reviews = spark.createDataFrame([(10, 1, "abc", "en"), (11, 1, None, None)],
        "id bigint, work_refid bigint, review string, review_lang string")
    new = sim.enqueue_similarity(work, mapping, queue, reviews)
    assert rows(new) == [(1, 10, 3, "en"), (1, 11, 0, None), (2, -1, 0, None)]
    assert rows(sim.enqueue_similarity(work, mapping, queue, reviews, n=1), "work_refid") == [(1,), (1,)]
    assert sim.mark_processed(queue, "2016-05-26 12:00:00").filter("date_processed is null").isEmpty()


def test_no_cartesian_join(spark):
    reviews = spark.createDataFrame(
        make_reviews(1, 20, 0.5), "id bigint, work_refid bigint, site_id int, review string, review_lang string"
    )
    queue = reviews.select("work_refid", F.col("id").alias("review_id"), F.length("review").alias("text_length"),
                           "review_lang", F.lit(None).cast("timestamp").alias("date_processed"))
    plan = sim.pick_similar(queue, reviews)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_kept_index_in_batches_equals_brute_force(spark):
    """Three batches over one index: answers are those of one batch over all that came before."""
    from shelfmark.plans.tables import layout
    from shelfmark.sources.tables import materialize

    reviews = make_reviews(21, 150, 0.7)
    rnd = random.Random(4)
    lot = {r[0]: rnd.randrange(3) if r[1] == 1 else rnd.randrange(2) for r in reviews}
    schema = "id bigint, work_refid bigint, site_id int, review string, review_lang string"
    members = spark.createDataFrame([], layout("similar_member")).drop("load_audit_id")
    classes = spark.createDataFrame([], layout("similar_class")).drop("load_audit_id")
    built = set()
    for batch in range(3):
        here = [r for r in reviews if lot[r[0]] <= batch]
        fresh = [r for r in here if lot[r[0]] == batch]
        queue = spark.createDataFrame(here, schema).select(
            "work_refid", F.col("id").alias("review_id"), F.length("review").alias("text_length"), "review_lang",
            F.when(~F.col("id").isin([r[0] for r in fresh]), F.lit("2016-01-01").cast("timestamp")).alias("date_processed"))
        # Only texts of this batch can be read any more.
        texts = spark.createDataFrame(fresh, schema)
        added = materialize(sim.by_work(sim.index_members(queue, texts, members)), "m")
        new = materialize(sim.by_work(sim.index_classes(added, texts, classes)), "c")
        assert added.count() == sum(len(r[3]) >= 100 and r[4] is not None for r in fresh)
        keys = {(r.work_refid, r.lang, r["len"], r.text_key) for r in new.collect()}
        assert len(keys) == new.count() and not keys & built
        built |= keys
        # The index already has this batch: nothing is added twice.
        assert sim.index_members(queue, texts, members.unionByName(added)).isEmpty()
        members, classes = members.unionByName(added), classes.unionByName(new)
        unread = classes
        if batch == 2:
            # Works without a pending review are not looked at: their sets may be anything.
            assert {r[1] for r in fresh} == {1}
            unread = classes.withColumn("grams", F.when(F.col("work_refid") == 1, F.col("grams")))
        found = sim.pick_indexed(queue, members, unread).collect()
        got = {r.review_id: (r.site_id, r.other_site_id, r.other_review_id, round(r.similarity, 9)) for r in found}
        assert got == brute_force(here, {r[0] for r in here if lot[r[0]] < batch}) and len(found) == len(got)
    nothing = spark.createDataFrame([], queue.schema)
    assert sim.pick_indexed(nothing, members, classes).isEmpty()
    plan = sim._within(classes, queue.select("work_refid", F.col("review_lang").alias("lang")))._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(work_refid" in plan
