import datetime

import pytest

from shelfmark.sources.ledger import Ledger
from shelfmark.sources.tables import Store
from shelfmark.streaming import ingest
from shelfmark.streaming.reviews import KEY, ReviewIntake

NOW = datetime.datetime(2016, 5, 1, 10)
HEADER = "site_logical_name|user_uid|work_refid|parsed_review_date|review"


@pytest.fixture()
def place(spark, tmp_path):
    store, ledger = Store(spark, str(tmp_path / "wh")), Ledger(spark, str(tmp_path / "audit"))
    intake = ReviewIntake(store, "review", ledger, "intake", NOW)
    folder = tmp_path / "in"
    folder.mkdir()

    def send(name, *lines):
        (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")
        ingest.ingest_dumps(spark, str(folder), KEY, str(tmp_path / "ck"), intake.sink())

    def stored():
        layout = spark.read.schema("review string, period_class int, load_audit_id int")
        main, late = (layout.parquet(store.path(t)).collect() if store.exists(t) else [] for t in ("review", "review_late"))
        return sorted(r.review for r in main), sorted((r.review, r.period_class) for r in late)

    return intake, send, stored


def test_reviews_come_once_and_late_ones_go_beside(place):
    _, send, stored = place
    first = ["goodreads|u1|1|2016-04-01|a", "goodreads|u1|1|2016-04-01|a", "goodreads|u2|1|2016-04-20|b", "goodreads||1|2016-04-20|b"]
    send("1.dat", *first)
    assert stored() == (["a", "b", "b"], [])
    # Out of order: within the delay, before it, after the harvest, without a date.
    second = ["babelio|u1|1|2016-03-25|c", "babelio|u1|1|2016-03-01|old", "babelio|u1|2|2016-06-01|future", "babelio|u1|3||undated",
              "babelio|u1|4|no date|odd"]
    send("2.dat", *second)
    expected = (["a", "b", "b", "c"], [("future", 1), ("odd", None), ("old", -1), ("undated", None)])
    assert stored() == expected
    # Sent again, alone and together, and after the watermark has passed them.
    send("3.dat", *first, *second)
    assert stored() == expected
    send("4.dat", "goodreads|u9|9|2016-04-30|z")
    send("5.dat", *second, *first, "goodreads|u8|9|2016-03-30|late now")
    assert stored() == (["a", "b", "b", "c", "z"], sorted([*expected[1], ("late now", -1)], key=lambda r: r[0]))


def test_a_repeated_batch_replaces_itself(spark, place):
    intake, _, stored = place
    rows = lambda *r: spark.createDataFrame([(*x,) for x in r], ", ".join(f"{k} string" for k in KEY))
    one, two = ("s", "u", "1", "2016-04-01", "a"), ("s", "u", "1", "2016-01-01", "b")
    assert intake.load(rows(one), 1) == 1
    # The first attempt broke off after it had written; the second has more to say.
    assert intake.load(rows(one, two), 1) == 2
    assert stored() == (["a", "b"], [])
    assert intake.load(rows(one, two, ("s", "u", "2", "2016-02-01", "c")), 2) == 0
    assert stored() == (["a", "b"], [("c", -1)])
    assert intake.load(rows(one, two), 2) == 0
    assert stored() == (["a", "b"], [])


@pytest.mark.parametrize("small", [0, 100])
def test_batches_of_any_size_and_spelled_digests_are_known(spark, place, monkeypatch, small):
    """Small batches go to the stored digests, beside large ones these move; hex digests of old loads count."""
    from pyspark.sql import functions as F

    from shelfmark.streaming import reviews

    monkeypatch.setattr(reviews, "SMALL_BATCH", small)
    intake, _, stored = place
    rows = lambda *r: spark.createDataFrame([(*x,) for x in r], ", ".join(f"{k} string" for k in KEY))
    one, two, old = (("s", "u", str(i), "2016-04-01", t) for i, t in enumerate("abo"))
    assert intake.load(rows(one, one), 1) == 1
    spelled = rows(old).withColumn("digest", F.lower(F.hex(reviews.review_digest()))).withColumn(
        "review_date", F.col("parsed_review_date").cast("date")).withColumn("load_audit_id", F.lit(2))
    spelled.write.mode("append").partitionBy("load_audit_id").parquet(intake.store.path("review"))
    assert intake.load(rows(old, one, two), 3) == 1
    assert stored()[0] == ["a", "b", "o"]


def test_a_batch_is_written_twice_at_most(spark, place, monkeypatch):
    """Once where its reviews are classed and once into the tables; digests take 32 bytes."""
    from shelfmark.streaming import reviews

    intake, _, _ = place
    written, write, append = [], reviews.materialize, intake.store.append_batch
    monkeypatch.setattr(reviews, "materialize", lambda df, name: (written.append(name), write(df, name))[1])
    monkeypatch.setattr(intake.store, "append_batch", lambda name, df: (written.append(name), append(name, df))[1])
    rows = spark.createDataFrame([("s", "u", "1", "2016-04-01", "a")], ", ".join(f"{k} string" for k in KEY))
    assert intake.load(rows, 1) == 1
    assert written == ["intake", "review_late", "review"]
    assert len(spark.read.parquet(intake.store.path("review")).first()["digest"]) == 32


def test_nothing_arrives(spark, place):
    _, send, stored = place
    send("1.dat")
    assert stored() == ([], [])
