"""Load flows over a table store: the order in which the jobs run.

Every step is one ledger entry. A step's writes either replace a whole table version or
one load's partition, and a step computes its rows from the tables without the rows of its
own load, so it can be run again whether it failed or its input has grown. A flow whose
input is empty ends there: what was staged before is not loaded again.

Tables whose rows change after they were written are kept as touches: a load appends what it
says about its keys, and the rows are put together when they are read. ``fold_touches`` keeps
the number of lots small; it runs while no load does.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F

from shelfmark.operators import (
    keys, languages, loads, normalize, overlay, queues, repair, sameuser, similarity, standing, star,
)
from shelfmark.operators.merge import add_ids
from shelfmark.plans import tables as layouts
from shelfmark.sources import delimited, feeds
from shelfmark.sources.ledger import EMPTY, Ledger
from shelfmark.sources.tables import Store, drop_intermediate, is_empty, materialize
from shelfmark.sources.touches import TouchLog


# Loads of a table kept as touches after which they are folded into one.
LOADS_TO_FOLD = 32


class Warehouse:
    """The store, its ledger and the steps that change it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.store = Store(spark, root)
        self.ledger = Ledger(spark, f"{root.rstrip('/')}/load_audit")

    def table(self, name: str) -> DataFrame:
        """A table, empty before its first load; reviews as their patches have them."""
        if name in layouts.TOUCHED:
            return self.log(name).read()
        if name == "review" and self.store.exists("review_patch"):
            return overlay.laid_over(self.stored(name), self.table("review_patch"), layouts.PATCHED)
        return self.stored(name)

    def stored(self, name: str) -> DataFrame:
        """A table's rows as they are stored."""
        if self.store.exists(name):
            return self.spark.read.schema(layouts.SCHEMAS[name]).parquet(self.store.path(name))
        return self.spark.createDataFrame([], layouts.SCHEMAS[name])

    def log(self, name: str) -> TouchLog:
        """The touches of a table that is kept as such."""
        return TouchLog(self.spark, f"{self.store.root}/{name}", layouts.layout(name), layouts.TOUCHED[name])

    def fold_touches(self, least: int = LOADS_TO_FOLD) -> dict[str, int]:
        """Fold the touches of each table with at least ``least`` lots; how many lots each had."""
        folded = {}
        for name in layouts.TOUCHED:
            log = self.log(name)
            if len(log.loads()) >= least:
                folded[name] = log.fold()
                drop_intermediate(self.spark)
        return folded

    def _replace(self, name: str, df: DataFrame) -> int:
        return self.store.replace(name, df).count()

    def before(self, name: str, batch: int) -> DataFrame:
        """A stored table without what an earlier attempt of this load added."""
        return self.table(name).filter(~F.col("load_audit_id").eqNullSafe(F.lit(batch)))

    def _append(self, name: str, rows: DataFrame, batch: int) -> int:
        """Write a load's rows in place of those of its earlier attempts; none takes them back."""
        observed = Observation()
        self.store.append_batch(name, rows.observe(observed, F.count(F.lit(1)).alias("rows")))
        written = observed.get["rows"]
        if not written:
            self.store.drop_batch(name, batch)
        return written

    def _run(self, job: str, step: str, work: Callable[[int], int | None], now: datetime) -> str:
        """A ledger step; its intermediate tables go when it has written its result."""
        try:
            return self.ledger.run(job, step, work, now)
        finally:
            drop_intermediate(self.spark)

    # -- reference feed ------------------------------------------------------------

    def load_isbn_feed(self, path: str, task: str, now: datetime) -> None:
        """Feed file to works, isbns and their pairs."""
        job, at = "isbn feed", now.isoformat(sep=" ")
        staged = feeds.read_isbn_feed(self.spark, path)

        def stage(batch: int):
            return None if is_empty(staged) else self._replace("stage_isbn", staged)

        if self._run(job, f"stage {task}", stage, now) == EMPTY:
            return
        feed = self.table("stage_isbn")
        self._run(job, f"work {task}", lambda b: self.log("work").append(b, loads.work_touches(feed, at, b)), now)
        self._run(job, f"isbn {task}", lambda b: self.log("isbn").append(b, loads.isbn_touches(feed, at, b)), now)
        # A full feed also marks the pairs it no longer has, so the whole table is its next state.
        self._run(job, f"work_isbn {task}", lambda b: self._replace(
            "work_isbn", loads.sync_work_isbn(self.before("work_isbn", b), feed, at, b)), now)

    # -- work details ----------------------------------------------------------------

    def load_work_info(self, path: str | Sequence[str], task: str, now: datetime) -> None:
        """Work-info dump to works, details, authors, titles and classification."""
        from shelfmark.schemas import STAGED_WORK_INFO

        job, at = "work details", now.isoformat(sep=" ")
        staged = delimited.typed(delimited.read_headered_dump(self.spark, path, STAGED_WORK_INFO))

        def stage_rows(batch: int):
            return None if is_empty(staged) else self._replace("stage_work_info", staged)

        if self._run(job, f"stage {task}", stage_rows, now) == EMPTY:
            return
        stage = self.table("stage_work_info")
        self._run(
            job, f"work {task}", lambda b: self.log("work").append(b, loads.missing_work_touches(stage, at, b)), now)
        inserts = {
            "work_info": loads.insert_work_info,
            "author": loads.insert_author, "author_info": loads.insert_author_info,
            "work_author": loads.insert_work_author, "work_sameas": loads.insert_work_sameas,
            "mds": loads.insert_mds,
        }
        for name, insert in inserts.items():
            self._run(
                job, f"{name} {task}",
                lambda b, n=name, i=insert: self._append(n, i(self.before(n, b), stage, at, b), b), now,
            )
        self._run(
            job, f"work_title {task}",
            lambda b: self._append("work_title", loads.insert_work_title(
                self.before("work_title", b), stage, self.table("language"), at, b), b), now,
        )

    def load_languages(self, path: str, task: str, now: datetime) -> None:
        """The language reference, read only while the stored table is empty."""
        def load(batch: int) -> int | None:
            stored = self.table("language")
            if not stored.isEmpty():
                return None
            columns = stored.columns
            return self._replace("language", delimited.load_language_ref(self.spark, path, None).select(*columns))

        self._run("language reference", f"language {task}", load, now)

    def export_isbns_without_lang(self, folder: str, n: int) -> None:
        """Write the next isbns whose language is to be asked for."""
        asked = queues.isbns_without_lang(self.table("work_isbn"), self.table("work_info"), self.table("isbn_info"), n)
        delimited.export_delimited(asked, folder)

    def load_isbn_lang(self, path: str | Sequence[str], task: str, now: datetime) -> None:
        """Language replies per isbn: valid ones are merged, the others kept beside them."""
        from shelfmark.schemas import STAGED_ISBN_LANG

        job, at = "isbn languages", now.isoformat(sep=" ")
        replies = delimited.read_headered_dump(self.spark, path, STAGED_ISBN_LANG).withColumnRenamed("lang_code", "reply")
        accepted, rejected = normalize.validate_isbn_lang(replies)
        self._run(
            job, f"isbn_info {task}",
            lambda b: None if is_empty(replies) else self.log("isbn_info").append(
                b, loads.isbn_lang_touches(accepted, at, b)), now,
        )
        self._run(
            job, f"isbn_lang_rejected {task}",
            lambda b: self._append("isbn_lang_rejected", rejected.withColumn("load_audit_id", F.lit(b)), b), now,
        )

    # -- reviews -----------------------------------------------------------------------

    def load_reviews(self, path: str | Sequence[str], site: str, task: str, now: datetime) -> None:
        """One site's review dump to users, reviews, tags and site mapping."""
        from shelfmark.schemas import STAGED_REVIEW

        job, at = "review dump", now.isoformat(sep=" ")
        staged = delimited.typed(delimited.read_headered_dump(self.spark, path, STAGED_REVIEW))

        def stage_rows(batch: int):
            if is_empty(loads.of_site(staged, site)):
                return None
            self.store.replace_partition("stage_review", loads.of_site(staged, site), "site_logical_name")
            return self.table("stage_review").filter(F.col("site_logical_name") == site).count()

        if self._run(job, f"stage {task}", stage_rows, now) == EMPTY:
            return
        stage, sites = self.table("stage_review"), self.table("site")

        def run(name: str, fn) -> None:
            self._run(job, f"{name} {task}", fn, now)

        run("user", lambda b: self.log("user").append(b, loads.user_touches(stage, sites, at, b, site)))
        works = loads.of_site(stage, site).select("work_refid")
        if site == "librarything":
            run("work", lambda b: self.log("work").append(b, loads.missing_work_touches(stage, at, b, site)))

        def reviews(batch: int) -> int:
            last = self.before("review", batch).agg(F.max("id")).first()[0]
            rows = loads.append_review(stage, sites, at, batch, site)
            written = self._append("review", add_ids(rows, last or 0), batch)
            self._keep_states(batch)
            return written

        run("review", reviews)
        run("tag", lambda b: self._append(
            "tag", loads.insert_tag(self.before("tag", b), stage, sites, at, b, site), b))
        run("work_tag", lambda b: self.log("work_tag").append(b, loads.work_tag_touches(stage, sites, at, b, site)))
        if site == "librarything":
            run("work_sameas", lambda b: self._append(
                "work_sameas", loads.insert_work_sameas(self.before("work_sameas", b), stage, at, b, site), b))
            same = self.table("work_sameas")
            run("last_harvest", lambda b: self.log("work").append(b, loads.harvest_touches(same, works, at, b)))
        else:
            run("work_site_mapping", lambda b: self.log("work_site_mapping").append(
                b, loads.site_mapping_touches(stage, sites, at, b, site)))

    def _keep_states(self, batch: int) -> None:
        """The report states of a load, out of its stored reviews."""
        own = self.table("review").filter(F.col("load_audit_id") == batch)
        self._append("review_state", standing.load_state(own), batch)
        self._append("review_readers", standing.load_readers(own), batch)

    def take_back_reviews(self, batch: int) -> None:
        """Take a load's reviews out, with what reports keep of them."""
        for name in ("review_state", "review_readers", "review"):
            self.store.drop_batch(name, batch)

    def fill_languages(self, task: str, now: datetime) -> None:
        """Find the language of reviews that have a text and none, from those that have both.

        What is found is laid over the reviews as patches. Two-letter answers become MARC codes.
        """
        def fill(batch: int) -> int | None:
            reviews = overlay.laid_over(self.stored("review"), self.before("review_patch", batch), layouts.PATCHED)
            if reviews.filter("review_lang is null and review is not null").isEmpty():
                return None
            marc = {r.code2: r.code for r in self.table("language").filter("code2 is not null and code is not null").collect()}
            found = languages.found_languages(reviews, languages.train_profiles(reviews), marc).filter("detected_lang is not null")
            return self._append("review_patch", overlay.value_patch(found, "review_lang", F.col("detected_lang"), batch), batch)

        self._run("language fill", f"review {task}", fill, now)

    def repair_reviews(self, task: str, now: datetime) -> None:
        """Known problems as patches: languages of texts in capitals, works loaded twice, uids of two works."""
        reviews, mapping = self.table("review"), self.table("work_site_mapping")
        repairs = {
            "capitals": lambda b: overlay.value_patch(repair.lang_resets(reviews), "review_lang", F.lit(None), b),
            "double loads": lambda b: overlay.deletion_patch(
                repair.double_loaded_master(reviews, self.table("work_sameas")), b),
            "shared uids": lambda b: overlay.deletion_patch(repair.shared_uid_duplicates(reviews, mapping), b),
        }
        for name, patches in repairs.items():
            self._run("repair", f"{name} {task}", lambda b, p=patches: self._append("review_patch", p(b), b), now)

    def undo_patches(self, batch: int) -> None:
        """Take the patches of one load out again."""
        self.store.drop_batch("review_patch", batch)

    def work_in_patches(self) -> int:
        """Rewrite the loads that hold patched reviews, then drop the patches; returns the loads rewritten.

        If it ends between the two, the patches are laid over rows that have them already.
        """
        patched = self.stored("review").join(self.table("review_patch").select("id").distinct(), "id", "left_semi")
        lots = [r[0] for r in patched.select("load_audit_id").distinct().collect()]  # a number per load
        if lots:
            rows = materialize(self.table("review").filter(F.col("load_audit_id").isin(lots)), "patched")
            self.store.append_batch("review", rows)
            alive = {r[0] for r in rows.select("load_audit_id").distinct().collect()}
            for batch in lots:
                if batch in alive:
                    self._keep_states(batch)
                else:
                    self.take_back_reviews(batch)  # all its reviews are deleted
        for r in self.table("review_patch").select("load_audit_id").distinct().collect():
            self.undo_patches(r[0])
        drop_intermediate(self.spark)
        return len(lots)

    # -- near-duplicates ------------------------------------------------------------------

    def process_similarity(self, task: str, now: datetime, n_work: int | None = None) -> None:
        """Queue the next works, index their reviews, find the similar ones, mark them processed."""
        job, at = "near-duplicates", now.isoformat(sep=" ")
        reviews = self.table("review")

        def enqueue(batch: int) -> int:
            queue = self.table("rev_similarto_process").filter(F.col("load_audit_id") != batch)
            new = similarity.enqueue_similarity(
                self.table("work"), self.table("work_site_mapping"), queue, reviews, n_work)
            if new.isEmpty():
                raise similarity.NothingPending("no more works to compare")
            rows = new.withColumn("date_processed", F.lit(None).cast("timestamp_ntz")).withColumn(
                "load_audit_id", F.lit(batch))
            self._replace("rev_similarto_process", queue.unionByName(rows, allowMissingColumns=True))
            return new.count()

        def lot(name: str, rows: DataFrame, batch: int) -> int:
            return self._append(name, similarity.by_work(rows.withColumn("load_audit_id", F.lit(batch))), batch)

        def index_reviews(batch: int) -> int:
            new = similarity.index_members(
                self.table("rev_similarto_process"), reviews, self.before("similar_member", batch))
            return lot("similar_member", new, batch)

        def index_texts(batch: int) -> int:
            pending = self.table("rev_similarto_process").filter("date_processed is null").select(F.col("review_id").alias("id"))
            added = self.table("similar_member").join(pending, "id", "left_semi")
            return lot("similar_class", similarity.index_classes(added, reviews, self.before("similar_class", batch)), batch)

        def pick(batch: int) -> int:
            found = similarity.pick_indexed(
                self.table("rev_similarto_process"), self.table("similar_member"), self.table("similar_class"))
            return self._append("review_similarto", found.withColumn("load_audit_id", F.lit(batch)), batch)

        self._run(job, f"queue {task}", enqueue, now)
        self._run(job, f"index reviews {task}", index_reviews, now)
        self._run(job, f"index texts {task}", index_texts, now)
        self._run(job, f"pick {task}", pick, now)
        self._run(job, f"mark {task}", lambda b: self._replace(
            "rev_similarto_process", similarity.mark_processed(self.table("rev_similarto_process"), at)), now)

    def derive_same_users(self, task: str, now: datetime) -> None:
        """Link the users of different sites whose reviews are alike, from all similar pairs found so far."""
        self._run("same users", f"user_sameas {task}", lambda b: self._replace(
            "user_sameas", sameuser.same_users(self.table("review_similarto"), self.table("review"))), now)

    # -- star schema ------------------------------------------------------------------------

    def register_keys(self, registry: str, wanted: DataFrame, key: str, name: str, task: str, now: datetime) -> DataFrame:
        """Give ids to the keys of ``wanted`` that have none, as a ledger step; returns the registry."""
        def add(batch: int) -> int:
            new = keys.new_keys(self.before(registry, batch), wanted, key, name)
            return self._append(registry, new.withColumn("load_audit_id", F.lit(batch)), batch)

        self._run("star schema", f"{registry} {task}", add, now)
        return self.table(registry)

    def build_star(self, task: str, now: datetime) -> None:
        """All dimensions, bridges and the fact, laid out by book.

        Surrogate ids come from the key registries, so a later build keeps those of an
        earlier one.
        """
        put = self.store.replace
        site = self.table("site")
        put("dim_site", star.dim_site(site, self.table("site_identifier")))
        put("dim_language", star.dim_language(self.table("language")))
        put("dim_date", star.dim_date(self.spark, self.table("review").select(F.col("review_date").alias("date_id"))))
        put("dim_mds", star.dim_mds(self.table("mds")))
        book = put("dim_book", star.dim_book(
            self.table("work_info"), self.table("work_title"), self.table("work_sameas")))
        forms = star.tag_forms(self.table("tag"))
        tag_keys = self.register_keys("tag_key", forms, "tag_name", "tag_id", task, now)
        tag = put("dim_tag", keys.with_ids(forms, tag_keys, "tag_name", "tag_id"))
        put("rel_tag", star.rel_tag(self.table("work_tag"), self.table("tag"), tag, book))
        authors = star.named_authors(self.table("author"), self.table("author_info"))
        author_keys = self.register_keys("author_key", authors, "code", "author_id", task, now)
        author = put("dim_author", keys.with_ids(authors, author_keys, "code", "author_id"))
        put("rel_author", star.rel_author(self.table("work_author"), self.table("author"), author, book))
        people = star.dim_reviewer(self.table("user"), site)
        if self.store.exists("city"):
            # The running total is over the cities: a fixed, small reference table.
            city = self.table("city").withColumn("pop_cum", F.sum("pop").over(Window.orderBy("city")))
            people = star.assign_city(people, city, city.agg(F.max("pop_cum")).first()[0])
        reviewer_keys = self.register_keys("reviewer_key", people, "reviewer_uuid", "reviewer_id", task, now)
        reviewer = put("dim_reviewer", keys.with_ids(people, reviewer_keys, "reviewer_uuid", "reviewer_id"))
        fact = star.fact_review(self.table("review"), book, reviewer, self.table("review_similarto"))
        put("fact_review", fact.repartitionByRange("book_id", "id").sortWithinPartitions("book_id"))

    def export_star(self, folder: str) -> list[str]:
        """Write every table of the star schema as delimited text; returns their names."""
        tables = ("dim_site", "dim_language", "dim_date", "dim_mds", "dim_book", "dim_tag", "rel_tag", "dim_author",
                  "rel_author", "dim_reviewer", "fact_review")
        for name in tables:
            replacements = delimited.EXPORT_REPLACEMENTS.get("review" if name == "fact_review" else name)
            delimited.export_delimited(self.store.read(name), f"{folder.rstrip('/')}/{name}", replacements)
        return list(tables)

    def import_table(self, name: str, path: str, schema: str, task: str, now: datetime, max_errors: int = 100) -> None:
        """Read an exported table back; lines that are no rows go to ``rejected``.

        With more of them than are tolerated the table stays as it is, and the step fails.
        """
        def load(batch: int) -> int:
            rows, rejects, bad = delimited.read_with_rejects(self.spark, path, schema)
            self._append("rejected", rejects.withColumn("load_audit_id", F.lit(batch)), batch)
            if bad > max_errors:
                raise delimited.TooManyBadRows(f"{bad} rows, {max_errors} tolerated")
            return self._replace(name, rows)

        self._run("import", f"{name} {task}", load, now)
