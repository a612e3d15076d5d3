"""The warehouse relations expressed over the given parquet tables.

Every relation exists twice: as a DataFrame for the jobs and as SQL text for the
cross-check. Parts stand for works, customers for users, suppliers for authors,
regions for sites, nations for languages, line items for ratings and documents for
review texts. Old and new states of a table are cut by date, as two feeds would be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Feeds: the stored state holds what shipped before the second date, the new feed what
# shipped from the first date on, so both share the span between.
FEED_START = "1998-01-01"
STORED_END = "1999-07-01"
NOW = "2020-01-01 00:00:00"

TITLES = (
    "red widget", "small ring", "blue anvil", "old gear",
    "hot plate", "new bolt", "large gizmo",
)
TITLES_SQL = ", ".join(f"'{t}'" for t in TITLES)

STANDIN_SQL: dict[str, str] = {
    "site": "select cast(r_regionkey + 1 as int) as id, r_name as logical_name from region",
    "site_identifier": """
        select cast(r_regionkey + 1 as int) as site_id,
               'www.' || lower(r_name) || '.example' as hostname from region""",
    "language": """
        select 'l' || lpad(cast(n_nationkey as varchar), 2, '0') as code,
               lpad(cast(n_nationkey as varchar), 2, '0') as code2,
               'x' || lpad(cast(n_nationkey as varchar), 2, '0') as code3,
               n_name as english_name, 'fr ' || n_name as french_name from nation""",
    "part_code": """
        select p_partkey, p_name, p_brand, p_type, p_size,
               cast(cast(round(p_retailprice * 10) as bigint) as varchar) as digits from part""",
    "work_info": """
        select p_partkey as work_refid, p_name as title,
               case p_type when 'SMALL' then null when 'LARGE' then '-- '
                    else 'L' || lpad(substr(p_brand, 7), 2, '0') end as ori_lang_code,
               digits as mds_code, cast(p_size as int) as popularity from part_code""",
    "mds": """
        select substr(digits, 1, cast(2 + p_size % 3 as int)) as code,
               max(p_type || '-->' || p_brand || '-->' || p_name) as mds_text
        from part_code group by 1""",
    "users": """
        select c_custkey as id, case when c_acctbal < 0 then null else c_name end as username,
               cast(n_regionkey + 1 as int) as site_id, c_mktsegment as segment,
               'l' || lpad(cast(n_nationkey as varchar), 2, '0') as lang
        from customer join nation on c_nationkey = n_nationkey""",
    "author": "select s_suppkey as author_id, lower(s_name) as code, s_name as name from supplier",
    "work_author": "select distinct l_partkey as work_refid, l_suppkey as author_id from lineitem",
    "review_r": """
        select l_partkey as work_refid, o_custkey as user_id, u.site_id, u.lang as review_lang,
               cast(ceil(l_quantity / 5) as int) as parsed_rating,
               cast(l_linenumber - 1 as int) as parsed_likes,
               cast(o_orderdate as date) as review_date,
               cast(year(o_orderdate) as int) as load_audit_id,
               l_orderkey as order_id, l_returnflag as flag
        from lineitem join orders on l_orderkey = o_orderkey
        join users u on o_custkey = u.id""",
    "review_t": """
        select doc_id as id, cast(substr(source, 4) as bigint) as work_refid,
               doc_id % 97 as user_id, cast(doc_id % 5 + 1 as int) as site_id,
               "text" as review, lang as review_lang, cast(n_chars as int) as text_length,
               date '2020-01-01' + cast(doc_id % 7 as int) as review_date
        from documents""",
    "work_site_mapping": """
        select l_partkey as work_refid, site_id,
               case when l_discount = 0 then '-1'
                    else 'u' || cast(l_suppkey as varchar) end as work_uid,
               max(cast(o_orderdate as date)) as last_harvest_dts,
               min(cast(year(o_orderdate) as int)) as load_audit_id
        from lineitem join orders on l_orderkey = o_orderkey
        join users u on o_custkey = u.id
        group by 1, 2, 3""",
    "work": """
        select p_partkey as refid, max(case when l_linestatus = 'F' and l_returnflag = 'R'
               then cast(l_shipdate as date) end) as last_harvest_dts
        from part left join lineitem on l_partkey = p_partkey group by 1""",
    "work_sameas": """
        select p_partkey as work_refid, master_refid from
          (select p_partkey, min(p_partkey) over (partition by p_name, p_brand, p_size) as master_refid
           from part) m
        where p_partkey <> master_refid""",
    "work_isbn": """
        select l_partkey as work_refid, l_orderkey as ean,
               max(cast(l_shipdate as date)) as last_seen_date,
               case when min(l_linestatus) = 'O' then date '2002-01-01' end as deletion_date
        from lineitem group by 1, 2""",
    "isbn_info": """
        select o_orderkey as ean, case when o_orderstatus = 'P' then null
               when o_orderstatus = 'F' then 'fre' else 'eng' end as lang_code from orders""",
    "user_geo": """
        select user_id, valid_from, region,
               lead(valid_from) over (partition by user_id order by valid_from) as valid_to
        from (select o_custkey as user_id, cast(o_orderdate as date) as valid_from,
                     max(o_orderpriority) as region
              from orders group by 1, 2) g""",
    "user_info": """
        select c_custkey as user_id, c_mktsegment as gender,
               date '1950-01-01' + cast(round(abs(c_acctbal)) as int) as birth_date from customer""",
    "dim_book": """
        select work_refid as book_id, title as english_title, title as title_ori
        from work_info where work_refid not in (select work_refid from work_sameas)
        and title is not null""",
    "stored_feed": f"select * from lineitem where l_shipdate < timestamp '{STORED_END}'",
    "new_feed": f"select * from lineitem where l_shipdate >= timestamp '{FEED_START}'",
    "staged_reviews": """
        select l_partkey as work_refid, s.logical_name as site_logical_name,
               case when l_tax = 0 then null else 'c' || cast(o_custkey as varchar) end as user_uid,
               c_name || ' ' || l_returnflag as username,
               cast(ceil(l_quantity / 5) as int) as rating_n,
               cast(l_linenumber - 1 as int) as likes_n,
               cast(o_orderdate as date) as parsed_review_date,
               'l' || lpad(cast(n_nationkey as varchar), 2, '0') as review_lang,
               case when l_discount = 0 then '-1' else 'u' || cast(l_suppkey as varchar) end as work_uid,
               case when l_discount = 0.1 then l_suppkey + 1000000 end as dup_refid,
               case when l_discount = 0.05 then null else
                    lower(p_type) || '__&__' || lower(p_brand) || '__&__' || p_name end as tags_t,
               case when l_discount = 0.05 then null else
                    cast(l_linenumber as varchar) || ';1,' || lpad(cast(p_size as varchar), 3, '0')
                    || ' ;' || cast(p_size as varchar) end as tags_n,
               'eng' as tags_lang, p_name as title, cast(l_suppkey as varchar) as authors,
               l_shipdate
        from lineitem join orders on l_orderkey = o_orderkey
        join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
        join site s on s.id = n_regionkey + 1 join part on l_partkey = p_partkey""",
    "staged_works": """
        select p_partkey as work_refid, p_name as title,
               case when p_type = 'PROMO' then p_partkey + 1000000 end as dup_refid,
               'English' as original_lang,
               case p_type when 'SMALL' then null else 'l' || lpad(substr(p_brand, 7), 2, '0') end
                    as ori_lang_code,
               p_name || ';' || p_brand as authors,
               replace(p_name, ' ', '') || ';' || lower(p_brand) || ';' || lower(p_type) as authors_code,
               substr(digits, 1, 3) || '.' || substr(digits, 4) as mds_code,
               case when p_size % 5 = 0 then substr(digits, 1, 3) end as mds_code_corr,
               case when p_type = 'ECONOMY' then null
                    else p_type || '-->' || p_brand || '-->' || p_name end as mds_text,
               p_type as lc_subjects,
               cast(p_size as varchar) || ',' || lpad(cast(p_size as varchar), 3, '0') as popularity,
               'NATION_' || cast(p_size % 25 as varchar) || ' : ' || p_name || ': ' || p_brand
                    || '__&__' || 'Klingon : x' || p_type || '__&__ : empty' as other_lang_title
        from part_code""",
}


def _lang_code(key: Column) -> Column:
    return F.concat(F.lit("l"), F.lpad(key.cast("string"), 2, "0"))


class Standins:
    """Lazy access to the relations of one scale directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- reference relations -------------------------------------------------

    def site(self) -> DataFrame:
        return self.raw("region").select(
            (F.col("r_regionkey") + 1).cast("int").alias("id"),
            F.col("r_name").alias("logical_name"),
        )

    def site_identifier(self) -> DataFrame:
        return self.raw("region").select(
            (F.col("r_regionkey") + 1).cast("int").alias("site_id"),
            F.concat(F.lit("www."), F.lower("r_name"), F.lit(".example")).alias("hostname"),
        )

    def language(self) -> DataFrame:
        key = F.col("n_nationkey")
        two = F.lpad(key.cast("string"), 2, "0")
        return self.raw("nation").select(
            _lang_code(key).alias("code"),
            two.alias("code2"),
            F.concat(F.lit("x"), two).alias("code3"),
            F.col("n_name").alias("english_name"),
            F.concat(F.lit("fr "), "n_name").alias("french_name"),
        )

    def _part_code(self) -> DataFrame:
        return self.raw("part").withColumn(
            "digits", F.round(F.col("p_retailprice") * 10).cast("long").cast("string")
        )

    def work_info(self) -> DataFrame:
        brand = F.lpad(F.substr("p_brand", F.lit(7)), 2, "0")
        return self._part_code().select(
            F.col("p_partkey").alias("work_refid"),
            F.col("p_name").alias("title"),
            F.when(F.col("p_type") == "SMALL", F.lit(None))
            .when(F.col("p_type") == "LARGE", F.lit("-- "))
            .otherwise(F.concat(F.lit("L"), brand))
            .alias("ori_lang_code"),
            F.col("digits").alias("mds_code"),
            F.col("p_size").cast("int").alias("popularity"),
        )

    def mds(self) -> DataFrame:
        return (
            self._part_code()
            .groupBy(
                F.substring(F.col("digits"), F.lit(1), (F.col("p_size") % 3 + 2).cast("int")).alias("code")
            )
            .agg(F.max(F.concat_ws("-->", "p_type", "p_brand", "p_name")).alias("mds_text"))
        )

    def users(self) -> DataFrame:
        nation = self.raw("nation")
        return (
            self.raw("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("id"),
                F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("username"),
                (F.col("n_regionkey") + 1).cast("int").alias("site_id"),
                F.col("c_mktsegment").alias("segment"),
                _lang_code(F.col("n_nationkey")).alias("lang"),
            )
        )

    def author(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("author_id"),
            F.lower("s_name").alias("code"),
            F.col("s_name").alias("name"),
        )

    def work_author(self) -> DataFrame:
        return (
            self.raw("lineitem")
            .select(F.col("l_partkey").alias("work_refid"), F.col("l_suppkey").alias("author_id"))
            .distinct()
        )

    # -- facts -----------------------------------------------------------------

    def review_r(self, with_user: bool = True) -> DataFrame:
        """Rating facts. The user join is left out where no user attribute is read."""
        orders = self.raw("orders").select(
            "o_orderkey",
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderdate").cast("date").alias("review_date"),
            F.year("o_orderdate").cast("int").alias("load_audit_id"),
        )
        if with_user:
            user = self.users().select(
                F.col("id").alias("user_id"), "site_id", F.col("lang").alias("review_lang")
            )
            orders = orders.join(user, "user_id")
        lines = self.raw("lineitem").select(
            F.col("l_orderkey").alias("o_orderkey"),
            F.col("l_partkey").alias("work_refid"),
            F.ceil(F.col("l_quantity") / 5).cast("int").alias("parsed_rating"),
            (F.col("l_linenumber") - 1).cast("int").alias("parsed_likes"),
            F.col("l_returnflag").alias("flag"),
            F.col("l_discount"),
            F.col("l_suppkey"),
        )
        return lines.join(orders, "o_orderkey").withColumnRenamed("o_orderkey", "order_id")

    def review_t(self) -> DataFrame:
        return self.raw("documents").select(
            F.col("doc_id").alias("id"),
            F.substr("source", F.lit(4)).cast("long").alias("work_refid"),
            (F.col("doc_id") % 97).alias("user_id"),
            (F.col("doc_id") % 5 + 1).cast("int").alias("site_id"),
            F.col("text").alias("review"),
            F.col("lang").alias("review_lang"),
            F.col("n_chars").cast("int").alias("text_length"),
            F.date_add(F.lit("2020-01-01").cast("date"), (F.col("doc_id") % 7).cast("int")).alias(
                "review_date"
            ),
        )

    def work_site_mapping(self) -> DataFrame:
        return (
            self.review_r()
            .groupBy(
                "work_refid",
                "site_id",
                F.when(F.col("l_discount") == 0, F.lit("-1"))
                .otherwise(F.concat(F.lit("u"), F.col("l_suppkey").cast("string")))
                .alias("work_uid"),
            )
            .agg(
                F.max("review_date").alias("last_harvest_dts"),
                F.min("load_audit_id").alias("load_audit_id"),
            )
        )

    def work(self) -> DataFrame:
        harvested = (
            self.raw("lineitem")
            .filter((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "R"))
            .groupBy(F.col("l_partkey").alias("refid"))
            .agg(F.max(F.col("l_shipdate").cast("date")).alias("last_harvest_dts"))
        )
        return (
            self.raw("part")
            .select(F.col("p_partkey").alias("refid"))
            .join(harvested, "refid", "left")
        )

    def work_sameas(self) -> DataFrame:
        part = self.raw("part").select("p_partkey", "p_name", "p_brand", "p_size")
        masters = part.groupBy("p_name", "p_brand", "p_size").agg(
            F.min("p_partkey").alias("master_refid")
        )
        return (
            part.join(masters, ["p_name", "p_brand", "p_size"])
            .filter(F.col("p_partkey") != F.col("master_refid"))
            .select(F.col("p_partkey").alias("work_refid"), "master_refid")
        )

    def work_isbn(self) -> DataFrame:
        return (
            self.raw("lineitem")
            .groupBy(F.col("l_partkey").alias("work_refid"), F.col("l_orderkey").alias("ean"))
            .agg(
                F.max(F.col("l_shipdate").cast("date")).alias("last_seen_date"),
                F.when(F.min("l_linestatus") == "O", F.lit("2002-01-01").cast("date")).alias(
                    "deletion_date"
                ),
            )
        )

    def isbn_info(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("ean"),
            F.when(F.col("o_orderstatus") == "P", F.lit(None))
            .when(F.col("o_orderstatus") == "F", F.lit("fre"))
            .otherwise(F.lit("eng"))
            .alias("lang_code"),
        )

    def user_geo(self) -> DataFrame:
        from shelfmark.operators.satellites import close_intervals

        versions = (
            self.raw("orders")
            .groupBy(
                F.col("o_custkey").alias("user_id"),
                F.col("o_orderdate").cast("date").alias("valid_from"),
            )
            .agg(F.max("o_orderpriority").alias("region"))
        )
        return close_intervals(versions, "user_id")

    def user_info(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_mktsegment").alias("gender"),
            F.date_add(
                F.lit("1950-01-01").cast("date"), F.round(F.abs("c_acctbal")).cast("int")
            ).alias("birth_date"),
        )

    def dim_book(self) -> DataFrame:
        return (
            self.work_info()
            .filter(F.col("title").isNotNull())
            .join(self.work_sameas(), "work_refid", "left_anti")
            .select(
                F.col("work_refid").alias("book_id"),
                F.col("title").alias("english_title"),
                F.col("title").alias("title_ori"),
            )
        )

    def star_review(self, with_user: bool = True) -> DataFrame:
        """The rating facts under the star schema's column names."""
        names = {
            "work_refid": "book_id", "user_id": "reviewer_id", "review_date": "date_id",
            "parsed_rating": "rating", "parsed_likes": "nb_likes", "review_lang": "lang_code",
        }
        return self.review_r(with_user).withColumnsRenamed(names)

    # -- feeds -----------------------------------------------------------------

    def stored_feed(self) -> DataFrame:
        return self.raw("lineitem").filter(
            F.col("l_shipdate") < F.lit(STORED_END).cast("timestamp_ntz")
        )

    def new_feed(self) -> DataFrame:
        return self.raw("lineitem").filter(
            F.col("l_shipdate") >= F.lit(FEED_START).cast("timestamp_ntz")
        )

    def staged_reviews(self) -> DataFrame:
        """Rows in the shape of the review staging table."""
        part = self.raw("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
        orders = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        customer = self.raw("customer").select("c_custkey", "c_name", "c_nationkey")
        nation = self.raw("nation").select("n_nationkey", "n_regionkey")
        buyers = (
            orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.site(), F.col("id") == F.col("n_regionkey") + 1)
        )
        full = (
            self.raw("lineitem")
            .join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(part, F.col("l_partkey") == F.col("p_partkey"))
        )
        tagged = F.col("l_discount") != 0.05
        size = F.col("p_size").cast("string")
        return full.select(
            F.col("l_partkey").alias("work_refid"),
            F.col("logical_name").alias("site_logical_name"),
            F.when(
                F.col("l_tax") != 0, F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
            ).alias("user_uid"),
            F.concat_ws(" ", "c_name", "l_returnflag").alias("username"),
            F.ceil(F.col("l_quantity") / 5).cast("int").alias("rating_n"),
            (F.col("l_linenumber") - 1).cast("int").alias("likes_n"),
            F.col("o_orderdate").cast("date").alias("parsed_review_date"),
            _lang_code(F.col("n_nationkey")).alias("review_lang"),
            F.when(F.col("l_discount") == 0, F.lit("-1"))
            .otherwise(F.concat(F.lit("u"), F.col("l_suppkey").cast("string")))
            .alias("work_uid"),
            F.when(F.col("l_discount") == 0.1, F.col("l_suppkey") + 1000000).alias("dup_refid"),
            F.when(
                tagged, F.concat_ws("__&__", F.lower("p_type"), F.lower("p_brand"), "p_name")
            ).alias("tags_t"),
            F.when(
                tagged,
                F.concat(
                    F.col("l_linenumber").cast("string"), F.lit(";1,"),
                    F.lpad(size, 3, "0"), F.lit(" ;"), size,
                ),
            ).alias("tags_n"),
            F.lit("eng").alias("tags_lang"),
            F.col("p_name").alias("title"),
            F.col("l_suppkey").cast("string").alias("authors"),
            F.col("l_shipdate"),
        )

    def staged_works(self) -> DataFrame:
        """Rows in the shape of the work-info staging table."""
        size = F.col("p_size").cast("string")
        code = F.col("digits")
        return self._part_code().select(
            F.col("p_partkey").alias("work_refid"),
            F.col("p_name").alias("title"),
            F.when(F.col("p_type") == "PROMO", F.col("p_partkey") + 1000000).alias("dup_refid"),
            F.lit("English").alias("original_lang"),
            F.when(
                F.col("p_type") != "SMALL",
                F.concat(F.lit("l"), F.lpad(F.substr("p_brand", F.lit(7)), 2, "0")),
            ).alias("ori_lang_code"),
            F.concat_ws(";", "p_name", "p_brand").alias("authors"),
            F.concat_ws(
                ";", F.replace("p_name", F.lit(" "), F.lit("")), F.lower("p_brand"), F.lower("p_type")
            ).alias("authors_code"),
            F.concat(F.substring(code, 1, 3), F.lit("."), F.substr(code, F.lit(4))).alias("mds_code"),
            F.when(F.col("p_size") % 5 == 0, F.substring(code, 1, 3)).alias("mds_code_corr"),
            F.when(
                F.col("p_type") != "ECONOMY", F.concat_ws("-->", "p_type", "p_brand", "p_name")
            ).alias("mds_text"),
            F.col("p_type").alias("lc_subjects"),
            F.concat(size, F.lit(","), F.lpad(size, 3, "0")).alias("popularity"),
            F.concat(
                F.lit("NATION_"), (F.col("p_size") % 25).cast("string"), F.lit(" : "),
                F.col("p_name"), F.lit(": "), F.col("p_brand"),
                F.lit("__&__Klingon : x"), F.col("p_type"), F.lit("__&__ : empty"),
            ).alias("other_lang_title"),
        )
