"""Registered normalisation queries: raw field texts are composed from the fact rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions import fields, ids, text
from shelfmark.functions.isbn import isbn10_to_13 as to_13
from shelfmark.operators import languages, normalize, repair
from shelfmark.plans.grams import GRAMS_SQL
from shelfmark.plans.registry import query
from shelfmark.plans.standins import Standins

SITE_SQL = "[" + ", ".join(f"'{s}'" for s in fields.SITES) + "][site_id]"
MONTHS_SQL = "[" + ", ".join(f"'{m}'" for m in fields.FRENCH_MONTHS) + "]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def site_name(site_id: Column | str) -> Column:
    return F.get(F.array(*[F.lit(s) for s in fields.SITES]), _col(site_id) - 1)


def _facts(s: Standins) -> DataFrame:
    keys = ["order_id", "work_refid", "user_id", "site_id", "parsed_rating", "parsed_likes", "review_date"]
    return s.review_r().select(*keys).withColumn("site", site_name("site_id"))


def by_site(**values: Column) -> Column:
    """Pick an expression by site id; keywords are s1 to s5."""
    out = None
    for name, value in values.items():
        test = F.col("site_id") == int(name[1:])
        out = F.when(test, value) if out is None else out.when(test, value)
    return out


def raw_rating() -> Column:
    n = F.col("parsed_rating")
    stars = n % 6
    return by_site(
        s1=F.concat(F.lit("ss"), n.cast("string"), F.lit(".gif")),
        s2=stars.cast("string"),
        s3=F.concat(n.cast("string"), F.lit(" etoiles")),
        s4=F.when(stars > 0, F.concat(F.lit("Livres "), stars.cast("string"), F.lit(".00/5"))),
        s5=F.concat(stars.cast("string"), F.lit(".5 out of 5 stars")),
    )


def raw_date() -> Column:
    d = F.col("review_date")
    month = F.get(F.array(*[F.lit(m) for m in fields.FRENCH_MONTHS]), F.month(d) - 1)
    french = F.concat_ws(" ", F.dayofmonth(d).cast("string"), month, F.year(d).cast("string"))
    return by_site(
        s1=F.when(F.dayofmonth(d) == 1, F.lit("no date")).otherwise(F.date_format(d, "MMM d, yyyy")),
        s2=F.date_format(d, "MMM d, yyyy"),
        s3=F.concat(F.lit(" - BOURGES - 50 ans - "), french),
        s4=french,
        s5=F.date_format(d, "'on' MMMM d, yyyy"),
    )


def raw_likes() -> Column:
    n = F.col("parsed_likes")
    total = F.concat(F.lit("1,"), F.lpad((n + F.col("parsed_rating")).cast("string"), 3, "0"))
    return by_site(
        s1=F.when(n > 0, n.cast("string")).otherwise(F.lit(" ")),
        s2=F.when(n > 0, F.concat(n.cast("string"), F.when(n == 1, " like").otherwise(" likes"))),
        s4=n.cast("string"),
        s5=F.when(n == 0, F.lit("One person found this helpful"))
        .when(n < 4, F.concat(n.cast("string"), F.lit(" people found this helpful")))
        .otherwise(F.concat(n.cast("string"), F.lit(" of "), total, F.lit(" people found this helpful"))),
    )


def raw_link() -> Column:
    u = F.col("user_id").cast("string")
    return by_site(
        s1=F.concat(F.lit("/profile/user"), u),
        s2=F.concat(F.lit("/user/show/"), u, F.lit("-some-name")),
        s3=F.concat(F.lit("/i.php/vuser/?uid=a"), u),
        s4=F.concat(F.lit("/monprofil.php?id_user="), u),
        s5=F.concat(F.lit("/gp/pdp/profile/A"), u, F.lit("/ref=cm_cr_arp_d_pdp?ie=UTF8")),
    )


@query("normalize_rating", f"""
    select order_id, work_refid, user_id, {SITE_SQL} as site,
           cast(case site_id when 1 then parsed_rating
                when 2 then case when parsed_rating % 6 > 0 then 2 * (parsed_rating % 6) end
                when 3 then parsed_rating when 4 then 2 * (parsed_rating % 6)
                when 5 then 2 * (parsed_rating % 6) + 1 end as int) as parsed_rating from review_r""")
def normalize_rating(s: Standins):
    return _facts(s).select(
        "order_id", "work_refid", "user_id", "site",
        fields.parsed_rating("site", raw_rating()).alias("parsed_rating"),
    )


@query("normalize_date", f"""
    select order_id, work_refid, user_id, {SITE_SQL} as site,
           case when site_id = 1 and day(review_date) = 1 then null else review_date end as parsed_review_date
    from review_r""")
def normalize_date(s: Standins):
    return _facts(s).select(
        "order_id", "work_refid", "user_id", "site",
        fields.parsed_date("site", raw_date()).alias("parsed_review_date"),
    )


@query("normalize_likes", f"""
    select order_id, work_refid, user_id, {SITE_SQL} as site,
           cast(case when site_id in (1, 2) and parsed_likes = 0 then null when site_id = 3 then null
                when site_id = 5 and parsed_likes = 0 then null else parsed_likes end as int) as parsed_likes,
           cast(case when site_id = 5 and parsed_likes >= 4 then 1000 + parsed_rating end as int) as parsed_dislikes
    from review_r""")
def normalize_likes(s: Standins):
    return _facts(s).select(
        "order_id", "work_refid", "user_id", "site",
        fields.parsed_likes("site", raw_likes()).alias("parsed_likes"),
        fields.parsed_dislikes("site", raw_likes()).alias("parsed_dislikes"),
    )


@query("normalize_user_uid", f"""
    select order_id, work_refid, {SITE_SQL} as site,
           case site_id when 1 then 'user' || user_id when 2 then user_id || '-some-name' when 3 then 'a' || user_id
                when 4 then cast(user_id as varchar)
                else case when parsed_likes = 0 then 'A customer' else 'A' || user_id end end as user_uid,
           case when site_id = 1 then 'user' || user_id when site_id = 5 and parsed_likes = 0 then 'A customer'
                when parsed_likes = 0 then null else 'name ' || user_id end as username
    from review_r""")
def normalize_user_uid(s: Standins):
    named = F.when(F.col("parsed_likes") > 0, F.concat(F.lit("name "), F.col("user_id").cast("string")))
    rows = _facts(s).withColumn("username", named).withColumn(
        "user_uid", fields.user_uid("site", raw_link(), "username")
    )
    return rows.select(
        "order_id", "work_refid", "site", "user_uid",
        fields.user_name("site", "user_uid", "username").alias("username"),
    )


@query("pack_tags", """
    select work_refid, site_logical_name,
           lower(p_type) || '__&__' || p_name || ' > ' || p_brand as tags_t,
           case site_logical_name when 'librarything' then p_size || ';' || (p_size * 3)
                when 'goodreads' then p_size || ' ;0' else p_size || ';' || (p_size + 7) end as tags_n,
           case site_logical_name when 'babelio' then 'fre' else 'eng' end as tags_lang
    from (select p_partkey as work_refid, p_type, p_name, p_brand, p_size,
                 unnest(['librarything', 'goodreads', 'babelio']) as site_logical_name from part) p""")
def pack_tags(s: Standins):
    size = F.col("p_size")
    three = F.array(F.lit(fields.LIBRARYTHING), F.lit(fields.GOODREADS), F.lit(fields.BABELIO))
    text_of = lambda c: c.cast("string")
    site = F.col("site_logical_name")
    first = F.when(site == fields.LIBRARYTHING, F.concat(F.lit(" ("), text_of(size), F.lit(")"))).when(
        site == fields.GOODREADS, F.concat(text_of(size), F.lit(" users"))
    ).otherwise(F.concat(F.lit("tag_t"), text_of(size), F.lit(" tc0 ")))
    second = F.when(site == fields.LIBRARYTHING, F.concat(F.lit("("), text_of(size * 3), F.lit(")p;"))).when(
        site == fields.GOODREADS, F.lit(None)
    ).otherwise(F.concat(F.lit("tag_t"), text_of(size + 7), F.lit(" tc1")))
    rows = s.raw("part").select(
        F.col("p_partkey").alias("work_refid"), "p_size",
        F.array(F.lower("p_type"), F.concat_ws(" > ", "p_name", "p_brand")).alias("tags"),
        F.explode(three).alias("site_logical_name"),
    )
    packed = normalize.pack_tags(rows.withColumn("tag_counts", F.array(first, second)))
    return packed.select("work_refid", "site_logical_name", "tags_t", "tags_n", "tags_lang")


@query("correct_mds", """
    with p as (select p_partkey as work_refid, p_size, substr(digits, 1, 3) || '.' || substr(digits, 4) as code, digits,
                      [p_type, p_brand, p_name][1:cast(1 + p_size % 3 as int)] as levels from part_code)
    select work_refid, code as mds_code, array_to_string(levels, '-->') as mds_text,
           case when length(digits) > len(levels) then substr(digits, 1, len(levels)) end as mds_code_corr from p""")
def correct_mds(s: Standins):
    code = F.col("digits")
    rows = s._part_code().select(
        F.col("p_partkey").alias("work_refid"),
        F.concat(F.substring(code, 1, 3), F.lit("."), F.substr(code, F.lit(4))).alias("code"),
        F.array_insert(
            F.slice(F.array("p_type", "p_brand", "p_name"), F.lit(1), (F.col("p_size") % 3 + 1).cast("int")),
            2, F.lit("not-set"),
        ).alias("levels"),
    )
    return rows.select("work_refid", *[c.alias(n) for n, c in fields.corrected_mds("code", "levels").items()])


_EDITIONS = """editions as (
        select l_partkey as work_refid, l_orderkey * 10 + l_linenumber as position,
               'asin' || l_suppkey as asin, cast(l_linenumber as varchar) || '.0' as avg_stars,
               cast(l_quantity as int) * 100 as nb, l_returnflag
        from lineitem)"""


@query("dedupe_editions", f"""
    with {_EDITIONS}, kept as (
        select work_refid, min_by(asin, (position, asin)) as work_uid from editions where l_returnflag = 'A'
        group by work_refid, nb, avg_stars)
    select work_refid, work_uid from kept
    union all select p_partkey, case when p_partkey in (select work_refid from editions) then '-2' else '-1' end
    from part where p_partkey not in (select work_refid from kept)""")
def dedupe_editions(s: Standins):
    lines = s.raw("lineitem")
    nb = F.col("l_quantity").cast("int") * 100
    results = lines.select(
        F.col("l_partkey").alias("work_refid"),
        F.struct(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("p"),
            F.concat(F.lit("asin"), F.col("l_suppkey").cast("string")).alias("a"),
        ).alias("position"),
        F.concat(F.lit("asin"), F.col("l_suppkey").cast("string")).alias("asin"),
        F.when(
            F.col("l_returnflag") == "A",
            F.concat(F.col("l_linenumber").cast("string"), F.lit(".0 out of 5 stars")),
        ).alias("stars"),
        F.regexp_replace(F.format_number(nb, 0), "^$", "0").alias("nb_reviews"),
    )
    searched = s.raw("part").select(F.col("p_partkey").alias("work_refid"))
    return normalize.dedupe_editions(searched, results)


@query("isbn10_to_13", """
    with i as (select o_orderkey, lpad(cast(o_orderkey * 7919 % 1000000000 as varchar), 9, '0') as d from orders),
    s as (select *, '978' || d as b from i)
    select o_orderkey, b || cast((10 - (list_sum(list_transform(range(1, 13),
           lambda k: cast(substr(b, k, 1) as int) * case when k % 2 = 1 then 1 else 3 end))::bigint % 10)) % 10 as varchar)
           as isbn13 from s""")
def isbn10_to_13(s: Standins):
    number = F.lpad(((F.col("o_orderkey") * 7919) % 1000000000).cast("string"), 9, "0")
    dashed = F.concat(F.substring(number, 1, 1), F.lit("-"), F.substring(number, 2, 8), F.lit("-X"))
    return s.raw("orders").select("o_orderkey", to_13(dashed).alias("isbn13"))


@query("marc_lookup", """
    with asked as (select o_orderkey, case o_orderkey % 6 when 0 then ' nation_' || (o_custkey % 30) || ' '
            when 1 then lpad(cast(o_custkey % 30 as varchar), 2, '0') when 2 then 'X' || lpad(cast(o_custkey % 30 as varchar), 2, '0')
            when 3 then 'FR nation_' || (o_custkey % 30) when 4 then null else 'funny' end as name from orders),
    names as (select upper(code2) as n, upper(code) as code from language union select upper(code3), upper(code) from language
        union select upper(english_name), upper(code) from language union select upper(french_name), upper(code) from language)
    select o_orderkey, case when name is not null then lower(coalesce(names.code, '--')) end as marc_code
    from asked left join names on names.n = upper(trim(asked.name))""")
def marc_lookup(s: Standins):
    kind, number = F.col("o_orderkey") % 6, (F.col("o_custkey") % 30).cast("string")
    name = (
        F.when(kind == 0, F.concat(F.lit(" nation_"), number, F.lit(" ")))
        .when(kind == 1, F.lpad(number, 2, "0"))
        .when(kind == 2, F.concat(F.lit("X"), F.lpad(number, 2, "0")))
        .when(kind == 3, F.concat(F.lit("FR nation_"), number))
        .when(kind == 5, F.lit("funny"))
    )
    asked = s.raw("orders").select("o_orderkey", name.alias("name"))
    return normalize.marc_lookup(asked, "name", s.language(), capital=False).drop("name")


@query("derived_names", r"""
    select p_partkey, cast(md5('w' || p_partkey || p_brand)::uuid as varchar) as other_work_id,
           upper(regexp_replace(trim(p_name), '\s+', ' ', 'g')) as short_form,
           regexp_replace(upper(trim(p_name)), '\s+', '-', 'g') as dashed_title,
           upper(p_brand) || ', ' || upper(p_type) as author_label from part""")
def derived_names(s: Standins):
    uid = F.concat(F.lit("w"), F.col("p_partkey").cast("string"))
    return s.raw("part").select(
        "p_partkey", ids.derive_other_work_id(uid, "p_brand").alias("other_work_id"),
        ids.short_form(F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit("  ")))).alias("short_form"),
        ids.dashed_title(F.concat(F.col("p_name"), F.lit(" "))).alias("dashed_title"),
        ids.author_label("p_type", "p_brand").alias("author_label"),
    )


@query("clean_text", """
    select id, replace(replace(review, chr(13) || chr(10), chr(10)), ' (   )', '') as review,
           replace(review, chr(9), '') as flat from review_t""")
def clean_text(s: Standins):
    stained = F.concat(F.replace("review", F.lit("\n"), F.lit("\r\n")), F.lit(" (   )"))
    return s.review_t().select(
        "id",
        text.without_empty_rating(text.unix_lines(stained)).alias("review"),
        text.without_tabs("review").alias("flat"),
    )


@query("isbn_lang_validate", """
    select o_orderkey as ean, case when o_orderstatus = 'O' then 'eng' else 'und' end as lang_code
    from orders where o_orderstatus <> 'P'""")
def isbn_lang_validate(s: Standins):
    reply = F.when(F.col("o_orderstatus") == "O", "eng").when(F.col("o_orderstatus") == "F", "unknown")
    replies = s.raw("orders").select(
        F.col("o_orderkey").alias("ean"), reply.otherwise("an error page").alias("reply")
    )
    return normalize.validate_isbn_lang(replies)[0]


@query("isbn_lang_rejects", """
    select o_orderkey as ean, 'an error page' as reply from orders where o_orderstatus = 'P'""")
def isbn_lang_rejects(s: Standins):
    reply = F.when(F.col("o_orderstatus") == "O", "eng").when(F.col("o_orderstatus") == "F", "unknown")
    replies = s.raw("orders").select(F.col("o_orderkey").alias("ean"), reply.otherwise("an error page").alias("reply"))
    return normalize.validate_isbn_lang(replies)[1]


@query("lang_prior", """
    select review_lang, round(count(*)::double / sum(count(*)) over (), 9) as ratio
    from review_t where length(review) >= 100 group by 1""")
def lang_prior(s: Standins):
    return languages.lang_prior(s.review_t())


_DETECTED = f"""grams as (select id, review_lang, review, {GRAMS_SQL} as g from review_t),
    counted as (select lang, gram, count(*) as n
        from (select review_lang as lang, unnest(g) as gram from grams where review_lang is not null) group by 1, 2),
    sizes as (select lang, ln(sum(n) + count(*)) as size from counted group by 1),
    found as (select id, lang, sum(ln(n + 1)) as weight
        from (select id, unnest(g) as gram from grams where length(review) >= 30) join counted using (gram) group by 1, 2),
    scored as (select id, lang, weight - len(g) * size as score
        from found join sizes using (lang) join grams using (id)),
    tops as (select id, max(score) as score, max_by(lang, (score, lang)) as lang from scored group by 1),
    sure as (select id, any_value(tops.lang) as lang, 1 / sum(exp(scored.score - tops.score)) as p
        from scored join tops using (id) group by 1),
    detected as (select id, review, review_lang, case when length(review) > 0 then
            case when p >= 0.7 then lang else 'und' end end as detected_lang
        from grams left join sure using (id))"""


@query("detect_language", f"with {_DETECTED} select id, review_lang, detected_lang from detected")
def detect_language(s: Standins):
    reviews = languages.with_sets(s.review_t().select("id", "review", "review_lang"))
    profiles = languages.train_profiles(reviews)
    return languages.detect_language(reviews, profiles).select("id", "review_lang", "detected_lang")


@query("batch_detect_language", f"""
    with {_DETECTED}
    select id, case when length(review) >= 30 and 2 * length(translate(review, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) < length(review)
                    then detected_lang else coalesce(review_lang, detected_lang) end as review_lang from detected""")
def batch_detect_language(s: Standins):
    """Languages of reviews in capitals are forgotten, then found again."""
    reviews = languages.with_sets(s.review_t().select("id", "review", "review_lang"))
    profiles = languages.train_profiles(reviews)
    reset = repair.reset_lang_for_caps(reviews)
    return languages.batch_detect_language(reset, profiles).select("id", "review_lang")
