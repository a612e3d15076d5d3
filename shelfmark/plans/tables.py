"""Column layouts of the stored tables."""

from __future__ import annotations

from pyspark.sql.types import StructType

from shelfmark.sources.touches import Touched

_AUDIT = ", create_dts timestamp_ntz, load_audit_id int"

SCHEMAS = {
    "site": "id int, logical_name string",
    "site_identifier": "site_id int, hostname string",
    "language": "code string, code3 string, code3_term string, code2 string, english_name string, "
                "english_iso_name string, french_name string, french_iso_name string",
    "stage_isbn": "work_refid bigint, isbn_ori string, isbn10 string, isbn13 string",
    "stage_review": "site_logical_name string, username string, user_uid string, rating string, review string, "
                    "review_date string, review_lang string, likes string, work_refid bigint, dup_refid bigint, "
                    "work_uid string, title string, authors string, tags_t string, tags_n string, tags_lang string, "
                    "parsed_review_date date, parsed_rating string, parsed_likes int, parsed_dislikes int",
    "stage_work_info": "work_refid bigint, dup_refid bigint, title string, original_lang string, ori_lang_code string, "
                       "authors string, authors_code string, mds_code string, mds_code_corr string, mds_text string, "
                       "lc_subjects string, popularity string, other_lang_title string",
    "work": "refid bigint, last_harvest_dts timestamp_ntz, last_seen_date date" + _AUDIT,
    "work_info": "work_refid bigint, title string, original_lang string, ori_lang_code string, mds_code string, "
                 "mds_code_ori string, lc_subjects string, popularity int" + _AUDIT,
    "isbn": "ean bigint, isbn13 string, isbn10 string, last_seen_date date" + _AUDIT,
    "isbn_info": "ean bigint, lang_code string, update_dts timestamp_ntz" + _AUDIT,
    "work_isbn": "work_refid bigint, ean bigint, last_seen_date date, deletion_date date" + _AUDIT,
    "author": "id string, code string" + _AUDIT,
    "author_info": "author_id string, name string" + _AUDIT,
    "work_author": "work_refid bigint, author_id string" + _AUDIT,
    "work_title": "work_refid bigint, lang_code string, lang_text string, title string" + _AUDIT,
    "work_sameas": "work_refid bigint, master_refid bigint" + _AUDIT,
    "mds": "code string, code_w_dot string, mds_text string" + _AUDIT,
    "tag": "id string, tag string, tag_upper string, ori_site_id int, lang_code string" + _AUDIT,
    "work_tag": "work_refid bigint, tag_id string, source_site_id int, frequency int, update_dts timestamp_ntz" + _AUDIT,
    "user": "id string, user_uid string, site_id int, username string, last_seen_date date" + _AUDIT,
    "review": "id bigint, work_refid bigint, user_id string, site_id int, rating string, parsed_rating int, "
              "likes string, parsed_likes int, review string, review_date date, review_lang string" + _AUDIT,
    "work_site_mapping": "work_refid bigint, work_uid string, site_id int, last_harvest_dts date, title string, "
                         "authors string" + _AUDIT,
    "rev_similarto_process": "work_refid bigint, review_id bigint, text_length int, review_lang string, "
                             "date_processed timestamp_ntz, load_audit_id int",
    "similar_member": "id bigint, work_refid bigint, lang string, len int, site_id int, text_key string, load_audit_id int",
    "similar_class": "work_refid bigint, lang string, len int, text_key string, grams binary, n int, bucket int, "
                     "load_audit_id int",
    "isbn_lang_rejected": "ean string, reply string, load_audit_id int",
    "tag_key": "tag_name string, tag_id bigint, load_audit_id int",
    "author_key": "code string, author_id bigint, load_audit_id int",
    "reviewer_key": "reviewer_uuid string, reviewer_id bigint, load_audit_id int",
    "review_patch": "id bigint, column string, value string, deleted boolean, load_audit_id int",
    "review_state": "work_refid bigint, site_id int, nb_reviews bigint, rating_n bigint, rating_sum bigint, "
                    "rating_squares bigint, load_audit_id int",
    "review_readers": "site_id int, readers binary, load_audit_id int",
    "user_sameas": "user_id string, same_user_id string",
    "rejected": "source string, block bigint, field string, reason string, line string, load_audit_id int",
    "city": "city string, pop bigint, lat double, long double",
    "review_similarto": "site_id int, review_id bigint, other_site_id int, other_review_id bigint, "
                        "similarity double, load_audit_id int",
}

# Columns of a review that a patch can set.
PATCHED = ("review_lang", "parsed_rating", "review_date")

# Tables kept as touches: their keys, and the columns each kind of touch sets on known rows.
TOUCHED = {
    "work": Touched(("refid",), {"seen": ("last_seen_date",), "harvested": ("last_harvest_dts",)}),
    "isbn": Touched(("ean",), {"seen": ("last_seen_date",)}),
    "isbn_info": Touched(("ean",), {"told": ("lang_code", "update_dts")}),
    "user": Touched(("id",), {"seen": ("last_seen_date",)}),
    "work_tag": Touched(("work_refid", "tag_id", "source_site_id"), {"counted": ("frequency", "update_dts")}),
    "work_site_mapping": Touched(("work_refid", "work_uid", "site_id"), {"seen": ("last_harvest_dts",)}),
}


def layout(name: str) -> StructType:
    """A stored table's layout."""
    return StructType.fromDDL(SCHEMAS[name])
