"""Column lists of the staging tables the dump files load into."""

from __future__ import annotations

STAGED_REVIEW = (
    "site_logical_name", "username", "user_uid", "rating", "review", "review_date", "review_lang",
    "likes", "work_refid", "dup_refid", "work_uid", "title", "authors", "tags_t", "tags_n",
    "tags_lang", "parsed_review_date", "parsed_rating", "parsed_likes", "parsed_dislikes",
)
STAGED_WORK_INFO = (
    "work_refid", "dup_refid", "title", "original_lang", "ori_lang_code", "authors", "authors_code",
    "mds_code", "mds_code_corr", "mds_text", "lc_subjects", "popularity", "other_lang_title",
)
STAGED_ISBN = ("work_refid", "isbn_ori", "isbn10", "isbn13")
STAGED_ISBN_LANG = ("ean", "lang_code")
LANGUAGE_REF = (
    "code3", "code3_term", "code2", "code", "english_iso_name", "english_name",
    "french_iso_name", "french_name",
)

# Types of the staged columns that are not text.
STAGED_TYPES = {
    "work_refid": "bigint", "dup_refid": "bigint", "parsed_review_date": "date",
    "parsed_likes": "int", "parsed_dislikes": "int", "ean": "bigint",
}


def text_schema(columns: tuple[str, ...]) -> str:
    return ", ".join(f"{c} string" for c in columns)
