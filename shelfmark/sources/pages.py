"""Review and work-detail pages to rows.

``mapInPandas`` hands pages to the element tree and takes raw texts back; ratings,
dates, likes, user ids, tags and classification codes are then made by column
expressions for all sites alike.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions import fields
from shelfmark.functions.text import without_tabs
from shelfmark.operators.normalize import marc_lookup, normalize_reviews
from shelfmark.session import ship_package
from shelfmark.sources.markup import Element, parse
from shelfmark.sources.tables import spread

# Host names of the sites.
HOSTS = {
    "librarything.com": fields.LIBRARYTHING,
    "goodreads.com": fields.GOODREADS,
    "critiqueslibres.com": fields.CRITIQUESLIBRES,
    "babelio.com": fields.BABELIO,
    "amazon.com": fields.AMAZON,
}

RAW_REVIEW = (
    "url string, site_logical_name string, work_uid string, title string, authors string, "
    "tags array<string>, tag_counts array<string>, nth int, username string, user_link string, "
    "rating string, review_date string, likes string, review string"
)
RAW_WORK = (
    "url string, requested string, page_refid string, title string, original_lang string, other_lang_title string, "
    "authors string, author_links array<string>, mds array<string>, lc_subjects string, popularity string"
)


def site_of(url: Column | str) -> Column:
    """Site a page belongs to, by its host name; NULL for other hosts."""
    host = F.parse_url(F.col(url) if isinstance(url, str) else url, F.lit("HOST"))
    out = None
    for domain, site in HOSTS.items():
        test = (host == domain) | F.endswith(host, F.lit("." + domain))
        out = F.when(test, site) if out is None else out.when(test, site)
    return out


def _joined(texts: list[str]) -> str:
    return " ".join(texts).strip()


def _text_of(e: Element | None) -> str | None:
    return e.own_text() if e is not None else None


def _attr_of(e: Element | None, name: str) -> str | None:
    return e.get(name) if e is not None else None


def _librarything(page: Element) -> Iterator[dict]:
    for block in page.find_all("div", cls="bookReview"):
        body = block.find("div", cls="commentText")
        footer = block.find("span", cls="controlItems")
        image = body.find("img", lambda e: e.parent.get("class") == "rating")
        dated = (_text_of(footer) or "").strip()
        yield {
            "review": _joined(body.texts()),
            "rating": image.get("src").rsplit("pics/", 1)[-1] if image else None,
            "user_link": _attr_of(footer.find("a", lambda e: e.get("href").startswith("/profile/")), "href"),
            "review_date": dated[dated.find("|") + 1:dated.rfind("|")].strip(),
            "likes": _text_of(block.find("span", cls="reviewVoteCount")),
        }


def _amazon(page: Element) -> Iterator[dict]:
    for block in page.find_all("div", cls="a-section review"):
        author = block.find("a", cls="a-size-base a-link-normal author")
        body = block.find("span", cls="a-size-base review-text")
        yield {
            "rating": _text_of(block.find("span", cls="a-icon-alt")),
            "username": _text_of(author),
            "user_link": _attr_of(author, "href"),
            "review": _joined(body.texts()) if body else "",
            "review_date": _text_of(block.find("span", cls="a-size-base a-color-secondary review-date")),
            "likes": _text_of(block.find("span", cls="a-size-small a-color-secondary review-votes")),
        }


def _goodreads(page: Element) -> Iterator[dict]:
    for block in page.find_all("div", lambda e: e.get("id").startswith("review_")):
        user = block.find("a", cls="user")
        holder = block.find("span", lambda e: e.get("id").startswith("reviewTextContainer"))
        shown = [e for e in holder.elements() if e.get("id").startswith("freeText")] if holder else []
        stars = len(block.find_all("span", cls="staticStar p10"))
        yield {
            "rating": str(stars) if stars else None,
            "username": _attr_of(user, "title"),
            "user_link": _attr_of(user, "href"),
            # The whole text is in the last of the text elements.
            "review": _joined(shown[-1].texts()) if shown else "",
            "review_date": _text_of(block.find("a", itemprop="publishDate")),
            "likes": _text_of(block.find("span", cls="likesCount")),
        }


def _babelio(page: Element) -> Iterator[dict]:
    for block in page.find_all("div", cls="post_con"):
        user = block.find("a", lambda e: "/monprofil.php?id_user=" in e.get("href"), cls="author")
        dated = block.find("span", lambda e: e.parent.tag == "td" and e.parent.get("class") == "no_img")
        lines = [
            t for holder in block.find_all("div", cls="text row")
            for e in holder.elements() if e.tag == "div" for t in e.own_texts()
        ]
        likes = block.find("span", lambda e: bool(e.get("id")) and e.parent.get("class") == "post_items_like ")
        yield {
            "rating": _text_of(block.find("li", cls="current-rating")),
            "username": _text_of(user),
            "user_link": _attr_of(user, "href"),
            "review": _joined(lines),
            "review_date": _text_of(dated),
            "likes": _text_of(likes),
        }


def _critiqueslibres(page: Element) -> Iterator[dict]:
    """Rows come in threes: title and stars, text and user, a rule."""
    rating = None
    for table in page.find_all("table", width="100%", border="0", cellpadding="3"):
        for row in (e for e in table.elements() if e.tag == "tr"):
            stars = row.find("img", lambda e: "etoiles" in e.get("name"))
            if stars is not None:
                rating = stars.get("name")
            user = row.find("a", lambda e: e.get("href").startswith("/i.php/vuser"))
            if user is not None:
                paragraphs = row.find_all("p")
                yield {
                    "rating": rating,
                    "username": _text_of(user),
                    "user_link": user.get("href"),
                    "review": _joined(paragraphs[0].texts()) if len(paragraphs) > 1 else "",
                    "review_date": user.parent.own_texts()[-1].rsplit("-", 1)[-1].strip(),
                }


def _page_fields(site: str, url: str, page: Element) -> dict:
    """Work, title, authors and tags a page shows besides its reviews."""
    out: dict = {"tags": [], "tag_counts": []}

    def between(start: str, *ends: str) -> str | None:
        if start not in url:
            return None
        rest = url.split(start, 1)[1]
        for end in ends:
            rest = rest.split(end, 1)[0]
        return rest

    if site == fields.LIBRARYTHING:
        out["work_uid"] = between("/work/", "/", "?")
        for tag in (e for d in page.find_all("div", cls="tags") for e in d.elements() if e.tag == "span"):
            name = _text_of(tag.find("a"))
            if name:
                out["tags"].append(name)
                out["tag_counts"].append(_text_of(tag.find("span", cls="count")))
    elif site == fields.AMAZON:
        out["work_uid"] = between("/product-reviews/", "/ref=")
        title = page.find("div", cls="a-row product-title")
        author = page.find("div", cls="a-row product-by-line")
        out["title"] = _text_of(title.find("a")) if title else None
        out["authors"] = _text_of(author.find("a")) if author else None
    elif site == fields.GOODREADS:
        out["work_uid"] = between("/book/show/", "?")
        title = _text_of(page.find("h1", cls="bookTitle"))
        out["title"] = title.strip() if title else None
        names = [t for a in page.find_all("a", cls="authorName") for e in a.elements() for t in e.own_texts()]
        out["authors"] = ",".join(names) or None
        for line in page.find_all("div", lambda e: e.get("class").startswith("elementList ")):
            left, right = line.find("div", cls="left"), line.find("div", cls="right")
            if left is not None:
                out["tags"].append(" > ".join(t for a in left.find_all("a") for t in a.own_texts()[:1]))
                out["tag_counts"].append(_text_of(right.find("a")) if right else None)
    elif site == fields.BABELIO:
        out["work_uid"] = between("/livres/", "/critiques", "?")
        for tag in page.find_all("a", rel="tag"):
            out["tags"].append((_text_of(tag) or "").strip())
            out["tag_counts"].append(tag.get("class"))
    else:
        out["work_uid"] = between("/vcrit/", "?")
        title = page.find("strong")
        out["title"] = _text_of(title)
    return out


REVIEW_RULES = {
    fields.LIBRARYTHING: _librarything,
    fields.AMAZON: _amazon,
    fields.GOODREADS: _goodreads,
    fields.BABELIO: _babelio,
    fields.CRITIQUESLIBRES: _critiqueslibres,
}


# Rows handed back to Spark at a time.
ROWS_PER_FRAME = 500


def _frames(rows: Iterator[dict], schema: str) -> Iterator[pd.DataFrame]:
    """Rows as frames of bounded size."""
    names = [f.split()[0] for f in schema.split(", ")]
    while chunk := list(itertools.islice(rows, ROWS_PER_FRAME)):
        yield pd.DataFrame({n: pd.Series([r.get(n) for r in chunk], dtype=object) for n in names})


def raw_reviews(pages: DataFrame) -> DataFrame:
    """Reviews as written on the pages; a page without any gives one row of page fields.

    Pages of other hosts are skipped before they reach Python.
    """

    def reviews(batches: Iterator[pd.DataFrame]) -> Iterator[dict]:
        for batch in batches:
            for url, site, html in zip(batch["url"], batch["site"], batch["html"]):
                page = parse(html)
                shared = {"url": url, "site_logical_name": site, **_page_fields(site, url, page)}
                found = [{**shared, "nth": i, **r} for i, r in enumerate(REVIEW_RULES[site](page))]
                yield from found or [shared]

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _frames(reviews(batches), RAW_REVIEW)

    ours = pages.select("url", site_of("url").alias("site"), "html").filter(
        F.col("site").isNotNull() & F.col("html").isNotNull()
    )
    ship_package(pages.sparkSession)
    return spread(ours).mapInPandas(extract, RAW_REVIEW)


def extract_reviews(pages: DataFrame) -> DataFrame:
    """Normalised reviews of ``pages(url, html)``."""
    return normalize_reviews(raw_reviews(pages))


def _work(page: Element, url: str) -> dict:
    table = page.find("table", id="book_bookInformationTable") or Element("table", {}, None)
    rows = table.find_all("tr")
    title = rows[0].find("b") if rows else None
    other: list[str] = []
    for cell in table.find_all("td", lambda e: (e.own_text() or "").startswith("Other language")):
        siblings = cell.parent.elements()
        for e in siblings[siblings.index(cell) + 1:]:
            other.extend(e.texts())
    heads = [h for d in page.find_all("div", cls="headsummary") for h in d.elements() if h.tag == "h2"]
    authors = [a for h in heads for a in h.elements() if a.tag == "a"]
    ddc = table.find("div", id="ddcdisplay")
    first = next((e for e in ddc.elements() if e.tag == "p"), None) if ddc is not None else None
    lines = [
        "->".join(t for a in line.elements() if a.tag == "a" and a.get("href").startswith("/subject/")
                  for t in a.own_texts()[:1])
        for line in table.find_all("div", cls="subjectLine")
    ]
    content = page.find("tr", cls="wslcontent")
    popular = content.find("a", lambda e: "popularity" in e.get("href")) if content is not None else None
    if popular is None and content is not None:
        cells = [e for e in content.elements() if e.tag == "td"]
        popular = cells[2] if len(cells) > 2 else None
    return {
        "url": url,
        "page_refid": url.split("/work/", 1)[1].split("/workdetails", 1)[0],
        "title": _text_of(title),
        "original_lang": _text_of(table.find("a", lambda e: e.get("href").startswith("/language.php?"))),
        "other_lang_title": "__&__".join(other),
        "authors": ";".join(t for a in authors for t in a.own_texts()[:1]),
        "author_links": [a.get("href") for a in authors],
        "mds": [t for a in first.elements() if a.tag == "a" for t in a.own_texts()[:1]] if first else [],
        "lc_subjects": "__&__".join(lines) if lines else None,
        "popularity": _text_of(popular),
    }


def extract_work_details(pages: DataFrame, language: DataFrame | None = None) -> DataFrame:
    """Work reference rows of ``pages(requested_refid, url, html)``.

    With the language table the original language gets its code.

    A page that shows another work than the one requested is its master: the requested
    id is the duplicate. Author codes are the links without their eight-character prefix.
    """

    def works(batches: Iterator[pd.DataFrame]) -> Iterator[dict]:
        for batch in batches:
            for url, asked, html in zip(batch["url"], batch["requested"], batch["html"]):
                yield {"requested": asked, **_work(parse(html), url)}

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _frames(works(batches), RAW_WORK)

    detail = pages.filter(
        F.contains(F.col("url"), F.lit("/workdetails")) & F.col("html").isNotNull()
    ).select("url", F.col("requested_refid").cast("string").alias("requested"), "html")
    ship_package(pages.sparkSession)
    # Many pages are few bytes but costly to take apart: they are dealt to all cores, whatever their files.
    raw = spread(detail).mapInPandas(extract, RAW_WORK)
    code = F.get("mds", F.lit(0))
    mds = fields.corrected_mds(code, F.slice("mds", F.lit(2), F.greatest(F.size("mds") - 1, F.lit(0))))
    known = F.size("mds") > 0
    rows = raw.select(
        F.col("page_refid").cast("bigint").alias("work_refid"),
        F.when(F.col("page_refid") != F.col("requested"), F.col("requested")).cast("bigint").alias("dup_refid"),
        without_tabs("title").alias("title"),
        "original_lang",
        without_tabs("authors").alias("authors"),
        F.array_join(F.transform("author_links", lambda a: F.substr(a, F.lit(9))), ";").alias("authors_code"),
        *[F.when(known, c).alias(n) for n, c in mds.items()],
        "lc_subjects",
        F.when(~F.contains(F.col("popularity"), F.lit("—")), F.col("popularity")).alias("popularity"),
        "other_lang_title",
    )
    if language is None:
        return rows
    return marc_lookup(rows, "original_lang", language, out="ori_lang_code", capital=False)
