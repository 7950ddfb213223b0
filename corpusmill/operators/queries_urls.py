"""Queries of URL work, hashing and duplicates, and crawl control."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import urls as U
from corpusmill.operators import crawl, dedup
from corpusmill.operators.catalogue import query
from corpusmill.plans.lineage import table

HOME = ("example.net",)
C = F.col
CLEAN = "regexp_replace(replace(replace(url, 'https://', ''), 'http://', ''), '/+$', '')"
HOME_SQL = r"regexp_matches(url, '(?i)^https?://(www\.)?(example\.net)(/|$)')"
DENIED_SQL = "regexp_matches(url, '(?i)" + "|".join(U.DENIED) + "')"
HOST_SQL = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"
COMMENT_SQL = (
    f"(ends_with(lower({HOST_SQL}), 'substack.com') AND len(list_filter(string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&'),"
    " lambda p: contains(lower(split_part(p, '=', 1)), 'comment') AND regexp_matches(p, '=.'))) > 0)"
)
#: Page urls with some turned into comment pages, images and mail links.
VARIED = "CASE page_id % 6 WHEN 0 THEN 'https://a.substack.com/p/x?' || CASE page_id % 4 WHEN 0 THEN 'commentId=' || page_id ELSE 'comment=' END WHEN 1 THEN url || '.jpeg' WHEN 2 THEN 'mailto:a' || page_id || '@b.c' ELSE url END"


def pages(spark, d):
    return table(spark, d, "pages")


def varied(spark, d):
    return pages(spark, d).select("page_id", F.expr(VARIED).alias("url"))


@query("u1_clean_url", f"SELECT page_id, {CLEAN} AS cleaned FROM pages")
def _(spark, d):
    return pages(spark, d).select("page_id", U.clean(C("url")).alias("cleaned"))


@query("u2_file_names", f"SELECT page_id, replace({CLEAN}, '/', '_') || '.html' AS html_name, replace({CLEAN}, '/', '_') || '.pdf' AS pdf_name, replace({CLEAN}, '/', '_') || '.txt' AS txt_name FROM pages")
def _(spark, d):
    return pages(spark, d).select("page_id", *[U.file_name(C("url"), f".{s}").alias(f"{s}_name") for s in ("html", "pdf", "txt")])


@query("u3_archived_name", f"SELECT page_id, 'archived_' || replace(replace(replace({CLEAN}, '?', 'QQ'), '=', 'EQ'), '&', 'AMP') AS name FROM pages")
def _(spark, d):
    return pages(spark, d).select("page_id", U.archived_name(C("url")).alias("name"))


@query(
    "u4_safe_file_name",
    "WITH b AS (SELECT page_id, regexp_extract(regexp_extract(url, '^[^?#]*'), '[^/]*$') AS b FROM pages) "
    "SELECT page_id, substr(regexp_replace(CASE WHEN ends_with(lower(b), '.txt') THEN b ELSE b || '.txt' END, '[^-\\p{L}\\p{N}_. ]', '_', 'g'), 1, 200) AS name FROM b",
)
def _(spark, d):
    return pages(spark, d).select("page_id", U.safe_name(C("url")).alias("name"))


@query("u5_home_domain", f"SELECT page_id, {HOME_SQL} AS is_home FROM pages")
def _(spark, d):
    return pages(spark, d).select("page_id", U.is_home(C("url"), HOME).alias("is_home"))


@query("u6_archive_url", "SELECT page_id, starts_with(lower(u), 'https://web.archive.org') AS is_archive FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'https://WEB.archive.org/web/' || url ELSE url END AS u FROM pages)")
def _(spark, d):
    u = F.expr("CASE WHEN page_id % 3 = 0 THEN 'https://WEB.archive.org/web/' || url ELSE url END")
    return pages(spark, d).select("page_id", U.is_archive(u).alias("is_archive"))


@query("u7_denied", f"SELECT page_id, {DENIED_SQL} AS is_denied FROM pages")
def _(spark, d):
    return pages(spark, d).select("page_id", U.is_denied(C("url")).alias("is_denied"))


@query("u8_image_url", f"SELECT page_id, regexp_matches(url, '.jpe+g$|.gif$|.png$') AS is_image FROM (SELECT page_id, {VARIED} AS url FROM pages)")
def _(spark, d):
    return varied(spark, d).select("page_id", U.is_image(C("url")).alias("is_image"))


@query("u9_mail_url", f"SELECT page_id, starts_with(url, 'mailto:') AS is_mail FROM (SELECT page_id, {VARIED} AS url FROM pages)")
def _(spark, d):
    return varied(spark, d).select("page_id", U.is_mail(C("url")).alias("is_mail"))


@query("u10_comment_page", f"SELECT page_id, {COMMENT_SQL} AS is_comment FROM (SELECT page_id, {VARIED} AS url FROM pages)")
def _(spark, d):
    return varied(spark, d).select("page_id", U.is_comment_page(C("url")).alias("is_comment"))


@query(
    "u11_should_visit",
    f"WITH v AS (SELECT page_id, {VARIED} AS url FROM pages) SELECT page_id, url FROM v WHERE NOT ({DENIED_SQL} OR regexp_matches(url, '(?i)^https?://web\\.archive\\.org') "
    f"OR regexp_matches(url, '.jpe+g$|.gif$|.png$') OR starts_with(url, 'mailto:') OR {COMMENT_SQL}) AND url NOT IN (SELECT url FROM v WHERE page_id % 5 = 0)",
)
def _(spark, d):
    v = varied(spark, d)
    return v.where(U.may_visit(C("url"))).join(v.where("page_id % 5 = 0").select("url"), "url", "left_anti").select("page_id", "url")


@query("u12_should_expand", f"SELECT page_id, page_id % 4 < 2 AND {HOME_SQL} AS expand FROM pages")
def _(spark, d):
    return pages(spark, d).select("page_id", U.may_expand(C("page_id") % 4, U.is_home(C("url"), HOME), 2).alias("expand"))


@query("u13_strip_fragment", "SELECT page_id, regexp_replace(url, '#([\\p{L}\\p{N}_-]+)$', '') AS url FROM pages")
def _(spark, d):
    return pages(spark, d).select("page_id", U.without_fragment(C("url")).alias("url"))


LINKS_SQL = """WITH l AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*?href\\s*=\\s*"([^"]*)"', 1)) AS href,
 generate_subscripts(regexp_extract_all(html, '(?is)<a\\s[^>]*?href\\s*=\\s*"([^"]*)"', 1), 1) - 1 AS pos FROM pages)"""


@query("u14_links", LINKS_SQL + " SELECT page_id, CAST(pos AS INTEGER) AS pos, href, CASE WHEN starts_with(href, '/') THEN regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*') || href ELSE href END AS target FROM l")
def _(spark, d):
    return crawl.links(pages(spark, d))


#: A link graph over the pages: every page leads to two others.
EDGES = "SELECT page_id AS n, 'p' || page_id AS src, 'p' || ((page_id * k + 1) % (SELECT count(*) FROM pages)) AS dst FROM pages, (SELECT 3 AS k UNION ALL SELECT 7)"


@query(
    "u15_crawl",
    f"WITH RECURSIVE e AS ({EDGES}), r AS (SELECT 'p1' AS url, 0 AS depth UNION SELECT dst, depth + 1 FROM r JOIN e ON src = url WHERE depth < 4) SELECT url, CAST(min(depth) AS INTEGER) AS depth FROM r GROUP BY url",
)
def _(spark, d):
    p = pages(spark, d).select("page_id")
    n = p.count()
    edges = p.select(F.concat(F.lit("p"), "page_id").alias("src"), F.explode(F.array(*[(C("page_id") * k + 1) % n for k in (3, 7)])).alias("t")).select("src", F.concat(F.lit("p"), "t").alias("dst"))
    return crawl.crawl(spark.createDataFrame([("p1",)], "url string"), edges, max_depth=4).select("url", C("depth_actual").alias("depth"))


@query("u17_max_pages", "SELECT page_id, url FROM (SELECT page_id, url, row_number() OVER (ORDER BY page_id % 4, url, page_id) AS r FROM pages) WHERE r <= 20")
def _(spark, d):
    return pages(spark, d).orderBy(C("page_id") % 4, "url", "page_id").limit(20).select("page_id", "url")


@query("u19_classify", f"SELECT page_id, {HOME_SQL} AS is_home, {DENIED_SQL} AS is_denied FROM pages")
def _(spark, d):
    return pages(spark, d).select("page_id", U.is_home(C("url"), HOME).alias("is_home"), U.is_denied(C("url")).alias("is_denied"))


@query("u20_default_scheme", f"SELECT page_id, 'http://' || {CLEAN} AS url FROM pages")
def _(spark, d):
    return pages(spark, d).select("page_id", U.with_scheme(U.clean(C("url"))).alias("url"))


TXT = "'<a href=\"/f' || (page_id % 7) || '.txt\">Download</a><a href=\"/g' || (page_id % 3) || '\"> download </a>' || html"


@query(
    "u21_candidate_links",
    f"WITH l AS (SELECT page_id, generate_subscripts(m, 1) AS pos, unnest(m) AS u FROM (SELECT page_id, regexp_extract_all({TXT}, '(?is)<a\\s[^>]*?href\\s*=\\s*\"([^\"]*)\"', 1) AS m FROM pages)), "
    "k AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY page_id, pos) AS r FROM l WHERE ends_with(lower(u), '.txt')) SELECT u AS url, page_id FROM k WHERE r = 1",
)
def _(spark, d):
    return crawl.candidate_links(pages(spark, d).select("page_id", F.expr(TXT).alias("html"))).select("url", "page_id")


@query(
    "u22_slug",
    "SELECT doc_id, coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(lower(text), '[^a-z0-9-]+', '-', 'g'), '^-+|-+$', '', 'g'), '-{2,}', '-', 'g'), ''), 'post') AS slug FROM documents",
)
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", U.slug(C("text")).alias("slug"))


@query("u23_html_file", "SELECT page_id, regexp_matches(lower(url), '\\.html?$') AS is_html FROM pages")
def _(spark, d):
    return pages(spark, d).select("page_id", U.is_html_file(C("url")).alias("is_html"))


@query("u24_prefix_url", "SELECT page_id, 'https://articles.example/a-' || page_id AS url FROM pages")
def _(spark, d):
    return pages(spark, d).select("page_id", F.concat(F.lit("https://articles.example/a-"), C("page_id").cast("string")).alias("url"))


KIND_CASE = "CASE page_id % 11 WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'text/html; charset=utf-8' WHEN 2 THEN 'application/xhtml+xml' WHEN 3 THEN 'text/css' WHEN 4 THEN 'application/javascript' WHEN 5 THEN 'image/jpeg' WHEN 6 THEN 'image/png' WHEN 7 THEN 'image/gif' WHEN 8 THEN 'application/vnd.ms-powerpoint' WHEN 9 THEN 'application/xml' ELSE 'text/plain' END"


@query(
    "s9_content_kind",
    f"SELECT page_id, CASE WHEN contains(t, 'pdf') THEN 'pdf' WHEN contains(t, 'html') THEN 'html' WHEN contains(t, 'xml') THEN 'xml' WHEN contains(t, 'css') THEN 'css' WHEN contains(t, 'javascript') THEN 'js' WHEN contains(t, 'jpeg') THEN 'jpeg' "
    f"WHEN contains(t, 'png') THEN 'png' WHEN contains(t, 'gif') THEN 'gif' WHEN contains(t, 'powerpoint') THEN 'ppt' ELSE 'unknown' END AS kind FROM (SELECT page_id, {KIND_CASE} AS t FROM pages)",
)
def _(spark, d):
    return pages(spark, d).select("page_id", U.content_kind(F.expr(KIND_CASE)).alias("kind"))


HASH_SQL = "sha256(translate(regexp_replace(text, '^[ \\t\\n\\r\\x0b\\f]+|[ \\t\\n\\r\\x0b\\f]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))"


@query("d1_content_hash", f"SELECT doc_id, {HASH_SQL} AS hash FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", dedup.content_hash(C("text")).alias("hash"))


@query("d2_seen_content", f"SELECT {HASH_SQL} AS hash, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1")
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", dedup.content_hash(C("text")).alias("hash"))
    return dedup.keep_first(docs, ["hash"], "doc_id")


@query("d4_visited", "SELECT DISTINCT url FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0)")
def _(spark, d):
    p = pages(spark, d)
    return dedup.not_visited(p.select("url"), p.where("page_id % 3 = 0").select("url"))


@query("d5_first_by_title", "SELECT title, min(doc_id) AS doc_id, count(*) AS copies FROM (SELECT doc_id, split_part(text, chr(10), 1) AS title FROM documents) GROUP BY title")
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"))
    return dedup.keep_first(docs, ["title"], "doc_id")


@query("d6_file_digest", "SELECT page_id, sha256(html) AS sha256, strlen(html) AS bytes FROM pages")
def _(spark, d):
    return pages(spark, d).select("page_id", F.sha2("html", 256).alias("sha256"), F.octet_length("html").cast("long").alias("bytes"))


@query("d7_unique_ids", "SELECT conv_id, list_sort(list_distinct(list(strlen(text)))) AS ids FROM conversations GROUP BY conv_id")
def _(spark, d):
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_set(F.octet_length("text").cast("long"))).alias("ids"))


@query("l7_pending_queue", "SELECT url, depth_actual, depth_effective FROM (SELECT 'u' || user_id AS url, CAST(event_id % 5 AS INTEGER) AS depth_actual, CAST(event_id % 3 AS INTEGER) AS depth_effective, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events) WHERE r = 1 AND url NOT IN (SELECT 'u' || user_id FROM events WHERE event_type = 'signup' AND event_id % 50 = 0)")
def _(spark, d):
    e = table(spark, d, "events")
    rows = e.select(F.concat(F.lit("u"), "user_id").alias("url"), (C("event_id") % 5).cast("int").alias("depth_actual"), (C("event_id") % 3).cast("int").alias("depth_effective"), C("event_id").alias("no"))
    return crawl.pending(rows, "no", e.where("event_type = 'signup' AND event_id % 50 = 0").select(F.concat(F.lit("u"), "user_id").alias("url")))


@query("d2_first_row_per_hash", f"SELECT doc_id, lang, source FROM (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY {HASH_SQL} ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", dedup.content_hash(C("text")).alias("hash"))
    return docs.join(dedup.keep_first(docs, ["hash"], "doc_id").select("doc_id"), "doc_id", "left_semi").select("doc_id", "lang", "source")


@query("u21_rank_links", LINKS_SQL + " SELECT href, count(*) AS n, count(DISTINCT page_id) AS pages FROM l GROUP BY href")
def _(spark, d):
    return crawl.links(pages(spark, d)).groupBy("href").agg(F.count("*").alias("n"), F.count_distinct("page_id").alias("pages"))
