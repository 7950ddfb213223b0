"""URL predicates and projections as Column builders; everything stays in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The deny list's alternatives, in order.
DENIED = (
    r"^java?script:", r"^mailto:", r"amazon\.com", r"youtube\.com", r"youtu\.be", r"instagram\.com", r"facebook\.com", r"tiktok\.com",
    r"twitter\.com", r"x\.com", r"linkedin\.com", r"reddit\.com", r"pinterest\.com", r"snapchat\.com", r"nytimes\.com", r"washingtontimes\.com",
    r"cnn\.com", r"foxnews\.com", r"nbcnews\.com", r"abcnews\.go\.com", r"example\.com", r"example\.org", r"rumble\.com", r"redirect",
    r"sign-in", r"wa\.me", r"tel:\+", r"\.gov\b", r"\.mil\b",
)
# Content kinds in the order in which they are looked for.
KINDS = (("pdf", "pdf"), ("html", "html"), ("xml", "xml"), ("css", "css"), ("javascript", "js"), ("jpeg", "jpeg"), ("png", "png"), ("gif", "gif"), ("powerpoint", "ppt"))


def clean(url: Column) -> Column:
    """The schemes removed wherever they stand, then trailing slashes."""
    bare = F.replace(F.replace(url, F.lit("https://"), F.lit("")), F.lit("http://"), F.lit(""))
    return F.regexp_replace(bare, "/+$", "")


def file_name(url: Column, suffix: str) -> Column:
    return F.concat(F.translate(clean(url), "/", "_"), F.lit(suffix))


def archived_name(url: Column) -> Column:
    out = clean(url)
    for mark, name in (("?", "QQ"), ("=", "EQ"), ("&", "AMP")):
        out = F.replace(out, F.lit(mark), F.lit(name))
    return F.concat(F.lit("archived_"), out)


def safe_name(url: Column) -> Column:
    """The last path part without query and fragment, as a .txt name of safe characters."""
    base = F.regexp_extract(F.regexp_extract(url, "^[^?#]*", 0), "[^/]*$", 0)
    base = F.when(F.endswith(F.lower(base), F.lit(".txt")), base).otherwise(F.concat(base, F.lit(".txt")))
    return F.substring(F.regexp_replace(base, r"[^-\p{L}\p{N}_. ]", "_"), 1, 200)


def is_home(url: Column, domains: Sequence[str]) -> Column:
    """On one of the domains, with or without www; a port or query right behind the host fails."""
    names = "|".join(d.replace(".", r"\.") for d in domains)
    return url.rlike(f"(?i)^https?://(www\\.)?({names})(/|$)")


def is_archive(url: Column) -> Column:
    return url.rlike(r"(?i)^https?://web\.archive\.org")


def is_denied(url: Column, patterns: Sequence[str] = DENIED) -> Column:
    return url.rlike("(?i)" + "|".join(patterns))


def is_image(url: Column, fixed: bool = False) -> Column:
    """Image suffixes as they are tested for: any character before them, no .jpg unless ``fixed``."""
    return url.rlike(r"\.(jpe?g|gif|png)$" if fixed else ".jpe+g$|.gif$|.png$")


def is_mail(url: Column) -> Column:
    return F.startswith(url, F.lit("mailto:"))


def host(url: Column) -> Column:
    return F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def query_string(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def is_comment_page(url: Column, platform: str = "substack.com") -> Column:
    """A host of the platform and a query key with "comment" whose value isn't blank."""
    named = F.exists(F.split(query_string(url), "&"), lambda p: F.lower(F.split_part(p, F.lit("="), F.lit(1))).contains("comment") & p.rlike("=."))
    return F.endswith(F.lower(host(url)), F.lit(platform)) & named


def may_visit(url: Column) -> Column:
    """All tests of a link but whether it was visited, cheapest first."""
    return ~(is_denied(url) | is_archive(url) | is_image(url) | is_mail(url) | is_comment_page(url))


def may_expand(depth: Column, home: Column, max_depth: int) -> Column:
    return (depth < max_depth) & home


def without_fragment(url: Column) -> Column:
    return F.regexp_replace(url, r"#([\p{L}\p{N}_-]+)$", "")


def with_scheme(url: Column) -> Column:
    return F.when(F.startswith(url, F.lit("http://")) | F.startswith(url, F.lit("https://")), url).otherwise(F.concat(F.lit("http://"), url))


def resolve(base: Column, href: Column) -> Column:
    """Absolute form of a link; dot segments stay as they are."""
    origin = F.regexp_extract(base, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    page = F.regexp_extract(base, "^[^?#]*", 0)
    folder = F.when(page == origin, F.concat(origin, F.lit("/"))).otherwise(F.regexp_replace(page, "[^/]*$", ""))
    return (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(F.startswith(href, F.lit("//")), F.concat(F.regexp_extract(base, "^[A-Za-z][A-Za-z0-9+.-]*:", 0), href))
        .when(F.startswith(href, F.lit("/")), F.concat(origin, href))
        .when(href == "", base)
        .when(F.startswith(href, F.lit("?")), F.concat(page, href))
        .when(F.startswith(href, F.lit("#")), F.concat(F.regexp_extract(base, "^[^#]*", 0), href))
        .otherwise(F.concat(folder, href))
    )


def slug(text: Column) -> Column:
    out = F.regexp_replace(F.lower(text), "[^a-z0-9-]+", "-")
    out = F.regexp_replace(F.regexp_replace(out, "^-+|-+$", ""), "-{2,}", "-")
    return F.coalesce(F.nullif(out, F.lit("")), F.lit("post"))


def is_html_file(name: Column) -> Column:
    return F.lower(name).rlike(r"\.html?$")


def content_kind(content_type: Column) -> Column:
    """The first kind whose name the content type holds."""
    out = F.lit("unknown")
    for part, kind in reversed(KINDS):
        out = F.when(content_type.contains(part), F.lit(kind)).otherwise(out)
    return out
