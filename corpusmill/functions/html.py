"""HTML to text in the JVM: tag stripping, entities, headings, article bodies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.text import strip

# The entities that are resolved, the ampersand last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", "\xa0"), ("&copy;", "©"), ("&reg;", "®"), ("&middot;", "·"), ("&hellip;", "…"), ("&mdash;", "—"), ("&ndash;", "–"), ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&ldquo;", "“"), ("&rdquo;", "”"), ("&amp;", "&"))
HEADING = r"(?is)<(h[123])\b[^>]*>(.*?)</\1\s*>"


def unescape(x: Column) -> Column:
    for name, sign in ENTITIES:
        x = F.replace(x, F.lit(name), F.lit(sign))
    return x


def escape(x: Column) -> Column:
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        x = F.replace(x, F.lit(sign), F.lit(name))
    return x


def to_text(html: Column) -> Column:
    """Visible text: text nodes apart by a space, lines and double spaces folded to one space."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->|<![^>]*>", "")
    bare = unescape(F.regexp_replace(bare, r"(?s)<[^>]*>", " "))
    phrases = F.transform(F.split(bare, r"\r\n|\r|\n|  "), strip)
    return F.array_join(F.filter(phrases, lambda p: p != ""), " ")


def without_cdn_scripts(html: Column, source: str = "substackcdn") -> Column:
    """The body without scripts of the source; empty if there is no body."""
    body = F.regexp_extract(html, r"(?is)<body\b[^>]*>.*</body\s*>", 0)
    return F.regexp_replace(body, rf"(?is)<script\b[^>]*\bsrc\s*=\s*[\"'][^\"']*{source}[^>]*>.*?</script\s*>", "")


def title(html: Column) -> Column:
    return strip(unescape(F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1)))


def article(html: Column) -> Column:
    """An approximation of article extraction: the article element without navigation, advertising and footer."""
    body = F.coalesce(F.nullif(F.regexp_extract(html, r"(?is)<article\b[^>]*>(.*)</article\s*>", 1), F.lit("")), html)
    return to_text(F.regexp_replace(body, r"(?is)<(nav|footer|aside)\b[^>]*>.*?</\1\s*>|<div class=\"ad\">.*?</div>", " "))


def section_of(html: Column, at: Column) -> Column:
    """The nearest heading with text before a character place."""
    before = F.substring(html, F.lit(1), at)
    found = F.filter(F.transform(F.regexp_extract_all(before, F.lit(HEADING), 2), to_text), lambda h: h != "")
    return F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit(""))
