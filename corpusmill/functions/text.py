"""Text cleaning, stop handling and transcript sections as Column builders."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns of boilerplate lines, tested against the stripped line.
BOILERPLATE = (r"^if you wish[,:\- ]", r"^if you want more detail", r"^related articles\b", r"\bclick here\b", r"\bwatch (an?|the)?\s*video on youtube\b", r"^note:\b", r"\|$")
# Publication names replaced wherever they stand, in this order.
NAME_CHAIN = (
    ("Seattle times", "Seattle Times"), ("Scientific American Blog", "Scientific American"), ("The Sacramento Bee", "Sacramento Bee"), ("Mother Jones Magazine", "Mother Jones"),
    ("Sydney Mountain Herald", "Sydney Morning Herald"), ("The Nation magazine", "The Nation"), ("Chicago Sun-Times News Group", "Chicago Sun-Times"), ("Wired magazine", "Wired"),
    ("The New Yorker magazine", "The New Yorker"), ("Fortune magazine", "Fortune"), ("The Atlantic Monthly", "The Atlantic"), ("Tikkun Magazine - March", "Tikkun Magazine"),
    ("The Daily Mail", "Daily Mail"), ("U.S. Right to Know", "US Right to Know"), ("Wired Magazine", "Wired"), ("Minneapolis Star-Tribune", "Star Tribune"),
    ("CNBC News", "CNBC"), ("Minneapolis Star Tribune", "Star Tribune"), ("The New Yorker", "New Yorker"),
)
# Fixed value: dates are ISO, "Mon D, YYYY" or M/D/YY[YY], whichever comes first.
DATE = r"\b(\d{4}-\d{2}-\d{2}|(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec)[a-z]*\.?\s+\d{1,2},\s+\d{4}|\d{1,2}/\d{1,2}/\d{2,4})\b"
# The line patterns of a transcript.
TITLE_LINE = r"(?imd)^\*{6}\s*(.*?)\s*\*{6}\s*$"
OVERVIEW = r"(?imsd)^%{6}\s*PROJECT OVERVIEW\s*%{6}\s*$(.*?)^%{6}\s*END PROJECT OVERVIEW\s*%{6}\s*$"
BEGIN_SESSIONS = r"(?imd)^=+\s*BEGIN SESSIONS\s*=+\s*$"
SESSION_HEADER = r"(?imd)^=+[^\S\n]*(\S[^\n]*?)\s+SESSION\s*$"
END_PROJECT = r"(?imd)^&{6}\s*END OF .*?\*{6}\s*$"
MARKER_LINE = r"(?i)^\*{6}\s*.*?\s*\*{6}\s*$|^%{6}\s*PROJECT OVERVIEW\s*%{6}\s*$|^=+\s*BEGIN SESSIONS\s*=+\s*$|^&{6}\s*END OF .*?\*{6}\s*$"
MAX_TARGETS = 30


def strip(x: Column) -> Column:
    """Unicode white space off both ends."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def rstrip(x: Column) -> Column:
    return F.regexp_replace(x, r"(?U)\s+$", "")


def one_space(x: Column) -> Column:
    return F.regexp_replace(x, r"(?U)\s+", " ")


def max_two_newlines(x: Column) -> Column:
    return F.regexp_replace(x, r"\n{3,}", "\n\n")


def lines(x: Column) -> Column:
    return F.split(x, r"\r\n|\r|\n")


def drop_boilerplate(x: Column) -> Column:
    """Lines without boilerplate; blanks collapsed, at most one empty line, stripped."""
    kept = F.filter(lines(x), lambda ln: ~strip(ln).rlike("(?i)" + "|".join(BOILERPLATE)))
    return strip(max_two_newlines(F.regexp_replace(F.array_join(kept, "\n"), "[ \\t\\xa0]+", " ")))


def note_on_new_line(x: Column) -> Column:
    return F.regexp_replace(x, r"(?i)(?<=[^\n])Note:", "\nNote:")


def replace_chain(x: Column, chain: Sequence[tuple[str, str]] = NAME_CHAIN) -> Column:
    for old, new in chain:
        x = F.replace(x, F.lit(old), F.lit(new))
    return x


def strip_publication(x: Column) -> Column:
    """Markup and quotes off a publication's name; what follows the first / or ( goes."""
    for mark in ("<i>", "</i>", "<em>", "<", ">"):
        x = F.replace(x, F.lit(mark), F.lit(""))
    x = F.trim(F.substring_index(F.substring_index(x, "/", 1), "(", 1))
    return F.replace(F.regexp_replace(x, '^"+|"+$', ""), F.lit("'"), F.lit(""))


def first_date(x: Column) -> Column:
    return F.regexp_extract(x, DATE, 1)


def title_line(raw: Column) -> Column:
    return strip(F.regexp_extract(raw, TITLE_LINE, 1))


def targets(raw: Column) -> Column:
    """Lines under the title up to a blank line or a marker; rules of dashes are passed over."""
    tail = F.regexp_extract(raw, r"(?imsd)^\*{6}\s*[^\n]*?\s*\*{6}[^\S\n]*\n(.*)", 1)
    body = F.transform(lines(F.regexp_replace(tail, r"(?U)^\s+", "")), strip)
    stop = F.array_min(F.filter(F.transform(body, lambda ln, k: F.when((ln == "") | ln.rlike(MARKER_LINE), k)), lambda k: k.isNotNull()))
    kept = F.filter(F.slice(body, F.lit(1), F.coalesce(stop, F.size(body))), lambda ln: ~ln.rlike(r"^[-=*_/\\]{3,}$"))
    return F.array_join(F.slice(kept, 1, MAX_TARGETS), "\n")


def overview(raw: Column) -> Column:
    return strip(max_two_newlines(F.regexp_extract(raw, OVERVIEW, 1)))


def sessions(raw: Column) -> Column:
    """array<struct<viewer, body>>: the region between the session markers, cut at its headers."""
    mark = "\x00"
    region = F.coalesce(F.nullif(F.regexp_extract(raw, BEGIN_SESSIONS + r"(?s)(.*)", 1), F.lit("")), raw)
    region = F.element_at(F.split(region, END_PROJECT, 2), 1)
    parts = F.split(F.regexp_replace(region, SESSION_HEADER, mark + "$1" + "\x01"), mark)
    tidy = lambda b: max_two_newlines(F.regexp_replace(strip(b), r"(?md)^=+\s*$", ""))
    headed = F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda p: F.struct(strip(F.split_part(p, F.lit("\x01"), F.lit(1))).alias("viewer"), tidy(F.split_part(p, F.lit("\x01"), F.lit(2))).alias("body")))
    alone = F.array(F.struct(F.lit("").alias("viewer"), strip(region).alias("body")))
    return F.when(F.size(parts) > 1, headed).when(strip(region) != "", alone).otherwise(F.filter(alone, lambda s: F.lit(False)))


def session_text(parts: Column) -> Column:
    label = lambda s: F.when(s["viewer"] != "", F.concat(F.lit("Session ("), s["viewer"], F.lit("):"))).otherwise(F.lit("Session:"))
    return strip(F.array_join(F.transform(parts, lambda s: F.concat(label(s), F.lit("\n"), strip(s["body"]))), "\n\n"))


def compose(raw: Column) -> Column:
    """Targets, overview and sessions with their labels, empty ones left out."""
    part = lambda label, x: F.when(x != "", F.concat(F.lit(label), x))
    return F.concat_ws("\n\n", part("Targets:\n", targets(raw)), part("Overview:\n", overview(raw)), F.nullif(session_text(sessions(raw)), F.lit("")))


def cut_at_stops(x: Column, stops: Sequence[str]) -> Column:
    """The text before the first occurrence of each stop in turn."""
    for stop in stops:
        x = F.substring_index(x, stop, 1)
    return x


def cut_at_literal_stops(x: Column, stops: Sequence[str]) -> Column:
    """The text before the first stop, with the white space and quotes around it."""
    if not stops:
        return x
    pattern = r"(?:\s|[\"'])*(?:" + "|".join(re.sub(r"([^\w\s])", r"\\\1", s) for s in stops) + r")(?:\s|[\"'])*"
    return rstrip(F.element_at(F.split(x, pattern, 2), 1))


def strip_prompt(prompt: Column, answer: Column) -> Column:
    rest = F.substr(answer, F.length(prompt) + 1)
    return F.when(F.startswith(answer, prompt), F.regexp_replace(rest, r"(?U)^\s+", "")).otherwise(answer)


def ends_with_stop(x: Column, stops: Sequence[str]) -> Column:
    """Whether the tail is a stop, bare or with a space or quotes around it."""
    forms = [f for s in stops if s for f in (s, " " + s, s + " ", f'"{s}"', f" '{s}'", s + '"', s + "'", f' "{s}" ')]
    out = F.lit(False)
    for f in forms:
        out = out | F.endswith(x, F.lit(f))
    return out


def clamp_to_sentences(x: Column, max_skip: int = 220, least: int = 60) -> Column:
    """Head and tail moved to sentence bounds, if those are near; short results fall back to the text."""
    whole = strip(x)
    closing = "[)\"'’»\\]\\)]*"
    head_end = F.regexp_instr(whole, F.lit("[.!?…]" + closing + r"\s+"))
    from_head = strip(F.regexp_replace(whole, r"(?s)^.*?[.!?…]" + closing + r"\s+", ""))
    head = F.when(whole.rlike("^[A-Z0-9“\"(\\[]") | (head_end == 0) | (head_end - 1 >= max_skip), whole).otherwise(from_head)
    upto = F.regexp_extract(head, "(?s)^(.*[.!?…]" + closing + ")", 1)
    tail = F.when(head.rlike("[.!?…]" + closing + r"\s*$") | (upto == "") | (F.length(head) - F.length(upto) >= max_skip), head).otherwise(rstrip(upto))
    return F.when(F.coalesce(x, F.lit("")) == "", F.lit("")).when(F.length(tail) < least, whole).otherwise(tail)
