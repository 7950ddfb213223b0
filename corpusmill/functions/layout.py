"""PDF layout to text over a nested page struct: width, height and blocks of lines of spans.

Pages are flattened to one row for each block; headers, footers and fonts are aggregates joined back,
and paragraphs are an ordered fold over an array of lines. A PDF parser isn't part of this library.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import one_space, rstrip, strip

PAGE_SCHEMA = "doc_id bigint, page_no int, width double, height double, blocks array<struct<type:int,bbox:array<double>,lines:array<struct<spans:array<struct<text:string,size:double>>>>>>"
BULLET = r"^(\s*[\-•*]|\s*\d+[\.\)])\s"
LEARN_PAGES = 5


def spans(lines: Column) -> Column:
    return F.flatten(F.transform(lines, lambda ln: ln["spans"]))


def inline_text(lines: Column) -> Column:
    """All spans with their white space folded, apart by a space."""
    return F.array_join(F.transform(spans(lines), lambda s: strip(one_space(F.coalesce(s["text"], F.lit(""))))), " ")


def sizes(lines: Column) -> Column:
    return F.filter(F.transform(spans(lines), lambda s: s["size"]), lambda x: x.isNotNull() & (x != 0))


def block_lines(lines: Column) -> Column:
    return F.transform(lines, lambda ln: F.array_join(F.transform(ln["spans"], lambda s: F.coalesce(s["text"], F.lit(""))), ""))


def flatten_pages(pages: DataFrame) -> DataFrame:
    """One row for each block, text blocks and others."""
    rows = pages.select("doc_id", "page_no", "width", "height", F.posexplode("blocks").alias("block_no", "b"))
    font = sizes(F.col("b.lines"))
    mean = F.when(F.size(font) > 0, F.aggregate(font, F.lit(0.0), lambda a, x: a + x) / F.size(font)).otherwise(0.0)
    corner = lambda k: F.element_at("b.bbox", k + 1)
    return rows.select(
        "doc_id", "page_no", "width", "height", "block_no", F.col("b.type").alias("type"), corner(0).alias("x0"), corner(1).alias("y0"), corner(2).alias("x1"), corner(3).alias("y1"),
        strip(inline_text(F.col("b.lines"))).alias("text"), font.alias("sizes"), mean.alias("font"), block_lines(F.col("b.lines")).alias("lines"),
    )


def is_page_number(text: Column, x0, y0, x1, y1, width, height) -> Column:
    """One to four digits near the top or bottom edge, about centred."""
    x, y = (x0 + x1) / 2, (y0 + y1) / 2
    return text.rlike(r"^\d{1,4}$") & (F.abs(x - width / 2) < width * 0.2) & ((y < height * 0.08) | (y > height * 0.92))


def running_texts(blocks: DataFrame, band: float = 0.10) -> DataFrame:
    """(doc_id, text) repeated in the top or bottom band of the first pages."""
    pages = blocks.groupBy("doc_id").agg(F.least(F.lit(LEARN_PAGES), F.count_distinct("page_no")).alias("n"), F.min("page_no").alias("first"))
    early = blocks.join(pages, "doc_id").where((F.col("page_no") < F.col("first") + F.col("n")) & (F.col("text") != ""))
    where = F.array_compact(F.array(F.when(F.col("y0") < F.col("height") * band, "top"), F.when(F.col("y0") > F.col("height") * (1 - band), "bottom")))
    counts = early.select("doc_id", "text", "n", F.explode(where).alias("band")).groupBy("doc_id", "text", "band", "n").agg(F.count("*").alias("times"))
    return counts.where(F.col("times") >= F.greatest(F.lit(2), F.floor(F.col("n") / 2))).select("doc_id", "text").distinct()


def page_fonts(blocks: DataFrame) -> DataFrame:
    """(doc_id, page_no, median): the median font size, 10 where a page has none."""
    rows = blocks.select("doc_id", "page_no", F.explode_outer("sizes").alias("s"))
    return rows.groupBy("doc_id", "page_no").agg(F.coalesce(F.median("s"), F.lit(10.0)).alias("median"))


def clean_blocks(blocks: DataFrame) -> DataFrame:
    """Text blocks without page numbers, running headers and footers, and footnotes."""
    number = is_page_number(F.col("text"), *[F.col(c) for c in ("x0", "y0", "x1", "y1", "width", "height")])
    small = (F.col("font") > 0) & (F.col("font") < 0.8 * F.col("median"))
    note = (F.col("y0") > 0.85 * F.col("height")) & (small | F.col("text").rlike(r"^(\d+|[*†‡])\s"))
    rows = blocks.where((F.coalesce("type", F.lit(0)) == 0) & (F.col("text") != "")).join(page_fonts(blocks), ["doc_id", "page_no"])
    return rows.where(~number & ~note).join(running_texts(blocks), ["doc_id", "text"], "left_anti")


def reflow(lines: Column) -> Column:
    """Paragraphs of an array of lines: hyphens joined, bullets and blank lines start anew."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("buf"))
    done = lambda s: F.when(s["buf"] != "", F.concat(s["out"], F.array(strip(s["buf"])))).otherwise(s["out"])

    def step(s: Column, raw: Column) -> Column:
        line = rstrip(raw)
        lead = F.regexp_replace(line, r"(?U)^\s+", "")
        head = F.substr(s["buf"], F.lit(1), F.length(s["buf"]) - 1)
        hyphen = F.when(line.rlike(r"^\p{Ll}"), F.concat(head, lead)).otherwise(F.concat(head, F.lit("-"), lead))
        new = F.struct(done(s).alias("out"), strip(line).alias("buf"))
        return (
            F.when(line == "", F.struct(done(s).alias("out"), F.lit("").alias("buf")))
            .when(s["buf"] == "", F.struct(s["out"].alias("out"), strip(line).alias("buf")))
            .when(F.endswith(s["buf"], F.lit("-")), F.struct(s["out"].alias("out"), hyphen.alias("buf")))
            .when(line.rlike(BULLET), new)
            .otherwise(F.struct(s["out"].alias("out"), F.concat(s["buf"], F.lit(" "), strip(line)).alias("buf")))
        )

    return F.array_join(F.transform(F.aggregate(lines, start, step, done), lambda p: strip(one_space(p))), "\n\n")


def clean_text(pages: DataFrame) -> DataFrame:
    """(doc_id, text): cleaned blocks in reading order, page by page, reflowed."""
    place = F.struct("page_no", F.round("y0", 1).alias("y"), F.round("x0", 1).alias("x"), "block_no", F.concat("lines", F.array(F.lit(""))).alias("lines"))
    kept = clean_blocks(flatten_pages(pages)).groupBy("doc_id").agg(F.array_sort(F.collect_list(place)).alias("p"))
    return kept.select("doc_id", reflow(F.flatten(F.transform("p", lambda p: p["lines"]))).alias("text"))
