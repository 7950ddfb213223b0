"""URL allow and block rules as a sort-merge range join over reversed-host keys.

A rule ``(host, path, verdict)`` fits a url whose host is the rule's host or a
subdomain of it and whose path starts with the rule's path. Reversing a host's
labels (``www.example.com`` -> ``com.example.www.``) turns "is a subdomain" into
a key prefix, so every rule is an interval of host keys and, inside it, an
interval of paths. Both families are laminar: two intervals are nested or
disjoint. A sorted sweep with a stack of the active rules flattens them once into
elementary segments; the urls are then merged with the segment starts in key
order and take the last segment at or before them.

Everything on the url side is DataFrame work. Rows are dealt to the sorted sweeps
by a hash of the row, not by host, so a host with a third of all rows is spread
evenly; the segments go along with each share. Their number is bounded by the
number of rules (a parameter of the plan, at most ``MAX_RULES``).

Defined results: a null url, or one without ``://``, has an empty host and path
and takes the default verdict with a null rule. Of several fitting rules the one
with the longest ``host + path`` wins; ties go to the longer host. Repeated rows
are kept, empty tables give empty results, and other columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Rule = tuple[str, str, str]
MAX_RULES = 100_000
#: Segments that are written into the plan; more are a table of their own.
MAX_LITERALS = 500


def host_key(host: str) -> str:
    return ".".join(reversed(host.split("."))) + "."


def _after(prefix: str) -> str:
    """The first string that sorts behind every string that starts with ``prefix``."""
    return prefix[:-1] + chr(ord(prefix[-1]) + 1)


def _sweep(spans: list[tuple[str, int]]) -> list[tuple[str, tuple[int, ...]]]:
    """Segment starts in order, each with the rules active from there on.

    ``spans`` holds (prefix, rule number); the stack keeps the nested prefixes.
    """
    stack: list[str] = []
    members: dict[str, list[int]] = {}
    for prefix, rule in spans:
        members.setdefault(prefix, []).append(rule)
    active = lambda: tuple(r for p in stack for r in members[p])
    out: dict[str, tuple[int, ...]] = {"": ()}
    for prefix in sorted(members):
        while stack and not prefix.startswith(stack[-1]):
            closed = stack.pop()
            if closed:
                out[_after(closed)] = active()
        stack.append(prefix)
        out[prefix] = active()
    while stack:
        closed = stack.pop()
        if closed:
            out[_after(closed)] = active()
    return sorted(out.items())


def segments(rules: Sequence[Rule]) -> list[tuple[str, str, str | None, str | None]]:
    """(host key from, path from, winning rule, its verdict), sorted; None where no rule fits."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    rows: list[tuple[str, str, str | None, str | None]] = []
    for host_from, hosts in _sweep([(host_key(h), n) for n, (h, _, _) in enumerate(rules)]):
        for path_from, fits in _sweep([(rules[n][1], n) for n in hosts]):
            best = max(fits, key=lambda n: (len(rules[n][0] + rules[n][1]), len(rules[n][0])), default=None)
            rows.append((host_from, path_from, None, None) if best is None else (host_from, path_from, rules[best][0] + rules[best][1], rules[best][2]))
    return rows


def url_host(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(urls: DataFrame, rules: Sequence[Rule], url: str = "url", default: str = "allow", shares: int | None = None) -> DataFrame:
    """``urls`` with host, path, rule and verdict; columns of those names are replaced."""
    spark = urls.sparkSession
    shares = shares or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    host, path = url_host(F.col(f"`{url}`")), url_path(F.col(f"`{url}`"))
    left = urls.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("__row"), host.alias("__host"), path.alias("__path")).select(
        F.pmod(F.xxhash64("__row"), F.lit(shares)).cast("int").alias("__share"), "__row", "__host", "__path",
        F.concat(F.array_join(F.reverse(F.split("__host", r"\.")), "."), F.lit(".")).alias("__hkey"), F.lit(1).alias("__is_url"),
        F.lit(None).cast("string").alias("__seg_host"), F.lit(None).cast("struct<rule:string,verdict:string>").alias("__seg"),
    )
    rows = segments(rules)
    text = lambda x: F.lit(x).cast("string")
    if len(rows) <= MAX_LITERALS:
        literal = F.array(*[F.struct(text(h).alias("h"), text(p).alias("p"), F.struct(text(r).alias("rule"), text(v).alias("verdict")).alias("seg")) for h, p, r, v in rows])
        dealt = spark.range(shares).select(F.col("id").cast("int").alias("__share"), F.explode(literal).alias("s"))
    else:
        table = spark.createDataFrame([((h, p, (r, v)),) for h, p, r, v in rows], "s struct<h:string,p:string,seg:struct<rule:string,verdict:string>>")
        dealt = table.select(F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("__share"), "s")
    right = dealt.select(
        "__share", F.lit(None).cast(left.schema["__row"].dataType).alias("__row"), F.lit(None).cast("string").alias("__host"), F.col("s.p").alias("__path"),
        F.col("s.h").alias("__hkey"), F.lit(0).alias("__is_url"), F.col("s.h").alias("__seg_host"), F.col("s.seg").alias("__seg"),
    )
    by_host = Window.partitionBy("__share").orderBy("__hkey", "__is_url").rowsBetween(Window.unboundedPreceding, 0)
    by_path = Window.partitionBy("__share", "__from").orderBy("__path", "__is_url").rowsBetween(Window.unboundedPreceding, 0)
    swept = left.unionByName(right).withColumn("__from", F.last("__seg_host", ignorenulls=True).over(by_host)).withColumn("__seg", F.last("__seg", ignorenulls=True).over(by_path))
    return swept.where("__is_url = 1").select(
        "__row.*", F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__seg.rule").alias("rule"), F.coalesce("__seg.verdict", F.lit(default)).alias("verdict"),
    )


#: Rules of the registered query, in the order given by its contract.
QUERY_RULES: list[Rule] = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op4_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, QUERY_RULES).select("page_id", "host", "path", "rule", "verdict")


_FITS = "(host = '{h}' OR suffix(host, '.{h}')) AND starts_with(path, '{p}')"
ORACLE_SQL = f"""
WITH a AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM a),
c AS (SELECT page_id, translate(raw, '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM b),
d AS (SELECT *, CASE {' '.join(f"WHEN {_FITS.format(h=h, p=p)} THEN '{h}{p}'" for h, p, _ in sorted(QUERY_RULES, key=lambda r: -len(r[0] + r[1])))} END AS rule FROM c)
SELECT page_id, host, path, rule, CASE {' '.join(f"WHEN rule = '{h}{p}' THEN '{v}'" for h, p, v in QUERY_RULES)} ELSE 'allow' END AS verdict FROM d
"""
