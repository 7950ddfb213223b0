"""Every query of the library's own operators against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest
from compare import same
from pyspark.sql import functions as F

from corpusmill.functions import markup
from corpusmill.operators import registry
from corpusmill.operators import vectors as V


@pytest.mark.parametrize("name", [n for n in registry.queries() if n in registry.oracle_sql()])
def test_query_equals_sql(spark, small, name):
    same(registry.queries()[name](spark, small), registry.oracle_sql()[name], small)


def test_parsed_text_equals_sql_on_open_references(spark, tmp_path):
    pages = ["<p>a &amp</p><p>b&amp;&amp</p>", "<h1>&quot</h1>&lt x &copy y", "<p>&amp;amp &amp;lt; &a &am</p>&", "&eacute;&#60;&#39;&unknown; &#x41;", "<p>\xa0&nbsp;c &lt;i&gt; &quot;d&apos;</p>", None, ""]
    spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    same(registry.queries()["h1_parsed_text"](spark, str(tmp_path)), registry.oracle_sql()["h1_parsed_text"], str(tmp_path))
    assert markup.text_of("<p>a &amp</p>&eacute;&#60;") == "a & é<"


def exact_units(spark, tmp_path, name, vectors):
    """The query's rows and its SQL's, as text, so that signs of zeros count."""
    import duckdb

    path = str(tmp_path / "embeddings.parquet")
    spark.createDataFrame([(k, v, k % 2) for k, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{path}/*.parquet')")
    want = con.sql(registry.oracle_sql()[name])
    rows = registry.queries()[name](spark, str(tmp_path)).select(*want.columns).collect()
    return sorted(str(tuple(r)) for r in rows), sorted(map(str, want.fetchall()))


UNITS = [[1.0, -1e-7, 0.0], [-1e-7, 1.0, -0.0], [0.6, -0.8], [-2e-6, 3.0], [1e30, -1.0], [0.125, -0.992156], []]


@pytest.mark.parametrize("name", ["v19_epsilon_normalise", "v2_normalise"])
def test_units_equal_sql_to_the_sign(spark, tmp_path, name):
    got, want = exact_units(spark, tmp_path, name, [*UNITS, None, [0.0, -0.0]])
    assert got == want and any("-0.0" in r for r in want)


def test_rounded_equals_sql(spark):
    import duckdb

    xs = [0.0, -0.0, 1.005, -1.005, 2.675, 0.285, 1e-9, -1e-9, 0.005, -0.005, 1e306, -1e306, 123456.785, float("inf"), float("-inf")]
    got = [r[0] for r in spark.createDataFrame(list(enumerate(xs)), "k int, x double").orderBy("k").select(V.rounded(F.col("x"), 2)).collect()]
    assert list(map(repr, got)) == [repr(duckdb.execute("SELECT round(CAST(? AS DOUBLE), 2)", [x]).fetchone()[0]) for x in xs]


@pytest.mark.parametrize("name", [n for n in registry.queries() if n not in registry.oracle_sql()])
def test_query_without_sql_runs(spark, small, name):
    assert registry.queries()[name](spark, small).count() > 0
