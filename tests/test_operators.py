"""Literal cases that the tables don't hold."""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import functions as F

from corpusmill.functions import binary, html, layout, markup, text, urls
from corpusmill.operators import chunk, crawl, dedup, search, state, tfidf, training, vectors
from corpusmill.sources import io
from corpusmill.streaming.queue import DownloadLog, unseen, window_counts


def values(spark, column, inputs, kind="string"):
    """The column expression over one-column rows named x."""
    df = spark.createDataFrame([(k, x) for k, x in enumerate(inputs)], f"k int, x {kind}").select("k", column.alias("y"))
    return [r["y"] for r in df.orderBy("k").collect()]


def test_urls(spark):
    x = F.col("x")
    assert values(spark, urls.clean(x), ["https://a.b/c//", "http://a?u=http://b/", None]) == ["a.b/c", "a?u=b", None]
    assert values(spark, urls.is_home(x, ["a.org"]), ["https://www.A.org/x", "http://a.org", "http://a.org:80/", "http://b.a.org/"]) == [True, True, False, False]
    assert values(spark, urls.is_image(x), ["a.jpeg", "a.jpg", "xgif", "a.PNG"]) == [True, False, True, False]
    assert values(spark, urls.is_image(x, fixed=True), ["a.jpg"]) == [True]
    assert values(spark, urls.is_denied(x), ["http://netflix.com/", "http://a.gov/", "http://a.gove/", "http://ok.net"]) == [True, True, False, False]
    assert values(spark, urls.is_comment_page(x), ["https://a.substack.com/p?commentId=1", "https://a.substack.com/p?comment=", "https://a.b/?comment=1"]) == [True, False, False]
    assert values(spark, urls.without_fragment(x), ["a#top", "a#", "a#a/b"]) == ["a", "a#", "a#a/b"]
    assert values(spark, urls.slug(x), ["Hello, World!", "--", "Été"]) == ["hello-world", "post", "t"]
    assert values(spark, urls.safe_name(x), ["http://a/b/c d?.q", "http://a/x.TXT#f", "http://a/"]) == ["c d.txt", "x.TXT", ".txt"]
    base = F.lit("http://h.x/a/b?q#f")
    assert values(spark, urls.resolve(base, x), ["/z", "c", "?r", "#g", "//o.y/p", "http://w/", ""]) == ["http://h.x/z", "http://h.x/a/c", "http://h.x/a/b?r", "http://h.x/a/b?q#g", "http://o.y/p", "http://w/", "http://h.x/a/b?q#f"]


def test_content_hash_is_of_bytes(spark):
    want = [hashlib.sha256(s.encode().strip().lower()).hexdigest() for s in (" ABC é É\n", "", "\x0bx\x0c")]
    assert values(spark, dedup.content_hash(F.col("x")), [" ABC é É\n", "", "\x0bx\x0c"]) == want


def test_text(spark):
    x = F.col("x")
    assert values(spark, text.one_space(x), ["a\xa0\n b"]) == ["a b"]
    assert values(spark, text.drop_boilerplate(x), ["a\nclick here\nNote: x\nNote:x\nend|\n\n\n\nb"]) == ["a\nNote: x\n\nb"]
    assert values(spark, text.note_on_new_line(x), ["a note: b", "Note: c\nNote: d"]) == ["a \nNote: b", "Note: c\nNote: d"]
    assert values(spark, text.replace_chain(x), ["The New Yorker magazine"]) == ["New Yorker"]
    assert values(spark, text.strip_publication(x), ['<i>"A\'s B"</i> (blog)/x']) == ["As B"]
    assert values(spark, text.first_date(x), ["on 2020-01-02 or 1/2/20", "Sept. 3, 2021", "3/4/21", "no"]) == ["2020-01-02", "Sept. 3, 2021", "3/4/21", ""]
    assert values(spark, text.cut_at_literal_stops(x, ["</s>", "<|e|>"]), ['yes "</s>" no', "all", "a<|e|>"]) == ["yes", "all", "a"]
    assert values(spark, text.ends_with_stop(x, ["END"]), ["x END", "x END ", "x END.", 'x "END"']) == [True, True, False, True]
    shown = values(spark, text.clamp_to_sentences(x), ["tail of one. " + "A whole sentence that is certainly long enough to be kept by itself. " + "and a cut", "short", None])
    assert shown == ["A whole sentence that is certainly long enough to be kept by itself.", "short", ""]


def test_transcripts(spark):
    raw = "x\n****** T ******\nOne\n---\nTwo\n\nno\n%%%%%% PROJECT OVERVIEW %%%%%%\na\n\n\n\nb\n%%%%%% END PROJECT OVERVIEW %%%%%%\n== BEGIN SESSIONS ==\n=== Ann SESSION\nhi\n=== Bob SESSION\nho\n&&&&&& END OF T ******\nz"
    df = spark.createDataFrame([(raw,)], "x string").select(text.title_line(F.col("x")).alias("t"), text.targets(F.col("x")).alias("g"), text.overview(F.col("x")).alias("o"), text.sessions(F.col("x")).alias("s"))
    r = df.first()
    assert (r["t"], r["g"], r["o"], [tuple(s) for s in r["s"]]) == ("T", "One\nTwo", "a\n\nb", [("Ann", "hi"), ("Bob", "ho")])
    many = "****** T ******\n" + "\n".join(f"l{k}" for k in range(40))
    assert values(spark, text.targets(F.col("x")), [many, ""])[0].count("\n") == 29


def test_chunk_bounds(spark):
    docs = spark.createDataFrame([(n, " ".join(map(str, range(n)))) for n in (0, 1, 400, 401, 750, 751)], "doc_id long, text string")
    got = {}
    for r in chunk.chunks(docs).collect():
        got.setdefault(r["doc_id"], []).append((r["start_word"], r["end_word"]))
    assert got == {1: [(0, 1)], 400: [(0, 400)], 401: [(0, 400), (1, 401)], 750: [(0, 400), (350, 750)], 751: [(0, 400), (350, 750), (351, 751)]}
    assert values(spark, chunk.ngrams(F.split("x", " "), 2), ["a b c", "a"]) == [["a b", "b c"], []]


def test_weights_by_hand(spark):
    docs = spark.createDataFrame([(1, "cat dog cat", "dog", ""), (2, "cat", None, None)], "doc_id long, chunk_text string, title string, section string")
    got = {(r["doc_id"], r["term"]): r["weight"] for r in tfidf.weights(docs).collect()}
    cat, dog = (1 + math.log(2)) * 1.0, (1 + math.log(3)) * (math.log(3 / 2) + 1)
    assert math.isclose(got[1, "cat"], cat / math.hypot(cat, dog)) and math.isclose(got[2, "cat"], 1.0)
    q = spark.createDataFrame([(7, "Dog zebra 99"), (8, "zebra")], "query_id long, text string")
    hits = search.lexical(q, tfidf.weights(docs), docs.agg(F.count("*").alias("n"))).collect()
    assert [(r["query_id"], r["doc_id"], r["rank"]) for r in hits] == [(7, 1, 1)]
    assert values(spark, tfidf.query_tokens(F.col("x")), ["Don't stop-it 42 a"]) == [["don't", "stop-it"]]


def test_crawl_resets_depth_at_home(spark):
    edges = spark.createDataFrame([("h0", "x1"), ("x1", "h1"), ("h1", "x2"), ("x2", "x3"), ("x3", "x4"), ("x1", "h0")], "src string, dst string")
    seen = crawl.crawl(spark.createDataFrame([("h0",)], "url string"), edges, 2, home=lambda u: F.startswith(u, F.lit("h")))
    assert sorted(tuple(r) for r in seen.collect()) == [("h0", 0, 0), ("h1", 2, 0), ("x1", 1, 1), ("x2", 3, 1), ("x3", 4, 2)]


def test_capped_clusters_end_on_equal_vectors(spark):
    rows = spark.createDataFrame([(k, [1.0, 0.0] if k < 30 else [0.0, float(k)]) for k in range(40)], "vec_id long, v array<double>")
    got = vectors.capped_clusters(rows, k=2, cap=10).groupBy("cluster_id").count().collect()
    assert sum(r["count"] for r in got) == 40 and max(r["count"] for r in got) <= 20


def groups_of(spark, rows, kind="array<double>", **options):
    """{cluster_id: sorted keys} of capped clusters; each key is in one cluster and ids follow size and least key."""
    got = [tuple(r) for r in vectors.capped_clusters(spark.createDataFrame(rows, f"vec_id long, v {kind}"), **options).collect()]
    assert sorted(k for k, _ in got) == sorted(k for k, _ in rows)
    groups = {c: sorted(k for k, d in got if d == c) for _, c in got}
    assert [c for c, _ in sorted(groups.items(), key=lambda g: (-len(g[1]), g[1][0]))] == list(range(1, len(groups) + 1))
    return groups


def test_capped_clusters_fit_once_whatever_their_number(spark, monkeypatch):
    from pyspark.ml.clustering import KMeans

    fits, fit = [], KMeans.fit
    monkeypatch.setattr(KMeans, "fit", lambda self, part: fits.append(1) or fit(self, part))
    rows = [(k, [float(k % 12), float(k % 12 // 3) * 40, (k * 37 % 101) / 1e4]) for k in range(240)]
    groups = groups_of(spark, rows, k=3, cap=10)
    assert len(fits) == 1 and max(map(len, groups.values())) <= 10


def test_capped_clusters_larger_than_a_task(spark, monkeypatch):
    monkeypatch.setattr(vectors, "TASK_VALUES", 120)
    rows = [(k, [100.0 * (k % 8), (k * 37 % 101) / 1e3]) for k in range(400)] + [(k, [-900.0, 0.0]) for k in range(400, 700)]
    groups = groups_of(spark, rows, k=2, cap=50)
    assert max(map(len, groups.values())) <= 50 and all(max(g) < 400 or min(g) >= 400 for g in groups.values())


def test_capped_clusters_keep_rows_without_a_vector(spark):
    rows = [(k, [1.0, float(k)]) for k in range(20)] + [(20, None), (21, [1.0]), (22, [float("nan"), 1.0]), (23, [None, 1.0]), (24, [float("inf"), 0.0])]
    groups = groups_of(spark, rows, k=2, cap=3)
    assert max(map(len, groups.values())) <= 3 and all(max(g) < 20 or min(g) >= 20 for g in groups.values())
    assert groups_of(spark, [(1, None), (2, None)], k=2, cap=1) == {1: [1], 2: [2]}


def test_state(spark):
    old = spark.createDataFrame([("a", "html", "1"), ("b", "pdf", "2")], "cleaned_url string, content_type string, hash string")
    new = spark.createDataFrame([("a", "xml", "3", 1), ("a", "css", "4", 2), ("c", "js", "5", 1)], "cleaned_url string, content_type string, hash string, at int")
    assert sorted(tuple(r) for r in state.upsert(old, new, "cleaned_url", "at").collect()) == [("a", "html", "4"), ("b", "pdf", "2"), ("c", "js", "5")]
    assert state.empty(spark, state.DOWNLOADS).count() == 0


def test_reflow_and_html(spark):
    lines = spark.createDataFrame([(["A line that is hy-", "phenated and", "Anti-", "American", "- bullet", "", " last  one "],)], "x array<string>")
    assert lines.select(layout.reflow(F.col("x"))).first()[0] == "A line that is hyphenated and Anti-American\n\n- bullet\n\nlast one"
    page = "<html><script>x</script><p>a &amp; b</p>\n<p>c&nbsp;d</p><!-- e --></html>"
    assert values(spark, html.to_text(F.col("x")), [page]) == ["a & b c\xa0d"] and markup.text_of(page) == "a & b c\xa0d"
    assert values(spark, html.without_cdn_scripts(F.col("x")), ['<body>a<script src="//substackcdn.com/1">z</script></body>', "none"]) == ["<body>a</body>", ""]


def test_link_rows():
    table = '<h2>S</h2><table><tr><td><a href="t">T</a></td><td>1/2/20</td><td><a href="f.txt">Download</a></td></tr></table><div><a href="u">U</a> on 2020-01-02 <a href="g.txt">download</a></div>'
    rows = markup.link_rows(table, "http://h/p/")
    assert [(r["url"], r["title"], r["title_url"], r["publication_date"], r["section"]) for r in rows] == [("http://h/p/f.txt", "T", "http://h/p/t", "1/2/20", "S"), ("http://h/p/g.txt", "U", "http://h/p/u", "2020-01-02", "S")]


def test_encoders():
    assert [binary.varuint(n) for n in (0, 127, 128, 300)] == [b"\0", b"\x7f", b"\x80\x01", b"\xac\x02"]
    assert binary.from_base58("2g") == b"a" and binary.from_base58("11") == b"\0\0\0" and binary.from_base58("1112") == b"\0\0\0\1"
    assert binary.transaction(1, 2, 3, [["", "é"]]) == bytes([1, 0, 2, 0, 0, 0, 3, 0, 0, 0, 1, 1, 0, 2, 0xC3, 0xA9, 0])


def test_files(spark, tmp_path):
    (tmp_path / "t" / "u").mkdir(parents=True)
    (tmp_path / "t" / "a.txt").write_bytes("é".encode())
    (tmp_path / "t" / "u" / "b.txt").write_bytes(b"\xe9\x93")
    assert sorted(r["text"] for r in io.text_files(spark, str(tmp_path / "t")).collect()) == ["é", "é“"]
    rows = spark.createDataFrame([("a|b", 1)], "title string, n int")
    io.write_pipe_csv(rows, str(tmp_path / "csv"))
    assert io.read_pipe_csv(spark, str(tmp_path / "csv"), ["title"]).first()["title"] == "ab"
    (tmp_path / "x.json").write_text('[{"a": 1}, {"a": 2}]')
    (tmp_path / "y.json").write_text('{"a": 1}\n{"a": 2}\n')
    assert io.read_json(spark, str(tmp_path / "x.json")).count() == io.read_json(spark, str(tmp_path / "y.json")).count() == 2
    pairs = spark.createDataFrame([("q", "a"), ("q", " ")], "question string, answer string")
    io.write_chat_jsonl(pairs, str(tmp_path / "chat"))
    assert [r["text"] for r in spark.read.json(str(tmp_path / "chat")).collect()] == ["<|user|>\nq\n<|assistant|>\na"]
    assert training.chat_rows(pairs).count() == 1
    io.write_shards(spark.createDataFrame([(1, 2), (1, 3)], "cluster_id int, v int"), str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).where("cluster_id = 1").count() == 2


def test_fetch_retries(spark):
    def get(url):
        if url == "bad":
            raise OSError("no")
        return 200, "text/html", url.encode()

    got = {r["url"]: (r["status"], r["error"]) for r in io.fetch(spark.createDataFrame([("a",), ("bad",)], "url string"), get, pause=0).collect()}
    assert got == {"a": (200, None), "bad": (500, "no")}


def test_streams(spark, tmp_path):
    rows = spark.sql("SELECT * FROM VALUES (timestamp '2024-01-01 00:00:00', 'A '), (timestamp '2024-01-01 00:01:00', 'a'), (timestamp '2024-01-01 00:07:00', 'b') t(ts, text)")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    for name, df, mode in (("first", unseen(stream, "ts").select("hash"), "append"), ("wide", window_counts(stream, "ts", "text"), "complete")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
        q.awaitTermination()
    assert spark.table("first").count() == 2 and spark.table("wide").count() == 3
    log = DownloadLog(spark, str(tmp_path / "log"), "cleaned_url string, content_type string, hash string, download_time timestamp")
    assert log.read().count() == 0
    batch = spark.sql("SELECT 'u' AS cleaned_url, 'html' AS content_type, '1' AS hash, timestamp '2024-01-01 00:00:00' AS download_time")
    log.merge(batch, 0)
    log.merge(batch.withColumn("content_type", F.lit("pdf")).withColumn("hash", F.lit("2")), 1)
    assert [(r["content_type"], r["hash"]) for r in log.read().collect()] == [("html", "2")]
