"""Queries of counts, TF-IDF, search, vectors, joins, state and training records."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.operators import chunk, search, state, tfidf, training
from corpusmill.operators import vectors as V
from corpusmill.operators.catalogue import query
from corpusmill.operators.queries_text import CHUNK_SQL, STRIP
from corpusmill.plans.lineage import cut, scratch, spread, table
from corpusmill.sources import io

C = F.col
STOP_SQL = "[" + ", ".join(f"'{w}'" for w in tfidf.STOP) + "]"
TOKENS = lambda x: f"list_filter(list_transform(regexp_extract_all({x}, '[A-Za-z0-9]+'), lambda t: lower(t)), lambda t: length(t) >= 2 AND NOT list_contains({STOP_SQL}, t))"
NAMES_SQL = f"list_filter(list_transform(regexp_extract_all(text, '[A-Za-z][A-Za-z''-]{{1,}}'), lambda t: lower(t)), lambda t: NOT list_contains({STOP_SQL}, t))"
FIELDS = {"text": 1.0, "lang": 2.0, "source": 1.0}
TF_SQL = "tf AS (SELECT doc_id, term, sum(w) AS tf FROM (" + " UNION ALL ".join(f"SELECT doc_id, unnest({TOKENS(c)}) AS term, CAST({w} AS DOUBLE) AS w FROM documents" for c, w in FIELDS.items()) + ") GROUP BY doc_id, term)"
W_SQL = f"""{TF_SQL}, df AS (SELECT term, count(*) AS df FROM tf GROUP BY term), n AS (SELECT count(*) AS n FROM documents),
r AS (SELECT doc_id, term, df, (1 + ln(tf)) * (ln((n + 1) / (df + 1)) + 1) AS raw FROM tf JOIN df USING (term), n),
w AS (SELECT doc_id, term, df, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM r WHERE raw > 0)"""
Q_SQL = f"""q AS (SELECT item_id AS query_id, term, count(*) AS tf FROM (SELECT item_id, unnest({TOKENS('text')}) AS term FROM benchmark) GROUP BY ALL),
qr AS (SELECT query_id, term, (1 + ln(q.tf)) * (ln((n + 1) / (df + 1)) + 1) AS raw FROM q JOIN df USING (term), n),
qw AS (SELECT query_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY query_id)) AS qw FROM qr),
hits AS (SELECT query_id, doc_id, round(sum(qw * weight), 9) AS score FROM qw JOIN w USING (term) GROUP BY ALL HAVING score > 0),
lex AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM hits)"""


def docs(spark, d):
    return spread(table(spark, d, "documents"))


def queries_of(spark, d):
    return table(spark, d, "benchmark").select(C("item_id").alias("query_id"), "text")


def index(spark, d):
    return tfidf.weights(docs(spark, d).select("doc_id", *FIELDS), fields=FIELDS)


def stored_index(spark, d):
    """The index as a search finds it: written once."""
    return cut(index(spark, d))


def n_docs(spark, d):
    return table(spark, d, "documents").agg(F.count("*").alias("n"))


@query("t1_index_tokens", f"SELECT doc_id, array_to_string({TOKENS('text')}, ' ') AS tokens FROM documents")
def _(spark, d):
    return docs(spark, d).select("doc_id", F.array_join(tfidf.index_tokens(C("text")), " ").alias("tokens"))


@query("t2_query_tokens", f"SELECT item_id, array_to_string(list_filter(regexp_extract_all(lower(text), '[a-z][a-z''-]{{1,}}'), lambda t: NOT list_contains({STOP_SQL}, t)), ' ') AS tokens FROM benchmark")
def _(spark, d):
    return table(spark, d, "benchmark").select("item_id", F.array_join(tfidf.query_tokens(C("text")), " ").alias("tokens"))


@query("t3_weighted_tf", f"WITH {TF_SQL} SELECT doc_id, term, tf FROM tf")
def _(spark, d):
    return tfidf.term_frequencies(docs(spark, d), "doc_id", FIELDS)


@query("t4_document_frequency", f"WITH {TF_SQL} SELECT term, count(*) AS df FROM tf GROUP BY term")
def _(spark, d):
    return tfidf.document_frequencies(tfidf.term_frequencies(docs(spark, d), "doc_id", FIELDS))


@query("t5_idf", f"WITH {TF_SQL}, df AS (SELECT term, count(*) AS df FROM tf GROUP BY term) SELECT term, round(ln(((SELECT count(*) FROM documents) + 1) / (df + 1)) + 1, 9) AS idf FROM df")
def _(spark, d):
    df = tfidf.document_frequencies(tfidf.term_frequencies(docs(spark, d), "doc_id", FIELDS))
    return df.join(F.broadcast(n_docs(spark, d))).select("term", F.round(tfidf.idf(C("df"), C("n")), 9).alias("idf"))


@query("t6_weights", f"WITH {W_SQL} SELECT doc_id, term, round(weight, 6) AS weight FROM w")
def _(spark, d):
    return index(spark, d).select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query("t7_inverted_index", f"WITH {W_SQL}, g AS (SELECT term, count(*) AS n, min(doc_id) AS first, sum(doc_id) AS ids FROM w GROUP BY term) SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx, CAST(sum(n) OVER (ORDER BY term) - n AS BIGINT) AS \"offset\", CAST(n AS BIGINT) AS n, first, CAST(ids AS BIGINT) AS ids FROM g")
def _(spark, d):
    ids = F.aggregate("doc_ids", F.lit(0).cast("long"), lambda a, x: a + x)
    return tfidf.packed(index(spark, d)).select("term", "idx", "offset", F.size("doc_ids").cast("long").alias("n"), F.element_at("doc_ids", 1).alias("first"), ids.alias("ids"))


@query("s27_unpacked_index", f"WITH {W_SQL} SELECT term, doc_id, round(weight, 6) AS weight FROM w")
def _(spark, d):
    return tfidf.unpack(tfidf.packed(index(spark, d))).select("term", "doc_id", F.round("weight", 6).alias("weight"))


GRAMS = f"""t AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+'), lambda t: NOT list_contains({STOP_SQL}, t)) AS t FROM documents),
g AS (SELECT doc_id, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term FROM t),
tf AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY ALL), n AS (SELECT count(*) AS n FROM documents),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term), k AS (SELECT term, df FROM df, n WHERE df >= 2 AND df <= 0.9 * n),
r AS (SELECT doc_id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS raw FROM tf JOIN k USING (term), n)"""


@query("t8_vectorise", f"WITH {GRAMS} SELECT doc_id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight FROM r")
def _(spark, d):
    return tfidf.vectorise(docs(spark, d), C("text"), stop=tfidf.STOP).select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query("t9_vocabulary", f"WITH {TF_SQL} SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx FROM (SELECT DISTINCT term FROM tf)")
def _(spark, d):
    df = tfidf.document_frequencies(tfidf.term_frequencies(docs(spark, d), "doc_id", FIELDS))
    return tfidf.vocabulary(df).select("term", "idx")


@query("t10_title_and_summary", "SELECT doc_id, coalesce(nullif(lang, 'fr'), '') || ' ' || coalesce(source, '') AS text FROM documents")
def _(spark, d):
    return docs(spark, d).select("doc_id", training.joined(F.nullif("lang", F.lit("fr")), C("source")).alias("text"))


@query("t11_top_terms", f"SELECT term, count(*) AS n FROM (SELECT unnest({NAMES_SQL}) AS term FROM documents) GROUP BY term ORDER BY n DESC, term LIMIT 100")
def _(spark, d):
    return tfidf.top_terms(docs(spark, d), tfidf.name_tokens(C("text")))


def _grams(n):
    gram = " || ' ' || ".join(f"t[i + {k}]" if k else "t[i]" for k in range(n))
    return f"SELECT term, count(*) AS n FROM (SELECT unnest(list_transform(range(1, len(t) - {n - 2}), lambda i: {gram})) AS term FROM (SELECT {NAMES_SQL} AS t FROM documents)) GROUP BY term ORDER BY n DESC, term LIMIT 100"


@query("t12_top_bigrams", _grams(2))
def _(spark, d):
    return tfidf.top_terms(docs(spark, d), tfidf.name_tokens(C("text")), 2)


@query("t12_top_trigrams", _grams(3))
def _(spark, d):
    return tfidf.top_terms(docs(spark, d), tfidf.name_tokens(C("text")), 3)


@query("t14_cluster_sizes", "SELECT min(n) AS least, max(n) AS most, count(*) AS clusters FROM (SELECT count(*) AS n FROM embeddings GROUP BY label)")
def _(spark, d):
    return table(spark, d, "embeddings").groupBy("label").agg(F.count("*").alias("n")).agg(F.min("n").alias("least"), F.max("n").alias("most"), F.count("*").alias("clusters"))


@query("v15_lexical_search", f"WITH {W_SQL}, {Q_SQL} SELECT query_id, doc_id, score, CAST(rank AS INTEGER) AS rank FROM lex WHERE rank <= 50")
def _(spark, d):
    return search.lexical(queries_of(spark, d), stored_index(spark, d), n_docs(spark, d), 50)


DOT = "list_inner_product"
E_SQL = "e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"


@query("v16_rerank", f"WITH {W_SQL}, {Q_SQL}, {E_SQL}, s AS (SELECT lex.query_id, doc_id, round({DOT}(e.v, f.v), 9) AS score FROM lex JOIN e ON e.vec_id = doc_id JOIN e f ON f.vec_id = lex.query_id WHERE rank <= 50) SELECT query_id, doc_id, round(score, 5) AS score FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) <= 10")
def _(spark, d):
    pool = search.lexical(queries_of(spark, d), stored_index(spark, d), n_docs(spark, d), 50)
    e = table(spark, d, "embeddings").select("vec_id", V.doubles(C("embedding")).alias("v"))
    found = search.rerank(pool, e.withColumnRenamed("vec_id", "doc_id"), e.select(C("vec_id").alias("query_id"), C("v").alias("q")), V.dot)
    return found.select("query_id", "doc_id", F.round("score", 5).alias("score"))


@query("v17_hydrate", f"WITH {W_SQL}, {Q_SQL} SELECT query_id, doc_id, l.quality FROM lex LEFT JOIN labels l USING (doc_id) WHERE rank <= 5")
def _(spark, d):
    hits = search.lexical(queries_of(spark, d), stored_index(spark, d), n_docs(spark, d), 5)
    return hits.join(table(spark, d, "labels"), "doc_id", "left").select("query_id", "doc_id", "quality")


@query("v18_valid_rows", f"SELECT doc_id FROM documents WHERE {STRIP('text')} <> ''")
def _(spark, d):
    return docs(spark, d).where(C("text").isNotNull() & (X.strip(C("text")) != "")).select("doc_id")


@query("v20_cards", f"WITH {W_SQL}, {Q_SQL} SELECT query_id, coalesce(nullif(CASE WHEN doc_id % 2 = 0 THEN '' ELSE source END, ''), '(untitled)') AS title, lang AS section, round(score, 3) AS score FROM lex JOIN documents USING (doc_id) WHERE rank <= 10")
def _(spark, d):
    hits = search.lexical(queries_of(spark, d), stored_index(spark, d), n_docs(spark, d), 10).join(docs(spark, d).drop("text"), "doc_id")
    return hits.select("query_id", *search.card(F.when(C("doc_id") % 2 == 0, "").otherwise(C("source")), C("lang"), C("score")))


@query("v1_dot_and_norm", f"WITH {E_SQL} SELECT vec_id, round(sqrt({DOT}(v, v)), 6) AS norm, round({DOT}(v, (SELECT v FROM e WHERE vec_id = 0)), 6) AS dot FROM e")
def _(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", V.doubles(C("embedding")).alias("v"))
    first = e.where("vec_id = 0").select(C("v").alias("q"))
    return e.join(F.broadcast(first)).select("vec_id", F.round(V.norm(C("v")), 6).alias("norm"), F.round(V.dot(C("v"), C("q")), 6).alias("dot"))


@query("v2_normalise", f"WITH {E_SQL} SELECT vec_id, list_transform(v, lambda x: round(x * 3 / (3 * sqrt({DOT}(v, v))), 5)) AS unit FROM e")
def _(spark, d):
    tripled = F.transform(V.doubles(C("embedding")), lambda x: x * 3)
    return table(spark, d, "embeddings").select("vec_id", F.transform(V.normalise(tripled), lambda x: V.rounded(x, 5)).alias("unit"))


CENTRES = f"""{E_SQL}, x AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS k FROM e), m AS (SELECT label, k, avg(x) AS m, count(*) AS n FROM x GROUP BY ALL),
c AS (SELECT label AS cluster_id, max(n) AS size, list(m ORDER BY k) AS m FROM m GROUP BY label), u AS (SELECT cluster_id, size, list_transform(m, lambda x: x / (sqrt({DOT}(m, m)) + 1e-12)) AS centroid FROM c)"""
ROUTED = f"r AS (SELECT a.vec_id AS query_id, cluster_id, round({DOT}(a.v, centroid), 9) AS score FROM e a, u WHERE a.vec_id % 20 = 0 QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY score DESC, cluster_id) <= 3)"


def vectors(spark, d):
    return table(spark, d, "embeddings").select("vec_id", C("label").alias("cluster_id"), V.doubles(C("embedding")).alias("v"))


def vector_queries(spark, d):
    return vectors(spark, d).where("vec_id % 20 = 0").select(C("vec_id").alias("query_id"), C("v").alias("q"))


@query("v8_centroids", f"WITH {CENTRES} SELECT cluster_id, size, list_transform(centroid, lambda x: round(x, 5)) AS centroid FROM u")
def _(spark, d):
    return V.centroids(vectors(spark, d), digits=5)


@query("v9_shard_index", "SELECT label AS cluster_id, count(*) AS size, list(vec_id ORDER BY vec_id) AS ids FROM embeddings GROUP BY label")
def _(spark, d):
    return vectors(spark, d).groupBy("cluster_id").agg(F.count("*").alias("size"), F.sort_array(F.collect_list("vec_id")).alias("ids"))


@query("v11_route", f"WITH {CENTRES}, {ROUTED} SELECT query_id, cluster_id, round(score, 5) AS score FROM r")
def _(spark, d):
    return V.route(vector_queries(spark, d), V.centroids(vectors(spark, d))).select("query_id", "cluster_id", F.round("score", 5).alias("score"))


@query("v12_shard_search", f"WITH {CENTRES}, {ROUTED}, h AS (SELECT r.query_id, e.vec_id, round({DOT}(e.v, q.v), 9) AS score FROM r JOIN e ON e.label = r.cluster_id JOIN e q ON q.vec_id = r.query_id) SELECT query_id, vec_id, round(score, 5) AS score FROM h WHERE h.score > 0 QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY h.score DESC, vec_id) <= 10")
def _(spark, d):
    q, rows = vector_queries(spark, d), vectors(spark, d)
    return V.search_shards(q, V.route(q, V.centroids(rows)), rows, 10).select("query_id", "vec_id", F.round("score", 5).alias("score"))


@query("v6_v7_capped_clusters")
def _(spark, d):
    return V.capped_clusters(table(spark, d, "embeddings").select("vec_id", C("embedding").alias("v")), k=8, cap=200)


@query("v10_id_to_cluster", "SELECT vec_id, label AS cluster_id FROM embeddings")
def _(spark, d):
    return vectors(spark, d).select("vec_id", "cluster_id")


@query("v14_query_vector", f"WITH {W_SQL}, {Q_SQL} SELECT query_id, term, round(qw, 6) AS qw FROM qw")
def _(spark, d):
    i = stored_index(spark, d)
    return search.query_weights(queries_of(spark, d), i.select("term", "df").distinct(), n_docs(spark, d)).select("query_id", "term", F.round("qw", 6).alias("qw"))


@query("v19_epsilon_normalise", f"WITH {E_SQL} SELECT vec_id, list_transform(v, lambda x: round(x / (sqrt({DOT}(v, v)) + 1e-12), 5)) AS unit FROM e")
def _(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.transform(V.normalise(V.doubles(C("embedding")), V.EPSILON), lambda x: V.rounded(x, 5)).alias("unit"))


MAP_SQL = "m AS (SELECT n_name AS asis, 'Region ' || n_regionkey AS clean FROM nation WHERE n_nationkey % 2 = 0)"


@query("m1_m3_media_map", f"WITH {MAP_SQL} SELECT c_custkey, coalesce(clean, n_name) AS publication FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN m ON n_name = asis")
def _(spark, d):
    nation = table(spark, d, "nation")
    mapping = nation.where("n_nationkey % 2 = 0").select(C("n_name").alias("asis"), F.concat(F.lit("Region "), C("n_regionkey").cast("string")).alias("clean"))
    rows = table(spark, d, "customer").join(nation, C("c_nationkey") == C("n_nationkey")).select("c_custkey", C("n_name").alias("publication"))
    return training.mapped(rows, "publication", mapping)


@query("m4_rename", "SELECT doc_id AS \"ID\", lang AS \"Source\", n_chars AS \"Size\" FROM documents")
def _(spark, d):
    return docs(spark, d).drop("text", "source").withColumnsRenamed({"doc_id": "ID", "lang": "Source", "n_chars": "Size"})


@query("m5_table_of_map", "SELECT * FROM (VALUES ('NY Times', 'New York Times'), ('NYT', 'New York Times'), ('WaPo', 'Washington Post')) t(asis, clean)")
def _(spark, d):
    return training.map_table(spark, {"New York Times": ["NY Times", "NYT"], "Washington Post": ["WaPo"]})


@query("m6_metadata_by_file", "SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON lower('F' || d.doc_id) = lower('f' || l.doc_id)")
def _(spark, d):
    meta = table(spark, d, "labels").select(F.lower(F.concat(F.lit("f"), C("doc_id").cast("string"))).alias("k"), "quality")
    return docs(spark, d).select("doc_id", F.lower(F.concat(F.lit("F"), C("doc_id").cast("string"))).alias("k")).join(meta, "k", "left").select("doc_id", "quality")


@query("m7_only_missing", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(spark, d):
    return docs(spark, d).select("doc_id").join(table(spark, d, "labels"), "doc_id", "left_anti")


@query("m8_in_vocabulary", f"SELECT item_id, term FROM (SELECT DISTINCT item_id, unnest({TOKENS('text')}) AS term FROM benchmark) WHERE term IN (SELECT unnest({TOKENS('text')}) FROM documents)")
def _(spark, d):
    terms = docs(spark, d).select(F.explode(tfidf.index_tokens(C("text"))).alias("term")).distinct()
    return table(spark, d, "benchmark").select("item_id", F.explode(tfidf.index_tokens(C("text"))).alias("term")).distinct().join(terms, "term", "left_semi").select("item_id", "term")


@query("m9_query_by_centroid", f"WITH {CENTRES} SELECT a.vec_id AS query_id, cluster_id, round({DOT}(a.v, centroid), 5) AS score FROM e a, u WHERE a.vec_id % 20 = 0")
def _(spark, d):
    return V.route(vector_queries(spark, d), V.centroids(vectors(spark, d)), top=10**6).select("query_id", "cluster_id", F.round("score", 5).alias("score"))


BATCH = "SELECT 'u' || user_id AS cleaned_url, event_type AS content_type, CAST(event_id AS VARCHAR) AS hash, CAST(event_id AS BIGINT) AS url_file_size, 'f' || user_id AS url_file_path, event_id AS batch FROM events"


@query("l2_upsert", f"WITH b AS ({BATCH}) SELECT cleaned_url, arg_min(content_type, batch) AS content_type, arg_max(hash, batch) AS hash, arg_max(url_file_size, batch) AS url_file_size FROM b GROUP BY cleaned_url")
def _(spark, d):
    return cached(spark, d).select("cleaned_url", "content_type", "hash", "url_file_size")


def cached(spark, d):
    e = table(spark, d, "events")
    rows = e.select(F.concat(F.lit("u"), "user_id").alias("cleaned_url"), C("event_type").alias("content_type"), C("event_id").cast("string").alias("hash"), C("event_id").alias("url_file_size"), F.concat(F.lit("f"), "user_id").alias("url_file_path"), C("event_id").alias("batch"))
    start = state.upsert(state.empty(spark, rows.drop("batch").schema), rows.where("batch < 100"), "cleaned_url", "batch")
    return state.upsert(start, rows.where("batch >= 100"), "cleaned_url", "batch")


@query("l3_lookup", f"WITH b AS ({BATCH}) SELECT cleaned_url, arg_max(hash, batch) AS hash FROM b WHERE cleaned_url = 'u7' GROUP BY cleaned_url")
def _(spark, d):
    return cached(spark, d).where("cleaned_url = 'u7'").select("cleaned_url", "hash")


LISTING = "SELECT 'f' || user_id AS path, CAST(max(event_id) + CASE WHEN user_id % 5 = 0 THEN 1 ELSE 0 END AS BIGINT) AS size FROM events WHERE user_id % 3 > 0 GROUP BY user_id"


@query("l4_validated", f"WITH b AS ({BATCH}), s AS (SELECT cleaned_url, any_value(url_file_path) AS p, max(url_file_size) AS z FROM b GROUP BY 1), l AS ({LISTING}) SELECT cleaned_url, CASE WHEN size IS NULL THEN 'missing' WHEN size = z THEN 'hit' ELSE 'stale' END AS status FROM s LEFT JOIN l ON p = path")
def _(spark, d):
    listing = table(spark, d, "events").where("user_id % 3 > 0").groupBy("user_id").agg(F.max("event_id").alias("m"))
    listing = listing.select(F.concat(F.lit("f"), "user_id").alias("path"), (C("m") + F.when(C("user_id") % 5 == 0, 1).otherwise(0)).alias("size"))
    return state.validated(cached(spark, d), listing)


TEXT_LISTING = "SELECT 't' || user_id AS path, CAST(2 * max(event_id) AS BIGINT) AS size FROM events WHERE user_id % 7 > 0 GROUP BY user_id"


@query(
    "l5_file_info",
    f"WITH b AS ({BATCH}), s AS (SELECT any_value(url_file_path) AS p, max(url_file_size) AS z FROM b GROUP BY cleaned_url), l AS ({LISTING}), t AS ({TEXT_LISTING}) "
    "SELECT p AS url_file_path, z AS url_file_size, t.path AS text_file_path, CAST(2 * z AS BIGINT) AS text_file_size FROM s JOIN l ON p = l.path AND l.size = z JOIN t ON t.path = 't' || substr(p, 2) AND t.size = 2 * z",
)
def _(spark, d):
    newest = table(spark, d, "events").groupBy("user_id").agg(F.max("event_id").alias("m"))
    page = newest.where("user_id % 3 > 0").select(F.concat(F.lit("f"), "user_id").alias("path"), (C("m") + F.when(C("user_id") % 5 == 0, 1).otherwise(0)).alias("size"))
    plain = newest.where("user_id % 7 > 0").select(F.concat(F.lit("t"), "user_id").alias("path"), (C("m") * 2).alias("size"))
    known = cached(spark, d).withColumn("text_file_path", F.concat(F.lit("t"), F.substring("cleaned_url", 2, 99))).withColumn("text_file_size", C("url_file_size") * 2)
    return state.file_info(known, page.unionByName(plain))


@query("l6_remove", f"WITH b AS ({BATCH}) SELECT DISTINCT cleaned_url FROM b WHERE cleaned_url NOT IN (SELECT 'u' || user_id FROM events WHERE user_id % 4 = 1)")
def _(spark, d):
    gone = table(spark, d, "events").where("user_id % 4 = 1").select(F.concat(F.lit("u"), "user_id").alias("cleaned_url"))
    return state.remove(cached(spark, d), gone, "cleaned_url").select("cleaned_url")


@query("q1_title_and_body", f"SELECT doc_id, coalesce(nullif({STRIP('split_part(text, chr(10), 1)')}, ''), 'doc ' || doc_id) AS title, {STRIP('CASE WHEN contains(text, chr(10)) THEN substr(text, instr(text, chr(10)) + 1) ELSE $$$$ END')} AS body FROM documents")
def _(spark, d):
    return docs(spark, d).select("doc_id", *training.title_and_body(C("text"), F.concat(F.lit("doc "), C("doc_id").cast("string"))))


BLOCKY = "replace(text, '. ', '.' || chr(10) || repeat(' ', CAST(doc_id % 3 AS INTEGER)) || chr(10))"
BLOCKS_SQL = f"b AS (SELECT doc_id, unnest(list_filter(list_transform(regexp_split_to_array({BLOCKY}, '\\n[ \\t]*(?:\\n[ \\t]*)+'), lambda x: {STRIP('x')}), lambda x: x <> '')) AS block FROM documents)"


@query("q2_blocks", f"WITH {BLOCKS_SQL} SELECT doc_id, block, count(*) AS n FROM b GROUP BY ALL")
def _(spark, d):
    return docs(spark, d).select("doc_id", F.explode(training.blocks(F.expr(BLOCKY))).alias("block")).groupBy("doc_id", "block").agg(F.count("*").alias("n"))


@query("q3_monolith", f"WITH {BLOCKS_SQL}, p AS (SELECT doc_id, {STRIP('split_part(block, chr(10), 1)')} AS title, {STRIP('CASE WHEN contains(block, chr(10)) THEN substr(block, instr(block, chr(10)) + 1) ELSE $$$$ END')} AS body FROM b) SELECT doc_id, title, body FROM p WHERE title <> '' AND body <> ''")
def _(spark, d):
    return training.monolith(docs(spark, d).select("doc_id", F.expr(BLOCKY).alias("text")))


@query("q4_line_questions", f"WITH l AS (SELECT doc_id, {STRIP('l')} AS body FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents)) SELECT doc_id, 'What about ' || substr(regexp_extract(body, '(?s)^(.*?[.!?])[\\s]', 1) || CASE WHEN regexp_matches(body, '(?s)^.*?[.!?][\\s]') THEN '' ELSE body END, 1, 120) || '?' AS question, body AS answer FROM l WHERE body <> ''")
def _(spark, d):
    return training.line_questions(docs(spark, d), "What about {title_hint}?")


PAIRS = "p AS (SELECT conv_id, turn, role, text AS question, lead(role) OVER w AS next_role, lead(text) OVER w AS answer FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))"


@query("q5_chat_records", f"WITH {PAIRS} SELECT conv_id, turn, '<|user|>' || chr(10) || question || chr(10) || '<|assistant|>' || chr(10) || answer AS text FROM p WHERE role = 'user' AND next_role = 'assistant'")
def _(spark, d):
    pairs = training.chat_pairs(table(spark, d, "conversations"))
    return pairs.select("conv_id", "turn", training.chat_record(C("question"), C("answer"))["text"].alias("text"))


@query("s18_chat_jsonl", f"WITH {PAIRS} SELECT conv_id, turn, question, regexp_replace(substr(answer, 1, 80), '[\\s]+$', '') AS answer FROM (SELECT conv_id, turn, role, next_role, {STRIP('regexp_replace(question, $$[ ' + chr(92) + 't]+$$, $$ $$, $$g$$)')} AS question, {STRIP('regexp_replace(answer, $$[ ' + chr(92) + 't]+$$, $$ $$, $$g$$)')} AS answer FROM p) WHERE role = 'user' AND next_role = 'assistant' AND question <> '' AND answer <> ''")
def _(spark, d):
    return training.chat_rows(training.chat_pairs(table(spark, d, "conversations")), max_answer=80)


@query("q6_stop_tokens", f"SELECT doc_id, {STRIP('l')} || ' </s>' AS line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents) WHERE {STRIP('l')} <> ''")
def _(spark, d):
    return training.stop_lines(docs(spark, d))


@query("q7_instruction", f"WITH {PAIRS} SELECT conv_id, turn, '### Instruction:' || chr(10) || question || chr(10) || chr(10) || '### Response:' || chr(10) || answer AS text FROM p WHERE role = 'user' AND next_role = 'assistant'")
def _(spark, d):
    return training.chat_pairs(table(spark, d, "conversations")).select("conv_id", "turn", training.instruction(C("question"), C("answer")).alias("text"))


@query("q8_head", "SELECT doc_id FROM documents ORDER BY doc_id LIMIT 200")
def _(spark, d):
    return docs(spark, d).select("doc_id").orderBy("doc_id").limit(200)


@query("q9_stop_trim", "SELECT conv_id, turn, split_part(split_part(text, ' the ', 1), '.', 1) AS text FROM conversations")
def _(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", X.cut_at_stops(C("text"), [" the ", "."]).alias("text"))


REQUEST = "CASE conv_id % 3 WHEN 0 THEN '{\"inputs\":\"a' || turn || '\",\"parameters\":{\"max_tokens\":' || turn || '}}' WHEN 1 THEN '{\"input\":\"b\"}' ELSE '{\"messages\":[{\"role\":\"user\",\"content\":\"c\"}],\"parameters\":{\"temperature\":0.1,\"max_new_tokens\":9}}' END"


@query("q10_request", "SELECT conv_id, turn, CASE conv_id % 3 WHEN 0 THEN turn WHEN 1 THEN 256 ELSE 9 END AS max_new_tokens, CASE conv_id % 3 WHEN 2 THEN 0.1 ELSE 0.7 END::DOUBLE AS temperature, 0.9::DOUBLE AS top_p, CASE conv_id % 3 WHEN 0 THEN 'a' || turn WHEN 1 THEN 'b' ELSE 'c' END AS prompt FROM conversations")
def _(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", "turn", F.expr(REQUEST).alias("r"))
    return rows.select("conv_id", "turn", *training.request(C("r")))


@query("q11_until_eos", "SELECT conv_id, CASE WHEN list_contains(ids, 2) THEN ids[1:list_position(ids, 2) - 1] ELSE ids END AS ids FROM (SELECT conv_id, list(turn ORDER BY turn) AS ids FROM conversations GROUP BY conv_id)")
def _(spark, d):
    ids = table(spark, d, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("ids"))
    return ids.select("conv_id", training.until(C("ids"), 2).alias("ids"))


TAILED = "text || ' \"</s>\" more <|end|>'"


@query("q12_literal_stops", f"SELECT conv_id, turn, regexp_replace(regexp_extract({TAILED}, '(?s)^(.*?)(?:\\s|[\"''])*(?:</s>|<\\|end\\|>)', 1), '\\s+$', '') AS text FROM conversations")
def _(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", X.cut_at_literal_stops(F.expr(TAILED), ["</s>", "<|end|>"]).alias("text"))


@query("q13_strip_prompt", f"WITH {PAIRS} SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN regexp_replace(answer, '^\\s+', '') ELSE answer END AS answer FROM p WHERE answer IS NOT NULL")
def _(spark, d):
    rows = training.turns(table(spark, d, "conversations")).where("answer IS NOT NULL")
    echoed = F.when(C("turn") % 2 == 0, F.concat("question", F.lit(" "), "answer")).otherwise(F.concat(F.lit(""), "answer"))
    return rows.select("conv_id", "turn", X.strip_prompt(F.when(C("turn") % 2 == 0, C("question")).otherwise(F.lit("\x00")), echoed).alias("answer"))


@query("q14_stop_suffix", "SELECT conv_id, turn, turn % 3 < 2 AS stops FROM conversations")
def _(spark, d):
    tail = F.expr("text || CASE turn % 3 WHEN 0 THEN '</s>' WHEN 1 THEN ' \"</s>\" ' ELSE '</s> x' END")
    return table(spark, d, "conversations").select("conv_id", "turn", X.ends_with_stop(tail, ["</s>"]).alias("stops"))


@query("q15_prompts", "SELECT item_id, text || ' ' || 'Answer briefly.' AS prompt FROM benchmark")
def _(spark, d):
    return table(spark, d, "benchmark").select("item_id", F.concat_ws(" ", "text", F.lit("Answer briefly.")).alias("prompt"))


@query("s7_wayback", "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'a' || page_id END AS url FROM pages")
def _(spark, d):
    r = F.expr("CASE WHEN page_id % 2 = 0 THEN '{\"archived_snapshots\":{\"closest\":{\"url\":\"a' || page_id || '\"}}}' ELSE '{\"archived_snapshots\":{}}' END")
    return table(spark, d, "pages").select("page_id", F.get_json_object(r, "$.archived_snapshots.closest.url").alias("url"))


@query("s16_pipe_rows", "SELECT doc_id, replace(text, '|', '') AS chunk_text, replace(source, '|', '') AS section FROM documents")
def _(spark, d):
    return training.without_pipes(docs(spark, d).select("doc_id", C("text").alias("chunk_text"), C("source").alias("section")))


@query("s21_text_files", f"SELECT page_id, {STRIP('url')} || chr(10) || chr(10) || html AS content FROM pages WHERE html <> ''")
def _(spark, d):
    return training.text_files(table(spark, d, "pages").select("page_id", C("url").alias("title"), C("html").alias("content")))


@query("s22_pdf_title", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'no_title' ELSE lang END AS title FROM documents")
def _(spark, d):
    return docs(spark, d).select("doc_id", training.some_title(F.when(C("doc_id") % 2 == 0, F.when(C("doc_id") % 4 == 0, "")).otherwise(C("lang"))).alias("title"))


@query("s24_counts", "SELECT count(*) FILTER (WHERE ends_with(u, '.txt')) AS text_files, count(*) FILTER (WHERE contains(u, 'CRAWLING')) AS crawled FROM (SELECT CASE page_id % 3 WHEN 0 THEN url || '.txt' WHEN 1 THEN 'CRAWLING ' || url ELSE url END AS u FROM pages)")
def _(spark, d):
    u = F.expr("CASE page_id % 3 WHEN 0 THEN url || '.txt' WHEN 1 THEN 'CRAWLING ' || url ELSE url END")
    return table(spark, d, "pages").agg(F.count_if(F.endswith(u, F.lit(".txt"))).alias("text_files"), F.count_if(u.contains("CRAWLING")).alias("crawled"))


@query("s10_text_with_fallback", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN text ELSE regexp_replace(text, '[^\\x00-\\x7F]', 'é', 'g') END AS text FROM documents")
def _(spark, d):
    """Every second text in a one-byte encoding that is no valid UTF-8 where it isn't ASCII."""
    other = F.encode(F.regexp_replace("text", r"[^\x00-\x7F]", "é"), "ISO-8859-1")
    return docs(spark, d).select("doc_id", io.decode(F.when(C("doc_id") % 2 == 0, F.encode("text", "UTF-8")).otherwise(other)).alias("text"))


@query("s11_file_scan", "SELECT DISTINCT lang AS folder, true AS read FROM documents")
def _(spark, d):
    path = scratch(spark)
    table(spark, d, "documents").select("lang", "text").write.partitionBy("lang").csv(path)
    found = io.files(spark, path, "*.csv").select(F.regexp_extract("path", "lang=([^/]*)/", 1).alias("folder"), F.length("content").alias("n"))
    return found.groupBy("folder").agg((F.sum("n") > 0).alias("read"))


@query("s12_pipe_csv", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, source FROM documents")
def _(spark, d):
    path = scratch(spark)
    io.write_pipe_csv(table(spark, d, "documents").select("doc_id", "lang", "source"), path)
    return io.read_pipe_csv(spark, path, ["doc_id", "source"])


@query("s13_json_records", "SELECT doc_id, lang, text FROM documents")
def _(spark, d):
    path = scratch(spark)
    io.write_json(table(spark, d, "documents").select("doc_id", "lang", "text"), path)
    return io.read_json(spark, path, "doc_id long, lang string, text string")


@query("s14_records_by_type", "SELECT doc_id, text, k FROM documents, (VALUES ('lines'), ('array')) v(k)")
def _(spark, d):
    """The same records one to a line and, with another content type, as arrays of whole files."""
    lines, arrays = scratch(spark), scratch(spark)
    rows = table(spark, d, "documents").select("doc_id", "text")
    io.write_json(rows, lines)
    some = rows.groupBy(F.floor(C("doc_id") / 500).alias("b")).agg(F.to_json(F.collect_list(F.struct("doc_id", "text"))).alias("value"))
    some.repartition(F.col("b")).write.option("maxRecordsPerFile", "1").partitionBy("b").text(arrays)
    kinds = (("lines", "application/x-ndjson", lines), ("array", "application/json", f"{arrays}/*"))
    a, b = (io.read_records(spark, path, kind, "doc_id long, text string").withColumn("k", F.lit(k)) for k, kind, path in kinds)
    return a.select("doc_id", "text", "k").unionByName(b.select("doc_id", "text", "k"))


@query("s17_json_sink", "SELECT doc_id, text, false AS escaped FROM documents")
def _(spark, d):
    """Lines as written: letters beyond ASCII aren't escaped."""
    path = scratch(spark)
    io.write_json(table(spark, d, "documents").select("doc_id", "text"), path)
    line = spark.read.text(path)
    return line.select(F.get_json_object("value", "$.doc_id").cast("long").alias("doc_id"), F.get_json_object("value", "$.text").alias("text"), C("value").rlike(r"\\u00[8-9a-fA-F]").alias("escaped"))


@query("s19_index_sink", f"WITH {W_SQL} SELECT term, count(*) AS n, min(doc_id) AS first, round(sum(weight), 4) AS weight FROM w GROUP BY term")
def _(spark, d):
    path = scratch(spark)
    io.write_index(tfidf.packed(index(spark, d)), path)
    read = spark.read.schema("term string, doc_ids array<long>, weights array<double>").json(path)
    total = F.aggregate("weights", F.lit(0.0), lambda a, x: a + x)
    return read.select("term", F.size("doc_ids").cast("long").alias("n"), F.element_at("doc_ids", 1).alias("first"), F.round(total, 4).alias("weight"))


#: Chunks in the place of documents.
CHUNKED_TF = " UNION ALL ".join(f"SELECT doc_id, unnest({TOKENS(c)}) AS term, CAST({w} AS DOUBLE) AS w FROM p" for c, w in zip(("chunk_text", "source", "lang"), tfidf.FIELDS.values(), strict=True))
CHUNKED_SQL = f"""WITH p AS ({CHUNK_SQL} SELECT doc_id || ':' || i AS doc_id, array_to_string(c.w[st + 1:en], ' ') AS chunk_text, source, lang FROM c JOIN documents USING (doc_id)),
tf AS (SELECT doc_id, term, sum(w) AS tf FROM ({CHUNKED_TF}) GROUP BY doc_id, term){W_SQL.removeprefix(TF_SQL).replace("FROM documents", "FROM p")}, {Q_SQL}
SELECT query_id, doc_id AS chunk_id, score, CAST(rank AS INTEGER) AS rank FROM lex WHERE rank <= 10"""


@query("flagship_chunk_search", CHUNKED_SQL)
def flagship(spark, d):
    """Documents to chunks to a weighted index; every benchmark item as a query, its ten best chunks."""
    parts = chunk.chunks(docs(spark, d), keep=("source", "lang"))
    parts = parts.withColumn("chunk_id", F.concat_ws(":", "doc_id", "chunk_index"))
    weights = tfidf.weights(parts.select("chunk_id", "chunk_text", C("source").alias("title"), C("lang").alias("section")), key="chunk_id")
    return search.lexical(queries_of(spark, d), cut(weights), parts.agg(F.count("*").alias("n")), 10, key="chunk_id")
