"""Queries of HTML, transcripts, cleaning, chunking and training text."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import html as H
from corpusmill.functions import text as X
from corpusmill.operators import chunk
from corpusmill.operators.catalogue import query
from corpusmill.plans.lineage import spread, table

C = F.col
SPACE = "\\s\\x0b\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
STRIP = lambda x: f"regexp_replace({x}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"
WORDS = f"regexp_extract_all(text, '[^{SPACE}]+')"


def docs(spark, d):
    return spread(table(spark, d, "documents"))


def pages(spark, d):
    return table(spark, d, "pages")


def unescape_sql(x):
    for name, sign in H.ENTITIES:
        x = f"replace({x}, '{name}', '{sign.replace(chr(39), chr(39) * 2)}')"
    return x


def text_sql(x):
    bare = f"regexp_replace({x}, '(?is)<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>|<!--.*?-->|<![^>]*>', '', 'g')"
    bare = unescape_sql(f"regexp_replace({bare}, '(?s)<[^>]*>', ' ', 'g')")
    return f"array_to_string(list_filter(list_transform(regexp_split_to_array({bare}, '\\r\\n|\\r|\\n|  '), lambda p: {STRIP('p')}), lambda p: p <> ''), ' ')"


@query("h1_html_to_text", f"SELECT page_id, {text_sql('html')} AS text FROM pages")
def _(spark, d):
    return pages(spark, d).select("page_id", H.to_text(C("html")).alias("text"))


ARTICLE = "regexp_replace(coalesce(nullif(regexp_extract(html, '(?is)<article\\b[^>]*>(.*)</article\\s*>', 1), ''), html), '(?is)<nav\\b[^>]*>.*?</nav\\s*>|<footer\\b[^>]*>.*?</footer\\s*>|<aside\\b[^>]*>.*?</aside\\s*>|<div class=\"ad\">.*?</div>', ' ', 'g')"


@query("h2_article", f"SELECT page_id, {STRIP(unescape_sql('regexp_extract(html, $$(?is)<title' + chr(92) + 'b[^>]*>(.*?)</title' + chr(92) + 's*>$$, 1)'))} AS title, {text_sql(ARTICLE)} AS text FROM pages")
def _(spark, d):
    return pages(spark, d).select("page_id", H.title(C("html")).alias("title"), H.article(C("html")).alias("text"))


CDN = "CASE WHEN page_id % 2 = 0 THEN replace(html, '</body>', '<script src=\"https://substackcdn.com/x.js\">1</script></body>') ELSE html END"


@query("h4_body_without_cdn", f"SELECT page_id, sha256(regexp_replace(regexp_extract(x, '(?is)<body\\b[^>]*>.*</body\\s*>'), '(?is)<script\\b[^>]*\\bsrc\\s*=\\s*[\"''][^\"'']*substackcdn[^>]*>.*?</script\\s*>', '', 'g')) AS hash FROM (SELECT page_id, {CDN} AS x FROM pages)")
def _(spark, d):
    return pages(spark, d).select("page_id", F.sha2(H.without_cdn_scripts(F.expr(CDN)), 256).alias("hash"))


@query("h5_section", "SELECT page_id, coalesce(list_filter(list_transform(regexp_extract_all(substr(html, 1, length(html) // 2), '(?is)<h[123]\\b[^>]*>(.*?)</h[123]\\s*>', 1), lambda h: " + text_sql("h") + "), lambda h: h <> '')[-1], '') AS section FROM pages")
def _(spark, d):
    return pages(spark, d).select("page_id", H.section_of(C("html"), F.floor(F.length("html") / 2).cast("int")).alias("section"))


DATED = "text || CASE doc_id % 4 WHEN 0 THEN ' 2019-03-' || (10 + doc_id % 20) WHEN 1 THEN ' Mar ' || (1 + doc_id % 28) || ', 2021 x' WHEN 2 THEN ' 3/' || (1 + doc_id % 28) || '/21 1/1/2020' ELSE '' END"


@query("h7_first_date", f"SELECT doc_id, regexp_extract({DATED}, '{X.DATE}', 1) AS found FROM documents")
def _(spark, d):
    return docs(spark, d).select("doc_id", X.first_date(F.expr(DATED)).alias("found"))


@query("h8_escape", "SELECT page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;') AS escaped FROM pages")
def _(spark, d):
    return pages(spark, d).select("page_id", H.escape(C("html")).alias("escaped"))


@query("h9_missing_text", f"SELECT page_id, {text_sql('html')} AS text FROM pages WHERE page_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 3 = 0)")
def _(spark, d):
    done = docs(spark, d).where("doc_id % 3 = 0").select(C("doc_id").alias("page_id"))
    return pages(spark, d).join(done, "page_id", "left_anti").select("page_id", H.to_text(C("html")).alias("text"))


#: Transcripts made of documents: title, targets, overview and sessions, some parts missing.
RAW = (
    "CASE WHEN doc_id % 5 = 4 THEN '' ELSE '****** Title ' || doc_id || ' ******' || chr(10) || 'Target ' || lang || chr(10) || '-----' || chr(10) || 'Second ' || source || chr(10) || chr(10) END || "
    "CASE WHEN doc_id % 3 = 0 THEN '%%%%%% PROJECT OVERVIEW %%%%%%' || chr(10) || text || chr(10) || chr(10) || chr(10) || 'more' || chr(10) || '%%%%%% END PROJECT OVERVIEW %%%%%%' || chr(10) ELSE '' END || "
    "CASE WHEN doc_id % 4 = 0 THEN '=== BEGIN SESSIONS ===' || chr(10) || '=== Ann SESSION' || chr(10) || text || chr(10) || '=== Bob SESSION' || chr(10) || lang || text || chr(10) || '&&&&&& END OF X ******' || chr(10) || 'after' WHEN doc_id % 4 = 1 THEN '=== BEGIN SESSIONS ===' || chr(10) || text ELSE '' END"
)
RAW_SQL = f"WITH t AS (SELECT doc_id, {RAW} AS raw FROM documents)"
TITLE_SQL = STRIP("regexp_extract(raw, '(?im)^\\*{6}\\s*(.*?)\\s*\\*{6}\\s*$', 1)")
OVER_SQL = STRIP("regexp_replace(regexp_extract(raw, '(?ims)^%{6}\\s*PROJECT OVERVIEW\\s*%{6}\\s*$(.*?)^%{6}\\s*END PROJECT OVERVIEW\\s*%{6}\\s*$', 1), '\\n{3,}', chr(10) || chr(10), 'g')")


def transcripts(spark, d):
    return docs(spark, d).select("doc_id", F.expr(RAW).alias("raw"))


@query("c1_title", f"{RAW_SQL} SELECT doc_id, {TITLE_SQL} AS title FROM t")
def _(spark, d):
    return transcripts(spark, d).select("doc_id", X.title_line(C("raw")).alias("title"))


@query("c2_targets", "SELECT doc_id, CASE WHEN doc_id % 5 = 4 THEN '' ELSE 'Target ' || lang || chr(10) || 'Second ' || source END AS targets FROM documents")
def _(spark, d):
    return transcripts(spark, d).select("doc_id", X.targets(C("raw")).alias("targets"))


@query("c3_overview", f"{RAW_SQL} SELECT doc_id, {OVER_SQL} AS overview FROM t")
def _(spark, d):
    return transcripts(spark, d).select("doc_id", X.overview(C("raw")).alias("overview"))


@query(
    "c4_sessions",
    f"{RAW_SQL} SELECT doc_id, 'Ann' AS viewer, {STRIP('text')} AS body FROM documents WHERE doc_id % 4 = 0 UNION ALL SELECT doc_id, 'Bob', {STRIP('lang || text')} FROM documents WHERE doc_id % 4 = 0 "
    f"UNION ALL SELECT doc_id, '', {STRIP('text')} FROM documents WHERE doc_id % 4 = 1 UNION ALL SELECT doc_id, '', {STRIP('raw')} FROM t WHERE doc_id % 4 > 1 AND {STRIP('raw')} <> ''",
)
def _(spark, d):
    return transcripts(spark, d).select("doc_id", F.inline(X.sessions(C("raw"))))


@query(
    "c5_compose",
    f"{RAW_SQL}, p AS (SELECT doc_id, CASE WHEN doc_id % 5 = 4 THEN NULL ELSE 'Targets:' || chr(10) || 'Target ' || lang || chr(10) || 'Second ' || source END AS a, nullif({OVER_SQL}, '') AS b, "
    f"CASE doc_id % 4 WHEN 0 THEN 'Session (Ann):' || chr(10) || {STRIP('text')} || chr(10) || chr(10) || 'Session (Bob):' || chr(10) || {STRIP('lang || text')} WHEN 1 THEN 'Session:' || chr(10) || {STRIP('text')} ELSE CASE WHEN {STRIP('raw')} <> '' THEN 'Session:' || chr(10) || {STRIP('raw')} END END AS c "
    f"FROM t JOIN documents USING (doc_id)) SELECT doc_id, {STRIP('concat_ws(chr(10) || chr(10), a, $$Overview:$$ || chr(10) || b, c)')} AS relevant FROM p",
)
def _(spark, d):
    return transcripts(spark, d).select("doc_id", X.strip(X.compose(C("raw"))).alias("relevant"))


@query("c6_words", f"SELECT doc_id, CAST(len({WORDS}) AS BIGINT) AS n_words, array_to_string({WORDS}, ' ') AS joined FROM documents")
def _(spark, d):
    return docs(spark, d).select("doc_id", F.size(chunk.words(C("text"))).cast("long").alias("n_words"), F.array_join(chunk.words(C("text")), " ").alias("joined"))


CHUNK_SQL = f"""WITH w AS (SELECT doc_id, {WORDS} AS w FROM documents), n AS (SELECT doc_id, w, len(w) AS n FROM w),
s AS (SELECT doc_id, w, n, unnest(CASE WHEN n = 0 THEN [] WHEN n <= 400 THEN [0] WHEN (n - 400) % 350 = 0 THEN range(0, n - 399, 350) ELSE list_append(range(0, n - 399, 350), n - 400) END) AS st FROM n),
c AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY st) - 1 AS i, st, least(n, st + 400) AS en, w FROM s)"""


@query("c7_chunks", f"{CHUNK_SQL} SELECT doc_id, CAST(i AS INTEGER) AS chunk_index, CAST(st AS INTEGER) AS start_word, CAST(en AS INTEGER) AS end_word, CAST(en - st AS INTEGER) AS chunk_words, array_to_string(w[st + 1:en], ' ') AS chunk_text FROM c")
def _(spark, d):
    return chunk.chunks(docs(spark, d))


@query(
    "c8_chunk_table",
    f"{CHUNK_SQL} SELECT c.doc_id, coalesce(nullif(m.title, ''), 'doc ' || c.doc_id) AS title, CAST(i AS INTEGER) AS chunk_index, CAST(en - st AS INTEGER) AS chunk_words "
    "FROM c LEFT JOIN (SELECT item_id, CASE WHEN item_id % 2 = 0 THEN text ELSE '' END AS title FROM benchmark) m ON c.doc_id = m.item_id",
)
def _(spark, d):
    meta = table(spark, d, "benchmark").select(C("item_id").alias("doc_id"), F.expr("CASE WHEN item_id % 2 = 0 THEN text ELSE '' END").alias("title"))
    rows = chunk.chunks(docs(spark, d)).join(meta, "doc_id", "left")
    return rows.select("doc_id", F.coalesce(F.nullif("title", F.lit("")), F.concat(F.lit("doc "), C("doc_id").cast("string"))).alias("title"), "chunk_index", "chunk_words")


@query("c9_one_space", f"SELECT doc_id, regexp_replace(text, '[{SPACE}]+', ' ', 'g') AS text FROM documents")
def _(spark, d):
    return docs(spark, d).select("doc_id", X.one_space(C("text")).alias("text"))


@query("c10_newlines", "SELECT doc_id, regexp_replace(replace(text, '. ', '.' || repeat(chr(10), 1 + doc_id % 5)), '\\n{3,}', chr(10) || chr(10), 'g') AS text FROM documents")
def _(spark, d):
    return docs(spark, d).select("doc_id", X.max_two_newlines(F.expr("replace(text, '. ', '.' || repeat(chr(10), int(1 + doc_id % 5)))")).alias("text"))


NOISY = "text || chr(10) || 'Note: stays' || chr(10) || ' Click here' || chr(10) || 'Related articles' || chr(10) || 'If you wish, x' || chr(10) || 'end |'"


BAD_SQL = "'(?i)" + "|".join(X.BOILERPLATE) + "'"
KEPT_SQL = f"array_to_string(list_filter(regexp_split_to_array({NOISY}, '\\r\\n|\\r|\\n'), lambda l: NOT regexp_matches({STRIP('l')}, {BAD_SQL})), chr(10))"
FOLDED_SQL = f"regexp_replace(regexp_replace({KEPT_SQL}, '[ \\t\\x{{a0}}]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')"


@query("c11_boilerplate", f"SELECT doc_id, {STRIP(FOLDED_SQL)} AS text FROM documents")
def _(spark, d):
    return docs(spark, d).select("doc_id", X.drop_boilerplate(F.expr(NOISY)).alias("text"))


NOTED = "'Note: a' || text || ' note: b' || chr(10) || 'Note: c'"


@query("c12_note_line", f"SELECT doc_id, regexp_replace({NOTED}, '([^\\n])(?i:note:)', '\\1' || chr(10) || 'Note:', 'g') AS text FROM documents")
def _(spark, d):
    return docs(spark, d).select("doc_id", X.note_on_new_line(F.expr(NOTED)).alias("text"))


CLOSING = """[)"''»\\]\\)’]*"""
ENDING = f"[.!?…]{CLOSING}"
CLAMP_SQL = f"""{CHUNK_SQL}, a AS (SELECT doc_id, CAST(i AS INTEGER) AS chunk_index, array_to_string(w[st + 1:en], ' ') AS t FROM c), b AS (SELECT *, {STRIP('t')} AS whole FROM a),
h AS (SELECT *, CASE WHEN regexp_matches(whole, '^[A-Z0-9“"(\\[]') OR NOT regexp_matches(whole, '{ENDING}\\s+') OR length(regexp_extract(whole, '(?s)^(.*?){ENDING}\\s+', 1)) >= 220
  THEN whole ELSE {STRIP(f"regexp_replace(whole, '(?s)^.*?{ENDING}' || chr(92) || 's+', '')")} END AS head FROM b),
u AS (SELECT *, regexp_extract(head, '(?s)^(.*{ENDING})', 1) AS upto FROM h),
z AS (SELECT *, CASE WHEN regexp_matches(head, '{ENDING}\\s*$') OR upto = '' OR length(head) - length(upto) >= 220 THEN head ELSE {STRIP('upto')} END AS tail FROM u)
SELECT doc_id, chunk_index, CASE WHEN t = '' THEN '' WHEN length(tail) < 60 THEN whole ELSE tail END AS shown FROM z"""


@query("c13_clamp", CLAMP_SQL)
def _(spark, d):
    return chunk.chunks(docs(spark, d)).select("doc_id", "chunk_index", X.clamp_to_sentences(C("chunk_text")).alias("shown"))


@query(
    "c14_token_blocks",
    f"WITH w AS (SELECT doc_id, list_append({WORDS}, '</s>') AS t FROM documents), x AS (SELECT doc_id, unnest(t) AS t, generate_subscripts(t, 1) AS k FROM w), g AS (SELECT t, row_number() OVER (ORDER BY doc_id, k) - 1 AS p FROM x) "
    "SELECT CAST(p // 1024 AS BIGINT) AS block_no, array_to_string(list(t ORDER BY p), ' ') AS tokens FROM g GROUP BY p // 1024 HAVING count(*) = 1024",
)
def _(spark, d):
    return chunk.token_blocks(docs(spark, d), chunk.words(C("text"))).select("block_no", F.array_join("tokens", " ").alias("tokens"))


@query(
    "c15_text_blocks",
    f"WITH w AS (SELECT doc_id, regexp_extract_all({STRIP('text')} || ' </s>', '[^{SPACE}]+') AS t FROM documents), x AS (SELECT doc_id, unnest(t) AS t, generate_subscripts(t, 1) AS k FROM w), g AS (SELECT t, row_number() OVER (ORDER BY doc_id, k) - 1 AS p FROM x) "
    "SELECT CAST(p // 512 AS BIGINT) AS block_no, CAST(count(*) AS BIGINT) AS n, sha256(array_to_string(list(t ORDER BY p), ' ')) AS digest FROM g GROUP BY p // 512 HAVING count(*) = 512",
)
def _(spark, d):
    rows = chunk.token_blocks(docs(spark, d), chunk.words(X.strip(C("text"))), block=512)
    return rows.select("block_no", F.size("tokens").cast("long").alias("n"), F.sha2(F.array_join("tokens", " "), 256).alias("digest"))


@query("c16_truncate_pad", f"SELECT doc_id, array_to_string(list_concat({WORDS}[1:512], list_resize(CAST([] AS VARCHAR[]), greatest(0, 512 - len({WORDS})), '<pad>')), ' ') AS tokens FROM documents")
def _(spark, d):
    w = F.slice(chunk.words(C("text")), 1, 512)
    return docs(spark, d).select("doc_id", F.array_join(F.concat(w, F.array_repeat(F.lit("<pad>"), F.lit(512) - F.size(w))), " ").alias("tokens"))


@query("c17_corpus", f"SELECT doc_id, text FROM documents WHERE {STRIP('text')} <> ''")
def _(spark, d):
    return docs(spark, d).where(X.strip(C("text")) != "").select("doc_id", "text")


@query(
    "c18_open_chunks",
    f"WITH w AS (SELECT doc_id, {WORDS} AS w FROM documents), s AS (SELECT doc_id, w, unnest(CASE WHEN len(w) = 0 THEN [] ELSE range(0, greatest(1, len(w) - 40), 440) END) AS st FROM w) "
    "SELECT doc_id, CAST(st // 440 AS INTEGER) AS chunk_index, CAST(least(len(w), st + 480) - st AS INTEGER) AS chunk_words FROM s",
)
def _(spark, d):
    return chunk.chunks(docs(spark, d), size=480, overlap=40, backshift=False).select("doc_id", "chunk_index", "chunk_words")


NAMES = "CASE doc_id % 4 WHEN 0 THEN 'The New Yorker magazine' WHEN 1 THEN '<i>Wired magazine</i> (blog)' WHEN 2 THEN '\"The Daily Mail\"/UK' ELSE 'Reader''s ' || source END"
CHAIN_SQL = NAMES
for _old, _new in X.NAME_CHAIN:
    CHAIN_SQL = f"replace({CHAIN_SQL}, '{_old}', '{_new}')"


@query("c19_replace_chain", f"SELECT doc_id, {CHAIN_SQL} AS publication FROM documents")
def _(spark, d):
    return docs(spark, d).select("doc_id", X.replace_chain(F.expr(NAMES)).alias("publication"))


@query("c20_publication", f"SELECT doc_id, replace(trim(trim(split_part(split_part(replace(replace(replace(replace(replace({NAMES}, '<i>', ''), '</i>', ''), '<em>', ''), '<', ''), '>', ''), '/', 1), '(', 1)), '\"'), '''', '') AS publication FROM documents")
def _(spark, d):
    return docs(spark, d).select("doc_id", X.strip_publication(F.expr(NAMES)).alias("publication"))
