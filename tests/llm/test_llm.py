"""The training-data operators against brute force, SQL and the public tokenizer library."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from compare import same
from pyspark.sql import functions as F

import corpus_pipeline
from corpusmill.llm import bpe, components, jpeg, kernels, language, mixing, registry, simhash, suffix_dedup, token_counts, toxicity, url_filter, vectors

WORD = re.compile(r"[^\x20\x09-\x0d]+")
ODD = [None, "", " \t\n", "a", "A b", "é É ÉCOLE a\tb\x0bc  d", "x" * 5000, "word " * 3000, "漢字 👍 ﬁ ½\xa0y", "a" * 700]


def random_texts(n: int, seed: int = 3) -> list[str]:
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdé ") for _ in range(k)) for k in (250, 199, 200, 600)] + ["a" * 500, "xyz" * 150]
    text = lambda k: "".join(rng.choice("abcdé \n") for _ in range(k))
    return [text(rng.randint(0, 300)) + rng.choice(passages) + text(rng.randint(0, 300)) for _ in range(n)]


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls in ids and texts, empty and long texts, repeated rows, and columns with clashing names."""
    rows = [(k if k != 4 else None, t) for k, t in enumerate(ODD + random_texts(60))]
    rows += [rows[12], rows[12], (12, ODD[9]), rows[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return rows, df.selectExpr("doc_id", "text", "'l' AS lang", "'fp' AS fp", "1 AS n", "'r' AS runs", "2 AS key", "'s' AS score", "'m' AS mix")


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def ascii_lower(t: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def sorted_rows(rows):
    return sorted((tuple(r) for r in rows), key=repr)


# --- suffix-array dedup


def removed(texts: list[bytes]):
    count = collections.Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 199):
            if count[t[i : i + 200]] > 1:
                gone[i : i + 200] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        yield len(t), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()


@pytest.mark.parametrize("group", [suffix_dedup.MAX_GROUP, 3])
def test_suffix_dedup_equals_brute_force(odd_docs, monkeypatch, group):
    monkeypatch.setattr(suffix_dedup, "MAX_GROUP", group)
    rows, df = odd_docs
    want = [(d, *r) for (d, _), r in zip(rows, removed([(t or "").encode() for _, t in rows]), strict=True)]
    assert sorted_rows(suffix_dedup.digests(df).collect()) == sorted_rows(want)


def test_repeated_rows_are_one_row_with_a_count(spark):
    text = "".join(random.Random(4).choice("abcdef ") for _ in range(700))
    rows = [(None, text)] * 2000 + [(None, text[100:400] + "!"), (1, text)]
    got = suffix_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(d, *r) for (d, _), r in zip(rows, removed([t.encode() for _, t in rows]), strict=True)]
    assert sorted_rows(got) == sorted_rows(want)


def test_strip_repeats_keeps_columns_and_whole_characters(odd_docs, no_docs):
    rows, df = odd_docs
    out = suffix_dedup.strip_repeats(df)
    assert out.columns == df.columns and out.count() == len(rows)
    clean = {r["doc_id"]: r["text"] for r in out.collect()}
    assert clean[6] == "" and clean[7] == "" and clean[8] == ODD[8]
    assert suffix_dedup.strip_repeats(no_docs).count() == 0


def test_matching_statistics_equal_longest_matches():
    rng = random.Random(1)
    parts = ["".join(rng.choice("ab") for _ in range(rng.choice([200, 230, 300]))) for _ in range(6)]
    parts += [parts[0], parts[1][:210] + "c", "d" + parts[2][-205:]]
    data = np.frombuffer("".join(parts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    got = suffix_dedup.RunLengthIndex(data, offsets).statistics()
    count = collections.Counter(p[i : i + 200] for p in parts for i in range(len(p) - 199))
    for p, at in zip(parts, offsets, strict=False):
        for i in range(len(p) - 199):
            assert (got[at + i] >= 200) == (count[p[i : i + 200]] > 1)


def test_index_of_a_block_of_over_two_million_grams():
    """Ranks beyond 21 bits: the windows' order and matches are right."""
    rng = np.random.default_rng(2)
    size, n = 384, 8000  # 3 MB; nearly all 8-, 24- and 72-grams are different
    data = rng.integers(0, 256, n * size, dtype=np.uint8)
    again = rng.choice(n, 40, replace=False).reshape(20, 2)
    for a, b in again:  # 210 bytes in common: 11 windows each
        data[b * size + 100 : b * size + 310] = data[a * size + 50 : a * size + 260]
    index = suffix_dedup.RunLengthIndex(data, np.arange(n + 1) * size)
    assert index.ranks[0][1].max() >= 1 << 21
    order = index.order
    first = [data[order + k].astype(np.int64) for k in range(8)]
    lead = sum(x << (8 * (6 - k)) for k, x in enumerate(first[:7]))
    assert (lead[1:] >= lead[:-1]).all()
    want = {int(x) for a, b in again for x in (*range(a * size + 50, a * size + 61), *range(b * size + 100, b * size + 111))}
    assert set(np.flatnonzero(index.statistics() >= 200).tolist()) == want


# --- toxicity


def test_toxicity_finds_the_held_out(spark, no_docs):
    rng = random.Random(5)
    plain, bad = [f"w{k}" for k in range(300)], ["grumbleone", "grumbletwo", "snarlthree", "snarlfour"]
    rows, marks = [], []
    for k in range(900):
        toxic = k % 6 == 0
        words = [rng.choice(plain) for _ in range(40)] + [rng.choice(bad) for _ in range(4 * toxic)]
        rng.shuffle(words)
        rows.append((k, " ".join(words)))
        marks.append((k, int(toxic)))
    rows += [(900, None), (901, ""), (None, "x")]
    marks += [(900, None), (None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    out = toxicity.with_scores(docs, model).collect()
    good = [(r["score"] >= 0.7) == (r["doc_id"] % 6 == 0) for r in out if r["doc_id"] is not None and r["doc_id"] < 900 and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert len(out) == 903 and sum(good) / len(good) > 0.97 and all(0 <= r["score"] <= 1 for r in out)
    lone = toxicity.fit(docs, labels.where("toxic = 0"))
    assert len({r["score"] for r in toxicity.with_scores(docs, lone).collect()}) == 1
    assert toxicity.with_scores(no_docs, toxicity.fit(no_docs, labels)).count() == 0


def test_nnpu_risk_is_not_driven_below_zero():
    rng = np.random.default_rng(0)
    pos, unl = (rng.random((40, 8)) < 0.5).astype(np.float32), (rng.random((200, 8)) < 0.2).astype(np.float32)
    pos[:, 0], unl[:, 0] = 1, np.arange(200) < 40
    w, b = toxicity.nnpu(pos, unl, 0.2)
    z = unl @ w + b
    assert w[0] > 0 and z[:40].mean() > z[40:].mean() + 1


def test_risk_and_gradient_equal_plain_loops():
    rng = np.random.default_rng(1)
    x_p, x_u, w = (rng.random((7, 3)) < 0.5).astype(np.float32), (rng.random((11, 3)) < 0.5).astype(np.float32), rng.normal(size=4)
    loss = lambda z: math.log1p(math.exp(-z))

    def plain(w, prior):
        z = lambda row: sum(a * b for a, b in zip(row, w[:3], strict=True)) + w[3]
        first = prior * sum(loss(z(r)) for r in x_p) / 7
        return first, sum(loss(-z(r)) for r in x_u) / 11 - prior * sum(loss(-z(r)) for r in x_p) / 7

    for prior in (0.2, 0.95):
        zp, zu = x_p @ w[:3] + w[3], x_u @ w[:3] + w[3]
        terms = plain(w, prior)
        assert np.allclose(toxicity.risk(zp, zu, prior), terms)
        goal = (lambda v, p=prior: sum(plain(v, p))) if terms[1] >= 0 else (lambda v, p=prior: -plain(v, p)[1])
        steps = [(goal(w + 1e-5 * e) - goal(w - 1e-5 * e)) / 2e-5 for e in np.eye(4)]
        assert np.allclose(toxicity.gradient(x_p, x_u, zp, zu, prior), steps, atol=1e-4)


# --- vectors


def test_links_equal_all_pairs(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 16))
    x = np.concatenate([base, base[:20] + 0.05 * rng.normal(size=(20, 16)), base[:5] + 0.35 * rng.normal(size=(5, 16)), base[:3] * 2.0, base[:3]])
    rows = [(k, [float(y) for y in v]) for k, v in enumerate(x)]
    rows += [(200, None), (201, [0.0] * 16), (202, [float("nan")] * 16), (203, [1.0, None] * 8), (204, [1.0] * 3), (205, [float("inf")] * 16), (206, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rep", F.lit("clash"))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    label = np.arange(len(x))
    while not np.array_equal(new := np.minimum(label, np.where(near, label[None, :], 10**6).min(axis=1)), label):
        label = new
    want = {k: (int(near[k].sum()), int(label[k]), bool(label[k] == k)) for k in range(len(x))} | {k: (0, k, True) for k in range(200, 207)}
    for group in (vectors.GROUP, 20):
        got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors.link_vectors(df, group=group).collect()}
        assert got == want
    assert vectors.link_vectors(df.limit(0)).count() == 0
    few = [(None, [1.0, 0.0]), (None, [1.0, 0.01]), (None, [0.0, 1.0]), (7, [0.0, 1.0]), (5, [0.01, 1.0]), (None, None)]
    for kind in ("float", "double"):
        got = vectors.link_vectors(spark.createDataFrame(few, f"vec_id long, embedding array<{kind}>")).collect()
        assert sorted_rows(got) == sorted_rows([(None, 1, None, True), (None, 1, None, True), (None, 2, 5, False), (7, 2, 5, False), (5, 2, 5, True), (None, 0, None, True)])


def test_quantisation_bound_holds():
    x = np.random.default_rng(4).normal(size=(200, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q, s, e = vectors.quantise(x)
    about = (q.astype(float) @ q.T.astype(float)) * s[:, None] * s[None]
    assert (np.abs(about - x @ x.T) <= e[:, None] + e[None] + 3 * e[:, None] * e[None]).all()


# --- url rules


def test_url_rules_equal_a_plain_search(spark):
    rules = [*url_filter.QUERY_RULES, ("a.com", "/", "block"), ("a.com", "/x/y", "allow"), ("b.a.com", "/x", "block"), ("com", "/x/y/z", "block")]
    rng = random.Random(7)
    hosts = ["a.com", "b.a.com", "c.b.a.com", "xa.com", "com", "www.example.com", "example.com", "n.net", "a.com:80", ""]
    urls = [f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}{rng.choice(['', '/', '/x', '/x/y', '/x/y/z', '/en/1', '/es/', '/fr'])}{rng.choice(['', '?q=/en/', '#/en/'])}" for _ in range(300)] + [None, "", "nothing", "HTTP://A.COM/x", "a://b://c/en/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash"))
    for r in url_filter.judge(df, rules, shares=3).collect():
        rest = r["url"].split("://", 1)[1] if r["url"] and "://" in r["url"] else ""
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0]
        host = ascii_lower(host)
        fits = [x for x in rules if (host == x[0] or host.endswith("." + x[0])) and path.startswith(x[1])]
        best = max(fits, key=lambda x: (len(x[0] + x[1]), len(x[0])), default=None)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, best and best[0] + best[1], best[2] if best else "allow"), r["url"]
    assert url_filter.judge(df.limit(0), rules).count() == 0


# --- SimHash


def fingerprint(text, words=3):
    found = WORD.findall(ascii_lower(text or ""))
    parts = [" ".join(found[k : k + words]) for k in range(len(found) - words + 1)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def classes_of(items, linked):
    root = {k: k for k in items}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(items, 2):
        if linked(a, b):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {k: find(k) for k in items}


def test_fingerprints_and_classes_equal_brute_force(spark, odd_docs, no_docs):
    rows, df = odd_docs
    fps = simhash.fingerprints(df)
    assert sorted_rows((r["doc_id"], r["fp"] & (2**64 - 1)) for r in fps.collect()) == sorted_rows((d, fingerprint(t)) for d, t in rows)
    rng = random.Random(9)
    near = [(k, rng.getrandbits(64)) for k in range(40)]
    near += [(100 + k, f ^ sum(1 << b for b in rng.sample(range(64), rng.choice([0, 2, 3, 4])))) for k, (_, f) in enumerate(near)]
    table = spark.createDataFrame([(k, f - (1 << 64) if f >> 63 else f) for k, f in near], "doc_id long, fp long")
    want = classes_of([k for k, _ in near], lambda a, b: bin(dict(near)[a] ^ dict(near)[b]).count("1") <= 3)
    got = table.join(simhash.classes(table), "fp").collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert simhash.classes(simhash.fingerprints(no_docs)).count() == 0


@pytest.mark.parametrize(("hot", "differ"), [(8, 3), (20, 3), (8, 2)])
def test_hot_buckets_equal_brute_force(spark, hot, differ):
    """Families of near fingerprints, in buckets that are split into shares, and unrelated ones."""
    rng = np.random.default_rng(hot + differ)
    centres = rng.integers(0, 1 << 64, 3, dtype=np.uint64)
    flips = lambda n: sum(1 << int(k) for k in rng.choice(64, n, replace=False))
    fps = [int(centres[k % 3]) ^ flips(int(rng.integers(0, 6))) for k in range(600)] + [int(x) for x in rng.integers(0, 1 << 64, 100, dtype=np.uint64)]
    fps = sorted(set(fps))
    ids = rng.permutation(len(fps)).tolist()
    near = np.bitwise_count(np.array(fps, np.uint64)[:, None] ^ np.array(fps, np.uint64)) <= differ
    least = np.array(ids)
    while not np.array_equal(new := np.where(near, least, len(fps)).min(axis=1), least):
        least = new
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    table = spark.createDataFrame(list(zip(ids, signed, strict=True)), "doc_id long, fp long")
    got = {r["fp"]: r["component_id"] for r in simhash.classes(table, differ=differ, hot=hot).collect()}
    assert got == dict(zip(signed, least.tolist(), strict=True))
    nodes = table.withColumnRenamed("doc_id", "rep")
    masks = simhash.block_masks(differ)
    rows = nodes.select(F.explode(F.array(*[F.struct(F.lit(t).alias("tab"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key")) for t, m in enumerate(masks)])).alias("t"), "fp").select("t.*", "fp")
    counts = collections.Counter((t, x & m) for t, m in enumerate(masks) for x in signed)
    want = {(*k, n) for k, n in counts.items() if n > hot}
    assert want
    assert {(r["tab"], r["key"], r["n"]) for r in simhash.hot_buckets(nodes, rows, simhash.BLOCKS, masks, hot)[1].collect()} == want
    assert simhash.hot_buckets(nodes, rows, simhash.BLOCKS, masks, max(counts.values())) is None


def test_shares_are_linear():
    values = np.random.default_rng(1).integers(0, 1 << 64, 200, dtype=np.uint64)
    assert np.array_equal(simhash.share(values[:100] ^ values[100:], 9), simhash.share(values[:100], 9) ^ simhash.share(values[100:], 9))
    assert len(simhash.ball(0, 2)) == 1 + 64 + 64 * 63 // 2


def test_near_duplicates_equal_brute_force(spark, small, odd_docs, no_docs):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    sets = {}
    for r in docs.collect():
        w = WORD.findall(ascii_lower(r["text"]))
        sets[r["doc_id"]] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    want = set(classes_of(sorted(sets), lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])).values())
    assert {r["doc_id"] for r in simhash.drop_near_duplicates(docs).collect()} == want
    rows, df = odd_docs
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns and kept.where("doc_id = 12").count() <= 2 and kept.where("text = '' OR text IS NULL OR trim(text) = ''").count() == 1
    assert simhash.drop_near_duplicates(no_docs).count() == 0


def copies(kind: str, n: int, rng) -> tuple[list[str], list[str]]:
    """A text of n words and one with words added behind or cut off, at a similarity of 0.8 or a little more."""
    base = [f"w{k}" for k in rng.integers(0, 10**6, n)]
    more = [f"x{k}" for k in rng.integers(0, 10**6, (n - 4) // 4)]
    return base, base + more if kind == "appended" else base[: 4 + -(-4 * (n - 4) // 5)]


def kept_of(spark, texts: list[str]) -> list[int]:
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sorted(r["doc_id"] for r in simhash.drop_near_duplicates(docs).collect())


@pytest.mark.parametrize("kind", ["appended", "truncated"])
def test_near_duplicates_with_a_passage_more_or_less(spark, kind):
    """All pairs at 0.8 or more link, however few word fingerprints share a block."""
    rng = np.random.default_rng(11)
    texts = [" ".join(t) for n in rng.integers(60, 600, 60).tolist() for t in copies(kind, n, rng)]
    shingles = [set(zip(*(t.split()[k:] for k in range(5)))) for t in texts]
    alike = lambda a, b: len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b])
    want = sorted(set(classes_of(range(len(texts)), alike).values()))
    assert len(want) == 60 and kept_of(spark, texts) == want


@pytest.mark.parametrize("chunk", [simhash.CHUNK, 7])
def test_groups_of_near_copies_equal_all_pairs(spark, monkeypatch, chunk):
    """Groups of near copies around 0.8, in one task or dealt out in chunks: the result is that of all pairs."""
    rng = np.random.default_rng(7)
    texts = []
    for _ in range(3):
        base = [f"w{k}" for k in rng.integers(0, 5000, 120)]
        for _ in range(40):
            copy = list(base)
            for at in rng.choice(120, int(rng.integers(1, 4)), replace=False):
                copy[at] = f"x{rng.integers(0, 10**6)}"
            texts.append(" ".join(copy))
    shingles = [set(zip(*(t.split()[k:] for k in range(5)))) for t in texts]
    want = classes_of(range(len(texts)), lambda a, b: len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b]))
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    assert kept_of(spark, texts) == sorted(set(want.values()))


def test_short_near_duplicates(spark):
    """Texts of 8 and 9 words (4 and 5 shingles, similarity 0.8) link, whatever their fingerprints."""
    rng = np.random.default_rng(12)
    texts = []
    for _ in range(60):
        words = [f"w{k}" for k in rng.integers(0, 10**6, 9)]
        texts += [" ".join(words), " ".join(words[:8])]
    assert kept_of(spark, texts) == list(range(0, 120, 2))


def test_meeting_pairs_are_all_pairs_across_parts():
    rng = np.random.default_rng(5)
    group, part = rng.integers(0, 6, 80), rng.integers(0, 4, 80)
    order = np.lexsort((part, group))
    group, part = group[order], part[order]
    got = [(int(a), int(b)) for i, j in simhash._across(group, part) for a, b in zip(i, j, strict=True)]
    assert sorted(got) == [(a, b) for a in range(80) for b in range(a + 1, 80) if group[a] == group[b] and part[a] != part[b]]


def test_parities_differ_in_no_more_than_the_sets():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (3, 200, 260, 300, 900)]
    sets += [np.unique(np.concatenate([s[: int(0.9 * len(s))], rng.integers(0, 1 << 63, k).astype(np.uint64)])) for k, s in enumerate(sets)]
    parities = simhash.Parities(np.array(simhash._parities(np.concatenate(sets), np.array([len(s) for s in sets])).to_pylist(), dtype=object))
    i, j = (np.array(x) for x in zip(*itertools.combinations(range(len(sets)), 2), strict=True))
    apart = [len(np.setxor1d(sets[a], sets[b])) for a, b in zip(i, j, strict=True)]
    differ = parities.differ(i, j)
    assert (differ <= apart).all() and (differ[(i + 5) == j] > 0)[1:].all()


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(300 + k, 301 + k) for k in range(30)]
    want = classes_of(sorted({x for e in edges for x in e}), lambda a, b, s=set(edges) | {e[::-1] for e in edges}: (a, b) in s)
    got = {r["id"]: r["component_id"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: c for k, c in want.items() if k != c}


# --- mixing


def test_mixing_targets_and_tree():
    sizes = [("a", 100), ("b", 1000), ("c", 10), (None, 0)]
    goal = mixing.targets(sizes)
    assert goal[0] == 300 and goal[2] <= 30 and goal[3] == 0 and math.isclose(sum(goal), 1110)
    quotas = mixing.split_tree([5, 0, 17, 100], 7)
    assert len(quotas) == 7 and np.sum(quotas, axis=0).tolist() == [5, 0, 17, 100] and max(map(sum, quotas)) - min(map(sum, quotas)) <= 1


@pytest.mark.parametrize("split_last", [True, False])
def test_mixing_takes_its_targets(spark, no_docs, split_last):
    rng = random.Random(1)
    rows = [(k, " ".join(["w"] * rng.randrange(30)), rng.choice(["a", "a", "a", "b", "c", None])) for k in range(300)] + [(7, None, "a"), (7, "x y", "a"), (7, "x y", "a"), (None, "z", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    out = mixing.mix(docs, split_last=split_last).collect()
    again = mixing.mix(docs, split_last=split_last).collect()
    assert sorted_rows((r["doc_id"], r["mix"]["taken"]) for r in out) == sorted_rows((r["doc_id"], r["mix"]["taken"]) for r in again) and len(out) == len(rows)
    for source in ("a", "b", "c", None):
        mine = [r["mix"] for r in out if r["source"] == source]
        assert abs(sum(m["taken"] for m in mine) - mine[0]["target"]) <= (0.5 if split_last else 30) and all(m["taken"] <= 3 * m["size"] for m in mine)
        assert sum(m["size"] for m in mine) == mine[0]["source_size"]
    assert mixing.mix(no_docs).count() == 0


def test_mixing_draws_are_the_trees(spark, monkeypatch):
    """Each shard gets of each source as many blocks as the tree says, long digits and short ones alike."""
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 3)  # blocks of five digits at most
    trees = []
    real = mixing.split_runs
    monkeypatch.setattr(mixing, "split_runs", lambda counts, shards: trees.append((counts, list(real(counts, shards)))) or trees[-1][1])
    rows = [(k, "w " * (1 + k % 3), "abc"[min(k % 7, 2)]) for k in range(400)]
    for first in (1, 3):
        monkeypatch.setattr(mixing, "FIRST_DIGITS", first)
        out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), shards=9, name="m").collect()
        (counts, tree), names = trees.pop(), sorted({r["source"] for r in out})
        digits = {x: next(k for k in range(9) if sum(r["m"]["size"] for r in out if r["source"] == x) <= 3 * 16**k) for x in names}
        block = lambda r: hashlib.md5(f"mix-1:{r['doc_id']}".encode()).hexdigest()[: digits[r["source"]]]
        seen = {(r["source"], block(r), d["epoch"], d["shard"]) for r in out for d in r["m"]["draws"]}
        assert len({x[:3] for x in seen}) == len(seen)  # a block goes to one shard in each epoch
        got = collections.Counter((shard, names.index(source)) for source, _, _, shard in seen)
        assert got == {(shard, n): k for shard, of, have in tree for n, k in zip(of.tolist(), have.tolist(), strict=True)}
        assert sum(got.values()) == sum(counts) and all(sum(x["words"] for x in r["m"]["draws"]) == r["m"]["taken"] for r in out)


# --- BPE


def test_bpe_equals_the_library(spark, odd_docs, no_docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(2)
    more = ["don't 'TIS we'll İstanbul ΣΑΣ Σ", "a<|endoftext|>b <|startoftext|> <|endof", "\xa0", "x \x1c z\x85", "1234 ½ ١٢ 漢字かな 👩‍👩‍👧 %%%***"]
    more += ["".join(rng.choice("aAbé'sStre lld1½\n\xa0Σßﬁ漢👍,.-") for _ in range(60)) for _ in range(100)]
    rows, df = odd_docs
    rows = rows + [(1000 + k, t) for k, t in enumerate(more)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted_rows(bpe.encode(df).collect()) == sorted_rows(want)
    long = ["a" * 100_000 + "b", "".join(rng.choice("abcdefgh") for _ in range(1_000_000)), "é漢" * 30_000]
    for t in long:
        assert bpe.encoder(bpe.default_path()).ids(t) == library.encode(t, add_special_tokens=False).ids
    packed = {r["doc_id"]: np.frombuffer(r["ids"], "<u2").tolist() for r in bpe.encode_rows(df).collect()}
    assert packed[1001] == library.encode(more[1], add_special_tokens=False).ids and packed[1] == []
    assert bpe.encode(no_docs).count() == 0


# --- language


def test_language_by_text_and_by_evidence(spark, small):
    pages, docs = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("pages", "documents"))
    out = language.identify(pages, docs)
    right = out.join(docs.select("doc_id", "lang"), "doc_id").where("predicted = lang").count()
    assert right >= 0.97 * docs.count() and out.count() == pages.count() + docs.count()
    odd = spark.createDataFrame([(1, None, None), (2, "http://h.de/", ""), (2, "http://h.de/", ""), (3, "x", '<html lang="fr"><b>')], "page_id long, url string, html string").withColumn("z", F.lit(1))
    rows = language.identify(pages.unionByName(odd.drop("z")), docs).where("page_id < 4 AND kind = 'page'").collect()
    assert len(rows) >= 4 and all(0 <= r["confidence"] <= 1 and r["predicted"] for r in rows)
    assert language.identify(pages.limit(0), docs.limit(0)).count() == 0


# --- JPEG


def plain_decode(media: bytes) -> list[int]:
    """All coefficients of a picture, bit by bit."""
    p = jpeg.parse(media)
    tree = {}
    for k, t in p.tables.items():
        code, at, own = 0, 16, {}
        for n in range(1, 17):
            for _ in range(t[n - 1]):
                own[format(code, f"0{n}b")] = t[at]
                code, at = code + 1, at + 1
            code *= 2
        tree[k] = own
    out = []
    for part in re.split(rb"\xff[\xd0-\xd7]", media[p.scan[0] : p.scan[1]]):
        bits = iter("".join(format(b, "08b") for b in part.replace(b"\xff\0", b"\xff")))

        def symbol(table, bits=bits):
            code = ""
            while code not in table:
                code += next(bits)
            return table[code]

        def value(n, bits=bits):
            raw = "".join(next(bits) for _ in range(n))
            return 0 if not n else int(raw, 2) if raw[0] == "1" else int(raw, 2) - (1 << n) + 1

        dc = collections.Counter()
        for part_no, d, a in p.blocks * (p.restart or p.grid[0] * p.grid[1]):
            block = [0] * 64
            dc[part_no] += value(symbol(tree[0, d]))
            block[0], k = dc[part_no], 0
            while k < 63:
                s = symbol(tree[1, a])
                if s == 0:
                    break
                k += (s >> 4) + 1
                block[k] = value(s & 15) if s & 15 else 0
            out += block
    return out


def test_language_of_held_out_documents(spark, small):
    pages, docs = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("pages", "documents"))
    hidden = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    out = language.identify(pages, docs.withColumn("lang", F.when(~hidden, F.col("lang"))).withColumn("k", F.lit("clash")).withColumn("z", F.lit(0)))
    rows = out.join(docs.where(hidden).select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) > 50 and sum(r["predicted"] == r["lang"] for r in rows) >= 0.96 * len(rows)


def test_fusion_equals_a_plain_one(spark):
    rng = random.Random(8)
    hosts = [("a.x.de", "x.de", "de"), ("b.x.de", "x.de", "de"), ("c.org", "c.org", "org"), (None, None, None)]
    rows = [(k, *rng.choice(hosts), rng.choice([None, "fr", "de"]), [rng.gauss(0, 2) for _ in range(3)]) for k in range(40)]
    rows = [(k, h, d, s, c, z) for k, h, d, s, c, z in rows]
    df = spark.createDataFrame(rows, "id long, host string, domain string, suffix string, declared string, z array<double>")
    soft = lambda z: [math.exp(x) / sum(map(math.exp, z)) for x in z]
    p = {r[0]: soft(r[5]) for r in rows}

    def shares(of, parent):
        """Of the records in ``of``, drawn towards ``parent``."""
        sums = [sum(p[k][n] for k in of) for n in range(3)]
        return [(x + language.STRENGTH * q) / (sum(sums) + language.STRENGTH) for x, q in zip(sums, parent, strict=True)]

    for r in language.fuse(df, ["de", "en", "fr"]).collect():
        others = [x for x in rows if x[0] != r["id"]]
        like = lambda n, v, others=others: [x[0] for x in others if x[n] == v]
        base = shares([x[0] for x in others], [1 / 3] * 3)
        prior = shares([x[0] for x in others if (x[1], x[2]) == (r["host"], r["domain"])], shares(like(2, r["domain"]), base)) if r["host"] else base
        z = [a + math.log(b) for a, b in zip(r["z"], prior, strict=True)]
        for n, column in ((4, "declared"), (3, "suffix")):
            if r[column]:
                z = [a + math.log(b / q) for a, b, q in zip(z, shares(like(n, r[column]), base), base, strict=True)]
        assert np.allclose(r["post"], soft(z)) and r["predicted"] == ["de", "en", "fr"][int(np.argmax(z))]


def test_language_learns_every_label(spark):
    """More than 64 labels, the rarest of one document among them."""
    word = lambda k: " ".join(chr(97 + (k + a) % 26) + chr(97 + k // 26) + chr(97 + (k * 7 + a) % 26) for a in range(5))
    rows = [(3 * k + c, f"{word(k)} " * 20, f"l{k:02}", None) for k in range(70) for c in range(3 if k < 69 else 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    names, table = language.train(docs)
    assert names == [f"l{k:02}" for k in range(70)] and table.shape == (language.BUCKETS, 70)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    got = {r["doc_id"]: r["predicted"] for r in language.identify(pages, docs).collect()}
    assert got == {d: label for d, _, label, _ in rows}


def test_jpeg_round_trip_and_a_plain_decoder(odd_docs, no_docs):
    raw = [b"", b"\xff" * 500, bytes(range(256)) * 3, b"x" * 60000]
    batch = pa.RecordBatch.from_arrays([pa.array(raw, pa.binary())], names=["text"])
    for i, j, data, offsets in kernels.text_slices(batch):
        media = jpeg.encode(*jpeg.padded(data, offsets))
        for k, c in zip(range(i, j), jpeg.decode(media), strict=True):
            p = jpeg.parse(media[k - i])
            assert jpeg.payload_of(c, p.units) == raw[k] + b" " * (-len(raw[k]) % 192 or (0 if raw[k] else 192))
            if k < 3:
                assert plain_decode(media[k - i]) == c.ravel().tolist()
    rows, df = odd_docs
    for r in jpeg.media_columns(df).where("doc_id IS NOT NULL").collect():
        own = [(t or "").encode() for d, t in rows if d == r["doc_id"]]
        pads = [t + b" " * (-len(t) % 192 or (0 if t else 192)) for t in own]
        hit = [p for p in pads if hashlib.sha256(p).hexdigest() == r["payload_sha256"]]
        assert hit and r["tail_crc32"] == zlib.crc32(hit[0][-16:]) and r["media_sha256"] == hashlib.sha256(bytes(r["media"])).hexdigest() and r["payload_bytes"] == len(hit[0])
    assert jpeg.media_columns(no_docs).count() == 0


@pytest.mark.parametrize("n", [1, 256, 257, 256 * 8191, 256 * 8191 + 1, 8191 * 8191])
def test_jpeg_sides_fit_16_bits(n):
    w, h = jpeg.grid(n)
    assert 8 * w < 1 << 16 and 8 * h < 1 << 16 and w * (h - 1) < n <= w * h and (w == min(n, 256) or n > 256 * 8191)


def test_jpeg_reader_takes_runs_and_no_restarts():
    """Other tables: DC categories 0 and 2, AC end of block, run 3 of size 1, and sixteen zeros; no restarts."""
    dc = bytes([0, 2] + [0] * 14) + bytes([0, 2])
    ac = bytes([0, 3] + [0] * 14) + bytes([0x00, 0x31, 0xF0])
    head = b"\xff\xd8" + jpeg._segment(jpeg.SOF0, bytes([8, 0, 8, 0, 16, 1, 1, 0x11, 0])) + jpeg._segment(jpeg.DHT, b"\0" + dc) + jpeg._segment(jpeg.DHT, b"\x10" + ac) + jpeg._segment(jpeg.SOS, bytes([1, 1, 0, 0, 63, 0]))
    bits = "01" + "10" + "01" + "1" + "10" + "01" + "0" + "00" + "00" + "00"
    bits += "1" * (-len(bits) % 8)
    media = head + int(bits, 2).to_bytes(len(bits) // 8, "big") + b"\xff\xd9"
    (c,) = jpeg.decode([media])
    want = np.zeros((2, 1, 64), int)
    want[0, 0, [0, 4, 24]], want[1, 0, 0] = [2, 1, -1], 2
    assert np.array_equal(c, want) and np.array_equal(c.ravel(), plain_decode(media))


# --- token counts


def test_token_counts_equal_the_plain_recurrence(spark, odd_docs, no_docs, small):
    model = token_counts.unigram(token_counts.default_path())
    rows, df = odd_docs
    texts = [t for _, t in rows] + [r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").limit(20).collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
    memo = {}
    for r in token_counts.token_counts(df).collect():
        found = (texts[r["doc_id"]] or "").encode().split()
        assert r["n_pretokens"] == len(found)
        assert r["n_tokens"] == sum(memo.setdefault(w, model.alone(b" " + w)) for w in found)
    assert token_counts.token_counts(no_docs).count() == 0


def test_token_counts_equal_all_segmentations():
    """Against every segmentation of short words, scored from the vocabulary file alone."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    own = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    own = [p.replace("▁", " ").encode() for p in own if "▁" not in p[1:]]
    score = {p: -round(math.log(k + 2) * 2**20) for k, p in reversed(list(enumerate(own)))}
    lone = -round(math.log(10**12 + 1) * 2**20)
    words = [b"the", b"zqxj", b"token", "é漢".encode(), b"aaaa", b"ing", b"h", b"wordpiece"]

    def plain(word):
        best = None
        for cuts in itertools.product((0, 1), repeat=len(word) - 1):
            at = [0, *[k + 1 for k, c in enumerate(cuts) if c], len(word)]
            parts = [word[a:b] for a, b in itertools.pairwise(at)]
            if all(p in score or len(p) == 1 for p in parts):
                got = sum(max(score.get(p, lone), lone) if len(p) == 1 else score[p] for p in parts), -len(parts)
                best = max(best or got, got)
        return -best[1]

    data = np.frombuffer(b"\n".join(words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    with np.errstate(over="ignore"):
        got = token_counts.Unigram(token_counts.pieces(token_counts.default_path())).word_counts(data, ends - [len(w) for w in words], ends)
    assert got.tolist() == [plain(b" " + w) for w in words]


# --- clashing names


CLASH = ("k", "l", "n", "id", "fp", "key", "rep", "row", "runs", "size", "mix", "score", "text2", "part", "node", "did", "th", "no", "blk", "a.b", "with space")


def test_clashing_and_odd_column_names(spark):
    """Extra columns of the operators' own names, and names that need quoting, change nothing."""
    texts = random_texts(12) + [None, "", "one two three four five six seven"] * 2
    docs = spark.createDataFrame([(k, t, "en" if k % 2 else "de", "s") for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    odd = docs.select("*", *[F.lit(c).alias(c) for c in CLASH])
    labels = spark.createDataFrame([(k, k % 2) for k in range(12)], "doc_id long, toxic int")
    pages = spark.createDataFrame([(1, "http://a.net/es/", "<p>x")], "page_id long, url string, html string")
    e = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1])], "vec_id long, embedding array<float>")
    more = lambda df: df.select("*", *[F.lit(c).alias(c) for c in CLASH])
    for plain, with_more in (
        (suffix_dedup.digests(docs), suffix_dedup.digests(odd)),
        (suffix_dedup.strip_repeats(docs), suffix_dedup.strip_repeats(odd).select(docs.columns)),
        (toxicity.with_scores(docs, toxicity.fit(docs, labels)), toxicity.with_scores(odd, toxicity.fit(odd, more(labels))).select(*docs.columns, "score")),
        (vectors.link_vectors(e), vectors.link_vectors(more(e))),
        (url_filter.judge(pages, url_filter.QUERY_RULES), url_filter.judge(more(pages), url_filter.QUERY_RULES).select(*pages.columns, "host", "path", "rule", "verdict")),
        (simhash.fingerprints(docs), simhash.fingerprints(odd)),
        (simhash.drop_near_duplicates(docs), simhash.drop_near_duplicates(odd).select(docs.columns)),
        (mixing.mix(docs), mixing.mix(odd).select(*docs.columns, "mix")),
        (bpe.encode(docs), bpe.encode(odd)),
        (language.identify(pages, docs), language.identify(more(pages), odd)),
        (jpeg.media_columns(docs), jpeg.media_columns(odd)),
        (token_counts.token_counts(docs), token_counts.token_counts(odd)),
    ):
        assert sorted_rows(plain.collect()) == sorted_rows(with_more.collect())


# --- queries and the pipeline


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_query_equals_sql(spark, small, name):
    same(registry.queries()[name](spark, small), registry.oracle_sql()[name], small)


def test_pipeline_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "suffix_dedup", "mixing", "bpe"]
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        new = corpus_pipeline.cut(stage(spark, docs, small))
        if name != "bpe":
            assert new.dtypes == docs.dtypes
        seen.append({r["doc_id"] for r in new.select("doc_id").collect()})
        docs = new
    dropped = {r["doc_id"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()} - seen[0]
    assert all(labels.get(d, 1) for d in dropped) and seen[1] <= seen[0] and seen[2] == seen[1] and seen[3] <= seen[2] and seen[4] == seen[3]
    empty = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, small).count() == 0
