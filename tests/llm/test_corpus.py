"""The corpus operators against brute force, exact round trips and held-out
labels, on small fixtures with nulls, ties, repeats and extra columns."""

import hashlib
import os
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tallyspark.llm import (
    common,
    external_shuffle,
    license_scan,
    mil_quality,
    multi_index,
    packing,
    permutation_index,
    pii_crf,
    queries,
    raking,
    simhash,
    warc,
)

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
DOC = "doc_id long, text string, lang string, source string, n_chars long, shard int, h string, bucket string"


def docs_of(spark, tmp_path, texts, ids=None):
    """Rows with clashing extra columns, read from files as in production."""
    rows = [(i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else "s", len(t or ""), 7, "x", None)
            for k, (i, t) in enumerate(zip(ids or range(len(texts)), texts))]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, DOC).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


ODD = [None, "", " \n\t", "one", "one two", "a b c d", "a b c d", "A B c d", "x" * 5000, "w " * 20000,
       "Mail me: a.b@c.de or +1 (555) 123-4567. Again 123-4567, and 10.0.0.1!", "é ü | 3 MIT License"]


# -- components ---------------------------------------------------------------
def test_components_path_star_and_none(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(1, k) for k in range(200, 260)]
    got = dict(common.components(spark.createDataFrame(path + star, "a long, b long")).collect())
    assert all(got[k] == 100 for k in range(100, 141)) and all(got[k] == 1 for k in range(200, 260))
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("same", [True, False])
def test_spanning_links_connect_what_the_matrix_connects(same):
    rng = np.random.default_rng(3)
    m = rng.random((30, 30)) < 0.05
    if same:
        m |= m.T
    n = 30 if same else 60

    def groups(pairs):
        own = list(range(n))
        for i, j in pairs:
            j = j if same else j + 30
            a, b = own[i], own[j]
            own = [a if o == b else o for o in own]
        return {frozenset(k for k in range(n) if own[k] == o) for o in own}

    links = common.spanning_links(m, same)
    assert all(m[i, j] for i, j in links) and len(links) < n
    assert groups(links) == groups(zip(*np.nonzero(m)))


# -- 5 SimHash ----------------------------------------------------------------
def slow_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    s = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


@pytest.mark.parametrize("text", [t for t in ODD if t is None or len(t) < 100])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize("light,block", [(64, 4096), (2, 5)])
def test_links_reach_every_pair(spark, light, block):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 62, 6)
    fps = {int(c) ^ (1 << int(a)) ^ (1 << int(b)) for c in centres for a, b in rng.integers(0, 62, (40, 2))} | {0, 3, -1}
    fps = sorted(fps)
    got = common.components(simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), 2, light, block))
    got = dict(got.collect())
    own = {f: f for f in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if own[a] > own[b] and bin((a ^ b) & (1 << 64) - 1).count("1") <= 2:
                    own[a], changed = own[b], True
    assert {f: got.get(f, f) for f in fps} == own


def test_simhash_rows(spark, tmp_path):
    docs = docs_of(spark, tmp_path, ODD + ["a b c d"], [*range(len(ODD)), 5])
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == 13
    own = {r.doc_id: r.component_id for r in rows}
    assert own[1] == own[2] == own[0] == 0 and own[5] == own[6] == own[7] == 5
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 5").count() == 1
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


# -- 2 shuffle ----------------------------------------------------------------
def test_shards(spark, tmp_path):
    docs = docs_of(spark, tmp_path, ODD * 20, [None if i % 7 == 0 else i % 50 for i in range(240)])
    out = external_shuffle.write_shards(docs, 7, str(tmp_path / "out"), bucket_bytes=30000)
    rows = [(r.shard, r.slot, tuple(r.doc)) for r in out.collect()]
    sizes = [sum(s == k for s, _, _ in rows) for k in range(7)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(t for s, t, _ in rows if s == k) == list(range(sizes[k])) for k in range(7))
    assert sorted(map(repr, (d for _, _, d in rows))) == sorted(repr(tuple(r)) for r in docs.collect())
    again = external_shuffle.write_shards(docs, 7, str(tmp_path / "again"), bucket_bytes=30000)
    assert sorted(map(repr, rows)) == sorted(repr((r.shard, r.slot, tuple(r.doc))) for r in again.collect())
    assert external_shuffle.write_shards(docs.limit(0), 7, str(tmp_path / "none")).count() == 0
    digest = {r.text_crc32: r.size for r in external_shuffle.shard_digest(docs).collect()}
    assert digest[0] == 8 and digest[zlib.crc32(b"one")] == 11


# -- 1, 4 vectors -------------------------------------------------------------
def vectors_of(spark, n=300, dim=8):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(n, dim)).round(3)
    x[::3] = x[0] + rng.normal(scale=0.05, size=x[::3].shape).round(3)
    x[40:50] = x[40]
    rows = [(i, [float(v) for v in r], i % 2) for i, r in enumerate(x)]
    rows += [(1000, None, 0), (1020, [0.0] * dim, 0), (1040, [float("nan")] * dim, 1), (1060, [1.0], 1),
             (None, [1.0] * dim, 0), (1080, [1.0, None] * (dim // 2), 0), (1100, [1.0] * dim, None)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), x


def test_permutation_search_is_exact_when_all_is_shortlisted(spark):
    df, x = vectors_of(spark)
    got = permutation_index.search(df, F.col("vec_id") % 20 == 0, k=5, n_pivots=16, prefix=8, shortlist=1.0,
                                   block_rows=90, chunk_rows=7).collect()
    ids = np.r_[np.arange(300), 1100]
    x = np.vstack([x, np.ones(8)])
    for q in (0, 20, 40, 280, 1100):
        score = (x * x[ids == q]).sum(axis=1)
        best = [ids[i] for i in np.lexsort((ids, -score)) if ids[i] != q][:5]
        assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == best
    assert permutation_index.search(df.limit(0), F.lit(True)).count() == 0


def test_permutation_recall(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 32))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = permutation_index.search(df, F.col("vec_id") % 60 == 0, k=20, block_rows=1500).collect()
    hits = 0
    for q in range(0, 3000, 60):
        score = x @ x[q]
        score[q] = -np.inf
        hits += len({r.vec_id for r in got if r.query_id == q} & set(np.argsort(-score)[:20].tolist()))
    assert hits / (50 * 20) >= 0.9


@pytest.mark.parametrize("sigma", [0.3, 1.0])
def test_permutation_recall_when_norms_differ(spark, sigma):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 32)) * rng.lognormal(0, sigma, size=(3000, 1))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = permutation_index.search(df, F.col("vec_id") % 60 == 0, k=20, block_rows=1500).collect()
    hits = 0
    for q in range(0, 3000, 60):
        score = x @ x[q]
        score[q] = -np.inf
        hits += len({r.vec_id for r in got if r.query_id == q} & set(np.argsort(-score)[:20].tolist()))
    assert hits / (50 * 20) >= 0.9


def test_every_vector_length_takes_part(spark):
    df, x = vectors_of(spark)
    short = [(i, [float(v) for v in x[i - 2000, :3]], i % 2) for i in range(2000, 2300)] + [(2400, [2e200], 0),
                                                                                            (2420, [-1e-200], 0)]
    both = df.where("vec_id is not null").union(spark.createDataFrame(short, df.schema))
    got = permutation_index.search(both, F.col("vec_id") % 20 == 0, k=4, shortlist=1.0).collect()
    ids, y = np.arange(2000, 2300), x[:, :3]
    for q in (2000, 2040, 2280):
        score = (y * y[ids == q]).sum(axis=1)
        best = [ids[i] for i in np.lexsort((ids, -score)) if ids[i] != q][:4]
        assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == best
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == 2400] == [1060, 2420]
    links = {r.vec_id: r for r in multi_index.near_duplicates(both, 0.93, codes=4).collect()}
    alone = {r.vec_id: r for r in multi_index.near_duplicates(both.where("size(embedding) = 3"), 0.93, codes=4).collect()}
    assert all(links[i] == alone[i] for i in range(2000, 2300)) and links[2044].n_links >= 4
    assert len(links) == both.count() and links[2400].n_links == 0


@pytest.mark.parametrize("block", [2048, 16])
def test_multi_index_links(spark, block):
    df, x = vectors_of(spark)
    got = {r.vec_id: r for r in multi_index.near_duplicates(df, 0.93, codes=4, block_rows=block).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = (u @ u.T >= 0.93) & (np.arange(300)[:, None] % 2 == np.arange(300)[None, :] % 2)
    np.fill_diagonal(linked, False)
    links = np.array([got[i].n_links for i in range(300)])
    assert (links <= linked.sum(axis=1)).all() and links.sum() >= 0.95 * linked.sum()
    assert all(got[i].component_id == i and got[i].n_links == 0 for i in (1000, 1020, 1040, 1060, 1080, 1100))
    assert all(got[i].n_links >= 4 for i in range(40, 50)) and not got[None].kept
    assert multi_index.near_duplicates(df.limit(0)).count() == 0


# -- 3 quality ----------------------------------------------------------------
def test_quality_held_out(spark):
    docs, labels = (common.read(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    got = mil_quality.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(got) > 50 and np.mean([r.predicted == r.quality for r in got]) >= 0.95


def test_quality_edges(spark, tmp_path):
    docs = docs_of(spark, tmp_path, ODD, [None, *range(1, len(ODD))])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)] + [(3, None, 0), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = mil_quality.quality_scores(docs, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in mil_quality.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert mil_quality.quality_scores(docs.limit(0), labels).count() == 0


def test_training_takes_one_text_of_a_repeated_id(spark, tmp_path):
    rows = [f"text {i % 9}." for i in range(400)] + ["a | b | c"] * 20
    docs = docs_of(spark, tmp_path, rows, [2] * 400 + [*range(100, 120)])
    labels = spark.createDataFrame([(i, int(i == 2), 0) for i in (2, *range(100, 120))],
                                   "doc_id long, quality int, toxic int")
    once = docs.where("doc_id <> 2 or text = 'text 0.'").dropDuplicates(["doc_id", "text"])
    a, b = (mil_quality.train(d, labels) for d in (docs, once))
    assert all(np.array_equal(getattr(a, n), getattr(b, n)) for n in a.NAMES)


def test_training_counts_documents_not_label_rows(spark, tmp_path):
    docs = docs_of(spark, tmp_path, [f"text {i}." + " a | b" * (i % 2) for i in range(40)])
    once = [(i, i % 2, 0) for i in range(40)]
    many = once + [(i, i % 2, 0) for i in range(20) for _ in range(300)]
    a, b = (mil_quality.train(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int"), train_docs=25)
            for x in (once, many))
    assert all(np.array_equal(getattr(a, n), getattr(b, n)) for n in a.NAMES)


def test_style_does_not_depend_on_neighbours():
    texts = [(t or "").encode() for t in ODD]
    together = mil_quality.passage_style(texts)
    for one, t in zip(together, texts):
        assert np.allclose(one, mil_quality.passage_style([t])[0])
    assert [len(b) for b in together][9] == 250


def test_gradients():
    rng = np.random.default_rng(0)
    m = mil_quality.GatedAttention(4, 1)
    x, first, y = rng.normal(size=(9, 4)), np.array([0, 2, 6]), np.array([1.0, 0, 1])

    def loss():
        p = m.forward(x, first)[0]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    p, kept = m.forward(x, first)
    for name, g in zip(m.NAMES, m.gradients(y, p, kept)):
        value = getattr(m, name)
        at = (0,) * value.ndim
        value[at] += 1e-6
        up = loss()
        value[at] -= 2e-6
        assert abs((up - loss()) / 2e-6 - g[at]) < 1e-5
        value[at] += 1e-6


# -- 6 mixing -----------------------------------------------------------------
def test_raked_marginals(spark):
    cells = spark.createDataFrame([(a, b, c, 1 + 3 * i) for i, (a, b, c) in enumerate(
        (a, b, c) for a in ("x", "y", None) for b in ("en", "de") for c in ("p", "q"))],
        "source string, lang string, topic string, tokens long")
    targets = {"source": spark.createDataFrame([("x", .5), ("y", .3), (None, .2)], "source string, share double"),
               "lang": spark.createDataFrame([("en", .5), ("de", .5)], "lang string, share double"),
               "topic": spark.createDataFrame([("p", .25), ("q", .75)], "topic string, share double")}
    got = raking.rake(cells, targets).collect()
    total = sum(r.tokens for r in got)
    for dim, want in (("source", {"x": .5, "y": .3, None: .2}), ("topic", {"p": .25, "q": .75})):
        for v, share in want.items():
            assert abs(sum(r.weight for r in got if r[dim] == v) / total - share) < 1e-6


def test_mix_edges(spark, tmp_path):
    docs = docs_of(spark, tmp_path, ODD, [None, *range(1, len(ODD))])
    out = raking.mix(docs)
    assert out.columns == [*docs.columns, "__mix"] and out.count() == len(ODD)
    assert out.where("__mix.kept is null").count() == 0
    assert raking.mix(docs.limit(0)).count() == 0


def test_mixing_meets_the_raked_marginals(spark, tmp_path):
    langs = ["es"] * 60 + ["de"] * 240 + ["en"] * 5700
    rows = [(i, f"text {'|' if i % 50 == 0 else ''} {i:06d}", lang, "s") for i, lang in enumerate(langs)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "m"))
    docs = spark.read.parquet(str(tmp_path / "m"))
    out = corpus_pipeline.mixing(spark, docs, SF).select("lang", raking.topic_of(F.col("text")).alias("topic"),
                                                         raking.tokens_of(F.col("text")).alias("tokens")).collect()
    own = docs.select("lang", raking.topic_of(F.col("text")).alias("topic"), raking.tokens_of(F.col("text")).alias("tokens"))
    whole, all_tokens = sum(r.tokens for r in out), own.agg(F.sum("tokens")).first()[0]
    assert abs(whole / all_tokens - raking.KEEP_SHARE) < 0.03
    for dim in ("lang", "topic"):
        for r in raking.tempered(own, dim).collect():
            assert abs(sum(o.tokens for o in out if o[dim] == r[dim]) / whole - r.share) < 0.08 * r.share, (dim, r)


# -- 7 personal data ----------------------------------------------------------
def test_base_spans():
    text = ("a@b.c x@y 1.2.3.4, 256.1.1.1, 0300.1.1.1, 4111 1111 1111 1111, 4111111111111112, "
            "1 4111111111111111 1234, +49 (30) 1234-56, +1 23, é@é.de")
    got = [(k, text[a:b]) for k, a, b in pii_crf.base_spans(text)]
    assert got == [("email", "a@b.c"), ("ip", "1.2.3.4"), ("card", "4111 1111 1111 1111"), ("phone", "+49 (30) 1234-56")]


def test_base_spans_are_leftmost_and_linear():
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    rng = np.random.default_rng(4)
    for _ in range(4000):
        text = "".join(rng.choice(list("ab@@..-_12 "), 24))
        spans = pii_crf.base_spans(text)
        assert [s[1:] for s in spans if s[0] == "email"] == [m.span() for m in email.finditer(text)]
        text = "".join(rng.choice(list("12...5 "), 24))
        spans = pii_crf.base_spans(text)
        assert [s[1:] for s in spans if s[0] == "ip"] == [
            m.span() for m in ip.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    n = 300_000  # the square of this would not end
    assert pii_crf.base_spans("a" * n + " x@y.z " + "7" * n + ".1.1.1") == [("email", n + 1, n + 6)]
    assert pii_crf.base_spans("0" * 5000 + "1.1.1.1") == [("ip", 0, 5007)]


def test_skip_edges_carry_labels_and_leave_clean_texts(spark, tmp_path):
    phones = [f"Call +1 ({200 + i}) 555-{1000 + i} now, yes {i} times in {1900 + i}." for i in range(60)]
    texts = ODD + phones + ["We met 2021 times: +1 (333) 555-7777 is ours, so dial 555-7777 today in 2021.",
                            "No data 555-7777 here, but 2021 and 2021."]
    docs = docs_of(spark, tmp_path, texts)
    rows = {r.doc_id: r for r in pii_crf.personal_data(docs).collect()}
    n = len(texts)
    found = [texts[n - 2][int(a):int(b)] for _, a, b in (s.split(":") for s in rows[n - 2].spans.split(","))]
    assert found == ["+1 (333) 555-7777", "555-7777"] and rows[n - 2].n_phone == 1
    assert rows[n - 1].spans == "" and rows[0].spans == "" and rows[9].n_ip == 0
    assert rows[0].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii_crf.personal_data(docs.limit(0)).count() == 0
    assert pii_crf.redact("ab cd", [("ip", 0, 2), ("card", 1, 4)]) == "[IP]d"


@pytest.mark.parametrize("base,again", [
    ("+44 20 7946 0958", "020 7946 0958"), ("+442079460958", "020 7946 0958"), ("+44 20 7946 0958", "7946 0958"),
    ("+44 20 7946 0958", "(020) 7946-0958"), ("4111 1111 1111 1111", "4111.1111 1111.1111")])
def test_mentions_are_tied_whatever_their_grouping(spark, tmp_path, base, again):
    phones = [f"Call +1 ({200 + i}) 555-{1000 + i} now, yes {i} times in {1900 + i}." for i in range(60)]
    phones += [f"Pay 4111 1111 1111 1111 or 4111111111111111, {i}." for i in range(20)]
    texts = [*phones, f"Ours is {base}, since 2021. So dial {again}, 3 times in 2021 12 or 7947 0958."]
    text = texts[-1]
    model = pii_crf.train(docs_of(spark, tmp_path, texts))
    own = pii_crf.base_spans(text)
    more = pii_crf.added_spans(model, [text], [own])[0]
    assert [text[a:b].strip("()") for _, a, b in own] == [base]
    # a leading bracket is outside of a span, as with single tokens
    assert [text[a:b] for _, a, b in more] == [again.lstrip("(")]
    clean = text.replace(base, "nothing")
    assert pii_crf.added_spans(model, [clean], [pii_crf.base_spans(clean)]) == [[]]


# -- 8 licenses ---------------------------------------------------------------
def test_license_scan(spark, tmp_path):
    texts = ODD + ["Foo. Licensed under the Apache License, Version 2.0.\n" * 3, "license MIT licensé mit license",
                   "Licensed under the quite new Apache License, Version 2.0"]
    docs = docs_of(spark, tmp_path, texts)
    got = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    n = len(texts)
    assert (got[n - 3].n_base, got[n - 3].labels, got[n - 3].score) == (3, "apache,apache-notice", 1.0)
    assert (got[n - 2].n_base, got[n - 2].first_word, got[n - 2].labels) == (1, 3, "mit")
    assert got[n - 1].labels == "apache,apache-notice" and got[0].n_words == 0 and got[0].score == 0
    assert got[n - 4].base_labels == "mit" and got[n - 4].n_words == 5
    assert license_scan.scan(docs.limit(0)).count() == 0


def test_license_spans_are_verified(spark, tmp_path):
    gpl = license_scan.TEMPLATES["gpl-terms"]
    apache = "Licensed under the Apache License, Version 2.0."
    texts = ["The album was released under the Motown label", "Licensed under the Mozilla Public License, Version 2.0.",
             "License, Version 2.0. Under the Apache License, Licensed under the", gpl.replace("General", "Lesser General"),
             "licensed under the " * 40 + apache, "Released under the MIT License.", gpl,
             "released under the released under the mit license released under the"]
    eight = license_scan.default_templates(spark).where(F.col("name").isin(list(license_scan.TEMPLATES)))
    got = {r.doc_id: r for r in license_scan.scan(docs_of(spark, tmp_path, texts), eight).collect()}
    labels = [got[i].labels for i in range(len(texts))]
    assert labels[:4] == ["", "", "apache", "gpl"]
    assert [got[i].score for i in (0, 1)] == [0, 0]
    assert labels[4:] == ["apache,apache-notice", "mit,mit-notice", "gpl,gpl-terms", "mit,mit-notice"]
    assert [got[i].score for i in (4, 5, 6, 7)] == [1.0] * 4


def test_license_templates_are_a_parameter(spark, tmp_path):
    own = "You may sing this song wherever two or more people are gathered around a fire."
    names = list(license_scan.TEXTS)
    texts = [f"Copyright someone.\n{license_scan.TEXTS[n]}\nThe end." for n in names] + [f"Hear: {own}"]
    docs = docs_of(spark, tmp_path, texts)
    got = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    assert all(n in got[i].labels.split(",") and got[i].score == 1 for i, n in enumerate(names))
    for i, n in enumerate(names):
        if n.startswith(("cc", "lgpl", "agpl", "mpl", "bsd-e", "isc", "zlib", "unl")):  # "gpl" is a base label
            assert [x for x in got[i].labels.split(",") if x != "gpl"] == [n]
    assert got[len(names)].labels == ""
    song = spark.createDataFrame([("song", own)], "name string, text string")
    got = {r.doc_id: r.labels for r in license_scan.scan(docs, song).collect()}
    assert got[len(names)] == "song" and "mit-permission" not in got[0]
    with pytest.raises(ValueError, match="tiny"):
        license_scan.scan(docs, spark.createDataFrame([("tiny", "two words")], "name string, text string"))


# -- 9 packing ----------------------------------------------------------------
def test_pieces_hold_each_id_once(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path(packing.TOKENIZER)
    texts = ODD + ["it's Größe <|endoftext|> Ａ́ á b can't!" + "\x1c\x85 z"]
    docs = docs_of(spark, tmp_path, texts)
    rows = packing.pack_documents(docs, size=256).collect()
    tokenizer = Tokenizer.from_file(path)
    for i, text in enumerate(texts):
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in own]).tolist()
        assert ids == [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        assert [r.start for r in own] == [sum(o.length for o in own[:k]) for k in range(len(own))]
        assert {r.doc_tokens for r in own} == {len(ids)}
    for s in {r.sequence_id for r in rows}:
        own = sorted((r for r in rows if r.sequence_id == s), key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(o.length for o in own[:k]) for k in range(len(own))]
        assert sum(r.length for r in own) <= 256
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_pack_is_balanced_and_full():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 3000, 4000).tolist() + [10000, 4096]
    pieces = packing.pack(lengths, 4096)
    used = max(p[3] for p in pieces) + 1
    assert sum(p[2] for p in pieces) == sum(lengths) and used <= -(-sum(lengths) // 4096) + 1


def test_word_cache_overflow(monkeypatch):
    import public_tokenizers
    path = public_tokenizers.path(packing.TOKENIZER)
    texts = [b"alpha beta gamma " + b"q" * 80, b"delta alpha, epsilon", b"beta " + b"q" * 80]
    want = packing.WordEncoder(path).encode(texts)
    monkeypatch.setattr(packing, "CACHE_WORDS", 2)
    monkeypatch.setattr(packing, "LEARN_BYTES", 1)
    assert packing.WordEncoder(path).encode(texts) == want


def test_words_are_split_as_the_tokenizer_does():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path(packing.TOKENIZER)
    parts = ["the", "The", "Tion", "J\u030c", "I\u0307", "\u212a", "\u1e9e", "\u00c9", "\u00e9", "e\u0301", "E\u0301",
             "\u00d7", "\u00b5", "'s", "'S", "'", "don't", "We'LL", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>", ".", ",",
             "...", "-", "23", "\u00bd", "\u4e2d", "<", "\u0338", "\u017f", "\x1c", "\x85", "\u00a0", "</w>", "\x00",
             "q" * 60, " ", "  ", "\t", "\n", "\r\x0b", "\x0c"]
    rng = np.random.default_rng(3)
    texts = ["", " ", *("".join(rng.choice(parts, rng.integers(1, 9))) for _ in range(3000))]
    tokenizer = Tokenizer.from_file(path)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    got = packing.WordEncoder(path).encode([t.encode() for t in texts])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == want


def test_letters_are_learnt_once_whatever_their_case_and_signs():
    import public_tokenizers
    encoder = packing.WordEncoder(public_tokenizers.path(packing.TOKENIZER))
    encoder.encode([b"Ention ention ention, (Ention) ENTION. ention...", "\u00e9cole \u00e9cole.".encode()])
    assert {w for w in encoder.known if b"ention" in w or b"cole" in w} == {b"ention", b"(ention)", "\u00e9cole".encode()}
    short = packing.WordEncoder(public_tokenizers.path(packing.TOKENIZER))
    short.ends[:] = False  # as if no id ended a word: offsets tell words apart
    assert short.encode([b"alpha beta, Gamma."]) == encoder.encode([b"alpha beta, Gamma."])


def test_python_workers_get_bounded_batches(spark):
    common.ready(spark)
    rows = spark.range(0, 24, 1, 1).select(F.expr("repeat('x', 1 << 20)").alias("text"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    got = [r.n for r in rows.mapInArrow(sizes, "n long").collect()]
    assert sum(got) >= 24 << 20 and max(got) <= common.BATCH_BYTES + (2 << 20)


# -- 10 WARC ------------------------------------------------------------------
def test_archives_round_trip(spark, tmp_path):
    big = "WARC/1.1\r\n\r\n" + "é" * 100
    rows = [(5, "http://a", big, 1), (3, "http://b\r\nX: y", big, 1), (None, None, big, 1), (3, "u", big, 1),
            (7, "u", "short", 1), (8, "u", "short", 1), (9, "u", None, 1), (10, "u", "", 1)]
    spark.createDataFrame(rows, "page_id long, url string, html string, digest int").write.parquet(str(tmp_path / "p"))
    pages = spark.read.parquet(str(tmp_path / "p"))
    out = str(tmp_path / "warc")
    warc.write_archives(pages, out)
    records = warc.read_archives(spark, out).collect()
    assert len(records) == 8 and sum(r.record_type == "revisit" for r in records) == 3
    assert {bytes(r.payload).decode() for r in records if r.page_id == 7} == {"short"}
    got = warc.archive_digest(pages).collect()
    assert {r.payload_bytes for r in got if r.payload_digest == hashlib.sha256(big.encode()).hexdigest()} == {212}
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in got if r.payload_bytes == 212) == [
        (0, "revisit", 3), (3, "response", None), (3, "revisit", 3), (5, "revisit", 3)]
    assert warc.archive_digest(pages.limit(0)).count() == 0


# -- queries and pipeline -----------------------------------------------------
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(queries.ORACLE_SQL[name])
    cols = [c[0] for c in cur.description]
    got = queries.QUERIES[name](spark, SF).select(*cols).collect()
    assert sorted(repr(tuple(r)) for r in got) == sorted(map(repr, cur.fetchall()))


CLASHING = ("__f", "__r", "__text", "__score", "__own", "__draw", "__mix", "__rate", "__source", "__redacted", "spans",
            "n_email", "base_sha256", "doc", "words", "block", "ids", "digest", "bytes", "first", "x", "is_query",
            "component", "fp", "no_id", "label", "a b", "a.b")


def clashing(df):
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING if c not in df.columns])


def test_clashing_columns_change_nothing(spark, tmp_path):
    path = str(tmp_path / "d")
    clashing(docs_of(spark, tmp_path, ODD).drop("shard")).write.parquet(path)
    docs = spark.read.parquet(path)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert all(r[c] == f"own {c}" for r in out.collect() for c in CLASHING), name
    n = len(ODD)
    assert corpus_pipeline.pack(spark, docs, SF).select("doc_id").distinct().count() == n
    assert license_scan.scan(docs).count() == raking.mix_report(docs).count() == n
    shards = external_shuffle.write_shards(docs, 3, str(tmp_path / "out"))
    assert all(r.doc["__r"] == "own __r" for r in shards.collect()) and shards.count() == n
    vectors, _ = vectors_of(spark)
    found = permutation_index.search(clashing(vectors), F.col("vec_id") % 20 == 0, k=3, n_pivots=16, prefix=8)
    assert found.where("rank = 1").count() == 16
    pages = spark.createDataFrame([(1, "u", "h" * 200), (2, "u", "h" * 200)], "page_id long, url string, html string")
    got = warc.archive_digest(clashing(pages)).collect()
    assert sorted((r.page_id, r.record_type) for r in got) == [(1, "response"), (2, "revisit")]


def test_mix_rates_a_value_without_target_zero(spark, tmp_path):
    docs = docs_of(spark, tmp_path, ODD)
    target = spark.createDataFrame([("en", 1.0)], "lang string, share double")
    rows = raking.mix(docs, targets={"lang": target}).select("lang", "__mix.*").collect()
    assert len(rows) == len(ODD)
    assert all(r.rate == 0 and r.kept is False for r in rows if r.lang is None)


def test_pipeline_stages(spark, tmp_path):
    docs = docs_of(spark, tmp_path, ODD, [None, *range(1, len(ODD))])
    real = common.read(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF).count() == 0
        assert stage(spark, real, SF).count() > 0
    clean = corpus_pipeline.personal_data(spark, docs, SF).where("doc_id = 10").first()
    assert "[EMAIL]" in clean.text and "[PHONE]" in clean.text and clean.n_chars == len(clean.text)
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and out.where("doc_id is null").count() == 0


def test_training_of_the_field_is_bounded(spark, tmp_path):
    """Documents beyond the bound are not trained on, but searched whole."""
    note = "Call +1 (555) 123-4567 or write a.b@c.de. "
    docs = docs_of(spark, tmp_path, [note * 3] * 5 + [note + "word " * 5000 + "then 123-4567 again"] * 3 + [None, ""])
    assert pii_crf.train(docs.where("length(text) > 9000")) is None
    small = docs.where("length(text) < 9000")
    a, b = (pii_crf.train(d) for d in (docs, small))
    assert a is not None and all(np.array_equal(x, y) for x, y in zip(vars(a).values(), vars(b).values())
                                 if isinstance(x, np.ndarray))
    got = {r.doc_id: r for r in pii_crf.personal_data(docs).collect()}
    assert got[6].n_phone == 1 and got[6].n_email == 1 and got[8].n_phone == 0
