"""Hard negatives, token archives and periodic runs against brute force and
exact round trips, with nulls, ties, repeats, very long texts and clashing
columns."""

import hashlib
import os
import random
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_corpus import ODD, docs_of

from tallyspark.llm import cover_tree, periodic_runs, token_archive

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


# -- 11 hard negatives --------------------------------------------------------
VECTORS = "vec_id long, embedding array<double>, label string, asks int, block string, x string, rank int"


def negatives_by_hand(rows, scale=256):
    own = [(i, [int(np.floor(scale * c)) for c in e], lab) for i, e, lab, *_ in rows
           if i is not None and lab is not None and e is not None and all(c is not None and np.isfinite(c) for c in e)]

    def score(a, b):
        return min(max(sum(x * y for x, y in zip(a[1], b[1])), 1 - (1 << 63)), (1 << 63) - 1)

    def first(a, others):
        return sorted(others, key=lambda k: (-score(a, own[k]), own[k][0], k))[:5]

    out = []
    for n, a in enumerate(own):
        if a[0] % 10:
            continue
        same = [k for k, b in enumerate(own) if k != n and b[2] == a[2] and len(b[1]) == len(a[1])]
        for p in first(a, same):
            top = score(a, own[p])
            rest = [k for k, b in enumerate(own) if b[2] != a[2] and len(b[1]) == len(a[1])
                    and 80 * top <= 100 * score(a, b) <= 100 * top]
            out += [(a[0], own[p][0], r, own[k][0], top, score(a, own[k])) for r, k in enumerate(first(a, rest), 1)]
    return sorted(out)


def vector_rows(n=260, dim=6):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(5, dim))
    rows = [[i, (centres[i % 5] + 0.3 * rng.normal(size=dim)).round(2).tolist(), f"l{rng.integers(3)}"]
            for i in range(n)]
    for i in range(0, n, 3):
        rows[i][1] = [0.5] * dim  # a third are copies
    for i in range(200, 230):
        rows[i][1] = rows[i][1][:3]  # another length
    rows += [[300, None, "l0"], [310, [None] * dim, "l1"], [320, [float("nan")] * dim, "l1"], [330, [0.0] * dim, "l2"],
             [340, [1.0] * dim, None], [None, [1.0] * dim, "l1"], [350, [], "l1"], [360, [], "l2"]]
    rows += [list(r) for r in rows[:12]]  # repeated rows
    return [(*r, 1, "b", "x", 9) for r in rows]


@pytest.mark.parametrize("block,chunk", [(2048, 2048), (16, 5)])
def test_hard_negatives(spark, tmp_path, block, chunk, monkeypatch):
    monkeypatch.setattr(cover_tree, "CELL_ROWS", 40)
    rows = vector_rows()
    spark.createDataFrame(rows, VECTORS).repartition(3).write.parquet(str(tmp_path / "v"))
    base = spark.read.parquet(str(tmp_path / "v"))
    got = cover_tree.mine(base, F.col("vec_id") % 10 == 0, block_rows=block, chunk_rows=chunk)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = negatives_by_hand(rows)
    assert len(want) > 100 and sorted(map(tuple, got.collect())) == want
    assert cover_tree.mine(base.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert cover_tree.mine(base, F.lit(False)).count() == 0


def test_huge_components_are_scored_in_whole_numbers(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=4) * 3e5).tolist(), f"l{i % 2}", 1, "b", "x", 1) for i in range(60)]
    got = cover_tree.mine(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 10 == 0, scale=256.0)
    assert sorted(map(tuple, got.collect())) == negatives_by_hand(rows)
    far = [(i, [1e200 * (1 + i % 5), 1e-300], f"l{i % 2}", 1, "b", "x", 1) for i in range(40)]
    got = cover_tree.mine(spark.createDataFrame(far, VECTORS), F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, got)) == negatives_by_hand(far) and {r.positive_score for r in got} == {(1 << 63) - 1}


def test_cover_tree_radii_cover_and_every_point_is_a_centre():
    rng = np.random.default_rng(8)
    points = np.unique(np.floor(20 * np.concatenate([rng.normal(size=(80, 5)), 0.1 * rng.normal(size=(80, 5)) + 3])), axis=0)
    tree = cover_tree.CoverTree(points)
    on_sphere = np.column_stack([points, np.sqrt(np.maximum(tree.m2 - (points ** 2).sum(axis=1), 0))])
    below = [{int(c)} for c in tree.centre]
    for node in reversed(range(len(tree.centre))):
        if tree.count[node]:
            children, own = tree.children(np.array([node]))
            assert tree.centre[children[0]] == tree.centre[node] and not own[0] and own[1:].all()
            below[node] = set().union(*(below[c] for c in children))
            assert sum(len(below[c]) for c in children) == len(below[node])
            assert (tree.radius[children] <= tree.radius[node] / cover_tree.BASE + 1e-6).all()
        far = np.linalg.norm(on_sphere[list(below[node])] - on_sphere[tree.centre[node]], axis=1).max()
        assert far <= tree.radius[node] + 1e-6
    assert below[0] == set(range(len(points)))


def test_descent_skips_nodes_outside_the_windows(monkeypatch):
    rng = np.random.default_rng(9)
    z = np.floor(200 * np.concatenate([c + 0.05 * rng.normal(size=(150, 3)) for c in 4 * rng.normal(size=(12, 3))]))
    n = len(z)
    block = cover_tree.Block(z, np.zeros(n), np.arange(n), np.zeros(n, int), np.arange(n))
    scored, plain = [], cover_tree.inner
    monkeypatch.setattr(cover_tree, "inner", lambda a, b: scored.append(len(a)) or plain(a, b))
    root = block.tree.centre[block.tree.children(np.zeros(1, int))[0]]
    rows, scores = block.search(z[7], plain(z[[7]], block.points[root])[0], lambda r: block.f[r] == 0, [(-np.inf, np.inf)], 5)[0]
    best = np.sort(z @ z[7])[::-1][:5]
    assert scores.tolist() == best.tolist() and len(root) + sum(scored) < n / 2


# -- 12 token archives --------------------------------------------------------
@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(token_archive.TOKENIZER))


def test_piece_encoder_gives_the_tokenizers_ids(tokenizer):
    import public_tokenizers
    own = token_archive.PieceEncoder(public_tokenizers.path(token_archive.TOKENIZER))
    rng = random.Random(1)
    marks = [*" \n\t\r\x0b\x0c\x1c\x1f\x85\xa0 ​'sab1é.,中\U0001f600", "<|endoftext|>", "'ll", "  ", " word", "\n\n"]
    latin = [m for m in marks if m.isascii() or max(m) <= "\xff"] + [*"ªµº×÷²¼_-3Zz", " Word", " (", "'re"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 16))) for alphabet in (marks, latin) for _ in range(1500)]
    for at in range(0, len(texts), 100):
        part = texts[at:at + 100]
        want = [tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in part]
        assert [np.frombuffer(x, own.type).tolist() for x in own.encode(part)] == want


def test_piece_encoder_cuts_any_script_where_the_tokenizer_does(tokenizer):
    import public_tokenizers
    own = token_archive.PieceEncoder(public_tokenizers.path(token_archive.TOKENIZER))
    assert own.cut
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    odd = [*spaces, *"\x00'’“…\u200b\u180e\ufeffжЁ\u0482\u0483ſɏʰʼの中²½×÷ªµ\u0301|<", " ", "\n", "'s", "'re", "a", "Z", "1", ".."]
    rng = random.Random(2)
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 12))) for alphabet in (odd, [*spaces, *"ab.1'"], " \n\xa0a.")
             for _ in range(1500)] + ["<|endoftext|> a b", "a  <|endoftext|>"]
    rng.shuffle(texts)
    for part in (texts, pa.array(["cut off", *texts])[1:]):
        want = [x.ids + [2] for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(x, own.type).tolist() for x in own.encode(part)] == want


def test_distinct_pieces_are_encoded_once_and_words_by_the_model_alone(tokenizer):
    import public_tokenizers
    own = token_archive.PieceEncoder(public_tokenizers.path(token_archive.TOKENIZER))
    asked = []
    own.tokenizer = type("Whole", (), {"encode_batch_fast": lambda _, texts, **b: (
        asked.extend(texts), tokenizer.encode_batch_fast(texts, **b))[1]})()
    words = ["".join(random.Random(i).choices("abcdeéßж", k=6)) for i in range(300)]
    texts = [" ".join(w + sign for w in words) + " …" for sign in (",", ".", "!?", ")")]
    got = [np.frombuffer(x, own.type).tolist() for x in own.encode(texts)]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert asked == [" …"]  # not one word, though its text has a sign beyond Latin
    assert len(own.known) == len({*words}) + 4 + 1  # a word is the same piece whatever sign follows
    own.model = None
    assert [np.frombuffer(x, own.type).tolist() for x in own.encode(texts[::-1])] == got[::-1]


def test_texts_of_another_kind_of_tokenizer_stay_whole(tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer, pre_tokenizers
    other = Tokenizer.from_file(public_tokenizers.path(token_archive.TOKENIZER))
    other.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    other.save(str(tmp_path / "other.json"))
    own, texts = token_archive.PieceEncoder(str(tmp_path / "other.json")), ["", "of the thing, 12 of", "", "a\n\n b", ""]
    assert [np.frombuffer(x, own.type).tolist() for x in own.encode(texts)] == [other.encode(t).ids + [2] for t in texts]


@pytest.mark.parametrize("limit", [token_archive.FILE_BYTES, 300])
def test_archive_round_trip(spark, tmp_path, tokenizer, limit):
    texts = ODD + [f"document {i} says {'so ' * (i % 40)}" for i in range(120)]
    ids = [None if i % 9 == 4 else i % 30 - 3 for i in range(len(texts))]
    docs = docs_of(spark, tmp_path, texts, ids)
    path = str(tmp_path / "archive")
    token_archive.write(docs, path, file_limit=limit, range_bytes=2000)
    got = token_archive.with_starts(token_archive.read(spark, path)).orderBy("start").collect()
    order = [r.doc_id for r in got]
    assert order == sorted([i for i in ids if i is not None]) + [None] * ids.count(None)
    tokens = {t: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in texts}
    assert sorted((str(r.doc_id), r.ids) for r in got) == sorted(
        (str(i), np.array(tokens[t], "<u4").tobytes()) for i, t in zip(ids, texts))
    at = 0
    for r in got:
        assert (r.start, r.tokens, r.ids_crc32) == (at, len(r.ids) // 4, zlib.crc32(r.ids))
        at += r.tokens
    some = token_archive.read(spark, path, doc_ids=[5, -3, 999]).collect()
    assert sorted(r.doc_id for r in some) == sorted(i for i in ids if i in (5, -3))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path + "/shards").count()
    assert files > 5 if limit == 300 else files < 5


def test_archive_edges(spark, tmp_path):
    docs = docs_of(spark, tmp_path, ["x" * 40000], [7])  # nothing short enough to train on
    assert [tuple(r)[:2] for r in token_archive.archive_digest(docs).collect()] == [(7, 0)]
    assert token_archive.archive_digest(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="dictionary"):
        data = token_archive.file_bytes([(1, 0, 0, 1, b"x")], token_archive.Dictionary(b"a").digest, 2)
        token_archive.open_file(memoryview(data), token_archive.Dictionary(b"b").digest)


def test_shared_dictionary_helps_short_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    import public_tokenizers
    path = public_tokenizers.path(token_archive.TOKENIZER)
    texts = [r.text or "" for r in docs.select("text").collect()]
    ids = [x for x in token_archive.PieceEncoder(path).encode(texts) if len(x) < 600]
    made = token_archive.Dictionary(token_archive.train_on(ids[::2], 20000)).compressor()
    plain = token_archive.Dictionary(b"").compressor()
    assert sum(len(made.compress(x)) for x in ids[1::2]) < 0.95 * sum(len(plain.compress(x)) for x in ids[1::2])


# -- 13 periodic runs ---------------------------------------------------------
def slow_runs(w, least=6, exponent=4):
    out = []
    for q in range(1, len(w) // 2 + 1):
        t = 0
        while t + q < len(w):
            s = t
            while t + q < len(w) and w[t] == w[t + q]:
                t += 1
            n = t + q - s
            if t > s and n >= max(least, exponent * q) and all(
                    any(w[i] != w[i + d] for i in range(s, s + n - d)) for d in range(1, q)):
                out.append((s, n, q))
            t += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def runs_of(texts, least=6, exponent=4):
    numbers, used = [], 0
    for w in texts:
        own = {x: k for k, x in enumerate(set(w), used)}
        numbers += [own[x] for x in w]
        used += len(own)
    out = [[] for _ in texts]
    starts = np.cumsum([0, *map(len, texts)])
    for d, s, n, q in periodic_runs.runs(np.array(numbers, np.int64), starts, least, exponent):
        out[d].append((s, n, q))
    return out


@pytest.mark.parametrize("least,exponent", [(6, 4), (2, 2), (20, 3), (1, 5)])
def test_runs_equal_brute_force(least, exponent):
    rng, found = random.Random(least), 0
    for _ in range(60):
        texts = []
        for _ in range(rng.randint(1, 5)):
            w = []
            for _ in range(rng.randint(0, 5)):
                period = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randint(1, 25))]
                w += (period * rng.randint(1, 8))[:rng.randint(1, 150)]
            texts.append(w)
        want = [slow_runs(w, least, exponent) for w in texts]
        found += sum(map(len, want))
        assert runs_of(texts, least, exponent) == want
    assert found > 50


def test_long_runs_of_every_class():
    rng = random.Random(7)
    for q in (1, 5, 6, 18, 19, 57, 58, 174, 175, 600):
        period = [rng.randrange(50) for _ in range(q)]
        w = [-1, *(period * 7)[:4 * q + 3], -2]
        assert max(runs_of([w])[0], key=lambda r: r[1]) == max(slow_runs(w), key=lambda r: r[1])


def test_periods_by_row(spark, tmp_path):
    texts = ODD + ["a b " * 9 + "c", "la " * 4000, "x y z " * 3, " ".join(str(i % 37) for i in range(400))]
    ids = [*range(len(texts) - 1), None]
    docs = docs_of(spark, tmp_path, texts, ids)
    rows = periodic_runs.find(docs, F.struct(*docs.columns).alias("runs_of"), F.col("bucket").alias("strong")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        w = (r.runs_of.text or "").encode().split()
        want = slow_runs(w) if len(w) < 1000 else [(0, len(w), 1)]
        assert [tuple(x) for x in r.runs] == want and r.n_words == len(w)
        best = max(want, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
        assert (r.strongest and tuple(r.strongest)) == best
        gone = {i for s, n, q in want for i in range(s + q, s + n)}
        assert r.collapsed.encode() == b" ".join(x for i, x in enumerate(w) if i not in gone)
    assert periodic_runs.run_digest(docs.limit(0)).count() == 0


def test_run_digest_with_planted_periods(spark, tmp_path):
    texts = [f"{'word ' * (i % 3)}{' '.join(str(k * i % 101) for k in range(i * 3 % 140))}" for i in range(150)]
    docs = docs_of(spark, tmp_path, texts, [i * 7 for i in range(150)])
    planted = 0
    got = {r.doc_id: r for r in periodic_runs.run_digest(docs).collect()}
    for k, text in enumerate(texts):
        w, h = text.encode().split(), zlib.crc32(str(k * 7).encode())
        if h % 10 == 0 and w:
            n, g = len(w), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        want = slow_runs(w)
        planted += bool(want)
        r, best = got[k * 7], max(want, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=(None,) * 3)
        gone = {i for s, n, q in want for i in range(s + q, s + n)}
        assert (r.n_runs, r.start, r.length, r.period) == (len(want), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if want else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in want).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(
            b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()
    assert planted > 3
