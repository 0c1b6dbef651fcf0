"""Repeated passages, the manifest and hard negatives against plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from entlens.llm import manifest, negatives, passages
from tests_llm_data import ODD, make


def plain_cuts(rows, window):
    """(key, n_words, kept words) of each row, by a dictionary of all windows."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, passage_order(rows[i][1])))
    seen, out = set(), []
    for i in order:
        words = (rows[i][1] or "").encode().split()
        covered = [False] * len(words)
        for s in range(len(words) - window + 1):
            own = tuple(words[s:s + window])
            if own in seen:
                covered[s:s + window] = [True] * window
            seen.add(own)
        out.append((rows[i][0], len(words), b" ".join(w for w, c in zip(words, covered) if not c).decode()))
    return sorted(out, key=str)


def passage_order(text):
    """Rows of one key stand in the order of two hashes, which the tests give no passages in common unless the texts are equal."""
    return text or ""


def cuts(df, window):
    got = passages.drop_repeats(df, window)
    texts = df.select(F.col("doc_id").alias("k"), "text")
    out = []
    whole = {(r.k, hashlib.sha256(b" ".join((r.text or "").encode().split())).hexdigest()): b" ".join((r.text or "").encode().split()).decode() for r in texts.collect()}
    for r in got.collect():
        kept = whole[r.doc_id, r.words_sha256] if r.kept is None else r.kept
        removed = {i for s in r.spans for i in range(s.start, s.end)}
        assert (r.kept is None) == (not removed) and len(kept.encode().split()) == r.n_words - len(removed)
        out.append((r.doc_id, r.n_words, kept))
    return sorted(out, key=str)


def corpus(rng, alphabet, n):
    texts = [" ".join(f"w{rng.randrange(alphabet)}" for _ in range(rng.randrange(0, 90))) for _ in range(n)]
    long = [f"p{i}" for i in range(70)]
    texts += [t + " " + " ".join(long[rng.randrange(0, 20):rng.randrange(30, 71)]) + " " + t[:40] for t in texts[:n // 2]]
    texts += ["a " * k for k in (5, 19, 20, 21, 60)] + ["b a a " * 15, "a b a " * 15, "x " + "a b " * 30, "a b " * 25 + "y"] + texts[:n // 4]
    return [(i, t) for i, t in enumerate(rng.sample(texts, len(texts)))]


@pytest.mark.parametrize("window,alphabet,piece", [(20, 3, 300_000), (20, 50, 37), (5, 4, 300_000), (2, 3, 11), (20, 1, 300_000), (1, 9, 300_000)])
def test_repeated_passages_by_all_windows(spark, monkeypatch, window, alphabet, piece):
    rng = random.Random(window * alphabet)
    rows = corpus(rng, alphabet, 40)
    monkeypatch.setattr(passages, "PIECE_WORDS", piece)
    assert cuts(make(spark, rows), window) == plain_cuts(rows, window)


def test_pieces_and_groups_make_no_difference():
    """The windows' witnesses do not depend on where a long text is cut or what stands beside it."""
    rng = np.random.default_rng(5)
    words = rng.integers(0, 40, 3000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15 & 0xFFFFFFFF)
    starts, name, place, *sides = passages.witnesses(words, [3000], 20)
    for a, b in ((0, 700), (333, 1500), (1481, 3000)):
        s, n, p, *own = passages.witnesses(words[a:b], [b - a], 20)
        there = slice(a, a + len(s))
        assert (n == name[there]).all() and (np.where(p < 0, -1, p + (a << passages.LEVEL_BITS)) == place[there]).all()
        for side in (0, 2):
            held = own[side + 1]
            assert (held == sides[side + 1][there]).all() and (own[side][held] == sides[side][there][held]).all()
    assert (place >= 0).mean() > 0.8


def test_passages_of_odd_rows(spark, odd, none):
    rows = [(i, t) for i, t in ODD]
    assert cuts(odd, 20) == plain_cuts(rows, 20)
    assert passages.drop_repeats(none).collect() == []
    copies = make(spark, [(7, "a b c d e"), (7, "a b c d e"), (None, "a b c d e"), (3, "z a b c d")])
    got = sorted(((r.doc_id, r.n_words, r.kept) for r in passages.drop_repeats(copies, 4).collect()), key=str)
    assert got == sorted([(3, 5, None), (7, 5, "e"), (7, 5, ""), (None, 5, "")], key=str)


def plain_root(nodes, fanout):
    while len(nodes) > 1:
        nodes = [hashlib.sha256("".join(nodes[i:i + fanout]).encode()).hexdigest() for i in range(0, len(nodes), fanout)]
    return nodes[0]


def plain_leaf(r, n_chars):
    fields = [r.doc_id, r.source, r.lang, n_chars, r.text]
    return hashlib.sha256("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields).encode()).hexdigest()


@pytest.mark.parametrize("fanout,levels,n", [(2, 2, 61), (3, 1, 50), (2, 10, 33), (4, 1, 1)])
def test_manifest_by_one_list(spark, fanout, levels, n):
    rows = [(i * 3, f"text {i % 7} é") for i in range(n)]
    df = make(spark, rows).withColumn("lang", F.when(F.col("doc_id") % 5 == 0, F.lit(None)).when(F.col("doc_id") % 7 == 0, "z").otherwise("en"))
    tampered = F.when(F.col("doc_id") % 4 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    got = manifest.manifest(df.withColumn("leaf", F.lit(1)), changed={"n_chars": tampered}, fanout=fanout, levels=levels).collect()
    by_lang = {}
    for r in sorted(df.collect(), key=lambda r: r.doc_id):
        by_lang.setdefault(r.lang, []).append(r)
    subroots = {lang: plain_root([plain_leaf(r, r.n_chars) for r in own], fanout) for lang, own in by_lang.items()}
    root = plain_root([subroots[lang] for lang in sorted(subroots, key=lambda x: (x is not None, x or ""))], fanout)
    assert len(got) == n
    own = {r.doc_id: r for rs in by_lang.values() for r in rs}
    for r in got:
        assert r.leaf == plain_leaf(own[r.doc_id], own[r.doc_id].n_chars) and r.subroot == subroots[own[r.doc_id].lang] and r.root == root
        assert r.verified == (r.doc_id % 4 != 0) == (r.folded_root == root)
        node = r.leaf
        for s in r.proof:
            node = hashlib.sha256((s.left + node + s.right).encode()).hexdigest()
        assert node == root


def test_manifest_of_odd_rows(spark, odd, none):
    got = manifest.manifest(odd, levels=1).collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(i for i, _ in ODD if i is not None) and len(got) == len(ODD)
    assert all(r.verified for r in got) and len({r.root for r in got}) == 1
    assert manifest.manifest(none).collect() == []
    assert zlib.crc32(b"1") == spark.range(1).select(F.crc32(F.lit("1").cast("binary"))).first()[0]


def plain_negatives(rows, is_anchor, positives=5, take=3):
    def product(a, b):
        return sum(x * y for x, y in zip(a, b))

    rows = [(k, lab, [int(np.floor(256 * np.float64(x))) for x in v]) for k, lab, v in rows
            if k is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, (key, lab, v) in enumerate(rows):
        if not is_anchor(key):
            continue
        scored = sorted((-product(v, w), k, j) for j, (k, _, w) in enumerate(rows) if j != i)
        for s, k, j in [x for x in scored if rows[x[2]][1] == lab][:positives]:
            fit = [(n, t) for t, n, m in scored if rows[m][1] != lab and 50 * -s <= 100 * -t <= 95 * -s][:take]
            out += [(key, k, rank + 1, n, -s, -t) for rank, (n, t) in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("bucket,spread", [(1024, 1.0), (7, 0.3), (16, 0.0)])
def test_hard_negatives_by_all_pairs(spark, monkeypatch, bucket, spread):
    monkeypatch.setattr(negatives, "BUCKET", bucket)
    rng = np.random.default_rng(int(10 * spread) + bucket)
    centres = rng.normal(size=(3, 6))
    rows = [(i, int(rng.integers(0, 4)), [float(x) for x in (centres[i % 3] + spread * rng.normal(size=6)) * rng.choice([0.2, 1, 3])]) for i in range(300)]
    rows += [(400, None, [1.0] * 6), (401, 1, None), (402, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (403, 1, [float("nan")] * 6), (404, 1, [float("inf")] * 6), (None, 1, [1.0] * 6),
             (405, 1, [0.0] * 6), (410, 1, [0.0] * 6), (406, 2, []), (407, 2, [2.0, 2.0]), (10, 1, rows[10][2]), (408, 9, [5.0] * 6), (420, 9, [5.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("score", F.lit("x")).withColumn("row", F.lit(None).cast("string"))
    got = negatives.hard_negatives(df, F.col("vec_id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in got.collect()) == plain_negatives(rows, lambda k: k % 10 == 0)
    assert negatives.hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).collect() == []


def test_hard_negatives_of_large_values(spark):
    big = 2.0 ** 28  # products beyond what doubles hold exactly
    rows = [(0, 1, [big, 1.0]), (1, 1, [big, 3.0]), (2, 2, [big * 0.75, 5.0]), (3, 2, [big * 0.75, 7.0]), (4, 2, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = [tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") == 0, scale=1).orderBy("rank").collect()]
    most = int(big) ** 2
    assert got == [(0, 1, 1, 3, most + 3, most * 3 // 4 + 7), (0, 1, 2, 2, most + 3, most * 3 // 4 + 5)]
    beyond = df.withColumn("embedding", F.transform("embedding", lambda x: x * 4096))
    assert negatives.hard_negatives(beyond, F.col("vec_id") == 0, scale=1).collect() == []  # all scores count as the largest long
