"""The near-copy and mixing stages against plain Python, with ids on several texts, clashing columns and dotted names."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from entlens.llm import mixing, simhash
from test_learned import classes, code
from tests_llm_data import ODD, make


def copies(rng, n, words, changed):
    """Texts and copies with a few words changed."""
    out = []
    for _ in range(n):
        own = [f"w{x}" for x in rng.integers(0, 10**6, words)]
        out.append(" ".join(own))
        for _ in range(3):
            other = list(own)
            for i in rng.integers(0, words, changed):
                other[i] = f"w{rng.integers(0, 10**6)}"
            out.append(" ".join(other))
    return out


def test_one_of_each_group_stays(spark, tmp_path):
    rng = np.random.default_rng(14)
    texts = copies(rng, 12, 300, 1) + copies(rng, 4, 1500, 2)
    rows = [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts)] + [(500, ""), (501, None), (None, texts[0]), (None, "only here of all texts"), (None, "Only here OF all texts"), (3, texts[5]), (3, texts[5])] + ODD
    docs = make(spark, rows).withColumn("group_id", F.lit("own")).withColumn("a.b", F.lit(1)).withColumn("none", F.lit(2))
    out = corpus_pipeline.near_dedup(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    got = Counter((r.doc_id, r.text or "") for r in out.collect())
    codes = {t: code(t, 3) for t in {t or "" for _, t in rows}}
    names = list(codes)
    group = classes({i: codes[t] for i, t in enumerate(names)}, lambda a, b: (a ^ b).bit_count() <= 2)
    group = {t: group[i] for i, t in enumerate(names)}
    assert sum(got.values()) == len(set(group.values())) and set(got.values()) == {1}
    for g in set(group.values()):
        own = [(i, t or "") for i, t in rows if group[t or ""] == g]
        kept, = [x for x in got if group[x[1]] == g]
        ids = [i for i, _ in own if i is not None]
        assert kept in own and kept[0] == (min(ids) if ids else None)
    many = Counter(group[t] for t in texts)
    assert len(many) < len(texts)  # some copies are within the distance


def test_a_very_long_text_in_pieces():
    text = " ".join(f"Word{i % 977} x" for i in range(400_000)).encode()
    whole, = simhash.codes([text], simhash.LINKS)
    parts = np.concatenate(list(simhash.shingle_hashes(text, 3)))
    assert len(parts) == 800_000 - 2
    sample = [(2 * sum(int(h) >> b & 1 for h in parts) > len(parts)) for b in (0, 17, 63)]
    assert sample == [bool(int(whole[0]) >> b & 1) for b in (0, 17, 63)]


def test_rows_are_drawn_by_their_own_cell(spark):
    rows = [(i % 400, f"{'licensed text ' if i % 3 else 'plain words '}{'x ' * (i % 50)}") for i in range(1200)] + ODD
    docs = make(spark, rows).withColumn("a.b", F.lit(1)).withColumn("probability", F.lit("own")).withColumn("row", F.lit(5))
    out = mixing.draw_documents(docs)
    assert out.columns == docs.columns
    want = Counter((r.doc_id, r.topic, r.tokens) for r in mixing.mix_documents(docs).where("drawn").collect())
    got = Counter((r.doc_id, r.t, r.n) for r in out.select("doc_id", mixing.topic(F.col("text")).alias("t"), mixing.tokens(F.col("text")).alias("n")).collect())
    assert got == want and 0 < sum(got.values()) < len(rows)
    assert mixing.draw_documents(docs.limit(0)).count() == 0


def test_stages_keep_clashing_columns(spark, tmp_path):
    rows = [(1, " ".join(f"word{i}" for i in range(80)) + "\nA shared line of text here"), (2, " ".join(f"other{i}" for i in range(80)) + "\nA shared line of text here"), (3, "short")]
    docs = make(spark, rows).select("*", F.lit("a").alias("n_words"), F.lit("b").alias("failed"), F.lit("c").alias("n_lines"), F.lit("d").alias("n_dropped"), F.lit("e").alias("a.b"))
    ruled = corpus_pipeline.quality_rules(spark, docs, str(tmp_path))
    lined = corpus_pipeline.line_dedup(spark, ruled, str(tmp_path))
    assert ruled.columns == lined.columns == docs.columns
    got = {r.doc_id: r for r in lined.collect()}
    assert set(got) == {1, 2} and all((r.n_words, r.failed, r.n_lines, r.n_dropped, r["a.b"], r.kept) == ("a", "b", "c", "d", "e", None) for r in got.values())
    assert got[2].text == rows[1][1].split("\n")[0] and got[2].n_chars == len(got[2].text)
