"""BPE, token counts, SimHash, nearest neighbours, toxicity and the pipeline against libraries and brute force."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

import corpus_pipeline
from entlens.llm import ann, bpe, simhash, tokencount, toxicity
from tests_llm_data import ODD, make

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
MORE = ["", " lead", "trail ", "a  b   c", "x\n \n y\n", "　wide\xa0space\x85", "don't we'll I'M", "1234567 ½ ²", "b" * 700, "ab" * 200, "!!!???" * 30, "\x00\x1c\x1f", "é ‍👩‍👩‍👧"]


def test_bpe_is_tiktoken(spark, odd, none):
    texts = [t for _, t in ODD] + MORE
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    got = bpe.encode_decode(make(spark, list(enumerate(texts))), RANKS, public_tokenizers.PATTERN, keep=["doc_id"]).collect()
    assert len(got) == len(texts)
    for r in got:
        t = texts[r.doc_id] or ""
        assert r.ids == own.encode_ordinary(t) and bytes(r.decoded) == t.encode(), t
    kept = bpe.encode_decode(odd, RANKS, public_tokenizers.PATTERN)
    assert kept.columns == [c for c in odd.columns if c not in ("text", "ids")] + ["ids", "decoded"] and kept.count() == len(ODD)
    assert bpe.encode_decode(none, RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_forgets_and_long_words(monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_KEPT", 3)
    monkeypatch.setattr(bpe, "LONG_WORD", 4)
    coder = bpe.Coder(RANKS, public_tokenizers.PATTERN)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    for text in ["several ordinary words, repeated words.", "other ordinary words; longerwordsthanbefore"] * 2:
        ids, ends, raw, raw_ends = coder.code([text, text])
        assert ids.tolist() == own.encode_ordinary(text) * 2 and raw[:raw_ends[0]].tobytes() == text.encode() and ends[1] == 2 * ends[0]


@pytest.mark.parametrize("scores", ["own", "tied"])
def test_token_counts_are_the_librarys(scores):
    pieces = tokencount.read_pieces(PIECES)
    if scores == "tied":
        pieces = [(p, float(-(i % 5))) for i, (p, _) in enumerate(pieces)]
    library = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], 0, False))
    library.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace()])
    counting = tokencount.Counting(pieces)
    for text in [t or "" for _, t in ODD] + MORE + ["🙂🙂x🙂 日本語𐍈"]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert counting.text(text)[1:3] == (len(ids), ids.count(0)), text


def test_token_counts_of_rows(odd, none):
    got = tokencount.count_tokens(odd, PIECES)
    assert {"n_words", "n_tokens", "n_unknown", "score", "lang"} <= set(got.columns) and got.count() == len(ODD)
    assert [tuple(r) for r in got.where("doc_id in (3, 4)").select("n_words", "n_tokens", "n_unknown", "score").collect()] == [(0, 0, 0, 0.0)] * 2
    assert tokencount.count_tokens(none, PIECES).count() == 0


def code(text, k, bits=64):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(bits) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def classes(codes, near):
    """{row: smallest row reachable} by comparing all pairs."""
    parent = {i: i for i in codes}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in codes:
        for j in codes:
            if i < j and near(codes[i], codes[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in codes}


def test_simhash_of_texts(odd, none):
    got = simhash.near_duplicates(odd).select("doc_id", simhash.fingerprint_hex(F.col("code")).alias("hex"), "component_id").collect()
    codes = {i: code(t, 3) for i, t in ODD if i is not None}
    want = classes(codes, lambda a, b: (a ^ b).bit_count() <= 2)
    assert Counter((r.doc_id, r.hex, r.component_id) for r in got if r.doc_id is not None) == Counter((i, f"{codes[i]:016x}", want[i]) for i, _ in ODD if i is not None)
    assert sum(r.doc_id is None for r in got) == 2
    assert simhash.near_duplicates(none).count() == 0


def test_simhash_links_are_whole(spark, monkeypatch):
    """Chains and a crowded cluster of near codes; the bound on a key's rows is lowered so that keys are dealt in blocks."""
    rng = np.random.default_rng(3)
    codes = [int(x) for x in rng.integers(0, 2**63, 60)]
    for start in codes[:3]:
        for _ in range(40):  # a chain of steps of two bits
            start ^= 1 << int(rng.integers(64)) | 1 << int(rng.integers(64))
            codes.append(start)
    codes += [codes[5] ^ 1 << int(rng.integers(20)) ^ 1 << int(rng.integers(20)) for _ in range(120)]
    codes = list(dict.fromkeys(codes))
    nodes = spark.createDataFrame([(i, c.to_bytes(8, "little")) for i, c in enumerate(codes)], "doc long, code binary")
    want = classes(dict(enumerate(codes)), lambda a, b: (a ^ b).bit_count() <= 2)
    for block in (simhash.BLOCK, 40):
        monkeypatch.setattr(simhash, "BLOCK", block)
        found = {r.node: r.component for r in simhash.components(simhash.similar_pairs(nodes, simhash.LINKS)).collect()}
        assert {i: found.get(i, i) for i in want} == want


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in v], i) for i, v in enumerate(rng.normal(size=(400, 16)))]
    rows += [(1000 + i, rows[0][1], 1) for i in range(30)]  # a common vector
    bad = [(2000, None, 1), (2100, [0.0] * 16, 1), (2200, [None] + [1.0] * 15, 1), (2300, [float("nan")] * 16, 1), (2400, [float("inf")] * 16, 1), (None, rows[1][1], 1)]
    table = spark.createDataFrame(rows + bad + rows[:3], "vec_id long, embedding array<double>, rank int")
    got = ann.nearest_neighbours(table, F.col("vec_id") % 100 == 0).collect()
    vectors = {i: v for i, v, _ in rows}
    hits = total = 0
    for q in [i for i in vectors if i % 100 == 0]:
        want = ann.exact_neighbours(vectors, q)
        own = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r for r, _, _ in own] == list(range(1, 11)) and all(s == pytest.approx(np.linalg.norm(np.array(vectors[v]) - vectors[q]), abs=1e-12) for _, v, s in own)
        hits += len({v for _, v, _ in own} & {v for _, v in want})
        total += 10
    assert hits >= 0.9 * total and {r.query_id for r in got} == {i for i in vectors if i % 100 == 0}
    assert [r.vec_id for r in sorted((r for r in got if r.query_id == 0), key=lambda r: r["rank"])] == list(range(1000, 1010))
    few = ann.nearest_neighbours(table.where("vec_id in (0, 5)"), F.col("vec_id") % 100 == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in few] == [(0, 1, 5)]
    assert ann.nearest_neighbours(table.where("vec_id > 1999"), F.col("vec_id") % 100 == 0).count() == 0


def test_an_outlying_query_gets_all_its_neighbours(spark, monkeypatch):
    """Queries far from all else find few codes within the radius that suits the others."""
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.concatenate([rng.normal(size=(1, 16)) * 0.05 + rng.normal(size=(1, 16)) for _ in range(1)] * 300 + [rng.normal(size=(4, 16)) * 9]))]
    rows = [(i, [x + float(rng.normal()) * 0.05 for x in v]) for i, v in rows]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(ann, "_radius", lambda *_: 3)
    got = ann.nearest_neighbours(table, (F.col("vec_id") % 100 == 0) | (F.col("vec_id") >= 300)).collect()
    counts = Counter(r.query_id for r in got)
    assert set(counts) == {0, 100, 200, 300, 301, 302, 303} and set(counts.values()) == {10}


def test_toxicity(spark, odd, none):
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for i in range(600):
        words = list(rng.choice([f"plain{j}" for j in range(80)], 40))
        if i % 5 == 0:
            words[3:3], words[20:20] = ["you", "vilewort"], ["grubling" + str(i % 3)]
        rows.append((i, " ".join(words) + "."))
        labels.append((i, int(i % 5 == 0)))
    labels = spark.createDataFrame(labels + [(None, 1), (9999, None)], "doc_id long, toxic int")
    docs = make(spark, rows)
    terms = toxicity.learn_terms(docs, labels)
    assert "=vilewort" in terms and "grub" in terms and not any(t.lstrip("=").startswith("plain") for t in terms)
    scored = toxicity.score_toxicity(docs, terms, keep=["doc_id"]).withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()
    held = [r for r in scored if r.held]
    assert len(held) > 80 and all((r.score >= 0.3) == (r.doc_id % 5 == 0) and 0 <= r.score <= 1 for r in held)
    grammar = toxicity.Grammar({"=vilewort": 2.0})
    weight = lambda text: sum(w for _, _, w in grammar.clauses(text))
    assert weight("no vilewort") < weight("he said vilewort") * 1.01 < weight("a vilewort") * 1.01 < weight("you vilewort") * 1.01 <= weight("kill you vilewort")
    assert weight("never, vilewort") == 2.0 and weight("vileworts") == 0
    assert toxicity.score_toxicity(odd, terms).count() == len(ODD) and toxicity.score_toxicity(none, terms).count() == 0
    assert toxicity.learn_terms(docs, labels.limit(0)) == {}
    assert {r.score for r in toxicity.score_toxicity(odd.where("doc_id in (3, 4)"), terms).collect()} == {toxicity.sigmoid(toxicity.PRIOR)}


def test_pipeline(spark, tmp_path):
    """Each stage against its own brute-force form on what the stage before it kept."""
    rng = np.random.default_rng(4)
    clean = [" ".join(rng.choice([f"word{j}" for j in range(900)], 120)) for _ in range(30)]
    near = [c.replace(c.split()[60], "other", 1) for c in clean[:5]]
    rows = ODD + [(100 + i, t + ("\na line that many texts have in common" if i % 3 == 0 else "")) for i, t in enumerate(clean)]
    rows += [(200 + i, t) for i, t in enumerate(near)] + [(300, clean[7]), (300, clean[7]), (301, "### $$$ *** " * 60)]
    make(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        seen.append({(r.doc_id): r for r in out.collect()})
        docs = out
    ruled, lined, deduped, mixed, coded = seen
    assert set(ruled) == {100 + i for i in range(30)} | {200 + i for i in range(5)} | {300}
    assert set(lined) == set(ruled) and lined[300].text == "" and lined[100].text.endswith("in common") and not lined[103].text.endswith("in common")
    codes = {i: code(r.text, 3) for i, r in lined.items()}
    assert set(deduped) == set(classes(codes, lambda a, b: (a ^ b).bit_count() <= 2).values()) and set(deduped) < set(lined)
    assert set(mixed) <= set(deduped) and len(mixed) > 15
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    assert set(coded) == set(mixed) and all(r.round_trip and r.ids == own.encode_ordinary(mixed[i].text) for i, r in coded.items())
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == Counter(list(coded))
