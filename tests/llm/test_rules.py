"""Sharding, quality rules, line dedup, licence scan and mixing against plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from entlens.llm import licenses, linededup, mixing, quality, sharding
from tests_llm_data import ODD, make

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def ring_place(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def test_ring_agrees_with_a_walk_key_by_key(spark):
    shards, vnodes = 4, 8
    ids = list(range(50)) + [7] * 30  # a key that repeats beyond a shard's room
    got = sharding.place_on_ring(make(spark, [(i, f"t{i}") for i in ids]), shards=shards, vnodes=vnodes).collect()
    nodes = sorted((ring_place(f"node-{n}"), n % shards) for n in range(shards * vnodes))
    arc_of = lambda key: next((a for a, (p, _) in enumerate(nodes) if ring_place(key) <= p), 0)
    capacity = [len(ids) // shards + (s < len(ids) % shards) for s in range(shards)]
    arcs = defaultdict(int)
    for i in ids:
        arcs[arc_of(str(i))] += 1
    want = Counter()
    for a in sorted(arcs):  # every arc fills its own shard first
        s = nodes[a][1]
        took = min(capacity[s], arcs[a])
        capacity[s] -= took
        arcs[a] -= took
        want[a, s] += took
    for a in sorted(arcs):  # the overflow walks on clockwise
        for _, s in nodes[a:] + nodes[:a]:
            took = min(capacity[s], arcs[a])
            capacity[s] -= took
            arcs[a] -= took
            want[a, s] += took
    assert Counter((arc_of(str(r.doc_id)), r.shard) for r in got) == +want
    for s in range(shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(len(ids) // shards + (s < len(ids) % shards)))
    assert all(r.home_shard == nodes[arc_of(str(r.doc_id))][1] for r in got)


def test_ring_odd_rows(odd, none):
    got = sharding.place_on_ring(odd).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in ODD)
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes[s] for s in range(16)) <= 1 and {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    assert sharding.place_on_ring(none).count() == 0


def measured(text):
    w, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
    windows = defaultdict(list)
    for i in range(len(w) - 2):
        windows[tuple(w[i:i + 3])].append(i)
    again = {j for at in windows.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again))


def test_quality_measures_and_policies(spark, odd, none):
    texts = [t for _, t in ODD] + ["good words in a clean text " + " ".join(f"w{i}" for i in range(60)), "### *** $$$ " * 30 + " ".join(f"w{i}" for i in range(90))]
    docs = make(spark, list(enumerate(texts)))
    rows = {r.doc_id: r for r in quality.apply_policy(docs).collect()}
    for i, t in enumerate(texts):
        r, m = rows[i], measured(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == m, t
        assert r.base_failed == (m[0] < 50 or 100 * m[4] > 50 * m[0]) and not (r.base_failed and r.kept)
    assert rows[len(texts) - 2].kept and not rows[len(texts) - 1].kept and not rows[len(texts) - 1].base_failed
    ledger = quality.ledger(docs).cache()
    for policy in quality.POLICIES.values():
        mask = quality.mask(policy)
        fails = [r.failed & mask for r in ledger.collect()]
        bits = {rule.name: 1 << b for b, rule in enumerate(quality.rules())}
        for r in quality.ablation(ledger, policy).collect():
            bit = bits[r.rule]
            assert (r.n_failed, r.n_alone, r.n_kept_without) == (sum(f & bit > 0 for f in fails), sum(f == bit for f in fails), sum(f & ~bit == 0 for f in fails))
    assert quality.apply_policy(none).count() == 0 and quality.ablation(quality.ledger(none), quality.POLICIES["v1"]).agg(F.sum("n_failed")).first()[0] == 0
    assert quality.ledger(odd).count() == len(ODD)


@pytest.mark.parametrize("least", [2, 3])
def test_line_dedup(odd, none, least):
    key = lambda line: "".join(c.lower() if c.isascii() else c for c in line.strip(SPACE))
    held = defaultdict(set)
    for i, t in ODD:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                held[key(line)].add(i)
    first = {k: min((i for i in ids if i is not None), default=None) for k, ids in held.items() if len(ids) >= least}
    want = Counter()
    for i, t in ODD:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in first or first[key(x)] == i]
        want[i, "\n".join(kept), len(lines), len(lines) - len(kept)] += 1
    got = linededup.dedup_lines(odd, min_docs=least)
    assert got.columns == [*odd.columns, "n_lines", "n_dropped"]
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()) == want
    assert linededup.dedup_lines(none).count() == 0


def test_licenses(spark, odd, none):
    texts = [(i, t) for i, t in ODD] + [(20, "Text before. Released under the MIT License. all rights reserved all RIGHTS reserved"), (21, "the mit license is mentioned only"),
                                       (22, "Licensed under the Apache License, Version 2.0."), (23, "GNU General Public License cc by")]
    got = licenses.scan_licenses(make(spark, texts)).collect()
    assert len(got) == len(texts)
    by = {r.doc_id: r for r in got}
    for i, t in texts:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
        base = sorted((k, label) for phrase, label in licenses.PHRASES for k in range(len(w)) if w[k:k + len(phrase.split())] == phrase.split())
        if i is not None:
            assert by[i].n_words == len(w) and sorted((b.start, b.label) for b in by[i].base) == base, t
    labels = lambda i: {(n.label, n.score) for n in by[i].notices}
    assert labels(20) == {("mit", 1.0)} and labels(22) == {("apache", 1.0)} and labels(21) == set() and labels(6) == set()
    assert [n.start for n in by[20].notices] == [2]
    assert licenses.scan_licenses(none).count() == 0


def test_mixing(spark, odd, none):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), ["en", "de", None][i % 3], f"src{i % 4 if i % 2 else 0}") for i in range(600)], "doc_id long, text string, lang string, source string")
    mix = mixing.Mix(shares={"lang": {"en": 0.5}}, rounds=12)
    rows = mixing.mix_documents(docs, mix).collect()
    assert len(rows) == 600
    cells = {(r.source, r.lang, r.topic): r for r in rows}
    total = sum(r.tokens for r in rows)
    assert sum(r.weight for r in cells.values()) == pytest.approx(total)
    assert sum(r.weight for r in cells.values() if r.lang == "en") == pytest.approx(0.5 * total, rel=1e-3)
    own = Counter()
    for r in rows:
        own[r.source] += r.tokens
    wish = {s: n ** 0.7 for s, n in own.items()}
    for s in own:
        assert sum(r.weight for r in cells.values() if r.source == s) == pytest.approx(total * wish[s] / sum(wish.values()), rel=1e-3)
    assert sum(r.probability * r.tokens for r in rows) == pytest.approx(mix.keep * total, rel=1e-6)
    assert all(r.drawn == (int(hashlib.md5(f"mix:{r.doc_id}".encode()).hexdigest()[:13], 16) / 2**52 < r.probability) for r in rows)
    kept = mixing.mix_documents(odd).collect()
    assert Counter(r.doc_id for r in kept) == Counter(i for i, _ in ODD)
    assert all(not r.drawn for r in kept if r.doc_id == 3 and r.probability == 0)
    assert mixing.mix_documents(none).count() == 0
