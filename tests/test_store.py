"""Shared fitted blocks against blocks fitted fold by fold, the search ledger, the SVD by blocks and categories as a table."""

import hashlib
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from entlens.operators import crossval as CV
from entlens.operators import evaluate as H
from entlens.operators import knn as K
from entlens.operators import models as G
from entlens.operators import svd
from entlens.operators import vectorize as V
from entlens.operators.store import FoldStore

CONFIG = G.ModelConfig(word=V.Ngrams("word", 1, 2, 2, 60), char=V.Ngrams("char", 2, 3, 3, 150), svd_components=6, params={"C": 1.0, "max_iter": 5})


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(1)
    tone = {0: ["great", "helps"], 1: ["awful", "hurts"], 2: ["started", "dose"]}
    rows = []
    for i in range(75):
        words = [*rng.choice([f"w{j}" for j in range(30)], 8), *tone[i % 3 if i % 7 else 0], f"only{i}"]
        text = None if i == 5 else " ".join(words)
        rows.append((str(i), text, text and text[:20], i % 3, ["a", "b", None][i % 3] if i % 11 else f"rare{i}", "exact", i % 5, [float(x) for x in rng.normal(size=4)]))
    df = spark.createDataFrame(rows, "unique_hash string, ctx_k0 string, ctx_k1 string, sentiment int, entity_norm string, match_type string, fold int, embedding array<float>")
    numbers = {c: (F.col("unique_hash").cast("int") * (k + 3) % 17).cast("int") for k, c in enumerate((*V.COUNT_FEATURES, *V.SCALED_FEATURES))}
    return df.withColumns(numbers).withColumns({"entity": F.col("entity_norm"), "text_clean": F.col("ctx_k0"), "full_masked": F.col("ctx_k1"), "ctx_k2": F.col("ctx_k0")}).cache()


@pytest.fixture(scope="module")
def store(frame):
    return FoldStore(frame, CONFIG)


def rows_of(df):
    """The values of every vector, in order of size: the places of terms may differ between two ways to fit."""
    return {r.unique_hash: np.sort(r.v) for r in df.select("unique_hash", vector_to_array("features").alias("v")).collect()}


@pytest.mark.parametrize("representation,blocks", [("sparse", V.BLOCKS), ("counts", V.BLOCKS)])
def test_blocks_without_a_fold_are_those_fitted_on_the_other_rows(frame, store, representation, blocks):
    config = replace(CONFIG, representation=representation, blocks=blocks)
    for fold in (3,):
        own = config.features().fit(frame.filter(F.col("fold") != fold))
        table = store.table(config, fold)
        assert store.features(config, fold)[1].width == own.width
        for ours, part in ((table.train, frame.filter(F.col("fold") != fold)), (table.valid, frame.filter(F.col("fold") == fold))):
            want, got = rows_of(own.transform(part, ["unique_hash"])), rows_of(ours)
            assert want.keys() == got.keys() and all(np.allclose(want[k], got[k], atol=1e-9) for k in want)


def test_vocabulary_of_each_fold_keeps_the_commonest(frame, store):
    _, models = store.text("ctx_k0")
    for fold in (-1, 2):
        kept = {r.term for r in V.vocabulary(frame.filter(F.col("fold") != fold), "ctx_k0", CONFIG.word).collect()}
        assert set(models[fold, "word"].terms) == kept and len(kept) == 60


def test_weights_follow_the_training_rows(frame, store):
    table = store.table(CONFIG, 1)
    want = {r.sentiment: r.weight for r in V.class_weights(frame.filter("fold <> 1"), "sentiment").collect()}
    assert {r.sentiment: pytest.approx(r.weight) for r in table.train.select("sentiment", "weight").distinct().collect()} == want


def test_a_block_is_made_once_for_threads_that_want_it(store, monkeypatch):
    calls = []
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: store.once(("test",), lambda: calls.append(1) or object()), range(20)))
    assert len(calls) == 1 and len({id(x) for x in got}) == 1


def test_grid_and_selection(frame, store):
    grid = CV.grid_search(store, CONFIG, ["ctx_k0"], [0.1, 1.0]).collect()
    assert {(r.text_column, r.C) for r in grid} == {("ctx_k0", 0.1), ("ctx_k0", 1.0)}
    assert [r.f1_weighted for r in grid] == sorted((r.f1_weighted for r in grid), reverse=True)


def test_a_search_goes_on_where_it_stopped(spark, store, monkeypatch, tmp_path):
    config = replace(CONFIG, model="ComplementNB", representation="counts", params={"alpha": 0.3})
    settings = dict(trials=7, startup=2, wave=3, seed=3)
    whole = [tuple(r) for r in CV.random_search(store, config, ledger=CV.Ledger(spark, str(tmp_path / "a")), **settings).collect()]
    plain, calls = CV.measured, []

    def failing(table, config):
        calls.append(1)
        if len(calls) > 11:
            raise RuntimeError("lost")
        return plain(table, config)

    ledger = CV.Ledger(spark, str(tmp_path / "b"))
    monkeypatch.setattr(CV, "measured", failing)
    with pytest.raises(RuntimeError):
        CV.random_search(store, config, ledger=ledger, **settings)
    done = ledger.rows().count()
    assert 0 < done < sum(r[4] for r in whole)
    monkeypatch.setattr(CV, "measured", lambda t, c: calls.append(2) or plain(t, c))
    again = [tuple(r) for r in CV.random_search(store, config, ledger=ledger, **settings).collect()]
    assert again == whole and calls.count(2) == sum(r[4] for r in whole) - done
    assert sum(r[6] for r in whole) == 1 and {r[3] for r in whole} <= {"complete", "stopped"}
    # The score over all folds is that of the rows together.
    base = H.scores(CV.cross_validate(store, config)).first()
    assert whole[0][5] == pytest.approx(base.f1_weighted)


def test_singular_vectors_by_blocks(spark):
    rng = np.random.default_rng(7)
    n, width, k = 60, 43, 5
    dense = np.where(rng.random((n, width)) < 0.2, rng.normal(size=(n, width)), 0) + np.outer(rng.normal(size=n), rng.normal(size=width)) * (rng.random(n) < 0.5)[:, None]
    dense[:, 20:30] = 0  # a block of columns without an entry
    rows = [(i, [int(j) for j in np.flatnonzero(r)], [float(r[j]) for j in np.flatnonzero(r)]) for i, r in enumerate(dense)] + [(n, [], []), (n + 1, None, None)]
    df = spark.createDataFrame(rows, "id int, indices array<int>, values array<double>").repartition(3)
    basis, values = svd.leading_vectors(df, width, k, passes=40, rows=7, cols=10)
    _, s, vt = np.linalg.svd(dense)
    assert np.allclose(values, s[:k], rtol=1e-6)
    got = np.zeros((50, k))
    for r in basis.collect():
        got[10 * r.cb:10 * r.cb + 10] = np.frombuffer(r.data).reshape(-1, k)
    assert np.allclose(got[:width] @ got[:width].T, vt[:k].T @ vt[:k], atol=1e-5)
    named = df.select("id", F.struct("indices", "values").alias("t"))
    shown = {r.id: np.array(r.p) for r in svd.project(named, "t", "p", basis, k, cols=10).collect()}
    assert len(shown) == n + 2 and all(np.allclose(shown[i], dense[i] @ got[:width]) for i in range(n)) and not shown[n].any() and not shown[n + 1].any()


def test_both_ways_of_the_svd_agree(spark):
    rng = np.random.default_rng(8)
    dense = rng.normal(size=(40, 25)) * (rng.random((40, 25)) < 0.4)
    rows = [([int(j) for j in np.flatnonzero(r)], [float(r[j]) for j in np.flatnonzero(r)]) for r in dense]
    df = spark.createDataFrame(rows, "indices array<int>, values array<double>").select(F.struct("indices", "values").alias("t"))
    sent, blocks = (V.SvdModel.fit(df, "t", 25, 4, passes=30, send_bytes=b) for b in (1 << 20, 0))
    assert sent.blocks is None and blocks.basis is None and sent.width == blocks.width == 4
    assert np.allclose(sent.values, blocks.values, rtol=1e-6)
    for model in (sent, blocks):
        norms = np.sort([np.linalg.norm(r.p) for r in model.project(df, "t", "p").collect()])
        assert np.allclose(norms, np.sort(np.linalg.norm(dense @ sent.basis, axis=1)), atol=1e-5)


def test_many_categories(spark):
    df = spark.range(400_000).select((F.col("id") % 200_000).cast("string").alias("c")).unionByName(spark.createDataFrame([("once",), (None,), (None,)], "c string"))
    model = V.OneHotModel(("c",), min_rows=2).fit(df)
    assert model.kept["c"] == 200_001 and model.width == 200_002
    got = {r.c: r.p for r in model.encode(df.distinct()).select("c", F.col("_place_c").alias("p")).collect()}
    kept = [v if v is not None else V.NULL_CATEGORY for v in got if v != "once"]
    want = {v: i for i, v in enumerate(sorted(kept, key=lambda v: (hashlib.md5(v.encode()).hexdigest()[:2], v)))}
    assert got.pop("once") == 200_001 and {v if v is not None else V.NULL_CATEGORY: p for v, p in got.items()} == want


def test_manhattan_neighbours(spark):
    rng = np.random.default_rng(9)
    points = rng.normal(size=(200, 5))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(points)], "id long, embedding array<double>")
    got = {(r.query, r["rank"]): r.neighbour for r in K.k_nearest(df, df, 4, n_pivots=8, p=1).collect()}
    apart = np.abs(points[:, None] - points[None]).sum(axis=2)
    np.fill_diagonal(apart, np.inf)
    assert got == {(i, r + 1): int(j) for i in range(200) for r, j in enumerate(np.argsort(apart[i], kind="stable")[:4])}


def test_clustered_vectors_are_hardly_compared(spark):
    rng = np.random.default_rng(10)
    centres = rng.normal(size=(30, 6)) * 20
    points = np.concatenate([c + rng.normal(size=(40, 6)) for c in centres])
    df = spark.createDataFrame([(f"r{i:04}", [float(x) for x in v]) for i, v in enumerate(points)], "id string, embedding array<double>")
    report = {}
    got = {(r.query, r["rank"]): r.neighbour for r in K.k_nearest(df, df, 3, report=report).collect()}
    apart = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    np.fill_diagonal(apart, np.inf)
    assert got == {(f"r{i:04}", r + 1): f"r{int(j):04}" for i in range(len(points)) for r, j in enumerate(np.argsort(apart[i], kind="stable")[:3])}
    assert report["all"] == 1200 * 1200 and report["pairs"] < 0.3 * report["all"]


def test_neighbour_search_moves_a_query_once_a_block(spark, monkeypatch):
    monkeypatch.setattr(K, "SLICE_ROWS", 7)
    monkeypatch.setattr(K, "BLOCK_ROWS", 50)
    moved = []
    keep = K.materialise
    monkeypatch.setattr(K, "materialise", lambda df, label, **more: moved.append((label, keep(df, label, **more))) or moved[-1][1])
    points = np.random.default_rng(11).normal(size=(400, 8))
    points[100:240] = points[100]  # one vector that fills more than two blocks
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(points)], "id long, embedding array<double>").repartition(3)
    got = {(r.query, r["rank"]): r.neighbour for r in K.k_nearest(df, df, 4, n_pivots=100).collect()}
    apart = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    np.fill_diagonal(apart, np.inf)
    assert got == {(i, r + 1): int(j) for i in range(400) for r, j in enumerate(np.argsort(apart[i], kind="stable")[:4])}
    asks = [table.count() for label, table in moved if label == "knn-asks"]
    assert asks[-1] <= 400 * 16  # no more than blocks, where each of 100 cells was a row


def test_products_stay_in_small_pieces():
    import tracemalloc

    rng = np.random.default_rng(9)
    for rows, width, each, k in ((30_000, 500, 2, 100), (40, 500, 300, 100)):
        cols = np.concatenate([np.sort(rng.choice(width, each, replace=False)) for _ in range(rows)])
        starts, vals, basis = np.arange(rows + 1) * each, rng.normal(size=rows * each), rng.normal(size=(width, k))
        dense = np.zeros((rows, width))
        dense[np.repeat(np.arange(rows), each), cols] = vals
        tracemalloc.start()
        made = svd.times(starts, cols, vals, basis)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert np.allclose(made, dense @ basis) and peak < made.nbytes + (8 << 20)


def test_gram_products_move_as_blocks(spark, monkeypatch):
    monkeypatch.setattr(V, "SUM_ROWS", 10)
    rng = np.random.default_rng(10)
    dense = rng.normal(size=(40, 37)) * (rng.random((40, 37)) < 0.3)
    dense[:, 10:20] = 0  # a block without an entry
    rows = [([int(j) for j in np.flatnonzero(r)], [float(r[j]) for j in np.flatnonzero(r)]) for r in dense] + [(None, None)]
    df = spark.createDataFrame(rows, "indices array<int>, values array<double>").repartition(3)
    basis = rng.normal(size=(37, 4))
    assert np.allclose(V.SvdModel._gram_times(df, basis), dense.T @ (dense @ basis))


def test_rows_do_not_move_for_singular_vectors(spark, monkeypatch):
    moved = []
    plain = svd.materialise
    monkeypatch.setattr(svd, "materialise", lambda df, label, **more: moved.append((label, plain(df, label, **more))) or moved[-1][1])
    monkeypatch.setattr(svd, "release", lambda *tables: None, raising=False)
    rng = np.random.default_rng(12)
    dense = rng.normal(size=(50, 33)) * (rng.random((50, 33)) < 0.4)
    rows = [([int(j) for j in np.flatnonzero(r)], [float(r[j]) for j in np.flatnonzero(r)]) for r in dense]
    sizes, found = [], []
    for times in (1, 6):
        moved.clear()
        df = spark.createDataFrame(rows * times, "indices array<int>, values array<double>").repartition(3)
        found.append(svd.leading_vectors(df, 33, 4, passes=3, rows=8, cols=10)[1])
        tables = [t for _, t in moved if {"data", "vals"} & set(t.columns)]
        sizes.append(sum(t.agg(F.sum(F.length("data" if "data" in t.columns else "vals"))).first()[0] for t in tables))
    assert sizes[0] == sizes[1] and np.allclose(found[1], found[0] * np.sqrt(6))


def test_groups_of_singular_vectors_give_the_same(spark):
    rng = np.random.default_rng(13)
    dense = rng.normal(size=(40, 27)) * (rng.random((40, 27)) < 0.4)
    rows = [([int(j) for j in np.flatnonzero(r)], [float(r[j]) for j in np.flatnonzero(r)]) for r in dense]
    df = spark.createDataFrame(rows, "indices array<int>, values array<double>").repartition(3)
    one, some = (svd.leading_vectors(df, 27, 5, passes=8, cols=10, group_bytes=b) for b in (1 << 20, 8 * 30 * 4))
    assert np.allclose(one[1], some[1])
    named = df.select(F.struct("indices", "values").alias("t"))
    for made in (one, some):
        norms = [np.linalg.norm(r.p) for r in svd.project(named, "t", "p", made[0], 5, cols=10, group_bytes=8 * 30 * 2).collect()]
        assert len(norms) == 40 and np.isclose(np.sum(np.square(norms)), np.sum(made[1] ** 2), rtol=1e-3)


def test_large_fold_tables_stand_one_at_a_time(frame, store, monkeypatch):
    import os
    from entlens import session
    from entlens.operators import crossval, store as ST
    config = replace(CONFIG, model="ComplementNB", representation="counts", params={"alpha": 0.3})
    whole = {(r.unique_hash, r.predicted) for r in CV.cross_validate(store, config).collect()}
    alone = FoldStore(frame, CONFIG)
    monkeypatch.setattr(ST, "FILL_BYTES", 0, raising=False)
    before, most, plain = set(os.listdir(session.shared_folder(frame.sparkSession))), [], crossval.predict

    def counted(*args):
        most.append(sum(f.split("-")[1] == "features" for f in set(os.listdir(session.shared_folder(frame.sparkSession))) - before if f.startswith("fold")))
        return plain(*args)

    monkeypatch.setattr(crossval, "predict", counted)
    assert {(r.unique_hash, r.predicted) for r in CV.cross_validate(alone, config).collect()} == whole and len(whole) == 75
    assert max(most) == 1


def test_one_against_rest_keeps_no_copy_of_the_rows(spark, store, monkeypatch):
    from pyspark.sql import DataFrame
    table = store.table(CONFIG, 2)
    with monkeypatch.context() as patched:
        for kind in (DataFrame, type(table.train)):
            patched.setattr(kind, "persist", lambda *a, **b: pytest.fail("cached once more"))
        model = G.fit_estimator(table.train, CONFIG)
    assert len(model.models) == 3 and G.predict(model, table.valid, ["unique_hash"]).count() == 15


def test_texts_are_left_behind_once_their_terms_are_numbered(store):
    rows, _ = store.text("ctx_k0")
    assert not {"ctx_k0", "ctx_k1", "ctx_k2", "text_clean", "full_masked"} & set(rows.columns)


def test_model_rows_hold_what_the_models_read(spark):
    from entlens.plans import stages as S
    folder = "/root/testdata/sf0.001"
    rows, labelled = S.model_frame(spark, folder), spark.read.parquet(f"{folder}/labels.parquet")
    assert not {"text", "text_clean", "full_masked", "ctx_k1", "ctx_natural"} & set(rows.columns)
    prepared = S._prepared(spark, folder, True, S.SHIPPED_TEXT, V.BLOCKS)
    assert prepared.join(labelled, "doc_id", "left_anti").count() == 0 and prepared.count() == rows.count() > 0
    wide = S.frame(spark, folder).join(labelled.select("doc_id"), "doc_id").select("unique_hash", "ctx_k0", "vader_full_mean", "mention_count")
    assert {tuple(r) for r in rows.select(wide.columns).collect()} == {tuple(r) for r in wide.collect()}


def test_scoring_prepares_what_the_model_reads(spark, monkeypatch):
    from entlens.plans import modelling as M
    made = []
    plain = M.materialise
    monkeypatch.setattr(M, "materialise", lambda df, label, **more: made.append(df.columns) or plain(df, label, **more))
    rows = M._prepare(spark)(M._raw_pairs(spark, "/root/testdata/sf0.001").limit(20))
    assert not {"text", "text_clean", "full_masked", "ctx_k1", "ctx_k2"} & set(made[0])
    assert {"ctx_k0", "embedding", *V.COUNT_FEATURES, *V.SCALED_FEATURES, *V.CATEGORY_FEATURES} <= set(rows.columns) and rows.count() == 20


def test_the_registered_search_has_no_limit_of_seconds(monkeypatch):
    from entlens.plans import modelling as M
    asked = []
    monkeypatch.setattr(M.S, "fold_store", lambda *a: None)
    monkeypatch.setattr(M, "_screened", lambda *a: None)
    monkeypatch.setattr(M.CV, "tune_best", lambda store, screened, configs, **search: asked.append((set(configs), search)))
    M.search(None, "")
    assert asked == [({"LogisticRegression", "LinearSVC", "ComplementNB"}, {})]


def test_boosted_trees_are_registered_whole():
    from entlens.plans import modelling as M
    made = M.config("GradientBoosting")
    assert made.svd_components == G.SHIPPED.svd_components == 300 and made.representation == "dense"
    assert G.boosted_trees(made.params, 1.0).getClassifier().getMaxIter() == 150


def test_manhattan_tiles_are_small_and_their_slack_holds():
    import tracemalloc

    rng = np.random.default_rng(14)
    for scale in (1.0, 1e-40, 1e33):
        a, b = rng.normal(size=(37, 64)) * scale, rng.normal(size=(9_000, 64)) * scale
        exact = np.abs(a[:, None] - b[None, :500]).sum(axis=2)
        tracemalloc.start()
        made, slack = K._manhattan(a, b)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert (np.abs(made[:, :500] - exact) <= slack[:, None]).all()
        assert peak < made.nbytes + 5 * b.nbytes  # no array of queries times rows times coordinates


def test_manhattan_neighbours_among_copies_and_large_numbers(spark):
    points = np.random.default_rng(15).normal(size=(160, 6))
    points[40:70] = points[40]
    points[70:75] *= 1e33
    points[80:100] = points[80] + np.random.default_rng(16).normal(size=(20, 6)) * 1e-9  # closer than single precision tells
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(points)], "id long, embedding array<double>")
    got = {(r.query, r["rank"]): r.neighbour for r in K.k_nearest(df, df, 5, n_pivots=8, p=1).collect()}
    apart = np.abs(points[:, None] - points[None]).sum(axis=2)
    np.fill_diagonal(apart, np.inf)
    assert got == {(i, r + 1): int(j) for i in range(160) for r, j in enumerate(np.argsort(apart[i], kind="stable")[:5])}


def test_settings_on_the_same_features_share_a_large_table(frame, monkeypatch):
    from entlens.operators import store as ST
    monkeypatch.setattr(ST, "FILL_BYTES", 0, raising=False)
    monkeypatch.setattr(CV, "ABLATIONS", [v for v in CV.ABLATIONS if v[0] == "balanced" or v[1] in ("ctx_k1", CV.SHIPPED_NAME) and v[0] == "text_col"])
    alone, made = FoldStore(frame, CONFIG), []
    plain = V.materialise
    monkeypatch.setattr(V, "materialise", lambda df, label, **more: made.append(label) or plain(df, label, **more))
    rows = CV.run_ablations(alone, replace(CONFIG, model="ComplementNB", representation="counts", params={"alpha": 0.3})).collect()
    assert [(r.group, r.variant) for r in sorted(rows)] == [("balanced", "no class weights"), ("balanced", "shipped"), ("text_col", "ctx_k1"), ("text_col", "shipped")]
    assert all(r.delta == 0 for r in rows if r.shipped) and len({r.f1_weighted for r in rows if r.shipped}) == 1
    assert sum(label.endswith("-features") for label in made) == 2 * 5  # a table a fold for each text
