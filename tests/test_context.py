from pyspark.sql import functions as F

from entlens.functions import match as M
from entlens.functions.valence import ValenceLexicon
from entlens.operators.context import context_job, preprocess_pairs
from entlens.operators.lexicon import Lexicon

NAMES = ["Alphazol", "Beta-Max", "Gammacin", "gammacin plus"]
GROUPS = [["alphazol", "azolin"], ["gammacin", "gamcin"]]
VALENCE = ValenceLexicon({"great": 3.0, "awful": -2.0})


def run(spark, rows, limit=5000):
    lexicon = Lexicon.from_lists(spark, NAMES, GROUPS, limit)
    df = spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)], "unique_hash string, text string, entity string")
    return [r.asDict() for r in context_job(df, lexicon).orderBy("unique_hash").collect()]


TEXT = "Alphazol was great for me. My cousin hated beta max. Nothing else."


def test_two_entities_get_their_own_window(spark):
    a, b = run(spark, [(TEXT, "alphazol"), (TEXT, "Beta-Max")])
    assert a["ctx_k0"] == "targetdrug was great for me."
    assert b["ctx_k0"] == "My cousin hated targetdrug."
    assert a["n_other_drugs"] == b["n_other_drugs"] == 1
    assert a["full_masked"] == "targetdrug was great for me. My cousin hated otherdrug. Nothing else."
    assert a["first_mention_pos"] == 0.0 and a["match_type"] == "exact"


def test_synonym_misspelling_and_missing(spark):
    s, f, n = run(spark, [("Took azolin today.", "alphazol"), ("The alphazoll helped.", "alphazol"), ("No name here at all.", "alphazol")])
    assert (s["match_type"], f["match_type"], n["match_type"]) == ("exact", "fuzzy", "none")
    assert f["ctx_k0"] == "The targetdrug helped."
    assert n["ctx_k0"] == "No name here at all." and n["first_mention_pos"] == -1.0 and n["mention_count"] == 0


def test_longest_name_wins_and_longer_words_do_not_match(spark):
    (r,) = run(spark, [("Gammacin-plus beats gammacins and Alphazol.", "alphazol")])
    assert r["full_masked"] == "otherdrug beats gammacins and targetdrug."


def test_missing_space_after_a_full_stop_is_a_boundary(spark):
    (r,) = run(spark, [("It was fine.Alphazol was not.", "alphazol")])
    assert r["ctx_k0"] == "targetdrug was not."


def test_crop_keeps_the_mention(spark):
    text = " ".join(["word"] * 400) + " alphazol " + " ".join(["tail"] * 400)
    (r,) = run(spark, [(text, "alphazol")])
    assert len(r["ctx_k0"].split()) <= 250 and "targetdrug" in r["ctx_k0"]


def test_joined_lexicon_gives_the_same_rows(spark):
    rows = [(TEXT, "alphazol"), ("gamcin and beta-max and azolin", "Gammacin"), ("The alphazoll helped.", "alphazol")]
    assert run(spark, rows) == run(spark, rows, limit=1)


def test_rows_do_not_depend_on_their_batch(spark):
    lexicon = Lexicon.from_lists(spark, NAMES, GROUPS)
    rows = [("0", TEXT, "alphazol"), ("1", "Awful &amp; bad. <i>azolin</i>", "alphazol"), ("2", "nothing", "gammacin")]
    schema = "unique_hash string, text string, entity string"
    whole = preprocess_pairs(spark.createDataFrame(rows, schema), lexicon, VALENCE).orderBy("unique_hash").collect()
    alone = [preprocess_pairs(spark.createDataFrame([r], schema), lexicon, VALENCE).first() for r in rows]
    assert whole == alone


def brute_lcs(a, b):
    row = [0] * (len(a) + 1)
    for ch in b:
        new = [0]
        for j, x in enumerate(a):
            new.append(row[j] + 1 if x == ch else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_common_subsequence_against_brute_force(spark):
    words = ["alimta", "alitma", "stelara", "stellara", "a", "", "zz", "x" * 61 + "ab", "ab" * 40, "ba" * 35]
    df = spark.createDataFrame([(a, b) for a in words for b in words], "a string, b string")
    for r in df.select("a", "b", M.lcs_length(F.col("a"), F.col("b")).alias("n")).collect():
        assert r.n == brute_lcs(r.a, r.b), (r.a, r.b)


def test_spellings_are_looked_for_once_a_row(spark):
    df = spark.createDataFrame([("thanedbel sat, tanedble-x thanedble", "thanedble"), ("new yorc and new york city", "New-York"), ("", "a"), (None, "b"), ("x", None)], "text string, entity string")
    best = M.best_alias(F.col("text"), M.normalise_name("entity"), 80.0)
    plan = df.select(best.alias("b"))
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    assert [r.b and (round(r.b.score, 3), r.b.alias) for r in plan.collect()] == [(100.0, "thanedble"), (100.0, "new york"), None, None, None]
