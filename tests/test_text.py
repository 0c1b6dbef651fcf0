import html

import pytest
from pyspark.sql import functions as F

from entlens.functions import text as T


def apply(spark, fn, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[1] for r in df.select("i", fn(F.col("t"))).orderBy("i").collect()]


def test_minimal_keeps_case_and_line_breaks(spark):
    got = apply(spark, T.clean_minimal, "A&nbsp;<b>Bold</b>  move.\n\n Next\tline ")
    assert got == ["A Bold move.\nNext line"]


def test_links_leave_their_words(spark):
    got = apply(spark, T.clean_minimal, "See https://www.site.com/Great-results/page.html?drug=abc#frag now", "www.[bad/x now")
    assert got == ["See url Great results page drug abc now", "url now"]


def test_classical(spark):
    got = apply(spark, T.clean_classical, "I can't say it’s sooooo GOOD!! It won't, didn't.")
    assert got == ["i can not say it s soo good ! ! it will not did not"]


def test_unescape_matches_the_standard_library(spark):
    texts = ["&lt;p&gt; &amp;amp; &#233; &#x1F600; &notit; plain", "no entity", "&"]
    assert apply(spark, T.unescape_html, *texts) == [html.unescape(t) for t in texts]


def test_negation_scope(spark):
    got = apply(spark, T.mark_negation_scope, "There was no rash after four weeks and sleep improved.")
    assert got == ["There was no rash_NEG after_NEG four_NEG weeks_NEG and_NEG sleep improved."]


def test_stop_words_keep_negations(spark):
    stop = T.default_stop_words(spark)
    assert not set(stop) & set(T.NEGATIONS) and "the" in stop


@pytest.mark.parametrize("text", ["", "   ", "\n"])
def test_empty_texts(spark, text):
    assert apply(spark, T.clean_classical, text) == [""]
    assert apply(spark, T.word_count, text) == [0]
