"""Documents with the odd cases every operator must take."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, kept boolean, ids string, score string, line string"


def make(spark, rows):
    """Documents from (doc_id, text), with extra columns whose names the operators use too."""
    return spark.createDataFrame(
        [(i, t, "en" if i is None or i % 2 else None, "src0" if i is None or i % 3 else None, len(t) if t else None, 1, None, "x", None, "y") for i, t in rows], SCHEMA)


ODD = [
    (1, "The quick brown fox jumps over the lazy dog.\nA shared line of text here\nshort\nshort\n"),
    (2, "the QUICK brown fox jumps over the lazy dog.\n  a shared line of TEXT here \t\nshort"),
    (3, None), (4, ""), (5, " \t\n\x0b "), (6, "one"), (7, "one two"), (8, "la la la la la la"),
    (9, "héllo wörld ñandú 日本語 🙂🙂 naïve café"), (10, "x" * 3000), (11, "word " * 4000),
    (12, "Licensed under CC BY-NC 4.0. All rights reserved.\nAll  rights, reserved"), (12, "Licensed under CC BY-NC 4.0. All rights reserved.\nAll  rights, reserved"),
    (13, "The quick brown fox jumps over the lazy dog.\nA shared line of text here\nshort\nshort\n"),
    (None, "A shared line of text here\nonly null has this line"), (None, "only null has this line"),
    (14, "tab\there\r\nand   spaces \x1c control\x1f"), (15, "\n\n\n"), (16, "a b a b a b a b a b c"),
]
