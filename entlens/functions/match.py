"""Entity-name matching, sentences, windows and crops as Column expressions.

All of it is row-wise, so it needs no shuffle and runs unchanged on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from entlens.functions.text import WS, WS_CHARS, holds, let, outside, plain_spaces, strip, words

# The separators, token and edge characters the match rule is defined over.
SEP = rf"[{WS}\-]"
SENTENCE_END = rf"[.!?](?:(?=[{WS}])|(?<=[a-z].)(?=[A-Z]))"
RARE_WS = "".join(x for x in WS_CHARS if x not in " \n")
EDGE_PUNCTUATION = ".,;:!?()[]{}\"'"
FUZZY_WORD = r"[a-z0-9][a-z0-9\-]*"
MAX_BIT_WIDTH = 62


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_name(c: Column | str) -> Column:
    return F.regexp_replace(F.lower(strip(c)), f"{SEP}+", " ")


def name_key(name: Column) -> Column:
    """Letters and digits of the part of a name that must stand as whole runs in a text, without separators.

    Names start and end at run boundaries and their parts may be written together or apart, so a text can only hold a
    name if some consecutive runs of the text, joined, equal this key.
    """
    return F.regexp_replace(F.regexp_extract(_col(name), r"[a-z0-9]+(?: [a-z0-9]+)*", 0), " ", "")


def name_parts(name: Column) -> Column:
    return F.size(F.split(F.regexp_extract(_col(name), r"[a-z0-9]+(?: [a-z0-9]+)*", 0), " "))


def name_pattern(names: Column) -> Column:
    """One pattern for a set of names: longest name first, parts tolerant of separators, never inside a longer run."""
    ordered = F.transform(
        F.sort_array(F.transform(names, lambda n: F.struct((-F.length(n)).alias("len"), n.alias("name")))),
        lambda s: s["name"],
    )
    escaped = F.transform(ordered, lambda n: F.regexp_replace(n, r"([\\.\[\]{}()*+?^$|])", r"\\$1"))
    tolerant = F.transform(escaped, lambda n: F.replace(n, F.lit(" "), F.lit(f"{SEP}*")))
    return F.concat(
        F.lit("(?iu)(?<![a-z0-9])(?:"), F.array_join(tolerant, "|"), F.lit(")(?![a-z0-9])")
    )


def text_keys(text: Column | str, max_parts: int) -> Column:
    """Distinct separator-free keys of 1..max_parts adjacent letter/digit runs of a text."""
    plain = plain_spaces(F.lower(_col(text)), also="-")
    runs = F.filter(F.split(F.regexp_replace(plain, f"{outside('0-9', 'a-z', ' ')}+", " | "), " +"), lambda t: t != "")

    def grams(tokens: Column) -> Column:
        out, joined = [tokens], tokens
        for width in range(2, max_parts + 1):
            shifted = F.slice(tokens, F.lit(width), F.greatest(F.size(tokens), F.lit(1)))
            joined = F.zip_with(joined, shifted, lambda a, b: F.concat(a, b))
            out.append(joined)
        return F.array_distinct(F.concat(*out) if len(out) > 1 else tokens)

    return F.filter(let(runs, grams), lambda k: k.isNotNull() & (k != "|"))


def loose_parts(text: Column | str, lengths: list[int]) -> Column:
    """Distinct pieces of the given lengths of what stands between the letters, digits and separators of a text."""
    runs = F.filter(F.split(F.lower(_col(text)), rf"[a-z0-9{WS}\-]+"), lambda r: r != "")

    def pieces(r: Column) -> Column:
        return F.flatten(F.array(*[F.when(F.length(r) >= n, F.transform(F.sequence(F.lit(1), F.greatest(F.length(r) - n + 1, F.lit(1))), lambda i: F.substring(r, i, F.lit(n)))).otherwise(
            F.array().cast("array<string>")) for n in lengths]))

    return F.array_distinct(F.flatten(F.transform(runs, pieces)))


def split_sentences(text: Column | str) -> Column:
    """A sentence ends at its last mark before white space, at one between a small and a capital letter, and at a line break. The pattern
    starts with the mark, so little is tried elsewhere, and only a text with white space beyond blanks is stripped of all of it."""
    def cut(t: Column) -> Column:
        lines = F.split(F.regexp_replace(t, SENTENCE_END, "$0\n"), "\n")
        return F.when(holds(t, RARE_WS), F.transform(lines, strip)).otherwise(F.transform(lines, lambda s: F.trim(s)))

    return F.array_remove(let(_col(text), cut), "")


def first_offset(text: Column, pattern: Column) -> Column:
    """Characters before the first match (the text length when there is none)."""
    return F.length(F.split(text, pattern, 2)[0])


def lcs_length(a: Column, b: Column) -> Column:
    """Longest common subsequence of two strings.

    Bit-parallel over a 62-bit word; longer first strings take the row-by-row table, with the same result.
    """
    return F.when(F.length(a) <= MAX_BIT_WIDTH, _lcs_bits(a, b)).otherwise(_lcs_table(a, b))


def _chars(c: Column) -> Column:
    return F.filter(F.split(c, ""), lambda x: x != "")


def _lcs_bits(a: Column, b: Column) -> Column:
    full = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(a)) - F.lit(1).cast("long")

    def run(a_chars: Column) -> Column:
        def mask_of(ch: Column) -> Column:
            return F.aggregate(
                F.transform(a_chars, lambda x, i: F.when(x == ch, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))),
                F.lit(0).cast("long"), lambda acc, v: acc.bitwiseOR(v))

        masks = F.transform(_chars(b), mask_of)
        state = F.aggregate(
            masks, full,
            lambda s, m: (s + s.bitwiseAND(m)).bitwiseOR(s - s.bitwiseAND(m)).bitwiseAND(full))
        return F.length(a) - F.bit_count(state)

    return let(_chars(a), run)


def _lcs_table(a: Column, b: Column) -> Column:
    zeros = F.transform(F.sequence(F.lit(0), F.length(a)), lambda _: F.lit(0))

    def next_row(row: Column, ch: Column, a_chars: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.size(a_chars)), F.array(F.lit(0)),
            lambda done, j: F.concat(done, F.array(
                F.when(a_chars[j - 1] == ch, row[j - 1] + 1)
                .otherwise(F.greatest(row[j], F.element_at(done, -1))))))

    def run(a_chars: Column) -> Column:
        last = F.aggregate(_chars(b), zeros, lambda row, ch: next_row(row, ch, a_chars))
        return F.element_at(last, -1)

    return F.when((a == "") | (b == ""), F.lit(0)).otherwise(let(_chars(a), run))


def indel_ratio(a: Column, b: Column) -> Column:
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(100.0)).otherwise(F.lit(200.0) * lcs_length(a, b) / total)


def fuzzy_candidates(text: Column, name: Column) -> Column:
    """Distinct word spans as long as the name (in parts), same first character, length within two."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit(FUZZY_WORD), F.lit(0))
    facts = F.struct(F.substring(name, 1, 1).alias("first"), F.size(F.split(name, " ")).alias("parts"), F.length(name).alias("size"))

    def near(c: Column, f: Column) -> Column:
        return F.abs(F.length(c) - f["size"]) <= 2

    def spans(w: Column, f: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(1), F.size(w) - f["parts"] + 1), lambda i: F.element_at(w, i).startswith(f["first"]))
        joined = F.transform(starts, lambda i: F.array_join(F.slice(w, i, f["parts"]), " "))
        alone = F.filter(w, lambda c: c.startswith(f["first"]) & near(c, f))
        return F.when(F.size(w) < f["parts"], F.array().cast("array<string>")).when(f["parts"] == 1, F.array_distinct(alone)).otherwise(
            F.array_distinct(F.filter(joined, lambda c: near(c, f))))

    # What the name alone decides is worked out once a row, not for each word.
    return let(facts, lambda f: let(tokens, lambda w: spans(w, f)))


def best_alias(text: Column, name: Column, threshold: float) -> Column:
    """struct(score, alias) of the closest spelling at or above the threshold, else null. Ties: smallest alias."""

    def closest(n: Column) -> Column:
        scored = F.transform(
            fuzzy_candidates(text, n),
            lambda c: F.struct((-indel_ratio(n, c)).alias("neg_score"), c.alias("alias")))
        return F.array_min(F.filter(scored, lambda s: s["neg_score"] <= F.lit(-float(threshold))))

    return let(let(name, closest), lambda best: F.when(
        best.isNotNull(), F.struct((-best["neg_score"]).alias("score"), best["alias"].alias("alias"))))


def around(anchors: Column, radius: Column, last: Column) -> Column:
    """Sorted distinct positions within `radius` of an anchor, clipped to 0..last."""
    spread = F.transform(
        anchors, lambda a: F.sequence(F.greatest(a - radius, F.lit(0)), F.least(a + radius, last)))
    return F.sort_array(F.array_distinct(F.flatten(spread)))


def join_positions(items: Column, positions: Column) -> Column:
    """Items at sorted positions joined by a space, with ` ... ` wherever positions jump."""
    return F.array_join(F.transform(
        positions,
        lambda p, i: F.when((i > 0) & (p - F.get(positions, i - 1) > 1), F.concat(F.lit("... "), F.get(items, p)))
        .otherwise(F.get(items, p)),
    ), " ")


def positions_where(items: Column, predicate) -> Column:
    flagged = F.transform(items, lambda x, i: F.when(predicate(x), i))
    return F.filter(flagged, lambda i: i.isNotNull())


def sentence_window(sentences: Column, anchors: Column, k: int, fallback: Column) -> Column:
    """Anchor sentences with k neighbours on each side; the fallback text when there is no anchor."""
    window = let(around(anchors, F.lit(k), F.size(sentences) - 1), lambda pos: join_positions(sentences, pos))
    return F.when(F.size(anchors) > 0, window).otherwise(fallback)


def crop_words(text: Column, is_anchor, max_words: int) -> Column:
    """Limit a text to max_words, keeping the words around its anchor words."""

    def crop(w: Column) -> Column:
        def keep(anchors: Column) -> Column:
            radius = F.greatest(F.floor(F.lit(max_words) / (F.size(anchors) * 2)).cast("int"), F.lit(15))
            kept = F.slice(around(anchors, radius, F.size(w) - 1), 1, max_words)
            return F.when(F.size(anchors) > 0, let(kept, lambda pos: join_positions(w, pos))).otherwise(
                F.array_join(F.slice(w, 1, max_words), " "))

        return F.when(F.size(w) <= max_words, text).otherwise(let(positions_where(w, is_anchor), keep))

    return let(words(text), crop)


def trim_edges(word: Column) -> Column:
    return F.btrim(F.lower(word), F.lit(EDGE_PUNCTUATION))


# Literal (substring) variants used by the corpus statistics ------------------------------------------------------

def literal_mentions(text: Column, name: Column) -> Column:
    low, needle = F.lower(text), F.lower(name)
    count = F.try_divide(F.length(low) - F.length(F.replace(low, needle, F.lit(""))), F.length(needle)).cast("int")
    return F.when(F.length(needle) == 0, F.lit(0)).otherwise(count)


def first_mention_word(text: Column, name: Column) -> Column:
    """Words before the first literal mention (a word cut by the mention counts), -1 without one."""
    low, needle = F.lower(text), F.lower(name)
    head = F.call_function("substring_index", low, needle, F.lit(1))
    return F.when((F.length(needle) > 0) & low.contains(needle), F.size(words(head))).otherwise(F.lit(-1))


def entity_sentences(text: Column, name: Column) -> Column:
    found = F.filter(split_sentences(text), lambda s: F.lower(s).contains(F.lower(name)))
    return let(found, lambda f: F.when(F.size(f) > 0, F.array_join(f, " ")).otherwise(text))


def aspect_window(text: Column, name: Column, width: int = 40, fallback_words: int = 200) -> Column:
    def build(w: Column) -> Column:
        anchors = positions_where(w, lambda t: F.lower(t).contains(F.lower(name)))

        def cut(a: Column) -> Column:
            pos = around(a, F.lit(width), F.size(w) - 1)
            return F.when(F.size(a) > 0, F.array_join(F.transform(pos, lambda p: F.get(w, p)), " ")).otherwise(
                F.array_join(F.slice(w, 1, fallback_words), " "))

        return let(anchors, cut)

    return let(words(text), build)


def mask_exploratory(text: Column, name: Column, all_names: list[str]) -> Column:
    """Replace the entity and its suffixed forms by <TARGETDRUG> and every other listed name by <OTHERDRUG>."""
    from entlens.functions.text import WORD_CHAR, collapse

    start, end = f"(?<!{WORD_CHAR})", f"{WORD_CHAR}*"
    target = F.concat(F.lit(f"(?iu){start}"), _escape(F.lower(name)), F.lit(end))
    masked = F.regexp_replace(text, target, F.lit(" <TARGETDRUG> "))
    low = F.lower(text)
    others = F.filter(
        F.array(*[F.lit(n) for n in all_names]), lambda n: (F.lower(n) != F.lower(name)) & low.contains(F.lower(n)))
    masked = F.aggregate(others, masked, lambda done, n: F.regexp_replace(
        done, F.concat(F.lit(f"(?iu){start}"), _escape(n), F.lit(end)), F.lit(" <OTHERDRUG> ")))
    return collapse(masked)


def _escape(name: Column) -> Column:
    return F.regexp_replace(name, r"([\\.\[\]{}()*+?^$|])", r"\\$1")
