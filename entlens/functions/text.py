"""Text normalisation as Column expressions. Only `unescape_html` leaves the JVM."""

from __future__ import annotations

import html
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

# The characters Unicode calls white space, spelled out because a bare \s is ASCII-only in the JVM.
WS = r"\t\n\x0b\x0c\r\x1c-\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WS_CHARS = "".join(
    chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
                     0x202F, 0x205F, 0x3000)
)
WORD_CHAR = r"[\p{L}\p{N}_]"

# Patterns and word lists that the results depend on.
TAG = r"</?[a-zA-Z][^>]{0,200}>"
URL = rf"(?i)https?://[^{WS}]+|www\.[^{WS}]+"
URL_NOISE = ("www", "com", "org", "net", "html", "htm", "php", "asp", "aspx")
#: One of these stands in every link.
URL_MARKS = ("://", "ww.", "wW.", "Ww.", "WW.")
JUNK_CHARS = "\uFFFD\u200B\u00AD"
NEGATIONS = ("not", "no", "never", "nor", "cannot")
NEGATION_CUES = (
    "no", "not", "never", "none", "nor", "cannot", "cant", "don't", "didn't", "doesn't", "wasn't", "isn't", "won't",
    "without", "stopped", "quit",
)
NEGATION_SCOPE = 5


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def outside(*allowed: str) -> str:
    """A class of everything but the allowed characters and ranges, as positive ranges.

    The JVM runs a negated union of classes several times slower than the same set of plain ranges.
    """
    spans = sorted((ord(a[0]), ord(a[-1])) for a in allowed)
    out, start = [], 0
    for low, high in spans:
        if low > start:
            out.append((start, low - 1))
        start = max(start, high + 1)
    out.append((start, 0x10FFFF))
    return "[" + "".join(rf"\x{{{a:x}}}" if a == b else rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in out) + "]"


def let(value: Column, body) -> Column:
    """Evaluate `value` once and hand it to `body`; a lambda would otherwise re-evaluate it for every element."""
    return F.element_at(F.transform(F.array(value), lambda bound: body(bound)), 1)


def strip(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit(WS_CHARS))


def plain_spaces(c: Column | str, keep: str = "", also: str = "") -> Column:
    """White space (but `keep`) and the characters of `also` become plain spaces.

    Line breaks and the characters of `also` are common and replaced at once. The others are searched for first: only a text that holds
    one goes through the per-character map.
    """
    chars = [x for x in WS_CHARS if x not in " " + keep]
    rare = "".join(x for x in chars if x != "\n")
    c = _col(c)
    for x in [x for x in chars if x == "\n"] + list(also):
        c = F.replace(c, F.lit(x), F.lit(" "))
    return where_held(c, rare, lambda t: F.translate(t, rare, " " * len(rare)))


def holds(c: Column, parts) -> Column:
    """Whether a text holds one of the parts: searches for bytes, far cheaper than a pattern. Parts beyond ASCII are looked for only in texts
    beyond ASCII, and there behind the first two bytes that many of them share."""
    plain, wide = [x for x in parts if x.isascii()], [x for x in parts if not x.isascii()]
    tests = [c.contains(x) for x in plain]
    if wide:
        starts = sorted({x.encode()[:2] for x in wide})
        tests.append((F.octet_length(c) != F.length(c)) & _any([c.cast("binary").contains(F.lit(x)) for x in starts]) & _any([c.contains(x) for x in wide]))
    return _any(tests)


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def where_held(c: Column | str, parts, change) -> Column:
    """`change` of the texts that hold one of the parts; it leaves the others as they are, so they are not put through it."""
    return let(_col(c), lambda t: F.when(holds(t, parts), change(t)).otherwise(t))


def single_spaces(c: Column | str) -> Column:
    return where_held(c, ("  ",), lambda t: F.regexp_replace(t, " {2,}", " "))


def collapse(c: Column | str) -> Column:
    """Every run of white space becomes one space; the ends are trimmed."""
    return F.trim(single_spaces(plain_spaces(c)))


def words(c: Column | str) -> Column:
    return F.array_remove(F.split(plain_spaces(c), " "), "")


def word_count(c: Column | str) -> Column:
    return F.size(words(c))


#: Texts that are Python strings at once, whatever the size of a batch.
DECODED_AT_ONCE = 256


@F.arrow_udf(StringType())
def _unescape(texts: pa.Array) -> pa.Array:
    """Only the texts of a slice are Python strings at a time; the rest of a batch stays in Arrow."""
    if texts.null_count == len(texts):
        return texts
    parts = []
    for at in range(0, len(texts), DECODED_AT_ONCE):
        part = texts.slice(at, DECODED_AT_ONCE)
        parts.append(part if part.null_count == len(part) else pa.array([t if t is None else html.unescape(t) for t in part.to_pylist()], texts.type))
    return pa.concat_arrays(parts)


def unescape_html(c: Column | str) -> Column:
    """Decode HTML entities. Rows without an ampersand cross to Python as nulls and keep their JVM value."""
    c = _col(c)
    return F.coalesce(_unescape(F.when(c.contains("&"), c)), c)


def strip_tags(c: Column | str) -> Column:
    return where_held(c, ("<",), lambda t: F.regexp_replace(t, TAG, " "))


def _bad_brackets(host: Column) -> Column:
    opened, closed = host.contains("["), host.contains("]")
    inner = F.regexp_extract(host, r"\[([^\]]*)\]", 1)
    looks_like_ip = inner.rlike(r"^(?:[vV][0-9a-fA-F]+\..+|[0-9a-fA-F:.]*:[0-9a-fA-F:.]*:[0-9a-fA-F:.]*)$")
    return (opened != closed) | (opened & closed & ~looks_like_ip)


def url_words(link: Column | str) -> Column:
    """` url ` plus the readable words of the path and the query; a malformed host leaves ` url ` alone."""
    rest = F.regexp_replace(F.regexp_replace(_col(link), r"(?i)^https?://", ""), r"(?s)#.*$", "")
    host = F.regexp_extract(rest, r"^([^/?]*)", 1)
    tail = F.regexp_extract(rest, r"(?s)^[^/?]*(.*)$", 1)
    kept = F.filter(F.regexp_extract_all(tail, F.lit("[A-Za-z]{3,}"), F.lit(0)), lambda w: ~F.lower(w).isin(*URL_NOISE))
    readable = F.concat(F.lit(" url "), F.array_join(kept, " "), F.lit(" "))
    return F.when(_bad_brackets(host), F.lit(" url ")).otherwise(readable)


def replace_urls(c: Column | str) -> Column:
    """Text pieces and the words of the links between them, put back together in order."""
    def weave(c: Column) -> Column:
        pieces = F.split(c, URL, -1)
        links = F.transform(F.regexp_extract_all(c, F.lit(URL), F.lit(0)), url_words)
        woven = F.flatten(F.zip_with(pieces, links, lambda text, link: F.array(text, F.coalesce(link, F.lit("")))))
        return F.when(c.rlike(URL), F.array_join(woven, "")).otherwise(c)

    return where_held(c, URL_MARKS, weave)


def replace_junk(c: Column | str) -> Column:
    return where_held(c, JUNK_CHARS, lambda t: F.translate(t, JUNK_CHARS, " " * len(JUNK_CHARS)))


def collapse_lines(c: Column | str) -> Column:
    """Collapse white space but keep one line break where there was any: it marks a sentence boundary."""
    c = single_spaces(plain_spaces(c, keep="\n"))
    c = where_held(c, (" \n", "\n ", "\n\n"), lambda t: F.regexp_replace(t, " ?\n[ \n]*", "\n"))
    return F.btrim(c, F.lit(" \n"))


def clean_minimal(c: Column | str) -> Column:
    return collapse_lines(replace_junk(replace_urls(strip_tags(unescape_html(c)))))


def clean_minimal_decoded(decoded: Column | str) -> Column:
    """`clean_minimal` for text whose entities are already decoded."""
    return collapse_lines(replace_junk(replace_urls(strip_tags(decoded))))


def fold_case(c: Column | str) -> Column:
    return F.replace(F.lower(_col(c)), F.lit("’"), F.lit("'"))


def expand_negations(c: Column | str) -> Column:
    """The word comes first in each pattern and what stands before it is tested last, so that the JVM can search for the word."""
    end = f"(?!{WORD_CHAR})"
    c = F.regexp_replace(_col(c), f"can't(?<!{WORD_CHAR}can't){end}", "can not")
    c = F.regexp_replace(c, f"won't(?<!{WORD_CHAR}won't){end}", "will not")
    return F.regexp_replace(c, f"n't{end}", " not")


def drop_symbols(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), outside("0-9", "a-z", "!", "?", *WS_CHARS), " ")


# What a folded text loses: all but letters, digits, ! and ?; white space becomes a plain space with it.
KEPT_SYMBOLS = outside("0-9", "a-z", "!", "?", " ")


def squash_elongation(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"([a-z])\1{2,}", "$1$1")


def space_emphasis(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"([!?])", " $1 ")


def classical_tail(c: Column | str) -> Column:
    """The bag-of-words half of `clean_classical`, for text that is minimally cleaned already. What is dropped becomes a plain space, white
    space too, so that nothing but runs of plain spaces is left to collapse."""
    kept = F.regexp_replace(expand_negations(fold_case(c)), KEPT_SYMBOLS, " ")
    return F.trim(F.regexp_replace(space_emphasis(squash_elongation(kept)), " {2,}", " "))


def clean_classical(c: Column | str) -> Column:
    return classical_tail(clean_minimal(c))


def clean_exploratory(c: Column | str) -> Column:
    c = F.regexp_replace(_col(c), "[‘’ʼ]", "'")
    c = F.regexp_replace(c, "[“”]", '"')
    c = F.regexp_replace(c, "[–—]", "-")
    c = F.regexp_replace(c, "&(amp|nbsp|quot|lt|gt);", " ")
    c = F.regexp_replace(c, "<[a-z/][^>]*>", " ")
    c = F.regexp_replace(c, rf"https?://[^{WS}]+|www\.[^{WS}]+", " <URL> ")
    return collapse(c)


def mark_negation_scope(c: Column | str, cues: tuple[str, ...] = NEGATION_CUES, scope: int = NEGATION_SCOPE) -> Column:
    """Append _NEG to the tokens that follow a cue within `scope` tokens; cues themselves stay plain."""
    def mark(tokens: Column) -> Column:
        is_cue = F.transform(tokens, lambda t: F.regexp_replace(F.lower(t), "[^a-z']", "").isin(*cues))
        return let(is_cue, lambda cue: F.array_join(F.transform(
            tokens,
            lambda t, i: F.when(
                ~cue[i] & F.exists(F.slice(cue, F.greatest(i - scope, F.lit(0)) + 1, F.least(i, F.lit(scope))), lambda x: x),
                F.concat(t, F.lit("_NEG")),
            ).otherwise(t),
        ), " "))

    return let(words(c), mark)


def default_stop_words(spark) -> list[str]:
    """The stop list is a parameter. The default is Spark's English list without the negations."""
    from pyspark.ml.feature import StopWordsRemover

    return sorted(set(StopWordsRemover.loadDefaultStopWords("english")) - set(NEGATIONS))


def remove_stop_words(tokens: Column | str, stop_words: list[str]) -> Column:
    return F.filter(_col(tokens), lambda t: ~t.isin(*stop_words)) if stop_words else _col(tokens)
