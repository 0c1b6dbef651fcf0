"""Row features: counts, rates and cue words as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from entlens.functions.text import NEGATIONS, WORD_CHAR, word_count

# Cue lists and patterns.
FIRST_PERSON = ("i", "me", "my", "mine", "myself", "i'm", "im", "i've", "ive", "i'd", "i'll")
FIRST_PERSON_PATTERN = r"\b(i|my|me|mine|myself|i'm|im|i've|ive|i'd|i'll)\b"
CLINICAL_PATTERN = (
    r"\b(phase|trial|study|placebo|endpoint|efficacy|fda|approval|approved|"
    r"patients|cohort|randomi[sz]|double.blind|primary endpoint|statistically|"
    r"p\s?[<=]\s?0|confidence interval|hazard ratio|median pfs|overall survival)\b"
)
POSITIVE_PHRASES = (
    "great", "love", "amazing", "wonderful", "thankful", "grateful", "improved", "improvement", "helping", "helped",
    "works well", "remission", "stable", "hope", "better",
)
NEGATIVE_PHRASES = (
    "awful", "terrible", "horrible", "worst", "hate", "failed", "stopped working", "side effects", "pain", "nausea",
    "fatigue", "worse", "scared", "frustrated", "relapse", "progression",
)


def _cues(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.lower(text), "’", "'"), F.lit("[a-z']+"), F.lit(0))


def negation_count(text: Column) -> Column:
    return F.size(F.filter(_cues(text), lambda t: t.isin(*NEGATIONS) | t.endswith("n't")))


def first_person_count(text: Column) -> Column:
    return F.size(F.filter(_cues(text), lambda t: t.isin(*FIRST_PERSON)))


def occurrences(text: Column, needle: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(needle), F.lit("")))


def window_features(text: Column, window: Column, long_doc_chars: int) -> dict[str, Column]:
    return {
        "char_count": F.length(text),
        "word_count": word_count(text),
        "is_long_doc": (F.length(text) > long_doc_chars).cast("int"),
        "window_word_count": word_count(window),
        "exclamation_count": occurrences(window, "!"),
        "question_count": occurrences(window, "?"),
        "negation_count": negation_count(window),
        "first_person_count": first_person_count(window),
    }


def phrase_hits(text: Column, phrases: tuple[str, ...]) -> Column:
    """Non-overlapping occurrences of every phrase in the lower-cased text, summed."""
    low = F.lower(text)
    total = F.lit(0)
    for phrase in phrases:
        total = total + F.regexp_count(low, F.lit(phrase))
    return total


def _unicode_boundaries(pattern: str) -> str:
    inner = pattern.removeprefix(r"\b").removesuffix(r"\b")
    return f"(?<!{WORD_CHAR}){inner}(?!{WORD_CHAR})"


def pattern_count(text: Column, pattern: str) -> Column:
    return F.regexp_count(F.lower(text), F.lit(_unicode_boundaries(pattern)))


def sentence_shape(text: Column) -> dict[str, Column]:
    n_words = word_count(text)
    n_sentences = F.greatest(F.regexp_count(text, F.lit("[.!?]+")), F.lit(1))
    return {
        "n_words": n_words,
        "n_chars": F.length(text),
        "n_sentences": n_sentences,
        "avg_sentence_length": n_words / n_sentences,
        "question_count": occurrences(text, "?"),
        "exclamation_count": occurrences(text, "!"),
    }


def rates(text: Column) -> dict[str, Column]:
    n_words = F.greatest(word_count(text), F.lit(1))
    return {
        "first_person_rate": pattern_count(text, FIRST_PERSON_PATTERN) / n_words,
        "clinical_rate": pattern_count(text, CLINICAL_PATTERN) / n_words,
        "digit_rate": F.regexp_count(text, F.lit(r"\p{Nd}")) / F.greatest(F.length(text), F.lit(1)),
    }


def markup_flags(text: Column) -> dict[str, Column]:
    return {
        "has_url": text.rlike(r"https?://|www\."),
        "has_html": text.rlike(r"<[a-z/][^>]*>"),
        "has_non_ascii": text.rlike(r"[^\x00-\x7F]"),
    }


