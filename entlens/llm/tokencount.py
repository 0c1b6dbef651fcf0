"""Token counts without tokens: a Viterbi pass that keeps the best score and the number of its pieces.

An Aho-Corasick automaton finds every vocabulary piece that ends at each character of a word. The recurrence carries the best
score and the piece count of the best path to each character; no path is stored. A text is counted by its distinct words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial

from pyspark.sql import DataFrame, functions as F, types as T

# The mark of a word's start, and what an unknown character scores below the worst piece.
WORD_START, UNKNOWN_PENALTY = "▁", 10.0
WORDS_KEPT = 400_000


def read_pieces(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a SentencePiece model, without its control, unknown and byte entries."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


class Counting:
    """A worker's automaton, and the counts of words met so far."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick
        import regex

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        if pieces:
            self.automaton.make_automaton()
        self.empty = not pieces
        self.unknown = min((score for _, score in pieces), default=0.0) - UNKNOWN_PENALTY
        self.spaces = regex.compile(r"\p{White_Space}+")
        self.controls = regex.compile("[\x1c-\x1f]")
        self.known: dict[str, tuple[int, int, float]] = {}

    def words(self, text: str) -> list[str]:
        """Runs without white space. str.split also cuts at four control characters that are not white space."""
        return [w for w in self.spaces.split(text) if w] if self.controls.search(text) else text.split()

    def word(self, text: str) -> tuple[int, int, float]:
        """(pieces, unknown pieces among them, score) of the best path.

        Of equal paths the one whose last piece begins first is kept; a character no piece covers alone may be unknown, and
        neighbouring unknown characters of a path are one piece.
        """
        n = len(text)
        score = [0.0] + [float("-inf")] * n
        count, unknown, ends_unknown = [0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        found = iter(()) if self.empty else iter(self.automaton.iter(text))
        last, match = next(found, (n, None))
        for end in range(1, n + 1):
            best, start = None, 0
            alone = False
            while last == end - 1:  # longest first, so earliest start first
                length, own = match
                alone |= length == 1
                sum_ = score[end - length] + own
                if best is None or sum_ > best:
                    best, start = sum_, end - length
                last, match = next(found, (n, None))
            if not alone:
                sum_ = score[end - 1] + self.unknown
                if best is None or sum_ > best:
                    fused = ends_unknown[end - 1]
                    score[end], ends_unknown[end] = sum_, True
                    count[end], unknown[end] = count[end - 1] + (not fused), unknown[end - 1] + (not fused)
                    continue
            score[end], count[end], unknown[end] = best, count[start] + 1, unknown[start]
        return count[n], unknown[n], score[n]

    def text(self, text: str) -> tuple[int, int, int, float]:
        words = Counter(self.words(text))
        pieces = unknown = 0
        score = 0.0
        for word, times in sorted(words.items()):
            if (got := self.known.get(word)) is None:
                if len(self.known) >= WORDS_KEPT:
                    self.known.clear()
                got = self.known[word] = self.word(WORD_START + word)
            pieces += times * got[0]
            unknown += times * got[1]
            score += times * got[2]
        return words.total(), pieces, unknown, score


_counting: dict[str, Counting] = {}


def _count_batches(batches: Iterator, path: str):
    import pyarrow as pa

    if path not in _counting:
        _counting.clear()
        _counting[path] = Counting(read_pieces(path))
    counting = _counting[path]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
    names = ("n_words", "n_tokens", "n_unknown", "score")
    for batch in batches:
        rows = [counting.text(t.as_py() or "") for t in batch.column(batch.num_columns - 1)]
        made = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=[*batch.schema.names[:-1], *names])


def count_tokens(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (default: all but the text), n_words, n_tokens, n_unknown (long) and score (double).

    Words are runs without Unicode white space, each with the word mark before it, and are segmented on their own into the
    pieces of the SentencePiece file at `path`, taken as a unigram vocabulary. n_tokens is the number of pieces on the best
    path, score the sum of its scores. A null or empty text has no words, no tokens and score 0. An input column with one of
    the four names is replaced. Rows are counted one by one: repeated rows get equal counts; an empty table stays empty.
    No shuffle; the work is linear in the text, and the store of counted words is bounded.
    """
    made = ("n_words", "n_tokens", "n_unknown", "score")
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in {text, *made}]
    rows = docs.select(*[f"`{c}`" for c in keep], F.col(f"`{text}`").alias("_text"))
    schema = rows.drop("_text").schema
    for name, kind in zip(made, (T.LongType(), T.LongType(), T.LongType(), T.DoubleType()), strict=True):
        schema = schema.add(name, kind)
    return rows.mapInArrow(partial(_count_batches, path=path), schema)
