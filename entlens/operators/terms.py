"""Terms of texts, counted over Arrow batches.

The JVM cuts a text into tokens. A batch numbers its distinct tokens once and makes each n-gram of a distinct token once, however often it
occurs; what is left for every occurrence is arithmetic on numbers, in pieces of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Tokens, and entries of character n-grams, that a task holds at once (one text more at most).
PIECE_TOKENS = 1_000_000
PIECE_ENTRIES = 4_000_000
#: Rows whose terms are put together at once before they go back to Arrow.
ROWS_AT_ONCE = 1_000
#: Longer tokens are cut one by one, since slicing a column costs a call for each place in the longest.
LONG_TOKEN = 48


def _pieces(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges that hold at most `most` in all, or one element."""
    ends = np.cumsum(lengths)
    start = 0
    while start < len(lengths):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, stop
        start = stop


def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and their sums."""
    if not len(key):
        return key, n
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[starts], np.add.reduceat(n[order], starts)


def char_grams(words: pa.Array, low: int, high: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """For distinct words: (word, gram) with repeats, ordered by word, and the grams. A padded word shorter than a width contributes its
    padded form once and no wider n-gram."""
    padded = pc.binary_join_element_wise(" ", words, " ", "")
    size = pc.utf8_length(padded).to_numpy(zero_copy_only=False)
    at, grams = [], []
    short = np.flatnonzero(size < low)
    if len(short):
        at.append(short)
        grams.append(padded.take(pa.array(short)))
    usual = np.flatnonzero((size >= low) & (size <= LONG_TOKEN))
    for n in range(low, high + 1):
        left = usual[size[usual] >= n]
        place = 0
        while len(left):
            at.append(left)
            grams.append(pc.utf8_slice_codeunits(padded.take(pa.array(left)), place, place + n))
            place += 1
            left = left[size[left] >= place + n]
    for i in np.flatnonzero(size > max(LONG_TOKEN, low - 1)):
        word = padded[int(i)].as_py()
        cut = [word[k : k + n] for n in range(low, min(high, len(word)) + 1) for k in range(len(word) - n + 1)]
        at.append(np.full(len(cut), i))
        grams.append(pa.array(cut, pa.string()))
    if not at:
        return np.empty(0, np.int64), np.empty(0, np.int64), pa.array([], pa.string())
    coded = pa.concat_arrays([g.cast(pa.string()) for g in grams]).dictionary_encode()
    at, code = np.concatenate(at).astype(np.int64), coded.indices.to_numpy().astype(np.int64)
    order = np.argsort(at, kind="stable")
    return at[order], code[order], coded.dictionary


def counted(lists: pa.Array, kind: str, low: int, high: int, known: pa.Array | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array | None]]:
    """Pieces (row, term, tf, terms) of a column of token lists, ordered by row and term; with a dictionary `known`, terms are places in
    it, and others are left out."""
    lengths = _lengths(lists)
    for start, stop in _pieces(lengths, PIECE_TOKENS):
        part = lists.slice(start, stop - start)
        row = np.repeat(np.arange(start, stop), lengths[start:stop])
        flat = part.flatten()
        if pc.any(pc.equal(flat, "")).as_py():
            keep = pc.not_equal(flat, "")
            flat, row = flat.filter(keep), row[keep.to_numpy(zero_copy_only=False)]
        coded = flat.dictionary_encode()
        words, code = coded.dictionary.cast(pa.string()), coded.indices.to_numpy().astype(np.int64)
        yield from (_of_chars if kind == "char" else _of_words)(row, code, words, low, high, known)


def _places(terms: pa.Array, known: pa.Array | None) -> np.ndarray | None:
    return None if known is None else pc.fill_null(pc.index_in(terms, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _of_chars(row, code, words, low, high, known):
    at, gram, terms = char_grams(words, low, high)
    places = _places(terms, known)
    if places is not None:
        gram = places[gram]
        at, gram = at[gram >= 0], gram[gram >= 0]
    starts = np.searchsorted(at, np.arange(len(words) + 1))
    n_words, n_terms = max(1, len(words)), max(1, len(terms if known is None else known))
    pair, times = _summed(row * n_words + code, np.ones(len(row), np.int64))
    row, code = pair // n_words, pair % n_words
    width = starts[code + 1] - starts[code]
    # Cut where a row ends, so that a row's terms are counted in one piece.
    ends = np.flatnonzero(np.concatenate([row[1:] != row[:-1], [True]])) + 1 if len(row) else np.empty(0, np.int64)
    first = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    sizes = np.add.reduceat(width, first) if len(first) else first
    for start, stop in _pieces(sizes, PIECE_ENTRIES):
        span = slice(first[start], ends[stop - 1])
        w = width[span]
        offset = np.repeat(starts[code[span]] - np.concatenate([[0], np.cumsum(w)[:-1]]), w)
        found = gram[offset + np.arange(w.sum())]
        key, tf = _summed(np.repeat(row[span], w) * n_terms + found, np.repeat(times[span], w))
        yield key // n_terms, key % n_terms, tf, terms if known is None else None


def _of_words(row, code, words, low, high, known):
    n_words = max(1, len(words))
    rows, ids, names, total = [], [], [], 0
    gram, label, here = code, words, row
    for width in range(1, high + 1):
        if width > 1:
            inside = here[: len(here) - 1] == row[width - 1 :] if len(here) else np.empty(0, bool)
            key = gram[: len(inside)][inside] * n_words + code[width - 1 :][inside]
            here = row[: len(row) - width + 1]
            distinct, inverse = np.unique(key, return_inverse=True)
            label = pc.binary_join_element_wise(label.take(pa.array(distinct // n_words)), words.take(pa.array(distinct % n_words)), " ")
            full = np.full(len(inside), -1, np.int64)
            full[inside] = inverse
            # A gram that would cross into the next row has no wider one either.
            here = np.where(inside, here, -1 - np.arange(len(here)))
            gram = full
            owner, number = row[: len(inside)][inside], inverse
        else:
            owner, number = row, code
        if width >= low:
            rows.append(owner)
            ids.append(number + total)
            names.append(label)
            total += len(label)
    terms = pa.concat_arrays(names)
    row, ids = np.concatenate(rows), np.concatenate(ids)
    places = _places(terms, known)
    if places is not None:
        ids = places[ids]
        row, ids = row[ids >= 0], ids[ids >= 0]
    n_terms = max(1, len(terms if known is None else known))
    key, tf = _summed(row * n_terms + ids, np.ones(len(row), np.int64))
    yield key // n_terms, key % n_terms, tf, terms if known is None else None


def totals(batches: Iterator[pa.RecordBatch], kind: str, low: int, high: int) -> Iterator[pa.RecordBatch]:
    """(group, term, df, cf) of each piece of batches (tokens, group)."""
    for batch in batches:
        coded = batch.column(1).dictionary_encode(null_encoding="encode")
        group = coded.indices.to_numpy().astype(np.int64)
        for row, term, tf, terms in counted(batch.column(0), kind, low, high):
            if not len(row):
                continue
            n_terms = len(terms)
            # Few terms of a piece may be in this slice of it.
            key, inverse = np.unique(group[row] * n_terms + term, return_inverse=True)
            df, cf = np.bincount(inverse), np.bincount(inverse, weights=tf).astype(np.int64)
            for at in range(0, len(key), 200_000):
                part = key[at : at + 200_000]
                yield pa.RecordBatch.from_arrays(
                    [coded.dictionary.take(pa.array(part // n_terms)), terms.take(pa.array(part % n_terms)), pa.array(df[at : at + 200_000].astype(np.int64)), pa.array(cf[at : at + 200_000])],
                    names=["group", "term", "df", "cf"])


def _rows(n: int, pieces, build) -> pa.Array:
    """One list of structs a row, from pieces in the order of the rows."""
    sizes, parts = np.zeros(n, np.int64), []
    for row, term, tf, _ in pieces:
        sizes += np.bincount(row, minlength=n)
        parts.append((row, term, tf))
    row, term, tf = (np.concatenate([p[i] for p in parts]) if parts else np.empty(0, np.int64) for i in range(3))
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    columns = build(row, term, tf, n)
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(c)) for c in columns.values()], names=list(columns))


def _sliced(lists: pa.Array, build) -> pa.Array:
    return pa.concat_arrays([build(lists.slice(at, ROWS_AT_ONCE)) for at in range(0, max(1, len(lists)), ROWS_AT_ONCE)])


def unit_weights(row: np.ndarray, tf: np.ndarray, idf: np.ndarray, n: int) -> np.ndarray:
    """(1 + ln tf) * idf, scaled to unit length within each row."""
    weight = (np.log(tf) + 1) * idf
    norm = np.sqrt(np.bincount(row, weights=weight * weight, minlength=n))[row]
    return np.divide(weight, norm, out=np.zeros(len(weight)), where=norm > 0)


def weighted(lists: pa.Array, kind: str, low: int, high: int, known: pa.Array, idf: np.ndarray) -> pa.Array:
    """struct(indices, values) of each list of tokens."""
    return _sliced(lists, lambda part: _rows(len(part), counted(part, kind, low, high, known), lambda row, term, tf, n: {
        "indices": term.astype(np.int32), "values": unit_weights(row, tf, idf[term], n)}))


def numbered(lists: pa.Array, kind: str, low: int, high: int, known: pa.Array) -> pa.Array:
    """struct(ids, counts) of each list of tokens."""
    return _sliced(lists, lambda part: _rows(len(part), counted(part, kind, low, high, known), lambda row, term, tf, n: {
        "ids": term.astype(np.int32), "counts": tf.astype(np.float64)}))


def numbering(spark, listed: list[str], spec):
    """A function of a column of tokens: struct(ids, counts) of the terms listed, the ids their places in the list."""
    from pyspark.sql import functions as F

    shared = spark.sparkContext.broadcast(listed)
    kind, low, high = spec.kind, spec.low, spec.high
    known: list[pa.Array] = []

    @F.arrow_udf("struct<ids:array<int>,counts:array<double>>")
    def terms(tokens: pa.Array) -> pa.Array:
        if not known:
            known.append(pa.array(shared.value, pa.string()))
        return numbered(tokens, kind, low, high, known[0])

    return terms


def placed(held: pa.StructArray, places: np.ndarray, idf: np.ndarray) -> pa.Array:
    """struct(indices, values) of each struct(ids, counts): places of the numbers that have one (-1: none), weights of unit length."""
    lists, counts = held.field("ids"), held.field("counts")
    row = np.repeat(np.arange(len(held)), _lengths(lists))
    term, tf = places[lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)], counts.flatten().to_numpy(zero_copy_only=False)
    keep = term >= 0
    return _rows(len(held), [(row[keep], term[keep], tf[keep], None)], lambda row, term, tf, n: {
        "indices": term.astype(np.int32), "values": unit_weights(row, tf, idf[term], n)})
