"""Removal of repeated passages by recompression.

A text is a row of words, and a round makes it shorter: first every run of one symbol becomes a symbol, then every pair of a `left`
symbol and the `right` one after it. The name of a run or a pair is a hash of its parts, and its side in a round a bit of its name, so
all tasks name equal runs and pairs alike, and equal passages get equal symbols except near their ends. How far in that holds is kept
with each symbol: [lo, hi) are the words that decide that it stands there. A window of words that holds all of them holds the symbol,
wherever else the window occurs.

The witness of a window is a symbol of the highest round that it decides, of these the one of the smallest name, as long as symbols are
so short that nearly every window decides one. A window that occurs twice has one witness in both places, and there, left or right of
the witness, holds the same CONTEXT: half of the words that the window has besides. Two Spark rounds follow. The first groups witnesses
by name and context: where neither side occurs in two places, no window over the witness repeats. The second groups the remaining
windows by their witness and compares them by a hash of all their words; all but the earliest of each lose their words. Windows
without a witness (inside long runs, in short texts) meet by a second hash.

Of equal texts one takes part, the others go whole. A task sends each name, and each window, once for GROUP_BYTES of text, however
often it occurs there, so a frequent one is as many rows as there are such groups. 128 bits stand for a text and for a window, 64 for
a word and for a symbol with its context (which only propose).
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterator
from functools import partial

from pyspark.sql import DataFrame, functions as F

from entlens.llm.common import pieces, run_batches
from entlens.session import materialise

WINDOW = 20
GROUP_BYTES = 5_000_000
PIECE_WORDS = 100_000
#: The number of the word where a symbol starts, its round and the side of its context make a place.
LEVEL_BITS, SIDE_BITS = 5, 1
FAR = 1 << 40
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


def _mix(z):
    import numpy as np

    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def word_hashes(text: bytes):
    """(a 64-bit hash of each word, the SHA-256 of the words joined by one space)."""
    import numpy as np
    import xxhash

    parts, joined, between = [], hashlib.sha256(), b""
    for piece in pieces(text):
        words = piece.split()
        if words:
            parts.append(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))
            joined.update(between + b" ".join(words))
            between = b" "
    return np.concatenate(parts) if parts else np.empty(0, np.uint64), joined.hexdigest()


def _round(words, level: int, name, start, end, lo, hi, first, last):
    """One round over symbols: name, words [start, end), deciding words [lo, hi), and whether they stand first or last in their text."""
    import numpy as np

    c1, c2, c3, _ = (np.uint64(m) for m in MULTIPLIERS)
    t = np.uint64(level)
    # Runs: the neighbour on either side is another symbol. One unlike word next to it shows that, else the neighbour has to be known.
    begin = first | np.concatenate([[True], name[1:] != name[:-1]])
    b = np.flatnonzero(begin)
    e = np.append(b[1:], len(name)) - 1
    count = e - b + 1
    name = np.where(count > 1, _mix(name[b] * c1 + count.astype(np.uint64) * c2 + t), name[b])
    lo, hi = np.minimum.reduceat(lo, b), np.maximum.reduceat(hi, b)
    start, end, first, last = start[b], end[e], first[b], last[e]
    before, after = np.maximum(np.arange(len(b)) - 1, 0), np.minimum(np.arange(len(b)) + 1, len(b) - 1)
    plain_left = words[np.maximum(start - 1, 0)] != words[end - 1]
    plain_right = words[np.minimum(end, len(words) - 1)] != words[start]
    known_lo = np.where(first, -FAR, np.where(plain_left, start - 1, np.minimum(lo, lo[before])))
    known_hi = np.where(last, FAR, np.where(plain_right, end + 1, np.maximum(hi, hi[after])))
    known_lo = np.where(~last & ~plain_right, np.minimum(known_lo, lo[after]), known_lo)
    known_hi = np.where(~first & ~plain_left, np.maximum(known_hi, hi[before]), known_hi)
    lo, hi = np.minimum(lo, known_lo), np.maximum(hi, known_hi)
    # Pairs of a left symbol and a right one. One that stays single does so because of the neighbour it would have gone with.
    left = (_mix(name + t * c3) & np.uint64(1 << 17)) != 0
    head = left & ~last & ~left[after]
    tail = np.concatenate([[False], head[:-1]])
    single = ~head & ~tail
    with_next, with_last = single & left, single & ~left
    new_lo, new_hi = lo.copy(), hi.copy()
    new_lo[with_next], new_hi[with_next] = np.minimum(lo, lo[after])[with_next], np.where(last, FAR, np.maximum(hi, hi[after]))[with_next]
    new_lo[with_last], new_hi[with_last] = np.where(first, -FAR, np.minimum(lo, lo[before]))[with_last], np.maximum(hi, hi[before])[with_last]
    new_lo[head], new_hi[head] = np.minimum(lo, lo[after])[head], np.maximum(hi, hi[after])[head]
    name = np.where(head, _mix(name * c2 + _mix(name[after] + c1) + t), name)
    end, last = np.where(head, end[after], end), np.where(head, last[after], last)
    keep = ~tail
    return tuple(x[keep] for x in (name, start, end, new_lo, new_hi, first, last))


def rounds(window: int) -> int:
    """Rounds until symbols have an eighth of a window's words; a round leaves about three symbols of four."""
    return max(1, round(math.log(max(window, 8) / 8) / math.log(4 / 3)))


def witnesses(words, sizes, window: int):
    """For texts of `sizes` words one after the other, of all windows: the start, the witness's name, its place (-1 without one), the
    hash of the witness with its context to the left and whether the window holds that, the same to the right."""
    import numpy as np

    n = len(words)
    sizes = np.asarray(sizes)
    ends = np.cumsum(sizes)
    stop, begin = np.repeat(ends, sizes), np.repeat(ends - sizes, sizes)
    at = np.arange(n)
    starts = np.flatnonzero(at + window <= stop)
    is_open = np.zeros(n, bool)
    is_open[starts] = True
    name, place, low_at, high_at = np.zeros(n, np.uint64), np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    with np.errstate(over="ignore"):
        levels, state = [], (words, at, at + 1, at, at + 1, at == begin, at + 1 == stop)
        for level in range(1, rounds(window) + 1) if len(starts) else ():
            state = _round(words, level, *state)
            symbol, start, _, lo, hi = state[:5]
            inner = np.flatnonzero(hi - lo <= window)
            levels.append((level, symbol[inner], start[inner], lo[inner], hi[inner]))
        for level, symbol, start, lo, hi in reversed(levels):
            low, high = np.maximum(hi - window, begin[start]), np.minimum(lo, stop[start] - window)
            count = np.maximum(high - low + 1, 0)
            which = np.repeat(np.arange(len(symbol)), count)
            over = low[which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            wanted = is_open[over]
            which, over = which[wanted], over[wanted]
            rank = _mix(symbol)
            best = np.full(n, 0xFFFFFFFFFFFFFFFF, np.uint64)
            np.minimum.at(best, over, rank[which])
            won = rank[which] == best[over]
            which, over = which[won][::-1], over[won][::-1]  # the leftmost of equal names is written last
            name[over], place[over], is_open[over] = symbol[which], start[which] << LEVEL_BITS | level, False
            low_at[over], high_at[over] = lo[which], hi[which]
        name, place, lo, hi = (x[starts] for x in (name, place, low_at, high_at))
        found, first, inverse = np.unique(place, return_index=True, return_inverse=True)
        half = (window - (hi - lo)) // 2
        sides = []
        for side, (holds, edge) in enumerate(((lo - starts >= half, lo - half), (starts + window - hi >= half, hi))):
            # Of an occurrence's windows those that hold the context agree on it.
            mixed = name[first] + np.uint64(side)
            for k in range(int(half.max(initial=0))):
                inside = np.clip(edge[first] + k, 0, n - 1)
                mixed = np.where(k < half[first], _mix(mixed * np.uint64(MULTIPLIERS[0]) + words[inside]), mixed)
            sides += [mixed[inverse], holds & (place >= 0)]
    return starts, name, place, *sides


def _segments(hashes: list, window: int):
    """Texts in pieces of at most PIECE_WORDS, long ones in several that share all but one word of a window."""
    for row, words in enumerate(hashes):
        for at in range(0, max(len(words) - window + 1, 0), PIECE_WORDS):
            yield row, at, words[at:at + PIECE_WORDS + window - 1]


def _windows(hashes: list, window: int):
    """What `witnesses` gives for the windows of many texts, some texts at a time: (row, start in its text, name, place in the text or
    -1, left, holds left, right, holds right, words, start in these)."""
    import numpy as np

    held, size = [], 0
    for segment in [*_segments(hashes, window), None]:
        if held and (segment is None or size + len(segment[2]) > PIECE_WORDS + window):
            rows, offsets, parts = zip(*held)
            sizes = np.array([len(p) for p in parts])
            words = np.concatenate(parts)
            starts, name, place, *sides = witnesses(words, sizes, window)
            which = np.searchsorted(np.cumsum(sizes), starts, side="right")
            shift = (np.array(offsets) - (np.cumsum(sizes) - sizes))[which]
            yield np.array(rows)[which], starts + shift, name, np.where(place < 0, -1, place + (shift << LEVEL_BITS)), *sides, words, starts
            held, size = [], 0
        if segment is not None:
            held.append(segment)
            size += len(segment[2])


def _marks(row, place, side: int):
    """A number for a text of a group, a place in it and a side; the text's number stands above bit 40."""
    return row << 40 | place << SIDE_BITS | side


def _groups(batches: Iterator):
    """Rows of about GROUP_BYTES of text at a time, as tables; the text is the last column."""
    import pyarrow as pa
    import pyarrow.compute as pc

    held, size = [], 0
    for batch in batches:
        lengths = pc.binary_length(batch.column(batch.num_columns - 1)).to_pylist()
        at = 0
        for i, length in enumerate(lengths):
            size += (length or 0) + 100
            if size >= GROUP_BYTES:
                held.append(batch.slice(at, i + 1 - at))
                yield pa.Table.from_batches(held)
                held, size, at = [], 0, i + 1
        if at < batch.num_rows:
            held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


#: What is known of a row: whether it has no key, the key, the second hash of its text, its words.
ROW_FORMAT = struct.Struct("<?qqq")


def _witness_batches(batches: Iterator, window: int):
    """Rows (run, t1, place, info): a witness with a context under their hash, its place negative (and less one) if they occur again in
    this group of texts; under t1 the places known to occur again, -1 for a text with windows without a witness, and for each input
    row what is known of it."""
    import numpy as np
    import pyarrow as pa

    for table in _groups(batches):
        none, doc, t1, t2 = (table.column(c).to_pylist() for c in ("none", "doc", "t1", "t2"))
        seen, hashes, infos = set(), [], []
        for i, text in enumerate(table.column("_text")):
            words, joined = word_hashes(text.as_py() or b"")
            infos.append(ROW_FORMAT.pack(none[i], doc[i], t2[i], len(words)) + bytes.fromhex(joined))
            hashes.append(words if (t1[i], t2[i]) not in seen else words[:0])
            seen.add((t1[i], t2[i]))
        t1 = np.array(t1, np.int64)
        is_open, found = np.zeros(len(t1), bool), [(np.empty(0, np.int64), np.empty(0, np.uint64))]
        for row, _, _, place, left, has_left, right, has_right, *_ in _windows(hashes, window):
            is_open[row[place < 0]] = True
            for side, (key, has) in enumerate(((left, has_left), (right, has_right))):
                mark, at = np.unique(_marks(row[has], place[has], side), return_index=True)
                found.append((mark, key[has][at]))
        mark, at = np.unique(np.concatenate([m for m, _ in found]), return_index=True)
        key = np.concatenate([k for _, k in found])[at]
        _, at, inverse, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        row, place = mark >> 40, mark & ((1 << 40) - 1)
        again = count[inverse] > 1
        parts = [(key[at].view(np.int64), t1[row[at]], np.where(again[at], -2 - place[at], place[at])), (t1[row[again]], t1[row[again]], place[again]),
                 (t1[is_open], t1[is_open], np.full(is_open.sum(), -1))]
        for (run, text, place), plain in zip(parts, (True, False, False)):
            # An empty info marks what passes through.
            yield pa.RecordBatch.from_arrays([pa.array(run), pa.array(text), pa.array(place.astype(np.int64)), pa.array([None if plain else b""] * len(run), pa.binary())], names=["run", "t1", "place", "info"])
        yield pa.RecordBatch.from_arrays([pa.array(t1), pa.array(t1), pa.nulls(len(t1), pa.int64()), pa.array(infos, pa.binary())], names=["run", "t1", "place", "info"])


def _begins(*columns):
    """Where a new group of equal values begins, in sorted columns."""
    import numpy as np

    new = np.zeros(len(columns[0]), bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    new[:1] = True
    return new


def _numpy(table, *names):
    return [table.column(c).to_numpy() for c in names]


def _repeated(table):
    """The places of witnesses that stand with a context in more than one, those known before, and the input rows."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    info = table.column("info")
    kind = pc.fill_null(pc.binary_length(info), -1).to_numpy()
    run, t1, place = (table.column(c).fill_null(0).to_numpy() for c in ("run", "t1", "place"))
    at = np.flatnonzero(kind < 0)
    twice = place[at] < 0
    run, text, spot = run[at], t1[at], np.where(twice, -2 - place[at], place[at])
    order = np.lexsort((spot, text, run))
    run, text, spot, twice = (x[order] for x in (run, text, spot, twice))
    if len(run):
        first, new = np.flatnonzero(_begins(run)), _begins(run, text, spot)
        several = np.logical_or.reduceat(twice, first) | (np.add.reduceat(new.astype(np.int64), first) > 1)
        several = several[np.cumsum(_begins(run)) - 1] & new
        text, spot = text[several], spot[several]
    known = kind == 0
    rows = [ROW_FORMAT.unpack_from(x) + (x[ROW_FORMAT.size:].hex(),) for x in info.filter(pa.array(kind > 0)).to_pylist()]
    none, doc, t2, n_words, digest = zip(*rows) if rows else ((), (), (), (), ())
    n = len(text) + int(known.sum())
    places = pa.array(np.concatenate([text, t1[known], t1[kind > 0]])), pa.concat_arrays([pa.array(np.concatenate([spot, place[known]])), pa.nulls(len(rows), pa.int64())])
    types = [("none", none, pa.bool_()), ("doc", doc, pa.int64()), ("t2", t2, pa.int64()), ("n_words", n_words, pa.int64()), ("words_sha256", digest, pa.string())]
    return pa.RecordBatch.from_arrays([*places, *(pa.concat_arrays([pa.nulls(n, t), pa.array(v, t)]) for _, v, t in types)], names=["t1", "place", *(name for name, _, _ in types)])


def _joined(*columns):
    """Where a new stretch begins: the last column no longer counts up by one, or another one changes."""
    import numpy as np

    new = _begins(*columns[:-1])
    new[1:] |= columns[-1][1:] != columns[-1][:-1] + 1
    return np.flatnonzero(new)


def _window_batches(batches: Iterator, window: int):
    """Windows that may repeat: under their witness, neighbours together, with a hash of their words; those that are not the earliest
    of this group of texts are known to go and have no hash."""
    import numpy as np
    import pyarrow as pa

    b1, b2 = np.uint64(MULTIPLIERS[0]), np.uint64(MULTIPLIERS[3])
    for table in _groups(batches):
        hashes = [word_hashes(t.as_py() or b"")[0] for t in table.column("_text")]
        marks = table.column("marks").combine_chunks()
        which, spots = np.repeat(np.arange(table.num_rows), marks.value_lengths().to_numpy()), marks.flatten().to_numpy()
        marked = np.unique((which << 40 | spots)[spots >= 0])
        none, doc, t1, t2 = _numpy(table, "none", "doc", "t1", "t2")
        rank = np.empty(table.num_rows, np.int64)
        rank[np.lexsort((t2, t1, doc, none))] = np.arange(table.num_rows)
        found = []
        for row, start, name, place, _, has_left, _, has_right, words, at in _windows(hashes, window):
            some = place < 0
            for side, has in enumerate((has_left, has_right)):
                some |= has & np.isin(_marks(row, place, side), marked)
            row, start, name, place, at = (x[some] for x in (row, start, name, place, at))
            one, two = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
            with np.errstate(over="ignore"):
                for k in range(window):
                    one, two = one * b1 + words[at + k], two * b2 + _mix(words[at + k])
                found.append((row, start, np.where(place < 0, _mix(two), name).view(np.int64), one.view(np.int64)))
        if not found:
            continue
        row, start, run, one = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((start, rank[row], one, run))
        row, start, run, one = (x[order] for x in (row, start, run, one))
        sent = _begins(run, one)
        for pick, to_send in ((sent, True), (~sent, False)):
            r, s, k, h = (x[pick] for x in (row, start, run, one))
            if not len(r):
                continue
            order = np.lexsort((s, r))
            r, s, k, h = (x[order] for x in (r, s, k, h))
            first = _joined(r, k, s) if to_send else _joined(r, s)
            size = np.diff(np.append(first, len(r)))
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(r)).astype(np.int32)), pa.array(h)) if to_send else pa.array([[]] * len(first), pa.list_(pa.int64()))
            r, s, k = r[first], s[first], k[first]
            yield pa.RecordBatch.from_arrays([pa.array(k if to_send else t1[r]), *(pa.array(x[r]) for x in (none, doc, t1, t2)), pa.array(s), lists, pa.array(np.zeros(len(r), np.int64) if to_send else size)],
                                             names=["run", "none", "doc", "t1", "t2", "start", "hashes", "n"])


def _later(table):
    """Stretches of windows that are not the earliest of their kind."""
    import numpy as np
    import pyarrow as pa

    run, none, doc, t1, t2, start, known = _numpy(table, "run", "none", "doc", "t1", "t2", "start", "n")
    lists = table.column("hashes").combine_chunks()
    size = lists.value_lengths().to_numpy()
    which = np.repeat(np.arange(len(run)), size)
    at = start[which] + np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
    one = lists.flatten().to_numpy()
    order = np.lexsort((at, t2[which], t1[which], doc[which], none[which], one, run[which]))
    which, at, one = which[order], at[order], one[order]
    later = ~_begins(run[which], one)
    a, b, s = t1[which[later]], t2[which[later]], at[later]
    order = np.lexsort((s, b, a))
    a, b, s = a[order], b[order], s[order]
    first = _joined(a, b, s) if len(a) else np.empty(0, np.int64)
    n = np.diff(np.append(first, len(a)))
    old = known > 0
    columns = [np.concatenate(x) for x in ((a[first], t1[old]), (b[first], t2[old]), (s[first], start[old]), (n, known[old]))]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["t1", "t2", "start", "n"])


def _cut_batches(batches: Iterator, window: int):
    """The words that repeated windows cover, as spans, and the others joined by one space."""
    import pyarrow as pa

    for batch in batches:
        spans, texts = [], []
        for found, text in zip(batch.column("found").to_pylist(), batch.column("_text")):
            merged: list[list[int]] = []
            for s in sorted((f["start"], f["start"] + f["n"] - 1 + window) for f in found):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append(list(s))
            words, kept, at = text.as_py().split(), [], 0
            for low, high in merged:
                kept += words[at:low]
                at = high
            spans.append([{"start": a, "end": b} for a, b in merged])
            texts.append(b" ".join(kept + words[at:]))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("none", "doc", "t1", "t2")), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                                          pa.array(texts, pa.binary())], names=["none", "doc", "t1", "t2", "spans", "kept"])


SPANS = "array<struct<start long, end long>>"
TEXT, ROW = ["t1", "t2"], ["none", "doc", "t1", "t2"]


def drop_repeats(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for every input row: the key, n_words, spans (the words removed, from `start` up to `end`), kept (the other words joined by
    one space; null if none were removed) and words_sha256 (of all words joined by one space).

    A word goes if a window of `window` words over it also starts earlier: in a row of a smaller key or before it in its own text, as the
    input has it. Words are what stands between ASCII white space; a null text has none. A text of fewer than `window` words is kept.
    Rows without a key come after all others; rows of one key with different texts in the order of two hashes of these; of rows alike
    in both the first stands for all. Columns other than the two are not read. An empty table gives no rows.
    """
    raw = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    doc = F.col(f"`{key}`").cast("long")
    rows = docs.select(doc.isNull().alias("none"), F.coalesce(doc, F.lit(0).cast("long")).alias("doc"), F.xxhash64(raw).alias("t1"), F.xxhash64(F.lit(window), raw).alias("t2"), raw.alias("_text"))
    sent = rows.mapInArrow(partial(_witness_batches, window=window), "run long, t1 long, place long, info binary").repartition("run").sortWithinPartitions("run")
    known = materialise(sent.mapInArrow(partial(run_batches, linked=_repeated), "t1 long, place long, none boolean, doc long, t2 long, n_words long, words_sha256 string"), "witnesses")
    own = known.where("place IS NULL")
    firsts = own.groupBy(*TEXT).agg(F.min(F.struct("none", "doc")).alias("f")).select(*TEXT, "f.none", "f.doc")
    marks = known.where("place IS NOT NULL").groupBy("t1").agg(F.collect_set("place").alias("marks"))  # one text's witnesses at most
    marks = materialise(marks.join(firsts, "t1"), "marks")
    texts = rows.groupBy(*ROW).agg(F.first("_text").alias("_text")).join(marks, ROW).select(*ROW, "marks", "_text")
    texts = materialise(texts, "open-texts")
    # Which of the windows over them are not the earliest.
    windows = texts.mapInArrow(partial(_window_batches, window=window), "run long, none boolean, doc long, t1 long, t2 long, start long, hashes array<long>, n long")
    later = windows.repartition("run").sortWithinPartitions("run").mapInArrow(partial(run_batches, linked=_later), "t1 long, t2 long, start long, n long")
    later = later.groupBy(*TEXT).agg(F.collect_list(F.struct("start", "n")).alias("found"))  # one text's windows at most
    later = materialise(later, "later-windows")
    cut = texts.select(*ROW, "_text").join(later, TEXT).select(*ROW, "found", "_text").mapInArrow(partial(_cut_batches, window=window), f"none boolean, doc long, t1 long, t2 long, spans {SPANS}, kept binary")
    # The first row of each text takes part; all others repeat it.
    same = own.groupBy(*ROW).agg(F.count("*").alias("rows"), F.first("n_words").alias("n_words"), F.first("words_sha256").alias("words_sha256"))
    same = same.join(firsts.select(*ROW, F.lit(True).alias("is_first")), ROW, "left").join(cut, ROW, "left")
    same = same.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    alone = F.col("is_first").isNotNull() & (F.col("row") == 1)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))
    nothing = F.array().cast(SPANS)
    spans = F.when(alone, F.coalesce("spans", nothing)).when(F.col("n_words") >= window, whole).otherwise(nothing)
    kept = F.when(alone, F.col("kept").cast("string")).when(F.col("n_words") >= window, F.lit(""))
    return same.select(F.when(~F.col("none"), F.col("doc")).alias(key), "n_words", spans.alias("spans"), kept.alias("kept"), "words_sha256")
