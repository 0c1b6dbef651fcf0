"""Byte-level BPE encoding and decoding with DuckDB recursive queries in each partition.

A task cuts its texts into the pattern's matches and hands the matches it has not met before to DuckDB. There a recursive
query joins token-position rows with the merge table and contracts each word's leftmost pair of least rank until no pair is
left; an ordered aggregation turns the ids of each word back into bytes. Texts are then put together from their words.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import partial

from pyspark.sql import DataFrame, functions as F, types as T

# Bounds of a task's memory: text taken at once, words handed to DuckDB at once, words remembered between texts.
CHUNK_CHARS, WORDS_AT_ONCE, WORDS_KEPT = 2_000_000, 20_000, 1_000_000
# From this length on a word's earlier states are replaced instead of kept until the fixpoint.
LONG_WORD = 256

# A pass contracts one pair in every word that has one; the others drop out of the recursion. A candidate is one number: the
# merged id, which is the pair's rank, above its place, so that the least is the leftmost pair of least rank.
PASS = """
    SELECT {count} s.word, s.tokens[:(b.best & 16777215) - 1] || [CAST(b.best >> 24 AS INT)] || s.tokens[(b.best & 16777215) + 2:]
    FROM step s JOIN (
        SELECT p.word, min((CAST(m.merged AS BIGINT) << 24) | p.place) AS best
        FROM (SELECT word, unnest(tokens[:-2]) AS token, unnest(tokens[2:]) AS next, unnest(range(1, len(tokens))) AS place FROM step) p
        JOIN merges m ON m.pair = ((CAST(p.token AS BIGINT) << 20) | p.next)
        GROUP BY p.word) b ON b.word = s.word
"""
DECODE = """
placed AS (SELECT word, unnest(tokens) AS token, unnest(range(len(tokens))) AS place FROM fixed)
SELECT p.word, list(p.token ORDER BY p.place) AS ids, string_agg(v.hex, '' ORDER BY p.place) AS decoded
FROM placed p JOIN vocabulary v ON v.token = p.token GROUP BY p.word ORDER BY p.word
"""
ENCODE = f"""WITH RECURSIVE step(pass, word, tokens) AS (
    SELECT 0, word, tokens FROM fresh UNION ALL {PASS.format(count="s.pass + 1,")}),
fixed AS (SELECT word, arg_max(tokens, pass) AS tokens FROM step GROUP BY word), {DECODE}"""
ENCODE_LONG = f"""WITH RECURSIVE step(word, tokens) USING KEY (word) AS (
    SELECT word, tokens FROM fresh UNION {PASS.format(count="")}),
fixed AS (SELECT word, tokens FROM step), {DECODE}"""


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: a base64 token and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_table(ranks: dict[bytes, int]) -> list[tuple[int, int, int]]:
    """(left, right, merged) for every way to cut a token into two tokens. The merged id is also the rank of the pair."""
    return [(ranks[token[:i]], ranks[token[i:]], rank) for token, rank in ranks.items()
            for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]


class Store:
    """Values of many words end to end, with the place where each ends."""

    def __init__(self, kind: str):
        import numpy as np

        self.values, self.ends = np.empty(0, kind), np.zeros(1, np.int64)

    def add(self, values, lengths) -> None:
        import numpy as np

        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths, dtype=np.int64)])
        self.values = np.concatenate([self.values, values])

    def joined(self, slots):
        """The values of these words end to end, and the place where each begins, with the end of the last."""
        import numpy as np

        lengths = self.ends[slots + 1] - self.ends[slots]
        to = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])
        places = np.arange(to[-1], dtype=np.int64)
        places += np.repeat(self.ends[slots] - to[:-1], lengths)
        return self.values[places], to


class Coder:
    """A task's DuckDB connection with the merge table, and the words coded so far.

    Texts are looked up by the runs between single spaces, each taken with the space before it. No match of the pattern reaches
    over such a cut as long as no two white-space characters touch and none ends the text; other texts are matched whole.
    """

    def __init__(self, path: str, pattern: str):
        import re

        import duckdb
        import numpy as np
        import pyarrow as pa
        import regex

        self.ranks = read_ranks(path)
        self.find = regex.compile(pattern).findall
        self.touching = re.compile(r"\s\s|\s\Z").search
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB"})
        left, right, merged = (np.array(x, np.int64) for x in zip(*merge_table(self.ranks), strict=True))
        given = {"merges": pa.table({"pair": (left << 20) | right, "merged": merged}),
                 "vocabulary": pa.table({"token": pa.array(self.ranks.values(), pa.int32()), "hex": pa.array([t.hex() for t in self.ranks])})}
        for name, table in given.items():
            self.db.register("given", table)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.forget()

    def forget(self) -> None:
        self.matches: dict[str, int] = {}  # slots of the pattern's matches
        self.runs: dict[str, int] = {}  # slots of the runs, named without the space before them
        self.ids, self.bytes = Store("int32"), Store("uint8")

    def _learn(self, words: list[str], query: str) -> None:
        import numpy as np
        import pyarrow as pa

        raw = [w.encode("utf-8") for w in words]
        # A word that is a token stays whole, whatever merges would make of it.
        tokens = [self.byte_ids[np.frombuffer(b, np.uint8)] if (r := self.ranks.get(b)) is None else np.array([r], np.int32) for b in raw]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int32)
        fresh = pa.table({"word": pa.array(np.arange(len(words), dtype=np.int32)), "tokens": pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(tokens)))})
        self.db.register("fresh", fresh)
        got = self.db.sql(query).to_arrow_table()
        self.db.unregister("fresh")
        ids = got["ids"].combine_chunks()
        decoded = [bytes.fromhex(x) for x in got["decoded"].to_pylist()]
        self.ids.add(ids.flatten().to_numpy(zero_copy_only=False), ids.value_lengths().to_numpy(zero_copy_only=False))
        self.bytes.add(np.frombuffer(b"".join(decoded), np.uint8), [len(d) for d in decoded])
        start = len(self.ids.ends) - 1 - len(words)
        self.matches.update(zip(words, range(start, start + len(words)), strict=True))

    def learn(self, words: set[str]) -> None:
        fresh = sorted(words.difference(self.matches))
        short, long = [w for w in fresh if len(w) < LONG_WORD], [w for w in fresh if len(w) >= LONG_WORD]
        for i in range(0, len(short), WORDS_AT_ONCE):
            self._learn(short[i:i + WORDS_AT_ONCE], ENCODE)
        for word in long:
            self._learn([word], ENCODE_LONG)

    def learn_runs(self, runs: list[str]) -> None:
        """Runs with the space before them; one of several matches gets a slot of its own."""
        import numpy as np

        cut = [self.find(" " + r) for r in runs]
        self.learn({w for ws in cut for w in ws})
        several = [(r, ws) for r, ws in zip(runs, cut, strict=True) if len(ws) > 1]
        self.runs.update((r, self.matches[ws[0]]) for r, ws in zip(runs, cut, strict=True) if len(ws) == 1)
        if several:
            slots = np.array([self.matches[w] for _, ws in several for w in ws], np.int64)
            ends = np.cumsum([len(ws) for _, ws in several])
            start = len(self.ids.ends) - 1
            for store in (self.ids, self.bytes):
                values, to = store.joined(slots)
                store.add(values, np.diff(to[ends], prepend=0))
            self.runs.update((r, start + i) for i, (r, _) in enumerate(several))

    def code(self, texts: list[str]):
        """(ids, ends of ids by text, bytes, ends of bytes by text) of the texts."""
        import numpy as np

        if len(self.runs) + len(self.matches) > WORDS_KEPT:
            self.forget()
        # First the matches looked up as such (a text's first run, or a whole text), then the runs.
        cut = [(self.find(t), []) if self.touching(t) else (lambda first, *rest: (self.find(first), rest))(*t.split(" ")) for t in texts]
        self.learn({w for words, _ in cut for w in words})
        self.learn_runs(list({r for _, runs in cut for r in runs}.difference(self.runs)))
        slots, ends = [], []
        for words, runs in cut:
            slots += [self.matches[w] for w in words]
            slots += map(self.runs.__getitem__, runs)
            ends.append(len(slots))
        slots = np.array(slots, np.int64)
        ids, id_places = self.ids.joined(slots)
        raw, raw_places = self.bytes.joined(slots)
        return ids, id_places[ends], raw, raw_places[ends]


_coders: dict[tuple[str, str], Coder] = {}


def _coder(path: str, pattern: str) -> Coder:
    """One for each Python worker: the merge table is built once, not for every task."""
    if (path, pattern) not in _coders:
        _coders.clear()
        _coders[path, pattern] = Coder(path, pattern)
    return _coders[path, pattern]


def chunks(texts: list[str | None], most: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Runs of rows with about `most` characters; a longer text has a run of its own."""
    start = held = 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if held and held + n > most:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts)


def _code_batches(batches, path: str, pattern: str):
    import numpy as np
    import pyarrow as pa

    coder = _coder(path, pattern)
    for batch in batches:
        texts = batch.column(batch.num_columns - 1).to_pylist()
        for start, end in chunks(texts):
            ids, id_ends, raw, raw_ends = coder.code([t or "" for t in texts[start:end]])
            id_offsets = np.concatenate([[0], id_ends]).astype(np.int32)
            raw_offsets = np.concatenate([[0], raw_ends]).astype(np.int32)
            rows = [c.slice(start, end - start) for c in batch.columns[:-1]]
            yield pa.RecordBatch.from_arrays(
                [*rows, pa.ListArray.from_arrays(pa.array(id_offsets), pa.array(ids)),
                 pa.Array.from_buffers(pa.binary(), end - start, [None, pa.py_buffer(raw_offsets), pa.py_buffer(raw)])],
                names=[*batch.schema.names[:-1], "ids", "decoded"])


def encode_decode(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (default: all but the text), ids (array<int>) and decoded (binary, from the ids).

    The ids are those of the tiktoken library without special tokens. A null text counts as empty; an empty text has no ids
    and decodes to no bytes. An input column named ids or decoded is replaced. Each row is coded on its own: repeated rows get
    equal results, and an empty table stays empty. No shuffle; a task holds one chunk of text and a bounded store of words.
    A match of n bytes takes up to n - 1 passes over it, so one unbroken match of many thousand characters is slow, not cut.
    """
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in {text, "ids", "decoded"}]
    rows = docs.select(*[f"`{c}`" for c in keep], F.col(f"`{text}`").alias("_text"))
    kinds = [f for f in rows.schema.fields if f.name != "_text"]
    schema = rows.select(*[f"`{f.name}`" for f in kinds]).schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", T.BinaryType())
    return rows.mapInArrow(partial(_code_batches, path=path, pattern=pattern), schema)
