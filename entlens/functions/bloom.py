"""A Bloom filter of a table's keys, tested inside the row: what cannot be a key is dropped before it becomes a row of its own."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

HASHES = 8
BITS_PER_KEY = 24
#: 2 MB, the most that is put into a plan. More keys than fit let more through; none is ever lost.
MOST_BITS = 1 << 24


@dataclass(frozen=True)
class KeyFilter:
    words: tuple[int, ...]  # 64 bits each

    @classmethod
    def of(cls, keys: DataFrame, column: str, most_bits: int = MOST_BITS) -> KeyFilter:
        """One aggregate: set bits are combined by word in the tasks; at most MOST_BITS / 64 words come back."""
        n = keys.count()
        bits = 64
        while bits < min(max(n * BITS_PER_KEY, 64), most_bits):
            bits *= 2
        places = F.explode(F.array(*[cls._place(F.col(column), i, bits) for i in range(HASHES)])).alias("at")
        rows = keys.where(F.col(column).isNotNull()).select(places).groupBy(F.floor(F.col("at") / 64).alias("word")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))).alias("bits")).collect()
        words = [0] * (bits // 64)
        for r in rows:
            words[r["word"]] = r["bits"]
        return cls(tuple(words))

    @staticmethod
    def _place(key: Column, i: int, bits: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(i), key), F.lit(bits).cast("long"))

    def may_hold(self, key: Column) -> Column:
        """False for certain where the key is not in the table; the first unset bit settles it."""
        words = F.from_json(F.lit(json.dumps(self.words)), "array<long>")
        out = None
        for i in range(HASHES):
            at = self._place(key, i, 64 * len(self.words))
            bit = F.call_function("shiftrightunsigned", F.get(words, F.floor(at / 64).cast("int")), (at % 64).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1
            out = bit if out is None else out & bit
        return F.coalesce(out, F.lit(False))
