"""SimHash near-duplicate classes with a pigeonring filter.

A code of `bits` bits is a ring of `segments` equal segments. Of two codes that differ in `radius` bits or fewer, some segment
starts a chain whose first l segments differ in at most l * radius / segments bits, for every l. While that budget is below 1
the chain must agree exactly, so these bits, with the place where the chain starts, are a key: codes meet under equal keys.
The rest of the chain is then held against the growing budgets, and only what passes gets the full Hamming check.

The keys are the exact beginnings that the budgets force, so no pair within the radius is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from entlens.llm.common import pieces, run_batches
from entlens.session import materialise

#: Hashes whose bits are counted at once.
CHUNK = 150_000
#: Rows of one key that a task compares at once; a larger key is dealt in blocks, each pair of blocks to a task of its own.
BLOCK = 2048
SMALL_RUN = 8


@dataclass(frozen=True)
class Scheme:
    words: int = 3  # words in a shingle
    bits: int = 64
    radius: int = 2
    segments: int = 16

    @property
    def width(self) -> int:
        return self.bits // self.segments

    @property
    def exact_bits(self) -> int:
        return self.width * max(n for n in range(1, self.segments) if n * self.radius // self.segments == 0)

    def levels(self) -> list[tuple[int, int]]:
        """(bits of the chain, differences allowed there), the longest chain for each budget, as far as 64 bits reach."""
        longest: dict[int, int] = {}
        for n in range(1, min(self.segments, 64 // self.width) + 1):
            longest[n * self.radius // self.segments] = n * self.width
        return [(n, budget) for budget, n in longest.items()]


#: 3 words, 64 bits, 2 differences; complete.
LINKS = Scheme()


def _mix(h, word: int):
    """Another 64-bit hash from the first; the first is the hash itself."""
    import numpy as np

    if word == 0:
        return h
    with np.errstate(over="ignore"):
        z = h + np.uint64(word * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def shingle_hashes(text: bytes, k: int) -> Iterator:
    """XXH64 (seed 42) of every k-word shingle of the text with A-Z lower-cased, piece by piece; of the whole sequence if it is shorter."""
    import numpy as np
    import xxhash

    digest, words, any_ = xxhash.xxh64_intdigest, [], False
    for piece in pieces(text):
        words += piece.lower().split()
        if len(words) >= k:
            joined = b" ".join(words)
            starts = [0, *accumulate(len(w) + 1 for w in words)]
            yield np.array([digest(joined[a:b - 1], 42) for a, b in zip(starts, starts[k:])], np.uint64)
            words, any_ = words[len(words) - k + 1:], True
    if words and not any_:
        yield np.array([digest(b" ".join(words), 42)], np.uint64)


def codes(texts: list[bytes], scheme: Scheme):
    """The codes as rows of 64-bit words: a bit is 1 if it is in over half the hashes; a text without words is all 0."""
    import numpy as np

    ones = np.zeros((len(texts), scheme.bits), np.int64)
    counts = np.zeros(len(texts), np.int64)
    held, rows, size = [], [], 0

    def add():
        """Count the bits of what is held, by text."""
        sizes = np.array([len(h) for h in held])
        begins = np.cumsum(sizes) - sizes
        hashes = np.concatenate(held)
        for word in range(scheme.bits // 64):
            bits = np.unpackbits(_mix(hashes, word).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            np.add.at(ones[:, 64 * word:64 * word + 64], rows, np.add.reduceat(bits, begins, axis=0, dtype=np.int32))
        np.add.at(counts, rows, sizes)

    for row, text in enumerate(texts):
        for own in shingle_hashes(text, scheme.words):
            held.append(own)
            rows.append(row)
            size += len(own)
            if size >= CHUNK:
                add()
                held, rows, size = [], [], 0
    if held:
        add()
    return np.packbits(2 * ones > counts[:, None], axis=1, bitorder="little").view(np.uint64)


def _code_batches(batches: Iterator, scheme: Scheme):
    import pyarrow as pa

    for batch in batches:
        made = codes([t or b"" for t in batch.column(batch.num_columns - 1).to_pylist()], scheme)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([r.tobytes() for r in made], pa.binary())], names=[*batch.schema.names[:-1], "code"])


def _matrix(column, words: int):
    import numpy as np

    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, words)


def _chain_batches(batches: Iterator, scheme: Scheme, only_keys: bool):
    """Each code under every chain start: key, the 64 bits from there on, and the row it came with."""
    import numpy as np
    import pyarrow as pa

    low = np.uint64((1 << scheme.exact_bits) - 1)
    for batch in batches:
        if not batch.num_rows:
            continue
        bits = np.unpackbits(_matrix(batch.column("code"), scheme.bits // 64).view(np.uint8), axis=1, bitorder="little")
        bits = np.concatenate([bits, bits[:, :64]], axis=1)
        for start in range(scheme.segments):
            at = start * scheme.width
            chain = np.ascontiguousarray(np.packbits(bits[:, at:at + 64], axis=1, bitorder="little")).view(np.uint64)[:, 0]
            key = pa.array(((chain & low) | np.uint64(start << scheme.exact_bits)).view(np.int64))
            if only_keys:
                yield pa.RecordBatch.from_arrays([key], names=["key"])
            else:
                yield pa.RecordBatch.from_arrays([key, pa.array(chain.view(np.int64)), batch.column("doc"), batch.column("code")], names=["key", "chain", "doc", "code"])


def _near(chain_a, chain_b, code_a, code_b, scheme: Scheme):
    """Where the chains keep to their budgets and, of these, the codes to the radius."""
    import numpy as np

    x = chain_a ^ chain_b
    ok = np.ones(x.shape, bool)
    for n, budget in scheme.levels():
        ok &= np.bitwise_count(x & np.uint64((1 << n) - 1)) <= budget
    at = np.nonzero(ok)
    if len(at[0]):
        a, b = (code_a[at], code_b[at]) if x.ndim == 1 else (code_a[at[0]], code_b[at[1]])
        ok[at] = np.bitwise_count(a ^ b).sum(axis=-1) <= scheme.radius
    return ok


def _forest(chain, code, scheme: Scheme) -> Iterator[tuple[int, int]]:
    """(root, member) for the components of one key's rows: as many links as it takes, not one for each pair."""
    import numpy as np

    n = len(chain)
    near = np.zeros((n, n), bool)
    for i in range(0, n, 256):
        near[i:i + 256] = _near(chain[i:i + 256, None], chain[None, :], code[i:i + 256], code, scheme)
    left = np.ones(n, bool)
    for root in range(n):
        if not left[root]:
            continue
        left[root] = False
        edge = near[root] & left
        while edge.any():
            left &= ~edge
            yield from ((root, int(j)) for j in np.flatnonzero(edge))
            edge = near[edge].any(axis=0) & left


def _linked(scheme: Scheme, table):
    """Links (a, b) among rows of equal `run` in a table sorted by it."""
    import numpy as np
    import pyarrow as pa

    run = table.column("run").to_numpy()
    chain = table.column("chain").to_numpy().view(np.uint64)
    code = _matrix(table.column("code"), scheme.bits // 64)
    doc = table.column("doc").to_numpy()
    begins = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    sizes = np.diff(np.concatenate([begins, [len(run)]]))
    small = np.repeat(sizes <= SMALL_RUN, sizes)
    a, b = [], []
    for d in range(1, SMALL_RUN):
        i = np.flatnonzero((run[d:] == run[:-d]) & small[d:]) if d < len(run) else np.empty(0, np.int64)
        i = i[_near(chain[i], chain[i + d], code[i], code[i + d], scheme)]
        a.append(i)
        b.append(i + d)
    for at, n in zip(begins[sizes > SMALL_RUN], sizes[sizes > SMALL_RUN]):
        pairs = list(_forest(chain[at:at + n], code[at:at + n], scheme))
        if pairs:
            found = np.array(pairs) + at
            a.append(found[:, 0])
            b.append(found[:, 1])
    a, b = np.concatenate(a), np.concatenate(b)
    return pa.RecordBatch.from_arrays([pa.array(doc[a]), pa.array(doc[b])], names=["a", "b"])


def _met(nodes: DataFrame, make, schema: str, linked) -> DataFrame:
    """Links (a, b) that `linked` finds among rows of equal key; `make` gives the rows of a batch of nodes, or only their keys."""
    keys = nodes.mapInArrow(partial(make, only_keys=True), "key long")
    crowded = materialise(keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK), "crowded-keys")
    rows = nodes.mapInArrow(partial(make, only_keys=False), f"key long, {schema}")
    columns = rows.columns[1:]
    if crowded.limit(1).count():
        # Deal a crowded key in blocks of about half the bound: a row meets each block of its key in one task.
        parts = crowded.select("key", F.ceil(2 * F.col("n") / BLOCK).cast("int").alias("parts"))
        rows = rows.join(parts, "key", "left").withColumn("part", F.pmod(F.xxhash64("code"), F.coalesce("parts", F.lit(1))).cast("int"))
        met = F.when(F.col("parts").isNull(), F.array(F.lit(None).cast("long"))).otherwise(F.transform(
            F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.xxhash64("key", F.least("part", p), F.greatest("part", p))))
        rows = rows.withColumn("pair", F.explode(met)).withColumn("run", F.coalesce("pair", "key"))
    else:
        rows = rows.withColumn("run", F.col("key"))
    rows = rows.select("run", *columns).repartition("run").sortWithinPartitions("run", "doc")
    return rows.mapInArrow(partial(run_batches, linked=linked), "a long, b long").distinct()


def similar_pairs(nodes: DataFrame, scheme: Scheme) -> DataFrame:
    """Links (a, b) between the `doc` of different codes; `nodes` has doc (long, not null) and code, each code once.

    Not every pair is a row: of the rows that meet under a key only a spanning forest is given, which keeps every component.
    """
    return _met(nodes, partial(_chain_batches, scheme=scheme), "chain long, doc long, code binary", partial(_linked, scheme))


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of a link. Alternating large and small stars.

    Each half round is a minimum per node, combined before it moves, and a join of the links with it. Rounds are written to
    the shared folder. It ends when a round changes nothing; the number of rounds grows with the logarithm of the nodes.
    """
    edges = materialise(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")

    def state(df: DataFrame):
        row = df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(row)

    seen = state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        large = materialise(large, "large-star")
        # Here u > v in every row.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = materialise(small.where(F.col("u") != F.col("v")).distinct(), "small-star")
        now = state(edges)
        if now == seen:
            break
        seen = now
    ends = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return ends.unionByName(ends.select(F.col("component").alias("node"), "component").distinct())


def near_duplicates(docs: DataFrame, scheme: Scheme = LINKS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for every input row: key, code (binary, the 64-bit words little-endian), component_id, group_id and text_hash.

    component_id is the smallest key reachable over links between codes, the row's own included; group_id names the same component
    whether or not any of its rows has a key. Rows of equal code are one node, whatever their number. A null text counts as empty;
    texts without a word share the code 0, which is linked like any other. A row with a null key is never the smallest key; a
    component without keys has none. text_hash is a 64-bit hash of the text. Other columns are not read. An empty table gives no rows.
    """
    raw = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc"), F.xxhash64(raw).alias("text_hash"), raw.alias("_text"))
    rows = materialise(rows.mapInArrow(partial(_code_batches, scheme=scheme), "doc long, text_hash long, code binary"), "codes")
    # A code of 64 bits is its node's number, longer ones are hashed.
    number = (F.conv(F.hex("code"), 16, 10).cast("decimal(20,0)") - F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("long") if scheme.bits == 64 else F.xxhash64("code")
    nodes = materialise(rows.groupBy("code").agg(F.min("doc").alias("doc")).withColumn("node", number), "code-nodes")
    classes = components(similar_pairs(nodes.select(F.col("node").alias("doc"), "code"), scheme))
    named = nodes.join(classes, "node", "left").select("code", "doc", F.coalesce("component", "node").alias("group_id"))
    named = materialise(named, "named-codes")
    # Most components are one code; the smallest key of the others is a join of their few rows.
    least = named.groupBy("group_id").agg(F.min("doc").alias("component_id"), F.count("*").alias("n")).where(F.col("n") > 1).drop("n")
    named = named.join(least, "group_id", "left").select("code", F.coalesce("component_id", "doc").alias("component_id"), "group_id")
    return rows.join(named, "code").select(F.col("doc").alias(key), "code", "component_id", "group_id", "text_hash")


def fingerprint_hex(code: Column) -> Column:
    """16 lowercase hex digits of a 64-bit code."""
    return F.lower(F.concat(*[F.substring(F.hex(code), 15 - 2 * i, 2) for i in range(8)]))
