"""Quality rules as a bitmask ledger.

Each rule is evaluated once per document. The ledger keeps the measurements and one bit per failed rule; a policy is a mask of
the rules it enforces, so another version of the policy, or the effect of leaving one rule out, is a bitwise test over the ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from entlens.llm.common import SPACE_CHARS, SPACE_CLASS, let

SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    name: str
    failed: Column


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]


BASE_RULES = ("few_words", "repeated_words")
POLICIES = {
    "base": Policy("base", BASE_RULES),
    "v1": Policy("v1", (*BASE_RULES, "symbol_share", "duplicate_lines", "short_words", "long_words")),
}


def rules() -> list[Rule]:
    """The rules over the measured columns; the place in the list is the bit. Integer arithmetic only, no division."""
    c = F.col
    return [
        Rule("few_words", c("n_words") < 50),
        Rule("repeated_words", 100 * c("n_repeat_words") > 50 * c("n_words")),
        Rule("symbol_share", 100 * c("n_symbols") > 10 * c("word_chars")),
        Rule("duplicate_lines", 100 * c("n_dup_lines") > 60 * c("n_lines")),
        Rule("short_words", (c("n_words") > 0) & (c("word_chars") < 2 * c("n_words"))),
        Rule("long_words", c("word_chars") > 15 * c("n_words")),
    ]


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more, by one sort of long numbers per text.

    A window is a 64-bit number: its hash above, its place below, with just as many bits as the places of this text need.
    Sorted, equal hashes are neighbours; the places found are sorted again and their windows laid over each other.
    """

    def packed(w: Column, bits: Column) -> Column:
        """Each window's hash and place in one number."""
        return F.transform(F.slice(w, 1, F.size(w) - 2), lambda x, i: F.call_function(
            "shiftleft", F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)), bits).bitwiseOR(i.cast("long")))

    def repeated(s: Column, bits: Column) -> Column:
        twins = F.filter(F.sequence(F.lit(0), F.size(s) - 2), lambda i: F.call_function(
            "shiftrightunsigned", F.get(s, i).bitwiseXOR(F.get(s, i + 1)), bits) == 0)
        low = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
        places = F.flatten(F.transform(twins, lambda i: F.array(F.get(s, i).bitwiseAND(low), F.get(s, i + 1).bitwiseAND(low))))
        return let(F.sort_array(F.array_distinct(places)), covered)

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda x, i: F.least(F.coalesce(F.get(at, i + 1) - x, F.lit(3)), F.lit(3)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    def counted(w: Column) -> Column:
        return let(F.length(F.bin(F.size(w))), lambda bits: let(F.sort_array(packed(w, bits)), lambda s: repeated(s, bits)))

    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(counted(words))


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (long) and failed (long, a bit per failed rule).

    A null text counts as an empty one: all measures 0, and the rule on few words fails. Columns of the input with one of these
    names are replaced. Every row is measured on its own, so repeated rows and ties need no rule; an empty table stays empty.
    """
    spaces = F.lit(SPACE_CHARS)

    def measure(t: Column) -> Column:
        def of_words(w: Column) -> Column:
            return F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                            _repeat_words(w).alias("n_repeat_words"))

        bare = F.btrim(t, spaces)
        words = F.when(F.length(bare) == 0, F.array().cast("array<string>")).otherwise(F.split(bare, f"{SPACE_CLASS}+"))
        lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, spaces)) > 0)
        return let(words, of_words).alias("words"), let(lines, lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("lines")

    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words, lines = measure(whole)
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
    kept = [f"`{c}`" for c in docs.columns if c not in {*measures, "failed"}]
    # One struct, built behind a lambda, so that no later use of a measure can copy the expression that makes it.
    measured = let(F.struct(words, lines, F.regexp_count(whole, F.lit(SYMBOLS)).cast("long").alias("n_symbols")), lambda m: F.struct(
        m["words"]["n_words"].alias("n_words"), m["words"]["word_chars"].alias("word_chars"), m["n_symbols"].alias("n_symbols"),
        m["lines"]["n_dup_lines"].alias("n_dup_lines"), m["words"]["n_repeat_words"].alias("n_repeat_words"), m["lines"]["n_lines"].alias("n_lines")))
    out = docs.select(*kept, measured.alias("_measures")).select(*kept, "_measures.*")
    bits = F.lit(0).cast("long")
    for bit, rule in enumerate(rules()):
        bits = bits + F.when(rule.failed, F.lit(1 << bit)).otherwise(F.lit(0)).cast("long")
    return out.withColumn("failed", bits)


def mask(policy: Policy) -> int:
    bits = {rule.name: 1 << bit for bit, rule in enumerate(rules())}
    return sum(bits[name] for name in policy.rules)


def passes(policy: Policy) -> Column:
    """True where a row of the ledger breaks no rule of the policy."""
    return F.col("failed").bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablation(rows: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: n_failed, n_alone (failed no other rule of it) and n_kept_without (kept if the rule were left out).

    One aggregation with a partial sum per task; an empty ledger gives zeros.
    """
    own = F.col("failed").bitwiseAND(F.lit(mask(policy)).cast("long"))
    bits = {rule.name: 1 << bit for bit, rule in enumerate(rules())}

    def count(test: Column) -> Column:
        return F.coalesce(F.sum(test.cast("long")), F.lit(0))

    sums = rows.agg(count(own == 0).alias("kept"), *[x for name in policy.rules for x in (
        count(own.bitwiseAND(F.lit(bits[name]).cast("long")) != 0).alias(f"failed_{name}"), count(own == bits[name]).alias(f"alone_{name}"))])
    lines = F.array(*[F.struct(F.lit(policy.version).alias("version"), F.lit(name).alias("rule"), F.col(f"failed_{name}").alias("n_failed"),
                               F.col(f"alone_{name}").alias("n_alone"), (F.col("kept") + F.col(f"alone_{name}")).alias("n_kept_without"))
                      for name in policy.rules])
    return sums.select(F.explode(lines).alias("line")).select("line.*")


def apply_policy(docs: DataFrame, policy: Policy = POLICIES["v1"], text: str = "text") -> DataFrame:
    """The ledger with base_failed and kept (both boolean): the verdict of the policy, false wherever a base rule failed."""
    return ledger(docs, text).withColumn("base_failed", ~passes(POLICIES["base"])).withColumn("kept", passes(POLICIES["base"]) & passes(policy))
