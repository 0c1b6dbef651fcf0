"""Toxicity by a weighted finite-state pattern grammar over clauses.

Five small transducers read the word classes of a clause: insult, threat, target, negation and reported speech. Each has a
few states and multiplies the weight of an insult by a factor that depends on what it has read. A threat with a target in its
clause has a weight of its own, under the same negation and report. Their composition runs once over a clause; the weights of a text's matched clauses add up to the log-odds of its score. Insults and their weights are
learned from labels; the words of the other classes are given.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from itertools import product

from pyspark.sql import DataFrame, functions as F, types as T

from entlens.session import materialise

# Words of the given classes in the languages of the corpus.
CLASSES = {
    "threat": "kill hurt destroy smash beat die burn töte schlage zerstöre sterben tuer frapper mourir détruire matar golpear morir destruir",
    "target": "you your you're u he she they him her them du dich dir ihr euch sie tu te toi vous ton votre tú usted ustedes vosotros ellos",
    "negation": "not never no nobody isn't aren't wasn't don't nicht kein keine nie niemals pas jamais aucun ne nunca jamás ningún",
    "report": "said says told wrote quoted reported claims sagte sagt schrieb zitierte dit disait écrit cité dijo dice escribió citó",
}
#: Labelled rows learned from at most; beyond it a hash of the row decides.
MOST_ROWS = 40_000
#: Terms kept at most, the least log-odds of a term, and the least number of documents with label 1 that hold it.
MOST_TERMS, LEAST_WEIGHT, LEAST_COUNT = 5_000, 0.35, 3
#: Letters of a whole word at least, and of the beginnings.
SHORTEST, PREFIXES = 2, (4, 5, 6, 7, 8)
PRIOR = -2.2

# A machine: {(state, class): (next state, factor)}. A word of another class leaves state and weight as they are.
MACHINES = {
    "insult": {("start", "insult"): ("seen", 1.0), ("seen", "insult"): ("seen", 1.0)},
    "threat": {("start", "threat"): ("seen", 1.0), ("seen", "insult"): ("seen", 1.25)},
    "target": {("start", "target"): ("seen", 1.0), ("seen", "insult"): ("seen", 1.25)},
    "negation": {("start", "negation"): ("seen", 1.0), ("seen", "negation"): ("start", 1.0), ("seen", "insult"): ("start", 0.75)},
    "report": {("start", "report"): ("seen", 1.0), ("seen", "insult"): ("seen", 0.75)},
}
SYMBOLS = ("insult", "threat", "target", "negation", "report")


def compose(machines: dict) -> dict[tuple[tuple[str, ...], str], tuple[tuple[str, ...], float]]:
    """One machine whose state is the tuple of the states, and whose factor is the product of the factors."""
    states = [sorted({"start", *(s for s, _ in m), *(s for s, _ in m.values())}) for m in machines.values()]
    out = {}
    for state, symbol in product(product(*states), SYMBOLS):
        steps = [m.get((s, symbol), (s, 1.0)) for s, m in zip(state, machines.values(), strict=True)]
        out[state, symbol] = (tuple(s for s, _ in steps), math.prod(f for _, f in steps))
    return out


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


class Grammar:
    """The composed machine with its lexicon: terms are whole words ("=word"), beginnings ("word") or threats beside a target ("+word")."""

    def __init__(self, terms: dict[str, float]):
        import re

        import ahocorasick

        self.terms = terms
        self.classes = {w: name for name, words in CLASSES.items() for w in words.split()}
        self.machine = compose(MACHINES)
        self.start = ("start",) * len(MACHINES)
        self.negation, self.report = list(MACHINES).index("negation"), list(MACHINES).index("report")
        self.clause = re.compile(r"[^.,;:!?\n]+").finditer
        self.word = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*").finditer
        self.automaton = ahocorasick.Automaton()
        for term in terms:
            self.automaton.add_word(term.lstrip("=+"), True)
        if terms:
            self.automaton.make_automaton()

    def weight(self, word: str) -> float:
        """The largest weight of the terms that fit the word; 0 if none does."""
        fits = [self.terms.get("=" + word, 0.0), *(self.terms.get(word[:n], 0.0) for n in PREFIXES if len(word) >= n)]
        return max(fits)

    def clauses(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the matched clauses, in characters."""
        lower = text.lower()
        if len(lower) != len(text):  # a character that grows when lower-cased would shift the places
            lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        if not self.terms or next(self.automaton.iter(lower), None) is None:
            return []
        found = []
        for clause in self.clause(lower):
            state, total, threat, target = self.start, 0.0, 0.0, False
            for m in self.word(lower, *clause.span()):
                word = m.group()
                own = self.weight(word)
                symbol = "insult" if own else self.classes.get(word)
                if symbol:
                    state, factor = self.machine[state, symbol]
                    total += own * factor
                    if symbol in ("threat", "target"):
                        threat, target = max(threat, self.terms.get("+" + word, 0.0)), target or symbol == "target"
            if target:
                total += threat * 0.75 ** (state[self.negation] == "seen") * 0.75 ** (state[self.report] == "seen")
            if total:
                found.append((*clause.span(), total))
        return found

    def score(self, clauses: list[tuple[int, int, float]]) -> float:
        return sigmoid(PRIOR + sum(w for _, _, w in clauses))


def held_out(key) -> F.Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learn_terms(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
                most_rows: int = MOST_ROWS) -> dict[str, float]:
    """Words and word beginnings that tell label 1 from label 0, with the log-odds of a cautious share.

    Rows held out are left out, and so are rows without a key, text or label; of several labels of a key the largest counts. At
    most about `most_rows` labelled rows are used, picked by a hash of the key. Copies of a text count once. The share is the
    lower end of the Wilson interval, so a term seen in a few documents weighs little. No labels give no terms.
    """
    own = labels.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{label}`").cast("int").alias("_label"))
    own = own.where(F.col("_key").isNotNull() & F.col("_label").isNotNull() & ~held_out(F.col("_key")))
    rows = own.count()
    if rows > most_rows:
        own = own.where(F.conv(F.substring(F.md5(F.col("_key").cast("string")), 1, 8), 16, 10).cast("long") < (most_rows << 32) // rows)
    own = own.groupBy("_key").agg(F.max("_label").alias("_label"))
    texts = docs.select(F.col(f"`{key}`").alias("_key"), F.lower(F.col(f"`{text}`")).alias("_text")).where(F.length("_text") > 0)
    # The labelled rows are bounded by `most_rows`.
    texts = texts.join(F.broadcast(own), "_key").withColumn("_hash", F.xxhash64("_text")).dropDuplicates(["_hash"])
    words = F.array_distinct(F.filter(F.split(F.col("_text"), r"[^\p{L}']+"), lambda w: F.length(w) >= SHORTEST))

    def beginnings(n: int):
        return F.transform(F.filter(words, lambda w: F.length(w) >= n), lambda w: F.substring(w, 1, n))

    threats, targets = (F.array(*map(F.lit, CLASSES[name].split())) for name in ("threat", "target"))

    def aimed(clause):
        own = F.split(clause, r"[^\p{L}']+")
        return F.when(F.arrays_overlap(own, targets), F.transform(F.array_intersect(own, threats), lambda w: F.concat(F.lit("+"), w))).otherwise(F.array().cast("array<string>"))

    pairs = F.flatten(F.transform(F.split(F.col("_text"), r"[.,;:!?\n]+"), aimed))
    terms = F.array_distinct(F.concat(F.transform(words, lambda w: F.concat(F.lit("="), w)), *map(beginnings, PREFIXES), pairs))
    counts = texts.select("_label", F.explode(terms).alias("term")).groupBy("term").agg(
        F.sum("_label").cast("double").alias("t"), F.count("*").cast("double").alias("n"))
    z = 1.64
    share = F.col("t") / F.col("n")
    low = (share + z * z / (2 * F.col("n")) - z * F.sqrt(share * (1 - share) / F.col("n") + z * z / (4 * F.col("n") * F.col("n")))) / (1 + z * z / F.col("n"))
    good = counts.where(F.col("t") >= LEAST_COUNT).withColumn("weight", F.log(F.greatest(low, F.lit(1e-9)) / (1 - F.least(low, F.lit(1 - 1e-9)))))
    good = materialise(good.where(F.col("weight") >= LEAST_WEIGHT).select("term", "weight"), "toxic-terms")
    return {r.term: round(r.weight, 6) for r in good.orderBy(F.desc("weight"), "term").limit(MOST_TERMS).collect()}


def _score_batches(batches: Iterator, terms: dict[str, float]):
    import pyarrow as pa

    grammar = Grammar(terms)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("weight", pa.float64())]))
    for batch in batches:
        found = [grammar.clauses(t.as_py() or "") for t in batch.column(batch.num_columns - 1)]
        clauses = pa.array([[{"start": a, "end": b, "weight": w} for a, b, w in cs] for cs in found], kind)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([grammar.score(cs) for cs in found], pa.float64()), clauses],
                                         names=[*batch.schema.names[:-1], "score", "clauses"])


def score_toxicity(docs: DataFrame, terms: dict[str, float], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (default: all but the text), score (double, 0 to 1) and clauses (array of start, end, weight).

    Only the text enters the score. A null or empty text, and any text without a matched clause, has the score of the prior.
    Each row is scored on its own, whole: repeated rows get equal scores, and an empty table stays empty. Input columns named
    score or clauses are replaced.
    """
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in {text, "score", "clauses"}]
    rows = docs.select(*[f"`{c}`" for c in keep], F.col(f"`{text}`").alias("_text"))
    clause = T.StructType().add("start", T.LongType()).add("end", T.LongType()).add("weight", T.DoubleType())
    schema = rows.drop("_text").schema.add("score", T.DoubleType()).add("clauses", T.ArrayType(clause))
    return rows.mapInArrow(partial(_score_batches, terms=terms), schema)
