"""Entity lexicon: normalised names, synonym groups, and which names a text can hold."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from entlens.config import MAX_LITERAL_NAMES, MAX_SCANNED_NAMES
from entlens.functions.bloom import KeyFilter
from entlens.functions.match import loose_parts, name_key, name_parts, normalise_name, text_keys
from entlens.functions.text import let

CANDIDATE = "array<struct<name:string,canonical:string>>"


def synonym_closure(groups: DataFrame) -> DataFrame:
    """(name, members): for every member, the union of the groups that list it. Input: (group_id, member)."""
    members = groups.select("group_id", normalise_name("member").alias("name")).distinct()
    other = members.select("group_id", F.col("name").alias("member"))
    return members.join(other, "group_id").groupBy("name").agg(F.sort_array(F.collect_set("member")).alias("members"))


def build_entries(names: DataFrame, groups: DataFrame) -> DataFrame:
    """One row per known name: its synonyms, canonical name (smallest synonym) and matching key.

    `names` has a column `name`; names without a group stand for themselves.
    """
    closure = synonym_closure(groups)
    known = names.select(normalise_name("name").alias("name")).union(closure.select("name")).distinct()
    members = F.coalesce(F.col("members"), F.array("name"))
    return known.join(closure, "name", "left").select(
        "name",
        members.alias("members"),
        F.array_min(members).alias("canonical"),
        name_key(F.col("name")).alias("key"),
        name_parts(F.col("name")).alias("n_parts"),
    )


@dataclass(frozen=True)
class Lexicon:
    """Known names as a table, and as a literal when they are few enough to live inside a plan."""

    entries: DataFrame
    rows: tuple[dict, ...] | None
    max_parts: int

    @classmethod
    def build(cls, names: DataFrame, groups: DataFrame, limit: int = MAX_LITERAL_NAMES) -> Lexicon:
        entries = build_entries(names, groups)
        few = entries.limit(limit + 1).collect()
        if len(few) > limit:
            return cls(entries, None, entries.agg(F.max("n_parts")).first()[0])
        return cls(entries, tuple(r.asDict() for r in few), max((r["n_parts"] for r in few), default=1))

    @classmethod
    def from_lists(cls, spark: SparkSession, names: list[str], groups: list[list[str]],
                   limit: int = MAX_LITERAL_NAMES) -> Lexicon:
        name_rows = spark.createDataFrame([(n,) for n in names], "name string")
        group_rows = spark.createDataFrame(
            [(i, m) for i, group in enumerate(groups) for m in group], "group_id int, member string")
        return cls.build(name_rows, group_rows, limit)

    @property
    def is_literal(self) -> bool:
        return self.rows is not None

    # Columns for a literal lexicon ------------------------------------------------------------------------------

    def candidates(self, text: Column) -> Column:
        """Names the text can hold, with their canonical names; exact verification is left to the name pattern."""
        if not self.is_literal:
            raise ValueError("this lexicon is too large for a literal; use with_candidates on a DataFrame")
        if len(self.rows) <= MAX_SCANNED_NAMES:
            return let(F.lower(text), self._scanned)
        by_key: dict[str, list[dict]] = {}
        loose: list[dict] = []
        for row in self.rows:
            item = {"name": row["name"], "canonical": row["canonical"]}
            (by_key.setdefault(row["key"], []) if row["key"] else loose).append(item)
        found = F.lit(None).cast(CANDIDATE)
        if by_key:
            lookup = F.from_json(F.lit(json.dumps(by_key)), f"map<string,{CANDIDATE}>")
            hits = F.filter(text_keys(text, self.max_parts), lambda k: k.isin(*by_key))
            found = F.flatten(F.transform(hits, lambda k: F.element_at(lookup, k)))
        found = F.coalesce(found, F.array().cast(CANDIDATE))
        if loose:
            listed = F.from_json(F.lit(json.dumps(loose)), CANDIDATE)
            low = F.lower(text)
            found = F.concat(found, F.filter(listed, lambda e: low.contains(first_part(e["name"]))))
        return F.sort_array(found)

    def _scanned(self, low: Column) -> Column:
        """A few names are searched for one by one: every run of letters and digits of a name stands in a text that holds it."""
        found = F.array().cast(CANDIDATE)
        if self.rows:
            found = F.array_compact(F.array(*[
                F.when(reduce(lambda a, b: a & b, [*[low.contains(run) for run in scanned_for(row["name"])], low.rlike(whole_runs(row["name"]))]),
                       F.struct(F.lit(row["name"]).alias("name"), F.lit(row["canonical"]).alias("canonical")))
                for row in self.rows]))
        return F.sort_array(found)

    def members_of(self, name: Column) -> Column:
        """Synonyms of a normalised name, itself when it has none."""
        grouped = {r["name"]: r["members"] for r in self.rows if r["members"] != [r["name"]]}
        if not grouped:
            return F.array(name)
        lookup = F.from_json(F.lit(json.dumps(grouped)), "map<string,array<string>>")
        return F.coalesce(F.when(name.isin(*grouped), F.element_at(lookup, name)), F.array(name))


def with_candidates(df: DataFrame, lexicon: Lexicon, id_col: str, text_col: str = "clean") -> DataFrame:
    """Add `candidates` to a document table.

    A literal lexicon is looked up inside the row. A larger one is joined: a filter of its keys, tested in the row, lets hardly a run
    of the text through that is no key, so about as many rows move as there are hits. Names without a letter or digit have no
    key; they are joined on their first part, which a text can hold at any place between letters, digits and separators.
    """
    if lexicon.is_literal:
        return df.withColumn("candidates", lexicon.candidates(F.col(text_col)))
    entry = F.struct("name", "canonical").alias("entry")
    keyed = lexicon.entries.where("key <> ''").select("key", entry)
    loose = lexicon.entries.where("key = ''").select(first_part(F.col("name")).alias("key"), entry)
    hits = df.select(id_col, F.explode(known_keys(F.col(text_col), lexicon)).alias("key")).join(keyed, "key").select(id_col, "entry")
    lengths = loose.agg(F.sort_array(F.collect_set(F.length("key")))).first()[0]  # no more than the longest name has characters
    if lengths:
        parts = F.filter(loose_parts(F.col(text_col), lengths), KeyFilter.of(loose.select("key").distinct(), "key").may_hold)
        more = df.select(id_col, F.explode(parts).alias("key")).join(loose, "key").select(id_col, "entry")
        hits = hits.unionByName(more)
    found = hits.groupBy(id_col).agg(F.sort_array(F.collect_set("entry")).alias("candidates"))
    return df.join(found, id_col, "left").withColumn("candidates", F.coalesce("candidates", F.array().cast(CANDIDATE)))


def scanned_for(name: str) -> list[str]:
    """What a lower-cased text must hold to hold the name, wherever separators stand: its runs of letters and digits, else its first part."""
    return re.findall("[a-z0-9]+", name) or [name.split(" ")[0]]


def whole_runs(name: str) -> str:
    """The runs of a name in order, none inside a longer run; asked only of texts that hold them all."""
    runs = re.findall("[a-z0-9]+", name)
    return "(?<![a-z0-9])" + "[^a-z0-9]*".join(runs) + "(?![a-z0-9])" if runs else ""


def first_part(name: Column) -> Column:
    return F.split(name, " ")[0]


def known_keys(text: Column, lexicon: Lexicon) -> Column:
    """The keys of a text that the lexicon may hold."""
    return F.filter(text_keys(text, lexicon.max_parts), KeyFilter.of(lexicon.entries.where("key <> ''"), "key").may_hold)


def canonical_of(name: Column, candidates: Column) -> Column:
    """Canonical name of a matched spelling: that of the known name it equals, otherwise itself."""
    known = F.filter(candidates, lambda e: e["name"] == name)
    return let(known, lambda k: F.coalesce(F.get(k, 0)["canonical"], name))
