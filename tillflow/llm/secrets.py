"""Secrets in texts, found through an inverted index of trigrams.

Each rule's regular expression yields a Boolean query of trigrams that every match must contain. The index
posts texts under the trigrams that occur in any query; the postings are intersected per rule, and only the
texts left over are searched with the rule. Rules without a mandatory trigram search every text.

Built-in functions only. Defined cases: a NULL text counts as empty and has no spans; repeated rows are kept
and get equal results; spans are ordered by start, then by rule as listed; an input column named
``secrets`` is replaced, all other columns are kept.
"""

from __future__ import annotations

import re
from re import _constants as op
from re import _parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import fresh, text_of, with_results
from tillflow.llm.spans import with_spans


class Rule(NamedTuple):
    name: str
    pattern: str
    at_least: int = 0  # code points of ``group``
    group: int = 0


# The first three are the base rules. Possessive repeats match what the plain ones do, in linear time.
RULES = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?+\x20*+[:=]\x20*+["']?+"""
                   r"([A-Za-z0-9+/_.=-]++)", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]++", 20),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}+", 24),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}+"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}+"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
]
BASE = [r.name for r in RULES[:3]]

# A character class or a product of alternatives larger than this is treated as "anything".
MOST_STRINGS = 24


def _product(left: set[str], right: set[str] | None) -> set[str] | None:
    out = {a + b for a in left for b in right} if right is not None else None
    return out if out is not None and len(out) <= MOST_STRINGS else None


def _sequence(nodes) -> set[str] | None:
    out: set[str] | None = {""}
    for node in nodes:
        out = _product(out, _strings(node)) if out is not None else None
    return out


def _strings(node) -> set[str] | None:
    """All strings a part of a pattern can match, in lower case; None if they are many or unbounded."""
    kind, value = node
    if kind is op.LITERAL:
        return {chr(value).lower()}
    if kind is op.IN and all(k is op.LITERAL for k, _ in value) and len(value) <= MOST_STRINGS:
        return {chr(v).lower() for _, v in value}
    if kind is op.BRANCH:
        parts = [_sequence(b) for b in value[1]]
        return None if None in parts else set().union(*parts)
    if kind is op.SUBPATTERN:
        return _sequence(value[-1])
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT) and value[1] <= 4:
        once, out = _sequence(value[2]), set()
        for n in range(value[0], value[1] + 1):
            out |= _sequence(list(value[2]) * n) or set()
        return None if once is None else out
    if kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
        return {""}
    return None


def _all_of(left: list[frozenset], right: list[frozenset]) -> list[frozenset]:
    both = list(dict.fromkeys(a | b for a in left for b in right))
    return [a for a in both if not any(b < a for b in both)]  # a set that needs more than another adds nothing


def _grams(run: set[str]) -> list[frozenset]:
    parts = [frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in sorted(run)]
    return parts if all(parts) else [frozenset()]


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives, each a set of lower-case trigrams; a match has all of at least one set.

    An empty set among them means that nothing is mandatory.
    """

    def query(nodes) -> list[frozenset]:
        out, run = [frozenset()], {""}
        for node in nodes:
            longer = _product(run, _strings(node))
            if longer is not None:
                run = longer
                continue
            out, run = _all_of(out, _grams(run)), {""}
            kind, value = node
            if kind is op.SUBPATTERN:
                out = _all_of(out, query(value[-1]))
            elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT) and value[0] > 0:
                out = _all_of(out, query(value[2]))
        return _all_of(out, _grams(run))

    return query(_parser.parse(pattern, re.ASCII))


def postings(texts: DataFrame, key: str, text: str, grams: list[str]) -> DataFrame:
    """The inverted index, restricted to the trigrams that some rule asks for: (trigram, key)."""
    listed = F.array(*[F.lit(g) for g in grams])
    # The lower-cased text is the one element of an outer array: bound there, it is not made anew for every trigram.
    held = texts.select(key, F.flatten(F.transform(F.array(F.lower(text)), lambda low: F.filter(
        listed, lambda g: F.contains(low, g)))).alias("grams"))
    return held.select(F.explode("grams").alias("trigram"), key)


def candidates(index: DataFrame, key: str, rules: list[Rule]) -> DataFrame:
    """(key, rules): the rules whose trigram query a text's postings satisfy, one row per text."""
    asked = [(r.name, i, g, len(alternative)) for r in rules
             for i, alternative in enumerate(trigram_query(r.pattern)) for g in sorted(alternative)]
    queries = index.sparkSession.createDataFrame(asked, "rule string, alternative int, trigram string, needed int")
    # As many rows as the rules' trigrams, whatever the texts are.
    hits = index.join(F.broadcast(queries), "trigram").groupBy(key, "rule", "alternative").agg(
        F.count_distinct("trigram").alias("held"), F.max("needed").alias("needed"))
    return hits.where("held = needed").groupBy(key).agg(F.collect_set("rule").alias("rules"))


def find_secrets(df: DataFrame, text: str = "text", result: str = "secrets", rules: list[Rule] = RULES) -> DataFrame:
    """``df`` with ``result``: array<struct<start, rank, end, kind, value>>, ordered by start and rule."""
    row, whole, key, spans = fresh(df, "row", "whole", "key", "spans")
    columns = [F.col(f"`{c}`") for c in df.columns]
    # Rows of equal content share a key, which is harmless: they have the same candidates.
    hashed = [c for c, (_, kind) in zip(columns, df.dtypes, strict=True) if "map" not in kind]
    plain = df.select(F.struct(*columns).alias(row), text_of(text).alias(whole), F.xxhash64(*hashed).alias(key))
    indexed = [r for r in rules if all(trigram_query(r.pattern))]
    if indexed:
        grams = sorted({g for r in indexed for a in trigram_query(r.pattern) for g in a})
        plain = plain.join(candidates(postings(plain, key, whole, grams), key, indexed), key, "left")
    found = with_spans(plain, whole, {r.name: r.pattern for r in rules}, only_if={
        r.name: F.array_contains("rules", r.name) for r in indexed})

    def listed(rank: int, rule: Rule) -> Column:
        kept = F.filter(F.col(f"spans_{rule.name}"), lambda s: F.length(
            F.regexp_extract(s["value"], rule.pattern, rule.group)) >= rule.at_least)
        return F.transform(kept, lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"),
            F.lit(rule.name).alias("kind"), s["value"].alias("value")))

    out = found.select(f"{row}.*", F.array_sort(F.concat(*[listed(i, r) for i, r in enumerate(rules)])).alias(spans))
    return with_results(out, **{result: F.col(spans)}).drop(spans)


def redact(df: DataFrame, text: str = "text", found: str = "secrets", mark: str = "[secret]") -> DataFrame:
    """``df`` with every span of ``found`` replaced by ``mark`` in ``text``; spans that overlap become one mark.

    A NULL text stays NULL.
    """
    whole = F.col(f"`{text}`")
    zero = F.struct(F.lit(0).alias("upto"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        piece = F.when(span["start"] < state["upto"], "").when(
            (span["start"] == state["upto"]) & (state["upto"] > 0), "").otherwise(F.concat(
                F.substring(whole, state["upto"] + 1, span["start"] - state["upto"]), F.lit(mark)))
        return F.struct(F.greatest(state["upto"], span["end"]).alias("upto"), F.concat(state["out"], piece).alias("out"))

    cleaned = F.aggregate(F.col(found), zero, step, lambda s: F.concat(
        s["out"], F.substring(whole, s["upto"] + 1, F.greatest(F.char_length(whole) - s["upto"], F.lit(0)))))
    return df.withColumn(text, F.when(F.size(found) > 0, cleaned).otherwise(whole))
