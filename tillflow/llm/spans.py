"""Where the matches of patterns lie in a text, with built-in functions only.

Spark returns matched strings without positions. The pieces between the matches (``split``) and the
matches themselves (``regexp_extract_all``) come from the same leftmost scan, so running sums of their
lengths are the positions, in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Code points of context kept on either side of a match.
CONTEXT = 40

SPAN = "struct<start:int,end:int,value:string,before:string,after:string>"


def _starts(hits: Column, gaps: Column) -> Column:
    pairs = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits,
                       lambda gap, hit: F.struct(F.length(gap).alias("gap"), F.length(hit).alias("hit")))
    return F.aggregate(
        pairs, F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<int>)").alias("starts")),
        lambda state, p: F.struct(
            (state["at"] + p["gap"] + p["hit"]).alias("at"),
            F.concat(state["starts"], F.array(state["at"] + p["gap"])).alias("starts")),
        lambda state: state["starts"])


def _spans(hits: Column, gaps: Column, starts: Column) -> Column:
    return F.transform(hits, lambda hit, i: F.struct(
        F.get(starts, i).alias("start"), (F.get(starts, i) + F.length(hit)).alias("end"), hit.alias("value"),
        F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("before"),
        F.left(F.get(gaps, i + 1), F.lit(CONTEXT)).alias("after")))


def with_spans(df: DataFrame, text: str, patterns: dict[str, str], only_if: dict[str, Column] | None = None
               ) -> DataFrame:
    """A column ``spans_<kind>`` of array<SPAN> for each pattern; empty where nothing matches.

    ``only_if`` names a cheap condition without which a text cannot match the kind. Each step is a
    projection of its own, so no match is searched twice; positions are computed only where there are hits.
    """
    t, nothing = F.col(text), F.expr("CAST(array() AS array<string>)")
    gate = only_if or {}
    found = {k: F.regexp_extract_all(t, F.lit(p), F.lit(0)) for k, p in patterns.items()}
    df = df.withColumns({f"hits_{k}": F.when(gate[k], v).otherwise(nothing) if k in gate else v
                         for k, v in found.items()})
    some = {k: F.size(f"hits_{k}") > 0 for k in patterns}
    df = df.withColumns({f"gaps_{k}": F.when(some[k], F.split(t, p, -1)) for k, p in patterns.items()})
    df = df.withColumns({f"starts_{k}": F.when(some[k], _starts(F.col(f"hits_{k}"), F.col(f"gaps_{k}")))
                         for k in patterns})
    df = df.withColumns({f"spans_{k}": F.when(
        some[k], _spans(F.col(f"hits_{k}"), F.col(f"gaps_{k}"), F.col(f"starts_{k}"))).otherwise(
        F.expr(f"CAST(array() AS array<{SPAN}>)")) for k in patterns})
    return df.drop(*[f"{p}_{k}" for k in patterns for p in ("hits", "gaps", "starts")])


def joined(spans: Column) -> Column:
    """``kind:start:end`` comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def only(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def counted(spans: Column, kind: str) -> Column:
    return F.size(only(spans, kind)).cast("long")
