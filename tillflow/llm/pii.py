"""Personal data in texts: patterns propose spans, checksums confirm them, nearby words adjust the score.

Built-in functions only. Defined cases: a NULL text counts as empty; an empty text has no spans; rows are
treated one by one, so repeated rows and ties give equal results; spans are ordered by start, then by kind
as listed in ``KINDS``; an input column named ``pii`` is replaced, all other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import fresh, text_of, with_results
from tillflow.llm.spans import with_spans

# In the order in which spans at one start are listed; the first four are the base kinds.
KINDS = ["email", "ip", "card", "phone", "iban"]
BASE = KINDS[:4]

# Possessive forms of the plain patterns. The lookbehinds only skip starts in the middle of a run, where a
# match would have begun earlier; ``\G`` is the end of the match before. So scans stay linear.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
}

# A confirmed span starts with ``base``; words within reach add or take ``STEP``.
STEP = 0.15
SCORES = {
    "email": (0.8, "mail|contact|write|reply", "example|noreply|test"),
    "ip": (0.6, "host|server|client|address|login", "version|release|build"),
    "card": (0.7, "card|visa|master|credit|payment|expir", "order|serial|tracking"),
    "phone": (0.6, "phone|call|tel|mobile|fax", "ratio|score"),
    "iban": (0.8, "iban|bank|account|transfer", "sample"),
}


def luhn(digits: Column) -> Column:
    """True if a string of digits passes the Luhn check."""
    positions = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))
    from_right = F.reverse(digits)

    def share(i: Column) -> Column:
        d = F.coalesce(F.try_to_number(F.substring(from_right, i, F.lit(1)), F.lit("9")).cast("int"), F.lit(0))
        return F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(positions, F.lit(0), lambda total, i: total + share(i)) % 10 == 0


def mod97(value: Column) -> Column:
    """True if an account number passes ISO 7064 mod 97: the first four characters last, letters as 10 to 35."""
    plain = F.regexp_replace(value, "[^A-Z0-9]", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def step(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code < 65, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(turned), F.lit(1))), F.lit(0), step) == 1


def confirmed(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "iban":
        return mod97(value)
    return F.lit(True)


def _score(kind: str, span: Column) -> Column:
    base, towards, against = SCORES[kind]
    near = F.lower(F.concat_ws(" ", span["before"], span["after"]))
    return F.round(F.lit(base) + F.when(near.rlike(towards), STEP).otherwise(0.0)
                   - F.when(near.rlike(against), STEP).otherwise(0.0), 2)


def find_pii(df: DataFrame, text: str = "text", result: str = "pii") -> DataFrame:
    """``df`` with ``result``: array<struct<start, rank, end, kind, value, score>>, ordered by start and kind."""
    row, whole, spans = fresh(df, "row", "whole", "spans")
    plain = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(row), text_of(text).alias(whole))
    found = with_spans(plain, whole, PATTERNS, only_if={
        "email": F.contains(F.col(whole), F.lit("@")), "phone": F.contains(F.col(whole), F.lit("+"))})

    def listed(kind: str) -> Column:
        return F.transform(
            F.filter(F.col(f"spans_{kind}"), lambda s: confirmed(kind, s["value"])),
            lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
                               s["end"].alias("end"), F.lit(kind).alias("kind"), s["value"].alias("value"),
                               _score(kind, s).alias("score")))

    out = found.select(f"{row}.*", F.array_sort(F.concat(*[listed(k) for k in KINDS])).alias(spans))
    return with_results(out, **{result: F.col(spans)}).drop(spans)
