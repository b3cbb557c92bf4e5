"""Personal data, in DataFrame expressions only: regular expressions propose
spans, validators (Luhn, mod-97, ranges) confirm them, context words nearby
move the score.

Positions come from two views of one pattern: the matches, and the text
between them; their lengths add up to where each match begins.  Patterns use
possessive repeats and start only where a run of their characters starts, so
a very long run costs linear time and no recursion.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Kind:
    """``hint``: a cheap test without which no match is possible; ``always``:
    a confirmed span is reported whatever its score."""

    name: str
    pattern: str
    hint: str
    score: float
    context: str
    always: bool


_BYTE = r"(?=[0-9])0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]?)"  # zeros alone are a part, too

KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "@", 0.9, r"e-?mail|contact|write|reply", True),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]", 0.6, r"\bip\b|address|host|server|login", True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9]", 0.8, r"card|visa|master|amex|credit|payment", True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.6, r"phone|call|tel|mobile|fax", True),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         r"[A-Z]{2}[0-9]{2}", 0.9, r"iban|bank|account|konto|compte|cuenta", False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]-[0-9]", 0.4, r"ssn|social|security", False),
    Kind("short_card", r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++", r"[0-9]", 0.4, r"card|visa|amex|diners|credit", False),
)
BASE_KINDS = tuple(k.name for k in KINDS if k.always)
_PAGE = 1024  # code points
_NEAR = 40  # code points of context on either side
_BONUS = 0.3
_THRESHOLD = 0.6


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _mod97(value: Column) -> Column:
    """Remainder of an IBAN: country and check digits go last, letters count
    from 10 on."""
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    letters = F.filter(F.split(turned, ""), lambda c: c != "")
    return F.aggregate(letters, F.lit(0), lambda acc, c: F.when(c.rlike("[A-Z]"), (acc * 100 + F.ascii(c) - 55) % 97)
                       .otherwise((acc * 10 + F.ascii(c) - 48) % 97))


def _valid(kind: str, value: Column) -> Column:
    digits = _digits(value)
    n = F.length(digits)
    return {
        "email": lambda: F.lit(True),
        "ip": lambda: value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"),
        "card": lambda: n.between(16, 19) & F.call_function("luhn_check", digits),
        "phone": lambda: n.between(8, 15),
        "iban": lambda: F.length(F.regexp_replace(value, " ", "")).between(15, 34) & (_mod97(value) == 1),
        "ssn": lambda: ~value.rlike("^(000|666|9)") & ~value.rlike("-00-|-0000$"),
        "short_card": lambda: n.between(13, 15) & F.call_function("luhn_check", digits),
    }[kind]()


_SPAN = "array<struct<start:bigint,end:bigint,value:string>>"
_SLICE = 256  # matches whose spans are added up one after the other


def _spans(pairs: Column, at: Column) -> Column:
    """Spans of (match, gap before it) pairs that begin at a place."""
    start = F.struct(at.alias("at"), F.array().cast(_SPAN).alias("found"))

    def step(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["match"])
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(F.struct(
            begin.alias("start"), end.alias("end"), pair["match"].alias("value")))).alias("found"))

    return F.aggregate(pairs, start, step, lambda acc: acc["found"])


def _located(matches: Column, gaps: Column) -> Column:
    """[(start, end, value)] in code points from matches and the text around.
    Very many matches are cut into slices: the lengths of whole slices are
    added up first, so the time is linear in the matches."""
    pairs = F.zip_with(matches, F.slice(gaps, 1, F.size(matches)), lambda m, g: F.struct(m.alias("match"), g.alias("gap")))
    many = F.transform(F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / _SLICE).cast("int")),
                       lambda i: F.struct(F.slice(matches, i * _SLICE + 1, F.lit(_SLICE)).alias("m"), F.slice(gaps, i * _SLICE + 1, F.lit(_SLICE)).alias("g")))
    size = lambda texts: F.aggregate(texts, F.lit(0).cast("long"), lambda acc, t: acc + F.length(t))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("found"))
    begins = F.aggregate(many, start, lambda acc, s: F.struct(
        (acc["at"] + size(s["m"]) + size(s["g"])).alias("at"), F.concat(acc["found"], F.array(acc["at"])).alias("found")), lambda acc: acc["found"])
    sliced = F.flatten(F.zip_with(many, begins, lambda s, at: _spans(
        F.zip_with(s["m"], F.slice(s["g"], 1, F.size(s["m"])), lambda m, g: F.struct(m.alias("match"), g.alias("gap"))), at)))
    return F.when(F.size(matches) > _SLICE, sliced).when(F.size(matches) > 0, _spans(pairs, F.lit(0).cast("long"))).otherwise(
        F.array().cast(_SPAN))


def find_pii(docs: DataFrame, text_col: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Every input row with ``pii``: an array of (kind, start, end, score), by
    kind in the given order, then start; code points, end exclusive.

    Matches are leftmost and non-overlapping within a kind; those that fail
    the validator are dropped without a retry.  A context word within 40 code
    points adds 0.3 to the score (1.0 at most).  Kinds marked ``always`` are
    reported whatever the score, the others from 0.6 on.  A null or empty text
    has no spans; repeated rows and null ids are rows like any other; an input
    column ``pii`` is replaced."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    matches = [F.when(F.col("body").rlike(k.hint), F.regexp_extract_all("body", F.lit(k.pattern), F.lit(0)))
               .otherwise(F.array().cast("array<string>")).alias(f"m_{k.name}") for k in kinds]
    rows = rows.select("row", "body", *matches)
    gaps = [F.when(F.size(f"m_{k.name}") > 0, F.split("body", k.pattern, -1)).alias(f"g_{k.name}") for k in kinds]
    rows = rows.select("row", "body", *[f"m_{k.name}" for k in kinds], *gaps)
    rows = rows.select("row", "body", *[_located(F.col(f"m_{k.name}"), F.col(f"g_{k.name}")).alias(k.name) for k in kinds])

    # finding a place in a text takes time in proportion to it: long ones are cut once
    rows = rows.withColumn("pages", F.when(F.length("body") > 4 * _PAGE, F.regexp_extract_all("body", F.lit(f"(?s).{{1,{_PAGE}}}"), F.lit(0))))

    def part(at: Column, size: Column) -> Column:
        page = F.floor(at / _PAGE).cast("int")
        two = F.concat(F.coalesce(F.get("pages", page), F.lit("")), F.coalesce(F.get("pages", page + 1), F.lit("")))
        return F.when(F.col("pages").isNotNull(), F.substring(two, (at - page * _PAGE + 1).cast("int"), size.cast("int"))).otherwise(
            F.substring("body", (at + 1).cast("int"), size.cast("int")))

    def scored(kind: Kind) -> Column:
        def one(span: Column) -> Column:
            first = F.greatest(span["start"] - _NEAR, F.lit(0))
            near = F.concat_ws(" ", part(first, span["start"] - first), part(span["end"], F.lit(_NEAR)))
            score = F.least(F.lit(1.0), F.lit(kind.score) + F.when(F.lower(near).rlike(kind.context), F.lit(_BONUS)).otherwise(0.0))
            return F.struct(F.lit(kind.name).alias("kind"), span["start"].alias("start"), span["end"].alias("end"), score.alias("score"))

        confirmed = F.transform(F.filter(kind.name, lambda s: _valid(kind.name, s["value"])), one)
        return confirmed if kind.always else F.filter(confirmed, lambda s: s["score"] >= _THRESHOLD)

    rest = [F.col(f"row.`{c}`") for c in docs.columns if c != "pii"]
    found = rows.select("row", F.concat(*[scored(k) for k in kinds]).alias("pii"))
    return found.select(*rest, "pii")
