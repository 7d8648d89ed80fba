"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Everything is a column expression, so documents are read once and nothing is shuffled.

NULL and empty texts have no spans.  Repeated rows each get their own result.  Offsets are code
points, ends exclusive.  Patterns are possessive and start only where a run of their characters
starts, so very long texts take linear time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaflow.llm.common import text_or_empty

BLOCK = 256  # spans joined to the result at a time, so that long lists are not copied once per span
CUT = 512  # code points of a piece of text; context is looked up in pieces, not from the start of the text
NEAR = 40  # code points on either side in which context words count
ACCEPT = 0.6  # score from which an added span is reported

# Words that make a kind likelier nearby; fixed values.
CONTEXT = {
    "email": "mail|e-mail|contact|kontakt|correo|courriel",
    "ip": "ip|address|host|server|adresse",
    "card": "card|visa|mastercard|karte|carte|tarjeta|credit",
    "phone": "tel|phone|call|mobile|fax|anruf",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": "ssn|social security|tax id|taxpayer",
}


@dataclass(frozen=True)
class Kind:
    """One kind of personal data: a pattern, a test of the matched text, and scores."""

    name: str
    pattern: str
    needs: str  # a character every match holds; texts without it are not searched
    base: bool  # base kinds are always reported
    score: float


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the Luhn sum of a text of digits is divisible by ten."""
    def step(total: Column, place: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - place, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(place % 2 == 0, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), step) % 10 == 0


def _mod97(code: Column) -> Column:
    """Whether an account code, its first four characters moved to the end, is 1 modulo 97."""
    moved = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def step(rest: Column, place: Column) -> Column:
        number = F.ascii(F.substring(moved, place, F.lit(1)))
        return F.when(number < 58, rest * 10 + number - 48).otherwise(rest * 100 + number - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1


def _at_most_255(part: Column) -> Column:
    plain = F.ltrim(part, F.lit("0"))
    return (F.length(plain) <= 3) & (F.concat(F.lit("0"), F.substring(plain, 1, 3)).cast("int") <= 255)


def _valid(kind: str, hit: Column) -> Column:
    count = F.length(_digits(hit))
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), _at_most_255)
    if kind == "card":
        return F.when(count.between(13, 19), _luhn(_digits(hit))).otherwise(F.lit(False))
    if kind == "phone":
        return count.between(9, 15)
    if kind == "iban":
        return F.when(F.length(hit).between(15, 34), _mod97(hit)).otherwise(F.lit(False))
    return F.lit(True)


KINDS = [
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", True, 0.8),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", ".", True, 0.7),
    Kind("card", r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++", "", True, 0.8),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", True, 0.7),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}+(?![A-Za-z0-9])", "", False, 0.7),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", False, 0.3),
]

_SPANS = "array<struct<start:int,end:int,hit:string>>"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches of a pattern as array<struct<start, end, hit>>.

    The pieces between matches come from ``split``; adding up lengths gives offsets.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def located(found: Column) -> Column:
        parts = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found, lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit")))

        def add(state: Column, part: Column) -> Column:
            start = state["at"] + part["gap"]
            end = start + F.length(part["hit"])
            span = F.struct(start.alias("start"), end.alias("end"), part["hit"].alias("hit"))
            return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

        def block(state: Column, number: Column, listed: Column) -> Column:
            empty = F.struct(state["at"].alias("at"), F.array().cast(_SPANS).alias("out"))
            done = F.aggregate(F.slice(listed, number * BLOCK + 1, F.lit(BLOCK)), empty, add)
            return _let(done, lambda x: F.struct(x["at"].alias("at"), F.concat(state["out"], x["out"]).alias("out")))

        zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))
        return _let(parts, lambda listed: F.aggregate(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / BLOCK).cast("int")), zero, lambda s, n: block(s, n, listed))["out"])

    return _let(hits, lambda found: F.when(F.size(found) > 0, located(found)).otherwise(F.array().cast(_SPANS)))


def _cut(text: Column) -> Column:
    """The text in pieces of CUT code points, the last one shorter."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))


def _around(cuts: Column, span: Column) -> Column:
    """A span with NEAR code points on either side, from the pieces of its text that hold them."""
    begin = F.greatest(span["start"] - NEAR, F.lit(0))
    piece = F.floor(begin / CUT).cast("int")
    pieces = F.slice(cuts, piece + 1, F.floor((span["end"] + NEAR - 1) / CUT).cast("int") - piece + 1)
    return F.substring(F.array_join(pieces, ""), begin - piece * CUT + 1, span["end"] + NEAR - begin)


def _kind_spans(text: Column, kind: Kind) -> Column:
    """Accepted spans of one kind as array<struct<kind, start, end, score, base>>."""
    def scored(span: Column, cuts: Column) -> Column:
        around = _around(cuts, span)
        near = F.lower(around).rlike(rf"\b(?:{CONTEXT[kind.name]})")
        return F.struct(F.lit(kind.name).alias("kind"), span["start"].alias("start"), span["end"].alias("end"),
                        (F.lit(kind.score) + F.when(near, 0.15 if kind.base else 0.35).otherwise(0.0)).alias("score"), F.lit(kind.base).alias("base"))

    empty = F.array().cast("array<struct<kind:string,start:int,end:int,score:double,base:boolean>>")
    valid = F.filter(matches(text, kind.pattern), lambda s: _valid(kind.name, s["hit"]))
    found = _let(valid, lambda hits: F.when(F.size(hits) > 0, _let(_cut(text), lambda cuts: F.transform(hits, lambda s: scored(s, cuts)))).otherwise(empty))
    found = found if kind.base else F.filter(found, lambda s: s["score"] >= ACCEPT)
    return F.when(text.contains(kind.needs), found).otherwise(empty) if kind.needs else found


def find_personal_data(df: DataFrame, text: str = "text", into: str = "personal") -> DataFrame:
    """Add ``into``: spans by kind, then start, as array<struct<kind, start, end, score, base>>.

    Base spans (email, ip, card, phone) are all kept; their score only ranks them.  Account codes (mod
    97) and national numbers are added when checksum and context words lift them over ACCEPT.
    """
    value = text_or_empty(text)
    return df.withColumn(into, F.concat(*[_kind_spans(value, kind) for kind in KINDS]))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def personal_data_digest(documents: DataFrame) -> DataFrame:
    """One row per document: counts of base spans, their digest, and all spans."""
    found = find_personal_data(documents.select("doc_id", "text"))
    spans = F.col("personal")

    def number(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [number(kind.name) for kind in KINDS if kind.base]
    return found.select("doc_id", *counts, F.sha2(span_text(F.filter(spans, lambda s: s["base"])), 256).alias("base_sha256"), span_text(spans).alias("spans"))
