"""Personal data by patterns, checksums and context words, in DataFrame functions only.

Patterns propose spans; validators confirm them: parts of an address up to 255, Luhn's
check digit for cards, the remainder modulo 97 for account numbers, digit counts for
phones. Kinds whose form is weak start from a low score that nearby context words raise;
spans with a score of ``LEAST_SCORE`` or more are kept. The four base kinds are confirmed
by their validator alone, and context only adds to their score.

Positions are not given by Spark's regular expressions; they are sums over what lies
between the matches. The patterns are possessive and look behind themselves, so a long
run of digits or letters takes linear time and no recursion; they match the same spans
as the plain forms in their comments. Sums are taken over blocks of matches and contexts
from pieces of the text, so many matches in one text take linear time as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_SCORE = 0.5
#: Characters before and after a span in which context words are looked for.
NEAR = 40
#: Characters in a piece of text that contexts are taken from; more than ``NEAR``.
TILE = 1024
#: Matches whose lengths are summed together.
BLOCK = 256
CONTEXT_GAIN = 0.3

#: Kinds in the order of the digest, and their patterns.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: Score of a confirmed span before its context.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
#: Words near a span that raise its score.
CONTEXT = {
    "email": r"(?i)e-?mail|contact|write to",
    "ip": r"(?i)\bip\b|address|server|host",
    "card": r"(?i)card|visa|mastercard|payment|karte|carte|tarjeta",
    "phone": r"(?i)phone|call|tel|mobile|fax",
    "iban": r"(?i)iban|account|bank|konto|compte|cuenta",
    "ssn": r"(?i)ssn|social security|taxpayer",
}

SPANS = "array<struct<kind:string,at:int,start:int,end:int,score:double>>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the sum of the digits, every second from the right doubled, ends in 0."""
    backwards = F.split(F.reverse(digits), "")
    doubled = F.transform(
        backwards,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            (d.cast("int") * 2) % 10 + F.floor(d.cast("int") * 2 / 10).cast("int")
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def mod97(text: Column) -> Column:
    """Whether an account number, its head moved to its end and letters read as 10 to 35,
    leaves 1 modulo 97."""
    plain = F.regexp_replace(text, " ", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    values = F.transform(F.split(turned, ""), lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).when(c != "", F.ascii(c) - 55))
    step = lambda a, v: F.when(v.isNull(), a).otherwise((a * F.when(v > 9, 100).otherwise(10) + v) % 97)
    return F.aggregate(values, F.lit(0), step) == 1


def _valid(kind: str, text: Column) -> Column:
    n = F.length(_digits(text))
    if kind == "ip":
        parts = F.transform(F.split(text, "[.]"), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (p.cast("int") <= 255))
    if kind == "card":
        return n.between(14, 19) & luhn(_digits(text))
    if kind == "phone":
        return n.between(10, 15)
    if kind == "iban":
        return F.length(F.regexp_replace(text, " ", "")).between(15, 34) & mod97(text)
    if kind == "ssn":
        return ~text.rlike("^(000|666|9)|-00-|-0000$")
    return F.lit(True)


def _confirmed(kind: str, pairs: Column) -> Column:
    """Starts and texts of the matches that hold, from the gaps and matches of a text.

    A start is the sum of all lengths before it. Arrays are copied when they grow, so sums
    are taken over blocks of ``BLOCK`` matches first, then inside each.
    """
    size = lambda p: F.length(p["gap"]) + F.length(p["match"])
    none = F.array().cast("array<struct<start:int,text:string>>")

    def cut(pairs):
        last = F.floor((F.greatest(F.size(pairs), F.lit(1)) - 1) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(pairs, b * BLOCK + 1, BLOCK))

    def heads(blocks):
        return F.aggregate(
            F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda a, p: a + size(p))),
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
            lambda a, n: F.struct((a["at"] + n).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")),
        )["out"]

    def inside(b):
        return F.aggregate(
            b["block"],
            F.struct(b["head"].alias("at"), none.alias("out")),
            lambda a, p: F.struct(
                (a["at"] + size(p)).alias("at"),
                F.when(_valid(kind, p["match"]), F.concat(a["out"], F.array(F.struct((a["at"] + F.length(p["gap"])).alias("start"), p["match"].alias("text"))))).otherwise(a["out"]).alias("out"),
            ),
        )["out"]

    starts = lambda blocks: F.flatten(F.transform(F.arrays_zip(blocks.alias("block"), heads(blocks).alias("head")), inside))
    return _bound(pairs, lambda p: _bound(cut(p), starts))


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once: a lambda's argument is not inlined."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _tile(tiles: Column, i: Column) -> Column:
    return F.coalesce(F.get(tiles, i), F.lit(""))


def _before(tiles: Column, at: Column) -> Column:
    """The ``NEAR`` characters before a place, or fewer at the text's start."""
    i = F.floor(at / TILE).cast("int")
    held = F.concat(_tile(tiles, i - 1), _tile(tiles, i))
    first = F.greatest(i - 1, F.lit(0)) * TILE
    return F.substr(held, F.greatest(at - NEAR, F.lit(0)) - first + 1, F.least(at, F.lit(NEAR)))


def _after(tiles: Column, at: Column) -> Column:
    i = F.floor(at / TILE).cast("int")
    return F.substr(F.concat(_tile(tiles, i), _tile(tiles, i + 1)), at - i * TILE + 1, F.lit(NEAR))


def _found(kind: str, text: Column, tiles: Column) -> Column:
    """Confirmed spans of one kind, or an empty array; code points, end exclusive."""
    between = F.split(text, PATTERNS[kind], -1)
    match = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    empty = F.array().cast(SPANS)
    pairs = F.arrays_zip(F.slice(between, 1, F.size(match)).alias("gap"), match.alias("match"))
    start = _confirmed(kind, pairs)

    def span(s):
        end = s["start"] + F.length(s["text"])
        near = F.concat_ws(" ", _before(tiles, s["start"]), _after(tiles, end))
        gain = F.when(near.rlike(CONTEXT[kind]), CONTEXT_GAIN).otherwise(0.0)
        return F.struct(
            F.lit(kind).alias("kind"),
            F.lit(KINDS.index(kind)).alias("at"),
            s["start"].alias("start"),
            end.alias("end"),
            F.least(F.lit(SCORES[kind]) + gain, F.lit(1.0)).alias("score"),
        )

    kept = F.filter(F.transform(start, span), lambda s: s["score"] >= LEAST_SCORE)
    return F.when(text.rlike(PATTERNS[kind]), kept.cast(SPANS)).otherwise(empty)


def _digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans``: every row's spans (kind, place of the kind in ``KINDS``, start,
    end, score), by start and then kind.

    Null and empty texts have none. Repeated rows have equal spans, each its own row;
    null ids are passed through; no rows give no rows; other columns do not matter.
    Nothing is shuffled, and no Python runs on the executors.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    tiles = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{TILE}}}"), F.lit(0))
    given = given.select("doc_id", "text", F.explode(F.array(tiles)).alias("tiles"))  # computed once a row
    kinds = given.select("doc_id", *(_found(k, F.col("text"), F.col("tiles")).alias(k) for k in KINDS))
    order = lambda a, b: F.when((a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["at"] < b["at"])), -1).otherwise(1)
    spans = F.array_sort(F.concat(*(F.col(k) for k in KINDS)), order)
    return kinds.select("doc_id", spans.alias("spans"))


def pii_digest(found: DataFrame) -> DataFrame:
    """Counts and digests of the spans of ``find_pii``."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["at"] < 4)
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in KINDS[:4]),
        F.sha2(_digest(base), 256).alias("base_sha256"),
        _digest(spans).alias("spans"),
    )
