"""Personal data in texts: patterns propose spans, checksums confirm them, context moves the score.

Everything here is an expression over one text column; nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinloom.llm.common import let, running_starts

# The four base patterns, each written so that the regular expression engine neither
# recurses (possessive repeats) nor starts again inside a run that it has already tried (the
# look-behinds; \G lets a match begin where the last one ended). They find the same matches as
#   email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip    [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card  [0-9]([\x20-]?[0-9])+
#   phone \+[0-9][\x20().0-9-]+[0-9]
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# What the method adds.
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = KINDS[:4]
CONTEXT_CHARS = 40
ACCEPT = 0.5

_CONTEXT = {
    "email": r"mail|contact|write to",
    "ip": r"\bip\b|address|host|server",
    "card": r"card|visa|master|amex|credit|debit|karte|tarjeta|carte",
    "phone": r"phone|tel|call|mobile|fax|whatsapp",
    "iban": r"iban|bank|account|konto|cuenta|compte",
    "ssn": r"ssn|social security|tax id",
}


def luhn_ok(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    doubled = lambda d, i: F.when(i % 2 == 1, F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)).otherwise(d)
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, i: doubled(F.ascii(c) - 48, i))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97_ok(code: Column) -> Column:
    """Whether an account code (letters and digits, no blanks) leaves 1 modulo 97 once its head is moved to the end."""
    moved = F.concat(F.substr(code, F.lit(5)), F.substr(code, F.lit(1), F.lit(4)))
    value = lambda c: F.ascii(c) - F.when(F.ascii(c) >= 65, 55).otherwise(48)
    step = lambda a, c: (a * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97
    return F.aggregate(F.split(moved, ""), F.lit(0), step) == 1


def _matches(text: Column, pattern: str, gate: Column) -> Column:
    """Array of (start, end, value, before) of the pattern's matches; code points, end exclusive."""

    def located(pieces: Column, hits: Column) -> Column:
        pairs = F.transform(hits, lambda h, i: F.length(F.element_at(pieces, i + 1)) + F.length(h))
        return let(
            running_starts(pairs),
            lambda at: F.transform(
                hits,
                lambda h, i: F.struct(
                    (F.element_at(at, i + 1) + F.length(F.element_at(pieces, i + 1))).alias("start"),
                    (F.element_at(at, i + 1) + F.length(F.element_at(pieces, i + 1)) + F.length(h)).alias("end"),
                    h.alias("value"),
                    F.right(F.element_at(pieces, i + 1), F.lit(CONTEXT_CHARS)).alias("before"),
                ),
            ),
        )

    found = let(
        F.split(text, pattern, -1),
        lambda p: let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda h: located(p, h)),
    )
    return F.when(gate, found)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    """The checksum or range test of a kind."""
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
        return value.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return let(_digits(value), lambda d: F.when(F.length(d).between(13, 19), luhn_ok(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    if kind == "iban":
        return let(F.replace(value, F.lit(" "), F.lit("")), lambda c: F.length(c).between(15, 34) & mod97_ok(c))
    if kind == "ssn":
        return ~value.rlike(r"^(?:000|666|9..)-|-00-|-0000$")
    return F.lit(True)


def _base(kind: str, value: Column) -> Column:
    """Whether a valid match belongs to the base spans."""
    if kind == "card":
        return F.length(_digits(value)).between(16, 19)
    return F.lit(kind in BASE_KINDS)


def _score(kind: str, value: Column, before: Column) -> Column:
    """Prior of the kind, raised by a context word in the text before the span."""
    near = F.lower(before).rlike(_CONTEXT[kind])
    prior = {"email": 0.9, "ip": 0.7, "phone": 0.7, "iban": 0.8, "ssn": 0.3}.get(kind)
    start = F.when(_base(kind, value), 0.8).otherwise(0.3) if prior is None else F.lit(prior)
    return F.least(F.lit(1.0), start + F.when(near, 0.3).otherwise(0.0))


_GATES = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
    "phone": lambda t: F.contains(t, F.lit("+")) & t.rlike(r"\+[0-9]"),
    "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}"),
    "ssn": lambda t: t.rlike(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
}
_PATTERNS = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE, IBAN, SSN), strict=True))


def find_pii(text: Column) -> Column:
    """Array of struct(kind, start, end, value, score, base), by kind as listed, then start.

    A match that its checksum refuses is dropped without another try. Base matches stay whatever
    their score; others need a score of 0.5. Null and empty texts give an empty array. Positions
    count code points.
    """
    text = F.coalesce(text, F.lit(""))

    def of(kind: str) -> Column:
        none = F.array().cast(
            "array<struct<kind:string,start:int,end:int,value:string,score:double,base:boolean>>"
        )
        scored = F.transform(
            F.filter(_matches(text, _PATTERNS[kind], _GATES[kind](text)), lambda m: _valid(kind, m["value"])),
            lambda m: F.struct(
                F.lit(kind).alias("kind"),
                m["start"].alias("start"),
                m["end"].alias("end"),
                m["value"].alias("value"),
                _score(kind, m["value"], m["before"]).alias("score"),
                _base(kind, m["value"]).alias("base"),
            ),
        )
        return F.coalesce(F.filter(scored, lambda s: s["base"] | (s["score"] >= ACCEPT)), none)

    return F.concat(*(of(k) for k in KINDS))


def spans_text(spans: Column) -> Column:
    """Comma-joined kind:start:end."""
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def mask(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; spans that overlap are replaced as one,
    by the kind of the first (of those that start together, the longest).

    Null texts stay null.
    """
    ordered = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("end"), s["kind"].alias("kind")))
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        kept = F.substr(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], -s["end"]).alias("at"),
            F.when(s["start"] < acc["at"], acc["out"])
            .otherwise(F.concat(acc["out"], F.array(kept, F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))))
            .alias("out"),
        )

    masked = F.aggregate(
        ordered, start, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substr(text, a["at"] + 1))
    )
    return F.when(F.size(spans) > 0, masked).otherwise(text)


def mask_all(text: Column) -> Column:
    """Struct of (text, hit): the text masked again and again until nothing is found in it, and whether anything was.

    What is masked may have kept a match of another kind from being valid (a number that ran on into
    it), so a text in which something was found is searched again. Every mask takes a digit or an @
    away, so there are at most as many rounds as the text has of these, and one that finds nothing;
    the rounds after that one only hand the text on. Null texts stay null.
    """
    again = lambda t: let(
        find_pii(t), lambda f: F.struct(mask(t, f).alias("text"), (F.size(f) > 0).alias("open"), (F.size(f) > 0).alias("hit"))
    )
    start = F.struct(text.alias("text"), F.lit(True).alias("open"), F.lit(False).alias("hit"))

    def step(acc: Column, _: Column) -> Column:
        searched = let(again(acc["text"]), lambda n: n.withField("hit", acc["hit"] | n["hit"]))
        return F.when(acc["open"], searched).otherwise(acc)

    rounds = F.sequence(F.lit(0), F.regexp_count(text, F.lit("[0-9@]")))
    return F.aggregate(rounds, start, step, lambda acc: acc.dropFields("open"))


def mask_documents(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with personal data in `text` masked, and `n_chars` (if there) following the text.

    One expression on each row, with as many rounds as its text needs. All other columns stay as
    they are, whatever their names; null texts stay null.
    """
    text, chars = (docs.columns.index(k) if k in docs.columns else None for k in ("text", "n_chars"))
    placed = docs.toDF(*(f"c{i}" for i in range(len(docs.columns)))).withColumn("masked", mask_all(F.col(f"c{text}")))
    columns = [F.col(f"c{i}") for i in range(len(docs.columns))]
    columns[text] = F.col("masked.text")
    if chars is not None:
        kind = docs.schema[chars].dataType
        columns[chars] = F.when(F.col("masked.hit"), F.length("masked.text").cast(kind)).otherwise(columns[chars])
    return placed.select(columns).toDF(*docs.columns)


def pii_documents(docs: DataFrame) -> DataFrame:
    """Spans and base counts of every document: `doc_id, n_*, base_sha256, spans`."""
    found = docs.select(F.col("doc_id"), find_pii(F.col("text")).alias("_found"))
    base = F.filter("_found", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("_found", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("_found")).alias("spans"),
    )
