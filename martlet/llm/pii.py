"""Personal data: regular expressions propose spans, checksums confirm them, and words
nearby adjust the score.

A text is cut by a pattern into the pieces between its matches; running totals of the
lengths of pieces and matches are the positions. Everything stays in one row, so no
document needs a key and none is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import text_of


@dataclass(frozen=True)
class Kind:
    """A pattern, and what its spans need to count.

    ``base`` kinds are reported whenever ``valid``; the others only if the score, from
    ``score`` and raised by ``bonus`` if a word of ``context`` is near, reaches the
    threshold. Patterns are possessive where that changes nothing, so that a long run
    of one character costs linear time and no stack.
    """

    name: str
    pattern: str
    base: bool
    score: float
    context: str
    bonus: float = 0.3
    sign: str = ""  # what every match contains


#: Kinds in the order in which spans with the same start are listed. The base patterns
#: are fixed values of the result; lookbehinds, possessive forms and least numbers of
#: digits change nothing about the spans that are left after validation.
KINDS = (
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        True, 0.9, r"mail|contact|kontakt|correo|courriel", sign="@",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        True, 0.7, r"\bip\b|host|server|address|adresse", sign=".",
    ),
    Kind("card", r"[0-9](?:[ -]?[0-9]){13,}+", True, 0.7, r"card|karte|tarjeta|carte|visa|credit"),
    Kind(
        "phone", r"\+[0-9](?:[ ().-]*+[0-9]){9,}+", True, 0.7,
        r"phone|tel|call|fax|mobil|anruf|llam|appel", sign="+",
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        False, 0.8, r"iban|account|konto|cuenta|compte|bank|banque",
    ),
    Kind(
        "ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", False, 0.4,
        r"\bssn\b|social security|sozialversicherung|seguridad social", sign="-",
    ),
)
#: Score from which a span of a kind beyond the base counts.
THRESHOLD = 0.6
#: Characters before and after a span in which context words count.
NEAR = 40
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_BLOCK = 256


def _total(array: Column) -> Column:
    return F.aggregate(array, F.lit(0), lambda acc, x: acc + x)


def _block_sums(lengths: Column) -> Column:
    last = F.floor((F.size(lengths) - 1) / _BLOCK).cast("int")
    return F.when(
        F.size(lengths) > 0,
        F.transform(
            F.sequence(F.lit(0), last),
            lambda b: _total(F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK))),
        ),
    ).otherwise(F.array().cast("array<int>"))


def _running(lengths: Column, sums: Column) -> Column:
    """Totals up to and with each element; by blocks, so that the work is not quadratic."""

    def upto(_, i: Column) -> Column:
        block = F.floor(i / _BLOCK).cast("int")
        ahead = F.when(block > 0, _total(F.slice(sums, F.lit(1), block))).otherwise(0)
        first = block * _BLOCK
        return ahead + _total(F.slice(lengths, first + 1, i - first + 1))

    return F.transform(lengths, upto)


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    count = F.length(digits)
    if kind == "ip":
        return match.rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$")
    if kind == "card":
        return count.between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return count.between(10, 15)
    if kind == "iban":
        return _mod97(match)
    if kind == "ssn":
        return ~match.rlike(r"^(?:000|666|9..)-|-00-|-0000$")
    return F.lit(True)


def _mod97(match: Column) -> Column:
    """ISO 7064: letters count 10 to 35, the first four signs go last, remainder 1."""
    plain = F.regexp_replace(match, " ", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))

    def step(acc: Column, sign: Column) -> Column:
        letter = sign.rlike("[A-Z]")
        value = F.when(letter, F.ascii(sign) - 55).otherwise(F.ascii(sign) - 48)
        return (acc * F.when(letter, 100).otherwise(10) + value) % 97

    rest = F.aggregate(F.split(turned, ""), F.lit(0), lambda a, s: F.when(s == "", a).otherwise(step(a, s)))
    return F.length(plain).between(15, 34) & (rest == 1)


def _spans(kind: Kind, place: int) -> Column:
    """Confirmed spans of one kind, from the columns that ``find`` prepares."""
    between, ends = F.col(f"between_{kind.name}"), F.col(f"ends_{kind.name}")

    def one(match: Column, i: Column) -> Column:
        near = F.lower(F.concat_ws(
            " ", F.right(between[i], F.lit(NEAR)), F.left(between[i + 1], F.lit(NEAR))
        ))
        bonus = F.when(near.rlike(kind.context), kind.bonus).otherwise(0.0)
        return F.struct(
            (ends[i] - F.length(match)).alias("start"),
            F.lit(place).alias("kind"),
            ends[i].alias("end"),
            F.least(F.lit(1.0), F.lit(kind.score) + bonus).alias("score"),
            match.alias("match"),
        )

    spans = F.transform(F.col(f"found_{kind.name}"), one)
    kept = F.filter(spans, lambda s: _valid(kind.name, s["match"]))
    return kept if kind.base else F.filter(kept, lambda s: s["score"] >= THRESHOLD)


def find(docs: DataFrame) -> DataFrame:
    """Spans of personal data in the column text of every row of ``docs``.

    Returns ``doc`` (a struct of all columns, whatever their names), ``text`` (null
    counts as empty) and ``spans``: an array of start, kind (place in KINDS), end,
    score and match, by start and kind; positions are code points from 0, ends
    exclusive. Rows are independent: repeated rows and null ids change nothing, an
    empty text has no spans and an empty table no rows.
    """
    frame = docs.select(F.struct("*").alias("doc"), text_of().alias("text"))
    none = F.array().cast("array<string>")
    names = [k.name for k in KINDS]
    frame = frame.withColumns({
        f"found_{k.name}": F.when(
            F.contains("text", F.lit(k.sign)) if k.sign else F.lit(True),
            F.regexp_extract_all("text", F.lit(k.pattern), F.lit(0)),
        ).otherwise(none)
        for k in KINDS
    })
    frame = frame.withColumns({
        f"between_{k.name}": F.when(
            F.size(f"found_{k.name}") > 0, F.split("text", k.pattern, -1)
        ).otherwise(none)
        for k in KINDS
    })
    frame = frame.withColumns({f"steps_{n}": _steps(n) for n in names})
    frame = frame.withColumns({f"sums_{n}": _block_sums(F.col(f"steps_{n}")) for n in names})
    frame = frame.withColumns({
        f"ends_{n}": _running(F.col(f"steps_{n}"), F.col(f"sums_{n}")) for n in names
    })
    spans = F.concat(*[_spans(k, place) for place, k in enumerate(KINDS)])
    return frame.select("doc", "text", F.array_sort(spans).alias("spans"))


def _steps(name: str) -> Column:
    """From the end of one match to the end of the next."""
    between = F.col(f"between_{name}")
    return F.transform(
        F.col(f"found_{name}"), lambda m, i: F.length(between[i]) + F.length(m)
    )


def listing(spans: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
        ),
        ",",
    )


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin([i for i, k in enumerate(KINDS) if k.base]))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in its text replaced by its kind in brackets.

    Overlapping spans are covered by one replacement, named after the first. Rows
    without spans stay as they are; where a text changes, n_chars (if there is one)
    is counted anew.
    """
    names = F.array(*[F.lit(k.name.upper()) for k in KINDS])
    text = F.col("text")

    def cover(state: Column, span: Column) -> Column:
        gap = F.substr(text, state["upto"] + 1, span["start"] - state["upto"])
        mask = F.concat(gap, F.lit("["), F.element_at(names, span["kind"] + 1), F.lit("]"))
        return F.struct(
            F.concat(
                state["out"], F.when(span["start"] >= state["upto"], mask).otherwise("")
            ).alias("out"),
            F.greatest(state["upto"], span["end"]).alias("upto"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("upto"))
    covered = F.aggregate(
        "spans", start, cover, lambda s: F.concat(s["out"], F.substr(text, s["upto"] + 1))
    )
    found = find(docs).withColumn("hit", F.size("spans") > 0)
    found = found.withColumn("clean", F.when(F.col("hit"), covered))
    out = []
    for name in docs.columns:
        old = F.col("doc").getField(name)
        if name == "text":
            old = F.when(F.col("hit"), F.col("clean")).otherwise(old)
        elif name == "n_chars":
            fresh = F.length("clean").cast(docs.schema[name].dataType)
            old = F.when(F.col("hit"), fresh).otherwise(old)
        out.append(old.alias(name))
    return found.select(*out)
