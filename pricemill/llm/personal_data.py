"""Personal data in whole texts: regular expressions propose, checksums confirm, context words adjust the score.

Everything is a DataFrame expression over one row: no exchange, no Python.  Matches come from ``regexp_extract_all`` and
the text between them from ``split`` by the same pattern; the running sum of both lengths gives every match its place.
So a text is read a fixed number of times, whatever its length, and a match knows the text before and after it.

``email``, ``ip``, ``card`` and ``phone`` are always kept once their checks hold; their score tells how sure the context
makes them.  ``iban`` (confirmed by mod 97 and its country's length), ``ssn`` and ``tel`` (numbers without a country code)
are kept where the score reaches ``LEAST_SCORE``: the last two need a context word.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

LEAST_SCORE = 0.6
NEAR = 48  # code points before and after a match in which context words count
RAISE, LOWER = 0.3, 0.3
BLOCK = 256  # running sums are taken in blocks of as many matches, and then over the blocks

# Lengths of the account numbers of ISO 13616, by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27,
    "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25,
    "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23,
    "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.

    ``proposes`` is the pattern as stated, ``finds`` an equal one whose quantifiers never give back and which does not
    start inside a run, so that long runs of letters or digits take linear time and no stack; ``hint`` is a pattern that
    every match holds.  ``raises`` and ``lowers`` are alternatives of context words, in lower case.
    """

    name: str
    proposes: str
    finds: str
    hint: str
    confirms: Callable[[Column], Column]
    prior: float
    raises: str
    lowers: str
    stays: bool  # kept whatever the score
    shortens: Callable[[Column], Column] | None = None  # what of a proposal is the value: it begins where the proposal does


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.ascii(F.substring(digits, i, F.lit(1))) - 48
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when((n - i) % 2 == 1, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number without spaces passes the check of ISO 7064 mod 97-10."""
    moved = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substring(moved, i, F.lit(1)))
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add) == 1


def _ip(c: Column) -> Column:
    return c["value"].rlike(r"\A(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|\z)){4}\z")


def _card(c: Column) -> Column:
    digits = digits_of(c["value"])
    return F.length(digits).between(13, 19) & luhn(digits)


def _phone(c: Column) -> Column:
    return F.length(digits_of(c["value"])).between(9, 15)


def words(alternatives: str) -> str:
    """A pattern of any of the words, between characters that are neither letters nor digits."""
    return rf"(?:^|[^\p{{L}}\p{{N}}])(?:{alternatives})(?:[^\p{{L}}\p{{N}}]|$)"


def _alone(c: Column) -> Column:
    """The match is no part of a longer word or number."""
    return ~c["before"].rlike(r"[A-Za-z0-9+.-]\z") & ~c["after"].rlike(r"\A[-A-Za-z0-9]")


def _iban_length(value: Column) -> Column:
    lengths = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])
    return F.coalesce(F.try_element_at(lengths, F.substring(value, 1, 2)), F.lit(0))


def _account(value: Column) -> Column:
    return F.replace(value, F.lit(" "), F.lit(""))


def _iban(c: Column) -> Column:
    account = _account(c["value"])
    return _alone(c) & (F.length(account) == _iban_length(account)) & mod97(account)


def _without_words(value: Column) -> Column:
    """An account number in groups of four without the words in capitals that follow it."""
    end = (_iban_length(value) + F.floor((_iban_length(value) - 1) / 4)).cast("int")
    return F.when(F.substring(value, end + 1, F.lit(1)) == " ", F.left(value, end)).otherwise(value)


def _ssn(c: Column) -> Column:
    return _alone(c) & ~c["value"].rlike(r"\A(?:000|666|9)") & ~c["value"].rlike(r"\A....00-|0000\z")


def _tel(c: Column) -> Column:
    return _alone(c) & ~c["before"].rlike(r"\+[0-9]{1,3}[ .(-]{0,2}\z")


# The patterns of the kinds.  Those of the first four, and their order, belong to the result.
KINDS = (
    Kind("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", lambda c: F.lit(True),
         0.9, "e-?mail|mail|contact|write|correo|courriel|kontakt", "noreply|no-reply", True),
    Kind("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]", _ip,
         0.6, "ip|address|host|server|login|client", "version|release|section|chapter|v", True),
    Kind("card", r"[0-9]([\x20-]?[0-9])+", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9]", _card,
         0.7, "card|credit|visa|mastercard|amex|payment|karte|tarjeta|carte", "isbn|order|tracking|serial", True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", _phone,
         0.7, "phone|tel|telephone|call|mobile|fax|telefon|tel[eé]fono|t[eé]l[eé]phone", "sum|total|offset", True),
    Kind("iban", r"[A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]{4})+(\x20?[A-Z0-9]+)?",
         r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4})++(?:\x20?[A-Z0-9]++)?", r"[A-Z]{2}[0-9]{2}", _iban,
         0.8, "iban|account|bank|konto|cuenta|compte", "example|sample", False, _without_words),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "-[0-9]{2}-", _ssn,
         0.4, "ssn|social security|social-security", "part|order|serial|isbn", False),
    Kind("tel", r"(\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}",
         r"(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}", r"[0-9]{3}[\x20.-][0-9]{4}", _tel,
         0.4, "phone|tel|telephone|call|mobile|fax|telefon|tel[eé]fono|t[eé]l[eé]phone",
         "sum|total|order|serial|isbn", False),
)
BASE = tuple(k for k in KINDS if k.stays)
SPAN = "struct<kind:string,start:bigint,end:bigint,value:string,score:double>"


def running_sums(values: str) -> Column:
    """Sums of the values of a column up to each one: within blocks, then over the blocks, so that no long array is copied per value."""
    last = F.size(values) - 1
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor(last / BLOCK).cast("int")),
        lambda b: F.transform(F.sequence(b * BLOCK, F.least(b * BLOCK + BLOCK - 1, last)), lambda i: F.get(values, i)),
    )
    none = F.array().cast("array<bigint>")
    inside = F.transform(blocks, lambda block: F.aggregate(
        block, none, lambda sums, v: F.array_append(sums, F.coalesce(F.try_element_at(sums, F.lit(-1)), F.lit(0).cast("long")) + v)))
    whole = F.aggregate(inside, none, lambda sums, block: F.concat(
        sums, F.transform(block, lambda v: v + F.coalesce(F.try_element_at(sums, F.lit(-1)), F.lit(0).cast("long")))))
    return F.when(F.size(values) > 0, whole).otherwise(none)


def _score(kind: Kind, c: Column) -> Column:
    near = F.lower(F.concat_ws(" ", F.right(c["before"], F.lit(NEAR)), F.left(c["after"], F.lit(NEAR))))
    score = (
        F.lit(kind.prior) + F.when(near.rlike(words(kind.raises)), RAISE).otherwise(0.0)
        - F.when(near.rlike(words(kind.lowers)), LOWER).otherwise(0.0)
    )
    return F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)), 2)


def find_personal_data(docs: DataFrame, text: str = "text", into: str = "spans", least_score: float = LEAST_SCORE) -> DataFrame:
    """``docs`` with ``into``: the spans of personal data in the whole ``text``, by kind in the order of ``KINDS``, then start.

    A span has its kind, start and end (code points, end exclusive), value and score (0 to 1).  Proposals of a kind are
    leftmost and do not overlap; one that fails its check is dropped and its text is not searched again.  Kinds do not
    know of each other, so spans of different kinds may overlap.  A null or empty text has no spans.  Repeated rows stay
    rows, further columns stay as they are (but for a column named ``into``), an empty table gives an empty table.
    """
    row, whole = "_pii_row", F.coalesce(F.col("_pii_row")[text], F.lit(""))
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row))
    nothing = F.array().cast("array<string>")
    found = found.withColumns({
        f"_values_{k.name}": F.when(whole.rlike(k.hint), F.regexp_extract_all(whole, F.lit(k.finds), F.lit(0))).otherwise(nothing)
        for k in KINDS
    })
    found = found.withColumns({
        f"_gaps_{k.name}": F.when(F.size(f"_values_{k.name}") > 0, F.split(whole, k.finds, -1)).otherwise(nothing) for k in KINDS
    })
    found = found.withColumns({f"_steps_{k.name}": F.zip_with(
        F.slice(f"_gaps_{k.name}", F.lit(1), F.size(f"_values_{k.name}")), f"_values_{k.name}",
        lambda gap, value: (F.length(gap) + F.length(value)).cast("long")) for k in KINDS})
    found = found.withColumns({f"_ends_{k.name}": running_sums(f"_steps_{k.name}") for k in KINDS})

    def spans(k: Kind) -> Column:
        values, gaps, ends = f"_values_{k.name}", f"_gaps_{k.name}", f"_ends_{k.name}"
        proposed = F.zip_with(
            F.arrays_zip(F.col(values).alias("value"), F.col(ends).alias("end")),
            F.arrays_zip(F.slice(gaps, F.lit(1), F.size(values)).alias("before"), F.slice(gaps, F.lit(2), F.size(values)).alias("after")),
            lambda v, g: F.struct(
                v["value"].alias("value"), (v["end"] - F.length(v["value"])).alias("start"), g["before"].alias("before"),
                g["after"].alias("after")),
        )
        if k.shortens is not None:
            proposed = F.transform(proposed, lambda c: F.struct(
                k.shortens(c["value"]).alias("value"), c["start"].alias("start"), c["before"].alias("before"),
                F.concat(F.substring(c["value"], F.length(k.shortens(c["value"])) + 1, F.length(c["value"])), c["after"]).alias("after")))
        scored = F.transform(F.filter(proposed, k.confirms), lambda c: F.struct(
            F.lit(k.name).alias("kind"), c["start"].alias("start"), (c["start"] + F.length(c["value"])).alias("end"),
            c["value"].alias("value"), _score(k, c).alias("score")))
        return (scored if k.stays else F.filter(scored, lambda s: s["score"] >= least_score)).cast(f"array<{SPAN}>")

    return found.select(
        *[F.col(row)[c].alias(c) for c in docs.columns if c != into], F.concat(*[spans(k) for k in KINDS]).alias(into))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest_personal_data(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: the number of spans of every kind, the base spans' SHA-256, and all spans.

    A null or empty text has counts of zero, the hash of the empty string and no spans.  Rows are kept as they are,
    repeated and null doc_ids included; an empty table gives an empty result; further columns are ignored.
    """
    found = find_personal_data(docs.select("doc_id", "text"), into="_spans")
    base = F.filter("_spans", lambda s: s["kind"].isin([k.name for k in BASE]))

    def number(kind: Kind) -> Column:
        return F.size(F.filter("_spans", lambda s: s["kind"] == kind.name)).cast("long").alias(f"n_{kind.name}")

    return found.select(
        "doc_id", *[number(k) for k in KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("_spans")).alias("spans"),
    )
