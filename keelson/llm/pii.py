r"""Operator 3: personal data, proposed by regular expressions, confirmed by
checksums, scored with the words around.

Per kind a regular expression proposes spans, leftmost and non-overlapping;
a validator confirms them (part range, Luhn, mod-97, digit counts) and the text
just before and after moves the score. Spans of the four base kinds that pass their
validator are always kept; the further kinds (iban, ssn) need a score of at
least ``MIN_SCORE``.

DataFrame functions only. The built-ins return what a pattern matched but not
where, so the place is summed up: ``split`` by the pattern gives the text
between the matches and ``regexp_extract_all`` the matches, and both scan with the same
engine, so their lengths in turn give each start. Documents without a digit
or an @ pay one scan per group of kinds.

The patterns are the contract's, in a form that cannot backtrack: quantifiers are possessive
where what follows cannot match inside them, and a run is only tried from its first
character (or from the end of the previous match, ``\G``), since a later
start in the same run succeeds exactly when that one does. Time is linear in the text and
the stack does not grow with a match, so a megabyte of digits is safe. An IBAN has the fixed length
of its country, so what follows it is never taken in; where a country's number is all digits, letters end it.

Edge cases. Null text counts as empty: no spans, and the hash of the empty
string. Repeated rows each get their result. Null doc_ids stay. Other
columns are ignored. Places are code points, the end exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.common import read

MIN_SCORE = 0.6
CONTEXT = 40  # code points before and after a span
CONTEXT_BONUS = 0.3

# Characters after the check digits by country, from the IBAN registry and its list of partial users.
# Countries that changed their length stand under both.
IBAN_DIGITS = {
    11: "NO", 12: "BE", 14: "DK FI FO GL", 15: "SI", 16: "AT BA EE LT XK", 17: "HR", 18: "DE ME RS VA", 19: "TL IL",
    20: "CZ ES SE SK TN DZ", 21: "PT AO MZ", 22: "IS DZ", 24: "HU PL",
}
IBAN_LETTERS = {
    12: "BI", 14: "NL SD FK", 15: "MK", 16: "KZ LU MN", 17: "CH LI LV CR", 18: "BG BH CR GB GE IE", 19: "AE GI IQ OM SO", 20: "AD MD PK RO SA VG",
    21: "CV GW LY ST", 22: "IR TR", 23: "BF BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD", 24: "AL AZ BF BJ BY CI CY DO GT HN LB MA ML NE NI SN SV TG",
    25: "BR EG PS QA UA", 26: "JO KW MU YE", 27: "MT SC", 28: "LC NI", 29: "RU",
}


def _ibans() -> str:
    kinds = ((IBAN_DIGITS, "[0-9]"), (IBAN_LETTERS, "[A-Z0-9]"))
    each = [rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?{one}){{{n}}}" for by_length, one in kinds for n, c in by_length.items()]
    return rf"(?<![A-Za-z0-9])(?:{'|'.join(each)})(?![A-Za-z0-9])"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    words: str  # context words that speak for the kind, as alternatives
    score: float  # of a confirmed span, before the context is read
    base: bool


# The kinds in the order of the contract, then the method's own.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "mail|contact|write|send", 0.9, True),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", "ip|host|server|address|login", 0.6, True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "card|visa|master|credit|pay|karte|tarjeta|carte", 0.7, True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "phone|tel|call|mobile|fax|whatsapp", 0.6, True),
    Kind("iban", _ibans(), "iban|account|bank|konto|cuenta|compte|bic", 0.8, False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "ssn|social|security|tax", 0.4, False),
)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True where the check digit of a string of digits holds."""
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(iban: Column) -> Column:
    """True where the ISO 7064 check of an IBAN (no spaces) holds."""
    turned = F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4))
    return (
        F.aggregate(
            F.split(turned, ""),
            F.lit(0),
            lambda a, c: F.when(c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97),
        )
        == 1
    )


def confirmed(kind: str, m: Column) -> Column:
    """The validator of a kind, for a matched string."""
    if kind == "ip":
        # at most 255 whatever the leading zeros; long numbers never reach a cast
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(m, r"\."), lambda p: (F.length(part(p)) <= 2) | ((F.length(part(p)) == 3) & (part(p) <= "255")))
    if kind == "card":
        d = _digits(m)
        return F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    if kind == "iban":
        s = F.regexp_replace(m, " ", "")
        return F.when(F.length(s).between(15, 34), mod97(s)).otherwise(False)
    if kind == "ssn":
        return ~m.rlike("^(000|666|9)|-00-|-0000$")
    return F.lit(True)


def _spans(text: Column, order: int, kind: Kind) -> Column:
    """array<struct<s, k, e, kind, score>> of the kept spans of one kind."""
    # one struct in an array, so that both scans run once and not again for every match
    scans = F.array(F.struct(F.split(text, kind.pattern, -1).alias("between"), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("matches")))

    def steps(scan: Column) -> Column:
        between = scan["between"]
        return F.transform(
            scan["matches"],
            lambda m, i: F.struct(
                m.alias("m"),
                F.length(m).alias("n"),
                F.length(F.get(between, i)).alias("gap"),
                F.concat(F.right(F.get(between, i), F.lit(CONTEXT)), F.lit(" "), F.left(F.get(between, i + 1), F.lit(CONTEXT))).alias("near"),
            ),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,near:string>>").alias("out"))
    placed = F.aggregate(
        F.flatten(F.transform(scans, steps)),
        start,
        lambda a, x: F.struct(
            (a["at"] + x["gap"] + x["n"]).alias("at"),
            # only confirmed spans are carried along: most long lists of matches are numbers
            F.when(
                confirmed(kind.name, x["m"]),
                F.concat(a["out"], F.array(F.struct((a["at"] + x["gap"]).alias("s"), (a["at"] + x["gap"] + x["n"]).alias("e"), x["near"].alias("near")))),
            )
            .otherwise(a["out"])
            .alias("out"),
        ),
        lambda a: a["out"],
    )
    score = lambda x: F.lit(kind.score) + F.when(F.lower(x["near"]).rlike(rf"\b(?:{kind.words})"), F.lit(CONTEXT_BONUS)).otherwise(0.0)
    scored = F.transform(
        placed,
        lambda x: F.struct(
            x["s"].alias("s"), F.lit(order).alias("k"), x["e"].alias("e"), F.lit(kind.name).alias("kind"),
            F.least(score(x), F.lit(1.0)).alias("score"),
        ),
    )
    return scored if kind.base else F.filter(scored, lambda x: x["score"] >= MIN_SCORE)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, one array of spans per kind, all spans in order, counts and hash."""
    none = F.array().cast("array<struct<s:int,k:int,e:int,kind:string,score:double>>")
    df = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    df = df.withColumn("has_at", F.col("text").contains("@")).withColumn("has_digits", F.col("text").rlike(r"[0-9][^A-Za-z]?[0-9]"))
    for order, kind in enumerate(KINDS):
        asked = "has_at" if kind.name == "email" else "has_digits"
        if kind.name == "ip":
            asked = F.col("has_digits") | F.col("text").contains(".")
            asked = asked & F.col("text").rlike(r"[0-9]\.[0-9]")
        elif kind.name == "phone":
            asked = F.col("text").contains("+")
        else:
            asked = F.col(asked)
        df = df.withColumn(kind.name, F.when(asked, _spans(F.col("text"), order, kind)).otherwise(none))
    base = [k.name for k in KINDS if k.base]
    # the order of the fields (start, kind as listed, end) is the order of the spans
    df = df.withColumn("base", F.array_sort(F.concat(*base))).withColumn("found", F.array_sort(F.concat(*[k.name for k in KINDS])))
    counts = [F.size(n).cast("long").alias(f"n_{n}") for n in base]
    return df.select(
        "doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"), F.col("found").alias("findings")
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents; see the contract for the columns."""
    return find_pii(read(spark, sf_dir, "documents")).drop("findings")
