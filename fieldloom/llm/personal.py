"""Personal data: patterns propose, checksums confirm, context words adjust.

Emails, network addresses, payment cards (Luhn) and phone numbers are always
reported when pattern and check hold; words nearby change their score only.  Account numbers
(IBAN: length by country, mod-97) and national identity numbers (that can exist) are added when
their score reaches ``REPORT``: an identity number needs a word that speaks for it, an account number
is left out beside a word that speaks against it and none for it.  Patterns are written so that a long text is read once: runs
are entered at their start only and never backtracked.

Defined results: a null or empty text has no spans; spans of different kinds may
overlap; repeated rows are judged each on its own; other columns are ignored, or
kept by ``redacted``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spans import NEAR, count_of, digest_text, with_matches, with_spans

BASE = {"email": 0, "ip": 1, "card": 2, "phone": 3}
ADDED = {"iban": 4, "ssn": 5}
LOCAL = r"A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # whole runs of 14 to 19 digits with single blanks or hyphens between
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)"
            r"(?![A-Za-z0-9])",
    # areas 000, 666 and 900 up, group 00 and serial 0000 are never given out
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
}
QUICK = {"email": lambda t: F.contains(t, F.lit("@")), "phone": lambda t: F.contains(t, F.lit("+"))}
#: score of a confirmed match, words that raise it, words that lower it (whole words)
SCORES = {
    "email": (0.8, "e?-?mail|contact|write to|courriel|correo", "noreply|no-reply"),
    "ip": (0.5, "ip|address|host|server|client", "version|release|section"),
    "card": (0.8, "card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta", "order|serial|isbn"),
    "phone": (0.7, "(?:tele)?phone|tel|call|fax|mobile?", "id|ref"),
    "iban": (0.6, "iban|account|bank|konto|compte|cuenta", "example|sample|dummy|test"),
    "ssn": (0.3, "ssn|social security|tax|identity", "order|part|serial"),
}
# fixed values: characters of an account number by country
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "ES": 24, "FI": 18,
    "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21,
    "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30,
    "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24,
    "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26,
    "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
REPORT = 0.5
ORDER = ("email", "phone", "card", "iban", "ip", "ssn")  # wider kinds are replaced first


def luhn(found: Column) -> Column:
    digits = F.reverse(F.regexp_replace(found, "[^0-9]", ""))
    total = F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), lambda acc, i: acc + F.when(
        i % 2 == 1, F.substr(digits, i, F.lit(1)).cast("int")).otherwise(
        2 * F.substr(digits, i, F.lit(1)).cast("int")
        - F.when(F.substr(digits, i, F.lit(1)) > "4", 9).otherwise(0)))
    return total % 10 == 0


def mod_97(found: Column) -> Column:
    plain = F.replace(found, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))
    rest = F.aggregate(F.split(turned, ""), F.lit(0), lambda acc, c: (
        acc * F.when(c.between("0", "9"), 10).otherwise(100)
        + F.coalesce(F.conv(c, 36, 10).cast("int"), F.lit(0))) % 97)
    size = F.char_length(plain)
    # of other countries any length the standard allows
    lengths = F.create_map(*[F.lit(v) for kv in IBAN_LENGTHS.items() for v in kv])
    fits = F.coalesce(size == F.try_element_at(lengths, F.left(plain, F.lit(2))), size.between(15, 34))
    return fits & (rest == 1)


def octets(found: Column) -> Column:
    part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]?)"
    return found.rlike(rf"^{part}(?:\.{part}){{3}}$")


def confirmed(kind: str, found: Column) -> Column:
    if kind == "ip":
        return octets(found)
    if kind == "card":
        return luhn(found)
    if kind == "phone":
        return F.char_length(F.regexp_replace(found, "[^0-9]", "")).between(10, 15)
    if kind == "iban":
        return mod_97(found)
    return F.lit(True)


def score(kind: str, before: Column, after: Column) -> Column:
    value, raises, lowers = SCORES[kind]
    near = F.lower(F.concat_ws(" ", before, after))
    return (F.lit(value) + F.when(near.rlike(rf"\b(?:{raises})\b"), F.lit(0.2)).otherwise(F.lit(0.0))
            - F.when(near.rlike(rf"\b(?:{lowers})\b"), F.lit(0.2)).otherwise(F.lit(0.0)))


def reported(kind: str, found: Column, before: Column, after: Column) -> Column:
    ok = confirmed(kind, found)
    return ok if kind in BASE else ok & (score(kind, before, after) >= REPORT)


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans``: array of start, stop, rank, kind, found, score, sorted."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kinds = BASE | ADDED
    spans = with_spans(with_matches(rows, "text", PATTERNS, QUICK).drop("text"), kinds)

    def kept(k: str) -> Column:
        return F.transform(
            F.filter(f"s_{k}", lambda s: reported(k, s["found"], s["before"], s["after"])),
            lambda s: F.struct(s["start"], s["stop"], s["rank"], s["kind"], s["found"],
                               score(k, s["before"], s["after"]).alias("score")))

    order = F.concat(*[kept(k) for k in kinds])
    return spans.select("doc_id", F.array_sort(F.transform(order, lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["stop"].alias("stop"),
        s["kind"].alias("kind"), s["found"].alias("found"), s["score"].alias("score")))).alias("spans"))


def personal_digest(found: DataFrame) -> DataFrame:
    """Counts and digests of ``personal_data``."""
    counts = [count_of(F.col("spans"), k).alias(f"n_{k}") for k in BASE]
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    return found.select("doc_id", *counts, F.sha2(digest_text(base), 256).alias("base_sha256"),
                        digest_text(F.col("spans")).alias("spans"),
                        F.array_join(F.transform("spans", lambda s: F.format_number(s["score"], 1)), ",").alias("scores"))


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every reported match replaced by its kind in brackets.  Kinds
    are replaced one after the other, each on what the wider ones left."""
    names = docs.columns
    rows = docs.select(F.struct("*").alias("__row"), F.col("text").alias("__text"))
    for k in ORDER:
        cut = with_matches(rows, "__text", {k: PATTERNS[k]}, QUICK)

        def shown(p: Column, i: Column, k: str = k) -> Column:
            found = F.get(f"m_{k}", i)  # none after the last piece
            hit = found.isNotNull() & reported(k, found, F.right(p, F.lit(NEAR)),
                                               F.left(F.get(f"p_{k}", i + 1), F.lit(NEAR)))
            return F.concat(p, F.when(hit, F.lit(f"[{k.upper()}]")).otherwise(F.coalesce(found, F.lit(""))))

        whole = F.array_join(F.transform(f"p_{k}", lambda p, i: shown(p, i)), "")
        rows = cut.select("__row", F.when(F.col(f"m_{k}").isNotNull(), whole)
                          .otherwise(F.col("__text")).alias("__text"))
    return rows.select(*[F.col("__text").alias(c) if c == "text" else F.col(f"__row.`{c}`") for c in names])
