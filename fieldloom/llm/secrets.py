"""Secret scan with linking of credential parts.

Assignments to secret-like names, access key ids and long hexadecimal runs are always
reported.  Weak candidates - user names, mixed random-looking tokens, endpoints -
mean little alone.  They are rows of an interval join: a weak part opens a scope of
``SCOPE`` code points before its start and after its stop, and it is reported only when
a complementary part of the same document reaches into it (a secret for identifiers and
endpoints; an identifier or an endpoint for secrets).  The join is on document and cell
of the scope's width, a part having a row for each cell it touches, and a semi-join, so
the number of parts in a scope does not multiply rows; spans do not overlap within a
kind, so a scope holds few.

Defined results: a null or empty text has no spans; rows of one doc_id with different
texts are told apart by the text; repeated rows give the same result each; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.shared import materialize

from .common import document_key
from .spans import count_of, digest_text, with_matches, with_spans

BASE = {"assign": 0, "access": 1, "hex": 2}
WEAK = {"user": 3, "key": 4, "endpoint": 5}
ROLES = {"assign": "secret", "access": "identifier", "hex": "secret",
         "user": "identifier", "key": "secret", "endpoint": "endpoint"}
COMPLEMENTS = {"identifier": ("secret",), "endpoint": ("secret",), "secret": ("identifier", "endpoint")}
SCOPE = 200
NAME = "(?i:password|passwd|secret|token|api_?key)"
VALUE = "[A-Za-z0-9+/_.=-]"
PATTERNS = {
    "assign": rf"{NAME}[\"']?\x20*+[:=]\x20*+[\"']?{VALUE}++",
    "access": r"AKIA[A-Z0-9]{12,}+",
    "hex": r"(?<![0-9a-f])[0-9a-f]{32,}+",
    "user": rf"(?<![A-Za-z0-9_])(?i:user(?:name)?|login|account|client_?id)[\"']?\x20*+[:=]\x20*+[\"']?"
            r"[A-Za-z0-9@+/_.-]{3,}+",
    # '=' may stand before (name=value), and there is no upper length: the scope decides
    "key": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}+(?![A-Za-z0-9+/_=-])",
    "endpoint": r"https?://[A-Za-z0-9._~:/?#@!&()*+,;=%-]++|"
                r"(?<![A-Za-z0-9.-])(?:[a-z0-9-]++\.)++[a-z]{2,}+:[0-9]{2,5}+",
}
QUICK = {"access": lambda t: F.contains(t, F.lit("AKIA")),
         "assign": lambda t: F.contains(t, F.lit("=")) | F.contains(t, F.lit(":")),
         "user": lambda t: F.contains(t, F.lit("=")) | F.contains(t, F.lit(":")),
         "endpoint": lambda t: F.contains(t, F.lit(":"))}


def passes(kind: str, found: Column) -> Column:
    if kind == "assign":  # the value has eight characters or more
        return F.char_length(F.regexp_extract(
            found, rf"^{NAME}[\"']?\x20*+[:=]\x20*+[\"']?({VALUE}++)$", 1)) >= 8
    if kind == "key":  # all three classes, so no plain word or path
        return found.rlike("[a-z]") & found.rlike("[A-Z]") & found.rlike("[0-9]")
    return F.lit(True)


def parts(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, ``base`` and ``weak``: sorted arrays of start, rank, stop, kind."""
    rows = document_key(docs).withColumn("text", F.coalesce("text", F.lit("")))
    kinds = BASE | WEAK
    spans = with_spans(with_matches(rows, "text", PATTERNS, QUICK).drop("text"), kinds)

    def joined(some: dict[str, int]) -> Column:
        return F.array_sort(F.concat(*[F.transform(
            F.filter(f"s_{k}", lambda s: passes(k, s["found"])),
            lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"),
                               s["stop"].alias("stop"), s["kind"].alias("kind"))) for k in some]))

    both = spans.select("doc_id", "text_key", joined(BASE).alias("base"), joined(WEAK).alias("weak"))
    free = F.filter("weak", lambda w: ~F.exists("base", lambda b: (
        (b["start"] < w["stop"]) & (w["start"] < b["stop"]))))
    return both.select("doc_id", "text_key", "base", F.when(F.size("weak") > 0, free)
                       .otherwise(F.col("weak")).alias("weak"))


def linked(found: DataFrame) -> DataFrame:
    """doc_id, text_key, ``added``: the weak parts that a scope confirms."""
    keys = ["doc_id", "text_key"]
    names = list(ROLES)
    role = F.element_at(F.array(*[F.lit(ROLES[k]) for k in names]), F.col("p.rank") + 1)
    rows = (found.filter(F.size("weak") > 0).distinct()
            .select(*keys, F.explode(F.concat("base", "weak")).alias("p"))
            .select(*keys, "p", role.alias("role"), F.col("p.start").alias("start"),
                    F.col("p.stop").alias("stop")))

    def cells(first: Column, last: Column) -> Column:
        return F.explode(F.sequence(F.floor(F.greatest(first, F.lit(0)) / SCOPE).cast("int"),
                                    F.floor(last / SCOPE).cast("int")))

    needs = F.explode(F.array(*[F.struct(F.lit(r).alias("have"), F.lit(c).alias("need"))
                                for r, cs in COMPLEMENTS.items() for c in cs]))
    weak = (rows.filter(F.col("p.rank") >= len(BASE)).select("*", needs.alias("x"))
            .filter("x.have = role").withColumn("near", cells(
                F.col("start") - SCOPE - 1, F.col("stop") + SCOPE)))
    other = rows.select(F.col("doc_id").alias("o_id"), F.col("text_key").alias("o_key"),
                        F.col("role").alias("o_role"), F.col("start").alias("o_start"),
                        F.col("stop").alias("o_stop"), cells(F.col("start"), F.col("stop") - 1).alias("o_cell"))
    scope = (F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("text_key") == F.col("o_key"))
             & (F.col("near") == F.col("o_cell")) & (F.col("x.need") == F.col("o_role"))
             & (F.col("o_start") - F.col("stop") <= SCOPE) & (F.col("start") - F.col("o_stop") <= SCOPE))
    return (weak.join(other, scope, "left_semi").groupBy(*keys)
            .agg(F.collect_set("p").alias("added")))


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id, ``base`` and ``spans`` (base and confirmed weak parts, sorted): one row
    per document row."""
    found = materialize(parts(docs), "parts")
    more = linked(found).select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "added")
    joined = found.join(more, F.col("doc_id").eqNullSafe(F.col("__id"))
                        & (F.col("text_key") == F.col("__key")), "left")
    spans = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(found.schema["base"].dataType))))
    return joined.select("doc_id", "base", spans.alias("spans"))


def secret_digest(found: DataFrame) -> DataFrame:
    counts = [count_of(F.col("base"), k).alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(digest_text(F.col("base")), 256).alias("base_sha256"),
                        digest_text(F.col("spans")).alias("spans"))
