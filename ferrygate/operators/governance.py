"""Personal-data scan of raw text.

Each detector is a pair of expressions: one cuts whole candidate tokens out of the text, the
other decides per token. Findings of all columns come from one narrow pass without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Detector token shapes, decisions and severities. Every token shape takes in whole
# digit runs, so nothing is found inside a longer number, and none nests one repetition in another.
EMAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
EMAIL_GAP = r"[^A-Za-z0-9._%+\-@]+"
CARD_GROUPS = r"[0-9]{4}[ \-][0-9]{4}[ \-][0-9]{4}[ \-][0-9]{4}"
PHONE = (
    r"(?:\+[0-9]{1,3}[ .\-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .\-][0-9]{3,4}[ .\-][0-9]{4}"
)
NUMBER_TOKEN = f"{CARD_GROUPS}|{PHONE}|[0-9]+"
DOTTED_TOKEN = r"[0-9][0-9.]*"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"\A{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}\.*\z"
SEVERITY = {"card": "High", "email": "Medium", "phone": "Medium", "ip": "Low"}
#: Version of the values above; a change of any of them needs a new one, so that scanned files are scanned again.
DETECTORS = 1
FINDING = "table_name string, column_name string, row_key string, kind string, severity string, n int, low boolean"


def _tokens(text: Column, shape: str) -> Column:
    return F.regexp_extract_all(text, F.lit(shape), F.lit(0))


def luhn_valid(digits: Column) -> Column:
    """Check-digit test of a digit string (doubling every second digit from the right)."""
    reversed_digits = F.split(F.reverse(digits), "")
    points = F.transform(
        reversed_digits,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)
        ),
    )
    return F.aggregate(points, F.lit(0), lambda total, p: total + p) % 10 == 0


def _is_card(token: Column) -> Column:
    digits = F.translate(token, " -", "")
    plain = token.rlike(r"\A[0-9]+\z") | token.rlike(rf"\A{CARD_GROUPS}\z")
    fits = plain & F.length(digits).between(13, 19)
    return F.when(fits, luhn_valid(digits)).otherwise(F.lit(False))


def _is_phone(token: Column) -> Column:
    return token.rlike(rf"\A{PHONE}\z") & ~token.rlike(rf"\A{CARD_GROUPS}\z")


def _emails(text: Column) -> Column:
    # Cut at characters no address has; only pieces with an @ are searched.
    pieces = F.filter(F.split(text, EMAIL_GAP), lambda piece: piece.contains("@"))
    return F.aggregate(
        pieces, F.lit(0), lambda total, piece: total + F.regexp_count(piece, F.lit(EMAIL))
    )


def detector_counts(text: Column) -> dict[str, Column]:
    """Number of findings per kind in a text column."""
    numbers = _tokens(text, NUMBER_TOKEN)
    return {
        "card": F.size(F.filter(numbers, _is_card)),
        "email": _emails(text),
        "ip": F.size(F.filter(_tokens(text, DOTTED_TOKEN), lambda t: t.rlike(IPV4))),
        "phone": F.size(F.filter(numbers, _is_phone)),
    }


def pii_findings(
    df: DataFrame,
    table: str,
    key: str,
    columns: list[str] | None = None,
    keep: dict[str, str] | None = None,
) -> DataFrame:
    """``table_name, column_name, row_key, kind, severity, n, low`` for rows with findings.

    ``columns`` defaults to every text column. ``low`` marks findings of low severity; they
    are kept in the result. ``keep`` names further columns to carry along: result name to column of ``df``.
    """
    kept = keep or {}
    names = columns or [
        f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name != key
    ]
    found = F.array(
        *(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(kind).alias("kind"),
                F.lit(SEVERITY[kind]).alias("severity"),
                F.coalesce(n, F.lit(0)).alias("n"),
            )
            for name in names
            for kind, n in detector_counts(F.col(name)).items()
        )
    )
    hits = F.filter(found, lambda f: f["n"] > 0)
    return (
        df.select(
            F.col(key).cast("string").alias("row_key"),
            *(F.col(column).alias(name) for name, column in kept.items()),
            F.explode(hits).alias("f"),
        )
        .select(F.lit(table).alias("table_name"), "f.column_name", "row_key", "f.kind",
                "f.severity", "f.n", (F.col("f.severity") == "Low").alias("low"), *kept)
    )
