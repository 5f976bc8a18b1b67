"""Personal data: patterns propose spans, check sums confirm them, words nearby move the score.

Every step is a column expression on the document's own row: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.staging import once
from larder.llm import spans as S
from larder.llm.common import table

# The patterns start only where a run starts or the last match ended (\G), and their repeats are possessive:
# the same matches as the plain patterns, without quadratic scans or deep recursion on long runs.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
NUMBER = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
SSN = r"(?<![0-9A-Za-z-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z-])"
LOCAL_PHONE = r"(?<![0-9A-Za-z+(-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])"

_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_VALID_IP = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"

BASE_KINDS = ["email", "ip", "card", "phone"]
ADDED_KINDS = ["iban", "card_short", "ssn", "phone_local"]
KINDS = BASE_KINDS + ADDED_KINDS

# Score before and after a check sum, what a word nearby adds, and which words count.
_PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "card_short": 0.4, "ssn": 0.3, "phone_local": 0.3}
_WORDS = {
    "email": "e-?mail|contact|write to|mailto",
    "ip": "ip|address|host|server|login",
    "card": "card|visa|mastercard|amex|credit|debit|payment",
    "phone": "phone|tel|call|mobile|fax|cell",
    "iban": "iban|account|bank|transfer",
    "card_short": "card|visa|mastercard|amex|credit|debit|payment",
    "ssn": "ssn|social security|taxpayer",
    "phone_local": "phone|tel|call|mobile|fax|cell",
}
THRESHOLD = 0.5
CONTEXT = 40


def _score(text: Column, span: Column, kind: str) -> Column:
    """Prior plus 0.3 for a context word within 40 characters on either side, at most 1."""
    low = F.greatest(span["start"] - CONTEXT, F.lit(0))
    near = F.concat_ws(
        " ",
        F.substr(text, low + 1, span["start"] - low),
        F.substr(text, span["end"] + 1, F.lit(CONTEXT)),
    )
    word = near.rlike(rf"(?i)(?<![A-Za-z])(?:{_WORDS[kind]})(?![A-Za-z])")
    return F.least(F.lit(_PRIOR[kind]) + F.when(word, 0.3).otherwise(0.0), F.lit(1.0))


def findings(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add `pii`: array of (kind, start, end, value, score), ordered by kind as listed, then start.

    The kinds email, ip, card and phone follow the base rules and always stay.  The others (iban with mod-97,
    13 to 15 digit cards with Luhn, social security and national phone numbers) stay from a score of 0.5: a
    card or number without a word such as "card" or "phone" near it is dropped.  Columns of `docs` pass through;
    null text is empty and has no findings; repeated rows are judged alike; a column named `pii` is replaced.
    """
    keep = [c for c in docs.columns if c != "pii"]
    df = docs.select(
        F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)]).alias("_in"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"),
    )
    t = F.col("_text")
    empty = F.array().cast("array<string>")
    digit = t.rlike("[0-9]")
    df = once(
        df,
        _email=F.when(F.contains(t, F.lit("@")), S.found(t, EMAIL)).otherwise(empty),
        _ip=F.when(digit, S.found(t, IP)).otherwise(empty),
        _number=F.when(digit, S.found(t, NUMBER)).otherwise(empty),
        _phone=F.when(F.contains(t, F.lit("+")), S.found(t, PHONE)).otherwise(empty),
        _iban=F.when(t.rlike("[A-Z]{2}[0-9]{2}"), S.found(t, IBAN)).otherwise(empty),
        _ssn=F.when(digit, S.found(t, SSN)).otherwise(empty),
        _local=F.when(digit, S.found(t, LOCAL_PHONE)).otherwise(empty),
    )

    def some(pattern: str, column: str, kind: str, test) -> Column:
        """Places only where some match passes; the rest of the rows pay for a filter on short strings."""
        m = F.col(column)
        spans = F.filter(S.placed(t, pattern, m, kind), lambda s: test(s["value"]))
        return F.when(F.exists(m, test), spans).otherwise(S.none())

    count = lambda v: F.length(S.digits(v))
    checked = lambda low, high: lambda v: F.when(
        count(v).between(low, high), S.luhn(S.digits(v))
    ).otherwise(False)
    iban = lambda v: F.when(
        F.length(F.replace(v, F.lit(" "), F.lit(""))).between(15, 34), S.mod97(F.replace(v, F.lit(" "), F.lit("")))
    ).otherwise(False)
    df = once(
        df,
        _spans=F.array(
            some(EMAIL, "_email", "email", lambda v: F.lit(True)),
            some(IP, "_ip", "ip", lambda v: v.rlike(_VALID_IP)),
            some(NUMBER, "_number", "card", checked(16, 19)),
            some(PHONE, "_phone", "phone", lambda v: count(v).between(8, 15)),
            some(IBAN, "_iban", "iban", iban),
            some(NUMBER, "_number", "card_short", checked(13, 15)),
            some(SSN, "_ssn", "ssn", lambda v: F.lit(True)),
            some(LOCAL_PHONE, "_local", "phone_local", lambda v: F.lit(True)),
        ),
    )
    def scored(i: int, kind: str) -> Column:
        return F.transform(
            F.get(F.col("_spans"), i),
            lambda s: F.struct(*[s[c].alias(c) for c in ("kind", "start", "end", "value")], _score(t, s, kind).alias("score")),
        )

    n = len(BASE_KINDS)
    all_scored = [scored(i, kind) for i, kind in enumerate(KINDS)]
    base = F.concat(*all_scored[:n])
    inside = lambda s: F.exists(  # noqa: E731  part of a base span: a card's digits, say, are not a phone number too
        F.flatten(F.slice(F.col("_spans"), 1, n)),
        lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]),
    )
    added = F.filter(F.concat(*all_scored[n:]), lambda s: (s["score"] >= THRESHOLD) & ~inside(s))
    df = once(df.select("_in", "_text", "_spans"), pii=F.concat(base, added))
    return df.select(*[F.col("_in")[f"c{i}"].alias(c) for i, c in enumerate(keep)], "pii")


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """Replace what `findings` reports by [KIND]; of overlapping spans the first is replaced up to the last end.

    Columns stay as they are; `length`, where the table has it, is set anew for changed texts.  Null text
    stays null.
    """
    df = findings(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_text")), "_text")
    t = F.col("_text")
    ordered = F.array_sort(
        F.transform(F.col("pii"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    merged = F.aggregate(
        ordered,
        F.array().cast("array<struct<start:int,end:int,kind:string>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["end"] > s["start"]),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(
                    F.struct(
                        F.get(acc, F.size(acc) - 1)["start"].alias("start"),
                        F.greatest(F.get(acc, F.size(acc) - 1)["end"], s["end"]).alias("end"),
                        F.get(acc, F.size(acc) - 1)["kind"].alias("kind"),
                    )
                ),
            ),
        ).otherwise(F.concat(acc, F.array(s))),
    )
    has = F.size("pii") > 0
    df = once(df, _merged=F.when(has, merged))
    m = F.col("_merged")
    before = F.transform(
        m,
        lambda s, i: F.concat(
            F.substr(
                t,
                F.when(i > 0, F.get(m, i - 1)["end"]).otherwise(0) + 1,
                s["start"] - F.when(i > 0, F.get(m, i - 1)["end"]).otherwise(0),
            ),
            F.lit("["),
            F.upper(s["kind"]),
            F.lit("]"),
        ),
    )
    tail = F.substr(t, F.get(m, F.size(m) - 1)["end"] + 1, F.length(t))
    df = once(df, _clean=F.when(has, F.concat(F.array_join(before, ""), tail)).otherwise(t))
    made = {text: F.col("_clean")}
    if length and length in docs.columns:
        made[length] = F.when(has, F.length("_clean").cast(docs.schema[length].dataType)).otherwise(F.col("_row")[length])
    return df.select(*[made.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256 and all spans."""
    df = findings(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "pii")
    is_base = lambda s: s["kind"].isin(BASE_KINDS)
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")
    return df.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        S.digest(F.filter("pii", is_base)).alias("base_sha256"),
        S.listed(F.col("pii")).alias("spans"),
    )
