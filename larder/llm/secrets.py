"""Secret scan: patterns find candidates in each text, the whole corpus tells copied examples from live ones.

A value that many owners or many repositories of one owner have is an example that was copied around; a
random-looking value of few looks live.  The scan is column expressions on the row.  What is shuffled are hashes of candidates, first as distinct
(hash, owner, repository), then as counts that tasks have summed before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.staging import once
from larder.llm import spans as S
from larder.llm.common import cut, table, with_row

ASSIGN = (
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)"""
)
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
# Kinds that have no base rule; each begins with a mark that its issuer gives it, or is a long mixed word.
ADDED = {
    "host_token": "(?<![A-Za-z0-9_])(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35})",
    "jwt": r"(?<![A-Za-z0-9_.-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    "private_key": "-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----",
    "mixed": "(?<![A-Za-z0-9+/_=.@-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9A-Z+/_-]*[a-z])(?=[0-9a-z+/_-]*[A-Z])"
    "[A-Za-z0-9+/_-]{24,}={0,2}(?![A-Za-z0-9+/_=.@-])",
}
BASE_KINDS = ["assign", "access", "hex"]
MAX_OWNERS = 2
MAX_REPOSITORIES = 10
MIN_ENTROPY = 2.5


def _value(kind: str, match: Column) -> Column:
    """What is secret in a match: of an assignment the right side, without key word and sign."""
    return F.regexp_extract(match, ASSIGN, 1) if kind == "assign" else match


def _entropy(value: Column) -> Column:
    """Bits per character."""
    chars = F.filter(F.split(value, ""), lambda c: c != "")
    n = F.length(value)
    return F.aggregate(
        F.array_distinct(chars),
        F.lit(0.0),
        lambda a, c: S.let(
            F.size(F.filter(chars, lambda x: x == c)) / n, lambda p: a - p * F.log2(p)
        ),
    )


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add `found`: array of (kind, start, end, hash, entropy) of base and added kinds, ordered by start, then kind.

    Narrow.  Null text is empty; all other columns pass through (one named `found` is replaced).
    """
    keep = [c for c in docs.columns if c != "found"]
    df = docs.select(
        F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)]).alias("_in"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"),
    )
    t = F.col("_text")
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX} | ADDED
    empty = F.array().cast("array<string>")
    gates = {"assign": t.rlike("[:=]"), "access": F.contains(t, F.lit("AKIA"))}
    df = once(
        df,
        **{f"_{k}": F.when(gates.get(k, F.lit(True)), S.found(t, p)).otherwise(empty) for k, p in patterns.items()},
    )
    spans = []
    for kind, pattern in patterns.items():
        made = S.placed(t, pattern, F.col(f"_{kind}"), kind)
        spans.append(F.filter(made, lambda s: F.length(_value("assign", s["value"])) >= 8) if kind == "assign" else made)
    df = once(df, _base=F.concat(*spans[: len(BASE_KINDS)]), _more=F.concat(*spans[len(BASE_KINDS) :]))
    apart = F.filter(
        "_more", lambda s: ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    )
    rank = F.create_map(*[x for i, k in enumerate(patterns) for x in (F.lit(k), F.lit(i))])
    ordered = F.array_sort(
        F.transform(
            F.concat("_base", apart),
            lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value")),
        )
    )
    secret = lambda s: F.when(s["kind"] == "assign", _value("assign", s["value"])).otherwise(s["value"])
    found = F.transform(
        ordered,
        lambda s: S.let(
            secret(s),
            lambda v: F.struct(
                s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                F.sha2(v, 256).alias("hash"), _entropy(v).alias("entropy"),
            ),
        ),
    )
    df = once(df, found=F.when(F.size(F.col("_base")) + F.size(F.col("_more")) > 0, found).otherwise(F.array().cast(
        "array<struct<kind:string,start:int,end:int,hash:string,entropy:double>>")))
    return df.select(*[F.col("_in")[f"c{i}"].alias(c) for i, c in enumerate(keep)], "found")


def ownership(hashes: DataFrame) -> DataFrame:
    """(hash, owner, repository) rows -> hash, owners, repositories, occurrences.

    Null owners or repositories count as one unknown owner or repository.  A hash in a third of all rows is
    spread by owner and repository first; after that each task sends one row per hash and owner, then per hash.
    """
    once_each = hashes.groupBy("hash", "owner", "repository").agg(F.count(F.lit(1)).alias("occurrences"))
    per_owner = once_each.groupBy("hash", "owner").agg(
        F.count(F.lit(1)).alias("repositories"), F.sum("occurrences").alias("occurrences")
    )
    return per_owner.groupBy("hash").agg(
        F.count(F.lit(1)).alias("owners"),
        F.sum("repositories").alias("repositories"),
        F.sum("occurrences").alias("occurrences"),
    )


def secrets(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "doc_id"
) -> DataFrame:
    """One row per document: the id, and `found` with the verdict of each candidate.

    `found` has (kind, start, end, hash, entropy, owners, repositories, live).  A value is live when at most two
    owners and ten repositories have it and its characters carry 2.5 bits or more.  Base kinds stay whatever the verdict; added kinds
    stay only when live.  Null ids stay null; repeated rows give repeated results; an empty table gives none.
    Repositories are counted within their owner.
    """
    scanned = candidates(
        docs.select(
            F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"),
            F.col(f"`{owner}`").cast("string").alias("owner"), F.col(f"`{repository}`").cast("string").alias("repository"),
        )
    ).drop("text")
    scanned = cut(with_row(scanned), "secret-candidates")
    each = scanned.select("_row", "owner", "repository", F.posexplode("found").alias("pos", "s"))
    stats = cut(ownership(each.select(F.col("s.hash").alias("hash"), "owner", "repository")), "secret-owners")
    # both sides are plain scans, so that a hash with very many rows can be split between tasks
    judged = each.select("_row", "pos", "s", F.col("s.hash").alias("hash")).join(stats, "hash", "left")
    few = (F.col("owners") <= MAX_OWNERS) & (F.col("repositories") <= MAX_REPOSITORIES)
    live = few & (F.col("s.entropy") >= MIN_ENTROPY)
    per_row = (
        judged.where(live | F.col("s.kind").isin(BASE_KINDS))
        .groupBy("_row")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        "pos", "s.kind", "s.start", "s.end", "s.hash", "s.entropy", "owners", "repositories", live.alias("live")
                    )
                )
            ).alias("judged")
        )
    )
    made = scanned.select("_row", "doc_id").join(per_row, "_row", "left")
    found = F.transform("judged", lambda s: s.dropFields("pos"))
    return made.select("doc_id", F.coalesce(found, F.array().cast(
        "array<struct<kind:string,start:int,end:int,hash:string,entropy:double,owners:bigint,repositories:bigint,live:boolean>>"
    )).alias("found"))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, all spans, and how many candidates are live or copied."""
    df = secrets(table(spark, sf_dir, "documents"))
    count = lambda test: F.size(F.filter("found", test)).cast("long")
    return df.select(
        "doc_id",
        *[count(_is(kind)).alias(f"n_{kind}") for kind in BASE_KINDS],
        S.digest(F.filter("found", lambda s: s["kind"].isin(BASE_KINDS))).alias("base_sha256"),
        S.listed(F.col("found")).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"),
        count(lambda s: ~s["live"]).alias("n_copied"),
    )


def _is(kind: str):
    return lambda s: s["kind"] == kind
