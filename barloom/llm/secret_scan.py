"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Three base patterns (assignments, access keys, long hexadecimal runs) give spans that always stay. A fourth, wider one gives
candidates: runs of 20 or more key characters that hold digits, upper and lower case, or are long keys of digits and letters of one
case. A candidate's value is that of the assignment it lies in or over, otherwise the run without a leading ``name=``. Every value is hashed, and the
hashes are counted over the whole corpus by distinct repositories and distinct owners. A value that many owners hold, or that
stands in many repositories, is a copied example; one with few of both is a live-looking credential, and such candidates become
spans of kind ``live``. Counting combines on the map side, first by (value, owner, repository), so a value in a third of all rows is one
row per task.

Spark's functions give matches but not their places; a place is the sum of the lengths of the pieces between
matches and of the matches before it. Places count code points; ends are exclusive.

A null text is empty and has no spans. A null owner or repository counts as one of its own. Repeated rows get the same
result each. Spans of a document are ordered by start, then kind. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import cut

# The base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: Candidates for the ownership count.
WIDE = r"[A-Za-z0-9+/_=-]{20,}"
#: A name before a candidate's value, and long values of one case.
NAME = r"^[A-Za-z0-9_-]+=(?=[^=])"
ONE_CASE = r"^(?=.*[0-9])(?=.*[A-Za-z])(?:[a-z0-9_]{32,}|[A-Z0-9_]{32,})=*$"
KINDS = ("assign", "access", "hex", "live")


def _spans(kind: str, pattern: str, group: int = 0, least: int = 1) -> Column:
    """Array of (start, rank, kind, end, value) of the leftmost non-overlapping matches; short values are dropped."""
    text, p = F.col("text"), F.lit(pattern)
    whole = F.regexp_extract_all(text, p, F.lit(0))
    value = F.regexp_extract_all(text, p, F.lit(group)) if group else whole
    pieces = F.split(text, pattern, -1)
    # Lengths up to each match: one pass, as a running sum.
    zipped = F.arrays_zip(pieces.alias("piece"), whole.alias("whole"), value.alias("value"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,value:string>>").alias("out"))

    def add(state: Column, x: Column) -> Column:
        a = state["at"] + F.length(x["piece"])
        b = a + F.length(x["whole"])
        one = F.struct(
            a.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), b.alias("end"), x["value"].alias("value")
        )
        known = x["whole"].isNotNull()
        keep = known & (F.length(x["value"]) >= least)
        return F.struct(
            F.when(known, b).otherwise(a).alias("at"),
            F.when(keep, F.concat(state["out"], F.array(one))).otherwise(state["out"]).alias("out"),
        )

    return F.aggregate(zipped, start, add, lambda s: s["out"])


def _own_value(span: Column) -> Column:
    """The value of a candidate without the name of its key."""
    over = F.filter(F.col("assign"), lambda a: (a["start"] < span["end"]) & (span["start"] < a["end"]))
    return F.coalesce(F.get(over, F.lit(0))["value"], F.regexp_replace(span["value"], F.lit(NAME), F.lit("")))


def _if(found: Column, spans: Column) -> Column:
    """Only texts in which a cheap search finds something are taken apart."""
    return F.when(found, spans).otherwise(
        F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,value:string>>")
    )


def _shown(spans: Column, *more: str) -> Column:
    """kind:start:end, and what else is asked for, by start and kind, comma-joined."""
    return F.concat_ws(
        ",",
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", s["kind"], *(s[n].cast("string") for n in ("start", "end", *more))),
        ),
    )


def scan_secrets(
    docs: DataFrame,
    owner: Column,
    repository: Column,
    most_owners: int = 2,
    most_repositories: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied, held) of each row.

    ``n_live`` counts candidates that at most ``most_owners`` owners hold in at most ``most_repositories`` repositories,
    ``n_copied`` base spans whose value goes beyond either. ``held`` has kind:start:end:owners:repositories of every base span
    and candidate; candidates that are not live are of kind ``example``.
    """
    source = docs.select(
        F.col(id_column).alias("id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"),
    )
    text = F.col("text")
    mixed = lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]")
    looks_live = lambda s: mixed(s) | _own_value(s).rlike(ONE_CASE)
    valued = lambda s: F.struct(*(s[n].alias(n) for n in ("start", "rank", "kind", "end")), _own_value(s).alias("value"))
    found = source.select(
        "id",
        "owner",
        "repository",
        F.md5("text").alias("key"),
        _if(text.rlike(ASSIGN), _spans("assign", ASSIGN, 2, 8)).alias("assign"),
        _if(text.contains("AKIA"), _spans("access", ACCESS)).alias("access"),
        _if(text.rlike(HEX), _spans("hex", HEX)).alias("hex"),
        _if(text.rlike(WIDE), _spans("live", WIDE)).alias("wide"),
    )
    found = found.withColumn("wide", F.transform(F.filter("wide", looks_live), valued))
    found = cut(
        found.select(
            "id", "owner", "repository", "key", F.concat("assign", "access", "hex").alias("base"), "wide",
            F.size("assign").alias("n_assign"), F.size("access").alias("n_access"), F.size("hex").alias("n_hex"),
        )
    )
    values = found.where((F.size("base") > 0) | (F.size("wide") > 0)).select(
        "id", "key", "owner", "repository", F.explode(F.concat("base", "wide")).alias("span")
    )
    values = values.withColumn("hash", F.sha2(F.col("span.value"), 256))
    frequency = (
        values.groupBy("hash", "owner", "repository")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("hash")
        .agg(F.count_distinct("owner").alias("owners"), F.count(F.lit(1)).alias("repositories"))
    )
    few = (F.col("owners") <= most_owners) & (F.col("repositories") <= most_repositories)
    kind = F.when(F.col("copied") & (F.col("span.kind") == "live"), "example").otherwise(F.col("span.kind"))
    judged = (
        values.select("id", "key", "span", "hash")
        .distinct()
        .join(frequency, "hash")
        .withColumn("live", (F.col("span.kind") == "live") & few)
        .withColumn("copied", ~few)
        .groupBy("id", "key")
        .agg(
            F.collect_list(F.when(F.col("live"), F.col("span"))).alias("added"),
            F.count_if("live").alias("n_live"),
            F.count_if(F.col("copied") & (F.col("span.kind") != "live")).alias("n_copied"),
            F.collect_list(F.struct("span.start", "span.rank", kind.alias("kind"), "span.end", "owners", "repositories")).alias("held"),
        )
    )
    # Most documents have no span, so the join's right side is small; ids that are null must meet too.
    joined = found.alias("f").join(
        judged.alias("j"), (F.col("f.key") == F.col("j.key")) & F.col("f.id").eqNullSafe(F.col("j.id")), "left"
    )
    every = F.concat(F.col("base"), F.coalesce("added", F.filter("base", lambda _: F.lit(False))))
    return joined.select(
        F.col("f.id").alias(id_column),
        F.col("n_assign").cast("long").alias("n_assign"),
        F.col("n_access").cast("long").alias("n_access"),
        F.col("n_hex").cast("long").alias("n_hex"),
        F.sha2(_shown(F.col("base")), 256).alias("base_sha256"),
        _shown(every).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_copied", F.lit(0)).alias("n_copied"),
        F.coalesce(_shown(F.col("held"), "owners", "repositories"), F.lit("")).alias("held"),
    )
