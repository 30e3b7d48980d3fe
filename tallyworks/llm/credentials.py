r"""Secret scan: spans of credentials, told apart from widely copied examples by who owns them.

Base spans of three kinds are always reported. Further candidates (tokens of known shape, long random strings)
are hashed and counted over the whole corpus by distinct repositories and owners: one that many owners have
is a copied example; one that stays within ``most_owners`` and ``most_repositories`` looks live and
adds a span of kind ``owned``.

DataFrame operations only; values leave the texts as SHA-256 digests. Counting goes from (digest, owner,
repository) to (digest, owner) to digest, pre-aggregated at each step, so a document that a third of all rows
copy is one entry per task before it is shuffled. Positions are sums of lengths of what a split leaves between
matches and of the matches, in two levels, so texts with very many matches stay cheap.

Defined cases: null texts are empty; null owners and repositories count as one; repeated rows are
reported each; an empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import saved


class Kind(NamedTuple):
    name: str
    pattern: str
    least: int  # characters of the group
    group: int


BASE = (
    Kind("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Kind("access", r"AKIA[A-Z0-9]+", 16, 0),
    Kind("hex", r"[0-9a-f]{32,}", 32, 0),
)
_SHAPES = (
    r"gh[pousr]_[A-Za-z0-9]{20,}",
    r"sk-[A-Za-z0-9]{20,}",
    r"xox[abprs]-[A-Za-z0-9-]{10,}",
    r"glpat-[A-Za-z0-9_-]{16,}",
    r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----",
    r"[A-Za-z0-9+/_-]{24,}",
)
OTHER = Kind("owned", "|".join(_SHAPES), 1, 0)
MOST_OWNERS = 1
MOST_REPOSITORIES = 3
_CHUNK = 256


def _scan(values: Column) -> Column:
    """Running sums of a short array."""
    start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("all"))

    def add(so_far: Column, x: Column) -> Column:
        total = so_far["sum"] + x
        return F.struct(total.alias("sum"), F.concat(so_far["all"], F.array(total)).alias("all"))

    return F.aggregate(values, start, add, lambda s: s["all"])


def running_sums(values: Column) -> Column:
    """Running sums of an array of any length: within chunks, then of the chunks."""
    first = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(_CHUNK))
    inner = F.transform(first, lambda a: _scan(F.slice(values, a, F.lit(_CHUNK))))
    before = _scan(F.concat(F.array(F.lit(0)), F.transform(inner, lambda x: F.coalesce(F.try_element_at(x, F.lit(-1)), F.lit(0)))))
    return F.flatten(F.zip_with(inner, F.slice(before, F.lit(1), F.size(inner)), lambda x, b: F.transform(x, lambda v: v + b)))


def matches(text: Column, kind: Kind, rank: int) -> Column:
    """Structs (start, rank, kind, end, value) of the leftmost matches that are long enough, in code points."""
    whole = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group)) if kind.group else whole
    steps = F.zip_with(F.slice(F.split(text, kind.pattern, -1), F.lit(1), F.size(whole)), whole, lambda a, b: F.char_length(a) + F.char_length(b))
    rows = F.arrays_zip(whole.alias("whole"), part.alias("part"), running_sums(steps).alias("end"))
    kept = F.filter(rows, lambda x: F.char_length(x["part"]) >= kind.least)
    found = F.transform(
        kept,
        lambda x: F.struct(
            (x["end"] - F.char_length(x["whole"])).alias("start"),
            F.lit(rank).alias("rank"),
            F.lit(kind.name).alias("kind"),
            x["end"].alias("end"),
            x["part"].alias("value"),
        ),
    )
    empty = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,value:string>>")
    return F.when(text.rlike(kind.pattern), found).otherwise(empty)


def _looks_random(value: Column) -> Column:
    """A known shape, or capitals, small letters and digits together."""
    shaped = value.rlike(f"^(?:{'|'.join(_SHAPES[:-1])})")
    return shaped | (value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(
    docs: DataFrame,
    owner: Column,
    repository: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_owners: int = MOST_OWNERS,
    most_repositories: int = MOST_REPOSITORIES,
) -> DataFrame:
    """(id, base, owned, n_live, n_copied): base and added spans as structs (start, rank, kind, end), sorted;
    how many of all candidates look live or are copied examples."""
    text = F.col("_text")
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_col).alias("_id"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("_owner"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("_repository"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    )
    base = F.array_sort(F.concat(*(matches(text, kind, k) for k, kind in enumerate(BASE))))
    other = F.filter(matches(text, OTHER, len(BASE)), lambda s: _looks_random(s["value"]))
    hidden = lambda s: F.struct(s["start"], s["rank"], s["kind"], s["end"], F.sha2(s["value"].cast("binary"), 256).alias("digest"))
    found = rows.select("_row", "_id", "_owner", "_repository", F.transform(base, hidden).alias("base"), F.transform(other, hidden).alias("other"))
    found = saved(found, "candidates")

    each = found.where("size(base) + size(other) > 0").select("_row", "_owner", "_repository", F.explode(F.concat("base", "other")).alias("span"))
    each = each.withColumn("digest", F.col("span.digest"))
    known = (
        each.groupBy("digest", "_owner", "_repository").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("digest", "_owner").agg(F.count(F.lit(1)).alias("repositories"))
        .groupBy("digest").agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"))
        .select("digest", ((F.col("owners") <= most_owners) & (F.col("repositories") <= most_repositories)).alias("live"))
    )
    added = F.col("live") & (F.col("span.rank") == len(BASE))
    span = F.struct("span.start", "span.rank", "span.kind", "span.end")
    judged = each.join(known, "digest").groupBy("_row").agg(
        F.array_sort(F.collect_list(F.when(added, span))).alias("owned"),
        F.count(F.when(F.col("live"), True)).alias("n_live"),
        F.count(F.when(~F.col("live"), True)).alias("n_copied"),
    )
    empty = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
    return found.join(judged, "_row", "left").select(
        F.col("_id").alias(id_col),
        F.transform("base", lambda s: F.struct(s["start"], s["rank"], s["kind"], s["end"])).alias("base"),
        F.coalesce("owned", empty).alias("owned"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_copied", F.lit(0)).alias("n_copied"),
    )


def spans_text(*spans: Column) -> Column:
    """kind:start:end of all spans by start, then kind as listed, joined by commas."""
    return _joined(F.array_sort(F.concat(*spans)))
