r"""Secret scans: pattern candidates with their places, then corpus-wide ownership frequency of each candidate.

Base spans, leftmost and non-overlapping per kind: ``assign`` (a keyword, ``:`` or ``=``, a value of 6 characters or more),
``access`` (AKIA keys of 20 or more) and ``hex`` (24 or more digits). Each candidate value is hashed; distinct repositories
and owners per hash tell widely copied examples from owner-specific values. A value that at most ``max_owners`` owners hold and that looks generated adds a ``live`` span over the value
itself. Repositories are counted and returned beside the owners but decide nothing alone: an owner's secret stays live in however many
of the owner's repositories it stands, and however large the corpus grows. Looking generated means letters and digits, at least
eight different characters (all but one, in a shorter value), and no placeholder as a token of its own or ahead. Base spans always stay.

Plan (SQL functions only): split and regexp_extract_all give gaps and matches of one scan; texts without a match never build
arrays, and no text is shuffled. Lengths become rows of one narrow written table, a running sum per document and kind turns
them into offsets, and the ownership counts are distinct aggregations with partial sums. The counts are written before
they are joined back, so a value that a third of all rows hold is split by AQE's skew join.

Edge cases: a null text is empty; null ids are kept apart by row; a null owner or repository counts as one unnamed owner or
repository; repeated rows are separate rows of the result, counted once as repository; an empty table gives an empty table; extra columns
are ignored. Offsets are code points, the end exclusive. A text of any length is scanned whole (its matches are one array in its own row);
ties cannot arise, as matches of a kind do not overlap and spans that start together stand in the order of their kinds.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from marquee.llm.common import text_of
from marquee.session import materialize

#: Fixed values of the contract: kinds in order with pattern, value group and least length of that group.
KEYWORDS = "password|passwd|secret|token|api_?key"
ASSIGN = (r"(" + "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in KEYWORDS) + r")"
          r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
# a maximal run is kept whole or not at all, so the least length can stand in the pattern of these two
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = (("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24))
PLACEHOLDERS = (r"(^|[^a-z0-9])(example|placeholder|changeme|change_me|dummy|sample|your|x{4,}|0{4,}|1234[0-9]*)([^a-z0-9]|$)",
                r"^(example|placeholder|changeme|dummy|sample)")
VARIETY = 8


def _matches(text: Column, order: int, pattern: str, group: int) -> Column:
    """array<struct(kind, gap, len, value)>: code points before each match since the last one, and the match."""
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                          F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
                          F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))
    found = F.transform(zipped, lambda x: F.struct(F.lit(order).alias("kind"), F.length(x["gap"]).alias("gap"),
                                                   F.length(x["hit"]).alias("len"), x["value"].alias("value")))
    none = F.array().cast("array<struct<kind:int,gap:int,len:int,value:string>>")
    # the piece after the last match has no match of its own
    return F.when(F.regexp_like(text, F.lit(pattern)), F.filter(found, lambda x: x["len"].isNotNull())).otherwise(none)


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                 repo_col: str = "doc_id", max_owners: int = 1) -> tuple[DataFrame, DataFrame]:
    """(documents: uid, id; spans: uid, kind, start, end, base, n_owners, n_repos, live)."""
    owner = F.coalesce(F.col(owner_col).cast("string"), F.lit(""))
    repo = F.coalesce(F.col(repo_col).cast("string"), F.lit(""))
    found = F.concat(*[_matches(F.col("t"), i, pattern, group) for i, (_, pattern, group, _) in enumerate(KINDS)])
    base = docs.select(F.col(id_col).alias("id"), owner.alias("owner"), repo.alias("repo"), text_of(text_col).alias("t"))
    base = base.select(F.monotonically_increasing_id().alias("uid"), "id", "owner", "repo", found.alias("found"))
    # hashes only from here on: no written table holds a candidate value
    base = materialize(base.withColumn("found", F.transform("found", lambda x: F.struct(
        x["kind"].alias("kind"), x["gap"].alias("gap"), x["len"].alias("len"), F.length(x["value"]).alias("vlen"),
        F.sha2(x["value"], 256).alias("vhash"), _generated(x["value"]).alias("generated")))), "secret-candidates")
    rows = base.where(F.size("found") > 0).select("uid", "owner", "repo", F.posexplode("found").alias("nth", "c"))
    rows = rows.select("uid", "owner", "repo", "nth", "c.*")
    running = W.partitionBy("uid", "kind").orderBy("nth").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("len")).over(running))
    least = F.get(F.array(*[F.lit(m) for *_, m in KINDS]), F.col("kind"))
    rows = rows.where(F.col("vlen") >= least).withColumn("start", F.col("end") - F.col("len"))
    rows = materialize(rows.select("uid", "owner", "repo", "kind", "start", "end", "vlen", "vhash", "generated"), "secret-spans")
    owned = rows.select("vhash", "owner", "repo").distinct()
    owned = owned.groupBy("vhash").agg(F.countDistinct("owner").alias("n_owners"), F.countDistinct("repo").alias("n_repos"))
    rows = rows.join(materialize(owned, "secret-owners"), "vhash")
    live = F.col("generated") & (F.col("n_owners") <= max_owners)
    return base.select("uid", "id"), rows.withColumn("live", live)


def _generated(value: Column) -> Column:
    """Letters and digits, varied characters, no placeholder; values are ASCII by their patterns."""
    variety = F.size(F.array_distinct(F.regexp_extract_all(value, F.lit("."), F.lit(0))))
    placeholder = [F.regexp_like(F.lower(value), F.lit(p)) for p in PLACEHOLDERS]
    return (F.regexp_like(value, F.lit("[0-9]")) & F.regexp_like(value, F.lit("[A-Za-z]"))
            & (variety >= F.least(F.lit(VARIETY), F.length(value) - 1)) & ~placeholder[0] & ~placeholder[1])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                 repo_col: str = "doc_id") -> DataFrame:
    """Per row of docs: id, base and spans as sorted ``kind:start:end`` lists, and counts per kind."""
    base, rows = secret_spans(docs, id_col, text_col, owner_col, repo_col)
    names = F.array(*[F.lit(k) for k, *_ in KINDS], F.lit("live"))
    base_span = F.struct(F.col("start").alias("start"), F.col("kind").alias("kind"), F.col("end").alias("end"))
    live_span = F.struct((F.col("end") - F.col("vlen")).alias("start"), F.lit(len(KINDS)).alias("kind"), F.col("end").alias("end"))
    per_doc = rows.groupBy("uid").agg(
        *[F.count(F.when(F.col("kind") == i, 1)).alias(f"n_{k}") for i, (k, *_) in enumerate(KINDS)],
        F.collect_list(base_span).alias("base"), F.collect_set(F.when(F.col("live"), live_span)).alias("live"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    per_doc = per_doc.select("uid", *[f"n_{k}" for k, *_ in KINDS], F.size("live").cast("long").alias("n_live"),
                             joined(F.col("base")).alias("base"), joined(F.concat("base", "live")).alias("spans"))
    out = base.join(per_doc, "uid", "left")
    return out.select(F.col("id").alias(id_col), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_assign", "n_access", "n_hex", "n_live")],
                      F.coalesce("base", F.lit("")).alias("base"), F.coalesce("spans", F.lit("")).alias("spans"))
