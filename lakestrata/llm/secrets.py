"""Secret scans with corpus-wide ownership frequency, all in native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.llm.common import stored

ASSIGN = r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
#: kind, pattern of a match, pattern of what precedes the value in it, least length of the value; in the order that breaks ties of position.
#: Matches of the last two are maximal runs, so a least length inside the pattern finds the same ones.
KINDS = (
    ("assign", ASSIGN, 12),
    ("access", r"AKIA[A-Z0-9]{14,}", 18),
    ("hex", r"[0-9a-f]{16,}", 16),
)
SEEN = 12
#: Whole runs of ``SEEN`` characters or more with a digit in them; they count if they are a secret's value elsewhere. A run
#: is entered at its first character only, so each character is looked at a few times whatever the runs are like.
BARE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_=-]{%d})[A-Za-z+/_=-]*+[0-9][A-Za-z0-9+/_=-]*+" % SEEN
_BLOCK = 256  # matches whose places are added up one by one
_SPAN = "array<struct<start:int,rank:int,stop:int,value:string>>"
_LEAD = ASSIGN[: ASSIGN.rindex("([A-Za-z0-9")]  # what stands before the value of an assignment


def _may_hold(kind: str) -> Column:
    """A cheap test, never false for a text that holds the kind."""
    text = F.col("text")
    if kind == "access":
        return F.contains(text, F.lit("AKIA"))
    if kind == "hex":
        return text.rlike("[0-9a-f]{16}")
    low, test = F.lower(text), F.lit(False)
    for part in ("passw", "secret", "token", "apikey", "api_key"):
        test = test | F.contains(low, F.lit(part))
    return test


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches, each with how many characters lie between it and the one before.

    What lies between the matches is as long as the pieces of the text split there, so
    positions follow from lengths alone.
    """
    found = F.zip_with(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1),
        lambda m, piece: F.struct(m.alias("m"), F.length(piece).alias("gap")),
    )
    return F.filter(found, lambda x: x["m"].isNotNull())


def spans(found: Column, rank: int, least: int, lead: str | None = None) -> Column:
    """:func:`matches`, held in a column, whose value has ``least`` characters: start, end (exclusive, in code points), value.

    Places are added up in blocks of ``_BLOCK`` matches and inside them, so the work follows
    the number of matches. ``lead`` is the part of a match before its value.
    """
    value = lambda m: F.regexp_replace(m, "^" + lead, "") if lead else m
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / _BLOCK).cast("int")), lambda k: F.slice(found, k * _BLOCK + 1, F.lit(_BLOCK)))
    ends = F.aggregate(
        F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda n, x: n + x["gap"] + F.length(x["m"]))),
        F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)),
    )
    walked = F.zip_with(blocks, ends, lambda block, begin: F.aggregate(
        block, F.struct(begin.alias("at"), F.array().cast(_SPAN).alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + F.length(x["m"])).alias("at"),
            F.concat(
                acc["out"],
                F.array(F.struct((acc["at"] + x["gap"]).alias("start"), F.lit(rank).alias("rank"), (acc["at"] + x["gap"] + F.length(x["m"])).alias("stop"), value(x["m"]).alias("value"))),
            ).alias("out"),
        ),
    )["out"])
    # the last entry of ``ends`` begins no block
    whole = F.flatten(F.filter(walked, lambda out: out.isNotNull()))
    return F.when(F.size(found) > 0, F.filter(whole, lambda s: F.length(s["value"]) >= least)).otherwise(F.array().cast(_SPAN))


def _joined(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*(F.lit(k) for k, _, _ in KINDS), F.lit("seen"))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _count(rank: int) -> Column:
    return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("bigint")


def ownership(found: DataFrame, copied_owners: int) -> DataFrame:
    """``(value, n_repos, n_owners, verdict)`` from ``(value, repo, owner)``: distinct pairs first, then counts, both combined map-side."""
    repos = found.select("value", "repo").distinct().groupBy("value").agg(F.count(F.lit(1)).alias("n_repos"))
    owners = found.select("value", "owner").distinct().groupBy("value").agg(F.count(F.lit(1)).alias("n_owners"))
    verdict = F.when(F.col("n_owners") >= copied_owners, "example").when(F.col("n_owners") == 1, "live").otherwise("shared")
    return repos.join(owners, "value").withColumn("verdict", verdict)


def scan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repo: Column | None = None, owner: Column | None = None, copied_owners: int = 3,
) -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, n_shared, most_repos``.

    Base spans are those of ``KINDS``, told per kind. The method adds spans of kind ``seen``:
    a bare run of ``SEEN`` characters or more with a digit, apart from all base spans, whose
    value is a base secret somewhere in the corpus. Every value is hashed; over all its
    spans of both sorts, a hash has so many distinct repositories (``repo``, by default the
    document) and owners (``owner``, by default the column ``source``). A value of
    ``copied_owners`` owners or more is a widely copied example, however it was pasted, one
    of a single owner looks live, others are shared; ``n_live``, ``n_example`` and
    ``n_shared`` count a document's base spans by that, ``most_repos`` tells of how many
    repositories its most copied base value is (0 without one). ``spans`` lists all by
    start, then kind.

    Cost: one pass over the texts without a shuffle; then only hashes of candidates move.
    A value that a third of the documents hold collapses to distinct pairs map-side before
    it is counted, and AQE splits its key in the join. Null texts are empty; null owners
    and repositories count as one; repeated rows each keep a row; other columns are ignored.
    """
    repo = F.col(doc_id).cast("string") if repo is None else repo
    owner = F.col("source") if owner is None else owner
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(repo, F.lit("")).alias("repo"), F.coalesce(owner, F.lit("")).alias("owner"),
    )
    none = F.array().cast("array<struct<m:string,gap:int>>")
    found = [
        F.when(_may_hold(kind), matches(F.col("text"), pattern)).otherwise(none).alias(f"m{rank}") for rank, (kind, pattern, _) in enumerate(KINDS)
    ]
    found.append(F.when(F.col("text").rlike("[0-9]"), matches(F.col("text"), BARE)).otherwise(none).alias(f"m{len(KINDS)}"))
    base = [spans(F.col(f"m{rank}"), rank, least, _LEAD if kind == "assign" else None) for rank, (kind, _, least) in enumerate(KINDS)]
    bare = spans(F.col(f"m{len(KINDS)}"), len(KINDS), SEEN)
    hashed = lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["stop"].alias("stop"), F.xxhash64(s["value"]).alias("value"))
    apart = lambda s: ~F.exists("base", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"]))
    rows = stored(
        rows.select("doc_id", F.xxhash64("text").alias("same"), "repo", "owner", *found)
        .select("doc_id", "same", "repo", "owner", F.array_sort(F.transform(F.concat(*base), hashed)).alias("base"), F.transform(bare, hashed).alias("bare"))
        .select("doc_id", "same", "repo", "owner", "base", F.when(F.size("base") > 0, F.filter("bare", apart)).otherwise(F.col("bare")).alias("bare"))
    )
    secret = rows.select(F.explode("base.value").alias("value")).distinct()
    each = rows.select("doc_id", "same", "repo", "owner", F.explode(F.concat("base", "bare")).alias("s")).select("doc_id", "same", "repo", "owner", "s.*")
    each = stored(each.join(secret, "value", "left_semi"))
    values = ownership(each.select("value", "repo", "owner"), copied_owners)
    judged = each.drop("repo", "owner").distinct().join(values, "value")
    of = lambda verdict: F.count_if((F.col("rank") < len(KINDS)) & (F.col("verdict") == verdict))
    detail = judged.groupBy("doc_id", "same").agg(
        F.array_sort(F.collect_list(F.struct("start", "rank", "stop"))).alias("all"),
        of("live").alias("n_live"), of("example").alias("n_example"), of("shared").alias("n_shared"),
        F.max(F.when(F.col("rank") < len(KINDS), F.col("n_repos"))).alias("most_repos"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return (
        rows.alias("r").join(detail.alias("d"), F.expr("r.doc_id <=> d.doc_id and r.same = d.same"), "left")
        .select(
            "r.doc_id", *(_count(k).alias(f"n_{kind}") for k, (kind, _, _) in enumerate(KINDS)),
            F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), F.coalesce(_joined(F.col("all")), F.lit("")).alias("spans"),
            zero("n_live"), zero("n_example"), zero("n_shared"), zero("most_repos"),
        )
    )
