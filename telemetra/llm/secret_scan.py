"""Secret scan with corpus-wide ownership frequency (operator 10), DataFrame functions only.

Patterns find candidates in whole texts.  The candidates' hashes are counted
over the corpus by distinct repositories and distinct owners: a value that
many owners hold is a copied example, one that a single owner holds looks
live.  Besides the base kinds, long mixed tokens are candidates; those of a
single owner are added as kind ``owned``.

Places come from marking: every match is wrapped in a marker character, the
text is split at the marker, and a running sum over the lengths of the parts
gives the offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetra.llm.common import stored, text_of

#: Marks matches; a text's own marker characters become the other one, which no pattern matches.
MARK, OTHER = "\ue000", "\ue001"
VALUE = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Runs of one class: a run that is long enough is the base match of the same place.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
MIXED = "[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "owned")
PATTERNS = dict(zip(KINDS, (VALUE, ACCESS, HEX, MIXED)))
LEAST_VALUE = 6


def candidates(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str) -> DataFrame:
    """A row per document with the parts around the matches of each kind that has any."""
    text = F.col("text")

    def parts(kind):
        marked = F.split(F.regexp_replace(text, PATTERNS[kind], f"{MARK}$0{MARK}"), MARK)
        return F.struct(F.lit(kind).alias("kind"), F.transform(marked, lambda p, i: F.struct(
            F.length(p).cast("long").alias("n"), F.when(i % 2 == 1, p).alias("match"))).alias("parts"))

    return docs.select(
        F.col(id_col).alias("id"), F.col(owner_col).cast("string").alias("owner"),
        F.col(repo_col).cast("string").alias("repo"),
        F.replace(text_of(text_col), F.lit(MARK), F.lit(OTHER)).alias("text"),
    ).select(
        F.monotonically_increasing_id().alias("row"), "id", "owner", "repo",
        F.filter(F.array(*[parts(k) for k in KINDS]), lambda f: F.size(f["parts"]) > 1).alias("found"))


def located(found: DataFrame) -> DataFrame:
    """``row, owner, repo, kind, start, end, value`` of the candidates that qualify."""
    kinds = found.select("row", "owner", "repo", F.explode("found").alias("f")) \
        .select("row", "owner", "repo", "f.kind", F.posexplode("f.parts").alias("pos", "part"))
    before = Window.partitionBy("row", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    match = F.col("match")
    mixed = match.rlike("[0-9]") & match.rlike("[A-Z]") & match.rlike("[a-z]")
    return kinds.select(
        "row", "owner", "repo", "kind", "part.match", F.coalesce(F.sum("part.n").over(before), F.lit(0)).alias("start"),
        "part.n",
    ).filter(match.isNotNull()).select(
        "row", "owner", "repo", "kind", "start", (F.col("start") + F.col("n")).alias("end"),
        F.when(F.col("kind") == "assign", F.regexp_extract(match, VALUE, 2)).otherwise(match).alias("value"),
        mixed.alias("mixed"),
    ).filter(F.when(F.col("kind") == "assign", F.length("value") >= LEAST_VALUE)
             .when(F.col("kind") == "owned", F.col("mixed")).otherwise(True)).drop("mixed")


def ownership(spans: DataFrame) -> DataFrame:
    """``digest, n_repos, n_owners`` of each candidate value, counted over the corpus."""
    return spans.groupBy("digest", "owner", "repo").agg(F.lit(1).alias("one")) \
        .groupBy("digest", "owner").agg(F.sum("one").alias("repos")) \
        .groupBy("digest").agg(F.sum("repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                repo_col: str | None = None, example_owners: int = 3) -> DataFrame:
    """One row per input row: ``id_col, n_assign, n_access, n_hex, base_sha256, spans, n_examples, n_live``.

    ``repo_col`` is the unit that counts as a repository (default: the
    document).  A candidate is an example when ``example_owners`` owners or
    more hold its value and live when exactly one does.  A mixed token is
    added as ``owned`` when it is live and overlaps no base span.  Null and
    empty texts have no spans; a null owner is one owner.  Rows that repeat an
    id stay separate; an empty table gives an empty result; other columns are
    not read.
    """
    found = stored(candidates(docs, id_col, text_col, owner_col, repo_col or id_col), "secret-parts")
    spans = stored(located(found).withColumn("digest", F.sha2("value", 256)).drop("value"), "secret-spans")
    owners = stored(ownership(spans), "secret-owners")

    span = F.struct(F.col("start"), F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).alias("k"),
                    "kind", "end", (F.col("n_owners") == 1).alias("live"),
                    (F.col("n_owners") >= example_owners).alias("example"))
    per_doc = spans.join(owners, "digest").groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("all"))
    base = F.filter("all", lambda s: s["kind"] != "owned")
    with_base = per_doc.withColumn("base", base)
    kept = F.filter("all", lambda s: (s["kind"] != "owned") | (s["live"] & ~F.exists(
        F.col("base"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))))
    listed = with_base.select("row", "base", kept.alias("kept"))
    docs_out = found.select("row", "id").join(listed, "row", "left")

    def joined(spans_col):
        return F.array_join(F.transform(spans_col, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(where):
        return F.when(F.col("kept").isNull(), F.lit(0)).otherwise(F.size(F.filter("kept", where))).cast("long")

    def of_kind(kind):
        return lambda s: s["kind"] == kind

    return docs_out.select(
        F.col("id").alias(id_col), *[number(of_kind(k)).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(F.coalesce(joined(F.col("base")), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(joined(F.col("kept")), F.lit("")).alias("spans"),
        number(lambda s: s["example"]).alias("n_examples"), number(lambda s: s["live"]).alias("n_live"))
