"""Secrets in texts, single ones and credentials in several parts (DataFrame functions only).

*Base findings*, leftmost and without overlap for each kind: assignments to secret-like names, access
identifiers, long hexadecimal runs. Each counts by itself.

*Weak candidates* count only together. An access identifier, a secret and an endpoint make a credential;
a bare word that could be a key, an account name or a host is no finding. Each part becomes an interval of its
text; intervals are joined within a scope: parts whose distance is at most ``REACH`` code points. A weak
candidate is reported if its scope holds a complementary part:

==========  ==================================================  ============================================
weak kind   what it is                                          reported next to
==========  ==================================================  ============================================
key         32 characters or more of base64 alphabet with a      an access identifier or account, weak or
            digit, a capital and a small letter, not in the      not; an assigned secret does not need it
            path of a URL
account     value assigned to user, login, client id and such    an assigned secret, a long hex run or a key
endpoint    URL or assigned host                                 an access identifier or account *and* a
                                                                 secret of any kind (all three parts)
==========  ==================================================  ============================================

A complement never overlaps the part that asks: the same characters are not two parts of a credential. So it ends where
the part starts or before, or starts where the part ends or after, at most ``REACH`` code points away. Its end or start is
then in the part's own bucket of ``REACH`` code points or the next one, and the interval join is by text, bucket, role and
side. A bucket's starts (or ends) of a role are one sorted set, of at most ``REACH`` numbers, so nothing multiplies,
however dense or long the parts are. Texts that are equal are linked once. Only texts with a weak candidate and a
complement anywhere are exploded.

Null and empty texts have no findings. Rows that repeat, ids included, are reported each. Parts of one kind never overlap;
of parts of several kinds each is reported. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.llm.shared import stored, whole

# Fixed by the contract: pattern, group measured, least length. In the order of kinds.
BASE = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
# Kinds that follow the base kinds, with the role each plays. Runs are found whole, then measured.
WEAK = {
    # URLs up to their query are matched first and have no group, so that nothing in them is a key.
    "key": (r"""https?://[^\s"'<>?#]+|([A-Za-z0-9+/]{32,}={0,2})""", 1, 32),
    "account": (r"""(?i)\b(user|username|login|account|client_?id|key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]+)""",
                2, 3),
    "endpoint": (r"""(?i)\b(?:https?://|(?:host|endpoint|server|url)["']?\x20*[:=]\x20*["']?)[A-Za-z0-9.-]+\.[A-Za-z]{2,}""",
                 0, 8),
}
KINDS = [*BASE, *WEAK]
ROLE = {"assign": "secret", "hex": "secret", "key": "secret", "access": "identifier", "account": "identifier",
        "endpoint": "endpoint"}
# Roles of which a weak kind needs all in its scope.
NEEDS = {"key": ["identifier"], "account": ["secret"], "endpoint": ["identifier", "secret"]}
REACH = 400


def spans(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Array of (start, rank, kind, end) of the matches of one kind, by start; code points, end exclusive.

    The text is cut at the matches; lengths of the pieces between them and of the matches, added up, are
    the offsets. Most texts have no match and are only searched once.
    """
    def found(column: Column) -> Column:
        def lengths(strings: Column) -> Column:
            return F.transform(strings, F.length)
        pieces = lengths(F.split(column, pattern, -1))
        matches = F.regexp_extract_all(column, F.lit(pattern), F.lit(0))
        measured = lengths(F.regexp_extract_all(column, F.lit(pattern), F.lit(group)))
        steps = F.arrays_zip(
            F.slice(pieces, F.lit(1), F.size(matches)).alias("gap"), lengths(matches).alias("long"),
            measured.alias("measured"), matches.alias("match"))
        rank = KINDS.index(kind)

        def step(done, x):
            start = done["at"] + x["gap"]
            kept = x["measured"] >= least
            if kind == "key":
                kept = kept & x["match"].rlike("[0-9]") & x["match"].rlike("[A-Z]") & x["match"].rlike("[a-z]")
            span = F.struct(start.cast("int").alias("start"), F.lit(rank).alias("rank"),
                            F.lit(kind).alias("kind"), (start + x["long"]).cast("int").alias("end"))
            return F.struct((start + x["long"]).cast("int").alias("at"), F.when(
                kept, F.concat(done["spans"], F.array(span))).otherwise(done["spans"]).alias("spans"))

        none = F.expr("cast(array() as array<struct<start:int,rank:int,kind:string,end:int>>)")
        start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
        return F.aggregate(steps, start, step, lambda done: done["spans"])

    # Long runs only: the same maximal runs as those of any length that are long enough.
    empty = F.expr("cast(array() as array<struct<start:int,rank:int,kind:string,end:int>>)")
    return F.when(text.rlike(pattern), found(text)).otherwise(empty)


def _long_runs(kind: str) -> str:
    """A pattern that finds only runs of the least length. They are maximal either way, so these are the same
    matches; a text has far fewer of them. Assignments have inner structure and keep their pattern."""
    return {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}.get(kind, {**BASE, **WEAK}[kind][0])


def parts(docs: DataFrame) -> DataFrame:
    """doc_id, the digest of the text, ``base`` and ``weak`` spans."""
    text = whole("text")
    def of(kinds):
        return F.array_sort(F.concat(*[spans(text, kind, _long_runs(kind), *spec[1:]) for kind, spec in kinds.items()]))
    return docs.select("doc_id", "text").select(
        "doc_id", F.when(of(WEAK) != F.expr("array()"), F.sha2(text, 256)).alias("digest"),
        of(BASE).alias("base"), of(WEAK).alias("weak"))


def link(found: DataFrame, reach: int = REACH) -> DataFrame:
    """digest and ``linked``: the weak spans whose scope holds what they need."""
    role = F.create_map(*[F.lit(x) for item in ROLE.items() for x in item])
    texts = found.where("size(weak) > 0 AND size(base) + size(weak) > 1").groupBy("digest").agg(
        F.first("base").alias("base"), F.first("weak").alias("weak"))
    marks = stored(texts.select("digest", F.explode(F.concat("base", "weak")).alias("part")).select(
        "digest", "part", role[F.col("part.kind")].alias("role")), "parts")
    def bucket(position: Column) -> Column:
        return F.floor(position / reach)

    # Side "after": where complements start; "before": where they end.
    sides = F.explode(F.array(*[F.struct(F.lit(side).alias("side"), F.col(f"part.{at}").alias("at"))
                                for side, at in (("after", "start"), ("before", "end"))])).alias("edge")
    edges = marks.select("digest", F.col("role").alias("needed"), sides).select(
        "digest", "needed", "edge.side", "edge.at", bucket(F.col("edge.at")).alias("bucket")).groupBy(
            "digest", "bucket", "needed", "side").agg(F.collect_set("at").alias("places"))
    needs = F.create_map(*[x for kind, roles in NEEDS.items() for x in (
        F.lit(kind), F.array(*[F.lit(r) for r in roles]))])
    looks = F.explode(F.array(*[
        F.struct(F.lit(side).alias("side"), (bucket(F.col(f"part.{at}")) + step).alias("bucket"))
        for side, at, steps in (("after", "end", (0, 1)), ("before", "start", (0, -1))) for step in steps])).alias("look")
    asks = marks.where(F.col("part.kind").isin(*WEAK)).select(
        "digest", "part", F.explode(needs[F.col("part.kind")]).alias("needed")).select(
        "digest", "part", "needed", looks).select("digest", "part", "needed", "look.*")
    close = F.when(F.col("side") == "after", F.exists("places", lambda at: (
        at >= F.col("part.end")) & (at - F.col("part.end") <= reach))).otherwise(F.exists("places", lambda at: (
            at <= F.col("part.start")) & (F.col("part.start") - at <= reach)))
    met = asks.join(edges, ["digest", "bucket", "needed", "side"]).where(close).groupBy("digest", "part").agg(
        F.count_distinct("needed").alias("n")).where(
            F.col("n") == F.size(needs[F.col("part.kind")]))
    return met.groupBy("digest").agg(F.collect_list("part").alias("linked"))


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, ``base`` and ``linked``: sorted arrays of (start, rank, kind, end) for every row."""
    found = stored(parts(docs), "findings")
    candidates = found.where("digest IS NOT NULL")
    linked = link(candidates, reach)
    none = F.expr("cast(array() as array<struct<start:int,rank:int,kind:string,end:int>>)")
    return candidates.join(linked, "digest", "left").select(
        "doc_id", "base", F.array_sort(F.coalesce("linked", none)).alias("linked")).union(
        found.where("digest IS NULL").select("doc_id", "base", none.alias("linked")))


def written(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def report(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """The findings of every row as counts, a digest of the base findings, and all spans as text."""
    def number(kind):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scan(docs, reach).select(
        "doc_id", *[number(kind) for kind in BASE], F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.array_sort(F.concat("base", "linked"))).alias("spans"), F.size("linked").cast("long").alias("n_linked"))
