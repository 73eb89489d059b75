"""Secrets: patterns, then linking of multipart credentials.

Base spans come from three patterns (assign, access, hex).  Weaker parts are searched too:
identifiers (a named user, account or key id), endpoints (a URL, a host with a port, a named
host) and secrets without a name (a long mixed token).  Parts of a document are joined by
interval: two parts belong to one credential if at most SCOPE characters lie between them.
A weak part is reported only when its complement co-occurs: a weak secret or a weak
identifier with the other role, an endpoint with both an identifier and a secret.  Each part
is listed under the SCOPE-wide bins that it reaches; as spans of a kind do not overlap, a bin
holds a bounded number of them, so the join makes no large groups however many parts a
document has.

Only column expressions, joins and aggregates are used.

Defined cases: null text counts as empty, with no spans; rows that share doc_id and text get
the same result each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfeat.llm import common

KINDS = ["assign", "access", "hex", "ident", "weak", "endpoint"]
SCOPE = 300

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?+\x20*+[:=]\x20*+["']?+([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
#: A named identifier, an endpoint, an unnamed secret; of any length, read once as nothing is given back.
IDENT = r"""\b(?i:user_?name|user_?id|login|account|client_?id|access_?key_?id|tenant_?id)["']?+\x20*+[:=]\x20*+["']?+[A-Za-z0-9@._-]{3,}+"""
ENDPOINT = r"""\b(?:[a-z][a-z0-9+]{1,15}+://[A-Za-z0-9._:@/-]{4,}+|(?i:host_?name|host|endpoint|server|url)["']?+\x20*+[:=]\x20*+["']?+[A-Za-z0-9._:-]{4,}+|[a-z0-9-]{1,63}+(?:\.[a-z0-9-]{1,63}+){1,8}+:[0-9]{2,5}+\b)"""
WEAK = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+(?![A-Za-z0-9+/_=-])"

IDENT_ROLE, SECRET_ROLE, ENDPOINT_ROLE = 0, 1, 2


def parts(docs: DataFrame) -> DataFrame:
    """doc_id, __h and the spans (s, e) of every kind; weak secrets have upper, lower case and digits."""
    t = F.col("t")

    def found(needs: Column, pattern: str, group: int | None = None) -> Column:
        return F.when(needs, common.spans(t, pattern, group)).otherwise(common.no_spans())

    named = t.rlike(r"[:=]")
    mixed = lambda m: m.rlike("[0-9]") & m.rlike("[a-z]") & m.rlike("[A-Z]")
    col = {
        "assign": F.filter(found(named & t.rlike(ASSIGN), ASSIGN, 1), lambda x: F.length(x["g"]) >= 6),
        "access": found(t.contains("AKIA"), ACCESS),
        "hex": found(t.rlike(HEX), HEX),
        "ident": found(named & t.rlike(IDENT), IDENT),
        "weak": F.filter(found(t.rlike(WEAK), WEAK), lambda x: mixed(x["m"])),
        "endpoint": found(t.contains(":") | t.contains("="), ENDPOINT),
    }
    d = docs.select("doc_id", common.text_hash().alias("__h"), F.coalesce("text", F.lit("")).alias("t"))
    d = d.select("doc_id", "__h", *[F.transform(c, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))).alias(k) for k, c in col.items()])
    # a weak part that lies over a base span is that span already
    strong = F.concat("assign", "access", "hex")
    over = lambda x: F.exists(strong, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
    return d.select("doc_id", "__h", "assign", "access", "hex", *[F.filter(k, lambda x: ~over(x)).alias(k) for k in KINDS[3:]])


def linked(found: DataFrame) -> DataFrame:
    """(doc_id, __h, kept): the weak parts (s, k, e) whose complement lies within SCOPE characters."""
    ids = F.size("access") + F.size("ident")
    secrets = F.size("assign") + F.size("hex") + F.size("weak")
    weak = F.size("ident") + F.size("weak") + F.size("endpoint")
    some = found.filter((ids > 0) & (secrets > 0) & (weak > 0)).dropDuplicates(["doc_id", "__h"])
    role = F.element_at(F.array(*[F.lit(r) for r in (SECRET_ROLE, IDENT_ROLE, SECRET_ROLE, IDENT_ROLE, SECRET_ROLE, ENDPOINT_ROLE)]), F.col("k") + 1)
    every = F.concat(*[common.kinded(F.col(k), i) for i, k in enumerate(KINDS)])
    rows = common.table(some.select("doc_id", "__h", F.explode(every).alias("p")).select("doc_id", "__h", "p.s", "p.k", "p.e").withColumn("role", role), "secret-parts")

    def bins(low: Column, high: Column) -> Column:
        return F.explode(F.sequence(F.floor(low / SCOPE), F.floor(high / SCOPE)))

    # an interval meets what lies in the bins it covers once the other side is widened by the scope
    a = rows.filter(F.col("k") >= 3).withColumn("bin", bins(F.col("s"), F.col("e"))).select(F.struct("doc_id", "__h").alias("d"), "bin", "s", "k", "e", F.col("role").alias("own"))
    b = rows.filter(F.col("role") != ENDPOINT_ROLE).withColumn("bin", bins(F.col("s") - SCOPE, F.col("e") + SCOPE)).select(
        F.struct("doc_id", "__h").alias("d"), "bin", F.col("s").alias("os"), F.col("e").alias("oe"), "role")
    j = a.join(b, ["d", "bin"]).filter((F.col("role") != F.col("own")) & (F.col("os") <= F.col("e") + SCOPE) & (F.col("s") <= F.col("oe") + SCOPE))
    met = j.groupBy("d", "s", "k", "e", "own").agg(F.countDistinct("role").alias("roles"))
    kept = met.filter((F.col("own") != ENDPOINT_ROLE) | (F.col("roles") == 2))
    return kept.groupBy("d").agg(F.collect_set(F.struct("s", "k", "e")).alias("kept")).select("d.doc_id", "d.__h", "kept")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, n_linked (reported weak parts), base and spans
    (kind:start:end, comma-joined)."""
    found = common.table(parts(docs), "secret-spans")
    more = linked(found).select(F.col("doc_id").alias("__id"), F.col("__h").alias("__g"), "kept")
    j = found.join(more, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__g")), "left")
    base = F.concat(*[common.kinded(F.col(k), i) for i, k in enumerate(KINDS[:3])])
    extra = F.coalesce("kept", F.array().cast("array<struct<s:int,k:int,e:int>>"))
    return j.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]], F.size(extra).cast("long").alias("n_linked"),
                    common.span_text(base, KINDS).alias("base"), common.span_text(F.concat(base, extra), KINDS).alias("spans"))
