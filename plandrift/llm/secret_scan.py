"""Secret scans (4): an incremental ledger of scanned blobs.

Every historical version of a file is a blob, addressed by the SHA-256 of its content.
The ledger holds the findings of each (blob, rule version). A scan hashes the versions,
drops the pairs that the ledger has, scans each remaining blob once, appends to the
ledger and joins the findings back to all paths with that content.

DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plandrift.llm import common

# Kinds in their order, patterns, and what a match has to satisfy.
KINDS = ("assign", "access", "hex", "private_key")
PATTERNS = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{24,}",
    "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
}
#: Changes with any change of the rules above.
RULE_VERSION = "1"

#: What is blanked from a private key's header on: up to its END line or, where that is missing,
#: the header fields and the base64 that follow. The finding itself stays the header.
KEY_BLOCK = (r"^-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*+(?:-(?!----)[^-]*+){0,200}+-----END [A-Z ]*PRIVATE KEY-----"
             r"|(?:\s++[A-Za-z][A-Za-z-]*+: [^\n]*+){0,8}+(?:\s++[A-Za-z0-9+/=]{32,}+){0,400}+(?:\s++[A-Za-z0-9+/]*+=++)?+)")

FINDINGS = "array<struct<start:bigint,kind_no:int,kind:string,stop:bigint>>"


def _spans(value: Column, no: int, kind: str) -> Column:
    """Spans of one kind in code points, from the texts between and of the matches."""
    pattern = F.lit(PATTERNS[kind])
    found = F.regexp_extract_all(value, pattern, F.lit(0))
    between = F.split(value, PATTERNS[kind], -1)
    # The state carries the end of the last match; each match adds what lies before it.
    walked = F.aggregate(
        F.zip_with(between, found, lambda b, m: F.struct(F.length(b).cast("long").alias("gap"), m.alias("m"))),
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(
            "array<struct<start:bigint,m:string>>").alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + F.coalesce(F.length(x["m"]), F.lit(0))).alias("at"),
            F.when(x["m"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(
                F.struct((acc["at"] + x["gap"]).alias("start"), x["m"].alias("m"))))).alias("out")),
        lambda acc: acc["out"])
    long_enough = {
        "assign": lambda x: F.length(F.regexp_extract(x["m"], PATTERNS["assign"], 2)) >= 6,
        "access": lambda x: F.length(x["m"]) >= 20,
    }.get(kind, lambda x: F.lit(True))
    spans = F.transform(F.filter(walked, long_enough), lambda x: F.struct(
        x["start"].alias("start"), F.lit(no).alias("kind_no"), F.lit(kind).alias("kind"),
        (x["start"] + F.length(x["m"])).alias("stop")))
    return F.when(value.rlike(PATTERNS[kind]), spans).otherwise(F.array().cast(FINDINGS)).cast(FINDINGS)


def findings(value: Column) -> Column:
    """All spans of a text, by start, then kind in the order of ``KINDS``."""
    return F.sort_array(F.concat(*[_spans(value, no, kind) for no, kind in enumerate(KINDS)]))


def scan(versions: DataFrame, ledger: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(findings per version, new ledger rows) of ``versions`` (path_id, content).

    Versions without content have no blob and no findings. The ledger (blob_id,
    rule_version, spans) may be missing; rows of other rule versions are left alone.
    The text of each unseen blob travels once, after a reduction within each partition.
    Blobs without findings are in the ledger, too, so that none is scanned twice.
    """
    addressed = versions.select("path_id", "content", F.sha2(F.col("content").cast("binary"), 256).alias("blob_id"))
    blobs = addressed.where("content is not null").groupBy("blob_id").agg(F.first("content").alias("content"))
    if ledger is not None:
        known = ledger.where(F.col("rule_version") == RULE_VERSION).select("blob_id")
        blobs = blobs.join(known, "blob_id", "left_anti")
    new = common.stored(blobs.select("blob_id", F.lit(RULE_VERSION).alias("rule_version"),
                                     findings(F.col("content")).alias("spans")), "ledger")
    # Clean blobs need no join: only those with findings go back to the paths.
    hits = new.where(F.size("spans") > 0).select("blob_id", "spans")
    if ledger is not None:
        hits = hits.unionByName(ledger.where((F.col("rule_version") == RULE_VERSION) & (F.size("spans") > 0))
                                .select("blob_id", "spans"))
    paths = versions.select("path_id", F.sha2(F.col("content").cast("binary"), 256).alias("blob_id"))
    return paths.join(hits, "blob_id", "left").select(
        "path_id", "blob_id", F.coalesce("spans", F.array().cast(FINDINGS)).cast(FINDINGS).alias("spans")), new


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts per kind, digest of the base spans and all spans, per row.

    A null text counts as empty. Repeated rows and null ids stay; an empty table gives
    no rows; other columns are not looked at.
    """
    versions = docs.select(F.col(doc_id).cast("long").alias("path_id"),
                           F.coalesce(F.col(text).cast("string"), F.lit("")).alias("content"))
    found, _ = scan(versions)
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    base = F.filter("spans", lambda s: s["kind_no"] < 3)
    return found.select(
        F.col("path_id").alias("doc_id"),
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents with each secret replaced by ``mark``, overlapping spans by one;
    of a private key all of its block.

    ``n_chars`` follows where it was the length of the text. Null texts stay null.
    """
    # Only texts that some pattern matches travel; no other can have a finding.
    matched = F.coalesce(reduce(or_, [F.col("text").rlike(PATTERNS[kind]) for kind in KINDS]), F.lit(False))
    clean, docs = docs.where(~matched), docs.where(matched)
    addressed = docs.withColumn("__blob", F.sha2(F.col("text").cast("binary"), 256))
    versions = docs.select(F.lit(0).cast("long").alias("path_id"), F.col("text").alias("content"))
    _, new = scan(versions)
    hits = new.where(F.size("spans") > 0).select(F.col("blob_id").alias("__blob"), F.col("spans").alias("__spans"))
    joined = addressed.join(hits, "__blob", "left")
    block = lambda s: F.length(F.regexp_extract(F.substring(
        F.col("text"), s["start"].cast("int") + 1, F.length("text")), KEY_BLOCK, 0))
    spans = F.transform("__spans", lambda s: F.struct(s["start"].alias("start"), F.when(
        s["kind"] == "private_key", F.greatest(s["stop"], s["start"] + block(s))).otherwise(s["stop"]).alias("stop")))
    cut = F.aggregate(
        spans, F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["stop"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.substring(
                F.col("text"), acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int")), F.lit(mark)))
            .otherwise(acc["out"]).alias("out")),
        lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"].cast("int") + 1, F.length("text"))))
    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(cut)
    changed = joined.withColumn("__text", text)
    return changed.select(*[
        F.col("__text").alias("text") if c == "text" else
        F.when(F.col("n_chars") == F.length("text"), F.length("__text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars")
        if c == "n_chars" else F.col(c) for c in docs.columns]).unionByName(clean)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(common.read(spark, sf_dir, "documents"))


_SPANS_SQL = """
    list_transform(list_filter(list_transform(range(1, len(found_{k}) + 1), lambda i: {{
        'start': list_sum(list_transform(between_{k}[1:i], lambda x: length(x)))::BIGINT
                 + coalesce(list_sum(list_transform(found_{k}[1:i - 1], lambda x: length(x))), 0)::BIGINT,
        'm': found_{k}[i]}}), lambda x: {test}),
        lambda x: {{'start': x.start, 'kind_no': {no}, 'kind': '{k}', 'stop': x.start + length(x.m)}})"""


def _oracle() -> str:
    tests = {"assign": f"length(regexp_extract(x.m, $re${PATTERNS['assign']}$re$, 2)) >= 6",
             "access": "length(x.m) >= 20"}
    columns = ", ".join(f"regexp_extract_all(t, $re${PATTERNS[k]}$re$) AS found_{k}, "
                        f"string_split_regex(t, $re${PATTERNS[k]}$re$) AS between_{k}" for k in KINDS)
    spans = ", ".join(f"{_SPANS_SQL.format(k=k, no=no, test=tests.get(k, 'true'))} AS s_{k}"
                      for no, k in enumerate(KINDS))
    text = "array_to_string(list_transform({0}, lambda s: s.kind || ':' || s.start || ':' || s.stop), ',')"
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
matches AS (SELECT doc_id, {columns} FROM texts),
spans AS (SELECT doc_id, {spans} FROM matches),
ordered AS (SELECT *, list_sort(list_concat(s_assign, list_concat(s_access, s_hex))) AS base,
  list_sort(list_concat(list_concat(s_assign, s_access), list_concat(s_hex, s_private_key))) AS every FROM spans)
SELECT doc_id, len(s_assign)::BIGINT AS n_assign, len(s_access)::BIGINT AS n_access, len(s_hex)::BIGINT AS n_hex,
  sha256({text.format('base')}) AS base_sha256, {text.format('every')} AS spans
FROM ordered"""


ORACLE = _oracle()
