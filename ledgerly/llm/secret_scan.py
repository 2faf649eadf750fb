"""Secret scans over an incremental blob ledger.

Every version of every path is content-addressed (SHA-256 of its text). The
ledger knows which pairs of blob and rule version have been scanned and what
was found. A run scans only the pairs it has not seen, appends them, and joins
the findings back to all paths that ever had the blob. A text that thousands of
paths share is scanned once; a new rule version rescans blobs, not paths, and
versions that are missing for the same blob are scanned in one pass.

Which row holds a blob is found on hashes alone, but to learn it every text
moves once, to the shuffle partition of its blob. Texts without a blob (null)
stay out of the joins, and paths of a blob that very many share are salted.

Everything is DataFrame expressions on the JVM. Spans come from the regular
expressions alone: the text between matches (``split``) and the matches
(``regexp_extract_all``) alternate, so their lengths add up to code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerly.llm.common import aside, put_back, scratch_path
from ledgerly.operators.skew import salted_join

SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                     T.StructField("kind", T.StringType())])
FINDINGS = T.StructType([T.StructField("blob_id", T.StringType()),
                         T.StructField("rule_version", T.StringType()),
                         T.StructField("spans", T.ArrayType(SPAN))])


@dataclass(frozen=True)
class SecretRule:
    """All leftmost non-overlapping matches of ``pattern`` whose capture
    ``group`` has at least ``least`` code points. A text without ``holds`` has
    no match, which is cheaper to see."""

    kind: str
    pattern: str
    group: int
    least: int
    holds: str = ""


# The base rules, in the order their kinds are listed.
BASE_RULES = [
    SecretRule("assign", "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?"
               "([A-Za-z0-9+/_.=-]+)", 2, 8),
    SecretRule("access", "(AKIA[A-Z0-9]+)", 1, 16),
    SecretRule("hex", "([0-9a-f]+)", 1, 32),
]

# Further kinds, public formats of keys and tokens, in the order
# their kinds are listed.
ADDED_RULES = [
    SecretRule("private_key", "(-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
               "[A-Za-z0-9+/=:,\\x20\\t\\r\\n]+(-[A-Za-z0-9+/=:,\\x20\\t\\r\\n]+){0,8}"
               "-----END [A-Z ]{0,40}PRIVATE KEY-----)", 1, 1, "PRIVATE KEY-----"),
    SecretRule("web_token", "(eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+)", 1, 1, "eyJ"),
    SecretRule("connection", "((postgres|postgresql|mysql|mariadb|mssql|mongodb|mongodb\\+srv|redis|"
               "rediss|amqp|amqps|ftp|ftps|sftp|ssh|http|https)://[^\\x00-\\x20\"'<>:/@]{1,64}:"
               "[^\\x00-\\x20\"'<>/@]{1,128}@)", 1, 1, "://"),
    SecretRule("code_host_token", "(gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,}|"
               "glpat-[A-Za-z0-9_-]{20,})", 1, 1),
    SecretRule("service_token", "(xox[abprs]-[A-Za-z0-9-]{10,}|[sr]k_live_[A-Za-z0-9]{16,}|"
               "AIza[A-Za-z0-9_-]{35}|npm_[A-Za-z0-9]{36}|SG\\.[A-Za-z0-9_-]{16,}\\.[A-Za-z0-9_-]{16,})", 1, 1),
]
#: Rule versions in the order they came, each with the kinds it added.
RULE_VERSIONS = {"base-1": BASE_RULES, "added-1": ADDED_RULES}


def _pattern_to_look_for(rule: SecretRule) -> str:
    """A run of one class that is long enough holds exactly the matches of the
    unbounded rule that are kept, and is far rarer."""
    if rule.pattern == "([0-9a-f]+)":
        return f"([0-9a-f]{{{max(1, rule.least)},}})"
    if rule.pattern == "(AKIA[A-Z0-9]+)":
        return f"(AKIA[A-Z0-9]{{{max(1, rule.least - 4)},}})"
    return rule.pattern


def rule_spans(text: Column, rule: SecretRule) -> Column:
    """Spans of one rule, by start. Texts without a match skip the work."""
    pattern = F.lit(_pattern_to_look_for(rule))
    gaps = F.transform(F.split(text, _pattern_to_look_for(rule), -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    kept = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    parts = F.arrays_zip(F.slice(gaps, 1, F.size(whole)).alias("g"), whole.alias("w"),
                         kept.alias("k"))
    # (next position, spans so far): one pass over the matches.
    empty = F.array().cast(T.ArrayType(SPAN))
    start = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans"))

    def step(acc: Column, part: Column) -> Column:
        begin = acc["at"] + part["g"]
        end = begin + part["w"]
        span = F.struct(begin.alias("start"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        return F.struct(end.alias("at"), F.when(part["k"] >= rule.least, F.concat(
            acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    found = F.aggregate(parts, start, step, lambda acc: acc["spans"])
    likely = text.rlike(_pattern_to_look_for(rule))
    if rule.holds:
        likely = F.contains(text, F.lit(rule.holds)) & likely
    return F.when(likely, found).otherwise(empty)


def in_order(found: Column, kinds: list[str]) -> Column:
    """Spans by start, then in the order of the ``kinds``."""
    listed = F.array(*[F.lit(k) for k in kinds])
    ranked = F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(listed, s["kind"]).alias("rank"),
        s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.array_sort(ranked), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))


def all_spans(text: Column, rules: list[SecretRule]) -> Column:
    """Spans of all rules by start, then in the order of the rules."""
    return in_order(F.concat(*[rule_spans(text, r) for r in rules]), [r.kind for r in rules])


class BlobLedger:
    """Findings per (blob, rule version), as Parquet appended run by run.

    ``path`` must be in storage that all executors share; by default it is a
    new folder under the session's shared checkpoint folder. A pair that is in
    the ledger is scanned, with an empty list if nothing was found."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or scratch_path(spark, "blob-ledger")
        if path is None:
            spark.createDataFrame([], FINDINGS).write.mode("ignore").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(FINDINGS).parquet(self.path)

    def scan(self, versions: DataFrame, rules: list[SecretRule], rule_version: str, *,
             text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> int:
        """Scan what one rule version has not seen; see ``scan_versions``."""
        return self.scan_versions(versions, {rule_version: rules}, text=text, keys=keys)

    def scan_versions(self, versions: DataFrame, rule_versions: dict[str, list[SecretRule]], *,
                      text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> int:
        """Scan the pairs of blob and rule version that are unseen in
        ``versions`` (one row per path and version) and append them; returns the
        number of pairs added. Run again after a failed run: nothing of a failed
        append is visible."""
        hashed = versions.select(
            F.sha2(F.col(f"`{text}`"), 256).alias("blob_id"),
            F.xxhash64(*[F.col(f"`{k}`") for k in keys]).alias("holder"),
            F.col(f"`{text}`").alias("text")).where(F.col("blob_id").isNotNull())
        names = F.array(*[F.lit(v) for v in rule_versions])
        seen = (self.read().where(F.col("rule_version").isin(list(rule_versions)))
                .groupBy("blob_id").agg(F.collect_set("rule_version").alias("seen")))
        # One holder per blob, found on hashes alone (summed up before the
        # shuffle, however many copies there are), with the versions it lacks.
        unseen = (hashed.groupBy("blob_id").agg(F.min("holder").alias("holder"))
                  .join(seen, "blob_id", "left")
                  .withColumn("lacks", F.array_except(names, F.coalesce(
                      "seen", F.array().cast("array<string>"))))
                  .where(F.size("lacks") > 0).drop("seen"))
        # Repeated rows of a holder meet where the join put them: no second move.
        texts = hashed.join(unseen, ["blob_id", "holder"]).dropDuplicates(["blob_id", "holder"])
        results = F.array(*[
            F.struct(F.lit(v).alias("rule_version"), F.when(
                F.array_contains("lacks", v), all_spans(F.col("text"), rules)).alias("spans"))
            for v, rules in rule_versions.items()])
        found = (texts.select("blob_id", F.explode(results).alias("r"))
                 .where(F.col("r.spans").isNotNull()).select("blob_id", "r.*"))
        before = self.read().count()
        found.write.mode("append").parquet(self.path)
        return self.read().count() - before

    def findings(self, rule_version: str) -> DataFrame:
        return (self.read().where(F.col("rule_version") == rule_version)
                .select("blob_id", "spans").dropDuplicates(["blob_id"]))

    def all_findings(self, rule_versions: dict[str, list[SecretRule]]) -> DataFrame:
        """The blobs with findings of any of the versions, with all their spans."""
        kinds = [r.kind for rules in rule_versions.values() for r in rules]
        per_pair = (self.read().where(F.col("rule_version").isin(list(rule_versions)))
                    .where(F.size("spans") > 0).dropDuplicates(["blob_id", "rule_version"]))
        return per_pair.groupBy("blob_id").agg(
            in_order(F.flatten(F.collect_list("spans")), kinds).alias("spans"))


def scan_documents(docs: DataFrame, *, rules: list[SecretRule] | None = None,
                   rule_version: str = "base-1", ledger: BlobLedger | None = None,
                   text: str = "text", doc_id: str = "doc_id",
                   rule_versions: dict[str, list[SecretRule]] | None = None) -> DataFrame:
    """``docs`` plus ``blob_id`` and ``spans`` (start, end, kind; code points,
    end exclusive), through the ledger (a new one by default). ``rule_versions``
    takes the spans of several rule versions together.

    Null texts have no blob and no spans; empty texts share one blob without
    any. Copies share a blob and its spans, whoever holds it; repeated rows come
    back as often as they came in."""
    if rule_versions is None:
        rule_versions = {rule_version: BASE_RULES if rules is None else rules}
    ledger = ledger or BlobLedger(docs.sparkSession)
    ledger.scan_versions(docs, rule_versions, text=text, keys=(doc_id,))
    clean = [c for c in docs.columns if c.lower() not in {"blob_id", "spans"} - {text, doc_id}]
    # Rows without a blob get a key that meets nothing, each its own, so that
    # they are spread; a blob of very many paths is measured and salted.
    alone = F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))
    named = (docs.select(*[F.col(f"`{c}`") for c in clean])
             .withColumn("blob_id", F.sha2(F.col(f"`{text}`"), 256))
             .withColumn("__blob", F.coalesce("blob_id", alone)))
    found = ledger.all_findings(rule_versions).withColumnRenamed("blob_id", "__blob")
    return (salted_join(named, found, ["__blob"], [doc_id], "left")
            .withColumn("spans", F.coalesce("spans", F.array().cast(T.ArrayType(SPAN))))
            .select(*[F.col(f"`{c}`") for c in clean], "blob_id", "spans"))


def mask(text: Column, spans: Column, sign: str = "[SECRET]") -> Column:
    """The text with every span (overlapping ones as one) replaced by a sign."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        part = F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(gap, F.lit(sign)))
                      ).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), part.alias("out"))

    masked = F.aggregate(spans, start, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, masked).otherwise(text)


def mask_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every secret in the text masked; clean rows and all other
    columns, whatever they are called, come back unchanged."""
    text, doc_id = options.get("text", "text"), options.get("doc_id", "doc_id")
    found = scan_documents(aside(docs, doc_id, text), **options)
    return put_back(found, docs, **{text: mask(F.col(f"`{text}`"), F.col("spans"))})
