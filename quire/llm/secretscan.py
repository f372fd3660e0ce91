"""Secret scans over an incremental ledger of content-addressed blobs.

Only DataFrame and SQL functions; no Python runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.checkpoint import cut, exists
from .common import absent, text_or_empty

#: Findings of up to so many bytes are broadcast to documents.
BROADCAST_FINDINGS = 20_000_000
#: Bytes that a blob and one of its spans take in a broadcast row.
_BLOB_BYTES, _SPAN_BYTES = 100, 40
MASK = "[SECRET]"
#: Code points of a text's blocks when it is masked.
MASK_BLOCK = 512


@dataclass(frozen=True)
class Rule:
    """``pattern`` in both Java's and RE2's syntax; ``group`` has at least ``least`` code points."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: The rules in their order of kinds.
RULES = (
    Rule("assign", 1, r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
         r"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", 1, r"[0-9a-f]{32,}", 0, 32),
)

_SPAN = "array<struct<start:int,kind:int,stop:int>>"
_LEDGER = f"blob binary, rule string, spans {_SPAN}"


def blob() -> Column:
    """Content address of a version."""
    return F.unhex(F.sha2(text_or_empty(), 256))


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], _LEDGER)


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), then)[0]


def _matches(text: Column, rule: Rule) -> Column:
    """For each match in order: code points before it since the last, of it, and of its group; null if none."""
    pattern = F.lit(rule.pattern)

    def lengths(found: Column) -> Column:
        parts = [F.transform(F.slice(F.split(text, rule.pattern, -1), 1, F.size(found)), F.length),
                 F.transform(found, F.length)]
        parts.append(F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
                     if rule.group else parts[1])
        named = [F.transform(F.arrays_zip(*parts), lambda m: F.struct(
            m["0"].alias("gap"), m["1"].alias("size"), m["2"].alias("part")))]
        return F.when(F.size(found) > 0, named[0])

    return _let(F.regexp_extract_all(text, pattern, F.lit(0)), lengths)


def scan(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows (blob, rule, spans) of the unseen pairs of ``versions`` (blob, text).

    Copies of a blob collapse before its text moves; a blob is scanned only by
    the rule versions that the ledger lacks for it.
    """
    names = F.array(*[F.lit(r.name) for r in rules])
    todo = versions.select("blob").distinct().withColumn("rule", F.explode(names)).join(
        ledger.select("blob", "rule"), ["blob", "rule"], "left_anti").groupBy("blob").agg(
        F.collect_set("rule").alias("rules"))
    texts = versions.groupBy("blob").agg(F.first("text").alias("text")).join(todo, "blob")
    found = F.array(*[F.struct(
        F.lit(r.name).alias("rule"), F.lit(k).alias("kind"), F.lit(r.least).alias("least"),
        F.when(F.array_contains("rules", r.name), _matches(F.col("text"), r)).alias("found"))
        for k, r in enumerate(rules)])
    pairs = cut(texts.select("blob", "rules", F.explode(found).alias("x")).where(
        F.array_contains("rules", F.col("x.rule"))).select("blob", "x.*"))
    bare = pairs.where(F.col("found").isNull()).select("blob", "rule", F.expr(f"cast(array() as {_SPAN})").alias("spans"))
    each = pairs.where(F.col("found").isNotNull()).select(
        "blob", "rule", "kind", "least", F.posexplode("found").alias("nth", "m"))
    # where a match starts: all gaps up to it and all matches before it
    upto = Window.partitionBy("blob", "rule").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stop = F.sum(F.col("m.gap") + F.col("m.size")).over(upto).cast("int")
    spans = each.withColumn("stop", stop).select("blob", "rule", F.when(
        F.col("m.part") >= F.col("least"),
        F.struct((F.col("stop") - F.col("m.size")).alias("start"), "kind", "stop")).alias("span"))
    hits = spans.groupBy("blob", "rule").agg(F.array_sort(F.collect_list("span")).cast(_SPAN).alias("spans"))
    return bare.unionByName(hits)


def ledger_of(docs: DataFrame, rules: tuple[Rule, ...] = RULES, batches: int = 2,
              ledger: DataFrame | None = None, path: str | None = None) -> DataFrame:
    """The ledger after all documents, taken in as ``batches`` increments.

    Each increment scans what the ones before haven't seen and is written to
    the shared checkpoint folder.  A ledger at ``path`` is read first, and new
    rows are appended to it; one writer at a time.
    """
    spark = docs.sparkSession
    if ledger is None:
        ledger = spark.read.schema(_LEDGER).parquet(path) if path and exists(spark, path) else empty_ledger(spark)
    versions = docs.select("doc_id", blob().alias("blob"), text_or_empty().alias("text"))
    turn = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    for k in range(batches):
        new = cut(scan(versions.where(turn == k), ledger, rules))
        if path:
            new.write.mode("append").parquet(path)
        ledger = ledger.unionByName(new)
    return ledger


def _by_blob(ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, spans) of the blobs with findings by the given rule versions, all kinds in order."""
    current = ledger.where(F.col("rule").isin([r.name for r in rules]) & (F.size("spans") > 0))
    return current.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))


def _sized(found: DataFrame, spans: str) -> DataFrame:
    """``found`` with a broadcast hint if the bytes of its blobs and spans allow it."""
    held = found.agg(F.sum(_BLOB_BYTES + _SPAN_BYTES * F.size(spans).cast("long"))).first()[0] or 0
    # beyond the bound also against Spark's own guess, which goes by the size of the written files
    return found.hint("broadcast" if held <= BROADCAST_FINDINGS else "merge")


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, batches: int = 2,
                 ledger_path: str | None = None) -> DataFrame:
    """Rows (doc_id, spans) of every document; spans hold (start, kind, stop), by start and kind.

    With ``ledger_path``, a folder in shared storage, only pairs of blob and rule
    version that its ledger lacks are scanned and appended; without, the ledger
    starts empty.

    Positions count code points, the stop is exclusive.  A null text counts as
    empty; repeated rows give one row each; a document without findings has an
    empty array; a null doc_id stays null; other columns are ignored.
    """
    found = _sized(cut(_by_blob(ledger_of(docs, rules, batches, path=ledger_path), rules)), "spans")
    return docs.select("doc_id", blob().alias("blob")).join(found, "blob", "left").select(
        "doc_id", F.coalesce("spans", F.expr(f"cast(array() as {_SPAN})")).alias("spans"))


def spelt(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``kind:start:stop`` of each span, joined by commas."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"], s["stop"])), ",")


def gaps(found: DataFrame) -> DataFrame:
    """(blob, gaps, stop): the stretches that no span of a blob covers, and the end of its last span.

    A gap (start, stop) lies before each span that starts beyond all spans before
    it.  Spans go one by one through a window over their blob.
    """
    each = found.select("blob", F.explode("spans").alias("s")).select("blob", "s.*")
    before = Window.partitionBy("blob").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    open_ = each.withColumn("covered", F.max("stop").over(before))
    gap = F.when(F.col("covered").isNull() | (F.col("start") > F.col("covered")), F.struct(
        F.coalesce("covered", F.lit(0)).alias("start"), F.col("start").alias("stop")))
    return open_.groupBy("blob").agg(F.array_sort(F.collect_list(gap)).alias("gaps"), F.max("stop").alias("stop"))


def masked(text: Column, gaps_: Column, stop: Column) -> Column:
    """``gaps_`` of ``text`` and what follows ``stop``, with the mask between them.

    The text is cut into blocks of code points once, so that a gap is put
    together from its blocks and no piece is looked for from the text's start.
    """
    every = F.concat(gaps_, F.array(F.struct(stop.alias("start"), F.length(text).alias("stop"))))

    def piece(blocks: Column, gap: Column) -> Column:
        first, last = (F.floor(gap[c] / MASK_BLOCK).cast("int") for c in ("start", "stop"))
        at = gap["start"] - first * MASK_BLOCK + 1
        head = F.get(blocks, first)
        tail = F.substring(F.get(blocks, last), F.lit(1), gap["stop"] - last * MASK_BLOCK)
        return F.when(first == last, F.coalesce(F.substring(head, at, gap["stop"] - gap["start"]), F.lit(""))).otherwise(
            F.concat(F.substring(head, at, F.lit(MASK_BLOCK)),
                     F.array_join(F.slice(blocks, first + 2, last - first - 1), ""), F.coalesce(tail, F.lit(""))))

    blocks = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % MASK_BLOCK), F.lit(0))
    return _let(blocks, lambda b: F.array_join(F.transform(every, lambda g: piece(b, g)), MASK))


def without_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, ledger_path: str | None = None) -> DataFrame:
    """``docs`` with the found stretches of their texts masked and ``n_chars``, if there, set anew.

    Spans that overlap or touch become one mask.  ``ledger_path`` as in
    :func:`secret_spans`.  A text without findings stays as it is, null or empty
    ones too; repeated rows stay; other columns stay, whatever their names; an
    empty table stays empty.
    """
    found = cut(gaps(_by_blob(ledger_of(docs, rules, path=ledger_path), rules)))
    names = absent(docs, "own_blob", "blob", "gaps", "stop")
    own, blob_, gaps_, stop = names
    found = _sized(found.select(F.col("blob").alias(blob_), F.col("gaps").alias(gaps_), F.col("stop").alias(stop)), gaps_)
    joined = docs.withColumn(own, blob()).join(found, F.col(own) == F.col(blob_), "left")
    hit = F.col(blob_).isNotNull()
    out = joined.withColumn("text", F.when(hit, masked(F.col("text"), F.col(gaps_), F.col(stop))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(hit, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
