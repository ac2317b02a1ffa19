"""Secret scan over an incremental blob ledger, in DataFrame functions.

Every row is a version of a path (its doc_id).  Texts are addressed by their
SHA-256; the ledger holds the findings of every (blob, rule version) scanned
before, and only pairs that it lacks are scanned, each blob once.  Findings
are then joined back to all paths.

Java's regular expressions give no positions, so matches are put between
marks, the text is split at the marks, and lengths of the parts add up to
positions in code points.

Defined results: null text is empty text (no spans); a null id stays null and
its row is returned; repeated rows are reported each; an empty table gives no
rows and adds nothing to the ledger; other columns are ignored.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetlake.llm.common import stage

# (kind, pattern, group whose length counts, least length): the contract's
# three kinds and the method's own (fixed values).
ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]""" \
    r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = [("assign", ASSIGN, 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]{24,}", 0, 24)]
MORE = [("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
        ("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 35),
        ("pem", "-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----", 0, 27)]
RULES = BASE + MORE
RULE_VERSION = "1"
# A text without this string has no match of the kind.
NEEDS = {"access": "AKIA", "github": "gh", "jwt": "eyJ", "pem": "PRIVATE KEY-----"}
_MARK, _OTHER = "\u0001", "\u0002"
_SPAN = "struct<start:int,ord:int,end:int,kind:string>"

LEDGER = T.StructType([
    T.StructField("blob", T.StringType()), T.StructField("rule_version", T.StringType()),
    T.StructField("found", T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("ord", T.IntegerType()),
        T.StructField("end", T.IntegerType()), T.StructField("kind", T.StringType())]))),
])


def whole_text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def blob_of(text: Column) -> Column:
    """Content address."""
    return F.sha2(text.cast("binary"), 256)


def _marked(text: Column, kind: str, pattern: str) -> Column:
    found = F.regexp_replace(text, F.lit(pattern), F.lit(f"{_MARK}$0{_MARK}"))
    return F.when(F.contains(text, F.lit(NEEDS[kind])), found).otherwise(text) if kind in NEEDS else found


def _runs(items: Column) -> Column:
    """An array cut into runs of an even length near the root of its size, so that
    folds that append to an array copy a run at a time, not all that came before."""
    size = F.size(items)
    step = 2 * F.ceil(F.sqrt(F.greatest(size, F.lit(1))) / 2).cast("int")
    return F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(size / step).cast("int") - 1, F.lit(0))),
                       lambda k: F.slice(items, k * step + 1, step))


def _before(values: Column, join) -> Column:
    """What ``join`` makes of all numbers before each one."""
    start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(values, start, lambda acc, v: F.struct(
        join(acc["sum"], v).alias("sum"), F.concat(acc["out"], F.array(acc["sum"])).alias("out")), lambda acc: acc["out"])


def _spans(parts: Column, order: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """Spans of every second part that is long enough."""
    def step(acc, x):
        size = F.length(x)
        long_enough = (F.length(F.regexp_extract(x, pattern, group)) if group else size) >= least
        span = F.struct(acc["pos"].alias("start"), F.lit(order).alias("ord"),
                        (acc["pos"] + size).alias("end"), F.lit(kind).alias("kind"))
        return F.struct(
            (acc["pos"] + size).alias("pos"), (~acc["odd"]).alias("odd"),
            F.when(acc["odd"] & long_enough, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    none = F.array().cast(f"array<{_SPAN}>")
    start = F.struct(F.lit(0).alias("pos"), F.lit(False).alias("odd"), none.alias("out"))
    # a run has an even number of parts, so marks keep their place in it
    folded = F.transform(_runs(parts), lambda run: F.aggregate(run, start, step))

    def moved(run, by):
        return F.transform(run["out"], lambda s: F.struct(
            (s["start"] + by).alias("start"), s["ord"].alias("ord"), (s["end"] + by).alias("end"),
            s["kind"].alias("kind")))

    # the runs are made once and named by an array of one
    placed = F.transform(F.array(folded), lambda runs: F.flatten(F.zip_with(
        runs, _before(F.transform(runs, lambda r: r["pos"]), lambda a, v: a + v), moved)))
    return F.when(F.size(parts) > 1, placed[0]).otherwise(none)


def find_spans(texts: DataFrame, text: str = "text") -> DataFrame:
    """``texts`` with ``found``: the spans of all kinds, by start, then kind."""
    out = texts.withColumn("__t", F.translate(F.col(text), _MARK, _OTHER))
    for k, (kind, pattern, _, _) in enumerate(RULES):
        out = out.withColumn(f"__p{k}", F.split(_marked(F.col("__t"), kind, pattern), _MARK, -1))
    spans = [_spans(F.col(f"__p{k}"), k, *rule) for k, rule in enumerate(RULES)]
    return out.withColumn("found", F.sort_array(F.concat(*spans))) \
        .drop("__t", *[f"__p{k}" for k in range(len(RULES))])


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The stored ledger, one row per (blob, rule version); empty where nothing is stored yet."""
    try:
        stored = spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)
    return stored.dropDuplicates(["blob", "rule_version"])      # runs at the same time may add a pair twice


def scan_stored(docs: DataFrame, path: str, rule_version: str = RULE_VERSION) -> tuple[DataFrame, DataFrame]:
    """``scan`` against the ledger stored at ``path``, to which its new rows are appended."""
    found, new = scan(docs, read_ledger(docs.sparkSession, path), rule_version)
    new.write.mode("append").parquet(path)
    return found, new


def scan(docs: DataFrame, ledger: DataFrame | None = None, rule_version: str = RULE_VERSION) \
        -> tuple[DataFrame, DataFrame]:
    """(doc_id, blob and found of every row; the rows to append to the ledger)."""
    spark = docs.sparkSession
    if ledger is None:
        ledger = spark.createDataFrame([], LEDGER)
    seen = ledger.where(F.col("rule_version") == rule_version).select("blob", "rule_version", "found")
    versions = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    addressed = stage(versions.select("doc_id", blob_of(F.col("text")).alias("blob")), "blobs")
    unseen = addressed.groupBy("blob").agg(F.min("doc_id").alias("first_id")) \
        .join(seen.select("blob"), "blob", "left_anti")
    # one row per unseen blob brings its text: keyed by id and blob, so copies of a blob are never gathered
    unseen = unseen.withColumnRenamed("blob", "unseen_blob")
    texts = versions.withColumn("blob", blob_of(F.col("text"))).join(
        unseen, F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("blob") == F.col("unseen_blob")), "left_semi")
    new = find_spans(texts).select("blob", F.lit(rule_version).alias("rule_version"), "found") \
        .dropDuplicates(["blob"])
    new = stage(new, "ledger")
    findings = seen.unionByName(new).select(F.col("blob").alias("b"), "found")
    found = addressed.join(findings, F.col("blob") == F.col("b"), "left").drop("b")
    return found, new


def joined(found: Column, base_only: bool = False) -> Column:
    """kind:start:end of spans, comma-joined."""
    if base_only:
        found = F.filter(found, lambda s: s["ord"] < len(BASE))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def redact(docs: DataFrame, ledger: DataFrame | None = None, ledger_path: str | None = None) -> DataFrame:
    """``docs`` with every span overwritten by as many asterisks.

    A text whose blob has no finding passes as it is.  Findings come back by
    blob; only texts with findings are cut up.  With ``ledger_path`` the stored
    ledger is read and added to.
    """
    found, _ = scan(docs, ledger) if ledger_path is None else scan_stored(docs, ledger_path)
    hits = found.where(F.size("found") > 0).select(F.col("blob").alias("__blob"), F.col("found").alias("__found")) \
        .dropDuplicates(["__blob"])
    names = docs.columns
    d = docs.join(hits, blob_of(whole_text()) == F.col("__blob"), "left")
    return d.withColumn("text", F.when(F.col("__found").isNotNull(), starred(F.col("text"), F.col("__found")))
                        .otherwise(F.col("text"))).select(*names)


def starred(text: Column, found: Column) -> Column:
    """``text`` with spans (by start, may overlap) overwritten.

    Spans are taken in runs; a run works on its own region of the text, from
    its first span to that of the next run, so no step copies the whole text.
    """
    def region(run, g, runs, reached):
        first = F.when(g == 0, F.lit(0)).otherwise(run[0]["start"])
        stop = F.when(g < F.size(runs) - 1, F.try_element_at(runs, g + 2)[0]["start"]).otherwise(F.length(text))
        covered = F.least(F.greatest(reached, first), stop)       # by spans of the runs before

        def cut(body):
            def step(acc, s):
                start = F.greatest(s["start"], acc["pos"])
                end = F.greatest(F.least(s["end"], stop), acc["pos"])
                gap = F.substring(body, acc["pos"] - first + 1, F.greatest(start - acc["pos"], F.lit(0)))
                return F.struct(end.alias("pos"), F.concat(
                    acc["out"], gap, F.repeat(F.lit("*"), F.greatest(end - start, F.lit(0)))).alias("out"))

            begin = F.struct(covered.alias("pos"), F.repeat(F.lit("*"), covered - first).alias("out"))
            return F.aggregate(run, begin, step, lambda acc: F.concat(
                acc["out"], F.substring(body, acc["pos"] - first + 1, stop - acc["pos"])))

        return F.transform(F.array(F.substring(text, first + 1, stop - first)), cut)[0]

    def whole(runs):
        reached = _before(F.transform(runs, lambda run: F.array_max(F.transform(run, lambda s: s["end"]))), F.greatest)
        at = F.sequence(F.lit(0), F.size(runs) - 1)
        pairs = F.transform(F.array(reached), lambda ends: F.zip_with(
            runs, at, lambda run, g: region(run, g, runs, F.element_at(ends, g + 1))))
        return F.array_join(pairs[0], "")

    return F.transform(F.array(_runs(found)), whole)[0]
