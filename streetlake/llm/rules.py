"""Quality rules: base counts and distribution divergence, in DataFrame functions.

Every text gives counts of its character classes and of the common words of
its language.  Summed per language over all documents that pass the base
rules, they are the language's reference histograms; a document is rejected if
the Jensen-Shannon distance of one of its histograms to the reference of its
language is over a limit.  Classes have a reference for every value of lang
that enough documents have, and one over all documents for the others; common
words have one for each word list, found by the primary tag (EN and en-US have
the words of en).  Short texts scatter more, by 1 / sqrt(n_words), so
under a number of words the limit widens by it.

Defined results: null or empty text has no words and fails the base rule;
documents without a language, or in one without a word list, are judged by
their base counts and character classes; a null id stays null; repeated rows are judged each; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetlake.llm.common import stage

# Common words per language (fixed values).
COMMON = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "on", "with", "as", "by", "at", "are", "this"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "ein"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una"],
}
N_COMMON = 16
MIN_WORDS, CLASS_LIMIT = 50, 0.30       # character classes: largest Jensen-Shannon distance from so many words on
MIN_SAMPLE, WORD_LIMIT = 100, 0.24      # common words: the same; under it limits widen with 1 / sqrt(n_words)
LEAST_DOCS, MOST_REFERENCES = 20, 10_000    # a language's own classes need so many documents, and one in so many of all
WHITE = "\t\n\x0b\f\r"
EDGE = ".,;:!?()\"'¿¡«»„“”‘’…"          # cut off both ends of a word before it is looked up
MARKS = r"[\p{P}&&[^#*%&]]"             # punctuation that is no symbol of the base counts


def word_list(text: Column) -> Column:
    """The words of a text in order: what stands between the contract's white space."""
    return F.array_remove(F.split(F.translate(text, WHITE, " " * len(WHITE)), " ", -1), "")


def primary_tag(lang: Column) -> Column:
    """``en`` of EN, en-US and en_GB."""
    return F.lower(F.substring_index(F.translate(F.trim(lang), "_", "-"), "-", 1))


def _times(array: str, k: int) -> Column:
    """How often ``k`` stands in an array."""
    return F.size(F.filter(array, lambda x: x == k)).cast("long")


def _pairs(left: str, right: str, shift: int) -> Column:
    """Hashes of left[i] and right[i + shift]."""
    n = F.greatest(F.size(right) - shift, F.lit(0))
    return F.zip_with(F.slice(left, 1, n), F.slice(right, shift + 1, n), lambda a, b: F.xxhash64(a, b))


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, the contract's counts and the two histograms."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                    text.alias("t"), F.xxhash64(F.col("text").cast("string")).alias("hash"))
    d = d.withColumn("w", word_list(F.col("t")))
    d = d.withColumn("n_words", F.size("w").cast("long"))
    # five words' hash from hashes of one, two and four
    d = d.withColumn("h1", F.transform("w", lambda x: F.xxhash64(x)))
    d = d.withColumn("h2", _pairs("h1", "h1", 1)).withColumn("h4", _pairs("h2", "h2", 2))
    d = d.withColumn("h", _pairs("h4", "h1", 4))
    # only where some window repeats are windows sorted with their starts; each
    # such start covers its five words, less those covered before
    d = d.withColumn("many", F.size("h") > F.size(F.array_distinct("h")))
    order = F.when(F.col("many"), F.sort_array(F.transform(
        F.col("h"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))) \
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    d = d.withColumn("o", order)
    starts = F.sort_array(F.transform(
        F.filter(F.col("o"), lambda x, i: (F.coalesce(F.get(F.col("o"), i - 1)["h"] == x["h"], F.lit(False)))
                 | (F.coalesce(F.get(F.col("o"), i + 1)["h"] == x["h"], F.lit(False)))),
        lambda x: x["i"]))
    d = d.withColumn("s", starts)
    covered = F.aggregate(F.col("s"), F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end")),
                          lambda acc, i: F.struct(
                              (acc["n"] + (i + 5 - F.greatest(acc["end"], i))).cast("bigint").alias("n"),
                              (i + 5).alias("end")), lambda acc: acc["n"])
    lines = F.filter(F.split(F.col("t"), "\n", -1), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    common = F.create_map(*[x for k, v in COMMON.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    d = d.withColumn("ls", lines).withColumn("list", common[primary_tag(F.col("lang"))])
    d = d.withColumn("c", F.when(F.col("list").isNotNull(), F.filter(
        F.transform(F.col("w"), lambda w: F.array_position(F.col("list"), F.btrim(F.lower(w), F.lit(EDGE)))),
        lambda k: k > 0)))
    n_chars = F.length("t")
    d = d.select(
        "doc_id", "hash", "lang", "n_words",
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("ls") - F.size(F.array_distinct("ls"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        n_chars.cast("long").alias("n_chars"),
        F.regexp_count("t", F.lit("[0-9]")).cast("long").alias("n_digits"),
        F.regexp_count("t", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("t", F.lit(MARKS)).cast("long").alias("n_marks"),
        *[_times("c", k).alias(f"c{k}") for k in range(1, N_COMMON + 1)])
    return d.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


CLASS_COLUMNS = ["k_space", "k_symbol", "k_digit", "k_upper", "k_mark", "k_other"]
WORD_COLUMNS = [f"c{k}" for k in range(1, N_COMMON + 1)] + ["c_other"]


def _histograms(counts: DataFrame) -> DataFrame:
    """The exclusive classes of both histograms (null words: no list)."""
    used = sum((F.col(f"c{k}") for k in range(1, N_COMMON + 1)), F.lit(0))
    return counts.withColumns({
        "k_space": F.col("n_chars") - F.col("word_chars"), "k_symbol": F.col("n_symbols"),
        "k_digit": F.col("n_digits"), "k_upper": F.col("n_upper"), "k_mark": F.col("n_marks"),
        "k_other": F.col("word_chars") - F.col("n_symbols") - F.col("n_digits") - F.col("n_upper") - F.col("n_marks"),
        "c_other": F.col("n_words") - used,
    })


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two arrays of shares; null if one is."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    terms = F.zip_with(p, q, lambda x, y: part(x, (x + y) / 2) + part(y, (x + y) / 2))
    total = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return F.sqrt(F.abs(total) / 2)     # rounding may leave a sum just under 0


def _shares(columns: list[str], prefix: str = "") -> Column:
    counts = F.array(*[F.col(prefix + c).cast("double") for c in columns])
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.when(total > 0, F.transform(counts, lambda x: x / total))


def judge(counts: DataFrame, min_words: int = MIN_WORDS, class_limit: float = CLASS_LIMIT,
          min_sample: int = MIN_SAMPLE, word_limit: float = WORD_LIMIT) -> DataFrame:
    """``counts`` (staged) with both distances and ``kept``."""
    h = _histograms(counts)
    sums = h.where(~F.col("base_failed")).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"r_{c}") for c in CLASS_COLUMNS + WORD_COLUMNS])
    sums = stage(sums, "rule-references")
    whole = sums.agg(F.sum("n").alias("n"), *[F.sum(f"r_{c}").alias(c) for c in CLASS_COLUMNS]).first()
    least_docs = max(LEAST_DOCS, -(-(whole["n"] or 0) // MOST_REFERENCES))
    # at most MOST_REFERENCES values have their share of the documents, and the lists bound the words
    classes = sums.where(F.col("lang").isNotNull() & (F.col("n") >= least_docs)) \
        .select("lang", _shares(CLASS_COLUMNS, "r_").alias("own_classes"))
    words = sums.withColumn("tag", primary_tag(F.col("lang"))).where(F.col("tag").isin(*COMMON)).groupBy("tag") \
        .agg(*[F.sum(f"r_{c}").alias(f"r_{c}") for c in WORD_COLUMNS]) \
        .select("tag", _shares(WORD_COLUMNS, "r_").alias("ref_words"))
    chars = sum(whole[c] or 0 for c in CLASS_COLUMNS)
    all_classes = F.array(*[F.lit(whole[c] / chars) for c in CLASS_COLUMNS]) if chars else F.lit(None).cast("array<double>")
    j = h.withColumn("tag", primary_tag(F.col("lang"))).join(F.broadcast(classes), "lang", "left") \
        .join(F.broadcast(words), "tag", "left").withColumn("ref_classes", F.coalesce("own_classes", all_classes))
    odd = F.lit(False)
    for name, columns, limit, least in (("class", CLASS_COLUMNS, class_limit, min_words),
                                        ("word", WORD_COLUMNS, word_limit, min_sample)):
        far = js_distance(_shares(columns), F.col("ref_classes" if name == "class" else "ref_words"))
        j = j.withColumn(f"{name}_distance", far)
        wider = F.sqrt(F.greatest(F.lit(1.0), least / F.greatest("n_words", F.lit(1))))
        odd = odd | F.coalesce(F.col(f"{name}_distance") > limit * wider, F.lit(False))
    return j.withColumn("kept", ~F.col("base_failed") & ~odd)


def quality_rules(docs: DataFrame, **limits) -> DataFrame:
    """One row per document: counts, distances, base_failed, kept."""
    return judge(stage(base_counts(docs), "rule-counts"), **limits).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "class_distance", "word_distance", "base_failed", "kept")


def keep_documents(docs: DataFrame, **limits) -> DataFrame:
    """``docs`` without the rows that the rules reject, columns as they were.

    Verdicts go back to texts by id and text hash; only kept keys are joined.
    """
    key = F.xxhash64(F.col("text").cast("string"))
    counts = stage(base_counts(docs), "rule-counts")
    kept = judge(counts, **limits).where("kept").select(F.col("doc_id").alias("__id"), F.col("hash").alias("__hash")) \
        .distinct()
    d = docs.withColumn("__h", key).withColumn("__i", F.col("doc_id").cast("long"))
    return d.join(kept, F.col("__i").eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__hash")), "left_semi") \
        .select(*docs.columns)
