"""URL filter: rules first, gradient-boosted trees for the rest, in DataFrame functions.

URLs that a rule fits are the labelled ones.  Trees of depth two are grown on
binned lexical features by Newton boosting: one grouped sum of gradients per
(node, feature, bin) and level, whose rows are as many as bins, chooses the
splits.  The model becomes a SQL expression, so scoring is part of the scan.

The training rows are a sample of the labelled URLs of about ``TRAIN_ROWS``
rows at most, taken by a hash of URL and id, so that one URL on a third of all
rows adds a share of them only.  The sample grows the trees; suffix statistics
come from all rows: a suffix's share of all pages, and the block rate of its
labelled ones.

Defined results: a null URL, or one without ``://``, has an empty host and
path, fits no rule and is judged by the model on its (empty) features; without
labelled URLs everything unruled is allowed; a null id stays null; repeated
rows are judged each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetlake.llm.common import stage
from streetlake.operators.joins import MAX_BROADCAST_ROWS

# (verdict, host, path) in the order stated (fixed values).
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/")]
TRAIN_ROWS = 20_000
ROUNDS, BINS, STEP, RIDGE = 8, 16, 0.4, 1.0
FEATURES = ["length", "depth", "digit_ratio", "entropy", "params", "host_labels", "host_length", "hyphens",
            "suffix_rate", "suffix_share"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def with_rule(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path, the longest fitting rule and its verdict."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    host, path = host_and_path(F.col("url"))
    p = p.withColumn("host", host).withColumn("path", path)
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, start in sorted(RULES, key=lambda r: (len(r[1] + r[2]), r[1:])):    # the longest is asked first
        fits = ((F.col("host") == h) | F.endswith(F.col("host"), F.lit("." + h))) \
            & F.startswith(F.col("path"), F.lit(start))
        rule = F.when(fits, F.lit(h + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return p.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def lexical(pages: DataFrame) -> DataFrame:
    """The features that need the URL alone, and its suffix."""
    u = F.coalesce(F.col("url"), F.lit(""))
    size = F.greatest(F.length(u), F.lit(1)).cast("double")
    chars = F.split(u, "")
    distinct = F.array_distinct(chars)
    share = lambda c: (F.length(u) - F.length(F.replace(u, c, F.lit("")))) / size
    entropy = F.aggregate(distinct, F.lit(0.0), lambda a, c: a - F.when(
        (c != "") & (share(c) > 0), share(c) * F.log2(share(c))).otherwise(0.0))
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    return pages.withColumns({
        "length": F.length(u).cast("double"),
        "depth": F.size(F.filter(F.split("path", "/"), lambda x: x != "")).cast("double"),
        "digit_ratio": (F.length(u) - F.length(F.translate(u, string.digits, ""))) / size,
        "entropy": entropy,
        "params": F.size(F.filter(F.split(query, "&"), lambda x: x != "")).cast("double"),
        "host_labels": F.size(F.split("host", r"\.")).cast("double"),
        "host_length": F.length("host").cast("double"),
        "hyphens": (F.length(u) - F.length(F.translate(u, "-_", ""))).cast("double"),
        "suffix": F.substring_index("host", ".", -1),
    })


def _bin(feature: str, edges: list[float]) -> Column:
    """Number of the feature's bin among the edges."""
    out = F.lit(0)
    for e in edges:
        out = out + F.when(F.col(feature) > e, 1).otherwise(0)
    return out


def _leaf(tree: dict) -> Column:
    """A tree as an expression over the bins."""
    if "leaf" in tree:
        return F.lit(tree["leaf"])
    return F.when(F.col("b_" + tree["feature"]) <= tree["bin"], _leaf(tree["left"])).otherwise(_leaf(tree["right"]))


def _best(sums: dict[tuple[str, int], tuple[float, float]]) -> tuple | None:
    """(gain, feature, bin, left sums, right sums) of the best split of a node."""
    best = None
    for f in FEATURES:
        bins = sorted(b for g, b in sums if g == f)
        total = [sum(sums[f, b][k] for b in bins) for k in (0, 1)]
        left = [0.0, 0.0]
        for b in bins[:-1]:
            left = [left[k] + sums[f, b][k] for k in (0, 1)]
            right = [total[k] - left[k] for k in (0, 1)]
            gain = sum(s * s / (h + RIDGE) for s, h in (left, right)) - total[0] ** 2 / (total[1] + RIDGE)
            if best is None or gain > best[0] + 1e-12:
                best = (gain, f, b, tuple(left), tuple(right))
    return best


def _value(sums: tuple[float, float]) -> dict:
    return {"leaf": STEP * sums[0] / (sums[1] + RIDGE)}


def _level(rows: DataFrame, score: Column, node: Column) -> dict[int, dict]:
    """Gradient sums per node, feature and bin: nodes * features * bins rows."""
    p = 1 / (1 + F.exp(-score))
    stacked = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col("b_" + f).alias("b")) for f in FEATURES]))
    got = rows.select((F.col("y") - p).alias("g"), (p * (1 - p)).alias("h"), node.alias("node"), stacked.alias("x")) \
        .groupBy("node", "x.f", "x.b").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
    out: dict[int, dict] = {}
    for r in got:
        out.setdefault(r["node"], {})[r["f"], r["b"]] = (r["g"], r["h"])
    return out


def suffix_statistics(pages: DataFrame) -> tuple[DataFrame, int, float | None]:
    """(suffix, suffix_rate and suffix_share of all pages; number and block rate of the labelled ones)."""
    counts = stage(pages.groupBy("suffix").agg(
        F.count(F.lit(1)).alias("n"), F.count("y").alias("labelled"), F.sum("y").alias("blocked")), "url-suffixes")
    total = counts.agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "blocked")]).first()
    if not total["labelled"]:
        return counts, 0, None
    prior = total["blocked"] / total["labelled"]
    return counts.select(
        "suffix", ((F.coalesce("blocked", F.lit(0.0)) + 5 * prior) / (F.col("labelled") + 5)).alias("suffix_rate"),
        (F.col("n") / total["n"]).alias("suffix_share")), total["labelled"], prior


def train(pages: DataFrame) -> tuple[DataFrame | None, list[Column], Column]:
    """(suffix statistics, bins, score expression) from rows with lexical features and y, null where no rule fits."""
    suffixes, n, prior = suffix_statistics(pages)
    if not n:
        return None, [], F.lit(-1.0)
    share = min(1.0, TRAIN_ROWS / n)
    sample = stage(pages.where(F.col("y").isNotNull() & (
        F.pmod(F.xxhash64("url", "page_id"), F.lit(1_000_000)) < share * 1_000_000)), "url-train")
    total = sample.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("y")).first()
    if not total["n"]:
        return None, [], F.lit(-1.0)
    rows = _with_suffix(sample, suffixes)
    at = [k / BINS for k in range(1, BINS)]
    cuts = rows.agg(*[F.percentile_approx(f, at, 1000).alias(f) for f in FEATURES]).first()
    bins = [_bin(f, sorted(set(cuts[f]))).alias("b_" + f) for f in FEATURES]
    rows = stage(rows.select("y", *bins), "url-bins")
    prior = min(max(total["y"], 1e-3), 1 - 1e-3)
    score = F.lit(math.log(prior / (1 - prior)))
    for _ in range(ROUNDS):
        top = _level(rows, score, F.lit(0)).get(0, {})
        root = _best(top)
        if root is None or root[0] <= 1e-9:
            break
        _, f, b, left, right = root
        below = _level(rows, score, F.when(F.col("b_" + f) <= b, 0).otherwise(1))
        tree = {"feature": f, "bin": b}
        for side, node, sums in (("left", 0, left), ("right", 1, right)):
            split = _best(below.get(node, {}))
            tree[side] = _value(sums) if split is None or split[0] <= 1e-9 else {
                "feature": split[1], "bin": split[2], "left": _value(split[3]), "right": _value(split[4])}
        score = score + _leaf(tree)
    return suffixes, bins, score


def _with_suffix(rows: DataFrame, suffixes: DataFrame, most: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Suffix statistics, broadcast if they are ``most`` rows at most.  Of more, those
    with a share over 1 / ``most`` are broadcast and the others, none of them hot, shuffled."""
    s = suffixes.withColumnRenamed("suffix", "__s")
    fits = F.col("suffix") == F.col("__s")
    if s.count() <= most:
        return rows.join(F.broadcast(s), fits, "left").drop("__s")
    hot = F.broadcast(s.where(F.col("suffix_share") * most >= 1))
    rare = s.where(F.col("suffix_share") * most < 1).hint("merge")
    return rows.join(hot, fits).unionByName(rows.join(hot, fits, "left_anti").join(rare, fits, "left")).drop("__s")


def judge_urls(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict and the model's block probability."""
    p = lexical(with_rule(pages))
    p = p.withColumn("y", (F.col("rule_verdict") == "block").cast("double"))
    suffixes, bins, score = train(p)
    if suffixes is not None:
        p = _with_suffix(p, suffixes).select("*", *bins)
    p = p.withColumn("block_probability", 1 / (1 + F.exp(-score)))
    return p.select("page_id", "host", "path", "rule", F.coalesce(
        "rule_verdict", F.when(F.col("block_probability") > 0.5, "block").otherwise("allow")).alias("verdict"),
        "block_probability")
