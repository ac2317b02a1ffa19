"""How the word use of sources differs, from a quadtree over the count matrix.

Terms are runs of letters; a language keeps the terms of at least ``MIN_DOCS``
of its documents.  Every (language, source) group and every language prices
each kept term by a smoothed share, and two prices differ by
floor((p - q)^2 / q), summed over all kept terms for pairs of sources.

The matrix of groups and kept terms is mostly zeros.  Its columns are dealt by
hash to blocks, its rows to tiles, and a cell of two tiles and a block holds a
K^2-tree (K = 2) for each tile: bitmaps in which a quadrant without counts has
no node.  Both trees are descended together for all pairs of their groups at
once; where neither has a node the whole quadrant is priced by one product,
since a term that a group lacks always has the same price there, and only
leaves with a count on either side are priced one by one.  Cells are bounded
by ``ROWS`` and ``COLUMNS``, so a language with a third of all documents gives
more cells, not larger ones.

All arithmetic is exact: a price is a long division in three steps of a
thousand, so no product leaves 64 bits while a group has under 9e15 words.

Defined results: null text, lang and source are empty strings; a document is a
row, so repeated rows count each; a group without terms has prices like any
other; a language without kept terms gives pairs of value 0 and no terms; a
very long text is counted in pieces; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streetlake.llm.common import MAX_BROADCAST_ROWS, ship_package, stage, text_bytes

MIN_DOCS = 3
TOP_TERMS = 200
SCALE_STEPS = 3             # prices are shares of 1000 ** 3
ROWS = 32                   # expected groups of a tile
COLUMNS = 1024              # expected kept terms of a block
CELLS_PER_TASK = 8
MAX_TASKS = 20_000
HELD = 400_000              # (group, term) counts a task holds before it hands them on
PIECE = 1 << 20             # bytes of text counted at once

# Letters, lower-cased from A to Z; every other ASCII byte ends a term.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, those of about PIECE bytes at a time."""
    at = 0
    while at < len(text):
        end = at + PIECE
        part = text[at:end].translate(FOLD)
        while end < len(text) and part[-1:] != b" ":        # to the end of the term
            more = text[end:end + 4096].translate(FOLD)
            stop = more.find(b" ")
            part += more if stop < 0 else more[:stop + 1]
            end += len(more) if stop < 0 else stop + 1
        yield part.split()
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n occurrences, df documents); a null term stands for the group itself.

    Tasks count before they hand on, so a term comes at most once per source
    and hand-over; one shuffle by (lang, term) then serves the sums and the
    window over a term's sources.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, tuple[Counter, Counter]] = {}
        held = 0

        def hand_on() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, df) in counts.items():
                yield _rows(lang, source, [None], [0], [0])
                terms = list(n)
                for at in range(0, len(terms), 50_000):
                    some = terms[at:at + 50_000]
                    yield _rows(lang, source, some, [n[t] for t in some], [df[t] for t in some])
            counts.clear()

        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, key in enumerate(zip(langs, sources)):
                if key not in counts:
                    counts[key] = (Counter(), Counter())
                n, df = counts[key]
                before, seen = len(n), set()
                for words in pieces(batch.column(2)[i].as_py()):
                    n.update(words)
                    seen.update(words)
                df.update(seen)
                held += len(n) - before + 1
                if held > HELD:
                    yield from hand_on()
                    held = 0
        yield from hand_on()

    def _rows(lang, source, terms, n, df) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
             pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(df, pa.int64())],
            names=["lang", "source", "term", "n", "df"])

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(text("lang").alias("lang"), text("source").alias("source"), text_bytes("text").alias("text")) \
        .mapInArrow(run, "lang string, source string, term string, n long, df long") \
        .repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Counts of kept terms with ``n_lang``, and ``first``, true in one row of each (lang, term)."""
    of_term = Window.partitionBy("lang", "term")
    return term_counts(docs).select(
        "lang", "source", "term", "n", F.sum("df").over(of_term).alias("df_lang"),
        F.sum("n").over(of_term).alias("n_lang"), (F.min("source").over(of_term) == F.col("source")).alias("first")) \
        .where((F.col("df_lang") >= min_docs) | F.col("term").isNull()).drop("df_lang")


def price_sql(count: str, total: str) -> Column:
    """1 + floor(1000^3 * count / total) for count <= total, in longs."""
    rest, out = f"({count})", []
    for k in range(SCALE_STEPS):
        out.append(f"({rest} * 1000L) div {total} * {1000 ** (SCALE_STEPS - 1 - k)}L")
        rest = f"(({rest} * 1000L) % {total})"
    return F.expr(f"1L + {' + '.join(out)}")


def price(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(1000^3 * count / total) for count <= total, in longs."""
    out, rest = np.zeros(np.broadcast(count, total).shape, np.int64), count
    for _ in range(SCALE_STEPS):
        whole, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + whole
    return out + 1


def differ(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class K2Tree:
    """Bitmaps of the nonempty quadrants of a 2^height square matrix.

    ``bits[l]`` has four bits for each node of level l, in order (upper left,
    upper right, lower left, lower right); the i-th set bit is node i of the
    next level.  Nodes of the last level are the nonzero cells.
    """

    def __init__(self, rows: np.ndarray, cols: np.ndarray, height: int):
        code = np.zeros(len(rows), np.int64)
        for b in range(height):
            code |= ((rows >> b & 1) << (2 * b + 1)) | ((cols >> b & 1) << (2 * b))
        self.order = np.argsort(code)           # leaf i is entry order[i]
        code, self.bits, self.rank = code[self.order], [], []
        for level in range(height):
            below = np.unique(code >> 2 * (height - level - 1))
            nodes = np.unique(below >> 2)
            bits = np.zeros(4 * len(nodes), bool)
            bits[4 * np.searchsorted(nodes, below >> 2) + (below & 3)] = True
            self.bits.append(bits)
            self.rank.append(np.cumsum(bits) - 1)

    def child(self, level: int, node: np.ndarray, quadrant: int) -> np.ndarray:
        """Number of the child on the next level, -1 where the quadrant is empty."""
        out = np.full(len(node), -1, np.int64)
        there = node >= 0
        at = 4 * node[there] + quadrant
        out[there] = np.where(self.bits[level][at], self.rank[level][at], -1)
        return out


def joint_leaves(one: K2Tree, other: K2Tree, n_one: int, n_other: int, n_cols: int, height: int) \
        -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Both trees descended together, for all pairs of their rows at once (of
    a tree with itself: for pairs of an earlier and a later row).

    Returns row and leaf of the first, row and leaf of the second for every
    pair of rows and column with a count on either side (leaf -1: no count),
    and how many columns of each pair lie in quadrants that both lack.
    """
    empty = np.zeros((n_one + 1, n_other + 1), np.int64)        # differences along both axes
    a = b = c = np.zeros(1, np.int64)
    ka = np.array([0 if len(one.order) else -1])
    kb = np.array([0 if len(other.order) else -1])

    def skip(a, b, c, size) -> None:
        width = np.minimum(size, n_cols - c * size)
        a0, a1 = a * size, np.minimum((a + 1) * size, n_one)
        b0, b1 = b * size, np.minimum((b + 1) * size, n_other)
        for x, y, sign in ((a0, b0, 1), (a1, b0, -1), (a0, b1, -1), (a1, b1, 1)):
            np.add.at(empty, (x, y), sign * width)

    for level in range(height):
        if level == 0 and ka[0] < 0 and kb[0] < 0:
            skip(a, b, c, 1 << height)
            a = b = c = ka = kb = np.zeros(0, np.int64)
        size, parts = 1 << (height - level - 1), []
        for dc in (0, 1):
            cc = 2 * c + dc
            for da in (0, 1):
                aa, child_a = 2 * a + da, one.child(level, ka, 2 * da + dc)
                for db in (0, 1):
                    bb, child_b = 2 * b + db, other.child(level, kb, 2 * db + dc)
                    inside = (cc * size < n_cols) & (aa * size < n_one) & (bb * size < n_other)
                    if one is other:
                        inside &= aa < bb if size == 1 else aa <= bb
                    nothing = inside & (child_a < 0) & (child_b < 0)
                    if nothing.any():
                        skip(aa[nothing], bb[nothing], cc[nothing], size)
                    go = inside & ~nothing
                    parts.append((aa[go], bb[go], cc[go], child_a[go], child_b[go]))
        a, b, c, ka, kb = (np.concatenate(x) for x in zip(*parts))
    return a, ka, b, kb, empty.cumsum(0).cumsum(1)[:-1, :-1]


def cell_values(one: tuple, other: tuple, n_cols: int) -> tuple[np.ndarray, np.ndarray]:
    """Summed differences in a cell, first to second and second to first.

    A side is (total of each row, row, column and count of its nonzero cells);
    of a side with itself only pairs of an earlier and a later row are summed.
    """
    height = max(int(max(n_cols, len(one[0]), len(other[0]), 2) - 1).bit_length(), 1)
    trees = [K2Tree(one[1], one[2], height)]
    trees.append(trees[0] if other is one else K2Tree(other[1], other[2], height))
    a, ka, b, kb, empty = joint_leaves(*trees, len(one[0]), len(other[0]), n_cols, height)
    prices = []
    for (totals, rows, _, counts), tree, row, leaf in ((one, trees[0], a, ka), (other, trees[1], b, kb)):
        none = price(np.ones(len(totals), np.int64), totals)
        held = price(counts[tree.order] + 1, totals[rows[tree.order]])
        at = none[row]
        at[leaf >= 0] = held[leaf[leaf >= 0]]
        prices.append((none, at))
    (za, pa_), (zb, pb) = prices
    there = empty * differ(za[:, None], zb[None, :])
    back = empty * differ(zb[None, :], za[:, None])
    np.add.at(there, (a, b), differ(pa_, pb))
    np.add.at(back, (a, b), differ(pb, pa_))
    return there, back


def _cell(key: tuple, entries: pa.Table, about: pa.Table) -> pa.Table:
    """Values of the pairs of groups of one cell."""
    lang, _, i, j = (k.as_py() for k in key)
    info = about.to_pylist()[0] if about.num_rows else None
    out: list[tuple] = []
    if info is not None:
        terms = entries.column("term").combine_chunks().dictionary_encode() if entries.num_rows else None
        cols = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64) if terms is not None else np.zeros(0, int)
        tile = entries.column("tile").to_numpy()
        sources = entries.column("source").to_pylist()
        counts = entries.column("n").to_numpy()
        sides, names = [], []
        for t, members in ((i, info["rows_i"]), (j, info["rows_j"])):
            if sides and i == j:
                sides, names = sides * 2, names * 2
                break
            names.append([m["source"] for m in members])
            number = {s: k for k, s in enumerate(names[-1])}
            mine = np.flatnonzero(tile == t)
            rows = np.array([number[sources[k]] for k in mine], np.int64)
            sides.append((np.array([m["total"] for m in members], np.int64), rows, cols[mine],
                          counts[mine].astype(np.int64)))
        there, back = cell_values(*sides, info["n_cols"])
        for x, s in enumerate(names[0]):
            for y, o in enumerate(names[1]):
                if i != j or x < y:
                    out += [(lang, s, o, int(there[x, y])), (lang, o, s, int(back[x, y]))]
    columns = list(zip(*out)) or [(), (), (), ()]
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.string(), pa.int64()))],
                    names=["lang", "source", "item", "value"])


def attach(rows: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` joined with a staged table that is broadcast only if its counted size allows."""
    return rows.join(F.broadcast(small) if small.count() <= MAX_BROADCAST_ROWS else small, on)


def pair_values(counts: DataFrame, groups: DataFrame, langs: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of sources of a language."""
    placed = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    entries = attach(counts.where("term IS NOT NULL").select("lang", "source", "term", "n", "first"), langs, ["lang"]) \
        .withColumn("block", placed("term", "n_blocks")).withColumn("tile", placed("source", "n_tiles"))
    blocks = entries.where("first").groupBy("lang", "block").agg(F.count(F.lit(1)).alias("n_cols")) \
        .unionByName(langs.where("v = 0").select("lang", F.lit(0).alias("block"), F.lit(0).cast("long").alias("n_cols")))
    tiles = stage(attach(groups, langs.select("lang", "n_tiles"), ["lang"])
                  .groupBy("lang", placed("source", "n_tiles").alias("tile"))
                  .agg(F.sort_array(F.collect_list(F.struct("source", "total"))).alias("rows")), "divergence-tiles")
    side = lambda name: tiles.select("lang", F.col("tile").alias(name), F.col("rows").alias(f"rows_{name}"))
    about = stage(blocks, "divergence-blocks").join(side("i"), "lang").join(side("j"), "lang").where("i <= j")
    cells = entries.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("n_tiles") - 1))).select(
        "lang", "block", F.least("tile", "with").alias("i"), F.greatest("tile", "with").alias("j"),
        "tile", "source", "term", "n")
    key = ["lang", "block", "i", "j"]
    # cells hold few bytes and much work: their number, not their size, sets the number of tasks
    n_cells = langs.agg(F.expr("sum(n_blocks * (n_tiles * (n_tiles + 1L) div 2))")).first()[0] or 0
    tasks = min(max(-(-n_cells // CELLS_PER_TASK), 1), MAX_TASKS)
    part = cells.repartition(tasks, *key).groupBy(*key).cogroup(about.repartition(tasks, *key).groupBy(*key)) \
        .applyInArrow(_cell, "lang string, source string, item string, value long")
    return part.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_values(counts: DataFrame, groups: DataFrame, langs: DataFrame) -> DataFrame:
    """(lang, source, item, value) of kept terms that a group uses more than its language does."""
    known = attach(counts.where("term IS NOT NULL AND n > 0").select("lang", "source", "term", "n", "n_lang"),
                   groups, ["lang", "source"])
    known = attach(known, langs.select("lang", F.col("total").alias("total_lang")), ["lang"])
    priced = known.withColumn("p", price_sql("n + 1", "total")).withColumn("q", price_sql("n_lang + 1", "total_lang"))
    return priced.where("p > q").select(
        "lang", "source", F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div q").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank."""
    counts = stage(kept_counts(docs, min_docs), "divergence-counts")
    kept = F.col("term").isNotNull()
    langs = counts.groupBy("lang").agg(
        F.count(F.when(kept & F.col("first"), 1)).alias("v"),
        F.coalesce(F.sum(F.when(kept & F.col("first"), F.col("n_lang"))), F.lit(0)).alias("n"),
        F.count(F.when(~kept, 1)).alias("n_groups"))
    langs = stage(langs.select(
        "lang", "v", (F.col("n") + F.col("v")).alias("total"),
        F.greatest(F.ceil(F.col("v") / COLUMNS), F.lit(1)).cast("int").alias("n_blocks"),
        F.ceil(F.col("n_groups") / ROWS).cast("int").alias("n_tiles")), "divergence-langs")
    sums = counts.groupBy("lang", "source").agg(F.coalesce(F.sum(F.when(kept, F.col("n"))), F.lit(0)).alias("n"))
    # a language without kept terms prices nothing; 1 keeps its unused divisor from being 0
    groups = stage(attach(sums, langs.select("lang", "v"), ["lang"]).select(
        "lang", "source", F.greatest(F.col("n") + F.col("v"), F.lit(1)).alias("total")), "divergence-groups")

    of_group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df, part: df.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(of_group).alias("rank"))
    pairs = ranked(pair_values(counts, groups, langs.select("lang", "v", "n_blocks", "n_tiles")), "pair")
    return pairs.unionByName(ranked(term_values(counts, groups, langs), "term").where(F.col("rank") <= top))
