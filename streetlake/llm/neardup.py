"""Near-duplicate detection with MinHash bands and odd sketches.

Every text becomes the set of its word shingles (64-bit hashes).  Rows with
equal sets form a class, and classes are compared, not copies.  MinHash
samples of a set are cut into bands; classes that share a band are candidates.
All samples are also folded into an odd sketch, a bitmap in which each sample
flips one bit: the population count of the XOR of two sketches estimates high
similarities well, and rules out most candidates before a text is moved.

Within a band's group not all pairs are made.  The class that meets most
others is the group's hub; every member is checked against it on full sets.
Once those links are joined into components, only members outside the hub's
component can still bring a new connection; they are compared with all members
of the hub on full sets, in cells of bounded size that return links between
different components and nothing else.  So nothing is capped: a link
of the stated similarity is missed only if no band meets, and the number of
bands is chosen so that the odds of that are under ``MISS`` for a pair exactly
at the threshold.  A link that only repeats a connection already proven is not
checked.

Defined results: null or empty text has no shingles, links with nothing and is
its own component; a text with fewer words than a shingle is one shingle; a
row without a doc_id has no component and is kept; repeated rows fall into one
class; rows with one doc_id and different texts are compared each, and the
component of each is the smallest doc_id that its own text reaches; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetlake.llm.common import attach_groups, rows_of, ship_package, stage, text_bytes

ROWS = 4                # MinHash samples of a band
SAMPLES = 128           # samples of the odd sketch, at least
SKETCH = 512            # its bits
MISS = 1e-7
BLOCK = 128             # members of a hub on each side of a cell
LONGS = [f"s{i}" for i in range(SKETCH // 64)]
_U = np.uint64


def n_bands(similarity: float) -> int:
    """Bands after which a pair at the threshold goes unmet with odds under MISS."""
    return math.ceil(math.log(MISS) / math.log(1 - similarity ** ROWS))


def n_samples(similarity: float) -> int:
    return max(SAMPLES, ROWS * n_bands(similarity))


def sketch_limit(similarity: float) -> int:
    """Largest XOR count of two sketches at the threshold, but for odds of about MISS.

    D samples differ in a pair (binomial); 2 D flips leave about
    N/2 (1 - exp(-4 D / N)) odd bits.
    """
    k = n_samples(similarity)
    differ = k * (1 - similarity) + 5.2 * math.sqrt(k * similarity * (1 - similarity))
    odd = SKETCH / 2 * (1 - math.exp(-4 * differ / SKETCH))
    return math.ceil(odd + 2 * math.sqrt(odd))


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=_U) * _U(2) + _U(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(29))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(32))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(29))


class Shingler:
    """Texts (UTF-8) to sorted arrays of distinct shingle hashes."""

    def __init__(self, width: int, limit: int = 400_000):
        self.width, self.limit = width, limit
        self.known: dict[bytes, int] = {}
        self.factors = _odd(3, width)

    def words(self, text: bytes) -> np.ndarray:
        ws = text.lower().split()
        new = set(ws).difference(self.known)
        if len(self.known) + len(new) > self.limit:
            self.known.clear()
            new = set(ws)
        for w in new:
            self.known[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        return np.fromiter(map(self.known.__getitem__, ws), _U, len(ws))

    def shingles(self, text: bytes) -> np.ndarray:
        w = self.words(text)
        if not len(w):
            return w
        if len(w) < self.width:                 # the whole sequence; its length is part of it
            h = np.array([len(w)], _U)
            for x in w:
                h = _mix(h * _U(0x9E3779B97F4A7C15) + x)
            return h
        n = len(w) - self.width + 1
        h = np.zeros(n, _U)
        for j in range(self.width):
            h += w[j:j + n] * self.factors[j]
        return np.unique(_mix(h))


def signatures(sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(bands, sketches) of non-empty sets."""
    k, bands = n_samples(similarity), n_bands(similarity)
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    least = np.empty((len(sets), k), _U)
    scratch = np.empty_like(flat)
    for i, a in enumerate(_odd(5, k)):
        np.multiply(flat, a, out=scratch)
        least[:, i] = np.minimum.reduceat(scratch, starts)
    folded = least[:, :bands * ROWS].reshape(len(sets), bands, ROWS)
    key = np.arange(1, bands + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)
    for j in range(ROWS):
        key = _mix(key + folded[:, :, j])
    bit = (_mix(least + np.arange(1, k + 1, dtype=_U) * _U(0xD1B54A32D192ED03)) >> _U(64 - 9)).astype(np.int64)
    cell = np.arange(len(sets))[:, None] * SKETCH + bit
    odd = (np.bincount(cell.ravel(), minlength=len(sets) * SKETCH) & 1).astype(np.uint8)
    return key.astype(np.int64), np.packbits(odd).view(np.int64).reshape(len(sets), -1)


def _sets_of(shingler: Shingler, batch: pa.RecordBatch, column: int) -> list[np.ndarray]:
    return [shingler.shingles(x.as_py()) for x in batch.column(column)]


def sketch_rows(docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """Per row: id, hash of its text, set size, hash of its set, bands, sketch."""
    ship_package(docs.sparkSession)
    names = ["doc_id", "text_hash", "n", "k1", "k2", "bands", *LONGS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for whole in batches:
            for b in rows_of(whole, 128):
                sets = _sets_of(shingler, b, 2)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                keys = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                full = [i for i, s in enumerate(sets) if len(s)]
                bands: list = [None] * len(sets)
                sketch = np.zeros((len(sets), len(LONGS)), np.int64)
                if full:
                    found, sketch[full] = signatures([sets[i] for i in full], similarity)
                    for i, row in zip(full, found):
                        bands[i] = row
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(bands, pa.list_(pa.int64())),
                     *[pa.array(sketch[:, i]) for i in range(len(LONGS))]], names=names)

    schema = "doc_id long, text_hash long, n long, k1 long, k2 long, bands array<long>, " \
        + ", ".join(f"{c} long" for c in LONGS)
    text = text_bytes("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       text.alias("text")).mapInArrow(run, schema)


def odd_bits(a: str, b: str) -> Column:
    """Population count of the XOR of two sketches."""
    one = lambda c: F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}")))
    out = one(LONGS[0])
    for c in LONGS[1:]:
        out = out + one(c)
    return out


def can_link(a: str, b: str, similarity: float) -> Column:
    """Whether sizes and sketches allow the similarity (sizes bound it exactly)."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (F.least(na, nb) >= similarity * F.greatest(na, nb) * (1 - 1e-12)) \
        & (odd_bits(a, b) <= sketch_limit(similarity))


def fetch_texts(nodes: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text) of the classes' representatives, staged; rows that repeat one are one text."""
    wanted = classes.select("node", "doc_id", "text_hash").join(nodes, "node", "left_semi")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes("text").alias("text")) \
        .withColumn("text_hash", F.xxhash64("text")).join(wanted, ["doc_id", "text_hash"]) \
        .dropDuplicates(["doc_id", "text_hash"])
    return stage(texts.select("node", "text"), "neardup-texts")


def check_pairs(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """Exact similarity of pairs (a, b) of classes: a, b, shared, total.

    Texts of the classes concerned are fetched once; rows come sorted by a, so
    a hub's set is built once per run of its pairs.
    """
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    texts = fetch_texts(nodes, classes, docs)
    ta = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    tb = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    both = pairs.select("a", "b").join(tb, "b").join(ta, "a").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        last, kept = None, np.zeros(0, _U)
        for whole in batches:
            for r in rows_of(whole, 256):
                out = []
                for i, a in enumerate(r.column(0).to_pylist()):
                    ta = r.column(2)[i].as_py()
                    if (a, ta) != last:
                        last, kept = (a, ta), shingler.shingles(ta)
                    other = shingler.shingles(r.column(3)[i].as_py())
                    shared = len(np.intersect1d(kept, other, assume_unique=True))
                    out.append((shared, len(kept) + len(other) - shared))
                if out:
                    shared, total = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [r.column(0), r.column(1), pa.array(shared, pa.int64()), pa.array(total, pa.int64())],
                        names=["a", "b", "shared", "total"])

    checked = both.mapInArrow(run, "a long, b long, shared long, total long")
    return stage(checked, "neardup-checked")


def in_cells(met: DataFrame) -> DataFrame:
    """Members of hubs dealt to cells (hub, r, c) of BLOCK by BLOCK, so that no
    task holds a large group: members outside the hub's component (``asks``)
    meet all members."""
    met = stage(met, "met")
    sizes = met.groupBy("hub").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("outer"), 1)).alias("n_outer")) \
        .where("n > 1 and n_outer > 0").select(
            "hub", F.ceil(F.col("n") / BLOCK).cast("int").alias("cols"),
            F.ceil(F.col("n_outer") / BLOCK).cast("int").alias("rows"), F.col("n").alias("members"))
    met = stage(attach_groups(met, stage(sizes, "met-sizes"), "hub", "members").where("members is not null"), "met")
    place = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["hub", "node", "component", "outer"]
    one = met.where("outer").select(*columns, F.lit(True).alias("asks"), place("rows").alias("r"),
                                    every("cols").alias("c"))
    return one.unionByName(met.select(*columns, F.lit(False).alias("asks"), every("rows").alias("r"),
                                      place("cols").alias("c")))


def may_link(cells: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """(hub, node) of members whose size and sketch allow a link in some cell to another component."""
    limit = sketch_limit(similarity)

    def cell(t: pa.Table) -> pa.Table:
        asks = t.column("asks").to_numpy(zero_copy_only=False)
        ask, other = np.flatnonzero(asks), np.flatnonzero(~asks)
        kept = np.zeros(t.num_rows, bool)
        if len(ask) and len(other):
            comps, n = t.column("component").to_numpy(), t.column("n").to_numpy()
            sketch = np.stack([t.column(c).to_numpy() for c in LONGS], 1).view(_U)
            for i in ask:
                rest = other[comps[other] != comps[i]]
                rest = rest[np.minimum(n[rest], n[i]) >= similarity * np.maximum(n[rest], n[i]) * (1 - 1e-12)]
                odd = np.bitwise_count(sketch[rest] ^ sketch[i]).sum(1, dtype=np.int64)
                rest = rest[odd <= limit]
                kept[rest] = True
                kept[i] |= len(rest) > 0
        at = np.flatnonzero(kept)
        return t.select(["hub", "node"]).take(pa.array(at))

    rows = cells.select("hub", "r", "c", "node", "component", "asks").join(classes.select("node", "n", *LONGS), "node")
    return stage(rows.groupBy("hub", "r", "c").applyInArrow(cell, "hub long, node long").distinct(), "may-link")


def cross_links(spokes: DataFrame, found: DataFrame, classes: DataFrame, docs: DataFrame, width: int,
                percent: int) -> DataFrame:
    """Links between members of one hub that lie in different components: (a, b).

    Sizes and sketches are compared first; only members that may link to
    another component meet again with their texts.  A cell then numbers the
    shingles it holds; one pass over them gives the exact intersections of a
    set with all others.  Per set and component one link is enough.
    """
    hub_component = found.select(F.col("node").alias("hub"), F.col("component").alias("of_hub"))
    met = stage(spokes.where("node != hub").join(found, "node", "left"), "met").join(hub_component, "hub", "left") \
        .select("hub", "node", F.coalesce("component", "node").alias("component"),
                (F.coalesce("component", "node") != F.coalesce("of_hub", "hub")).alias("outer"))
    met = stage(met, "met")
    likely = may_link(in_cells(met), classes, percent / 100)
    again = in_cells(met.join(likely, ["hub", "node"]))
    cells = again.join(fetch_texts(likely.select("node").distinct(), classes, docs), "node")

    def cell(t: pa.Table) -> pa.Table:
        shingler, out = Shingler(width), []
        asks = t.column("asks").to_numpy(zero_copy_only=False)
        nodes, comps = t.column("node").to_numpy(), t.column("component").to_numpy()
        ask, other = np.flatnonzero(asks), np.flatnonzero(~asks)
        if len(ask) and len(other):
            sets = [shingler.shingles(x.as_py()) for x in t.column("text")]
            sizes = np.array([len(x) for x in sets])
            codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
            ends = np.cumsum(sizes)
            held = np.concatenate([codes[ends[i] - sizes[i]:ends[i]] for i in other])
            starts = np.concatenate([[0], np.cumsum(sizes[other])[:-1]])
            flag = np.zeros(codes.max() + 1, bool)
            for i in ask:
                mine = codes[ends[i] - sizes[i]:ends[i]]
                flag[mine] = True
                shared = np.add.reduceat(flag[held], starts, dtype=np.int64)
                flag[mine] = False
                total = sizes[i] + sizes[other] - shared
                hit = other[(100 * shared >= percent * total) & (comps[other] != comps[i])]
                out += [(nodes[i], nodes[j]) for j in hit[np.unique(comps[hit], return_index=True)[1]]]
        a, b = zip(*out) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return stage(cells.groupBy("hub", "r", "c").applyInArrow(cell, "a long, b long").distinct(), "cross-links")


def components(links: DataFrame) -> DataFrame:
    """(node, component): smallest node reachable over links (a, b).

    Labels take the least label of their neighbours, then that of the node
    they point to, until none changes.
    """
    edges = stage(links.select(F.col("a").alias("src"), F.col("b").alias("dst"))
                  .union(links.select("b", "a")).distinct(), "cc-edges")
    lab = stage(edges.groupBy("src").agg(F.min("dst").alias("m"))
                .select(F.col("src").alias("node"), F.least("src", "m").alias("component")), "cc")
    while True:
        near = edges.join(lab.withColumnRenamed("node", "dst"), "dst").groupBy("src").agg(F.min("component").alias("m"))
        new = stage(lab.join(near, F.col("node") == F.col("src")).select(
            "node", F.col("component").alias("old"), F.least("component", "m").alias("component")), "cc")
        up = new.select(F.col("node").alias("u"), F.col("component").alias("top"))
        lab = stage(new.join(up, F.col("component") == F.col("u"), "left").select(
            "node", F.least("component", "top").alias("component"), "old"), "cc")
        moved = lab.where("old > component").limit(1).count()
        lab = lab.drop("old")
        if not moved:
            return lab


def near_duplicates(docs: DataFrame, width: int = 3, percent: int = 85) -> DataFrame:
    """Per row: doc_id, text_hash, n_shingles, component_id, kept.

    Links hold where 100 * intersection >= ``percent`` * union.
    """
    t = percent / 100
    rows = stage(sketch_rows(docs, width, t), "sketches")
    classes = rows.where("n > 0 and doc_id is not null").groupBy("k1", "k2").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("m"), F.first("n").alias("n"),
        F.first("bands").alias("bands"), F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in LONGS])
    # classes are numbered: ids of documents may repeat with other texts
    classes = stage(classes.select(
        F.monotonically_increasing_id().alias("node"), F.col("m.doc_id").alias("doc_id"),
        F.col("m.text_hash").alias("text_hash"), F.struct("k1", "k2").alias("key"), "copies", "n", "bands", *LONGS),
        "classes")
    sketches = classes.select("node", "n", *LONGS)
    banded = classes.select("node", F.explode("bands").alias("band"))
    groups = stage(banded.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "bands")
    members = stage(banded.join(groups, "band"), "members")
    weights = stage(members.groupBy("node").agg(F.sum("size").alias("weight")), "weights")
    hubs = members.join(weights, "node").groupBy("band") \
        .agg(F.max(F.struct(F.col("weight"), (-F.col("node")).alias("minus"))).alias("x")) \
        .select("band", (-F.col("x.minus")).alias("hub"))
    spokes = stage(members.select("band", "node").join(stage(hubs, "hubs"), "band"), "spokes")

    def linked(checked: DataFrame) -> DataFrame:
        return checked.where(F.col("shared") * 100 >= F.col("total") * percent).select("a", "b")

    star = spokes.where("node != hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    near = star.join(sketches.alias("x"), F.col("a") == F.col("x.node")) \
        .join(sketches.alias("y"), F.col("b") == F.col("y.node")).where(can_link("x", "y", t)).select("a", "b")
    checked = check_pairs(stage(near, "star"), classes, docs, width)
    links = linked(checked)
    found = components(links)

    more = cross_links(spokes.select("hub", "node").distinct(), found, classes, docs, width, percent)
    if more.limit(1).count():
        found = components(links.union(more))

    member = stage(classes.select("node", "doc_id", "key", "copies").join(found, "node", "left").select(
        "doc_id", "key", "copies", F.coalesce("component", "node").alias("component")), "neardup-members")
    labels = member.groupBy("component").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("size"))
    named = attach_groups(member, stage(labels, "neardup-labels"), "component", "size").select("key", "copies", "least")
    ids = rows.select("doc_id", "text_hash", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.struct("k1", "k2")).alias("key"))
    out = attach_groups(ids, stage(named, "neardup-named"), "key", "copies")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component; rows without an id all stay."""
    keep = stage(near_duplicates(docs, width, percent).where("kept and doc_id is not null")
                 .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct(), "kept")
    names = docs.columns
    d = docs.withColumn("__id", F.col("doc_id").cast("long")).withColumn("__hash", F.xxhash64(text_bytes("text")))
    named = d.where("doc_id is not null").join(keep, ["__id", "__hash"], "left_semi") \
        .dropDuplicates(["__id", "__hash"])
    return named.select(*names).unionByName(docs.where("doc_id is null"))
