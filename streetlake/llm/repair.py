"""Repair of conversation structure by a grammar-compressed dynamic program.

Every row of a conversation becomes a symbol: the initial of its role and its
first fault.  Re-Pair replaces frequent pairs of symbols of all conversations
by rules.  For each symbol and, bottom-up, for each rule a min-plus transfer
matrix tells the cheapest edits that lead from one state of the wanted role
order to another; its entries carry the edits' initials as a rope that shares
its parts with the matrices below.  The matrices are made once and serve every
conversation, whose own sequence is then a short walk over them.

Order of roles, as states: 0 nothing yet, 1 after system, 2 after user, 3
after assistant; 0 and 3 may end a conversation.

A conversation of any size is cut up: rows are sorted over range partitions
(without their texts), segments of bounded length come out of them, and only
the row symbols of a conversation pass through one task.  The one thing that
must see a whole conversation in order is the digest of its repaired text; its
rows stream past a running SHA-256 and are never held.

Defined results: a null conv_id is one conversation; null turn, role or text
read as one space (rows without a turn come first); rows that share a turn
stand by role, then by SHA-256 of the text; rows repeated as a whole are
duplicates; a role of another initial than s, u or a can only be changed or
deleted; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetlake.llm.common import ship_package, stage

BLANK = " \t\n\x0b\x0c\r"
SEGMENT = 1 << 16               # symbols of a segment, at most
MAX_RULES = 64                  # rules of the grammar (it shortens sequences; what it can't shorten stays)
BATCH = 8                       # rules of a round
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

# Symbols of rows: their role's initial with a whole text, the same with a
# truncated one, and rows that must go.
WHOLE, CUT = "suax", "SUAX"
FAULTS = {"b": "blank", "d": "duplicate"}
FIRST_RULE = 0x4E00             # symbols of rules are characters from here on


# ---- the dynamic program ------------------------------------------------

class Rope:
    """Edit initials as a binary tree over shared parts."""

    __slots__ = ("left", "right", "text", "size")

    def __init__(self, text: str | None = None, left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        self.size = len(text) if text is not None else left.size + right.size

    def __add__(self, other: Rope) -> Rope:
        if self.size + other.size <= 64:
            return Rope(str(self) + str(other))
        return Rope(None, self, other)

    def __str__(self) -> str:
        if self.text is None:
            out, todo = [], [self]
            while todo:
                node = todo.pop()
                if node.text is None:
                    todo += [node.right, node.left]
                else:
                    out.append(node.text)
            return "".join(out)
        return self.text


# Output of a user or an assistant row: state before -> state after.
USER, ASSISTANT = {0: 2, 1: 2, 3: 2}, {2: 3}
# State -> states after inserted rows, and how many (a cycle of them never pays).
INSERTED = {0: {0: 0, 2: 1, 3: 2}, 1: {1: 0, 2: 1, 3: 2}, 2: {2: 0, 3: 1}, 3: {3: 0, 2: 1}}


class Transfer:
    """Cheapest edits between two states over some rows.

    ``cost[i][j]`` (None: no way), ``rope[i][j]`` and ``rank[i][j]``, the place
    of the edits among those that start in state i, in ASCII order.  Edits of
    the same rows end with a row's own edit and tell the state they lead to,
    so two of them that start alike are never equal and neither begins the
    other: appending never changes their order, and ranks decide every tie
    without reading a rope.
    """

    def __init__(self, cost: list, rope: list, rank: list):
        self.cost, self.rope, self.rank = cost, rope, rank

    def __mul__(self, other: Transfer) -> Transfer:
        cost, rope, rank = [], [], []
        for i in range(4):
            costs, ranks, back = step(self.cost[i], self.rank[i], other)
            cost.append(costs)
            rank.append(ranks)
            rope.append([None if k is None else self.rope[i][k] + other.rope[k][j] for j, k in enumerate(back)])
        return Transfer(cost, rope, rank)


def step(costs, ranks, by: Transfer) -> tuple[tuple, tuple, tuple]:
    """Costs and ranks of the four states after ``by``, and the state each came from."""
    back, cost, keys = [], [], []
    for j in range(4):
        ways = [(costs[k] + by.cost[k][j], ranks[k], k) for k in range(4)
                if costs[k] is not None and by.cost[k][j] is not None]
        best = min(ways, default=None)
        back.append(None if best is None else best[2])
        cost.append(None if best is None else best[0])
        keys.append(None if best is None else (best[1], by.rank[best[2]][j]))
    order = sorted(x for x in keys if x is not None)
    return tuple(cost), tuple(None if x is None else order.index(x) for x in keys), tuple(back)


def symbol_transfer(symbol: str) -> Transfer:
    """Inserts, then one row of this kind kept, re-roled or deleted."""
    edits = [(i, i, DELETE, "D") for i in range(4)]
    if symbol not in FAULTS:
        extra = TRUNCATED if symbol in CUT else 0
        edits += [(i, j, REROLE + extra, "R") for i, j in {**USER, **ASSISTANT}.items()]
        kept = {"s": {0: 1}, "u": USER, "a": ASSISTANT}.get(symbol.lower(), {})
        edits += [(i, j, KEEP + extra, "K") for i, j in kept.items()]
    cost, rope, rank = ([[None] * 4 for _ in range(4)] for _ in range(3))
    for i in range(4):
        best: dict[int, tuple[int, str]] = {}
        for k, n in INSERTED[i].items():
            for at, j, c, letter in edits:
                if at == k:
                    best[j] = min(best.get(j, (1 << 60, "")), (INSERT * n + c, "I" * n + letter))
        order = sorted(text for _, text in best.values())
        for j, (c, text) in best.items():
            cost[i][j], rope[i][j], rank[i][j] = c, Rope(text), order.index(text)
    return Transfer(cost, rope, rank)


def rule_transfers(rules: list[tuple[str, str]]) -> dict[str, Transfer]:
    """Transfer of every symbol and, bottom-up, of every rule (symbol, its pair)."""
    out = {c: symbol_transfer(c) for c in (*WHOLE, *CUT, *FAULTS)}
    for symbol, pair in rules:
        out[symbol] = out[pair[0]] * out[pair[1]]
    return out


class Walk:
    """States along a conversation's packed symbols, with the way back.

    Only differences of costs matter for the next step, and few occur, so
    steps are looked up in ``taken``, shared by all conversations of a worker.
    """

    def __init__(self, transfers: dict[str, Transfer], taken: dict):
        self.transfers, self.taken = transfers, taken
        self.base, self.state = 0, ((0, None, None, None), (0, None, None, None))
        self.symbols: list[str] = []
        self.backs: list[tuple] = []

    def go(self, packed: str) -> None:
        for c in packed:
            found = self.taken.get((self.state, c))
            if found is None:
                cost, rank, back = step(*self.state, self.transfers[c])
                least = min(x for x in cost if x is not None)
                found = (least, (tuple(None if x is None else x - least for x in cost), rank), back)
                self.taken[self.state, c] = found
            self.base += found[0]
            self.state = found[1]
            self.backs.append(found[2])
        self.symbols.append(packed)

    def end(self) -> tuple[int, str]:
        """Cheapest cost and edits of the whole conversation."""
        costs, ranks = self.state
        total, _, state, n = min((costs[k] + INSERT * n, ranks[k], k, n) for k in range(4) if costs[k] is not None
                                 for j, n in INSERTED[k].items() if j in (0, 3))
        out, symbols = ["I" * n], "".join(self.symbols)
        for c, back in zip(reversed(symbols), reversed(self.backs)):
            out.append(str(self.transfers[c].rope[back[state]][state]))
            state = back[state]
        return self.base + total, "".join(reversed(out))


# ---- the grammar --------------------------------------------------------

def pack_with(sequence: Column, rules: list[tuple[str, str]]) -> Column:
    """Rules applied one after the other, each from left to right."""
    for symbol, pair in rules:
        sequence = F.replace(sequence, F.lit(pair), F.lit(symbol))
    return sequence


def fit_grammar(sequences: DataFrame, max_rules: int = MAX_RULES) -> list[tuple[str, str]]:
    """Re-Pair rules (symbol, pair) for a column ``symbols``, most frequent pairs first.

    Each round counts the neighbouring pairs of all distinct sequences, weighted
    by how often a sequence stands, and replaces the ``BATCH`` most frequent in
    turn.  It ends when no pair stands twice.  Rules only shorten the work: any
    grammar gives the same repairs.
    """
    held = stage(sequences.groupBy("symbols").agg(F.count(F.lit(1)).alias("weight")), "repair-sequences")
    rules: list[tuple[str, str]] = []
    while len(rules) < max_rules:
        packed = held.select(F.filter(F.split(pack_with(F.col("symbols"), rules), ""), lambda c: c != "").alias("c"),
                             "weight").where("size(c) > 1")
        pairs = packed.select(F.explode(F.transform(
            F.sequence(F.lit(1), F.size("c") - 1),
            lambda i: F.concat(F.element_at("c", i), F.element_at("c", i + 1)))).alias("pair"), "weight")
        top = pairs.groupBy("pair").agg(F.sum("weight").alias("n")).where("n > 1") \
            .orderBy(F.desc("n"), "pair").limit(min(BATCH, max_rules - len(rules))).collect()
        if not top:
            break
        rules += [(chr(FIRST_RULE + len(rules) + k), r["pair"]) for k, r in enumerate(top)]
    return rules


# ---- rows, faults, segments ---------------------------------------------

def read_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text, nulls of the last two as one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        space("role").alias("role"), space("text").alias("text"))


def damage(rows: DataFrame) -> DataFrame:
    """The contract's damage, by the check sum of `conv_id:turn`."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    hurt = rows.withColumn("kind", kind).where("kind != 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"))
    return hurt.select("conv_id", "turn", "role", "text",
                       F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")


def text_key() -> Column:
    """Identity of a text."""
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256))


ORDER = ["conv_id", "turn", "role", "text_key"]


def faults(rows: DataFrame) -> DataFrame:
    """One row per distinct (conv_id, turn, role, text): ``n`` rows of it, and the symbol of the first of them.

    Equal rows of a turn stand side by side, so a count stands for them; a
    duplicate is a text with an earlier turn of the same role, found by one
    minimum per text and a join whose keys are unique on both sides.
    """
    solid = F.rtrim(F.col("text"), F.lit(BLANK))
    kinds = rows.select(
        "conv_id", "turn", "role", text_key().alias("text_key"), (solid == "").alias("blank"),
        (~F.right(solid, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    each = stage(kinds.groupBy(*ORDER).agg(F.count(F.lit(1)).alias("n"), F.first("blank").alias("blank"),
                                           F.first("cut").alias("cut")), "repair-rows")
    # a null turn comes first
    earliest = each.where("NOT blank").groupBy("conv_id", "role", "text_key").agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("late"), F.col("turn").alias("turn"))).alias("m")) \
        .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("text_key").alias("t"),
                F.col("m.turn").alias("at"), F.lit(True).alias("earliest"))
    marked = each.join(earliest, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
                       & (F.col("text_key") == F.col("t")) & F.col("turn").eqNullSafe(F.col("at")), "left")
    initial = F.left("role", F.lit(1))
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    symbol = F.when(F.col("blank"), "b").when(F.col("earliest").isNull(), "d") \
        .when(F.col("cut"), F.upper(known)).otherwise(known)
    return marked.select(*ORDER, "n", symbol.alias("symbol"), initial.alias("initial"))


def segments(marked: DataFrame, limit: int = SEGMENT) -> DataFrame:
    """Symbols and counts of runs of a conversation's rows, in order of (part, segment).

    Rows are sorted over range partitions, so the rows of one conversation may
    lie in several; a segment ends with its conversation, its partition, or
    ``limit`` rows.
    """
    ship_package(marked.sparkSession)
    tidy = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text_key")]
    ordered = marked.repartitionByRange(*tidy).sortWithinPartitions(*tidy) \
        .select("conv_id", "turn", "n", "symbol", "initial")
    legal = {"su", "ua", "au"}
    names = ["conv_id", "part", "segment", "symbols", "blank", "duplicate", "truncated", "illegal", "first_initial",
             "last_initial", "first_turn", "last_turn", "turns"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.string(), *[pa.int64()] * 4, pa.string(), pa.string(),
             *[pa.int64()] * 3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, now = TaskContext.get().partitionId(), 0, None

        def row_of() -> tuple:
            return (now["conv"], part, number, "".join(now["symbols"]), now["b"], now["d"], now["t"], now["illegal"],
                    now["first"], now["last"], now["first_turn"], now["last_turn"], now["turns"])

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

        for batch in batches:
            out = []
            for conv, turn, n, symbol, initial in zip(*(c.to_pylist() for c in batch.columns)):
                while n:
                    if now is None or now["conv"] != conv or now["size"] >= limit:
                        if now is not None:
                            out.append(row_of())
                            number += 1
                        now = {"conv": conv, "symbols": [], "size": 0, "b": 0, "d": 0, "t": 0, "illegal": 0,
                               "first": initial, "last": None, "first_turn": None, "last_turn": None, "turns": 0}
                    take = min(n, limit - now["size"])
                    # of equal rows all but the first are duplicates, unless they are blank
                    later = symbol if symbol in FAULTS else "d"
                    now["symbols"].append(symbol + later * (take - 1))
                    now["size"] += take
                    for mark, m in ((symbol, 1), (later, take - 1)):
                        if mark in FAULTS:
                            now[mark] += m
                        elif mark in CUT:
                            now["t"] += m
                    if now["last"] is not None and now["last"] + initial not in legal:
                        now["illegal"] += 1
                    now["illegal"] += take - 1          # a role after itself
                    now["last"] = initial
                    if turn is not None and turn != now["last_turn"]:
                        now["turns"] += 1
                        now["last_turn"] = turn
                        if now["first_turn"] is None:
                            now["first_turn"] = turn
                    n -= take
                    symbol = later
            if out:
                yield batch_of(out)
        if now is not None:
            yield batch_of([row_of()])

    return ordered.mapInArrow(
        run, "conv_id long, part int, segment long, symbols string, blank long, duplicate long, truncated long, "
             "illegal long, first_initial string, last_initial string, first_turn long, last_turn long, turns long")


def audits(found: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Counts, cost and audit of every conversation with rows, from its segments."""
    legal = {"su", "ua", "au"}
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    types = [*[pa.int64()] * 7, pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transfers = rule_transfers(rules)
        taken: dict = {}
        now: dict | None = None

        def row_of() -> tuple:
            first, last = now["first_turn"], now["last_turn"]
            gaps = 0 if first is None else last - first + 1 - now["turns"]
            return (now["conv_id"], gaps, now["blank"], now["duplicate"], now["truncated"], now["illegal"],
                    *now["walk"].end())

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if now is None or now["conv_id"] != r["conv_id"]:
                    if now is not None:
                        out.append(row_of())
                    now = {**r, "walk": Walk(transfers, taken)}
                else:
                    for c in ("blank", "duplicate", "truncated", "illegal"):
                        now[c] += r[c]
                    now["illegal"] += now["last_initial"] + r["first_initial"] not in legal
                    now["last_initial"] = r["last_initial"]
                    if r["first_turn"] is not None:
                        now["turns"] += r["turns"] - (r["first_turn"] == now["last_turn"])
                        now["last_turn"] = r["last_turn"]
                        if now["first_turn"] is None:
                            now["first_turn"] = r["first_turn"]
                now["walk"].go(r["packed"])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=columns)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row_of(), types)], names=columns)

    packed = found.withColumn("packed", pack_with(F.col("symbols"), rules)).drop("symbols")
    return packed.repartition("conv_id").sortWithinPartitions("conv_id", "part", "segment") \
        .mapInArrow(run, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
                         "cost long, audit string")


def repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): rows and their conversation's audit stream past a running digest."""
    columns = ["conv_id", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}

        def put(role: str, text: str) -> None:
            if state["n"]:
                state["hash"].update(b"\n")
            state["hash"].update(role.encode("utf-8") + b":")
            state["hash"].update(text.encode("utf-8"))
            state["n"] += 1
            state["after"] = role[:1]

        def turn_of() -> str:
            return "assistant" if state["after"] == "u" else "user"

        def insert() -> None:
            while state["audit"][state["at"]:state["at"] + 1] == "I":
                state["at"] += 1
                put(turn_of(), "")

        def end() -> tuple:
            insert()
            return state["conv"], state["hash"].hexdigest()

        for batch in batches:
            out = []
            for conv, audit, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if audit is not None:
                    if state:
                        out.append(end())
                    state.update(conv=conv, audit=audit, at=0, n=0, after="", hash=hashlib.sha256())
                    continue
                insert()
                edit = state["audit"][state["at"]]
                state["at"] += 1
                if edit == "K":
                    put(role, text)
                elif edit == "R":
                    put(turn_of(), text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=columns)
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(end(), (pa.int64(), pa.string()))],
                                             names=columns)

    lines = rows.select("conv_id", F.lit(None).cast("string").alias("audit"), "turn", "role", "text",
                        text_key().alias("text_key"))
    none = F.lit(None)
    heads = edits.select("conv_id", "audit", none.cast("long").alias("turn"), none.cast("string").alias("role"),
                         none.cast("string").alias("text"), none.cast("binary").alias("text_key"))
    # an audit comes before its rows: only there the text is null
    order = [F.col("conv_id"), F.col("text").isNotNull(), F.col("turn").asc_nulls_first(), F.col("role"),
             F.col("text_key")]
    return heads.unionByName(lines).repartition("conv_id").sortWithinPartitions(*order) \
        .select("conv_id", "audit", "role", "text").mapInArrow(run, "conv_id long, repaired_sha256 string")


def repair(conversations: DataFrame, hurt: bool = True) -> DataFrame:
    """Per conv_id: faults, cost and edits of the cheapest repair, digest of the result.

    ``hurt`` first damages the rows as the contract has it.
    """
    rows = read_rows(conversations)
    damaged = damage(rows) if hurt else rows
    found = stage(segments(faults(damaged)), "repair-segments")
    rules = fit_grammar(found.select("symbols"))
    edits = stage(audits(found, rules), "repair-audits")
    digests = repaired(damaged, edits.select("conv_id", "audit"))
    zero = F.lit(0).cast("long")
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    everyone = rows.select("conv_id").distinct()
    e = edits.withColumnRenamed("conv_id", "__e")
    d = digests.withColumnRenamed("conv_id", "__d")
    out = everyone.join(e, same("conv_id", "__e"), "left").join(d, same("conv_id", "__d"), "left")
    return out.select(
        "conv_id", *[F.coalesce(F.col(c), zero).alias(c)
                     for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
