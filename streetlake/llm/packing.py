"""Best-fit packing by minimum bin slack.

``encode_pieces`` turns texts into token pieces of at most ``capacity`` ids,
``pack`` places every piece.  Only the histogram of piece lengths (at most
``capacity`` entries, whatever the size of the corpus) reaches the driver.
There, bin after bin, the longest length left is taken and a bitset subset-sum
over the lengths still available finds the fullest feasible combination, which
is removed; a combination is used for as many bins as its lengths allow, so
the plan has about as many patterns as there are lengths.  The patterns go out
as ranges of ranks (rank of a piece among those of its length), and ranks come
from per-partition counts, so that a length shared by a third of all pieces is
never gathered in one task.

Defined results: null text is empty text (one piece, the end id); a null id
stays null; repeated rows are packed each; an empty table packs into no rows;
a very long text gives one piece per ``capacity`` ids; further columns of the
input are ignored.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from streetlake.llm.common import rows_of, ship_package, stage, text_bytes
from streetlake.llm.tokens import WHITE, byte_characters

CAPACITY = 2048

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("part", T.IntegerType()),
    T.StructField("slot", T.LongType()),
])

# Pre-tokens of byte-level vocabularies of this kind (fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# White space runs of this length are kept from the rank encoder, whose
# pattern backtracks over a run.
LONG_RUN = 20_000
LONG_WHITE = re.compile(f"[{WHITE}]{{{LONG_RUN},}}")
# A space between two words: pre-tokens begin there whatever stands before.
BETWEEN_WORDS = re.compile(f"(?<=[^{WHITE}]) (?=[^{WHITE}])")
STEP = 1 << 20              # characters encoded at once

_ENCODERS: dict[str, tuple] = {}


def portions(text: str) -> Iterator[tuple[str, bool]]:
    """Parts of a text that encode by themselves, and whether a part is a long run of white space.

    A run leaves its last character to the word behind it, as the vocabulary's
    pattern does; other parts are cut between words about every STEP characters.
    """
    def stepwise(start: int, end: int) -> Iterator[tuple[str, bool]]:
        while end - start > STEP and (m := BETWEEN_WORDS.search(text, start + STEP, end)):
            yield text[start:m.start()], False
            start = m.start()
        yield text[start:end], False

    if len(text) < LONG_RUN:
        yield text, False
        return
    at = 0
    for run in LONG_WHITE.finditer(text):
        stop = run.end() if run.end() == len(text) else run.end() - 1
        yield from stepwise(at, run.start())
        yield text[run.start():stop], True
        at = stop
    yield from stepwise(at, len(text))


def _rank_encoder(spec: str):
    """The rank-based encoder, where the ids of a vocabulary count its merges:
    they are ranks as well then, and it gives the library's ids in less time.  Else None."""
    model = json.loads(spec)
    m, pre = model["model"], model.get("pre_tokenizer") or {}
    back = {c: b for b, c in enumerate(byte_characters())}
    merges = [x.split(" ") if isinstance(x, str) else x for x in m["merges"]]
    ranked = (not model.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
              and not pre.get("add_prefix_space") and not m.get("end_of_word_suffix")
              and sorted(m["vocab"].values()) == list(range(len(m["vocab"])))
              and all(m["vocab"].get(c, 256) < 256 for c in back)
              and all(m["vocab"].get(a + b) == 256 + r for r, (a, b) in enumerate(merges)))
    if not ranked:
        return None
    import tiktoken
    ranks = {bytes(back[c] for c in t): i for t, i in m["vocab"].items()}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def _encoder(key: str, spec: str) -> tuple:
    """(library tokenizer, rank encoder or None, special strings), once per worker."""
    if key not in _ENCODERS:
        from tokenizers import Tokenizer
        tok = Tokenizer.from_str(spec)
        tok.no_truncation()
        tok.no_padding()
        special = [t.content for t in tok.get_added_tokens_decoder().values()]
        _ENCODERS[key] = (tok, _rank_encoder(spec), special)
    return _ENCODERS[key]


def encode_text(text: str, key: str, spec: str) -> bytes:
    """Ids of a text as packed little-endian 32-bit integers."""
    tok, ranked, special = _encoder(key, spec)
    if ranked is None or any(s in text for s in special):
        # a special token ends a run of white space: leave such texts whole
        return packed_ids(tok.encode(text, add_special_tokens=False).ids)
    return b"".join(packed_ids(tok.encode(part, add_special_tokens=False).ids if run else ranked(part))
                    for part, run in portions(text))


def packed_ids(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece; only the first may be shorter."""
    first = total % capacity or min(total, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, total, capacity)]


def encode_pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 0,
                  capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Token pieces of every text: PIECES, and the ids themselves if asked for.

    ``part`` and ``slot`` number the pieces of one length inside one input
    partition; ``pack`` needs the result staged, so that they stay as they are.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(spec)    # a vocabulary file: fixed size
    key, tail = tokenizer_path, np.array([end_id], "<u4").tobytes()
    schema = T.StructType(PIECES.fields + ([T.StructField("ids", T.ArrayType(T.LongType()))] if with_ids else []))
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for whole in batches:
            for batch in rows_of(whole):
                out: list[tuple] = []
                for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    packed = encode_text(raw.decode("utf-8", "replace"), key, shared.value) + tail
                    view = memoryview(packed)
                    for k, (start, length) in enumerate(cut(len(packed) // 4, capacity)):
                        body = view[4 * start:4 * (start + length)]
                        slot = seen.get(length, 0)
                        seen[length] = slot + 1
                        row = (doc_id, k, start, length, zlib.crc32(body), part, slot)
                        out.append(row + ((np.frombuffer(body, "<u4").tolist(),) if with_ids else ()))
                if out:
                    cols = list(zip(*out))
                    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(),
                             pa.list_(pa.int64())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(cols, types)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes("text").alias("text")) \
        .mapInArrow(run, schema)


def fullest(available: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(length, copies) of a combination that fills as much of ``room`` as any can.

    Bit s of ``reach`` says that some combination sums to s; a length with
    many copies joins in doubling bundles.
    """
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in available if x <= room), reverse=True):
        left, bundle = min(available[length], room // length), 1
        while left:
            n = min(bundle, left)
            steps.append((length, n, reach))
            reach |= (reach << (n * length)) & mask
            left -= n
            bundle *= 2
        if reach >> room & 1:
            break
    goal, used = reach.bit_length() - 1, {}
    for length, n, before in reversed(steps):
        if not before >> goal & 1:
            goal -= n * length
            used[length] = used.get(length, 0) + n
    return sorted(used.items(), reverse=True)


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """(number of bins, [(length, copies)]) patterns that use up ``counts``."""
    left = {n: c for n, c in counts.items() if c > 0}
    plan = []
    while left:
        top = max(left)
        left[top] -= 1
        combo = dict(fullest({n: c for n, c in left.items() if c}, capacity - top))
        left[top] += 1
        combo[top] = combo.get(top, 0) + 1
        times = min(left[n] // c for n, c in combo.items())
        for n, c in combo.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
        plan.append((times, sorted(combo.items(), reverse=True)))
    return plan


def rank_ranges(plan: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first rank, copies, first bin, offset): the pieces of a
    length with ranks from ``first rank`` on fill ``copies`` places of each bin."""
    taken: dict[int, int] = {}
    rows, bins = [], 0
    for times, combo in plan:
        offset = 0
        for length, copies in combo:
            rows.append((length, taken.get(length, 0), copies, bins, offset))
            taken[length] = taken.get(length, 0) + copies * times
            offset += length * copies
        bins += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (staged) with sequence_id and offset instead of part and slot."""
    held = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = held.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    ranges = rank_ranges(plan_bins(counts, capacity))    # lengths <= capacity: a bounded table
    ranked = pieces.join(base, ["length", "part"]).withColumn("rank", F.col("base") + F.col("slot")) \
        .drop("base", "part", "slot")
    schema = T.StructType(ranked.drop("rank").schema.fields + [
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = np.int64(1) << np.int64(48)
        starts = ranges[:, 0] * wide + ranges[:, 1]
        for b in batches:
            if not b.num_rows:
                continue
            length = b.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = b.column("rank").to_numpy(zero_copy_only=False).astype(np.int64)
            at = ranges[np.searchsorted(starts, length * wide + rank, "right") - 1]
            k = rank - at[:, 1]
            rest = b.drop_columns(["rank"])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(at[:, 3] + k // at[:, 2]), pa.array(at[:, 4] + k % at[:, 2] * length)],
                names=schema.fieldNames())

    return ranked.mapInArrow(run, schema)


def best_fit_pack(docs: DataFrame, tokenizer_path: str, end_id: int = 0,
                  capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Encode, cut and place every document."""
    return pack(stage(encode_pieces(docs, tokenizer_path, end_id, capacity, with_ids), "pieces"), capacity)
