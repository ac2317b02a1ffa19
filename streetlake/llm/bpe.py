"""Exact BPE by backtracking over longest matches, and decoding by offsets.

An Aho-Corasick automaton over the vocabulary gives the longest token that
starts at each place of a word.  Tokens are taken greedily; a token is kept
only if the pair table says that the merge order would also leave the border
between it and its predecessor alone, otherwise the next shorter token is
tried, otherwise the predecessor is given up and its end is closed.  Each
place is closed at most once, so a word takes linear time, and a row of tokens
whose neighbours are all compatible is the one that the merges give.

Defined results: null text is empty text (no ids, empty decoded text); special
strings in a text get their own ids, as the library does; a null id stays
null; repeated rows give repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetlake.llm.common import rows_of, ship_package, text_bytes
from streetlake.llm.tokens import WHITE, PieceCache, byte_characters

END = "\ue000"           # stands for the end-of-word suffix; no byte-level alphabet has it
CHUNK = re.compile(f"[^{WHITE}]+")
_NOT_WHITE = re.compile("[\x1c-\x1f]")    # white space for str.split, not for the vocabulary


# Pre-tokens of lower-case Latin-1 text without white space, as the vocabulary's
# own pattern cuts them (fixed value).
LATIN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^a-zªµºß-öø-ÿ0-9²³¹¼½¾]+")
LATIN_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
LATIN_STEPS = ["NFC", "Replace", "Lowercase"]


class BacktrackingBPE:
    """Words (byte-level characters) to ids for one vocabulary."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str | None = None, pairs: int = 400_000):
        import ahocorasick

        self.end = END if suffix else ""
        inner = (lambda s: s[:-len(suffix)] + END if s.endswith(suffix) else s) if suffix else (lambda s: s)
        self.ids = {inner(s): i for s, i in vocab.items()}
        self.rank: dict[tuple[str, str], int] = {}
        self.split: dict[str, tuple[str, str]] = {}
        self.born: dict[str, int] = {}
        for r, m in enumerate(merges):
            a, b = map(inner, m.split(" ") if isinstance(m, str) else m)
            self.rank.setdefault((a, b), r)
            if a + b not in self.split:
                self.split[a + b], self.born[a + b] = (a, b), r
        # what merges never make can't stand in an encoding, but for single characters
        usable = [t for t in self.ids if t in self.split or len(t) == 1 or (len(t) == 2 and t[-1] == END)]
        self.automaton = ahocorasick.Automaton()
        for t in usable:
            self.automaton.add_word(t, (len(t), t))
        self.automaton.make_automaton()
        known = set(usable)
        self.shorter = {t: next((t[:k] for k in range(len(t) - 1, 0, -1) if t[:k] in known), None) for t in usable}
        self.table: dict[tuple[str, str], bool] = {}
        self.pairs = pairs

    def compatible(self, x: str, y: str) -> bool:
        """Whether the merges of x + y leave the border between x and y alone.

        Walks back in time: of the two tokens at the border, the one made
        later is split.  A pair that stood there together merges across the
        border if its rank comes before the merge that ended it.
        """
        key = (x, y)
        known = self.table.get(key)
        if known is None:
            if len(self.table) >= self.pairs:
                self.table.clear()
            known = self.table[key] = self._walk(x, y)
        return known

    def _walk(self, u: str, v: str) -> bool:
        born, ends_u, ends_v = self.born, float("inf"), float("inf")
        while True:
            r = self.rank.get((u, v))
            if r is not None and r < ends_u and r <= ends_v:
                return False
            bu, bv = born.get(u, -1), born.get(v, -1)
            if bu < 0 and bv < 0:
                return True
            if bu > bv:
                ends_u, u = bu, self.split[u][1]
            else:                       # equal: the same token twice, the left one is made first
                ends_v, v = bv, self.split[v][0]

    def encode(self, word: str) -> list[int]:
        """Ids of one word."""
        w = word + self.end
        whole = self.ids.get(w)
        if whole is not None and w in self.split:
            return [whole]
        n = len(w)
        longest: list[str | None] = [None] * (n + 1)
        for end, (size, t) in self.automaton.iter(w):    # ends ascend: the longest of a start comes last
            longest[end - size + 1] = t
        is_open = [True] * (n + 1)
        table, tokens = self.table, []
        pos, token = 0, longest[0]
        while pos < n:
            while token is not None:
                if is_open[pos + len(token)]:
                    if not tokens:
                        break
                    fits = table.get((tokens[-1], token))
                    if self.compatible(tokens[-1], token) if fits is None else fits:
                        break
                token = self.shorter[token]
            if token is not None:
                tokens.append(token)
                pos += len(token)
                token = longest[pos]
            else:
                if not tokens:
                    raise ValueError(f"no encoding of {word!r} in this vocabulary")
                is_open[pos] = False
                token = tokens.pop()
                pos -= len(token)
        return [self.ids[t] for t in tokens]


class OffsetTable:
    """Token texts in one byte string; a token's text is a slice of it."""

    def __init__(self, texts: dict[int, str], joint: str = ""):
        size = max(texts, default=-1) + 1
        parts = [(texts.get(i, "") + joint).encode() for i in range(size)]
        self.blob = np.frombuffer(b"".join(parts), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        self.tail = len(joint.encode())

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the tokens, with the joint between neighbours."""
        if not len(ids):
            return b""
        at = self.offsets[ids]
        lens = self.offsets[ids.astype(np.int64) + 1] - at
        ends = np.cumsum(lens)
        where = np.arange(ends[-1], dtype=np.int64) + np.repeat(at - (ends - lens), lens)
        out = self.blob[where].tobytes()
        return out[:-self.tail] if self.tail else out


class Codec:
    """Encoder and decoder for one tokenizer file (normaliser and pre-tokens as it says)."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        model = json.loads(spec)
        tok = Tokenizer.from_str(spec)
        self.normalise = tok.normalizer.normalize_str if tok.normalizer else str
        self.pre = tok.pre_tokenizer.pre_tokenize_str
        steps = [n["type"] for n in (model.get("normalizer") or {}).get("normalizers", [])]
        cuts = [(c.get("pattern") or {}).get("Regex") for c in model["pre_tokenizer"].get("pretokenizers", [])]
        self.latin = steps == LATIN_STEPS and cuts == [LATIN_PATTERN, None]
        self.byte = byte_characters()
        m = model["model"]
        self.bpe = BacktrackingBPE(m["vocab"], m["merges"], m.get("end_of_word_suffix"))
        texts = {i: t for t, i in m["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        texts |= {i: t for t, i in self.special.items()}
        if model.get("decoder"):
            raise ValueError("only vocabularies without a decoder, whose tokens are joined by spaces")
        self.table = OffsetTable(texts, " ")
        alternatives = "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
        self.cutter = re.compile(f"({alternatives})") if alternatives else None
        self.first = os.path.commonprefix(list(self.special))
        self.words: dict[str, bytes] = {}
        self.cache = PieceCache(lambda chunks: [self._chunk(c) for c in chunks])

    def _pre_tokens(self, part: str) -> list[str]:
        """Normalised pre-tokens; by a plain pattern where all is Latin-1."""
        if self.latin and (part.isascii() or max(part) <= "\xff"):
            return LATIN.findall(part.lower())
        text = self.normalise(part)
        return [text[a:b] for _, (a, b) in self.pre(text)]

    def _word(self, word: str) -> bytes:
        got = self.words.get(word)
        if got is None:
            if len(self.words) > 300_000:
                self.words.clear()
            ids = self.bpe.encode("".join([self.byte[b] for b in word.encode()]))
            got = self.words[word] = np.array(ids, "<u4").tobytes()
        return got

    def _chunk(self, chunk: str) -> bytes:
        if not self.cutter or self.first not in chunk:
            return b"".join(map(self._word, self._pre_tokens(chunk)))
        out = b""
        for part in self.cutter.split(chunk):
            if part in self.special:
                out += np.array([self.special[part]], "<u4").tobytes()
            elif part:
                out += b"".join(map(self._word, self._pre_tokens(part)))
        return out

    def encode(self, text: str) -> bytes:
        """Ids as packed little-endian 32-bit integers."""
        chunks = CHUNK.findall(text) if _NOT_WHITE.search(text) else text.split()
        return self.cache.packed(chunks)

    def decode(self, packed: bytes) -> bytes:
        return self.table.decode(np.frombuffer(packed, "<u4"))


_CODECS: dict[str, Codec] = {}


def codec(key: str, spec: str) -> Codec:
    """The codec of a tokenizer file, built once per Python worker."""
    if key not in _CODECS:
        _CODECS[key] = Codec(spec)
    return _CODECS[key]


def bpe_round_trip(docs: DataFrame, tokenizer_path: str, with_values: bool = False) -> DataFrame:
    """Encode and decode every whole text.

    Returns doc_id, n_tokens and the SHA-256 of the packed ids and of the
    decoded text; ``with_values`` adds ``ids`` and ``decoded`` themselves.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(spec)    # a vocabulary file: fixed size
    key = tokenizer_path
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    ] + ([T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("decoded", T.StringType())]
         if with_values else []))
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(key, shared.value)
        for whole in batches:
            for batch in rows_of(whole):
                out = []
                for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    packed = c.encode(raw.decode("utf-8", "replace"))
                    decoded = c.decode(packed)
                    row = (doc_id, len(packed) // 4, hashlib.sha256(packed).hexdigest(),
                           hashlib.sha256(decoded).hexdigest())
                    if with_values:
                        row += (np.frombuffer(packed, "<u4").tolist(), decoded.decode("utf-8", "replace"))
                    out.append(row)
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, t) for v, t in zip(zip(*out), types)], names=schema.fieldNames())

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes("text").alias("text")) \
        .mapInArrow(run, schema)
