"""Divergence of sources against plain Python, on rows that hold every awkward case."""

import collections
import random
import re

import numpy as np
import pytest

from streetlake.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, n long, term string, value int"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def rows(sources=5, docs=120, seed=3):
    rnd = random.Random(seed)
    words = ["alpha", "Beta", "ÉTÉ", "été", "straße", "東京", "it's", "x9y", "Z", "a-b", "naïve space"] \
        + [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(150)]
    out = [(None, None, None, None), (1, "", "en", ""), (2, "only 123 456", "xx", "s0"), (3, "rare words", "xx", "s1"),
           (4, "A a\nA\ta", "one", "solo"), (5, "a", "one", "solo"), (6, "a b", "one", "solo"),
           (7, "Same row", "en", "s1"), (7, "Same row", "en", "s1"), (7, "Same row", "en", "s1"),
           (8, "long " * 3000 + "tail", "de", "s2")]
    for i in range(docs):
        out.append((100 + i, " ".join(rnd.choice(words[:rnd.choice([5, 40, 160])]) for _ in range(rnd.randint(0, 60))),
                    rnd.choice(["en", "en", "de", "é"]), rnd.choice([None] + [f"s{k}" for k in range(sources)])))
    return [(*r, 1, "clash", 2) for r in out]


def expected(data, min_docs=3, top=200):
    n, df, groups = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), set()
    for _, text, lang, source, *_ in data:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in TERM.findall(text or "")]
        n[lang, source].update(words)
        df[lang].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, d in df[lang].items() if d >= min_docs]
        mine = sorted(s for x, s in groups if x == lang)
        both = sum((n[lang, s] for s in mine), collections.Counter())
        prices = {}
        for s, c in [(s, n[lang, s]) for s in mine] + [(None, both)]:
            total = sum(c[t] for t in kept)
            prices[s] = {t: 1 + 10 ** 9 * (c[t] + 1) // (total + len(kept)) for t in kept}
        f = lambda p, q: (p - q) ** 2 // q
        for s in mine:
            pair = [(sum(f(prices[s][t], prices[o][t]) for t in kept), o) for o in mine if o != s]
            term = [(f(prices[s][t], prices[None][t]), t) for t in kept
                    if n[lang, s][t] and prices[s][t] > prices[None][t]]
            for part, items, limit in (("pair", pair, None), ("term", term, top)):
                for rank, (value, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode()))[:limit], 1):
                    out.append((lang, s, part, item, value, rank))
    return out


def found(df):
    return sorted(map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect()))


@pytest.mark.parametrize("tile,block", [(32, 1024), (2, 16), (3, 7)])
def test_audit_against_plain_python(spark, monkeypatch, tile, block):
    monkeypatch.setattr(divergence, "ROWS", tile)
    monkeypatch.setattr(divergence, "COLUMNS", block)
    data = rows()
    assert found(divergence.audit(spark.createDataFrame(data, SCHEMA).repartition(3))) == sorted(expected(data))


def test_many_sources_few_terms(spark):
    data = rows(sources=70, docs=400, seed=9)
    got = found(divergence.audit(spark.createDataFrame(data, SCHEMA), top=5))
    assert got == sorted(expected(data, top=5))


def test_empty(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_tasks_hand_counts_on(spark, monkeypatch):
    df = spark.createDataFrame(rows(), SCHEMA)
    want = sorted(map(tuple, divergence.term_counts(df).collect()), key=str)
    monkeypatch.setattr(divergence, "HELD", 10)
    monkeypatch.setattr(divergence, "PIECE", 9)
    assert sorted(map(tuple, divergence.term_counts(df.coalesce(1)).collect()), key=str) == want


def test_prices_are_exact():
    rnd = random.Random(1)
    total = [rnd.randint(1, 8 * 10 ** 15) for _ in range(500)]
    count = [rnd.randint(1, t) for t in total]
    got = divergence.price(np.array(count), np.array(total))
    assert got.tolist() == [1 + 10 ** 9 * c // t for c, t in zip(count, total)]


@pytest.mark.parametrize("seed", range(6))
def test_tree_leaves_and_empty_quadrants(seed):
    rnd = np.random.default_rng(seed)
    n_one, n_other, n_cols = int(rnd.integers(1, 9)), int(rnd.integers(1, 6)), int(rnd.integers(1, 40))
    one, other = (rnd.random((n, n_cols)) < rnd.choice([0, 0.05, 0.6]) for n in (n_one, n_other))
    height = max(int(max(n_cols, n_one, n_other, 2) - 1).bit_length(), 1)
    trees = [divergence.K2Tree(*np.nonzero(m), height) for m in (one, other)]
    a, ka, b, kb, empty = divergence.joint_leaves(*trees, n_one, n_other, n_cols, height)
    either = one[:, None, :] | other[None, :, :]
    assert (empty == (~either).sum(2)).all()
    assert (np.bincount(a * n_other + b, minlength=n_one * n_other).reshape(n_one, n_other) == either.sum(2)).all()
    assert (ka >= 0).sum() == sum(one[x].sum() for x in range(n_one)) * n_other
    assert (kb >= 0).sum() == other.sum() * n_one
    a, _, b, _, empty = divergence.joint_leaves(trees[0], trees[0], n_one, n_one, n_cols, height)
    either = one[:, None, :] | one[None, :, :]
    later = np.triu(np.ones((n_one, n_one), bool), 1)
    assert (empty[later] == (~either).sum(2)[later]).all()
    assert (np.bincount(a * n_one + b, minlength=n_one ** 2).reshape(n_one, n_one) == either.sum(2) * later).all()
