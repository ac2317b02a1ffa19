"""Conversation repair against brute force."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest

from streetlake.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, cost string, part int"
WHITE = re.compile(r"[^\x20\x09-\x0D]")
GOOD = re.compile(r"(s?(ua)+)?")


def hurt(rows):
    out = []
    for conv, turn, role, text in rows:
        space = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def edits(kinds):
    """Every edit string worth trying: (cost, audit)."""
    best = None
    options = []
    for initial, fault in kinds:
        if fault in ("blank", "duplicate"):
            options.append([("D", 2)])
        else:
            extra = 5 if fault == "truncated" else 0
            options.append([("D", 2), ("K", extra), ("R", 1 + extra)])
    for chosen in itertools.product(*options):
        for gaps in itertools.product(range(3), repeat=len(kinds) + 1):
            cost = sum(c for _, c in chosen) + 5 * sum(gaps)
            audit = "".join("I" * g + e for g, (e, _) in zip(gaps, chosen)) + "I" * gaps[-1]
            if best is not None and (cost, audit) >= best:
                continue
            if fits(kinds, audit):
                best = (cost, audit)
    return best


def fits(kinds, audit):
    """Whether some choice of roles for R and I gives an allowed order."""
    row, shape = 0, ""
    for c in audit:
        if c == "I":
            shape += "[ua]"
        else:
            if c == "K":
                shape += re.escape(kinds[row][0]) or "(?!)"
            elif c == "R":
                shape += "[ua]"
            row += 1
    return any(re.fullmatch(shape, s) for n in range(0, 9) for s in ("ua" * n, "sua" + "ua" * n))


def expected(rows):
    convs = {r[0] for r in rows}
    damaged = collections.defaultdict(list)
    for r in hurt(rows):
        damaged[r[0]].append(r)
    out = {}
    for conv in convs:
        mine = sorted(damaged[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(),
                                                    hashlib.sha256(r[3].encode()).digest()))
        seen, kinds = set(), []
        for _, _, role, text in mine:
            solid = WHITE.findall(text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else \
                "truncated" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            kinds.append((role[:1], fault))
        turns = {r[1] for r in mine if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))
        count = collections.Counter(f for _, f in kinds)
        cost, audit = edits(kinds)
        lines, after, row = [], "", 0
        for c in audit:
            other = "assistant" if after == "u" else "user"
            role, text = (other, "") if c == "I" else (other, mine[row][3]) if c == "R" else mine[row][2:4]
            row += c != "I"
            if c != "D":
                lines.append(f"{role}:{text}")
                after = role[:1]
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def random_rows(seed, convs, longest):
    rnd = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", None, "", "tool", "umpire"]
    texts = ["Yes.", "No", "Really?", None, "", " \n", "é!", "東京", "a. b", " ", "Yes."]
    out = []
    for c in range(convs):
        for t in range(rnd.randint(1, longest)):
            for _ in range(rnd.choice([1, 1, 1, 1, 2])):
                out.append((c if c else None, rnd.choice([t, t, t, t + 3, None]), rnd.choice(roles), rnd.choice(texts)))
    return out


def found(df):
    return {r.conv_id: tuple(r[1:]) for r in df.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7) for r in rows], SCHEMA)


@pytest.mark.parametrize("seed,limit", [(1, 1 << 16), (2, 2)])
def test_against_brute_force(spark, monkeypatch, seed, limit):
    rows = random_rows(seed, 70, 3)
    whole = repair.segments
    monkeypatch.setattr(repair, "segments", lambda m: whole(m, limit))
    got, want = found(repair.repair(frame(spark, rows).repartition(3))), expected(rows)
    assert got == want


def brute(kinds):
    return edits(kinds)


def walked(kinds, rules=()):
    packed = "".join("b" if f in ("blank", "duplicate") else (r if r in "sua" else "x").upper() if f else
                     (r if r in "sua" else "x") for r, f in kinds)
    for symbol, pair in rules:
        packed = packed.replace(pair, symbol)
    walk = repair.Walk(repair.rule_transfers(list(rules)), {})
    walk.go(packed)
    return walk.end()


def test_all_short_sequences():
    kinds = [(r, f) for r in "suat" for f in ("", "truncated")] + [("u", "blank")]
    for n in range(0, 4):
        for some in itertools.product(kinds, repeat=n):
            assert walked(some) == (brute(some) or (0, "")), some


def test_rules_change_nothing():
    rnd = random.Random(4)
    rules = [("一", "ua"), ("丁", "一一"), ("丂", "uu"), ("七", "丁丁"), ("丄", "aU"), ("丅", "bu")]
    kinds = [(r, f) for r in "suat" for f in ("", "", "", "truncated", "blank")]
    for _ in range(300):
        some = [rnd.choice(kinds) for _ in range(rnd.randint(0, 4))] + [("u", ""), ("a", "")] * rnd.randint(0, 40) \
            + [rnd.choice(kinds) for _ in range(rnd.randint(0, 30))]
        assert walked(some, rules) == walked(some)


def test_grammar_is_learnt_from_all_sequences(spark):
    seqs = spark.createDataFrame([("uaua" * 8,)] * 5 + [("suaua",), ("b",), ("",), ("Ub" * 4,)], "symbols string")
    rules = repair.fit_grammar(seqs)
    assert rules[0][1] in ("ua", "au") and len(rules) <= repair.MAX_RULES
    short = [r[0] for r in seqs.select(repair.pack_with(seqs.symbols, rules)).collect()]
    assert len(short[0]) <= 4
    back = dict(rules)

    def spell(c):
        return "".join(map(spell, back[c])) if c in back else c
    assert ["".join(map(spell, x)) for x in short] == [r[0] for r in seqs.collect()]


def test_one_long_conversation_over_many_partitions(spark):
    """Rows of one conversation lie in many partitions and segments; the plain walk agrees."""
    rows = [(7, i, ["user", "assistant"][i % 2], f"Line {i % 4000}.") for i in range(6000)] + [(8, 0, "user", "Hi.")]
    got = found(repair.repair(frame(spark, rows).repartition(4)))
    damaged = [r for r in hurt(rows) if r[0] == 7]
    seen, kinds = set(), []
    for _, _, role, text in damaged:
        fault = "blank" if not text else "duplicate" if (role, text) in seen else "" if text[-1] == "." else "truncated"
        seen.add((role, text))
        kinds.append((role[:1], fault))
    cost, audit = walked(kinds)
    assert got[7][5:7] == (cost, audit)
    assert got[7][0] == 0 + (max(r[1] for r in damaged) - min(r[1] for r in damaged) + 1 - len({r[1] for r in damaged}))
    assert got[7][1:4] == tuple(sum(f == x for _, f in kinds) for x in ("blank", "duplicate", "truncated"))
    assert got[7][4] == sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))


def test_empty_and_undamaged(spark):
    assert repair.repair(frame(spark, [])).count() == 0
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Hello.")]
    got = found(repair.repair(frame(spark, rows), hurt=False))
    text = "system:Be kind.\nuser:Hi!\nassistant:Hello."
    assert got == {1: (0, 0, 0, 0, 0, 0, "KKK", hashlib.sha256(text.encode()).hexdigest())}
