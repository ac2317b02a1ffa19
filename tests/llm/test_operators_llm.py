"""Training-data operators against brute force, on rows that hold every awkward case."""

import collections
import hashlib
import math
import random
import re
import unicodedata
import zlib

import numpy as np
import pytest

from streetlake.llm import bpe, licenses, neardup, packing, quality_model, quotes, rules, secrets, topk, urls
from streetlake.llm.queries import tokenizer

WORDS = "the of and lorem ipsum dolor sit amet der die und Straße été niño 東京 x9 A-Z it's!! ***".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n int, stats string, hash string, t int"


def texts():
    rnd = random.Random(5)
    out = [None, "", " ", "\n\n", "one", "two words", "GNU General Public License, v3\nApache License; mit license CC-BY",
           "token=secret=abcdefgh password: 'hunter22' api_key=short AKIA" + "Z9" * 9 + " " + "0af9" * 8 + " é🙂",
           "token=token: abcdefgh \u0001 SECRET = zzzzzzzz <|endoftext|> \n<|startoftext|>", "a  b\n\n c \t d e \x1c f",
           "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
           "associated documentation files to deal in the software without restriction"]
    for _ in range(25):
        out.append(" ".join(rnd.choice(WORDS) + rnd.choice(["", "", ".", "\n"]) for _ in range(rnd.randint(1, 400))))
    base = [rnd.choice(WORDS) + str(rnd.randint(0, 500)) for _ in range(300)]
    for cut in (0, 0, 3, 10, 25, 60, 120):
        out.append(" ".join(base[:len(base) - cut] + [f"z{cut}{k}" for k in range(cut)]))
    out += ["same line\n" * 30, out[15], out[15], "long " * 9000 + "tail"]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None, "xx"][i % 4], "s", 0, 1, "s", "h", 2) for i, t in enumerate(texts())]
    rows += [rows[15], (None, texts()[20], "en", "s", 0, 1, "s", "h", 2), (None, None, None, None, None, 1, "", "", 2)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def same(got, want):
    assert collections.Counter(got) == collections.Counter(want)


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def test_op1_pieces_and_places(docs, empty):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    rows = packing.best_fit_pack(docs, tokenizer("byte_bpe_50k.json")).collect()
    want = []
    for i, t in pairs(docs):
        ids = np.array(tok.encode(t, add_special_tokens=False).ids + [0], "<u4")
        first = len(ids) % 2048 or min(2048, len(ids))
        for k, (a, b) in enumerate(zip([0, *range(first, len(ids), 2048)], range(first, len(ids) + 1, 2048))):
            want.append((i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    same([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows], want)
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        end = 0
        for a, n in sorted(places):
            assert a == end
            end += n
        assert end <= 2048
    assert packing.best_fit_pack(empty, tokenizer("byte_bpe_50k.json")).count() == 0


def test_op1_plan_uses_all_and_fills():
    rnd = random.Random(2)
    counts = {rnd.randint(1, 2048): rnd.randint(1, 40) for _ in range(300)} | {2048: 1000}
    plan = packing.plan_bins(dict(counts))
    used = collections.Counter()
    for times, combo in plan:
        assert sum(n * c for n, c in combo) <= 2048
        for n, c in combo:
            used[n] += c * times
    assert dict(used) == counts
    least = -(-sum(n * c for n, c in counts.items()) // 2048)
    assert sum(t for t, _ in plan) <= least * 1.02 + 1


def test_op1_fullest_is_exact():
    rnd = random.Random(3)
    for _ in range(200):
        have = {rnd.randint(1, 30): rnd.randint(1, 3) for _ in range(6)}
        room = rnd.randint(0, 60)
        sums = {0}
        for n, c in have.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        got = packing.fullest(have, room)
        assert all(c <= have[n] for n, c in got)
        assert sum(n * c for n, c in got) == max(s for s in sums if s <= room)


def test_op2_scores(spark, docs, empty):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice(WORDS[:8]) if i % 3 else rnd.choice(WORDS).upper() + "***" for _ in range(60)))
            for i in range(300)]
    train = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i, _ in rows] + [(None, 1), (7, None)],
                                   "doc_id long, quality int")
    got = {r.doc_id: r for r in quality_model.classify(train, labels).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sorted(i for i in got if got[i].held_out) == sorted(held)
    assert np.mean([got[i].predicted == int(i % 3 > 0) for i in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    all_docs = quality_model.classify(docs, labels)
    assert all_docs.count() == docs.count() and all_docs.where("score is null").count() == 0
    assert {r.score for r in quality_model.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_model.classify(empty, labels).count() == 0
    assert quality_model.keep_good(docs, labels).columns == docs.columns


def test_op2_isotonic():
    y = np.array([0.1, 0.5, 0.3, 0.9, 0.2])
    fit = quality_model.isotonic(np.arange(5), y, np.ones(5))
    assert np.all(np.diff(fit) >= 0) and abs(fit.sum() - y.sum()) < 1e-12


def spans_of(t):
    out = []
    for order, (kind, pattern, group, least) in enumerate(secrets.RULES):
        out += [(m.start(), order, m.end(), kind) for m in re.finditer(pattern, t) if len(m[group]) >= least]
    return sorted(out)


def test_op3_spans_ledger_and_redaction(spark, docs, empty):
    found, new = secrets.scan(docs)
    got = [(r.doc_id, tuple(tuple(s) for s in r.found)) for r in found.collect()]
    same(got, [(i, tuple(spans_of(t))) for i, t in pairs(docs)])
    blobs = {hashlib.sha256(t.encode()).hexdigest() for _, t in pairs(docs)}
    assert {r.blob for r in new.collect()} == blobs and new.count() == len(blobs)
    again, unseen = secrets.scan(docs, new)
    assert unseen.count() == 0
    same([(r.doc_id, tuple(tuple(s) for s in r.found)) for r in again.collect()], got)
    assert secrets.scan(docs, new, "2")[1].count() == len(blobs)
    assert secrets.scan(empty)[0].count() == 0
    clean = secrets.redact(docs)
    assert clean.columns == docs.columns
    for i, t in pairs(clean):
        if i is not None:
            old = texts()[i] or ""
            masked = list(old)
            for a, _, b, _ in spans_of(old):
                masked[a:b] = "*" * (b - a)
            assert t == "".join(masked)


def test_op3_stored_ledger(docs, tmp_path):
    path = str(tmp_path / "ledger")
    some = docs.where("doc_id < 20")
    first, new = secrets.scan_stored(some, path)
    blobs = {hashlib.sha256(t.encode()).hexdigest() for _, t in pairs(docs)}
    assert new.count() == len({hashlib.sha256(t.encode()).hexdigest() for _, t in pairs(some)})
    found, more = secrets.scan_stored(docs, path)
    assert new.count() + more.count() == len(blobs)
    same([(r.doc_id, tuple(tuple(s) for s in r.found)) for r in found.collect()], [(i, tuple(spans_of(t))) for i, t in pairs(docs)])
    new.write.mode("append").parquet(path)          # the same pairs by a run at the same time
    assert first.count() == some.count()
    again, none = secrets.scan_stored(docs, path)
    assert none.count() == 0 and again.count() == docs.count()
    same(pairs(secrets.redact(docs, ledger_path=path)), pairs(secrets.redact(docs)))
    assert secrets.read_ledger(docs.sparkSession, path).count() == len(blobs)
    assert secrets.scan_stored(some, path, "2")[1].count() == new.count()


def test_op4_against_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 8))
    x[10:60] = x[10]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(1000, None), (1050, [1.0, None] + [0.0] * 6), (1100, [float("nan")] + [0.0] * 7), (None, [0.0] * 8),
             (1150, [0.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ok = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows
          if i is not None and v and all(c is not None and np.isfinite(c) for c in v)]
    want = []
    for i, q in ok:
        if i % 50 == 0:
            best = sorted((-int(q @ v), j) for j, v in ok if j != i)[:5]
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    same([tuple(r) for r in topk.exact_top_k(df).select("query_id", "rank", "vec_id", "score").collect()], want)
    assert topk.exact_top_k(df.limit(0)).count() == 0


def test_op5_round_trip(docs, empty):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    want = []
    for i, t in pairs(docs):
        ids = tok.encode(t, add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    same([tuple(r) for r in bpe.bpe_round_trip(docs, tokenizer("word_bpe_49k.json")).collect()], want)
    assert bpe.bpe_round_trip(empty, tokenizer("word_bpe_49k.json")).count() == 0


def test_op5_any_text():
    from tokenizers import Tokenizer
    path = tokenizer("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        codec = bpe.codec(path, f.read())
    rnd = random.Random(8)
    for _ in range(3000):
        t = "".join(chr(rnd.choice([rnd.randint(0, 0x17F), rnd.randint(97, 122), 32])) for _ in range(rnd.randint(0, 30)))
        assert codec.encode(t) == np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_op6_threads(spark):
    rows = [(1, 0, "user", "Hello there\nSecond line"), (1, 1, "assistant", "> hello   THERE\nMy answer"),
            (1, 2, "user", ">> hello there\n> my answer\n> My Answer\nThanks"), (1, 3, "user", "> nobody said this"),
            (1, 4, "user", "> Thanks\n> second line\n"), (2, 0, "user", "> hello there"), (2, 1, None, None),
            (None, 5, "user", "> hello there"), (1, 0, "user", "Hello there\nSecond line")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = collections.Counter((r.conv_id, r.turn, r.clean_text, r.reply_to, r.root_turn, r.depth)
                              for r in quotes.link_quotes(df).collect())
    assert got == collections.Counter([
        (1, 0, "Hello there\nSecond line", None, 0, 0), (1, 0, "Hello there\nSecond line", None, 0, 0),
        (1, 1, "My answer", 0, 0, 1), (1, 2, "Thanks", 1, 0, 2), (1, 3, "", None, 3, 0), (1, 4, "", 2, 0, 3),
        (2, 0, "", None, 0, 0), (2, 1, None, None, 1, 0), (None, 5, "", None, 5, 0)])
    assert quotes.link_quotes(df.limit(0)).count() == 0


def test_op6_nested_and_rewrapped(spark):
    rows = [(1, 0, "user", "first line\nsecond line\nthird line"), (1, 1, "assistant", "> first line\nan answer to that"),
            # two lines of turn 0 stand inside the quote of turn 1
            (1, 2, "user", ">> first line\n>> second line\n> an answer to that\nmore"),
            (2, 0, "user", "one long paragraph that goes on and on"), (2, 1, "assistant", "short"),
            (2, 2, "user", "> one long paragraph that\n> goes on and on\n\nyes"),       # wrapped anew
            (3, 0, "user", "a\u0001b"), (3, 1, "user", "> a b"),
            (4, 0, "user", "> only a quote"), (4, 1, "user", "only a quote"),           # later: no source
            (5, 0, "user", "x"), (5, 1, "user", "x y"), (5, 2, "user", "> x\n> y")]     # a line and a run: the later
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): (r.clean_text, r.reply_to, r.root_turn, r.depth, r.quote_levels)
           for r in quotes.link_quotes(df).collect()}
    assert got[1, 1] == ("an answer to that", 0, 0, 1, 1)
    assert got[1, 2] == ("more", 1, 0, 2, 2)
    assert got[2, 2] == ("yes", 0, 0, 1, 1)
    assert got[3, 1] == ("", 0, 0, 1, 1)
    assert got[4, 0][1] is None and got[4, 1][1] is None
    assert got[5, 2][1:4] == (1, 1, 1)


def test_op7_places(docs, empty):
    want = []
    for i, t in pairs(docs):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
        hits = [(k, label) for p, label in licenses.PHRASES for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        want.append((i, len(w), len(hits), min(hits)[0] if hits else None, max(hits)[0] if hits else None,
                     ",".join(sorted({x for _, x in hits}))))
    rows = licenses.scan_licenses(docs).collect()
    same([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows], want)
    grant = next(r for r in rows if r.doc_id == 10)
    assert grant.labels == "mit" and grant.base_labels == "" and grant.score == 1.0
    assert licenses.scan_licenses(empty).count() == 0


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_op8_components(spark, docs, empty, width, percent):
    rnd = random.Random(9)
    base = [f"w{rnd.randint(0, 5000)}" for _ in range(200)]
    rows = pairs(docs)
    for k in range(120):                       # edits of one text, near and over the threshold
        w = list(base)
        for p in rnd.sample(range(200), rnd.randint(0, 12)):
            w[p] = f"e{k}x{p}"
        rows.append((1000 + k, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets.append(frozenset(tuple(w[k:k + width]) for k in range(len(w) - width + 1)) if len(w) >= width
                    else frozenset([tuple(w)] if w else []))
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is not None and rows[b][0] is not None and sets[a] and sets[b] \
                    and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    want = [(i, len(sets[k]), None if i is None else least[top(k)], i is None or least[top(k)] == i)
            for k, (i, _) in enumerate(rows)]
    same([tuple(r) for r in neardup.near_duplicates(df, width, percent).drop("text_hash").collect()], want)
    assert neardup.near_duplicates(empty).count() == 0
    kept = neardup.drop_near_duplicates(docs, width, percent)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    assert len(ids) == len(set(ids))


def test_op9_rules_and_model(spark):
    rows = ["https://A.example.net/en/1?x=1", "https://a.net/de/", "http://net/x", "http://b.example.com/de/1", "x.org",
            "https://org/fr/2", "https://a.org/fr#t", "https://a.net", "//a.net/", None, "", "https://u.com/a/b?c=1&d=2"]
    rows += [f"https://s{i}.net/{i}" for i in range(30)] + [f"https://s{i}.org/fr/{i}-a" for i in range(30)]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(rows)] + [(None, rows[0])], "page_id long, url string")
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(df).collect()]
    by = {g[0]: g[1:] for g in got}
    assert len(got) == len(rows) + 1 and {g[4] for g in got} <= {"allow", "block"}
    assert by[0] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert by[1] == ("a.net", "/de/", "net/", "block") and by[2][2:] == ("net/", "block")
    assert by[3][2:] == ("example.com/de/", "block") and by[5][2:] == ("org/fr/", "allow")
    assert by[4][:3] == ("", "", None) and by[6][:3] == ("a.org", "/fr", None) and by[7][:3] == ("a.net", "", None)
    assert by[9][:3] == ("", "", None)
    assert urls.judge_urls(df.limit(0)).count() == 0


def test_op10_counts(docs, empty):
    want = []
    for i, t in pairs(docs):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        win = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
        cover = {k + j for k in range(len(w) - 4) if win[tuple(w[k:k + 5])] > 1 for j in range(5)}
        ls = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(ls) - len(set(ls)),
                     len(cover), len(w) < 10 or 100 * len(cover) > 20 * len(w)))
    rows = rules.quality_rules(docs).collect()
    same([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows],
         want)
    assert all(r.kept in (True, False) and not (r.base_failed and r.kept) for r in rows)
    assert rules.quality_rules(empty).count() == 0
    kept = rules.keep_documents(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in rows)


def test_pipeline_stages(spark, tmp_path, docs):
    import corpus_pipeline
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1) for i in range(60)], "doc_id long, quality int") \
        .write.parquet(str(tmp_path / "labels.parquet"))
    d = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, step in corpus_pipeline.STAGES[:-1]:
        before = d.count()
        d = step(spark, d, str(tmp_path))
        assert d.columns == ["doc_id", "text", "lang", "source", "n_chars"] and d.count() <= before, name
    assert corpus_pipeline.run(spark, str(tmp_path)).where("length > 2048").count() == 0


def test_op10_histogram_classes(spark):
    text = "The the, AND «x» Ωmega Écrit. with (by) !!! ;:'\" a$b #1 *** ¿qué?"
    rows = [(1, text, "en"), (2, "DES, des du. Qui! dans Ÿ", "fr"), (3, "¿Una? con, por; NO. las", "es"),
            (4, "Sich auf, FÜR ist. des Ein!", "de"), (5, text, "xx")]
    got = {r.doc_id: r.asDict() for r in rules.base_counts(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    marks = sum(unicodedata.category(c)[0] == "P" and c not in "#*%&" for c in text)
    assert got[1]["n_marks"] == marks and got[1]["n_upper"] == sum(unicodedata.category(c) == "Lu" for c in text)
    for i, t, lang in rows[:4]:
        words = [w.lower().strip(rules.EDGE) for w in t.split()]
        assert [got[i][f"c{k + 1}"] for k in range(16)] == [words.count(w) for w in rules.COMMON[lang]]
        assert sum(w in rules.COMMON[lang] for w in words) >= 5
    assert "k_mark" in rules.CLASS_COLUMNS


def divergence(p, q):
    """Jensen-Shannon distance of two lists of counts."""
    if not sum(p) or not sum(q):
        return None
    p, q = np.array(p) / sum(p), np.array(q) / sum(q)
    m = (p + q) / 2
    part = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m) if a > 0)
    return math.sqrt(max((part(p) + part(q)) / 2, 0))


def histograms_of(t, lang):
    """(number of words, base failed, counts of classes, of common words or None)."""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    win = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    cover = {k + j for k in range(len(w) - 4) if win[tuple(w[k:k + 5])] > 1 for j in range(5)}
    n = [sum(c in "#*$%&|<>" for c in t), sum("0" <= c <= "9" for c in t),
         sum(unicodedata.category(c) == "Lu" for c in t),
         sum(unicodedata.category(c)[0] == "P" and c not in "#*%&" for c in t)]
    chars = sum(map(len, w))
    common = rules.COMMON.get(lang)
    looked = collections.Counter(x.lower().strip(rules.EDGE) for x in w)
    words = common and [looked[x] for x in common]
    return (len(w), len(w) < 10 or 100 * len(cover) > 20 * len(w), [len(t) - chars, *n, chars - sum(n)],
            words and words + [len(w) - sum(words)])


def rule_verdicts(rows):
    """id -> (class distance, word distance, kept) of (id, text, lang) by brute force."""
    tag = lambda lang: (lang or "").strip().replace("_", "-").split("-")[0].lower()
    hist = [(i, lang, *histograms_of(t or "", tag(lang))) for i, t, lang in rows]
    by_lang, by_tag = (collections.defaultdict(lambda n=n: np.zeros(n, int)) for n in (6, 17))
    docs = collections.Counter()
    for _, lang, _, failed, classes, words in hist:
        if not failed:
            for key in {lang, "all"}:
                by_lang[key] += classes
                docs[key] += 1
            if words:
                by_tag[tag(lang)] += words
    out = {}
    for i, lang, n, failed, classes, words in hist:
        own = lang if lang and docs[lang] >= 20 else "all"
        far = [divergence(classes, list(by_lang[own])), words and divergence(words, list(by_tag[tag(lang)]))]
        over = [d is not None and d > limit * math.sqrt(max(1, least / max(n, 1)))
                for d, limit, least in ((far[0], 0.30, 50), (far[1], 0.24, 100))]
        out[i] = (*far, not failed and not any(over))
    return out


def prose(rnd, lang, n):
    """Invented words, three in ten of them common ones of the language."""
    out = [rnd.choice(rules.COMMON[lang]) if rnd.random() < 0.3 else
           "".join(rnd.choice("aeiou") + rnd.choice("bdlmnrst") for _ in range(rnd.randint(1, 3))) for _ in range(n)]
    out = [w.capitalize() if k % 9 == 0 else w + "." if k % 9 == 8 else w for k, w in enumerate(out)]
    return " ".join(out)


def gibberish(rnd, n):
    """Words of consonants only."""
    return " ".join("".join(rnd.choice("bcdfghjklmnpqrstvwxz") for _ in range(rnd.randint(3, 7))) for _ in range(n))


def marks_only(rnd, n):
    return " ".join("".join(rnd.choice(".,;:!?-()") for _ in range(rnd.randint(2, 6))) for _ in range(n))


def same_verdicts(rows, got):
    want = rule_verdicts(rows)
    assert sorted(got) == sorted(want)
    for i, (far_class, far_word, kept) in want.items():
        assert got[i].kept == kept, i
        for a, b in ((got[i].class_distance, far_class), (got[i].word_distance, far_word)):
            assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-6), i


def test_op10_short_texts(spark):
    rnd = random.Random(6)
    rows = [(k, prose(rnd, lang, 150), lang) for k, lang in enumerate(["en", "de", "fr", "es"] * 30)]
    clean = range(200, 260)
    rows += [(i, prose(rnd, "en", rnd.randint(10, 199)), "en") for i in clean]
    junk = range(300, 340)
    rows += [(i, gibberish(rnd, rnd.randint(60, 199)), "en") for i in junk]
    rows += [(400 + i, marks_only(rnd, n), "de") for i, n in enumerate((12, 20, 45, 120))]
    rows += [(500, None, "en"), (501, " ", "en"), (502, "a b", "fr"), (503, prose(rnd, "en", 60), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = {r.doc_id: r for r in rules.quality_rules(df).collect()}
    same_verdicts(rows, got)
    assert not any(got[i].kept for i in [*junk, 400, 401, 402, 403])
    assert sum(got[i].kept for i in clean) >= 58


def test_op10_other_languages(spark):
    rnd = random.Random(7)
    rows = [(k, prose(rnd, "en", 150), "en") for k in range(40)] + [(50 + k, prose(rnd, "es", 150), "it") for k in range(25)]
    rows += [(100 + k, prose(rnd, "en", 150), lang) for k, lang in enumerate(["EN", "en-US", "en_GB", "xx", None])]
    rows += [(200 + k, marks_only(rnd, 120), lang) for k, lang in enumerate(["it", "xx", "EN", "", None])]
    rows += [(300 + k, gibberish(rnd, 120), lang) for k, lang in enumerate(["EN", "en-US", " en_GB"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = {r.doc_id: r for r in rules.quality_rules(df).collect()}
    same_verdicts(rows, got)
    assert sorted(i for i in got if not got[i].kept) == [200, 201, 202, 203, 204, 300, 301, 302]
    assert got[50].word_distance is None and got[50].class_distance is not None


def test_op4_mixed_lengths(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(v) for v in rng.normal(size=8)]) for i in range(120)]
    rows += [(i, [float(v) for v in rng.normal(size=3)]) for i in range(150, 171)] + [(200, [1.0] * 9), (201, [2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    q = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows]
    want = []
    for i, a in q:
        best = sorted((-int(a @ b), j) for j, b in q if j != i and len(a) == len(b))[:5] if i % 50 == 0 else []
        want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    assert {w[0] for w in want} == {0, 50, 100, 150}
    same([tuple(r) for r in topk.exact_top_k(df).select("query_id", "rank", "vec_id", "score").collect()], want)


def test_op9_suffixes_of_all_pages(spark, monkeypatch):
    monkeypatch.setattr(urls, "TRAIN_ROWS", 20)
    rows = [f"https://s{i}.net/{i}" for i in range(90)] + [f"https://s{i}.org/fr/{i}" for i in range(60)]
    rows += [f"https://s{i}.org/{i}" for i in range(50)] + [f"https://s{i}.hot/{i}" for i in range(150)]
    rows += [f"https://s.r{i}/" for i in range(40)] + [None, "x"]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string").repartition(3)
    p = urls.lexical(urls.with_rule(df)).withColumn("y", (urls.F.col("rule_verdict") == "block").cast("double"))
    stats, n, prior = urls.suffix_statistics(p)
    assert (n, prior) == (150, 90 / 150)
    want = {"net": (90, 90, 90), "org": (110, 60, 0), "hot": (150, 0, 0), "": (2, 0, 0)} | {f"r{i}": (1, 0, 0) for i in range(40)}
    got = {r.suffix: (r.suffix_rate, r.suffix_share) for r in stats.collect()}
    assert got == {s: (pytest.approx((b + 5 * prior) / (k + 5)), pytest.approx(m / len(rows))) for s, (m, k, b) in want.items()}
    few, many = ({r.page_id: (r.suffix_rate, r.suffix_share) for r in urls._with_suffix(p, stats, most).collect()}
                 for most in (1000, 10))
    assert few == many and len(few) == len(rows)
    seen = []
    train = urls._with_suffix
    monkeypatch.setattr(urls, "_with_suffix", lambda rows, s, *a: seen.append(s) or train(rows, s, *a))
    assert urls.judge_urls(df).count() == len(rows)
    assert all({r.suffix: r.suffix_share for r in s.collect()}["hot"] == 150 / len(rows) for s in seen) and seen


def test_pipeline_against_plain_python(spark, tmp_path):
    import corpus_pipeline
    from tokenizers import Tokenizer
    rnd = random.Random(11)
    good = {i: prose(rnd, ["en", "de"][i % 2], rnd.randint(120, 300)) for i in range(120)}
    for i in range(0, 30, 3):
        good[i] += " password=hunter22x AKIA" + "Z9" * 9
    spam = ["click", "buy", "cheap", "casino", "winner", "bonus", "free"]
    bad = {200 + i: " ".join(w if rnd.random() < 0.6 else rnd.choice(spam) for w in prose(rnd, "en", 200).split())
           for i in range(90)}
    junk = {400 + i: gibberish(rnd, rnd.randint(60, 250)) for i in range(8)} | {410: "too short", 411: None, 412: "a b c d e " * 30}
    copies = {500 + i: good[i] for i in range(10)} | {520 + i: good[40 + i] + " zuletzt" for i in range(10)}
    texts = good | bad | junk | copies
    lang = {i: ["en", "de"][i % 2] if i < 200 else "de" if (500 <= i and i % 2) else "en" for i in texts}
    spark.createDataFrame([(i, t, lang[i], "s", 0) for i, t in texts.items()],
                          "doc_id long, text string, lang string, source string, n_chars long") \
        .repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i not in bad)) for i in [*good, *bad]], "doc_id long, quality int") \
        .write.parquet(str(tmp_path / "labels.parquet"))
    # plain stages: rules, labels learnt, one (the first) of near copies, masks
    verdict = rule_verdicts([(i, t, lang[i]) for i, t in texts.items()])
    want = [{i for i in texts if verdict[i][2]}]
    assert want[0].isdisjoint(junk) and len(want[0] & set(bad)) > 60
    want.append(want[0] - set(bad))
    grams = {i: {tuple(w[k:k + 5]) for k in range(len(w) - 4)} for i in want[1] for w in [lower(texts[i]).split()]}
    near = lambda a, b: 100 * len(grams[a] & grams[b]) >= 80 * len(grams[a] | grams[b])
    want.append({i for i in want[1] if not any(j < i and near(i, j) for j in want[1])})
    assert want[2].isdisjoint(copies)
    masked = {}
    for i in want[2]:
        chars = list(texts[i])
        for a, _, b, _ in spans_of(texts[i]):
            chars[a:b] = "*" * (b - a)
        masked[i] = "".join(chars)
    assert any(masked[i] != texts[i] for i in masked)
    want.append(want[2])
    d = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for (name, step), ids in zip(corpus_pipeline.STAGES[:-1], want):
        d = corpus_pipeline.stage(step(spark, d, str(tmp_path)), name)
        assert sorted(r.doc_id for r in d.collect()) == sorted(ids), name
    assert {r.doc_id: r.text for r in d.collect()} == masked
    tok = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    pieces = []
    for i, t in masked.items():
        ids = np.array(tok.encode(t, add_special_tokens=False).ids + [0], "<u4")
        first = len(ids) % 2048 or min(2048, len(ids))
        for k, (a, b) in enumerate(zip([0, *range(first, len(ids), 2048)], range(first, len(ids) + 1, 2048))):
            pieces.append((i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    same([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows], pieces)


def test_op7_edited_notices(spark):
    idf = {w: 1.0 for t in [n[0] for n in licenses.NOTICES] for w in t.encode().split()}
    index, rows, want = licenses.LicenseIndex(idf), [], {}
    for n, (text, label, keys) in enumerate(licenses.NOTICES):
        ws = text.split()
        fixed = {w for key in keys for w in key.split()}
        voting = [w.decode() for w in list(index.votes[n])[:licenses.RARE]]
        edited = [w for w in voting if w not in fixed][:3]         # three of its rarest words
        rows += [(3 * n, "intro words " + " ".join("qq" if w in edited else w for w in ws) + " tail")]
        rows += [(3 * n + 1, " ".join(ws[::-1]))]                  # the words, not in place
        rows += [(3 * n + 2, " ".join(w if w not in fixed else "qq" for w in ws))]    # without its key phrases
        rows += [(1001 + 3 * n, keys[0])]                          # a key phrase alone
        if len(edited) == 3:
            want[3 * n] = label
    got = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(want) >= 4
    for i, label in want.items():
        assert label in got[i].labels.split(","), i
    for i, r in got.items():
        if i % 3:
            assert set(r.labels.split(",")) == set(r.base_labels.split(",")), i
