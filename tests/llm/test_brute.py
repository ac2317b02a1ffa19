"""Plain-Python versions of the quotation links, the URL trees, the quality scores and the top-k search."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest

from streetlake.llm import quality_model, quotes, topk, urls

QUOTED = re.compile(r"\s*>[\s>]*", re.ASCII)


def line_of(line):
    """(level, normal text) of a line."""
    head = QUOTED.match(line)
    rest = line[head.end():] if head else line
    return (head.group().count(">") if head else 0), re.sub(r"\s+", " ", rest, flags=re.ASCII).strip(" ").lower()


def passages(text):
    """Distinct (level, passage) of a text: its lines, and its runs of lines of one level."""
    lines = [line_of(x) for x in text.split("\n")]
    out, run = set(lines), []
    for level, words in lines + [(None, "")]:
        if run and (not words or level != run[0][0]):
            out.add((run[0][0], " ".join(w for _, w in run)))
            run = []
        if words:
            run.append((level, words))
    return {(level, words) for level, words in out if words}


def linked(rows):
    """The rows of link_quotes, one message after the other."""
    first, votes = {}, collections.defaultdict(collections.Counter)
    placed = [(c, t, passages(x)) for c, t, _, x in rows if None not in (c, t, x)]
    for c, t, parts in placed:
        for level, words in parts:
            if not level:
                first[c, words] = min(t, first.get((c, words), t))
    for c, t, parts in placed:
        for level, words in parts:
            source = first.get((c, words))
            if level and source is not None and source < t:
                votes[c, t][level, source] += 1
    parent = {}
    for key, count in votes.items():
        outer = min(level for level, _ in count)
        parent[key] = max((n, source) for (level, source), n in count.items() if level == outer)[1]
    out = []
    for c, t, role, text in rows:
        lines = [] if text is None else text.split("\n")
        levels = [line_of(x)[0] for x in lines]
        n = sum(x > 0 for x in levels)
        clean = "\n".join(x for x, level in zip(lines, levels) if not level).strip(" \t\r\n") if n else text
        root, depth = t, 0
        while n and (c, root) in parent:
            root, depth = parent[c, root], depth + 1
        out.append((c, t, role, clean, n, max(levels, default=0), parent.get((c, t)) if n else None, root, depth))
    return out


def conversations(seed):
    """Messages that quote earlier, later and no messages, nested, wrapped anew, cut and respaced."""
    rnd = random.Random(seed)
    say = lambda: " ".join(rnd.choice("Yes no Maybe so the cat sat on a mat".split()) for _ in range(rnd.randint(1, 4)))
    rows = []
    for c in range(12):
        told = []
        for t in range(rnd.randint(1, 12)):
            lines = []
            for _ in range(rnd.randint(0, 3)):
                if told and rnd.random() < 0.8:
                    body = rnd.choice(told).split("\n")
                    lo = rnd.randrange(len(body))
                    body = body[lo:rnd.randint(lo + 1, len(body))]
                    if rnd.random() < 0.3:
                        body = re.findall(r"\S+(?:\s\S+)?", " ".join(body)) or [""]
                    mark = rnd.choice([">", "> ", " >", ">> ", "> > ", ">\t"])
                    lines += [mark + (x.upper() if rnd.random() < 0.3 else x.replace(" ", "  ")) for x in body]
                else:
                    lines.append("> " + say())
                lines += rnd.choice([[], [""], [">"], [say()]])
            lines += [say() for _ in range(rnd.randint(0, 3))]
            told.append("\n".join(lines))
        rows += [(c, t, rnd.choice(["user", "assistant"]), x) for t, x in enumerate(told)]
    rows += rnd.sample(rows, 6)                                             # rows twice
    rows += [(c, t, "user", "> " + x) for c, t, _, x in rnd.sample(rows, 3)]    # one turn, two texts
    return rows + [(None, 1, "user", "> yes"), (2, None, "user", "> yes"), (3, 2, None, None), (4, 90, "user", "")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_op6_links(spark, seed):
    rows = conversations(seed)
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, root string")
    got = quotes.link_quotes(df.repartition(5))
    names = ["conv_id", "turn", "role", "clean_text", "n_quoted", "quote_levels", "reply_to", "root_turn", "depth"]
    want = linked(rows)
    assert sum(r[6] is not None for r in want) > 20 and max(r[8] for r in want) > 2
    assert collections.Counter(map(tuple, got.select(*names).collect())) == collections.Counter(want)


# --- URL trees ------------------------------------------------------------------

def plain_features(url, path, host):
    u = url or ""
    counts = collections.Counter(u)
    query = re.search(r"\?([^#]*)", u)
    size = max(len(u), 1)
    return [len(u), sum(bool(x) for x in path.split("/")), sum(x in "0123456789" for x in u) / size,
            -sum(n / len(u) * math.log2(n / len(u)) for n in counts.values()),
            sum(bool(x) for x in query.group(1).split("&")) if query else 0,
            len(host.split(".")), len(host), sum(x in "-_" for x in u)]


def grown(bins, y):
    """Scores of all rows of ``bins``; the trees are grown on those with a label."""
    known = ~np.isnan(y)
    x, t = bins[known], y[known]
    prior = min(max(t.mean(), 1e-3), 1 - 1e-3)
    score, at = np.full(len(bins), math.log(prior / (1 - prior))), known

    def split(rows, g, h):
        best = None
        for f in range(x.shape[1]):
            for b in sorted(set(x[rows, f]))[:-1]:
                left = rows & (x[:, f] <= b)
                right = rows & ~left
                gain = sum(g[s].sum() ** 2 / (h[s].sum() + urls.RIDGE) for s in (left, right)) \
                    - g[rows].sum() ** 2 / (h[rows].sum() + urls.RIDGE)
                if best is None or gain > best[0] + 1e-12:
                    best = (gain, f, b, left, right)
        return best if best and best[0] > 1e-9 else None

    for _ in range(urls.ROUNDS):
        p = 1 / (1 + np.exp(-score[at]))
        g, h = t - p, p * (1 - p)
        leaf = lambda rows: urls.STEP * g[rows].sum() / (h[rows].sum() + urls.RIDGE)
        root = split(np.ones(len(t), bool), g, h)
        if root is None:
            break
        _, f, b, left, right = root
        add = np.zeros(len(bins))
        for side, rows in ((bins[:, f] <= b, left), (bins[:, f] > b, right)):
            under = split(rows, g, h)
            if under is None:
                add[side] = leaf(rows)
            else:
                _, f2, b2, l2, r2 = under
                add[side & (bins[:, f2] <= b2)] = leaf(l2)
                add[side & (bins[:, f2] > b2)] = leaf(r2)
        score = score + add
    return score


def test_op9_trees_and_verdicts(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(300):
        host = "".join(rnd.choice("abcxyz0-") for _ in range(rnd.randint(1, 12))) + rnd.choice(
            [".net", ".org", ".example.com", ".example.net", ".com", ".io"])
        path = "".join("/" + rnd.choice(["en", "de", "fr", "a-b", "p_1", "123"]) for _ in range(rnd.randint(0, 4)))
        path = rnd.choice([path, path + "/", "/fr" + path, "/de/" + path, "/en/"])
        rows.append((i, "https://" + host + path + rnd.choice(["", "?a=1", "?a=1&b=2&&", "#t", "?x#y?z=1"])))
    rows += [(300, "ftp:none"), (301, "http://"), (None, rows[0][1])]
    df = spark.createDataFrame(rows, "page_id long, url string")
    feats = urls.lexical(urls.with_rule(df)).collect()
    for r in feats:
        want = plain_features(r.url, r.path, r.host)
        assert [r[f] for f in urls.FEATURES[:8]] == pytest.approx(want, abs=1e-9), r.url
    y = np.array([math.nan if r.rule_verdict is None else float(r.rule_verdict == "block") for r in feats])
    known = ~np.isnan(y)
    assert 40 < known.sum() < len(y) - 40 and 0.1 < y[known].mean() < 0.9
    suffix = [r.host.rsplit(".", 1)[-1] for r in feats]
    pages, blocked, labelled = collections.Counter(suffix), collections.Counter(), collections.Counter()
    for s, v in zip(suffix, y):
        if not math.isnan(v):
            blocked[s] += v
            labelled[s] += 1
    prior = y[known].mean()
    x = np.array([[r[f] for f in urls.FEATURES[:8]]
                  + [(blocked[s] + 5 * prior) / (labelled[s] + 5), pages[s] / len(feats)] for r, s in zip(feats, suffix)])
    bins = np.zeros(x.shape, int)
    for f in range(x.shape[1]):
        ordered = sorted(x[known, f])
        edges = {ordered[max(math.ceil(k / urls.BINS * len(ordered)), 1) - 1] for k in range(1, urls.BINS)}
        bins[:, f] = sum((x[:, f] > e).astype(int) for e in edges)
    p = 1 / (1 + np.exp(-grown(bins, y)))
    assert 0 < (p[~known] > 0.5).sum() < (~known).sum()
    got = collections.defaultdict(list)
    for r in urls.judge_urls(df).collect():
        got[r.page_id, r.host, r.path].append((r.verdict, r.block_probability))
    for r, q in zip(feats, p):
        verdict, found = got[r.page_id, r.host, r.path].pop()
        assert found == pytest.approx(q, abs=1e-9), r.url
        assert verdict == (r.rule_verdict or ("block" if q > 0.5 else "allow"))
    assert not any(got.values())


# --- quality scores -------------------------------------------------------------

def pooled(x, y, w):
    """Non-decreasing weighted least squares by the min-max formula."""
    mean = lambda a, b: np.dot(y[a:b + 1], w[a:b + 1]) / w[a:b + 1].sum()
    return np.array([max(min(mean(a, b) for b in range(i, len(x))) for a in range(i + 1)) for i in range(len(x))])


def test_op2_scores_by_plain_equations(spark):
    rnd = random.Random(8)
    words = "The cat sat on a mat, and so did I! *** ## 12 x9 été || A-Z lorem".split()
    rows = [(i, " ".join(rnd.choice(words[:9 + (i % 4) * 3]) for _ in range(rnd.randint(0, 90))) + "\n" * (i % 3))
            for i in range(240)] + [(240, None), (241, " \n ")]
    labels = [(i, int(rnd.random() < (0.9, 0.7, 0.3, 0.1)[i % 4])) for i, _ in rows if i % 7] + [(9999, 1), (None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r.doc_id: r for r in quality_model.classify(
        docs, spark.createDataFrame(labels, "doc_id long, quality int").repartition(3)).collect()}
    stats = {i: np.array(quality_model.statistics((t or "").encode())) for i, t in rows}
    fold = {i: zlib.crc32(str(i).encode()) % 5 for i, _ in rows}
    train = [(stats[i], q) for i, q in labels if i in stats and fold[i] in (1, 2, 3)]
    held = [(stats[i], q) for i, q in labels if i in stats and fold[i] == 4]
    x, y = np.array([s for s, _ in train]), np.array([q for _, q in train], float)
    mean, scale = x.mean(0), x.std(0)
    scale[scale <= 1e-9] = 1
    rng = np.random.default_rng(7)
    omega = rng.normal(0, 1 / math.sqrt(quality_model.N_STATS / 2), (quality_model.N_STATS, quality_model.N_FEATURES))
    phase = rng.uniform(0, 2 * math.pi, quality_model.N_FEATURES)

    def phi(s):
        z = np.clip((s - mean) / scale, -8, 8)
        return np.append(np.cos(z @ omega + phase) * math.sqrt(2 / quality_model.N_FEATURES), 1.0)

    a = np.array([phi(s) for s in x])
    # ridge as least squares with rows added for the penalty
    penalty = math.sqrt(quality_model.RIDGE * len(y) / a.shape[1])
    weights = np.linalg.lstsq(np.vstack([a, penalty * np.eye(a.shape[1])]), np.append(y, np.zeros(a.shape[1])), rcond=None)[0]
    bins = collections.defaultdict(list)
    for s, q in held:
        raw = min(max(phi(s) @ weights, -1), 2)
        bins[math.floor((raw + 1) / 3 * quality_model.BINS)].append((raw, q))
    knots = sorted((np.mean([r for r, _ in v]), np.mean([q for _, q in v]), len(v)) for v in bins.values())
    kx, ky, kw = map(np.array, zip(*knots))
    levels = pooled(kx, ky, kw)
    want = {i: float(np.clip(np.interp(phi(s) @ weights, kx, levels), 0, 1)) for i, s in stats.items()}
    assert len(set(want.values())) > 20 and set(got) == set(want)
    for i, s in want.items():
        assert got[i].score == pytest.approx(s, abs=1e-6), i
        assert got[i].held_out == (fold[i] == 0)
        assert got[i].predicted == int(got[i].score >= 0.3)


# --- repeated ids in the top-k search --------------------------------------------

@pytest.mark.parametrize("candidates, queries, numbers", [(16_384, 4_096, 1 << 22), (17, 3, 1 << 22), (64, 8, 40)])
def test_op4_queries_are_rows(spark, monkeypatch, candidates, queries, numbers):
    monkeypatch.setattr(topk, "CANDIDATES", candidates)
    monkeypatch.setattr(topk, "QUERIES", queries)
    monkeypatch.setattr(topk, "NUMBERS", numbers)
    rng = np.random.default_rng(9)
    rows = [(int(i), [float(v) for v in rng.normal(size=4)]) for i in rng.integers(0, 60, 90)]
    rows += [(50, [float(v) for v in rng.normal(size=4)]) for _ in range(40)]      # one id on a third of all rows
    rows += rows[:10] + rows[-3:] + [(0, [0.0] * 4)] * 2
    df = spark.createDataFrame([(*r, 1, 2) for r in rows],
                               "vec_id long, embedding array<double>, row long, d int").repartition(4)
    ints = [np.floor(256 * np.array(v)).astype(int) for _, v in rows]
    want = []
    for a, (i, _) in enumerate(rows):
        if i % 50 == 0:
            best = sorted((-int(ints[a] @ ints[b]), rows[b][0]) for b in range(len(rows)) if b != a)[:5]
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    got = topk.exact_top_k(df).select("query_id", "rank", "vec_id", "score").collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)
