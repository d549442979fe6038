"""Hard negatives, suffix-array dedup and phrase collocations against brute force."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tidepool.llm import hard_negatives, line_dedup, phrases, suffix_index
from tidepool.llm.queries import ORACLE, QUERIES
from tests.conftest import SF01
from tests.oracle_compare import compare


@pytest.mark.parametrize("name", [n for n in QUERIES if re.match("op1[123]_", n)])
def test_equals_its_sql(spark, con, name):
    ok, message = compare(QUERIES[name](spark, SF01), con, ORACLE[name])
    assert ok, message


# -- suffix-array dedup -------------------------------------------------------------------

def cut(texts):
    """(n_removed, maximal ranges, rest) of every text by counting all windows."""
    m, count = suffix_index.MATCH, collections.Counter()
    for t in texts:
        count.update(t[p:p + m] for p in range(len(t) - m + 1))
    out = []
    for t in texts:
        mark = bytearray(len(t))
        for p in range(len(t) - m + 1):
            if count[t[p:p + m]] > 1:
                mark[p:p + m] = b"\1" * m
        runs = [x.span() for x in re.finditer(b"\1+", bytes(mark))]
        out.append((sum(mark), runs, bytes(c for c, k in zip(t, mark) if not k)))
    return out


def test_suffix_family_equals_all_windows(spark):
    """Shared passages with varied edges, overlaps, near copies, a periodic text, a repeat
    inside one text, copies under one id and several, texts of 399 to 401 bytes."""
    r = random.Random(4)
    def prose(n):
        return "".join(r.choice("abcdefgh \u00e9\n") for _ in range(n))
    passage, half = prose(900), prose(390)
    texts = [prose(r.randint(0, 300)) + passage[r.randint(0, 300):r.randint(500, 900)] + prose(50)
             for _ in range(25)]
    twin = prose(3000)
    texts += [twin, twin[:1500] + "#" + twin[1501:], "ab" * 700, half + "x" + half, None, "",
              prose(200) + passage + prose(10) + passage + half, twin[:399], twin[:400], twin[:401],
              passage * 3, "z" * 1200, prose(500), *["copy " * 90] * 3]
    rows = [(None if i == 7 else i % 40, t, i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, t1 int").repartition(5)
    want = cut([(t or "").encode() for t in texts])
    for batches in (1, 3):
        got = suffix_index.without_repeats(docs, batches).collect()
        assert sorted((x["doc_id"] or -1, x["n_removed"], [tuple(y) for y in x["removed"]], bytes(x["kept"]))
                      for x in got) == sorted(
            ((-1 if d is None else d) or -1, *w) for (d, _, _), w in zip(rows, want))
        assert all(x["n_bytes"] == x["n_removed"] + len(x["kept"]) for x in got)
    assert sum(w[0] for w in want) > 10_000


def test_suffix_family_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_index.without_repeats(empty, 2).collect() == []


def test_anchors_depend_on_window_bytes_only():
    rng = np.random.default_rng(1)
    shared = rng.integers(0, 4, 1000, dtype=np.uint8)
    seen = []
    for left in (0, 17, 333):
        block = np.concatenate([rng.integers(0, 4, left, dtype=np.uint8), shared])
        _, first, last, anchor = suffix_index.entries(
            block, np.array([0, len(block)]), suffix_index.Rolling(block))
        at = {}
        for f, l, a in zip(first, last, anchor):
            for p in range(max(f, left), l + 1):
                at[p - left] = a - left
        seen.append(at)
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 601


# -- phrase collocations ------------------------------------------------------------------

def collocations(rows, least, top):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(low)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang or "und"] += len(w)
            for k in range(1, 6):
                f[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = {q[i:j] for q, b in found.items() for i in range(len(q))
                  for j in range(i + 2, len(q) + 1) if j - i < len(q) and b >= found[q[i:j]]}
        best = []
        for p in found.keys() - inside:
            score, k = min((1000 * c[p] * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -c[p], " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s)
                for i, (s, a, p, l, r) in enumerate(sorted(best)[:top])]
    return sorted(out)


def test_collocations_equal_a_count_of_all_phrases(spark):
    """Small shards, so that phrases are summed over many; fixed phrases, a doubled word,
    an own language for null, borders at every place."""
    r = random.Random(9)
    words = ["The", "of", "new", "york", "Times", "\u00e9tat", "a", "b", "a-b", "\u00c9"]
    def text():
        out = []
        for _ in range(r.randint(0, 60)):
            out.append(r.choice(["new york times", "a a a", r.choice(words), r.choice(words)]))
            out.append(r.choice([" ", "  ", "\t", ", ", ".", "\n", " ? ", ":"]))
        return "".join(out)
    rows = [(r.choice(["en", "en", "fr", None]), r.choice([text(), text(), None, "", " . ,"]))
            for _ in range(300)]
    docs = spark.createDataFrame([(*x, 1) for x in rows], "lang string, text string, id int").repartition(6)
    got = sorted(map(tuple, phrases.collocations(docs, 12, 50, shard_bytes=500).collect()))
    assert got == collocations(rows, 12, 50) and {x[0] for x in got} == {"en", "fr", "und"}


def test_counts_leave_groups_of_shards_summed(spark, monkeypatch):
    """80 shards of one text: from three words on, rows follow Spark's cores, not shards."""
    made, write = {}, phrases.durable
    def counted(df, name, *rest):
        out = write(df, name, *rest)
        if name.startswith("phrase-extensions"):
            made[name] = out.where("word IS NOT NULL").count(), out.where("left_min IS NOT NULL").count()
        return out
    monkeypatch.setattr(phrases, "durable", counted)
    docs = spark.createDataFrame([("en", "a b c d e f g")] * 80, "lang string, text string").repartition(4)
    got = sorted(map(tuple, phrases.collocations(docs, 80, shard_bytes=1).collect()))
    assert got == collocations([("en", "a b c d e f g")] * 80, 80, None)
    cores = spark.sparkContext.defaultParallelism
    assert cores < 40 and len(made) == 3
    for size, (extensions, beside) in zip((3, 4, 5), (made[x] for x in sorted(made))):
        assert 8 - size <= extensions <= cores * (8 - size) and 9 - size <= beside <= cores * (9 - size)


def test_sums_of_a_group_are_bounded(monkeypatch):
    """A group with more counts than a task holds leaves in parts with the same sums."""
    r = random.Random(5)
    want, sides, states = collections.Counter(), {}, []
    for group in (1, 1, 1, 2, 2):
        pairs = sorted({(r.randint(1, 9), r.randint(1, 9)) for _ in range(20)})
        n = [r.randint(1, 5) for _ in pairs]
        beside = {own: sorted(r.randint(0, 9) for _ in range(2)) for own in range(1, 8)}
        for (p, w), k in zip(pairs, n):
            want[group, p, w] += k
        for own, (a, b) in beside.items():
            x, y = sides.get((group, own), (a, b))
            sides[group, own] = min(a, x), max(b, y)
        low, high = zip(*beside.values())
        columns = [*zip(*pairs), n, list(beside), low, high, low, high]
        names = ["parent", "word", "n", *phrases.STATE[6:]]
        packed = phrases._packed({c: np.array(x) for c, x in zip(names, columns)})
        states.append(pa.RecordBatch.from_arrays(
            [pa.array([group]), *[pa.array(packed[c], pa.binary()) for c in names]], names=["group", *names]))
    rows = {}
    for held in (10, 10_000):
        monkeypatch.setattr(phrases, "HELD", held)
        out = [x for b in phrases._sum_batches(iter(states)) for x in b.to_pylist()]
        got, seen = collections.Counter(), {}
        for x in out:
            if x["word"] is not None:
                got[x["group"], x["parent"], x["word"]] += x["n"]
            else:
                assert (x["left_min"], x["left_max"]) == (x["right_min"], x["right_max"])
                a, b = seen.get((x["group"], x["parent"]), (x["left_min"], x["left_max"]))
                seen[x["group"], x["parent"]] = min(a, x["left_min"]), max(b, x["left_max"])
        assert got == want and seen == sides
        rows[held] = len(out)
    assert rows[10_000] == len(want) + len(sides) < rows[10]


def test_no_collocations(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(empty, 2).collect() == []


def test_bidirectional_intervals_find_every_occurrence():
    r = random.Random(2)
    t = np.array([0, *[r.choice([0, 1, 1, 2, 2, 3]) for _ in range(400)], 0], dtype=np.int32)
    fwd, rev = phrases.transform(t), phrases.transform(t[::-1])
    used, lo, n = phrases._single(t, 4)
    level = {(int(s),): (int(a), int(a), int(c)) for s, a, c in zip(used, lo, n)}
    for size in range(2, 6):
        keys = list(level)
        f, b, n = (np.array([level[k][i] for k in keys]) for i in range(3))
        least, most = phrases.neighbours(fwd, f, n)
        for k, x, y in zip(keys, least, most):
            at = [i for i in range(1, len(t)) if tuple(t[i:i + len(k)]) == k]
            assert (min(t[i - 1] for i in at), max(t[i - 1] for i in at)) == (x, y)
        grown = phrases.extend_right(rev, phrases.last_to_first(rev), f, b, n)
        level = {(*keys[p], int(w)): (int(x), int(y), int(c)) for p, w, x, y, c in zip(*grown)}
        want = collections.Counter(tuple(t[i:i + size].tolist()) for i in range(len(t) - size + 1))
        assert {k: v[2] for k, v in level.items()} == {k: v for k, v in want.items() if 0 not in k}


# -- hard negatives -----------------------------------------------------------------------

def mined(rows, dot):
    out = []
    for a, la, qa in rows:
        if a % 50:
            continue
        near = sorted((-dot(qa, q), i) for i, l, q in rows if l == la and i != a and len(q) == len(qa))[:5]
        for s, p in near:
            far = sorted((-dot(qa, q), i) for i, l, q in rows if l != la and len(q) == len(qa)
                         and 50 * -s <= 100 * dot(qa, q) <= 95 * -s)[:3]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i) in enumerate(far)]
    return sorted(out)


def test_hard_negatives_equal_all_pairs(spark, monkeypatch):
    """Ties, one very common vector, two dimensions, values beyond 32 bits, rows that take
    no part; small tiles, so that searches go over many trees."""
    monkeypatch.setattr(hard_negatives, "TILE", 40)
    monkeypatch.setattr(hard_negatives, "BLOCK", 3)
    r = random.Random(3)
    rows = []
    for i in range(700):
        v = [r.choice([0.0, 0.25, 0.5, 1.0, -0.25]) for _ in range(3)]
        v = [0.5, 0.5, 0.5] if i % 3 == 0 else v + [1.0] if i % 10 == 1 else v
        rows.append((i, r.randrange(4), [x * 2 ** 25 for x in v] if i % 50 == 11 else v))
    bad = [(1000, None, [1.0, 1.0, 1.0]), (1050, 1, None), (1100, 1, [1.0, None, 0.0]),
           (1150, 1, [1.0, float("nan"), 0.0]), (1200, 1, [float("inf"), 0.0, 0.0]), (None, 1, [1.0] * 3),
           (1250, 1, [])]
    df = spark.createDataFrame([(*x, 0) for x in rows + bad + rows[:30]],
                               "vec_id long, label int, embedding array<double>, dim int")
    part = hard_negatives.participants(df)
    got = hard_negatives.hard_negatives(part, part.where("vec_id % 50 = 0")).collect()
    exact = [(i, l, [int(np.floor(256 * x)) for x in v]) for i, l, v in rows]
    want = mined(exact, lambda a, b: sum(x * y for x, y in zip(a, b)))
    cols = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(x[c] for c in cols) for x in got) == want and len(want) > 50


def test_no_hard_negatives(spark):
    empty = hard_negatives.participants(
        spark.createDataFrame([], "vec_id long, label int, embedding array<float>"))
    assert hard_negatives.hard_negatives(empty, empty).collect() == []


def test_tree_prunes_and_stays_exact():
    rng = np.random.default_rng(5)
    rows = np.sort(rng.integers(-9, 9, (900, 3)), axis=0)
    order = hard_negatives.str_order(rows, 16)
    assert sorted(order.tolist()) == list(range(900))
    tree = hard_negatives.RTree(np.arange(900)[order], rows[order], 16, 4)
    q = np.array([3, -2, 5])
    low, high = tree.intervals(q[None])
    scores = rows[order] @ q
    for node in range(tree.leaves_from, len(tree.first)):
        s = scores[tree.first[node]:tree.last[node]]
        assert low[0, node] <= s.min() and s.max() <= high[0, node]
    windows = [(-30, 10), (0, 40), (5, 4)]
    got = tree.search(q, low[0].tolist(), high[0].tolist(), 4, windows)
    for w, found in zip(windows, got):
        want = sorted((-int(s), int(i)) for s, i in zip(scores, tree.ids) if w[0] <= s <= w[1])[:4]
        assert sorted((-s, i) for s, i in found) == want


# -- clashing names -----------------------------------------------------------------------

def test_line_dedup_replaces_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b\nc", 7, 8, 9), (2, "x\na b", 7, 8, 9)],
                                 "doc_id long, text string, n_lines int, n_removed int, removed_lines int")
    out = {r["doc_id"]: r.asDict() for r in line_dedup.deduplicated(docs).collect()}
    assert out[2]["text"] == "x" and out[2]["n_lines"] == 2 and out[2]["removed_lines"] == [1]
    kept = {r["doc_id"]: r.asDict() for r in line_dedup.deduplicated(docs, "own_").collect()}
    assert kept[2]["n_removed"] == 8 and kept[2]["own_n_removed"] == 1
