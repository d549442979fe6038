"""The operators of the llm subpackage against brute force, planted cases and edge cases."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.oracle_compare import compare
from tidepool.llm import (components, decontaminate, language, licenses, line_dedup, packing,
                          paragraphs, quality_classifier, quality_rules, queries, simhash, toxicity)
from tidepool.llm.common import held_out, table

SF01, SF1 = "/root/testdata/sf0.01", "/root/testdata/sf0.1"
LONG = " ".join(f"wort{i % 977} ist lang" for i in range(40_000))
# null and empty texts, null ids, nulls in every column, repeated rows, one id with two
# texts, ties, a very long text, and extra columns named like internal ones
EDGE = [(1, "", "en", "a"), (2, None, None, None), (None, "a text without an id", "en", "a"),
        (3, LONG, "de", "b"), (4, "same words here today", "en", "a"),
        (4, "same words here today", "en", "a"), (4, "another text for this id", None, "a"),
        (5, "same words here today", "en", None), (6, " \t\n ", "fr", "b"), (7, "!!! 123 ...", "es", "b")]
SCHEMA = "doc_id long, text string, lang string, source string, th int, fp int, h int, key int, n int"


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame([(*r, 0, 0, 0, 0, 0) for r in EDGE], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(3, 1, 0), (4, 0, 1), (4, 1, 1), (1, None, None), (None, 1, 1)],
                                 "doc_id long, quality int, toxic int")


def per_row(docs, labels):
    yield quality_rules.judged(docs)
    yield licenses.license_scan(docs)
    yield simhash.simhash_groups(docs)
    yield line_dedup.deduplicated(docs)
    yield language.predict(docs, language.fit_from_labels(docs))
    yield quality_classifier.predict(docs, quality_classifier.fit_from_labels(docs, labels))
    yield toxicity.predict(docs, toxicity.fit_from_labels(docs, labels))


def test_edge_rows_are_all_answered(edge, labels):
    ids = collections.Counter(r[0] for r in EDGE)
    for out in per_row(edge, labels):
        assert collections.Counter(r["doc_id"] for r in out.collect()) == ids


def test_empty_tables(spark, empty, labels):
    for out in per_row(empty, labels.limit(0)):
        assert out.count() == 0
    bench = spark.createDataFrame([], "item_id long, text string")
    assert packing.packed(empty).count() == 0
    assert paragraphs.repeated_paragraphs(empty).count() == 0
    assert decontaminate.contaminated(empty, bench).count() == 0


# ---- components -------------------------------------------------------------------------

def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    links += [(i, i + 1) for i in range(1000, 1120)] + [(5, 5), (None, 3)]
    got = {r["node"]: r["root"] for r in components.connected_components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert got == roots({x for e in real for x in e}, real)


# ---- packing ----------------------------------------------------------------------------

def test_token_ids_equal_the_tokenizer(spark):
    exact, _ = packing._encoders(packing.VOCABULARY)
    texts = [r["text"] for r in table(spark, SF01, "documents").collect()]
    for t in [*texts[::3], "", " ", "<|endoftext|> a<|endoftext|>", "é́\U0001F600\n\n\t x", "a" * 3000]:
        want = exact.encode(t, add_special_tokens=False).ids + [0]
        assert packing.token_ids(t).tolist() == want
    assert packing.token_ids(None).tolist() == [0]


def test_packing_places_every_piece(spark, edge):
    for docs in (edge, table(spark, SF01, "documents")):
        out = packing.packed(docs).toPandas()
        want = collections.Counter()
        for r in docs.collect():
            ids = packing.token_ids(r["text"])
            first = len(ids) % 2048 or 2048
            cuts = [0, *range(first, len(ids) + 1, 2048)]
            want.update((r["doc_id"], k, s, e - s, zlib.crc32(ids[s:e].tobytes()))
                        for k, (s, e) in enumerate(zip(cuts, cuts[1:])))
        cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
        got = collections.Counter((None if x[0] != x[0] else int(x[0]), *map(int, x[1:]))
                                  for x in out[cols].itertuples(index=False))
        assert got == want
        out = out.sort_values(["sequence_id", "offset"])
        groups = out.groupby("sequence_id")
        assert groups.length.sum().max() <= 2048
        assert (out.offset == groups.length.cumsum() - out.length).all()
        assert out.sequence_id.nunique() <= 1.01 * out.length.sum() / 2048 + 1


def test_configurations_cover_histograms():
    rng = random.Random(1)
    for _ in range(4):
        h = {rng.randrange(1, 65): rng.randrange(1, 400) for _ in range(30)}
        groups, bound = packing.pack(h, 64)
        used = collections.Counter()
        for count, _, content in groups:
            assert sum(n * c for n, c in content) <= 64
            for n, c in content:
                used[n] += count * c
        assert used == collections.Counter(h)
        plain = packing._Bins(64)
        for n in sorted(h, reverse=True):
            plain.best_fit(n, h[n])
        assert bound - 1e-6 <= sum(g[0] for g in groups) <= 1.03 * sum(g[0] for g in plain.groups)


# ---- quality rules ----------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, con, name):
    ok, why = compare(queries.QUERIES[name](spark, SF01), con, queries.ORACLE[name])
    assert ok, why


def test_bad_host_takes_its_documents(spark):
    good = "plain words that nobody repeats in any way at all here number {}"
    rows = [(i, good.format(i), "good") for i in range(40)]
    rows += [(100 + i, good.format(i) + " #" * 30, "bad") for i in range(40)]
    rows += [(200, good.format(1), "bad"), (201, good.format(2), None)]
    out = {r["doc_id"]: r for r in quality_rules.judged(
        spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(out[i]["kept"] for i in range(40)) and out[201]["kept"]
    assert not out[200]["base_failed"] and out[200]["host_failed"] and not out[200]["kept"]


# ---- decontamination --------------------------------------------------------------------

def test_leaks_with_substitutions(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    item = [word() for _ in range(40)]
    noisy = [word() if i % 9 == 4 else w for i, w in enumerate(item)]
    fill = lambda n: [word() for _ in range(n)]
    docs = {1: fill(30) + item + fill(9), 2: fill(7) + noisy, 3: fill(60), 4: item[:20] + fill(5),
            5: item[:9] + fill(30), 6: ["x"] + "one two three four five six".split() + ["y"],
            7: "one two three four five seven".split(), 8: [], 9: ["A-" + w.upper() for w in item]}
    bench = [(1, " ".join(item)), (2, "one two three, four five six"), (3, None), (4, "one two")]
    rows = [(k, " ".join(v)) for k, v in docs.items()] + [(1, " ".join(docs[1])), (10, None)]
    found = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"),
                                       spark.createDataFrame(bench, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(1, 1), (2, 1), (4, 1), (6, 2)}


def test_leaks_beyond_and_between_hits(spark):
    w = [f"item{i}" for i in range(59)]
    other = [f"other{i}" for i in range(59)]
    # a 15-word item with two or three words changed, its hits 12 words apart at most
    short = [f"short{i}" for i in range(15)]
    changed = lambda *at: [other[i] if i in at else x for i, x in enumerate(short)]
    docs = [(1, w[:25] + other[25:46] + w[46:]), (2, w[:5] + other[5:54] + w[54:]),
            (3, ["x"] + changed(1, 13)), (4, changed(0, 1, 14) + ["y"]), (5, changed(0, 1, 2, 14))]
    found = decontaminate.contaminated(
        spark.createDataFrame([(k, " ".join(v)) for k, v in docs], "doc_id long, text string"),
        spark.createDataFrame([(1, " ".join(w)), (2, " ".join(short))], "item_id long, text string"))
    assert {tuple(r)[0:1] + tuple(r)[2:] for r in found.collect()} == {
        (1, 1, 25, 25), (3, 2, 13, 15), (4, 2, 12, 12)}


def test_seed_blocks_give_the_same(spark, monkeypatch):
    docs, bench = table(spark, SF01, "documents"), table(spark, SF01, "benchmark")
    want = sorted(map(tuple, decontaminate.contaminated(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_SEEDS", 1500)
    assert sorted(map(tuple, decontaminate.contaminated(docs, bench).collect())) == want


# ---- language ---------------------------------------------------------------------------

def test_phrases_against_a_direct_parse():
    samples = {"a": "the cat sat on the mat and the rat ran", "b": "el gato se sento en la alfombra roja"}
    m = language.fit(samples)
    texts = ["the rat sat on el gato", "zzz the", "la la la roja mat", ""]
    syms, sizes = language.symbols_of(texts, m.classes)
    got = language.count_phrases(m, syms, sizes)
    clean = lambda t: re.sub(r"[^a-z]+", " ", t.lower())
    for t, row in zip(texts, got):
        for lang, n in zip(m.languages, row):
            text, ref, count, i = clean(t), clean(samples[lang]), 0, 0
            while i < len(text):
                k = 1
                while i + k <= len(text) and text[i:i + k] in ref:
                    k += 1
                i += max(1, k - 1)
                count += 1
            assert n == count


def test_phrases_go_on_across_chunks(monkeypatch):
    rng = random.Random(3)
    text = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    samples = {"a": text(300, "abc "), "b": text(300, "bcde"), "c": "ab" * 150}
    m = language.fit(samples)
    texts = [text(n, "abcdez ") for n in (0, 1, 7, 40, 41, 200)] + ["ab" * 90, "z" * 30]
    syms, sizes = language.symbols_of(texts, m.classes)
    whole = language.count_phrases(m, syms, sizes)
    for chunk in (1, 3, 8, 40):
        monkeypatch.setattr(language, "CHUNK", chunk)
        assert (language.count_phrases(m, syms, sizes) == whole).all()


def test_automata_stay_small_for_large_alphabets():
    rng = random.Random(4)
    letters = [chr(0x4E00 + i) for i in range(3000)]
    samples = {"en": "".join(rng.choice("etaoin shrdlu") for _ in range(20_000))}
    for k in range(3):
        samples[f"x{k}"] = "".join(rng.choice(letters) for _ in range(20_000))
    m = language.fit(samples)
    assert len(m.languages) == 4 and m.nbytes < 16 << 20
    moves = language.suffix_automaton([1, 2, 1, 3, 1, 2, 2])
    base, owner, target = language.displace(moves)
    got = [{c: target[base[s] + c] for c in range(1, 4)
            if 0 <= base[s] + c < len(owner) and owner[base[s] + c] == s} for s in range(len(moves))]
    assert got == moves


def test_language_accuracy_held_out(spark):
    docs = table(spark, SF1, "documents")
    out = language.predict(docs, language.fit_from_labels(docs)).select("doc_id", "lang_pred")
    both = out.join(docs.select("doc_id", "lang"), "doc_id").where(held_out(F.col("doc_id"), 3, 1))
    assert both.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.99


def test_undetermined(edge):
    out = language.predict(edge, language.fit_from_labels(edge)).collect()
    assert {r["doc_id"] for r in out if r["lang_pred"] == "und"} == {1, 2, 6, 7}
    assert all(0 <= r["score"] <= 1 for r in out)


# ---- SimHash ----------------------------------------------------------------------------

def test_fingerprint_by_definition():
    def plain(t, k):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        grams = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    for t in ["", "One", "ÉCOLE Two x", "a b c a b c a b c d", "x\x0by\tz\nÄ w", LONG[:3000]]:
        assert simhash.fingerprint(t, 3) % 2 ** 64 == plain(t, 3)


@pytest.mark.parametrize("crowded", [64, 1])
@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_fingerprint_links(spark, monkeypatch, crowded, bits):
    rng = random.Random(bits)
    fps = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(12):
            fps.add(x)
            x ^= sum({1 << rng.randrange(64) for _ in range(rng.randrange(5))})
    fps |= {0, 2 ** 64 - 1, 2 ** 63}
    signed = [x - 2 ** 64 if x >> 63 else x for x in fps]
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    got = [(r["a"], r["b"]) for r in simhash.fingerprint_links(
        spark.createDataFrame([(x,) for x in signed], "fp long"), bits).collect()]
    want = [(a, b) for a in signed for b in signed
            if a < b and 0 < ((a ^ b) % 2 ** 64).bit_count() <= bits]
    assert all(((a ^ b) % 2 ** 64).bit_count() <= bits for a, b in got)
    assert roots(signed, got) == roots(signed, want)


# ---- licences ---------------------------------------------------------------------------

def test_base_places_by_definition(spark):
    rows = {r["doc_id"]: r["text"] for r in table(spark, SF01, "documents").collect()}
    rows |= {-1: "CC BY cc-by, cc  by by", -2: "All Rights\nReserved all rights reserved", -3: "",
             -4: "general publicé license general public license"}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    for r in licenses.license_scan(docs).collect():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(
            c.lower() if "A" <= c <= "Z" else c for c in rows[r["doc_id"]]))
        at = [(i, label) for p, label in licenses.BASE.items() for i in range(len(w))
              if w[i:i + len(p.split())] == p.split()]
        assert (r["n_words"], r["n_base"]) == (len(w), len(at))
        assert r["first_word"] == min((i for i, _ in at), default=None)
        assert r["last_word"] == max((i for i, _ in at), default=None)
        assert r["base_labels"] == ",".join(sorted({x for _, x in at}))
        assert {x for _, x in at} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_templates_need_their_key_phrase(spark):
    rows = [(1, "x released under the mit license y"), (2, "released under the license of mit"),
            (3, "Licensed under the Apache License, Version 2.0."), (4, "apache mit license gnu")]
    out = {r["doc_id"]: r["labels"] for r in licenses.license_scan(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1] == "mit" and out[2] == "" and out[3] == "apache-2.0"


# ---- line and paragraph dedup -----------------------------------------------------------

def test_patience_aligns_equal_lines_in_order():
    rng = random.Random(2)
    for _ in range(200):
        a = [rng.randrange(12) for _ in range(rng.randrange(15))]
        b = [rng.randrange(12) for _ in range(rng.randrange(15))]
        pairs = sorted(line_dedup.patience(a, b))
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert sorted(line_dedup.patience([1, 2, 3, 9, 4], [0, 1, 2, 3, 4])) == [(0, 1), (1, 2), (2, 3), (4, 4)]


def test_gaps_without_unique_lines_align():
    def longest(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row = _next(row, x, b)
        return row[-1]

    def _next(row, x, b):
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        return new
    rng = random.Random(8)
    for k in range(400):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(25))] for _ in range(2))
        got = sorted(line_dedup.subsequence(a, b, most=1 << 26 if k % 2 else 8))
        assert all(a[i] == b[j] for i, j in got) and len(got) == longest(a, b)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))
    a, b = [0, 1, 2, 1, 2, 3], [4, 1, 2, 5, 1, 2, 6]
    assert sorted(line_dedup.patience(a, b)) == [(1, 1), (2, 2), (3, 4), (4, 5)]


def test_line_dedup(spark):
    body = [f"line number {i} of a shared part" for i in range(5)]
    rows = [(1, "\n".join(["only one", *body, "", "end one"])),
            (2, "\n".join(["only two", *body, "", "end two"])),
            (3, "\n".join(["only one", *body, "", "end one"])), (4, "alone\n\nquite"), (None, "alone\nhere"),
            (5, None), (6, "")]
    out = {r["doc_id"]: r for r in line_dedup.deduplicated(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[2]["text"] == "only two\n\nend two" and out[2]["removed_lines"] == [1, 2, 3, 4, 5]
    assert out[1]["text"] == rows[0][1] and out[1]["n_removed"] == 0
    assert out[3]["text"] in ("", None) and out[3]["n_removed"] >= out[3]["n_lines"] == 7
    assert out[None]["n_removed"] == 0 and out[4]["text"] == "\nquite"
    assert out[5]["text"] is None and out[6]["text"] == ""


@pytest.mark.parametrize("holders", [11, 1000])
def test_line_dedup_of_common_passages(spark, holders):
    shared = ["a passage that many share", "", "and its second line"]
    rows = [(i, "\n".join([f"first {i}", f"second {i}", *shared, f"last {i}"])) for i in range(holders)]
    out = line_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["removed_lines"] for r in out} == {i: [2, 4] if i else [] for i in range(holders)}


def passages(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    fill = lambda n: [word() for _ in range(n)]
    shared = fill(70)
    rows = [(i, " ".join(fill(40) + shared + fill(30))) for i in range(6)]
    rows += [(100 + i, " ".join(fill(120))) for i in range(6)]
    copy = fill(60)
    for i in range(30):         # near copies: one word differs in each
        w = list(copy)
        w[rng.randrange(60)] = word()
        rows.append((200 + i, " ".join(w)))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_passages_found_and_clean_documents_left(spark, monkeypatch):
    docs = passages(spark)
    out = paragraphs.repeated_paragraphs(docs).collect()
    ids = {r["doc_id"] for r in out}
    assert set(range(6)) <= ids and not ids & set(range(100, 106))
    assert {r["first_doc_id"] for r in out if r["doc_id"] in range(6)} == {0}
    assert len({r["doc_id"] for r in out if r["doc_id"] >= 200}) >= 28
    key = lambda rows: sorted((r["doc_id"], r["start"], r["first_doc_id"], r["first_start"])
                              for r in rows)
    monkeypatch.setattr(paragraphs, "CROWDED", 1)
    assert key(paragraphs.repeated_paragraphs(docs).collect()) == key(out)


def test_families_joined_by_members_that_have_hubs(spark):
    # 1-10, 10-11 and 11-2 share 18 of 22 shingles, no other pair reaches the threshold
    at = {1: 0, 10: 2, 11: 4, 2: 6, 0: 100}
    sets = spark.createDataFrame([(h, list(range(i, i + 20))) for h, i in at.items()],
                                 "h long, s array<long>")
    crowd = spark.createDataFrame([(1, 1), (1, 10), (2, 2), (2, 11), (3, 0), (3, 10), (3, 11)],
                                  "key long, h long")
    links = {(r["a"], r["b"]) for r in paragraphs._crowd_links(crowd, sets).collect()}
    assert {tuple(sorted(e)) for e in links} == {(1, 10), (10, 11), (2, 11)}


def test_paragraphs_by_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    words = {r["doc_id"]: r["text"].encode().lower().split() for r in docs.collect()}
    sets, where = {}, collections.defaultdict(set)
    places = paragraphs.paragraphs(docs).collect()
    for r in places:
        w = words[r["doc_id"]][r["start"]:r["start"] + r["n"]]
        sets[r["h"]] = frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        where[r["h"]].add(r["doc_id"])
    inv = collections.defaultdict(set)
    for h, s in sets.items():
        for x in s:
            inv[x].add(h)
    near = {(a, b) for hs in inv.values() for a in hs for b in hs if a < b
            and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    root = roots(sets, near)
    spread = collections.defaultdict(set)
    for h in sets:
        spread[root[h]] |= where[h]
    want = {(r["doc_id"], r["start"]) for r in places if len(spread[root[r["h"]]]) > 1}
    got = {(r["doc_id"], r["start"]) for r in paragraphs.repeated_paragraphs(docs).collect()}
    assert got <= want and len(got) >= 0.97 * len(want)


# ---- classifiers ------------------------------------------------------------------------

def auc(y, s):
    order = np.argsort(np.argsort(s, kind="stable"), kind="stable") + 1.0
    y = np.asarray(y)
    return (order[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


@pytest.mark.parametrize("name, label, least", [("op3_quality_classifier", "quality", 0.95),
                                                ("op4_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    out = queries.QUERIES[name](spark, SF1).where("held_out")
    rows = out.join(table(spark, SF1, "labels"), "doc_id").select("score", label).toPandas()
    assert rows.score.between(0, 1).all()
    assert auc(rows[label].to_numpy(), rows.score.to_numpy()) > least


def test_maximal_segments_by_definition():
    def plain(x):
        """The segment with the largest sum (shortest, leftmost), then both sides of it."""
        best = max(((round(sum(x[i:j]), 9), -(j - i), -i) for i in range(len(x))
                    for j in range(i + 1, len(x) + 1)), default=(0, 0, 0))
        if best[0] <= 0:
            return []
        i, j = -best[2], -best[2] - best[1]
        return [(i, j - 1)] + plain(x[:i]) + [(a + j, b + j) for a, b in plain(x[j:])]
    rng = random.Random(8)
    for _ in range(300):
        x = [rng.choice([-0.5, -0.5, -0.5, 1.25, 0.7, 2.1]) for _ in range(rng.randrange(16))]
        hits = [(i, s) for i, s in enumerate(x) if s > 0]
        got = toxicity.maximal_segments(hits, 0.5)
        total = lambda p: sorted(round(sum(x[a:b + 1]), 6) for a, b in p)
        assert total([(a, b) for a, b, _ in got]) == total(plain(x))
        assert all(math.isclose(s, sum(x[a:b + 1])) for a, b, s in got)


def test_toxic_passages_are_placed():
    m = toxicity.Model({"vile": 4.0}, 2.0, 0.1)
    score, found = toxicity.judge("calm words " * 20 + "Vile vile, vile " + "and more " * 20, m)
    assert score > 0.9 and [(a, b) for a, b, _ in found] == [(40, 42)]
    assert toxicity.judge("calm words", m) == (0.0, []) and toxicity.judge("", m) == (0.0, [])


# ---- the pipeline -----------------------------------------------------------------------

def test_pipeline_stages(spark):
    import corpus_pipeline as p
    docs = table(spark, SF01, "documents")
    rows = docs.count()
    sizes = []
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, SF01)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        sizes.append(out.count())
    gone = line_dedup.deduplicated(docs).where("n_removed > 0 AND n_removed = n_lines").count()
    assert sizes[0] >= 0.99 * rows and sizes[1] == rows - gone
    assert 0 <= docs.select("text").distinct().count() - sizes[1] <= 5
    groups = simhash.simhash_groups(docs)
    assert sizes[2] == groups.select("root").distinct().count()
    leaks = decontaminate.contaminated(docs, table(spark, SF01, "benchmark"))
    assert sizes[3] == rows - leaks.select("doc_id").distinct().count()
    assert p.run(spark, SF01).select("doc_id").distinct().count() > 0.85 * rows
