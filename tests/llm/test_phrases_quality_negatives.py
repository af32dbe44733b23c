"""Collocations, quality scores and hard negatives on messy rows, against brute force."""

import collections
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

llm = pytest.importorskip("meteoloom.llm")
from meteoloom.llm import collocations, hard_negatives, quality, quotient  # noqa: E402

EXTRA = "shard long, words array<string>, codes binary, at int, id long, f long, w1 long, score double, good boolean, statistics int, leaf int, block int, tag long, n long, _id long, _doc long"


def frame(spark, rows, schema):
    """Rows with columns whose names clash with internal ones."""
    n = EXTRA.count(",") + 1
    return spark.createDataFrame([(*r, *[None] * n) for r in rows], f"{schema}, {EXTRA}")


# ------------------------------------------------------------------ counting quotient filters


@pytest.mark.parametrize("width", [32, 47, 63, 64, 96])
@pytest.mark.parametrize("prefix_bits", [0, 3, 9])
def test_filters_give_their_keys_back(width, prefix_bits):
    rng = np.random.default_rng(width + prefix_bits)
    top = lambda n, bits: rng.integers(0, 2**bits, n, dtype=np.uint64) if bits < 64 else rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n, dtype=np.uint64)
    for n in (1, 2, 700, 5000):
        pool = [top(n, min(width, 64))] + ([top(n, width - 64)] if width > 64 else [])
        pick = rng.integers(0, n, 3 * n)
        keys = [c[pick] for c in pool]
        weight = rng.choice([1, 1, 1, 2, 127, 128, 300, 16384, 2**40], 3 * n).astype(np.int64)
        assert all((a == b).all() for a, b in zip(quotient.restore(quotient.permute(keys, width), width), keys, strict=True))
        want = collections.Counter()
        for k, w in zip(zip(*(c.tolist() for c in keys), strict=True), weight.tolist(), strict=True):
            want[k] += w
        # Two shards, merged filter by filter.
        shards = [quotient.build([c[s] for c in keys], weight[s], width, prefix_bits) for s in (slice(0, n), slice(n, None))]
        by = collections.defaultdict(list)
        for prefix, data in (x for s in shards for x in s):
            by[prefix].append(quotient.decode(data, width, prefix_bits, prefix))
        got = collections.Counter()
        for parts in by.values():
            merged, counts = quotient.merge(parts)
            assert len(merged[0]) == 1 or all(np.diff(merged[0].astype(object)) >= 0)
            for k, c in zip(zip(*(c.tolist() for c in quotient.restore(merged, width)), strict=True), counts.tolist(), strict=True):
                assert k not in got
                got[k] = c
        assert got == want


def test_permutation_is_one_to_one_and_filters_are_compact():
    x = np.arange(1 << 12, dtype=np.uint64)
    assert len(np.unique(quotient.permute([x], 12)[0])) == 1 << 12
    keys = [np.random.default_rng(1).integers(0, 2**48, 100_000, dtype=np.uint64)]
    held = quotient.build(keys, np.ones(100_000, np.int64), 48, 0)[0][1]
    assert len(held) < 100_000 * 5.5  # 48 bits of key and a counter in plain form: 14 bytes
    assert quotient.build([np.zeros(0, np.uint64)], np.zeros(0, np.int64), 32, 4) == []


# ------------------------------------------------------------------ op11


def phrases_by_hand(rows, least=10, share=50, top=2000):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, c in f.items():
        cand, long = [], collections.Counter()
        for p, a in c.items():
            if len(p) == 3 and a >= least:
                long[p[:2]], long[p[1:]] = max(long[p[:2]], a), max(long[p[1:]], a)
        for p, a in c.items():
            if len(p) > 1 and a >= least and not (len(p) == 2 and p in long and 100 * long[p] >= share * a):
                score, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                cand.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for i, (s, a, p, x, y) in enumerate(sorted(cand)[:top]):
            out.append((lang, i + 1, p.decode(), -a, x, y, n[lang], -s))
    return sorted(out)


def phrase_rows():
    rng = random.Random(3)
    vocab = ["The", "of", "New", "york", "CITY", "é", "Ärger", "\U0001f600", "a-b", "x\x00y", *[f"w{i}" for i in range(12)]]
    gap = [" ", "  ", "\t", ", ", ". ", "\n", "!", ";\r", " : ", "\x0b"]
    make = lambda k: "".join(rng.choice(vocab) + rng.choices(gap, [30, 2, 2, 1, 1, 1, 1, 1, 1, 1])[0] for _ in range(k))
    rows = [(rng.choice(["en", "de", None, "und"]), make(rng.randrange(0, 90))) for _ in range(120)]
    rows += [("en", "new york city " * 30), ("en", "deep blue sea. " * 25), ("en", "deep blue. " * 4), ("en", "deep green " * 12)]  # a long phrase that hides parts, ties
    rows += [("en", None), (None, ""), ("en", ".,;"), ("fr", "a b " * 9), ("fr", "a"), ("it", "z " * 4000), ("de", rows[3][1]), ("de", rows[3][1])]
    return rows


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("wide", [False, True])
def test_collocations(spark, monkeypatch, small, wide):
    if small:  # many shards, many ranges, merges on the way
        for name, value in (("SHARD", 50), ("RANGE", 8), ("_TOGETHER", 100)):
            monkeypatch.setattr(collocations, name, value)
    if wide:
        monkeypatch.setattr(collocations, "ID_BITS", 22)  # three of them need more than 64 bits
    rows = phrase_rows()
    docs = frame(spark, [(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string").repartition(3)
    got = sorted(map(tuple, collocations.collocations(docs).collect()))
    assert got == phrases_by_hand(rows)
    if not small and not wide:
        assert sorted(map(tuple, collocations.collocations(docs, least=4, share=80, top=7).collect())) == phrases_by_hand(rows, 4, 80, 7)


def test_collocations_of_nothing(spark):
    none = frame(spark, [], "doc_id long, text string, lang string")
    assert collocations.collocations(none).collect() == []
    assert collocations.collocations(frame(spark, [(1, None, None), (None, "", "en")], "doc_id long, text string, lang string")).collect() == []


def test_rows_of_shards_stay_small(spark):
    rows = [(f"l{i % 40}", " ".join(f"w{(i * 7 + k * k) % 5003}" for k in range(4000)) + ". end") for i in range(120)]
    coded = frame(spark, rows, "lang string, text string").coalesce(1).mapInArrow(collocations._shards, collocations._CODED)
    most, tokens = coded.select(F.max(F.length("codes")), F.sum(F.length("codes")) / 4).first()
    assert most <= 4 * collocations.CHUNK and tokens == coded.select(F.sum("c")).first()[0] == 120 * 4001
    for (lang,) in coded.select("lang").distinct().sort("lang").limit(3).collect():  # the tokens come back in order
        words = {(r.shard, r.at): r.word for r in coded.where(F.col("lang") == lang).where("c is not null").collect()}
        chunks = coded.where(F.col("lang") == lang).where("c is null").sort("shard", "at").collect()
        codes = np.concatenate([np.frombuffer(r.codes, np.int32) for r in chunks])
        shards = np.concatenate([np.full(len(r.codes) // 4, r.shard) for r in chunks])
        said = [w for x, text in rows if x == lang for w in text.replace(".", "").split()]
        assert [words[s, c] for s, c in zip(shards.tolist(), (codes ^ (codes >> 31)).tolist(), strict=True)] == said
        assert np.flatnonzero(codes < 0).tolist() == [k for t in range(3) for k in (4001 * t, 4001 * t + 4000)]


def test_a_task_holds_few_tokens_open_whatever_the_languages(spark, monkeypatch):
    for name, value in (("OPEN", 200), ("_TOGETHER", 100)):
        monkeypatch.setattr(collocations, name, value)
    rows = phrase_rows() + [(f"l{i}", "a b c. " * 5) for i in range(60)]
    docs = frame(spark, rows, "lang string, text string").coalesce(1)
    sizes = docs.select(F.coalesce("lang", F.lit("und")), F.coalesce("text", F.lit(""))).mapInArrow(collocations._shards, collocations._CODED).groupBy("shard").agg(F.sum("c").alias("n"))
    assert sizes.count() > 60 and sizes.select(F.max("n")).first()[0] <= 200 + 4000
    assert sorted(map(tuple, collocations.collocations(docs).collect())) == phrases_by_hand(rows)


def test_no_window_orders_all_candidates_of_a_language(spark, monkeypatch):
    rows = [("en", f"a{i} b{i}. " * 10) for i in range(300)] + [("de", "x y z. " * 12), ("en", "p q r. " * 11)]  # 300 ties at the last place
    plans, ranked = [], collocations.ranked
    monkeypatch.setattr(collocations, "ranked", lambda *args: plans.append(ranked(*args)) or plans[-1])
    docs = frame(spark, rows, "lang string, text string")
    assert sorted(map(tuple, collocations.collocations(docs, top=5).collect())) == phrases_by_hand(rows, top=5)
    windows = re.findall(r"Window \[.*?\], \[(.*?)\], \[", plans[0]._jdf.queryExecution().optimizedPlan().toString())
    assert [bool(re.search("deal", w)) for w in windows] == [False, True, True]  # from the last to the first


@pytest.mark.parametrize("bits", [17, 32])
def test_counting_a_shard_takes_little_memory(bits):
    codes = np.random.default_rng(2).integers(0, 1 << 15, 1 << 20, dtype=np.int32)
    at = np.arange(1 << 15, dtype=np.int32)
    tracemalloc.start()
    try:
        n = sum(1 for _ in collocations.shard_filters(codes, at, at.astype(np.int64), bits, 6))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 128
    assert most < 80e6  # before, 87 MB and 113 MB


def test_words_are_the_same_however_texts_are_batched(monkeypatch):
    texts = [t for _, t in phrase_rows()]
    want = None
    for size in (1, 50, 1 << 22):
        monkeypatch.setattr(collocations, "_TOGETHER", size)
        for kind in (pa.string(), pa.large_string()):
            found = [(w, f) for words, fresh in collocations.words_of(pa.array([None, *texts, ""], kind)[1:]) for w, f in zip(words.to_pylist(), fresh.tolist(), strict=True)]
            want = want or found
            assert found == want


def test_products_beyond_64_bits_are_exact(spark):
    # 1000000 * a * a passes 2**63 from about three million occurrences on.
    a, left, right = 4_000_000_007, 4_000_000_011, 5_000_000_021
    row = spark.range(1).select(F.lit(a).alias("a"), F.lit(left).alias("f1"), F.lit(right).alias("f2"))
    text = "cast(1000000 as decimal(7,0)) * cast(a as decimal(14,0)) * cast(a as decimal(14,0)) div (cast(f1 as decimal(14,0)) * cast(f2 as decimal(14,0)))"
    assert row.select(F.expr(text)).first()[0] == 1000000 * a * a // (left * right)


# ------------------------------------------------------------------ op12


def test_statistics_of_texts():
    at = lambda t: dict(zip(quality.NAMES, quality.text_statistics(t), strict=True))
    assert not quality.text_statistics(None).any() and not quality.text_statistics("").any()
    x = at("Aa bb bb!\n12 ÄB.\nAa bb bb!\n")
    assert x["words"] == math.log1p(8) and x["lines"] == math.log1p(3) and abs(x["lines_repeated"] - 1 / 3) < 1e-12
    assert abs(x["words_ending"] - 3 / 8) < 1e-12 and abs(x["words_capital"] - 2 / 8) < 1e-12 and abs(x["words_distinct"] - 5 / 8) < 1e-12 and abs(x["words_commonest"] - 2 / 8) < 1e-12
    n = len("Aa bb bb!\n12 ÄB.\nAa bb bb!\n".encode())
    assert abs(x["digits"] - 2 / n) < 1e-12 and abs(x["wide"] - 2 / n) < 1e-12 and abs(x["marks"] - 3 / n) < 1e-12 and abs(x["blanks"] - 8 / n) < 1e-12
    assert at("a a b b b")["words_repeated"] == 3 / 4 and at("xxxx y")["run_longest"] == math.log1p(4)
    for t in (" \n\t", "x" * 100_000, "\x00", "\U0001f600"):
        assert np.isfinite(quality.text_statistics(t)).all()


def split_by_hand(x, g, h, cuts):
    """Every cut of every statistic by its own sums."""
    best = (-math.inf, 0, 0)
    part = lambda m: (g[m].sum(), h[m].sum())
    gt, ht = g.sum(), h.sum()
    for c, own in enumerate(cuts):
        for b, cut in enumerate(own):
            (gl, hl), (gr, hr) = part(x[:, c] <= cut), part(x[:, c] > cut)
            if hl >= quality.LEAST and hr >= quality.LEAST:
                gain = gl**2 / (hl + quality.SHRINK) + gr**2 / (hr + quality.SHRINK) - gt**2 / (ht + quality.SHRINK)
                if gain > best[0] + 1e-9:
                    best = (gain, c, b)
    return best


def test_trees_equal_plain_loops():
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(300, 5)), 1)
    y = ((x[:, 1] > 0.3) ^ (x[:, 3] > -0.2)).astype(float)
    model = quality.fit(x, y, trees=6, depth=3)
    cuts = quality.quantile_cuts(x)
    margin = np.full(300, model.base)
    for t in range(6):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        for i in range(300):  # a walk by itself
            k = 0
            while k < 7:
                k = 2 * k + 1 + int(x[i, model.feature[t, k]] > model.cut[t, k])
            margin[i] += model.value[t, k - 7]
        work = [(0, np.ones(300, bool))]
        while work:
            k, own = work.pop()
            if k >= 7:
                if own.any():
                    assert abs(model.value[t, k - 7] + quality.RATE * g[own].sum() / (h[own].sum() + quality.SHRINK)) < 1e-9
                continue
            gain, c, b = split_by_hand(x[own], g[own], h[own], cuts)
            if gain > 1e-6:
                assert (model.feature[t, k], model.cut[t, k]) == (c, cuts[c][b])
            else:
                assert model.cut[t, k] == np.inf
            right = x[:, model.feature[t, k]] > model.cut[t, k]
            work += [(2 * k + 1, own & ~right), (2 * k + 2, own & right)]
    assert np.allclose(model.margins(x), margin)
    assert ((quality.fit(x, y).scores(x) > 0.5) == (y > 0.5)).mean() > 0.97


def test_cuts_keep_to_the_number_of_bins():
    x = np.stack([np.arange(5000.0), np.zeros(5000), np.arange(5000) % 3], axis=1)
    cuts = quality.quantile_cuts(x)
    assert len(cuts[0]) <= quality.BINS - 1 and len(cuts[1]) == 0 and cuts[2].tolist() == [0.5, 1.5]


def quality_rows():
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(200)]
    data, labels = [], []
    for i in range(700):
        w = [rng.choice(vocab) for _ in range(rng.randrange(15, 80))]
        good = rng.random() < 0.8
        data.append((i, " ".join(w if good else [x + "###" for x in w])))
        labels.append((i, int(good), 0))
    return data, labels


def test_quality(spark):
    data, labels = quality_rows()
    lab = spark.createDataFrame([*labels, (None, 1, 1), (3, None, 1), (9999, 0, 0)], "doc_id long, quality int, toxic int")
    docs = frame(spark, [*data, (2000, None), (2001, ""), (None, "w1 w2"), (5, data[5][1])], "doc_id long, text string")
    model = quality.train(docs, lab)
    out = quality.quality(docs, model).collect()
    assert len(out) == 704 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in out)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out if r["doc_id"] is not None)
    truth = {i: q for i, q, _ in labels}
    held = [r for r in out if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 100 and sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    # Labels of held-out rows change nothing; neither do repeated rows, nor their order.
    lies = lab.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.train(docs.unionByName(docs).unionByName(docs).repartition(5), lies)
    assert (again.cut == model.cut).all() and (again.value == model.value).all() and again.base == model.base
    none = frame(spark, [], "doc_id long, text string")
    assert quality.quality(none, model).count() == 0
    flat = quality.train(docs, lab.limit(0))
    assert {r["score"] for r in quality.quality(docs, flat).collect()} == {0.5}
    assert quality.train(none, lab).base == 0 and len(quality.train(docs, lab.where("quality = 1")).value) == 0


def test_sample_of_labels_is_bounded(spark, monkeypatch):
    data, labels = quality_rows()
    monkeypatch.setattr(quality, "LABELLED", 60)
    seen = []
    monkeypatch.setattr(quality, "fit", lambda rows, good: seen.append(len(rows)))
    docs = frame(spark, data * 3, "doc_id long, text string")
    quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert seen == [60]


# ------------------------------------------------------------------ op13


def negatives_by_hand(rows, every=100, positives=5, negatives=10, low=30, high=90):
    kept = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v) or sum(x * x for x in v) >= 2**62:
            continue
        r = (label, [int(x) for x in v])
        kept[i] = min(kept.get(i, r), r)
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, (label, v) in kept.items():
        if i % every:
            continue
        order = sorted((-dot(v, w), j, own) for j, (own, w) in kept.items() if j != i)
        for ps, p, _ in [x for x in order if x[2] == label][:positives]:
            fits = [(s, j) for s, j, own in order if own != label and low * -ps <= 100 * -s <= high * -ps][:negatives]
            out += [(i, p, k + 1, j, -ps, -s) for k, (s, j) in enumerate(fits)]
    return sorted(out)


def vector_rows(seed=4, n=300):
    rng = random.Random(seed)
    centre = [[rng.randrange(-60, 60) for _ in range(8)] for _ in range(6)]
    rows = [(i, rng.randrange(3), [float(x + rng.randrange(-25, 25)) for x in centre[i % 6]]) for i in range(n)]
    same = [10.0] * 8  # a hot vector under all labels, anchors among its rows
    rows += [(1000 + i, i % 3, same) for i in range(150)]
    rows += [(400, None, same), (401, 1, None), (402, 1, [1.0, None]), (403, 1, [math.nan] * 8), (404, 2, [math.inf] * 8), (None, 1, same)]
    rows += [(500, 0, [0.0] * 8), (501, 1, []), (502, 2, [5.0, 6.0]), (600, 2, [-3.0] * 8), (7, 1, rows[7][2]), (8, 2, [1.0] * 8), (503, 0, [float(2**31)] + [0.0] * 7)]
    rows += [(700, 1, [float(2**30), 3.0]), (701, 1, [float(2**30 - 1), 5.0]), (702, 2, [float(2**29) + 1, 7.0])]  # beyond the reach of doubles
    return rows


@pytest.mark.parametrize(("fan", "block"), [(16, 1024), (3, 7)])
def test_hard_negatives(spark, monkeypatch, fan, block):
    for name, value in (("FAN", fan), ("BLOCK", block), ("LEAF", 4), ("TOGETHER", 3)):
        monkeypatch.setattr(hard_negatives, name, value)
    monkeypatch.setattr(hard_negatives.Tree.__init__, "__defaults__", (fan, 4, hard_negatives.LEVELS))
    rows = vector_rows()
    table = frame(spark, rows, "vec_id long, label int, v array<double>").repartition(3)
    want = negatives_by_hand(rows)
    assert sorted(map(tuple, hard_negatives.hard_negatives(table).collect())) == want and len(want) > 100
    want = negatives_by_hand(rows, 50, 2, 3, 10, 100)
    assert sorted(map(tuple, hard_negatives.hard_negatives(table, 50, 2, 3, 10, 100).collect())) == want


def test_hard_negatives_of_nothing(spark):
    schema = "vec_id long, label int, v array<double>"
    assert hard_negatives.hard_negatives(frame(spark, [], schema)).collect() == []
    assert hard_negatives.hard_negatives(frame(spark, [(100, 1, [1.0]), (1, None, [1.0])], schema)).collect() == []
    assert hard_negatives.hard_negatives(frame(spark, [(0, 1, []), (1, 1, []), (2, 2, []), (3, 2, None)], schema)).collect() == [(0, 1, 1, 2, 0, 0)]


def test_rows_of_the_query(spark):
    rows = [(7, 9, [0.5, -0.001, None]), (8, 9, [1.0, -1.5, math.inf]), (14, None, None), (None, 3, [math.nan])]
    got = hard_negatives.noisy_rows(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")).collect()
    assert [(r["vec_id"], r["label"]) for r in got] == [(7, 0), (8, 9), (14, None), (None, 3)]
    assert got[0]["v"] == [128.0, -1.0, None] and got[1]["v"] == [256.0, -384.0, math.inf] and got[2]["v"] is None and math.isnan(got[3]["v"][0])


def test_subtrees_left_out_hold_nothing():
    """Bounds by leaf against all rows, and that they do leave leaves out."""
    rng = np.random.default_rng(9)
    centre = rng.integers(-300, 300, (20, 8))
    rows = (centre[rng.integers(0, 20, 2000)] + rng.integers(-20, 20, (2000, 8))).astype(np.int32)
    label = rng.integers(0, 3, 2000)
    tree = hard_negatives.Tree(rows[:400])
    leaf = tree.assign(rows)
    for k in np.unique(leaf):
        own = rows[leaf == k]
        low, high = tree.block_ranges(int(k), own)
        size = hard_negatives.squares(own)
        tree.settle(int(k), low, high, size.min(), size.max(), int(label[leaf == k].min()), int(label[leaf == k].max()))
    q, mark = rows[:60], label[:60]
    scores = hard_negatives.inner(q, rows)
    least = np.sort(scores, axis=1)[:, -300].astype(float)
    most = np.sort(scores, axis=1)[:, -20].astype(float)
    open_ = 0
    for same in (True, False):
        top = tree.bounds(q, mark, same, least, most)
        for i in range(60):
            for k in range(len(tree.paths)):
                own = scores[i, (leaf == k) & ((label == mark[i]) == same)]
                own = own[(own >= least[i]) & (own <= most[i])]
                if len(own):
                    assert top[i, k] >= own.max()
        open_ += (top > -np.inf).mean()
    assert open_ / 2 < 0.6
