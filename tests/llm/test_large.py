"""Long repeats, resampling and clustering against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stationday.llm import clustering, recompression, resampling
from stationday.llm.blocks import WordDigests, word_blocks
from stationday.llm.common import utf8
from tests.llm.conftest import ODD, make_docs


# ---- blocks


@pytest.mark.parametrize("most", [1, 7, 64, 1 << 20])
def test_word_blocks_cut_no_word(most):
    texts = ["", "ab cd", "x" * 100, " lead", "trail ", "", "é漢 z", "end"]
    data, offsets = utf8(pa.array(texts))
    got = [
        (int(t), bytes(data[s:e]).decode())
        for starts, ends, text in word_blocks(data, offsets, recompression.INSIDE, most)
        for s, e, t in zip(starts, ends, text)
    ]
    assert got == [(i, w) for i, t in enumerate(texts) for w in t.split()]


def test_word_digests_do_not_depend_on_place_or_length():
    long = "y" * 5000
    data, offsets = utf8(pa.array([f"one {long} two one", f"{long} one"]))
    (starts, ends, _), = word_blocks(data, offsets, recompression.INSIDE)
    first, second = WordDigests()(data, starts, ends)
    assert first[0] == first[3] == first[5] and first[1] == first[4] and first[0] != first[2]
    assert (first != second).all()


# ---- recompression


def plain_repeats(texts, width):
    lists = [(t or "").encode().split() for t in texts]
    windows = Counter(tuple(ws[i : i + width]) for ws in lists for i in range(len(ws) - width + 1))
    out = []
    for ws in lists:
        gone = [False] * len(ws)
        for i in range(len(ws) - width + 1):
            if windows[tuple(ws[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        kept = b" ".join(w for w, g in zip(ws, gone) if not g)
        out.append((len(ws), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def repeat_texts():
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    vocabulary = [word(rng.randint(1, 6)) for _ in range(60)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [prose(n) for n in (34, 35, 36, 50, 90)]
    texts = []
    for i in range(120):
        words = prose(rng.randint(0, 150))
        for p in rng.sample(passages, rng.randint(0, 2)):
            at = rng.randint(0, len(words))
            words[at:at] = p
        texts.append(rng.choice([" ", "  ", "\n", " \t"]).join(words))
    texts += [texts[0]] * 5 + [texts[1] + " tail"]
    texts += ["la " * 34, "la " * 35, "la " * 36, "ab cd " * 60, "ab cd " * 40 + "ef", "x " + "la " * 200]
    return texts + ["Case " * 40, "case " * 40, None, "", " \n "]


def by_id(rows, *names):
    return sorted(tuple(r[n] for n in names) for r in rows)


def test_repeats_equal_all_windows(spark):
    texts = repeat_texts()
    got = recompression.remove_repeats(make_docs(spark, list(enumerate(texts))).repartition(5)).collect()
    want = [(i, *row) for i, row in enumerate(plain_repeats(texts, 35))]
    assert by_id(got, "doc_id", "n_words", "n_removed", "kept_sha256") == want
    assert sum(r["n_removed"] for r in got) > 1000


@pytest.mark.parametrize("width", [2, 5, 12])
def test_repeats_of_other_widths(spark, width):
    texts = repeat_texts()[::3]
    got = recompression.remove_repeats(make_docs(spark, list(enumerate(texts))), width).collect()
    assert [(r["n_words"], r["n_removed"], r["kept_sha256"]) for r in sorted(got, key=lambda r: r["doc_id"])] == plain_repeats(texts, width)


def test_repeats_in_a_text_of_several_chunks(monkeypatch):
    rng = random.Random(2)
    words = [str(rng.randint(0, 10**6)) for _ in range(3000)]
    words[2000:2100] = words[100:200]
    column = pa.array([" ".join(words)])
    whole = {c for *_, c, _ in recompression.stretches(column, 35) for c in c.tolist()}
    monkeypatch.setattr(recompression, "CHUNK", 700)
    monkeypatch.setattr(recompression, "word_blocks", lambda *a: word_blocks(*a, 997))
    windows = {}
    for _, base, at, n, _, _, digests in recompression.stretches(column, 35):
        for start, count in zip(at, n):
            for w in range(start, start + count):
                f1, f2 = digests(np.array([w]), np.array([w + 35]))
                windows.setdefault((int(f1[0]), int(f2[0])), []).append(base + w)
    assert sorted(w for ws in windows.values() for w in ws) == list(range(3000 - 34))  # every window once
    assert sorted(ws for ws in windows.values() if len(ws) > 1) == [[100 + i, 2000 + i] for i in range(66)]
    assert whole


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(3)
    shared = rng.integers(0, 50, 80).astype(np.uint64)
    seen = []
    for _ in range(2):
        names = np.concatenate([rng.integers(0, 50, 60).astype(np.uint64), shared, rng.integers(0, 50, 60).astype(np.uint64)])
        begins = np.zeros(200, bool)
        begins[0] = True
        at, n, name = recompression.anchors(names, begins, 35)
        seen.append({w - 60: nm for a, k, nm in zip(at, n, name) for w in range(a, a + k)})
    assert all(seen[0][w] == seen[1][w] for w in range(80 - 34))


def test_repeats_odd_rows(spark, odd, no_docs):
    got = recompression.remove_repeats(odd).collect()
    texts = [t for _, t in ODD]
    assert by_id(got, "doc_id", "n_words", "n_removed", "kept_sha256") == [(i + 1, *row) for i, row in enumerate(plain_repeats(texts, 35))]
    assert recompression.remove_repeats(no_docs).collect() == []
    twice = make_docs(spark, [(1, "a b " * 30), (1, "a b " * 30), (None, "q " * 3)])
    assert by_id(recompression.remove_repeats(twice).where("doc_id = 1").collect(), "n_removed") == [(60,), (60,)]


# ---- resampling


def plain_resample(docs, target, percent=5):
    def features(text):
        ws = re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        runs = [" ".join(ws[i : i + k]) for k in (1, 2, 3) for i in range(len(ws) - k + 1)]
        return len(ws), [zlib.crc32(f.encode()) % 10000 for f in runs]

    of = [features(t) for _, t in docs]
    s, t = Counter(b for _, bs in of for b in bs), Counter(b for x in target for b in features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000))))
    rows = []
    for (i, _), (n, bs) in zip(docs, of):
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, bs))
        rows.append([i, n, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0]))
    ranks = {r[0]: k + 1 for k, r in enumerate(able[: percent * len(able) // 100])}
    return sorted((r[0], *r[2:], ranks.get(r[0])) for r in rows)


@pytest.fixture(scope="module")
def pool():
    rng = random.Random(8)
    words = ["Größe", "ice", "Tea", "x9", "naïve", "漢字", "w" * 60, "-", "B2"] + [f"t{i}" for i in range(40)]
    text = lambda n: rng.choice([" ", "; ", "\n"]).join(rng.choice(words) for _ in range(n))
    return [(i, text(rng.randint(0, 60))) for i in range(400)], [text(30) for _ in range(6)]


@pytest.mark.parametrize("percent", [0, 5, 60, 100])
def test_resampling_equals_a_plain_version(spark, pool, percent):
    docs, target = pool
    benchmark = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = resampling.resample(make_docs(spark, docs).repartition(7), benchmark, percent).collect()
    assert sorted(map(tuple, got)) == plain_resample(docs, target, percent)


def test_feature_buckets_of_a_long_text_in_small_blocks(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(500)) + " " + "z" * 300 + " end"
    whole = sorted(b for _, bs, _ in resampling.feature_buckets(pa.array([text])) for b in bs)
    monkeypatch.setattr(resampling, "word_blocks", lambda *a: word_blocks(*a, 64))
    assert sorted(b for _, bs, _ in resampling.feature_buckets(pa.array([text])) for b in bs) == whole


def test_quickselect_finds_every_key(spark):
    rows = [(i % 7, i) for i in range(60)] + [(3, 100)] * 3
    df = spark.createDataFrame(rows, "score long, doc_id long").withColumn("n_features", F.lit(1)).withColumn("row", F.monotonically_increasing_id())
    keys = resampling._order(df)
    want = sorted(tuple(r) for r in keys.select(*resampling.KEY).collect())
    for k in (1, 2, 31, 62, 63):
        assert resampling.kth_key(keys, k, pivots=4) == want[k - 1]


def test_resampling_odd_rows(spark, odd, no_docs):
    none = spark.createDataFrame([(1, None), (2, "")], "item_id long, text string")
    assert [r[:-1] for r in plain_resample(ODD, [], 100)] == sorted(map(lambda r: tuple(r)[:-1], resampling.resample(odd, none, 100).collect()))
    assert resampling.resample(no_docs, none).collect() == []
    twice = make_docs(spark, [(1, "a " * 30)] * 4 + [(None, "b " * 30), (None, None)])
    ranks = [r["rank"] for r in resampling.resample(twice, none, 60).collect()]
    assert sorted(r for r in ranks if r) == [1, 2, 3] and len(ranks) == 6


# ---- clustering


def plain_clusters(rows, clusters=8, rounds=10):
    kept = [
        (i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in kept[:clusters]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        for k in range(len(centroids)):
            mine = [v for (_, v), o in zip(kept, of) if o == k]
            if mine:
                centroids[k] = [sum(x) // len(mine) for x in zip(*mine)]
    found = [(i, *near(v)) for i, v in kept]
    inertia = Counter()
    for _, d, k in found:
        inertia[k] += d
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    return sorted((i, k, d, inertia[k], sum(inertia.values()), digest(centroids[k])) for i, d, k in found)


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster string")


def test_clusters_equal_a_plain_version(spark):
    rng = np.random.default_rng(4)
    middles = rng.normal(0, 1, (5, 64))
    rows = [(i, (middles[i % 5] + rng.normal(0, 0.2, 64)).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]  # ties
    got = clustering.cluster(table(spark, rows).repartition(6), block=16).collect()
    assert sorted(map(tuple, got)) == plain_clusters(rows)


def test_clusters_odd_rows(spark):
    v = [0.5] * 64
    bad = [(1, None), (2, []), (3, [1.0] * 63), (4, [None, *v[1:]]), (5, [math.nan, *v[1:]]), (6, [math.inf, *v[1:]])]
    rows = bad + [(7, v), (7, v), (8, [-x for x in v]), (9, [1e30] + [0.0] * 63)]
    got = clustering.cluster(table(spark, rows)).collect()
    assert sorted(r["vec_id"] for r in got) == [7, 7, 8, 9]
    assert by_id([r for r in got if r["vec_id"] != 9], "vec_id", "distance") == [(7, 0), (7, 0), (8, 0)]
    assert clustering.cluster(table(spark, bad)).collect() == []
    assert clustering.cluster(table(spark, [])).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_box_bounds_lose_no_nearest_centroid():
    rng = np.random.default_rng(6)
    for _ in range(50):
        m, centroids = rng.integers(-20, 20, (30, 4)), rng.integers(-40, 40, (6, 4))
        among = clustering.candidates(m.min(0), m.max(0), centroids)
        assert [x.tolist() for x in clustering.nearest(m, centroids, among)] == [x.tolist() for x in clustering.nearest(m, centroids, range(6))]


def test_hilbert_neighbours_are_one_step_apart():
    grid = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    keys = clustering.hilbert_keys(grid, 3)
    places = [int.from_bytes(k.tobytes(), "big") for k in keys]
    assert len(set(places)) == 512
    walk = grid[np.argsort(places)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()
