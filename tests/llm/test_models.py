"""Classifiers by held-out accuracy, retrieval and nearest neighbours against plain versions."""

import os
import random

import numpy as np
import pytest

from stationday.llm import ann, decontamination, quality, toxicity
from tests.llm.conftest import ODD, make_docs

SF_DIR = os.environ.get("TEST_MODEL_DIR", "/root/testdata/sf0.01")
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def rates(scored, labels, column):
    rows = scored.join(labels, "doc_id").where(f"held_out and {column} is not null").select("predicted", column, "score").collect()
    good = [r["score"] for r in rows if r[column] == 1]
    bad = [r["score"] for r in rows if r[column] == 0]
    better = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    return sum(r["predicted"] == r[column] for r in rows) / len(rows), better


@needs_data
def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    accuracy, order = rates(quality.score(docs, quality.train(docs, labels)), labels, "quality")
    assert accuracy > 0.95 and order > 0.97


@needs_data
def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    accuracy, order = rates(toxicity.score(docs, toxicity.train(docs, labels)), labels, "toxic")
    assert accuracy > 0.9 and order > 0.75


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers_stand_odd_rows(spark, module, odd, no_docs, labels):
    model = module.train(odd, labels)
    rows = module.score(odd, model).collect()
    assert sorted(r["doc_id"] for r in rows) == [i for i, _ in ODD]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    score = {r["doc_id"]: r["score"] for r in rows}
    assert score[1] == score[2] and score[5] == score[6]
    assert module.score(no_docs, module.train(no_docs, labels.limit(0))).count() == 0
    if module is quality:
        assert quality.keep_good(odd, model).columns == odd.columns


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(2)
    terms = ["moron", "trash", "scum", "worthless", "pathetic", "disgusting", "trashy"]
    automaton = toxicity.Automaton(terms)
    words = []
    for _ in range(3000):
        w = list(rng.choice(terms))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(w) + 1)
            w[at : at + rng.randrange(2)] = rng.choice(["", "a", "s", "h"])
        words.append("".join(w))
    for w in words:
        near = [(edits(w, t), i) for i, t in enumerate(terms) if edits(w, t) <= automaton.edits_of[i]]
        hit = automaton.match(w)
        assert (hit is None) == (not near), w
        if near:
            assert hit[1] == min(near)[0], w
    assert toxicity.Automaton(["achlich*"]).match("achlichkeit") == (0, 0)


def test_quoted_hits_weigh_less():
    lexicon = toxicity.Lexicon(["moron"], [4.0])
    assert lexicon.features("he said “you moron” to me")[0] < lexicon.features("he said you moron to me")[0]
    assert lexicon.features("you mor0n")[0] < lexicon.features("you moron")[0]
    assert lexicon.features(None) == lexicon.features("") == [0.0] * toxicity.N_FEATURES


def test_benchmark_passages(spark, odd, no_docs):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8)))
    filler = [" ".join(word() for _ in range(300)) for _ in range(60)]
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([15, 30, 50, 120, 3])] + [(90, None), (91, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    texts = ODD + [(100 + i, f) for i, f in enumerate(filler)]
    planted = {}
    for i, text in items[:4]:
        words = text.split()
        changed = [w if k % 6 else "other" for k, w in enumerate(words)]
        planted |= {500 + i: i, 600 + i: i}
        texts.append((500 + i, f"{filler[i]} {text.upper()}, {filler[i + 1]}"))
        texts.append((600 + i, f"{filler[i + 2]} {' '.join(changed)} {filler[i]}"))
    found = decontamination.search(make_docs(spark, texts), benchmark).collect()
    assert {r["doc_id"]: r["items"] for r in found if r["contaminated"]} == {d: [i] for d, i in planted.items()}
    assert len(found) == len(texts)
    assert decontamination.search(no_docs, benchmark).count() == 0
    clean = decontamination.search(odd, benchmark.limit(0)).collect()
    assert len(clean) == len(ODD) and not any(r["contaminated"] for r in clean)
    assert decontamination.keep_clean(odd, benchmark).columns == odd.columns


def test_an_item_in_a_third_of_all_rows_is_found(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8)))
    text = " ".join(word() for _ in range(30))
    texts = [(i, " ".join(word() for _ in range(100))) for i in range(300)]
    texts = [(i, f"{t} {text} {t}" if i % 3 == 0 else t) for i, t in texts]
    found = decontamination.search(make_docs(spark, texts), spark.createDataFrame([(7, text)], "item_id long, text string"))
    assert {r["doc_id"] for r in found.collect() if r["items"] == [7] and r["covered"] == 1.0} == set(range(0, 300, 3))


def test_candidates_equal_a_search_of_all_windows(spark):
    """Short items, items of common words and items with a quarter of their words changed, between rare and common words."""
    rng = random.Random(9)
    common = [f"c{i}" for i in range(30)]
    rare = lambda: f"r{rng.randrange(10**9)}"
    items = [[rare() for _ in range(n)] for n in (2, 3, 5, 12, 40)] + [[rng.choice(common) for _ in range(n)] for n in (10, 20, 70)]
    items += [[rng.choice(common) if k % 3 else rare() for k in range(n)] for n in (9, 16, 17, 33, 49)]
    texts = [(i, " ".join(rng.choice(common) for _ in range(90))) for i in range(40)]
    for i, item in enumerate(items):
        for kind, filler in enumerate((rare, lambda: rng.choice(common))):
            for part in range(2):
                kept = [w if not part or k % 4 else filler() for k, w in enumerate(item)]
                words = [filler() for _ in range(37 + i)] + kept + [filler() for _ in range(50)]
                texts.append((1000 * (i + 1) + 10 * kind + part, " ".join(words)))
    benchmark = spark.createDataFrame([(i, " ".join(item)) for i, item in enumerate(items)], "item_id long, text string")
    found = {r["doc_id"]: (r["items"], r["covered"]) for r in decontamination.search(make_docs(spark, texts), benchmark).collect()}
    numbers = {}
    number = lambda words: np.array([numbers.setdefault(w, len(numbers)) for w in words])
    for doc_id, text in texts:
        words, best = text.split(), {}
        for i, item in enumerate(items):
            starts = sorted({*range(0, max(1, len(item) - 48), 48), max(0, len(item) - 48)})
            for passage in (item[s : s + 48] for s in starts):
                width = 32 if len(passage) <= 16 else 64
                for at in range(0, max(1, 16 * -(-len(words) // 16) - width + 1), 16):
                    window = number(words[at : at + width])
                    covered = decontamination.common_subsequence(number(passage), window) / len(passage)
                    enough = 0.7 if decontamination.common_subsequence(number(passage[-5:]), window) < min(5, len(passage)) else 0.5
                    if covered >= (1.0 if len(passage) < 8 else enough):
                        best[i] = max(best.get(i, 0), covered)
        assert found[doc_id] == (sorted(best), max(best.values(), default=0.0)), doc_id
        if doc_id >= 1000 and doc_id % 10 == 0:
            assert doc_id // 1000 - 1 in best


def test_common_subsequence():
    rng = random.Random(5)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(12))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            before = 0
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
        assert decontamination.common_subsequence(np.array(a, np.uint16), np.array(b, np.uint16)) == row[-1]


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 16))
    vectors = [(i, (centres[i % 12] + 0.4 * rng.normal(size=16)).tolist()) for i in range(900)]
    vectors += [(2000 + i, vectors[3][1]) for i in range(120)]  # one very common vector
    odd = [(5000, None), (5050, []), (5100, [0.0] * 16), (5150, [float("nan")] * 16), (5200, [None] + [1.0] * 15), (5250, [1.0, 2.0]), (None, [1.0] * 16)]
    frame = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<float>")
    found = ann.search(frame.withColumn("class", frame["vec_id"])).collect()
    ids = np.array([i for i, _ in vectors])
    x = np.array([v for _, v in vectors], np.float32).astype(np.float64)
    hits, queries = 0, [i for i in range(len(ids)) if ids[i] % 50 == 0]
    for q in queries:
        scores = ann.cosines(x[q], x)
        scores[q] = -9
        best = np.lexsort((ids, -scores))[:5]
        got = sorted((r for r in found if r["query_id"] == ids[q]), key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == [1, 2, 3, 4, 5]
        assert all(abs(r["score"] - scores[np.flatnonzero(ids == r["vec_id"])[0]]) < 1e-12 for r in got)
        assert [(-r["score"], r["vec_id"]) for r in got] == sorted((-r["score"], r["vec_id"]) for r in got)
        hits += len({r["vec_id"] for r in got} & set(ids[best].tolist()))
    assert {r["query_id"] for r in found} == {int(ids[q]) for q in queries}
    assert hits / (5 * len(queries)) >= 0.9
    assert ann.search(frame.limit(0)).count() == 0
    few = ann.search(frame.where("vec_id in (0, 1, 2)")).collect()
    assert [r["vec_id"] for r in few] and len(few) == 2


def test_nearest_of_isolated_vectors(spark, monkeypatch):
    """A query whose own list holds too few others still gets as many as there are."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(640, 8)) * 0.2 + np.eye(8)[0]
    x[:3] = -np.eye(8)[:3] * 5  # alone in their lists
    x[3] = x[2] + 0.01  # two in a list
    fitted = ann.fit_centroids
    monkeypatch.setattr(ann, "fit_centroids", lambda sample, count: np.concatenate([-np.eye(8)[:3], fitted(sample, count)[3:]]))
    frame = spark.createDataFrame([(50 * i if i < 4 else 1000 * i + 1, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {}
    for r in ann.search(frame).collect():
        found.setdefault(r["query_id"], []).append(r["rank"])
    assert {q: sorted(ranks) for q, ranks in found.items()} == {q: [1, 2, 3, 4, 5] for q in (0, 50, 100, 150)}
    assert ann.search(frame.where("vec_id < 200")).count() == 12
