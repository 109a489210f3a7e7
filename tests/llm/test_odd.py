"""Texts and rows that once stopped an operator or lost a result."""

import pytest

from stationday.llm import ann, decontamination, licenses, packing, quality
from tests.llm.conftest import make_docs


@pytest.mark.parametrize("text", ["\n" + ". " * 100_000, "a" + "." * 100_000 + "b", "\n. x" * 20_000, "...\n" * 20_000])
def test_license_scan_of_pages_of_dots(spark, text):
    assert licenses.scan(make_docs(spark, [(1, text)])).count() == 1
    assert len(licenses.scan(make_docs(spark, [(1, text)])).collect()) == 1


@pytest.mark.parametrize("kind", ["int", "long", "string"])
def test_decontamination_with_null_and_other_item_ids(spark, kind):
    passage = "the quick brown fox jumps over seven lazy dogs while nine clever cats watch from the old garden wall quietly tonight"
    ids = [("1" if kind == "string" else 1), None]
    benchmark = spark.createDataFrame([(i, passage) for i in ids], f"item_id {kind}, text string")
    docs = make_docs(spark, [(1, "intro words here " + passage + " and more after it"), (2, "nothing to see in this one at all")])
    got = {r["doc_id"]: (r["contaminated"], r["items"]) for r in decontamination.search(docs, benchmark).collect()}
    assert got == {1: (True, [None, ids[0]]), 2: (False, [])}


def test_nearest_of_repeated_rows(spark):
    v, w = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(50, v)] * 8 + [(51, v)] + [(i, [1.0, i / 100, 0.0]) for i in range(52, 58)] + [(60, w)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(ann.search(table).collect(), key=lambda r: r["rank"])
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(50, i + 1, 51 + i) for i in range(5)]


def test_one_encoder_for_a_process():
    assert packing.public_encoder() is packing.public_encoder()


def test_kept_documents_are_those_scored_as_good(spark, odd, labels, no_docs):
    model = quality.train(odd, labels)
    kept = quality.keep_good(odd, model)
    assert kept.columns == odd.columns
    good = {r["doc_id"] for r in quality.score(odd, model).collect() if r["predicted"]}
    assert {r["doc_id"] for r in kept.collect()} == good
    assert quality.keep_good(no_docs, model).collect() == []


def test_ids_of_odd_texts_equal_those_of_the_library():
    import random

    import numpy as np
    import public_tokenizers
    import tokenizers

    library = tokenizers.Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    encoder = packing.public_encoder()
    rng = random.Random(1)
    texts = ["don't. it's) naïve, Größe! 漢字。 漢字, a  b", " lead", "trail ", "x́ y.́", "d) e)) 12, 12. a1, ² ½. ª, word.'s", "a b, ß,ß ﬁ. "]
    texts += ["".join(rng.choice("ab Z9,.!?)'\n\té漢½́_-") for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["a" + "." * n + " b" for n in (39, 40, 41, 100)]
    for text in texts:
        assert np.frombuffer(encoder(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
