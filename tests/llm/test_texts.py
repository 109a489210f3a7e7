"""Near duplicates, packing, sharding, pages: plain versions and exact round trips."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stationday.llm import common, neardup, packing, pages, sharding
from stationday.llm.graph import components
from tests.llm.conftest import ODD, make_docs


def plain_links(texts, width):
    """Size and smallest reachable id by comparing all pairs."""
    sets = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                common_ = len(sets[a] & sets[b])
                if common_ and 100 * common_ >= 80 * len(sets[a] | sets[b]) and label[b] < label[a]:
                    label[a], changed = label[b], True
    return {i: (len(sets[i]), label[i]) for i in sets}


def edited_texts():
    rng = random.Random(4)
    texts, base = list(ODD), [f"w{rng.randrange(5000)}" for _ in range(150)]
    for i in range(120):
        words = list(base)
        for _ in range(rng.randrange(0, 9)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(9999)}"
        texts.append((1000 + i, " ".join(words)))
    texts += [(2000 + i, "Copied line of text that is the same everywhere") for i in range(40)]
    return texts


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates_equal_all_pairs(spark, width):
    texts = edited_texts()
    found = neardup.link(make_docs(spark, texts), width=width).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == plain_links(texts, width)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_keep_first_and_empty(spark, odd, no_docs):
    kept = neardup.keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4, 5, 7, 8, 9]
    assert neardup.link(no_docs).count() == 0
    null_id = make_docs(spark, [(None, "a b c d e f"), (3, "a b c d e f")])
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in neardup.link(null_id).collect()} == {(None, None, True), (3, 3, True)}


def test_blocks_of_long_lists(spark, monkeypatch):
    """Comparing block against block finds the same as one block."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    texts = edited_texts()
    found = neardup.link(make_docs(spark, texts), width=4).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: c for i, (_, c) in plain_links(texts, 4).items()}


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (100, 101), (7, 7)], "a long, b long")
    found = {r["id"]: r["component"] for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert components(edges.limit(0)).count() == 0


@given(st.lists(st.one_of(st.none(), st.text(max_size=60)), max_size=8))
def test_word_hashes_follow_words(texts):
    words = common.Words()
    hashes, _, _, first = words(pa.array(texts, pa.string()))
    plain = [(t or "").encode().lower().split() for t in texts]
    assert np.diff(first).tolist() == [len(w) for w in plain]
    seen = {}
    for h, w in zip(hashes.tolist(), [w for ws in plain for w in ws]):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


@settings(deadline=None, max_examples=200)
@given(st.text(alphabet="ab'st  \n\té 漢1!<|endoftext|>", max_size=40))
def test_ids_equal_the_tokenizers_library(tokenizer, text):
    ids = np.frombuffer(test_ids_equal_the_tokenizers_library.encoder(text), "<u4").tolist()
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids


test_ids_equal_the_tokenizers_library.encoder = packing.public_encoder()


@settings(deadline=None, max_examples=200)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "a", " ", "b's", "\n", "漢"]), max_size=8))
def test_ids_equal_the_tokenizers_library_as_it_comes(parts):
    import public_tokenizers
    from tokenizers import Tokenizer

    test = test_ids_equal_the_tokenizers_library_as_it_comes
    if not hasattr(test, "tokenizer"):
        test.tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = "".join(parts)
    ids = np.frombuffer(test.encoder(text), "<u4").tolist()
    assert ids == test.tokenizer.encode(text, add_special_tokens=False).ids


test_ids_equal_the_tokenizers_library_as_it_comes.encoder = packing.public_encoder()


@pytest.mark.parametrize(("length", "most", "fan_in"), [(1024, 256, 32), (64, 2, 2)])
def test_packing_round_trip(spark, tokenizer, no_docs, length, most, fan_in):
    texts = ODD + [(100 + i, " ".join(f"t{j}" for j in range(i))) for i in range(60)]
    docs = make_docs(spark, texts).repartition(7)
    rows = packing.pack(docs, length=length, most=most, fan_in=fan_in).collect()
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc_id, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert 0 < at <= length
    assert packing.pack(no_docs).count() == 0


def test_shards_are_even_and_groups_stay_together(spark, no_docs):
    rng = random.Random(1)
    texts = ODD + [(100 + i, "z" * rng.randrange(1, 400)) for i in range(3000)] + [(9000 + i, "hot " * 30) for i in range(1500)]
    rows = sharding.assign(make_docs(spark, texts)).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(i for i, _ in texts)
    sizes, slots, homes = {}, {}, {}
    for r in rows:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        text = dict(texts)[r["doc_id"]]
        assert r["size"] == len((text or "").encode()) + 1 and r["text_crc32"] == zlib.crc32((text or "").encode())
        homes.setdefault(text, set()).add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    long = max(len((t or "").encode()) for _, t in texts) + 1
    # the longest text alone exceeds a share; its shard gets few others, the rest are even
    *rest, most = sorted(sizes.values())
    assert most <= 1.02 * long and max(rest) <= 1.03 * min(rest)
    assert all(len(h) == 1 for t, h in homes.items() if t is None or not t.startswith("hot"))
    assert len(homes["hot " * 30]) > 1  # a group beyond a shard's share is split
    assert sharding.assign(no_docs).count() == 0


def test_place_by_hand():
    vectors = np.array([[4.0, 1], [3, 1], [3, 1], [2, 1]])
    assert sharding.place(vectors, vectors.sum(0), 2).tolist() == [0, 1, 1, 0]


PAGE = """<html><head><title>t</title><script>var t="</p>";</script></head><body><nav><a href=/>home</a></nav>
<div class="cookie-notice"><p>We use cookies on this page for many good reasons, please accept them all.</p></div>
<article><h1>A &amp; B</h1><p>First&nbsp;para  <b>bold</b>,
more.<br>next<p>Short.</p><!-- <p>hidden</p> --><form>Name <input></form><pre>x &lt; y</pre></article>
<section class="comments"><article><p>I really do not agree with this article at all, said the reader of the page.</p></article></section>
<footer><p>&copy; all of us</p></footer>"""


def test_pages(spark):
    rows = [(1, "u", PAGE), (2, "u", None), (3, None, ""), (4, "u", "<article><p>cut off <a hre"), (5, "u", "plain"), (5, "u", "plain")]
    found = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    text = {r["page_id"]: r["text"] for r in found}
    assert text[1] == "A & B\nFirst para bold, more. next\nShort.\nx < y"
    assert (text[2], text[3], text[4]) == ("", "", "cut off")
    assert len(found) == 6 and all(r["n_chars"] == len(r["text"]) for r in found)


def test_only_raw_elements_swallow_text():
    text = lambda html: " ".join(b.text for b in pages.blocks_of(html))
    for tag in ("video-player", "title-bar", "svg-icon", "button-group", "math-field"):
        assert text(f"<p>a.</p><{tag} x='1'>kept</{tag}><p>last.</p>") == "a. kept last."
    for tag in ('<svg class="i"/>', "<svg/>", "<math a='>' b = c />", "<SVG hidden/>", '<svg a="1" / b/>'):
        assert text(f"<p>a.</p>{tag}<p>last.</p><svg>no</svg>") == "a. last."
    for tag in ("svg", "video", "title", "button"):
        assert text(f"<p>a.</p><{tag} w=1>no</{tag}><p>b.</p><{tag}>no</{tag} ><p>last.</p>") == "a. b. last."
    assert text("<p>a.</p><svg href=a/>no</svg><p>last.</p>") == "a. last."


def test_the_tree_fits_its_table():
    x, y = pages.labelled_blocks()
    assert all(pages.trained()(row) == label for row, label in zip(x, y))
