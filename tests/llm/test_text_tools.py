"""BPE against the library, HTML extraction against known pages, and the pipeline."""

from __future__ import annotations

import html
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from metaferry.llm import block_labeller, bpe, html_blocks

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


ODD = [
    None, "", " \n\t ", "a", "aaaa aaaaa", "Hello, World!", "it's DON'T they'LL", "x<|endoftext|>y <|startoftext|><|endoftext|",
    "İstanbul ΣΑΣ ΌΔΟΣ", "é ẛ̣", "\x1c\x1d a\x1cb", "a\u0085b c​d", "😀👍🏽 中文字 한국어", "12345 ½²",
    "word " * 20_000, "z" * 20_000, "՘Ᲊ new letters Ɤ",
]


def test_encoding_matches_the_library(spark, library):
    dice = random.Random(8)
    pool = "aAbB eEéÉ'sS'tT'll  1234½²!?#<|>endoftext|\n\tçßΣσςİıǅ中かな한국́̈"
    texts = ODD + ["".join(dice.choice(pool) for _ in range(dice.randrange(1, 80))) for _ in range(500)]
    docs = spark.createDataFrame([(k, t, [1], "d") for k, t in enumerate(texts)], "doc_id long, text string, ids array<int>, decoded string")
    rows = bpe.encode(docs, decoded="decoded").collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        assert row.ids == ids, ascii(texts[row.doc_id])[:100]
        assert row.decoded == library.decode(ids, skip_special_tokens=False)
    again = bpe.decode(bpe.encode(docs).drop("decoded")).collect()
    assert {r.doc_id: r.decoded for r in again} == {r.doc_id: r.decoded for r in rows}
    assert bpe.encode(docs.limit(0)).count() == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav>"
    "<div class=ad>Buy &amp; go</div><article><h1>Head\n line</h1><p><b>One &lt;two&gt;.<br>Next<p>A&nbsp;&eacute;<!-- x -->b"
    "<script>var t='</p>';</script> c</p></article><footer>End</footer></body></html>"
)


def test_blocks():
    found = [(block.path[-1][0], block.text) for block in html_blocks.blocks(PAGE)]
    assert found == [("li", "Home"), ("div", "Buy & go"), ("h1", "Head line"), ("p", "One <two>. Next"), ("p", "A éb c"), ("footer", "End")]
    assert html_blocks.blocks(None) == [] and html_blocks.blocks("") == []
    assert [b.text for b in html_blocks.blocks("plain < text > &amp; <")] == ["plain < text > & <"]
    assert [b.text for b in html_blocks.blocks("a<!-- open")] == ["a"]
    assert html_blocks.blocks("<div class='Big Ad' id=x>t</div>")[0].path == (("div", ".big", ".ad", ".x"),)
    assert len(html_blocks.blocks("<p>x" * 20_000)) == 20_000


def test_gradients():
    """Back-propagation against differences."""
    dice = np.random.default_rng(3)
    labeller = block_labeller.Labeller()
    labeller.weights = {name: value.astype(np.float64) for name, value in labeller.weights.items()}
    pages = [dice.normal(size=(n, block_labeller.WIDTH)) * 0.3 for n in (5, 2)]
    labels = [dice.integers(0, 2, n).astype(float) for n in (5, 2)]

    def loss():
        total = 0.0
        for page, label in zip(pages, labels):
            chance = labeller.chances([labeller.inputs(page)])[0]
            total -= (label * np.log(chance) + (1 - label) * np.log(1 - chance)).sum()
        return total / 7

    slopes = labeller._slopes(pages, labels)
    for name, value in labeller.weights.items():
        place = np.unravel_index(np.abs(slopes[name]).argmax(), slopes[name].shape)
        old = value[place]
        value[place] = old + 1e-2
        up = loss()
        value[place] = old - 1e-2
        down = loss()
        value[place] = old
        assert slopes[name][place] == pytest.approx((up - down) / 2e-2, rel=0.03, abs=1e-4), name


@needs_tables
def test_main_text_of_given_and_odd_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    odd = spark.createDataFrame([(-1, "u", None), (-2, None, ""), (-3, "u", "<nav>x</nav>"), (-4, "u", PAGE), (-4, "u", PAGE)], pages.schema)
    rows = block_labeller.main_text(pages.unionByName(odd)).collect()
    assert len(rows) == pages.count() + 5
    texts = {row.page_id: row.text for row in rows}
    assert (texts[-1], texts[-2], texts[-3]) == ("", "", "")
    assert texts[-4] == "Head line\n\nOne <two>. Next\n\nA éb c"
    right = 0
    for page in pages.collect():
        inside = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        wanted = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", part)).split()) for part in re.split(r"</?(?:p|h1)>", inside)]
        right += texts[page.page_id] == "\n\n".join(filter(None, wanted))
    assert right >= 0.98 * pages.count()
    assert block_labeller.main_text(pages.limit(0)).count() == 0


@needs_tables
def test_other_layouts(spark):
    labeller = block_labeller.trained(block_labeller.sample(spark.read.parquet(f"{SF.replace('0.001', '0.01')}/pages.parquet")))
    page = (
        '<body><div class="sidebar"><ul><li><a>Link</a></li></ul></div><div id="content"><h1>Title</h1><p>Some main text, indeed.</p>'
        '<p>More of it.</p><div class="comments"><p>I like it, said a reader.</p></div></div><footer>c</footer></body>'
    )
    found = html_blocks.blocks(page)
    chances = labeller.chances([labeller.inputs(block_labeller.Vectors(labeller.known).of(found))])[0]
    assert [block.text for block, chance in zip(found, chances) if chance > 0.5] == ["Title", "Some main text, indeed.", "More of it."]


@needs_tables
def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF).cache()
        kept.append((name, before, after))
        before = after
    by_name = {name: (old, new) for name, old, new in kept}
    for name, (_, new) in list(by_name.items())[:-1]:
        assert new.columns == columns, name
    assert 0 < by_name["quality rules"][1].count() < docs.count()
    old, new = by_name["near dedup"]
    assert new.count() == new.select("doc_id").distinct().count() <= old.count()
    old, new = by_name["mixing"]
    times = Counter(row.doc_id for row in new.select("doc_id").collect())
    assert max(times.values()) <= 3 and set(times) <= {row.doc_id for row in old.select("doc_id").collect()}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for row in by_name["encoding"][1].limit(50).collect():
        assert row.ids == library.encode(row.text, add_special_tokens=False).ids


def test_state_classes_and_hidden_elements():
    found = html_blocks.blocks(
        '<html class=x><body class="has-sidebar"><div class="no-sidebar widget-on leftBar"><p hidden>a</p><p style="color:red; display: none">b</p>'
        '<div aria-hidden="true"><p>c</p>d</div><span hidden>e</span><p>f <i style="display:none">g</i>h</p><p title="hidden">i</p></div>'
    )
    assert [block.text for block in found] == ["f h", "i"]
    assert found[0].path[:3] == (("html",), ("body",), ("div", ".left", ".bar"))


def test_names_around_the_text_decide_nothing():
    labeller = block_labeller.trained(_pages("0.01"))
    prose = "<p>The ship left in the morning, and nobody saw it again until late summer.</p>" * 4
    pages = [
        f'<body class="has-sidebar"><article class="post"><h1>Title</h1>{prose}</article><footer>End</footer></body>',
        f'<body class="widget-on"><nav>Home</nav><main>{prose}</main></body>',
        f'<body><div id="content"><div id="bodyContent" class="mw-body-content">{prose}</div></div><div class="sidebar">Links</div></body>',
    ]
    for page in pages:
        found = html_blocks.blocks(page)
        chances = labeller.chances([labeller.inputs(block_labeller.Vectors(labeller.known).of(found))])[0]
        main = [block.text for block, chance in zip(found, chances) if chance > 0.5]
        assert sum(text.startswith("The ship") for text in main) == 4 and not {"End", "Home", "Links"} & set(main)


def _pages(size):
    import pandas as pd

    return pd.read_parquet(f"{SF.replace('0.001', size)}/pages.parquet")["html"].tolist()[: block_labeller.SAMPLE_PAGES]


def test_pages_without_end_tags():
    texts = lambda page: [block.text for block in html_blocks.blocks(page)]
    assert texts("<html><head><title>T</title><meta charset=x><body><p>a<p>b") == ["a", "b"]
    assert texts("<head><title>T</title><style>p{}</style><p>a</p><p>b") == ["a", "b"]
    assert texts("<p>a <svg/> b</p><p>c <math x='1'/>d") == ["a b", "c d"]
    assert texts("<p>a<svg><text>no</text></svg> b</p>") == ["a b"]
    assert texts("<p>a<svg class=x/>no</svg>b") == ["ab"]
    assert texts("<p>a<noscript>b</p><p>c<iframe src=x>d") == ["ab", "cd"]
    assert texts("<p>a<script>var x='<p>'</script>b<SCRIPT SRC=y></SCRIPT >c<script x=\"y>no</script>d") == ["abcd"]
    assert len(texts("<p>x<svg>" * 20_000)) == 20_000
