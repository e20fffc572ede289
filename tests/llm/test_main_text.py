"""Blocks of pages, the labeller's gradients, and its accuracy on pages it has not seen."""

from __future__ import annotations

import numpy as np
import pytest
from netrill.llm import main_text
from netrill.llm.html_blocks import blocks_of

SCHEMA = "page_id long, url string, html string, text string, n_chars int"


@pytest.fixture(scope="module")
def model():
    return main_text.train()


def test_blocks():
    page = """<!doctype html><title>a < b</title><script>if (a<b) "</p>";</script><!-- <p>no</p> -->
      <div class='Side-bar x' id=top><p>one<p>two <b>bold<br>three</b>&amp;&nbsp;&lt;x</div>
      <ul><li>a<li><a href="x>y">link</a> rest</ul>tail</p></i><textarea><p>no</textarea><style>p{"""
    blocks = blocks_of(page)
    assert [b.text for b in blocks] == ["one", "two bold three& <x", "a", "link rest", "tail"]
    assert blocks[0].path == ["div", ".side", ".bar", ".x", ".top", "p"]
    assert blocks[3].linked == 4
    assert blocks[4].path == []
    assert blocks_of(None) == blocks_of("") == blocks_of("<p>  </p><br>") == []
    assert [b.text for b in blocks_of("<p>a < b &copy; 3<4")] == ["a < b © 3<4"]
    # A tag whose quote never closes ends at the next bracket.
    assert [b.text for b in blocks_of('<p title="un>open')] == ["open"]


def test_gradients_are_slopes():
    rng = np.random.default_rng(1)
    model = main_text.Labeller.fresh(3)
    pages = [(rng.random((n, main_text.WIDTH)) < 0.02).astype(float) for n in (3, 5, 1)]
    labels = [rng.integers(0, 2, len(p)).astype(float) for p in pages]
    _, slopes = main_text.gradients(model, pages, labels)
    for name, weights in model.weights.items():
        for place in np.argsort(-np.abs(slopes[name].ravel()))[:3]:
            old = weights.flat[place]
            losses = []
            for step in (1e-5, -1e-5):
                weights.flat[place] = old + step
                losses.append(main_text.gradients(model, pages, labels)[0])
            weights.flat[place] = old
            assert (losses[0] - losses[1]) / 2e-5 == pytest.approx(slopes[name].flat[place], rel=1e-3, abs=1e-7)


def test_pages_side_by_side_are_read_as_alone(model, monkeypatch):
    pages = [model.embedded(blocks) for blocks, _ in main_text.sample(11, 20)]
    monkeypatch.setattr(main_text, "TOGETHER", 100)
    together = model.labels([*pages, np.zeros((0, main_text.INNER))])
    for page, found in zip(pages, together, strict=False):
        np.testing.assert_allclose(model.labels([page])[0], found, atol=1e-9)
    assert len(together[-1]) == 0


def test_held_out_pages(model):
    made = main_text.sample(12345, 200)
    found = model.labels([model.embedded(blocks) for blocks, _ in made])
    wanted = np.concatenate([labels for _, labels in made]) > 0
    got = np.concatenate(found) >= 0.5
    assert (got == wanted).mean() > 0.97


def test_rows(spark, model):
    page = (
        '<body><div class="menu"><a href=1>Home</a> <a href=2>Contact</a></div><article><h1>The title here</h1>'
        "<p>First&nbsp;long paragraph, of some words.\n More of it.<p>Second paragraph, which ends here.</article>"
        '<div class="comments"><h3>2 comments</h3><p>I agree, great post.</p></div><footer>&copy; 2024 all rights</footer>'
    )
    long = "<article>" + "<p>Some words of a long page, as prose.</p>" * 5000 + "</article>"
    rows = [(1, "u", page, "clash", 0), (1, "u", page, "clash", 0), (2, None, None, None, None), (None, "v", "", "", 1), (3, "w", long, "", 1)]
    got = main_text.extracted(spark.createDataFrame(rows, SCHEMA), model).collect()
    text = "The title here\nFirst long paragraph, of some words. More of it.\nSecond paragraph, which ends here."
    assert [tuple(r) for r in got[:4]] == [
        (1, "u", text, len(text)), (1, "u", text, len(text)), (2, None, "", 0), (None, "v", "", 0)
    ]
    assert got[4]["text"].count("\n") == 4999
    assert main_text.extracted(spark.createDataFrame([], SCHEMA)).collect() == []


def test_own_labels():
    page = '<nav>x</nav><article><p>main</p><div class="ad">buy</div></article>'
    blocks, labels = main_text.own_labels(page)
    assert [b.text for b in blocks] == ["x", "main", "buy"]
    assert labels.tolist() == [0, 1, 0]
    assert main_text.own_labels("<p>no article</p>") is None
