"""Heads without end tags, and formulas."""

import pytest

from corpusloom.llm.htmlblocks import blocks


@pytest.mark.parametrize("source,want", [
    ("<html><head><meta charset=utf-8><title>x</title><article><p>Text", ["Text"]),
    ("<head><title>x</title><style>p{}</style><link rel=a><p>One<p>Two", ["One", "Two"]),
    ("<head><title>x</title>Plain <b>words</b> first<p>Two", ["Plain words first", "Two"]),
    ("<head><template><p>never shown</p></template><script>1<2</script><span>Shown</span>", ["Shown"]),
    ("<head><title>x</title></head><body><p>Text</p></body>", ["Text"]),
    ("<article><p>So <math><mi>a</mi><mo>=</mo><mn>1</mn><annotation encoding='application/x-tex'>a=1</annotation></math> holds</p></article>", ["So a=1 holds"]),
    ("<p>tail <svg><title>t</title></svg> end</p><p>next</p>", ["tail end", "next"]),
    ("<p>tail <svg viewBox='0 0 9 9'><title>t</title><desc>d <p>e</p></desc><text><li>x</li></text><g><div>y</div></g></svg> end", ["tail end"]),
    ("<p>cut <svg><text>never closed</p><p>next</p>", ["cut", "next"]),
    ("<svg><title>logo</title></svg><h1>Head</h1><p>one<p>two", ["Head", "one", "two"]),
])
def test_text_after_an_open_head(source, want):
    assert [b.text for b in blocks(source)] == want
