"""Everyday entities are decoded without a look at each, to what html.unescape gives."""

import html

import pytest

from feedloom.functions import text

TEXTS = ["&amp;lt; &amp;", "&lt;&gt;&quot;&#39;&apos;&nbsp;&copy;&middot;&amp;", "a & b", "&amp;&", "&ampamp;", "&copy &lt;", "&notit;", "&#x27;&amp;", "x"]


@pytest.mark.parametrize("value", TEXTS)
def test_same_as_html_unescape(value):
    assert text._decoded(value) == html.unescape(value)


def test_everyday_entities_take_no_step_each(monkeypatch):
    monkeypatch.setattr(text.html, "unescape", None)
    assert text._decoded(" &amp;lt; &quot;x&quot; &amp;") == ' &lt; "x" &'
