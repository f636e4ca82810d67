"""Page extraction on wrappers, names inside articles, elements left open, and pages made to take long."""

from __future__ import annotations

import time

import pytest

from tessera.llm import html_extract as H

LONG = " ".join(f"word{i}" for i in range(60)) + "."
P = f"<p>{LONG}</p>"


@pytest.mark.parametrize("html", [
    f"<form id=aspnetForm><div id=content><article>{P}</article></div></form>",
    f"<article><section class=search><h2>Search algorithms</h2>{P}</section></article>",
    f"<article><section class='related work'>{P}</section></article>",
    f"<button>Go<article>{P}</article>",
    f"<select><option>a<option>b<article>{P}</article>",
    f"<svg><article>{P}</article>",
    f"<iframe src=x><article>{P}</article>",
    f"<template><canvas><audio><video><article>{P}</article>",
    f"<object><object>inner</object>outer</object><article>{P}</article>",
    f"<article>{P}</article><script>if (a < b) {{",
    f"<article>{P}</article><button>one</button><button>two</button>",
])
def test_the_article_stands_alone(html):
    got = H.main_text(html)
    assert LONG in got and not any(x in got for x in ("inner", "outer", "one", "two", "if (a"))


def test_a_form_around_the_page_says_nothing_and_one_inside_goes():
    assert H.main_text(f"<form><div>{P}{P}</div></form>") == f"{LONG}\n{LONG}"
    inside = f"<article>{P}<form><p>Subscribe to our newsletter for weekly updates</p><label>Mail</label><input></form>{P}</article>"
    assert H.main_text(inside) == f"{LONG}\n{LONG}"
    assert H.main_text("<form><label>Name</label><input><label>Mail</label><input><p>Send us a message.</p></form>") == ""


def test_formulas_stay_in_their_sentence():
    assert H.main_text(f"<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be {LONG}</p></article>") == f"Let x=2 be {LONG}"


@pytest.mark.parametrize("page", [
    "<a " * 350_000, "<div>" * 100_000 + "</p>" * 100_000 + "</i>" * 100_000, "<i><div>" + "<b>" * 150_000 + "</i>" * 150_000, "<svg>" * 200_000,
    "<button>" * 120_000, '<a "x' * 200_000, "<!-- " * 200_000, "<form>" * 150_000, "<" * 1_000_000, "</" * 500_000, "<b>" * 100_000 + "x" + "</b>" * 100_000])
def test_a_megabyte_of_anything_takes_little_time(page):
    began = time.process_time()
    H.main_text(page)
    assert time.process_time() - began < 4
