"""Broken and very long pages: one pass over the markup, bounded paths, and the text that is there."""

import time
import tracemalloc

import pytest

from variantloom.llm import html_extract

MB = 1_000_000


@pytest.mark.parametrize("unit", ["<a ", "<svg ", "<!", "<", '<a "', "<a '\"", "<a b=' ", "</div ", "<script ", "<p>", "</table>", "<br", "&lt;", '<p class="x" '])
def test_a_megabyte_of_broken_markup(unit):
    page = "<body><p>the text of the page</p>" + unit * (MB // len(unit))
    start = time.process_time()
    text = html_extract.extract_text(page, [])
    assert time.process_time() - start < 10 and text.startswith("the text of the page")


def test_unclosed_tags_before_text():
    assert html_extract.extract_text("<p>one <b two</p><p>three</p>", []).endswith("three")
    assert html_extract.extract_text("<body><div class='a > b'><p>x</p></div><p title=\"<b>\">y</p></body>", []) == "x\n\ny"
    assert html_extract.extract_text("<!DOCTYPE html><p>x</p><?php y", []) == "x"


def test_deep_elements_hold_no_square_of_their_depth():
    page = "<body>" + '<div class="col wrapper">' * 16_000 + "<p>deep text</p>" + "</div>" * 16_000 + "<p>after</p>"
    tracemalloc.start()
    text = html_extract.extract_text(page, [])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert text == "deep text\n\nafter" and peak < 200 * MB


def test_unmatched_ends_in_deep_elements():
    page = "<body>" + "<div>" * 20_000 + "text" + "</section>" * 20_000
    start = time.process_time()
    assert html_extract.extract_text(page, []) == "text" and time.process_time() - start < 10


def test_equal_long_paths_have_one_name():
    page = "<div class='some long name of a class'>" * 40 + "text"
    paths = [[c.path for c in html_extract.parse(page)[1]] for _ in range(2)]
    assert paths[0] == paths[1] and len(set(paths[0])) == 40 and max(map(len, paths[0])) <= html_extract.MOST_PATH
