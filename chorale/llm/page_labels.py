"""Labelled pages: hand-made HTML in usual layouts, with the content in ``<!--[-->`` marks.

They are what the weights of ``html_text`` are learned from. Marks may stand more than once.
"""

from __future__ import annotations

PAGES = [
    # A blog with its article marked up as such.
    """<html><head><title>Rain on the coast</title></head><body><header><a href="/">Coast Blog</a>
    <p>Notes from the sea side</p></header><nav><ul><li><a href="/">Home</a></li><li><a href="/a">About us</a></li>
    <li><a href="/c">Contact</a></li></ul></nav><article><!--[--><h1>Rain on the coast</h1><p>It rained for three days
    and the harbour filled with boats that had come in from the open sea.</p><p>On the <b>fourth</b> day the wind
    turned, as the <a href="/pilots">pilots</a> had said it would.<br>Nobody was surprised.</p><ul><li>Boats in port:
    forty</li><li>Days of rain: three</li></ul><p>Short end.</p><!--]--></article><aside><h3>More</h3><ul><li>
    <a href="/1">Fog in May</a></li><li><a href="/2">Storms of spring</a></li></ul></aside><footer><p>All rights
    reserved by the owners of this site.</p></footer></body></html>""",
    # A news page made of divisions.
    """<html><body><div id="top"><a href="/">News</a> <a href="/w">World</a> <a href="/s">Sport</a></div>
    <div class="crumbs"><a href="/">News</a> <a href="/w">World</a></div><div id="story"><!--[--><h1>Council agrees
    on new bridge</h1><p>The council voted on Monday to build a second bridge over the river, after years of debate
    about its cost.</p><blockquote><p>We have waited long enough, said the mayor.</p></blockquote><p>Work is to begin
    next year and will take four summers.</p><h2>What it costs</h2><p>The sum is given as ninety million, a third of
    it from the <a href="/state">state</a>.</p><!--]--></div><div id="rest"><h4>Read on</h4><a href="/3">Old bridge
    closed</a><a href="/4">River rises</a></div><div id="end"><a href="/terms">Terms</a><a href="/help">Help</a>
    </div></body></html>""",
    # A main element with a table and a list.
    """<html><body><header><h2>Cook Book</h2><a href="/">Start</a></header><main><!--[--><h1>Bread</h1><p>A plain
    loaf needs flour, water, salt and time.</p><table><tr><th>Flour</th><td>500 g</td></tr><tr><th>Water</th>
    <td>350 g</td></tr></table><ol><li>Mix everything and let it rest for an hour.</li><li>Fold, shape and bake it
    hot.</li></ol><!--]--></main><div><a href="/b">Buns</a><a href="/r">Rolls</a><a href="/p">Pies</a></div>
    <footer><a href="/imprint">Imprint</a> <p>Made with care in a small kitchen.</p></footer></body></html>""",
    # Old markup: paragraphs never closed, menus as lists.
    """<html><body><ul><li><a href="a">One</a><li><a href="b">Two</a><li><a href="c">Three</a></ul><!--[--><h1>On
    owls</h1><p>Owls hunt at night and sleep by day.<p>Their ears are set at different heights, so that they can tell
    how high a sound comes from.<p>Most of them keep to one place.<!--]--><hr><a href="up">Up</a> <a href="next">Next
    page</a></body></html>""",
]
