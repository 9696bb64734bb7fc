"""Main text of hand-written pages of many makes."""

import pytest

from tenura.llm import extract as ex

LONG = "The harbour was quiet in the morning, and the boats lay still. Nobody had seen the storm coming. By noon the sky had turned dark, and the first drops fell."
MORE = "Later that day the fishermen came back. They spoke of waves as high as houses; some had lost their nets. The council met in the evening to discuss what to do."
THIRD = "In the end the town agreed on a new wall. It took three years to build, and it still stands today."
LINKS = "<ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li><li><a href='/c'>Sports</a></li><li><a href='/d'>Contact</a></li></ul>"

# name: (html, main text)
PAGES = {
    "unnamed block": (f"<body><div><h1>A storm</h1><p>{LONG}</p><p>{MORE}</p></div></body>", ["A storm", LONG, MORE]),
    "wrappers and semantic frame": (
        f"<body><nav>{LINKS}</nav><div class='wrapper'><div class='inner'><h1>A storm</h1><p>{LONG}</p><p>{MORE}</p></div></div><footer>© 2024 The Paper</footer></body>",
        ["A storm", LONG, MORE],
    ),
    "unknown names": (
        f"<body><div class='qx-top'>{LINKS}</div><div class='qx-a1'><div class='zz'><h1>A storm</h1><p>{LONG}</p><p>{MORE}</p><p>{THIRD}</p></div></div><div class='qx-b'><p>© 2024 All rights reserved</p></div></body>",
        ["A storm", LONG, MORE, THIRD],
    ),
    "table layout": (
        f"<body><table><tr><td><a href='/'>Home</a><br><a href='/n'>News</a><br><a href='/s'>Sports</a></td><td><h1>A storm</h1><p>{LONG}</p><p>{MORE}</p></td></tr></table></body>",
        ["A storm", LONG, MORE],
    ),
    "article header": (
        f"<body><header><a href='/'>The Paper</a>{LINKS}</header><article><header><h1>A storm</h1></header><p>{LONG}</p><p>{MORE}</p></article><footer><p>© 2024</p></footer></body>",
        ["A storm", LONG, MORE],
    ),
    "article header with standfirst": (
        f"<body><article><header class='entry-header'><h1>A storm</h1><p>{THIRD}</p></header><div class='entry-content'><p>{LONG}</p><p>{MORE}</p></div></article></body>",
        ["A storm", THIRD, LONG, MORE],
    ),
    "list comments": (
        f"<body><article><h1>A storm</h1><p>{LONG}</p><p>{MORE}</p></article><ol class='commentlist'><li>{THIRD}</li><li>I was there. It was awful.</li></ol></body>",
        ["A storm", LONG, MORE],
    ),
    "comments by id": (
        f"<body><main><h1>A storm</h1><p>{LONG}</p><p>{MORE}</p></main><section id='comments'><ul><li>Great piece!</li><li>{THIRD}</li></ul></section></body>",
        ["A storm", LONG, MORE],
    ),
    "comments inside the article": (
        f"<body><article><h1>A storm</h1><p>{LONG}</p><p>{MORE}</p><section id='comments'><h2>2 comments</h2><ul><li><p>{THIRD}</p></li><li><p>Nice.</p></li></ul></section></article></body>",
        ["A storm", LONG, MORE],
    ),
    "cookie bar": (
        f"<body><div class='cookie-banner'><p>We use cookies to improve your visit.</p><button>Accept</button></div><div id='content'><h1>A storm</h1><p>{LONG}</p><p>{MORE}</p></div></body>",
        ["A storm", LONG, MORE],
    ),
    "no names at all": (
        f"<body><div>{LINKS}</div><div><h1>A storm</h1><p>{LONG}</p><h2>Afterwards</h2><p>{MORE}</p></div><div><h3>Related</h3><ul><li><a href='/x'>Another storm</a></li><li><a href='/y'>A third one</a></li></ul></div><div>Copyright 2024 The Paper</div></body>",
        ["A storm", LONG, "Afterwards", MORE],
    ),
    "body of paragraphs": (f"<body><h1>A storm</h1><p>{LONG}</p><p>{MORE}</p><p>{THIRD}</p></body>", ["A storm", LONG, MORE, THIRD]),
    "breaks in a cell": (
        f"<body><table><tr><td><a href='/'>Home</a> <a href='/n'>News</a></td></tr><tr><td><font size=2>{LONG}<br><br>{MORE}</font></td></tr></table></body>",
        [f"{LONG} {MORE}"],
    ),
    "sections": (
        f"<body><header><h2><a href='/'>Site</a></h2></header><main><section><h2>One</h2><p>{LONG}</p></section><section><h2>Two</h2><p>{MORE}</p></section></main><aside><h3>Popular</h3>{LINKS}</aside></body>",
        ["One", LONG, "Two", MORE],
    ),
    "newsletter and share inside": (
        f"<body><div class='post'><h1>A storm</h1><div class='share'><a href='#'>Facebook</a> <a href='#'>Twitter</a></div><p>{LONG}</p><form class='newsletter'><label>Subscribe to our newsletter</label><input><button>Go</button></form><p>{MORE}</p></div></body>",
        ["A storm", LONG, MORE],
    ),
    "lists and quotes": (
        f"<body><nav>{LINKS}</nav><article><h1>A storm</h1><p>{LONG}</p><ul><li>High waves</li><li>Lost nets</li></ul><blockquote><p>{THIRD}</p></blockquote><p>{MORE}</p></article></body>",
        ["A storm", LONG, "High waves", "Lost nets", THIRD, MORE],
    ),
    "advert inside": (
        f"<body><div id='main-content'><h1>A storm</h1><p>{LONG}</p><div class='advertisement'><span>Advertisement</span><a href='http://ad'>Buy the best boots in town</a></div><p>{MORE}</p></div></body>",
        ["A storm", LONG, MORE],
    ),
    "sidebar in wrapper": (
        f"<body><div class='container'><div class='row'><div class='col-md-8'><h1>A storm</h1><p>{LONG}</p><p>{MORE}</p></div><div class='col-md-4 sidebar'><h3>Trending</h3>{LINKS}<p>Sign up today.</p></div></div></div></body>",
        ["A storm", LONG, MORE],
    ),
    "weblog": (
        f"<html><body class='single'><div id='page' class='site'><header id='masthead' class='site-header'><a href='/'>Blog</a><nav id='site-navigation'>{LINKS}</nav></header><div id='primary'><main id='main'><article class='post hentry'><header class='entry-header'><h1 class='entry-title'>A storm</h1></header><div class='entry-content'><p>{LONG}</p><figure><img src=x><figcaption>The old harbour</figcaption></figure><p>{MORE}</p></div></article><div id='comments' class='comments-area'><h2 class='comments-title'>2 thoughts</h2><ol class='comment-list'><li class='comment'><article class='comment-body'><p>{THIRD}</p></article></li></ol><div id='respond'><form><label>Name</label><input></form></div></div></main></div><aside id='secondary' class='widget-area'><h3>Recent posts</h3>{LINKS}</aside><footer id='colophon'>Proudly powered</footer></div></body></html>",
        ["A storm", LONG, "The old harbour", MORE],
    ),
    "names of two parts": (
        f"<div class='page'><div class='page__top'>{LINKS}</div><div class='blog-post'><div class='blog-post__title'><h1>A storm</h1></div><div class='blog-post__body'><p>{LONG}</p><pre>x = 1</pre><p>{MORE}</p></div></div><div class='page__bottom'><a href='/i'>Imprint</a></div></div>",
        ["A storm", LONG, "x = 1", MORE],
    ),
    "encyclopedia": (
        f"<body><div id='mw-navigation'>{LINKS}</div><div id='content' role='main'><h1 id='firstHeading'>Storm</h1><div id='toc' class='toc'><ul><li><a href='#1'>History</a></li><li><a href='#2'>Effects</a></li></ul></div><p>{LONG} See also <a href='/w'>wind</a> and <a href='/r'>rain</a>.</p><h2>History</h2><p>{MORE}</p><table class='wikitable'><tr><th>Year</th><th>Height</th></tr><tr><td>1999</td><td>12 m</td></tr></table></div><div id='footer'><p>Text is available under a free licence.</p></div></body>",
        ["Storm", f"{LONG} See also wind and rain.", "History", MORE, "Year", "Height", "1999", "12 m"],
    ),
    "short notice": (
        "<body><nav><a href='/'>Home</a></nav><main><h1>Notice</h1><p>The library is closed on Monday.</p></main><footer>© City</footer></body>",
        ["Notice", "The library is closed on Monday."],
    ),
    "comments in boxes": (
        f"<body><div class='story'><h1>A storm</h1><p>{LONG}</p><p>{MORE}</p><div class='reader-comments'><div class='c'><b>Ann</b><p>{THIRD}</p></div></div></div></body>",
        ["A storm", LONG, MORE],
    ),
    "boxes for paragraphs": (
        f"<body><div class='a'>{LINKS}</div><div class='b'><div>A storm</div><div>{LONG}</div><div>{MORE}</div><div>{THIRD}</div></div></body>",
        ["A storm", LONG, MORE, THIRD],
    ),
    "thread and repeated text": (
        f"<body><article><h2>A storm</h2><p>{LONG}</p><p>{MORE}</p><div id='disqus_thread'><p>{THIRD}</p></div></article><div class='sidebar'><p>{THIRD}</p></div></body>",
        ["A storm", LONG, MORE],
    ),
}


@pytest.fixture(scope="module")
def texts():
    got = ex.extract_texts([page for page, _ in PAGES.values()], ex.train())
    return dict(zip(PAGES, got))


@pytest.mark.parametrize("name", PAGES)
def test_layout(texts, name):
    assert texts[name].split("\n") == PAGES[name][1]


def test_features_tell_lengths_apart():
    short, long = (ex.forest_of([ex.parse(f"<p>{t}</p>")]) for t in ("Short.", LONG))
    assert set(short.slot.tolist()) != set(long.slot.tolist())
