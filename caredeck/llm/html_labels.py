"""The labelled table of the block classifier: small pages and the texts of their content blocks."""

_LONG = "The council met on Tuesday to settle the budget for the coming year and heard reports from three departments."
_MORE = "After two hours the members agreed to fund the bridge, the school roof and a new library van out of reserves."
_THIRD = "Work is to start in spring, once the tenders have been read and the river has gone down to its usual level."
_SHORT = "It rained."
_LINKED = 'See the <a href="/r">full report of the audit office</a> for the figures behind the decision taken last week.'
_LINKED_TEXT = "See the full report of the audit office for the figures behind the decision taken last week."
_NAV = '<nav><ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/sport">Sport</a></li></ul></nav>'
_FOOT = "<footer>&copy; 2020 The Example. All rights reserved. Contact us for licences and reprints of this page.</footer>"
_COOKIE = '<div class="cookie-notice"><p>We use cookies to make this site work and to measure how it is used by visitors.</p></div>'
_AD = '<div class="ad">Buy two chairs and pay for one only this week in all our shops along the coast.</div>'
_SIDE = '<aside><h3>Most read</h3><ul><li><a href="/1">Storm takes the pier</a></li><li><a href="/2">Fair opens</a></li></ul></aside>'
_COMMENTS = (
    '<section class="comments"><h2>Comments</h2><div class="comment"><p>I was there and can say that nobody listened to the people '
    "from the harbour at all.</p></div><div class=\"comment\"><p>Agreed.</p></div></section>"
)
_FORM = '<form action="/s"><label>Get our letter every morning</label><input type="text"><button>Sign up</button></form>'
_HEAD = '<header><h1>The Example</h1><p>News from the coast since 1901, every day and for everyone in the county</p></header>'

#: (page, texts of its content blocks). Fixed, hand-labelled values.
LABELLED = (
    (f"<html><head><title>t</title></head><body>{_NAV}{_AD}<article><h1>Budget settled</h1><p>{_LONG}</p><p>{_SHORT}</p><p>{_MORE}</p></article>{_FOOT}</body></html>",
     {"Budget settled", _LONG, _SHORT, _MORE}),
    (f"<body>{_HEAD}{_NAV}{_COOKIE}<main><h2>Budget settled</h2><p>{_LINKED}</p><ul><li>Bridge</li><li>Roof</li></ul><p>{_THIRD}</p></main>{_SIDE}{_COMMENTS}{_FOOT}</body>",
     {"Budget settled", _LINKED_TEXT, "Bridge", "Roof", _THIRD}),
    (f"<body>{_NAV}<article><header><h1>Bridge first</h1></header><p>{_SHORT}</p><p>{_THIRD}</p>{_AD}<p>{_MORE}</p>{_FORM}{_COMMENTS}</article>{_SIDE}{_FOOT}</body>",
     {"Bridge first", _SHORT, _THIRD, _MORE}),
    (f"<body>{_NAV}<p>{_LONG}</p><p>{_MORE}</p><p>{_LINKED}</p>{_FOOT}</body>", {_LONG, _MORE, _LINKED_TEXT}),
    (f'<body><div class="menu"><a href="/a">Home</a> <a href="/b">About us</a></div><div class="post"><p>{_LONG}</p><p>{_SHORT}</p></div><div class="sidebar"><p>{_THIRD}</p></div></body>',
     {_LONG, _SHORT}),
    ('<body><div><a href="/a">One</a> <a href="/b">Two</a></div><div><a href="/c">More from the same writer and others</a></div>'
     f"<div>{_LONG}</div><div>{_MORE}</div><div><a href=\"/d\">Next page</a></div></body>", {_LONG, _MORE}),
    (f"<body>{_COOKIE}<article><p>{_SHORT}</p></article>{_SIDE}<div class=\"newsletter\"><p>{_THIRD}</p></div></body>", {_SHORT}),
    (f"<body><div id=\"content\"><h1>Library van</h1><p>{_THIRD}</p><p>{_LINKED}</p><p><a href=\"/m\">Map of the stops</a></p></div><div id=\"related\"><p>{_LONG}</p></div>{_FOOT}</body>",
     {"Library van", _THIRD, _LINKED_TEXT, "Map of the stops"}),
    (f"<body><table><tr><td><a href='/x'>Login</a></td><td><a href='/y'>Help</a></td></tr></table><p>{_MORE}</p><p>{_LONG}</p><p><a href='/z'>Older</a> <a href='/w'>Newer</a></p></body>",
     {_MORE, _LONG}),
    (f"<body>{_HEAD}<article><h1>A</h1><blockquote>{_LONG}</blockquote><pre>x = 1</pre><h2>B</h2><p>{_SHORT}</p></article>{_COMMENTS}{_FORM}</body>",
     {"A", _LONG, "x = 1", "B", _SHORT}),
    (f"<body><article><p>No.</p><p>Yes.</p><p>{_MORE}</p></article><footer>Imprint</footer></body>", {"No.", "Yes.", _MORE}),
    (f"<body>{_NAV}{_SIDE}{_AD}{_FORM}{_FOOT}</body>", set()),
    (f"<body><div>{_THIRD}</div><article><h1>Roof</h1><p>{_LONG}</p><p>{_SHORT}</p></article><div>{_MORE}</div><p>{_LINKED}</p></body>",
     {"Roof", _LONG, _SHORT}),
    (f"<body><p>{_SHORT}</p><main><p>{_THIRD}</p><p>{_MORE}</p><p><a href='/m'>All stops of the van on one map</a></p></main><p>{_LONG}</p></body>",
     {_THIRD, _MORE, "All stops of the van on one map"}),
    (f"<body><p><a href='/1'>Storm takes the pier at night</a></p><p>{_LONG}</p><p>{_THIRD}</p><p><a href='/2'>Fair opens in the old market</a></p></body>",
     {_LONG, _THIRD}),
)
