"""Records that an XML parser refuses, each with its reason, and those it takes."""

import xml.etree.ElementTree as ET

from svgspark.operators import tree as T

X = 'xmlns:x="u"'
ROWS = {
    "<svg></g></svg>": "unexpected close tag",
    "</svg>": "unexpected close tag",
    "<svg><g></svg>": "mismatched tag",
    "<svg><g>": "unclosed tag",
    "<svg/><g/>": "junk after document element",
    "<!-- c -->": None,
    "<svg/>text": "text outside the document element",
    "<svg a=b/>": "malformed tag",
    "<svg a/>": "malformed tag",
    '<svg a="1"b="2"/>': "malformed tag",
    '<svg a="x<y"/>': "malformed tag",
    "<svg a='1' a='2'/>": "duplicate attribute",
    "<svg>&nbsp;</svg>": "undefined entity",
    '<svg a="b & c"/>': "undefined entity",
    "<svg>a ]]> b</svg>": "malformed comment or text",
    "<svg><!-- a -- b --></svg>": "malformed comment or text",
    "<svg>a\x01b</svg>": "invalid character",
    " <?xml version='1.0'?><svg/>": "XML declaration not at the start",
    '<svg><use x:href="#a"/></svg>': "unbound prefix",
    "<x:svg/>": "unbound prefix",
    f'<svg><g {X}><a x:b="1"/></g><a x:b="1"/></svg>': "unbound prefix",
    f'<svg><g {X}/><a x:b="1"/></svg>': "unbound prefix",
    f'<svg><g><a {X}/></g><g><a x:b="1"/></g></svg>': "unbound prefix",
    f'<svg {X}><g><a x:b="1"/></g></svg>': None,
    f'<svg><a x:b="1" {X}/></svg>': None,
    f'<svg><g {X}><g {X}/><x:a></x:a></g></svg>': None,
    '<svg xml:space="preserve" xml:lang="en">a &amp; b &#233; &#xE9; <![CDATA[ & < ]]></svg>': None,
    "<?xml version='1.0'?><!DOCTYPE svg><svg a='&lt;' b=\"it's\"><!-- c --><g\n id = 'x' /></svg >": None,
}


def test_reasons(spark):
    docs = spark.createDataFrame(list(enumerate(ROWS)), "rec_id long, svg string")
    got = {r.rec_id: (r.ok, r.reason) for r in T.wellformed(T.svg_tokens(docs)).collect()}
    wrong = []
    for k, (svg, reason) in enumerate(ROWS.items()):
        want = "no element" if svg == "<!-- c -->" else reason
        try:
            ET.fromstring(svg)
            parsed = True
        except ET.ParseError:
            parsed = False
        if got[k] != (want is None, want) or parsed != got[k][0]:
            wrong.append((svg, got[k], want, parsed))
    assert wrong == []
