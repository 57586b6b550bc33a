"""Well-formedness of XML text against a parser."""

import random
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from tidemark.functions.xml import well_formed

CASES = ["<a/>", "<a></a>", "<a><b>x</b><b/></a>", "<a><b></a></b>", "<a>", "</a>", "<a></a></a>", "<a/><b/>", "", "text", "<a>x</a>tail", "head<a/>",
         "<a>1 < 2</a>", "<a>1 &lt; 2 &amp; &#65; &#x41;</a>", "<a>A & B</a>", "<a>&nbsp;</a>", "<a>&amp</a>", "<a x='1' y=\"a > b\"/>", "<a x=1/>", "<a x='<'/>",
         "<?xml version='1.0'?>\n<!-- <b> -->\n<a><![CDATA[</a> & <]]></a>\n<!-- end -->\n", "<!DOCTYPE a>\n<a/>", "<a><!-- open</a>", "<a><![CDATA[x</a>", "<A></a>",
         "<a:b xmlns:a='u'><a:c/></a:b>", "<a ><b\n/></a >", "< a/>", "<a b='1'c='2'/>", "<é>ü</é>", "<a>]]</a>", "<rss><channel><item><link>u</link></channel></rss>"]


def parses(text):
    try:
        ET.fromstring(text)
        return True
    except ET.ParseError:
        return False


def test_agrees_with_a_parser(spark):
    rng = random.Random(3)
    pieces = ["<a>", "</a>", "<b x='1'>", "</b>", "<c/>", "t", "&amp;", "&", "<", " ", "<!-- c -->"]
    texts = CASES + ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 9))) for _ in range(400)]
    texts += ["<a>" + "".join(rng.choice(pieces[:8]) for _ in range(rng.randrange(6))) + "</a>" for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", well_formed(F.col("t")).alias("ok"))
    wrong = [(r.t, r.ok) for r in df.collect() if r.ok != parses(r.t)]
    assert not wrong


def test_null_and_long_texts(spark):
    deep = "<a>" * 300 + "</a>" * 300
    wide = "<r>" + "<i k='v'>text</i>" * 20000 + "</r>"
    rows = [(None,), (deep,), (deep + "</a>",), (wide,), (wide[:-4],)]
    got = [r.ok for r in spark.createDataFrame(rows, "t string").select(well_formed(F.col("t")).alias("ok")).collect()]
    assert got == [False, True, False, True, False]


@pytest.mark.parametrize("fault", ["</item>", "<open>", "<b><i></b></i>", "A & B"])
def test_a_feed_that_cannot_be_parsed_has_no_items(spark, fault):
    from tidemark.sources.feeds import feed_items
    item = "<item><title>t</title><link>https://a.b/c</link><description>d</description></item>"
    good = f"<rss><channel>{item}{item}</channel></rss>"
    bad = good.replace("</channel>", f"{fault}</channel>")
    assert [r.n for r in feed_items(spark.createDataFrame([(0, good), (1, bad)], "n int, x string"), "x", ("n",)).collect()] == [0, 0]
