import pytest

from pricedex.llm import html_extract as H


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain  text", ""), ("<body>plain\n text &amp; more", "plain text & more"),
    ("<nav>menu</nav><body><article><h1>T</h1><p>One<b>two</b><br>three<p>Four &lt;5&gt; &copy</article><footer>f</footer>",
     "T\nOnetwo three\nFour <5> ©"),
    ("<body><article><p>a < b and c<d></p><p>cut off <a hre", "a < b and c\ncut off"),
    ("<body><div id='main'><p>kept<script>var x='</p><p>no'</script> text</p><style>p{}</style></div><div class='ad-box'>ad",
     "kept text"),
    ("<body><main><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></main><form><p>f</p></form>", "a\nb\nc\nd"),
    ("<body><article><p>text</p><section class='comments'><article><p>reader</p></article></section></article>", "text"),
    ("<body><div class=post><h1>H</h1><div class=txt><p>long enough text here</p></div></div><p hidden>no</p>",
     "H\nlong enough text here"),
    ("<body><article><!-- <p>no</p> --><p>yes</p><!-- open", "yes"),
    ("<body><article><p title='a>b\"' class=\"x\">quoted</p><p title=\"open>next</p><p>last</p></article>", "quoted\nnext\nlast"),
    ("<html><body><article>&#72;&#x69;&nbsp;&eacute;&bogus;</article>", "Hi é&bogus;"),
    ("</p></div><body></x><article><p>stray</b></i></article></article>", "stray"),
    ("<body><article><p>in <button>press</button>side</p></article>", "in side"),
])
def test_extract(page, text):
    assert H.extract(page or "", None) == text


def test_general_classes():
    assert H._general("post-12345") == "post-N" and H._general("Entry_Body") == "entry-body"


def page(template, i):
    body = "".join(f"<p>Paragraph {k} of page {i} with some words in it.</p>" for k in range(3))
    if template == "odd":  # the page's own best container is the wrong one; its host knows better
        return (f"<body><div class='story s{i}'>{body}</div><div class='teasers'>"
                + "<p>another long teaser text</p>" * 60 + "</div>")
    return f"<body><div class='story s{i}'>{body}</div><div class='teasers'><p>teaser</p></div>"


def test_host_consensus_decides(spark):
    rows = [(i, f"https://www.host.example/{i}", page("usual", i)) for i in range(9)]
    rows += [(9, "https://WWW.host.example:443/odd", page("odd", 9)), (10, None, "<body><div class=x><p>no host</p></div>"),
             (11, "https://other.example", None), (None, "https://www.host.example/n", "<body><article><p>no path</p></article>")]
    pages = spark.createDataFrame([(*r, "h", "p") for r in rows], "page_id long, url string, html string, host string, path string")
    got = {r.page_id: r for r in H.extract_pages(spark, pages).collect()}
    assert len(got) == len(rows)
    assert got[9].path == ">body>div.N.story" and got[9].host == "www.host.example"
    assert got[9].text == "\n".join(f"Paragraph {k} of page 9 with some words in it." for k in range(3))
    assert got[10].text == "no host" and got[11].text == "" and got[None].text == "no path"


def test_winner_has_most_pages_then_text(spark):
    counted = spark.createDataFrame([("h", "a", 3, 10), ("h", "b", 3, 11), ("h", "c", 2, 99), ("g", "z", 1, 1), ("g", "y", 1, 1)],
                                    "host string, path string, pages long, chars long")
    assert {r.host: r.path for r in H.winning_paths(counted).collect()} == {"h": "b", "g": "y"}


def test_empty_table(spark):
    assert H.extract_pages(spark, spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_query_on_the_given_pages(spark):
    """The given pages have one article each: its blocks, read with plain string work."""
    import html
    import re

    from pricedex.llm.queries import QUERIES, read_table

    sf = "/root/testdata/sf0.001"
    got = {r.page_id: r for r in QUERIES["op2_html_extraction"](spark, sf).collect()}
    rows = read_table(spark, sf, "pages").collect()
    assert set(got) == {r.page_id for r in rows}
    for r in rows:
        body = r.html.split("<article>", 1)[1].split("</article>")[0].split("<footer>")[0]
        body = re.sub(r"<[^>]*$", "", body)
        blocks = (html.unescape(re.sub(r"<[^<>]*>", "", b.replace("<br>", " "))) for b in re.split(r"</?(?:p|h1)>", body))
        text = "\n".join(t for b in blocks if (t := " ".join(b.split())))
        assert got[r.page_id].text == text and got[r.page_id].n_chars == len(text)
