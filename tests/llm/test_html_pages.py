"""No article text is lost: pages that once lost it, generated pages with known
text, deep pages."""

import random
import time

import pytest

from daycut.llm import html_paths

LONG = "The harbour town was quiet that morning and the boats lay still. " * 4
ARTICLE = f"<article><h1>Harbour</h1><p>{LONG}</p></article>"
TEXT = f"Harbour\n{LONG.strip()}"


@pytest.mark.parametrize("page", [
    f"<body><form id='aspnetForm'><input name=a><div>{ARTICLE}</div><button>Go</button></form></body>",
    f"<body><header><main>{ARTICLE}</main></header><footer>Imprint</footer></body>",
    f"<body>{ARTICLE.replace('<article>', '<article title=' + chr(34) + 'a hidden gem' + chr(34) + '>')}</body>",
    f"<body>{ARTICLE.replace('<p>', '<p title=' + chr(34) + 'the hidden cost' + chr(34) + '>')}</body>",
    f"<body><div role='dialog'><main>{ARTICLE}</main></div></body>",
    f"<body><div hidden>{ARTICLE}</div></body>",
    f"<body><div hidden>Loading</div>{ARTICLE}<div aria-hidden='true'>x</div><nav><ul><li>Home</ul></nav></body>",
    f"<body><form role=search><label>Find</label><input></form>{ARTICLE}<form><label>Your name</label> Send</form></body>",
    f"<body><header><h2>Site</h2></header>{ARTICLE}<aside>Related reads and more of them</aside></body>"])
def test_pages_keep_their_article(page):
    assert html_paths.extract(page, [])[0] == TEXT


def test_math_and_label_stay():
    page = f"<body><article><p>{LONG}<p>Energy <math><mi>E</mi></math> is <label>mass</label> here</article></body>"
    assert html_paths.extract(page, [])[0].endswith("\nEnergy E is mass here")


def test_attributes_by_name():
    assert html_paths.attributes(""" hidden class="a b" title='hidden role=alert' data-x=1 CLASS=c async""") == {
        "hidden": "", "class": "a b", "title": "hidden role=alert", "data-x": "1", "async": ""}


def words(rng, n):
    return " ".join(rng.choice(["stone", "river", "käse", "a&b", "12 < 13", "mill", "Ähre"]) for _ in range(n)).strip()


def generated(rng):
    """A page and the text it should give."""
    esc = lambda t: t.replace("&", "&amp;").replace("<", "&lt;")
    blocks = [words(rng, rng.randrange(25, 60)) for _ in range(rng.randrange(2, 6))]
    body = "".join(f"<{t}>{esc(b)}</{t}>" for b in blocks for t in [rng.choice(["p", "div", "blockquote", "h2"])])
    box = rng.choice(["<article{}>%s</article>", "<main{}>%s</main>", "<div class='post-body'{}>%s</div>", "<section{}>%s</section>"])
    box = box.format(rng.choice(["", " title='hidden footer'", " data-role=alert", " id=nav-history"])) % body
    for _ in range(rng.randrange(0, 3)):
        box = rng.choice(["<div class='wrap'>%s</div>", "<form id=f1>%s</form>", "<div class='site-content'>%s</div>",
                          "<table><tr><td>%s</td></tr></table>"]) % box
    junk = ["<nav><a href=/>Home</a> <a href=/x>More</a></nav>", "<div class='cookie-notice'>We use cookies</div>",
            "<footer><p>Imprint and contact</p></footer>", "<aside>Read this next</aside>", "<script>var a='<p>';</script>",
            "<div class='comments'><p>First!</p></div>", "<form><label>Mail</label><input></form>", "<style>p{}</style>",
            "<div role=navigation>Skip to here</div>", "<div hidden>secret</div>", "<header>Daily News</header>", "<!-- no -->"]
    rng.shuffle(junk)
    cut = rng.randrange(len(junk))
    return f"<html><body>{''.join(junk[:cut])}{box}{''.join(junk[cut:])}</body></html>", "\n".join(" ".join(b.split()) for b in blocks)


def test_generated_pages_alone():
    rng = random.Random(11)
    for _ in range(400):
        page, text = generated(rng)
        assert html_paths.extract(page, [])[0] == text, page


def test_generated_pages_by_host(spark):
    """Several hosts of one template each, a host of very many pages among them."""
    rng, rows, want = random.Random(12), [], {}
    for host in range(6):
        state = rng.getstate()
        for i in range(60 if host else 300):
            page, text = generated(rng)
            rows.append((len(rows), f"https://h{host}.example/{i}", page))
            want[len(rows) - 1] = text
        rng.setstate(state)
        rng.random()
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    for bound in (html_paths.SENT_BYTES, -1):               # sent winners, dealt hosts
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(html_paths, "SENT_BYTES", bound)
            got = {r.id: r.text for r in html_paths.extract_pages(df).collect()}
        assert got.keys() == want.keys()
        lost = [i for i in want if not set(want[i].split("\n")) <= set(got[i].split("\n"))]
        assert len(lost) <= 0.02 * len(want), lost


def test_time_grows_with_the_page():
    """Nested unclosed elements, four times as many: about four times the work."""
    took = []
    for n in (4000, 16000):
        page = "<div class=x>word <ul hidden><b>" * n
        t0 = time.process_time()
        html_paths.extract(page, ["/div.x/div.x", "/div.y"])
        took.append(time.process_time() - t0)
    assert took[1] < 9 * took[0] + 0.2
