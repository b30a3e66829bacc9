"""Small fixtures and brute-force versions of the training-data operators.

Fixtures hold nulls, empty and long texts, repeated rows, ties, empty tables
and extra columns whose names clash with the operators' own.
"""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daycut.llm import (catalog, common, cotrain, decontam, html_paths, jaccard, langid, merkle, mixing, mtree, secrets,
                        substring)

WORD = re.compile(r"[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k1 string, n string, gram long, id string"


def frame(spark, texts, schema=SCHEMA):
    """Documents with clashing extra columns; ``texts``: (id, text) pairs."""
    rows = [(i, t, "en" if n % 2 else None, None if n % 7 == 0 else f"s{n % 3}", None if t is None else len(t),
             "x", "y", 1, "z") for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, schema)


def prose(seed, n, words=300):
    rng = random.Random(seed)
    return " ".join(rng.choice([f"w{rng.randrange(words)}", f"É{rng.randrange(words)}"]) for _ in range(n))


ODD = [(1, None), (2, ""), (3, " \t\n"), (None, "one two"), (5, "one two"), (5, "one two"), (6, "Word " * 900),
       (7, prose(1, 120)), (8, prose(1, 120)), (9, prose(1, 119) + " other"), (10, "x" * 5000), (11, "a b c d e")]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- secrets

def brute_base(text):
    text = text or ""
    assign = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 1, m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 2, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 3, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def test_secret_base_and_links(spark):
    near, far = " " * 50, " x" * 400
    bare = "Zx81QmNv02LkPqRt93WyAs7d"
    texts = ODD + [
        (20, 'é token = "abcdefgh12" and PassWord:short'), (21, "token: token:abcdefghijk"),
        (22, "AKIA" + "A" * 12 + near + bare), (23, "AKIA" + "A" * 12 + far + bare), (24, bare),
        (25, "user=alice" + near + "secret=abcdefgh1234 http://db.example.com:80/x"), (26, "user=alice"),
        (27, "http://db.example.com user=bob"), (28, "deadbeef" * 5 + near + "login: carol"), (29, "AKIAAKIA" + "B" * 9)]
    got = secrets.secrets_digest(secrets.scan_secrets(frame(spark, texts))).collect()
    by = {r.doc_id: r for r in got if r.doc_id and r.doc_id >= 20}
    assert len(got) == len(texts)
    for i, t in texts:
        if i and i >= 20:
            base = brute_base(t)
            assert by[i].base_sha256 == sha(",".join(f"{secrets.KINDS[k - 1]}:{a}:{b}" for a, k, b in base))
            assert (by[i].n_assign, by[i].n_access, by[i].n_hex) == tuple(sum(k == x for _, k, _ in base) for x in (1, 2, 3))
    assert "bare" in by[22].spans and by[23].spans == "access:0:16" and by[24].spans == ""
    assert by[25].spans.count(":") == 6 and "endpoint" in by[25].spans and "account" in by[25].spans
    assert by[26].spans == "" and by[27].spans == "" and "account" in by[28].spans
    assert all(r.spans == "" and r.base_sha256 == sha("") for r in got if r.doc_id in (1, 2, 3))


def test_redact(spark):
    docs = frame(spark, ODD + [(20, "é token = abcdefgh12 end"), (20, "é token = abcdefgh12 end")])
    out = secrets.redact(docs, secrets.scan_secrets(docs))
    assert out.columns == docs.columns
    assert sorted(r.text for r in out.where("doc_id = 20").collect()) == ["é [SECRET] end"] * 2
    assert out.count() == docs.count() and out.where("text IS NULL").count() == 1


def brute_redact(text, spans):
    out, at = "", 0
    for start, _, stop in spans:
        if start >= at:
            out += text[at:start] + "[SECRET]"
        at = max(at, stop)
    return out + text[at:]


def test_redact_long_texts_and_clashing_names(spark):
    rng = random.Random(3)
    pool = ["secret=abcdefgh12", "é" * 700, "\U0001f600" * 900, "deadbeef" * 5, "token: secret=abcdefghij", "\n", " word ",
            "AKIA" + "A" * 12, "password='" + "ab12" * 9 + "'"]
    texts = [(i, "".join(rng.choice(pool) + rng.choice(["", " "]) for _ in range(rng.randrange(1, 40)))) for i in range(60)]
    docs = frame(spark, texts).withColumnsRenamed({"k1": "_k1", "n": "_found"})
    found = secrets.scan_secrets(docs)
    spans = {r.id: r.found for r in found.collect()}
    for i, text in texts:
        assert set(brute_base(text)) <= {tuple(s) for s in spans[i]}
    out = secrets.redact(docs, found)
    assert out.columns == docs.columns
    assert {r.doc_id: (r.text, r._k1, r._found) for r in out.collect()} == {
        i: (brute_redact(t, spans[i]), "x", "y") for i, t in texts}


def test_secrets_of_a_text_with_100_000_findings(spark):
    parts = [f"secret=abcdefgh{n:06d} user=u{n:06d}x" for n in range(50_000)]
    text = "\n".join(parts)
    docs = spark.createDataFrame([(1, text), (2, "clean")], "doc_id long, text string")
    found = secrets.scan_secrets(docs)
    spans = {r.id: r.found for r in found.collect()}
    assert len(spans[1]) == 100_000 and spans[2] == []
    assert [tuple(s) for s in spans[1] if s.kind == 1] == brute_base(text)
    clean = {r.doc_id: r.text for r in secrets.redact(docs, found).collect()}
    assert clean == {1: "\n".join(["[SECRET] [SECRET]"] * 50_000), 2: "clean"}


def test_secret_scan_has_no_python(spark):
    plan = secrets.scan_secrets(frame(spark, ODD))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---- n-gram Jaccard join

def brute_sets(texts):
    out = []
    for _, t in texts:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def brute_components(texts, percent=80):
    sets, top = brute_sets(texts), list(range(len(texts)))

    def find(a):
        while top[a] != a:
            a = top[a]
        return a

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                top[y] = x
    low = {}
    for i, (d, _) in enumerate(texts):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [(d, len(sets[i]), low.get(find(i))) for i, (d, _) in enumerate(texts)]


def near_copies(seed, n, groups=4, size=80):
    rng = random.Random(seed)
    seeds = [prose(100 * seed + g, size + 10 * g).split() for g in range(groups)]
    out = []
    for i in range(n):
        w = list(rng.choice(seeds))
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(len(w))] = f"q{rng.randrange(10**6)}"
        out.append((1000 + i, " ".join(w)))
    return out


def key(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("block", [jaccard.BLOCK_GRAMS, 200])
def test_jaccard_components(spark, block):
    texts = ODD + near_copies(3, 60) + [(2000 + i, "common line of seven words right here " + prose(i, 40)) for i in range(12)]
    random.Random(1).shuffle(texts)
    got = jaccard.jaccard_components(frame(spark, texts), block_grams=block)
    assert key([(r.id, r.n, r.component) for r in got.collect()]) == key(brute_components(texts))


def test_trie_links_against_all_pairs():
    rng = np.random.default_rng(5)
    for _ in range(300):
        bases = [rng.choice(60, size=rng.integers(1, 40), replace=False) for _ in range(3)]
        sets = []
        for _ in range(rng.integers(1, 14)):
            s = set(bases[rng.integers(3)].tolist())
            for _ in range(rng.integers(0, 4)):
                s ^= {int(rng.integers(0, 70))}
            sets.append(np.array(sorted(s or {1}), dtype=np.uint64))
        percent = int(rng.choice([50, 70, 80, 100]))
        top = list(range(len(sets)))
        for i, a in enumerate(sets):
            for j in range(i):
                both = len(np.intersect1d(a, sets[j]))
                if 100 * both >= percent * (len(a) + len(sets[j]) - both):
                    lo, hi = sorted((top[i], top[j]))
                    top = [lo if t == hi else t for t in top]
        assert jaccard.trie_links(sets, percent).tolist() == top


def test_one_of_each_keeps_clashing_columns(spark):
    docs = frame(spark, ODD).withColumnsRenamed({"k1": "_k1", "n": "_twice", "gram": "_K2"})
    out = jaccard.one_of_each(docs, jaccard.jaccard_components(docs))
    assert out.columns == docs.columns
    assert {(r._k1, r._twice, r._K2) for r in out.collect()} == {("x", "y", 1)}
    assert sorted(r.doc_id for r in out.collect() if r.doc_id) == [1, 2, 3, 5, 6, 7, 10, 11]


def test_one_of_each(spark):
    texts = ODD + near_copies(4, 20)
    docs = frame(spark, texts)
    kept = jaccard.one_of_each(docs, jaccard.jaccard_components(docs))
    assert kept.columns == docs.columns
    want = [d for d, n, c in brute_components(texts) if n == 0 or d == c]
    got = [r.doc_id for r in kept.collect()]
    assert key(set(got)) == key(set(want)) and got.count(5) == 1 and len(got) == len(set(got))


def test_components_of_a_graph(spark):
    order = list(range(300))
    random.Random(2).shuffle(order)
    edges = list(zip(order, order[1:])) + [(1000, 1001), (1001, 1002), (2000, 2000)]
    got = {r.node: r.comp for r in common.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in order}, 1000: 1000, 1001: 1000, 1002: 1000, 2000: 2000}


# ---- substring dedup

def brute_repeats(texts, window=35):
    docs = [WORD.findall(t or "") for _, t in texts]
    count = {}
    for w in docs:
        for i in range(len(w) - window + 1):
            count[tuple(w[i:i + window])] = count.get(tuple(w[i:i + window]), 0) + 1
    out = []
    for (d, _), w in zip(texts, docs):
        keep = [True] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                keep[i:i + window] = [False] * window
        kept = [x for x, k in zip(w, keep) if k]
        out.append((d, len(w), len(w) - len(kept), " ".join(kept)))
    return out


@pytest.mark.parametrize("shard, hot", [(substring.SHARD_WORDS, substring.HOT_LEAST), (100, 3)])
def test_remove_repeats(spark, shard, hot):
    passage, line = prose(50, 60), prose(51, 14)
    texts = ODD + [(100 + i, f"{prose(200 + i, 30)} {passage if i % 2 else prose(i, 40)}\n{line}  {prose(300 + i, 30)}")
                   for i in range(20)]
    texts += [(200, f"{passage} tail"), (201, prose(52, 34)), (202, prose(52, 34)), (203, prose(53, 35)),
              (204, prose(53, 35)), (205, "p q r " * 60), (206, " ".join(passage.split()[10:50]) + " end")]
    got = substring.remove_repeats(frame(spark, texts), shard_words=shard, hot_least=hot)
    assert key([(r.id, r.n_words, r.n_removed, r.kept) for r in got.collect()]) == key(brute_repeats(texts))


def test_a_common_passage_is_dealt_over_parts(spark):
    passage = prose(60, 60)
    texts = [(i, f"{prose(400 + i, 30)} {passage} {prose(900 + i, 30)}") for i in range(400)]
    texts += [(1000 + i, f"{prose(400 + i, 30)} {' '.join(passage.split()[:20])}") for i in range(30)]
    most = []

    def watch(*args, real=substring.dealt):
        out = real(*args)
        most.append([out.where("hash IS NULL").groupBy(*by).agg(F.sum(F.octet_length("words") / 6).alias("s"))
                            .agg(F.max("s")).first()[0] for by in (["key"], ["key", "part"])])
        return out

    with pytest.MonkeyPatch.context() as m:
        m.setattr(substring, "dealt", watch)
        got = substring.remove_repeats(frame(spark, texts), shard_words=1000, hot_least=100)
        rows = [(r.id, r.n_words, r.n_removed, r.kept) for r in got.collect()]
    assert key(rows) == key(brute_repeats(texts))
    whole, part = most[0]
    assert whole > 4000 and part < 2000


# ---- HTML extraction

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<div class="cookie-banner">We use cookies</div><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- <p>no</p> -->
<div id="main-7" class="post post-12"><h1>Head &amp; line</h1><p>First  text<b> bold<p>Second&nbsp;one<br>after break
<form><input name=q>Search</form><div class="ad">Buy</div><p>Third</div>
<section class="comments"><p>reader says</p></section><aside>side</aside><footer>&copy; foot</footer></body></html>"""


def test_extraction(spark):
    pages = spark.createDataFrame(
        [(1, "https://H.example.com/a", PAGE, "c"), (2, "http://h.example.com:8/b", PAGE.replace("post-12", "post-99"), "c"),
         (3, None, "", "c"), (4, "x", None, "c"), (5, "http://h.example.com/c", "<p>bare <i>text", "c"),
         (5, "http://h.example.com/c", "<p>bare <i>text", "c"), (None, "http://o/", "plain & simple < 3", "c")],
        "page_id long, url string, html string, host string")
    got = {(r.id, r.url): r for r in html_paths.extract_pages(pages).collect()}
    text = "Head & line\nFirst text bold\nSecond one\nafter break\nThird"
    assert got[1, "https://H.example.com/a"].text == text
    assert got[2, "http://h.example.com:8/b"].text == text
    assert got[1, "https://H.example.com/a"].path == "/body/div.post.post-0"
    assert got[3, None].text == "" and got[4, "x"].text == "" and got[5, "http://h.example.com/c"].text == "bare text"
    assert got[None, "http://o/"].text == "plain & simple < 3"
    assert html_paths.extract_pages(pages).count() == 7 and html_paths.extract_pages(pages.limit(0)).count() == 0


def test_labels_take_no_article_text():
    text = "main text of the page " * 20
    for label in ("site-content has-sidebar", "no-sidebar", "sidebar-right", "sidebar", "page_wrap widget"):
        page = f"<body><div class='{label}'><article><h1>Top</h1><p>{text}</p></article></div><div class='ad'>Buy</div></body>"
        assert html_paths.extract(page, [])[0] == f"Top\n{text.strip()}"
    page = (f"<article><p>{text}</p><h2 id='side-effects'>Side effects</h2><section id='related-work'><p>work</p></section>"
            "<div id=legal-history class=section><p>law</p></div><h2 id=search-algorithms>Search</h2><h3 id=toc>Toc</h3>"
            "<div class='related-posts'><article>other</article></div><div class='comment-list'>said</div>"
            "<p>in <span class='share-buttons'>tweet</span> line</p><div id='ad-300x250'>Buy <a>me</a></div></article>")
    assert html_paths.extract(page, [])[0].split("\n")[1:] == ["Side effects", "work", "law", "Search", "Toc", "in line"]
    assert html_paths.extract(f"<div class=ad>{text}</div><article><p>short</article>", [])[0] == "short"


def test_host_vote_beats_a_misleading_page(spark):
    good = "<body><div class=story><p>" + "main text " * 30 + "</p></div><div class=box><p>short</p></div></body>"
    odd = "<body><div class=story><p>few words</p></div><div class=box><p>" + "other stuff " * 30 + "</p></div></body>"
    pages = spark.createDataFrame([(i, "http://a.b/x", good if i else odd) for i in range(5)],
                                  "page_id long, url string, html string")
    got = {r.id: r.text for r in html_paths.extract_pages(pages).collect()}
    assert got[0] == "few words" and got[1].startswith("main text")


# ---- classifier

def test_classifier(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(400):
        bad, mean = i % 4 == 0, i % 5 == 0
        w = prose(i, 30).split()
        if bad:
            w = [x.upper() + "!!" for x in w]
        if mean:
            w[5:5] = [rng.choice(["vile", "nasty"]), "vile"]
        rows.append((i, " ".join(w)))
        labels.append((i, int(not bad), int(mean)))
    docs = frame(spark, rows + [(None, None), (900, ""), (901, "z" * 30000)])
    table = spark.createDataFrame(labels[:300] + [(None, 1, 0), (5000, 1, 0), (7, None, 0)],
                                  "doc_id long, quality int, toxic int")
    models = cotrain.train(docs, table, ["quality", "toxic"], labelled_rows=280)
    got = {r.id: r.keep for r in cotrain.classify(docs, models, catalog.WANT).collect()}
    truth = {i: q == 1 and t == 0 for i, q, t in labels}
    held = [i for i in truth if i >= 300]
    assert len(got) == 403 and sum(got[i] == truth[i] for i in held) >= 0.95 * len(held)
    kept = cotrain.keep_good(docs, models, catalog.WANT)
    assert kept.columns == docs.columns and kept.count() == sum(got.values())


def test_classifier_does_not_depend_on_layout(spark):
    """Conflicting labels, repeated ids and other partitions give the same models."""
    texts = [(i, ("fine words here " if i % 3 else "BAD!! WORDS ") + prose(i, 12)) for i in range(200)]
    docs = frame(spark, texts + [(5, "another text of id 5"), (5, None), (None, "no id")] * 3)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(120)] + [(i, 0, 1) for i in range(0, 120, 9)],
                                   "doc_id long, quality int, toxic int")
    a = cotrain.train(docs, labels, ["quality", "toxic"])
    b = cotrain.train(docs.repartition(7, "text"), labels.repartition(5, "quality"), ["quality", "toxic"])
    for t in a:
        assert all(np.array_equal(x, y) for x, y in zip(a[t], b[t]))


def test_classifier_exchange_sums_all_rows(spark):
    """The lessons against sums over all rows made in one place."""
    docs = frame(spark, ODD + [(i, prose(i, 9) + "!" * (i % 7)) for i in range(90)])
    rows = docs.select(F.xxhash64("doc_id").alias("h"), "text", F.col("source"))
    rng = np.random.default_rng(5)
    weights = {"q": [rng.normal(0, 9, cotrain.CONTENT + 1), rng.normal(0, 9, cotrain.META + 1)]}
    got = cotrain.exchange(rows.repartition(5), weights, ["source"], confident=0.9, groups=3)["q"]
    table = rows.toArrow().combine_chunks()
    content, stats = cotrain.content_view(table.column("text").combine_chunks())
    views = content, cotrain.meta_view(stats, {"source": table.column("source").to_pylist()})
    part = table.column("h").to_numpy() % 3
    for giver, lesson in ((0, got[1]), (1, got[0])):
        p = 1 / (1 + np.exp(-np.clip(views[giver].times(weights["q"][giver]) + weights["q"][giver][-1], -30, 30)))
        want = {}
        for r in range(len(part)):
            if max(p[r], 1 - p[r]) >= 0.9:
                want.setdefault((int(p[r] >= 0.5), part[r]), []).append(r)
        assert [int(n) for n in lesson.rows] == [len(want[k]) for k in sorted(want)] and len(want) > 2
        for line, k in enumerate(sorted(want)):
            x = views[1 - giver].pick(np.array(want[k]))
            mean = np.bincount(x.index, x.value, minlength=cotrain.CONTENT) / len(want[k])
            mine = lesson.x.pick(np.array([line]))
            dense = np.bincount(mine.index, mine.value, minlength=cotrain.CONTENT)
            assert lesson.y[line] == k[0] and np.abs(mean - dense).max() < 1e-5


def test_classifier_without_labels(spark):
    docs = frame(spark, ODD)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    models = cotrain.train(docs, none, ["quality"])
    assert cotrain.keep_good(docs, models, {"quality": 1}).count() == len(ODD)
    assert cotrain.classify(docs.limit(0), models, {"quality": 1}).count() == 0


# ---- fixity

def test_fixity(spark):
    schema = "page_id long, url string, html string, slot string"
    rows = [(i, f"u{i}", f"body é {i}", "c") for i in range(5000)] + [(None, None, None, "c"), (7, "u7", "twice", "c")]
    a = spark.createDataFrame(rows, schema)
    b = [(i, u, h + "!" if i in (0, 4097) else h, s) for i, u, h, s in rows if i != 300] + [(9999, "u", "x", "c"), rows[5]]
    body = merkle.warc_record(F.col("url"), F.col("page_id"), F.col("html"))
    got = merkle.audit(a, spark.createDataFrame(b, schema), "page_id", body, body).collect()
    assert {(r.slot, r.status) for r in got} == {(0, "corrupt"), (4097, "corrupt"), (300, "missing"), (9999, "extra"),
                                                 (5, "repeated")}

    def record(i):
        data = f"body é {i}".encode()
        return (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: u{i}\r\nWARC-Record-ID: <urn:record:{i}>\r\n"
                f"Content-Length: {len(data)}\r\n\r\n").encode() + data + b"\r\n\r\n"

    at = {r.slot: r for r in got}
    assert (at[0].start, at[0].stop) == (0, len(record(0))) and at[4097].file == 1
    assert at[4097].start == len(record(4096)) and at[4097].sha256 == hashlib.sha256(record(4097)).hexdigest()
    assert merkle.audit(a, a, "page_id", body, body).count() == 0
    assert merkle.audit(a.limit(0), a.limit(0), "page_id", body, body).count() == 0


# ---- decontamination

def edit_distance(item, text):
    """Fewest edits of item against any part of text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        old, row = row, [i]
        for j, d in enumerate(text, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (c != d)))
    return min(row)


def test_decontamination_against_brute_force(spark):
    rng = random.Random(8)
    items = [(i, prose(700 + i, 18)) for i in range(4)] + [(9, None), (10, "short"), (None, prose(720, 20))]
    texts = list(ODD)
    for n in range(40):
        i, item = items[n % 4]
        chars = list(item)
        for _ in range(rng.randrange(0, 9)):
            at = rng.randrange(len(chars))
            chars[at:at + 1] = rng.choice([[], ["~"], [chars[at], "~"]])
        texts.append((100 + n, f"{prose(n, 20)} {''.join(chars).upper() if n % 3 else ''.join(chars)}  {prose(n + 50, 20)}"))
    texts.append((300, "before " + items[-1][1].replace(" ", "\n ") + " after"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, texts)
    got = {(r.id, r.item_id): r for r in decontam.contaminated(docs, bench).collect()}
    low = lambda t: re.sub(rb"[ \t\n\v\f\r]+", b" ", bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()))
    want = {}
    for d, t in texts[len(ODD):]:
        for i, item in items:
            if item and len(item) > 20:
                e = edit_distance(low(item), low(t))
                if e <= int(len(low(item)) * decontam.EDIT_SHARE):
                    want[d, -1 if i is None else i] = e
    assert {k: r.edits for k, r in got.items()} == want and len(want) > 10
    r = got[300, -1]
    assert dict(texts)[300][r.start:r.stop].split() == items[-1][1].split()
    kept = decontam.decontaminate(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(texts) - len({d for d, _ in want})
    assert decontam.contaminated(docs, bench.limit(0)).count() == 0


def test_decontamination_folds_all_letters(spark):
    items = [(1, "Où étaient les élèves âgés, près de la forêt où le maître a prêté ses cahiers?"),
             (2, "съешь же ещё этих мягких французских булок, да выпей чаю"),
             (3, "ο γρήγορος σκύλος πηδάει πάνω από τους τεμπέληδες λύκους"),
             (4, "die große Straße führt über weiße Brücken außen am Schloß vorbei"),
             (5, "ⱥ and ⱦ with ⱥ or ⱦ in a line of plain words")]
    texts = [(10 * i, f"Å before {t.upper()} after é") for i, t in items]
    texts += [(10 * i + 1, f"ẞ K İ {t.swapcase()}") for i, t in items] + [(99, "no such passage, ÀÉÎ " * 9)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.id: r for r in decontam.contaminated(frame(spark, texts), bench).collect()}
    assert {d: (r.item_id, r.edits) for d, r in got.items()} == {d: (d // 10, 0) for d, _ in texts if d < 99}
    for d, t in texts[:-1]:
        assert t[got[d].start:got[d].stop].casefold() == dict(items)[d // 10].casefold()
    assert [r.doc_id for r in decontam.decontaminate(frame(spark, texts), bench).collect()] == [99]


def test_decontamination_of_every_length_against_brute_force(spark):
    """Items of 2 to 63 bytes: the full 5 % of edits at each, short ones as whole words."""
    rng = random.Random(12)
    some = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    items = [(n, " ".join(f"x{some(n - 2)}y".split())) for n in range(2, 64)] + [(100, "what is 2+2?"), (101, " \n"), (102, "é")]
    texts = [(0, "so What  is 2+2? yes"), (1, "somewhat is 2+2?"), (2, "café"), (3, "caf É"), (4, items[0][1]), (5, None)]
    for n in range(10, 160):
        chars = list(rng.choice(items[:62])[1])
        for _ in range(rng.randrange(0, 5)):
            at = rng.randrange(len(chars))
            chars[at:at + 1] = rng.choice([[], ["q"], [chars[at], "q"]])
        texts.append((n, rng.choice(["", some(12) + " ", some(12)]) + "".join(chars) + rng.choice(["", " " + some(12), some(12)])))
    flat = lambda t: " ".join((t or "").lower().split())
    want = {}
    for d, t in texts:
        for i, item in items:
            item = flat(item)
            if len(item.encode()) < decontam.Q:
                edge = [r"(?<!\w)" if item[:1].isalnum() else "", r"(?!\w)" if item[-1:].isalnum() else ""]
                if item and re.search(edge[0] + re.escape(item) + edge[1], flat(t)):
                    want[d, i] = 0
            elif (e := edit_distance(item, flat(t))) <= int(len(item) * decontam.EDIT_SHARE):
                want[d, i] = e
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.id, r.item_id): r.edits for r in decontam.contaminated(frame(spark, texts), bench).collect()}
    assert got == want and {(0, 100), (3, 102)} <= set(want) and not {(1, 100), (2, 102)} & set(want)
    assert {i for _, i in want} & set(range(2, 14)) and {e for e in want.values()} >= {0, 1, 2}


def test_alignment_of_a_long_item():
    rng = random.Random(13)
    item = "".join(rng.choice("abcdefgh") for _ in range(100_000))
    chars = list(item)
    for at in rng.sample(range(0, 100_000, 50), 300):
        chars[at] = "z"
    index = decontam.Index([(1, item.encode())])
    text = "".join(rng.choice("abcdefgh") for _ in range(30_000))
    got = decontam.find(index, pa.array([text, text + "".join(chars) + text]))
    assert [(g[0], g[2]) for g in got] == [(1, 300)] and abs(got[0][3] - 30_000) < 50


def test_benchmark_in_blocks(spark):
    items = spark.createDataFrame([(i, prose(800 + i, 20)) for i in range(6)], "item_id long, text string")
    assert sum(len(x.items) for x in decontam.indexes(items, limit=100)) == 6
    assert len(decontam.indexes(items, limit=100)) > 1


# ---- language identification

def test_language_id(spark):
    said = {"en": ["the", "and", "with", "house", "thing"], "fr": ["le", "une", "avec", "maison", "chose"],
            "xx": ["ßa", "öl", "ünd", "äpf", "zug"]}
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(said[lang]) for _ in range(20)), lang, "c")
            for i, lang in enumerate(list(said) * 40)]
    docs = spark.createDataFrame(rows + [(900, None, "en", "c"), (901, "", "fr", "c"), (902, "12 34 !!", "en", "c"),
                                         (903, "maison avec le", None, "c"), (903, "maison avec le", None, "c")],
                                 "doc_id long, text string, lang string, score string")
    model = langid.learn(docs.where("doc_id % 4 <> 2"), "text", "lang")
    got = langid.identify(docs, "doc_id", "text", model).collect()
    by = {r.id: r for r in got}
    assert model[0] == ["en", "fr", "xx"] and len(got) == len(rows) + 5
    assert all(by[i].lang_pred == lang for i, _, lang, _ in rows if i % 4 == 2)
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (900, 901, 902)) and by[903].lang_pred == "fr"
    assert all(0 <= r.score <= 1 for r in got)
    nothing = langid.learn(docs.limit(0), "text", "lang")
    assert langid.identify(docs, "doc_id", "text", nothing).where("lang_pred <> 'und'").count() == 0


def test_language_sample_counts_no_copies_and_spares_rare_languages(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") < 3, "rare").when(F.col("id") % 2 == 0, "a").otherwise("b").alias("lang"),
        F.concat(F.lit("t"), (F.col("id") % 3000).cast("string")).alias("text")).withColumn("h", F.xxhash64("text", "lang"))
    got = {r.lang: (r.n, r.d) for r in common.sample_each(rows, "lang", "h", 1003).groupBy("lang").agg(
        F.count("*").alias("n"), F.countDistinct("h").alias("d")).collect()}
    assert got == {"a": (492, 492), "b": (492, 492), "rare": (3, 3)}
    assert common.sample_each(rows, "lang", "h", 10**6).count() == 3003
    assert common.sample_each(rows.limit(0), "lang", "h", 10).count() == 0
    docs = spark.createDataFrame([(None, None, None)], "doc_id long, text string, lang string").limit(0)
    assert langid.identify(docs, "doc_id", "text", (["en"], np.zeros((1, langid.CELLS), np.uint64))).count() == 0


def test_language_filters_hold_many_languages(spark):
    rows = [(f"l{i:03d}", " ".join(f"{chr(0x4E00 + 40 * i + j)}{chr(0x4E00 + 40 * i + j + 1)}" for j in range(20)))
            for i in range(70) for _ in range(2)]
    docs = spark.createDataFrame([(n, t, lang) for n, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    model = langid.learn(docs, "text", "lang")
    assert model[1].shape[0] == 2
    got = {r.id: r.lang_pred for r in langid.identify(docs, "doc_id", "text", model).collect()}
    assert got == {n: lang for n, (lang, _) in enumerate(rows)}


# ---- exact top-k

def brute_top(rows, k=5):
    ok = [(i, tuple(np.floor(np.array(v, float) * 256).astype(int).tolist())) for i, v in rows
          if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all()]
    out = []
    for q, v in sorted(set(ok)):
        if q % 50 == 0:
            best = sorted((-sum(x * y for x, y in zip(v, w)), i) for i, w in ok if i != q)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return out


@pytest.mark.parametrize("n, tree_rows", [(400, 40), (400, 5000), (3, 2048), (0, 2048)])
def test_top_k(spark, n, tree_rows):
    rng = np.random.default_rng(n)
    rows = [(i, [float(x) for x in rng.normal(size=8) * (1 + i % 3)]) for i in range(n)]
    if n > 100:
        rows += [(1000 + i, rows[7][1]) for i in range(80)]                        # a large group of equal vectors
        rows += [(2000, None), (2001, [1.0, None]), (2050, [float("nan")] * 8), (None, [1.0] * 8), (2100, [float("inf")] * 8),
                 (2150, [0.5, 0.25]), rows[3], rows[50], *[rows[9]] * 30]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, label int")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got = mtree.top_k(table, tree_rows=tree_rows, query_rows=5)
    assert key([tuple(r) for r in got.collect()]) == key(brute_top(rows))


# ---- mixing

def test_targets_by_hand(spark):
    sizes = spark.createDataFrame([("a", 100, 5), ("b", 10, 5), ("c", 40, 5), (None, 50, 5)],
                                  "source string, source_size long, docs long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    # weights 1, 2, 3, 1; b stops at 30, the rest shares 170 by 1, 3, 1
    assert got == {"a": 34.0, "b": 30.0, "c": 102.0, None: 34.0}


def test_mixing(spark):
    rng = random.Random(6)
    texts = [(i, prose(i, rng.randrange(0, 60))) for i in range(600)] + ODD + [(700, prose(9, 30))] * 40
    docs = frame(spark, texts)
    run = lambda: sorted(map(str, mixing.mix_sources(docs, chunk=16, fanout=4).collect()))
    got = mixing.mix_sources(docs, chunk=16, fanout=4).toPandas()
    assert len(got) == len(texts) and (got["copies"] <= 3).all() and (got["taken"] == got["copies"] * got["size"]).all()
    assert sorted(got["size"]) == sorted(len(WORD.findall(t or "")) for _, t in texts)
    for _, part in got.fillna({"source": "~"}).groupby("source"):
        assert abs(part["taken"].sum() - part["target"].iloc[0]) <= part["size"].max()
    assert abs(got.groupby("source", dropna=False)["target"].first().sum() - got["size"].sum()) < 1e-6
    assert run() == run()
    rows = mixing.mixed_rows(docs, mixing.mix_sources(docs, chunk=16, fanout=4))
    assert rows.columns == docs.columns + ["copies"]
    assert rows.agg(F.sum("copies")).first()[0] == got["copies"].sum()
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_equal_rows_are_one_set(spark, monkeypatch):
    """3000 equal rows of one document with one near copy: the task that
    compares them gets at most one set of either from each partition."""
    text = prose(4, 200)
    docs = spark.createDataFrame([(1, text)] * 3000 + [(2, text + " more"), (3, prose(5, 80))], "doc_id long, text string").repartition(6)
    seen, join = [], jaccard._join_tries

    def counted(percent):
        run = join(percent)
        sets = spark.sparkContext.accumulator(0)
        seen.append(sets)

        def counting(batches):
            def each():
                for batch in batches:
                    sets.add(batch.num_rows)
                    yield batch
            yield from run(each())
        return counting

    monkeypatch.setattr(jaccard, "_join_tries", counted)
    found = jaccard.jaccard_components(docs)
    assert found.where("component = 1").count() == 3001 and found.where("component = 3").count() == 1
    assert seen[0].value <= 2 * (6 + 1)                     # six partitions; checkpoint() runs a job twice


def test_mixed_rows_follow_the_source(spark):
    """One (id, text) in two sources: copies go to the source they were decided
    for, in either order of the rows, and reruns agree; rows that differ in
    other columns and equal rows share theirs; a column ``copies`` is replaced."""
    rows = [(1, "one two three four", s, lang, 7) for s, lang in [("s1", "en"), ("s2", "en"), ("s2", "de"), *[("s3", "fr")] * 50]]
    rows += [(i, f"w{i} " * (i % 9 + 1), f"s{i % 3 + 1}", "en", 7) for i in range(2, 60)]
    schema = "doc_id long, text string, source string, lang string, copies int"
    seen = set()
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, schema).repartition(3)
        decided = mixing.mix_sources(docs, chunk=8, fanout=4)
        got = mixing.mixed_rows(docs, decided)
        assert got.columns == ["doc_id", "text", "source", "lang", "copies"]
        taken = got.groupBy("doc_id", "source").agg(F.sum("copies").alias("n")).collect()
        want = decided.groupBy("id", "source").agg(F.sum("copies").alias("n")).where("n > 0").collect()
        assert {(r.doc_id, r.source): r.n for r in taken} == {(r.id, r.source): r.n for r in want}
        seen.add(tuple(sorted(map(str, got.collect()))))
        assert got.where("copies < 1 OR copies > 3").count() == 0
    assert len(seen) == 1


def test_mix_targets_by_sql(spark):
    """Sizes, source sizes and targets of the mix against DuckDB."""
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = con.sql(r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT source, sum(size) AS total, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM d GROUP BY source)
SELECT source, total, w FROM s ORDER BY source NULLS LAST""").fetchall()
    whole, left, target = sum(t for _, t, _ in want), {s: (t, w) for s, t, w in want}, {}
    rest = float(whole)
    while left:                                             # stop full sources, share the excess anew
        share = {s: rest * w / sum(w for _, w in left.values()) for s, (_, w) in left.items()}
        full = {s for s, (t, _) in left.items() if share[s] > 3 * t}
        target.update({s: 3.0 * left[s][0] for s in full} if full else share)
        rest -= sum(3 * left[s][0] for s in full)
        left = {s: x for s, x in left.items() if s in full} and {s: x for s, x in left.items() if s not in full} if full else {}
    got = catalog.op10_source_mixing(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source"), "doc_id")
    rows = got.groupBy("source").agg(F.first("target").alias("t"), F.first("source_size").alias("n"), F.sum("taken").alias("taken")).collect()
    assert {r.source: r.n for r in rows} == {s: t for s, t, _ in want}
    for r in rows:
        assert abs(r.t - target[r.source]) < 1e-6 * max(1, r.t) and r.taken <= 3 * r.n


def test_empty_tables(spark):
    docs = frame(spark, ODD).limit(0)
    assert secrets.scan_secrets(docs).count() == 0
    assert jaccard.jaccard_components(docs).count() == 0
    assert substring.remove_repeats(docs).count() == 0
    assert decontam.contaminated(docs, spark.createDataFrame([(1, prose(1, 20))], "item_id long, text string")).count() == 0


def test_held_out_rule(spark):
    got = {r.doc_id: r.h for r in spark.range(50).select(F.col("id").alias("doc_id")).select(
        "doc_id", catalog._held_out().alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(50)}
