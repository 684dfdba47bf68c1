"""Tokens, packing, language, language model, pages and urls."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tellerflow.llm import html, language, lm, packing, queries, tokens, urls

SF_DIR = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "\n\n  x", "it's we'll THEY'RE", "a<|endoftext|>b <|endoftext|>", "naïve café — ß ΑΣ",
    "日本語 テキスト", "e\u0301 \u00a0x\u2003y", "\x1c\x1d tab\x85", "ſ K İ", "🙂🙂 ok", "x" * 3000, "12345 6,7",
    "<|STARTOFTEXT|> a", "\u0301lead", "a\x00b", "word " * 3000,
]


@pytest.fixture
def texts(docs):
    return docs(*enumerate(ODD), (None, "no id"), (3, "again and once more"))


def test_token_counts_equal_the_library(texts):
    path = queries.tokenizer_path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    for r in tokens.count_tokens(texts, path).join(texts, "doc_id").filter("doc_id <> 3").collect():
        want = len(own.encode(r.text or "", add_special_tokens=False).ids)
        assert (r.n_tokens, r.over_limit, r.n_bytes) == (
            want, want > 1024, len((r.text or "").encode())), repr(r.text)[:50]
    assert tokens.count_tokens(texts.limit(0), path).count() == 0


def check_pieces(rows, sources, length):
    """Every document in order and whole, every sequence gapless; returns sequence lengths."""
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        of_sequence[r.sequence_id].append(r)
        of_doc[r.doc_id, r.doc_tokens].append(r)
        assert r.length == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(bytes(r.ids))
    for doc, ids in sources:
        at = 0
        for r in sorted(of_doc[doc, len(ids)], key=lambda r: r.start):
            assert r.start == at and np.frombuffer(bytes(r.ids), "<u4").tolist() == ids[at : at + r.length]
            at += r.length
        assert at == len(ids)
    used = []
    for pieces in of_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        used.append(at)
        assert at <= length
    return used


@pytest.mark.parametrize("windows,parts", [(1, 1), (4, 3), (32, 7)])
def test_packing_round_trip(texts, windows, parts):
    path = queries.tokenizer_path("word_bpe_49k.json")
    own = Tokenizer.from_file(path)
    rows = packing.pack(texts.repartition(parts), path, length=256, open_windows=windows).collect()
    sources = [
        (r.doc_id, [*own.encode(r.text or "", add_special_tokens=False).ids, 1])
        for r in texts.collect()
    ]
    used = check_pieces(rows, sources, 256)
    assert sum(used) == sum(len(ids) for _, ids in sources)
    assert all(n & (n - 1) == 0 for n in used)  # no padding at all
    assert packing.pack(texts.limit(0), path).count() == 0


def test_language_on_held_out_documents(spark):
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    found = queries.op6_language_id(spark, "/root/testdata/sf0.01").join(docs, "doc_id")
    held = found.filter("held_out").select("lang", "lang_pred", "score").collect()
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in held)


def test_language_of_odd_texts(spark, texts):
    rows = [("en", f"the cat and the dog number {i}") for i in range(60)]
    rows += [("de", f"der hund und die katze nummer {i}") for i in range(60)]
    rows += [(None, "nothing"), ("en", None), ("de", "")]
    model = language.fit(spark.createDataFrame(rows, "lang string, text string"))
    found = language.identify(texts, model)
    assert found.columns.count("score") == 1
    by = {r.text: (r.lang_pred, r.score) for r in found.collect()}
    assert by[None] == by[""] == by["12345 6,7"] == by[" "] == ("und", 0.0)
    assert {k for k, (lang, _) in by.items() if lang == "und"} == {None, "", " ", "12345 6,7"}
    assert model.predict("the dog") [0] == "en" and model.predict("die katze und der hund")[0] == "de"
    none = language.fit(spark.createDataFrame([], "lang string, text string"))
    assert {r.lang_pred for r in language.identify(texts, none).collect()} == {"und"}


def test_bucket_counts_do_not_depend_on_chunks(monkeypatch):
    text = "".join(random.Random(1).choices("abc dé", k=500))
    whole = Counter(x for b in language._buckets(text) for x in b.tolist())
    monkeypatch.setattr(language, "CHUNK", 37)
    assert Counter(x for b in language._buckets(text) for x in b.tolist()) == whole


def kneser_ney(train, order):
    """The same model of any order in plain Python: split(text), counts of words, p(context, word)."""

    def split(t):
        return [*(t or "").encode().lower().split(), None]

    words, counts = Counter(), [None] * (order + 1)
    counts[order] = Counter()
    for t in train:
        w = split(t)
        words.update(w)
        padded = [0] * (order - 1) + w
        counts[order].update(tuple(padded[i : i + order]) for i in range(len(w)))
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    cuts, total, rest = [None], Counter(), Counter()
    for n in range(1, order + 1):
        d = lm._discounts([sum(c == k for c in counts[n].values()) for k in (1, 2, 3, 4)])
        cuts.append(d)
        for g, c in counts[n].items():
            total[g[:-1]] += c
            rest[g[:-1]] += d[min(c, 3)]

    def p(context, word):
        low = 1 / (len(words) + 1)
        for n in range(1, order + 1):
            before = tuple(context[len(context) - n + 1 :])
            if total[before]:
                c = counts[n][(*before, word)]
                low = (max(c - cuts[n][min(c, 3)], 0) + rest[before] * low) / total[before]
        return low

    return split, words, p


@pytest.mark.parametrize("order, shard_bytes", [(1, 10**6), (2, 10**6), (3, 10**6), (3, 600), (4, 600)])
def test_language_model_equals_the_formulas(spark, docs, order, shard_bytes):
    """Also with many ranges of the hash, over which hot words are divided."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    train = [" ".join(rng.choices(words, range(1, 61), k=rng.randrange(30))) for _ in range(200)]
    train += [train[0]] * 300 + ["w1 w2 " * 150, "", None]
    model = lm.fit(docs(*enumerate(train)).repartition(3), order=order, shard_bytes=shard_bytes)
    assert (model.hot.shape[1] > 1) == (shard_bytes == 600)
    split, counts, p = kneser_ney(train, order)
    n, v = sum(counts.values()), len(counts)
    test = [*train[:20], "W1 unknown w2 unknown unknown w3 w4", "", None, " ", "w59 " * 500, "w1 w2 w1 w2 w1"]
    found = lm.score_texts(model, docs(*enumerate(test))).orderBy("doc_id").collect()
    for r, text in zip(found, test, strict=True):
        w = split(text)
        padded = [0] * (order - 1) + w
        score = sum(math.log10(p(padded[i : i + order - 1], x)) for i, x in enumerate(w))
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(counts[x] > 0 for x in w), n)
        assert math.isclose(r.score, score, rel_tol=1e-9)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
    for context in ([0, 0, 0], [0, 0, b"w1"], [b"w1", b"w2", b"w1"], [b"w59"] * 3, [b"never", b"w1", b"w2"]):
        context = context[4 - order :] if order > 1 else []
        assert math.isclose(sum(p(context, b) for b in counts) + p(context, b"new"), 1, rel_tol=1e-9)


def test_language_model_of_one_text(spark, docs):
    model = lm.fit(docs((1, "a b")))
    split, _, p = kneser_ney(["a b"], 3)
    w = [0, 0, *split("a b")]
    want = sum(math.log10(p(w[i : i + 2], w[i + 2])) for i in range(3))
    assert math.isclose(lm.score_texts(model, docs((1, "a b"))).first().score, want, rel_tol=1e-9)


def test_language_model_of_nothing(spark, docs):
    model = lm.fit(docs())
    r = lm.score_texts(model, docs((None, "a b"))).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0, 0)
    assert lm.score_texts(model, docs()).count() == 0


def test_columns_pack_and_are_found():
    rng = np.random.default_rng(0)
    x = [np.sort(rng.integers(0, 2**63, 1000, dtype=np.uint64)), rng.integers(0, 300, 1000, dtype=np.uint64)]
    for a, b in zip(lm._unpack(lm._pack(x), 2), x, strict=True):
        assert (a == b).all()
    for n in (1, 7, 16, 1000):
        order, ends, low = lm._index(x[0][:n] * np.uint64(2) + np.uint64(1))
        hit, at = lm._find(ends, low, x[0] * np.uint64(2) + np.uint64(1))
        assert hit.tolist() == list(range(n)) and (order[at] == hit).all()


def test_rows_of_many_large_numbers_keep_their_order():
    rng = np.random.default_rng(1)
    columns = [rng.integers(0, 1 << 40, 500) // (1 << 36) for _ in range(3)]
    key = lm._key(columns, 1 << 40)
    rows = list(zip(*(c.tolist() for c in columns)))
    assert sorted(range(500), key=lambda i: (key[i], i)) == sorted(range(500), key=lambda i: (rows[i], i))


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href="/a">Home page</a></li><li>News and more</li></ul></nav>
<div class="ad">Buy now very cheap things</div><article><h1>Big &amp; small</h1>
<p>First <b>bold paragraph with several words<br>and a&nbsp;break &lt;here&gt;.<p>Second paragraph,
unclosed &copy and quite long enough.<script>var t="</p>";</script>
<aside>Related: other things</aside><form><label>Name</label></form>
<ul><li>Point one with all the words that a longer list may have</li><li>Point two</li></ul></article>
<div class="comments"><p>Nice article, I like it a lot, thanks</p></div>
<footer>&copy; site and some words of law</footer></body></html>"""
WANT = ("Big & small\n\nFirst bold paragraph with several words and a break <here>.\n\n"
        "Second paragraph, unclosed © and quite long enough.\n\nPoint one with all the words that a longer list may have\n\nPoint two")


def test_main_text(spark):
    pages = spark.createDataFrame(
        [(i, "u", p) for i, p in enumerate([PAGE] * 3 + [
            PAGE.replace("article>", "div>"), None, "", "plain words only here", "<p>cut <b", "<!-- x",
            "<nav>only menu words</nav>"])] + [(None, None, PAGE)],
        "page_id long, url string, html string",
    ).withColumn("text", F.lit("clash"))
    learned = html.extract(pages, html.fit(pages)).collect()
    texts = {r.page_id: r.text for r in learned}
    assert texts[0] == texts[3] == texts[None] == WANT
    assert (texts[4], texts[5], texts[6], texts[8], texts[9]) == ("", "", "plain words only here", "", "")
    assert all(r.n_chars == len(r.text) for r in learned)
    assert html.extract(pages.limit(0), html.fit(pages.limit(0))).count() == 0


def test_every_test_page_gives_its_article(spark):
    found = queries.op9_html_extract(spark, SF_DIR).collect()
    pages = {r.page_id: r.html for r in queries.table(spark, SF_DIR, "pages").collect()}
    for r in found:
        inner = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        for tag in ("</p>", "<p>", "<h1>", "</h1>"):
            inner = inner.replace(tag, "\0")
        for tag in ("<b>", "<br>"):
            inner = inner.replace(tag, " " if tag == "<br>" else "")
        blocks = [" ".join(html.html.unescape(b).split()) for b in inner.split("\0")]
        assert r.text == "\n\n".join(b for b in blocks if b)


def test_long_asides_and_lists_lose_no_article_text(spark):
    """Asides longer than the lead and the ending, and lists that mostly stand outside articles."""
    aside = "<aside><p>" + "advert words " * 60 + "</p></aside>"
    links = "<ul>" + "<li>link with words</li>" * 12 + "</ul>"
    page = (f"{links}<article><p>A short lead of six words.</p>{aside}<p>" + "body " * 50 + "</p>"
            f"<ul><li>One inner point</li></ul><p>" + "more " * 20 + f"</p>{aside}"
            f"<p>A short ending.</p></article>{links}")
    df = spark.createDataFrame([(i, "u", page) for i in range(20)],
                               "page_id long, url string, html string")
    weights = html.fit(df)
    assert weights.words["+li"] < 0
    want = ["A short lead of six words.", ("body " * 50).strip(), "One inner point",
            ("more " * 20).strip(), "A short ending."]
    for w in (weights, html.Weights(words={"+li": -1.0})):
        assert html.main_text(page, w) == "\n\n".join(want)


BODY = "".join(f"<p>Paragraph {i} " + "of the article with words " * 3 + "</p>" for i in range(4))
LINKS = "<div class='menu'><a href='/'>Home</a> <a href='/x'>Other</a></div>"


@pytest.mark.parametrize("before, after", [
    ('<body class="single right-sidebar">', "</body>"),
    ('<body class="no-js cookies-set sidebar">', "</body>"),
    ('<div class="content with-sidebar"><article>', "</article></div>"),
    ('<div class="content with-sidebar">', "</div>"),
    ('<article class="post comments-open">', "</article>"),
    ('<form id="aspnetForm"><main>', "</main></form>"),
    ('<form id="aspnetForm">', "</form>"),
    ('<div class="widget"><main>', "</main></div>"),
    ('<div id="menu-page"><section>', "</section></div>"),
])
def test_a_container_named_after_an_aside_is_none(before, after):
    want = html.main_text(f"<article>{BODY}</article>", html.Weights())
    assert want.count("\n\n") == 3
    assert html.main_text(f"{LINKS}{before}{BODY}{after}{LINKS}", html.Weights()) == want


@pytest.mark.parametrize("aside", [
    '<div class="sidebar">{}</div>', '<div class="right-sidebar">{}</div>', '<div id="cookie-banner">{}</div>',
    '<ol class="comment-list"><li><article class="comment">{}</article></li></ol>',
    '<section id="comments"><article class="comment-body comment">{}</article></section>',
    '<form>{}</form>', '<div role="alert">{}</div>', '<div class="box ad">{}</div>', '<aside>{}</aside>',
    '<div class="related-posts">{}</div>', '<footer>{}</footer>', '<dialog>{}</dialog>',
])
def test_real_asides_go(aside):
    aside = aside.format("<p>nothing of the article but some other words</p>")
    want = html.main_text(f"<article>{BODY}</article>", html.Weights())
    for page in (f"<article>{BODY}</article>{aside}", f"{aside}<main>{BODY}</main>",
                 f"<article>{BODY}{aside}</article>", f"<div>{BODY}{aside}</div>"):
        assert html.main_text(f"<body>{page}</body>", html.Weights()) == want, page


def test_short_leads_and_endings_stay():
    figures = '<figure><img src="a"><figcaption></figcaption></figure>' * 4
    for tag in ("article", "main", "div"):
        page = f"<{tag}><p>A lead of just six words.</p>{figures}{BODY}</{tag}>"
        assert html.main_text(page, html.Weights()).startswith("A lead of just six words.\n\n"), tag
    page = "<article><p>alpha beta gamma delta</p><p>one two three</p><p>epsilon</p></article>"
    for weights in (html.Weights(), html.Weights(tags={"p": -1.0, "/p": -1.0})):
        assert html.main_text(page, weights) == "alpha beta gamma delta\n\none two three\n\nepsilon"


def test_best_region_equals_all_regions():
    rng = np.random.default_rng(5)
    for _ in range(300):
        scores = rng.integers(-3, 4, rng.integers(1, 30)) / 2
        regions = [(scores[i : j + 1].sum(), j - i, -i, -j)
                   for i in range(len(scores)) for j in range(i, len(scores))]
        best = max(regions)
        want = None if best[0] <= 0 else (-best[2], -best[3])
        assert html.best_region(scores) == want
    assert html.best_region(np.array([])) is None


def test_host_path_and_rules(spark):
    cases = {
        None: ("", "", None), "": ("", "", None), "no scheme": ("", "", None),
        "http://A.Org/x?y=/z#f": ("a.org", "/x", "org/"), "http://a.org": ("a.org", "", None),
        "https://Example.org/es/1": ("example.org", "/es/1", "example.org/es/"),
        "http://m.example.org/en/12": ("m.example.org", "/en/12", "example.org/en/1"),
        "http://notexample.org/en/12": ("notexample.org", "/en/12", "org/"),
        "x://É.com/fr/": ("É.com", "/fr/", "com/fr/"), "http://com/de/x": ("com", "/de/x", "com/de/"),
        "http://h#a/b": ("h", "", None), "a://b://c/d": ("b:", "//c/d", None),
    }
    df = spark.createDataFrame([(i, u) for i, u in enumerate(cases)], "page_id long, url string")
    labelled = spark.createDataFrame([], "url string, bad boolean")
    df = df.selectExpr("*", "'x' AS host", "1 AS verdict")
    found = {r.page_id: r for r in urls.judge(df, queries.URL_RULES, labelled).collect()}
    verdicts = dict((rule, what) for what, rule in queries.URL_RULES) | {None: "allow"}
    for i, want in enumerate(cases.values()):
        assert (found[i].host, found[i].path, found[i].rule) == want
        assert found[i].verdict == verdicts[want[2]]
    assert urls.judge(df.limit(0), queries.URL_RULES, labelled).count() == 0


def test_impure_templates_are_rejected(spark):
    """Numbers become wildcards; the branch of bad labels is blocked, its siblings are not."""
    rows = [(i, f"http://h.net/{kind}/{i}") for i in range(400) for kind in ("news", "spam", "misc")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labelled = pages.filter("page_id < 100").select(
        "url", F.when(F.col("page_id") < 90, F.col("url").contains("spam")).alias("bad")
    )
    found = urls.judge(pages, [], labelled).groupBy("template", "verdict").count().collect()
    assert {(r.template, r.verdict, r["count"]) for r in found} == {
        ("/news/*", "allow", 400), ("/misc/*", "allow", 400), ("/spam/*", "block", 400)
    }


def test_small_and_deep_sections_of_a_large_host_have_branches(spark):
    """60 sections of a host, none with 2% of it, and two that differ in the eighth segment only."""
    rows = [(f"http://h.net/s{k}/{i}", k == 7) for k in range(60) for i in range(40)]
    rows += [(f"http://h.net/{i}/b/c/d/e/f/g/{kind}/{i}", kind == "x")
             for kind in "xy" for i in range(30)]
    labelled = spark.createDataFrame(rows, "url string, bad boolean")
    pages = labelled.selectExpr("monotonically_increasing_id() AS page_id", "url")
    found = urls.judge(pages, [], labelled).collect()
    bad = {url.removeprefix("http://h.net"): b for url, b in rows}
    assert len(found) == len(rows)
    assert all((r.verdict == "block") == bad[r.path] for r in found)


def test_hosts_paths_and_rules_of_all_pages_equal_plain_python(spark):
    """Every url of the pages and odd ones, by string methods alone."""
    given = [r.url for r in queries.table(spark, SF_DIR, "pages").select("url").collect()]
    given += [None, "", "no scheme/x", "http://", "HTTP://ExAmple.ORG/es/1?x=/en", "a://b.com#/fr/", "x://org",
              "x://sub.EXAMPLE.org/en/1", "x://notexample.org/en/1", "x://com/fr/y", "x://a.com/fr", "x://É.org/",
              "x://a.com?/fr/", "://net/a://b/c", "x://example.org/en/12"]

    def plain(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
        best = None
        for verdict, rule in queries.URL_RULES:
            name, _, tail = rule.partition("/")
            if (host == name or host.endswith("." + name)) and path.startswith("/" + tail):
                if best is None or len(rule) > len(best[1]):
                    best = (verdict, rule)
        return host, path, best[1] if best else None, best[0] if best else None

    pages = spark.createDataFrame(list(enumerate(given)), "page_id long, url string")
    none = spark.createDataFrame([], "url string, bad boolean")
    found = {r.page_id: r for r in urls.judge(pages, queries.URL_RULES, none).collect()}
    for i, url in enumerate(given):
        host, path, rule, verdict = plain(url)
        r = found[i]
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow"), url
