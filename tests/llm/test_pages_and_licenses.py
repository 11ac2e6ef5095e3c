"""Main text of pages and the license scan."""

import random
import re
from collections import defaultdict

import pytest

from ratelake.llm import licenses, templates
from ratelake.llm.templates import Page

PAGES = "page_id long, url string, html string"


def text(source, known=()):
    return Page(source).main_text(frozenset(known))


@pytest.mark.parametrize(
    "source, want",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a\n b<p>c<br>d</p>", "a b\n\nc d"),
        ("<nav>x</nav><article><h1>T</h1><p><b>one<br><p>two</article><footer>f</footer>", "T\n\none\n\ntwo"),
        ("<article><p>a<script>var t='</p>';</script>b</p><style>p{}</style></article>", "ab"),
        ("<article><p>cut &amp", "cut &"),
        ("<article><p>cut &am", "cut &am"),
        ("<article><p>cut <b", "cut"),
        ("<!-- <p>no</p> --><p>yes</p><!-- open <p>no", "yes"),
        ("<main><ul><li>one<li>two<ul><li>in</ul></ul><table><tr><td>a<td>b<tr><td>c</table></main>", "one\n\ntwo\n\nin\n\na\n\nb\n\nc"),
        ("<article><header><h1>T</h1></header><p>x</p><div class='user comments'><p>hi</p></div><form>f</form></article>", "T\n\nx"),
        ("<div class=sidebar>s<article><p>main</p></article>", "main"),
        ("<div id=\"cookie-notice\">c</div><div role=navigation>n</div><p>t</p><aside>a</aside>", "t"),
        ("<title>t</title><textarea>x</textarea><p title='a>b'>q</p>", "q"),
        ("<article><p>&lt;b&gt; &copy; &#233;&nbsp;x</p></article>", "<b> © é x"),
        ("</p></div><p>stray</p></article>", "stray"),
        ("<p class=\"unclosed>text</p><p>more</p>", "text\n\nmore"),
    ],
)
def test_main_text(source, want):
    assert text(source) == want


@pytest.mark.parametrize(
    "source, want",
    [
        ("<div class='content has-sidebar'><p>a</p></div><div class=x>b</div>", "a\n\nb"),
        ("<div class='no-sidebar'><p>a</p></div><div class='post comments-open'>b</div><div class=with-header>c</div>", "a\n\nb\n\nc"),
        ("<article><h1 class='entry-header'>T</h1><p>x</p></article>", "T\n\nx"),
        ("<article><div class='article-header'><h1>T</h1></div><p>x</p></article>", "T\n\nx"),
        ("<article><h1 class=header>T</h1><div class=header><h2>U</h2></div><p>x</p></article>", "T\n\nU\n\nx"),
        ("<article><p>x</p><section id=related-work>r</section><section id=search-methods>s</section><div class=share-prices>p</div></article>", "x\n\nr\n\ns\n\np"),
        ("<p data-id=search>a</p><blockquote cite='/q?id=related'>b</blockquote><p title=' class=ads '>c</p>", "a\n\nb\n\nc"),
        ("<div id=header><p>most of the text of this page</p><div class=ads>advert</div></div><p>rest</p>", "most of the text of this page\n\nrest"),
        ("<div id=header><p>one half</p></div><div class=widget><p>one half</p></div>", "one half\n\none half"),
        ("<p>short</p><div class=comments><p>much longer words of readers</p></div><div class=site-footer>f</div>", "short"),
        ("<p>words of the page</p><div class='sidebar-left x'>s</div><div id=comments-section>c</div><div id=ad_12>a</div>", "words of the page"),
        ("<p>" + "İ" * 9 + "a</p><SCRIPT>var x = '</scripty>';</Script ><p>b</p>", "İ" * 9 + "a\n\nb"),
    ],
)
def test_only_whole_names_of_parts_go(source, want):
    assert text(source) == want


@pytest.mark.parametrize(
    "source, want",
    [
        ("<article>Real text</article><div id='comments' class='comments-area'><article class='comment-body'>Reader says hi</article></div>", "Real text"),
        ("<main><h1>T</h1><p>Real text.</p><article class='comment'>Reader comment one</article></main>", "T\n\nReal text."),
        ("<article><p>Story</p></article><aside class='related'><article class='teaser'>Other story</article></aside>", "Story"),
        ("<article><p>Story</p><section id='disqus_thread'>Reader</section></article>", "Story"),
        ("<main><h1>Title</h1><p>The long text of this page itself.</p><article>See also</article></main>", "Title\n\nThe long text of this page itself.\n\nSee also"),
        ("<main><h1>Title</h1><article>The long text of this page itself.</article></main>", "The long text of this page itself."),
        ("<div class=sidebar>s<article><p>a</p></article><article><p>b</p></article>", "a\n\nb"),
        ("<div class=comments><p>hi<article>Reader</article></div><p>Own text</p>", "Own text"),
        ("<article class='post comments-open'><p>x</p><article class='comment'><p>y</p><article>z</article></article><p>w</p></article>", "x\n\nw"),
    ],
)
def test_articles_of_others_are_no_main_text(source, want):
    assert text(source) == want


def test_counts_equal_brute_force(spark):
    rng = random.Random(3)
    parts = [f"<div><p>part {i}</p></div>" for i in range(8)]
    rows = [
        (i, f"http://h{i % 3}.example/{i}", "<body>" + "".join(p for k, p in enumerate(parts) if rng.random() < 0.08 * (k + 1)) + f"<p>own {i % 50}</p></body>")
        for i in range(120)
    ]
    texts, holding = defaultdict(set), defaultdict(set)
    for _, url, source in rows:
        page, host = Page(source), templates.host_of(url)
        texts[host].add(page.main_text())
        for _, _, hashed in page.candidates():
            holding[host, hashed].add(page.main_text())
    want = {(h, s) for (h, s), on in holding.items() if len(on) >= 5 and len(on) >= 0.2 * len(texts[h])}
    made = spark.createDataFrame(rows, PAGES).repartition(4).mapInArrow(templates._subtrees, "page_id long, host string, subtree long, like long")
    assert {tuple(r) for r in templates.site_templates(made).collect()} == want and want


def test_long_and_deep_pages():
    assert text("<div>" * 20_000 + "x" + "</div>" * 20_000) == "x"
    assert len(text("<p>" + "word " * 400_000)) == 5 * 400_000 - 1
    assert text("<" * 50_000) == "<" * 50_000


def test_templates_of_a_site_go(spark, cluttered):
    box = "<div><p>Subscribe to our letter</p></div>"
    rows = [(i, f"https://A.example/{i}", f"<body><p>Own words {i}</p>{box}<p>Quoted often</p></body>") for i in range(30)]
    rows += [(100 + i, "http://b.example/", f"<article><p>Own {i}</p><p>Quoted often</p><section>In every article</section></article>") for i in range(12)]
    rows += [(200 + i, "http://c.example/", f"<body><p>Rare {i}</p>{box}</body>") for i in range(4)]
    rows += [(300 + i, "http://d.example/", "<body><p>The same page</p></body>") for i in range(50)]
    rows += [(None, None, None), (400, "http://[broken", "<p>x</p>"), (0, "https://a.example/0", rows[0][2])]
    df = cluttered(spark.createDataFrame(rows, PAGES))
    out = templates.extract(df).collect()
    assert len(out) == len(rows)
    got = {r.page_id: r.text for r in out}
    assert all(got[i] == f"Own words {i}" for i in range(30))
    assert all(got[100 + i] == f"Own {i}\n\nQuoted often" for i in range(12))
    assert got[200] == "Rare 0\n\nSubscribe to our letter"
    assert got[300] == "The same page" and got[None] == "" and got[400] == "x"
    assert templates.extract(df.limit(0)).count() == 0


def test_base_places_equal_brute_force(documents, cluttered):
    texts = [
        None,
        "",
        "MIT License",
        "the mit-license; MIT\nLICENSE mitlicense mit x license",
        "Apache License, Version 2.0. GNU General Public License, version 3. mit license",
        "general public license " * 500,
        "license mit license mit license",
        "Licensed under CC BY-NC 4.0.",
        "Ünder the Äpache license é",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction",
        "Permission is hereby granted to nobody, free of charge or not",
        "word " * 100_000 + "apache license",
    ]
    rows = list(enumerate(texts)) + [(2, texts[2]), (None, texts[2])]
    out = licenses.scan_licenses(cluttered(documents(*rows))).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out}
    for i, source in enumerate(texts):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), source or ""))
        found = [(k, label) for label, phrase in licenses.BASE_PHRASES for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
        r = by_id[i]
        assert (r.n_words, r.n_base) == (len(words), len(found))
        places = [k for k, _ in found]
        assert (r.first_word, r.last_word) == ((min(places), max(places)) if places else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in found}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
        assert 0 <= r.score <= 1
    assert by_id[4].labels == "apache,gpl,mit"
    assert by_id[7].labels == "cc-by-nc" and by_id[7].base_labels == ""
    assert by_id[9].labels == "mit" and by_id[10].labels == ""
    assert licenses.scan_licenses(documents((1, "a")).limit(0)).count() == 0


@pytest.mark.parametrize("template", licenses.TEMPLATES, ids=lambda t: t.text[:30])
def test_every_template_is_found_among_other_words(template):
    """Even where each of its words is as common as another, and with words put in."""
    words = template.text.split()
    index = licenses.Index({})
    for source in (template.text, "some words before " * 5 + template.text.upper() + " and after", " ".join([*words[: len(words) // 2], *words[len(words) // 2 :]])):
        assert template.label in index.scan(source)["labels"].split(",")
    assert index.scan(" ".join(reversed(words)))["labels"] == "" or len(words) < 4


def test_rarity_counts_files(documents):
    idf = licenses.rarity(documents((1, "mit mit"), (2, "MIT"), (3, None), (4, "apache")))
    assert idf["mit"] < idf["apache"] < idf["gnu"]


def all_places(index, source):
    """Labels and best share by trying every template at every place."""
    words, labels, best = licenses.words_of(source), set(), 0.0
    for number, template in enumerate(index.templates):
        for begin in range(-len(index.words[number]), len(words)):
            share = index.in_place(number, begin, words)
            if share >= index.settings.enough - 1e-9:
                labels.add(template.label)
                best = max(best, share)
    return labels, best


def test_labels_equal_a_scan_of_all_places():
    """Notices with words lost, put in or replaced; common words count no more than rare ones in what is found."""
    rng = random.Random(8)
    found = 0
    for idf in ({}, {w: rng.random() for t in licenses.TEMPLATES for w in t.text.split()}):
        index = licenses.Index(idf)
        for template in licenses.TEMPLATES:
            for _ in range(3):
                words = template.text.split()
                for _ in range(rng.randrange(0, 2 + len(words) // 5)):
                    at = rng.randrange(len(words))
                    words[at : at + 1] = rng.choice([[], ["other"], [words[at], "more"]])
                source = " ".join(["before"] * rng.randrange(4) + words + ["after the license of the software"])
                labels, best = all_places(index, source)
                got = index.scan(source)
                assert set(filter(None, got["labels"].split(","))) == labels | set(filter(None, got["base_labels"].split(",")))
                assert max((s["share"] for s in got["spans"]), default=0.0) == pytest.approx(best)
                found += bool(labels)
    assert found > 100


@pytest.mark.parametrize(
    "source, want",
    [
        ("Licensed under the BSD 3-Clause License.", "bsd"),
        ("SPDX-License-Identifier: BSD-3-Clause", "bsd"),
        ("SPDX-License-Identifier: CC-BY-SA-4.0", "cc-by-sa"),
        ("GNU GPLv2 or later", "gpl"),
        ("GNU Library General Public License", "gpl,lgpl"),
        ("license identifier of the mit", ""),
    ],
)
def test_short_notices(source, want):
    assert licenses.Index({}).scan(source)["labels"] == want


def test_a_notice_without_its_rarest_words_is_found():
    template = licenses.TEMPLATES[0]
    idf = {w: 1.0 / (i + 1) for i, w in enumerate(dict.fromkeys(template.text.split()))}
    words = template.text.split()
    lost = [w for w in sorted(set(words), key=lambda w: -idf[w]) if not any(w in p.split() for p in template.phrases)][:3]
    source = " ".join("other" if w in lost else w for w in words)
    assert licenses.Index(idf).scan(source)["labels"] == "mit"
