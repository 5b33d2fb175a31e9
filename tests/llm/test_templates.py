"""Main text on pages as sites write them: probes by hand, and generated templates without article elements."""

import random

import pytest

from linkloom.llm import html_template


def extract(spark, pages):
    rows = [(i, u, h) for i, (u, h) in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in html_template.extract_main_text(frame).collect()}


def sentence(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(n))


def test_probes(spark):
    rng = random.Random(1)
    pages, want = [], []

    def page(host, html, text):
        pages.append((f"http://{host}.example/{len(pages)}", html))
        want.append(text)

    for i in range(20):  # a constant notice beside articles, two of them on one page
        a, b = sentence(rng, 30), sentence(rng, 20)
        second = f"<article><p>{b}</article>" if i == 7 else ""
        page("legal", f"<body><article><p>{a}</article>{second}<div class=legal>All rights reserved notice constant.</div>",
             f"{a}\n{b}" if second else a)
    for i in range(12):  # intro and content are siblings
        a, b = sentence(rng, 12), sentence(rng, 60)
        page("post", f"<body><div class=top>The Site Name</div><div class=post><div class=intro>{a}</div><div class=content><p>{b}</div></div>",
             f"{a}\n{b}")
    for i in range(8):  # words inside other attributes' names and values
        a = sentence(rng, 25)
        page("style", f'<body><div style="overflow:hidden" data-id="menu" title=\'class="ad"\'><article>{a}</article></div>', a)
    for i in range(8):  # a name that contains a hint is content, a constant sentence inside every article is not
        a, b = sentence(rng, 25), sentence(rng, 25)
        page("work", f"<body><article><p>{a}<div class=related-work><p>{b}</div><div class=box{i}>Subscribe to our letter today</div></article>",
             f"{a}\n{b}")
    for i in range(6):  # a hinted container that holds all the text
        a = sentence(rng, 30)
        page("widget", f"<body><div class=widget><p>{a}</div>", a)
    for i in range(6):  # copies: their text is constant, and stays
        page("copies", "<body><p>the same article on every page of this host</p>", "the same article on every page of this host")
    got = extract(spark, pages)
    assert [got[i] for i in range(len(pages))] == want


@pytest.mark.parametrize("seed", range(3))
def test_generated_templates(spark, seed):
    """Random hosts: constant frames, varying menus of links, and several varying slots outside any article."""
    rng = random.Random(seed)
    pages, want = [], []
    for host in range(4):
        frame = [sentence(rng, rng.randint(3, 9)) for _ in range(4)]
        slots = rng.randint(1, 4)
        for _ in range(rng.randint(8, 20)):
            texts = [sentence(rng, rng.randint(8, 40)) for _ in range(slots)]
            links = "".join(f"<li><a href=/{k}>{sentence(rng, 2)}</a></li>" for k in range(rng.randint(3, 8)))
            body = "".join(f"<div class=s{chr(97 + k)}><h2>{frame[2]}</h2><p>{t}</p></div>" for k, t in enumerate(texts))
            pages.append((f"https://h{host}.example/{len(pages)}",
                          f"<html><body><div class=head>{frame[0]}</div><ul class=x>{links}</ul>{body}<div class=box>{frame[1]}</div>"
                          f"<div class=end><p>{frame[3]}</p></div></body></html>"))
            want.append("\n".join(texts))
    got = extract(spark, pages)
    assert [got[i] for i in range(len(pages))] == want


def test_only_tokens_that_may_cover_a_host_are_counted(spark):
    """Templates equal plain counts over whole pages; tokens of single articles leave no task (before: every token did)."""
    rng = random.Random(4)
    pages = [(i, f"http://h{i % 5}.example/{i}", f"<body><div class=top>The site {i % 5} &amp; its name</div><p>{sentence(rng, 200)} é\U0001f600</p>")
             for i in range(60)] + [(60 + i, None, f"<p>same words {sentence(rng, 3)}") for i in range(3)]
    parsed = html_template.parsed_pages(spark.createDataFrame(pages, "page_id long, url string, html string")).cache()
    tokens, on, n_pages = html_template.Tokens(), {}, {}
    for _, url, html in pages:
        host = html_template._host(url)
        n_pages[host] = n_pages.get(host, 0) + 1
        blocks, tags = html_template.page_blocks(html)
        assert html_template.unpack_blocks(html_template.pack_blocks(blocks, tags))[1] == tags
        for token in tokens.of_page(blocks, tags)[0].tolist():
            on[host, token] = on.get((host, token), 0) + 1
    want = {k for k, n in on.items() if n >= 4 and n >= html_template.COVER * n_pages[k[0]]}
    templates = {r["host"]: r for r in html_template.host_templates(parsed).collect()}
    assert {(h, t) for h, r in templates.items() for t in r["common"] or []} == want and len(want) > 25
    hosts = spark.createDataFrame(list(n_pages.items()), "host string, all_pages long")
    assert len(want) <= html_template.occurrence_vectors(parsed, hosts).count() < len(on) / 50
