from __future__ import annotations

import random
import time

from tests.llm.helpers import with_clashes
from tidewater.llm.html_extract import blocks_of, extract

PAGE = "page_id long, url string, html string"
MENU = "<div>home news sport weather travel food culture opinion jobs</div>"


def main_of(page: str) -> str:
    return "\n".join(t for p, t in blocks_of(page) if p == "main")


def test_article_without_its_surroundings():
    page = ("<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var t='</p>';</script></head>"
            "<body><header>no</header><nav><ul><li>no</ul></nav><!-- <p>no</p> --><div class='ad box'>no</div>"
            "<article><header><h1>T &amp;amp; t</h1></header><p><b>one<br>two<p>three\n  four &eacute;&#33;</p>"
            "<form>no<input><select><option>no</select></form><div class=\"comments\"><p>no</p></div>"
            "<aside>no</aside><ul><li>a<li>b</ul><table><tr><td>x<td>y</tr></table></article>"
            "<section id=comments>no</section><footer>&copy; no</footer></body></html>")
    assert main_of(page) == "T &amp; t\none two\nthree four é!\na\nb\nx y"


def test_cut_off_and_odd_markup():
    assert main_of("<article><p>a &am") == "a &am"
    assert main_of("<article><p>a <di") == "a"
    assert main_of("<article><p>1 < 2 <b>b</b>c</article>") == "1 < 2 bc"
    assert main_of('<article><p title="a > b">x</p></div></section></article>y') == "x"
    assert main_of("<ARTICLE><P>x<script>if (a<b) '<p>'</SCRIPT>y") == "xy"
    assert main_of("<article><p>x<script>never closed") == "x"
    assert blocks_of("") == []


def test_repeats_on_a_host_go_and_unique_runs_stay(spark):
    rows = [(k, f"http://h.org/{k}", f"<body>{MENU}<div>unique text number {k} of its own page here</div>") for k in range(6)]
    rows += [(10, "http://other.org/", f"<body>{MENU}"), (11, None, None), (12, "x", ""), (13, "http://h.org/0", rows[0][2])]
    pages = with_clashes(spark.createDataFrame(rows, PAGE).repartition(3), "host", "keys", "page", "text")
    want = {**{k: f"unique text number {k} of its own page here" for k in range(6)},
            13: "unique text number 0 of its own page here",
            10: "home news sport weather travel food culture opinion jobs", 11: "", 12: ""}
    got = extract(pages).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    joined = extract(pages, max_repeated=0).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, joined))


def test_copies_of_a_page_keep_their_text(spark):
    text = "one story without an article around it that two pages of this host tell alike"
    rows = [(k, "http://h.org/", f"<div>{text}</div>") for k in range(2)]
    rows += [(10 + k, "http://i.org/", f"<body>{MENU}<div>{text}</div><div>{MENU}</div>") for k in range(2)]
    rows += [(20 + k, "http://i.org/", f"<body>{MENU}<div>page {k} says this and no other page does so</div>") for k in range(4)]
    for limit in (1_000_000, 0):
        got = {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(rows, PAGE), limit).collect()}
        assert got[0] == got[1] == text
        assert got[10] == got[11] and text in got[10]


def runs_brute(rows):
    """Tokens of each page that lie in 12 or more tokens which another page of its host has."""
    streams = {}
    for k, url, page in rows:
        out = ["|"]
        for _, t in blocks_of(page):
            out += [*t.lower().split(), "|"]
        streams[k] = (url.split("/")[2], out)
    seen: dict = {}
    for k, (host, w) in streams.items():
        for a in range(len(w) - 11):
            seen.setdefault((host, *w[a:a + 12]), set()).add(k)
    out = {}
    for k, (host, w) in streams.items():
        covered = {c for a in range(len(w) - 11) if len(seen[(host, *w[a:a + 12])]) > 1 for c in range(a, a + 12)}
        out[k] = sum(w[c] != "|" for c in covered)
    return out


def test_repeated_runs_match_brute_force(spark):
    rng = random.Random(6)
    shared = [[f"w{rng.randrange(40)}" for _ in range(rng.randrange(5, 60))] for _ in range(12)] + [["a"] * 30]
    rows = []
    for k in range(60):
        parts = [rng.choice(shared) if rng.random() < 0.5 else [f"u{rng.randrange(9999)}" for _ in range(rng.randrange(1, 30))]
                 for _ in range(rng.randrange(1, 6))]
        cut = [p[rng.randrange(len(p)):] if rng.random() < 0.3 else p for p in parts]
        rows.append((k, f"http://h{k % 3 % 2}.org/{k}", "".join(f"<p>{' '.join(p)}</p>" for p in cut)))
    want = runs_brute(rows)
    for limit in (1_000_000, 0):
        got = extract(spark.createDataFrame(rows, PAGE).repartition(4), limit).collect()
        assert {r["page_id"]: r["n_repeated"] for r in got} == want
    assert sum(v > 0 for v in want.values()) > 20


def test_long_and_deep_pages_take_linear_time():
    start = time.process_time()
    assert blocks_of("<div>" * 100_000 + "x" + "</div>" * 100_000) == [("open", "x")]
    text = "many words and a few more of them " * 150_000  # 5 MB
    assert main_of(f"<article><p class=lead>{text}</p>{'<p>short' * 50_000}</article>").startswith(text.strip())
    assert time.process_time() - start < 10


def test_names_of_paragraphs_items_and_spans():
    for part in ("<p class='advert'>no</p>", "<p class='newsletter'>no", "<ul class='share-buttons'><li>no</ul>",
                 "<div class='related-links'>no</div>", "<ol class='commentlist'><li>no</ol>", "<p class='advert-text'>no</p>",
                 "<ul><li class=ad>no<li class=promo>no</ul>", "<h3 class='related'>no</h3>"):
        assert main_of(f"<article><p>story</p>{part}<p>end</article>") == "story\nend", part
    assert main_of("<article><p>one <span class='ad'>no <span>no</span> no</span>two<p>three</article>") == "one two\nthree"
    assert main_of("<article><p>one <span class='ad'>no<p>two</article>") == "one\ntwo"
    assert main_of("<article><ul><li class='ad'><p>no</p>no<li>yes</ul><p class='lead'>end</article>") == "yes\nend"
    assert main_of("<article><div class='ad-free'>story</div><p class='long-form-text'>end</article>") == "story\nend"


def test_repeated_articles_stay(spark):
    page = f"<body>{MENU}<article><p>the same story told on two pages of one host, word for word</p></article>"
    rows = [(1, "http://h.org/1", page), (2, "http://h.org/2", page), (2, "http://h.org/2", page)]
    got = extract(spark.createDataFrame(rows, PAGE)).collect()
    assert len(got) == 3 and {r["text"] for r in got} == {"the same story told on two pages of one host, word for word"}
    assert extract(spark.createDataFrame([], PAGE)).count() == 0


def test_text_repeated_in_articles_goes(spark):
    advert = "<p>sign up today for the weekly letter with all of our best stories</p>"
    own = [f"story {k} tells of thing {k} and of nothing else that any other page has" for k in range(8)]
    rows = [(k, f"http://h.org/{k}", f"<article><p>{t}</p>{advert}<p>end {k}</p></article>") for k, t in enumerate(own)]
    for limit in (1_000_000, 0):
        got = extract(spark.createDataFrame(rows, PAGE), max_repeated=limit).collect()
        assert {r["page_id"]: r["text"] for r in got} == {k: f"{t}\nend {k}" for k, t in enumerate(own)}


def test_a_line_that_few_articles_of_a_host_share_stays(spark):
    line = "<p>the quick brown fox jumps over the lazy dog near the old river bank</p>"
    rows = [(k, f"http://h.org/{k}", f"<article><p>only page {k} has this</p>{line if k < 4 else ''}</article>")
            for k in range(12)]
    got = extract(spark.createDataFrame(rows, PAGE)).collect()
    assert sum("quick brown fox" in r["text"] for r in got) == 4


def test_phrases_met_by_chance_do_not_drop_a_block(spark):
    phrase = "once upon a time in a land far away"  # nine words
    rows = [(k, f"http://h.org/{k}", f"<div>{phrase} lived number{k}</div>") for k in range(2)]
    # on a larger host, two pages are too few for a repeat
    both = "<div>a longer sentence of fourteen words which two pages of the larger host share</div>"
    rows += [(100 + k, f"http://big.org/{k}", both if k < 2 else f"<div>page {k}</div>") for k in range(250)]
    got = {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(rows, PAGE)).collect()}
    assert [got[k] for k in range(2)] == [f"{phrase} lived number{k}" for k in range(2)]
    assert got[100] == got[101] == both[5:-6]


def test_names_of_wrappers_keep_the_article():
    story = "<article><p>story</p></article>"
    for page in (f"<div class='has-sidebar'>{story}</div>", "<main class='no-sidebar'><p>story</main>",
                 f"<div id='page-header-and-content'>{story}</div>", "<article class='post widget'><p>story</article>",
                 f"<div class=widget>{story}</div>", f"<form id=aspnet>{story}</form>",
                 f"<main><div class='with-sidebar'>{story}</div></main>", f"<div class='comments'>{story}</div>",
                 "<main><div class=widget><article><p>story</article></div></main>",
                 "<article><div class='wide no-ad'>story</div></article>"):
        assert main_of(page) == "story", page
    assert main_of("<article><div class='entry-header'><h1>head</h1></div><p>story</article>") == "head\nstory"


def test_names_of_parts_are_chrome():
    for name in ("site-footer", "cookie-banner", "main-nav", "ad-box", "sidebar-left", "comments-area", "x widget"):
        assert main_of(f"<article><p>story</p><div class='{name}'>no</div></article>") == "story", name
        assert blocks_of(f"<div id='{name.replace('x ', '')}'>no</div>") == [("chrome", "no")], name
    comment = "<article class='comment'><p>no</p></article>"
    assert main_of(f"<main><article><p>story</article><div id=comments>{comment}</div></main>") == "story"
    assert main_of(f"<article><p>story</p>{comment}</article>") == "story"
