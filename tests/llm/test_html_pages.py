"""Pages whose article is known from how they are made: depth, wrappers, names, threads, headers, what isn't shown."""

import random
import time
import tracemalloc

import pytest

from granary.llm import html_text
from granary.llm.html_text import SOMETIMES, USUAL, Page


def prose(k):
    return f"This is whole sentence number {k} of its text, and it goes on for quite a while. It is followed by another one."


ARTICLE = "".join(f"<p>{prose(k)}</p>" for k in range(5))
WANT = "\n".join(map(prose, range(5)))


def text(html):
    return Page(html).text(None)[0]


@pytest.mark.parametrize("tag", ['div class="comment"', "div", "center", "section", "article", "blockquote"])
def test_time_and_memory_follow_the_length(tag):
    html = f"<body><article><h1>T</h1><p>{prose(1)}</p></article>" + f"<{tag}>" * 16_000 + "deep" + f"</{tag.split()[0]}>" * 16_000
    tracemalloc.start()
    page = Page(html)
    page.votes(), page.doubtful(), page.text(None)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    began = time.process_time()
    page = Page(html)
    page.votes(), page.doubtful(), page.text(None)
    assert time.process_time() - began < 2 and peak < 60_000_000
    assert prose(1) in page.text(None)[0]


@pytest.mark.parametrize("what", ["<b>", "<p>", "</p>", "<title>", "<textarea>x", "<select>", "<td>", "<li>", "</div>", "<span hidden>", "<a>x", "<p>x</div>", "<div class=a>x<textarea>", f"<div class=msg><p>{prose(3)}", f"<div class=msg><p>{prose(3)}</p></div>"])
def test_repeated_markup_takes_linear_time(what):
    def took(n):
        html = "<body>" + what * n
        began = time.process_time()
        page = Page(html)
        page.votes(), page.doubtful(), page.text(None)
        return time.process_time() - began

    assert took(16_000) < 12 * took(4_000) + 0.5


def test_a_page_in_a_form_keeps_its_article():
    assert text(f"<body><form id=all><div><div>{ARTICLE}</div><div>x</div></div></form></body>") == WANT
    assert text(f"<body><div>{ARTICLE}<form><p>{prose(8)}</p><input></form></div></body>") == WANT


@pytest.mark.parametrize("name", sorted(USUAL | SOMETIMES))
def test_no_name_drops_prose(name):
    part = f"<p>{prose(7)}</p><p>{prose(8)}</p>"
    for page in (f"<article><h1>Title</h1>{ARTICLE}<section class='{name}'>{part}</section></article>", f"<div class=c><h1>Title</h1>{ARTICLE}<div id='{name}'>{part}</div></div>"):
        assert text(f"<body>{page}</body>") == f"Title\n{WANT}\n{prose(7)}\n{prose(8)}"


@pytest.mark.parametrize("thread", [
    f'<section id="thread"><div class="msg"><p>{prose(11)}</p></div><div class="msg"><p>{prose(12)}</p></div></section>',
    f'<div class="reactions"><div class="msg"><b>Ann</b> {prose(11)}</div><div class="msg">{prose(12)}</div><div class="msg">Short.</div></div>',
    f'<div><ul><li class="post"><div>Ann, Monday</div><p>{prose(11)}</p></li><li class="post"><div>Bo, Tuesday</div><p>{prose(12)}</p></li></ul></div>',
    f'<div class="x"><article class="y"><p>{prose(11)}</p></article><article class="y"><p>{prose(12)}</p></article></div>',
])
def test_threads_go_whatever_they_are_called(thread):
    short = f"<p>{prose(1)}</p>"
    assert text(f"<body><article><h1>T</h1>{short}</article>{thread}<footer>{prose(3)}</footer></body>") == f"T\n{prose(1)}"
    if "<article" not in thread:
        assert text(f"<body><article><h1>T</h1>{short}{thread}</article></body>") == f"T\n{prose(1)}"
        assert text(f"<body><div class=content><h1>T</h1>{ARTICLE}{thread}</div><footer>x</footer></body>") == f"T\n{WANT}"


def test_parts_of_an_article_are_no_thread():
    parts = "".join(f"<section class=part><h2>H{k}</h2><p>{prose(30 + k)}</p></section>" for k in range(3))
    assert text(f"<body><article><h1>T</h1>{ARTICLE}{parts}</article></body>").count("H") == 3
    same = "".join(f"<div class=para>{prose(30 + k)}</div>" for k in range(3))
    assert text(f"<body><article><h1>T</h1><div class=b>{same}</div></article></body>") == "T\n" + "\n".join(prose(30 + k) for k in range(3))
    between = f"<div class=b>{same}</div>"
    assert text(f"<body><div><h1>T</h1>{ARTICLE}{between}<p>{prose(9)}</p></div></body>").endswith(prose(9)) and prose(31) in text(f"<body><div><h1>T</h1>{ARTICLE}{between}<p>{prose(9)}</p></div></body>")
    steps = "<ol>" + "".join(f"<li class=step>{prose(40 + k)}</li>" for k in range(3)) + "</ol>"
    assert prose(41) in text(f"<body><article><h1>T</h1>{ARTICLE}{steps}</article></body>")


def test_only_the_page_header_goes():
    page = f"<body><header><p>Site</p><p>{prose(9)}</p></header><article><header><h1>Title</h1><p>The lead.</p></header>{ARTICLE}</article></body>"
    assert text(page) == f"Title\nThe lead.\n{WANT}"


@pytest.mark.parametrize("hide", ["hidden", 'hidden="until-found"', 'style="color: red; display:none"', "style='visibility : hidden'", 'aria-hidden="true"'])
def test_what_is_not_shown_is_no_text(hide):
    assert text(f"<body><article>{ARTICLE}<div {hide}><p>{prose(8)}</p><div>x</div></div></article></body>") == WANT
    assert text(f"<body><article>{ARTICLE}<p>a <span {hide}>b <span>c</span> d</span> e</p></article></body>") == f"{WANT}\na e"
    assert text(f"<body><article>{ARTICLE}<p title='hidden none' data-x=\"style='display:none' hidden\">end</p></article></body>") == f"{WANT}\nend"


def test_equal_texts_of_a_host_have_equal_hashes():
    rnd, made = random.Random(2), []
    for k in range(6):
        made.append(Page(f"<body><p>{prose(rnd.random())}</p><div class=social><p>{prose(1)}</p><div class=tags><p>{prose(2)}</p><p>{prose(k // 3)}</p></div></div></body>").doubtful())
    assert made[0] == made[2] != made[3] == made[5] and len(made[0]) == 2


def test_many_hosts_and_deep_pages_in_spark(spark):
    deep = "<body><div>" * 3000 + f"<p>{prose(1)}</p>"
    rows = [(k, f"http://h{k % 3}/{k}", f"<body><nav>n</nav><div class=post><h1>T{k}</h1>{ARTICLE}</div><div class=social><p>Tell your friends about this page and all of the others.</p></div></body>") for k in range(12)]
    got = {r.page_id: r for r in html_text.extract_text(spark.createDataFrame([*rows, (99, None, deep), (99, None, deep), (None, "http://h0/", None)], "page_id long, url string, html string")).collect()}
    assert all(got[k].text == f"T{k}\n{WANT}" and got[k].path == "body>div.post" for k in range(12)) and got[99].text == prose(1) and got[None].text == ""
