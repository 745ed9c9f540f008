"""Labelled pages from which the extraction weights are learnt.

Each layout is a page written out by hand: ``{+n}`` stands for about n words of
the main text and ``{-n}`` for about n words of something else. Layouts say
nothing of the words themselves, so the filler is made up. Short and long
articles, single words, lists and prose occur on both sides.

Further pages are put together by rule: an article in one of the ``SHELLS``,
with boxes named by ``BOXES`` before, inside and after it, so that each name is
met with all kinds of content.
"""

from __future__ import annotations

import random
import re

LAYOUTS = [
    """<html><head><title>{-5}</title></head><body><nav><ul><li><a href="/">{-1}</a></li><li><a href="/b">{-2}</a></li><li><a href="/c">{-1}</a></li></ul></nav>
       <div class="ad">{-12}</div><article><h1>{+6}</h1><p>{+40}</p><p>{+1}</p><p><b>{+3}<br><p>{+20}</p></article><footer>{-9}</footer></body></html>""",
    """<html><body><header><a href="/">{-2}</a><nav><a href="/x">{-1}</a> <a href="/y">{-1}</a></nav></header><main><article><header><h1>{+5}</h1></header><p>{+1}</p>
       <aside><h2>{-2}</h2><ul><li><a href="/r">{-6}</a></li><li><a href="/s">{-6}</a></li></ul></aside><p>{+25}</p><ul><li>{+4}</li><li>{+9}</li></ul><blockquote><p>{+12}</p></blockquote>
       <footer><p>{-6}</p></footer></article><section class="comments"><h2>{-2}</h2><div class="comment"><p>{-25}</p></div><div class="comment"><p>{-9}</p></div></section></main>
       <footer><p>{-14}</p></footer></body></html>""",
    """<html><body><div id="header"><div class="logo">{-2}</div><ul class="menu"><li><a href="/">{-1}</a></li><li><a href="/n">{-1}</a></li></ul></div>
       <div id="main" class="container"><div class="sidebar"><h3>{-2}</h3><p>{-20}</p></div><div class="content"><h2>{+4}</h2><p>{+50}</p><div class="ads advert">{-8}</div><p>{+2}</p></div></div>
       <div id="footer">{-10} <a href="/t">{-2}</a></div></body></html>""",
    """<html><body><div class="cookie-notice banner"><p>{-18}</p><button>{-1}</button></div><div class="post"><h1 class="post-title entry-title">{+7}</h1><div class="post-body entry-content">
       <p>{+30}</p><figure><img src="a.png"><figcaption>{+6}</figcaption></figure><p>{+45}</p><div class="share social"><a href="#">{-1}</a><a href="#">{-1}</a></div>
       <div class="newsletter subscribe"><form action="/s"><label>{-9}</label><input name="e"><button>{-1}</button></form></div></div></div>
       <div id="comments" class="reply respond"><ol class="comment-list"><li class="comment"><p>{-30}</p></li></ol><form><textarea>{-2}</textarea></form></div></body></html>""",
    """<html><body><table class="layout"><tr><td class="nav menu"><a href="/">{-1}</a><a href="/">{-2}</a></td><td class="main text"><h1>{+4}</h1><p>{+60}</p><table><tr><th>{+1}</th><td>{+2}</td></tr>
       <tr><th>{+1}</th><td>{+3}</td></tr></table><pre>{+15}</pre></td></tr></table><div class="copyright">{-8}</div></body></html>""",
    """<html><body><div role="navigation"><a href="/">{-1}</a> | <a href="/">{-1}</a></div><div role="main"><h1>{+3}</h1><p>{+20}</p><p>{+20}</p></div>
       <div role="complementary"><p>{-15}</p></div><div role="contentinfo"><p>{-10}</p></div></body></html>""",
    """<html><body><p>{+30}</p><p>{+25}</p><h2>{+3}</h2><p>{+50}<a href="/z"></a></p></body></html>""",
    """<html><body><div class="breadcrumb breadcrumbs"><a href="/">{-1}</a> <a href="/">{-1}</a></div><div class="alert notice warning"><p>{-14}</p></div><section class="article story"><h1>{+5}</h1>
       <p>{+1}</p><p>{+30}</p></section><div class="related recommended"><h3>{-2}</h3><ul><li><a href="/">{-7}</a></li><li><a href="/">{-8}</a></li><li><a href="/">{-6}</a></li></ul></div>
       <div class="pagination pager"><a href="/">{-1}</a><a href="/">{-1}</a></div><div class="widget promo sponsored"><p>{-16}</p></div><footer class="site-footer">{-12}</footer></body></html>""",
    """<html><body><div class="topbar search"><form><input name="q"><select><option>{-1}</option><option>{-1}</option></select></form></div><article class="post"><h1>{+2}</h1><p>{+2}</p>
       <div class="advertisement sponsor"><p>{-20}</p></div><div class="popup modal overlay"><p>{-15}</p><form><label>{-4}</label></form></div><p>{+8}</p><aside class="sidebar"><p>{-25}</p></aside><p>{+3}</p>
       <nav class="toc"><ul><li><a href="#a">{-3}</a></li></ul></nav><div class="comments" id="disqus"><article class="comment"><p>{-22}</p></article><article class="comment"><p>{-3}</p></article></div></article></body></html>""",
    """<html><body><div class="masthead">{-4}</div><div class="navbar nav-links">{-5}</div><div><div><p>{+35}</p><p>{+40}</p><p>{+1}</p></div></div><div class="tags meta"><a href="/">{-1}</a></div>
       <dialog><p>{-12}</p></dialog><noscript>{-9}</noscript><div class="disclaimer legal">{-14}</div></body></html>""",
    """<html><body><nav>{-6}</nav><div class="notification consent gdpr">{-16}</div><article><h1>{+1}</h1><p>{+1}</p></article><section id="user-comments"><p>{-28}</p><p>{-31}</p></section>
       <aside>{-18}</aside><div class="footer-links"><a href="/">{-2}</a></div><footer>{-20}</footer></body></html>""",
]


SHELLS = ["<article>{}</article>", "<main>{}</main>", '<article class="post entry">{}</article>', '<div class="content">{}</div>', '<div id="main-content">{}</div>', '<div class="post-body">{}</div>',
          '<div class="article-text">{}</div>', '<section class="story">{}</section>', '<div role="main">{}</div>', "<main><article>{}</article></main>", "<div>{}</div>", '<div class="page"><div class="entry-content">{}</div></div>']
PARTS = ["<p>{+30}</p>", "<p>{+60}</p>", "<p>{+2}</p>", "<p>{+1}</p>", "<h2>{+4}</h2>", "<h3>{+3}</h3>", "<ul><li>{+5}</li><li>{+12}</li></ul>", "<ol><li>{+8}</li><li>{+2}</li></ol>", "<blockquote><p>{+15}</p></blockquote>",
         "<p><b>{+4}<br><p>{+20}</p>", "<table><tr><th>{+1}</th><td>{+3}</td></tr></table>", "<pre>{+12}</pre>", "<figure><figcaption>{+6}</figcaption></figure>", "<p><a href='/'>{+2}</a></p>", "<div>{+25}</div>", "<div><p>{+25}</p></div>"]
BOXES = """ad ads advert advertisement sponsor sponsored promo banner cookie consent gdpr notice notification alert warning popup modal overlay nav navbar navigation menu breadcrumb pagination pager toc
    header masthead topbar logo footer copyright legal disclaimer sidebar widget related recommended share social newsletter subscribe signup login search form comment comments reply respond disqus tags meta""".split()
ELEMENTS = "nav aside footer form header dialog noscript".split()
INNER = ["<p>{-30}</p>", "<p>{-3}</p>", "{-15}", "{-2}", "<h3>{-2}</h3><p>{-20}</p>", "<ul><li><a href='/'>{-2}</a></li><li><a href='/'>{-6}</a></li></ul>", "<div><p>{-12}</p><p>{-40}</p></div>", "<ol><li>{-9}</li><li><p>{-25}</p></li></ol>",
         "<h2>{-3}</h2><ul><li>{-4}</li></ul>", "<article><p>{-20}</p></article>"]


def _assembled(r: random.Random, turn: int) -> str:
    """A page by rule; over the turns every box name occurs equally often."""
    names = [f'<div class="{b}">{{}}</div>' for b in BOXES] + [f'<section id="user-{b}">{{}}</section>' for b in BOXES] + [f"<{e}>{{}}</{e}>" for e in ELEMENTS for _ in range(4)]

    def boxes(k: int, outside: bool) -> list[str]:
        chosen = [names[(turn * 7 + r.randrange(len(names))) % len(names)] for _ in range(k)]
        inner = INNER if outside else INNER[:-1]
        return [b.replace("{}", r.choice(inner)) for b in chosen if outside or not b.startswith("<header")]

    main = ["<h1>{+5}</h1>"] * r.randint(0, 1) + r.choices(PARTS, k=r.randint(1, 7))
    for box in boxes(r.randint(0, 2), False):
        main.insert(r.randint(1, len(main)), box)
    return "<html><body>" + "".join(boxes(r.randint(0, 4), True)) + r.choice(SHELLS).replace("{}", "".join(main)) + "".join(boxes(r.randint(0, 4), True)) + "</body></html>"


def labelled_pages(per_layout: int = 8, assembled: int = 700, seed: int = 7) -> list[tuple[str, str]]:
    """(html, main text) of every layout filled in ``per_layout`` times and of so many
    pages assembled by rule."""
    r = random.Random(seed)
    syllables = [a + b for a in "bdfklmnprstv" for b in "aeiou"]

    def words(n: int) -> str:
        n = max(1, round(n * r.choice((0.3, 0.6, 1, 1, 1.6, 3)))) if n > 1 else 1
        said = " ".join("".join(r.choices(syllables, k=r.randint(1, 4))) for _ in range(n))
        return said.capitalize() + r.choice(("", ".", ".")) if n > 2 else said

    def filled(layout: str) -> tuple[str, str]:
        main: list[str] = []

        def fill(m: re.Match) -> str:
            said = words(int(m.group(2)))
            if m.group(1) == "+":
                main.append(said)
            return said

        page = re.sub(r"\{([+-])(\d+)\}", fill, layout)
        return page, "\n".join(main)

    return [filled(x) for x in LAYOUTS for _ in range(per_layout)] + [filled(_assembled(r, i)) for i in range(assembled)]
