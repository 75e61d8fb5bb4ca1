"""Labelled pages: layouts drawn from a seed, whose content blocks carry a mark.

Every page has one article among some of what sites put around it: menus,
headers, footers, sidebars, notices, adverts, forms, comments. Where things
stand, which elements and names they use, and how long their texts are is drawn
anew for each page. Words are made up, so nothing can be learned from them but
a few cue words of interfaces.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import lru_cache

from haulmark.llm.dom import LABEL

# Names that sites give to their parts.
CONTENT = ("content", "main-content", "article-body", "post", "post-content", "entry-content", "story", "text", "articleBody", "hentry")
MENU = ("nav", "menu", "navbar", "main-menu", "navigation", "breadcrumb", "breadcrumbs", "toc", "pagination", "tabs", "tags")
HEADER = ("header", "site-header", "masthead", "topbar", "top", "page-header", "branding", "logo")
FOOTER = ("footer", "site-footer", "colophon", "bottom", "copyright", "legal", "page-footer")
SIDEBAR = ("sidebar", "side", "right-col", "widget", "related", "widget-area", "recommended", "more-stories", "secondary")
NOTICE = ("cookie-banner", "notice", "gdpr", "consent", "popup", "modal", "alert", "message", "announcement", "overlay")
ADVERT = ("ad", "ads", "advert", "ad-slot", "sponsored", "promo", "advertisement", "banner-ad", "sponsor")
FORM = ("search", "login", "newsletter", "subscribe", "signup", "contact-form", "share", "social")
COMMENT = ("comments", "comment-list", "discussion", "replies", "responses", "disqus_thread", "reader-comments")
WRAPPER = ("page", "wrapper", "container", "row", "col", "site", "inner", "layout", "main", "body", "outer", "grid")
CUES = ("cookies", "subscribe", "login", "advertisement", "sponsored", "reply", "comments", "privacy", "newsletter", "search", "share")
MARK = f" {LABEL}"
SYLLABLES = ("an", "ter", "ou", "is", "the", "ne", "ro", "li", "cha", "ve", "st", "en", "ö", "qui", "dor", "mé", "ra", "ing", "to", "os")


WORDS = 2000


@lru_cache(maxsize=1)
def vocabulary() -> list[str]:
    r = random.Random(0)
    return ["".join(r.choices(SYLLABLES, k=r.choice([1, 1, 2, 2, 3, 4]))) for _ in range(WORDS)]


class Sampler:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return self.r.choice(vocabulary())

    def words(self, n: int) -> str:
        return " ".join(self.r.choices(vocabulary(), k=n))

    def sentence(self, cues: float = 0.002) -> str:
        words = [self.r.choice(CUES) if self.r.random() < cues else self.word() for _ in range(self.r.choice([1, 3, 6, 9, 12, 18, 25]))]
        return " ".join(words).capitalize() + self.r.choice([".", ".", ".", ".", "!", "?", ""])

    def sentences(self, most: int, cues: float = 0.002) -> str:
        return " ".join(self.sentence(cues) for _ in range(self.r.randint(1, most)))

    def chance(self, p: float) -> bool:
        return self.r.random() < p

    def names(self, kinds: tuple[str, ...], bare: float = 0.1) -> str:
        if self.chance(bare):
            return ""
        key = self.r.choice(["class", "class", "id"])
        name = self.r.choice(kinds)
        return f' {key}="{name}{self.r.choice(["", "", "", " clearfix", "-1"])}"'

    def box(self, tags: str, kinds: tuple[str, ...], inner: str, bare: float = 0.1) -> str:
        """An element whose tag or name says what it is."""
        options = tags.split()
        tag = self.r.choice(options)
        plain = tag in ("div", "ul", "section", "p", "ol")
        return f"<{tag}{self.names(kinds, bare if plain else 0.6)}>{inner}</{tag}>"

    def link(self, n: int = 2) -> str:
        return f'<a href="/{self.word()}">{self.words(self.r.randint(1, n))}</a>'

    def links(self, n: int = 4) -> str:
        how, several = self.r.random(), range(self.r.randint(2, 12))
        if how < 0.6:
            return "<ul>" + "".join(f"<li>{self.link(n)}</li>" for _ in several) + "</ul>"
        return self.r.choice([" | ", " ", " &middot; ", "<br>"]).join(self.link(n) for _ in several)

    # What stands around the article

    def menu(self) -> str:
        return self.box("nav nav div ul", MENU, self.links(2), 0.25)

    def header(self) -> str:
        parts = [f'<a href="/">{self.words(2)}</a>', f"<p>{self.sentence()}</p>", f"<h1>{self.words(2)}</h1>", self.menu(), self.form()]
        return self.box("header header div", HEADER, "".join(self.r.sample(parts, self.r.randint(1, 3))), 0.0)

    def footer(self) -> str:
        parts = [
            f"&copy; {self.words(2)} &middot; {self.sentence()}", f"<p>{self.sentences(2)}</p>", self.links(2),
            f"<p>&copy; 2020 {self.words(3)}. {self.sentence(0.2)}</p>", f"<div>{self.sentence()}</div>",
        ]
        return self.box("footer footer footer div", FOOTER, "".join(self.r.sample(parts, self.r.randint(1, 3))), 0.0)

    def sidebar(self) -> str:
        out = ""
        for _ in range(self.r.randint(1, 4)):
            title = f"<h{self.r.choice('2344')}>{self.words(3)}</h4>"
            body = self.r.choice([self.links(6), f"<p>{self.sentences(3)}</p>", f"<p>{self.link(5)} {self.sentence()}</p>"])
            out += f"<div>{title}{body}</div>" if self.chance(0.5) else title + body
        return self.box("aside aside div div section", SIDEBAR, out, 0.05)

    def notice(self) -> str:
        text = f"<p>{self.sentences(3, 0.1)}</p>" if self.chance(0.5) else self.sentences(3, 0.1)
        if self.chance(0.6):
            text += "<button>OK</button>" if self.chance(0.5) else self.link(2)
        return self.box("div div div section dialog", NOTICE, text, 0.0)

    def advert(self) -> str:
        text = self.sentences(3, 0.05)
        text = self.r.choice([text, f"<p>{text}</p>", f'<a href="/x">{text}</a>', f"<h3>{self.words(4)}</h3><p>{text}</p>"])
        return self.box("div div aside", ADVERT, text, 0.0)

    def form(self) -> str:
        inner = self.r.choice(["", f"<p>{self.sentence(0.2)}</p>", self.sentence(0.2)])
        inner += f'<label>{self.word()}</label><input type="text"><button>{self.word()}</button>'
        return f"<form{self.names(FORM, 0.5)}>{inner}</form>" if self.chance(0.8) else self.box("div", FORM, inner + self.links(2), 0)

    def comments(self) -> str:
        out = f"<h{self.r.choice('23')}>{self.r.choice([self.words(2), 'Comments', '3 comments'])}</h3>" if self.chance(0.7) else ""
        item = self.r.choice(["li", "div", "article"])
        for _ in range(self.r.randint(1, 8)):
            name = self.r.choice([' class="comment"', ' class="comment-body"', ""])
            who = self.r.choice([f"<b>{self.words(2)}</b>", f"<span>{self.words(2)}</span><br>", f"<h4>{self.words(2)}</h4>", ""])
            out += f"<{item}{name}>{who}<p>{self.sentences(5, 0.01)}</p>{self.link(1) if self.chance(0.4) else ''}</{item}>"
        out += self.form() if self.chance(0.4) else ""
        return self.box("section div div ol", COMMENT, out, 0.0)

    # The article

    def inline(self, text: str) -> str:
        words = text.split(" ")
        if self.chance(0.3):
            i = self.r.randrange(len(words))
            words[i] = self.r.choice([f'<a href="/y">{words[i]}</a>', f"<b>{words[i]}</b>", f"<em>{words[i]}</em>", f"{words[i]}<br>"])
        return " ".join(words)

    def block(self) -> str:
        kind = self.r.random()
        if kind < 0.72:
            text = self.inline(self.sentences(self.r.choice([1, 3, 8])))
            return f"<p{MARK}>{text}" + ("</p>" if self.chance(0.85) else "")
        if kind < 0.79:
            return f"<h2{MARK}>{self.words(4)}</h2>"
        if kind < 0.86:
            short = self.chance(0.5)
            items = (self.words(3) if short else self.inline(self.sentences(2)) for _ in range(self.r.randint(1, 6)))
            tag = self.r.choice(["ul", "ol"])
            return f"<{tag}>" + "".join(f"<li{MARK}>{i}</li>" for i in items) + f"</{tag}>"
        if kind < 0.90:
            return f"<blockquote><p{MARK}>{self.sentences(3)}</p></blockquote>"
        if kind < 0.93:
            return f"<pre{MARK}>{self.words(12)}\n  {self.words(5)}</pre>"
        if kind < 0.96:
            cells = "".join(f"<tr><td{MARK}>{self.words(2)}</td><td{MARK}>{self.r.randint(1, 999)}</td></tr>" for _ in range(3))
            return f"<table>{cells}</table>"
        if kind < 0.98:
            return f'<figure><img src="z.png"><figcaption{MARK}>{self.sentence()}</figcaption></figure>'
        return f"<div{MARK}>{self.inline(self.sentences(4))}</div>"

    def article(self) -> str:
        title = f"<h1{MARK}>{self.sentence()}</h1>"
        if self.chance(0.15):
            title = f"<header>{title}</header>"
        blocks = [self.block() for _ in range(self.r.choice([1, 2, 4, 8, 15, 30]))]
        for make, p in ((self.advert, 0.25), (self.form, 0.08), (self.sidebar, 0.15), (self.menu, 0.12), (self.notice, 0.05)):
            if self.chance(p):
                blocks.insert(self.r.randint(0, len(blocks)), make())
        inner = title + "".join(blocks) if self.chance(0.92) else "".join(blocks)
        if self.chance(0.2):
            inner += self.r.choice([self.comments, self.sidebar])()
        kind = self.r.random()
        if kind < 0.5:
            return f"<article{self.names(CONTENT, 0.6)}>{inner}</article>"
        tag = self.r.choice(["div", "div", "section", "main"])
        return f"<{tag}{self.names(CONTENT, 0.3)}>{inner}</{tag}>"

    def page(self) -> str:
        before = [self.notice] * self.chance(0.2) + [self.header] * self.chance(0.5) + [self.menu] * self.chance(0.6)
        before += [self.advert] * self.chance(0.4) + [self.form] * self.chance(0.15) + [self.sidebar] * self.chance(0.15)
        after = [self.sidebar] * self.chance(0.4) + [self.comments] * self.chance(0.35) + [self.advert] * self.chance(0.2)
        after += [self.form] * self.chance(0.2) + [self.menu] * self.chance(0.2)
        self.r.shuffle(before)
        self.r.shuffle(after)
        after += [self.footer] * self.chance(0.85) + [self.notice] * self.chance(0.15)
        head, tail = [f() for f in before], [f() for f in after]
        core = self.article()
        for _ in range(self.r.choice([0, 0, 1, 2, 3])):  # wrappers take in some of the neighbours
            i, j = self.r.randint(0, len(head)), self.r.randint(0, len(tail))
            core = "".join(head[i:]) + core + "".join(tail[:j])
            head, tail = head[:i], tail[j:]
            tag = self.r.choice(["div", "div", "div", "main", "section"])
            core = f"<{tag}{self.names(WRAPPER, 0.3)}>{core}</{tag}>"
        html = f"<!DOCTYPE html><html><head><title>{self.words(4)}</title><style>p{{margin:0}}</style></head><body>"
        html += "".join(head) + f"<script>var t='</p>';</script>{core}" + "".join(tail)
        return html if self.chance(0.2) else html + "</body></html>"


def pages(n: int, seed: int = 0) -> Iterator[str]:
    for i in range(n):
        yield Sampler(seed * 1_000_003 + i).page()
