"""Labelled pages for training: page layouts of many kinds, made from a grammar with known article blocks."""

from __future__ import annotations

import random

#: Classes that themes give to html, body, wrappers and articles; they name parts of the page, but hold all of it.
THEMES = (
    "has-sidebar", "cookie-bar", "comments-open", "nav-fixed menu-open", "page sidebar-right", "single-post footer-dark", "home archive", "with-ads", "popup-ready", "search-results header-sticky",
    "legal", "post has-comments", "post comment-page", "widget-area", "toc related-on", "social share-bar", "newsletter story", "tags-shown content", "login-modal", "breadcrumb-top",
)

_SYLLABLES = "ba ce di fo gu la me ni ro su ta ve wi zo an el or us in".split()


class _Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.html: list[str] = []
        self.labels: list[tuple[str, int]] = []

    def word(self) -> str:
        return "".join(self.r.choice(_SYLLABLES) for _ in range(self.r.randint(1, 4)))

    def words(self, lo: int, hi: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(lo, hi)))

    def sentence(self) -> str:
        s = self.words(3, 16)
        if self.r.random() < 0.4:
            s = s.replace(" ", ", ", 1)
        return s.capitalize() + self.r.choice("....!?")

    def text(self, text: str, label: int) -> str:
        self.labels.append((text, label))
        return text

    def paragraph(self, label: int, most: int = 6) -> str:
        return self.text(" ".join(self.sentence() for _ in range(self.r.randint(1, most))), label)

    def add(self, *parts: str) -> None:
        self.html += parts

    def open(self, tags: list[str], *classes: str) -> str:
        """An opening tag, with a class or an id more often than not; returns its name."""
        tag = self.r.choice(tags)
        c = self.r.choice(classes) if classes else ""
        attr = self.r.choice([f' class="{c}"', f' id="{c}"', f" class='{self.word()} {c}'"]) if c else ""
        self.add(f"<{tag}{attr}>")
        return tag

    def theme(self, tag: str, chance: float) -> None:
        c = self.r.choice(THEMES)
        self.add(f'<{tag} class="{c}">' if self.r.random() < chance else f"<{tag}>")

    def links(self, lo: int, hi: int) -> None:
        if self.r.random() < 0.8:
            self.add("<ul>", *(f'<li><a href="/{self.word()}">{self.text(self.words(1, 3), 0)}</a></li>' for _ in range(self.r.randint(lo, hi))), "</ul>")
        else:
            run = " | ".join(self.words(1, 2) for _ in range(self.r.randint(lo, hi)))
            self.labels.append((run, 0))
            self.add(" | ".join(f'<a href="#">{x}</a>' for x in run.split(" | ")))

    # parts around the article
    def nav(self) -> None:
        t = self.open(["nav", "nav", "div"], "nav", "menu", "navbar", "main-menu", "breadcrumbs")
        self.links(3, 9)
        self.add(f"</{t}>")

    def header(self) -> None:
        t = self.open(["header", "div"], "header", "site-header", "masthead", "banner")
        self.add(f"<{(h := self.r.choice(['h1', 'p', 'div', 'a']))}>{self.text(self.words(1, 5), 0)}</{h}>")
        if self.r.random() < 0.5:
            self.nav() if self.r.random() < 0.5 else self.add(f"<p>{self.paragraph(0, 1)}</p>")
        self.add(f"</{t}>")

    def footer(self) -> None:
        t = self.open(["footer", "footer", "div"], "footer", "site-footer", "colophon")
        lead = self.r.choice(["&copy; ", "Copyright ", "© 2020 ", ""])
        line = lead + self.words(1, 4) + self.r.choice([" &middot; " + self.sentence(), ". All rights reserved.", ""])
        self.labels.append((line.replace("&copy;", "©").replace("&middot;", "·"), 0))
        self.add(self.r.choice(["<p>", ""]) + line)
        if self.r.random() < 0.4:
            self.add("</p>")
            self.links(2, 6)
        if self.r.random() < 0.3:
            self.add(f"<p>{self.paragraph(0, 3)}</p>")
        self.add(f"</{t}>")

    def ad(self) -> None:
        t = self.open(["div", "div", "aside", "section", "p"], "ad", "ads", "advert", "sponsored", "promo", "ad-slot", "advertisement")
        self.add(self.paragraph(0, 3) if self.r.random() < 0.7 else f'<a href="#">{self.text(self.words(2, 6), 0)}</a>', f"</{t}>")

    def notice(self) -> None:
        t = self.open(["div", "div", "section", "aside", "dialog"], "cookie-notice", "notice", "consent", "newsletter", "popup", "alert", "gdpr")
        self.add(f"<p>{self.paragraph(0, 3)}</p>" if self.r.random() < 0.7 else self.paragraph(0, 3))
        if self.r.random() < 0.5:
            self.add(f"<button>{self.word()}</button>")
        self.add(f"</{t}>")

    def form(self) -> None:
        self.add(f'<form class="{self.word()}">', f"<label>{self.text(self.words(1, 4), 0)}</label>", "<input type='text'>")
        if self.r.random() < 0.5:
            self.add(f"<p>{self.paragraph(0, 2)}</p>")
        self.add("<button>Go</button></form>")

    def sidebar(self) -> None:
        t = self.open(["aside", "aside", "div", "section"], "sidebar", "related", "widget", "side-rail", "popular")
        self.add(f"<h3>{self.text(self.words(1, 4), 0)}</h3>")
        self.links(2, 6) if self.r.random() < 0.6 else self.add(f"<p>{self.paragraph(0, 4)}</p>")
        self.add(f"</{t}>")

    def comments(self) -> None:
        t = self.open(["section", "div", "div", "ol", "ul"], "comments", "comment-list", "replies", "discussion")
        inner = "li" if t in ("ol", "ul") else "div"
        for _ in range(self.r.randint(1, 5)):
            self.add(f'<{inner} class="{self.r.choice(["comment", "reply", "comment-body"])}">')
            if self.r.random() < 0.5:
                self.add(f"<h4>{self.text(self.words(1, 3), 0)}</h4>")
            self.add(f"<p>{self.paragraph(0, 5)}</p></{inner}>")
        self.add(f"</{t}>")

    def around(self, kinds: str) -> None:
        for kind in kinds.split():
            if self.r.random() < 0.5:
                getattr(self, kind)()

    # the article
    def article(self, most: int = 12) -> None:
        style = self.r.randint(0, 5)
        outer = []
        if style == 0:
            self.add("<main>")
            outer.append("main")
        if style < 3:
            self.theme(t := "article", 0.5)
        elif style == 3:
            t = self.open(["main"], "", "content")
        elif self.r.random() < 0.4:
            self.theme(t := self.r.choice(["div", "section"]), 0.7)  # nothing tells that it is the article but what it holds
        else:
            t = self.open(["div", "section"], "content", "post", "entry-content", "article-body", "story", "main", "main-content", "page")
        outer.append(t)
        if self.r.random() < 0.8:
            h = self.r.choice(["h1", "h1", "h2"])
            wrap = self.r.random() < 0.25
            self.add("<header>" * wrap, f"<{h}>{self.text(self.sentence() if self.r.random() < 0.5 else self.words(1, 9), 1)}</{h}>", "</header>" * wrap)
        for _ in range(self.r.randint(1, most)):
            x = self.r.random()
            if x < 0.66:
                self.add(self.r.choice(["<p>", "<p>", "<p><b>"]), self.paragraph(1, 7), self.r.choice(["</p>", "</p>", "</p>", "", "<br>"]))
                if self.html[-1] == "<br>":
                    self.add("<p>")
            elif x < 0.74:
                self.add("<ul>", *(f"<li>{self.text(self.words(1, 10), 1)}</li>" for _ in range(self.r.randint(2, 5))), "</ul>")
            elif x < 0.82:
                self.add(f"<h{(n := self.r.randint(2, 4))}>{self.text(self.words(1, 6), 1)}</h{n}>")
            elif x < 0.87:
                self.add(f"<blockquote>{self.paragraph(1, 3)}</blockquote>")
            elif x < 0.92:
                self.add("<table>", *(f"<tr><td>{self.text(self.words(1, 3), 1)}</td><td>{self.text(self.words(1, 3), 1)}</td></tr>" for _ in range(3)), "</table>")
            elif x < 0.98:
                self.around("ad ad sidebar notice form")
            else:
                self.add(f"<div>{self.paragraph(1, 4)}</div>")
        if self.r.random() < 0.15:
            self.comments()
        for t in reversed(outer):
            self.add(f"</{t}>")

    def page(self) -> tuple[str, list[tuple[str, int]]]:
        self.add(f"<!DOCTYPE html><html><head><title>{self.words(1, 6)}</title></head>")
        self.theme("body", 0.4)
        bare = self.r.random() < 0.12  # an article and nothing else
        wrap = self.r.random() < 0.3
        if wrap:
            self.theme("div", 0.5) if self.r.random() < 0.5 else self.add('<div class="wrapper">')
        if not bare:
            self.around("header nav notice ad form sidebar")
        self.article(self.r.choice([1, 2, 12]) if bare else 12)
        if not bare:
            self.around("ad sidebar comments form notice nav")
            if self.r.random() < 0.85:
                self.footer()
        self.add("</div>" * wrap, "</body></html>")
        return "".join(self.html), self.labels


def labelled_pages(count: int, seed: int = 7) -> list[tuple[str, list[tuple[str, int]]]]:
    """Pages with their blocks' texts and labels (1: article) in page order."""
    return [_Maker(seed * 1_000_003 + i).page() for i in range(count)]
