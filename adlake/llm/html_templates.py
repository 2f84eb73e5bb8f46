"""Generated pages with known main text, to train the extractor of operator 9.

Every run of main text starts with MAIN_MARK (a private-use character), which the trainer
reads as the label and removes. Layouts, containers, attribute names and what surrounds or
interrupts the article are drawn at random; words are made of syllables, and so are many of the
names, since pages needn't use the usual ones. Some pages hold next to nothing, some no
article, and an article may hold paragraphs that are whole links.
"""
from __future__ import annotations

import numpy as np

MAIN_MARK = "\ue000"
SYLLABLES = "an be ti re on ka lo mi ser von ein qua der el ou pre ster ion ment la".split()
#: Attribute tokens that usual page parts carry.
MAIN_NAMES = ["content", "post", "entry-content", "article-body", "main", "story", "post-body", "text", "page-content", "articleBody", "", ""]
NAV_NAMES = ["nav", "menu", "navbar", "top-menu", "navigation", "breadcrumbs", "topbar", "links", "", ""]
SIDE_NAMES = ["sidebar", "widget", "related", "right-col", "recommended", "aside", "teaser", "popular", "tags"]
AD_NAMES = ["ad", "ads", "advert", "banner", "sponsor", "promo", "ad-slot", "advertisement", "sponsored"]
NOTICE_NAMES = ["cookie-notice", "notice", "alert", "consent", "popup", "modal", "gdpr", "subscribe", "message", "disclaimer"]
COMMENT_NAMES = ["comments", "comment-list", "disqus", "responses", "commentlist", "discussion", "replies", "reader-comments"]
FOOT_NAMES = ["footer", "copyright", "site-footer", "bottom", "legal", "colophon", ""]
HEAD_NAMES = ["header", "masthead", "site-header", "logo", "top", ""]
SHARE_NAMES = ["share", "social", "sharing", "share-buttons", "meta", "byline", "pagination", "pager"]


def template_page(rng: np.random.Generator) -> str:
    return _Page(rng).page()


class _Page:
    def __init__(self, rng: np.random.Generator):
        self.rng = rng
        self.closes = rng.random() < 0.75  # whether paragraphs are closed

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def pick(self, options):
        return options[int(self.rng.integers(len(options)))]

    def words(self, low: int, high: int) -> str:
        n = int(self.rng.integers(low, high + 1))
        picks = self.rng.integers(0, len(SYLLABLES), (n, 3))
        sizes = self.rng.integers(1, 4, n)
        return " ".join("".join(SYLLABLES[s] for s in row[:k]) for row, k in zip(picks, sizes))

    def sentences(self, n: int) -> str:
        mark = self.pick([".", ".", ".", "!", "?", "!!", " ***"])
        return " ".join(self.words(1, 16).capitalize() + self.pick([".", ".", mark, ""]) for _ in range(n))

    def made_up(self) -> str:
        """A name that no list of usual names has."""
        return self.pick(["-", "_", ""]).join(self.words(1, 1) for _ in range(int(self.rng.integers(1, 3))))

    def wrap(self, tag: str, inner: str, names: list[str] = (), strange: float = 0.1) -> str:
        name = self.pick(names) if len(names) and self.chance(0.85) else ""
        if len(names) and self.chance(strange):
            name = self.made_up()
        attr = f' {self.pick(["class", "class", "id"])}="{name}"' if name else ""
        return f"<{tag}{attr}>{inner}</{tag}>"

    def links(self, low: int, high: int) -> str:
        items = [f'<a href="/{k}">{self.words(1, 3)}</a>' for k in range(int(self.rng.integers(low, high + 1)))]
        if self.chance(0.7):
            return "<ul>" + "".join(f"<li>{a}</li>" for a in items) + "</ul>"
        return self.pick([" | ", " ", " &middot; "]).join(items)

    # --- boilerplate --------------------------------------------------------------------------
    def nav(self) -> str:
        return self.wrap(self.pick(["nav", "nav", "div", "ul", "section"]), self.links(2, 9), NAV_NAMES)

    def header(self) -> str:
        return self.wrap(self.pick(["header", "div"]), self.pick([f"<h1>{self.words(1, 3)}</h1>", f"<div>{self.words(1, 4)}</div>",
                                                                  f'<a href="/">{self.words(1, 2)}</a>']) + (self.nav() if self.chance(0.5) else ""),
                         HEAD_NAMES if self.chance(0.9) else ())

    def ad(self) -> str:
        inner = self.pick([self.sentences(1), self.sentences(int(self.rng.integers(1, 5))), f"<p>{self.sentences(2)}</p>",
                           f'<a href="//x">{self.words(2, 8)}</a>'])
        return self.wrap(self.pick(["div", "div", "aside", "section", "ins", "p"]) if not inner.startswith("<p") else "div", inner, AD_NAMES[:] * 3)

    def notice(self) -> str:
        inner = f"<p>{self.sentences(int(self.rng.integers(1, 4)))}</p>" if self.chance(0.5) else self.sentences(2)
        if self.chance(0.4):
            inner += f"<button>{self.words(1, 2)}</button>"
        return self.wrap(self.pick(["div", "div", "section", "aside"]), inner, NOTICE_NAMES)

    def form(self) -> str:
        inner = f"<label>{self.words(1, 4)}</label><input name=q><button>{self.words(1, 2)}</button>"
        if self.chance(0.5):
            inner = f"<p>{self.sentences(1)}</p>" + inner
        return self.wrap("form", inner, ["search", "newsletter", "signup", "login", "contact"])

    def side(self) -> str:
        inner = f"<h3>{self.words(1, 3)}</h3>" * self.chance(0.6)
        inner += self.links(3, 8) if self.chance(0.6) else "".join(f"<p>{self.sentences(int(self.rng.integers(1, 4)))}</p>" for _ in range(2))
        return self.wrap(self.pick(["aside", "aside", "div", "section"]), inner, SIDE_NAMES)

    def share(self) -> str:
        return self.wrap(self.pick(["div", "ul", "p", "section"]), self.pick([self.links(2, 5), self.words(1, 4)]), SHARE_NAMES)

    def comments(self) -> str:
        one = lambda: self.wrap(self.pick(["div", "li", "article"]),
                                f"<b>{self.words(1, 2)}</b> " * self.chance(0.6) + f"<p>{self.sentences(int(self.rng.integers(1, 6)))}</p>",
                                ["comment", "reply", "comment-body", "comment-item"])
        return self.wrap(self.pick(["section", "div", "ol"]), f"<h3>{self.words(1, 2)}</h3>" * self.chance(0.7)
                         + "".join(one() for _ in range(int(self.rng.integers(1, 6)))), COMMENT_NAMES)

    def footer(self) -> str:
        inner = self.pick([f"&copy; {self.words(1, 2)} &middot; {self.sentences(1)}", f"<p>{self.sentences(2)}</p>", self.links(3, 8)])
        return self.wrap(self.pick(["footer", "footer", "div"]), inner, FOOT_NAMES[:6])

    # --- main text ----------------------------------------------------------------------------
    def main(self, tag: str, inner: str) -> str:
        end = "" if tag == "p" and not self.closes and self.chance(0.7) else f"</{tag}>"
        return f"<{tag}>{MAIN_MARK}{inner}{end}"

    def linked(self, inner: str) -> str:
        return f'<a href="/{self.words(1, 1)}">{inner}</a>'

    def paragraph(self) -> str:
        n = int(self.rng.integers(1, 3)) if self.chance(0.35) else int(self.rng.integers(2, 14))
        text = self.words(1, 2).capitalize() + "." if self.chance(0.12) else self.sentences(n)
        kind = self.rng.random()
        if kind < 0.06:
            text = self.linked(self.words(2, 9).capitalize() + self.pick(["", "."]))
        elif kind < 0.2:
            text = f"<b>{text}" + self.pick(["</b>", "<br>", "<br></b>"])
        elif kind < 0.28:
            text += f" {self.linked(self.words(1, 4))} {self.sentences(1)}"
        elif kind < 0.31:
            text = f"{self.words(1, 2).capitalize()} {', '.join(self.linked(self.words(1, 4)) for _ in range(3))}."
        return self.main(self.pick(["p"] * 12 + ["div"]), text)

    def heading(self, tag: str) -> str:
        found = self.main(tag, self.words(1, 12 if tag == "h1" else 8).capitalize())
        return self.wrap(self.pick(["div", "header"]), found, ["title", "heading", "headline", "entry-header"], 0.4) if self.chance(0.12) else found

    def block(self) -> str:
        """A block that is no paragraph."""
        items = int(self.rng.integers(2, 7))
        kind = int(self.rng.integers(7))
        if kind < 2:
            tag = self.pick(["ul", "ul", "ol"])
            linked = self.chance(0.2)
            return f"<{tag}>" + "".join(self.main("li", self.linked(self.words(2, 8)) if linked and self.chance(0.6) else self.pick(
                [self.words(1, 25), self.sentences(1)])) for _ in range(items)) + f"</{tag}>"
        if kind == 2:
            return "<dl>" + "".join(self.main("dt", self.words(1, 3)) + self.main("dd", self.sentences(1)) for _ in range(items)) + "</dl>"
        if kind == 3:
            head = "<tr>" + "".join(self.main("th", self.words(1, 2)) for _ in range(2)) + "</tr>" if self.chance(0.5) else ""
            return "<table>" + head + "".join("<tr>" + self.main("td", self.words(1, 4)) * 2 + "</tr>" for _ in range(items)) + "</table>"
        return self.pick([self.main("blockquote", self.sentences(2)), self.main("pre", self.words(5, 40)),
                          f"<blockquote>{self.main('p', self.sentences(2))}</blockquote>",
                          f"<figure><img src=x>{self.main('figcaption', self.sentences(1))}</figure>"])

    def body(self) -> str:
        parts = [self.heading("h1" if self.chance(0.8) else "h2")] if self.chance(0.8) else []
        if self.chance(0.2):
            parts.append(self.share())
        sections = self.chance(0.12)
        for _ in range(int(self.rng.integers(1, 4)) if self.chance(0.35) else int(self.rng.integers(2, 25))):
            parts.append(self.paragraph())
            if sections and self.chance(0.5):
                parts.append(self.wrap("section", self.heading("h2") * self.chance(0.8) + "".join(
                    self.paragraph() for _ in range(int(self.rng.integers(1, 4)))), ["section", "chapter", "", ""], 0.4))
            if self.chance(0.05):
                parts.append(self.heading(self.pick(["h2", "h2", "h3"])))
            if self.chance(0.06):
                parts.append(self.block())
            if self.chance(0.03):
                parts.append(self.pick([self.ad, self.side, self.share, self.form, self.notice])())
        return "".join(parts)

    def article(self) -> str:
        inner = self.body() + (self.comments() if self.chance(0.1) else "") + (self.share() if self.chance(0.1) else "")
        kind = self.rng.random()
        if kind < 0.45:
            return self.wrap("article", inner, MAIN_NAMES if self.chance(0.4) else ())
        if kind < 0.6:
            return self.wrap("main", inner, MAIN_NAMES if self.chance(0.4) else ())
        if kind < 0.92:
            return self.wrap(self.pick(["div", "div", "section"]), inner, MAIN_NAMES[:10], 0.5)
        return inner

    def short(self) -> str:
        """A page of next to nothing."""
        inner = self.heading(self.pick(["h1", "h2"])) * self.chance(0.4) + "".join(
            self.main("p", self.pick([self.sentences(1), self.words(3, 9).capitalize() + "."])) for _ in range(int(self.rng.integers(1, 4))))
        kind = self.rng.random()
        if kind < 0.7:
            inner = self.wrap(self.pick(["div", "div", "main", "article", "section"]), inner, MAIN_NAMES if self.chance(0.5) else (), 0.3)
        return (self.nav() if self.chance(0.3) else "") + inner + (self.footer() if self.chance(0.35) else "")

    def page(self) -> str:
        head = (f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>{self.words(1, 8)}</title>'
                + "<style>p{margin:0}</style>" * self.chance(0.5) + '<script>var t="</p>";go();</script>' * self.chance(0.5) + "</head><body>")
        end = "</body></html>" * self.chance(0.85)
        if self.chance(0.15):
            return head + self.short() + end
        top = [part() for part, p in ((self.header, 0.4), (self.nav, 0.7), (self.notice, 0.25), (self.form, 0.15), (self.ad, 0.6),
                                      (self.side, 0.1)) if self.chance(p)]
        self.rng.shuffle(top)
        middle = ([self.article()] if self.chance(0.95) else []) + ([self.comments()] if self.chance(0.25) else [])
        if self.chance(0.3):
            middle.insert(self.pick([0, len(middle)]), self.side())
        middle = "".join(middle)
        if self.chance(0.3):
            for _ in range(int(self.rng.integers(1, 4))):
                middle = self.wrap("div", middle, ["container", "wrapper", "page", "row", "site", "col"], 0.3)
        elif self.chance(0.06):
            middle = f"<table><tr><td>{middle}</td><td>{self.links(3, 6)}</td></tr></table>"
        bottom = [part() for part, p in ((self.ad, 0.2), (self.side, 0.2), (self.form, 0.15), (self.notice, 0.15), (self.footer, 0.85))
                  if self.chance(p)]
        comment = "<!-- x -->" * self.chance(0.3)
        return head + "".join(top) + comment + middle + "".join(bottom) + end
