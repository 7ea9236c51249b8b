"""Seeded page layouts with known article text, to fit the node classifier of HTML extraction."""

from __future__ import annotations

import random

import numpy as np

LETTERS = "abcdefghijklmnopqrstuvwxyz"


class Writer:
    """Builds html and remembers, by element in page order, what belongs to the article.

    ``plain`` pages put the article where no name tells it: in the body itself, in
    unnamed or neutrally named boxes, in a layout table, or in a fragment without body.
    Half of them also drop the names of what stands around it.
    """

    def __init__(self, seed: int, plain: bool = False):
        self.r = random.Random(seed)
        self.plain = plain
        self.bare = plain and self.r.random() < 0.5
        self.out: list[str] = []
        self.label: list[int] = [1]  # the root holds the article

    def words(self, low: int, high: int) -> str:
        r = self.r
        text = []
        for _ in range(r.randint(low, high)):
            word = "".join(r.choice(LETTERS) for _ in range(r.randint(1, 9)))
            text.append(word + r.choice(["", "", "", "", "", ",", "."]))
        return (" ".join(text)).capitalize() + r.choice([".", ".", ".", "", "!", "?"])

    def tag(self, name: str, label: int, inside=None, **attributes) -> None:
        marks = "".join(f' {k.rstrip("_")}="{v}"' for k, v in attributes.items() if v)
        self.out.append(f"<{name}{marks}>")
        self.label.append(label)
        if callable(inside):
            inside()
        elif inside:
            self.out.append(inside)
        self.out.append(f"</{name}>")

    def links(self, label: int, n: int) -> None:
        def item() -> None:
            self.tag("a", label, self.words(1, 3), href="/x")
        if self.r.random() < 0.6:
            self.tag("ul", label, lambda: [self.tag("li", label, item) for _ in range(n)])
        else:
            for _ in range(n):
                item()

    def article(self) -> None:
        r = self.r
        if r.random() < 0.9:
            self.tag(r.choice(["h1", "h1", "h2"]), 1, self.words(1, 10))
        if r.random() < 0.15:
            self.tag("div", 0, lambda: self.links(0, r.randint(2, 5)), class_=r.choice(["share", "social-share", "post-meta share"]))
        for _ in range(r.randint(1, 14)):
            kind = r.random()
            if kind < 0.72:
                def body() -> None:
                    if r.random() < 0.2:
                        self.tag(r.choice(["b", "em", "strong", "span"]), 1, self.words(1, 6))
                    self.out.append(self.words(1, r.choice([1, 3, 12, 60, 150])))
                    if r.random() < 0.15:
                        self.tag("a", 1, self.words(1, 4), href="/y")
                        self.out.append(self.words(1, 20))
                self.tag("p", 1, body)
            elif kind < 0.78:
                self.tag(r.choice(["h2", "h3"]), 1, self.words(1, 7))
            elif kind < 0.84:
                self.tag(r.choice(["ul", "ol"]), 1, lambda: [self.tag("li", 1, self.words(1, 25)) for _ in range(r.randint(1, 6))])
            elif kind < 0.87:
                self.tag("blockquote", 1, lambda: self.tag("p", 1, self.words(3, 40)))
            elif kind < 0.89:
                self.tag("pre", 1, self.words(3, 30))
            elif kind < 0.91:
                self.tag("table", 1, lambda: [self.tag("tr", 1, lambda: [self.tag("td", 1, self.words(1, 4)) for _ in range(3)]) for _ in range(3)])
            elif kind < 0.93:
                self.tag("figure", 1, lambda: self.tag("figcaption", 1, self.words(2, 15)))
            elif kind < 0.97:
                self.tag("div", 0, lambda: self.boiler_text(), class_=r.choice(["ad", "advert", "ads banner", "sponsored", "promo-box", "adslot", "newsletter-signup"]))
            else:
                self.tag("aside", 0, lambda: self.boiler_text(), class_=r.choice(["", "related", "more-stories"]))

    def boiler_text(self) -> None:
        if self.r.random() < 0.4:
            self.tag("p", 0, self.words(1, 40))
        elif self.r.random() < 0.4:
            self.links(0, self.r.randint(1, 6))
        else:
            self.out.append(self.words(1, 30))

    def form(self) -> None:
        def inside() -> None:
            self.tag("label", 0, self.words(1, 4))
            if self.r.random() < 0.4:
                self.tag("p", 0, self.words(2, 15))
            self.tag("button", 0, self.words(1, 2))
        self.tag("form", 0, inside, class_="" if self.bare else self.r.choice(["", "search", "newsletter", "login", "contact-form"]))

    def comments(self) -> None:
        r = self.r

        def one() -> None:
            self.tag("div", 0, lambda: (self.tag("span", 0, self.words(1, 2), class_=r.choice(["author", "user", ""])), self.tag("p", 0, self.words(2, 60))),
                     class_=r.choice(["comment", "reply", "comment-body", ""]))

        def inside() -> None:
            if r.random() < 0.6:
                self.tag(r.choice(["h2", "h3"]), 0, self.words(1, 3))
            for _ in range(r.randint(1, 5)):
                one()
            if r.random() < 0.3:
                self.form()
        name = r.choice(["section", "div", "ol", "aside"])
        self.tag(name, 0, inside, **r.choice([{"class_": "comments"}, {"id": "comments"}, {"class_": "comment-list"}, {"id": "disqus_thread"}, {"class_": "reader-comments"}]))

    def page(self) -> str:
        r = self.r

        def menu() -> None:
            if self.bare:
                self.tag(r.choice(["nav", "div"]), 0, lambda: self.links(0, r.randint(2, 8)))
            elif r.random() < 0.7:
                self.tag("nav", 0, lambda: self.links(0, r.randint(2, 8)), class_=r.choice(["", "", "menu", "main-nav"]))
            else:
                self.tag("div", 0, lambda: self.links(0, r.randint(2, 8)), class_=r.choice(["nav", "menu", "navbar top", "breadcrumbs", "navigation"]))

        def top() -> None:
            def inside() -> None:
                if r.random() < 0.7:
                    self.tag(r.choice(["div", "span", "p", "h1", "a"]), 0, self.words(1, 6), class_="" if self.bare else r.choice(["logo", "title", "site-title", ""]))
                if r.random() < 0.5:
                    menu()
            if self.bare:
                self.tag("header", 0, inside)
            elif r.random() < 0.7:
                self.tag("header", 0, inside, class_=r.choice(["", "site-header"]))
            else:
                self.tag("div", 0, inside, **r.choice([{"class_": "header"}, {"id": "header"}, {"id": "masthead"}]))

        def notice() -> None:
            self.tag("div", 0, self.boiler_text, class_=r.choice(["cookie-notice", "cookie-banner", "notice", "consent", "gdpr popup", "alert", "newsletter modal"]))

        def advert() -> None:
            self.tag(r.choice(["div", "div", "aside", "section"]), 0, self.boiler_text,
                     **r.choice([{"class_": "ad"}, {"class_": "ads"}, {"class_": "advert"}, {"class_": "ad-banner"}, {"id": "ad-top"}, {"class_": "sponsored promo"}]))

        def side() -> None:
            def inside() -> None:
                for _ in range(r.randint(1, 3)):
                    if r.random() < 0.5:
                        self.tag(r.choice(["h2", "h3", "h4"]), 0, self.words(1, 4))
                    self.boiler_text()
            if self.bare:
                self.tag("aside", 0, inside)
            elif r.random() < 0.6:
                self.tag("aside", 0, inside, class_=r.choice(["", "sidebar"]))
            else:
                self.tag("div", 0, inside, **r.choice([{"class_": "sidebar"}, {"id": "sidebar"}, {"class_": "widget related"}, {"class_": "trending"}]))

        def foot() -> None:
            def inside() -> None:
                if r.random() < 0.4:
                    self.links(0, r.randint(1, 5))
                if r.random() < 0.5:
                    self.tag("p", 0, "&copy; " + self.words(1, 20))
                else:
                    self.out.append("&copy; " + self.words(1, 20))
            if self.bare or r.random() < 0.7:
                self.tag("footer", 0, inside)
            else:
                self.tag("div", 0, inside, **r.choice([{"class_": "footer"}, {"id": "footer"}, {"class_": "site-footer copyright"}]))

        def story() -> None:
            def inside() -> None:
                self.article()
                if r.random() < 0.12:
                    self.comments()
            if self.plain:
                return self.unnamed(inside, menu)
            kind = r.random()
            if kind < 0.4:
                self.tag("article", 1, inside, class_=r.choice(["", "", "post"]))
            elif kind < 0.6:
                self.tag("main", 1, lambda: self.tag("article", 1, inside))
            elif kind < 0.75:
                self.tag("main", 1, inside, id=r.choice(["", "main"]))
            else:
                self.tag(r.choice(["div", "section"]), 1, inside, **r.choice([{"class_": "content"}, {"id": "content"}, {"class_": "article-body"}, {"class_": "post entry"}, {"class_": "story"}]))

        def body() -> None:
            before = [p for p, share in ((notice, 0.3), (top, 0.6), (menu, 0.6), (advert, 0.5), (self.form, 0.2), (side, 0.2)) if r.random() < share]
            after = [p for p, share in ((self.comments, 0.4), (side, 0.4), (advert, 0.3), (self.form, 0.3), (notice, 0.15), (foot, 0.85)) if r.random() < share]
            r.shuffle(before)
            for part in before:
                part()
            if self.plain and r.random() < 0.5:  # nothing or little around it
                before, after = [], after[-1:]
            if r.random() < 0.3:
                self.tag("div", 1, lambda: [p() for p in [story, *after]], class_=r.choice(["wrapper", "container", "page", ""]))
            else:
                for part in [story, *after]:
                    part()
        if self.plain and r.random() < 0.12:
            self.article()
        else:
            self.tag("body", 1, body)
        return "".join(self.out)

    def unnamed(self, inside, menu) -> None:
        """The article without a container, or in one whose name says nothing."""
        r = self.r
        kind = r.random()
        if kind < 0.3:
            inside()
        elif kind < 0.75:
            name, neutral = r.choice(["div", "div", "section"]), r.choice(["", "", "", "container", "wrapper", "inner", "row", "col-md-8", "box", "x1 y2"])
            if r.random() < 0.4:
                self.tag("div", 1, lambda: self.tag(name, 1, inside, class_=neutral), class_=r.choice(["", "container", "row", "grid"]))
            else:
                self.tag(name, 1, inside, class_=neutral)
        else:
            def cells() -> None:
                if r.random() < 0.5:
                    self.tag("td", 0, menu)
                self.tag("td", 1, inside)
            self.tag("table", 1, lambda: self.tag("tr", 1, cells))


def layouts(n: int, seed: int = 11) -> list:
    """``n`` pages as (tree, label of every element); every second one is plain."""
    from memweave.llm.htmltext import Page

    found = []
    for k in range(n):
        writer = Writer(seed * 1_000_003 + k, plain=k % 2 == 1)
        page = Page(writer.page())
        if len(page.tag) != len(writer.label):
            raise ValueError("layout and parsed tree differ")
        found.append((page, np.array(writer.label, float)))
    return found
