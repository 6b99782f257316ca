"""Labelled example pages, from which the extractor learns what surrounds an article.

Pages follow a small grammar: an article between page furniture of the usual sorts, in varying
order, marked up by sectioning elements, by names in attributes, or by neither. Words are
invented. Every element knows whether it holds main text.
"""

from __future__ import annotations

import numpy as np

NAMES = {  # words that page authors put into class and id
    "nav": "nav navbar menu navigation breadcrumb breadcrumbs topnav mainmenu pagination pager toc",
    "ad": "ad ads advert advertisement banner sponsor sponsored promo promotion adsense adbox",
    "side": "sidebar side aside widget widgets rail secondary related recommended popular trending",
    "head": "header masthead topbar logo branding site",
    "foot": "footer bottom copyright colophon legal imprint credits",
    "comment": "comment comments commentlist discussion respond reply replies disqus reviews thread",
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay newsletter subscribe signup paywall disclaimer",
    "share": "share sharing social follow tags meta byline buttons toolbar login search",
    "content": "content article post entry story main text body prose article-body entry-content post-content hentry",
}
SETS = {kind: frozenset(names.replace("-", " ").split()) for kind, names in NAMES.items()}


class PageMaker:
    def __init__(self, seed: int) -> None:
        self.draw = np.random.default_rng(seed)
        letters = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "la", "que"]
        self.syllables = letters + ["ion", "ment", "sch", "ung", "os", "ar", "ei", "ou"]

    def chance(self, p: float) -> bool:
        return bool(self.draw.random() < p)

    def pick(self, options):
        return options[int(self.draw.integers(len(options)))]

    def words(self, low: int, high: int) -> str:
        made = []
        for _ in range(int(self.draw.integers(low, high + 1))):
            word = "".join(self.pick(self.syllables) for _ in range(int(self.draw.integers(1, 4))))
            made.append(word + ("." if self.chance(0.08) else "," if self.chance(0.06) else ""))
        return " ".join(made).capitalize() + ("." if self.chance(0.8) else "")

    def names(self, kind: str) -> str:
        name = self.pick(NAMES[kind].split())
        if self.chance(0.3):
            name = f"{self.pick(['site', 'page', 'c', 'js', 'main', 'block'])}-{name}"
        if self.chance(0.2):
            name += f" {self.pick(['col', 'row', 'box', 'inner', 'clearfix', 'x1'])}"
        return f' {self.pick(["class", "class", "id"])}="{name}"'

    def plain(self) -> str:
        return f' class="{self.pick(["c", "col", "row", "x", "box", "wrap"])}{self.draw.integers(99)}"'

    def box(self, kind: str, tags: list[str], inside: str, label: int) -> str:
        """An element for `inside`: a fitting tag, a telling name, or (rarely) neither."""
        way = self.draw.random()
        tag = self.pick(tags) if way < 0.5 else self.pick(["div", "div", "section"])
        named = self.names(kind) if way > 0.45 and way < 0.92 else self.plain() if self.chance(0.3) else ""
        return f'<{tag} data-label="{label}"{named}>{inside}</{tag}>'

    def item_list(self, low: int, high: int, words: tuple[int, int], label: int) -> str:
        items = []
        for _ in range(int(self.draw.integers(low, high + 1))):
            text = self.words(*words)
            linked = not label and self.chance(0.9)
            items.append(f"<li>{f'<a href=/{text[:4]}>{text}</a>' if linked else text}</li>")
        tag = self.pick(["ul", "ul", "ol"])
        return f"<{tag}>{''.join(items)}</{tag}>"

    def paragraph(self, low: int, high: int) -> str:
        text = self.words(low, high)
        if self.chance(0.25):
            text = f"<{(t := self.pick(['b', 'i', 'em', 'a href=/x', 'span']))}>{text}</{t.split()[0]}> {self.words(3, 20)}"
        if self.chance(0.15):
            text += f"<br>{self.words(2, 20)}"
        return f"<p>{text}" + ("</p>" if self.chance(0.8) else "")

    def article(self) -> str:
        parts = [f"<h1>{self.words(2, 9)}</h1>"] if self.chance(0.85) else []
        size = (1, 12) if self.chance(0.35) else (10, 120)
        for _ in range(1 if self.chance(0.2) else int(self.draw.integers(1, 14))):
            kind = self.draw.random()
            if kind < 0.78:
                parts.append(self.paragraph(*((1, 6) if self.chance(0.15) else size)))
            elif kind < 0.84:
                parts.append(f"<{(t := self.pick(['h2', 'h3']))}>{self.words(2, 7)}</{t}>")
            elif kind < 0.89:
                parts.append(self.item_list(2, 6, (3, 25), 1))
            elif kind < 0.92:
                parts.append(f"<blockquote>{self.paragraph(8, 40)}</p></blockquote>")
            elif kind < 0.94:
                parts.append(f"<table><tr><td>{self.words(1, 4)}<td>{self.words(1, 4)}</table>")
            elif kind < 0.96:
                parts.append(f"<div{self.plain()}>{self.words(8, 60)}</div>")
            else:
                parts.append(self.pick([self.ad, self.share, self.related])())
        inside = "".join(parts)
        if self.chance(0.3):
            inside = f'<div data-label="1"{self.names("content") if self.chance(0.5) else ""}>{inside}</div>'
        if self.chance(0.3):
            inside = f'<header data-label="1">{parts[0]}</header>{inside}' if "<h1" in parts[0] else inside
        return self.box("content", ["article", "article", "main"], inside, 1)

    def navigation(self) -> str:
        return self.box("nav", ["nav"], self.item_list(2, 10, (1, 3), 0), 0)

    def top(self) -> str:
        inside = f"<div>{self.words(1, 4)}</div>" + (self.form() if self.chance(0.3) else "")
        inside += self.navigation() if self.chance(0.4) else f"<p>{self.words(2, 8)}</p>"
        return self.box("head", ["header"], inside, 0)

    def form(self) -> str:
        return f'<form data-label="0"><label>{self.words(1, 4)}</label><input name=q><p>{self.words(2, 10)}</p><button>{self.words(1, 2)}</button></form>'

    def ad(self) -> str:
        text = self.words(3, 30)
        return self.box("ad", ["aside", "ins"], text if self.chance(0.6) else f"<p><a href=/ad>{text}</a></p>", 0)

    def share(self) -> str:
        return self.box("share", ["div"], self.item_list(2, 5, (1, 2), 0), 0)

    def related(self) -> str:
        return self.box("side", ["aside"], f"<h3>{self.words(1, 4)}</h3>{self.item_list(2, 6, (2, 9), 0)}", 0)

    def side(self) -> str:
        inside = "".join(
            self.pick([self.related, self.ad, self.form, lambda: f"<p>{self.words(4, 40)}</p>"])()
            for _ in range(int(self.draw.integers(1, 4)))
        )
        return self.box("side", ["aside"], inside, 0)

    def notice(self) -> str:
        inside = f"<p>{self.words(6, 40)}</p>" if self.chance(0.6) else self.words(6, 40)
        return self.box("notice", ["div", "dialog"], inside, 0)

    def comments(self) -> str:
        one = lambda: f"<div{self.names('comment')}><p>{self.words(1, 3)}</p>{self.paragraph(3, 50)}</div>"
        many = "".join(one() for _ in range(int(self.draw.integers(1, 7))))
        if self.chance(0.4):
            many = "".join(f"<li>{self.paragraph(3, 50)}</li>" for _ in range(3))
            many = f"<ol{self.names('comment')}>{many}</ol>"
        inside = f"<h3>{self.words(1, 3)}</h3>{many}{self.form() if self.chance(0.3) else ''}"
        return f'<{(t := self.pick(["section", "div", "div", "aside"]))} data-label="0"{self.names("comment")}>{inside}</{t}>'

    def footer(self) -> str:
        inside = f"&copy; {self.words(1, 4)} &middot; {self.words(2, 40)}"
        if self.chance(0.5):
            inside = f"<p>{inside}</p>{self.item_list(2, 6, (1, 3), 0)}"
        return self.box("foot", ["footer"], inside, 0)

    def page(self) -> str:
        """A page whose elements carry `data-label` where the label changes."""
        maybe = lambda part, p: part() if self.chance(p) else ""
        before = [maybe(self.top, 0.5), maybe(self.navigation, 0.7), maybe(self.ad, 0.5), maybe(self.notice, 0.35)]
        after = [maybe(self.share, 0.25), maybe(self.related, 0.25), maybe(self.comments, 0.4)]
        order = self.draw.permutation(len(before))
        middle = self.article() + "".join(after)
        if self.chance(0.5):
            middle = f'<div data-label="1"{self.plain()}>{middle}{maybe(self.side, 0.5)}</div>'
        else:
            middle += maybe(self.side, 0.4)
        inside = "".join(before[i] for i in order) + middle + maybe(self.ad, 0.2) + maybe(self.notice, 0.2) + maybe(self.footer, 0.8)
        if self.chance(0.3):
            inside = f'<div data-label="1"{self.plain()}>{inside}</div>'
        title = f"<title>{self.words(2, 8)}</title>"
        return f'<!DOCTYPE html><html data-label="1"><head>{title}</head><body>{inside}</body></html>'
