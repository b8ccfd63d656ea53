"""Labelled pages to learn from: layouts drawn from a seed, every part marked as main text or not by ``data-main``.

Layouts differ in their elements, names, nesting and order; one part in four has names that say nothing, so that amounts of
text, links and punctuation must tell it. Words are drawn syllables.
"""

from __future__ import annotations

import random

#: Words that sites use in class and id for parts beside the main text, by part, and for the main text.
ROLES = {
    "menu": "nav menu navbar navigation breadcrumb toc pagination tabs",
    "header": "header masthead topbar logo branding banner",
    "footer": "footer bottom copyright legal colophon",
    "sidebar": "sidebar aside related recommended popular trending widget rail secondary more",
    "notice": "cookie consent notice alert gdpr popup modal newsletter subscribe overlay promo warning",
    "advert": "ad ads advert advertisement sponsor sponsored adsense banner dfp",
    "form": "form search login signup contact",
    "share": "share social sharing follow tags meta",
    "comments": "comments comment reply replies respond discussion disqus feedback reviews",
}
MAIN = "article content main post entry story body text prose page"
BESIDE = frozenset(w for words in ROLES.values() for w in words.split()) - {"header", "meta", "page"}


class _Layout:
    def __init__(self, seed: int) -> None:
        self.r = random.Random(seed)
        syllables = ["".join(self.r.choice(x) for x in ("bcdfglmnprstvz", "aeiouéü", ["", "n", "r", "s"])) for _ in range(60)]
        self.words = ["".join(self.r.choices(syllables, k=self.r.choice([1, 2, 2, 3]))) for _ in range(300)]
        self.plain = self.r.random() < 0.25  # names say nothing
        self.semantic = self.r.random()

    def some(self, low: int, high: int) -> str:
        return " ".join(self.r.choices(self.words, k=self.r.randint(low, high)))

    def sentences(self, low: int, high: int) -> str:
        return " ".join(self.some(4, 16).capitalize() + self.r.choice([".", ".", ".", "?", "!"]) for _ in range(self.r.randint(low, high)))

    def name(self, words: str) -> str:
        if self.plain or self.r.random() < 0.08:
            return f' class="{self.r.choice(["c", "x", "box", "u"])}{self.r.randint(1, 99)}"'
        word = self.r.choice(words.split())
        word = self.r.choice([word, f"site-{word}", f"{word}-{self.r.choice(['wrapper', 'box', 'inner', 'area', 'list', 'block'])}", f"js_{word}", f"{word}{self.r.randint(1, 9)}"])
        return f' {self.r.choice(["class", "class", "id"])}="{word}"'

    def links(self, low: int, high: int, tag: str = "li") -> str:
        return "".join(f'<{tag}><a href="/{self.some(1, 1)}">{self.some(1, 6).capitalize()}</a></{tag}>' for _ in range(self.r.randint(low, high)))

    def part(self, element: str, words: str, inside: str, main: int = 0) -> str:
        tag = element if self.r.random() < self.semantic else "div"
        return f'<{tag}{self.name(words)} data-main="{main}">{inside}</{tag}>'

    def menu(self) -> str:
        return self.part("nav", ROLES["menu"], f"<ul>{self.links(3, 9)}</ul>")

    def header(self) -> str:
        return self.part("header", ROLES["header"], f"<h1>{self.some(1, 4)}</h1><p>{self.some(2, 8)}</p>" if self.r.random() < 0.5 else f'<a href="/">{self.some(1, 3)}</a>')

    def footer(self) -> str:
        mark = self.r.choice(["&copy; ", "© 2020 ", ""])
        return self.part("footer", ROLES["footer"], self.r.choice([f"{mark}{self.some(1, 3)} &middot; {self.sentences(1, 2)}", f"<p>{mark}{self.some(2, 6)}</p><ul>{self.links(2, 6)}</ul>"]))

    def sidebar(self) -> str:
        inside = "".join(self.r.choice([f"<h3>{self.some(1, 3)}</h3><ul>{self.links(2, 6)}</ul>", f"<h4>{self.some(1, 4)}</h4><p>{self.sentences(1, 2)}</p>"]) for _ in range(self.r.randint(1, 3)))
        return self.part("aside", ROLES["sidebar"], inside)

    def advert(self) -> str:
        return self.part("div", ROLES["advert"], self.r.choice([self.sentences(1, 2), f'<a href="/x">{self.some(2, 9)}</a>', f"<p>{self.sentences(1, 1)}</p>"]))

    def notice(self) -> str:
        return self.part("div", ROLES["notice"], f"<p>{self.sentences(1, 3)}</p>{self.r.choice(['', '<button>ok</button>'])}")

    def form(self) -> str:
        return f'<form{self.name(ROLES["form"])} data-main="0"><label>{self.some(1, 3)}</label><input type="text"><p>{self.some(1, 9)}</p><button>{self.some(1, 2)}</button></form>'

    def share(self) -> str:
        return self.part("div", ROLES["share"], self.r.choice([f"<ul>{self.links(2, 5)}</ul>", self.some(1, 6)]))

    def comments(self) -> str:
        tag = self.r.choice(["div", "li", "article"]) if not self.plain else "div"
        one = lambda: f'<{tag}{self.name("comment reply")}><p>{self.some(1, 2)}</p><p>{self.sentences(1, 5)}</p></{tag}>'
        inside = f"<h3>{self.some(1, 3)}</h3>" + "".join(one() for _ in range(self.r.randint(1, 5)))
        words = ROLES["comments"]
        if self.plain:  # nothing else would tell a reader's text from the author's
            return f'<section id="comments" data-main="0">{inside}</section>'
        return self.part("section", words, inside)

    def main(self) -> str:
        blocks = [f"<h1>{self.some(2, 9).capitalize()}</h1>"] if self.r.random() < 0.85 else []
        if blocks and self.r.random() < 0.25:
            blocks = [f"<header>{blocks[0]}<p>{self.some(2, 6)}</p></header>"]
        for _ in range(self.r.choice([1, 2, 4, 8, 14])):
            kind = self.r.random()
            if kind < 0.68:
                blocks.append(f"<p>{self.r.choice(['', '<b>'])}{self.sentences(1, 7)}{self.r.choice(['</p>', '</p>', '<br>', ''])}")
            elif kind < 0.76:
                blocks.append(f"<h2>{self.some(1, 6)}</h2>")
            elif kind < 0.82:
                blocks.append("<ul>" + "".join(f"<li>{self.sentences(1, 2)}</li>" for _ in range(self.r.randint(2, 5))) + "</ul>")
            elif kind < 0.87:
                blocks.append(f"<blockquote><p>{self.sentences(1, 3)}</p></blockquote>")
            elif kind < 0.91:
                blocks.append("<table>" + "".join(f"<tr><td>{self.some(1, 2)}</td><td>{self.some(1, 4)}</td></tr>" for _ in range(3)) + "</table>")
            elif kind < 0.94:
                blocks.append(f"<figure><img src=x><figcaption>{self.some(3, 9)}.</figcaption></figure>")
            else:
                blocks.append(f'<p>{self.sentences(1, 2)} <a href="/y">{self.some(1, 4)}</a> {self.sentences(1, 2)}</p>')
        for other, chance in ((self.advert, 0.2), (self.share, 0.25), (self.sidebar, 0.12), (self.notice, 0.1), (self.form, 0.08), (self.menu, 0.08), (self.comments, 0.12)):
            if self.r.random() < chance:
                at = self.r.randint(1, len(blocks)) if other is not self.comments else len(blocks)
                blocks.insert(at, other())
        return self.part(self.r.choice(["article", "article", "main", "section"]), MAIN, "".join(blocks), 1)

    def wrapped(self, inside: str) -> str:
        for _ in range(self.r.choice([0, 0, 1, 2])):
            inside = f'<div{self.name("wrapper container row col page layout outer main content")}>{inside}</div>'
        return inside

    def page(self) -> str:
        maybe = lambda chance, part: part() if self.r.random() < chance else ""
        middle = [self.main()]
        middle.insert(self.r.randint(0, 1), maybe(0.4, self.sidebar))
        middle = maybe(0.3, self.advert) + "".join(middle) + maybe(0.35, self.comments) + maybe(0.15, self.sidebar)
        top = maybe(0.5, self.notice) + maybe(0.5, self.header) + maybe(0.8, self.menu) + maybe(0.2, self.form) + maybe(0.4, self.advert)
        bottom = maybe(0.2, self.advert) + maybe(0.15, self.form) + maybe(0.8, self.footer) + maybe(0.15, self.notice)
        return f"<html><body>{self.wrapped(top + self.wrapped(middle) + bottom)}</body></html>"


def layouts(count: int, seed: int = 1) -> list[str]:
    """``count`` labelled pages."""
    return [_Layout(seed * 1_000_003 + k).page() for k in range(count)]
