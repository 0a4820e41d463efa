"""Labelled training pages for the extractor, drawn from layout rules.

Pages vary in nesting, in semantic tags against plain divs with class words, in the parts they have and in the length of
everything, so that no single cue settles a node. On a share of the pages the parts are named by invented words, which
leaves only tags, links, density and place to go by. Every node is labelled: 1 within the article, 0 within a part
to leave out, and 1 for containers that lead to the article.
"""

from __future__ import annotations

import random

LETTERS = "etaoinshrdlucmfwygpbvk"
#: class words per kind of part, the kinds being what the extractor has to tell apart
WORDS = {
    "article": "article content main post entry story body text prose news blog page single copy",
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs pagination pager tabs toc skip links topnav submenu",
    "header": "header masthead topbar logo branding site banner hero top brand",
    "footer": "footer copyright legal colophon bottom credits imprint",
    "side": "sidebar aside widget related recommended popular trending more rail side recent teaser tags categories",
    "notice": "cookie consent notice alert gdpr privacy popup modal overlay paywall message warning toast banner",
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion banner adsense dfp outbrain taboola",
    "form": "form search login signin signup register subscribe newsletter contact",
    "comments": "comment comments reply replies discussion disqus respond thread feedback responses",
    "share": "share sharing social follow facebook twitter like buttons author byline meta",
}


class Writer:
    def __init__(self, seed: int, invented: float = 0.0):
        self.r = random.Random(seed)
        self.words = {kind: words.split() for kind, words in WORDS.items()}
        own = random.Random(~seed)
        if own.random() < invented:
            self.words = {kind: ["".join(own.choice(LETTERS) for _ in range(own.randint(4, 10))) for _ in words] for kind, words in self.words.items()}

    def some(self, low: int, high: int) -> int:
        """Small numbers more often than large ones."""
        return low + int((high - low + 1) * self.r.random() ** 2)

    def word(self) -> str:
        return "".join(self.r.choice(LETTERS) for _ in range(self.r.randint(1, 9)))

    def line(self, low: int, high: int) -> str:
        words = [self.word() for _ in range(self.some(low, high))]
        if self.r.random() < 0.1:
            words = [w + self.r.choice(["!!", "%%%", " |", "&amp;"]) for w in words]
        return " ".join(words)

    def prose(self, high: int = 8) -> str:
        comma = lambda s: s.replace(" ", ", ", 1) if self.r.random() < 0.4 else s
        return " ".join(comma(self.line(1, 24)).capitalize() + "." for _ in range(self.some(1, high)))

    def attrs(self, kind: str, chance: float = 0.9) -> str:
        if self.r.random() > chance:
            return ""
        words = self.words[kind]
        mark = self.r.choice(words)
        if self.r.random() < 0.5:
            mark += self.r.choice(["-", "_", " "]) + self.r.choice(["wrap", "box", "area", "list", "inner", "1", "block", "item", self.word(), self.r.choice(words)])
        return f' {self.r.choice(["class", "class", "id", "role"])}="{mark}"'

    def part(self, kind: str, tags: list[str], inner: str, label: int = 0) -> str:
        """One part; ``data-y`` carries the label of the part's nodes."""
        semantic = self.r.random() < 0.55
        tag = self.r.choice(tags) if semantic else self.r.choice(["div", "div", "section"])
        plain = 0.75 if tag in ("nav", "header", "footer", "aside", "form", "article", "main") else 0.04
        return f'<{tag} data-y="{label}"{self.attrs(kind, 1 - plain)}>{inner}</{tag}>'

    def links(self, low: int = 2, high: int = 12) -> str:
        link = lambda: f'<a href="/{self.word()}">{self.line(1, 5)}</a>'
        n = self.some(low, high)
        if self.r.random() < 0.6:
            return "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(n)) + "</ul>"
        return self.r.choice([" ", " | ", "<br>"]).join(link() for _ in range(n))

    def any_text(self) -> str:
        return self.r.choice([self.prose(2), f"<p>{self.prose(4)}</p>", self.line(1, 8), f"<h3>{self.line(1, 6)}</h3><p>{self.prose(3)}</p>", f"<a href='/x'>{self.line(1, 9)}</a>"])

    def menu(self):
        return self.part("menu", ["nav"], self.links())

    def header(self):
        bits = [f"<h1>{self.line(1, 3)}</h1>", f"<a href='/'>{self.line(1, 2)}</a>", f"<p>{self.line(2, 9)}</p>", self.links(2, 6), f"<span>{self.line(1, 4)}</span>"]
        return self.part("header", ["header"], "".join(self.r.sample(bits, self.r.randint(1, 3))))

    def footer(self):
        bits = [f"&copy; {self.line(1, 5)}", f"<p>{self.prose(3)}</p>", self.links(2, 6), f"&copy; {self.word()}.{self.word()} &middot; {self.prose(2)}", f"<small>{self.line(3, 12)}</small>"]
        return self.part("footer", ["footer"], "".join(self.r.sample(bits, self.r.randint(1, 3))))

    def side(self):
        bits = "".join(self.r.choice([f"<h3>{self.line(1, 4)}</h3>{self.links()}", self.any_text(), f"<p>{self.prose(4)}</p>"]) for _ in range(self.some(1, 3)))
        return self.part("side", ["aside"], bits)

    def advert(self):
        return self.part("advert", ["aside", "ins", "div"], self.any_text())

    def notice(self):
        return self.part("notice", ["div", "dialog", "section"], self.any_text() + self.r.choice(["", "<button>ok</button>", f"<a href='#'>{self.line(1, 3)}</a>"]))

    def form(self):
        inner = self.r.choice(["", f"<p>{self.prose(2)}</p>", f"<h3>{self.line(1, 4)}</h3>"]) + f"<label>{self.line(1, 4)}</label><input name='{self.word()}'><button>{self.line(1, 2)}</button>"
        if self.r.random() < 0.3:
            inner += f"<select><option>{self.line(1, 2)}</option><option>{self.line(1, 3)}</option></select><textarea>{self.line(1, 9)}</textarea>"
        return f'<form data-y="0"{self.attrs("form", 0.6)}>{inner}</form>' if self.r.random() < 0.7 else self.part("form", ["div"], f"<form>{inner}</form>")

    def comments(self):
        one = lambda: f"<{(t := self.r.choice(['li', 'div', 'article']))}{self.attrs('comments', 0.6)}>{self.r.choice(['', f'<b>{self.word()}</b> ', f'<span>{self.line(1, 3)}</span>'])}<p>{self.prose(5)}</p></{t}>"
        items = "".join(one() for _ in range(self.some(1, 6)))
        return self.part("comments", ["section", "ol", "ul"], self.r.choice(["", f"<h2>{self.line(1, 3)}</h2>"]) + items)

    def share(self):
        return self.part("share", ["div", "ul"], self.r.choice([self.links(1, 4), self.line(1, 6), f"<span>{self.line(1, 5)}</span>"]))

    def paragraph(self) -> str:
        text = self.prose(14)
        roll = self.r.random()
        words = text.split()
        if roll < 0.3:
            k = self.r.randrange(len(words))
            words[k] = f"<{(t := self.r.choice(['b', 'em', 'strong', 'i', 'span', 'code']))}>{words[k]}</{t}>"
        elif roll < 0.5:
            k = self.r.randrange(len(words))
            words[k] = f"<a href='/{self.word()}'>{words[k]}</a>"
        text = " ".join(words)
        roll = self.r.random()
        if roll < 0.15:
            return f"<p><b>{text}<br>"
        return f"<p>{text}</p>" if roll < 0.93 else f"<div>{text}</div>"

    def body(self) -> str:
        out = [f"<h1>{self.line(2, 12)}</h1>"] if self.r.random() < 0.75 else []
        if self.r.random() < 0.2:
            out = [f"<header data-y='1'>{''.join(out)}<p>{self.line(2, 12)}</p></header>"]
        for _ in range(self.some(1, 16)):
            roll = self.r.random()
            if roll < 0.74:
                out.append(self.paragraph())
            elif roll < 0.82:
                out.append(f"<{(t := self.r.choice(['h2', 'h3']))}>{self.line(1, 8)}</{t}>")
            elif roll < 0.88:
                out.append("<ul>" + "".join(f"<li>{self.r.choice([self.line(1, 12), self.prose(2)])}</li>" for _ in range(self.some(2, 6))) + "</ul>")
            elif roll < 0.91:
                out.append(f"<blockquote><p>{self.prose(3)}</p></blockquote>")
            elif roll < 0.94:
                out.append("<table>" + "".join(f"<tr><td>{self.line(1, 4)}</td><td>{self.line(1, 4)}</td></tr>" for _ in range(self.some(2, 5))) + "</table>")
            elif roll < 0.96:
                out.append(f"<figure><img src='/x.png'><figcaption>{self.line(2, 12)}</figcaption></figure>")
            else:
                out.append(f"<pre><code>{self.line(2, 20)}</code></pre>")
            if self.r.random() < 0.06:
                out.append(self.r.choice([self.advert, self.share, self.side, self.form, self.notice])())
        return "".join(out)

    def page(self) -> str:
        chance = lambda p, f: f() if self.r.random() < p else ""
        article = self.part("article", ["article", "main"], self.body() + chance(0.1, self.share) + chance(0.08, self.comments), 1)
        for _ in range(self.some(0, 3)):
            around = [article]
            if self.r.random() < 0.35:
                around.append(self.r.choice([self.side, self.comments, self.advert, self.share])())
            if self.r.random() < 0.25:
                around.insert(0, self.r.choice([self.side, self.menu, self.advert, self.notice])())
            article = f'<{(t := self.r.choice(["div", "div", "main", "section"]))} data-y="1"{self.attrs("article", 0.5)}>{"".join(around)}</{t}>'
        before = [chance(0.6, self.header), chance(0.7, self.menu), chance(0.25, self.notice), chance(0.4, self.advert), chance(0.15, self.form)]
        after = [chance(0.35, self.comments), chance(0.4, self.side), chance(0.15, self.form), chance(0.25, self.advert), chance(0.75, self.footer), chance(0.2, self.notice)]
        return f"<html><body data-y='1'>{''.join(before)}{article}{''.join(after)}</body></html>"


def pages(count: int, seed: int = 5, invented: float = 0.0) -> list[str]:
    """``count`` pages; on a share ``invented`` of them no class word is one of WORDS."""
    return [Writer(seed * 100_003 + k, invented).page() for k in range(count)]
