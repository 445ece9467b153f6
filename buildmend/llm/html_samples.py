"""Generated pages whose content is marked, from which the page trees learn.

Layouts, element names, attribute words, nesting and texts vary by a seed.
Every piece of main text begins with a check mark.
"""

from __future__ import annotations

import random

SYLLABLES = "an be ca do el fi go ha in ju ka lo me no or pa qu ra se ti un ve wa xi yo za".split()


class Maker:
    def __init__(self, rng: random.Random):
        self.rng = rng
        #: Pages of one site are plain, named by class, or named by meaning.
        self.style = rng.choice(["plain", "class", "semantic", "mixed"])

    def words(self, n: int) -> str:
        out = []
        for _ in range(max(1, n)):
            w = "".join(self.rng.choice(SYLLABLES) for _ in range(self.rng.randint(1, 3)))
            out.append(w + self.rng.choice(["", "", "", "", "", ",", "."]))
        return " ".join(out).capitalize() + "."

    def box(self, inner: str, meaning: str, words: list[str]) -> str:
        """An element around ``inner`` that shows its purpose more or less."""
        rng, tag, attrs = self.rng, "div", ""
        shown = self.style if self.style != "mixed" else rng.choice(["plain", "class", "semantic"])
        if shown == "semantic" or (meaning in ("nav", "footer") and rng.random() < 0.5):
            tag = meaning
        if shown != "plain" and rng.random() < 0.7 or tag == "div" and rng.random() < 0.6:
            word = rng.choice(words)
            word = rng.choice([word, f"{word}-{rng.choice(['box', 'wrap', 'inner', 'block'])}", f"site-{word}", f"{word}Area"])
            attrs = f' {rng.choice(["class", "class", "id"])}="{word}"'
        for _ in range(rng.choice([0, 0, 0, 1])):
            inner = f"<div>{inner}</div>"
        return f"<{tag}{attrs}>{inner}</{tag}>"

    def links(self, n: int) -> str:
        rng = self.rng
        items = [f'<a href="/{i}">{self.words(rng.randint(1, 4)).rstrip(".")}</a>' for i in range(n)]
        kind = rng.choice(["ul", "ul", "ul", "plain", "p"])
        if kind == "ul":
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return (" | ".join(items)) if kind == "plain" else "".join(f"<p>{x}</p>" for x in items)

    def prose(self, low: int = 1, high: int = 120, mark: str = "✓") -> str:
        rng = self.rng
        body = self.words(rng.choice([rng.randint(low, 12), rng.randint(low, high)]))
        if rng.random() < 0.2:
            body += f' <a href="#">{self.words(2)}</a> {self.words(rng.randint(1, 20))}'
        if rng.random() < 0.15:
            return f"<p><b>{mark}{body}<br>" if rng.random() < 0.6 else f"<p>{mark}<i>{body}</i><br>{self.words(5)}</p>"
        return f"<p>{mark}{body}" + ("</p>" if rng.random() < 0.9 else "")

    def advert(self) -> str:
        return self.box(self.rng.choice(["", "<p>"]) + self.words(self.rng.randint(2, 25)), "aside", ["ad", "ads", "advert", "banner", "promo", "sponsored", "ad-slot"])

    def part(self) -> str:
        """A section of the article, whose name may be one that boxes around articles have too."""
        rng = self.rng
        named = rng.choice(["", "related-work", "contact", "side-effects", "top-level", "legal-notes", "reviews", "discussion", "social-studies", "advert-history"])
        head = f"<h2>✓{self.words(rng.randint(1, 5))}</h2>" if rng.random() < 0.7 else ""
        inner = head + "".join(self.prose(5) for _ in range(rng.randint(1, 4)))
        return f'<section class="{named}">{inner}</section>' if named else f"<{(tag := rng.choice(['section', 'div']))}>{inner}</{tag}>"

    def code(self) -> str:
        lines = "\n".join(f"{self.words(2).rstrip('.')} = {self.rng.randint(0, 99)};" for _ in range(self.rng.randint(1, 8)))
        return f"<pre>✓{lines}</pre>" if self.rng.random() < 0.6 else f"<pre><code>✓{lines}</code></pre>"

    def content(self) -> str:
        rng = self.rng
        parts = [f"<h1>✓{self.words(rng.randint(1, 12))}</h1>"] if rng.random() < 0.85 else []
        if parts and rng.random() < 0.25:
            parts = [f"<div>{parts[0]}</div>"]
        if rng.random() < 0.2:
            parts.append(self.box(self.words(4), "div", ["byline", "meta", "date", "share", "social"]))
        long = rng.random() < 0.06
        for _ in range(rng.randint(20, 150) if long else rng.choice([1, 2, rng.randint(3, 16)])):
            parts.append(self.prose(1, 12 if long and rng.random() < 0.5 else 120))
            chance = rng.random()
            if chance < 0.07:
                parts.append(f"<h2>✓{self.words(4)}</h2>")
            elif chance < 0.12:
                parts.append("<ul>" + "".join(f"<li>✓{self.words(rng.randint(3, 20))}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
            elif chance < 0.15:
                parts.append(f"<blockquote>✓{self.words(20)}</blockquote>")
            elif chance < 0.18:
                parts.append(self.advert())
            elif chance < 0.20:
                parts.append(f"<table><tr><td>✓{self.words(3)}</td><td>✓{self.words(3)}</td></tr></table>")
            elif chance < 0.22:
                parts.append(f"<figure><figcaption>✓{self.words(8)}</figcaption></figure>")
            elif chance < 0.25:
                parts.append(self.code())
            elif chance < 0.28:
                parts.append(self.part())
        inner = "".join(parts)
        if rng.random() < 0.12:
            inner = f"<header>{parts[0]}</header>" + "".join(parts[1:])
        kind = rng.choice(["article", "article", "main", "div", "section"])
        if kind == "div":
            return self.box(inner, "div", ["article", "content", "main", "post", "entry", "story", "body", "text"])
        return f"<{kind}>{inner}</{kind}>" if rng.random() < 0.7 else f'<{kind} class="{rng.choice(["post", "entry", "content"])}">{inner}</{kind}>'

    def comments(self) -> str:
        rng = self.rng
        each = "".join(self.box(f"<p>{self.words(2)}</p>" + self.prose(3, 50, ""), "div", ["comment", "reply", "comment-body"]) for _ in range(rng.randint(1, 5)))
        return self.box(f"<h3>{rng.choice(['Comments', 'Responses', self.words(1)])}</h3>" + each, "section", ["comments", "discussion", "respond", "replies", "disqus"])

    def page(self) -> str:
        rng, parts = self.rng, []
        if rng.random() < 0.3:
            parts.append(self.box(self.prose(5, 30, "") + "<button>OK</button>", "div", ["cookie", "consent", "notice", "alert", "popup"]))
        if rng.random() < 0.6:
            parts.append(self.box(rng.choice(["", f"<p>{self.words(3)}</p>", f"<h2>{self.words(2)}</h2>"]) + self.words(3), "header", ["header", "masthead", "logo", "top"]))
        if rng.random() < 0.85:
            parts.append(self.box(self.links(rng.randint(2, 9)), "nav", ["nav", "menu", "navbar", "breadcrumbs"]))
        if rng.random() < 0.6:
            parts.append(self.advert())
        side = self.box(f"<h3>{self.words(2)}</h3>" + rng.choice([self.links(rng.randint(2, 7)), self.prose(5, 30, "")]), "aside", ["sidebar", "side", "widget", "related", "popular"])
        if rng.random() < 0.25:
            parts.append(side)
        if rng.random() < 0.15:
            parts.append(f"<div><h1>✓{self.words(rng.randint(2, 12))}</h1></div>")
        parts.append(self.content())
        if rng.random() < 0.35:
            parts.append(self.comments())
        if rng.random() < 0.3:
            parts.append(f"<form>{self.words(4)}<input><label>{self.words(2)}</label></form>" if rng.random() < 0.6 else self.box(f"<p>{self.words(5)}</p><input>", "form", ["newsletter", "subscribe", "search", "login"]))
        if rng.random() < 0.3:
            parts.append(side)
        if rng.random() < 0.25:
            parts.append(self.advert())
        if rng.random() < 0.9:
            parts.append(self.box(f"&copy; {self.words(rng.randint(1, 14))}" + rng.choice(["", self.links(3)]), "footer", ["footer", "copyright", "legal", "bottom"]))
        inner = "".join(parts)
        for _ in range(rng.choice([0, 0, 1, 2])):
            inner = f'<div id="{rng.choice(["page", "wrap", "container", "root"])}">{inner}</div>'
        return f"<html><head><title>t</title></head><body>{inner}</body></html>"


def labelled_pages(n: int, seed: int):
    rng = random.Random(seed)
    for _ in range(n):
        yield Maker(rng).page()
