"""Pages of known layout for training: real lines of text in random page furniture."""

from __future__ import annotations

import html
import random
from collections.abc import Sequence

# Words that authors of pages commonly use in classes and ids, by what stands in such elements.
WORDS = {
    "wrap": "container wrapper page site layout row inner outer col grid root app".split(),
    "main": "article post entry content main story body text article-body post-content entry-content page-content articleBody story-text prose single".split(),
    "header": "header masthead site-header top branding page-header top-bar logo hero".split(),
    "menu": "nav menu navigation topnav navbar main-menu breadcrumbs breadcrumb pagination site-nav links tabs toolbar skip-link".split(),
    "notice": "cookie cookie-banner consent notice gdpr alert popup modal overlay message announcement privacy-notice warning".split(),
    "advert": "ad ads advert advertisement sponsored sponsor promo ad-slot adsbox banner-ad promotion google-ad".split(),
    "aside": "sidebar side widget related recommended trending popular more-stories secondary teaser aside read-next tags share social author-box newsletter".split(),
    "comments": "comments comment-list responses discussion disqus replies reader-comments comment commentlist reply user-comment thread feedback".split(),
    "footer": "footer site-footer copyright legal bottom colophon foot page-footer credits".split(),
    "form": "form search login subscribe signup newsletter-form contact-form search-form respond".split(),
}
TAGS = {
    "main": ["article", "main", "div", "div", "section"], "header": ["header", "header", "div"], "menu": ["nav", "nav", "div", "ul"], "notice": ["div", "div", "section", "aside", "dialog"], "advert": ["div", "div", "aside", "section"],
    "aside": ["aside", "aside", "div", "section"], "comments": ["section", "div", "div", "aside"], "footer": ["footer", "footer", "div"], "form": ["form"],
}


class Layout:
    """Builds one page.  Elements with main text are marked data-main="1", those of furniture "0"."""

    def __init__(self, rng: random.Random, lines: Sequence[str], words: Sequence[str]):
        self.rng, self.lines, self.words = rng, lines or ["A line."], words or ["word"]
        self.bare, self.plain = rng.random() < 0.15, rng.random() < 0.35  # no names at all; no elements that say what they hold
        if self.bare:
            self.plain = rng.random() < 0.3

    def some(self, low: int, high: int) -> str:
        return html.escape(" ".join(self.rng.choice(self.words) for _ in range(self.rng.randint(low, high))), quote=False)

    def line(self) -> str:
        return html.escape(self.rng.choice(self.lines), quote=False)

    def attributes(self, role: str, main: int | None = None) -> str:
        out = "" if main is None else f' data-main="{main}"'
        if not self.bare and self.rng.random() < 0.85:
            names = [self.rng.choice(WORDS[role])]
            if self.rng.random() < 0.3:
                names.append(self.rng.choice(WORDS[role] + WORDS["wrap"]))
            out += f' {self.rng.choice(["class", "class", "id"])}="{" ".join(names)}"'
        return out

    def tag(self, role: str) -> str:
        return "div" if self.plain and role not in ("form",) else self.rng.choice(TAGS[role])

    def block(self, role: str, inside: str, main: int = 0, tag: str | None = None) -> str:
        tag = tag or self.tag(role)
        return f"<{tag}{self.attributes(role, main)}>{inside}</{tag}>"

    def menu(self, low: int = 3, high: int = 9) -> str:
        links = [f'<a href="/{k}">{self.some(1, 3)}</a>' for k in range(self.rng.randint(low, high))]
        how = self.rng.random()
        return "<ul>" + "".join(f"<li>{x}</li>" for x in links) + "</ul>" if how < 0.65 else self.rng.choice([" | ", " ", " &raquo; "]).join(links)

    def sentences(self, low: int, high: int) -> str:
        text = [self.some(3, 25).capitalize() + self.rng.choice([".", ".", "!", "?"]) for _ in range(self.rng.randint(low, high))]
        return " ".join(text) if self.rng.random() < 0.5 else "".join(f"<p>{t}</p>" for t in text)

    def form(self) -> str:
        return self.block("form", f'<label>{self.some(1, 4)}</label><input type="text" name="q"><button>{self.some(1, 2)}</button>' + (f"<p>{self.some(3, 20)}.</p>" if self.rng.random() < 0.4 else ""))

    def header(self) -> str:
        parts = [self.rng.choice([f'<a href="/">{self.some(1, 3)}</a>', f"<p>{self.some(2, 8)}</p>", f"<h1>{self.some(1, 3)}</h1>", f"<div>{self.some(1, 4)}</div>"])]
        if self.rng.random() < 0.5:
            parts.append(self.block("menu", self.menu()))
        if self.rng.random() < 0.3:
            parts.append(self.form())
        return self.block("header", "".join(parts))

    def notice(self) -> str:
        return self.block("notice", self.sentences(1, 3) + (f'<a href="/privacy">{self.some(1, 3)}</a>' if self.rng.random() < 0.5 else "") + ("<button>OK</button>" if self.rng.random() < 0.5 else ""))

    def advert(self) -> str:
        return (f"<!-- ad {self.rng.randint(0, 99)} -->" if self.rng.random() < 0.3 else "") + self.block("advert", self.sentences(1, 3) if self.rng.random() < 0.7 else f'<a href="/out">{self.some(2, 12)}</a>')

    def aside(self) -> str:
        parts = []
        for _ in range(self.rng.randint(1, 3)):
            title = f"<h{(k := self.rng.randint(2, 4))}>{self.some(1, 4)}</h{k}>"
            parts.append(self.block("aside", title + self.rng.choice([self.menu(2, 8), self.sentences(1, 3), f'<div><a href="/x">{self.some(4, 12)}</a><p>{self.some(8, 30)}.</p></div>' * self.rng.randint(1, 3)]), tag="div"))
        return self.block("aside", "".join(parts))

    def comments(self) -> str:
        each = []
        for _ in range(self.rng.randint(1, 8)):
            says = "".join(f"<p>{self.line() if self.rng.random() < 0.4 else self.some(3, 40) + '.'}</p>" for _ in range(self.rng.randint(1, 3)))
            who = self.rng.choice([f"<b>{self.some(1, 2)}</b> ", f'<a href="/u">{self.some(1, 2)}</a> ', f"<div>{self.some(1, 2)}, {self.rng.randint(1, 28)}.{self.rng.randint(1, 12)}.</div>", ""])
            each.append(who + says + (f'<a href="#r">{self.some(1, 1)}</a>' if self.rng.random() < 0.4 else ""))
        listed = self.rng.random() < 0.4
        inside = "<ol>" + "".join(f"<li{self.attributes('comments')}>{x}</li>" for x in each) + "</ol>" if listed else "".join(f"<div{self.attributes('comments')}>{x}</div>" for x in each)
        title = f"<h{(k := self.rng.randint(2, 4))}>{self.some(1, 3)}</h{k}>" if self.rng.random() < 0.6 else ""
        return self.block("comments", title + inside + (self.form() if self.rng.random() < 0.4 else ""))

    def footer(self) -> str:
        parts = [self.rng.choice([f"&copy; {self.some(1, 3)} &middot; {self.some(3, 25)}.", f"<p>&copy; 20{self.rng.randint(10, 25)} {self.some(1, 4)}</p>", f"<div>{self.some(4, 30)}.</div>"])]
        if self.rng.random() < 0.5:
            parts.insert(self.rng.randint(0, 1), self.menu())
        return self.block("footer", "".join(parts))

    def article(self) -> str:
        rng, parts = self.rng, []
        if rng.random() < 0.8:
            parts.append(f"<h1>{self.some(2, 12)}</h1>")
        how = rng.random()
        start = rng.randrange(len(self.lines))
        for k in range(rng.choice([1, 2, 4, 8, 15, 30])):
            text = html.escape(self.lines[(start + k) % len(self.lines)], quote=False)
            kind = rng.random()
            if how < 0.1:
                parts.append(f"{text}<br><br>" if kind < 0.8 else f"<div>{text}</div>")
            elif kind < 0.75:
                parts.append((f"<p>{text}</p>", f"<p>{text}\n", f"<div>{text}</div>", f"<p><b>{text}<br>")[0 if kind < 0.5 or how > 0.35 else rng.randint(0, 3)])
            elif kind < 0.81:
                parts.append(f"<h{(z := rng.randint(2, 4))}>{self.some(1, 8)}</h{z}>")
            elif kind < 0.86:
                parts.append("<ul>" + "".join(f"<li>{self.line() if rng.random() < 0.5 else self.some(1, 12)}</li>" for _ in range(rng.randint(2, 6))) + "</ul>")
            elif kind < 0.9:
                parts.append(f"<blockquote><p>{text}</p></blockquote>")
            elif kind < 0.93:
                parts.append(f'<p>{text} <a href="/in">{self.some(1, 4)}</a> {self.some(2, 12)}.</p>')
            elif kind < 0.95:
                parts.append("<table>" + "".join("<tr>" + "".join(f"<td>{self.some(1, 3)}</td>" for _ in range(3)) + "</tr>" for _ in range(rng.randint(2, 4))) + "</table>")
            elif kind < 0.97:
                parts.append(f"<figure><img src='i.png'><figcaption>{self.some(3, 15)}</figcaption></figure>")
            else:
                parts.append(self.block("advert", self.sentences(1, 3), tag=rng.choice(["div", "aside"])) if rng.random() < 0.6 and not self.bare else self.block("aside", self.menu(2, 5)))
        inside = "".join(parts)
        if rng.random() < 0.25:
            inside = f"<div{self.attributes('main')}>{inside}</div>"
        if rng.random() < 0.2:
            inside += self.block("aside", self.menu(2, 6))
        return self.block("main", inside, 1)

    def page(self) -> str:
        rng = self.rng
        head = [f for f, p in ((self.header, 0.7), (lambda: self.block("menu", self.menu()), 0.6), (self.notice, 0.35), (self.advert, 0.4), (self.aside, 0.15)) if rng.random() < p]
        if rng.random() < 0.2:
            rng.shuffle(head)
        tail = [f for f, p in ((self.advert, 0.2), (self.aside, 0.35), (self.comments, 0.4), (self.notice, 0.15), (self.form, 0.15)) if rng.random() < p]
        rng.shuffle(tail)
        middle = [self.article, *tail]
        if rng.random() < 0.15:
            middle.insert(0, self.aside)
        center = "".join(f() for f in middle)
        if rng.random() < 0.08:
            center = f"<table><tr><td>{self.menu()}</td><td>{center}</td></tr></table>"
        elif rng.random() < 0.5:
            center = f"<div{self.attributes('wrap')}>{center}</div>"
        body = "".join(f() for f in head) + center + (self.footer() if rng.random() < 0.75 else "")
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            body = f"<div{self.attributes('wrap')}>{body}</div>"
        return f"<!DOCTYPE html><html><head><title>{self.some(2, 9)}</title><script>var t='</p>';</script></head><body>{body}</body></html>"


def training_pages(lines: Sequence[str], n: int, seed: int = 0) -> list[str]:
    """`n` pages whose article lines are consecutive ones of `lines`, whose furniture is made of their words."""
    rng = random.Random(seed)
    words = [w for line in lines[:2000] for w in line.split()[:60]]
    return [Layout(rng, lines, words).page() for _ in range(n)]
