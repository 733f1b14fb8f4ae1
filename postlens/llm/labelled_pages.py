"""Labelled pages for training, laid out by rule from a seed.

Every element whose text is known carries ``data-y`` (1: main text, 0: not);
text takes the mark of its nearest marked ancestor.  Words are invented, so
that layout and not vocabulary is learnt.
"""

from __future__ import annotations

import random

_SYLLABLES = "an ber con da el fi gor hu in jo ka lem mo nu or pa que ri sol tu un vi wer xa yo ze th ing er".split()

# Names that page templates commonly give to their parts.
MENU = ["nav", "menu", "navbar", "main-menu", "navigation", "topnav", "breadcrumbs", "pagination", "toc", "links"]
HEADER = ["header", "masthead", "site-header", "top-bar", "branding", "page-header"]
FOOTER = ["footer", "site-footer", "copyright", "bottom", "colophon", "legal"]
SIDE = ["sidebar", "aside", "widget", "rail", "right-col", "related", "recommended", "most-read", "tags", "author-bio"]
ADVERT = ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner", "ad-slot", "adsense"]
NOTICE = ["notice", "cookie", "cookie-banner", "consent", "alert", "gdpr", "popup", "modal", "message", "disclaimer", "warning"]
FORM = ["newsletter", "subscribe", "signup", "login", "search", "search-form", "contact-form", "poll"]
COMMENT = ["comments", "comment", "comment-list", "replies", "discussion", "responses", "reader-comments", "disqus"]
SHARE = ["share", "social", "share-buttons", "follow"]
CONTENT = ["content", "article", "post", "entry-content", "post-body", "story", "main-text", "article-body", "text", "entry"]


class Page:
    """One page under construction."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.semantic = self.r.random() < 0.6
        self.noise = self.r.choice(["plain", "plain", "plain", "upper", "symbols", "short", "pipes", "long"])

    def word(self) -> str:
        return "".join(self.r.choice(_SYLLABLES) for _ in range(self.r.choice((1, 1, 2, 2, 3, 4))))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def sentence(self, low: int = 1, high: int = 25) -> str:
        w = self.words(low, high).capitalize()
        if self.r.random() < 0.3 and " " in w:
            w = w.replace(" ", ", ", 1)
        return w + self.r.choice("....?!")

    def prose(self) -> str:
        """A paragraph of the main text, in the page's manner of writing."""
        n = self.r.choice((1, 1, 2, 3, 5, 9)) if self.noise != "long" else self.r.randint(5, 25)
        if self.noise == "short":
            return self.words(1, 3).capitalize() + self.r.choice(("", ".", "."))
        t = " ".join(self.sentence() for _ in range(n))
        if self.noise == "upper":
            t = " ".join(x.upper() + "!!" for x in t.split())
        elif self.noise == "symbols":
            t = " ".join(x + self.r.choice(("&amp;&amp;&amp;", "###", "***", "$$$", "%%%")) for x in t.split())
        elif self.noise == "pipes":
            t = t.replace(" ", " | ")
        if self.r.random() < 0.15:
            t = f"{t} <a href='/{self.word()}'>{self.words(1, 3)}</a> {self.sentence()}"
        if self.r.random() < 0.2:
            t = f"<{(k := self.r.choice(('b', 'i', 'em', 'strong', 'span')))}>{t}</{k}>"
        return t

    def wrap(self, tag: str, names: list[str] | None, y: int | None, inside: str, sure: bool = False) -> str:
        mark = "" if y is None else f" data-y={y}"
        if names and (sure or self.r.random() < 0.85):
            mark += f' {self.r.choice(("class", "class", "id"))}="{self.r.choice(names)}"'
        return f"<{tag}{mark}>{inside}</{tag}>"

    def links(self, low: int = 3, high: int = 12) -> str:
        items = [f"<a href='/{self.word()}'>{self.words(1, 4)}</a>" for _ in range(self.r.randint(low, high))]
        if self.r.random() < 0.7:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return self.r.choice((" | ", " ", " &raquo; ")).join(items)

    def menu(self) -> str:
        if self.semantic:
            return self.wrap("nav", MENU if self.r.random() < 0.3 else None, 0, self.links())
        return self.wrap("div", MENU, 0, self.links(), True)

    def header(self) -> str:
        inside = f"<a href='/'>{self.words(1, 3)}</a>" + (f"<p>{self.sentence(2, 8)}</p>" if self.r.random() < 0.5 else "")
        inside += self.menu() if self.r.random() < 0.5 else ""
        return self.wrap("header" if self.semantic else "div", HEADER, 0, inside, not self.semantic)

    def footer(self) -> str:
        inside = f"&copy; {self.words(1, 3)} &middot; {self.sentence(2, 14)}"
        if self.r.random() < 0.5:
            inside = f"<p>{inside}</p>" + (self.links() if self.r.random() < 0.5 else "")
        return self.wrap("footer" if self.semantic else "div", FOOTER, 0, inside, not self.semantic)

    def advert(self) -> str:
        inside = self.sentence(2, 15)
        if self.r.random() < 0.4:
            inside = f"<p>{inside}</p><p>{self.sentence(2, 20)}</p>"
        if self.r.random() < 0.3:
            inside += f"<a href='/{self.word()}'>{self.words(1, 3)}</a>"
        return self.wrap(self.r.choice(("div", "div", "aside", "section")), ADVERT, 0, inside, True)

    def notice(self) -> str:
        inside = self.r.choice(("<p>{}</p>", "{}", "<p>{}</p><button>Ok</button>")).format(
            " ".join(self.sentence(4, 18) for _ in range(self.r.randint(1, 3))))
        return self.wrap(self.r.choice(("div", "div", "section", "aside")), NOTICE, 0, inside, True)

    def side(self) -> str:
        inside = f"<h3>{self.words(1, 3)}</h3>" + self.links(2, 6)
        if self.r.random() < 0.4:
            inside += f"<p>{self.sentence(3, 20)}</p>"
        return self.wrap("aside" if self.semantic else "div", SIDE, 0, inside, not self.semantic)

    def form(self) -> str:
        inside = f"<label>{self.words(1, 3)}</label><input name=q><button>{self.words(1, 2)}</button>"
        if self.r.random() < 0.5:
            inside = f"<h4>{self.words(2, 5)}</h4><p>{self.sentence(3, 14)}</p>" + inside
        if self.r.random() < 0.3:
            inside += "<select><option>" + "</option><option>".join(self.words(1, 2) for _ in range(3)) + "</option></select>"
        f = f"<form data-y=0>{inside}</form>"
        return self.wrap("div", FORM, 0, f) if self.r.random() < 0.5 else f

    def share(self) -> str:
        return self.wrap("div", SHARE, 0, self.links(2, 5), True)

    def comments(self) -> str:
        tag = self.r.choice(("div", "li", "article", "section"))
        each = [f"<{tag}{self.r.choice(('', ' class=comment', ' class=reply'))}>"
                f"<{(k := self.r.choice(('b', 'span', 'h4', 'cite')))}>{self.word()}</{k}>"
                f"<p>{' '.join(self.sentence() for _ in range(self.r.randint(1, 4)))}</p></{tag}>"
                for _ in range(self.r.randint(1, 6))]
        inside = "".join(each)
        if tag == "li":
            inside = self.r.choice(("<ol>{}</ol>", "<ul>{}</ul>")).format(inside)
        head = f"<h3>{self.words(1, 3)}</h3>" if self.r.random() < 0.7 else ""
        return self.wrap(self.r.choice(("section", "div", "aside")), COMMENT, 0, head + inside, True)

    def article(self) -> str:
        parts = []
        for i in range(self.r.choice((1, 2, 4, 6, 9, 14))):
            k = self.r.random()
            if k < 0.08:
                parts.append(f"<h{(h := self.r.randint(2, 4))}>{self.words(1, 6)}</h{h}>")
            elif k < 0.13:
                parts.append("<ul>" + "".join(f"<li>{self.prose()}</li>" for _ in range(self.r.randint(2, 5))) + "</ul>")
            elif k < 0.17:
                parts.append(f"<blockquote><p>{self.prose()}</p></blockquote>")
            elif k < 0.19:
                parts.append("<table>" + "".join(f"<tr><td>{self.words(1, 3)}</td><td>{self.words(1, 2)}</td></tr>"
                                                 for _ in range(self.r.randint(2, 4))) + "</table>")
            elif k < 0.21:
                parts.append(f"<pre>{self.prose()}</pre>")
            elif k < 0.24:
                parts.append(f"<div>{self.prose()}</div>")
            elif k < 0.27:
                parts.append(f"<p><b>{self.sentence()}<br><p>{self.prose()}</p>")
            else:
                parts.append(f"<p>{self.prose()}</p>")
        for make, chance in ((self.advert, 0.25), (self.share, 0.15), (self.side, 0.12), (self.form, 0.12),
                             (self.notice, 0.12), (self.comments, 0.1), (self.menu, 0.08), (self.footer, 0.05)):
            if self.r.random() < chance:
                parts.insert(self.r.randint(0, len(parts)), make())
        title = f"<h1>{self.words(1, 9)}</h1>"
        if self.r.random() < 0.15:
            title = f"<header>{title}</header>"
        body = title + "".join(parts)
        if self.r.random() < 0.3:
            body = title + self.wrap("div", CONTENT, 1, "".join(parts))
        k = self.r.random()
        if self.semantic and k < 0.75:
            return self.wrap("article", CONTENT if self.r.random() < 0.4 else None, 1, body)
        if self.semantic and k < 0.85:
            return self.wrap("main", None, 1, body)
        if k < 0.93:
            return self.wrap(self.r.choice(("div", "div", "section")), CONTENT, 1, body)
        return self.wrap("table", None, 1, f"<tr><td>{body}</td></tr>")

    def html(self) -> str:
        before = [self.header, self.menu, self.notice, self.advert, self.form, self.side, self.share]
        after = [self.footer, self.comments, self.side, self.advert, self.form, self.share, self.notice, self.menu]
        top = [f() for f in before if self.r.random() < 0.4]
        end = [f() for f in after if self.r.random() < 0.4]
        middle = self.article()
        if self.r.random() < 0.4:
            near = [f() for f in (self.side, self.comments, self.advert) if self.r.random() < 0.5]
            middle = self.wrap(self.r.choice(("main", "div", "div", "section")), ["container", "wrapper", "main", "page", "row"],
                               None, middle + "".join(near))
        self.r.shuffle(end)
        body = "".join(top) + middle + "".join(end)
        if self.r.random() < 0.3:
            body = self.wrap("div", ["wrapper", "page", "site", "app"], None, body)
        return (f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title><script>var a='</p>';</script></head>"
                f"<body data-y=0>{body}</body></html>")


def pages(n: int, seed: int = 11) -> list[str]:
    return [Page(seed * 1_000_003 + i).html() for i in range(n)]
