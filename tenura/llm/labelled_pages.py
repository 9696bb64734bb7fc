"""Labelled pages to train the extraction model on: page frames of many kinds, with the main text marked.

Pages are put together from the parts below with invented words. ``data-main`` marks the element whose blocks are the main text;
parts that stand inside it but do not belong to it carry ``data-other``. The marks are read as labels and are no features.
"""

from __future__ import annotations

import random

_SYLLABLES = "ka lo mi ren tas vo el un dri pa sol ne qui ber tan fe gor hal is ju".split()

# Names that pages give to their parts.
MAIN_NAMES = ["content", "main", "post", "entry", "article-body", "story", "post-content", "entry-content", "main-content", "text", "body-text", "page-content"]
OTHER_NAMES = {
    "menu": ["nav", "menu", "navbar", "main-nav", "breadcrumb", "breadcrumbs", "toc", "pagination", "pager", "skip-links", "site-nav"],
    "header": ["header", "masthead", "site-header", "banner", "topbar", "page-header", "branding", "logo"],
    "footer": ["footer", "site-footer", "copyright", "colophon", "bottom", "legal"],
    "aside": ["sidebar", "aside", "widget", "related", "recommended", "trending", "popular", "more-stories", "tags", "author-box", "bio"],
    "notice": ["cookie", "cookie-notice", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "message-bar", "disclaimer", "paywall"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "banner-ad", "adsense", "ad-slot", "promoted"],
    "form": ["subscribe", "newsletter", "signup", "search", "login", "contact-form", "search-form"],
    "comment": ["comments", "comment", "comment-list", "replies", "discussion", "disqus", "respond", "reader-comments", "comment-body"],
    "share": ["share", "social", "share-buttons", "follow", "tools", "print"],
}
# Words by which short texts tell what part they stand in, in four languages.
TELLING = {
    "comment": ["comment", "comments", "reply", "replies", "replied", "responses", "kommentar", "kommentare", "antworten", "commentaire", "commentaires", "répondre", "comentario", "comentarios", "responder"],
    "ad": ["advertisement", "advert", "sponsored", "promoted", "anzeige", "werbung", "publicité", "sponsorisé", "publicidad", "patrocinado"],
    "cookie": ["cookie", "cookies", "consent", "gdpr", "datenschutz", "consentement", "consentimiento"],
    "legal": ["©", "copyright", "rights", "reserved", "impressum", "privacy", "terms", "rechte", "droits", "derechos", "mentions"],
    "share": ["share", "tweet", "facebook", "twitter", "whatsapp", "linkedin", "teilen", "partager", "compartir"],
    "form": ["subscribe", "newsletter", "login", "password", "email", "search", "abonnieren", "suche", "suchen", "abonner", "rechercher", "suscribir", "buscar"],
    "menu": ["home", "menu", "navigation", "skip", "startseite", "accueil", "inicio", "menü"],
    "related": ["related", "popular", "trending", "recommended", "beliebt", "similaires", "relacionados"],
}
# Names that say nothing of the part.
_MUTE_NAMES = ["c1", "c2", "row", "col", "col-md-8", "box", "inner", "outer", "wrap", "l-grid", "grid__item", "x", "block-7", "left", "right", "center", "css-1a2b3c", "sc-bdvvtl"]
_ROLES = {"menu": "navigation", "header": "banner", "footer": "contentinfo", "aside": "complementary", "form": "search", "notice": "alert"}
_TAGS = {"menu": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form", "comment": "section", "share": "div", "ad": "div", "notice": "div"}


class _Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.plain = False

    def word(self):
        return "".join(self.r.choice(_SYLLABLES) for _ in range(self.r.randint(1, 4)))

    def line(self, low, high):
        words = [self.word() for _ in range(self.r.randint(low, high))]
        return " ".join(words).capitalize() + self.r.choice([".", ".", "", "!", ":"])

    def text(self):
        """A sentence or many; short ones are as common in the main text as anywhere."""
        return self.line(1, 8) if self.r.random() < 0.35 else " ".join(self.line(3, 20) for _ in range(self.r.randint(1, 6)))

    def inline(self, text):
        if self.r.random() < 0.4:
            tag = self.r.choice(["b", "i", "em", "strong", "span", "code", "a"])
            link = ' href="/x"' if tag == "a" else ""
            return f"<{tag}{link}>{self.line(1, 4)}</{tag}> {text}"
        return text

    def named(self, name):
        """The mark that tells a part; on plain pages one that tells nothing, or none."""
        if self.plain:
            return self.muted()
        kind = self.r.choice(["class", "class", "id"])
        extra = self.r.choice(["", "", " clearfix", " col-8", " wide"])
        return f' {kind}="{name}{extra if kind == "class" else ""}"'

    def muted(self):
        return self.r.choice(["", "", f' class="{self.r.choice(_MUTE_NAMES)}"', f' class="{self.word()}"', f' id="{self.word()}{self.r.randint(1, 9)}"'])

    def telling(self, part, low=0, high=6):
        """A short text with a word that tells its part."""
        words = [self.word() for _ in range(self.r.randint(low, high))]
        words.insert(self.r.randint(0, len(words)), self.r.choice(TELLING[part]))
        return self.r.choice(["", "12 ", "3 "]) * (part == "comment") + " ".join(words).capitalize()

    def links(self):
        items = "".join(f'<li><a href="/{self.word()}">{self.line(1, 3)}</a></li>' for _ in range(self.r.randint(2, 9)))
        return f"<ul>{items}</ul>"

    def comments(self):
        """Reader comments as paragraphs, lists or boxes, long or short."""
        r = self.r
        item = r.choice(["div", "li", "li", "article", "p"])
        inside = r.choice([lambda: f"<p>{self.text()}</p>", lambda: self.text(), lambda: f"<b>{self.line(1, 2)}</b> {self.text()}", lambda: f"<h4>{self.line(1, 2)}</h4><p>{self.text()}</p><p>{self.text()}</p>"])
        mark = "" if r.random() < 0.5 else self.named(r.choice(["comment", "comment-body", "reply", "comment-item"]))
        if item == "p":
            inside = lambda: self.text()
        items = "".join(f"<{item}{mark}>{inside()}</{item}>" for _ in range(r.randint(1, 6)))
        if item == "li":
            list_ = r.choice(["ol", "ul"])
            items = f"<{list_}{r.choice(['', self.named('commentlist'), self.named('comment-list')])}>{items}</{list_}>"
        # Without telling names only a heading tells them.
        head = f"<h{r.randint(2, 4)}>{self.telling('comment', 0, 2)}</h{r.randint(2, 4)}>" if self.plain or r.random() < 0.5 else ""
        return head + items

    def plain_part(self, kind):
        """A part that is told by what it holds."""
        r = self.r
        if kind == "menu":
            return r.choice([self.links, lambda: " | ".join(f'<a href="/{self.word()}">{self.line(1, 2)}</a>' for _ in range(r.randint(2, 9))), lambda: "".join(f'<a href="/{self.word()}">{self.line(1, 2)}</a>' for _ in range(r.randint(2, 6)))])()
        if kind == "header":
            return r.choice([f'<a href="/">{self.line(1, 3)}</a>', f'<h2><a href="/">{self.line(1, 3)}</a></h2>', f'<a href="/"><img src="x.png"></a><span>{self.line(1, 5)}</span>']) + r.choice(["", self.links()])
        if kind == "footer":
            return r.choice([f"<p>{self.telling('legal')} 2024</p>", f"{self.telling('legal')}", f"<p>© 2024 {self.line(1, 4)}</p>{self.links()}", f"<small>{self.telling('legal')}</small>", self.links() + self.telling("legal")])
        if kind == "aside":
            return f"<h3>{r.choice([self.telling('related', 0, 2), self.line(1, 3)])}</h3>{self.links()}"
        if kind == "notice":
            return r.choice(["<p>{}</p><button>OK</button>", "{} <button>OK</button>", "<span>{}</span><a href='/p'>OK</a>"]).format(self.telling("cookie", 3, 10))
        if kind == "ad":
            return r.choice([f"{self.telling('ad')}", f"<p>{self.telling('ad')}</p>", f'<span>{self.telling("ad")}</span><a href="http://ad.example">{self.line(2, 8)}</a>'])
        if kind == "share":
            return f"{self.telling('share', 0, 1)}: " + " ".join(f'<a href="/s">{self.line(1, 1)}</a>' for _ in range(r.randint(2, 5)))
        return self.comments()

    def other(self, kind):
        """A part that is not main text, by its tag, its name, what it holds, or several of these."""
        r, name = self.r, self.r.choice(OTHER_NAMES[kind])
        tag = r.choice([_TAGS[kind], "div"])
        marks = "" if tag == _TAGS[kind] and tag != "div" and tag != "section" and r.random() < 0.5 else self.named(name)
        if kind in _ROLES and r.random() < (0.1 if self.plain else 0.3):
            marks += f' role="{_ROLES[kind]}"'
        if kind == "form":
            return f'<{tag}{marks} data-other>{r.choice(["", f"<h3>{self.line(1, 4)}</h3>", f"<h3>{self.telling("form")}</h3>"])}<label>{self.line(1, 3)}</label><input type="text"><button>{self.line(1, 2)}</button>{r.choice(["", f"<p>{self.text()}</p>", self.blocks(1, 2)])}</{tag}>'
        inner = r.choice([self.links, lambda: f"<p>{self.text()}</p>", lambda: self.text(), lambda: f"<h3>{self.line(1, 4)}</h3>{self.links()}", lambda: self.heading() + self.blocks(0, 3), lambda: self.blocks(1, 5), lambda: self.blocks(2, 8)])
        if kind == "comment":
            inner = lambda: r.choice(["", f"<h2>{self.line(1, 3)}</h2>"]) + self.comments()
        if self.plain or r.random() < 0.3:
            inner = lambda: self.plain_part(kind)
        body = inner()
        if kind == "comment" and r.random() < 0.3 and not self.plain:
            # The list itself carries the name.
            return f'<{(t := r.choice(["ol", "ul"]))} class="{r.choice(["commentlist", "comments", "comment-list", "replies"])}" data-other>' + "".join(f"<li><p>{self.text()}</p></li>" for _ in range(r.randint(1, 5))) + f"</{t}>"
        if r.random() < 0.3:
            body = f"<div>{body}</div>"
        return f"<{tag}{marks} data-other>{body}</{tag}>"

    def heading(self):
        level = self.r.randint(1, 4)
        return f"<h{level}>{self.line(1, 6)}</h{level}>"

    def blocks(self, low, high):
        return "".join(self.block() for _ in range(self.r.randint(low, high)))

    def block(self):
        r = self.r
        kind = r.random()
        if kind < 0.62:
            return f"<p>{self.inline(self.text())}</p>"
        if kind < 0.72:
            return f"<h2>{self.line(1, 8)}</h2>"
        if kind < 0.78:
            return "<ul>" + "".join(f"<li>{self.inline(self.line(1, 12))}</li>" for _ in range(r.randint(1, 5))) + "</ul>"
        if kind < 0.83:
            return f"<blockquote><p>{self.text()}</p></blockquote>"
        if kind < 0.87:
            return f"<table><tr><td>{self.line(1, 4)}</td><td>{self.line(1, 4)}</td></tr></table>"
        if kind < 0.90:
            return f"<pre>{self.line(2, 12)}</pre>"
        if kind < 0.93:
            return f"<figure><figcaption>{self.line(1, 8)}</figcaption></figure>"
        if kind < 0.96:
            return f"<div>{self.text()}</div>"
        return f"<p><b>{self.text()}<br>"

    def article(self):
        """The blocks of a main text: a heading, perhaps in a header of its own, then paragraphs, lists and sections."""
        r = self.r
        head = ""
        if r.random() < 0.85:
            head = f"<h{(k := r.choice([1, 1, 1, 2]))}>{self.line(1, 12)}</h{k}>"
            if r.random() < 0.3:
                head += r.choice([f"<p>{self.line(4, 20)}</p>", f"<h2>{self.line(3, 9)}</h2>"])
            if r.random() < 0.35:
                tag = r.choice(["header", "header", "div", "hgroup"])
                mark = "" if tag == "header" and r.random() < 0.6 else self.named(r.choice(["entry-header", "article-header", "post-header", "entry-title", "title", "headline"]))
                head = f"<{tag}{mark}>{head}</{tag}>"
        count = r.randint(1, 14) if not self.plain else r.randint(2, 14)
        blocks = [self.block() for _ in range(count)]
        if self.plain or r.random() < 0.5:
            # At least one paragraph of some length.
            blocks.insert(r.randint(0, len(blocks)), f"<p>{' '.join(self.line(6, 20) for _ in range(r.randint(1, 7)))}</p>")
        style = r.random()
        if style < 0.1:
            blocks = [b.replace("<p>", "<div>").replace("</p>", "</div>") for b in blocks]
        elif style < 0.18:
            blocks = [f"<section{self.muted()}><h2>{self.line(1, 6)}</h2>{b}</section>" for b in blocks]
        elif style < 0.26:
            # Old pages: runs of text with line breaks.
            blocks = [f"{self.text()} {self.line(5, 20)}<br><br>" for _ in blocks]
        elif style < 0.32:
            blocks = [f"<div{self.muted()}>{b}</div>" for b in blocks]
        return [head] * bool(head) + blocks

    def note(self):
        """A page of a sentence or two, with little around them."""
        r = self.r
        self.plain = False
        tag = r.choice(["article", "article", "main", "div"])
        mark = "" if tag != "div" and r.random() < 0.7 else self.named(r.choice(MAIN_NAMES))
        title = f"<h1>{self.line(1, 5)}</h1>" if r.random() < 0.4 else ""
        main = f"<{tag}{mark} data-main>{title}{''.join(f'<p>{self.inline(self.line(1, 7))}</p>' for _ in range(r.randint(1, 3)))}</{tag}>"
        around = [self.other(r.choice(["menu", "header", "footer", "aside", "notice", "comment", "form"])) for _ in range(r.choice([0, 0, 0, 1, 2]))]
        at = r.randint(0, len(around))
        page = "".join(around[:at]) + main + "".join(around[at:])
        return page if r.random() < 0.4 else f"<html><body>{page}</body></html>"

    def page(self):
        r = self.r
        if r.random() < 0.14:
            return self.note()
        self.plain = r.random() < 0.55
        outer = ["menu", "header", "footer", "aside", "notice", "ad", "form", "comment", "share"]
        first, last = ["menu", "header", "notice", "ad", "form", "share", "aside"], ["footer", "aside", "notice", "ad", "form", "comment", "share"]
        before = [self.other(k) for k in r.sample(first if self.plain else outer, r.randint(0, 4))]
        after = [self.other(k) for k in r.sample(last if self.plain else outer, r.randint(0, 4))]
        if r.random() < (0.3 if self.plain else 0.7):
            before.append(f"<nav data-other>{self.links()}</nav>")
        if r.random() < 0.7 and not self.plain:
            before.append(f'<div class="ad" data-other>{self.text()}</div>')
        if r.random() < (0.3 if self.plain else 0.7):
            after.append(f"<footer data-other>{self.text()}</footer>")
        r.shuffle(before)
        blocks = self.article()
        inner = ["ad", "aside", "share", "form", "notice", "comment", "comment"]
        for _ in range(r.choice([0, 0, 1, 2])):
            kind = r.choice(inner)
            blocks.insert(len(blocks) if kind == "comment" and r.random() < 0.7 else r.randint(1, len(blocks)), self.other(kind))
        tag, name = r.choice([("article", ""), ("article", ""), ("article", "x"), ("main", ""), ("div", "x"), ("section", "x"), ("div", "x")])
        if self.plain and r.random() < 0.7:
            tag, name = "div", "x"
        main = f"<{tag}{self.named(r.choice(MAIN_NAMES)) if name else ''} data-main>{''.join(blocks)}</{tag}>"
        head = f"<html><head><title>{self.line(1, 9)}</title>{r.choice(['', '<style>p{}</style><script>var a=1;</script>', '<meta charset=utf-8>'])}</head>"
        if r.random() < 0.12:
            return f"{head}<body data-main>{''.join(before)}{''.join(blocks)}{''.join(after)}</body></html>"
        if self.plain and r.random() < 0.25:
            # A page laid out by a table.
            cells = [f"<td data-other>{b}</td>" for b in before[:2]] + [f"<td{self.muted()} data-main>{''.join(blocks)}</td>"] + [f"<td data-other>{b}</td>" for b in after[:1]]
            tops = f"<tr><td colspan=3 data-other>{self.plain_part('header')}</td></tr>" if r.random() < 0.5 else ""
            ends = f"<tr><td colspan=3 data-other>{self.plain_part('footer')}</td></tr>" if r.random() < 0.5 else ""
            return f"{head}<body><table>{tops}<tr>{''.join(cells)}</tr>{ends}</table>{''.join(after[1:])}</body></html>"
        for _ in range(r.choice([0, 0, 1, 2, 3])):
            tag = r.choice(["div", "div", "main", "section"])
            main = f"<{tag}{r.choice(['', self.named('container'), self.named('wrapper'), self.muted()])}>{main}{r.choice(['', self.other('aside')])}</{tag}>"
        return f"<!DOCTYPE html>{head}<body>{''.join(before)}{main}{''.join(after)}</body></html>"


def training_pages(n: int, seed: int = 11) -> list[str]:
    maker = _Maker(seed)
    return [maker.page() for _ in range(n)]
