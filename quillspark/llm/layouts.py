"""Pages with known main text, drawn from a grammar of layouts, to fit the block labeller on.

A page is a header, menus, notices, adverts, sidebars, forms, comments and a footer around (or
inside) an article.  Containers get semantic elements, telling class names, or names without
meaning; words are made of random syllables, with stock phrases in some of the boilerplate.  Every
text starts with a mark that says whether it belongs to the article."""

from __future__ import annotations

import random
import re

MAIN, REST = "\ue000", "\ue001"

#: Names that web pages give the parts of a page.
_PARTS = {
    "main": "content article post story entry body text main copy page post-content article-body entry-content main-content story-body post-body page-content article-text articleBody".split(),
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs topnav mainnav tabs links pagination pager toc skip categories tags sitemap".split(),
    "header": "header masthead site-header page-header top topbar banner branding logo site-title tagline".split(),
    "footer": "footer foot site-footer bottom copyright legal colophon credits imprint contentinfo page-footer".split(),
    "side": "sidebar aside side widget widgets related rail popular trending recent most-read secondary complementary recommended teaser more left right left-column right-rail".split(),
    "advert": "ad ads advert advertisement adbox sponsor sponsored promo promotion banner-ad adslot commercial".split(),
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay disclaimer warning announcement message banner toast privacy".split(),
    "form": "search login signup subscribe newsletter form contact signin register".split(),
    "comments": "comments comment-list commentlist comment discussion respond replies reader-comments responses feedback user-comments thread disqus".split(),
    "share": "share social sharing follow social-links share-buttons toolbar".split(),
}
_AROUND = "main site page top global primary left right inner outer box wrapper container block js section content col row".split()
_PHRASES = {
    "menu": ["Home", "About us", "Contact", "News", "Sport", "Archive", "Next", "Previous", "Skip to content", "Menu", "Products", "Blog", "FAQ", "Login"],
    "header": ["Welcome", "The daily news", "Search", "Sign in", "Menu", "Established 1901"],
    "footer": ["All rights reserved.", "Terms of use", "Privacy policy", "Copyright 2020", "Imprint", "Contact us", "Powered by"],
    "side": ["Related articles", "Most read", "Popular posts", "You may also like", "Recent posts", "About the author", "Archives", "Tags"],
    "advert": ["Advertisement", "Sponsored", "Buy now", "Special offer", "Click here", "Order today", "50% off", "Learn more"],
    "notice": ["We use cookies.", "This site uses cookies to improve your experience.", "Accept all", "Please enable JavaScript.", "Subscribe to keep reading.", "Privacy settings", "Your browser is out of date."],
    "form": ["Search", "Email", "Your name", "Submit", "Password", "Remember me", "Subscribe", "Send", "Sign up for our newsletter", "Message"],
    "comments": ["Comments", "Leave a reply", "Reply", "Report", "3 comments", "says:", "Like", "Log in to comment", "Posted by", "Great article!", "I agree.", "First!"],
    "share": ["Share", "Tweet", "Print", "Email this", "Follow us"],
}
_SYLLABLES = "an ar be con de der en er es for ge ha in ing is ka la le lo ma me mi na ne no o on or ou pa per qui ra re ri ro sa se si st ta te ter th ti to tra un ur ve vi wa za ción ée ü ß".split()


class Layout:
    def __init__(self, rng: random.Random):
        self.rng = rng
        self.style = rng.choices(["semantic", "named", "bare"], [4, 5, 2])[0]
        self.sloppy = rng.random() < 0.35
        self.stock = rng.random()  # how often boilerplate is a stock phrase
        self.vocabulary = [self._word() for _ in range(rng.randrange(30, 300))]

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def _word(self) -> str:
        return "".join(self.rng.choices(_SYLLABLES, k=self.rng.choice([1, 1, 2, 2, 3, 4])))

    def words(self, n: int) -> str:
        out = [self.rng.choice(self.vocabulary) for _ in range(max(1, n))]
        if self.chance(0.06):  # junk: a few words over and over
            out = [w for w in out[: 1 + len(out) // 8] for _ in range(self.rng.choice([5, 12, 30]))]
        for i in range(len(out)):
            if i == 0 or out[i - 1].endswith("."):
                out[i] = out[i].capitalize()
            if self.chance(0.12):
                out[i] += self.rng.choice([".", ",", ".", ",", "!", "?", " |", " &amp;", ":"])
        return " ".join(out) + ("." if self.chance(0.8) else "")

    def text(self, part: str, n: int) -> str:
        if part in _PHRASES and self.chance(self.stock):
            own = self.rng.choice(_PHRASES[part])
            return REST + own + (" " + self.words(n) if self.chance(0.3) else "")
        return (MAIN if part == "main" else REST) + self.words(n)

    def names(self, part: str) -> str:
        """Attributes of a container of this kind."""
        if self.style == "bare" and self.chance(0.9):
            return "" if self.chance(0.6) else f' class="{self._word()}{self.rng.randrange(99)}"'
        name = self.rng.choice(_PARTS[part])
        if self.chance(0.35):
            extra, joint = self.rng.choice(_AROUND), self.rng.choice(["-", "_", " ", "-"])
            name = f"{extra}{joint}{name}" if self.chance(0.5) else f"{name}{joint}{extra}"
        if self.chance(0.1):
            head, *tail = name.replace("_", "-").split("-")
            name = head + "".join(x.capitalize() for x in tail)
        which = self.rng.choice(["class", "class", "class", "class", "id", "id", "role"])
        return f' {which}="{name}"' + (f' id="{self._word()}"' if which == "class" and self.chance(0.15) else "")

    def neutral(self) -> str:
        return "" if self.chance(0.4) else f' class="{self.rng.choice(_AROUND)}{self.rng.choice(["", "", "-" + self._word()])}"'

    def box(self, part: str, inside: str) -> str:
        semantic = {"menu": "nav", "header": "header", "footer": "footer", "side": "aside", "form": "form", "advert": "aside",
                    "comments": "section", "main": self.rng.choice(["article", "article", "main", "section"])}
        if self.style == "semantic" and part in semantic and self.chance(0.85):
            tag = semantic[part]
            if part in ("comments", "advert") or tag == "section" or self.chance(0.3):
                style, self.style = self.style, "named"
                attributes, self.style = self.names(part), style
            else:
                attributes = ""
            if part == "main" and tag == "main" and self.chance(0.5):
                inside = f"<article>{inside}</article>"
        else:
            tag, attributes = self.rng.choice(["div", "div", "div", "section"]), self.names(part)
            if self.style == "semantic" and not attributes:
                attributes = f' class="{self.rng.choice(_PARTS[part])}"'
            if self.style == "named" and part == "main" and self.chance(0.15):
                attributes += ' role="main"'
        return f"<{tag}{attributes}>{inside}</{tag}>"

    def links(self, part: str, n: int) -> str:
        if self.chance(0.75):
            return "<ul>" + "".join(f'<li><a href="/{i}">{self.text(part, self.rng.randrange(1, 4))}</a></li>' for i in range(n)) + "</ul>"
        return "".join(f'<a href="/{i}">{self.text(part, 1)}</a> ' for i in range(n)) + ("<p></p>" if self.chance(0.3) else "")

    def paragraph(self) -> str:
        n = self.rng.choice([1, 2, 3, 6, 12, 25, 40, 70, 100])
        inside = self.text("main", n)
        if self.chance(0.2):
            inside += f' <a href="/x">{self.words(2)}</a> ' + self.words(5)
        if self.chance(0.15):
            inside += f"<b>{self.words(2)}</b> <em>{self.words(1)}</em>"
        if self.sloppy and self.chance(0.6):
            return f"<p><b>{inside}<br>" if self.chance(0.3) else f"<p>{inside}"
        return f"<p>{inside}</p>"

    def article(self) -> str:
        rng, out = self.rng, []
        if self.chance(0.8):
            title = f"<h1>{self.text('main', rng.randrange(2, 12))}</h1>"
            if self.chance(0.4):
                line = self.text("main", rng.randrange(2, 6))
                title += f'<p class="{rng.choice(["byline", "date", "meta", "author", "lead", "subtitle"])}">{line}</p>'
            out.append(f"<header>{title}</header>" if self.chance(0.2) else title)
        for _ in range(rng.choice([1, 2, 4, 8, 12, 20])):
            kind = rng.random()
            if kind < 0.68:
                out.append(self.paragraph())
            elif kind < 0.76:
                out.append(f"<h{(h := rng.randrange(2, 5))}>{self.text('main', rng.randrange(1, 8))}</h{h}>")
            elif kind < 0.82:
                tag = rng.choice(["ul", "ol"])
                out.append(f"<{tag}>" + "".join(f"<li>{self.text('main', rng.randrange(1, 15))}</li>" for _ in range(rng.randrange(1, 6))) + f"</{tag}>")
            elif kind < 0.86:
                tag = rng.choice(["blockquote", "pre", "div"])
                out.append(f"<{tag}>{self.text('main', rng.randrange(2, 40))}</{tag}>")
            elif kind < 0.89:
                out.append(f'<figure><img src="x.png" alt="x"><figcaption>{self.text("main", rng.randrange(2, 12))}</figcaption></figure>')
            elif kind < 0.92:
                out.append("<table>" + "".join("<tr>" + "".join(f"<td>{self.text('main', rng.randrange(1, 5))}</td>" for _ in range(3)) + "</tr>" for _ in range(rng.randrange(1, 4))) + "</table>")
            elif self.style != "bare":
                out.append(self.extra(rng.choice(["advert", "advert", "side", "share", "form", "notice"])))
        if self.style != "bare" and self.chance(0.25):
            out.append(self.extra(rng.choice(["share", "side", "comments", "comments", "form"])))
        if self.chance(0.3):
            return f"<div{self.neutral()}>" + "".join(out) + "</div>"
        return "".join(out)

    def extra(self, part: str) -> str:
        """A part other than the article."""
        rng = self.rng
        if part == "menu":
            inside = self.links("menu", rng.randrange(2, 9))
        elif part == "header":
            inside = (f"<h1>{self.text('header', rng.randrange(1, 9))}</h1>" if self.chance(0.5) else f'<a href="/">{self.text("header", 1)}</a>' if self.chance(0.5) else "") + (f"<p>{self.text('header', rng.randrange(2, 9))}</p>" if self.chance(0.6) else "") or f"<div>{self.text('header', 3)}</div>"
            if self.chance(0.4):
                inside += self.links("menu", rng.randrange(2, 6))
        elif part == "footer":
            inside = rng.choice(["&copy; ", "", "(c) "]) + self.text("footer", rng.randrange(2, 14))
            inside = REST + inside.replace(REST, "")
            if self.chance(0.4):
                inside = f"<p>{inside}</p>" + (self.links("footer", rng.randrange(1, 6)) if self.chance(0.6) else f"<p>{self.text('footer', 8)}</p>")
        elif part == "side":
            inside = f"<h3>{self.text('side', 2)}</h3>" * self.chance(0.7)
            inside += self.links("side", rng.randrange(2, 7)) if self.chance(0.6) else "".join(f"<p>{self.text('side', rng.randrange(3, 30))}</p>" for _ in range(rng.randrange(1, 4)))
        elif part in ("advert", "notice"):
            inside = self.text(part, rng.randrange(2, 25))
            if self.chance(0.4):
                inside = f"<p>{inside}</p>" + (f'<a href="/go">{self.text(part, 2)}</a>' if self.chance(0.5) else f"<button>{self.text(part, 1)}</button>")
        elif part == "form":
            inside = "".join(rng.choice([f"<label>{self.text('form', 1)}</label><input>", f"<p>{self.text('form', 5)}</p>", f"<button>{self.text('form', 1)}</button>", f"<select><option>{self.text('form', 1)}<option>{self.text('form', 1)}</select>", f"<label>{self.text('form', 2)} <input></label>"]) for _ in range(rng.randrange(1, 5)))
            if self.style != "semantic":
                inside = f"<form>{inside}</form>"
            elif self.chance(0.3):
                return f"<form>{inside}</form>"
        elif part == "comments":
            tag = rng.choice(["div", "li", "article", "div"])
            style, self.style = self.style, "named" if self.style != "bare" else "bare"
            each = []
            for _ in range(rng.randrange(1, 7)):
                who = rng.choice([f"<b>{self.text('comments', 1)}</b> ", f"<h4>{self.text('comments', 2)}</h4>", f'<a href="/u">{self.text("comments", 1)}</a>', ""])
                said = "".join(f"<p>{self.text('comments', rng.choice([2, 5, 15, 40, 80]))}</p>" for _ in range(rng.choice([1, 1, 2])))
                each.append(f"<{tag}{self.names('comments')}>{who}{said}" + (f'<a href="/r">{self.text("comments", 1)}</a>' if self.chance(0.3) else "") + f"</{tag}>")
            self.style = style
            inside = "".join(each)
            if tag == "li":
                inside = f"<ol>{inside}</ol>"
            if self.chance(0.6):
                inside = f"<h3>{self.text('comments', 2)}</h3>" + inside
        else:
            inside = self.links("share", rng.randrange(1, 5))
        return self.box(part, inside)

    def page(self) -> str:
        rng = self.rng
        before, after = [], []
        if self.chance(0.15):
            before.append(self.extra("notice"))
        if self.chance(0.5):
            before.append(self.extra("header"))
        if self.chance(0.8):
            before.append(self.extra("menu"))
        for part, p in [("advert", 0.4), ("menu", 0.15), ("form", 0.15), ("notice", 0.12), ("side", 0.2)]:
            if self.chance(p):
                before.append(self.extra(part))
        for part, p in [("share", 0.15), ("side", 0.3), ("comments", 0.35), ("advert", 0.2), ("form", 0.2), ("menu", 0.1)]:
            if self.chance(p):
                after.append(self.extra(part))
        if self.chance(0.85):
            after.append(self.extra("footer"))
        if self.chance(0.15):
            after.append(self.extra("notice"))
        main = self.box("main", self.article())
        if self.chance(0.05):  # the title stands before the article's container
            main = f"<h1>{self.text('main', rng.randrange(3, 9))}</h1>{main}"
        body = [*before, main, *after]
        if self.style != "bare" and self.chance(0.12):  # the parts are cells of a table
            body = [re.sub(r"^<(\w+)([^>]*)>(.*)</\1>$", r"<td\2>\3</td>", x, flags=re.S) for x in body]
            body = [f"<td>{x}</td>" if not x.startswith("<td") else x for x in body]
            ends = [rng.random() < 0.3 for _ in body]
            return "<html><body><table><tr>" + "".join(x + "</tr><tr>" * e for x, e in zip(body, ends)) + "</tr></table></body></html>"
        if self.chance(0.4):
            i, j = rng.randrange(len(before) + 1), rng.randrange(len(before) + 1, len(body) + 1)
            body = [*body[:i], f"<div{self.neutral()}>", *body[i:j], "</div>", *body[j:]]
        if self.chance(0.5):
            body = [x + rng.choice(["", "\n", "<!-- x -->", "<script>var t='</p>';</script>"]) for x in body]
        html = "<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body>" + "".join(body) + "</body></html>"
        if self.chance(0.1):  # cut somewhere past the article's start
            html = html[: rng.randrange(len(html) // 2, len(html))]
        return html


def training_pages(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return [Layout(rng).page() for _ in range(n)]
