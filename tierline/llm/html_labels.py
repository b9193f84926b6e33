"""Labelled pages for the extraction model: ``data-content`` marks content (1) and the rest (0).

``LABELLED`` holds some pages written by hand and ``DRAWN`` drawn ones, put together from the parts that
sites use, under the names that sites give them.
"""

import random

LONG = "The council met on Monday to discuss the new bridge, and most members spoke in favour of the plan."
SHORT = "It rained."
MENU = '<ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/about">About us</a></li></ul>'
PARAGRAPHS = f"<h1>A new bridge</h1><p>{LONG}</p><p>{SHORT}</p><p>{LONG} {LONG}</p><h2>Costs</h2><p>{LONG} <a href='/x'>see here</a></p>"
LISTED = f"<ul><li>{LONG}</li><li>Short point</li></ul><ul><li>bread</li><li>milk</li><li>salt</li></ul><ol><li>one</li><li>two</li><li>three</li></ol><blockquote><p>{LONG}</p></blockquote><table><tr><td>Year</td><td>1999</td></tr></table><pre>{SHORT}</pre>"
COMMENTS = f'<section class="comments" data-content="0"><h3>Comments</h3><div class="comment"><p>{LONG}</p></div><div class="comment"><p>{SHORT}</p></div><form><p>Reply</p></form></section>'
NAV = f'<nav data-content="0">{MENU}</nav>'
FOOT = f'<footer data-content="0"><p>&copy; 2020 Example. {SHORT}</p>{MENU}</footer>'
PLAIN_FOOT = f'<footer data-content="0">&copy; example &middot; {LONG}</footer>'
AD = f'<div class="ad" data-content="0">{LONG}</div><div class="banner" data-content="0"><p>{LONG}</p></div>'
ASIDE = f'<aside data-content="0"><h3>Related</h3>{MENU}<p>{LONG}</p></aside>'
SIDE = f'<div class="sidebar" data-content="0"><h3>More</h3>{MENU}<div><p>{LONG}</p></div></div>'
COOKIE = f'<div id="cookie-notice" data-content="0"><p>{LONG}</p><button>OK</button></div>'
FORM = f'<form data-content="0"><p>Subscribe for news. {LONG}</p><input name="q"></form>'
HEADER = f'<header data-content="0"><div class="logo">Example</div>{MENU}<p>{SHORT}</p></header>'
TITLE = "<head><title>Page</title><script>x()</script></head>"


def _page(body: str) -> str:
    return f"<html>{TITLE}<body>{body}</body></html>"


WRITTEN = [
    _page(f'{NAV}{AD}<article data-content="1">{PARAGRAPHS}</article>{PLAIN_FOOT}'),
    _page(f'{HEADER}<main data-content="1"><article>{PARAGRAPHS}{LISTED}</article></main>{ASIDE}{FOOT}'),
    _page(f'{COOKIE}{HEADER}{NAV}<article data-content="1">{PARAGRAPHS}{AD}{LISTED}{COMMENTS}</article>{FORM}{FOOT}'),
    _page(f'<div id="page"><div class="menu" data-content="0">{MENU}</div><div class="content" data-content="1">{PARAGRAPHS}{LISTED}</div>{SIDE}{COMMENTS}<div class="footer" data-content="0"><p>{SHORT}</p></div></div>'),
    _page(f'<div class="wrapper">{HEADER}<div class="post" data-content="1"><h1>Bridge</h1><div><p>{LONG}</p><p>{SHORT}</p>{AD}<p>{LONG}</p></div></div>{SIDE}{FORM}</div>{FOOT}'),
    _page(f'{NAV}<section data-content="1">{PARAGRAPHS}</section>{ASIDE}<div class="newsletter" data-content="0"><p>{LONG}</p></div>{FOOT}'),
    _page(f'{NAV}<div class="ad" data-content="0">{SHORT}</div><article data-content="1"><h1>{SHORT}</h1><p>{SHORT}</p><p>{SHORT}</p><div><p>{LONG}</p></div></article>{PLAIN_FOOT}'),
    _page(f'<div data-content="1"><p>{LONG}</p><p>{LONG}</p></div>{COOKIE}<div class="share" data-content="0"><a href="#">Share</a></div>{FOOT}'),
    _page(f'{HEADER}{AD}<main data-content="1"><h1>Words</h1>{LISTED}<p>{LONG}</p><div class="entry"><p>{SHORT}</p><ol><li>{SHORT}</li><li>{LONG}</li></ol></div></main>{COMMENTS}{ASIDE}{FOOT}'),
    _page(f'<p data-content="1">{LONG}</p><p data-content="1">{SHORT}</p><p data-content="1">{LONG}</p>{NAV}'),
]

#: Pages drawn from the parts below.
DRAWN = 300

# Names (class or id) under which sites put their parts.
PART_NAMES = {
    "menu": "nav menu navbar navigation main-nav top-menu site-nav breadcrumb breadcrumbs pagination pager toolbar topbar mobile-menu skip-links",
    "top": "header site-header masthead page-header logo banner-top search searchbox branding login",
    "foot": "footer site-footer copyright legal disclaimer colophon bottom-links footer-widgets",
    "side": "sidebar side aside widget rail right-column related related-posts recommended popular trending tags meta",
    "advert": "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion adsbox",
    "notice": "cookie cookie-banner cookies consent gdpr notice notices alert popup modal overlay toast privacy-notice",
    "form": "newsletter subscribe subscription signup login-form search-form contact-form poll",
    "share": "share sharing social social-links share-buttons follow byline-links",
    "talk": "comments comment-list commentlist discussion disqus replies respond responses thread reviews",
    "body": "article content entry post story main body text prose article-body post-content entry-content story-text main-content",
    "wrap": "page wrapper container layout row column inner site grid wrap",
    "line": "lead intro summary text paragraph first dropcap story-text body-text",
    "title": "title headline header entry-title post-title section-header heading",
}
PART_TAGS = {
    "menu": "nav nav div div ul", "top": "header header div", "foot": "footer footer div", "side": "aside aside div div section", "advert": "div div section aside",
    "notice": "div div section", "form": "form form div", "share": "div div ul", "talk": "section div div ol",
}


class _Draw:
    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def named(self, part: str, share: float = 0.85) -> str:
        if self.rng.random() > share:
            return ""
        return f' {self.rng.choice(["class", "class", "class", "id"])}="{self.rng.choice(PART_NAMES[part].split())}"'

    def words(self, least: int, most: int) -> str:
        return " ".join(self.rng.choices(LONG.split(), k=self.rng.randint(least, most))) + "."

    def links(self, tag: str = "li") -> str:
        return "".join(f"<{tag}><a href='/{i}'>{self.words(1, 4)}</a></{tag}>" for i in range(self.rng.randint(2, 6)))

    def rest(self, part: str) -> str:
        """A part that is no content."""
        tag = self.rng.choice(PART_TAGS[part].split())
        name = self.named(part, 0.85 if tag not in ("div", "section", "ul", "ol") else 1)
        hidden = self.rng.choice([" hidden", " style='display: none'", ' aria-hidden="true"']) if part == "notice" and self.rng.random() < 0.4 else ""
        if part in ("menu", "share"):
            inner = self.links() if tag in ("ul", "ol") else self.rng.choice([f"<ul>{self.links()}</ul>", self.links("span"), self.links("div")])
        elif part == "talk":
            inner = "".join(f"<{'li' if tag == 'ol' else 'div'} class='{self.rng.choice(['comment', 'reply', 'response', 'review'])}'><p>{self.words(2, 40)}</p></{'li' if tag == 'ol' else 'div'}>" for _ in range(self.rng.randint(1, 4)))
        elif part == "form":
            inner = f"<p>{self.words(3, 20)}</p><label>{self.words(1, 2)} <input></label><button>{self.words(1, 2)}</button>"
        elif part in ("top", "foot", "side"):
            inner = self.rng.choice([f"<ul>{self.links()}</ul>", f"<p>{self.words(3, 30)}</p>", self.words(3, 30), f"<h3>{self.words(1, 3)}</h3><ul>{self.links()}</ul>", f"<div><p>{self.words(3, 30)}</p></div>"])
        else:
            inner = self.rng.choice([self.words(3, 30), f"<p>{self.words(3, 30)}</p>", f"<p>{self.words(3, 20)}</p><a href='/x'>{self.words(1, 3)}</a>"])
        if part in ("advert", "share") and self.rng.random() < 0.25:
            return f'<p class="{self.rng.choice(PART_NAMES[part].split())}" data-content="0">{self.words(2, 20)}</p>'
        return f'<{tag}{name}{hidden} data-content="0">{inner}</{tag}>'

    def line(self) -> str:
        some = self.rng.random()
        if some < 0.04:  # opened by the reader's click
            tag = self.rng.choice(["p", "div"])
            return f"<{tag} hidden>{self.words(1, 60)}</{tag}>"
        if some < 0.47:
            return f"<p{self.named('line', 0.15)}>{self.words(1, 60)}</p>"
        if some < 0.55:
            return "<ul>" + "".join(self.rng.choice([f"<li>{self.words(1, 9)}</li>", f"<li><a href='/l'>{self.words(1, 9)}</a></li>"]) for _ in range(self.rng.randint(2, 6))) + "</ul>"
        if some < 0.62:
            return f"<p><a href='/source'>{self.words(1, 8)}</a></p>"
        if some < 0.70:
            return f"<p>{self.words(3, 20)} <a href='/see'>{self.words(1, 4)}</a> {self.words(1, 20)}</p>"
        if some < 0.80:
            tag = self.rng.choice(["h2", "h3", "h4"])
            return f"<{tag}{self.named('title', 0.3)}>{self.words(1, 6)}</{tag}>"
        if some < 0.86:
            return "<ul>" + "".join(f"<li>{self.words(1, 12)}</li>" for _ in range(self.rng.randint(2, 6))) + "</ul>"
        if some < 0.89:
            return "<ol>" + "".join(f"<li><p>{self.words(1, 12)}</p></li>" for _ in range(self.rng.randint(2, 6))) + "</ol>"
        if some < 0.93:
            return f"<blockquote><p>{self.words(4, 40)}</p></blockquote>"
        if some < 0.96:
            return "<table>" + "".join(f"<tr><th>{self.words(1, 2)}</th><td>{self.words(1, 4)}</td></tr>" for _ in range(3)) + "</table>"
        return self.rng.choice([f"<pre>{self.words(2, 20)}</pre>", f"<figure><img><figcaption>{self.words(2, 9)}</figcaption></figure>", f"<div><p>{self.words(2, 30)}</p></div>", f"<section><h3>{self.words(1, 4)}</h3><p>{self.words(2, 30)}</p></section>"])

    def page(self) -> str:
        rng = self.rng
        lines = [f"<h1{self.named('title', 0.3)}>{self.words(2, 9)}</h1>"] + [self.line() for _ in range(rng.randint(1, 14))]
        for part in ("advert", "share", "form", "menu"):
            if rng.random() < 0.25:
                lines.insert(rng.randint(1, len(lines)), self.rest(part))
        if rng.random() < 0.3:
            lines.append(self.rest("talk"))
        tag = rng.choice(["article", "article", "main", "div", "section"])
        body = f"<{tag}{self.named('body', 0.4 if tag in ('article', 'main') else 0.9)} data-content=\"1\">{''.join(lines)}</{tag}>"
        if rng.random() < 0.15:  # lines without elements of their own
            tag = rng.choice(["div", "div", "article"])
            body = f"<{tag}{self.named('body', 0.4)} data-content=\"1\">{'<br><br>'.join(self.words(5, 60) for _ in range(rng.randint(1, 9)))}</{tag}>"
        elif tag != "main" and rng.random() < 0.2:
            body = f"<main{self.named('body', 0.3)}>{body}</main>"
        before = [self.rest(x) for x in ("notice", "top", "menu", "advert") if rng.random() < 0.5]
        after = [self.rest(x) for x in ("talk", "side", "advert", "share", "form", "notice") if rng.random() < 0.3]
        middle = "".join(before) + body + "".join(after)
        if rng.random() < 0.4:
            middle = f"<div{self.named('wrap', 0.9)}>{middle}</div>"
        return _page(middle + (self.rest("foot") if rng.random() < 0.8 else ""))


LABELLED = WRITTEN + [_Draw(i).page() for i in range(DRAWN)]
