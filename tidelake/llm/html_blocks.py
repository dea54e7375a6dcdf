"""Text blocks of a page, each with what the markup says about it."""

from __future__ import annotations

import re
from functools import lru_cache
from html.parser import HTMLParser

# Elements of the HTML standard.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl",
         "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
         "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table",
         "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul"}
SILENT = {"script", "style", "noscript", "template", "iframe", "svg", "math", "object", "canvas", "head", "title",
          "select", "button", "textarea", "option", "datalist", "audio", "video"}
ASIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
ENDS_ITSELF = {"p": BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
               "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
MAIN_ROLE, ASIDE_ROLE = {"main", "article"}, {"navigation", "banner", "contentinfo", "complementary", "search", "form",
                                              "dialog", "alert", "menu", "menubar"}
MARKED = re.compile(r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|banner|sponsor(?:ed)?|promo|nav|navbar|menu|sidebar|cookies?"
                    r"|consent|notice|popup|modal|comments?|disqus|repl(?:y|ies)|respond|share|social|related|breadcrumbs?|footer"
                    r"|header|masthead|newsletter|subscribe|login|signup|pagination|widget|toolbar|copyright)(?:$|[\s_-])", re.I)
WORDY = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "figure", "figcaption", "table", "pre", "dl", "dd", "dt"}
ARTICLE_PART = re.compile(r"(?:^|[_-])(?:article|post|entry|story|content|section|chapter|headline|title)(?:$|[_-])", re.I)
# last words of compounds that still name furniture ("share-buttons"), unlike "share-price"
FURNITURE = re.compile(r"[_-](?:bars?|box(?:es)?|buttons?|links?|lists?|items?|icons?|wrap|wrapper|containers?|labels?|text|blocks?|slots?"
                       r"|units?|areas?|messages?|msg|title|info|notes?|tools?|sections?|body|content|inner|counts?|meta|this|us|now"
                       r"|posts|articles|stories|more|media|top|bottom|left|right|main|row|col|\d+)$", re.I)
# Elements whose content is markup like any other; their tags without attributes need no further rules
ORDINARY = (BLOCK - {"title"}) | {"a", "abbr", "b", "br", "cite", "code", "em", "i", "mark", "q", "s", "small", "span", "strong",
                                  "sub", "sup", "time", "u"}
PLAIN_START, PLAIN_END = re.compile("<([a-z][a-z0-9]*)>"), re.compile("</([a-z][a-z0-9]*)>")


@lru_cache(maxsize=4096)
def furniture(tag: str, names: str, in_article: bool) -> bool:
    """Whether a class or id names page furniture.  In an article, the header of an article's part (``article-header``)
    does not, nor does a text element's compound that only begins with such a word (``share-price``)."""
    for name in names.split() if MARKED.search(names) else ():
        if not MARKED.search(name):
            continue
        if in_article and re.search(r"(?:^|[_-])(?:header|banner|masthead)$", name, re.I) and ARTICLE_PART.search(name):
            continue
        if in_article and tag in WORDY and not FURNITURE.search(name) and not MARKED.search(re.split(r"[_-]", name)[-1]):
            continue
        return True
    return False


class Blocks(HTMLParser):
    """Collects (text, in the article, set aside) for every block with text, in page order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, bool, bool]] = []  # name, and the state before it
        self.main = self.aside = self.silent = False
        self.found: list[tuple[str, bool, bool]] = []
        self.held: list[str] = []

    def cut(self) -> None:
        if self.held:
            text = " ".join("".join(self.held).split())
            self.held = []
            if text:
                self.found.append((text, self.main, self.aside))

    def updatepos(self, i, j):  # lines are not counted
        return j

    def parse_starttag(self, i):
        plain = PLAIN_START.match(self.rawdata, i)
        if not plain or plain[1] not in ORDINARY:
            return super().parse_starttag(i)
        self.lasttag = plain[1]
        self.handle_starttag(plain[1], ())
        return plain.end()

    def parse_endtag(self, i):
        plain = PLAIN_END.match(self.rawdata, i) if self.cdata_elem is None else None
        if not plain or plain[1] not in ORDINARY:
            return super().parse_endtag(i)
        self.handle_endtag(plain[1])
        return plain.end()

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.cut()
            while self.open and tag in ENDS_ITSELF.get(self.open[-1][0], ()):
                self.leave(len(self.open) - 1)
            if tag not in ("div", "section"):
                for at in range(len(self.open) - 1, -1, -1):
                    if self.open[at][0] in BLOCK:
                        if tag in ENDS_ITSELF.get(self.open[at][0], ()):
                            self.leave(at)
                        break
        if tag == "br":
            self.held.append(" ")
        if tag in VOID:
            return
        self.open.append((tag, self.main, self.aside, self.silent))
        if tag in ("article", "main"):
            self.main = True
        if tag in ASIDE:
            self.aside = True
        if tag in SILENT:
            self.silent = True
        if attrs:
            self.attributes(tag, dict(attrs))

    def attributes(self, tag, a):
        role = (a.get("role") or "").lower()
        if role in MAIN_ROLE:
            self.main = True
        if role in ASIDE_ROLE or "hidden" in a:
            self.aside = True
        elif tag not in ("html", "body", "article", "main") and any(
                furniture(tag, a[k], self.main) for k in ("class", "id") if a.get(k)):
            self.aside = True
        if tag in ("article", "main") and MARKED.search(a.get("class") or ""):
            self.aside = True  # a comment or an advert marked up as an article

    def handle_startendtag(self, tag, attrs):
        if tag in BLOCK:
            self.cut()
        if tag == "br":
            self.held.append(" ")

    def leave(self, at: int) -> None:
        _, self.main, self.aside, self.silent = self.open[at]
        del self.open[at:]

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.cut()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self.leave(i)
                return
            if tag not in BLOCK and self.open[i][0] in BLOCK:
                return  # a stray inline end tag closes no block

    def handle_data(self, data):
        if not self.silent:
            self.held.append(data)


def blocks_of(html: str) -> list[tuple[str, bool, bool]]:
    parser = Blocks()
    parser.feed(html)
    parser.close()
    parser.cut()
    return parser.found
