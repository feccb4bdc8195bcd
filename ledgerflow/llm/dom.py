"""A forgiving HTML tree for text extraction: elements, text and features."""

from __future__ import annotations

import html as _html
import re
from collections import Counter

import numpy as np

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs2>[^>]*)>", re.S)
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
# Fixed values of HTML: elements without end tags, raw-text elements, elements
# that never show text, block elements, those of running text, and what a start
# tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
FOREIGN = frozenset(("svg", "math"))     # these may be self-closing
_RAW_END = {t: re.compile(f"</{t}", re.I | re.A) for t in RAW}
HIDDEN = RAW | frozenset("head select option button object canvas datalist audio video".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr li main menu nav ol p pre section summary table caption tbody thead tfoot tr td th ul".split())
FLOW = frozenset("p li dt dd h1 h2 h3 h4 h5 h6 blockquote pre td th caption figcaption summary address".split())
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "option": ({"option"}, {"select"})}
_SCOPE = frozenset("html body table td th caption button object".split())
# Words of class, id and role attributes, by what they name.
TOKENS = {
    "content": "article content main post entry body story text prose paragraph page".split(),
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager tabs toolbar sitemap skip links".split(),
    "head": "header head masthead topbar branding logo banner top site".split(),
    "foot": "footer foot bottom copyright legal colophon credits imprint contentinfo".split(),
    "side": "sidebar side aside related widget recommended recommendations trending popular more complementary rail teaser archive tags".split(),
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion dfp adsense adbox commercial".split(),
    "notice": "cookie cookies consent gdpr notice popup modal overlay alert warning privacy paywall announcement".split(),
    "social": "share sharing social follow facebook twitter like buttons".split(),
    "comment": "comment comments commentlist disqus reply replies respond discussion responses feedback reader".split(),
    "form": "form login signin signup subscribe subscription newsletter search register contact input".split(),
}
GROUPS = list(TOKENS)
_GROUP_OF: dict[str, list[int]] = {}
for _i, _words in enumerate(TOKENS.values()):
    for _w in _words:
        _GROUP_OF.setdefault(_w, []).append(_i)
TAGS = ["article", "main", "section", "div", "p", "h1", "h2", "list", "li", "table", "nav", "header", "footer", "aside", "form", "quote", "body", "inline"]
_TAG_OF = {"html": "body", "h3": "h2", "h4": "h2", "h5": "h2", "h6": "h2", "ul": "list", "ol": "list", "dl": "list", "menu": "list", "dd": "li", "dt": "li",
           "tbody": "table", "thead": "table", "tfoot": "table", "tr": "table", "td": "table", "th": "table", "caption": "table", "blockquote": "quote",
           "pre": "quote", "figure": "quote", "figcaption": "quote", "fieldset": "form"}
_TAG_NO = {t: i for i, t in enumerate(TAGS)}
NUMERIC = ["depth", "log_chars", "page_share", "link_share", "log_words", "chars_per_block", "tags_per_chars", "p_share", "li_share", "stops_per_word",
           "sibling_no", "siblings", "parent_share", "same_tag_siblings", "after_heading", "begins_at", "ends_at", "largest_sibling_share", "own_share", "legal_sign"]
FEATURES = NUMERIC + [f"tag_{t}" for t in TAGS] + [f"own_{g}" for g in GROUPS] + [f"in_{g}" for g in GROUPS] + \
    ["in_nav", "in_header", "in_footer", "in_aside", "in_form", "in_article", "in_main", "hidden"]
_IN = ["nav", "header", "footer", "aside", "form", "article", "main"]
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_STOPS = re.compile(r"[.!?;,]")


class Page:
    """Elements as parallel lists, in page order; element 0 is the page.

    ``items`` holds (element, text) in page order; text None is a boundary
    between blocks, and white space within a block is not yet collapsed."""

    def __init__(self, source: str):
        self.tag, self.parent, self.depth, self.attrs = ["html"], [-1], [0], [""]
        self.items: list[tuple[int, str | None]] = []
        self._stack = [0]
        self._open_p = [0]              # p elements open in the scope of each open element
        self._n_open: Counter[str] = Counter()
        self._parse(source)

    def _open(self, tag: str, attrs: str) -> None:
        own = len(self.tag)
        self.tag.append(tag)
        self.parent.append(self._stack[-1])
        self.depth.append(self.depth[self._stack[-1]] + 1)
        self.attrs.append(attrs)
        self._stack.append(own)
        self._open_p.append((0 if tag in _SCOPE else self._open_p[-1]) + (tag == "p"))
        self._n_open[tag] += 1

    def _pop_to(self, place: int) -> None:
        if any(self.tag[n] in BLOCK for n in self._stack[place:]):
            self.items.append((self._stack[place], None))
        for n in self._stack[place:]:
            self._n_open[self.tag[n]] -= 1
        del self._stack[place:], self._open_p[place:]

    def _close(self, names: set[str] | frozenset[str], bounds: set[str] | frozenset[str]) -> None:
        for place in range(len(self._stack) - 1, 0, -1):
            tag = self.tag[self._stack[place]]
            if tag in names:
                self._pop_to(place)
                return
            if tag in bounds:
                return

    def _parse(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            m = _TOKEN.search(source, at)
            begin = m.start() if m else size
            if begin > at:
                self.items.append((self._stack[-1], source[at:begin]))
            if not m:
                break
            at = m.end()
            tag = (m["tag"] or m["tag2"] or "").lower()
            if not tag:
                continue
            if m["end"] or m["end2"]:
                self._end(tag)
                continue
            attrs = m["attrs"] or m["attrs2"] or ""
            if tag in FOREIGN and attrs.endswith("/"):
                continue
            if tag in RAW:
                stop = _RAW_END[tag].search(source, at)
                at = source.find(">", stop.start()) + 1 or size if stop else size
                continue
            if tag == "br":
                self.items.append((self._stack[-1], " "))
                continue
            if tag in BLOCK:
                if tag in ("html", "body") and self._stack[0] == 0 and tag == "html":
                    self.attrs[0] += attrs
                    continue
                if self._open_p[-1]:
                    self._close({"p"}, _SCOPE)
                if tag in CLOSES:
                    self._close(*CLOSES[tag])
                if tag == "body":
                    self._close({"head"}, {"html"})
                self.items.append((self._stack[-1], None))
            elif tag == "option":
                self._close(*CLOSES[tag])
            if tag in VOID or attrs.endswith("/") and tag not in BLOCK and tag not in ("a", "b", "i", "span", "em", "strong"):
                continue
            self._open(tag, attrs)

    def _end(self, tag: str) -> None:
        if not self._n_open[tag]:
            return
        for place in range(len(self._stack) - 1, 0, -1):
            own = self.tag[self._stack[place]]
            if own == tag:
                self._pop_to(place)
                return
            if own in BLOCK and tag not in BLOCK:
                return      # an inline end tag does not close a block

    # -- what the classifier sees -----------------------------------------------

    def nodes(self) -> np.ndarray:
        """The classified elements: blocks, and others with a class, id or role
        that are no part of running text (a link or emphasis in a paragraph, or
        beside text of its parent, belongs to that text)."""
        beside = {i for i, text in self.items if text and text.strip()}
        flow = [False] * len(self.tag)
        out = []
        for i, (t, a) in enumerate(zip(self.tag, self.attrs)):
            p = self.parent[i]
            if t in BLOCK:
                flow[i] = t in FLOW
                out.append(i)
                continue
            flow[i] = flow[p] or p in beside
            if not flow[i] and t not in HIDDEN and any(m[1].lower() in ("class", "id", "role") for m in _ATTR.finditer(a)):
                out.append(i)
        return np.array(out, dtype=np.int64)

    def hidden(self) -> np.ndarray:
        """True for elements that show no text."""
        out = np.zeros(len(self.tag), dtype=bool)
        for i, t in enumerate(self.tag):
            out[i] = t in HIDDEN or (i > 0 and out[self.parent[i]])
        return out

    def features(self, nodes: np.ndarray) -> np.ndarray:
        n = len(self.tag)
        chars, words, stops, links, tags, blocks, ps, lis, own_chars = (np.zeros(n) for _ in range(9))
        first, last = np.full(n, np.inf), np.zeros(n)
        hidden = self.hidden()
        in_link = np.zeros(n, dtype=bool)
        for i in range(1, n):
            in_link[i] = self.tag[i] == "a" or in_link[self.parent[i]]
        legal = np.zeros(n, dtype=bool)
        run = 0
        for i, text in self.items:
            if text is None or hidden[i]:
                continue
            w = len(text.split())
            if not w:
                continue
            k = len(text)
            chars[i] += k
            own_chars[i] += k
            words[i] += w
            stops[i] += len(_STOPS.findall(text))
            links[i] += k * in_link[i]
            blocks[i] += 1
            legal[i] |= "©" in text or "&copy" in text
            first[i], last[i] = min(first[i], run), run + k
            run += k
        for i in range(1, n):
            tags[i] = 1
            ps[i] = self.tag[i] == "p"
            lis[i] = self.tag[i] == "li"
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            for x in (chars, words, stops, links, tags, blocks, ps, lis):
                x[p] += x[i]
            legal[p] |= legal[i]
            first[p], last[p] = min(first[p], first[i]), max(last[p], last[i])
        children: list[list[int]] = [[] for _ in range(n)]
        for i in range(1, n):
            children[self.parent[i]].append(i)
        own = np.zeros((n, len(GROUPS)), dtype=bool)
        shut = np.zeros(n, dtype=bool)
        for i, a in enumerate(self.attrs):
            if a and a != "/":
                for m in _ATTR.finditer(a):
                    name = m[1].lower()
                    if name in ("class", "id", "role"):
                        for w in _WORDS.findall(m[2] or m[3] or m[4] or ""):
                            for g in _GROUP_OF.get(w.lower(), ()):
                                own[i, g] = True
                    elif name == "hidden" or name == "style" and "none" in (m[2] or m[3] or ""):
                        shut[i] = True
        within = np.zeros((n, len(GROUPS)), dtype=bool)
        inside = np.zeros((n, len(_IN)), dtype=bool)
        for i in range(1, n):
            p = self.parent[i]
            within[i] = within[p] | own[p]
            inside[i] = inside[p]
            if self.tag[p] in _IN:
                inside[i, _IN.index(self.tag[p])] = True
            shut[i] |= shut[p]
        place, alike, largest = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), np.zeros(n)
        for around in children:
            kinds = Counter(self.tag[x] for x in around)
            most = max((chars[x] for x in around), default=0)
            for k, x in enumerate(around):
                place[x], alike[x], largest[x] = k, kinds[self.tag[x]], most
        alike[0], largest[0] = 1, chars[0]
        out = np.zeros((len(nodes), len(FEATURES)), dtype=np.float32)
        total = max(run, 1)
        for r, i in enumerate(nodes.tolist()):
            p = self.parent[i]
            around = children[p] if p >= 0 else [i]
            at = int(place[i])
            c = chars[i]
            out[r, :len(NUMERIC)] = (
                min(self.depth[i], 20), np.log1p(c), c / total, links[i] / max(c, 1), np.log1p(words[i]), c / max(blocks[i], 1),
                100 * tags[i] / max(c, 1), ps[i] / max(tags[i], 1), lis[i] / max(tags[i], 1), stops[i] / max(words[i], 1), min(at, 50),
                min(len(around), 50), c / max(chars[p], 1) if p >= 0 else 1, alike[i] / len(around),
                at > 0 and self.tag[around[at - 1]] in ("h1", "h2", "h3"), min(first[i], total) / total, last[i] / total,
                c / max(largest[i], 1), own_chars[i] / max(c, 1), legal[i])
            tag = _TAG_OF.get(self.tag[i], self.tag[i])
            out[r, len(NUMERIC) + _TAG_NO.get(tag, _TAG_NO["div" if self.tag[i] in BLOCK else "inline"])] = 1
            base = len(NUMERIC) + len(TAGS)
            out[r, base:base + len(GROUPS)] = own[i]
            out[r, base + len(GROUPS):base + 2 * len(GROUPS)] = within[i]
            out[r, base + 2 * len(GROUPS):base + 2 * len(GROUPS) + len(_IN)] = inside[i]
            out[r, -1] = shut[i]
        return out

    def text(self, kept: np.ndarray) -> str:
        """The text of kept elements: references decoded, white space within
        a block collapsed, blocks joined by one space."""
        parts = [" " if text is None else _html.unescape(text) if "&" in text else text for i, text in self.items if text is None or kept[i]]
        return " ".join("".join(parts).split())
