"""Markup in texts, whole or in remains: found, named and turned into clean text.

A lexer for the signs of wiki text, HTML, Markdown and LaTeX builds a tree of candidate nodes: an element is the parent of what stands between its
tags, code blocks and formulas are parents of what they enclose. Each node has integer features (its sign, attribute tokens, closedness, depth, equal
siblings, density of its subtree, surroundings, and how much of each markup the rest of the text shows). Boosted trees, trained on
generated texts whose nodes are known, give every node a distribution over (markup, element) and
none. Decoding goes from ancestors to descendants and weighs both together: a node inside a code block or formula is
nothing of its own, so a block is taken only if that explains its inside at least as well as its parts do; and what stands in the element of a
heading is neither a heading nor a list.
"""

from __future__ import annotations

import html
import random
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from palimpsest.llm.gbt import Trees, boost

MARKUPS = ("wiki", "html", "markdown", "latex")
ELEMENTS = ("any", "heading", "list", "code", "formula")
#: Class 0 is none; class 1 + 5 * markup + element.
N_CLASSES = 1 + len(MARKUPS) * len(ELEMENTS)


def cls(markup: str, element: str = "any") -> int:
    return 1 + 5 * MARKUPS.index(markup) + ELEMENTS.index(element)


# Tag names of wiki text and of HTML, code-like environments, environments that hold formulas, lists or sections.
WIKI_TAGS = frozenset("ref references nowiki syntaxhighlight source math gallery noinclude includeonly onlyinclude poem timeline score templatestyles".split())
HTML_TAGS = frozenset(
    "a abbr address article aside b base bdi bdo big blockquote body br button canvas caption center cite code col colgroup data dd del details dfn dialog div dl dt em "
    "embed fieldset figcaption figure font footer form frame frameset h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main map mark "
    "menu meta meter nav noscript object ol optgroup option output p param picture pre progress q rp rt ruby s samp script section select small span strike strong style sub "
    "summary sup svg table tbody td template textarea tfoot th thead time title tr track tt u ul var video wbr mi mn mo mrow msup msub mfrac msqrt semantics annotation".split()
)
VOID = frozenset("area base br col embed hr img input link meta param track wbr".split())
CODE_ENVIRONMENTS = frozenset(("verbatim", "lstlisting", "minted", "Verbatim", "alltt"))
FORMULA_ENVIRONMENTS = frozenset(("equation", "align", "gather", "multline", "eqnarray", "displaymath", "math", "alignat", "flalign"))
LIST_ENVIRONMENTS = frozenset(("itemize", "enumerate", "description"))
SECTIONS = frozenset(("part", "chapter", "section", "subsection", "subsubsection", "paragraph", "subparagraph"))
COMMANDS = frozenset(
    "textbf textit emph texttt textsc textrm textsf underline cite citep citet ref label footnote mbox url href item begin end bf it em rm sf tt sc large Large small tiny "
    "caption includegraphics title author date maketitle newline hline centering noindent bibliography usepackage documentclass input include vspace hspace par pageref eqref".split()
)

_TOKEN = re.compile(
    r"""(?P<wheading>^[ \t]*={2,6}[^=\n][^\n]*)
|(?P<underline>^(?:={3,}|-{3,})[ \t]*$)
|(?P<fence>^[ ]{0,3}(?:```+|~~~+)[^\n`]*$)
|(?P<mdtable>^\|?[ \t]*:?-{3,}:?[ \t]*\|[-|: \t]*$)
|(?P<wtable>^[ \t]*(?:\{\||\|\}|\|-|\|\+))
|(?P<sign>^[ \t]*(?:[*#][*#:]*(?=[^\n])|[-+](?=[ \t])|\d{1,3}[.)](?=[ \t])))
|(?P<comment><!--)
|(?P<tag></?[ \t]*[A-Za-z][A-Za-z0-9]*(?:[ \t][^<>\n]*)?/?>|</?[A-Za-z][A-Za-z0-9]*[ \t]+[a-z]+=[^\s<>]*)
|(?P<entity>&(?:\#\d{1,7}|\#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});)
|(?P<wlink>\[\[[^\[\]\n]*\]\]|\[\[|\]\])
|(?P<template>\{\{[^{}]*\}\}|\{\{|\}\})
|(?P<elink>\[(?:https?:)?//[^\s\]]+[^\]\n]*\]?)
|(?P<mdlink>!?\[[^\[\]\n]*\]\([^()\n]*\)|!\[[^\[\]\n]*\]?|\[\^[^\[\]\s]+\]:?|\[[^\[\]\n]+\]\[[^\[\]\n]*\]|\[[^\[\]\n]+\]\([^()\s]*(?=\s|$))
|(?P<quotes>''+)
|(?P<stars>\*{1,3}(?=[^\s*])[^*\n]*\*{1,3}|\*{2,3})
|(?P<ticks>`[^`\n]+`)
|(?P<strike>~~(?=[^\s~])[^~\n]*~~|~{3,5}|(?<=\w)~(?=\\))
|(?P<under>__[A-Z]+__|(?<!\w)_{1,2}(?=[^\s_])[^_\n]*[^\s_]_{1,2}(?!\w))
|(?P<math>\\[(\[]|\$\$?)
|(?P<command>\\[a-zA-Z]+\*?|\\['`^"~=.][a-zA-Z]|\\[%&_\#{}$]|\\\\(?=[ \t]*$)|\{\\[a-z]+(?=\s))
""",
    re.M | re.S | re.X,
)
#: Where a token may begin: found by character set, so most of a text is skipped at once.
_TRIGGER = re.compile(r"\n(?=[ \t]*[=\-`~|{#*+0-9:])|[<&\[\]{}*`~_\\$]|''|!\[")
KINDS = tuple(_TOKEN.groupindex) + ("pre", "code", "env", "indent", "wcell")
_K = {k: i for i, k in enumerate(KINDS)}
_TAG_NAME = re.compile(r"</?[ \t]*([A-Za-z][A-Za-z0-9]*)")
_ATTR = re.compile(r"[ \t][a-zA-Z-]+[ \t]*=")
_ENV = re.compile(r"\{([A-Za-z]+)\*?\}")
_TEX = re.compile(r"[\\^_={}<>+]")
_RAISED = re.compile(r"[\\^_]")
_MATHML = re.compile(r"<m(?:i|n|o|row|sup|sub|frac|sqrt)\b", re.I)

# Feature columns.
KIND, NAME, CLOSED, SPACE, CONTENT, BEFORE, DEPTH, SIBLINGS, DENSITY, ATTRS, WIKI, HTML, MARKDOWN, LATEX, LEAD, NESTING = range(16)
_RADIX = (32, 8, 2, 2, 8, 4, 4, 4, 4, 4, 5, 5, 5, 5, 3, 4)
N_FEATURES = len(_RADIX)
#: Sign whose markup hardly depends on the rest of the text: what counts as showing a markup.
_SHOWS = {"wlink": 0, "template": 0, "wtable": 0, "elink": 0, "wheading": 0, "mdlink": 2, "mdtable": 2, "fence": 2, "ticks": 2, "entity": 1, "comment": 1, "math": 3}


def _content(s: str) -> int:
    """0 empty, 1 digits, 2 TeX signs, 3 words, 4 MathML, 5 other."""
    if not s.strip():
        return 0
    if _MATHML.search(s):
        return 4
    if s.strip()[0].isdigit() and not ("\\" in s or "^" in s or "_" in s):
        return 1
    if _TEX.search(s):
        return 2
    return 3 if s.strip()[0].isalpha() else 5


def _before(text: str, at: int) -> int:
    if not at:
        return 0
    c = text[at - 1]
    return 0 if c == "\n" else 1 if c.isspace() else 2 if c.isalnum() or c in ":/\\" else 3


def lex(text: str) -> tuple[list, list]:
    """(features, nodes) of a text: a node is [kind, start, end, inner start, inner end, parent, end of span]."""
    nodes, feats, shows = [], [], []
    spans: list[tuple[int, int]] = []  # (end, node) of open blocks, innermost last
    stack: list[tuple[str, int]] = []  # open tags
    places: dict[str, list[int]] = {}  # of each name in the stack: a closing tag without opening must not search all of it
    skip = 0
    find = text.find
    gone: set[str] = set()  # closing signs known not to come any more: openings without end must not each scan the rest

    def ending(sign: str, start: int) -> int:
        """Position of the next ``sign``, -1 if there is none."""
        if sign in gone:
            return -1
        at = find(sign, start)
        if at < 0:
            gone.add(sign)
        return at

    def closer(key: str, pattern: str, start: int):
        """Next match of a pattern that is named ``key``."""
        if key in gone:
            return None
        m = re.compile(pattern, re.I | re.M).search(text, start)
        if m is None:
            gone.add(key)
        return m

    nexts: dict[re.Pattern, tuple[int, int, int]] = {}  # searched from, next match

    def has(pattern: re.Pattern, start: int, end: int) -> bool:
        """Does the pattern occur between? Openings that share their end must not each search up to it."""
        known = nexts.get(pattern)
        if known is None or not known[0] <= start <= known[1]:
            m = pattern.search(text, start)
            known = nexts[pattern] = (start, *(m.span() if m else (len(text) + 1, len(text) + 1)))
        return known[2] <= end

    def content(start: int, end: int) -> int:
        """``_content`` of a part of any length."""
        at = start
        while at < end and text[at].isspace():
            at += 1
        if at == end:
            return 0
        if has(_MATHML, start, end):
            return 4
        if text[at].isdigit() and not has(_RAISED, start, end):
            return 1
        if has(_TEX, start, end):
            return 2
        return 3 if text[at].isalpha() else 5

    def add(kind, start, end, name=0, closed=1, space=0, content=5, attrs=0, span=0, inner=None, show=-1):
        while spans and spans[-1][0] <= start:
            spans.pop()
        parent = spans[-1][1] if spans else -1
        i = len(nodes)
        a, b = inner or (end, end)
        nodes.append([kind, start, end, a, b, parent, span or end])
        feats.append([_K[kind], name, closed, space, content, _before(text, start), min(3, len(spans)), 0, 0, min(3, attrs), 0, 0, 0, 0, 0, min(3, len(stack))])
        shows.append(show)
        if span > end:
            spans.append((span, i))
        return i

    search, match, first, begun = _TRIGGER.search, _TOKEN.match, True, False
    while True:
        if first:
            at, first = 0, False
        else:
            hit = search(text, skip)
            if hit is None:
                break
            at = hit.start()
            if text[at] == "\n":
                at += 1
        m = match(text, at)
        if m is None:
            skip = max(skip, at + (at > 0 or begun))
            begun = True
            continue
        begun = True
        kind, s, e = m.lastgroup, m.start(), m.end()
        skip = e
        tok = m.group()
        show = _SHOWS.get(kind, -1)
        if kind == "tag":
            low = _TAG_NAME.match(tok).group(1).lower()
            known = 1 if low in WIKI_TAGS else 2 if low in HTML_TAGS else 0
            closing, whole = tok[1] == "/", tok.endswith(">")
            show = known - 1
            if known == 2 and low[0] == "h" and low[1:].isdigit():
                name = 3
            elif low in ("ul", "ol", "li", "dl", "dd", "dt"):
                name = 4
            else:
                name = known
            if not closing and whole and not tok.endswith("/>") and low in ("pre", "syntaxhighlight", "source", "math"):
                at = closer(f"</{low}", rf"</\s*{low}\s*>", e)
                if at:
                    block = "math" if low == "math" else "pre" if low == "pre" else "code"
                    add(block, s, e, 1 + known, 1, 0, content(e, at.start()) if block == "math" else 5, len(_ATTR.findall(tok)), at.end(), (e, at.start()), show)
                    continue
            if closing:
                matched = bool(places.get(low))
                if matched:
                    hit = places[low][-1]
                    feats[stack[hit][1]][CLOSED] = 1
                    nodes[stack[hit][1]][6] = s  # the element ends where its closing tag begins, which is a sibling
                    while len(stack) > hit:
                        places[stack.pop()[0]].pop()
                add(kind, s, e, name, int(matched), 0, 5, 0, show=show)
            else:
                i = add(kind, s, e, name, int(low in VOID or tok.endswith("/>")) if whole else 0, 0, 5, len(_ATTR.findall(tok)), show=show)
                if whole and low not in VOID and not tok.endswith("/>") and known:
                    places.setdefault(low, []).append(len(stack))
                    stack.append((low, i))
        elif kind == "comment":
            at = ending("-->", e)
            skip = e = at + 3 if at >= 0 else e
            add(kind, s, e, int(at >= 0), int(at >= 0), show=show)
        elif kind == "fence":
            mark = tok.strip()
            mark = mark[: len(mark) - len(mark.lstrip(mark[0]))]
            at = closer(mark, rf"^[ ]{{0,3}}{re.escape(mark)}{re.escape(mark[0])}*[ \t]*$", e + 1)
            if at:
                add(kind, s, e, 0, 1, 0, 5, 0, at.end(), (min(e + 1, at.start()), at.start()), show)
            else:
                add(kind, s, e, 0, 0)
        elif kind == "math":
            if tok[0] == "\\":
                at = ending("\\)" if tok[1] == "(" else "\\]", e)
                ok = at >= 0
                add(kind, s, e, 4, int(ok), 0, content(e, at) if ok else 5, 0, at + 2 if ok else 0, (e, at) if ok else None, show)
            elif tok == "$$":
                at = ending("$$", e)
                ok = at > e
                add(kind, s, e, 5, int(ok), 0, content(e, at) if ok else 5, 0, at + 2 if ok else 0, (e, at) if ok else None, show if ok else -1)
            else:
                nxt = text[e] if e < len(text) else " "
                line = find("\n", e)
                at = find("$", e, line if line >= 0 else len(text))
                ok = at > e and not nxt.isspace() and not text[at - 1].isspace() and not (at + 1 < len(text) and text[at + 1].isalnum()) and not nxt.isdigit()
                c = _content(text[e:at]) if ok else 1 if nxt.isdigit() else 5
                add(kind, s, e, 6, int(ok), int(nxt.isspace()), c, 0, at + 1 if ok else 0, (e, at) if ok else None, show if ok and c == 2 else -1)
        elif kind == "command":
            if tok.startswith(("\\begin", "\\end")):
                env = _ENV.match(text, e)
                name = env.group(1) if env else ""
                what = 1 if name in CODE_ENVIRONMENTS else 2 if name in FORMULA_ENVIRONMENTS else 3 if name in LIST_ENVIRONMENTS else 4 if name else 0
                close = env.group().join(("\\end", "")) if env and tok == "\\begin" else ""
                at = ending(close, env.end()) if close else -1
                if what in (1, 2) and at >= 0:
                    add("env", s, env.end(), what, 1, 0, 5, 0, at + len(close), (env.end(), at), 3)
                else:
                    add("env", s, env.end() if env else e, what, int(at >= 0 or tok == "\\end"), 0, 5, show=3 if name else -1)
            else:
                bare = tok.lstrip("{\\").rstrip("*")
                name = 1 if bare in SECTIONS else 2 if bare == "item" else 3 if bare in COMMANDS else 4 if len(tok) == 3 and tok[1] in "'`^\"~=." else 5 if len(bare) < 2 else 0
                nxt = text[e] if e < len(text) else " "
                add(kind, s, e, name, int(nxt in "{["), int(nxt.isspace()), 5, 0, show=3 if name in (1, 2, 3) and _before(text, s) != 2 or name == 0 and nxt == "{" else -1)
        elif kind == "wheading":
            shut = tok.rstrip().endswith("==")
            add(kind, s, e, 0, int(shut), 0, 3, 0, show=show if shut else -1, inner=(s, e))
        elif kind == "underline":
            up = text[:s].rsplit("\n", 2)[-2:][0] if s else ""
            prev = text[text.rfind("\n", 0, s - 1) + 1 : s - 1] if s > 1 else ""
            title = bool(prev.strip()) and prev[:1] not in "=|*#-{<" and up is not None
            add(kind, s, e, int(title), 1, 0, 3 if title else 0, show=2 if title else -1)
        elif kind == "sign":
            mark = tok.strip()
            name = {"*": 0, "-": 1, "+": 2}.get(mark[0], 3 if mark[0].isdigit() else 4)
            line = find("\n", e)
            if mark[0] == "*" and find("*", e, line if line >= 0 else len(text)) >= 0 and not text[e : e + 1].isspace() and len(mark) < 4:
                rest = re.compile(r"\*{1,3}(?=[^\s*])[^*\n]*\*{1,3}").match(text, s + len(tok) - len(mark))
                if rest:  # emphasis that begins the line
                    add("stars", s, rest.end(), min(3, len(mark)), 1, 0, 3, show=2 if len(mark) > 1 else -1, inner=(s + len(tok), rest.end()))
                    skip = rest.end()
                    continue
            deep = int(len(mark) > 1 and mark[0] in "*#") + (1 if mark[0] == "#" and len(set(mark)) == 1 and len(mark) > 1 else 0)
            stop = find("\n", e)
            alone = (s < 2 or text[s - 2 : s] == "\n\n") and (stop < 0 or not text[stop : stop + 2].strip())
            add(kind, s, e, name, deep & 1, int(text[e : e + 1].isspace()), (5 if deep < 2 else 4) + 2 * alone, min(3, len(tok) - len(tok.lstrip())))
        elif kind == "stars":
            n = len(tok) - len(tok.lstrip("*"))
            good = len(tok) > 3 and tok.endswith("*" * n) and not tok[:-n].endswith((" ", "\t"))
            add(kind, s, e, min(3, n), int(good), int(text[e : e + 1].isspace()), 3 if good else 0, show=2 if good and n > 1 else -1, inner=(s + n, e - n) if good else None)
        elif kind == "quotes":
            add(kind, s, e, min(5, len(tok)), 1, 0, show=0)
        elif kind == "strike":
            name = 1 if tok == "~" else 2 if tok.startswith("~~~") else 3
            add(kind, s, e, name, 1, show=3 if name == 1 else 0 if name == 2 else 2, inner=(s + 2, e - 2) if name == 3 else None)
        elif kind == "under":
            name = 1 if tok[2:-2].isupper() and tok.startswith("__") and tok[2:-2].isalpha() else 2
            add(kind, s, e, name, 1, show=0 if name == 1 else -1)
        elif tok == "}}" and "{{" not in (before := text[text.rfind("\n", 0, s) + 1 : s]) and "\\" in before and before.count("{") - before.count("}") >= 2:
            continue  # two groups of commands that end together
        elif kind in ("wlink", "template"):
            add(kind, s, e, 0 if len(tok) > 2 else 1 if tok[0] in "[{" else 2, int(len(tok) > 2), show=show if len(tok) > 2 or tok[0] in "[{" else -1, inner=(s + 2, e - 2) if len(tok) > 2 else None)
        elif kind in ("ticks", "mdlink", "elink"):
            add(kind, s, e, int(tok[0] == "!"), int(tok[-1] in ")]`"), show=show, inner=(s + 1, e - 1) if kind == "ticks" else None)
        else:
            add(kind, s, e, 1, 1, show=show)
    _nest(nodes, feats)
    _context(text, nodes, feats, shows)
    return feats, nodes


def _nest(nodes: list, feats: list) -> None:
    """Parents, and depths in blocks and in elements: a node's parent is the innermost of both that it begins in. One that crosses its parent's end, ends there."""
    around: list[tuple[int, int, int, int]] = []  # (end, node, blocks, elements), innermost last
    for i, n in enumerate(nodes):
        while around and around[-1][0] <= n[1]:
            around.pop()
        end, n[5], blocks, elements = around[-1] if around else (n[6], -1, 0, 0)
        feats[i][DEPTH], feats[i][NESTING] = min(3, blocks), min(3, elements)
        if n[6] > n[2]:
            tag = n[0] == "tag"
            around.append((min(n[6], end), i, blocks + (not tag), elements + tag))


def _context(text: str, nodes: list, feats: list, shows: list) -> None:
    """Fill the features that look at the whole text: evidence outside blocks, equal siblings, subtree density."""
    block = [False] * len(nodes)
    for i, n in enumerate(nodes):
        p = n[5]
        block[i] = p >= 0 and (block[p] or feats[p][KIND] in _SOLID and feats[p][CLOSED] == 1)
    seen = [0, 0, 0, 0]
    below = [0] * len(nodes)  # nodes of each subtree
    for i in range(len(nodes) - 1, -1, -1):
        if nodes[i][5] >= 0:
            below[nodes[i][5]] += below[i] + 1
    same: dict[tuple, int] = {}
    for i, n in enumerate(nodes):
        if shows[i] >= 0 and not block[i]:
            seen[shows[i]] += 1
        key = (n[5], feats[i][KIND], feats[i][NAME])
        same[key] = same.get(key, 0) + 1
    for i, n in enumerate(nodes):
        f = feats[i]
        for k in range(4):
            v = seen[k] - (shows[i] == k and not block[i])
            f[WIKI + k] = v if v < 3 else 3 if v < 6 else 4
        w, d = seen[0] - (shows[i] == 0), seen[2] - (shows[i] == 2)
        f[LEAD] = 1 + (w > d) - (d > w)
        k = same[(n[5], f[KIND], f[NAME])]
        f[SIBLINGS] = 0 if k < 2 else 1 if k < 3 else 2 if k < 6 else 3
        c = below[i] * 64 // max(1, n[6] - n[1])
        f[DENSITY] = min(3, c)


_SOLID = frozenset(_K[k] for k in ("pre", "code", "env", "fence", "math"))

# --- training texts ---------------------------------------------------------------------------------


class _Maker:
    """Texts with known constructs: a base markup, remains of others, and signs used in their plain sense."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.parts: list[tuple[str, int]] = []

    def word(self) -> str:
        return "".join(self.r.choice(("ka", "lo", "mi", "ren", "tas", "vo", "shu", "bel")) for _ in range(self.r.randint(1, 3)))

    def words(self, n: int) -> str:
        return " ".join(self.word() for _ in range(n))

    def tex(self) -> str:
        n = self.r.randint(1, 99)
        return self.r.choice(("\\frac{a_%d}{b}", "x^{%d}", "\\alpha_{%d}", "n_{%d} > 0", "\\sum_{i=1}^{%d} x_i^2", "\\sqrt{%d} \\le \\pi", "E = m c^%d", "\\lambda_%d", "a_%d + b")) % n

    def code(self) -> str:
        w, n = self.word(), self.r.randint(1, 400)
        lines = (f"int {w} = {n};", f"for x in {w}:", f"    return {w} ** {n}", f"# keep {n}", f"if ({w} < {n}) {{ {w}++; }}", f'echo "${w}"', f"SELECT * FROM {w}_{n}", f'<div id="{w}">x</div>', f"* {w}", f"{w}[{n}] = '{w}'")
        return "\n".join(self.r.sample(lines, self.r.randint(1, 4)))

    def inline(self, m: str) -> tuple[str, int]:
        r, w, v, n = self.r, self.word(), self.word(), self.r.randint(1, 999)
        if m == "wiki":
            s = r.choice((f"[[{w}]]", f"[[{w} ({v})|{w}]]", f"'''{w}'''", f"''{w}''", f"{{{{{w}|{n}|{v}}}}}", f"{{{{{w}}}}}", f"[https://{w}.example/{n} {v}]", f"<ref>{{{{cite {w}|year={n}}}}}</ref>",
                          f'<ref name="{w}">{v}</ref>', f"[[{w}", f"{w}]]", f"{{{{{w}|name={v}|x={n}", f"{w}}}}}", f"<nowiki>{w}</nowiki>", "~~~~", "__NOTOC__", f"[[File:{w}.jpg|thumb|{v}", f"[[Category:{w}]]", f"'''{w}", "</ref>", f"[[:{w}#{n}]]", '<ref name="n1" />'))
            return s, cls("wiki")
        if m == "html":
            t = r.choice("b i em span div p td font a br img small sup EM SPAN tr table th u hr strong center".split())
            s = r.choice((f"<{t}>{w}</{t}>", f'<{t} class="{v}">{w}</{t}>', f"<{t}>", f"</{t}>", f"<{t} href=/{w}/{n}>{v}", "&nbsp;", "&ndash;", f"&#{n + 200};", "&#xA0;", "&amp;nbsp;", "&quot;", f"&lt;{t}&gt;{w}&lt;/{t}&gt;", f"<!-- {w} -->", "<br/>", f"<code>{w}</code>", f"<{t} color=red>{w}", "&amp;"))
            return s, cls("html")
        if m == "markdown":
            s = r.choice((f"**{w}**", f"***{w}***", f"*{w} {v}*", f"`{w}_{n}`", f"`{w}`", f"[{w}](/{v}/{w})", f"![{w}]({n}.png)", f"~~{w}~~", f"_{w}_", f"__{w}__", f"[{w}](https://{v}.example)", f"[{w}][{n}]", f"[^{n}]", f"[{w}](/{v}"))
            return s, cls("markdown")
        s = r.choice((f"\\textbf{{{w}}}", f"\\emph{{{w}}}", f"~\\cite{{{w}{n}}}", f"\\ref{{{w}}}", f"\\footnote{{{w} {v}, {n}}}", f"\\mbox{{{w}}}", f"{{\\bf {w}}}", f"caf\\'e {w}", f"\\label{{{w}}}", f"\\textbf{{\\emph{{{w}}}}}", f"\\begin{{center}}{w}\\end{{center}}", f"{n}\\% {w}", f"\\url{{{w}}}", f"\\{w}{{{v}}}"))
        return s, cls("latex")

    def formula(self, m: str) -> tuple[str, int]:
        t = self.tex()
        if m == "wiki":
            return self.r.choice((f"<math>{t}</math>", f'<math display="block">{t}</math>')), cls("wiki", "formula")
        if m == "html":
            return f"<math><mi>{self.word()}</mi><mo>=</mo><mn>{self.r.randint(1, 99)}</mn></math>", cls("html", "formula")
        return self.r.choice((f"${t}$", f"\\({t}\\)", f"\\[{t}\\]", f"$${t}$$", f"\\begin{{equation}}\n{t}\n\\end{{equation}}", f"\\begin{{align*}}{t}\\end{{align*}}")), cls("latex", "formula")

    def block(self, m: str, what: str) -> tuple[str, int]:
        r, n = self.r, self.r.choice((1, 2, 2, 3, 3, 4))
        items, title, code = [self.words(r.randint(3, 8)).capitalize() for _ in range(n)], self.words(3).capitalize(), self.code()
        gap = r.choice((" ", " ", ""))
        if what == "heading":
            k = r.randint(2, 4)
            s = {"wiki": f"{'=' * k}{gap}{title}{gap}{'=' * k}{r.choice(('', ' '))}", "html": f"<h{k}{r.choice(('', ' id=s', ' class=h'))}>{title}</h{k}>", "latex": f"\\{r.choice(sorted(SECTIONS))}{r.choice(('', '*'))}{{{title}}}",
                 "markdown": r.choice((f"{(mark := '#' * r.randint(1, 5))} {title}{r.choice(('', '', ' ' + mark))}", f"{title}\n{r.choice('-=') * r.randint(4, 14)}"))}[m]
        elif what == "list":
            sign = r.choice(("*", "#")) if m == "wiki" else r.choice(("*", "-", "+", "1."))
            nest = lambda i: (sign + r.choice("*#")) if m == "wiki" and i and r.random() < 0.4 else ("  " if i and r.random() < 0.3 and m == "markdown" else "") + (f"{i + 1}." if sign == "1." else sign)
            s = {"html": "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>", "latex": "\\begin{itemize}\n" + "\n".join("\\item " + x for x in items) + "\n\\end{itemize}"}.get(m) or "\n".join(nest(i) + (gap if m == "wiki" else " ") + x for i, x in enumerate(items))
            if m == "html":
                s = s.replace("ul>", r.choice(("ul>", "ol>"))).replace("<li>", r.choice(("<li>", "\n<li>", '<li class="i">', "\n<LI>", "<LI>"))).replace("</li>", r.choice(("</li>", "</li>", "", "</LI>")))
                s = s.replace("ul>", "UL>") if r.random() < 0.2 else s
        elif what == "code":
            t, f = r.choice(("syntaxhighlight", "source")), r.choice(("```", "~~~", "````"))
            s = {"wiki": f"<{t}{r.choice(('', ' lang=python', ' line'))}>\n{code}\n</{t}>", "html": r.choice((f"<pre>{code}</pre>", f"<pre><code>{code}</code></pre>", f'<pre class="src">\n{html.escape(code)}</pre>')), "markdown": f"{f}{r.choice(('', 'sh'))}\n{code}\n{f}", "latex": "\\begin{%s}\n%s\n\\end{%s}" % ((e := r.choice(("verbatim", "lstlisting"))), code, e)}[m]
        elif what == "table":
            a, b = self.word(), self.word()
            s = {"wiki": f'{{| class="{a}"\n! {a} !! {b}\n|-\n| {b} || {n}\n|}}', "html": f"<table><tr><td>{a}</td><td>{n}</td></tr></table>", "markdown": f"| {a} | {b} |\n|---|---|\n| {b} | {n} |", "latex": f"\\begin{{tabular}}{{lr}}\n{a} & {n} \\\\\n{b} & {n}\n\\end{{tabular}}"}[m]
            what = "any"
        else:
            return self.formula("latex" if m == "markdown" else m)
        return s, cls(m, what)

    def plain(self) -> str:
        r, n, k, w, v = self.r, self.r.randint(1, 999), self.r.randint(1, 999), self.word(), self.word()
        return r.choice((f"price from ${n} to ${k}", f"R&D and Q&A cost ${n} each, or ${k} for all", f"{n} * {k} * 2 cells", f"note [{n}] and note [{k}]", f"{w} < {n} and {v} > {k}", f"C:\\{w}\\{v}{n}", f"rank #{n} and #{k}", f"about {n} % of ~{k}",
                         f"({w} == {n}) && ({v} != {k})", f"reads *** {w.capitalize()} *** on", f"the field {w}_{v}_max", f"{n}_000", f"{w} - {v} + {n} = {k}", f"a/b/{w}.txt", f"{w}'s {v}", f"{n} | {k}", f"it's {w} -> {v}", f"<{n}", f"${n}", f"{w}~{v}", f"[{w}]", f"{{{w}}}", f"AT&T; {w}"))

    def put(self, s: str, label: int) -> None:
        self.parts.append((s, label))

    def text(self) -> tuple[str, list[tuple[int, int, int]]]:
        """(text, spans (start, end, class)) of one text."""
        r = self.r
        self.parts = []
        base = r.choice(("wiki", "wiki", "html", "markdown", "latex", "plain"))
        other = r.sample(MARKUPS, r.choice((0, 0, 1, 1, 2)))
        wrapped = base == "html" or "html" in other and r.random() < 0.5
        around: list[str] = []  # elements that hold what follows
        for _ in range(r.randint(1, 9)):
            while wrapped and r.random() < 0.4:
                if around and r.random() < 0.5:
                    self.put(f"</{around.pop()}>", cls("html"))
                else:
                    around.append(r.choice("div section table tr td blockquote center span b i p TABLE TR TD DIV".split()))
                    self.put(f"<{around[-1]}{r.choice(('', '', ' class=x', ' width=40'))}>{r.choice(('', chr(10)))}", cls("html"))
            if base != "plain" and r.random() < 0.35:
                self.put(*self.block(base, r.choice(("heading", "list", "list", "code", "table", "formula"))))
            elif base in ("plain", "html", "latex") and r.random() < 0.12:
                sign = r.choice(("(1)", "1.", "-", "*", "#"))
                self.put("\n".join(f"{sign} {self.words(4)}" for _ in range(2)), 0 if sign == "(1)" else -ord(sign[0]))
            else:
                if base == "html" and r.random() < 0.6:
                    self.put(r.choice(("<p>", "<div>", '<div class="x"><p>', "<P>")), cls("html"))
                for _ in range(r.randint(1, 4)):
                    p = r.random()
                    self.put(self.words(r.randint(3, 9)) + ("" if p < 0.5 and r.random() < 0.3 else " "), 0)  # signs may adjoin a word
                    if base != "plain" and p < 0.3:
                        self.put(*self.inline(base))
                    elif other and p < 0.5:
                        self.put(*self.inline(r.choice(other)))
                    elif p < 0.6:
                        self.put(self.plain(), 0)
                    elif p < 0.66 and (base in ("latex", "wiki") or other):
                        self.put(*self.formula(r.choice(("latex", "latex", "wiki"))))
                    self.put(r.choice((" ", ". ", "")), 0)
            self.put("\n\n", 0)
        while around and r.random() < 0.8:
            self.put(f"</{around.pop()}>", cls("html"))
        # Bare line signs go with the markup that the rest of the text shows.
        shown = [sum(label > 0 and (label - 1) // 5 == m for _, label in self.parts) for m in (0, 2)]
        wiki, markdown = shown[0] > 0 and shown[0] >= shown[1], shown[1] > shown[0]
        bare = {"*": cls("wiki", "list") if wiki else cls("markdown", "list") if markdown else 0, "#": cls("wiki", "list") if wiki else 0}
        out, spans = "", []
        for s, label in self.parts:
            if label < 0:
                label = bare.get(chr(-label), cls("markdown", "list") if shown[1] else 0)
            spans.append((len(out), len(out) + len(s), max(label, 0)))
            out += s
        return out, spans


_INSIDE, _HEADING, _LISTED = (np.array([c > 0 and ELEMENTS[(c - 1) % 5] in names for c in range(N_CLASSES)]) for names in (("code", "formula"), ("heading",), ("list",)))


def _labels(nodes: list, feats: list, spans: list) -> list[int]:
    """True class of every node: that of its span; inside a construct only its main signs carry the element."""
    out, at = [], 0
    for i, n in enumerate(nodes):
        while at + 1 < len(spans) and spans[at][1] <= n[1]:
            at += 1
        c = spans[at][2] if spans and spans[at][0] <= n[1] < spans[at][1] else 0
        p = n[5]
        while p >= 0 and not _INSIDE[out[p]]:
            p = nodes[p][5]
        if p >= 0:
            c = 0  # inside a block, its closing sign included
        if c:
            element = ELEMENTS[(c - 1) % 5]
            kind = KINDS[feats[i][KIND]]
            bearer = {"heading": kind in ("wheading", "underline", "sign") or kind == "tag" and feats[i][NAME] == 3 or kind == "command" and feats[i][NAME] == 1,
                      "list": kind == "sign" or kind == "tag" and feats[i][NAME] == 4 or kind == "command" and feats[i][NAME] == 2 or kind == "env" and feats[i][NAME] == 3,
                      "code": kind in ("pre", "code", "fence", "env"), "formula": kind in ("math", "env"), "any": False}[element]
            if element in ("code", "formula") and not bearer:
                c = 0  # inside the block
            elif not bearer:
                c -= ELEMENTS.index(element)
        out.append(c)
    return out


@lru_cache(maxsize=2)
def trained(texts: int = 4000, seed: int = 11) -> Trees:
    """The model, fitted once per process on generated texts; equal rows are merged, so fitting takes seconds."""
    maker, rows = _Maker(seed), {}
    for _ in range(texts):
        t, spans = maker.text()
        feats, nodes = lex(t)
        for f, c in zip(feats, _labels(nodes, feats, spans), strict=True):
            key = (*f, c)
            rows[key] = rows.get(key, 0) + 1
    data = np.array(list(rows), np.int64)
    return boost(data[:, :-1], data[:, -1], np.array(list(rows.values()), float), N_CLASSES, rounds=24, depth=5, rate=0.3)


def _allowed() -> dict[tuple[int, int], np.ndarray]:
    """Readings a sign can have at all, by kind and name: the grammar's share of the decision."""
    c, out = cls, {}
    every = {
        "wheading": [c("wiki", "heading"), c("wiki")], "underline": [c("markdown", "heading"), c("markdown"), c("wiki")], "fence": [c("markdown", "code"), c("markdown")],
        "mdtable": [c("markdown")], "wtable": [c("wiki")], "sign": [c("wiki", "list"), c("markdown", "list"), c("markdown", "heading")], "comment": [c("html")], "tag": [c("html")],
        "entity": [c("html")], "wlink": [c("wiki")], "template": [c("wiki")], "elink": [c("wiki")], "mdlink": [c("markdown")], "quotes": [c("wiki")], "stars": [c("markdown")], "ticks": [c("markdown")],
        "strike": [c("markdown")], "under": [c("markdown")], "math": [c("latex", "formula"), c("latex")], "command": [c("latex")], "pre": [c("html", "code")], "code": [c("wiki", "code")], "env": [c("latex")],
    }
    named = {
        ("tag", 1): [c("wiki")], ("tag", 2): [c("html")], ("tag", 3): [c("html", "heading")], ("tag", 4): [c("html", "list")], ("math", 2): [c("wiki", "formula"), c("html", "formula")],
        ("command", 1): [c("latex", "heading")], ("command", 2): [c("latex", "list")], ("env", 1): [c("latex", "code"), c("latex")], ("env", 2): [c("latex", "formula"), c("latex")], ("env", 3): [c("latex", "list")],
        ("strike", 1): [c("latex")], ("strike", 2): [c("wiki")], ("under", 1): [c("wiki")], ("sign", 0): [c("wiki", "list"), c("markdown", "list")], ("sign", 1): [c("markdown", "list")], ("sign", 2): [c("markdown", "list")],
        ("sign", 3): [c("markdown", "list")],
    }
    for kind, k in _K.items():
        for name in range(8):
            mask = np.full(N_CLASSES, -1e3)
            mask[[0, *named.get((kind, name), every.get(kind, []))]] = 0
            out[k, name] = mask
    return out


# --- decoding ---------------------------------------------------------------------------------------


def _packed(f: np.ndarray) -> np.ndarray:
    out = np.zeros(len(f), np.int64)
    for k, r in enumerate(_RADIX):
        out = out * r + np.minimum(f[:, k], r - 1)
    return out


def node_scores(feats: np.ndarray, model: Trees) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows' log probabilities, row of each node): equal feature rows are scored once."""
    codes, first, inverse = np.unique(_packed(feats), return_index=True, return_inverse=True)
    x = feats[first]
    mask = _allowed()
    return np.log(model.probabilities(x) + 1e-9) + np.array([mask[k, n] for k, n in x[:, [KIND, NAME]].tolist()]), inverse


def decode(nodes: list, logp: np.ndarray) -> list[int]:
    """Class per node, ancestors first. A block of code or formula makes its descendants none; it is chosen if it and their being
    none are together likelier than the best reading of block and descendants on their own. An element read as a heading leaves its descendants
    what isn't a heading or list, and is weighed with that."""
    n = len(nodes)
    if all(x[5] < 0 for x in nodes):
        return logp.argmax(1).tolist()
    kids: dict[int, list[int]] = {}
    for i, x in enumerate(nodes):
        if x[5] >= 0:
            kids.setdefault(x[5], []).append(i)
    free, held, none = [0.0] * n, [0.0] * n, [0.0] * n  # value of the subtree at its best, in a heading, and as nothing
    choice, in_heading = [0] * n, [0] * n
    readings = []  # (best value, class) of blocks, headings, other signs, and signs that may stand in a heading
    for mask in (_INSIDE, _HEADING, ~(_INSIDE | _HEADING), ~(_INSIDE | _HEADING | _LISTED)):
        some = np.where(mask, logp, -np.inf)
        readings.append((some.max(1).tolist(), some.argmax(1).tolist()))
    (block, as_block), (title, as_title), (sign, as_sign), (inline, as_inline) = readings
    nothing = logp[:, 0].tolist()
    for i in range(n - 1, -1, -1):
        f = h = z = 0.0
        for k in kids.get(i, ()):
            f, h, z = f + free[k], h + held[k], z + none[k]
        free[i], choice[i] = max((sign[i] + f, as_sign[i]), (block[i] + z, as_block[i]), (title[i] + h, as_title[i]))
        held[i], in_heading[i] = max((inline[i] + h, as_inline[i]), (block[i] + z, as_block[i]))
        none[i] = nothing[i] + z
    out, around = [0] * n, [0] * n  # around: 0 free, 1 in a heading, 2 in a block
    for i in range(n):
        p = nodes[i][5]
        if p >= 0:
            around[i] = 2 if around[p] == 2 or _INSIDE[out[p]] else 1 if around[p] or _HEADING[out[p]] else 0
        if around[i] < 2:
            out[i] = in_heading[i] if around[i] else choice[i]
    return out


_ATTRIBUTES = r"[ \t]*+(?:(?:[^|=\[\]{}\n]*+=[^|\[\]{}\n]*+|nowrap[ \t]*+)\|(?!\|))?[ \t]*+"
_CELL_LINE = re.compile(r"^[ \t]*[|!](?![-+}])[^\n]*", re.M)
_CELL_BEGIN = re.compile(rf"[ \t]*+(?:\|\||!!|[|!]){_ATTRIBUTES}")
_CELL_NEXT = {sign: re.compile(rf"(?:{signs}){_ATTRIBUTES}") for sign, signs in (("|", r"\|\|"), ("!", r"\|\||!!"))}
_CUT_ROW = re.compile(r"[ \t]*+(?:\|(?:[^|\n]|\|(?!\|))*+\|\||![^!\n]*[^!\s][ \t]*!!(?=[ \t]*[^\s!]))")
_CAPTION = re.compile(rf"[ \t]*\|\+{_ATTRIBUTES}")
_WHOLE = frozenset(("wlink", "template", "elink", "mdlink", "comment", "ticks", "tag", "mdtable"))


def cells(text: str, nodes: list, classes: list[int]) -> list:
    """Nodes of the cells of wiki tables: signs that begin a line or part cells, with their attributes.

    A table goes from its opening to its end, one broken off to the next empty line; a row or end without an opening makes its paragraph
    a table. Elsewhere a line is a row only by a doubled sign. Signs inside links, templates, code and formulas are none.
    """
    lines = [m.span() for m in _CELL_LINE.finditer(text)]
    if not lines:
        return []
    taken = bytearray(len(text))
    tables, begin, until = [], -1, 0
    for (kind, s, e, _, _, _, span), c in zip(nodes, classes, strict=True):
        if not c:
            continue
        if _INSIDE[c] or kind in _WHOLE:
            end = span if _INSIDE[c] else e
            taken[s:end] = b"\1" * (end - s)
        elif kind == "wtable":
            sign = text[s:e].strip()
            if sign == "{|":
                if begin >= 0:
                    tables.append((begin, until))
                begin = s
            elif sign == "|}" and begin >= 0:
                tables.append((begin, e))
                begin = -1
            elif begin < 0 and (not tables or s >= tables[-1][1]):
                stop = text.find("\n\n", e)
                tables.append((text.rfind("\n\n", 0, s) + 1, len(text) if stop < 0 else stop))
            if begin >= 0:
                stop = text.find("\n\n", e)
                until = len(text) if stop < 0 else stop
    if begin >= 0:
        tables.append((begin, until))
    out, k = [], 0
    for a, b in lines:
        while k < len(tables) and tables[k][1] <= a:
            k += 1
        if taken[a] or not (k < len(tables) and tables[k][0] <= a or _CUT_ROW.match(text, a, b) and not text[a:b].rstrip().endswith("|")):
            continue
        m, first, at = _CELL_BEGIN.match(text, a, b), text[a:b].lstrip()[0], a
        while m:
            sign = m.start()
            if not taken[sign]:
                while sign > at and text[sign - 1] in " \t":
                    sign -= 1
                out.append(["wcell", sign, m.end(), m.end(), m.end(), -1, m.end()])
            at = m.end()
            m = _CELL_NEXT[first].search(text, at, b)
    return out


def analyse(texts: list[str], model: Trees):
    """Per text (nodes, classes); cells of tables, which follow from the other nodes, come last."""
    out = []
    for text, (nodes, classes) in zip(texts, _signs(texts, model), strict=True):
        more = cells(text, nodes, classes)
        out.append((nodes + more, classes + [cls("wiki")] * len(more)))
    return out


def _signs(texts: list[str], model: Trees):
    """Per text the lexer's nodes and their classes."""
    lexed = [lex(t) for t in texts]
    rows = [f for feats, _ in lexed for f in feats]
    if not rows:
        return [(nodes, []) for _, nodes in lexed]
    logp, inverse = node_scores(np.array(rows, np.int64), model)
    out, at = [], 0
    for feats, nodes in lexed:
        out.append((nodes, decode(nodes, logp[inverse[at : at + len(feats)]])))
        at += len(feats)
    return out


def constructs(nodes: list, classes: list[int]) -> set[tuple[str, str]]:
    """(markup, element) pairs that a text has; every markup with one also has ``any``."""
    found = set()
    for c in set(classes) - {0}:
        m, e = MARKUPS[(c - 1) // 5], ELEMENTS[(c - 1) % 5]
        found |= {(m, e), (m, "any")}
    return found


# --- clean text -------------------------------------------------------------------------------------

_GONE = frozenset(("cite", "citep", "citet", "ref", "label", "footnote", "begin", "end", "hline", "centering", "noindent", "vspace", "hspace", "pageref", "eqref"))
_REFS = re.compile(r"<ref\b[^<>]*?/>|<ref\b[^<>]*>[^<]*(?:<(?!/?ref)[^<]*)*</ref\s*>", re.I)
_GROUP = re.compile(r"(?:[^{}]|\{[^{}]*\})*+\}")
_ARG = re.compile(r"(?:\[[^\]\n]*\])?\{([^{}]*)\}")


_OPEN_FILE = re.compile(r"(?i)(?:file|image|datei|fichier|archivo):[^|\n\]]*(?:\|(?:[a-z]+|\d+px)(?=\|))*\|?")
_OPEN_TEMPLATE = re.compile(r"[^|{}\n]*(?:\|[^|{}\n=]*=[^|{}\s]*)*")


_LANGUAGE = re.compile(r"""\blang(?:uage)?[ \t]*=[ \t]*["']?([\w+#.-]+)|\bclass[ \t]*=[ \t]*["']?(?:[\w -]*[ ])?lang(?:uage)?-([\w+#.-]+)""", re.I)
_OPTIONS = re.compile(r"\[([^\]\n]*)\]|\{([\w+#.-]+)\}(?=[ \t]*\n)")
_INNER_CODE = re.compile(r"\s*<code\b([^>]*)>|</code\s*>\s*$", re.I)


def _code(text: str, kind: str, s: int, e: int, a: int, b: int) -> str:
    """A code block in fences, with the language that its opening names."""
    opening, inner, language = text[s:e], text[a:b], ""
    if kind == "fence":
        language = (opening.strip().lstrip("`~").split() or [""])[0]
    elif kind == "env":
        if m := _OPTIONS.match(inner):
            named = _LANGUAGE.search(m.group(1) or "")
            language, inner = m.group(2) or (named.group(1) if named else ""), inner[m.end() :]
    else:
        if m := _INNER_CODE.match(inner):
            opening += m.group(1) or ""
        if m := _LANGUAGE.search(opening):
            language = m.group(1) or m.group(2)
        inner = html.unescape(_INNER_CODE.sub("", inner.strip("\n")))
    inner = inner.strip("\n")
    mark = max(re.findall("`{3,}", inner), key=len, default="``") + "`"
    return f"\n{mark}{language}\n{inner}\n{mark}\n"


_LIST_BEGIN = re.compile(r"<(?:ul|ol|dl)\b", re.I)


def _list_depths(text: str, nodes: list) -> list[int]:
    """Lists of elements or environments around each node."""
    out, env = [0] * len(nodes), 0
    own = [0] * len(nodes)
    for i, n in enumerate(nodes):
        if n[0] == "env" and (m := _ENV.search(text, n[1], n[2])) and m.group(1) in LIST_ENVIRONMENTS:
            env = max(0, env + (1 if text.startswith("\\begin", n[1]) else -1))
        p = n[5]
        around = own[p] if p >= 0 else 0
        own[i] = around + (n[0] == "tag" and bool(_LIST_BEGIN.match(text, n[1])))
        out[i] = around + env
    return out


def clean(text: str, nodes: list, classes: list[int]) -> str:
    """Text without markup; headings as ``# ``, items as ``- `` by their depth, code in fences with its language, formulas between dollars.

    Only nodes decoded as markup are touched, signs in their plain sense stay.
    """
    edits: list[tuple[int, int, str]] = []
    depths = _list_depths(text, nodes)
    covered, last_ref = 0, max(text.rfind("</ref"), text.rfind("</REF"), text.rfind("<ref"))
    for (kind, s, e, a, b, _, span), c, lists in sorted(zip(nodes, classes, depths, strict=True), key=lambda x: x[0][1]):
        if not c or s < covered:
            continue
        element, tok = ELEMENTS[(c - 1) % 5], text[s:e]
        if element == "code":
            edits.append((s, span, _code(text, kind, s, e, a, b)))
        elif element == "formula":
            edits.append((s, span, "$" + re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", text[a:b])).strip() + "$"))
        elif element == "heading":
            if kind == "wheading":
                level = len(tok.strip()) - len(tok.strip().lstrip("="))
                edits.append((s, e, "#" * level + " " + tok.strip().strip("=").strip()))
            elif kind == "underline":
                start = text.rfind("\n", 0, max(0, s - 1)) + 1
                edits += [(start, start, "# "), (max(start, s - 1), e, "")]
            elif kind == "tag":
                edits.append((s, e, "\n" if tok[1] == "/" else "\n" + "#" * int(re.search(r"\d", tok).group()) + " "))
            elif kind == "command":
                arg = _ARG.match(text, e)
                edits.append((s, arg.end() if arg else e, "# " + arg.group(1) if arg else ""))
        elif element == "list":
            if kind == "sign":
                mark = tok.strip()
                depth = len(mark) - 1 if mark[0] in "*#" else len(tok[: len(tok) - len(tok.lstrip())].expandtabs(4)) // 2
                edits.append((s, e, "  " * depth + "- " if not text[e : e + 1].isspace() else "  " * depth + "-"))
            elif kind == "command" or kind == "tag" and re.match(r"<(li|dt|dd)\b", tok, re.I):
                edits.append((s, e, ("\n" if kind == "tag" else "") + "  " * max(0, lists - 1) + ("- " if kind == "tag" else "-")))
            else:
                edits.append((s, e, "\n" if kind == "tag" else ""))
        elif kind == "wcell":
            edits.append((s, e, "" if s == 0 or text[s - 1] == "\n" else "\t"))
        elif kind == "wtable" and tok.strip() == "|+":
            edits.append((s, _CAPTION.match(text, s).end(), ""))
        elif kind in ("wtable", "mdtable"):  # attributes of the table or row, or the line below a header
            stop = text.find("\n", e)
            stop = len(text) if stop < 0 else stop
            edits.append((s, stop if tok.strip() != "|}" else e, ""))
        elif tok == "[[" and (m := _OPEN_FILE.match(text, e)) or tok == "{{" and (m := _OPEN_TEMPLATE.match(text, e)):
            edits.append((s, m.end(), ""))  # broken off: what is certainly not its text
        elif kind == "wlink":
            inner = tok[2:-2] if len(tok) > 3 else ""
            edits.append((s, e, "" if re.match(r"(?i)(file|image|category|datei|fichier|archivo|kategorie|catégorie|categoría):", inner) else inner.rsplit("|", 1)[-1].lstrip(":")))
        elif kind == "template":
            edits.append((s, e, ""))
        elif kind == "elink":
            edits.append((s, e, tok.strip("[]").partition(" ")[2]))
        elif kind == "mdlink":
            edits.append((s, e, re.sub(r"!?\[([^\]]*)\]?(\([^)]*\))?", r"\1", tok)))
        elif kind in ("stars", "strike", "under", "ticks") and len(tok) > 2:
            edits.append((s, e, tok.strip("*~_`") if not (kind == "under" and tok.strip("_").isupper()) else ""))
        elif kind == "entity":
            edits.append((s, e, html.unescape(tok).replace("\xa0", " ")))
        elif kind == "command":
            bare = tok.lstrip("{\\").rstrip("*")
            arg = _ARG.match(text, e)
            if tok[0] == "{" and (m := _GROUP.match(text, e)):
                edits += [(s, e + text[e : e + 1].isspace(), ""), (m.end() - 1, m.end(), "")]
            elif bare in _GONE:
                edits.append((s, arg.end() if arg else e, ""))
            elif tok[1:2] in "%&_#{}$" and len(tok) == 2:
                edits.append((s, e, tok[1]))
            elif tok[1:2] in "'`^\"~=." and len(tok) == 3:
                import unicodedata

                mark = {"'": "\u0301", "`": "\u0300", "^": "\u0302", '"': "\u0308", "~": "\u0303", "=": "\u0304", ".": "\u0307"}[tok[1]]
                edits.append((s, e, unicodedata.normalize("NFC", tok[2] + mark)))
            else:
                edits.append((s, arg.end() if arg else e, arg.group(1) if arg else ""))
        elif kind == "env":
            arg = _ARG.match(text, e) if "tabular" in tok else None
            edits.append((s, arg.end() if arg else e, ""))
        elif kind in ("tag", "comment", "quotes", "fence", "pre", "code", "math", "strike"):
            if kind == "tag" and s < last_ref and re.match(r"<ref\b", tok, re.I) and (m := _REFS.match(text, s)):
                edits.append((s, m.end(), ""))
                covered = m.end()
            else:
                edits.append((s, e, "\n" if kind == "tag" and re.match(r"</?(p|div|br|tr|table|td|th)\b", tok, re.I) else ""))
    out, at = [], 0
    for s, e, new in sorted(edits, key=lambda x: (x[0], -x[1])):
        if s < at:
            continue
        out += [text[at:s], new]
        at = e
    out.append(text[at:])
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"(?<![ \t])[ \t]+\n", "\n", "".join(out))).strip()


def _scan(docs: DataFrame, fields: str, make) -> DataFrame:
    bc = docs.sparkSession.sparkContext.broadcast(trained())  # a few hundred kilobytes, whatever the data

    def run(batches):
        import pandas as pd

        from palimpsest.llm.words import groups

        names = [f.split()[0] for f in fields.split(", ")]
        for pdf in batches:
            model = bc.value
            texts, ids = pdf["text"].tolist(), pdf["doc_id"].tolist()
            for a, b in groups(texts):
                rows = [row for i, t, (nodes, classes) in zip(ids[a:b], texts[a:b], analyse(texts[a:b], model), strict=True) for row in make(i, t, nodes, classes)]
                yield pd.DataFrame(rows, columns=names)

    return docs.select("doc_id", "text").filter("doc_id IS NOT NULL AND text IS NOT NULL").mapInPandas(run, fields)


def find_markup(docs: DataFrame) -> DataFrame:
    """(doc_id, markup, element) of documents (doc_id, text). NULL texts and texts without markup give no rows."""
    return _scan(docs, "doc_id long, markup string, element string", lambda i, t, nodes, classes: [(i, m, e) for m, e in sorted(constructs(nodes, classes))])


def clean_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, clean_text) of documents with a text; repeated rows stay repeated."""
    return _scan(docs, "doc_id long, clean_text string", lambda i, t, nodes, classes: [(i, clean(t, nodes, classes))])
