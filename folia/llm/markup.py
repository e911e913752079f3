"""Markup residue: which tokens of a text belong to the formatting, and the text without them.

Wrappers are inferred as union-free regular expressions. A text becomes a nested stream of candidate tokens
of HTML, Markdown, wiki, LaTeX and the typesetter with text slots between them; tokens that open and close
are pairs with a stream inside. The streams of one host (one manual) are aligned one after the other with
the expression folded so far: groups that a stream passes over become optional, groups that follow
themselves repeated, what the expression lacks is put in where the alignment stands. The expression of a
host is ``((group ((group)? #TEXT)+)+? ... #TEXT)+``, with order, nesting, ``?`` and ``+`` and no alternatives.

Whether a group is template or text is shown by other witnesses of the regions: token streams of both are
aligned, and a group that the other witness mostly goes on without is template, one that both keep (key names,
prices, names with stars) is text. Where a host has shown a group seldom, the expression of all hosts counts
as further sightings, then the key wherever it stands, then lists of known elements.

Applying a wrapper parses a text with it: tokens that match a group are markup; headings, lists, code and
formulas keep a plain form of their structure in the clean text.

Defined results: null and empty texts hold no markup and stay as they are; a null or reversed span has no
lines and one that runs past the file ends with it; repeated rows give one row; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.functions.frames import frame
from folia.llm.lookalike import skeleton
from folia.plans.samples import bounded_sample

#: Regions of the fitting sample, at most; candidate tokens of a stream up to which two witnesses are aligned in it.
SAMPLE_REGIONS, FIT_TOKENS = 6_000, 2_000
#: Sightings that the share of the next wider level counts for, and the share of dropped ones that makes a group.
WEIGHT, DROPPED = 4.0, 0.5

#: Elements of HTML and of the wiki's tags (fixed values).
ELEMENTS = frozenset(
    "a abbr address article aside b big blockquote body br button caption center cite code col dd del div dl dt em font footer form h1 h2 h3 h4 h5 h6 head header hr html i img input ins kbd label li link main mark math meta nav nowiki ol option p pre q ref references s samp script section select small source span strike strong style sub sup syntaxhighlight table tbody td textarea tfoot th thead title tr tt u ul var".split()
)

TOKENS = re.compile(
    r"""(?P<comment><!--.*?-->)
    |(?P<tag></?(?P<tagname>[A-Za-z][A-Za-z0-9-]*)(?:\s+[\w:-]+(?:\s*=\s*(?:"[^"<>]*"|'[^'<>]*'|[^\s"'<>]+))?)*\s*/?>)
    |(?P<entity>&(?:amp;)*(?:\#\d{1,7}|\#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});)
    |(?P<tex>\\(?P<texname>[A-Za-z]+)\*?(?:\[[^\]\n]*\])?(?:\{(?P<texarg>[^{}\n]*)\})?)
    |(?P<texsign>\\[&%$\#_{}\[\]()~^\\]|(?<=\w)~(?=\\)|\\\s(?=\w))
    |(?P<control>\x06[0-9*]|\x16\(|[\x00-\x08\x0b\x0c\x0e-\x1f\x7f])
    |(?P<directive>^[.](?P<dirname>[A-Za-z]\w*)\b)
    |(?P<fence>^[ ]{0,3}(?:`{3,}|~{3,})[ \t]*[\w+-]*[ \t]*$)
    |(?P<textile>^(?:h[1-6]|bq|bc|fn\d+)\.[ ])
    |(?P<heading>^[ ]{0,3}\#{1,6}[ ]+(?=\S)|(?<=\S)[ ]+\#{2,6}$)
    |(?P<wikihead>^={2,6}(?=[^=\n]+={2,6}[ \t]*$)|(?<=[^=\n])={2,6}[ \t]*$)
    |(?P<rule>^[ ]{0,3}(?:-{3,}|={4,}|\*{3,}|_{3,})[ \t]*$)
    |(?P<bullet>^[ ]{0,3}[-*+][ ]+(?=\S))
    |(?P<quote>^>[ ]?)
    |(?P<link>!?\[(?=[^\]\n]+\]\([^()\s]+\))|\]\((?P<url>[^()\s]+)\))
    |(?P<wikilink>\[\[(?:[^\[\]|\n]+\|)?|\]\])
    |(?P<template>\{\{(?:[^{}|\n]+\|)?|\}\})
    |(?P<wikitable>^\{\|.*$|^\|[-}+].*$)
    |(?P<apostrophes>'{2,5}(?=\S)|(?<=\S)'{2,5})
    |(?P<stars>\*{2,3}(?=[^\s*])|(?<=[^\s*])\*{2,3}(?!\w))
    |(?P<strike>~~(?=\S)|(?<=\S)~~)
    |(?P<lines>(?<!\w)__(?=[^\s_])|(?<=[^\s_])__(?!\w))
    |(?P<tick>`(?=[^`\n]+`(?!\w))|(?<=[^\s`(])`(?!\w))
    |(?P<math>\$\$|\$(?=[^\s$\d][^$\n]*(?<!\s)\$)|(?<=[^\s$])\$(?!\d)(?=\W|$))
    |(?P<star>(?<![\w*\\])\*(?=\w[^*\n]*\w\*(?!\w)))
    |(?P<line>(?<![\w_\\])_(?=[^\W_][^_\n]*[^\W_]_(?!\w)))
    |(?P<brace>\{\\(?:bf|it|em|tt|rm|sf|sl|sc)\b|\}|\{)
    """,
    re.X | re.M | re.S,
)
#: Places where a candidate token can start.
STARTS = re.compile(r"[<&\\\x00-\x08\x0b\x0c\x0e-\x1f\x7f#=*`~'\[\]{}_$]|!(?=\[)|^(?:[.>|+-]|h\d\.|b[qc]\.|fn\d|[ ]{1,3}[-#`~*+_=])|[ ]+(?=\#{2,6}$)", re.M)
_WORD = re.compile(r"[^\W_]+|\S")
_CODE_LINE = re.compile(r"^\s*(?:[(;]|`\(|#\||,@|\d+>)")
_VARIABLE = re.compile("\\*\\w+(?:[-‐‑]\\w+)+\\*")
#: Kinds of tokens that formatting always makes, whatever a host has shown (fixed values).
SURE = frozenset("comment entity control fence textile wikihead wikilink template wikitable apostrophes strike link".split())
#: TeX names that are also written outside of TeX are learned; these are known commands (fixed values).
TEX = frozenset("begin end chapter section subsection subsubsection paragraph emph textbf textit texttt textsc underline bf it tt em rm sf index label cite ref item footnote frac leq le geq ge neq ne times cdot verb url href caption includegraphics hline newpage noindent par".split())


@dataclass(frozen=True)
class Token:
    """One candidate token: its place, the group it would belong to, and its kind."""

    start: int
    end: int
    key: str
    kind: str
    opens: bool = True


def candidates(text: str) -> list[Token]:
    """All candidate tokens of a text, in order."""
    out = []
    end = 0
    for first in STARTS.finditer(text):
        if first.start() < end or (m := TOKENS.match(text, first.start())) is None:
            continue
        end = m.end()
        kind = m.lastgroup if m.lastgroup not in ("tagname", "texname", "texarg", "dirname", "url") else next(k for k in ("tag", "tex", "directive", "link") if m[k] is not None)
        if kind == "tag":
            key = "tag:" + m["tagname"].lower()
        elif kind == "tex":
            if m.start() and text[m.start() - 1] == "#":
                continue
            key = "tex:" + m["texname"]
        elif kind == "directive":
            key = "dir:" + m["dirname"]
        elif kind == "star":
            key = "star:name" if _VARIABLE.match(text, m.start()) else "star"
        elif kind == "brace" and m.group().startswith("{\\"):
            key = "brace:tex"
        elif kind in ("math", "texsign"):
            key = f"{kind}:{m.group()[:2]}"
        else:
            key = kind
        if kind in ("bullet", "heading", "quote", "rule", "tick", "stars", "brace", "texsign", "apostrophes", "strike", "lines", "star", "line", "math", "template", "wikilink") and _in_code(text, m.start()):
            key += "@code"
        # Only a sign of headings stands at both ends of a line.
        out.append(Token(m.start(), m.end(), key, kind, kind != "wikihead" or not m.start() or text[m.start() - 1] == "\n"))
    return out


def _in_code(text: str, at: int) -> bool:
    a = text.rfind("\n", 0, at) + 1
    return _CODE_LINE.match(text, a) is not None


def stream(text: str) -> list[tuple[str, str | None]]:
    """(symbol, group key or None) of words and candidate tokens."""
    out: list[tuple[str, str | None]] = []
    at = 0
    for t in candidates(text):
        out += [(w.casefold(), None) for w in _WORD.findall(skeleton(text[at : t.start]))]
        out.append((t.key, t.key))
        at = t.end
    out += [(w.casefold(), None) for w in _WORD.findall(skeleton(text[at:]))]
    return out


@dataclass
class Item:
    """One sighting: a lone token, or a pair that opens and closes with what stands between; a slot has no token."""

    key: str
    kind: str
    tokens: list[Token]
    inner: list[Item] = field(default_factory=list)


SLOT = "#TEXT"
#: Kinds whose first token opens and whose next one of the same key closes (fixed values).
TURNS = frozenset("apostrophes stars strike lines tick star line math fence wikihead rule".split())


def _role(text: str, t: Token) -> str:
    raw = text[t.start : t.end]
    if t.kind == "tag":
        return "close" if raw.startswith("</") else "lone" if raw.endswith("/>") else "open"
    if t.kind in ("link", "wikilink", "template", "brace"):
        return "close" if raw[0] in "]}" else "open"
    if t.kind in TURNS and t.kind != "rule":
        return "turn"
    name = t.key.partition(":")[2]
    if t.kind == "tex" and name in ("begin", "end"):
        return "open" if name == "begin" else "close"
    if t.kind == "directive":
        return "close" if name.startswith("end_") else "open"
    return "lone"


def _pair_key(t: Token) -> str:
    """What an opening and a closing token have in common; a pair is called by its opening one."""
    return "brace" if t.kind == "brace" else t.key.replace("tex:end", "tex:begin").replace("dir:end_", "dir:")


def _name(t: Token) -> str:
    return t.key if t.kind == "brace" else _pair_key(t)


def items(text: str, tokens: list[Token]) -> list[Item]:
    """The tokens of a text as a nested sequence with text slots; a token without its partner stands alone."""
    # (items so far, the token that opened the level)
    levels: list[tuple[list[Item], Token | None]] = [([], None)]
    at = 0
    for t in tokens:
        if _WORD.search(text, at, t.start):
            levels[-1][0].append(Item(SLOT, "slot", []))
        at = t.end
        role, key = _role(text, t), _pair_key(t)
        if role in ("close", "turn"):
            k = next((i for i in range(len(levels) - 1, 0, -1) if _pair_key(levels[i][1]) == key), 0)
            if k:
                while len(levels) > k + 1:
                    _give_up(levels)
                inner, first = levels.pop()
                levels[-1][0].append(Item(_name(first), t.kind, [first, t], inner))
                continue
        if role in ("open", "turn"):
            levels.append(([], t))
        else:
            levels[-1][0].append(Item(_name(t), t.kind, [t]))
    if _WORD.search(text, at):
        levels[-1][0].append(Item(SLOT, "slot", []))
    while len(levels) > 1:
        _give_up(levels)
    return levels[0][0]


def _give_up(levels: list[tuple[list[Item], Token | None]]) -> None:
    """The innermost opening token never closes: it stands alone before what followed it."""
    inner, first = levels.pop()
    levels[-1][0].append(Item(_name(first), first.kind, [first]))
    levels[-1][0].extend(inner)


@dataclass
class Group:
    """One group of a union-free expression, what stands inside it, and how often the other witness lacked it."""

    key: str
    inner: list[Group] = field(default_factory=list)
    dropped: int = 0
    kept: int = 0
    optional: bool = False
    repeated: bool = False


def _place(level: list[Group], key: str, at: int) -> int | None:
    """Where a key stands in an expression that is read from ``at`` on and starts over at its end."""
    for k in (*range(at, len(level)), *range(at)):
        if level[k].key == key:
            return k
    return None


def fold(level: list[Group], seen: list[Item], verdicts: dict[int, bool], first: bool) -> None:
    """Align one nested stream with an expression and widen the expression to match it.

    Groups that the stream passes over become optional, a group that follows itself becomes repeated, and an
    item that the expression lacks is put in where the alignment stands, as an optional group unless the
    stream is the first. The expression may start over, so every key stands once on its level.
    """
    at, last = 0, None
    met: set[str] = set()
    for item in seen:
        k = level.index(last) if last is not None and last.key == item.key else _place(level, item.key, at)
        if k is None:
            k = at
            level.insert(k, Group(item.key, optional=not first))
        elif level[k] is last:
            last.repeated = True
        group = level[k]
        met.add(item.key)
        shown = [verdicts[t.start] for t in item.tokens if t.start in verdicts]
        group.dropped += sum(shown)
        group.kept += len(shown) - sum(shown)
        if item.inner:
            fold(group.inner, item.inner, verdicts, first)
        at, last = k + 1, group
    for group in level:
        group.optional |= group.key not in met


def merge(level: list[Group], other: list[Group]) -> None:
    """Fold one expression into another: counts add up, flags hold if either has them."""
    at = 0
    for group in other:
        k = _place(level, group.key, at)
        if k is None:
            k = at
            level.insert(k, Group(group.key, optional=True))
        into = level[k]
        into.dropped, into.kept, into.optional, into.repeated = into.dropped + group.dropped, into.kept + group.kept, into.optional or group.optional, into.repeated or group.repeated
        merge(into.inner, group.inner)
        at = k + 1


def expression(level: list[Group]) -> str:
    """An expression as text: ``(key inner)`` with ``+`` for repeated and ``?`` for optional groups."""
    out = []
    for g in level:
        if g.key == SLOT:
            out.append(SLOT)
        elif g.dropped >= g.kept:
            out.append(f"({g.key}{' ' + expression(g.inner) if g.inner else ''}){'+' if g.repeated else ''}{'?' if g.optional else ''}")
    return " ".join(out)


def _prior(key: str, kind: str) -> float:
    """Share of sightings that are formatting where no stream has shown any: by lists of known elements."""
    name = key.partition(":")[2]
    if kind == "tag":
        known = name in ELEMENTS
    elif kind == "tex":
        known = name in TEX
    else:
        known = (kind in SURE or key == "brace:tex") and not key.endswith("@code")
    return 0.95 if known else 0.4 if kind == "directive" else 0.05


@dataclass
class Wrappers:
    """The expressions of all hosts of a sample, that of all hosts together, and counts of keys wherever they stand."""

    hosts: dict[str, list[Group]]
    common: list[Group]
    keys: dict[str, tuple[int, int]]
    shown: dict[str, tuple[int, int]] = field(default_factory=dict)
    verdicts: dict[tuple, bool] = field(default_factory=dict)
    decided: Counter = field(default_factory=Counter)

    def parse(self, text: str, host: str | None) -> list[Token]:
        """The markup tokens of a text: those that the host's expression matches as groups of its template."""
        if not STARTS.search(text):
            return []
        tokens = candidates(text)
        taken: set[int] = set()
        self._match(items(text, tokens), self.hosts.get(host or "", []), self.common, (host,), taken)
        found = [t for t in tokens if t.start in taken]
        # Braces are markup only where a command opened them.
        if any(t.kind == "brace" for t in found):
            found = _paired_braces(text, found)
        return found

    def shows(self, name: str) -> bool:
        """Whether the arguments of a directive are text: as often as witnesses had them, on top of what is known of it."""
        yes, n = self.shown.get(name, (0, 0))
        return yes + WEIGHT * (name.removeprefix("end_") not in SILENT) >= DROPPED * (n + WEIGHT)

    def _match(self, seen: list[Item], own: list[Group], common: list[Group], where: tuple, taken: set[int]) -> None:
        """Read a nested stream along the expressions; ``where`` is the way from the host to the level."""
        at = also = 0
        for item in seen:
            if item.key == SLOT:
                continue
            k, m = _place(own, item.key, at), _place(common, item.key, also)
            at, also = at if k is None else k + 1, also if m is None else m + 1
            mine, every = None if k is None else own[k], None if m is None else common[m]
            here = (*where, item.key)
            verdict = self.verdicts.get(here)
            if verdict is None:
                verdict = self.verdicts[here] = self._judge(item, mine, every)
            if verdict:
                taken.update(t.start for t in item.tokens)
            if item.inner:
                self._match(item.inner, mine.inner if mine else [], every.inner if every else [], here, taken)

    def _judge(self, item: Item, mine: Group | None, every: Group | None) -> bool:
        """Whether a group belongs to the template: each level's counts on top of ``WEIGHT`` sightings of the wider one."""
        share, by = _prior(item.key, item.kind), "lists"
        d, n = self.keys.get(item.key, (0, 0))
        for name, lost, kept in (("keys", d, n - d), ("common", every.dropped if every else 0, every.kept if every else 0), ("host", mine.dropped if mine else 0, mine.kept if mine else 0)):
            if lost + kept:
                share, by = (lost + WEIGHT * share) / (lost + kept + WEIGHT), name
        self.decided[by] += 1
        return share >= DROPPED


def _paired_braces(text: str, found: list[Token]) -> list[Token]:
    out: list[Token] = []
    open_at = 0
    for t in found:
        if t.kind != "brace":
            out.append(t)
            if t.kind == "tex" and text[t.end : t.end + 1] == "{":
                open_at += 1
        elif text.startswith("{\\", t.start):
            open_at += 1
            out.append(t)
        elif text[t.start] == "{":
            if t.start and out and out[-1].end == t.start and out[-1].kind == "tex":
                out.append(t)
        elif open_at:
            open_at -= 1
            out.append(t)
    return out


def _labels(text: str, tokens: list[Token], witness: str) -> dict[int, bool]:
    """Start of every token to whether the other witness goes on without it, from the aligned streams of both."""
    left: list[tuple[str, int | None]] = []
    at = 0
    for t in tokens:
        left += [(w.casefold(), None) for w in _WORD.findall(skeleton(text[at : t.start]))]
        left.append((t.key, t.start))
        at = t.end
    left += [(w.casefold(), None) for w in _WORD.findall(skeleton(text[at:]))]
    right = stream(witness)
    out: dict[int, bool] = {}
    for op, i1, i2, j1, j2 in SequenceMatcher(None, [x for x, _ in left], [x for x, _ in right], autojunk=False).get_opcodes():
        other = Counter(k for _, k in right[j1:j2] if k)
        for key, start in left[i1:i2]:
            if start is None:
                continue
            out[start] = op != "equal" and not other[key]
            other[key] -= 1
    return out


def fit(rows: list[tuple[str | None, str, str | None]]) -> Wrappers:
    """Wrappers from (host, source text, other witness or None) rows: the streams of a host are folded one after the other."""
    hosts: dict[str, list[Group]] = {}
    keys: Counter = Counter()
    lost: Counter = Counter()
    visible: Counter = Counter()
    lines: Counter = Counter()
    for host, source, witness in rows:
        if not STARTS.search(source) or not (tokens := candidates(source)):
            continue
        labels = _labels(source, tokens, witness) if witness is not None and len(tokens) <= FIT_TOKENS else {}
        first = (host or "") not in hosts
        fold(hosts.setdefault(host or "", []), items(source, tokens), labels, first)
        if labels and any(t.kind == "directive" for t in tokens):
            other = f" {' '.join(w.casefold() for w in _WORD.findall(skeleton(witness)))} "
            for t in tokens:
                end = source.find("\n", t.end)
                rest = [w.casefold() for w in _WORD.findall(skeleton(source[t.end : end if end >= 0 else len(source)]))]
                if t.kind == "directive" and rest:
                    visible[t.key.partition(":")[2]] += f" {' '.join(rest)} " in other
                    lines[t.key.partition(":")[2]] += 1
        for t in tokens:
            if t.start in labels:
                keys[_name(t)] += 1
                lost[_name(t)] += labels[t.start]
    common: list[Group] = []
    for host in sorted(hosts):
        merge(common, hosts[host])
    return Wrappers(hosts, common, {k: (lost[k], n) for k, n in keys.items()}, {k: (visible[k], n) for k, n in lines.items()})


def clean(text: str, host: str | None, wrappers: Wrappers) -> str:
    """The text without markup; headings as ``# ``, items as ``- ``, code as fenced lines, formulas as ``$...$``."""
    found = wrappers.parse(text, host)
    if not found:
        return text
    return _tidy("".join(out for _, _, out, _ in _pieces(text, found, wrappers.shows)))


def clean_span(text: str, pieces: list[tuple[int, int, str, bool]] | None, start: int, end: int) -> str:
    """Clean text of ``text[start:end]``, from the pieces of the whole text (None: no markup in it).

    What formatting leaves belongs to the place where the formatting starts; other text is cut at the borders.
    """
    if pieces is None:
        return text[start:end]
    out: list[str] = []
    touched = False
    # The pieces cover the text in order; those before the span are skipped by bisection.
    for a, b, plain, markup in pieces[max(0, bisect_right(pieces, start, key=lambda p: p[0]) - 1) :]:
        if a >= end:
            break
        if b <= start:
            continue
        touched |= markup
        out.append(text[max(a, start) : min(b, end)] if not markup else plain if a >= start else "")
    return _tidy("".join(out)) if touched else text[start:end]


def _tidy(text: str) -> str:
    lines = [x.rstrip() for x in text.split("\n")]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip("\n")


_FRAC = re.compile(r"\\d?frac\s*\{([^{}]*)\}\s*\{([^{}]*)\}")
#: Directives whose arguments control the typesetter and are no text, unless witnesses show them (fixed values).
SILENT = frozenset("c comment cindex index vindex findex kindex table itemize enumerate include insert page need sp space center font device nopara para tabs set setq vmode lisp example format group block bye end_table".split())


def _pieces(text: str, found: list[Token], shows: Callable[[str], bool] = lambda name: name.removeprefix("end_") not in SILENT) -> list[tuple[int, int, str, bool]]:
    """The text in order as (start, end, what is left of it, whether it is markup)."""
    out: list[tuple[int, int, str, bool]] = []
    at = 0
    for t in found:
        if t.start < at:
            continue
        if at < t.start:
            out.append((at, t.start, text[at : t.start], False))
        raw = text[t.start : t.end]
        at = t.end
        if t.key in ("tex:frac", "tex:dfrac") and (m := _FRAC.match(text, t.start)):
            at = m.end()
            out.append((t.start, at, "/".join(x if x.isalnum() else f"({x})" for x in m.groups()), True))
            continue
        plain = _plain(raw, t)
        # Blocks start on a line of their own.
        if plain.startswith("\n") and not plain.strip("\n") and (not t.start or text[t.start - 1] == "\n"):
            plain = ""
        elif t.kind == "tag" and plain.startswith(("- ", "#")) and t.start and text[t.start - 1] != "\n":
            plain = "\n" + plain
        name = t.key.partition(":")[2]
        if t.kind == "directive" and not shows(name):
            end = text.find("\n", at)
            at = len(text) if end < 0 else end
        elif t.kind == "directive" or t.kind == "brace" and raw.startswith("{\\") or t.kind == "tex" and not raw.endswith("}") and not plain:
            at += text[at : at + 1] == " "
        elif raw == "\x16(" and (end := text.find(")", at)) >= 0 and not any(at <= u.start < end for u in found):
            out += [(t.start, at, plain, True), (at, end, text[at:end], False), (end, end + 1, "", True)]
            at = end + 1
            continue
        out.append((t.start, at, plain, True))
    if at < len(text):
        out.append((at, len(text), text[at:], False))
    return out


#: Depth of headings by command, directive and element (fixed values).
DEPTH = {"chapter": 1, "section": 2, "subsection": 3, "subsubsection": 4, "paragraph": 5, "title": 1, "h1": 1, "h2": 2, "h3": 3, "h4": 4, "h5": 5, "h6": 6}
TEX_SIGNS = {"leq": "≤", "le": "≤", "geq": "≥", "ge": "≥", "neq": "≠", "ne": "≠", "times": "×", "cdot": "·"}


def _plain(raw: str, t: Token) -> str:
    """What is left of a markup token: heading marks, item marks, code fences, signs, visible arguments."""
    if t.kind == "entity":
        return html.unescape(html.unescape(raw))
    name = t.key.partition(":")[2]
    if t.kind == "tag":
        closing = raw.startswith("</")
        if name == "li":
            return "" if closing else "- "
        if name in ("pre", "syntaxhighlight"):
            return "\n```\n"
        if name == "math":
            return "$"
        if name in DEPTH:
            return "\n" if closing else "#" * DEPTH[name] + " "
        if name in ("sub", "sup"):
            return "}" if closing else "_{" if name == "sub" else "^{"
        if name in ("td", "th"):
            return "\t" if closing else ""
        return "\n" if name in ("br", "p", "div", "tr", "ul", "ol", "dl", "dt", "dd", "table", "hr", "blockquote", "section", "article") else ""
    if t.kind == "tex":
        if name in ("begin", "end"):
            return "```" if "verbatim" in raw or "lisp" in raw else "$$" if "equation" in raw or "math" in raw else ""
        if name in DEPTH:
            return "#" * DEPTH[name] + " " + _argument(raw)
        if name == "item":
            return "- "
        return "" if name in ("index", "label", "cite", "ref") else TEX_SIGNS.get(name, _argument(raw))
    if t.kind == "directive":
        return "#" * DEPTH[name] + " " if name in DEPTH else "- " if name in ("item", "kitem", "xitem") else "```" if name in ("lisp", "end_lisp", "example", "end_example") else ""
    if t.kind == "texsign":
        return {"\\[": "$$", "\\]": "$$", "~": " "}.get(raw, raw[1:] if len(raw) > 1 else " ")
    if t.kind == "math":
        return raw
    if t.kind == "textile":
        return "#" * int(raw[1]) + " " if raw[0] == "h" else ""
    if t.kind == "heading":
        return raw.strip() + " " if not raw.startswith(" ") or raw.endswith(" ") else ""
    if t.kind == "wikihead":
        return "#" * len(raw.strip()) if t.opens else ""
    if t.kind == "fence":
        return "```"
    return "- " if t.kind == "bullet" else ""


def _argument(raw: str) -> str:
    """The argument of a command, its escaped signs resolved."""
    a, b = raw.find("{"), raw.rfind("}")
    return re.sub(r"\\([&%$#_{}])", r"\1", raw[a + 1 : b]) if 0 <= a < b else ""


def fitted(regions: DataFrame, *, sample_regions: int = SAMPLE_REGIONS) -> Wrappers:
    """Wrappers of at most ``sample_regions`` regions with two witnesses, those of the lowest id hash."""
    # The recognised text never held formatting; a reviewer's text that equals the source can be a copy of it and shows nothing.
    reviewed = F.when(F.col("canonical_text") != F.col("source_text"), F.col("canonical_text"))
    both = regions.select("id", "document_id", "source_text", F.coalesce("ocr_text", reviewed).alias("other")).where("source_text is not null")
    rows = bounded_sample(both, ["id"], sample_regions).select("document_id", "source_text", "other").collect()
    return fit([(r[0], r[1], r[2]) for r in rows])


def _shared(df: DataFrame, wrappers: Wrappers):
    return df.sparkSession.sparkContext.broadcast((wrappers.hosts, wrappers.common, wrappers.keys, wrappers.shown))


def marked_regions(regions: DataFrame, wrappers: Wrappers) -> DataFrame:
    """Ids of regions whose source text holds markup."""
    shared = _shared(regions, wrappers)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Wrappers(*shared.value)
        for pdf in batches:
            yield frame([(k,) for k, host, t in zip(pdf["id"], pdf["document_id"], pdf["source_text"]) if t and own.parse(t, host)], ["id"])

    return regions.select("id", "document_id", "source_text").where(F.length("source_text") > 0).mapInPandas(run, "id string").distinct()


def marked_lines(sources: DataFrame, wrappers: Wrappers) -> DataFrame:
    """(source_path, lines): the numbers, from 1, of the lines of each file that hold markup themselves."""
    shared = _shared(sources, wrappers)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Wrappers(*shared.value)
        for pdf in batches:
            rows = []
            for path, host, text in zip(pdf["source_path"], pdf["document_id"], pdf["text"]):
                found: set[int] = set()
                at = line = 0
                for t in own.parse(text, host) if text else ():
                    line += text.count("\n", at, t.start)
                    at = t.start
                    found.update(range(line + 1, line + 2 + text.count("\n", t.start, t.end)))
                rows.append((path, sorted(found)))
            yield frame(rows, ["source_path", "lines"])

    return sources.select("source_path", "document_id", "text").mapInPandas(run, "source_path string, lines array<int>")


def marked_selectors(selectors: DataFrame, lines: DataFrame) -> DataFrame:
    """Ids of selectors with markup in any line of their span."""
    spans = selectors.where("size(source_span) >= 2 and source_span[0] <= source_span[1]").select("selector_id", "source_path", F.col("source_span")[0].alias("a"), F.col("source_span")[1].alias("b"))
    return spans.join(lines, "source_path").where("exists(lines, x -> x between a and b)").select("selector_id").distinct()


def found(regions: DataFrame, selectors: DataFrame, sources: DataFrame) -> DataFrame:
    """(origin, case_key) of every region and every selector with markup."""
    wrappers = fitted(regions)
    a = marked_regions(regions, wrappers).select(F.lit("region").alias("origin"), F.col("id").alias("case_key"))
    b = marked_selectors(selectors, marked_lines(sources, wrappers)).select(F.lit("selector").alias("origin"), F.col("selector_id").alias("case_key"))
    return a.unionByName(b)


def cleaned(regions: DataFrame, wrappers: Wrappers | None = None) -> DataFrame:
    """(id, clean_text) of every row of the regions table."""
    shared = _shared(regions, wrappers or fitted(regions))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Wrappers(*shared.value)
        for pdf in batches:
            yield frame([(k, clean(t, host, own) if t else t) for k, host, t in zip(pdf["id"], pdf["document_id"], pdf["source_text"])], ["id", "clean_text"])

    return regions.select("id", "document_id", "source_text").mapInPandas(run, "id string, clean_text string")


def cleaned_selectors(selectors: DataFrame, sources: DataFrame, wrappers: Wrappers) -> DataFrame:
    """(selector_id, clean_text) of every selector: the lines of its span without markup.

    A file is parsed once and as a whole, so a span inside a block is read as part of it. A null or reversed
    span, one that starts past the file, and a file that is unknown or null give a null text.
    """
    shared = _shared(sources, wrappers)
    first, last = F.col("source_span")[0], F.col("source_span")[1]
    valid = F.coalesce((F.size("source_span") >= 2) & (first <= last), F.lit(False))
    spans = selectors.select("selector_id", "source_path", F.when(valid, F.greatest(first, F.lit(1))).alias("a"), F.when(valid, last).alias("b")).distinct()
    # Each file goes to its spans once, however many there are.
    each = spans.groupBy("source_path").agg(F.collect_list("selector_id").alias("ids"), F.collect_list(F.coalesce("a", F.lit(0))).alias("firsts"), F.collect_list(F.coalesce("b", F.lit(0))).alias("lasts"))
    files = sources.select("source_path", "document_id", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Wrappers(*shared.value)
        for pdf in batches:
            for host, text, ids, firsts, lasts in zip(pdf["document_id"], pdf["text"], pdf["ids"], pdf["firsts"], pdf["lasts"]):
                starts = [0, *(m.end() for m in re.finditer("\n", text))] if text is not None else []
                tokens = own.parse(text, host) if text else []
                pieces = _pieces(text, tokens, own.shows) if tokens else None
                rows = []
                for key, a, b in zip(ids, firsts, lasts):
                    there = 1 <= a <= b and a <= len(starts)
                    end = (starts[b] - 1 if b < len(starts) else len(text)) if there else 0
                    rows.append((key, clean_span(text, pieces, starts[a - 1], end) if there else None))
                yield frame(rows, ["selector_id", "clean_text"])

    return each.join(files, "source_path", "left").select("document_id", "text", "ids", "firsts", "lasts").mapInPandas(run, "selector_id string, clean_text string")


def cleaned_all(regions: DataFrame, selectors: DataFrame, sources: DataFrame) -> DataFrame:
    """(origin, case_key, clean_text) of every row of the regions table and of every selector."""
    wrappers = fitted(regions)
    a = cleaned(regions, wrappers).select(F.lit("region").alias("origin"), F.col("id").alias("case_key"), "clean_text")
    b = cleaned_selectors(selectors, sources, wrappers).select(F.lit("selector").alias("origin"), F.col("selector_id").alias("case_key"), "clean_text")
    return a.unionByName(b)
