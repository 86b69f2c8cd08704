"""Names and literals paired by syntax beyond ``name = "literal"``.

``pairs`` looks at every name that the caller finds sensitive and reads what
follows it:

* signs ``=``, ``:``, ``:=``, ``=>`` after a name, a quoted key or a subscript
  (``config["name"] = ``), after a type with balanced brackets, and with the
  value on the next line, behind a backslash or in parentheses;
* strings with prefixes (``b"..."``), triple and back quotes, adjacent strings;
* defaults: ``x or "..."``, ``x ?? "..."``, ``f("...", "...")``, and the second
  argument after a quoted name (``get("name", "...")``, ``set("name", "...")``);
* setters (``setName("...")``), ``#define NAME ...``, ``--name value``;
* tuples (``a, name = 1, "..."``), YAML blocks (``name: |``), XML elements and
  ``key="name" value="..."`` attributes.

A literal holds no white space.  Every pattern is possessive and every region
is read a bounded number of times, so the time is in proportion to the text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

Places = list[tuple[int, int]]

# Parts of names worth a look; the caller decides on whole names.
STEMS = ("pass", "pwd", "secret", "token", "key", "credential", "private", "auth", "bearer", "signing", "encryption",
         "salt", "session", "access")
_NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-")
_REST = re.compile(r"[A-Za-z0-9_.-]*+")
_STRING = re.compile(
    r"""[A-Za-z]{0,2}+(?:\"{3}\s*+([^\s"]++)\s*+\"{3}|'{3}\s*+([^\s']++)\s*+'{3}"""
    r"""|"((?:[^\s"\\]|\\\S)++)"|'((?:[^\s'\\]|\\\S)++)'|`([^\s`]++)`)""")
_MORE = re.compile(r"""(?:\s|\\\n)*+[+.]?+(?:\s|\\\n)*+(?=[A-Za-z]{0,2}["'`])""")
_SIGN = re.compile(r"""["'`]?+[ \t]*+\]?+[ \t]*+(?::=|=>|=(?!=)|:(?![:/=]))""")
_GAP = re.compile(r"(?:\s|\\\n|\()*+")
_TYPED = re.compile(r"[ \t]*+[?!]?:[ \t]*+(?=[A-Za-z_&*\[(])")
_TYPE = re.compile(r"[A-Za-z0-9_ \t<>,\[\].&|?:*()]*+")
_OR = re.compile(r"[\w.]++(?:[(\[][^()\[\]\n]*+[)\]])?+[ \t]*+(?:or\b|\|\||\?\?|\?:)[ \t]*+")
_DEFAULT = re.compile(r"""[\w.]++\([ \t]*+(?:"[^"\n]*+"|'[^'\n]*+')[ \t]*+,[ \t]*+""")
_SECOND = re.compile(r"""["'`]\s*+,\s*+""")
_SETS = re.compile(r"(?:.*[._])?(?:set|with|put|add)(?=[A-Z_])", re.S)
_CALLED = re.compile(r"\(\s*+")
_BARE = re.compile(r"""[ \t]++["']?+([^\s"']++)""")
_FLAG = re.compile(r"""(?:[ \t]++|=)["']?+([^\s"'\\-][^\s"']*+)""")
_BLOCK = re.compile(r"""["']?+[ \t]*+:[ \t]*+[|>][-+0-9]{0,2}+[ \t]*+\n[ \t]++(\S++)[ \t]*+(?:\n|\Z)""")
_ELEMENT = re.compile(r">\s*+([^<>\s]++)\s*+</")
_ATTRIBUTE = re.compile(r"""["']\s++value\s*+=\s*+(?=["'])""", re.I)
_TUPLE = re.compile(r"^[ \t]*+([\w.]++(?:[ \t]*+,[ \t]*+[\w.]++)++)[ \t]*+=(?!=)[ \t]*+(.++)$", re.M)
_ITEM = re.compile(r"""(?:"(?:[^"\\]|\\.)*+"|'(?:[^'\\]|\\.)*+'|[^,"'])++""")


def names(text: str) -> Iterator[tuple[int, int]]:
    """Places of the words that hold one of ``STEMS``, in order."""
    low = text.lower()
    if len(low) != len(text):  # a letter whose lower case is longer
        low = "".join(c.lower() if c.isascii() else c for c in text)
    starts = []
    for stem in STEMS:
        at = low.find(stem)
        while at >= 0:
            starts.append(at)
            at = low.find(stem, at + len(stem))
    end = 0
    for at in sorted(starts):
        if at < end:
            continue
        a = at
        while a > end and text[a - 1] in _NAME_CHARS:
            a -= 1
        end = _REST.match(text, at).end()
        yield a, end


def _strings(text: str, at: int) -> Places:
    """The string at a place, and those joined to it."""
    out: Places = []
    while m := _STRING.match(text, at):
        out.append(m.span(m.lastindex))
        more = _MORE.match(text, m.end())
        if not more:
            break
        at = more.end()
    return out


def _value(text: str, at: int) -> Places:
    """The literals of an expression that starts here."""
    at = _GAP.match(text, at).end()
    if found := _strings(text, at):
        return found
    other = _OR.match(text, at) or _DEFAULT.match(text, at)
    return _strings(text, other.end()) if other else []


def pairs(text: str, sensitive: Callable[[str], bool]) -> list[tuple[str, Places]]:
    """(name, places of its literals) for the names that ``sensitive`` accepts."""
    out: list[tuple[str, Places]] = []
    typed_to = 0
    some = False
    for a, e in names(text):
        name = text[a:e].strip(".-")
        if not name or not sensitive(name):
            continue
        some = True
        before = text[max(0, a - 1):a]
        found: Places = []
        if m := _BLOCK.match(text, e) or (before == "<" and _ELEMENT.match(text, e)) or (
                text.startswith("--", a) and _FLAG.match(text, e)) or (
                text.endswith("#define ", max(0, a - 8), a) and _BARE.match(text, e)):
            found = [m.span(1)]
        elif m := _SIGN.match(text, e):
            found = _value(text, m.end())
        elif before and before in "\"'" and (m := _ATTRIBUTE.match(text, e)):
            found = _strings(text, m.end())
        elif before and before in "\"'`" and (m := _SECOND.match(text, e)) and _opened(text, a - 1):
            found = _strings(text, m.end())
        elif (m := _CALLED.match(text, e)) and _SETS.match(name):
            found = _strings(text, m.end())
        if not found and e >= typed_to and (m := _TYPED.match(text, e)):
            run = _TYPE.match(text, m.end())
            typed_to = run.end()
            kind = run[0]
            if (("<" in kind or "[" in kind) and all(kind.count(x) == kind.count(y) for x, y in ("<>", "[]", "()"))
                    and text[typed_to:typed_to + 1] == "=" and text[typed_to + 1:typed_to + 2] not in ("=", ">")):
                found = _value(text, typed_to + 1)
        if found:
            out.append((name, found))
    if some:
        for m in _TUPLE.finditer(text):
            targets = [x.strip() for x in m[1].split(",")]
            if any(map(sensitive, targets)):
                items = list(_ITEM.finditer(text, m.start(2), m.end(2)))
                if len(items) == len(targets):
                    out += [(t, found) for t, item in zip(targets, items) if sensitive(t)
                            and (found := _strings(text, _GAP.match(text, item.start()).end()))]
    return out


def _opened(text: str, quote: int) -> bool:
    """Whether a call's bracket stands before the quote, spaces aside."""
    at = quote
    while at > 0 and text[at - 1] in " \t":
        at -= 1
    return at > 0 and text[at - 1] == "("
