"""Secret scans with assignment-aware lexing.

Base kinds are plain patterns: ``assign`` (a sensitive word, a sign and a
value), ``access`` (cloud access keys) and ``hex`` (long hex runs).

Lexing: source and configuration syntax is read as name, sign and literal
(``name = "x"``, ``name: x``, ``"name" => 'x'``, ``export NAME=x``), with a type
between name and sign or not (``name: Type = "x"``, ``var name Type = "x"``), where a
value may be a quoted literal, a bare word, another name (also ``$NAME`` and
``${NAME}``), or such parts joined by ``+`` or ``.``.  ``assignments`` adds the
forms in which name and literal stand further apart (subscripts, tuples, calls
and defaults, prefixed and long strings, types, YAML blocks, XML pairs).  Any bare word that the
text assigns is a reference.  A name takes the literals of the names it refers
to; a concatenation is scored as folded and its parts are reported.  Each name
is split into its words, which give it a sensitivity; a literal scores the
sensitivity of the most sensitive name that it reaches, times how much it
looks like a key.
Literals that reach the threshold are spans of kind ``lexed``.

Null and empty texts have no spans.  Repeated rows give repeated results.
``redact`` replaces the union of all spans and passes every column through;
only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm import assignments
from souk.llm.shared import slices

KINDS = ("assign", "access", "hex", "lexed")
# Base patterns and the least length of a finding.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # a shorter run fails as a whole
MIN_ASSIGN, MIN_ACCESS = 6, 20
# Words of a name and how sensitive they make it.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "private": 0.6, "access": 0.5, "auth": 0.7, "bearer": 0.8,
    "signing": 0.6, "encryption": 0.6, "client": 0.3, "api": 0.4, "key": 0.5, "salt": 0.5, "session": 0.4,
}
THRESHOLD = 0.5
MIN_LITERAL = 8

_NAME = r"[A-Za-z_][A-Za-z0-9_.-]*"
# A bare value goes on up to white space, a quote, comma or semicolon.
_PART = r"""(?:"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|[A-Za-z0-9_$!@#%^~*&?][^\s"',;]*)"""
_JOIN = r"(?:[ \t]*[+.][ \t]*|(?<=\+)[ \t]*|(?<=\.))"
# A type between name and '=': ``name: Type =`` with references, paths,
# generics and unions, or ``name Type =`` after var or const or with a plain
# type word.  ``Type name =`` stays with the name before the sign.
_ARGS = r"""(?:<[^<>=\n"]{0,60}(?:<[^<>=\n"]{0,60}>[^<>=\n"]{0,60})*>|\[[^\[\]=\n"]{0,60}(?:\[[^\[\]=\n"]{0,60}\][^\[\]=\n"]{0,60})*\])"""
_ATOM = rf"""(?:[&*]|'[a-z_]+[ \t]+|\[[0-9]*\]|(?:mut|dyn|const|readonly)[ \t]+){{0,4}}(?:[A-Za-z_]\w*(?:(?:\.|::)[A-Za-z_]\w*)*|\[[^\[\]=\n"]{{1,60}}\]){_ARGS}{{0,4}}[?!]?"""
_TYPE = rf"""{_ATOM}(?:[ \t]*\|[ \t]*{_ATOM})*"""
_PLAIN_TYPE = r"(?:\*|\[\w*\])*(?:string|String|str|byte|bytes|rune|char|any|error|u?int(?:8|16|32|64)?|bool|float(?:32|64)|auto|object|std|unsigned|signed)\b"
_MODIFIER = r"(?:public|private|protected|internal|static|final|readonly|const|constexpr|let|var|val|mut|export|def|new|return)\b"
_AFTER_NAME = (rf"""(?:["']?[ \t]*[?!]?:[ \t]*{_TYPE}(?:[ \t]+=(?![=>])|[ \t]*=(?=["']))"""
               rf"""|[ \t]+{_PLAIN_TYPE}[ \t]*=(?![=>])"""
               r"""|["']?[ \t]*(?::=|=>|=(?!=)|:(?![:/])))""")
_LEX = re.compile(rf"""(?<![A-Za-z0-9_.-])["']?(?:(?:var|const)[ \t]+(?!{_MODIFIER}|{_PLAIN_TYPE})(?P<go>[A-Za-z_]\w*)[ \t]+{_TYPE}[ \t]*=(?![=>])|(?!(?:{_MODIFIER}|{_PLAIN_TYPE})[ \t]+[A-Za-z_*\[])(?P<name>{_NAME}){_AFTER_NAME})[ \t]*(?P<value>{_PART}(?:{_JOIN}{_PART})*)""", re.A)
_PARTS = re.compile(_PART, re.A)
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*\Z", re.A)
_REFERENCE = re.compile(r"[$@]?\{?([A-Za-z_][A-Za-z0-9_.-]*)\}?[)\]}]*\Z", re.A)
_CALL = re.compile(r"[A-Za-z_][A-Za-z0-9_.:]*(?:[(\[]|[(\[].*[)\]])\Z", re.A)
_INSIDE = re.compile(r"passphrase|password|passwd|credentials|credential|apikey|secret(?!ar|ion)|token(?!i[sz])|bearer|pwd"
                     r"|private|signing|encryption|session|access|client|auth|salt|api|key")
_STRONG = {"passphrase", "password", "passwd", "credentials", "credential", "apikey", "secret", "token", "bearer", "pwd"}
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")

Found = tuple[int, int, int]  # start, kind, end


def base(text: str) -> list[Found]:
    """Base findings: leftmost and non-overlapping for each kind."""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


@lru_cache(maxsize=1 << 14)
def sensitivity(name: str) -> float:
    """How sensitive a target name is, 0 to 1.  In joined names (``dbpwd``)
    words of the list count if one of them is telling by itself or they make
    up the whole name."""
    words: set[str] = set()
    for w in (w.lower() for w in _WORDS.findall(name)):
        inside = [w] if w in SENSITIVE else _INSIDE.findall(w)
        if not _STRONG.isdisjoint(inside) or "".join(inside) == w:
            words.update(inside)
    return min(1.0, sum(SENSITIVE.get(w, 0.0) for w in words))


def looks_random(value: str | Counter) -> float:
    """Entropy of the characters (a text, or their counts) against that of a
    random key, 0 to 1; digits or mixed case are needed for more than half."""
    chars = Counter(value)
    n = sum(chars.values())
    if n < MIN_LITERAL or any(c.isspace() for c in chars):
        return 0.0
    bits = -sum(c / n * math.log2(c / n) for c in chars.values())
    mixed = any(c.isdigit() for c in chars) or (any(c != c.lower() for c in chars) and any(c != c.upper() for c in chars))
    return min(1.0, bits / 3.0) * (1.0 if mixed else 0.5)


Part = tuple[int, int] | str  # a literal's place, or the name referred to


def _expressions(text: str) -> list[tuple[str, list[Part]]]:
    """Each assignment's name and the parts of its value."""
    found = list(_LEX.finditer(text))
    assigned = {m["go"] or m["name"] for m in found}

    def refers(word: str) -> str | None:
        m = _REFERENCE.match(word)
        name = m and (m[1] if m[1] in assigned else m[1].strip("."))
        return name if name in assigned else None

    out = []
    for m in found:
        parts: list[Part] = []
        for p in _PARTS.finditer(text, m.start("value"), m.end("value")):
            a, b = p.span()
            if text[a] in "\"'":
                parts.append((a + 1, b - 1))
                continue
            word = p[0]
            # A sign that joins the next part is no part of the word.
            while b < m.end("value") and word[-1:] in ("+", "."):
                word, b = word[:-1], b - 1
            names = [refers(word)]
            if names[0] is None and ("+" in word or "." in word):
                names = next((x for x in ([refers(w) for w in word.split(sign)] for sign in "+.") if len(x) > 1 and all(x)), names)
            if all(names):
                parts += names
            elif not _CALL.match(word) and (not _IDENTIFIER.match(word) or any(c.isdigit() for c in word)):
                parts.append((a, b))
        out.append((m["go"] or m["name"], parts))
    return out


def _folded(text: str, rows: list[tuple[str, list[Part]]]) -> list[Counter]:
    """Character counts of each value with its references followed: to the
    assignment last before it, else to the first one as it stands alone."""
    first: dict[str, Counter] = {}
    for _ in range(2):
        latest: dict[str, Counter] = {}
        out = []
        for name, parts in rows:
            chars: Counter = Counter()
            for p in parts:
                chars.update(latest.get(p, first.get(p, {})) if isinstance(p, str) else text[p[0]:p[1]])
            out.append(chars)
            latest[name] = chars
        first = {name: c for (name, _), c in zip(reversed(rows), reversed(out))}
    return out


def _sensitive(name: str) -> bool:
    return sensitivity(name) >= THRESHOLD


def _apart(text: str) -> set[tuple[int, int]]:
    """Literals that ``assignments`` pairs with a sensitive name."""
    found: set[tuple[int, int]] = set()
    for name, places in assignments.pairs(text, _sensitive):
        weight, values = sensitivity(name), [text[a:b] for a, b in places]
        whole = len(places) > 1 and weight * looks_random("".join(values)) >= THRESHOLD
        found.update(p for p, v in zip(places, values) if whole or weight * looks_random(v) >= THRESHOLD)
    return found


def lexed(text: str) -> list[Found]:
    """Literals that reach a sensitive name, directly or by constants."""
    return [(a, 3, b) for a, b in sorted(_reached(text) | _apart(text))]


def _reached(text: str) -> set[tuple[int, int]]:
    """Literals that ``_expressions`` lead to a sensitive name."""
    rows = _expressions(text)
    of: dict[str, list[int]] = {}
    for i, (name, _) in enumerate(rows):
        of.setdefault(name, []).append(i)
    weights = {name: w for name in of if (w := sensitivity(name)) > 0}
    # Names from the most sensitive on: each passes its weight to those it
    # refers to, once.
    reached: dict[str, float] = {}
    for name in sorted(weights, key=weights.get, reverse=True):
        front = [name]
        while front:
            n = front.pop()
            if n not in reached:
                reached[n] = weights[name]
                front += [p for i in of[n] for p in rows[i][1] if isinstance(p, str)]
    if not reached:
        return set()
    folded: list[Counter] = []
    if any(len(rows[i][1]) > 1 for n in reached for i in of[n]):
        folded = _folded(text, rows)
    found: set[tuple[int, int]] = set()
    whole: set[str] = set()
    for name, weight in reached.items():
        for i in of[name]:
            parts = rows[i][1]
            all_of_it = len(parts) > 1 and weight * looks_random(folded[i]) >= THRESHOLD
            for p in parts:
                if isinstance(p, str):
                    if all_of_it:
                        whole.add(p)
                elif p[0] < p[1] and (all_of_it or weight * looks_random(text[p[0]:p[1]]) >= THRESHOLD):
                    found.add(p)
    # Every literal behind a folded value is a part of it.
    front, seen = list(whole), set()
    while front:
        n = front.pop()
        if n not in seen:
            seen.add(n)
            for i in of[n]:
                found.update(p for p in rows[i][1] if not isinstance(p, str) and p[0] < p[1])
                front += [p for p in rows[i][1] if isinstance(p, str)]
    return found


def scan(text: str) -> list[Found]:
    """All findings by start, then kind as listed, then end."""
    return sorted(base(text) + lexed(text)) if text else []


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): spans is an array of (kind, start, end) in code points."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            rows = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in scan(x or "")]
                    for x in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(rows, arrow)], ["id", "spans"])

    return (source.mapInArrow(run, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")
            .withColumnRenamed("id", id_col))


def mask(text: str, sign: str = "[SECRET]") -> str:
    """The text with every run of overlapping findings replaced."""
    out, at = [], 0
    for a, _, b in scan(text):
        if a >= at:
            out += [text[at:a], sign]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None,
           sign: str = "[SECRET]") -> DataFrame:
    """``docs`` with findings masked in the text; ``length_col``, if given,
    gets the new length in code points where the text changed."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            old = part.column(text_col).to_pylist()
            new = [x if x is None else mask(x, sign) for x in old]
            i = part.schema.get_field_index(text_col)
            part = part.set_column(i, part.schema.field(i), pa.array(new, part.schema.field(i).type))
            if length_col is not None:
                j = part.schema.get_field_index(length_col)
                was = part.column(j).to_pylist()
                now = [w if a == b else len(b) for a, b, w in zip(old, new, was)]
                part = part.set_column(j, part.schema.field(j), pa.array(now, part.schema.field(j).type))
            yield part

    return docs.mapInArrow(run, schema)
