"""Secret scan: known shapes of secrets, and literals assigned to names that sound sensitive.

Source and configuration syntax is lexed in texts that have an assignment sign, with the state kept over
continued lines, triple quotes and block scalars. Pairs of a name and a literal come out of it; a name
set to another name, or to a sum, takes the literals of it, so a constant is followed to where it is
used, also if it is set behind that. A literal counts by the most sensitive name it reaches and by how
random it looks.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from torquelake.llm.common import identified

KINDS = ("assign", "access", "hex", "lexed")

# The shapes of the contract, letters of the names in either case.
_NAMES = ("password", "passwd", "secret", "token")
_CASELESS = "|".join("".join(f"[{c.upper()}{c}]" for c in name) for name in _NAMES)
ASSIGN = re.compile(rf"""({_CASELESS}|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

#: How sensitive a part of a name is.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.8, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "auth": 0.6, "bearer": 0.8, "private": 0.5, "access": 0.4,
    "signing": 0.5, "encryption": 0.5, "api": 0.4, "key": 0.4, "dsn": 0.6, "salt": 0.5, "cookie": 0.5,
}
REPORTED = 0.5
#: Literals that stand for a secret without being one.
_PLACEHOLDER = re.compile(r"(?i)\A(?:x+|\*+|\.+|change_?me|example|placeholder|none|null|true|false|todo|test|dummy|your.*|<.*>|\$\{.*\}|%\(.*\)s|\{\{.*\}\})\Z")
_LEXEME = re.compile(
    r"""(?P<comment>(?:\#|//)[^\n]*)|(?P<triple>\"{3}(?:[^\\]|\\.)*?\"{3}|'{3}(?:[^\\]|\\.)*?'{3})"""
    r"""|(?P<string>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')|(?P<cont>\\\r?\n)"""
    r"""|(?P<op>:=|=>|===?|!=|[<>]=|[:=])|(?P<word>[A-Za-z0-9_$][A-Za-z0-9_$.+/-]*=*)|(?P<plus>\+)|(?P<end>[\n;,{}()\[\]|])""",
    re.DOTALL,
)
#: Behind a colon: a block scalar, whose lines follow.
_BLOCK = re.compile(r"\x20*[|>][0-9+-]*\x20*(?:\#[^\n]*)?\r?\n")
_LINE = re.compile(r"[^\n]*\n?")
#: Words between a name and its sign that are its type.
_TYPES = frozenset("string str byte bytes int int64 any interface char text String Any".split())
#: Literals that a sum may have when constants in it are followed.
SUMMED = 1000
_NAME = re.compile(r"\A[A-Za-z_$][A-Za-z0-9_$.-]*\Z")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

Span = tuple[int, int, str]
#: Text, start, end, and whether it is a bare word, which may be a name.
Part = tuple[str, int, int, bool]


def base_spans(text: str) -> list[Span]:
    """``start, end, kind`` of the known shapes, leftmost and without overlap in a kind."""
    found: list[Span] = []
    if ":" in text or "=" in text:
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return found


def name_score(name: str) -> float:
    """Of the parts of a name in camel, snake, dotted or dashed case; two weak parts add up."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    return min(1.0, sum(sorted((SENSITIVE.get(p, 0.0) for p in {*parts}), reverse=True)[:2]))


def literal_score(value: str) -> float:
    """0 for what is short, a placeholder or one sign repeated; up to 1 with bits for a character."""
    if len(value) < 6 or _PLACEHOLDER.match(value) or any(c.isspace() for c in value):
        return 0.0
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())
    return min(1.0, bits / 3)


def assignments(text: str) -> Iterator[tuple[str, str, int, int]]:
    """``name, literal, start, end`` of each assignment, constants followed; a sum gives each of its parts.

    A quoted string, or on the right side a bare word that is no known name, is a literal; a word that
    is a name set elsewhere stands for its literal, the last one before or else the first one behind.
    """
    found = list(_assigned(text))
    later: dict[str, list[Part]] = {}
    for name, parts in reversed(found):
        later[name] = parts
    known: dict[str, list[Part]] = {}

    def resolved(parts: list[Part], through: frozenset[str]) -> list[Part]:
        out: list[Part] = []
        for part in parts:
            word = part[0]
            if not part[3] or word in through or len(through) > 50:
                out.append(part)
            elif word in known:
                out += known[word]
            elif word in later:
                out += resolved(later[word], through | {word})
            else:
                out.append(part)
            if len(out) > SUMMED:
                return out
        return out

    for name, parts in found:
        known[name] = whole = resolved(parts, frozenset([name]))
        value = "".join(p[0] for p in whole)
        for _, start, stop, _ in whole:
            yield name, value, start, stop


def _block(text: str, at: int, colon: int) -> list[Part]:
    """Lines of a block scalar: those behind ``at`` that are further in than the line of the colon."""
    head = text[text.rfind("\n", 0, colon) + 1 : colon]
    depth = len(head) - len(head.lstrip(" "))
    lines = []
    while at < len(text):
        line = _LINE.match(text, at)[0]
        inner = line.strip()
        start = at + len(line) - len(line.lstrip())
        if inner and start - at <= depth:
            break
        if inner:
            lines.append((inner, start, start + len(inner), False))
        at += len(line)
    return lines


def _assigned(text: str) -> Iterator[tuple[str, list[Part]]]:
    """Names and the parts of what they are set to, as they stand."""
    name = ready = None  # the last word or quoted key; the name that waits for its value
    typed = False  # whether the sign was a colon, so that a word behind it may be a type
    parts: list[Part] = []  # of the name in ``owner``, complete unless a plus follows
    owner, more, bracket = None, False, 0
    for m in _LEXEME.finditer(text):
        kind, word = m.lastgroup, m[0]
        if kind == "cont":
            continue
        if owner is not None:
            if kind == "plus":
                more = True
                continue
            if more and kind in ("string", "word"):
                start, stop = (m.start() + 1, m.end() - 1) if kind == "string" else m.span()
                parts.append((text[start:stop], start, stop, kind == "word"))
                more = False
                continue
            if typed and parts[-1][3] and (word in ("[", "|") or bracket and word != "\n"):
                bracket = max(0, bracket + (word in ("[", "|")) - (word == "]" or kind == "word" and text[m.start() - 2 : m.start()].strip() == "|"))
                continue
            if typed and len(parts) == 1 and parts[0][3] and word == "=":
                ready, owner, typed = owner, None, False
                continue
            yield owner, parts
            owner, more, bracket, name = None, False, 0, None
        if kind == "op":
            block = _BLOCK.match(text, m.end()) if word == ":" and name else None
            if block and (lines := _block(text, block.end(), m.start())):
                for line in lines:
                    yield name, [line]
                name = ready = None
                continue
            ready, name = (name, None) if word in (":", "=", ":=", "=>") else (None, None)
            typed = word == ":"
        elif kind in ("end", "comment", "plus"):
            name = name if word == "]" else None
            ready = None
        elif kind == "triple":
            at = m.start() + 3
            if ready is not None:
                for line in text[at : m.end() - 3].splitlines(keepends=True):
                    start = at + len(line) - len(line.lstrip())
                    if line.strip():
                        yield ready, [(line.strip(), start, start + len(line.strip()), False)]
                    at += len(line)
            name = ready = None
        else:
            start, stop = (m.start() + 1, m.end() - 1) if kind == "string" else m.span()
            value = text[start:stop]
            if ready is not None:
                if typed and kind == "word" and value.endswith("=") and text[stop : stop + 1] in ("'", '"'):  # name: str="..."
                    typed = False
                    continue
                owner, parts = ready, [(value, start, stop, kind == "word")]
                name = ready = None
            elif not (name and kind == "word" and value in _TYPES):
                name = value.rstrip("=") if _NAME.match(value.rstrip("=")) else None
                if kind == "word" and word.endswith("=") and name:  # name=value without a space
                    ready, name, typed = name, None, False
    if owner is not None:
        yield owner, parts


def lexed_spans(text: str) -> list[Span]:
    """Literals whose names and looks together reach ``REPORTED``."""
    found = {(a, b, "lexed") for name, value, a, b in assignments(text) if name_score(name) * literal_score(value) >= REPORTED}
    return sorted(found)


def scan_text(text: str) -> tuple[list[Span], list[Span]]:
    """Known shapes, and with them the literals that none of them covers, by start and kind."""
    base = base_spans(text)
    order = lambda s: (s[0], KINDS.index(s[2]), s[1])
    base.sort(key=order)
    lexed = lexed_spans(text) if ":" in text or "=" in text else []
    added = [s for s in lexed if not any(a <= s[0] and s[1] <= b for a, b, _ in base)]
    return base, sorted(base + added, key=order)


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for every row; no row is shuffled.

    Spans are ``kind:start:end`` in code points, end exclusive. ``base_sha256`` is of those of known
    shapes alone. A null or empty text has none and the hash of an empty string. Rows that repeat
    are scanned as often; an empty table gives an empty result.
    """
    rows = identified(docs, id_col, text_col).select("_id", "_text")
    id_type = rows.schema["_id"].dataType.simpleString()

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[], [], []]
            digests, spans = [], []
            for value in batch.column(1):
                base, every = scan_text(value.as_py())
                kinds = Counter(kind for _, _, kind in base)
                for column, kind in zip(counts, KINDS, strict=False):
                    column.append(kinds[kind])
                digests.append(hashlib.sha256(written(base).encode()).hexdigest())
                spans.append(written(every))
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    schema = f"doc_id {id_type}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return rows.mapInArrow(scanned, schema)
