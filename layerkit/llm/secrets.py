"""Secret scans with an assignment-aware lexer.

Three base patterns give the spans that any scan would find. The lexer then
reads text as source or configuration: names, literals and what joins them. It
keeps name-literal pairs, follows a name that is assigned from another name to
the literal behind it, and scores each literal by how sensitive the names are
that it reaches, how long it is and how mixed its characters are. Literals that
score enough are added as spans of kind ``lexed``; base spans always stay.

A literal is quoted, or it is an unquoted value up to white space or a
delimiter that no held name equals, as in .env, INI, YAML and credentials
files. Quotes may have a prefix, be three or be back quotes. A call, an index and
``$NAME`` are no literals. A type between name and value is read past, and all
names of a chain ``a = b = "..."`` hold its end. Names may be subscripts in
quotes, stand in a tuple, be elements or the first argument of a call whose second
is a literal; YAML blocks give their lines. Literals and held names that are added
up are one value. An unquoted value of a name that is not sensitive, such as a
URL, may hold pairs; one after a colon amid other words is prose and no literal.

Texts are scanned whole, one row at a time, where they lie: nothing is shuffled
and memory is bounded by a batch and one text's assignments.

Defined cases: a null or empty text has no spans. Rows may repeat, each is
scanned. An empty table has no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from layerkit.llm.common import mapped, table

# The base patterns, and the order of kinds.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 or more is the same run without the bound
KINDS = ("assign", "access", "hex", "lexed")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
WORDS = re.compile(r"(?i:passw|secret|token|api_?key)", re.ASCII)

# Sensitive parts of names and what they are worth.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.9,
    "credentials": 0.9, "privatekey": 1.0, "accesskey": 1.0, "auth": 0.7, "bearer": 0.8, "signature": 0.5, "salt": 0.5, "key": 0.6,
}
LEAST_SCORE = 1.0
LEAST_LITERAL = 6
# Runs are possessive: nothing is tried twice, so no run needs a bound.
NAME = r"[A-Za-z_][A-Za-z0-9_.\-]*+"
TYPE = rf"(?:&(?:'[a-z]++[ \t]++)?(?:mut[ \t]++)?)?{NAME}[?!]?(?:[ \t]*+[\[<|][^\"'\n=;:(){{}}]*+)?"
# A string literal: prefixed or not, in three quotes, one or two, or back quotes.
QUOTED = (
    r"(?i:[rbfu]{1,2}+(?=[\"']))?+(?:"
    r'"""(?P<three>(?:[^"\\]++|\\.|"(?!""))*+)"""' + r"|'''(?P<thrice>(?:[^'\\]++|\\.|'(?!''))*+)'''"
    r'|"(?P<double>[^"\\\n]*+(?:\\.[^"\\\n]*+)*+)"' + r"|'(?P<single>[^'\\\n]*+(?:\\.[^'\\\n]*+)*+)'|`(?P<back>[^`\n]*+)`)"
)
LITERAL = re.compile(QUOTED, re.DOTALL)
_GROUPS = ("three", "thrice", "double", "single", "back")
ASSIGNS = rf"(?::[ \t]*+{TYPE}[ \t]*+:?=(?![=>~])|:=|=>|=(?![=~])|(?P<colon>:))"
LEXED = re.compile(
    rf"""(?<![A-Za-z0-9_.\-])[0-9.\-]*+(?P<name>{NAME})["']?\]*+[ \t]*+{ASSIGNS}[ \t]*+"""
    rf"""(?:{QUOTED}"""
    rf"""|(?P<chain>(?={NAME}(?:[ \t]++:?=|:?=(?=[ \t"']))(?![=>~])))|(?P<block>[|>][+\-]?[ \t]*+\r?\n)"""
    rf"""|(?=(?P<first>[^\s"'`,;()\[\]{{}}<>=:])))""",
    re.DOTALL,
)
# An unquoted value; ``&`` ends it only before the next pair of a query string.
RUN = re.compile(rf"""(?:[^\s"'`,;()\[\]{{}}<>&]++|&(?!{NAME}=))++""")
WHOLE = re.compile(rf"\$?({NAME})")
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
# What joins a literal or name with the next one.
JOIN = re.compile(r"[ \t]*+(?:(?:\+|\.\.?)[ \t]*+(?:\\?\r?\n[ \t]*+)?|\\\r?\n[ \t]*+|(?=[\"']))")
# Names in a row; as many values may follow one sign of equality.
ROW = re.compile(rf"(?<![A-Za-z0-9_.\-]){NAME}(?:[ \t]*+,[ \t]*+{NAME})++")
EQUALS = re.compile(r"[ \t]*+=(?![=>~])[ \t]*+(?=[rbfuRBFU]{0,2}[\"'`])")
COMMA = re.compile(r"[ \t]*+,[ \t]*+")
# A name in quotes and a literal, as the arguments of a call.
DEFAULT = re.compile(rf"""\([ \t]*+["'](?P<name>{NAME})["'][ \t]*+,[ \t]*+(?={"[rbfuRBFU]{0,2}"}["'`])""")
ELEMENT = re.compile(rf"<(?P<name>{NAME})(?:[ \t][^<>\n]*+)?>(?P<value>[^<>\s]++)</(?P=name)>")
LINE = re.compile(r"(?P<indent>[ \t]*+)(?P<line>[^\r\n]*+)\r?\n?")
_NAMED = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-")


class Span(NamedTuple):
    start: int
    rank: int  # of the kind
    end: int

    def __str__(self) -> str:
        return f"{KINDS[self.rank]}:{self.start}:{self.end}"


def base_spans(text: str) -> list[Span]:
    """Spans of the three patterns; each pattern runs only where its fixed letters occur."""
    found = []
    if WORDS.search(text):
        found += [Span(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [Span(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [Span(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def sensitivity(name: str) -> float:
    """Worth of the most sensitive part of a name, or of two parts in a row."""
    parts = [p.lower() for p in PARTS.findall(name)]
    pairs = [a + b for a, b in zip(parts, parts[1:])]
    return max((SENSITIVE.get(p, 0.0) for p in [*parts, *pairs]), default=0.0)


def mixture(literal: str) -> float:
    """Bits per character, from 0 for one repeated character; 4 counts as fully mixed."""
    size = len(literal)
    bits = -sum(n / size * math.log2(n / size) for n in Counter(literal).values())
    return min(1.0, bits / 4)


Place = tuple[int, int]


def _inside(m: re.Match) -> Place:
    """Where the contents of a matched string literal lie."""
    return next(m.span(g) for g in _GROUPS if m[g] is not None)


def _joined(text: str, at: int, held: dict[str, list[Place]]) -> tuple[list[Place], int]:
    """What is added to a value that ends at ``at``: string literals, and the literals of held names."""
    found: list[Place] = []
    while (sign := JOIN.match(text, at)) is not None:
        if (m := LITERAL.match(text, sign.end())) is not None:
            found.append(_inside(m))
            at = m.end()
        elif sign.end() > at and (m := WHOLE.match(text, sign.end())) is not None and m[1] in held:
            found += held[m[1]]
            at = m.end()
        else:
            break
    return found, at


def _block(text: str, at: int, name_at: int) -> tuple[list[Place], int]:
    """Lines of a block that stand deeper than the name it belongs to."""
    start = text.rfind("\n", 0, name_at) + 1
    own = len(text[start:name_at]) - len(text[start:name_at].lstrip(" \t-"))
    found = []
    while at < len(text):
        m = LINE.match(text, at)
        if m["line"].strip() and len(m["indent"]) <= own:
            break
        if m["line"].strip():
            found.append((m.start("line"), m.start("line") + len(m["line"].rstrip())))
        at = m.end()
    return found, at


def _back(text: str, at: int, characters: frozenset[str] | str) -> int:
    """Where a run of characters that ends at ``at`` begins."""
    while at and text[at - 1] in characters:
        at -= 1
    return at


def _in_prose(text: str, name_at: int, end: int) -> bool:
    """Whether an unquoted value after a colon reads like running text: a word before the name, or after the value."""
    begin = _back(text, name_at, _NAMED)
    gap = _back(text, begin, " \t")
    if 0 < gap < begin and text[gap - 1].isalpha():
        return True
    after = text[end : end + 2]
    return len(after) == 2 and after[0] in " \t" and after[1].isalpha()


def _target(text: str, at: int) -> list[str]:
    """The name that what is called right before ``at`` is assigned to, if there is one."""
    sign = _back(text, _back(text, at, _NAMED), " \t")
    if not sign or text[sign - 1] != "=":
        return []
    end = _back(text, _back(text, sign - 1, ": \t"), "\"']")
    name = text[_back(text, end, _NAMED) : end].lstrip("0123456789.-")
    return [name] if name else []


def _elsewhere(text: str) -> Iterator[tuple[list[str], list[Place]]]:
    """Pairs that no single sign joins: tuples, defaults in calls and elements."""
    if "," in text:
        for row in ROW.finditer(text) if "=" in text else ():
            sign = EQUALS.match(text, row.end())
            at = sign.end() if sign else len(text)
            for name in re.split(r"[ \t]*,[ \t]*", row[0]) if sign else ():
                value = LITERAL.match(text, at)
                if value is None:
                    break
                yield [name], [_inside(value)]
                comma = COMMA.match(text, value.end())
                if comma is None:
                    break
                at = comma.end()
        for m in DEFAULT.finditer(text):
            if (value := LITERAL.match(text, m.end())) is not None:
                yield [m["name"], *_target(text, m.start())], [_inside(value)]
    if "</" in text:
        for m in ELEMENT.finditer(text):
            yield [m["name"]], [m.span("value")]


def lexed_spans(text: str) -> list[Span]:
    """Literals that sensitive names hold, directly or through other names.

    The last assignment before a use counts, as when the text is run from top
    to bottom. A literal counts once, with its most sensitive name. Parts that are
    joined into one value are judged together, and each is a span.
    """
    worth: dict[tuple[Place, ...], float] = {}

    def note(names: list[str], places: list[Place]) -> None:
        if places:
            worth[tuple(places)] = max(worth.get(tuple(places), 0.0), max(map(sensitivity, names)))

    for names, places in _elsewhere(text):
        note(names, places)
    if "=" in text or ":" in text:
        holds: dict[str, list[Place]] = {}
        chain: list[str] = []
        at = run_end = 0
        while m := LEXED.search(text, at):
            if chain and m.start() > at:
                chain = []  # what was to follow is no assignment
            at = m.end()
            chain.append(m["name"])
            if m["chain"] is not None:
                continue
            names, chain, places = chain, [], []
            sensitive = max(map(sensitivity, names))
            if m["block"] is not None:
                places, at = _block(text, at, m.start("name"))
                for place in places[1:] if sensitive else ():
                    note(names, [place])
                places = places[:1]
            elif m["first"] is None:
                more, at = _joined(text, at, holds)
                places = [_inside(m), *more]
            else:
                inner = at < run_end
                # Every value inside a run ends where the run ends, so no run is read twice.
                if not inner:
                    found_run = RUN.match(text, at)
                    run_end = found_run.end() if found_run else at
                whole = WHOLE.match(text, at)
                if whole and whole.end() == run_end:
                    if whole[1] in holds:
                        more, end = _joined(text, run_end, holds)
                        places, run_end = [*holds[whole[1]], *more], max(run_end, end)
                    elif text[at] != "$" and text[run_end : run_end + 1] not in ("(", "["):
                        places = [(at, run_end)]
                    at = run_end
                elif sensitive or not inner:
                    places = [(at, run_end)]
                    at = run_end if sensitive else at
                if m["colon"] is not None and places == [(m.end(), run_end)] and _in_prose(text, m.start("name"), run_end):
                    places = []
            for name in names:
                if places:
                    holds[name] = places
                else:
                    holds.pop(name, None)
            note(names, places)
    found = set()
    for places, sensitive in worth.items():
        if sensitive + 0.5 < LEAST_SCORE:
            continue
        literal = "".join(text[start:end] for start, end in places)
        if len(literal) >= LEAST_LITERAL and not any(c.isspace() for c in literal) and sensitive + 0.5 * mixture(literal) >= LEAST_SCORE:
            found |= {Span(start, 3, end) for start, end in places if end > start}
    return sorted(found)


_FIELDS = [
    ("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("n_lexed", pa.int64()),
    ("base_sha256", pa.string()), ("spans", pa.string()),
]
_DDL = "doc_id long, n_assign long, n_access long, n_hex long, n_lexed long, base_sha256 string, spans string"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for value in batch.column("text"):
            text = value.as_py() or ""
            base, lexed = base_spans(text), lexed_spans(text)
            counts = Counter(s.rank for s in [*base, *lexed])
            digest = hashlib.sha256(",".join(map(str, base)).encode()).hexdigest()
            rows.append((*[counts[rank] for rank in range(len(KINDS))], digest, ",".join(map(str, sorted([*base, *lexed])))))
        columns = list(zip(*rows)) if rows else [()] * (len(_FIELDS) - 1)
        arrays = [pa.array(list(c), kind) for c, (_, kind) in zip(columns, _FIELDS[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], schema=pa.schema(_FIELDS))


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per document: counts by kind, a digest of the base spans and all spans."""
    return mapped(docs.select("doc_id", "text"), _scan, _DDL)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of the documents."""
    return secret_spans(table(spark, sf_dir, "documents"))
