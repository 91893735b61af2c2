"""Secret scans: fixed patterns, and literals that reach a sensitive name by assignment."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# The shapes every scan reports.
KINDS = ("assign", "access", "hex", "named")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYS = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
ASSIGN = re.compile(rf"(?:{_KEYS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(rf"AKIA[A-Z0-9]{{{MIN_ACCESS - 4},}}")
HEX = re.compile(rf"[0-9a-f]{{{MIN_HEX},}}")

# Words in a name that make its value sensitive, with their weight.
SENSITIVE = {
    "password": 1.0,
    "passwd": 1.0,
    "pwd": 0.9,
    "passphrase": 1.0,
    "secret": 1.0,
    "token": 0.9,
    "apikey": 1.0,
    "api_key": 1.0,
    "access_key": 1.0,
    "private_key": 1.0,
    "credential": 0.9,
    "credentials": 0.9,
    "auth": 0.7,
}
PLACEHOLDERS = re.compile(r"(?i)^(?:x+|\*+|\.+|changeme|example|placeholder|none|null|true|false|todo)$")
THRESHOLD = 0.5

# One assignment of source code or a configuration file. Names start at a word's start and every
# repetition is possessive, so a scan is linear in the text.
_NAME = r"[A-Za-z_][A-Za-z0-9_.\-]*+"
STATEMENT = re.compile(
    rf"""(?<![A-Za-z0-9_.\-])(?P<name>{_NAME})["']?[\x20\t]*+(?::=|=>|=|:)(?!=)[\x20\t]*+
    (?:"(?P<double>(?:[^"\\\n]|\\.)*+)"|'(?P<single>(?:[^'\\\n]|\\.)*+)'
    |(?P<ref>\$?\{{?{_NAME}\}}?(?=[\x20\t]*+(?:[;,\n\r)]|$)))|(?P<bare>[^\s"',;#(){{}}\[\]]++))""",
    re.VERBOSE,
)


def name_weight(name: str) -> float:
    """How sensitive a target name is: the heaviest of the words and word pairs in it."""
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name)
    parts = [p for p in re.split(r"[_.\-]+", spaced.lower()) if p]
    pairs = [a + joint + b for a, b in zip(parts, parts[1:], strict=False) for joint in ("_", "")]
    return max((SENSITIVE.get(p, 0.0) for p in [*parts, *pairs]), default=0.0)


def literal_weight(value: str) -> float:
    """How much a literal looks like a secret: long, varied, no placeholder, no sentence."""
    if len(value) < MIN_VALUE or PLACEHOLDERS.match(value) or re.search(r"\s", value):
        return 0.0
    counts = Counter(value)
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    return min(1.0, 0.4 + bits / 5)


def named_literals(text: str) -> list[tuple[int, int, float]]:
    """Literals that a sensitive name is given, directly or through other names.

    Assignments are read in order. A name given another name takes over the literal last given
    to that one (constants are propagated along any chain); ``A = "x"; password = A`` reports the
    literal "x" where it stands. The score is the name's weight times the literal's.
    """
    held: dict[str, tuple[int, int]] = {}
    found: dict[tuple[int, int], float] = {}
    for m in STATEMENT.finditer(text):
        name, ref = m["name"], m["ref"]
        if ref is not None:
            span = held.get(ref.strip("${}"))
            if span is None:  # an unknown name is a bare word
                span = m.span("ref")
        else:
            span = m.span("double" if m["double"] is not None else "single" if m["single"] is not None else "bare")
        held[name] = span
        weight = name_weight(name)
        if weight:
            score = weight * literal_weight(text[span[0] : span[1]])
            if score >= THRESHOLD:
                found[span] = max(score, found.get(span, 0.0))
    return [(a, b, s) for (a, b), s in sorted(found.items())]


def find_secrets(text: str | None) -> list[tuple[str, int, int, float]]:
    """All spans of a text as (kind, start, end, score), in code points, end exclusive.

    ``assign``, ``access`` and ``hex`` are the fixed patterns, each leftmost and non-overlapping;
    ``named`` are the literals of ``named_literals``. Ordered by start, then kind as listed.
    """
    text = text or ""
    spans = [
        ("assign", m.start(), m.end(), 1.0)
        for m in ASSIGN.finditer(text)
        if m.end(1) - m.start(1) >= MIN_VALUE
    ]
    spans += [("access", m.start(), m.end(), 1.0) for m in ACCESS.finditer(text)]
    spans += [("hex", m.start(), m.end(), 1.0) for m in HEX.finditer(text)]
    if "=" in text or ":" in text:
        spans += [("named", a, b, s) for a, b, s in named_literals(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The secrets of every whole text: ``doc_id, spans`` (kind, start, end, score).

    One row per input row, null ids and repeated rows included; null texts count as empty and
    have no spans. Each text is scanned where it lies, without a shuffle. Other columns are
    ignored.
    """
    span = pa.struct(
        [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in find_secrets(t.as_py())]
                for t in batch.column(1)
            ]
            columns = [batch.column(0), pa.array(found, type=pa.list_(span))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "spans"])

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"doc_id {kind}, spans {SPANS}")
