"""Secret scans: three fixed patterns, and an assignment-aware lexer for source and configuration text.

The lexer reads name-literal pairs (`name = "literal"`, `name: literal`, `"name": "literal"`, `name => 'literal'`,
`name: type = "literal"`), resolves names that are
assigned from other names until nothing changes, and scores every literal by the terms of the names that it reaches and by its own
make-up. Names and literals have any length and may hold escapes. Literals with a score of at least 1.5 are added as kind `literal`; pattern matches always stay.

Positions are code points of the whole text, ends exclusive. Null and empty texts have no spans; ties at one start are ordered by kind.
Repeated rows give equal rows. An empty table gives an empty result; extra columns play no part.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("assign", "access", "hex", "literal")
MASK = "[SECRET]"


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The patterns of the three base kinds and the least lengths of a match.
_ASSIGN = re.compile(
    "(" + "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key")) + r")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_LEAST = {"assign": 8, "access": 16, "hex": 32}
_ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: What a target name says about its literal: weights of the terms in it.
TERMS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.6, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 1.0, "credentials": 1.0, "cred": 0.7, "auth": 0.6, "key": 0.5, "private": 0.5, "access": 0.3, "signing": 0.5, "client": 0.2, "api": 0.4, "bearer": 0.8,
}
#: Every sensitive name holds one of these: the terms that contain no other.
_TERM_HINTS = tuple(t for t in TERMS if not any(o in t for o in TERMS if o != t))
def _nested(opening: str, closing: str, depth: int = 3) -> str:
    own = "[^" + re.escape(opening + closing) + r"\n=]"
    inner = f"|{_nested(opening, closing, depth - 1)}" if depth > 1 else ""
    return re.escape(opening) + f"(?:{own}++{inner})*+" + re.escape(closing)


#: A declared type between a name and its "=": dotted words, bracketed arguments, unions, references.
_ATOM = rf"(?:&(?:'\w++[ \t]++)?+)?+[A-Za-z_$][\w.$]*+(?:{_nested('[', ']')}|{_nested('<', '>')})*+"
_TYPED = rf"[?!]?+:[ \t]*+{_ATOM}(?:[ \t]*+\|[ \t]*+{_ATOM})*+[ \t]*+=(?![=>])"
_PAIR = re.compile(
    r"""(?<![\w.$-])(?P<q>["']?)(?P<name>[A-Za-z_$][\w.$-]*+)(?P=q)[ \t]*+(?:"""
    + _TYPED
    + r"""|:=|=>|=(?!=)|:(?!:))[ \t]*+"""
    r"""(?:"(?P<double>(?:[^"\\\n]++|\\.)++)"|'(?P<single>(?:[^'\\\n]++|\\.)++)'|(?P<bare>[^\s"',;{}()\[\]]++))"""
)
_NAME = re.compile(r"[A-Za-z_$][\w.$-]*\Z")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def _name_weight(name: str) -> float:
    return min(1.0, sum(TERMS.get(p.lower(), 0.0) for p in _PART.findall(name)))


def _bits(literal: str) -> float:
    n = len(literal)
    return -sum(c / n * math.log2(c / n) for c in Counter(literal).values())


def _literal_weight(literal: str) -> float:
    """0 to 1: long literals of many kinds of characters look like keys, words and numbers don't."""
    if len(literal) < 8 or any(c.isspace() for c in literal) or not literal.isascii():
        return 0.0
    kinds = sum(any(f(c) for c in literal) for f in (str.isdigit, str.isupper, str.islower))
    return min(1.0, _bits(literal) / 4) * (0.4 + 0.2 * kinds)


def _lexed(text: str) -> Iterator[tuple[int, int]]:
    """Spans of literals that a sensitive name is assigned, directly or through other names."""
    literals: dict[str, list[tuple[int, int]]] = {}
    aliases: list[tuple[str, str]] = []
    for m in _PAIR.finditer(text):
        kind = m.lastgroup
        value = m[kind]
        if kind == "bare" and _NAME.match(value) and not any(c.isdigit() for c in value):
            aliases.append((m["name"], value))
        if kind != "bare" or len(value) >= 8:
            literals.setdefault(m["name"], []).append(m.span(kind))
    if not literals:
        return
    weight: dict[str, float] = {name: _name_weight(name) for name in literals}
    for name, value in aliases:
        weight.setdefault(name, _name_weight(name))
        weight.setdefault(value, _name_weight(value))
    moved = True
    while moved:  # a constant is as sensitive as the names it is assigned to
        moved = False
        for name, value in aliases:
            if weight[name] > weight[value]:
                weight[value], moved = weight[name], True
    for name, spans in literals.items():
        if weight[name] > 0:
            for start, end in spans:
                if weight[name] + _literal_weight(text[start:end]) >= 1.5:
                    yield start, end


def scan(text: str) -> list[tuple[int, int, int, int, int]]:
    """(start, kind number, end, start of the secret, end of the secret), sorted."""
    found = []
    small = text.lower()
    if any(h in small for h in _ASSIGN_HINTS):
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= _LEAST["assign"]:
                found.append((m.start(), 0, m.end(), m.start(2), m.end(2)))
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= _LEAST["access"]:
                found.append((m.start(), 1, m.end(), m.start(), m.end()))
    for m in _HEX.finditer(text):
        found.append((m.start(), 2, m.end(), m.start(), m.end()))
    if (":" in text or "=" in text) and any(h in small for h in _TERM_HINTS):
        for start, end in sorted(set(_lexed(text))):
            found.append((start, 3, end, start, end))
    return sorted(found)


def redacted(text: str) -> str:
    """`text` with every maximal run of secret characters as one mask."""
    runs: list[list[int]] = []
    for start, end in sorted((s[3], s[4]) for s in scan(text)):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    out, at = [], 0
    for start, end in runs:
        out += [text[at:start], MASK]
        at = end
    return "".join([*out, text[at:]])


def _joined(spans: list[tuple[int, int, int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{start}:{end}" for start, k, end, _, _ in spans)


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: list[list[int]] = [[], [], [], []]
        base, spans = [], []
        for text in batch.column(1):
            found = scan(text.as_py() or "")
            tally = Counter(s[1] for s in found)
            for k, column in enumerate(counts):
                column.append(tally[k])
            base.append(hashlib.sha256(_joined([s for s in found if s[1] < 3]).encode()).hexdigest())
            spans.append(_joined(found))
        yield pa.record_batch(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(base), pa.array(spans)],
            ["doc_id", "n_assign", "n_access", "n_hex", "n_literal", "base_sha256", "spans"],
        )


def report(documents: DataFrame) -> DataFrame:
    """One row per document: counts by kind, a digest of the base spans, and all spans."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_report, "doc_id long, n_assign long, n_access long, n_hex long, n_literal long, base_sha256 string, spans string")


def redact(documents: DataFrame) -> DataFrame:
    """All rows and columns of `documents`, the secrets in `text` masked (and `n_chars` counted anew)."""
    names = documents.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else redacted(t) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.column(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    out = documents.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType) for f in documents.schema]))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.char_length("text").cast(documents.schema["n_chars"].dataType))
    return out
