"""Secret scans: fixed patterns, and sliding-window entropy per character class."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from riskgrid.llm.common import sha256, slices, spans_text, texts

ASSIGN = re.compile(
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: Without one of these, lower-cased, a text holds no assignment.
ASSIGN_HINTS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Character class: its runs, the window in characters, and the bits a character that a window must reach.
CLASSES = {
    "entropy_hex": (re.compile(r"[0-9a-f]{24,}|[0-9A-F]{24,}"), 24, 2.9),
    "entropy_alnum": (re.compile(r"[A-Za-z0-9]{20,}"), 20, 3.6),
    "entropy_base64": (re.compile(r"[A-Za-z0-9+/=_-]{24,}"), 24, 3.8),
}
SHORTEST = 20
#: Candidates that match one of these whole are no secrets.
ALLOWED = (
    re.compile(r"[0-9]+"),  # numbers
    re.compile(r"[^0-9]+"),  # words, also joined ones
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),  # identifiers
    re.compile(r"(?i:sha(1|256|384|512)[-_=].*)"),  # digests named as such
    re.compile(r"(?i:.*example.*)"),
    re.compile(r"[A-Za-z]*[0-9]{0,4}([-_/][A-Za-z]*[0-9]{0,4})*"),  # names and paths with short numbers
)
_C_LOG = [0.0] + [c * math.log2(c) for c in range(1, 65)]


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    return {
        "assign": [m.span() for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8],
        "access": [m.span() for m in ACCESS.finditer(text) if m.end() - m.start() >= 16],
        "hex": [m.span() for m in HEX.finditer(text) if m.end() - m.start() >= 32],
    }


def dense_parts(run: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Unions of the windows of ``run`` whose Shannon entropy reaches ``bits``; counts move with the window."""
    counts: dict[str, int] = {}
    total = 0.0  # sum of c * log2(c)
    parts: list[list[int]] = []
    for end, char in enumerate(run, 1):
        c = counts.get(char, 0)
        total += _C_LOG[c + 1] - _C_LOG[c]
        counts[char] = c + 1
        if end > window:
            old = run[end - window - 1]
            c = counts[old]
            total += _C_LOG[c - 1] - _C_LOG[c]
            counts[old] = c - 1
        if end >= window and math.log2(window) - total / window >= bits:
            if parts and end - window <= parts[-1][1]:
                parts[-1][1] = end
            else:
                parts.append([end - window, end])
    return [(a, b) for a, b in parts]


def entropy_spans(text: str, taken: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """Dense parts of candidate runs that no allow-list entry covers and no span of ``taken`` or an earlier class meets."""
    found, taken = [], list(taken)
    for kind, (pattern, window, bits) in CLASSES.items():
        for m in pattern.finditer(text):
            if any(allowed.fullmatch(m[0]) for allowed in ALLOWED):
                continue
            for a, b in dense_parts(m[0], window, bits):
                start, end = m.start() + a, m.start() + b
                if not any(s < end and start < e for s, e in taken):
                    found.append((kind, start, end))
                    taken.append((start, end))
    return found


def scan(text: bytes) -> tuple[dict[str, list[tuple[int, int]]], list[tuple[str, int, int]]]:
    """Base spans by kind, and the method's spans, in code points."""
    none = {"assign": [], "access": [], "hex": []}
    lower = text.lower()
    if max(map(len, text.split()), default=0) < 16 and not any(x in lower for x in ASSIGN_HINTS):
        return none, []
    decoded = text.decode("utf-8", "replace")
    base = base_spans(decoded)
    return base, entropy_spans(decoded, [x for spans in base.values() for x in spans])


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per document with counts of the base kinds and all spans.

    A null or empty text has no spans (digest of the empty string). Rows are scanned alone: repeated rows get equal
    rows, an empty table gives none, other columns are ignored. Two spans with one start come in the order of the kinds.
    """
    order = {kind: k for k, kind in enumerate(("assign", "access", "hex", *CLASSES))}
    by_start = lambda x: (x[1], order[x[0]], x[2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
            for text in batch.column("text").to_pylist():
                base, more = scan(text)
                fixed = sorted(((k, a, b) for k, spans in base.items() for a, b in spans), key=by_start)
                for k in ("assign", "access", "hex"):
                    columns[f"n_{k}"].append(len(base[k]))
                columns["base_sha256"].append(sha256(spans_text(fixed)))
                columns["spans"].append(spans_text(sorted(fixed + more, key=by_start)))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id")} | columns)

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return texts(docs).mapInArrow(run, schema)
