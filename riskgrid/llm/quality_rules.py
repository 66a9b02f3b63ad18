"""Quality rules as a short-circuit cascade, ordered by rejection per cost as seen on a sample."""

from __future__ import annotations

import itertools
import operator
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgrid.llm.common import numbering, numbers_of, slices, stable_sample, texts

#: Documents (at most) on which costs and rejections of the rules are estimated.
SAMPLE_ROWS = 2000
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\v\f\r"
_FOLLOWING = bytes(range(0x80, 0xC0))
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Measures:
    """Measures of one text, each computed when a rule first asks for it."""

    def __init__(self, text: bytes):
        self.text = text

    @cached_property
    def words(self) -> list[bytes]:
        # bytes.split() cuts at exactly the six ASCII blanks.
        return self.text.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text.translate(None, SPACE + _FOLLOWING))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.text) - len(self.text.translate(None, SYMBOLS))

    @cached_property
    def _lines(self) -> tuple[int, int]:
        lines = [x for x in self.text.split(b"\n") if not x.isspace() and x]
        return len(lines), len(lines) - len(set(lines))

    @property
    def n_lines(self) -> int:
        return self._lines[0]

    @property
    def n_dup_lines(self) -> int:
        return self._lines[1]

    @cached_property
    def n_stutters(self) -> int:
        """Words equal to the one before."""
        return sum(map(operator.eq, self.words, itertools.islice(self.words, 1, None)))

    @cached_property
    def n_repeat_words(self) -> int:
        n = len(self.words) - WINDOW + 1
        if n < 2:
            return 0
        ids = numbers_of(self.words, numbering()).astype(np.uint64) + np.uint64(1)
        window = np.zeros(n, np.uint64)
        for k in range(WINDOW):
            window = window * _BASE + ids[k : k + n]
        _, inverse, counts = np.unique(window, return_inverse=True, return_counts=True)
        starts = counts[inverse] > 1
        if not starts.any():
            return 0
        edges = np.zeros(n + WINDOW, np.int64)
        edges[:n] += starts
        edges[WINDOW:] -= starts
        return int(np.count_nonzero(np.cumsum(edges)))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measures], bool]


RULES = (
    Rule("few_words", lambda m: m.n_words < 10),
    Rule("repeated_windows", lambda m: 100 * m.n_repeat_words > 20 * m.n_words),
    Rule("symbols", lambda m: 10 * m.n_symbols > m.n_words),
    Rule("repeated_lines", lambda m: m.n_dup_lines >= 4 and 10 * m.n_dup_lines > 3 * m.n_lines),
    Rule("word_length", lambda m: not 3 * m.n_words <= m.word_chars <= 10 * m.n_words),
    Rule("stuttering", lambda m: 10 * m.n_stutters > 3 * m.n_words),
    Rule("shouting", lambda m: 2 * m.text.count(b"!") > m.n_words),
)
BASE = ("few_words", "repeated_windows")


def sample_costs(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per rule: seconds spent and documents rejected on the sample, each rule run from scratch."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds, rejected, seen = [0.0] * len(RULES), [0] * len(RULES), 0
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                seen += 1
                for k, rule in enumerate(RULES):
                    began = time.perf_counter()
                    rejected[k] += bool(rule.rejects(Measures(text)))
                    seconds[k] += time.perf_counter() - began
        yield pa.RecordBatch.from_pydict(
            {"rule": list(range(len(RULES))), "seconds": seconds, "rejected": rejected, "seen": [seen] * len(RULES)}
        )

    sample = stable_sample(texts(docs), sample_rows, "quality rules")
    measured = sample.mapInArrow(measure, "rule long, seconds double, rejected long, seen long")
    return measured.groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected"), F.sum("seen").alias("seen"))


def cascade_order(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[int]:
    """Rule numbers, highest rejections per second first. One row per rule reaches the driver."""
    rows = sample_costs(docs, sample_rows).collect()
    rate = {r["rule"]: r["rejected"] / max(r["seconds"], 1e-9) for r in rows if r["seen"]}
    return sorted(range(len(RULES)), key=lambda k: (-rate.get(k, 0.0), k))


def passes(measures: Measures, order: list[int]) -> bool:
    return not any(RULES[k].rejects(measures) for k in order)


def assess(docs: DataFrame, order: list[int] | None = None) -> DataFrame:
    """One row per document with its measures and verdict.

    A null text counts as empty: no words, so ``few_words`` rejects it. Rows are judged alone, so repeated
    rows get equal rows and an empty table gives none; other columns of ``docs`` are ignored. The verdict does
    not depend on the order of the rules, only the time does. The measures of the base are returned for every
    document, so here the cascade saves only the rules outside it; :func:`keep` saves all of them.
    """
    order = cascade_order(docs) if order is None else order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [Measures(x) for x in batch.column("text").to_pylist()]
            kept = [passes(m, order) for m in found]
            names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
            out = {"doc_id": batch.column("doc_id")}
            out |= {name: pa.array([getattr(m, name) for m in found], pa.int64()) for name in names}
            out["base_failed"] = [any(r.rejects(m) for r in RULES if r.name in BASE) for m in found]
            out["kept"] = kept
            yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"
    return texts(docs).mapInArrow(run, schema)


def keep(docs: DataFrame, order: list[int] | None = None) -> DataFrame:
    """The documents that no rule rejects, all columns as they are; rules after the first rejection aren't run."""
    order = cascade_order(docs) if order is None else order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            good = [passes(Measures((x or "").encode()), order) for x in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
