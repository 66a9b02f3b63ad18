"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskgrid.llm.common import sha256, slices, spans_text, stable_sample, texts
from riskgrid.session import stage

KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TAGS = ("other", *KINDS)

#: The labelled table comes from at most so many documents, and excerpts without a span from so many of them.
TRAIN_DOCS, PLAIN_DOCS = 4000, 400
#: Characters around a labelled span, and at the start of a document without any, that become training words.
CONTEXT = 100
#: Words in a sequence: a line is cut after so many.
SEQUENCE = 64
EPOCHS = 80
PENALTY = 1e-4
#: Words remembered per Python worker.
CACHE_WORDS = 400_000

WORD = re.compile(r"[^\x20\x09-\x0D]+|\n")


def digits_of(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def luhn(digits: list[int]) -> bool:
    doubled = [(2 * d - 9 if d > 4 else 2 * d) for d in digits[-2::-2]]
    return (sum(doubled) + sum(digits[::-2])) % 10 == 0


def is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in text.split("."))


def is_card(text: str) -> bool:
    return 16 <= len(d := digits_of(text)) <= 19 and luhn(d)


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Leftmost non-overlapping matches of each kind, without those that fail its test."""
    return {
        "email": [m.span() for m in EMAIL.finditer(text)] if "@" in text else [],
        "ip": [m.span() for m in IP.finditer(text) if is_ip(m[0])],
        "card": [m.span() for m in CARD.finditer(text) if is_card(m[0])],
        "phone": [m.span() for m in PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15] if "+" in text else [],
    }


def shape_class(word: str) -> str:
    """A coarse class: letters become x, digits 9, runs are joined, marks at the end left out; one class for all with @."""
    if "@" in word:
        return "@"
    word = word.rstrip(".,;:!?") or word
    shape = re.sub(r"(.)\1+", r"\1", "".join("9" if "0" <= c <= "9" else "x" if c.isalpha() else c for c in word[:40]))
    return shape if len(shape) <= 6 else shape[:6] + "~"


def features(word: str) -> tuple[str, ...]:
    """What the model sees of a word: shapes and lengths, never the word itself."""
    coarse = shape_class(word)
    digits = digits_of(word)
    found = [f"shape={coarse}", f"length={min(len(word), 24) // 3}", f"digits={min(len(digits), 20)}"]
    if "@" in word:
        found.append("at")
    if len(digits) >= 16 and luhn(digits):
        found.append("luhn")
    if word.count(".") == 3 and len(digits) >= 4:
        parts = word.strip(".,;:()").split(".")
        found.append("quad" if len(parts) == 4 and all(p.isdigit() and p.isascii() and int(p[-9:]) < 256 for p in parts) else "dots")
    if word[0] in "+(":
        found.append("open=" + word[0])
    if digits and len(digits) == len(word):
        found.append("number")
    return tuple(found)


@dataclass
class Model:
    own: dict[str, np.ndarray]  # feature of the word: a weight for each tag
    before: dict[str, np.ndarray]  # class of the word before
    after: dict[str, np.ndarray]
    steps: np.ndarray  # tag to tag


def sequences(text: str) -> list[list[tuple[str, int, int]]]:
    """Words with their places, by line, at most ``SEQUENCE`` of them in one."""
    out, line = [], []
    for m in WORD.finditer(text):
        if m[0] == "\n" or len(line) == SEQUENCE:
            if line:
                out.append(line)
            line = []
        if m[0] != "\n":
            line.append((m[0], m.start(), m.end()))
    return [*out, line] if line else out


def labelled(docs: DataFrame, rows: int = TRAIN_DOCS, plain: int = PLAIN_DOCS) -> DataFrame:
    """The labelled table: (text, spans) of excerpts, from at most ``rows`` documents in digest order.

    Excerpts are the surroundings of base spans, at most 8 a document, and the starts of ``plain`` documents without any.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: dict[str, list] = {"doc_id": [], "text": [], "start": [], "end": [], "tag": []}
            for doc, data in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                text = data.decode("utf-8", "replace")
                spans = [(k, a, b) for k, found in base_spans(text).items() for a, b in found]
                for kind, a, b in spans[:8] or [("other", 0, 0)]:
                    low, high = max(0, a - CONTEXT), b + CONTEXT
                    for key, value in zip(out, (doc, text[low:high], a - low, b - low, kind)):
                        out[key].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("tag", pa.string())]))

    sample = stable_sample(docs.select("doc_id", "text"), rows, "labelled")
    found = stage(texts(sample).mapInArrow(run, "doc_id long, text string, start long, end long, tag string"), "labelled")
    return found.where("tag != 'other'").unionAll(found.where("tag = 'other'").orderBy("doc_id").limit(plain))


def train(docs: DataFrame, rows: int = TRAIN_DOCS, plain: int = PLAIN_DOCS) -> Model:
    """A model from the labelled table of ``docs``; without any rows it tags nothing. The bounded table is read by the driver."""
    examples = []
    for row in labelled(docs, rows, plain).orderBy("doc_id", "start", "tag").collect():
        spans = [(k, a, b) for k, found in base_spans(row["text"]).items() for a, b in found]
        for line in sequences(row["text"]):
            tags = [next((TAGS.index(k) for k, a, b in spans if a < e and s < b), 0) for _, s, e in line]
            examples.append(([w for w, _, _ in line], tags))
    return fit(examples)


def fit(examples: list[tuple[list[str], list[int]]], epochs: int = EPOCHS) -> Model:
    """Weights by gradient ascent (Adam) on the penalised likelihood; forward-backward over all sequences at once."""
    n_tags = len(TAGS)
    if not examples:
        return Model({}, {}, {}, np.zeros((n_tags, n_tags)))
    names: dict[str, int] = {}
    width = max(len(words) for words, _ in examples)
    rows, columns = [], []
    gold = np.zeros((len(examples), width), np.int64)
    mask = np.zeros((len(examples), width), bool)
    for i, (words, tags) in enumerate(examples):
        classes = ["<", *map(shape_class, words), ">"]
        gold[i, : len(tags)], mask[i, : len(tags)] = tags, True
        for j, word in enumerate(words):
            for name in (*features(word), "before:" + classes[j], "after:" + classes[j + 2]):
                rows.append(i * width + j)
                columns.append(names.setdefault(name, len(names)))
    rows, columns = np.array(rows), np.array(columns)
    order = np.argsort(columns, kind="stable")
    n, t = len(examples), n_tags
    weights = np.zeros((len(names) + t, t))
    moment, square = np.zeros_like(weights), np.zeros_like(weights)
    cells = n * width
    row_starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    col_sorted, row_sorted = columns[order], rows[order]
    col_starts = np.flatnonzero(np.r_[True, col_sorted[1:] != col_sorted[:-1]])
    onehot = np.eye(t)[gold] * mask[..., None]
    both = mask[:, 1:] & mask[:, :-1]
    pair_gold = np.einsum("nwi,nwj->ij", onehot[:, :-1] * both[..., None], onehot[:, 1:])
    for epoch in range(1, epochs + 1):
        step = weights[len(names) :]
        emit = np.zeros((cells, t))
        emit[rows[row_starts]] = np.add.reduceat(weights[columns], row_starts, axis=0)
        emit = emit.reshape(n, width, t)
        forward = np.zeros((n, width, t))
        backward = np.zeros((n, width, t))
        forward[:, 0] = emit[:, 0]
        for j in range(1, width):
            moved = np.logaddexp.reduce(forward[:, j - 1, :, None] + step, axis=1) + emit[:, j]
            forward[:, j] = np.where(mask[:, j, None], moved, forward[:, j - 1])
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        for j in range(width - 2, -1, -1):
            moved = np.logaddexp.reduce(step + (emit[:, j + 1] + backward[:, j + 1])[:, None, :], axis=2)
            backward[:, j] = np.where(mask[:, j + 1, None], moved, 0)
        share = np.exp(forward + backward - total[:, None, None]) * mask[..., None]
        gradient = np.zeros_like(weights)
        gradient[col_sorted[col_starts]] = np.add.reduceat((onehot - share).reshape(cells, t)[row_sorted], col_starts, axis=0)
        pair = np.exp(forward[:, :-1, :, None] + step + (emit + backward)[:, 1:, None, :] - total[:, None, None, None])
        gradient[len(names) :] = pair_gold - (pair * both[..., None, None]).sum((0, 1))
        gradient = gradient / n - PENALTY * weights
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        weights += 0.15 * (moment / (1 - 0.9**epoch)) / (np.sqrt(square / (1 - 0.99**epoch)) + 1e-8)
    pick = lambda head: {k[len(head) :]: weights[v] for k, v in names.items() if k.startswith(head)}
    own = {k: weights[v] for k, v in names.items() if not k.startswith(("before:", "after:"))}
    return Model(own, pick("before:"), pick("after:"), weights[len(names) :].copy())


def viterbi(emit: np.ndarray, lengths: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Best tags of padded sequences, all at once: emit is (sequences, words, tags). Ties go to the earlier tag."""
    n, width, _ = emit.shape
    best = emit[:, 0].copy()
    back = np.zeros(emit.shape, np.int8)
    at_end = best.copy()
    for j in range(1, width):
        through = best[:, :, None] + steps
        back[:, j] = through.argmax(axis=1)
        best = through.max(axis=1) + emit[:, j]
        at_end = np.where((lengths > j)[:, None], best, at_end)
    tags = np.zeros((n, width), np.int64)
    row = np.arange(n)
    tag = at_end.argmax(axis=1)
    for j in range(width - 1, -1, -1):
        inside = lengths > j
        tags[:, j] = np.where(inside, tag, 0)
        tag = np.where(inside & (j > 0), back[row, j, tag], tag)
    return tags


class Tagger:
    """Tags batches of texts; remembers each word's weights and class."""

    def __init__(self, model: Model):
        self.model = model
        zero = np.zeros(len(TAGS))
        self.classes = {c: k for k, c in enumerate(dict.fromkeys(["", *model.before, *model.after]))}
        self.before = np.array([model.before.get(c, zero) for c in self.classes], np.float32)
        self.after = np.array([model.after.get(c, zero) for c in self.classes], np.float32)
        self.clear()

    def clear(self) -> None:
        self.words: dict[bytes, int] = {}
        self.own: dict[tuple, int] = {}
        self.rows: list[np.ndarray] = []
        self.row_class: list[int] = []

    def number(self, word: bytes) -> int:
        """The row (weights and class) of a word: words of one shape share it."""
        text = word.decode("utf-8", "replace")
        coarse = shape_class(text)
        key = (features(text), coarse)
        if key not in self.own:
            self.own[key] = len(self.rows)
            self.rows.append(sum((self.model.own.get(f, 0.0) for f in key[0]), np.zeros(len(TAGS))))
            self.row_class.append(self.classes.get(coarse, 0))
        if len(self.words) >= CACHE_WORDS:
            self.words.clear()
        self.words[word] = self.own[key]
        return self.own[key]

    def tag(self, lines: list[list[bytes]]) -> list[np.ndarray]:
        """Tags of each sequence of at most ``SEQUENCE`` words."""
        get, number = self.words.get, self.number
        flat = [k if (k := get(w)) is not None else number(w) for line in lines for w in line]
        lengths = np.fromiter(map(len, lines), np.int64, len(lines))
        total = len(flat)
        if not total:
            return [np.zeros(0, np.int64) for _ in lines]
        ids = np.array(flat, np.int64)
        kinds = np.array(self.row_class, np.int64)[ids]
        ends = np.cumsum(lengths)
        starts = ends - lengths
        filled = lengths > 0
        previous = np.r_[0, kinds[:-1]]
        following = np.r_[kinds[1:], 0]
        previous[starts[filled]] = self.classes.get("<", 0)
        following[ends[filled] - 1] = self.classes.get(">", 0)
        emit = np.array(self.rows, np.float32)[ids] + self.before[previous] + self.after[following]
        tags = np.zeros(total, np.int64)
        steps = self.model.steps.astype(np.float32)
        order = np.argsort(lengths, kind="stable")
        for part in np.array_split(order, max(1, len(order) // 4096)):
            part = part[lengths[part] > 0]
            if not len(part):
                continue
            width = int(lengths[part].max())
            cell = starts[part][:, None] + np.arange(width)
            inside = np.arange(width) < lengths[part][:, None]
            cell = np.where(inside, cell, 0)
            got = viterbi(emit[cell], lengths[part], steps)
            tags[cell[inside]] = got[inside]
        return np.split(tags, ends[:-1])

    def spans(self, data: list[bytes]) -> list[list[tuple[str, int, int]]]:
        """For each text the tagged runs, in code points."""
        lines, owner, order_in_doc = [], [], []
        for d, text in enumerate(data):
            k = 0
            for line in text.split(b"\n"):
                words = line.split()
                for i in range(0, len(words), SEQUENCE):
                    lines.append(words[i : i + SEQUENCE])
                    owner.append(d)
                    order_in_doc.append(k)
                    k += 1
        found: list[list[tuple[str, int, int]]] = [[] for _ in data]
        hits: dict[int, dict[int, np.ndarray]] = {}
        for d, k, tags in zip(owner, order_in_doc, self.tag(lines)):
            if tags.any():
                hits.setdefault(d, {})[k] = tags
        for d, tagged in hits.items():
            for k, line in enumerate(sequences(data[d].decode("utf-8", "replace"))):
                if k in tagged:
                    last = 0
                    for tag, (_, a, b) in zip(tagged[k].tolist(), line):
                        if tag and tag == last:
                            found[d][-1] = (TAGS[tag], found[d][-1][1], b)
                        elif tag:
                            found[d].append((TAGS[tag], a, b))
                        last = tag
        return found


def all_spans(data: list[bytes], tagger: Tagger) -> list[tuple[list, list]]:
    """Base spans and the method's own (those that meet no base span), by kind, then start."""
    out = []
    order = {k: i for i, k in enumerate(KINDS)}
    for raw, tagged in zip(data, tagger.spans(data)):
        base = []
        if re.search(rb"[0-9@]", raw):
            base = [(k, a, b) for k, spans in base_spans(raw.decode("utf-8", "replace")).items() for a, b in spans]
        more = [x for x in tagged if not any(a < x[2] and x[1] < b for _, a, b in base)]
        key = lambda x: (order[x[0]], x[1], x[2])
        out.append((sorted(base, key=key), sorted(more, key=key)))
    return out


def find_pii(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document with counts of the base kinds and all spans.

    A null or empty text has no spans. Rows are tagged alone: repeated rows get equal rows, an empty table gives none,
    other columns are ignored. Spans are sorted by kind, then start; the model's are added where no base span is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        for batch in slices(batches):
            columns: dict[str, list] = {k: [] for k in (*(f"n_{k}" for k in KINDS), "base_sha256", "spans")}
            for base, more in all_spans(batch.column("text").to_pylist(), tagger):
                for k in KINDS:
                    columns[f"n_{k}"].append(sum(x[0] == k for x in base))
                columns["base_sha256"].append(sha256(spans_text(base)))
                columns["spans"].append(spans_text(sorted(base + more, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id")} | columns)

    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    return texts(docs).mapInArrow(run, schema)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each span replaced by its kind in brackets; of overlapping spans the first start wins and the rest of the other goes too."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda x: (x[1], -x[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def mask_pii(docs: DataFrame, model: Model) -> DataFrame:
    """All rows and columns of ``docs``, with personal data in ``text`` replaced and ``n_chars`` (if there) counted anew.

    A null text stays null, and its ``n_chars`` stays as it is.
    """
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        for batch in slices(batches):
            was = batch.column("text").to_pylist()
            data = [(x or "").encode() for x in was]
            new = [x if x is None else masked(x, base + more) if base or more else x for x, (base, more) in zip(was, all_spans(data, tagger))]
            arrays = {name: batch.column(name) for name in names}
            arrays["text"] = pa.array(new, batch.schema.field("text").type)
            if "n_chars" in arrays:
                counted = batch.column("n_chars").to_pylist()
                lengths = [n if x is None else len(x) for n, x in zip(counted, new)]
                arrays["n_chars"] = pa.array(lengths, batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays([arrays[name] for name in names], schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
