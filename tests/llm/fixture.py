"""Small documents with every odd case, and helpers shared by the tests."""

from __future__ import annotations

import random
import zlib

import pyarrow.parquet as pq
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(n: int = 120) -> list[tuple[int | None, str | None]]:
    rows = pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    out = [(r["doc_id"], r["text"]) for r in rows[:n]]
    rng = random.Random(5)
    base = out[3][1].split()
    near = base[:]
    near[len(near) // 2] = "changed"
    odd = [
        None,
        "",
        " \t\n ",
        "one",
        "Four words are here",
        "five words are right here",
        "FIVE words are right here",
        "x " * 3000,
        " non breaking   İ café \U0001f600 é",
        "a\x1cb\x85c <|endoftext|> It's 12,345!",
        " ".join(base),
        " ".join(near),
        " ".join(base[:-1]),
        " ".join(rng.choice(base) for _ in range(4000)),
    ]
    out += [(10_000 + k, t) for k, t in enumerate(odd)]
    out += [out[5], out[5], (None, out[6][1]), (None, None), (20_000, out[7][1]), (20_001, out[7][1])]
    return out


def frame(spark, rows, clashing: bool = True):
    """The rows as documents; with further columns named like those that operators make."""
    df = spark.createDataFrame([(i, t, "en", "src", None if t is None else len(t)) for i, t in rows], SCHEMA).repartition(3)
    if clashing:
        for name in ("node", "block", "training", "held_out", "kept", "rank", "length", "label", "unit", "n", "spans", "g", "score"):
            df = df.withColumn(name, F.lit("clash"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def remainder(doc_id, modulus):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % modulus


def words(text):
    return (text or "").encode().split()


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=repr)
