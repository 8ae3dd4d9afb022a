"""Benchmark decontamination by q-gram lemma filtering.

Texts are compared in lower case with runs of white space as one space. A benchmark item
is cut into units of ``UNIT`` characters every ``STRIDE`` characters (the last one ends
with the item; a shorter item is one unit). A document region matches a unit of length L
if they are at an edit distance of at most ``budget(L)``, about one edit in 11 characters.

1. Rolling hashes of all q-grams of a text are looked up in the units' q-grams.
2. Each hit lies on a diagonal (place in the text minus place in the unit). Hits are
   counted by unit in diagonal bands of twice ``BAND``, which overlap by half. By the
   q-gram lemma a match with k edits leaves L - q + 1 - k q shared q-grams, on diagonals
   at most k apart, so at least one band holds that many. Other regions are dropped;
   no match is lost.
3. The bands left are verified by banded alignment: edit distance of the unit to any part
   of the text along the band, which also gives the matching span.

The benchmark comes to the tasks in blocks of about ``block_bytes`` of text, however
large it is: the documents pass through one map step for each block, without a shuffle.
Texts are worked on in pieces of bounded length that overlap by more than a match.

Defined results: null and empty texts have no hits. Null item texts, and items of under
``Q`` characters, take no part. A null item id stands in the hits as null. Repeated
documents get equal hits, repeated items each their own. Documents pass through with
all columns; one named ``hits`` is replaced. An empty benchmark or table is allowed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

Q = 9
UNIT = 80
STRIDE = 40
BAND = 16
PIECE = 1 << 20
PAIRS = 1 << 22
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
HIT = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("start", T.IntegerType()),
                    T.StructField("end", T.IntegerType()), T.StructField("edits", T.IntegerType())])


def budget(length: int) -> int:
    """Edits allowed in a unit; so few that the lemma always asks for a q-gram."""
    return min(length * 7 // UNIT, (length - Q) // Q, BAND // 2)


def normal(text: str) -> str:
    low = text.lower()
    if len(low) != len(text):  # a few letters grow in lower case; offsets must hold
        low = "".join(c.lower()[:1] for c in text)
    return " ".join(low.replace("\0", " ").split())


def offsets(text: str) -> np.ndarray:
    """Place in ``text`` of every character of ``normal(text)``."""
    out: list[np.ndarray] = []
    for m in re.finditer(r"[^\s\0\x1c-\x1f]+", text):
        if out:
            out.append(np.array([m.start() - 1]))
        out.append(np.arange(m.start(), m.end()))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def letters(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)


def hashes(c: np.ndarray) -> np.ndarray:
    """Hash of the q-gram at every place."""
    n = max(0, len(c) - Q + 1)
    wide = c.astype(np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(Q):
        h = h * MULTIPLIER + wide[j:j + n]
    return h ^ (h >> np.uint64(29))


@dataclass
class Index:
    """Units of one block of benchmark items and their q-grams."""

    items: list            # item id of each unit
    units: list            # letters of each unit
    need: np.ndarray       # shared q-grams that a match needs
    grams: np.ndarray      # sorted distinct hashes
    first: np.ndarray      # first occurrence of each, and one more
    unit_of: np.ndarray
    place_of: np.ndarray
    marks: np.ndarray      # a bit table over hash ends, to pass over most places

    @classmethod
    def of(cls, rows: list[tuple[int | None, str]]) -> "Index | None":
        items, units = [], []
        for item, text in rows:
            s = normal(text)
            if len(s) < Q:
                continue
            starts = list(range(0, max(1, len(s) - UNIT + 1), STRIDE))
            if starts[-1] + UNIT < len(s):
                starts.append(len(s) - UNIT)
            for a in starts:
                items.append(item)
                units.append(letters(s[a:a + UNIT]))
        if not units:
            return None
        made = [hashes(u) for u in units]
        every = np.concatenate(made)
        order = np.argsort(every, kind="stable")
        grams, first = np.unique(every[order], return_index=True)
        unit_of = np.repeat(np.arange(len(units)), [len(m) for m in made])[order]
        place_of = np.concatenate([np.arange(len(m)) for m in made])[order]
        marks = np.zeros(1 << 20, bool)
        marks[(grams & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        need = np.array([len(u) - Q + 1 - budget(len(u)) * Q for u in units])
        return cls(items, units, need, grams, np.append(first, len(every)), unit_of, place_of, marks)

    @property
    def overlap(self) -> int:
        return UNIT + 4 * BAND + Q

    def search(self, c: np.ndarray, base: int = 0) -> Iterator[tuple[int, int, int, int]]:
        """(unit, start, end, edits) of the matches in the letters ``c``."""
        h = hashes(c)
        at = np.flatnonzero(self.marks[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
        gram = np.minimum(np.searchsorted(self.grams, h[at]), len(self.grams) - 1)
        same = self.grams[gram] == h[at]
        at, gram = at[same], gram[same]
        many = self.first[gram + 1] - self.first[gram]
        if many.sum() > PAIRS and len(c) > 4 * self.overlap:
            half = len(c) // 2
            yield from self.search(c[:half + self.overlap], base)
            yield from self.search(c[half - self.overlap:], base + half - self.overlap)
            return
        ends = np.cumsum(many)
        occurrence = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[gram] - ends + many, many)
        unit = self.unit_of[occurrence]
        # diagonals from 2 * UNIT up, so that band numbers are positive
        band = (np.repeat(at, many) - self.place_of[occurrence] + 2 * UNIT) // BAND
        width = (len(c) + 4 * UNIT) // BAND + 2
        keys, counts = np.unique(np.concatenate([unit * width + band, unit * width + band - 1]), return_counts=True)
        unit, band = keys // width, keys % width
        keep = counts >= self.need[unit]
        yield from self.align(c, unit[keep], band[keep] * BAND - 2 * UNIT, base)

    def align(self, c: np.ndarray, unit: np.ndarray, diagonal: np.ndarray, base: int,
              block: int = 2048) -> Iterator[tuple[int, int, int, int]]:
        """Banded semi-global alignment of the units along bands that begin at
        ``diagonal``; many candidates at a time, by unit length."""
        lengths = np.array([len(self.units[u]) for u in unit])
        for size in np.unique(lengths):
            chosen = np.flatnonzero(lengths == size)
            k, padded = budget(int(size)), np.concatenate([
                np.zeros(4 * UNIT, np.uint32), c, np.zeros(4 * UNIT + 4 * BAND, np.uint32)])
            span = 2 * BAND + 2 * k + 1
            for s in range(0, len(chosen), block):
                these = chosen[s:s + block]
                u = np.stack([self.units[x] for x in unit[these]])
                zero = diagonal[these] - k  # text place of letter 0 on the first diagonal
                step = np.arange(span)
                cost = np.zeros((len(these), span), np.int32)
                start = np.broadcast_to(zero[:, None] + step, cost.shape).copy()
                for i in range(size):
                    text = padded[np.clip(zero[:, None] + i + step + 4 * UNIT, 0, len(padded) - 1)]
                    best = cost + (text != u[:, i:i + 1])
                    left_out = np.full_like(cost, 1 << 20)
                    left_out[:, :-1] = cost[:, 1:] + 1
                    from_start = start.copy()
                    better = left_out < best
                    from_start[:, :-1] = np.where(better[:, :-1], start[:, 1:], start[:, :-1])
                    best = np.minimum(best, left_out)
                    # letters put in: a running minimum along the band
                    lead = best - step
                    run = np.minimum.accumulate(lead, axis=1)
                    source = np.maximum.accumulate(np.where(lead == run, step, -1), axis=1)
                    cost = run + step
                    start = np.take_along_axis(from_start, source, axis=1)
                end = cost.argmin(axis=1)
                row = np.arange(len(these))
                for r in np.flatnonzero(cost[row, end] <= k):
                    a = max(0, int(start[r, end[r]]))
                    b = min(len(c), int(zero[r] + size + end[r]))
                    yield int(unit[these[r]]), base + a, base + b, int(cost[r, end[r]])

    def hits(self, texts: list[str | None]) -> list[list[tuple]]:
        """For each text, (item id, start, end, edits) in its own characters."""
        out: list[list[tuple]] = [[] for _ in texts]
        gap = "\0" * (BAND + 1)  # more letters than a match can skip
        held, size = [], 0

        def flush() -> None:
            nonlocal held, size
            starts = np.cumsum([0] + [len(s) + len(gap) for _, s, _ in held])
            found: dict[int, set] = {}
            for unit, a, b, edits in self.search(letters(gap.join(s for _, s, _ in held))):
                w = int(np.searchsorted(starts, a, side="right")) - 1
                if a >= starts[w] + len(held[w][1]):  # begins in the gap before the next text
                    w, a = w + 1, int(starts[w + 1])
                doc, s, at = held[w]
                a, b = a - int(starts[w]) + at, min(b - int(starts[w]), len(s)) + at
                if b > a:
                    found.setdefault(doc, set()).add((unit, a, b, edits))
            for doc, spans in found.items():
                place = offsets(texts[doc])
                out[doc] += [(self.items[u], int(place[a]), int(place[b - 1]) + 1, e) for u, a, b, e in spans]
            held, size = [], 0

        for i, t in enumerate(texts):
            s = normal(t or "")
            for a in range(0, max(1, len(s) - self.overlap), PIECE):
                held.append((i, s[a:a + PIECE + self.overlap], a))
                size += len(held[-1][1])
                if size >= PIECE:
                    flush()
        if held:
            flush()
        return [sorted(set(x), key=lambda h: (h[1], h[2], h[0] is None, h[0] or 0)) for x in out]


def _step(df: DataFrame, text: str, rows: list[tuple[int | None, str]]) -> DataFrame:
    """Append the hits of one block of items to the column ``hits``."""
    kept = [c for c in df.columns if c != "hits"]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField("hits", T.ArrayType(HIT))])
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()),
                               ("edits", pa.int32())]))
    names = HIT.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index.of(rows)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = index.hits(part.column(text).to_pylist()) if index else [[]] * part.num_rows
                old = part.column("hits").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept]
                    + [pa.array([o + [dict(zip(names, h)) for h in f] for o, f in zip(old, found)], kind)],
                    names=kept + ["hits"])

    return df.select(*kept, "hits").mapInArrow(run, schema)


def find_passages(df: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", block_bytes: int = 2 << 20) -> DataFrame:
    """``df`` with ``hits``: array of (item_id, start, end, edits), one for each benchmark
    unit found, spans in characters of the text, in their order."""
    items = benchmark.where(F.col(item_text).isNotNull()).select(
        F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t"))
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = int(total // block_bytes) + 1
    out = df.select(*[c for c in df.columns if c != "hits"], F.array().cast(T.ArrayType(HIT)).alias("hits"))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).collect()
        out = _step(out, text, sorted(((r.i, r.t) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1])))
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: the benchmark items found in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_passages(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.size("hits").cast("long").alias("n_hits"),
                        F.array_sort(F.array_distinct("hits.item_id")).alias("item_ids"),
                        (F.size("hits") > 0).cast("int").alias("contaminated"))
