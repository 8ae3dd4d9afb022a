"""SimHash near-duplicates, joined by Golay-code fuzzy hashing.

A fingerprint has 64 bits, one majority vote each over the XXH64 hashes of a text's
word shingles. Two fingerprints link when at most ``max_bits`` (0 to 2) bits differ.

The 64 bits are cut into segments of 22, 21 and 21 bits, each padded with zeros to a
word of the perfect binary Golay code (23, 12, 7). By the pigeonhole principle two
errors leave one segment intact and put at most two into the next one. The balls of
radius 3 about the codewords fill the space, so every word decodes to one codeword; a
segment's keys are the codewords that it and its one-bit neighbours decode to (one to
six, in the mean 5). Two segments that differ in at most two bits have a word between
them which is at most one bit from either, so they share a key. A fingerprint's join
keys are thus (segment number, intact segment, codeword of the next segment): about
16 keys of some 34 bits.

Distinct fingerprints with equal keys are paired and verified on all 64 bits. A key
with more than ``bucket`` fingerprints is not paired off; its fingerprints go an exact
way whose output is linear: each is keyed by the 65 words of its own ball of radius 1.
Fingerprints at a distance of up to two share such a word, those sharing one are at a
distance of up to two, and a word has 65 of them at most, so each word's fingerprints
link to the smallest. (For ``max_bits`` under 2, those links are verified pairwise.)

Defined results: a null text counts as empty; texts without words have fingerprint
zero and link like any other. Repeated ids and rows are all kept and share the
component. A component's id is its smallest non-null id, null if it has none. An
empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, join_spread, landed, table
from .components import components

SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (shift, bits)
GENERATOR = 0b110001110101  # fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
SEED = 42


def fingerprint(text: str | None, words: int = 3) -> int:
    """The SimHash of a text as a signed 64-bit integer."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    width = min(words, len(tokens))
    joined, digest = b" ".join(tokens), xxhash.xxh64_intdigest
    ends = [e - 1 for e in accumulate(len(t) + 1 for t in tokens)]
    starts = [0] + [e + 1 for e in ends[:-1]]
    count, votes = len(tokens) - width + 1, np.zeros(64, np.int64)
    for at in range(0, count, 1 << 14):  # bounds the bit matrix of a very long text
        hashes = np.array([digest(joined[s:e], SEED) for s, e in
                           zip(starts[at:min(at + (1 << 14), count)], ends[at + width - 1:])], dtype=">u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > count).view(">i8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 3,
                 carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, columns of ``carry``, fp): one row per input row."""
    kept = [id_col, *carry]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField("fp", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint(t.as_py(), words) for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(made, pa.int64())],
                                             names=[*kept, "fp"])

    return df.select(*kept, text).mapInArrow(run, schema)


class Golay:
    """Nearest-codeword decoding of 23-bit words, by syndrome."""

    def __init__(self) -> None:
        high = np.arange(1 << 12, dtype=np.int64) << 11
        self.rest = high.copy()
        for bit in range(22, 10, -1):
            self.rest ^= np.where(self.rest >> bit & 1, GENERATOR << bit - 11, 0)
        self.leader = np.zeros(1 << 11, np.int64)
        ones = 1 << np.arange(23, dtype=np.int64)
        for errors in (ones, (ones[:, None] ^ ones).ravel(),
                       (ones[:, None, None] ^ ones[:, None] ^ ones).ravel()):
            heavy = errors[np.bitwise_count(errors) > np.bitwise_count(self.leader[self.syndrome(errors)])]
            fresh = heavy[self.leader[self.syndrome(heavy)] == 0]
            fresh = fresh[self.syndrome(fresh) != 0]
            self.leader[self.syndrome(fresh)] = fresh

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        return self.rest[words >> 11] ^ (words & 0x7FF)

    def decode(self, words: np.ndarray) -> np.ndarray:
        """Index (0 to 4095) of the nearest codeword."""
        return (words ^ self.leader[self.syndrome(words)]) >> 11

    def keys(self, words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, codeword index), without repeats, of each word and its one-bit
        neighbours within the lowest ``bits`` bits."""
        flips = np.concatenate([[0], 1 << np.arange(bits, dtype=np.int64)])
        found = np.sort(self.decode(words[:, None] ^ flips), axis=1)
        new = np.ones(found.shape, bool)
        new[:, 1:] = found[:, 1:] != found[:, :-1]
        row, _ = np.nonzero(new)
        return row, found[new]


_golay: list[Golay] = []


def join_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment number, key, fingerprint) of int64 fingerprints."""
    if not _golay:
        _golay.append(Golay())
    u = fps.view(np.uint64)
    part = [((u >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in SEGMENTS]
    out = []
    for i in range(3):
        j = (i + 1) % 3
        row, code = _golay[0].keys(part[j], SEGMENTS[j][1])
        out.append((np.full(len(row), i, np.int32), (i << 40) | part[i][row] << 12 | code, fps[row]))
    return tuple(np.concatenate(x) for x in zip(*out))


def links(fps: DataFrame, max_bits: int = 2, bucket: int = 32) -> DataFrame:
    """(a, b): edges between the distinct fingerprints ``fps`` (column fp) whose
    components are those of all pairs at up to ``max_bits`` differing bits."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the segments are laid out for up to two differing bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seg, key, fp = join_keys(batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(seg), pa.array(key), pa.array(fp)],
                                             names=["seg", "key", "fp"])

    keys = landed(fps.select("fp").mapInArrow(run, "seg int, key long, fp long"), "golay")
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = join_spread(keys, sizes, "key")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    few = (shared.where(F.col("n") <= bucket).groupBy("key").agg(F.sort_array(F.collect_list("fp")).alias("l"))
           .select("l", F.posexplode("l").alias("at", "a"))
           .select("a", F.explode(F.slice("l", F.col("at") + 2, F.size("l"))).alias("b")).where(near))
    hot = shared.where(F.col("n") > bucket).select("fp").distinct()
    flips = [0, *(1 << k for k in range(63)), -(1 << 63)]
    balls = (hot.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(x)) for x in flips])).alias("w"))
             .groupBy("w").agg(F.sort_array(F.collect_list("fp")).alias("l")).where(F.size("l") > 1))
    if max_bits == 2:
        many = balls.select(F.col("l")[0].alias("a"), F.explode(F.slice("l", 2, 65)).alias("b"))
    else:
        many = (balls.select("l", F.posexplode("l").alias("at", "a"))
                .select("a", F.explode(F.slice("l", F.col("at") + 2, F.size("l"))).alias("b")).where(near))
    return few.union(many).distinct()


def _rooted(df: DataFrame, id_col: str, text: str, words: int, max_bits: int, bucket: int,
            carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, columns of ``carry``, fp, component_id, _root) of every row; ``_root`` is the
    smallest fingerprint of the component, which no other component has."""
    made = landed(fingerprints(df, id_col, text, words, carry), "simhash")
    distinct = landed(made.groupBy("fp").agg(F.min(id_col).alias("rep")), "simhash-distinct")
    roots = cut(components(links(distinct, max_bits, bucket)))
    nodes = distinct.join(roots, distinct.fp == roots.node, "left") \
        .select("fp", "rep", F.coalesce("root", "fp").alias("_root"))
    smallest = nodes.groupBy("_root").agg(F.min("rep").alias("component_id"))
    classes = landed(join_spread(nodes, smallest, "_root").select("fp", "component_id", "_root"), "simhash-classes")
    return made.join(classes, "fp").select(id_col, *carry, "fp", "component_id", "_root")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 3,
                    max_bits: int = 2, bucket: int = 32) -> DataFrame:
    """(id, fp, component_id) of every row."""
    return _rooted(df, id_col, text, words, max_bits, bucket).drop("_root")


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs``, its columns in order, with one document of each component: that of the
    smallest id, and of several rows of that id, or where all ids are null, the one of the
    smallest row hash (rows that repeat it as a whole stay with it)."""
    keyed = docs.select("*", F.xxhash64(*docs.columns).alias("_row"))
    found = _rooted(keyed, "doc_id", "text", words, max_bits, 32, ("_row",))
    stays = (found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
             .groupBy("_root").agg(F.min("_row").alias("_row")).select("_row").distinct())
    return join_spread(keyed, stays, "_row", "left_semi").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: fingerprint and component of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
