"""Removal of repeated byte strings by suffix arrays of shards.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier: in a
document of smaller id, or earlier in the same one. Strings are judged on the input.

1. Shards. Documents are gathered, where they lie, into shards of about ``SHARD`` bytes
   (a longer document is cut into pieces that overlap by LENGTH - 1). The suffix array
   of a shard, but for the stretches whose grams occur nowhere else in it, is made by
   Larsson-Sadakane refinement and its common prefixes by Kasai's scan (``suffixes``). Runs of suffixes that share LENGTH bytes are the equal strings; all
   but a run's earliest are decided here, whatever other shards hold.
2. What may repeat elsewhere. Every string has an anchor: its ``GRAM`` bytes of least
   hash, so equal strings have equal anchors at the same place. For each anchor of
   undecided strings a shard gives its hash; an anchor that only one document or piece
   has is decided by that. The hashes are counted by an aggregate.
3. Equal contexts. For the other anchors, the bytes that their undecided strings span
   are digested. All but the earliest of the anchors with one digest are decided by
   an aggregate and a join, whole, so a passage in a third of all documents costs
   each shard one row.
4. Merging. Anchors with several contexts, such as those at the edge of a passage, come
   together by hash. Their strings are sorted, and each is found among them by binary
   search; all but the earliest are repeats. For an anchor of more than ``MANY``
   contexts the strings themselves are spread by a 128-bit hash, so none is too hot for a
   task.
5. The spans of a document are gathered by its key and cut out.

Documents without any repeat don't leave their place: rows are tested against broadcast
sets of key buckets (``BUCKETS`` at most, whatever the input) before each join on the text.

Defined results: a null text counts as empty. Null ids come before all others; rows of one
id are ordered by a hash of their text. Rows that repeat as a whole are documents one
after another: of 100 bytes or more, all but one of them go entirely. The 64-bit hash of
id and text that stands for a row is checked by 17 further bits. Other columns are
ignored. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_spread, landed, table
from .suffixes import END, repeats, words8

LENGTH = 100
GRAM = 32
SHARD = 3 << 20
MANY = 2048
BUCKETS = 1 << 20
CHECK = (1 << 17) - 1
PLACE = np.uint64((1 << 24) - 1)  # low bits of an anchor's order: its place in the shard


def _slide(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of the ``width`` values from every place on (fewer at the end)."""
    out, have = x.copy(), 1
    while have < width:
        step = min(have, width - have)
        out[:-step] = np.minimum(out[:-step], out[step:])
        have += step
    return out


def gram_hashes(first: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes at every place, from ``words8``."""
    padded, h = np.append(first, np.zeros(GRAM, np.uint64)), np.zeros(len(first), np.uint64)
    for at in range(0, GRAM, 8):
        h = (h ^ padded[at:at + len(first)]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return h


def window_hashes(text: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the LENGTH bytes at every place (fewer at the end)."""
    with np.errstate(over="ignore"):
        out, width, base = np.zeros(len(text), np.uint64), 0, np.uint64(0x9E3779B97F4A7C15)
        part = (text.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        part ^= part >> np.uint64(32)
        size = 1
        while True:  # ``part`` covers ``size`` bytes; LENGTH is put together from such parts
            if LENGTH & size:
                after = np.append(out[size:], np.zeros(min(size, len(out)), np.uint64))
                out = part * base_power(base, width) + after
                width += size
            if width == LENGTH:
                return out ^ (out >> np.uint64(31))
            part = part * base_power(base, size) + np.append(part[size:], np.zeros(min(size, len(part)), np.uint64))
            size *= 2


def base_power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def joined(spans_from: np.ndarray, spans_to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of spans as maximal runs."""
    if not len(spans_from):
        return spans_from, spans_to
    by = np.argsort(spans_from, kind="stable")
    a, b = spans_from[by], np.maximum.accumulate(spans_to[by])
    new = np.append(True, a[1:] > b[:-1])
    return a[new], b[np.append(np.flatnonzero(new)[1:] - 1, len(a) - 1)]


def again_in_shard(text: np.ndarray, valid: np.ndarray, h: np.ndarray) -> np.ndarray:
    """``repeats`` of a shard. A string can only repeat if each of its grams does, so the
    suffix array is made of the stretches where all grams of a string share their bucket
    (by ``h``) with another gram; that loses no repeat."""
    bucket = (h >> np.uint64(41)).astype(np.int64)
    many = np.bincount(bucket, minlength=1 << 23)[bucket] > 1
    edges = np.flatnonzero(np.diff(many, prepend=False, append=False))
    # the strings from begin to end - 1 have repeated grams only
    begin, end = edges[::2], edges[1::2] - (LENGTH - GRAM)
    begin, end = begin[end > begin], end[end > begin]
    begin, stop = joined(begin, end + LENGTH - 1)
    whole = np.zeros(len(text) + 1, np.int64)
    np.add.at(whole, begin, 1)
    np.add.at(whole, np.minimum(stop, len(text)), -1)
    keep = np.flatnonzero(np.cumsum(whole[:-1]))
    out = np.zeros(len(text), bool)
    out[keep] = repeats(text[keep], valid[keep] & _all_after(many, LENGTH - GRAM + 1)[keep], LENGTH)
    return out


def _all_after(flags: np.ndarray, width: int) -> np.ndarray:
    """Are the ``width`` flags from every place on all set (fewer at the end)?"""
    return _slide(flags.view(np.uint8), width).astype(bool)


def shard_rows(units: list[tuple]) -> list[dict]:
    """``units``: (id, u, check, piece, base, bytes). Steps 1 and 2 for one shard."""
    # rows that repeat as a whole have one key and are looked at once
    units = sorted({x[1:4]: x for x in units}.values(), key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2], x[4]))
    sizes = np.array([len(x[5]) for x in units], np.int64)
    ends = np.cumsum(sizes)
    text = np.frombuffer(b"".join(x[5] for x in units), np.uint8)
    valid = np.arange(len(text)) + LENGTH <= np.repeat(ends, sizes)
    h = gram_hashes(words8(np.append(text, END))[:len(text)])
    again = again_in_shard(text, valid, h)
    order = _slide((h & ~PLACE) | np.arange(len(h), dtype=np.uint64), LENGTH - GRAM + 1)
    at = np.flatnonzero(valid & ~again)
    anchor = (order[at] & PLACE).astype(np.int64)
    new = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])) if len(at) else at
    place, low = anchor[new], at[new]
    high = at[np.append(new[1:], len(at)) - 1] if len(at) else at
    gone = np.flatnonzero(again)
    out = []
    for (key, u, check, piece, base, _), end, size in zip(units, ends.tolist(), sizes.tolist()):
        begin = end - size
        a, b = np.searchsorted(low, (begin, end))
        c, d = np.searchsorted(gone, (begin, end))
        x, y = joined(gone[c:d] - begin + base, gone[c:d] - begin + base + LENGTH)
        p = place[a:b]
        out.append({"u": u, "piece": piece, "hash": h[p].view(np.int64), "place": p - begin + base,
                    "reach": (check << 14 | (p - low[a:b]) << 7 | (p - high[a:b])), "check": check,
                    "from": x, "to": y})
    return out


def _rows(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, t, u, c): the text as bytes, the row key and its check bits."""
    t = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    return df.select(F.col(id_col).cast("long").alias("id"), t.alias("t")).select(
        "id", "t", F.xxhash64("id", "t").alias("u"),
        F.xxhash64(F.lit(1), "id", "t").bitwiseAND(F.lit(CHECK)).cast("int").alias("c"))


def _some(rows: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows in (or not in) a bucket of any of ``keys``; a bounded broadcast."""
    bucket = F.pmod(F.col("u"), F.lit(BUCKETS))
    return rows.withColumn("_b", bucket).join(
        F.broadcast(keys.select(bucket.alias("_b")).distinct()), "_b", how).drop("_b")


def _shards(rows: DataFrame) -> DataFrame:
    kinds = pa.schema([("u", pa.int64()), ("piece", pa.int32()), ("hash", pa.list_(pa.int64())),
                       ("place", pa.list_(pa.int32())), ("reach", pa.list_(pa.int32())), ("check", pa.int32()),
                       ("from", pa.list_(pa.int32())), ("to", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, size = [], 0

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(shard_rows(units), schema=kinds)

        for batch in batches:
            for key, t, u, c in zip(*(batch.column(x) for x in ("id", "t", "u", "c"))):
                t = t.as_buffer()
                if t.size < LENGTH:
                    continue
                for piece, at in enumerate(range(0, max(1, t.size - LENGTH + 1), SHARD)):
                    part = t.slice(at, min(SHARD + LENGTH - 1, t.size - at)).to_pybytes()
                    units.append((key.as_py(), u.as_py(), c.as_py(), piece, at, part))
                    size += len(part)
                    if size >= SHARD:
                        yield made()
                        units, size = [], 0
        if units:
            yield made()

    return landed(rows.mapInArrow(
        run, "u long, piece int, hash array<long>, place array<int>, reach array<int>, check int, "
             "from array<int>, to array<int>"), "shards")


def _contexts(rows: DataFrame, wanted: DataFrame, whole: bool) -> DataFrame:
    """For anchors by document (u, at: array of hash, place, reach, n): the digest
    (d1, d2) of their context, or the bytes themselves (ctx)."""
    kinds = pa.schema([("hash", pa.int64()), ("reach", pa.int32()), ("n", pa.int64()), ("id", pa.int64()),
                       ("u", pa.int64()), ("place", pa.int32()),
                       *([("ctx", pa.binary())] if whole else [("d1", pa.int64()), ("d2", pa.int64())])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # (hash, reach, n, place, id, u) arrays of a document
        parts: list[bytes] = []

        def made() -> pa.RecordBatch:
            hashes, reach, n, place = (np.concatenate([x[i] for x in held]) for i in range(4))
            many = [len(x[0]) for x in held]
            known = np.repeat([x[4] is not None for x in held], many)
            ids = np.repeat(np.array([x[4] or 0 for x in held], np.int64), many)
            if whole:
                last = [pa.array(parts, pa.binary())]
            else:
                d = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, parts)), np.int64).reshape(-1, 2)
                last = [pa.array(np.ascontiguousarray(d[:, 0])), pa.array(np.ascontiguousarray(d[:, 1]))]
            return pa.RecordBatch.from_arrays(
                [pa.array(hashes), pa.array((reach & 0x3FFF).astype(np.int32)), pa.array(n), pa.array(ids, mask=~known),
                 pa.array(np.repeat(np.array([x[5] for x in held], np.int64), many)), pa.array(place.astype(np.int32)), *last],
                schema=kinds)

        for batch in batches:
            lists = batch.column("at")
            edges = lists.offsets.to_numpy()
            every = {x: lists.values.field(x).to_numpy(zero_copy_only=False) for x in ("hash", "reach", "n", "place")}
            columns = zip(*(batch.column(x).to_pylist() for x in ("id", "u", "c")), batch.column("t"))
            for row, (key, u, c, t) in enumerate(columns):
                hashes, reach, n, place = (x[edges[row]:edges[row + 1]] for x in every.values())
                mine = reach >> 14 == c
                if not mine.all():
                    hashes, reach, n, place = hashes[mine], reach[mine], n[mine], place[mine]
                t = t.as_py()
                parts += [t[a:b] for a, b in zip((place - (reach >> 7 & 127)).tolist(),
                                                 (place - (reach & 127) + LENGTH).tolist())]
                held.append((hashes, reach, n, place, key, u))
                if len(parts) >= 16384:
                    yield made()
                    held, parts = [], []
        if held:
            yield made()

    schema = "hash long, reach int, n long, id long, u long, place int, " + ("ctx binary" if whole else "d1 long, d2 long")
    return _some(rows, wanted).join(wanted, "u").select("id", "u", "c", "t", "at").mapInArrow(run, schema)


def _by_document(anchors: DataFrame, n: Column) -> DataFrame:
    return anchors.groupBy("u").agg(F.collect_list(F.struct("hash", "place", "reach", n.alias("n"))).alias("at"))


def _merge(contexts: DataFrame) -> DataFrame:
    """(u, c, from, to): strings that an earlier context of the same anchor holds."""
    kinds = pa.schema([("u", pa.int64()), ("from", pa.int32()), ("to", pa.int32())])

    def search(group: list[tuple]) -> pa.RecordBatch:
        group = sorted({r[:4]: r for r in group}.values(),
                       key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))  # id, u, place
        text = np.frombuffer(b"".join(r[4] for r in group), np.uint8)
        sizes = np.array([len(r[4]) for r in group])
        inside = np.arange(len(text)) + LENGTH <= np.repeat(np.cumsum(sizes), sizes)
        place = np.flatnonzero(inside)
        strings = np.lib.stride_tricks.sliding_window_view(text, LENGTH)
        # sorted by hash, each is looked up by binary search and compared byte by byte;
        # should two of one hash differ, the strings themselves are sorted
        keys = window_hashes(text)[place]
        known, earliest = np.unique(keys, return_index=True)
        found = earliest[np.searchsorted(known, keys)]
        other = np.flatnonzero(found < np.arange(len(keys)))
        if not all((strings[place[x]] == strings[place[found[x]]]).all() for x in np.array_split(other, len(other) // 65536 + 1)):
            whole = np.ascontiguousarray(strings[place]).view(f"S{LENGTH}").ravel()
            known, earliest = np.unique(whole, return_index=True)
            found = earliest[np.searchsorted(known, whole)]
        again = np.flatnonzero(found < np.arange(len(keys)))
        many = np.array([len(r[4]) - LENGTH + 1 for r in group])
        row = np.repeat(np.arange(len(group)), many)[again]
        start = np.array([r[3] for r in group])[row] + again - (np.cumsum(many) - many)[row]
        return pa.RecordBatch.from_arrays([pa.array(np.array([r[2] for r in group], np.int64)[row]),
                                           pa.array(start.astype(np.int32)), pa.array((start + LENGTH).astype(np.int32))],
                                          schema=kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, size = [], 0
        for batch in batches:
            for r in zip(*(batch.column(x).to_pylist() for x in ("hash", "id", "u", "place", "ctx", "reach"))):
                if group and r[0] != group[-1][0] and size >= 1 << 20:
                    yield search(group)
                    group, size = [], 0
                group.append((r[0], r[1], r[2], r[3] - (r[5] >> 7), r[4]))
                size += len(r[4])
        if group:
            yield search(group)

    few = (contexts.where(F.col("n") <= MANY).repartition("hash").sortWithinPartitions("hash")
           .mapInArrow(run, "u long, from int, to int"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, u, place, reach, ctx in zip(*(batch.column(x).to_pylist() for x in ("id", "u", "place", "reach", "ctx"))):
                many, low = len(ctx) - LENGTH + 1, place - (reach >> 7)
                d = np.frombuffer(b"".join(xxhash.xxh3_128_digest(ctx[i:i + LENGTH]) for i in range(many)), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy()), pa.array([key] * many, pa.int64()),
                     pa.array([u] * many, pa.int64()), pa.array(np.arange(low, low + many, dtype=np.int32))],
                    names=["d1", "d2", "id", "u", "at"])

    strings = contexts.where(F.col("n") > MANY).mapInArrow(spread, "d1 long, d2 long, id long, u long, at int")
    first = strings.groupBy("d1", "d2").agg(F.min(F.struct("id", "u", "at")).alias("f"), F.count("*").alias("m")).where("m > 1")
    many = (join_spread(strings, first, ["d1", "d2"]).where(F.struct("id", "u", "at") > F.col("f"))
            .select("u", F.col("at").alias("from"), (F.col("at") + LENGTH).alias("to")))
    return few.union(many)


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(u, spans): array of (from, to, check) to remove, spans may overlap; check -1: any."""
    shards = _shards(rows)
    own = shards.select("u", F.explode(F.transform(
        F.arrays_zip("from", "to"), lambda s: F.struct(s["from"].alias("from"), s["to"].alias("to")))).alias("s"), "check")
    own = own.select("u", "s.from", "s.to", "check")
    # a piece of a document counts as a document of its own
    unit = F.when(F.col("piece") == 0, F.col("u")).otherwise(F.xxhash64("u", "piece"))
    shared = landed(shards.select(unit.alias("unit"), F.explode("hash").alias("hash")).groupBy("hash")
                    .agg(F.min("unit").alias("_lo"), F.max("unit").alias("_hi")).where("_lo < _hi").select("hash"), "shared-hashes")
    # narrow rows, exchanged for this join only (``shared`` is a table), so hot keys can be split
    anchors = shards.select("u", F.explode(F.arrays_zip("hash", "place", "reach")).alias("a")).select(
        "a.hash", "u", F.shiftleft(F.col("a.place").cast("long"), 32).bitwiseOR(F.col("a.reach").cast("long")).alias("at"))
    found = anchors.join(shared, "hash").select("hash", "u", F.shiftright("at", 32).cast("int").alias("place"),
                                                F.col("at").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("reach"))
    wanted = landed(_by_document(found, F.lit(0).cast("long")), "shared-anchors")
    digests = landed(_contexts(rows, wanted, False), "contexts")
    same = ["hash", "reach", "d1", "d2"]
    reps = landed(digests.groupBy(*same).agg(F.min(F.struct("id", "u", "place")).alias("f")), "first-contexts")
    place = F.col("place") - F.shiftright("reach", 7), F.col("place") - F.col("reach").bitwiseAND(F.lit(127)) + LENGTH
    equal = (join_spread(digests, reps, same).where(F.struct("id", "u", "place") > F.col("f"))
             .select("u", place[0].alias("from"), place[1].alias("to")))
    several = reps.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
    # the check bits were compared when the digests were made
    open_ = join_spread(reps, several, "hash").select(F.col("f.u").alias("u"), "hash", F.col("f.place").alias("place"), "reach", "n")
    checks = wanted.select("u", F.shiftright(F.col("at")[0]["reach"], 14).alias("c0"))
    open_ = open_.join(checks, "u").withColumn("reach", F.col("reach") + F.shiftleft("c0", 14)).drop("c0")
    merged = _merge(landed(_contexts(rows, landed(_by_document(open_, F.col("n")), "open-anchors"), True), "open-contexts"))
    other = equal.union(merged).withColumn("check", F.lit(-1))
    return own.union(other).groupBy("u").agg(F.collect_list(F.struct("from", "to", "check")).alias("spans"))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_bytes, kept, removed), one row per input row: the bytes kept, and the
    removed runs as an array of (from, to)."""
    rows = _rows(df, id_col, text)
    spans = landed(repeated_spans(rows), "spans")
    # rows that repeat as a whole: one is worked on, the others are known
    copies = landed(rows.groupBy("u", "c", "id").agg(F.count("*").alias("m"), F.max(F.length("t")).alias("size"))
                    .where("m > 1"), "copies")
    touched = spans.select("u").union(copies.select("u"))
    near = (_some(rows, touched).join(spans, "u", "left")
            .join(copies.select("u", "c", "m"), ["u", "c"], "left"))
    base = near.where("m is null").unionByName(near.where("m is not null").dropDuplicates(["u", "c"])).drop("m")
    base = base.select("id", "t", "c", "spans").union(
        _some(rows, touched, "left_anti").select("id", "t", "c", F.lit(None).cast(spans.schema["spans"].dataType)))
    runs = "array<struct<from: int, to: int>>"
    kinds = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("kept", pa.binary()),
                       ("removed", pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for key, t, c, cut in zip(*(batch.column(x) for x in ("id", "t", "c", "spans"))):
                t, a, b = t.as_py(), np.zeros(0, np.int64), np.zeros(0, np.int64)
                if cut.is_valid:
                    a, b, check = (cut.values.field(x).to_numpy(zero_copy_only=False).astype(np.int64)
                                   for x in ("from", "to", "check"))
                    mine = (check == c.as_py()) | (check < 0)
                    a, b = joined(a[mine], b[mine])
                edges = np.concatenate([[0], np.stack([a, b], 1).ravel(), [len(t)]]).tolist()
                made.append({"id": key.as_py(), "n_bytes": len(t),
                             "kept": b"".join(t[x:y] for x, y in zip(edges[::2], edges[1::2])),
                             "removed": [{"from": x, "to": y} for x, y in zip(a.tolist(), b.tolist())]})
            yield pa.RecordBatch.from_pylist(made, schema=kinds)

    done = base.mapInArrow(run, f"id long, n_bytes long, kept binary, removed {runs}")
    more = copies.select("id", "size", F.explode(F.sequence(F.lit(2).cast("long"), "m")))
    long = F.col("size") >= LENGTH
    # short copies hold no string that could repeat: their bytes come from the rows
    rest = more.where(long).select("id", F.col("size").cast("long").alias("n_bytes"), F.lit(b"").alias("kept"),
                                   F.array(F.struct(F.lit(0).alias("from"), F.col("size").alias("to"))).alias("removed"))
    short = (copies.where(~long).select("u", "c", "m")
             .join(_some(rows, copies).dropDuplicates(["u", "c"]), ["u", "c"])
             .select("id", F.length("t").cast("long").alias("n_bytes"), F.col("t").alias("kept"),
                     F.array().cast(runs).alias("removed"), F.explode(F.sequence(F.lit(2).cast("long"), "m"))).drop("col"))
    return done.union(rest).union(short)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: what is left of every document without its repeated strings."""
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        F.col("id").alias("doc_id"), "n_bytes",
        F.coalesce(F.aggregate("removed", F.lit(0).cast("long"), lambda s, r: s + r["to"] - r["from"]), F.lit(0).cast("long"))
        .alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
