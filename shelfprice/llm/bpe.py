"""Byte-level BPE encoding and decoding with the tiktoken library.

``tokenize`` runs one Arrow pass over the rows (no shuffle): every executor process
builds the encoder once from a local rank file, encodes each text, decodes the ids
again as raw bytes, and adds the outputs that were asked for.

Long texts. The library's regular expression engine keeps a backtracking stack that
overflows on very long white-space runs. So a text above ``MAX_SEGMENT`` characters
is first cut at *safe boundaries*: a cut between a non-space and a white-space
character is always a match boundary of the pattern, because no alternative of it
matches a space after a non-space, and its only look-ahead concerns characters to
the right of a white-space run, which stays whole in the right part. The ids are
therefore those of the uncut text. A segment without such a boundary is matched with
the ``regex`` module, which has no such limit, and each match is encoded by itself.

Defined results: a null text counts as empty (no ids, the digest of nothing), a null
``doc_id`` is carried through, repeated rows give repeated results, an empty table
gives an empty table. Input columns that clash with an output name are replaced by
the output.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

import public_tokenizers

MAX_SEGMENT = 1 << 16
SAFE = re.compile(r"(?<=\S)(?=\s)")

OUTPUTS = {
    "ids": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
    "n_tokens": (T.LongType(), pa.int64()),
    "decoded": (T.BinaryType(), pa.binary()),
    "ids_sha256": (T.StringType(), pa.string()),
    "decoded_sha256": (T.StringType(), pa.string()),
}


class Codec:
    """A tiktoken encoder over a rank file, safe on texts of any length."""

    _made: dict[tuple[str, str], "Codec"] = {}

    def __init__(self, rank_path: str, pattern: str):
        with open(rank_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.enc = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks,
                                     special_tokens={})
        self.pattern = regex.compile(pattern)
        self.digits = [str(i) for i in range(max(ranks.values()) + 1)]

    @classmethod
    def of(cls, rank_path: str, pattern: str) -> "Codec":
        """The codec of this process; built once."""
        key = (rank_path, pattern)
        if key not in cls._made:
            cls._made[key] = cls(rank_path, pattern)
        return cls._made[key]

    def encode(self, text: str) -> list[int]:
        if len(text) <= MAX_SEGMENT:
            return self.enc.encode_ordinary(text)
        ids: list[int] = []
        for part in segments(text):
            if len(part) <= MAX_SEGMENT:
                ids += self.enc.encode_ordinary(part)
            else:
                for m in self.pattern.finditer(part):
                    ids += self.enc._encode_single_piece(m[0])
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return self.enc.decode_bytes(ids)

    def joined(self, ids: list[int]) -> str:
        return ",".join(map(self.digits.__getitem__, ids))


def segments(text: str, size: int = MAX_SEGMENT) -> Iterator[str]:
    """Cut ``text`` at safe boundaries into parts of about ``size`` characters; a
    part is longer only where it holds no safe boundary."""
    start, n = 0, len(text)
    while n - start > size:
        found = SAFE.search(text, start + size)
        end = found.start() if found else n
        yield text[start:end]
        start = end
    if start < n or n == 0:
        yield text[start:]


def tokenize(df: DataFrame, text: str = "text", outputs: tuple[str, ...] = ("ids",),
             rank_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``df`` without ``text``, with ``outputs`` added: ``ids`` (token ids),
    ``n_tokens``, ``decoded`` (raw bytes made from the ids), ``ids_sha256`` (of the
    decimal ids joined by commas) and ``decoded_sha256``; both lower-case hex."""
    rank_path = rank_path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    pattern = pattern or public_tokenizers.PATTERN
    kept = [c for c in df.columns if c != text and c not in outputs]
    schema = T.StructType([df.schema[c] for c in kept]
                          + [T.StructField(o, OUTPUTS[o][0]) for o in outputs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(rank_path, pattern)
        for batch in batches:
            # a few hundred texts at a time bound what the ids of a batch hold
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made: dict[str, list] = {o: [] for o in outputs}
                for t in part.column(text):
                    ids = codec.encode(t.as_py() or "")
                    got = {"ids": ids, "n_tokens": len(ids)}
                    if "ids_sha256" in made:
                        got["ids_sha256"] = hashlib.sha256(codec.joined(ids).encode()).hexdigest()
                    if "decoded" in made or "decoded_sha256" in made:
                        got["decoded"] = codec.decode(ids)
                        got["decoded_sha256"] = hashlib.sha256(got["decoded"]).hexdigest()
                    for o in outputs:
                        made[o].append(got[o])
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept]
                    + [pa.array(made[o], OUTPUTS[o][1]) for o in outputs],
                    names=kept + list(outputs))

    return df.select(*kept, text).mapInArrow(run, schema)


def decode(df: DataFrame, ids: str = "ids", rank_path: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """``df`` with ``decoded`` added: the raw bytes of the ids (null ids: none)."""
    rank_path = rank_path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    pattern = pattern or public_tokenizers.PATTERN
    kept = [c for c in df.columns if c != "decoded"]
    schema = T.StructType([df.schema[c] for c in kept]
                          + [T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(rank_path, pattern)
        for batch in batches:
            made = [codec.decode(x.as_py() or []) for x in batch.column(ids)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(made, pa.binary())],
                names=kept + ["decoded"])

    return df.select(*kept).mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op1: ids and decoded bytes of every document, as digests."""
    from .common import table
    return tokenize(table(spark, sf_dir, "documents").select("doc_id", "text"),
                    outputs=("n_tokens", "ids_sha256", "decoded_sha256"))
