"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are the powers of two
that add up to n (whole sequences of ``limit`` first, then the binary digits
of the rest, large ones first). Pieces of one length form a bucket; a piece is
a sequence of its own, so no sequence crosses documents and none is padded:
every length is a power of two. There is no shuffle: every document is cut by
itself, whatever its length.

Token ids are those of the vocabulary's ``tokenizers`` file without special
tokens. They are made with the same vocabulary's rank file by ``tiktoken``,
which is about four times as fast (the tests hold both against each other);
texts that spell a special token go through ``tokenizers`` itself.

Defined cases: a null or empty text has the end id only (one piece of length
1); null and repeated doc_ids are rows like others; an empty table gives an
empty result; further columns are not read.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.arrow import map_batches, texts

LIMIT = 2048
END = 1  #: fixed value: the id that ends a document
SCHEMA = "doc_id {0}, start long, length long, ids binary, doc_tokens long"
FLUSH = 1 << 18  #: tokens gathered before a batch goes out


def cuts(n: int, limit: int = LIMIT) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens."""
    whole = n // limit
    out = [(i * limit, limit) for i in range(whole)]
    at, rest, size = whole * limit, n % limit, limit
    while rest:
        size >>= 1
        if rest >= size:
            out.append((at, size))
            at, rest = at + size, rest - size
    return out


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Text to ids. Holds both readers of one vocabulary."""

    def __init__(self, json_path: str, rank_path: str):
        import public_tokenizers
        import tiktoken

        with open(rank_path, "rb") as f:
            ranks = {base64.b64decode(k): int(v) for k, v in map(bytes.split, f)}
        self.fast = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        with open(json_path, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f).get("added_tokens", [])]
        self.json_path, self._full = json_path, None

    @property
    def full(self):
        """The tokenizer of the ``tokenizers`` library, read when first needed."""
        if self._full is None:
            from tokenizers import Tokenizer

            self._full = Tokenizer.from_file(self.json_path)
        return self._full

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            ids = self.full.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array([*ids, END], dtype="<u4")


def pack(
    docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT,
    vocabulary: tuple[str, str] | None = None,
) -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, bucket, sequence_id,
    offset). ``ids`` holds little-endian unsigned 32-bit ids. ``bucket`` is
    the length's exponent; sequence ids of one bucket are neighbours, so a
    sort or a write partitioned by bucket gives batches of one length."""
    if limit & (limit - 1):
        raise ValueError("limit must be a power of two")
    paths = vocabulary or default_vocabulary()
    kind = docs.schema[key].dataType.simpleString()

    def run(batches) -> Iterator[dict]:
        encoder = Encoder(*paths)
        for b in batches:
            out, held = _empty(), 0
            for doc, body in zip(b.column(0), texts(b.column(1))):
                ids = encoder.ids(body)
                for start, length in cuts(len(ids), limit):
                    out["doc_id"].append(doc.as_py())
                    out["start"].append(start)
                    out["length"].append(length)
                    out["ids"].append(ids[start : start + length].tobytes())
                    out["doc_tokens"].append(len(ids))
                held += len(ids)
                if held >= FLUSH:
                    yield out
                    out, held = _empty(), 0
            yield out

    pieces = map_batches(docs.select(key, text), run, SCHEMA.format(kind))
    bucket = F.length(F.bin("length")) - 1
    return pieces.withColumn("bucket", bucket).withColumn(
        "sequence_id", F.monotonically_increasing_id() + F.shiftleft(F.col("bucket").cast("long"), 58)
    ).withColumn("offset", F.lit(0).cast("long"))


def _empty() -> dict:
    return {"doc_id": [], "start": [], "length": [], "ids": [], "doc_tokens": []}


def digest(docs: DataFrame) -> DataFrame:
    return pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "bucket",
    )
