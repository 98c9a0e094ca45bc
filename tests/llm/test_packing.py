import zlib
from collections import defaultdict

import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarry.llm import packing
from tests.llm.fixtures import AWKWARD, docs

PATHS = packing.default_vocabulary()


@pytest.fixture(scope="module")
def full():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@given(st.integers(1, 100_000))
def test_cuts_are_powers_of_two_without_gap(n):
    at = 0
    for start, length in packing.cuts(n):
        assert start == at and length & (length - 1) == 0 and length <= packing.LIMIT
        at += length
    assert at == n


encoder = packing.Encoder(*PATHS)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_ids_equal_the_tokenizers_library(text):
    full = encoder.full
    assert list(encoder.ids(text)) == [*full.encode(text, add_special_tokens=False).ids, packing.END]


def test_special_strings_and_long_words(full):
    for text in ("<|endoftext|>", "a <|endoftext|>b", "z" * 5000, "  \n\t x", "'ll 've 12345 é\U0001f600"):
        assert list(encoder.ids(text)) == [*full.encode(text, add_special_tokens=False).ids, 1]


def test_round_trip(spark, full):
    rows = [(100 + i, " ".join(f"word{j}" for j in range(i * 37))) for i in range(40)]
    rows += [r for r in AWKWARD if r[0] is not None and r[0] != 3]
    out = packing.digest(docs(spark, rows)).collect()
    assert len({r["sequence_id"] for r in out}) == len(out)
    by = defaultdict(list)
    for r in out:
        by[r["doc_id"]].append(r)
    for i, text in rows:
        ids = np.array([*full.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(by[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["offset"] == 0 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            assert r["bucket"] == r["length"].bit_length() - 1
            at += r["length"]
        assert at == len(ids)


def test_repeated_null_and_empty(spark):
    out = packing.digest(docs(spark, AWKWARD)).collect()
    assert sum(r["doc_id"] == 3 for r in out) % 2 == 0
    assert sum(r["length"] for r in out if r["doc_id"] in (0, 1)) == 2
    assert packing.digest(docs(spark, [])).count() == 0
