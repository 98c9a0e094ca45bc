"""The pipeline's stages, each against what it promises about its own input."""

import importlib
import re
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from quarry.llm import ngram_join, packing, secrets, toxicity
from quarry.llm.common import written

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns(steps):
    for step in steps[:-1]:
        assert step.columns == steps[0].columns and step.dtypes == steps[0].dtypes


def test_toxic_documents_go(spark, steps):
    scores = toxicity.digest(steps[0], spark.read.parquet(f"{SF}/labels.parquet"))
    clean = {r["doc_id"] for r in scores.where("predicted = 0").collect()}
    assert set(rows(steps[1])) == clean


def test_one_of_each_group_stays(steps):
    want = {r["component_id"] for r in ngram_join.digest(steps[1]).collect()}
    assert set(rows(steps[2])) == want
    assert ngram_join.digest(steps[2]).where("n_links > 0").count() == 0


def test_secrets_are_masked(steps):
    before, after = rows(steps[2]), rows(steps[3])
    assert set(before) == set(after)
    for i, r in after.items():
        assert r["n_chars"] == len(r["text"])
        kept = r["text"].split("[SECRET]")
        assert re.fullmatch(".*".join(map(re.escape, kept)), before[i]["text"], re.S)
    assert secrets.scan(steps[3]).where("size(secret_spans) > 0").count() == 0


def test_mix_is_full(steps):
    count = lambda df: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in df.collect())
    assert count(steps[4]) == count(steps[3])


def test_packing_holds_every_token(steps):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sum(len(tok.encode(r["text"], add_special_tokens=False).ids) + 1 for r in steps[4].collect())
    assert sum(r["length"] for r in steps[5].collect()) == want


def test_packed_ids_are_the_tokenizers(steps):
    """Every document's pieces put together give its ids, as often as it stands in the mix."""
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in steps[4].collect():
        ids = np.array([*tok.encode(r["text"], add_special_tokens=False).ids, packing.END], "<u4")
        for start, length in packing.cuts(len(ids)):
            want[r["doc_id"], start, ids[start : start + length].tobytes()] += 1
    got = steps[5].collect()
    assert Counter((r["doc_id"], r["start"], bytes(r["ids"])) for r in got) == want
    assert all(len(r["ids"]) == 4 * r["length"] and r["ids_crc32"] == zlib.crc32(r["ids"]) for r in got)


def test_run_gives_the_last_stage(spark, steps):
    key = lambda df: sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert key(corpus_pipeline.run(spark, SF)) == key(steps[5])


def test_entry_without_this_part(monkeypatch):
    import __spark_entry__

    for name in ("corpus_pipeline", "quarry.llm"):
        monkeypatch.setitem(sys.modules, name, None)
    try:
        entry = importlib.reload(__spark_entry__)
        assert "pagerank" in entry.queries() and not [k for k in entry.queries() if k.startswith("op")]
    finally:
        monkeypatch.undo()
        importlib.reload(__spark_entry__)
