from __future__ import annotations

import hashlib
from collections import Counter
from pathlib import Path

import pytest

from cinderlake.llm import token_counts as C
from cinderlake.llm.queries import op1_token_counts

if not Path(C.VOCABULARY).exists():
    pytest.skip("no vocabulary here", allow_module_level=True)


def brute(rows):
    encode = C.encoder(C.VOCABULARY).encode_ordinary
    out = []
    for i, text, *_ in rows:
        clean = None if text is None else text.replace("\r\n", "\n").replace("\r", "\n")
        out.append((i, None if clean is None else hashlib.sha256(clean.encode()).hexdigest(), None if clean is None else len(encode(clean))))
    return Counter(out)


def test_counts_and_cache(spark, make, odd_rows, tmp_path):
    rows = [*odd_rows, (20, "a\r\nb <|endoftext|>", "en", "s"), (21, "a\nb <|endoftext|>", "en", "s")]
    path = str(tmp_path / "cache")
    first = C.token_counts(make(rows), path).collect()
    assert Counter((r.doc_id, r.digest, r.n_tokens) for r in first) == brute(rows)
    assert all(r.was_cached is (None if r.digest is None else False) for r in first)
    distinct = len({r.digest for r in first if r.digest})
    stored = spark.read.parquet(path)
    assert stored.count() == distinct
    more = [*rows, (30, "something new", "en", "s")]
    again = C.token_counts(make(more), path).collect()
    assert Counter((r.doc_id, r.digest, r.n_tokens) for r in again) == brute(more)
    assert [r.doc_id for r in again if r.was_cached is False] == [30]
    assert spark.read.parquet(path).count() == distinct + 1
    assert C.token_counts(make([]), str(tmp_path / "none")).count() == 0


def test_another_tokenizer_has_counts_of_its_own(make, tmp_path):
    other = str(Path(C.VOCABULARY).with_name("byte_bpe_multi_50k.tiktoken"))
    path, docs = str(tmp_path / "cache"), make([(1, "Ünïcode 中文", "en", "s")])
    a, b = C.token_counts(docs, path).first(), C.token_counts(docs, path, other).first()
    assert a.digest == b.digest and not b.was_cached
    assert b.n_tokens == len(C.encoder(other).encode_ordinary("Ünïcode 中文"))


def test_query_meets_hits_and_misses(spark, make, odd_rows, tmp_path):
    rows = [*odd_rows, *((100 + k, f"text {k}", "en", "s") for k in range(40))]
    make(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = op1_token_counts(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.digest, r.n_tokens) for r in got) == brute(rows)
    assert all(r.was_cached == (None if r.digest is None else int(r.digest[0], 16) % 2 == 0) for r in got)
    assert {r.was_cached for r in got} == {True, False, None}
