from __future__ import annotations

import random

import pytest

#: Columns that operators use inside; documents may have columns of these names too.
CLASHING = ("id", "line", "site", "label", "language", "accepted", "node", "component", "keeper", "run", "head", "hot", "part", "rank", "key", "range", "slot", "phase", "position", "digest", "content", "bytes", "chunk", "media", "count", "__gone", "__id", "__row", "__places", "license", "start", "lines_removed", "class", "links", "cell", "side", "batch", "n_tokens", "block", "source_2")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHING)

_FIRST = "ba be bi bo bu da de di do du ka ke ki ko ku la le li lo lu".split()
WORDS = [a + b + c for a in _FIRST for b in _FIRST for c in "mar nel rit son tuv wex".split()]


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    out = [r.choice(WORDS) for _ in range(words)]
    return "".join(w + ("\n" if i % 12 == 11 else " ") for i, w in enumerate(out)).strip()


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text, lang, source) rows, with further columns whose names clash."""

    def build(rows):
        return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), *("x" for _ in CLASHING)) for i, t, lang, s in rows], SCHEMA)

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs, empty and blank texts, a very long text, ties, repeated rows, an id used twice."""
    long = prose(1, 60_000)
    base = prose(2, 120)
    return [
        (1, base, "en", "a"), (2, base, "en", "b"), (3, None, "en", "a"), (4, "", None, "a"), (5, " \n\n ", "en", None), (6, "%%% ### 123", "en", "c"), (None, base, "en", "a"), (None, None, None, None),
        (7, long, "de", "b"), (8, prose(3, 80), "de", None), (8, prose(3, 80), "de", None), (9, prose(4, 70), "fr", "c"), (9, prose(5, 70), "fr", "c"), (10, "Ünïcode ÉÀ中文 \U0001f600", "fr", "c"), (11, "one", "en", "a"), (12, "one", "en", "a"),
    ]
