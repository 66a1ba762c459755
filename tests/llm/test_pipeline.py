from __future__ import annotations

import random

import pytest

import corpus_pipeline as P
from cinderlake.llm import decontaminate, language_id, line_dedup, source_mix

from .conftest import prose
from .test_decontaminate import brute as leaks
from .test_language_id import brute_grams
from .test_line_dedup import brute as lines
from .test_simhash_bk import brute_groups, near_copy
from .test_source_mix import simulate

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus")
    r = random.Random(1)
    rows = []
    for k in range(150):
        text = prose(k, r.randint(1, 150))
        if k % 5 == 0:
            text += "\nshared line of many sites"
        rows.append((k, text, "en", f"src{k % 14}"))
    for k in range(20):
        rows.append((200 + k, near_copy(rows[k][1], 0.03, r), "en", f"src{r.randrange(14)}"))
    rows += [(300 + k, rows[3][1], "en", f"src{k}") for k in range(14)]
    rows += [(400, None, "en", "src1"), (401, "", "en", "src2"), (402, "%%%", "en", None), (403, "中文的汉字不在里面" * 9, None, "src1"), (404, prose(900, 40), None, None), (None, prose(901, 40), "en", "src3")]
    rows += [(405, rows[8][1], "en", "src5"), (406, "x " * 3 + prose(902, 30), "en", "src6")]
    spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], COLUMNS).write.parquet(str(path / "documents.parquet"))
    items = [(1, prose(902, 30)), (2, prose(40, 60)), (3, None)]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path), rows, items


def brute(spark, folder):
    path, rows, items = folder
    model = language_id.train(spark.read.parquet(f"{path}/documents.parquet"))
    table = model.log_probabilities

    def known(text):
        grams = brute_grams(text or "")
        best = max((sum(n * table[g, k] for g, n in grams.items()) for k in range(len(model.labels))), default=0)
        return bool(grams) and best >= -sum(grams.values()) * language_id.BUCKET_BITS * 0.6931471805599453

    rows = [r for r in rows if known(r[1])]
    changed = dict(lines(rows, line_dedup.MIN_SITES))
    rest = {i: t for i, t in changed}
    rows = [(i, rest[i], lang, s) for i, t, lang, s in rows if rest[i] == t or rest[i].strip(" \t\r\n")]
    gone = {i for i, _ in brute_groups(rows)[0]}
    rows = [r for r in rows if r[0] not in gone]
    dirty = {i for i, _ in leaks(rows, items, decontaminate.WINDOW, decontaminate.LEAST_WORDS)}
    return [r for r in rows if r[0] not in dirty]


def test_equals_brute_force(spark, folder):
    got = sorted(P.run(spark, folder[0]).collect(), key=lambda x: x.mix_position)
    want = brute(spark, folder)
    assert {(x.doc_id, x.text, x.lang, x.source, x.n_chars) for x in got} == {(i, t, lang, s, len(t)) for i, t, lang, s in want}
    assert len(got) == len(want) < len(folder[1])
    assert [x.mix_position for x in got] == list(range(len(got)))
    sizes: dict = {}
    for r in want:
        sizes[r[3]] = sizes.get(r[3], 0) + 1
    blocks = {s: -(-n // source_mix.BLOCK_DOCS) for s, n in sizes.items()}
    order = simulate(blocks, {s: source_mix.WEIGHTS.get(s, source_mix.DEFAULT_WEIGHT) for s in sizes})
    expected = [s for s, b in order for _ in range(min(source_mix.BLOCK_DOCS, sizes[s] - b * source_mix.BLOCK_DOCS))]
    assert [x.source for x in got] == expected


def test_stages_take_odd_rows_and_empty_tables(spark, make, odd_rows, folder):
    for docs in (make(odd_rows), make([])):
        for number, (_, stage) in enumerate(P.STAGES):
            out = stage(spark, docs, folder[0])
            assert out.columns == (docs.columns if number < 4 else [*docs.columns, "mix_position"])
            out.count()
