from __future__ import annotations

import random
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from cinderlake.llm import secret_crf as S
from cinderlake.llm._common import blocks

from .conftest import prose


def lines_of(seed, n):
    return [prose(seed * 1000 + k, 1 + k % 20).replace("\n", " ") for k in range(n)]


@pytest.fixture(scope="module")
def model():
    return S.fit(*S.training_lines(lines_of(1, 1200), seed=1))


def found(model, texts):
    tagger, out = S.Tagger(model), []
    for block in blocks(pa.array(texts, pa.string()), 3000):
        for doc, a, b in tagger.spans(block):
            out.append((block.first + doc, block.data[a:b].tobytes().decode()))
    return out


def test_held_out_accuracy(model):
    texts, spans = S.training_lines(lines_of(2, 800), seed=2)
    want = {(k, texts[k][a:b]) for k, own in enumerate(spans) for a, b in own}
    got = set(found(model, texts))
    assert len(got & want) >= 0.85 * len(want)
    assert len(got - want) <= 0.1 * len(want)


def test_skipping_lines_changes_nothing(model):
    texts = S.training_lines(lines_of(3, 300), seed=3)[0]
    slow = []
    for block in blocks(pa.array(texts, pa.string())):
        tokens = S.tokens_of(block)
        for number in np.unique(tokens.line):
            low, high = np.searchsorted(tokens.line, (number, number + 1))
            tags = S.viterbi(sum(t[i[low:high]] for t, i in zip(model.tables, tokens.features)), model)
            for k in np.flatnonzero(tags == S.BEGIN):
                end = k + 1
                while end < len(tags) and tags[end] == S.INSIDE:
                    end += 1
                slow.append((int(tokens.doc[low]), block.data[tokens.begins[low + k] : tokens.ends[low + end - 1]].tobytes().decode()))
    assert found(model, texts) == slow and slow


def test_viterbi_and_likelihood_equal_enumeration(model):
    r = np.random.default_rng(0)
    emission = r.normal(size=(5, 3))
    free = S.Model([], r.normal(size=(3, 3)), r.normal(size=3))

    def value(path):
        return free.initial[path[0]] + sum(emission[t, y] for t, y in enumerate(path)) + sum(free.transitions[a, b] for a, b in zip(path, path[1:]))

    paths = list(product(range(3), repeat=5))
    assert tuple(S.viterbi(emission, free)) == max(paths, key=value)
    total, marginals, pairs = S._forward_backward(emission[None], np.ones((1, 5), bool), free.transitions, free.initial)
    weights = np.exp([value(p) for p in paths])
    assert np.isclose(total[0], np.log(weights.sum()))
    for t in range(5):
        for y in range(3):
            assert np.isclose(marginals[0, t, y], sum(w for w, p in zip(weights, paths) if p[t] == y) / weights.sum())
    assert np.isclose(pairs.sum(), 4)


def test_places_and_odd_rows(make, model, odd_rows):
    r = random.Random(1)
    secret = "".join(r.choice("0123456789abcdef") for _ in range(40))
    rows = [*odd_rows, (50, f'É ñ token = "{secret}" de', "en", "s"), (None, f'ba\n\ntoken = "{secret}"', "en", "s"), (51, odd_rows[8][1] + f'\ntoken = "{secret}"', "en", "s")]
    docs = make(rows)
    got = [(x.doc_id, x.start, x.length) for x in S.scan(docs, model).collect()]
    want = [(i, t.index(secret), 40) for i, t, *_ in rows if t and secret in t]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert S.scan(make([]), model).count() == 0
    trained = S.train(docs, train_docs=5, train_lines=50)
    assert {x.doc_id for x in S.scan(docs, trained).collect()} >= {50, 51}
    assert S.train(make([])).transitions.shape == (3, 3)
