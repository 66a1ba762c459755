from __future__ import annotations

import random
import re

import pyarrow as pa

from cinderlake.llm import decontaminate as D
from cinderlake.llm._common import blocks, normalise

from .conftest import WORDS, prose


def plain(text):
    return " " + " ".join(re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())) + " "


def brute(rows, items, window, least):
    out = {}
    for i, text, *_ in rows:
        for item, passage in items:
            words = plain(passage).split()
            if len(words) < least:
                continue
            size = min(window, len(words))
            n = sum(s in plain(text) for s in {" " + " ".join(words[k : k + size]) + " " for k in range(len(words) - size + 1)})
            if n:
                out[i, item] = max(n, out.get((i, item), 0))
    return out


def items_of(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")


def test_equals_brute_force(spark, make, monkeypatch):
    r = random.Random(5)
    items = [(k, prose(100 + k, r.randint(3, 30))) for k in range(25)] + [(90, None), (91, ""), (None, prose(7, 20)), (92, prose(103, 30)), (93, prose(103, 30))]
    rows = []
    for k in range(120):
        text = prose(k, r.randint(0, 200))
        if k % 3 == 0:
            part = (r.choice(items)[1] or "").split()
            cut = r.randint(0, 5)
            text += "\n" + "  ".join(part[cut : len(part) - r.randint(0, 5)]).upper() + ". " + r.choice(WORDS)
        rows.append((k, text, "en", "s"))
    docs, table = make(rows), items_of(spark, items)
    for window, least in ((4, 3), (13, 5)):
        got = {(x.doc_id, x.item_id): x.n_strings for x in D.matches(docs, table, window, least).collect()}
        assert got == brute(rows, items, window, least) and got
    kept = D.remove_contaminated(docs, table, 4, 3)
    dirty = {i for i, _ in brute(rows, items, 4, 3)}
    assert {x.doc_id for x in kept.collect()} == {i for i, *_ in rows} - dirty and kept.columns == docs.columns
    monkeypatch.setattr(D, "GROUP_BYTES", 2000)  # several groups of items give the same
    assert {(x.doc_id, x.item_id): x.n_strings for x in D.matches(docs, table, 4, 3).collect()} == brute(rows, items, 4, 3)
    assert {x.doc_id for x in D.remove_contaminated(docs, table, 4, 3).collect()} == {i for i, *_ in rows} - dirty


def test_odd_rows(spark, make, odd_rows):
    docs = make(odd_rows)
    items = [(1, " ".join(odd_rows[0][1].split()[3:30])), (2, odd_rows[8][1][-300:])]
    got = {(x.doc_id, x.item_id): x.n_strings for x in D.matches(docs, items_of(spark, items)).collect()}
    assert got == brute(odd_rows, items, D.WINDOW, D.LEAST_WORDS) and (None, 1) in got and (7, 2) in got
    assert D.matches(docs, items_of(spark, [])).count() == 0
    assert D.matches(make([]), items_of(spark, items)).count() == 0
    assert D.remove_contaminated(docs, items_of(spark, [])).count() == len(odd_rows)


def test_normalise():
    texts = ["Ab, c!", None, "", "...", "É 1", "x"]
    data, offsets = normalise(next(blocks(pa.array(texts, pa.string()))))
    raw = data.tobytes().decode()
    got = [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:])]
    assert got == [" ab c ", "", "", "", " é 1 ", " x "] and raw == "".join(got)


def test_texts_of_one_item_are_counted_together_in_any_number_of_groups(spark, make, monkeypatch):
    texts = [prose(300 + k, 20) for k in range(12)]
    benchmark = spark.createDataFrame([(item, t) for t in texts for item in (1, None)] + [(2, texts[0])], "item_id bigint, text string")
    docs = make([(1, "\n".join(texts), "en", "a"), (2, texts[3], "en", "a")])
    whole = sorted(map(tuple, D.matches(docs, benchmark).collect()), key=repr)
    monkeypatch.setattr(D, "GROUP_BYTES", 4096)
    split = sorted(map(tuple, D.matches(docs, benchmark).collect()), key=repr)
    assert split == whole
    assert (1, 1, 12 * 8) in split and (1, None, 12 * 8) in split and (1, 2, 8) in split


def test_short_items_and_ids_of_other_types(spark, make):
    items = [(1, "one two three four"), (2, "solo"), (3, prose(40, 30)), (4, "!!!"), (3, "Solo")]
    rows = [(1, "Zero one two three, four five", "en", "a"), (2, "one two three", "en", "a"), (3, "a SOLO voice", "en", "a"), (4, "soloist", "en", "a"), (5, prose(40, 30) + " solo", "en", "a")]
    docs = make(rows)
    want = {(1, 1): 1, (3, 2): 1, (3, 3): 1, (5, 2): 1, (5, 3): 18 + 1}
    for kind in ("int", "bigint", "string", "date"):
        table = spark.createDataFrame(items, "item_id int, text string").selectExpr(f"CAST({'DATE_ADD(DATE' + chr(39) + '2024-01-01' + chr(39) + ', item_id)' if kind == 'date' else 'item_id'} AS {kind}) AS item_id", "text")
        ids = {r.item_id: r.k for r in table.selectExpr("item_id", f"CAST({'DATEDIFF(item_id, DATE' + chr(39) + '2024-01-01' + chr(39) + ')' if kind == 'date' else 'item_id'} AS int) AS k").distinct().collect()}
        got = D.matches(docs, table)
        assert got.schema["item_id"].dataType == table.schema["item_id"].dataType
        assert {(x.doc_id, ids[x.item_id]): x.n_strings for x in got.collect()} == want
    assert {x.doc_id for x in D.remove_contaminated(docs, table).collect()} == {2, 4}
