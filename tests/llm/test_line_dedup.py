from __future__ import annotations

from collections import Counter, defaultdict

from pyspark.sql import functions as F

from cinderlake.llm import line_dedup as D


def brute(rows, min_sites):
    sites, ids = defaultdict(set), defaultdict(set)
    for i, text, _, source in rows:
        for line in (text or "").split("\n"):
            key = line.strip(" \t\r")
            if key:
                ids[key].add(i)
                if source is not None:
                    sites[key].add(source)
    keeper = {k: min((i for i in ids[k] if i is not None), default=None) for k in ids if len(sites[k]) >= min_sites}
    out = []
    for i, text, _, source in rows:
        if text is None:
            out.append((i, None))
            continue
        out.append((i, "\n".join(line for line in text.split("\n") if not (k := line.strip(" \t\r")) or k not in keeper or keeper[k] == i)))
    return Counter(out)


def result(frame):
    return Counter((r.doc_id, r.text) for r in frame.collect())


def test_equals_brute_force_around_the_threshold(make):
    rows = []
    for n in range(1, 40):
        for k in range(n):
            rows.append((1000 * n + k, f"common {n % 9}\nwide {n}\n\n own {n} {k}\r\nwide {n}", "en", f"s{k}"))
    docs = make(rows)
    for threshold in (3, 10, 20):
        assert result(D.remove_boilerplate(docs, threshold)) == brute(rows, threshold)


def test_odd_rows(make, odd_rows):
    docs = make(odd_rows)
    out = D.remove_boilerplate(docs, 2, removed="gone_lines")
    assert out.columns == [*docs.columns, "gone_lines"]
    assert result(out) == brute(odd_rows, 2)
    assert out.where(F.col("line") == "x").count() == len(odd_rows)
    assert D.remove_boilerplate(make([])).count() == 0
    alone = [(None, "same", "en", f"s{k}") for k in range(4)]
    assert result(D.remove_boilerplate(make(alone), 2)) == brute(alone, 2) == Counter({(None, "same"): 4})


def test_count_takes_a_free_name(spark, make, odd_rows, tmp_path):
    out = D.remove_boilerplate(make(odd_rows), 2, removed="lines_removed")
    assert out.columns[-1] == "lines_removed_2" and len({c.lower() for c in out.columns}) == len(out.columns)
    out.write.parquet(str(tmp_path / "out"))
    assert {r.lines_removed for r in out.collect()} == {"x"}
