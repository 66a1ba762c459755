"""Benchmark decontamination by Wu-Manber multi-pattern search.

Test strings are the ``window``-word windows of each benchmark item (the whole item where it has fewer words, down to
``least_words``, by default one), in normalised form: case-folded words between single spaces. With ``m`` the shortest test string's length
in bytes, a table over hashed blocks of ``BLOCK`` bytes tells how far a cursor may jump; where the jump is zero, the bucket of
that block names the test strings whose first ``m`` bytes end in it, and a direct comparison decides. The cursors of many text
segments advance in step as one numpy vector, so most bytes of a text are never looked at. One pass over the texts, no shuffle. Strings of fewer than ``SHORT_WORDS`` words have tables of their
own beside those of the others, whose jumps they would shorten; both are searched in that pass and count alike.

The tables are broadcast behind a check of the benchmark's size: beyond ``GROUP_BYTES`` of text the items are split into
groups by a hash of their id, so that all texts of an id (and of NULL) are counted together however large they are; each group has tables
of its own and the texts are searched once per group.

Results for edge cases: NULL, empty and wordless texts match nothing; NULL, wordless and (below ``least_words``) too short items yield no test string; a NULL item id is kept as one. Rows that share an
id count as one document (the greatest count is given). Items that share a test string are all reported. An empty table on either side gives
no match. A text is searched as a whole however long it is, in segments that overlap by a test string. Item ids may be of any type. Further columns are ignored by
``matches`` and kept by ``remove_contaminated``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import blocks, normalise

WINDOW = 13
LEAST_WORDS = 1
SHORT_WORDS = 5
BLOCK = 8
TABLE_BITS = 20
SEGMENT = 2048
GROUP_BYTES = 16 << 20

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Tables:
    """Shift table, suffix buckets and test strings."""

    def __init__(self, strings: list[bytes]) -> None:
        self.strings = strings
        self.length = min(map(len, strings))
        self.block = min(BLOCK, self.length)
        farthest = self.length - self.block + 1
        self.shift = np.full(1 << TABLE_BITS, farthest, dtype=np.int32)
        heads = np.frombuffer(b"".join(s[: self.length] for s in strings), np.uint8).reshape(len(strings), self.length)
        self.bucket: dict[int, list[int]] = {}
        for end in range(self.block, self.length + 1):
            keys = self.keys(heads[:, end - self.block : end])
            np.minimum.at(self.shift, keys, self.length - end)
        for number, key in enumerate(keys.tolist()):
            self.bucket.setdefault(key, []).append(number)

    def keys(self, bytes_: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(bytes_), 8), dtype=np.uint8)
        wide[:, : bytes_.shape[1]] = bytes_
        return ((wide.view(np.uint64)[:, 0] * _FACTOR) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def search(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
        """(text, test string) for every occurrence."""
        m, width = self.length, self.block
        lengths = np.diff(offsets)
        pieces = np.maximum(0, -(-(lengths - m + 1) // SEGMENT))
        text = np.repeat(np.arange(len(lengths)), pieces)
        first = offsets[:-1][text] + (np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * SEGMENT
        last = np.minimum(first + SEGMENT, offsets[1:][text] - m + 1)  # starts of occurrences lie in [first, last)
        at = first.copy()
        raw, span = data.tobytes(), np.arange(width)
        while len(at):
            keys = self.keys(data[(at + (m - width))[:, None] + span])
            jump = self.shift[keys]
            for k in np.flatnonzero(jump == 0).tolist():
                begin = int(at[k])
                end_of_text = int(offsets[text[k] + 1])
                for number in self.bucket.get(int(keys[k]), ()):
                    string = self.strings[number]
                    if begin + len(string) <= end_of_text and raw.startswith(string, begin):
                        yield int(text[k]), number
            at = at + np.maximum(jump, 1)
            going = at < last
            if not going.all():
                at, last, text = at[going], last[going], text[going]


def test_strings(text: str | None, window: int = WINDOW, least_words: int = LEAST_WORDS) -> list[bytes]:
    block = next(iter(blocks(pa.array([text], pa.string()))), None)
    words = normalise(block)[0].tobytes().split() if block is not None else []
    if len(words) < least_words:
        return []
    size = min(window, len(words))
    return list(dict.fromkeys(b" " + b" ".join(words[i : i + size]) + b" " for i in range(len(words) - size + 1)))


test_strings.__test__ = False  # not a test


class Search:
    """The tables of one group of items: for each of their strings the places of its items in ``ids``."""

    def __init__(self, own: dict[bytes, dict[int, None]], ids: pa.Array) -> None:
        self.ids, self.parts = ids, []
        for short in (False, True):
            strings = [s for s in own if (s.count(b" ") - 1 < SHORT_WORDS) == short]
            if strings:
                self.parts.append((Tables(strings), [list(own[s]) for s in strings]))

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """(text, places of the items) for every test string that occurs in the text, once."""
        for tables, items in self.parts:
            for text, number in set(tables.search(data, offsets)):
                yield text, items[number]

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> set[int]:
        return {text for tables, _ in self.parts for text, _ in tables.search(data, offsets)}


def _groups(benchmark: DataFrame, window: int, least_words: int, item_column: str, text_column: str) -> Iterator[Search]:
    """One search for each group of items that fits the size check."""
    items = benchmark.select(F.col(item_column).alias("item"), F.col(text_column).cast("string").alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, ceil(size * min(window, 8) / GROUP_BYTES))  # windows overlap, so tables outgrow the texts
    for group in range(groups):
        part = items if groups == 1 else items.where(F.pmod(F.xxhash64("item"), F.lit(groups)) == group)
        rows = part.toArrow()  # about GROUP_BYTES, checked above; an item's texts stay together
        ids = pa.concat_arrays(rows.column("item").chunks) if rows.num_rows else pa.array([], rows.schema.field("item").type)
        first: dict = {}
        own: dict[bytes, dict[int, None]] = {}
        for place, (item, text) in enumerate(zip(ids.to_pylist(), rows.column("text").to_pylist())):
            item = first.setdefault(item, place)
            for string in test_strings(text, window, least_words):
                own.setdefault(string, {})[item] = None
        if own:
            yield Search(own, ids)


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least_words: int = LEAST_WORDS, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text") -> DataFrame:
    """``id, item, n_strings``: how many distinct test strings of the item occur in the document, where any does."""
    spark = docs.sparkSession
    item_type = benchmark.schema[item_column].dataType
    id_type = docs.schema[id_column].dataType
    schema = T.StructType([T.StructField(id_column, id_type), T.StructField(item_column, item_type), T.StructField("n_strings", T.LongType())])
    out = None
    for group in _groups(benchmark, window, least_words, item_column, item_text_column):
        sent = spark.sparkContext.broadcast(group)

        def apply(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            search = sent.value
            for batch in batches:
                rows, found, counts = [], [], []
                for block in blocks(batch.column(1)):
                    tally: dict[tuple[int, int], int] = {}
                    for text, items in search.hits(*normalise(block)):
                        for item in items:
                            tally[text, item] = tally.get((text, item), 0) + 1
                    for (text, item), n in tally.items():
                        rows.append(block.first + text)
                        found.append(item)
                        counts.append(n)
                if rows:
                    columns = [batch.column(0).take(pa.array(rows, pa.int64())), search.ids.take(pa.array(found, pa.int64())), pa.array(counts, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, schema.names)

        hits = docs.select(id_column, F.col(text_column).cast("string")).mapInArrow(apply, schema)
        out = hits if out is None else out.unionAll(hits)
    if out is None:
        return spark.createDataFrame([], schema)
    return out.groupBy(id_column, item_column).agg(F.max("n_strings").alias("n_strings"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least_words: int = LEAST_WORDS, text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text") -> DataFrame:
    """The documents, all columns as they were, in which no test string occurs; a filter in one pass, nothing is joined."""
    spark = docs.sparkSession
    for group in _groups(benchmark, window, least_words, item_column, item_text_column):
        sent = spark.sparkContext.broadcast(group)

        def apply(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                for block in blocks(batch.column(text_column)):
                    for text in sent.value.texts(*normalise(block)):
                        keep[block.first + text] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(apply, docs.schema)
    return docs
