"""Repeated passages by a distributed suffix sort: front-coded sorted runs are exchanged and merged by prefix-aware loser trees.

A passage is ``PASSAGE`` words. Sorting the suffixes at every word would move the corpus many times over, so suffixes start at anchors only: of
the ``ANCHOR``-word runs within a passage the one with the smallest hash (the first of equals). Equal passages have the same anchor at
the same place, so nothing is lost, and about two words in 27 are anchors. Anchors whose run occurs in one document only are dropped by
one narrow aggregation; those that are left carry the hashes of the passages that chose them.

A suffix is the text from its anchor on, as far as a passage that chose the anchor reaches (``PASSAGE`` words at most, each followed by a space, so that order by bytes
is order by words). Each task sorts its suffixes by their text, cuts the run at splitters taken from a sample, and front-codes it: the bytes shared with the suffix
before, and those after. A range's runs meet in one task and are merged by a loser tree that keeps for each run the prefix it shares with the last suffix
out: if two differ in it the longer one goes first without a comparison, else comparison starts behind it. Splitters look at no more of a suffix than an anchor's words
are sure to have, so suffixes that share a passage meet.

The merge gives each suffix the prefix that it shares with its predecessor, and these delimit the suffixes that share any number of words. A passage that begins ``j`` words
before its anchor is repeated by those that share ``PASSAGE - j`` words from there on and the ``j`` words before, which travel with the suffix as text; so passages are compared
by their words throughout, hashes only choose anchors and leave out those of one document.

Results for edge cases: NULL, empty and shorter texts than a passage have none. Rows with a NULL id are left out. Rows that share an id count as one
document, so a passage repeated in them alone is not reported, nor is one repeated within one document. Words compare case-folded, without
punctuation. Texts of any length are worked on whole. An empty table gives an empty result. Further columns are ignored, whatever their names. Of the documents that hold a passage, the one with the smallest id keeps it.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ._common import Block, Substrings, Words, blocks, materialise, mix, words_of

PASSAGE = 50
ANCHOR = 25
#: Suffixes that one merging task gets, about, and that one sorted run has at least unless the task has fewer.
RANGE_SUFFIXES = 50_000
RUN_SUFFIXES = 100_000
_SAMPLE = 64
#: Sampled heads for each range that come to the driver, and the bytes of a head.
_HEADS, _HEAD_BYTES = 32, 48


def anchors(block: Block, passage: int = PASSAGE, anchor: int = ANCHOR) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, Substrings | None]:
    """Words; each anchor's document, word, first and last passage start, and run hash (word numbers count through the block)."""
    words = words_of(block)
    count = len(words.hashes)
    none = np.zeros(0, np.int64)
    if count < passage:
        return words, none, none, none, none, none.astype(np.uint64), None
    sums = Substrings(words.hashes)
    at = np.arange(count - anchor + 1)
    grams = sums.of(at, at + anchor)
    room = np.maximum(np.diff(words.offsets) - passage + 1, 0)
    doc = np.repeat(np.arange(block.size), room)
    starts = np.arange(len(doc)) - np.repeat(np.cumsum(room) - room, room) + words.offsets[:-1][doc]
    if not len(starts):
        return words, none, none, none, none, none.astype(np.uint64), None
    # smallest in each window by doubling: the value at the window's start and its place, the first of equals
    width, best, place = 1, grams, at
    wanted = passage - anchor + 1
    while width < wanted:
        step = min(width, wanted - width)
        left, right = best[: len(best) - step], best[step:]
        later = right < left
        best, place = np.where(later, right, left), np.where(later, place[step:], place[: len(place) - step])
        width += step
    chosen = place[starts]
    head = np.ones(len(starts), dtype=bool)
    head[1:] = (chosen[1:] != chosen[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(starts)) - 1
    return words, doc[first], chosen[first], starts[first], starts[last], grams[chosen[first]], sums


def _plain(words: Words) -> tuple[bytes, np.ndarray]:
    """All words of a block, each followed by a space, and where each begins."""
    length = words.ends - words.begins
    at = np.concatenate([[0], np.cumsum(length + 1)])
    out = np.full(at[-1], 32, dtype=np.uint8)
    inner = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(at[:-1], length) + inner] = words.folded[np.repeat(words.begins, length) + inner]
    return out.tobytes(), at


def _head_bytes(anchor: int) -> int:
    """How much of a suffix splitters see: what ``anchor`` words have at least, so that suffixes which share them fall in one range."""
    return min(_HEAD_BYTES, 2 * anchor)


def anchor_table(docs: DataFrame, passage: int, anchor: int) -> DataFrame:
    """``run, id, head`` for each anchor: its run's hash, and for a sample of runs the first bytes of the suffix."""
    size = _head_bytes(anchor)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                words, doc, at, _, _, runs, _ = anchors(block, passage, anchor)
                if not len(at):
                    continue
                heads: list[bytes | None] = [None] * len(at)
                picked = np.flatnonzero(runs % np.uint64(_SAMPLE) == 0)
                if len(picked):
                    raw, begin = _plain(words)
                    for k in picked.tolist():
                        heads[k] = raw[begin[at[k]] : begin[at[k]] + size]
                # a document's equal runs count once
                yield pa.RecordBatch.from_arrays([pa.array(runs.view(np.int64)), batch.column(0).take(pa.array(block.first + doc)), pa.array(heads, pa.binary())], ["run", "id", "head"])

    return docs.mapInArrow(apply, T.StructType([T.StructField("run", T.LongType()), docs.schema.fields[0], T.StructField("head", T.BinaryType())]))


class LoserTree:
    """Merges sorted runs of byte strings, each with the length of the prefix it shares with the one before in its run.

    Yields (run, place in the run, prefix shared with the last string out). Prefixes count whole units of ``unit`` bytes.
    """

    def __init__(self, runs: list[tuple[list[bytes], list[int]]], unit: int = 1) -> None:
        self.runs, self.unit = runs, unit
        self.compared = 0  # bytes looked at, for tests

    def _shared(self, a: bytes, b: bytes, known: int) -> int:
        """Whole units that ``a`` and ``b`` share, given that the first ``known`` are equal."""
        skip = known * self.unit
        a, b = a[skip:], b[skip:]
        size = min(len(a), len(b))
        x = int.from_bytes(a[:size], "big") ^ int.from_bytes(b[:size], "big")
        same = size if not x else size - (x.bit_length() + 7) // 8
        self.compared += min(size, same + 1)
        return known + same // self.unit

    def __iter__(self) -> Iterator[tuple[int, int, int]]:
        runs = self.runs
        count = len(runs)
        size = 1
        while size < count:
            size *= 2
        place = [0] * size
        key: list[bytes | None] = [runs[r][0][0] if r < count and runs[r][0] else None for r in range(size)]
        prefix = [0] * size  # shared with the last string out
        loser = [-1] * size

        def duel(a: int, b: int) -> tuple[int, int]:
            """Winner and loser; the loser's prefix becomes the one it shares with the winner."""
            x, y = key[a], key[b]
            if y is None:
                return a, b
            if x is None:
                return b, a
            if prefix[a] != prefix[b]:
                # the longer prefix goes first; the other one shares its own prefix with the winner as well
                return (a, b) if prefix[a] > prefix[b] else (b, a)
            shared = self._shared(x, y, prefix[a])
            skip = shared * self.unit
            if x[skip:] < y[skip:] or (x[skip:] == y[skip:] and a < b):
                prefix[b] = shared
                return a, b
            prefix[a] = shared
            return b, a

        winners = list(range(size))
        level = size // 2
        tops = winners
        while level >= 1:
            new = []
            for k in range(level):
                win, lose = duel(tops[2 * k], tops[2 * k + 1])
                loser[level + k] = lose
                new.append(win)
            tops, level = new, level // 2
        best = tops[0]
        while key[best] is not None:
            yield best, place[best], prefix[best]
            place[best] += 1
            strings, shared = runs[best]
            if place[best] < len(strings):
                key[best], prefix[best] = strings[place[best]], shared[place[best]]
            else:
                key[best] = None
            node = (size + best) // 2
            while node >= 1:
                best, loser[node] = duel(best, loser[node])
                node //= 2


def shared_bytes(a: bytes, b: bytes) -> int:
    size = min(len(a), len(b))
    x = int.from_bytes(a[:size], "big") ^ int.from_bytes(b[:size], "big")
    return size if not x else size - (x.bit_length() + 7) // 8


def encode(keys: list[bytes]) -> tuple[np.ndarray, bytes]:
    """A sorted run, front-coded: the bytes each string shares with the one before, and the rest of it."""
    shared, tails, last = np.zeros(len(keys), np.int32), [], b""
    for k, key in enumerate(keys):
        same = len(key) if key is last else shared_bytes(last, key)
        shared[k] = same
        tails.append(key[same:])
        last = key
    return shared, b"".join(tails)


def decode(shared: np.ndarray, length: np.ndarray, tails: bytes) -> list[bytes]:
    """A front-coded run's strings; equal neighbours are one object."""
    out, at, last = [], 0, b""
    for same, size in zip(shared.tolist(), length.tolist()):
        if same < size or size < len(last):
            last = last[:same] + tails[at : at + size - same]
            at += size - same
        out.append(last)
    return out


#: What travels of a suffix besides its text: shared bytes, length, the first passage's place, words from there to the anchor, passages, bytes of the words before.
_FIELDS = 6


def suffix_runs(docs: DataFrame, splitters: list[bytes], passage: int, anchor: int) -> DataFrame:
    """Front-coded sorted runs, cut at the splitters. ``docs`` has ``id, text, hot``: the runs of each document that others have too."""
    id_field = docs.schema.fields[0]
    size = _head_bytes(anchor)
    schema = T.StructType([T.StructField("part", T.IntegerType()), *(T.StructField(c, T.BinaryType()) for c in ("fields", "tails", "backs")), T.StructField("ids", T.ArrayType(id_field.dataType))])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        keys: list[bytes] = []
        backs: list[bytes] = []
        fields: list[np.ndarray] = []
        ids: list[pa.Array] = []

        def emit() -> pa.RecordBatch:
            order = sorted(range(len(keys)), key=keys.__getitem__)
            every, owner = np.concatenate(fields), pa.concat_arrays(ids)
            part = [bisect_right(splitters, keys[k][:size]) for k in order]
            edges = [k for k in range(len(order)) if not k or part[k] != part[k - 1]]
            out: list[list] = [[] for _ in range(5)]
            for a, b in zip(edges, [*edges[1:], len(order)]):
                own = order[a:b]
                strings = [keys[k] for k in own]
                shared, tails = encode(strings)
                behind = [backs[k] for k in own]
                table = np.column_stack([shared, [len(s) for s in strings], every[own], [len(s) for s in behind]]).astype(np.int32)
                made = (part[a], squeeze.compress(np.ascontiguousarray(table.T).tobytes()), squeeze.compress(tails), squeeze.compress(b"".join(behind)), owner.take(pa.array(own, pa.int64())))
                for column, value in zip(out, made):
                    column.append(value)
            for held in (keys, backs, fields, ids):
                held.clear()
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, out[4])]), pa.int32()), pa.concat_arrays(out[4]))
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *(pa.array(c, pa.binary()) for c in out[1:4]), lists], schema.names)

        for batch in batches:
            hot = batch.column(2)
            ends = hot.offsets.to_numpy()
            values = hot.values.to_numpy(zero_copy_only=False).view(np.uint64)
            for block in blocks(batch.column(1)):
                words, doc, at, first, last, runs, _ = anchors(block, passage, anchor)
                if not len(at):
                    continue
                low, high = ends[block.first], ends[block.last]
                owner = np.repeat(np.arange(block.size), np.diff(ends[block.first : block.last + 1]))
                salt = mix(np.arange(1, block.size + 1, dtype=np.uint64))
                kept = np.flatnonzero(np.isin(runs ^ salt[doc], values[low:high] ^ salt[owner]))
                if not len(kept):
                    continue
                doc, at, first, last = doc[kept], at[kept], first[kept], last[kept]
                raw, begin = _plain(words)
                keys += [raw[a:b] for a, b in zip(begin[at].tolist(), begin[last + passage].tolist())]
                backs += [raw[a:b] for a, b in zip(begin[first].tolist(), begin[at].tolist())]
                fields.append(np.column_stack([first - words.offsets[doc], at - first, last - first + 1]))
                ids.append(batch.column(0).take(pa.array(block.first + doc)))
            if len(keys) >= RUN_SUFFIXES:
                yield emit()
        if keys:
            yield emit()

    return docs.mapInArrow(apply, schema)


def merge_range(runs: list[tuple[list[bytes], list[int]]]) -> tuple[np.ndarray, np.ndarray]:
    """Merge a range's runs: each suffix's number (runs one after the other), in sorted order, and how many words it shares with the one before."""
    base = np.cumsum([0, *(len(strings) for strings, _ in runs)]).tolist()
    order, words = [], []
    for run, place, prefix in LoserTree(runs):
        order.append(base[run] + place)
        words.append(runs[run][0][place].count(b" ", 0, prefix))
    return np.array(order, np.int64), np.array(words, np.int64)


def repeated(runs: list[dict], ids: pa.Array, passage: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Passages in two documents or more: (suffix row, first start, last start, row of the keeping document)."""
    spread = zstandard.ZstdDecompressor()
    tables = [np.frombuffer(spread.decompress(run["fields"]), np.int32).reshape(_FIELDS, -1) for run in runs]
    order, shared = merge_range([(decode(t[0], t[1], spread.decompress(run["tails"])), t[0].tolist()) for t, run in zip(tables, runs)])
    _, _, first, back, count, _ = np.concatenate(tables, axis=1)[:, order].astype(np.int64)
    # the words before each anchor, numbered, the nearest first
    behind = [spread.decompress(run["backs"]) for run in runs]
    numbers: dict[bytes, int] = {}
    flat = np.array([numbers.setdefault(w, len(numbers)) for text in behind for w in text.split()], dtype=np.int64)
    all_back = np.concatenate([t[3] for t in tables]).astype(np.int64)
    ends = np.cumsum(all_back)[order]
    # documents by rank, so that ids of any type compare
    dense = np.asarray(pc.rank(ids, tiebreaker="dense")).astype(np.int64)[order]
    alike = np.zeros(len(order), dtype=np.int64)  # the class of the words before, as far as they are looked at
    rows, starts, keepers = [], [], []
    for j in range(int(back.max(initial=0)) + 1):
        if j:
            there = np.flatnonzero(back >= j)
            key = alike[there] * (len(numbers) + 1) + flat[ends[there] - j]
            alike[there] = np.unique(key, return_inverse=True)[1]
        own = np.flatnonzero((back >= j) & (back - count < j))
        if len(own) < 2:
            continue
        interval = np.cumsum(shared < passage - j)
        key = interval[own] * (len(order) + 1) + alike[own]
        by = np.lexsort((dense[own], key))
        own, key = own[by], key[by]
        new = np.ones(len(own), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        begins = np.flatnonzero(new)
        cls = np.cumsum(new) - 1
        ending = np.append(begins[1:], len(own)) - 1
        keep = np.flatnonzero((dense[own[begins]] != dense[own[ending]])[cls])
        rows.append(own[keep])
        starts.append((first + back - j)[own[keep]])
        keepers.append(own[begins][cls[keep]])
    none = np.zeros(0, np.int64)
    row, start, keeper = (np.concatenate([none, *parts]) for parts in (rows, starts, keepers))
    by = np.lexsort((start, row))
    row, start, keeper = row[by], start[by], keeper[by]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1) | (dense[keeper[1:]] != dense[keeper[:-1]])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(row)) - 1
    return order[row[at]], start[at], start[last] if len(row) else start, order[keeper[at]]


def passages(docs: DataFrame, passage: int = PASSAGE, anchor: int | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, first_word, end_word, kept_id, is_kept``: maximal spans of words all of whose passages occur in other documents too.

    ``kept_id`` is the smallest id that holds the passages; its own spans have ``is_kept`` true. Words count from 0, ``end_word`` is exclusive.
    """
    anchor = max(1, passage // 2) if anchor is None else anchor
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")).where("id is not null and text is not null")
    table = materialise(anchor_table(texts, passage, anchor))
    hot = table.groupBy("run").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high").select("run")
    by_doc = materialise(table.select("run", "id").join(hot, "run", "left_semi").groupBy("id").agg(F.collect_set("run").alias("hot")))
    suffixes = by_doc.agg(F.sum(F.size("hot").cast("bigint"))).first()[0] or 0
    parts = max(1, -(-suffixes // RANGE_SUFFIXES))
    splitters: list[bytes] = []
    if parts > 1:
        # runs are sampled whole, so that frequent ones weigh as much as they have suffixes; few enough heads for each range come to the driver
        step = max(1, suffixes // _SAMPLE // (parts * _HEADS))
        sample = table.where(F.col("head").isNotNull() & (F.pmod(F.xxhash64("run"), F.lit(step)) == 0)).join(hot, "run", "left_semi")
        heads = sorted(bytes(r.head) for r in sample.select("head").collect())
        splitters = sorted({heads[k * len(heads) // parts] for k in range(1, parts)}) if heads else []
    runs = suffix_runs(texts.join(by_doc, "id").select("id", "text", "hot"), splitters, passage, anchor)
    # a task for each range: hashed part numbers would give some tasks several ranges and others none
    ranges = runs.repartitionById(parts, "part")
    id_field = T.StructField("id", texts.schema["id"].dataType)
    schema = T.StructType([id_field, T.StructField("first", T.LongType()), T.StructField("last", T.LongType()), T.StructField("kept", id_field.dataType)])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def whole() -> Iterator[tuple[list[dict], pa.Array]]:
            held, ids, part = [], [], None
            for batch in batches:
                lists = batch.column("ids")
                for k in range(batch.num_rows):
                    own = batch.column("part")[k].as_py()
                    if part is not None and own != part:
                        yield held, pa.concat_arrays(ids)
                        held, ids = [], []
                    part = own
                    held.append({c: batch.column(c)[k].as_py() for c in ("fields", "tails", "backs")})
                    ids.append(lists[k].values)
            if held:
                yield held, pa.concat_arrays(ids)

        for held, ids in whole():
            row, first, last, keeper = repeated(held, ids, passage)
            if len(row):
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), pa.array(first), pa.array(last), ids.take(pa.array(keeper))], schema.names)

    found = materialise(ranges.mapInArrow(apply, schema))
    same = W.partitionBy("id", "kept").orderBy("first", "last")
    reach = F.max("last").over(same.rowsBetween(W.unboundedPreceding, -1))
    islands = found.withColumn("new", (reach.isNull() | (F.col("first") > reach + 1)).cast("int")).withColumn("island", F.sum("new").over(same))
    spans = islands.groupBy("id", "kept", "island").agg(F.min("first").alias("first_word"), (F.max("last") + passage).alias("end_word"))
    return spans.select(F.col("id").alias(id_column), "first_word", "end_word", F.col("kept").alias(f"kept_{id_column}"), (F.col("id") == F.col("kept")).alias("is_kept"))
