"""License scanning: MinHash bands over overlapping text windows retrieve templates, exact shingle containment verifies them.

Templates of similar length form a class with its own window length and stride: a stride of an eighth of the class length, and
windows a stride minus one word longer, so that any run of a template's length lies wholly in some window. The Jaccard similarity of that window and a
template of which it holds ``CONTAINMENT`` has a known lower bound, and each class takes so many bands of ``ROWS`` MinHash values that two sets at that bound collide
with probability ``RETRIEVAL`` at least. A window can only verify if enough of its shingles occur in templates of its class; windows that fail this exact
test are not hashed. Retrieved templates are verified on the words themselves: ``|shingles in both| / |template's shingles|``.

One pass over the texts, no shuffle; the templates are a fixed table and go with the tasks.

Results for edge cases: NULL, empty and wordless texts match nothing. NULL ids, repeated ids and repeated rows are scanned each for itself. Among equally good windows the
first counts. Templates of fewer words than a shingle are refused. An empty table gives an empty result. Further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import Block, Words, blocks, mix, words_of
from .licenses import TEMPLATES

SHINGLE = 3
CONTAINMENT = 0.8
RETRIEVAL = 0.999
ROWS = 2
_RATIO = 1.4
_STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def shingle_hashes(hashes: np.ndarray) -> np.ndarray:
    """A hash of each run of ``SHINGLE`` words (fewer words than that: one hash of all)."""
    size = max(1, len(hashes) - SHINGLE + 1) if len(hashes) else 0
    out = np.zeros(size, dtype=np.uint64)
    for k in range(min(SHINGLE, len(hashes))):
        out += hashes[k : k + size] * _STEPS[k]
    return mix(out)


class LengthClass:
    """The templates of one range of lengths, and the band tables that retrieve them."""

    def __init__(self, longest: int, members: list[tuple[str, np.ndarray, set]], containment: float) -> None:
        self.stride = max(1, longest // 8)
        self.window = longest + self.stride - 1
        self.members = members
        self.known = np.unique(np.concatenate([m[1] for m in members]))
        self.needed = min(ceil(containment * len(m[1]) - 1e-9) for m in members)
        room = max(1, self.window - SHINGLE + 1)
        bound = min(ceil(containment * len(m[1]) - 1e-9) / (room + len(m[1]) - ceil(containment * len(m[1]) - 1e-9)) for m in members)
        self.bands = max(1, ceil(log(1 - RETRIEVAL) / log(1 - min(bound, 0.999) ** ROWS)))
        seeds = mix(np.arange(1, 2 * self.bands * ROWS + 1, dtype=np.uint64)).reshape(2, -1)
        self._factor, self._shift = seeds[0] | np.uint64(1), seeds[1]
        self.tables: list[dict[int, list[int]]] = [{} for _ in range(self.bands)]
        for number, (_, shingles, _) in enumerate(members):
            for band, key in enumerate(self.keys(shingles)):
                self.tables[band].setdefault(key, []).append(number)

    def keys(self, shingles: np.ndarray) -> list[int]:
        least = (shingles[:, None] * self._factor + self._shift).min(axis=0).reshape(self.bands, ROWS)
        return mix(least[:, 0] * _STEPS[0] + least[:, 1] * _STEPS[1]).tolist()

    def retrieve(self, shingles: np.ndarray) -> set[int]:
        return {number for band, key in enumerate(self.keys(shingles)) for number in self.tables[band].get(key, ())}


def _words(text: str) -> tuple[Block, Words]:
    block = next(blocks(pa.array([text], pa.string())))
    return block, words_of(block)


def _grams(folded: bytes, words: Words, low: int, high: int) -> set:
    own = [folded[a:b] for a, b in zip(words.begins[low:high].tolist(), words.ends[low:high].tolist())]
    return {tuple(own[i : i + SHINGLE]) for i in range(max(1, len(own) - SHINGLE + 1))}


class Scanner:
    def __init__(self, templates: dict[str, str], containment: float = CONTAINMENT) -> None:
        self.containment = containment
        sized = []
        for name, text in templates.items():
            words = _words(text)[1]
            if len(words.begins) < SHINGLE:
                raise ValueError(f"template {name} has fewer than {SHINGLE} words")
            sized.append((len(words.begins), name, np.unique(shingle_hashes(words.hashes)), _grams(words.folded.tobytes(), words, 0, len(words.begins))))
        self.classes, rest = [], sorted(sized, key=lambda x: (x[0], x[1]))
        while rest:
            longest = max(n for n, *_ in rest if n <= max(rest[0][0] * _RATIO, rest[0][0]))
            self.classes.append(LengthClass(longest, [(a, b, c) for n, a, b, c in rest if n <= longest], containment))
            rest = [x for x in rest if x[0] > longest]
        self.known = np.unique(np.concatenate([c.known for c in self.classes]))
        self._maybe = np.zeros(1 << 16, dtype=bool)
        self._maybe[(self.known >> np.uint64(48)).astype(np.int64)] = True

    def scan(self, block: Block) -> Iterator[tuple[int, str, float, int]]:
        """(document, template, containment, first word of the best window)."""
        words = words_of(block)
        count = np.diff(words.offsets)
        if not len(words.hashes):
            return
        size = len(words.hashes)
        padded = np.concatenate([words.hashes, np.zeros(SHINGLE - 1, np.uint64)])
        hashed = mix(sum(padded[k : k + size] * _STEPS[k] for k in range(SHINGLE)))
        doc = np.repeat(np.arange(block.size), count)
        whole = np.arange(size) <= words.offsets[1:][doc] - SHINGLE  # shingles that end within their document
        hits = np.flatnonzero(whole & self._maybe[(hashed >> np.uint64(48)).astype(np.int64)])
        hits = hits[np.isin(hashed[hits], self.known)]
        if not len(hits):
            return
        folded = words.folded.tobytes()
        best: dict[tuple[int, str], tuple[float, int]] = {}
        for cls in self.classes:
            own = hits[np.isin(hashed[hits], cls.known)]
            if len(own) < cls.needed:
                continue
            begin = words.offsets[doc[own]]
            place = own - begin
            # the windows, by number within the document, that hold each hit's shingle
            reach = max(1, cls.window - SHINGLE + 1)
            last = place // cls.stride
            first = np.maximum(0, -(-(place - reach + 1) // cls.stride))
            times = last - first + 1
            number = np.repeat(first, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            start = np.repeat(begin, times) + number * cls.stride
            starts, held = np.unique(start, return_counts=True)
            for at in starts[held >= cls.needed].tolist():
                d = int(doc[at])
                end = min(at + cls.window, int(words.offsets[d + 1]))
                shingles = np.unique(hashed[at : max(at + 1, end - SHINGLE + 1)])
                grams = None
                for member in cls.retrieve(shingles):
                    name, _, template = cls.members[member]
                    grams = _grams(folded, words, at, end) if grams is None else grams
                    share = len(grams & template) / len(template)
                    if share >= self.containment and share > best.get((d, name), (0.0, 0))[0]:
                        best[d, name] = (share, at - int(words.offsets[d]))
        for (d, name), (share, at) in best.items():
            yield d, name, share, at


def scan(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, license, containment, word``: the templates that each document holds, and where the best window begins."""
    scanner = Scanner(TEMPLATES if templates is None else templates, containment)
    sent = docs.sparkSession.sparkContext.broadcast(scanner)  # a fixed table, whatever the corpus
    schema = T.StructType([T.StructField(id_column, docs.schema[id_column].dataType), T.StructField("license", T.StringType()), T.StructField("containment", T.DoubleType()), T.StructField("word", T.LongType())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = sent.value
        for batch in batches:
            found = [(block.first + d, name, share, at) for block in blocks(batch.column(1)) for d, name, share, at in scanner.scan(block)]
            if found:
                rows, names, shares, places = zip(*found)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(names), pa.array(shares, pa.float64()), pa.array(places, pa.int64())], schema.names)

    return docs.select(F.col(id_column), F.col(text_column).cast("string")).mapInArrow(apply, schema)
