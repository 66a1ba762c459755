"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of a bounded, deterministic sample of labelled rows (at most ``train_rows`` per label, a documented
parameter); scoring broadcasts the log-probability matrix (``labels x buckets``, a fixed size) and multiplies it with each
block's sparse count rows in numpy. One pass over the texts, no shuffle of texts.

Characters: ASCII and Latin-1 capitals are folded, every run of ASCII non-letters counts as one space, and each text starts and
ends with a space. A further class spreads its probability evenly over all buckets; where it beats every language, the text
is in none of them.

Results for edge cases: a NULL or empty text, or one without letters, gets language NULL, score NULL and ``accepted`` false. Rows with a NULL id, repeated
rows and ties are scored each for itself; of equally likely labels the first in alphabetical order wins. An empty table gives an
empty result; without any labelled row every text gets language NULL and ``accepted`` false. Further columns are ignored by
``identify`` and kept by ``keep_known_languages``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ._common import Block, blocks, fold_case

ORDERS = (1, 2, 3)
BUCKET_BITS = 14
SMOOTHING = 0.1
TRAIN_ROWS = 400
#: Cells of the dense counting table of one round of documents.
_CELLS = 1 << 19
_SPACE = 32


@dataclass(frozen=True)
class Model:
    labels: tuple[str, ...]
    log_probabilities: np.ndarray  # (buckets, labels), float64
    orders: tuple[int, ...] = ORDERS


def characters(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Case-folded characters of a block, each text between spaces, and the texts' offsets into them."""
    data = fold_case(block.data)
    count = block.size
    letter = (data >= 128) | ((data >= 97) & (data <= 122))
    previous = np.zeros(len(data), dtype=bool)
    previous[1:] = letter[:-1]
    if len(data):
        inner = block.starts[:-1][block.starts[:-1] < len(data)]
        previous[inner] = False
    # a non-letter is kept, as a space, where it follows a letter; continuation bytes go into their character
    lead = (letter & ((data & 0xC0) != 0x80)) | (~letter & previous)
    at = np.flatnonzero(lead)
    chars = np.where(letter[at], data[at], _SPACE).astype(np.uint64)
    wide = np.flatnonzero(chars >= 0xC0)
    for step in (1, 2, 3):
        if not len(wide):
            break
        place = at[wide] + step
        inside = place < len(data)
        wide, place = wide[inside], place[inside]
        more = (data[place] & 0xC0) == 0x80
        wide, place = wide[more], place[more]
        chars[wide] = (chars[wide] << np.uint64(8)) | data[place]
    offsets = np.searchsorted(at, block.starts)
    ends_open = np.zeros(count, dtype=np.int64)  # a text that ends in a letter gets a closing space
    filled = offsets[1:] > offsets[:-1]
    ends_open[filled] = chars[offsets[1:][filled] - 1] != _SPACE
    grown = np.concatenate([[0], np.cumsum(np.diff(offsets) + filled + ends_open)])
    out = np.full(grown[-1], _SPACE, dtype=np.uint64)
    place = np.arange(len(chars)) + np.repeat(grown[:-1] - offsets[:-1] + filled, np.diff(offsets))
    out[place] = chars
    return out, grown


def _gram_hashes(chars: np.ndarray, order: int) -> np.ndarray:
    """A bucket for the n-gram that ends at each character from ``order - 1`` on."""
    mixed = chars * np.uint64(0x9E3779B97F4A7C15)
    size = len(chars) - order + 1
    out = mixed[order - 1 :].copy()
    for back in range(1, order):
        out += mixed[order - 1 - back : order - 1 - back + size] * np.uint64((0xC2B2AE3D27D4EB4F ** (back + 1)) & (2**64 - 1))
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9 ^ (order << 1))
    out >>= np.uint64(64 - BUCKET_BITS)
    return out.astype(np.int32)


def sparse_counts(block: Block, orders: tuple[int, ...] = ORDERS) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Count rows in compressed form for rounds of documents: (first document, row, bucket, count) arrays."""
    chars, offsets = characters(block)
    lengths = np.diff(offsets)
    width = 1 << BUCKET_BITS
    step = max(1, _CELLS // width)
    grams = {n: _gram_hashes(chars, n) for n in orders if len(chars) >= n}
    for first in range(0, block.size, step):
        last = min(block.size, first + step)
        low, high = offsets[first], offsets[last]
        row = np.repeat(np.arange(last - first), lengths[first:last])
        keys = []
        for n, hashed in grams.items():
            place = np.arange(low, high)
            inside = place - np.repeat(offsets[first:last], lengths[first:last]) >= n - 1
            place = place[inside]
            keys.append(row[inside] * width + hashed[place - (n - 1)])
        counts = np.bincount(np.concatenate(keys), minlength=1) if keys and high > low else np.zeros(1, np.int64)
        cells = np.flatnonzero(counts)
        yield first, cells // width, cells % width, counts[cells]


def score(block: Block, matrix: np.ndarray, orders: tuple[int, ...] = ORDERS) -> np.ndarray:
    """Summed log-probabilities (documents x labels): the sparse count rows times the matrix; NaN for texts without n-grams."""
    out = np.full((block.size, matrix.shape[1]), np.nan)
    for first, row, bucket, count in sparse_counts(block, orders):
        if not len(row):
            continue
        heads = np.flatnonzero(np.diff(row, prepend=-1))
        out[first + row[heads]] = np.add.reduceat(matrix[bucket] * count[:, None], heads, axis=0)
    return out


def train(labelled: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang", train_rows: int = TRAIN_ROWS, orders: tuple[int, ...] = ORDERS) -> Model:
    """Fit on at most ``train_rows`` rows of each label, those with the smallest hash of the id.

    The sample is chosen from ids and labels alone (pruned columns); only its own texts are read.
    """
    ids = labelled.select(F.col(label_column).alias("label"), F.col(id_column).alias("id")).where("label is not null and id is not null")
    rank = F.row_number().over(W.partitionBy("label").orderBy(F.xxhash64("id"), "id"))
    sample = ids.withColumn("rank", rank).where(F.col("rank") <= train_rows).select("id").distinct()
    texts = labelled.select(F.col(id_column).alias("id"), F.col(label_column).alias("label"), F.col(text_column).cast("string").alias("text")).where("label is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = batch.column("label").to_pylist()
            for block in blocks(batch.column("text")):
                for first, row, bucket, times in sparse_counts(block, orders):
                    for r in np.unique(row):
                        own = row == r
                        total = totals.setdefault(labels[block.first + first + r], np.zeros(1 << BUCKET_BITS, np.int64))
                        total[bucket[own]] += times[own]
        for label, total in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([label]), pa.array([total.tobytes()], pa.binary())], ["label", "counts"])

    # at most labels x tasks fixed-size rows come to the driver; neither grows with the corpus, as the sample is bounded
    part = texts.join(F.broadcast(sample), "id", "left_semi").select("label", "text").coalesce(8).mapInArrow(count, "label string, counts binary")
    merged: dict[str, np.ndarray] = {}
    for row in part.collect():
        merged[row.label] = merged.get(row.label, 0) + np.frombuffer(row.counts, np.int64)
    return fit(merged, orders)


def fit(counts: dict[str, np.ndarray], orders: tuple[int, ...] = ORDERS) -> Model:
    labels = tuple(sorted(counts))
    if not labels:
        return Model((), np.zeros((1 << BUCKET_BITS, 0)), orders)
    table = np.stack([counts[label] for label in labels], axis=1).astype(np.float64) + SMOOTHING
    return Model(labels, np.log(table / table.sum(axis=0)), orders)


def identify(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """``id, language, score, margin, accepted`` for every row, with the columns in ``carry`` as they are.

    ``score`` is the mean log-probability of an n-gram, ``margin`` the lead over the next label, per n-gram.
    """
    spark = docs.sparkSession
    uniform = -BUCKET_BITS * np.log(2.0)
    matrix = np.concatenate([model.log_probabilities, np.full((1 << BUCKET_BITS, 1), uniform)], axis=1)
    sent = spark.sparkContext.broadcast((model.labels, matrix, model.orders))
    kept = docs.select(F.col(id_column), F.col(text_column), *carry)
    own = [c for c in ("language", "score", "margin", "accepted")]
    schema = T.StructType([f for f in kept.schema.fields if f.name == id_column or f.name in carry] + [T.StructField(c, t) for c, t in zip(own, (T.StringType(), T.DoubleType(), T.DoubleType(), T.BooleanType()))])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, table, orders = sent.value
        names = np.array([*labels, None], dtype=object)
        for batch in batches:
            best = np.full(batch.num_rows, len(labels))
            mean, lead, known = np.full(batch.num_rows, np.nan), np.full(batch.num_rows, np.nan), np.zeros(batch.num_rows, bool)
            for block in blocks(batch.column(text_column)) if labels else ():
                total = score(block, table, orders)
                some = np.flatnonzero(~np.isnan(total[:, 0]))
                languages = total[some, :-1]
                winner = languages.argmax(axis=1)
                top = languages[np.arange(len(some)), winner]
                grams = total[some, -1] / uniform
                at = block.first + some
                best[at], mean[at] = winner, top / grams
                if len(labels) > 1:
                    lead[at] = (top - np.partition(languages, -2, axis=1)[:, -2]) / grams
                known[at] = top >= total[some, -1]
            columns = [batch.column(f.name) for f in schema.fields[:-4]]
            made = [pa.array(names[best], pa.string()), pa.array(mean, from_pandas=True), pa.array(lead, from_pandas=True), pa.array(known)]
            yield pa.RecordBatch.from_arrays(columns + made, [f.name for f in schema.fields])

    return kept.mapInArrow(apply, schema)


def keep_known_languages(docs: DataFrame, model: Model, languages: tuple[str, ...] | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents, all columns as they were, whose text is in a language of ``languages`` (default: any the model knows)."""
    spark = docs.sparkSession
    uniform = -BUCKET_BITS * np.log(2.0)
    matrix = np.concatenate([model.log_probabilities, np.full((1 << BUCKET_BITS, 1), uniform)], axis=1)
    sent = spark.sparkContext.broadcast((model.labels, matrix, model.orders))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, table, orders = sent.value
        wanted = np.array([languages is None or label in languages for label in labels], dtype=bool)
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            if labels:
                for block in blocks(batch.column(text_column)):
                    total = score(block, table, orders)
                    some = np.flatnonzero(~np.isnan(total[:, 0]))
                    winner = total[some, :-1].argmax(axis=1)
                    keep[block.first + some] = wanted[winner] & (total[some, winner] >= total[some, -1])
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(apply, docs.schema)
