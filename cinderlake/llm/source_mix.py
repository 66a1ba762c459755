"""Mixing sources to target weights by Pfair scheduling.

A source with weight ``q`` of ``Q`` in all has a rate ``w = q / Q``. Its block ``i`` (from 1) is released at slot
``floor((i - 1) / w)`` and due by slot ``ceil(i / w)``; of the released blocks the earliest deadline goes first (ties: the
greater weight, then the source's name). With the rates summing to one this keeps every source within less than one block of its
ideal share at every slot. Integer weights make the schedule repeat every ``Q`` slots, so at most one period of a phase is computed, with two heaps, on
the driver. When a source runs out of blocks the rest go on, their rates divided by their sum, as a new phase; each phase holds its own bound.
The schedule has at most as many entries as there are blocks, and as sources times the sum of weights (each source ends one phase). Every document comes out exactly once.

The schedule reaches the documents' ranks as sorted arrays, by binary search in Arrow batches; it is broadcast in parts of at most ``SCHEDULE_BYTES``, each part with
the sources of one range of names, however many sources there are.

Ranks within a source come from a salted hash order: counts per (source, hash range) are summed, and rows are numbered within each range, so no
task ever holds a whole source.

Results for edge cases: a NULL source is a source of its own with the default weight. A NULL id, repeated rows and ties in the
hash order are ordered by all that is known of them; rows equal in id and source take neighbouring places. Texts play no part. An empty table
gives an empty result. Sources with weight zero or below are refused. Texts may have any length; only ``mix`` carries them, whole. Further columns are kept by ``mix``
as they are; where one has the name of the position column, the position takes the next free name (``mix_position_2`` and so on).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ._common import free_name, materialise

BLOCK_DOCS = 16
#: Production weights: four favoured sources, one share for every other.
WEIGHTS = {"src1": 6, "src2": 4, "src3": 3, "src4": 2}
DEFAULT_WEIGHT = 1
#: Rows that one numbering task sorts, about.
RANGE_ROWS = 200_000
#: Bytes of the schedule that are broadcast at once.
SCHEDULE_BYTES = 64 << 20


def phases(blocks: dict[str | None, int], weights: dict[str | None, int]) -> Iterator[dict]:
    """The schedule as phases: start and length in slots, the period, and for each source its first block, how many it gets, and the slots of its first turns.

    A phase ends right after the last block of the first source to run out.
    """
    left = {s: n for s, n in blocks.items() if n}
    first, start = dict.fromkeys(left, 0), 0
    names = sorted(left, key=lambda s: (-weights[s], s is None, s or ""))
    while left:
        names = [s for s in names if s in left]
        share, rest = [weights[s] for s in names], [left[s] for s in names]
        size = sum(share)
        turns: list[list[int]] = [[] for _ in names]
        waiting, ready = [(0, k) for k in range(len(names))], []  # by release; by deadline, then in the order of names
        heapify(waiting)
        length = 0
        for slot in range(size):
            while waiting and waiting[0][0] <= slot:
                k = heappop(waiting)[1]
                heappush(ready, (-(-(len(turns[k]) + 1) * size // share[k]), k))
            deadline, k = heappop(ready)
            assert deadline > slot, "rates that sum to one always leave a released block in time"
            own = turns[k]
            own.append(slot)
            if len(own) == rest[k]:
                length = slot + 1
                break
            if len(own) < share[k]:
                heappush(waiting, (len(own) * size // share[k], k))
        if not length:  # nobody runs out within the first period, so all of its turns are known and repeat
            length = 1 + min((n - 1) // q * size + own[(n - 1) % q] for n, q, own in zip(rest, share, turns))
        whole, part = divmod(length, size)
        used = [whole * q + sum(slot < part for slot in own) if whole else len(own) for q, own in zip(share, turns)]
        yield {"start": start, "length": length, "size": size, "sources": [(s, first[s], n, q, own) for s, n, q, own in zip(names, used, share, turns) if n]}
        start += length
        for s, n in zip(names, used):
            first[s] += n
            left[s] -= n
        left = {s: n for s, n in left.items() if n}


@dataclass
class Schedule:
    """Sorted arrays: the spans of ``names[i]``'s blocks that one phase places, and the slots of a period's turns."""

    names: list
    spans: np.ndarray  # (key, phase, first block, start, size, weight, place of the first turn); key = source << 40 | first block
    turns: np.ndarray
    gaps: np.ndarray  # slots after which documents are missing, as a block was short
    missing: np.ndarray  # how many documents then are

    @property
    def bytes(self) -> int:
        return self.spans.nbytes + self.turns.nbytes

    def place(self, source: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phase and slot of each block."""
        own = self.spans[np.searchsorted(self.spans[:, 0], (source << 40) | block, side="right") - 1]
        _, phase, first, start, size, weight, at = own.T
        whole, turn = np.divmod(block - first, weight)
        return phase, start + whole * size + self.turns[at + turn]

    def lacking(self, slot: np.ndarray) -> np.ndarray:
        return self.missing[np.searchsorted(self.gaps, slot, side="left")]

    def of(self, low: int, high: int) -> Schedule:
        """The same for the sources ``low`` to ``high`` (exclusive) alone."""
        own = self.spans[np.searchsorted(self.spans[:, 0], low << 40) : np.searchsorted(self.spans[:, 0], high << 40)].copy()
        counts = np.minimum(own[:, 5], _turn_counts(own, len(self.turns), self.spans))
        turns = np.concatenate([self.turns[a : a + n] for a, n in zip(own[:, 6].tolist(), counts.tolist())]) if len(own) else self.turns[:0]
        own[:, 6] = np.cumsum(counts) - counts
        own[:, 0] -= low << 40
        return Schedule(self.names[low:high], own, turns, self.gaps, self.missing)


def _turn_counts(own: np.ndarray, total: int, spans: np.ndarray) -> np.ndarray:
    """Turns of each span: up to the next span's first turn."""
    begins = np.append(np.sort(spans[:, 6]), total)
    return begins[np.searchsorted(begins, own[:, 6], side="right")] - own[:, 6]


def plan(rows: dict[str | None, int], weights: dict[str | None, int], block_docs: int) -> Schedule:
    """The whole schedule of sources with so many rows; names in the order of their bytes, NULL first."""
    names = sorted(rows, key=lambda s: (s is not None, (s or "").encode()))
    number = {s: k for k, s in enumerate(names)}
    spans, turns, at, last = [], [], 0, {}
    for phase, made in enumerate(phases({s: -(-n // block_docs) for s, n in rows.items()}, weights)):
        for s, first, n, q, own in made["sources"]:
            own = own[: min(q, n)]
            spans.append(((number[s] << 40) | first, phase, first, made["start"], made["size"], q, at))
            turns.append(np.array(own, np.int64))
            at += len(own)
            last[s] = made["start"] + (n - 1) // q * made["size"] + own[(n - 1) % q]
    table = np.array(spans, np.int64).reshape(-1, 7)
    short = sorted((last[s], -n % block_docs) for s, n in rows.items() if n % block_docs)
    gaps = np.array([place for place, _ in short], np.int64)
    missing = np.cumsum([0, *(lack for _, lack in short)]).astype(np.int64)
    return Schedule(names, table[np.argsort(table[:, 0])], np.concatenate(turns) if turns else np.zeros(0, np.int64), gaps, missing)


def _ranked(docs: DataFrame, id_column: str, source_column: str, seed: int) -> tuple[DataFrame, dict[str | None, int]]:
    """``id, source, rank`` for every row (rank from 0 within its source), and the rows of each source."""
    keyed = docs.select(F.col(id_column).alias("id"), F.col(source_column).cast("string").alias("source")).withColumn("key", F.xxhash64(F.lit(seed), F.col("id").cast("string"), "source"))
    keyed = materialise(keyed)
    bits = 62  # hash ranges are the key's leading bits; how many follows from the number of rows
    rows = keyed.count()
    ranges = 1
    while rows / (1 << ranges) > RANGE_ROWS:
        ranges += 1
    keyed = keyed.withColumn("range", F.shiftrightunsigned("key", bits + 2 - ranges))
    counts = keyed.groupBy("source", "range").agg(F.count("*").alias("n"))
    before = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    offsets = materialise(counts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))))
    numbered = keyed.withColumn("at", F.row_number().over(W.partitionBy("source", "range").orderBy("key", "id")) - 1)
    ranked = numbered.join(offsets.select(F.col("source").alias("s"), F.col("range").alias("r"), "offset"), F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r"))).select("id", "source", (F.col("at") + F.col("offset")).alias("rank"))
    sizes = {r.source: r.n for r in offsets.groupBy("source").agg(F.sum("n").alias("n")).collect()}  # one row for each source
    return ranked, sizes


def schedule(docs: DataFrame, weights: dict[str, int] | None = None, default_weight: int = DEFAULT_WEIGHT, block_docs: int = BLOCK_DOCS, id_column: str = "doc_id", source_column: str = "source", seed: int = 0, schedule_bytes: int = SCHEDULE_BYTES) -> DataFrame:
    """``id, source, block, phase, slot, position``: where each document goes; positions are 0 to rows - 1 without gaps."""
    spark = docs.sparkSession
    weights = WEIGHTS if weights is None else weights
    if min([default_weight, block_docs, *weights.values()]) <= 0:
        raise ValueError("weights and block size must be positive")
    ranked, sizes = _ranked(docs, id_column, source_column, seed)
    made = plan(sizes, {s: weights.get(s, default_weight) for s in sizes}, block_docs)
    parts = -(-made.bytes // schedule_bytes) if sizes else 1
    step = max(1, -(-len(made.names) // max(1, parts)))
    schema = T.StructType([f for f in ranked.schema.fields if f.name != "rank"] + [T.StructField("block", T.LongType()), T.StructField("phase", T.IntegerType()), T.StructField("slot", T.LongType()), T.StructField("position", T.LongType())])
    out = None
    for low in range(0, max(1, len(made.names)), step):
        own = made.of(low, low + step) if parts > 1 else made
        sent = spark.sparkContext.broadcast((pa.array(own.names, pa.string()), own))

        def apply(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            names, own = sent.value
            for batch in batches:
                source = pc.index_in(batch.column("source"), value_set=names).to_numpy(zero_copy_only=False).astype(np.int64)
                block, inside = np.divmod(batch.column("rank").to_numpy().astype(np.int64), block_docs)
                phase, slot = own.place(source, block) if len(source) else (source, source)
                position = slot * block_docs + inside - own.lacking(slot)
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("source"), pa.array(block), pa.array(phase.astype(np.int32)), pa.array(slot), pa.array(position)], schema.names)

        rows = ranked
        if parts > 1:
            named = [n for n in own.names if n is not None]
            rows = ranked.where((F.col("source").isNull() if None in own.names else F.lit(False)) | (F.col("source").between(named[0], named[-1]) if named else F.lit(False)))
        placed = rows.mapInArrow(apply, schema)
        out = placed if out is None else out.unionAll(placed)
    return out


def mix(docs: DataFrame, weights: dict[str, int] | None = None, default_weight: int = DEFAULT_WEIGHT, block_docs: int = BLOCK_DOCS, id_column: str = "doc_id", source_column: str = "source", seed: int = 0, position: str = "mix_position") -> DataFrame:
    """The documents in mixed order, with their place in the column ``position``; files hold consecutive places.

    Rows that share an id and a source get that many places between them, in no fixed order.
    """
    places = materialise(schedule(docs, weights, default_weight, block_docs, id_column, source_column, seed).select("id", "source", "position"))
    same = W.partitionBy("__id", "__s")
    clash = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select([F.col(f"`{c}`").alias(a) for c, a in clash.items()])
    lists = places.groupBy(F.col("id").alias("__id"), F.col("source").alias("__s")).agg(F.sort_array(F.collect_list("position")).alias("__places"))
    repeated = lists.where(F.size("__places") > 1).limit(1).count() > 0
    own_id, own_source = F.col(clash[id_column]), F.col(clash[source_column]).cast("string")
    joined = plain.join(lists, own_id.eqNullSafe(F.col("__id")) & own_source.eqNullSafe(F.col("__s")))
    at = F.row_number().over(same.orderBy(*[F.col(a) for c, a in clash.items()])) if repeated else F.lit(1)
    placed = joined.withColumn("__at", at).select([*clash.values(), F.element_at("__places", F.col("__at")).alias("__position")])
    rows = places.count()
    spark: SparkSession = docs.sparkSession
    parts = max(1, min(rows, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    target = F.floor(F.col("__position") * parts / max(rows, 1)).cast("int")
    return placed.repartitionById(parts, target).sortWithinPartitions("__position").toDF(*docs.columns, free_name(position, docs.columns))
