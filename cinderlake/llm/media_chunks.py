"""Content-defined chunking of media payloads.

A gear hash rolls over the payload (``h = 2 h + G[byte]`` modulo 2**32, so it depends on the last 32 bytes only); a chunk ends where the hash's
``MASK_BITS`` leading bits are zero, but never below ``MIN_SIZE`` or above ``MAX_SIZE`` bytes. The hash of all positions is built in five
doubling steps in numpy. Chunks and payloads are addressed by SHA-256; a recipe is the ordered list of a payload's chunk digests.

Joins over digest prefixes alone decide what is stored: a chunk of one payload goes into that payload's pack, a chunk of several goes, once, from the
payload with the smallest digest into the table of shared chunks, and chunks or payloads that the store has are left out. Prefixes are 128 bits of a
chunk's digest and 64 bits of a payload's; what the store has is compared in full. Payloads move once, to meet that decision, each compressed with a dictionary
that is trained on at most ``SAMPLE`` payloads' first ``SAMPLE_BYTES`` (it changes sizes, never results); the receiving task cuts and digests them again, so
recipes do not travel. A pack holds its payload's recipe and the bytes of the chunks that are its own.

Reconstruction takes every chunk of the recipe in order, digests each slice against the recipe's digest and the whole against the payload's. A pack with
all its chunks is checked where it lies; the others, and recipes that the store does not hold in that form, are moved, and with them each shared chunk once for
every task that needs it.

Results for edge cases: a NULL payload has no recipe (NULL in all columns but the id), an empty one an empty recipe and counts as verified. NULL ids, repeated ids and
repeated rows are kept, row for row; equal payloads share their recipe. A payload is cut as a whole however long it is, in pieces of ``_STRIDE`` bytes that overlap. An
empty table gives an empty result. Further columns are ignored, whatever their names. A recipe with a missing chunk, a wrong digest or another order of chunks is not verified.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import cleaned, discard, materialise, mix, shared_folder, text_buffers

MIN_SIZE = 256
MASK_BITS = 10
MAX_SIZE = 8192
#: Payload bytes that one packing task gets, about.
BUCKET_BYTES = 16 << 20
_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_STRIDE = 1 << 22

SAMPLE, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 16 << 10, 110 << 10

RECIPE = "media binary, chunks array<binary>, sizes array<int>"
PACK = RECIPE + ", own array<int>, whole boolean, bytes binary"
SHARED = "chunk binary, bytes binary"


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash at each byte, over the 32 bytes that end there (fewer at the start)."""
    out = _GEAR[data]
    for step in (1, 2, 4, 8, 16):
        if len(out) > step:
            rolled = out.copy()
            rolled[step:] += out[:-step] << np.uint32(step)
            out = rolled
    return out


def cuts(data: np.ndarray, min_size: int = MIN_SIZE, mask_bits: int = MASK_BITS, max_size: int = MAX_SIZE) -> list[int]:
    """The ends of the payload's chunks."""
    marks = []
    for low in range(0, len(data), _STRIDE):  # pieces overlap by the hash's reach, so the marks are those of the whole
        start = max(0, low - 31)
        hashed = gear_hashes(data[start : low + _STRIDE])[low - start :]
        marks.append(np.flatnonzero(hashed >> np.uint32(32 - mask_bits) == 0) + low + 1)
    places = np.concatenate(marks).tolist() if marks else []
    out, begin, k, size = [], 0, 0, len(data)
    while begin < size:
        while k < len(places) and places[k] < begin + min_size:
            k += 1
        end = min(size, begin + max_size)
        if k < len(places) and places[k] < end:
            end = places[k]
        out.append(end)
        begin = end
    return out


def _payloads(media: DataFrame, payload_column: str) -> DataFrame:
    return media.select(F.col(payload_column).cast("binary").alias("payload")).where("payload is not null")


def _chunked(raw: bytes, ends: list[int]) -> list[bytes]:
    return [hashlib.sha256(raw[a:b]).digest() for a, b in zip([0, *ends], ends)]


def recipes(media: DataFrame, payload_column: str = "payload", min_size: int = MIN_SIZE, mask_bits: int = MASK_BITS, max_size: int = MAX_SIZE) -> DataFrame:
    """``media, chunks, sizes`` for each distinct payload; ``media`` is the payload's digest."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(0))
            whole, digests, sizes = [], [], []
            for k in range(batch.num_rows):
                payload = data[offsets[k] : offsets[k + 1]]
                ends, raw = cuts(payload, min_size, mask_bits, max_size), payload.tobytes()
                whole.append(hashlib.sha256(raw).digest())
                digests.append(_chunked(raw, ends))
                sizes.append(np.diff([0, *ends]).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(whole, pa.binary()), pa.array(digests, pa.list_(pa.binary())), pa.array(sizes, pa.list_(pa.int32()))], ["media", "chunks", "sizes"])

    return _payloads(media, payload_column).mapInArrow(apply, RECIPE).groupBy("media").agg(F.first("chunks").alias("chunks"), F.first("sizes").alias("sizes"))


def _prefix(digest: bytes, part: int = 0) -> int:
    return int.from_bytes(digest[8 * part : 8 * part + 8], "big", signed=True)


def _prefix_column(digest: Column, part: int = 0) -> Column:
    """``_prefix`` as an expression."""
    halves = [F.conv(F.hex(F.substring(digest, 8 * part + a, 4)), 16, 10).cast("bigint") for a in (1, 5)]
    return F.shiftleft(halves[0], 32).bitwiseOR(halves[1])


def _uses(media: DataFrame, payload_column: str) -> DataFrame:
    """``key, high, low, size``: each chunk of each payload once; a task tells equal payloads' chunks once."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            data, offsets = text_buffers(batch.column(0))
            rows: list[tuple[int, int, int, int]] = []
            for k in range(batch.num_rows):
                payload = data[offsets[k] : offsets[k + 1]]
                raw = payload.tobytes()
                whole = hashlib.sha256(raw).digest()
                if whole in seen:
                    continue
                seen.add(whole)
                ends, key = cuts(payload), _prefix(whole)
                own = dict(zip(_chunked(raw, ends), np.diff([0, *ends]).tolist()))
                rows += [(key, _prefix(c), _prefix(c, 1), n) for c, n in own.items()]
            table = np.array(rows, dtype=np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in table.T], ["key", "high", "low", "size"])

    return _payloads(media, payload_column).mapInArrow(apply, "key bigint, high bigint, low bigint, size bigint")


def _dictionary(media: DataFrame, payload_column: str) -> bytes:
    """A compression dictionary of a bounded sample of the payloads; empty where there is too little to train on."""
    head = F.substring(F.col("payload"), 1, SAMPLE_BYTES).alias("head")
    sample = [bytes(r.head) for r in _payloads(media, payload_column).select(head).limit(SAMPLE).collect() if r.head]
    if sum(map(len, sample)) < 8 * DICTIONARY_BYTES:
        return b""
    return zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes()


def _codec(dictionary: bytes) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    made = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=9, dict_data=made), zstandard.ZstdDecompressor(dict_data=made)


def _sent(media: DataFrame, payload_column: str, dictionary: bytes) -> DataFrame:
    """``key, blob``: each payload, compressed; a task sends equal payloads once."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze, seen = _codec(dictionary)[0], set()
        for batch in batches:
            keys, blobs = [], []
            for value in batch.column(0):
                raw = value.as_py()
                whole = hashlib.sha256(raw).digest()
                if whole not in seen:
                    seen.add(whole)
                    keys.append(_prefix(whole))
                    blobs.append(squeeze.compress(raw))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())], ["key", "blob"])

    return _payloads(media, payload_column).mapInArrow(apply, "key bigint, blob binary")


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _read(spark: SparkSession, store_path: str, kind: str) -> DataFrame:
    schema = PACK if kind == "packs" else SHARED
    there = _exists(spark, f"{store_path}/{kind}")
    return spark.read.schema(schema).parquet(f"{store_path}/{kind}") if there else spark.createDataFrame([], schema)


def _own_chunks() -> Column:
    return F.transform("own", lambda i: F.get(F.col("chunks"), i))


def _decisions(uses: DataFrame, packs: DataFrame | None, shared: DataFrame | None) -> DataFrame:
    """``key, skip, lend, have, present`` for payloads that do not simply store all their chunks.

    ``skip`` are chunks that another payload stores, ``lend`` those that this one stores for several, ``have`` and ``present`` what the store has.
    """
    chunk = ["high", "low"]
    holders = uses.groupBy(*chunk).agg(F.min("key").alias("owner"), F.max("key").alias("last")).where("owner <> last").select(*chunk, "owner")
    pair = F.concat(F.lpad(F.hex("high"), 16, "0"), F.lpad(F.hex("low"), 16, "0"))
    none = F.lit(None).cast("binary")
    marked = uses.join(holders, chunk).select("key", F.when(F.col("key") == F.col("owner"), "lend").otherwise("skip").alias("what"), F.unhex(pair).alias("value"))
    if packs is not None:
        stored = packs.select(F.explode(_own_chunks()).alias("chunk")).unionAll(shared.select("chunk"))
        stored = stored.select(_prefix_column(F.col("chunk")).alias("high"), _prefix_column(F.col("chunk"), 1).alias("low"), "chunk")
        had = uses.join(stored, chunk).select("key", F.lit("have").alias("what"), F.col("chunk").alias("value"))
        there = packs.select(_prefix_column(F.col("media")).alias("key"), "media").join(uses.select("key").distinct(), "key", "left_semi")
        marked = marked.unionAll(had).unionAll(there.select("key", F.lit("present").alias("what"), F.col("media").alias("value")))
    lists = [F.collect_set(F.when(F.col("what") == name, F.col("value")).otherwise(none)).alias(name) for name in ("skip", "lend", "have", "present")]
    return marked.groupBy("key").agg(*lists)


def add_chunks(media: DataFrame, store_path: str, payload_column: str = "payload") -> None:
    """Store the chunks of ``media`` that the store at ``store_path`` lacks, and the recipes of its payloads."""
    spark = media.sparkSession
    uses = materialise(_uses(media, payload_column))
    buckets = max(1, -(-(uses.agg(F.sum("size")).first()[0] or 0) // BUCKET_BYTES))
    there = _exists(spark, f"{store_path}/packs")
    decided = materialise(_decisions(uses, *((_read(spark, store_path, kind) for kind in ("packs", "shared")) if there else (None, None))))
    dictionary = _dictionary(media, payload_column)
    sent = _sent(media, payload_column, dictionary).withColumn("kind", F.lit(1))
    both = decided.withColumn("kind", F.lit(0)).unionByName(sent, allowMissingColumns=True).withColumn("bucket", F.pmod("key", F.lit(buckets)).cast("int"))
    # a task for each bucket; in it a payload's decision comes right before the payload
    met = both.repartitionById(buckets, "bucket").sortWithinPartitions("key", "kind").drop("bucket")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread = _codec(dictionary)[1]
        key, done, decision = None, set(), {}
        for batch in batches:
            packs, lent = [], []
            for row in batch.to_pylist():
                if row["key"] != key:
                    key, done, decision = row["key"], set(), {}
                if row["kind"] == 0:
                    decision = {c: set(row[c] or ()) for c in ("skip", "lend", "have", "present")}
                    continue
                raw = spread.decompress(row["blob"])
                whole = hashlib.sha256(raw).digest()
                if whole in done or whole in decision.get("present", ()):
                    continue
                done.add(whole)
                ends = cuts(np.frombuffer(raw, np.uint8))
                chunks, begins = _chunked(raw, ends), [0, *ends]
                own, met = [], set()
                for place, chunk in enumerate(chunks):
                    if chunk in met:  # of a chunk that a payload repeats the first place counts
                        continue
                    met.add(chunk)
                    if chunk in decision.get("have", ()) or chunk[:16] in decision.get("skip", ()):
                        continue
                    if chunk[:16] in decision.get("lend", ()):
                        lent.append({"chunk": chunk, "bytes": raw[begins[place] : ends[place]]})
                    else:
                        own.append(place)
                packs.append({"media": whole, "chunks": chunks, "sizes": np.diff(begins).tolist(), "own": own, "whole": len(own) == len(met), "bytes": b"".join(raw[begins[i] : ends[i]] for i in own)})
            columns = {f.name: pa.array([r[f.name] for r in packs] + [None] * len(lent), f.type) for f in _arrow(PACK)}
            columns["bytes"] = pa.array([r["bytes"] for r in (*packs, *lent)], pa.binary())
            columns["chunk"] = pa.array([None] * len(packs) + [r["chunk"] for r in lent], pa.binary())
            columns["table"] = pa.array(["packs"] * len(packs) + ["shared"] * len(lent), pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    fresh = shared_folder(spark)
    with cleaned(spark):
        met.mapInArrow(pack, PACK + ", chunk binary, table string").write.option("compression", "zstd").partitionBy("table").parquet(fresh)
    # both tables come from one pass; their files are then added to the store's
    for kind in ("packs", "shared"):
        _adopt(spark, f"{fresh}/table={kind}", f"{store_path}/{kind}")
    for table in (uses, decided):
        discard(table)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"binary": pa.binary(), "array<binary>": pa.list_(pa.binary()), "array<int>": pa.list_(pa.int32()), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in schema.split(", "))])


def _adopt(spark: SparkSession, fresh: str, table: str) -> None:
    paths = spark._jvm.org.apache.hadoop.fs.Path
    files = paths(fresh).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(paths(table))
    if files.exists(paths(fresh)):
        for status in files.listStatus(paths(fresh)):
            if status.getPath().getName().endswith(".parquet"):
                files.rename(status.getPath(), paths(table, status.getPath().getName()))


_RESULT = "media binary, chunks array<binary>, sizes array<int>, n_bytes bigint, verified boolean, payload binary"


def _checked(rows: list[dict], pieces: dict[bytes, bytes], with_payload: bool) -> pa.RecordBatch:
    """Every recipe's slices in order, each against its digest, and the whole against the payload's."""
    sizes, good, payloads = [], [], []
    for row in rows:
        own, at = {}, 0
        for place in row["own"] or ():
            own[row["chunks"][place]] = row["bytes"][at : at + row["sizes"][place]]
            at += row["sizes"][place]
        parts = [own.get(c, pieces.get(c)) for c in row["chunks"]]
        fits = len(row["sizes"]) == len(parts) and all(p is not None and len(p) == n and hashlib.sha256(p).digest() == c for p, n, c in zip(parts, row["sizes"], row["chunks"]))
        payload = b"".join(p for p in parts if p is not None)
        sizes.append(len(payload))
        good.append(fits and hashlib.sha256(payload).digest() == row["media"])
        payloads.append(payload if with_payload else None)
    columns = [pa.array([r[c] for r in rows], t) for c, t in (("media", pa.binary()), ("chunks", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int32())))]
    columns += [pa.array(sizes, pa.int64()), pa.array(good, pa.bool_()), pa.array(payloads, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _RESULT.split(", ")])


def _in_place(packs: DataFrame, with_payload: bool) -> DataFrame:
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _checked(batch.to_pylist(), {}, with_payload)

    return packs.where("whole").select("media", "chunks", "sizes", "own", "bytes").mapInArrow(apply, _RESULT)


def _gathered(rows: DataFrame, packs: DataFrame, shared: DataFrame, with_payload: bool) -> DataFrame:
    """The same for recipes (``media, chunks, sizes, own, bytes``) some of whose chunks lie elsewhere."""
    total = rows.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    placed = rows.withColumn("bucket", F.pmod(F.xxhash64("media"), F.lit(buckets)).cast("int"))
    needed = placed.select("bucket", F.explode(F.array_except("chunks", F.coalesce(_own_chunks(), F.array().cast("array<binary>")))).alias("chunk")).distinct()
    pieces = needed.join(shared, "chunk").select("bucket", "chunk", "bytes")
    rest = materialise(needed.join(shared.select("chunk"), "chunk", "left_anti"))
    if rest.limit(1).count():  # chunks that sit in other payloads' packs
        held = packs.select(F.col("media").alias("holder"), F.explode(_own_chunks()).alias("chunk"))
        wants = rest.join(held, "chunk").groupBy("bucket", "chunk").agg(F.min("holder").alias("holder")).groupBy("holder").agg(F.collect_list(F.struct("bucket", "chunk")).alias("wants"))

        def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out: tuple[list, list, list] = ([], [], [])
                for row in batch.to_pylist():
                    at, parts = 0, {}
                    for place in row["own"]:
                        parts[row["chunks"][place]] = row["bytes"][at : at + row["sizes"][place]]
                        at += row["sizes"][place]
                    for want in row["wants"]:
                        for column, value in zip(out, (want["bucket"], want["chunk"], parts[want["chunk"]])):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())], ["bucket", "chunk", "bytes"])

        found = packs.join(wants, packs["media"] == F.col("holder")).select("chunks", "sizes", "own", "bytes", "wants")
        pieces = pieces.unionAll(found.mapInArrow(take, "bucket int, chunk binary, bytes binary"))
    both = pieces.withColumn("kind", F.lit(0)).unionByName(placed.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    met = both.repartitionById(buckets, "bucket").sortWithinPartitions("kind").select("kind", "chunk", "bytes", "media", "chunks", "sizes", "own")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[bytes, bytes] = {}  # of one bucket, so about BUCKET_BYTES
        for batch in batches:
            rows = batch.to_pylist()
            pieces.update((r["chunk"], r["bytes"]) for r in rows if r["kind"] == 0)
            yield _checked([r for r in rows if r["kind"] == 1], pieces, with_payload)

    return met.mapInArrow(build, _RESULT)


def _stored(store_path: str, spark: SparkSession, with_payload: bool = False) -> DataFrame:
    """Every payload of the store, rebuilt."""
    packs, shared = _read(spark, store_path, "packs"), _read(spark, store_path, "shared")
    open_ = packs.where("not whole").select("media", "chunks", "sizes", "own", "bytes")
    return _in_place(packs, with_payload).unionAll(_gathered(open_, packs, shared, with_payload))


def _rebuilt(recipe_table: DataFrame, store_path: str, with_payload: bool) -> DataFrame:
    spark = recipe_table.sparkSession
    packs, shared = _read(spark, store_path, "packs"), _read(spark, store_path, "shared")
    # recipes as the store holds them are rebuilt where they lie, any others from chunks wherever they are
    wanted = recipe_table.select("media", "chunks", "sizes").distinct()
    form = ["media", "chunks", "sizes"]
    known = _stored(store_path, spark, with_payload).join(wanted, form, "left_semi")
    other = materialise(wanted.join(packs.select(*form), form, "left_anti"))
    empty = other.select(*form, F.lit(None).cast("array<int>").alias("own"), F.lit(None).cast("binary").alias("bytes"))
    return known.unionAll(_gathered(empty, packs, shared, with_payload))


def reconstruct(recipe_table: DataFrame, store_path: str) -> DataFrame:
    """``media, n_bytes, verified`` for each distinct recipe, rebuilt from the store chunk by chunk in the recipe's order."""
    return _rebuilt(recipe_table, store_path, False).select("media", "n_bytes", "verified")


def payloads_of(recipe_table: DataFrame, store_path: str) -> DataFrame:
    """``media, n_bytes, verified, payload`` for each distinct recipe."""
    return _rebuilt(recipe_table, store_path, True).select("media", "n_bytes", "verified", "payload")


def chunk_report(media: DataFrame, store_path: str | None = None, id_column: str = "page_id", payload_column: str = "html") -> DataFrame:
    """Store the payloads' chunks, rebuild every payload from them, and tell for each row what it is made of.

    ``id, n_bytes, n_chunks, media, chunks, verified``; digests in hexadecimal, chunks in order.
    """
    store_path = store_path or f"{shared_folder(media.sparkSession)}/chunks"
    add_chunks(media, store_path, payload_column)
    known = _stored(store_path, media.sparkSession).select("chunks", "n_bytes", "verified", F.col("media").alias("__media"))
    rows = media.select(F.col(id_column), F.unhex(F.sha2(F.col(payload_column).cast("binary"), 256)).alias("__own"))
    hexed = lambda x: F.lower(F.hex(x))
    out = rows.join(known, F.col("__own") == F.col("__media"), "left")
    return out.select(id_column, "n_bytes", F.when(F.col("__media").isNotNull(), F.size("chunks")).cast("bigint").alias("n_chunks"), hexed(F.col("__media")).alias("media"), F.transform("chunks", hexed).alias("chunks"), "verified")
