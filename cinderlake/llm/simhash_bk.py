"""SimHash near-duplicate detection with BK-trees.

A document's distinct words vote on the 256 bits of its signature, each with a weight that grows with its length in bytes
(short words are mostly function words). Signatures are searched in BK-trees, whose children are keyed by their integer Hamming
distance to the parent; a query follows only the edges within ``radius`` of its own distance.

One tree over a corpus would be searched nearly whole, so trees are sharded: each of 64 keys is a sample of 16 of a signature's bits (every bit is in four
keys, and two keys share one bit at most), and documents that agree in a key share its shard. Pairs within 15 bits share one for certain, as sixteen of the
keys have no bit in common; a pair at ``RADIUS`` shares one with probability 0.95. Every signature is a query in each of its 64 shards, and a pair that shares several
counts in the first. Pairs that share none are found by a second, exact search (``rest_links``), so that no pair within the radius is left out. Where the trees fit ``BROADCAST_BYTES`` they are built once and broadcast; beyond that each task receives its shards by a
shuffle, builds their trees and answers the shard's own queries. Both ways find the same links. A shard of more than ``HOT_ROWS`` signatures is cut into parts, and
each pair of parts is a task of its own, so nothing is capped and no task holds more than two parts.

The second search takes a signature as eight words of 32 bits. Two signatures within 44 bits differ by at most 5 bits in one of the first five words, or by at most 4 in one of the other
three: else they would be 5 * 6 + 3 * 5 = 45 bits apart. A word's bits are the points of an affine space over the field of two elements, of dimension 5 or 4, and as many points as that lie in a
hyperplane. So the two agree in all 16 bits beside some hyperplane, and those that agree there are compared: 400 half-spaces, of which each brings a pair of unlike signatures together with
probability 1/65,536. Signatures are cut into blocks of about ``BLOCK_ROWS``; a task compares a block with itself or with another, in some of the half-spaces.

Documents with the same signature count once in the trees. Links are counted where they are found; within a task only the edges of a spanning forest
leave it, and classes are the connected components over all shards.

Results for edge cases: a text that is NULL, empty or without words has no duplicates and stays. So does a row with a NULL id. Rows that share an
id but not their text are different documents; of rows that share both one stays. The row with the smallest id of a class stays (of equal ids the one whose text has
the smallest hash). Texts of any length are worked on whole. An empty table gives an empty result. Further columns are ignored by ``classes`` and ``duplicates`` and kept
by ``drop_duplicates``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..operators.components import connected_components
from ._common import Block, blocks, materialise, mix, words_of

SIGNATURE_BITS = 256
RADIUS = 44
BROADCAST_BYTES = 32 << 20
HOT_ROWS = 1 << 17
BLOCK_ROWS = 1 << 19
#: Bytes of the list of hot shards that go to every task; more than fit make ``HOT_ROWS`` larger.
_HOT_BYTES = 64 << 20
_KEY_BITS = 16


def _times(a: int, b: int) -> int:
    """The product in the field of 16 elements."""
    out = 0
    for bit in range(4):
        if b >> bit & 1:
            out ^= a << bit
    for bit in (7, 6, 5, 4):
        if out >> bit & 1:
            out ^= 0b10011 << (bit - 4)
    return out


#: The bits of each shard key: the sixteen words of 16 bits, and three families of lines that take one bit of each word. Keys of a family are disjoint, any others meet in one bit.
SAMPLES = tuple(tuple(16 * w + b for b in range(16)) for w in range(16)) + tuple(tuple(16 * w + (b ^ _times(m, w)) for w in range(16)) for m in (0, 1, 2) for b in range(16))
KEYS = len(SAMPLES)
_PARTS = SIGNATURE_BITS // 64
_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)
#: (query, node) pairs looked at in one step of a search.
_FRONTIER = 1 << 19
_PIECE = 4096
#: Signatures whose rows for the shards are made at once.
_SPREAD = 8192


def signatures(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Signatures (documents x 4 words of 64 bits), and which documents have words."""
    words = words_of(block)
    counts = np.diff(words.offsets)
    votes, totals = np.zeros((block.size, SIGNATURE_BITS), dtype=np.uint32), np.zeros(block.size, dtype=np.uint32)
    doc = np.repeat(np.arange(block.size), counts)
    order = np.lexsort((words.hashes, doc))
    hashes, doc, length = words.hashes[order], doc[order], (words.ends - words.begins)[order]
    first = np.ones(len(hashes), dtype=bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    hashes, doc = hashes[first], doc[first]
    weight = np.clip(2 * length[first] - 4, 1, 16).astype(np.uint16)
    heads = np.searchsorted(doc, np.arange(block.size + 1))
    # votes add up in 16-bit lanes, four to a machine word; pieces of at most _PIECE words cannot overflow a lane
    for low in range(0, len(hashes), _PIECE):
        high = min(len(hashes), low + _PIECE)
        bits = np.unpackbits(mix(hashes[low:high, None] ^ _SEEDS[None, :]).view(np.uint8), axis=1).astype(np.uint16)
        bits *= weight[low:high, None]
        own = np.unique(doc[low:high])
        starts = np.maximum(heads[own], low) - low
        votes[own] += np.add.reduceat(bits.view(np.uint64), starts, axis=0).view(np.uint16).astype(np.uint32)
        totals[own] += np.add.reduceat(weight[low:high].astype(np.uint32), starts)
    out = np.packbits(2 * votes > totals[:, None], axis=1).view(np.uint64)
    return out, counts > 0


def signature_table(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``node, s0, s1, s2, s3`` for each row with an id and words; ``node`` is a struct of the id and a hash of the text."""
    id_type = docs.schema[id_column].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, has = [np.zeros((0, _PARTS), np.uint64)], [np.zeros(0, bool)]
            for block in blocks(batch.column(1)):
                signature, some = signatures(block)
                made.append(signature)
                has.append(some)
            keep = np.flatnonzero(np.concatenate(has))
            signature = np.concatenate(made)[keep].view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), *(pa.array(np.ascontiguousarray(signature[:, i])) for i in range(_PARTS))], ["node", "s0", "s1", "s2", "s3"])

    text = F.col(text_column).cast("string")
    picked = docs.select(_node(F.col(id_column), text).alias("node"), text.alias("text")).where("node.id is not null and text is not null")
    return picked.mapInArrow(apply, f"node struct<id:{id_type},h:bigint>, s0 bigint, s1 bigint, s2 bigint, s3 bigint")


def _node(own_id: Column, text: Column) -> Column:
    return F.struct(own_id.alias("id"), F.xxhash64(text).alias("h"))


_EDGES = SIGNATURE_BITS + 1


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)


class Forest:
    """BK-trees over items, one for each group; built and searched for all groups at once, level by level.

    Nodes must be ordered by group; a group's first node is its root. Node ``k`` has the signature ``code[item[k]]``, or ``code[k]`` without ``item``.
    """

    def __init__(self, code: np.ndarray, group: np.ndarray, item: np.ndarray | None = None) -> None:
        size = len(group)
        self.code, self.item = code, item
        begins = np.flatnonzero(np.diff(group, prepend=group[0] - 1 if size else 0)) if size else np.zeros(0, np.int64)
        self.root = np.repeat(begins, np.diff(np.append(begins, size)))
        parent, edge = np.full(size, -1), np.zeros(size, dtype=np.int64)
        left = np.setdiff1d(np.arange(size), begins, assume_unique=True)
        at = self.root[left]
        while len(left):
            distance = hamming(self._code(left), self._code(at))
            key = at * _EDGES + distance
            order = np.argsort(key, kind="stable")
            left, at, distance, key = left[order], at[order], distance[order], key[order]
            first = np.ones(len(left), dtype=bool)
            first[1:] = key[1:] != key[:-1]
            # the first item with a distance to this parent becomes its child; the others go on below that child
            parent[left[first]], edge[left[first]] = at[first], distance[first]
            child = left[first][np.cumsum(first) - 1]
            left, at = left[~first], child[~first]
        nodes = np.flatnonzero(parent >= 0)
        keys = parent[nodes] * _EDGES + edge[nodes]
        order = np.argsort(keys)
        self.children, self.child_keys = nodes[order], keys[order]

    def _code(self, node: np.ndarray) -> np.ndarray:
        return self.code[node] if self.item is None else self.code[self.item[node]]

    def search(self, query: np.ndarray, start: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query's place, item) arrays of all items within ``radius`` in the trees below ``start``."""
        stack = [(np.arange(low, min(len(query), low + _FRONTIER)), start[low : low + _FRONTIER]) for low in range(0, len(query), _FRONTIER)]
        while stack:
            place, node = stack.pop()
            distance = hamming(query[place], self._code(node))
            hit = distance <= radius
            if hit.any():
                yield place[hit], node[hit]
            low = np.searchsorted(self.child_keys, node * _EDGES + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.child_keys, node * _EDGES + np.minimum(distance + radius, SIGNATURE_BITS), side="right")
            count = high - low
            some = count > 0
            place, low, count = place[some], low[some], count[some]
            if not len(place):
                continue
            ends = np.cumsum(count)
            cut = 0
            while cut < len(place):  # bounded pieces keep memory flat whatever the shard's size
                base = ends[cut - 1] if cut else 0
                stop = max(cut + 1, int(np.searchsorted(ends, base + _FRONTIER, side="right")))
                c = count[cut:stop]
                offset = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
                stack.append((np.repeat(place[cut:stop], c), self.children[np.repeat(low[cut:stop], c) + offset]))
                cut = stop


class Spanning:
    """A spanning forest of the pairs it is given, in bounded memory."""

    def __init__(self, size: int) -> None:
        self.label = np.arange(size)
        self._a: list[np.ndarray] = []
        self._b: list[np.ndarray] = []
        self._held = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self._a.append(a)
        self._b.append(b)
        self._held += len(a)
        if self._held > 1 << 20:
            self._settle()

    def _settle(self) -> None:
        a, b = np.concatenate([self.label[:0], *self._a]), np.concatenate([self.label[:0], *self._b])
        self._a, self._b, self._held = [], [], 0
        label = self.label
        while True:
            low = np.minimum(label[a], label[b])
            before = label.copy()
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            while True:
                shorter = label[label]
                if np.array_equal(shorter, label):
                    break
                label = shorter
            if np.array_equal(before, label):
                break
        self.label = label

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        self._settle()
        other = np.flatnonzero(self.label != np.arange(len(self.label)))
        return other, self.label[other]


def _keys(code: np.ndarray) -> np.ndarray:
    """The shard keys of each signature (signatures x keys of 16 bits)."""
    order = np.array(SAMPLES).ravel()
    out = [np.zeros((0, KEYS), np.uint16)]
    for low in range(0, len(code), 1 << 14):
        bits = np.unpackbits(np.ascontiguousarray(code[low : low + (1 << 14)]).view(np.uint8).reshape(-1, SIGNATURE_BITS // 8), axis=1)
        out.append(np.ascontiguousarray(np.packbits(bits[:, order], axis=1)).view(np.uint16))
    return np.concatenate(out)


def _first_shared(keys: np.ndarray, a: np.ndarray, b: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Whether key ``number`` is the first that the items of each pair share."""
    out = np.empty(len(a), dtype=bool)
    for low in range(0, len(a), 1 << 17):
        part = slice(low, low + (1 << 17))
        out[part] = (keys[a[part]] == keys[b[part]]).argmax(axis=1) == number[part]
    return out


def cell_links(cell: np.ndarray, side: np.ndarray, signature: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of items ordered by cell and side: the edges of a spanning forest of all links, and each item's number of links.

    A cell is a shard, or two parts of a hot one. Its items of side 0 make its trees. In a shard or one part with itself they are the queries too, between different
    parts those of side 1 are. A link counts in the first shard that its two items share.
    """
    size = len(cell)
    spanning, links = Spanning(size), np.zeros(size, dtype=np.int64)
    kept = np.flatnonzero(side == 0)
    if len(kept):
        keys = _keys(signature)
        forest = Forest(signature[kept], cell[kept])
        begin = np.searchsorted(cell[kept], cell)
        there = begin < len(kept)
        there[there] = cell[kept][begin[there]] == cell[there]
        crossed = ((cell >> 20) & 0xFFFFF) != (cell & 0xFFFFF)
        alone = np.searchsorted(cell, cell) == np.searchsorted(cell, cell, side="right") - 1
        query = np.flatnonzero(there & (crossed == (side == 1)) & ~alone)
        own = (cell >> 56).astype(np.int64)
        for place, node in forest.search(signature[query], begin[query], radius):
            a, b = query[place], kept[node]
            once = crossed[a] | (a < b)
            a, b = a[once], b[once]
            first = _first_shared(keys, a, b, own[a])
            a, b = a[first], b[first]
            links += np.bincount(a, minlength=size) + np.bincount(b, minlength=size)
            spanning.add(a, b)
    return *spanning.edges(), links


def half_spaces(radius: int) -> list[tuple[int, int, int]]:
    """(word, bits, mask): two signatures within ``radius`` differ by at most ``bits`` in some word of 32 bits, and there in no bit of one of its masks.

    Above 47 bits the masks would have fewer bits than can tell signatures apart: one empty mask compares all with all.
    """
    if radius > 47:
        return [(0, 32, 0)]
    out = []
    for word in range(8):
        bits = (radius + 1) // 8 - 1 + (word < (radius + 1) % 8)
        if bits < 0:
            continue
        points = [1 << bits | i % (1 << bits) for i in range(32)]
        # the mask of all points is needed only where no bit may differ
        normals = [v for v in range(1, 2 << bits) if v != 1 << bits or not bits]
        out += [(word, bits, sum(1 << i for i, point in enumerate(points) if (point & v).bit_count() & 1)) for v in normals]
    return out


def _run_ends(values: np.ndarray) -> np.ndarray:
    """For each place in the sorted values, where its run of equal ones ends."""
    ends = np.append(np.flatnonzero(values[1:] != values[:-1]) + 1, len(values))
    return np.repeat(ends, np.diff(ends, prepend=0))


def rest_links(signature: np.ndarray, side: np.ndarray, radius: int, part: int = 0, parts: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs within ``radius`` that share no shard: the edges of a spanning forest, and each item's number of links.

    Pairs are those of different sides, or all where there is one side. Of the half-spaces each ``parts``-th is searched, from number ``part``. A pair counts in the first
    word with few enough bits, and there in the first half-space.
    """
    size = len(signature)
    spanning, links = Spanning(size), np.zeros(size, dtype=np.int64)
    crossed = bool(side.any())
    spaces = half_spaces(radius)
    least = {word: bits for word, bits, _ in spaces}
    words = np.ascontiguousarray(np.ascontiguousarray(signature).view(np.uint32).T)
    for number in range(part, len(spaces), parts) if size > 1 else ():
        word, bits, mask = spaces[number]
        earlier = [np.uint32(before) for other, _, before in spaces[:number] if other == word]
        own = words[word]
        # items with the same lower half of the word share a shard: they are kept apart from each other, as those of one side are
        kind = side if crossed else own & np.uint32(0xFFFF)
        run = (own & np.uint32(mask)).astype(np.uint64) << np.uint64(16) | kind.astype(np.uint64)
        order = np.argsort(run)
        run, own = run[order], own[order]
        begin = _run_ends(run)
        count = _run_ends(run >> np.uint64(16)) - begin
        some = np.flatnonzero(count)
        begin, count = begin[some], count[some]
        ends = np.cumsum(count)
        cut = 0
        while cut < len(some):
            stop = max(cut + 1, int(np.searchsorted(ends, (ends[cut - 1] if cut else 0) + _FRONTIER, side="right")))
            c = count[cut:stop]
            a = np.repeat(some[cut:stop], c)
            b = np.arange(len(a)) + np.repeat(begin[cut:stop] - (np.cumsum(c) - c), c)
            cut = stop
            few = np.bitwise_count(own[a] ^ own[b]) <= bits
            a, b = order[a[few]], order[b[few]]
            apart = signature[a] ^ signature[b]
            near = (np.bitwise_count(apart).sum(axis=1, dtype=np.int64) <= radius) & (apart.view(np.uint16) != 0).all(axis=1)
            a, b, apart = a[near], b[near], apart[near]
            there = np.bitwise_count(apart.view(np.uint32))
            first = np.ones(len(a), dtype=bool)
            for other in range(word):
                first &= there[:, other] > least.get(other, -1)
            a, b, apart = a[first], b[first], apart[first]
            for before in earlier if len(a) else ():
                first = (apart.view(np.uint32)[:, word] & before) != 0
                a, b, apart = a[first], b[first], apart[first]
            if not len(a):
                continue
            rest = (_keys(apart) != 0).all(axis=1)
            a, b = a[rest], b[rest]
            links += np.bincount(a, minlength=size) + np.bincount(b, minlength=size)
            spanning.add(a, b)
    return *spanning.edges(), links


def _parts_of(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(f"s{i}").to_numpy(zero_copy_only=False).view(np.uint64) for i in range(_PARTS)], axis=1)


_LINKS = "a bigint, b bigint, links bigint"


def _rows(ids: pa.Array, a: np.ndarray, b: np.ndarray, item: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
    """Edges as ``a, b``, numbers of links as ``a, links``."""
    left = ids.take(pa.array(np.concatenate([a, item])))
    right = ids.take(pa.array(np.concatenate([b, np.zeros(len(item), np.int64)]), mask=np.arange(len(a) + len(item)) >= len(a)))
    return pa.RecordBatch.from_arrays([left, right, pa.array(np.concatenate([np.zeros(len(a), np.int64), links]))], ["a", "b", "links"])


def _by_broadcast(nodes: DataFrame, radius: int) -> DataFrame:
    """Each signature is searched in the trees of its shards; ``a`` counts its own links only, as ``b`` is a query too."""
    rows = nodes.select("k", "s0", "s1", "s2", "s3").toArrow()  # within BROADCAST_BYTES, checked by the caller
    ids = pa.concat_arrays(rows.column("k").chunks) if rows.num_rows else pa.array([], pa.int64())
    signature = np.stack([rows.column(f"s{i}").to_numpy().view(np.uint64) for i in range(_PARTS)], axis=1)
    keys = _keys(signature)
    shard = (np.arange(KEYS, dtype=np.int64)[None, :] << 16) | keys
    order = np.argsort(shard.ravel(), kind="stable")
    item, group = (order // KEYS).astype(np.int32), shard.ravel()[order]
    forest = Forest(signature, group, item)
    begins = np.flatnonzero(np.diff(group, prepend=-1))
    sent = nodes.sparkSession.sparkContext.broadcast((forest, group[begins].astype(np.int32), begins.astype(np.int32), keys, ids))
    numbered = nodes.sparkSession.createDataFrame(pa.table({"at": pa.array(np.arange(len(ids)), pa.int64())})).repartition(max(1, len(ids) // 2048))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, groups, begins, keys, ids = sent.value
        for batch in batches:
            at = batch.column("at").to_numpy()
            own = (np.arange(KEYS, dtype=np.int32)[None, :] << 16) | keys[at].astype(np.int32)
            start = begins[np.searchsorted(groups, own.ravel())].astype(np.int64)
            spanning, links = Spanning(len(ids)), np.zeros(len(ids), dtype=np.int64)
            for place, node in forest.search(np.repeat(forest.code[at], KEYS, axis=0), start, radius):
                a, b = at[place // KEYS], forest.item[node].astype(np.int64)
                first = (a != b) & _first_shared(keys, a, b, place % KEYS)
                links += np.bincount(a[first], minlength=len(ids))
                spanning.add(a[first], b[first])
            some = np.flatnonzero(links)
            yield _rows(ids, *spanning.edges(), some, links[some])

    return numbered.mapInArrow(apply, _LINKS)


def _hot_shards(nodes: DataFrame, count: int, hot_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Shards with more than ``hot_rows`` signatures, and into how many parts each is cut.

    Tasks report a shard if it has a fair part of that number among their own signatures: one with so many has it in some tasks, and what the others leave out is less
    than a quarter.
    """
    hot_rows = max(hot_rows, count * KEYS * 16 // _HOT_BYTES)
    if count <= hot_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = max(1, hot_rows // (4 * max(1, nodes.rdd.getNumPartitions())))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(KEYS << 16, dtype=np.int32)
        for batch in batches:
            total += np.bincount(((np.arange(KEYS) << 16) | _keys(_parts_of(batch))).ravel(), minlength=KEYS << 16).astype(np.int32)
        shard = np.flatnonzero(total >= least)
        yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(total[shard].astype(np.int64))], ["shard", "n"])

    found = nodes.select("s0", "s1", "s2", "s3").mapInArrow(apply, "shard bigint, n bigint").groupBy("shard").agg(F.sum("n").alias("n")).where(F.col("n") * 4 > hot_rows * 3).orderBy("shard").toArrow()
    shard, n = (found.column(c).to_numpy() for c in ("shard", "n"))  # within _HOT_BYTES
    return shard, -(-4 * n // (3 * hot_rows))


def _whole_cells(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.Table]:
    """Tables of at least so many rows, but the last, that end where a cell ends."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        cell = batch.column("place").to_numpy() >> 1
        if not len(cell):
            continue
        if held and rows >= least:
            cut = int(np.searchsorted(cell, held[-1].column("place")[-1].as_py() >> 1, side="right"))
            if cut < len(cell):
                yield pa.Table.from_batches([*held, batch.slice(0, cut)])
                held, rows, batch = [], 0, batch.slice(cut)
        held.append(batch)
        rows += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


def _by_shuffle(nodes: DataFrame, count: int, radius: int, hot_rows: int) -> DataFrame:
    hot, parts = _hot_shards(nodes, count, hot_rows)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each shard; in a hot one a row for each pair of parts that the signature's own is in."""
        for whole in batches:
            for low in range(0, whole.num_rows, _SPREAD):
                batch = whole.slice(low, _SPREAD)
                code = _parts_of(batch)
                shard = ((np.arange(KEYS) << 16) | _keys(code)).ravel()
                row = np.repeat(np.arange(len(code)), KEYS)
                cell, side = shard << 40, np.zeros(len(shard), dtype=np.int64)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, shard), len(hot) - 1)
                    times = np.where(hot[at] == shard, parts[at], 1)
                    own = (mix(code[:, 0] ^ code[:, 1] ^ code[:, 2] ^ code[:, 3])[row] % times.astype(np.uint64)).astype(np.int64)
                    many = np.repeat(np.arange(len(shard)), times)
                    other = np.arange(len(many)) - np.repeat(np.cumsum(times) - times, times)
                    own = own[many]
                    cell = (shard[many] << 40) | (np.minimum(own, other) << 20) | np.maximum(own, other)
                    side = (own > other).astype(np.int64)
                    row = row[many]
                # in the order of cells, as the receiving task needs them
                place = (cell << 1) | side
                order = np.argsort(place, kind="stable")
                picked = batch.take(pa.array(row[order]))
                yield pa.RecordBatch.from_arrays([pa.array(place[order]), *picked.columns], ["place", *batch.schema.names])

    rows = nodes.select("k", "s0", "s1", "s2", "s3").mapInArrow(spread, "place bigint, k bigint, s0 bigint, s1 bigint, s2 bigint, s3 bigint")
    cells = rows.repartition(F.shiftright("place", 1)).sortWithinPartitions("place")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_cells(batches, 1 << 17):
            batch = table.combine_chunks().to_batches()[0]
            place = batch.column("place").to_numpy()
            a, b, links = cell_links(place >> 1, place & 1, _parts_of(batch), radius)
            some = np.flatnonzero(links)
            yield _rows(batch.column("k"), a, b, some, links[some])

    return cells.mapInArrow(apply, _LINKS)


def _by_half_spaces(nodes: DataFrame, count: int, radius: int, block_rows: int) -> DataFrame:
    """The links of pairs that share no shard. A cell is a pair of blocks, and a part of the half-spaces where there are few blocks."""
    many = max(1, -(-count // block_rows))
    parts = max(1, min(16 // many, count >> 12))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, _SPREAD):
                batch = whole.slice(low, _SPREAD)
                code = _parts_of(batch)
                own = (mix(code[:, 0] ^ code[:, 1] ^ code[:, 2] ^ code[:, 3]) % np.uint64(many)).astype(np.int64)[:, None, None]
                other, part = np.arange(many)[None, :, None], np.arange(parts)[None, None, :]
                high = np.maximum(own, other)
                cell = (high * (high + 1) // 2 + np.minimum(own, other)) * parts + part
                place = ((cell << 1) | (own > other)).ravel()
                order = np.argsort(place, kind="stable")
                picked = batch.take(pa.array(order // (many * parts)))
                yield pa.RecordBatch.from_arrays([pa.array(place[order]), *picked.columns], ["place", *batch.schema.names])

    rows = nodes.select("k", "s0", "s1", "s2", "s3").mapInArrow(spread, "place bigint, k bigint, s0 bigint, s1 bigint, s2 bigint, s3 bigint")
    # each cell is a task
    cells = rows.repartitionById(parts * many * (many + 1) // 2, F.shiftright("place", 1).cast("int")).sortWithinPartitions("place")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_cells(batches, 1):
            place = table.column("place").to_numpy()
            for begin, end in _runs(place >> 1):
                batch = table.slice(begin, end - begin).combine_chunks().to_batches()[0]
                a, b, links = rest_links(_parts_of(batch), place[begin:end] & 1, radius, int(place[begin] >> 1) % parts, parts)
                some = np.flatnonzero(links)
                yield _rows(batch.column("k"), a, b, some, links[some])

    return cells.mapInArrow(apply, _LINKS)


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    ends = np.unique(_run_ends(values))
    return zip(np.append(0, ends[:-1]).tolist(), ends.tolist())


def _classified(docs: DataFrame, radius: int, id_column: str, text_column: str, broadcast_bytes: int, hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """``node, class, links, n`` of each row with words (``n`` rows have its signature), and whether rows share id and text: (node, times)."""
    table = materialise(signature_table(docs, id_column, text_column))
    parts = ["s0", "s1", "s2", "s3"]
    nodes = materialise(table.groupBy(*parts).agg(F.min("node").alias("node"), F.count("*").alias("n")).withColumn("k", F.monotonically_increasing_id()))
    count = nodes.count()
    small = count * (KEYS * (20 + 2) + 8 * _PARTS + 32) <= broadcast_bytes
    found = _by_broadcast(nodes, radius) if small else _by_shuffle(nodes, count, radius, hot_rows)
    if radius >= SIGNATURE_BITS // _KEY_BITS:  # below, all pairs share a shard
        found = found.unionByName(_by_half_spaces(nodes, count, radius, BLOCK_ROWS))
    found = materialise(found)
    linked = connected_components(found.where("b is not null"), materialise).select(F.col("node").alias("k"), "component")
    links = found.where("b is null").groupBy(F.col("a").alias("k")).agg(F.sum("links").alias("links"))
    near = materialise(nodes.join(linked, "k").join(links, "k").select("k", "node", "component", "links"))
    heads = near.groupBy("component").agg(F.min("node").alias("class"))
    known = nodes.join(near.join(heads, "component").select("k", "class", "links"), "k", "left")
    known = known.select(*parts, "n", F.coalesce("class", "node").alias("class"), F.coalesce("links", F.lit(0)).alias("links"))
    repeated = table.groupBy("node").agg(F.count("*").alias("times")).where("times > 1")
    return table.join(known, parts).select("node", "class", "links", "n"), repeated


def classes(docs: DataFrame, radius: int = RADIUS, id_column: str = "doc_id", text_column: str = "text", broadcast_bytes: int = BROADCAST_BYTES, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``id, class_id, n_links`` for each row that has a copy or a near duplicate: its class by the smallest id in it, and to how many other signatures its own is linked.

    Copies are not linked to each other: rows with the same signature have the same class and links. A row without a row here is alone in its class.
    """
    found, _ = _classified(docs, radius, id_column, text_column, broadcast_bytes, hot_rows)
    return found.where("n > 1 or links > 0").select(F.col("node.id").alias(id_column), F.col("class.id").alias(f"class_{id_column}"), F.col("links").alias("n_links"))


def duplicates(docs: DataFrame, radius: int = RADIUS, id_column: str = "doc_id", text_column: str = "text", broadcast_bytes: int = BROADCAST_BYTES, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``id, kept_id``: each document that near-duplicates another, with the one of its class that stays."""
    found, _ = _classified(docs, radius, id_column, text_column, broadcast_bytes, hot_rows)
    return found.where("node <> class").select(F.col("node.id").alias(id_column), F.col("class.id").alias(f"kept_{id_column}"))


def drop_duplicates(docs: DataFrame, radius: int = RADIUS, id_column: str = "doc_id", text_column: str = "text", broadcast_bytes: int = BROADCAST_BYTES, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The documents, all columns as they were, without those that near-duplicate a document that stays."""
    found, repeated = _classified(docs, radius, id_column, text_column, broadcast_bytes, hot_rows)
    gone = materialise(found.where("node <> class").select(F.col("node").alias("__gone")).distinct())
    # columns go by place, so that theirs can have any names
    plain = docs.toDF(*(f"__c{i}" for i in range(len(docs.columns))))
    own_id, own_text = (F.col(f"__c{docs.columns.index(c)}") for c in (id_column, text_column))
    node = _node(own_id, own_text.cast("string"))
    rest = plain.join(gone, node == F.col("__gone"), "left_anti")
    again = materialise(repeated.select(F.col("node").alias("__again")))
    if again.limit(1).count():  # of rows that share id and text one stays
        order = W.partitionBy("__again").orderBy(*[F.col(c) for c in plain.columns])
        rest = rest.join(again, node == F.col("__again"), "left").withColumn("__row", F.row_number().over(order)).where("__row = 1 or __again is null").drop("__row", "__again")
    return rest.toDF(*docs.columns)
