"""Secret scanning with a linear-chain conditional random field.

A line is a sequence of tokens, each tagged secret-begin, secret-inside or outside. Features: the token's shape (length, digits, capitals, hexadecimal,
letter-digit changes), its word and prefix, the three words before and the one after, the shape before, and the file (length, share of
digits, share of ``=``). Weights are fitted by maximising the conditional likelihood on lines of a bounded sample of documents
(``TRAIN_DOCS`` documents, ``TRAIN_LINES`` lines, of a line the first ``TRAIN_CHARS`` characters and in them ``TRAIN_TOKENS`` tokens around its first
secret: documented parameters that bound the training sample and its memory; what is scanned is never cut), in half of which generated secrets and look-alikes are planted;
secrets that the lines already hold are labelled by an assignment rule. Viterbi decodes. All of it is numpy over whole blocks; a line in which no
token can lift a tagged path above the all-outside path, by a bound on scores and transitions, is all outside and is not decoded.

One pass over the texts, no shuffle; the weights (fixed tables) are broadcast.

Results for edge cases: NULL, empty and blank texts hold no secret. NULL ids, repeated ids and repeated rows are scanned each for itself. Of equally good paths the one
that stays outside longest wins. Lines and texts of any length are tagged whole. An empty table gives an empty result, also for training: the generated lines alone are then used. Further columns are ignored.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import LOWER, Block, Substrings, blocks

OUTSIDE, BEGIN, INSIDE = 0, 1, 2
TRAIN_DOCS = 400
TRAIN_LINES = 2800
TRAIN_CHARS = 4000
TRAIN_TOKENS = 40
_ROUNDS = 50
#: Cells (line x token) of a padded table that is decoded at once.
_CELLS = 1 << 17
_RATE = 0.5
_DECAY = 1e-4
#: A feature value in fewer training lines has no weight.
_SEEN = 8
_WORDS, _SHAPES, _PREFIXES, _FILES = 4096, 4096, 1024, 64
_WORD_BYTE = np.zeros(256, dtype=bool)
_WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256), *b"_-+/."]] = True
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[*b" \t\r\n\x0b\x0c"]] = True
_KINDS = np.zeros((256, 5), dtype=bool)  # digit, capital, small letter, hexadecimal, non-ASCII
_KINDS[48:58, 0] = _KINDS[65:91, 1] = _KINDS[97:123, 2] = _KINDS[128:256, 4] = True
_KINDS[[*b"0123456789abcdefABCDEF"], 3] = True
#: Tables by feature: name, size.
FEATURES = (("shape", _SHAPES), ("word", _WORDS), ("prefix", _PREFIXES), ("before1", _WORDS), ("before2", _WORDS), ("before3", _WORDS), ("after1", _WORDS), ("shape_before", _SHAPES), ("file", _FILES))


@dataclass
class Tokens:
    begins: np.ndarray
    ends: np.ndarray
    line: np.ndarray  # number of each token's line
    doc: np.ndarray
    features: list[np.ndarray]


def tokens_of(block: Block) -> Tokens:
    data, size = block.data, len(block.data)
    word = _WORD_BYTE[data]
    edge = np.zeros(size + 1, dtype=bool)
    edge[block.starts] = True
    joined = np.zeros(size, dtype=bool)
    joined[1:] = word[1:] & word[:-1]
    joined &= ~edge[:size]
    begins = np.flatnonzero(~_SPACE[data] & ~joined)
    follows = np.zeros(size + 1, dtype=bool)
    follows[:size] = joined
    ends = np.flatnonzero(~_SPACE[data] & ~follows[1:]) + 1
    count = len(begins)
    doc = np.searchsorted(block.starts, begins, side="right") - 1
    breaks = edge[:size].copy()
    breaks[1:] |= data[:-1] == 10
    line = np.cumsum(breaks)[begins] if count else np.zeros(0, np.int64)
    length = ends - begins
    sums = np.zeros((5, size + 1), dtype=np.int32)
    for k in range(5):
        np.cumsum(_KINDS[:, k][data], out=sums[k, 1:])
    digits, capitals, smalls, hexes, wide = (sums[k][ends] - sums[k][begins] for k in range(5))
    is_digit = _KINDS[:, 0][data]
    change = np.zeros(size + 1, dtype=np.int32)
    np.cumsum(is_digit[1:] != is_digit[:-1], out=change[2:] if size > 1 else change[:0])
    changes = change[np.maximum(ends, 1)] - change[np.minimum(begins + 1, size)]
    lengths = np.digitize(length, (2, 3, 6, 10, 16, 24, 40))
    share = np.where(digits == 0, 0, np.where(digits == length, 4, 1 + np.digitize(digits / np.maximum(length, 1), (0.2, 0.5))))
    shape = ((((lengths * 5 + share) * 3 + np.minimum(capitals, 2)) * 2 + (smalls > 0)) * 2 + (hexes == length)) * 2 + (wide > 0)
    shape = shape * 4 + np.digitize(changes, (1, 3, 6))
    low = LOWER[data]
    hashed = Substrings(low)
    own = (hashed.of(begins, ends) >> np.uint64(52)).astype(np.int64) if count else np.zeros(0, np.int64)
    own = np.where((length <= 16) & (digits == 0), own, 0)
    head = (hashed.of(begins, np.minimum(begins + 4, ends)) >> np.uint64(54)).astype(np.int64) if count else np.zeros(0, np.int64)
    head = np.where(length >= 10, head, 0)

    def moved(values: np.ndarray, by: int) -> np.ndarray:
        """Values of the token ``by`` places on in the same line, elsewhere 1."""
        out = np.ones(count, dtype=np.int64)
        if by < 0 and count > -by:
            same = line[-by:] == line[:by]
            out[-by:][same] = values[:by][same]
        elif by > 0 and count > by:
            same = line[:-by] == line[by:]
            out[:-by][same] = values[by:][same]
        return out

    bytes_ = np.maximum(np.diff(block.starts), 1)
    equals = np.zeros(size + 1, dtype=np.int64)
    np.cumsum(data == 61, out=equals[1:])
    digit_share = (sums[0][block.starts[1:]] - sums[0][block.starts[:-1]]) / bytes_
    equal_share = (equals[block.starts[1:]] - equals[block.starts[:-1]]) / bytes_
    file = (np.digitize(bytes_, (100, 1000, 10000)) * 4 + np.digitize(digit_share, (0.001, 0.02, 0.1))) * 4 + np.digitize(equal_share, (1e-9, 0.001, 0.01))
    shape = shape.astype(np.int64)
    features = [shape, own, head, moved(own, -1), moved(own, -2), moved(own, -3), moved(own, 1), moved(shape, -1), file[doc] if count else np.zeros(0, np.int64)]
    return Tokens(begins, ends, line, doc, features)


@dataclass(frozen=True)
class Model:
    tables: list[np.ndarray]  # one (size, 3) table for each feature
    transitions: np.ndarray  # (from, to)
    initial: np.ndarray


def _forward_backward(emission: np.ndarray, mask: np.ndarray, transitions: np.ndarray, initial: np.ndarray):
    """Log partition, tag marginals and summed transition marginals of padded lines (lines x places x tags)."""
    lines, places, _ = emission.shape
    forward = np.empty_like(emission)
    forward[:, 0] = initial + emission[:, 0]
    lse = lambda x, axis: (m := x.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis=axis))
    for t in range(1, places):
        step = lse(forward[:, t - 1, :, None] + transitions, 1) + emission[:, t]
        forward[:, t] = np.where(mask[:, t, None], step, forward[:, t - 1])
    total = lse(forward[:, -1], 1)
    backward = np.zeros((lines, 3))
    marginals = np.empty_like(emission)
    pairs = np.zeros((3, 3))
    for t in range(places - 1, -1, -1):
        marginals[:, t] = np.exp(forward[:, t] + backward - total[:, None]) * mask[:, t, None]
        if t:
            inner = (emission[:, t] + backward)[:, None, :] + transitions
            joint = np.exp(forward[:, t - 1, :, None] + inner - total[:, None, None]) * mask[:, t, None, None]
            pairs += joint.sum(axis=0)
            backward = np.where(mask[:, t, None], lse(inner, 2), backward)
    return total, marginals, pairs


def fit(texts: list[str], tags: list[list[tuple[int, int]]]) -> Model:
    """Fit on lines and the character spans of their secrets, by AdaGrad ascent of the conditional log-likelihood."""
    column = pa.array(texts, pa.string())
    gathered: list[list[np.ndarray]] = []
    labels: list[np.ndarray] = []
    for block in blocks(column):
        tokens = tokens_of(block)
        for k in range(block.size):
            low, high = np.searchsorted(tokens.doc, (k, k + 1))
            if low == high:
                continue
            start = int(block.starts[k])
            text = texts[block.first + k]
            own = np.zeros(high - low, dtype=np.int64)
            for a, b in tags[block.first + k]:
                a, b = len(text[:a].encode()) + start, len(text[:b].encode()) + start
                inside = np.flatnonzero((tokens.begins[low:high] >= a) & (tokens.begins[low:high] < b))
                own[inside] = INSIDE
                own[inside[:1]] = BEGIN
            middle = int(np.flatnonzero(own)[0]) if own.any() else 0
            cut = max(0, min(middle - TRAIN_TOKENS // 2, high - low - TRAIN_TOKENS))
            gathered.append([f[low:high][cut : cut + TRAIN_TOKENS] for f in tokens.features])
            labels.append(own[cut : cut + TRAIN_TOKENS])
    lines = len(labels)
    mask = np.zeros((lines, TRAIN_TOKENS), dtype=bool)
    gold = np.zeros((lines, TRAIN_TOKENS), dtype=np.int64)
    index = [np.zeros((lines, TRAIN_TOKENS), dtype=np.int64) for _ in FEATURES]
    for k, own in enumerate(labels):
        mask[k, : len(own)] = True
        gold[k, : len(own)] = own
        for f in range(len(FEATURES)):
            index[f][k, : len(own)] = gathered[k][f]
    tables = [np.zeros((size, 3)) for _, size in FEATURES]
    transitions, initial = np.zeros((3, 3)), np.zeros(3)
    squares = [np.full(t.shape, 1e-6) for t in (*tables, transitions, initial)]
    truth = (gold[:, :, None] == np.arange(3)) & mask[:, :, None]
    true_pairs = np.zeros((3, 3))
    np.add.at(true_pairs, (gold[:, :-1][mask[:, 1:]], gold[:, 1:][mask[:, 1:]]), 1)
    used = [np.bincount(np.concatenate([np.unique(i[k][mask[k]]) for k in range(lines)]), minlength=size) >= _SEEN for i, (_, size) in zip(index, FEATURES)]
    for _ in range(_ROUNDS):
        emission = sum(table[i] for table, i in zip(tables, index))
        _, marginals, pairs = _forward_backward(emission, mask, transitions, initial)
        rest = (truth - marginals) / lines
        slopes = []
        for table, i, seen in zip(tables, index, used):
            slope = seen[:, None] * np.stack([np.bincount(i[mask], rest[:, :, y][mask], len(table)) for y in range(3)], axis=1)
            slopes.append(slope - _DECAY * table)
        slopes += [(true_pairs - pairs) / lines - _DECAY * transitions, rest[:, 0].sum(axis=0) - _DECAY * initial]
        for weight, slope, square in zip((*tables, transitions, initial), slopes, squares):
            square += slope**2
            weight += _RATE * slope / np.sqrt(square)
    transitions[OUTSIDE, INSIDE] = initial[INSIDE] = -1e4
    return Model(tables, transitions, initial)


def viterbi(emission: np.ndarray, model: Model) -> np.ndarray:
    """The best tags of one line (places x tags); ties go to the lower tag number."""
    score = model.initial + emission[0]
    back = np.zeros((len(emission), 3), dtype=np.int8)
    for t in range(1, len(emission)):
        ways = score[:, None] + model.transitions
        back[t] = ways.argmax(axis=0)
        score = ways[back[t], np.arange(3)] + emission[t]
    tags = np.zeros(len(emission), dtype=np.int8)
    tags[-1] = score.argmax()
    for t in range(len(emission) - 1, 0, -1):
        tags[t - 1] = back[t, tags[t]]
    return tags


def viterbi_all(scores: np.ndarray, lengths: np.ndarray, model: Model) -> np.ndarray:
    """The same for many lines at once: ``scores`` (lines x places x tags) padded behind each line's length; lines come longest first."""
    places = scores.shape[1]
    back = np.zeros((places, len(scores), 3), dtype=np.int8)
    score = model.initial + scores[:, 0]
    for t in range(1, places):
        n = int(np.searchsorted(-lengths, -t))  # lines that are longer than t
        ways = score[:n, :, None] + model.transitions
        back[t, :n] = ways.argmax(axis=1)
        score[:n] = ways.max(axis=1) + scores[:n, t]
    tags = np.zeros((len(scores), places), dtype=np.int8)
    row = np.arange(len(scores))
    tags[row, lengths - 1] = score.argmax(axis=1)
    for t in range(places - 1, 0, -1):
        n = int(np.searchsorted(-lengths, -t))
        tags[:n, t - 1] = back[t, row[:n], tags[:n, t]]
    return tags


class Tagger:
    def __init__(self, model: Model) -> None:
        self.model = model
        self._lift = [(t[:, 1:] - t[:, :1]).max(axis=1).astype(np.float32) for t in model.tables]
        free = model.transitions - model.transitions[OUTSIDE, OUTSIDE]
        self._slack = 2 * max(0.0, float(free.max())) + max(0.0, float((model.initial - model.initial[OUTSIDE]).max())) + 1e-3

    def spans(self, block: Block) -> Iterator[tuple[int, int, int]]:
        """(document, first byte, end) of each secret, in the block's data."""
        tokens = tokens_of(block)
        if not len(tokens.begins):
            return
        lift = np.full(len(tokens.begins), self._slack, dtype=np.float32)
        for table, index in zip(self._lift, tokens.features):
            lift += table[index]
        hot = np.flatnonzero(lift > 0)
        if not len(hot):
            return
        numbers = np.unique(tokens.line[hot])
        lows, highs = np.searchsorted(tokens.line, numbers), np.searchsorted(tokens.line, numbers, side="right")
        order = np.argsort(lows - highs, kind="stable")
        lows, lengths = lows[order], (highs - lows)[order]
        found = []
        first = 0
        while first < len(lows):  # lines of like length share a padded table
            longest = int(lengths[first])
            last = min(int(np.searchsorted(-lengths, -(longest * 3 // 4), side="right")), first + max(1, _CELLS // longest))
            own, at = lengths[first:last], np.arange(longest)
            place = np.minimum(lows[first:last, None] + at, len(tokens.line) - 1)
            scores = sum(table[index[place]] for table, index in zip(self.model.tables, tokens.features))
            tags = viterbi_all(scores, own, self.model)
            tags[at >= own[:, None]] = OUTSIDE
            for line, k in zip(*np.nonzero(tags == BEGIN)):
                end = k + 1
                while end < own[line] and tags[line, end] == INSIDE:
                    end += 1
                low = int(lows[first + line])
                found.append((int(tokens.doc[low]), int(tokens.begins[low + k]), int(tokens.ends[low + end - 1])))
            first = last
        yield from sorted(found)


_ASSIGNED = re.compile(r"""(?i)\b(?:api_?key|access_?key|auth_?token|access_?token|token|client_?secret|secret(?:_access)?(?:_key)?|passw(?:or)?d|pwd|private_?key)["']?\s*[=:]\s*["']?([^\s"']{8,})""")


def _value(r: random.Random) -> str:
    chars = lambda alphabet, n: "".join(r.choice(alphabet) for _ in range(n))
    letters = string.ascii_letters + string.digits
    hexes = "0123456789abcdef"
    kind = r.randrange(9)
    return [
        lambda: chars(hexes, r.choice((32, 40, 64))), lambda: chars(hexes, 40), lambda: chars(letters + "+/", 40), lambda: chars(letters, r.randint(16, 40)),
        lambda: "AKIA" + chars(string.ascii_uppercase + string.digits, 16), lambda: "ghp_" + chars(letters, 36), lambda: "sk-" + chars(letters, 48),
        lambda: ".".join(["eyJ" + chars(letters, 24), "eyJ" + chars(letters, 40), chars(letters + "-_", 43)]), lambda: chars(string.ascii_letters, 4) + r.choice("!#$%^*") + chars(letters, 5) + r.choice("!#$%^*") + chars(string.digits, 3),
    ][kind]()


def _planted(r: random.Random) -> tuple[str, int, int]:
    """A generated secret in its context, and its span."""
    value = _value(r)
    known = value.startswith(("AKIA", "ghp_", "sk-", "eyJ"))
    if known and r.random() < 0.4:
        return value, 0, len(value)
    name = r.choice(("token", "token", "secret", "password", "passwd", "api_key", "apikey", "access_token", "auth_token", "client_secret", "private_key", "secret_access_key", "TOKEN", "API_KEY", "SECRET_KEY"))
    before, after = r.choice(((' = "', '"'), (' = "', '"'), ("=", ""), (": ", ""), ('": "', '"'), ("='", "'")))
    head = name + before
    return head + value + after, len(head), len(head) + len(value)


def _lookalike(r: random.Random) -> str:
    chars = lambda alphabet, n: "".join(r.choice(alphabet) for _ in range(n))
    digits, hexes = string.digits, "0123456789abcdef"
    number = lambda n: chars(digits, n)
    return r.choice([
        f'commit = "{chars(hexes, 40)}"', f"sha256: {chars(hexes, 64)}", f"md5={chars(hexes, 32)}", f"commit {chars(hexes, 40)}", f"id = {number(8)}", f'name = "{chars(string.ascii_lowercase, 8)}"',
        number(16), f"+1 ({number(3)}) {number(3)}-{number(4)}", ".".join(str(r.randrange(256)) for _ in range(4)), f"{chars(string.ascii_lowercase, r.randint(2, 9))}.{number(2)}@mail{number(1)}.example.com", f"{chars(string.ascii_lowercase, r.randint(2, 9))}{number(2)}@{chars(string.ascii_lowercase, 6)}.org",
        f"https://example.com/{chars(string.ascii_lowercase, 7)}/{number(4)}", f"path=/usr/lib/{chars(string.ascii_lowercase, 9)}", f"uuid {chars(hexes, 8)}-{chars(hexes, 4)}-{chars(hexes, 4)}-{chars(hexes, 12)}", f"{chars(string.ascii_lowercase, 5)} = {number(3)}",
        "the token is", "a secret garden", "password reset", chars(string.ascii_uppercase, 12) + "!!", number(16) + "!!",
    ])


def training_lines(lines: list[str], seed: int = 7) -> tuple[list[str], list[list[tuple[int, int]]]]:
    """Lines with the spans of their secrets: found by the assignment rule, and planted in every other line."""
    r = random.Random(seed)
    texts, spans = [], []
    for number in range(max(len(lines), 400)):
        words = (lines[number] if number < len(lines) else " ".join("".join(r.choice(string.ascii_lowercase) for _ in range(r.randint(1, 9))) for _ in range(r.randint(0, 12)))).split(" ")
        at = r.randint(0, len(words))
        text, own = " ".join(words), []
        if number % 8 == 6:  # monotonous lines without secrets
            text = " ".join([words[at % len(words)]] * r.randint(2, 30))
        if number % 2:
            words = words[max(0, at - 12) : at + 12]
            at = min(at, 12)
            extra, a, b = _planted(r) if number % 4 == 1 else (_lookalike(r), 0, 0)
            head = "".join(w + " " for w in words[:at])
            text = head + extra + r.choice(("", "", "###", "!!", "%%%", ".")) * (number % 4 == 3 or extra[-1] in "\"'") + "".join(" " + w for w in words[at:])
            own = [(len(head) + a, len(head) + b)] if b else []
        own += [m.span(1) for m in _ASSIGNED.finditer(text) if not any(m.start(1) < b and a < m.end(1) for a, b in own)]
        texts.append(text)
        spans.append(own)
    return texts, spans


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", train_docs: int = TRAIN_DOCS, train_lines: int = TRAIN_LINES) -> Model:
    """Fit on lines of the ``train_docs`` documents whose ids have the smallest hashes."""
    chosen = docs.select(F.col(id_column).alias("id")).where("id is not null").orderBy(F.xxhash64("id"), "id").limit(train_docs).distinct()
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")).join(F.broadcast(chosen), "id", "left_semi")
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    picked = lines.select(F.xxhash64("line").alias("h"), F.substring("line", 1, TRAIN_CHARS).alias("line")).orderBy("h", "line").limit(train_lines)
    return fit(*training_lines([row.line for row in picked.collect()]))  # at most train_lines rows


def scan(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, start, length``: each secret's place in characters, from 0; the secret itself is not repeated."""
    sent = docs.sparkSession.sparkContext.broadcast(Tagger(model))
    schema = T.StructType([T.StructField(id_column, docs.schema[id_column].dataType), T.StructField("start", T.LongType()), T.StructField("length", T.LongType())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = sent.value
        for batch in batches:
            rows, starts, lengths = [], [], []
            for block in blocks(batch.column(1)):
                lead = None
                for doc, begin, end in tagger.spans(block):
                    if lead is None:
                        lead = np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)])
                    rows.append(block.first + doc)
                    starts.append(int(lead[begin] - lead[block.starts[doc]]))
                    lengths.append(int(lead[end] - lead[begin]))
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())], schema.names)

    return docs.select(F.col(id_column), F.col(text_column).cast("string")).mapInArrow(apply, schema)
