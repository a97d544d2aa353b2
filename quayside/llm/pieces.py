"""SentencePiece encoding and decoding by suffix-array matching.

For a model of merges (type BPE, identity normalisation, byte fallback), which is read from its
file and never trained here. A batch of texts is encoded at once:

1. The texts fall apart wherever no piece spans the two characters next to each other; no merge
   can cross such a place. Equal parts are encoded once. The distinct parts are concatenated.
2. Index: a suffix array of the concatenation, ordered by as many characters as the longest piece
   has, made by doubling ranks.
3. Every piece is searched in it by binary search; the range found holds its occurrences, which
   are edges from their first to past their last character.
4. The edges are sorted by the position where they end and relaxed in this order: the piece
   that ends the encoding of a prefix is the one edge whose piece the merges would keep apart from the
   piece before it. Following the pieces back from the end gives the encoding.

Two pieces stay apart if undoing their merges, latest first, never uncovers a pair that would have
merged earlier. Results are those of the merges themselves, not an approximation.

Characters without a piece become bytes. A null text gives null, an empty one no piece. Rows are
independent. Memory follows the bytes of a batch, or the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import arrays
from quayside.llm.common import prepare, schema_with

MARK = "▁"
#: Characters of a code that a 64-bit key holds: 16 bits each.
PACKED = 4
CACHE = 1 << 20
#: Bytes of text that are indexed at once; the index takes about 200 times as much memory.
SLICE_BYTES = 1 << 20
U64 = arrays.U64


@dataclass
class Vocabulary:
    """Pieces in the order of their merges: single characters first."""

    pieces: list[str]
    ids: np.ndarray
    #: The two pieces that were merged last; single characters have themselves.
    left: np.ndarray
    right: np.ndarray
    #: Pairs that merge, as left << 32 | right in ascending order, and what they become.
    pairs: np.ndarray
    merged: np.ndarray
    byte_ids: np.ndarray
    #: For decoding: the bytes of every id.
    id_bytes: list[bytes]

    @cached_property
    def codes(self) -> np.ndarray:
        """The code of each character that has a piece, from 1 on; 0 for the others."""
        table = np.zeros(0x110000, dtype=np.uint16)
        for code, piece in enumerate((p for p in self.pieces if len(p) == 1), 1):
            table[ord(piece)] = code
        return table

    @cached_property
    def spanned(self) -> np.ndarray:
        """Which two character codes stand next to each other in some piece."""
        size = int(self.codes.max()) + 1
        table = np.zeros((size, size), dtype=bool)
        for piece in self.pieces:
            if len(piece) > 1:
                code = self.codes[[ord(c) for c in piece]]
                table[code[:-1], code[1:]] = True
        return table

    @cached_property
    def lengths(self) -> np.ndarray:
        return np.array([len(p) for p in self.pieces])

    @cached_property
    def keys(self) -> np.ndarray:
        """Codes of each piece, padded with 0 to a power of two of at least PACKED columns."""
        width = PACKED
        while width < self.lengths.max():
            width *= 2
        table = np.zeros((len(self.pieces), width), dtype=np.uint16)
        for row, piece in enumerate(self.pieces):
            table[row, : len(piece)] = self.codes[[ord(c) for c in piece]]
        return table


def _last_merge(text: str, rank: dict[str, int]) -> tuple[str, str] | None:
    """The two parts that become the text last, if the merges make it one piece at all.

    The best pair merges first, the leftmost of equal ones.
    """
    parts, last = list(text), (text, text)
    while len(parts) > 1:
        options = [(rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in rank]
        if not options:
            return None
        i = min(options)[1]
        last = (parts[i], parts[i + 1])
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return last


def load(path: str) -> Vocabulary:
    """Read a model file on the driver; the vocabulary is what tasks need."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    spec = model.normalizer_spec
    if model.trainer_spec.model_type != model.trainer_spec.BPE or not model.trainer_spec.byte_fallback:
        raise ValueError("needs a model of merges with byte fallback")
    if spec.name != "identity" or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
        raise ValueError("needs identity normalisation with a prefix")
    kind = sentencepiece_model_pb2.ModelProto.SentencePiece
    normal = [(i, p) for i, p in enumerate(model.pieces) if p.type == kind.NORMAL]
    normal.sort(key=lambda x: (len(x[1].piece) > 1, -x[1].score))
    rank = {p.piece: i for i, (_, p) in enumerate(normal)}
    split = {p.piece: _last_merge(p.piece, rank) for _, p in normal}
    keep = [(i, p.piece) for i, p in normal if split[p.piece]]
    place = {text: n for n, (_, text) in enumerate(keep)}
    left = np.array([place[split[text][0]] for _, text in keep], dtype=np.int64)
    right = np.array([place[split[text][1]] for _, text in keep], dtype=np.int64)
    pairs = sorted(
        (place[text[:i]] << 32 | place[text[i:]], place[text])
        for text in place
        for i in range(1, len(text))
        if text[:i] in place and text[i:] in place
    )
    byte_ids = np.zeros(256, dtype=np.int64)
    id_bytes = []
    for i, p in enumerate(model.pieces):
        if p.type == kind.BYTE:
            byte_ids[int(p.piece[1:-1], 16)] = i
            id_bytes.append(bytes([int(p.piece[1:-1], 16)]))
        elif p.type == kind.CONTROL:
            id_bytes.append(b"")
        elif p.type == kind.UNKNOWN:
            id_bytes.append(model.trainer_spec.unk_surface.encode())
        else:
            id_bytes.append(p.piece.replace(MARK, " ").encode())
    return Vocabulary(
        [text for _, text in keep],
        np.array([i for i, _ in keep]),
        left,
        right,
        np.array([k for k, _ in pairs], dtype=np.int64),
        np.array([v for _, v in pairs], dtype=np.int64),
        byte_ids,
        id_bytes,
    )


def ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An ascending order of the keys, the rank of each among the distinct ones, and these."""
    order = np.argsort(key)
    ascending = key[order]
    new = np.append(True, ascending[1:] != ascending[:-1])[: len(key)]
    rank = np.empty(len(key), dtype=np.int64)
    rank[order] = np.cumsum(new) - 1
    return order, rank, ascending[new]


class Index:
    """A suffix array over character codes, ordered by the first ``width`` of them."""

    def __init__(self, codes: np.ndarray, width: int):
        padded = np.concatenate([codes, np.zeros(width, dtype=codes.dtype)]).astype(U64)
        count = len(codes)
        key = np.zeros(count, dtype=U64)
        for i in range(PACKED):
            key = key << U64(16) | padded[i : i + count]
        #: Distinct keys of each level in order, and the rank of each suffix at that level.
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        step = PACKED
        while True:
            self.order, rank, distinct = ranked(key)
            self.levels.append((distinct, rank))
            if step >= width:
                break
            behind = np.zeros(count, dtype=np.int64)
            # Past the end nothing follows; it gets the rank of the padding, or less than any.
            behind[: max(0, count - step)] = rank[step:] + 1
            key = rank.astype(np.int64) << 32 | behind
            step *= 2
        self.sorted = [rank[self.order] for _, rank in self.levels]

    def _ranks(self, level: int, keys: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks at a level whose suffixes begin with the keys: from, to (exclusive)."""
        distinct = self.levels[level][0]
        if level == 0:
            low = np.zeros(len(keys), dtype=U64)
            high = np.zeros(len(keys), dtype=U64)
            for i in range(PACKED):
                inside = i < lengths
                low = low << U64(16) | np.where(inside, keys[:, i], 0).astype(U64)
                high = high << U64(16) | np.where(inside, keys[:, i], 0xFFFF).astype(U64)
            return np.searchsorted(distinct, low), np.searchsorted(distinct, high, side="right")
        half = PACKED << (level - 1)
        begin, end = self._ranks(level - 1, keys[:, :half], np.minimum(lengths, half))
        longer = lengths > half
        after_from, after_to = self._ranks(level - 1, keys[:, half:], np.maximum(lengths - half, 0))
        # The first half of a longer piece is complete, so it has one rank or none.
        low = np.where(longer, begin << 32 | (after_from + 1), begin << 32)
        high = np.where(longer, begin << 32 | (after_to + 1), end << 32)
        from_, to = np.searchsorted(distinct, low), np.searchsorted(distinct, high)
        empty = longer & (end <= begin)
        return np.where(empty, 0, from_), np.where(empty, 0, to)

    def ranges(self, keys: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parts of ``order`` that hold the places where the keys occur."""
        top = len(self.levels) - 1
        begin, end = self._ranks(top, keys, lengths)
        return np.searchsorted(self.sorted[top], begin), np.searchsorted(self.sorted[top], end)


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.known = np.full(CACHE, -1, dtype=np.int64)
        self.apart = np.zeros(CACHE, dtype=bool)

    def _stay_apart(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether the merges keep two pieces apart, for arrays of pairs."""
        v = self.v
        result = np.ones(len(first), dtype=bool)
        left, right = first.copy(), second.copy()
        limit = np.full(len(first), np.iinfo(np.int64).max)
        active = np.arange(len(first))
        while len(active):
            a, b = left[active], right[active]
            pair = a << 32 | b
            at = np.searchsorted(v.pairs, pair).clip(max=len(v.pairs) - 1)
            merges = (v.pairs[at] == pair) & (v.merged[at] < limit[active])
            result[active[merges]] = False
            active, a, b = active[~merges], a[~merges], b[~merges]
            # Undo the later one of the two; a single character is left as it is.
            single_a, single_b = v.left[a] == a, v.left[b] == b
            undo_a = (a > b) & ~single_a | single_b
            going = ~(single_a & single_b)
            active, a, b, undo_a = active[going], a[going], b[going], undo_a[going]
            left[active] = np.where(undo_a, v.right[a], a)
            right[active] = np.where(undo_a, b, v.left[b])
            limit[active] = np.where(undo_a, a, b + 1)
        return result

    def stay_apart(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        pair = first << 32 | second
        slot = (arrays.mixed(pair.view(U64)) & U64(CACHE - 1)).astype(np.int64)
        result = self.apart[slot]
        new = np.flatnonzero(self.known[slot] != pair)
        if len(new):
            distinct, back = np.unique(pair[new], return_inverse=True)
            found = self._stay_apart(distinct >> 32, distinct & 0xFFFFFFFF)[back]
            result[new] = found
            # Slots of these pairs may have been taken from each other, so both go together.
            self.known[slot[new]] = pair[new]
            self.apart[slot[new]] = found
            last = self.known[slot[new]] == pair[new]
            self.apart[slot[new][last]] = found[last]
        return result

    def parts(self, codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of the parts that begin at ``first``: flat, and where each part's begin.

        codes: characters of the distinct parts, each followed by a 0.
        """
        v = self.v
        count = len(codes)
        index = Index(codes, v.keys.shape[1])
        begin, end = index.ranges(v.keys, v.lengths)
        n = end - begin
        piece = np.repeat(np.arange(len(n)), n)
        place = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(len(piece))
        start = index.order[place]
        del index
        stop = start + v.lengths[piece]
        # Edges of all parts that end as many characters into their part are relaxed together.
        part = np.repeat(np.arange(len(first)), np.diff(np.append(first, count)))[start]
        reach = stop - first[part]
        # Sixteen bits sort in linear time, and few parts are longer.
        order = np.argsort(reach.astype(np.uint16) if reach.max(initial=0) < 1 << 16 else reach, kind="stable")
        start, stop, piece, reach, part = start[order], stop[order], piece[order], reach[order], part[order]
        begins = start == first[part]
        ends = np.append(first[1:], count) - 1
        #: The last piece of the encoding of what comes before each place.
        last = np.full(count + 1, -1, dtype=np.int64)
        steps = np.append(np.flatnonzero(np.append(True, reach[1:] != reach[:-1])), len(reach))
        for a, b in zip(steps[:-1], steps[1:]):
            some = slice(a, b)
            good = begins[some].copy()
            inner = np.flatnonzero(~good) + a
            before = last[start[inner]]
            fits = np.zeros(len(inner), dtype=bool)
            there = before >= 0
            fits[there] = self.stay_apart(before[there], piece[inner[there]])
            good[inner - a] = fits
            last[stop[some][good]] = piece[some][good]
        # Back from the ends, all parts at once.
        owner, at, found = np.arange(len(first)), ends.copy(), []
        while len(owner):
            token = last[at]
            found.append((owner, token))
            at = at - v.lengths[token]
            more = at > first[owner]
            owner, at = owner[more], at[more]
        owners = np.concatenate([o for o, _ in found]) if found else np.zeros(0, dtype=np.int64)
        depth = np.repeat(np.arange(len(found)), [len(o) for o, _ in found])
        tokens = np.concatenate([t for _, t in found]) if found else owners
        sizes = np.bincount(owners, minlength=len(first))
        bounds = np.append(0, np.cumsum(sizes))
        # The piece found first is the last one of its part.
        flat = np.empty(len(tokens), dtype=np.int64)
        flat[bounds[1:][owners] - 1 - depth] = tokens
        return flat, bounds

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and where each text's begin."""
        v = self.v
        marked = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
        at = np.append(0, np.cumsum([len(t) for t in marked]))
        chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        if not len(chars):
            return np.zeros(0, dtype=np.int32), np.zeros(len(texts) + 1, dtype=np.int64)
        codes = v.codes[chars]
        cut = np.ones(len(chars), dtype=bool)
        cut[1:] = ~v.spanned[codes[:-1], codes[1:]]
        cut[at[:-1][at[:-1] < len(chars)]] = True
        start = np.flatnonzero(cut)
        size = np.diff(np.append(start, len(chars)))
        key = arrays.Runs(chars.astype(U64) + U64(1), seed=5).of(start, start + size)
        order, part, distinct = ranked(key)
        which = np.empty(len(distinct), dtype=np.int64)
        which[part] = np.arange(len(part))
        rep = start[which]
        # Equal hashes are checked by all characters; else every part is one of its own.
        offset = np.arange(len(chars)) - np.repeat(start, size)
        if (size != size[which][part]).any() or (chars[np.repeat(rep[part], size) + offset] != chars).any():
            which, part = np.arange(len(start)), np.arange(len(start))
            rep = start
        del offset, key, order, distinct
        long = size[which]
        known = np.flatnonzero(codes[rep] > 0)
        widths = long[known] + 1
        first = np.cumsum(widths) - widths
        flat = np.zeros(int(widths.sum()), dtype=np.uint16)
        inside = np.arange(len(flat)) - np.repeat(first, widths)
        real = inside < np.repeat(widths - 1, widths)
        flat[real] = codes[(np.repeat(rep[known], widths) + inside)[real]]
        tokens, bounds = self.parts(flat, first) if len(known) else (np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64))
        ids = [v.ids[tokens]]
        begin = np.zeros(len(which), dtype=np.int64)
        many = np.zeros(len(which), dtype=np.int64)
        begin[known], many[known] = bounds[:-1], np.diff(bounds)
        used = len(tokens)
        for other in np.flatnonzero(codes[rep] == 0):
            raw = np.frombuffer(chr(chars[rep[other]]).encode("utf-8", "surrogatepass"), dtype=np.uint8)
            ids.append(v.byte_ids[raw])
            begin[other], many[other] = used, len(raw)
            used += len(raw)
        pool = np.concatenate(ids).astype(np.int32)
        count = many[part]
        total = np.append(0, np.cumsum(count))
        source = np.repeat(begin[part] - total[:-1], count) + np.arange(total[-1])
        return pool[source], total[np.searchsorted(start, at)]


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        size = np.array([len(b) for b in vocabulary.id_bytes])
        self.size, self.begin = size, np.cumsum(size) - size
        self.bytes = np.frombuffer(b"".join(vocabulary.id_bytes), dtype=np.uint8)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        size = self.size[ids]
        total = np.append(0, np.cumsum(size))
        out = self.bytes[np.repeat(self.begin[ids] - total[:-1], size) + np.arange(total[-1])].tobytes()
        ends = total[bounds]
        # The first piece brings the space that was put before the text.
        return [
            out[a + (out[a : a + 1] == b" ") : b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])
        ]


_ready: dict[int, tuple[Encoder, Decoder]] = {}


def _tools(vocabulary) -> tuple[Encoder, Decoder]:
    """Made once in a worker, as tables and the cache of pairs are kept from batch to batch."""
    if id(vocabulary) not in _ready:
        _ready.clear()
        _ready[id(vocabulary)] = Encoder(vocabulary), Decoder(vocabulary)
    return _ready[id(vocabulary)]


def pieces_of(text: str, limit: int, v: Vocabulary) -> list[str]:
    """A long text cut at single spaces that no piece of the vocabulary spans, the space left out.

    Encoding puts a space before each, so their ids follow each other as those of the text do. A stretch
    without such a space stays whole.
    """
    mark = v.codes[ord(MARK)]

    def ends(at: int) -> bool:
        last = text[at - 1]
        return last != " " and at + 1 < len(text) and not v.spanned[v.codes[ord(last)], mark]

    out, begin = [], 0
    while len(text) - begin > limit:
        at = text.rfind(" ", begin + 1, begin + limit)
        while at > 0 and not ends(at):
            at = text.rfind(" ", begin + 1, at)
        if at < 0:
            at = text.find(" ", begin + limit)
            while at > 0 and not ends(at):
                at = text.find(" ", at + 1)
        if at < 0:
            break
        out.append(text[begin:at])
        begin = at + 1
    return [*out, text[begin:]]


def _each(encoder: Encoder, decoder: Decoder, texts: list[str], and_decode: bool):
    """Ids, where each text's begin, and the decoded texts; of a single long text piece by piece."""
    if len(texts) > 1 or len(texts[0]) <= SLICE_BYTES:
        ids, bounds = encoder.encode(texts)
        return ids, bounds, decoder.decode(ids, bounds) if and_decode else None
    found, back = [], []
    for piece in pieces_of(texts[0], SLICE_BYTES, encoder.v):
        ids, bounds = encoder.encode([piece])
        found.append(ids)
        back += decoder.decode(ids, bounds) if and_decode else []
    ids = np.concatenate(found)
    return ids, np.array([0, len(ids)]), [" ".join(back)] if and_decode else None


def _encoded(vocabulary, and_decode: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _tools(vocabulary.value)
        for batch, _ in arrays.slices(batches, "text", SLICE_BYTES):
            texts = batch.column("text")
            none = texts.is_null()
            ids, bounds, back = _each(encoder, decoder, texts.fill_null("").to_pylist(), and_decode)
            added = {"ids": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids), mask=none)}
            if and_decode:
                added["decoded"] = pa.array(back, pa.string(), mask=none.to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in batch.schema.names), *added.values()],
                [*batch.schema.names, *added],
            )

    return run


def _decoded(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = _tools(vocabulary.value)
        for batch in batches:
            column = batch.column("ids")
            bounds = column.offsets.to_numpy().astype(np.int64)
            values = column.values.to_numpy(zero_copy_only=False)[bounds[0] : bounds[-1]]
            done, texts = 0, []
            # As many rows at a time as have about a million ids.
            parts = np.unique(np.append(np.searchsorted(bounds - bounds[0], np.arange(0, len(values), 1 << 20)), len(column)))
            for a, b in zip(np.append(0, parts), parts):
                own = bounds[a : b + 1] - bounds[0]
                texts += decoder.decode(values[own[0] : own[-1]], own - own[0]) if b > a else []
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in batch.schema.names),
                    pa.array([t if ok else None for t, ok in zip(texts, column.is_valid().to_pylist())], pa.string()),
                ],
                [*batch.schema.names, "decoded"],
            )

    return run


def encode(docs: DataFrame, vocabulary: Vocabulary, and_decode: bool = False) -> DataFrame:
    """The columns of docs (with a text) and ids, the pieces of the text. An ids column is replaced.

    ``and_decode`` adds what ``decode`` would, in the same tasks.
    """
    spark = docs.sparkSession
    prepare(spark)
    added = "ids array<int>" + ", decoded string" * and_decode
    docs = docs.drop("ids", *["decoded"] * and_decode).withColumn("text", F.col("text").cast("string"))
    return docs.mapInArrow(
        _encoded(spark.sparkContext.broadcast(vocabulary), and_decode), schema_with(docs, added)
    )


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The columns given (with ids) and decoded, the text of the pieces. A decoded column is replaced."""
    spark = encoded.sparkSession
    prepare(spark)
    encoded = encoded.drop("decoded")
    return encoded.mapInArrow(
        _decoded(spark.sparkContext.broadcast(vocabulary)), schema_with(encoded, "decoded string")
    )
