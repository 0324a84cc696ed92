"""SentencePiece encoding and decoding: pieces are located in a suffix array, and their edges relaxed by position.

For a byte-pair model an edge may follow the last piece of the text before it
only if merging would leave both pieces apart. Every prefix of a text has
exactly one such last piece, so relaxing the edges in order of their end gives
the pieces that merging gives, without merging.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colweave.llm.text import slices, span_hash

SPACE = "▁"
SLICE_BYTES = 512 << 10
KNOWN_CHUNKS = 500_000
_CODES = 0x110000
_NEVER = 1 << 40


def _merged(symbols: list[str], rank: dict[str, int]) -> tuple[list[str], tuple[str, str] | None]:
    """Merge the best-ranked neighbours, leftmost first, to the end; also the last two that were merged."""
    last = None
    while True:
        ranks = [rank.get(a + b, _NEVER) for a, b in zip(symbols, symbols[1:], strict=False)]
        at = min(range(len(ranks)), key=ranks.__getitem__, default=None)
        if at is None or ranks[at] == _NEVER:
            return symbols, last
        last = symbols[at], symbols[at + 1]
        symbols = [*symbols[:at], "".join(last), *symbols[at + 2 :]]


@dataclass(frozen=True)
class Model:
    """Arrays of a model; of bounded size (the vocabulary), so they travel with every task.

    Pieces have their ids as numbers; a character without a piece has the number size + code point.
    """

    size: int
    alphabet: np.ndarray  # characters of pieces longer than one, sorted; numbered from 1 as letters
    inside: np.ndarray  # which letters stand next to each other in some piece
    bits: int  # of a letter; a 64-bit key holds as many letters as fit
    char_codes: np.ndarray  # characters that are pieces, sorted, and their ids
    char_ids: np.ndarray
    long_ids: np.ndarray  # pieces longer than one that merging can reach, their lengths and packed characters
    long_sizes: np.ndarray
    long_keys: np.ndarray
    formed: np.ndarray  # rank at which a piece is made, -1 for characters; its two parts
    left: np.ndarray
    right: np.ndarray
    join_keys: np.ndarray  # (a * size + b) whose text is a piece, sorted, and the rank of that piece
    join_ranks: np.ndarray
    byte_ids: np.ndarray  # 256 ids, or empty
    unknown: int
    out_data: np.ndarray  # what each piece decodes to
    out_offsets: np.ndarray

    @property
    def words(self) -> int:
        return self.long_keys.shape[1]

    @property
    def per_word(self) -> int:
        return 64 // self.bits


def load(path: str) -> Model:
    """Read a byte-pair model with identity normalisation, a leading space, and spaces kept.

    Other models are refused. The file is read on the driver only.
    """
    import sentencepiece

    reader = sentencepiece.SentencePieceProcessor(model_file=path)
    if "".join(reader.encode("  a  ﬁ", out_type=str)) != f"{SPACE * 3}a{SPACE * 2}ﬁ":
        raise ValueError("the model changes its text before encoding")
    size = reader.get_piece_size()
    names = [reader.id_to_piece(i) for i in range(size)]
    special = [reader.is_control(i) or reader.is_unknown(i) or reader.is_byte(i) or reader.is_unused(i) for i in range(size)]
    normal = [i for i in range(size) if not special[i]]
    ordered = sorted({-reader.get_score(i) for i in normal})
    place = {s: k for k, s in enumerate(ordered)}
    rank = {names[i]: place[-reader.get_score(i)] for i in normal if len(names[i]) > 1}
    number = {names[i]: i for i in normal}

    formed, left, right = np.full(size, -1, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int64)
    long, joins = [], {}
    for name, r in rank.items():
        done, last = _merged(list(name), rank)
        if len(done) == 1 and all(part in number for part in last):
            i = number[name]
            formed[i], left[i], right[i] = r, number[last[0]], number[last[1]]
            long.append(i)
        for k in range(1, len(name)):
            a, b = number.get(name[:k]), number.get(name[k:])
            if a is not None and b is not None:
                joins[a * size + b] = r
    alphabet = np.array(sorted({ord(c) for n in rank for c in n}), np.int64)
    if len(alphabet) > 1 << 13:
        raise ValueError("more than 8,192 characters in pieces")
    index = {chr(c): k + 1 for k, c in enumerate(alphabet.tolist())}
    inside = np.zeros((len(alphabet) + 1, len(alphabet) + 1), bool)
    for n in rank:
        for x, y in zip(n, n[1:], strict=False):
            inside[index[x], index[y]] = True
    # One letter more than there are, as a bound above a piece adds one to its last letter.
    bits = (len(alphabet) + 1).bit_length()
    each = 64 // bits
    keys = np.zeros((len(long), -(-max((len(n) for n in rank), default=1) // each)), np.uint64)
    for row, i in enumerate(long):
        for k, c in enumerate(names[i]):
            keys[row, k // each] |= np.uint64(index[c] << (bits * (each - 1 - k % each)))
    chars = sorted((ord(names[i]), i) for i in normal if len(names[i]) == 1)
    byte_ids = {int(names[i][3:5], 16): i for i in range(size) if reader.is_byte(i)}
    out = [
        bytes([int(names[i][3:5], 16)]) if reader.is_byte(i)
        else b"" if reader.is_control(i)
        else " ⁇ ".encode() if reader.is_unknown(i)
        else names[i].replace(SPACE, " ").encode()
        for i in range(size)
    ]
    join_keys = np.array(sorted(joins), np.int64)
    return Model(
        size, alphabet, inside, bits,
        np.array([c for c, _ in chars], np.int64), np.array([i for _, i in chars], np.int64),
        np.array(long, np.int64), np.array([len(names[i]) for i in long], np.int64), keys, formed, left, right,
        join_keys, np.array([joins[k] for k in join_keys.tolist()], np.int64),
        np.array([byte_ids[b] for b in range(256)] if len(byte_ids) == 256 else [], np.int64), reader.unk_id(),
        np.frombuffer(b"".join(out), np.uint8), np.concatenate([[0], np.cumsum([len(o) for o in out])]),
    )


def _member(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the sorted table, whether it is there)"""
    if not len(table):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


def _spread(values: np.ndarray, offsets: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """values[offsets[c]:offsets[c + 1]] for every chosen c, one after the other."""
    many = offsets[chosen + 1] - offsets[chosen]
    ends = np.cumsum(many)
    if not len(ends) or not ends[-1]:
        return values[:0]
    return values[np.repeat(offsets[chosen] - (ends - many), many) + np.arange(ends[-1])]


class _Encoder:
    """Encodes slices; remembers the chunks it has seen, up to ``KNOWN_CHUNKS``, to index each once."""

    def __init__(self, model: Model) -> None:
        self.m = model
        self.letter = np.zeros(_CODES, np.int16)
        self.letter[model.alphabet] = np.arange(1, len(model.alphabet) + 1)
        self.single = np.arange(model.size, model.size + _CODES, dtype=np.int32)
        self.single[model.char_codes] = model.char_ids
        self._forget()
        self.pair_keys, self.pair_apart = np.zeros(0, np.int64), np.zeros(0, bool)

    def _forget(self) -> None:
        self.hashes, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.tokens, self.offsets = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets per text)"""
        marked = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum([len(t) for t in marked])
        if not len(codes):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        # No piece spans two neighbours that stand together in no piece: the chunks between are independent.
        cut = np.ones(len(codes), bool)
        letters = self.letter[codes]
        cut[1:] = ~self.m.inside[letters[:-1], letters[1:]]
        cut[ends[ends < len(codes)]] = True
        starts = np.flatnonzero(cut)
        stops = np.append(starts[1:], len(codes))
        hashes, where, back = np.unique(span_hash(codes, starts, stops), return_index=True, return_inverse=True)
        if len(self.hashes) + len(hashes) > KNOWN_CHUNKS:
            self._forget()
        fresh = ~_member(hashes, self.hashes)[1]
        if fresh.any():
            new = where[fresh]
            tokens, offsets = self._encode_chunks(codes, starts[new], stops[new])
            rows = np.concatenate([self.rows, len(self.offsets) - 1 + np.arange(len(new))])
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + offsets[1:]])
            self.tokens = np.concatenate([self.tokens, tokens])
            known = np.concatenate([self.hashes, hashes[fresh]])
            order = np.argsort(known, kind="stable")
            self.hashes, self.rows = known[order], rows[order]
        chunk = self.rows[np.searchsorted(self.hashes, hashes)][back]
        many = np.concatenate([[0], np.cumsum(self.offsets[chunk + 1] - self.offsets[chunk])])
        bounds = many[np.searchsorted(starts, np.concatenate([[0], ends]))]
        return _spread(self.tokens, self.offsets, chunk), bounds

    def _edges(self, codes: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, row of the piece) of every place of a piece: binary search in the sorted suffixes.

        ``codes`` is the text of all chunks; ``room`` is how many characters are left in the chunk.
        """
        m, n = self.m, len(codes)
        letter = self.letter[codes].astype(np.uint64)
        keys = []
        for w in range(m.words):
            key = np.zeros(n, np.uint64)
            for k in range(m.per_word):
                step = m.per_word * w + k
                if step < n:
                    ahead = np.where(room[: n - step] > step, letter[step:], 0)
                    key[: n - step] |= ahead << np.uint64(m.bits * (m.per_word - 1 - k))
            keys.append(key)
        # Suffixes are told apart by as many characters as the longest piece has.
        order = np.lexsort(keys[::-1])
        ranked = [k[order] for k in keys]

        def bound(targets: np.ndarray) -> np.ndarray:
            """How many suffixes are smaller, for all pieces at once."""
            low, high = np.searchsorted(ranked[0], targets[:, 0], "left"), np.searchsorted(ranked[0], targets[:, 0], "right")
            while (low < high).any():
                mid = np.minimum((low + high) >> 1, n - 1)
                less = np.zeros(len(targets), bool)
                for w in range(m.words - 1, -1, -1):
                    seen = ranked[w][mid]
                    less = (seen < targets[:, w]) | ((seen == targets[:, w]) & less)
                open_ = low < high
                low, high = np.where(open_ & less, mid + 1, low), np.where(open_ & ~less, mid, high)
            return low

        after = m.long_keys.copy()
        last = m.long_sizes - 1
        after[np.arange(len(last)), last // m.per_word] += np.uint64(1) << (
            m.bits * (m.per_word - 1 - last % m.per_word)
        ).astype(np.uint64)
        first, stop = bound(m.long_keys), bound(after)
        return _ranges(order, first, stop)

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the text of pieces a and b leaves them apart."""
        m, span = self.m, self.m.size + _CODES
        keys, back = np.unique(a * span + b, return_inverse=True)
        fresh = keys[~_member(keys, self.pair_keys)[1]]
        if len(fresh):
            known = np.concatenate([self.pair_keys, fresh])
            apart = np.concatenate([self.pair_apart, self._walk(fresh // span, fresh % span)])
            order = np.argsort(known, kind="stable")
            self.pair_keys, self.pair_apart = known[order], apart[order]
            if len(known) > 4 * KNOWN_CHUNKS:
                keep = _member(self.pair_keys, keys)[1]
                self.pair_keys, self.pair_apart = self.pair_keys[keep], self.pair_apart[keep]
        return self.pair_apart[np.searchsorted(self.pair_keys, keys)][back]

    def _walk(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Undo the merges of a and b from the latest back; they meet if their neighbours at some time join earlier
        than either is used up. At equal rank the left merge comes first."""
        m = self.m
        apart = np.ones(len(a), bool)
        live = np.flatnonzero((a < m.size) & (b < m.size))
        a, b = a[live], b[live]
        gone_a, gone_b = np.full(len(a), _NEVER), np.full(len(a), _NEVER)
        while len(live):
            at, joins = _member(a * m.size + b, m.join_keys)
            rank = m.join_ranks[at] if len(m.join_ranks) else at
            meet = joins & (rank < gone_a) & (rank <= gone_b)
            apart[live[meet]] = False
            made_a, made_b = m.formed[a], m.formed[b]
            undo_b = made_b >= made_a
            go = ~meet & (np.maximum(made_a, made_b) >= 0)
            gone_a, gone_b = np.where(undo_b, gone_a, made_a)[go], np.where(undo_b, made_b, gone_b)[go]
            a, b = np.where(undo_b, a, m.right[a])[go], np.where(undo_b, m.left[b], b)[go]
            live = live[go]
        return apart

    def _encode_chunks(self, all_codes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets per chunk) of the given chunks."""
        m, sizes = self.m, stops - starts
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        n = int(offsets[-1])
        codes = all_codes[np.repeat(starts - offsets[:-1], sizes) + np.arange(n)]
        begin = np.repeat(offsets[:-1], sizes)
        room = np.repeat(offsets[1:], sizes) - np.arange(n)
        single = self.single[codes].astype(np.int64)
        several = np.flatnonzero(np.repeat(sizes > 1, sizes))
        where, row = self._edges(codes[several], room[several]) if len(several) else (several, several)
        where = several[where]
        source = np.concatenate([np.arange(n), where])
        piece = np.concatenate([single, m.long_ids[row]])
        width = np.concatenate([np.ones(n, np.int64), m.long_sizes[row]])
        reach = source - begin[source] + width
        order = np.argsort(reach.astype(np.uint16) if reach.max() < 1 << 16 else reach, kind="stable")
        source, piece, width, reach = source[order], piece[order], width[order], reach[order]
        groups = np.searchsorted(reach, np.arange(1, reach[-1] + 2))
        last, length = np.full(n + 1, -1, np.int64), np.zeros(n + 1, np.int64)  # of the piece that ends after a character
        for lo, hi in zip(groups[:-1], groups[1:], strict=True):
            s, p = source[lo:hi], piece[lo:hi]
            inner = s > begin[s]
            ok = ~inner
            if inner.any():
                ok[inner] = self._apart(last[s[inner] - 1], p[inner])
            end = s[ok] + width[lo:hi][ok] - 1
            last[end], length[end] = p[ok], width[lo:hi][ok]
        # Walk back from the ends of all chunks at once.
        here, chunk = offsets[1:] - 1, np.arange(len(sizes))
        ends = []
        while len(here):
            ends.append(here)
            here = here - length[here]
            keep = here >= offsets[chunk]
            here, chunk = here[keep], chunk[keep]
        taken = np.sort(np.concatenate(ends))
        ids, owner = last[taken], np.searchsorted(offsets, taken, "right") - 1
        strange = np.flatnonzero(ids >= m.size)
        many = np.ones(len(ids), np.int64)
        if len(strange) and len(m.byte_ids):
            raw = [chr(c).encode("utf-8", "surrogatepass") for c in (ids[strange] - m.size).tolist()]
            many[strange] = [len(r) for r in raw]
            ids = np.repeat(ids, many)
            ids[ids >= m.size] = m.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        else:
            ids = np.where(ids >= m.size, m.unknown, ids)
        counts = np.bincount(owner, many, len(sizes)).astype(np.int64)
        return ids.astype(np.int32), np.concatenate([[0], np.cumsum(counts)])


def _ranges(order: np.ndarray, first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """order[first:stop] of every row, with the row."""
    many = stop - first
    total = np.cumsum(many)
    step = np.arange(total[-1] if len(total) else 0)
    row = np.repeat(np.arange(len(many)), many)
    return order[first[row] + step - (total - many)[row]], row


_encoders: list[_Encoder] = []


def _encoder(model: Model) -> _Encoder:
    """The worker's encoder, kept between tasks as long as the vocabulary is the same."""
    if not _encoders or not all(
        np.array_equal(getattr(_encoders[0].m, f), getattr(model, f)) for f in ("out_data", "out_offsets", "long_keys", "formed")
    ):
        _encoders[:] = [_Encoder(model)]
    return _encoders[0]


def _kinds(docs: DataFrame) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema.fields)


def encode(docs: DataFrame, model: Model) -> DataFrame:
    """All rows and columns of documents (text) with ``ids``, an array of piece numbers.

    A null text has null ids and an empty one none. Texts of any length are
    encoded whole. Input columns called ids are replaced. Nothing is shuffled; a
    task holds one slice of texts, or one text if that is longer, and its chunks.
    """
    docs = docs.drop("ids").withColumn("text", F.col("text").cast("string"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model)
        for part in slices(batches, "text", SLICE_BYTES):
            texts = part.column("text").to_pylist()
            ids, offsets = encoder.encode(texts)
            gone = pa.array([t is None for t in texts] + [False])
            places = pa.array(offsets, pa.int32(), mask=gone.to_numpy(zero_copy_only=False)) if None in texts else pa.array(offsets, pa.int32())
            lists = pa.ListArray.from_arrays(places, pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, "ids"])

    return docs.mapInArrow(run, f"{_kinds(docs)}, ids array<int>")


def decode(encoded: DataFrame, model: Model) -> DataFrame:
    """All rows and columns of a table (ids) with ``decoded``, the text that the ids stand for.

    Null ids give a null text; null or unknown numbers in the array, and bytes
    that are not UTF-8, give the replacement character or nothing. Input columns called decoded are replaced.
    """
    encoded = encoded.drop("decoded")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                lists = part.column("ids")
                ids = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                many = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                ids = np.where((ids >= 0) & (ids < model.size), ids, model.unknown)
                raw = _spread(model.out_data, model.out_offsets, ids).tobytes()
                sizes = np.concatenate([[0], np.cumsum(model.out_offsets[ids + 1] - model.out_offsets[ids])])
                ends = np.concatenate([[0], np.cumsum(many)])
                texts = []
                for a, b, valid in zip(sizes[ends[:-1]], sizes[ends[1:]], lists.is_valid().to_pylist(), strict=True):
                    text = raw[a:b].decode("utf-8", "replace")
                    texts.append((text[1:] if text[:1] == " " else text) if valid else None)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "decoded"])

    return encoded.mapInArrow(run, f"{_kinds(encoded)}, decoded string")
