"""Batch tokenization for the packing operators.

The file ``word_bpe_49k.json`` lower-cases, drops white space and cuts texts into
letter runs, single digits, marks and English contractions before its merges
run.  Pieces between cuts that hold for every such text are therefore encoded
once: a batch's bytes are cut by array operations, pieces of up to 15 bytes are
looked up by their own bytes in an open-addressing table of arrays, longer ones in
a dictionary, and the ids are gathered.  What a cut can't be proven for (bytes
beyond Latin-1's letters, combining marks, the names of special tokens) stays
in one piece or goes to the library text by text.  Any other file is encoded text
by text.
"""

from __future__ import annotations

import json
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from quillspark.llm.common import WORKER_KEPT, batches_of, utf8_buffer

#: Bytes of a worker's table; beyond them the pieces used least are forgotten (the ids stay the same).
TABLE_BYTES = 64 << 20
#: Bytes of the texts whose pieces are looked up at a time, or one text; each piece takes a hundred bytes meanwhile.
PART_BYTES = 1 << 20

#: What a file must say of its normalizer and pre-tokenizer for pieces to be encoded one by one.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}

_SPACE, _LETTER, _DIGIT, _MARK, _APOSTROPHE, _OTHER = range(6)
_KEY_BYTES = 15  # the sixteenth byte of a key is the piece's length


def _byte_classes() -> np.ndarray:
    kinds = np.full(256, _MARK, np.uint8)
    kinds[[0x20, *range(0x09, 0x0E)]] = _SPACE
    for first, last, kind in (("a", "z", _LETTER), ("A", "Z", _LETTER), ("0", "9", _DIGIT), ("'", "'", _APOSTROPHE)):
        kinds[ord(first) : ord(last) + 1] = kind
    kinds[0x80:] = _OTHER
    return kinds


def _cut_between() -> np.ndarray:
    """Whether a piece always ends between bytes of two kinds (row: the first one's)."""
    cut = np.zeros((6, 6), bool)
    cut[_SPACE, :] = cut[:, _SPACE] = True
    for a in (_LETTER, _DIGIT, _MARK, _APOSTROPHE):
        for b in (_LETTER, _DIGIT, _MARK, _APOSTROPHE):
            cut[a, b] = a != b
    cut[_DIGIT, _DIGIT] = True
    cut[_APOSTROPHE, _LETTER] = False  # a contraction
    cut[_APOSTROPHE, _MARK] = cut[_MARK, _APOSTROPHE] = False  # one run of marks
    return cut


def _lower_bytes() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


_CLASSES, _CUT, _LOWER = _byte_classes(), _cut_between().ravel(), _lower_bytes()


def _byte_chars() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for the characters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_BYTE_CHARS = _byte_chars()


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceTable:
    """Ids of pieces, in arrays: keys, where a piece's ids start, how many there are, how often it was met."""

    def __init__(self) -> None:
        self._start_with(1 << 12)

    def _start_with(self, room: int) -> None:
        self.size = 0
        self.low, self.high = np.zeros(room, np.uint64), np.zeros(room, np.uint64)
        self.starts, self.counts, self.uses = (np.zeros(room, np.int32) for _ in range(3))
        self.flat, self.used = np.zeros(4 * room, np.uint32), 0
        self.cells = np.full(2 * room, -1, np.int32)
        self.long: dict[bytes, int] = {}
        self.long_bytes = 0

    @property
    def n_bytes(self) -> int:
        arrays = (self.low, self.high, self.starts, self.counts, self.uses, self.flat, self.cells)
        return sum(a.nbytes for a in arrays) + self.long_bytes

    def _cell(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mixed = (low ^ (high * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
        return (mixed >> np.uint64(64 - (len(self.cells) - 1).bit_length())).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Numbers of the pieces; -1 for unknown ones."""
        out = np.full(len(low), -1, np.int64)
        cell, open_ = self._cell(low, high), np.arange(len(low))
        while len(open_):
            at = self.cells[cell]
            a, b = low[open_], high[open_]
            met = (self.low[at] == a) & (self.high[at] == b) & (at >= 0)
            out[open_[met]] = at[met]
            on = ~met & (at >= 0)
            open_, cell = open_[on], (cell[on] + 1) & (len(self.cells) - 1)
        return out

    def _file(self, numbers: np.ndarray) -> None:
        cell = self._cell(self.low[numbers], self.high[numbers])
        while len(numbers):
            free = self.cells[cell] < 0
            self.cells[cell[free]] = numbers[free]  # of several for one cell the last stays
            on = self.cells[cell] != numbers
            numbers, cell = numbers[on], (cell[on] + 1) & (len(self.cells) - 1)

    def add(self, ids: list[list[int]], keys: tuple[np.ndarray, np.ndarray] | None, names: list[bytes] | None = None) -> np.ndarray:
        """New pieces: short ones with their keys, or long ones with their names. Their numbers."""
        n = len(ids)
        counts = np.fromiter(map(len, ids), np.int32, n)
        flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(counts.sum()))
        self._grow(n, len(flat))
        numbers = np.arange(self.size, self.size + n)
        self.flat[self.used : self.used + len(flat)] = flat
        self.starts[numbers] = self.used + np.cumsum(counts) - counts
        self.counts[numbers], self.uses[numbers] = counts, 0
        self.size, self.used = self.size + n, self.used + len(flat)
        if keys is not None:
            self.low[numbers], self.high[numbers] = keys
            self._file(numbers.astype(np.int32))
        else:
            self.low[numbers] = self.high[numbers] = 0  # no short piece has these: its key holds its length
            self.long.update(zip(names, numbers.tolist(), strict=True))
            self.long_bytes += sum(map(len, names)) + 200 * n
        return numbers

    def _grow(self, n: int, ids: int) -> None:
        while self.used + ids > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        grown = False
        while self.size + n > len(self.low):
            grown = True
            for name in ("low", "high", "starts", "counts", "uses"):
                own = getattr(self, name)
                setattr(self, name, np.concatenate([own, np.zeros(len(own), own.dtype)]))
        if grown:
            self.cells = np.full(2 * len(self.low), -1, np.int32)
            self._file(np.flatnonzero(self.high[: self.size]).astype(np.int32))

    def shrink(self, limit: int) -> None:
        """Beyond ``limit`` bytes: keep the pieces used most, up to a third of the limit."""
        if self.n_bytes <= limit:
            return
        cost = 4 * self.counts[: self.size].astype(np.int64) + 36
        names = {v: k for k, v in self.long.items()}
        for number, name in names.items():
            cost[number] += len(name) + 200
        order = np.argsort(-self.uses[: self.size], kind="stable")
        kept = np.sort(order[: int(np.searchsorted(np.cumsum(cost[order]), limit // 3))])
        ids = [self.flat[s : s + c].tolist() for s, c in zip(self.starts[kept].tolist(), self.counts[kept].tolist(), strict=True)]
        low, high, uses = self.low[kept], self.high[kept], self.uses[kept]
        short = high != 0
        self._start_with(1 << 12)
        new = [self.add([x for x, s in zip(ids, short.tolist(), strict=True) if s], (low[short], high[short]))]
        long = np.flatnonzero(~short).tolist()
        new.append(self.add([ids[i] for i in long], None, [names[int(kept[i])] for i in long]))
        self.uses[np.concatenate(new)] = np.concatenate([uses[short], uses[~short]]) // 2


_WORKER_TABLES: dict[str, PieceTable] = WORKER_KEPT


class BatchTokenizer:
    """``encode(texts) -> (ids uint32, lengths int64)``; a null text has no ids.

    ``end_id`` (if not None) follows the ids of every text, null or empty too.
    The pieces' table is the worker's, so later tasks find what earlier ones have
    encoded; ``table_bytes`` bounds it.
    """

    def __init__(self, path: str, end_id: int | None = None, table_bytes: int = TABLE_BYTES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end_id, self.table_bytes = end_id, table_bytes
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        model = {k: v for k, v in said["model"].items() if k not in ("vocab", "merges")}
        self.special = [t["content"] for t in said["added_tokens"]]
        self.piecewise = said["normalizer"] == _NORMALIZER and said["pre_tokenizer"] == _PRE_TOKENIZER and model["type"] == "BPE" and not model["dropout"] and not said["truncation"] and not said["padding"] and all(self.special)
        self.n_ids = self.tokenizer.get_vocab_size()
        self.model = self.tokenizer.model
        self.table = _WORKER_TABLES.setdefault(path, PieceTable())

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _ids_of(self, pieces: list[bytes], letters: np.ndarray) -> list[list[int]]:
        """Ids of lower-cased pieces; letters tells runs of ASCII's and Latin-1's letters, to which only the merges apply."""
        tokenize = self.model.tokenize
        out: list[list[int] | None] = [None] * len(pieces)
        rest = []
        for i, (piece, plain) in enumerate(zip(pieces, letters.tolist(), strict=True)):
            if plain:
                out[i] = [t.id for t in tokenize(piece.decode("ascii") if piece.isascii() else piece.decode("latin-1").translate(_BYTE_CHARS))]
            else:
                rest.append(i)
        for i, ids in zip(rest, self._encode([pieces[i].decode() for i in rest]), strict=True):
            out[i] = ids
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        if self.piecewise and len(texts):
            parts = [self._by_piece(part.column(0)) for part in batches_of(iter([pa.record_batch([texts], ["text"])]), "text", PART_BYTES)]
            ids, lengths = (np.concatenate(x) for x in zip(*parts, strict=True))
        else:
            ids, lengths = self._by_text(texts)
        if self.end_id is None:
            return ids, lengths
        out = np.empty(len(ids) + len(lengths), np.uint32)
        last = np.cumsum(lengths + 1) - 1
        keep = np.ones(len(out), bool)
        keep[last] = False
        out[keep], out[last] = ids, self.end_id
        return out, lengths + 1

    def _by_text(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        each = self._encode(texts.to_pylist())
        lengths = np.fromiter(map(len, each), np.int64, len(each))
        return np.fromiter(chain.from_iterable(each), np.uint32, int(lengths.sum())), lengths

    def _whole(self, texts: pa.Array, data: np.ndarray) -> np.ndarray:
        """Texts that aren't cut: combining marks may melt with the letter before them, and special tokens are taken out of a text first."""
        whole = np.zeros(len(texts), bool)
        if ((data == 0xCC) | (data == 0xCD)).any():
            whole |= pc.match_substring_regex(texts, "[\u0300-\u036f]").to_numpy(zero_copy_only=False)
        joined = data.tobytes()
        for name in self.special:
            if name.encode() in joined:
                whole |= pc.match_substring(texts, name).to_numpy(zero_copy_only=False)
        return whole

    def _by_piece(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = utf8_buffer(texts)
        whole = self._whole(texts, data)
        if not whole.any():
            return self._cut_and_gather(data, offsets)
        cut, uncut = np.flatnonzero(~whole), np.flatnonzero(whole)
        ids, n = self._cut_and_gather(*utf8_buffer(texts.take(pa.array(cut))))
        own, m = self._by_text(texts.take(pa.array(uncut)))
        lengths = np.zeros(len(texts), np.int64)
        lengths[cut], lengths[uncut] = n, m
        out = np.empty(int(lengths.sum()), np.uint32)
        of_whole = np.repeat(whole, lengths)
        out[~of_whole], out[of_whole] = ids, own
        return out, lengths

    def _cut_and_gather(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        kinds = _CLASSES[data]
        text = np.concatenate([_LOWER[data], np.zeros(16, np.uint8)])
        lead = np.flatnonzero(data == 0xC3)  # U+00C0 to U+00FF: letters but for the signs of multiplication and division
        second = data[lead + 1]
        lead, second = lead[(second != 0x97) & (second != 0xB7)], second[(second != 0x97) & (second != 0xB7)]
        kinds[lead] = kinds[lead + 1] = _LETTER
        capital = lead[second < 0x9F] + 1
        text[capital] += 32
        edge = np.empty(len(data) + 1, bool)
        edge[1:-1] = _CUT[kinds[:-1] * np.uint8(6) + kinds[1:]]
        edge[offsets] = True
        solid = kinds != _SPACE
        starts = np.flatnonzero(edge[:-1] & solid)
        sizes = np.flatnonzero(edge[1:] & solid) + 1 - starts
        numbers = self._numbers(text, starts, sizes, kinds)
        table = self.table
        table.uses[: table.size] += np.bincount(numbers, minlength=table.size).astype(np.int32)
        n = table.counts[numbers]
        ends = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
        ids = table.flat[np.repeat(table.starts[numbers].astype(np.int64) - ends[:-1], n) + np.arange(ends[-1])]
        lengths = np.diff(ends[np.searchsorted(starts, offsets)])
        table.shrink(self.table_bytes)
        return ids, lengths

    def _numbers(self, text: np.ndarray, starts: np.ndarray, sizes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Places of the pieces in the table, after those that are new were added."""
        table = self.table
        eights = np.ndarray((len(text) - 7,), "<u8", text.data, strides=(1,))
        low = eights[starts] & _MASKS[np.minimum(sizes, 8)]
        high = (eights[np.minimum(starts + 8, len(eights) - 1)] & _MASKS[np.clip(sizes - 8, 0, 7)]) | (np.minimum(sizes, 16).astype(np.uint64) << np.uint64(56))
        numbers = np.full(len(starts), -1, np.int64)
        short = sizes <= _KEY_BYTES
        own = np.flatnonzero(short)
        numbers[own] = table.find(low[own], high[own])
        new = own[numbers[own] < 0]
        odd = (kinds != _LETTER).astype(np.uint8)
        if len(new):
            order = new[np.lexsort((low[new], high[new]))]
            head = np.concatenate([[True], (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])])
            first = order[head]
            added = table.add(self._ids_of(*_pieces(text, starts[first], sizes[first], odd)), (low[first], high[first]))
            numbers[order] = added[np.cumsum(head) - 1]
        rest = np.flatnonzero(~short)
        if len(rest):
            names = [text[s : s + n].tobytes() for s, n in zip(starts[rest].tolist(), sizes[rest].tolist(), strict=True)]
            fresh = {name: i for name, i in zip(names, rest.tolist(), strict=True) if name not in table.long}
            if fresh:
                first = np.fromiter(fresh.values(), np.int64, len(fresh))
                table.add(self._ids_of(*_pieces(text, starts[first], sizes[first], odd)), None, list(fresh))
            numbers[rest] = [table.long[name] for name in names]
        return numbers


#: What of 8 bytes belongs to a piece of 0 to 8 bytes.
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def _pieces(text: np.ndarray, starts: np.ndarray, sizes: np.ndarray, odd: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The pieces, and whether they hold nothing but letters."""
    order = np.argsort(starts)
    bounds = np.empty(2 * len(starts), np.int64)
    bounds[0::2], bounds[1::2] = starts[order], starts[order] + sizes[order]
    letters = np.empty(len(starts), bool)
    letters[order] = np.maximum.reduceat(np.append(odd, np.uint8(0)), bounds)[0::2] == 0
    return [text[s : s + n].tobytes() for s, n in zip(starts.tolist(), sizes.tolist(), strict=True)], letters
