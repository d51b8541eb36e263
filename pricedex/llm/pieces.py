"""SentencePiece BPE encoding with spans in the original bytes, and decoding, from a model file of that library.

The file's protocol buffer is read here: pieces with scores and types, and the normaliser's settings with its compiled
character map (a double-array trie over UTF-8 bytes, then replacement strings). Normalisation takes the longest prefix
of the rest of the text that the map knows, else one character, and writes for every byte it puts out where in the
original text that came from. Spaces become the piece mark; a mark stands before the text if the model asks for it.

Pieces: adjacent symbols merge by highest score, the left pair first among equals. No piece has a mark behind another
character, and characters that no longer piece contains cannot merge, so a text falls apart at these places into words that
merge alone; a worker remembers the pieces of words. A character that is no piece becomes its bytes' pieces. Every piece's
bytes in the normalised text are projected to the original through the alignment; of a character's byte pieces the last
has its span and the others are empty at its start.

Cases: null text counts as empty and has no pieces; a text of any length is held by one task, once, with its pieces;
control pieces' names in a text are ordinary text; decoding leaves control pieces out, turns the mark into a space (less the
one put before the text) and bytes that are no UTF-8 into U+FFFD each; null ids of documents and repeated rows stay as
they are; an empty table gives an empty table; extra columns are not read.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the file format: piece types, the mark that stands for a space, the replacement character.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MARK = "▁"
REPLACEMENT = "�"
BPE = 2

CACHE = 300_000  # words a worker remembers, and as many from before
LONG_WORD = 256  # characters; longer words are not remembered
SLICE = 1 << 19  # bytes, or ids, of the rows that are handled together
NEVER = 1 << 31  # rank of pairs that do not merge


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message's fields: integers, or raw bytes of fixed and length-delimited ones."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at: at + size]
        at += size


@dataclass
class NormaliserSpec:
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra_spaces: bool = True
    escape_spaces: bool = True

    @classmethod
    def parse(cls, data: bytes) -> NormaliserSpec:
        found = dict(_fields(data))
        return cls(found.get(2, b""), bool(found.get(3, 1)), bool(found.get(4, 1)), bool(found.get(5, 1)))


class CharacterMap:
    """The compiled map: the longest known prefix of some bytes, and what replaces it."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.strings = blob[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(length, replacement) of the longest prefix of data[at:] in the map."""
        units = self.units
        if not units:
            return None
        node = _offset(units[0])
        best = None
        for i in range(at, len(data)):
            node ^= data[i]
            unit = units[node] if node < len(units) else 0
            if unit & 0x800000FF != data[i]:  # the label, and no leaf
                break
            node ^= _offset(unit)
            if unit >> 8 & 1:  # a key ends here: its value is the leaf's
                best = i + 1 - at, units[node] & 0x7FFFFFFF
        if best is None:
            return None
        start = best[1]
        return best[0], self.strings[start: self.strings.index(b"\0", start)]


def _offset(unit: int) -> int:
    return unit >> 10 << ((unit & 0x200) >> 6)


class Normaliser:
    """``run`` gives the normalised bytes and, for each of them and the end, the original byte where it comes from."""

    def __init__(self, spec: NormaliserSpec):
        self.spec = spec
        self.map = CharacterMap(spec.charsmap)
        self.mark = MARK.encode() if spec.escape_spaces else b" "

    def run(self, text: bytes) -> tuple[bytes, np.ndarray]:
        return self._by_map(text) if self.map.units or self.spec.remove_extra_spaces else self._as_is(text)

    def _as_is(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """Without a character map only the marks change: each space's mark comes from the space."""
        if not text:
            return b"", np.zeros(1, np.int64)
        out = (self.mark if self.spec.dummy_prefix else b"") + text.replace(b" ", self.mark)
        width = np.where(np.frombuffer(text, np.uint8) == 0x20, len(self.mark), 1)
        origin = np.repeat(np.arange(len(text)), width)
        prefix = np.zeros(len(out) - len(origin), np.int64)
        return out, np.concatenate([prefix, origin, [len(text)]])

    def _by_map(self, text: bytes) -> tuple[bytes, np.ndarray]:
        spec, out, origin = self.spec, bytearray(), []
        at = 0
        if spec.remove_extra_spaces:  # leading spaces go
            while at < len(text):
                size, new = self._next(text, at)
                if new != b" ":
                    break
                at += size
        if at == len(text):
            return b"", np.zeros(1, np.int64)
        if spec.dummy_prefix:
            out += self.mark
            origin += [at] * len(self.mark)
        spaced = spec.remove_extra_spaces
        while at < len(text):
            size, new = self._next(text, at)
            if spaced:
                new = new.lstrip(b" ")
            if new:
                marked = new.replace(b" ", self.mark)
                out += marked
                origin += [at] * len(marked)
                spaced = spec.remove_extra_spaces and new.endswith(b" ")
            at += size
        end = len(text)
        if spec.remove_extra_spaces:  # trailing spaces go, and the end is where they began
            while out.endswith(self.mark):
                end = origin[-len(self.mark)]
                del out[-len(self.mark):], origin[-len(self.mark):]
        return bytes(out), np.array([*origin, end], np.int64)

    def _next(self, text: bytes, at: int) -> tuple[int, bytes]:
        found = self.map.longest(text, at)
        if found:
            return found
        first = text[at]
        size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        return size, text[at: at + size]


class _Memory(dict):
    """Results of a function of one string. The latest ``CACHE`` are held, and those used again since the ones before."""

    def __init__(self, function: Callable[[str], bytes]):
        self.function = function
        self.before: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        value = self.before.get(key)
        if value is None:
            value = self.function(key)
        if len(key) <= LONG_WORD:
            self[key] = value
            if len(self) >= CACHE:
                self.before = dict(self)
                self.clear()
        return value


class Model:
    """A BPE model with byte pieces: ``encode`` and ``decode`` agree with the library's."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.types: list[int] = []
        self.scores: list[float] = []
        kind, fallback, suffix, denormalised, spec = 0, False, False, False, NormaliserSpec()
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.types.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
                kind, fallback, suffix = trainer.get(3, 1), bool(trainer.get(35, 0)), bool(trainer.get(24, 0))
            elif number == 3:
                spec = NormaliserSpec.parse(value)
            elif number == 5:
                denormalised = bool(NormaliserSpec.parse(value).charsmap)
        if (kind != BPE or not fallback or suffix or denormalised or {USER_DEFINED, UNUSED} & set(self.types)
                or not spec.escape_spaces):
            raise ValueError("only BPE models with byte pieces and marks before words, without user-defined or unused "
                             "pieces or a denormaliser, are read")
        self.spec, self.normaliser = spec, Normaliser(spec)
        merged = {p: i for i, (p, t) in enumerate(zip(self.pieces, self.types, strict=True)) if t == NORMAL}
        self.merged = merged
        # the order of merges: rank 0 has the highest score (equal scores, equal rank: then the left pair goes first)
        level = {s: r for r, s in enumerate(sorted({self.scores[i] for i in merged.values()}, reverse=True))}
        self.rank = {p: level[self.scores[i]] for p, i in merged.items()}
        self.byte_id = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(self.pieces, self.types, strict=True)) if t == BYTE}
        inner = {c for p in merged if len(p) > 1 for c in p}
        if any(c == MARK and p[i - 1] != MARK for p in merged for i, c in enumerate(p) if i):
            apart = ".+"
        elif "\n" in inner:
            apart = f"{MARK}+[^{MARK}]*|[^{MARK}]+"
        else:  # a line feed merges with nothing
            apart = f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n"
        self.words = re.compile(apart, re.DOTALL)
        self.simple = apart.endswith("\n") and spec.dummy_prefix and not spec.charsmap and not spec.remove_extra_spaces
        self.symbols = _Memory(self._symbol)
        self.known = {spaced: _Memory(partial(self._learn, spaced=spaced)) for spaced in (False, True)}
        # decoding
        self.out = [b"" if t in (CONTROL, BYTE) else b" \xe2\x81\x87 " if t == UNKNOWN else p.replace(MARK, " ").encode()
                    for p, t in zip(self.pieces, self.types, strict=True)]
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.controls = frozenset(i for i, t in enumerate(self.types) if t == CONTROL)
        self.plain = [bytes([self.byte_of[i]]) if i in self.byte_of else o for i, o in enumerate(self.out)]

    # ------------------------------------------------------------------------------------------------ encoding
    def _merge(self, word: str) -> list[str]:
        """The word's symbols after all merges."""
        rank = self.rank.get
        symbols = list(word)
        if len(symbols) > 48:
            return self._merge_long(symbols)
        pairs = [rank(a + b, NEVER) for a, b in pairwise(symbols)]
        while pairs and (best := min(pairs)) < NEVER:
            i = pairs.index(best)  # the left pair first
            symbols[i: i + 2] = [new := symbols[i] + symbols[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank(symbols[i - 1] + new, NEVER)
            if i < len(pairs):
                pairs[i] = rank(new + symbols[i + 1], NEVER)
        return symbols

    def _merge_long(self, symbols: list[str | None]) -> list[str]:
        """The same with a heap: candidates whose symbols have changed since are passed over."""
        rank = self.rank.get
        before, after = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
        heap = [(r, i, i + 1, len(a) + len(b)) for i, (a, b) in enumerate(pairwise(symbols))
                if (r := rank(a + b)) is not None]
        heapq.heapify(heap)

        def push(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (r := rank(symbols[i] + symbols[j])) is not None:
                heapq.heappush(heap, (r, i, j, len(symbols[i]) + len(symbols[j])))

        while heap:
            _, i, j, size = heapq.heappop(heap)
            if symbols[i] is None or symbols[j] is None or after[i] != j or len(symbols[i]) + len(symbols[j]) != size:
                continue
            symbols[i] += symbols[j]
            symbols[j] = None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            push(before[i], i)
            push(i, after[i])
        return [s for s in symbols if s is not None]

    def _symbol(self, s: str) -> bytes:
        """A symbol's ids, each followed by its piece's width (two unsigned 32-bit numbers a piece). Of the byte pieces of a
        character the last has its width and the others none."""
        found, data = self.merged.get(s), s.encode("utf-8", "surrogatepass")
        if found is not None:
            return struct.pack("<II", found, len(data))
        return b"".join(struct.pack("<II", self.byte_id[b], 0) for b in data)[:-4] + struct.pack("<I", len(data))

    def _learn(self, word: str, spaced: bool) -> bytes:
        """Ids and widths of a word's pieces. If ``spaced``, a mark is as wide as a space."""
        symbols = self._merge(word)
        raw = b"".join(map(self.symbols.__getitem__, symbols))
        if spaced and word[:1] == MARK:
            found, width = struct.unpack_from("<II", raw)
            raw = struct.pack("<II", found, width - len(MARK.encode()) + 1) + raw[8:]
        return raw

    def _of_words(self, words: list[str], spaced: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words and the widths of their pieces, in the original if ``spaced``, else in normalised bytes."""
        raw = b"".join(map(self.known[spaced].__getitem__, words))
        both = np.frombuffer(raw, "<u4").astype(np.int32).reshape(-1, 2)
        return both[:, 0], both[:, 1]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the start and end of each piece in the text's UTF-8 bytes."""
        if self.simple and text and text[0] != " " and not any(x in text for x in ("  ", MARK, "\0")):
            # without a character map and with single spaces, a word's pieces have the same widths wherever it stands
            words = ("\0" + MARK + text.replace(" ", "\0" + MARK).replace("\n", "\0\n\0")).split("\0")
            ids, widths = self._of_words(words, True)
            widths[0] -= 1  # the mark before the text comes from nothing
            ends = np.cumsum(widths, dtype=np.int32)
            return ids, ends - widths, ends
        data, origin = self.normaliser.run(text.encode("utf-8", "surrogatepass"))
        ids, widths = self._of_words(self.words.findall(data.decode("utf-8", "surrogatepass")), False)
        ends = np.cumsum(widths)
        return ids, origin[ends - widths].astype(np.int32), origin[ends].astype(np.int32)

    # ------------------------------------------------------------------------------------------------ decoding
    def decode(self, ids: list[int]) -> bytes:
        """The text of the ids, in UTF-8."""
        head, at = b"", 0
        if self.spec.dummy_prefix or self.spec.remove_extra_spaces:
            while at < len(ids):
                kind = self.types[ids[at]]
                if kind == NORMAL and self.pieces[ids[at]].startswith(MARK):
                    head = self.out[ids[at]][1:]
                    if head or not self.spec.remove_extra_spaces:
                        at += 1
                        break
                elif kind != CONTROL:
                    break
                at += 1
        rest = ids[at:]
        joined = b"".join(map(self.plain.__getitem__, rest))
        try:
            joined.decode()  # byte pieces that make up characters, as an encoder's do
        except UnicodeDecodeError:
            return head + self._decode_runs(rest)
        return head + (joined if self.controls.isdisjoint(rest) else self._decode_runs(rest))

    def _decode_runs(self, ids: list[int]) -> bytes:
        """Runs of byte pieces on their own: each byte that starts no character becomes U+FFFD."""
        parts, run = [], bytearray()
        for i in [*ids, None]:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                parts.append(_readable(bytes(run)))
                run.clear()
            if i is not None:
                parts.append(self.out[i])
        return b"".join(parts)


def _readable(data: bytes) -> bytes:
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at: at + size].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append(REPLACEMENT)
            size = 1
        at += size
    return "".join(out).encode()


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in parts whose texts or lists are of bounded size, but for single rows that are larger."""
    values = batch.column(column)
    size = values.value_lengths() if pa.types.is_list(values.type) else pc.binary_length(values)
    total = np.cumsum(size.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        stop = int(np.searchsorted(total, (total[at - 1] if at else 0) + SLICE, "right"))
        yield batch.slice(at, max(stop, at + 1) - at)
        at = max(stop, at + 1)


_MODELS: dict[str, Model] = {}


def model(path: str) -> Model:
    """The model of a file, read once in every worker."""
    if path not in _MODELS:
        with open(path, "rb") as f:
            _MODELS[path] = Model(f.read())
    return _MODELS[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded_col: str | None = None) -> DataFrame:
    """Rows (doc_id, ids array<int>, starts array<int>, ends array<int>): pieces with their spans in the text's bytes.

    ``path`` names the model file on every machine; ``decoded_col`` adds the text decoded from the ids, by the same tasks.
    """
    names = ["doc_id", "ids", "starts", "ends"] + [decoded_col] * (decoded_col is not None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in batches:
            for part in _slices(b, "text"):
                found = [m.encode(t) for t in part.column("text").to_pylist()]
                offsets = pa.array(np.cumsum([0, *(len(f[0]) for f in found)]).astype(np.int32))
                columns = [part.column("doc_id")]
                columns += [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x))) for x in zip(*found, strict=True)]
                if decoded_col is not None:
                    columns.append(pa.array([m.decode(f[0].tolist()) for f in found], pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    decoded = f", `{decoded_col}` string" if decoded_col is not None else ""
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, starts array<int>, ends array<int>{decoded}")


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids in ``text_col``; null ids have null text, ids outside the model raise an error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in batches:
            for part in _slices(b, ids_col):
                lists = part.column(ids_col)
                ids, offsets = lists.flatten().to_pylist(), np.cumsum([0, *lists.value_lengths().fill_null(0).to_pylist()])
                texts = [m.decode(ids[i:j]) if known else None
                         for i, j, known in zip(offsets[:-1], offsets[1:], lists.is_valid().to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary()).cast(pa.string())],
                                                 [*part.schema.names, text_col])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{schema}, `{text_col}` string")
