"""SentencePiece encoding and decoding by streaming Viterbi.

Merge vocabularies (BPE) give every prefix of a text exactly one encoding, and a sequence of pieces
is an encoding if each neighbouring pair is one. So the lattice has one surviving path per
position: the last piece there is the one that fits the last piece before it. Paths reach back at
most the longest piece's length; once the paths of all positions that can still be extended share
a boundary, the ids before it are final and leave the window.
"""

from __future__ import annotations

import math
import re
import sys
from array import array
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"
# Entries of a memory before it becomes the older one, which is looked up but not added to; longer
# stretches are not remembered.
HELD, LONGEST_HELD = 400_000, 40

START = -1  # stands before the first piece
LITTLE = sys.byteorder == "little" and array("i").itemsize == 4

_MODELS: dict[str, "PieceModel"] = {}


class PieceModel:
    """Pieces, scores and ids of a merge vocabulary of the sentencepiece library."""

    def __init__(self, path: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = library.get_piece_size()
        self.text = [library.id_to_piece(i) for i in range(n)]
        plain = [
            i
            for i in range(n)
            if not (library.is_byte(i) or library.is_unknown(i) or library.is_control(i) or library.is_unused(i))
        ]
        self.ids = {self.text[i]: i for i in plain}
        self.score = {self.text[i]: library.get_score(i) for i in plain}
        self.byte_ids = {int(self.text[i][3:-1], 16): i for i in range(n) if library.is_byte(i)}
        self.bytes = {i: bytes([b]) for b, i in self.byte_ids.items()}
        self.control = {i for i in range(n) if library.is_control(i)}
        self.unknown = library.unk_id()
        self.longest = max(map(len, self.ids))
        longer = [p for p in self.ids if len(p) > 1]
        # If spaces stand only at the start of pieces, and line ends in none, no piece crosses them.
        self.cuts = all(SPACE not in p.lstrip(SPACE) and "\n" not in p for p in longer)
        self.stretches = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+").findall
        # No merge joins two characters that are neighbours in no piece.
        self.inside = {p[i : i + 2] for p in longer for i in range(len(p) - 1)}
        # Pieces go by number: their id, or for characters outside the vocabulary their code above all ids.
        self.beyond = n
        self.sizes = [len(t) for t in self.text]
        self.ending = ahocorasick.Automaton()  # at each place the pieces that end there, the longest first
        for piece, i in self.ids.items():
            self.ending.add_word(piece, (i, len(piece)))
        self.ending.make_automaton()
        self.fits: dict[int, bool] = {}
        self.older_fits: dict[int, bool] = {}
        self.packed: dict[str, bytes] = {}
        self.older_packed: dict[str, bytes] = {}
        self.made: dict[str, tuple[str, str] | None] = {p: ("", "") for p in self.ids if len(p) == 1}
        # What an id adds to a text by itself; None where it depends on its neighbours.
        self.shown: list[str | None] = [p.replace(SPACE, " ") for p in self.text]
        for i in {*self.bytes, *self.control, self.unknown}:
            ascii_byte = i in self.bytes and self.bytes[i] < b"\x80"
            self.shown[i] = self.bytes[i].decode() if ascii_byte else None

    def merged(self, text: str, halves: bool = False) -> list[str]:
        """The encoding by its definition: merge the best-scored pair, the leftmost first.

        ``halves`` asks for the two parts that the last merge of a single piece joins.
        """
        parts, score = list(text), self.score
        while len(parts) > 1:
            best = max(
                ((score[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in score),
                default=None,
            )
            if best is None:
                break
            i = -best[1]
            if halves and len(parts) == 2:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def halves(self, piece: str) -> tuple[str, str] | None:
        """The parts of a piece's last merge; None if merging never makes the piece."""
        if piece not in self.made:
            single = self.merged(piece) == [piece]
            self.made[piece] = tuple(self.merged(piece, halves=True)) if single else None
        return self.made[piece]

    def pair_fits(self, before: str, piece: str) -> bool:
        """Whether the two pieces are the encoding of their text ("" stands for the start)."""
        return self.numbers_fit(self.number(before) if before else START, self.number(piece))

    def numbers_fit(self, before: int, piece: int) -> bool:
        pair = before << 32 | piece
        known = self.fits.get(pair)
        if known is None:
            known = self.older_fits.get(pair)
            if known is None:
                known = self._fits("" if before == START else self.piece(before), self.piece(piece))
            if len(self.fits) > HELD:
                self.older_fits, self.fits = self.fits, {}
            self.fits[pair] = known
        return known

    def number(self, piece: str) -> int:
        known = self.ids.get(piece)
        return self.beyond + ord(piece) if known is None else known

    def piece(self, number: int) -> str:
        return self.text[number] if number < self.beyond else chr(number - self.beyond)

    def _fits(self, left: str, right: str) -> bool:
        """Undo the merges of both pieces, the latest first, and look for one across the border
        that would have come before the undone one (or at the same score, further left)."""
        if SPACE * 2 in left + right:  # runs of spaces share one score: go by the definition
            return self.merged(left + right) == ([left, right] if left else [right])
        if len(right) > 1 and self.halves(right) is None:
            return False
        if not left:
            return True
        score, floor = self.score, -float("inf")
        while True:
            across = score.get(left + right)
            if across is not None and across > floor:
                return False
            made_left = score[left] if len(left) > 1 else None
            made_right = score[right] if len(right) > 1 else None
            if made_left is None and made_right is None:
                return True
            if made_right is None or made_left is not None and made_left < made_right:
                floor, left = made_left, self.halves(left)[1]
            else:
                floor, right = math.nextafter(made_right, -math.inf), self.halves(right)[0]

    def piece_ids(self, piece: str) -> list[int]:
        """The id of a piece; a character outside the vocabulary falls back to its bytes."""
        if piece in self.ids:
            return [self.ids[piece]]
        if not self.byte_ids:
            return [self.unknown]
        return [self.byte_ids[b] for b in piece.encode()]

    def encode(self, text: str) -> bytes:
        """The ids of a text, packed as little-endian 32-bit integers."""
        if not text:
            return b""
        text = SPACE + text.replace(" ", SPACE)
        if not self.cuts:
            return self._stretch(text)
        held = self.packed
        parts = self.stretches(text)
        out = [held.get(p) for p in parts]
        if None in out:
            out = [self._part(p) if packed is None else packed for p, packed in zip(parts, out, strict=True)]
            if len(held) > HELD:
                self.older_packed, self.packed = held, {}
        return b"".join(out)

    def _part(self, part: str) -> bytes:
        packed = self.packed.get(part)
        if packed is not None:
            return packed
        packed = self.older_packed.get(part)
        if packed is None:
            inside = self.inside
            cuts = [i for i, (a, b) in enumerate(zip(part, part[1:]), 1) if a + b not in inside]
            if cuts:
                packed = b"".join([self._part(part[a:b]) for a, b in zip([0, *cuts], [*cuts, len(part)], strict=True)])
            else:
                packed = self._stretch(part)
        if len(part) <= LONGEST_HELD:
            self.packed[part] = packed
        return packed

    def _stretch(self, text: str) -> bytes:
        stream = PieceStream(self)
        numbers = stream.push(text) + stream.rest()
        if max(numbers) >= self.beyond:
            numbers = [i for n in numbers for i in ([n] if n < self.beyond else self.piece_ids(self.piece(n)))]
        return array("i", numbers).tobytes() if LITTLE else np.asarray(numbers, dtype="<i4").tobytes()

    def decode(self, ids: Iterable[int]) -> str:
        """The text of a sequence of ids, without the space that encoding puts in front."""
        shown = [self.shown[i] for i in ids]
        if None in shown:
            shown = self._by_neighbours(ids)
        text = "".join(shown)
        return text[1:] if text.startswith(" ") else text

    def _by_neighbours(self, ids: Iterable[int]) -> list[str]:
        out, raw = [], bytearray()
        for i in ids:
            if i in self.bytes:
                raw += self.bytes[i]
                continue
            if raw:
                out.append(raw.decode(errors="replace"))
                raw = bytearray()
            if i == self.unknown:
                out.append(" ⁇ ")
            elif i not in self.control:
                out.append(self.shown[i])
        if raw:
            out.append(raw.decode(errors="replace"))
        return out


class PieceStream:
    """Encodes a text that arrives in parts; ``feed`` and ``finish`` return the final pieces.

    The window holds the text since the last common boundary. Positions are counted from there;
    ``last[i]`` is the number of the last piece of the one path that reaches position i.
    """

    def __init__(self, model: PieceModel):
        self.model = model
        self.window = ""
        self.last: list[int] = [START]  # at the window's start: the piece before it

    def feed(self, text: str) -> list[str]:
        return [self.model.piece(n) for n in self.push(text)]

    def finish(self) -> list[str]:
        """The pieces that are left; the stream is empty afterwards."""
        return [self.model.piece(n) for n in self.rest()]

    def push(self, text: str) -> list[int]:
        step, out = 8 * self.model.longest, []
        if len(text) <= step:
            self._advance(text)
            return self._commit() if len(self.window) > step else out
        for at in range(0, len(text), step):
            self._advance(text[at : at + step])
            if len(self.window) > step:
                out += self._commit()
        return out

    def rest(self) -> list[int]:
        numbers = self._path(len(self.window))
        self.window, self.last = "", [START]
        return numbers

    def _advance(self, text: str) -> None:
        model, last = self.model, self.last
        fits, settled = model.fits.get, len(last)
        start = max(0, settled - model.longest)  # no piece that ends at an open position begins earlier
        self.window += text
        for at, (piece, size) in model.ending.iter(self.window, start):
            if at + 1 < settled:
                continue
            while settled <= at:
                self._alone(settled)
                settled += 1
            before = last[settled - size]
            fit = fits(before << 32 | piece)
            if fit or fit is None and model.numbers_fit(before, piece):
                last.append(piece)
                settled += 1
        for i in range(settled, len(self.window) + 1):
            self._alone(i)

    def _alone(self, end: int) -> None:
        """The last piece of a path to where no piece of the vocabulary fits: a character outside it."""
        number = self.model.number(self.window[end - 1])
        if number < self.model.beyond or not self.model.numbers_fit(self.last[end - 1], number):
            raise ValueError("the vocabulary's merges give a prefix no encoding")
        self.last.append(number)

    def _path(self, end: int) -> list[int]:
        numbers, last, sizes, beyond = [], self.last, self.model.sizes, self.model.beyond
        while end:
            number = last[end]
            numbers.append(number)
            end -= sizes[number] if number < beyond else 1
        return numbers[::-1]

    def _commit(self) -> list[int]:
        """Hand over the pieces before the last boundary that all surviving paths share."""
        end, sizes, beyond = len(self.window), self.model.sizes, self.model.beyond
        shared: set[int] | None = None
        for i in range(max(1, end - self.model.longest + 1), end + 1):
            bounds, at = set(), i
            while at:
                bounds.add(at)
                at -= sizes[self.last[at]] if self.last[at] < beyond else 1
            shared = bounds if shared is None else shared & bounds
            if not shared:
                return []
        cut = max(shared)
        numbers = self._path(cut)
        self.window, self.last = self.window[cut:], self.last[cut:]
        return numbers


def _model(path: str) -> PieceModel:
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encode_pieces(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Piece ids of every whole text: ``doc_id, ids`` (array of int).

    The ids are those of the vocabulary's own library. ``model`` is the path of the vocabulary
    file on every machine. One row per input row, repeated rows and null ids included; null texts
    count as empty and have no ids. Other columns are ignored.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _model(model)
        for batch in batches:
            packed = [pieces.encode(t.as_py() or "") for t in batch.column(1)]
            ends = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
            ids = np.frombuffer(b"".join(packed), dtype="<i4")
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids, type=pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "ids"])

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"doc_id {kind}, ids array<int>")


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """Texts of ``doc_id, ids``: ``doc_id, ids, text``. Null ids arrays give empty texts.

    Decoding undoes encoding, but for the character that stands for a space in pieces: it comes
    back as a space.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _model(model)
        for batch in batches:
            lists = batch.column(1)
            values = lists.values.to_numpy(zero_copy_only=False)
            ends = lists.offsets.to_numpy()
            texts = [pieces.decode(values[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            columns = [batch.column(0), lists, pa.array(texts, type=pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(decode, f"doc_id {kind}, ids array<int>, text string")
