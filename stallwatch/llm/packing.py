"""Sum-of-squares packing of tokenised documents into windows of fixed width.

Each task packs the documents it reads, in their order. A document's full windows stand alone; its rest
goes into the open window whose fill level makes the sum of squared counts of open windows per level
smallest, or into a new one. The counts are one array with an entry per level. When a task's documents
are through, its open windows are merged by cutting the emptiest into the gaps of the fullest, so at most
one window of a task stays short. No shuffle is needed, and a repeated task gives the same windows.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallwatch.llm.words import chunks

#: Entries of a task's memory of words and their ids, and the longest word in it; it only saves time.
REMEMBERED, REMEMBERED_CHARS = 300_000, 48
#: Words whose ids do not need the tokenizer's normaliser: printable ASCII and Latin-1 letters.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
#: The tokenizer's own pattern, for such words in lower case.
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def _byte_letters() -> dict[int, str]:
    """Latin-1 code point of each byte -> the letter that byte-level tokenizers write for it."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordTokenizer:
    """ids of whole texts as little-endian 32-bit bytes, by words.

    White space separates words in this tokenizer whatever stands around it, so texts are cut at spaces and
    newlines and the ids of words met lately are remembered. Plain words go straight to the BPE model, in the
    pieces of the tokenizer's own pattern; all others through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.letters = _byte_letters()
        self.known: dict[str, bytes] = {"": b""}
        self.before: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def ids(self, word: str) -> bytes:
        plain = word.isprintable() if word.isascii() else _PLAIN.fullmatch(word)
        if not plain or "<|" in word:
            return array("I", self.whole.encode(word, add_special_tokens=False).ids).tobytes()
        lower = word.lower()
        found = [lower] if lower.isascii() and lower.isalpha() else _PIECES.findall(lower)
        out = b""
        for piece in found:
            ids = self.pieces.get(piece)
            if ids is None:
                letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
                ids = array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
                if len(self.pieces) >= REMEMBERED:
                    self.pieces.clear()
                if len(piece) <= REMEMBERED_CHARS:
                    self.pieces[piece] = ids
            out += ids
        return out

    def encode(self, text: str) -> bytes:
        if len(self.known) >= REMEMBERED:
            self.before, self.known = self.known, {"": b""}
        words = text.replace("\n", " ").split(" ")
        parts = list(map(self.known.get, words))
        at = -1
        for _ in range(parts.count(None)):
            at = parts.index(None, at + 1)
            word = words[at]
            part = self.known.get(word)
            if part is None:
                part = self.before.get(word)
                part = self.ids(word) if part is None else part
                if len(word) <= REMEMBERED_CHARS:
                    self.known[word] = part
            parts[at] = part
        return b"".join(parts)


class LevelArray:
    """Open windows by fill level, and the number of them at each level."""

    def __init__(self, width: int):
        self.width = width
        self.counts = np.zeros(width + 1, dtype=np.int64)
        self.open: dict[int, list[list]] = {}

    def place(self, piece: tuple, size: int) -> list | None:
        """Puts a piece of 0 < size < width; returns the window if that fills it."""
        top = self.width - size
        after = self.counts[size : self.width + 1]  # of levels 0..top once the piece is in; level width counts nothing
        cost = 2 * after[: top + 1] - 2 * self.counts[: top + 1] + 2
        cost[top] -= 1 + 2 * after[top]
        cost[0] += 2 * self.counts[0] - 1
        cost[1:][self.counts[1 : top + 1] == 0] = np.iinfo(np.int64).max
        level = top - int(np.argmin(cost[::-1]))
        if level:
            self.counts[level] -= 1
            window = self.open[level].pop()
        else:
            window = []
        window.append((*piece, level))
        level += size
        if level == self.width:
            return window
        self.counts[level] += 1
        self.open.setdefault(level, []).append(window)
        return None

    def merge_rest(self) -> Iterator[list]:
        """All windows still open, merged."""
        rest = [(level, w) for level in sorted(self.open, reverse=True) for w in self.open[level]]
        i, j = 0, len(rest) - 1
        while i <= j:
            level, window = rest[i]
            while level < self.width and j > i:
                have, last = rest[j]
                doc, start, ids, total, offset = last.pop()
                take = min(self.width - level, len(ids) // 4)
                window.append((doc, start, ids[: 4 * take], total, level))
                level += take
                if 4 * take < len(ids):
                    last.append((doc, start + take, ids[4 * take :], total, offset))
                if last:
                    # what is left must start at 0 without gaps again
                    at, again = 0, []
                    for doc, start, ids, total, _ in last:
                        again.append((doc, start, ids, total, at))
                        at += len(ids) // 4
                    rest[j] = (at, again)
                else:
                    j -= 1
            yield window
            i += 1


def pack(docs: DataFrame, tokenizer_path: str, width: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of documents in windows: id_col, start, length, ids (binary, little-endian 32-bit), doc_tokens,
    sequence_id, offset.

    A document's tokens are its ids and ``end_id``; a null or empty text has end_id alone. Every token is in
    exactly one piece. Pieces of a window have offsets from 0 without gaps; windows are padded to ``width`` at
    the end. Repeated documents are packed each on their own. Extra columns are ignored; an empty table gives
    no rows.
    """
    names = [id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    kinds = [docs.schema[id_col].dataType, T.LongType(), T.LongType(), T.BinaryType(), T.LongType(), T.LongType(), T.LongType()]
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(tokenizer_path)
        levels, first, done = LevelArray(width), TaskContext.get().partitionId() << 33, 0
        rows: list[tuple] = []
        id_type = None

        def close(window: list) -> None:
            nonlocal done
            rows.extend((doc, start, len(ids) // 4, ids, total, first + done, offset) for doc, start, ids, total, offset in window)
            done += 1

        def written() -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[]] * 7
            types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for batch in chunks(batches, "text"):
            id_type = batch.schema.field(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = tokenizer.encode(text or "") + end
                total = len(ids) // 4
                whole = total // width * width
                for start in range(0, whole, width):
                    close([(doc, start, ids[4 * start : 4 * (start + width)], total, 0)])
                if whole < total and (window := levels.place((doc, whole, ids[4 * whole :], total), total - whole)):
                    close(window)
            if len(rows) > 2000:
                yield written()
                rows.clear()
        for window in levels.merge_rest():
            close(window)
            if len(rows) > 2000:
                yield written()
                rows.clear()
        if rows:
            yield written()

    return docs.select(id_col, F.col(text_col).alias("text")).mapInArrow(run, T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)]))
