"""Sum-of-squares online packing of documents into fixed training windows.

Each task packs the documents of its own input split, in order, as they
arrive; nothing is shuffled. The state of a task is a *level array*: for each
fill level the open windows of that level. A document goes where the sum of
the squared counts of partially filled windows ends up smallest, either into
an open window or into a new one, so that no fill level piles up.

* A document of ``length`` tokens or more first gives whole windows of its
  own; what is left is placed like any other document.
* A window with less than one level of room left is topped up from a
  *filler* document, which is cut as needed, and closed full. Only filler
  and over-long documents are cut on this path.
* At ``max_open`` windows, and at the end of the split, open windows are
  closed: the emptiest give their pieces to the fullest. The one window that
  is left over at the end is cut into sequences of power-of-two length,
  which take no padding.

Memory of a task: at most ``max_open`` windows of ``length`` ids, one filler
document, one Arrow batch, and the bounded word cache. A lost task is run
again on the same split and gives the same rows.

Defined cases: a null or empty text is a document of the end id alone; rows
that repeat are packed each on its own; null ids are kept; an empty table
gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.llm.common import worker_cache
from tickwise.llm.textbytes import LOWER, hash_runs, pieces_of

LENGTH = 4096
LEVELS = 64
MAX_OPEN = 1024
END_ID = 2

# Words whose ids a Python worker remembers; a full memory starts anew.
MAX_WORDS = 1 << 21

# The splitting pattern of the word-end vocabulary file is a fixed value:
#   's|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+
# Below it is stated on bytes, for texts of ASCII and Latin-1 letters.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
SPACE, LETTER, DIGIT, SYMBOL = 0, 1, 2, 3
KIND = np.full(256, SYMBOL, dtype=np.uint8)
KIND[[9, 10, 11, 12, 13, 32]] = SPACE
KIND[97:123] = KIND[128:192] = KIND[195] = LETTER
KIND[48:58] = DIGIT


class BatchEncoder:
    """Ids of many texts at once, equal to ``tokenizer.encode(text)``.

    White space and changes of character kind end a word in this vocabulary,
    and each word has ids of its own. Words are found and hashed (64 bits) on
    the bytes of the whole batch and looked up in a memory of the worker; new
    words go to the vocabulary's own model. Texts with other characters than
    ASCII and Latin-1 letters, or with a special token's string, go to the
    tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # the byte alphabet of the vocabulary: printable bytes stand for
        # themselves, the others follow from 256 on in their order
        itself = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = (b for b in range(256) if b not in itself)
        self.alphabet = {b: chr(256 + i) for i, b in enumerate(others)}
        self._forget()
        probe = "It's 2 O'Clock -- d\u00e9j\u00e0 vu!? we'll see"
        raw = np.frombuffer(probe.encode(), dtype=np.uint8)
        if self.encode(raw, np.array([0, len(raw)]))[0].tolist() != self._whole(probe).tolist():
            raise ValueError(f"{path} does not split words as this encoder does")

    def _forget(self, words: int = 0) -> None:
        slots = max(2 * MAX_WORDS, 1 << (2 * words).bit_length())
        self.keys = np.zeros(slots, dtype=np.uint64)  # open addressing; 0 is free
        self.first = np.zeros(slots, dtype=np.int32)
        self.count = np.zeros(slots, dtype=np.int32)
        self.n_known = 0
        self.store = np.zeros(1 << 16, dtype="<u4")
        self.stored = 0

    def _whole(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        """``hashes`` are distinct and unknown."""
        tokenize, alphabet = self.model.tokenize, self.alphabet
        texts = [w.decode() if w.isascii() else w.decode("latin-1").translate(alphabet) for w in words]
        each = [[t.id for t in tokenize(w)] for w in texts]
        counts = np.fromiter((len(x) for x in each), dtype=np.int32, count=len(each))
        total = int(counts.sum())
        if self.stored + total > len(self.store):
            grown = np.zeros(2 * (self.stored + total), dtype="<u4")
            grown[: self.stored] = self.store[: self.stored]
            self.store = grown
        self.store[self.stored : self.stored + total] = np.fromiter((i for x in each for i in x), dtype="<u4", count=total)
        first = (self.stored + np.cumsum(counts) - counts).astype(np.int32)
        self.stored += total
        self.n_known += len(hashes)
        mask = np.uint64(len(self.keys) - 1)
        left, step = np.arange(len(hashes)), np.uint64(0)
        while len(left):
            slot = (hashes[left] + step) & mask
            free = self.keys[slot] == 0
            _, take = np.unique(slot[free], return_index=True)
            take = np.flatnonzero(free)[take]
            at = slot[take]
            self.keys[at] = hashes[left[take]]
            self.first[at] = first[left[take]]
            self.count[at] = counts[left[take]]
            left = np.delete(left, take)
            step += np.uint64(1)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each hash, -1 if unknown."""
        mask = np.uint64(len(self.keys) - 1)
        out = np.full(len(hashes), -1, dtype=np.int64)
        left, step = np.arange(len(hashes)), np.uint64(0)
        while len(left):
            slot = (hashes[left] + step) & mask
            key = self.keys[slot]
            hit = key == hashes[left]
            out[left[hit]] = slot[hit]
            left = left[~hit & (key != 0)]
            step += np.uint64(1)
        return out

    def _split(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the words of lower-cased bytes."""
        kind = KIND[data]
        n = len(data)
        start = np.empty(n, dtype=bool)
        start[0] = True
        start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        start[bounds[bounds < n]] = True
        marks = np.flatnonzero((data == 39) & start)
        if len(marks):
            to = bounds[np.searchsorted(bounds, marks, side="right")]
            open_ = np.ones(len(marks), dtype=bool)
            padded = np.concatenate([data, np.zeros(2, dtype=np.uint8)])
            for tail in CONTRACTIONS:
                m = marks[open_]
                hit = m + len(tail) < to[open_]
                for j, ch in enumerate(tail):
                    hit &= padded[m + 1 + j] == ord(ch)
                found = m[hit]
                start[found + 1] = False
                after = found + 1 + len(tail)
                start[after[after < n]] = True
                open_[np.flatnonzero(open_)[hit]] = False
        starts = np.flatnonzero(start)
        ends = np.append(starts[1:], n)
        keep = kind[starts] != SPACE
        return starts[keep], ends[keep]

    def encode(self, raw: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
        """Ids (unsigned 32-bit) of each text of the batch."""
        n_texts = len(bounds) - 1
        # a letter of Latin-1 is C3 and one byte; its capitals differ by one bit
        data = LOWER[raw]
        lead = np.flatnonzero(raw == 0xC3) + 1
        second = data[lead]
        data[lead[(second < 0x9F) & (second != 0x97)]] |= 0x20
        odd = (raw == 0xC2) | (raw > 0xC3) | ((raw < 32) & (KIND[raw] != SPACE)) | (raw == 127)
        odd[lead[(second == 0x97) | (second == 0xB7)]] = True
        angle = np.flatnonzero(raw[:-1] == 60)
        odd[angle[raw[angle + 1] == 124]] = True  # "<|" may open a special token
        texts_odd = np.zeros(n_texts, dtype=bool)
        texts_odd[np.searchsorted(bounds, np.flatnonzero(odd), side="right") - 1] = True
        starts, ends = self._split(data, bounds) if len(data) else (np.zeros(0, np.int64),) * 2
        of = np.searchsorted(bounds, starts, side="right") - 1
        if texts_odd.any():
            plain = ~texts_odd[of]
            starts, ends, of = starts[plain], ends[plain], of[plain]
        hashes = hash_runs(data, starts, ends)
        row = self._rows(hashes, data, starts, ends)
        counts = self.count[row]
        total = int(counts.sum())
        before = np.cumsum(counts) - counts
        ids = self.store[np.arange(total) + np.repeat(self.first[row] - before, counts)]
        per_text = np.bincount(of, weights=counts, minlength=n_texts).astype(np.int64) if len(of) else np.zeros(n_texts, np.int64)
        out = np.split(ids, np.cumsum(per_text)[:-1]) if n_texts else []
        for i in np.flatnonzero(texts_odd).tolist():
            out[i] = self._whole(raw[bounds[i] : bounds[i + 1]].tobytes().decode())
        return out

    def _rows(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Slot of each word in the memory, learning the new ones."""
        row = self._find(hashes)
        missing = np.flatnonzero(row < 0)
        if len(missing) == 0:
            return row
        new, at = np.unique(hashes[missing], return_index=True)
        if self.n_known + len(new) > MAX_WORDS:  # start anew with the words of this batch
            new, at = np.unique(hashes, return_index=True)
            self._forget(len(new))
            missing = np.arange(len(hashes))
        at = missing[at]
        whole = data.tobytes()
        self._learn(new, [whole[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
        row[missing] = self._find(hashes[missing])
        return row


class SquaresPacker:
    """The level array of one task. ``add`` and ``finish`` return closed
    windows, each a list of ``(document, start, ids)``."""

    def __init__(self, length: int, levels: int, max_open: int):
        self.length, self.step, self.max_open = length, max(1, length // levels), max_open
        n = length // self.step + 1
        self.counts = [0] * n
        self.open: list[list[list]] = [[] for _ in range(n)]  # [fill, pieces]
        self.n_open = 0
        self.filler: tuple | None = None
        self.closed: list[list[tuple]] = []

    def add(self, document, ids: bytes) -> None:
        at, n = 0, len(ids) // 4
        while n - at >= self.length:
            self.closed.append([(document, at, ids[4 * at : 4 * (at + self.length)])])
            at += self.length
        if at < n:
            piece = (document, at, ids[4 * at :])
            if self.filler is None:
                self.filler = piece
            else:
                self._place(piece, n - at)

    def _place(self, piece: tuple, size: int) -> None:
        step, counts, length = self.step, self.counts, self.length
        best_level, best = 0, 0 if length - size < step else 2 * counts[size // step] + 1
        for h, stack in enumerate(self.open):
            if not stack:
                continue
            fill = stack[-1][0] + size
            if fill > length:
                break
            # change of the sum of squares if the top window of level h grows
            j = fill // step
            if length - fill < step:
                change = 1 - 2 * counts[h]
            else:
                change = 2 * (counts[j] - counts[h]) + 2 if j != h else 0
            if change <= best:
                best_level, best = h + 1, change
        if best_level:
            fill, pieces = self._take(best_level - 1)
        else:
            fill, pieces = 0, []
        pieces.append(piece)
        self._put(fill + size, pieces)

    def _take(self, level: int) -> tuple[int, list]:
        self.counts[level] -= 1
        self.n_open -= 1
        return self.open[level].pop()

    def _put(self, fill: int, pieces: list) -> None:
        while fill < self.length and self.length - fill < self.step and self.filler is not None:
            document, start, ids = self.filler
            n = min(self.length - fill, len(ids) // 4)
            pieces.append((document, start, ids[: 4 * n]))
            fill += n
            self.filler = (document, start + n, ids[4 * n :]) if 4 * n < len(ids) else None
        if fill == self.length:
            self.closed.append(pieces)
            return
        level = fill // self.step
        self.open[level].append((fill, pieces))
        self.counts[level] += 1
        self.n_open += 1
        if self.n_open > self.max_open:
            self._merge()

    def _merge(self) -> None:
        """Close windows: the emptiest are taken apart to fill the fullest."""
        windows = [w for stack in self.open for w in stack]
        windows.sort(key=lambda w: w[0])
        self.open = [[] for _ in self.open]
        self.counts = [0] * len(self.counts)
        self.n_open = 0
        low, high = 0, len(windows) - 1
        loose: list[tuple] = []  # pieces of the window that is taken apart
        while low <= high:
            fill, pieces = windows[high]
            high -= 1
            while fill < self.length and (loose or low <= high):
                if not loose:
                    loose = list(reversed(windows[low][1]))
                    low += 1
                document, start, ids = loose.pop()
                n = min(self.length - fill, len(ids) // 4)
                pieces.append((document, start, ids[: 4 * n]))
                fill += n
                if 4 * n < len(ids):
                    loose.append((document, start + n, ids[4 * n :]))
            if fill == self.length:
                self.closed.append(pieces)
            else:
                self._keep(fill, pieces)
        if loose:
            self._keep(sum(len(p[2]) // 4 for p in loose), list(reversed(loose)))

    def _keep(self, fill: int, pieces: list) -> None:
        self.open[fill // self.step].append((fill, pieces))
        self.counts[fill // self.step] += 1
        self.n_open += 1

    def finish(self) -> None:
        if self.filler is not None:
            piece, self.filler = self.filler, None
            self._keep(len(piece[2]) // 4, [piece])
        if self.n_open:
            self._merge()
        rest = [p for stack in self.open for w in stack for p in w[1]]
        rest.reverse()
        left = sum(len(p[2]) // 4 for p in rest)
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            window = []
            while size:
                document, start, ids = rest.pop()
                n = min(size, len(ids) // 4)
                window.append((document, start, ids[: 4 * n]))
                size -= n
                if 4 * n < len(ids):
                    rest.append((document, start + n, ids[4 * n :]))
            self.closed.append(window)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    end_id: int = END_ID,
    levels: int = LEVELS,
    max_open: int = MAX_OPEN,
) -> DataFrame:
    """One row per piece: ``<id_col>, start, length, ids`` (little-endian
    unsigned 32-bit), ``doc_tokens, sequence_id, offset``. Sequences are
    ``length`` ids long, or a power of two at the end of an input split."""
    source = docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("t"))
    id_type = source.schema["d"].dataType
    schema = T.StructType(
        [
            T.StructField(id_col, id_type),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_cache(f"encoder:{tokenizer_path}", lambda: BatchEncoder(tokenizer_path))
        packer = SquaresPacker(length, levels, max_open)
        end = np.asarray([end_id], dtype="<u4").tobytes()
        next_id = TaskContext.get().partitionId() << 36
        out_schema = None

        def emit():
            nonlocal next_id
            rows: list[list] = [[] for _ in range(7)]
            for window in packer.closed:
                offset = 0
                for (doc, total), start, ids in window:
                    n = len(ids) // 4
                    for column, value in zip(rows, (doc, start, n, ids, total, next_id, offset), strict=True):
                        column.append(value)
                    offset += n
                next_id += 1
            packer.closed = []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(rows, out_schema, strict=True)], schema=out_schema
            )

        for batch in batches:
            if out_schema is None:
                out_schema = pa.schema(
                    [(id_col, batch.schema.field(0).type)]
                    + [(n, pa.binary() if n == "ids" else pa.int64()) for n in schema.names[1:]]
                )
            documents = batch.column(0).to_pylist()
            for at, n, raw, bounds in pieces_of(batch.column(1)):
                for doc, ids in zip(documents[at : at + n], encoder.encode(raw, bounds), strict=True):
                    packer.add((doc, len(ids) + 1), ids.tobytes() + end)
                if packer.closed:
                    yield emit()
        packer.finish()
        if packer.closed:
            yield emit()

    return source.mapInArrow(task, schema)
