"""Sum-of-squares online packing of tokenised documents into fixed windows.

Every task packs the documents of its partition as they come, so packing needs
no shuffle, and a task that is run again makes the same sequences. A document
is cut into full windows and a rest; the rest goes to the fill level whose
choice keeps the sum of squared counts of partly filled windows smallest. The
counts stand in an array by level. The few windows that are still open at the
end of a partition, or beyond ``max_open``, are joined by cutting their pieces,
so that a task leaves one window that is not full.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tickloom.llm.common import sliced, texts, travels

if TYPE_CHECKING:
    from tokenizers import Tokenizer

travels(__name__)

WINDOW = 2048
END_ID = 1
MAX_OPEN = 2048  # open windows of a task: at most 2048 x 2048 ids in memory
_SPECIAL = "<|endoftext|>"
_LONG_RUN = re.compile(r"\S{1000}")
_TASK_BITS = 40
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class Encoder:
    """Ids of the byte-level BPE vocabulary in a tokenizer file.

    The ranks of that vocabulary are applied by the faster of the two public
    libraries (the ids are the same, which the tests check); a text with a run
    of 1000 characters or more without white space goes to the file's own
    library, whose time does not grow with the square of such a run.
    """

    def __init__(self, json_path: str, ranks_path: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.json_path = json_path
        self.ranks = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    @cached_property
    def own(self) -> Tokenizer:
        """The file's own library, loaded with the first text that needs it: it takes more memory than the ranks."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.json_path)

    @cached_property
    def special(self) -> int:
        return self.own.token_to_id(_SPECIAL)

    def __call__(self, text: str) -> list[int]:
        if _LONG_RUN.search(text):
            return self.own.encode(text, add_special_tokens=False).ids
        if _SPECIAL not in text:
            return self.ranks.encode_ordinary(text)
        ids: list[int] = []
        for i, part in enumerate(text.split(_SPECIAL)):
            ids += ([self.special] if i else []) + self.ranks.encode_ordinary(part)
        return ids


@dataclass
class Piece:
    doc_id: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc_id, self.start, self.ids[:at], self.doc_tokens),
            Piece(self.doc_id, self.start + at, self.ids[at:], self.doc_tokens),
        )


@dataclass
class SumOfSquares:
    """Open windows by fill level; ``closed`` gets every window that is full."""

    window: int = WINDOW
    closed: list[list[Piece]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.counts = np.zeros(self.window + 1, dtype=np.int64)  # the level array
        self.open: list[list[list[Piece]]] = [[] for _ in range(self.window + 1)]

    def choose(self, size: int) -> int:
        """The level (0: a new window) after which the sum of squared counts is smallest.

        Moving a window from level h to h + size changes the sum by
        2 (count[h + size] - count[h]) + 2; full windows do not count. Ties go
        to the fullest window.
        """
        from_, to = self.counts[: self.window - size + 1], self.counts[size:]
        change = 2 * (to - from_) + 2
        change[-1] = 1 - 2 * from_[-1]
        change = np.where(from_ > 0, change, np.iinfo(np.int64).max)
        change[0] = 2 * self.counts[size] + 1 if size < self.window else 0
        return len(change) - 1 - int(np.argmin(change[::-1]))

    def add(self, piece: Piece) -> None:
        size = len(piece.ids)
        level = self.choose(size)
        if level:
            window = self.open[level].pop()
            self.counts[level] -= 1
        else:
            window = []
        window.append(piece)
        self._put(window, level + size)

    def _put(self, window: list[Piece], level: int) -> None:
        if level == self.window:
            self.closed.append(window)
        else:
            self.open[level].append(window)
            self.counts[level] += 1

    def join_open(self) -> None:
        """Join all open windows, fullest first, cutting pieces where a window ends."""
        pieces = [p for level in reversed(self.open) for window in level for p in window]
        self.__post_init__()
        current: list[Piece] = []
        fill = 0
        for piece in pieces:
            while fill + len(piece.ids) >= self.window:
                head, piece = piece.cut(self.window - fill)
                self.closed.append([*current, head])
                current, fill = [], 0
            if len(piece.ids):
                current.append(piece)
                fill += len(piece.ids)
        if current:
            self._put(current, fill)

    def drain(self) -> list[list[Piece]]:
        done, self.closed = self.closed, []
        return done


def pack(
    docs: DataFrame,
    json_path: str | None = None,
    ranks_path: str | None = None,
    window: int = WINDOW,
    max_open: int = MAX_OPEN,
) -> DataFrame:
    """Pieces of all documents, each with its sequence and offset.

    A document is the ids of its ``text`` (null: empty), then END_ID, so an
    empty text is one id. Every row is a document of its own, also if its
    ``doc_id`` is null or repeated. Other columns are not read. An empty table
    gives no pieces. Paths of the vocabulary default to the public ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        encode = Encoder(
            json_path or public_tokenizers.path("byte_bpe_50k.json"),
            ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"),
        )
        packer = SumOfSquares(window)
        task = TaskContext.get().partitionId() << _TASK_BITS
        made = 0
        for batch in sliced(batches):
            for doc_id, text in zip(texts(batch, "doc_id"), texts(batch, "text")):
                ids = np.array([*encode(text or ""), END_ID], dtype="<u4")
                whole = Piece(doc_id, 0, ids, len(ids))
                while len(whole.ids) >= window:
                    full, whole = whole.cut(window)
                    packer.closed.append([full])
                if len(whole.ids):
                    packer.add(whole)
                if packer.counts.sum() > max_open:
                    packer.join_open()
                if len(packer.closed) >= 1024:
                    yield (out := _rows(packer.drain(), task + made))[0]
                    made += out[1]
        packer.join_open()
        rest = packer.drain() + [w for level in packer.open for w in level]
        if rest:
            yield _rows(rest, task + made)[0]

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def _rows(windows: list[list[Piece]], first: int) -> tuple[pa.RecordBatch, int]:
    columns: list[list] = [[] for _ in range(7)]
    for i, window in enumerate(windows):
        offset = 0
        for p in window:
            row = (p.doc_id, p.start, len(p.ids), zlib.crc32(p.ids.tobytes()), p.doc_tokens, first + i, offset)
            for column, value in zip(columns, row):
                column.append(value)
            offset += len(p.ids)
    names = [f.strip().split()[0] for f in SCHEMA.split(",")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names), len(windows)
