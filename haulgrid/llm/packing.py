"""Hierarchical packing: documents into sequences of several lengths, with next to no padding.

Each task tokenizes its documents and packs them pool by pool, so nothing is shuffled but what is
left at a task's end, less than the shortest window. A document longer than the longest window
fills such windows by itself; its rest, like any shorter document, goes to the tier of the shortest
window that holds it. The tiers are packed from long to short. A piece opens a window of its tier; the
gap behind it takes the longest piece of a shorter tier that fits, again and again, and where
none fits one is cut. So only windows of the longest tier can have padding, less than ``LEAST``
ids each, and what is left over at the very end. The windows of a pool are dealt to steps of about equally
many ids, each with its share of every tier.
"""

from __future__ import annotations

import heapq
import os
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from haulgrid.llm.common import stored, table

#: Windows of the tiers; each but the last must come out full.
SIZES = (256, 512, 1024, 2048)
#: The id behind each document.
END = 1
#: Ids that a cut leaves on either side, if there is a choice.
LEAST = 16
#: Ids that a task gathers before it packs them.
POOL = 1 << 20
#: Ids in a step, about.
STEP = 1 << 16
#: Tasks whose last pieces are packed together.
TASKS = 1024

#: Words whose ids a worker keeps at a time, with marks and without, and their letters at most.
KEPT_WORDS = 300_000
KEPT_PLAIN = 600_000
KEPT_LETTERS = 40
#: Letters of a text that are split into words at a time, up to the next blank.
SEGMENT = 1 << 20

WIDTH = 4  # bytes of an id
_BLANK = re.compile(r"[ \t\n\r]")


#: Words whose pieces the tokenizer finds by letters alone: some that no normal form changes, with
#: ASCII marks before and behind, each run of them a piece of its own; or digits, each one a piece. An
#: apostrophe before letters would take some of them along.
_WORD = re.compile(r"([!-&(-/:-@\[-`{-~]*)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")
_DIGITS = re.compile(r"[0-9]+")
#: ASCII marks.
_MARKS = string.punctuation


def _parts(word: str) -> tuple[str, str, str] | None:
    """The marks before a plain word, its letters and the marks behind; None of any other word."""
    letters = word.strip(_MARKS)
    if not (letters.isalpha() and letters.isascii()):
        match = _WORD.fullmatch(word)
        return match and match.groups()
    at = word.find(letters)
    return None if "'" in word[:at] else (word[:at], letters, word[at + len(letters):])


class Encoder(dict):
    """The ids of words, as little-endian unsigned 32-bit numbers; of texts by way of their words.

    The tokenizer lets no token reach over white space and drops it, so a text's ids are those of
    its words one after the other. A worker keeps the ids of the words that it has seen. A plain
    word goes to the tokenizer's model alone; any other goes through all of its steps.
    """

    def __init__(self, model: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.bytes = [i.to_bytes(WIDTH, "little") for i in range(self.tokenizer.get_vocab_size())]
        # What the model is given for a letter that is not ASCII.
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.letters = {at: split(chr(at))[0][0] for at in range(0xC0, 0x100) if chr(at) not in "×÷"}
        # Such a token in a text is itself, whatever it is made of.
        special = [re.escape(token.content) for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special) or "(?!)").search
        self.tokenize = self.tokenizer.model.tokenize

    def _whole(self, text: str) -> bytes:
        return b"".join([self.bytes[i] for i in self.tokenizer.encode(text, add_special_tokens=False).ids])

    def _letters(self, word: str) -> bytes:
        given = word if word.isascii() else word.translate(self.letters)
        return b"".join([self.bytes[token.id] for token in self.tokenize(given)])

    def __missing__(self, word: str) -> bytes:
        """Learn the ids of a word; those of its letters in lower case are kept once for all its forms."""
        parts = _parts(word)
        if parts and not self.special(word):
            before, letters, behind = parts
            lower = letters.lower()
            ids = self._letters(lower) if lower == word or self.special(lower) else self[lower]
            if before:
                ids = self[before] + ids
            if behind:
                ids += self[behind]
        elif _DIGITS.fullmatch(word) and len(word) > 1:
            ids = b"".join([self[digit] for digit in word])
        else:
            ids = self._whole(word)
        if len(word) <= KEPT_LETTERS:
            self[word] = ids
        return ids

    def encoded(self, text: str) -> bytes:
        """The ids of a text."""
        if len(self) > KEPT_WORDS + KEPT_PLAIN:
            self.clear()
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join(map(self.__getitem__, words))


def segments(text: str) -> Iterator[str]:
    """A text cut at blanks."""
    at = 0
    while at < len(text):
        blank = _BLANK.search(text, at + SEGMENT)
        end = blank.start() if blank else len(text)
        yield text[at:end]
        at = end


@dataclass(frozen=True)
class Piece:
    """Some neighbouring ids of a document."""

    document: int
    doc_id: object
    start: int
    doc_tokens: int
    ids: bytes

    def __len__(self) -> int:
        return len(self.ids) // WIDTH

    def cut(self, at: int) -> tuple["Piece", "Piece"]:
        return (
            replace(self, ids=self.ids[:at * WIDTH]),
            replace(self, start=self.start + at, ids=self.ids[at * WIDTH:]),
        )


class Packer:
    """Pieces that wait for a window, by their length, and the windows made so far."""

    def __init__(self, sizes: tuple[int, ...] = SIZES, least: int = LEAST):
        self.sizes, self.least, self.longest = sizes, least, sizes[-1]
        self.waiting: list[list[Piece]] = [[] for _ in range(self.longest + 1)]
        self.lengths = 0  # bit n is set if a piece of n ids waits
        self.tokens = 0  # that wait
        self.windows: list[tuple[int, list[Piece]]] = []

    def add(self, piece: Piece) -> None:
        """Full windows of the longest tier leave at once."""
        while len(piece) >= self.longest:
            head, piece = piece.cut(self.longest)
            self.windows.append((self.longest, [head]))
        if len(piece):
            self.waiting[len(piece)].append(piece)
            self.lengths |= 1 << len(piece)
            self.tokens += len(piece)

    def _take(self, length: int) -> Piece:
        piece = self.waiting[length].pop()
        if not self.waiting[length]:
            self.lengths &= ~(1 << length)
        self.tokens -= length
        return piece

    def _upto(self, length: int) -> int:
        """The length of the longest piece of at most so many ids, 0 if there is none."""
        return max((self.lengths & ((2 << length) - 1)).bit_length() - 1, 0)

    def _from(self, length: int) -> int:
        """The length of the shortest piece of at least so many ids, 0 if there is none."""
        above = self.lengths >> length
        return length + (above & -above).bit_length() - 1 if above else 0

    def _filled(self, first: Piece, size: int) -> list[Piece] | None:
        """A window behind this piece; None, and its pieces wait on, if there is too little to fill it."""
        window, gap = [first], size - len(first)
        while gap:
            length = self._upto(gap)
            if not length:
                if size == self.longest and gap < self.least:
                    break
                long = self._from(gap + self.least) or self._from(gap + 1)
                if not long:
                    for piece in window:
                        self.add(piece)
                    return None
                head, rest = self._take(long).cut(gap)
                self.add(rest)
                window.append(head)
                break
            window.append(self._take(length))
            gap -= length
        return window

    def pack(self) -> None:
        """Windows for what waits, tier by tier; too little for a window waits on."""
        shorter = (0, *self.sizes)
        for size, below in zip(reversed(self.sizes), reversed(shorter[:-1])):
            while (length := self._upto(size)) > below:
                window = self._filled(self._take(length), size)
                if window is None:
                    break
                self.windows.append((size, window))

    def finish(self) -> list[Piece]:
        """Windows for all that waits but less than the shortest, which is returned."""
        self.pack()
        rest = [self._take(self._upto(self.longest)) for _ in range(sum(map(len, self.waiting)))]
        left = sum(map(len, rest))
        for size in reversed(self.sizes):
            while left >= size:
                left -= size
                window, gap = [], size
                while gap:
                    piece = rest.pop()
                    if len(piece) > gap:
                        piece, after = piece.cut(gap)
                        rest.append(after)
                    window.append(piece)
                    gap -= len(piece)
                self.windows.append((size, window))
        return rest

    def stepped(self) -> list[tuple[int, int, list[Piece]]]:
        """The windows made, which leave, each with its step: long ones first, to the step with least ids."""
        windows, self.windows = sorted(self.windows, key=lambda window: -window[0]), []
        total = sum(size for size, _ in windows)
        heap = [(0, step) for step in range(max(1, round(total / STEP)))]
        out = []
        for size, window in windows:
            ids, step = heapq.heappop(heap)
            out.append((step, size, window))
            heapq.heappush(heap, (ids + size, step))
        return out


class _Writer:
    """Rows of packed pieces, with sequences and steps numbered from a base on."""

    def __init__(self, base: int, arrow: pa.Schema):
        self.sequence = self.step = base
        self.arrow = arrow

    def rows(self, packer: Packer, left: list[Piece] = []) -> Iterator[pa.RecordBatch]:  # noqa: B006
        windows = packer.stepped()
        out = []
        for step, size, window in windows:
            offset = 0
            for piece in window:
                out.append(self._row(piece, self.sequence, offset, size, self.step + step))
                offset += len(piece)
            self.sequence += 1
        self.step += 1 + max((step for step, _, _ in windows), default=-1)
        out += [self._row(piece, None, None, None, None) for piece in left]
        yield from pa.Table.from_pylist(out, self.arrow).to_batches()

    def _row(self, piece: Piece, sequence, offset, size, step) -> dict:
        return {
            "document": piece.document, "doc_id": piece.doc_id, "start": piece.start, "length": len(piece),
            "doc_tokens": piece.doc_tokens, "ids": piece.ids, "sequence_id": sequence, "offset": offset,
            "size": size, "step": step,
        }


#: Numbers of documents, sequences and steps have the task above these bits.
TASK_BITS = 33
#: Sequences and steps of last pieces are numbered from here on.
LAST = 1 << 62


def pieces(docs: DataFrame, model: str, end: int = END, sizes: tuple[int, ...] = SIZES) -> DataFrame:
    """(document, doc_id, start, length, doc_tokens, ids, sequence_id, offset, size, step) of all pieces.

    ``docs`` has doc_id and text; ``model`` is a tokenizer's file, as text, one that drops white
    space. A document's ids are those of its whole text without special tokens, and ``end``. A
    piece is ``length`` of them from ``start`` on; ids holds them as little-endian 32-bit numbers.
    It lies at ``offset`` of its sequence, which is to be padded to ``size``; sequences of one ``step``
    belong together. document numbers the rows of ``docs``, so rows with one id stay apart; equal
    rows and NULL ids are documents like any other. A NULL text is empty, and an empty one has
    the end alone. An empty table gives an empty table; other columns are not read. ``sizes`` are
    powers of two, ascending.
    """
    id_type = docs.schema["doc_id"].dataType
    kinds = T.StructType.fromDDL(
        "document long, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long, "
        "size int, step long"
    ).add("doc_id", id_type)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = Encoder(model), Packer(sizes)
        first = document = TaskContext.get().partitionId() << TASK_BITS
        writer = _Writer(first, to_arrow_schema(kinds))

        def encoded() -> Iterator[tuple[object, bytes]]:
            for batch in batches:
                for doc_id, text in zip(batch.column(0), batch.column(1)):
                    yield doc_id.as_py(), b"".join(map(encoder.encoded, segments(text.as_py() or "")))

        for doc_id, ids in encoded():
            ids += end.to_bytes(WIDTH, "little")
            packer.add(Piece(document, doc_id, 0, len(ids) // WIDTH, ids))
            document += 1
            if packer.tokens > POOL or len(packer.windows) * sizes[-1] > POOL:
                packer.pack()
                yield from writer.rows(packer)
        left = packer.finish()
        yield from writer.rows(packer, left)

    def last(group: pa.Table) -> pa.Table:
        """The last pieces of many tasks; their own last ones are one padded sequence."""
        packer = Packer(sizes)
        rows = sorted(group.to_pylist(), key=lambda row: (row["document"], row["start"]))
        for row in rows:
            packer.add(Piece(row["document"], row["doc_id"], row["start"], row["doc_tokens"], row["ids"]))
        left = packer.finish()
        if left:
            total = sum(map(len, left))
            packer.windows.append((total if total & (total - 1) == 0 else sizes[-1], left))
        group = rows[0]["document"] >> TASK_BITS
        writer = _Writer(LAST + (group // TASKS << TASK_BITS), to_arrow_schema(kinds))
        return pa.Table.from_batches(writer.rows(packer), writer.arrow)

    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(packed, kinds)
    found = stored(found, "packed")
    tasks = F.floor(F.shiftright("document", TASK_BITS) / TASKS)
    rest = found.where("sequence_id is null").groupBy(tasks.alias("tasks"))
    return found.where("sequence_id is not null").union(rest.applyInArrow(last, kinds))


def op11_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """All documents in sequences of at most 2048 ids; ``tokenizer`` is the path of its file."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    with open(tokenizer, encoding="utf-8") as file:
        model = file.read()
    found = pieces(table(spark, sf_dir, "documents"), model)
    return found.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        "size", "step",
    )
