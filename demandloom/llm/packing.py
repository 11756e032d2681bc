"""Packing of tokenised documents into windows, in order, by dynamic programming."""

from __future__ import annotations

import re
from collections import deque

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import arrow_schema, documents, per_worker

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
WINDOW = 4096
# Costs in tokens of padding: cutting a document after a sentence, and elsewhere.
SENTENCE_CUT = 16
HARD_CUT = 64
# A stretch without a sentence end gets a place to cut every so many tokens.
STRETCH = 512
# Tokens planned together; what does not fill its last window opens the next block.
BLOCK = 1 << 20
# Distinct words whose ids a Python worker remembers: about 120 MB.
REMEMBERED = 500_000

PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


def plan_cuts(places: list[int], penalties: list[int], window: int) -> list[int]:
    """Indices of the cuts that minimise padding plus penalties, from 0 to the last place.

    ``places`` ascend from 0 by at most ``window``; ``penalties[j]`` is paid for a cut at
    place ``j``. A window from place ``i`` to ``j`` is padded by ``window - (places[j] -
    places[i])``, so the best ``i`` for ``j`` has the least ``cost[i] + places[i]`` among
    those in reach. A queue holds the candidates with that key ascending: a place
    drops out at the front when it falls out of reach and at the back when a later one
    is no worse, so every place enters and leaves once.
    """
    cost = [0] * len(places)
    origin = [0] * len(places)
    queue: deque[tuple[int, int]] = deque([(0, 0)])
    pop_front, pop_back, push = queue.popleft, queue.pop, queue.append
    for j in range(1, len(places)):
        here = places[j]
        while places[queue[0][1]] < here - window:
            pop_front()
        best, i = queue[0]
        origin[j] = i
        cost[j] = key = best + window - here + penalties[j]
        key += here
        while queue and queue[-1][0] >= key:
            pop_back()
        push((key, j))
    cuts = [len(places) - 1]
    while cuts[-1]:
        cuts.append(origin[cuts[-1]])
    return cuts[::-1]


def binary_lengths(length: int, window: int, cut: int = HARD_CUT) -> list[int]:
    """Lengths of the last sequences: powers of two need no padding, each cut has its price.

    The largest powers are split off while that costs less than padding the rest.
    """
    parts = []
    while length & (length - 1) and window - length > cut:
        power = 1 << (length.bit_length() - 1)
        parts.append(power)
        length -= power
    return [*parts, length] if length else parts


class WordIds(dict):
    """Chunk of a text between blanks to its number; ids of chunk ``n`` in ``flat``.

    Blanks part the pieces that the tokenizer sees, and so does the step from a letter
    to a mark, so chunks are encoded once each. A chunk of plain Latin letters and
    closing marks goes to the model directly, any other through the whole tokenizer.
    """

    def __init__(self, path: str):
        import os
        from array import array
        from string import punctuation

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.marks = punctuation
        self.letters = _byte_letters()
        self.forget = lambda: (array("I"), array("q", [0]), array("b"))
        self.flat, self.ends, self.closes = self.forget()

    def __missing__(self, chunk: str) -> int:
        if chunk.isalpha() and chunk.isascii():
            ids, closes = [t.id for t in self.model.tokenize(chunk)], False
        else:
            ids = self.encode(chunk)  # may number its closing marks first
            closes = chunk.rstrip("\"')]»”’")[-1:] in (".", "!", "?", "…")
        self[chunk] = number = len(self)
        self.flat.extend(ids)
        self.ends.append(len(self.flat))
        self.closes.append(closes)
        return number

    def encode(self, chunk: str) -> list[int]:
        """Ids of a chunk whose letters A-Z are lowered."""
        from unicodedata import is_normalized

        if not chunk:
            return []
        stem = chunk.rstrip(self.marks)
        # Below U+0250 every letter lowers to one letter, except the two left out.
        if stem and stem.isalpha() and max(stem) < "ɐ" and not {"İ", "ŉ"} & set(stem):
            low = stem.lower()
            if low.isascii() or is_normalized("NFC", low):
                piece = low if low.isascii() else "".join(map(self.letters.__getitem__, low.encode()))
                ids = [t.id for t in self.model.tokenize(piece)]
                if len(stem) < len(chunk):
                    tail = self[chunk[len(stem) :]]
                    ids += self.flat[self.ends[tail] : self.ends[tail + 1]]
                return ids
        return self.tokenizer.encode(chunk, add_special_tokens=False).ids

    def trim(self, most: int) -> None:
        if len(self) > most:
            self.clear()
            self.flat, self.ends, self.closes = self.forget()


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones
    for themselves, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in plain)
    moved = {b: chr(0x100 + i) for i, b in enumerate(others)}
    return [moved.get(b, chr(b)) for b in range(256)]


class Stream:
    """Documents of one partition, packed block by block."""

    def __init__(self, first_sequence: int, end_id: int, window: int):
        self.sequence, self.end_id, self.window = first_sequence, end_id, window
        self.docs: list[tuple] = []  # id, ids, places of cuts, their penalties, ids already out
        self.waiting = 0

    def add(self, doc_id, ids, sentence_ends) -> None:
        """``ids`` with the end id; ``sentence_ends`` are places inside, ascending."""
        places, penalties, last = [], [], 0
        for place in (*sentence_ends, len(ids)):
            hard = range(last + STRETCH, place, STRETCH)
            places.extend(hard)
            penalties.extend([HARD_CUT] * len(hard))
            places.append(place)
            penalties.append(SENTENCE_CUT)
            last = place
        penalties[-1] = 0
        self.docs.append((doc_id, ids, places, penalties, 0))
        self.waiting += len(ids)

    def pack(self, last: bool):
        """Rows of ``PIECES`` for the windows that are settled, all if ``last``."""
        if not self.docs:
            return
        places, penalties, base = [0], [0], 0
        for _, ids, mine, prices, out in self.docs:
            places.extend(base - out + p for p in mine if p > out)
            penalties.extend(price for p, price in zip(mine, prices, strict=True) if p > out)
            base += len(ids) - out
        cuts = [places[i] for i in plan_cuts(places, penalties, self.window)]
        lengths = [b - a for a, b in zip(cuts, cuts[1:], strict=False)]
        rest = lengths.pop()
        if last:
            lengths += binary_lengths(rest, self.window)
        yield from self._cut(lengths)

    def _cut(self, lengths: list[int]):
        at, docs = 0, self.docs
        doc_id, ids, mine, prices, out = docs[0]
        for length in lengths:
            offset = 0
            while offset < length:
                take = min(length - offset, len(ids) - out)
                piece = ids[out : out + take].tobytes()
                yield doc_id, out, take, piece, len(ids), self.sequence, offset
                out += take
                offset += take
                if out == len(ids) and at + 1 < len(docs):
                    at += 1
                    doc_id, ids, mine, prices, out = docs[at]
            self.sequence += 1
        left = [(doc_id, ids, mine, prices, out)] if out < len(ids) else []
        self.docs = left + docs[at + 1 :]
        self.waiting = sum(len(d[1]) - d[4] for d in self.docs)


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, window: int = WINDOW, end_id: int = END_ID):
    """Pieces of documents in sequences of at most ``window`` tokens: ``PIECES``.

    A document is its ids without special tokens, then ``end_id``; a NULL or empty text
    is that id alone. ``ids`` holds little-endian unsigned 32-bit ids. Documents keep
    the order of their input partition, and each partition is packed by itself with
    no exchange; sequence ids start at the partition's number times 2^32. Within a
    partition, blocks of about a million tokens are planned exactly. Only the end of a
    partition pays for its last window, as powers of two where that is cheaper. Repeated
    rows are packed each; an empty table gives no piece.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        stream = Stream(TaskContext.get().partitionId() << 32, end_id, window)
        words = per_worker(("word ids", tokenizer), lambda: WordIds(tokenizer))
        number_of = words.__getitem__

        def rows(last):
            found = list(stream.pack(last))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found, strict=True), schema.types, strict=True)],
                    schema=schema,
                )

        for batch in batches:
            words.trim(REMEMBERED)
            chunked = []
            for text in batch.column("text").to_pylist():
                chunked.append(np.array(list(map(number_of, chunks_of(text or ""))), dtype=np.int64))
            flat = np.array(words.flat, dtype="<u4")
            ends = np.array(words.ends, dtype=np.int64)
            closes = np.array(words.closes, dtype=bool)
            for doc_id, chunks in zip(batch.column("doc_id").to_pylist(), chunked, strict=True):
                sizes = ends[chunks + 1] - ends[chunks]
                after = np.cumsum(sizes)
                ids = np.empty(after[-1] + 1, dtype="<u4")
                ids[-1] = end_id
                ids[:-1] = flat[np.repeat(ends[chunks + 1] - after, sizes) + np.arange(after[-1])]
                sentences = after[closes[chunks]]
                stream.add(doc_id, ids, np.unique(sentences[sentences < after[-1]]).tolist())
                if stream.waiting >= BLOCK:
                    yield from rows(False)
        yield from rows(True)

    schema = arrow_schema(PIECES)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


_BLANKS = bytes.maketrans(b"\t\n\r", b"   ")


# A point or comma before a blank that does not follow a plain or Latin-1 letter.
_ODD = re.compile(rb"(?<![a-z])(?<!\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])[.,] ")


def chunks_of(text: str) -> list[str]:
    """Parts of a text between which the tokenizer parts it too.

    A-Z are lowered and blanks made one kind, as the tokenizer does. A point or comma at
    the end of a word is a part by itself, unless the text has others too.
    """
    data = text.encode().lower().translate(_BLANKS)
    if not _ODD.search(data):
        data = data.replace(b". ", b" . ").replace(b", ", b" , ")
    return data.decode().split(" ")


def op8(spark, sf_dir: str) -> DataFrame:
    return digests(pack(documents(spark, sf_dir)))


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def packed(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the digest of the packed pieces."""
    return digests(pack(docs))
