"""Alignment of two tokenizers over the same bytes, by an associative monoid of fragments.

Byte offsets at which a token of A and a token of B both end cut a text into groups. A
fragment stands for a byte range: the ids up to its first cut (open prefix), the groups
between its cuts, and the ids after its last cut (open suffix). Fragments of neighbouring
ranges compose to that of both, in any bracketing, so a very long text is worked on in
chunks by many tasks and its fragments are put together by a tree of small groups.

Both tokenizers work stretch by stretch: a cut of the text before a blank or line end that
follows something else is a token end of both, whatever stands around it. A stretch's
ids and groups are worked out once and remembered.
"""

from __future__ import annotations

import re
from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm.common import arrow_schema, documents, per_worker
from demandloom.session import materialize, scratch_path

TOKENIZER_A = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER_B = public_tokenizers.path("piece_bpe_32k.model")
# Characters of a chunk of a longer text. A chunk ends inside a stretch of at most this
# many characters, and before a longer one.
CHUNK_CHARS = 1 << 16
SHORT_STRETCH = 1024
# Links of one block, whose distinct pairs are looked up together.
BLOCK_LINKS = 1 << 22
# Distinct stretches that a Python worker remembers: about 200 MB.
REMEMBERED = 400_000
# Fragments that one task puts together at a time.
ARITY = 16
# Pair of ids as one number.
SHIFT = 32

# Documents, distinct pairs of a block, chunks of longer texts, and links of those.
DOCUMENT, PAIRS, CHUNK, LINKS = 0, 1, 2, 3
# Added to the partition's number in the blocks of longer texts.
LATE = 1 << 24
STAGED = (
    "kind int, row long, doc_id long, chunk int, chunks int, n_a long, n_b long, n_groups long, "
    "groups_sha256 string, block long, links binary, pair long, n long, body string, low long, high long"
)
FRAGMENTS = (
    "row long, doc_id long, chunk int, chunks int, good boolean, cut boolean, prefix_a array<int>, "
    "prefix_b array<int>, suffix_a array<int>, suffix_b array<int>, n_a long, n_b long, "
    "n_groups long, text binary, codes binary"
)
JOINTS = (
    "row long, chunk int, a array<int>, b array<int>, cut boolean, prefix_a array<int>, "
    "prefix_b array<int>, suffix_a array<int>, suffix_b array<int>"
)

_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_BLANKS = re.compile(r"\s\s")


def stretches(full: str) -> list[str]:
    """A text, from a cut on, cut before every blank and line end that follows something else.

    The blank before a stretch is left out unless another blank comes next; ``whole``
    puts it back.
    """
    if _BLANKS.search(full):
        parts = _CUT.split(full)
        return [p[1:] if p[0] == " " and not p[1:2].isspace() and len(p) > 1 else p for p in parts]
    return full.replace("\n", " \n").split(" ")[1:]


def whole(stretch: str) -> str:
    return stretch if stretch[:1] in (" ", "\n") else " " + stretch


class Aligner(dict):
    """Stretch to its number ``n``: sizes, groups and links of both tokenizers.

    ``groups[n]`` is the text of its groups; ``codes[code_ends[n] : code_ends[n + 1]]`` are the
    linked pairs, one per group; ``good[n]`` tells whether both give back its bytes.
    """

    def __init__(self, path_a: str, path_b: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy as np
        import sentencepiece
        from tokenizers import Tokenizer

        a = Tokenizer.from_file(path_a)
        a.encode_special_tokens = True
        self.bytes_a = bytes_of_entries(a)
        self.encode_a = encoder_of(a, path_a, self.bytes_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = bytes_of_pieces(self.b)
        self.blank = self.b.piece_to_id("▁")
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in t]) for t in (self.bytes_a, self.bytes_b))
        self.forget()

    def forget(self) -> None:
        from array import array

        self.clear()
        self.fresh: list[str] = []
        self.pairs: dict[int, str] = {}
        self.groups: list[str] = []
        self.codes, self.code_ends = array("q"), array("q", [0])
        self.n_a, self.n_b, self.good = array("i"), array("i"), array("b")
        self.made = None

    def __missing__(self, stretch: str) -> int:
        self[stretch] = number = len(self)
        self.fresh.append(stretch)
        return number

    def ids(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of both tokenizers for whole stretches; those of B without the blank it adds."""
        if text[0] != " ":
            b = self.b.encode(text)[1:]
        elif text == " ":
            b = [self.blank]
        else:
            b = self.b.encode(text[1:])
        return self.encode_a(text), b

    def gives_back(self, text: str, a: list[int], b: list[int]) -> bool:
        data = text.encode()
        return all(
            b"".join(map(t.__getitem__, x)) == data for t, x in ((self.bytes_a, a), (self.bytes_b, b))
        )

    def learn(self) -> None:
        """What is to be known of the stretches numbered since the last call.

        Many are tokenised as one text, which both part at the same places again. One that
        ends with a blank, as at the end of a text, would run into the next.
        """
        fresh, self.fresh = [whole(x) for x in self.fresh], []
        part: list[str] = []
        for text in fresh:
            alone = text[-1].isspace()
            if part and (alone or len(part) >= 512):
                self._put(part)
                part = []
            part.append(text)
            if alone:
                self._put(part)
                part = []
        if part:
            self._put(part)

    def _put(self, texts: list[str]) -> None:
        import numpy as np

        joined = "".join(texts)
        a, b = self.ids(joined)
        if not self.gives_back(joined, a, b):
            if len(texts) > 1:
                for text in texts:
                    self._put([text])
                return
            self._add([""], [0], [len(a)], [len(b)], np.empty(0, dtype=np.int64), False)
            return
        a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        ends, at_a, at_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        sizes = map(len, texts if joined.isascii() else [t.encode() for t in texts])
        text_ends = np.cumsum(np.fromiter(sizes, dtype=np.int64, count=len(texts)))
        last = np.searchsorted(ends, text_ends)
        if (ends[last] != text_ends).any():  # the end of a stretch is a cut
            raise AssertionError(f"tokens reach over the end of a stretch in {joined!r}")
        codes = (a[at_a] << SHIFT) | b[at_b]
        groups = self._texts(a, b, at_a, at_b, codes)
        cut_ends = (last + 1).tolist()
        begins = [0, *cut_ends[:-1]]
        sizes_a, sizes_b = (np.diff(at[last], prepend=-1).tolist() for at in (at_a, at_b))
        self._add(
            [";".join(groups[x:y]) for x, y in zip(begins, cut_ends, strict=True)],
            [y - x for x, y in zip(begins, cut_ends, strict=True)],
            sizes_a,
            sizes_b,
            codes,
            True,
        )

    def _texts(self, a, b, at_a, at_b, codes) -> list[str]:
        """The groups as text. Most are of one token each, and of few different pairs."""
        import numpy as np

        first_a, first_b = (np.concatenate([[0], at[:-1] + 1]) for at in (at_a, at_b))
        groups = list(map(self.pairs.get, codes.tolist()))
        single = (first_a == at_a) & (first_b == at_b)
        unknown = np.array([g is None for g in groups], dtype=bool)
        for k in np.flatnonzero(single & unknown).tolist():
            code = int(codes[k])
            groups[k] = self.pairs[code] = f"{code >> SHIFT}|{code & ((1 << SHIFT) - 1)}"
        many = np.flatnonzero(~single)
        bounds = (x[many].tolist() for x in (first_a, at_a + 1, first_b, at_b + 1))
        a, b = a.tolist(), b.tolist()
        for k, i, j, m, n in zip(many.tolist(), *bounds, strict=True):
            groups[k] = group_text(a[i:j], b[m:n])
        return groups

    def _add(self, groups, n_groups, n_a, n_b, codes, good) -> None:
        self.groups += groups
        self.codes.frombytes(codes.tobytes())
        end = self.code_ends[-1]
        for n in n_groups:
            end += n
            self.code_ends.append(end)
        self.n_a.extend(n_a)
        self.n_b.extend(n_b)
        self.good.extend([good] * len(groups))

    def of(self, numbers):
        """``(n_a, n_b, text of the groups, codes)`` of stretches in a row, all good; else None."""
        import numpy as np

        codes, code_ends, n_a, n_b, good = self.arrays()
        if not good[numbers].all():
            return None
        sizes = code_ends[numbers + 1] - code_ends[numbers]
        after = np.cumsum(sizes)
        at = np.repeat(code_ends[numbers + 1] - after, sizes) + np.arange(sizes.sum())
        text = ";".join([self.groups[n] for n in numbers.tolist()])
        return int(n_a[numbers].sum()), int(n_b[numbers].sum()), text, codes[at]

    def arrays(self):
        """What is known so far, as arrays; made anew after ``learn``."""
        import numpy as np

        if self.made is None or len(self.made[2]) != len(self.n_a):
            columns = (self.codes, self.code_ends, self.n_a, self.n_b, self.good)
            self.made = [np.array(x, dtype=np.int64) for x in columns]
        return self.made


# Odd texts on which a faster encoder has to agree with the library.
PROBES = (
    " it's we'll I'd  two\n\n lines\t1234 ünïcode 中文 😀 <|endoftext|> x\u00a0y \u2581 ",
    "\n\n \r\n a\x00b\x85c ﬁ é “quoted” don't DON'T 12,345.67e-8 __init__ ####",
)


def encoder_of(tokenizer, path: str, entries: list[bytes]):
    """Text to ids of a byte-level vocabulary.

    Where the ids are the ranks of the merges and words are parted by the usual pattern, a
    faster library gives the same ids; that it does is looked at here.
    """
    import tiktoken

    ranks = {data: i for i, data in enumerate(entries) if not _is_special(tokenizer, i)}
    fast = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def slow(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    if all(fast.encode_ordinary(x) == slow(x) for x in PROBES):
        return fast.encode_ordinary
    return slow


def _is_special(tokenizer, number: int) -> bool:
    return number in tokenizer.get_added_tokens_decoder()


def group_text(a, b) -> str:
    return ",".join(map(str, a)) + "|" + ",".join(map(str, b))


def bytes_of_entries(tokenizer) -> list[bytes]:
    """Bytes of a byte-level vocabulary: printable ones stand for themselves, the others
    for the letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    size = tokenizer.get_vocab_size()
    return [bytes(byte_of[c] for c in tokenizer.id_to_token(i)) for i in range(size)]


def bytes_of_pieces(processor) -> list[bytes]:
    """Bytes of a piece vocabulary: U+2581 is a blank, ``<0xHH>`` the byte HH."""
    found = []
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i)
        if processor.is_byte(i):
            found.append(bytes([int(piece[3:5], 16)]))
        else:
            found.append(piece.replace("▁", " ").encode())
    return found


def chunks_of(full: str, chars: int) -> list[tuple[str, int, int]]:
    """``(body, low, high)`` of each chunk: the stretches that meet it, and its byte range there.

    The ranges follow each other and cover the text. A place every ``chars`` characters ends
    a range; one in a stretch longer than ``SHORT_STRETCH`` moves to its start, so only
    short stretches are looked at from two sides.
    """
    ranges: list[tuple[int, int, int]] = []  # cut before, end, cut after
    last, at = 0, chars
    while at < len(full):
        found = _CUT.search(full, at)
        after = found.start() if found else len(full)
        before = _last_cut(full, max(at - SHORT_STRETCH, last), at)
        if before is not None and after - before <= SHORT_STRETCH:
            ranges.append((before, at, after))
            last, at = at, at + chars
            continue
        start = before if before is not None else _last_cut(full, last, at)
        if start is not None and start > last:
            ranges.append((start, start, start))
            last = start
        at = max(after, at + 1)
    pieces, begin, end = [], 0, 0
    for before, stop, after in (*ranges, (len(full),) * 3):
        low = len(full[begin:end].encode())
        pieces.append((full[begin:after], low, low + len(full[end:stop].encode())))
        begin, end = before, stop
    return pieces


def _last_cut(text: str, low: int, high: int) -> int | None:
    return max((m.start() for m in _CUT.finditer(text, low, high + 1)), default=None)


class Fragment:
    """Ids up to the first cut, whether there is a cut, and ids after the last one."""

    __slots__ = ("cut", "prefix_a", "prefix_b", "suffix_a", "suffix_b")

    def __init__(self, cut, prefix_a, prefix_b, suffix_a, suffix_b):
        self.cut = cut
        self.prefix_a, self.prefix_b = prefix_a, prefix_b
        self.suffix_a, self.suffix_b = suffix_a, suffix_b

    def then(self, after: Fragment) -> tuple[Fragment, tuple | None]:
        """The fragment of both ranges, and the group that closes between them, if one does.

        Without a cut all ids of a range are in its prefix.
        """
        if not self.cut:
            a, b = self.prefix_a + after.prefix_a, self.prefix_b + after.prefix_b
            return Fragment(after.cut, a, b, after.suffix_a, after.suffix_b), None
        a, b = self.suffix_a + after.prefix_a, self.suffix_b + after.prefix_b
        if not after.cut:
            return Fragment(True, self.prefix_a, self.prefix_b, a, b), None
        # Nothing closes where the ranges meet at a cut.
        closed = (a, b) if a else None
        return Fragment(True, self.prefix_a, self.prefix_b, after.suffix_a, after.suffix_b), closed


def staged(docs: DataFrame, path_a: str, path_b: str, chunk_chars: int, block_links: int) -> DataFrame:
    """One pass over the texts, as ``STAGED``: documents, chunks of longer ones, pair counts.

    A document that fits a chunk is finished here; ``links`` holds places in the block's
    list of distinct pairs, which ``PAIRS`` rows give in order with their numbers.
    """

    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        aligner = per_worker(("aligner", path_a, path_b), lambda: Aligner(path_a, path_b))
        number_of = aligner.__getitem__
        first = TaskContext.get().partitionId() << 33
        row = block = first
        waiting: list[tuple] = []
        n_waiting = 0

        def batch_of(rows, names):
            return sparse_batch(rows, names, schema)

        def flush():
            nonlocal block, n_waiting
            if not waiting:
                return
            yield from block_rows([w[-1] for w in waiting], waiting, block, batch_of)
            waiting.clear()
            n_waiting = 0
            block += 1

        for batch in batches:
            if len(aligner) > REMEMBERED:
                aligner.forget()
            made, cut = [], []
            for doc_id, text in zip(
                batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True
            ):
                full = " " + text if text else ""
                if len(full) > chunk_chars:
                    pieces = chunks_of(full, chunk_chars)
                    if len(pieces) > 1:
                        cut += [
                            (CHUNK, row, doc_id, k, len(pieces), *piece) for k, piece in enumerate(pieces)
                        ]
                        row += 1
                        continue
                numbers = np.array(list(map(number_of, stretches(full))) if full else [], dtype=np.int64)
                made.append((row, doc_id, numbers))
                row += 1
            if cut:
                names = ("kind", "row", "doc_id", "chunk", "chunks", "body", "low", "high")
                yield batch_of(cut, names)
            aligner.learn()
            for number, doc_id, numbers in made:
                found = aligner.of(numbers) if len(numbers) else None
                if found is None:
                    none = np.empty(0, dtype=np.int64)
                    waiting.append((DOCUMENT, number, doc_id, 0, 0, 0, "", block, none))
                else:
                    n_a, n_b, text, codes = found
                    sha = hashlib.sha256(text.encode()).hexdigest()
                    waiting.append((DOCUMENT, number, doc_id, n_a, n_b, len(codes), sha, block, codes))
                    n_waiting += len(codes)
                if n_waiting >= block_links:
                    yield from flush()
        yield from flush()

    schema = arrow_schema(STAGED)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, STAGED)


def sparse_batch(rows: list[tuple], names: tuple, schema):
    """Rows of some columns as a batch of all."""
    import pyarrow as pa

    columns = dict(zip(names, zip(*rows, strict=True), strict=True))
    arrays = [
        pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(rows), f.type)
        for f in schema
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def block_rows(codes, rows, block, batch_of):
    """The documents of a block with their links as places, and the block's distinct pairs."""
    import numpy as np

    flat = np.concatenate(codes)
    pairs, place, counts = np.unique(flat, return_inverse=True, return_counts=True)
    ends = np.cumsum([len(c) for c in codes])
    place = place.astype("<u4")
    names = ("kind", "row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "block", "links")
    for at in range(0, len(rows), 200):
        part = [
            (*rows[i][:-1], place[ends[i] - len(codes[i]) : ends[i]].tobytes())
            for i in range(at, min(at + 200, len(rows)))
        ]
        yield batch_of(part, names)
    for at in range(0, len(pairs), 50_000):
        some = slice(at, at + 50_000)
        n = len(pairs[some])
        columns = zip([PAIRS] * n, [block] * n, pairs[some].tolist(), counts[some].tolist(), strict=True)
        yield batch_of(list(columns), ("kind", "block", "pair", "n"))


def fragments(chunks: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``FRAGMENTS`` of the chunks of long texts, dealt anew so that those of one text are spread.

    ``text`` holds the groups between the chunk's cuts, ``codes`` their links. Only the first
    and the last stretch of a chunk can reach beyond it; a range that starts with a stretch,
    as that of the whole text does, starts with a cut.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        aligner = per_worker(("aligner", path_a, path_b), lambda: Aligner(path_a, path_b))

        def edge(text, low, high, cut):
            """Ids of a stretch that end in a range, and where both have a cut; ``cut`` starts it."""
            lists, ends = [], []
            for ids, t in zip(aligner.ids(text), (aligner.bytes_a, aligner.bytes_b), strict=True):
                ids = np.array(ids, dtype=np.int64)
                end = np.cumsum([len(t[i]) for i in ids.tolist()])
                kept = (end > low) & (end <= high)
                lists.append(ids[kept].tolist())
                ends.append(end[kept])
            _, *places = np.intersect1d(*ends, assume_unique=True, return_indices=True)
            cuts = [([0] if cut else []) + (x + 1).tolist() for x in places]
            return lists, cuts

        def between(lists, cuts):
            """Text and codes of the groups between the cuts of an edge."""
            (a, b), (x, y) = lists, cuts
            groups = [group_text(a[i:k], b[j:m]) for i, k, j, m in zip(x, x[1:], y, y[1:], strict=False)]
            codes = [(a[k - 1] << SHIFT) | b[m - 1] for k, m in zip(x[1:], y[1:], strict=False)]
            return groups, codes

        def fragment(body, low, high):
            texts = stretches(body)
            size = len(body.encode())
            first = texts.pop(0) if low else None
            last = texts.pop() if high < size and texts else None
            numbers = np.array(list(map(aligner.__getitem__, texts)), dtype=np.int64)
            if len(aligner) > REMEMBERED:
                aligner.forget()
                numbers = np.array(list(map(aligner.__getitem__, texts)), dtype=np.int64)
            aligner.learn()
            inner = aligner.of(numbers)
            edges = [whole(x) for x in (first, last) if x is not None]
            if inner is None or not all(aligner.gives_back(x, *aligner.ids(x)) for x in edges):
                return [False, True, [], [], [], [], 0, 0, 0, b"", b""]
            n_a, n_b, text, codes = inner
            groups, codes = [text] if text else [], [codes]
            prefix = suffix = ([], [])
            cut = low == 0
            if first is not None:
                lists, cuts = edge(whole(first), low, high, False)
                n_a, n_b = n_a + len(lists[0]), n_b + len(lists[1])
                cut = bool(cuts[0])
                ahead, ahead_codes = between(lists, cuts)
                groups, codes = ahead + groups, [ahead_codes, *codes]
                prefix = [x[: c[0]] if cut else x for x, c in zip(lists, cuts, strict=True)]
                if cut:
                    suffix = [x[c[-1] :] for x, c in zip(lists, cuts, strict=True)]
            if last is not None:
                # All before is stretches as a whole, so the last one starts at a cut.
                start = size - len(whole(last).encode())
                lists, cuts = edge(whole(last), -1, high - start, True)
                n_a, n_b = n_a + len(lists[0]), n_b + len(lists[1])
                behind, behind_codes = between(lists, cuts)
                groups, codes, cut = groups + behind, [*codes, behind_codes], True
                suffix = [x[c[-1] :] for x, c in zip(lists, cuts, strict=True)]
            flat = np.concatenate([np.asarray(c, dtype="<i8") for c in codes])
            listed = ";".join(groups).encode()
            return [True, cut, *prefix, *suffix, n_a, n_b, len(flat), listed, flat.tobytes()]

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                keys = [part.column(c) for c in ("row", "doc_id", "chunk", "chunks")]
                ranges = (part.column(c).to_pylist() for c in ("body", "low", "high"))
                made = [fragment(*x) for x in zip(*ranges, strict=True)]
                types = schema.types[len(keys) :]
                arrays = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([*keys, *arrays], schema=schema)

    schema = arrow_schema(FRAGMENTS)
    columns = ("row", "doc_id", "chunk", "chunks", "body", "low", "high")
    return chunks.select(*columns).repartition("row", "chunk").mapInArrow(run, FRAGMENTS)


def joints(found: DataFrame, most_chunks: int, arity: int = ARITY) -> DataFrame:
    """``JOINTS``: the groups that close between fragments, at the chunk that closes them.

    Neighbours are put together ``arity`` at a time until one fragment of each text is
    left, so no task gets more than that of one text at once, however long it is.
    """

    def compose(_, table):
        import pyarrow as pa

        total, rows = None, []
        for r in sorted(table.to_pylist(), key=lambda r: r["chunk"]):
            new = Fragment(*(r[c] for c in Fragment.__slots__))
            if total is None:
                total, first = new, (r["row"], r["chunk"])
                continue
            total, group = total.then(new)
            if group:
                rows.append((r["row"], r["chunk"], *group, *[None] * 5))
        rows.append((*first, None, None, *(getattr(total, c) for c in Fragment.__slots__)))
        arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)]
        return pa.Table.from_arrays(arrays, schema=schema)

    schema = arrow_schema(JOINTS)
    level = found.select("row", "chunk", *Fragment.__slots__)
    closed, span = [], 1
    while span < most_chunks:
        span *= arity
        part = F.floor(F.col("chunk") / span)
        done = level.withColumn("part", part).groupBy("row", "part").applyInArrow(compose, JOINTS)
        done = materialize(done, "joints")
        closed.append(done.where("a is not null").select("row", "chunk", "a", "b"))
        level = done.where("a is null").select(level.columns)
    return reduce(DataFrame.unionByName, closed)


def sealed(found: DataFrame, glue: DataFrame, block_links: int) -> DataFrame:
    """``STAGED`` rows of the texts whose fragments ``found`` are all good.

    The parts of a text come to one task in order, chunk after chunk, and leave it as
    blocks of links; the last row of a text is its ``DOCUMENT``.
    """

    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() + LATE << 33
        waiting: list[tuple] = []
        n_waiting = 0
        now = state = sums = None

        def batch_of(rows, names):
            return sparse_batch(rows, names, schema)

        def ended():
            yield batch_of(
                [(DOCUMENT, *now, *sums, state.hexdigest())],
                ("kind", "row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256"),
            )

        def flush():
            nonlocal block, n_waiting
            if waiting:
                rows = [(LINKS, row, None, None, None, None, None, block, None) for row, _ in waiting]
                yield from block_rows([codes for _, codes in waiting], rows, block, batch_of)
                waiting.clear()
                n_waiting = 0
                block += 1

        names = ("row", "doc_id", "n_a", "n_b", "n_groups", "text", "codes", "a", "b")
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in names)
            for row, doc_id, n_a, n_b, n_groups, text, codes, a, b in zip(*columns, strict=True):
                if a is not None:
                    text = group_text(a, b).encode()
                    codes = np.array([(a[-1] << SHIFT) | b[-1]], dtype="<i8")
                else:
                    codes = np.frombuffer(codes, dtype="<i8")
                if now is None or row != now[0]:
                    if now is not None:
                        yield from ended()
                    now, state, sums = (row, doc_id), hashlib.sha256(), [0, 0, 0]
                    comma = b""
                if len(codes):
                    state.update(comma + text)
                    comma = b";"
                    waiting.append((row, codes))
                    n_waiting += len(codes)
                for i, n in enumerate((n_a or 0, n_b or 0, len(codes))):
                    sums[i] += n
                if n_waiting >= block_links:
                    yield from flush()
        if now is not None:
            yield from ended()
        yield from flush()

    schema = arrow_schema(STAGED)
    # A group that closes at a chunk comes before the chunk's own.
    columns = ("row", "chunk", "doc_id", "n_a", "n_b", "n_groups", "text", "codes")
    parts = found.select(*columns, F.lit(1).alias("after")).unionByName(
        glue.withColumn("after", F.lit(0)), allowMissingColumns=True
    )
    parts = parts.repartition("row").sortWithinPartitions("row", "chunk", "after")
    return parts.drop("chunk", "after").mapInArrow(run, STAGED)


def with_totals(pairs: DataFrame) -> DataFrame:
    """``(of_block, pair, count, best)``: a pair's number in the corpus, and whether no pair of its
    second id has more."""
    totals = pairs.groupBy("pair").agg(F.sum("n").alias("count"))
    of_second = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1)))
    totals = totals.withColumn("best", F.col("count") == F.max("count").over(of_second))
    return pairs.select(F.col("block").alias("of_block"), "pair").join(totals, "pair")


def looked_up(carriers: DataFrame, known: DataFrame) -> DataFrame:
    """``carriers`` with ``n_best`` and ``count_sum`` of their links, block by block."""

    def look(rows, pairs):
        import numpy as np
        import pyarrow as pa

        pairs = pairs.sort_by("pair")
        counts = pairs["count"].to_numpy()
        best = pairs["best"].to_numpy(zero_copy_only=False).astype(np.int64)
        n_best, count_sum = [], []
        for links in rows["links"].to_pylist():
            place = np.frombuffer(links, dtype="<u4")
            n_best.append(int(best[place].sum()))
            count_sum.append(int(counts[place].sum()))
        kept = rows.select([f.name for f in schema][:-2])
        arrays = [*(c.cast(f.type) for c, f in zip(kept.columns, schema, strict=False))]
        return pa.table([*arrays, pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())], schema=schema)

    layout = "kind int, row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, n_best long, count_sum long"
    schema = arrow_schema(layout)
    columns = [f.name for f in schema][:-2]
    left = carriers.select("block", "links", *columns).groupBy("block")
    return left.cogroup(known.groupBy("of_block")).applyInArrow(look, layout)


def aligned(
    docs: DataFrame,
    path_a: str = TOKENIZER_A,
    path_b: str = TOKENIZER_B,
    chunk_chars: int = CHUNK_CHARS,
    block_links: int = BLOCK_LINKS,
) -> DataFrame:
    """Per row of ``docs``: its tokens in both tokenizers, groups, and how common its links are.

    ``doc_id, n_a, n_b, n_groups, groups_sha256, n_links, n_best, count_sum``. A is a
    byte-level vocabulary and reads a blank and the text; B is a piece vocabulary that adds
    the blank itself. Names of special tokens in a text are plain text. A link is a token of
    A and one of B that end together; its count is that of its pair of ids over all rows; it
    is best if no pair of its B id has a higher one. A NULL or empty text has no tokens, nor
    has one that either tokenizer does not give back byte by byte, as one with U+2581.
    Repeated rows count each; an empty table gives none; further columns are ignored.
    A stretch without a blank or line end is the unit that one task tokenises.
    """
    written = _packed(staged(docs, path_a, path_b, chunk_chars, block_links), "aligned")
    of = {k: written.where(F.col("kind") == k) for k in (DOCUMENT, PAIRS, CHUNK)}
    carriers, pairs = of[DOCUMENT], of[PAIRS]
    most_chunks = of[CHUNK].agg(F.max("chunks")).first()[0]
    if most_chunks:
        found = _packed(fragments(of[CHUNK], path_a, path_b), "fragments")
        bad = materialize(found.where("not good").select("row", "doc_id").distinct(), "not-given-back")
        good = found.join(bad.select("row"), "row", "left_anti")
        late = _packed(sealed(good, joints(good, most_chunks), block_links), "long-texts")
        carriers = carriers.unionByName(late.where(F.col("kind") == LINKS))
        pairs = pairs.unionByName(late.where(F.col("kind") == PAIRS))
    looked = looked_up(carriers, with_totals(pairs))
    if most_chunks:
        looked = materialize(looked, "looked-up")
        sums = looked.where(F.col("kind") == LINKS).groupBy("row").agg(
            F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
        )
        long = late.where(F.col("kind") == DOCUMENT).drop("n_best", "count_sum").join(sums, "row", "left")
        zeros = {c: F.lit(0) for c in ("n_a", "n_b", "n_groups", "n_best", "count_sum")}
        none = bad.select("doc_id", *[v.cast("long").alias(c) for c, v in zeros.items()], F.lit("").alias("groups_sha256"))
        looked = looked.where(F.col("kind") == DOCUMENT).select(none.columns)
        looked = looked.unionByName(long.select(none.columns)).unionByName(none)
    return looked.select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256"
    )


def _packed(df: DataFrame, label: str) -> DataFrame:
    """As ``materialize``, packed more tightly: most of it are small numbers in four bytes."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def op11(spark, sf_dir: str) -> DataFrame:
    return aligned(documents(spark, sf_dir))
