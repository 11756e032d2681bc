"""Repeated byte strings across all texts, by column-wise construction of a collection BWT.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else.

1. Anchors. Of the ``GRAM``-byte grams of every ``length``-byte string the one of least
   hash, the leftmost of equals, is its anchor: equal strings have equal anchors at
   equal offsets. Only strings whose anchor gram occurs twice or more can repeat.
2. Rows. All strings with the same anchor place make one row, the bytes from the start
   of the first to the end of the last. Rows of one anchor gram meet in one task and
   are aligned at the anchor, so equal strings start in the same column.
3. Columns. The task inserts one symbol of each row per round, from the last column to
   the first, and updates the order of the suffixes and the common prefixes of
   neighbours; the columns lie in an external file that is read in sequence. A string
   repeats if a common prefix at its column has ``length`` bytes.
4. Cuts. The spans go back to their texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import arrow_schema, documents
from demandloom.session import materialize, scratch_path

LENGTH = 400
GRAM = 64
# Of the pipeline's stage: strings of this length are found, and cut where they make up
# a passage of more words than this.
PASSAGE_BYTES = 200
PASSAGE_GRAM = 32
PASSAGE_WORDS = 50
# Rows that one run of rounds takes; the rows of one anchor gram are never parted.
GROUP_ROWS = 30_000
# Bytes whose anchors are computed together.
CHUNK = 1 << 19
# Distinct rows whose repeats a task counts before it sends them on.
HELD_ROWS = 20_000
# Rows of one key that a task may get; beyond, the key is made longer.
HOT_ROWS = 2000
PAD = 0xFF  # no byte of UTF-8


def gram_hashes(data, gram: int = GRAM):
    """A 64-bit hash of every ``gram`` bytes, by wrapping prefix sums of a polynomial."""
    import numpy as np

    base, inverse = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
    n = len(data)

    def powers(b):
        line = np.full(n + 1, b, dtype=np.uint64)
        line[0] = 1
        return np.cumprod(line, dtype=np.uint64)

    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + 1) * powers(base)[:n], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * powers(inverse)[: n - gram + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def sliding_min(values, width: int):
    """Minimum of every ``width`` neighbours: running minima of blocks, from both ends."""
    import numpy as np

    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[:n] = values
    rows = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    last = n - width + 1
    return np.minimum(back[:last], ahead[width - 1 : width - 1 + last])


def anchors(data, bounds, length: int = LENGTH, gram: int = GRAM):
    """Anchors in texts that lie end to end in ``data``; text ``i`` up to ``bounds[i + 1]``.

    Arrays: text, anchor place, first and last start of the strings it stands for, and
    the gram's hash; places count from the start of ``data``.
    """
    import numpy as np

    found = [np.empty(0, dtype=np.int64)] * 4 + [np.empty(0, dtype=np.uint64)]
    parts = [found]
    for at in range(0, max(len(data) - length + 1, 0), CHUNK):
        piece = data[at : at + CHUNK + length - 1]
        h = gram_hashes(piece, gram)
        place_bits = np.uint64(24)
        ranked = (h >> place_bits << place_bits) | np.arange(len(h), dtype=np.uint64)
        least = sliding_min(ranked, length - gram + 1) & np.uint64((1 << 24) - 1)
        least = least.astype(np.int64)
        starts = np.arange(len(least), dtype=np.int64) + at
        text = np.searchsorted(bounds, starts, "right") - 1
        inside = starts + length <= bounds[text + 1]
        starts, text, least = starts[inside], text[inside], least[inside]
        if not len(starts):
            continue
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(starts)) - 1
        parts.append([text[first], least[first] + at, starts[first], starts[last], h[least[first]]])
    return [np.concatenate(column) for column in zip(*parts, strict=True)]


def texts_of(batch, column: str):
    """All bytes of a binary column end to end, and where each text starts and the last ends."""
    import numpy as np
    import pyarrow as pa

    texts = batch.column(column).fill_null(b"").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body else np.empty(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]] if len(texts) else data, offsets - offsets[0]


def repeated_columns(rows: list[bytes], offsets: list[int], length: int = LENGTH):
    """``(row, first, last)``: starts in a row at which a string of ``length`` bytes repeats.

    ``rows`` are aligned at their ``offsets``; strings are compared with those of other
    rows in the same column. ``order`` lists the rows by their suffix from the current
    column, ``differ[i]`` is the column where the suffixes of rows ``order[i - 1]`` and
    ``order[i]`` part. Inserting the symbols of the column before sorts the order by
    symbol, stably; rows that become neighbours part where the first two of all rows
    between them did. Each row is its own document: nothing matches its padding.
    """
    import tempfile

    import numpy as np

    n = len(rows)
    offsets = np.asarray(offsets, dtype=np.int64)
    sizes = np.fromiter(map(len, rows), dtype=np.int64, count=n)
    shift = int(offsets.max())
    begins = shift - offsets
    width = int((begins + sizes).max())
    lasts = begins + sizes - length
    ranges: list[tuple] = []
    with tempfile.TemporaryFile() as columns:
        for at in range(0, n, 4096):
            part = rows[at : at + 4096]
            block = np.full((len(part), width), PAD, dtype=np.uint8)
            for i, row in enumerate(part):
                begin = begins[at + i]
                block[i, begin : begin + len(row)] = np.frombuffer(row, dtype=np.uint8)
            for c, line in enumerate(np.ascontiguousarray(block.T)):
                columns.seek(c * n + at)
                columns.write(line.tobytes())
        order = np.arange(n)
        differ = np.full(n, width, dtype=np.int32)
        was = np.zeros(n, dtype=bool)
        ends = np.zeros(n, dtype=np.int64)
        for c in range(width - 1, -1, -1):
            columns.seek(c * n)
            symbols = np.frombuffer(columns.read(n), dtype=np.uint8)[order]
            moved = np.argsort(symbols, kind="stable")
            symbols, order = symbols[moved], order[moved]
            together = np.flatnonzero(symbols[1:] == symbols[:-1]) + 1
            parted = np.full(n, c, dtype=np.int32)
            parted[together] = range_minima(differ, moved[together - 1] + 1, moved[together])
            differ = parted
            pairs = np.flatnonzero(differ[1:] >= c + length) + 1
            now = np.zeros(n, dtype=bool)
            now[order[pairs]] = True
            now[order[pairs - 1]] = True
            now &= (begins <= c) & (c <= lasts)
            turned = np.flatnonzero(now != was)
            if len(turned):
                opened = turned[now[turned]]
                ends[opened] = c
                closed = turned[was[turned]]
                ranges.append((closed, np.full(len(closed), c + 1), ends[closed]))
                was = now
        left = np.flatnonzero(was)
        ranges.append((left, np.zeros(len(left), dtype=np.int64), ends[left]))
    row, first, last = (np.concatenate(x) for x in zip(*ranges, strict=True))
    return row, first - begins[row], last - begins[row]


def range_minima(values, first, last):
    """``min(values[first[i] : last[i] + 1])`` for each ``i``, by minima of powers of two."""
    import numpy as np

    found = values[last]
    wide = np.flatnonzero(last > first)
    if not len(wide):
        return found
    low, high = first[wide], last[wide]
    level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    table, span = values, 1
    for k in range(int(level.max()) + 1):
        if k:
            table = np.minimum(table[:-span], table[span:])
            span *= 2
        mine = np.flatnonzero(level == k)
        if len(mine):
            found[wide[mine]] = np.minimum(table[low[mine]], table[high[mine] - span + 1])
    return found


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` as packed rows with their bytes and a 128-bit key of id and text.

    Rows equal in both share the key, and share the result.
    """
    text = F.coalesce(F.col("_row.text"), F.lit(""))
    packed = docs.select(F.struct("*").alias("_row"))
    return packed.select(
        "_row",
        text.cast("binary").alias("_bytes"),
        F.xxhash64(F.lit(1), "_row.doc_id", text).alias("_a"),
        F.xxhash64(F.lit(2), text, "_row.doc_id").alias("_b"),
    )


def anchor_grams(texts: DataFrame, length: int, width: int) -> DataFrame:
    """``(_a, _b, gram, places)`` for each different anchor gram of each text."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            data, bounds = texts_of(batch, "_bytes")
            text, _, _, _, gram = anchors(data, bounds, length, width)
            order = np.lexsort((gram, text))
            text, gram = text[order], gram[order]
            new = np.ones(len(text), dtype=bool)
            new[1:] = (text[1:] != text[:-1]) | (gram[1:] != gram[:-1])
            first = np.flatnonzero(new)
            owner = pa.array(text[first])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_a").take(owner),
                    batch.column("_b").take(owner),
                    pa.array(gram[first].view("int64")),
                    pa.array(np.diff(first, append=len(text))),
                ],
                schema=schema,
            )

    layout = "_a long, _b long, gram long, places long"
    schema = arrow_schema(layout)
    return texts.select("_a", "_b", "_bytes").mapInArrow(run, layout)


ROWS = (
    "gram long, low int, high int, d1 long, d2 long, offset int, bytes binary, copies long, "
    "_a long, _b long, start long"
)


class Lines:
    """Output of a task that finds rows: a line per place, and one per distinct row.

    However often a row occurs, a task sends its bytes once, with the number of copies.
    """

    def __init__(self, schema):
        self.schema = schema
        self.held: dict[bytes, list] = {}

    def hold(self, body: bytes, copies: int, *rest) -> bytes:
        import xxhash

        digest = xxhash.xxh3_128_digest(body)
        if digest in self.held:
            self.held[digest][-1] += copies
        else:
            self.held[digest] = [*rest, body, copies]
        return digest

    def places(self, digests: list[bytes], owners, starts):
        import numpy as np
        import pyarrow as pa

        if digests:
            d = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            none = [pa.nulls(len(d), t) for t in self.schema.types[:8]]
            none[3:5] = pa.array(d[:, 0]), pa.array(d[:, 1])
            owned = [pa.array(x, pa.int64()) for x in (*owners, starts)]
            yield pa.RecordBatch.from_arrays([*none, *owned], schema=self.schema)

    def release(self, most: int = 0):
        import numpy as np
        import pyarrow as pa

        if len(self.held) > most:
            d = np.frombuffer(b"".join(self.held), dtype="<i8").reshape(-1, 2)
            gram, low, high, offset, body, copies = zip(*self.held.values(), strict=True)
            columns = [gram, low, high, d[:, 0], d[:, 1], offset, body, copies]
            types = self.schema.types
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=False)]
            arrays += [pa.nulls(len(d), t) for t in types[8:]]
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)
            self.held.clear()


def rows_of(texts: DataFrame, length: int, width: int) -> DataFrame:
    """Rows at the anchors whose gram is in ``grams`` of its text, as ``ROWS``.

    A line per place: the row's digest ``d1, d2``, the text ``_a, _b`` and the first start.
    A line per distinct row: its key ``gram``, the starts ``low`` to ``high`` it may have as
    seen from the anchor, which lies at ``offset``, its bytes and copies.
    """

    def run(batches):
        import numpy as np

        lines = Lines(schema)
        for batch in batches:
            data, bounds = texts_of(batch, "_bytes")
            text, place, first, last, gram = anchors(data, bounds, length, width)
            gram = gram.view("int64")
            known = batch.column("grams")
            wanted = np.zeros(len(gram), dtype=bool)
            edges = np.searchsorted(text, np.arange(len(known) + 1))
            for i, grams in enumerate(known):
                mine = slice(edges[i], edges[i + 1])
                wanted[mine] = np.isin(gram[mine], grams.values.to_numpy())
            chosen = np.flatnonzero(wanted)
            raw = memoryview(data)
            digests = [
                lines.hold(
                    bytes(raw[first[i] : last[i] + length]),
                    1,
                    int(gram[i]),
                    width - length,
                    0,
                    int(place[i] - first[i]),
                )
                for i in chosen
            ]
            owner = text[chosen]
            keys = (batch.column(c).to_numpy()[owner] for c in ("_a", "_b"))
            yield from lines.places(digests, keys, first[chosen] - bounds[owner])
            yield from lines.release(HELD_ROWS)
        yield from lines.release()

    schema = arrow_schema(ROWS)
    return texts.select("_a", "_b", "_bytes", "grams").mapInArrow(run, ROWS)


def halves(rows: DataFrame, length: int, width: int) -> DataFrame:
    """Each distinct row as two, in the form of ``rows_of``: its early and its late starts.

    All strings of a half share more bytes than those of the row, from the last start to
    ``length`` beyond the first, as counted from the anchor: they are its new key. Equal
    strings start in the same half, and share that key. The place of a half is the
    digest of its row and the start in it.
    """

    def run(batches):
        import xxhash

        lines = Lines(schema)
        for batch in batches:
            digests, starts, owner = [], [], []
            columns = [batch.column(c).to_pylist() for c in ("low", "high", "offset", "bytes", "copies")]
            for i, (low, high, offset, body, copies) in enumerate(zip(*columns, strict=True)):
                middle = (low + high) // 2
                for begin, end in ((low, middle), (middle + 1, high)):
                    first = max(begin, -offset)
                    last = min(end, len(body) - length - offset)
                    if first > last:
                        continue
                    shared = body[end + offset : begin + length + offset]
                    key = xxhash.xxh64_intdigest(shared, seed=end - width + length)
                    key -= (key >> 63) << 64
                    part = body[first + offset : last + length + offset]
                    digests.append(lines.hold(part, copies, key, begin, end, -first))
                    starts.append(first + offset)
                    owner.append(i)
            keys = (batch.column(c).to_numpy()[owner] for c in ("d1", "d2"))
            yield from lines.places(digests, keys, starts)
            yield from lines.release(HELD_ROWS)
        yield from lines.release()

    schema = arrow_schema(ROWS)
    columns = ("low", "high", "d1", "d2", "offset", "bytes", "copies")
    return rows.select(*columns).mapInArrow(run, ROWS)


def settled(rows: DataFrame, length: int) -> DataFrame:
    """``(d1, d2, first, last)``: starts in a distinct row at which its strings repeat.

    A row that occurs twice repeats as a whole, but still meets the others.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        group: dict[bytes, list] = {}

        def settle():
            if not group:
                return
            bodies = [g[1] for g in group.values()]
            row, first, last = repeated_columns(bodies, [g[0] for g in group.values()], length)
            twice = np.array([i for i, g in enumerate(group.values()) if g[2] > 1], dtype=np.int64)
            once = ~np.isin(row, twice)
            sizes = np.fromiter(map(len, bodies), dtype=np.int64, count=len(bodies))
            row = np.concatenate([row[once], twice])
            first = np.concatenate([first[once], np.zeros(len(twice), dtype=np.int64)])
            last = np.concatenate([last[once], sizes[twice] - length])
            d = np.frombuffer(b"".join(group), dtype="<i8").reshape(-1, 2)[row]
            group.clear()
            yield pa.RecordBatch.from_arrays(
                [pa.array(d[:, 0]), pa.array(d[:, 1]), pa.array(first), pa.array(last)],
                schema=schema,
            )

        latest = None
        for batch in batches:
            digests = np.stack([batch.column("d1").to_numpy(), batch.column("d2").to_numpy()], 1)
            raw = np.ascontiguousarray(digests, dtype="<i8").tobytes()
            columns = (batch.column(c).to_pylist() for c in ("gram", "offset", "bytes", "copies"))
            for i, (gram, offset, body, copies) in enumerate(zip(*columns, strict=True)):
                if gram != latest and len(group) >= GROUP_ROWS:
                    yield from settle()
                latest = gram
                digest = raw[16 * i : 16 * i + 16]
                if digest in group:
                    group[digest][2] += copies
                else:
                    group[digest] = [offset, body, copies]
        yield from settle()

    layout = "d1 long, d2 long, first long, last long"
    schema = arrow_schema(layout)
    columns = ("gram", "d1", "d2", "offset", "bytes", "copies")
    grouped = rows.select(*columns).repartition("gram").sortWithinPartitions("gram")
    return grouped.mapInArrow(run, layout)


def united(repeats: DataFrame) -> DataFrame:
    """Neighbouring and overlapping ranges of starts of a row as one, so that halves of halves
    do not go to each of its places by themselves."""

    def step(done: Column, new: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        longer = F.struct(last["first"].alias("first"), F.greatest(last["last"], new["last"]).alias("last"))
        joined = F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))
        meets = F.coalesce(new["first"] <= last["last"] + 1, F.lit(False))
        return F.when(meets, joined).otherwise(F.concat(done, F.array(new)))

    found = F.array_sort(F.collect_set(F.struct("first", "last")))
    ranges = repeats.groupBy("d1", "d2").agg(found.alias("_found"))
    merged = F.aggregate("_found", F.slice("_found", 1, 0), step)
    return ranges.select("d1", "d2", F.inline(merged))


def placed(rows: DataFrame, length: int, width: int) -> DataFrame:
    """``(_a, _b, first, last)``: repeating starts of the owners of the places in ``rows``.

    The rows of one key meet in one task. Where they are more than ``HOT_ROWS``, as around
    a passage that very many texts have in contexts of their own, they are halved and
    so parted by longer keys, again and again until no key has too many: at the latest
    when a row has one start, since its key is then its whole string.
    """
    lines = rows.where("bytes is not null")
    hot = (
        lines.where("low < high")
        .groupBy("gram")
        .count()
        .where(F.col("count") > HOT_ROWS)
        .select("gram")
    )
    hot = materialize(hot, "hot-keys")
    if hot.isEmpty():
        repeats = settled(lines, length)
    else:
        parts = _write(halves(lines.join(hot, "gram", "left_semi"), length, width), "half-rows")
        parted = placed(parts, length, width).select(
            F.col("_a").alias("d1"), F.col("_b").alias("d2"), "first", "last"
        )
        cold = settled(lines.join(hot, "gram", "left_anti"), length)
        repeats = cold.unionByName(parted)
    places = rows.where("start is not null").select("d1", "d2", "_a", "_b", "start")
    return places.join(united(repeats), ["d1", "d2"]).select(
        "_a",
        "_b",
        (F.col("start") + F.col("first")).alias("first"),
        (F.col("start") + F.col("last")).alias("last"),
    )


def _write(df: DataFrame, label: str) -> DataFrame:
    """As ``materialize``; neighbouring rows overlap, which this codec makes little of."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def repeated_spans(texts: DataFrame, length: int = LENGTH, width: int = GRAM) -> DataFrame:
    """``(_a, _b, spans)``: per text with repeats the byte spans that they cover, not merged."""
    long_enough = texts.where(F.octet_length("_bytes") >= length).select("_a", "_b", "_bytes")
    grams = materialize(anchor_grams(long_enough, length, width), "anchor-grams")
    # Written, so that both sides of the join are exchanges and a hot gram can be split.
    often = materialize(
        grams.groupBy("gram").agg(F.sum("places").alias("n")).where("n > 1").select("gram"),
        "frequent-grams",
    )
    wanted = grams.join(often, "gram").groupBy("_a", "_b").agg(F.collect_set("gram").alias("grams"))
    once = long_enough.join(wanted.hint("shuffle_hash"), ["_a", "_b"])
    rows = _write(rows_of(once, length, width), "anchor-rows")
    spans = placed(rows, length, width).select(
        "_a",
        "_b",
        F.struct(F.col("first").alias("from"), (F.col("last") + length).alias("to")).alias("span"),
    )
    return spans.groupBy("_a", "_b").agg(F.collect_set("span").alias("spans"))


def whole_words(text: bytes, begin: int, end: int) -> tuple[int, int]:
    """The part of a span from its first word on to its last that do not go on outside of it.

    The blanks around stay, so that the words before and after are not joined.
    """
    blanks = b" \t\n\v\f\r"
    if begin and text[begin - 1] not in blanks:
        while begin < end and text[begin] not in blanks:
            begin += 1
    if end < len(text) and text[end] not in blanks:
        while end > begin and text[end - 1] not in blanks:
            end -= 1
    while 0 < begin < end and text[begin] in blanks:
        begin += 1
    while begin < end < len(text) and text[end - 1] in blanks:
        end -= 1
    return begin, end


def cut(data: Column, spans: Column, over_words: int | None = None) -> Column:
    """``(kept, n_removed, n_spans)`` of bytes without the union of their spans.

    With ``over_words`` only of the whole words of those that hold more words.
    """

    def run(texts, covers):
        import pandas as pd

        found = []
        for text, cover in zip(texts, covers, strict=True):
            merged: list[list[int]] = []
            pairs = () if cover is None else cover
            for begin, end in sorted((s["from"], s["to"]) for s in pairs):
                if merged and begin <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                else:
                    merged.append([begin, end])
            if over_words is not None:
                inner = (whole_words(text, begin, end) for begin, end in merged)
                merged = [(b, e) for b, e in inner if len(text[b:e].split()) > over_words]
            kept, at = [], 0
            for begin, end in merged:
                kept.append(text[at:begin])
                at = end
            kept.append(text[at:])
            body = b"".join(kept)
            found.append((body, len(text) - len(body), len(merged)))
        return pd.DataFrame(found, columns=["kept", "n_removed", "n_spans"])

    udf = F.pandas_udf(run, "kept binary, n_removed long, n_spans long")
    return udf.asNondeterministic()(data, spans)


def without_repeats(
    docs: DataFrame, length: int = LENGTH, width: int = GRAM, over_words: int | None = None
) -> DataFrame:
    """Per row of ``docs``: ``_row``, its ``_bytes``, ``kept``, ``n_removed`` and ``n_spans``.

    Texts are UTF-8 bytes, NULL is empty; strings never cross texts and are judged on
    the input. Each of several equal rows has its strings elsewhere, so loses them; so
    do all copies of a text of ``length`` bytes or more. Shorter texts stay. An empty
    table gives none. A row's other columns are carried along. With ``over_words`` only
    stretches of repeated strings that hold more words go, and of those the whole words.
    """
    texts = keyed(docs)
    spans = repeated_spans(texts, length, width)
    joined = texts.join(spans.hint("shuffle_hash"), ["_a", "_b"], "left")
    done = cut(F.col("_bytes"), F.col("spans"), over_words).alias("_cut")
    return joined.select("_row", "_bytes", done).select("_row", "_bytes", "_cut.*")


def op4(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return without_repeats(docs).select(
        F.col("_row.doc_id").alias("doc_id"),
        F.octet_length("_bytes").cast("long").alias("n_bytes"),
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
        # NULL where a cut goes through a character, so that the bytes left are no text.
        F.try_validate_utf8(F.col("kept").cast("string")).alias("text"),
    )


def drop_repeats(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: passages of over ``PASSAGE_WORDS`` words that occur twice go from the
    texts, wherever they are; every document stays.

    Their strings are found at ``PASSAGE_BYTES``, which so many words of prose exceed, but not
    those of one or two letters; neighbouring ones that repeat in different places count
    together. A character of which a cut took some bytes goes as a whole. A NULL text stays
    NULL, and ``n_chars`` follows the text where there is such a column.
    """

    def decoded(kept):
        return kept.map(lambda body: body.decode("utf-8", "ignore"))

    text = F.pandas_udf(decoded, "string")(F.col("kept"))
    new = F.when(F.col("n_removed") > 0, text).otherwise(F.col("_row.text"))
    done = without_repeats(docs, PASSAGE_BYTES, PASSAGE_GRAM, PASSAGE_WORDS).withColumn("_text", new)
    columns = {c.lower(): F.col("_row")[c].alias(c) for c in docs.columns}
    columns["text"] = F.col("_text").alias("text")
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        n_chars = F.when(F.col("n_removed") > 0, F.length("_text")).otherwise(F.col("_row.n_chars"))
        columns["n_chars"] = n_chars.cast(kind).alias("n_chars")
    return done.select(*columns.values())
