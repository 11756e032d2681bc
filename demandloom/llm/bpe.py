"""Byte-level BPE encoding and decoding by recursive queries in DuckDB."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import arrow_schema, documents, per_worker

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
# Bytes of distinct words that one recursive query takes; a longer word goes alone.
QUERY_BYTES = 400_000
# Words up to this size take one contraction a round, longer ones all of a pair.
SHORT = 64
# Distinct stretches of text whose ids a Python worker remembers: about 200 MB.
REMEMBERED = 800_000
MEMORY = "300MB"

# ``tokens(word, s, id)``: one row per byte, ``s`` unique, with a gap between words.
# ``merges(pair, merged, size)``: pair is left id * 65536 + right id, size the bytes of
# the merged token, whose id is its rank. A word without a pair leaves the recursion.
#
# A round contracts in each word the pair of least rank, the leftmost of equals: the
# least of ``rank, size, s`` in one number.
CONTRACT_ONE = """
WITH RECURSIVE step(word, s, e, id, live) AS (
  SELECT word, s, s + 1, id, true FROM tokens
  UNION ALL (
    WITH act AS (SELECT * FROM step WHERE live),
    best AS (
      SELECT a.word, min(((m.merged::BIGINT * 256 + m.size) << 32) + a.s) AS key
      FROM act a JOIN act b ON a.e = b.s
      JOIN merges m ON m.pair = a.id::BIGINT * 65536 + b.id GROUP BY a.word),
    pick AS (
      SELECT word, (key & 4294967295)::INT AS s, ((key >> 32) & 255)::INT AS size,
        (key >> 40)::INT AS merged
      FROM best)
    SELECT t.word, t.s, CASE WHEN t.s = p.s THEN t.s + p.size ELSE t.e END,
      CASE WHEN t.s = p.s THEN p.merged ELSE t.id END, p.merged IS NOT NULL
    FROM act t LEFT JOIN pick p ON t.word = p.word
    WHERE p.merged IS NULL OR t.s <= p.s OR t.s >= p.s + p.size))
"""

# The same with all places of that pair at once, from the left where they overlap, as
# no contraction makes a pair of lower rank. So a long word takes few rounds.
CONTRACT_ALL = """
WITH RECURSIVE step(word, s, e, id, live) AS (
  SELECT word, s, s + 1, id, true FROM tokens
  UNION ALL (
    WITH act AS (SELECT * FROM step WHERE live),
    pairs AS (
      SELECT a.word, a.s, b.s AS second, b.e, m.merged
      FROM act a JOIN act b ON a.e = b.s
      JOIN merges m ON m.pair = a.id::BIGINT * 65536 + b.id),
    best AS (SELECT word, min(merged) AS merged FROM pairs GROUP BY word),
    found AS (
      SELECT p.*, p.second - p.s AS len, row_number() OVER (PARTITION BY word ORDER BY p.s) AS k
      FROM pairs p JOIN best USING (word, merged)),
    pick AS (
      SELECT * FROM found
      QUALIFY row_number() OVER (PARTITION BY word, s - len * k ORDER BY s) % 2 = 1)
    SELECT t.word, t.s, coalesce(p.e, t.e), coalesce(p.merged, t.id), b.merged IS NOT NULL
    FROM act t LEFT JOIN best b ON t.word = b.word LEFT JOIN pick p ON t.s = p.s
    WHERE NOT EXISTS (SELECT 1 FROM pick q WHERE q.second = t.s)))
"""

ENDED = "SELECT word, s, id FROM step WHERE NOT live ORDER BY s"

# The bytes that the ids of each word stand for, put together in order.
DECODE = """
SELECT word, string_agg(v.bytes, '' ORDER BY s) AS decoded
FROM ids t JOIN vocabulary v ON t.id = v.id GROUP BY word ORDER BY word
"""


class Codec(dict):
    """Stretch of a text to its number ``n``.

    Its ids are ``ids[id_ends[n] : id_ends[n + 1]]``, their bytes likewise in ``body``.
    """

    def __init__(self, path: str, pattern: str):
        import base64
        import tempfile

        import duckdb
        import numpy as np
        import pyarrow as pa
        import regex

        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines)
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.find = regex.compile(pattern).findall
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype="int32")
        merges = [
            (left * 65536 + right, rank, len(token))
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if (left := self.ranks.get(token[:cut])) is not None
            and (right := self.ranks.get(token[cut:])) is not None
        ]
        self.base = duckdb.connect(
            config={"threads": 1, "memory_limit": MEMORY, "temp_directory": tempfile.gettempdir()}
        )
        tables = {
            "merges": dict(zip(("pair", "merged", "size"), zip(*merges, strict=True), strict=True)),
            "vocabulary": {"id": list(self.ranks.values()), "bytes": [t.hex() for t in self.ranks]},
        }
        for name, columns in tables.items():
            self.base.register("given", pa.table({c: pa.array(v) for c, v in columns.items()}))
            self.base.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.base.unregister("given")
        self.forget()

    def forget(self) -> None:
        from array import array

        self.clear()
        self.ids, self.id_ends = array("I"), array("q", [0])
        self.body, self.body_ends = bytearray(), array("q", [0])
        self.fresh: list[str] = []

    def __missing__(self, stretch: str) -> int:
        self[stretch] = number = len(self)
        self.fresh.append(stretch)
        return number

    def learn(self) -> None:
        """Ids and bytes of the stretches numbered since the last call."""
        words: dict[str, int] = {}
        number_of = words.setdefault
        made = [[number_of(w, len(words)) for w in self.find(x)] for x in self.fresh]
        self.fresh = []
        ids: list = [None] * len(words)
        bodies: list[bytes] = [b""] * len(words)
        numbered = [(number, text.encode()) for text, number in words.items()]
        for contract, fits in (
            (CONTRACT_ONE, lambda word: len(word) <= SHORT),
            (CONTRACT_ALL, lambda word: len(word) > SHORT),
        ):
            part, size = [], 0
            for number, word in numbered:
                if not fits(word):
                    continue
                if part and size + len(word) > QUERY_BYTES:
                    self._encode(part, contract, ids, bodies)
                    part, size = [], 0
                part.append((number, word))
                size += len(word)
            self._encode(part, contract, ids, bodies)
        for numbers in made:
            for n in numbers:
                self.ids.extend(ids[n])
                self.body += bodies[n]
            self.id_ends.append(len(self.ids))
            self.body_ends.append(len(self.body))

    def _encode(self, part: list[tuple[int, bytes]], contract: str, ids: list, bodies: list):
        import numpy as np
        import pyarrow as pa

        if not part:
            return
        # A word that is a token as a whole is that token, as the library has it.
        start = [self.ranks.get(word) for _, word in part]
        raw = b"".join(w if s is None else b"\0" for (_, w), s in zip(part, start, strict=True))
        sizes = np.array([len(w) if s is None else 1 for (_, w), s in zip(part, start, strict=True)])
        whole = np.array([-1 if s is None else s for s in start], dtype="int32")
        token = self.byte_ids[np.frombuffer(raw, dtype=np.uint8)]
        first = np.cumsum(sizes) - sizes
        token[first[whole >= 0]] = whole[whole >= 0]
        word = np.repeat(np.arange(len(part), dtype="int32"), sizes)
        at = np.arange(len(raw), dtype="int32") + word
        self.base.register("tokens", pa.table({"word": word, "s": at, "id": token}))
        found = self.base.sql(contract + ENDED).to_arrow_table()
        self.base.register("ids", found)
        decoded = self.base.sql(DECODE).to_arrow_table()["decoded"].to_pylist()
        for name in ("tokens", "ids"):
            self.base.unregister(name)
        flat = found["id"].to_numpy().tolist()
        ends = np.cumsum(np.bincount(found["word"].to_numpy(), minlength=len(part))).tolist()
        begin = 0
        for (number, _), end, body in zip(part, ends, decoded, strict=True):
            ids[number], bodies[number] = flat[begin:end], bytes.fromhex(body)
            begin = end

    def put_together(self, texts: list[list[int]]):
        """Ids and bytes of texts given as the numbers of their stretches."""
        import numpy as np

        ids = np.array(self.ids, dtype="<u4")
        ends = np.array(self.id_ends, dtype=np.int64)
        body, edges = bytes(self.body), self.body_ends
        for numbers in texts:
            n = np.array(numbers, dtype=np.int64)
            sizes = ends[n + 1] - ends[n]
            after = np.cumsum(sizes)
            at = np.repeat(ends[n + 1] - after, sizes) + np.arange(sizes.sum())
            yield ids[at].tobytes(), b"".join([body[edges[i] : edges[i + 1]] for i in numbers])


def stretches(text: str, find) -> list[str]:
    """Parts of ``text``, in order and without gaps, between which no match reaches.

    Where no two blanks are adjacent, a blank is a match by itself if it is a line end,
    and the first character of a match if it is a space. Other texts are cut into
    their matches.
    """
    import re

    if re.search(r"\s\s", text):
        return find(text)
    found: list[str] = []
    for i, line in enumerate(text.split("\n")):
        if i:
            found.append("\n")
        head, *rest = line.split(" ")
        if head:
            found.append(head)
        found.extend([" " + part for part in rest])
    return found


def encode(docs: DataFrame, ranks: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """``(doc_id, ids, decoded)`` of every whole text, both binary.

    ``ids`` are little-endian unsigned 32-bit integers; ``decoded`` are the bytes they
    stand for. Each match of ``pattern`` is encoded by itself, without special tokens. A
    partition sends its distinct words through the recursive query once; a text is
    then put together from them. A NULL or empty text has no ids; repeated rows repeat.
    """
    schema_text = "doc_id long, ids binary, decoded binary"

    def run(batches):
        import pyarrow as pa

        codec = per_worker(("bpe", ranks, pattern), lambda: Codec(ranks, pattern))
        number_of = codec.__getitem__
        for batch in batches:
            if len(codec) > REMEMBERED:
                codec.forget()
            texts = batch.column("text").to_pylist()
            numbers = [list(map(number_of, stretches(t or "", codec.find))) for t in texts]
            codec.learn()
            ids, decoded = zip(*codec.put_together(numbers), strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())],
                schema=schema,
            )

    schema = arrow_schema(schema_text)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema_text)


def op10(spark, sf_dir: str) -> DataFrame:
    return encode(documents(spark, sf_dir)).select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
