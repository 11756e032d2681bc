"""Main text of web pages; unmarked boilerplate by suffix arrays over the pages of a host."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm.common import arrow_schema, table
from demandloom.llm.markup import read
from demandloom.session import materialize

# Pages of one host that one task compares, on average; the result does not depend on it.
HOST_PAGES = 256
# A run of this many tokens, or more, is boilerplate if so many distinct pages have it.
RUN = 8
LEAST_PAGES, SHARE = 3, 0.2
# A block of a main element has to be on so many distinct pages, and such a share of them,
# to be template: passages that some articles share are content.
MAIN_PAGES, MAIN_SHARE = 10, 0.8
# What a run is counted over, all of one host: distinct texts outside main elements, distinct
# pages by their text outside, and distinct main texts.
PLAIN, AROUND, WITHIN = 0, 1, 2
LIMITS = {
    PLAIN: (LEAST_PAGES, SHARE),
    AROUND: (MAIN_PAGES, MAIN_SHARE),
    WITHIN: (MAIN_PAGES, MAIN_SHARE),
}

TEXT = "page_id long, url string, text string"
# Kinds of ``DEALT`` rows: a text outside main elements, a main text, and the main texts that
# were seen with a text outside.
OUTSIDE, MAIN, PAIRS = 0, 1, 2
DEALT = (
    "host string, deal long, kind int, is_page boolean, page_id long, url string, id binary, "
    "blocks array<string>, dropped array<boolean>, pairs binary"
)
FOUND = "host string, parts int, kind int, run string, n long, untold long"
COUNTED = "host string, parts int, kind int, run string, bound double, n long"


def shared_runs(streams, weights, run=RUN):
    """All different runs of ``run`` tokens in distinct ``streams``, by one place of each.

    Returns the streams end to end, the places, and for each row of ``weights``, one value
    per stream, the sums over the streams that have the run. Each stream is closed by a
    token of its own, and the starts sorted by the ``run`` tokens that follow: a suffix
    array to that depth, by doubling, in which equal runs are neighbours.
    """
    import numpy as np

    number: dict[str, int] = {}
    tokens: list = []
    ids: list[int] = []
    sizes = np.array([len(s) + 1 for s in streams], dtype=np.int64)
    for i, stream in enumerate(streams):
        ids.extend(number.setdefault(t, len(number)) for t in stream)
        ids.append(-1 - i)
        tokens.extend(stream)
        tokens.append(None)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    rank = np.unique(np.array(ids, dtype=np.int64), return_inverse=True)[1]
    depth = 1
    while depth < run:
        step = min(depth, run - depth)
        ahead = np.full(len(rank), -1)
        ahead[:-step] = rank[step:]
        rank = np.unique(rank * (len(rank) + 1) + ahead + 1, return_inverse=True)[1]
        depth += step
    # Starts whose run goes over the end of the stream are none.
    whole = np.arange(len(ids)) + run < np.cumsum(sizes)[owner]
    array = np.argsort(rank, kind="stable")
    array = array[whole[array]]
    rank, pages = rank[array], owner[array]
    # Of one run the starts are sorted by page: a page counts where it is new.
    new_run = np.ones(len(array), dtype=bool)
    new_run[1:] = rank[1:] != rank[:-1]
    new_page = new_run.copy()
    new_page[1:] |= pages[1:] != pages[:-1]
    group = np.cumsum(new_run) - 1
    sums = [np.bincount(group, np.asarray(w)[pages] * new_page) for w in weights]
    return tokens, array[new_run], sums


def by_first(runs) -> dict[str, set[str]]:
    """Runs, their tokens joined by blanks, by their first token."""
    found: dict[str, set[str]] = {}
    for run in runs:
        found.setdefault(run.split(" ", 1)[0], set()).add(run)
    return found


def places(stream, known: dict[str, set[str]], run=RUN):
    """``(start, run)`` of each run in the stream that is known."""
    for i, token in enumerate(stream):
        if token in known:
            found = " ".join(stream[i : i + run])
            if found in known[token]:
                yield i, found


def covered(stream, known: dict[str, set[str]], run=RUN):
    """For each token whether a known run covers it; longer ones consist of these."""
    import numpy as np

    cover = np.zeros(len(stream), dtype=bool)
    for i, _ in places(stream, known, run):
        cover[i : i + run] = True
    return cover


def repeated_tokens(streams: list[list[str]], run=RUN, least=LEAST_PAGES, share=SHARE):
    """For each token of each stream whether it lies in a run that many streams share.

    Equal streams count as one. What ``main_text`` does for a host, where all of its
    streams are at hand.
    """
    distinct = list(dict.fromkeys(map(tuple, streams)))
    tokens, starts, (n,) = shared_runs(distinct, [[1] * len(distinct)], run)
    many = starts[n >= max(least, share * len(distinct))]
    known = by_first(" ".join(tokens[i : i + run]) for i in many)
    return [covered(s, known, run) for s in streams]


def kept_blocks(blocks: list[str], around: dict[str, set[str]], within: dict[str, set[str]]):
    """The blocks of a main element without those that are template of the host.

    A block goes if runs cover all of it that are outside the main elements of many
    pages, or inside those of many. A main element that the latter cover for the
    greater part is a copy of others, not a page in a template: they take nothing
    from it.
    """
    stream = [t for block in blocks for t in block.split()]
    cover, own = covered(stream, around), covered(stream, within)
    if 2 * own.sum() <= len(own):
        cover |= own
    kept, at = [], 0
    for block in blocks:
        n = len(block.split())
        if not cover[at : at + n].all():
            kept.append(block)
        at += n
    return kept


def dealt_parts(pages: DataFrame) -> DataFrame:
    """``DEALT`` rows: one for each page, and what else its host is judged by.

    A page with a main element is that, any other the text outside. The texts outside
    main elements are sent once per task, and with each the ids of the main texts
    around which it was seen. A row that counts has an ``id``, a digest of its text:
    equal ones are dealt to the same part. Copies in a task are dealt in turn, so a
    task that is repeated has to get its rows in the same order, as from files.
    """

    def run(batches):
        import pyarrow as pa
        import xxhash

        def digest(blocks):
            return xxhash.xxh3_128_digest(" ".join(blocks).encode())

        def deal(key):
            return int.from_bytes(key[:8], "little", signed=True)

        def batch_of(rows):
            columns = zip(*rows, strict=True)
            arrays = [pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        around: dict[tuple, set[bytes]] = {}
        mains: set[tuple] = set()
        turn = 0
        for batch in batches:
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "host", "html"))
            for page_id, url, host, source in zip(*columns, strict=True):
                page = read(source or "")
                outside, main = digest(page.outside), digest(page.main)
                new = (host, outside) not in around
                around.setdefault((host, outside), set()).add(main)
                turn += 1
                if page.has_main:
                    first = bool(page.main) and (host, main) not in mains
                    mains.add((host, main))
                    key, to = (main, deal(main)) if first else (None, turn)
                    rows.append((host, to, MAIN, True, page_id, url, key, page.main, None, None))
                    if new:
                        to = deal(outside)
                        rows.append(
                            (host, to, OUTSIDE, False, None, None, outside, page.outside, None, None)
                        )
                else:
                    key, to = (outside, deal(outside)) if new else (None, turn)
                    rows.append(
                        (host, to, OUTSIDE, True, page_id, url, key, page.outside, page.dropped, None)
                    )
            if rows:
                yield batch_of(rows)
        pairs = list(around.items())
        for at in range(0, len(pairs), 1000):
            yield batch_of(
                [
                    (host, deal(key), PAIRS, False, None, None, key, None, None, b"".join(sorted(seen)))
                    for (host, key), seen in pairs[at : at + 1000]
                ]
            )

    schema = arrow_schema(DEALT)
    columns = (F.col("page_id").cast("long"), F.col("url").cast("string"), host_of().alias("host"), "html")
    return pages.select(*columns).mapInArrow(run, DEALT)


def host_of():
    return F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^/?#]*//([^/?#]*)", 1))


def counted_streams(group):
    """What counts in a part: ``(kinds, streams, weights)``, each distinct stream once."""
    import numpy as np

    seen: dict[int, dict[bytes, list[str]]] = {OUTSIDE: {}, MAIN: {}}
    pairs: dict[bytes, list[bytes]] = {}
    columns = (group.column(c).to_pylist() for c in ("kind", "id", "blocks", "pairs"))
    for kind, key, blocks, mains in zip(*columns, strict=True):
        if kind == PAIRS:
            pairs.setdefault(key, []).append(mains)
        elif key is not None and key not in seen[kind]:
            seen[kind][key] = [t for block in blocks for t in block.split()]
    ones = [[1] * len(seen[kind]) for kind in (OUTSIDE, MAIN)]
    pages = [len(np.unique(np.frombuffer(b"".join(pairs[key]), dtype="S16"))) for key in seen[OUTSIDE]]
    return [
        ((PLAIN, AROUND), list(seen[OUTSIDE].values()), (ones[0], pages)),
        ((WITHIN,), list(seen[MAIN].values()), (ones[1],)),
    ]


def part_runs(group):
    """``FOUND`` rows of a part: runs that may be frequent in the host, and for each kind how
    much there is in all, without a run; ``untold`` is the most that other runs can have.

    What is frequent in the host is so in one of its parts at least. In the only
    part of a host the host's own limit holds.
    """
    import math

    import numpy as np

    host, parts = group.column("host")[0].as_py(), group.column("parts")[0].as_py()
    rows = []
    for kinds, streams, weights in counted_streams(group):
        if not streams:
            continue
        totals = [sum(w) for w in weights]
        least = [LIMITS[k][0] if parts == 1 else 1 for k in kinds]
        # A little less than the share, so that rounding loses none.
        given = zip(kinds, totals, least, strict=True)
        floors = [math.ceil(max(n, LIMITS[k][1] * total * (1 - 1e-9))) for k, total, n in given]
        given = zip(kinds, totals, floors, strict=True)
        rows += [(host, parts, k, None, total, floor - 1) for k, total, floor in given]
        if all(total < floor for total, floor in zip(totals, floors, strict=True)):
            continue
        tokens, starts, sums = shared_runs(streams, weights)
        for kind, floor, n in zip(kinds, floors, sums, strict=True):
            for i in np.flatnonzero(n >= floor):
                found = " ".join(tokens[starts[i] : starts[i] + RUN])
                rows.append((host, parts, kind, found, int(n[i]), floor - 1))
    return _table(rows, FOUND)


def recounted(group, asked):
    """``COUNTED`` rows: the runs ``asked`` as counted in this part, or as they are if settled."""
    rows, opened = [], {}
    for row in asked.to_pylist():
        if row["settled"]:
            rows.append([row[c] for c in ("host", "parts", "kind", "run", "bound", "n")])
        else:
            opened.setdefault(row["kind"], {})[row["run"]] = row
    for kinds, streams, weights in counted_streams(group) if opened else ():
        for kind, weight in zip(kinds, weights, strict=True):
            runs = opened.get(kind, {})
            known, n = by_first(runs), dict.fromkeys(runs, 0)
            for stream, w in zip(streams, weight, strict=True) if runs else ():
                for run in {run for _, run in places(stream, known)}:
                    n[run] += w
            rows += [(*(r[c] for c in ("host", "parts", "kind", "run", "bound")), n[r["run"]]) for r in runs.values()]
    return _table(rows, COUNTED)


def page_texts(group, frequent):
    """``TEXT`` rows of the pages in a part, by the frequent runs of its host."""
    runs: dict[int, list[str]] = {kind: [] for kind in LIMITS}
    columns = (frequent.column(c).to_pylist() for c in ("kind", "run"))
    for kind, run in zip(*columns, strict=True):
        runs[kind].append(run)
    known = {kind: by_first(found) for kind, found in runs.items()}
    rows = []
    names = ("is_page", "kind", "page_id", "url", "blocks", "dropped")
    for is_page, kind, page_id, url, blocks, dropped in zip(
        *(group.column(c).to_pylist() for c in names), strict=True
    ):
        if not is_page:
            continue
        if kind == MAIN:
            text = " ".join(kept_blocks(blocks, known[AROUND], known[WITHIN]))
        else:
            cover = covered([t for block in blocks for t in block.split()], known[PLAIN])
            kept, at = [], 0
            for block, drop in zip(blocks, dropped, strict=True):
                tokens = block.split()
                if not drop:
                    kept += [t for t, c in zip(tokens, cover[at:], strict=False) if not c]
                at += len(tokens)
            text = " ".join(kept)
        rows.append((page_id, url, text))
    return _table(rows, TEXT)


def _table(rows, layout: str):
    import pyarrow as pa

    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    fields = [field.split() for field in layout.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    arrays = [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.table(arrays, names=[name for name, _ in fields])


def main_text(pages: DataFrame, host_pages: int = HOST_PAGES) -> DataFrame:
    """``(page_id, url, text)`` for each row of ``pages``.

    A page with an ``article`` or ``main`` element has the text in it as its main text,
    without what is marked as menu, footer, advert, form, comment and the like, and
    without the blocks that are template of the host, see ``kept_blocks``. On a
    page without one, all text not so marked is main text except token runs that
    repeat across pages of the host. The text around main elements is evidence for
    those runs, so every page of the host counts. No host, as of a NULL or odd
    ``url``, is a host too. A NULL or empty page has the empty text; repeated rows
    repeat and count as one page.

    The pages of a host are dealt by hash into parts of about ``host_pages``. A run that
    is frequent in the host is so in some part: a suffix array per part finds those,
    and each that its parts' counts leave open is counted in all of them. So the size
    of a part changes no result.
    """
    counts = materialize(
        pages.select(host_of().alias("host")).groupBy("host").count().where(F.col("count") > host_pages),
        "large-hosts",
    )
    parts = F.coalesce(F.ceil(F.col("count") / host_pages), F.lit(1)).cast("int")
    dealt = dealt_parts(pages).join(counts, "host", "left").withColumn("parts", parts)
    dealt = dealt.withColumn("part", F.pmod("deal", "parts")).drop("count", "deal")
    # Every step takes these rows whole, so that Spark deals them once.
    dealt = dealt.groupBy("host", "part")

    def to_parts(runs, numbers):
        return runs.withColumn("part", F.explode(numbers)).groupBy("host", "part")

    every = F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)
    found = dealt.applyInArrow(part_runs, FOUND).groupBy("host", "parts", "kind", "run")
    found = found.agg(F.sum("n").alias("n"), F.sum("untold").alias("untold"))
    # The runs of a host are dealt to as many groups, what there is in all to each of them.
    own = F.array(F.pmod(F.xxhash64("run"), F.col("parts").cast("long")))
    found = found.withColumn("part", F.explode(F.when(F.col("run").isNull(), every).otherwise(own)))
    beside = Window.partitionBy("host", "kind", "part")

    def in_all(column):
        return F.max(F.when(F.col("run").isNull(), F.col(column))).over(beside)

    bound = F.lit(None)
    for kind, (least, share) in LIMITS.items():
        limit = F.greatest(F.lit(float(least)), F.lit(share) * in_all("n"))
        bound = F.when(F.col("kind") == kind, limit).otherwise(bound)
    # Not settled by the parts that told it: too few there, but not with the most that the
    # others can have.
    many = F.col("n") >= F.col("bound")
    most = F.col("n") + F.col("others") - F.col("untold")
    asked = found.select("*", bound.alias("bound"), in_all("untold").alias("others"))
    asked = asked.where("run is not null").where(most >= F.col("bound"))
    asked = asked.withColumn("settled", many)
    asked = to_parts(asked, F.when(F.col("settled"), F.array("part")).otherwise(every))
    counted = dealt.cogroup(asked).applyInArrow(recounted, COUNTED)
    frequent = counted.groupBy("host", "parts", "kind", "run", "bound").agg(F.sum("n").alias("n"))
    frequent = to_parts(frequent.where(many), every)
    return dealt.cogroup(frequent).applyInArrow(page_texts, TEXT)


def op6(spark, sf_dir: str) -> DataFrame:
    found = main_text(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
