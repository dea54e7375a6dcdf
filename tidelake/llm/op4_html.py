"""Operator 4: main text of web pages by the suffix array of their host, checked by the markup.

Every page of a host takes part with all its blocks, its article's too; nothing is settled before the array:

1. The token streams of whole pages, a mark between blocks, are concatenated by host.  Every position is a suffix,
   held as its first ``DEPTH`` tokens (32 bits of each token's hash).  Suffixes are dealt out by ranges of (host,
   tokens) and sorted, ``BLOCK`` or so to a task, so a host or passage with a third of all pages lies in many tasks.
2. In a task, the common lengths of neighbours cut the array into intervals: the suffixes that share
   their first l tokens.  An interval's distinct pages tell whether that substring repeats.  Intervals
   that touch a task's first or last suffix may go on in the next task: their pages are counted over
   all tasks that hold them.
3. A position's longest repeat is the longest prefix met in at least ``PAGES`` distinct pages and
   ``SHARE`` of the host's.  It is boilerplate if it holds ``RUN`` words or consists of whole blocks (a menu
   of three words).  Repeats longer than ``DEPTH`` are covered by those of the following positions.
   Tokens that nothing covers are kept.
4. The markup checks the result.  Blocks that it sets aside (menus, headers, footers, sidebars, forms, comments,
   adverts) go.  The blocks in an article or main element are the text if they hold as many words as the array
   leaves outside them; then their covered words come back, because articles of a host share sentences.

Most suffixes share their beginning with too few pages and are left out before the sort, exactly: the pages of a
host are dealt into groups of up to ``CHUNK``, and a substring on n of the host's pages is on its share of n, by the
group's size, in at least one group.  So only positions stay whose first tokens reach that share in a group.

So a passage that a few articles of a host share stays, and so do the texts of hosts with fewer than
``PAGES`` distinct pages.  Pages with equal streams count as one, so copies of a page do not make its text boilerplate.

Defined cases: null or empty html gives the empty text; a null url is a host of its own; repeated
rows and null ids are pages of their own; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.common import column, stored, table, texts
from tidelake.llm.html_blocks import blocks_of
from tidelake.llm.words import hash_words, mix

RUN, PAGES, SHARE, SALT = 6, 3, 0.5, 32
DEPTH, SHORTEST, BLOCK = 16, 3, 400_000  # tokens of a suffix; a mark, a word and a mark; suffixes of a task
CHUNK, HELD = 512, 8_000_000  # pages of a group; tokens that a task holds at once
AT_ONCE = 1 << 20  # bytes of text, or codes, that a task turns into arrays at once
END, MARK = 0, 1
MAIN, ASIDE = 1, 2
PARSED = "rid long, page_id long, url string, host string, blocks array<string>, marks binary, open boolean"
GRAMS = "host string, need double, gram long, digest long, codes binary"  # a common beginning, or a page not grouped yet
SUFFIXES = "host string, prefix binary, rid long, at int, digest long, least long, open boolean"
ARRAY = ("task int, rid long, at int, own int, front int, back int, "  # a suffix
         "side int, host string, prefix binary, digest long, least long")  # a page of an interval at a border


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").removeprefix("www.")
    except ValueError:
        return ""


def join_blocks(blocks) -> str:
    return "\n\n".join(blocks)


def spans(sizes: np.ndarray, limit: int):
    """Ranges of up to 500 rows and about ``limit`` in all (a larger row alone)."""
    ends, lo = np.concatenate([[0], np.cumsum(sizes)]), 0
    while lo < len(sizes):
        hi = max(lo + 1, min(lo + 500, int(np.searchsorted(ends, ends[lo] + limit, side="right")) - 1))
        yield lo, hi
        lo = hi


def portions(batch: pa.RecordBatch, name: str):
    """Slices of a batch by the bytes of a column of binary values, or of lists of strings."""
    if not batch.num_rows:
        return
    col = column(batch, name)
    if pa.types.is_list(col.type):
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(col.flatten()).to_numpy(zero_copy_only=False))])
        sizes = np.diff(ends[col.offsets.to_numpy() - col.offsets[0].as_py()])
    else:
        sizes = pc.binary_length(col).to_numpy(zero_copy_only=False)
    for lo, hi in spans(sizes, AT_ONCE):
        yield batch.slice(lo, hi - lo)


def joined_streams(blocks: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Token streams of pages, one after the other, and the end of each: codes of the blocks' words with a mark before
    each block of a page and after its last."""
    words, rows = hash_words(blocks.flatten())
    codes = np.maximum((words >> np.uint64(32)).astype(np.uint32), np.uint32(MARK + 1))
    ends = blocks.offsets.to_numpy() - blocks.offsets[0].as_py()  # in blocks
    some = np.cumsum(np.diff(ends) > 0)  # pages with a block so far, each has a mark more than blocks
    before = np.arange(1, ends[-1] + 1) + np.repeat(some - 1, np.diff(ends))  # marks before a block's words
    out = np.full(len(codes) + ends[-1] + (some[-1] if len(some) else 0), MARK, np.uint32)
    out[np.arange(len(codes)) + np.repeat(before, np.diff(rows))] = codes
    return out, rows[ends[1:]] + ends[1:] + some


def streams(blocks: pa.ListArray | list[list[str]]) -> list[np.ndarray]:
    """Token streams of pages, given as lists of blocks; each has memory of its own."""
    codes, ends = joined_streams(blocks if isinstance(blocks, pa.Array) else pa.array(blocks, pa.list_(pa.string())))
    return [codes[lo:hi].copy() for lo, hi in zip([0, *ends], ends)]


def parsed(pages: DataFrame) -> DataFrame:
    """Pages with all their blocks in order, what the markup says of each (``MAIN``, ``ASIDE``), and whether it says
    nothing of some: only such a page's own repeats can change its text, though all pages count for them."""
    def parse(batches):
        for batch in batches:
            rid, ids, urls = (column(batch, c) for c in ("rid", "page_id", "url"))
            html = texts(batch, "html")
            for lo in range(0, len(html), 500):
                found = [blocks_of(page) for page in html.slice(lo, 500).to_pylist()]
                blocks = [[t for t, _, _ in page] for page in found]
                marks = [bytes(MAIN * main | ASIDE * aside for _, main, aside in page) for page in found]
                hosts = [host_of(u) for u in urls.slice(lo, 500).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [rid.slice(lo, 500), ids.slice(lo, 500), urls.slice(lo, 500), pa.array(hosts, pa.string()),
                     pa.array(blocks, pa.list_(pa.string())), pa.array(marks, pa.binary()), pa.array([0 in m for m in marks], pa.bool_())],
                    names=["rid", "page_id", "url", "host", "blocks", "marks", "open"])

    rows = pages.select(F.monotonically_increasing_id().alias("rid"), F.col("page_id").cast("long"),
                        F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(parse, PARSED)


def beginnings(codes: np.ndarray, run: int, ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A hash of the tokens that any boilerplate from a position begins with, the shortest whole block from a mark and
    ``run`` tokens from a word, and whether the stream has so many there; ``ends`` of joined streams."""
    grams, fits = np.zeros(len(codes), np.uint64), np.zeros(len(codes), bool)
    ends = np.array([len(codes)]) if ends is None else ends
    left = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(len(codes))
    for size, begins in ((SHORTEST, codes == MARK), (max(run, 1), codes != MARK)):
        at = np.flatnonzero(begins & (left >= size))
        gram = np.full(len(at), size, np.uint64)
        for k in range(size):
            gram = mix(gram + codes[at + k])
        grams[at], fits[at] = gram, True
    return grams, fits


def shared_beginnings(codes: list[np.ndarray], run: int, least: int) -> np.ndarray:
    """Beginnings that at least ``least`` of the streams hold."""
    sizes, found, pages = np.array([len(c) for c in codes]), [], []
    for lo, hi in spans(sizes, AT_ONCE // 4):
        grams, fits = beginnings(np.concatenate(codes[lo:hi]), run, np.cumsum(sizes[lo:hi]))
        found.append(grams[fits])
        pages.append(np.repeat(np.arange(lo, hi, dtype=np.int32), sizes[lo:hi])[fits])
    gram, page, least = np.concatenate(found), np.concatenate(pages), max(1, least)
    ordered = np.sort(gram)
    often = np.unique(ordered[least - 1:][ordered[least - 1:] == ordered[:len(ordered) - least + 1]])  # met so often
    if least == 1 or not len(often):
        return often
    at = np.flatnonzero(among(gram, often))
    gram, page = gram[at], page[at]
    order = np.lexsort((page, gram))
    gram, page = gram[order], page[order]
    first = np.concatenate([[True], (gram[1:] != gram[:-1]) | (page[1:] != page[:-1])])  # once a page
    gram, n = np.unique(gram[first], return_counts=True)
    return gram[n >= least]


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each value is one of ``known``, which are in order."""
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def grouped(run: int, last: bool):
    """A task's pages by host in groups of up to ``CHUNK``: the beginnings that ``need`` of a group's pages hold.  A
    group so small that one page is enough is handed on as it is, unless ``last``."""
    def group(batches):
        held, tokens = {}, 0

        def flush(host):
            need, digests, codes = held.pop(host)
            least = int(np.ceil(need * len(digests) - 1e-9))
            if least <= 1 and not last:
                for a in range(0, len(codes), 500):
                    n = len(codes[a:a + 500])
                    yield [host] * n, [need] * n, [None] * n, digests[a:a + 500], [c.tobytes() for c in codes[a:a + 500]]
                return
            gram = shared_beginnings([*dict(zip(digests, codes)).values()], run, least).view(np.int64).tolist()  # of distinct pages
            for a in range(0, len(gram), 20_000):
                n = len(gram[a:a + 20_000])
                yield [host] * n, [need] * n, gram[a:a + 20_000], [None] * n, [None] * n

        def frames(hosts):
            for host in hosts:
                for cols in flush(host):
                    kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                     names=["host", "need", "gram", "digest", "codes"])

        for batch in batches:
            for part in portions(batch, "codes" if last else "blocks"):
                hosts, needs, digests = (column(part, c).to_pylist() for c in ("host", "need", "digest"))
                if last:
                    codes = [np.frombuffer(c, np.uint32) for c in column(part, "codes").to_pylist()]
                else:
                    codes = streams(column(part, "blocks"))
                for host, need, digest, c in zip(hosts, needs, digests, codes):
                    _, ds, cs = held.setdefault(host, (need, [], []))
                    ds.append(digest)
                    cs.append(c)
                    tokens += len(c)
                    if len(ds) >= CHUNK:
                        tokens -= sum(map(len, cs))
                        yield from frames([host])
                if tokens > HELD:
                    yield from frames(list(held))
                    tokens = 0
        yield from frames(list(held))
    return group


def common_beginnings(pages: DataFrame, run: int) -> DataFrame:
    """(host, grams in order): every beginning that ``need`` (a share) of a host's rows among ``pages`` (host, need, digest, blocks)
    may hold, and few others.  Were one on less than that share in every group, it would be on less in all."""
    first = stored(pages.select("host", "need", "digest", "blocks").mapInArrow(grouped(run, False), GRAMS), "page-groups")
    rest = first.where("gram is null")
    salts = rest.groupBy("host").agg(F.ceil(F.count("*") / (4 * CHUNK)).cast("long").alias("salts"))
    rest = (rest.join(salts, "host").withColumn("salt", F.pmod("digest", "salts")).repartition("host", "salt")
            .select("host", "need", "digest", "codes").mapInArrow(grouped(run, True), GRAMS))
    return (first.where("gram is not null").select("host", "gram").union(rest.select("host", "gram"))
            .groupBy("host").agg(F.array_sort(F.collect_set("gram")).alias("grams")))


def binaries(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    data = np.ascontiguousarray(matrix)
    offsets = (np.arange(len(data) + 1) * data.shape[1] * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def suffixes(pages: DataFrame, run: int, depth: int = DEPTH) -> DataFrame:
    """A row for every position of ``pages`` (host, rid, digest, least, open, blocks, grams) that begins with one of ``grams``."""
    def explode(batches):
        for batch in batches:
            for part in portions(batch, "blocks"):
                codes, ends = joined_streams(column(part, "blocks"))
                grams, fits = beginnings(codes, run, ends)
                starts, common, found = np.concatenate([[0], ends[:-1]]), {}, []
                for i, host in enumerate(column(part, "host").to_pylist()):
                    if host not in common:
                        common[host] = column(part, "grams")[i].values.to_numpy(zero_copy_only=False)
                    at = starts[i] + np.flatnonzero(fits[starts[i]:ends[i]])
                    found.append(at[among(grams[at].view(np.int64), common[host])])
                found = np.concatenate(found)
                for a in range(0, len(found), 20_000):
                    at = found[a:a + 20_000]
                    page = np.searchsorted(ends, at, side="right")
                    of = {c: column(part, c).take(pa.array(page)) for c in ("host", "rid", "digest", "least", "open")}
                    window = at[:, None] + np.arange(depth)
                    prefix = np.where(window < ends[page][:, None], codes[np.minimum(window, len(codes) - 1)], np.uint32(END))
                    yield pa.RecordBatch.from_arrays(
                        [of["host"], binaries(prefix), of["rid"], pa.array((at - starts[page]).astype(np.int32)), of["digest"], of["least"],
                         of["open"]], names=["host", "prefix", "rid", "at", "digest", "least", "open"])

    return pages.select("host", "rid", "digest", "least", "open", "blocks", "grams").mapInArrow(explode, SUFFIXES)


def common_lengths(hosts: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Tokens that each suffix shares with the one before it (0 for the first and across hosts)."""
    same = (codes[1:] == codes[:-1]) & (codes[1:] != END) & (hosts[1:] == hosts[:-1])[:, None]
    return np.concatenate([[0], np.where(same.all(axis=1), codes.shape[1], same.argmin(axis=1))])


def intervals(rows: pa.Table, depth: int, task: int):
    """Output of one task of the array: its suffixes of open pages that may lie in a repeat, with the
    longest repeat found here and the longest intervals shared with the first and the last suffix; and
    the distinct pages of the intervals that touch these two."""
    n = len(rows)
    hosts, least = rows["host"].combine_chunks().dictionary_encode().indices.to_numpy(), rows["least"].to_numpy()
    codes = np.frombuffer(b"".join(rows["prefix"].to_pylist()), np.uint32).reshape(n, depth)
    page = np.unique(rows["digest"].to_numpy(), return_inverse=True)[1]
    lcp, size = common_lengths(hosts, codes), (codes != END).sum(axis=1)
    front = np.minimum.accumulate(np.concatenate([size[:1], lcp[1:]]))
    back = np.minimum.accumulate(np.concatenate([lcp[1:], size[-1:]])[::-1])[::-1]
    own = np.zeros(n, np.int32)
    border = {k: [] for k in ("side", "row", "length")}
    for length in range(SHORTEST, depth + 1):
        group = np.cumsum(lcp < length)  # from 1
        pairs = np.unique((group * (n + 1) + page)[size >= length])
        own[(np.bincount(pairs // (n + 1), minlength=group[-1] + 1)[group] >= least) & (size >= length)] = length
        for side, inside in ((0, front >= length), (1, back >= length)):
            at = np.flatnonzero(inside)
            at = at[np.unique(page[at], return_index=True)[1]]
            border["side"].append(np.full(len(at), side, np.int32))
            border["row"].append(at)
            border["length"].append(np.full(len(at), length))
    keep = np.flatnonzero(rows["open"].to_numpy(zero_copy_only=False) & (np.maximum(own, np.maximum(front, back)) >= SHORTEST))
    for a in range(0, len(keep), 20_000):
        at = keep[a:a + 20_000]
        yield frame(task, len(at), rid=rows["rid"].take(at), at=rows["at"].take(at), own=pa.array(own[at]),
                    front=pa.array(front[at].astype(np.int32)), back=pa.array(back[at].astype(np.int32)))
    side, row, length = (np.concatenate(border[k]) for k in ("side", "row", "length"))
    for a in range(0, len(row), 20_000):
        at = row[a:a + 20_000]
        keys = [codes[i, :k].tobytes() for i, k in zip(at, length[a:a + 20_000])]
        yield frame(task, len(at), side=pa.array(side[a:a + 20_000]), host=rows["host"].take(at),
                    prefix=pa.array(keys, pa.binary()), digest=rows["digest"].take(at), least=rows["least"].take(at))


TYPES = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def frame(task: int, n: int, **given) -> pa.RecordBatch:
    """A batch of the ``ARRAY`` columns, null where nothing is given."""
    given["task"] = pa.array(np.full(n, task, np.int32))
    names, kinds = zip(*(c.split() for c in ARRAY.split(", ")))
    cols = [given.get(c, pa.nulls(n, TYPES[k])) for c, k in zip(names, kinds)]
    return pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in cols], names=list(names))


def longest_repeats(pages: DataFrame, run: int = RUN, depth: int = DEPTH, block: int = BLOCK) -> DataFrame:
    """(rid, at, length): the longest repeat at each position of the ``open`` ones of ``pages`` (host, rid, digest, open, blocks, least: the pages
    a repeat is on at least, grams: the beginnings of which any other is on fewer)."""
    placed = stored(suffixes(pages, run, depth), "suffixes")  # counted, sampled for ranges and sorted
    tasks = max(1, -int(-placed.count() // block))
    order = ["host", "prefix", "rid", "at"]
    placed = placed.repartitionByRange(tasks, *order).sortWithinPartitions(*order)

    def build(batches):
        from pyspark import TaskContext

        got = [b for b in batches if b.num_rows]
        if got:
            yield from intervals(pa.Table.from_batches(got), depth, TaskContext.get().partitionId())

    array = stored(placed.mapInArrow(build, ARRAY), "suffix-array")
    border = array.where("side is not null")
    repeated = (border.groupBy("host", "prefix").agg(F.count_distinct("digest").alias("n"), F.max("least").alias("least"))
                .where("n >= least").select("host", "prefix"))
    length = (F.octet_length("prefix") / 4).cast("int")
    tops = (border.select("task", "side", "host", "prefix").distinct().join(repeated, ["host", "prefix"]).groupBy("task")
            .agg(F.max(F.when(F.col("side") == 0, length)).alias("f"), F.max(F.when(F.col("side") == 1, length)).alias("b")))
    found = F.greatest("own", F.least(F.col("front"), F.coalesce("f", F.lit(0))), F.least(F.col("back"), F.coalesce("b", F.lit(0))))
    # a row for each task; what begins a repeat repeats
    return (array.where("side is null").join(F.broadcast(tops), "task", "left")
            .select("rid", "at", found.alias("length")).where(F.col("length") >= SHORTEST))


def checked_text(blocks: list[str], marks: bytes, repeats: list[tuple[int, int]], run: int) -> str:
    """What no boilerplate among ``repeats`` (position, length) covers, each block's other tokens in order, as far as
    the markup (``marks`` of each block) agrees."""
    if not repeats:
        return agreed_text(blocks, marks, blocks)
    words = [b.split() for b in blocks]
    is_mark = np.concatenate([[True], *(np.arange(len(w) + 1) == len(w) for w in words)])
    before = np.cumsum(~is_mark) - ~is_mark  # words before a position
    last = np.maximum.accumulate(np.where(is_mark, np.arange(len(is_mark)), -1))  # mark at or before it
    step = np.zeros(len(is_mark) + 1, np.int64)
    for at, length in repeats:
        end = at + length
        if before[end - 1] + (not is_mark[end - 1]) - before[at] < run:
            end = int(last[end - 1]) if is_mark[at] else at  # whole blocks only
        step[at] += 1
        step[end] -= 1
    gone = np.cumsum(step)[:-1][~is_mark] > 0
    ends = np.cumsum([0, *map(len, words)])
    left = [[x for x, g in zip(w, gone[a:]) if not g] for w, a in zip(words, ends)]
    return agreed_text(blocks, marks, [" ".join(w) for w in left])


def agreed_text(blocks: list[str], marks: bytes, left: list[str]) -> str:
    """The article among the blocks if it has as many words as are ``left`` outside it, else all that is left."""
    article = [b for b, m in zip(blocks, marks) if m == MAIN]
    outside = sum(len(b.split()) for b, m in zip(left, marks) if m == 0)
    if article and (not outside or sum(len(b.split()) for b in article) >= outside):
        return join_blocks(article)
    return join_blocks(b for b, m in zip(left, marks) if b and not m & ASIDE)


def main_text(pages: DataFrame, run: int = RUN, pages_least: int | None = None, share: float = SHARE,
              depth: int = DEPTH, block: int = BLOCK) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.  ``pages_least`` asks for
    that many pages whatever the host's share.  ``run`` words must fit in ``depth`` tokens."""
    rows = stored(parsed(pages), "pages")
    streamed = (rows.where(F.size("blocks") > 0).withColumn("digest", F.xxhash64("blocks"))
                .withColumn("salt", F.pmod("rid", F.lit(SALT)).cast("int")))
    least = F.greatest(F.lit(PAGES), F.ceil(F.col("of") * share)) if pages_least is None else F.lit(pages_least)
    hosts = stored(streamed.groupBy("host").agg(F.count_distinct("digest").alias("of"), F.count("*").alias("n"))
                   .withColumn("least", least.cast("long")).where("of >= least")
                   .select("host", "least", (F.col("least") / F.col("n")).alias("need")), "hosts")

    def salted(known):  # few hosts are joined without shuffling pages
        return known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))

    grams = stored(common_beginnings(streamed.join(salted(hosts), ["host", "salt"]), run), "beginnings")
    arrayed = streamed.join(salted(stored(hosts.join(grams, "host"), "known-hosts")), ["host", "salt"])
    repeats = stored(longest_repeats(arrayed, run, depth, block).groupBy("rid")
                     .agg(F.collect_list(F.struct("at", "length")).alias("repeats")), "repeats")  # at most a page's own positions

    def finish(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                found = [[(r["at"], r["length"]) for r in rs or []] for rs in column(part, "repeats").to_pylist()]
                blocks, marks = column(part, "blocks").to_pylist(), column(part, "marks").to_pylist()
                text = [checked_text(b, m, r, run) for b, m, r in zip(blocks, marks, found)]
                yield pa.RecordBatch.from_arrays([column(part, "page_id"), column(part, "url"), pa.array(text, pa.string())],
                                                 names=["page_id", "url", "text"])

    out = (rows.join(repeats, "rid", "left").select("page_id", "url", "blocks", "marks", "repeats")
           .mapInArrow(finish, "page_id long, url string, text string"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all ``pages``."""
    return main_text(table(spark, sf_dir, "pages"))
