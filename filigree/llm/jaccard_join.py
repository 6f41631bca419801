"""N-gram Jaccard self-join by a token-group matrix.

Documents of one n-gram set are one set with a list of copies.  Sets are
partitioned into groups of similar ones: those whose least n-gram by hash (of the
frequent ones, where these are most of the set) and whose size class agree.
The matrix, kept as postings by n-gram range, has for each group the union of
its members' prefix n-grams; the number that a query shares with the union
bounds its overlap with every member, so only groups that can hold a partner
are opened and compared exactly.

The global order puts the most frequent n-grams last, which keeps passages that
many documents share out of the prefixes.  Any order gives the same result.
N-grams travel packed by range of their hash, and numpy does the work.

Sets are told apart by 64-bit signatures and n-grams compared as 48-bit hashes;
apart from collisions of these the join is exact.  What an opened group finds is
counted and linked in its task, so that no pair is ever a row: a set comes out with
the number of documents that it is linked with and a set that it hangs together with.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.llm.common import stored, text_slices
from filigree.llm.hashing import GRAM_BITS, WORD_RE, batch_ngrams, mix64

N, THRESHOLD = 3, 0.5
#: Prefixes are longer by this share of a set than a match needs, so a single shared n-gram opens few groups.
EXTRA = 0.06
#: N-grams with more postings than this are put last, of the most frequent ones up to HOT_ROWS.
HOT_POSTINGS, HOT_ROWS = 12, 2_000_000
#: Rows up to which a table of ids is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000
#: A set of more than this share of all documents is joined by broadcast, so there are at most as many as its inverse.
HOT_SHARE = 1e-3
_RANGE = 2_000_000  # n-grams of one range, of which about half have postings
_PACK = 800_000  # n-grams that are packed together
_CELLS = 500_000  # postings by groups that are summed at a time
_OPEN = 1_000_000  # n-grams of one side of an exact comparison
_MASK = np.uint64(0xFFFFFFFF)


def _signatures(grams: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set of n-grams; 0 for the empty set."""
    sizes = np.diff(offsets)
    sums = np.add.reduceat(np.append(mix64(grams + np.uint64(0x1234567)), np.uint64(0)), offsets[:-1]) if len(sizes) else np.zeros(0, dtype=np.uint64)
    return np.where(sizes > 0, mix64(sums + sizes.astype(np.uint64)), np.uint64(0)).view(np.int64)


def document_sets(docs: DataFrame, n: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, sig and size of every document that has a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, "text"):
                grams, offsets = batch_ngrams(batch.column("text").to_pylist(), n)
                out = pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_signatures(grams, offsets)), pa.array(np.diff(offsets))], names=["doc_id", "sig", "size"])
                yield out.filter(pa.array(np.diff(offsets) > 0))

    slim = _slim(docs, doc_id, text)
    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, sig long, size long")


def _slim(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null and text <> ''")


def _by_range(tokens: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """The ranges of sorted tokens by their upper bits."""
    upper = (tokens >> np.uint64(GRAM_BITS - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(upper, prepend=-1))
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(tokens)]):
        yield int(upper[a]), slice(a, b)


def _rest(tokens: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits after the range's."""
    return ((tokens >> np.uint64(GRAM_BITS - bits - 32)) & _MASK).astype(np.uint32)


def frequent(slim: DataFrame, n: int, bits: int) -> np.ndarray:
    """Sorted leading bits + 32 bits of the most frequent n-grams; it orders n-grams and decides nothing else."""

    def packed(grams: list[np.ndarray]) -> pa.RecordBatch:
        every = np.sort(np.concatenate(grams))
        rows = [(r, _rest(every[s], bits).tobytes()) for r, s in _by_range(every, bits)]
        return pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.int32()), pa.array([t for _, t in rows], pa.binary())], names=["range", "tokens"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for whole in batches:
            for batch in text_slices(whole, "text"):
                held.append(batch_ngrams(batch.column("text").to_pylist(), n)[0])
                if sum(map(len, held)) > _PACK:
                    yield packed(held)
                    held = []
        if held:
            yield packed(held)

    def reduce(table: pa.Table) -> pa.Table:
        tokens = np.sort(np.concatenate([np.frombuffer(t, dtype=np.uint32) for t in table["tokens"].to_pylist()]))
        at = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
        counts = np.diff(np.append(at, len(tokens)))
        often = counts > HOT_POSTINGS
        high = np.int64(table["range"][0].as_py()) << np.int64(32)
        return pa.table({"token": pa.array(high | tokens[at[often]].astype(np.int64)), "postings": pa.array(counts[often].astype(np.int64))})

    found = stored(slim.select("text").mapInArrow(count, "range int, tokens binary").groupBy("range").applyInArrow(reduce, "token long, postings long"), "jaccard-frequent")
    top = found.orderBy(F.desc("postings"), "token").limit(HOT_ROWS).select("token")  # a bounded hint
    return np.sort(np.array([x for b in top.toArrow().to_batches() for x in b.column(0).to_numpy(zero_copy_only=False)], dtype=np.int64))


def _least(grams: np.ndarray, late: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The n-gram of least hash of each set (sorted): of its frequent ones if these are half of the set at least, else of its others.

    A set that is mostly of frequent n-grams is one of many copies, and these
    n-grams are what the copies share; in others they are passages of unlike
    documents.
    """
    if not len(begin):
        return np.zeros(0, dtype=np.uint64)
    many = 2 * np.add.reduceat(late.astype(np.int64), begin) >= sizes
    good = late == np.repeat(many, sizes)
    return grams[np.minimum.reduceat(np.where(good, np.arange(len(grams)), len(grams)), begin)]


def _short(grams: np.ndarray) -> bytes:
    """The upper 48 bits of n-gram hashes, six bytes each."""
    return (grams >> np.uint64(GRAM_BITS - 48)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _long(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(packed, dtype=np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), dtype=np.uint8)
    out[:, :6] = raw
    return out.reshape(-1).view("<u8")


def _prefixes(texts: list[str], n: int, threshold: float, bits: int, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """(prefix tokens, set index of each, sig, group, size) of the distinct sets of a batch."""
    grams, offsets = batch_ngrams(texts, n)
    sigs, sizes = _signatures(grams, offsets), np.diff(offsets)
    _, first = np.unique(sigs, return_index=True)
    first = first[sizes[first] > 0]
    doc = np.repeat(np.arange(len(texts)), sizes)
    chosen = np.isin(doc, first)
    grams, doc = grams[chosen], doc[chosen]
    lead = (grams >> np.uint64(GRAM_BITS - bits - 32)).astype(np.int64)
    at = np.searchsorted(hot, lead)
    late = (hot[np.minimum(at, len(hot) - 1)] == lead) if len(hot) else np.zeros(len(lead), dtype=bool)
    first_sorted = np.sort(first)
    begin = np.searchsorted(doc, first_sorted)
    home = _least(grams, late, begin, sizes[first_sorted])
    order = np.argsort((doc << 1) | late, kind="stable")  # frequent ones last, else by hash
    grams, doc = grams[order], doc[order]
    place = np.arange(len(doc)) - np.repeat(begin, sizes[first_sorted])
    length = sizes[first_sorted] - np.ceil((threshold - EXTRA) * sizes[first_sorted] - 1e-9).astype(np.int64) + 1
    index = np.repeat(np.arange(len(first_sorted)), sizes[first_sorted])
    keep = place < length[index]
    band = np.floor(np.log2(sizes[first_sorted])).astype(np.uint64)
    group = mix64(home * np.uint64(64) + band).view(np.int64)
    return grams[keep], index[keep], sigs[first_sorted], group, sizes[first_sorted]


def matches(tokens: np.ndarray, sig: np.ndarray, group: np.ndarray, size: np.ndarray, which: np.ndarray, home: np.ndarray, threshold: float) -> dict[str, np.ndarray]:
    """Of one range's postings: how many n-grams each query shares with each group's union.

    Rows of own membership (count 0, own 1) tell the group of each set that is
    at home in this range.  A pair of sets is looked for from the one of smaller sig.
    """
    sigs, where, inverse = np.unique(sig, return_index=True, return_inverse=True)
    groups, group_of = np.unique(group[where], return_inverse=True)
    size_of = size[where].astype(np.int64)
    keys = np.unique((tokens.astype(np.uint64) << np.uint64(32)) | inverse[which].astype(np.uint64))
    token, member = keys >> np.uint64(32), (keys & _MASK).astype(np.int64)
    starts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1]))) if len(token) else np.zeros(0, dtype=np.int64)
    counts = np.diff(np.append(starts, len(token)))
    shared = np.repeat(counts > 1, counts)
    member = member[shared]
    counts = counts[counts > 1]
    run = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((group_of[member], run))
    cell_run, cell_group, cell_member = run[order], group_of[member[order]], member[order]
    cells = np.flatnonzero((np.diff(cell_run, prepend=-1) != 0) | (np.diff(cell_group, prepend=-1) != 0))
    mine = np.unique(inverse[home])
    if not len(cells):
        return _cell_rows(sigs, groups, size_of, group_of, mine, *(np.zeros(0, dtype=np.int64),) * 4)
    low, high = np.minimum.reduceat(size_of[cell_member], cells), np.maximum.reduceat(size_of[cell_member], cells)
    top = np.maximum.reduceat(cell_member, cells)
    run_of_cell = cell_run[cells]
    per_run = np.bincount(run_of_cell, minlength=len(counts))
    first_cell = np.concatenate(([0], np.cumsum(per_run)))[:-1]
    work = np.cumsum(counts * per_run)
    found: list[tuple[np.ndarray, ...]] = []
    waiting, summed = 0, 0
    lo = 0
    begin = np.concatenate(([0], np.cumsum(counts)))
    while lo < len(counts):
        done = work[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(work, done + _CELLS, side="right")))
        m = member[begin[lo] : begin[hi]]
        r = run[begin[lo] : begin[hi]]
        # a run of very many members is cut too
        for a in range(0, len(m), step := max(1, int(_CELLS // max(1, per_run[lo:hi].max())))):
            mm, rr = m[a : a + step], r[a : a + step]
            times = per_run[rr]
            query = np.repeat(mm, times)
            ends = np.cumsum(times)
            cell = np.repeat(first_cell[rr] - (ends - times), times) + np.arange(ends[-1])
            near = (top[cell] > query) & (high[cell] >= threshold * size_of[query] - 1e-9) & (low[cell] * threshold <= size_of[query] + 1e-9)
            query, cell = query[near], cell[near]
            found.append(_summed((query << 32) | cell_group[cells[cell]], np.ones(len(query), dtype=np.int32), low[cell].astype(np.int32), high[cell].astype(np.int32)))
            waiting += len(found[-1][0])
            if waiting > summed + _CELLS:
                found = [_summed(*(np.concatenate(x) for x in zip(*found)))]
                waiting, summed = 0, len(found[0][0])
        lo = hi
    key, count, smallest, largest = _summed(*(np.concatenate(x) for x in zip(*found)))
    return _cell_rows(sigs, groups, size_of, group_of, mine, key, count, smallest, largest)


def _cell_rows(sigs: np.ndarray, groups: np.ndarray, size_of: np.ndarray, group_of: np.ndarray, mine: np.ndarray, key: np.ndarray, count: np.ndarray, low: np.ndarray, high: np.ndarray) -> dict[str, np.ndarray]:
    q, g = key >> 32, key & 0xFFFFFFFF
    return {
        "q": np.concatenate((sigs[q], sigs[mine])),
        "g": np.concatenate((groups[g], groups[group_of[mine]])),
        "shared": np.concatenate((count, np.zeros(len(mine)))).astype(np.int32),
        "low": np.concatenate((low, size_of[mine])).astype(np.int32),
        "high": np.concatenate((high, size_of[mine])).astype(np.int32),
        "size": np.concatenate((size_of[q], size_of[mine])).astype(np.int32),
        "own": np.concatenate((np.zeros(len(q)), np.ones(len(mine)))).astype(np.int8),
    }


def _summed(key: np.ndarray, count: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, dtype=np.int64)
    if not len(at):
        return key, count, low, high
    return key[at], np.add.reduceat(count[order], at), np.minimum.reduceat(low[order], at), np.maximum.reduceat(high[order], at)


def set_links(docs: DataFrame, sets: DataFrame, n: int, threshold: float, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """sig, root and links of the sets that are at least threshold alike with another one, a row for each opened group.

    links counts the documents of the other sets that the group's comparison
    finds alike, each pair of sets once in all rows; root is the least of the
    sets that hang together with sig in it.  sets: sig, size, docs and doc_a,
    the smallest id of each set.
    """
    spark = docs.sparkSession
    slim = _slim(docs, doc_id, text)
    total = sets.agg(F.sum("size")).head()[0] or 0
    bits = min(20, max(4, math.ceil(math.log2(max(1.0, total / _RANGE)))))
    hot = spark.sparkContext.broadcast(frequent(slim, n, bits))

    def packed(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        shift = np.cumsum([0, *(len(h[2]) for h in held)])
        tokens, which = np.concatenate([h[0] for h in held]), np.concatenate([h[1] + x for h, x in zip(held, shift)])
        sig, group, size = (np.concatenate([h[k] for h in held]) for k in (2, 3, 4))
        order = np.argsort(tokens, kind="stable")
        tokens, which = tokens[order], which[order]
        _, least = np.unique(which, return_index=True)  # of each set the first posting tells its group's membership
        home = (tokens[least] >> np.uint64(GRAM_BITS - bits)).astype(np.int64)
        rows = []
        for r, s in _by_range(tokens, bits):
            used, local = np.unique(which[s], return_inverse=True)
            rows.append((r, _rest(tokens[s], bits).tobytes(), local.astype(np.uint32).tobytes(), sig[used].tobytes(), group[used].tobytes(), size[used].astype(np.uint32).tobytes(), (home[used] == r).tobytes()))
        columns = list(zip(*rows)) or [()] * 7
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], names=["range", "tokens", "which", "sig", "grp", "size", "home"])

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for whole in batches:
            for batch in text_slices(whole, "text"):
                held.append(_prefixes(batch.column("text").to_pylist(), n, threshold, bits, hot.value))
                if sum(len(h[0]) for h in held) > _PACK:
                    yield packed(held)
                    held = []
        if held:
            yield packed(held)

    def match(table: pa.Table) -> pa.Table:
        def joined(name: str, kind: type) -> list[np.ndarray]:
            return [np.frombuffer(x, dtype=kind) for x in table[name].to_pylist()]

        sig = joined("sig", np.int64)
        shift = np.concatenate(([0], np.cumsum([len(x) for x in sig])))
        which = np.concatenate([w + s for w, s in zip((x.astype(np.int64) for x in joined("which", np.uint32)), shift)])
        return pa.table(matches(np.concatenate(joined("tokens", np.uint32)), np.concatenate(sig), np.concatenate(joined("grp", np.int64)), np.concatenate(joined("size", np.uint32)), which, np.concatenate(joined("home", bool)), threshold))

    cells = slim.select("text").mapInArrow(post, "range int, tokens binary, which binary, sig binary, grp binary, size binary, home binary").groupBy("range").applyInArrow(match, "q long, g long, shared int, low int, high int, size int, own byte")
    cells = stored(cells.groupBy("q", "g").agg(F.sum("shared").alias("shared"), F.min(F.when(F.col("own") == 0, F.col("low"))).alias("low"), F.max(F.when(F.col("own") == 0, F.col("high"))).alias("high"), F.max("size").alias("size"), F.max("own").alias("own")), "jaccard-cells")
    t, size = threshold, F.col("size")
    lowest, highest = F.greatest(F.col("low"), size * t), F.least(F.col("high"), size / t)
    # what two sets share beyond the prefixes lies in the suffix of one of them
    least = F.least(*[(size + s) * (t / (1 + t)) - F.greatest(size, s) * (t - EXTRA) for s in (lowest, highest)])
    opened = cells.where((F.col("shared") > 0) & (F.col("shared") >= least - 1e-6))
    wanted = opened.groupBy("g").agg(F.ceil(F.sum("size") / _OPEN).alias("query_parts"))
    inside = cells.where("own = 1").join(wanted.select("g"), "g")
    parts = inside.groupBy("g").agg(F.ceil(F.sum("size") / _OPEN).alias("member_parts")).join(wanted, "g")
    part = lambda count: F.pmod(F.xxhash64("q"), F.col(count)).cast("int")
    spread = lambda count: F.explode(F.sequence(F.lit(0), (F.col(count) - 1).cast("int")))
    asks = opened.join(parts, "g").withColumn("x", part("query_parts")).withColumn("y", spread("member_parts")).select("q", "g", "x", "y", F.lit(1).alias("role"))
    holds = inside.join(parts, "g").withColumn("y", part("member_parts")).withColumn("x", spread("query_parts")).select("q", "g", "x", "y", F.lit(2).alias("role"))
    once = asks.unionByName(holds).groupBy("q", "g", "x", "y").agg(F.bit_or("role").alias("role"))  # 1 asks, 2 is held
    routes = stored(once.groupBy("q").agg(F.collect_list(F.struct("g", "x", "y", "role")).alias("routes")).join(sets.select(F.col("sig").alias("q"), F.col("doc_a").alias("doc_id"), "docs"), "q"), "jaccard-routes")
    rows = routes.agg(F.sum(F.size("routes"))).head()[0] or 0

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, "text"):
                grams, offsets = batch_ngrams(batch.column("text").to_pylist(), n)
                good = pa.array(_signatures(grams, offsets) == batch.column("q").to_numpy())  # ids may repeat with other texts
                packed = [_short(grams[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("docs"), batch.column("routes"), pa.array(packed, pa.binary())], names=["q", "docs", "routes", "grams"]).filter(good)

    needed = slim.join(F.broadcast(routes) if rows <= BROADCAST_ROWS else routes, "doc_id").select("q", "docs", "routes", "text")
    sent = needed.mapInArrow(tokens, f"q long, docs long, routes {routes.schema['routes'].dataType.simpleString()}, grams binary").select("q", "docs", "grams", F.explode("routes").alias("r")).select("q", "docs", "grams", "r.*")

    def compare(table: pa.Table) -> pa.Table:
        role = table["role"].to_numpy()
        sig = table["q"].to_numpy()
        grams = table["grams"].combine_chunks()
        order = np.argsort(sig, kind="stable")  # a set comes several times where the rows of its id do
        starts = np.flatnonzero(np.concatenate(([True], np.diff(sig[order]) != 0)))
        first = order[starts]
        names, docs_of, role = sig[first], table["docs"].to_numpy()[first], np.bitwise_or.reduceat(role[order], starts)
        members, queries = np.flatnonzero(role & 2), np.flatnonzero(role & 1)
        links, parent = np.zeros(len(names), dtype=np.int64), np.arange(len(names))
        if len(members) and len(queries):
            held = [_long(grams[int(first[i])].as_buffer()) for i in members]
            sizes = np.array([len(h) for h in held], dtype=np.int64)
            token, owner = np.concatenate(held), np.repeat(np.arange(len(held)), sizes)
            del held
            order = np.argsort(token, kind="stable")
            token, owner = token[order], owner[order]
            for i in queries.tolist():
                query = _long(grams[int(first[i])].as_buffer())
                lo, hi = np.searchsorted(token, query), np.searchsorted(token, query, side="right")
                times = hi - lo
                ends = np.cumsum(times)
                hits = owner[np.repeat(lo - (ends - times), times) + np.arange(ends[-1])]
                overlap = np.bincount(hits, minlength=len(sizes))
                found = members[(members > i) & (overlap >= threshold * (sizes + len(query) - overlap) - 1e-9)]  # names are sorted
                if len(found):
                    links[i] += docs_of[found].sum()
                    links[found] += docs_of[i]
                    _unite(parent, np.append(found, i))
        linked = np.flatnonzero(links)
        return pa.table({"sig": pa.array(names[linked]), "root": pa.array(names[_roots(parent, linked)]), "links": pa.array(links[linked])})

    return sent.groupBy("g", "x", "y").applyInArrow(compare, "sig long, root long, links long")


def _roots(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The root of each node; the nodes are hung on it."""
    up = parent[nodes]
    while not np.array_equal(up, above := parent[up]):
        up = above
    parent[nodes] = up
    return up


def _unite(parent: np.ndarray, nodes: np.ndarray) -> None:
    roots = _roots(parent, nodes)
    parent[roots] = roots.min()


def document_links(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, class_id and n_links of every document that is linked with another one, stored.

    Two documents are linked if their sets of word n-grams have a Jaccard
    similarity of at least threshold.  A class holds the documents that hang
    together by links; class_id is its smallest doc_id.  n_links is the number
    of other documents that a document is linked with, its exact copies
    included.  A document without a link is a class of its own and has no row.

    Words are lower-cased runs without ASCII punctuation; a text of fewer than n
    words is one n-gram.  Documents without words (null, empty) and rows without
    id have no row, an empty table gives an empty one.  Repeated rows of an id
    count once; an id with several different texts counts as a document, and
    has a row, for each of them.
    """
    by_doc = stored(document_sets(docs, n, doc_id, text).distinct(), "jaccard-documents")
    sets = stored(by_doc.groupBy("sig").agg(F.max("size").alias("size"), F.count("*").alias("docs"), F.min("doc_id").alias("doc_a")), "jaccard-sets")
    found = stored(set_links(docs, sets, n, threshold, doc_id, text), "jaccard-links")
    stars = components(found.select(F.col("sig").alias("u"), F.col("root").alias("v")))
    linked = found.groupBy("sig").agg(F.sum("links").alias("links")).join(stars.withColumnRenamed("node", "sig"), "sig", "left").select("sig", "links", F.coalesce("root", "sig").alias("root"))
    known = stored(sets.join(linked, "sig", "left").where("docs > 1 or links > 0").select("sig", "doc_a", "docs", F.coalesce("root", "sig").alias("root"), (F.col("docs") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "jaccard-known")
    least = known.groupBy("root").agg(F.min("doc_a").alias("class_id"))
    classes = stored(known.join(least, "root").select("sig", "docs", "class_id", "n_links"), "jaccard-classes")
    if classes.count() <= BROADCAST_ROWS:
        rows = by_doc.join(F.broadcast(classes), "sig")
    else:
        total = by_doc.count()
        hot = F.col("docs") > HOT_SHARE * total
        few, many = classes.where(hot), classes.where(~hot)
        rows = by_doc.join(F.broadcast(few), "sig").unionByName(by_doc.join(F.broadcast(few.select("sig")), "sig", "left_anti").join(many, "sig"))
    return stored(rows.select("doc_id", "class_id", "n_links"), "jaccard-rows")


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node that it is connected with) of an edge table (u, v), by alternating large and small stars."""
    links = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
    while not _are_stars(links):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u <> v").distinct(), "components")
        first = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(first, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(first.select("u", F.col("m").alias("v"))).distinct()
        links = stored(small, "components")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _are_stars(links: DataFrame) -> bool:
    """Whether every node either hangs on one root or is a root."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(links.select(F.col("v").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    return not ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds")).where("hangs + holds > 1").limit(1).count()


def unique(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs, all columns, without the documents of a class (see document_links) but the one of smallest id.

    Rows without id and documents without words stay; rows of one id stay or go together.
    """
    gone = document_links(docs, n, threshold, doc_id, text).where("doc_id <> class_id").select(F.col("doc_id").alias("__gone")).distinct()
    gone = stored(gone, "jaccard-gone")
    small = gone.count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(gone) if small else gone, docs[doc_id] == gone["__gone"], "left_anti")


def links_sql(docs: str = "documents", n: int = N, threshold: float = THRESHOLD) -> str:
    """SQL of document_links()."""
    word = WORD_RE.replace("'", "''")
    return f"""with recursive
worded as (select doc_id, regexp_extract_all(lower(text), '{word}') as w from {docs} where doc_id is not null and text is not null),
gram_lists as (select doc_id, list_sort(list_distinct(case when len(w) < {n} then [array_to_string(w, ' ')]
  else list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n} - 1], ' ')) end)) as g from worded where len(w) > 0),
sets as materialized (select min(doc_id) as doc_a, list_distinct(list(doc_id)) as copies, len(any_value(g))::bigint as size, g as g_ from gram_lists group by g),
grams as (select doc_a, unnest(g_) as gram from sets),
shared as (select a.doc_a as u, b.doc_a as v, count(*)::bigint as overlap from grams a join grams b on a.gram = b.gram and a.doc_a <> b.doc_a group by all),
near as materialized (select u, v, len(b.copies) as docs from shared join sets a on a.doc_a = u join sets b on b.doc_a = v where overlap >= {threshold} * (a.size + b.size - overlap) - 1e-9),
reached as (select doc_a as node, doc_a as other from sets union select node, v from reached join near on other = u),
roots as (select node, min(other) as class_id from reached group by node),
counts as (select doc_a, len(copies) - 1 + coalesce((select sum(docs) from near where u = doc_a), 0) as n_links, copies from sets)
select unnest(copies) as doc_id, class_id, n_links::bigint as n_links from counts join roots on node = doc_a where n_links > 0"""
