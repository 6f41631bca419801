"""Removal of passages that repeat earlier ones, by suffix arrays.

Documents of a shard are laid out in id order.  Its suffix array over words
comes from Larsson-Sadakane refinement in numpy and the common prefixes from
Kasai's lemma; runs of suffixes that share at least LENGTH words are the
shard's repeats, of which the earliest stays.  The windows that are first in
their shard go, sorted, to one task per key range, where the shards' runs are
merged by binary search and all but the earliest occurrence of a key are
repeats.  Windows meet across shards by a 64-bit hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filigree.llm.common import partitions, stored, text_slices
from filigree.llm.hashing import WORD_RE, hash_spans, mix64, word_spans

LENGTH = 50
#: Rows up to which the table of repeats is broadcast when texts are cut; beyond it the join shuffles.
BROADCAST_ROWS = 500_000
_SHARD = 2_000_000  # bytes of text
_WINDOWS = 1_000_000  # of one key range


def suffix_array(values: np.ndarray) -> np.ndarray:
    """Suffix array of a sequence of non-negative integers that ends in a unique least one.

    Larsson and Sadakane: suffixes are grouped by their first h values, and
    only groups of several suffixes are sorted again, by the group of the
    suffix h further on, with h doubling.
    """
    n = len(values)
    order = np.argsort(values, kind="stable")
    placed = values[order]
    rank = np.empty(n, dtype=np.int64)
    fresh = np.concatenate(([True], placed[1:] != placed[:-1])) if n else np.zeros(0, dtype=bool)
    starts = np.maximum.accumulate(np.where(fresh, np.arange(n), 0)) if n else np.zeros(0, dtype=np.int64)
    rank[order] = starts
    lonely = fresh & np.append(fresh[1:], True)
    slots = np.flatnonzero(~lonely)
    h = 1
    while len(slots):
        suffix = order[slots]
        key = (rank[suffix] << np.int64(32)) | rank[np.minimum(suffix + h, n - 1)]
        by = np.argsort(key)
        suffix, key = suffix[by], key[by]
        order[slots] = suffix
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        rank[suffix] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(slots)), 0))]
        lonely = fresh & np.append(fresh[1:], True)
        slots = slots[~lonely]
        h *= 2
    return order


def common_prefixes(values: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix, in suffix order, with the one before it (0 for the first).

    By Kasai's lemma the common prefix of a suffix is at least one shorter than
    that of the suffix one position earlier; it is exactly that where the
    values before the two suffixes agree, so only the others are compared.
    """
    n = len(values)
    if not n:
        return np.zeros(0, dtype=np.int64)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    at = np.arange(n)
    known = (before >= 0) & (at > 0) & (before > 0)
    known[known] = values[at[known] - 1] == values[before[known] - 1]
    compare = np.flatnonzero(~known)
    length = np.zeros(n, dtype=np.int64)
    a, b = compare, before[compare]
    a, b = a[b >= 0], b[b >= 0]
    step = 0
    while len(a):
        same = (a + step < n) & (b + step < n)
        same[same] = values[a[same] + step] == values[b[same] + step]
        length[a[~same]] = step
        a, b = a[same], b[same]
        step += 1
    source = np.maximum.accumulate(np.where(known, 0, at))
    return np.maximum(length[source] - (at - source), 0)[order]


def shard_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, offsets) of texts as they are, in their case."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    bounds = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw]))).astype(np.int64)
    buf = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    starts, ends = word_spans(buf)
    return hash_spans(buf, starts, ends), np.searchsorted(starts, bounds)


def shard_repeats(words: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(group, window start) of the windows of length words that occur more than once, grouped."""
    docs = len(offsets) - 1
    _, ranks = np.unique(words, return_inverse=True)
    values = np.empty(len(words) + docs, dtype=np.int64)
    doc = np.repeat(np.arange(docs), np.diff(offsets))
    values[np.arange(len(words)) + doc] = ranks + docs
    values[offsets[1:] + np.arange(docs)] = np.arange(docs)[::-1]  # each document ends in a value of its own
    order = suffix_array(values)
    shared = common_prefixes(values, order) >= length
    member = shared | np.append(shared[1:], False)
    group = np.cumsum(~shared)[member]
    position = order[member]
    at_doc = np.searchsorted(offsets[1:] + np.arange(docs), position, side="right")
    return group, position - at_doc


def window_keys(words: np.ndarray, length: int) -> np.ndarray:
    """64-bit hashes of the length words from each position on, by doubling."""
    keys, have = mix64(words + np.uint64(1)), 1
    while have < length:
        step = min(have, length - have)
        keys = mix64(keys[: len(keys) - step] * np.uint64(0x9E3779B97F4A7C55) + keys[step:] + np.uint64(have))
        have += step
    return keys


def _merged(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...], lost: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, ...]:
    """Two sorted runs (key, doc, start) of distinct keys as one; the later occurrence of a key that both have goes to lost."""
    if len(a[0]) < len(b[0]):
        a, b = b, a
    at = np.searchsorted(a[0], b[0])
    hit = np.zeros(len(at), dtype=bool)
    inside = at < len(a[0])
    hit[inside] = a[0][at[inside]] == b[0][inside]
    i, j = at[hit], np.flatnonzero(hit)
    behind = (b[1][j] > a[1][i]) | ((b[1][j] == a[1][i]) & (b[2][j] > a[2][i]))
    ahead = (b[1][j] < a[1][i]) | ((b[1][j] == a[1][i]) & (b[2][j] < a[2][i]))
    lost.append((b[1][j[behind]], b[2][j[behind]]))
    lost.append((a[1][i[ahead]], a[2][i[ahead]]))
    a[1][i[ahead]], a[2][i[ahead]] = b[1][j[ahead]], b[2][j[ahead]]
    new = ~hit
    return tuple(np.insert(x, at[new], y[new]) for x, y in zip(a, b))


def _spans(doc: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, first word, word after the last) of the unions of windows."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    fresh = np.concatenate(([True], (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + length))) if len(doc) else np.zeros(0, dtype=bool)
    at = np.flatnonzero(fresh)
    last = np.append(at[1:], len(doc))[: len(at)] - 1
    return doc[at], start[at], start[last] + length


def repeats(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, starts, ends and removed_words of the documents that repeat earlier passages.

    A word is a run of characters without ASCII punctuation and blanks, in its
    case.  A word is repeated when it lies in a window of length words of its
    document that also occurs earlier, in order of (doc_id, word position),
    anywhere.  starts and ends are the first words and the words after the last
    of the maximal runs of repeated words, counted from 0.  Ids are integers;
    rows without id or text repeat nothing, rows of one id count as one, and an
    empty table gives an empty one.  A text of any length is in one shard.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null and text <> ''")
    volume = slim.agg(F.sum(F.length("text"))).head()[0] or 0
    bits = min(24, max(5, math.ceil(math.log2(max(1.0, volume / 6.5 / _WINDOWS)))))
    buckets = max(partitions(spark), 1 << bits)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, "text", _SHARD):
                ids = batch.column("doc_id").to_numpy()
                order = np.argsort(ids, kind="stable")
                ids = ids[order]
                words, offsets = shard_words(batch.column("text").take(pa.array(order)).to_pylist())
                if not len(words):
                    continue
                doc = np.repeat(np.arange(len(ids)), np.diff(offsets))
                first = np.zeros(len(words), dtype=bool)
                count = np.diff(offsets)
                place = np.arange(len(words)) - offsets[doc]
                first[place <= count[doc] - length] = True
                group, position = shard_repeats(words, offsets, length)
                by = np.lexsort((place[position], ids[doc[position]], group))
                group, position = group[by], position[by]
                head = np.maximum.accumulate(np.where(np.diff(group, prepend=-1) != 0, np.arange(len(group)), 0)) if len(group) else group
                later = (ids[doc[position]] != ids[doc[position[head]]]) | (place[position] != place[position[head]])
                first[position] = False
                first[position[np.unique(head)]] = True
                again = position[later]
                at = np.flatnonzero(first)
                keys = window_keys(words, length)[at] if len(at) else np.zeros(0, dtype=np.uint64)
                by = np.argsort(keys)
                keys, at = keys[by], at[by]
                zone = (keys >> np.uint64(64 - bits)).astype(np.int64)
                cuts = np.flatnonzero(np.diff(zone, prepend=-1))
                rows = [(int(zone[a]), keys[a:b].tobytes(), ids[doc[at[a:b]]].tobytes(), place[at[a:b]].astype(np.uint32).tobytes(), b"", b"") for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(keys)])]
                if len(again):
                    rows.append((int(ids[0] % (1 << bits)), b"", b"", b"", ids[doc[again]].tobytes(), place[again].astype(np.uint32).tobytes()))
                if rows:
                    columns = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], names=names)

    def merge(table: pa.Table) -> pa.Table:
        lost: list[tuple[np.ndarray, np.ndarray]] = []
        runs = []
        for row in table.to_pylist():
            lost.append((np.frombuffer(row["lost_docs"], dtype=np.int64), np.frombuffer(row["lost_starts"], dtype=np.uint32)))
            if row["keys"]:
                runs.append((np.frombuffer(row["keys"], dtype=np.uint64), np.frombuffer(row["docs"], dtype=np.int64).copy(), np.frombuffer(row["starts"], dtype=np.uint32).copy()))
        while len(runs) > 1:
            runs = [_merged(runs[i], runs[i + 1], lost) if i + 1 < len(runs) else runs[i] for i in range(0, len(runs), 2)]
        doc, start = (np.concatenate(x) for x in zip(*lost))
        bucket = (mix64(doc.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        bucket, doc, start = bucket[by], doc[by], start[by]
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
        parts = list(zip(cuts, [*cuts[1:], len(bucket)]))
        return pa.table({"bucket": pa.array([int(bucket[a]) for a, _ in parts], pa.int32()), "docs": pa.array([doc[a:b].tobytes() for a, b in parts], pa.binary()), "starts": pa.array([start[a:b].tobytes() for a, b in parts], pa.binary())})

    def gather(table: pa.Table) -> pa.Table:
        doc = np.concatenate([np.frombuffer(x, dtype=np.int64) for x in table["docs"].to_pylist()])
        start = np.concatenate([np.frombuffer(x, dtype=np.uint32) for x in table["starts"].to_pylist()]).astype(np.int64)
        doc, begin, end = _spans(doc, start, length)
        at = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1]))) if len(doc) else np.zeros(0, dtype=np.int64)
        offsets = pa.array(np.append(at, len(doc)), pa.int32())
        total = np.add.reduceat(end - begin, at) if len(at) else np.zeros(0, dtype=np.int64)
        return pa.table({"doc_id": pa.array(doc[at]), "starts": pa.ListArray.from_arrays(offsets, pa.array(begin.astype(np.int32))), "ends": pa.ListArray.from_arrays(offsets, pa.array(end.astype(np.int32))), "removed_words": pa.array(total.astype(np.int64))})

    names = ["zone", "keys", "docs", "starts", "lost_docs", "lost_starts"]
    runs = slim.mapInArrow(shards, "zone int, keys binary, docs binary, starts binary, lost_docs binary, lost_starts binary")
    lost = runs.groupBy("zone").applyInArrow(merge, "bucket int, docs binary, starts binary")
    return lost.groupBy("bucket").applyInArrow(gather, "doc_id long, starts array<int>, ends array<int>, removed_words long")


def cut_text(text: str, starts: list[int], ends: list[int]) -> str:
    """The text without the words of the spans and what stands between them up to the next word; as it is if it has fewer words than the spans."""
    raw = text.encode("utf-8", "replace")
    begins, _ = word_spans(np.frombuffer(raw, dtype=np.uint8))
    if max(ends) > len(begins):
        return text
    out, at = [], 0
    for a, b in zip(starts, ends):
        out.append(raw[at : begins[a]])
        at = begins[b] if b < len(begins) else len(raw)
    out.append(raw[at:])
    return b"".join(out).decode("utf-8", "replace")


def without_repeats(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", chars: str | None = "n_chars") -> DataFrame:
    """docs, all columns, with repeated passages cut from their texts and column chars, if there is one, counted anew.

    A document of which no word is left goes; other rows stay as they are, also
    null and empty texts.  Of rows of one id with different texts those too short
    for the spans of the id stay as they are.
    """
    found = stored(repeats(docs, length, doc_id, text).select(F.col("doc_id").alias("__cut_id"), F.col("starts").alias("__starts"), F.col("ends").alias("__ends")), "suffix-repeats")
    small = found.count() <= BROADCAST_ROWS
    columns, schema = docs.columns, docs.schema
    joined = docs.join(F.broadcast(found) if small else found, F.col(doc_id).cast("bigint") == F.col("__cut_id"), "left").drop("__cut_id")
    which, count = columns.index(text), columns.index(chars) if chars in columns else -1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = batch.column("__starts")
            rows = np.flatnonzero(starts.is_valid().to_numpy(zero_copy_only=False))
            parts = [batch.column(i) for i in range(len(columns))]
            if len(rows):
                texts = parts[which].to_pylist()
                ends = batch.column("__ends")
                keep = np.ones(batch.num_rows, dtype=bool)
                for i in rows.tolist():
                    whole, texts[i] = texts[i], cut_text(texts[i], starts[i].as_py(), ends[i].as_py()) if texts[i] else texts[i]
                    keep[i] = whole == texts[i] or len(word_spans(np.frombuffer(texts[i].encode("utf-8", "replace"), dtype=np.uint8))[0]) > 0
                parts[which] = pa.array(texts, parts[which].type)
                if count >= 0:
                    sizes = parts[count].to_pylist()
                    for i in rows.tolist():
                        sizes[i] = None if texts[i] is None else len(texts[i])
                    parts[count] = pa.array(sizes, parts[count].type)
                yield pa.RecordBatch.from_arrays(parts, names=columns).filter(pa.array(keep))
            else:
                yield pa.RecordBatch.from_arrays(parts, names=columns)

    return joined.mapInArrow(cut, T.StructType(schema.fields))


def repeats_sql(docs: str = "documents", length: int = LENGTH) -> str:
    """SQL of repeats()."""
    word = WORD_RE.replace("'", "''")
    return f"""with worded as (select doc_id, regexp_extract_all(text, '{word}') as w from {docs} where doc_id is not null and text is not null),
windows as (select doc_id, s, md5(array_to_string(w[s + 1:s + {length}], ' ')) as k from (select doc_id, w, unnest(range(0, len(w) - {length} + 1)) as s from worded)),
ordered as (select doc_id, s, row_number() over (partition by k order by doc_id, s) as nth from windows),
covered as (select distinct doc_id, unnest(range(s, s + {length})) as p from ordered where nth > 1),
islands as (select doc_id, p, p - row_number() over (partition by doc_id order by p) as island from covered),
spans as (select doc_id, min(p)::int as a, max(p)::int + 1 as b from islands group by doc_id, island)
select doc_id, list(a order by a) as starts, list(b::int order by a) as ends, sum(b - a)::bigint as removed_words from spans group by doc_id"""
