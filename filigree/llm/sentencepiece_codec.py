"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Every word of a batch holds an agenda of its adjacent symbol pairs ordered by
the score of the piece that they form, leftmost first among equals.  The best
pair is merged and its two neighbours enter the agenda, until no pair forms a
piece.  The agendas of all distinct words of an Arrow batch advance together
in numpy, one merge a word a round; a word of more than LONG characters has a
heap of its own instead, so that its cost grows as n log n.

Every word that is new to a worker is compared with the library.  That is a
comparison of all texts, since texts of a vocabulary that the constructor takes
split exactly at blanks: nothing but the mark for blanks is normalised, no piece
holds the mark except at its start, and no piece is matched ahead of merging.
"""

from __future__ import annotations

import heapq
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from filigree.llm.common import text_slices, without

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Characters of a word beyond which it is merged by a heap.
LONG = 256
_WORD = re.compile("▁*[^▁]+|▁+")
_NEVER = np.int64(1) << np.int64(60)


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a serialised message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = number() if key & 7 == 2 else 8 if key & 7 == 1 else 4
            yield key >> 3, message[at : at + size]
            at += size


def _verify(model: bytes) -> None:
    """Raises unless the model merges pairs and its texts split exactly at blanks."""
    pieces, trainer, normalizer, denormalizer = (1, 2, 3, 5)
    kinds: set[int] = set()
    spec: dict[int, dict[int, int | bytes]] = {trainer: {}, normalizer: {}, denormalizer: {}}
    for part, value in _fields(model):
        if part == pieces:
            kinds.add(int(dict(_fields(value)).get(3, 1)))
        elif part in spec:
            spec[part] = dict(_fields(value))
    rules = spec[normalizer]
    for good, what in (
        (spec[trainer].get(3) == 2, "pieces aren't merged by score"),
        (not spec[trainer].get(24, 0), "the mark for blanks is a suffix"),
        (not rules.get(2) and not spec[denormalizer].get(2), "characters are normalised"),
        (rules.get(3, 1) == 1, "texts get no mark at their start"),
        (rules.get(4, 1) == 0, "extra blanks are removed"),
        (rules.get(5, 1) == 1, "blanks aren't escaped"),
        (kinds <= {1, 2, 3, 6}, "it has user-defined or unused pieces"),
    ):
        if not good:
            raise ValueError(f"this vocabulary can't be encoded word by word: {what}")


class _Index(dict):
    """Numbers keys as they first come."""

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        return n


class MergeVocabulary:
    """Pieces, scores and the table of mergeable pairs of one model file."""

    def __init__(self, model_file: str) -> None:
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        _verify(sp.serialized_model_proto())
        n = sp.vocab_size()
        self.size = n
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        ids = {self.pieces[i]: i for i in plain}
        if any("▁" in p.lstrip("▁") for p in ids):
            raise ValueError("a piece of this vocabulary spans words")
        self.byte_id = np.full(256, sp.unk_id(), dtype=np.int64)
        for i in range(n):
            if sp.is_byte(i):
                self.byte_id[int(self.pieces[i][1:-1], 16)] = i
        # characters that are not pieces are numbered from n on, per batch
        self.char_id = {p: i for p, i in ids.items() if len(p) == 1}
        scores = np.array([sp.get_score(i) for i in range(n)])
        rank_of = {s: r for r, s in enumerate(sorted({scores[i] for i in plain}, reverse=True))}
        keys, outs, ranks = [], [], []
        for piece, i in ids.items():
            for cut in range(1, len(piece)):
                a, b = ids.get(piece[:cut]), ids.get(piece[cut:])
                if a is None and cut == 1 or b is None and cut == len(piece) - 1:
                    if not (piece[:cut] in ids or cut > 1) or not (piece[cut:] in ids or len(piece) - cut > 1):
                        raise ValueError(f"piece {piece!r} holds a character that is no piece")
                if a is not None and b is not None:
                    keys.append(a * n + b)
                    outs.append(i)
                    ranks.append(rank_of[scores[i]])
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.table_key = np.full(1 << self.bits, -1, dtype=np.int64)
        self.table_out = np.zeros(1 << self.bits, dtype=np.int64)
        self.table_rank = np.full(1 << self.bits, _NEVER, dtype=np.int64)
        keys, outs, ranks = (np.array(x, dtype=np.int64) for x in (keys, outs, ranks))
        slot, todo = self._slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(todo):
            self.probes += 1
            free = self.table_key[slot[todo]] == -1
            _, first = np.unique(slot[todo], return_index=True)
            winner = np.zeros(len(todo), dtype=bool)
            winner[first] = True
            win = todo[free & winner]
            self.table_key[slot[win]], self.table_out[slot[win]], self.table_rank[slot[win]] = keys[win], outs[win], ranks[win]
            todo = todo[~(free & winner)]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
        self.index, self.checked, self.pairs = _Index(), None, None
        surface = [self._surface(i) for i in range(n)]
        self.piece_len = np.array([len(s) for s in surface], dtype=np.int64)
        self.piece_start = np.concatenate(([0], np.cumsum(self.piece_len)))[:-1]
        self.piece_bytes = np.frombuffer(b"".join(surface), dtype=np.uint8)

    def _surface(self, i: int) -> bytes:
        sp = self.library
        if sp.is_byte(i):
            return bytes([int(self.pieces[i][1:-1], 16)])
        if sp.is_control(i):
            return b""
        if sp.is_unknown(i):
            return " ⁇ ".encode()
        return self.pieces[i].replace("▁", " ").encode()

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Table slots of the pairs, -1 where a pair forms no piece."""
        known = (left >= 0) & (right >= 0)
        keys = np.where(known, left * self.size + right, -2)
        slot = self._slot(keys)
        found = np.full(len(keys), -1, dtype=np.int64)
        todo = np.arange(len(keys))
        for _ in range(self.probes + 1):
            at = self.table_key[slot[todo]]
            hit = at == keys[todo]
            found[todo[hit]] = slot[todo[hit]]
            todo = todo[~hit & (at != -1)]
            if not len(todo):
                break
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
        return found

    def merge_word(self, symbols: np.ndarray) -> tuple[list[int], list[int]]:
        """(ids, place of the first character of each) of one word's characters, by a heap of its adjacent pairs."""
        if self.pairs is None:
            used = np.flatnonzero(self.table_key >= 0)
            self.pairs = dict(zip(self.table_key[used].tolist(), zip(self.table_rank[used].tolist(), self.table_out[used].tolist())))
        pairs, size = self.pairs, self.size
        symbol = symbols.tolist()
        n = len(symbol)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        slot = self.look_up(symbols[:-1], symbols[1:])
        at = np.flatnonzero(slot >= 0)
        heap = list(zip(self.table_rank[slot[at]].tolist(), at.tolist(), (symbols[at] * size + symbols[at + 1]).tolist()))
        heapq.heapify(heap)
        while heap:
            _, i, key = heapq.heappop(heap)
            j = after[i]
            if j >= n or symbol[i] < 0 or symbol[j] < 0 or symbol[i] * size + symbol[j] != key:
                continue  # one of the two has been merged since
            symbol[i], symbol[j] = pairs[key][1], -2
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if symbol[k] >= 0 and (found := pairs.get(symbol[i] * size + symbol[k])):
                    heapq.heappush(heap, (found[0], i, symbol[i] * size + symbol[k]))
            h = before[i]
            if h >= 0 and symbol[h] >= 0 and (found := pairs.get(symbol[h] * size + symbol[i])):
                heapq.heappush(heap, (found[0], h, symbol[h] * size + symbol[i]))
        places = [i for i, x in enumerate(symbol) if x != -2]
        return [symbol[i] for i in places], places

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of words that are already in piece form."""
        text = "".join(words)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        distinct, where = np.unique(points, return_inverse=True)
        table = np.array([self.char_id.get(chr(c), -1) for c in distinct], dtype=np.int64)
        symbol = table[where] if len(points) else np.zeros(0, dtype=np.int64)
        origin = np.arange(len(points))  # the first character of each symbol
        word = np.repeat(np.arange(len(words)), lengths)
        done_ids, done_word, done_at = [], [], []
        ends = np.cumsum(lengths)
        for i in np.flatnonzero(lengths > LONG).tolist():
            begin = int(ends[i] - lengths[i])
            ids, places = self.merge_word(symbol[begin : ends[i]])
            done_ids.append(np.array(ids, dtype=np.int64))
            done_word.append(np.full(len(ids), i))
            done_at.append(np.array(places, dtype=np.int64) + begin)
        short = np.repeat(lengths <= LONG, lengths)
        symbol, origin, word = symbol[short], origin[short], word[short]
        pair = np.full(len(symbol), -1, dtype=np.int64)
        inner = np.flatnonzero(word[1:] == word[:-1]) if len(word) else np.zeros(0, dtype=np.int64)
        pair[inner] = self.look_up(symbol[inner], symbol[inner + 1])
        while len(symbol):
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            sizes = np.diff(np.append(starts, len(word)))
            place = np.arange(len(word)) - np.repeat(starts, sizes)
            agenda = np.where(pair >= 0, (self.table_rank[pair] << np.int64(32)) | place, _NEVER)
            best = np.minimum.reduceat(agenda, starts)
            live = best < _NEVER
            ended = np.repeat(~live, sizes)
            if ended.any():
                done_ids.append(symbol[ended])
                done_word.append(word[ended])
                done_at.append(origin[ended])
                keep = ~ended
                agenda, best, sizes = agenda[keep], best[live], sizes[live]
                symbol, origin, word, pair = symbol[keep], origin[keep], word[keep], pair[keep]
                if not len(symbol):
                    break
            at = np.flatnonzero(agenda == np.repeat(best, sizes))  # one a word: positions differ
            symbol[at] = self.table_out[pair[at]]
            left = np.ones(len(symbol), dtype=bool)
            left[at + 1] = False
            shift = np.cumsum(left) - 1
            symbol, origin, word, pair = symbol[left], origin[left], word[left], pair[left]
            at = shift[at]
            pair[at] = -1
            right = at[(at + 1 < len(word))]
            right = right[word[right] == word[right + 1]]
            pair[right] = self.look_up(symbol[right], symbol[right + 1])
            before = at[at > 0] - 1
            before = before[word[before] == word[before + 1]]
            pair[before] = self.look_up(symbol[before], symbol[before + 1])
        if not done_ids:
            return np.zeros(0, dtype=np.int32), np.zeros(len(words) + 1, dtype=np.int64)
        ids, word, at = np.concatenate(done_ids), np.concatenate(done_word), np.concatenate(done_at)
        order = np.argsort(at, kind="stable")
        ids, word, at = ids[order], word[order], at[order]
        if (ids < 0).any():  # characters outside the vocabulary fall back to bytes
            raw = [chr(p).encode("utf-8", "replace") for p in points[at[ids < 0]]]
            count = np.ones(len(ids), dtype=np.int64)
            count[ids < 0] = [len(r) for r in raw]
            out = np.repeat(ids, count)
            out[out < 0] = self.byte_id[np.frombuffer(b"".join(raw), dtype=np.uint8)]
            ids, word = out, np.repeat(word, count)
        return ids.astype(np.int32), np.searchsorted(word, np.arange(len(words) + 1))

    def encode_batch(self, texts: list[str], check: bool = False, held: int = 120_000) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of a batch of texts; a null or empty text has no ids.

        Words are remembered between batches, up to about held of them or ten
        times as many ids.  check compares every word that is encoded with the
        library and raises on any difference.
        """
        if len(self.index) > held or self.checked != check or len(self.held_ids) > 10 * held:
            self.index, self.checked = _Index(), check
            self.held_ids, self.held_offsets = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)
        index, known = self.index, len(self.index)
        codes: list[np.ndarray] = []
        counts = np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            if text:
                parts = text.replace("▁", " ").split(" ")
                if "" in parts:
                    parts = [w[1:] for w in _WORD.findall("▁" + text.replace(" ", "▁"))]
                counts[i] = len(parts)
                codes.append(np.fromiter(map(index.__getitem__, parts), dtype=np.int64, count=len(parts)))
        fresh = ["▁" + w for w in itertools.islice(index, known, None)]
        ids, offsets = self.encode_words(fresh)
        if check:
            self._check_words(fresh, ids, offsets)
        self.held_ids = np.concatenate((self.held_ids, ids))
        self.held_offsets = np.concatenate((self.held_offsets, offsets[1:] + self.held_offsets[-1]))
        out, ends = _gather(self.held_ids, self.held_offsets, np.concatenate(codes) if codes else np.zeros(0, dtype=np.int64))
        bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]
        return out, bounds

    def _check_words(self, words: list[str], ids: np.ndarray, offsets: np.ndarray) -> None:
        # the library puts one boundary mark before a text, so a word is given without its first
        chosen = [i for i, w in enumerate(words) if len(w) > 1]
        theirs = self.library.encode([words[i][1:] for i in chosen], num_threads=1)
        flat = np.fromiter(itertools.chain.from_iterable(theirs), dtype=np.int32)
        ours, ends = _gather(ids, offsets, np.array(chosen, dtype=np.int64))
        if not (np.array_equal(flat, ours) and np.array_equal(np.cumsum(list(map(len, theirs))), ends)):
            raise AssertionError("encoding differs from the library's")

    def decode_batch(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of id runs; the boundary mark before a text goes."""
        flat, ends = _gather(self.piece_bytes, np.append(self.piece_start, len(self.piece_bytes)), ids, self.piece_len)
        data = flat.tobytes()
        bounds = np.concatenate(([0], ends))[offsets]
        texts = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            text = data[a:b].decode("utf-8", "replace")
            texts.append(text[1:] if text[:1] == " " else text)
        return texts


def _gather(values: np.ndarray, offsets: np.ndarray, rows: np.ndarray, lengths: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Concatenation of the runs of a ragged array that rows names, and the ends of each."""
    size = (np.diff(offsets) if lengths is None else lengths)[rows]
    ends = np.cumsum(size)
    if not len(rows) or not ends[-1]:
        return values[:0], ends
    step = np.repeat(offsets[rows] - (ends - size), size)
    return values[step + np.arange(ends[-1])], ends


_HELD: dict[str, MergeVocabulary] = {}


def vocabulary(model_file: str) -> MergeVocabulary:
    """One vocabulary a worker process."""
    if model_file not in _HELD:
        _HELD[model_file] = MergeVocabulary(model_file)
    return _HELD[model_file]


def encode(docs: DataFrame, model_file: str = DEFAULT_MODEL, text: str = "text", check: bool = True, prefix: str = "") -> DataFrame:
    """docs with columns ids (array<int>), n_ids and round_trip (do the decoded ids give the text back).

    A null text has null ids, n_ids 0 and a null round_trip; an empty text has
    empty ids.  Literal boundary marks (U+2581) decode to spaces, so such a text
    has round_trip false.  Other columns pass through; columns of docs that have
    one of the new names are replaced, unless prefix tells them apart.  An empty
    table gives an empty one, repeated rows give repeated rows.
    """
    new = [f"{prefix}ids", f"{prefix}n_ids", f"{prefix}round_trip"]
    docs = without(docs, *new)
    schema = T.StructType([*docs.schema.fields, T.StructField(new[0], T.ArrayType(T.IntegerType())), T.StructField(new[1], T.LongType()), T.StructField(new[2], T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model_file)
        for whole in batches:
            for batch in text_slices(whole, text):
                texts = batch.column(text).to_pylist()
                ids, offsets = v.encode_batch(texts, check)
                same = [None if a is None else a == b for a, b in zip(texts, v.decode_batch(ids, offsets))]
                absent = pa.array([t is None for t in texts])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()), mask=absent if absent.true_count else None)
                yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(np.diff(offsets), pa.int64()), pa.array(same, pa.bool_())], names=[*batch.schema.names, *new])

    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, model_file: str = DEFAULT_MODEL, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """rows with the text of their ids in column out, which replaces one of that name; null ids give a null text, empty ids an empty one."""
    rows = without(rows, out)
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model_file)
        for batch in batches:
            column = batch.column(ids)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            texts = v.decode_batch(flat, np.concatenate(([0], np.cumsum(sizes))).astype(np.int64))
            texts = [None if gone else t for t, gone in zip(texts, column.is_null().to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out])

    return rows.mapInArrow(run, schema)
