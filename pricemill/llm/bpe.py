"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

A text is cut where no piece of the vocabulary can reach across (before a run of spaces, around a line feed); what lies
between is a chunk.  A chunk starts as characters; of the candidate merges of neighbours, the one with the best score,
then the leftmost, is taken next, until none is left.  With dropout, a candidate (start, middle and end in the chunk) is
skipped where the keyed hash of the occurrence and candidate is below the rate.  The key of an occurrence is the 64-bit hash of
seed, doc_id, chunk number and chunk, so every place of a word is decided anew, and alike in reruns.

``Encoder.agenda`` is the plain form with a priority queue.  ``Encoder.merge_all`` gives the same for many chunks at
once: in each round every chunk takes its best merge.  ``Encoder.segment_all`` merges a word once for each set of candidates
that any of its places skips on its way, and gives each place the result it would have alone; the places of a new word that has few are merged at once.  Characters without a piece become byte pieces; so does U+2581,
which stands for a space in pieces.  Decoding gives back the text, whatever the dropout.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterable, Iterator, Sequence
from hashlib import blake2b
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 17
LONG_CHUNK = 48  # characters; longer chunks take the priority queue
BATCH_CHARACTERS = 1 << 20
MERGED_CHUNKS = 1 << 14  # distinct chunks that are merged together
SELDOM = 2  # places in a batch of a new chunk, up to which each is merged by its own key
CACHED = 1 << 17  # distinct chunks whose merges without dropout a task keeps: some 30 MB
SLOTS = 20  # log2 of the slots of the table of pairs
SPACE = "▁"
NONE = np.int64(1) << np.int64(40)  # rank of a pair that does not merge
MASK = (1 << 64) - 1
K1, K2, K3 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
CHUNK = re.compile(r" +[^ \n]*|[^ \n]+|\n")
GAP, FEED = 0x20, 0x0A


def _dropped(key: int, start: int, middle: int, end: int, limit: int) -> bool:
    h = (key ^ (start * K1 + middle * K2 + end * K3)) & MASK
    h = ((h ^ (h >> 31)) * K1) & MASK
    h = ((h ^ (h >> 29)) * K2) & MASK
    return h >> 11 < limit


def _dropped_all(key: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, limit: int) -> np.ndarray:
    h = key ^ (start.astype(np.uint64) * np.uint64(K1) + middle.astype(np.uint64) * np.uint64(K2) + end.astype(np.uint64) * np.uint64(K3))
    h = (h ^ (h >> np.uint64(31))) * np.uint64(K1)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(K2)
    return h >> np.uint64(11) < np.uint64(limit)


def _candidate(start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A candidate of a chunk of at most LONG_CHUNK characters in 18 bits."""
    return start.astype(np.int64) << 12 | middle.astype(np.int64) << 6 | end


class Encoder:
    """``model``: the bytes of a SentencePiece BPE model with byte pieces and without normalisation."""

    def __init__(self, model: bytes, dropout: float = DROPOUT, seed: int = SEED):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor()
        pieces.LoadFromSerializedProto(model)
        count = pieces.GetPieceSize()
        special = {i for i in range(count) if pieces.IsControl(i) or pieces.IsUnknown(i) or pieces.IsByte(i)}
        self.limit, self.seed = int(dropout * (1 << 53)), seed
        self._forget()
        self.byte_ids = np.array([pieces.PieceToId(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.ids = {pieces.IdToPiece(i).replace(SPACE, " "): i for i in range(count) if i not in special}
        self.bytes_of = [b""] * count
        for piece, i in self.ids.items():
            self.bytes_of[i] = piece.encode()
        for b, i in enumerate(self.byte_ids.tolist()):
            self.bytes_of[i] = bytes([b])
        order = {s: r for r, s in enumerate(sorted({-pieces.GetScore(i) for i in self.ids.values()}))}
        self.rank = {p: order[-pieces.GetScore(i)] for p, i in self.ids.items()}
        # symbols: pieces, then characters that occur in pieces only, then any other character
        self.symbols = dict(self.ids)
        for piece in self.ids:
            for c in piece:
                self.symbols.setdefault(c, len(self.symbols) + count)
        self.other = max(self.symbols.values()) + 1
        self.by_character = np.arange(0x110000, dtype=np.int32) + np.int32(self.other)
        for piece, s in self.symbols.items():
            if len(piece) == 1 and piece != SPACE:
                self.by_character[ord(piece)] = s
        self.character_of = {s: ord(p) for p, s in self.symbols.items() if s >= count}
        self.count = count
        pairs = {}
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                a, b = self.symbols.get(piece[:cut]), self.symbols.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a * self.other + b] = (self.rank[piece], i)
        # a hash table with linear probing: key, rank and merged piece by slot
        slots = max(SLOTS, (4 * len(pairs)).bit_length())
        self.shift, self.slot_mask = np.uint64(64 - slots), (1 << slots) - 1
        self.pair_keys = np.full(1 << slots, -1, np.int64)
        self.pair_rank, self.pair_id = np.zeros(1 << slots, np.int32), np.zeros(1 << slots, np.int32)
        for key, (rank, i) in pairs.items():
            at = (key * K1 & MASK) >> (64 - slots)
            while self.pair_keys[at] != -1:
                at = at + 1 & self.slot_mask
            self.pair_keys[at], self.pair_rank[at], self.pair_id[at] = key, rank, i
        widths = np.array([len(b) for b in self.bytes_of])
        self.byte_begin, self.byte_width = np.cumsum(widths) - widths, widths
        self.byte_pool = np.frombuffer(b"".join(self.bytes_of), np.uint8)

    # one chunk -----------------------------------------------------------------------------------------------------

    def chunk_key(self, chunk: str, place: int) -> int:
        h = (place + zlib.crc32(chunk.encode("utf-8", "surrogatepass")) * K2 + self.seed * K3) & MASK
        h = ((h ^ (h >> 32)) * K1) & MASK
        return ((h ^ (h >> 29)) * K3) & MASK

    def chunk_keys(self, crc: np.ndarray, place: np.ndarray) -> np.ndarray:
        h = place + crc * np.uint64(K2) + np.uint64(self.seed * K3 & MASK)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(K1)
        return (h ^ (h >> np.uint64(29))) * np.uint64(K3)

    def agenda(self, chunk: str, place: int = 0) -> list[int]:
        """The ids of a chunk, by a priority queue of candidate merges."""
        key, n = self.chunk_key(chunk, place), len(chunk)
        text: list[str | None] = list(chunk)
        ends, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i < 0 or j >= n:
                return
            rank = None if SPACE in text[i] or SPACE in text[j] else self.rank.get(text[i] + text[j])
            if rank is not None and not (self.limit and _dropped(key, i, j, ends[j], self.limit)):
                heapq.heappush(queue, (rank, i, j, ends[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        while queue:
            _, i, j, end = heapq.heappop(queue)
            if text[i] is None or text[j] is None or after[i] != j or ends[j] != end:
                continue
            text[i], text[j], ends[i], after[i] = text[i] + text[j], None, end, after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        out: list[int] = []
        for part in text:
            if part is not None:
                i = None if part == SPACE else self.ids.get(part)
                out += [i] if i is not None else self.byte_ids[list(part.encode("utf-8", "surrogatepass"))].tolist()
        return out

    # many chunks ---------------------------------------------------------------------------------------------------

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slot of each pair in the table, or -1."""
        keys = left.astype(np.int64) * self.other + right
        keys[(left >= self.other) | (right >= self.other)] = -2
        at = ((keys.astype(np.uint64) * np.uint64(K1)) >> self.shift).astype(np.int64)
        found = self.pair_keys[at]
        out = np.where(found == keys, at, -1)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.slot_mask
            found = self.pair_keys[at[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = at[open_[hit]]
            open_ = open_[~hit & (found != -1)]
        return out

    def merge_all(
        self, chunks: list[str], keys: np.ndarray | None, skipped: np.ndarray | None = None, taken: list | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks in a row, and where each chunk begins in them (one more entry at the end).

        Without ``keys``, just the candidates of the sorted array ``skipped`` (chunk << 18 | candidate) are skipped.
        ``taken`` receives the merges of each round: chunks and candidates.
        """
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        letters = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbol = self.by_character[letters]
        chunk = np.repeat(np.arange(len(chunks), dtype=np.int32), lengths)
        start = (np.arange(len(symbol)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
        done_symbol, done_chunk = [], []

        def candidates(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Rank (or NONE) and merged id of the pairs that begin at the given places."""
            pair = self._pairs(symbol[at], symbol[at + 1])
            where = np.flatnonzero((pair >= 0) & (chunk[at] == chunk[at + 1]))
            rank, merged = np.full(len(at), NONE), np.zeros(len(at), np.int32)
            at, pair = at[where], pair[where]
            if taken is not None or (keys is not None and self.limit):
                third = np.minimum(at + 2, len(symbol) - 1)
                end = np.where((chunk[third] == chunk[at]) & (third == at + 2), start[third], lengths[chunk[at]])
                if keys is not None:
                    go = ~_dropped_all(keys[chunk[at]], start[at], start[at + 1], end, self.limit)
                else:
                    ends[at] = end
                    code = chunk[at].astype(np.int64) << 18 | _candidate(start[at], start[at + 1], end)
                    go = skipped[np.minimum(np.searchsorted(skipped, code), len(skipped) - 1)] != code if len(skipped) else np.ones(len(at), bool)
                where, pair = where[go], pair[go]
            rank[where], merged[where] = self.pair_rank[pair], self.pair_id[pair]
            return rank, merged

        rank, merged = np.full(len(symbol), NONE), np.zeros(len(symbol), np.int32)
        ends = np.zeros(len(symbol), np.int64)
        if len(symbol) > 1:
            rank[:-1], merged[:-1] = candidates(np.arange(len(symbol) - 1))
        while len(symbol):
            first = np.flatnonzero(np.concatenate(([True], chunk[1:] != chunk[:-1])))
            best = np.minimum.reduceat(rank * len(symbol) + np.arange(len(symbol)), first)
            more = best < NONE * len(symbol)
            size = np.diff(np.append(first, len(symbol)))
            ended = np.repeat(~more, size)
            if ended.any():
                done_symbol.append(symbol[ended])
                done_chunk.append(chunk[ended])
            at = best[more] % len(symbol)
            if taken is not None:
                taken.append((chunk[at], _candidate(start[at], start[at + 1], ends[at])))
            symbol[at] = merged[at]
            live = ~ended
            live[at + 1] = False
            new_place = np.cumsum(live) - 1
            at = new_place[at]
            symbol, chunk, start, rank, merged, ends = symbol[live], chunk[live], start[live], rank[live], merged[live], ends[live]
            if len(at):
                for place in (at, at[at > 0] - 1):
                    inner = place[place < len(symbol) - 1]
                    rank[inner], merged[inner] = candidates(inner)
                    rank[place[place == len(symbol) - 1]] = NONE
        symbol, chunk = (np.concatenate([np.zeros(0, np.int32), *x]) for x in (done_symbol, done_chunk))
        order = np.argsort(chunk, kind="stable")
        return self._spelled(symbol[order], chunk[order], len(chunks))

    def _spelled(self, symbol: np.ndarray, chunk: np.ndarray, chunks: int) -> tuple[np.ndarray, np.ndarray]:
        """Replace characters without a piece by the pieces of their bytes."""
        raw = symbol >= self.count
        if raw.any():
            letters = symbol - self.other
            for i in np.flatnonzero(raw & (symbol < self.other)):
                letters[i] = self.character_of[int(symbol[i])]
            spelled = [self.byte_ids[list(chr(c).encode("utf-8", "surrogatepass"))] for c in letters[raw].tolist()]
            width = np.ones(len(symbol), np.int64)
            width[raw] = [len(s) for s in spelled]
            out = np.repeat(symbol, width)
            out[np.repeat(raw, width)] = np.concatenate(spelled)
            symbol, chunk = out, np.repeat(chunk, width)
        return symbol.astype(np.int32), np.searchsorted(chunk, np.arange(chunks + 1))

    def _merges(self, words: list[str], skips: list[tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and taken merges of each word without the candidates it skips, and where those of each word begin."""
        ids, paths, begins, starts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
        for low in range(0, len(words), MERGED_CHUNKS):
            some = words[low : low + MERGED_CHUNKS]
            skipped = np.sort(np.array([i << 18 | c for i, skip in enumerate(skips[low : low + MERGED_CHUNKS]) for c in skip], np.int64))
            rounds: list = []
            found, begin = self.merge_all(some, None, skipped, rounds)
            ids.append(found)
            begins.append(begins[-1][-1] + begin[1:])
            of = np.concatenate([np.zeros(0, np.int64), *[r[0] for r in rounds]])
            paths.append(np.concatenate([np.zeros(0, np.int64), *[r[1] for r in rounds]])[np.argsort(of, kind="stable")])
            starts.append(starts[-1][-1] + np.cumsum(np.bincount(of, minlength=len(some))))
        return np.concatenate(ids), np.concatenate(begins), np.concatenate(paths), np.concatenate(starts)

    def _without_dropout(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``_merges`` of words that skip nothing; those of up to CACHED words stay for the batches to come."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > CACHED:
            self._forget()
            new = words
        if new:
            ids, begins, path, starts = self._merges(new, [()] * len(new))
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            old_ids, old_begins, old_path, old_starts = self.cached
            self.cached = (
                np.concatenate([old_ids, ids]), np.concatenate([old_begins, old_begins[-1] + begins[1:]]),
                np.concatenate([old_path, path]), np.concatenate([old_starts, old_starts[-1] + starts[1:]]),
            )
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        return (*_picked(*self.cached[:2], at), *_picked(*self.cached[2:], at))

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.cached = np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)

    def segment_all(self, words: list[str], word: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where in them the ids of each place begin and how many there are; ``word`` and ``keys`` by place.

        What a place skips matters only where the candidate would be taken.  So places start from the merges of their word without
        dropout; the first of these that a place skips leads it to the merges without that one, which agree up to there, and so
        on.  Each set of skipped candidates of a word is merged once.  A word with up to SELDOM places whose merges are not kept
        would save nothing by that: its places are merged by their keys.
        """
        out, first, size, total = [np.zeros(0, np.int32)], np.zeros(len(word), np.int64), np.zeros(len(word), np.int64), 0
        if not len(word):
            return out[0], first, size
        # nodes: a word, the candidates skipped so far (sorted), and the number of merges known to be taken
        kinds, node, places = np.unique(word, return_inverse=True, return_counts=True)
        seldom = (places <= SELDOM) & np.fromiter((words[w] not in self.known for w in kinds.tolist()), bool, len(kinds)) & bool(self.limit)
        alone = np.flatnonzero(seldom[node])
        for low in range(0, len(alone), MERGED_CHUNKS):
            some = alone[low : low + MERGED_CHUNKS]
            ids, begins = self.merge_all([words[w] for w in word[some].tolist()], keys[some])
            out.append(ids)
            first[some], size[some] = total + begins[:-1], np.diff(begins)
            total += len(ids)
        open_ = np.flatnonzero(~seldom[node])
        kinds, node = kinds[~seldom], (np.cumsum(~seldom) - 1)[node[open_]]
        nodes_word, nodes_skip, nodes_from = kinds, [()] * len(kinds), np.zeros(len(kinds), np.int64)
        while len(open_):
            spelled = [words[w] for w in nodes_word.tolist()]
            ids, begins, path, begin = self._without_dropout(spelled) if nodes_word is kinds else self._merges(spelled, nodes_skip)
            out.append(ids)
            first[open_], size[open_] = total + begins[:-1][node], np.diff(begins)[node]
            total += len(ids)
            if not self.limit:
                break
            # the first merge of its path that each place skips, one step of all paths at a time
            at, key = begin[node] + nodes_from[node], keys[open_]
            end, gone = begin[node + 1], np.full(len(open_), -1)
            walking = np.flatnonzero(at < end)
            while len(walking):
                c = path[at[walking]]
                skips = _dropped_all(key[walking], c >> 12, c >> 6 & 63, c & 63, self.limit)
                gone[walking[skips]] = at[walking[skips]]
                walking = walking[~skips]
                at[walking] += 1
                walking = walking[at[walking] < end[walking]]
            left = np.flatnonzero(gone >= 0)
            taken, at = np.unique(gone[left], return_inverse=True)
            parent = np.searchsorted(begin, taken, side="right") - 1
            nodes_skip = [nodes_skip[p] + (c,) for p, c in zip(parent.tolist(), path[taken].tolist(), strict=True)]
            nodes_word, nodes_from = nodes_word[parent], taken - begin[parent]
            open_, node = open_[left], at
        return np.concatenate(out), first, size

    # texts ---------------------------------------------------------------------------------------------------------

    def encode(self, texts: list[str | None], doc_keys: list[int]) -> list[np.ndarray]:
        """Ids of each text; null and empty texts have none."""
        flat, sizes = _cut([(" " + t).encode("utf-8", "surrogatepass") if t else b"" for t in texts])
        if not len(flat):
            return [np.zeros(0, np.int32) for _ in texts]
        flat = flat.dictionary_encode()
        number = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        salt = np.repeat(np.array(doc_keys, np.uint64), sizes) + number.astype(np.uint64) * np.uint64(K2)
        salt = (salt ^ (salt >> np.uint64(31))) * np.uint64(K1)
        spelled, word = flat.dictionary.to_pylist(), flat.indices.to_numpy().astype(np.int64)
        crc = np.fromiter(map(zlib.crc32, spelled), np.uint64, len(spelled))
        words = [w.decode("utf-8", "surrogatepass") for w in spelled]
        long = (np.fromiter(map(len, words), np.int64, len(words)) > LONG_CHUNK)[word]
        first, spread = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
        short = np.flatnonzero(~long)
        ids, first[short], spread[short] = self.segment_all(words, word[short], self.chunk_keys(crc[word[short]], salt[short]))
        parts, at = [ids], len(ids)
        alike: dict[int, tuple[int, int]] = {}
        for c in np.flatnonzero(long).tolist():
            w = int(word[c])
            if self.limit or w not in alike:
                parts.append(np.array(self.agenda(words[w], int(salt[c])), np.int32))
                alike[w] = at, len(parts[-1])
                at += len(parts[-1])
            first[c], spread[c] = alike[w]
        ids = np.concatenate(parts)
        ends = np.cumsum(spread)
        out = ids[np.repeat(first - (ends - spread), spread) + np.arange(ends[-1])]
        return np.split(out, np.concatenate(([0], ends))[np.cumsum(sizes)][:-1])

    def decode_all(self, ids: np.ndarray) -> bytes:
        """The bytes of all ids in a row."""
        width = self.byte_width[ids]
        ends = np.cumsum(width)
        if not len(ends):
            return b""
        return self.byte_pool[np.repeat(self.byte_begin[ids] - (ends - width), width) + np.arange(ends[-1])].tobytes()

    def decode(self, ids: Iterable[int]) -> str:
        """The text; the space that encoding puts in front is taken off."""
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "surrogatepass")
        return text[1:]


def _cut(texts: list[bytes]) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The chunks of all texts in a row, as CHUNK finds them, and how many each text has."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = b"".join(texts)
    letters = np.frombuffer(data, np.uint8)
    gap, feed = letters == GAP, letters == FEED
    begins = feed.copy()
    begins[1:] |= feed[:-1] | (gap[1:] & ~gap[:-1])
    ends = np.cumsum(sizes)
    begins[(ends - sizes)[sizes > 0]] = True
    at = np.flatnonzero(begins)
    chunks = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(data)).astype(np.int64)), pa.py_buffer(data)])
    return chunks, np.diff(np.searchsorted(at, np.append(0, ends)))


def _picked(values: np.ndarray, begin: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``at`` of ``values``, which begin at ``begin``, one after the other, and where each begins."""
    size = begin[at + 1] - begin[at]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(begin[at] - (ends - size), size) + np.arange(total)], np.concatenate(([0], ends))


SCHEMA = "doc_id long, n_tokens long, token_ids array<int>, lossless boolean"


def encode_documents(
    docs: DataFrame, model_file: str = MODEL_FILE, dropout: float = DROPOUT, seed: int = SEED, place: Sequence[str] = ()
) -> DataFrame:
    """Token ids of every whole text of ``docs(doc_id, text)``; ``lossless``: they decode to the text.

    A null or empty text has no tokens (and counts as lossless: it decodes to the empty text).  Repeated rows with equal
    doc_id are encoded alike, a null doc_id has a key of its own.  An empty table gives an empty result; further columns of
    ``docs`` are ignored, but the long columns ``place`` are kept and belong to the key as doc_id does.  The driver reads the model file; tasks get its bytes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Path(model_file).read_bytes())  # the file of a vocabulary

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(shared.value, dropout, seed)
            ids, sizes = batch.column("doc_id").to_pylist(), pc.utf8_length(batch.column("text")).fill_null(0).to_pylist()
            places = list(zip(*[batch.column(c).to_pylist() for c in ("doc_id", *place)], strict=True))
            at = 0
            while at < len(ids):
                end, size = at, 0
                while end < len(ids) and (end == at or size < BATCH_CHARACTERS):
                    size += sizes[end]
                    end += 1
                some = batch.column("text")[at:end].to_pylist()  # not all of a batch at once
                tokens = encoder.encode(some, [
                    int.from_bytes(blake2b(":".join(map(str, p)).encode(), digest_size=8).digest(), "little") for p in places[at:end]])
                ids_in_a_row = np.concatenate(tokens)
                same = [True] * len(some)
                if encoder.decode_all(ids_in_a_row) != "".join(" " + s for s in some if s).encode("utf-8", "surrogatepass"):
                    same = [encoder.decode(t.tolist()) == (s or "") for t, s in zip(tokens, some, strict=True)]
                offsets = np.concatenate(([0], np.cumsum([len(t) for t in tokens]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[at:end], pa.int64()), pa.array(np.diff(offsets).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids_in_a_row, pa.int32())), pa.array(same),
                    *[batch.column(c)[at:end] for c in place],
                ], names=["doc_id", "n_tokens", "token_ids", "lossless", *place])
                at = end

    return docs.select("doc_id", "text", *place).mapInArrow(run, ", ".join([SCHEMA, *[f"{c} long" for c in place]]))
