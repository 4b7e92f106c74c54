"""Byte-level BPE: pre-tokens of overlapping chunks, stitched where their boundaries agree, then merged by rank."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsieve.llm.shingles import mix, powers
from mailsieve.llm.streams import bounded_batches, slices

#: Code points of a chunk, and how far a chunk reads into the next one.
CHUNK, OVERLAP = 1 << 14, 256
#: Bytes of text, or of ids, worked on together.
SLICE = 1 << 19
#: A boundary is decided by at most so many characters after it.
MARGIN = 4
#: Pieces kept with their ids by a Python worker, none longer than so many bytes.
KEPT_PIECES, KEPT_BYTES = 150_000, 48
#: Pieces over so many bytes are merged with a heap, one by one.
LONG_PIECE = 128
_NEVER = np.int64(1 << 40)

# Fixed value: the pattern whose pieces follow from classes of neighbouring characters.
CLASS_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_OTHER, _LETTER, _NUMBER, _BLANK = range(4)
_SHORT_ENDINGS, _LONG_ENDINGS = "stmd", ("re", "ve", "ll")


@cache
def _classes() -> np.ndarray:
    """Class of every code point."""
    every = "".join(chr(i) if not 0xD800 <= i < 0xE000 else " " for i in range(0x110000))
    out = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_BLANK, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            out[m.start() : m.end()] = kind
    out[0xD800:0xE000] = _OTHER
    return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def class_starts(points: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Where the pieces of CLASS_PATTERN start, for texts that lie end to end from ``rows`` on.

    A run of one class is a piece.  A blank before a run belongs to it if it is a space; the blanks before
    that one are a piece.  An apostrophe that starts a piece takes the short endings.
    """
    n = len(points)
    kind = _classes()[points]
    first = np.zeros(n + 1, bool)
    first[rows] = True
    first = first[:n]
    turn = first.copy()
    turn[1:] |= kind[1:] != kind[:-1]
    blank = kind == _BLANK
    spaced = np.zeros(n, bool)
    spaced[1:] = (points[:-1] == 32) & ~first[1:]
    starts = turn & (blank | ~spaced)
    starts[:-1] |= blank[:-1] & ~blank[1:] & ~first[1:]
    marks = np.flatnonzero(starts & (points == 39))
    if len(marks):
        ends = rows[np.searchsorted(rows, marks, side="right")]
        ahead = [np.where(marks + k < ends, points[np.minimum(marks + k, n - 1)], 0) for k in (1, 2)]
        size = np.zeros(len(marks), np.int64)
        for ending in _LONG_ENDINGS:
            size[(ahead[0] == ord(ending[0])) & (ahead[1] == ord(ending[1]))] = 2
        size[np.isin(ahead[0], [ord(c) for c in _SHORT_ENDINGS])] = 1
        marks, ends, size = marks[size > 0], ends[size > 0], size[size > 0]
        starts[marks + 1] = False
        after = marks + 1 + size
        starts[after[after < ends]] = True
    return starts


_BYTE_MARKS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _by_content(raw: bytes, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An example of each distinct piece and which each piece is, should two have had one hash."""
    seen: dict[bytes, int] = {}
    one: list[int] = []
    which = np.empty(len(starts), np.int64)
    for i, (a, n) in enumerate(zip(starts.tolist(), sizes.tolist(), strict=True)):
        which[i] = seen.setdefault(raw[a : a + n], len(one))
        if which[i] == len(one):
            one.append(i)
    return np.array(one), which


class Coder:
    """Encoder and decoder for one rank file (lines of base64 token, blank, rank) and pre-token pattern."""

    def __init__(self, ranks: bytes, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> None:
        lines = (line.split() for line in ranks.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.split = None if pattern == CLASS_PATTERN else regex.compile(pattern).findall
        self.chunk, self.overlap = chunk, overlap
        self.kept: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.byte_pairs = np.array(
            [self.ranks.get(bytes([a, b]), _NEVER) for a in range(256) for b in range(256)], np.int64)

    @cached_property
    def merges(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of ids that merge, sorted, and the id each merges to; only encoding needs them."""
        pairs = {
            (self.ranks[t[:k]] << 32) + self.ranks[t[k:]]: rank for t, rank in self.ranks.items()
            for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks}
        keys = np.sort(np.fromiter(pairs, np.int64, len(pairs)))
        return keys, np.array([pairs[x] for x in keys.tolist()], np.int64)

    def _runs(self, parts: list[str]) -> list[np.ndarray]:
        """For each text by itself, where its pieces start, and its length."""
        if self.split is not None:
            return [np.cumsum([0, *map(len, self.split(part))]) for part in parts]
        sizes = [len(p) for p in parts]
        rows = np.concatenate([[0], np.cumsum(sizes)])
        starts = np.flatnonzero(class_starts(code_points("".join(parts)), rows)) if rows[-1] else np.empty(0, np.int64)
        own = np.split(starts, np.searchsorted(starts, rows[1:-1]))
        return [np.append(x - a, n) for x, a, n in zip(own, rows[:-1], sizes, strict=True)]

    def bounds(self, texts: list[str]) -> list[np.ndarray]:
        """For each text, where the matches of the pattern start, and its length.

        Texts are cut into chunks that reach into the next one, and all chunks are matched independently.
        Matching looks ahead only, so two runs that share a boundary agree from there on; a run is sure up to
        MARGIN characters before its end, where the cut may tell.  A chunk's run is left for the next one's at
        the first sure boundary both have; if the overlap has none, the next chunk is matched again from the
        last sure one (a piece over many chunks, whenever what is left has doubled).
        """
        step = self.chunk + self.overlap
        starts = [range(0, max(len(t) - self.overlap, 1), self.chunk) for t in texts]
        runs = iter(self._runs([t[a : a + step] for t, own in zip(texts, starts, strict=True) for a in own]))
        return [
            self._stitch(text, list(own), [next(runs) + a for a in own]) for text, own in zip(texts, starts, strict=True)]

    def _stitch(self, text: str, starts: list[int], runs: list[np.ndarray]) -> np.ndarray:
        n, step = len(text), self.chunk + self.overlap
        kept, at, run, stop = [], 0, runs[0], min(step, n)
        for a, later in zip(starts[1:], runs[1:], strict=True):
            sure = run[(run >= at) & (run < stop - MARGIN)]
            met = sure[(sure >= a) & np.isin(sure, later)]
            end = min(a + step, n)
            if len(met):
                kept.append(run[(run >= at) & (run < met[0])])
                at, run, stop = int(met[0]), later, end
            elif len(sure) > 1 or end == n or end - at > 2 * (stop - at):
                last = int(sure[-1]) if len(sure) else at
                kept.append(run[(run >= at) & (run < last)])
                at, run, stop = last, self._runs([text[last:end]])[0] + last, end
        return np.concatenate([*kept, run[run >= at]])

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, which is the id of what it merges to."""
        keys, merged = self.merges
        wanted = (left << 32) + right
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, merged[at], _NEVER)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece: its adjacent pair of least rank is merged, leftmost first, while there is one.

        All pieces are worked on together, one merge of each in a round; the heap takes long ones.
        """
        out = [b"" if p not in self.ranks else self.ranks[p].to_bytes(4, "little") for p in pieces]
        short = []
        for i, piece in enumerate(pieces):
            if not out[i] and piece:
                if len(piece) > LONG_PIECE:
                    out[i] = np.array(self._merge_long(piece), "<u4").tobytes()
                else:
                    short.append(i)
        own = [pieces[i] for i in short]
        ids, ends = self._rounds(
            np.frombuffer(b"".join(own), np.uint8), np.repeat(np.arange(len(own)), [len(p) for p in own]))
        data, at = ids.astype("<u4").tobytes(), 0
        for i, end in zip(short, (4 * ends).tolist(), strict=True):
            out[i] = data[at:end]
            at = end
        return out

    def _rounds(self, data: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged ids of pieces whose bytes lie end to end, and where each piece's end."""
        if not len(data):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        ids, rank = self.bytes[data], np.full(len(data), _NEVER)
        rank[:-1] = np.where(owner[1:] == owner[:-1], self.byte_pairs[data[:-1] * np.int64(256) + data[1:]], _NEVER)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            least = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(ids))))
            over = least == _NEVER
            if over.any():
                done.append((owner[over], ids[over]))
                ids, owner, rank, least = ids[~over], owner[~over], rank[~over], least[~over]
            hit = np.flatnonzero(rank == least)
            hit = hit[np.concatenate([[True], owner[hit[1:]] != owner[hit[:-1]]])] if len(hit) else hit
            ids[hit] = rank[hit]
            stay = np.ones(len(ids), bool)
            stay[hit + 1] = False
            ids, owner, rank = ids[stay], owner[stay], rank[stay]
            new = hit - np.arange(len(hit))
            rank[new] = _NEVER
            for left in (new[new + 1 < len(ids)], new[new > 0] - 1):
                left = left[owner[left] == owner[left + 1]]
                rank[left] = self._pair_ranks(ids[left], ids[left + 1])
        owner, ids = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(owner, kind="stable")
        return ids[order], np.cumsum(np.bincount(owner))

    def _merge_long(self, piece: bytes) -> list[int]:
        ranks, n = self.ranks, len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)

        def offer(i: int) -> None:
            if i >= 0 and (mid := after[i]) < n and (r := ranks.get(piece[i : after[mid]])) is not None:
                heapq.heappush(heap, (r, i, after[mid]))

        while heap:
            _, i, end = heapq.heappop(heap)
            mid = after[i] if alive[i] else n
            if mid >= n or after[mid] != end:
                continue
            alive[mid], after[i] = False, end
            if end < n:
                before[end] = i
            offer(i)
            offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : after[i]]])
            i = after[i]
        return out

    def _coded(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, those of short ones kept for later; of two generations the older one goes."""
        if len(self.kept) > KEPT_PIECES:
            self.old, self.kept = self.kept, {}
        kept, old = self.kept, self.old
        out = [kept.get(p) or old.get(p) for p in pieces]
        fresh = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(fresh, self.merge([pieces[i] for i in fresh]), strict=True):
            out[i] = ids
            if len(pieces[i]) <= KEPT_BYTES:
                self.kept[pieces[i]] = ids
        return out

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers.

        Pieces of all texts are told apart by a hash (checked byte by byte), and only distinct ones are merged.
        """
        whole = "".join(texts)
        if not whole:
            return [b""] * len(texts)
        bounds = self.bounds(texts)
        begins = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        starts = np.concatenate([b[:-1] + a for b, a in zip(bounds, begins[:-1], strict=True)])
        raw = whole.encode()
        if len(raw) > len(whole):
            points = code_points(whole)
            widths = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
            starts = np.concatenate([[0], np.cumsum(widths)])[starts]
        data = np.frombuffer(raw, np.uint8)
        sizes = np.diff(np.append(starts, len(data)))
        place = np.arange(len(data), dtype=np.int32) - np.repeat(starts.astype(np.int32), sizes)
        marks = np.add.reduceat(_BYTE_MARKS[data] * powers(int(sizes.max()))[place], starts)
        _, one, which = np.unique(mix(marks ^ sizes.astype(np.uint64)), return_index=True, return_inverse=True)
        like = starts[one][which]
        same = np.minimum(np.repeat(like.astype(np.int32), sizes) + place, len(data) - 1)
        if (sizes != sizes[one][which]).any() or (data != data[same]).any():
            one, which = _by_content(raw, starts, sizes)
        coded = self._coded([raw[a : a + n] for a, n in zip(starts[one].tolist(), sizes[one].tolist(), strict=True)])
        counts = np.array([len(x) // 4 for x in coded])
        flat, own = np.frombuffer(b"".join(coded), "<u4"), counts[which]
        ends = np.concatenate([[0], np.cumsum(own)])
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])[which]
        ids = flat[np.arange(ends[-1]) + np.repeat(first - ends[:-1], own)].tobytes()
        cuts = 4 * ends[np.concatenate([[0], np.cumsum([len(b) - 1 for b in bounds])])]
        return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    @cached_property
    def token_bytes(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all tokens end to end, and where each starts; the ids after the last token have none."""
        starts = np.cumsum([0, *map(len, self.tokens)])
        return np.frombuffer(b"".join(self.tokens), np.uint8), starts

    def decode_flat(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of a run of ids, reserved ones empty, and where the bytes of each id start."""
        data, starts = self.token_bytes
        known = np.minimum(ids, len(self.tokens))
        sizes = np.append(np.diff(starts), 0)[known]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(ends[-1]) + np.repeat(starts[known] - ends[:-1], sizes)
        return data[at], ends

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode_all(self, rows: list[bytes]) -> list[bytes]:
        return [self.decode(ids) for ids in rows]


_CODERS: dict[tuple[int, str], Coder] = {}


def coder_for(ranks: bytes, pattern: str) -> Coder:
    """One coder for each vocabulary in a Python worker."""
    key = (hash(ranks), pattern)
    if key not in _CODERS:
        _CODERS[key] = Coder(ranks, pattern)
    return _CODERS[key]


def _map_column(
    df: DataFrame, source: str, steps: list[tuple[str, str]], ranks: str, pattern: str, keep_source: bool = True,
) -> DataFrame:
    """``df`` with a binary column for each of ``steps`` (column, method of the coder), the first from ``source`` and
    every other from the one before; the vocabulary file is read by the driver."""
    with open(ranks, "rb") as file:
        shared = df.sparkSession.sparkContext.broadcast(file.read())
    targets = [name for name, _ in steps]
    names = [c for c in df.columns if c not in targets]
    stays = [c for c in names if keep_source or c != source]
    at = names.index(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_for(shared.value, pattern)
        for batch in batches:
            for part in slices(batch, names[at], SLICE):
                given = part.column(at).to_pylist()
                rows, made = [x for x in given if x is not None], []
                for _, work in steps:
                    rows = getattr(coder, work)(rows)
                    found = iter(rows)
                    made.append(pa.array([None if x is None else next(found) for x in given], pa.binary()))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in stays], *made], [*stays, *targets])

    schema = df.select(stays).schema
    for name in targets:
        schema = schema.add(name, "binary")
    return bounded_batches(df.select(names)).mapInArrow(run, schema)


def encode(df: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with column ``ids``: the tokens of each whole text, 4 bytes each, little-endian.

    ``ranks`` is a rank file and ``pattern`` its pre-token pattern.  No special tokens.  Null stays null,
    empty is empty; other columns stay (one called ``ids`` is replaced).  Rows never move: each is encoded
    where it is read, in chunks, so that only the text and its ids are held; a lost task is simply repeated.
    """
    return _map_column(df, text, [(ids, "encode_all")], ranks, pattern)


def decode(df: DataFrame, ranks: str, pattern: str, ids: str = "ids", data: str = "decoded") -> DataFrame:
    """``df`` with column ``data``: the tokens' raw bytes, end to end; null stays null."""
    return _map_column(df, ids, [(data, "decode_all")], ranks, pattern)


def round_trip(
    df: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids", data: str = "decoded",
) -> DataFrame:
    """``df`` without its texts, with what ``encode`` and then ``decode`` give, in one pass.

    A task has one Python worker with one coder for both; nulls, other columns and bounds are as there.
    """
    return _map_column(df, text, [(ids, "encode_all"), (data, "decode_all")], ranks, pattern, keep_source=False)


def round_trip_digest(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every text of ``docs``; a null text is empty."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return round_trip(texts, ranks, pattern).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
