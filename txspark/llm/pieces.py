"""SentencePiece encoding and decoding with merge-type vocabularies."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "\u2581"
#: Chunks and parts of chunks whose ids a worker remembers, each, and the longest of them.
REMEMBERED, LONGEST = 400_000, 48
#: Characters of text that a task encodes at a time; a text is never cut.
SLICE_CHARS = 4_000_000


class Merges:
    """A merge-type (BPE) vocabulary: pieces with scores, read from a ``.model`` file.

    Only identity normalisation and plain pieces are supported, that is, no user-defined or unused ones; other models are refused.
    """

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kind, norm, trainer = sentencepiece_model_pb2.ModelProto.SentencePiece, model.normalizer_spec, model.trainer_spec
        if trainer.model_type != trainer.BPE:
            raise ValueError(f"{path} is no merge-type model")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or trainer.treat_whitespace_as_suffix:
            raise ValueError(f"{path} normalises text in a way that is not supported")
        if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces):
            raise ValueError(f"{path} has user-defined or unused pieces, which are not supported")
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.dummy = norm.add_dummy_prefix
        # inside, a plain space stands for its mark: short strings then have a byte for each character
        self.ids = {p.piece.replace(SPACE, " "): i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
        self.costs = {p.piece.replace(SPACE, " "): -p.score for p in model.pieces if p.type == kind.NORMAL}
        self.unknown = trainer.unk_id
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kind.BYTE} if trainer.byte_fallback else {}
        self.bytes = {i: b for b, i in self.byte_ids.items()}
        self.is_byte = np.zeros(len(model.pieces), bool)
        self.is_byte[list(self.bytes)] = True
        self.control = {i for i, p in enumerate(model.pieces) if p.type == kind.CONTROL}
        self.surfaces = [trainer.unk_surface if p.type == kind.UNKNOWN else "" if p.type in (kind.CONTROL, kind.BYTE) else p.piece.replace(SPACE, " ") for p in model.pieces]
        #: Characters that are neighbours in some piece; between any others no merge is possible.
        self.joined = {a + b for p in self.ids for a, b in zip(p, p[1:], strict=False)}
        # a space after another character starts a chunk of its own, unless some piece spans the two
        spans = any(pair[1] == " " != pair[0] for pair in self.joined)
        self.chunks = re.compile("(?s).+" if spans else " +[^ ]*|[^ ]+")
        self.known: dict[str, bytes] = {}  # ids as int32
        self.parts: dict[str, bytes] = {}
        self._tabulate(len(model.pieces))
        self.differing: set[str] = set()

    def split(self, text: str) -> list[str]:
        """The normalised text in chunks that no piece spans."""
        return self.chunks.findall((" " if self.dummy and text else "") + text.replace(SPACE, " "))

    def merge(self, chunk: str) -> list[str]:
        """Pieces of a chunk: of all adjacent pairs of symbols that form a piece, that of the best score is merged first, the leftmost of equals."""
        symbols, n, costs = list(chunk), len(chunk), self.costs
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        agenda = [(costs[pair], i, i + 1, 2) for i, pair in enumerate(map("".join, zip(symbols, symbols[1:], strict=False))) if pair in costs]
        heapify(agenda)
        while agenda:
            _, left, right, size = heappop(agenda)
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != size:
                continue  # a symbol of the pair has been merged since
            symbols[left] += symbols[right]
            symbols[right] = ""
            further, earlier = after[right], before[left]
            after[left] = further
            if further >= 0:
                before[further] = left
                pair = symbols[left] + symbols[further]
                if pair in costs:
                    heappush(agenda, (costs[pair], left, further, len(pair)))
            if earlier >= 0:
                pair = symbols[earlier] + symbols[left]
                if pair in costs:
                    heappush(agenda, (costs[pair], earlier, left, len(pair)))
        return [s for s in symbols if s]

    def _tabulate(self, n: int) -> None:
        """Tables for ``merge_short``: symbols by code point, and cost and merged symbol of each pair of symbols that forms a piece.

        Symbols are ids of pieces, then the characters that are pieces only together with others, then one for all other characters.
        """
        symbols = dict(self.ids)
        for c in sorted({c for p in self.ids for c in p} - symbols.keys()):
            symbols[c] = n + len(symbols) - len(self.ids)
        self.n_pieces, self.other = n, n + len(symbols) - len(self.ids)
        self.symbol_of = np.full(0x110000, self.other, np.int32)
        for c, k in symbols.items():
            if len(c) == 1:
                self.symbol_of[ord(c)] = k
        pairs = [(symbols[p[:k]] * (self.other + 1) + symbols[p[k:]], i, self.costs[p]) for p, i in self.ids.items() for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols]
        pairs.sort()
        self.pair_keys = np.array([k for k, _, _ in pairs] + [2**62], np.int64)
        self.pair_pieces = np.array([i for _, i, _ in pairs] + [0], np.int32)
        self.pair_costs = np.array([c for _, _, c in pairs] + [0], np.float32)
        pairs_of = np.array([(ord(a) << 21) | ord(b) for a, b in self.joined] or [-1], np.int64)
        self.joined_keys = np.append(np.sort(pairs_of), 2**62)

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cost and merged symbol of pairs of symbols; infinite where they form no piece."""
        key = left.astype(np.int64) * (self.other + 1) + right
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_costs[at], np.float32(np.inf)), self.pair_pieces[at]

    def merge_short(self, parts: list[str]) -> list[bytes]:
        """Ids of parts of one length: ``merge`` with a row of costs as the agenda of each part, whose first lowest cost is merged, in all rows at once."""
        size, gone = len(parts[0]), -1
        sym = self.symbol_of[np.array(parts, f"U{size}").view(np.uint32).reshape(-1, size)]
        after = np.tile(np.arange(1, size + 1), (len(parts), 1))
        before = np.tile(np.arange(-1, size - 1), (len(parts), 1))
        cost, merged = self._look_up(sym[:, :-1], sym[:, 1:])
        live = np.arange(len(parts)) if size > 1 else np.zeros(0, np.int64)
        while len(live):
            j = cost[live].argmin(axis=1)
            open_ = np.isfinite(cost[live, j])
            live, j = live[open_], j[open_]
            right = after[live, j]
            sym[live, j] = merged[live, j]
            sym[live, right] = gone
            further = after[live, right]
            after[live, j] = further
            cost[live, j] = np.inf
            inner = right < size - 1  # the right symbol had an agenda entry of its own
            cost[live[inner], right[inner]] = np.inf
            has = further < size
            r, c, f = live[has], j[has], further[has]
            before[r, f] = c
            cost[r, c], merged[r, c] = self._look_up(sym[r, c], sym[r, f])
            earlier = before[live, j]
            has = earlier >= 0
            r, c, e = live[has], j[has], earlier[has]
            cost[r, e], merged[r, e] = self._look_up(sym[r, e], sym[r, c])
        left = sym != gone
        flat, ends = sym[left].astype(np.int32), np.cumsum(left.sum(axis=1))
        data, plain = flat.tobytes(), ((sym < self.n_pieces).all(axis=1)).tolist()
        starts = [0, *(4 * ends[:-1]).tolist()]
        return [data[a:b] if ok else self._ids_of(part) for a, b, ok, part in zip(starts, (4 * ends).tolist(), plain, parts, strict=True)]

    def _ids_of(self, part: str) -> bytes:
        """Ids of a part through ``merge``, with bytes or the unknown id for symbols beyond the vocabulary."""
        ids: list[int] = []
        for piece in self.merge(part):
            known = self.ids.get(piece)
            if known is not None:
                ids.append(known)
            else:
                ids += [self.byte_ids[b] for b in piece.encode()] if self.byte_ids else [self.unknown]
        return array("i", ids).tobytes()

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks as int32, from those of their parts, which no piece spans either."""
        whole = "".join(chunks)
        points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        key = (points[:-1] << 21) | points[1:]
        cut = self.joined_keys[np.searchsorted(self.joined_keys, key)] != key
        ends = np.cumsum([len(c) for c in chunks])
        cut[ends[:-1] - 1] = True
        bounds = [0, *(np.flatnonzero(cut) + 1).tolist(), len(whole)]
        cut_parts = [whole[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        known, long = self.parts, {}
        by_size: dict[int, list[str]] = {}
        for part in dict.fromkeys(p for p in cut_parts if p not in known):
            if len(part) <= LONGEST:
                by_size.setdefault(len(part), []).append(part)
            else:
                long[part] = self._ids_of(part)
        for parts in by_size.values():
            known.update(zip(parts, self.merge_short(parts), strict=True))
        ids = [known[p] if p in known else long[p] for p in cut_parts]
        of = np.searchsorted(bounds, np.append(0, ends)).tolist()
        return [ids[a] if b == a + 1 else b"".join(ids[a:b]) for a, b in zip(of, of[1:], strict=False)]

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts, one after the other, and where each text begins and ends. Chunks that this worker has not met are encoded and checked
        against the library in one call."""
        cut = [self.split(t) for t in texts]
        known = self.known
        for memory in (known, self.parts):
            if len(memory) > REMEMBERED:
                memory.clear()
        fresh = {c for c in chain.from_iterable(cut) if c not in known}
        long = {}
        if fresh:
            fresh = list(fresh)
            coded = dict(zip(fresh, self.encode_chunks(fresh), strict=True))
            first = int(self.dummy)  # which the library adds itself; all chunks start with it then
            for (c, ids), want in zip(coded.items(), self.library.encode([c[first:] for c in coded], num_threads=1), strict=True):
                if len(c) > first and ids != array("i", want).tobytes():
                    self.differing.add(c)
                (known if len(c) <= LONGEST else long)[c] = ids
        ids_of = (lambda c: known[c] if c in known else long[c]) if long else known.__getitem__
        coded_texts = [b"".join(map(ids_of, cs)) for cs in cut]
        ends = np.concatenate([[0], np.cumsum([len(b) >> 2 for b in coded_texts], dtype=np.int64)])
        return np.frombuffer(b"".join(coded_texts), np.int32), ends

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        ids, ends = self.encode_all(texts)
        return [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def agrees(self, text: str) -> bool:
        """Whether the library gave the same ids for every chunk of the text."""
        return not self.differing or self.differing.isdisjoint(self.split(text))

    def decode(self, ids: list[int], plain: bool = False) -> str:
        """Text of ids. Runs of byte pieces are UTF-8, with U+FFFD for each byte that is none; ``plain`` tells that there are no byte pieces.

        The space that starts the first piece with text is the one that encoding put there, and goes.
        """
        if plain:
            out = "".join(map(self.surfaces.__getitem__, ids))
            first = next((i for i in ids if i not in self.control), self.unknown)
            return out[1:] if self.dummy and first != self.unknown and out.startswith(" ") else out
        parts: list[str] = []
        run, begun = bytearray(), not self.dummy
        for i in ids:
            if i in self.bytes:
                run.append(self.bytes[i])
                continue
            if run:
                parts.append(from_utf8(bytes(run)))
                run.clear()
                begun = True
            surface = self.surfaces[i]
            if not begun and i != self.unknown and surface.startswith(" "):
                surface, begun = surface[1:], True
            parts.append(surface)
            begun = begun or surface != ""
        return "".join([*parts, from_utf8(bytes(run))])


def from_utf8(data: bytes) -> str:
    """Text of bytes, with U+FFFD for each byte that starts no whole character."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(data):
        for size in range(1, 5):
            try:
                out.append(data[at : at + size].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("\ufffd")
            size = 1
        at += size
    return "".join(out)


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    """The vocabulary of a file, read once by a worker."""
    return Merges(path)


def _ranges(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` characters together."""
    at = 0
    ends = np.cumsum(sizes)
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        yield at, to
        at = to


def encode_texts(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids (array), decoded (the text of the ids) and agrees, of every whole text.

    Text is cut where no piece of the vocabulary spans two characters, first at spaces, so that a chunk is coded alone: an agenda holds its adjacent
    pairs of symbols that form a piece by score, then place; the best is merged and its new neighbours enter the agenda. Symbols
    beyond the vocabulary become bytes, or the unknown id. A worker remembers the ids of short chunks. What it codes anew in an Arrow batch is checked
    against the library in one call, and ``agrees`` tells whether the library gave the same for all chunks of a text.

    Null text counts as empty: no ids, empty decoded text. Repeated rows are coded each; other columns are ignored; an empty table gives none.
    """

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = merges(model_path)
        for batch in batches:
            text = batch.column("text")
            for start, end in _ranges(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False), SLICE_CHARS):
                texts = [t or "" for t in text.slice(start, end - start).to_pylist()]
                flat, ends = model.encode_all(texts)
                in_bytes = np.concatenate([[0], np.cumsum(model.is_byte[flat])])
                plain = in_bytes[ends[1:]] == in_bytes[ends[:-1]]
                decoded = [model.decode(flat[a:b].tolist(), p) for a, b, p in zip(ends[:-1], ends[1:], plain, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, end - start), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)), pa.array(decoded, pa.string()), pa.array([model.agrees(t) for t in texts])],
                    names=["doc_id", "ids", "decoded", "agrees"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(coded, "doc_id long, ids array<int>, decoded string, agrees boolean")
