"""SentencePiece encoding with seeded merge-dropout, and decoding.

The vocabulary is a merge-type (BPE) SentencePiece model file, given by path and
read with the sentencepiece library in each task; segmentation with skips is done here.
White space is a visible mark, and no piece holds a mark after another
character, so a text splits into chunks (marks, then characters without marks)
that never merge across; a line break is a chunk. Within a chunk an agenda holds the candidate merges,
best piece first, leftmost first among equals; a candidate that comes up is
skipped with probability ``dropout``, decided by a hash keyed by the seed, the
document's id, the chunk's place in the document and the candidate's turn in the
agenda. A skipped candidate is gone unless a neighbouring merge makes it anew. So
every occurrence of a word is segmented by itself. The hash is drawn as the
number of candidates up to the next skipped one, which has the same
distribution; a chunk and the turns that are skipped in it say what comes out,
so results are cached under these without any effect on them. Chunks of pieces, which are nearly all, go through
the agenda many at a time: in each step every chunk of a block makes or skips its own best candidate.

Decoding joins the pieces' bytes, and is exact for any dropout: unknown
characters are bytes (the model has byte pieces), and so is the mark U+2581 where a text
itself holds it. With dropout 0 the result equals the library's own for texts that
its normaliser leaves as they are and that do not hold the mark.

Defined cases: a null text is encoded as the empty text, which has no pieces; a
null id is a key of its own; repeated rows get equal results; an empty table
gives an empty result; characters that the model's normaliser would change are
left as they are; other columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.llm.common import text_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 7
VARIANTS = 2  # documents whose skips ``Pieces.segments`` shows; in use, every document has its own
LONG = 64  # code points of a chunk that is cached and takes the short way
CACHED = 300_000  # entries per generation, of chunks and of chunks with skips
TURNS = 255  # the most candidates between two skips that one draw tells apart; longer ways take more draws
MIX, WORD = 0x9E3779B97F4A7C15, 2**64 - 1
BLOCK = 8192  # chunks that go through the agenda together
TOGETHER = 1_000_000  # characters of texts that are encoded together, of one text at least
MARK = "▁"
OWN_MARK = "\udc81"  # stands for a mark in the text itself; no text holds it, as it is half a character
CHUNK = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")


class Generations(dict):
    """Results by key. Bounded: a full generation is set aside, and dropped when the next one is full."""

    def __init__(self, make):
        super().__init__()
        self.make, self.before = make, {}

    def __missing__(self, key):
        found = self.before.get(key)
        return self.put(key, self.make(key) if found is None else found)

    def put(self, key, found):
        if len(self) >= CACHED:
            self.before = dict(self)
            self.clear()
        self[key] = found
        return found

    def known(self, key):
        """What is kept under a key, or None."""
        found = self.get(key)
        if found is None and (found := self.before.get(key)) is not None:
            self.put(key, found)
        return found


def mixed(x):
    """The finaliser of SplitMix64, of numpy's numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def rehashed(x: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of numbers as their eight little-endian bytes."""
    p1, p2, p3, p4, p5 = map(np.uint64, (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5,
    ))

    def turned(v: np.ndarray, n: int) -> np.ndarray:
        return (v << np.uint64(n)) | (v >> np.uint64(64 - n))

    with np.errstate(over="ignore"):
        h = np.uint64((seed + int(p5) + 8) & WORD) ^ (turned(x * p2, 31) * p1)
        h = turned(h, 27) * p1 + p4
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        return h ^ (h >> np.uint64(32))


class Draws:
    """The gaps of many chunks: as ``Skips.gaps`` gives them, one per call and chunk asked for."""

    def __init__(self, pieces: Pieces, keys: np.ndarray):
        self.levels, self.turns, self.seed = pieces.level_array, pieces.turns, pieces.seed & WORD
        self.keys, self.second = keys.copy(), np.zeros(len(keys), bool)

    def one(self, rows: np.ndarray) -> np.ndarray:
        key, second = self.keys[rows], self.second[rows]
        half = np.where(second, key >> np.uint64(32), key & np.uint64(0xFFFFFFFF))
        self.keys[rows[second]] = rehashed(key[second], self.seed)
        self.second[rows] = ~second
        return self.turns - np.searchsorted(self.levels, half, "right")

    def next(self, rows: np.ndarray) -> np.ndarray:
        gaps = self.one(rows)
        more = np.flatnonzero(gaps == self.turns) if self.turns else np.array([], int)
        while len(more):  # more than any chunk here has candidates need not be told apart
            drawn = self.one(rows[more])
            gaps[more] += drawn
            more = more[(drawn == self.turns) & (gaps[more] <= LONG)]
        return gaps


class Skips:
    """The skips of one document: by a chunk's place, the candidates that are kept before each skipped one."""

    def __init__(self, pieces: Pieces, name: int):
        self.pieces = pieces
        self.key = np.uint64(xxhash.xxh64_intdigest(f"{pieces.seed}:{name}"))

    def keys(self, n: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed(self.key + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(MIX))

    def gaps(self, key: int) -> Iterator[int]:
        """All gaps of the chunk with this key; two come from each hash, a gap of ``TURNS`` goes on with the next."""
        levels, n, run = self.pieces.levels, self.pieces.turns, 0
        while True:
            for half in (key & 0xFFFFFFFF, key >> 32):
                gap = n - bisect.bisect_right(levels, half)
                run += gap
                if gap < n or not n:
                    yield run
                    run = 0
            key = xxhash.xxh64_intdigest(key.to_bytes(8, "little"), self.pieces.seed & WORD)

    def first(self, keys: np.ndarray) -> np.ndarray:
        """The first gap of each key, at most ``TURNS``."""
        at = np.searchsorted(self.pieces.level_array, keys & np.uint64(0xFFFFFFFF), "right")
        return (self.pieces.turns - at).astype(np.uint64)

    @cached_property
    def drops(self) -> list[bytes]:
        """By place of a chunk and turn of a candidate: 1 where it is skipped. For looking at them."""
        if not self.pieces.limit:
            return []
        rows = []
        for key in self.keys(LONG).tolist():
            row, at, gaps = bytearray(2048), -1, self.gaps(key)
            while (at := at + 1 + next(gaps)) < len(row):
                row[at] = 1
            rows.append(bytes(row))
        return rows


class Pieces:
    """A model's pieces: the agenda's order is by score, so pieces are known by their rank in it."""

    def __init__(self, model: str, dropout: float, seed: int):
        import sentencepiece

        processor = self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        n = processor.get_piece_size()
        self.limit = int(dropout * 2**32)
        self.seed = seed
        self.bytes_of: list[bytes] = [b""] * n
        self.byte_ids = [0] * 256
        scores: dict[str, tuple[float, int]] = {}
        for i in range(n):
            piece = processor.id_to_piece(i)
            if processor.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_ids[value] = i
                self.bytes_of[i] = bytes([value])
            elif not (processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i)):
                scores[piece] = (-processor.get_score(i), i)
                self.bytes_of[i] = piece.replace(MARK, " ").encode()
        self.bytes = set(self.byte_ids)
        self.spellings = pa.array(self.bytes_of, pa.large_binary())
        self.starting = np.array([processor.id_to_piece(i).startswith(MARK) for i in range(n)])
        if any(a != MARK == b for p in scores for a, b in zip(p, p[1:])) or any("\n" in p for p in scores):
            raise ValueError("pieces that go across white space are not supported")
        ordered = sorted(scores, key=scores.get)
        self.rank = {piece: k for k, piece in enumerate(ordered)}
        self.none = len(ordered)
        self.coded = {piece: np.array([i], "<i4").tobytes() for piece, (_, i) in scores.items()}
        # Pairs of pieces that merge, by the ranks of both; characters by their rank, where they are pieces.
        rank, pairs = self.rank, {}
        for piece, k in rank.items():
            for cut in range(1, len(piece)):
                a, b = rank.get(piece[:cut]), rank.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = k
        self.pairs = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[x] for x in self.pairs.tolist()] + [self.none], np.int64)
        self.single = np.full(0x110000, -1, np.int32)
        for piece, k in rank.items():
            if len(piece) == 1:
                self.single[ord(piece)] = k
        self.id_of = np.array([scores[piece][1] for piece in ordered], "<i4")
        # A 32-bit hash below the j-th level from above: j candidates and more are kept before a skipped one.
        levels = [int((1 - dropout) ** j * 2**32) for j in range(TURNS, 0, -1)]
        self.levels = [x for x in levels if x]
        self.level_array = np.array(self.levels, np.uint64)
        self.turns = len(self.levels)
        self.plain, self.skipped = Generations(self.whole), Generations(self.after)
        self.segments = [Skips(self, v) for v in range(VARIANTS if self.limit else 1)]

    def whole(self, chunk: str) -> tuple[int, bytes]:
        """Without skips: the candidates that come up, and the ids."""
        return self.after((chunk,))

    def after(self, key: tuple) -> tuple[int, bytes]:
        """A chunk with the gaps before its skips: the candidates that come up after the last one, and the ids."""
        chunk, *gaps = key
        parts = self.short(chunk, gaps)
        return len(chunk) - len(parts) - sum(gaps), self.coded_parts(parts)

    def skipping(self, chunk: str, gaps: Iterator[int]) -> bytes:
        """Ids of one occurrence of a chunk: what is known of its gaps, or one run of the agenda."""
        if len(chunk) > LONG:
            return self.coded_parts(self.long(chunk, gaps))
        key, (left, found) = (chunk,), self.plain[chunk]
        while (gap := next(gaps)) < left:
            key += (gap,)
            known = self.skipped.known(key)
            if known is None:
                return self.run(key, gaps)
            left, found = known
        return found

    def run(self, key: tuple, gaps: Iterator[int]) -> bytes:
        """A chunk with the gaps of ``key`` and then those of ``gaps``; what came out is kept under all that were used."""
        chunk, *drawn = key

        def each() -> Iterator[int]:
            yield from key[1:]
            for gap in gaps:
                drawn.append(gap)
                yield gap

        parts = self.short(chunk, each())
        used = drawn[:-1]  # the last one was not reached
        found = self.coded_parts(parts)
        if len(used) < 3:
            self.skipped.put((chunk, *used), (len(chunk) - len(parts) - sum(used), found))
        return found

    def short(self, chunk: str, gaps: Iterable[int]) -> list[str]:
        """The agenda as a list of the ranks of neighbouring pairs. ``gaps``: the candidates that are
        kept before each skipped one."""
        gaps = iter(gaps)
        keep = next(gaps, -1)
        rank, none = self.rank.get, self.none
        parts = list(chunk)
        agenda = [rank(chunk[i : i + 2], none) for i in range(len(chunk) - 1)]
        agenda.append(none)
        while (best := min(agenda)) < none:
            i = agenda.index(best)
            if not keep:
                agenda[i], keep = none, next(gaps, -1)
                continue
            keep -= 1
            whole = parts[i] = parts[i] + parts.pop(i + 1)
            del agenda[i]
            if i:
                agenda[i - 1] = rank(parts[i - 1] + whole, none)
            if i + 1 < len(parts):
                agenda[i] = rank(whole + parts[i + 1], none)
        return parts

    def long(self, chunk: str, gaps: Iterable[int]) -> list[str]:
        """The same for long chunks, the agenda being a heap."""
        gaps = iter(gaps)
        keep = next(gaps, -1)
        rank, none = self.rank.get, self.none
        parts: list[str | None] = list(chunk)
        n = len(parts)
        after, ahead = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(rank(parts[i] + parts[i + 1], none), i, i + 1, 2) for i in range(n - 1)]
        agenda = [entry for entry in agenda if entry[0] < none]
        heapq.heapify(agenda)
        while agenda:
            best, left, right, size = heapq.heappop(agenda)
            a, b = parts[left], parts[right]
            if a is None or b is None or after[left] != right or len(a) + len(b) != size:
                continue
            if not keep:
                keep = next(gaps, -1)
                continue
            keep -= 1
            parts[left], parts[right] = (whole := a + b), None
            after[left] = nxt = after[right]
            if nxt < n:
                ahead[nxt] = left
                if (found := rank(whole + parts[nxt], none)) < none:
                    heapq.heappush(agenda, (found, left, nxt, size + len(parts[nxt])))
            if (prev := ahead[left]) >= 0 and (found := rank(parts[prev] + whole, none)) < none:
                heapq.heappush(agenda, (found, prev, left, size + len(parts[prev])))
        return [p for p in parts if p is not None]

    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of what pairs of ranks make, ``none`` where that is no piece; -1 stands for no neighbour."""
        pair = a.astype(np.int64) << 32 | b
        at = np.searchsorted(self.pairs, pair)
        found = self.merged[at]
        found[self.pairs[np.minimum(at, len(self.pairs) - 1)] != pair] = self.none
        found[(a < 0) | (b < 0)] = self.none
        return found

    def many(self, chunks: list[str], keys: np.ndarray) -> list[bytes]:
        """Ids of chunks of at most ``LONG`` characters, each skipping by its own key."""
        sizes = np.array(list(map(len, chunks)))
        order = np.argsort(sizes, kind="stable")
        found: list[bytes] = [b""] * len(chunks)
        for k in range(0, len(order), BLOCK):
            rows = order[k : k + BLOCK].tolist()
            for i, coded in zip(rows, self.block([chunks[i] for i in rows], sizes[rows], keys[rows])):
                found[i] = coded
        return found

    def block(self, chunks: list[str], sizes: np.ndarray, keys: np.ndarray) -> list[bytes]:
        """``short`` of many chunks in step; an entry of the agenda is the rank and the place of a pair."""
        n, width = len(chunks), int(sizes.max())
        points = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), "<u4")
        parts = np.full((width + 1, n), -1, np.int32)  # the last place is the neighbour of who has none
        parts.T[np.arange(width + 1) < sizes[:, None]] = self.single[points]
        odd = (parts[:width] < 0).sum(0) != width - sizes
        end = np.int64(self.none) << 8
        agenda = np.full((width + 1, n), end, np.int64)
        places = np.arange(width)[:, None]
        ranks = self.merge(parts[:-1].ravel(), parts[1:].ravel()).reshape(width, n)
        agenda[:-1] = np.where(ranks < self.none, ranks << 8 | places, end)
        after = np.repeat(np.arange(1, width + 2, dtype=np.int32)[:, None], n, 1)
        after = np.where(after < sizes, after, width)
        ahead = np.repeat(np.arange(-1, width, dtype=np.int32)[:, None], n, 1)
        ahead[0] = width
        agenda[:, odd] = end
        draws = Draws(self, keys)
        keep = draws.next(np.arange(n))
        while True:
            best = agenda.min(0)
            rows = np.flatnonzero(best < end)
            if not len(rows):
                break
            best = best[rows]
            place = best & 255
            skip = keep[rows] == 0
            if skip.any():
                agenda[place[skip], rows[skip]] = end
                keep[rows[skip]] = draws.next(rows[skip])
                rows, best, place = rows[~skip], best[~skip], place[~skip]
            keep[rows] -= 1
            whole = best >> 8
            gone = after[place, rows]
            right, left = after[gone, rows], ahead[place, rows]
            parts[place, rows], parts[gone, rows] = whole, -1
            after[place, rows], ahead[right, rows] = right, place
            agenda[gone, rows] = end
            ranks = self.merge(parts[left, rows], whole)
            agenda[left, rows] = np.where(ranks < self.none, ranks << 8 | left, end)
            ranks = self.merge(whole, parts[right, rows])
            agenda[place, rows] = np.where(ranks < self.none, ranks << 8 | place, end)
        alive = parts.T >= 0
        coded = self.id_of[parts.T[alive]].tobytes()
        ends = (4 * np.cumsum(alive.sum(1))).tolist()
        found = [coded[a:b] for a, b in zip([0, *ends], ends)]
        own = Skips(self, 0)
        for i in np.flatnonzero(odd).tolist():  # characters that are no pieces
            found[i] = self.skipping(chunks[i], own.gaps(int(keys[i])))
        return found

    def coded_parts(self, parts: list[str]) -> bytes:
        coded = self.coded
        try:
            return b"".join([coded[p] for p in parts])
        except KeyError:  # a character that is no piece: its bytes
            return b"".join(
                coded.get(p) or np.array([self.byte_ids[x] for x in self.spelled(p)], "<i4").tobytes()
                for p in parts
            )

    def learn(self, chunks: list[str]) -> None:
        """What chunks give without skips: the library's own segmentation, where it leaves the text as it is and needs no
        byte pieces. Other chunks take the agenda here when they are met."""
        words = [c for c in chunks if c and c[0] == MARK != c[-1] and len(c) <= LONG and OWN_MARK not in c and MARK not in c[1:]]
        ids = np.array(self.library.encode(" ".join([c[1:] for c in words])), "<i4")
        firsts = np.flatnonzero(self.starting[ids]).tolist() if len(ids) else []
        if len(firsts) != len(words):
            if len(words) > 1:  # one that the library splits otherwise must not hide the others
                self.learn(words[: len(words) // 2])
                self.learn(words[len(words) // 2 :])
            return
        for chunk, a, b in zip(words, firsts, [*firsts[1:], len(ids)]):
            own = ids[a:b].tolist()
            if b"".join([self.bytes_of[i] for i in own])[1:] == chunk[1:].encode() and self.bytes.isdisjoint(own):
                self.plain.put(chunk, (len(chunk) - len(own), ids[a:b].tobytes()))

    def spelled(self, character: str) -> bytes:
        return (MARK if character == OWN_MARK else character).encode("utf-8", "replace")

    def encode(self, text: str, name: int) -> bytes:
        """Piece ids of a text. The name of the document and a chunk's place say which candidates are skipped."""
        return self.encode_all([text], [name])[0]

    def encode_all(self, texts: list[str], names: list[int]) -> list[bytes]:
        """The same for several texts, as many at a time as hold ``TOGETHER`` characters."""
        done: list[bytes] = []
        ends = np.cumsum([len(t) for t in texts])
        while (start := len(done)) < len(texts):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + TOGETHER, "right")))
            done += self.encode_some(texts[start:stop], names[start:stop])
        return done

    def spaced(self, text: str) -> str:
        """The chunks of a text, with spaces between them."""
        if MARK in text:
            text = text.replace(MARK, OWN_MARK)
        if "  " in text or text[:1] in (" ", ""):
            return " ".join(CHUNK.findall(MARK + text.replace(" ", MARK))) if text else ""
        return MARK + text.replace(" ", f" {MARK}").replace("\n", " \n ")  # the same, faster: no two marks meet

    def encode_some(self, texts: list[str], names: list[int]) -> list[bytes]:
        """Chunks are numbered, so that what is known of them is looked up once for all their places."""
        rows = [text.encode("utf-8", "surrogatepass") for text in map(self.spaced, texts)]
        split = pc.split_pattern(pa.array(rows, pa.large_binary()), b" ")
        numbered = split.flatten().dictionary_encode()
        words = [w.decode("utf-8", "surrogatepass") for w in numbered.dictionary.to_pylist()]
        codes, bounds = numbered.indices.to_numpy().astype(np.int64), split.offsets.to_numpy()
        plain = self.plain
        new = [w for w in words if w not in plain]
        for k in range(0, len(new), 2000):
            self.learn(new[k : k + 2000])
        known = [plain[w] if len(w) <= LONG else (WORD, b"") for w in words]
        left = np.array([n for n, _ in known], np.uint64)[codes]
        found = [coded for _, coded in known]
        keys = np.concatenate([Skips(self, name).keys(n) for name, n in zip(names, np.diff(bounds).tolist())])
        for k in np.flatnonzero(left == np.uint64(WORD)).tolist():
            gaps = Skips(self, 0).gaps(int(keys[k])) if self.limit else ()
            word, codes[k] = words[codes[k]], len(found)
            found.append(self.coded_parts(self.long(word, gaps)))
        if self.limit:
            hit = np.flatnonzero((Skips(self, 0).first(keys) < left) & (left != np.uint64(WORD)))
            chunks, codes[hit] = [words[c] for c in codes[hit].tolist()], len(found) + np.arange(len(hit))
            found += self.many(chunks, keys[hit]) if chunks else []
        return joined(pa.array(found, pa.large_binary()), codes, bounds)

    def decode(self, ids: bytes) -> str:
        return self.decode_all([ids])[0]

    def decode_all(self, ids: list[bytes]) -> list[str]:
        bounds = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int64)
        texts = joined(self.spellings, np.frombuffer(b"".join(ids), "<i4"), bounds)
        return [text[1:].decode("utf-8", "replace") for text in texts]


def joined(values: pa.Array, codes: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """The values numbered by ``codes``, put together from each bound to the next."""
    taken = values.take(pa.array(codes))
    offsets = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset : taken.offset + len(taken) + 1]
    data, ends = taken.buffers()[2] or b"", offsets[bounds].tolist()
    whole = memoryview(data)
    return [bytes(whole[a:b]) for a, b in zip(ends, ends[1:])]


@cache
def pieces(model: str, dropout: float, seed: int) -> Pieces:
    return Pieces(model, dropout, seed)


def encoded(
    docs: DataFrame, ids: bool = True, model: str = MODEL, dropout: float = DROPOUT, seed: int = SEED
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_chars``, ``n_tokens``, ``ids`` (if asked for), ``ids_sha256`` (of
    little-endian 32-bit ids), ``decoded_sha256`` (of the decoded text) and ``lossless``."""
    rows = docs.select("doc_id", text_of(docs).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(model, dropout, seed)
        for batch in batches:
            for part in (batch.slice(k, 256) for k in range(0, batch.num_rows, 256)):  # bounds the ids held at once
                yield encode_part(own, part)

    def encode_part(own: Pieces, part: pa.RecordBatch) -> pa.RecordBatch:
        names, texts = part.column("doc_id").to_pylist(), part.column("_text").to_pylist()
        coded = own.encode_all(texts, [xxhash.xxh64_intdigest(str(n), seed) for n in names])
        decoded = own.decode_all(coded)
        columns = {
            "doc_id": part.column("doc_id"),
            "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            "n_tokens": pa.array([len(c) // 4 for c in coded], pa.int64()),
        }
        if ids:
            offsets = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(coded), "<i4"))
            columns["ids"] = pa.ListArray.from_arrays(pa.array(offsets), values)
        columns["ids_sha256"] = pa.array([hashlib.sha256(c).hexdigest() for c in coded])
        columns["decoded_sha256"] = pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded])
        columns["lossless"] = pa.array([d == t for d, t in zip(decoded, texts)])
        return pa.RecordBatch.from_pydict(columns)

    kind = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_chars long, n_tokens long, "
    kind += ("ids array<int>, " if ids else "") + "ids_sha256 string, decoded_sha256 string, lossless boolean"
    return rows.mapInArrow(run, kind)
