"""SentencePiece encoding by batched numpy Viterbi, and decoding.

The text is prepared as the model's normaliser does (identity; a space before the text; spaces become U+2581) and cut
into units before each U+2581 that follows another character: no piece of such a model spans that border, so units are
encoded once each and remembered.

Units of equal length advance together.  Rolling hashes of all their substrings of one length are probed in the
sorted hashes of the pieces (a hit is confirmed character by character), and for every end position a vectorised
maximum over the piece lengths keeps the best score and a backpointer.  A character that is no piece costs more than
any piece and becomes its UTF-8 bytes' pieces (byte fallback).  The result is the segmentation of largest total
score, ties to the shorter last piece.

A unit of more than ``LONG`` characters, as texts without spaces give, is cut where its two neighbours stand side by
side in no piece, which changes neither result; what is still long is probed for all places at once and goes forward
place by place, with plain maxima over the few pieces that end there, in time in proportion to its length.

A BPE model's own encoder applies merges by rank instead of maximising the total.  ``encode(..., merges=True)`` does
that in the same batched way: units of equal length advance together, the best adjacent pair of each is merged, the
leftmost first on ties, until no pair is a piece; a unit that is still long after the cuts keeps its pairs in a heap.
These are the library's ids.

Edge cases: a null or empty text has no ids.  U+2581 itself decodes to a space, as in the library.  Ids decode to
bytes, which join to the text with the first space dropped.  Repeated rows each give a row, an empty table none.  Extra
columns are kept; a column called as the result is replaced.
"""

from __future__ import annotations

import heapq
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, documents, short_batches
from .token_counts import by_bytes, gather

#: Bytes of units and ids that a worker remembers.
MEMO_BYTES = 256 << 20
#: Characters of a unit that is cut further, and not remembered as a whole.
LONG = 96
#: Characters of text that are cut into units at once.
SLICE_CHARS = 8 << 20
MARKS = ",.;:!?*#$%&"
SPACE = "▁"
_UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+$")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_KNOWN = np.uint64(44)
_models: dict[str, "PieceModel"] = {}
_memos: dict[tuple[str, tuple[bool, ...]], Memo] = {}


class PieceModel:
    """The pieces of a model file, by sorted hash."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        text = {i: sp.id_to_piece(i) for i in plain}
        self.unknown = sp.unk_id()
        self.bytes_id = np.full(256, self.unknown, np.uint32)
        self.out = [b""] * n
        for i in range(n):
            if sp.is_byte(i):
                b = int(sp.id_to_piece(i)[3:5], 16)
                self.bytes_id[b], self.out[i] = i, bytes([b])
            elif i in text:
                self.out[i] = text[i].replace(SPACE, " ").encode()
        self.out[self.unknown] = " ⁇ ".encode()
        self.widest = max(map(len, text.values()), default=1)
        after = {b for t in text.values() for a, b in zip(t, t[1:], strict=False) if a.isascii() and a.isalpha()}
        self.marks = "".join(c for c in MARKS if c not in after)
        pairs = {ord(a) << 32 | ord(b) for t in text.values() for a, b in zip(t, t[1:], strict=False)}
        self.pairs = np.array(sorted(pairs), np.uint64)
        chars = np.zeros((len(plain), self.widest), np.uint32)
        for row, i in enumerate(plain):
            chars[row, : len(text[i])] = [ord(c) for c in text[i]]
        size = np.array([len(text[i]) for i in plain])
        powers = self._powers(self.widest)
        h = np.zeros(len(plain), np.uint64)
        with np.errstate(over="ignore"):
            for j in range(self.widest):
                h = np.where(j < size, h * _BASE + chars[:, j].astype(np.uint64) + np.uint64(1), h)
        order = np.argsort(h, kind="stable")
        self.keys, self.ids = h[order], np.array(plain, np.uint32)[order]
        self.known = np.zeros(1 << 64 - int(_KNOWN), bool)  # of the first bits of a hash, whether some piece has them
        self.known[self.keys >> _KNOWN] = True
        self.chars, self.size = chars[order], size[order]
        self.score = np.array([sp.get_score(i) for i in plain])[order]
        self.low = float(self.score.min()) - 10 if len(plain) else -10.0
        self.powers = powers

    @staticmethod
    def _powers(n: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]), dtype=np.uint64)

    def probe(self, hashes: np.ndarray, chars: np.ndarray, start, size) -> np.ndarray:
        """Row of the piece equal to chars[k, start:start + size], or -1, for each hash."""
        out = np.full(len(hashes), -1, np.int64)
        hit = np.nonzero(self.known[hashes >> _KNOWN])[0]  # most substrings are no piece
        at = np.minimum(np.searchsorted(self.keys, hashes[hit]), len(self.keys) - 1)
        same = self.keys[at] == hashes[hit]
        hit, at = hit[same], at[same]
        start, size = np.broadcast_to(start, hashes.shape)[hit], np.broadcast_to(size, hashes.shape)[hit]
        ok = self.size[at] == size
        for j in range(int(size.max()) if len(size) else 0):
            column = np.minimum(start + j, chars.shape[1] - 1)
            ok &= (j >= size) | (chars[hit, column] == self.chars[at, min(j, self.widest - 1)])
        out[hit[ok]] = at[ok]
        return out

    def cut(self, unit: str) -> list[str]:
        """A unit cut between neighbours that stand side by side in no piece."""
        c = np.frombuffer(unit.encode("utf-32-le"), np.uint32).astype(np.uint64)
        pair = c[:-1] << np.uint64(32) | c[1:]
        at = np.minimum(np.searchsorted(self.pairs, pair), max(0, len(self.pairs) - 1))
        apart = np.nonzero(self.pairs[at] != pair)[0] + 1 if len(self.pairs) else np.arange(1, len(unit))
        at = [0, *apart.tolist(), len(unit)]
        return [unit[a:b] for a, b in zip(at, at[1:], strict=False)]

    def places(self, unit: str) -> list[list[tuple[int, int]]]:
        """For each end in a unit, the (size, row) of the pieces that end there, the shortest first."""
        chars = np.frombuffer(unit.encode("utf-32-le"), np.uint32)
        hashes, out = self.long_hashes(chars), [[] for _ in range(len(unit) + 1)]
        for size in range(1, min(self.widest, len(unit)) + 1):
            start = np.arange(len(unit) - size + 1)
            with np.errstate(over="ignore"):
                h = hashes[size:] - hashes[: len(start)] * self.powers[size]
            at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            hit = np.nonzero((self.keys[at] == h) & (self.size[at] == size))[0]
            same = np.ones(len(hit), bool)
            for j in range(size):
                same &= chars[hit + j] == self.chars[at[hit], j]
            for i, row in zip((hit[same] + size).tolist(), at[hit[same]].tolist(), strict=True):
                out[i].append((size, row))
        return out

    @staticmethod
    def long_hashes(chars: np.ndarray) -> np.ndarray:
        out, h, base, mask = np.zeros(len(chars) + 1, np.uint64), 0, int(_BASE), (1 << 64) - 1
        values = []
        for c in chars.tolist():
            h = (h * base + c + 1) & mask
            values.append(h)
        out[1:] = values
        return out

    def prefix_hashes(self, chars: np.ndarray) -> np.ndarray:
        out = np.zeros((len(chars), chars.shape[1] + 1), np.uint64)
        with np.errstate(over="ignore"):
            for j in range(chars.shape[1]):
                out[:, j + 1] = out[:, j] * _BASE + chars[:, j].astype(np.uint64) + np.uint64(1)
        return out


def model(path: str) -> PieceModel:
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def _fallback(m: PieceModel, char: str) -> np.ndarray:
    return m.bytes_id[np.frombuffer(char.encode(), np.uint8)]


def viterbi(m: PieceModel, units: list[str]) -> list[bytes]:
    """Ids of units of one length, by the best total score."""
    n, width = len(units), len(units[0])
    chars = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).reshape(n, width)
    hashes = m.prefix_hashes(chars)
    best = np.full((n, width + 1), -np.inf)
    best[:, 0] = 0
    back = np.zeros((n, width + 1), np.int64)  # length of the last piece
    piece = np.full((n, width + 1), -1, np.int64)
    for end in range(1, width + 1):
        for size in range(1, min(m.widest, end) + 1):
            start = end - size
            with np.errstate(over="ignore"):
                h = hashes[:, end] - hashes[:, start] * m.powers[size]
            row = m.probe(h, chars, start, size)
            score = best[:, start] + np.where(row >= 0, m.score[row], m.low if size == 1 else -np.inf)
            better = score > best[:, end]
            best[better, end], back[better, end], piece[better, end] = score[better], size, row[better]
    at, steps, every = np.full(n, width), [], np.arange(n)
    while at.any():  # all units go back together, a piece a step
        steps.append(np.where(at > 0, piece[every, at], -2))
        at = at - back[every, at]
    rows = np.stack(steps[::-1], axis=1)
    return _as_ids(m, rows[rows > -2], (rows > -2).sum(1), lambda k: _spelled(m, units[k], rows[k][rows[k] > -2]))


def viterbi_long(m: PieceModel, unit: str) -> bytes:
    """Ids of one long unit, by the best total score."""
    score, low = m.score.tolist(), m.low
    best, back = [0.0] * (len(unit) + 1), [(1, -1)] * (len(unit) + 1)
    for end, own in enumerate(m.places(unit)):
        if end:
            top, step = -np.inf, (1, -1)
            if not own or own[0][0] > 1:  # a character that is no piece
                top = best[end - 1] + low
            for size, row in own:
                s = best[end - size] + score[row]
                if s > top:
                    top, step = s, (size, row)
            best[end], back[end] = top, step
    rows, at = [], len(unit)
    while at:
        size, row = back[at]
        rows.append(row)
        at -= size
    return _spelled(m, unit, np.array(rows[::-1]))


def merge_long(m: PieceModel, unit: str) -> bytes:
    """Ids of one long unit, by merging the best adjacent pair again and again: a heap of pairs over linked symbols."""
    row_of = {(end - size, size): row for end, own in enumerate(m.places(unit)) for size, row in own}
    score, n = m.score.tolist(), len(unit)
    size, after, before = [1] * n, list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[float, int, int]] = []

    def offer(a: int) -> None:
        b = after[a] if a >= 0 else n
        if b < n and (row := row_of.get((a, size[a] + size[b]))) is not None:
            heapq.heappush(heap, (-score[row], a, size[a] + size[b]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, a, both = heapq.heappop(heap)
        b = after[a] if size[a] else n
        if b >= n or size[a] + size[b] != both:
            continue  # one of the two has changed since
        size[a], size[b], after[a] = both, 0, after[b]
        if after[a] < n:
            before[after[a]] = a
        offer(before[a])
        offer(a)
    rows, at = [], 0
    while at < n:
        rows.append(row_of.get((at, size[at]), -1))
        at = after[at]
    return _spelled(m, unit, np.array(rows))


def _spelled(m: PieceModel, unit: str, rows: np.ndarray) -> bytes:
    """Ids of one unit's pieces, characters that are no piece by their bytes."""
    ids, at = [], 0
    for r in rows:
        size = int(m.size[r]) if r >= 0 else 1
        ids.append(m.ids[r : r + 1] if r >= 0 else _fallback(m, unit[at]))
        at += size
    return np.concatenate(ids).astype("<u4").tobytes()


def _as_ids(m: PieceModel, rows: np.ndarray, count: np.ndarray, spell) -> list[bytes]:
    """Ids of each unit, given the rows of all units' pieces in order; ``spell`` gives those of a unit with other characters."""
    raw = m.ids[rows].astype("<u4").tobytes()
    ends = (4 * np.cumsum(count)).tolist()
    out = [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    for k in np.unique(np.repeat(np.arange(len(count)), count)[rows < 0]).tolist():
        out[k] = spell(k)
    return out


def merge(m: PieceModel, units: list[str]) -> list[bytes]:
    """Ids of units of one length, by merging the best adjacent pair again and again."""
    n, width = len(units), len(units[0])
    chars = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).reshape(n, width)
    hashes = m.prefix_hashes(chars)
    powers = m._powers(2 * m.widest)
    cut = np.tile(np.arange(width + 1), (n, 1))  # starts of the symbols; the first ``count`` + 1 hold
    count = np.full(n, width)
    score = np.full((n, width), -np.inf)  # of the pair of symbols i, i + 1

    def scored(rows: np.ndarray, at: np.ndarray) -> None:
        ok = (at >= 0) & (at + 1 < count[rows])
        rows, at = rows[ok], at[ok]
        a, b = cut[rows, at], cut[rows, at + 2]
        score[rows, at] = -np.inf
        fits = b - a <= m.widest
        rows, at, a, b = rows[fits], at[fits], a[fits], b[fits]
        if len(rows):
            with np.errstate(over="ignore"):
                h = hashes[rows, b] - hashes[rows, a] * powers[b - a]
            row = m.probe(h, chars[rows], a, b - a)
            score[rows, at] = np.where(row >= 0, m.score[row], -np.inf)

    for i in range(width - 1):
        scored(np.arange(n), np.full(n, i))
    alive = np.arange(n)
    while len(alive):
        at = score[alive].argmax(1)
        ok = score[alive, at] > -np.inf
        alive, at = alive[ok], at[ok]
        if not len(alive):
            break
        columns = np.arange(width + 1)
        source = np.minimum(columns + (columns[None, :] > at[:, None]), width)
        cut[alive] = np.take_along_axis(cut[alive], source, 1)
        source = np.minimum(columns[:-1] + (columns[None, :-1] > at[:, None]), width - 1)
        score[alive] = np.take_along_axis(score[alive], source, 1)
        count[alive] -= 1
        score[alive, np.maximum(count[alive] - 1, 0)] = -np.inf
        scored(alive, at - 1)
        scored(alive, at)
    rows = np.repeat(np.arange(n), count)
    firsts = np.concatenate([[0], np.cumsum(count)])
    place = np.arange(len(rows)) - firsts[rows]
    a, b = cut[rows, place], cut[rows, place + 1]
    with np.errstate(over="ignore"):
        h = hashes[rows, b] - hashes[rows, a] * powers[np.minimum(b - a, 2 * m.widest)]
    found = m.probe(h, chars[rows], a, b - a)
    return _as_ids(m, found, count, lambda k: _spelled(m, units[k], found[firsts[k] : firsts[k + 1]]))


def units_of(m: PieceModel, texts: pa.Array) -> pa.ListArray:
    """Texts (no null) cut into units, as strings with U+2581 for spaces; empty strings stand for nothing.

    A border is safe if no piece spans it: before a run of spaces, and between an ASCII letter and those of ``MARKS``
    that follow a letter in no piece.
    """
    own = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))
    own = pc.replace_substring_regex(own, pattern="( +)", replacement="\0\\1")
    if m.marks:
        own = pc.replace_substring_regex(own, pattern=f"([A-Za-z])([{re.escape(m.marks)}])", replacement="\\1\0\\2")
    return pc.split_pattern(pc.replace_substring(own, pattern=" ", replacement=SPACE), "\0")


def encode_batch(path: str, texts: list[str | None], kinds: tuple[bool, ...], memo_bytes: int = MEMO_BYTES) -> tuple[list[list[bytes]], list[bool]]:
    """For each of ``kinds`` (whether to merge) the ids of whole texts; and whether the first kind's decode to the text.

    Units are found once, each distinct one is encoded once and remembered together with whether its pieces give its
    text back; a text whose units all do does so, and any other is decoded as a whole.
    """
    m, memo = model(path), _memos.setdefault((path, kinds), Memo(memo_bytes))
    plain = ["" if x is None or "\0" in x else x for x in texts]
    out, back, at = [[] for _ in kinds], [], 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (size < SLICE_CHARS or end == at):
            size += len(plain[end])
            end += 1
        words = units_of(m, pa.array(plain[at:end], pa.string()))
        coded = words.flatten().dictionary_encode()
        good, *values = zip(*_encoded(m, memo, coded.dictionary.to_pylist(), kinds), strict=True)
        for own, ids in zip(out, values, strict=True):
            own += gather(words, coded, ids)
        bad = np.concatenate([[0], np.cumsum(~np.array(good, bool)[coded.indices.to_numpy()])])
        bounds = words.offsets.to_numpy() - words.offsets[0].as_py()
        back += (bad[bounds[1:]] == bad[bounds[:-1]]).tolist()
        at = end
    if kinds[0]:
        back = [False] * len(texts)
    for i, x in enumerate(texts):
        if x and "\0" in x:
            coded = _encoded(m, memo, _UNIT.findall(SPACE + x.replace(" ", SPACE)), kinds)
            for j, own in enumerate(out):
                own[i] = b"".join(v[j + 1] for v in coded)
            back[i] = False
        if not back[i] or x and SPACE in x:
            back[i] = decode(path, out[0][i]) == (x or "")
    return out, back


def _gives_back(m: PieceModel, unit: str, ids: bytes) -> bool:
    return b"".join([m.out[i] for i in np.frombuffer(ids, "<u4").tolist()]) == unit.replace(SPACE, " ").encode()


def _encoded(m: PieceModel, memo: Memo, units: list[str], kinds: tuple[bool, ...]) -> list[tuple]:
    """(whether the first kind's ids decode to the unit; the ids of each kind) of each unit."""
    memo.room()
    memo[""] = (True, *[b""] * len(kinds))
    new, long = set(units).difference(memo), {}
    for u in [u for u in new if len(u) > LONG]:
        new.remove(u)
        long[u] = m.cut(u)
    if long:
        new.update(x for own in long.values() for x in own if x not in memo)
    passing = [u for u in new if len(u) > LONG]  # no cut was found in these
    for u in passing:
        ids = [(merge_long if k else viterbi_long)(m, u) for k in kinds]
        memo[u] = _gives_back(m, u, ids[0]), *ids
    by_length: dict[int, list[str]] = {}
    for u in new.difference(passing):
        by_length.setdefault(len(u), []).append(u)
    for width, own in by_length.items():
        for some in by_bytes(own):
            ids = [(merge if k else viterbi)(m, some) for k in kinds]
            good = [True] * len(some) if kinds[0] else [_gives_back(m, u, b) for u, b in zip(some, ids[0], strict=True)]
            memo.learn(some, list(zip(good, *ids, strict=True)), 2 * width * len(some) + sum(sum(map(len, x)) + 40 * len(x) for x in ids))
    for u, own in long.items():
        if u not in memo:
            values = [memo[x] for x in own]
            memo[u] = all(v[0] for v in values), *[b"".join(v[j + 1] for v in values) for j in range(len(kinds))]
            passing.append(u)
    out = list(map(memo.__getitem__, units))
    for u in passing:
        del memo[u]
    return out


def encode(path: str, texts: list[str | None], merges: bool = False) -> list[bytes]:
    """Ids of whole texts as little-endian u32."""
    return encode_batch(path, texts, (merges,))[0][0]


def decode(path: str, ids: bytes) -> str:
    """The text of little-endian u32 ids; bytes that are no UTF-8 become U+FFFD."""
    out = model(path).out
    text = b"".join([out[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")
    return text[1:] if text[:1] == " " else text


def with_pieces(docs: DataFrame, path: str, into: str, merges: bool = False, memo_bytes: int = MEMO_BYTES) -> DataFrame:
    """``docs`` with ``into``: struct n, crc (of the ids), back (whether decoding gives the text), and with ``merges``
    merged_n, merged_crc.  ``memo_bytes``: what a worker may remember; less where it also serves other operators."""
    short_batches(docs.sparkSession)

    def run(batch):
        ids, back = encode_batch(path, batch.to_pylist(), (False, True) if merges else (False,), memo_bytes)
        columns = [pa.array(c, pa.int64()) for own in ids for c in ([len(b) // 4 for b in own], [zlib.crc32(b) for b in own])]
        return pa.StructArray.from_arrays([*columns, pa.array(back, pa.bool_())], [*names, "back"])

    names = ["n", "crc", "merged_n", "merged_crc"][: 4 if merges else 2]
    kind = ", ".join(f"{n} long" for n in names) + ", back boolean"
    return docs.withColumn(into, F.arrow_udf(run, kind, F.ArrowUDFType.SCALAR)(F.col("text")))


def op6_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (best total score), round_trip, and bpe_n_tokens, bpe_ids_crc32 (by merges)."""
    out = with_pieces(documents(spark, sf_dir).select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"), "p", merges=True)
    return out.select("doc_id", F.col("p.n").alias("n_tokens"), F.col("p.crc").alias("ids_crc32"), F.col("p.back").alias("round_trip"), F.col("p.merged_n").alias("bpe_n_tokens"), F.col("p.merged_crc").alias("bpe_ids_crc32"))
