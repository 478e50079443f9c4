"""Token counts of whole texts, without keeping the ids.

Texts are cut at safe boundaries, where the pre-tokenizer splits whatever stands around; the pieces of a batch that
are not in the worker's memo go to the library in batches of about equal bytes (UTF-8), and only their lengths are kept.
A text's count is the sum of its pieces' counts.

Safe boundaries of the byte-level pre-tokenizer: before a space that stands alone between two characters that are not
white space (the space then begins the next token, and no added token holds a space).  A piece of more than ``LONG``
characters, as texts without spaces give, is cut further: around added tokens; between ASCII letters, digits, marks
and a line end, whose runs are never one token (not beside an apostrophe, which may join a letter); and between two
characters whose meeting bytes stand side by side in no entry of the vocabulary, so that no merge can span them.  Only
a run in which every pair may merge stays whole, and the library takes it in n log n.

Edge cases: a null or empty text has 0 bytes and 0 tokens.  Strings of special tokens inside a text count as the
library's default has it (one token).  Ties cannot arise.  Repeated rows each give a row; an empty table gives none.
Extra columns are kept; a column called as the result is replaced.
"""

from __future__ import annotations

import os
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, documents, short_batches

#: Bytes of new pieces that go to the library in one call.
CALL_BYTES = 1 << 18
#: Bytes of pieces that a worker remembers, and the longest of them in characters.
MEMO_BYTES, LONGEST_KEPT = 320 << 20, 256
#: Characters of a piece that is cut further.
LONG = 512
LIMIT = 512

_UNSAFE = re.compile(r"\s |[ ]\s")
_SAFE = re.compile(r"(?<=\S) (?=\S)")
#: ASCII marks but the apostrophe.
_MARK = r"!-&(-/:-@\[-`{-~"
_RUNS = re.compile(rf"(?<=[A-Za-z])(?=[0-9\n{_MARK}])|(?<=[0-9])(?=[A-Za-z\n{_MARK}])|(?<=[{_MARK}])(?=[A-Za-z0-9\n])")
_tokenizers: dict[str, object] = {}
_pairs: dict[str, np.ndarray] = {}
_memos: dict[tuple[str, str], Memo] = {}


def tokenizer(path: str):
    """The worker's tokenizer for a file, loaded once."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _tokenizers[path] = t
    return _tokenizers[path]


def pieces(text: str) -> list[str]:
    """The text cut at its safe boundaries; the pieces joined by a space give the text back."""
    return _SAFE.split(text) if _UNSAFE.search(text) else text.split(" ")


def _byte_of() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def merging_pairs(path: str) -> np.ndarray:
    """Whether two bytes stand side by side in some entry of the vocabulary, as a flat table."""
    if path not in _pairs:
        byte, out = _byte_of(), np.zeros(1 << 16, bool)
        for entry in tokenizer(path).get_vocab():
            own = [byte.get(c) for c in entry]
            for x, y in zip(own, own[1:], strict=False):
                if x is not None and y is not None:
                    out[x << 8 | y] = True
        _pairs[path] = out
    return _pairs[path]


def _unmerged(path: str, text: str) -> list[str]:
    """The text cut where no merge can span, not beside an apostrophe or white space."""
    raw = np.frombuffer(text.encode(), np.uint8)
    start = np.nonzero((raw & 0xC0) != 0x80)[0]  # of each character
    pair = raw[start[1:] - 1].astype(np.int64) << 8 | raw[start[1:]]
    first = raw[start]
    bare = (first[:-1] == 39) | (first[1:] == 39) | np.array([c.isspace() for c in text[:-1]]) | np.array([c.isspace() for c in text[1:]])
    at = [0, *(np.nonzero(~merging_pairs(path)[pair] & ~bare)[0] + 1).tolist(), len(text)]
    return [text[a:b] for a, b in zip(at, at[1:], strict=False)]


def parts(path: str, piece: str) -> list[str]:
    """A long piece cut at its further safe boundaries."""
    special = [x.content for x in tokenizer(path).get_added_tokens_decoder().values()]
    around = re.split("(" + "|".join(map(re.escape, special)) + ")", piece) if special else [piece]
    out = []
    for i, own in enumerate(around):
        if i % 2:
            out.append(own)
        elif own:
            for run in _RUNS.split(own):
                out += _unmerged(path, run) if len(run) > LONG else [run]
    return out


def by_bytes(items: list, most: int = CALL_BYTES):
    """Consecutive batches of about ``most`` bytes in UTF-8."""
    batch, size = [], 0
    for x in items:
        batch.append(x)
        size += len(x) if x.isascii() else len(x.encode())
        if size >= most:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


def gather(words: pa.ListArray, coded: pa.DictionaryArray, values: list[bytes]) -> list[bytes]:
    """The ids (little-endian u32) of each list of words, given those of each distinct word."""
    flat = np.frombuffer(b"".join(values), "<u4")
    size = np.array([len(v) // 4 for v in values], np.int64)
    start = np.cumsum(size) - size
    word = coded.indices.to_numpy()
    ends = np.cumsum(size[word])
    total = int(ends[-1]) if len(ends) else 0
    ids = flat[np.repeat(start[word] - ends + size[word], size[word]) + np.arange(total)].astype("<u4", copy=False)
    bounds = np.concatenate([[0], ends])[words.offsets.to_numpy() - words.offsets[0].as_py()]
    return [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]


def _lengths(path: str, pieces: list[str]) -> list[int]:
    """Tokens of each piece, encoded in batches of about equal bytes."""
    t = tokenizer(path)
    return [len(e) for some in by_bytes(pieces) for e in t.encode_batch_fast(some, add_special_tokens=False)]


def _learn(path: str, memo: Memo, new: set[str], lead: str) -> list[str]:
    """Counts new pieces, each after ``lead``, into the memo; those too long to stay there are returned."""
    passing = [x for x in new if len(x) > LONGEST_KEPT] if len(max(new, key=len, default="")) > LONGEST_KEPT else []
    for x in passing:
        memo[x] = sum(_lengths(path, parts(path, lead + x) if len(x) > LONG else [lead + x]))
    kept = list(new.difference(passing)) if passing else list(new)
    memo.learn(kept, _lengths(path, [lead + x for x in kept] if lead else kept), 2 * sum(map(len, kept)))
    return passing


def count_tokens(path: str, texts: list[str | None]) -> list[int]:
    """Tokens of each whole text, as the library counts them."""
    # A text's first piece has no space before it, all others have.
    memos = [_memos.setdefault((path, lead), Memo(MEMO_BYTES)) for lead in ("", " ")]
    out = []
    for batch in by_bytes([x or "" for x in texts], 1 << 22):
        cut = [pieces(x) if x else [""] for x in batch]
        firsts, rest = {own[0] for own in cut}, set().union(*(own[1:] for own in cut))
        passing = []
        for memo, own, lead in zip(memos, (firsts, rest), ("", " "), strict=True):
            memo.room()
            passing.append(_learn(path, memo, own.difference(memo), lead))
        first, other = (m.__getitem__ for m in memos)
        out += [first(own[0]) + sum(map(other, own[1:])) for own in cut]
        for memo, long in zip(memos, passing, strict=True):
            for x in long:
                del memo[x]
    return out


def token_counts(docs: DataFrame, path: str, into: str = "n_tokens") -> DataFrame:
    """``docs`` with the column ``into``: the tokens of ``text``."""
    short_batches(docs.sparkSession)

    def run(batch):
        return pa.array(count_tokens(path, batch.to_pylist()), pa.int64())

    return docs.withColumn(into, F.arrow_udf(run, "long", F.ArrowUDFType.SCALAR)(F.col("text")))


def op2_token_counts(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    docs = documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    out = token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
