"""Language identification by prediction by partial matching.

Every language has a variable-order context tree over all 256 byte values (orders 0 to 3).  The statistics are frozen
after training.  A byte seen c times in a context of n bytes, d different ones, has the probability c / (n + d); a byte
not seen there escapes with d / (n + d) to the next shorter context, whose symbols already ruled out are excluded, so
each distribution sums to one; below order 0 all bytes are alike.  A text's code length in each language is the sum of
-log2 p over all its bytes, in double precision; the shortest wins.

With frozen statistics the cost of a byte that a context has not seen is that of the shorter context plus a number of
the context alone, log2(what the seen symbols leave of the shorter context's distribution) - log2(escape).  So the trees
become sparse tables: for each sequence of 4 (3, 2, 1) bytes that occurs, one row with its full cost in every language,
and for each context of 3 (2, 1) bytes one row of such numbers.  A sequence is found by a hash probe; what the longest
table lacks adds its context's row and goes on with the next.  Coding a text is a probe or two a byte.

Bounds: training takes at most ``TEXTS_PER_LANGUAGE`` texts and ``BYTES_PER_LANGUAGE`` bytes a language (whole texts by
smallest hash, those that fit; where none fits, the beginning of the shortest), at most ``BYTES`` of all, of the
``LANGUAGES`` most frequent labels, and less where the tables would exceed ``TABLE_BYTES``: that is what the executors are
sent at most.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; so is every text if no labelled row exists.
A row whose label is null trains nothing and is predicted like others.  Repeated texts count once in training.
Equal code lengths go to the first language by name.  Texts of any length are coded whole, in chunks that see the bytes
before them.  Repeated rows each give a row, an empty table none.  Extra columns are kept, whatever their names;
columns called as the results are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, own_name, short_batches

ORDER = 3
TEXTS_PER_LANGUAGE = 300
BYTES_PER_LANGUAGE = 2_000_000
#: Bytes of all training texts; with many languages each gets its part.
BYTES = 64_000_000
#: Labels that are learned, the most frequent by distinct texts, ties by name.
LANGUAGES = 256
#: Bytes of the tables; beyond, half of each language's texts is left out, then half of the one, again and again.
TABLE_BYTES = 256 << 20
#: Ranking deals a language's hashes over so many tasks.
SALTS = 64
#: Bytes that are coded at once, for four languages or fewer.
CHUNK = 1 << 18


class HashIndex:
    """The place of each key in an array of distinct keys, by open addressing."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.shift, self.mask = np.uint64(64 - bits), np.uint64((1 << bits) - 1)
        self.key, self.row, self.rounds = np.zeros(1 << bits, np.uint32), np.full(1 << bits, -1, np.int32), 0
        left, at = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.row[at] < 0
            slots, first = np.unique(at[free], return_index=True)
            won = np.nonzero(free)[0][first]
            self.row[slots], self.key[slots] = left[won], keys[left[won]]
            rest = np.ones(len(left), bool)
            rest[won] = False
            left, at = left[rest], (at[rest] + np.uint64(1)) & self.mask
            self.rounds += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        at = self._slot(keys)
        row = self.row[at]
        out = np.where((row >= 0) & (self.key[at] == keys), row, -1)
        open_ = np.nonzero((out < 0) & (row >= 0))[0]
        for _ in range(1, self.rounds):
            if not len(open_):
                break
            at[open_] = (at[open_] + np.uint64(1)) & self.mask
            row = self.row[at[open_]]
            hit = (row >= 0) & (self.key[at[open_]] == keys[open_])
            out[open_[hit]] = row[hit]
            open_ = open_[(row >= 0) & ~hit]
        return out


@dataclass(frozen=True)
class PpmModel:
    langs: list[str]
    grams: list[HashIndex | None]  # by order, the sequences of context and byte; order 0 needs none
    costs: list[np.ndarray]  # (sequence, language): full cost in bits; all 256 bytes in order 0
    contexts: list[HashIndex | None]
    escapes: list[np.ndarray]  # (context, language): cost of leaving it

    @property
    def size(self) -> int:
        return sum(x.nbytes for x in [*self.costs, *self.escapes])


def _events(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order, the sequences of context and byte as numbers, ascending, and how often they occur."""
    s = np.frombuffer(b"".join(b"\0" * ORDER + t for t in texts), np.uint8).astype(np.uint32)
    inner = np.ones(len(s), bool)  # bytes of texts, not what stands before them
    ends = np.cumsum([len(t) + ORDER for t in texts])
    for k in range(ORDER):
        inner[np.concatenate([[0], ends[:-1]]).astype(int) + k] = False
    key, out = s.copy(), []
    for k in range(ORDER + 1):
        if k:
            key[k:] |= s[:-k] << np.uint32(8 * k)
        out.append(np.unique(key[inner], return_counts=True))
    return out


def _tables(own: list[tuple[np.ndarray, np.ndarray]], wanted: list[np.ndarray], contexts: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """One language's full costs of the ``wanted`` sequences, and the costs of leaving ``contexts``, for orders 0 to 3.
    Every sequence's last bytes are themselves wanted one order below, every context's too."""
    costs, leaves = [], []
    for k, (keys, n) in enumerate(own):
        below = costs[-1] if k else np.full(256, 8.0)
        # The shorter context's cost of each wanted sequence, and of each seen one.
        low = wanted[k] & np.uint32((1 << 8 * k) - 1) if k else wanted[0]
        parent = below[np.searchsorted(wanted[k - 1], low)] if k else below[low]
        seen = np.searchsorted(wanted[k], keys)
        of, first = np.unique(keys >> np.uint32(8), return_index=True)
        total = np.add.reduceat(n, first).astype(float)
        kinds = np.diff(np.append(first, len(keys))).astype(float)
        rest = 1 - np.add.reduceat(np.exp2(-parent[seen]), first)
        whole = (kinds == 256) | (rest <= 1e-12)  # nothing is left to escape to
        leave = np.where(whole, 0.0, np.log2(np.maximum(rest, 1e-300)) - np.log2(kinds / (total + kinds)))
        out = np.zeros(len(contexts[k]))
        out[np.searchsorted(contexts[k], of)] = leave
        cost = parent + out[np.searchsorted(contexts[k], wanted[k] >> np.uint32(8))]
        row = np.repeat(np.arange(len(of)), np.diff(np.append(first, len(keys))))
        cost[seen] = np.log2(total[row] + np.where(whole[row], 0.0, kinds[row])) - np.log2(n)
        costs.append(cost)
        leaves.append(out)
    return costs, leaves


def train(texts: dict[str, list[bytes]], table_bytes: int = TABLE_BYTES) -> PpmModel:
    """Builds the frozen model from whole texts by language."""
    langs = sorted(texts)
    while True:
        events = [_events(texts[lang]) for lang in langs]
        union = lambda k: np.unique(np.concatenate([e[k][0] for e in events]))  # noqa: B023, E731
        wanted = [np.arange(256, dtype=np.uint32), union(1), union(2), union(3)]
        contexts = [np.unique(w >> np.uint32(8)) for w in wanted]
        if 8 * len(langs) * sum(map(len, [*wanted, *contexts])) <= table_bytes or all(len(t) <= 1 and len(b"".join(t)) <= 16 for t in texts.values()):
            break
        texts = {lang: own[: (len(own) + 1) // 2] if len(own) > 1 else [t[: len(t) // 2 + 1] for t in own] for lang, own in texts.items()}
    tables = [_tables(own, wanted, contexts) for own in events]
    stack = lambda which, k: np.ascontiguousarray(np.stack([p[which][k] for p in tables], axis=1))
    index = lambda keys: [None, *map(HashIndex, keys[1:])]
    return PpmModel(langs, index(wanted), [stack(0, k) for k in range(ORDER + 1)], index(contexts), [stack(1, k) for k in range(ORDER + 1)])


def _costs(model: PpmModel, key: np.ndarray, k: int) -> np.ndarray:
    """Bits of the last byte of each sequence of k + 1 bytes: a row each, a column per language."""
    if not k:
        return model.costs[0][key]
    row = model.grams[k].find(key)
    out = model.costs[k][np.maximum(row, 0)]
    miss = np.nonzero(row < 0)[0]
    if len(miss):
        key = key[miss]
        context = model.contexts[k].find(key >> np.uint32(8))
        out[miss] = _costs(model, key & np.uint32((1 << 8 * k) - 1), k - 1) + np.where((context >= 0)[:, None], model.escapes[k][np.maximum(context, 0)], 0.0)
    return out


def byte_costs(model: PpmModel, data: bytes) -> np.ndarray:
    """Bits of every byte after the first three, given the three before it."""
    s = np.frombuffer(data, np.uint8).astype(np.uint32)
    return _costs(model, s[:-3] << np.uint32(24) | s[1:-2] << np.uint32(16) | s[2:-1] << np.uint32(8) | s[3:], ORDER)


def code_lengths(model: PpmModel, texts: list[bytes]) -> np.ndarray:
    """Code length in bits of every whole text, a row per text and a column per language."""
    out = np.zeros((len(texts), len(model.langs)))
    chunk = max(1024, 4 * CHUNK // max(4, len(model.langs)))
    parts: list[bytes] = []
    owner: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if parts:
            bits = byte_costs(model, b"".join(parts))
            ends = np.cumsum([len(p) for p in parts])
            starts = np.concatenate([[0], ends[:-1]])
            # Row i is that of byte i + 3: a part's rows, then those of the bytes before the next part.
            runs = np.stack([starts, ends - ORDER], axis=1).reshape(-1)[:-1]
            np.add.at(out, owner, np.add.reduceat(bits, runs, axis=0)[::2])
            parts.clear()
            owner.clear()
            size = 0

    for i, t in enumerate(texts):
        for at in range(0, len(t), chunk):
            head = t[at - ORDER : at] if at else b"\0" * ORDER
            parts.append(head + t[at : at + chunk])
            owner.append(i)
            size += len(parts[-1])
            if size >= chunk:
                flush()
    flush()
    return out


def predict(model: PpmModel, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
    """The language of least code length, and its posterior under equal priors."""
    bits = code_lengths(model, texts)
    best = bits.argmin(1)
    score = 1 / np.exp2(np.minimum(0, bits.min(1, keepdims=True) - bits)).sum(1)
    return [model.langs[i] for i in best], score


def sample_texts(labelled: DataFrame, per_language: int = TEXTS_PER_LANGUAGE, max_bytes: int = BYTES_PER_LANGUAGE, most: int = BYTES) -> dict[str, list[bytes]]:
    """At most ``per_language`` distinct texts of each ``lang`` in ``labelled`` (text, lang), by smallest text hash.

    The first pass ranks hashes only, a language's dealt over ``SALTS`` tasks that each pass on their smallest.  The
    second fetches the chosen texts: bounded by ``most`` bytes, so they may go to the driver.
    """
    keyed = labelled.where("text is not null and lang is not null").select("lang", "text", F.xxhash64("text").alias("h"))
    sizes = keyed.groupBy("lang", "h").agg(F.max(F.octet_length("text")).alias("n"))
    langs = [r["lang"] for r in sizes.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()]
    if not langs:
        return {}
    keyed, sizes = keyed.where(F.col("lang").isin(langs)), sizes.where(F.col("lang").isin(langs))
    limit = max(1, min(max_bytes, most // len(langs)))
    # Texts too long by themselves stand behind all others, the shortest first.
    sizes = sizes.withColumn("long", F.when(F.col("n") > limit, F.col("n")).otherwise(0)).withColumn("salt", F.pmod("h", F.lit(SALTS)))
    order = ("long", "h")
    few = sizes.withColumn("rk", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rk") <= per_language)
    w = Window.partitionBy("lang").orderBy(*order)
    top = few.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= per_language)
    chosen = top.withColumn("sum", F.sum("n").over(w)).where((F.col("sum") <= limit) | (F.col("rk") == 1)).select("lang", "h")
    rows = keyed.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.max(F.encode(F.col("text"), "utf-8")).alias("text"))
    out: dict[str, list[bytes]] = {}
    for r in sorted(rows.select("lang", "h", F.expr(f"left(text, {limit})").alias("text")).collect(), key=lambda r: (r["lang"], r["h"])):
        out.setdefault(r["lang"], []).append(bytes(r["text"]))
    return out


def identify(docs: DataFrame, model: PpmModel | None, prefix: str = "") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (names after ``prefix``); uses the column ``text`` alone."""
    spark = docs.sparkSession
    short_batches(spark)
    pred, score = f"{prefix}lang_pred", f"{prefix}score"
    if model is None:
        return docs.withColumns({pred: F.lit("und"), score: F.lit(0.0)})
    shared = spark.sparkContext.broadcast(model)

    def run(batch):
        names, p = predict(shared.value, [t.encode() if t else b"" for t in batch.to_pylist()])
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(p, pa.float64())], ["l", "p"])

    udf = F.arrow_udf(run, "l string, p double", F.ArrowUDFType.SCALAR)
    told = own_name(docs, f"{prefix}told")
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    out = docs.withColumn(told, udf(F.when(lettered, F.col("text"))))
    return out.withColumns({pred: F.when(lettered, F.col(told)["l"]).otherwise("und"), score: F.when(lettered, F.col(told)["p"]).otherwise(0.0)}).drop(told)


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learns from rows whose crc32(doc_id) mod 4 is not 2."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)).alias("held_out"))
    texts = sample_texts(docs.where(~F.col("held_out")))
    return identify(docs.select("doc_id", "held_out", "text"), train(texts) if texts else None).drop("text")
