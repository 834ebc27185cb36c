"""Document scores by prediction by partial matching over bytes, next to a smoothed word model.

The model is a byte-context trie of order ORDER, kept as tables of (context, symbol) counts by order: each shorter context's
counts are those of the longer ones added up. Escapes are estimated by method D (half a count for each distinct symbol),
and symbols seen in a longer context are excluded from the shorter ones. A text is the bytes of its words, each
followed by a space, and an end symbol; it starts in a context of end symbols. Probabilities therefore sum to one over
all texts, and the log probability of a symbol depends only on the ORDER bytes before it.

That makes scoring a lookup: documents are dealt to blocks of about BLOCK bytes, each block lists its distinct words and
byte sequences once, the lists are joined with the model, and every block is scored beside its own part of the model.
Nothing of the corpus passes through the driver but sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import held_out, stored, table
from .texts import GOLDEN, Words, pieces, texts_of, words_of

ORDER = 5
#: Symbols of a text, the bytes 0-255 without the six that separate words, plus space and end.
SPACE_BYTE, END_BYTE, SYMBOLS = 0x20, 0x0A, 252
ALPHA = 0.1
BLOCK = 24_000_000
#: Bytes of text that a Python worker handles at once.
PIECE = 400_000
#: Rows of a block's list that go back to Spark at once.
ROWS = 100_000
WORD, BYTES = 0, 1


def sequences(words: Words, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of ``order`` bytes of context and the symbol, for every symbol of every text, and each text's first place."""
    n = np.diff(words.bounds)
    size = words.end - words.start
    before = np.concatenate(([0], np.cumsum(size + 1)))
    content = before[words.bounds[1:]] - before[words.bounds[:-1]] + 1
    begin = np.cumsum(content + order) - content  # of each text, behind its context of end symbols
    at = before[:-1] + np.repeat(begin - before[words.bounds[:-1]], n)
    buffer = np.full(int((content + order).sum()), END_BYTE, np.uint8)
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    buffer[np.repeat(at, size) + inside] = words.data[np.repeat(words.start, size) + inside]
    buffer[at + size] = SPACE_BYTE
    codes = np.zeros(len(buffer) - order, np.uint64)
    for i in range(order + 1):
        codes <<= np.uint64(8)
        codes |= buffer[i:len(buffer) - order + i]
    counted = np.ones(len(codes), bool)
    skip = (begin[1:] - order)[:, None] + np.arange(order)[None] - order
    counted[skip.ravel()] = False
    return codes[counted], np.cumsum(content) - content


def _run_lengths(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if weights is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(keys))) if weights is None else np.add.reduceat(weights, first) if len(first) else weights
    return keys[first], counts


class BlockCounts:
    """The words and byte sequences of a block, and how often each occurs in texts that are learned from.

    Pieces are merged into one sorted list of each kind as they come, so memory follows the distinct keys.
    """

    def __init__(self, block: int, order: int):
        self.block, self.order = block, order
        self.found = {kind: (np.zeros(0, np.uint64), np.zeros(0, np.int64)) for kind in (WORD, BYTES)}

    def add(self, piece: pa.RecordBatch) -> None:
        one = np.uint64(1)
        words = words_of(texts_of(piece, "text"))
        held = piece.column(piece.schema.get_field_index("held_out")).to_numpy(zero_copy_only=False).astype(np.uint64)
        codes, first = sequences(words, self.order)
        owner = np.diff(np.append(first, len(codes)))
        for kind, keys in ((WORD, (words.hash >> one << one) | held[words.text]), (BYTES, (codes << one) | np.repeat(held, owner))):
            keys, counts = _run_lengths(keys)
            counts = np.where(keys & one, 0, counts)
            old_keys, old_counts = self.found[kind]
            self.found[kind] = _run_lengths(np.concatenate((old_keys, keys >> one)), np.concatenate((old_counts, counts)))

    def table(self) -> pa.RecordBatch:
        parts = [(np.full(len(keys), kind, np.int8), keys.view(np.int64), counts) for kind, (keys, counts) in self.found.items()]
        kinds, keys, counts = (np.concatenate(x) for x in zip(*parts))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(keys), self.block, np.int64)), pa.array(kinds), pa.array(keys), pa.array(counts)],
            ["block", "kind", "key", "n"])

    def batches(self) -> Iterator[pa.RecordBatch]:
        whole = self.table()
        for start in range(0, whole.num_rows, ROWS):
            yield whole.slice(start, ROWS)


def _count_split(order: int):
    """For rows as they are read: those of a block follow each other in one task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for piece in pieces(batches, "text", PIECE):
            blocks = piece.column(piece.schema.get_field_index("block")).to_numpy()
            cuts = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
            for a, b in zip(cuts, cuts[1:]):
                if now is None or now.block != blocks[a]:
                    if now is not None:
                        yield from now.batches()
                    now = BlockCounts(int(blocks[a]), order)
                now.add(piece.slice(a, b - a))
        if now is not None:
            yield from now.batches()

    return count


def _count_group(order: int):
    def count(group: pa.Table) -> pa.Table:
        counts = BlockCounts(group["block"][0].as_py(), order)
        for piece in pieces(iter(group.to_batches()), "text", PIECE):
            counts.add(piece)
        return pa.Table.from_batches([counts.table()])

    return count


class Lookup:
    """Values by 64-bit key for whole arrays: one probe of a hash table, a search for what collided."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = np.uint64(64 - max(4, int(2 * len(keys)).bit_length()))
        slots = self._slot(keys)
        self.keys = np.full(1 << (64 - int(self.shift)), np.iinfo(np.uint64).max, np.uint64)
        self.values = np.full(len(self.keys), np.nan)
        self.keys[slots], self.values[slots] = keys, values
        lost = np.flatnonzero(self.keys[slots] != keys)
        lost = lost[np.argsort(keys[lost])]
        self.rest, self.rest_values = keys[lost], values[lost]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * GOLDEN) >> self.shift

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slot(keys)
        out = self.values[slots]
        miss = np.flatnonzero(self.keys[slots] != keys)
        if len(miss):
            at = np.searchsorted(self.rest, keys[miss])
            if not len(self.rest) or at.max() >= len(self.rest) or (self.rest[at] != keys[miss]).any():
                raise ValueError("a block's model lacks a key of its texts")
            out[miss] = self.rest_values[at]
        return out


def _score(order: int, total: int, distinct: int, texts: int):
    def score(docs: pa.Table, model: pa.Table) -> pa.Table:
        kind, key, value = (model[c].to_numpy() for c in ("kind", "key", "value"))
        known, symbol = (Lookup(key[kind == k].view(np.uint64), value[kind == k]) for k in (WORD, BYTES))
        scale = total + ALPHA * (distinct + 1)
        end = np.log10((texts + ALPHA) / scale)
        out = []
        for piece in pieces(iter(docs.to_batches()), "text", PIECE):
            words = words_of(texts_of(piece, "text"))
            codes, first = sequences(words, order)
            counts = known[words.hash >> np.uint64(1)]
            sums = np.stack([np.append(0.0, np.cumsum(x))[words.bounds] for x in (np.log10((counts + ALPHA) / scale), counts > 0)])
            base, seen = sums[:, 1:] - sums[:, :-1]
            out.append(pa.RecordBatch.from_arrays(
                [piece.column(piece.schema.get_field_index("id")), piece.column(piece.schema.get_field_index("held_out")),
                 pa.array(np.diff(words.bounds) + 1, pa.int64()), pa.array(seen.astype(np.int64) + (texts > 0)),
                 pa.array(base + end), pa.array(np.add.reduceat(symbol[codes], first))],
                ["id", "held_out", "n_tokens", "n_known", "base_score", "score"]))
        return pa.Table.from_batches(out)

    return score


def symbol_scores(sequences_seen: DataFrame, order: int) -> DataFrame:
    """(key, value): log10 probability of the last byte of each sequence after those before it.

    ``sequences_seen`` (key, n) holds every sequence of order + 1 bytes that is asked for, with its training count or 0.
    """
    def mask(k: int) -> int:
        return (1 << (8 * (k + 1))) - 1

    counts = {order: stored(sequences_seen.where("n > 0").select(F.col("key").alias("g"), "n"))}
    for k in range(order - 1, -1, -1):
        counts[k] = stored(counts[k + 1].groupBy(F.col("g").bitwiseAND(F.lit(mask(k)).cast("long")).alias("g")).agg(F.sum("n").alias("n")))
    contexts = {}
    for k in range(order + 1):
        own = counts[k].withColumn("c", F.shiftright("g", 8))
        if k:
            # how often the symbols of a context follow the one that is a byte shorter
            shorter = counts[k - 1].select(F.col("g").alias("s"), F.col("n").alias("m"))
            own = own.join(shorter, F.col("g").bitwiseAND(F.lit(mask(k - 1)).cast("long")) == F.col("s"))
        else:
            own = own.withColumn("m", F.lit(0).cast("long"))
        contexts[k] = stored(own.groupBy("c").agg(
            F.sum("n").alias("total"), F.count("*").alias("distinct"), F.sum("m").alias("shorter")))
    state = sequences_seen.select("key", "n", F.lit(None).cast("double").alias("value"), F.lit(0.0).alias("escaped"),
                                  F.lit(0).cast("long").alias("out"), F.lit(0).cast("long").alias("out_kinds"))
    for k in range(order, -1, -1):
        g = F.col("key").bitwiseAND(F.lit(mask(k)).cast("long"))
        if k < order:
            # only what the longer contexts did not predict is still looked up
            open_g = F.when(F.col("value").isNull(), g)
            state = state.drop("n").join(counts[k].withColumnRenamed("g", "_g"), open_g == F.col("_g"), "left").drop("_g")
        else:
            state = state.withColumn("n", F.nullif("n", F.lit(0)))
        state = state.join(contexts[k], F.when(F.col("value").isNull(), F.shiftright(g, 8)) == F.col("c"), "left").drop("c")
        total, kinds = F.col("total") - F.col("out"), F.col("distinct") - F.col("out_kinds")
        live = F.col("total").isNotNull() & (kinds > 0) & F.col("value").isNull()
        state = state.withColumns({
            "value": F.when(live & F.col("n").isNotNull(), F.col("escaped") + F.log10((F.col("n") - 0.5) / total)).otherwise(F.col("value")),
            "escaped": F.col("escaped") + F.when(live & F.col("n").isNull(), F.log10(0.5 * kinds / total)).otherwise(0.0),
            "out": F.coalesce("shorter", F.lit(0).cast("long")), "out_kinds": F.coalesce("distinct", F.lit(0).cast("long")),
        }).drop("total", "distinct", "shorter")
        if k == order:
            # most sequences are predicted here; the rest is the small part that goes on
            state = stored(state)
            predicted, state = state.where("value IS NOT NULL").select("key", "value"), state.where("value IS NULL")
    seen = contexts[0].agg(F.coalesce(F.max("distinct"), F.lit(0))).first()[0]
    never = F.col("escaped") + F.log10(F.lit(1.0 / max(1, SYMBOLS - seen)))
    return predicted.unionByName(state.select("key", F.coalesce("value", never).alias("value")))


def scores(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 10, order: int = ORDER, block: int = BLOCK,
           splits: bool = False) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    Learns from the rows whose CRC-32 of the id as text is not divisible by ``folds`` (a null id counts as empty text and is
    held out). Texts are lower-cased (A-Z); null and empty ones are a lone end. ``score`` is the log10 probability of the
    text under the byte model, ``base_score`` under word counts smoothed by ALPHA. Repeated rows count as often as
    they occur. Without training rows all symbols are equally likely. An empty table gives no rows.

    With ``splits``, for a table read straight from files, a block is an input split, so the texts are counted where they are
    read and shuffled only once; otherwise blocks are dealt by hash. A block's texts and model fit a task's memory.
    """
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), held_out(key, folds).alias("held_out"))
    size, texts = rows.agg(F.sum(F.octet_length("text")), F.count(F.when(~F.col("held_out"), 1))).first()
    listed = "block long, kind byte, key long, n long"
    if splits:
        rows = rows.withColumn("block", F.xxhash64(F.input_file_name(), F.input_file_block_start()))
        found = stored(rows.select("block", "text", "held_out").mapInArrow(_count_split(order), listed))
    else:
        blocks = max(1, -(-(size or 0) // block))
        rows = rows.withColumn("block", F.pmod(F.xxhash64("id", F.octet_length("text")), F.lit(blocks).cast("long")))
        found = stored(rows.select("block", "text", "held_out").groupBy("block").applyInArrow(_count_group(order), listed))
    keys = stored(found.groupBy("kind", "key").agg(F.sum("n").alias("n")))
    words = keys.where(F.col("kind") == WORD)
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    total, distinct = total + texts, distinct + (texts > 0)
    symbols = symbol_scores(keys.where(F.col("kind") == BYTES).select("key", "n"), order)
    model = words.select("kind", "key", F.col("n").cast("double").alias("value")).unionByName(
        symbols.select(F.lit(BYTES).cast("byte").alias("kind"), "key", "value"))
    local = found.select("block", "kind", "key").join(model, ["kind", "key"])
    kind = dict(rows.dtypes)["id"]
    out = rows.groupBy("block").cogroup(local.groupBy("block")).applyInArrow(
        _score(order, total, distinct, texts),
        f"id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select(F.col("id").alias(key), "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
                      "base_score", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    return scores(table(spark, sf_dir, "documents"), splits=True)
