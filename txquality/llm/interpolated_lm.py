"""Language-model scores by deleted interpolation.

P(w | v) mixes the maximum-likelihood estimates of the pair (v, w) and of the
word w with a uniform share. The three weights depend on how often the context
v was seen: contexts are put into buckets by the logarithm of their count, and
each bucket's weights are learned by expectation-maximisation. For that a tenth
of the training documents is deleted: their pairs are the held-out counts, and
the estimates under them are those of the other nine tenths. Scores then use
the counts of all training documents.

How it is spread: documents are dealt into blocks of about BLOCK_BYTES of text
by a hash. A block sends each distinct word and pair once, sorted and packed,
to the task that owns that range of hashes; owners add up the counts and answer
in the same order; the block then knows the count of every token. A word that
is in every document is thus sent once for each block. What a block learned is
written as packed counts, from which weights and scores are computed without
the texts. The driver sees totals and at most 3 x BUCKETS sums a round.

Tokens are runs of bytes other than space and 09-0D, lower-cased (A-Z), then
one end token. The context of a text's first token is the start, seen once for
each training document. Words are counted by a 64-bit hash.

Defined cases: a NULL or empty text is its end token alone; documents that
repeat count as often as they stand there; a NULL id belongs to training;
without training documents every token has the uniform share of an empty
vocabulary, 1; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txquality.llm import textkit as tk
from txquality.session import stored

BLOCK_BYTES = 16 << 20
LEAST_BLOCKS = 64
ROW_BYTES = 64
DELETED_PARTS = 10
BUCKETS = 48
ROUNDS = 20
SETTLED = 1e-4
_END = np.uint64(tk.hash_word(b"\x00 end"))
_START = np.uint64(tk.hash_word(b"\x00 start"))


def tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens with the end tokens, hashes of the pairs they end, and the rows' token bounds."""
    starts, ends, rows = tk.spans(data, bounds, tk.NOT_SPACE)
    words = tk.hash_spans(tk.LOWER[data], starts, ends)
    n = len(rows) - 1
    rows = rows + np.arange(n + 1)
    out = np.empty(len(words) + n, np.uint64)
    last = rows[1:] - 1
    inner = np.ones(len(out), bool)
    inner[last] = False
    out[inner], out[last] = words, _END
    before = np.empty_like(out)
    before[1:] = out[:-1]
    before[rows[:-1]] = _START
    return out, tk.mix(tk.mix(before) + out), rows


def _tokens_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of a block, computed piece by piece."""
    words, pairs, sizes = [], [], []
    for piece in tk.pieces(iter(table.select(["text"]).combine_chunks().to_batches())):
        w, p, rows = tokens(*tk.text_bytes(piece.column(0)))
        words.append(w), pairs.append(p), sizes.append(np.diff(rows))
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *words]), np.concatenate([none, *pairs]), np.concatenate([np.zeros(0, np.int64), *sizes]).astype(np.int64)


def _owners(keys: np.ndarray, owners: int) -> np.ndarray:
    """Bounds of each owner's share of ascending keys."""
    owner = ((keys >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)
    return np.searchsorted(owner, np.arange(owners + 1))


def _ask(owners: int):
    def run(table: pa.Table) -> pa.Table:
        words, pairs, sizes = _tokens_of(table)
        block = table.column("block")[0].as_py()
        trained = np.repeat(~table.column("held_out").to_numpy(), sizes)
        rows = {k: [] for k in ("block", "kind", "owner", "keys", "counts")}
        for kind, hashes in enumerate((words, pairs)):
            keys, which = np.unique(hashes, return_inverse=True)
            counts = np.bincount(which, trained, len(keys)).astype(np.int64)
            at = _owners(keys, owners)
            for owner in np.flatnonzero(np.diff(at)):
                a, b = at[owner], at[owner + 1]
                for name, value in zip(rows, (block, kind, int(owner), tk.pack_sorted(keys[a:b]), tk.pack(counts[a:b]))):
                    rows[name].append(value)
        return pa.table({"block": pa.array(rows["block"], pa.int64()), "kind": pa.array(rows["kind"], pa.int32()), "owner": pa.array(rows["owner"], pa.int32()), "keys": pa.array(rows["keys"], pa.binary()), "counts": pa.array(rows["counts"], pa.binary())})

    return run


def _answer(deleted_from: int):
    """Counts over all blocks for the keys of each block, in its order; and one row of totals."""

    def run(table: pa.Table) -> pa.Table:
        blocks = table.column("block").to_numpy()
        kind, owner = table.column("kind")[0].as_py(), table.column("owner")[0].as_py()
        keys = [tk.unpack_sorted(b) for b in table.column("keys").to_pylist()]
        counts = [tk.unpack(b).astype(np.int64) for b in table.column("counts").to_pylist()]
        sizes = np.array([len(k) for k in keys])
        distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
        every, kept = np.concatenate(counts), np.repeat(blocks < deleted_from, sizes)
        total = np.bincount(which, every, len(distinct)).astype(np.int64)
        retained = np.bincount(which[kept], every[kept], len(distinct)).astype(np.int64)
        at = np.concatenate(([0], np.cumsum(sizes)))
        parts = [which[a:b] for a, b in zip(at, at[1:])]
        answers = [tk.pack(total[p]) for p in parts] + [b""]
        partial = [tk.pack(retained[p]) if b >= deleted_from else b"" for p, b in zip(parts, blocks)]
        partial.append(tk.pack(np.array([(total > 0).sum(), total.sum(), retained.sum()])))
        return pa.table({
            "block": pa.array([*blocks.tolist(), -1], pa.int64()), "kind": pa.array([kind] * (len(blocks) + 1), pa.int32()),
            "owner": pa.array([owner] * (len(blocks) + 1), pa.int32()), "total": pa.array(answers, pa.binary()), "retained": pa.array(partial, pa.binary()),
        })

    return run


_LEARNED = "block long, ids array<{id}>, held_out array<boolean>, sizes binary, known binary, logs array<double>, words binary, pairs binary, kept_words binary, kept_pairs binary, totals array<long>"


def _learn(id_type: pa.DataType, deleted_from: int):
    """Counts of every token of a block, from the owners' answers."""
    schema = pa.schema([
        ("block", pa.int64()), ("ids", pa.list_(id_type)), ("held_out", pa.list_(pa.bool_())), ("sizes", pa.binary()), ("known", pa.binary()), ("logs", pa.list_(pa.float64())),
        ("words", pa.binary()), ("pairs", pa.binary()), ("kept_words", pa.binary()), ("kept_pairs", pa.binary()), ("totals", pa.list_(pa.int64())),
    ])

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        kinds, owners = answers.column("kind").to_numpy(), answers.column("owner").to_numpy()
        if docs.num_rows == 0:
            totals = sum(tk.unpack(b).astype(np.int64) for b, k in zip(answers.column("retained").to_pylist(), kinds) if k == 0)
            return pa.Table.from_pylist([{"block": -1, "totals": totals.tolist()}], schema)
        words, pairs, sizes = _tokens_of(docs)
        block = docs.column("block")[0].as_py()
        found = {}
        for kind, hashes in enumerate((words, pairs)):
            _, which = np.unique(hashes, return_inverse=True)
            own = np.flatnonzero(kinds == kind)
            own = own[np.argsort(owners[own])]
            for name in ("total", "retained")[: 1 + (block >= deleted_from)]:
                blobs = answers.column(name).take(pa.array(own)).to_pylist()
                found[kind, name] = np.concatenate([tk.unpack(b).astype(np.int64) for b in blobs])[which]
        count = found[0, "total"]
        at = np.cumsum(sizes) - sizes
        row = {
            "block": block, "ids": docs.column("doc_id").to_pylist(), "held_out": docs.column("held_out").to_pylist(), "sizes": tk.pack(sizes),
            "known": tk.pack(np.add.reduceat((count > 0).astype(np.int64), at)), "logs": np.add.reduceat(np.log10(count + 1.0), at),
            "words": tk.pack(count), "pairs": tk.pack(found[1, "total"]), "totals": None,
            "kept_words": tk.pack(found[0, "retained"]) if block >= deleted_from else None, "kept_pairs": tk.pack(found[1, "retained"]) if block >= deleted_from else None,
        }
        return pa.Table.from_pylist([row], schema)

    return run


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the whole logarithm of its count."""
    return np.minimum(np.frexp(context.astype(np.float64))[1], BUCKETS - 1)


def estimates(words: np.ndarray, pairs: np.ndarray, sizes: np.ndarray, total: int, vocabulary: int) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
    """Maximum-likelihood estimates of pair and word, the uniform share, and the contexts' buckets.

    The start's count is that of the end token, the last of each text.
    """
    last = np.cumsum(sizes) - 1
    context = np.empty_like(words)
    context[1:] = words[:-1]
    context[last - sizes + 1] = words[last]
    by_pair = np.where(context > 0, pairs / np.maximum(context, 1), 0.0)
    return by_pair, words / max(total, 1), 1.0 / (vocabulary + 1), bucket_of(context)


def _expect(weights: np.ndarray, retained: int, vocabulary: int):
    """One pass of expectation: how much of each bucket's held-out tokens each estimate explains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((BUCKETS, 3))
        for batch in batches:
            for words, pairs, sizes in zip(*(batch.column(i).to_pylist() for i in range(3))):
                two, one, none, bucket = estimates(tk.unpack(words).astype(np.int64), tk.unpack(pairs).astype(np.int64), tk.unpack(sizes).astype(np.int64), retained, vocabulary)
                parts = weights[bucket] * np.stack((two, one, np.full(len(one), none)), 1)
                parts /= parts.sum(1, keepdims=True)
                for k in range(3):
                    sums[:, k] += np.bincount(bucket, parts[:, k], BUCKETS)
        held = np.flatnonzero(sums.sum(1))
        yield pa.RecordBatch.from_arrays([pa.array(held), *(pa.array(sums[held, k]) for k in range(3))], ["bucket", "two", "one", "none"])

    return run


def learn_weights(learned: DataFrame, retained: int, vocabulary: int) -> np.ndarray:
    """Weights (pair, word, uniform) of each bucket of context counts."""
    weights = np.tile([0.4, 0.4, 0.2], (BUCKETS, 1))
    weights[0] = [0.0, 0.8, 0.2]
    deleted = learned.where("kept_words is not null").select("kept_words", "kept_pairs", "sizes")
    for _ in range(ROUNDS):
        found = deleted.mapInArrow(_expect(weights, retained, vocabulary), "bucket long, two double, one double, none double").groupBy("bucket").agg(F.sum("two"), F.sum("one"), F.sum("none")).collect()
        if not found:
            break
        fresh = weights.copy()
        for bucket, *sums in found:
            grown = np.array(sums) + (0.0 if bucket == 0 else 0.1, 0.1, 0.1)
            fresh[bucket] = grown / grown.sum()
        moved = np.abs(fresh - weights).max()
        weights = fresh
        if moved < SETTLED:
            break
    return weights


def _score(weights: np.ndarray, total: int, vocabulary: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one_row = {name: batch.column(j)[i] for j, name in enumerate(batch.schema.names)}
                sizes = tk.unpack(one_row["sizes"].as_py()).astype(np.int64)
                words, pairs = (tk.unpack(one_row[k].as_py()).astype(np.int64) for k in ("words", "pairs"))
                two, one, none, bucket = estimates(words, pairs, sizes, total, vocabulary)
                mixed = weights[bucket, 0] * two + weights[bucket, 1] * one + weights[bucket, 2] * none
                score = np.add.reduceat(np.log10(mixed), np.cumsum(sizes) - sizes)
                base = one_row["logs"].values.to_numpy() - sizes * math.log10(total + vocabulary + 1)
                n = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [one_row["ids"].values, one_row["held_out"].values, pa.array(sizes), pa.array(tk.unpack(one_row["known"].as_py()).astype(np.int64)), pa.array(np.full(n, total)), pa.array(base), pa.array(score)],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return run


def score_documents(docs: DataFrame, held_out) -> DataFrame:
    """Scores of all documents by a model of those that ``held_out`` (a Column) is not true for."""
    id_type = docs.schema["doc_id"].dataType
    kind = id_type.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    weight = rows.agg(F.sum(F.octet_length("text") + ROW_BYTES)).first()[0] or 0
    blocks = max(LEAST_BLOCKS, math.ceil(weight / BLOCK_BYTES))
    deleted_blocks = max(1, blocks // DELETED_PARTS)
    owners = max(1, blocks // 2)
    draw = F.xxhash64("doc_id", "text")
    deleted = ~F.col("held_out") & (F.pmod(F.shiftright(draw, 32), F.lit(DELETED_PARTS)) == 0)
    placed = rows.withColumn("block", F.when(deleted, F.lit(blocks) + F.pmod(draw, F.lit(deleted_blocks))).otherwise(F.pmod(draw, F.lit(blocks))).cast("long"))
    asked = placed.groupBy("block").applyInArrow(_ask(owners), "block long, kind int, owner int, keys binary, counts binary")
    answered = asked.groupBy("kind", "owner").applyInArrow(_answer(blocks), "block long, kind int, owner int, total binary, retained binary")
    from pyspark.sql.pandas.types import to_arrow_type

    learned = stored(placed.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(_learn(to_arrow_type(id_type), blocks), _LEARNED.format(id=kind)), "lm-counts")
    totals = learned.where("block = -1").select("totals").collect()
    vocabulary, total, retained = totals[0][0] if totals else (0, 0, 0)
    weights = learn_weights(learned, retained, vocabulary)
    return learned.where("block >= 0").select("ids", "held_out", "sizes", "known", "logs", "words", "pairs").mapInArrow(
        _score(weights, total, vocabulary), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
