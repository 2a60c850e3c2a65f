"""Training-order materialisation: token sequences in a keyed order, as fixed-stride shard files.

Texts become token ids (SentencePiece BPE, closed by an end token), written once
as a token table in which every row knows its offset inside its partition;
the partition totals give the global offset, so the whole corpus is one
stream cut into sequences of ``seq_len`` ids without padding (the last
sequence is filled with the end token). A keyed Feistel permutation with
cycle-walking maps the sequence number to its global slot, a bijection on
0..n-1. Fragments are range-partitioned by shard, put in slot order inside
the task and streamed into shard files of ``seqs_per_shard`` records of
``2 * seq_len`` bytes: slot s is record ``s % seqs_per_shard`` of shard
``s // seqs_per_shard``, so a reader can resume at any slot by seeking.

A shard is written under a task's own name and renamed when complete: a
rerun writes the same bytes again. The folder is on storage that all
executors share; without a scheme it belongs to Hadoop's default file system
(``storage``). The order is keyed by the texts' place in the input: another
split of the input files numbers them otherwise, and so gives another order
under the same key.

Defined results: null text counts as empty; an empty text is its end token
alone; repeated rows are repeated texts; an empty table has no sequence.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridemart.llm import tokens as tk
from ridemart.llm.frames import slim, task_partitions
from ridemart.llm.merge_dropout import MODEL, segmented, vocabulary
from ridemart.llm.storage import opened, qualified
from ridemart.plans.joins import maybe_broadcast
from ridemart.session import scratch_path

END_TOKEN = 2            # </s>; ids fit 16 bits
SEQ_LEN = 1024
SEQS_PER_SHARD = 4096
KEY = 0x5EED
ROUNDS = 6


def feistel(index: np.ndarray, n: int, key: int, rounds: int = ROUNDS) -> np.ndarray:
    """Keyed bijection on 0..n-1: a balanced Feistel network over the next even power of two, walked until inside."""
    x = np.asarray(index).astype(np.uint64)
    half = np.uint64(max(1, ((max(n, 2) - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = tk.mix(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))

    def permute(v):
        left, right = v >> half, v & mask
        for k in keys:
            left, right = right, left ^ (tk.mix(right ^ k) & mask)
        return (left << half) | right

    out = permute(x)
    walk = np.flatnonzero(out >= n)
    while len(walk):
        out[walk] = permute(out[walk])
        walk = walk[out[walk] >= n]
    return out.astype(np.int64)


def _tokenise(model: str):
    def run(batches):
        v, pid, upto = vocabulary(model), TaskContext.get().partitionId(), 0
        for b in batches:
            for lo, t in tk.slices(b.column(1)):
                u = tk.Units(t)
                values, size = segmented(model, 0).encode(u, v, 0)
                edge = np.concatenate([[0], np.cumsum(size)])[u.first]
                some = np.diff(t.off) > 0                               # the unit of an empty text is its leading space alone
                if not some.all():
                    values = values[np.repeat(some, np.diff(edge))]
                n = np.diff(edge) * some
                values = np.insert(values, np.cumsum(n), END_TOKEN)     # closes every text
                n += 1
                edge = np.concatenate([[0], np.cumsum(n)])
                tokens = pa.Array.from_buffers(pa.binary(), t.n, [None, pa.py_buffer((edge * 2).astype(np.int32)),
                                                                  pa.py_buffer(values.astype("<u2").tobytes())])
                start = upto + edge[:-1]
                upto += int(edge[-1])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, t.n), pa.array(np.full(t.n, pid), pa.int32()), pa.array(start, pa.int64()),
                     pa.array(n, pa.int64()), tokens], names=["doc_id", "part", "start", "n_tokens", "tokens"])
    return run


def _fragments(seq_len: int, n_seq: int, total: int, key: int, rows: int = 2_000):
    """Cut every text's tokens at sequence borders, each fragment compressed by itself."""
    def run(batches):
        codec = pa.Codec("zstd", compression_level=5)
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                b = batch.slice(lo, rows)
                start, n = np.asarray(b.column("at")), np.asarray(b.column("n_tokens"))
                first = start // seq_len
                count = (start + n - 1) // seq_len - first + 1
                row = np.repeat(np.arange(len(n)), count)
                seq = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]
                a, z = np.maximum(seq * seq_len, start[row]), np.minimum((seq + 1) * seq_len, (start + n)[row])
                blobs = b.column("tokens")
                raw = [blobs[i].as_buffer() for i in range(len(n))]
                parts = [codec.compress(raw[r][x:y], asbytes=True)
                         for r, x, y in zip(row.tolist(), ((a - start[row]) * 2).tolist(), ((z - start[row]) * 2).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(feistel(seq, n_seq, key)), pa.array(seq), pa.array(a - seq * seq_len, pa.int32()),
                     pa.array(z - a, pa.int32()), pa.array(parts, pa.binary())], names=["slot", "seq", "at", "n", "tokens"])
    return run


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def _write(folder: str, seq_len: int, per_shard: int, n_seq: int):
    def run(batches):
        store, base = opened(folder)
        me = f"{TaskContext.get().taskAttemptId()}"
        codec = pa.Codec("zstd")
        shard, out, slot, seq, parts, rows = -1, None, -1, -1, [], []
        end = np.uint16(END_TOKEN).tobytes()

        def close_slot():
            if slot >= 0:
                record = b"".join(parts)
                if seq == n_seq - 1:                    # the last sequence is filled
                    record += end * (seq_len - len(record) // 2)
                if len(record) != 2 * seq_len:
                    raise ValueError(f"slot {slot} holds {len(record)} bytes")
                out.write(record)
                rows.append((slot, seq, shard, slot % per_shard * 2 * seq_len, hashlib.sha256(record).hexdigest()))

        def close_shard():
            if out is not None:
                out.close()
                store.move(f"{base}/.{shard_name(shard)}.{me}", f"{base}/{shard_name(shard)}")

        def flush():
            got = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (
                pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["slot", "seq", "shard", "byte_offset", "sha256"])
            rows.clear()
            return got

        for b in batches:
            for s, q, n, blob in zip(*(b.column(c).to_pylist() for c in ("slot", "seq", "n", "tokens"))):
                if s != slot:
                    close_slot()
                    if s // per_shard != shard:
                        close_shard()
                        shard = s // per_shard
                        out = store.open_output_stream(f"{base}/.{shard_name(shard)}.{me}")
                    slot, seq, parts = s, q, []
                parts.append(codec.decompress(blob, 2 * n, asbytes=True))
            if rows:
                yield flush()
        close_slot()
        close_shard()
        if rows:
            yield flush()
    return run


def materialise_order(docs: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                      model: str = MODEL, seq_len: int = SEQ_LEN, seqs_per_shard: int = SEQS_PER_SHARD,
                      key: int = KEY) -> DataFrame:
    """Write the shards under ``folder``/shards and return the manifest: one row per sequence.

    Manifest (also kept as Parquet in ``folder``/manifest): slot, seq (its number in the
    stream), shard, byte_offset, sha256 of the record. ``folder``/tokens holds the token
    table (doc_id, part, start, n_tokens, tokens); ``folder`` is new or empty.
    """
    spark = docs.sparkSession
    folder = qualified(spark, folder or scratch_path(spark, "llm-shards"))
    schema = "doc_id long, part int, start long, n_tokens long, tokens binary"
    (slim(docs, id_col, text_col).mapInArrow(_tokenise(model), schema)
     .write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", "9").parquet(f"{folder}/tokens"))
    table = spark.read.schema(schema).parquet(f"{folder}/tokens")
    totals = table.groupBy("part").agg(F.sum("n_tokens").alias("n"))            # a row per input split
    bases = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    total = totals.agg(F.sum("n")).first()[0] or 0
    n_seq = -(-total // seq_len)
    store, path = opened(folder)
    store.create_dir(f"{path}/shards", recursive=True)
    placed = table.join(maybe_broadcast(bases), "part").select((F.col("base") + F.col("start")).alias("at"), "n_tokens", "tokens")
    n_shards = max(1, -(-n_seq // seqs_per_shard))
    n_tasks = min(n_shards, task_partitions(spark))
    # consecutive shards to each task; slots are a permutation, so their ranges are known without a sample
    task = F.expr(f"cast((slot div {seqs_per_shard}) * {n_tasks} div {n_shards} as int)")
    (placed.mapInArrow(_fragments(seq_len, n_seq, total, key), "slot long, seq long, at int, n int, tokens binary")
     .repartitionById(n_tasks, task).sortWithinPartitions("slot", "at")
     .mapInArrow(_write(f"{folder}/shards", seq_len, seqs_per_shard, n_seq),
                 "slot long, seq long, shard long, byte_offset long, sha256 string")
     .write.option("compression", "zstd").parquet(f"{folder}/manifest"))
    return spark.read.parquet(f"{folder}/manifest")


def read_slots(folder: str, first_slot: int, count: int, seq_len: int = SEQ_LEN,
               seqs_per_shard: int = SEQS_PER_SHARD) -> np.ndarray:
    """``count`` sequences from ``first_slot`` on, read sequentially (a resumed reader's view)."""
    store, base = opened(folder if ":" in folder else f"file://{folder}")
    got, slot = [], first_slot
    while slot < first_slot + count:
        shard, rec = divmod(slot, seqs_per_shard)
        n = min(seqs_per_shard - rec, first_slot + count - slot)
        with store.open_input_file(f"{base}/{shard_name(shard)}") as f:
            f.seek(rec * 2 * seq_len)
            got.append(np.frombuffer(f.read(n * 2 * seq_len), "<u2"))
        slot += n
    return np.concatenate(got).reshape(-1, seq_len) if got else np.zeros((0, seq_len), np.uint16)
