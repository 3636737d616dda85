"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of documents in seeded order. A round gives a source the quantum ``window * share`` and
sends its next packets (at most ``packet`` tokens, never over a document's end) while the deficit it has saved up
covers them; what is left is carried on. So packet p of a queue is sent in round ``ceil(end / quantum) - 1``,
where ``end`` counts the queue's tokens up to the packet's end: deficits are a matter of prefix sums, and they
carry over windows and partitions without any task waiting for another. Rounds laid end to end, sources in
order within a round, are the stream that is cut into windows; a packet on a cut goes on in the next window.

At any point of the stream a source is within a packet and a quantum of its target share. ``weights`` are the targets, by name or as
an expression; a queue that has run dry leaves its part to the others, so targets hold until the first queue ends. Without weights
the target is each source's share of all tokens, and all queues end together.

Prefix sums are taken in two or three levels (hash bucket in a queue, rounds, chunks of rounds), so no task
holds more than a bucket, and the largest source is spread over all of them. Token ids are written to a table
once; they move once more, to meet their document's places.

Defined cases: a null text counts as empty and has the end token alone; a null source is a queue of its own; rows
that repeat a doc_id are packed each for itself; a text longer than a window goes on in others. Weights that are null or not
positive count as the least of the others. Other columns, whatever their names, are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campanile.llm.common import split_large, written
from campanile.llm.tokens import tokenizer

WINDOW = 4096
PACKET = 256
END_ID = 2
BUCKETS = 4096
ROUNDS_IN_CHUNK = 64


def tokenized(docs: DataFrame, source: str, id_col: str, source_col: str, text_col: str, end_id: int = END_ID) -> DataFrame:
    """(part, row, id, queue, n, ids) for each row: ids as little-endian unsigned 16 or 32-bit integers."""
    file = docs.sparkSession.sparkContext.broadcast(source)
    key = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("null"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), key.alias("queue"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, end = TaskContext.get().partitionId(), 0, np.uint32(end_id).tobytes()
        model = None

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(2).cast(pa.large_binary()).to_pylist()
            ids = [model.encode(t or b"") + end for t in texts]
            n = pa.array([len(x) // 4 for x in ids], pa.int64())
            small = [np.frombuffer(x, "<u4").astype("<u2").tobytes() for x in ids] if model.narrow else ids
            places = pa.array(np.arange(at, at + len(ids), dtype=np.int64))
            return pa.RecordBatch.from_arrays([pa.array([part] * len(ids), pa.int64()), places, batch.column(0), batch.column(1), n, pa.array(small, pa.binary())], ["part", "row", "id", "queue", "n", "ids"])

        for batch in batches:
            if batch.num_rows:
                model = model or tokenizer(file.value)
                for out in split_large(batch, one):
                    yield out
                    at += out.num_rows

    return rows.mapInArrow(run, "part long, row long, id long, queue string, n long, ids binary")


def queue_places(rows: DataFrame, seed: int, buckets: int = BUCKETS) -> DataFrame:
    """(part, row, queue, n, before): tokens of the queue before each document in seeded order."""
    h = F.xxhash64(F.lit(seed), "id")
    rows = rows.select("part", "row", "id", "queue", "n", h.alias("h")).withColumn("bucket", F.pmod(F.col("h"), F.lit(buckets)))
    sums = rows.groupBy("queue", "bucket").agg(F.sum("n").alias("total"))
    order = Window.partitionBy("queue").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("queue", "bucket", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("bucket_start"))
    inner = Window.partitionBy("queue", "bucket").orderBy("h", "id", "part", "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(starts, ["queue", "bucket"]).withColumn("before", F.col("bucket_start") + F.coalesce(F.sum("n").over(inner), F.lit(0)))
    return placed.select("part", "row", "queue", "n", "before")


def quanta(rows: DataFrame, window: int, weights: dict[str, float] | Column | None = None) -> DataFrame:
    """(queue, quantum): a round's tokens of each source; default: its share of all tokens.

    weights: by the source's name, or an expression over a table with a row for each source, whose column is ``source``.
    """
    totals = rows.groupBy("queue").agg(F.sum("n").alias("total")).withColumn("source", F.when(F.col("queue") != "null", F.expr("substring(queue, 2)")))
    if weights is None:
        share = F.col("total")
    elif isinstance(weights, dict):
        named = F.create_map(*[F.lit(x) for k, w in weights.items() for x in (f"={k}", float(w))])
        share = F.try_element_at(named, F.col("queue"))
    else:
        share = weights
    totals = totals.withColumn("given", share.cast("double"))
    least = F.min(F.when(F.col("given") > 0, F.col("given"))).over(Window.partitionBy())
    totals = totals.withColumn("share", F.when(F.col("given") > 0, F.col("given")).otherwise(F.coalesce(least, F.lit(1.0))))
    whole = F.sum("share").over(Window.partitionBy())  # a row for each source
    return totals.select("queue", (F.lit(float(window)) * F.col("share") / whole).alias("quantum"))


def stream_places(packets: DataFrame, chunk_rounds: int = ROUNDS_IN_CHUNK) -> DataFrame:
    """packets with ``at``: its tokens' place in the stream, by (round, queue, queue offset)."""
    packets = packets.withColumn("chunk", F.floor(F.col("round") / chunk_rounds)).withColumn("span", F.floor(F.col("chunk") / 4096))
    chunks = packets.groupBy("span", "chunk").agg(F.sum("len").alias("total"))
    spans = chunks.groupBy("span").agg(F.sum("total").alias("total"))
    rows = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    # one row for each 4096 chunks of 64 rounds, about a billion tokens each
    span_start = spans.select("span", F.coalesce(F.sum("total").over(rows(Window.orderBy("span"))), F.lit(0)).alias("span_start"))
    starts = chunks.join(span_start, "span").select(
        "chunk", (F.col("span_start") + F.coalesce(F.sum("total").over(rows(Window.partitionBy("span").orderBy("chunk"))), F.lit(0))).alias("chunk_start")
    )
    inner = rows(Window.partitionBy("chunk").orderBy("round", "queue", "queue_at"))
    return packets.join(starts, "chunk").withColumn("at", F.col("chunk_start") + F.coalesce(F.sum("len").over(inner), F.lit(0)))


def cut(packets: list[tuple[int, int, int]], window: int) -> list[tuple[int, int, int, int]]:
    """(start, length, sequence, offset) pieces of a document from its packets (start, length, place in the stream)."""
    out: list[list[int]] = []
    for start, n, at in sorted(packets):
        while n:
            seq, off = divmod(at, window)
            take = min(n, window - off)
            last = out[-1] if out else None
            if last and last[2] == seq and last[0] + last[1] == start and last[3] + last[1] == off:
                last[1] += take
            else:
                out.append([start, take, seq, off])
            start, at, n = start + take, at + take, n - take
    return [tuple(x) for x in out]


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    window: int = WINDOW,
    packet: int = PACKET,
    end_id: int = END_ID,
    weights: dict[str, float] | Column | None = None,
    seed: int = 17,
    with_ids: bool = False,
) -> DataFrame:
    """A row for each piece: PIECES, and with_ids the piece's ids as an array.

    tokenizer_file: a path the driver reads; its text is sent to the executors.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        source = f.read()
    rows = written(tokenized(docs, source, id_col, source_col, text_col, end_id), "tokens")
    placed = queue_places(rows.drop("ids"), seed).join(quanta(rows.select("queue", "n"), window, weights), "queue")
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(packet).cast("long")))
    packets = placed.select("part", "row", "queue", "n", "before", "quantum", first.alias("start"))
    packets = packets.select(
        "part", "row", "queue", "start", F.least(F.lit(packet).cast("long"), F.col("n") - F.col("start")).alias("len"), "quantum", (F.col("before") + F.col("start")).alias("queue_at")
    )
    packets = packets.withColumn("round", (F.ceil((F.col("queue_at") + F.col("len")) / F.col("quantum")) - 1).cast("long")).drop("quantum")
    of_row = stream_places(packets).groupBy("part", "row").agg(F.collect_list(F.struct("start", "len", "at")).alias("packets"))
    joined = rows.select("part", "row", "id", "n", "ids").join(of_row, ["part", "row"]).select("id", "n", "ids", "packets")

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        docs_, n, ids, lists = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)
        flat, ends = lists.flatten(), lists.value_lengths().to_numpy(zero_copy_only=False).cumsum()
        triples = list(zip(*[flat.field(k).to_pylist() for k in ("start", "len", "at")], strict=True))
        out: list[tuple] = []
        at = 0
        for doc, count, raw, end in zip(docs_, n, ids, ends.tolist(), strict=True):
            wide = np.frombuffer(raw, "<u2").astype("<u4") if len(raw) == 2 * count else np.frombuffer(raw, "<u4")
            for start, length, seq, off in cut(triples[at:end], window):
                got = wide[start : start + length]
                out.append((doc, start, length, zlib.crc32(got.tobytes()), count, seq, off, *([got.astype(np.int64)] if with_ids else [])))
            at = end
        names = [x.split()[0] for x in PIECES.split(", ")] + ["ids"] * with_ids
        kinds = [pa.int64()] * 7 + [pa.list_(pa.int64())] * with_ids
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from split_large(batch, one)

    return joined.mapInArrow(run, PIECES + ", ids array<long>" * with_ids)


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids, doc_ids, starts, used) from pieces with ids: each padded to the window, or left at a power of two."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "start", "ids")))
    got = pieces.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("used"))
    ids = F.flatten(F.transform("parts", lambda p: p["ids"]))
    short = F.when(F.expr("used & (used - 1)") == 0, F.lit(0)).otherwise(F.lit(window) - F.col("used"))
    return got.select(
        "sequence_id",
        F.concat(ids, F.array_repeat(F.lit(pad_id).cast("long"), short.cast("int"))).alias("ids"),
        F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"),
        F.transform("parts", lambda p: p["offset"]).alias("starts"),
        "used",
    )
