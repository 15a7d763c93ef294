"""Token ids in files, coded by a static range asymmetric numeral system (rANS).

All blocks share one table of token frequencies, scaled to a power of two. A block is
coded on its own by interleaved lanes: token i belongs to lane i mod LANES. Each lane's
64-bit state gives off 32-bit words; a decoder reads them in the lanes' turn. A block's
entry in its segment holds the lanes' last states (the point decoding starts from), its
counts and a checksum, so blocks decode in parallel. Numpy steps all lanes of all blocks
of a segment at once.

Files of a store: ``segments`` (whole documents in order, with ids and lengths),
``frequencies`` and ``parts`` (tokens of each part, hence where it starts).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import new_path
from .tokens import encoder

SCALE_BITS, LANES, BLOCK, SEGMENT = 20, 32, 1 << 14, 1 << 20
_MAGIC, _HEAD, _ENTRY = b"RANS", struct.Struct("<4sIIII"), struct.Struct("<III")
_LOW = np.uint64(1 << 31)
_32 = np.uint64(32)
_symbols: dict[bytes, np.ndarray] = {}


def _symbol_table(freq: np.ndarray) -> np.ndarray:
    """The token of each slot of the scale; a worker keeps the last table."""
    name = freq.tobytes()
    if name not in _symbols:
        _symbols.clear()
        _symbols[name] = np.repeat(np.arange(len(freq), dtype=np.uint16 if len(freq) <= 1 << 16 else np.uint32), freq.astype(np.int64))
    return _symbols[name]


def scaled(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Frequencies that sum to 2 ** bits, at least one for each token that occurs."""
    counts = np.asarray(counts, np.float64)
    total, size = counts.sum(), 1 << bits
    if not total:
        return np.zeros(len(counts), np.uint64)
    if np.count_nonzero(counts) > size:
        raise ValueError("more tokens than the scale can tell apart")
    out = np.where(counts > 0, np.maximum(1, np.floor(counts / total * size)), 0).astype(np.int64)
    while (over := int(out.sum()) - size) != 0:
        order = np.argsort(-out, kind="stable")
        if over < 0:
            out[order[0]] -= over
        else:
            room = np.maximum(out[order] // 2, 0) * (out[order] > 1)
            take = np.minimum(room, np.maximum(0, over - (np.cumsum(room) - room)))
            out[order] -= take
    return out.astype(np.uint64)


def encode_segment(ids: np.ndarray, freq: np.ndarray) -> bytes:
    """A segment: head, an entry and lane states for each block, then the blocks' words."""
    start = np.cumsum(freq) - freq
    blocks = -(-len(ids) // BLOCK)
    steps = BLOCK // LANES
    padded = np.zeros(blocks * BLOCK, np.int64)
    padded[: len(ids)] = ids
    grid = padded.reshape(blocks, steps, LANES)
    real = (np.arange(blocks * BLOCK) < len(ids)).reshape(blocks, steps, LANES)
    state = np.full((blocks, LANES), _LOW, np.uint64)
    words, given = np.zeros((blocks, steps, LANES), np.uint32), np.zeros((blocks, steps, LANES), bool)
    bits, top = np.uint64(SCALE_BITS), np.uint64(63 - SCALE_BITS)
    least = np.maximum(freq, np.uint64(1))  # padding may be a token that never occurs
    for t in range(steps - 1, -1, -1):
        on = real[:, t]
        if not on.any():
            continue
        f, c = least[grid[:, t]], start[grid[:, t]]
        out = on & (state >= (f << top))
        words[:, t], given[:, t] = state.astype(np.uint32), out
        state = np.where(out, state >> _32, state)
        whole = state // f
        after = (whole << bits) + (state - whole * f) + c
        state = after if on.all() else np.where(on, after, state)
    parts, entries = [], []
    for b in range(blocks):
        own = words[b][given[b]].tobytes()
        entries.append(_ENTRY.pack(min(BLOCK, len(ids) - b * BLOCK), len(own) // 4, zlib.crc32(state[b].tobytes() + own)))
        parts.append(own)
    return _HEAD.pack(_MAGIC, 1, blocks, len(ids), LANES) + b"".join(entries) + state.tobytes() + b"".join(parts)


def decode_segment(data: bytes, freq: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of a segment's blocks ``first`` to before ``last``; each block is checked."""
    magic, version, blocks, _, lanes = _HEAD.unpack_from(data)
    if magic != _MAGIC or version != 1 or lanes != LANES:
        raise ValueError("not a segment of this format")
    last = blocks if last is None else last
    entries = np.frombuffer(data, "<u4", 3 * blocks, _HEAD.size).reshape(blocks, 3).astype(np.int64)
    at = _HEAD.size + 12 * blocks
    state = np.frombuffer(data, "<u8", blocks * LANES, at).reshape(blocks, LANES)[first:last].copy()
    at += 8 * blocks * LANES
    words = np.frombuffer(data, "<u4", -1, at)
    pointer = (np.cumsum(entries[:, 1]) - entries[:, 1])[first:last]
    sizes, crcs = entries[first:last, 0], entries[first:last, 2]
    for b in range(last - first):
        own = words[pointer[b] : pointer[b] + entries[first + b, 1]]
        if zlib.crc32(state[b].tobytes() + own.tobytes()) != crcs[b]:
            raise ValueError(f"block {first + b} is damaged")
    start = np.cumsum(freq) - freq
    symbol = _symbol_table(freq)
    bits, mask = np.uint64(SCALE_BITS), np.uint64((1 << SCALE_BITS) - 1)
    words = words.astype(np.uint64)
    steps = BLOCK // LANES
    out = np.zeros((last - first, steps, LANES), np.uint32)
    lane = np.arange(LANES)
    whole = int(sizes.min(initial=BLOCK)) // LANES  # steps in which every lane has a token
    for t in range(steps):
        slot = state & mask
        ids = symbol[slot.view(np.int64)]
        after = freq[ids] * (state >> bits) + slot - start[ids]
        low = after < _LOW
        if t >= whole:
            on = t * LANES + lane < sizes[:, None]
            if not on.any():
                break
            after, low = np.where(on, after, state), low & on
        out[:, t], state = ids, after
        # Few lanes run low at a step; they take the next words in their turn.
        block, own = np.nonzero(low)
        taken = np.bincount(block, minlength=len(pointer))
        place = np.arange(len(block)) - np.repeat(np.cumsum(taken) - taken, taken)
        state[block, own] = (state[block, own] << _32) | words[pointer[block] + place]
        pointer = pointer + taken
    flat = out.reshape(last - first, BLOCK)
    return np.concatenate([flat[b, : sizes[b]] for b in range(last - first)]) if last > first else np.zeros(0, np.uint32)


def _token_rows(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Documents in id order: doc_id, part, start (in the part), n, ids. Each task ends with
    a row that holds nothing but how often it gave each id (counts; null in other rows)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = ["doc_id", "part", "start", "n", "width", "ids", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        given = np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, counts = encoder(vocabulary).encode(batch.column("text"))
            ends = np.cumsum(counts)
            own = np.insert(ids, ends, end_id).astype("<u2" if max(end_id, int(ids.max(initial=0))) < 1 << 16 else "<u4")
            counts = counts + 1
            offsets = np.concatenate([[0], np.cumsum(counts)])
            width = own.dtype.itemsize
            data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets * width), pa.py_buffer(own)])
            starts = before + offsets[:-1]
            before += int(offsets[-1])
            given = _summed(given, np.bincount(own))
            columns = [batch.column("doc_id"), batch.column("part"), pa.array(starts), pa.array(counts), pa.array(np.full(len(counts), width, np.int32)), data.cast(pa.binary()), pa.nulls(len(counts), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=fields)
        if len(given):
            types = [batch.column("doc_id").type, batch.column("part").type, pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
            last = [None, None, None, None, None, None, given.astype("<i8").tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(last, types)], names=fields)

    dealt = docs.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").withColumn("part", F.spark_partition_id())
    return dealt.select("doc_id", "part", "text").mapInArrow(run, f"doc_id {kind}, part int, start bigint, n bigint, width int, ids binary, counts binary")


def _summed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sum of two arrays of counts; the shorter one lacks zeros."""
    a, b = (a, b) if len(a) >= len(b) else (b, a)
    out = a.copy()
    out[: len(b)] += b
    return out


def write_store(docs: DataFrame, path: str, vocabulary: str = "word_bpe_49k.json", end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes all documents' ids, each ended by ``end_id``, in ascending id order (null ids
    first, equal ids in any order). Null text is empty: the end id alone. Other columns
    are ignored; an empty table gives a store without segments.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    # Equal ids may be a third of all rows: their rows are told apart for dealing.
    texts = texts.withColumn("tie", F.monotonically_increasing_id())
    raw = new_path(spark, "token-rows")
    _token_rows(texts, vocabulary, end_id).write.option("compression", "zstd").parquet(raw)
    written = spark.read.parquet(raw)
    rows = written.filter("counts IS NULL").drop("counts")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        given = np.zeros(0, np.int64)
        for batch in batches:
            for own in batch["counts"]:
                given = _summed(given, np.frombuffer(own, "<i8"))
        used = np.flatnonzero(given)
        yield pd.DataFrame({"id": used, "n": given[used]})

    tasks = written.filter("counts IS NOT NULL").select("counts")
    seen = tasks.mapInPandas(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).orderBy("id")
    counts = seen.toPandas()  # one row per id of the vocabulary at most
    freq = np.zeros(int(counts["id"].max()) + 1 if len(counts) else 1, np.int64)
    freq[counts["id"].to_numpy(np.int64)] = counts["n"]
    freq = scaled(freq)
    spark.createDataFrame([(freq.astype("<u8").tobytes(), SCALE_BITS)], "frequencies binary, bits int").write.parquet(f"{path}/frequencies")
    rows.groupBy("part").agg(F.sum("n").alias("tokens")).write.parquet(f"{path}/parts")
    shared = spark.sparkContext.broadcast(freq)

    def segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = shared.value
        held: list = []

        def flush() -> pd.DataFrame:
            ids = np.concatenate([np.frombuffer(x.ids, f"<u{x.width}") for x in held])
            names = [[None if pd.isna(x.doc_id) else x.doc_id for x in held]]
            row = {"part": held[0].part, "start": held[0].start, "doc_ids": names, "lengths": [[x.n for x in held]], "payload": encode_segment(ids, table)}
            held.clear()
            return pd.DataFrame(row)

        size = 0
        for batch in batches:
            for x in batch.itertuples(index=False):
                # Rows of a file follow one another; at another part a segment ends.
                if held and (size + x.n > SEGMENT or held[-1].part != x.part or held[-1].start + held[-1].n != x.start):
                    yield flush()
                    size = 0
                held.append(x)
                size += x.n
        if held:
            yield flush()

    kind = rows.schema["doc_id"].dataType.simpleString()
    coded = rows.mapInPandas(segments, f"part int, start bigint, doc_ids array<{kind}>, lengths array<bigint>, payload binary")
    coded.write.option("compression", "uncompressed").parquet(f"{path}/segments")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of a store: doc_id, start, n_tokens, ids_crc32 (of its ids as
    little-endian 32-bit numbers), from the decoded blocks."""
    row = spark.read.parquet(f"{path}/frequencies").first()
    shared = spark.sparkContext.broadcast(np.frombuffer(row.frequencies, "<u8").astype(np.uint64))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for x in batch.itertuples(index=False):
                ids = decode_segment(x.payload, shared.value).astype("<u4")
                lengths = np.asarray(x.lengths, np.int64)
                ends = np.cumsum(lengths)
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(ends - lengths, ends)]
                names = [None if v is None or v != v else v for v in x.doc_ids]
                yield pd.DataFrame({"doc_id": pd.Series(names, dtype=object), "part": x.part, "start": x.start + ends - lengths, "n_tokens": lengths, "ids_crc32": crcs})

    segments = spark.read.parquet(f"{path}/segments")
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()
    rows = segments.mapInPandas(run, f"doc_id {kind}, part int, start bigint, n_tokens bigint, ids_crc32 bigint")
    before, starts = 0, []
    for part in sorted(spark.read.parquet(f"{path}/parts").collect(), key=lambda p: p.part):  # a row a part
        starts.append((part.part, before))
        before += part.tokens
    starts = spark.createDataFrame(starts, "part int, before bigint")
    rows = rows.join(F.broadcast(starts), "part")
    return rows.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def stored(docs: DataFrame) -> DataFrame:
    """Writes a store in the shared folder and reads it back."""
    path = new_path(docs.sparkSession, "token-store")
    write_store(docs, path)
    return read_store(docs.sparkSession, path)
