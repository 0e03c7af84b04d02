"""Stupid-backoff scores of documents from n-gram counts of a corpus.

A word's factor is c(n-gram) / c(n-gram without its last word) for the longest
n-gram of at most ``orders`` words, ending in it, that the corpus holds; each
order given up costs a factor of ``ALPHA``. A word that the corpus lacks counts
as one seen once, and the count of no words at all is the corpus' size. A
document's log score is the sum of its words' logs.

Without a ``corpus``, each row is scored by all other rows: its own n-grams are
taken off every count, so that texts unlike the others back off. With
``held_out=False`` they stay in.

Count tables are partitioned by hash: rows are packed into compressed chunks of
bounded size; a chunk sends the 64-bit hashes of its n-grams, each once and with
its count, to the buckets (ranges of hashes) that they are in. A bucket adds up
the counts and joins them with the chunks that asked, which look their n-grams
up and add up the logs for each document. A frequent n-gram is one entry of a
chunk, so it loads no bucket; the n-gram of no words is counted like all others.
What is sent is in proportion to the text at any size.

Null and empty texts have no words and score 0; a text longer than a chunk is a
chunk of its own. Repeated rows count as often as they occur and each get a row;
rows that share an id each get a row. An empty table gives an empty result, an
empty corpus counts as one word. Other columns are not read, whatever their
names. Reading ``docs`` twice must give the same rows in the same partitions, as
tables do.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm import text as bytes_of

ALPHA = 0.4
ORDERS = 3
CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20
#: Hash of the n-gram of no words.
NOTHING = np.uint64(0x243F6A8885A308D3)


def _grams(texts: pa.Array, orders: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each order the hash of the n-gram that ends at each word (of no meaning if it is too short), each word's row, and its place in the row."""
    hashes, row, place, before = [], [], [], 0
    for a, b in bytes_of.slices(texts):
        data, bounds = bytes_of.raw(texts[a:b])
        begins, ends, firsts = bytes_of.words(data, bounds)
        hashes.append(bytes_of.hashes(data, begins, ends))
        r = np.repeat(np.arange(b - a), np.diff(firsts))
        place.append((np.arange(len(begins)) - firsts[:-1][r]).astype(np.int32))
        row.append((r + a).astype(np.int32))
    none = np.zeros(0, np.int32)
    grams = [np.concatenate([none.astype(np.uint64), *hashes])]
    for _ in range(1, orders):
        longer = grams[0].copy()
        longer[1:] = bytes_of.mix(grams[-1][:-1] * np.uint64(bytes_of.BASE) + grams[0][1:])
        grams.append(longer)
    return grams, np.concatenate([none, *row]), np.concatenate([none, *place])


def _distinct(grams: list[np.ndarray], place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of n-grams of all orders, that of no words included, and how often each occurs."""
    keys = np.sort(np.concatenate([g[place >= m] for m, g in enumerate(grams)]))
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(keys)))
    at = np.searchsorted(keys[first], NOTHING)
    return np.insert(keys[first], at, NOTHING), np.insert(counts, at, len(place))


def _places(keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Where each hash is among sorted distinct ones, which hold all of them: hashes are even, so their first bits nearly tell."""
    shift = np.uint64(64 - max(1, len(keys).bit_length()))
    starts = np.zeros((1 << int(64 - shift)) + 1, np.int32)
    np.cumsum(np.bincount((keys >> shift).astype(np.int64), minlength=len(starts) - 1), out=starts[1:])
    at = starts[(asked >> shift).astype(np.int64)]
    todo = np.flatnonzero(keys[at] != asked)
    while len(todo):
        at[todo] += 1
        todo = todo[keys[at[todo]] != asked[todo]]
    return at


def _squeezed(x: np.ndarray) -> bytes:
    """Whole numbers compressed as planes of bytes, of the least width that holds them."""
    width = next(w for w in (1, 2, 4, 8) if w == 8 or not len(x) or int(x.max()) < 1 << 8 * w)
    planes = x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _restored(packed: bytes, n: int) -> np.ndarray:
    width = packed[0]
    planes = np.frombuffer(pa.decompress(memoryview(packed)[1:], n * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(f"<u{width}").ravel()


def _chunks(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int) -> DataFrame:
    """(chunk, data): rows packed into compressed Arrow streams."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 33
        for batch in batches:
            for a, b in bytes_of.slices(batch.column("text"), chunk_bytes):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as writer:
                    writer.write_batch(batch.slice(a, b - a))
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["chunk", "data"])
                chunk += 1

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(packed, "chunk long, data binary")


def _unpacked(table: pa.Table) -> pa.Table:
    return pa.ipc.open_stream(table["data"][0].as_buffer()).read_all().combine_chunks()


def score(docs: DataFrame, corpus: DataFrame | None = None, orders: int = ORDERS, held_out: bool = True, id_col: str = "doc_id", text_col: str = "text", alpha: float = ALPHA, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(id, n_words, log_score) of every row of ``docs``, by n-grams of up to ``orders`` words in ``corpus``, or in the other rows."""
    own = corpus is None
    counting = docs if own else corpus
    size = counting.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    n_buckets = int(size // bucket_bytes) + 1
    chunks = _chunks(docs, id_col, text_col, chunk_bytes)

    def sent(asks: bool, counts: bool):
        def of(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            grams, _, place = _grams(_unpacked(table)["text"].combine_chunks(), orders)
            keys, n = _distinct(grams, place)
            # Buckets are ranges of hashes, so a chunk's buckets follow each other.
            where = ((keys >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)
            cut = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
            ranges = list(zip(cut.tolist(), [*cut[1:].tolist(), len(where)]))
            return pa.table({
                "bucket": pa.array(where[cut], pa.int64()), "chunk": pa.array([key[0].as_py()] * len(cut), pa.int64()), "asks": pa.array([asks] * len(cut)),
                "n": pa.array([b - a for a, b in ranges], pa.int64()),
                "hashes": pa.array([_squeezed(np.diff(keys[a:b], prepend=np.uint64(0))) for a, b in ranges], pa.binary()),
                "counts": pa.array([_squeezed(n[a:b] * counts) for a, b in ranges], pa.binary()),
            })

        return of

    def summed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        sizes = table["n"].to_pylist()
        hashes = np.concatenate([np.cumsum(_restored(x.as_py(), n), dtype=np.uint64) for x, n in zip(table["hashes"], sizes)])
        counts = np.concatenate([_restored(x.as_py(), n).astype(np.int64) for x, n in zip(table["counts"], sizes)])
        keys = np.sort(hashes)
        keys = keys[np.append(True, keys[1:] != keys[:-1])]
        at = _places(keys, hashes)
        # What other chunks count: mostly nothing, so it takes little room.
        others = np.bincount(at, counts).astype(np.int64)[at] - counts
        asks = table["asks"].to_pylist()
        parts = [_squeezed(x) for x, ask in zip(np.split(others, np.cumsum(sizes)[:-1]), asks) if ask]
        asking = table.filter(table["asks"])
        return pa.table({"bucket": asking["bucket"], "chunk": asking["chunk"], "n": asking["n"], "others": pa.array(parts, pa.binary())})

    def scored(chunk: pa.Table, others: pa.Table) -> pa.Table:
        rows = _unpacked(chunk)
        grams, row, place = _grams(rows["text"].combine_chunks(), orders)
        keys, counts = _distinct(grams, place)
        others = others.sort_by("bucket")
        total = np.concatenate([_restored(x.as_py(), n).astype(np.int64) for x, n in zip(others["others"], others["n"].to_pylist())])
        if len(total) != len(keys):
            raise ValueError("a chunk changed between two readings of the rows")
        if own:
            total += counts
        n_words = np.bincount(row, minlength=len(rows))
        size = int(total[np.searchsorted(keys, NOTHING)])
        sizes = size - n_words if own and held_out else np.full(len(rows), size)
        out, used, shorter = -np.log(np.maximum(sizes, 1))[row], np.zeros(len(row), np.int8), None
        for m in range(orders):
            long = np.flatnonzero(place >= m)
            at = _places(keys, grams[m][long])
            found = total[at]
            if own and held_out:
                # An n-gram that occurs once in all is the document's own.
                some = np.flatnonzero(found > 1)
                _, inverse, mine = np.unique(row[long[some]].astype(np.int64) * len(keys) + at[some], return_inverse=True, return_counts=True)
                found[some] -= mine[inverse]
                found[total[at] == 1] = 0
            here = np.zeros(len(row), np.int64)
            here[long] = found
            if m == 0:
                out += np.log(np.maximum(here, 1))
            else:
                hit = np.flatnonzero(here)
                out[hit], used[hit] = np.log(here[hit]) - np.log(shorter[hit - 1]), m
            shorter = here
        out += np.log(alpha) * (np.minimum(place, orders - 1) - used)
        return pa.table({"id": rows["id"], "n_words": pa.array(n_words, pa.int64()), "log_score": pa.array(np.bincount(row, out, len(rows)), pa.float64())})

    columns = "bucket long, chunk long, asks boolean, n long, hashes binary, counts binary"
    # Both groupings of the chunks read one shuffle.
    asked = chunks.groupBy("chunk").applyInArrow(sent(True, own), columns)
    if not own:
        asked = asked.unionByName(_chunks(corpus, id_col, text_col, chunk_bytes).groupBy("chunk").applyInArrow(sent(False, True), columns))
    others = asked.groupBy("bucket").applyInArrow(summed, "bucket long, chunk long, n long, others binary")
    out = chunks.groupBy("chunk").cogroup(others.groupBy("chunk")).applyInArrow(scored, "id long, n_words long, log_score double")
    return out.select(F.col("id").alias(id_col), "n_words", "log_score")
