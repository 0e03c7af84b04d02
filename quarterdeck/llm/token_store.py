"""Token ids in wavelet-matrix shards.

Documents are encoded in ascending id order and packed into shards of about
``shard_tokens`` ids; a shard is one row of a Parquet dataset and holds one
wavelet matrix (token access, counting and occurrence lookup, each from the few
compressed blocks that it passes) with the ids and lengths of its documents.
Spark writes and reads the dataset, so it can lie in any store. Token positions
are global: a shard's first position comes from totals per range partition and
running sums inside it.

A null text is empty and has just the end id; rows with a null id come first;
rows that share an id are ordered by a hash of their texts and may be dealt to
several tasks; repeated rows are each encoded; a document longer than a shard is
a shard of its own; an empty table gives an empty result. Other columns of the
table are not read, whatever their names. Special-token strings get the special
ids, as in the tokenizer's plain call, or with ``special_as_text`` the ids of
ordinary text.
"""

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarterdeck.llm import scratch
from quarterdeck.llm import text as bytes_of
from quarterdeck.llm.wavelet import WaveletMatrix

END_ID = 0
SHARD_TOKENS = 1 << 20
SLICE_BYTES = 6 << 20
CACHED_WORDS = 600_000
SHARD = "part int, shard int, doc_ids array<long>, lengths array<int>, n_tokens long, matrix binary"

_encoders: dict[tuple[str, bool], "Encoder"] = {}


def _strings(texts: pa.Array) -> list[str]:
    """A column without nulls as a list, by way of numpy, which makes no scalar of each value."""
    return texts.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    """Ids of whole texts, with a memory of words: each distinct piece of a slice of texts is looked up once, and new ones are encoded.

    The tokenizer splits before a space that a non-space follows, so texts are
    cut there. A piece of letters, full stops, commas and single line breaks is
    cut further as the tokenizer would, and its words go to the tokenizer's
    model and into a memory; other pieces, texts with runs of spaces or a space
    at the end, and texts with special tokens go through the whole tokenizer.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.special = [] if special_as_text else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.n_ids = self.tokenizer.get_vocab_size()
        self.words: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        # The character that stands for each byte.
        plain = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.shown = {b: plain.pre_tokenize_str(chr(b))[0][0][-1] for b in range(128)}
        for code in (*range(0x80, 0x800), *range(0x800, 0x10000, 0x40), *range(0x10000, 0x110000, 0x1000)):
            if not 0xD800 <= code < 0xE000 and len(self.shown) < 256:
                for byte, c in zip(chr(code).encode(), plain.pre_tokenize_str(chr(code))[0][0]):
                    self.shown.setdefault(byte, c)
        self.space = self.shown[ord(" ")]

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [array("I", x.ids).tobytes() for x in found]

    def _word(self, word: str) -> bytes:
        """Ids of letters, with a space before them or not."""
        shown = word.replace(" ", self.space) if word.isascii() else word.encode().decode("latin-1").translate(self.shown)
        found = self.words[word] = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        return found

    def _mark(self, mark: str) -> bytes:
        if mark not in self.marks:
            self.marks[mark] = self._encode([mark])[0]
        return self.marks[mark]

    def _lines(self, piece: str) -> bytes | None:
        """Ids of a piece, with its space or not, or none if it isn't of the simple kind."""
        out, known = [], self.words.get
        for k, line in enumerate(piece.split("\n")):
            word = line.rstrip(".,")
            ids = known(word)
            if ids is None:
                if not (word if k else word.removeprefix(" ")).isalpha():
                    return None
                ids = self._word(word)
            if k:
                out.append(self._mark("\n"))
            out.append(ids)
            if len(word) < len(line):
                out.append(self._mark(line[len(word) :]))
        return b"".join(out)

    def _coded(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces."""
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        known, out, other = self.words.get, [], []
        for piece in pieces:
            ids = known(piece)
            if ids is None:
                # Most pieces that are no known words are new ones, or words with marks after them.
                word = piece.rstrip(".,")
                ids = known(word)
                if ids is None and word.removeprefix(" ").isalpha():
                    ids = self._word(word)
                if ids is not None:
                    if len(word) < len(piece):
                        ids += self._mark(piece[len(word) :])
                elif (ids := self._lines(piece)) is None:
                    other.append(len(out))
            out.append(ids)
        for k, ids in zip(other, self._encode([pieces[k] for k in other])):
            out[k] = ids
        return out

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and each text's bounds in them."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.or_(pc.match_substring(texts, "  "), pc.ends_with(texts, " "))
        for token in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        split = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        flat, bounds = split.flatten(), np.asarray(split.offsets)[: len(texts) + 1]
        # First pieces have no space before them; odd texts are one piece, which goes through the tokenizer.
        heads = self._coded(_strings(flat.take(pa.array(bounds[:-1]))))
        whole = np.flatnonzero(odd)
        for k, ids in zip(whole.tolist(), self._encode(texts.take(pa.array(whole)).to_pylist())):
            heads[k] = ids
        coded = flat.dictionary_encode()
        which = np.array(coded.indices, np.int32)
        which[bounds[:-1]] = np.arange(len(texts)) + len(coded.dictionary)
        ids = self._coded([" " + x for x in _strings(coded.dictionary)]) + heads
        ids = pa.array(ids, pa.large_binary()).take(pa.array(which))
        _, ends, data = ids.buffers()
        return np.frombuffer(data or b"", "<u4"), np.frombuffer(ends, np.int64, len(flat) + 1)[bounds] // 4


def encoder(path: str, special_as_text: bool = False) -> Encoder:
    """The worker's encoder of a tokenizer file."""
    if (path, special_as_text) not in _encoders:
        _encoders[path, special_as_text] = Encoder(path, special_as_text)
    return _encoders[path, special_as_text]


def write_shards(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS, special_as_text: bool = False) -> None:
    """Encode ``docs`` in ascending id order and write the shards to ``path``."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part, shard = encoder(tokenizer, special_as_text), TaskContext.get().partitionId(), 0
        n_bits = max(1, (max(encode.n_ids - 1, end_id)).bit_length())
        kind = np.uint32 if n_bits > 16 else np.uint16
        ids, lengths, held = [], [], []

        def full() -> pa.RecordBatch:
            tokens = np.concatenate(held)
            blob = WaveletMatrix.of(tokens, n_bits).to_bytes()
            columns = [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int32())), pa.array([len(tokens)], pa.int64()), pa.array([blob], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["part", "shard", "doc_ids", "lengths", "n_tokens", "matrix"])

        n = 0
        for batch in batches:
            for a, b in bytes_of.slices(batch.column(1), SLICE_BYTES):
                tokens, bounds = encode(batch.column(1)[a:b])
                tokens = np.insert(tokens.astype(kind), bounds[1:], end_id)
                bounds = bounds + np.arange(len(bounds))
                begin = 0
                for k, key in enumerate(batch.column(0)[a:b].to_pylist()):
                    size = int(bounds[k + 1] - bounds[k])
                    if n and n + size > shard_tokens:
                        held.append(tokens[begin : bounds[k]])
                        yield full()
                        shard, n, begin = shard + 1, 0, bounds[k]
                        ids, lengths, held = [], [], []
                    ids.append(key)
                    lengths.append(size)
                    n += size
                held.append(tokens[begin:])
        if n:
            yield full()

    ordered = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # The hash parts and orders rows that share an id.
    order = F.col("id").asc_nulls_first(), F.xxhash64("text")
    ordered = ordered.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ordered.select("id", "text").mapInArrow(packed, SHARD).write.option("compression", "none").mode("overwrite").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``first``, the global position of each one's first token."""
    shards = spark.read.schema(SHARD).parquet(path)
    sizes = shards.select("part", "shard", "n_tokens")
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition, however large the data.
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select(F.col("part").alias("p"), F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    sizes = sizes.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(parts, F.expr("part = p"))
    sizes = sizes.select(F.col("part").alias("p"), F.col("shard").alias("s"), (F.col("base") + F.col("inner")).alias("first"))
    # Few rows against many bytes: the matrices stay where they are if Spark finds the sizes small enough to send.
    return shards.join(sizes, F.expr("part = p AND shard = s")).drop("p", "s")


def documents(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the matrices."""

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.select(["doc_ids", "lengths", "first", "matrix"]).to_pylist():
                ids = WaveletMatrix.from_bytes(row["matrix"]).decode().astype("<u4")
                ends = np.cumsum(np.array(row["lengths"], np.int64))
                begins = ends - np.array(row["lengths"], np.int64)
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(begins + row["first"]), pa.array(ends - begins), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.mapInArrow(unpacked, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_counts(shards: DataFrame, token_ids: list[int]) -> DataFrame:
    """(token_id, n): occurrences of some ids in all shards, by rank alone."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("matrix").to_pylist():
                matrix = WaveletMatrix.from_bytes(blob)
                yield pa.RecordBatch.from_arrays([pa.array(token_ids, pa.int64()), pa.array([matrix.count(t) for t in token_ids], pa.int64())], ["token_id", "n"])

    return shards.select("matrix").mapInArrow(counted, "token_id long, n long").groupBy("token_id").agg(F.sum("n").alias("n"))


def token_positions(shards: DataFrame, token_id: int) -> DataFrame:
    """(position): every global position of an id, by select."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.select(["first", "matrix"]).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(WaveletMatrix.from_bytes(row["matrix"]).occurrences(token_id) + row["first"])], ["position"])

    return shards.select("first", "matrix").mapInArrow(found, "position long")


def tokens_at(shards: DataFrame, begin: int, end: int) -> DataFrame:
    """(position, token_id) of the global positions from ``begin`` to before ``end``, by access; other shards are not read."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                matrix = WaveletMatrix.from_bytes(row["matrix"])
                at = np.arange(max(begin - row["first"], 0), min(end - row["first"], matrix.n))
                yield pa.RecordBatch.from_arrays([pa.array(at + row["first"]), pa.array(matrix.access(at))], ["position", "token_id"])

    some = shards.filter((F.col("first") < end) & (F.col("first") + F.col("n_tokens") > begin))
    return some.select("first", "matrix").mapInArrow(found, "position long, token_id long")


def encode_and_read(docs: DataFrame, tokenizer: str, path: str | None = None, **options) -> DataFrame:
    """Write the shards (in the shared folder unless ``path`` is given) and read the documents back."""
    path = path or scratch.folder(docs.sparkSession)
    write_shards(docs, path, tokenizer, **options)
    return documents(read_shards(docs.sparkSession, path))
