"""Token ids in binary shards, with a minimal perfect hash index for access by document.

A folder holds, all in a place that every executor reaches:

``shard-NNNNN.bin``
    Raw little-endian unsigned ids, two bytes each where the vocabulary allows it and four otherwise, of a range of
    documents in ascending ``doc_id`` order, each document's followed by the end id.
``index-NNNNN.npz``
    For the keys that hash to the partition: the bit arrays of the levels of a minimal perfect hash function, with
    the number of bits before each word, and at each key's number its stored fingerprint, shard, offset and length.
``manifest``
    A Parquet table of ``shard``, ``n_docs``, ``n_ids`` and ``base``, the ids in the shards before it.

A key is looked up in constant time: its hash names the partition, each level is one bit test, the number of set bits
before its own is the place of its entry, and the fingerprint there turns away keys that were never written.

Defined cases: a null text is the empty text, one end id; null ids sort last and have a key too; rows that share an
id stand together, by text, and are told apart by ``occurrence`` from 0; an empty table gives no files and no rows.
"""

from __future__ import annotations

import io
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import coder, once_a_process, texts, vocabulary_path
from shelfcast.session import materialise, scratch_dir

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
LEVELS = 40
GAMMA = 2  # bits for each key that a level has to place


def _files(uri: str):
    """The file system of a URI or an absolute path, and the path in it."""
    from pyarrow.fs import FileSystem

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return FileSystem.from_uri(uri)


def _publish(store, temporary: str, final: str) -> None:
    """Give a finished file its name; a repeated task writes the same content again."""
    try:
        store.move(temporary, final)
    except OSError:
        store.delete_file(final)
        store.move(temporary, final)


def mixed(values, seed: int):
    """A 64-bit mix of unsigned 64-bit values."""
    import numpy as np

    x = values + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def keys_of(doc_ids, occurrences):
    """64-bit keys of documents; ``doc_ids`` is an Arrow array of whole numbers, null for no id."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    ids = pc.fill_null(doc_ids.cast(pa.int64()), 0).to_numpy(zero_copy_only=False).view(np.uint64)
    null = pc.is_null(doc_ids).to_numpy(zero_copy_only=False).astype(np.uint64)
    return mixed(mixed(ids, 1) + np.asarray(occurrences).astype(np.uint64) + (null << np.uint64(40)), 2)


class PerfectHash:
    """Numbers ``n`` distinct keys from 0 to ``n - 1``; any other key gets a number too, or -1."""

    def __init__(self, bits: list, ranks: list):
        self.bits, self.ranks = bits, ranks

    @classmethod
    def build(cls, keys) -> PerfectHash:
        """Each level sets the bits that one key alone hashes to; keys that collide go on to the next level."""
        import numpy as np

        bits, ranks, placed = [], [], 0
        for level in range(LEVELS):
            if not len(keys):
                break
            size = -(-GAMMA * len(keys) // 64) * 64
            at = mixed(keys, 10 + level) % np.uint64(size)
            hits = np.bincount(at.astype(np.int64), minlength=size)
            alone = hits == 1
            words = np.packbits(alone, bitorder="little").view("<u8")
            counts = np.cumsum(np.bitwise_count(words).astype(np.int64))
            bits.append(words)
            ranks.append(placed + counts - np.bitwise_count(words))
            placed += int(counts[-1])
            keys = keys[~alone[at.astype(np.int64)]]
        if len(keys):
            raise ValueError("keys are not distinct")
        return cls(bits, ranks)

    def numbers(self, keys):
        import numpy as np

        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (words, ranks) in enumerate(zip(self.bits, self.ranks, strict=True)):
            at = mixed(keys[open_], 10 + level) % np.uint64(64 * len(words))
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            found = (words[word] >> bit) & np.uint64(1) == 1
            before = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[open_[found]] = (ranks[word] + np.bitwise_count(before))[found]
            open_ = open_[~found]
        return out


class IndexPart:
    """One partition of the index: where each of its keys' ids stand."""

    def __init__(self, arrays: dict):
        levels = sum(name.startswith("bits") for name in arrays)
        self.hash = PerfectHash(
            [arrays[f"bits{i}"] for i in range(levels)], [arrays[f"ranks{i}"] for i in range(levels)]
        )
        self.prints, self.entries = arrays["prints"], arrays["entries"]

    @staticmethod
    def arrays(keys, entries) -> dict:
        import numpy as np

        found = PerfectHash.build(keys)
        order = np.argsort(found.numbers(keys))
        out = {f"bits{i}": x for i, x in enumerate(found.bits)} | {f"ranks{i}": x for i, x in enumerate(found.ranks)}
        prints = (mixed(keys[order], 3) & np.uint64(0xFFFFFFFF)).astype("<u4")
        return out | {"prints": prints, "entries": entries[order]}

    def lookup(self, keys):
        """Whether each key was written, and its shard, offset and length."""
        import numpy as np

        number = self.hash.numbers(keys)
        known = number >= 0
        prints = (mixed(keys, 3) & np.uint64(0xFFFFFFFF)).astype("<u4")
        known[known] = self.prints[number[known]] == prints[known]
        return known, self.entries[np.where(known, number, 0)] if len(self.entries) else self.entries


@once_a_process(4)
def _open_part(folder: str, part: int) -> IndexPart | None:
    import numpy as np
    from pyarrow.fs import FileType

    store, place = _files(f"{folder}/index-{part:05d}.npz")
    if store.get_file_info(place).type == FileType.NotFound:
        return None
    with store.open_input_file(place) as file, np.load(io.BytesIO(file.read())) as arrays:
        return IndexPart({name: arrays[name] for name in arrays.files})


class TokenFolder:
    """Writes and reads a folder of token ids; ``parts`` are the shards, and the partitions of the index."""

    def __init__(self, spark: SparkSession, folder: str | None = None, parts: int | None = None):
        self.spark = spark
        self.folder = folder or f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
        self.parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(self, docs: DataFrame, path: str | None = None, end_id: int = END_ID) -> None:
        """Tokenises every document and writes shards, index and manifest."""
        from pyspark.sql import Window

        entries = materialise(self._write_shards(docs, path or vocabulary_path(VOCABULARY), end_id))
        self._write_index(entries)
        shards = entries.groupBy("shard").agg(
            F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_ids"), F.first("width").alias("width")
        )
        # As many rows as shards.
        before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        shards = shards.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
        shards.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/manifest")

    def _write_shards(self, docs: DataFrame, path: str, end_id: int) -> DataFrame:
        folder, kind = self.folder, docs.schema["doc_id"].dataType.simpleString()

        def run(batches: Iterator) -> Iterator:
            import numpy as np
            import pyarrow as pa
            from pyspark import TaskContext

            context = TaskContext.get()
            shard, attempt = context.partitionId(), context.taskAttemptId()
            codes = coder(path)
            width = 2 if max(codes.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
            store, place = _files(folder)
            store.create_dir(place, recursive=True)
            written, last, occurrence, out = 0, None, 0, None
            for whole in batches:
                for begin, ids, ends in codes.encode(whole.column(1)):
                    batch = whole.slice(begin, len(ends) - 1)
                    if out is None:
                        out = store.open_output_stream(f"{place}/shard-{shard:05d}.{attempt}.part")
                    ids = np.insert(ids, ends[1:], end_id)
                    out.write(ids.astype(f"<u{width}").tobytes())
                    sizes = np.diff(ends) + 1
                    nth = np.zeros(batch.num_rows, np.int32)
                    for row, doc_id in enumerate(batch.column(0).to_pylist()):
                        occurrence = occurrence + 1 if (doc_id,) == last else 0
                        last, nth[row] = (doc_id,), occurrence
                    columns = [
                        batch.column(0),
                        pa.array(nth),
                        pa.array(np.full(batch.num_rows, shard, np.int32)),
                        pa.array(written + np.cumsum(sizes) - sizes),
                        pa.array(sizes),
                        pa.array(np.full(batch.num_rows, width, np.int32)),
                    ]
                    written += int(sizes.sum())
                    names = ["doc_id", "occurrence", "shard", "offset", "n_tokens", "width"]
                    yield pa.RecordBatch.from_arrays(columns, names)
            if out is not None:
                out.close()
                _publish(store, f"{place}/shard-{shard:05d}.{attempt}.part", f"{place}/shard-{shard:05d}.bin")

        schema = f"doc_id {kind}, occurrence int, shard int, offset bigint, n_tokens bigint, width int"
        order = F.col("doc_id").asc_nulls_last()
        dealt = texts(docs).repartitionByRange(self.parts, order).sortWithinPartitions(order, "text")
        return dealt.mapInArrow(run, schema)

    def _part(self, frame: DataFrame) -> DataFrame:
        part = F.pmod(F.xxhash64(F.col("doc_id").cast("bigint"), F.col("occurrence").cast("int")), F.lit(self.parts))
        return frame.withColumn("part", part.cast("int"))

    def _write_index(self, entries: DataFrame) -> None:
        folder = self.folder

        def run(batches: Iterator) -> Iterator:
            import numpy as np
            import pyarrow as pa
            from pyspark import TaskContext

            rows = [b for b in batches if b.num_rows]
            if not rows:
                return
            held = pa.Table.from_batches(rows)
            keys = keys_of(held["doc_id"].combine_chunks(), held["occurrence"].to_numpy())
            values = np.stack([held[c].to_numpy().astype("<i8") for c in ("shard", "offset", "n_tokens")], axis=1)
            buffer = io.BytesIO()
            np.savez(buffer, **IndexPart.arrays(keys, values))
            part = held["part"][0].as_py()
            store, place = _files(f"{folder}/index-{part:05d}.npz")
            temporary = f"{place}.{TaskContext.get().taskAttemptId()}.part"
            with store.open_output_stream(temporary) as file:
                file.write(buffer.getvalue())
            _publish(store, temporary, place)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(keys)])], ["part", "n"])

        dealt = self._part(entries).repartitionById(self.parts, F.col("part"))
        materialise(dealt.mapInArrow(run, "part int, n bigint"))

    def manifest(self) -> DataFrame:
        schema = "shard int, n_docs bigint, n_ids bigint, width int, base bigint"
        return self.spark.read.schema(schema).parquet(f"{self.folder}/manifest")

    def lookup(self, keys: DataFrame) -> DataFrame:
        """``doc_id``, ``occurrence``, ``shard``, ``offset`` and ``n_tokens`` of the keys that were written."""
        folder, kind = self.folder, keys.schema["doc_id"].dataType.simpleString()

        def run(batches: Iterator) -> Iterator:
            import numpy as np
            import pyarrow as pa

            for batch in batches:
                parts = batch.column(2).to_numpy()
                for part in np.unique(parts).tolist():
                    index = _open_part(folder, part)
                    if index is None:
                        continue
                    rows = batch.filter(pa.array(parts == part))
                    known, entry = index.lookup(keys_of(rows.column(0), rows.column(1).to_numpy()))
                    rows = rows.filter(pa.array(known))
                    entry = entry[known]
                    columns = [rows.column(0), rows.column(1), pa.array(entry[:, 0].astype(np.int32))]
                    columns += [pa.array(entry[:, 1].copy()), pa.array(entry[:, 2].copy())]
                    names = ["doc_id", "occurrence", "shard", "offset", "n_tokens"]
                    yield pa.RecordBatch.from_arrays(columns, names)

        schema = f"doc_id {kind}, occurrence int, shard int, offset bigint, n_tokens bigint"
        dealt = self._part(keys.select("doc_id", F.col("occurrence").cast("int").alias("occurrence")))
        return dealt.repartitionById(self.parts, F.col("part")).mapInArrow(run, schema)

    def read(self, keys: DataFrame, keep_ids: bool = False) -> DataFrame:
        """The keys' ids, from the shards by way of the index.

        ``doc_id``, ``occurrence``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids_crc32``;
        with ``keep_ids`` also ``ids``, as little-endian unsigned 32-bit numbers.
        """
        folder, kind = self.folder, keys.schema["doc_id"].dataType.simpleString()

        def run(batches: Iterator) -> Iterator:
            import numpy as np
            import pyarrow as pa

            shard, file = None, None
            for whole in batches:
                for begin in range(0, whole.num_rows, 500):
                    batch = whole.slice(begin, 500)
                    crcs, payloads = [], []
                    columns = (batch.column(n).to_pylist() for n in ("shard", "offset", "n_tokens", "width"))
                    for at, offset, size, width in zip(*columns, strict=True):
                        if at != shard:
                            store, place = _files(f"{folder}/shard-{at:05d}.bin")
                            shard, file = at, store.open_input_file(place)
                        raw = file.read_at(size * width, offset * width)
                        ids = np.frombuffer(raw, f"<u{width}").astype("<u4").tobytes()
                        crcs.append(zlib.crc32(ids))
                        if keep_ids:
                            payloads.append(ids)
                    keep = ["doc_id", "occurrence", "start", "n_tokens"]
                    columns = [batch.column(n) for n in keep] + [pa.array(crcs, pa.int64())]
                    names = [*keep, "ids_crc32"]
                    if keep_ids:
                        columns.append(pa.array(payloads, pa.binary()))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names)

        schema = f"doc_id {kind}, occurrence int, start bigint, n_tokens bigint, ids_crc32 bigint"
        shards = F.broadcast(self.manifest().select("shard", "base", "width"))  # a row for each shard
        found = self.lookup(keys).join(shards, "shard").withColumn("start", F.col("base") + F.col("offset"))
        dealt = found.repartitionById(self.parts, F.col("shard")).sortWithinPartitions("shard", "offset")
        return dealt.mapInArrow(run, schema + ", ids binary" * keep_ids)


def every_key(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``occurrence`` of every row."""
    counted = docs.groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("n"))
    return counted.select("doc_id", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("occurrence"))


def write_and_read(docs: DataFrame, folder: str | None = None, path: str | None = None) -> DataFrame:
    """Every document's place, length and checksum, read back from the files just written."""
    files = TokenFolder(docs.sparkSession, folder)
    files.write(docs, path)
    return files.read(every_key(docs))
