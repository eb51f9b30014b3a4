"""What the corpus operators share: tables, the scratch folder, byte-level words."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.session import reach

#: Bytes that end a word of the contracts "everything but white space" (0x20, 0x09-0x0D); bytes.split() uses the same.
#: A-Z are lower-cased by bytes.lower(), which leaves all other bytes as they are.


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return reach(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder of the session.  Only a local session, as in tests, may do without one and gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tallyforge-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/tallyforge/{uuid.uuid4().hex}"


def settled(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """df written once to the shared folder and read again: later uses don't compute it anew, and lost executors don't take it along."""
    spark = df.sparkSession
    path = scratch(spark)
    df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._settled_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes settled tables that nothing reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._settled_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def partitions(df: DataFrame, size: int = 32 << 20) -> int:
    """Shuffle partitions for work on df's texts: the session's number, or more if a share of df's files were larger than size."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    known = [int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size())]
    stored = sum(x for x in known if x < 1 << 60)  # a table of unknown size says the greatest number
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(stored // size, 1 << 20))


def by_home(df: DataFrame, home, parts: int) -> DataFrame:
    """Rows dealt evenly: home is a number, its remainder the partition."""
    return df.repartitionById(parts, F.pmod(home, F.lit(parts)).cast("int"))


def raw(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The UTF-8 bytes of a string column; null is empty."""
    col = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in col.cast(pa.binary() if not pa.types.is_large_string(col.type) else pa.large_binary()).to_pylist()]


def given_back() -> None:
    """Memory that nothing uses goes back to the system: workers stay for the next stages, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


#: Bytes of a batch of texts on its way to Python.
BATCH_BYTES = 8 << 20
_BATCH, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def bounded(df: DataFrame) -> DataFrame:
    """df, whose batches reach Python in BATCH_BYTES (or one row): they are held by the executor, outside its heap, and by its workers.  A session's own limit stays."""
    if df.sparkSession.conf.get(_BATCH) == _BATCH_DEFAULT:
        df.sparkSession.conf.set(_BATCH, f"{BATCH_BYTES}b")
    return df


def sliced(batches, rows: int = 2000):
    """Batches in slices, so that what a task makes of one at a time is bounded; memory that nothing uses goes back after each."""
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)
            given_back()


def words(text: bytes) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased."""
    return text.lower().split()


def parcel(batch: pa.RecordBatch, level: int = 1) -> bytes:
    """Many small rows as one compressed value: they cost no row each in a shuffle."""
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=level))) as w:
        w.write_batch(batch)
    return out.getvalue().to_pybytes()


def portions(sizes: list[int], limit: int) -> list[tuple[int, int]]:
    """First and end of consecutive items whose sizes sum to the limit at most (a larger one goes by itself)."""
    out, lo, total = [], 0, 0
    for k, n in enumerate(sizes):
        if k > lo and total + n > limit:
            out.append((lo, k))
            lo, total = k, 0
        total += n
    return [*out, (lo, len(sizes))] if sizes else []


def stretches(sorted_keys: np.ndarray) -> list[tuple[int, int]]:
    """First and end of each run of equal keys (0 and above)."""
    first = np.flatnonzero(np.diff(sorted_keys, prepend=-1)).tolist()
    return list(zip(first, [*first[1:], len(sorted_keys)], strict=True)) if first else []


def bundle(parts: list[bytes]) -> bytes:
    """A parcel of one row for each part, without a schema's bytes; parts are compressed apart, as their bytes differ in kind."""
    codec, out = pa.Codec("zstd", compression_level=1), []
    for x in parts:
        small = codec.compress(x, asbytes=True) if len(x) > 64 else x
        out.append(small if len(small) < len(x) else x)
    sizes = np.array([[len(x) for x in parts], [len(x) for x in out]], "<u4").tobytes()
    return b"".join([len(parts).to_bytes(4, "little"), sizes, *out])


def unparcel(value: bytes) -> pa.RecordBatch:
    head = bytes(memoryview(value)[:4])
    if head != b"\xff" * 4:  # a bundle; a stream begins so
        n, codec, parts = int.from_bytes(head, "little"), pa.Codec("zstd"), []
        sizes, at = np.frombuffer(value, "<u4", 2 * n, 4).reshape(2, n).tolist(), 4 + 8 * n
        for whole, small in zip(*sizes, strict=True):
            x = memoryview(value)[at : at + small]
            parts.append(codec.decompress(x, whole, asbytes=True) if small < whole else x.tobytes())
            at += small
        return pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], ["packed"])
    with pa.ipc.open_stream(value) as r:
        return r.read_next_batch()


#: A batch's questions to a table dealt by hash, and what stays of the batch until they are answered.
ASKED = "home long, kind int, batch long, bucket int, rows binary"
TABLE, QUESTION, REST = 0, 1, 2


def asked(home: list[int], kind: int, batch: int, values: list[bytes], shift: int = 0) -> pa.RecordBatch:
    """Rows for these homes; shift sets the answers of a batch's later questions behind those of its earlier ones."""
    n = len(home)
    return pa.RecordBatch.from_arrays([pa.array(home, pa.int64()), pa.array([kind] * n, pa.int32()), pa.array([batch] * n, pa.int64()), pa.array([h + shift for h in home], pa.int32()), pa.array(values, pa.binary())], ["home", "kind", "batch", "bucket", "rows"])


def each(batches):
    """Rows of asked questions as tuples."""
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def gathered(rows):
    """Tuples in batches, as each() had them."""
    names, kinds = ["home", "kind", "batch", "bucket", "rows"], [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
    cols: list[list] = [[], [], [], [], []]
    for row in rows:
        for c, x in zip(cols, row, strict=True):
            c.append(x)
        if len(cols[0]) >= 256:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)
            cols = [[], [], [], [], []]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)


def answered(rows: DataFrame, answer, finish, schema: str, parts: int) -> DataFrame:
    """Questions meet the table's rows by home, their answers return to their batch.

    answer(tables) gives a function from a question's batch to the answer's array; finish(rest, answers by bucket in
    order) gives the batch's rows.  An entry travels once for each batch that asks it, however many documents hold it, so
    frequent words make no hot key.  Rows come sorted: a task holds one home's table, and then one batch, at a time.
    """

    def replies(batches):
        now, tables, reply = None, [], None
        for home, kind, batch, bucket, value in each(batches):
            if kind == REST:
                yield bucket, REST, batch, bucket, value
                continue
            if home != now:
                now, tables, reply = home, [], None
            if kind == TABLE:
                tables.append(value)
                continue
            if reply is None:
                reply, tables = answer(unparcel(v) for v in tables), []
            yield bucket, QUESTION, batch, bucket, parcel(pa.RecordBatch.from_arrays([reply(unparcel(value))], ["answer"]))

    def first(batches):
        yield from gathered(replies(batches))

    def second(batches):
        now, answers = None, []
        for _, kind, batch, _, value in each(batches):
            if batch != now:
                now, answers = batch, []
            if kind == REST:
                yield finish(unparcel(value), answers)
                answers = []
            else:
                answers.append(unparcel(value).column(0))

    met = by_home(rows, F.col("home"), parts).sortWithinPartitions("home", "kind").mapInArrow(first, ASKED)
    return by_home(met, F.col("batch"), parts).sortWithinPartitions("batch", "kind", "bucket").mapInArrow(second, schema)
