"""Tables in the shared folder, and column helpers that several operators use."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, which separates words (Java regular expression class body).
BLANK = r"\x20\x09-\x0D"
#: Ids up to which a filter on documents is broadcast (8 bytes each).
BROADCAST_IDS = 2_000_000
#: Rows of a batch of texts that a task works on, and passes on, at a time.
SLICE_ROWS = 500
#: A worker remembers the last 240,000 to 480,000 distinct strings of a function, unless told otherwise.
REMEMBERED = 240_000


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, named by ``spark.checkpoint.dir``.

    Where that is unset a scratch folder is made, in local mode only: on a
    cluster a machine-local folder would lose rows, so this raises.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="telemetra-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Tables that the last pipeline stage stored, and whether it is being built; see :func:`stage`.
_of_stage: list[DataFrame] = []
_in_stage: list[bool] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs only the tasks that read the table.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    if _in_stage:
        _of_stage.append(out)
    return out


def stage(function):
    """A pipeline stage: when the next one begins, the tables it stored are deleted.

    The result of a stage has been written by then, so nothing reads them.
    """
    @functools.wraps(function)
    def run(spark, docs, sf_dir):
        while _of_stage:
            discard(_of_stage.pop())
        _in_stage.append(True)
        try:
            return function(spark, docs, sf_dir)
        finally:
            _in_stage.pop()
    return run


def without(docs: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """``docs`` without the rows whose id is in ``ids`` (column ``id``); null ids stay.

    The ids are broadcast when they are few, else both sides are shuffled.
    """
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, docs[id_col] == ids["id"], "left_anti")


def discard(df: DataFrame) -> None:
    """Delete a :func:`stored` table that no later plan reads."""
    path = getattr(df, "_stored_at", None)
    if path:
        spark = df.sparkSession
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def stored_bytes(df: DataFrame) -> int:
    """Size of the files of a :func:`stored` table."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def text_of(col: str | Column) -> Column:
    """The text, null counted as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, though the body uses it often."""
    return F.transform(F.array(value), body)[0]


def slices(batches):
    """The rows of ``batches``, a few at a time: what is made of a whole batch of texts takes several times its room."""
    for batch in batches:
        for first in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(first, SLICE_ROWS)


_remembering: list["Remembered"] = []


def forget_others(*kept: "Remembered") -> None:
    """Workers outlive a stage: drop what earlier stages remembered there, and give back unused memory."""
    import pyarrow as pa

    for memory in _remembering:
        if not any(memory is k for k in kept):
            memory.clear()
            memory.older = {}
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc: freed arrays stay with the process else
    if give_back:
        give_back(0)


def forgetting(run):
    """``run`` of an Arrow map; when its task ends, its worker drops what it remembered and Arrow's unused memory.

    Workers stay, also those that later stages have no use for.
    """
    def task(batches):
        try:
            yield from run(batches)
        finally:
            forget_others()
    return task


class Remembered(dict):
    """Results of a function of a string; those not used for long are forgotten."""

    def __init__(self, of, room: int = REMEMBERED):
        self.of, self.older, self.room = of, {}, room
        _remembering.append(self)

    def __missing__(self, key):
        out = self.older.pop(key, None)
        if out is None:
            out = self.of(key)
        self[key] = out
        return out

    def trim(self):
        if len(self) > self.room:
            self.older = dict(self)
            self.clear()
