"""Shared pieces of the corpus operators: the shared folder, lineage cuts and sizes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the separators of words in every contract of this subpackage.
WHITE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is the session's ``spark.checkpoint.dir``. Only where that is unset (local tests, where driver and
    executors are one process) a temporary folder is made, once per application.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        named = sc.getCheckpointDir() or tempfile.mkdtemp(prefix="docket-shared-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder, as a URI with a scheme."""
    base = shared_dir(spark)
    return f"{base if '://' in base or base.startswith('file:') else 'file://' + base}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows as a table in the shared folder and read them back: lineage ends here and a lost executor
    costs nothing that was computed before."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder; its files go when the result is no longer used."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out evenly when the input comes in fewer splits than the session has cores."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of a text column, counted over all rows."""
    return df.select(F.sum(F.octet_length(column))).first()[0] or 0


def map_column(rows: DataFrame, column: str, fields: str, start) -> DataFrame:
    """Append columns computed from one column, in Arrow batches; all other columns pass unchanged, nulls and nested
    types included. ``start()`` runs once a task and returns a function from the values of a batch to a list of
    value lists, one for each of ``fields``. Columns of ``rows`` with the names of new ones are left out.
    """
    import pyarrow as pa
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_type

    new = T._parse_datatype_string(fields)
    kept = [f for f in rows.schema if f.name not in new.names]
    types = [to_arrow_type(f.dataType) for f in new]
    names = [f.name for f in kept] + new.names
    at = rows.columns.index(column)
    places = [i for i, c in enumerate(rows.columns) if c not in new.names]

    def run(batches):
        work = start()
        for b in batches:
            for lo, hi in _pieces(b.column(at)):
                part = b.slice(lo, hi - lo)
                made = [pa.array(v, type=t) for v, t in zip(work(part.column(at).to_pylist()), types)]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in places] + made, names=names)

    return rows.mapInArrow(run, T.StructType(kept + list(new)))


def _pieces(values, limit: int = 8 << 20):
    """Row ranges of a batch of about ``limit`` bytes each, one row at least, so that long texts don't pile up."""
    import numpy as np
    import pyarrow.compute as pc

    length = pc.list_value_length if str(values.type).startswith(("list", "large_list")) else pc.binary_length
    sizes = np.cumsum(pc.fill_null(length(values), 0).to_numpy(zero_copy_only=False)) if len(values) else []
    lo = 0
    while lo < len(values):
        base = int(sizes[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(sizes, base + limit, side="right")))
        yield lo, hi
        lo = hi
