"""CSV files taken apart by many tasks: their headers, and records that run over lines.

A file is read in blocks of lines. Whether a line begins inside a quoted field depends
on all lines before it, so each block first tells what it does to either beginning;
carried over the blocks of a file, this gives every block its own. The blocks are then
cut into records at once, and only the pieces of records that cross a border meet.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercastar.storage import durable
from mercastar.workers import find_package

# Blocks that begin inside a field are broadcast, 24 bytes each.
MOST_BLOCKS = 1 << 20

LONGEST_HEADER = 1 << 16

# Pieces of a block: a whole record, the end of an earlier one, a stretch of an earlier
# one that fills the block, and a record that is open at the end of the block.
WHOLE, END, MIDDLE, OPEN = range(4)

_CONTENT = re.compile(r'(?:[^"]|"")*+')


def inside_after(line: str, inside: bool) -> bool:
    """Whether a line ends inside a quoted field, given whether it begins in one.

    A field is quoted if its first character is a quote. A doubled quote stays in it;
    what follows its end, up to the next comma, is taken as it is, as are quotes in
    other fields.
    """
    at = 0
    while True:
        if inside:
            at = _CONTENT.match(line, at).end()
            if at == len(line):
                return True
            at = line.find(",", at + 1) + 1
            if not at:
                return False
        if line.find('"', at) < 0:
            return False
        inside = line[at] == '"'
        if inside:
            at += 1
        else:
            at = line.find(",", at) + 1
            if not at:
                return False


def _marks(batch: pa.RecordBatch) -> tuple[pa.Array, pa.Array]:
    """Which lines hold a quote, and which one where a field may begin."""
    lines = batch.column("value")
    return pc.match_substring(lines, '"'), pc.match_substring_regex(lines, '(^|,)"')


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines of files, cut at line feeds only, with the file and the start of their block."""
    text = spark.read.option("lineSep", "\n").text(paths)
    return text.select(
        "value",
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block: the state after it, had it begun outside or inside a field."""
    now, outside, inside = None, False, True
    for batch in batches:
        done = []
        files, blocks = batch.column("file").to_numpy(), batch.column("block").to_numpy()
        marked, opening = (m.to_numpy(zero_copy_only=False).copy() for m in _marks(batch))
        new = (files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])
        marked[1:] |= new
        for i in sorted({0, *marked.nonzero()[0].tolist()}):
            key = (int(files[i]), int(blocks[i]))
            line, opens = batch.column("value")[i].as_py(), opening[i]
            if key != now:
                if now is not None:
                    done.append((*now, outside, inside))
                now, outside, inside = key, False, True
                if key[1] == 0 and line.startswith("﻿"):
                    line, opens = line[1:], True
            if outside or opens:
                outside = inside_after(line, outside)
            if inside or opens:
                inside = inside_after(line, inside)
        yield _effect_batch(done)
    if now is not None:
        yield _effect_batch([(*now, outside, inside)])


def _effect_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
    names = ["file", "block", "outside", "inside"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _beginnings(effects: DataFrame) -> DataFrame:
    """The blocks `(of, at)` that begin inside a field.

    An effect either fixes the state, leaves it or turns it. The state after a block
    is the one last fixed, turned as often as blocks since then turn it.
    """
    line = Window.partitionBy("file").orderBy("block")
    upto = line.rowsBetween(Window.unboundedPreceding, 0)
    counted = effects.withColumn("turns", F.sum((F.col("outside") & ~F.col("inside")).cast("int")).over(upto))
    fixed = F.when(
        F.col("outside") == F.col("inside"),
        F.struct(F.col("outside").cast("int").alias("state"), F.col("turns").alias("turns")),
    )
    last = counted.withColumn("last", F.last(fixed, ignorenulls=True).over(upto))
    zero = F.lit(0)
    state = F.coalesce("last.state", zero) + F.col("turns") - F.coalesce("last.turns", zero)
    before = last.withColumn("state", state % 2).withColumn("state", F.lag("state", 1, 0).over(line))
    return before.where("state = 1").select(F.col("file").alias("of"), F.col("block").alias("at"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and parts of records `(file, block, kind, first, text)`, in order.

    `first` marks the first record of a file. Empty lines between records are left out.
    """
    now, inside, earlier, first, pending = None, False, False, False, []
    for batch in batches:
        out = []

        def put(kind: int, text: str) -> None:
            nonlocal first
            out.append((*now, kind, first, text))
            first = False

        lines = batch.column("value").to_pylist()
        marked, opening = (m.to_pylist() for m in _marks(batch))
        keys = zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), strict=True)
        begins = batch.column("began").to_pylist()
        for line, quotes, opens, key, began in zip(lines, marked, opening, keys, begins, strict=True):
            if key != now:
                if pending:
                    put(MIDDLE if earlier else OPEN, "\n".join(pending))
                now, inside, earlier, first, pending = key, began, began, key[1] == 0, []
                if first and line.startswith("﻿"):
                    line, opens = line[1:], True
            if not inside and not opens:
                if line not in ("", "\r"):
                    put(WHOLE, line)
                continue
            pending.append(line)
            if quotes:
                inside = inside_after(line, inside)
            if not inside:
                put(END if earlier else WHOLE, "\n".join(pending))
                earlier, pending = False, []
        yield _piece_batch(out)
    if pending:
        kind = MIDDLE if earlier else OPEN
        yield _piece_batch([(*now, kind, first, "\n".join(pending))])


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 5
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
    names = ["file", "block", "kind", "first", "text"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def read_records(spark: SparkSession, files: list[str]) -> DataFrame:
    """All records of CSV files as `text`, without the first record of each file.

    Quoted fields may hold line breaks. A record ends with a line feed, or a carriage
    return and a line feed, outside of quoted fields; line ends in fields stay as they
    are. Files are read twice, in blocks: once for the quotes, once for the records,
    which are stored. A record that crosses
    blocks is put together from its pieces; no other text is shuffled.
    """
    find_package(spark)
    lines = _lines(spark, files)
    effects = durable(
        lines.mapInArrow(_effects, "file bigint, block bigint, outside boolean, inside boolean")
    )
    blocks = effects.count()
    if blocks > MOST_BLOCKS:
        raise ValueError(f"{blocks} blocks, more than {MOST_BLOCKS}: raise spark.sql.files.maxPartitionBytes")
    began = _beginnings(effects)
    here = (F.col("file") == F.col("of")) & (F.col("block") == F.col("at"))
    # Rows keep their order in the scan: the blocks that begin inside are broadcast.
    told = lines.join(F.broadcast(began), here, "left").select(
        "value", "file", "block", F.col("of").isNotNull().alias("began")
    )
    pieces = durable(
        told.mapInArrow(_pieces, "file bigint, block bigint, kind int, first boolean, text string")
    )
    whole = pieces.where(F.col("kind") == WHOLE).select("first", "text")

    line = Window.partitionBy("file").orderBy("block", "kind")
    opened = F.last(F.when(F.col("kind") == OPEN, F.col("block")), ignorenulls=True).over(line)
    crossing = pieces.where(F.col("kind") != WHOLE).withColumn("opened", opened)
    parts = F.array_sort(F.collect_list(F.struct("block", "kind", "text", "first")))
    crossing = crossing.groupBy("file", "opened").agg(parts.alias("parts")).select(
        F.get("parts", F.lit(0))["first"].alias("first"),
        F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"),
    )
    records = whole.unionByName(crossing).where(~F.col("first"))
    return records.select(F.regexp_replace("text", r"\r$", "").alias("text"))


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line of each file `(line, path)`, of lines that lie together by file."""
    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        paths = batch.column("path")
        new = pc.indices_nonzero(pc.not_equal(paths[1:], paths[:-1])).to_pylist()
        firsts = [0] * (paths[0].as_py() != now) + [i + 1 for i in new]
        now = paths[-1].as_py()
        if firsts:
            yield batch.take(pa.array(firsts)).rename_columns(["line", "path"])


def first_lines(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files of a path, folder or pattern by their first line, found by tasks.

    The driver lists the files and gets their distinct first lines with their names; it
    opens none. Lines are scanned as text, which takes a fraction of what parsing them
    takes; of the first block of a file, only the line that comes first goes on. Files are
    scanned in their order, so no task holds or sorts lines for it. Empty files have no
    first line.
    """
    try:
        text = spark.read.option("lineSep", "\n").text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    told = text.select(
        F.substring("value", 1, LONGEST_HEADER).alias("value"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    find_package(spark)
    heads = told.where("block = 0").select("value", "path").mapInArrow(_heads, "line string, path string")
    found = heads.groupBy("line").agg(F.array_sort(F.collect_list("path")).alias("paths")).collect()
    return {r["line"]: [_decoded(spark, p) for p in r["paths"]] for r in found}


def _decoded(spark: SparkSession, path: str) -> str:
    """A path as readers take it, from the URI that the scan reports."""
    if "%" not in path:
        return path
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path)).toString()
